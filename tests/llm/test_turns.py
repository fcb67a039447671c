"""Conversation repair against plain definitions: every edit script of short
conversations, and a table of least audits from the end for longer ones."""
import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from sparkprep.llm import turns as T
from sparkprep.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SOUND = re.compile(r"(s?(ua)+)?\Z")


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        do = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if do == 0:
            continue
        text = "" if do == 1 else re.sub("[.!?]", "", text) if do == 2 else text
        out += [(c, t, "user" if do == 4 else role, text)] * (2 if do == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        mark = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not mark else "duplicate" if (role, text) in seen else "truncated" if mark[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def least_audit(rows, found):
    """(cost, audit) from the end of the conversation: suffixes can be compared, as their first letters decide."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        options = []
        if inserted < 2:
            c, a = best(i, follow[last], inserted + 1)
            options.append((c + 3, "I" + a))
        if i == len(rows):
            if last in ("", "a"):
                options.append((0, ""))
            return min(options, default=(10**9, ""))
        role, f = rows[i][2], found[i]
        c, a = best(i + 1, last, 0)
        options.append((c + 4, "D" + a))
        if f not in ("blank", "duplicate"):
            extra = 3 if f == "truncated" else 0
            if role[:1] == follow[last] or (role[:1] == "s" and last == ""):
                c, a = best(i + 1, role[:1], 0)
                options.append((c + extra, "K" + a))
            c, a = best(i + 1, follow[last], 0)
            options.append((c + 3 + extra, "R" + a))
        return min(options)

    import sys
    sys.setrecursionlimit(100_000)
    return best(0, "", 0)


def repaired(rows, audit):
    names, out, it = {"": "user", "s": "user", "u": "assistant", "a": "user"}, [], iter(rows)
    for letter in audit:
        last = out[-1][0][0] if out else ""
        if letter == "I":
            out.append((names[last], ""))
            continue
        _, _, role, text = next(it)
        if letter != "D":
            out.append((role if letter == "K" else names[last], text))
    assert next(it, None) is None and SOUND.match("".join(r[0] for r, _ in out))
    return out


def plain(rows, ids):
    out = []
    for c in set(ids):
        own = in_order([r for r in rows if r[0] == c])
        found = faults(own)
        cost, audit = least_audit(own, found)
        text = "\n".join(f"{r}:{t}" for r, t in repaired(own, audit))
        marks = [r[2][:1] for r in own]
        have = [r[1] for r in own if r[1] is not None]
        out.append((c, max(have) - min(have) + 1 - len(set(have)) if have else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(marks, marks[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: (r[0] is not None, r[0] or 0))


def every_script(kinds):
    """The least (cost, audit) among all edit scripts with up to two inserts at a place."""
    best, names = None, {"": "u", "s": "u", "u": "a", "a": "u"}
    for ins in itertools.product(range(3), repeat=len(kinds) + 1):
        for ops in itertools.product("DKR", repeat=len(kinds)):
            last, cost, roles = "", 0, ""
            for n, op, kind in itertools.zip_longest(ins, ops, kinds):
                for _ in range(n):
                    last = names.get(last, "u")
                    roles, cost = roles + last, cost + 3
                if op is None:
                    break
                if op == "D":
                    cost += 4
                    continue
                if kind[1] == "d":
                    cost += 10**6
                last = kind[0] if op == "K" else names.get(last, "u")
                roles += last
                cost += (op == "R") * 3 + (kind[1] == "t") * 3
            if SOUND.match(roles):
                audit = "".join("I" * n + (o or "") for n, o in itertools.zip_longest(ins, ops))
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def solved(kinds):
    runs = [T.ROWS[k] for k in kinds]
    q = T.last_state(T.join(runs))
    edits = [T.EDITS[k][a][b] for k, (a, b) in zip(kinds, T.cross(runs, T.NOTHING, q))]
    return sum(c for c, _ in edits) + 3 * T.AT_END[q], "".join(a for _, a in edits) + "I" * T.AT_END[q]


def test_cross_against_every_script():
    kinds = sorted(T.EDITS)
    cases = [c for n in range(3) for c in itertools.product(kinds, repeat=n)]
    rng = random.Random(5)
    cases += [tuple(rng.choices(kinds, k=n)) for n in (3, 3, 4) for _ in range(60)]
    for case in cases:
        assert solved(case) == every_script(case), case


def test_cross_against_table_and_in_any_grouping():
    rng = random.Random(6)
    for n in (5, 17, 64, 301):
        kinds = rng.choices(sorted(T.EDITS), k=n)
        rows = [(0, i, {"-": "x"}.get(k[0], k[0]), "") for i, k in enumerate(kinds)]
        found = [{"d": "blank", "t": "truncated", "k": ""}[k[1]] for k in kinds]
        assert solved(kinds) == least_audit(rows, found)
        runs = [T.ROWS[k] for k in kinds]
        cut = rng.randrange(1, n)
        whole, parts = T.join(runs), T.join([T.join(runs[:cut]), T.join(runs[cut:])])
        assert whole.cost == parts.cost
        for p in range(4):
            known = [q for q in range(4) if whole.cost[p][q] < T.INF]
            assert sorted(known, key=whole.rank[p].__getitem__) == sorted(known, key=parts.rank[p].__getitem__)


def conversations():
    rng = random.Random(7)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t * rng.choice([1, 1, 1, 2]), rng.choice(["user", "assistant", "system", "tool", "", "agent", "User"]),
                         rng.choice(["Hi.", "yes", "", " \t\n", "What?", "ok.\n", "\x85", "no!\x0b"])))
    rows += [(100, None, "user", "a."), (100, None, "assistant", "b."), (100, 3, "user", None), (100, 3, None, "c"), (None, 1, "user", "x."),
             (None, None, None, None), (101, None, "user", "x."), (102, 5, "assistant", "long " * 50_000), (103, 0, "user", "q."), (103, 0, "user", "q.")]
    rows += [(200, i // 2, "user" if i % 3 else "assistant", f"t{i % 50}.") for i in range(400)]
    return rows


def test_against_plain(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    hurt = T.damage(df)
    assert sorted(map(str, plain_damage(rows))) == sorted(str(tuple(r)) for r in hurt.collect())
    want = plain(plain_damage(rows), [r[0] for r in rows])
    assert got(T.repair(hurt, df)) == want
    # As it is, without damage.
    blank = [tuple(" " if x is None and i > 1 else x for i, x in enumerate(r)) for r in rows]
    assert got(T.repair(df)) == plain(blank, [r[0] for r in rows])


def test_long_conversation_in_levels_of_runs(spark, monkeypatch):
    monkeypatch.setattr(T, "RUN", 5)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(T.repair(T.damage(df), df)) == plain(plain_damage(rows), [r[0] for r in rows])


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.repair(T.damage(empty), empty).collect() == []
    df = spark.createDataFrame([(1, 0, "user", "a.", "x", 9)], "conv_id bigint, turn bigint, role string, text string, TEXT string, g int")
    assert got(T.repair(T.damage(df), df))[0][0] == 1


def test_rows_all_dropped(spark):
    gone = [(c, 0, "user", "a.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(gone, SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert got(T.repair(T.damage(df), df)) == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in gone]


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_conversation_repair"](spark, sf_dir)) == plain(plain_damage(rows), [r[0] for r in rows])
