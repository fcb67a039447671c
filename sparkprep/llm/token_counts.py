"""Operator 6, token counts of a BPE model in the sentencepiece format.

Counting needs no ids in order, so a task takes the distinct pre-tokens of a
few MB of text together, holds them as one ragged array of symbols, and works
in rounds: each round looks up the rank of every adjacent pair, takes each
sequence's lowest rank (the leftmost of equals) and merges it, in all
sequences at once. A sequence without a known pair leaves; what is left of it
is its count.

A text is cut where no merge can reach over: before a run of blanks, as no
piece has a blank after another character, and around characters that no longer
piece has (a line feed, say). Both rules are taken from the model's pieces.

Defined results: null counts as empty and has no tokens; texts of any length
are counted whole; null ids and repeated rows are rows like others; an empty
table gives no rows; further columns are not looked at, whatever their names."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memo, bounded_batches, exact, slices, strings

BLANK = "▁"
FAR = np.int64(1) << 62
#: Sequences above this are merged one at a time, not in rounds.
LONG = 4096
#: Pre-tokens that a worker remembers.
REMEMBERED = 400_000


def read_model(path: str) -> dict:
    """The pieces that merges can make, with their scores; on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for probe in ("a  b ", "ﬁ éé"):
        if sp.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("only models that keep texts as they are and put one blank before them")
    ids = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {"pieces": [sp.id_to_piece(i) for i in ids], "scores": [sp.get_score(i) for i in ids]}


class Merger:
    """Merge tables of a model as sorted numpy arrays."""

    def __init__(self, model: dict):
        pieces, scores = model["pieces"], np.array(model["scores"])
        rank = np.unique(-scores, return_inverse=True)[1]
        symbol = {p: i for i, p in enumerate(pieces)}
        longer = [p for p in pieces if len(p) > 1]
        joined = set("".join(longer))
        if any(BLANK in p.lstrip(BLANK) for p in longer):
            raise ValueError("a piece has a blank inside")
        for c in joined:
            symbol.setdefault(c, len(symbol))
        self.n = len(symbol) + 1  # the last symbol is any character that no piece has
        self.of_char = np.full(0x110000, self.n - 1, np.int32)
        self.known = np.zeros(0x110000, bool)
        for s, i in symbol.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        for p in pieces:
            if len(p) == 1:
                self.known[ord(p)] = True
        table = {}
        for p in longer:
            for j in range(1, len(p)):
                left, right = symbol.get(p[:j]), symbol.get(p[j:])
                if left is not None and right is not None:
                    table[left * self.n + right] = (int(rank[symbol[p]]), symbol[p])
        keys = sorted(table)
        self.keys = np.array(keys + [FAR], np.int64)
        self.rank = np.array([table[k][0] for k in keys] + [FAR], np.int64)
        self.made = np.array([table[k][1] for k in keys] + [-1], np.int32)
        alone = "".join(c for c in ("\n", "\t") if c not in joined)
        none = f"[^{BLANK}{alone}]"
        self.cut = re.compile(f"[{alone}]|{BLANK}+{none}*|{none}+" if alone else f"{BLANK}+{none}*|{none}+")

    def pretokens(self, text: str) -> list[str]:
        return self.cut.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def pairs(self, left, right):
        """Rank and product of each pair; an unknown pair has rank FAR."""
        key = left.astype(np.int64) * self.n + right
        at = np.searchsorted(self.keys, key)
        at[self.keys[at] != key] = len(self.keys) - 1
        return self.rank[at], self.made[at]

    def counts(self, units: list[str]) -> np.ndarray:
        """Surviving symbols of each unit, as the library would count tokens."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        start = np.cumsum(size) - size
        sym = self.of_char[points]
        # A character that is no piece ends as its UTF-8 bytes; merged away, it costs nothing.
        extra = np.where(self.known[points], 0, (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF))
        out = np.zeros(len(units), np.int64)
        for k in np.flatnonzero(size > LONG):
            s = slice(start[k], start[k] + size[k])
            out[k] = self._long(sym[s], extra[s])
        live = np.flatnonzero((size <= LONG) & (size > 0))
        if not len(live):
            return out
        keep = np.repeat(size <= LONG, size)
        sym, extra, owner = sym[keep], extra[keep], np.repeat(np.arange(len(live)), size[live])
        n = size[live].copy()
        while len(sym):
            first = np.cumsum(n) - n
            rank, made = np.full(len(sym), FAR), np.empty(len(sym), np.int32)
            inside = owner[:-1] == owner[1:]
            at = np.flatnonzero(inside)
            rank[at], made[at] = self.pairs(sym[at], sym[at + 1])
            # Rank and place in one number: the least is the leftmost lowest rank.
            place = np.arange(len(sym)) - np.repeat(first, n)
            least = np.minimum.reduceat(np.where(rank < FAR, rank * (LONG + 1) + place, FAR), first)
            over = least == FAR
            if over.any():
                ended = np.repeat(over, n)
                out[live[over]] = n[over] + np.add.reduceat(extra, first)[over]
                if over.all():
                    break
                stay = ~ended
                hit = (first + least % (LONG + 1))[~over]
                moved = np.cumsum(stay) - 1
                sym, extra, made = sym[stay], extra[stay], made[stay]
                hit = moved[hit]
                live, n = live[~over], n[~over]
            else:
                hit = first + least % (LONG + 1)
            sym[hit] = made[hit]
            extra[hit] = 0
            rest = np.ones(len(sym), bool)
            rest[hit + 1] = False
            sym, extra, n = sym[rest], extra[rest], n - 1
            owner = np.repeat(np.arange(len(n)), n)
        return out

    def _long(self, sym, extra, block: int = 512) -> int:
        """One very long sequence: the same merges in the same order, with the
        lowest rank found through the least of each block."""
        n = len(sym)
        sym, extra = sym.copy(), extra.copy()
        rank, made = np.full(n + (-n) % block, FAR), np.zeros(n, np.int32)
        rank[: n - 1], made[: n - 1] = self.pairs(sym[:-1], sym[1:])
        blocks = rank.reshape(-1, block)
        least = blocks.min(1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n

        def put(i, r):
            rank[i] = r
            least[i // block] = blocks[i // block].min()

        while True:
            b = int(least.argmin())
            if least[b] == FAR:
                return left + int(extra.sum())
            i = b * block + int(blocks[b].argmin())
            j = after[i]
            sym[i], extra[i], extra[j] = made[i], 0, 0
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            left -= 1
            put(j, FAR)
            for a, z in ((before[i], i), (i, after[i])):
                if a >= 0:
                    if z < n:
                        r, m = self.pairs(sym[a : a + 1], sym[z : z + 1])
                        made[a] = m[0]
                        put(a, r[0])
                    else:
                        put(a, FAR)


_MERGERS: dict[str, Merger] = {}


def count_tokens(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row. The model is read
    on the driver and sent to the tasks (its size is the vocabulary's)."""
    spark: SparkSession = df.sparkSession
    bounded_batches(df)
    docs = exact(df, doc_id=id_col, text=text_col)
    model = spark.sparkContext.broadcast(read_model(model_path))
    # A worker's merger is found by what the file holds, not by its path.
    with open(model_path, "rb") as f:
        content = hashlib.sha256(f.read()).digest()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        import pyarrow as pa

        if content not in _MERGERS:
            _MERGERS.clear()
            _MERGERS[content] = Merger(model.value)
            _MERGERS[content].memo = Memo(REMEMBERED)
        merger, memo = _MERGERS[content], _MERGERS[content].memo
        for piece in slices(batches):
            docs_units = [merger.pretokens(t) for t in strings(piece.column("text"))]
            new = list({u for units in docs_units for u in units if u not in memo})
            if memo.full(len(new)):
                new = list({u for units in docs_units for u in units})
            if new:
                memo.update(zip(new, merger.counts(new).tolist()))
            n = [sum(map(memo.__getitem__, units)) for units in docs_units]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return counted.mapInArrow(task, f"doc_id {kind}, n_bytes bigint, n_tokens bigint").withColumn(
        "over_limit", F.col("n_tokens") > limit)
