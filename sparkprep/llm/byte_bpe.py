"""Operator 2, byte-level BPE: encoding and decoding by a rank file.

A text is split by the vocabulary's pattern; each pre-token is looked up in
two tiers:

1. a minimal perfect hash over the vocabulary: a slot for every token and no
   slot free, two small arrays, and one comparison of bytes that tells whether
   the pre-token is the token of that slot. A hit is the pre-token's id;
2. a miss is merged byte by byte: a heap has the ranks of adjacent pairs and
   a linked list has the parts, so a pre-token of n bytes takes n log n steps.

Decoding joins the bytes of the ids. The rank file is read on the driver; its
tokens and the hash's arrays are sent to the tasks (bounded by the vocabulary).
A worker remembers results of pre-tokens in a bounded table.

Defined results: null counts as empty and has no ids; any text is encoded
whole, however long (a task holds it once, with its ids); special tokens do not
exist: their strings are ordinary text; null ids and repeated rows are rows like
others; an empty table gives no rows; further columns are not looked at, whatever
their names."""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .common import bounded_batches, exact, slices, strings
from .pieces import RUN, PieceTable

REMEMBERED = 400_000
# Fixed value: the pattern for which texts may be cut before blanks and line feeds.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Marks that the pattern puts into one pre-token when they follow letters.
MARKS = ".,;:!?"


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank; the file has a base64 token and its rank per line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must count from 0 without gaps")
    return sorted(ranks, key=ranks.get)


class PerfectHash:
    """A minimal perfect hash of ``keys``: two halves of a 64-bit hash; the
    first picks a bucket, the second, displaced by the bucket's seed, the slot.
    Buckets are placed from the largest to the smallest, each with the first
    seed that puts all its keys into free slots."""

    def __init__(self, keys: list[bytes], load: int = 2):
        self.n = max(1, len(keys))
        self.buckets = max(1, len(keys) // load)
        self.seed = np.zeros(self.buckets, np.int64)
        self.slot = np.full(self.n, -1, np.int64)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        halves = [divmod(xxhash.xxh64_intdigest(k), 1 << 32) for k in keys]
        for i, (a, _) in enumerate(halves):
            members[a % self.buckets].append(i)
        free = bytearray(b"\x01") * self.n
        left = self.n
        for b in sorted(range(self.buckets), key=lambda x: -len(members[x])):
            if len(members[b]) == 1 and left * 8 < self.n:
                # Few slots are left: a seed below zero names the slot itself.
                at = free.index(1)
                self.seed[b], free[at] = -1 - at, 0
                self.slot[at] = members[b][0]
                left -= 1
                continue
            for seed in range(1 << 20) if members[b] else ():
                at = [self._place(halves[i][1], seed) for i in members[b]]
                if len(set(at)) == len(at) and all(free[x] for x in at):
                    self.seed[b] = seed
                    for x, i in zip(at, members[b]):
                        free[x] = 0
                        self.slot[x] = i
                    left -= len(at)
                    break
            else:
                if members[b]:
                    raise ValueError("no seed found")
        self.seed, self.slot = self.seed.tolist(), self.slot.tolist()

    def _place(self, half: int, seed: int) -> int:
        x = (half ^ (seed * 0x9E3779B1)) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return (x >> 32) % self.n

    def __call__(self, key: bytes) -> int:
        """The place of ``key`` if it is a key; else of some other key."""
        a, b = divmod(xxhash.xxh64_intdigest(key), 1 << 32)
        seed = self.seed[a % self.buckets]
        return self.slot[self._place(b, seed) if seed >= 0 else -1 - seed]


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, tokens: list[bytes], hash_: PerfectHash, pattern: str):
        import regex

        self.tokens, self.hash = tokens, hash_
        self.pattern = regex.compile(pattern)
        self.rank = {t: i for i, t in enumerate(tokens)}  # of the pairs that the heap meets
        self.single = [self.rank[bytes((b,))] for b in range(256)]
        self.two = [self.rank.get(bytes(divmod(x, 256)), -1) for x in range(1 << 16)]
        self.cuts = pattern == PATTERN
        self.plain = PieceTable(lambda pieces: list(map(self._piece, pieces)), "<u4", REMEMBERED)

    def id_of(self, piece: bytes) -> int:
        """The id of a whole token, -1 if it is none."""
        i = self.hash(piece)
        return i if self.tokens[i] == piece else -1

    def merge(self, piece: bytes) -> list[int]:
        """Tier two: the ids of a pre-token that is no token. Heap entries are
        one number: rank, start and end of the pair; an entry whose parts have
        changed meanwhile is passed over."""
        n, rank = len(piece), self.rank.get
        ids = [self.single[b] for b in piece]
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        bits = n.bit_length()
        low, wide = (1 << bits) - 1, 2 * bits
        heap = [self.two[a << 8 | b] << wide | i << bits | i + 2
                for i, (a, b) in enumerate(zip(piece, piece[1:])) if self.two[a << 8 | b] >= 0]
        heapify(heap)
        while heap:
            x = heappop(heap)
            i, e = x >> bits & low, x & low
            m = end[i]
            if ids[i] < 0 or m >= n or end[m] != e:
                continue
            ids[i], ids[m], end[i] = x >> wide, -1, e
            if e < n:
                before[e] = i
                r = rank(piece[i : end[e]])
                if r is not None:
                    heappush(heap, r << wide | i << bits | end[e])
            j = before[i]
            if j >= 0:
                r = rank(piece[j:e])
                if r is not None:
                    heappush(heap, r << wide | j << bits | e)
        return [x for x in ids if x >= 0]

    def _ids(self, pretokens) -> bytes:
        out = []
        for p in pretokens:
            b = p.encode()
            i = self.id_of(b)
            out += self.merge(b) if i < 0 else [i]
        return pack(f"<{len(out)}I", *out)

    def _piece(self, piece: str) -> bytes:
        """The ids of a blank or line feed and what follows it, or of what a text begins with."""
        if piece[:1] != " ":
            return self._ids(self.pattern.findall(piece))
        word = piece.rstrip(MARKS)
        if not word[1:].isalpha():
            return self._ids(self.pattern.findall(piece))
        # Letters, then perhaps marks: two pre-tokens.
        return self._ids((word, piece[len(word):]) if len(word) < len(piece) else (word,))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Texts that can be cut are put together from their
        distinct pieces; white space beside white space, or another pattern than
        the one the cuts are known for, leaves a text to the pattern alone."""
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if self.cuts and not RUN.search(t)]
        for i, ids in zip(plain, self.plain([texts[i] for i in plain])):
            out[i] = ids
        return [self._ids(self.pattern.findall(t)) if ids is None else ids for t, ids in zip(texts, out)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple, Codec] = {}


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit), for each row."""
    return _run(df, ranks_path, pattern, id_col, text_col, "ids binary", lambda c, ts: [(ids,) for ids in c.encode_all(ts)])


def decode_documents(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text for each row of ``encode_documents``. Ids that end inside
    a character give U+FFFD there, as the reference library's decoder does."""
    return _run(df, ranks_path, pattern, id_col, ids_col, "text string",
                lambda c, ts: [(c.decode(t).decode("utf-8", "replace"),) for t in ts])


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: a digest of the ids, and of the bytes they decode to."""

    def both(codec, texts):
        return [(len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest())
                for ids in codec.encode_all(texts)]

    return _run(df, ranks_path, pattern, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", both)


def _run(df, ranks_path, pattern, id_col, value_col, schema, work) -> DataFrame:
    bounded_batches(df)
    rows = exact(df, doc_id=id_col, text=value_col)
    tokens = read_ranks(ranks_path)
    # A worker's codec is found by what the file holds, not by its path.
    content = hashlib.sha256(b"".join(len(t).to_bytes(4) + t for t in tokens)).digest()
    shared = df.sparkSession.sparkContext.broadcast((tokens, PerfectHash(tokens)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    binary = rows.schema["text"].dataType.simpleString() == "binary"
    names = ["doc_id", *(c.split()[0] for c in schema.split(", "))]

    def task(batches):
        import pyarrow as pa

        key = (content, pattern)
        if key not in _CODECS:
            _CODECS.clear()
            _CODECS[key] = Codec(*shared.value, pattern)
        types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        kinds = [types[c.split()[1]] for c in schema.split(", ")]
        for piece in slices(batches):
            column = piece.column("text")
            values = [b"" if x is None else x for x in column.to_pylist()] if binary else strings(column)
            out = work(_CODECS[key], values)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names)

    return rows.mapInArrow(task, f"doc_id {kind}, {schema}")
