"""Token ids of texts from those of their distinct pieces.

The pattern of the byte-level vocabulary begins a pre-token at each blank or line
feed that stands between two other characters, and merges don't cross
pre-tokens. So the ids of a text without white space beside white space are those
of its pieces, cut before each blank and line feed, and a piece need only be
encoded once for as long as a worker remembers it."""

from __future__ import annotations

import re

import numpy as np

#: White space beside white space: such texts are not cut here.
RUN = re.compile(r"\s\s")
#: What a worker remembers of pieces, besides their number.
REMEMBERED_BYTES = 1 << 25


class PieceTable:
    """``encode`` gives the ids (bytes of ``id_type``) of distinct pieces."""

    def __init__(self, encode, id_type: str, remembered: int = 400_000):
        import pyarrow as pa

        self.encode, self.id_type, self.remembered = encode, id_type, remembered
        # The pieces, the ids of all in one array, and how many each has.
        self.pieces, self.flat, self.size = pa.array([], pa.large_string()), np.zeros(0, id_type), np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Arrow splits the texts and numbers the distinct
        pieces; numpy puts their ids in the texts' order."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not texts:
            return []
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        firsts, pieces = split.offsets.to_numpy(), split.flatten()
        coded = pc.dictionary_encode(pieces)
        places = self._remember(coded.dictionary)
        # What a text begins with has no blank before it.
        heads = pieces.take(pa.array(firsts[:-1])).to_pylist()
        every = list(dict.fromkeys(heads))
        of = dict(zip(every, self.encode(every)))
        first = [of[h] for h in heads]
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(first), self.id_type)])
        size = np.concatenate([self.size, self._sizes(first)])
        begin = np.cumsum(size) - size
        index = places[coded.indices.to_numpy()]
        index[firsts[:-1]] = len(self.size) + np.arange(len(first))
        taken = size[index]
        ends = np.cumsum(taken)
        ids = flat[np.repeat(begin[index] - (ends - taken), taken) + np.arange(ends[-1])]
        cuts = np.concatenate([[0], ends])[firsts].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _sizes(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(len, found), np.int64, len(found)) // self.flat.itemsize

    def _remember(self, pieces) -> np.ndarray:
        """The places of distinct pieces in what the worker remembers: pieces that
        have a blank before them unless they begin with a line feed. Those that
        are new are encoded; if they don't fit, only the pieces asked for stay."""
        import pyarrow as pa
        import pyarrow.compute as pc

        at = pc.fill_null(pc.index_in(pieces, value_set=self.pieces), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(self.pieces) + len(new) > self.remembered or self.pieces.nbytes > REMEMBERED_BYTES:
            kept = at[at >= 0]
            begin, size = (np.cumsum(self.size) - self.size)[kept], self.size[kept]
            ends = np.cumsum(size)
            self.flat = self.flat[np.repeat(begin - (ends - size), size) + np.arange(ends[-1])] if len(ends) else self.flat[:0]
            self.pieces, self.size = self.pieces.take(pa.array(kept)), size
            at[at >= 0] = np.arange(len(kept))
        if len(new):
            at[new] = len(self.pieces) + np.arange(len(new))
            wanted = pieces.take(pa.array(new))
            found = self.encode([p if p[:1] == "\n" else " " + p for p in wanted.to_pylist()])
            self.pieces = pa.concat_arrays([self.pieces, wanted])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(found), self.id_type)])
            self.size = np.concatenate([self.size, self._sizes(found)])
        return at
