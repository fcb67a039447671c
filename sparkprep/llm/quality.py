"""Operator 8, quality rules learned by gradient-boosted trees.

Every text is turned into a row of statistics. Trees are boosted on a bounded
sample of labelled rows (about ``SAMPLE`` documents whose ids hash lowest, read
once to the driver as rows of ``len(FEATURES)`` numbers), then flattened into
numpy arrays of nodes: feature, threshold, children, value. Scoring walks all
rows of a batch down all trees level by level.

``FALLING`` features may only lower the score as they grow: a split that would
raise it is not made, and the halves of a split keep to their sides of its
middle further down.

Defined results: null and empty texts have no words and fail the base rules;
without labels of both kinds the verdict is the base rules' alone; null ids
and repeated rows are judged like others; an empty table gives no rows; a text of
any length is read whole by one task; further columns are not looked at, whatever
their names."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, capitals, exact, labelled_documents, slices, strings

SAMPLE = 8000
WINDOW = 5
SYMBOLS = re.compile(r"[#*$%&|<>]")
BLANKS = " \t\n\v\f\r"
FEATURES = ("log_words", "chars_per_word", "symbols_per_char", "dup_line_share", "repeat_word_share",
            "distinct_word_share", "upper_share", "digit_share", "mark_share", "words_per_line", "short_line_share")
#: May only lower the score.
FALLING = ("symbols_per_char", "dup_line_share", "repeat_word_share", "mark_share")


def repeated_words(words: list) -> int:
    """Words that lie in a window of ``WINDOW`` words found twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = len(number)
    if size <= 4096:
        code = np.zeros(n - WINDOW + 1, np.int64)
        for k in range(WINDOW):
            code = code << 12 | ids[k : n - WINDOW + 1 + k]
    else:  # windows are numbered word by word, so that a number always fits
        code = ids
        for k in range(1, WINDOW):
            code = np.unique(code[:-1] * size + ids[k:], return_inverse=True)[1]
    _, which, count = np.unique(code, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[which] > 1)
    edge = np.zeros(n + 1, np.int64)
    edge[twice] += 1
    edge[twice + WINDOW] -= 1
    return int((np.cumsum(edge)[:n] > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The base counts, and the features."""
    words = text.encode().split()
    n, chars = len(words), len(text) - sum(map(text.count, BLANKS))
    symbols = len(SYMBOLS.findall(text))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    dup, rep = len(lines) - len(set(lines)), repeated_words(words)
    letters = text.translate(_NO_MARKS)
    upper, digits = capitals(text), sum(map(text.count, "0123456789"))
    short = sum(len(x) < 30 for x in lines)
    shape = [np.log1p(n), chars / max(n, 1), symbols / max(chars, 1), dup / max(len(lines), 1), rep / max(n, 1),
             len(set(words)) / max(n, 1), upper / max(chars, 1), digits / max(chars, 1),
             (len(text) - len(letters)) / max(chars, 1), n / max(len(lines), 1), short / max(len(lines), 1)]
    return [n, chars, symbols, dup, rep], shape


_NO_MARKS = str.maketrans("", "", "!?;:=+_~^@\\/[]{}()\"")


@dataclass
class Trees:
    """Boosted trees as arrays; node 0 of each tree is its root, leaves point to themselves."""

    feature: np.ndarray  # (trees, nodes)
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, c, l, r, v in zip(self.feature, self.cut, self.left, self.right, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = np.where(x[rows, f[at]] <= c[at], l[at], r[at])
            score += v[at]
        return 1 / (1 + np.exp(-score))


def boost(x: np.ndarray, y: np.ndarray, falling: set[int], trees: int = 60, depth: int = 3, rate: float = 0.2,
          bins: int = 48, ridge: float = 1.0, least: int = 20) -> Trees:
    """Newton boosting of the logistic loss over quantile bins."""
    nodes = 2 ** (depth + 1) - 1
    shape = (trees, nodes)
    feature, left = np.zeros(shape, np.int64), np.tile(np.arange(nodes), (trees, 1))
    cut, right, value = np.zeros(shape), left.copy(), np.zeros(shape)
    share = min(max(y.mean() if len(y) else 1.0, 1e-4), 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
        score = np.full(len(y), base)
        for t in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            level = [(0, np.arange(len(y)), -np.inf, np.inf)]
            free = 1
            for d in range(depth + 1):
                below = []
                for node, rows, low, high in level:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    value[t, node] = rate * np.clip(-gs / (hs + ridge), low, high)
                    found = d < depth and _split(binned[rows], g[rows], h[rows], falling, low, high, ridge, least, bins)
                    if found:
                        k, b, wl, wr = found
                        feature[t, node], cut[t, node] = k, edges[k][b]
                        left[t, node], right[t, node] = free, free + 1
                        goes, middle = binned[rows, k] <= b, (wl + wr) / 2
                        fixed = k in falling
                        below.append((free, rows[goes], middle if fixed else low, high))
                        below.append((free + 1, rows[~goes], low, middle if fixed else high))
                        free += 2
                    else:
                        score[rows] += value[t, node]
                level = below
    return Trees(feature, cut, left, right, value, base, depth)


def _split(binned, g, h, falling, low, high, ridge, least, bins):
    """(feature, bin, left weight, right weight) of the best split, if one gains."""
    best, found = 1e-6, None
    whole = g.sum() ** 2 / (h.sum() + ridge)
    for k in range(binned.shape[1]):
        n = np.cumsum(np.bincount(binned[:, k], minlength=bins))[:-1]
        gl = np.cumsum(np.bincount(binned[:, k], g, bins))[:-1]
        hl = np.cumsum(np.bincount(binned[:, k], h, bins))[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        wl, wr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
        gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - whole
        gain[(n < least) | (len(g) - n < least)] = 0
        if k in falling:
            gain[wr > wl] = 0
        b = int(gain.argmax())
        if gain[b] > best:
            best, found = gain[b], (k, b, wl[b], wr[b])
    return found


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    bounded_batches(docs)
    rows = labelled_documents(docs, labels, sample)

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches):
            shapes = [np.array(statistics(t)[1]).tobytes() for t in strings(piece.column("text"))]
            yield pa.RecordBatch.from_arrays([piece.column("quality").cast(pa.int32()), pa.array(shapes, pa.binary())], ["y", "x"])

    # In one order whatever the tasks' order, so that sums come out the same.
    got = sorted(rows.mapInArrow(task, "y int, x binary").collect(), key=lambda r: (r.y, bytes(r.x)))
    x = np.array([np.frombuffer(r.x) for r in got]).reshape(len(got), len(FEATURES))
    return boost(x, np.array([r.y > 0 for r in got], float), {FEATURES.index(f) for f in FALLING})


def judge(df: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, p_good, kept for each row."""
    bounded_batches(df)
    docs = exact(df, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches):
            found = [statistics(t) for t in strings(piece.column("text"))]
            counts = np.array([c for c, _ in found], np.int64)
            good = trees(np.array([s for _, s in found]))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *[pa.array(c) for c in counts.T], pa.array(good)], ["doc_id", *names, "p_good"])

    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in names) + ", p_good double"
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return docs.mapInArrow(task, schema).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
