"""Operator 9, toxicity by a classifier chain.

Categories are predicted one after the other by logistic regressions. A later
category gets the probabilities of the earlier ones as features; while it is
trained these come out of fold (each row's from a model that has not seen it),
so that it doesn't learn to trust them more than it can later on.

Training uses a bounded sample of labelled rows: about ``SAMPLE`` rows whose
ids hash lowest. Words and beginnings of words become features if their
presence tells a category apart (chi-squared over the sample, counted by
Spark), ``WORDS`` for each category; five shape figures of a text come along.
The fit runs on the driver over ``SAMPLE`` x features numbers; scoring reads
every text whole, in the tasks.

The labels table names one toxicity category and low quality, so the chain is
``junk`` (quality 0), ``toxic`` (toxic 1) and ``severe``: toxic documents with
at least as many of the category's words as the median toxic document.
A document is rejected if its ``toxic`` probability reaches the threshold that
has the best F1 over the out-of-fold probabilities.

Defined results: null and empty texts have the probabilities of a text without
words; labels without a text, null labels and labels of null ids are not
learned from; a category without both kinds of rows has its base rate as a
constant probability, and nothing is rejected without toxic examples; null ids
and repeated rows are scored like others; an empty table gives no rows; a text of
any length is read whole by one task; further columns are not looked at, but
``drop_toxic`` carries them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import Memo, bounded_batches, capitals, exact, labelled_documents, slices, strings

SAMPLE = 8000
WORDS = 200
FOLDS = 5
RIDGE = 1.0
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6, 7)
#: Words whose features a worker remembers.
REMEMBERED = 300_000
CHAIN = ("junk", "toxic", "severe")


def _words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _marks(word: str) -> list[str]:
    """A word and its beginnings, so that forms not met in training count too."""
    return [word, *[word[:n] + "-" for n in BEGINNINGS if n < len(word)]]


def _shape(text: str, words: list[str]) -> list[float]:
    n, letters = len(words), sum(map(len, words))
    blanks = text.count(" ") + text.count("\n")
    return [np.log1p(n), letters / (n + 1), len(set(words)) / (n + 1),
            (len(text) - letters - blanks) / (len(text) + 1), capitals(text) / (len(text) + 1)]


@dataclass
class Logistic:
    """Logistic regression with a ridge, by Newton steps."""

    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, steps: int = 6) -> "Logistic":
        x = np.c_[x, np.ones(len(x), x.dtype)]
        w = np.zeros(x.shape[1])
        if not len(y) or y.min() == y.max():
            w[-1] = -20.0 if not len(y) or not y.max() else 20.0
            return cls(w)
        ridge = np.full(len(w), RIDGE)
        ridge[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            w -= np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        return cls(w)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


_KNOWN: dict[tuple, Memo] = {}


@dataclass
class Chain:
    """The models of the categories in order, and the words and scales of their features."""

    names: tuple[str, ...]
    vocabulary: dict[str, int]
    centre: np.ndarray
    scale: np.ndarray
    models: list[Logistic] = field(default_factory=list)
    threshold: float = 2.0

    def features(self, texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.vocabulary) + 5))
        key = tuple(self.vocabulary)
        if key not in _KNOWN:
            _KNOWN.clear()  # a worker scores by one model at a time
            _KNOWN[key] = Memo(REMEMBERED)
        known = _KNOWN[key]
        for i, t in enumerate(texts):
            words = _words(t)
            x[i, -5:] = _shape(t, words)
            each = set(words)
            new = [w for w in each if w not in known]
            if known.full(len(new)):
                new = each
            for w in new:
                known[w] = tuple(self.vocabulary[m] for m in _marks(w) if m in self.vocabulary)
            x[i, list(chain.from_iterable(map(known.__getitem__, each)))] = 1.0
        return x

    def fit(self, x: np.ndarray, y: np.ndarray, fold: np.ndarray, decide: int) -> None:
        x = x.copy()
        x[:, -5:] = (x[:, -5:] - self.centre) / self.scale
        for k in range(y.shape[1]):
            out = np.zeros(len(x))
            for f in range(FOLDS):
                if (fold == f).any():
                    out[fold == f] = Logistic.fit(x[fold != f], y[fold != f, k])(x[fold == f])
            self.models.append(Logistic.fit(x, y[:, k]))
            if k == decide:
                self.threshold = best_threshold(out, y[:, k])
            x = np.c_[x, out]

    def predict(self, texts: list[str]) -> np.ndarray:
        x = self.features(texts)
        x[:, -5:] = (x[:, -5:] - self.centre) / self.scale
        first = x.shape[1]
        for model in self.models:
            x = np.c_[x, model(x)]
        return x[:, first:]


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Midway between the scores around the cut with the best F1; above 1 without positives."""
    if not y.any():
        return 2.0
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    last = np.r_[p[:-1] != p[1:], True]
    f1 = np.where(last, 2 * hits / (np.arange(1, len(p) + 1) + y.sum()), -1)
    k = int(f1.argmax())
    return float((p[k] + (p[k + 1] if k + 1 < len(p) else 0.0)) / 2)


def select_words(sample: DataFrame, labels: list[str], per_label: int = WORDS) -> list[str]:
    """Words whose presence tells a label apart, counted over the sample's documents."""

    def count(batches):
        import pyarrow as pa
        from collections import defaultdict

        table = defaultdict(lambda: [0] * (len(labels) + 1))
        for piece in slices(batches):
            marks = list(zip(*[piece.column(c).to_pylist() for c in labels]))
            for text, mark in zip(strings(piece.column("text")), marks):
                for w in {m for w in set(_words(text)) for m in _marks(w)}:
                    row = table[w]
                    row[0] += 1
                    for k, m in enumerate(mark):
                        row[k + 1] += m
        names = ["word", "n", *labels]
        for i in range(0, len(table), 50_000):
            part = list(table.items())[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in part]), *[pa.array([r[k] for _, r in part], pa.int64()) for k in range(len(names) - 1)]], names)

    schema = "word string, n bigint, " + ", ".join(f"{c} bigint" for c in labels)
    counts = sample.mapInArrow(count, schema).groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", *labels)])
    counts = materialize(counts.where("n >= 3"))
    total = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in labels]).first()
    found: dict[str, None] = {}
    for c in labels:
        n, t = float(total["n"] or 0), float(total[c] or 0)
        if not 0 < t < n:
            continue
        excess = F.col(c) - F.col("n") * (t / n)
        chi = excess * excess / (F.col("n") * (t / n) * (1 - t / n) * (1 - F.col("n") / n) + F.lit(1e-9))
        for r in counts.orderBy(chi.desc(), "word").limit(per_label).collect():
            found.setdefault(r["word"])
    return list(found)


def train(labelled: DataFrame, junk: Column, toxic: Column, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """``labelled`` has an id, a text and what the two conditions need; all of it is learned from."""
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                           junk.cast("int").alias("junk"), toxic.cast("int").alias("toxic"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL AND junk IS NOT NULL AND toxic IS NOT NULL")
    bounded_batches(labelled)
    rows = materialize(rows)
    words = select_words(rows, ["junk", "toxic"])
    model = Chain(CHAIN, {w: i for i, w in enumerate(words)}, np.zeros(5), np.ones(5))

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches):
            x = model.features(strings(piece.column("text")))
            rows_ = [v.astype("<f4").tobytes() for v in x]
            yield pa.RecordBatch.from_arrays([piece.column(c) for c in ("fold", "junk", "toxic")] + [pa.array(rows_, pa.binary())],
                                             ["fold", "junk", "toxic", "x"])

    got = rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int"))
    got = got.mapInArrow(task, "fold int, junk int, toxic int, x binary").collect()
    # In one order whatever the tasks' order, so that sums come out the same.
    got.sort(key=lambda r: (r.fold, r.junk, r.toxic, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, "<f4") for r in got], np.float64).reshape(len(got), len(words) + 5)
    fold = np.array([r.fold for r in got], int)
    y = np.array([(r.junk, r.toxic) for r in got], float).reshape(len(got), 2)
    if len(got):
        model.centre, model.scale = x[:, -5:].mean(0), x[:, -5:].std(0) + 1e-9
    # Words of the category: those that toxic documents have more often than others.
    hits = np.zeros(len(got))
    if 0 < y[:, 1].sum() < len(got):
        more = x[y[:, 1] == 1, :-5].mean(0) > 4 * x[y[:, 1] == 0, :-5].mean(0) + 0.02
        hits = x[:, :-5][:, more].sum(1)
    severe = (y[:, 1] == 1) & (hits >= max(1.0, np.median(hits[y[:, 1] == 1]) if y[:, 1].any() else 1.0))
    model.fit(x, np.c_[y, severe.astype(float)], fold, decide=1)
    return model


def score(df: DataFrame, model: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a probability for each category, toxic, kept."""
    bounded_batches(df)
    docs = exact(df, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches):
            p = model.predict(strings(piece.column("text")))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *[pa.array(v) for v in p.T]],
                                             ["doc_id", *[f"p_{c}" for c in model.names]])

    schema = f"doc_id {kind}, " + ", ".join(f"p_{c} double" for c in model.names)
    bad = F.col("p_toxic") >= model.threshold
    return docs.mapInArrow(task, schema).withColumns({"toxic": bad, "kept": ~bad})


def drop_toxic(df: DataFrame, model: Chain, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with their columns; each text is scored where its row is."""
    bounded_batches(df)
    place, cols = df.columns.index(text_col), df.columns
    flat = df.toDF(*[f"c{k}" for k in range(len(cols))])
    toxic = CHAIN.index("toxic")

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches, text_col=f"c{place}"):
            p = model.predict(strings(piece.column(place)))[:, toxic]
            yield piece.filter(pa.array(p < model.threshold))

    return flat.mapInArrow(task, flat.schema).toDF(*cols)


def train_on_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    return train(labelled_documents(docs, labels, sample), F.col("quality") == 0, F.col("toxic") == 1)
