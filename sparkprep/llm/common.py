"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: White space of the word rule: blank and \t \n \v \f \r (also what ``bytes.split()`` splits on).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exact(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """The named columns only, taken by exact spelling: a further column
    whose name differs only in case can't make a reference ambiguous.
    ``renamed`` maps an output name to an input name."""
    want = [(n, n) for n in names] + list(renamed.items())
    cols = df.columns
    missing = [n for _, n in want if n not in cols]
    if missing:
        raise ValueError(f"missing columns {missing}; have {cols}")
    by_place = df.toDF(*[f"__c{i}" for i in range(len(cols))])
    return by_place.select(*[F.col(f"__c{cols.index(n)}").alias(o) for o, n in want])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def spread(hash_of: Column, n: int) -> Column:
    """A number from 0 to n - 1 that depends on the value alone."""
    return F.pmod(F.xxhash64(hash_of), F.lit(n)).cast("int")


def texts(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def labelled_documents(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, quality, toxic), one row an id, of a sample of the labels: of N labelled
    ids those whose hash is in the lowest ``sample / N`` of all hashes, so
    about ``sample`` (all, if there are fewer), the same ones in every run, and
    without a sort. The sampled side is what is broadcast. A document labelled
    twice is toxic if one label says so, and of the lower quality; of rows that
    repeat an id the least text counts, so the rows are no more than the ids;
    labels without a document, null labels and null ids are left out."""
    rows = exact(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    each = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    n = max(1, rows.agg(F.approx_count_distinct("doc_id", 0.01)).first()[0])
    share = F.lit(int(2**31 * min(1.0, sample / n)) if n > sample else 2**31)
    chosen = materialize(each.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < share))
    found = exact(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")
    return found.groupBy("doc_id", "toxic", "quality").agg(F.min("text").alias("text")).select("doc_id", "toxic", "quality", "text")


#: Text that goes to a Python worker in one Arrow batch.
BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> None:
    """Has the session cut Arrow batches by bytes: ten thousand rows, Spark's
    own measure, are too much memory where texts are long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    if conf.get(key) != str(BATCH_BYTES):
        conf.set(key, str(BATCH_BYTES))


def slices(batches, max_bytes: int = 4 << 20, text_col: str = "text"):
    """Arrow record batches cut into pieces of about ``max_bytes`` of text, so
    that what a task holds beside a batch stays small."""
    import pyarrow.compute as pc

    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(size):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(size):
            yield batch.slice(start)


_ASCII_OTHERS = bytes(c for c in range(128) if not 65 <= c <= 90)


def capitals(text: str) -> int:
    """Upper case letters among all characters of a text."""
    if text.isascii():
        return len(text.encode().translate(None, _ASCII_OTHERS))
    return sum(map(str.isupper, text))


class Memo(dict):
    """A bounded table of results by key; emptied when full."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def full(self, new: int) -> bool:
        """Empties the table if ``new`` more entries don't fit; says so."""
        if len(self) + new <= self.most:
            return False
        self.clear()
        return True


def strings(column) -> list[str]:
    """An Arrow string column as Python strings, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]
