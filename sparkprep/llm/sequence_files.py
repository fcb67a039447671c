"""Token ids as Arrow files of equal-length sequences (operator 12).

``write_sequences`` encodes documents in ascending order of their ids, each
followed by an end id, and packs the ids one after the other into sequences of
``length`` ids. A file is an Arrow IPC file: batches of ``BATCH`` sequences with

* ``ids``: fixed-size list of unsigned integers (16 bits if all ids fit),
* ``mask``: fixed-size list of bits, true for an id, false for the padding that
  fills a file's last sequence,
* ``docs``: the documents that begin in the sequence, as (doc_id, place of the
  first id in the file).

All buffers are uncompressed and every batch but a file's last has the same
size, so ``SequenceFile`` maps a file and gives the i-th sequence and mask as
views on the map, without reading or copying others. A file ends with a
document once it has ``file_ids`` ids, so documents are never cut.

On Spark: the documents are sorted by range (the row's own place breaks ties,
so copies of one id in any number are split over tasks); a task holds one file
and one document at a time. Files go through Spark's text source, one value a
file, so they are committed with the job on any file system: it writes a value
and then the line separator, which here is the closing mark of Arrow files.

Results for the cases at the edge: a null text is empty and gives the end id
alone; null ids come first; equal ids are ordered by a hash of their text;
repeated rows are encoded each; very long texts go to the library in pieces (see
``Encoder``); an empty table gives no file
with sequences and no rows; further columns are not looked at."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from array import array
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Memo, bounded_batches, exact, slices, strings
from .pieces import RUN, PieceTable

LENGTH = 2048
FILE_IDS = 1 << 22
#: Sequences of a batch.
BATCH = 256
#: Text that a task encodes at once.
PIECE_BYTES = 1 << 23
LONG_TEXT = 1 << 20
LONG_PIECE = 1 << 18
#: Fixed value: what an Arrow file ends with.
CLOSING = "ARROW1"

_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")
_WORD = re.compile(r" \S+")
#: A blank within or at the end of a run of white space.
_BLANK_IN_RUN = re.compile(r"\s (?:\s|\Z)")


class Encoder:
    """The library's ids of texts, from its ids of their pieces.

    The byte-level pattern begins a pre-token at a blank or line feed that stands
    between two other characters, and at the last blank of a run of white space;
    merges don't cross pre-tokens. So a text is cut there, and the library
    encodes each distinct piece once for as long as a worker remembers it. A text
    with a blank elsewhere in a run is encoded whole, as all texts are if the
    tokenizer isn't of this kind. A long one is then still cut, before blanks
    between two visible characters, as an encoding takes some hundred bytes an id."""

    def __init__(self, definition: str, id_type: str, remembered: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        told = json.loads(definition)
        before = told.get("pre_tokenizer") or {}
        self.cuts = (told.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not before.get("add_prefix_space") and told.get("truncation") is None and told.get("padding") is None
                     and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                                 for t in told.get("added_tokens", [])))
        self.id_type, self.code = id_type, {"<u2": "H", "<u4": "I"}[id_type]
        if self.cuts:
            # A byte-level token has a character for each byte.
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.sizes = np.zeros(max(vocabulary.values()) + 2, np.int64)
            for token, i in vocabulary.items():
                self.sizes[i] = len(token)
        self.added = [t["content"] for t in told.get("added_tokens", [])]
        self.plain, self.known = PieceTable(self._encode, id_type, remembered), Memo(remembered // 4)
        self.marks = dict(zip(".,;:!?", self._library(list(".,;:!?"))))

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of words with a blank before them, as one text for the
        library; a token's bytes tell where the words end."""
        out = []
        for at in range(0, len(words), 1024):
            some = words[at:at + 1024]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, self.id_type)
            ends = np.cumsum([len(w.encode()) for w in some])
            ends = (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1).tolist()
            out += [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]
        return out

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of these distinct pieces."""
        new = set(pieces).difference(self.known)
        if self.known.full(len(new)):
            new = set(pieces)
        new = list(new)
        self.known.update(zip(new, self._encode(new) if self.cuts else self._library(new)))
        out = [self.known[p] for p in pieces]
        for p in new:
            if len(p) > 256:
                del self.known[p]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian integers of ``id_type``."""
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if self.cuts and not RUN.search(t)]
        for i, ids in zip(plain, self.plain([texts[i] for i in plain])):
            out[i] = ids
        parts = {}
        for i, t in enumerate(texts):
            if out[i] is None:
                if self.cuts and not _BLANK_IN_RUN.search(t):
                    head, *rest = t.split(" ")
                    parts[i] = [head, *(" " + p for p in rest)]
                else:
                    parts[i] = list(_pieces(t)) if self.cuts else [t]
        every = list(set().union(*parts.values()))
        known = dict(zip(every, self._ids(every)))
        for i, ps in parts.items():
            out[i] = b"".join(map(known.__getitem__, ps))
        return out

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces. A mark after a letter or digit is a
        pre-token of its own, so marked words cost no more than the words."""
        stems = {p: p[:-1] for p in pieces if p[-1:] in self.marks and p[-2:-1].isalnum()}
        every = [*{p for p in pieces if p not in stems} | set(stems.values())]
        words = [p for p in every if _WORD.fullmatch(p) and not any(t in p for t in self.added)]
        found = dict(zip(words, self._words(words)))
        rest = [p for p in every if p not in found]
        found.update(zip(rest, self._library(rest)))
        return [found[stems[p]] + self.marks[p[-1]] if p in stems else found[p] for p in pieces]


def _pieces(text: str):
    """A long text cut where a pre-token always begins; others whole."""
    start = 0
    while len(text) - start > LONG_TEXT:
        cut = _CUT.search(text, start + LONG_PIECE)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(definition: str, id_type: str) -> Encoder:
    """A worker's encoder, found by what the tokenizer is, not by its path."""
    key = (hashlib.sha256(definition.encode()).digest(), id_type)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition, id_type)
    return _ENCODERS[key]


def _file(ids: list[np.ndarray], doc_ids: list, doc_type, id_type, length: int, range_no: int, file_no: int) -> bytes:
    """One Arrow file, but for its closing mark."""
    import pyarrow as pa

    sizes = np.fromiter(map(len, ids), "<i8", len(ids))
    places = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    rows = -(-total // length)
    flat = np.zeros(rows * length, id_type)
    np.concatenate(ids, out=flat[:total], casting="unsafe")
    mask = pa.array(np.arange(rows * length) < total)
    first = np.searchsorted(places, np.arange(rows + 1) * length).astype("i4")
    docs = pa.ListArray.from_arrays(pa.array(first), pa.StructArray.from_arrays(
        [pa.array(doc_ids, doc_type), pa.array(places)], ["doc_id", "place"]))
    batch = pa.RecordBatch.from_arrays(
        [pa.FixedSizeListArray.from_arrays(pa.array(flat), length), pa.FixedSizeListArray.from_arrays(mask, length), docs],
        ["ids", "mask", "docs"])
    batch = batch.replace_schema_metadata({"range": str(range_no), "file": str(file_no)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, batch.schema) as writer:
        for at in range(0, rows, BATCH):
            writer.write_batch(batch.slice(at, BATCH))
    return sink.getvalue().to_pybytes()[:-len(CLOSING)]


class SequenceFile:
    """Random access to a file's sequences, from a path (mapped) or its bytes."""

    def __init__(self, source):
        import pyarrow as pa

        self._file = pa.ipc.open_file(pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source))
        schema = self._file.schema
        self.length = schema.field("ids").type.list_size
        self.range_no, self.file_no = int(schema.metadata[b"range"]), int(schema.metadata[b"file"])
        self._batches = self._file.num_record_batches
        last = self._file.get_batch(self._batches - 1).num_rows if self._batches else 0
        self._len = max(0, self._batches - 1) * BATCH + last

    def __len__(self) -> int:
        return self._len

    def __getitem__(self, i: int):
        """Ids (a numpy array) and mask (an Arrow array of bits) of the i-th
        sequence, both views on the file."""
        if not -self._len <= i < self._len:
            raise IndexError(i)
        batch, row = divmod(i % self._len, BATCH)
        ids, mask = (self._file.get_batch(batch).column(c).flatten().slice(row * self.length, self.length) for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def documents(self):
        """(doc_id, place, ids) of every document, in order. A document that
        lies in one batch is a view on the file."""
        held, begun = [], None
        for b in range(self._batches):
            ids, mask = (self._file.get_batch(b).column(c).flatten() for c in (0, 1))
            ids = ids.to_numpy(zero_copy_only=True)[:mask.true_count]
            base = b * BATCH * self.length
            docs = self._file.get_batch(b).column(2).flatten()
            keys, places = docs.field("doc_id").to_pylist(), docs.field("place").to_pylist()
            cuts = [p - base for p in places]
            held.append(ids[:cuts[0]] if cuts else ids)
            if cuts:
                if begun is not None:
                    yield (*begun, np.concatenate(held))
                for k, p, at, end in zip(keys, places, cuts, cuts[1:]):
                    yield k, p, ids[at:end]
                begun, held = (keys[-1], places[-1]), [ids[cuts[-1]:]]
        if begun is not None:
            yield (*begun, np.concatenate(held))


def write_sequences(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, length: int = LENGTH,
                    file_ids: int = FILE_IDS, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes the sequences of ``df`` as files in the new folder ``path``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    bounded_batches(df)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    most = max(_encoder(definition, "<u4").tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
    id_type = "<u2" if most <= 1 << 16 else "<u4"
    shared = df.sparkSession.sparkContext.broadcast(definition)
    rows = exact(df, doc_id=id_col, text=text_col)
    doc_type = to_arrow_type(rows.schema["doc_id"].dataType)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64(F.coalesce("text", F.lit(""))), F.col("__tie")]
    rows = rows.withColumn("__tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def task(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(shared.value, id_type)
        no, part = 0, TaskContext.get().partitionId()
        end = np.array([end_id], id_type).tobytes()
        ids, doc_ids, held = [], [], 0

        def closed():
            one = _file(ids, doc_ids, doc_type, id_type, length, part, no)
            return pa.RecordBatch.from_arrays([pa.array([one], pa.binary())], ["value"])

        for piece in slices(batches, PIECE_BYTES):
            for key, own in zip(piece.column("doc_id").to_pylist(), encoder.encode(strings(piece.column("text")))):
                ids.append(np.frombuffer(own + end, id_type))
                doc_ids.append(key)
                held += len(ids[-1])
                if held >= file_ids:
                    yield closed()
                    ids, doc_ids, held, no = [], [], 0, no + 1
        if ids:
            yield closed()

    files = rows.mapInArrow(task, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.options(lineSep=CLOSING, maxRecordsPerFile=1, compression="none").text(path)
    return path


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files in ``path``: doc_id, the range and file it is
    in, its place there, n_tokens, and ids_crc32 (over the ids as
    little-endian unsigned 32-bit integers). One file at a time is in a task."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_type

    found = spark.read.format("binaryFile").load(path).where("length > 0")
    doc_type = _doc_type(found)
    if doc_type is None:
        return spark.createDataFrame([], "doc_id bigint, range int, file int, place bigint, n_tokens bigint, ids_crc32 bigint")
    bounded_batches(found)
    names = ["doc_id", "range", "file", "place", "n_tokens", "ids_crc32"]
    types = [doc_type, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def task(batches):
        for batch in batches:
            for content in batch.column("content"):
                file = SequenceFile(content.as_buffer())
                each = ((k, file.range_no, file.file_no, p, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for k, p, ids in file.documents())
                while some := list(islice(each, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names)

    schema = f"doc_id {from_arrow_type(doc_type).simpleString()}, range int, file int, place bigint, n_tokens bigint, ids_crc32 bigint"
    return found.select("content").mapInArrow(task, schema)


def _doc_type(found: DataFrame):
    """The Arrow type of the ids of documents, as a first file has it at its begin."""
    import pyarrow as pa

    first = found.select(F.substring("content", 1, 1 << 16)).head(1)
    if not first:
        return None
    # Eight bytes open an Arrow file; its schema follows.
    return pa.ipc.read_schema(pa.py_buffer(bytes(first[0][0])[8:])).field("docs").type.value_type.field("doc_id").type


def with_starts(documents: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before: places are added up
    over the files of a range, and over the ranges (a row for each)."""
    files = documents.groupBy("range", "file").agg(F.sum("n_tokens").alias("n"))
    in_range = Window.partitionBy("range").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    in_all = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = files.groupBy("range").agg(F.sum("n").alias("n"))
    ranges = ranges.select("range", F.coalesce(F.sum("n").over(in_all), F.lit(0)).alias("__range"))
    files = files.select("range", "file", F.coalesce(F.sum("n").over(in_range), F.lit(0)).alias("__file")).join(ranges, "range")
    out = documents.join(files, ["range", "file"])
    return out.withColumn("start", F.col("__range") + F.col("__file") + F.col("place")).drop("__range", "__file")
