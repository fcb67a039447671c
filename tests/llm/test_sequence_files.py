"""Sequence files against the tokenizers library and Arrow's own reader."""
import glob
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkprep.llm import sequence_files as S
from sparkprep.llm.queries import QUERIES
from sparkprep.session import work_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string"


def plain(rows):
    tok = Tokenizer.from_file(PATH)
    out, start = [], 0
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, rows, **how):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, SCHEMA)
    return S.write_sequences(df, work_path(spark, "t", unique=True), PATH, **how)


def read(spark, path):
    df = S.with_starts(S.read_documents(spark, path))
    return sorted([tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()], key=lambda r: r[1])


ROWS = [(i, f"Text {i} " * (i % 40) + "é<|endoftext|>!") for i in range(-20, 300)] + [(400, ""), (401, None), (402, "x" * 5000), (403, "word " * 20_000)]


@pytest.mark.parametrize("length,file_ids", [(8, 100), (2048, 1 << 22), (7, 1)])
def test_round_trip(spark, length, file_ids):
    path = written(spark, ROWS[::-1], length=length, file_ids=file_ids)
    assert read(spark, path) == plain(ROWS)


def test_files_are_arrow_files_with_equal_sequences(spark):
    path = written(spark, ROWS, length=16, file_ids=1000)
    names = [n for n in sorted(glob.glob(f"{path}/part-*")) if open(n, "rb").read(1)]
    assert len(names) > 2
    files = [S.SequenceFile(n) for n in names]
    everything = []
    for name, file in zip(names, files):
        with pa.memory_map(name) as m:
            table = pa.ipc.open_file(m).read_all()
            assert table.schema.field("ids").type == pa.list_(pa.uint16(), 16) and table.num_rows == len(file)
            flat, mask = table["ids"].to_pylist(), table["mask"].to_pylist()
        ids = [i for row, keep in zip(flat, mask) for i, k in zip(row, keep) if k]
        assert all(k for row in mask[:-1] for k in row)
        for i in range(len(file)):
            own, kept = file[i]
            assert own.tolist() == flat[i] and kept.to_pylist() == mask[i] and not own.flags.owndata
        assert [t for _, _, d in file.documents() for t in d.tolist()] == ids
        with pytest.raises(IndexError):
            file[len(file)]
        everything += ids
    tok = Tokenizer.from_file(PATH)
    assert everything == [i for _, t in ROWS for i in tok.encode(t or "", add_special_tokens=False).ids + [0]]


TEXTS = ["it's a  b   c d'll e.f 12 34 5,6 " * 30, "x" * 400, " \n a b\n\n c" * 40, "é è ü a<|endoftext|> b " * 20, "a b" * 100, "", " ", "\n", "a ",
         " a", "a\nb", "a \nb", "a\n b", "a\x1c b", "a\x1c  b", "a\u3000 b \u3000c", "a\n\nb c", "\ta b\r\n c", "<|endoftext|>", "a <|endoftext|>\nb"]


def encoder(**kw):
    with open(PATH, encoding="utf-8") as f:
        return S.Encoder(f.read(), "<u4", **kw)


def same(e, texts):
    want = [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == want


def test_pieces_join_to_what_the_library_gives(monkeypatch):
    rng = random.Random(3)
    signs = ["a", "Word", "é", " ", " ", " ", "\n", "\n", "\t", "  ", "'s", "12", "!?", "\u3000", "\x1c", "\x85", "<|endoftext|>", "日本"]
    e = encoder(remembered=500)
    same(e, TEXTS)
    for _ in range(40):
        same(e, ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(50)])
    # Long texts that the library would get whole are cut.
    monkeypatch.setattr(S, "LONG_TEXT", 50)
    monkeypatch.setattr(S, "LONG_PIECE", 11)
    same(e, TEXTS)
    assert all("".join(S._pieces(t)) == t for t in TEXTS) and len(list(S._pieces(TEXTS[0]))) > 5


def test_other_tokenizers_get_whole_texts():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        e = S.Encoder(f.read(), "<u4")
    assert not e.cuts
    same(e, TEXTS)


def test_ties_nulls_and_hot_ids(spark):
    rows = [(None, "n"), (None, None), (5, "b c"), (5, "a"), (5, "a")] + [(9, "hot copy")] * 500 + [(10, "last")]
    got = read(spark, written(spark, rows, length=4, file_ids=50))
    assert sorted(map(str, ((d, n, c) for d, _, n, c in got))) == sorted(map(str, ((d, n, c) for d, _, n, c in plain(rows))))
    assert [d for d, *_ in got] == [d for d, _ in rows]
    assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:]))


def test_empty_table_and_other_columns(spark):
    assert read(spark, written(spark, spark.createDataFrame([], SCHEMA))) == []
    df = spark.createDataFrame([("b", "two", "x", 1), ("a", "one", "y", 2)], "doc_id string, text string, TEXT string, place int")
    assert [r[0] for r in read(spark, written(spark, df))] == ["a", "b"]


def test_query(spark, sf_dir):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    result = QUERIES["op12_sequence_files"](spark, sf_dir)
    assert result.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted([tuple(r) for r in result.collect()], key=lambda r: r[1]) == plain(rows)
