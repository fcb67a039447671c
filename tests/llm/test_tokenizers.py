import hashlib
import random

import numpy as np
import pytest

from sparkprep.llm import byte_bpe, token_counts

P = pytest.importorskip("public_tokenizers")
RANKS, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string"


def texts():
    rnd = random.Random(4)
    odd = "abc  the\n\t's'llé1²日.,!0<|>\r\v\f\x85\xa0　▁{}();-_= \U0001F600́ﬁ"
    out = ["".join(rnd.choice(odd) for _ in range(rnd.randint(0, 200))) for _ in range(400)]
    return out + ["", " ", "  ", "\n", "a\n\nb", "word,\nWord", "it's we'll", "<|endoftext|> <s> </s>", "a" * 9000, "ab" * 6000,
                  "日本語" * 1500, " lead", "trail ", "x\x00y", "." * 5000, "aé" * 2100]


def test_perfect_hash_is_minimal_and_perfect():
    keys = [b"k%d" % i for i in range(5000)]
    h = byte_bpe.PerfectHash(keys)
    assert [h(k) for k in keys] == list(range(5000)) and sorted(h.slot) == list(range(5000))
    assert byte_bpe.PerfectHash([b"one"])(b"one") == 0


def test_encoding_as_the_library(spark, sf_dir):
    import tiktoken

    tokens = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (3, "again"), (3, "again")]
    rows += [(10_000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {}
    for d, t in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want.setdefault(d, []).append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = {}
    for r in byte_bpe.round_trip(df, RANKS, P.PATTERN).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}


def test_encode_then_decode(spark):
    df = spark.createDataFrame(list(enumerate(texts())), SCHEMA)
    ids = byte_bpe.encode_documents(df, RANKS, P.PATTERN)
    back = {r.doc_id: r.text for r in byte_bpe.decode_documents(ids, RANKS, P.PATTERN).collect()}
    assert back == dict(enumerate(texts()))


def test_small_memory_gives_the_same():
    tokens = byte_bpe.read_ranks(RANKS)
    codec = byte_bpe.Codec(tokens, byte_bpe.PerfectHash(tokens), P.PATTERN)
    want = [codec.encode(t) for t in texts()]
    codec.plain.remembered = 10
    assert [codec.encode(t) for t in texts()] == want


def test_another_pattern_takes_no_shortcut():
    import tiktoken

    pattern = r"\p{L}+|\s+|[^\s\p{L}]+"
    tokens = byte_bpe.read_ranks(RANKS)
    codec = byte_bpe.Codec(tokens, byte_bpe.PerfectHash(tokens), pattern)
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    for t in ["in the house", "a b\nc d. e", " x  y\n\nz "]:
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == other.encode_ordinary(t)


def test_counts_as_the_library(spark, sf_dir):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (3, "again"), (3, "again"), (77, "word " * 5000)]
    rows += [(10_000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want, got = {}, {}
    for d, t in rows:
        n = len(sp.encode(t or ""))
        want.setdefault(d, []).append((len((t or "").encode()), n, n > 4096))
    for r in token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), PIECES).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_tokens, r.over_limit))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}


def test_long_sequences_in_rounds_and_alone():
    merger = token_counts.Merger(token_counts.read_model(PIECES))
    rnd = random.Random(9)
    units = ["▁" + "".join(rnd.choice("abcdefet hin.é") for _ in range(n)).replace(" ", "") for n in (1, 5, 50, 700, 3000)]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [len(sp.encode(u[1:])) for u in units]
    assert merger.counts(units).tolist() == want
    points = [np.frombuffer(u.encode("utf-32-le"), np.uint32) for u in units]
    extra = [np.where(merger.known[p], 0, (p > 0x7F).astype(int) + (p > 0x7FF) + (p > 0xFFFF)) for p in points]
    assert [merger._long(merger.of_char[p], e) for p, e in zip(points, extra)] == want


def test_empty_tables_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.round_trip(empty, RANKS, P.PATTERN).collect() == []
    assert token_counts.count_tokens(empty, PIECES).collect() == []
    df = spark.createDataFrame([(1, "a b", 5, "z")], "doc_id bigint, text string, n_tokens int, TEXT string")
    assert byte_bpe.round_trip(df, RANKS, P.PATTERN).first().n_tokens == 2
    assert token_counts.count_tokens(df, PIECES).first().n_tokens == 2
