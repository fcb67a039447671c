"""The pipeline against brute force on a small table, stage by stage."""
import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline as P
from sparkprep.llm import mixing, toxicity
from tests.llm.test_simhash import plain_components, plain_fingerprint

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents():
    rnd = random.Random(8)
    vocabulary = ["w%d" % i for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 120))]
        toxic = i % 8 == 0
        if toxic:
            words[3:3] = ["grubby", "vilest"]
        text = " ".join(words)
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        if i < 250:
            labels.append((i, 1, int(toxic)))
    for i in range(400, 460):
        base = rows[rnd.randrange(400)]
        text = base[1] if i % 2 else base[1] + " tail"
        rows.append((i, text, None, base[3], len(text)))
    return rows + [(500, None, None, None, None), (501, "", "en", "s1", 0), (502, "short", "en", "s0", 5)], labels


def test_stages_against_brute_force(spark, tmp_path):
    rows, labels = documents()
    sf = str(tmp_path)
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")

    kept = {r[0]: r for r in rows}
    model = toxicity.train_on_labels(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {d: r for d, r in kept.items() if model.predict([r[1] or ""])[0, 1] < model.threshold}
    assert not any(t and "vilest" in (kept[d][1] or "") for d, _, t in labels if d in kept)
    best = {}
    for d, r in kept.items():
        best[r[1] or ""] = max(d, best.get(r[1] or "", d))
    kept = {d: kept[d] for d in best.values()}
    of = plain_components({d: plain_fingerprint(r[1], 4) for d, r in kept.items()}, 4)
    kept = {d: kept[d] for d in sorted(kept) if of[d] == d}
    plan = {r.doc_id: r.n_copies for r in mixing.mix_plan(spark.createDataFrame(list(kept.values()), SCHEMA)).collect()}
    want = sorted(d for d, n in plan.items() for _ in range(n))

    tiktoken = pytest.importorskip("tiktoken")
    tokenizers = pytest.importorskip("public_tokenizers")
    from sparkprep.llm.byte_bpe import read_ranks
    ranks = {t: i for i, t in enumerate(read_ranks(tokenizers.path("byte_bpe_50k.tiktoken")))}
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = P.run(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == want
    for r in got:
        ids = np.array(library.encode_ordinary(kept[r.doc_id][1] or ""), "<u4").tobytes()
        assert r.n_tokens == len(ids) // 4 and r.ids_sha256 == hashlib.sha256(ids).hexdigest()


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "simhash", "mixing", "byte_bpe"]
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes


def test_stages_on_an_empty_table(spark, tmp_path):
    sf = str(tmp_path)
    docs = spark.createDataFrame([], SCHEMA)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert P.run(spark, sf).collect() == []
