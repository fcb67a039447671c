"""Every registered query on the small tables: columns, one row per row, and
results against plain definitions over the whole tables."""
import hashlib
import html
import re
from collections import Counter

import pytest

from sparkprep.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_class_lm import tokens
from tests.llm.test_classifiers import plain_statistics
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_substrings import plain

COLUMNS = {
    "op1_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op2_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op4_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_class_lm": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
                     "base_score": "double", "score": "double"},
    "op6_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op7_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op8_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                    "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op9_toxicity": {"doc_id": "bigint", "toxic": "boolean", "kept": "boolean"},
    "op11_conversation_repair": {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint",
                                 "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string"},
    "op12_sequence_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op13_merkle_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string",
                             "folded_root": "string", "verified": "boolean"},
    "op10_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
}


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    done = {}

    def of(name):
        if name not in done:
            df = QUERIES[name](spark, sf_dir)
            assert COLUMNS[name].items() <= dict(df.dtypes).items()
            done[name] = df.collect()
        return done[name]

    return of


def test_names():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_for_each_row(spark, sf_dir, result, name):
    table, key = {"op3_html_text": ("pages", "page_id"), "op11_conversation_repair": ("conversations", "conv_id")}.get(name, ("documents", "doc_id"))
    ids = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
    want = sorted(r[0] for r in (ids.distinct() if table == "conversations" else ids).collect())
    assert sorted(r[key] for r in result(name)) == want


def test_main_texts(spark, sf_dir, result):
    got = {r.page_id: (r.text, r.n_chars) for r in result("op3_html_text")}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = (re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S) or [None, ""])[1]
        article = re.sub(r"<[^>]*\Z", "", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n\n".join(b for b in blocks if b)
        assert got[r.page_id] == (text, len(text))


def test_fingerprints_and_components(docs, result):
    want = {d: plain_fingerprint(t, 4) for d, t in docs}
    component = plain_components(want, 4)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in result("op7_simhash")} == {
        (d, f"{x:016x}", component[d]) for d, x in want.items()}


def test_removed_windows(docs, result):
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result("op10_substring_dedup"))
    assert got == sorted(plain(docs, 50)) and any(r[2] for r in got)


def test_base_counts(docs, result):
    texts = dict(docs)
    for r in result("op8_quality"):
        if len(texts[r.doc_id] or "") < 4000:  # the plain count is quadratic
            assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == plain_statistics(texts[r.doc_id])


def test_verdicts_agree_with_labels(spark, sf_dir, result):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in result("op8_quality") if r.doc_id in labels and not r.base_failed]
    assert sum(r.kept == (labels[r.doc_id].quality > 0) for r in rows) >= 0.95 * len(rows)
    rows = [r for r in result("op9_toxicity") if r.doc_id in labels]
    assert sum(r.toxic == (labels[r.doc_id].toxic > 0) for r in rows) >= 0.95 * len(rows)


def test_language_model_beats_counts_on_held_out_texts(docs, result):
    texts = dict(docs)
    rows = result("op5_class_lm")
    assert Counter(r.n_tokens for r in rows) == Counter(len(tokens(t)) for t in texts.values())
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_token_digests_round_trip(docs, result):
    texts = dict(docs)
    for r in result("op2_byte_bpe"):
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
