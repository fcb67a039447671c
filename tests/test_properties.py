"""
found has at least 9 digits, C1 agrees with a plain-Python model, and the
phone/e-mail folds agree with the brute-force models on random text."""
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkprep.functions import contacts as C
from sparkprep.functions import text as T
from sparkprep.operators import lines as L
from tests import bruteforce as B

ALPHABET = st.sampled_from(list("ab9 0123456789;\"@.-/+,:ÇçãéNnoe\tx") + [".com", ".pt", "nan", "none", "@m.pt "])
TEXTS = st.lists(st.lists(ALPHABET, max_size=25).map("".join), min_size=1, max_size=40)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@given(st.lists(st.text(max_size=12), min_size=1, max_size=8))
@settings(max_examples=50, deadline=None)
def test_names_idempotent(names):
    once = [T.standardize_name(n) for n in names]
    assert [T.standardize_name(n) for n in once] == once


@given(TEXTS)
@SETTINGS
def test_folds_match_models(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = df.orderBy("i").select(C.phone_numbers("v").alias("p"), C.emails("v").alias("e"),
                                 T.clean_string("v").alias("s")).collect()
    for t, r in zip(texts, got):
        assert r.p == B.phones(t)
        assert all(len(n.lstrip("+")) >= 9 for n in r.p)
        assert r.e == B.emails(t)
        model = re.sub(r"[^\w]", "", t.replace(" ", "").lower().replace("nan", "").replace("none", ""))
        assert r.s == model


@given(TEXTS)
@SETTINGS
def test_quote_repair_idempotent(spark, texts):
    df = spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "line_no long, line string")
    once = L.repair_quoted_delimiters(df)
    twice = L.repair_quoted_delimiters(once)
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    assert [r[1] for r in sorted(a)] == [B.repair_quotes(t, ";", '"') for t in texts]
