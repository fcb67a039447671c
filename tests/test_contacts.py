"""Golden cases for phone and e-mail extraction (FIXTURES.md D4, D6)."""
import pytest

from sparkprep.functions import contacts as C


@pytest.mark.parametrize("text,expected", [
    ("212345678/9", ["212345678", "212345679"]),
    ("+351 212 345 678", ["351212345", "351212678"]),
    ("21 234 5678 ou 912345678", ["212345678", "912345678"]),
    ("123", []),
    ("", []),
    (None, []),
    ("+1 (139) 555-2766", ["+11395552766"]),
])
def test_phone_numbers(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(C.phone_numbers("v")).collect()[0][0] == expected


@pytest.mark.parametrize("text,expected", [
    ("a@x.com b@y.pt", ["a@x.com", "b@y.pt"]),
    ("ANA@mail.pt/rui@b.com", ["ana@mail.pt", "rui@b.com"]),
    ("q@nope z@w.pt k@r.es", ["w.ptk@r.es"]),
    ("none", []),
    ("x@y", []),
    ("José@mail.pt", ["jos@mail.pt"]),
    ("... @x.com", []),
    (None, []),
])
def test_emails(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(C.emails("v")).collect()[0][0] == expected
