"""T4 parity of PII normalisation and hashing with Python; T6 failure paths."""

import hashlib
import hmac
import re

import pytest
from pyspark.sql import functions as F

from shoplens.functions.pii import PiiHasher, normalize_email, normalize_phone
from shoplens.operators.pii import PII_POLICY, protect, rewrite_path

VALUES = ["a@b.ru", " A@B.RU ", "", "Иван@Почта.РФ", "\t x@y.z ", "　q@w.e ",
          "\x1cx@y\x1f", "8 (916) 123-45-67", "+7 916 123 45 67", "9161234567", "٣٤٥", "8٩١٦١٢٣٤٥٦٧",
          "x" * 300]


def py_phone(v):
    d = re.sub(r"\D+", "", v)
    return "7" + d[1:] if len(d) == 11 and d.startswith("8") else d


def _values_df(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def test_normalize_email_matches_python_strip_lower(spark):
    ws = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    vals = VALUES + [ws + "MiXeD@Case.Org" + ws]
    got = dict(_values_df(spark, vals).select("i", normalize_email(F.col("v")).alias("n")).collect())
    for i, v in enumerate(vals):
        assert got[i] == v.strip().lower(), repr(v)


def test_normalize_phone_matches_python_regex(spark):
    got = dict(_values_df(spark, VALUES).select("i", normalize_phone(F.col("v")).alias("n")).collect())
    for i, v in enumerate(VALUES):
        assert got[i] == py_phone(v), repr(v)


@pytest.mark.parametrize("salt", [b"salt", b"", b"k" * 64, b"long-key-" * 12, "соль".encode()])
@pytest.mark.parametrize("algo", ["hmac_sha256", "md5"])
def test_hash_matches_python(spark, salt, algo):
    if not salt:
        with pytest.raises(ValueError):
            PiiHasher(salt, algo)
        return
    h = PiiHasher(salt, algo)
    got = dict(_values_df(spark, VALUES + [None]).select("i", h.hash(F.col("v")).alias("h")).collect())
    for i, v in enumerate(VALUES):
        if algo == "md5":
            want = hashlib.md5(salt + v.encode()).hexdigest()
        else:
            want = hmac.new(salt, v.encode(), hashlib.sha256).hexdigest()
        assert got[i] == want, repr(v)
    assert got[len(VALUES)] is None


def test_hand_worked_hmac_values(spark):
    h = PiiHasher.from_text("salt")
    df = _values_df(spark, ["a@b.ru", " A@B.RU ", "", None, "8 (916) 123-45-67", "+7 916 123 45 67"])
    r = dict(df.select("i", F.when(F.col("i") < 4, h.email(F.col("v"))).otherwise(h.phone(F.col("v")))).collect())
    assert r[0] == r[1] == "e6cc5f4c3b9698a30c0b0b1a877754dc506ca9cab63cc44709fc447d6fab5c38"
    assert r[2] == "379d7f7966f400cb6e3c0b2cca4bf8a2db03b8c81fef8020015b5a3103c30460"
    assert r[3] is None
    assert r[4] == r[5]


def test_unknown_algorithm_and_missing_salt_fail():
    with pytest.raises(ValueError):
        PiiHasher.from_text("s", "sha1")
    with pytest.raises(ValueError):
        PiiHasher.from_text("", "md5")
    assert "s3cret" not in repr(PiiHasher.from_text("s3cret"))


def test_nested_rewrite_keeps_nulls_and_ignores_missing_paths(spark):
    df = spark.createDataFrame(
        [(1, ("A@B.RU", "8 (916) 123-45-67")), (2, (None, "1")), (3, None)],
        "id int, customer struct<email: string, phone: string>")
    h = PiiHasher.from_text("salt")
    out = protect(df, "purchases", h)
    rows = {r["id"]: r["customer"] for r in out.collect()}
    assert rows[1]["email"] == "e6cc5f4c3b9698a30c0b0b1a877754dc506ca9cab63cc44709fc447d6fab5c38"
    assert rows[2]["email"] is None and rows[2]["phone"] is not None
    assert rows[3] is None
    # a path that does not exist is a no-op
    same = rewrite_path(df, "customer.nope", lambda c: F.lit("x"))
    assert same.schema == df.schema
    assert PII_POLICY["products"] == ()


def test_protect_stringifies_id_and_rejects_unknown_collection(spark):
    df = spark.createDataFrame([(7, "x@y.z", "1")], "_id int, email string, phone string")
    out = protect(df, "customers", PiiHasher.from_text("salt"))
    assert dict(out.dtypes)["_id"] == "string"
    with pytest.raises(KeyError):
        protect(df, "unknown", PiiHasher.from_text("salt"))


def test_non_string_values_are_stringified_before_hashing(spark):
    h = PiiHasher.from_text("salt")
    df = spark.createDataFrame([(89161234567,)], "phone bigint")
    got = df.select(h.phone(F.col("phone")).alias("h")).first().h
    assert got == hmac.new(b"salt", b"79161234567", hashlib.sha256).hexdigest()
