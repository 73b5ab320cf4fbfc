import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatspark.functions import casts, strings


def one(spark, expr, data, schema):
    return spark.createDataFrame(data, schema).select(expr.alias("x")).collect()


def test_normalize_cves(spark):
    rows = one(spark, strings.normalize_cves("c"),
               [(" cve-2024-000001, CVE-2024-000002 ,n/a,CVE-2024-000001",), (None,), ("",)], "c string")
    assert rows[0]["x"] == ["CVE-2024-000001", "CVE-2024-000002"]
    assert rows[1]["x"] == [] and rows[2]["x"] == []


def test_join_text_and_ids(spark):
    df = spark.createDataFrame([("a ", None, "h", "1"), (None, "b", None, None)], "d string, s string, h string, p string")
    r = df.select(strings.join_text("d", "s").alias("t"), strings.finding_id("h", "p").alias("i")).collect()
    assert [x["t"] for x in r] == ["a", "b"]
    import hashlib
    assert r[0]["i"] == hashlib.md5(b"h-1").hexdigest()
    assert r[1]["i"] == hashlib.md5(b"-").hexdigest()


def test_tolerant_int(spark):
    rows = one(spark, casts.tolerant_int("p"), [("80",), (" 80 ",), ("80.5",), ("",), (None,), ("+7",)], "p string")
    assert [r["x"] for r in rows] == [80, 80, None, None, None, 7]


def test_parse_iso_and_day(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.000",), ("2024-01-02T03:04:05.000Z",),
                                ("2024-01-02T05:04:05+02:00",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(casts.parse_iso("s")).collect()]
    assert got[:3] == [dt.datetime(2024, 1, 2, 3, 4, 5)] * 3
    assert got[3] is None and got[4] is None
    d = spark.createDataFrame([("2024-01-02",), ("2024-1-2",), ("2024-13-01",), ("x",)], "s string")
    assert [r[0] for r in d.select(casts.parse_day("s")).collect()] == [
        dt.date(2024, 1, 2), dt.date(2024, 1, 2), None, None]


def test_decimal_or_zero_and_round(spark):
    rows = one(spark, casts.decimal_or_zero("e"), [("0.936",), ("",), (None,), ("n/a",)], "e string")
    assert [r["x"] for r in rows] == [Decimal("0.93600"), Decimal("0.00000"), Decimal("0.00000"), None]
    # Q7: half-up on the decimal value (a binary float would give 2.67)
    r = spark.range(1).select(casts.round2(F.lit(Decimal("2.675"))).alias("x")).first()["x"]
    assert r == 2.68


def test_falsy_to_null(spark):
    df = spark.createDataFrame([("", 0.0, [], False), ("a", 0.5, ["x"], True)],
                               "s string, d double, a array<string>, b boolean")
    r = df.select(casts.falsy_to_null(F.col("s"), T.StringType()).alias("s"),
                  casts.falsy_to_null(F.col("d"), T.DoubleType()).alias("d"),
                  casts.falsy_to_null(F.col("a"), T.ArrayType(T.StringType())).alias("a"),
                  casts.falsy_to_null(F.col("b"), T.BooleanType()).alias("b")).collect()
    assert tuple(r[0]) == (None, None, None, None)
    assert tuple(r[1]) == ("a", 0.5, ["x"], True)


def test_decimal_text_and_threat_text(spark):
    df = spark.createDataFrame([(Decimal("0.39480"), Decimal("1.00000"), Decimal("0.00043"))],
                               "a decimal(7,5), b decimal(7,5), c decimal(7,5)")
    r = df.select(strings.decimal_text("a"), strings.decimal_text("b"), strings.decimal_text("c")).first()
    assert tuple(r) == ("0.3948", "1.0", "0.00043")
    m = spark.createDataFrame([({"k": ["a", "b"], "z": ["1"]},), ({},)], "m map<string,array<string>>")
    got = [x[0] for x in m.select(strings.threats_to_text("m")).collect()]
    assert got[0] in ("k: a, b; z: 1", "z: 1; k: a, b") and got[1] == ""


def test_lowercase_in(spark):
    rows = one(spark, strings.lowercase_in("v", ["Known", "YES"]), [("known",), ("no",), (None,)], "v string")
    assert [r["x"] for r in rows] == [True, False, None]


def test_split_quarantine(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("", None)], "k string, v int")
    good, bad = casts.split_quarantine(df, {"missing_key": F.col("k").isNull() | (F.col("k") == ""),
                                            "no_value": F.col("v").isNull()})
    assert [r["k"] for r in good.collect()] == ["a"]
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["missing_key", "missing_key,no_value"]


def test_threats_json_unwraps_single_values(spark):
    import json
    m = spark.createDataFrame([({"a": ["x"], "b": ["1", "2"], "c": ['q"t']},)], "m map<string,array<string>>")
    got = json.loads(m.select(strings.threats_json("m")).first()[0])
    assert got == {"a": "x", "b": ["1", "2"], "c": 'q"t'}


def test_finding_id_compat(spark):
    import hashlib
    df = spark.createDataFrame([(None, "1")], "h string, p string")
    r = df.select(strings.finding_id("h", "p", "nan")).first()[0]
    assert r == hashlib.md5(b"nan-1").hexdigest()


def test_large_numbers_and_any_white_space(spark):
    from threatspark.functions import strings
    r = spark.range(1).select(
        strings.cve_of(F.lit(1_000_000)).alias("a"), strings.cve_of(F.lit(7)).alias("b"),
        casts.tolerant_int(F.lit("\t3000000000\n")).alias("c"),
        strings.normalize_cves(F.lit("CVE-2020-1,\nCVE-2020-2,\tcve-2020-3")).alias("d"),
        casts.decimal_or_zero(F.lit("0.000431239")).cast("string").alias("e"),
        strings.join_text(F.lit("\n a"), F.lit("b\t")).alias("f")).first()
    assert (r["a"], r["b"], r["c"]) == ("CVE-2024-1000000", "CVE-2024-000007", 3_000_000_000)
    assert r["d"] == ["CVE-2020-1", "CVE-2020-2", "CVE-2020-3"] and r["e"].startswith("0.000431239") and r["f"] == "a b"
