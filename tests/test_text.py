import sqlite3

from pyspark.sql import functions as F

from fieldledger.functions import text

C = F.col


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_labels_agree_with_sqlite(spark):
    values = [
        "PrimaryxxxxMainHoodxxxxxx A", "Primaryxxxxfoo", "Primary", "Primaryxxxxxabc", "PrimaryxxxxMain", "Primaryxxxx",
        "PrimaryABCD", "", "x", None,
    ]
    con = sqlite3.connect(":memory:")
    want = [con.execute("SELECT substr(?1, 12, instr(substr(?1, 12), 'x') - 1)", (v,)).fetchone()[0] for v in values]
    assert [r[0] for r in column(spark, values).select(text.label(C("v"))).collect()] == want


def test_prefix_ignores_ascii_case_only(spark):
    values = ["primaryABC", "PRIMARYx", "Primary", "Prim", "xPrimary", "Primaré", None]
    got = [r[0] for r in column(spark, values).where(text.has_prefix(C("v"), "Primary")).collect()]
    assert got == ["primaryABC", "PRIMARYx", "Primary"]


def test_money(spark):
    values = ["9,250.00", " 12 ", "n/a", "", None, "-1,000.5"]
    assert [r[0] for r in column(spark, values).select(text.money(C("v"))).collect()] == [9250.0, 12.0, None, None, None, -1000.5]


def test_number_text_has_no_exponent(spark):
    values = [450.0, None, 12345678.5, 1e7, 0.125, 100.0]
    got = [r[0] for r in column(spark, values, "double").select(text.number_text(C("v"))).collect()]
    assert got == ["450.0", None, "12345678.5", "10000000.0", "0.125", "100.0"]


def test_snake_names(spark):
    names = {"externalIds": "external_ids", "ivrOpen": "ivr_open", "HTTPServerName": "http_server_name", "a1B": "a1_b", "id": "id"}
    assert {n: text.snake_name(n) for n in names} == names
    got = column(spark, list(names)).select(text.snake_column(C("v"))).collect()
    assert [r[0] for r in got] == list(names.values())


def test_fill_is_null_with_a_null_slot(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "v string, n long")
    got = df.select(text.fill("<{v}> {n} days", {"v": C("v"), "n": C("n")})).collect()
    assert [r[0] for r in got] == ["<a> 1 days", None]


def test_number_text_at_any_size(spark):
    values = [1e30, -1e30, 1e-12, 0.1 + 0.2, 1e7, 123456789012.34, -2.5e-7, 0.0, 9999999.5, None, float("inf")]
    got = [r[0] for r in column(spark, values, "double").select(text.number_text(C("v"))).collect()]
    big = "1" + "0" * 30 + ".0"
    assert got == [big, "-" + big, "0.000000000001", "0.3", "10000000.0", "123456789012.34", "-0.00000025", "0.0", "9999999.5", None, "Infinity"]
