import json

import pytest

from fieldledger.plans import billing, field_work, next_service, quality  # noqa: F401
from fieldledger.plans.catalog import (
    ReportCatalog,
    as_json,
    bounded_query,
    register_tables,
    select_only,
    timestamp_view,
    view_name,
)
from fieldledger.plans.report import REPORTS, Settings
from fieldledger.sources.adapter import AS_OF, domain_tables
from fieldledger.sources.tables import Tables, row_count


@pytest.fixture
def numbers(spark):
    spark.range(1500).createOrReplaceTempView("numbers")
    yield
    spark.catalog.dropTempView("numbers")


def test_only_queries_pass(spark, numbers):
    assert select_only(spark, " SELECT id FROM numbers ; ") == "SELECT id FROM numbers"
    select_only(spark, "WITH a AS (SELECT 1 AS x) SELECT replace('update', 'u', 'x') FROM a")
    select_only(spark, "SELECT 'how to reflect (light)' AS x, id AS `using` FROM numbers -- reflect('a')")
    for bad in (
        "SELECT `reflect`('java.lang.System', 'exit', 0)", "SELECT java_method/**/('java.lang.System', 'exit', 0)", "SELECT * FROM text.`/etc/hostname`",
        "", ";", "DROP VIEW numbers", "INSERT INTO numbers VALUES (1)", "WITH a AS (SELECT 1) INSERT INTO numbers SELECT * FROM a",
        "SELECT * FROM missing", "SELECT reflect('java.lang.System', 'exit', 0)", "SELECT TRANSFORM (id) USING 'cat' FROM numbers",
        "SELECT 1; DROP VIEW numbers", "CREATE TABLE x AS SELECT 1", "EXPLAIN SELECT 1",
    ):
        with pytest.raises(ValueError):
            select_only(spark, bad)
    assert spark.table("numbers").count() == 1500


def test_default_limit(spark, numbers):
    assert bounded_query(spark, "SELECT id FROM numbers").count() == 1000
    assert bounded_query(spark, "SELECT id FROM numbers LIMIT 1200").count() == 1200
    assert bounded_query(spark, "SELECT id FROM (SELECT id FROM numbers LIMIT 1200)").count() == 1000
    ordered = bounded_query(spark, "SELECT id FROM numbers ORDER BY id DESC", limit=2)
    assert [r.id for r in ordered.collect()] == [1499, 1498]


def test_rows_as_json(spark):
    assert [json.loads(r.row) for r in as_json(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b")).collect()] == [{"a": 1, "b": None}]


def test_saved_views(spark, numbers, tmp_path):
    catalog = ReportCatalog(spark, str(tmp_path / "reports"))
    catalog.save("report_big", "Which are\nbig?", "SELECT id FROM numbers WHERE id > 1490")
    catalog.save("report_big", "Which are big?", "SELECT id FROM numbers WHERE id > 1495;")
    assert spark.table("report_big").count() == 4
    for name, sql in (("big", "SELECT 1"), ("report_Big", "SELECT 1"), ("report_x", "SELECT 1/0 AS x"), ("report_x", "DROP VIEW report_big")):
        with pytest.raises(Exception):
            catalog.save(name, "", sql)
    listed = catalog.listing().collect()
    assert [(r.name, r.description, r.sql) for r in listed] == [("report_big", "Which are big?", "SELECT id FROM numbers WHERE id > 1495")]
    spark.catalog.dropTempView("report_big")
    (tmp_path / "reports" / "report_bad.sql").write_text("-- name: report_bad\nSELECT * FROM nowhere\n")
    fresh = ReportCatalog(spark, str(tmp_path / "reports"))
    done, errors = fresh.restore()
    assert done == ["report_big"] and list(errors) == ["report_bad"]
    assert spark.table("report_big").count() == 4 and fresh.listing().where("name = \'report_big\'").first().created_at.endswith("Z")
    assert fresh.drop("report_big") and not fresh.drop("report_big")
    assert not (tmp_path / "reports" / "report_big.sql").exists()
    with pytest.raises(ValueError):
        fresh.drop("numbers")


def test_reports_as_views_and_tables(spark, tmp_path):
    tables = domain_tables(spark, "/root/testdata/sf0.001")
    register_tables(tables, ["job", "user", "service_line"])
    row = spark.sql("SELECT scheduled_date, scheduled_date_dt FROM v_job WHERE scheduled_date = 993945600 LIMIT 1").collect()
    assert all(r.scheduled_date_dt == "2001-06-30 17:00:00" for r in row)
    catalog = ReportCatalog(spark, str(tmp_path))
    catalog.add_reports(tables, Settings(AS_OF))
    names = {r.name for r in catalog.listing().collect()}
    assert names == {view_name(n) for n in REPORTS} and len(names) == 25
    assert {"report_zzz_ar_aging", "report_primary_hood_next_service_v3", "report_qual_primary_hood_duplicates"} <= names
    assert bounded_query(spark, "SELECT customer FROM report_zzz_ar_aging ORDER BY total_outstanding DESC LIMIT 3").count() == 3
    for name in names | {"job", "user", "service_line", "v_job", "v_user"}:
        spark.catalog.dropTempView(name)


def test_timestamp_view_and_counts(spark):
    tables = Tables({"tag": spark.range(3).toDF("id")})
    assert row_count(tables, "tag") == 3 and row_count(tables, "contact") == -1
    assert timestamp_view(tables["tag"], "tag").columns == ["id"]


def test_views_restore_in_the_order_in_which_they_read_each_other(spark, tmp_path):
    first = ReportCatalog(spark, str(tmp_path))
    first.save("report_b", "b", "SELECT 1 AS x -- not report_c")
    first.save("report_a", "a", "SELECT x, 'report_c' AS t FROM report_b")
    (tmp_path / "report_c.sql").write_text("-- name: report_c\n-- description: c\n-- created_at: t\nSELECT * FROM report_d")
    (tmp_path / "report_d.sql").write_text("-- name: report_d\n-- description: d\n-- created_at: t\nSELECT * FROM report_c")
    for name in ("report_a", "report_b"):
        spark.catalog.dropTempView(name)
    other = ReportCatalog(spark, str(tmp_path))
    assert {r.name for r in other.listing().collect()} >= {"report_a", "report_b", "report_c", "report_d"}
    done, errors = other.restore()
    assert done == ["report_b", "report_a"] and set(errors) == {"report_c", "report_d"} and "read each other" in errors["report_c"]
    assert other.drop("report_c") and not other.drop("report_c")
    assert "report_c" not in {r.name for r in other.listing().collect()}
    for name in done:
        spark.catalog.dropTempView(name)
