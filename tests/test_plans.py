"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks.registry import all_queries
from checks.settings import SETTINGS
from fieldledger import schema
from fieldledger.operators import merge
from fieldledger.operators.joins import attach_groups, lookup, without
from fieldledger.plans.report import REPORTS
from fieldledger.sources.adapter import domain_tables
from fieldledger.sources.tables import parquet_tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The domain tables written once, so that plans start at real scans."""
    root = tmp_path_factory.mktemp("tables")
    tables = domain_tables(spark, "/root/testdata/sf0.001")
    for name in tables:
        tables[name].write.parquet(f"{root}/{name}")
    return parquet_tables(spark, str(root), list(tables))


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def without_broadcast(spark):
    """Plans as they look when no side is small enough to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def large(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    without_broadcast(spark)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", list(REPORTS))
def test_no_nested_loops_no_python_no_single_partition(stored, large, name):
    text = plan_of(REPORTS[name].frame(stored, SETTINGS))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "SinglePartition", "Window "):
        assert bad not in text, bad


def scan(text: str, table: str) -> str:
    """Description of the first scan of a table."""
    found = re.search(rf"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*/{table}\]\n(?:[^\n]+\n)*", text)
    return found.group(0)


def test_filters_and_columns_reach_the_scans(stored):
    visits = scan(plan_of(REPORTS["visits"].frame(stored, SETTINGS)), "job")
    assert "GreaterThanOrEqual(completed_on" in visits and "EqualTo(status,completed)" in visits
    assert "description" not in visits.split("ReadSchema")[1]
    aging = scan(plan_of(REPORTS["ar_aging"].frame(stored, SETTINGS)), "invoice")
    assert "EqualTo(is_paid,0)" in aging and "EqualTo(type,invoice)" in aging
    assert len(aging.split("struct<")[1].split(",")) == 8
    overdue = scan(plan_of(REPORTS["overdue_invoices"].frame(stored, SETTINGS)), "invoice")
    assert "LessThan(due_date" in overdue
    stale = scan(plan_of(REPORTS["stale_quotes"].frame(stored, SETTINGS)), "quote")
    assert "LessThanOrEqual(created_at" in stale


def exchanges(text: str) -> int:
    return len(re.findall(r"\n\(\d+\) Exchange", text))


def test_shuffle_counts(stored, large):
    # Facts shrink per key first, then meet a lookup table: one shuffle for each side.
    for name, most in (("ar_aging", 2), ("revenue_by_customer", 2), ("quote_acceptance", 2), ("customer_churn_risk", 2), ("technician_workload", 4), ("revenue_monthly", 7)):
        assert exchanges(plan_of(REPORTS[name].frame(stored, SETTINGS))) <= most, name


def test_aggregates_combine_before_the_shuffle(stored, large):
    # What each fact is reduced by in the map tasks.
    for name, function in (
        ("ar_aging", "partial_sum"),
        ("customer_churn_risk", "partial_max"),
        ("appointment_cancellations", "partial_count"),
        ("revenue_monthly", "partial_sum(subtotal"),
    ):
        assert function in plan_of(REPORTS[name].frame(stored, SETTINGS)), name


def test_appointments_move_once(stored, large):
    # Both sides of the job join, the grouping by bare keys; all else is small.
    text = plan_of(REPORTS["appointment_cancellations"].frame(stored, SETTINGS))
    moved = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert sum("window_start" in columns for columns in moved) == 1




@pytest.fixture
def tiny_partitions(spark, large):
    """Thresholds at which test-sized data already counts as skewed."""
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def run_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(n: int):
    """7 for a third of the rows, spread out for the others."""
    return F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % n)


def test_hot_keys_are_split(spark, tiny_partitions):
    facts = spark.range(0, 60000, 1, 16).select("id", hot(500).alias("customer_id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    firms = spark.range(500).select("id", F.concat(F.lit("c"), "id").alias("name"))
    joined = lookup(facts, firms, "customer_id", {"name": "customer"})
    assert joined.count() == 60000
    assert "skew=true" in run_plan(joined)


@pytest.mark.parametrize("name", ["compliance_overdue", "primary_hood_next_service", "open_deficiencies"])
def test_a_hot_location_is_split_in_the_reports(spark, tiny_partitions, tmp_path, name):
    pad = F.sha2(F.col("id").cast("string"), 256)
    as_of, day = SETTINGS.as_of, 86400
    made = {
        "location": spark.range(300).select("id", F.lit("l").alias("name"), (F.col("id") % 40).alias("company_id"), F.lit("active").alias("status")),
        "company": spark.range(40).select("id", F.lit("c").alias("name"), F.lit("active").alias("status")),
        "job": spark.range(600).select("id", (F.col("id") % 300).alias("location_id"), F.lit("completed").alias("status"), F.lit(as_of - 500 * day).alias("completed_on"), F.lit(as_of).alias("scheduled_date")),
        "service_recurrence": spark.range(0, 30000, 1, 16).select(
            "id", hot(300).alias("location_id"), F.concat(F.lit("PrimaryxxxxMainHoodxxxxxx"), pad).alias("description"),
            F.lit("weekly").alias("frequency"), (F.pmod(F.xxhash64("id"), F.lit(60)) + 1).alias("interval"), F.lit(10).alias("service_line_id"),
            F.col("id").alias("current_service_recurrence_id"), (F.lit(as_of) + F.col("id")).alias("currently_due"), (F.col("id") / 7).alias("estimated_price"),
        ),
        "deficiency": spark.range(0, 30000, 1, 16).select("id", hot(300).alias("location_id"), F.lit("new").alias("status"), pad.alias("description"), F.lit(as_of).alias("reported_on")),
    }
    for table, rows in made.items():
        schema.conform(rows, table).write.parquet(f"{tmp_path}/{table}")
    df = REPORTS[name].frame(parquet_tables(spark, str(tmp_path)), SETTINGS)
    assert df.count() == 30000
    text = run_plan(df)
    assert "skew=true" in text, text


def test_hot_duplicates_are_spread(spark, large):
    rows = spark.range(3000).select("id", (F.col("id") % 3 * 0).alias("g"))
    sizes = rows.groupBy("g").count()
    joined = attach_groups(rows, sizes, ["g"], "id", salts=16)
    assert joined.count() == 3000
    assert joined.repartition(1).select(F.pmod(F.xxhash64("id"), F.lit(16))).distinct().count() == 16


def test_anti_join_collapses_partner_keys(spark, large):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(1000).select((F.col("id") % 3).alias("p"))
    text = plan_of(without(left, right, "k", "p"))
    assert "LeftAnti" in text and exchanges(text) == 2


def test_a_small_batch_does_not_shuffle_the_table(spark, tmp_path):
    layout = schema.table_schema("company")
    spark.range(1000).select("id").write.parquet(str(tmp_path / "t"))
    stored = spark.read.schema(layout).parquet(str(tmp_path / "t"))
    changes = schema.conform(spark.range(3).toDF("id"), "company")
    changes.write.parquet(str(tmp_path / "c"))
    batch = spark.read.schema(layout).parquet(str(tmp_path / "c"))
    text = plan_of(merge.upsert(stored, batch, "id"))
    assert "BroadcastHashJoin LeftAnti" in text
    before = text.split("BroadcastHashJoin LeftAnti")[0]
    assert "SortMergeJoin" not in before


def test_every_query_is_named():
    names = list(all_queries())
    assert len(names) == len(set(names)) > 75
