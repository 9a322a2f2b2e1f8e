"""Field-service tables projected from a generic order star schema.

Lets the reports run on the order/part/customer tables: every row of a domain
table comes from one row of an input table by arithmetic on its keys.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger import schema
from fieldledger.functions import dates
from fieldledger.sources.tables import Tables

AS_OF = 993945600  # 2001-07-01 00:00:00 UTC

LAYOUTS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
LINE_ID = (
    "CASE WHEN p_partkey % 2 = 0 THEN 10 WHEN p_type = 'ECONOMY' THEN 1 WHEN p_type = 'LARGE' THEN 2"
    " WHEN p_type = 'MEDIUM' THEN 3 WHEN p_type = 'PROMO' THEN 4 WHEN p_type = 'SMALL' THEN 5 ELSE 10 END"
)
LINES = [
    (1, "ECONOMY", "ECO"),
    (2, "LARGE", "LAR"),
    (3, "MEDIUM", "MED"),
    (4, "PROMO", "PRO"),
    (5, "SMALL", "SMA"),
    (10, "STANDARD", "KEC"),
]


def domain_tables(spark: SparkSession, sf_dir: str) -> Tables:
    @cache
    def raw(name: str) -> DataFrame:
        # A given layout saves a job per table that would only look at file footers.
        return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")

    def rows_of(name: str):
        return raw(name).agg(F.count(F.lit(1))).scalar()

    def orders() -> DataFrame:
        return raw("orders").select(
            "*", dates.epoch_of_ntz(F.col("o_orderdate")).alias("at"), rows_of("supplier").alias("n_sup")
        )

    def parts() -> DataFrame:
        return raw("part").select(
            "*",
            F.expr(LINE_ID).alias("line_id"),
            F.expr("p_partkey - CASE WHEN p_partkey % 4 = 3 THEN 3 ELSE 0 END").alias("base"),
            rows_of("supplier").alias("n_sup"),
        )

    def service_line() -> DataFrame:
        # An inline table: its size is known to the optimizer, so it is broadcast.
        values = ", ".join(f"({i}L, '{name}', '{abbr}')" for i, name, abbr in LINES)
        return spark.sql(f"SELECT * FROM VALUES {values} AS t(id, name, abbr)")

    def company() -> DataFrame:
        return raw("customer").selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            "CASE WHEN c_custkey % 25 = 2 THEN 0 ELSE 1 END AS is_customer",
            "CASE c_custkey % 20 WHEN 0 THEN 'on_hold' WHEN 1 THEN 'inactive' ELSE 'active' END AS status",
        )

    def location() -> DataFrame:
        return raw("supplier").selectExpr(
            "s_suppkey AS id",
            "s_name AS name",
            "s_suppkey * 3 AS company_id",
            "'STREET_' || s_suppkey AS address_street",
            "'CITY_' || s_nationkey AS address_city",
            "'ST' AS address_state",
            "'00000' AS address_postal",
            "CASE WHEN s_suppkey % 20 = 2 THEN 'on_hold' ELSE 'active' END AS status",
        )

    def user() -> DataFrame:
        return raw("nation").selectExpr(
            "n_nationkey AS id",
            "n_name AS name",
            "lower(n_name) || '@example.test' AS email",
            "CASE WHEN n_nationkey % 5 = 4 THEN 0 ELSE 1 END AS is_tech",
            "CASE WHEN n_nationkey % 7 = 6 THEN 'inactive' ELSE 'active' END AS status",
        )

    def job() -> DataFrame:
        return orders().selectExpr(
            "o_orderkey AS id",
            "o_orderkey + 1000 AS number",
            "o_orderpriority AS name",
            "o_custkey AS customer_id",
            "o_custkey % 25 AS owner_id",
            "o_orderkey % n_sup AS location_id",
            "'KEC' AS service_line",
            "o_totalprice AS estimated_price",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 'repair' ELSE 'cleaning' END AS type",
            "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'scheduled' ELSE"
            " CASE o_orderkey % 3 WHEN 0 THEN 'pending_invoice' WHEN 1 THEN 'sending_invoice' ELSE 'new' END END AS status",
            "at AS scheduled_date",
            "CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 17 <> 0 THEN at + 86400 END AS completed_on",
        )

    def appointment() -> DataFrame:
        return orders().selectExpr(
            "o_orderkey AS id",
            "o_orderkey AS job_id",
            "o_orderkey % n_sup AS location_id",
            "CASE o_orderkey % 5 WHEN 0 THEN 'canceled_by_customer' WHEN 1 THEN 'canceled_by_vendor'"
            " WHEN 2 THEN 'scheduled' ELSE 'completed' END AS status",
            "at AS window_start",
            "at + 3600 * (1 + o_orderkey % 4) AS window_end",
        )

    def invoice() -> DataFrame:
        return (
            orders()
            .where("o_orderkey % 10 <> 7")
            .selectExpr(
                "o_orderkey AS id",
                "'INV-' || o_orderkey AS invoice_number",
                "'invoice' AS type",
                "o_custkey AS customer_id",
                "o_orderkey AS job_id",
                "CASE WHEN o_orderkey % 50 = 0 THEN 'void' WHEN o_orderkey % 2 = 0 THEN 'paid' ELSE 'ok' END AS status",
                "CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS is_paid",
                "o_totalprice AS total_price",
                "CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice WHEN o_orderkey % 3 = 0 THEN o_totalprice / 2 END"
                " AS total_paid_amount",
                "at AS transaction_date",
                "CASE WHEN o_orderkey % 40 <> 1 THEN at + 30 * 86400 END AS due_date",
                "at + (o_orderkey % 60) * 86400 AS updated_at",
            )
        )

    def invoice_item() -> DataFrame:
        return (
            raw("lineitem")
            .join(parts(), F.col("l_partkey") == F.col("p_partkey"))
            .selectExpr(
                "l_orderkey AS invoice_id",
                "l_extendedprice AS subtotal",
                "CASE WHEN p_size % 7 <> 0 THEN line_id END AS service_line_id",
            )
        )

    def quote() -> DataFrame:
        return (
            orders()
            .where("o_orderkey % 4 = 0")
            .selectExpr(
                "o_orderkey AS id",
                "'Q-' || o_orderkey AS name",
                "o_custkey AS customer_id",
                "o_orderkey % n_sup AS location_id",
                "CASE (o_orderkey div 4) % 7 WHEN 1 THEN 'rejected' WHEN 2 THEN 'submitted' WHEN 3 THEN 'draft'"
                " WHEN 4 THEN 'new' WHEN 5 THEN 'canceled' ELSE 'accepted' END AS status",
                "o_totalprice AS total_price",
                "at AS created_at",
                "CASE WHEN (o_orderkey div 4) % 7 = 2 THEN at + 5 * 86400 END AS latest_submission",
                "at + 60 * 86400 AS expires_on",
            )
        )

    def asset() -> DataFrame:
        return parts().selectExpr(
            "p_partkey AS id",
            "p_name AS name",
            "p_type AS display",
            "p_partkey % n_sup AS location_id",
            "line_id AS service_line_id",
            "CASE WHEN p_partkey % 9 = 8 THEN 'inactive' ELSE 'active' END AS status",
            "CASE WHEN p_partkey % 11 = 10 THEN 1 ELSE 0 END AS is_abstract_group",
        )

    def deficiency() -> DataFrame:
        return (
            parts()
            .where("p_partkey % 3 = 0")
            .selectExpr(
                "p_partkey AS id",
                "p_partkey AS asset_id",
                "p_partkey % n_sup AS location_id",
                "p_brand AS title",
                "p_name AS description",
                "CASE p_size % 3 WHEN 0 THEN 'inoperable' WHEN 1 THEN 'deficient' ELSE 'suggested' END AS severity",
                "'new' AS resolution",
                "CASE p_size % 5 WHEN 0 THEN 'fixed' WHEN 1 THEN 'invalid' WHEN 3 THEN 'verified' ELSE 'new' END AS status",
                f"{AS_OF}L - p_size * 864000L AS reported_on",
            )
        )

    def service_recurrence() -> DataFrame:
        return parts().selectExpr(
            "p_partkey AS id",
            "(base * 2) % n_sup AS location_id",
            "base AS current_service_recurrence_id",
            "line_id AS service_line_id",
            "CASE base % 3 WHEN 0 THEN 'PrimaryxxxxMainHoodxxxxxx ' WHEN 1 THEN 'PrimaryxxxxCateringHoodxxxxxx '"
            " ELSE 'SecondaryxxxxFan' END || p_name AS description",
            "CASE p_size % 5 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly' WHEN 3 THEN 'yearly' END AS frequency",
            "1 + p_size % 6 AS interval",
            "CASE WHEN p_size % 5 = 4 THEN 'quarterly' END AS frequency_category",
            "p_retailprice AS estimated_price",
            "900000000L + p_size * 86400L AS created_at",
            "900000000L + p_size * 86400L AS first_start",
            f"CASE WHEN p_partkey % 4 = 3 THEN {AS_OF}L - 8640000L END AS ends_on",
            f"CASE WHEN p_partkey % 22 = 0 THEN {AS_OF}L + 800 * 86400L"
            f" WHEN p_partkey % 26 <> 0 THEN {AS_OF}L + (p_size % 20 - 8) * 2592000L END AS currently_due",
        )

    def service_request() -> DataFrame:
        return (
            raw("orders")
            .select("o_orderkey", (F.col("o_orderkey") % rows_of("part")).alias("part"))
            .selectExpr(
                "o_orderkey AS id",
                "o_orderkey AS job_id",
                "CASE WHEN part % 10 <> 4 THEN part END AS service_recurrence_id",
                "CASE WHEN part % 10 = 8 THEN 'open' WHEN o_orderkey % 6 = 0 THEN 'canceled'"
                " WHEN o_orderkey % 6 IN (1, 2) THEN 'open' ELSE 'closed' END AS status",
            )
        )

    def sync_log() -> DataFrame:
        # One run per event type and day.
        at = dates.epoch_of_ntz(F.col("ts"))
        return (
            raw("events")
            .groupBy(F.col("event_type").alias("resource"), dates.utc_date(at).alias("day"))
            .agg(
                F.min(at).alias("started_at"),
                F.max(at).alias("finished_at"),
                F.count(F.lit(1)).alias("records_fetched"),
                F.count_if(F.col("value") >= 1).alias("records_upserted"),
                F.max("event_id").alias("id"),
            )
            .selectExpr(
                "id",
                "resource",
                "started_at",
                "finished_at",
                "CASE WHEN id % 4 = 0 THEN 'failed' ELSE 'success' END AS status",
                "CASE WHEN id % 4 = 0 THEN 0 ELSE records_fetched END AS records_fetched",
                "CASE WHEN id % 4 = 0 THEN 0 ELSE records_upserted END AS records_upserted",
                "CASE WHEN id % 4 = 0 THEN 'API error 500 on GET ' || resource END AS error_message",
            )
        )

    makers = {
        "service_line": service_line,
        "company": company,
        "location": location,
        "user": user,
        "job": job,
        "appointment": appointment,
        "invoice": invoice,
        "invoice_item": invoice_item,
        "quote": quote,
        "asset": asset,
        "deficiency": deficiency,
        "service_recurrence": service_recurrence,
        "service_request": service_request,
        "sync_log": sync_log,
    }
    return Tables({n: (lambda n=n, m=m: schema.conform(m(), n)) for n, m in makers.items()})
