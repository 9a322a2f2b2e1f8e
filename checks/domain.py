"""DuckDB statements that answer the registered queries independently.

``DOMAIN`` is the fixture text of FIXTURES.md: the domain tables as CTEs over
the star schema. Every statement below states a query a second time, in SQL.
"""

from __future__ import annotations

NOW = 993945600

DOMAIN = """WITH
part_x AS (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 10 ELSE CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 10 END END AS line_id,
    p_partkey - CASE WHEN p_partkey % 4 = 3 THEN 3 ELSE 0 END AS base FROM part),
service_line AS (SELECT * FROM (VALUES (1,'ECONOMY','ECO'),(2,'LARGE','LAR'),(3,'MEDIUM','MED'),(4,'PROMO','PRO'),(5,'SMALL','SMA'),(10,'STANDARD','KEC')) t(id, name, abbr)),
company AS (SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 25 = 2 THEN 0 ELSE 1 END AS is_customer,
    CASE c_custkey % 20 WHEN 0 THEN 'on_hold' WHEN 1 THEN 'inactive' ELSE 'active' END AS status FROM customer),
location AS (SELECT s_suppkey AS id, s_name AS name, s_suppkey * 3 AS company_id, 'STREET_' || s_suppkey AS address_street,
    'CITY_' || s_nationkey AS address_city, 'ST' AS address_state, '00000' AS address_postal,
    CASE WHEN s_suppkey % 20 = 2 THEN 'on_hold' ELSE 'active' END AS status FROM supplier),
"user" AS (SELECT n_nationkey AS id, n_name AS name, lower(n_name) || '@example.test' AS email,
    CASE WHEN n_nationkey % 5 = 4 THEN 0 ELSE 1 END AS is_tech, CASE WHEN n_nationkey % 7 = 6 THEN 'inactive' ELSE 'active' END AS status FROM nation),
job AS (SELECT o_orderkey AS id, o_orderkey + 1000 AS number, o_orderpriority AS name, o_custkey AS customer_id, o_custkey % 25 AS owner_id,
    o_orderkey % (SELECT count(*) FROM supplier) AS location_id, 'KEC' AS service_line, o_totalprice AS estimated_price,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'repair' ELSE 'cleaning' END AS type,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'scheduled' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'pending_invoice' WHEN 1 THEN 'sending_invoice' ELSE 'new' END END AS status,
    CAST(epoch(o_orderdate) AS BIGINT) AS scheduled_date,
    CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 17 <> 0 THEN CAST(epoch(o_orderdate) AS BIGINT) + 86400 END AS completed_on FROM orders),
appointment AS (SELECT o_orderkey AS id, o_orderkey AS job_id, o_orderkey % (SELECT count(*) FROM supplier) AS location_id,
    CASE o_orderkey % 5 WHEN 0 THEN 'canceled_by_customer' WHEN 1 THEN 'canceled_by_vendor' WHEN 2 THEN 'scheduled' ELSE 'completed' END AS status,
    CAST(epoch(o_orderdate) AS BIGINT) AS window_start, CAST(epoch(o_orderdate) AS BIGINT) + 3600 * (1 + o_orderkey % 4) AS window_end FROM orders),
invoice AS (SELECT o_orderkey AS id, 'INV-' || o_orderkey AS invoice_number, 'invoice' AS type, o_custkey AS customer_id, o_orderkey AS job_id,
    CASE WHEN o_orderkey % 50 = 0 THEN 'void' WHEN o_orderkey % 2 = 0 THEN 'paid' ELSE 'ok' END AS status,
    CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS is_paid, o_totalprice AS total_price,
    CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice WHEN o_orderkey % 3 = 0 THEN o_totalprice / 2 END AS total_paid_amount,
    CAST(epoch(o_orderdate) AS BIGINT) AS transaction_date,
    CASE WHEN o_orderkey % 40 <> 1 THEN CAST(epoch(o_orderdate) AS BIGINT) + 30 * 86400 END AS due_date,
    CAST(epoch(o_orderdate) AS BIGINT) + (o_orderkey % 60) * 86400 AS updated_at FROM orders WHERE o_orderkey % 10 <> 7),
invoice_item AS (SELECT l_orderkey AS invoice_id, l_extendedprice AS subtotal, CASE WHEN p_size % 7 = 0 THEN NULL ELSE line_id END AS service_line_id
    FROM lineitem JOIN part_x ON l_partkey = p_partkey),
quote AS (SELECT o_orderkey AS id, 'Q-' || o_orderkey AS name, o_custkey AS customer_id, o_orderkey % (SELECT count(*) FROM supplier) AS location_id,
    CASE (o_orderkey // 4) % 7 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' WHEN 2 THEN 'submitted' WHEN 3 THEN 'draft' WHEN 4 THEN 'new' WHEN 5 THEN 'canceled' ELSE 'accepted' END AS status,
    CAST(NULL AS VARCHAR) AS substatus, o_totalprice AS total_price, CAST(epoch(o_orderdate) AS BIGINT) AS created_at,
    CASE WHEN (o_orderkey // 4) % 7 = 2 THEN CAST(epoch(o_orderdate) AS BIGINT) + 5 * 86400 END AS latest_submission,
    CAST(epoch(o_orderdate) AS BIGINT) + 60 * 86400 AS expires_on FROM orders WHERE o_orderkey % 4 = 0),
asset AS (SELECT p_partkey AS id, p_name AS name, p_type AS display, p_partkey % (SELECT count(*) FROM supplier) AS location_id, line_id AS service_line_id,
    CASE WHEN p_partkey % 9 = 8 THEN 'inactive' ELSE 'active' END AS status, CASE WHEN p_partkey % 11 = 10 THEN 1 ELSE 0 END AS is_abstract_group FROM part_x),
deficiency AS (SELECT p_partkey AS id, p_partkey AS asset_id, p_partkey % (SELECT count(*) FROM supplier) AS location_id, p_brand AS title, p_name AS description,
    CASE p_size % 3 WHEN 0 THEN 'inoperable' WHEN 1 THEN 'deficient' ELSE 'suggested' END AS severity, 'new' AS resolution,
    CASE p_size % 5 WHEN 0 THEN 'fixed' WHEN 1 THEN 'invalid' WHEN 3 THEN 'verified' ELSE 'new' END AS status,
    993945600 - p_size * 864000 AS reported_on FROM part WHERE p_partkey % 3 = 0),
service_recurrence AS (SELECT p_partkey AS id, (base * 2) % (SELECT count(*) FROM supplier) AS location_id, base AS current_service_recurrence_id, line_id AS service_line_id,
    CASE base % 3 WHEN 0 THEN 'PrimaryxxxxMainHoodxxxxxx ' WHEN 1 THEN 'PrimaryxxxxCateringHoodxxxxxx ' ELSE 'SecondaryxxxxFan' END || p_name AS description,
    CASE p_size % 5 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly' WHEN 3 THEN 'yearly' END AS frequency, 1 + p_size % 6 AS "interval",
    CASE WHEN p_size % 5 = 4 THEN 'quarterly' END AS frequency_category, p_retailprice AS estimated_price,
    900000000 + p_size * 86400 AS created_at, 900000000 + p_size * 86400 AS first_start,
    CASE WHEN p_partkey % 4 = 3 THEN 993945600 - 8640000 END AS ends_on,
    CASE WHEN p_partkey % 22 = 0 THEN 993945600 + 800 * 86400 WHEN p_partkey % 26 <> 0 THEN 993945600 + (p_size % 20 - 8) * 2592000 END AS currently_due FROM part_x),
service_request AS (SELECT o_orderkey AS id, o_orderkey AS job_id,
    CASE WHEN (o_orderkey % (SELECT count(*) FROM part)) % 10 = 4 THEN NULL ELSE o_orderkey % (SELECT count(*) FROM part) END AS service_recurrence_id,
    CASE WHEN (o_orderkey % (SELECT count(*) FROM part)) % 10 = 8 THEN 'open' WHEN o_orderkey % 6 = 0 THEN 'canceled' WHEN o_orderkey % 6 IN (1, 2) THEN 'open' ELSE 'closed' END AS status FROM orders)
"""


def on_domain(body: str) -> str:
    """A statement over the domain tables; ``body`` may go on with more CTEs after a comma."""
    body = body.strip()
    return DOMAIN + (body if body.startswith(",") else "\n" + body)


def day(ts: str) -> str:
    """UTC date text of epoch seconds."""
    return f"CAST(CAST(epoch_ms(CAST({ts} AS BIGINT) * 1000) AS DATE) AS VARCHAR)"


def local(ts: str) -> str:
    """Pacific date of epoch seconds."""
    return f"CAST(timezone('America/Los_Angeles', to_timestamp({ts})) AS DATE)"


def local_text(ts: str) -> str:
    return f"CAST({local(ts)} AS VARCHAR)"


def days(seconds: str) -> str:
    return f"CAST(({seconds}) // 86400 AS BIGINT)"


def step(date: str, frequency: str, n: str) -> str:
    """Date one cadence step later; month ends roll on."""

    def months(count: str) -> str:
        return (
            f"CAST(date_trunc('month', {date}) + to_months(CAST({count} AS INTEGER)) AS DATE)"
            f" + CAST(day({date}) - 1 AS INTEGER)"
        )

    return (
        f"CASE {frequency} WHEN 'daily' THEN {date} + CAST({n} AS INTEGER)"
        f" WHEN 'weekly' THEN {date} + CAST({n} * 7 AS INTEGER)"
        f" WHEN 'monthly' THEN {months(n)} WHEN 'yearly' THEN {months(n + ' * 12')} END"
    )


def rounded(value: str, digits: int = 2) -> str:
    """Half away from zero on the decimal value."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38, 6)), {digits}) AS DOUBLE)"


def total(value: str) -> str:
    return rounded(f"SUM({value})")


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"
