"""Reports against DuckDB on small tables full of edge cases: NULL and dangling
keys, equal names, ties, missing dates, hot keys."""

import random

import duckdb
import pandas as pd
import pytest

from checks.compare import plain, table
from checks.registry import REPORT_IDS
from checks.reports import REPORT_SQL
from checks.settings import SETTINGS
from fieldledger import schema
from fieldledger.plans.report import REPORTS
from fieldledger.sources.adapter import AS_OF
from fieldledger.sources.tables import Tables, parquet_tables

SIZE = {
    "service_line": 6, "company": 60, "location": 300, "user": 6, "job": 160, "appointment": 200, "invoice": 160,
    "invoice_item": 260, "service_recurrence": 1200, "service_request": 500, "quote": 150,
}
TEXTS = {
    ("company", "status"): ["active", "active", "active", "on_hold", "inactive", None],
    ("location", "status"): ["active", "active", "active", "on_hold", None],
    ("user", "status"): ["active", "active", "inactive"],
    ("job", "status"): ["completed", "completed", "scheduled", "new", "pending_invoice", "canceled", None],
    ("job", "type"): ["cleaning", "repair", None],
    ("appointment", "status"): ["canceled_by_customer", "canceled_by_vendor", "completed", "scheduled", None],
    ("invoice", "status"): ["ok", "paid", "void", "sent", None],
    ("invoice", "type"): ["invoice", "invoice", "invoice", "vendorbill", None],
    ("quote", "status"): ["accepted", "rejected", "submitted", "draft", "new", "canceled", None],
    ("asset", "status"): ["active", "active", "inactive"],
    ("deficiency", "status"): ["new", "verified", "fixed", "invalid", None],
    ("deficiency", "severity"): ["inoperable", "deficient", "suggested", None],
    ("service_recurrence", "frequency"): ["daily", "weekly", "monthly", "yearly", "odd", None],
    ("service_recurrence", "frequency_category"): ["quarterly", None],
    ("service_recurrence", "description"): ["PrimaryxxxxMainHoodxxxxxx A", "primaryxxxxMAINhoodxxxxxx", "PrimaryxxxxFan", "Primary", "Other", None],
    ("service_request", "status"): ["closed", "closed", "open", "canceled", None],
    ("service_line", "abbr"): ["KEC", "KEC", "GC"],
}
LINKS = {
    "customer_id": "company", "company_id": "company", "location_id": "location", "job_id": "job", "owner_id": "user",
    "invoice_id": "invoice", "asset_id": "asset", "service_recurrence_id": "service_recurrence",
}
FILLED: set[str] = set()
TABLES = [t for t in schema.TABLE_COLUMNS if t not in ("tag", "payment_terms", "contact", "quote_item", "sync_status", "sync_log")]


def value(rng, table, name, key):
    if name == "id":
        return key
    if (table, name) in TEXTS:
        return rng.choice(TEXTS[table, name])
    if name == "service_line_id":
        return rng.choice([10, 10, 10, 1, 2, 77, None])
    if name == "current_service_recurrence_id":
        return rng.choice([key, key, rng.randrange(60), None])
    if name == "ends_on":
        return rng.choice([None, None, None, AS_OF - 5, AS_OF, AS_OF + 5])
    if name == "interval":
        return rng.choice([0, 1, 2, 3, 13, None])
    if name in LINKS:
        top = SIZE.get(LINKS[name], 40)
        return rng.choice([0, 1, rng.randrange(top), rng.randrange(top), rng.randrange(top), top + rng.randrange(3), None])
    if name in schema.TIMESTAMP_COLUMNS:
        near = AS_OF + rng.randrange(-40, 40) * 86400 + rng.choice([0, 0, -1, 1, 40000])
        far = AS_OF + rng.randrange(-2000, 900) * 86400
        return rng.choice([near, near, far, far, far, AS_OF, None])
    if name.startswith("is_"):
        return rng.choice([0, 1, 1 if name in ("is_customer", "is_tech") else 0])
    if name in schema.DOUBLE_COLUMNS:
        return rng.choice([rng.randrange(1, 10**6) / 100, rng.randrange(1, 10**4) / 8, 0.0, None])
    if name in schema.INTEGER_COLUMNS or name.endswith("_id"):
        return rng.randrange(5)
    return rng.choice(["a", "b", "c", None]) if name != "name" else f"{table}{rng.randrange(9)}"


def domain(seed):
    rng = random.Random(seed)
    out = {}
    for name in TABLES:
        keys = [1, 2, 3, 4, 5, 10] if name == "service_line" else range(SIZE.get(name, 40))
        columns = schema.TABLE_COLUMNS[name].split()
        out[name] = [tuple(value(rng, name, c, k) for c in columns) for k in keys]
    return out


@pytest.fixture(scope="module", params=[1, 2])
def both(request, spark):
    data = domain(request.param)
    con = duckdb.connect()
    frames = {}
    for name, rows in data.items():
        layout = schema.table_schema(name)
        frames[name] = spark.createDataFrame(rows, layout).coalesce(2).cache()
        kinds = {"bigint": "Int64", "double": "float64", "string": "object"}
        frame = pd.DataFrame(rows, columns=layout.names).astype({f.name: kinds[f.dataType.simpleString()] for f in layout})
        con.register("frame", frame)
        types = ", ".join(
            f'CAST("{f.name}" AS {"BIGINT" if f.dataType.simpleString() == "bigint" else f.dataType.simpleString().upper().replace("STRING", "VARCHAR")}) AS "{f.name}"'
            for f in layout
        )
        con.execute(f'CREATE TABLE "{name}" AS SELECT {types} FROM frame')
    return Tables(frames), con


@pytest.mark.parametrize("key", list(REPORT_IDS))
def test_report(both, key):
    tables, con = both
    df = REPORTS[REPORT_IDS[key]].frame(tables, SETTINGS, ordered=True)
    got, names = table(df.columns, [tuple(r) for r in df.collect()])
    body = REPORT_SQL[key]().strip()
    result = con.execute("WITH nothing AS (SELECT 1) " + body)
    want, want_names = table([d[0] for d in result.description], result.fetchall())
    assert names == want_names
    assert [p for p in zip(got, want) if p[0] != p[1]] == [] and len(got) == len(want)
    if got:
        FILLED.add(key)


def test_no_report_was_only_checked_empty():
    assert set(REPORT_IDS) <= FILLED


def test_v3_order_is_by_kind_then_value(both):
    tables, _ = both
    rows = REPORTS["primary_hood_next_service_v3"].frame(tables, SETTINGS, ordered=True).collect()
    # No due date at all, then places without any visit, then calculated dates.
    shown = [(r["Calc Next Due Date"] is not None) + (r["Last Sched Job"] is not None or r["Last Compl Job"] is not None) * (r["Calc Next Due Date"] is not None) for r in rows]
    assert shown == sorted(shown)
    for part in (1, 2):
        days = [r["Calc Next Due Date"] for r, s in zip(rows, shown) if s == part]
        assert days == sorted(days)


ORDERS = {
    "open_deficiencies": lambda r: ({"inoperable": 1, "deficient": 2}.get(r.severity, 3), *last(-r.days_open if r.days_open is not None else None)),
    "revenue_monthly": lambda r: (flipped(r.year_month), *last(None if r.revenue is None else -r.revenue)),
    "quote_acceptance": lambda r: -r.total_quotes,
    "asset_inventory": lambda r: tuple((v is not None, v or "") for v in (r.customer, r.location, r.service_line, r.asset_type)),
    "compliance_overdue": lambda r: -r.days_overdue,
}


def last(v):
    return (v is None, v or 0)


def flipped(text):
    return [-ord(c) for c in text]


@pytest.mark.parametrize("name", list(ORDERS))
def test_ordered_reports(both, name):
    """Display order; NULLs come first going up and last going down."""
    rows = REPORTS[name].frame(both[0], SETTINGS, ordered=True).collect()
    keys = [ORDERS[name](r) for r in rows]
    assert keys == sorted(keys)


def test_stored_tables_give_the_same(both, spark, tmp_path):
    tables, _ = both
    for name in ("invoice", "company"):
        tables[name].write.parquet(f"{tmp_path}/{name}")
    stored = parquet_tables(spark, str(tmp_path))
    report = REPORTS["ar_aging"]
    assert sorted(map(tuple, report.frame(stored, SETTINGS).collect())) == sorted(map(tuple, report.frame(tables, SETTINGS).collect()))


def test_active_and_superseded_add_up(both):
    tables, _ = both
    versions = tables["service_recurrence"]
    current = versions.where("id = current_service_recurrence_id").count()
    rest = versions.where("not(id <=> current_service_recurrence_id)").count()
    assert current + rest == versions.count()


def test_buckets_add_up_to_the_total_without_due_date(both):
    tables, _ = both
    dated = tables.with_table("invoice", tables["invoice"].where("due_date is not null"))
    for r in REPORTS["ar_aging"].frame(dated, SETTINGS).collect():
        parts = r.current_due + r.days_1_30 + r.days_31_60 + r.days_61_90 + r.days_90_plus
        assert abs(parts - r.total_outstanding) < 0.05, plain(r)
