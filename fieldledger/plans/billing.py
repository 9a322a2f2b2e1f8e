"""Invoices, quotes and revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.functions import dates
from fieldledger.operators.joins import lookup, without
from fieldledger.plans.report import report

C = F.col


def open_balance() -> Column:
    return C("total_price") - F.coalesce(C("total_paid_amount"), F.lit(0.0))


def cents(value: Column, digits: int = 2) -> Column:
    """Half away from zero. The first rounding removes the noise of adding doubles
    in another order, which would otherwise decide on exact half cents."""
    return F.round(F.round(value, 6), digits)


def count_where(test: Column) -> Column:
    return F.sum(F.when(test, 1).otherwise(0)).cast("bigint")


def customer_invoices(t) -> DataFrame:
    return t["invoice"].where((C("type") == "invoice") & (C("status") != "void"))


@report("ar_aging", "Receivables per customer in due-date buckets", "-total_outstanding")
def ar_aging(t, s) -> DataFrame:
    late = dates.whole_days(s.now - C("due_date"))

    def bucket(test: Column) -> Column:
        return cents(F.sum(F.when(test, open_balance()).otherwise(0.0)))

    per_customer = (
        customer_invoices(t)
        .where(C("is_paid") == 0)
        .groupBy("customer_id")
        .agg(
            F.count("id").alias("invoice_count"),
            cents(F.sum(open_balance())).alias("total_outstanding"),
            bucket(late <= 0).alias("current_due"),
            bucket(late.between(1, 30)).alias("days_1_30"),
            bucket(late.between(31, 60)).alias("days_31_60"),
            bucket(late.between(61, 90)).alias("days_61_90"),
            bucket(late > 90).alias("days_90_plus"),
        )
        .where(C("total_outstanding") > 0)
    )
    return lookup(per_customer, t["company"], "customer_id", {"name": "customer"}).select(
        "customer",
        "invoice_count",
        "total_outstanding",
        "current_due",
        "days_1_30",
        "days_31_60",
        "days_61_90",
        "days_90_plus",
    )


@report("avg_days_to_payment", "Days from invoice date to the last change of paid invoices", "-avg_days_to_payment")
def avg_days_to_payment(t, s) -> DataFrame:
    days = dates.whole_days(C("updated_at") - C("transaction_date"))
    per_customer = (
        t["invoice"]
        .where((C("is_paid") == 1) & (C("type") == "invoice") & C("transaction_date").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("id").alias("paid_invoices"),
            cents(F.avg(days), 1).alias("avg_days_to_payment"),
            F.min(days).alias("min_days"),
            F.max(days).alias("max_days"),
        )
    )
    return lookup(per_customer, t["company"], "customer_id", {"name": "customer"}).select(
        "customer", "paid_invoices", "avg_days_to_payment", "min_days", "max_days"
    )


@report("overdue_invoices", "Unpaid invoices past their due date", "-days_overdue")
def overdue_invoices(t, s) -> DataFrame:
    due = t["invoice"].where(
        (C("is_paid") == 0)
        & ~C("status").isin("void", "paid")
        & (C("type") == "invoice")
        & (C("due_date") < s.as_of)
    )
    return lookup(due, t["company"], "customer_id", {"name": "customer_name"}, "left").select(
        "id",
        "invoice_number",
        "customer_name",
        "total_price",
        "total_paid_amount",
        open_balance().alias("balance_due"),
        "status",
        dates.utc_day(C("due_date")).alias("due_date"),
        dates.whole_days(s.now - C("due_date")).alias("days_overdue"),
    )


@report("revenue_by_customer", "Invoiced, paid and outstanding money per customer", "-total_invoiced")
def revenue_by_customer(t, s) -> DataFrame:
    per_customer = (
        customer_invoices(t)
        .groupBy("customer_id")
        .agg(
            F.count("id").alias("invoice_count"),
            cents(F.sum("total_price")).alias("total_invoiced"),
            cents(F.sum("total_paid_amount")).alias("total_paid"),
            cents(F.sum(open_balance())).alias("total_outstanding"),
        )
    )
    named = lookup(per_customer, t["company"], "customer_id", {"name": "customer", "status": "customer_status"})
    return named.select(
        "customer", "customer_status", "invoice_count", "total_invoiced", "total_paid", "total_outstanding"
    )


@report("revenue_monthly", "Revenue per month and service line", "-year_month", "-revenue")
def revenue_monthly(t, s) -> DataFrame:
    # Items shrink to one row per (invoice, line) on bare keys before they move, so neither an
    # invoice of very many items nor a line that most items have fills a task. They meet their
    # invoice next; names come last, and one row per (invoice, name) makes the distinct count plain.
    per_line = t["invoice_item"].groupBy("invoice_id", "service_line_id").agg(F.sum("subtotal").alias("amount"))
    dated = customer_invoices(t).where(C("transaction_date").isNotNull())
    billed = lookup(per_line, dated, "invoice_id", {"transaction_date": "at"})
    lined = lookup(billed, t["service_line"], "service_line_id", {"name": "line_name"}, "left")
    return (
        lined.groupBy("invoice_id", "at", F.coalesce(C("line_name"), F.lit("Unassigned")).alias("service_line"))
        .agg(F.sum("amount").alias("amount"))
        .groupBy(dates.year_month_text(C("at")).alias("year_month"), "service_line")
        .agg(F.count(F.lit(1)).alias("invoice_count"), cents(F.sum("amount")).alias("revenue"))
        .select(
            "year_month",
            F.substring("year_month", 1, 4).alias("year"),
            F.substring("year_month", 6, 2).alias("month"),
            "service_line",
            "invoice_count",
            "revenue",
        )
    )


@report("quote_acceptance", "Quote outcomes per customer", "-total_quotes")
def quote_acceptance(t, s) -> DataFrame:
    status = C("status")
    per_customer = (
        t["quote"]
        .groupBy("customer_id")
        .agg(
            F.count("id").alias("total_quotes"),
            count_where(status == "accepted").alias("accepted"),
            count_where(status == "rejected").alias("rejected"),
            count_where(status == "submitted").alias("pending"),
            count_where(status.isin("draft", "new")).alias("draft"),
            count_where(status == "canceled").alias("canceled"),
            cents(F.sum(F.when(status == "accepted", C("total_price")).otherwise(0.0))).alias("accepted_value"),
        )
    )
    rate = F.try_divide(100.0 * C("accepted"), C("accepted") + C("rejected"))
    return lookup(per_customer, t["company"], "customer_id", {"name": "customer"}).select(
        "customer",
        "total_quotes",
        "accepted",
        "rejected",
        "pending",
        "draft",
        "canceled",
        cents(rate, 1).alias("acceptance_rate_pct"),
        "accepted_value",
    )


@report("stale_quotes", "Open quotes nobody touched for 30 days", "-days_stale")
def stale_quotes(t, s) -> DataFrame:
    # The age test is written on the bare columns, so the scan can skip by it.
    limit = s.as_of - 30 * dates.DAY
    touched, made = C("latest_submission"), C("created_at")
    stale = t["quote"].where(
        C("status").isin("submitted", "draft", "new")
        & ((touched.isNotNull() & (touched <= limit)) | (touched.isNull() & (made <= limit)))
    )
    named = lookup(stale, t["company"], "customer_id", {"name": "customer"})
    placed = lookup(named, t["location"], "location_id", {"name": "location", "address_city": "city"}, "left")
    return placed.select(
        "customer",
        "location",
        "city",
        C("name").alias("quote_name"),
        "status",
        "substatus",
        cents(C("total_price")).alias("quote_value"),
        dates.utc_day(touched).alias("last_submitted"),
        dates.utc_day(made).alias("created_on"),
        dates.whole_days(s.now - F.coalesce(touched, made)).alias("days_stale"),
        dates.utc_day(C("expires_on")).alias("expires_on"),
    )


def unbilled(t, s, jobs: DataFrame) -> DataFrame:
    named = lookup(jobs, t["company"], "customer_id", {"name": "customer"})
    placed = lookup(named, t["location"], "location_id", {"name": "location", "address_city": "city"}, "left")
    return placed.select(
        "customer",
        "location",
        "city",
        C("number").alias("job_number"),
        C("name").alias("job_name"),
        C("type").alias("job_type"),
        "status",
        "service_line",
        dates.utc_day(C("completed_on")).alias("completed_on"),
        dates.whole_days(s.now - C("completed_on")).alias("days_since_completed"),
        cents(C("estimated_price")).alias("estimated_price"),
    )


@report("jobs_pending_invoice", "Jobs waiting in a billing state", "-days_since_completed")
def jobs_pending_invoice(t, s) -> DataFrame:
    return unbilled(t, s, t["job"].where(C("status").isin("pending_invoice", "sending_invoice")))


@report("jobs_without_invoice", "Completed jobs that were never billed", "-days_since_completed")
def jobs_without_invoice(t, s) -> DataFrame:
    done = t["job"].where((C("status") == "completed") & C("completed_on").isNotNull())
    return unbilled(t, s, without(done, customer_invoices(t), "id", "job_id")).drop("status")
