"""Fixed table layouts: column names, types and column comments.

Names follow one convention, so types come from a rule: ``*_id``, the epoch
seconds columns, 0/1 flags and counters are integers, money and measures are
doubles, everything else is text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Table columns, in stored order.
TABLE_COLUMNS = {
    "service_line": "id name trade abbr icon_url",
    "tag": "id name",
    "payment_terms": "id name order_index",
    "company": (
        "id name status ref_number is_customer is_vendor is_parts_vendor is_prime_contractor"
        " address_street address_city address_state address_postal phone default_brand_id"
        " created_at updated_at external_ids"
    ),
    "location": (
        "id name ref_number legacy_id lat lon phone email primary_contact_id address_street"
        " address_city address_state address_postal taxable status tax_group_id geocode_quality"
        " general_manager created_at updated_at store_number company_id brand_id remit_to_source"
        " external_ids"
    ),
    "contact": (
        "id first_name last_name phone mobile alternate_phone email types status created_at"
        " updated_at external_ids"
    ),
    "job": (
        "id name custom_name type job_type_weight status display_status substatus visibility"
        " section_visibilities number ref_number customer_po description scheduled_date"
        " latest_clock_in ivr_open ivr_activity service_line estimated_price due_by due_after"
        " completed_on vendor_id customer_id location_id owner_id sales_id primary_contact_id"
        " assigned_office_id created_at updated_at percent_complete is_project"
        " service_link_attachment_visibility service_link_comment_visibility"
        " service_link_attachment_category_visibility budgeted current_appointment_id external_ids"
        " terms_id contract_id project_id"
    ),
    "appointment": (
        "id name status window_start window_end location_id vendor_id job_id due_by released"
        " created_at updated_at"
    ),
    "invoice": (
        "id name type status substatus invoice_number ref_number tax_amount subtotal total_price"
        " total_paid_amount location_id job_id visibility assigned_user_id customer_id vendor_id"
        " customer_po notes partial is_paid is_sent transaction_date contract_id"
        " assigned_office_id payment_terms_id due_date created_at updated_at"
    ),
    "invoice_item": (
        "invoice_id id description quantity price subtotal tax_group_id tax_rate tax_rate_details"
        " tax_amount total_price order_index lib_item_id service_line_id job_item_id"
        " service_request_id created_at updated_at"
    ),
    "quote": (
        "id name ref_number status notes customer_id vendor_id location_id deficiency_severity"
        " deficiency_jobs respond_by expires_on latest_submission latest_accepted created_at"
        " updated_at subtotal tax_amount total_price quote_request_id contract_id assigned_to_id"
        " owner_id sales_id substatus visibility customer_po customer_po_required terms_id"
        " assigned_office_id description job_type tasking_detail_level"
        " quote_link_attachment_visibility quote_link_comment_visibility section_visibilities"
        " external_ids"
    ),
    "quote_item": (
        "quote_id id description lib_item_id service_line_id service_request_id price quantity"
        " tax_rate tax_rate_details cost visibility"
    ),
    "asset": (
        "id type name location_id service_line_id legacy_id status display properties parent_id"
        " created_at updated_at order_index asset_definition_id is_abstract_group"
        " has_active_task_list external_ids"
    ),
    "deficiency": (
        "id ref_number reported_on severity title status last_reported_status resolution"
        " report_source description proposed_fix owner_id sales_id reporter_id asset_id"
        " location_id service_line_id job_id visibility created_at updated_at external_ids"
    ),
    "service_recurrence": (
        "id description service_line_id asset_id location_id first_start first_end frequency"
        " interval frequency_category scheduling_type repeat_weekday ends_on parent_id contract_id"
        " preferred_vendor_id estimated_price duration preferred_start_time created_at updated_at"
        " currently_due current_service_recurrence_id"
    ),
    "service_request": (
        "id status description service_line_id asset_id location_id job_id deficiency_id"
        " change_order_id budget_id contract_id window_start window_end closed_on created_at"
        " updated_at service_recurrence_id preferred_vendor_id estimated_price duration"
        " preferred_start_time visibility original_window_start original_window_end"
        " service_link_attachment_visibility service_link_comment_visibility"
        " quote_link_attachment_visibility quote_link_comment_visibility"
        " service_link_attachment_category_visibility"
    ),
    "user": (
        "id name status email is_tech is_helper first_name last_name username phone timezone"
        " is_sales company_id location_id manager_id details activities mfa_required created_at"
        " updated_at external_ids"
    ),
    "sync_status": (
        "resource last_synced_at last_synced_at_dt last_run_at last_run_at_dt record_count"
    ),
    "sync_log": (
        "id resource started_at started_at_dt finished_at finished_at_dt status records_fetched"
        " records_upserted error_message"
    ),
}

# Epoch-seconds columns.
TIMESTAMP_COLUMNS = frozenset(
    "created_at updated_at scheduled_date latest_clock_in due_by due_after completed_on"
    " window_start window_end transaction_date due_date respond_by expires_on latest_submission"
    " latest_accepted reported_on first_start first_end ends_on currently_due closed_on"
    " original_window_start original_window_end last_synced_at last_run_at started_at"
    " finished_at".split()
)

# Integer and double columns that the naming rule cannot tell.
INTEGER_COLUMNS = frozenset(
    "id order_index taxable geocode_quality job_type_weight number ivr_open percent_complete"
    " budgeted released partial customer_po_required has_active_task_list interval"
    " repeat_weekday duration preferred_start_time mfa_required record_count records_fetched"
    " records_upserted service_link_attachment_visibility service_link_comment_visibility"
    " quote_link_attachment_visibility quote_link_comment_visibility".split()
)
DOUBLE_COLUMNS = frozenset(
    "lat lon estimated_price tax_amount subtotal total_price total_paid_amount quantity price"
    " tax_rate cost".split()
)

# Allowed texts of status-like columns, kept as column comments.
COLUMN_COMMENTS = {
    ("company", "status"): "active|pending|inactive|on_hold",
    ("location", "status"): "active|inactive|pending",
    ("contact", "status"): "public|private|inactive",
    ("job", "status"): (
        "new|scheduled|canceled|bidding|completed|pending_invoice|sending_invoice|invoiced|closed"
    ),
    ("appointment", "status"): (
        "scheduled|unscheduled|canceled_by_vendor|canceled_by_customer|completed|no_show"
    ),
    ("invoice", "status"): (
        "ok|internal_review|pending_accounting|processed|paid|sent|failed|void"
    ),
    ("quote", "status"): "accepted|canceled|draft|new|rejected|submitted",
    ("asset", "status"): "active|inactive",
    ("deficiency", "status"): "new|invalid|verified|fixed",
    ("user", "status"): "active|inactive",
    ("job", "type"): "cleaning|inspection|repair|construction|upgrade|etc",
    ("invoice", "type"): "invoice|vendorbill|external|unknown",
    ("deficiency", "severity"): "suggested|deficient|inoperable",
    ("deficiency", "resolution"): "new|invalid|fixed|out_for_quote|notified|rejected",
    ("deficiency", "report_source"): "manual|lsn|ivr|mobile|jcw",
    ("service_recurrence", "frequency"): "daily|weekly|monthly|yearly|null(task_list)",
    ("service_recurrence", "scheduling_type"): "default|task_list",
    ("sync_log", "status"): "success|partial|skipped|failed",
}

# Feed names whose table name is spelled differently.
TABLE_NAMES = {
    "serviceline": "service_line",
    "invoiceitem": "invoice_item",
    "quoteitem": "quote_item",
    "servicerecurrence": "service_recurrence",
    "servicerecurrenceitem": "service_recurrence_item",
    "servicerequest": "service_request",
    "paymentterms": "payment_terms",
    "taxrate": "tax_rate",
}

STATIC_TABLES = ("service_line", "tag", "payment_terms")
CHILD_TABLES = {"invoice_item": "invoice", "quote_item": "quote"}
KEY_COLUMN = {"sync_status": "resource"}


def table_name(feed: str) -> str:
    return TABLE_NAMES.get(feed, feed)


def resolve_table(name: str) -> str | None:
    """Table for a user-typed name: a feed, a table, or either without underscores."""
    squeezed = name.replace("_", "")
    for table in TABLE_COLUMNS:
        if name == table or squeezed == table.replace("_", ""):
            return table
    return None


def key_column(table: str) -> str:
    return KEY_COLUMN.get(table, "id")


def column_type(name: str) -> T.DataType:
    if name in DOUBLE_COLUMNS:
        return T.DoubleType()
    if name in TIMESTAMP_COLUMNS or name in INTEGER_COLUMNS:
        return T.LongType()
    if re.search(r"_id$|^is_", name):
        return T.LongType()
    return T.StringType()


def table_schema(table: str) -> T.StructType:
    fields = []
    for name in TABLE_COLUMNS[table].split():
        comment = COLUMN_COMMENTS.get((table, name))
        fields.append(T.StructField(name, column_type(name), True, {"comment": comment} if comment else {}))
    return T.StructType(fields)


def timestamp_columns(table: str) -> list[str]:
    return [n for n in TABLE_COLUMNS[table].split() if n in TIMESTAMP_COLUMNS]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Exactly the table's columns: unknown ones dropped, missing ones NULL."""
    return fit(df, table_schema(table))


def fit(df: DataFrame, layout: T.StructType) -> DataFrame:
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"TRY_CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in layout.fields
        ]
    )
