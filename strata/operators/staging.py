"""Staging models, bronze -> ``stg_*`` column-pruning projections.

Each model is a list of ``(output_column, source)``: ``source`` is the bronze
column (same name when ``None``) or a type string for a column the bronze DDL
does not have (typed NULL, decision D1). Projections are pure ``select``s, so
Catalyst prunes the scan to exactly these columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources.lake import Lake

_NULL = "null:"  # marker: "null:<type>" = column absent from bronze, typed NULL


def _n(t):
    return _NULL + t


# Staged column lists per model (bronze table, columns).
STAGING: dict[str, tuple[str, list]] = {
    "stg_employees": ("employees", [
        "subsidiary_id", "employee_id", "first_name", "last_name", "tin", "sss_number",
        "philhealth_number", "pagibig_number", "department", "position", "employment_type",
        "date_hired", "basic_salary", "ingested_at"]),
    "stg_finance__ap_invoices": ("ap_invoices", [
        "subsidiary_id", "invoice_number", "vendor_id", "vendor_name", "vendor_tin",
        "invoice_date", "due_date", "gross_amount", "vat_amount", "net_amount", "wht_amount",
        "payment_amount", "payment_date", "status", "is_interco", "counterpart_sub_id",
        "ingested_at"]),
    "stg_finance__ar_ledger": ("ar_ledger", [
        "subsidiary_id", "invoice_number", "customer_id", "customer_name", "customer_tin",
        "invoice_date", "due_date", "gross_amount", "vat_amount", "net_amount",
        "collected_amount", "collection_date", "status", "is_interco", "counterpart_sub_id",
        "ingested_at"]),
    "stg_finance__journal_entries": ("journal_entries", [
        "subsidiary_id", "entry_date", "entry_number", "account_code", "account_name",
        "debit_amount", "credit_amount", "description", "reference_doc", "is_interco",
        "counterpart_sub_id", "cost_center", "posted_by", "approved_by", "ingested_at"]),
    "stg_hr__payroll_runs": ("payroll_runs", [
        "subsidiary_id", "employee_id", "payroll_period", "gross_pay", "total_deductions",
        "net_pay", ("sss_ee", _n("decimal(18,2)")), ("philhealth_ee", _n("decimal(18,2)")),
        ("pagibig_ee", _n("decimal(18,2)")), ("wht", _n("decimal(18,2)")), "ingested_at"]),
    "stg_hr__statutory_contributions": ("statutory_contributions", [
        "subsidiary_id", "period_month", "period_year", ("sss_er_amount", "sss_employer"),
        ("philhealth_er_amount", "philhealth_employer"), ("pagibig_er_amount", "pagibig_employer"),
        ("ec_life_insurance_amount", _n("decimal(18,2)")), ("remittance_date", _n("date")),
        ("status", _n("string")), "total_amount", "ingested_at"]),
    "stg_it_audit__audit_log": ("audit_log", [
        "subsidiary_id", "event_timestamp", "user_id", "action", "result", "risk_level",
        "ingested_at"]),
    "stg_itaudit__access_events": ("access_events", [
        "subsidiary_id", "event_timestamp", "user_id", "action", "resource", "resource_id",
        "ip_address", "result", "ingested_at"]),
    "stg_itaudit__system_incidents": ("system_incidents", [
        "subsidiary_id", "incident_id", "incident_date", "incident_type", "severity",
        "description", "resolved_date", "ingested_at"]),
    "stg_legal__board_resolutions": ("board_resolutions", [
        "subsidiary_id", "resolution_number", "resolution_date", ("subject", "title"),
        ("description", _n("string")), ("status", _n("string")), "ingested_at"]),
    "stg_legal__officers": ("officers", [
        "subsidiary_id", ("officer_name", "name"), ("tin", _n("string")), "position",
        ("appointment_date", "start_date"), ("status", _n("string")), "ingested_at"]),
    "stg_legal__sec_filings": ("sec_filings", [
        "subsidiary_id", "filing_type", "due_date", "filing_date", "status", "reference_number",
        "ingested_at"]),
    "stg_legal__stockholders": ("stockholders", [
        "subsidiary_id", ("stockholder_name", "name"), ("tin", _n("string")),
        ("address", _n("string")), ("shares_owned", _n("bigint")), "ownership_pct", "is_foreign",
        "ingested_at"]),
    "stg_ops__inventory_movements": ("inventory_movements", [
        "subsidiary_id", "movement_date", "movement_type", "item_code", "quantity", "unit_cost",
        "total_cost", "warehouse_location", "reference_doc", "ingested_at"]),
    "stg_ops__purchase_orders": ("purchase_orders", [
        "subsidiary_id", "po_number", "vendor_id", ("po_date", "order_date"),
        ("delivery_date", "expected_date"), "total_amount", "status", "ingested_at"]),
    "stg_ops__sales_orders": ("sales_orders", [
        "subsidiary_id", "so_number", "customer_id", ("so_date", "order_date"),
        ("delivery_date", "ship_date"), "total_amount", "status", "ingested_at"]),
    "stg_procurement__vendors": ("vendors", [
        "subsidiary_id", "vendor_id", "vendor_name", "vendor_tin", "vendor_type",
        "payment_terms", "is_accredited", "ingested_at"]),
    "stg_procurement__wht_certificates": ("wht_certificates", [
        "subsidiary_id", "vendor_id", ("certificate_number", "cert_number"), "income_payment",
        ("tax_withheld", "wht_amount"), "tax_rate", ("cert_date", "issued_date"),
        ("status", _n("string")), "ingested_at"]),
    "stg_sales__campaigns": ("campaigns", [
        "subsidiary_id", "campaign_id", "campaign_name", "campaign_type", "channel",
        "start_date", "end_date", "budget_amount", "actual_spend", "leads_generated",
        "conversions", "revenue_attributed", "status", "ingested_at"]),
    "stg_sales__customers": ("customers", [
        "subsidiary_id", "customer_id", "customer_name", ("tin", "customer_tin"),
        ("address", _n("string")), ("industry", _n("string")),
        ("credit_limit", _n("decimal(18,2)")), "is_active", "ingested_at"]),
    "stg_sales_transactions": ("sales_transactions", [
        "subsidiary_id", "invoice_number", "customer_name", ("invoice_date", "transaction_date"),
        "gross_amount", "discount_amount", "vat_amount", "net_amount", "vat_classification",
        "is_interco", "counterpart_sub_id", "ingested_at"]),
    "stg_tax__bir_filings_log": ("bir_filings_log", [
        "subsidiary_id", "form_type", "period_covered", "due_date", "filing_date", "amount_paid",
        "surcharge_amount", "interest_amount", "compromise_amount", "penalty_amount", "efps_ref",
        "payment_mode", "status", "ingested_at"]),
    "stg_tax__vat_returns": ("vat_returns", [
        "subsidiary_id", "period_month", "period_year", "form_type", "gross_sales",
        "exempt_sales", "zero_rated_sales", "taxable_sales", "output_vat", "input_vat",
        "vat_payable", "filing_date", "efps_confirmation", "status", "ingested_at"]),
    "stg_tax__wht_filings": ("wht_filings", [
        "subsidiary_id", "form_type", "period_month", "period_year", "payee_tin", "payee_name",
        "income_payment", "atc_code", "tax_rate", "wht_amount", "filing_date",
        "efps_confirmation", "status", "ingested_at"]),
}


def columns_of(model: str) -> list[tuple[str, str]]:
    """[(output, source)] where source is a bronze column or ``null:<type>``."""
    out = []
    for c in STAGING[model][1]:
        out.append((c, c) if isinstance(c, str) else c)
    return out


def project(df: DataFrame, model: str) -> DataFrame:
    cols = []
    for out, src in columns_of(model):
        if src.startswith(_NULL):
            cols.append(F.lit(None).cast(src[len(_NULL):]).alias(out))
        else:
            cols.append(F.col(src).alias(out))
    return df.select(*cols)


def stage(lake: Lake, model: str, include_deleted: bool = False) -> DataFrame:
    table = STAGING[model][0]
    return project(lake.bronze(table, include_deleted=include_deleted), model)
