"""Silver facts and dimensions (full refresh projections)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import fiscal_month, fiscal_year, mask_tin
from strata.operators.staging import stage
from strata.sources.lake import Lake


def _with_fiscal(df: DataFrame, date_col: str, start_month: int = 1) -> DataFrame:
    return df.select("*", fiscal_year(date_col, start_month).alias("fiscal_year"),
                     fiscal_month(date_col, start_month).alias("fiscal_month"))


def with_fiscal_calendar(df: DataFrame, date_col: str, subsidiaries: DataFrame) -> DataFrame:
    """X1/X2 per tenant: fiscal year and month from each subsidiary's
    ``fiscal_year_start`` (1 = calendar year). The subsidiaries table has one
    row per tenant (registry-bounded), so it is broadcast."""
    starts = subsidiaries.select("subsidiary_id", F.col("fiscal_year_start").alias("_start"))
    d = F.col(date_col)
    start = F.coalesce(F.col("_start"), F.lit(1))
    j = df.join(F.broadcast(starts), "subsidiary_id", "left")
    return (j.withColumn("fiscal_year", F.year(d) + F.when((start > 1) & (F.month(d) >= start), 1)
                         .otherwise(0))
             .withColumn("fiscal_month", F.pmod(F.month(d) - start, 12) + 1)
             .drop("_start"))


def dim_employees(lake: Lake) -> DataFrame:
    """TIN hashed; government ids and ingested_at dropped."""
    s = stage(lake, "stg_employees")
    return s.select("subsidiary_id", "employee_id", "first_name", "last_name",
                    mask_tin("tin").alias("tin_hashed"), "department", "position",
                    "employment_type", "date_hired", "basic_salary")


def dim_vendors(lake: Lake, mask: bool = False) -> DataFrame:
    """Vendor TIN stays in clear for parity (D9); ``mask=True`` hashes it."""
    s = stage(lake, "stg_procurement__vendors")
    tin = mask_tin("vendor_tin").alias("vendor_tin_hashed") if mask else F.col("vendor_tin")
    return s.select("subsidiary_id", "vendor_id", "vendor_name", tin, "vendor_type",
                    "payment_terms", "is_accredited", "ingested_at")


def fact_ap_invoices(lake: Lake) -> DataFrame:
    s = stage(lake, "stg_finance__ap_invoices").drop("vendor_tin")
    return _with_fiscal(s, "invoice_date")


def fact_ar_ledger(lake: Lake) -> DataFrame:
    s = stage(lake, "stg_finance__ar_ledger").drop("customer_tin")
    return _with_fiscal(s, "invoice_date")


def fact_finance_journal_entries(lake: Lake) -> DataFrame:
    return _with_fiscal(stage(lake, "stg_finance__journal_entries"), "entry_date")


def fact_inventory_movements(lake: Lake) -> DataFrame:
    return _with_fiscal(stage(lake, "stg_ops__inventory_movements"), "movement_date")


def fact_sales(lake: Lake) -> DataFrame:
    return _with_fiscal(stage(lake, "stg_sales_transactions"), "invoice_date")


def fact_tax_vat_returns(lake: Lake) -> DataFrame:
    return stage(lake, "stg_tax__vat_returns").drop("efps_confirmation")


SILVER = {
    "dim_employees": dim_employees, "dim_vendors": dim_vendors,
    "fact_ap_invoices": fact_ap_invoices, "fact_ar_ledger": fact_ar_ledger,
    "fact_finance_journal_entries": fact_finance_journal_entries,
    "fact_inventory_movements": fact_inventory_movements, "fact_sales": fact_sales,
    "fact_tax_vat_returns": fact_tax_vat_returns,
}
