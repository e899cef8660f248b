"""Gold marts.

All marts are hash aggregates over (subsidiary, year, month)-like keys. Spark
plans them as partial (map-side) + final aggregates, so the shuffle carries
one row per group per input partition — a tenant holding a third of all rows
costs nothing extra. Money sums stay decimal (Spark widens sum(decimal(18,2))
to decimal(28,2), so no overflow at scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import to_double

KEYS = ["subsidiary_id", "fiscal_year", "fiscal_month"]


def group_pnl(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.groupBy(*KEYS).agg(
        F.sum("gross_amount").alias("revenue_gross"),
        F.sum("net_amount").alias("revenue_net"),
        F.sum("vat_amount").alias("output_vat"))


def group_pnl_consolidated(fact_sales: DataFrame) -> DataFrame:
    """Group P&L with subtotals per subsidiary/year and a grand total (ROLLUP).

    ``subsidiary_id`` NULL marks the consolidated (all subsidiaries) rows.
    """
    return fact_sales.rollup(*KEYS).agg(
        F.sum("gross_amount").alias("revenue_gross"),
        F.sum("net_amount").alias("revenue_net"),
        F.sum("vat_amount").alias("output_vat"),
        F.grouping_id().cast("int").alias("grouping_level"))


def exec_kpi(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.groupBy(*KEYS).agg(F.sum("net_amount").alias("revenue_net"))


def ap_monthly(fact_ap: DataFrame) -> DataFrame:
    return fact_ap.groupBy(*KEYS).agg(
        F.sum("gross_amount").alias("total_ap_gross"), F.sum("vat_amount").alias("total_ap_vat"),
        F.sum("net_amount").alias("total_ap_net"), F.sum("payment_amount").alias("total_ap_paid"))


def ar_monthly(fact_ar: DataFrame) -> DataFrame:
    return fact_ar.groupBy(*KEYS).agg(
        F.sum("gross_amount").alias("total_ar_gross"), F.sum("vat_amount").alias("total_ar_vat"),
        F.sum("net_amount").alias("total_ar_net"),
        F.sum("collected_amount").alias("total_ar_collected"))


def vat_monthly(fact_vat: DataFrame) -> DataFrame:
    return (fact_vat.groupBy("subsidiary_id", F.col("period_year").alias("fiscal_year"),
                             F.col("period_month").alias("fiscal_month"))
                    .agg(F.sum("taxable_sales").alias("total_taxable_sales"),
                         F.sum("output_vat").alias("total_output_vat"),
                         F.sum("input_vat").alias("total_input_vat"),
                         F.sum("vat_payable").alias("total_vat_payable")))


def financial_summary(ap: DataFrame, ar: DataFrame, vat: DataFrame) -> DataFrame:
    """Three-way full outer join of the monthly AP, AR and VAT aggregates.

    The inputs are already aggregated (one row per key), so both joins are
    small. NULL keys never match and pass through unmatched, as in SQL.
    """
    a, r, v = ap.alias("ap"), ar.alias("ar"), vat.alias("vat")
    cond1 = [F.col(f"ap.{k}") == F.col(f"ar.{k}") for k in KEYS]
    j = a.join(r, cond1, "full")
    j = j.select(*[F.coalesce(F.col(f"ap.{k}"), F.col(f"ar.{k}")).alias(k) for k in KEYS],
                 *[F.col(f"ap.{c}") for c in ap.columns if c not in KEYS],
                 *[F.col(f"ar.{c}") for c in ar.columns if c not in KEYS]).alias("j")
    cond2 = [F.col(f"j.{k}") == F.col(f"vat.{k}") for k in KEYS]
    out = j.join(v, cond2, "full")
    return out.select(*[F.coalesce(F.col(f"j.{k}"), F.col(f"vat.{k}")).alias(k) for k in KEYS],
                      *[F.col(f"j.{c}") for c in j.columns if c not in KEYS],
                      *[F.col(f"vat.{c}") for c in vat.columns if c not in KEYS])


def hr_headcount(dim_employees: DataFrame) -> DataFrame:
    """Average as sum/count in double (decimal avg scales differ by engine)."""
    return dim_employees.groupBy("subsidiary_id").agg(
        F.count(F.lit(1)).alias("headcount"),
        (to_double(F.sum("basic_salary")) / F.count("basic_salary")).alias("average_salary"),
        F.min("basic_salary").alias("min_salary"), F.max("basic_salary").alias("max_salary"))


def inventory_summary(fact_inv: DataFrame) -> DataFrame:
    """Grouped by the silver fiscal columns."""
    return fact_inv.groupBy("subsidiary_id", "movement_type", "fiscal_year", "fiscal_month").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("total_cost").alias("total_cost"))


def exec_kpi_view(exec_kpi_df: DataFrame) -> DataFrame:
    """The published KPI projection (net_revenue -> revenue_net)."""
    return exec_kpi_df.select(*KEYS, "revenue_net")
