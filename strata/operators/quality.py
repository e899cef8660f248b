"""Q1-Q6 data-quality checks and arithmetic rules.

Every check returns rows of one shape — ``model, check_name, column_name,
failures, status`` — so a quality report is a plain union. Checks on the same
table are folded into one aggregate (one scan for all NOT NULL columns,
one for all accepted-value lists); uniqueness and foreign keys aggregate per
key first, so a hot key is one row before any join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import MONEY, rate_of

RESULT_COLS = ["model", "check_name", "column_name", "failures", "status"]

# Declared column tests (model -> not_null columns, unique key).
# Uniqueness is tested on the per-subsidiary composite key (decision D11).
NOT_NULL_TESTS = {
    "stg_employees": ["subsidiary_id", "employee_id", "first_name", "last_name"],
    "stg_sales_transactions": ["invoice_number", "invoice_date", "gross_amount"],
    "stg_finance__journal_entries": ["entry_number", "debit_amount", "credit_amount"],
    "stg_finance__ap_invoices": ["invoice_number", "invoice_date"],
    "stg_finance__ar_ledger": ["invoice_number", "invoice_date"],
    "stg_tax__vat_returns": ["period_month", "period_year"],
    "stg_ops__inventory_movements": ["movement_date"],
    "stg_procurement__vendors": ["vendor_id"],
    "stg_legal__sec_filings": ["filing_type"],
    "stg_it_audit__audit_log": ["event_timestamp"],
}
UNIQUE_TESTS = {
    "stg_employees": ["subsidiary_id", "employee_id"],
    "stg_sales_transactions": ["subsidiary_id", "invoice_number"],
    "stg_finance__journal_entries": ["subsidiary_id", "entry_number"],
    "stg_finance__ap_invoices": ["subsidiary_id", "invoice_number"],
    "stg_finance__ar_ledger": ["subsidiary_id", "invoice_number"],
    "stg_procurement__vendors": ["subsidiary_id", "vendor_id"],
}


def _status(failures: Column) -> Column:
    return F.when(failures == 0, "pass").otherwise("fail")


def _result(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c) for c in RESULT_COLS[:4]], _status(F.col("failures")).alias("status"))


def _unpivot(one_row: DataFrame, model: str, check: str, names: list[str]) -> DataFrame:
    """One aggregated row with a column per check -> one row per check."""
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return _result(one_row.select(
        F.lit(model).alias("model"), F.lit(check).alias("check_name"),
        F.expr(f"stack({len(names)}, {pairs}) as (column_name, failures)")))


def assert_not_null(df: DataFrame, model: str, cols: list[str]) -> DataFrame:
    """Q1: NULL count per column — all columns in one scan."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot(agg, model, "not_null", cols)


def assert_unique(df: DataFrame, model: str, keys: list[str]) -> DataFrame:
    """Q2: number of key values that occur more than once (NULL keys ignored)."""
    nonnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    dup = (df.filter(nonnull).groupBy(*keys).count().filter(F.col("count") > 1)
             .agg(F.count(F.lit(1)).alias("failures")))
    return _result(dup.select(F.lit(model).alias("model"), F.lit("unique").alias("check_name"),
                              F.lit(",".join(keys)).alias("column_name"), "failures"))


def future_dated(df: DataFrame, col: str, as_of: str) -> DataFrame:
    """rows dated after ``as_of``."""
    return df.filter(F.col(col) > F.lit(as_of).cast("date"))


def assert_no_future(df: DataFrame, model: str, col: str, as_of: str) -> DataFrame:
    """Q3: count of rows dated after ``as_of``."""
    n = df.agg(F.count_if(F.col(col) > F.lit(as_of).cast("date")).alias("failures"))
    return _result(n.select(F.lit(model).alias("model"), F.lit("no_future_dates").alias("check_name"),
                            F.lit(col).alias("column_name"), "failures"))


def assert_accepted(df: DataFrame, model: str, accepted: dict[str, list[str]]) -> DataFrame:
    """Q4: values outside the accepted list (NULL passes), all columns in one scan."""
    agg = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(v)).alias(c)
                   for c, v in accepted.items()])
    return _unpivot(agg, model, "accepted_values", list(accepted))


def assert_expression(df: DataFrame, model: str, name: str, ok: Column) -> DataFrame:
    """Q4: rows where the boolean expression is false (NULL counts as true, like CHECK)."""
    n = df.agg(F.count_if(~F.coalesce(ok, F.lit(True))).alias("failures"))
    return _result(n.select(F.lit(model).alias("model"), F.lit("expression").alias("check_name"),
                            F.lit(name).alias("column_name"), "failures"))


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Q5 detail: child key values (with their row counts) missing from the parent.

    The child is aggregated per key before the anti join, so a key shared by
    a third of all rows is one row on the join.
    """
    nonnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    c = child.filter(nonnull).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return c.join(parent.select(*keys).distinct(), keys, "left_anti")


def assert_fk(child: DataFrame, parent: DataFrame, model: str, keys: list[str],
              parent_name: str) -> DataFrame:
    """Q5: child rows whose key has no parent row."""
    n = orphans(child, parent, keys).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))
    return _result(n.select(F.lit(model).alias("model"), F.lit(f"fk:{parent_name}").alias("check_name"),
                            F.lit(",".join(keys)).alias("column_name"), "failures"))


def run_checks(results: list[DataFrame]) -> DataFrame:
    """Q6: one quality report from any number of check results."""
    return reduce(lambda a, b: a.unionByName(b), results)


# ---------------------------------------------------------------------------
# Arithmetic rules: each a predicate that must hold for every row.
# ---------------------------------------------------------------------------
def _eq(a: Column, b: Column) -> Column:
    return a.cast(MONEY) == b.cast(MONEY)


def arithmetic_rules() -> dict[str, tuple[str, Column]]:
    """rule id -> (table, predicate that must be true)."""
    g = F.col("gross_amount")
    return {
        "R2_ap_vat": ("ap_invoices", _eq(F.col("vat_amount"), rate_of(g, "0.12"))),
        "R2_ap_net": ("ap_invoices", _eq(F.col("net_amount"), g - F.col("vat_amount"))),
        "R2_ap_wht": ("ap_invoices", _eq(F.col("wht_amount"), rate_of(g, "0.01"))),
        "R3_ar_vat": ("ar_ledger", _eq(F.col("vat_amount"), rate_of(g, "0.12"))),
        "R3_ar_net": ("ar_ledger", _eq(F.col("net_amount"), g - F.col("vat_amount"))),
        "R3_ar_collected": ("ar_ledger", F.col("collected_amount").isNull()
                            | F.col("collected_amount").between(g * F.lit("0.2").cast("decimal(2,1)"), g)),
        "R4_sales_discount": ("sales_transactions",
                              _eq(F.col("discount_amount"), rate_of(g, "0.02"))),
        "R4_sales_vat": ("sales_transactions",
                         _eq(F.col("vat_amount"), rate_of(g - F.col("discount_amount"), "0.12"))),
        "R4_sales_net": ("sales_transactions",
                         _eq(F.col("net_amount"), g - F.col("discount_amount") + F.col("vat_amount"))),
        "R5_vat_payable": ("vat_returns",
                           _eq(F.col("vat_payable"), F.col("output_vat") - F.col("input_vat"))),
        "R6_wht_amount": ("wht_filings",
                          _eq(F.col("wht_amount"),
                              F.round(F.col("income_payment") * F.col("tax_rate"), 2))),
        "R6_wht_rate": ("wht_filings", F.col("tax_rate").isin(
            F.lit("0.01").cast("decimal(6,4)"), F.lit("0.02").cast("decimal(6,4)"),
            F.lit("0.05").cast("decimal(6,4)"))),
        "R7_payroll_deductions": ("payroll_runs", _eq(
            F.col("total_deductions"), rate_of("gross_pay", "0.08") + rate_of("gross_pay", "0.03")
            + rate_of("gross_pay", "0.02"))),
        "R7_payroll_net": ("payroll_runs",
                           _eq(F.col("net_pay"), F.col("gross_pay") - F.col("total_deductions"))),
        "R8_statutory_total": ("statutory_contributions", _eq(
            F.col("total_amount"), F.col("sss_employer") + F.col("sss_employee")
            + F.col("philhealth_employer") + F.col("philhealth_employee")
            + F.col("pagibig_employer") + F.col("pagibig_employee"))),
        "R9_stock_value": ("inventory_movements",
                           _eq(F.col("total_cost"), F.col("quantity") * F.col("unit_cost"))),
        "R14_penalty": ("bir_filings_log", _eq(
            F.col("penalty_amount"), F.col("surcharge_amount") + F.col("interest_amount")
            + F.col("compromise_amount"))),
    }


def report_rules() -> dict[str, tuple[str, Column]]:
    """rule id -> (table or report, predicate that must be true): single journal lines, and totals against their buckets."""
    buckets = F.col("current") + F.col("aging_31_60") + F.col("aging_61_90") + F.col("aging_over_90")
    adds_up = _eq(F.col("total_outstanding"), buckets)
    return {
        "R1_line": ("journal_entries", _eq(F.col("debit_amount"), F.col("credit_amount"))),
        "R10_ap_total": ("ap_aging_detail", adds_up),
        "R10_ar_total": ("ar_aging", adds_up),
    }


def check_shares(df: DataFrame, model: str, group: str = "subsidiary_id", shares: str = "ownership_pct") -> DataFrame:
    """How many groups have shares that do not sum to 100 (a null share counts as 0, an empty table has no group). The groups
    are aggregated with map-side partials; no group is collected."""
    total = df.groupBy(group).agg(F.coalesce(F.sum(shares), F.lit(0)).alias("_total"))
    return _unpivot(total.agg(F.count_if(F.col("_total") != 100).alias("R11_shares")), model, "arithmetic", ["R11_shares"])


def journal_balanced(journal: DataFrame) -> DataFrame:
    """R1 (per document): debits equal credits for every source document."""
    return (journal.groupBy("subsidiary_id", "reference_doc")
                   .agg(F.sum("debit_amount").alias("debits"), F.sum("credit_amount").alias("credits"))
                   .filter(F.col("debits") != F.col("credits")))


def check_arithmetic(df: DataFrame, table: str, rules: dict[str, tuple[str, Column]] | None = None
                     ) -> DataFrame:
    """Violation counts of every rule of ``table`` in one scan."""
    rules = {k: v for k, v in (rules or arithmetic_rules()).items() if v[0] == table}
    agg = df.agg(*[F.count_if(~F.coalesce(p, F.lit(False))).alias(k) for k, (_t, p) in rules.items()])
    return _unpivot(agg, table, "arithmetic", list(rules))
