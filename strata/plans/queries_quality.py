"""Catalogue entries: filters, data quality, reconciliation, ingest and DML."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from strata.operators import changes, checks, filters, gold, quality, recon, reports, silver
from strata.operators.staging import STAGING, columns_of, stage
from strata.plans.catalog import query
from strata.schemas import CAMPAIGN_STATUSES, CAMPAIGN_TYPES, TABLES
from strata.sources import store
from strata.sources.landing import form_codes

# Catalogue dates.
AS_OF = "2000-12-31"
QUALITY_YEAR = 1998
LOADED_BEFORE = "1998-01-01"

ACCEPTED = {
    "stg_sales__campaigns": {"campaign_type": list(CAMPAIGN_TYPES), "status": list(CAMPAIGN_STATUSES)},
    "stg_finance__ap_invoices": {"status": ["unpaid", "paid", "overdue"]},
    "stg_finance__ar_ledger": {"status": ["open", "collected", "overdue"]},
    "stg_ops__inventory_movements": {"movement_type": ["receipt", "issue", "transfer", "adjustment"]},
    "stg_sales_transactions": {"vat_classification": ["vatable", "exempt", "zero_rated"]},
}
FOREIGN_KEYS = [  # (child bronze table, parent bronze table, key columns)
    ("ap_invoices", "vendors", ["subsidiary_id", "vendor_id"]),
    ("purchase_orders", "vendors", ["subsidiary_id", "vendor_id"]),
    ("wht_certificates", "vendors", ["subsidiary_id", "vendor_id"]),
    ("ar_ledger", "customers", ["subsidiary_id", "customer_id"]),
    ("sales_orders", "customers", ["subsidiary_id", "customer_id"]),
    ("payroll_runs", "employees", ["subsidiary_id", "employee_id"]),
]


def _status_sql(expr: str) -> str:
    return f"case when {expr} = 0 then 'pass' else 'fail' end"


def _union(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------
@query("live_rows", "select * from br_customers")
def live_rows(lake):
    """soft-deleted rows excluded."""
    return filters.live(lake.raw("customers"))


@query("tenant_view", "select * from br_customers where subsidiary_id = 'ABC'")
def tenant_view(lake):
    """F1 / row-level tenant scoping: live rows of one subsidiary."""
    return filters.tenant_view(lake.raw("customers"), "ABC")


@query("future_dated", f"select * from sv_fact_sales where invoice_date > date '{AS_OF}'")
def future_dated(lake):
    """facts dated after the as-of date."""
    return filters.future_dated(silver.fact_sales(lake), "invoice_date", AS_OF)


@query("records_lookback", """
select * exclude (id) from br_ap_invoices where invoice_date > date '1998-06-30' - 7 and invoice_date <= date '1998-06-30'""")
def records_lookback(lake):
    """A department feed's records of the last 7 days before the as-of date."""
    return filters.records(lake, "finance", "ap_invoices", days=7, as_of="1998-06-30").drop("id")


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------
def _nn_sql():
    parts = []
    for m, cols in quality.NOT_NULL_TESTS.items():
        for c in cols:
            n = f"count(*) filter (where {c} is null)"
            parts.append(f"select '{m}' as model, 'not_null' as check_name, '{c}' as column_name, "
                         f"{n} as failures, {_status_sql(n)} as status from {m}")
    return "\nunion all\n".join(parts)


@query("dq_not_null", _nn_sql())
def dq_not_null(lake):
    """Q1: declared NOT NULL tests."""
    return _union([quality.assert_not_null(stage(lake, m), m, cols)
                   for m, cols in quality.NOT_NULL_TESTS.items()])


def _uq_sql():
    parts = []
    for m, keys in quality.UNIQUE_TESTS.items():
        k = ", ".join(keys)
        nn = " and ".join(f"{x} is not null" for x in keys)
        parts.append(f"select '{m}' as model, 'unique' as check_name, '{','.join(keys)}' as column_name, "
                     f"count(*) as failures, {_status_sql('count(*)')} as status "
                     f"from (select {k} from {m} where {nn} group by {k} having count(*) > 1) d")
    return "\nunion all\n".join(parts)


@query("dq_unique", _uq_sql())
def dq_unique(lake):
    """Q2: declared unique tests on the per-subsidiary key."""
    return _union([quality.assert_unique(stage(lake, m), m, keys)
                   for m, keys in quality.UNIQUE_TESTS.items()])


def _acc_sql():
    parts = []
    for m, spec in ACCEPTED.items():
        for c, vals in spec.items():
            lst = ", ".join(f"'{v}'" for v in vals)
            n = f"count(*) filter (where {c} is not null and {c} not in ({lst}))"
            parts.append(f"select '{m}' as model, 'accepted_values' as check_name, '{c}' as column_name, "
                         f"{n} as failures, {_status_sql(n)} as status from {m}")
    n = "count(*) filter (where not coalesce(end_date >= start_date, true))"
    parts.append(f"select 'stg_sales__campaigns' as model, 'expression' as check_name, "
                 f"'end_date >= start_date' as column_name, {n} as failures, {_status_sql(n)} as status "
                 f"from stg_sales__campaigns")
    return "\nunion all\n".join(parts)


@query("dq_accepted", _acc_sql())
def dq_accepted(lake):
    """Q4: accepted values and the campaign date-order CHECK."""
    parts = [quality.assert_accepted(stage(lake, m), m, spec) for m, spec in ACCEPTED.items()]
    camp = stage(lake, "stg_sales__campaigns")
    parts.append(quality.assert_expression(camp, "stg_sales__campaigns", "end_date >= start_date",
                                           F.col("end_date") >= F.col("start_date")))
    return _union(parts)


def _fk_sql():
    parts = []
    for child, parent, keys in FOREIGN_KEYS:
        on = " and ".join(f"c.{k} = p.{k}" for k in keys)
        nn = " and ".join(f"c.{k} is not null" for k in keys)
        n = f"count(*) filter (where p.{keys[-1]} is null and {nn})"
        parts.append(
            f"select '{child}' as model, 'fk:{parent}' as check_name, '{','.join(keys)}' as column_name, "
            f"{n} as failures, {_status_sql(n)} as status from br_{child} c "
            f"left join (select distinct {', '.join(keys)} from br_{parent}) p on {on}")
    return "\nunion all\n".join(parts)


@query("dq_fk", _fk_sql())
def dq_fk(lake):
    """Q5: referential checks between live bronze tables (not in the reference)."""
    return _union([quality.assert_fk(lake.bronze(c), lake.bronze(p), c, keys, p)
                   for c, p, keys in FOREIGN_KEYS])


# Business dates checked against the catalogue's clock.
NO_FUTURE = {"fact_sales": "invoice_date", "fact_ap_invoices": "invoice_date",
             "fact_ar_ledger": "invoice_date", "fact_inventory_movements": "movement_date"}
NO_FUTURE_AS_OF = "1998-06-30"


def _nf_sql():
    n = "count(*) filter (where {c} > date '" + NO_FUTURE_AS_OF + "')"
    return "\nunion all\n".join(
        f"select '{m}' as model, 'no_future_dates' as check_name, '{c}' as column_name, "
        f"{n.format(c=c)} as failures, {_status_sql(n.format(c=c))} as status from sv_{m}"
        for m, c in NO_FUTURE.items())


@query("dq_no_future", _nf_sql())
def dq_no_future(lake):
    """Q3: rows dated after the clock."""
    return _union([quality.assert_no_future(silver.SILVER[m](lake), m, c, NO_FUTURE_AS_OF)
                   for m, c in NO_FUTURE.items()])


def _arith_sql():
    rules = {  # SQL twins of quality.arithmetic_rules()
        "ap_invoices": [
            ("R2_ap_vat", "vat_amount = cast(round(gross_amount * 0.12, 2) as decimal(18,2))"),
            ("R2_ap_net", "net_amount = gross_amount - vat_amount"),
            ("R2_ap_wht", "wht_amount = cast(round(gross_amount * 0.01, 2) as decimal(18,2))")],
        "ar_ledger": [
            ("R3_ar_vat", "vat_amount = cast(round(gross_amount * 0.12, 2) as decimal(18,2))"),
            ("R3_ar_net", "net_amount = gross_amount - vat_amount"),
            ("R3_ar_collected", "collected_amount is null or collected_amount between gross_amount * 0.2 and gross_amount")],
        "sales_transactions": [
            ("R4_sales_discount", "discount_amount = cast(round(gross_amount * 0.02, 2) as decimal(18,2))"),
            ("R4_sales_vat", "vat_amount = cast(round((gross_amount - discount_amount) * 0.12, 2) as decimal(18,2))"),
            ("R4_sales_net", "net_amount = gross_amount - discount_amount + vat_amount")],
        "vat_returns": [("R5_vat_payable", "vat_payable = output_vat - input_vat")],
        "wht_filings": [
            ("R6_wht_amount", "wht_amount = cast(round(income_payment * tax_rate, 2) as decimal(18,2))"),
            ("R6_wht_rate", "tax_rate in (0.01, 0.02, 0.05)")],
        "payroll_runs": [
            ("R7_payroll_deductions", "total_deductions = cast(round(gross_pay * 0.08, 2) as decimal(18,2)) "
             "+ cast(round(gross_pay * 0.03, 2) as decimal(18,2)) + cast(round(gross_pay * 0.02, 2) as decimal(18,2))"),
            ("R7_payroll_net", "net_pay = gross_pay - total_deductions")],
        "statutory_contributions": [
            ("R8_statutory_total", "total_amount = sss_employer + sss_employee + philhealth_employer "
             "+ philhealth_employee + pagibig_employer + pagibig_employee")],
        "inventory_movements": [("R9_stock_value", "total_cost = quantity * unit_cost")],
        "bir_filings_log": [("R14_penalty", "penalty_amount = surcharge_amount + interest_amount + compromise_amount")],
    }
    parts = []
    for table, rs in rules.items():
        for rid, pred in rs:
            n = f"count(*) filter (where not coalesce({pred}, false))"
            parts.append(f"select '{table}' as model, 'arithmetic' as check_name, '{rid}' as column_name, "
                         f"{n} as failures, {_status_sql(n)} as status from br_{table}")
    n = "count(*)"
    parts.append(f"select 'journal_entries' as model, 'arithmetic' as check_name, 'R1_balanced' as column_name, "
                 f"{n} as failures, {_status_sql(n)} as status from (select subsidiary_id, reference_doc "
                 f"from br_journal_entries group by 1, 2 having sum(debit_amount) <> sum(credit_amount)) u")
    return "\nunion all\n".join(parts)


@query("arithmetic_checks", _arith_sql())
def arithmetic_checks(lake):
    """R1-R11 (+ the generated penalty, X14): violations per rule."""
    tables = sorted({t for t, _p in quality.arithmetic_rules().values()})
    parts = [quality.check_arithmetic(lake.bronze(t), t) for t in tables]
    unbalanced = quality.journal_balanced(lake.bronze("journal_entries")).agg(
        F.count(F.lit(1)).alias("failures"))
    parts.append(unbalanced.select(
        F.lit("journal_entries").alias("model"), F.lit("arithmetic").alias("check_name"),
        F.lit("R1_balanced").alias("column_name"), "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status")))
    return _union(parts)


def _staged(model: str) -> tuple[str, dict]:
    """A staging model's stored table, and its columns as expressions over that table."""
    cols = {out: F.lit(None).cast(src.split(":", 1)[1]) if src.startswith("null:") else F.col(src) for out, src in columns_of(model)}
    return STAGING[model][0], cols


# The staging model whose columns a fact carries.
_FACT_STAGE = {"fact_sales": "stg_sales_transactions", "fact_ap_invoices": "stg_finance__ap_invoices",
               "fact_ar_ledger": "stg_finance__ar_ledger", "fact_inventory_movements": "stg_ops__inventory_movements"}


def declared_checks() -> list[checks.Check]:
    """Every declared check, on the stored table that its model projects."""
    out = []
    for m, cols in quality.NOT_NULL_TESTS.items():
        t, at = _staged(m)
        out += [checks.not_null(t, m, c, at[c]) for c in cols]
    for m, keys in quality.UNIQUE_TESTS.items():
        out.append(checks.unique(_staged(m)[0], m, keys))
    out += [checks.foreign_key(c, p, keys) for c, p, keys in FOREIGN_KEYS]
    for m, c in NO_FUTURE.items():
        t, at = _staged(_FACT_STAGE[m])
        out.append(checks.no_future(t, m, c, at[c], NO_FUTURE_AS_OF))
    for m, spec in ACCEPTED.items():
        t, at = _staged(m)
        out += [checks.accepted(t, m, c, at[c], v) for c, v in spec.items()]
    out.append(checks.expression("campaigns", "stg_sales__campaigns", "end_date >= start_date", F.col("end_date") >= F.col("start_date")))
    out += checks.all_rules()
    out.append(checks.equal_sums("journal_entries", "R1_balanced", ["subsidiary_id", "reference_doc"], ("debit_amount", "credit_amount")))
    return out


@query("quality_report", "\nunion all\n".join(
    f"select * from ({q}) q{i}" for i, q in enumerate(
        [_nn_sql(), _uq_sql(), _fk_sql(), _nf_sql(), _acc_sql(), _arith_sql()])))
def quality_report(lake):
    """Q6: one report row per check, over every kind of check (Q1-Q5 and the arithmetic rules); each table is read once."""
    return checks.report(lake.spark, lake.bronze, declared_checks())


# ---------------------------------------------------------------------------
# Reconciliation
# ---------------------------------------------------------------------------
_AUDIT_PAIRS = {  # bronze table -> silver model
    "journal_entries": "fact_finance_journal_entries", "sales_transactions": "fact_sales",
    "employees": "dim_employees", "ap_invoices": "fact_ap_invoices", "ar_ledger": "fact_ar_ledger",
    "inventory_movements": "fact_inventory_movements", "vat_returns": "fact_tax_vat_returns",
    "vendors": "dim_vendors",
}


@query("row_count_audit", "\nunion all\n".join(
    f"select 'bronze.{b}' as table_name, (select count(*) from fx_{b}) as bronze_count, "
    f"(select count(*) from sv_{s}) as silver_count, "
    f"(select count(*) from fx_{b}) - (select count(*) from sv_{s}) as diff"
    for b, s in _AUDIT_PAIRS.items()))
def row_count_audit(lake):
    """Bronze (all rows) vs silver row counts, extended to every pair."""
    return recon.row_count_audit({f"bronze.{b}": (lake.raw(b), silver.SILVER[s](lake))
                                  for b, s in _AUDIT_PAIRS.items()})


@query("row_diff", """
select subsidiary_id, customer_id, 'missing_in_right' as side from
  (select distinct subsidiary_id, customer_id from fx_customers
   except select distinct subsidiary_id, customer_id from stg_sales__customers) a
union all
select subsidiary_id, customer_id, 'missing_in_left' as side from
  (select distinct subsidiary_id, customer_id from stg_sales__customers
   except select distinct subsidiary_id, customer_id from fx_customers) b""")
def row_diff(lake):
    """Reconciliation by key: bronze customers missing from staging (the soft-deleted)."""
    return recon.row_diff(lake.raw("customers"), stage(lake, "stg_sales__customers"),
                          ["subsidiary_id", "customer_id"])


@query("gold_quality", f"""
with keys(mart, key) as (
  select unnest(['exec_kpi', 'group_pnl']), concat_ws('/', subsidiary_id, fiscal_month)
  from sv_fact_sales where fiscal_year = {QUALITY_YEAR}
  union all
  select 'bir_compliance_scorecard', concat_ws('/', subsidiary_id, form_type)
  from br_bir_filings_log where due_date between date '{QUALITY_YEAR}-01-01' and date '{QUALITY_YEAR}-12-31'),
marts(mart) as (values ('exec_kpi'), ('group_pnl'), ('bir_compliance_scorecard'))
select 'gold.' || mart as table_name, count(distinct key) as row_count, if(count(key) > 0, 'OK', 'FAILED') as status
from marts left join keys using (mart) group by mart""")
def gold_quality(lake):
    """Each gold mart has rows for the current fiscal year."""
    fs = silver.fact_sales(lake)
    marts = {"gold.exec_kpi": gold.exec_kpi(fs), "gold.group_pnl": gold.group_pnl(fs),
             "gold.bir_compliance_scorecard": reports.bir_compliance_scorecard(
                 lake.bronze("bir_filings_log"), form_codes(lake.spark))}
    return recon.gold_quality(marts, QUALITY_YEAR)


@query("table_metrics", """
select 'ar_ledger' as table_name, subsidiary_id, count(*) as row_count, max(invoice_date) as last_date
from br_ar_ledger group by subsidiary_id""")
def table_metrics(lake):
    """Rows and newest business date per subsidiary."""
    return recon.table_metrics(lake.bronze("ar_ledger"), "invoice_date", "ar_ledger")


@query("serve_top", """
select * from sv_fact_sales order by net_amount desc, subsidiary_id, invoice_number limit 5000""")
def serve_top(lake):
    """The BI result cap (5000 rows, stable order). The limit is the feature."""
    return filters.serve(silver.fact_sales(lake),
                         [F.col("net_amount").desc(), "subsidiary_id", "invoice_number"])


# ---------------------------------------------------------------------------
# Ingest and DML
# ---------------------------------------------------------------------------
_SALES_COLS = [c for c in TABLES["sales_transactions"].names if c != "id"]


@query("insert_ignore", f"select {', '.join(_SALES_COLS)} from br_sales_transactions")
def insert_ignore(lake):
    """M6: a re-poll of every sales row (each sent twice) into a table that already
    holds the rows before 1998: only the missing keys are inserted, once."""
    sales = store.keep(lake.bronze("sales_transactions"), "sales")  # a stored table in production; target and batch both read it
    target = sales.filter(F.col("transaction_date") < F.lit(LOADED_BEFORE).cast("date"))
    batch = sales.unionByName(sales)
    new = changes.insert_ignore(target, batch, "sales_transactions")
    return target.unionByName(new).drop("id")


@query("ingest_feed", f"select {', '.join(_SALES_COLS)} from br_sales_transactions")
def ingest_feed(lake):
    """Polled sales records as text, with the date sent under the
    fallback name ``invoice_date`` and NULL flags, typed and defaulted to bronze."""
    sales = lake.bronze("sales_transactions")
    polled = sales.select(
        *[F.col(c).cast("string").alias(c) for c in sales.columns
          if c not in ("transaction_date", "is_interco", "is_deleted", "ingested_at", "source_dept")],
        F.col("transaction_date").cast("string").alias("invoice_date"),
        F.when(F.col("is_interco"), F.lit("true")).alias("is_interco"))
    good, _bad = changes.ingest(polled, "sales_transactions", "2024-02-01 00:00:00")
    return good.drop("id")


@query("ingest_quarantine", f"""
select {', '.join(_SALES_COLS)}, 'x' as reject_reason from br_sales_transactions where false""")
def ingest_quarantine(lake):
    """Rows breaking NOT NULL without a default go to quarantine (none here)."""
    sales = lake.bronze("sales_transactions")
    polled = sales.select(*[F.col(c).cast("string").alias(c) for c in sales.columns])
    _good, bad = changes.ingest(polled, "sales_transactions", "2024-02-01 00:00:00")
    return bad.drop("id")


_AP_COLS = TABLES["ap_invoices"].names
_AP_PATCHED = {
    "status": "case when status = 'unpaid' then 'paid' else status end",
    "payment_amount": "case when status = 'unpaid' then cast(gross_amount - wht_amount as decimal(18,2)) "
                      "else payment_amount end",
    "payment_date": "case when status = 'unpaid' then due_date else payment_date end",
}


@query("patch_apply", "select " + ", ".join(
    f"{_AP_PATCHED[c]} as {c}" if c in _AP_PATCHED else c for c in _AP_COLS) + " from br_ap_invoices")
def patch_apply(lake):
    """M7: settle every unpaid AP invoice through a partial update; the patch also
    carries a field outside the allowed list (gross_amount), which is ignored."""
    ap = lake.bronze("ap_invoices")
    unpaid = ap.filter(F.col("status") == "unpaid")
    patches = unpaid.select(
        "subsidiary_id", "id",
        F.to_json(F.struct(F.lit("paid").alias("status"),
                           (F.col("gross_amount") - F.col("wht_amount")).cast("string").alias("payment_amount"),
                           F.col("due_date").cast("string").alias("payment_date"),
                           F.lit("0").alias("gross_amount"))).alias("patch"))
    return changes.patch(ap, patches, "ap_invoices")


@query("journal_rows_capped", """
select * exclude (id) from br_journal_entries where subsidiary_id = 'ABC'
order by entry_number limit 35""")
def journal_rows_capped(lake):
    """L3: the reference's ``days`` row cap on a feed (days * 5 rows; days = 7),
    in a stable order. The limit is the feature."""
    je = filters.live(lake.raw("journal_entries"), "ABC")
    return filters.limit_rows(je, days=7, order="entry_number").drop("id")
