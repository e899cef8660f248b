"""Catalogue entries for the reports."""

from __future__ import annotations

from functools import reduce

from strata.operators import history, quality, reports, silver
from strata.operators.staging import stage
from strata.plans.catalog import query
from strata.plans.oracle import EXTRA_CTES
from strata.schemas import FORM_CODES
from strata.sources.landing import form_codes

# Report dates used by the catalogue.
REPORT_AS_OF = "1998-06-30"
REPORT_YEAR = 1998


def _bucket(days: str) -> str:
    return (f"case when {days} between 0 and 30 then '0-30' when {days} between 31 and 60 then '31-60' "
            f"when {days} between 61 and 90 then '61-90' else '90+' end")


@query("trial_balance", f"""
select subsidiary_id, account_code, cast(sum(debit_amount) as double) as debit_balance,
  cast(sum(credit_amount) as double) as credit_balance, date '{REPORT_AS_OF}' as as_of_date
from sv_fact_finance_journal_entries where entry_date <= date '{REPORT_AS_OF}'
group by subsidiary_id, account_code""")
def trial_balance(lake):
    """B1."""
    return reports.trial_balance(silver.fact_finance_journal_entries(lake), REPORT_AS_OF)


def _aging_sql(src: str, party: str, paid_col: str, closed: str) -> str:
    d = f"datediff('day', invoice_date, date '{REPORT_AS_OF}')"
    return f"""
with b as (select subsidiary_id, {party}, gross_amount - coalesce({paid_col}, 0) as o, {_bucket(d)} as bk
  from {src} where status <> '{closed}' and invoice_date <= date '{REPORT_AS_OF}')
select subsidiary_id, {party},
  cast(sum(case when bk = '0-30' then o else 0 end) as double) as "current",
  cast(sum(case when bk = '31-60' then o else 0 end) as double) as aging_31_60,
  cast(sum(case when bk = '61-90' then o else 0 end) as double) as aging_61_90,
  cast(sum(case when bk = '90+' then o else 0 end) as double) as aging_over_90,
  cast(sum(o) as double) as total_outstanding, date '{REPORT_AS_OF}' as as_of_date
from b group by subsidiary_id, {party}"""


@query("ap_aging_detail", _aging_sql("sv_fact_ap_invoices", "vendor_id", "payment_amount", "paid"))
def ap_aging_detail(lake):
    """B2."""
    return reports.ap_aging_detail(silver.fact_ap_invoices(lake), REPORT_AS_OF)


@query("ar_aging", _aging_sql("sv_fact_ar_ledger", "customer_id", "collected_amount", "collected"))
def ar_aging(lake):
    """B3 (uses the otherwise unused aging-bucket macro, X4)."""
    return reports.ar_aging(silver.fact_ar_ledger(lake), REPORT_AS_OF)


@query("stock_summary", f"""
with g as (select subsidiary_id, item_code, warehouse_location,
    sum(case movement_type when 'receipt' then 1 when 'issue' then -1 when 'transfer' then 0
      when 'adjustment' then 1 else 0 end * quantity) as quantity_on_hand,
    arg_max(unit_cost, {{'d': movement_date, 'c': unit_cost}}) as unit_cost,
    sum(case when movement_type = 'issue' and movement_date > date '{REPORT_AS_OF}' - 30
      then quantity else 0 end) as issued
  from sv_fact_inventory_movements where movement_date <= date '{REPORT_AS_OF}'
  group by subsidiary_id, item_code, warehouse_location)
select subsidiary_id, item_code, warehouse_location, quantity_on_hand, unit_cost,
  cast(quantity_on_hand * unit_cost as double) as total_value,
  cast(quantity_on_hand * 30 as double) / cast(greatest(30, issued) as double) as days_of_stock,
  date '{REPORT_AS_OF}' as as_of_date
from g""")
def stock_summary(lake):
    """B4."""
    return reports.stock_summary(silver.fact_inventory_movements(lake), REPORT_AS_OF)


@query("vendor_scorecard", """
with p as (select subsidiary_id, vendor_id, substring(po_number, 4) as doc, order_date, expected_date,
    total_amount as ordered, status as po_status from br_purchase_orders),
a as (select subsidiary_id, vendor_id, substring(invoice_number, 4) as doc, invoice_date as received,
    due_date, payment_date, gross_amount as billed, status as ap_status from br_ap_invoices),
j as (select p.*, a.received, a.due_date, a.payment_date, a.billed, a.ap_status from p left join a
    on p.subsidiary_id = a.subsidiary_id and p.vendor_id = a.vendor_id and p.doc = a.doc
    where p.po_status <> 'cancelled'),
g as (select subsidiary_id, vendor_id, cast(year(order_date) as int) as year, cast(month(order_date) as int) as month,
    count(*) filter (where received is not null) as recv,
    count(*) filter (where received is not null and received <= expected_date) as ontime,
    count(*) as pos, count(*) filter (where ap_status = 'paid') as paid,
    count(*) filter (where ap_status = 'paid' and payment_date <= due_date) as paid_ok,
    sum(ordered) as ordered, sum(billed) as billed
  from j group by 1, 2, 3, 4)
select subsidiary_id, vendor_id, month, year,
  cast(ontime as double) / nullif(cast(recv as double), 0) as on_time_delivery_rate,
  cast(recv as double) / nullif(cast(pos as double), 0) as po_fill_rate,
  cast(paid_ok as double) / nullif(cast(paid as double), 0) as payment_compliance,
  cast(billed - ordered as double) / nullif(cast(ordered as double), 0) as price_variance
from g""")
def vendor_scorecard(lake):
    """B5."""
    return reports.vendor_scorecard(lake.bronze("purchase_orders"), lake.bronze("ap_invoices"))


@query("alphalist", """
select subsidiary_id, payee_name, payee_tin as tin, atc_code, period_year as year,
  cast(sum(income_payment) as double) as income_payment, cast(sum(wht_amount) as double) as wht_withheld
from stg_tax__wht_filings group by subsidiary_id, payee_name, payee_tin, atc_code, period_year""")
def alphalist(lake):
    """B6."""
    return reports.alphalist(stage(lake, "stg_tax__wht_filings"))


@query("dole_report", f"""
with e as (select subsidiary_id, count(*) as total_employees,
    count(*) filter (where employment_type = 'regular') as regular_count,
    count(*) filter (where employment_type = 'contractual') as contractual_count,
    cast(sum(basic_salary) as double) / count(basic_salary) as avg_monthly_salary
  from br_employees where date_hired is null or date_hired <= date '{REPORT_YEAR}-12-31' group by subsidiary_id),
w as (select subsidiary_id, sum(gross_pay) as total_wages from br_payroll_runs
  where year(payroll_date) = {REPORT_YEAR} group by subsidiary_id)
select e.subsidiary_id, {REPORT_YEAR} as year, total_employees, regular_count, contractual_count,
  avg_monthly_salary, cast(total_wages as double) as total_wages, date '{REPORT_YEAR}-12-31' as report_date
from e left join w on e.subsidiary_id = w.subsidiary_id""")
def dole_report(lake):
    """B7."""
    return reports.dole_report(lake.bronze("employees"), lake.bronze("payroll_runs"), REPORT_YEAR,
                               f"{REPORT_YEAR}-12-31")


@query("revenue_summary", f"""
select subsidiary_id, {REPORT_YEAR} as year, 0 as month, cast(sum(gross_amount) as double) as gross_amount,
  cast(sum(discount_amount) as double) as discount_amount, cast(sum(vat_amount) as double) as vat_amount,
  cast(sum(net_amount) as double) as net_amount, count(*) as invoice_count
from sv_fact_sales where fiscal_year = {REPORT_YEAR} group by subsidiary_id""")
def revenue_summary(lake):
    """Month 0 = the whole year."""
    return reports.revenue_summary(silver.fact_sales(lake), REPORT_YEAR, 0)


_CODES = ", ".join(f"('{c}', '{d}')" for c, d in FORM_CODES)


@query("bir_compliance_scorecard", f"""
with g as (select subsidiary_id, form_type, cast(year(due_date) as int) as fiscal_year,
    count(*) filter (where filing_date is not null) as filed,
    count(*) filter (where filing_date > due_date) as late,
    count(*) filter (where status = 'pending') as pending,
    cast(sum(penalty_amount) as double) as penalties
  from br_bir_filings_log group by 1, 2, 3),
codes as (select * from (values {_CODES}) t(form_code, description))
select g.*, cast(filed - late as double) / nullif(cast(filed as double), 0) as on_time_rate,
  codes.description as form_description
from g left join codes on g.form_type = codes.form_code""")
def bir_compliance_scorecard(lake):
    """B9."""
    return reports.bir_compliance_scorecard(lake.bronze("bir_filings_log"), form_codes(lake.spark))


@query("interco_elimination", """
with s as (select subsidiary_id as seller, counterpart_sub_id as buyer, fiscal_year, fiscal_month,
    sum(gross_amount) as interco_sales from sv_fact_sales
  where is_interco and counterpart_sub_id is not null group by 1, 2, 3, 4),
p as (select counterpart_sub_id as seller, subsidiary_id as buyer, fiscal_year, fiscal_month,
    sum(gross_amount) as interco_purchases from sv_fact_ap_invoices
  where is_interco and counterpart_sub_id is not null group by 1, 2, 3, 4),
j as (select coalesce(s.seller, p.seller) as seller, coalesce(s.buyer, p.buyer) as buyer,
    coalesce(s.fiscal_year, p.fiscal_year) as fiscal_year, coalesce(s.fiscal_month, p.fiscal_month) as fiscal_month,
    coalesce(interco_sales, 0) as sa, coalesce(interco_purchases, 0) as pu
  from s full join p on s.seller = p.seller and s.buyer = p.buyer and s.fiscal_year = p.fiscal_year
    and s.fiscal_month = p.fiscal_month)
select seller as subsidiary_id, buyer as counterpart_sub_id, fiscal_year, fiscal_month,
  cast(sa as double) as interco_sales, cast(pu as double) as interco_purchases,
  cast(least(sa, pu) as double) as eliminated, cast(abs(sa - pu) as double) as unreconciled,
  cast(sa - least(sa, pu) as double) as net_after_elimination
from j""")
def interco_elimination(lake):
    """B10."""
    return reports.interco_elimination(silver.fact_sales(lake), silver.fact_ap_invoices(lake))


@query("campaign_performance", """
select subsidiary_id, campaign_id, campaign_type, status,
  cast(conversions as double) / nullif(cast(leads_generated as double), 0) as conversion_rate,
  cast(actual_spend as double) / nullif(cast(leads_generated as double), 0) as cost_per_lead,
  cast(revenue_attributed - actual_spend as double) / nullif(cast(actual_spend as double), 0) as roi,
  cast(actual_spend as double) / nullif(cast(budget_amount as double), 0) as budget_utilisation
from stg_sales__campaigns""")
def campaign_performance(lake):
    """B11."""
    return reports.campaign_performance(stage(lake, "stg_sales__campaigns"))


@query("access_risk", """
with a as (select subsidiary_id, cast(event_timestamp as date) as event_date, user_id,
    count(*) filter (where result = 'failed') as failed_actions,
    count(*) filter (where risk_level in ('high', 'critical')) as high_risk_actions
  from stg_it_audit__audit_log group by 1, 2, 3),
d as (select subsidiary_id, cast(event_timestamp as date) as event_date, user_id,
    count(*) filter (where result = 'denied') as denied_access
  from stg_itaudit__access_events group by 1, 2, 3)
select coalesce(a.subsidiary_id, d.subsidiary_id) as subsidiary_id,
  coalesce(a.event_date, d.event_date) as event_date, coalesce(a.user_id, d.user_id) as user_id,
  coalesce(failed_actions, 0) as failed_actions, coalesce(high_risk_actions, 0) as high_risk_actions,
  coalesce(denied_access, 0) as denied_access
from a full join d on a.subsidiary_id = d.subsidiary_id and a.event_date = d.event_date
  and a.user_id = d.user_id""")
def access_risk(lake):
    """B12."""
    return reports.access_risk(stage(lake, "stg_it_audit__audit_log"),
                               stage(lake, "stg_itaudit__access_events"))


@query("incident_resolution", """
select subsidiary_id, severity, count(*) as incidents,
  count(*) filter (where resolved_date is null) as open_incidents,
  cast(sum(datediff('day', incident_date, resolved_date)) as double)
    / nullif(cast(count(datediff('day', incident_date, resolved_date)) as double), 0) as avg_resolution_days
from stg_itaudit__system_incidents group by subsidiary_id, severity""")
def incident_resolution(lake):
    """B13."""
    return reports.incident_resolution(stage(lake, "stg_itaudit__system_incidents"))


EXTRA_CTES["ox_ownership"] = """
with t as (select subsidiary_id, sum(cast(ownership_pct * 100 as bigint)) as total,
    max(stockholder_id) as last_id from br_stockholders group by subsidiary_id),
r as (select s.*, t.total, t.last_id,
    (cast(s.ownership_pct * 100 as bigint) * 20000 + t.total) // (t.total * 2) as bp
  from br_stockholders s join t on s.subsidiary_id = t.subsidiary_id),
o as (select subsidiary_id, sum(bp) as others from r where stockholder_id <> last_id group by subsidiary_id)
select r.subsidiary_id, r.stockholder_id, r.name, r.is_foreign,
  cast(case when r.stockholder_id = r.last_id then 10000 - coalesce(o.others, 0) else r.bp end / 100.0
    as decimal(6,2)) as ownership_pct
from r left join o on r.subsidiary_id = o.subsidiary_id"""


@query("ownership", """
select subsidiary_id, count(*) as holders, count(*) filter (where is_foreign) as foreign_holders,
  cast(sum(case when is_foreign then ownership_pct else 0 end) as double) as foreign_pct,
  cast(sum(case when not is_foreign then ownership_pct else 0 end) as double) as local_pct
from ox_ownership group by subsidiary_id""")
def ownership(lake):
    """Foreign / local ownership share per subsidiary."""
    sh = lake.bronze("stockholders").select("subsidiary_id", "stockholder_id", "name",
                                            "is_foreign", "ownership_pct")
    return reports.ownership_summary(history.close_to_100(sh))


@query("filing_timeliness", """
select subsidiary_id, filing_type, cast(year(due_date) as int) as year,
  count(*) filter (where filing_date is not null and filing_date <= due_date) as on_time,
  count(*) filter (where filing_date > due_date) as late,
  count(*) filter (where filing_date is null) as missing
from stg_legal__sec_filings group by 1, 2, 3""")
def filing_timeliness(lake):
    """B15."""
    return reports.filing_timeliness(stage(lake, "stg_legal__sec_filings"))


def _report_check_sql() -> str:
    def row(model, rule, n, src):
        return (f"select '{model}' as model, 'arithmetic' as check_name, '{rule}' as column_name, {n} as failures, "
                f"case when {n} = 0 then 'pass' else 'fail' end as status from {src}")
    adds = ('cast("current" + aging_31_60 + aging_61_90 + aging_over_90 as decimal(18,2)) = cast(total_outstanding as decimal(18,2))')
    parts = [row("journal_entries", "R1_line", "count(*) filter (where not coalesce(debit_amount = credit_amount, false))", "br_journal_entries")]
    for model, rule, src, party, paid, closed in (
            ("ap_aging_detail", "R10_ap_total", "sv_fact_ap_invoices", "vendor_id", "payment_amount", "paid"),
            ("ar_aging", "R10_ar_total", "sv_fact_ar_ledger", "customer_id", "collected_amount", "collected")):
        parts.append(row(model, rule, f"count(*) filter (where not coalesce({adds}, false))", f"({_aging_sql(src, party, paid, closed)}) t"))
    for model, src in (("stockholders", "br_stockholders"), ("ownership_closed", "ox_ownership")):
        parts.append(row(model, "R11_shares", "count(*) filter (where total <> 100)",
                         f"(select coalesce(sum(ownership_pct), 0) as total from {src} group by subsidiary_id) t"))
    return "\nunion all\n".join(parts)


@query("report_checks", _report_check_sql())
def report_checks(lake):
    """R1 of single lines, R10 (aging totals equal their buckets) and R11 (shares sum to 100, before and after closing): violations per rule."""
    rules = quality.report_rules()
    holders = lake.bronze("stockholders").select("subsidiary_id", "stockholder_id", "name", "is_foreign", "ownership_pct")
    parts = [quality.check_arithmetic(lake.bronze("journal_entries"), "journal_entries", rules),
             quality.check_arithmetic(ap_aging_detail(lake), "ap_aging_detail", rules),
             quality.check_arithmetic(ar_aging(lake), "ar_aging", rules),
             quality.check_shares(holders, "stockholders"),
             quality.check_shares(history.close_to_100(holders), "ownership_closed")]
    return reduce(lambda a, b: a.unionByName(b), parts)
