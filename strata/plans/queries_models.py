"""Catalogue entries for the staging, silver and gold models."""

from __future__ import annotations

from strata.operators import gold, silver
from strata.operators.staging import STAGING, stage
from strata.plans.catalog import query

# ---------------------------------------------------------------------------
# P1-P24 staging
# ---------------------------------------------------------------------------
for _model in STAGING:
    query(_model, f"select * from {_model}")(
        (lambda m: lambda lake: stage(lake, m))(_model))

# ---------------------------------------------------------------------------
# P25-P32 silver
# ---------------------------------------------------------------------------
for _name, _fn in silver.SILVER.items():
    query(_name, f"select * from sv_{_name}")(_fn)


@query("dim_vendors_masked", """
select subsidiary_id, vendor_id, vendor_name, sha256(vendor_tin) as vendor_tin_hashed, vendor_type,
  payment_terms, is_accredited, ingested_at from stg_procurement__vendors""")
def dim_vendors_masked(lake):
    """D9 option: vendor TIN hashed like the employee TIN."""
    return silver.dim_vendors(lake, mask=True)


# ---------------------------------------------------------------------------
# A1-A7, J1, P33 gold
# ---------------------------------------------------------------------------
_SUMS3 = """cast(sum(gross_amount) as double) as revenue_gross, cast(sum(net_amount) as double) as revenue_net,
  cast(sum(vat_amount) as double) as output_vat"""


@query("group_pnl", f"""
select subsidiary_id, fiscal_year, fiscal_month, {_SUMS3}
from sv_fact_sales group by subsidiary_id, fiscal_year, fiscal_month""")
def group_pnl(lake):
    """A2: gross, net and VAT per subsidiary and fiscal month."""
    return gold.group_pnl(silver.fact_sales(lake))


@query("group_pnl_consolidated", f"""
select subsidiary_id, fiscal_year, fiscal_month, {_SUMS3},
  cast(grouping(subsidiary_id, fiscal_year, fiscal_month) as int) as grouping_level
from sv_fact_sales group by rollup (subsidiary_id, fiscal_year, fiscal_month)""")
def group_pnl_consolidated(lake):
    """A2 + rollup: per-month rows, yearly and per-subsidiary subtotals, group total."""
    return gold.group_pnl_consolidated(silver.fact_sales(lake))


@query("exec_kpi", """
select subsidiary_id, fiscal_year, fiscal_month, cast(sum(net_amount) as double) as revenue_net
from sv_fact_sales group by subsidiary_id, fiscal_year, fiscal_month""")
def exec_kpi(lake):
    """Net revenue per subsidiary and month."""
    return gold.exec_kpi_view(gold.exec_kpi(silver.fact_sales(lake)))


_AP = """select subsidiary_id, fiscal_year, fiscal_month, cast(sum(gross_amount) as double) as total_ap_gross,
  cast(sum(vat_amount) as double) as total_ap_vat, cast(sum(net_amount) as double) as total_ap_net,
  cast(sum(payment_amount) as double) as total_ap_paid
from sv_fact_ap_invoices group by subsidiary_id, fiscal_year, fiscal_month"""
_AR = """select subsidiary_id, fiscal_year, fiscal_month, cast(sum(gross_amount) as double) as total_ar_gross,
  cast(sum(vat_amount) as double) as total_ar_vat, cast(sum(net_amount) as double) as total_ar_net,
  cast(sum(collected_amount) as double) as total_ar_collected
from sv_fact_ar_ledger group by subsidiary_id, fiscal_year, fiscal_month"""
_VAT = """select subsidiary_id, period_year as fiscal_year, period_month as fiscal_month,
  cast(sum(taxable_sales) as double) as total_taxable_sales, cast(sum(output_vat) as double) as total_output_vat,
  cast(sum(input_vat) as double) as total_input_vat, cast(sum(vat_payable) as double) as total_vat_payable
from sv_fact_tax_vat_returns group by subsidiary_id, period_year, period_month"""


@query("ap_monthly", _AP)
def ap_monthly(lake):
    """A3."""
    return gold.ap_monthly(silver.fact_ap_invoices(lake))


@query("ar_monthly", _AR)
def ar_monthly(lake):
    """A4."""
    return gold.ar_monthly(silver.fact_ar_ledger(lake))


@query("vat_monthly", _VAT)
def vat_monthly(lake):
    """A5: VAT period columns renamed to fiscal_*."""
    return gold.vat_monthly(silver.fact_tax_vat_returns(lake))


_MEASURES = ("ap_gross", "ap_vat", "ap_net", "ap_paid", "ar_gross", "ar_vat", "ar_net", "ar_collected",
             "taxable_sales", "output_vat", "input_vat", "vat_payable")
_TOTALS = ", ".join(f"cast(sum(v) filter (where k = '{c}') as double) as total_{c}" for c in _MEASURES)


# Every amount as one (key, measure, value) row, grouped once: nothing is joined.
@query("gold_financial_summary", f"""
with amounts as (
  select subsidiary_id, fiscal_year as y, fiscal_month as m, unnest([
    {{'k': 'ap_gross', 'v': gross_amount}}, {{'k': 'ap_vat', 'v': vat_amount}}, {{'k': 'ap_net', 'v': net_amount}},
    {{'k': 'ap_paid', 'v': payment_amount}}], recursive := true) from sv_fact_ap_invoices
  union all by name
  select subsidiary_id, fiscal_year as y, fiscal_month as m, unnest([
    {{'k': 'ar_gross', 'v': gross_amount}}, {{'k': 'ar_vat', 'v': vat_amount}}, {{'k': 'ar_net', 'v': net_amount}},
    {{'k': 'ar_collected', 'v': collected_amount}}], recursive := true) from sv_fact_ar_ledger
  union all by name
  select subsidiary_id, period_year as y, period_month as m, unnest([
    {{'k': 'taxable_sales', 'v': taxable_sales}}, {{'k': 'output_vat', 'v': output_vat}}, {{'k': 'input_vat', 'v': input_vat}},
    {{'k': 'vat_payable', 'v': vat_payable}}], recursive := true) from sv_fact_tax_vat_returns)
select subsidiary_id, y as fiscal_year, m as fiscal_month, {_TOTALS}
from amounts group by subsidiary_id, y, m""")
def gold_financial_summary(lake):
    """AP, AR and VAT monthly aggregates, full outer joined."""
    return gold.financial_summary(gold.ap_monthly(silver.fact_ap_invoices(lake)),
                                  gold.ar_monthly(silver.fact_ar_ledger(lake)),
                                  gold.vat_monthly(silver.fact_tax_vat_returns(lake)))


@query("gold_hr_headcount", """
select subsidiary_id, count(*) as headcount,
  cast(sum(basic_salary) as double) / count(basic_salary) as average_salary,
  cast(min(basic_salary) as double) as min_salary, cast(max(basic_salary) as double) as max_salary
from sv_dim_employees group by subsidiary_id""")
def gold_hr_headcount(lake):
    """A6."""
    return gold.hr_headcount(silver.dim_employees(lake))


@query("gold_inventory_summary", """
select subsidiary_id, movement_type, fiscal_year, fiscal_month,
  cast(sum(quantity) as bigint) as total_quantity, cast(sum(total_cost) as double) as total_cost
from sv_fact_inventory_movements group by subsidiary_id, movement_type, fiscal_year, fiscal_month""")
def gold_inventory_summary(lake):
    """A7 (grouped by the silver fiscal columns, D7)."""
    return gold.inventory_summary(silver.fact_inventory_movements(lake))
