"""DuckDB twins of the fixtures and models, for the SQL oracle.

Layers, each a CTE name prefix the resolver understands:

* ``fx_<table>`` — the bronze fixture, all rows (including soft-deleted);
* ``br_<table>`` — live bronze rows;
* ``stg_<model>`` — staging projections;
* ``sv_<model>`` — silver models.

``with_ctes(sql)`` prepends exactly the CTEs ``sql`` references, in
dependency order, so each oracle query is one self-contained statement over
the driver's pre-registered views.
"""

from __future__ import annotations

import re

from strata.operators.staging import STAGING, columns_of
from strata.schemas import SQL_TYPES, TABLES

ING = "timestamp '2024-02-01 00:00:00'"


def _duck_type(kind_sql: str) -> str:
    return {"string": "varchar", "timestamp_ntz": "timestamp", "int": "integer"}.get(kind_sql, kind_sql)


def sub(k: str) -> str:
    return f"case {k} % 3 when 0 then 'ABC' when 1 then 'XYZ' else 'RTL' end"


def next_sub(k: str) -> str:
    return f"case {k} % 3 when 0 then 'XYZ' when 1 then 'RTL' else 'ABC' end"


def _conform(table: str, body: str) -> str:
    """Select the bronze columns of ``table`` from ``body`` (typed, audit columns added)."""
    t = TABLES[table]
    produced = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", body, flags=re.I))
    cols = []
    for c in t.columns:
        ty = _duck_type(SQL_TYPES[c.kind])
        if c.name == "id" and "id" not in produced:
            cols.append("cast(null as integer) as id")
        elif c.name == "source_dept" and c.name not in produced:
            cols.append(f"'{t.dept}' as source_dept")
        elif c.name == "ingested_at":
            cols.append(f"{ING} as ingested_at")
        elif c.name == "is_deleted" and c.name not in produced:
            cols.append("false as is_deleted")
        elif c.name == "deleted_at":
            cols.append(f"case when is_deleted then {ING} end as deleted_at"
                        if "is_deleted" in produced else "cast(null as timestamp) as deleted_at")
        elif c.name in produced:
            cols.append(f"cast({c.name} as {ty}) as {c.name}")
        else:
            cols.append(f"cast(null as {ty}) as {c.name}")
    return f"select {', '.join(cols)} from ({body}) q"


# ---------------------------------------------------------------------------
# Fixture bodies
# ---------------------------------------------------------------------------
_FX: dict[str, str] = {}

_FX["sales_transactions"] = f"""
with b as (select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag,
    o.o_orderdate, c.c_name, c.c_nationkey,
    cast(l.l_extendedprice as decimal(18,2)) as g, cast(l.l_discount as decimal(4,2)) as d
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey),
b2 as (select *, cast(round(g*d,2) as decimal(18,2)) as disc from b),
b3 as (select *, cast(round((g-disc)*cast(0.12 as decimal(4,2)),2) as decimal(18,2)) as vat from b2)
select {sub('c_nationkey')} as subsidiary_id,
  'SALES-' || cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) || '-' || cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar) as invoice_number,
  c_name as customer_name, cast(o_orderdate as date) as transaction_date, g as gross_amount,
  disc as discount_amount, vat as vat_amount, cast(g - disc + vat as decimal(18,2)) as net_amount,
  case l_returnflag when 'A' then 'vatable' when 'N' then 'exempt' else 'zero_rated' end as vat_classification,
  l_suppkey % 10 = 0 as is_interco,
  case when l_suppkey % 10 = 0 then {next_sub('c_nationkey')} end as counterpart_sub_id
from b3"""

_FX["ar_ledger"] = f"""
with b as (select o.*, c.c_name, c.c_nationkey, cast(o.o_totalprice as decimal(18,2)) as g
  from orders o join customer c on o.o_custkey = c.c_custkey),
b2 as (select *, cast(round(g*cast(0.12 as decimal(4,2)),2) as decimal(18,2)) as vat from b)
select o_orderkey as id, {sub('c_nationkey')} as subsidiary_id, 'AR-' || cast(o_orderkey as varchar) as invoice_number,
  'CUST-' || cast(o_custkey as varchar) as customer_id, c_name as customer_name,
  cast(o_custkey + 300000000 as varchar) as customer_tin,
  cast(o_orderdate as date) as invoice_date, cast(o_orderdate as date) + 30 as due_date,
  g as gross_amount, vat as vat_amount, cast(g - vat as decimal(18,2)) as net_amount,
  case o_orderstatus when 'F' then g when 'P' then cast(round(g*cast(0.5 as decimal(2,1)),2) as decimal(18,2)) end as collected_amount,
  case o_orderstatus when 'F' then cast(o_orderdate as date) + 25 when 'P' then cast(o_orderdate as date) + 40 end as collection_date,
  case o_orderstatus when 'F' then 'collected' when 'P' then 'overdue' else 'open' end as status,
  o_orderkey % 10 = 0 as is_interco,
  case when o_orderkey % 10 = 0 then {next_sub('c_nationkey')} end as counterpart_sub_id
from b2"""

_OSL = """
with a as (select l_orderkey, l_suppkey, min(l_shipdate) as sd, max(l_linestatus) as ls,
   cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as g from lineitem group by l_orderkey, l_suppkey),
b as (select a.*, s.s_name, s.s_nationkey from a join supplier s on a.l_suppkey = s.s_suppkey)"""

_FX["ap_invoices"] = _OSL + f""",
c as (select *, cast(round(g*cast(0.12 as decimal(4,2)),2) as decimal(18,2)) as vat,
   cast(round(g*cast(0.01 as decimal(4,2)),2) as decimal(18,2)) as wht from b)
select l_orderkey * 100000000 + l_suppkey as id, {sub('s_nationkey')} as subsidiary_id, 'AP-' || cast(l_orderkey as varchar) || '-' || cast(l_suppkey as varchar) as invoice_number,
  'VND-' || cast(l_suppkey as varchar) as vendor_id, s_name as vendor_name,
  cast(l_suppkey + 200000000 as varchar) as vendor_tin,
  cast(sd as date) as invoice_date, cast(sd as date) + 30 as due_date,
  g as gross_amount, vat as vat_amount, cast(g - vat as decimal(18,2)) as net_amount, wht as wht_amount,
  case when ls = 'F' then cast(g - wht as decimal(18,2)) end as payment_amount,
  case when ls = 'F' then cast(sd as date) + 20 end as payment_date,
  case when ls = 'F' then 'paid' else 'unpaid' end as status, l_suppkey % 10 = 0 as is_interco,
  case when l_suppkey % 10 = 0 then {next_sub('s_nationkey')} end as counterpart_sub_id
from c"""

_FX["purchase_orders"] = _OSL + f"""
select {sub('s_nationkey')} as subsidiary_id, 'PO-' || cast(l_orderkey as varchar) || '-' || cast(l_suppkey as varchar) as po_number,
  'VND-' || cast(l_suppkey as varchar) as vendor_id, cast(sd as date) - 14 as order_date,
  cast(sd as date) - 14 + cast(l_orderkey % 14 + 7 as integer) as expected_date,
  case when ls = 'F' then 'received' else 'approved' end as status, g as total_amount
from b"""

_FX["journal_entries"] = """
select subsidiary_id, invoice_date as entry_date, 'JE-' || invoice_number || '-D' as entry_number,
  '2000' as account_code, 'Accounts Receivable' as account_name, gross_amount as debit_amount,
  cast(0 as decimal(18,2)) as credit_amount, invoice_number as reference_doc, is_interco, counterpart_sub_id
from fx_ar_ledger
union all
select subsidiary_id, invoice_date, 'JE-' || invoice_number || '-C', '4000', 'Revenue', cast(0 as decimal(18,2)),
  net_amount, invoice_number, is_interco, counterpart_sub_id from fx_ar_ledger
union all
select subsidiary_id, invoice_date, 'JE-' || invoice_number || '-V', '3000', 'Output VAT', cast(0 as decimal(18,2)),
  vat_amount, invoice_number, is_interco, counterpart_sub_id from fx_ar_ledger"""

_FX["vat_returns"] = """
with m as (select subsidiary_id, cast(extract(year from transaction_date) as int) as period_year,
    cast(extract(month from transaction_date) as int) as period_month,
    cast(sum(gross_amount) as decimal(18,2)) as g, cast(sum(vat_amount) as decimal(18,2)) as ov,
    cast(sum(case when vat_classification = 'exempt' then gross_amount else cast(0 as decimal(18,2)) end) as decimal(18,2)) as ex,
    cast(sum(case when vat_classification = 'zero_rated' then gross_amount else cast(0 as decimal(18,2)) end) as decimal(18,2)) as zr
  from fx_sales_transactions group by 1, 2, 3),
n as (select *, cast(round(g*cast(0.08 as decimal(4,2)),2) as decimal(18,2)) as iv from m)
select subsidiary_id, period_month, period_year, '2550M' as form_type, g as gross_sales, ex as exempt_sales,
  zr as zero_rated_sales, cast(g - ex - zr as decimal(18,2)) as taxable_sales, ov as output_vat,
  iv as input_vat, cast(ov - iv as decimal(18,2)) as vat_payable,
  make_date(period_year, period_month, 20) as filing_date,
  case when period_month % 4 = 0 then 'late' else 'filed' end as status
from n"""

_FX["customers"] = f"""
select c_custkey as id, {sub('c_nationkey')} as subsidiary_id, 'CUST-' || cast(c_custkey as varchar) as customer_id,
  c_name as customer_name, cast(c_custkey + 300000000 as varchar) as customer_tin,
  'customer' || cast(c_custkey as varchar) || '@example.com' as contact_email,
  c_acctbal >= 0 as is_active, c_acctbal < -500 as is_deleted
from customer"""

_FX["sales_orders"] = f"""
select o_orderkey as id, {sub('c_nationkey')} as subsidiary_id, 'SO-' || cast(o_orderkey as varchar) as so_number,
  'CUST-' || cast(o_custkey as varchar) as customer_id, cast(o_orderdate as date) as order_date,
  case when o_orderstatus <> 'O' then cast(o_orderdate as date) + cast(o_orderkey % 15 as integer) end as ship_date,
  case o_orderstatus when 'F' then 'completed' when 'P' then 'shipped' else 'pending' end as status,
  cast(o_totalprice as decimal(18,2)) as total_amount
from orders o join customer c on o.o_custkey = c.c_custkey"""

_FX["campaigns"] = f"""
with p as (select *, cast(p_retailprice as decimal(18,2)) as rp,
    date '2020-01-01' + cast(p_partkey % 730 as integer) as sd from part)
select p_partkey as id, {sub('p_partkey')} as subsidiary_id, 'CMP-' || cast(p_partkey as varchar) as campaign_id,
  p_name as campaign_name,
  case p_partkey % 6 when 0 then 'digital' when 1 then 'print' when 2 then 'events' when 3 then 'radio'
    when 4 then 'tv' else 'referral' end as campaign_type,
  p_brand as channel, sd as start_date,
  case when p_size % 10 <> 0 then sd + p_size * 3 end as end_date,
  cast(rp * 100 as decimal(18,2)) as budget_amount, cast(rp * p_size as decimal(18,2)) as actual_spend,
  p_size * 10 as leads_generated, p_size as conversions,
  cast(rp * p_size * 3 as decimal(18,2)) as revenue_attributed,
  case p_partkey % 4 when 0 then 'planned' when 1 then 'active' when 2 then 'completed' else 'cancelled' end as status
from p"""

_FX["employees"] = f"""
select c_custkey as id, {sub('c_nationkey')} as subsidiary_id, 'EMP-' || cast(c_custkey as varchar) as employee_id,
  c_name as first_name, c_mktsegment as last_name, cast(100000000 + c_custkey as varchar) as tin,
  cast(340000000 + c_custkey as varchar) as sss_number, cast(120000000 + c_custkey as varchar) as philhealth_number,
  cast(121000000 + c_custkey as varchar) as pagibig_number, c_mktsegment as department,
  case c_custkey % 3 when 0 then 'Staff' when 1 then 'Supervisor' else 'Manager' end as position,
  case when c_custkey % 10 < 7 then 'regular' else 'contractual' end as employment_type,
  date '1990-01-01' + cast(c_custkey % 3650 as integer) as date_hired,
  cast(abs(c_acctbal) as decimal(18,2)) as basic_salary
from customer"""

_FX["payroll_runs"] = f"""
with b as (select o.o_orderkey, o.o_custkey, o.o_orderdate, c.c_nationkey,
    cast(abs(c.c_acctbal) as decimal(18,2)) as gp from orders o join customer c on o.o_custkey = c.c_custkey),
d as (select *, cast(cast(round(gp*cast(0.08 as decimal(4,2)),2) as decimal(18,2))
    + cast(round(gp*cast(0.03 as decimal(4,2)),2) as decimal(18,2))
    + cast(round(gp*cast(0.02 as decimal(4,2)),2) as decimal(18,2)) as decimal(18,2)) as ded from b)
select o_orderkey as id, {sub('c_nationkey')} as subsidiary_id, strftime(o_orderdate, '%Y-%m') as payroll_period,
  'EMP-' || cast(o_custkey as varchar) as employee_id, gp as gross_pay, ded as total_deductions,
  cast(gp - ded as decimal(18,2)) as net_pay, last_day(cast(o_orderdate as date)) as payroll_date
from d"""

_FX["statutory_contributions"] = """
with m as (select subsidiary_id, cast(year(payroll_date) as int) as period_year, cast(month(payroll_date) as int) as period_month,
    cast(sum(gross_pay) as decimal(18,2)) as g from fx_payroll_runs group by 1, 2, 3),
r as (select *, cast(round(g*cast(0.095 as decimal(5,3)),2) as decimal(18,2)) as a,
    cast(round(g*cast(0.045 as decimal(5,3)),2) as decimal(18,2)) as b,
    cast(round(g*cast(0.025 as decimal(5,3)),2) as decimal(18,2)) as c,
    cast(round(g*cast(0.025 as decimal(5,3)),2) as decimal(18,2)) as d,
    cast(round(g*cast(0.02 as decimal(4,2)),2) as decimal(18,2)) as e,
    cast(round(g*cast(0.02 as decimal(4,2)),2) as decimal(18,2)) as f from m)
select subsidiary_id, period_month, period_year, a as sss_employer, b as sss_employee,
  c as philhealth_employer, d as philhealth_employee, e as pagibig_employer, f as pagibig_employee,
  cast(a + b + c + d + e + f as decimal(18,2)) as total_amount
from r"""

_FX["vendors"] = f"""
select s_suppkey as id, {sub('s_nationkey')} as subsidiary_id, 'VND-' || cast(s_suppkey as varchar) as vendor_id,
  s_name as vendor_name, cast(200000000 + s_suppkey as varchar) as vendor_tin,
  case s_suppkey % 3 when 0 then 'goods' when 1 then 'services' else 'mixed' end as vendor_type,
  case s_suppkey % 3 when 0 then '30' when 1 then '45' else '60' end as payment_terms,
  s_suppkey % 5 <> 0 as is_accredited
from supplier"""

_FX["wht_filings"] = """
with r as (select *, cast(case when gross_amount >= 100000 then '0.05' when gross_amount >= 50000 then '0.02'
    else '0.01' end as decimal(6,4)) as rt from fx_ap_invoices)
select subsidiary_id, '1601E' as form_type, cast(month(invoice_date) as int) as period_month,
  cast(year(invoice_date) as int) as period_year, vendor_tin as payee_tin, vendor_name as payee_name,
  gross_amount as income_payment,
  case when gross_amount >= 100000 then 'WC155' when gross_amount >= 50000 then 'WC030' else 'WC010' end as atc_code,
  rt as tax_rate, cast(round(gross_amount * rt, 2) as decimal(18,2)) as wht_amount,
  case when status = 'paid' then invoice_date + 10 end as filing_date,
  case when status = 'paid' then 'filed' else 'pending' end as status
from r"""

_FX["wht_certificates"] = """
select subsidiary_id, '2307-' || cast(year(invoice_date) as varchar) || '-' || subsidiary_id || '-' || invoice_number as cert_number,
  vendor_id, 'WC010' as atc_code, gross_amount as income_payment, cast(0.01 as decimal(6,4)) as tax_rate,
  wht_amount, invoice_date + 5 as issued_date
from fx_ap_invoices"""

_FX["bir_filings_log"] = f"""
with b as (select *, case when o_orderkey % 20 > 10 then cast(500.25 as decimal(18,2)) else cast(0 as decimal(18,2)) end as sur,
    case when o_orderkey % 20 > 15 then cast(100.10 as decimal(18,2)) else cast(0 as decimal(18,2)) end as intr from orders)
select o_orderkey as id, {sub('o_custkey')} as subsidiary_id,
  case o_orderkey % 4 when 0 then '2550M' when 1 then '2550Q' when 2 then '1601C' else '1601E' end as form_type,
  strftime(o_orderdate, '%Y-%m') as period_covered, cast(o_orderdate as date) as due_date,
  case when o_orderstatus <> 'O' then cast(o_orderdate as date) + cast(o_orderkey % 20 as integer) - 10 end as filing_date,
  cast(o_totalprice as decimal(18,2)) as amount_paid, sur as surcharge_amount, intr as interest_amount,
  cast(0 as decimal(18,2)) as compromise_amount, cast(sur + intr as decimal(18,2)) as penalty_amount,
  case o_orderstatus when 'F' then 'accepted' when 'O' then 'pending' else 'rejected' end as status
from b"""

_FX["inventory_movements"] = f"""
select {sub('s.s_nationkey')} as subsidiary_id, cast(l.l_shipdate as date) as movement_date,
  case when l.l_returnflag = 'A' then 'receipt' when l.l_returnflag = 'R' then 'adjustment'
    when l.l_linestatus = 'O' then 'issue' else 'transfer' end as movement_type,
  'SKU-' || cast(l.l_partkey as varchar) as item_code, cast(l.l_quantity as int) as quantity,
  cast(p.p_retailprice as decimal(18,2)) as unit_cost,
  cast(cast(l.l_quantity as int) * cast(p.p_retailprice as decimal(18,2)) as decimal(18,2)) as total_cost,
  'WH-' || cast(1 + l.l_suppkey % 2 as varchar) as warehouse_location,
  'PO-' || cast(l.l_orderkey as varchar) as reference_doc
from lineitem l join supplier s on l.l_suppkey = s.s_suppkey join part p on l.l_partkey = p.p_partkey"""

_FX["stockholders"] = f"""
select s_suppkey as id, {sub('s_nationkey')} as subsidiary_id, 'SH-' || cast(s_suppkey as varchar) as stockholder_id,
  s_name as name, cast(s_suppkey % 9 + 1 as decimal(6,2)) as ownership_pct, s_nationkey % 4 = 0 as is_foreign
from supplier"""

_FX["officers"] = f"""
select s_suppkey as id, {sub('s_nationkey')} as subsidiary_id, 'OFF-' || cast(s_suppkey as varchar) as officer_id,
  s_name as name,
  case s_suppkey % 4 when 0 then 'President' when 1 then 'Treasurer' when 2 then 'Corporate Secretary' else 'Director' end as position,
  date '2015-01-01' + cast(s_suppkey % 3000 as integer) as start_date,
  case when s_suppkey % 5 = 0 then date '2015-01-01' + cast(s_suppkey % 3000 as integer) + 365 end as end_date
from supplier"""

_FX["board_resolutions"] = f"""
select o_orderkey as id, {sub('o_custkey')} as subsidiary_id, 'BR-' || cast(o_orderkey as varchar) as resolution_number,
  cast(o_orderdate as date) as resolution_date, 'Approval of order ' || cast(o_orderkey as varchar) as title,
  'Board of Directors' as enacted_by
from orders"""

_FX["sec_filings"] = f"""
with b as (select *, cast(o_orderdate as date) + 30 as due,
    case when o_orderstatus <> 'O' then cast(o_orderdate as date) + cast(o_orderkey % 45 as integer) end as filed
  from orders)
select o_orderkey as id, {sub('o_custkey')} as subsidiary_id,
  case o_orderkey % 3 when 0 then 'GIS' when 1 then 'AFS' else 'ACGR' end as filing_type,
  due as due_date, filed as filing_date,
  case when filed is null then 'pending' when filed > due then 'late' else 'filed' end as status,
  'SEC-' || cast(o_orderkey as varchar) as reference_number
from b"""

_RISK = ("case when value > 200 then 'critical' when value > 100 then 'high' "
         "when value > 25 then 'medium' else 'low' end")

_FX["audit_log"] = f"""
select event_id as id, {sub('user_id')} as subsidiary_id, ts as event_timestamp,
  'USER-' || cast(user_id as varchar) as user_id,
  case event_type when 'signup' then 'LOGIN' when 'click' then 'READ' when 'view' then 'READ'
    when 'purchase' then 'EXPORT' else 'DELETE' end as action,
  case when event_type = 'error' then 'failed' else 'success' end as result,
  {_RISK} as risk_level
from events"""

_FX["access_events"] = f"""
select event_id as id, {sub('user_id')} as subsidiary_id, ts as event_timestamp,
  'USER-' || cast(user_id as varchar) as user_id,
  case event_type when 'signup' then 'LOGIN' when 'purchase' then 'EXPORT' else 'VIEW' end as action,
  case event_type when 'purchase' then 'orders' when 'signup' then 'accounts' else 'reports' end as resource,
  json_extract_string(props, '$.k') as resource_id,
  '10.0.' || cast(user_id % 256 as varchar) || '.' || cast(event_id % 256 as varchar) as ip_address,
  case when event_type = 'error' then 'denied' else 'allowed' end as result
from events"""

_FX["system_incidents"] = f"""
select event_id as id, {sub('user_id')} as subsidiary_id, 'INC-' || cast(event_id as varchar) as incident_id,
  cast(ts as date) as incident_date,
  case when value > 100 then 'outage' when value > 25 then 'security' else 'bug' end as incident_type,
  {_RISK} as severity, 'error event ' || cast(event_id as varchar) as description,
  case when event_id % 5 <> 0 then cast(ts as date) + cast(event_id % 5 as integer) end as resolved_date
from events where event_type = 'error'"""

# Kafka-shaped change messages (not a bronze table: no conform step).
CDC_RAW = """
with e as (select *, cast(user_id as varchar) as uid, user_id % 2 <> 0 as emp,
    cast(cast(value as decimal(18,2)) as varchar) as amt from events)
select case user_id % 3 when 0 then 'abc' when 1 then 'xyz' else 'rtl' end || '.' ||
    case when not emp then 'sales.customers' else 'hr.employees' end as topic,
  cast(user_id % 4 as integer) as "partition", event_id as "offset", ts as "timestamp",
  '{"op":"' || case event_type when 'signup' then 'c' when 'error' then 'd' when 'click' then 'r' else 'u' end
    || '","before":' || case when event_type = 'error' then '{"id":' || uid || '}' else 'null' end
    || ',"after":' || case
      when event_type = 'error' then 'null'
      when event_type = 'view' and emp then '{"id":' || uid || ',"position":"' || event_type || '"}'
      when event_type = 'view' then '{"id":' || uid || ',"customer_name":"' || event_type || '"}'
      when emp then '{"id":' || uid || ',"employee_id":"EMP-' || uid || '","position":"' || event_type
        || '","basic_salary":' || amt || '}'
      else '{"id":' || uid || ',"customer_id":"CUST-' || uid || '","customer_name":"' || event_type
        || '","phone":"' || cast(event_id as varchar) || '"}' end
    || ',"ts_ms":' || cast(epoch_us(ts) // 1000 as varchar) || '}' as value
from e"""

SUBSIDIARIES_SQL = """
select * from (values
  (1, 'ABC', 'ABC Trading Inc.', '123-456-789-000', 'CS201900001', '040', 'Trading', cast(1.00 as decimal(5,2)), 1),
  (2, 'XYZ', 'XYZ Manufacturing Corp.', '987-654-321-000', 'CS202000002', '041', 'Manufacturing', cast(1.10 as decimal(5,2)), 1),
  (3, 'RTL', 'PH Retail Co.', '456-123-789-000', 'CS202100088', '044', 'Retail', cast(0.75 as decimal(5,2)), 1))
  t(id, subsidiary_id, name, tin, sec_reg, bir_rdo, industry, scale_factor, fiscal_year_start)"""


def _stg_sql(model: str) -> str:
    table = STAGING[model][0]
    cols = []
    for out, src in columns_of(model):
        if src.startswith("null:"):
            cols.append(f"cast(null as {_duck_type(src[5:])}) as {out}")
        else:
            cols.append(f"{src} as {out}" if src != out else out)
    return f"select {', '.join(cols)} from br_{table}"


_SV: dict[str, str] = {
    "dim_employees": """select subsidiary_id, employee_id, first_name, last_name, sha256(tin) as tin_hashed,
        department, position, employment_type, date_hired, basic_salary from stg_employees""",
    "dim_vendors": """select subsidiary_id, vendor_id, vendor_name, vendor_tin, vendor_type, payment_terms,
        is_accredited, ingested_at from stg_procurement__vendors""",
    "fact_ap_invoices": """select subsidiary_id, invoice_number, vendor_id, vendor_name, invoice_date, due_date,
        gross_amount, vat_amount, net_amount, wht_amount, payment_amount, payment_date, status, is_interco,
        counterpart_sub_id, ingested_at, cast(extract(year from invoice_date) as int) as fiscal_year,
        cast(extract(month from invoice_date) as int) as fiscal_month from stg_finance__ap_invoices""",
    "fact_ar_ledger": """select subsidiary_id, invoice_number, customer_id, customer_name, invoice_date, due_date,
        gross_amount, vat_amount, net_amount, collected_amount, collection_date, status, is_interco,
        counterpart_sub_id, ingested_at, cast(extract(year from invoice_date) as int) as fiscal_year,
        cast(extract(month from invoice_date) as int) as fiscal_month from stg_finance__ar_ledger""",
    "fact_finance_journal_entries": """select subsidiary_id, entry_date, entry_number, account_code, account_name,
        debit_amount, credit_amount, description, reference_doc, is_interco, counterpart_sub_id, cost_center,
        posted_by, approved_by, ingested_at, cast(extract(year from entry_date) as int) as fiscal_year,
        cast(extract(month from entry_date) as int) as fiscal_month from stg_finance__journal_entries""",
    "fact_inventory_movements": """select subsidiary_id, movement_date, movement_type, item_code, quantity,
        unit_cost, total_cost, warehouse_location, reference_doc, ingested_at,
        cast(extract(year from movement_date) as int) as fiscal_year,
        cast(extract(month from movement_date) as int) as fiscal_month from stg_ops__inventory_movements""",
    "fact_sales": """select subsidiary_id, invoice_number, customer_name, invoice_date, gross_amount,
        discount_amount, vat_amount, net_amount, vat_classification, is_interco, counterpart_sub_id,
        ingested_at, cast(extract(year from invoice_date) as int) as fiscal_year,
        cast(extract(month from invoice_date) as int) as fiscal_month from stg_sales_transactions""",
    "fact_tax_vat_returns": """select subsidiary_id, period_month, period_year, form_type, gross_sales,
        exempt_sales, zero_rated_sales, taxable_sales, output_vat, input_vat, vat_payable, filing_date,
        status, ingested_at from stg_tax__vat_returns""",
}


def cte_body(name: str) -> str | None:
    if name == "fx_cdc_raw":
        return CDC_RAW
    if name == "fx_subsidiaries":
        return SUBSIDIARIES_SQL
    if name.startswith("fx_") and name[3:] in _FX:
        return _conform(name[3:], _FX[name[3:]])
    if name.startswith("br_") and name[3:] in _FX:
        return f"select * from fx_{name[3:]} where not coalesce(is_deleted, false)"
    if name in STAGING:
        return _stg_sql(name)
    if name.startswith("sv_") and name[3:] in _SV:
        return _SV[name[3:]].replace("from stg_", "from stg_")
    return EXTRA_CTES.get(name)


# Additional shared CTEs registered by other modules (name -> SQL body).
EXTRA_CTES: dict[str, str] = {}

_REF = re.compile(r"\b((?:fx|br|sv|ox)_[a-z0-9_]+|stg_[a-z0-9_]+)\b")


def with_ctes(sql: str) -> str:
    """Prepend, in dependency order, every CTE that ``sql`` references."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str):
        if name in seen:
            return
        body = cte_body(name)
        if body is None:
            return
        seen.add(name)
        for dep in _REF.findall(body):
            if dep != name:
                visit(dep)
        order.append(name)

    for ref in _REF.findall(sql):
        visit(ref)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{n} as ({cte_body(n).strip()})" for n in order)
    body = sql.strip()
    m = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if m:
        return f"with {m.group(1) or ''}{ctes},\n{body[m.end():]}"
    return f"with {ctes}\n{body}"
