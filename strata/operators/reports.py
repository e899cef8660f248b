"""Reports computed from bronze / silver tables.

Every report is a filtered hash aggregate (partial + final), so a subsidiary
or vendor holding a large share of rows is combined map-side before the
shuffle. Where two sides meet (vendor scorecard, interco elimination, access
risk) both sides are aggregated first and the small aggregates are joined.
Ratios are doubles from ``try_divide`` (NULL when the denominator is 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import aging_bucket, safe_ratio


def _d(x: str) -> Column:
    return F.lit(x).cast("date")


def trial_balance(journal: DataFrame, as_of: str) -> DataFrame:
    """B1: debit and credit balances per subsidiary and account up to ``as_of``."""
    return (journal.filter(F.col("entry_date") <= _d(as_of))
                   .groupBy("subsidiary_id", "account_code")
                   .agg(F.sum("debit_amount").alias("debit_balance"),
                        F.sum("credit_amount").alias("credit_balance"))
                   .withColumn("as_of_date", _d(as_of)))


def _aging(df: DataFrame, party: str, outstanding: Column, open_filter: Column,
           as_of: str) -> DataFrame:
    days = F.datediff(_d(as_of), F.col("invoice_date"))
    b = (df.filter(open_filter & (F.col("invoice_date") <= _d(as_of)))
           .select("subsidiary_id", party, outstanding.alias("_out"), aging_bucket(days).alias("_b")))
    zero = F.lit(0).cast("decimal(18,2)")

    def bucket(name):
        return F.sum(F.when(F.col("_b") == name, F.col("_out")).otherwise(zero))

    return (b.groupBy("subsidiary_id", party)
             .agg(bucket("0-30").alias("current"), bucket("31-60").alias("aging_31_60"),
                  bucket("61-90").alias("aging_61_90"), bucket("90+").alias("aging_over_90"),
                  F.sum("_out").alias("total_outstanding"))
             .withColumn("as_of_date", _d(as_of)))


def ap_aging_detail(ap: DataFrame, as_of: str) -> DataFrame:
    """B2: unpaid AP per vendor in 0-30 / 31-60 / 61-90 / 90+ day buckets."""
    out = F.col("gross_amount") - F.coalesce(F.col("payment_amount"), F.lit(0))
    return _aging(ap, "vendor_id", out, F.col("status") != "paid", as_of)


def ar_aging(ar: DataFrame, as_of: str) -> DataFrame:
    """Uncollected AR per customer in the same buckets."""
    out = F.col("gross_amount") - F.coalesce(F.col("collected_amount"), F.lit(0))
    return _aging(ar, "customer_id", out, F.col("status") != "collected", as_of)


# Signed effect of each movement type on stock on hand.
MOVEMENT_SIGN = {"receipt": 1, "issue": -1, "transfer": 0, "adjustment": 1}


def stock_summary(inv: DataFrame, as_of: str, usage_days: int = 30) -> DataFrame:
    """Stock on hand, last unit cost, value and days of stock per item and warehouse.

    days_of_stock = quantity / max(1, average daily issues over the trailing
    ``usage_days`` days).
    """
    sign = F.coalesce(F.create_map(*[F.lit(x) for kv in MOVEMENT_SIGN.items() for x in kv])
                      [F.col("movement_type")], F.lit(0))
    in_window = F.col("movement_date") > F.date_sub(_d(as_of), usage_days)
    issued = F.when((F.col("movement_type") == "issue") & in_window, F.col("quantity")).otherwise(0)
    g = (inv.filter(F.col("movement_date") <= _d(as_of))
            .groupBy("subsidiary_id", "item_code", "warehouse_location")
            .agg(F.sum(sign * F.col("quantity")).alias("quantity_on_hand"),
                 F.max_by("unit_cost", F.struct("movement_date", "unit_cost")).alias("unit_cost"),
                 F.sum(issued).alias("_issued")))
    return g.select(
        "subsidiary_id", "item_code", "warehouse_location", "quantity_on_hand", "unit_cost",
        (F.col("quantity_on_hand") * F.col("unit_cost")).cast("decimal(28,2)").alias("total_value"),
        ((F.col("quantity_on_hand") * usage_days).cast("double")
         / F.greatest(F.lit(usage_days), F.col("_issued")).cast("double")).alias("days_of_stock"),
        _d(as_of).alias("as_of_date"))


def vendor_scorecard(po: DataFrame, ap: DataFrame) -> DataFrame:
    """Per vendor and order month: on-time delivery, fill rate, payment
    compliance and price variance.

    A purchase order and its supplier invoice share the document number
    (``PO-<n>`` / ``AP-<n>``); the invoice date is the receipt date.
    """
    p = po.select("subsidiary_id", "vendor_id", F.expr("substring(po_number, 4)").alias("_doc"),
                  "order_date", "expected_date", F.col("total_amount").alias("_ordered"),
                  F.col("status").alias("_po_status"))
    a = ap.select("subsidiary_id", "vendor_id", F.expr("substring(invoice_number, 4)").alias("_doc"),
                  F.col("invoice_date").alias("_received"), "due_date", "payment_date",
                  F.col("gross_amount").alias("_billed"), F.col("status").alias("_ap_status"))
    j = p.join(a, ["subsidiary_id", "vendor_id", "_doc"], "left")
    received = F.col("_received").isNotNull()
    paid = F.col("_ap_status") == "paid"
    g = (j.filter(F.col("_po_status") != "cancelled")
          .groupBy("subsidiary_id", "vendor_id", F.year("order_date").alias("year"),
                   F.month("order_date").alias("month"))
          .agg(F.count(F.when(received, 1)).alias("_recv"),
               F.count(F.when(received & (F.col("_received") <= F.col("expected_date")), 1)).alias("_ontime"),
               F.count(F.lit(1)).alias("_pos"),
               F.count(F.when(paid, 1)).alias("_paid"),
               F.count(F.when(paid & (F.col("payment_date") <= F.col("due_date")), 1)).alias("_paid_ok"),
               F.sum("_ordered").alias("_ordered"), F.sum("_billed").alias("_billed")))
    return g.select(
        "subsidiary_id", "vendor_id", "month", "year",
        safe_ratio("_ontime", "_recv").alias("on_time_delivery_rate"),
        safe_ratio("_recv", "_pos").alias("po_fill_rate"),
        safe_ratio("_paid_ok", "_paid").alias("payment_compliance"),
        safe_ratio(F.col("_billed") - F.col("_ordered"), "_ordered").alias("price_variance"))


def alphalist(wht: DataFrame, year: int | None = None) -> DataFrame:
    """Income payments and tax withheld per payee, ATC code and year."""
    df = wht if year is None else wht.filter(F.col("period_year") == year)
    return (df.groupBy("subsidiary_id", "payee_name", F.col("payee_tin").alias("tin"), "atc_code",
                       F.col("period_year").alias("year"))
              .agg(F.sum("income_payment").alias("income_payment"),
                   F.sum("wht_amount").alias("wht_withheld")))


def dole_report(employees: DataFrame, payroll: DataFrame, year: int, report_date: str) -> DataFrame:
    """Headcount by employment type, average salary and wages paid in ``year``.

    (The male / female shares of the original report have no source field.)
    """
    end = F.make_date(F.lit(year), F.lit(12), F.lit(31))
    e = (employees.filter(F.col("date_hired").isNull() | (F.col("date_hired") <= end))
                  .groupBy("subsidiary_id")
                  .agg(F.count(F.lit(1)).alias("total_employees"),
                       F.count(F.when(F.col("employment_type") == "regular", 1)).alias("regular_count"),
                       F.count(F.when(F.col("employment_type") == "contractual", 1)).alias("contractual_count"),
                       (F.sum("basic_salary").cast("double") / F.count("basic_salary"))
                       .alias("avg_monthly_salary")))
    w = (payroll.filter(F.year("payroll_date") == year).groupBy("subsidiary_id")
                .agg(F.sum("gross_pay").alias("total_wages")))
    return (e.join(w, "subsidiary_id", "left")
             .select("subsidiary_id", F.lit(year).alias("year"), "total_employees", "regular_count",
                     "contractual_count", "avg_monthly_salary", "total_wages",
                     _d(report_date).alias("report_date")))


def revenue_summary(fact_sales: DataFrame, year: int, month: int = 0) -> DataFrame:
    """Sales totals per subsidiary for a month; ``month = 0`` = whole year."""
    df = fact_sales.filter(F.col("fiscal_year") == year)
    if month:
        df = df.filter(F.col("fiscal_month") == month)
    return (df.groupBy("subsidiary_id")
              .agg(F.sum("gross_amount").alias("gross_amount"),
                   F.sum("discount_amount").alias("discount_amount"),
                   F.sum("vat_amount").alias("vat_amount"), F.sum("net_amount").alias("net_amount"),
                   F.count(F.lit(1)).alias("invoice_count"))
              .select("subsidiary_id", F.lit(year).alias("year"), F.lit(month).alias("month"),
                      "gross_amount", "discount_amount", "vat_amount", "net_amount", "invoice_count"))


def bir_compliance_scorecard(bir: DataFrame, form_codes: DataFrame) -> DataFrame:
    """Filings, late filings, pending and penalties per form and fiscal year.

    The form-code seed is a handful of rows, so it is broadcast; codes absent
    from the seed keep a NULL description (D20).
    """
    filed = F.col("filing_date").isNotNull()
    late = filed & (F.col("filing_date") > F.col("due_date"))
    g = (bir.groupBy("subsidiary_id", "form_type", F.year("due_date").alias("fiscal_year"))
            .agg(F.count(F.when(filed, 1)).alias("filed"), F.count(F.when(late, 1)).alias("late"),
                 F.count(F.when(F.col("status") == "pending", 1)).alias("pending"),
                 F.sum("penalty_amount").alias("penalties")))
    g = g.withColumn("on_time_rate", safe_ratio(F.col("filed") - F.col("late"), "filed"))
    codes = form_codes.select(F.col("form_code").alias("form_type"),
                              F.col("description").alias("form_description"))
    return g.join(F.broadcast(codes), "form_type", "left")


def interco_elimination(fact_sales: DataFrame, fact_ap: DataFrame) -> DataFrame:
    """Intercompany sales vs the counterpart's intercompany purchases.

    Each side is aggregated per (seller, buyer, year, month) first; the full
    join on the swapped pair only meets the small aggregates. ``eliminated``
    is the amount both sides agree on (the smaller one).
    """
    keys = ["seller", "buyer", "fiscal_year", "fiscal_month"]
    s = (fact_sales.filter(F.col("is_interco") & F.col("counterpart_sub_id").isNotNull())
                   .groupBy(F.col("subsidiary_id").alias("seller"),
                            F.col("counterpart_sub_id").alias("buyer"), "fiscal_year", "fiscal_month")
                   .agg(F.sum("gross_amount").alias("interco_sales")))
    p = (fact_ap.filter(F.col("is_interco") & F.col("counterpart_sub_id").isNotNull())
                .groupBy(F.col("counterpart_sub_id").alias("seller"),
                         F.col("subsidiary_id").alias("buyer"), "fiscal_year", "fiscal_month")
                .agg(F.sum("gross_amount").alias("interco_purchases")))
    zero = F.lit(0).cast("decimal(28,2)")
    j = s.join(p, keys, "full")
    sales = F.coalesce("interco_sales", zero)
    purch = F.coalesce("interco_purchases", zero)
    elim = F.least(sales, purch)
    return j.select(F.col("seller").alias("subsidiary_id"), F.col("buyer").alias("counterpart_sub_id"),
                    "fiscal_year", "fiscal_month", sales.alias("interco_sales"),
                    purch.alias("interco_purchases"), elim.alias("eliminated"),
                    F.abs(sales - purch).alias("unreconciled"),
                    (sales - elim).alias("net_after_elimination"))


def campaign_performance(campaigns: DataFrame) -> DataFrame:
    """Conversion rate, cost per lead, ROI and budget use per campaign."""
    return campaigns.select(
        "subsidiary_id", "campaign_id", "campaign_type", "status",
        safe_ratio("conversions", "leads_generated").alias("conversion_rate"),
        safe_ratio("actual_spend", "leads_generated").alias("cost_per_lead"),
        safe_ratio(F.col("revenue_attributed") - F.col("actual_spend"), "actual_spend").alias("roi"),
        safe_ratio("actual_spend", "budget_amount").alias("budget_utilisation"))


def access_risk(audit: DataFrame, access: DataFrame) -> DataFrame:
    """Failed and high-risk actions (audit log) and denied accesses per user and day."""
    a = (audit.groupBy("subsidiary_id", F.to_date("event_timestamp").alias("event_date"), "user_id")
              .agg(F.count(F.when(F.col("result") == "failed", 1)).alias("failed_actions"),
                   F.count(F.when(F.col("risk_level").isin("high", "critical"), 1)).alias("high_risk_actions")))
    d = (access.groupBy("subsidiary_id", F.to_date("event_timestamp").alias("event_date"), "user_id")
               .agg(F.count(F.when(F.col("result") == "denied", 1)).alias("denied_access")))
    j = a.join(d, ["subsidiary_id", "event_date", "user_id"], "full")
    return j.select("subsidiary_id", "event_date", "user_id",
                    F.coalesce("failed_actions", F.lit(0)).alias("failed_actions"),
                    F.coalesce("high_risk_actions", F.lit(0)).alias("high_risk_actions"),
                    F.coalesce("denied_access", F.lit(0)).alias("denied_access"))


def incident_resolution(incidents: DataFrame) -> DataFrame:
    """Incidents, open incidents and mean days to resolve per severity."""
    days = F.datediff("resolved_date", "incident_date")
    return (incidents.groupBy("subsidiary_id", "severity")
                     .agg(F.count(F.lit(1)).alias("incidents"),
                          F.count(F.when(F.col("resolved_date").isNull(), 1)).alias("open_incidents"),
                          safe_ratio(F.sum(days), F.count(days)).alias("avg_resolution_days")))


def ownership_summary(holders: DataFrame) -> DataFrame:
    """Foreign and local ownership share per subsidiary (closed percentages)."""
    zero = F.lit(0).cast("decimal(6,2)")
    return (holders.groupBy("subsidiary_id")
                   .agg(F.count(F.lit(1)).alias("holders"),
                        F.count(F.when(F.col("is_foreign"), 1)).alias("foreign_holders"),
                        F.sum(F.when(F.col("is_foreign"), F.col("ownership_pct")).otherwise(zero))
                        .alias("foreign_pct"),
                        F.sum(F.when(~F.col("is_foreign"), F.col("ownership_pct")).otherwise(zero))
                        .alias("local_pct")))


def filing_timeliness(sec: DataFrame) -> DataFrame:
    """SEC filings on time, late and missing per type and year."""
    filed = F.col("filing_date").isNotNull()
    return (sec.groupBy("subsidiary_id", "filing_type", F.year("due_date").alias("year"))
               .agg(F.count(F.when(filed & (F.col("filing_date") <= F.col("due_date")), 1)).alias("on_time"),
                    F.count(F.when(filed & (F.col("filing_date") > F.col("due_date")), 1)).alias("late"),
                    F.count(F.when(~filed, 1)).alias("missing")))
