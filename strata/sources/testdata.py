"""Bronze domain tables derived from the driver's TPC-H-like test tables.

Every fixture is pure DataFrame code over the given parquet tables, so its
work grows with them. Money is built in decimal before any rounding (double
products round differently between engines). The SQL twin of each fixture is
in ``strata.plans.oracle`` and must stay row-for-row equal.

Join order matters at scale: the small side of each chain is joined first
(orders with customer before lineitem), so the big lineitem side is shuffled
once. Dimension joins (supplier, part) are left to AQE, which broadcasts them
only when their measured size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import MONEY, money, money_round, rate_of, ts_to_epoch_ms
from strata.schemas import CAMPAIGN_STATUSES, CAMPAIGN_TYPES, TABLES, Table
from strata.sources import store

# The load time stamped on every fixture row.
INGESTED_AT = "2024-02-01 00:00:00"

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def ingested_at() -> Column:
    return F.lit(INGESTED_AT).cast("timestamp_ntz")


def sub_of(key) -> Column:
    """Tenant of a numeric key: 0 -> ABC, 1 -> XYZ, 2 -> RTL."""
    return F.element_at(F.array(F.lit("ABC"), F.lit("XYZ"), F.lit("RTL")),
                        (F.col(key) % 3).cast("int") + 1) if isinstance(key, str) else \
        F.element_at(F.array(F.lit("ABC"), F.lit("XYZ"), F.lit("RTL")), (key % 3).cast("int") + 1)


def next_sub_of(key) -> Column:
    """The counterpart tenant of an intercompany row: ABC -> XYZ -> RTL -> ABC."""
    k = F.col(key) if isinstance(key, str) else key
    return F.element_at(F.array(F.lit("XYZ"), F.lit("RTL"), F.lit("ABC")), (k % 3).cast("int") + 1)


def s(x) -> Column:
    return F.col(x).cast("string")


def conform(df: DataFrame, table: Table | str, id_cols: list[str] | None = None) -> DataFrame:
    """Project ``df`` onto the bronze schema: defaults, audit columns, types, order."""
    t = TABLES[table] if isinstance(table, str) else table
    have = set(df.columns)
    if "id" not in have:
        keys = id_cols or list(t.keys) or [c for c in df.columns]
        # Only for rows without a unique source key; all others bring an id composed of theirs.
        df = df.withColumn("id", F.xxhash64(*keys))
    if "source_dept" not in have and "source_dept" in t.names:
        df = df.withColumn("source_dept", F.lit(t.dept))
    if "ingested_at" not in have and "ingested_at" in t.names:
        df = df.withColumn("ingested_at", ingested_at())
    if "is_deleted" not in have:
        df = df.withColumn("is_deleted", F.lit(False))
    if "deleted_at" not in have:
        df = df.withColumn("deleted_at", F.when(F.col("is_deleted"), ingested_at()))
    cols = []
    for c in t.columns:
        if c.name in df.columns:
            cols.append(F.col(c.name).cast(c.dtype).alias(c.name))
        else:
            cols.append(F.lit(None).cast(c.dtype).alias(c.name))
    return df.select(*cols)


class TestTables:
    """Reads the driver's parquet tables, one DataFrame per table per session.

    The test files hold one Parquet row group each, so a scan is a single
    task. When a scan yields fewer splits than the cluster's parallelism, its
    rows are spread once (hash on the table's key) so the derivations after
    it use every core; large inputs (many splits) are left as they are. Orders
    and events fan out into change messages, so these are spread until a
    partition holds a few megabytes of the file: a task's memory then stays
    the same when the table grows.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            try:
                par = self.spark.sparkContext.defaultParallelism
                if name in FAN_OUT_BYTES:
                    par = max(par, -(-store.size_of(self.spark, f"{self.sf_dir}/{name}.parquet") // FAN_OUT_BYTES[name]))
                splits = df.rdd.getNumPartitions()
            except Exception:  # Spark Connect: no RDD API; leave the scan as is
                par, splits = 0, 0
            if name in SPREAD_TABLES and splits < par:
                # hash on the table's key: deterministic on retry without the
                # local sort a round-robin repartition needs
                df = df.repartition(par, SPREAD_TABLES[name])
            self._cache[name] = df
        return self._cache[name]


# Tables large enough to be worth spreading (dimension tables stay as scanned).
SPREAD_TABLES = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id",
                 "customer": "c_custkey", "part": "p_partkey"}
# Bytes of the file for each partition of a table whose rows fan out into messages.
FAN_OUT_BYTES = {"orders": 4_000_000, "events": 4_000_000}


# ---------------------------------------------------------------------------
# Finance / sales
# ---------------------------------------------------------------------------
def _orders_customers(src: TestTables) -> DataFrame:
    o = src("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                             "o_orderdate")
    c = src("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return o.join(c, o.o_custkey == c.c_custkey)


def sales_transactions(src: TestTables) -> DataFrame:
    oc = _orders_customers(src).select("o_orderkey", "o_orderdate", "c_name", "c_nationkey")
    li = src("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                "l_extendedprice", "l_discount", "l_returnflag")
    b = li.join(oc, li.l_orderkey == oc.o_orderkey)
    g = money("l_extendedprice")
    disc = money_round(g * F.col("l_discount").cast("decimal(4,2)"))
    vat = rate_of(g - disc, "0.12")
    interco = (F.col("l_suppkey") % 10) == 0
    df = b.select(
        sub_of("c_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("SALES-"), s("l_orderkey"), F.lit("-"), s("l_linenumber"), F.lit("-"),
                 s("l_partkey"), F.lit("-"), s("l_suppkey")).alias("invoice_number"),
        F.col("c_name").alias("customer_name"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        g.alias("gross_amount"), disc.alias("discount_amount"), vat.alias("vat_amount"),
        money(g - disc + vat).alias("net_amount"),
        F.when(F.col("l_returnflag") == "A", "vatable").when(F.col("l_returnflag") == "N", "exempt")
         .otherwise("zero_rated").alias("vat_classification"),
        interco.alias("is_interco"),
        F.when(interco, next_sub_of("c_nationkey")).alias("counterpart_sub_id"))
    return conform(df, "sales_transactions")


def ar_ledger(src: TestTables) -> DataFrame:
    b = _orders_customers(src)
    g = money("o_totalprice")
    vat = rate_of(g, "0.12")
    d = F.col("o_orderdate").cast("date")
    st = F.col("o_orderstatus")
    interco = (F.col("o_orderkey") % 10) == 0
    df = b.select(
        F.col("o_orderkey").alias("id"),
        sub_of("c_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("AR-"), s("o_orderkey")).alias("invoice_number"),
        F.concat(F.lit("CUST-"), s("o_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        (F.col("o_custkey") + 300000000).cast("string").alias("customer_tin"),
        d.alias("invoice_date"), F.date_add(d, 30).alias("due_date"),
        g.alias("gross_amount"), vat.alias("vat_amount"), money(g - vat).alias("net_amount"),
        F.when(st == "F", g).when(st == "P", rate_of(g, "0.5")).alias("collected_amount"),
        F.when(st == "F", F.date_add(d, 25)).when(st == "P", F.date_add(d, 40))
         .alias("collection_date"),
        F.when(st == "F", "collected").when(st == "P", "overdue").otherwise("open").alias("status"),
        interco.alias("is_interco"),
        F.when(interco, next_sub_of("c_nationkey")).alias("counterpart_sub_id"))
    return conform(df, "ar_ledger")


def _order_supplier_lines(src: TestTables) -> DataFrame:
    """lineitem rolled up per (order, supplier): one invoice / purchase order each."""
    li = src("lineitem")
    a = (li.groupBy("l_orderkey", "l_suppkey")
           .agg(F.min("l_shipdate").alias("sd"), F.max("l_linestatus").alias("ls"),
                money(F.sum(money("l_extendedprice"))).alias("g")))
    sup = src("supplier").select("s_suppkey", "s_name", "s_nationkey")
    return a.join(sup, a.l_suppkey == sup.s_suppkey)


def order_supplier_id() -> Column:
    """64-bit id of an (order, supplier) pair: exact for up to 10^8 suppliers."""
    return F.col("l_orderkey").cast("long") * 100_000_000 + F.col("l_suppkey")


def ap_invoices(src: TestTables) -> DataFrame:
    b = _order_supplier_lines(src)
    g = F.col("g")
    vat = rate_of(g, "0.12")
    wht = rate_of(g, "0.01")
    sd = F.col("sd").cast("date")
    paid = F.col("ls") == "F"
    interco = (F.col("l_suppkey") % 10) == 0
    df = b.select(
        order_supplier_id().alias("id"), sub_of("s_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("AP-"), s("l_orderkey"), F.lit("-"), s("l_suppkey")).alias("invoice_number"),
        F.concat(F.lit("VND-"), s("l_suppkey")).alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        (F.col("l_suppkey") + 200000000).cast("string").alias("vendor_tin"),
        sd.alias("invoice_date"), F.date_add(sd, 30).alias("due_date"),
        g.alias("gross_amount"), vat.alias("vat_amount"), money(g - vat).alias("net_amount"),
        wht.alias("wht_amount"),
        F.when(paid, money(g - wht)).alias("payment_amount"),
        F.when(paid, F.date_add(sd, 20)).alias("payment_date"),
        F.when(paid, "paid").otherwise("unpaid").alias("status"),
        interco.alias("is_interco"),
        F.when(interco, next_sub_of("s_nationkey")).alias("counterpart_sub_id"))
    return conform(df, "ap_invoices")


def purchase_orders(src: TestTables) -> DataFrame:
    b = _order_supplier_lines(src)
    od = F.date_sub(F.col("sd").cast("date"), 14)
    df = b.select(
        order_supplier_id().alias("id"), sub_of("s_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("PO-"), s("l_orderkey"), F.lit("-"), s("l_suppkey")).alias("po_number"),
        F.concat(F.lit("VND-"), s("l_suppkey")).alias("vendor_id"),
        od.alias("order_date"),
        F.date_add(od, (F.col("l_orderkey") % 14 + 7).cast("int")).alias("expected_date"),
        F.when(F.col("ls") == "F", "received").otherwise("approved").alias("status"),
        F.col("g").alias("total_amount"))
    return conform(df, "purchase_orders")


def journal_entries(src: TestTables, ar: DataFrame | None = None) -> DataFrame:
    """Three lines per receivable (debit AR, credit revenue, credit VAT), one scan."""
    ar = ar if ar is not None else ar_ledger(src)
    zero = F.lit(0).cast(MONEY)

    def line(suffix, code, name, debit, credit):
        return F.struct(F.concat(F.lit("JE-"), F.col("invoice_number"), F.lit(suffix)).alias("entry_number"),
                        F.lit(code).alias("account_code"), F.lit(name).alias("account_name"),
                        debit.alias("debit_amount"), credit.alias("credit_amount"))

    lines = F.array(line("-D", "2000", "Accounts Receivable", F.col("gross_amount"), zero),
                    line("-C", "4000", "Revenue", zero, F.col("net_amount")),
                    line("-V", "3000", "Output VAT", zero, F.col("vat_amount")))
    df = (ar.select("subsidiary_id", F.col("invoice_date").alias("entry_date"), "is_interco",
                    "counterpart_sub_id", F.col("invoice_number").alias("reference_doc"),
                    F.explode(lines).alias("l"))
            .select("subsidiary_id", "entry_date", "is_interco", "counterpart_sub_id",
                    "reference_doc", "l.*"))
    return conform(df, "journal_entries", ["subsidiary_id", "entry_number"])


def vat_returns(src: TestTables, sales: DataFrame | None = None) -> DataFrame:
    sales = sales if sales is not None else sales_transactions(src)
    zero = F.lit(0).cast(MONEY)
    cls = F.col("vat_classification")
    m = (sales.groupBy("subsidiary_id",
                       F.year("transaction_date").alias("period_year"),
                       F.month("transaction_date").alias("period_month"))
              .agg(money(F.sum("gross_amount")).alias("g"), money(F.sum("vat_amount")).alias("ov"),
                   money(F.sum(F.when(cls == "exempt", F.col("gross_amount")).otherwise(zero))).alias("ex"),
                   money(F.sum(F.when(cls == "zero_rated", F.col("gross_amount")).otherwise(zero))).alias("zr")))
    iv = rate_of("g", "0.08")
    df = m.select(
        "subsidiary_id", "period_month", "period_year", F.lit("2550M").alias("form_type"),
        F.col("g").alias("gross_sales"), F.col("ex").alias("exempt_sales"),
        F.col("zr").alias("zero_rated_sales"), money(F.col("g") - F.col("ex") - F.col("zr")).alias("taxable_sales"),
        F.col("ov").alias("output_vat"), iv.alias("input_vat"), money(F.col("ov") - iv).alias("vat_payable"),
        F.make_date("period_year", "period_month", F.lit(20)).alias("filing_date"),
        F.when(F.col("period_month") % 4 == 0, "late").otherwise("filed").alias("status"))
    return conform(df, "vat_returns")


def customers(src: TestTables) -> DataFrame:
    c = src("customer")
    deleted = F.col("c_acctbal") < -500
    df = c.select(
        F.col("c_custkey").alias("id"), sub_of("c_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("CUST-"), s("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        (F.col("c_custkey") + 300000000).cast("string").alias("customer_tin"),
        F.concat(F.lit("customer"), s("c_custkey"), F.lit("@example.com")).alias("contact_email"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        deleted.alias("is_deleted"))
    return conform(df, "customers")


def sales_orders(src: TestTables) -> DataFrame:
    b = _orders_customers(src)
    d = F.col("o_orderdate").cast("date")
    st = F.col("o_orderstatus")
    df = b.select(
        F.col("o_orderkey").alias("id"), sub_of("c_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("SO-"), s("o_orderkey")).alias("so_number"),
        F.concat(F.lit("CUST-"), s("o_custkey")).alias("customer_id"),
        d.alias("order_date"),
        F.when(st != "O", F.date_add(d, (F.col("o_orderkey") % 15).cast("int"))).alias("ship_date"),
        F.when(st == "F", "completed").when(st == "P", "shipped").otherwise("pending").alias("status"),
        money("o_totalprice").alias("total_amount"))
    return conform(df, "sales_orders")


def campaigns(src: TestTables) -> DataFrame:
    p = src("part")
    rp = money("p_retailprice")
    start = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("p_partkey") % 730).cast("int"))
    types = F.array(*[F.lit(x) for x in CAMPAIGN_TYPES])
    statuses = F.array(*[F.lit(x) for x in CAMPAIGN_STATUSES])
    df = p.select(
        F.col("p_partkey").alias("id"), sub_of("p_partkey").alias("subsidiary_id"),
        F.concat(F.lit("CMP-"), s("p_partkey")).alias("campaign_id"),
        F.col("p_name").alias("campaign_name"),
        F.element_at(types, (F.col("p_partkey") % len(CAMPAIGN_TYPES)).cast("int") + 1).alias("campaign_type"),
        F.col("p_brand").alias("channel"), start.alias("start_date"),
        F.when(F.col("p_size") % 10 != 0, F.date_add(start, F.col("p_size") * 3)).alias("end_date"),
        money(rp * 100).alias("budget_amount"), money(rp * F.col("p_size")).alias("actual_spend"),
        (F.col("p_size") * 10).alias("leads_generated"), F.col("p_size").alias("conversions"),
        money(rp * F.col("p_size") * 3).alias("revenue_attributed"),
        F.element_at(statuses, (F.col("p_partkey") % len(CAMPAIGN_STATUSES)).cast("int") + 1).alias("status"))
    return conform(df, "campaigns")


# ---------------------------------------------------------------------------
# HR
# ---------------------------------------------------------------------------
def employees(src: TestTables) -> DataFrame:
    c = src("customer")
    k = F.col("c_custkey")
    df = c.select(
        k.alias("id"), sub_of("c_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("EMP-"), s("c_custkey")).alias("employee_id"),
        F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"),
        (k + 100000000).cast("string").alias("tin"),
        (k + 340000000).cast("string").alias("sss_number"),
        (k + 120000000).cast("string").alias("philhealth_number"),
        (k + 121000000).cast("string").alias("pagibig_number"),
        F.col("c_mktsegment").alias("department"),
        F.when(k % 3 == 0, "Staff").when(k % 3 == 1, "Supervisor").otherwise("Manager").alias("position"),
        F.when(k % 10 < 7, "regular").otherwise("contractual").alias("employment_type"),
        F.date_add(F.lit("1990-01-01").cast("date"), (k % 3650).cast("int")).alias("date_hired"),
        money(F.abs("c_acctbal")).alias("basic_salary"))
    return conform(df, "employees")


def payroll_runs(src: TestTables) -> DataFrame:
    b = _orders_customers(src)
    gross = money(F.abs("c_acctbal"))
    ded = money(rate_of(gross, "0.08") + rate_of(gross, "0.03") + rate_of(gross, "0.02"))
    df = b.select(
        F.col("o_orderkey").alias("id"), sub_of("c_nationkey").alias("subsidiary_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("payroll_period"),
        F.concat(F.lit("EMP-"), s("o_custkey")).alias("employee_id"),
        gross.alias("gross_pay"), ded.alias("total_deductions"), money(gross - ded).alias("net_pay"),
        F.last_day(F.col("o_orderdate").cast("date")).alias("payroll_date"))
    return conform(df, "payroll_runs")


def statutory_contributions(src: TestTables, payroll: DataFrame | None = None) -> DataFrame:
    payroll = payroll if payroll is not None else payroll_runs(src)
    m = (payroll.groupBy("subsidiary_id", F.year("payroll_date").alias("period_year"),
                         F.month("payroll_date").alias("period_month"))
                .agg(money(F.sum("gross_pay")).alias("g")))
    parts = {"sss_employer": "0.095", "sss_employee": "0.045", "philhealth_employer": "0.025",
             "philhealth_employee": "0.025", "pagibig_employer": "0.02", "pagibig_employee": "0.02"}
    cols = {k: rate_of("g", v) for k, v in parts.items()}
    total = money(cols["sss_employer"] + cols["sss_employee"] + cols["philhealth_employer"]
                  + cols["philhealth_employee"] + cols["pagibig_employer"] + cols["pagibig_employee"])
    df = m.select("subsidiary_id", "period_month", "period_year",
                  *[c.alias(k) for k, c in cols.items()], total.alias("total_amount"))
    return conform(df, "statutory_contributions")


# ---------------------------------------------------------------------------
# Procurement / tax
# ---------------------------------------------------------------------------
def vendors(src: TestTables) -> DataFrame:
    sp = src("supplier")
    k = F.col("s_suppkey")
    df = sp.select(
        k.alias("id"), sub_of("s_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("VND-"), s("s_suppkey")).alias("vendor_id"),
        F.col("s_name").alias("vendor_name"), (k + 200000000).cast("string").alias("vendor_tin"),
        F.when(k % 3 == 0, "goods").when(k % 3 == 1, "services").otherwise("mixed").alias("vendor_type"),
        F.when(k % 3 == 0, "30").when(k % 3 == 1, "45").otherwise("60").alias("payment_terms"),
        (k % 5 != 0).alias("is_accredited"))
    return conform(df, "vendors")


def wht_filings(src: TestTables, ap: DataFrame | None = None) -> DataFrame:
    ap = ap if ap is not None else ap_invoices(src)
    g = F.col("gross_amount")
    rate = (F.when(g >= 100000, F.lit("0.05")).when(g >= 50000, F.lit("0.02"))
             .otherwise(F.lit("0.01")).cast("decimal(6,4)"))
    paid = F.col("status") == "paid"
    df = ap.select(
        "id", "subsidiary_id", F.lit("1601E").alias("form_type"),
        F.month("invoice_date").alias("period_month"), F.year("invoice_date").alias("period_year"),
        F.col("vendor_tin").alias("payee_tin"), F.col("vendor_name").alias("payee_name"),
        g.alias("income_payment"),
        F.when(g >= 100000, "WC155").when(g >= 50000, "WC030").otherwise("WC010").alias("atc_code"),
        rate.alias("tax_rate"), money_round(g * rate).alias("wht_amount"),
        F.when(paid, F.date_add("invoice_date", 10)).alias("filing_date"),
        F.when(paid, "filed").otherwise("pending").alias("status"))
    return conform(df, "wht_filings")


def wht_certificates(src: TestTables, ap: DataFrame | None = None) -> DataFrame:
    ap = ap if ap is not None else ap_invoices(src)
    df = ap.select(
        "subsidiary_id",
        F.concat(F.lit("2307-"), F.year("invoice_date").cast("string"), F.lit("-"),
                 F.col("subsidiary_id"), F.lit("-"), F.col("invoice_number")).alias("cert_number"),
        "vendor_id", F.lit("WC010").alias("atc_code"), F.col("gross_amount").alias("income_payment"),
        F.lit("0.01").cast("decimal(6,4)").alias("tax_rate"), "wht_amount",
        F.date_add("invoice_date", 5).alias("issued_date"))
    return conform(df, "wht_certificates")


def bir_filings_log(src: TestTables) -> DataFrame:
    o = src("orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    st = F.col("o_orderstatus")
    zero = F.lit(0).cast(MONEY)
    sur = F.when(k % 20 > 10, F.lit("500.25").cast(MONEY)).otherwise(zero)
    intr = F.when(k % 20 > 15, F.lit("100.10").cast(MONEY)).otherwise(zero)
    df = o.select(
        k.alias("id"), sub_of("o_custkey").alias("subsidiary_id"),
        F.element_at(F.array(*[F.lit(x) for x in ("2550M", "2550Q", "1601C", "1601E")]),
                     (k % 4).cast("int") + 1).alias("form_type"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period_covered"),
        d.alias("due_date"),
        F.when(st != "O", F.date_add(d, (k % 20).cast("int") - 10)).alias("filing_date"),
        money("o_totalprice").alias("amount_paid"), sur.alias("surcharge_amount"),
        intr.alias("interest_amount"), zero.alias("compromise_amount"),
        money(sur + intr + zero).alias("penalty_amount"),
        F.when(st == "F", "accepted").when(st == "O", "pending").otherwise("rejected").alias("status"))
    return conform(df, "bir_filings_log")


# ---------------------------------------------------------------------------
# Ops
# ---------------------------------------------------------------------------
def inventory_movements(src: TestTables) -> DataFrame:
    li = src("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                "l_returnflag", "l_linestatus", "l_shipdate", "l_linenumber")
    sp = src("supplier").select("s_suppkey", "s_nationkey")
    p = src("part").select("p_partkey", "p_retailprice")
    b = li.join(sp, li.l_suppkey == sp.s_suppkey).join(p, li.l_partkey == p.p_partkey)
    qty = F.col("l_quantity").cast("int")
    uc = money("p_retailprice")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    df = b.select(
        sub_of("s_nationkey").alias("subsidiary_id"),
        F.col("l_shipdate").cast("date").alias("movement_date"),
        F.when(rf == "A", "receipt").when(rf == "R", "adjustment").when(ls == "O", "issue")
         .otherwise("transfer").alias("movement_type"),
        F.concat(F.lit("SKU-"), s("l_partkey")).alias("item_code"), qty.alias("quantity"),
        uc.alias("unit_cost"), money(qty * uc).alias("total_cost"),
        F.concat(F.lit("WH-"), (F.col("l_suppkey") % 2 + 1).cast("string")).alias("warehouse_location"),
        F.concat(F.lit("PO-"), s("l_orderkey")).alias("reference_doc"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    return conform(df, "inventory_movements",
                   ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"])


# ---------------------------------------------------------------------------
# Legal
# ---------------------------------------------------------------------------
def stockholders(src: TestTables) -> DataFrame:
    sp = src("supplier")
    df = sp.select(
        F.col("s_suppkey").alias("id"), sub_of("s_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("SH-"), s("s_suppkey")).alias("stockholder_id"),
        F.col("s_name").alias("name"),
        (F.col("s_suppkey") % 9 + 1).cast("decimal(6,2)").alias("ownership_pct"),
        (F.col("s_nationkey") % 4 == 0).alias("is_foreign"))
    return conform(df, "stockholders")


def officers(src: TestTables) -> DataFrame:
    sp = src("supplier")
    k = F.col("s_suppkey")
    start = F.date_add(F.lit("2015-01-01").cast("date"), (k % 3000).cast("int"))
    df = sp.select(
        k.alias("id"), sub_of("s_nationkey").alias("subsidiary_id"),
        F.concat(F.lit("OFF-"), s("s_suppkey")).alias("officer_id"), F.col("s_name").alias("name"),
        F.element_at(F.array(*[F.lit(x) for x in ("President", "Treasurer", "Corporate Secretary",
                                                  "Director")]), (k % 4).cast("int") + 1).alias("position"),
        start.alias("start_date"), F.when(k % 5 == 0, F.date_add(start, 365)).alias("end_date"))
    return conform(df, "officers")


def board_resolutions(src: TestTables) -> DataFrame:
    o = src("orders")
    df = o.select(
        F.col("o_orderkey").alias("id"), sub_of("o_custkey").alias("subsidiary_id"),
        F.concat(F.lit("BR-"), s("o_orderkey")).alias("resolution_number"),
        F.col("o_orderdate").cast("date").alias("resolution_date"),
        F.concat(F.lit("Approval of order "), s("o_orderkey")).alias("title"),
        F.lit("Board of Directors").alias("enacted_by"))
    return conform(df, "board_resolutions")


def sec_filings(src: TestTables) -> DataFrame:
    o = src("orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    due = F.date_add(d, 30)
    filed = F.when(F.col("o_orderstatus") != "O", F.date_add(d, (k % 45).cast("int")))
    df = o.select(
        k.alias("id"), sub_of("o_custkey").alias("subsidiary_id"),
        F.element_at(F.array(F.lit("GIS"), F.lit("AFS"), F.lit("ACGR")), (k % 3).cast("int") + 1)
         .alias("filing_type"),
        due.alias("due_date"), filed.alias("filing_date"),
        F.when(filed.isNull(), "pending").when(filed > due, "late").otherwise("filed").alias("status"),
        F.concat(F.lit("SEC-"), s("o_orderkey")).alias("reference_number"))
    return conform(df, "sec_filings")


# ---------------------------------------------------------------------------
# IT audit and the change stream (from events)
# ---------------------------------------------------------------------------
def _risk(value) -> Column:
    v = F.col(value)
    return (F.when(v > 200, "critical").when(v > 100, "high").when(v > 25, "medium")
             .otherwise("low"))


def audit_log(src: TestTables) -> DataFrame:
    e = src("events")
    et = F.col("event_type")
    df = e.select(
        F.col("event_id").alias("id"), sub_of("user_id").alias("subsidiary_id"),
        F.col("ts").alias("event_timestamp"), F.concat(F.lit("USER-"), s("user_id")).alias("user_id"),
        F.when(et == "signup", "LOGIN").when(et.isin("click", "view"), "READ")
         .when(et == "purchase", "EXPORT").otherwise("DELETE").alias("action"),
        F.when(et == "error", "failed").otherwise("success").alias("result"),
        _risk("value").alias("risk_level"))
    return conform(df, "audit_log")


def access_events(src: TestTables) -> DataFrame:
    e = src("events")
    et = F.col("event_type")
    df = e.select(
        F.col("event_id").alias("id"), sub_of("user_id").alias("subsidiary_id"),
        F.col("ts").alias("event_timestamp"), F.concat(F.lit("USER-"), s("user_id")).alias("user_id"),
        F.when(et == "signup", "LOGIN").when(et == "purchase", "EXPORT").otherwise("VIEW").alias("action"),
        F.when(et == "purchase", "orders").when(et == "signup", "accounts").otherwise("reports")
         .alias("resource"),
        F.get_json_object("props", "$.k").alias("resource_id"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 (F.col("event_id") % 256).cast("string")).alias("ip_address"),
        F.when(et == "error", "denied").otherwise("allowed").alias("result"))
    return conform(df, "access_events")


def system_incidents(src: TestTables) -> DataFrame:
    e = src("events").filter(F.col("event_type") == "error")
    k = F.col("event_id")
    v = F.col("value")
    d = F.col("ts").cast("date")
    df = e.select(
        k.alias("id"), sub_of("user_id").alias("subsidiary_id"),
        F.concat(F.lit("INC-"), s("event_id")).alias("incident_id"), d.alias("incident_date"),
        F.when(v > 100, "outage").when(v > 25, "security").otherwise("bug").alias("incident_type"),
        _risk("value").alias("severity"),
        F.concat(F.lit("error event "), s("event_id")).alias("description"),
        F.when(k % 5 != 0, F.date_add(d, (k % 5).cast("int"))).alias("resolved_date"))
    return conform(df, "system_incidents")


def cdc_raw(src: TestTables) -> DataFrame:
    """Kafka-shaped change messages (topic, partition, offset, timestamp, value).

    Every user is one record of ``<sub>.sales.customers`` (even ids) or
    ``<sub>.hr.employees`` (odd ids) and stays in partition ``user_id % 4``;
    offsets follow event time (``event_id`` increases with ``ts``), so offset
    order is change order. signup -> create, click -> snapshot read,
    error -> delete, else update; ``view`` updates carry a partial image.
    """
    e = src("events")
    et = F.col("event_type")
    uid = s("user_id")
    emp = F.col("user_id") % 2 != 0
    topic = F.concat(F.element_at(F.array(F.lit("abc"), F.lit("xyz"), F.lit("rtl")),
                                  (F.col("user_id") % 3).cast("int") + 1), F.lit("."),
                     F.when(~emp, F.lit("sales.customers")).otherwise(F.lit("hr.employees")))
    op = (F.when(et == "signup", "c").when(et == "error", "d").when(et == "click", "r")
           .otherwise("u"))
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    full_emp = F.concat(F.lit('{"id":'), uid, F.lit(',"employee_id":"EMP-'), uid,
                        F.lit('","position":"'), et, F.lit('","basic_salary":'), amount, F.lit("}"))
    part_emp = F.concat(F.lit('{"id":'), uid, F.lit(',"position":"'), et, F.lit('"}'))
    full_cus = F.concat(F.lit('{"id":'), uid, F.lit(',"customer_id":"CUST-'), uid,
                        F.lit('","customer_name":"'), et, F.lit('","phone":"'), s("event_id"),
                        F.lit('"}'))
    part_cus = F.concat(F.lit('{"id":'), uid, F.lit(',"customer_name":"'), et, F.lit('"}'))
    before = F.when(et == "error", F.concat(F.lit('{"id":'), uid, F.lit("}"))).otherwise(F.lit("null"))
    after = (F.when(et == "error", F.lit("null"))
              .when(et == "view", F.when(emp, part_emp).otherwise(part_cus))
              .otherwise(F.when(emp, full_emp).otherwise(full_cus)))
    value = F.concat(F.lit('{"op":"'), op, F.lit('","before":'), before, F.lit(',"after":'),
                     after, F.lit(',"ts_ms":'),
                     ts_to_epoch_ms("ts").cast("string"), F.lit("}"))
    return e.select(topic.alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
                    value.alias("value"))


def subsidiaries(spark: SparkSession) -> DataFrame:
    from strata.sources.landing import seed_subsidiaries
    return seed_subsidiaries(spark)


FIXTURES = {
    "sales_transactions": sales_transactions, "ar_ledger": ar_ledger, "ap_invoices": ap_invoices,
    "purchase_orders": purchase_orders, "journal_entries": journal_entries,
    "vat_returns": vat_returns, "customers": customers, "sales_orders": sales_orders,
    "campaigns": campaigns, "employees": employees, "payroll_runs": payroll_runs,
    "statutory_contributions": statutory_contributions, "vendors": vendors,
    "wht_filings": wht_filings, "wht_certificates": wht_certificates,
    "bir_filings_log": bir_filings_log, "inventory_movements": inventory_movements,
    "stockholders": stockholders, "officers": officers, "board_resolutions": board_resolutions,
    "sec_filings": sec_filings, "audit_log": audit_log, "access_events": access_events,
    "system_incidents": system_incidents,
}
