"""Bronze table definitions, natural keys, defaults and registries.

Each bronze table is declared once as a list of column specs
``"name type[!][=default]"`` (``!`` = NOT NULL). From that one declaration we
derive the Spark ``StructType`` (for ``spark.read.schema`` / ``from_json``),
the NOT NULL list (quarantine rules) and the DEFAULT map (``coalesce`` at
ingest).  Every table also carries ``is_deleted`` / ``deleted_at``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "money": T.DecimalType(18, 2),
    "rate": T.DecimalType(6, 4),
    "pct": T.DecimalType(6, 2),
    "dec5_2": T.DecimalType(5, 2),
    "dec10_2": T.DecimalType(10, 2),
}

# SQL spelling of the same types (used for DuckDB oracle casts and DDL strings)
SQL_TYPES = {
    "int": "int", "bigint": "bigint", "string": "string", "boolean": "boolean",
    "date": "date", "timestamp": "timestamp_ntz", "money": "decimal(18,2)",
    "rate": "decimal(6,4)", "pct": "decimal(6,2)", "dec5_2": "decimal(5,2)",
    "dec10_2": "decimal(10,2)",
}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    not_null: bool = False
    default: str | None = None  # SQL literal text

    @property
    def dtype(self) -> T.DataType:
        return _TYPES[self.kind]


@dataclass(frozen=True)
class Table:
    name: str
    dept: str | None
    keys: tuple[str, ...]            # natural key, () for keyless tables
    columns: tuple[Column, ...]
    date_col: str | None = None      # business date used for look-back / future checks
    generated: dict = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, not c.not_null) for c in self.columns])

    @property
    def ddl(self) -> str:
        return ", ".join(f"{c.name} {SQL_TYPES[c.kind]}" for c in self.columns)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if c.not_null]

    @property
    def defaults(self) -> dict[str, str]:
        return {c.name: c.default for c in self.columns if c.default is not None}

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")


def _parse(spec: str) -> Column:
    name, rest = spec.split(" ", 1)
    default = None
    if "=" in rest:
        rest, default = rest.split("=", 1)
    not_null = rest.endswith("!")
    return Column(name, rest.rstrip("!"), not_null, default)


_SOFT_DELETE = ("is_deleted boolean!=false", "deleted_at timestamp")
_INGESTED = "ingested_at timestamp!=now"


def _table(name, dept, keys, specs, date_col=None, generated=None, ingested=True):
    cols = list(specs) + ([_INGESTED] if ingested else []) + list(_SOFT_DELETE)
    return Table(name, dept, tuple(keys), tuple(_parse(s) for s in cols), date_col, generated or {})


def _dept_default(dept):
    return f"source_dept string!='{dept}'"


# ---------------------------------------------------------------------------
# The bronze DDL (column names, types, NOT NULL, defaults and
# natural keys) that data must conform to.
# ---------------------------------------------------------------------------
TABLES: dict[str, Table] = {t.name: t for t in [
    _table("subsidiaries", None, ["subsidiary_id"], [
        "id bigint!", "subsidiary_id string!", "name string!", "tin string!", "sec_reg string",
        "bir_rdo string", "industry string", "scale_factor dec5_2!=1.0",
        "fiscal_year_start int!=1", "currency string!='PHP'", "is_active boolean!=true",
        "created_at timestamp!=now", "updated_at timestamp!=now"], ingested=False),
    _table("pipeline_run_log", None, [], [
        "id bigint!", "run_id string!", "dag_id string", "task_id string", "subsidiary_id string",
        "source_dept string", "endpoint_called string", "rows_fetched int=0",
        "rows_inserted int=0", "rows_rejected int=0", "status string!='running'",
        "error_message string", "started_at timestamp!=now", "finished_at timestamp",
        "duration_seconds dec10_2"], ingested=False),
    _table("cdc_event_log", None, ["kafka_topic", "kafka_partition", "kafka_offset"], [
        "id bigint!", "kafka_topic string!", "kafka_partition int!", "kafka_offset bigint!",
        "subsidiary_id string!", "source_dept string", "source_table string!",
        "operation string!", "record_id string", "before_state string",
        "after_state string", "event_ts timestamp!", "consumed_at timestamp!=now",
        "is_processed boolean!=false", "created_at timestamp!=now"], "event_ts", ingested=False),
    _table("journal_entries", "finance", ["subsidiary_id", "entry_number"], [
        "id bigint!", "subsidiary_id string!", _dept_default("finance"), "entry_date date!",
        "entry_number string!", "account_code string!", "account_name string",
        "debit_amount money!=0", "credit_amount money!=0", "description string",
        "reference_doc string", "is_interco boolean!=false", "counterpart_sub_id string",
        "cost_center string", "posted_by string", "approved_by string"], "entry_date"),
    _table("ap_invoices", "finance", ["subsidiary_id", "invoice_number"], [
        "id bigint!", "subsidiary_id string!", _dept_default("finance"), "invoice_number string!",
        "vendor_id string", "vendor_name string", "vendor_tin string", "invoice_date date!",
        "due_date date", "gross_amount money!=0", "vat_amount money!=0",
        "net_amount money!=0", "wht_amount money!=0", "payment_amount money",
        "payment_date date", "status string!='unpaid'", "is_interco boolean!=false",
        "counterpart_sub_id string"], "invoice_date"),
    _table("ar_ledger", "finance", ["subsidiary_id", "invoice_number"], [
        "id bigint!", "subsidiary_id string!", _dept_default("finance"), "invoice_number string!",
        "customer_id string", "customer_name string", "customer_tin string",
        "invoice_date date!", "due_date date", "gross_amount money!=0",
        "vat_amount money!=0", "net_amount money!=0", "collected_amount money",
        "collection_date date", "status string!='open'", "is_interco boolean!=false",
        "counterpart_sub_id string"], "invoice_date"),
    _table("sales_transactions", "sales", ["subsidiary_id", "invoice_number"], [
        "id bigint!", "subsidiary_id string!", _dept_default("sales"), "invoice_number string!",
        "customer_name string", "transaction_date date!", "gross_amount money!=0",
        "discount_amount money!=0", "vat_amount money!=0", "net_amount money!=0",
        "vat_classification string", "is_interco boolean!=false",
        "counterpart_sub_id string"], "transaction_date"),
    _table("customers", "sales", ["subsidiary_id", "customer_id"], [
        "id bigint!", "subsidiary_id string!", _dept_default("sales"), "customer_id string!",
        "customer_name string", "customer_tin string", "contact_email string",
        "phone string", "is_active boolean!=true"]),
    _table("campaigns", "sales", ["subsidiary_id", "campaign_id"], [
        "id bigint!", "subsidiary_id string!", _dept_default("sales"), "campaign_id string!",
        "campaign_name string!", "campaign_type string!='digital'", "channel string",
        "start_date date!", "end_date date", "budget_amount money!=0",
        "actual_spend money!=0", "leads_generated int!=0", "conversions int!=0",
        "revenue_attributed money!=0", "status string!='active'"], "start_date"),
    _table("employees", "hr", ["subsidiary_id", "employee_id"], [
        "id bigint!", "subsidiary_id string!", _dept_default("hr"), "employee_id string!",
        "first_name string", "last_name string", "tin string", "sss_number string",
        "philhealth_number string", "pagibig_number string", "department string",
        "position string", "employment_type string", "date_hired date",
        "basic_salary money"], "date_hired"),
    _table("payroll_runs", "hr", [], [
        "id bigint!", "subsidiary_id string!", _dept_default("hr"), "payroll_period string!",
        "employee_id string!", "gross_pay money!=0", "total_deductions money!=0",
        "net_pay money!=0", "payroll_date date"], "payroll_date"),
    _table("statutory_contributions", "hr", [], [
        "id bigint!", "subsidiary_id string!", _dept_default("hr"), "period_month int!",
        "period_year int!", "sss_employer money!=0", "sss_employee money!=0",
        "philhealth_employer money!=0", "philhealth_employee money!=0",
        "pagibig_employer money!=0", "pagibig_employee money!=0", "total_amount money!=0"]),
    _table("vendors", "procurement", ["subsidiary_id", "vendor_id"], [
        "id bigint!", "subsidiary_id string!", _dept_default("procurement"), "vendor_id string!",
        "vendor_name string", "vendor_tin string", "vendor_type string",
        "payment_terms string", "is_accredited boolean!=false"]),
    _table("purchase_orders", "ops", ["subsidiary_id", "po_number"], [
        "id bigint!", "subsidiary_id string!", _dept_default("ops"), "po_number string!",
        "vendor_id string", "order_date date", "expected_date date", "status string",
        "total_amount money!=0"], "order_date"),
    _table("sales_orders", "ops", ["subsidiary_id", "so_number"], [
        "id bigint!", "subsidiary_id string!", _dept_default("ops"), "so_number string!",
        "customer_id string", "order_date date", "ship_date date", "status string",
        "total_amount money!=0"], "order_date"),
    _table("inventory_movements", "ops", [], [
        "id bigint!", "subsidiary_id string!", _dept_default("ops"), "movement_date date!",
        "movement_type string!", "item_code string", "quantity int", "unit_cost money",
        "total_cost money", "warehouse_location string", "reference_doc string"],
        "movement_date"),
    _table("vat_returns", "tax", ["subsidiary_id", "period_year", "period_month", "form_type"], [
        "id bigint!", "subsidiary_id string!", _dept_default("tax"), "period_month int!",
        "period_year int!", "form_type string!", "gross_sales money!=0",
        "exempt_sales money!=0", "zero_rated_sales money!=0", "taxable_sales money!=0",
        "output_vat money!=0", "input_vat money!=0", "vat_payable money!=0",
        "filing_date date", "efps_confirmation string", "status string!='pending'"],
        "filing_date"),
    _table("wht_filings", "tax", [], [
        "id bigint!", "subsidiary_id string!", _dept_default("tax"), "form_type string!",
        "period_month int", "period_year int", "payee_tin string", "payee_name string",
        "income_payment money!=0", "atc_code string", "tax_rate rate!=0",
        "wht_amount money!=0", "filing_date date", "efps_confirmation string",
        "status string!='pending'"], "filing_date"),
    _table("wht_certificates", "procurement", ["subsidiary_id", "cert_number"], [
        "id bigint!", "subsidiary_id string!", _dept_default("procurement"), "cert_number string!",
        "vendor_id string", "atc_code string", "income_payment money!=0", "tax_rate rate!=0",
        "wht_amount money!=0", "issued_date date"], "issued_date"),
    _table("bir_filings_log", "tax", [], [
        "id bigint!", "subsidiary_id string!", _dept_default("tax"), "form_type string!",
        "period_covered string", "due_date date", "filing_date date",
        "amount_paid money!=0", "surcharge_amount money!=0", "interest_amount money!=0",
        "compromise_amount money!=0", "penalty_amount money", "efps_ref string",
        "payment_mode string", "status string!='filed'"], "filing_date",
        generated={"penalty_amount": ("surcharge_amount", "interest_amount", "compromise_amount")}),
    _table("sec_filings", "legal", [], [
        "id bigint!", "subsidiary_id string!", _dept_default("legal"), "filing_type string!",
        "due_date date", "filing_date date", "status string", "reference_number string"],
        "filing_date"),
    _table("stockholders", "legal", ["subsidiary_id", "stockholder_id"], [
        "id bigint!", "subsidiary_id string!", "stockholder_id string!", "name string",
        "ownership_pct pct", "is_foreign boolean!=false"]),
    _table("board_resolutions", "legal", ["subsidiary_id", "resolution_number"], [
        "id bigint!", "subsidiary_id string!", "resolution_number string!",
        "resolution_date date", "title string", "enacted_by string"], "resolution_date"),
    _table("officers", "legal", ["subsidiary_id", "officer_id"], [
        "id bigint!", "subsidiary_id string!", "officer_id string!", "name string",
        "position string", "start_date date", "end_date date"], "start_date"),
    _table("access_events", "it_audit", [], [
        "id bigint!", "subsidiary_id string!", _dept_default("it_audit"),
        "event_timestamp timestamp!", "user_id string", "action string", "resource string",
        "resource_id string", "ip_address string", "result string"], "event_timestamp"),
    _table("audit_log", "it_audit", [], [
        "id bigint!", "subsidiary_id string!", _dept_default("it_audit"),
        "event_timestamp timestamp!", "user_id string", "action string", "result string",
        "risk_level string"], "event_timestamp"),
    _table("system_incidents", "it_audit", ["subsidiary_id", "incident_id"], [
        "id bigint!", "subsidiary_id string!", "incident_id string!", "incident_date date",
        "incident_type string", "severity string", "description string",
        "resolved_date date"], "incident_date"),
]}

BRONZE_DOMAIN = [n for n in TABLES if n not in ("subsidiaries", "pipeline_run_log", "cdc_event_log")]

# ---------------------------------------------------------------------------
# Change-capture registry — department -> captured tables
# (purchase_orders is captured under both ops and procurement).
# ---------------------------------------------------------------------------
CDC_TABLES: dict[str, list[str]] = {
    "finance": ["journal_entries", "ap_invoices", "ar_ledger"],
    "tax": ["vat_returns", "wht_filings", "bir_filings_log"],
    "hr": ["employees", "payroll_runs", "statutory_contributions"],
    "ops": ["inventory_movements", "purchase_orders", "sales_orders"],
    "sales": ["sales_transactions", "customers", "campaigns"],
    "procurement": ["vendors", "purchase_orders", "wht_certificates"],
    "legal": ["sec_filings", "stockholders", "board_resolutions", "officers"],
    "it_audit": ["audit_log", "access_events", "system_incidents"],
}

# Subsidiaries served by the change stream, and its topic pattern.
SUBSIDIARIES = ("ABC", "XYZ", "RTL")
TOPIC_PATTERN = r"(?i)^(abc|xyz|rtl)\..+"
SAFE_IDENTIFIER = r"^[a-zA-Z_][a-zA-Z0-9_]*$"

# Debezium op codes -> operation names.
OPERATION_MAP = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}

# Polled feeds — task id -> (group, table, look-back parameter).
FEEDS: dict[str, tuple[str, str, str | None]] = {
    "finance_journal_entries": ("finance", "journal_entries", "days:7"),
    "finance_ap_invoices": ("finance", "ap_invoices", "days:7"),
    "finance_ar_ledger": ("finance", "ar_ledger", "days:7"),
    "tax_vat_returns": ("tax", "vat_returns", "months:3"),
    "tax_wht_filings": ("tax", "wht_filings", "days:7"),
    "tax_bir_filings_log": ("tax", "bir_filings_log", "days:7"),
    "hr_employees": ("hr", "employees", None),
    "hr_payroll_runs": ("hr", "payroll_runs", "days:7"),
    "hr_statutory_contributions": ("hr", "statutory_contributions", "days:7"),
    "ops_inventory_movements": ("ops", "inventory_movements", "days:7"),
    "ops_purchase_orders": ("ops", "purchase_orders", "days:7"),
    "ops_sales_orders": ("ops", "sales_orders", "days:7"),
    "sales_transactions": ("sales", "sales_transactions", "days:7"),
    "sales_customers": ("sales", "customers", None),
    "sales_campaigns": ("sales", "campaigns", None),
    "procurement_vendors": ("procurement", "vendors", None),
    "procurement_purchase_orders": ("procurement", "purchase_orders", "days:7"),
    "procurement_wht_certs": ("procurement", "wht_certificates", None),
    "legal_sec_filings": ("legal", "sec_filings", None),
    "legal_stockholders": ("legal", "stockholders", None),
    "legal_board_resolutions": ("legal", "board_resolutions", None),
    "legal_officers": ("legal", "officers", None),
    "it_audit_log": ("it_audit", "audit_log", "days:7"),
    "it_access_events": ("it_audit", "access_events", "days:7"),
    "it_system_incidents": ("it_audit", "system_incidents", "days:7"),
}

# Polled field renames and fallbacks per feed (field -> column).
FEED_RENAMES: dict[str, dict[str, str]] = {
    "customers": {"tin": "customer_tin"},
    "wht_filings": {"taxpayer_name": "payee_name", "issued_date": "filing_date",
                    "efps_reference": "efps_confirmation"},
    "bir_filings_log": {"filing_type": "form_type", "submitted_at": "filing_date",
                        "efps_reference": "efps_ref"},
}
FEED_FALLBACKS: dict[str, dict[str, str]] = {
    "sales_transactions": {"transaction_date": "invoice_date"},
}

# Check constraints on campaigns.
CAMPAIGN_TYPES = ("digital", "print", "events", "radio", "tv", "referral")
CAMPAIGN_STATUSES = ("planned", "active", "completed", "cancelled")

# BIR form code seed (form_code, description).
FORM_CODES = [
    ("2550M", "Monthly VAT Return"),
    ("2550Q", "Quarterly VAT Return"),
    ("1601C", "Withholding Tax Return for Compensation"),
    ("2307", "BIR Form 2307 Certificate"),
    ("2316", "Annual Information Return"),
]

# Subsidiaries seed
# (subsidiary_id, name, tin, sec_reg, bir_rdo, industry, scale_factor, fiscal_year_start).
SUBSIDIARY_SEED = [
    ("ABC", "ABC Trading Inc.", "123-456-789-000", "CS201900001", "040", "Trading", "1.00", 1),
    ("XYZ", "XYZ Manufacturing Corp.", "987-654-321-000", "CS202000002", "041", "Manufacturing", "1.10", 1),
    ("RTL", "PH Retail Co.", "456-123-789-000", "CS202100088", "044", "Retail", "0.75", 1),
]
