"""Scalar ``Column -> Column`` helpers.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.schemas import OPERATION_MAP, SAFE_IDENTIFIER

MONEY = "decimal(18,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(x) -> Column:
    """``x`` evaluated once per row, as the output of a generator (one per ``select``). As a plain projection Spark writes its expression into every filter
    on it, below exchanges even, and parses JSON again for each field that is read."""
    return F.explode(F.array(_c(x)))


# X1 / X2 -------------------------------------------------------------------
def fiscal_year(date, start_month: int = 1) -> Column:
    """Fiscal year of a date; calendar year when the year starts in January.

    With ``start_month = m > 1`` a date in month >= m belongs to the next
    fiscal year (the fiscal year is named after the year it ends in).
    """
    d = _c(date)
    if start_month == 1:
        return F.year(d)
    return F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)


def fiscal_month(date, start_month: int = 1) -> Column:
    d = _c(date)
    if start_month == 1:
        return F.month(d)
    return F.pmod(F.month(d) - start_month, 12) + 1


# X3 --------------------------------------------------------------------------
def mask_tin(value) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text; NULL stays NULL."""
    return F.sha2(_c(value).cast("string"), 256)


# X4 --------------------------------------------------------------------------
def aging_bucket(days) -> Column:
    """'0-30' / '31-60' / '61-90'; everything else (NULL, negative, >90) '90+'."""
    d = _c(days)
    return (F.when(d.between(0, 30), "0-30")
             .when(d.between(31, 60), "31-60")
             .when(d.between(61, 90), "61-90")
             .otherwise("90+"))


# X6 --------------------------------------------------------------------------
EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> zoneless UTC timestamp; missing -> 1970-01-01.

    Pure TIMESTAMP_NTZ arithmetic, so the result does not depend on the
    session time zone.
    """
    return F.timestamp_add("MILLISECOND", F.coalesce(_c(ms), F.lit(0)).cast("long"),
                           F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def epoch_us_to_ts(us) -> Column:
    return F.timestamp_add("MICROSECOND", _c(us).try_cast("bigint"), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def ts_to_epoch_ms(ts) -> Column:
    """Zoneless timestamp -> epoch milliseconds (floor), independent of the session zone."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"),
                                    _c(ts).cast("timestamp_ntz")) / 1000).cast("long")


# X7 --------------------------------------------------------------------------
def operation_name(op) -> Column:
    """Debezium op code -> operation; missing means 'c', unknown means INSERT."""
    mapping = F.create_map(*[F.lit(x) for kv in OPERATION_MAP.items() for x in kv])
    return F.coalesce(mapping[F.coalesce(_c(op), F.lit("c"))], F.lit("INSERT"))


# X8 --------------------------------------------------------------------------
def record_id(after, before) -> Column:
    """The ``id`` of the image after the change, else of the one before, as text.

    An empty object or JSON null counts as falsy (falls through to the other
    image); an image without ``id`` yields ``''``.
    """
    a, b = _c(after), _c(before)

    def truthy(x):
        return x.isNotNull() & (F.trim(x) != "{}") & (F.trim(x) != "null")

    img = F.when(truthy(a), a).when(truthy(b), b)
    return F.when(img.isNull(), F.lit("")).otherwise(
        F.coalesce(F.get_json_object(img, "$.id"), F.lit("")))


# X9 / F7 --------------------------------------------------------------------
def topic_parts(topic, split=None) -> Column:
    """Split ``sub.dept.table[.more]`` into a struct (sub, dept, table, reason).

    ``reason`` is NULL for a valid topic. A leading ``public.`` schema segment
    of the table part is dropped; any other extra segment is rejected.
    ``split`` names a column that holds the topic's parts already.
    """
    t = _c(topic)
    parts = F.split(t, r"\.") if split is None else _c(split)
    n = F.size(parts)
    rest = F.slice(parts, 3, F.greatest(n, F.lit(1)))
    rest = F.when((F.size(rest) > 1) & (F.lower(rest[0]) == "public"),
                  F.slice(rest, 2, F.size(rest))).otherwise(rest)
    table = F.array_join(rest, ".")
    unsafe = F.when(F.size(rest) == 1, ~rest[0].rlike(SAFE_IDENTIFIER)).otherwise(F.exists(rest, lambda s: ~s.rlike(SAFE_IDENTIFIER)))
    reason = (F.when(t.isNull(), "null topic")
               .when(n < 3, "topic has fewer than 3 parts")
               .when(unsafe, "unsafe table identifier")
               .when(F.size(rest) > 1, "unexpected topic segment"))
    return F.struct(F.upper(parts[0]).alias("subsidiary_id"), parts[1].alias("source_dept"),
                    table.alias("source_table"), reason.alias("reason"))


def safe_identifier(name) -> Column:
    return _c(name).rlike(SAFE_IDENTIFIER)


# X14 -------------------------------------------------------------------------
def penalty(surcharge="surcharge_amount", interest="interest_amount",
            compromise="compromise_amount") -> Column:
    return (_c(surcharge) + _c(interest) + _c(compromise)).cast(MONEY)


# X20 -------------------------------------------------------------------------
def money_round(x, scale: int = 2) -> Column:
    """Round a decimal product to cents and keep it decimal(18,2)."""
    return F.round(_c(x), scale).cast(MONEY)


def money(x) -> Column:
    return _c(x).cast(MONEY)


def rate_of(amount, rate: str) -> Column:
    """``round(amount * rate, 2)`` with the rate as an exact decimal literal."""
    scale = len(rate.split(".")[1]) if "." in rate else 0
    return money_round(_c(amount) * F.lit(rate).cast(f"decimal({scale + 2},{scale})"))


def to_double(x) -> Column:
    return _c(x).cast("double")


# Misc ------------------------------------------------------------------------
def safe_ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def days_between(later, earlier) -> Column:
    return F.datediff(_c(later), _c(earlier))
