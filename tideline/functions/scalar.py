"""Scalar helpers as column expressions, and the same helpers as SQL functions without Python."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


#: Words that tell the direction of a holder's trade.
SELLING = ("减", "卖", "sell", "decrease")
BUYING = ("增", "买", "buy", "increase")


def canonical_code(c: Column) -> Column:
    """Trim, upper-case, and pad the code before the suffix to six digits."""
    t = F.upper(F.trim(c))
    parts = F.split(t, r"\.", 2)
    return F.when(F.size(parts) == 2, F.concat(F.lpad(parts[0], 6, "0"), F.lit("."), parts[1])).otherwise(t)


def first_present(*columns: Column) -> Column:
    """The first value that is not blank."""
    return F.coalesce(*[F.nullif(F.trim(c.cast("string")), F.lit("")) for c in columns])


def tolerant_date(c: Column) -> Column:
    """Dates from yyyyMMdd (also with .0) or ISO text; anything else is null."""
    t = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.to_date(F.coalesce(F.try_to_timestamp(F.when(t.rlike(r"^\d{8}$"), t), F.lit("yyyyMMdd")), F.try_to_timestamp(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(t, 1, 10)), F.lit("yyyy-MM-dd"))))


def number(c: Column) -> Column:
    """Double, null where the text is not a number or NaN."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def prefix_exchange(code: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """Exchange of a code from its first characters, the longest prefix first."""
    out = None
    for prefix in sorted(mapping, key=len, reverse=True):
        hit = code.startswith(prefix)
        out = F.when(hit, mapping[prefix]) if out is None else out.when(hit, mapping[prefix])
    return out.otherwise(F.lit(default))


def clock_ms(c: Column) -> Column:
    """Milliseconds since midnight of an HHMMSSmmm integer; null if it is no clock time."""
    h, m, s, ms = F.floor(c / 10000000), F.floor(c / 100000) % 100, F.floor(c / 1000) % 100, c % 1000
    return F.when((c >= 0) & (h < 24) & (m < 60) & (s < 60), ((h * 60 + m) * 60 + s) * 1000 + ms).cast("long")


def session_minute(ms: Column, *, morning: tuple[int, int] = (570, 690), afternoon: tuple[int, int] = (780, 900), auction: int = 555) -> Column:
    """Minute of day of the bar a trade belongs to: the opening auction to the first minute, others up to the next full
    minute, kept inside the two sessions; null outside of them."""
    up = F.ceil(ms / 60000)
    early = (ms >= auction * 60000) & (ms <= morning[0] * 60000)
    first = (ms > morning[0] * 60000) & (ms < (morning[1] + 1) * 60000)
    second = (ms >= afternoon[0] * 60000) & (ms < (afternoon[1] + 1) * 60000)
    return F.when(early, morning[0]).when(first, F.least(up, F.lit(morning[1]))).when(second, F.greatest(F.least(up, F.lit(afternoon[1])), F.lit(afternoon[0] + 1))).cast("long")


def direction(text: Column, amount: Column) -> Column:
    """-1 or +1 from words, those of selling first, else from the sign of the amount; +1 if neither tells."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.when(t.rlike("|".join(SELLING)), -1).when(t.rlike("|".join(BUYING)), 1).when(amount < 0, -1).otherwise(1)


def signed_trade(text: Column, volume: Column, price: Column, amount: Column) -> dict[str, Column]:
    """Direction, signed volume and signed amount of a holder's trade. A missing amount is estimated from the volume and the
    mean price, in units of ten thousand."""
    side = direction(text, volume)
    return {"direction": side, "signed_vol": F.abs(volume) * side, "signed_amount": F.coalesce(F.abs(amount), F.abs(volume) * price / 10000) * side}


SQL_FUNCTIONS = {
    "canonical_code(c STRING) RETURNS STRING": "CASE WHEN contains(c, '.') THEN concat(lpad(split(upper(trim(c)), '[.]', 2)[0], 6, '0'), '.', split(upper(trim(c)), '[.]', 2)[1]) ELSE upper(trim(c)) END",
    "tolerant_date(c STRING) RETURNS DATE": "to_date(coalesce(try_to_timestamp(regexp_extract(trim(c), '^([0-9]{8})([.]0)?$', 1), 'yyyyMMdd'), try_to_timestamp(regexp_extract(trim(c), '^([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), 'yyyy-MM-dd')))",
    "clock_ms(c BIGINT) RETURNS BIGINT": "CASE WHEN c >= 0 AND c div 10000000 < 24 AND (c div 100000) % 100 < 60 AND (c div 1000) % 100 < 60 THEN (((c div 10000000) * 60 + (c div 100000) % 100) * 60 + (c div 1000) % 100) * 1000 + c % 1000 END",
    "prefix_exchange(code STRING, mapping MAP<STRING, STRING>) RETURNS STRING": "element_at(mapping, array_max(transform(filter(map_keys(mapping), p -> startswith(code, p)), p -> struct(length(p) AS n, p AS p))).p)",
    "session_minute(ms BIGINT) RETURNS BIGINT": "CASE WHEN ms BETWEEN 33300000 AND 34200000 THEN 570 WHEN ms > 34200000 AND ms < 41460000 THEN least(ceil(ms / 60000), 690) WHEN ms >= 46800000 AND ms < 54060000 THEN greatest(least(ceil(ms / 60000), 900), 781) END",
}


def register_sql_functions(spark: SparkSession) -> None:
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
