"""Row-level normalisation: codes, boards, aliases, units, validity flags, identities and validity spans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.sweeps import covered
from tideline.operators.windows import keep_one

#: Suffixes of codes and the exchange they mean; first digits of bare codes of two exchanges.
SUFFIXES = {".XSHG": ".SH", ".XSHE": ".SZ", ".SH": ".SH", ".SZ": ".SZ"}
PREFIXES = {".SH": ("5", "6", "9"), ".SZ": ("0", "2", "3")}


def market_symbol(c: Column, market: str) -> Column:
    """A code of the market `a_share` with its exchange, from a suffix of any spelling or from its first digits; a code
    of another market only trimmed. Codes that no rule knows are upper-cased as they are. Blank or null is empty."""
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    if market != "a_share":
        return text
    up = F.upper(text)
    out = None
    for suffix, exchange in SUFFIXES.items():
        body = F.substring(up, F.lit(1), F.length(up) - len(suffix))
        padded = F.concat(F.lpad(body, 6, "0"), F.lit(exchange))
        wide = F.when(F.length(body) < 6, padded).otherwise(F.concat(body, F.lit(exchange)))
        hit = up.endswith(suffix)
        out = F.when(hit, wide) if out is None else out.when(hit, wide)
    code = F.when(F.length(up) < 6, F.lpad(up, 6, "0")).otherwise(up)
    for exchange, prefixes in PREFIXES.items():
        out = out.when(up.rlike("^[0-9]+$") & F.substring(code, 1, 1).isin(*prefixes), F.concat(code, F.lit(exchange)))
    return out.otherwise(up)


def board(symbol: Column) -> Column:
    """The board that a full code belongs to."""
    s = F.upper(symbol)
    return F.when(s.endswith(".BJ"), "BSE").when(s.startswith("688") & s.endswith(".SH"), "STAR").when(s.startswith("300") & s.endswith(".SZ"), "CHINEXT").otherwise("MAIN")


def rename_aliases(df: DataFrame, aliases: dict[str, list[str]], required: list[str]) -> DataFrame:
    """Canonical names for columns: for each name the first of its aliases that the table has. A required name without
    any is an error; other columns stay."""
    picked = {name: next((a for a in [name, *options] if a in df.columns), None) for name, options in aliases.items()}
    missing = [n for n in required if picked.get(n) is None and n not in df.columns]
    if missing:
        raise ValueError(f"no column for {missing} among {df.columns}")
    return df.withColumnsRenamed({a: n for n, a in picked.items() if a and a != n})


def valid_keys(df: DataFrame, code: str, date: str) -> DataFrame:
    """Rows whose code and date have their canonical form."""
    return df.where(F.col(code).rlike(r"^\d{6}\.(SH|SZ|BJ)$") & F.col(date).cast("string").rlike(r"^\d{8}$"))


def resolve_code(df: DataFrame, mapping: DataFrame, code: str, rules: dict[str, str]) -> DataFrame:
    """Adds resolved (code with exchange) and resolution: from a mapping table (code, full) first, else by the longest
    prefix of `rules`, else unresolved (null)."""
    known = mapping.select(F.col("code").alias("_code"), F.col("full").alias("_full"))
    out = df.join(known, F.col(code) == F.col("_code"), "left")
    fallback = F.coalesce(*[F.when(F.col(code).startswith(p), F.concat(F.col(code), F.lit(x))) for p, x in sorted(rules.items(), key=lambda r: -len(r[0]))])
    how = F.when(F.col("_full").isNotNull(), "mapped").when(fallback.isNotNull(), "prefix").otherwise("unresolved")
    return out.withColumns({"resolved": F.coalesce("_full", fallback), "resolution": how}).drop("_code", "_full")


def scale_units(df: DataFrame, profile: dict[str, float]) -> DataFrame:
    """Columns times the factors of a source's unit profile."""
    return df.withColumns({c: F.col(c) * F.lit(x) for c, x in profile.items()})


def minute_flags(df: DataFrame, year: int, epoch: str = "epoch") -> DataFrame:
    """Ten validity flags of annual minute bars (ticker, epoch seconds, open, high, low, close, volume, amount) and keep,
    and two more that are only reported: volume without amount, and amount without volume.

    A row of nulls only is a placeholder; the other flags hold for other rows. 13:00 without any flow is dropped, as the
    afternoon begins behind it.
    """
    values = [F.col(c) for c in ("open", "high", "low", "close", "volume", "amount")]
    empty = reduce(lambda a, b: a & b, [v.isNull() | F.isnan(v) for v in values])
    partial = ~empty & reduce(lambda a, b: a | b, [v.isNull() | F.isnan(v) for v in values])
    infinite = ~empty & F.coalesce(reduce(lambda a, b: a | b, [F.abs(v) == float("inf") for v in values]), F.lit(False))
    sound = ~empty & ~partial & ~infinite
    o, h, lo, c, v, a = values
    at = F.timestamp_seconds(epoch)
    clock = F.hour(at) * 100 + F.minute(at)
    still = sound & F.col(epoch).isNotNull() & (clock == 1300) & (F.second(at) == 0) & (v == 0) & (a == 0) & (o == c) & (o == h) & (o == lo)
    off = ~empty & F.col(epoch).isNotNull() & ~still & ~(clock.between(930, 1130) | clock.between(1301, 1500))
    flags = {
        "is_empty": empty, "partial_null": partial, "non_finite": infinite, "invalid_ticker": ~empty & F.col("ticker").isNull(), "invalid_timestamp": ~empty & F.col(epoch).isNull(),
        "wrong_year": ~empty & (F.year(at) != year), "non_minute": ~empty & (F.col(epoch) % 60 != 0), "negative_flow": sound & ((v < 0) | (a < 0)), "dropped_zero_flow": still, "off_session": off,
    }
    reported = {"zero_volume_nonzero_amount": sound & (v == 0) & (a > 0), "positive_volume_zero_amount": sound & (v > 0) & (a == 0)}
    df = df.withColumns({k: F.coalesce(x, F.lit(False)) for k, x in (flags | reported).items()})
    return df.withColumn("keep", ~reduce(lambda x, y: x | y, [F.col(k) for k in flags]))


#: Holder types of persons, and words that name institutions.
PERSONS = ("个人", "自然人")
INSTITUTIONS = ("公司", "集团", "有限", "银行", "基金", "保险", "证券", "信托", "资管", "资产", "投资", "社保", "汇金", "证金", "国有", "财政", "中央", "合伙", "计划", "qfii", "llc", "ltd", "limited", "inc")


def is_institution(name: Column, kind: Column) -> Column:
    """By the holder's type if there is one, else by its name: up to four Chinese characters are a person's."""
    kind, name = F.trim(F.coalesce(kind, F.lit(""))), F.lower(F.trim(F.coalesce(name, F.lit(""))))
    by_name = ~name.rlike("^[\\u4e00-\\u9fff]{1,4}$") & name.rlike("|".join(INSTITUTIONS))
    return F.when(kind.isin(*PERSONS), False).when(kind != "", True).otherwise(by_name)


def is_buy_rating(c: Column, words: tuple[str, ...]) -> Column:
    """Whether a rating's text holds one of the words; null holds none."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.contains(F.lower(c), F.lit(w)) for w in words]), F.lit(False))


def canonical_ticks(df: DataFrame, aliases: dict[str, list[str]], labels: DataFrame, row_id: str, drop: list[str]) -> DataFrame:
    """Ticks under canonical names (the first alias that is not null), with the sparse decision of their row, without
    rows of the decisions to drop. Rows without a label are kept."""
    named = df.select(row_id, *[F.coalesce(*[F.col(a) for a in options if a in df.columns]).alias(n) for n, options in aliases.items()])
    out = named.join(labels.select(row_id, "decision"), row_id, "left").withColumn("decision", F.coalesce("decision", F.lit("keep")))
    return out.where(~F.col("decision").isin(*drop))


def research_identity(df: DataFrame, code: str, date: str, known: DataFrame, overrides: DataFrame) -> DataFrame:
    """Adds identity: a dated override (code, from_date, to_date, identity), else the known key (code, identity), else
    the code with `unresolved:` in front. Both tables are short."""
    k = known.select(F.col("code").alias("_k"), F.col("identity").alias("_known"))
    o = overrides.select(F.col("code").alias("_o"), "from_date", "to_date", F.col("identity").alias("_override"))
    inside = (F.col(code) == F.col("_o")) & F.col(date).between(F.col("from_date"), F.coalesce("to_date", F.lit("9999-12-31").cast("date")))
    out = df.join(k, F.col(code) == F.col("_k"), "left").join(o, inside, "left")
    return out.withColumn("identity", F.coalesce("_override", "_known", F.concat(F.lit("unresolved:"), F.col(code).cast("string")))).drop("_k", "_known", "_o", "_override", "from_date", "to_date")


def dated_code(df: DataFrame, code: str, date: str, switches: DataFrame) -> DataFrame:
    """Adds active_code: the code under which a security traded on a date. switches: new_code, old_code, first_day, the
    first day of the new code."""
    s = switches.select(F.col("new_code").alias("_new"), "old_code", "first_day")
    out = df.join(s, F.col(code) == F.col("_new"), "left")
    return out.withColumn("active_code", F.when(F.col(date) < F.col("first_day"), F.col("old_code")).otherwise(F.col(code))).drop("_new", "old_code", "first_day")


def repair_join_key(c: Column) -> tuple[Column, Column]:
    """A code of the form 123456!1.SH without its mark, and whether it was repaired."""
    text = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    key = F.regexp_replace(text, r"^(\d{6})!1\.(SH|SZ)$", "$11.$2")
    return key, key != text


def within_spans(df: DataFrame, spans: DataFrame, key: str, date: str) -> DataFrame:
    """Rows of keys with a validity span (key, start, end; a null bound is open) that holds their date."""
    return df.join(covered(df, spans, key, date, "start", "end"), [key, date], "left_semi").select(*df.columns)


def pick_columns(df: DataFrame, keys: list[str], wanted: list[str]) -> DataFrame:
    """Keys and those wanted columns that the table has."""
    return df.select(*keys, *[c for c in wanted if c in df.columns and c not in keys])


def filled(df: DataFrame, keys: list[str], fills: dict[str, float]) -> DataFrame:
    """Keys and a fixed set of columns; one that is missing or null has its fill."""
    return df.select(*keys, *[(F.coalesce(F.col(c).cast("double"), F.lit(float(x))) if c in df.columns else F.lit(float(x))).alias(c) for c, x in fills.items()])


def plain_number(c: Column) -> Column:
    """A number written with thousands separators; anything else is null."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("double")


def renamed_bars(df: DataFrame, names: dict[str, str], numbers: list[str], code: str, time: str, first: str, last: str, order: list[Column]) -> DataFrame:
    """Raw bars of one source under canonical names: numbers without separators, columns that are missing null, the last
    row of each time, within the session's times."""
    own = df.select(*[(F.col(a) if a in df.columns else F.lit(None).cast("string")).alias(n) for n, a in names.items()], *[c for c in df.columns if c not in names.values()])
    own = own.withColumns({c: plain_number(F.col(c).cast("string")) for c in numbers})
    return keep_one(own, [code, time], order).where(F.date_format(time, "HH:mm").between(first, last))


def repair_bars(df: DataFrame) -> DataFrame:
    """Bars without placeholder rows (all values null), with high and low widened to hold open and close, and whether one
    of them was changed."""
    some = F.coalesce("open", "high", "low", "close", "volume", "amount").isNotNull()
    hi, lo = F.greatest("open", "high", "low", "close"), F.least("open", "high", "low", "close")
    out = df.where(some).withColumns({"_hi": hi, "_lo": lo})
    return out.withColumns({"repaired": ~F.col("_hi").eqNullSafe(F.col("high")) | ~F.col("_lo").eqNullSafe(F.col("low")), "high": F.col("_hi"), "low": F.col("_lo")}).drop("_hi", "_lo")


def limit_flags(close: Column, up: Column, down: Column) -> tuple[Column, Column]:
    """Whether a close reaches its upper or its lower limit; false where one of them is unknown."""
    return F.coalesce(close >= up, F.lit(False)), F.coalesce(close <= down, F.lit(False))


def suspended(daily: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Adds is_suspended: in the list of suspensions, or without volume or amount (an unknown one counts as none)."""
    out = daily.join(listed.select(*keys).distinct().withColumn("_off", F.lit(True)), keys, "left")
    none = (F.coalesce("volume", F.lit(0)) <= 0) | (F.coalesce("amount", F.lit(0)) <= 0)
    return out.withColumn("is_suspended", F.coalesce("_off", F.lit(False)) | none).drop("_off")


def tick_triage(df: DataFrame, kind: str, *, code: str, time: str, price: str, event_id: str | None = None) -> DataFrame:
    """Adds decision (keep, tag or exclude) and reason; the first rule that holds decides. kind: order, deal or snapshot;
    a snapshot has no event id."""
    if kind not in ("order", "deal", "snapshot") or (kind != "snapshot" and event_id is None):
        raise ValueError("kind must be order, deal or snapshot, and orders and deals need an event id")
    p = F.col(price)
    rules = [("exclude", "missing_required_value", F.col(code).isNull() | F.col(time).isNull() | p.isNull())]
    if kind == "snapshot":
        rules.append(("tag", "empty_snapshot_price", p <= 0))
    else:
        rules += [("exclude", "missing_event_id", F.col(event_id).isNull()), ("tag", "special_price_or_event", p <= 0)]
    pick = lambda i, rest: reduce(lambda out, r: F.when(r[2], r[i]).otherwise(out), reversed(rules), F.lit(rest))
    return df.withColumns({"decision": pick(0, "keep"), "reason": pick(1, "")})
