"""Disclosures over time: announcement events, normalised fundamentals, ledgers of versions, conflicts and their
resolution, context observations, status history and holder structure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalar import tolerant_date
from tideline.operators.pit import newest_flagged
from tideline.operators.sweeps import nearest, stretches
from tideline.operators.windows import intervals, keep_one, safe_ratio

#: Which report types an as-of selection takes; None takes all.
POLICIES: dict[str, tuple[str, ...] | None] = {"standard": ("1",), "diagnostic_including_type5": ("1", "5"), "all": None, "dataset_native": None}


def content_hash(columns: list[str]) -> Column:
    """A stable hash of a row's columns; a null and an empty text differ."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def announcement_events(raw: DataFrame, dataset: str, *, symbol: str = "ts_code", period: str = "end_date", announced: str = "ann_date", first: str = "f_ann_date", types: list[str] | None = None) -> DataFrame:
    """Events of raw statements, revisions and report types kept apart: adds report_period, available_date (the first
    announcement, else the announcement), row_hash and event_id. Rows that were never announced go."""
    rows = raw if types is None else raw.where(F.col("report_type").isin(*types))
    dated = rows.withColumns({"report_period": tolerant_date(F.col(period)), "available_date": F.coalesce(tolerant_date(F.col(first)), tolerant_date(F.col(announced)))}).where(F.col("available_date").isNotNull() & (F.coalesce(F.col(symbol), F.lit("")) != ""))
    hashed = dated.withColumn("row_hash", content_hash(raw.columns))
    return hashed.withColumn("event_id", F.sha2(F.concat_ws("|", F.lit(dataset), symbol, F.col("report_period").cast("string"), F.col("available_date").cast("string"), "row_hash"), 256))


def announced_as_of(events: DataFrame, at: Column, policy: str = "standard", *, symbol: str = "symbol", order: str = "event_id") -> DataFrame:
    """The latest visible event of each report period under a report-type policy, and of each type unless it is standard."""
    types = POLICIES[policy]
    seen = events.where(F.col("available_date") <= at)
    seen = seen if types is None else seen.where(F.col("report_type").isin(*types))
    keys = [symbol, "report_period"] + (["report_type"] if policy != "standard" else [])
    flag = F.coalesce(F.col("update_flag").cast("string").try_cast("double"), F.lit(-1.0))
    return keep_one(seen, keys, [F.desc("available_date"), F.desc(flag), F.desc(order)])


def component_panel(parts: dict[str, DataFrame], keys: list[str], values: dict[str, list[str]]) -> DataFrame:
    """Components joined one to one on the keys, columns named part_column, with the latest availability of all; a key
    that a part holds twice is an error when the rows are read."""

    def one(name: str) -> DataFrame:
        stop = F.raise_error(F.lit(f"{name} holds a key twice")).cast("int")
        once = parts[name].groupBy(*keys).agg(F.count("*").alias("_n"), F.max("available_date").alias(f"_at_{name}"), *[F.first(c).alias(f"{name}_{c}") for c in values[name]])
        return once.withColumn("_n", F.when(F.col("_n") > 1, stop).otherwise(F.col("_n"))).where("_n > 0").drop("_n")

    out = reduce(lambda a, b: a.join(b, keys), map(one, parts))
    at = [f"_at_{name}" for name in parts]
    return out.withColumn("available_date", F.greatest(*at) if len(at) > 1 else F.col(at[0])).drop(*at)


def annual_only(df: DataFrame, period: str = "report_period") -> DataFrame:
    return df.where((F.month(period) == 12) & (F.dayofmonth(period) == 31))


def normalized_fundamentals(raw: DataFrame, keys: list[str], values: list[str], *, report_types: list[str], templates: list[str], revision: list[str]) -> DataFrame:
    """Statements of the report types and templates asked for, of each key the newest revision, with `ambiguous` where
    the newest revisions differ in a value."""
    kept = raw.where(F.col("report_type").isin(*report_types) & F.col("comp_type").isin(*templates))
    newest = newest_flagged(kept, keys, revision)
    versions = F.size(F.collect_set(F.to_json(F.struct(*values), {"ignoreNullFields": "false"})).over(Window.partitionBy(*keys)))
    return keep_one(newest.withColumn("ambiguous", versions > 1), keys, [F.desc(content_hash(values))])


def drop_counters(raw: DataFrame, *, report_types: list[str], templates: list[str]) -> DataFrame:
    """One row: rows read, dropped for their report type and for their template."""
    wrong = ~F.coalesce(F.col("report_type").isin(*report_types), F.lit(False))
    return raw.agg(F.count("*").alias("n_read"), F.count_if(wrong).alias("n_report_type"), F.count_if(~wrong & ~F.coalesce(F.col("comp_type").isin(*templates), F.lit(False))).alias("n_template"))


def coalesce_sources(df: DataFrame, keys: list[str], values: list[str], order: str, source: str) -> DataFrame:
    """One row a key: of each column the last value that is not null in source order, and the sources joined in order."""
    picks = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in values]
    names = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(order, source))), lambda s: s[source]), "+").alias("sources")
    return df.groupBy(*keys).agg(*picks, names)


#: What a field's state tells about the event it came from.
PROVENANCE = ("report_period", "available_date", "disclosure_date", "retrieved_at", "event_id", "report_type", "update_flag", "comp_type", "source", "row_hash")


def field_state_with_provenance(events: DataFrame, key: str, fields: list[str], order: list[str], told: list[str]) -> DataFrame:
    """Per key and field the last value that is not null, with all told columns of its event and its age in days from the
    event to the newest one of the key."""
    at = F.struct(*order)
    picks = [F.max_by(F.struct(F.col(f).alias("value"), *told), F.when(F.col(f).isNotNull(), at)).alias(f"_{f}") for f in fields]
    out = events.groupBy(key).agg(*picks, F.max(order[0]).alias("_newest"))
    columns = [c for f in fields for c in (F.col(f"_{f}.value").alias(f), *[F.col(f"_{f}.{t}").alias(f"{f}_{t}") for t in told], F.datediff("_newest", f"_{f}.{order[0]}").alias(f"{f}_age"))]
    return out.select(key, *columns)


def freshness(vintages: DataFrame, sources: DataFrame, dates: DataFrame, source: str, vintage: str, date: str, max_age: int) -> DataFrame:
    """For each date and source the newest vintage by then, its age and its state: missing, stale or fresh.

    sources and dates are short lists; each vintage is looked up as-of, so no range join is made.
    """
    from tideline.operators.joins import as_of

    asked = sources.select(source).distinct().join(F.broadcast(dates.agg(F.collect_set(date).alias("_d")))).select(source, F.explode("_d").alias(date))
    out = as_of(asked, vintages.select(source, vintage).distinct(), [source], date, vintage, [])
    age = F.datediff(date, f"{vintage}_matched")
    return out.select(source, date, F.col(f"{vintage}_matched").alias(vintage), age.alias("age"), F.when(age.isNull(), "missing").when(age > max_age, "stale").otherwise("fresh").alias("state"))


def pit_checks(columns: list[str], keys: list[str], period: str, disclosed: str, available: str) -> dict[str, tuple[str, Column]]:
    """Checks of a point-in-time table for gates.check_table; columns that are missing are an error at once."""
    missing = [c for c in (*keys, period, disclosed, available) if c not in columns]
    if missing:
        raise ValueError(f"the table lacks {missing}")
    return {
        "null_key": ("error", reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])),
        "disclosed_before_period": ("error", F.col(disclosed) < F.col(period)),
        "available_before_disclosed": ("error", F.col(available) < F.col(disclosed)),
        "duplicate_key": ("error", F.count("*").over(Window.partitionBy(*keys)) > 1),
    }


def version_ledger(rows: DataFrame, observed: str, zone: str, delay: int, *, announced: str = "ann_date", first: str = "f_ann_date") -> DataFrame:
    """Adds available_from: the later of the disclosures and the local date of observation, plus a delay of at least one
    day. Rows without a disclosure are an error when they are read. Nothing is collapsed."""
    if delay < 1:
        raise ValueError("a delay of at least one day is required")
    local = F.to_date(F.from_utc_timestamp(F.col(observed).cast("timestamp"), zone))
    disclosed = F.greatest(tolerant_date(F.col(announced)), tolerant_date(F.col(first)))
    known = F.when(disclosed.isNull(), F.raise_error(F.lit("a row lacks its disclosure")).cast("date")).otherwise(disclosed)
    return rows.withColumn("available_from", F.date_add(F.greatest(known, local), delay))


def category_conflicts(df: DataFrame, event: list[str], category: str, fields: list[str]) -> DataFrame:
    """Events with more than one category, and the fields whose values differ between them (null is a value)."""
    differ = [F.when(F.size(F.collect_set(F.coalesce(F.col(f).cast("string"), F.lit("\0")))) > 1, F.lit(f)) for f in fields]
    out = df.groupBy(*event).agg(F.countDistinct(category).alias("n_categories"), F.array_compact(F.array(*differ)).alias("fields"))
    return out.where("n_categories > 1").withColumn("fields", F.array_join("fields", ","))


def decided(df: DataFrame, conflicts: DataFrame, decisions: DataFrame, event: list[str], category: str) -> tuple[DataFrame, DataFrame]:
    """Rows after decisions (event, chosen category): of an event in conflict only the chosen category stays, undecided
    ones go whole. Returns the rows and the errors: undecided, chosen_absent, needless (a decision without a conflict)."""
    d = decisions.select(*event, F.col("chosen"))
    open_ = conflicts.select(*event, F.lit(True).alias("_open"))
    rows = df.join(open_, event, "left").join(d, event, "left").where(F.col("_open").isNull() | (F.col(category) == F.col("chosen"))).select(*df.columns)
    found = df.select(*event, F.col(category).alias("chosen")).distinct().withColumn("_has", F.lit(True))
    each = open_.join(d, event, "full_outer").join(found, [*event, "chosen"], "left")
    error = F.when(F.col("_open").isNull(), "needless").when(F.col("chosen").isNull(), "undecided").when(F.col("_has").isNull(), "chosen_absent")
    return rows, each.select(*event, error.alias("error")).where("error IS NOT NULL")


def field_consensus(df: DataFrame, event: list[str], fields: list[str], usable: str) -> DataFrame:
    """Per event and field the value that all versions share (null if they differ), whether all fields agree, and the
    moment from which all versions are usable."""
    same = lambda f: F.size(F.collect_set(F.coalesce(F.col(f).cast("string"), F.lit("\0")))) == 1
    out = df.groupBy(*event).agg(F.count("*").alias("n_versions"), F.max(usable).alias("usable_at"), *[same(f).alias(f"_{f}") for f in fields], *[F.max(f).alias(f) for f in fields])
    agreed = reduce(lambda a, b: a & b, [F.col(f"_{f}") for f in fields])
    return out.select(*event, "n_versions", "usable_at", agreed.alias("agreed"), *[F.when(F.col(f"_{f}"), F.col(f)).alias(f) for f in fields])


def adjudicate(candidates: DataFrame, evidence: DataFrame, event: list[str], value: str, usable: str) -> DataFrame:
    """Evidence (event, value, evidence_at) against the candidates of an event (value, usable): resolved if a candidate
    has that value, usable from the later of both times; else rejected."""
    c = candidates.groupBy(*event, value).agg(F.min(usable).alias("_usable"))
    out = evidence.join(c, [*event, value], "left")
    return out.select(*event, value, F.when(F.col("_usable").isNull(), "rejected").otherwise("resolved").alias("state"), F.greatest("evidence_at", "_usable").alias("usable_at")).withColumn("usable_at", F.when(F.col("state") == "resolved", F.col("usable_at")))


def resolved_as_of(resolutions: DataFrame, event: list[str], value: str, at: Column) -> DataFrame:
    """The value of each resolution that is usable by then; null before."""
    seen = (F.col("state") == "resolved") & (F.col("usable_at") <= at)
    return resolutions.select(*event, F.when(seen, F.col(value)).alias(value))


def exact_read(asked: DataFrame, events: DataFrame, event: list[str], at: Column, value: str) -> DataFrame:
    """What is known of exact events by then: available with its value, conflict, not_yet or out_of_scope."""
    e = events.select(*event, value, "agreed", "usable_at", F.lit(True).alias("_in"))
    out = asked.join(e, event, "left")
    status = F.when(F.col("_in").isNull(), "out_of_scope").when(F.col("usable_at") > at, "not_yet").when(~F.col("agreed"), "conflict").otherwise("available")
    return out.select(*event, status.alias("status"), F.when(status == "available", F.col(value)).alias(value))


def observation_faults(obs: DataFrame) -> DataFrame:
    """How many context observations break each of eleven rules, in one scan but for the key's uniqueness."""
    hours = ("period_start", "period_end", "observed_at", "ingested_at", "source_retrieved_at", "available_at")
    c = F.col
    rules = {
        "bad_time": reduce(lambda a, b: a | b, [c(x).isNull() for x in hours]),
        "no_series": (F.trim(F.coalesce("series_id", F.lit(""))) == "") | (F.trim(F.coalesce("vintage_id", F.lit(""))) == ""),
        "not_finite": F.abs(c("value")) == float("inf"),
        "bad_flag": c("revision_covered").isNull() | c("reconstructed").isNull(),
        "duplicate": F.count("*").over(Window.partitionBy("series_id", "period_end", "vintage_id")) > 1,
        "period_order": c("period_start") > c("period_end"),
        "bad_revision": c("revision_number").isNull() | (c("revision_number") < 0) | (c("revision_number") % 1 != 0),
        "bad_hash": ~F.coalesce(c("source_hash").rlike("^[0-9a-fA-F]{64}$"), F.lit(False)),
        "retrieved_early": c("source_retrieved_at") < c("observed_at"),
        "available_early": c("available_at") < c("published_at"),
        "covered_reconstruction": c("reconstructed") & c("revision_covered"),
    }
    marked = obs.select(*[F.coalesce(x, F.lit(False)).alias(n) for n, x in rules.items()])
    counts = marked.agg(*[F.count_if(n).alias(n) for n in rules])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), c(n).alias("n_bad")) for n in rules])).alias("r")).select("r.*")


def wide_to_observations(wide: DataFrame, period: str, values: list[str], kind: str) -> DataFrame:
    """A wide macro table as observations: series, period_start, period_end, value, without nulls. period is text,
    yyyyMM of a month, yyyyQn of a quarter or yyyy of a year; kind says which."""
    p = F.col(period)
    start = {"month": F.try_to_timestamp(p, F.lit("yyyyMM")), "quarter": F.make_date(F.substring(p, 1, 4).try_cast("int"), (F.substring(p, 6, 1).try_cast("int") - 1) * 3 + 1, F.lit(1)), "year": F.make_date(p.try_cast("int"), F.lit(1), F.lit(1))}[kind].cast("date")
    months = {"month": 1, "quarter": 3, "year": 12}[kind]
    long = wide.withColumn("period_start", start).select("period_start", F.explode(F.array(*[F.struct(F.lit(v).alias("series"), F.col(v).cast("double").alias("value")) for v in values])).alias("x"))
    return long.select("x.series", "period_start", F.date_sub(F.add_months("period_start", months), 1).alias("period_end"), "x.value").where("value IS NOT NULL AND period_start IS NOT NULL")


def released(obs: DataFrame, calendar: DataFrame, zone: str, days: int = 120, lag: int = 3) -> DataFrame:
    """Adds release_at (the start of the local day after the earliest publish date behind the period, within so many
    days) and observed (whether the retrieval came within `lag` days of it). calendar: series, publish_date."""
    at = F.to_utc_timestamp(F.date_add("publish_date", 1).cast("timestamp"), zone)
    cal = calendar.select("series", at.alias("_at")).distinct()
    keys = ["series", "period_end"]
    asked = obs.select(*keys).distinct().withColumn("_end", F.col("period_end").cast("timestamp"))
    first = asked.join(nearest(asked, cal, "series", "_end", "_at", "_first", ahead=True), ["series", "_end"])
    first = first.where(F.col("_first") <= F.col("_end") + F.make_dt_interval(days=F.lit(days))).select(*keys, F.col("_first").alias("release_at"))
    out = obs.join(first, keys, "left")
    late = F.col("retrieved_at") - F.col("release_at")
    return out.withColumn("observed", F.coalesce((F.col("retrieved_at") >= F.col("release_at")) & (late <= F.make_dt_interval(days=F.lit(lag))), F.lit(False)))


def to_float_ratios(holdings: DataFrame, valuation: DataFrame, keys: list[str], amount: str, share: str, unit: float = 10_000.0) -> DataFrame:
    """Amounts against the float in units of 10,000, and the change of the ratio from the period before."""
    j = holdings.join(valuation, keys, "left").withColumn("ratio", safe_ratio(F.col(amount), F.when(F.col(share) > 0, F.col(share) * unit)))
    return j.withColumn("ratio_change", F.col("ratio") - F.lag("ratio").over(Window.partitionBy(keys[0]).orderBy(*keys[1:])))


def status_history(changes: DataFrame, calendar: DataFrame, symbol: str, start: str, name: str, pattern: str, date: str) -> DataFrame:
    """Open days of the intervals whose name matches a pattern, from a table of name changes; each day once."""
    spans = intervals(changes, [symbol], start).where(F.col(name).rlike(pattern))
    return expand_intervals(spans, calendar, symbol, start, "end_date", name, date)


def expand_intervals(spans: DataFrame, calendar: DataFrame, symbol: str, start: str, end: str, value: str, date: str) -> DataFrame:
    """One row for each open day inside an interval, up to its end or, if that is open, the calendar's; of several
    intervals the one that starts last wins.

    Intervals are cut into stretches that do not overlap before days are made of them, so the spans alone are shuffled and
    sorted; days are not.
    """
    last = calendar.agg(F.max(date).alias("_last"))  # one row
    bounded = spans.join(F.broadcast(last)).withColumn("_end", F.least(F.coalesce(F.col(end), F.col("_last")), F.col("_last")))
    parts = stretches(bounded, symbol, start, "_end", value)
    days = parts.select(symbol, F.explode(F.sequence("_from", "_until")).alias(date), value)
    return days.join(F.broadcast(calendar.select(date).distinct()), date, "left_semi").select(symbol, date, value)


def announcement_timing(history: DataFrame, events: DataFrame, symbol: str, date: str, within: int) -> DataFrame:
    """Whether the newest event of a symbol within so many days before a date, on it, or after it announced it: same_day
    before prior before later, else none; with the evidence's date."""
    asked, e = history.select(symbol, date).distinct(), events.select(symbol, F.col(date).alias("_event")).distinct()
    out = nearest(asked, e, symbol, date, "_event", "_prior", ahead=False).withColumn("_k", F.struct(symbol, date))
    for more in (nearest(asked, e, symbol, date, "_event", "_later", ahead=True), e.select(symbol, F.col("_event").alias(date), F.col("_event").alias("_same"))):
        # null-safe, as a row without a symbol or date has its row too
        out = out.join(more.select(F.struct(symbol, date).alias("_m"), more.columns[-1]), F.col("_k").eqNullSafe(F.col("_m")), "left").drop("_m")
    out = out.withColumns({"_prior": F.when(F.col("_prior") >= F.date_sub(date, within), F.col("_prior")), "_later": F.when(F.col("_later") <= F.date_add(date, within), F.col("_later"))})
    timing = F.when(F.col("_same").isNotNull(), "same_day").when(F.col("_prior").isNotNull(), "prior").when(F.col("_later").isNotNull(), "later").otherwise("none")
    return out.select(symbol, date, timing.alias("timing"), F.coalesce("_same", "_prior", "_later").alias("evidence"))


def holder_structure(first: DataFrame, second: DataFrame, keys: list[str], period: str, names: tuple[str, str]) -> DataFrame:
    """Concentration of two holder tables (keys, period, amount, institution) side by side: of each key the latest
    period's total and institutional share, and their change."""

    def one(df: DataFrame, name: str) -> DataFrame:
        own = F.sum(F.when(F.col("institution"), F.col("amount")))
        each = df.groupBy(*keys, period).agg(F.sum("amount").alias("_total"), F.coalesce(own, F.lit(0.0)).alias("_own"))
        last = keep_one(each, keys, [F.desc(period)])
        return last.select(*keys, F.col("_total").alias(f"{name}_total"), safe_ratio(F.col("_own"), F.col("_total")).alias(f"{name}_share"))

    a, b = one(first, names[0]), one(second, names[1])
    w = Window.partitionBy(*keys[1:]).orderBy(keys[0])
    return a.join(b, keys, "full_outer").withColumns({f"{n}_change": F.col(f"{n}_share") - F.lag(f"{n}_share").over(w) for n in names})


def interval_table(raw: DataFrame, symbol: str, start: str, end: str, value: str) -> DataFrame:
    """Typed intervals, one for each symbol and start (the one that ends last), with a fault: bad_start, bad_order or null."""
    typed = raw.select(symbol, tolerant_date(F.col(start)).alias(start), F.when(F.trim(F.coalesce(F.col(end), F.lit(""))) != "", tolerant_date(F.col(end))).alias(end), value)
    one = keep_one(typed, [symbol, start], [F.desc_nulls_first(end), F.desc(value)])
    return one.withColumn("fault", F.when(F.col(start).isNull(), "bad_start").when(F.col(end) < F.col(start), "bad_order"))


def corporate_actions(events: DataFrame, keys: list[str], fields: list[str], required: list[str]) -> DataFrame:
    """One row for each action: ready if its versions agree and nothing required is missing, else blocked with the fields
    that conflict or are missing."""
    differ = [F.when(F.countDistinct(f) > 1, F.lit(f"{f}:conflict")) for f in fields]
    lacks = [F.when(F.count(f) == 0, F.lit(f"{f}:missing")) for f in required]
    out = events.groupBy(*keys).agg(F.count("*").alias("n_versions"), F.array_join(F.array_compact(F.array(*differ, *lacks)), ",").alias("why"), *[F.max(f).alias(f) for f in fields])
    ready = F.col("why") == ""
    return out.select(*keys, "n_versions", F.when(ready, "ready").otherwise("blocked").alias("state"), "why", *[F.when(ready, F.col(f)).alias(f) for f in fields])


def split_ambiguous(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Adds ambiguous: whether the rows of a key differ in a value."""
    tuples = F.collect_set(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))
    bad = df.groupBy(*keys).agg(F.size(tuples).alias("_n")).where("_n > 1").select(*keys, F.lit(True).alias("_bad"))
    return df.join(bad, keys, "left").withColumn("ambiguous", F.coalesce("_bad", F.lit(False))).drop("_bad")


def union_components(parts: dict[str, DataFrame], keys: list[str], period: str, known: str) -> tuple[DataFrame, DataFrame]:
    """Component tables as one, matched by name, with their component; and per component the rows and the extent of its
    periods and known dates."""
    from tideline.sources.files import union_by_name

    every = union_by_name([df.withColumn("component", F.lit(name)) for name, df in parts.items()])
    about = every.groupBy("component").agg(F.count("*").alias("n_rows"), F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.min(known).alias("first_known"), F.max(known).alias("last_known"), F.countDistinct(*keys).alias("n_keys"))
    return every, about
