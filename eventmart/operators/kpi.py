"""Indicators over sessions, dimensions and rules.

Everything is pre-aggregated before it is shuffled. Windows only run over rollups, whose
size is bounded by calendar periods, never over raw rows; those without keys run inside days
and take what lies before a day from ``prefix``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.numbers import exact_sum
from eventmart.functions.time import clock_minutes, epoch_micros, minute_of_day, trunc_ts
from eventmart.operators.prefix import before_each, day_number

DURATION = "duration_minutes"


def occupancy_over_time(
    sessions: DataFrame, start: str, end: str, grid: str = "hour", keys: Sequence[str] = ()
) -> DataFrame:
    """Open sessions at the end of each period in which something changed.

    A session counts +1 in the period of its start and -1 in that of its end; the running
    sum goes over one summed row per key and period. Without keys it is put together from
    days, so that no task holds all periods.
    """
    moves = sessions.select(
        *keys,
        F.inline(
            F.array(
                F.struct(trunc_ts(grid, start).alias("period"), F.lit(1).alias("move")),
                F.struct(trunc_ts(grid, end).alias("period"), F.lit(-1).alias("move")),
            )
        ),
    ).filter(F.col("period").isNotNull())
    net = moves.groupBy(*keys, "period").agg(
        F.sum("move").alias("net_change"),
        F.count_if(F.col("move") > 0).alias("arrivals"),
    )
    dealt = list(keys) or ["__day"]
    net = net if keys else net.withColumn("__day", day_number(net, "period"))
    so_far = Window.partitionBy(*dealt).orderBy("period").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = net.withColumn("occupied", F.sum("net_change").over(so_far))
    if not keys:
        # the filter drops nothing; with the same columns both readers of net share its exchange
        days = net.filter("arrivals >= 0").groupBy("__day")
        days = days.agg(F.sum("net_change").alias("net_change"))
        running = running.join(before_each(days, "__day", "net_change", F.sum), "__day", "left")
        running = running.withColumn(
            "occupied", F.col("occupied") + F.coalesce("before", F.lit(0))
        )
    return running.select(*keys, "period", "arrivals", "occupied")


def period_totals(
    sessions: DataFrame, ts: str, unit: str = "day", keys: Sequence[str] = (), value: str = DURATION
) -> DataFrame:
    """Sessions, total and mean of ``value`` per period."""
    return sessions.groupBy(*keys, trunc_ts(unit, ts).alias("period")).agg(
        F.count(F.lit(1)).alias("sessions"),
        exact_sum(value).alias("total_value"),
        (exact_sum(value) / F.count(value)).alias("mean_value"),
    )


def top_by_count(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent key values; ties go to the smaller key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("sessions"))
    return counts.orderBy(F.col("sessions").desc(), *keys).limit(k)


def peak_hours(sessions: DataFrame, ts: str, k: int = 24) -> DataFrame:
    """Hours of the day by number of arrivals, busiest first."""
    return top_by_count(sessions.select(F.hour(ts).alias("hour_of_day")), ["hour_of_day"], k)


def turnover(sessions: DataFrame, key: str, ts: str, unit: str = "day") -> DataFrame:
    """Sessions per key and period."""
    return sessions.groupBy(key, trunc_ts(unit, ts).alias("period")).agg(
        F.count(F.lit(1)).alias("sessions")
    )


def flag_share(df: DataFrame, flag: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose boolean ``flag`` is true."""
    return df.groupBy(*keys).agg(F.avg(F.col(flag).cast("double")).alias("share"))


def variance(
    rollup: DataFrame, period: str, value: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Change against the previous period present in a rollup (one row per key and period).

    Without keys, the first period of a day finds its predecessor in the days before; periods
    that are neither times nor whole numbers are then compared in one task.
    """
    change = F.round(F.col(value) - F.col("previous"), 2)
    number = None if keys else day_number(rollup, period)
    if number is None:
        before = F.lag(value).over(Window.partitionBy(*keys).orderBy(period))
        return rollup.withColumn("previous", before).withColumn("change", change)
    inside = Window.partitionBy("__day").orderBy(period)
    dealt = rollup.withColumn("__day", number)
    # whole rows, so that both readers of the rollup share its exchange
    row = F.struct(*rollup.columns)
    lasts = dealt.groupBy("__day").agg(F.max_by(row, F.struct(period)).alias("last"))
    stepped = dealt.withColumns(
        {"__in_day": F.lag(value).over(inside), "__first": F.row_number().over(inside) == 1}
    )

    def latest(rows: str) -> Column:
        return F.max_by(rows, F.struct(F.col(rows)[period]))

    joined = stepped.join(before_each(lasts, "__day", "last", latest), "__day", "left")
    previous = F.when(F.col("__first"), F.col("before")[value]).otherwise(F.col("__in_day"))
    return joined.select(
        *rollup.columns, previous.alias("previous")
    ).withColumn("change", change)


def stay_shares(report: DataFrame, category: str = "stay_category") -> DataFrame:
    """Sessions and minutes per stay category."""
    return report.groupBy(category).agg(
        F.count(F.lit(1)).alias("sessions"), exact_sum(DURATION).alias("total_minutes")
    )


# --- rules in force -------------------------------------------------------------------

RULE_FIELDS = {
    "rule_number": "rule_number",
    "max_minutes": "max_minutes",
    "start_time": "start_time",
    "end_time": "end_time",
    "day": "day_range",
    "type": "type_desc",
}


def _covers(rule: Column, minute: Column, day: Column) -> Column:
    """Whether a rule holds at a minute of a day. The start is inside, the end outside; a rule
    that ends at or before its start runs past midnight and belongs to the day it began. Days
    count from Sunday = 0; a rule without a day holds every day."""
    begins, ends, on = rule["begins"], rule["ends"], rule["day"]
    same_day = on.isNull() | (on == day)
    day_before = on.isNull() | (on == F.pmod(day - 1, F.lit(7)))
    plain = (begins < ends) & same_day & (minute >= begins) & (minute < ends)
    late = (begins >= ends) & same_day & (minute >= begins)
    early = (begins >= ends) & day_before & (minute < ends)
    return F.coalesce(plain | late | early, F.lit(False))


def _packed(rules: DataFrame, rule_key: str, fields: Mapping[str, str]) -> DataFrame:
    """(__rule_key, __rules): the rules of a key in one array, lowest number first."""
    readable = F.col(fields["day"]).isNull() | F.col(fields["day"]).try_cast("int").isNotNull()
    hours = rules.filter(readable).select(
        F.col(rule_key).alias("__rule_key"),
        F.col(fields["day"]).try_cast("int").alias("day"),
        clock_minutes(fields["start_time"]).alias("begins"),
        clock_minutes(fields["end_time"]).alias("ends"),
        F.struct(
            F.col(fields["rule_number"]).cast("int").alias("rule_number"),
            F.col(fields["max_minutes"]).cast("double").alias("max_minutes"),
            F.col(fields["type"]).alias("type"),
        ).alias("rule"),
    ).filter(F.col("begins").isNotNull() & F.col("ends").isNotNull() & F.col("__rule_key").isNotNull())
    lowest = hours.groupBy("__rule_key", "day", "begins", "ends").agg(F.min("rule").alias("rule"))
    return lowest.groupBy("__rule_key").agg(
        F.array_sort(
            F.collect_list(F.struct("rule.*", "day", "begins", "ends"))
        ).alias("__rules")
    )


def rule_in_force(
    sessions: DataFrame,
    rules: DataFrame,
    key: str,
    arrival: str,
    rule_key: str | None = None,
    fields: Mapping[str, str] = RULE_FIELDS,
) -> DataFrame:
    """Add the lowest-numbered rule holding at arrival as a struct ``rule`` (or NULL).

    Rules are packed into one array per key, so the join keeps one row per session: no
    fan-out, and no second shuffle to pick the winner. Of rules with the same day and hours
    only the lowest can ever win, so a key's array is bounded by the distinct weekly hours,
    however many rule rows the key has. A rule whose day is text other than a number is
    left out: which days it means is unknown.
    """
    packed = _packed(rules, rule_key or key, fields)
    minute, day = minute_of_day(arrival), F.dayofweek(F.col(arrival)) - 1
    holding = F.filter("__rules", lambda r: _covers(r, minute, day))
    # Null-safe equality on keys that are never NULL here: plain equality would reuse the
    # shuffle under the packing aggregate, and the adaptive skew split needs one above it.
    return (
        sessions.join(packed, F.col(key).eqNullSafe(F.col("__rule_key")), "left")
        .withColumn("rule", F.get(holding, F.lit(0)))
        .drop("__rule_key", "__rules")
    )


_MINUTE, _DAY = 60_000_000, 86_400_000_000


def rules_along_stay(
    sessions: DataFrame,
    rules: DataFrame,
    key: str,
    arrival: str,
    departure: str,
    rule_key: str | None = None,
    fields: Mapping[str, str] = RULE_FIELDS,
) -> DataFrame:
    """Each session in segments, cut wherever a weekly rule of its key begins or ends, with
    the lowest-numbered ``rule`` that holds in the segment (or NULL) and its length ``micros``.

    Segments of a session add up to its length; a session of no length, or without an end,
    has none. A segment stays in the task of its session: a stay of many days has as many
    segments as rule edges lie in it.
    """
    packed = _packed(rules, rule_key or key, fields)
    lo, hi = F.col("__lo"), F.col("__hi")
    # a day's first minute is an edge too: rules hold on some days only
    edges = F.array_distinct(
        F.flatten(
            F.array(
                F.array(F.lit(0)),
                F.coalesce(
                    F.transform("__rules", lambda r: r["begins"]), F.array().cast("array<int>")
                ),
                F.coalesce(
                    F.transform("__rules", lambda r: r["ends"]), F.array().cast("array<int>")
                ),
            )
        )
    )
    days = F.sequence(F.floor(lo / F.lit(_DAY)), F.floor(hi / F.lit(_DAY)))
    moments = F.flatten(
        F.transform(
            days, lambda d: F.transform(edges, lambda m: d * _DAY + m.cast("long") * _MINUTE)
        )
    )
    inner = F.filter(moments, lambda t: (t > lo) & (t < hi))
    points = F.array_sort(F.array_distinct(F.concat(F.array(lo), inner, F.array(hi))))
    spans = F.transform(
        F.sequence(F.lit(0), F.size("__points") - 2),
        lambda i: F.struct(
            F.get("__points", i).alias("at"),
            (F.get("__points", i + 1) - F.get("__points", i)).alias("micros"),
        ),
    )
    minute = F.floor(F.pmod(F.col("__at"), F.lit(_DAY)) / F.lit(_MINUTE))
    day = F.pmod(F.floor(F.col("__at") / F.lit(_DAY)) + 4, F.lit(7))  # 1970-01-01: a Thursday
    return (
        sessions.withColumns({"__lo": epoch_micros(arrival), "__hi": epoch_micros(departure)})
        .filter(lo < hi)
        .join(packed, F.col(key).eqNullSafe(F.col("__rule_key")), "left")
        .withColumn("__points", points)
        .withColumn("__span", F.explode(spans))
        .withColumns({"__at": F.col("__span.at"), "micros": F.col("__span.micros")})
        .withColumn("rule", F.get(F.filter("__rules", lambda r: _covers(r, minute, day)), F.lit(0)))
        .select(*sessions.columns, F.timestamp_micros("__at").alias("segment_start"), "micros", "rule")
    )


def minutes_along_stay(segments: DataFrame) -> DataFrame:
    """Segments of ``rules_along_stay`` and their minutes per type of rule."""
    return segments.groupBy(F.col("rule.type").alias("rule_type")).agg(
        F.count(F.lit(1)).alias("segments"),
        (F.sum("micros") / F.lit(float(_MINUTE))).alias("total_minutes"),
    )


def overstays(ruled: DataFrame, duration: str = DURATION) -> DataFrame:
    """Limit, type and overstay flag of each session of ``rule_in_force``; a session that no
    rule covers, or whose rule has no limit, is no overstay."""
    limit = F.col("rule.max_minutes")
    return ruled.select(
        *(c for c in ruled.columns if c != "rule"),
        F.col("rule.rule_number").alias("rule_number"),
        F.col("rule.type").alias("rule_type"),
        limit.alias("max_minutes"),
        F.coalesce(F.col(duration) > limit, F.lit(False)).alias("is_overstay"),
    )


def minutes_by_rule_type(ruled: DataFrame, duration: str = DURATION) -> DataFrame:
    """Sessions and total minutes per type of the rule in force."""
    return ruled.groupBy(F.col("rule.type").alias("rule_type")).agg(
        F.count(F.lit(1)).alias("sessions"), exact_sum(duration).alias("total_minutes")
    )


def over_capacity(
    occupancy: DataFrame, capacity: DataFrame, keys: Sequence[str], limit: str = "capacity"
) -> DataFrame:
    """Rows of ``occupancy_over_time`` that exceed the capacity of their key."""
    joined = occupancy.join(capacity.select(*keys, limit), list(keys))
    return joined.filter(F.col("occupied") > F.col(limit))
