"""Slowly changing history (type 2) and point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.keys import surrogate_key
from eventmart.functions.time import epoch_micros
from eventmart.operators.sessions import with_next
from eventmart.operators.skew import large_keys, slice_of, with_grid

FROM, TO = "valid_from", "valid_to"
FAR_FUTURE = "9999-12-31 00:00:00"


def _as_of(value: str | Column, kind: str) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast(kind)


def start_history(
    incoming: DataFrame, as_of: str | Column, ts_type: str = "timestamp_ntz"
) -> DataFrame:
    """History after a first snapshot: every row open from ``as_of``."""
    return incoming.select(
        "*", _as_of(as_of, ts_type).alias(FROM), F.lit(None).cast(ts_type).alias(TO)
    )


def scd2_apply(
    hist: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    as_of: str | Column,
) -> DataFrame:
    """History after one more snapshot.

    A new key opens a row at ``as_of``. A key with a different check column (NULL-safe)
    closes its open row at ``as_of`` and opens another. An unchanged key keeps its row, and
    so does a key the snapshot lacks. Closed rows pass through. ``incoming`` holds one row
    per key (``dedup.latest_by``); applying the same snapshot again changes nothing.

    One full outer join of open rows and snapshot decides all cases, so each side is
    shuffled once; keys are unique on both sides, so no key can be hot.
    """
    body = [c for c in hist.columns if c not in (FROM, TO)]
    ts_type = hist.schema[FROM].dataType.simpleString()
    moment = _as_of(as_of, ts_type)
    types = {c: hist.schema[c].dataType for c in body}

    def row(image: str, start: Column, end: Column) -> Column:
        return F.struct(
            *(F.col(f"{image}.{c}").cast(types[c]).alias(c) for c in body),
            start.alias(FROM),
            end.cast(ts_type).alias(TO),
        )

    still_open = hist.filter(F.col(TO).isNull()).select(F.struct(*body, FROM).alias("old"))
    fresh = incoming.select(F.struct(*body).alias("new"))
    same_key = reduce(
        lambda a, b: a & b, (F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys)
    )
    differs = reduce(
        lambda a, b: a | b, (~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_cols)
    )
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = has_old & has_new & differs
    old_row = F.when(
        has_old, row("old", F.col(f"old.{FROM}"), F.when(changed, moment))
    )
    new_row = F.when(changed | ~has_old, row("new", moment, F.lit(None)))
    moved = (
        still_open.join(fresh, same_key, "full_outer")
        .select(F.filter(F.array(old_row, new_row), lambda r: r.isNotNull()).alias("__rows"))
        .select(F.inline("__rows"))
    )
    closed = hist.filter(F.col(TO).isNotNull())
    return closed.select(*body, FROM, TO).unionByName(moved)


def from_changes(
    changes: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str] = (), **slicing
) -> DataFrame:
    """History from a change log: each row is valid until the key's next row."""
    following = with_next(changes, keys, ts, [ts], tie_break, **slicing)
    return following.withColumnsRenamed({ts: FROM, f"next_{ts}": TO})


def as_dimension(hist: DataFrame) -> DataFrame:
    """Close open intervals at 9999-12-31 and flag the current row."""
    kind = hist.schema[TO].dataType.simpleString()
    return hist.select(
        *(c for c in hist.columns if c != TO),
        F.coalesce(F.col(TO), F.lit(FAR_FUTURE).cast(kind)).alias(TO),
        F.col(TO).isNull().alias("is_current_record"),
    )


def with_version_id(hist: DataFrame, keys: Sequence[str], name: str = "version_id") -> DataFrame:
    """Stable id of one version of a key."""
    return hist.select(surrogate_key(*keys, FROM).alias(name), *hist.columns)


# Facts and versions of one key within so many seconds are one group of a window.
AS_OF_SECONDS = 86_400


def join_as_of(
    fact: DataFrame,
    hist: DataFrame,
    keys: Sequence[str],
    ts: str,
    closed: str = "left",
    how: str = "inner",
    versions_per_slice: int | str | None = 64,
    slice_seconds: int = AS_OF_SECONDS,
) -> DataFrame:
    """Each fact row with the versions of its key valid at ``ts``.

    ``closed="left"`` takes ``[valid_from, valid_to)``, one version per instant of a gapless
    history; ``"both"`` takes BETWEEN, which gives two rows on the very instant of a change.
    A NULL ``valid_to`` is open.

    An equi-join on the key with the range as a residual would compare every fact of a key
    with all its versions. Keys with more than ``versions_per_slice`` versions are therefore
    cut into time slices that become part of the join key; a version is copied only into the
    slices it overlaps. Which side is broadcast is left to the measured sizes, and a
    fact-heavy key is split by the adaptive skew join. ``None`` never cuts.

    ``versions_per_slice="carry"`` is for keys with very many facts and versions: both are one
    stream, sorted by time in each key and slice of ``slice_seconds``, in which the last
    version is carried along, so no fact is compared with a version it does not meet. Over
    the edges of slices the version is carried once for each slice in use. A version that runs
    past the start of the key's next one cannot be carried: it is handed to all slices it
    overlaps, up to the last one in use. It sorts all facts and has more stages, so it is the
    slower way for keys with few versions. The slices only deal out the work. For joins other
    than inner and left, ``"carry"`` is the equi-join on the key.
    """
    if closed not in ("left", "both"):
        raise ValueError("closed must be 'left' or 'both'")
    if versions_per_slice == "carry" and how in ("inner", "left"):
        return _by_carry(fact, hist, keys, ts, closed == "both", how, slice_seconds)
    cut = None if versions_per_slice == "carry" else versions_per_slice
    return _by_key(fact, hist, keys, ts, closed, how, cut)


def _by_carry(
    fact: DataFrame,
    hist: DataFrame,
    keys: Sequence[str],
    ts: str,
    both: bool,
    how: str,
    slice_seconds: int,
) -> DataFrame:
    named = [f"__k{i}" for i in range(len(keys))]
    group = [*named, "__slice"]
    at, until = F.col("__at"), F.col("__to")
    keyed = [F.col(k).alias(n) for k, n in zip(keys, named, strict=True)]
    has_key = reduce(lambda a, b: a & b, (F.col(n).isNotNull() for n in named))
    slice_ = F.floor(F.col("__at") / F.lit(slice_seconds * 1_000_000))

    # versions that can hold at some instant, and where the key's next one starts
    versions = hist.select(
        *keyed,
        F.col(FROM).alias("__from"),
        epoch_micros(FROM).alias("__at"),
        epoch_micros(TO).alias("__to"),
        F.struct(*(c for c in hist.columns if c not in keys)).alias("__body"),
    ).filter(has_key & at.isNotNull() & (until.isNull() | (at <= until if both else at < until)))
    versions = with_next(
        versions, named, "__from", ["__at"], ["__to"], slice_seconds=slice_seconds
    )
    runs_past = F.col("next___at").isNotNull() & (
        until.isNull() | (until > F.col("next___at")) | (at == until) & (until == F.col("next___at"))
    )
    versions = versions.select(
        *named, "__at", "__to", F.struct("__at", "__to", "__body").alias("__v"),
        runs_past.alias("__past"),
    )
    plain, past = versions.filter("NOT __past"), versions.filter("__past")

    # facts without key or time meet nothing; their slices only spread them
    rows = fact.select(*keyed, epoch_micros(ts).alias("__at"), F.struct("*").alias("__f"))
    placed = F.when(has_key & at.isNotNull(), slice_).otherwise(F.xxhash64("__f"))
    rows = rows.select("*", placed.alias("__slice"), F.lit(2).alias("__kind"))
    stream = rows.unionByName(
        plain.select(*named, "__at", "__v", slice_.alias("__slice"), F.lit(1).alias("__kind")),
        allowMissingColumns=True,
    )
    if both:
        ends = plain.filter(until.isNotNull()).select(
            *named, until.alias("__at"), F.col("__v").alias("__e"), F.lit(0).alias("__kind")
        )
        stream = stream.unionByName(
            ends.withColumn("__slice", slice_), allowMissingColumns=True
        )
    in_slice = Window.partitionBy(*group).orderBy("__at", "__kind")
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = ["__v", "__e"] if both else ["__v"]
    seen = [F.last(c, ignorenulls=True).over(so_far).alias(f"{c}_seen") for c in held]
    is_last = F.lead("__kind").over(in_slice).isNull()
    walked = stream.select(*group, "__at", "__kind", "__f", *seen, is_last.alias("__last"))
    walked = walked.withColumnsRenamed({f"{c}_seen": c for c in held})
    met = walked.filter("__kind = 2").drop("__kind", "__last")

    # the version in force when a slice begins
    edges = walked.filter(F.col("__last") & has_key & at.isNotNull()).select(*group, "__v")
    earlier = Window.partitionBy(*named).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        *group, F.last("__v", ignorenulls=True).over(earlier).alias("__before")
    ).filter("__before IS NOT NULL")

    # versions that overlap others, in every slice they reach up to the last one in use
    final = edges.agg(F.max("__slice").alias("__final"))
    reach = F.least(
        F.coalesce(F.floor(until / F.lit(slice_seconds * 1_000_000)), F.col("__final")),
        F.col("__final"),
    )
    copies = (
        past.crossJoin(F.broadcast(final))  # one row
        .filter(slice_ <= reach)
        .select(*named, F.explode(F.sequence(slice_, reach)).alias("__slice"), "__v")
    )
    copies = copies.groupBy(*group).agg(F.collect_list("__v").alias("__others"))

    joined = met.join(carried, group, "left").join(copies, group, "left")
    current = F.coalesce("__v", "__before")
    before_end = lambda v: v["__to"].isNull() | (
        (at <= v["__to"]) if both else (at < v["__to"])
    )
    none = F.array().cast(f"array<{met.schema['__v'].dataType.simpleString()}>")
    others = F.filter("__others", lambda v: (v["__at"] <= at) & before_end(v))
    found = [
        F.filter(F.array(current), lambda v: v.isNotNull() & before_end(v)),
        F.coalesce(others, none),
    ]
    if both:
        ended = (F.col("__e.__to") == at) & (F.col("__v.__at") == at)
        found.append(F.when(ended, F.array("__e")).otherwise(none))
    explode = F.explode_outer if how == "left" else F.explode
    return joined.select("__f", explode(F.concat(*found)).alias("__v")).select(
        "__f.*", "__v.__body.*"
    )


def _by_key(
    fact: DataFrame,
    hist: DataFrame,
    keys: Sequence[str],
    ts: str,
    closed: str,
    how: str,
    versions_per_slice: int | None,
) -> DataFrame:
    versions = hist.select(
        *(F.col(k).alias(f"__h_{k}") for k in keys),
        *(c for c in hist.columns if c not in keys),
    )
    left, right = fact, versions
    match = [F.col(k) == F.col(f"__h_{k}") for k in keys]
    if versions_per_slice is not None:
        large = large_keys(hist, keys, FROM, versions_per_slice)
        left = with_grid(fact, keys, large).select(*fact.columns, slice_of(ts).alias("__at"))
        until = F.coalesce(slice_of(TO), F.col("__last"), F.lit(0))
        since = slice_of(FROM)
        right = with_grid(versions, [f"__h_{k}" for k in keys], large).select(
            *versions.columns,
            F.explode(F.sequence(since, F.greatest(since, until))).alias("__in"),
        )
        match.append(F.col("__at") == F.col("__in"))
    before_end = F.col(ts) < F.col(TO) if closed == "left" else F.col(ts) <= F.col(TO)
    match += [F.col(FROM) <= F.col(ts), F.col(TO).isNull() | before_end]
    joined = left.join(right, match, how)
    return joined.drop("__at", "__in", *(f"__h_{k}" for k in keys))
