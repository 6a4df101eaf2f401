"""Mix sources to target weights by systematic sampling.

Sources in code point order, null last, weigh 5, 2, 1 in turn and share 150 % of all words.
A target stops at twice its source's words; what is over is shared again by weight until no
target is above its bound. Every document of a source expects target / source words copies.
The documents of a source stand in order of size, then of a hash of their id; their expected
copies are summed along that order, a fixed offset of the source in [0, 1) is added, and a
document is taken once for each integer that its own step crosses. Neighbours have nearly
equal sizes, so the words taken stay near the target.

The sum is distributed: places are counted per (source, size), large sizes are cut into
ranges of the hash, and only within such a range are rows numbered. No source, size or copy
group is held by one task.

Defined cases: a null or empty text has size 0 and takes 0 words (it may be emitted); a null
source is a source of its own; rows of equal doc_id and size stand next to each other, in
arbitrary but harmless order, as they are alike. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart import runtime

WEIGHTS = (5, 2, 1)
#: Rows of one size are cut into hash ranges of about this many.
RANGE_ROWS = 512
_ADDED = ["size", "source_size", "target", "copies", "taken"]


def words_in(text: str) -> Column:
    """Number of runs of characters other than blank and the controls 9 to 13; null: 0."""
    count = F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+"))
    return F.coalesce(count, F.lit(0)).cast("bigint")


def _fraction(text: Column) -> Column:
    """28 bits of a digest, as an integer."""
    digits = F.substring(F.md5(text), 1, 7)
    return F.conv(digits, 16, 10).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, words); one row per source throughout.

    The bound is reached first where source words per weight are smallest. ``level`` is the
    words a unit of weight gets once all sources before are at their bound; the first source
    that stays within its bound sets it for all after.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn % len(WEIGHTS) + 1).cast("int"))
    per_source = (
        sizes.groupBy("source")
        .agg(F.sum("words").cast("bigint").alias("source_size"))
        .withColumn("weight", weight.cast("bigint"))
    )
    order = W.orderBy(
        F.col("source_size").cast("double") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    upto = order.rowsBetween(W.unboundedPreceding, -1)
    onwards = order.rowsBetween(0, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).partitionBy()
    left = (
        3 * F.sum("source_size").over(whole)
        - 4 * F.coalesce(F.sum("source_size").over(upto), F.lit(0))
    ).cast("double")
    level = left / (2 * F.sum("weight").over(onwards)).cast("double")
    nth = F.row_number().over(order)
    ranked = per_source.withColumns({"level": level, "nth": nth})
    within = F.col("level") * F.col("weight") <= 2 * F.col("source_size")
    first = F.min(F.when(within, F.struct("nth", "level"))).over(whole)
    return ranked.withColumn("first", first).select(
        "source",
        "source_size",
        F.when(F.col("nth") < F.col("first.nth"), (2 * F.col("source_size")).cast("double"))
        .otherwise(F.col("first.level") * F.col("weight"))
        .alias("target"),
    )


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (copies * size).

    Columns of ``docs`` with these names are replaced.
    """
    docs = docs.drop(*_ADDED)
    key = {
        "__unknown": F.col(source).isNull(),
        "__source": F.coalesce(F.col(source), F.lit("")),
        "size": words_in(text),
        "__hash": _fraction(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))),
    }
    by = ["__unknown", "__source", "size"]
    keyed = docs.withColumns(key)
    counted = runtime.written(keyed.groupBy(by).agg(F.count("*").alias("rows")), "mix-sizes")
    shares = targets(
        counted.select(
            F.when(~F.col("__unknown"), F.col("__source")).alias("source"),
            (F.col("size") * F.col("rows")).alias("words"),
        )
    ).select(
        F.col("source").isNull().alias("__unknown"),
        F.coalesce("source", F.lit("")).alias("__source"),
        "source_size",
        "target",
    )
    below = W.partitionBy("__unknown", "__source").orderBy("size")
    places = runtime.written(
        counted.withColumns(
            {
                "__before": F.sum("rows").over(below) - F.col("rows"),
                "__ranges": F.ceil(F.col("rows") / F.lit(RANGE_ROWS)).cast("bigint"),
            }
        )
        .drop("rows")
        .join(shares, ["__unknown", "__source"]),
        "mix-places",
    )
    part = F.shiftright(F.col("__hash") * F.col("__ranges"), 28)
    placed = keyed.join(places, by).withColumn("__part", part)
    ranges = (
        keyed.select(*by, "__hash")
        .join(places.where("__ranges > 1").select(*by, "__ranges"), by)
        .withColumn("__part", part)
        .groupBy(*by, "__part")
        .agg(F.count("*").alias("n"))
    )
    earlier = W.partitionBy(by).orderBy("__part")
    ranges = ranges.withColumn("__ahead", F.sum("n").over(earlier) - F.col("n")).drop("n")
    ranges = runtime.written(ranges, "mix-ranges")
    numbered = placed.join(ranges, [*by, "__part"], "left").withColumn(
        "__nth",
        F.row_number().over(
            W.partitionBy(*by, "__part").orderBy("__hash", F.col(doc_id).asc_nulls_first())
        )
        + F.col("__before")
        + F.coalesce("__ahead", F.lit(0)),
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _fraction(F.concat(F.lit("mix:"), "__source")).cast("double") / F.lit(float(1 << 28))
    crossed = F.floor(F.col("__nth") * rate + offset) - F.floor(
        (F.col("__nth") - 1) * rate + offset
    )
    copies = F.least(crossed, F.lit(2)).cast("bigint")
    return numbered.withColumn("copies", copies).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def emit(docs: DataFrame, **columns: str) -> DataFrame:
    """``docs``, each row as many times as it is taken; columns are unchanged."""
    times = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    mixed = mix(docs, **columns).withColumn("__copy", times)
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])
