"""Repeated passages of lines, in DataFrame functions only.

Every run of three consecutive lines is a window. The first place of a window, in order of
(doc_id, position), keeps it; all later places lose it. The lines of a text covered by its
later windows are merged and removed, the rest joined again by line feeds.

Defined cases: a null text stays null; a text of fewer than three lines and a window without
any word are left alone; rows with equal (doc_id, text) are one document and get the same
result; a row with a null doc_id comes after all others as one more document; extra columns
pass through unchanged, but for those named like added columns, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import runtime

WINDOW = 3
#: A window that blank and control characters 9 to 13 alone make up is not content.
_HAS_WORD = "[^\\x20\\x09-\\x0D]"


def _windows(lines: str) -> Column:
    """One struct (position, two independent 64-bit hashes) for each window with a word."""
    line = F.col(lines)
    starts = F.when(
        F.size(line) >= WINDOW, F.sequence(F.lit(0), F.size(line) - WINDOW)
    ).otherwise(F.array().cast("array<int>"))
    parts = lambda i: [F.get(line, i + k) for k in range(WINDOW)]
    all_ = F.transform(
        starts,
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(*parts(i)).alias("h1"),
            F.xxhash64(F.lit(WINDOW), *parts(i)).alias("h2"),
            F.concat(*parts(i)).rlike(_HAS_WORD).alias("worded"),
        ),
    )
    return F.filter(all_, lambda w: w["worded"])


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with its ``text`` shortened, and n_lines and n_removed (bigint).

    Repeated windows are counted with partial aggregates, so a passage that many documents
    share meets its first place as one row per task. They are then written to the shared
    folder, which lets the join with all windows split a hot window over tasks. Both joins
    are sort-merge joins at every size of the tables, and texts of fewer than three lines,
    which can lose nothing, go around the second one.
    """
    docs = docs.drop("n_lines", "n_removed")
    key = {"__null": F.col(doc_id).isNull(), "__id": F.col(doc_id), "__text": F.xxhash64(text)}
    keyed = docs.withColumns(key)
    lined = keyed.where(F.col(text).contains("\n")).select(
        *key, F.split(text, "\n", -1).alias("lines")
    )
    places = lined.select(*key, F.explode(_windows("lines")).alias("w")).select(
        *key, "w.pos", "w.h1", "w.h2"
    )
    place = F.struct(*key, "pos")
    repeated = (
        places.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first != last")
        .select("h1", "h2", "first")
    )
    repeated = runtime.written(repeated, "line-windows")
    later = (
        places.join(repeated.hint("merge"), ["h1", "h2"])
        .where(place != F.col("first"))
        .groupBy(*key)
        .agg(F.collect_set("pos").alias("later"))
    )
    later = runtime.written(later, "line-places")
    same = [
        F.col("d.__null") == F.col("r.__null"),
        F.col("d.__id").eqNullSafe(F.col("r.__id")),
        F.col("d.__text") == F.col("r.__text"),
    ]
    long = F.coalesce(F.regexp_count(text, F.lit("\n")) >= WINDOW - 1, F.lit(False))
    joined = keyed.where(long).alias("d").join(later.hint("merge").alias("r"), same, "left")
    covered = F.array_distinct(
        F.flatten(F.transform("r.later", lambda p: F.array(*[p + k for k in range(WINDOW)])))
    )
    lines = F.split(F.col(f"d.{text}"), "\n", -1)
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    shorter = F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n")
    shortened = joined.select(
        *[
            F.when(F.col("r.later").isNull(), F.col(f"d.{text}")).otherwise(shorter).alias(c)
            if c == text
            else F.col(f"d.`{c}`")
            for c in docs.columns
        ],
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(covered), F.lit(0)).cast("bigint").alias("n_removed"),
    )
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(text, F.lit("\n")) + 1)
    short = docs.where(~long).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n_lines.cast("bigint").alias("n_lines"),
        F.lit(0).cast("bigint").alias("n_removed"),
    )
    return shortened.unionAll(short)
