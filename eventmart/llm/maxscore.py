"""Exact top-k search by inner product, with MaxScore over shards.

Components are whole numbers; a dimension is a term, and its column in a shard is the posting
list of that term. For a query every term has a bound, the most it can add to the score of any
row of a block. Terms in order of their bounds split in two: the non-essential ones, whose
bounds together cannot lift a row to the current k-th best score by themselves, and the rest.
Postings of essential terms are traversed for all rows of the block. A row stays competitive
while its partial score and the bounds of the terms not yet read reach the k-th best score;
competitive rows are probed in the remaining terms, largest bound first. Shards are worked by
separate tasks and their best rows merged.

Rows with equal vectors and length collapse to one entry with its ``k + 1`` smallest ids:
these rows tie, so the others cannot be among the best of any query. The k-th best score
against a bounded sample of entries is where each query's threshold starts; it decides speed,
not results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.llm.vectors import matrix, scaled, usable

SCALE = 256
#: Entries of a shard; all queries pass every shard, in as many groups.
SHARD, GROUPS = 1 << 18, 4
#: Rows of a shard with bounds of their own, and terms probed between two tests.
BLOCK, PROBE = 4096, 8
#: Entries whose scores set the first thresholds.
SAMPLE = 512


class Shard:
    """Entries in blocks: posting lists by term, the bounds of each, and ids by entry."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, owner: np.ndarray):
        self.ids, self.largest = ids, int(np.abs(x).max(initial=0))
        # below this size whole numbers are exact in doubles
        kind = np.float64 if self.largest < 1 << 53 else object
        first = np.searchsorted(owner, np.arange(len(x) + 1))
        self.blocks = []
        for a in range(0, len(x), BLOCK):
            part = np.asfortranarray(x[a : a + BLOCK].astype(kind))
            bounds = part.min(axis=0), part.max(axis=0)
            self.blocks.append((part, *bounds, first[a : a + len(part) + 1]))

    def best(self, query: np.ndarray, own: int, k: int, least) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) but for id ``own``; scores below ``least`` may lack."""
        reach = int(np.abs(query).max(initial=0)) * self.largest * len(query)
        kind = np.float64 if reach < 1 << 53 else object
        query = query.astype(kind)
        top: list[tuple[int, int]] = []
        for postings, low, high, first in self.blocks:
            if kind is object:
                postings, low, high = (c.astype(np.int64).astype(object) for c in (postings, low, high))
            bound = np.maximum(query * low, query * high)
            order = np.argsort(-bound, kind="stable")
            # the most that the terms from each place on can add
            rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)
            short = rest < least if least is not None else np.zeros(1, bool)
            # essential: all terms before the longest tail that stays below the threshold
            done = max(int(short.argmax()), 1) if short.any() else len(order)
            score = postings[:, order[:done]] @ query[order[:done]]
            at = np.arange(len(score))
            while least is not None:
                alive = score + rest[done] >= least
                if not alive.all():
                    at, score = at[alive], score[alive]
                if done == len(order) or not len(at):
                    break
                terms = order[done : done + PROBE]
                score = score + postings[np.ix_(at, terms)] @ query[terms]
                done += len(terms)
            if len(at) > k + 1:
                # an entry has an id or more, and one of all ids is left out
                cut = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                at, score = at[score >= cut], score[score >= cut]
            for entry, value in zip(at.tolist(), score.tolist(), strict=True):
                members = self.ids[first[entry] : first[entry + 1]].tolist()
                top += [(int(value), i) for i in members if i != own]
            top = sorted(set(top), key=lambda t: (-t[0], t[1]))[:k]
            if len(top) == k and (least is None or top[-1][0] > least):
                least = top[-1][0]
        return top


def _entries(rows: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, and ids with the entry each belongs to."""
    held = rows.column("ids").combine_chunks()
    owner = np.repeat(np.arange(len(held)), held.value_lengths().to_numpy(zero_copy_only=False))
    x = matrix(rows.column("x").combine_chunks(), dims)
    return x, held.flatten().to_numpy(zero_copy_only=False), owner


def _searched(k: int):
    """Best rows of each query in each shard; rows come sorted by shard, entries first."""

    def run(batches):
        key, shard, held = None, None, []
        for batch in batches:
            names = ("dims", "shard", "part")
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            entry = batch.column("query_id").is_null().to_numpy(zero_copy_only=False)
            new = np.any(np.diff(keys, axis=1) != 0, axis=0) | (entry[1:] != entry[:-1])
            edges = np.r_[0, np.flatnonzero(new) + 1, batch.num_rows]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if a == b:
                    continue
                now = tuple(keys[:, a].tolist())
                part = batch.slice(a, b - a)
                if now != key:
                    key, shard, held = now, None, []
                if entry[a]:
                    held.append(part)
                    continue
                if shard is None:
                    shard = Shard(*_entries(pa.Table.from_batches(held), now[0])) if held else ()
                    held = []
                if not shard:
                    continue
                out = []
                x = matrix(part.column("x"), now[0])
                ids, floors = (part.column(c).to_pylist() for c in ("query_id", "least"))
                for q, own, least in zip(x, ids, floors, strict=True):
                    out += [(own, i, s) for s, i in shard.best(q, own, k, least)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array([r[0] for r in out], pa.int64()),
                        "vec_id": pa.array([r[1] for r in out], pa.int64()),
                        "score": pa.array([r[2] for r in out], pa.int64()),
                    }
                )

    return run


def _thresholds(samples: dict[int, Shard], k: int):
    """Queries with the k-th best score that the sample alone gives them."""

    def run(batches):
        for batch in batches:
            least = []
            rows = zip(batch.column("x").to_pylist(), batch.column("query_id").to_pylist(), strict=True)
            for x, own in rows:
                sample = samples.get(len(x))
                best = sample.best(np.array(x, np.int64), own, k, None) if sample else ()
                least.append(best[-1][0] if len(best) == k else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least, pa.int64())], [*batch.schema.names, "least"]
            )

    return run


def search(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row whose id is divisible
    by ``every``, by falling inner product of floor(``scale`` * component), then by id.

    A query is searched against all rows but those of its own id; it has fewer than ``k`` rows
    where fewer exist. Vectors that are null, or hold a null, NaN or infinite component, and
    rows with a null id, take no part. Vectors meet only those of their own length. A repeated
    row (equal id and vector) counts once. Rows of one id with different vectors are rows on
    their own, and as queries are one query whose best rows are taken over all of them, each
    found row once with its best score. An empty table gives no rows; columns other than the
    two named are not read. Scores must fit 64 bits.
    """
    rows = vectors.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), scaled(vector, scale).alias("x")
    )
    rows = rows.withColumn("dims", F.size("x"))
    same = W.partitionBy("dims", "x").orderBy("vec_id")
    entries = runtime.written(
        rows.distinct()
        .withColumn("nth", F.row_number().over(same))
        .where(F.col("nth") <= k + 1)
        .groupBy("dims", "x")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("hash", F.xxhash64("x")),
        "maxscore-entries",
    )
    sizes = entries.groupBy("dims").agg(
        F.ceil(F.count("*") / F.lit(SHARD)).cast("int").alias("shards")
    )
    sizes = runtime.written(sizes, "maxscore-sizes")
    sample = entries.orderBy("hash", "x").limit(SAMPLE).toArrow()
    samples = {}
    lengths = sample.column("dims").to_numpy()
    for dims in np.unique(lengths):
        some = sample.take(pa.array(np.flatnonzero(lengths == dims)))
        samples[int(dims)] = Shard(*_entries(some, int(dims)))
    queries = (
        rows.where(F.col("vec_id") % every == 0)
        .distinct()
        .select(F.col("vec_id").alias("query_id"), "dims", "x")
        .mapInArrow(
            _thresholds(samples, k),
            "query_id bigint, dims int, x array<bigint>, least bigint",
        )
        .join(sizes, "dims")
        .withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(GROUPS)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .withColumn("ids", F.lit(None).cast("array<bigint>"))
    )
    shards = (
        entries.join(sizes, "dims")
        .withColumn("shard", F.pmod("hash", F.col("shards")).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))))
        .withColumns({"query_id": F.lit(None).cast("bigint"), "least": F.lit(None).cast("bigint")})
    )
    columns = ["dims", "shard", "part", "query_id", "least", "x", "ids"]
    found = (
        shards.select(*columns)
        .unionByName(queries.select(*columns))
        .repartition("dims", "shard", "part")
        .sortWithinPartitions("dims", "shard", "part", F.col("query_id").asc_nulls_first(), "ids")
        .mapInArrow(_searched(k), "query_id bigint, vec_id bigint, score bigint")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
