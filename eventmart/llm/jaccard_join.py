"""Exact Jaccard join of documents on word shingles.

Documents with equal shingle sets collapse to one representative. Each representative sends
the first fifth of its shingles (a prefix under one global order, rare shingles first) to
tiles: runs of documents that share a shingle, sorted by set size, cut wherever sizes can no
longer reach the threshold. In a tile a pair is tried against hashed bitmap signatures: with
``x`` differing bits at least ``x`` elements differ, so the overlap is at most
``(|A| + |B| - x) / 2``. Pairs within the bound are compared by exact intersection of their
sorted shingle arrays.

Tiles are worked in two rounds, so that a group of near copies does not emit all its pairs.
First every member is tried against the smallest of its tile. Pairs of different components
that share a tile of three or more follow: tiles with one smallest id are joined to a unit,
and units of many documents are dealt to several tasks block by block. A block first names
only the nearest candidate of each document, one for a pair of components: within the parts
of a unit, then across them. What these links leave in different components is then tried
pair by pair. Every pair that reaches the threshold ends in one component either way.

The rare-first order comes from document counts of all shingles. Only its most frequent
``MAX_COMMON`` shingles are handed to tasks; any order gives the same links, so this bound
limits the broadcast and not the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.llm.components import connected_components
from eventmart.llm.textops import Texts, chunks, per_chunk, shingles

PERCENT = 80
#: A shingle in at least so many documents is common; at most so many of them are broadcast.
COMMON, MAX_COMMON = 24, 1_000_000
#: Shingles counted together before they are shuffled, and per group after.
COUNT_BATCH, COUNT_GROUP = 1_000_000, 1_000_000
#: Texts reach Python in batches of at most so many rows and bytes. What a table was shuffled
#: by goes once it is written; else it stays until the driver happens to collect its garbage.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
#: Rows of one tile held at once, rows of a block, and rows of a unit on a side of one task.
HELD, BLOCK, DEALT = 100_000, 512, 512


def _needed(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of size n with any partner."""
    return (PERCENT * n + 99) // 100


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    """Bits at hashed places, packed: a power of two, at least four for each element."""
    width = 1 << max(6, int(4 * len(hashes) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(hashes >> np.uint64(20)) & np.uint64(width - 1)] = True
    return np.packbits(bits, bitorder="little")


def overlap_bound(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """Most elements that sets of these bitmaps and sizes can share."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    y = np.bitwise_or.reduce(y.reshape(-1, len(x)), axis=0)
    return (n_a + n_b - int(np.bitwise_count(x ^ y).sum())) // 2


def _signatures(batch: pa.RecordBatch, n: int) -> pa.RecordBatch:
    sets = shingles(Texts(batch.column("text"), lower=True), n)
    odd = np.uint64(0x9FB21C651E98DF25)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column("doc_id"),
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "f1": np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
            "f2": np.array(
                [np.bitwise_xor.reduce((s ^ (s >> np.uint64(29))) * odd) for s in sets], np.uint64
            ).view(np.int64),
            "bitmap": pa.array([_bitmap(s).tobytes() for s in sets], pa.binary()),
        }
    )


def _counted(n: int, groups: int, bits: int):
    """Shingle counts of a task, as sorted keys and counts per range of keys."""
    low = -(-(1 << bits) // groups)

    def pack(held: list[np.ndarray]):
        keys = np.concatenate(held) >> np.uint64(64 - bits)
        keys, times = np.unique(keys, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(1, groups, dtype=object) * low)
        ranges = [(a, b) for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True)]
        some = [(g, a, b) for g, (a, b) in enumerate(ranges) if b > a]
        # steps between neighbours are small numbers; their byte planes compress well
        planes = [np.diff(keys[a:b], prepend=np.uint64(g * low)) for g, a, b in some]
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array([g for g, _, _ in some], pa.int32()),
                "keys": pa.array(
                    [p.view(np.uint8).reshape(-1, 8).T.tobytes() for p in planes], pa.binary()
                ),
                "times": pa.array(
                    [
                        times[a:b].astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
                        for _, a, b in some
                    ],
                    pa.binary(),
                ),
            }
        )

    def run(batches):
        held, size = [], 0
        for batch in chunks(batches, "text"):
            for s in shingles(Texts(batch.column("text"), lower=True), n):
                held.append(s)
                size += len(s)
            if size >= COUNT_BATCH:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    return run


def _summed(groups: int, bits: int):
    """Common keys of each range; rows come sorted by range."""
    low = -(-(1 << bits) // groups)

    def merge(part, held):
        keys = np.concatenate([k for k, _ in held])
        times = np.concatenate([t for _, t in held])
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        total = np.add.reduceat(times, first)
        some = total >= COMMON
        return pa.RecordBatch.from_pydict(
            {"key": keys[first][some].view(np.int64), "df": total[some].astype(np.int64)}
        )

    def run(batches):
        part, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part and held:
                    yield merge(part, held)
                    held = []
                part = row["part"]
                steps = np.frombuffer(row["keys"], np.uint8).reshape(8, -1).T
                keys = np.cumsum(np.ascontiguousarray(steps).view(np.uint64)[:, 0])
                times = np.frombuffer(row["times"], np.uint8).reshape(4, -1).T
                held.append(
                    (
                        keys + np.uint64(part * low),
                        np.ascontiguousarray(times).view(np.uint32)[:, 0].astype(np.int64),
                    )
                )
        if held:
            yield merge(part, held)

    return run


def key_bits(total: int) -> int:
    """Leading bits of a shingle's hash that count it: ten more than number all shingles.

    Two shingles that share a key only share a place in the order.
    """
    return min(62, max(24, int(total).bit_length() + 10))


def common_shingles(docs: DataFrame, n: int, total: int) -> DataFrame:
    """(key, df) of the keys of at least ``COMMON`` documents; ``total`` sizes the tasks."""
    groups, bits = max(16, total // COUNT_GROUP), key_bits(total)
    counts = docs.select("text").mapInArrow(
        _counted(n, groups, bits), "part int, keys binary, times binary"
    )
    return (
        counts.repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(_summed(groups, bits), "key bigint, df bigint")
    )


def _prefixes(n: int, common, bits: int):
    """(shingle, doc_id, n) for the prefix of each document under the rare-first order."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        frequent = common.value
        out, sizes = [], []
        for s in shingles(Texts(batch.column("text"), lower=True), n):
            p = len(s) - int(_needed(len(s))) + 1 if len(s) else 0
            if len(frequent) and p:
                key = s >> np.uint64(64 - bits)
                at = np.searchsorted(frequent["key"], key)
                at[at == len(frequent)] = 0
                hit = frequent["key"][at] == key
                if hit.any():
                    late = s[hit][np.argsort(frequent["rank"][at[hit]])]
                    s = np.concatenate([s[~hit], late])
            out.append(s[:p])
            sizes.append((p, len(s)))
        lengths = np.array([p for p, _ in sizes], np.int64)
        docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_pydict(
            {
                "shingle": np.concatenate([*out, np.empty(0, np.uint64)]).view(np.int64),
                "doc_id": np.repeat(docs, lengths).astype(np.int64),
                "n": np.repeat(np.array([m for _, m in sizes], np.int32), lengths),
            }
        )

    return per_chunk(run, "text")


def _tiles(batches):
    """Leader links (kind 0: leader, member) and rows of tiles of three or more (kind 1).

    Rows come sorted by shingle, size and id. A run that goes past a batch is carried on; of
    a very long one only the current leader is, and all its rows are of kind 1, however few
    of them are left after that.
    """

    def work(shingle, n, doc, whole, carried):
        start = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        length = np.diff(np.r_[start, len(shingle)])
        run_length = np.repeat(length, length)
        lead = np.repeat(start, length)
        for _ in range(len(n)):
            bad = 100 * n[lead].astype(np.int64) < PERCENT * n.astype(np.int64)
            if not bad.any():
                break
            at = np.flatnonzero(bad)
            fresh = at[np.r_[True, lead[at][1:] != lead[at][:-1]]]
            segment = np.searchsorted(fresh, at, "right") - 1
            lead[at] = fresh[segment]
        member = np.flatnonzero(lead != np.arange(len(lead)))
        pairs = np.unique(np.stack([doc[lead[member]], doc[member]], 1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        # the rows before a carried leader are out already
        open_ = (run_length >= 3) | (carried & (shingle == shingle[0]))
        many = np.flatnonzero(open_) if whole else np.arange(len(lead))
        last_lead = lead[-1]
        return last_lead, pa.RecordBatch.from_pydict(
            {
                "kind": np.r_[np.zeros(len(pairs), np.int8), np.ones(len(many), np.int8)],
                "x": np.r_[pairs[:, 0], shingle[many]],
                "y": np.r_[pairs[:, 1], doc[many]],
                "n": np.r_[np.zeros(len(pairs), np.int32), n[many]],
            }
        )

    held, carried = None, False
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in ("shingle", "n", "doc_id")]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        shingle = rows[0]
        if not len(shingle):
            continue
        cut = int(np.searchsorted(shingle, shingle[-1], "left"))
        if cut:
            # rows before the last run are whole runs
            yield work(*(r[:cut] for r in rows), whole=True, carried=carried)[1]
            carried = False
        held = [r[cut:] for r in rows]
        if len(held[0]) > HELD:
            lead, out = work(*held, whole=False, carried=carried)
            yield out
            held, carried = [r[lead : lead + 1] for r in held], True
    if held is not None and len(held[0]):
        yield work(*held, whole=True, carried=carried)[1]


def _blocks(nearest: bool):
    """Pairs of different components within the bitmap bound, unit by unit.

    Rows come sorted by (unit, g1, g2), size and id. These are at most about ``2 * DEALT``;
    larger units were dealt by ``side``. With ``nearest``, a block gives for each document
    the partner before it with fewest differing bits, and one such pair for two components.
    """

    def folded(bits, width):
        return np.bitwise_or.reduce(bits.reshape(len(bits), -1, width), axis=1)

    def refined(x, y, at_i, at_j):
        """Differing bits of some pairs; so many at once that they take a few MB."""
        step = max(1, (1 << 19) // x.shape[1])
        parts = [
            np.bitwise_count(x[at_i[k : k + step]] ^ y[at_j[k : k + step]]).sum(1, np.int64)
            for k in range(0, len(at_i), step)
        ]
        return np.concatenate([np.empty(0, np.int64), *parts])

    def blocks_of(rows):
        """Rows and bitmaps of each block. All of a block are of one width: a bitmap folded
        to the width of a much smaller set is full, and bounds nothing."""
        width = np.array([len(r["bitmap"]) // 8 for r in rows])
        runs = [0, *(np.flatnonzero(width[1:] != width[:-1]) + 1), len(rows)]
        for start, end in zip(runs, runs[1:], strict=False):
            for a in range(start, end, BLOCK):
                some = rows[a : min(a + BLOCK, end)]
                bits = np.frombuffer(b"".join(r["bitmap"] for r in some), np.uint64)
                yield slice(a, a + len(some)), bits.reshape(len(some), -1)

    def pairs_of(rows):
        n, comp, side, doc = (
            np.array([r[c] for r in rows], np.int64) for c in ("n", "comp", "side", "doc_id")
        )
        crossed = rows[0]["g1"] != rows[0]["g2"]
        blocks = list(blocks_of(rows))
        for a, (i, bits_i) in enumerate(blocks):
            for j, bits_j in blocks[a:]:
                if 100 * n[i][-1] < PERCENT * n[j][0]:
                    break  # sizes only grow from here
                ok = (comp[i][:, None] != comp[j][None]) & (
                    100 * n[i][:, None] >= PERCENT * n[j][None]
                )
                if i == j:
                    ok = np.triu(ok, 1)
                if crossed:
                    ok &= side[i][:, None] != side[j][None]
                if not ok.any():
                    continue
                width = min(bits_i.shape[1], bits_j.shape[1])
                x, y = folded(bits_i, width), folded(bits_j, width)
                size = n[i][:, None] + n[j][None]
                # a quarter of the width settles most pairs, the whole of it the others
                coarse = max(1, width // 4)
                u, v = folded(x, coarse), folded(y, coarse)
                differ = np.zeros(ok.shape, np.int64)
                for k in range(coarse):
                    differ += np.bitwise_count(u[:, k][:, None] ^ v[:, k][None])
                ok &= (100 + PERCENT) * ((size - differ) // 2) >= PERCENT * size
                at = np.nonzero(ok)
                differ[at] = refined(x, y, *at)
                ok &= (100 + PERCENT) * ((size - differ) // 2) >= PERCENT * size
                if nearest:
                    # shares of differing bits order candidates of different sizes
                    share = np.where(ok, differ / size, np.inf)
                    at_j = np.flatnonzero(ok.any(axis=0))
                    at_i = share[:, at_j].argmin(axis=0)
                    rank = np.argsort(share[at_i, at_j], kind="stable")
                    at_i, at_j = at_i[rank], at_j[rank]
                    c, d = comp[i][at_i], comp[j][at_j]
                    ends = np.stack([np.minimum(c, d), np.maximum(c, d)], 1)
                    first = np.unique(ends, axis=0, return_index=True)[1]
                    at_i, at_j = at_i[first], at_j[first]
                else:
                    at_i, at_j = np.nonzero(ok)
                x, y = doc[i][at_i], doc[j][at_j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"]
                )

    def run(batches):
        tile, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["unit"], row["g1"], row["g2"])
                if key != tile and rows:
                    yield from pairs_of(rows)
                    rows = []
                tile = key
                rows.append(row)
        if rows:
            yield from pairs_of(rows)

    return run


def _candidates(units: DataFrame, bits: DataFrame, across: bool, nearest: bool) -> DataFrame:
    """Distinct pairs (a, b) of ``units`` (unit, doc_id, n, comp) by ``_blocks``.

    A unit of more than ``DEALT`` documents is cut into parts; ``across`` compares them with
    each other too.
    """
    sizes = units.groupBy("unit").agg(
        F.ceil(F.count("*") / F.lit(DEALT)).cast("int").alias("k"),
        F.min("comp").alias("lo"),
        F.max("comp").alias("hi"),
    )
    sizes = sizes.where("lo != hi").select("unit", "k")
    dealt = units.join(sizes, "unit").join(bits, "doc_id").select(
        "unit", "doc_id", "n", "comp", "bitmap", "k",
        F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int").alias("side"),
    )
    others = F.sequence(F.lit(0), F.col("k") - 1) if across else F.array("side")
    dealt = dealt.withColumn("other", F.explode(others))
    dealt = dealt.withColumns({"g1": F.least("side", "other"), "g2": F.greatest("side", "other")})
    return (
        dealt.drop("other", "k")
        .repartition("unit", "g1", "g2")
        .sortWithinPartitions("unit", "g1", "g2", "n", "doc_id")
        .mapInArrow(_blocks(nearest), "a bigint, b bigint")
        .distinct()
    )


def _exact(n: int):
    """Pairs (a, b) that reach the threshold; rows come sorted by (a, salt, role)."""

    def run(batches):
        key, leaders = None, []
        for batch in chunks(batches, "text"):
            sets = shingles(Texts(batch.column("text"), lower=True), n)
            a, salt, role, b = (batch.column(c).to_pylist() for c in ("a", "salt", "role", "b"))
            found = []
            for k, mine in enumerate(sets):
                if (a[k], salt[k]) != key:
                    key, leaders = (a[k], salt[k]), []
                if role[k] == 0:
                    leaders.append(mine)
                    continue
                for other in leaders:
                    both = len(np.intersect1d(mine, other, assume_unique=True))
                    if both and 100 * both >= PERCENT * (len(mine) + len(other) - both):
                        found.append((a[k], b[k]))
                        break
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([x for x, _ in found], pa.int64()),
                    "b": pa.array([y for _, y in found], pa.int64()),
                }
            )

    return run


def _texts(docs: DataFrame, *ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents that ``ids`` (doc_id) name, written. The texts meet
    the ids in one kind of join at every size."""
    every = ids[0]
    for more in ids[1:]:
        every = every.union(more)
    kept = docs.join(every.distinct().hint("merge"), "doc_id", "left_semi")
    return runtime.written(kept, "jaccard-texts")


def _verified(pairs: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """Those of the written ``pairs`` (a, b) whose exact Jaccard reaches the threshold, written.

    Each member's text goes once to each of its leaders; a leader of many is salted.
    """
    near = _texts(docs, pairs.select(F.col("a").alias("doc_id")), pairs.select("b"))
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(256)).cast("int").alias("k"))
    salts = runtime.written(salts, "jaccard-salts")
    by_b = near.select(F.col("doc_id").alias("b"), "text")
    members = pairs.join(salts, "a").hint("merge").join(by_b, "b")
    members = members.select(
        "a", F.pmod(F.xxhash64("b"), F.col("k")).cast("int").alias("salt"), F.lit(1).alias("role"),
        "b", "text",
    )
    leaders = salts.hint("merge").join(near.withColumnRenamed("doc_id", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("salt"),
        F.lit(0).alias("role"), F.col("a").alias("b"), "text",
    )
    both = leaders.union(members).repartition("a", "salt")
    sorted_ = both.sortWithinPartitions("a", "salt", "role", "b")
    found = sorted_.mapInArrow(_exact(n), "a bigint, b bigint").distinct()
    found = runtime.written(found, "jaccard-links")
    runtime.released(near, salts)
    return found


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 5
) -> DataFrame:
    """One row (doc_id, n_shingles, component_id) for each row of ``docs``.

    Words are runs other than white space, with A-Z lower-cased; a text of fewer words than
    ``words`` has its whole sequence as one shingle. Texts link when 100 * intersection is at
    least 80 * union. A null or empty text, or one without words, has no shingles and links
    with nothing. Rows that share a doc_id are one document with the links of all of them; a
    row with a null doc_id links with nothing and has a null component_id. Other columns are
    not read.
    """
    with runtime.settings(docs.sparkSession, **SETTINGS):
        return _near_duplicates(docs, text, doc_id, words)


def _near_duplicates(docs: DataFrame, text: str, doc_id: str, words: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sig = runtime.written(
        docs.mapInArrow(
            per_chunk(lambda b: _signatures(b, words), "text"),
            "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, bitmap binary",
        ),
        "jaccard-signatures",
    )
    linked = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
    groups = runtime.written(
        linked.groupBy("n_shingles", "f1", "f2")
        .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
        .where("rep != last")
        .drop("last"),
        "jaccard-copies",
    )
    copies = runtime.written(
        linked.join(groups, ["n_shingles", "f1", "f2"])
        .where("doc_id != rep")
        .select("doc_id", "rep")
        .distinct(),
        "jaccard-copies",
    )
    dropped = copies.select("doc_id").join(
        groups.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_anti"
    )
    # a document of several rows stays while one of them stands for itself
    alone = linked.join(groups, ["n_shingles", "f1", "f2"], "left_anti").select("doc_id")
    dropped = runtime.written(dropped.join(alone, "doc_id", "left_anti"), "jaccard-copies")
    reps = docs.where("doc_id IS NOT NULL").join(dropped, "doc_id", "left_anti")

    total = sig.agg(F.sum("n_shingles")).first()[0] or 0
    common = runtime.written(common_shingles(docs, words, total), "jaccard-common")
    top = common.orderBy(F.desc("df"), "key").limit(MAX_COMMON)
    table = top.toArrow()
    runtime.released(groups, common)
    order = np.argsort(table.column("key").to_numpy().view(np.uint64))
    frequent = np.empty(len(order), [("key", np.uint64), ("rank", np.int64)])
    frequent["key"] = table.column("key").to_numpy().view(np.uint64)[order]
    frequent["rank"] = -order  # rarest first
    shared = spark.sparkContext.broadcast(frequent)

    rows = reps.mapInArrow(_prefixes(words, shared, key_bits(total)), "shingle bigint, doc_id bigint, n int")
    tiles = runtime.written(
        rows.repartition("shingle")
        .sortWithinPartitions("shingle", "n", "doc_id")
        .mapInArrow(_tiles, "kind tinyint, x bigint, y bigint, n int"),
        "jaccard-tiles",
    )
    runtime.released(dropped)
    bits = sig.where("n_shingles > 0").select("doc_id", "n_shingles", "bitmap")
    first = _bounded_pairs(
        tiles.where("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
        bits,
    )
    links = _verified(first, docs, words)
    runtime.released(first)
    comps = connected_components(links)

    many = tiles.where("kind = 1").select(F.col("x").alias("shingle"), F.col("y").alias("doc_id"), "n")
    many = many.join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "shingle", "doc_id", "n", F.coalesce("component_id", "doc_id").alias("comp")
    )
    many = runtime.written(many.distinct(), "jaccard-tiles")
    runtime.released(tiles, comps)
    # open tiles with one smallest id overlap widely: their documents form one unit, so that
    # a pair is tried once and not in each tile that it shares
    open_ = runtime.written(
        many.groupBy("shingle")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("doc_id").alias("unit"))
        .where("lo != hi")
        .select("shingle", "unit"),
        "jaccard-open",
    )
    units = runtime.written(
        many.join(open_, "shingle").select("unit", "doc_id", "n", "comp").distinct(),
        "jaccard-units",
    )
    runtime.released(many, open_)
    tried = None
    for across, nearest in ((False, True), (True, True), (True, False)):
        pairs = _candidates(units, bits, across, nearest)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = runtime.written(pairs, "jaccard-pairs")
        tried = pairs if tried is None else tried.union(pairs)
        links = links.union(_verified(pairs, docs, words))
        if nearest:
            comps = connected_components(links)
            named = comps.withColumnRenamed("id", "doc_id")
            before, units = units, runtime.written(
                units.drop("comp")
                .join(named, "doc_id", "left")
                .select("unit", "doc_id", "n", F.coalesce("component_id", "doc_id").alias("comp")),
                "jaccard-units",
            )
            runtime.released(before, comps)
    runtime.released(units)
    every = links.union(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    final = connected_components(every)
    return sig.join(final, sig.doc_id == final.id, "left").select(
        sig.doc_id,
        "n_shingles",
        F.coalesce("component_id", sig.doc_id).alias("component_id"),
    )


def _bounded_pairs(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs within the bitmap bound, written."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            kept = [
                r
                for r in rows
                if (100 + PERCENT) * overlap_bound(r["x"], r["y"], r["m"], r["n"])
                >= PERCENT * (r["m"] + r["n"])
            ]
            yield pa.RecordBatch.from_pydict(
                {c: pa.array([r[c] for r in kept], pa.int64()) for c in ("a", "b")}
            )

    left = bits.select(
        F.col("doc_id").alias("a"), F.col("n_shingles").alias("m"), F.col("bitmap").alias("x")
    )
    right = bits.select(
        F.col("doc_id").alias("b"), F.col("n_shingles").alias("n"), F.col("bitmap").alias("y")
    )
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "m", "n", "x", "y")
    kept = joined.mapInArrow(run, "a bigint, b bigint").distinct()
    return runtime.written(kept, "jaccard-pairs")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` (with doc_id and text) without near duplicates: the smallest id of each
    component stays, and so do rows with a null doc_id. Columns are unchanged."""
    with runtime.settings(docs.sparkSession, **SETTINGS):
        found = near_duplicates(docs)
        gone = runtime.written(
            found.where("component_id != doc_id").select("doc_id").distinct(), "jaccard-gone"
        )
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
