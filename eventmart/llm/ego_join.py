"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine >= c lie within epsilon = sqrt(2 - 2c) of each other, and so do
their projections on any orthonormal directions. Vectors are sorted by the cells that a grid
of side epsilon has on the leading principal directions, and the sorted sequence is cut into
blocks. Two blocks of one label are joined unless their boxes are further apart than epsilon;
inside, the two sequences are halved again and again, halves that are provably distant are
skipped, and short intervals are compared exactly.

Equal vectors of a label collapse before the join and count by their number. A block pair
sends on, for each of its vectors, a number of links and one root; never its pairs. So a
group of near copies costs work in its blocks but neither rows nor memory in its square.

The principal directions come from at most ``BASIS_ROWS`` vectors, those whose ids have the
smallest hashes. They steer what is skipped and never what is found.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import runtime
from eventmart.llm.components import connected_components

COSINE = 0.98
DIRECTIONS = 8
BASIS_ROWS = 4_000
#: Vectors of a block; of an interval that is compared without further halving.
BLOCK, LEAF = 2_048, 128


def _matrix(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors as float64; None for one that is null, zero, or not finite throughout."""
    out: list[np.ndarray | None] = []
    for value in column:
        items = value.values if value.is_valid else None
        if items is None or len(items) == 0 or items.null_count:
            out.append(None)
            continue
        vector = items.to_numpy(zero_copy_only=False).astype(np.float64)
        good = np.isfinite(vector).all() and vector.any() and np.isfinite(vector @ vector)
        out.append(vector if good and vector @ vector > 0 else None)
    return out


def _packed(batches):
    """(vec_id, label, vec) with the vector as bytes of float64; only usable rows."""
    for batch in batches:
        rows = zip(
            batch.column("vec_id").to_pylist(),
            batch.column("label").to_pylist(),
            _matrix(batch.column("embedding")),
            strict=True,
        )
        kept = [(i, x, v.tobytes()) for i, x, v in rows if v is not None]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in kept], pa.int64()),
                pa.array([r[1] for r in kept], pa.string()),
                pa.array([r[2] for r in kept], pa.binary()),
            ],
            ["vec_id", "label", "vec"],
        )


def _units(packed: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vector in the sample, its leading principal directions."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(BASIS_ROWS).select("vec")
    by_size: dict[int, list[bytes]] = {}
    for (vec,) in sample.collect():
        by_size.setdefault(len(vec), []).append(bytes(vec))
    out = {}
    for size, packed in by_size.items():
        unit = _units(packed)
        centred = unit - unit.mean(axis=0)
        _, directions = np.linalg.eigh(centred.T @ centred)
        out[size // 8] = directions[:, ::-1][:, :DIRECTIONS].copy()
    return out


def _project(unit: np.ndarray, basis: dict[int, np.ndarray]) -> np.ndarray:
    """Leading coordinates; a length that the sample lacks uses its first ones."""
    directions = basis.get(unit.shape[1])
    found = unit[:, :DIRECTIONS] if directions is None else unit @ directions
    return np.pad(found, ((0, 0), (0, DIRECTIONS - found.shape[1])))


def _celled(basis: dict[int, np.ndarray], eps: float):
    def run(batches):
        for batch in batches:
            packed = batch.column("vec").to_pylist()
            cells = np.zeros((len(packed), DIRECTIONS), np.int64)
            sizes = np.array([len(p) // 8 for p in packed], np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                found = _project(_units([packed[r] for r in rows]), basis)
                cells[rows] = np.floor(found / eps)
            columns = [batch.column(c) for c in ("label", "rep", "n", "vec")]
            grid = [pa.array(cells[:, k], pa.int32()) for k in range(DIRECTIONS)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int32()), *grid],
                ["label", "rep", "n", "vec", "dims", *_CELLS],
            )

    return run


_CELLS = [f"c{k}" for k in range(DIRECTIONS)]
_BLOCK = "label string, dims int, first bigint, c_lo int, c_hi int, lo array<double>, hi array<double>, ids binary, ns binary, vecs binary"


def _cut(basis: dict[int, np.ndarray]):
    """Blocks of the sorted rows of a task; a block has one label and one vector length."""

    def block(rows):
        packed = [r[3] for r in rows]
        found = _project(_units(packed), basis)
        return {
            "label": rows[0][0],
            "dims": rows[0][4],
            "first": rows[0][1],
            "c_lo": min(r[5] for r in rows),
            "c_hi": max(r[5] for r in rows),
            "lo": found.min(axis=0).tolist(),
            "hi": found.max(axis=0).tolist(),
            "ids": np.array([r[1] for r in rows], np.int64).tobytes(),
            "ns": np.array([r[2] for r in rows], np.int64).tobytes(),
            "vecs": b"".join(packed),
        }

    schema = pa.schema(
        [
            ("label", pa.string()), ("dims", pa.int32()), ("first", pa.int64()),
            ("c_lo", pa.int32()), ("c_hi", pa.int32()), ("lo", pa.list_(pa.float64())),
            ("hi", pa.list_(pa.float64())), ("ids", pa.binary()), ("ns", pa.binary()),
            ("vecs", pa.binary()),
        ]
    )

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            names = ["label", "rep", "n", "vec", "dims", "c0"]
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if held and (len(held) == BLOCK or (held[0][0], held[0][4]) != (row[0], row[4])):
                    yield pa.RecordBatch.from_pylist([block(held)], schema)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist([block(held)], schema)

    return run


class _Groups:
    """Disjoint sets over the rows of a block pair."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def join_blocks(
    ids: np.ndarray, ns: np.ndarray, unit: np.ndarray, found: np.ndarray, split: int,
    cosine: float = COSINE,
) -> tuple[np.ndarray, np.ndarray]:
    """Links and a root for each row of two blocks, rows before ``split`` and after it.

    ``split`` = 0 joins one block with itself. Links count the vectors a row stands for.
    """
    eps2 = (2 - 2 * cosine) * (1 + 1e-9) + 1e-12
    links, groups = np.zeros(len(ids), np.int64), _Groups(len(ids))

    def apart(a, b, c, d):
        gap = np.maximum(
            found[a:b].min(axis=0) - found[c:d].max(axis=0),
            found[c:d].min(axis=0) - found[a:b].max(axis=0),
        )
        gap = np.maximum(gap, 0)
        return float(gap @ gap) > eps2

    def compare(a, b, c, d):
        near = unit[a:b] @ unit[c:d].T >= cosine
        if a == c:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        links[a:b] += near @ ns[c:d]
        if a != c:
            links[c:d] += near.T @ ns[a:b]
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            for j in np.flatnonzero(near[i]).tolist():
                groups.join(a + i, c + j)

    todo = [(0, len(ids), 0, len(ids))] if split == 0 else [(0, split, split, len(ids))]
    while todo:
        a, b, c, d = todo.pop()
        if apart(a, b, c, d):
            continue
        if max(b - a, d - c) <= LEAF:
            compare(a, b, c, d)
        elif a == c:
            m = (a + b) // 2
            todo += [(a, m, a, m), (a, m, m, b), (m, b, m, b)]
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]
    roots = np.array([groups.root(i) for i in range(len(ids))], np.int64)
    return links, ids[roots]


def _joined(basis: dict[int, np.ndarray], cosine: float):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                same = one["first"] == one["first2"]
                sides = [""] if same else ["", "2"]
                ids = np.frombuffer(b"".join(one[f"ids{s}"] for s in sides), np.int64)
                ns = np.frombuffer(b"".join(one[f"ns{s}"] for s in sides), np.int64)
                x = np.frombuffer(b"".join(one[f"vecs{s}"] for s in sides), np.float64)
                x = x.reshape(len(ids), -1)
                unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                split = 0 if same else len(one["ids"]) // 8
                links, roots = join_blocks(ids, ns, unit, _project(unit, basis), split, cosine)
                some = links > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(links[some]), pa.array(roots[some])],
                    ["rep", "links", "root"],
                )

    return run


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) for each row of ``vectors``.

    Two vectors link when their labels are equal and not null, their lengths are equal, and
    their cosine in double precision is at least ``cosine``. A vector that is null, empty,
    zero, or has a null or non-finite component links with nothing; so does a row with a null
    id, whose component_id is null and which is kept. Repeated rows (same id, label and
    vector) are one vector. Other columns are not read.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(embedding).alias("embedding"),
    )
    usable = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    packed = usable.mapInArrow(_packed, "vec_id bigint, label string, vec binary")
    packed = runtime.written(packed.withColumn("same", F.md5("vec")), "ego-vectors")
    # equal vectors of a label, and among them repeated ids
    distinct = packed.groupBy("label", "same", "vec_id").agg(F.first("vec").alias("vec"))
    groups = runtime.written(
        distinct.groupBy("label", "same").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")
        ),
        "ego-groups",
    )
    basis = principal(groups.select(F.col("rep").alias("vec_id"), "vec"))
    eps = math.sqrt(2 - 2 * cosine)
    order = ["label", "dims", *_CELLS, "rep"]
    blocks = runtime.written(
        groups.select("label", "rep", "n", "vec")
        .mapInArrow(
            _celled(basis, eps),
            "label string, rep bigint, n bigint, vec binary, dims int, "
            + ", ".join(f"{c} int" for c in _CELLS),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_cut(basis), _BLOCK),
        "ego-blocks",
    )
    box = blocks.select("label", "dims", "first", "c_lo", "c_hi", "lo", "hi")
    left = box.withColumn("cell", F.explode(F.sequence(F.col("c_lo") - 1, F.col("c_hi") + 1)))
    right = box.select(
        "label",
        "dims",
        *[F.col(c).alias(f"{c}2") for c in ("first", "lo", "hi")],
        F.explode(F.sequence("c_lo", "c_hi")).alias("cell"),
    )
    gaps = F.zip_with(
        F.zip_with("lo2", "hi", lambda x, y: F.greatest(x - y, F.lit(0.0))),
        F.zip_with("lo", "hi2", lambda x, y: F.greatest(x - y, F.lit(0.0))),
        lambda x, y: F.greatest(x, y),
    )
    distance = F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)
    pairs = (
        left.join(right, ["label", "dims", "cell"])
        .where("first <= first2")
        .where(distance <= eps * eps * (1 + 1e-9) + 1e-12)
        .select("label", "dims", "first", "first2")
        .distinct()
    )
    pairs = runtime.written(pairs, "ego-pairs")
    data = ["ids", "ns", "vecs"]
    one = blocks.select("label", "dims", "first", *data)
    two = blocks.select(
        "label", "dims", F.col("first").alias("first2"), *[F.col(c).alias(f"{c}2") for c in data]
    )
    two = two.withColumn("ids2", F.col("ids2"))
    met = pairs.join(one, ["label", "dims", "first"]).join(two, ["label", "dims", "first2"])
    links = runtime.written(
        met.select("first", "first2", *data, *[f"{c}2" for c in data])
        .repartition("first", "first2")
        .mapInArrow(_joined(basis, cosine), "rep bigint, links bigint, root bigint"),
        "ego-links",
    )
    return _named(spark, vectors, packed, groups, links)


def _named(spark, vectors, packed, groups, links) -> DataFrame:
    """Links and components of representatives, given to every row of ``vectors``."""
    members = (
        packed.join(groups.select("label", "same", "rep", "n"), ["label", "same"])
        .select("vec_id", "rep", "n", "label", "same")
        .distinct()
    )
    members = runtime.written(members, "ego-members")
    total = links.groupBy("rep").agg(F.sum("links").alias("links"))
    own = members.join(runtime.written(total, "ego-totals"), "rep", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")
    )
    own = own.groupBy("vec_id").agg(F.sum("links").cast("bigint").alias("n_links"))
    edges = links.select(F.col("rep").alias("a"), F.col("root").alias("b")).union(
        members.select("vec_id", "rep")
    )
    comps = connected_components(edges)
    named = vectors.select("vec_id").join(own, "vec_id", "left")
    named = named.join(comps, named.vec_id == comps.id, "left")
    component = F.coalesce("component_id", "vec_id")
    return named.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
