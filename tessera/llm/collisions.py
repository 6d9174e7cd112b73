"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Every vector is projected on many seeded Gaussian directions. For unit vectors
at a given cosine the difference of two projections is Gaussian with a known
spread, so windows, counts and recall are calibrated without looking at data.
Only the number of directions in a group, which decides how much is compared
and not what is found, also looks at how close unrelated vectors are.

Each projection is cut into windows of one width at a random offset, which gives
every vector a window number for each direction; no projection is sorted whole.
Directions come in groups; vectors in the same windows of a whole group share a
cell, and hashes of cells are what Spark shuffles and sorts. Candidates are the
pairs of a cell. Their collisions over all directions are counted with windows
centred on the query vector; pairs that reach the calibrated count are verified
by their cosine in double precision.

In a cloud with a common direction unrelated vectors lie closer to each other.
Groups then have more directions, so that cells stay small, and recall takes
more groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, erf, exp, lgamma, log, log1p, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.blocks import block_pairs, runs
from tessera.llm.common import Scratch, check_columns, col, components, parts_for, row_position
from tessera.llm.simhash import forest

# Window width of a cell, in units of a unit vector's projection spread.
CELL = 2.0
# What one more group costs for a vector, in comparisons: it is shuffled and projected again.
COPY_COST = 100
# Classes whose pairs tell how close unrelated vectors are, and bins of their cosines.
SAMPLE = 1_024
_BINS = 128
_MOST_PER_GROUP = 64
_BLOCK_ROWS = 4_096
_PAIRS = 1 << 17


def _same_cell(spread: float, width: float) -> float:
    """Chance that two points a Gaussian difference apart fall in one window at a random offset."""
    z = width / spread
    inside = erf(z / sqrt(2))
    mean = spread * sqrt(2 / pi) * (1 - exp(-z * z / 2))
    return inside - mean / width


@dataclass(frozen=True)
class Plan:
    """Directions a group, groups, the half width of query windows and the least count."""

    per_group: int
    groups: int
    half_width: float
    least: int
    recall: float

    @property
    def directions(self) -> int:
        return self.per_group * self.groups


def background(vectors: list[np.ndarray], cosine: float) -> list[tuple[float, float]]:
    """``(cosine, share)`` of the pairs of a sample that are below ``cosine``, in bins.

    Pairs of different lengths do not count: they never share a cell. Without
    any pair left, unrelated vectors are taken to be at right angles.
    """
    shares = np.zeros(_BINS)
    edges = np.linspace(-1, cosine, _BINS + 1)
    for dim in sorted({len(v) for v in vectors}):
        units = unit_rows(np.stack([v for v in vectors if len(v) == dim]))
        found = (units @ units.T)[np.triu_indices(len(units), 1)]
        shares += np.histogram(found[found < cosine], edges)[0]
    if not shares.sum():
        return [(0.0, 1.0)]
    some = np.flatnonzero(shares)
    # A bin stands for its closest pairs.
    return list(zip(edges[1:][some].tolist(), (shares[some] / shares.sum()).tolist()))


def calibrate(
    rows: int,
    cosine: float,
    unrelated: list[tuple[float, float]] | None = None,
    cell_recall: float = 0.985,
    count_recall: float = 0.998,
) -> Plan:
    """Parameters that find a pair exactly at ``cosine`` with the product of both recalls.

    More directions a group leave fewer of the ``unrelated`` vectors (cosines
    and shares, see :func:`background`) in a cell, and take more groups for
    recall. The number with the least work is taken: comparisons in cells and
    copies of vectors. Closer pairs are found more surely.
    """
    near = sqrt(2 - 2 * cosine)
    p_near = _same_cell(near, CELL)
    far = [(_same_cell(sqrt(2 - 2 * c), CELL), share) for c, share in unrelated or [(0.0, 1.0)]]

    def groups_of(k: int) -> int:
        return max(1, ceil(log(1 - cell_recall) / log1p(-(p_near**k))))

    def work(k: int) -> float:
        return groups_of(k) * (COPY_COST + rows * sum(share * p**k for p, share in far))

    per_group = min(range(1, _MOST_PER_GROUP + 1), key=work)
    groups = groups_of(per_group)
    m, half_width = per_group * groups, 2 * near
    p = erf(2 / sqrt(2))
    least, above = m, p**m
    while above < count_recall and least > 0:
        least -= 1
        ways = lgamma(m + 1) - lgamma(least + 1) - lgamma(m - least + 1)
        above += exp(ways + least * log(p) + (m - least) * log1p(-p))
    return Plan(per_group, groups, half_width, least, cell_recall * count_recall)


def _directions(dim: int, plan: Plan, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, plan.directions)), rng.uniform(0, CELL, plan.directions)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow or underflow."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _project(units: np.ndarray, plan: Plan, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Projections, and each row's cell in every group as a hash of its windows."""
    dim = units.shape[1]
    matrix, offset = _directions(dim, plan, seed)
    values = units @ matrix
    windows = np.floor((values + offset) / CELL).astype(np.int64).view(np.uint64)
    windows = windows.reshape(len(units), plan.groups, plan.per_group)
    cells = np.full((len(units), plan.groups), dim, np.uint64)
    cells += np.arange(plan.groups, dtype=np.uint64) << np.uint64(32)
    for k in range(plan.per_group):
        cells = (cells ^ windows[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        cells ^= cells >> np.uint64(29)
    return values.astype(np.float32), cells.view(np.int64)


def _bodies(column: pa.ChunkedArray | pa.Array, stored: str) -> list[np.ndarray]:
    return [np.frombuffer(b, stored) for b in column.to_pylist()]


def usable(vector: Column) -> Column:
    """Vectors with components, all of them finite and not all zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _cells(classes: DataFrame, plan: Plan, seed: int, stored: str) -> DataFrame:
    """One row for each class and group: its cell, and the vector in the ``stored`` type."""
    schema = T.StructType(
        [
            T.StructField("cell", T.LongType()),
            T.StructField("number", T.IntegerType()),
            T.StructField("node", T.LongType()),
            T.StructField("copies", T.LongType()),
            T.StructField("body", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lists = part.column(2)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
                vectors = np.split(flat, ends[:-1])
                dims = np.array([len(v) for v in vectors])
                for dim in np.unique(dims):
                    which = np.flatnonzero(dims == dim)
                    _, cells = _project(unit_rows(np.stack([vectors[i] for i in which])), plan, seed)
                    body = [vectors[i].astype(stored).tobytes() for i in which]
                    for g in range(plan.groups):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(cells[:, g]),
                                pa.array(np.full(len(which), g, np.int32)),
                                part.column(0).take(pa.array(which)),
                                part.column(1).take(pa.array(which)),
                                pa.array(body, pa.binary()),
                            ],
                            names=schema.names,
                        )

    return classes.select("node", "copies", "vector").mapInArrow(run, schema)


def _unit_pairs(starts: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within each unit, some at a time."""
    i_all, j_all, held = [], [], 0
    for lo, hi in zip(starts[:-1], starts[1:]):
        across = side[lo:hi].any()
        right = lo + np.flatnonzero(side[lo:hi] == 1)
        for i in range(lo, hi):
            if across and side[i]:
                continue
            j = right if across else np.arange(i + 1, hi)
            if len(j):
                i_all.append(np.full(len(j), i))
                j_all.append(j)
                held += len(j)
            if held >= _PAIRS:
                yield np.concatenate(i_all), np.concatenate(j_all)
                i_all, j_all, held = [], [], 0
    if held:
        yield np.concatenate(i_all), np.concatenate(j_all)


def _linked(
    table: pa.Table, plan: Plan, cosine: float, seed: int, stored: str
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of whole units that collide often enough and are verified.

    A pair that shares cells in several groups is taken in the first of them.
    """
    units = ("cell", "number", "__left", "__right")
    columns = [table[u].to_numpy() for u in units]
    fresh = np.ones(table.num_rows, bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.append(np.flatnonzero(fresh), table.num_rows)
    number = columns[1]
    # Only rows of one dimension share a unit; a batch may hold several.
    bodies = _bodies(table["body"], stored)
    dims = np.array([len(b) for b in bodies])
    values = np.zeros((len(bodies), plan.directions), np.float32)
    cells = np.zeros((len(bodies), plan.groups), np.int64)
    units_of, place = {}, np.zeros(len(bodies), np.int64)
    for dim in np.unique(dims):
        which = np.flatnonzero(dims == dim)
        units_of[dim] = unit_rows(np.stack([bodies[i] for i in which]))
        values[which], cells[which] = _project(units_of[dim], plan, seed)
        place[which] = np.arange(len(which))
    earlier = np.arange(plan.groups)
    for i, j in _unit_pairs(starts, table["__side"].to_numpy()):
        new = (dims[i] == dims[j]) & ~((cells[i] == cells[j]) & (earlier < number[i][:, None])).any(axis=1)
        i, j = i[new], j[new]
        count = np.zeros(len(i), np.int32)
        for at in range(0, len(i), 8192):
            part = slice(at, at + 8192)
            count[part] = (np.abs(values[i[part]] - values[j[part]]) <= plan.half_width).sum(axis=1)
        often = count >= plan.least
        i, j = i[often], j[often]
        for dim, x in units_of.items():
            own = np.flatnonzero(dims[i] == dim)
            for at in range(0, len(own), 8192):
                a, b = i[own[at : at + 8192]], j[own[at : at + 8192]]
                near = np.einsum("rd,rd->r", x[place[a]], x[place[b]]) >= cosine
                yield a[near], b[near]


def near_duplicates(
    vectors: DataFrame,
    scratch: Scratch,
    cosine: float = 0.95,
    seed: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(vec_id, n_links, component_id)`` for every row.

    Equal vectors are one class with a count, so copies make no pairs; a link
    between two classes counts all copies of the other, and copies of a vector
    link with each other. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, as do vectors of different
    lengths; their component is their own id. Null ids take part and never
    name a component that has another id. An empty table gives no rows; other
    columns are not read. A cell of any size is dealt into pairs of blocks.
    """
    check_columns(vectors, [id_col, vector_col])
    # Single-precision components travel as such; cosines are computed in double.
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    kind, stored = ("array<float>", "<f4") if single else ("array<double>", "<f8")
    rows = vectors.select(
        col(id_col).alias("vec_id"),
        F.when(usable(col(vector_col)), col(vector_col).cast(kind)).alias("vector"),
    ).withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    classes = scratch.save(
        rows.filter(F.col("vector").isNotNull())
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector"))
        .withColumn("node", row_position()),
        "classes",
    )
    # By hash: at most SAMPLE vectors reach the driver, and decide nothing but the amount of work.
    seen = [np.array(r["vector"], np.float64) for r in classes.orderBy("h1", "h2").limit(SAMPLE).select("vector").collect()]
    plan = calibrate(classes.count(), cosine, background(seen, cosine))
    units = ["cell", "number", "__left", "__right"]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "n")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in runs(batches, units):
            table = chunk.combine_chunks()
            node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
            links = np.zeros(table.num_rows, np.int64)
            none = np.array([], np.int64)
            a, b = none, none
            for i, j in _linked(table, plan, cosine, seed, stored):
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                a, b = forest(np.concatenate([a, node[i]]), np.concatenate([b, node[j]]))
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[some], a])),
                    pa.array(np.concatenate([node[some], b])),
                    pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)])),
                ],
                names=schema.names,
            )

    cells = _cells(classes, plan, seed, stored)
    found = scratch.save(
        block_pairs(cells, "cell", "node", _BLOCK_ROWS)
        .repartition(parts_for(vectors.sparkSession), *units)
        .sortWithinPartitions(*units)
        .mapInArrow(run, schema),
        "links",
    )
    counts = found.groupBy(col("a").alias("__a")).agg(F.sum("n").alias("n"))
    roots = components(found.select("a", "b"), scratch).withColumnRenamed("node", "__node")
    placed = (
        classes.select("h1", "h2", "node", "least", "copies")
        .join(roots, F.col("node") == F.col("__node"), "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    names = placed.groupBy(col("root").alias("__root")).agg(F.min("least").alias("component_id"))
    linked = scratch.save(
        placed.join(names, F.col("root") == F.col("__root"))
        .join(counts, F.col("node") == F.col("__a"), "left")
        .select(
            col("h1").alias("__h1"),
            col("h2").alias("__h2"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "component_id",
        ),
        "linked",
    )
    own = F.col("vector").isNotNull() & (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))
    return rows.join(linked, own, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
