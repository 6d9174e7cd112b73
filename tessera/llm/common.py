"""Helpers shared by the operators: shared scratch tables, gapless numbering, components.

Intermediate tables are Parquet in the folder that ``spark.checkpoint.dir``
names, which the driver and all executors share, so a lost executor loses
nothing that was written. Only where the setting is absent (tests, local mode)
a local folder is made.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()

# monotonically_increasing_id() holds the partition above this many bits of row number.
_ROW_BITS = 33


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` would; once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = Path(__file__).resolve().parents[1]
        zipped = Path(tempfile.mkdtemp(prefix="tessera-py-")) / "tessera.zip"
        with zipfile.ZipFile(zipped, "w") as z:
            for f in sorted(here.rglob("*.py")):
                z.write(f, f.relative_to(here.parent))
        spark.sparkContext.addPyFile(str(zipped))
        _SHIPPED.add(app)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where none is set, in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tessera-llm-")
    return _LOCAL_ROOTS[app]


_WATCHED: list[list[Scratch]] = []


@contextmanager
def temporary() -> Iterator[None]:
    """Delete the tables of all runs begun inside, once what was made from them is written."""
    _WATCHED.append([])
    try:
        yield
    finally:
        for scratch in _WATCHED.pop():
            scratch.close()


class Scratch:
    """Tables of one operator run, each in a folder of its own under the shared root."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        if _WATCHED:
            _WATCHED[-1].append(self)

    def place(self, table: str) -> str:
        self._n += 1
        return f"{self.path}/{self._n:04d}-{table}"

    def save(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` and return it read back: computed once, lineage cut."""
        path = self.place(table)
        df.write.option("compression", "zstd").parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        read._scratch_path = path
        return read

    def drop(self, df: DataFrame) -> None:
        """Delete a table that ``save`` returned and nothing reads any more."""
        path = getattr(df, "_scratch_path", None)
        if path:
            self._delete(path)

    def close(self) -> None:
        """Delete all tables of the run, once the frames that read them are done with."""
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def col(name: str) -> Column:
    """A column by exact name (names may hold dots or spaces)."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_position() -> Column:
    """A row's place in its partition, to be taken right before ``Scratch.save``."""
    return F.monotonically_increasing_id()


def part_of(position: Column) -> Column:
    return F.shiftright(position, _ROW_BITS)


def place_in_part(position: Column) -> Column:
    return position.bitwiseAND((1 << _ROW_BITS) - 1)


def dense_index(saved: DataFrame, position: str, name: str) -> DataFrame:
    """Number the rows of a saved table 0, 1, 2, ... in the order of ``position``.

    ``position`` was written as :func:`row_position`. One row for each
    partition of the saved table reaches the driver, and the offsets go back
    as a literal array: both are as long as the table has partitions.
    """
    counts = {
        r["p"]: r["n"]
        for r in saved.groupBy(part_of(col(position)).alias("p"))
        .agg((F.max(place_in_part(col(position))) + 1).alias("n"))
        .collect()
    }
    offsets, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    start = F.lit(offsets or [0]).cast("array<bigint>")[part_of(col(position)).cast("int")]
    return saved.withColumn(name, start + place_in_part(col(position)))


def parts_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for the nodes of ``edges (a, b)``; root is a component's least node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every
    round is a partial minimum for each node and a join back, so a hub is
    pre-aggregated and its join can be split; the number of edges does not
    grow and rounds are logarithmic in practice. Each round's edges are a
    table in the shared folder; the one before is deleted.
    """
    edges = (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    now = scratch.save(edges, "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.filter(F.col("b") > F.col("a"))
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .filter(F.col("a") != F.col("b"))
            .distinct()
        )
        new = scratch.save(small, "edges")
        scratch.drop(now)
        now = new
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def text_or(name: str, other: str = "") -> Column:
    return F.coalesce(col(name), F.lit(other))


def check_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
