"""Sinks: replace output tables together, as Parquet versions or over JDBC.

Outputs are written beside the current ones first. One last step then makes all
of them current: a Parquet sink swaps one pointer file, a JDBC sink renames
tables. A failure before that step leaves readers on the old tables, all of
them; so does a failure of the step itself where the store swaps in one go.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The three analysis tables the reference job overwrites.
OUTPUT_TABLES = (
    "master_uw_language_engagements",
    "master_uw_translation_projects",
    "pb_language_engagements",
)


class Replacement:
    """Tables on their way to a sink. ``stage`` writes a frame once and returns it read back.

    This form suits any sink that can save a table: frames are staged and saved
    one after the other at the end.
    """

    def __init__(self, sink: TableSink, stage: Callable[[DataFrame, str], DataFrame]):
        self.sink, self._stage = sink, stage
        self.staged: dict[str, DataFrame] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.staged[name] = self._stage(df, name)
        return self.staged[name]

    def commit(self) -> None:
        for name, df in self.staged.items():
            self.sink.save(df, name)

    def abort(self) -> None:
        """Remove what was written; the current tables are untouched."""


class TableSink:
    def save(self, df: DataFrame, name: str) -> None:  # pragma: no cover - interface
        raise NotImplementedError

    def replacement(self, stage: Callable[[DataFrame, str], DataFrame]) -> Replacement:
        return Replacement(self, stage)


def _path(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


# Fixed values of a sink's folder: the pointer to current tables, and the versions.
POINTER, VERSIONS = "_current.json", "_versions"


@dataclass
class ParquetSink(TableSink):
    """Parquet tables under ``root`` in versions; ``_current.json`` names each table's current one.

    A version is a folder ``_versions/<id>/<name>``. The pointer file is written
    aside and renamed over the old one, so readers see all new tables or all
    old ones (on a store without atomic rename, one object is replaced). The
    version before the current one is kept for readers that have begun on it;
    older ones are deleted. ``partition_by`` optionally lays a table out by
    columns for downstream pruning; ``max_records_per_file`` bounds file sizes.
    """

    root: str
    partition_by: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    max_records_per_file: int | None = None

    def current(self) -> dict[str, str]:
        """Each table's folder under ``root`` as the pointer has it now."""
        return self._pointer().get("tables", {})

    def path(self, name: str) -> str:
        """Where the current ``name`` is; read it from there."""
        return os.path.join(self.root, self.current().get(name, name))

    def save(self, df: DataFrame, name: str) -> None:
        """Replace one table; the others stay as they are."""
        one = self.replacement(lambda d, _: d)
        try:
            one.save(df, name)
            one.commit()
        except BaseException:
            one.abort()
            raise

    def replacement(self, stage: Callable[[DataFrame, str], DataFrame]) -> ParquetReplacement:
        return ParquetReplacement(self, stage)

    def write(self, df: DataFrame, name: str, folder: str) -> None:
        writer = df.write
        if self.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", str(self.max_records_per_file))
        cols = self.partition_by.get(name)
        if cols:
            writer = writer.partitionBy(*cols)
        writer.parquet(folder)

    def _pointer(self) -> dict:
        path, fs = _path(_session(), os.path.join(self.root, POINTER))
        if not fs.exists(path):
            return {}
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _swap(self, pointer: dict) -> None:
        spark = _session()
        aside, fs = _path(spark, os.path.join(self.root, f"{POINTER}.{uuid.uuid4().hex}"))
        stream = fs.create(aside, True)
        try:
            stream.write(json.dumps(pointer).encode())
        finally:
            stream.close()
        jvm = spark._jvm
        over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), spark._jsc.hadoopConfiguration()
        )
        context.rename(aside, _path(spark, os.path.join(self.root, POINTER))[0], over)


def _session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("a Parquet sink needs a running Spark session")
    return spark


class ParquetReplacement(Replacement):
    """A version being written. Nothing is staged elsewhere: its own files are read back."""

    def __init__(self, sink: ParquetSink, stage: Callable[[DataFrame, str], DataFrame]):
        super().__init__(sink, stage)
        self.version = f"{VERSIONS}/{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        folder = os.path.join(self.sink.root, self.version, name)
        self.sink.write(df, name, folder)
        # Partition columns move to the end and may change type; readers get the frame's own.
        read = df.sparkSession.read.schema(df.schema).parquet(folder)
        self.staged[name] = read.select(*[f"`{c}`" for c in df.columns])
        return self.staged[name]

    def commit(self) -> None:
        old = self.sink._pointer()
        before = old.get("tables", {})
        tables = before | {name: f"{self.version}/{name}" for name in self.staged}
        self.sink._swap({"tables": tables, "before": before})
        # What only the version before the last one held.
        for folder in set(old.get("before", {}).values()) - set(before.values()) - set(tables.values()):
            self._delete(folder)

    def abort(self) -> None:
        if not any(f.startswith(f"{self.version}/") for f in self.sink.current().values()):
            self._delete(self.version)

    def _delete(self, folder: str) -> None:
        path, fs = _path(_session(), os.path.join(self.sink.root, folder))
        fs.delete(path, True)


@dataclass
class JdbcSink(TableSink):
    """Database tables, written as ``<name>__next`` and then renamed together.

    ``numPartitions`` caps concurrent connections; ``batchsize`` sets rows per
    insert batch. MySQL and MariaDB rename all tables in one atomic statement;
    elsewhere the renames are one transaction. ``save`` overwrites one table in
    place (drop and recreate, like the reference).
    """

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    num_partitions: int = 16
    batchsize: int = 10_000

    def save(self, df: DataFrame, name: str) -> None:
        opts = {
            "url": self.url,
            "dbtable": name,
            "numPartitions": str(self.num_partitions),
            "batchsize": str(self.batchsize),
        }
        opts.update(self.options)
        df.write.format("jdbc").mode("overwrite").options(**opts).save()

    def replacement(self, stage: Callable[[DataFrame, str], DataFrame]) -> JdbcReplacement:
        return JdbcReplacement(self, stage)

    def rename_statements(self, names: Sequence[str], existing: set[str]) -> list[str]:
        """SQL that makes every ``<name>__next`` current; tables that did not exist are only renamed."""
        pairs = []
        for name in names:
            if name in existing:
                pairs.append((name, f"{name}__old"))
            pairs.append((f"{name}__next", name))
        if self.url.split(":")[1] in ("mysql", "mariadb"):
            renames = ["RENAME TABLE " + ", ".join(f"{a} TO {b}" for a, b in pairs)]
        else:
            renames = [f"ALTER TABLE {a} RENAME TO {b}" for a, b in pairs]
        return renames

    def run(self, statements: Sequence[str]) -> None:
        """All statements in one transaction, over one connection of the driver."""
        connection = self._connect()
        try:
            connection.setAutoCommit(False)
            for sql in statements:
                connection.createStatement().execute(sql)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def existing(self, names: Sequence[str]) -> set[str]:
        connection = self._connect()
        try:
            found = set()
            for name in names:
                rows = connection.getMetaData().getTables(connection.getCatalog(), None, name, None)
                if rows.next():
                    found.add(name)
            return found
        finally:
            connection.close()

    def _connect(self):
        jvm = _session()._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.options.items():
            properties.setProperty(key, value)
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)


class JdbcReplacement(Replacement):
    """Next tables in the database; later steps read the staged copies, not the database."""

    def save(self, df: DataFrame, name: str) -> DataFrame:
        staged = super().save(df, name)
        self.sink.save(staged, f"{name}__next")
        return staged

    def commit(self) -> None:
        names = list(self.staged)
        left = self.sink.existing([f"{n}__old" for n in names])
        self.sink.run([f"DROP TABLE {n}" for n in sorted(left)])
        existing = self.sink.existing(names)
        self.sink.run(self.sink.rename_statements(names, existing))
        self.sink.run([f"DROP TABLE {n}__old" for n in names if n in existing])
