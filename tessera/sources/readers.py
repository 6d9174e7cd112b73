"""Sources: one ``load(name)`` per input table, from Parquet, JDBC or frames.

The reference issues a full-table ``select *`` per table. Here every read is
lazy, so Catalyst prunes columns and pushes filters into the scan, and the
three tables the reference reads but never uses cost nothing.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.schemas import REFERENCE_SCHEMAS, conform

# The twelve tables the reference job reads.
REFERENCE_TABLES = (
    "bible_info",
    "countries",
    "ietf_languages_codes",
    "joshua_project_data",
    "language_engagements",
    "language_engagements_organizations",
    "organizations",
    "pb_language_data",
    "sli_language_data",
    "training_events",
    "uw_reps",
    "uw_translation_products",
)

# The table that grows with the data.
LARGE_TABLES = ("uw_translation_products",)


class TableSource:
    """Something that can hand out a DataFrame per table name."""

    def load(self, name: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def load_checked(self, name: str) -> DataFrame:
        df = self.load(name)
        return conform(df, name) if name in REFERENCE_SCHEMAS else df

    def load_all(self, names: Iterable[str]) -> dict[str, DataFrame]:
        return {name: self.load_checked(name) for name in names}


@dataclass
class ParquetSource(TableSource):
    """Tables stored as ``<root>/<name><suffix>`` (a file or a directory).

    The default suffix matches the test data (``orders.parquet``); pass
    ``suffix=""`` for table directories named after the table.
    """

    spark: SparkSession
    root: str
    suffix: str = ".parquet"

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.root, f"{name}{self.suffix}"))


@dataclass
class JdbcSource(TableSource):
    """Tables read over JDBC.

    ``partitioning`` maps a table name to the options Spark needs to split a
    large table into parallel range reads, e.g.
    ``{"uw_translation_products": {"partitionColumn": "product_id",
    "lowerBound": "0", "upperBound": "100000000", "numPartitions": "256"}}``.
    Small lookup tables are read in one query; a table of ``must_partition``
    without such options is an error, as one task would read all of it.
    ``fetchsize`` keeps the driver from buffering a whole table per round trip.
    """

    spark: SparkSession
    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    partitioning: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    fetchsize: int = 10_000
    must_partition: tuple[str, ...] = LARGE_TABLES

    def reader_options(self, name: str) -> dict[str, str]:
        if name in self.must_partition and name not in self.partitioning:
            raise ValueError(f"{name} must be read in parallel ranges: give its partitioning options")
        opts = {"url": self.url, "dbtable": name, "fetchsize": str(self.fetchsize)}
        opts.update(self.options)
        opts.update(self.partitioning.get(name, {}))
        return opts

    def load(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.reader_options(name)).load()


@dataclass
class FrameSource(TableSource):
    """Tables already available as DataFrames (fixture views, temp views)."""

    frames: Mapping[str, DataFrame]

    def load(self, name: str) -> DataFrame:
        try:
            return self.frames[name]
        except KeyError as exc:
            raise KeyError(f"no frame registered for table {name!r}") from exc
