"""Input tables (Parquet, JDBC, frames), declared schemas, fixture views, sinks."""

from tessera.sources.readers import (
    REFERENCE_TABLES,
    FrameSource,
    JdbcSource,
    ParquetSource,
    TableSource,
)
from tessera.sources.schemas import REFERENCE_SCHEMAS, SchemaError, conform
from tessera.sources.sinks import OUTPUT_TABLES, JdbcSink, ParquetSink, TableSink

__all__ = [
    "REFERENCE_TABLES",
    "REFERENCE_SCHEMAS",
    "OUTPUT_TABLES",
    "FrameSource",
    "JdbcSource",
    "ParquetSource",
    "TableSource",
    "TableSink",
    "ParquetSink",
    "JdbcSink",
    "SchemaError",
    "conform",
]
