"""Run the daily job: ``python -m tessera --input ... --output ...``.

Inputs and outputs are ``parquet:<dir>`` (tables as ``<dir>/<name>.parquet``
in; out, ``<dir>/_current.json`` names each table's folder) or ``jdbc:<url>``. JDBC credentials come from
``--jdbc-option user=...`` or the environment variables
``TESSERA_JDBC_USER`` / ``TESSERA_JDBC_PASSWORD``. A large table can be read
in parallel ranges with ``--jdbc-partition table:column:lower:upper:parts``; the
product table must be.
"""

from __future__ import annotations

import argparse
import os
import sys

from tessera.plans.job import run_job
from tessera.session import build_session, size_shuffles, stored_bytes
from tessera.sources.readers import JdbcSource, ParquetSource
from tessera.sources.sinks import JdbcSink, ParquetSink


def _jdbc_options(pairs: list[str]) -> dict[str, str]:
    opts = {}
    for key, env in (("user", "TESSERA_JDBC_USER"), ("password", "TESSERA_JDBC_PASSWORD")):
        if os.environ.get(env):
            opts[key] = os.environ[env]
    for pair in pairs:
        key, _, value = pair.partition("=")
        opts[key] = value
    return opts


def _partitions(specs: list[str]) -> dict[str, dict[str, str]]:
    out = {}
    for spec in specs:
        table, column, lower, upper, parts = spec.split(":")
        out[table] = {
            "partitionColumn": column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": parts,
        }
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True, help="parquet:<dir> or jdbc:<url>")
    p.add_argument("--output", required=True, help="parquet:<dir> or jdbc:<url>")
    p.add_argument("--flow", choices=["live", "legacy"], default="live")
    p.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--jdbc-partition", action="append", default=[], metavar="T:COL:LO:HI:N")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--profile", choices=["local", "cluster"], default="cluster")
    p.add_argument("--checkpoint-dir", default=None, help="shared directory, where spark.checkpoint.dir is unset")
    p.add_argument("--input-gb", type=float, default=None, help="size of a JDBC input, to size shuffles from")
    p.add_argument(
        "--null-product-limit", type=int, default=None, help="stop where NULL keys of a goal join multiply beyond this"
    )
    args = p.parse_args(argv)

    spark = build_session(
        args.master, app_name=f"tessera-{args.flow}", profile=args.profile, checkpoint_dir=args.checkpoint_dir
    )
    jdbc = _jdbc_options(args.jdbc_option)

    kind, _, where = args.input.partition(":")
    if kind == "parquet":
        source = ParquetSource(spark, where)
        size_shuffles(spark, stored_bytes(spark, where))
    elif kind == "jdbc":
        source = JdbcSource(spark, where, jdbc, _partitions(args.jdbc_partition))
        if args.input_gb is not None:
            size_shuffles(spark, int(args.input_gb * 2**30))
    else:
        p.error(f"unknown input kind {kind!r}")

    kind, _, where = args.output.partition(":")
    if kind == "parquet":
        sink = ParquetSink(where)
    elif kind == "jdbc":
        sink = JdbcSink(where, jdbc)
    else:
        p.error(f"unknown output kind {kind!r}")

    report = run_job(spark, source, sink, flow=args.flow, null_product_limit=args.null_product_limit)
    where = sink.path if isinstance(sink, ParquetSink) else str
    print(" ".join(where(name) for name in report.outputs.values()))
    for name, rows in sorted(report.inputs.items()):
        print(f"read {name}: {rows} rows")
    for name, keys in report.null_keys.items():
        print(f"{name}: {keys.left} x {keys.right} NULL keys, {keys.rows} rows out")
    return 0


if __name__ == "__main__":
    sys.exit(main())
