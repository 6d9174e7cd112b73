"""Sources, sinks and the command line."""

from __future__ import annotations

import os

import pyarrow.parquet as pq
import pytest

from tessera.__main__ import _jdbc_options, _partitions, main
from tessera.sources.fixtures import FIXTURES
from tessera.sources.readers import JdbcSource, ParquetSource
from tessera.sources.sinks import JdbcSink, ParquetSink
from tessera.session import ensure_checkpoint_dir
from tests.conftest import settings


def test_jdbc_reader_options_partition_large_tables(spark):
    src = JdbcSource(
        spark,
        "jdbc:mysql://db/x",
        {"user": "u"},
        _partitions(["uw_translation_products:product_id:0:1000:8"]),
    )
    big = src.reader_options("uw_translation_products")
    small = src.reader_options("countries")
    assert big["partitionColumn"] == "product_id" and big["numPartitions"] == "8"
    assert big["dbtable"] == "uw_translation_products" and big["user"] == "u"
    assert "partitionColumn" not in small and small["fetchsize"] == "10000"


def test_jdbc_credentials_from_environment(monkeypatch):
    monkeypatch.setenv("TESSERA_JDBC_USER", "alice")
    monkeypatch.setenv("TESSERA_JDBC_PASSWORD", "secret")
    assert _jdbc_options(["ssl=true"]) == {"user": "alice", "password": "secret", "ssl": "true"}


def test_checkpoint_dir_kept_when_set(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current
    assert ensure_checkpoint_dir(spark, "/tmp/elsewhere") == current


def test_cli_runs_the_job_on_parquet(spark, small_tables, scratch):
    landed = os.path.join(scratch, "in")
    for name in FIXTURES:
        small_tables[name].write.mode("overwrite").parquet(os.path.join(landed, f"{name}.parquet"))
    # the landed tables read back through the Parquet source with the declared schemas
    src = ParquetSource(spark, landed)
    assert src.load_checked("uw_translation_products").count() == small_tables[
        "uw_translation_products"
    ].count()
    out = os.path.join(scratch, "out")
    assert main(["--input", f"parquet:{landed}", "--output", f"parquet:{out}", "--profile", "local"]) == 0
    sink = ParquetSink(out)
    counts = {n: pq.read_table(sink.path(n)).num_rows for n in sink.current()}
    assert counts == {
        "master_uw_translation_projects": 5405,
        "master_uw_language_engagements": 111,
        "pb_language_engagements": 279,
    }


def test_large_jdbc_table_needs_ranges(spark):
    src = JdbcSource(spark, "jdbc:mysql://db/x")
    with pytest.raises(ValueError, match="parallel ranges"):
        src.reader_options("uw_translation_products")
    assert src.reader_options("countries")["dbtable"] == "countries"


def test_cluster_profile_sizes_from_its_input(spark):
    from tessera.session import CLUSTER_CONF, DEFAULT_CONF, MOST_REDUCERS, size_shuffles, stored_bytes

    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
    assert DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
    assert CLUSTER_CONF["spark.storage.decommission.shuffleBlocks.enabled"] == "true"
    name = "spark.sql.shuffle.partitions"
    with settings(spark, {name: spark.conf.get(name)}):
        assert size_shuffles(spark, stored_bytes(spark, "/root/testdata/sf0.001")) < 100
        assert size_shuffles(spark, 100 << 40) == MOST_REDUCERS
        assert spark.conf.get(name) == str(MOST_REDUCERS)


def test_parquet_versions_replace_together(spark, scratch):
    sink = ParquetSink(os.path.join(scratch, "out"), partition_by={"b": ("k",)})
    rows = lambda n: spark.range(n).selectExpr("id % 2 as k", "id as v")
    sink.save(rows(4), "a")
    sink.save(rows(6), "b")
    assert spark.read.parquet(sink.path("a")).count() == 4
    first = dict(sink.current())
    both = sink.replacement(None)
    back = both.save(rows(10), "a"), both.save(rows(12), "b")
    assert [x.count() for x in back] == [10, 12] and back[1].columns == ["k", "v"]
    assert dict(back[1].dtypes) == {"k": "bigint", "v": "bigint"}
    assert sink.current() == first  # not yet
    both.commit()
    assert [spark.read.parquet(sink.path(n)).count() for n in "ab"] == [10, 12]
    # the version before is still there, an older one is not
    assert spark.read.parquet(os.path.join(scratch, "out", first["a"])).count() == 4
    sink.save(rows(1), "a")
    assert not os.path.exists(os.path.join(scratch, "out", first["a"]))
    assert spark.read.parquet(sink.path("b")).count() == 12
    left = sink.replacement(None)
    left.save(rows(3), "a")
    left.abort()
    assert not os.path.exists(os.path.join(scratch, "out", left.version))
    both.abort()  # committed: nothing to remove
    assert spark.read.parquet(sink.path("b")).count() == 12


def test_jdbc_tables_are_renamed_together():
    names = ["a", "b"]
    assert JdbcSink("jdbc:mysql://db/x").rename_statements(names, {"a"}) == [
        "RENAME TABLE a TO a__old, a__next TO a, b__next TO b"
    ]
    assert JdbcSink("jdbc:postgresql://db/x").rename_statements(names, {"a", "b"}) == [
        "ALTER TABLE a RENAME TO a__old",
        "ALTER TABLE a__next RENAME TO a",
        "ALTER TABLE b RENAME TO b__old",
        "ALTER TABLE b__next RENAME TO b",
    ]
