"""Whole-flow properties, the daily job with sinks, and the oracle at sf0.001."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F

from tessera.oracle import ORACLE_SQL
from tessera.plans import legacy, live
from tessera.plans.job import LIVE_INPUTS, NullKeyProduct, Staging, run_job
from tessera.plans.queries import QUERIES
from tessera.sources.fixtures import FIXTURES, FixtureTables
from tessera.sources.readers import FrameSource
from tessera.sources.sinks import OUTPUT_TABLES, ParquetSink
from tests.compare import compare, duck_connection
from tests.conftest import settings

SF_SMALL = "/root/testdata/sf0.001"


def _multiset(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_window_and_aggregate_agree(small_tables):
    a = live.project_status(small_tables, method="aggregate")
    w = live.project_status(small_tables, method="window")
    assert a.columns == w.columns
    assert _multiset(a) == _multiset(w)


def test_every_goal_language_is_reported(small_tables):
    out = live.run_live(small_tables)
    goals = small_tables["pb_language_data"].count()
    report = out["pb_language_engagements"]
    assert report.select("iso_639_2").distinct().count() == small_tables["pb_language_data"].select(
        "languagecode"
    ).distinct().count()
    assert report.count() >= goals


def test_rollup_has_one_row_per_engagement(small_tables):
    projects = live.project_status(small_tables)
    rollup = live.engagement_status(projects)
    assert rollup.count() == rollup.select("language_engagement_id").distinct().count()


def test_products_with_engagement_all_appear(small_tables):
    prep = live.prepared_products(small_tables)
    products = small_tables["uw_translation_products"]
    dim_ids = live.engagement_dimension(small_tables).select("language_engagement_id").distinct()
    matched = products.join(dim_ids, "language_engagement_id", "left_semi").count()
    assert prep.count() >= matched


@pytest.mark.parametrize("flow", ["live", "legacy"])
def test_job_writes_three_tables(spark, small_tables, scratch, flow):
    sink = ParquetSink(os.path.join(scratch, "out"))
    source = FrameSource({name: small_tables[name] for name in FIXTURES})
    run_job(spark, source, sink, flow=flow)
    expected = (live.run_live if flow == "live" else legacy.run_legacy)(small_tables)
    for name, df in expected.items():
        written = spark.read.parquet(sink.path(name))
        assert sorted(written.columns) == sorted(df.columns)
        assert _multiset(written.select(*df.columns)) == _multiset(df)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "project_status" in df.columns


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


# Large-size plans: no broadcast, from sizes or at run time.
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.mark.parametrize("conf", [{}, NO_BROADCAST], ids=["as-planned", "no-broadcast"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle_agrees(spark, duck, name, conf):
    with settings(spark, conf):
        # fresh views: a frame keeps the plan it was first run with
        df = QUERIES[name](FixtureTables(spark, SF_SMALL))
        res = compare(df, ORACLE_SQL[name], duck)
        if conf:
            assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert res["columns_match"], res
    assert not res["type_mismatch"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_building_a_query_runs_no_job(spark):
    """Footers of Parquet files aside, nothing runs and nothing is cached until the caller asks."""
    sc = spark.sparkContext
    tables = FixtureTables(spark, SF_SMALL)
    for name in FIXTURES:
        tables[name].schema
    for name, build in QUERIES.items():
        if name.startswith("written_"):
            continue  # writes to a sink and reads it back
        sc.setJobGroup(f"build-{name}", "build")
        df = build(tables)
        sc._jsc.clearJobGroup()
        assert not sc.statusTracker().getJobIdsForGroup(f"build-{name}"), name
        assert not df.storageLevel.useMemory and "InMemoryTableScan" not in df._jdf.queryExecution().toString()


def test_a_failure_leaves_the_old_tables(spark, small_tables, scratch):
    """All outputs are computed before the first is replaced."""
    sink = ParquetSink(os.path.join(scratch, "out"))
    good = {name: small_tables[name] for name in FIXTURES}
    run_job(spark, FrameSource(good), sink)
    before = {n: _multiset(spark.read.parquet(sink.path(n))) for n in OUTPUT_TABLES}
    broken = dict(good)
    goals = good["pb_language_data"]
    broken["pb_language_data"] = goals.withColumn("allaccessgoal", F.raise_error(F.lit("bad row")).cast("string"))
    broken["uw_translation_products"] = good["uw_translation_products"].limit(0)
    with pytest.raises(Exception, match="bad row"):
        run_job(spark, FrameSource(broken), sink)
    assert {n: _multiset(spark.read.parquet(sink.path(n))) for n in OUTPUT_TABLES} == before


def test_staging_is_shared_and_deleted(spark, small_tables, scratch, monkeypatch):
    kept = []
    original = Staging.save
    monkeypatch.setattr(Staging, "save", lambda self, df, name: kept.append(self.root) or original(self, df, name))
    run_job(spark, FrameSource({n: small_tables[n] for n in FIXTURES}), ParquetSink(os.path.join(scratch, "o")))
    assert kept and kept[0].startswith(spark.sparkContext.getCheckpointDir())
    assert not os.path.exists(kept[0].removeprefix("file:"))
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        Staging(spark)


def test_dimension_keys_that_differ_within_an_engagement(spark, small_tables):
    """Duplicate country codes with different names split one engagement's rows
    across display-name groups; the aggregate plans must match the window plans."""
    from pyspark.sql import functions as F

    from tessera.functions import status as st

    tables = {name: small_tables[name] for name in FIXTURES}
    countries = tables["countries"]
    tables["countries"] = countries.unionByName(
        countries.filter("alpha_3_code in ('C1', 'C2', 'C3')").withColumn(
            "english_short_name", F.concat(F.col("english_short_name"), F.lit(" (alt)"))
        )
    )
    for keys in (st.LIVE_GROUP_KEYS, st.DISPLAY_GROUP_KEYS):
        a = live.project_status(tables, keys=keys, method="aggregate")
        w = live.project_status(tables, keys=keys, method="window")
        assert _multiset(a) == _multiset(w)
    a = legacy.legacy_project_status(tables, method="aggregate")
    w = legacy.legacy_project_status(tables, method="window")
    assert a.columns == w.columns
    assert _multiset(a) == _multiset(w)


def test_status_counts_match_survey_at_sf0001(spark):
    ps = entry.queries()["project_status"](spark, SF_SMALL)
    counts = {r[0]: r[1] for r in ps.groupBy("project_status").count().collect()}
    assert counts == {
        "Inactive": 16,
        "Completed": 138 + 435 + 1709,
        "Future": 341,
        "Active": 2025 + 187 + 218 + 101,
        "Paused": 61,
        "Intent": 163,
        None: 11,
    }


def test_engagement_statuses_match_survey_at_sf001(spark):
    master = entry.queries()["engagement_master"](spark, "/root/testdata/sf0.01")
    counts = {r[0]: r[1] for r in master.groupBy("project_status").count().collect()}
    assert counts == {
        "Active": 476,
        "Prospective": 728,
        "Future": 96,
        "Completed": 4,
        "Paused": 3,
        "Inactive": 2,
    }


def _random_status(batches):
    """Another status at every read, as a live database might have."""
    import random

    import pyarrow as pa

    for batch in batches:
        k = batch.schema.get_field_index("product_status")
        drawn = [random.choice(["Completed", "In Progress", "Planned", "Paused", None]) for _ in range(batch.num_rows)]
        yield batch.set_column(k, batch.schema.field(k), pa.array(drawn, pa.string()))


class ChangingSource(FrameSource):
    """Products change at every read; loads and rows read are counted."""

    def __init__(self, spark, frames):
        self.loads, self.rows = [], spark.sparkContext.accumulator(0)
        rows = self.rows

        def count(batches):
            for batch in _random_status(batches):
                rows.add(batch.num_rows)
                yield batch

        products = frames["uw_translation_products"]
        super().__init__(dict(frames, uw_translation_products=products.mapInArrow(count, products.schema)))

    def load(self, name):
        self.loads.append(name)
        return super().load(name)


@pytest.mark.parametrize("flow", ["live", "legacy"])
def test_each_input_is_read_once_and_outputs_agree(spark, small_tables, scratch, flow):
    frames = {n: small_tables[n] for n in FIXTURES}
    source = ChangingSource(spark, frames)
    sink = ParquetSink(os.path.join(scratch, "out"))
    report = run_job(spark, source, sink, flow=flow)
    assert sorted(source.loads) == sorted(LIVE_INPUTS)
    n = frames["uw_translation_products"].count()
    assert source.rows.value == n and report.inputs["uw_translation_products"] == n
    assert report.inputs == {name: frames[name].count() for name in LIVE_INPUTS}
    written = {name: spark.read.parquet(sink.path(name)) for name in OUTPUT_TABLES}
    projects, master = written["master_uw_translation_projects"], written["master_uw_language_engagements"]
    dim = master.drop("project_status")
    if flow == "live":
        again = live.engagement_master(dim, live.engagement_status(projects))
        goals = live.goal_coverage(frames["pb_language_data"], master)
    else:
        again = legacy.legacy_engagement_master(dim, legacy.legacy_engagement_status(projects))
        goals = legacy.legacy_goal_coverage(frames["pb_language_data"], live.engagement_org_rep(frames))
    assert _multiset(again.select(*master.columns)) == _multiset(master)
    assert _multiset(goals) == _multiset(written["pb_language_engagements"].select(*goals.columns))


@pytest.mark.parametrize("flow", ["live", "legacy"])
def test_rollup_reads_no_products(spark, small_tables, scratch, monkeypatch, flow):
    """Under the engagement output: two columns of the project output, no product table."""
    plans = {}
    write = ParquetSink.write

    def kept(self, df, name, folder):
        write(self, df, name, folder)
        plans[name] = df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(ParquetSink, "write", kept)
    run_job(spark, FrameSource({n: small_tables[n] for n in FIXTURES}), ParquetSink(os.path.join(scratch, "o")), flow=flow)
    scans = [x for x in plans["master_uw_language_engagements"].splitlines() if "FileScan" in x]
    key = "language_engagement_id:bigint" if flow == "live" else "subtag_new:string"
    written = [x for x in scans if "_versions/" in x]
    assert len(scans) == 2 and len(written) == 1, scans
    assert f"ReadSchema: struct<{key},project_status:string>" in written[0]


class BreakingSink(ParquetSink):
    def write(self, df, name, folder):
        if name == "master_uw_language_engagements":
            raise RuntimeError("disk full")
        super().write(df, name, folder)


def test_a_failure_between_two_outputs_leaves_the_old_three(spark, small_tables, scratch):
    root = os.path.join(scratch, "out")
    good = {n: small_tables[n] for n in FIXTURES}
    run_job(spark, FrameSource(good), ParquetSink(root))
    sink = ParquetSink(root)
    before, current = {n: _multiset(spark.read.parquet(sink.path(n))) for n in OUTPUT_TABLES}, sink.current()
    fewer = dict(good, uw_translation_products=good["uw_translation_products"].limit(7))
    with pytest.raises(RuntimeError, match="disk full"):
        run_job(spark, FrameSource(fewer), BreakingSink(root))
    assert sink.current() == current
    assert {n: _multiset(spark.read.parquet(sink.path(n))) for n in OUTPUT_TABLES} == before
    assert len(os.listdir(os.path.join(root, "_versions"))) == 1  # what was written is gone


def test_null_keys_are_reported_and_bounded(spark, small_tables, scratch):
    frames = {n: small_tables[n] for n in FIXTURES}
    nulls = F.lit(None).cast("string")
    goals = frames["pb_language_data"]
    frames["pb_language_data"] = goals.unionByName(goals.limit(3).withColumn("languagecode", nulls))
    codes = frames["ietf_languages_codes"]
    frames["ietf_languages_codes"] = codes.withColumn("iso_639_2", F.when(F.col("ietf_id") % 7 > 0, F.col("iso_639_2")))
    null_goals = frames["pb_language_data"].filter("languagecode is null").count()
    null_engagements = live.engagement_org_rep(frames).filter("iso_639_2 is null").count()
    dim = live.engagement_dimension(frames)
    null_dim = dim.filter("iso_639_2 is null").count()
    assert null_dim == null_goals * null_engagements > 3
    root = os.path.join(scratch, "out")
    report = run_job(spark, FrameSource(frames), ParquetSink(root))
    first, second = report.null_keys["goal attributes"], report.null_keys["goal coverage"]
    assert (first.left, first.right, first.rows) == (null_engagements, null_goals, dim.count())
    written = spark.read.parquet(ParquetSink(root).path("pb_language_engagements")).count()
    assert (second.left, second.right, second.rows) == (null_goals, null_dim, written)
    current = ParquetSink(root).current()
    for bound in (first.product - 1, second.product - 1):
        with pytest.raises(NullKeyProduct, match="NULL keys"):
            run_job(spark, FrameSource(frames), ParquetSink(root), null_product_limit=bound)
    assert ParquetSink(root).current() == current
    run_job(spark, FrameSource(frames), ParquetSink(root), null_product_limit=second.product)


def test_retired_rollup_keeps_tags_and_their_absence(spark, small_tables):
    """Tags from the lists beside the groups, NULL tags too, against the written rows of Output A."""
    tables = {name: small_tables[name] for name in FIXTURES}
    codes = tables["ietf_languages_codes"]
    shared = F.when(F.col("ietf_id") % 5 == 0, F.lit("shared")).when(F.col("ietf_id") % 3 > 0, F.col("subtag_new"))
    tables["ietf_languages_codes"] = codes.withColumn("subtag_new", shared)
    projects = legacy.legacy_project_status(tables, method="window")
    want = legacy.legacy_engagement_status(projects)
    got = legacy.legacy_engagement_status(legacy.legacy_status_classes(tables))
    assert _multiset(got.select(*want.columns)) == _multiset(want)
    tags = {r[0] for r in want.select("subtag_new").collect()}
    assert None in tags and "shared" in tags
