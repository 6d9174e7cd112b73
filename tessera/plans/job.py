"""The daily job: read the inputs once, compute the three outputs, replace them together.

Every input is copied first, cut to the columns that the flow reads, and all
three outputs are computed from that one state: a source that changes during a
run, or that is read over JDBC, is seen as it was once. The copies, and the
engagement dimension that the outputs share, are Parquet in the folder that the
cluster names in ``spark.checkpoint.dir``; a lost executor never forces a second
read of a source. They are deleted when the job ends, whether or not it succeeds.

The rollup reads two columns of the project output that was just written, so no
status is derived twice. The sink makes the three outputs current in one last
step; a failure before it leaves yesterday's tables together.

NULL keys match NULL keys in the goal joins, as in the reference, which
multiplies them. Their numbers on both sides and the rows that come out are
observed while the tables are written, and a caller's bound on the product
stops the job before anything is replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import col
from tessera.plans import legacy, live
from tessera.sources.readers import TableSource
from tessera.sources.schemas import REFERENCE_SCHEMAS
from tessera.sources.sinks import TableSink

# The tables that the live flow reads.
LIVE_INPUTS = (
    "bible_info",
    "countries",
    "ietf_languages_codes",
    "language_engagements",
    "organizations",
    "pb_language_data",
    "sli_language_data",
    "uw_reps",
    "uw_translation_products",
)
# Every column of these goes into an output or a natural join; of the others only
# the declared columns are read.
WHOLE_INPUTS = ("uw_translation_products", "language_engagements", "ietf_languages_codes")

PROJECTS = "master_uw_translation_projects"
ENGAGEMENTS = "master_uw_language_engagements"
GOALS = "pb_language_engagements"


class NullKeyProduct(ValueError):
    """NULL keys on both sides of a join multiply beyond the bound that the caller gave."""


@dataclass(frozen=True)
class NullKeys:
    """What a NULL-safe join met: NULL keys on either side, and rows out."""

    left: int
    right: int
    rows: int

    @property
    def product(self) -> int:
        return self.left * self.right


@dataclass(frozen=True)
class JobReport:
    outputs: Mapping[str, str]
    inputs: Mapping[str, int]
    null_keys: Mapping[str, NullKeys]


class Staging:
    """Tables of one run under the shared checkpoint directory, deleted on exit."""

    def __init__(self, spark: SparkSession, name: str = "job"):
        base = spark.sparkContext.getCheckpointDir()
        if not base:
            raise ValueError("set spark.checkpoint.dir to a directory that the driver and all executors share")
        self.spark = spark
        self.root = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return it read back."""
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _observed(df: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """``df``, counting its rows and its NULL keys as they pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(col(key).isNull()).alias("nulls")), seen


def snapshot(source: TableSource, staging: Staging) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Each input copied in one read, and its rows. The copies are written side by side."""
    counted: dict[str, Observation] = {}

    def copy(name: str) -> DataFrame:
        df = source.load_checked(name)
        if name not in WHOLE_INPUTS:
            df = df.select(*[col(f.name) for f in REFERENCE_SCHEMAS[name].fields])
        df, counted[name] = _observed(df, df.columns[0])
        return staging.save(df, f"in_{name}")

    with ThreadPoolExecutor(4) as pool:
        tables = dict(zip(LIVE_INPUTS, pool.map(copy, LIVE_INPUTS)))
    return tables, {name: seen.get["rows"] for name, seen in counted.items()}


def run_job(
    spark: SparkSession,
    source: TableSource,
    sink: TableSink,
    flow: str = "live",
    null_product_limit: int | None = None,
) -> JobReport:
    """Run one flow end to end; reports output tables by role, input rows and NULL keys.

    ``null_product_limit`` bounds NULL keys left times NULL keys right in each
    of the two goal joins; beyond it :class:`NullKeyProduct` is raised and no
    output is replaced.
    """
    if flow not in ("live", "legacy"):
        raise ValueError(f"unknown flow {flow!r}")

    def check(name: str, keys: NullKeys) -> NullKeys:
        if null_product_limit is not None and keys.product > null_product_limit:
            raise NullKeyProduct(f"{name}: {keys.left} x {keys.right} NULL keys, the bound is {null_product_limit}")
        return keys

    with Staging(spark) as staging:
        tables, inputs = snapshot(source, staging)
        goals = tables["pb_language_data"]
        # Engagements as they were before goals are attached: both goal joins start from them.
        engagements, seen = _observed(live.engagement_org_rep(tables), "iso_639_2")
        engagements = staging.save(engagements, "engagements_before_goals")
        null_goals = goals.filter(col("languagecode").isNull()).count()
        before = check("goal attributes", NullKeys(seen.get["nulls"], null_goals, 0))
        dim, seen = _observed(live.engagement_dimension(tables, engagements), "iso_639_2")
        dim = staging.save(dim, "engagement_dimension")
        null_keys = {"goal attributes": NullKeys(before.left, before.right, seen.get["rows"])}
        right = seen.get["nulls"] if flow == "live" else before.left
        check("goal coverage", NullKeys(null_goals, right, 0))

        replacement = sink.replacement(staging.save)
        try:
            if flow == "live":
                projects = replacement.save(live.project_status(tables, dimension=dim), PROJECTS)
                master = live.engagement_master(dim, live.engagement_status(projects))
            else:
                projects = replacement.save(legacy.legacy_project_status(tables, dim), PROJECTS)
                master = legacy.legacy_engagement_master(dim, legacy.legacy_engagement_status(projects))
            master = replacement.save(master, ENGAGEMENTS)
            if flow == "live":
                # The dimension holds all of the engagements' codes.
                coverage = live.goal_coverage(goals, master, dim)
            else:
                coverage = legacy.legacy_goal_coverage(goals, engagements)
            coverage, seen = _observed(coverage, "iso_639_2")
            replacement.save(coverage, GOALS)
            null_keys["goal coverage"] = NullKeys(null_goals, right, seen.get["rows"])
            replacement.commit()
        except BaseException:
            replacement.abort()
            raise
    return JobReport(
        {"projects": PROJECTS, "engagements": ENGAGEMENTS, "goals": GOALS}, inputs, null_keys
    )
