"""Reference-shaped input tables derived from the TPC-H-like test tables.

The reference reads twelve tables from a relational database. The test data
holds TPC-H-like tables instead, so each reference table is defined here as a
view over them. Every view has a row for every row of its base tables, so its
size grows with the scale factor; the modulo expressions shape values (which
rows carry NULLs, which codes collide, which match nothing) and drop no row.

The same shapes are written in DuckDB SQL in ``tessera.oracle`` so the driver
can compare the two engines.
"""

from __future__ import annotations

import os
import weakref
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import null_string
from tessera.sources.schemas import REFERENCE_SCHEMAS, conform

_null = null_string


def _tag(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


class TestTables:
    """Lazy access to the parquet test tables of one scale factor."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._cache[name]


# --- the reference tables -------------------------------------------------


def ietf_languages_codes(t: TestTables) -> DataFrame:
    p = t["part"]
    key, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        key.alias("ietf_id"),
        F.col("p_name").alias("primary_anglicized_name"),
        F.when(size % 3 == 0, F.lit(""))
        .when(size % 7 == 0, _null())
        .otherwise(F.col("p_type"))
        .alias("alternative_names"),
        _tag("st", key).alias("subtag_new"),
        F.when(key % 17 == 0, _null()).otherwise(_tag("i", key - key % 5)).alias("iso_639_2"),
    )


def language_engagements(t: TestTables) -> DataFrame:
    c = t["customer"]
    key = F.col("c_custkey")
    return c.select(
        key.alias("language_engagement_id"),
        F.when(key % 41 == 40, F.lit(None).cast("bigint")).otherwise(key - key % 3).alias("ietf_id"),
        F.when(key % 13 == 0, _null()).otherwise(_tag("C", F.col("c_nationkey"))).alias("country_id"),
        (key % 9).alias("uw_rep_id"),
        (key % 12).alias("translation_organization_id"),
    )


def sli_language_data(t: TestTables) -> DataFrame:
    p = t["part"]
    key, size = F.col("p_partkey"), F.col("p_size")
    levels = p.select(
        F.when(size <= 25, _tag("st", key)).otherwise(_tag("none", key)).alias("bcp47"),
        (size % 5).alias("resource_level"),
    )
    repeats = p.select(
        F.when(size <= 5, _tag("st", key)).otherwise(_tag("nil", key)).alias("bcp47"),
        F.lit(9).alias("resource_level"),
    )
    return levels.unionByName(repeats)


def countries(t: TestTables) -> DataFrame:
    n, r = t["nation"], t["region"]
    key = F.col("n_nationkey")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.when(key < 22, _tag("C", key)).otherwise(_tag("X", key)).alias("alpha_3_code"),
        F.when(key < 22, _tag("c", key)).otherwise(_tag("x", key)).alias("alpha_2_code"),
        F.col("n_name").alias("english_short_name"),
        F.col("r_name").alias("world_region"),
    )


def organizations(t: TestTables) -> DataFrame:
    s = t["supplier"]
    key = F.col("s_suppkey")
    return s.select(
        F.when(key % 11 != 7, key).otherwise(-key).alias("org_id"),
        F.col("s_name").alias("name"),
        _tag("S", key).alias("abbreviation"),
        F.when(key % 3 == 0, "Unrestricted")
        .when(key % 3 == 1, "Restricted")
        .otherwise("Confidential")
        .alias("sensitivity"),
    )


def uw_reps(t: TestTables) -> DataFrame:
    s = t["supplier"]
    key = F.col("s_suppkey")
    return s.select(
        F.when(key != 8, key).otherwise(-key).alias("uw_rep_id"),
        F.col("s_name").alias("first_name"),
        F.col("s_name").alias("last_name"),
    )


def pb_language_data(t: TestTables) -> DataFrame:
    p = t["part"]
    key, size = F.col("p_partkey"), F.col("p_size")
    status = (
        F.when(size % 6 == 0, "Translation in Progress")
        .when(size % 6 == 1, "Translation Not Started")
        .when(size % 6 == 2, "Not Shown")
        .when(size % 6 == 3, "Goal Met")
        .when(size % 6 == 4, "")
        .otherwise(_null())
    )
    return p.select(
        F.when(key == 0, _null())
        .when(key % 5 == 0, _tag("i", key))
        .otherwise(_tag("u", key))
        .alias("languagecode"),
        F.col("p_name").alias("languagename"),
        F.col("p_type").alias("country"),
        _tag("C", key % 25).alias("countrycode"),
        status.alias("allaccessstatus"),
        F.col("p_brand").alias("allaccessgoal"),
        F.when(size % 2 == 0, "Yes").otherwise("No").alias("activetranslation"),
        F.when(size % 4 == 0, _null()).otherwise(F.col("p_type")).alias("completedscripture"),
        F.when(size % 5 == 0, F.lit(None).cast("int")).otherwise(F.lit(1970) + size).alias(
            "latestpublicationyear"
        ),
    )


def bible_info(t: TestTables) -> DataFrame:
    """Sixty-six books and one NULL, each listed as often as parts have its number."""
    key = F.col("p_partkey") % 67
    return t["part"].select(
        F.when(key == 66, _null()).otherwise(_tag("BK", key)).alias("scriptural_association"),
        F.when((key < 39) | (key == 66), "OT").otherwise("NT").alias("bible_section"),
    )


def uw_translation_products(t: TestTables) -> DataFrame:
    li, o = t["lineitem"], t["orders"]
    cust = F.col("o_custkey")
    orders = o.select(
        "o_orderkey",
        "o_orderstatus",
        F.when(cust % 100 < 50, cust - cust % 50).otherwise(cust).alias("language_engagement_id"),
    )
    x = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    eng = F.col("language_engagement_id")
    line, qty = F.col("l_linenumber"), F.col("l_quantity")
    part70 = F.col("l_partkey") % 70
    status = (
        F.when(eng % 7 == 0, "Completed")
        .when(eng % 7 == 1, F.when((line == 7) & (qty < 5), _null()).otherwise("Planned"))
        .when(eng % 7 == 2, F.when(line == 1, "In Progress").otherwise("Completed"))
        .when(eng % 7 == 3, F.when(line <= 3, "Not Scheduled").otherwise("Completed"))
        .when(
            eng % 7 == 4,
            F.when(line <= 2, "Paused").when(qty < 3, _null()).otherwise("Completed"),
        )
        .when(
            eng % 7 == 5,
            F.when((line == 1) & (qty < 10), "Inactive").otherwise("Completed"),
        )
        .otherwise(F.when(qty < 5, _null()).otherwise("Not Scheduled"))
    )
    return x.select(
        eng,
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_returnflag") == "N", "BP")
        .when(F.col("l_returnflag") == "R", "Scripture Text")
        .when(F.col("l_linestatus") == "F", "OBS")
        .otherwise("EJ")
        .alias("resource_package"),
        F.when(F.col("o_orderstatus") == "P", "Audio").otherwise("Text").alias("resource_format"),
        F.when(part70 < 66, _tag("BK", part70))
        .when(part70 == 66, "Bible")
        .when(part70 == 67, "NT")
        .when(part70 == 68, "OT")
        .otherwise(_null())
        .alias("scriptural_association"),
        F.when(F.col("l_suppkey") % 3 == 0, "")
        .when(F.col("l_suppkey") % 3 == 1, _null())
        .otherwise("Draft")
        .alias("scripture_text_name"),
        status.alias("product_status"),
    )


def training_events(t: TestTables) -> DataFrame:
    e = t["events"]
    kind = F.col("event_type")
    return e.select(
        "event_id",
        F.when(kind == "error", "Networks PR")
        .when(kind == "signup", _null())
        .otherwise(kind)
        .alias("Category of Training"),
    )


def joshua_project_data(t: TestTables) -> DataFrame:
    """People groups per country (read, unused by the live flow)."""
    c = t["customer"]
    key = F.col("c_custkey")
    return c.select(
        F.col("c_name").alias("PeopNameInCountry"),
        F.when(key % 19 == 0, _null()).otherwise(_tag("R", F.col("c_nationkey"))).alias("ROG3"),
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("LeastReached"),
        F.col("c_mktsegment").alias("PrimaryLanguageName"),
        _tag("i", (key % 400) * 5).alias("ROL3"),
        ((key * 37) % 100000).alias("Population"),
    )


def language_engagements_organizations(t: TestTables) -> DataFrame:
    """Engagement-to-organization link table (read, unused by the live flow)."""
    c = t["customer"]
    key = F.col("c_custkey")
    return c.select(key.alias("language_engagement_id"), (key % 12).alias("org_id"))


# --- derived inputs for the retired (commented-out) operators --------------


def engagement_org_lists(t: TestTables) -> DataFrame:
    """Engagements with their translating organizations as a JSON array text.

    Covers one to three elements, repeated ids, ids with no organization, an
    empty array, a NULL and malformed text.
    """
    c = t["customer"]
    key = F.col("c_custkey")
    a = (key % 97).cast("string")
    b = ((key * 7) % 113).cast("string")
    d = F.col("c_nationkey").cast("string")
    shape = key % 10
    text = (
        F.when(shape == 0, F.lit("[]"))
        .when(shape == 1, _null())
        .when(shape == 2, F.lit("not json"))
        .when(shape == 3, F.concat(F.lit("["), a, F.lit("]")))
        .when(shape <= 6, F.concat(F.lit("["), a, F.lit(", "), b, F.lit("]")))
        .otherwise(F.concat(F.lit("["), a, F.lit(", "), b, F.lit(", "), d, F.lit("]")))
    )
    return c.select(key.alias("language_engagement_id"), text.alias("translating_organization"))


def order_date_text(t: TestTables) -> DataFrame:
    """Order dates in the mixed text forms a tracker accumulates, in two columns.

    Month first with any separator, none, a month name, two-digit years on
    either side of the century cutoff; ISO with dashes, slashes and times;
    padded text; text that is no date; NULL.
    """
    o = t["orders"]
    key, d = F.col("o_orderkey"), F.col("o_orderdate")
    two_digits = F.concat(F.date_format(d, "M/d/"), F.lpad((key % 100).cast("string"), 2, "0"))
    forms = [
        F.date_format(d, "M/d/yyyy"),
        F.date_format(d, "yyyy-MM-dd"),
        F.date_format(d, "MMMM d, yyyy"),
        F.date_format(d, "M-d-yyyy"),
        F.date_format(d, "MMM d, yyyy"),
        F.lit("not a date"),
        _null(),
        two_digits,
        F.date_format(d, "yyyy/MM/dd"),
        F.date_format(d, "yyyy-MM-dd HH:mm:ss"),
        F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
        F.date_format(d, "MM.dd.yyyy"),
        F.date_format(d, "MMddyyyy"),
        F.date_format(d, "MMM d yyyy"),
        F.date_format(d, "MMMM d yyyy"),
        F.concat(F.lit(" "), F.date_format(d, "M/d/yyyy"), F.lit(" ")),
        F.date_format(d, "M / d / yyyy"),
        F.lit("13/45/2000"),
    ]

    def text(shape: Column) -> Column:
        out = F.when(shape == 0, forms[0])
        for k, form in enumerate(forms[1:], start=1):
            out = out.when(shape == k, form)
        return out

    n = len(forms)
    return o.select(
        "o_orderkey",
        text(key % n).alias("start_date"),
        text((key * 5 + 3) % n).alias("published_date"),
    )


def event_documents(t: TestTables) -> DataFrame:
    """An API response for every event: a JSON document that holds an array of records.

    One to three records a document, each with a nested object, a list and a
    field that is absent from some; an empty array, a NULL and malformed text.
    """
    e = t["events"]
    key = F.col("event_id")

    def record(n: int) -> Column:
        number = (key * 10 + n).cast("string")
        level = F.when((key + n) % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit(', "level": '), ((key + n) % 7).cast("string"))
        )
        return F.concat(
            F.lit('{"id": '), number, F.lit(', "languageName": "'), F.col("event_type"), F.lit(f'-{n}", '),
            F.lit('"geo": {"country": {"code": "'), _tag("C", (key + n) % 25), F.lit('"}, "size": '), number,
            F.lit('}, "tags": ["a'), number, F.lit('", "b"]'), level, F.lit("}"),
        )

    records = [record(n) for n in range(3)]
    shape = key % 12
    body = (
        F.when(shape == 0, F.lit(""))
        .when(shape <= 4, records[0])
        .when(shape <= 8, F.concat_ws(", ", *records[:2]))
        .otherwise(F.concat_ws(", ", *records))
    )
    text = (
        F.when(shape == 9, _null())
        .when(shape == 10, F.lit('{"resource": [{"id": '))
        .otherwise(F.concat(F.lit('{"resource": ['), body, F.lit("]}")))
    )
    return e.select("event_id", text.alias("document"))


def country_cross_reference(t: TestTables) -> DataFrame:
    """Country code cross reference (one code per nation; one NULL code)."""
    n = t["nation"]
    key = F.col("n_nationkey")
    return n.select(
        F.when(key == 5, _null()).otherwise(_tag("R", key)).alias("ROG3"),
        _tag("c", key).alias("ISO2"),
        F.upper(F.col("n_name")).alias("Ctry"),
    )


def resource_document(t: TestTables) -> DataFrame:
    """A flattened API document whose column names carry a ``resource.`` prefix."""
    p = t["part"]
    return p.select(
        F.col("p_partkey").alias("resource.id"),
        F.col("p_name").alias("resource.languageName"),
        F.col("p_type").alias("resource.country"),
        F.col("p_size").alias("resourcesize"),
        F.col("p_brand").alias("brand"),
    )


FIXTURES: dict[str, Callable[[TestTables], DataFrame]] = {
    "bible_info": bible_info,
    "countries": countries,
    "ietf_languages_codes": ietf_languages_codes,
    "joshua_project_data": joshua_project_data,
    "language_engagements": language_engagements,
    "language_engagements_organizations": language_engagements_organizations,
    "organizations": organizations,
    "pb_language_data": pb_language_data,
    "sli_language_data": sli_language_data,
    "training_events": training_events,
    "uw_reps": uw_reps,
    "uw_translation_products": uw_translation_products,
    "engagement_org_lists": engagement_org_lists,
    "order_date_text": order_date_text,
    "event_documents": event_documents,
    "country_cross_reference": country_cross_reference,
    "resource_document": resource_document,
}


class FixtureTables(Mapping):
    """Fixture views by name, built on first use; base tables pass through."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.base = TestTables(spark, sf_dir)
        self._views: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in FIXTURES:
            if name not in self._views:
                view = FIXTURES[name](self.base)
                # the same load-time check a real source gets
                self._views[name] = conform(view, name) if name in REFERENCE_SCHEMAS else view
            return self._views[name]
        return self.base[name]

    def __iter__(self):
        return iter(FIXTURES)

    def __len__(self) -> int:
        return len(FIXTURES)

    # Identity semantics, so plans built from these tables can be memoized.
    __hash__ = object.__hash__

    def __eq__(self, other: object) -> bool:
        return self is other


_SESSIONS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def fixture_frames(spark: SparkSession, sf_dir: str) -> FixtureTables:
    """All fixture views over one scale factor, built lazily, once per session."""
    per_session = _SESSIONS.setdefault(spark, {})
    if sf_dir not in per_session:
        per_session[sf_dir] = FixtureTables(spark, sf_dir)
    return per_session[sf_dir]
