"""The live flow: engagement dimension, product status, rollup, goal coverage.

Each stage is a function from DataFrames to a DataFrame so it can be run,
tested and explained on its own. ``tables`` is a mapping from reference table
name to DataFrame (see :mod:`tessera.sources`).

Physical plan at scale (checked with ``explain``):

* the engagement dimension is a chain of equi-joins on different keys; small
  lookups become broadcast joins from measured sizes, large ones sort-merge;
* products are reduced to one row a group by a partial aggregate, groups are
  joined to the dimension, and products join that group table once on their
  group keys (AQE splits a hot group);
* rollups read status classes, a partial aggregate of products, and are a
  partial ``min`` over a priority rank: no product row is shuffled for them.

One plan holds at all sizes: nothing here counts rows, hints or caches, and
building a query reads no more than Parquet footers.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import status as st
from tessera.functions.text import blank_to_null, combined_name, completed_scripture_label, yes_no
from tessera.operators.joins import (
    add_membership_flags,
    col,
    left_join_split,
    membership_lookup,
    natural_join,
    null_safe_join,
)
from tessera.operators.rollup import best_by_priority, pivot_presence
from tessera.operators.rules import GroupValue, first_match, with_group_values

Tables = Mapping[str, DataFrame]

ENGAGEMENT_KEY = "language_engagement_id"

# Lazy plans shared by several outputs, built once per input set. Holding a
# DataFrame holds only its plan; nothing is cached in memory.
_PLANS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def memo(tables: Tables, key: object, build: Callable[[], DataFrame]) -> DataFrame:
    try:
        plans = _PLANS.setdefault(tables, {})
    except TypeError:  # plain dicts cannot be weakly referenced
        return build()
    if key not in plans:
        plans[key] = build()
    return plans[key]

# The engagement columns kept after the language joins.
LOCALE_COLUMNS = (
    "language_engagement_id",
    "ietf_id",
    "primary_anglicized_name",
    "alternative_names",
    "subtag_new",
    "resource_level",
    "country_id",
    "uw_rep_id",
    "translation_organization_id",
    "iso_639_2",
)
COUNTRY_COLUMNS = ("alpha_2_code", "english_short_name", "world_region")
ORGANIZATION_COLUMNS = ("name", "abbreviation", "sensitivity")

# The engagement dimension, in output order.
ENGAGEMENT_COLUMNS = (
    "language_engagement_id",
    "ietf_id",
    "primary_anglicized_name",
    "alternative_names",
    "subtag_new",
    "resource_level",
    "english_short_name",
    "country_id",
    "abbreviation",
    "uw_rep_id",
    "name",
    "translation_organization_id",
    "iso_639_2",
    "world_region",
    "alpha_2_code",
    "sensitivity",
    "activetranslation",
    "allaccessstatus",
    "allaccessgoal",
    "aag_elligible",
    "combined_anglicized_name",
    "completed_scripture",
)

# Goal-language report columns.
GOAL_COLUMNS = (
    "languagename",
    "iso_639_2",
    "country",
    "countrycode",
    "allaccessstatus",
    "allaccessgoal",
    "aag_elligible",
    "has_uw_engagement",
    "uw_project_status",
)

BIBLE_FLAGS = {"OT": "__is_ot", "NT": "__is_nt"}


def engagement_locale(tables: Tables) -> DataFrame:
    """Engagements with their language codes, resource level and country."""
    eng = tables["language_engagements"]
    ietf = tables["ietf_languages_codes"]
    sli = tables["sli_language_data"].select("bcp47", "resource_level")
    x = natural_join(eng, ietf, ["ietf_id"], "inner")
    x = null_safe_join(x, sli, {"subtag_new": "bcp47"}, "left").select(*LOCALE_COLUMNS)
    countries = tables["countries"].select("alpha_3_code", *COUNTRY_COLUMNS)
    return null_safe_join(x, countries, {"country_id": "alpha_3_code"}, "left")


def engagement_org_rep(tables: Tables) -> DataFrame:
    """Keep engagements that have an organization and a representative."""
    x = engagement_locale(tables)
    orgs = tables["organizations"].select("org_id", *ORGANIZATION_COLUMNS)
    reps = tables["uw_reps"]
    x = null_safe_join(x, orgs, {"translation_organization_id": "org_id"}, "inner")
    x = null_safe_join(x, reps.select("uw_rep_id", "first_name", "last_name"), "uw_rep_id", "inner")
    return x.drop("first_name", "last_name")


def engagement_dimension(tables: Tables, engagements: DataFrame | None = None) -> DataFrame:
    """The 22-column engagement dimension with goal eligibility and labels.

    ``engagements`` may be :func:`engagement_org_rep` where that was written before.
    """
    if engagements is not None:
        return _engagement_dimension(tables, engagements)
    return memo(tables, "engagement_dimension", lambda: _engagement_dimension(tables, engagement_org_rep(tables)))


def _engagement_dimension(tables: Tables, x: DataFrame) -> DataFrame:
    goals = tables["pb_language_data"]
    year_type = goals.schema["latestpublicationyear"].dataType
    goals = goals.select(
        "languagecode",
        "activetranslation",
        "allaccessstatus",
        "allaccessgoal",
        "completedscripture",
        "latestpublicationyear",
    )
    x = null_safe_join(x, goals, {"iso_639_2": "languagecode"}, "left")
    x = x.withColumns(
        {
            "aag_elligible": st.aag_eligibility(col("allaccessstatus")),
            "combined_anglicized_name": combined_name(
                col("primary_anglicized_name"), col("alternative_names")
            ),
            "completed_scripture": completed_scripture_label(
                col("completedscripture"), col("latestpublicationyear"), year_type
            ),
        }
    )
    return x.select(*ENGAGEMENT_COLUMNS)


def section_lookup(tables: Tables) -> DataFrame:
    """One row per scriptural association with its OT / NT membership."""
    return memo(
        tables,
        "section_lookup",
        lambda: membership_lookup(
            tables["bible_info"], "scriptural_association", "bible_section", BIBLE_FLAGS
        ),
    )


def section_membership(tables: Tables) -> DataFrame:
    """Every product with its association's OT / NT list membership (``%in%``)."""
    products = tables["uw_translation_products"].select(
        ENGAGEMENT_KEY, "l_orderkey", "l_linenumber", "scriptural_association"
    )
    return add_membership_flags(
        products, "scriptural_association", section_lookup(tables)
    ).withColumnsRenamed({"__is_ot": "in_ot_list", "__is_nt": "in_nt_list"})


def flagged_products(tables: Tables, keep_flags: bool = False) -> DataFrame:
    """Products with ``bible_book_ref``; blank text names become NULL.

    The section lookup holds one row an association, so Spark broadcasts it
    from its size and this stays a map-side step. With ``keep_flags`` the row's
    OT/NT membership columns are kept (the retired rules read them).
    """

    def build() -> DataFrame:
        products = tables["uw_translation_products"]
        product_cols = products.columns
        flagged = add_membership_flags(
            products, "scriptural_association", section_lookup(tables)
        ).withColumns(
            {
                "bible_book_ref": st.book_ref(
                    col("resource_package"),
                    col("__is_ot"),
                    col("__is_nt"),
                    col("scriptural_association"),
                ),
                "scripture_text_name": blank_to_null(col("scripture_text_name")),
            }
        )
        flags = list(BIBLE_FLAGS.values()) if keep_flags else []
        return flagged.select(*[col(c) for c in (*product_cols, "bible_book_ref", *flags)])

    return memo(tables, ("flagged_products", keep_flags), build)


def prepared_products(
    tables: Tables, dimension: DataFrame | None = None, keep_flags: bool = False
) -> DataFrame:
    """Products joined to the engagement dimension, with ``bible_book_ref``."""
    dim = dimension if dimension is not None else engagement_dimension(tables)
    flagged = flagged_products(tables, keep_flags)
    product_cols = [c for c in flagged.columns if c != "bible_book_ref" and c not in BIBLE_FLAGS.values()]
    x = natural_join(flagged, dim, [ENGAGEMENT_KEY], "inner")
    dim_rest = [c for c in dim.columns if c != ENGAGEMENT_KEY]
    out = [*product_cols, *dim_rest, "bible_book_ref"]
    if keep_flags:
        out += list(BIBLE_FLAGS.values())
    return x.select(*[col(c) for c in out])


def _split_keys(keys: Sequence[str], flagged: DataFrame, dim: DataFrame) -> tuple[list[str], list[str]]:
    """Group keys on the product rows (the engagement first) and on the dimension."""
    own = [k for k in keys if k in flagged.columns and k != ENGAGEMENT_KEY]
    from_dim = [k for k in keys if k not in flagged.columns]
    missing = [k for k in from_dim if k not in dim.columns]
    if missing:
        raise ValueError(f"group keys on neither products nor dimension: {missing}")
    if not from_dim and ENGAGEMENT_KEY not in keys:
        raise ValueError("groups need the engagement or a dimension column among their keys")
    return [ENGAGEMENT_KEY, *own], from_dim


def _fan_out(dim: DataFrame, by: Sequence[str]) -> DataFrame:
    """How many dimension rows hold each combination of ``by``."""
    return dim.groupBy(*[col(k).alias(k) for k in by]).agg(F.count(F.lit(1)).alias("__fan_out"))


def _packed(values: Mapping[str, GroupValue]) -> Column:
    """A part's size and its yes/no values as one number, the size in the high bits.

    Two branches read a part's values and its keys; as one number is either
    needed whole or not at all, both branches read the same aggregate, which
    Spark then runs once.
    """
    flags = [n for n in values if n != st.COUNT_COL]
    packed = col(st.COUNT_COL) * F.lit(1 << len(flags))
    for k, name in enumerate(flags):
        packed = packed + col(name).cast("bigint") * F.lit(1 << k)
    return packed


def _unpacked(packed: Column, values: Mapping[str, GroupValue]) -> dict[str, Column]:
    flags = [n for n in values if n != st.COUNT_COL]
    out = {n: packed.bitwiseAND(F.lit(1 << k)) != 0 for k, n in enumerate(flags)}
    return {n: out.get(n, F.shiftright(packed, len(flags))) for n in values}


def _display_summary(dim: DataFrame, from_dim: Sequence[str], attach: str | None = None) -> DataFrame:
    """One row for each engagement and display columns, with how many dimension rows have them.

    The number stands first in the list ``__weight``; after it, a list each, the
    distinct values of ``attach``. They are one column for the reason given
    in :func:`_packed`, and lists in a list because a list of values loses NULL.
    """
    number = F.array(F.array(F.count(F.lit(1)).cast("string")))
    keys = [col(k).alias(k) for k in (ENGAGEMENT_KEY, *from_dim)]
    listed = F.concat(number, F.collect_set(F.array(col(attach).cast("string")))) if attach else number
    return dim.groupBy(*keys).agg(listed.alias("__weight"))


def _across_engagements(
    parts: DataFrame,
    summary: DataFrame,
    own: Sequence[str],
    from_dim: Sequence[str],
    values: Mapping[str, GroupValue],
) -> DataFrame:
    """Values of groups keyed by dimension columns, on each engagement's parts of them.

    ``parts`` holds one row for each ``own`` keys with the parts' values, packed.
    A part counts once for each dimension row with the same display columns.
    """
    placed = null_safe_join(parts.filter(col("__packed") > 0), summary, ENGAGEMENT_KEY, "inner")
    group = [*from_dim, *own[1:]]
    of_part = _unpacked(col("__packed"), values)
    rows = F.get(F.get(col("__weight"), 0), 0).cast("bigint")
    merged = placed.groupBy(*[col(k).alias(k) for k in group]).agg(
        *[v.merged(of_part[n], rows).alias(n) for n, v in values.items()]
    )
    return null_safe_join(placed.drop("__packed"), merged, group, "inner")


def status_groups(
    flagged: DataFrame, dim: DataFrame, keys: Sequence[str], values: Mapping[str, GroupValue]
) -> tuple[DataFrame, list[str]]:
    """Every group with its values beside every dimension row it has, and the product keys.

    The group size counts joined rows, so a product whose engagement has
    ``m`` dimension rows counts ``m`` times; any/all are unchanged by that.
    Products are read once, through a partial aggregate to one row for each
    product key; from there on everything is as large as groups.

    * Keys on the product rows: the size is ``n * m``, with ``m`` counted over
      the dimension's rows of the engagement.
    * Keys taken from the dimension (country, display name) span engagements:
      values are merged over them, and the dimension is read a second time to
      put its columns back.
    """
    own, from_dim = _split_keys(keys, flagged, dim)
    parts = flagged.groupBy(*[col(k).alias(k) for k in own]).agg(*[v().alias(n) for n, v in values.items()])
    if not from_dim:
        counted = dim.withColumn("__fan_out", F.count(F.lit(1)).over(Window.partitionBy(col(ENGAGEMENT_KEY))))
        groups = null_safe_join(parts, counted, ENGAGEMENT_KEY, "inner")
        return groups.withColumn(st.COUNT_COL, col(st.COUNT_COL) * col("__fan_out")).drop("__fan_out"), own
    parts = parts.withColumn("__packed", _packed(values)).drop(*values)
    groups = _across_engagements(parts, _display_summary(dim, from_dim), own, from_dim, values).drop("__weight")
    return null_safe_join(groups, dim, [ENGAGEMENT_KEY, *from_dim], "inner"), own


def status_products(
    tables: Tables,
    dimension: DataFrame | None,
    keys: Sequence[str],
    values: Mapping[str, GroupValue],
    rules: list,
    keep_flags: bool = False,
) -> DataFrame:
    """Output A layout: products, dimension columns, ``bible_book_ref``, size and status.

    After the partial aggregate behind :func:`status_groups` the products are
    shuffled once, by their group keys, to meet the group table.
    """
    flagged = flagged_products(tables, keep_flags)
    dim = dimension if dimension is not None else engagement_dimension(tables)
    groups, own = status_groups(flagged, dim, keys, values)
    x = null_safe_join(flagged, groups, own, "inner")
    hidden = ("bible_book_ref", *BIBLE_FLAGS.values())
    product_cols = [c for c in flagged.columns if c not in hidden]
    dim_rest = [c for c in dim.columns if c != ENGAGEMENT_KEY]
    return x.select(
        *[col(c) for c in (*product_cols, *dim_rest, "bible_book_ref", st.COUNT_COL)],
        first_match(rules).alias(st.STATUS_COL),
    )


# What a rule can read from a product besides its group keys.
_CLASS_COLUMNS = ("resource_package", "bible_book_ref", "scriptural_association", "product_status")


def status_classes(
    tables: Tables,
    dimension: DataFrame | None = None,
    keys: Sequence[str] = st.LIVE_GROUP_KEYS,
    values: Mapping[str, GroupValue] | None = None,
    rules: list | None = None,
    keep_flags: bool = False,
    attach: str | None = None,
) -> DataFrame:
    """``(engagement or attach, status)`` for every class of product rows the rules tell apart.

    Rules read a product's group, status, package and reference, and whether
    its association stands for a whole text. Products equal in those are one
    class, made by a partial aggregate, and get one status: the same pairs of
    engagement and status as the product rows have, without shuffling those.

    Where groups span engagements, ``attach`` may name a text column of the
    dimension that takes the engagement's place: its values come as lists with
    the weights of the groups, and the classes of a group as one short list, so
    neither dimension nor classes are joined again.
    """
    values = dict(values if values is not None else st.live_group_values())
    rules = rules if rules is not None else st.live_rules()
    flagged = flagged_products(tables, keep_flags).withColumn(
        "scriptural_association",
        F.when(col("scriptural_association").isin(*st.WHOLE_TEXT_ASSOCIATIONS), col("scriptural_association")),
    )
    dim = dimension if dimension is not None else engagement_dimension(tables)
    own, from_dim = _split_keys(keys, flagged, dim)
    flags = [c for c in BIBLE_FLAGS.values() if c in flagged.columns]
    class_keys = list(dict.fromkeys([*own, *_CLASS_COLUMNS, *flags]))
    classes = flagged.groupBy(*[col(k).alias(k) for k in class_keys]).agg(F.count(F.lit(1)).alias("__rows"))
    status = first_match(rules).alias(st.STATUS_COL)
    if not from_dim:
        if attach:
            raise ValueError("attach needs groups that span engagements")
        # The classes of one set of product keys are as few as statuses and flags allow.
        same = Window.partitionBy(*[col(k) for k in own])
        valued = classes.withColumns({n: v(same, col("__rows")) for n, v in values.items()}).drop("__rows")
        valued = null_safe_join(valued, _fan_out(dim, [ENGAGEMENT_KEY]), ENGAGEMENT_KEY, "inner")
        valued = valued.withColumn(st.COUNT_COL, col(st.COUNT_COL) * col("__fan_out"))
        return valued.select(col(ENGAGEMENT_KEY), status)
    # So few that they are listed, too.
    rest = [c for c in class_keys if c not in own]
    parts = classes.groupBy(*[col(k).alias(k) for k in own]).agg(
        *[v(weight=col("__rows")).alias(n) for n, v in values.items()],
        F.collect_list(F.struct(*[col(c) for c in rest])).alias("__classes"),
    )
    parts = parts.withColumn("__packed", _packed(values)).drop(*values)
    groups = _across_engagements(parts, _display_summary(dim, from_dim, attach), own, from_dim, values)
    one = groups.withColumn("__class", F.explode("__classes")).withColumns(
        {c: col("__class").getField(c) for c in rest}
    )
    if not attach:
        return one.select(col(ENGAGEMENT_KEY), status)
    found = one.select(F.slice("__weight", F.lit(2), F.size("__weight")).alias("__lists"), status)
    return found.select(F.explode("__lists").alias("__one"), st.STATUS_COL).select(
        F.get("__one", 0).alias(attach), st.STATUS_COL
    )


def project_status(
    tables: Tables,
    prepared: DataFrame | None = None,
    keys: tuple[str, ...] = st.LIVE_GROUP_KEYS,
    method: str = "aggregate",
    dimension: DataFrame | None = None,
) -> DataFrame:
    """Output A: every product with its group size and derived project status.

    ``method="aggregate"`` is :func:`status_products`. ``method="window"`` joins
    first and computes the group values with one window, each group in one
    task: the model that tests compare with.
    """
    if prepared is None and method == "aggregate":
        return status_products(tables, dimension, keys, st.live_group_values(), st.live_rules())
    prep = prepared if prepared is not None else prepared_products(tables, dimension)
    x = with_group_values(prep, keys, st.live_group_values(), method)
    status = first_match(st.live_rules())
    return x.select(*[col(c) for c in prep.columns], col(st.COUNT_COL), status.alias(st.STATUS_COL))


def status_presence(projects: DataFrame, priority=st.LIVE_PRIORITY) -> DataFrame:
    """Wide view: one column per status, set when the engagement has it.

    ``projects`` is Output A or :func:`status_classes`; both hold the same
    (engagement, status) pairs.
    """
    return pivot_presence(projects, "language_engagement_id", st.STATUS_COL, list(priority))


def engagement_status(projects: DataFrame, priority=st.LIVE_PRIORITY) -> DataFrame:
    """One status per engagement: the highest-priority project status.

    ``projects`` is Output A or :func:`status_classes`: repeated rows do not
    change a minimum.
    """
    return best_by_priority(projects, "language_engagement_id", st.STATUS_COL, list(priority))


def engagement_master(dimension: DataFrame, rollup: DataFrame) -> DataFrame:
    """Output B: the dimension with each engagement's status (or a default)."""
    x = natural_join(dimension, rollup, ["language_engagement_id"], "left")
    return x.withColumn(st.STATUS_COL, st.engagement_default_live(col(st.STATUS_COL)))


def goal_coverage(
    goals: DataFrame, engagements: DataFrame, codes: DataFrame | None = None
) -> DataFrame:
    """Output C: every goal language, with the engagements that cover it.

    Goals without an engagement are kept. The key column is named
    ``iso_639_2`` and holds the goal's code. ``codes`` is a frame with the same
    ``iso_639_2`` values (they are fixed before goals and statuses are joined,
    see :func:`engagement_org_rep`), so statuses are computed once.
    """
    eng = engagements.select(
        col("iso_639_2").alias("__iso"),
        col(st.STATUS_COL).alias("uw_project_status"),
        col("language_engagement_id").alias("__engagement"),
    )
    known = None if codes is None else codes.select(col("iso_639_2").alias("__iso"))
    x = left_join_split(goals, eng, {"languagecode": "__iso"}, known)
    x = x.withColumns(
        {
            "iso_639_2": col("languagecode"),
            "aag_elligible": st.aag_eligibility(col("allaccessstatus")),
            "has_uw_engagement": yes_no(col("__engagement").isNotNull()),
        }
    )
    return x.select(*GOAL_COLUMNS)


def run_live(tables: Tables, method: str = "aggregate") -> dict[str, DataFrame]:
    """All three live outputs, built lazily from one set of input frames."""
    dim = engagement_dimension(tables)
    master = engagement_master(dim, engagement_status(status_classes(tables, dim)))
    return {
        "master_uw_translation_projects": project_status(tables, method=method, dimension=dim),
        "master_uw_language_engagements": master,
        "pb_language_engagements": goal_coverage(
            tables["pb_language_data"], master, engagement_org_rep(tables)
        ),
    }
