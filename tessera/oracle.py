"""DuckDB SQL for every registered query: the correctness oracle.

Written independently of the Spark plans: group conditions use window
functions with ``min``/``max`` over 0/1 cases instead of ``bool_and``/
``bool_or`` and a join back, rollups use ``max(CASE ...)`` instead of a
priority rank, and NULL-safe keys use ``IS NOT DISTINCT FROM``. The fixture
views are inlined as CTEs over the base tables the driver registers.
"""

from __future__ import annotations

FIXTURE_CTES = """
ietf_languages_codes AS (
  SELECT p_partkey AS ietf_id, p_name AS primary_anglicized_name,
    CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 7 = 0 THEN NULL ELSE p_type END AS alternative_names,
    'st' || CAST(p_partkey AS VARCHAR) AS subtag_new,
    CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 'i' || CAST(p_partkey - p_partkey % 5 AS VARCHAR) END AS iso_639_2
  FROM part),
language_engagements AS (
  SELECT c_custkey AS language_engagement_id,
    CASE WHEN c_custkey % 41 = 40 THEN NULL ELSE c_custkey - c_custkey % 3 END AS ietf_id,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'C' || CAST(c_nationkey AS VARCHAR) END AS country_id,
    c_custkey % 9 AS uw_rep_id, c_custkey % 12 AS translation_organization_id
  FROM customer),
sli_language_data AS (
  SELECT CASE WHEN p_size <= 25 THEN 'st' ELSE 'none' END || CAST(p_partkey AS VARCHAR) AS bcp47,
    p_size % 5 AS resource_level FROM part
  UNION ALL
  SELECT CASE WHEN p_size <= 5 THEN 'st' ELSE 'nil' END || CAST(p_partkey AS VARCHAR) AS bcp47,
    9 AS resource_level FROM part),
countries AS (
  SELECT CASE WHEN n_nationkey < 22 THEN 'C' ELSE 'X' END || CAST(n_nationkey AS VARCHAR) AS alpha_3_code,
    CASE WHEN n_nationkey < 22 THEN 'c' ELSE 'x' END || CAST(n_nationkey AS VARCHAR) AS alpha_2_code,
    n_name AS english_short_name, r_name AS world_region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
organizations AS (
  SELECT CASE WHEN s_suppkey % 11 <> 7 THEN s_suppkey ELSE -s_suppkey END AS org_id, s_name AS name, 'S' || CAST(s_suppkey AS VARCHAR) AS abbreviation,
    CASE s_suppkey % 3 WHEN 0 THEN 'Unrestricted' WHEN 1 THEN 'Restricted' ELSE 'Confidential' END AS sensitivity
  FROM supplier),
uw_reps AS (
  SELECT CASE WHEN s_suppkey <> 8 THEN s_suppkey ELSE -s_suppkey END AS uw_rep_id,
    s_name AS first_name, s_name AS last_name FROM supplier),
pb_language_data AS (
  SELECT CASE WHEN p_partkey = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'i' || CAST(p_partkey AS VARCHAR)
      ELSE 'u' || CAST(p_partkey AS VARCHAR) END AS languagecode,
    p_name AS languagename, p_type AS country, 'C' || CAST(p_partkey % 25 AS VARCHAR) AS countrycode,
    CASE p_size % 6 WHEN 0 THEN 'Translation in Progress' WHEN 1 THEN 'Translation Not Started' WHEN 2 THEN 'Not Shown'
      WHEN 3 THEN 'Goal Met' WHEN 4 THEN '' ELSE NULL END AS allaccessstatus,
    p_brand AS allaccessgoal, CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS activetranslation,
    CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS completedscripture,
    CASE WHEN p_size % 5 = 0 THEN NULL ELSE 1970 + p_size END AS latestpublicationyear
  FROM part),
bible_info AS (
  SELECT CASE WHEN p_partkey % 67 = 66 THEN NULL ELSE 'BK' || CAST(p_partkey % 67 AS VARCHAR) END
      AS scriptural_association,
    CASE WHEN p_partkey % 67 < 39 OR p_partkey % 67 = 66 THEN 'OT' ELSE 'NT' END AS bible_section
  FROM part),
uw_translation_products AS (
  SELECT language_engagement_id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_returnflag = 'N' THEN 'BP' WHEN l_returnflag = 'R' THEN 'Scripture Text' WHEN l_linestatus = 'F' THEN 'OBS' ELSE 'EJ' END AS resource_package,
    CASE WHEN o_orderstatus = 'P' THEN 'Audio' ELSE 'Text' END AS resource_format,
    CASE WHEN l_partkey % 70 < 66 THEN 'BK' || CAST(l_partkey % 70 AS VARCHAR) WHEN l_partkey % 70 = 66 THEN 'Bible'
      WHEN l_partkey % 70 = 67 THEN 'NT' WHEN l_partkey % 70 = 68 THEN 'OT' ELSE NULL END AS scriptural_association,
    CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'Draft' END AS scripture_text_name,
    CASE language_engagement_id % 7
      WHEN 0 THEN 'Completed'
      WHEN 1 THEN CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN NULL ELSE 'Planned' END
      WHEN 2 THEN CASE WHEN l_linenumber = 1 THEN 'In Progress' ELSE 'Completed' END
      WHEN 3 THEN CASE WHEN l_linenumber <= 3 THEN 'Not Scheduled' ELSE 'Completed' END
      WHEN 4 THEN CASE WHEN l_linenumber <= 2 THEN 'Paused' WHEN l_quantity < 3 THEN NULL ELSE 'Completed' END
      WHEN 5 THEN CASE WHEN l_linenumber = 1 AND l_quantity < 10 THEN 'Inactive' ELSE 'Completed' END
      ELSE CASE WHEN l_quantity < 5 THEN NULL ELSE 'Not Scheduled' END END AS product_status
  FROM (SELECT l.*, o_orderstatus,
          CASE WHEN o_custkey % 100 < 50 THEN o_custkey - o_custkey % 50 ELSE o_custkey END AS language_engagement_id
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey) x),
training_events AS (
  SELECT event_id, CASE event_type WHEN 'error' THEN 'Networks PR' WHEN 'signup' THEN NULL ELSE event_type END
    AS "Category of Training"
  FROM events),
joshua_project_data AS (
  SELECT c_name AS PeopNameInCountry,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 'R' || CAST(c_nationkey AS VARCHAR) END AS ROG3,
    CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END AS LeastReached, c_mktsegment AS PrimaryLanguageName,
    'i' || CAST((c_custkey % 400) * 5 AS VARCHAR) AS ROL3, (c_custkey * 37) % 100000 AS Population
  FROM customer),
engagement_org_lists AS (
  SELECT c_custkey AS language_engagement_id,
    CASE WHEN c_custkey % 10 = 0 THEN '[]'
         WHEN c_custkey % 10 = 1 THEN NULL
         WHEN c_custkey % 10 = 2 THEN 'not json'
         WHEN c_custkey % 10 = 3 THEN '[' || CAST(c_custkey % 97 AS VARCHAR) || ']'
         WHEN c_custkey % 10 <= 6 THEN '[' || CAST(c_custkey % 97 AS VARCHAR) || ', ' || CAST((c_custkey * 7) % 113 AS VARCHAR) || ']'
         ELSE '[' || CAST(c_custkey % 97 AS VARCHAR) || ', ' || CAST((c_custkey * 7) % 113 AS VARCHAR) || ', '
              || CAST(c_nationkey AS VARCHAR) || ']' END AS translating_organization
  FROM customer),
order_date_forms AS (
  SELECT o_orderkey, [strftime(o_orderdate, '%-m/%-d/%Y'), strftime(o_orderdate, '%Y-%m-%d'),
    strftime(o_orderdate, '%B %-d, %Y'), strftime(o_orderdate, '%-m-%-d-%Y'), strftime(o_orderdate, '%b %-d, %Y'),
    'not a date', NULL, strftime(o_orderdate, '%-m/%-d/') || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0'),
    strftime(o_orderdate, '%Y/%m/%d'), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z', strftime(o_orderdate, '%m.%d.%Y'),
    strftime(o_orderdate, '%m%d%Y'), strftime(o_orderdate, '%b %-d %Y'), strftime(o_orderdate, '%B %-d %Y'),
    ' ' || strftime(o_orderdate, '%-m/%-d/%Y') || ' ', strftime(o_orderdate, '%-m / %-d / %Y'), '13/45/2000'] AS f
  FROM orders),
order_date_text AS (
  SELECT o_orderkey, f[1 + o_orderkey % 18] AS start_date, f[1 + (o_orderkey * 5 + 3) % 18] AS published_date
  FROM order_date_forms),
event_records AS (
  SELECT event_id, n, '{"id": ' || CAST(event_id * 10 + n AS VARCHAR) || ', "languageName": "' || event_type || '-'
    || CAST(n AS VARCHAR) || '", "geo": {"country": {"code": "C' || CAST((event_id + n) % 25 AS VARCHAR)
    || '"}, "size": ' || CAST(event_id * 10 + n AS VARCHAR) || '}, "tags": ["a' || CAST(event_id * 10 + n AS VARCHAR)
    || '", "b"]' || CASE WHEN (event_id + n) % 4 = 0 THEN '' ELSE ', "level": ' || CAST((event_id + n) % 7 AS VARCHAR) END
    || '}' AS record
  FROM events, range(3) AS r(n)),
event_documents AS (
  SELECT event_id,
    CASE WHEN event_id % 12 = 9 THEN NULL WHEN event_id % 12 = 10 THEN '{"resource": [{"id": '
      ELSE '{"resource": [' || coalesce(string_agg(record, ', ' ORDER BY n) FILTER (n <
        CASE WHEN event_id % 12 = 0 THEN 0 WHEN event_id % 12 <= 4 THEN 1 WHEN event_id % 12 <= 8 THEN 2 ELSE 3 END), '')
        || ']}' END AS document
  FROM event_records GROUP BY event_id),
country_cross_reference AS (
  SELECT CASE WHEN n_nationkey = 5 THEN NULL ELSE 'R' || CAST(n_nationkey AS VARCHAR) END AS ROG3,
    'c' || CAST(n_nationkey AS VARCHAR) AS ISO2, upper(n_name) AS Ctry
  FROM nation)
"""

STAGE_CTES = """
eng_locale AS (
  SELECT e.language_engagement_id, e.ietf_id, i.primary_anglicized_name, i.alternative_names, i.subtag_new,
    s.resource_level, e.country_id, e.uw_rep_id, e.translation_organization_id, i.iso_639_2
  FROM language_engagements e
  JOIN ietf_languages_codes i ON e.ietf_id IS NOT DISTINCT FROM i.ietf_id
  LEFT JOIN sli_language_data s ON i.subtag_new IS NOT DISTINCT FROM s.bcp47),
eng_locale_c AS (
  SELECT l.*, c.alpha_2_code, c.english_short_name, c.world_region
  FROM eng_locale l LEFT JOIN countries c ON l.country_id IS NOT DISTINCT FROM c.alpha_3_code),
eng_org_rep AS (
  SELECT l.*, o.name, o.abbreviation, o.sensitivity
  FROM eng_locale_c l
  JOIN organizations o ON l.translation_organization_id IS NOT DISTINCT FROM o.org_id
  JOIN uw_reps r ON l.uw_rep_id IS NOT DISTINCT FROM r.uw_rep_id),
eng_dim AS (
  SELECT x.language_engagement_id, x.ietf_id, x.primary_anglicized_name, x.alternative_names, x.subtag_new,
    x.resource_level, x.english_short_name, x.country_id, x.abbreviation, x.uw_rep_id, x.name,
    x.translation_organization_id, x.iso_639_2, x.world_region, x.alpha_2_code, x.sensitivity,
    g.activetranslation, g.allaccessstatus, g.allaccessgoal,
    CASE WHEN g.allaccessstatus IN ('Translation in Progress', 'Translation Not Started', 'Not Shown') THEN 'Yes'
         WHEN g.allaccessstatus IS NULL THEN 'Unknown' ELSE 'No' END AS aag_elligible,
    CASE WHEN x.primary_anglicized_name IS NOT NULL AND x.alternative_names = '' THEN x.primary_anglicized_name
         WHEN x.primary_anglicized_name IS NOT NULL AND x.alternative_names <> ''
           THEN x.primary_anglicized_name || ', ' || x.alternative_names END AS combined_anglicized_name,
    CASE WHEN g.completedscripture IS NOT NULL AND g.latestpublicationyear IS NOT NULL
           THEN g.completedscripture || ' - ' || CAST(g.latestpublicationyear AS VARCHAR)
         WHEN g.completedscripture IS NOT NULL THEN g.completedscripture || '  - No Date Associated' END
      AS completed_scripture
  FROM eng_org_rep x LEFT JOIN pb_language_data g ON x.iso_639_2 IS NOT DISTINCT FROM g.languagecode),
sections AS (
  SELECT scriptural_association,
    max(CASE WHEN bible_section = 'OT' THEN 1 ELSE 0 END) = 1 AS is_ot,
    max(CASE WHEN bible_section = 'NT' THEN 1 ELSE 0 END) = 1 AS is_nt
  FROM bible_info GROUP BY scriptural_association),
prep_flags AS (
  SELECT p.language_engagement_id, p.l_orderkey, p.l_linenumber, p.l_partkey, p.l_suppkey, p.resource_package,
    p.resource_format, p.scriptural_association, NULLIF(p.scripture_text_name, '') AS scripture_text_name,
    p.product_status,
    d.ietf_id, d.primary_anglicized_name, d.alternative_names, d.subtag_new, d.resource_level,
    d.english_short_name, d.country_id, d.abbreviation, d.uw_rep_id, d.name, d.translation_organization_id,
    d.iso_639_2, d.world_region, d.alpha_2_code, d.sensitivity, d.activetranslation, d.allaccessstatus,
    d.allaccessgoal, d.aag_elligible, d.combined_anglicized_name, d.completed_scripture,
    CASE WHEN p.resource_package = 'OBS' THEN 'STORY'
         WHEN p.resource_package = 'EJ' THEN 'SELECT'
         WHEN p.resource_package IN ('Scripture Text', 'BP') AND coalesce(s.is_ot, false) THEN 'OT'
         WHEN p.resource_package IN ('Scripture Text', 'BP') AND coalesce(s.is_nt, false) THEN 'NT'
         WHEN p.resource_package IN ('Scripture Text', 'BP') AND p.scriptural_association = 'Bible' THEN 'BIBLE'
    END AS bible_book_ref,
    coalesce(s.is_ot, false) AS in_ot, coalesce(s.is_nt, false) AS in_nt
  FROM uw_translation_products p
  JOIN eng_dim d ON p.language_engagement_id IS NOT DISTINCT FROM d.language_engagement_id
  LEFT JOIN sections s ON p.scriptural_association IS NOT DISTINCT FROM s.scriptural_association)
"""

# The columns of a prepared product, in output order.
PREP_COLUMNS = """language_engagement_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, resource_package,
    resource_format, scriptural_association, scripture_text_name, product_status, ietf_id,
    primary_anglicized_name, alternative_names, subtag_new, resource_level, english_short_name, country_id,
    abbreviation, uw_rep_id, name, translation_organization_id, iso_639_2, world_region, alpha_2_code,
    sensitivity, activetranslation, allaccessstatus, allaccessgoal, aag_elligible, combined_anglicized_name,
    completed_scripture, bible_book_ref"""


def _has(status: str, window: str) -> str:
    return f"max(CASE WHEN product_status = '{status}' THEN 1 ELSE 0 END) OVER {window} = 1"


def _every(status: str, window: str) -> str:
    return f"min(CASE WHEN product_status = '{status}' THEN 1 ELSE 0 END) OVER {window} = 1"


def live_projects_cte(name: str, keys: str) -> str:
    w = f"(PARTITION BY {keys})"
    return f"""
{name}_w AS (
  SELECT {PREP_COLUMNS},
    count(*) OVER {w} AS BP_num,
    {_has('Inactive', w)} AS any_inactive,
    {_every('Planned', w)} AS all_planned,
    {_has('In Progress', w)} AS any_in_progress,
    {_every('Paused', w)} AS all_paused,
    {_has('Paused', w)} AS any_paused,
    {_has('Completed', w)} AS any_completed,
    {_has('Planned', w)} AS any_planned,
    {_every('Completed', w)} AS all_completed,
    {_has('Not Scheduled', w)} AS any_not_scheduled
  FROM prep_flags),
{name} AS (
  SELECT {PREP_COLUMNS}, BP_num,
    CASE WHEN any_inactive THEN 'Inactive'
         WHEN coalesce(scriptural_association IN ('Bible', 'NT', 'OT'), false) AND product_status = 'Completed'
           THEN 'Completed'
         WHEN all_planned THEN 'Future'
         WHEN any_in_progress THEN 'Active'
         WHEN resource_package = 'OBS' AND product_status = 'Completed' THEN 'Completed'
         WHEN all_paused OR (any_paused AND any_completed) OR any_planned THEN 'Paused'
         WHEN resource_package IN ('BP', 'Scripture Text') AND all_completed AND bible_book_ref = 'NT' AND BP_num < 27
           THEN 'Active'
         WHEN resource_package IN ('BP', 'Scripture Text') AND all_completed AND bible_book_ref = 'OT' AND BP_num < 39
           THEN 'Active'
         WHEN any_completed AND (any_planned OR any_not_scheduled) THEN 'Active'
         WHEN all_completed THEN 'Completed'
         WHEN any_not_scheduled THEN 'Intent'
    END AS project_status
  FROM {name}_w)"""


# Group keys of the two flows and of the display-name form.
LEGACY_KEYS = (
    "english_short_name, combined_anglicized_name, resource_package, resource_format, "
    "bible_book_ref, scripture_text_name"
)
LIVE_KEYS = "language_engagement_id, resource_package, resource_format, bible_book_ref, scripture_text_name"
DISPLAY_KEYS = "english_short_name, combined_anglicized_name, resource_format, scripture_text_name"

LEGACY_PROJECTS_CTE = f"""
legacy_w AS (
  SELECT {PREP_COLUMNS}, in_ot, in_nt,
    count(*) OVER w AS BP_num,
    max(CASE WHEN product_status = 'In Progress' THEN 1 ELSE 0 END) OVER w = 1 AS any_in_progress,
    min(CASE WHEN product_status = 'Completed' THEN 1 ELSE 0 END) OVER w = 1 AS all_completed
  FROM prep_flags WINDOW w AS (PARTITION BY {LEGACY_KEYS})),
legacy_projects AS (
  SELECT {PREP_COLUMNS}, BP_num,
    CASE WHEN resource_package = 'BP' AND (bible_book_ref = 'NT' OR bible_book_ref = 'OT') AND any_in_progress
           THEN 'Active'
         WHEN resource_package = 'BP' AND bible_book_ref = 'NT' AND all_completed AND BP_num < 27 THEN 'Active'
         WHEN resource_package = 'BP' AND bible_book_ref = 'OT' AND all_completed AND BP_num < 39 THEN 'Active'
         WHEN resource_package = 'Scripture Text' AND bible_book_ref = 'NT' AND scriptural_association = 'NT'
           AND all_completed THEN 'Completed'
         WHEN resource_package = 'Scripture Text' AND bible_book_ref = 'OT' AND scriptural_association = 'OT'
           AND all_completed THEN 'Completed'
         WHEN resource_package = 'Scripture Text' AND bible_book_ref = 'NT' AND in_nt AND all_completed
           AND BP_num < 27 THEN 'Active'
         WHEN resource_package = 'Scripture Text' AND bible_book_ref = 'OT' AND in_ot AND all_completed
           AND BP_num < 39 THEN 'Active'
         WHEN product_status = 'Planned' OR product_status = 'Not Scheduled' THEN 'Future'
         WHEN any_in_progress THEN 'Active'
         WHEN coalesce(product_status = 'Paused', false) THEN 'Paused'
         WHEN coalesce(product_status = 'Inactive', false) THEN 'Inactive'
         WHEN all_completed THEN 'Completed'
    END AS project_status
  FROM legacy_w)"""


def _rollup(source: str, key: str, order: tuple[str, ...]) -> str:
    arms = "\n".join(
        f"         WHEN max(CASE WHEN project_status = '{s}' THEN 1 ELSE 0 END) = 1 THEN '{s}'"
        for s in order
    )
    return f"""SELECT {key},
    CASE
{arms}
    END AS project_status
  FROM {source} GROUP BY {key}"""


# Rollup priorities of the two flows, highest first.
LIVE_ORDER = ("Active", "Future", "Paused", "Inactive", "Intent", "Completed")
LEGACY_ORDER = ("Active", "Future", "Paused", "Completed", "Inactive")

ROLLUP_CTES = f"""
eng_status AS (
{_rollup('projects', 'language_engagement_id', LIVE_ORDER)}),
eng_master AS (
  SELECT d.*,
    CASE WHEN s.project_status IS NULL THEN 'Prospective' WHEN s.project_status = 'Intent' THEN 'Prospective'
         ELSE s.project_status END AS project_status
  FROM eng_dim d LEFT JOIN eng_status s ON d.language_engagement_id IS NOT DISTINCT FROM s.language_engagement_id),
legacy_status AS (
{_rollup('legacy_projects', 'subtag_new', LEGACY_ORDER)}),
legacy_master AS (
  SELECT d.*, coalesce(s.project_status, 'No Status Listed') AS project_status
  FROM eng_dim d LEFT JOIN legacy_status s ON d.subtag_new IS NOT DISTINCT FROM s.subtag_new)"""

AAG = """CASE WHEN g.allaccessstatus IN ('Translation in Progress', 'Translation Not Started', 'Not Shown') THEN 'Yes'
         WHEN g.allaccessstatus IS NULL THEN 'Unknown' ELSE 'No' END AS aag_elligible"""

EXPLODED_CTE = """
parsed_lists AS (
  SELECT language_engagement_id,
    CASE WHEN json_valid(translating_organization) THEN from_json(translating_organization, '["BIGINT"]') END AS arr
  FROM engagement_org_lists),
exploded AS (
  SELECT language_engagement_id, CAST(i AS INTEGER) AS pos, arr[i + 1] AS translating_organization_clean
  FROM parsed_lists, unnest(range(len(arr))) AS t(i)
  UNION ALL
  SELECT language_engagement_id, CAST(NULL AS INTEGER) AS pos, CAST(NULL AS BIGINT) AS translating_organization_clean
  FROM parsed_lists WHERE arr IS NULL OR len(arr) = 0),
exploded_orgs AS (
  SELECT x.language_engagement_id, x.pos, x.translating_organization_clean,
    o.name AS translating_organization, o.sensitivity
  FROM exploded x LEFT JOIN organizations o ON x.translating_organization_clean IS NOT DISTINCT FROM o.org_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes)


_ALL = (
    FIXTURE_CTES,
    STAGE_CTES,
    live_projects_cte("projects", LIVE_KEYS),
    live_projects_cte("display_projects", DISPLAY_KEYS),
    LEGACY_PROJECTS_CTE,
    ROLLUP_CTES,
    EXPLODED_CTE,
)
PREFIX = _with(*_ALL)


def _q(body: str) -> str:
    return f"{PREFIX}\n{body.strip()}"


def _date_sql(name: str) -> str:
    """Month-first forms by format, the century chosen by hand, then ISO."""
    t = f"trim(replace({name}, ' / ', '/'))"
    formats = ("%m/%d/%Y", "%m-%d-%Y", "%m.%d.%Y", "%m%d%Y", "%B %d, %Y", "%b %d, %Y", "%B %d %Y", "%b %d %Y")
    tried = ", ".join(f"try_strptime({t}, '{f}')" for f in formats)
    short = (
        f"CASE WHEN regexp_full_match({t}, '[0-9]+/[0-9]+/[0-9][0-9]') THEN try_strptime("
        f"regexp_replace({t}, '[0-9][0-9]$', '') || CASE WHEN right({t}, 2) <= '68' THEN '20' ELSE '19' END"
        f" || right({t}, 2), '%m/%d/%Y') END"
    )
    iso = ", ".join(f"try_strptime(left({t}, 10), '{f}')" for f in ("%Y-%m-%d", "%Y/%m/%d"))
    return f"CAST(coalesce({short}, {tried}, {iso}) AS DATE)"


ORACLE_SQL: dict[str, str] = {
    "engagement_organization_links": _q(
        "SELECT c_custkey AS language_engagement_id, c_custkey % 12 AS org_id FROM customer"
    ),
    "engagement_locale": _q("SELECT * FROM eng_locale_c"),
    "engagement_org_rep": _q("SELECT * FROM eng_org_rep"),
    "engagement_eligibility": _q("SELECT * FROM eng_dim"),
    "section_lookup": _q("SELECT * FROM sections"),
    "section_membership": _q(
        """SELECT p.language_engagement_id, p.l_orderkey, p.l_linenumber, p.scriptural_association,
    coalesce(s.is_ot, false) AS in_ot_list, coalesce(s.is_nt, false) AS in_nt_list
  FROM uw_translation_products p
  LEFT JOIN sections s ON p.scriptural_association IS NOT DISTINCT FROM s.scriptural_association"""
    ),
    "product_prep": _q(f"SELECT {PREP_COLUMNS} FROM prep_flags"),
    "project_status": _q("SELECT * FROM projects"),
    "status_presence": _q(
        "SELECT language_engagement_id, "
        + ", ".join(
            f"max(CASE WHEN project_status = '{s}' THEN project_status END) AS \"{s}\"" for s in LIVE_ORDER
        )
        + " FROM projects GROUP BY language_engagement_id"
    ),
    "engagement_status": _q("SELECT * FROM eng_status"),
    "engagement_master": _q("SELECT * FROM eng_master"),
    "goal_coverage": _q(
        f"""SELECT g.languagename, g.languagecode AS iso_639_2, g.country, g.countrycode, g.allaccessstatus,
    g.allaccessgoal, {AAG},
    CASE WHEN m.language_engagement_id IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_uw_engagement,
    m.project_status AS uw_project_status
  FROM pb_language_data g LEFT JOIN eng_master m ON g.languagecode IS NOT DISTINCT FROM m.iso_639_2"""
    ),
    "legacy_project_status": _q("SELECT * FROM legacy_projects"),
    "legacy_engagement_master": _q("SELECT * FROM legacy_master"),
    "legacy_goal_coverage": _q(
        f"""SELECT g.languagename, g.languagecode AS iso_639_2, g.country, g.allaccessstatus, g.allaccessgoal,
    {AAG},
    CASE WHEN e.language_engagement_id IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_uw_engagement
  FROM pb_language_data g LEFT JOIN eng_org_rep e ON g.languagecode IS NOT DISTINCT FROM e.iso_639_2"""
    ),
    "legacy_training_filter": _q(
        "SELECT * FROM training_events WHERE \"Category of Training\" <> 'Networks PR'"
    ),
    "json_list_explode": _q("SELECT * FROM exploded_orgs"),
    "sensitivity_rollup": _q(
        """SELECT language_engagement_id,
    string_agg(coalesce(translating_organization, 'NA'), ', ' ORDER BY pos) AS translating_organization,
    CASE WHEN max(CASE WHEN sensitivity = 'Confidential' THEN 1 ELSE 0 END) = 1 THEN 'Confidential'
         WHEN max(CASE WHEN sensitivity = 'Restricted' THEN 1 ELSE 0 END) = 1 THEN 'Restricted'
         WHEN max(CASE WHEN sensitivity = 'Unrestricted' THEN 1 ELSE 0 END) = 1 THEN 'Unrestricted'
    END AS sensitivity
  FROM exploded_orgs GROUP BY language_engagement_id"""
    ),
    "mixed_dates": _q(
        f"""SELECT o_orderkey, {_date_sql('start_date')} AS new_start, {_date_sql('published_date')} AS new_published
  FROM order_date_text"""
    ),
    "strip_column_prefix": _q(
        """SELECT p_partkey AS id, p_name AS languageName, p_type AS country, p_size AS ize, p_brand AS brand
  FROM part"""
    ),
    "country_xref": _q(
        """SELECT j.PeopNameInCountry, x.english_short_name, x.ISO2, j.LeastReached, j.PrimaryLanguageName, j.ROL3,
    j.Population
  FROM joshua_project_data j
  LEFT JOIN (SELECT r.ROG3, r.ISO2, r.Ctry, c.alpha_3_code, c.english_short_name, c.world_region
             FROM country_cross_reference r JOIN countries c ON r.ISO2 IS NOT DISTINCT FROM c.alpha_2_code) x
    ON j.ROG3 IS NOT DISTINCT FROM x.ROG3"""
    ),
    "group_by_display_name": _q("SELECT * FROM display_projects"),
    "json_document": _q(
        """SELECT d.event_id, CAST(json_extract(r, '$.id') AS BIGINT) AS id,
    json_extract_string(r, '$.languageName') AS languageName,
    json_extract_string(r, '$.geo.country.code') AS "geo.country.code",
    CAST(json_extract(r, '$.geo.size') AS BIGINT) AS "geo.size",
    array_to_string(CAST(json_extract(r, '$.tags') AS VARCHAR[]), ';') AS tags,
    CAST(json_extract(r, '$.level') AS INTEGER) AS level
  FROM event_documents d LEFT JOIN (
    SELECT event_id, unnest(CAST(json_extract(document, '$.resource') AS JSON[])) AS r
    FROM event_documents WHERE json_valid(document)) x ON d.event_id = x.event_id"""
    ),
}
ORACLE_SQL |= {
    "written_projects": ORACLE_SQL["project_status"],
    "written_engagements": ORACLE_SQL["engagement_master"],
    "written_goals": ORACLE_SQL["goal_coverage"],
}
