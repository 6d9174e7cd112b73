"""Cleaning operators from the retired part of the job.

Mixed-format dates, JSON list columns, an attribute rollup over the list
elements, JSON documents, and a country cross-reference. All are built-in
expressions, explodes, joins and partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import flatten_records, ordered_join
from tessera.operators.joins import col, null_safe_join
from tessera.operators.rollup import priority_rank, value_of_rank

# Month names; a name or its first three letters may be given.
MONTHS = (
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
)
# Fixed value: two-digit years up to this one are 20xx, later ones 19xx.
TWO_DIGIT_YEAR_CUTOFF = 68

_NAMES = "|".join(m if len(m) == 3 else f"{m[:3]}(?:{m[3:]})?" for m in MONTHS)
# One pattern takes a text of any form apart; no text matches two forms. Each
# form has three groups, and those of the other forms are empty.
_FORMS = (
    # Month, day, year with any separator or, at full width, none.
    r"(\d{1,2})[^A-Za-z0-9]+(\d{1,2})[^A-Za-z0-9]+(\d{4}|\d{2})",
    r"(\d{2})(\d{2})(\d{4}|\d{2})",
    rf"((?i:{_NAMES}))[^A-Za-z0-9]*(\d{{1,2}})[^A-Za-z0-9]+(\d{{4}}|\d{{2}})",
    # Year, month, day, alone or before a time.
    r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?:[T\s][\s\S]*)?",
)
_ANY_FORM = r"^\s*(?:" + "|".join(_FORMS) + r")\s*$"
# A line break, which no text keeps, marks what a form has made.
_YEAR_MONTH_DAY = "\n$3$6$9$10-$1$4$7$11-$2$5$8$12"

# Network sensitivity, most restrictive first.
SENSITIVITY_PRIORITY = ("Confidential", "Restricted", "Unrestricted")


def parse_mixed_date(text: Column, cutoff: int = TWO_DIGIT_YEAR_CUTOFF) -> Column:
    """A date from text in any of several forms; month-first forms win.

    Month first: numbers with any separator or none, or a month name; years of
    two digits get their century from ``cutoff``. Then ISO dates, with a time
    or without. White space around the text does not count. One pattern turns a
    text of any form into year, month and day, month names and two-digit years
    are completed in the text, and it is cast once; a date that does not exist
    is NULL. All steps are generated code.
    """
    parts = F.regexp_replace(F.translate(text, "\n", " "), _ANY_FORM, _YEAR_MONTH_DAY)
    short = F.lower(F.regexp_extract(parts, "^\n\\d+-([A-Za-z]{3})", 1))
    number = F.floor((F.instr(F.lit("".join(m[:3] for m in MONTHS)), short) + 2) / 3)
    parts = F.regexp_replace(parts, F.lit("^(\n\\d+-)[A-Za-z]+"), F.concat(F.lit("$1"), number.cast("string")))
    tens, ones = divmod(cutoff, 10)
    parts = F.regexp_replace(parts, rf"^\n((?!{tens}[^0-{ones}])[0-{tens}]\d)-", "\n20$1-")
    parts = F.regexp_replace(parts, r"^\n(\d{2})-", "\n19$1-")
    return F.regexp_extract(parts, r"^\n(\d{4}-\d{1,2}-\d{1,2})$", 1).try_cast("date")


def explode_json_list(
    df: DataFrame,
    json_col: str,
    element_type: T.DataType,
    out_col: str,
    pos_col: str = "pos",
    row_col: str | None = None,
) -> DataFrame:
    """One row per element of a JSON array held as text.

    Empty, NULL and malformed arrays keep their row with NULL element and
    position, so nothing is dropped. ``row_col`` adds a number that the
    elements of one source row share and no others.
    """
    parsed = F.from_json(col(json_col), T.ArrayType(element_type))
    rest = [col(c) for c in df.columns if c != json_col]
    if row_col:
        df = df.withColumn(row_col, F.monotonically_increasing_id())
        rest.append(col(row_col))
    return df.select(*rest, F.posexplode_outer(parsed).alias(pos_col, out_col))


def rollup_list_attributes(
    exploded: DataFrame,
    key: str,
    pos_col: str,
    name_col: str,
    level_col: str,
    levels: Sequence[str] = SENSITIVITY_PRIORITY,
    names_out: str | None = None,
    level_out: str | None = None,
    row_col: str = "row",
) -> DataFrame:
    """Per source row: the highest level among its elements, and their names in order.

    Names are joined with ", " in element order; a missing name prints as
    "NA". Groups are the elements of one source row (``row_col`` of
    :func:`explode_json_list`), so they are as long as its list, also where
    rows repeat a key.
    """
    agg = exploded.groupBy(col(row_col), col(key).alias(key)).agg(
        F.min(priority_rank(col(level_col), levels)).alias("__rank"),
        ordered_join(col(name_col), col(pos_col)).alias(names_out or name_col),
    )
    return agg.select(
        col(key),
        col(names_out or name_col),
        value_of_rank(F.col("__rank"), levels).alias(level_out or level_col),
    )


def parse_json_column(df: DataFrame, json_col: str, schema: T.StructType | str) -> DataFrame:
    """Parse JSON documents into a table against a declared schema.

    Nested fields become ``parent.child`` columns and an array of records
    becomes one row per record, as a flattened API response is laid out; an
    empty, NULL or malformed document keeps one row of NULLs. Top-level fields
    of the document have no prefix. A declared schema avoids an inference pass
    over the data.
    """
    rest = [col(c) for c in df.columns if c != json_col]
    parsed = df.select(*rest, F.from_json(col(json_col), schema).alias("__document"))
    fields = [f.name for f in parsed.schema["__document"].dataType.fields]
    top = parsed.select(*rest, *[col("__document").getField(n).alias(n) for n in fields])
    return flatten_records(top)


def country_cross_reference(
    people: DataFrame,
    cross_ref: DataFrame,
    countries: DataFrame,
    columns: Sequence[str],
) -> DataFrame:
    """Attach standard country attributes to people-group records.

    The cross reference is first restricted to codes known to ``countries``
    (inner join on the two-letter code), then left-joined by region code.
    """
    xref = null_safe_join(cross_ref, countries, {"ISO2": "alpha_2_code"}, "inner")
    x = null_safe_join(people, xref, "ROG3", "left")
    return x.select(*[col(c) for c in columns])
