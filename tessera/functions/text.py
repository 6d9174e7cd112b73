"""Column functions with R's text semantics, built from Spark built-ins.

All of these stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NA_TEXT = "NA"


def null_string() -> Column:
    """R's ``NA_character_``."""
    return F.lit(None).cast("string")


def blank_to_null(c: Column) -> Column:
    """``case_when(x == "" ~ NA, T ~ x)``: blank becomes NULL, NULL stays NULL."""
    return F.nullif(c, F.lit(""))


def r_text(c: Column, dtype: T.DataType | None = None) -> Column:
    """Render a value the way R's ``paste`` does.

    Integral values print without a fraction. R also prints a whole double
    without one (``2010``, not ``2010.0`` as Spark's cast would), so whole
    fractional values are rendered through a long. NULL is left as NULL; see
    :func:`paste` for R's ``"NA"``.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        whole = c == F.floor(c)
        return F.when(whole, c.cast("long").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def paste(*parts: Column, sep: str = " ") -> Column:
    """R's ``paste(..., sep=sep)`` for scalar arguments: NULL prints as "NA"."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit(NA_TEXT)) for p in parts])


def combined_name(primary: Column, alternative: Column) -> Column:
    """Display name: the primary name, plus ", alternative" when one is given.

    A blank alternative gives the primary name alone; a NULL alternative (or
    a NULL primary) gives NULL.
    """
    return F.when(primary.isNotNull() & (alternative == ""), primary).when(
        primary.isNotNull() & (alternative != ""), paste(primary, alternative, sep=", ")
    )


def completed_scripture_label(
    scripture: Column, year: Column, year_type: T.DataType | None = None
) -> Column:
    """"<scripture> - <year>", or "<scripture>  - No Date Associated" without a year.

    The second form has two spaces: the reference pastes with the default
    one-space separator onto a literal that already starts with a space.
    """
    return F.when(
        scripture.isNotNull() & year.isNotNull(),
        paste(scripture, r_text(year, year_type), sep=" - "),
    ).when(scripture.isNotNull() & year.isNull(), paste(scripture, F.lit(" - No Date Associated")))


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


def strip_pattern_from_names(df: DataFrame, pattern: str) -> DataFrame:
    """Remove every match of regex ``pattern`` from every column name.

    This is a metadata-only rename (no data moves). As with the reference,
    the pattern is a regular expression, so in ``"resource."`` the dot
    matches any character.
    """
    rx = re.compile(pattern)
    new = [rx.sub("", c) for c in df.columns]
    dupes = sorted({c for c in new if new.count(c) > 1})
    if dupes:
        raise ValueError(f"renaming would duplicate columns: {dupes}")
    return df.toDF(*new)


def ordered_join(
    values: Column, order: Column, sep: str = ", ", null_text: str = NA_TEXT
) -> Column:
    """Aggregate: ``paste(values, collapse=sep)`` in ``order`` within a group.

    Use inside ``groupBy().agg`` on groups of bounded size (elements of one
    source row). NULL values print as ``null_text``, as R prints NA.
    """
    items = F.array_sort(F.collect_list(F.struct(order.alias("o"), values.alias("v"))))
    return F.array_join(F.transform(items, lambda s: s["v"]), sep, null_text)


def flatten_struct_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """Flatten nested struct columns into ``parent<sep>child`` columns."""

    def walk(prefix: str, dtype: T.DataType, path: Column) -> list[Column]:
        if isinstance(dtype, T.StructType):
            out: list[Column] = []
            for f in dtype.fields:
                out += walk(f"{prefix}{sep}{f.name}", f.dataType, path.getField(f.name))
            return out
        return [path.alias(prefix)]

    cols: list[Column] = []
    for f in df.schema.fields:
        cols += walk(f.name, f.dataType, F.col(f"`{f.name}`"))
    return df.select(*cols)


def flatten_records(df: DataFrame, sep: str = ".") -> DataFrame:
    """Rows and plain columns from nested columns: arrays of records exploded, structs flattened.

    A column that holds an array of structs gives one row per record (one row
    of NULLs where it is empty or NULL), whose fields become
    ``column<sep>field``. Arrays of plain values stay. Two arrays of records
    side by side have no one table form and are an error.
    """
    while True:
        df = flatten_struct_columns(df, sep)
        records = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)
        ]
        if not records:
            return df
        if len(records) > 1:
            raise ValueError(f"several arrays of records: {records}")
        df = df.select(
            *[F.explode_outer(F.col(f"`{c}`")).alias(c) if c == records[0] else F.col(f"`{c}`") for c in df.columns]
        )
