"""Declared input schemas and the load-time check applied to every source.

The upstream database carries no DDL we can rely on, so each input declares
the columns the plans need and their types. Extra columns are kept. A missing
column, or a type that cannot be widened safely, fails the load instead of
silently changing a join (a string key against a numeric key would otherwise
be cast row by row at join time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


REFERENCE_SCHEMAS: dict[str, T.StructType] = {
    "language_engagements": _schema(
        ("language_engagement_id", L),
        ("ietf_id", L),
        ("country_id", S),
        ("uw_rep_id", L),
        ("translation_organization_id", L),
    ),
    "ietf_languages_codes": _schema(
        ("ietf_id", L),
        ("primary_anglicized_name", S),
        ("alternative_names", S),
        ("subtag_new", S),
        ("iso_639_2", S),
    ),
    "sli_language_data": _schema(("bcp47", S), ("resource_level", I)),
    "countries": _schema(
        ("alpha_3_code", S),
        ("alpha_2_code", S),
        ("english_short_name", S),
        ("world_region", S),
    ),
    "organizations": _schema(
        ("org_id", L), ("name", S), ("abbreviation", S), ("sensitivity", S)
    ),
    "uw_reps": _schema(("uw_rep_id", L), ("first_name", S), ("last_name", S)),
    "pb_language_data": _schema(
        ("languagecode", S),
        ("languagename", S),
        ("country", S),
        ("countrycode", S),
        ("allaccessstatus", S),
        ("allaccessgoal", S),
        ("activetranslation", S),
        ("completedscripture", S),
        ("latestpublicationyear", I),
    ),
    "bible_info": _schema(("scriptural_association", S), ("bible_section", S)),
    "uw_translation_products": _schema(
        ("language_engagement_id", L),
        ("resource_package", S),
        ("resource_format", S),
        ("scriptural_association", S),
        ("scripture_text_name", S),
        ("product_status", S),
    ),
    "training_events": _schema(("Category of Training", S)),
    # Read by the reference but never consumed; no columns are required.
    "joshua_project_data": _schema(),
    "language_engagements_organizations": _schema(),
}

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Decimal digits that always fit.
_WHOLE_DIGITS = {T.ByteType: 2, T.ShortType: 4, T.IntegerType: 9, T.LongType: 18}


class SchemaError(ValueError):
    """An input does not carry a required column or its type is incompatible."""


def _widenable(actual: T.DataType, declared: T.DataType) -> bool:
    if actual == declared:
        return True
    if not isinstance(declared, _INTEGRAL):
        return False
    if isinstance(actual, _INTEGRAL):
        return _INTEGRAL.index(type(actual)) < _INTEGRAL.index(type(declared))
    # A year that arrives as DECIMAL(4,0) from a JDBC source is still a year.
    if isinstance(actual, T.DecimalType):
        return actual.scale == 0 and actual.precision <= _WHOLE_DIGITS[type(declared)]
    return False


def conform(df: DataFrame, name: str, schemas: dict[str, T.StructType] | None = None) -> DataFrame:
    """Check ``df`` against the declared schema of table ``name``.

    Integral columns are widened to the declared type, never narrowed; every other column is
    passed through untouched and in its original order.
    """
    declared = (schemas or REFERENCE_SCHEMAS)[name]
    actual = {f.name: f.dataType for f in df.schema.fields}
    casts = {}
    for field in declared.fields:
        if field.name not in actual:
            raise SchemaError(f"{name}: missing column {field.name!r}")
        have = actual[field.name]
        if have == field.dataType:
            continue
        if not _widenable(have, field.dataType):
            raise SchemaError(
                f"{name}.{field.name}: type {have.simpleString()} is not compatible "
                f"with declared {field.dataType.simpleString()}"
            )
        casts[field.name] = field.dataType
    if not casts:
        return df
    return df.select(
        *[
            F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
