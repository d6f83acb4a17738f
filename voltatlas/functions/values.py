"""Scalar coercions: numbers, booleans, ids, JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts read as true and as false.
TRUE_TEXTS = ["true", "t", "yes", "y", "1"]
FALSE_TEXTS = ["false", "f", "no", "n", "0"]

_DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """Work out ``value`` once and use it several times in ``body``.

    A repeated sub-expression is otherwise copied into every use, and a few
    levels of that overflow the size of one generated method.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column that is worked out once per row.

    A plain column is copied into every filter that is pushed below it, so a
    parsed document would be parsed again for each condition on its fields.
    Filters on a generated column stay above it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def to_double(text: Column | str) -> Column:
    """Decimal text to double; anything else (also '1d' or '0x1') to NULL."""
    s = F.trim(as_column(text).cast("string"))
    return F.when(s.rlike(_DECIMAL_TEXT), s.try_cast("double"))


def to_int(value: Column | str) -> Column:
    """Integer part of a number or numeric text, cut toward zero."""
    number = to_double(value)
    return F.when(F.abs(number) < F.lit(9.2e18), number.try_cast("long"))


def to_bool(value: Column | str, numeric: bool = False) -> Column:
    """Truth texts, any case; a numeric column also knows 1.0 and 0.0."""
    s = F.lower(F.trim(as_column(value).cast("string")))
    if numeric:
        number = to_double(s)
        return F.when(number == 1.0, True).when(number == 0.0, False)
    return F.when(s.isin(TRUE_TEXTS), True).when(s.isin(FALSE_TEXTS), False)


def to_bool_column(df: DataFrame, name: str) -> Column:
    """``to_bool`` with the rule that fits the column's declared type."""
    return to_bool(df[name], numeric=isinstance(df.schema[name].dataType, T.NumericType))


def non_empty(df: DataFrame, name: str) -> Column:
    """The column as text, with '' missing and, for numbers, 0 missing."""
    dtype = df.schema[name].dataType
    text = df[name].cast("string")
    if isinstance(dtype, T.NumericType):
        return F.when(df[name] != 0, text)
    return F.when(text != "", text)


def double_text(value: Column | str) -> Column:
    """Shortest decimal text of a double with |x| < 1e7.

    Plain digits down to 1e-4, exponent form below, '.0' kept on whole numbers.
    """
    def spell(s: Column) -> Column:
        mantissa = F.regexp_replace(F.substring_index(s, "E", 1), r"\.0$", "")
        digits = F.regexp_replace(mantissa, r"[-.]", "")
        sign = F.when(s.startswith("-"), "-").otherwise("")
        exponent = F.substring_index(s, "E", -1).try_cast("int")
        small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
        tiny = F.concat(mantissa, F.lit("e-"), F.lpad((-exponent).cast("string"), 2, "0"))
        return F.when(exponent >= -4, small).otherwise(tiny)

    s = as_column(value).cast("double").cast("string")
    return F.when(s.contains("E-"), let(s, spell)).otherwise(s)


def request_point_key(
    df: DataFrame,
    feature_id: str = "road_feature_id",
    osm_id: str = "road_osm_id",
    lat: str = "request_point_lat",
    lon: str = "request_point_lon",
) -> Column:
    """First usable of feature id, map id and 'lat,lon'."""
    point = F.concat(double_text(df[lat]), F.lit(","), double_text(df[lon]))
    return F.coalesce(non_empty(df, feature_id), non_empty(df, osm_id), point)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Every struct, array, map or variant column as JSON text; scalars untouched.

    Decimals print as integers when they are whole and as floats otherwise.
    """
    out = []
    for field in df.schema.fields:
        c = df[field.name]
        if isinstance(field.dataType, T.VariantType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        elif isinstance(field.dataType, T.DecimalType):
            c = F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(
                double_text(c.cast("double"))
            )
        out.append(c.alias(field.name))
    return df.select(*out)


def random_event_id() -> Column:
    return F.uuid() if hasattr(F, "uuid") else F.expr("uuid()")


def stable_event_id(*parts: Column | str) -> Column:
    """The same id on every attempt, so a retried batch adds no new events."""
    texts = [F.coalesce(as_column(p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)
