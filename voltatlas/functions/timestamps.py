"""Timestamp coercion, clamping and text.  All results are timestamp_ntz in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.functions.values import as_column, let, to_double

# The trusted window.
MIN_TS = "2000-01-01 00:00:00"
MAX_TS = "2100-01-01 00:00:00"

# Seconds of 0001-01-01 and 9999-12-31T23:59:59.
_FIRST_SECOND = -62135596800.0
_LAST_SECOND = 253402300799.0

# Date texts read besides ISO.
EXTRA_FORMATS = ["yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "d MMM yyyy", "MMM d, yyyy", "d-MMM-yyyy", "MMM d yyyy", "d MMM yyyy HH:mm:ss"]


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def epoch_to_ts(value: Column | str) -> Column:
    """Epoch number to timestamp; the unit (s, ms, us, ns) follows from its size."""

    def seconds(x: Column) -> Column:
        size = F.abs(x)
        return (
            F.when(size >= 1e18, x / 1e9)
            .when(size >= 1e15, x / 1e6)
            .when(size >= 1e12, x / 1e3)
            .otherwise(x)
        )

    def stamp(s: Column) -> Column:
        whole = F.when(s < 0, F.ceil(s)).otherwise(F.floor(s))
        micros = F.rint((s - whole) * 1e6).cast("long") + whole * F.lit(1000000)
        return F.when(s.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_micros(micros))

    x = as_column(value).cast("double")
    return let(let(x, seconds), stamp).cast("timestamp_ntz")


def parse_iso(text: Column | str) -> Column:
    """ISO text, with or without zone, to UTC; then a few common date texts."""
    s = as_column(text)
    # A weekday before the date says nothing new, and the zones are UTC.
    plain = F.regexp_replace(s, r"^[A-Za-z]{3,9},\s*|\s+(?:GMT|UTC|[+]0000)$", "")
    other = F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in EXTRA_FORMATS])
    # Text in ISO form that is no time is not tried in the other forms.
    return F.coalesce(F.try_to_timestamp(s), F.when(~s.rlike("^[0-9]{4}-"), other)).cast("timestamp_ntz")


def coerce_ts(value: Column | str, mode: str = "numbers_first") -> Column:
    """Text or number to timestamp, NULL when it cannot be read.

    numbers_first  numeric text, then 'seconds_since_epoch=N', then ISO
    struct_first   one outer bracket pair is unwrapped and
                   'seconds_since_epoch' with '=', ':' or space comes first
    Text of only digits, signs and dots is a number or nothing, so the bare
    date 2024-01-01 gives NULL in both.
    """
    s = F.trim(as_column(value).cast("string"))
    if mode == "struct_first":
        s = F.when(
            s.startswith("(") & s.endswith(")") & (F.length(s) > 2),
            F.trim(F.substring(s, F.lit(2), F.length(s) - 2)),
        ).otherwise(s)
        pattern = r"seconds_since_epoch(?:\s*[:=]\s*|\s+)([0-9]+)"
    elif mode == "numbers_first":
        pattern = r"seconds_since_epoch=([0-9]+)"
    else:
        raise ValueError(f"unknown timestamp mode {mode!r}")
    numeric_like = r"^[0-9+.\-]*[0-9][0-9+.\-]*$"

    def read(t: Column) -> Column:
        number = F.when(t.rlike(numeric_like), t).otherwise(
            F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))
        )
        return let(
            number,
            lambda n: F.when(n.isNotNull(), epoch_to_ts(to_double(n))).otherwise(parse_iso(t)),
        )

    return let(s, read)


def coerce_number_ts(value: Column | str) -> Column:
    """Epoch column of a numeric type; NaN is missing."""
    x = as_column(value).cast("double")
    return epoch_to_ts(F.when(~F.isnan(x), x))


def coerce_ts_column(df: DataFrame, name: str, mode: str = "numbers_first") -> Column:
    """The rule that fits the column's declared type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df[name].cast("timestamp_ntz")
    if isinstance(dtype, T.NumericType):
        return coerce_number_ts(df[name])
    if isinstance(dtype, T.StructType):
        return coerce_number_ts(df[name]["seconds_since_epoch"])
    return coerce_ts(df[name], mode)


def clamp_ts(
    ts: Column | str,
    run_ts: Column | None,
    min_ts: Column | None = None,
    max_ts: Column | None = None,
) -> Column:
    """Missing or implausible timestamps become ``run_ts`` (NULL when None)."""
    ts = as_column(ts)
    low = min_ts if min_ts is not None else ntz(MIN_TS)
    high = max_ts if max_ts is not None else ntz(MAX_TS)
    good = ts.isNotNull() & ts.between(low, high)
    fallback = run_ts if run_ts is not None else F.lit(None).cast("timestamp_ntz")
    return F.when(good, ts).otherwise(fallback)


def repair_ts(ts: Column | str, run_ts: Column) -> Column:
    """The after-load rule: nothing later than a day past the run."""
    return clamp_ts(ts, run_ts, max_ts=run_ts + F.expr("INTERVAL 1 DAY"))


def ts_text(ts: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss.ffffff'."""
    return F.date_format(as_column(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def iso_seconds(ts: Column | str) -> Column:
    """'yyyy-MM-ddTHH:mm:ssZ', as envelopes carry it."""
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def warehouse_ts(text: Column | str) -> Column:
    """Load-time reading: 'seconds_since_epoch' is always nanoseconds, else a safe parse."""
    s = as_column(text).cast("string")
    digits = F.regexp_extract(s, r"seconds_since_epoch\s*[:=\s]+([0-9]+)", 1)
    seconds = digits.try_cast("double") / 1e9
    micros = F.rint(seconds * 1e6).cast("long")
    return F.when(
        s.contains("seconds_since_epoch"), F.timestamp_micros(micros).cast("timestamp_ntz")
    ).otherwise(F.try_to_timestamp(s).cast("timestamp_ntz"))
