"""What an HTTP answer means, and how it may be written down."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltatlas.functions.values import as_column

# Status classes.
RETRYABLE = [429, 500, 502, 503, 504]
PERMANENT = [400, 401, 403, 404]

# Error text length by job, with the mark that shows the cut.
ERROR_LIMITS = {"station_stream": (300, "..."), "traffic_body": (500, "…"), "traffic_row": (800, "…")}


def outcome(status: Column | str, policy: str = "traffic") -> Column:
    """ok, retryable, permanent or other.

    traffic  only the listed permanent codes end the attempt
    station  every other status from 400 up ends it
    """
    status = as_column(status)
    permanent = status.isin(PERMANENT) if policy == "traffic" else status >= 400
    return (
        F.when(status.isNull(), "other")
        .when(status.isin(RETRYABLE), "retryable")
        .when(permanent, "permanent")
        .when(status < 400, "ok")
        .otherwise("other")
    )


def error_text(text: Column | str, limit: int, mark: str = "…") -> Column:
    """Trimmed text, cut at ``limit`` characters with a mark behind the cut."""
    s = F.trim(as_column(text))
    return F.when(F.length(s) > limit, F.concat(F.left(s, F.lit(limit)), F.lit(mark))).otherwise(s)


def status_message(status: Column | str, body: Column | str, limit: int = 500, mark: str = "…") -> Column:
    """'HTTP 403: snippet', or 'HTTP 403' when the body is blank."""
    snippet = F.nullif(error_text(body, limit, mark), F.lit(""))
    head = F.concat(F.lit("HTTP "), as_column(status).cast("string"))
    return F.when(snippet.isNull(), head).otherwise(F.concat(head, F.lit(": "), snippet))


def redact_params(params: Column | str, secret: str = "key") -> Column:
    """Parameter map with the secret's value masked."""
    return F.transform_values(
        as_column(params), lambda k, v: F.when(k == secret, F.lit("***")).otherwise(v)
    )


def redact_query(url: Column | str, secret: str = "key") -> Column:
    """The same for a parameter inside a URL."""
    return F.regexp_replace(as_column(url), rf"([?&]{secret}=)[^&#]*", "$1***")
