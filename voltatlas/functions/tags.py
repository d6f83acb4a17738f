"""Tag bags as '"k"=>"v",...' text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltatlas.functions.values import as_column


def tags_encode(tags: Column | str) -> Column:
    """Map to text in map order; NULL values are skipped, quotes escaped."""
    kept = F.filter(F.map_entries(as_column(tags)), lambda e: e["value"].isNotNull())
    return F.array_join(
        F.transform(
            kept,
            lambda e: F.concat(
                F.lit('"'), e["key"], F.lit('"=>"'),
                F.replace(e["value"], F.lit('"'), F.lit('\\"')), F.lit('"'),
            ),
        ),
        ",",
    )


def tags_decode(text: Column | str) -> Column:
    """Text back to a map; commas and escaped quotes inside values survive.

    A repeated key keeps its last value.
    """
    pair = r'"((?:[^"\\]|\\.)*)"=>"((?:[^"\\]|\\.)*)"'
    s = as_column(text)
    keys = F.regexp_extract_all(s, F.lit(pair), F.lit(1))
    values = F.regexp_extract_all(s, F.lit(pair), F.lit(2))
    # Map construction refuses a repeated key, so drop all but the last first.
    n = F.size(keys)
    last = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: ~F.array_contains(F.slice(keys, i + 1, n), F.element_at(keys, i)),
    )
    decoded = F.map_from_entries(
        F.transform(
            last,
            lambda i: F.struct(
                F.element_at(keys, i).alias("key"),
                F.replace(F.element_at(values, i), F.lit('\\"'), F.lit('"')).alias("value"),
            ),
        )
    )
    return F.when(n > 0, decoded).otherwise(F.create_map().cast("map<string,string>"))
