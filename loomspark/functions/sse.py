"""Server-sent events as expressions: frames of clean input, the model named last. ``operators.streams`` recovers frames and rebuilds messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def frames(body: Column) -> Column:
    """Clean SSE text to an array of structs (event, data): frames end at blank lines."""
    blocks = F.filter(F.split(F.regexp_replace(body, "\r\n", "\n"), "\n\n+"), lambda b: F.trim(b) != "")
    line = lambda b, k: F.array_join(F.transform(F.filter(F.split(b, "\n"), lambda x: x.startswith(k)), lambda x: F.ltrim(F.substring(x, len(k) + 1, 1 << 30))), "\n")
    return F.transform(blocks, lambda b: F.struct(line(b, "event:").alias("event"), line(b, "data:").alias("data")))


def last_model(body: Column) -> Column:
    """The last non-empty model named in a stream."""
    found = F.filter(F.regexp_extract_all(body, F.lit(r'"model"\s*:\s*"([^"]*)"'), F.lit(1)), lambda m: m != "")
    return F.try_element_at(found, F.lit(-1))
