"""Token counts with a rank-file vocabulary, given by path. A Pandas UDF, as merges are beyond expressions."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import active


@lru_cache(2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_count(path: str, pattern: str):
    """A UDF from text to its number of tokens; null counts none."""

    active()

    @F.pandas_udf(T.LongType())
    def run(texts: pd.Series) -> pd.Series:
        enc = _encoding(path, pattern)
        return texts.map(lambda t: len(enc.encode_ordinary(t)) if t else 0).astype("int64")

    return run
