"""Semi-structured values: paths with fallbacks, usage aliases, attribute lists, recursive rewrites.

Paths and aliases are VARIANT expressions. What recurses to any depth cannot be
an expression and is an Arrow-batched Pandas UDF; its docstring says so.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import active

# --- fixed values: usage aliases ---------------------------------------------------------------
USAGE = {
    "input_tokens": ["input_tokens", "prompt_tokens", "inputTokens", "promptTokens"],
    "cached_input_tokens": ["cached_input_tokens", "cache_read_input_tokens", "input_tokens_details.cached_tokens", "cache_read_tokens", "cacheReadTokens"],
    "cache_creation_input_tokens": ["cache_creation_input_tokens", "cache_write_input_tokens", "cache_write_tokens", "cache_creation_tokens", "cacheCreateTokens"],
    "output_tokens": ["output_tokens", "completion_tokens", "outputTokens", "completionTokens"],
    "reasoning_tokens": ["reasoning_tokens", "reasoning_output_tokens", "output_tokens_details.reasoning_tokens"],
    "total_tokens": ["total_tokens", "totalTokens", "allTokens"],
}
#: Names of keys whose values are masked, as they are without anything but letters and digits, in lower case.
SENSITIVE_KEYS = [
    "authorization", "cookie", "setcookie", "proxyauthorization", "xapikey", "xauthtoken", "password", "secret", "apikey", "accesstoken", "refreshtoken",
    "phone", "phonenumber", "mobilephone", "telephone", "tel", "mobile", "email", "emailaddress",
    "address", "streetaddress", "shippingaddress", "billingaddress", "homeaddress", "workaddress", "postaladdress",
    "idcard", "identitycard", "idnumber", "nationalid", "passport", "passportnumber", "bankcard", "creditcard", "ssn",
    "fullname", "firstname", "lastname", "givenname", "familyname", "personname", "contactname", "recipientname", "customername", "patientname", "realname", "username",
]
BASE64_KEYS = ["b64_json", "base64", "image_base64", "audio_base64"]
# -----------------------------------------------------------------------------------------------


def pick(v: Column, paths: list[str], kind: str = "string") -> Column:
    """The first path that holds a value of the kind; blank strings count as missing."""
    got = [F.try_variant_get(v, p, kind) for p in paths]
    if kind == "string":
        got = [F.when(F.trim(c) != "", c) for c in got]
    return F.coalesce(*got)


def usage(v: Column) -> Column:
    """A5: struct of token counts from any known alias, numbers or numeric strings; total is at least input plus output."""
    def count(names: list[str]) -> Column:
        return F.coalesce(*[F.coalesce(F.try_variant_get(v, f"$.{n}", "long"), F.try_variant_get(v, f"$.{n}", "string").try_cast("long")) for n in names])

    found = {k: count(names) for k, names in USAGE.items()}
    parts = F.when(found["input_tokens"].isNotNull() | found["output_tokens"].isNotNull(), F.coalesce(found["input_tokens"], F.lit(0)) + F.coalesce(found["output_tokens"], F.lit(0)))
    found["total_tokens"] = F.greatest(found["total_tokens"], parts)
    return F.struct(*[c.alias(k) for k, c in found.items()])


def any_value(v: Column) -> Column:
    """One OTLP AnyValue to text, whatever its kind."""
    return F.coalesce(
        F.try_variant_get(v, "$.stringValue", "string"),
        F.try_variant_get(v, "$.intValue", "string"),
        F.try_variant_get(v, "$.doubleValue", "string"),
        F.try_variant_get(v, "$.boolValue", "string"),
        F.to_json(F.try_variant_get(v, "$.arrayValue.values", "variant")),
        F.to_json(F.try_variant_get(v, "$.kvlistValue.values", "variant")),
    )


def whole_json(text: Column) -> Column:
    """The VARIANT of a text that is one JSON value and nothing else, or null; the parser by itself takes a value that something follows."""
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(items) == 1, F.get(items, F.lit(0)))


def attributes(rows: DataFrame, keys: list[str], attrs: str) -> DataFrame:
    """Attribute list (JSON text of ``[{key, value}]``) to a map for each of ``keys``.

    Equal duplicates collapse; a key with different values is left out of the
    map and named in ``conflicts``.
    """
    parsed = rows.select(*keys, F.try_parse_json(attrs).alias("v"))
    at = F.from_json(F.to_json("v"), "array<struct<key:string,value:string>>")
    flat = parsed.select(*keys, F.explode(at).alias("a")).where("a.key is not null")
    flat = flat.select(*keys, F.col("a.key").alias("key"), any_value(F.try_parse_json("a.value")).alias("value")).distinct()
    one = flat.groupBy(*keys, "key").agg(F.min("value").alias("value"), F.count("*").alias("n"))
    return one.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("n") == 1, F.struct("key", "value"))))).alias("attributes"),
        F.sort_array(F.collect_list(F.when(F.col("n") > 1, F.col("key")))).alias("conflicts"),
    )


def _walk(value, leaf, whole=None):
    """Leaves rewritten by ``leaf(key, value)``, in order; ``whole(key)`` may replace a value of any kind by something that isn't None. By a stack of its own, so to any depth."""
    out: list = [None]
    todo = [(out, 0, None, value)]
    while todo:
        holder, at, key, v = todo.pop()
        if isinstance(v, dict):
            holder[at] = made = dict.fromkeys(v)
            put = {k: whole(k) for k in v} if whole else {}
            made.update({k: x for k, x in put.items() if x is not None})
            todo += [(made, k, k, x) for k, x in reversed(v.items()) if put.get(k) is None]
        elif isinstance(v, list):
            holder[at] = made = [None] * len(v)
            todo += [(made, i, key, x) for i, x in reversed(list(enumerate(v)))]
        else:
            holder[at] = leaf(key, v)
    return out[0]


#: What isn't JSON, or is nested deeper than the parser goes (some ten thousand levels).
UNREADABLE = (ValueError, RecursionError)


def rewritten(leaf, whole=None):
    """A Pandas UDF that rewrites all leaves of JSON texts; texts that can't be read become null."""
    active()

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else json.dumps(_walk(json.loads(t), leaf, whole), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
            except UNREADABLE:
                return None

        return texts.map(one)

    return run


def mask_json(c: Column, mask: str | None = None) -> Column:
    """P12, recursive: values of sensitive keys go whole, whatever they are; other strings by pattern."""
    import regex

    from . import text

    mask = text.MASK if mask is None else mask
    patterns = [regex.compile(p.replace(r"\p{IsHan}", r"\p{Han}")) for p in text.MASKED_PATTERNS]
    card, sensitive = regex.compile(text.CN_ID), {*SENSITIVE_KEYS}
    plain = lambda k: "".join(x for x in k if x.isascii() and x.isalnum()).lower()

    def leaf(key, v):
        if isinstance(v, str):
            for p in patterns:
                v = p.sub(lambda _: mask, v)
            v = card.sub(lambda m: m[1] + mask + m[3], v)
        return v

    return rewritten(leaf, lambda k: mask if plain(k) in sensitive else None)(c)


def scrub_json(c: Column) -> Column:
    """P14, recursive: strings of known keys and data urls are cut."""
    return scrubbed_json(c)["json"]


def scrubbed_json(c: Column) -> Column:
    """P14 with its account: the scrubbed JSON, and how many bytes of strings were cut; both null for texts that can't be read."""
    from . import text

    active()
    keys, mask = {*BASE64_KEYS}, text.BASE64_MASK

    @F.pandas_udf("json string, excluded long")
    def run(texts: pd.Series) -> pd.DataFrame:
        def one(t):
            cut = 0

            def leaf(key, v):
                nonlocal cut
                if isinstance(v, str) and (key is not None and key.lower() in keys or b";base64," in v.encode("utf-8", "surrogatepass")[:128].lower()):
                    cut += len(v.encode("utf-8", "surrogatepass"))
                    return mask
                return v

            try:
                return (None, None) if t is None else (json.dumps(_walk(json.loads(t), leaf), ensure_ascii=False, sort_keys=True, separators=(",", ":")), cut)
            except UNREADABLE:
                return None, None

        return pd.DataFrame([one(t) for t in texts], columns=["json", "excluded"]).astype({"excluded": "Int64"})

    return run(c)


def all_text(c: Column) -> Column:
    """All strings of a JSON text, in order, to any depth, joined by line feeds."""
    active()
    return _all_text(c)


@F.pandas_udf(T.StringType())
def _all_text(texts: pd.Series) -> pd.Series:
    def one(t):
        out: list[str] = []
        try:
            _walk(json.loads(t), lambda _, v: out.append(v) if isinstance(v, str) else None)
        except (*UNREADABLE, TypeError):
            return None
        return "\n".join(out)

    return texts.map(one)


def nested_usage(c: Column) -> Column:
    """The first object named ``usage``, at any depth but below ``tool_usage``, as JSON."""
    active()
    return _nested_usage(c)


@F.pandas_udf(T.StringType())
def _nested_usage(texts: pd.Series) -> pd.Series:
    def find(v):
        todo = [v]
        while todo:
            v = todo.pop()
            if isinstance(v, dict):
                if isinstance(v.get("usage"), dict):
                    return v["usage"]
                todo += [x for k, x in reversed(v.items()) if k != "tool_usage"]
            elif isinstance(v, list):
                todo += reversed(v)
        return None

    def one(t):
        try:
            found = find(json.loads(t))
        except (*UNREADABLE, TypeError):
            return None
        return None if found is None else json.dumps(found, sort_keys=True)

    return texts.map(one)
