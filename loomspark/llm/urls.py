"""URL filters that follow redirects and canonical links.

Host and path rules judge a url first; the longest rule that fits wins. Rules
are a table of any size, found by equal keys: a url's host and its parent
domains meet the rules' hosts, which tell the lengths of their paths, and its
path, cut to these lengths, meets the rules' paths. Urls that no rule fits
take over the decision of their aliases: urls of one normal form are one
node, redirects and canonical links are edges between nodes, and within a
connected component a block spreads to all aliases unless one of them is
explicitly allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, table, written
from .components import components

#: Entities that urls in attributes hold, the ampersand last.
ENTITIES = [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"), ("&amp;", "&")]
#: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, host string, path string")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) to the rule that fits and is longest: rule and verdict; those that no rule fits don't appear.

    A rule fits its host and all subdomains where the path starts with the
    rule's. Of equally long rules the first by text wins, of equal ones the
    first by verdict (allow). Rules without a host or a path fit nothing.
    """
    r = rules.where("host is not null and path is not null and verdict is not null").select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict", F.length("path").alias("length")
    )
    lengths = r.groupBy("rule_host").agg(F.collect_set("length").alias("lengths"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    x = urls.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes)).join(lengths, "rule_host")
    x = x.withColumn("length", F.explode(F.filter("lengths", lambda n: n <= F.length("path")))).drop("lengths")
    x = x.withColumn("rule_path", F.substring("path", F.lit(1), F.col("length"))).join(r, ["rule_host", "rule_path", "length"])
    rule = F.concat("rule_host", "rule_path")
    best = F.min_by(F.struct(rule.alias("rule"), "verdict"), F.struct(-F.length(rule), rule, "verdict"))
    return x.groupBy("host", "path").agg(best.alias("found")).select("host", "path", "found")


def normal_form(url: Column) -> Column:
    """Without scheme, www. or m., tracking parameters, fragment, .html and last slash; null where there is no host."""
    host = F.regexp_replace(host_of(url), r"^(www\d?|m|mobile|amp)\.", "")
    path = F.regexp_replace(path_of(url), r"(/index)?(\.html?)?/*$", "")
    query = F.regexp_extract(_rest(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    left = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_\w+|ref|fbclid|gclid)(=|$)"))), "&")
    return F.when(host != "", F.concat_ws("?", F.concat(host, path), F.when(left != "", left)))


def resolve(base: Column, ref: Column) -> Column:
    """The url that a reference means on a page at ``base``; null for an empty one, a fragment, or a relative one without a host."""
    here, path, tail = path_of(base), F.regexp_extract(ref, r"(?s)^([^?#]*)", 1), F.regexp_extract(ref, r"(?s)^[^?#]*(.*)", 1)
    whole = F.when(path == "", here).when(path.startswith("/"), path).otherwise(F.concat(F.regexp_extract(here, r"(?s)^(.*/)", 1), path))
    step = lambda a, x: F.when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(x == ".", a).otherwise(F.concat(a, F.array(x)))
    steps = F.aggregate(F.split(F.regexp_replace(whole, "^/", ""), "/"), F.array().cast("array<string>"), step)
    on_host = F.when(host_of(base) != "", F.concat(F.lit("http://"), host_of(base), F.lit("/"), F.array_join(steps, "/"), tail))
    given = (ref != "") & ~ref.startswith("#")
    return F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref).when(ref.startswith("//"), F.concat(F.lit("http:"), ref)).when(given, on_host)


def attributes(tag: Column) -> Column:
    """A tag's attributes as it has them, names with their values; each character is looked at once or twice, however long the tag is."""
    return F.regexp_extract_all(tag, F.lit(r"(?s)[^\s\"'>/=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+"), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """The value of the first attribute (of ``attributes``) of a name in any case, quoted or not, with the common entities decoded; empty if there is none."""
    own = F.get(F.filter(tag, lambda a: a.rlike(rf"(?is)^{name}\s*+=")), 0)
    value = F.regexp_extract(own, r"(?s)^[^=]*+=\s*+(.*)$", 1)
    value = F.coalesce(F.when(value.rlike("^[\"']"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value), F.lit(""))
    for entity, char in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return F.btrim(value, F.lit(SPACES))


def linked_urls(url: Column, html: Column) -> Column:
    """The targets of all canonical links and refreshes of a page, relative ones resolved against its base or else its url.

    A link is canonical if that is one of the words of its ``rel``, in any
    case. Tags within comments are none.
    """
    html = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", "")
    tags = lambda name: F.transform(F.regexp_extract_all(html, F.lit(rf"(?is)<{name}(?=[\s/])(?:[^\"'<>]++|\"[^\"]*+\"|'[^']*+')*+>"), F.lit(0)), attributes)
    is_canonical = lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical")
    is_refresh = lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh"
    refresh = lambda t: F.regexp_extract(_attribute(t, "content"), r"(?is)^\s*[\d.]*\s*[;,\s]\s*url\s*=\s*[\"']?([^\"'\s]+)", 1)
    canonical = F.transform(F.filter(tags("link"), is_canonical), lambda t: _attribute(t, "href"))
    moved = F.transform(F.filter(tags("meta"), is_refresh), refresh)
    own = F.get(F.transform(tags("base"), lambda t: _attribute(t, "href")), 0)
    to = lambda base: F.transform(F.concat(canonical, moved), lambda x: resolve(base, x))
    bound = F.transform(F.array(F.coalesce(resolve(url, own), url)), to)  # so that the base is found once a page, not once a link
    return F.array_distinct(F.array_compact(F.get(bound, 0)))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """One row a page: page_id, host, path, rule (null where none fits), verdict (allow or block).

    ``rules`` (verdict, host, path) may be of any number. ``redirects``
    (from_url, to_url) adds edges to those found in ``html``. A null url, or
    one without ``://``, has empty host and path, fits no rule, has no
    aliases and is allowed. Null or empty html has no links; a page of any
    length is searched whole. Every row is judged, repeated rows and ids
    too. Without rules all is allowed. An empty table gives no rows. Other
    columns are not looked at.
    """
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    # html without any such tag, most of it, needs no search
    html = F.when(F.col("html").rlike(r"(?i)<(link|meta)[\s/]"), F.col("html"))
    x = pages.select("page_id", host.alias("host"), path.alias("path"), normal_form(url).alias("node"), F.transform(linked_urls(url, html), normal_form).alias("to"))
    x = written(x, "url-pages")
    found = matched(x, rules)
    x = written(x.join(found, ["host", "path"], "left"), "url-ruled")
    edges = x.where("node is not null").select(F.col("node").alias("a"), F.explode("to").alias("b")).where("b is not null")
    if redirects is not None:
        edges = edges.union(redirects.select(normal_form(F.col("from_url")), normal_form(F.col("to_url"))))
    joined = components(edges)
    decided = x.where("found is not null and node is not null").groupBy("node").agg(
        F.max(F.col("found.verdict") == "allow").alias("allowed"), F.max(F.col("found.verdict") == "block").alias("blocked")
    )
    of = joined.withColumnRenamed("node", "n")
    decided = decided.join(of, decided["node"] == of["n"], "left").select(F.coalesce("component", "node").alias("component"), "allowed", "blocked")
    decided = decided.groupBy("component").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    spread = written(decided.where("blocked and not allowed").select("component", F.lit("block").alias("spread")), "url-spread")
    open_ = x.where("found is null")
    open_ = open_.join(of, open_["node"] == of["n"], "left").withColumn("component", F.coalesce("component", "node")).join(spread, "component", "left")
    none = F.lit(None).cast("string")
    return x.where("found is not null").select("page_id", "host", "path", "found.rule", "found.verdict").union(
        open_.select("page_id", "host", "path", none.alias("rule"), F.coalesce("spread", F.lit("allow")))
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rules_table(spark, RULES))


_NORMAL = r"""
CASE WHEN {host} <> '' THEN regexp_replace({host}, '^(www\d?|m|mobile|amp)\.', '') || regexp_replace({path}, '(/index)?(\.html?)?/*$', '')
  || CASE WHEN len({left}) > 0 THEN '?' || array_to_string(list_sort({left}), '&') ELSE '' END END"""
_LEFT = r"list_filter(string_split(regexp_extract({rest}, '(?s)^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_\w+|ref|fbclid|gclid)(=|$)'))"
_REST = "CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"
_HOST = "translate(regexp_extract({rest}, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({rest}, '(?s)^[^/?#]*([^?#]*)', 1)"


def _form(rest: str) -> str:
    return _NORMAL.format(host=_HOST.format(rest=rest), path=_PATH.format(rest=rest), left=_LEFT.format(rest=rest))


_FITS = "WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
_CASES = " ".join(_FITS.format(h=h, p=p) for _, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])))
_BLOCKS = ", ".join(f"'{h}{p}'" for v, h, p in RULES if v == "block")
SQL7 = rf"""
WITH RECURSIVE u AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
l AS (SELECT *, {_REST.format(url="url")} AS rest,
  list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\s[^>]*>'), lambda t: regexp_matches(t, '(?is)\srel\s*=\s*(["''][^"'']*\bcanonical\b[^"'']*["'']|canonical[\s/>])')), lambda t: regexp_extract(t, '(?is)\shref\s*=\s*["'']?([^"''>\s]+)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\s[^>]*>'), lambda t: regexp_matches(t, '(?is)\shttp-equiv\s*=\s*["'']?refresh["''\s/>]')), lambda t: regexp_extract(t, '(?is)[;,\s]\s*url\s*=\s*["'']?([^"''>\s]+)', 1))) AS links FROM u),
p AS (SELECT *, {_HOST.format(rest="rest")} AS host, {_PATH.format(rest="rest")} AS path, {_form("rest")} AS node,
  list_filter(links, lambda t: t <> '') AS targets FROM l),
j AS (SELECT *, CASE {_CASES} END AS rule FROM p),
g AS (SELECT node, host, replace(unnest(targets), '&amp;', '&') AS link FROM j),
t AS (SELECT node, {_REST.format(url="target")} AS trest FROM (SELECT node, CASE WHEN starts_with(link, '//') THEN 'http:' || link WHEN starts_with(link, '/') THEN 'http://' || host || link ELSE link END AS target FROM g)),
e AS (SELECT DISTINCT node AS a, {_form("trest")} AS b FROM t),
s AS (SELECT a, b FROM e WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM e WHERE a IS NOT NULL AND b IS NOT NULL),
reach AS (SELECT a, b FROM s UNION SELECT reach.a, s.b FROM reach JOIN s ON reach.b = s.a),
comp AS (SELECT a AS node, least(a, min(b)) AS c FROM reach GROUP BY a),
k AS (SELECT j.*, coalesce(comp.c, j.node) AS c2 FROM j LEFT JOIN comp ON j.node = comp.node),
d AS (SELECT c2, bool_or(rule NOT IN ({_BLOCKS})) AS allowed, bool_or(rule IN ({_BLOCKS})) AS blocked FROM k WHERE rule IS NOT NULL AND c2 IS NOT NULL GROUP BY c2)
SELECT page_id, host, path, rule, CASE WHEN rule IN ({_BLOCKS}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN blocked AND NOT allowed THEN 'block' ELSE 'allow' END AS verdict
FROM k LEFT JOIN d ON k.c2 = d.c2
"""
