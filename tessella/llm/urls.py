"""URL filters: a blocked Bloom filter of listed URLs before an exact join, native throughout."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import durable
from .registry import query, table

WORDS = 8  # 64-bit words of a block; a key sets one bit in each
BLOCK_BITS = WORDS * 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    blank = lambda c: F.coalesce(c, F.lit(""))
    return blank(F.translate(host, upper, upper.lower())), blank(path)


def _masks(key: str) -> list[Column]:
    bits = f"xxhash64('bits', {key})"
    return [
        F.expr(f"shiftleft(1L, cast(shiftrightunsigned({bits}, {6 * i}) & 63L as int))").alias(f"m{i}")
        for i in range(WORDS)
    ]


def _block(key: str, blocks: int) -> Column:
    return F.expr(f"pmod(xxhash64({key}), {blocks}L)").alias("block")


def blocked_bloom(keys: DataFrame, key: str, bits_per_key: int = 16) -> tuple[DataFrame, int]:
    """The filter as a table (block, w0..w7) without its empty blocks, and the number of blocks.

    A key's first hash names its block, its second one bit in each word, so a probe
    looks at one block only. Filters of any size stay tables: nothing goes to the driver.
    """
    blocks = max(1, ceil(keys.count() * bits_per_key / BLOCK_BITS))
    return (
        durable(
            keys.select(_block(key, blocks), *_masks(key))
            .groupBy("block")
            .agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])
        ),
        blocks,
    )


def possible_hits(rows: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows whose key may be in the filter: all true hits, few others.

    The filter's size is known from its files, so Spark broadcasts it only while small
    and otherwise joins on the block.
    """
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) != 0)
    probed = rows.select(*rows.columns, _block(key, blocks), *_masks(key))
    return probed.join(bloom, "block").where(hit).select(*rows.columns)


#: Characters that mean the same escaped or not (fixed by RFC 3986).
_UNRESERVED = "[A-Za-z0-9._~-]"
#: Parameters that only say where a visit came from.
TRACKING = "^(utm_[^=]*|gclid|fbclid)(=|$)"


def _unescaped(text: Column) -> Column:
    """Escapes of unreserved characters decoded once, the others in capitals."""

    def piece(part: Column) -> Column:
        digits = F.substring(part, 1, 2)
        char = F.char(F.conv(digits, 16, 10).cast("int"))
        after = F.substr(part, F.lit(3))
        return (
            F.when(~part.rlike("^[0-9A-Fa-f]{2}"), F.concat(F.lit("%"), part))
            .when(char.rlike(f"^{_UNRESERVED}$"), F.concat(char, after))
            .otherwise(F.concat(F.lit("%"), F.upper(digits), after))
        )

    parts = F.split(text, "%")
    return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""))


def _without_dots(path: Column) -> Column:
    """The path without ``.`` and ``..`` segments and without slashes at its end."""

    def step(done: Column, part: Column) -> Column:
        return (
            F.when(part == "..", F.regexp_replace(done, "/[^/]*$", ""))
            .when(part == ".", done)
            .otherwise(F.concat(done, F.lit("/"), part))
        )

    parts = F.split(path, "/")
    walked = F.aggregate(F.slice(parts, 2, F.size(parts)), F.lit(""), step)
    return F.regexp_replace(F.when(path.contains("/."), walked).otherwise(path), "/+$", "")


def canonical_url(url: Column, tracking: str = TRACKING) -> Column:
    """Host, path and query of a URL in one spelling; null for null or without ``://``.

    The scheme, user names, fragments, default ports, dots at the host's end, slashes at the
    path's end and parameters that fit ``tracking`` go; A-Z of the host becomes small; escapes
    are decoded where they need not be; dot segments are resolved; parameters are sorted.
    """
    at = F.locate("://", url)
    scheme = F.lower(F.substr(url, F.lit(1), at - 1))
    rest = F.regexp_extract(F.substr(url, at + 3), "^[^#]*", 0)
    authority = F.regexp_extract(rest, "^[^/?]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(authority) + 1), "^[^?]*", 0)
    asked = F.substr(rest, F.length(authority) + F.length(path) + 2)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    named = F.translate(F.regexp_replace(_unescaped(authority), "^.*@", ""), upper, upper.lower())
    port = F.when(scheme == "http", ":80").when(scheme == "https", ":443").otherwise(":")
    named = F.when(F.endswith(named, port), F.substr(named, F.lit(1), F.length(named) - F.length(port))).otherwise(named)
    host = F.regexp_replace(named, r"[.]*:?$", "")
    kept = F.filter(F.split(_unescaped(asked), "&"), lambda p: (p != "") & ~p.rlike(tracking))
    query_part = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")
    whole = F.concat(host, F.lit("/"), F.substr(_without_dots(_unescaped(path)), F.lit(2)), query_part)
    return F.when(at > 0, whole)


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    blocked: DataFrame | None = None,
) -> DataFrame:
    """Judge every row of ``pages`` by the longest listed rule that fits its URL, else by the list of URLs.

    ``listed(host, path, verdict)`` holds rules; one fits its host and all
    subdomains if the URL's path starts with its path. A URL's candidates are its host's
    ends at label borders that have rules, each with the beginnings of the path as long as
    a path listed for that host. Of the rules that fit, the longest wins. Where none fits,
    the verdict is ``block`` if ``blocked(url)`` lists the URL, both spelled by
    `canonical_url`, and ``default`` if not. Hosts, candidates and URLs pass a
    blocked Bloom filter first; what passes is joined exactly.

    Returns page_id, host, path, rule (host and path, or null) and verdict, one row for
    each row of ``pages``, repeated ones too. A null URL or one without ``://`` has empty
    host and path, no rule, and is not listed. Of a rule listed twice, block wins; null
    entries and empty lists fit nothing. Very long URLs are judged whole. Other columns are ignored.
    """
    entries = durable(
        listed.select(F.concat("host", "path").alias("key"), "host", "path", "verdict")
        .where(F.col("key").isNotNull())
        .groupBy("key", "host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select("key", "host", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"), "verdict")
    )
    # A host's path lengths are at most as many as its longest path has characters.
    hosts = durable(entries.groupBy("host").agg(F.collect_set("chars").alias("lengths")))
    host, path = host_and_path(F.col(f"`{url_col}`"))
    urls = durable(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id_col}`").alias("page_id"),
            host.alias("host"),
            path.alias("path"),
            canonical_url(F.col(f"`{url_col}`")).alias("canonical"),
        )
    )
    # One number for each count of labels that a listed host has.
    counts = sorted(r.labels for r in entries.select("labels").distinct().collect())
    judged = urls.withColumn("best", F.lit(None).cast("struct<n:int,labels:int,key:string,verdict:string>"))
    if counts:
        ends = F.array(
            *[F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n)) for n in counts]
        )
        probes = urls.select("row", "path", F.explode(F.array_distinct(ends)).alias("end")).where("end IS NOT NULL")
        on_host = possible_hits(probes, "end", *blocked_bloom(hosts, "host")).join(
            hosts.withColumnRenamed("host", "end"), "end"
        )
        begun = on_host.select("row", "path", "end", F.explode("lengths").alias("chars")).where(
            F.length("path") >= F.col("chars")
        )
        keyed = begun.select("row", F.expr("concat(end, substring(path, 1, chars))").alias("key"))
        hits = possible_hits(keyed, "key", *blocked_bloom(entries, "key")).join(entries, "key")
        best = hits.groupBy("row").agg(F.max(F.struct(F.length("key").alias("n"), "labels", "key", "verdict")).alias("best"))
        judged = urls.join(best, "row", "left")
    if blocked is None:
        found = judged.withColumn("hit", F.lit(False))
    else:
        keys = durable(
            blocked.select(canonical_url(F.col("url")).alias("canonical")).where("canonical IS NOT NULL").distinct()
        )
        passed = possible_hits(
            urls.select("row", "canonical").where("canonical IS NOT NULL"), "canonical", *blocked_bloom(keys, "canonical")
        )
        certain = durable(passed.join(keys, "canonical").select("row", F.lit(True).alias("hit")))
        found = judged.join(certain, "row", "left")
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("hit"), "block"), F.lit(default)).alias("verdict"),
    )


#: Entries (host, path, verdict) that the check of this operator fixes.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _rules_sql(value: int) -> str:
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    return " ".join(f"WHEN {fits.format(*r)} THEN '{(r[0] + r[1], r[2])[value]}'" for r in longest)


_CANONICAL_SQL = r"""
parts AS (
  SELECT page_id, lower(substr(url, 1, strpos(url, '://') - 1)) AS scheme,
    regexp_extract(substr(url, strpos(url, '://') + 3), '^[^#]*') AS rest FROM pages WHERE strpos(url, '://') > 0),
cut AS (SELECT *, regexp_extract(rest, '^[^/?]*') AS authority FROM parts),
cut_path AS (SELECT *, regexp_extract(substr(rest, length(authority) + 1), '^[^?]*') AS raw_path FROM cut),
plain AS (
  SELECT page_id, scheme, {authority} AS authority, {raw_path} AS path, {asked} AS asked
  FROM (SELECT *, substr(rest, length(authority) + length(raw_path) + 2) AS asked FROM cut_path)),
named AS (
  SELECT page_id, path, asked, translate(regexp_replace(authority, '^.*@', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS named,
    CASE scheme WHEN 'http' THEN ':80' WHEN 'https' THEN ':443' ELSE ':' END AS port FROM plain),
canonical AS (
  SELECT page_id,
    regexp_replace(CASE WHEN ends_with(named, port) THEN substr(named, 1, length(named) - length(port)) ELSE named END, '[.]*:?$', '')
    || '/' || substr(regexp_replace(CASE WHEN contains(path, '/.') THEN list_reduce(
        list_concat([''], string_split(path, '/')[2:]),
        lambda done, part: CASE part WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') WHEN '.' THEN done ELSE done || '/' || part END)
      ELSE path END, '/+$', ''), 2)
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_sort(kept), '&') ELSE '' END AS canonical
  FROM (SELECT *, list_filter(string_split(asked, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '%TRACKING%')) AS kept FROM named))
"""


def _unescaped_sql(column: str) -> str:
    char = "chr(CAST('0x' || substr(p, 1, 2) AS INTEGER))"
    return f"""string_split({column}, '%')[1] || array_to_string(list_transform(string_split({column}, '%')[2:], lambda p:
      CASE WHEN NOT regexp_matches(p, '^[0-9A-Fa-f]{{2}}') THEN '%' || p
      WHEN regexp_matches({char}, '^{_UNRESERVED}$') THEN {char} || substr(p, 3)
      ELSE '%' || upper(substr(p, 1, 2)) || substr(p, 3) END), '')"""


def _canonical_sql() -> str:
    """``canonical(page_id, canonical)`` of all URLs that have ``://``."""
    sql = _CANONICAL_SQL.replace("%TRACKING%", TRACKING)
    for column in ("authority", "raw_path", "asked"):
        sql = sql.replace("{" + column + "}", _unescaped_sql(column))
    return sql.strip()


#: Pages whose id this divides stand for a published list of URLs.
LISTED_EVERY = 20


@query(f"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
c AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
{_canonical_sql()},
listed AS (SELECT DISTINCT canonical FROM canonical WHERE page_id % {LISTED_EVERY} = 0)
SELECT c.page_id, host, path, CASE {_rules_sql(0)} END AS rule,
  CASE {_rules_sql(1)} WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM c LEFT JOIN canonical USING (page_id) LEFT JOIN listed USING (canonical)
""")
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL; where no rule fits, listed URLs are blocked."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    listed = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, verdict)")
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, listed, blocked=pages.where(F.col("page_id") % LISTED_EVERY == 0).select("url"))
