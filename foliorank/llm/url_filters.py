"""URL filters with redirect equivalence, in DataFrame functions alone.

A rule names a host and the start of a path; it fits the host and its subdomains,
and the longest fitting rule decides. Pages that redirect to, or declare as
canonical, one another are aliases: distributed connected components over those
edges carry a block to every alias without a rule of its own. An explicit allow
stands before a propagated block, and a page that nothing blocks is allowed.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliorank.storage import write_once

from .common import components, lower_ascii

# (verdict, rule): the part before the first slash is the host, the rest the path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one and for null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict), null if none fits.

    The rule list is a parameter of the query, compiled into one expression. Of
    equal rules the allowing one is taken.
    """
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0] == "allow")):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def address(url: Column) -> Column:
    """A url as a node: host and what follows it, without scheme, default port and fragment.

    An empty path is the path ``/``.
    """
    rest = after_scheme(url)
    scheme = F.lower(F.substring_index(url, "://", 1))
    port = F.when(scheme == "http", ":80$").when(scheme == "https", ":443$").otherwise("$")
    tail = F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)
    return F.when(
        rest != "",
        F.concat(F.regexp_replace(host(url), port, F.lit("")), F.when(F.startswith(tail, F.lit("/")), "").otherwise("/"), tail),
    )


_TAG = {
    "canonical": (r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*>", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"),
    "refresh": (
        r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*>",
        r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)",
    ),
}


_COMMENT = "(?s)<!--.*?-->"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


def _without_dots(path: Column) -> Column:
    """A path from its first slash on, with its ``.`` and ``..`` segments resolved."""
    parts = F.split(F.substr(path, F.lit(2)), "/", -1)
    none = F.array().cast("array<string>")
    kept = F.aggregate(
        parts,
        none,
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    # A path that ends in a dot segment names a folder.
    end = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
    plain = F.concat(F.lit("/"), F.array_join(F.concat(kept, end), "/"))
    return F.when(path.contains("/."), plain).otherwise(path)


def resolve(link: Column, url: Column) -> Column:
    """The absolute url of a page's ``link``; null for schemes that name no host (mailto:, data:)."""
    scheme = F.concat(F.substring_index(url, "://", 1), F.lit(":"))
    place = F.concat(scheme, F.lit("//"), host(url))
    own = F.when(path(url) == "", "/").otherwise(path(url))
    tail = F.regexp_extract(link, "[?#].*$", 0)
    named = F.regexp_extract(link, "^[^?#]*", 0)
    folder = F.regexp_extract(own, "^.*/", 0)
    return (
        F.when(link.rlike(_SCHEME + "//"), link)
        .when(link.rlike(_SCHEME), None)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(F.startswith(link, F.lit("/")), F.concat(place, _without_dots(named), tail))
        .when(F.startswith(link, F.lit("?")), F.concat(place, own, link))
        .when(F.startswith(link, F.lit("#")), F.concat(F.substring_index(url, "#", 1), link))
        .otherwise(F.concat(place, _without_dots(F.concat(folder, named)), tail))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """Edges (url, target) that the pages state themselves: all their canonical links and redirects."""

    def targets(tag: str, target: str) -> Column:
        tags = F.regexp_extract_all(F.regexp_replace("html", _COMMENT, ""), F.lit(tag), F.lit(0))
        return F.transform(tags, lambda t: F.replace(F.regexp_extract(t, target, 1), F.lit("&amp;"), F.lit("&")))

    declared = [targets(tag, target) for tag, target in _TAG.values()]
    # Most pages declare nothing: a plain search passes them by before any pattern runs.
    may = F.contains(F.lower("html"), F.lit("canonical")) | F.contains(F.lower("html"), F.lit("http-equiv"))
    return (
        pages.select("url", "html")
        .where(F.col("url").contains("://") & may)
        .select("url", F.explode(F.concat(*declared)).alias("_link"))
        .where("_link <> ''")
        .select("url", resolve(F.col("_link"), F.col("url")).alias("target"))
        .where("target IS NOT NULL")
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    redirects: DataFrame | None = None,
    default: str = "allow",
) -> DataFrame:
    """One row per page: page_id, host, path, rule and verdict.

    ``redirects`` (url, target) adds edges from a crawl's redirect log. Null urls and
    urls without ``://`` have an empty host and path, fit no rule and have no alias.
    Null html declares nothing. Targets relative to the page (a path, dots, a query) are
    resolved against its url, whatever a ``base`` element says; tags inside comments declare
    nothing, and html of any length is read whole. Rows that repeat, null ids and urls that several
    pages share are judged row by row; an empty table gives no rows.
    """
    own = pages.select(pages["page_id"], pages["url"], pages["html"])
    edges = page_edges(own)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("url", "target"))
    links = write_once(
        edges.select(address(F.col("url")).alias("left"), address(F.col("target")).alias("right")).where(
            "left IS NOT NULL AND right IS NOT NULL AND left <> right"
        ),
        "aliases",
    )
    judged = own.select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        address(F.col("url")).alias("node"),
    ).withColumn("_match", matched_rule(F.col("host"), F.col("path"), rules))
    columns = ["page_id", "host", "path", F.col("_match.rule").alias("rule")]
    if links.isEmpty():
        return judged.select(*columns, F.coalesce(F.col("_match.verdict"), F.lit(default)).alias("verdict"))
    groups = components(links, "left", "right")
    # Link targets that are not pages themselves still carry their rule into the group.
    rest = F.substr("node", F.char_length(F.regexp_extract("node", "^[^/?]*", 0)) + 1)
    blocked = (
        groups.withColumn(
            "_match",
            matched_rule(F.regexp_extract("node", "^[^/?]*", 0), F.substring_index(rest, "?", 1), rules),
        )
        .where("_match.verdict = 'block'")
        .select("component")
        .distinct()
    )
    aliases = groups.join(blocked, "component").select(F.col("node").alias("_node"), F.lit("block").alias("_alias"))
    return judged.join(aliases, F.col("node") == F.col("_node"), "left").select(
        *columns, F.coalesce(F.col("_match.verdict"), F.col("_alias"), F.lit(default)).alias("verdict")
    )


URL_SQL = r"""
WITH RECURSIVE p AS (
  SELECT row_number() OVER () AS number, page_id, url, html,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), m AS (
  SELECT *, {node} AS node, {rule} AS rule FROM (SELECT *, url AS link FROM h)
), tags AS (
  SELECT number, url, host, path, replace(unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(page, '(?is)<link\b[^>]*>'),
        lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?canonical\b')),
      lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(page, '(?is)<meta\b[^>]*>'),
        lambda t: regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')),
      lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)))), '&amp;', '&') AS href
  FROM (SELECT *, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS page FROM m WHERE node IS NOT NULL)
), parts AS (
  SELECT *, split_part(url, '://', 1) || ':' AS scheme, CASE WHEN path = '' THEN '/' ELSE path END AS own,
    regexp_extract(href, '[?#].*$') AS tail, regexp_extract(href, '^[^?#]*') AS named
  FROM tags WHERE href <> ''
), named AS (
  SELECT *, CASE WHEN starts_with(named, '/') THEN named ELSE regexp_extract(own, '^.*/') || named END AS dotted FROM parts
), plain AS (
  SELECT *, CASE WHEN contains(dotted, '/.') THEN '/' || array_to_string(list_concat(
      list_reduce(list_transform(string_split(substr(dotted, 2), '/'), lambda x: [x]),
        lambda done, x: CASE WHEN x[1] = '.' THEN done WHEN x[1] = '..' THEN done[1:greatest(len(done) - 1, 0)]
                             ELSE list_concat(done, x) END, CAST([] AS VARCHAR[])),
      CASE WHEN regexp_matches(dotted, '/[.][.]?$') THEN [''] ELSE CAST([] AS VARCHAR[]) END), '/') ELSE dotted END AS clean
  FROM named
), targets AS (
  SELECT number, CASE
      WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
      WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
      WHEN starts_with(href, '//') THEN scheme || href
      WHEN starts_with(href, '?') THEN scheme || '//' || host || own || href
      WHEN starts_with(href, '#') THEN split_part(url, '#', 1) || href
      ELSE scheme || '//' || host || clean || tail END AS link
  FROM plain
), e AS (
  SELECT DISTINCT m.node AS a, t.node AS b FROM (
    SELECT number, {node} AS node FROM (
      SELECT number, link, substr(link, strpos(link, '://') + 3) AS rest FROM targets WHERE strpos(link, '://') > 0)) t
  JOIN m USING (number) WHERE t.node <> m.node
), nodes AS (
  SELECT node, {rule} AS rule FROM (
    SELECT node, regexp_extract(node, '^[^/?]*') AS host, regexp_extract(node, '^[^/?]*([^?]*)', 1) AS path
    FROM (SELECT a AS node FROM e UNION SELECT b FROM e))
), reach AS (
  SELECT node AS seen FROM nodes WHERE rule IN ('example.com/en/', 'net/es/', 'net/fr/')
  UNION
  SELECT CASE WHEN seen = a THEN b ELSE a END FROM reach JOIN e ON seen = a OR seen = b)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN seen IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM m LEFT JOIN reach ON m.node = reach.seen
""".replace("{node}", """CASE WHEN rest <> '' THEN
      regexp_replace(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        CASE lower(split_part(link, '://', 1)) WHEN 'http' THEN ':80$' WHEN 'https' THEN ':443$' ELSE '$' END, '')
      || CASE WHEN starts_with(regexp_extract(rest, '^[^/?#]*([^#]*)', 1), '/') THEN '' ELSE '/' END
      || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) END""").replace("{rule}", """CASE
      WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END""")
