"""URL filters: rules by host and path, and block decisions that travel along redirects and canonical links.

A rule names a host and a path (`net/`, `example.org/es/`); it fits its host and all subdomains if the path
starts with the rule's, and the longest fitting rule decides (of equally long ones the greater name). Pages
without a rule of their own are judged by their aliases: redirects and canonical links tie URLs into
components, and a page is blocked if its component holds a blocked URL and no explicitly allowed one. An
explicit allow thus outranks the blocks of its aliases, and a page's own rule outranks everything. What is
tied to nothing decided is allowed.

Two URLs are one node if host, path and query agree; scheme, fragment, the scheme's default port and dot segments
of the path do not count. Link targets are read with their character references (those that end in a semicolon)
decoded. A null URL, or one
without `://`, has empty host and path, no rule and no aliases, and is allowed. Each row is judged by itself,
so repeated rows get equal verdicts; columns named like a result are replaced by it. Links are read from whole
pages, however long; a null page has none. An empty table gives no rows. Rules are a written list; each adds one
comparison to the projection.
"""

from __future__ import annotations

from html.entities import html5
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.llm.common import components, query, staged, table


class UrlRule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("allow", "org"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(_after(url), "/", 1))
    for end in "?#":
        rest = F.substring_index(rest, end, 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #; empty without ://."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(_after(url), r"(?s)^[^/?#]*([^?#]*)", 1)), F.lit(""))


def _after(url: Column) -> Column:
    return F.substr(url, F.instr(url, "://") + 3)


def _without_dots(path: Column) -> Column:
    """A path (from its /) without . and .. segments; .. at the root stays there."""
    parts = F.split(F.substr(path, F.lit(2)), "/")
    left = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    end = F.when(path.rlike(r"/\.{1,2}$") & (F.size(left) > 0), "/").otherwise("")
    return F.when(path.rlike(r"(?s)^/(.*/)?\.{1,2}(/|$)"), F.concat(F.lit("/"), F.array_join(left, "/"), end)).otherwise(path)


def _decoded(text: Column) -> Column:
    """The text with named and numeric character references decoded; unknown names stay as written, numbers of no character are U+FFFD."""
    names = F.str_to_map(
        F.lit("\x1e".join(f"{k[:-1]}\x1f{v}" for k, v in html5.items() if k[-1] == ";")), F.lit("\x1e"), F.lit("\x1f")
    )

    def read(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});", 1)
        digits = F.regexp_extract(name, "^#[xX]?([0-9A-Fa-f]+)$", 1)
        code = F.when(
            digits != "", F.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        )
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        number = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).when(code.isNotNull(), 0xFFFD)), 8, "0")), "UTF-32")
        char = F.when(F.startswith(name, F.lit("#")), number).when(name != "", F.element_at(names, name))
        rest = F.substr(piece, F.length(name) + 2)
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    after = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), read)
    return F.when(F.contains(text, F.lit("&")), F.concat(pieces[0], F.array_join(after, ""))).otherwise(text)


def _value(tag: Column, name: str) -> Column:
    """What an attribute of a tag is set to, decoded: up to the quote it begins with, else up to a space."""
    found = rf"""(?i)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
    return _decoded(F.concat(*(F.regexp_extract(tag, found, k) for k in (1, 2, 3))))


def _refresh_target(tag: Column) -> Column:
    """The URL in the content of a refresh: up to the quote it begins with, else up to a space."""
    found = r"""(?i)\burl\s*=\s*(?:"([^"]*)|'([^']*)|([^"'\s]+))"""
    content = _value(tag, "content")
    inside = F.concat(*(F.regexp_extract(content, found, k) for k in (1, 2, 3)))
    # a content without quotes ends at its first space
    loose = _decoded(F.regexp_extract(tag, r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", 1))
    return F.when(inside != "", inside).otherwise(loose)


def node_of(url: Column) -> Column:
    """The URL as a node: host, path (at least /) and query. Null without a host."""
    host, path = host_of(url), _without_dots(path_of(url))
    scheme = F.lower(F.substring_index(url, "://", 1))
    usual = F.when(scheme == "http", "80").when(scheme == "https", "443").when(scheme == "ftp", "21").otherwise("")
    port = F.regexp_extract(host, ":([0-9]*)$", 1)
    host = F.when(host.rlike(":[0-9]*$") & ((port == "") | (port == usual)), F.regexp_replace(host, ":[0-9]*$", "")).otherwise(host)
    asked = F.regexp_extract(_after(url), r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), asked))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (length, rule, verdict) of the longest rule that fits; null if none does."""
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    none = F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return F.array_max(F.array_compact(F.array(none, *fits)))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links between nodes, columns a and b: canonical link elements and refresh redirects of each page."""
    body = F.coalesce(F.col(html), F.lit(""))
    tags = F.concat(
        F.transform(
            F.regexp_extract_all(body, F.lit(r"(<[lL][iI][nN][kK][ \t\r\n][^>]*>)")),
            lambda t: F.when(
                t.rlike(r"""(?i)\brel\s*=\s*["']?canonical\b"""),
                _value(t, "href"),
            ),
        ),
        F.transform(
            F.regexp_extract_all(body, F.lit(r"(<[mM][eE][tT][aA][ \t\r\n][^>]*>)")),
            lambda t: F.when(
                t.rlike(r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""),
                _refresh_target(t),
            ),
        ),
    )
    found = pages.where(node_of(F.col(url)).isNotNull()).select(
        F.col(url).alias("url"),
        F.explode(F.filter(F.transform(F.array_compact(tags), lambda t: F.trim(t)), lambda t: t != "")).alias("to"),
    )
    host, path = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1), path_of(F.col("url"))
    folder = F.regexp_extract(path, "(?s)^(.*/)", 1)
    target = (
        F.when(F.instr("to", "://") > 0, F.col("to"))
        .when(F.startswith("to", F.lit("//")), F.concat(F.substring_index("url", "//", 1), F.col("to")))
        .when(F.startswith("to", F.lit("/")), F.concat(host, F.col("to")))
        .when(F.startswith("to", F.lit("?")), F.concat(host, path, F.col("to")))
        .when(F.startswith("to", F.lit("#")), F.col("url"))
        .otherwise(F.concat(host, F.when(folder == "", "/").otherwise(folder), F.col("to")))
    )
    return found.select(node_of(F.col("url")).alias("a"), node_of(target).alias("b")).where("a <> b")


def decide(pages: DataFrame, links: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule and verdict; `links` (a, b) tie nodes into components of aliases."""
    own = ("host", "path", "rule", "verdict")
    columns = [c for c in pages.columns if c.lower() not in own]
    read = pages.select(
        F.struct(*columns).alias("__row"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        node_of(F.col(url)).alias("__node"),
    ).withColumn("__own", fitting_rule(F.col("host"), F.col("path"), rules))
    aliases = staged(components(links), "aliases")
    # A node's rule is that of its host and path, whether or not a page with that URL is at hand.
    host = F.substring_index("node", "/", 1)
    path = F.regexp_extract("node", r"(?s)^[^/]*([^?]*)", 1)
    ruled = aliases.select("root", fitting_rule(host, path, rules)["verdict"].alias("verdict"))
    groups = ruled.groupBy("root").agg(
        F.max(F.coalesce(F.col("verdict") == "allow", F.lit(False))).alias("allowed"),
        F.max(F.coalesce(F.col("verdict") == "block", F.lit(False))).alias("blocked"),
    )
    shut = groups.where("blocked and not allowed").select("root")
    blocked = aliases.join(shut, "root").select(F.col("node").alias("__node"), F.lit(True).alias("__blocked"))
    # Pages that are judged by their own rule, or have no URL, need not look for aliases.
    asking = F.when(F.col("__own").isNull(), F.col("__node"))
    out = read.withColumn("__asks", asking).join(blocked.withColumnRenamed("__node", "__asks"), "__asks", "left")
    inherited = F.when(F.col("__blocked"), "block").otherwise("allow")
    return out.select(
        "__row.*", "host", "path",
        F.col("__own.rule").alias("rule"),
        F.coalesce(F.col("__own.verdict"), inherited).alias("verdict"),
    )


OP1_SQL = r"""
WITH RECURSIVE read AS (
  SELECT page_id, url, html,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT page_id, url, html, coalesce(regexp_extract(translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?s).*'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1), '') AS asked
  FROM read
), nodes AS (
  SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || asked END AS node FROM urls
), tags AS (
  SELECT node, unnest(list_transform(list_filter(
           regexp_extract_all(html, '<[lL][iI][nN][kK][ \t\r\n][^>]*>'),
           lambda t: regexp_matches(t, '(?i)\brel\s*=\s*["'']?canonical\b')),
           lambda t: regexp_extract(t, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1))
         || list_transform(list_filter(
           regexp_extract_all(html, '<[mM][eE][tT][aA][ \t\r\n][^>]*>'),
           lambda t: regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')),
           lambda t: regexp_extract(t, '(?i)\burl\s*=\s*["'']?([^"''\s>;]+)', 1))) AS target
  FROM nodes WHERE node IS NOT NULL
), links AS (
  SELECT DISTINCT node AS a, regexp_extract(split_part(target, '://', 2), '^[^#]*') AS b
  FROM tags WHERE contains(target, '://')
), both_ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS node, a AS other FROM both_ways
  UNION
  SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.other
), rules(rule, verdict, host, path) AS (
  VALUES ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
         ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'),
         ('com/de/', 'block', 'com', '/de/')
), ruled AS (
  SELECT p.page_id, max_by(r.rule, (length(r.rule), r.rule)) AS rule, max_by(r.verdict, (length(r.rule), r.rule)) AS verdict
  FROM nodes p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id
), heard AS (
  SELECT r.node, bool_or(u.verdict = 'allow') AS allowed, bool_or(u.verdict = 'block') AS blocked
  FROM reach r JOIN nodes p ON p.node = r.other JOIN ruled u ON u.page_id = p.page_id GROUP BY r.node
)
SELECT p.page_id, p.host, p.path, u.rule,
       coalesce(u.verdict, CASE WHEN h.blocked AND NOT h.allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM nodes p LEFT JOIN ruled u ON u.page_id = p.page_id LEFT JOIN heard h ON h.node = p.node
"""


@query("op1_url_filters", OP1_SQL)
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = decide(pages.select("page_id", "url"), page_links(pages.select("url", "html")))
    return judged.select("page_id", "host", "path", "rule", "verdict")
