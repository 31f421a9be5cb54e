"""URL rules with redirect equivalence, in DataFrame operations only.

A rule names a host and the start of a path and fits the host with all its subdomains; of
the rules that fit a URL the longest decides. Pages that redirect or point by a canonical
link to each other are aliases: connected components over these links carry a block to
pages that no rule fits. An explicit allow among the aliases goes before the block, and a
rule that fits the page itself before either.
"""

from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaris.llm.components import components
from scholaris.sources.workspace import stored

# Only A to Z are lower-cased, whatever the locale.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK, _META = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
_VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
_TARGET = r"(?is)^[^;,]*[;,]\s*url\s*=\s*[\"']?\s*([^\"'>\s]+)"
# Paths of more parts are compared as they are written, with their dots.
MOST_PARTS = 1000


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def rules_frame(spark: SparkSession, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Rules as a table (verdict, host, path), made of literals."""
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in asdict(rule).items()]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(df: DataFrame, url_column: str = "url") -> DataFrame:
    """`df` with `host` (A to Z lower-cased) and `path`; both empty without a `://`, or for null."""
    url = F.col(url_column)
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def ruled(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct places (host, path) that a rule fits.

    `rules` has verdict, host and path and may be large. A place asks for the parent domains,
    itself included, of every number of labels that rules have, with the starts of its path of
    every length that they have, so that finding rules is an equality join and no place meets rules that do not fit it. The
    longest rule decides; of equally long ones that with the longer host, then the allow.
    """
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]
    dots = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit("")))
    # As many labels as rules' hosts have, so that a host of very many makes no more strings than others.
    sizes = [r[0] for r in rules.select((dots + 1).alias("n")).distinct().orderBy("n").collect()]
    parents = F.array(*[F.when(dots + 1 >= n, F.substring_index("host", ".", -n)) for n in sizes] or [F.lit(None).cast("string")])
    starts = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")])
    asked = places.select("host", "path", F.explode(F.array_compact(parents)).alias("rule_host"))
    asked = asked.select("host", "path", "rule_host", F.explode(F.array_distinct(F.array_compact(starts))).alias("rule_path"))
    known = rules.select("verdict", F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).distinct()
    fits = asked.join(known, ["rule_host", "rule_path"])
    rank = F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("verdict") == "allow").alias("allow"),
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    verdict = F.when(F.col("best.allow"), "allow").otherwise("block")
    return best.select("host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))


def node(url: Column) -> Column:
    """What aliases are compared by: the URL without fragment, its scheme and host in lower case."""
    plain = F.regexp_extract(url, r"(?s)^[^#]*", 0)
    front = F.regexp_extract(plain, r"^[^:/?#]+://[^/?#]*", 0)
    return F.concat(F.translate(front, _UPPER, _LOWER), F.substring(plain, F.length(front) + 1, F.length(plain)))


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, in quotes or not; empty if it has none."""
    pattern = rf"(?is)[\s\"'/]{name}{_VALUE}"
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def without_dots(path: Column) -> Column:
    """A path that starts with / without its . and .. parts; a .. too many stays at the root."""
    parts = F.split(F.substring(path, 2, F.length(path)), "/")
    joined = F.aggregate(
        parts,
        F.lit(""),
        lambda whole, part: F.when(part == "..", F.regexp_replace(whole, r"/[^/]*$", ""))
        .when(part == ".", whole)
        .otherwise(F.concat(whole, F.lit("/"), part)),
    )
    open_end = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(joined, F.lit("/"))).otherwise(joined)
    dotted = path.rlike(r"/\.\.?(/|$)") & (F.size(parts) <= MOST_PARTS)
    return F.when(dotted, open_end).otherwise(path)


def resolved(name: Column, url: Column) -> Column:
    """The URL that a name on a page means: a whole URL, or one relative to scheme, site, folder or page."""
    scheme = F.regexp_extract(url, r"^[^:/?#]+:", 0)
    site = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*", 0)
    page = F.regexp_extract(url, r"^[^?#]*", 0)
    folder = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*(?:/(?:[^?#]*/)?)?", 0)
    folder = F.when(folder == site, F.concat(site, F.lit("/"))).otherwise(folder)
    whole = (
        F.when(name.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), name)
        .when(name.startswith("//"), F.concat(scheme, name))
        .when(name.startswith("/"), F.concat(site, name))
        .when(name.startswith("?"), F.concat(page, name))
        .otherwise(F.concat(folder, name))
    )
    front = F.regexp_extract(whole, r"^[^:/?#]+://[^/?#]*", 0)
    path = F.regexp_extract(whole, r"^[^:/?#]+://[^/?#]*(/[^?#]*)", 1)
    rest = F.substring(whole, F.length(front) + F.length(path) + 1, F.length(whole))
    return F.when(path == "", whole).otherwise(F.concat(front, without_dots(path), rest))


def declared_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(a, b): the nodes of a page and of what its canonical links and meta refreshes name.

    All of them count, and `canonical` may be any word of a link's `rel`. Names may be whole
    URLs, start with `//`, `/` or `?`, or be relative to the page's folder; . and .. in their
    paths are followed. Names of a fragment alone, pages without a link, and null columns
    give no rows.
    """
    html, url = F.col(html_column), F.col(url_column)
    canonical = F.filter(
        F.regexp_extract_all(html, F.lit(_LINK), F.lit(0)), lambda tag: attribute(tag, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    )
    refresh = F.filter(
        F.regexp_extract_all(html, F.lit(_META), F.lit(0)), lambda tag: attribute(tag, "http-equiv").rlike(r"(?i)^\s*refresh\s*$")
    )
    hrefs = F.transform(canonical, lambda tag: F.trim(attribute(tag, "href")))
    targets = F.transform(refresh, lambda tag: F.regexp_extract(attribute(tag, "content"), _TARGET, 1))
    # Few pages have either word: only those are searched by pattern.
    likely = pages.where(F.lower(html).contains("canonical") | F.lower(html).contains("http-equiv"))
    rows = likely.select(url.alias("url"), F.explode(F.array_distinct(F.concat(hrefs, targets))).alias("name"))
    rows = rows.where("name != '' and not startswith(name, '#') and instr(url, '://') > 0")
    whole = resolved(F.regexp_replace("name", "&amp;", "&"), F.col("url"))
    return rows.select(node(F.col("url")).alias("a"), node(whole).alias("b")).distinct()


def judged(
    pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(id, host, path, rule, verdict) of every page.

    `redirects` may add links known from a crawl, as two URL columns. The rule is written as
    its host and path and is null if none fits; the verdict is the rule's, else allow if an
    alias is allowed by a rule, else block if one is blocked, else allow. Linked URLs count
    as aliases even if no page has them. Null, empty and other URLs without `://` have an
    empty host and path and no links. Repeated rows and null ids stay; an empty table gives
    no rows, and no rules allow everything.
    """
    rows = host_and_path(pages.select(F.col(id_column).alias(id_column), F.col(url_column).alias("url")))
    links = declared_links(pages, url_column, html_column)
    if redirects is not None:
        links = links.union(redirects.select(*[node(F.col(c)) for c in redirects.columns[:2]]))
    groups = stored(components(links), "aliases")
    placed = host_and_path(groups, "node")
    places = rows.select("host", "path").union(placed.select("host", "path")).distinct()
    found = stored(ruled(places, rules), "ruled")
    decided = placed.join(found, ["host", "path"], "left").groupBy("component").agg(
        F.coalesce(F.bool_or(F.col("verdict") == "allow"), F.lit(False)).alias("allowed"),
        F.coalesce(F.bool_or(F.col("verdict") == "block"), F.lit(False)).alias("blocked"),
    )
    alias = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")
    aliases = groups.join(decided, "component").select("node", alias.alias("alias"))
    own = rows.join(found, ["host", "path"], "left").withColumn("node", node(F.col("url")))
    verdict = F.coalesce("verdict", "alias", F.lit("allow"))
    return own.join(aliases, "node", "left").select(id_column, "host", "path", "rule", verdict.alias("verdict"))
