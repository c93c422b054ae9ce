"""URL filtering with redirect equivalence, in DataFrame functions alone.

Explicit rules name a host (and its subdomains) and a path prefix; the longest
that fits decides. Pages without a rule take the decision of their aliases:
URLs of one normal form, joined further by canonical links and redirects found
in the pages, make one component; if any member is explicitly allowed the
component is allowed, else if any is blocked it is blocked, else it is allowed.
All such links of a page count; relative ones start from its scheme, host and
directory. A link's target is a member by its URL, whether or not it is a page here.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits
no rule, has no aliases and is allowed; null html has no links; repeated rows
are judged alike; ties of equally long rules go to allow; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import own_columns, stored
from tabloom.llm.components import connected

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))

# parameters that name where a visitor came from, not what the page is
TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid)(?:=[^&]*)?"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh)[^>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.regexp_replace(_after(url), r"^[^/?#]*", ""), r"^[^?#]*", 0), F.lit(""))


def normal_form(url: Column) -> Column:
    """Host and path without scheme, mobile or www prefix, fragment, tracking parameters, page suffix; null if no host."""
    host = F.regexp_replace(host_of(url), r"^(?:www|m|amp)\.(?=[^.]+\.)", "")
    path = F.regexp_replace(path_of(url), r"(?:/index)?(?:\.html?)?/*$", "")
    asked = F.regexp_extract(_after(url), r"^[^?#]*\?([^#]*)", 1)
    asked = F.regexp_replace(F.regexp_replace(F.concat(F.lit("&"), asked), f"&(?:{TRACKING})(?=&|$)", ""), r"^&+", "")
    return F.when(host_of(url) != "", F.concat(host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise("")))


def without_dots(path: Column) -> Column:
    """An absolute path without its '.' and '..' segments."""
    parts = F.slice(F.split(path, "/"), 2, 1 << 30)
    last = F.element_at(parts, -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done).when(
        x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(x))))
    kept = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def resolved(links: DataFrame) -> DataFrame:
    """``links`` (url, to) with ``target``: the URL that ``to`` means on the page ``url``; null if it has no host.

    Steps are columns of their own, since an expression repeated in the next one would multiply.
    """
    df = links.withColumns({
        "to": F.regexp_replace("to", r"(?i)&(?:amp|#38|#x26);", "&"), "scheme": F.regexp_extract("url", r"^\s*([^:/?#]*)://", 1),
        "host": host_of(F.col("url")), "path": path_of(F.col("url")),
        "asked": F.regexp_extract(_after(F.col("url")), r"^[^?#]*(\?[^#]*)", 1)})
    site = F.concat("scheme", F.lit("://"), "host")
    folder = F.concat(F.regexp_extract("path", r"^(?:.*/)?", 0), F.when(F.col("path").contains("/"), "").otherwise("/"))
    to = F.col("to")
    df = df.withColumn("near", F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), to).when(
        to.rlike(r"^//"), F.concat("scheme", F.lit(":"), to)).when(F.col("host") == "", F.lit(None)).when(
        to.rlike("^/"), F.concat(site, to)).when(to.rlike(r"^\?"), F.concat(site, "path", to)).when(
        to.rlike("^#"), F.concat(site, "path", "asked", to)).otherwise(F.concat(site, folder, to)))
    df = df.withColumns({"head": F.regexp_extract("near", r"^[^:/?#]+://[^/?#]*", 0), "path": path_of(F.col("near")),
                         "tail": F.regexp_extract("near", r"[?#](?s:.*)$", 0)})
    return df.withColumn("target", F.when(F.col("head") != "", F.concat("head", without_dots(F.col("path")), "tail")))


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b, target): normal forms of a page and of a URL it redirects to or names as canonical, and that URL; stored."""
    found = pages.filter(F.col("html").rlike(r"(?i)canonical|refresh")).select("url", F.explode(F.array_distinct(F.concat(
        *[F.regexp_extract_all("html", F.lit(link), F.lit(1)) for link in (CANONICAL, REFRESH)]))).alias("to"))
    links = resolved(found.filter("to != ''")).select(
        normal_form(F.col("url")).alias("a"), normal_form(F.col("target")).alias("b"), "target")
    # stored first: a filter pushed down would spell all steps out again in one expression
    return stored(links, "links").dropna()


def rule_table(spark, rules) -> DataFrame:
    split = [(r, *r.partition("/")[::2], v) for r, v in rules]
    return spark.createDataFrame([(r, h, "/" + p, v) for r, h, p, v in split],
                                 "rule string, rule_host string, rule_path string, rule_verdict string")


def match_rules(urls: DataFrame, rules: DataFrame, deepest: int) -> DataFrame:
    """``urls`` (url, host, path) with the longest rule that fits: a join on the host and its parent
    domains of ``deepest`` labels at most, which is what the rules' hosts have."""
    parts = F.split("host", r"\.")
    first = F.greatest(F.lit(1), F.size(parts) - (deepest - 1))
    last = F.slice(parts, first, F.lit(deepest))
    domains = F.transform(F.sequence(F.lit(1), F.size(last)), lambda k: F.array_join(F.slice(last, k, F.lit(deepest)), "."))
    tried = urls.filter("host != ''").select("url", "path", F.explode(domains).alias("rule_host"))
    fit = tried.join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    best = F.struct(F.length("rule").alias("size"), (F.col("rule_verdict") == "allow").alias("allow"), "rule", "rule_verdict")
    return fit.groupBy("url").agg(F.max(best).alias("best")).select("url", "best.rule", "best.rule_verdict")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and the alias component that decided where no rule did."""
    rows = own_columns(pages, {"page_id": "page_id", "url": "url", "html": "html"})
    links = page_links(rows)
    urls = rows.select("url").union(links.select("target")).filter("url is not null").distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                       normal_form(F.col("url")).alias("form"))
    deepest = max((r.partition("/")[0].count(".") + 1 for r, _ in rules), default=1)
    ruled = match_rules(urls, rule_table(pages.sparkSession, rules), deepest)
    urls = stored(urls.join(ruled, "url", "left"), "urls")

    roots = connected(links.select("a", "b")).select(F.col("node").alias("form"), "root")
    forms = urls.filter("form is not null").groupBy("form").agg(
        F.bool_or(F.col("rule_verdict") == "allow").alias("allow"), F.bool_or(F.col("rule_verdict") == "block").alias("block"))
    forms = forms.join(roots, "form", "left").withColumn("component", F.coalesce("root", "form"))
    decided = forms.groupBy("component").agg(F.bool_or("allow").alias("allow"), F.bool_or("block").alias("block"))
    said = forms.select("form", "component").join(decided, "component").select(
        "form", "component", F.when(F.col("block") & ~F.coalesce("allow", F.lit(False)), "block").otherwise("allow").alias("said"))
    urls = urls.join(said, "form", "left").select(
        "url", "rule", F.coalesce("rule_verdict", "said", F.lit("allow")).alias("verdict"), "component")
    judged = rows.select("page_id", "url").join(urls, "url", "left")
    return judged.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
                         F.coalesce("verdict", F.lit("allow")).alias("verdict"), "component")
