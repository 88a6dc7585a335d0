"""URL filters: hand-written rules first, then empirical-Bayes host reputation, in DataFrame operations alone.

Rules decide the pages that they fit; all others are judged by their host. A host's evidence is the outcome of each of
its pages, whether a rule fits it or not, so that rules don't choose what reputation sees: a page is bad (1) when its
html shows fewer than `least_words` words, else good (0). Other labels come in as a column (outcome_col).
Outcomes are counted by host. Each level's rate of bad pages is a beta-binomial whose prior has its mean from the level
above: host from registered domain, registered domain from public suffix, suffix from all pages. A level's prior
strength is its method-of-moments estimate over all groups of the level (one row of sums, the only thing the driver
reads). A page without a rule is blocked when its host's posterior mean less z posterior deviations reaches the
threshold.

Every table comes back to the one below by key and salt, a row for each salt that the key has there: a host with a
third of all pages, a domain with a third of all hosts, or a suffix with half of all domains is spread over 64 keys.

A public suffix is the last label, or the last two where rule SECOND_LEVEL or the parameter `suffixes` says so (a full
list can be given there). An IP address is its own registered domain, under the suffix "ip".

Defined results: a null url, or one without "://", has an empty host and path, no rule, and the verdict of the
empty host. A rule fits its host and whole-label subdomains when the path starts with the rule's; of several the
longest (ties: the first given). Ports and trailing dots count for rules but not for reputation. Null html has no
outcome, empty html is bad, very long html is read whole in time linear in its length. Without any known outcome all
is allowed; a host at the threshold exactly is blocked. Repeated rows and identifiers count as often as they occur,
null identifiers are rows like others. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import WORD, ascii_lower, cut, leaf_mask, leaf_of, named, with_leaves

#: Rules of the contract, (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Labels below a country's two letters that make a public suffix together with it.
SECOND_LEVEL = r"^(ac|co|com|edu|go|gov|mil|ne|net|nom|or|org|sch)\.[a-z]{2}$"
#: Tags, and what stands behind those that open a script or style. Neither part crosses a "<", so time is linear.
MARKUP = r"(?i)<(?:script|style)[^<>]*>[^<]*|<[^<>]*>"
LEAST_WORDS = 100


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls. rules: a few hundred at most, they become one expression."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def shown_words(html: Column) -> Column:
    """Words of a page outside its markup."""
    return F.regexp_count(F.regexp_replace(html, MARKUP, " "), F.lit(WORD))


def suffix_and_domain(host: Column, suffixes: tuple[str, ...] = ()) -> tuple[Column, Column]:
    plain = F.regexp_replace(host, r"\.*(:[0-9]*)?$", "")
    two = F.substring_index(plain, ".", -2)
    long = two.rlike(SECOND_LEVEL) | two.isin(*suffixes) if suffixes else two.rlike(SECOND_LEVEL)
    address = plain.rlike(r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$")
    suffix = F.when(address, "ip").when(long, two).otherwise(F.substring_index(plain, ".", -1))
    return suffix, F.when(address, plain).when(long, F.substring_index(plain, ".", -3)).otherwise(two)


def _strength(groups: DataFrame, prior: str) -> float:
    """Of the prior of a level, from (pages n, blocked k, prior mean); by moments, and 1 where nothing can be told."""
    n, k, p = F.col("n").cast("double"), F.col("k").cast("double"), F.col(prior)
    row: Row = groups.filter("n > 0").agg(F.sum((k - n * p) ** 2).alias("s"), F.sum(n * p * (1 - p)).alias("a"), F.sum(n * (n - 1) * p * (1 - p)).alias("b")).first()
    if not row.b:
        return 1.0
    return 1 / round(min(0.999, max(0.001, (row.s - row.a) / row.b)), 6) - 1


def host_reputation(outcomes: DataFrame, z: float = 1.645, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """host, n, k, leaves, mean, bound: from host, bad (1, 0 or null for pages without a known outcome) and leaf."""
    suffix, domain = suffix_and_domain(F.col("host"), suffixes)
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"), leaf_mask(F.col("leaf")).alias("leaves"))
    hosts = cut(hosts.withColumns({"suffix": suffix, "domain": domain, "host_leaf": leaf_of(F.col("host"))}))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), leaf_mask(F.col("host_leaf")).alias("host_leaves"))
    domains = cut(domains.withColumn("domain_leaf", leaf_of(F.col("domain"))))
    suffixes_ = cut(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), leaf_mask(F.col("domain_leaf")).alias("domain_leaves")))
    total = suffixes_.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    by_suffix = suffixes_.withColumn("p0", F.lit(((total.k or 0) + 0.5) / ((total.n or 0) + 1)))

    def shrunk(groups: DataFrame, prior: str, name: str) -> DataFrame:
        m = _strength(groups, prior)
        return groups.withColumn(name, (F.col("k") + m * F.col(prior)) / (F.col("n") + m))

    by_suffix = with_leaves(shrunk(by_suffix, "p0", "p1").select("suffix", "domain_leaves", "p1"), "domain_leaves", "domain_leaf")
    by_domain = shrunk(domains.join(by_suffix, ["suffix", "domain_leaf"]), "p1", "p2")
    by_domain = with_leaves(by_domain.select("suffix", "domain", "host_leaves", "p2"), "host_leaves", "host_leaf")
    of_host = hosts.join(by_domain, ["suffix", "domain", "host_leaf"])
    m = _strength(of_host, "p2")
    a, b = F.col("k") + m * F.col("p2"), F.col("n") - F.col("k") + m * (1 - F.col("p2"))
    bound = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return of_host.select("host", "n", "k", "leaves", (a / (a + b)).alias("mean"), bound.alias("bound"))


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", outcome_col: str | None = None, rules: tuple[tuple[str, str, str], ...] = RULES, z: float = 1.645, threshold: float = 0.5, least_words: int = LEAST_WORDS, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """page_id, host, path, rule, verdict, bad, mean, bound: a row for each page. outcome_col: 1, 0 or null, instead of html_col."""
    host, path = parts(named(url_col))
    bad = named(outcome_col) if outcome_col else shown_words(named(html_col)) < least_words
    seen = pages.select(named(id_col).alias("page_id"), leaf_of(named(id_col), named(url_col)).alias("leaf"), host.alias("host"), path.alias("path"), bad.cast("int").alias("bad"))
    rule, says = ruled(F.col("host"), F.col("path"), rules)
    # Read twice below, with html's words counted once.
    seen = cut(seen.withColumns({"rule": rule, "says": says}))
    hosts = with_leaves(host_reputation(seen, z, suffixes).drop("n", "k"), "leaves", "leaf")
    method = F.when(F.col("bound") >= threshold, "block").otherwise("allow")
    return seen.join(hosts, ["host", "leaf"]).select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), "bad", F.round("mean", 6).alias("mean"), F.round("bound", 6).alias("bound"))


ORACLE = r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest,
         CASE WHEN html IS NOT NULL THEN (len(regexp_extract_all(regexp_replace(html, '(?i)<(?:script|style)[^<>]*>[^<]*|<[^<>]*>', ' ', 'g'), '[^\x20\x09-\x0D]+')) < 100)::INT END AS bad FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, bad FROM u
), r AS (
  SELECT *, CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                 WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM p
), o AS (
  SELECT *, regexp_replace(host, '\.*(:[0-9]*)?$', '') AS plain FROM r
), h AS (
  SELECT host, any_value(plain) AS plain, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k, string_split(any_value(plain), '.') AS l FROM o GROUP BY host
), hl AS (
  SELECT host, n, k, l, regexp_full_match(plain, '[0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\]') AS address, plain,
         regexp_full_match(array_to_string(l[greatest(1, len(l) - 1):], '.'), '(ac|co|com|edu|go|gov|mil|ne|net|nom|or|org|sch)\.[a-z]{2}') AS two FROM h
), hs AS (
  SELECT host, n, k, CASE WHEN address THEN 'ip' ELSE array_to_string(l[greatest(1, len(l) - two::INT):], '.') END AS suffix,
         CASE WHEN address THEN plain ELSE array_to_string(l[greatest(1, len(l) - 1 - two::INT):], '.') END AS domain FROM hl
), d AS (
  SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM hs GROUP BY ALL
), s AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k, (sum(sum(k)) OVER () + 0.5) / (sum(sum(n)) OVER () + 1) AS p0 FROM d GROUP BY suffix
), ms AS (
  SELECT CASE WHEN coalesce(sum(n * (n - 1) * p0 * (1 - p0)), 0) = 0 THEN 1 ELSE 1 / round(least(0.999, greatest(0.001, (sum((k - n * p0) ** 2) - sum(n * p0 * (1 - p0))) / sum(n * (n - 1) * p0 * (1 - p0)))), 6) - 1 END AS m FROM s WHERE n > 0
), s1 AS (
  SELECT suffix, (k + m * p0) / (n + m) AS p1 FROM s, ms
), d1 AS (
  SELECT d.*, p1 FROM d JOIN s1 USING (suffix)
), md AS (
  SELECT CASE WHEN coalesce(sum(n * (n - 1) * p1 * (1 - p1)), 0) = 0 THEN 1 ELSE 1 / round(least(0.999, greatest(0.001, (sum((k - n * p1) ** 2) - sum(n * p1 * (1 - p1))) / sum(n * (n - 1) * p1 * (1 - p1)))), 6) - 1 END AS m FROM d1 WHERE n > 0
), d2 AS (
  SELECT suffix, domain, (k + m * p1) / (n + m) AS p2 FROM d1, md
), h2 AS (
  SELECT hs.*, p2 FROM hs JOIN d2 USING (suffix, domain)
), mh AS (
  SELECT CASE WHEN coalesce(sum(n * (n - 1) * p2 * (1 - p2)), 0) = 0 THEN 1 ELSE 1 / round(least(0.999, greatest(0.001, (sum((k - n * p2) ** 2) - sum(n * p2 * (1 - p2))) / sum(n * (n - 1) * p2 * (1 - p2)))), 6) - 1 END AS m FROM h2 WHERE n > 0
), h3 AS (
  SELECT host, k + m * p2 AS a, n - k + m * (1 - p2) AS b FROM h2, mh
), h4 AS (
  SELECT host, a / (a + b) AS mean, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM h3
)
SELECT page_id, o.host, path, rule, CASE WHEN rule IN ('example.com/de/', 'net/') OR rule IS NULL AND bound >= 0.5 THEN 'block' ELSE 'allow' END AS verdict, bad, round(mean, 6) AS mean, round(bound, 6) AS bound
FROM o JOIN h4 ON o.host = h4.host
"""
