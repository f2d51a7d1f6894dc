"""URL filters from address rules and from the reputation of hosts.

An address that a rule fits takes that rule's verdict; the longest rule wins. All others are judged
by their host. Labelled pages are outcomes, bad or not, and a host's share of bad pages is
estimated by empirical Bayes: the host's counts are shrunk towards its registered domain, the
domain's towards its suffix, the suffix's towards all pages. How strongly a level is shrunk follows
from the data: a beta-binomial prior whose weight comes from the variance between and within the
groups of that level. A host is blocked when the lower bound of its posterior share of bad pages
is over ``BAD_SHARE``, so hosts with few labels, which stay near their prior, are kept.

All steps are grouped sums and joins. Pages are summed per host, or per host and document, before
anything is shuffled. Verdicts reach the pages by host; hosts with over a thousandth of all pages,
of which there are fewer than a thousand, are broadcast, and only the others are joined by a
shuffle. The rules are a short list held in the program.

A null address or one without ``://`` has an empty host and path: no rule fits it, and it is judged
like the host ''. Labels of one document under several rows count as one, bad if any of them is;
a null label says nothing. Repeated pages are judged and counted each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import stored


@dataclass(frozen=True)
class AddressRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    AddressRule("allow", "com", "/"),
    AddressRule("block", "example.com", "/en/"),
    AddressRule("allow", "www.example.com", "/en/"),
    AddressRule("block", "net", "/es/"),
    AddressRule("block", "net", "/fr/"),
)

# Labels that make a suffix together with a country code.
SHARED_SUFFIXES = ("ac", "co", "com", "edu", "gov", "ne", "net", "or", "org")

#: A host is blocked when its bad share is over this, but for a chance of about 5 %.
BAD_SHARE, DEVIATIONS = 0.5, 1.645
#: Least and greatest weight of a prior, in pages.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1000.0
#: A host with more than one in so many pages is hot.
HOT_PART = 1000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def address(url: str = "url") -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path of an address."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def registered(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, both without user and port.

    The suffix is the last label, or the last two where a country code follows one of
    ``SHARED_SUFFIXES``; the domain has one label more. A numeric address is its own domain, under
    the suffix ''.
    """
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*\\z", "")
    shared = "|".join(SHARED_SUFFIXES)
    suffix = F.regexp_extract(name, rf"(?:^|\.)((?:(?:{shared})\.[a-z][a-z])|[^.]*)\z", 1)
    domain = F.regexp_extract(name, rf"([^.]*\.(?:(?:(?:{shared})\.[a-z][a-z])|[^.]*))\z", 1)
    numeric = name.rlike(r"^[0-9]+(\.[0-9]+){3}\z")
    return F.when(numeric | (domain == ""), name).otherwise(domain), F.when(numeric, "").otherwise(suffix)


def matching_rule(host: Column, path: Column, rules: tuple[AddressRule, ...] = RULES) -> Column:
    """Name and verdict of the longest rule that fits; null where none does.

    A rule fits its host and all hosts below it. Of equally long rules the one with the longer
    host goes first, and a block before an allow.
    """
    ranked = sorted(set(rules), key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r.name))
    hits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in ranked
    ]
    return F.coalesce(*hits) if hits else F.lit(None).cast("struct<rule:string,verdict:string>")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Per host: pages, labelled pages and bad ones.

    A page's label is that of the document which its address names by number, as the last part of
    the path. A page is bad when its document is toxic or of low quality.
    """
    host, path = address()
    document = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[A-Za-z]+)?/?\z", 1)
    named = F.when(document != "", document.cast("long"))
    each = pages.select(host.alias("host"), named.alias("document"))
    counted = stored(each.groupBy("host", "document").agg(F.count(F.lit(1)).alias("n")), "url-counts")
    bad = F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0)) + F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0))
    known = (
        labels.where("doc_id IS NOT NULL AND (toxic IS NOT NULL OR quality IS NOT NULL)")
        .groupBy(F.col("doc_id").alias("document"))
        .agg((F.max(bad) > 0).alias("bad"))
    )
    judged = counted.where("document IS NOT NULL").join(known, "document").groupBy("host").agg(
        F.sum("n").alias("labelled"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad")
    )
    totals = counted.groupBy("host").agg(F.sum("n").alias("pages"))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("labelled", "bad")}
    return totals.join(judged, "host", "left").withColumns(zero)


def prior_weight(children: DataFrame, parent: str | None) -> float:
    """The weight of a level's prior in pages, from the spread of its groups around their parents.

    The share of variance that lies between groups (``rho``, by the analysis of variance of
    binary outcomes) gives a beta-binomial prior of ``1 / rho - 1`` pages.
    """
    groups = children.where("labelled > 0").withColumn("share", F.col("bad") / F.col("labelled"))
    by = [parent] if parent else []
    above = groups.groupBy(*by).agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("labelled").alias("N"),
        (F.sum("bad") / F.sum("labelled")).alias("mean"),
        F.sum(F.col("labelled") * F.col("share") * F.col("share")).alias("squares"),
        F.sum(F.col("labelled") * F.col("share") * (1 - F.col("share"))).alias("within"),
        F.sum(F.col("labelled").cast("double") * F.col("labelled")).alias("sizes"),
    )
    sums = above.agg(
        F.sum("k").alias("k"),
        F.count(F.lit(1)).alias("parents"),
        F.sum("N").alias("N"),
        F.sum(F.col("squares") - F.col("N") * F.col("mean") * F.col("mean")).alias("between"),
        F.sum("within").alias("within"),
        F.sum(F.col("sizes") / F.col("N")).alias("sizes"),
    ).first()
    return weight_of(sums)


def weight_of(sums) -> float:
    """``prior_weight`` from its sums; with too few groups or no spread, the greatest weight."""
    if not sums["N"] or sums["k"] <= sums["parents"] or sums["N"] <= sums["k"]:
        return MOST_WEIGHT
    free = sums["k"] - sums["parents"]
    between, within = sums["between"] / free, sums["within"] / (sums["N"] - sums["k"])
    size = (sums["N"] - sums["sizes"]) / free
    scale = between + (size - 1) * within
    rho = (between - within) / scale if scale > 0 else 0.0
    return min(max(1 / rho - 1, LEAST_WEIGHT), MOST_WEIGHT) if rho > 0 else MOST_WEIGHT


def reputations(outcomes: DataFrame) -> DataFrame:
    """Per host: pages, posterior mean and lower bound of its share of bad pages."""
    domain, suffix = registered(F.col("host"))
    hosts = stored(outcomes.withColumns({"domain": domain, "suffix": suffix}), "url-hosts")
    sums = [F.sum(c).alias(c) for c in ("labelled", "bad")]
    domains = stored(hosts.groupBy("domain", "suffix").agg(*sums), "url-domains")
    suffixes = stored(domains.groupBy("suffix").agg(*sums), "url-suffixes")
    total = suffixes.agg(*sums).first()
    mean = ((total["bad"] or 0) + 0.5) / ((total["labelled"] or 0) + 1.0)

    def shrunk(prior: Column, weight: float) -> Column:
        return (F.col("bad") + weight * prior) / (F.col("labelled") + F.lit(weight))

    top = suffixes.select("suffix", shrunk(F.lit(mean), prior_weight(suffixes, None)).alias("prior"))
    middle = domains.join(top, "suffix").select(
        "domain", "suffix", shrunk(F.col("prior"), prior_weight(domains, "suffix")).alias("prior")
    )
    own = prior_weight(hosts, "domain")
    share = hosts.join(stored(middle, "url-priors"), ["domain", "suffix"]).withColumn("bad_share", shrunk(F.col("prior"), own))
    spread = F.sqrt(F.col("bad_share") * (1 - F.col("bad_share")) / (F.col("labelled") + F.lit(own) + 1))
    return share.select("host", "pages", "labelled", "bad", "bad_share", (F.col("bad_share") - DEVIATIONS * spread).alias("bad_bound"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: tuple[AddressRule, ...] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, bad_share, bad_bound."""
    known = stored(reputations(page_outcomes(pages, labels)), "url-reputations")
    total = known.agg(F.sum("pages")).first()[0] or 0
    host, path = address()
    each = pages.select("page_id", host.alias("host"), path.alias("path"))
    facts = ("host", "bad_share", "bad_bound")
    hot = known.where(F.col("pages") * HOT_PART > total).select(*facts)  # fewer than HOT_PART rows
    rest = known.where(F.col("pages") * HOT_PART <= total).select(*facts)
    placed = each.join(F.broadcast(hot), "host").unionByName(
        each.join(F.broadcast(hot.select("host")), "host", "left_anti").join(rest, "host")
    )
    hit = matching_rule(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.col("bad_bound") > BAD_SHARE, "block").otherwise("allow")
    return placed.withColumn("__hit", hit).select(
        "page_id", "host", "path", F.col("__hit.rule").alias("rule"),
        F.coalesce("__hit.verdict", verdict).alias("verdict"), "bad_share", "bad_bound",
    )


def judge_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns of ``filter_urls``."""
    return filter_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict")
