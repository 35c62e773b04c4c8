"""URL filters by empirical-Bayes host reputation, with allow and block rules.

Outcomes of labelled pages are counted per host. A beta-binomial prior is shrunk from level to
level: the corpus gives the prior of a suffix, the suffix that of a registered domain, the domain
that of a host. At each level the prior's strength is fitted by the method of moments from the
spread of the rates below it. A host is blocked when the upper bound of its posterior good rate
is below ``min_rate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinework.llm.common import checkpoint, split_join

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MIN_RATE, Z = 0.5, 1.64
# Public suffixes of two labels under which names are registered.
TWO_LABELS = (
    "ac.uk co.uk gov.uk org.uk co.jp ne.jp or.jp co.kr co.nz org.nz co.za co.in co.il co.id com.au net.au org.au com.br com.ar com.mx"
    " com.tr com.cn com.tw com.hk com.sg com.ua com.pl github.io"
).split()
#: Bounds of a fitted prior strength, in pages.
WEAKEST, STRONGEST = 2.0, 500.0
LEVELS = ("suffix", "domain", "host")


def parts(pages: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(id, __url, host, path, domain, suffix).

    A null url or one without ``://`` has an empty host and path. The registered domain is the
    suffix and one label more, the suffix the last label, or two for those of TWO_LABELS.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url).alias("__url"))
    rest = F.coalesce(F.when(F.contains("__url", F.lit("://")), F.expr("substring(__url, instr(__url, '://') + 3)")), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    two = F.substring_index("host", ".", -2).isin(TWO_LABELS)
    return rows.select("*", host.alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path")).select(
        "id",
        "__url",
        "host",
        "path",
        F.when(two, F.substring_index("host", ".", -3)).otherwise(F.substring_index("host", ".", -2)).alias("domain"),
        F.when(two, F.substring_index("host", ".", -2)).otherwise(F.substring_index("host", ".", -1)).alias("suffix"),
    )


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host, path), as text, and its verdict; null where none fits."""
    rule = verdict = None
    for what, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def reputations(counted: DataFrame, z: float = Z) -> DataFrame:
    """Posterior (host, rate, lower, upper) from (host, domain, suffix, good, pages)."""
    known = counted.withColumn("everything", F.lit(1))
    top = known.groupBy("everything").agg(((F.sum("good") + 1) / (F.sum("pages") + 2)).alias("rate"))
    above, parent = top, "everything"
    for level in LEVELS:
        own = known.groupBy(parent, level).agg(F.sum("good").alias("good"), F.sum("pages").alias("pages"))
        seen = checkpoint(own.join(above.withColumnRenamed("rate", "prior"), parent))  # read twice below
        m = F.col("prior")
        spread = F.try_divide(
            F.sum(F.col("pages") * (F.try_divide("good", "pages") - m) ** 2), F.sum("pages")
        )
        size = F.try_divide(F.sum(F.col("pages").cast("double")), F.count(F.when(F.col("pages") > 0, 1)))
        noise = F.first("prior") * (1 - F.first("prior"))
        # variance of a rate of n pages: m(1-m)(1/n + (1-1/n)/(s+1)); solved for the strength s
        between = (spread - noise / size) / (1 - 1 / F.greatest(size, F.lit(2.0)))
        ratio = F.try_divide(noise, F.when(between > 0, between))
        strength = F.when(ratio.isNull(), STRONGEST).otherwise(F.least(F.greatest(ratio - 1, F.lit(WEAKEST)), F.lit(STRONGEST)))
        fitted = seen.groupBy(parent).agg(strength.alias("strength"))
        joined = split_join(seen, fitted, parent)  # a domain may have very many hosts
        a = F.col("prior") * F.col("strength") + F.col("good")
        n = F.col("strength") + F.col("pages")
        above, parent = joined.select(level, (a / n).alias("rate"), n.alias("n")), level
        if level != LEVELS[-1]:
            above = above.drop("n")
    half = z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + 1))
    return above.select("host", "rate", (F.col("rate") - half).alias("lower"), (F.col("rate") + half).alias("upper"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, min_rate: float = MIN_RATE, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: (id, host, path, rule, verdict, rate, upper).

    ``outcomes`` has (id, good): good is 1 or 0; rows with a null in either are not used and several
    outcomes of a page each count. The longest fitting rule decides; without one the host's
    posterior does. A host without labelled pages is judged by its domain's rate, and so on upwards;
    with no labels at all every page passes. Repeated pages get a row each.
    """
    rows = parts(pages, id_col, url)
    good = outcomes.select(F.col(id_col).alias("id"), F.col("good").cast("bigint").alias("good")).dropna()
    hosts = checkpoint(
        rows.join(good, "id", "left")
        .groupBy("host", "domain", "suffix")
        .agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("pages"))
    )
    rule, ruled = rule_of(rules)
    known = checkpoint(reputations(hosts))  # a row for each host; the join below can split a hot one
    return rows.join(known, "host", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(ruled, F.when(F.col("upper") < min_rate, "block").otherwise("allow")).alias("verdict"),
        "rate",
        "upper",
    )
