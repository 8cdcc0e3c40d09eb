"""URL filter: host and path rules, and gradient-boosted trees on lexical features for what no rule covers.

The urls that a rule covers are the labelled ones; the trees learn from them and judge the rest. Features are lexical:
lengths, depths, digit ratio, character entropy, parameter counts, and statistics of suffixes (the share of blocked urls
among labelled ones with the same top-level domain, registered domain, and first path segment).

Everything is DataFrame operations and Spark's own tree learner. Rows: a NULL url, or one without ``://``, has an empty
host and path and is judged by its (empty) features; repeated rows are judged alike; without labelled urls of both kinds
there is nothing to learn, and the one kind seen, or ``allow``, is the verdict; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import ascii_lower, materialize

#: (host, path, verdict): a rule covers its host and all subdomains, where the path starts with the rule's.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
#: Labelled urls the trees are fitted on: all, or a hash sample of about so many.
FIT_ROWS = 200_000
TREES, DEPTH, STEP = 12, 3, 0.3
#: Weight of the overall share in the share of a suffix.
PRIOR = 20.0
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_=&?:%"
SUFFIXES = ("top", "domain", "segment")


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) with host (A-Z in lower case) and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id", "url", ascii_lower(F.regexp_extract(url, pattern, 1)).alias("host"),
        F.regexp_extract(url, pattern, 2).alias("path"),
    )


def rule_of(rules: tuple = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that covers (host, path); NULL where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, kind in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        covers = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        text, verdict = F.when(covers, host + path).otherwise(text), F.when(covers, kind).otherwise(verdict)
    return text, verdict


def occurrences(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def lexical(parts: DataFrame) -> tuple[DataFrame, list[str]]:
    """``parts`` with its lexical features and the suffixes; and the names of the features."""
    url = F.lower(F.coalesce("url", F.lit("")))
    n = F.greatest(F.length(url), F.lit(1))
    share = lambda c: occurrences(url, c) / n
    entropy = sum((-F.when(share(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0) for c in ALPHABET), F.lit(0.0))
    labels = F.split("host", r"\.")
    features = {
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "host_depth": occurrences(F.col("host"), "."), "path_depth": occurrences(F.col("path"), "/"),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / n,
        "letter_ratio": F.length(F.regexp_replace(url, "[^a-z]", "")) / n,
        "entropy": entropy, "parameters": occurrences(url, "="), "separators": occurrences(url, "&"),
        "dashes": occurrences(url, "-"), "fragment": occurrences(url, "#"),
        "secure": F.startswith(url, F.lit("https:")).cast("int"),
        "extension": F.regexp_like("path", F.lit(r"\.[A-Za-z0-9]{1,5}$")).cast("int"),
    }
    suffixes = {
        "top": F.element_at(labels, -1), "domain": F.array_join(F.slice(labels, F.greatest(F.lit(-2), -F.size(labels)), 2), "."),
        "segment": F.regexp_extract("path", "^/([^/]*)", 1),
    }
    out = parts.select("*", *[v.cast("double").alias(k) for k, v in features.items()], *[v.alias(k) for k, v in suffixes.items()])
    return out, list(features)


def with_suffix_shares(rows: DataFrame, labelled: DataFrame, share: float) -> tuple[DataFrame, list[str]]:
    """``rows`` with the smoothed share of blocked urls, and the log count, of each suffix among ``labelled``."""
    names = []
    for s in SUFFIXES:
        stats = labelled.groupBy(s).agg(F.sum("label").alias("blocked"), F.count("*").alias("n")).select(
            s, ((F.col("blocked") + PRIOR * share) / (F.col("n") + PRIOR)).alias(f"{s}_share"),
            F.log1p("n").alias(f"{s}_count"),
        )
        rows = rows.join(stats, s, "left").fillna({f"{s}_share": share, f"{s}_count": 0.0})
        names += [f"{s}_share", f"{s}_count"]
    return rows, names


def judge(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; ``score`` is the trees' probability of block."""
    text, verdict = rule_of(rules)
    rows, features = lexical(with_parts(pages).withColumns({"rule": text, "ruled": verdict}))
    rows = materialize(rows.withColumn("label", F.when(F.col("ruled") == "block", 1.0).when(F.col("ruled") == "allow", 0.0)), "urls")
    labelled = rows.filter("label IS NOT NULL")
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    own = ["page_id", "host", "path", "rule"]
    if not 0 < blocked < n:
        only = "block" if n and blocked == n else "allow"
        return rows.select(
            *own, F.coalesce("ruled", F.lit(only)).alias("verdict"), F.lit(float(only == "block")).alias("score")
        )
    rows, shares = with_suffix_shares(rows, labelled, blocked / n)
    assembled = VectorAssembler(inputCols=features + shares, outputCol="features").transform(rows)
    bound = F.pmod(F.xxhash64("url", "page_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, FIT_ROWS / n))
    model = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=32, seed=7,
    ).fit(assembled.filter("label IS NOT NULL").filter(bound).select("features", "label"))
    score = F.element_at(vector_to_array("probability"), 2)
    return model.transform(assembled).select(
        *own, F.coalesce("ruled", F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"), score.alias("score")
    )
