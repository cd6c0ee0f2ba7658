"""Host and path rules for URLs, and boosted trees on lexical features where no rule fits.

The labelled URLs are those that a rule decides.  Trees are trained on at most
about ``SAMPLE`` of them, chosen by a hash of the URL, so the fit has a bounded
size; everything else covers all rows.  Suffix statistics are counted over all
labelled URLs, one row per host suffix, and joined.

Only DataFrame and ML functions are used.  Defined results: a null URL, or one
without ``://``, has an empty host and path and no rule; repeated rows are judged
one by one; without labelled URLs of both verdicts the only one seen, or else
``allow``, holds for all.
Very long URLs are judged whole, and repeated rows one by one; of equally long rules there is one only; an empty table
gives no rows; other columns play no part in a verdict.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import once
from .stages import written

#: Rules of the registered query: verdict, host, path.  Fixed values.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
SAMPLE = 20_000
ITERATIONS = 20
DEPTH = 4
SMOOTHING = 20.0
LEXICAL = ["length", "host_length", "depth", "labels", "digit_ratio", "hyphens", "parameters", "entropy"]
FEATURES = [*LEXICAL, "suffix_urls", "suffix_blocked"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule for the columns _host and _path, as a struct of rule and verdict, else null."""
    found = F.lit(None)
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("_host") == host) | F.endswith(F.col("_host"), F.lit("." + host)))
        fits = fits & F.startswith(F.col("_path"), F.lit(path))
        found = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)

    def part(c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -p * F.log2(p)

    letters = F.array_distinct(F.array_remove(F.split(text, ""), ""))
    return F.aggregate(F.transform(letters, part), F.lit(0.0), lambda total, x: total + x)


def lexical(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``pages`` with _host, _path, _rule, _suffix and the lexical features, each computed once."""
    host, path = host_and_path(F.col("url"))
    placed = once(pages, _host=host, _path=path)
    ruled = once(placed, _rule=matched_rule(rules), _suffix=F.substring_index("_host", ".", -1))
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)

    def count(characters: str, text: Column = url) -> Column:
        return F.length(text) - F.length(F.translate(text, characters, ""))

    query = F.when(F.contains(url, F.lit("?")), count("&") + count("=")).otherwise(F.lit(0))
    features = {
        "_length": n, "_host_length": F.length("_host"), "_depth": count("/", F.col("_path")),
        "_labels": count(".", F.col("_host")), "_digit_ratio": count("0123456789") / F.greatest(n, F.lit(1)),
        "_hyphens": count("-_~"), "_parameters": query, "_entropy": entropy(url),
    }
    return once(ruled, **{k: v.cast("double") for k, v in features.items()})


def suffix_statistics(ruled: DataFrame) -> DataFrame:
    blocked = (F.col("_rule.verdict") == "block").cast("double")
    overall = SMOOTHING / 2
    return (
        ruled.where("_rule is not null").groupBy(F.col("_suffix").alias("_of"))
        .agg(F.log1p(F.count("*").cast("double")).alias("_suffix_urls"),
             ((F.sum(blocked) + overall) / (F.count("*") + SMOOTHING)).alias("_suffix_blocked"))
    )


def with_suffixes(features: DataFrame, suffixes: DataFrame) -> DataFrame:
    joined = features.join(suffixes, F.col("_suffix") == F.col("_of"), "left").drop("_of")
    return joined.fillna({"_suffix_urls": 0.0, "_suffix_blocked": 0.5})


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """``pages`` with the new columns url_host, url_path, url_rule, url_verdict and url_score (the trees' chance of a block)."""
    found = lexical(pages, rules)
    slim = lexical(pages.select("url"), rules)
    suffixes = written(suffix_statistics(slim), "suffixes")
    labelled = slim.where("_rule is not null")
    seen = {r["v"]: r["count"] for r in labelled.groupBy(F.col("_rule.verdict").alias("v")).count().collect()}
    columns = [c for c in pages.columns if c not in ("url_host", "url_path", "url_rule", "url_verdict", "url_score")]
    features = [f"_{f}" for f in FEATURES]
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    everything = with_suffixes(found, suffixes)
    if len(seen) == 2:
        share = min(1.0, sample / sum(seen.values()))
        chosen = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
        train = with_suffixes(chosen, suffixes).select(
            *features, (F.col("_rule.verdict") == "block").cast("double").alias("_label"))
        trees = GBTClassifier(featuresCol="_features", labelCol="_label", predictionCol="_block",
                              maxIter=ITERATIONS, maxDepth=DEPTH, seed=7)
        trees.setRawPredictionCol("_raw").setProbabilityCol("_chance")
        model = trees.fit(assembler.transform(written(train, "labelled_urls")))
        scored = model.transform(assembler.transform(everything))
        chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * vector_to_array(F.col("_raw"))[1]))
    else:
        scored = everything
        chance = F.lit(1.0 if "block" in seen else 0.0)
    scored = once(scored, _score=chance)
    learnt = F.when(F.col("_score") > 0.5, "block").otherwise("allow")
    return scored.select(
        *columns, F.col("_host").alias("url_host"), F.col("_path").alias("url_path"),
        F.col("_rule.rule").alias("url_rule"), F.coalesce("_rule.verdict", learnt).alias("url_verdict"),
        F.col("_score").alias("url_score"))

