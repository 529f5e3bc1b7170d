"""URL filter: rules by host and path, and boosted trees on lexical features for the rest.

Everything is DataFrame operations: features are SQL expressions, statistics of host suffixes
are grouped sums, and the trees are Spark's own gradient-boosted trees. URLs that a rule fits
are the labelled ones the trees learn from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

#: Labelled URLs that trees are grown from at most: those with the smallest hash.
TRAIN_ROWS = 20_000
#: Labelled URLs a suffix is thought to have had beforehand, at the average rate.
PRIOR = 20.0
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "longest_label", "digit_ratio", "host_digits", "hyphens", "entropy", "host_entropy",
    "parameters", "query_length", "has_fragment", "is_secure", "extension", "suffix_rate", "suffix_seen", "domain_rate", "domain_seen",
)

Rule = tuple[str, str, str]  # verdict (allow or block), host, path from "/" on


def host_of(url: str) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    return F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))


def longest_rule(host: str, path: str, rules: Sequence[Rule]) -> Column:
    """The rule that fits and is longest as host and path together, as (rule, verdict); else null.

    A rule fits its host and all subdomains of it where the path begins with the rule's.
    Of rules equally long the one with the longer host goes first.
    """
    choice = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)) & F.col(path).startswith(rule_path)
        choice = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(choice)
    return choice


def _entropy(text: Column) -> Column:
    """Bits per character of a text; 0 if it is empty."""
    size = F.char_length(text).cast("double")
    share = lambda c: (F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))) / size
    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.aggregate(chars, F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c)))


def lexical(pages: DataFrame) -> DataFrame:
    """Adds the features that a URL alone has; ``url``, ``host`` and ``path`` are given."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    digits = lambda c: F.char_length(c) - F.char_length(F.regexp_replace(c, "[0-9]", ""))
    labels = F.filter(F.split("host", r"\."), lambda x: x != "")
    return pages.withColumns({
        "url_length": F.char_length(url), "host_length": F.char_length("host"), "path_length": F.char_length("path"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")), "labels": F.size(labels),
        "longest_label": F.coalesce(F.array_max(F.transform(labels, F.char_length)), F.lit(0)),
        "digit_ratio": F.when(F.char_length(url) > 0, digits(url) / F.char_length(url)).otherwise(0.0), "host_digits": digits(F.col("host")),
        "hyphens": F.char_length(url) - F.char_length(F.replace(url, F.lit("-"), F.lit(""))), "entropy": _entropy(F.concat("host", "path")), "host_entropy": _entropy(F.col("host")),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")), "query_length": F.char_length(query),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"), "is_secure": F.startswith(F.lower(url), F.lit("https:")).cast("int"),
        "extension": F.regexp_like("path", F.lit(r"\.[A-Za-z0-9]{1,5}$")).cast("int"),
        "suffix": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2),
    })


def suffix_statistics(labelled: DataFrame, key: str, rate: float) -> DataFrame:
    """(key, smoothed share of blocked URLs, log of the number of labelled ones) by a host suffix."""
    sums = labelled.groupBy(key).agg(F.sum("label").alias("blocked"), F.count("*").alias("n"))
    return sums.select(key, ((F.col("blocked") + PRIOR * rate) / (F.col("n") + PRIOR)).alias(f"{key}_rate"), F.log1p(F.col("n").cast("double")).alias(f"{key}_seen"))


def _with_statistics(pages: DataFrame, tables: dict[str, DataFrame], rate: float) -> DataFrame:
    for key, stats in tables.items():
        pages = pages.join(stats, key, "left")
    return pages.fillna({f"{k}_rate": rate for k in tables} | {f"{k}_seen": 0.0 for k in tables})


def train(labelled: DataFrame, max_rows: int = TRAIN_ROWS, trees: int = 20, depth: int = 4) -> Model:
    """Grow trees from rows with ``FEATURES`` and ``label`` (1: block); at most ``max_rows`` rows."""
    sample = labelled.select("url", "label", *FEATURES).orderBy(F.xxhash64("url"), "url").limit(max_rows)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees_ = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2, subsamplingRate=0.8, seed=7)
    return PipelineModel([assembler, trees_.fit(assembler.transform(sample).select("features", "label"))])


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", max_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and block_chance.

    The verdict is that of the longest rule that fits, else that of the trees: block where
    their ``block_chance`` exceeds a half. Null URLs and those without ``://`` have an empty
    host and path; they are judged by the trees like others. Where the rules label no URL,
    the rest is allowed, and where they label all alike, the rest has that verdict; the
    chance is then null. Rows with null or repeated ids are judged each by itself.
    """
    spread = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).withColumns({"host": host_of("url"), "path": path_of("url")})
    ruled = spread.withColumn("choice", longest_rule("host", "path", rules))
    rows = lexical(ruled.select("page_id", "url", "host", "path", "choice.rule", F.col("choice.verdict").alias("by_rule")))
    labelled = rows.where("rule IS NOT NULL").withColumn("label", (F.col("by_rule") == "block").cast("double"))
    seen = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    columns = ["page_id", "host", "path", "rule"]
    if not seen["n"] or seen["blocked"] in (0, seen["n"]):
        other = "block" if seen["n"] and seen["blocked"] else "allow"
        return rows.select(*columns, F.coalesce("by_rule", F.lit(other)).alias("verdict"), F.lit(None).cast("double").alias("block_chance"))
    rate = seen["blocked"] / seen["n"]
    tables = {key: suffix_statistics(labelled, key, rate) for key in ("suffix", "domain")}
    model = train(_with_statistics(labelled, tables, rate), max_rows)
    scored = model.transform(_with_statistics(rows, tables, rate))
    chance = vector_to_array("probability")[1]
    return scored.select(*columns, F.coalesce("by_rule", F.when(chance > 0.5, "block").otherwise("allow")).alias("verdict"), chance.alias("block_chance"))
