"""URL verdicts: host rules first, else a logistic regression on hashed character n-grams of host and path.

The regression is trained on a small labelled URL table: the URLs that a rule decides, at most half of ``max_rows``
of each verdict, taken in the order of a hash. Features and model run inside the JVM (Spark ML), so there is no Python on the executors.

Defined cases: a null URL or one without ``://`` has an empty host and path; equal URLs get equal verdicts; with no
labelled URL the verdict is ``allow``, with labels of one kind it is that kind; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import ASCII_LOWER, empty_if_null, materialise

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
GRAMS = (3, 4)
FEATURES = 1 << 14


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: str) -> Column:
    return ASCII_LOWER(F.regexp_extract(empty_if_null(url), PARTS, 1))


def url_path(url: str) -> Column:
    return F.regexp_extract(empty_if_null(url), PARTS, 2)


def matching_rule(rules: Sequence[Rule], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits, as its text; of equally long ones that with the longer host. Else null."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = (F.col(host) == r.host) | F.col(host).endswith("." + r.host)
        found = F.when(fits & F.col(path).startswith(r.path), F.lit(r.text)).otherwise(found)
    return found


def char_grams(text: Column, n: int, prefix: str) -> Column:
    """All n-grams of ``^text$``, prefixed; none when it is shorter than n."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    starts = F.when(F.length(framed) >= n, F.sequence(F.lit(1), F.length(framed) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat(F.lit(prefix), framed.substr(i, F.lit(n))))


def url_features(df: DataFrame) -> DataFrame:
    """Adds the hashed n-gram counts of ``host`` and ``path`` as ``__url_features``."""
    grams = F.concat(*[char_grams(F.col(c), n, f"{c[0]}{n}:") for c in ("host", "path") for n in GRAMS])
    return HashingTF(numFeatures=FEATURES, inputCol="__url_grams", outputCol="__url_features", binary=True).transform(df.withColumn("__url_grams", grams)).drop("__url_grams")


def labelled_urls(parts: DataFrame, rules: Sequence[Rule], max_rows: int) -> DataFrame:
    """The labelled URL table: at most half of ``max_rows`` distinct (host, path) of each label that a rule decides, with ``label`` 1 for block."""
    blocked = [r.text for r in rules if r.verdict == "block"]
    known = parts.select("host", "path", "rule").filter("rule IS NOT NULL").distinct()
    known = known.select("host", "path", F.col("rule").isin(blocked).cast("double").alias("label"))
    first = [known.filter(F.col("label") == label).orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_rows // 2) for label in (0.0, 1.0)]
    return materialise(first[0].unionByName(first[1]), "labelled-urls")


def train(labelled: DataFrame) -> LogisticRegressionModel | str:
    """A fitted model, or the verdict for every URL when the labels are of fewer than two kinds."""
    kinds = {r["label"] for r in labelled.select("label").distinct().collect()}
    if len(kinds) < 2:
        return "block" if kinds == {1.0} else "allow"
    return LogisticRegression(featuresCol="__url_features", labelCol="label", maxIter=40, regParam=1e-3).fit(url_features(labelled))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", max_rows: int = 20_000) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` and ``block_score`` (null without a model); columns of those names are replaced."""
    parts = pages.withColumns({"host": url_host(url), "path": url_path(url)})
    parts = parts.withColumn("rule", matching_rule(rules))
    model = train(labelled_urls(parts, rules, max_rows))
    by_rule = F.lit(None).cast("string")
    for r in rules:
        by_rule = F.when(F.col("rule") == r.text, F.lit(r.verdict)).otherwise(by_rule)
    if isinstance(model, str):
        return parts.withColumns({"block_score": F.lit(None).cast("double"), "verdict": F.coalesce(by_rule, F.lit(model))})
    from pyspark.ml.functions import vector_to_array

    model = model.setPredictionCol("__url_verdict").setProbabilityCol("__url_share").setRawPredictionCol("__url_raw")
    scored = model.transform(url_features(parts)).withColumn("block_score", vector_to_array("__url_share")[1])
    scored = scored.withColumn("verdict", F.coalesce(by_rule, F.when(F.col("__url_verdict") == 1.0, "block").otherwise("allow")))
    return scored.drop("__url_features", "__url_raw", "__url_share", "__url_verdict")
