"""URL filter: rules, and logistic regression on hashed character n-grams of host and path. JVM-side throughout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import table
from lodeplane.llm.url_labels import labelled_urls

FEATURES = 1 << 14
GRAMS = (3, 4, 5)
#: The rules of op2: what a host and the start of a path must be, and what follows.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without :// or for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _A_TO_Z, _A_TO_Z.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without :// or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (of equally long ones the first in text order), and its verdict; both null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda x: (len(x[0]), [-ord(c) for c in x[0]])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith(f".{text[:at]}")) & path.startswith(text[at:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def grams(text: Column, mark: str) -> Column:
    """Character n-grams of a text between blanks, each behind a mark."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded) - (n - 1))
        return F.when(F.length(padded) >= n, F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(padded, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in GRAMS])


def features(urls: DataFrame) -> DataFrame:
    """urls (with host and path) plus the hashed n-grams."""
    tokens = F.concat(grams(F.col("host"), "h"), grams(F.regexp_replace("path", "[0-9]+", "0"), "p"))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_tokens", outputCol="_features").transform(urls.withColumn("_tokens", tokens))


def train(labelled: DataFrame, regularisation: float = 0.003) -> LogisticRegressionModel:
    """A model from a small table (url, label), label 1 for block."""
    rows = features(labelled.coalesce(1).select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("double")))
    return LogisticRegression(featuresCol="_features", labelCol="label", regParam=regularisation, maxIter=100, tol=1e-4, standardization=False).fit(rows)


def judge(urls: DataFrame, model: LogisticRegressionModel, rules: Sequence[tuple[str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """urls (with url) plus host, path, rule, verdict and p_block. Null urls have empty hosts and paths and get the method's verdict.

    Each row depends on its url alone. Columns of urls with these names are replaced.
    """
    urls = urls.drop("host", "path", "rule", "verdict", "p_block", "_tokens", "_features", "_raw", "_p", "_verdict")
    inner = features(urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}))
    model = model.copy().setFeaturesCol("_features").setRawPredictionCol("_raw").setProbabilityCol("_p").setPredictionCol("_verdict")
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    p = vector_to_array("_p")[1]
    scored = model.transform(inner).withColumns({"rule": rule, "p_block": p})
    return scored.select(*urls.columns, "host", "path", "rule", F.coalesce(verdict, F.when(p >= threshold, "block").otherwise("allow")).alias("verdict"), "p_block")


def op2_url_ngram_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for the url of every page."""
    model = train(spark.createDataFrame(labelled_urls(), "url string, label int"))
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), model).select("page_id", "host", "path", "rule", "verdict", "p_block")
