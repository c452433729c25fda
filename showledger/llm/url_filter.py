"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

Everything is DataFrame, SQL-function and pyspark.ml work in the JVM. The classifier is trained from a labelled URL
table: by default the URLs that a rule already decides, at most `TRAIN_ROWS` of them for each verdict, taken in the
order of a hash so that the choice is the same at every size and run. A host and path that no rule decides get the
method's verdict.

Defined results: a null URL, or one without `://`, has an empty host and path and is judged by the model like any other
(only the bias counts); a very long URL is used whole; repeated rows are judged alike; an empty table gives no rows; if
the labelled table lacks one verdict, the model's verdict is the one that is there, and `allow` when it is empty. Extra
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows used for each verdict (bound of the training sample).
TRAIN_ROWS = 5_000
#: Hashed features; lengths of the n-grams.
FEATURES, GRAMS = 1 << 12, (3, 4, 5)

# The rule list (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) as the filter defines them."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first, at the outside
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule, verdict = F.when(fits, own + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, told apart by a mark; each end has a space."""
    def of(mark: str, part: Column) -> Column:
        chars = F.split(F.concat(F.lit(" "), part, F.lit(" ")), "")

        def size(n: int) -> Column:
            places = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n)).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda i: F.concat(F.lit(mark), *[F.get(chars, i + k) for k in range(n)]))

        return F.concat(*[size(n) for n in GRAMS])

    return F.concat(of("h", host), of("p", path))


def train(labelled: DataFrame, rows: int = TRAIN_ROWS):
    """Logistic regression over `labelled` (host, path, verdict); None if there is only one verdict."""
    order = F.xxhash64("host", "path")
    one = labelled.where("verdict in ('allow', 'block')").select("host", "path", "verdict").distinct()
    found = dict(one.groupBy("verdict").count().collect())  # two rows
    if len(found) < 2:
        return None, next(iter(found), "allow")
    sample = None
    for verdict, n in sorted(found.items()):  # weights keep the ratio that both verdicts have over all rows
        part = one.where(F.col("verdict") == verdict).orderBy(order, "host", "path").limit(rows).withColumn("weight", F.lit(n / min(n, rows)))
        sample = part if sample is None else sample.unionByName(part)
    ready = HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features", binary=True).transform(
        sample.select(grams(F.col("host"), F.col("path")).alias("grams"), (F.col("verdict") == "block").cast("double").alias("label"), "weight"))
    return LogisticRegression(maxIter=30, regParam=0.01, weightCol="weight").fit(ready.select("features", "label", "weight")), None


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and p_block (the model's probability; null where a rule decides)."""
    host, path = split_url(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    ruled = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    model, only = train(ruled if labelled is None else labelled)
    if model is None:
        return ruled.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("p_block"))
    tf = HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features", binary=True)
    judged = model.transform(tf.transform(ruled.withColumn("grams", F.when(F.col("rule").isNull(), grams(F.col("host"), F.col("path"))).otherwise(F.array().cast("array<string>")))))
    p = F.when(F.col("rule").isNull(), vector_to_array("probability")[1])
    return judged.select("page_id", "host", "path", "rule", p.alias("p_block"), "verdict").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"), "p_block")
