"""URL filter: host and path rules, else a classifier on hashed character n-grams of host and path.

Built-in expressions only. The classifier is a logistic regression fitted on a small
table of labelled URLs; scoring a table of any size is a projection without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lengths of the n-grams, slots they are hashed to, and strength of the regularisation.
LENGTHS, SLOTS, RIDGE = (3, 4, 5), 1 << 14, 0.002
#: Without a rule, only what is clearly unwanted is blocked.
BLOCK_AT = 0.8

#: Rules host/path; at most some hundred, since each is tried on each URL.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# (The rules above are fixed values.)

#: Words that hosts and paths of the labelled table are built from: of unwanted and of ordinary sites.
UNWANTED = (
    "casino poker slots jackpot roulette bets betting win winner bonus free cheap discount pills viagra pharmacy adult xxx x porn sex cams dating"
    " spam farm links ads track tracker click popup banner loans payday cash crack keygen warez torrent replica prize giveaway"
).split()
ORDINARY = (
    "library museum school garden harbour river news weather recipes wiki council orchestra journal hospital books archive trains forum parliament"
    " sports research village mountain coast teacher history science travel music health data street forest city north old open"
).split()
#: Syllables of made-up names, which stand for hosts that say nothing.
SYLLABLES = "an be con del er in lan mo on or ra re st tan th ti tion ver wh".split()
ENDINGS = ("com", "net", "org")
LEADS = ("", "www.", "m.", "blog.")
PATHS = ("/en/{n}", "/de/{n}.html", "/fr/{n}/", "/es/{n}?page=2", "/{w}/{n}", "/{w}", "/en/{w}-{n}.html")


def labelled() -> list[tuple[str, int]]:
    """The small table of URLs: 1 for unwanted, 0 for ordinary and for made-up hosts; all under the same endings and paths."""
    made_up = [SYLLABLES[i % 19] + SYLLABLES[(5 * i + 3) % 19] + ("" if i % 3 else SYLLABLES[(7 * i + 1) % 19]) for i in range(60)]
    out = []
    for bad, words in ((1, UNWANTED), (0, ORDINARY), (0, made_up)):
        for i, w in enumerate(words):
            other = words[(7 * i + 3) % len(words)]
            for k, host in enumerate((w, f"{w}-{other}", f"{other}-{w}") if words is not made_up else (w, f"{w}{other}")):
                n = i + k
                path = PATHS[n % len(PATHS)].format(n=37 * n + 11, w=other)
                out.append((f"http{'s' * (n % 2)}://{LEADS[n % 4]}{host}.example.{ENDINGS[n % 3]}{path}", bad))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct (size, rule, verdict) of the longest rule that fits; null if none does."""
    found = []
    for rule, verdict in rules:
        own, sep, rest = rule.partition("/")
        inside = (host == own) | F.endswith(host, F.lit("." + own))
        fits = inside & F.startswith(path, F.lit(sep + rest))
        found.append(F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.greatest(*found) if len(found) > 1 else found[0]


def ngrams(text: Column, mark: str, lengths: Sequence[int] = LENGTHS) -> Column:
    """All character n-grams of a text with a start and an end sign, each led by `mark`."""
    # Cut into characters once, so that long texts cost no more per character than short ones.
    chars = F.concat(F.array(F.lit("^")), F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), F.array(F.lit("$")))
    parts = []
    for n in lengths:
        shifted = [F.slice(chars, F.lit(k + 1), F.greatest(F.size(chars) - n + 1, F.lit(0))) for k in range(n)]
        joined = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y)), shifted)
        parts.append(F.transform(joined, lambda x: F.concat(F.lit(mark), x)))
    return F.concat(*parts)


@dataclass(frozen=True)
class UrlModel:
    hashing: HashingTF
    regression: LogisticRegressionModel


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(u).alias("url"), F.lit(float(y)).alias("label")) for u, y in labelled()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _grams(df: DataFrame) -> DataFrame:
    return df.withColumn("__grams", F.concat(ngrams(F.col("host"), "h"), ngrams(F.col("path"), "p")))


def fit_urls(labelled: DataFrame, *, url: str = "url", label: str = "label") -> UrlModel:
    """Logistic regression of label (1: block) on the n-grams of host and path."""
    host, path = host_and_path(F.col(url))
    hashing = HashingTF(inputCol="__grams", outputCol="__x", numFeatures=SLOTS, binary=True)
    rows = hashing.transform(_grams(labelled.select(host.alias("host"), path.alias("path"), F.col(label).alias("label"))))
    return UrlModel(hashing, LogisticRegression(featuresCol="__x", labelCol="label", regParam=RIDGE, maxIter=60).fit(rows.select("__x", "label")))


def judge_urls(
    pages: DataFrame, model: UrlModel, *, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES, block_at: float = BLOCK_AT
) -> DataFrame:
    """(key, host, path, rule, verdict, block_probability) of every row.

    The longest rule that fits decides; without one the probability does. A null URL, or
    one without `://`, has empty host and path, which no rule fits. Repeated rows are
    judged each; an empty table gives no rows.
    """
    host, path = host_and_path(F.col(url))
    parts = _grams(pages.select(F.col(key), host.alias("host"), path.alias("path")))
    regression = model.regression.copy().setFeaturesCol("__x").setProbabilityCol("__p").setPredictionCol("").setRawPredictionCol("")
    scored = regression.transform(model.hashing.transform(parts))
    chance = vector_to_array("__p")[1]
    best = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(chance >= block_at, F.lit("block")).otherwise("allow")
    return scored.select(key, "host", "path", best["rule"].alias("rule"), F.coalesce(best["verdict"], own).alias("verdict"), chance.alias("block_probability"))
