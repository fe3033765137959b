"""URL filter: rules, and a character language-model ratio for the rest.

Host and path of a URL are held against allow and block rules (a host with its
subdomains and a path prefix; the longest fitting rule wins). The URLs that
rules accept and reject train two smoothed Markov models of characters. A
character's probability blends all orders from ``ORDER`` characters of history
down to none, each order trusting its counts the more often its history was
seen, so the effective order varies with the history. A URL that no rule fits
is judged by the mean log-ratio of the two models per character, against a
threshold calibrated on labelled hosts kept out of the training.

Everything is DataFrame expressions: n-grams are exploded from the distinct
host-and-path texts and counted with partial aggregation; lower orders are
sums over the full order's counts; the models are joined to the distinct
n-grams of the texts to judge, never to their positions. Joins on n-grams are
plain (AQE broadcasts small model tables by their measured size, and splits a
frequent n-gram else). Counts cover every labelled URL.

Defined cases: null URL or no ``://``: empty host and path; a text without
characters, or models without training URLs of both kinds: the method allows;
repeated pages get a row each; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: (verdict, host and path prefix)
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)
#: Characters of history.
ORDER = 4
#: Weight of the lower order, in observations of the history.
BACKOFF = 2.0
#: Probability of a character before any is seen.
FLOOR = 1.0 / 256
#: One host in so many calibrates instead of training.
CALIBRATION = 5


def parsed(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column."""
    u = F.col(url)
    rest = F.when(F.instr(u, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), upper, upper.lower()),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """Struct of the verdict and the longest rule that fits (null: none)."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, prefix = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _grams(texts: DataFrame, *keep: str) -> DataFrame:
    """A row per character (and one for the end) with its full history."""
    marked = F.concat(F.lit("^" * ORDER), F.col("url_text"), F.lit("$"))
    at = F.explode(F.sequence(F.lit(1), F.length("url_text") + 1)).alias("at")
    return (texts.select(*keep, marked.alias("marked"), at)
            .select(*keep, F.expr(f"substring(marked, at, {ORDER + 1})").alias("gram")))


def model_counts(train: DataFrame) -> DataFrame:
    """s, history, n_allow, n_block: counts of all n-grams and histories of
    the texts (url_text, verdict), of every order."""
    both = [F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block")]
    one = lambda v: F.when(F.col("verdict") == v, 1).otherwise(0).cast("double").alias(f"n_{v}")
    full = _grams(train, "verdict").select("gram", one("allow"), one("block")).groupBy("gram").agg(*both)
    # Every order at once: a gram's last characters, and what stands before the very last.
    suffix = F.explode(F.sequence(F.lit(1), F.lit(ORDER + 1))).alias("size")
    orders = full.select("gram", "n_allow", "n_block", suffix)
    piece = F.expr(f"substring(gram, {ORDER + 2} - size, size)")
    before = F.expr(f"substring(gram, {ORDER + 2} - size, size - 1)")
    either = F.explode(F.array(F.struct(piece.alias("s"), F.lit(False).alias("history")),
                               F.struct(before.alias("s"), F.lit(True).alias("history")))).alias("x")
    return orders.select(either, "n_allow", "n_block").groupBy("x.s", "x.history").agg(*both)


def gram_ratios(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """gram, ratio: log P(allow) - log P(block) of the last character."""
    asked = grams.select("gram").distinct().select(
        "gram", F.explode(F.sequence(F.lit(1), F.lit(ORDER + 1))).alias("size"))
    either = F.explode(F.array(
        F.struct(F.expr(f"substring(gram, {ORDER + 2} - size, size)").alias("s"), F.lit(False).alias("history")),
        F.struct(F.expr(f"substring(gram, {ORDER + 2} - size, size - 1)").alias("s"), F.lit(True).alias("history")))).alias("x")
    asked = asked.select("gram", "size", either).select("gram", "size", "x.s", "x.history")
    seen = asked.join(counts, ["s", "history"], "left")
    slots = [(size, history, verdict) for size in range(1, ORDER + 2) for history in (False, True) for verdict in ("allow", "block")]
    wide = seen.groupBy("gram").agg(*[
        F.coalesce(F.max(F.when((F.col("size") == s) & (F.col("history") == h), F.col(f"n_{v}"))), F.lit(0.0)).alias(f"{v}_{s}_{int(h)}")
        for s, h, v in slots])

    def probability(v: str) -> Column:
        return reduce(lambda p, s: (F.col(f"{v}_{s}_0") + BACKOFF * p) / (F.col(f"{v}_{s}_1") + BACKOFF),
                      range(1, ORDER + 2), F.lit(FLOOR))

    return wide.select("gram", (F.log(probability("allow")) - F.log(probability("block"))).alias("ratio"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: tuple = RULES) -> DataFrame:
    """key, host, path, rule, verdict, ratio of every page (ratio: where the
    method judged)."""
    host, path = parsed(url)
    rows = (pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
            .withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
            .withColumn("url_text", F.concat("host", "path")))
    texts = (rows.select("url_text", "host", F.col("found.verdict").alias("verdict")).distinct()
             .where(F.length("url_text") > 0)
             .withColumn("train", F.col("verdict").isNotNull() & (F.crc32("host") % CALIBRATION != 0)))
    texts = materialize(texts, "url-texts")
    counts = model_counts(texts.where("train"))
    grams = _grams(texts.where("NOT train"), "url_text", "verdict")
    scored = (grams.join(gram_ratios(grams, counts), "gram")
              .groupBy("url_text", "verdict").agg(F.avg("ratio").alias("ratio")))
    scored = materialize(scored, "url-ratios")
    spread = {r["verdict"]: (r["m"], r["s"]) for r in scored.where("verdict IS NOT NULL").groupBy("verdict").agg(
        F.avg("ratio").alias("m"), F.stddev_pop("ratio").alias("s")).collect()}  # two rows
    trained = texts.where("train").select("verdict").distinct().count() == 2
    threshold = 0.0
    if {"allow", "block"} <= spread.keys():
        (ma, sa), (mb, sb) = spread["allow"], spread["block"]
        threshold = (ma * sb + mb * sa) / (sa + sb) if sa + sb > 0 else (ma + mb) / 2
    out = rows.join(scored.where("verdict IS NULL").select("url_text", "ratio"), "url_text", "left")
    verdict = F.when(F.col("found").isNotNull(), F.col("found.verdict"))
    if trained:
        verdict = verdict.when(F.col("ratio") < threshold, "block")
    return out.select(F.col("key").alias(key), "host", "path", F.col("found.rule").alias("rule"),
                      verdict.otherwise("allow").alias("verdict"), "ratio")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL, judged."""
    return judge(table(spark, sf_dir, "pages")).drop("ratio")
