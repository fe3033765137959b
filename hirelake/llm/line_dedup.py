"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate. Lines are known by a 128-bit
hash. One hash aggregation keeps the lines that can be spread at all (often
enough, two different sites); for those a HyperLogLog sketch of the sites is
built per line and merged by the aggregation. Where the sketch's estimate is
within its error of the threshold, an exact distinct count decides. A
boilerplate line stays in the document with the smallest key and goes from all
others.

Only hashes and keys are shuffled for the decision; texts move once, to meet
the positions of their removed lines. All aggregations combine before the
shuffle, a line is reduced to one row for each of its sites before it is
joined and sketched, and the last join is a plain one that AQE splits, so a
line that a third of all documents hold lands in no single task.

Every line that is not blank is searched, whatever its length. The query and
its SQL compare lines without blanks at their ends, the pipeline stage without
white space of any kind.

Defined cases: a null site is the empty site; a null text stays null; blank
lines are never boilerplate;
repeated rows of one key are treated alike, and if that key is the smallest
all of them keep the line; rows with a null key keep a line only if every row
holding it has a null key; further columns pass through, ``removed_lines`` and
``lines`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: A line on so many sites is boilerplate.
MIN_SITES = 3
#: What the stage trims from a line (the query and its SQL trim blanks only).
WHITE = " \t\r\f\v"
SKETCH_LG_K = 12
#: Relative error of such a sketch (three standard deviations).
SKETCH_ERROR = 3 * 1.04 / (2 ** (SKETCH_LG_K / 2))


def _lines(df: DataFrame, key: str, site: str, text: str, blanks: str) -> DataFrame:
    line = F.btrim(F.col("line"), F.lit(blanks))
    return (df.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"),
                      F.xxhash64(F.coalesce(F.col(site).cast("string"), F.lit(""))).alias("site"),
                      F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
            .where(line != "")
            .select("key", "text_hash", "site", "pos", F.xxhash64(line).alias("h1"),
                    F.xxhash64(F.lit("line"), line).alias("h2")))


def boilerplate(df: DataFrame, key: str = "doc_id", site: str = "source", text: str = "text",
                min_sites: int = MIN_SITES, blanks: str = " ") -> DataFrame:
    """h1, h2, first_key of the lines on at least ``min_sites`` sites."""
    lines = _lines(df, key, site, text, blanks)
    able = (lines.groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("n"), F.min("site").alias("low"), F.max("site").alias("high"),
                 F.min("key").alias("first_key"))
            .where((F.col("n") >= min_sites) & ((F.col("low") != F.col("high")) | F.lit(min_sites <= 1)))
            .select("h1", "h2", "first_key"))
    sites = lines.select("h1", "h2", "site").distinct().join(able.select("h1", "h2"), ["h1", "h2"], "left_semi")
    estimate = (sites.groupBy("h1", "h2")
                .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_LG_K)).alias("estimate")))
    margin = max(1.0, SKETCH_ERROR * min_sites)
    near = estimate.where(F.abs(F.col("estimate") - F.lit(min_sites)) <= margin).select("h1", "h2")
    exact = (sites.join(near, ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites))
    sure = estimate.where(F.col("estimate") > min_sites + margin)
    spread = sure.select("h1", "h2").unionByName(exact.select("h1", "h2"))
    return able.join(spread, ["h1", "h2"], "left_semi")


def remove_lines(df: DataFrame, key: str = "doc_id", site: str = "source", text: str = "text",
                 min_sites: int = MIN_SITES, blanks: str = " ") -> DataFrame:
    """``df`` with boilerplate lines removed from ``text``, and the columns
    lines (before) and removed_lines."""
    found = boilerplate(df, key, site, text, min_sites, blanks)
    drop = (_lines(df, key, site, text, blanks).join(found, ["h1", "h2"])
            .where(~F.col("key").eqNullSafe(F.col("first_key")))
            .groupBy("key", "text_hash").agg(F.collect_set("pos").alias("gone"))
            .select(F.col("key").alias("__key"), F.col("text_hash").alias("__hash"), F.col("gone").alias("__gone")))
    columns = [c for c in df.columns if c not in ("lines", "removed_lines")]
    out = (df.select(*columns)
           .join(drop, F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__hash")), "left")
           .withColumn("__parts", F.split(text, "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__parts") - 1), "__gone")  # by hash: linear in the lines
    kept = F.array_join(F.transform(stay, lambda i: F.get("__parts", i)), "\n")
    return out.select(
        *[F.when(F.col("__gone").isNull(), F.col(c)).otherwise(kept).alias(c) if c == text else F.col(c) for c in columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size("__parts")).cast("long").alias("lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("removed_lines"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that other sites share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return remove_lines(docs).select("doc_id", "lines", "removed_lines", "text")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: boilerplate lines of any length go; a document goes if
    nothing but blanks is left of it by that."""
    out = remove_lines(docs, blanks=WHITE)
    left = (F.col("removed_lines") == 0) | (F.length(F.btrim("text", F.lit(WHITE + "\n"))) > 0)
    return out.where(left).select(
        *[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


SQL = f"""
WITH parts AS (
  SELECT doc_id, coalesce(source, '') AS site, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL
), numbered AS (
  SELECT doc_id, site, unnest(p) AS line, unnest(range(len(p))) AS pos FROM parts
), spread AS (
  SELECT trim(line) AS t, min(doc_id) AS first_key FROM numbered
  WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT site) >= {MIN_SITES}
), marked AS (
  SELECT n.doc_id, n.line, n.pos, s.t IS NOT NULL AND n.doc_id IS DISTINCT FROM s.first_key AS gone
  FROM numbered n LEFT JOIN spread s ON trim(n.line) = s.t
), merged AS (
  SELECT doc_id, count(*) AS lines, count(*) FILTER (gone) AS removed_lines,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(m.lines, 0) AS lines, coalesce(m.removed_lines, 0) AS removed_lines, m.text
FROM documents d LEFT JOIN merged m ON d.doc_id = m.doc_id
"""
