"""Mixing sources to target weights: hierarchical token budgets.

The leaves of a domain - language - source tree hold the documents. A token
budget flows from the root: at every node it is shared among the children by
their weights; a child that holds less than its share (its documents' tokens,
at most ``epochs`` times) gets all it holds, and what it leaves goes to its
siblings. Only a node whose children are all exhausted leaves something to its
own siblings, as its holding is the sum of theirs. Shares are whole tokens,
rounded down.

A leaf's budget buys whole epochs and then a prefix of one more: its documents
in the order of md5(seed | epoch | key), the last one cut to the tokens that
are left. Where the prefix ends is found by counting, not sorting: three times
the leaf's current bucket is split by the next byte of the hash into 256, token
sums are taken per bucket, and the bucket with the end is kept; only documents
in the last bucket (a 16-millionth of the leaf) are sorted. So a leaf with a
third of all documents costs no large task, and texts are never shuffled
beyond that bucket.

Tokens are runs of characters other than white space. Defined cases: null tree
values are the value ''; documents without tokens (null, empty, blank) are
never selected; weights of 0 or missing from the mapping: ``default``; an empty
table gives no rows; repeated rows are selected one by one; columns epoch,
n_tokens and take_tokens of the input are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

LEVELS = ("domain", "lang", "source")
SEED = "mix-1"
#: Tokens to take, as a share of all tokens (numerator, denominator).
BUDGET = (1, 1)
EPOCHS = 2
#: Weights by path from the root; a path that is missing has weight 1.
WEIGHTS = {
    ("web",): 5, ("books",): 3, ("forums",): 2,
    **{(d, lang): w for d in ("web", "books", "forums") for lang, w in (("en", 4), ("de", 2), ("fr", 2), ("es", 2))},
}


def domain() -> Column:
    """The domain of a source: a rule on its number."""
    number = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "([0-9]{1,9})$", 1)
    return (F.when(number == "", "other")
            .otherwise(F.element_at(F.array(*map(F.lit, ("web", "books", "forums"))),
                                    F.when(number == "", 0).otherwise(number.cast("int")) % 3 + 1)))


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Budgets of sibling nodes (parent columns, cap, weight, budget of the
    parent): water-filling in whole tokens, by windows over siblings."""
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parent).orderBy("ratio", "node")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (nodes.withColumn("ratio", ratio)
            .withColumn("before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
            .withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("full", F.col("cap") * F.col("rest") <= F.col("weight") * (F.col("budget") - F.col("before"))))
    first = lambda c: F.first(F.when(~F.col("full"), F.col(c)), ignorenulls=True).over(every)
    rows = rows.withColumn("open_budget", F.col("budget") - first("before")).withColumn("open_weight", first("rest"))
    share = F.expr("CASE WHEN full THEN cap WHEN open_weight > 0 THEN (weight * open_budget) div open_weight ELSE 0L END")
    return rows.withColumn("share", F.greatest(share, F.lit(0).cast("long")))


def _weight(path: list[str], weights: dict[tuple, int], default: int) -> Column:
    """Weight of the node at ``path`` (columns), from the mapping."""
    own = {k: w for k, w in weights.items() if len(k) == len(path)}
    if not own:
        return F.lit(default).cast("long")
    key = F.to_json(F.array(*path))
    import json

    entries = [F.lit(x) for k, w in own.items() for x in (json.dumps(list(k), separators=(",", ":"), ensure_ascii=False), int(w))]
    lookup = F.create_map(*entries)
    return F.coalesce(F.element_at(lookup, key), F.lit(default)).cast("long")


def budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple, int], budget: tuple[int, int],
            epochs: int, default: int = 1) -> DataFrame:
    """``levels``, supply, share (tokens) of every leaf, from its supply."""
    leaves = leaves.withColumn("cap", F.col("supply") * epochs)
    given = (leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("s"))
             .select(F.expr(f"(s * {int(budget[0])}L) div {int(budget[1])}L").alias("budget"), F.lit(1).alias("root")))
    parents, above = given, ["root"]
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = (leaves.withColumn("root", F.lit(1)).groupBy("root", *path)
                 .agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
                 .withColumn("node", F.col(path[-1])).withColumn("weight", _weight(path, weights, default)))
        rows = _share(nodes.join(parents, above), above)
        above = ["root", *path]
        parents = rows.select(*above, F.col("share").alias("budget"))
        last = rows
    return last.select(*levels, "supply", "share")


def mix(df: DataFrame, levels: dict[str, Column], key: str = "doc_id", text: str = "text",
        weights: dict[tuple, int] | None = None, budget: tuple[int, int] = BUDGET, epochs: int = EPOCHS,
        seed: str = SEED) -> DataFrame:
    """The selected rows of ``df``, once for each epoch that takes them:
    its columns, the tree's ``levels`` that are not among them, epoch, n_tokens and take_tokens; the
    last document of a leaf's prefix has its text cut to take_tokens."""
    names, own = list(levels), {"epoch", "n_tokens", "take_tokens"}
    tree = [f"__{n}" for n in names]
    rows = df.select(
        *[c for c in df.columns if c not in own],
        *[F.coalesce(c.cast("string"), F.lit("")).alias(t) for t, c in zip(tree, levels.values())],
        F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long").alias("n_tokens")).where("n_tokens > 0")
    narrow = materialize(rows.select(F.col(key).cast("string").alias("key"), *tree, "n_tokens"), "mix-sizes")
    shares = budgets(narrow.groupBy(*tree).agg(F.sum("n_tokens").alias("supply")), tree, weights or {}, budget, epochs)
    plan = shares.select(*tree, F.expr("share div supply").alias("__whole"), F.expr("share % supply").alias("__left"),
                         F.lit("").alias("__cut"))
    plan = materialize(plan, "mix-plan")

    def hashed(r: DataFrame, k: Column) -> DataFrame:
        # The epoch of the prefix is the one after the whole ones.
        return r.withColumn("__hash", F.md5(F.concat_ws("|", F.lit(seed), F.col("__whole").cast("string"),
                                                        F.coalesce(k.cast("string"), F.lit("")))))

    for depth in (2, 4, 6):
        inside = hashed(narrow.join(plan, tree), F.col("key")).where(
            (F.col("__left") > 0) & F.col("__hash").startswith(F.col("__cut")))
        sums = (inside.withColumn("__bucket", F.substring("__hash", 1, depth))
                .groupBy(*tree, "__bucket").agg(F.sum("n_tokens").alias("__tokens"), F.max("__left").alias("__left")))
        order = Window.partitionBy(*tree).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
        ends = (sums.withColumn("__upto", F.sum("__tokens").over(order))
                .where((F.col("__upto") > F.col("__left")) & (F.col("__upto") - F.col("__tokens") <= F.col("__left")))
                .select(*tree, F.col("__bucket").alias("at"), (F.col("__upto") - F.col("__tokens")).alias("spent")))
        plan = (plan.join(ends, tree, "left")
                .select(*tree, "__whole", F.col("__left") - F.coalesce("spent", F.lit(0)).alias("__left"),
                        F.coalesce("at", "__cut").alias("__cut")))
        plan = materialize(plan.toDF(*tree, "__whole", "__left", "__cut"), "mix-plan")

    # A leaf without a prefix has an empty cut; else documents below the cut are whole, those in it are counted off.
    placed = hashed(rows.join(plan, tree), F.col(key))
    bucket = F.substring("__hash", 1, 6)
    n_epochs = F.col("__whole") + F.when((F.col("__cut") != "") & (bucket < F.col("__cut")), 1).otherwise(0)
    whole = (placed.withColumn("epoch", F.explode(F.expr("sequence(0L, greatest(__whole, 1L))")))
             .where(F.col("epoch") < n_epochs).withColumn("take_tokens", F.col("n_tokens")))
    order = Window.partitionBy(*tree).orderBy("__hash", key).rowsBetween(Window.unboundedPreceding, 0)
    edge = (placed.where((F.col("__cut") != "") & (bucket == F.col("__cut")))
            .withColumn("__upto", F.sum("n_tokens").over(order))
            .withColumn("take_tokens", F.least("n_tokens", F.col("__left") - F.col("__upto") + F.col("n_tokens")))
            .where("take_tokens > 0").withColumn("epoch", F.col("__whole")))
    chunks = F.split(text, r"(?<=\S)(?=\s)", -1)  # white space and a token each
    prefix = F.array_join(F.slice(chunks, F.lit(1), F.col("take_tokens").cast("int")), "")
    edge = edge.withColumn(text, F.when(F.col("take_tokens") < F.col("n_tokens"), prefix).otherwise(F.col(text)))
    keep = [c for c in df.columns if c not in own]
    added = [F.col(t).alias(n) for t, n in zip(tree, names) if n not in keep]
    out = [*keep, *added, "epoch", "n_tokens", "take_tokens"]
    return whole.select(*out).unionByName(edge.select(*out))


def _levels() -> dict[str, Column]:
    return {"domain": domain(), "lang": F.col("lang"), "source": F.col("source")}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents, and how many tokens of each, make up the mix."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, _levels(), weights=WEIGHTS).select(
        "doc_id", "domain", "lang", "source", "epoch", "n_tokens", "take_tokens")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: nine tenths of the tokens, to the weights, each
    document at most once; the last of a source is cut."""
    out = mix(docs, _levels(), weights=WEIGHTS, budget=(9, 10), epochs=1)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def _sql_weight(depth: int) -> str:
    rows = [(k, w) for k, w in WEIGHTS.items() if len(k) == depth]
    cases = " ".join("WHEN " + " AND ".join(f"l{i} = '{v}'" for i, v in enumerate(k)) + f" THEN {w}" for k, w in rows)
    return f"CASE {cases} ELSE 1 END" if rows else "1"


def _sql_level(depth: int) -> str:
    """Shares of the nodes at ``depth``, from those above."""
    path = ", ".join(f"l{i}" for i in range(depth))
    above = ", ".join(f"l{i}" for i in range(depth - 1))
    join = "JOIN s{0} p ON ".format(depth - 1) + " AND ".join(f"n.l{i} = p.l{i}" for i in range(depth - 1)) if depth > 1 else ", total p"
    part = f"PARTITION BY {above} " if above else ""
    return f"""
n{depth} AS (SELECT n.*, p.share AS budget FROM (SELECT {path}, sum(supply) * {EPOCHS} AS cap, {_sql_weight(depth)} AS weight
  FROM leaf GROUP BY {path}) n {join}),
o{depth} AS (SELECT *, sum(cap) OVER ({part}ORDER BY cap / weight, l{depth - 1} ROWS UNBOUNDED PRECEDING) - cap AS prior,
  sum(weight) OVER ({part}ORDER BY cap / weight, l{depth - 1} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM n{depth}),
f{depth} AS (SELECT *, cap * rest <= weight * (budget - prior) AS whole FROM o{depth}),
g{depth} AS (SELECT *, min(CASE WHEN NOT whole THEN prior END) OVER ({part.strip()}) AS k,
  max(CASE WHEN NOT whole THEN rest END) OVER ({part.strip()}) AS w FROM f{depth}),
s{depth} AS (SELECT {path}, CAST(CASE WHEN whole THEN cap ELSE (weight * (budget - k)) // w END AS BIGINT) AS share FROM g{depth})"""


SQL = f"""
WITH docs AS (
  SELECT doc_id, lang, source, regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS number,
         CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) AS n_tokens FROM documents
), tree AS (
  SELECT doc_id, lang, source, n_tokens, coalesce(lang, '') AS l1, coalesce(source, '') AS l2,
         CASE WHEN number = '' THEN 'other' ELSE ['web', 'books', 'forums'][CAST(number AS INTEGER) % 3 + 1] END AS l0
  FROM docs WHERE n_tokens > 0
), leaf AS (SELECT l0, l1, l2, sum(n_tokens) AS supply FROM tree GROUP BY ALL),
total AS (SELECT sum(supply) * {BUDGET[0]} // {BUDGET[1]} AS share FROM leaf),{",".join(_sql_level(d) for d in (1, 2, 3))},
plan AS (SELECT leaf.*, share // supply AS whole, share % supply AS rem FROM leaf JOIN s3 USING (l0, l1, l2)),
placed AS (
  SELECT t.*, whole, rem, md5(concat_ws('|', '{SEED}', CAST(whole AS VARCHAR), CAST(doc_id AS VARCHAR))) AS h
  FROM tree t JOIN plan p USING (l0, l1, l2)
), counted AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY l0, l1, l2 ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM placed
)
SELECT doc_id, l0 AS domain, lang, source, CAST(epoch AS BIGINT) AS epoch, n_tokens,
       CAST(CASE WHEN epoch < whole THEN n_tokens ELSE least(n_tokens, rem - upto + n_tokens) END AS BIGINT) AS take_tokens
FROM (SELECT *, unnest(range(CAST(whole AS BIGINT) + 1)) AS epoch FROM counted)
WHERE epoch < whole OR rem - upto + n_tokens > 0
"""
