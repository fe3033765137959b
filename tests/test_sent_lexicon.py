"""Term arrays and term tables with the lexicon sent to the tasks: no
occurrence is shuffled, and the rows are those of the joins."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hirelake.operators import marts, terms
from hirelake.operators._util import broadcast_limit
from hirelake.plans import queries

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture()
def limited(spark):
    """run(limit, build) -> rows of a frame built and run under a broadcast limit."""
    old = spark.conf.get(LIMIT)

    def run(limit, build):
        spark.conf.set(LIMIT, limit)
        return rows(build())

    yield run
    spark.conf.set(LIMIT, old)


def _ran(df):
    """The plan that ran, without the one it began as."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan[:plan.index("\n+- == Initial Plan ==")]


def _lexicon(spark, words):
    return spark.createDataFrame([(w, c) for w, c in words], "term string, cost int")


ODD = [(1, None, "데이터엔지니어는 경험을 우대", "데이터 데이터"), (1, None, "데이터엔지니어는 경험을 우대", "데이터 데이터"), (None, "x", None, ""),
       (None, "y", "  ", "없는 말"), (2, "x", "가나" * 900, "경험"), (3, "z", "데이터", None)]
WORDS = [("데이터", 1), ("데이터엔지니어", 9), ("엔지니어", 1), ("경험", 1), ("우대", 2), ("우대", 1), ("가", 0), ("가나", 1), ("말", None)]


def test_limit_as_sessions_write_it(spark, limited):  # limited puts the limit back
    for text, n in (("-1", -1), ("4096", 4096), ("256k", 262144), ("64m", 1 << 26), ("10485760b", 10485760), ("1GB", 1 << 30)):
        spark.conf.set(LIMIT, text)
        assert broadcast_limit(spark) == n


def test_k2_arrays_of_sent_and_joined_lexicons_agree(spark, limited, sf_small):
    # occurrences and arrays of nouns were shuffled, several times the input
    df = spark.createDataFrame(ODD, "id int, k string, a string, b string").repartition(3)
    lex = _lexicon(spark, WORDS)
    build = lambda: terms.lexicon_terms(df, ["a", "b"], lex)
    sent, joined, too_large = (limited(n, build) for n in ("10m", "-1", "40"))
    assert sent == joined == too_large
    assert [r[4:] for r in sent if r[0] == 1] == [(["데이터", "엔지니어", "경험", "우대"], ["데이터", "데이터"])] * 2
    assert [r[4:] for r in sent if r[0] is None] == [([], []), ([], [])]
    spark.conf.set(LIMIT, "10m")
    out = queries.QUERIES["k2_second_stage"](spark, sf_small)
    assert len(out.collect()) > 0
    assert "hashpartitioning(tok" not in _ran(out) and "hashpartitioning(_rk" not in _ran(out)


def test_i13_arrays_need_no_shuffle_of_rows(spark, limited, sf_small):
    # five columns, their tokens and arrays went through three shuffles
    spark.conf.set(LIMIT, "10m")
    out = queries.QUERIES["i13_eda_terms"](spark, sf_small)
    assert len(out.collect()) > 0
    assert "hashpartitioning(tok" not in _ran(out) and "hashpartitioning(_rk" not in _ran(out)


def test_i11_keys_decide_at_run_time(spark, limited):
    # a unique key's texts stay where they are read; rows that share a key share their nouns as before
    lex = _lexicon(spark, WORDS)
    spark.conf.set(LIMIT, "10m")
    one = spark.createDataFrame([(1, "데이터 경험"), (2, None), (None, "우대"), (None, "우대")], "id int, txt string").repartition(2)
    out = terms.lexicon_terms(one, ["txt"], lex, name=lambda c: "nouns", key=["id"]).select("id", "nouns")
    assert rows(out) == [(None, ["우대"]), (None, ["우대"]), (1, ["데이터", "경험"]), (2, [])]
    assert "hashpartitioning(tok" not in _ran(out)
    for other in ("우대", None, ""):
        many = one.unionByName(spark.createDataFrame([(2, other), (2, "경험")], "id int, txt string"))
        build = lambda: terms.lexicon_terms(many, ["txt"], lex, name=lambda c: "nouns", key=["id"]).select("id", "nouns")
        assert limited("10m", build) == limited("-1", build)


POSTS = [("1", "wanted", "식대 복지 식대\x1f지원"), ("1", "wanted", "식대 복지 식대\x1f지원"), ("1", "wanted", "연봉 식대"), ("1", "jumpit", "복지"),
         (None, None, "복지"), (None, "wanted", "복지"), (None, "wanted", "복지"), ("2", "jumpit", None), ("3", "jumpit", "없는 말"), ("4", None, "")]


def test_k3_term_tables_shuffle_several_terms_a_row(spark, limited):
    # texts, tokens and single terms were shuffled, several times the input
    df = spark.createDataFrame(POSTS, "job_id string, platform string, welfare string").repartition(3)
    lex = _lexicon(spark, [(w, 1) for w in ("식대", "복지", "연봉", "식대\x1f지원", "지원")])
    build = lambda: terms.lexicon_term_table(df, "welfare", "w", lex, "[^ ]+")
    sent, joined, too_large = (limited(n, build) for n in ("10m", "-1", "40"))
    assert sent == joined == too_large
    assert [r[2] for r in sent if r[:2] == ("1", "wanted")] == ["복지", "식대", "식대\x1f지원", "연봉"] and len(sent) == 7
    spark.conf.set(LIMIT, "10m")
    latin = df.select("job_id", "platform", F.translate("welfare", "식복연", "sbP").alias("welfare"))
    for out, n in ((terms.lexicon_term_table(df, "welfare", "w", lex, "[^ ]+"), 7), (terms.latin_term_table(latin, "welfare", "w"), 6)):
        assert len(out.collect()) == n
        dealt = re.findall(r"Exchange hashpartitioning\(([^\n]*)", _ran(out))
        mine = [x for x in dealt if "job_id" in x]
        assert len(mine) == 1 and "_part" in mine[0] and not re.search(r"\bw#", mine[0])


def test_k3_parts_of_many_batches_meet(spark):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    letters = F.translate((F.col("id") % 500).cast("string"), "0123456789", "abcdefghij")
    df = spark.range(4000).select((F.col("id") % 3).cast("string").alias("job_id"), F.lit("jumpit").alias("platform"),
                                  F.concat_ws(" ", F.lit("all"), letters, letters).alias("welfare")).repartition(7)
    try:
        spark.conf.set(size, "13")
        got = rows(terms.latin_term_table(df, "welfare", "w"))
    finally:
        spark.conf.set(size, old)
    want = {(str(i % 3), "jumpit", w) for i in range(4000) for w in ("all", str(i % 500).translate(str.maketrans("0123456789", "abcdefghij")))}
    assert got == sorted(want)


def test_k4_joins_take_several_terms_a_row(spark):
    # every (posting, term) row was shuffled once more for the join
    jds = spark.createDataFrame([("wanted", "1", "a"), ("wanted", "1", "b"), ("jumpit", "2", "a"), ("jumpit", None, "a"), (None, "1", "a"), ("jumpit", "9", "a")],
                                "platform string, job_id string, major_category string").selectExpr("*", "'m' middle_category", "'s' sub_category")
    table = spark.createDataFrame([("wanted", "1", "x"), ("wanted", "1", "x"), ("wanted", "1", ""), ("wanted", "1", None), ("wanted", "1", "p\x1fq"), ("jumpit", "2", "y"),
                                   ("jumpit", None, "y"), (None, "1", "y"), ("rallit", "9", "y")], "platform string, job_id string, t string").coalesce(1)
    out = marts.posting_terms(jds, table, "t", "term")
    want = jds.join(table, ["platform", "job_id"]).select(*out.columns[:-1], F.col("t").alias("term"))
    assert rows(out) == rows(want) and len(rows(out)) == 11
    # a posting's terms share a row of what is joined: one of the plain terms, one for NULL and one for a term with the separator
    assert marts.packed(table.where("platform = 'wanted'"), marts.JOIN_KEYS, "t").count() == 3
