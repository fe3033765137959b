"""Term extraction with real Hangul rows, tagger hook, duplicate reports
(I10-I13, L2, C9, D14-D19, D21, D22, F2, F4)."""

from pyspark.sql import functions as F

from conftest import rows
from hirelake.operators import quality, tagger, terms


def _lexicon(spark, words):
    return spark.createDataFrame([(w,) for w in words], "term string")


def test_korean_nouns(spark):
    # particles after nouns are letters that no lexicon word covers
    lex = _lexicon(spark, ["데이터", "데이터엔지니어", "경험", "우대", "Spark"])
    df = spark.createDataFrame([
        (1, "데이터엔지니어는 Spark 경험을 우대합니다"),
        (2, "데이터를 다루는 경험"),
        (3, "   "),
        (4, None),
        (5, "모르는 단어만"),
    ], "id int, txt string")
    out = terms.lexicon_terms(df, ["txt"], lex, terms.KOREAN_PATTERN, name=lambda c: "nouns")
    got = dict(rows(out.select("id", "nouns")))
    assert got[1] == ["데이터엔지니어", "경험", "우대"]  # Latin token not in the Hangul script class
    assert got[2] == ["데이터", "경험"]
    assert got[3] == [] and got[4] == [] and got[5] == []
    # the content-hash key path gives the same arrays as a unique key
    keyed = terms.lexicon_terms(df, ["txt"], lex, terms.KOREAN_PATTERN, name=lambda c: "nouns", key=["id"])
    assert rows(keyed.select("id", "nouns")) == rows(out.select("id", "nouns"))


def test_add_term_columns_and_tables(spark):
    lex = _lexicon(spark, ["복지", "식대", "연봉"])
    df = spark.createDataFrame([
        ("1", "wanted", "Python 개발", "식대 지원 복지는 좋음", "연봉협상 Java"),
        ("1", "wanted", "Python 개발", "식대 지원 복지는 좋음", "연봉협상 Java"),  # exact duplicate row
        ("2", "jumpit", None, "", "C++ 우대"),
    ], "job_id string, platform string, preferred string, welfare string, required string")
    out = terms.add_term_columns(df, lex, ["preferred", "welfare", "required"])
    assert out.count() == 3
    r = out.where("job_id = '1'").first()
    assert r.welfare_korean_nouns == ["식대", "복지"] and r.required_korean_nouns == ["연봉"]
    assert r.preferred_english_nouns == ["Python"] and r.required_english_nouns == ["Java"]
    r2 = out.where("job_id = '2'").first()
    assert r2.preferred_korean_nouns == [] and r2.welfare_english_nouns == [] and r2.required_english_nouns == ["C"]
    # term tables (I2-I9) equal unnesting the arrays
    t = terms.lexicon_term_table(df, "welfare", "w", lex)
    assert rows(t) == [("1", "wanted", "복지"), ("1", "wanted", "식대")]
    e = terms.latin_term_table(df, "required", "r")
    assert rows(e) == [("1", "wanted", "Java"), ("2", "jumpit", "C")]


def test_compounds_have_all_their_nouns(spark):
    lex = _lexicon(spark, ["서버", "개발", "개발자", "자", "데이터"])
    df = spark.createDataFrame([(1, "서버개발자를 찾는 데이터서버개발"), (2, "버서")], "id int, txt string")
    out = terms.lexicon_terms(df, ["txt"], lex, name=lambda c: "nouns")
    assert dict(rows(out.select("id", "nouns"))) == {1: ["서버", "개발자", "데이터", "서버", "개발"], 2: []}
    # a dear word gives way to two cheap ones
    priced = spark.createDataFrame([("서버", 1), ("개발", 1), ("개발자", 9), ("자", 1), ("개발자", 8)], "term string, cost int")
    out = terms.lexicon_terms(df, ["txt"], priced, name=lambda c: "nouns")
    assert dict(rows(out.select("id", "nouns")))[1] == ["서버", "개발", "자", "서버", "개발"]


def test_very_long_token(spark):
    lex = _lexicon(spark, ["가나", "나다", "가나다라마"])
    df = spark.createDataFrame([(1, "가나다" * 2000)], "id int, txt string")
    out = terms.lexicon_terms(df, ["txt"], lex, name=lambda c: "nouns").first()["nouns"]
    assert len(out) == 2000 and set(out) <= {"가나", "나다"}


def test_tagger_hook(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None), (3, " ")], "id int, txt string")
    out = tagger.tagger_terms(df, ["txt"], lambda: (lambda s: s.split()[:2]), name=lambda c: "t")
    assert rows(out.select("id", "t")) == [(1, ["a", "b"]), (2, []), (3, [])]


def test_duplicates_null_safe(spark):
    df = spark.createDataFrame([
        ("1", "A"), ("1", "A"), ("1", "B"), ("2", None), ("2", None), ("3", "C"), (None, "D"), (None, "E"),
    ], "job_id string, company string")
    assert rows(quality.repeated_keys(df, ["job_id"])) == [(None, 2), ("1", 3), ("2", 2)]  # D14
    d15 = quality.duplicate_rows(df, ["job_id"])
    assert d15.count() == 7  # NULL ids form one key, like pandas duplicated(keep=False)
    d16 = quality.duplicate_rows(df, ["job_id", "company"])
    assert rows(d16) == [("1", "A"), ("1", "A"), ("2", None), ("2", None)]
    s = quality.duplicate_summary(df).first().asDict()  # D17
    assert s == {"total_rows": 8, "dup_rows": 7, "dup_pair_rows": 4, "dup_count_half": 3,
                 "net_postings_half": 5, "keys_agree": False, "removable_rows": 4, "net_postings": 4}


def test_dedupe_first_hot_key(spark):
    # One key holds most rows; min_by keeps the first by the explicit order
    hot = spark.range(0, 5000).select(F.lit("hot").alias("k"), (5000 - F.col("id")).alias("o"),
                                      F.col("id").cast("string").alias("v"))
    cold = spark.createDataFrame([("cold", 7, "x"), ("cold", 3, "y")], "k string, o long, v string")
    out = quality.dedupe_first(hot.unionByName(cold), ["k"], ["o"])
    assert rows(out) == [("cold", 3, "y"), ("hot", 1, "4999")]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_semi_sort_preview_profile(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, None), (10, "b")], "k long, v string")
    keys = spark.createDataFrame([(1,), (10,), (99,)], "k long")
    assert rows(quality.semi_on(df, keys, ["k"])) == [(1, "a"), (10, "b")]  # C9
    assert [r.k for r in quality.sort_by(df, ["k"], as_string=True).collect()] == [1, 10, 2, 3]  # F2
    assert [r.k for r in quality.preview(df, 2, ["k"], descending=True).collect()] == [10, 3]  # F4
    prof = {r.column: r for r in quality.profile(df).collect()}  # D21
    assert prof["k"]["count"] == 4 and prof["k"].min == "1" and prof["k"].max == "10" and prof["k"].mean == 4.0
    assert prof["v"].nulls == 1 and prof["v"].mean is None
    assert df.count() == 4 and df.rdd.getNumPartitions() >= 1 and "k" in df.schema.simpleString()  # D22


def test_exact_quartiles(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    cases = {"wide": [float(x) for x in rng.standard_normal(997) * 10.0 ** rng.integers(-200, 200, 997)], "ties": [1.0, 2.0, 2.0, 2.0, 9.0] * 40,
             "near": [1.0 + i * 2.0 ** -50 for i in range(300)], "one": [5.0], "signs": [-3.0, 0.0, -0.5, 7.0]}
    for name, vals in cases.items():
        df = spark.createDataFrame([(v, None) for v in vals] + [(None, None)], "v double, w int")
        got = quality.exact_quantiles(df, ["v", "w"], (0.25, 0.5, 0.75, 1.0)).collect()
        assert [r["column"] for r in got] == ["v"], name
        assert np.allclose(got[0]["quantiles"], np.quantile(vals, [0.25, 0.5, 0.75, 1.0]), rtol=1e-12, atol=0), name


def test_positions_of_sorted_rows(spark):
    from hirelake.operators.order import with_position
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(9).orderBy(F.desc("x"))
    got = with_position(df).collect()
    assert sorted((r.position, r.x) for r in got) == [(i + 1, 4999 - i) for i in range(5000)]
    assert with_position(df.where("x < 0")).collect() == []


def test_dedupe_by_row_id(spark):
    df = spark.createDataFrame([(5, "a", "x"), (3, "a", "y"), (4, None, "z"), (6, None, "w")], "id long, k string, v string")
    out = quality.dedupe_first(df, ["k"], ["id"], row_id="id")
    assert rows(out) == [(3, "a", "y"), (4, None, "z")]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_noun_arrays_of_two_columns(spark):
    lex = _lexicon(spark, ["데이터", "데이터엔지니어", "경험", "우대"])
    df = spark.createDataFrame([(1, "데이터엔지니어는 경험을 우대", "데이터 데이터"), (2, None, "경험")],
                               "id int, a string, b string")
    one = terms.lexicon_terms(df, ["a", "b"], lex, terms.KOREAN_PATTERN)
    assert rows(one)[0][3:] == (["데이터엔지니어", "경험", "우대"], ["데이터", "데이터"])


def test_words_of_a_token_are_walked_once(spark):
    # one pass in a small helper, not an interpreted fold that copies its state at every word
    lex = _lexicon(spark, ["가", "나", "가나", "나가"])
    toks = spark.createDataFrame([(1, "가나" * 1500), (2, "다")], "i int, tok string")
    out = terms.segment(toks, lex, ["i"])
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.i, r.nouns) for r in out.collect()] == [(1, ["가나"] * 1500)]
    # of equal gain the greatest list; a word whose cost is unknown is none
    priced = spark.createDataFrame([("가", 0), ("가나", 1), ("나", 1), ("나다", None)], "term string, cost int")
    toks = spark.createDataFrame([(1, "가나다"), (2, "나다")], "i int, tok string")
    assert {r.i: r.nouns for r in terms.segment(toks, priced, ["i"]).collect()} == {1: ["가나"], 2: ["나"]}


def test_noun_arrays_over_batches_and_repeated_keys(spark):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    lex = _lexicon(spark, ["데이터", "경험", "우대"])
    df = spark.createDataFrame([(1, None, "데이터 경험 " * 4), (1, None, "데이터 경험 " * 4), (1, "x", "우대"), (None, None, "경험"),
                                (2, "x", "데이터"), (2, "x", "우대 경험")], "id int, part string, txt string")
    try:
        spark.conf.set(size, "3")
        out = terms.lexicon_terms(df, ["txt"], lex, name=lambda c: "nouns", key=["id", "part"])
        got = rows(out.select("id", "part", "nouns"))
    finally:
        spark.conf.set(size, old)
    both = ["데이터", "우대", "경험"]  # rows that share a key share their nouns, by place and word
    assert got == sorted([(1, None, ["데이터", "경험"] * 4)] * 2 + [(1, "x", ["우대"]), (None, None, ["경험"])] + [(2, "x", both)] * 2,
                         key=lambda r: tuple("" if v is None else str(v) for v in r))


def test_term_table_collapses_texts_before_tokens(spark):
    lex = _lexicon(spark, ["복지", "식대"])
    df = spark.createDataFrame([("1", "wanted", "식대 복지 식대")] * 3 + [("1", "wanted", "식대"), (None, None, "복지"), ("2", "jumpit", None)],
                               "job_id string, platform string, welfare string")
    out = terms.lexicon_term_table(df, "welfare", "w", lex)
    assert rows(out) == [(None, None, "복지"), ("1", "wanted", "복지"), ("1", "wanted", "식대")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # no table of distinct tokens of every posting: only of texts, of nouns and of the vocabulary
    assert not any("Aggregate [job_id" in line and "tok" in line for line in plan.splitlines())
