"""Property tests: operators against brute-force Python on random inputs."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hirelake.functions import dates as fd
from hirelake.functions import geo as fg
from hirelake.operators import quality, terms

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

tokens = st.sampled_from(["주소", "주소지", "서울", "부산광역시", "강남구", "a", "경기", " ", "\t"])
addresses = st.one_of(st.none(), st.lists(tokens, max_size=5).map(lambda xs: " ".join(xs)))


def py_sido(location):
    if not location or not location.split():
        return None
    parts = location.split()
    if parts[0].startswith("주소"):
        return parts[1][:2] if len(parts) > 1 else None
    return parts[0][:2]


def py_gugun(location):
    if not location or not location.split():
        return None
    parts = location.split()
    if parts[0].startswith("주소"):
        return parts[2][:2] if len(parts) > 2 else None
    return parts[1][:2] if len(parts) > 1 else None


@SETTINGS
@given(st.lists(addresses, min_size=1, max_size=12))
def test_address_parts_match_python(spark, locs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(locs)], "i int, loc string")
    got = {r.i: (r.s, r.g) for r in df.select("i", fg.sido("loc").alias("s"), fg.gugun("loc").alias("g")).collect()}
    assert got == {i: (py_sido(v), py_gugun(v)) for i, v in enumerate(locs)}


words = st.text(alphabet="가나다라", min_size=1, max_size=6)


@SETTINGS
@given(st.lists(words, min_size=1, max_size=15), st.lists(words, min_size=0, max_size=8))
def test_segmentation_matches_brute_force(spark, toks, lexicon):
    def best(tok):
        """Greatest (gain, words) over all segmentations."""
        if not tok:
            return 0, []
        v, w = best(tok[1:])
        found = [(v, w)]  # an unknown letter
        for n in {len(x) for x in lexicon if tok.startswith(x)}:
            v, w = best(tok[n:])
            found.append((v + 2 * n - 1, [tok[:n], *w]))
        return max(found)

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(toks)], "i int, tok string")
    lex = spark.createDataFrame([(w,) for w in lexicon], "term string")
    got = {r.i: r.nouns for r in terms.segment(rows, lex, ["i"]).collect()}
    assert got == {i: w for i, t in enumerate(toks) if (w := best(t)[1])}


keys = st.one_of(st.none(), st.sampled_from(["1", "2", "3"]))


@SETTINGS
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.sampled_from(["A", "B"]))), min_size=1, max_size=20))
def test_duplicate_summary_matches_pandas(spark, pairs):
    df = spark.createDataFrame(pairs, "job_id string, company string")
    pdf = pd.DataFrame(pairs, columns=["job_id", "company"])
    dup = pdf[pdf.duplicated("job_id", keep=False)]
    dup2 = pdf[pdf.duplicated(["job_id", "company"], keep=False)]
    s = quality.duplicate_summary(df).first()
    assert (s.total_rows, s.dup_rows, s.dup_pair_rows) == (len(pdf), len(dup), len(dup2))
    assert s.dup_count_half == len(dup) // 2 and s.net_postings_half == len(pdf) - len(dup) // 2
    assert s.net_postings == len(pdf.drop_duplicates("job_id"))
    assert quality.duplicate_rows(df, ["job_id"]).count() == len(dup)
    assert quality.duplicate_rows(df, ["job_id", "company"]).count() == len(dup2)


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10**7), min_size=1, max_size=10))
def test_hms_matches_divmod(spark, secs):
    df = spark.createDataFrame([(s,) for s in secs], "s long")
    got = [r[0] for r in df.select(fd.hms("s")).collect()]
    want = []
    for s in secs:
        h, rem = divmod(s, 3600)
        m, sec = divmod(rem, 60)
        want.append(f"{h}h {m}m {sec}s")
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50), st.integers(0, 9)),
                min_size=1, max_size=30))
def test_dedupe_first_matches_pandas(spark, data):
    df = spark.createDataFrame(data, "k string, o long, v long")
    got = sorted(tuple(r) for r in quality.dedupe_first(df, ["k"], ["o"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "o", "v"]).sort_values(["k", "o", "v"])
    want = sorted(tuple(int(x) if not isinstance(x, str) else x for x in r)
                  for r in pdf.drop_duplicates("k", keep="first").itertuples(index=False))
    assert got == want


dates = st.one_of(st.none(), st.dates(min_value=dt.date(2023, 12, 20), max_value=dt.date(2024, 2, 10)).map(str),
                  st.sampled_from(["open-ended", "2024-13-01", ""]))


@SETTINGS
@given(st.lists(dates, min_size=1, max_size=20))
def test_deadline_window_matches_python(spark, ends):
    from hirelake.operators import marts
    rows_ = [(f"c{i}", "t", "u", e, "p", "d", "M", "m") for i, e in enumerate(ends)]
    df = spark.createDataFrame(rows_, "company string, title string, url string, end_at string, "
                                      "primary_responsibility string, company_description string, "
                                      "major_category string, middle_category string")
    got = sorted(r.company for r in marts.upcoming_deadlines(df, "2024-01-20", 7).collect())
    start = dt.date(2024, 1, 20)

    def ok(e):
        try:
            d = dt.date.fromisoformat(e)
        except (TypeError, ValueError):
            return False
        return start <= d <= start + dt.timedelta(days=7)
    assert got == sorted(f"c{i}" for i, e in enumerate(ends) if ok(e))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab Z\né.+-", max_size=25)), min_size=1, max_size=10))
def test_latin_terms_match_regex(spark, texts):
    import re
    from hirelake.functions.text import latin_terms
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.terms for r in df.select("i", latin_terms("t").alias("terms")).collect()}
    assert got == {i: (re.findall(r"[A-Za-z]+", t) if t else []) for i, t in enumerate(texts)}


platforms = st.sampled_from(["wanted", "jumpit", "rallit", "jobplanet", "other", None])
places = st.sampled_from(["A", "B", "C", None])


@SETTINGS
@given(st.lists(st.tuples(platforms, places, st.booleans()), min_size=1, max_size=20))
def test_geocode_rule_matches_python(spark, data):
    from hirelake.operators import geo
    addr = {"A": (1.0, 2.0), "B": (3.0, 4.0)}  # C misses
    rows_ = [(str(i), p, loc, [9.0, 9.0] if own else None) for i, (p, loc, own) in enumerate(data)]
    df = spark.createDataFrame(rows_, "job_id string, platform string, location string, coordinate array<double>")
    dim = spark.createDataFrame([(k, v[0], v[1]) for k, v in addr.items()], "location string, lat double, lon double")
    got = {r.job_id: r.coordinate for r in geo.geocode(df, dim).collect()}
    want = {}
    for job_id, p, loc, own in rows_:
        if p not in ("wanted", "jumpit", "rallit", "jobplanet"):
            continue  # the split/union drops other platforms
        if p in ("jobplanet", "jumpit"):
            want[job_id] = list(addr[loc]) if loc in addr else None  # replaced, a miss gives NULL
        else:
            want[job_id] = own  # kept as is
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from(["M1", "M2"])), min_size=1, max_size=12),
       st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.sampled_from([1.0, 2.0, None]),
                          st.sampled_from([5.0, None]), st.sampled_from(["d1", "d2"])), min_size=0, max_size=12))
def test_company_coordinates_matches_pandas(spark, jds_rows, detail_rows):
    from hirelake.operators import marts
    jds = spark.createDataFrame([(c, m, "mid", "sub") for c, m in jds_rows],
                                "company string, major_category string, middle_category string, sub_category string")
    detail = spark.createDataFrame(detail_rows, "company string, lat double, lon double, company_description string")
    got = sorted(tuple(r) for r in marts.company_coordinates(jds, detail).collect())
    u = pd.DataFrame([(c, m, "mid", "sub") for c, m in jds_rows],
                     columns=["company", "major_category", "middle_category", "sub_category"])
    c = pd.DataFrame(detail_rows, columns=["company", "lat", "lon", "company_description"])
    c = c[c.lat.notna() & c.lon.notna()]
    j = u.dropna(subset=["company"]).merge(c, on="company")
    want = sorted(set((r.major_category, r.middle_category, r.sub_category, r.company, r.lat, r.lon)
                      for r in j.itertuples(index=False)))
    assert got == want
