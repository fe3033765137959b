"""Site payload normalisers and scalar functions on hand-made edge rows
(B14-B18, H2-H4, H8-H11, H13, H16, H18, H22-H26, I10, I17)."""

import json

from pyspark.sql import functions as F

from conftest import rows
from hirelake.functions import dates as fd
from hirelake.functions import geo as fg
from hirelake.functions import text as ft
from hirelake.operators import normalize as nz


def _raw(spark, items):
    return spark.createDataFrame([(str(j), c, json.dumps(p, ensure_ascii=False) if p is not None else None)
                                  for j, c, p in items], "job_id string, category string, payload string")


def test_normalize_wanted(spark):
    full = {"job": {"company": {"name": "ACME"}, "position": "Backend",
                    "detail": {"main_tasks": "build", "requirements": "java", "preferred_points": "k8s",
                               "benefits": "meals", "intro": "we"},
                    "due_time": None, "skill_tags": [{"title": "Java"}, {"title": "Kotlin"}],
                    "address": {"full_location": "서울 강남구", "geo_location": {"location": {"lat": 37.5, "lng": 127.0}}}}}
    no_addr = {"job": {"company": {"name": "B"}, "detail": {}, "skill_tags": None}}
    df = nz.normalize_wanted(_raw(spark, [(1, "DBA", full), (2, "DBA", no_addr), (3, "DBA", {}), (4, "DBA", None)]))
    got = {r.job_id: r for r in df.collect()}
    assert set(got) == {"1", "2"}  # B18: missing payloads skipped
    assert got["1"].skills == ["Java", "Kotlin"] and got["1"].coordinate == [37.5, 127.0]  # H24, H23
    assert got["1"].url == "https://www.wanted.co.kr/wd/1" and got["1"].body == ""  # H7
    assert got["2"].coordinate is None and got["2"].location is None and got["2"].skills is None
    assert got["2"].title == ""


def test_normalize_jumpit(spark):
    p = {"result": {"companyName": "J", "title": "t", "preferredRequirements": "p", "qualifications": "q",
                    "responsibility": "r", "closedAt": "2024-01-31", "techStacks": [{"stack": "Go"}],
                    "welfares": "w", "serviceInfo": "s",
                    "jobPostingForSearchEngine": {"jobLocation": {"address": {"streetAddress": "부산 해운대구"}}}}}
    r = nz.normalize_jumpit(_raw(spark, [(42, "QA", p)])).first()
    assert (r.job_id, r.skills, r.location, r.coordinate, r.body) == ("42", ["Go"], "부산 해운대구", None, None)


def test_normalize_jobplanet_empty_crlf_date(spark):
    p = {"data": {"end_at": "2023.08.14", "name": "JP", "title": "t", "preferred_skill": "",
                  "required_qualification": "a\r\nb", "primary_responsibility": "x\r\ny", "skills": ["SQL"],
                  "location": "", "benefit": "b\r\n", "introduction": ""}}
    bad_date = {"data": {"end_at": "someday", "name": "JP", "title": "t", "preferred_skill": "x",
                         "required_qualification": "", "primary_responsibility": "", "skills": [],
                         "location": "서울", "benefit": "", "introduction": "i"}}
    got = {r.job_id: r for r in nz.normalize_jobplanet(_raw(spark, [(5, "DBA", p), (6, "DBA", bad_date)])).collect()}
    r = got["5"]
    assert r.end_at == "2023-08-14"  # H16
    assert r.preferred is None and r.location is None and r.company_description is None  # H3
    assert r.required == "a\nb" and r.primary_responsibility == "x\ny" and r.welfare == "b\n"  # H2
    assert got["6"].end_at is None and got["6"].required == ""


def test_normalize_rallit_truthy_coordinates(spark):
    def p(i, lat, lon):
        return {"data": {"id": i, "companyName": "R", "title": "t", "latitude": lat, "longitude": lon,
                         "jobSkillKeywords": ["React"], "addressMain": "서울 마포구"}}
    df = nz.normalize_rallit(_raw(spark, [(0, "FE", p(1, 37.1, 127.1)), (0, "FE", p(2, 0.0, 127.1)),
                                          (0, "FE", p(3, None, 127.1))]))
    assert rows(df.select("job_id", "coordinate")) == [("1", [37.1, 127.1]), ("2", None), ("3", None)]


def test_address_parts(spark):
    # NULL, blanks, label only, label + one token, one token, extra spaces
    data = [(1, None), (2, "   "), (3, "주소"), (4, "주소 경기"), (5, "부산"), (6, "서울  마포구"),
            (7, "주소 경기 성남시 분당구"), (8, "\t서울\t강남구 ")]
    df = spark.createDataFrame(data, "id int, loc string")
    got = rows(df.select("id", fg.sido("loc"), fg.gugun("loc")))
    assert got == [(1, None, None), (2, None, None), (3, None, None), (4, "경기", None), (5, "부산", None),
                   (6, "서울", "마포"), (7, "경기", "성남"), (8, "서울", "강남")]
    assert df.select(F.size(ft.split_ws("loc"))).where("id = 2").first()[0] == 0


def test_text_functions(spark):
    df = spark.createDataFrame([(1, " a\r\nb \n", "x y"), (2, "", None), (3, None, "zz")],
                               "id int, t string, s string")
    got = rows(df.select("id", ft.crlf_to_lf("t"), ft.empty_to_null("t"), ft.remove_spaces("s"),
                         ft.strip("t"), ft.newline_to_space("t"), ft.latin_terms("t")))
    assert got == [(1, " a\nb \n", " a\r\nb \n", "xy", "a\r\nb", " a\r b  ", ["a", "b"]),
                   (2, "", None, None, "", "", []),
                   (3, None, None, "zz", None, None, [])]  # I10: NULL/blank -> []


def test_clean_tags_and_date_helpers(spark):
    df = spark.createDataFrame([(["#<!-- -->Java ", "# Spark", "Go"], 0), (None, 3661), ([], 59)],
                               "tags array<string>, secs long")
    got = rows(df.select(ft.clean_tags("tags"), fd.hms("secs")), order=True)
    assert got[0] == (["Java", "Spark", "Go"], "0h 0m 0s")  # I17, H18
    assert got[1] == (None, "1h 1m 1s")
    assert got[2] == ([], "0h 0m 59s")
    d = spark.createDataFrame([("2024", "1", "5"), ("2024", "12", None)], "y string, m string, d string")
    assert [r[0] for r in d.select(fd.date_str("y", "m", "d")).collect()] == ["2024-01-05", None]  # H5, H6


def test_coordinate_parts_and_json(spark):
    df = spark.createDataFrame([([1.5, 2.5],), ([3.0],), (None,)], "c array<double>")
    got = rows(df.select(fg.coord_part("c", 1), fg.coord_part("c", 2)), order=True)
    assert got == [(1.5, 2.5), (3.0, None), (None, None)]  # H20-H22, no out-of-bounds error under ANSI
    # First element of a nested JSON array, NULL on any miss
    js = spark.createDataFrame([('{"documents": [{"address": {"x": "1", "y": "2"}}]}',), ('{"documents": []}',),
                                ("not json",)], "j string")
    schema = "documents array<struct<address: struct<x: string, y: string>>>"
    first = F.try_element_at(F.from_json("j", schema)["documents"], F.lit(1))["address"]
    assert [r[0] for r in js.select(first["y"]).collect()] == ["2", None, None]
