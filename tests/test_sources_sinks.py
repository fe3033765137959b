"""Landing zone, partitioned sinks and catalog tables."""

import json
import os

from pyspark.sql import functions as F

from conftest import rows
from hirelake.plans.pipeline import rebuild
from hirelake.sources import landing, sinks, tables


def _write_doc(path, payload):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(payload, f, ensure_ascii=False, indent=4)


def _posting(job_id, platform, **kw):
    base = {"job_id": job_id, "platform": platform, "category": "DBA", "url": None, "company": "c",
            "title": "t", "primary_responsibility": "a\nb", "required": None, "preferred": None,
            "end_at": None, "skills": ["Java"], "location": "부산", "welfare": None, "body": "",
            "company_description": None, "coordinate": None}
    base.update(kw)
    return base


def test_landing_both_wrapper_keys_and_mixed_ids(spark, tmp_dir):
    # A1 + A2: "results", older "result", neither; integer and string ids
    _write_doc(f"{tmp_dir}/wanted/year=2024/month=01/day=02/wanted.json",
               {"results": [_posting("11", "wanted"), _posting("12", "wanted", coordinate=[37.5, 127.0])]})
    _write_doc(f"{tmp_dir}/jumpit/year=2024/month=01/day=02/jumpit.json",
               {"result": [_posting(7, "jumpit")]})
    _write_doc(f"{tmp_dir}/rallit/year=2024/month=1/day=3/rallit.json", {"other": []})
    from hirelake.operators.clean import union_loose
    df = union_loose(list(landing.read_landing_sites(spark, tmp_dir, ["wanted", "jumpit", "rallit"]).values()))
    got = rows(df.select("job_id", "platform", "coordinate", "year", "month", "day"))
    assert got == [("11", "wanted", None, "2024", "01", "02"),
                   ("12", "wanted", [37.5, 127.0], "2024", "01", "02"),
                   ("7", "jumpit", None, "2024", "01", "02")]
    # partition values stay strings (unpadded values survive as written),
    # even with partition type inference switched on
    assert dict(df.dtypes)["month"] == "string"
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        again = landing.read_landing_rows(spark, f"{tmp_dir}/wanted", base_path=f"{tmp_dir}/wanted")
        assert {r.month for r in again.collect()} == {"01"}
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def test_write_landing_roundtrip_and_discover(spark, tmp_dir, sf_small):
    from hirelake.sources.fixtures import postings
    p = postings(spark, sf_small)
    out = f"{tmp_dir}/landing"
    landing.write_landing(p, out)  # A12: JSON lines by platform/day
    back = landing.read_posting_lines(spark, out)
    assert back.count() == p.count()
    assert sorted(back.columns) == sorted(p.columns)
    assert back.exceptAll(p).count() == 0
    found = landing.discover(spark, out)  # A13
    assert {"platform", "year", "month", "day", "job_id"} <= set(found.columns)


def test_partitioned_write_and_day_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([("a", "2024", "01", "01"), ("b", "2024", "01", "02")],
                               "v string, year string, month string, day string")
    out = f"{tmp_dir}/t"
    sinks.write_partitioned(df, out)  # A5
    new_day = spark.createDataFrame([("c", "2024", "01", "02")], df.schema)
    sinks.write_day(new_day, out)  # A6: only day=02 is replaced
    back = spark.read.parquet(out)
    assert rows(back.select("v", "day")) == [("a", "01"), ("c", "02")]
    # A4: the day filter becomes a partition filter of the scan
    plan = tables.read_day(back, "2024", "01", "02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan


def test_csv_and_catalog_tables(spark, tmp_dir):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n long")
    sinks.write_csv(df, f"{tmp_dir}/csv", single_file=True)  # A7
    back = spark.read.option("header", True).csv(f"{tmp_dir}/csv")
    assert rows(back) == [("x", "1"), ("y", "2")]
    sinks.save_table(df, "hl_test_save", path=f"{tmp_dir}/tbl")  # A8
    assert rows(tables.read_table(spark, "hl_test_save")) == [("x", 1), ("y", 2)]  # A3
    tables.register_views(spark, {"hl_view": df})  # A10
    assert spark.sql("SELECT sum(n) AS s FROM hl_view").first().s == 3


def test_rebuild_in_dependency_order(spark, tmp_dir):
    # Each table is written, and later tables read the written parent
    base = spark.range(10).withColumn("g", F.col("id") % 3)
    registry = {
        "base": lambda done: base,
        "counts": lambda done: done["base"].groupBy("g").count(),
    }
    done = rebuild(spark, registry, ["base", "counts"], base_path=f"{tmp_dir}/marts")
    assert rows(done["counts"]) == [(0, 4), (1, 3), (2, 3)]
    assert "FileScan" in done["counts"]._jdf.queryExecution().executedPlan().toString()


def test_literal_frames(spark):
    # Nested struct + array rows with an explicit schema
    from hirelake.operators.marts import count_by
    people = tables.literal_frame(spark, [("Ida", 41, "Oslo"), ("Bo", 35, "Bergen"), ("Liv", 52, "Oslo")],
                                  "name string, age long, city string")
    assert people.orderBy(F.desc("age")).first().name == "Liv"  # F3
    assert rows(count_by(people, ["city"])) == [("Bergen", 1), ("Oslo", 2)]  # D13
    nested = tables.literal_frame(spark, [(("a", "b"), ["x", "y"]), (("c", ""), ["y"])],
                                  "name struct<given:string,family:string>, tags array<string>")
    assert nested.schema["name"].dataType.names == ["given", "family"]
    assert nested.where(F.array_contains("tags", "x")).count() == 1


def test_full_rewrite_drops_days_and_discover_sees_all_rows(spark, tmp_dir):
    # A5 under the engine's own dynamic overwrite mode; A13 on a landing zone of A12
    from hirelake.sources import fixtures as fx
    days = spark.createDataFrame([("1", "2024", "01", "01"), ("2", "2024", "01", "02")], "job_id string, year string, month string, day string")
    sinks.write_partitioned(days, f"{tmp_dir}/out")
    sinks.write_partitioned(days.where("day = '02'"), f"{tmp_dir}/out")
    assert [r["job_id"] for r in spark.read.parquet(f"{tmp_dir}/out").collect()] == ["2"]
    posts = fx.postings(spark, "/root/testdata/sf0.001")
    landing.write_landing(posts, f"{tmp_dir}/landing")
    assert landing.discover(spark, f"{tmp_dir}/landing").count() == posts.count()


def test_unicode_white_space_and_large_division(spark):
    from hirelake.functions import dates as fd
    from hirelake.functions import geo as fg
    from hirelake.functions import text as ft
    texts = ["\u3000경기\u3000성남시", "부산\u00a0해운대구 ", " \x1f\n", "a\u2003b\x85c", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r for r in df.select("i", ft.split_ws("t").alias("s"), ft.strip("t").alias("x"), fg.sido("t").alias("sido"),
                                        ft.clean_tags(F.array(F.concat(F.lit("\t# <!-- -->"), "t"))).alias("tags")).collect()}
    for i, t in enumerate(texts):
        assert got[i]["s"] == t.split() and got[i]["x"] == t.strip()
    assert got[0]["sido"] == "경기"
    big = 2**53 + 3
    cases = [(big, 1), (-7, 2), (7, -2), (-8, 2), (0, 5), (2**62 + 1, 3)]
    out = spark.createDataFrame(cases, "a long, b long").select(fd.int_div("a", "b")).collect()
    assert [r[0] for r in out] == [a // b for a, b in cases]


def test_page_rules(spark):
    from hirelake.operators import pages
    html = ('<ul><li><div><a href="/positions/1">x</a></div></li><li class="k"><a class="c" href="/positions/2?q">y</a>'
            '<a href="/positions/9">second</a></li><li><a href="/positions/3">z</a></li><li>none</li></ul>'
            '<p class="x">one <b>bold</b><pre>kept</pre></p><p>two</p>')
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r["posting_id"] for r in pages.page_links(df).collect()] == ["1", "2", "3"]
    assert pages.first_paragraphs(df).first()["first_paragraph"] == "one boldkept"


def test_rebuild_into_catalog(spark, tmp_dir):
    # A9 without a base path: drop-and-create managed tables, in order
    base = spark.range(6).withColumn("g", F.col("id") % 2)
    registry = {"hl_base": lambda done: base,
                "hl_counts": lambda done: done["hl_base"].groupBy("g").count()}
    rebuild(spark, registry, ["hl_base", "hl_counts"])
    rebuild(spark, registry, ["hl_base", "hl_counts"])  # rerun replaces, never appends
    assert rows(spark.table("hl_counts")) == [(0, 3), (1, 3)]
    before = spark.table("hl_base")  # opened before the next rebuild: keeps its version
    rebuild(spark, {"hl_base": lambda done: base.where("id < 2")}, ["hl_base"])
    assert before.count() == 6 and spark.table("hl_base").count() == 2


def test_published_days_are_replaced_in_one_step(spark, tmp_dir):
    import pytest

    from hirelake.sources import publish as pub
    day = lambda n, *d: spark.range(n).selectExpr("id", "'2024' AS year", "'01' AS month", f"explode(array{d + d if len(d) == 1 else d}) AS day").distinct()
    path = f"{tmp_dir}/t"
    with pytest.raises(FileNotFoundError):
        pub.read_published(spark, path)
    pub.publish(day(3, "01", "02"), path)
    before = pub.read_published(spark, path)
    pub.publish(day(5, "02", "03"), path, emptied=[{"year": "2024", "month": "01", "day": "01"}])
    count = lambda df: {r["day"]: r["count"] for r in df.groupBy("day").count().collect()}
    assert count(before) == {"01": 3, "02": 3}  # opened before: keeps its version
    assert count(pub.read_published(spark, path)) == {"02": 5, "03": 5}
    assert pub.read_published(spark, path).columns == ["id", "year", "month", "day"]
    pub.publish(day(1, "02").limit(0), path)
    assert count(pub.read_published(spark, path)) == {"02": 5, "03": 5}


def test_register_prefix_sees_new_days(spark, tmp_dir):
    from hirelake.sources.catalog import register_prefix
    path = f"{tmp_dir}/days"
    day = lambda n, d: spark.range(n).selectExpr("id", "'2024' AS year", "'01' AS month", f"'{d}' AS day")
    day(3, "01").write.partitionBy("year", "month", "day").parquet(path)
    assert register_prefix(spark, "hl_days", path).count() == 3
    day(4, "02").withColumn("extra", F.lit("x")).write.mode("append").partitionBy("year", "month", "day").parquet(path)
    table = register_prefix(spark, "hl_days", path)
    assert table.count() == spark.table("hl_days").count() == 7
    assert spark.table("hl_days").where("day = '02'").select("extra").distinct().collect() == [("x",)]


def test_checkpoint_dir_comes_from_the_session(spark):
    from hirelake.session import checkpoint_dir, ensure_checkpoint_dir, scratch_path
    configured = checkpoint_dir(spark)
    assert configured and ensure_checkpoint_dir(spark) == configured  # never replaced once set
    assert scratch_path(spark, "x").startswith(configured.rstrip("/"))
