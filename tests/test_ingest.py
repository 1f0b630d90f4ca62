import datetime as dt

from pyspark.sql import functions as F

from shelfmatch.operators.ingest import compact_store, insert_if_absent
from shelfmatch.operators.urls import contains_brand, keyword_filter, new_urls, url_counts
from shelfmatch.functions.prices import crawl_time, parse_price, pick_price_text, reward_points, sku_from_url
from shelfmatch.session import scratch_path
from shelfmatch.sources.sitemap import read_sitemap
from shelfmatch.streaming.ingest import BatchProfile, _file_order, stage_batches, staged_stream, stream_insert_if_absent

T0 = dt.datetime(2024, 1, 1)


def _batch(spark, rows):
    return spark.createDataFrame(rows, "url string, product_data string, crawled_at timestamp, status string")


def test_insert_if_absent_first_write_wins_and_replay(spark):
    store, quarantine = scratch_path(spark, "store"), scratch_path(spark, "quar")
    b0 = _batch(spark, [("u1", "first", T0, "success"), ("u1", "second", T0, "success"), (None, "x", T0, "error: x"),
                        ("u2", "a", T0, "success")])
    s0 = insert_if_absent(spark, b0, store, 0, key="url", order=["crawled_at"], quarantine=quarantine)
    assert (s0["processed"], s0["inserted"], s0["duplicates"], s0["errors"]) == (4, 2, 1, 1)
    b1 = _batch(spark, [("u1", "later", T0, "success"), ("u3", "c", T0, "success")])
    s1 = insert_if_absent(spark, b1, store, 1, key="url", order=["crawled_at"])
    assert s1["inserted"] == 1
    again = insert_if_absent(spark, b1, store, 1, key="url", order=["crawled_at"])  # replayed batch
    assert again["inserted"] == 1
    rows = {r["url"]: r["product_data"] for r in spark.read.parquet(store).collect()}
    assert rows == {"u1": "first", "u2": "a", "u3": "c"}
    assert spark.read.parquet(quarantine).count() == 1


def test_insert_if_absent_after_a_batch_without_valid_rows_and_with_ties(spark):
    store = scratch_path(spark, "store")
    none = insert_if_absent(spark, _batch(spark, [(None, "x", T0, "error"), (None, "y", T0, "error")]), store, 0, key="url", order=["crawled_at"])
    assert (none["inserted"], none["errors"]) == (0, 2)
    for _ in range(2):  # equal in the order column: the other columns decide, so a replay writes the same row
        s1 = insert_if_absent(spark, _batch(spark, [("u1", "b", T0, "s"), ("u1", "a", T0, "s")]), store, 1, key="url", order=["crawled_at"])
        assert (s1["inserted"], s1["duplicates"]) == (1, 1)
    assert [r["product_data"] for r in spark.read.parquet(store).collect()] == ["a"]
    assert insert_if_absent(spark, _batch(spark, [("u1", "c", T0, "s")]), store, 2, key="url", order=["crawled_at"])["inserted"] == 0


def test_compaction_keeps_the_rows_and_later_batches_see_them(spark):
    store = scratch_path(spark, "store")
    for k in range(6):
        insert_if_absent(spark, _batch(spark, [(f"u{k}", f"b{k}", T0, "s"), (f"u{k + 1}", f"b{k}", T0, "s")] if k != 3 else []), store, k, key="url", order=["crawled_at"])
    before = {r["url"]: r["product_data"] for r in spark.read.parquet(store).collect()}
    assert compact_store(spark, store, 4) == 5  # an empty batch has a file too
    assert sorted(r["batch_id"] for r in spark.read.parquet(store).select("batch_id").distinct().collect()) == [4, 5]
    assert {r["url"]: r["product_data"] for r in spark.read.parquet(store).collect()} == before and spark.read.parquet(store).count() == len(before)
    assert compact_store(spark, store, 4) == 1  # nothing left to do
    after = insert_if_absent(spark, _batch(spark, [("u0", "late", T0, "s"), ("new", "x", T0, "s")]), store, 6, key="url", order=["crawled_at"])
    assert (after["inserted"], after["duplicates"]) == (1, 1)


def test_url_operators(spark):
    cands = spark.createDataFrame([("https://x.vn/dtdd/a",), ("https://x.vn/dtdd/sac-b",), ("https://x.vn/dtdd/a",),
                                   ("https://x.vn/phu-kien/dtdd",), ("ftp://samsung",)], "url string")
    assert [r[0] for r in keyword_filter(cands).distinct().collect()] == ["https://x.vn/dtdd/a"]
    seen = spark.createDataFrame([("https://x.vn/dtdd/a",)], "url string")
    assert new_urls(cands, seen).count() == 3
    r = url_counts(cands, seen).first()
    assert (r["total"], r["new"]) == (5, 3)
    assert cands.where(contains_brand("url")).count() == 1


def test_price_functions(spark):
    df = spark.createDataFrame([(" 29.990.000₫ ", "+7.497 Điểm thưởng", "https://s/p?sku=AB12", T0)],
                               "p string, r string, u string, t timestamp")
    r = df.select(parse_price("p").alias("p"), reward_points("r").alias("r"), sku_from_url("u").alias("s"),
                  crawl_time("t").alias("t"),
                  pick_price_text(F.array(F.lit("Trả góp"), F.col("p"))).alias("pick")).first()
    assert (r["p"], r["r"], r["s"], r["t"]) == (29990000, 7497, "AB12", "2024-01-01 00:00:00")
    assert r["pick"] == "29.990.000₫"
    bad = spark.createDataFrame([("Liên hệ",)], "p string").select(parse_price("p")).first()[0]
    assert bad is None


def test_sitemap_single_and_many(spark, tmp_path):
    one = tmp_path / "one.xml"
    one.write_text('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
                   '<url><loc>https://a/1</loc></url></urlset>')
    many = tmp_path / "many.xml"
    many.write_text('<urlset><url><loc>https://a/2</loc><lastmod>2024-01-01</lastmod></url><url><lastmod>x</lastmod></url>'
                    '<url><loc>https://a/3</loc></url></urlset>')
    idx = tmp_path / "index.xml"
    idx.write_text('<sitemapindex><sitemap><loc>https://a/s1.xml</loc></sitemap></sitemapindex>')
    locs = sorted(r["loc"] for r in read_sitemap(spark, [str(one), str(many)]).collect())
    assert locs == ["https://a/1", "https://a/2", "https://a/3"]
    assert [(r["loc"], r["is_index"]) for r in read_sitemap(spark, str(idx)).collect()] == [("https://a/s1.xml", True)]


def test_new_urls_plan_is_anti_join(spark):
    cands = spark.createDataFrame([("a",), ("b",)], "url string")
    seen = spark.createDataFrame([("a",)], "url string")
    plan = new_urls(cands, seen)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "Cartesian" not in plan


def test_catalogue_columns_are_bound_by_name_in_file_order(spark, tmp_path):
    import pytest

    from shelfmatch.sources.files import read_catalogue
    (tmp_path / "a.csv").write_text('title,_id,extra,title_cleaned,color_options,capacities\n"Phone\nX",42,e,phone x,NaN,N/A\nB,43,e,b,,128GB\n')
    (tmp_path / "b.csv").write_text('title,_id,extra,title_cleaned,color_options,capacities\nC,44,e,c,red,\n' + "D,45,e,d,red,\n" * 300)
    rows = read_catalogue(spark, str(tmp_path)).orderBy("_ord").collect()
    assert [r["_id"] for r in rows[:3]] == ["42", "43", "44"] and len(rows) == 303
    assert (rows[0]["title"], rows[0]["capacities"], rows[0]["color_options"], rows[1]["capacities"]) == ("Phone\nX", None, None, "128GB")
    (tmp_path / "c.csv").write_text("_id,title\n1,x\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_catalogue(spark, str(tmp_path / "c.csv"))


def test_many_micro_batches_of_a_trigger_load_as_one_by_one(spark):
    rows = [(k, k % 7 if k % 5 else None, f"d{k // 23}") for k in range(60)]  # days of 23, 23 and 14 items, in fours
    items = spark.createDataFrame(rows, "event_id long, user long, day string")
    profile, base = BatchProfile(4, 1), scratch_path(spark, "test-flush")
    for name, flush in (("one", None), ("many", "flush")):
        stage_batches(items, "day", f"{base}/{name}/in", ["event_id"], profile, flush)
        schema = (items.withColumn(flush, F.lit(0).cast("long")) if flush else items).schema
        stream = staged_stream(spark, f"{base}/{name}/in", schema, profile)
        load = stream_insert_if_absent(stream, *[f"{base}/{name}/{x}" for x in ("store", "stats", "ck")], key="user", order=["day", "event_id"],
                                       valid=F.col("event_id") != 1, quarantine=f"{base}/{name}/bad", flush=flush)
        load.awaitTermination()
    read = lambda path, *columns: sorted(map(tuple, spark.read.parquet(f"{base}/{path}").select(*columns).collect()), key=str)
    stats = ("first_item", "processed", "inserted", "duplicates", "errors")
    assert read("many/stats", *stats) == read("one/stats", *stats) and len(read("one/stats", *stats)) == 16
    assert read("many/store", *items.columns) == read("one/store", *items.columns)
    assert read("many/bad", *items.columns) == read("one/bad", *items.columns)
    triggers = spark.read.parquet(f"{base}/many/stats").select("batch_id").distinct().count()
    assert triggers == 3


def test_staged_files_beyond_a_thousand_keep_their_order():
    names = [f"day=1/part-00000-u.c{k:03d}.snappy.parquet" for k in (999, 1000, 1001, 100)]
    assert [_file_order(x)[1] for x in sorted(names, key=_file_order)] == [100, 999, 1000, 1001]
