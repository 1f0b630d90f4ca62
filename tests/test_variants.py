from shelfmatch.functions.lists import parse_list_literal, split_capacities, split_colours
from shelfmatch.operators.variants import spec_counts, variant_matrix, variant_overlap

PAIRS = [
    # capacities_1, colors_1, capacities_2, colors_2
    ("p1", "['256GB', '128GB']", "['Màu Đen, Xanh Dương', 'Xanh Dương, Màu Vàng']", "128 GB, 64GB", "Màu Vàng, Đen"),
    ("p2", "['256GB']", "['Vàng, Bạc, Đen']", "256GB", "Đen, Bạc, Vàng"),
    ("p3", "['256GB']", "[]", "256GB", "Xanh dương"),
    ("p4", "['128GB']", "['Xanh Nhạt, Xanh đậm']", "128GB", "Xanh Nhạt, Xanh Đậm"),
    ("p5", "['32GB', '32GB']", "[]", "32GB", "Xám, Xanh"),
    ("p6", None, "['Đen']", "128GB", "Đen"),
    ("p7", "abc", "['Đen']", "128GB", "Đen"),
    ("p8", "('128GB',)", "['Đen']", "128GB", "Đen"),
    ("p9", "['128GB']", "['Đen']", None, "Đen"),
    ("p10", "['128GB']", "['Đen']", "128GB", None),
]
EXPECTED = {
    ("p1", "128GB"): ["Vàng"],
    ("p2", "256GB"): ["Bạc", "Vàng", "Đen"],
    ("p3", "256GB"): [],
    ("p4", "128GB"): ["Xanh Nhạt"],
    ("p5", "32GB"): [],
    ("p10", "128GB"): [],
}


def _pairs(spark):
    rows = [(pid, "x", pid, pid, c1, c2, k1, k2) for pid, c1, k1, c2, k2 in PAIRS]
    return spark.createDataFrame(rows, "_id1 string, _id2 string, title_cleaned string, references_cleaned string, "
                                       "capacities_1 string, capacities_2 string, colors_1 string, colors_2 string")


def test_variant_overlap_fixture(spark):
    out = variant_overlap(_pairs(spark)).collect()
    got = {}
    counts = {}
    for r in out:
        got[(r["_id1"], r["capacity"])] = sorted(r["common_colors"])
        counts[(r["_id1"], r["capacity"])] = counts.get((r["_id1"], r["capacity"]), 0) + 1
        assert r["num_common_colors"] == len(r["common_colors"])
        assert set(r["common_colors"]) <= set(r["colors1_for_cap"]) & set(r["colors2_for_row"])
    assert got == {k: sorted(v) for k, v in EXPECTED.items()}
    assert counts[("p5", "32GB")] == 2  # repeated capacity keeps repeated rows


def test_variant_overlap_plan_has_no_exchange(spark):
    plan = variant_overlap(_pairs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_list_parsers(spark):
    df = spark.createDataFrame([("['a', \"it's\", None]", " 1 GB, ,2GB ", " Màu Đỏ,  , xMàu Đen")], "l string, c string, k string")
    r = df.select(parse_list_literal("l").alias("l"), split_capacities("c").alias("c"), split_colours("k").alias("k")).first()
    assert r["l"] == ["a", "it's", None]
    assert r["c"] == ["1GB", "2GB"]
    assert r["k"] == ["Đỏ", "xĐen"]
    nulls = spark.createDataFrame([(None,)], "x string").select(
        parse_list_literal("x").alias("l"), split_capacities("x").alias("c"), split_colours("x").alias("k")).first()
    assert nulls["l"] == [] and nulls["c"] == [] and nulls["k"] == []


def test_variant_matrix_and_counts(spark):
    df = spark.createDataFrame([("u1", ["128GB", "256GB"], ["Đen", "Trắng"]), ("u2", ["64GB"], [])],
                               "url string, storages array<string>, colors array<string>")
    variants, errors = variant_matrix(df)
    assert variants.count() == 4
    assert [r["url"] for r in errors.collect()] == ["u2"]
    sec = variants.selectExpr("url", "array(named_struct('id','a','title','A','specifications', "
                              "array(named_struct('label','x','value',array('1')), named_struct('label','y','value',array('2')))),"
                              "named_struct('id','b','title',cast(null as string),'specifications', "
                              "array(named_struct('label','z','value',array('3'))))) as sections")
    r = spec_counts(sec).first()
    assert r["totalSpecs"] == 3 and r["sections"][0]["specCount"] == 2
    assert r["sections"][1]["title"] == "Unknown Section"
