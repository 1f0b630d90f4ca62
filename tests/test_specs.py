from pyspark.sql import functions as F

from shelfmatch.operators.extract import (Rule, drop_forbidden, extract_fields, merge_sections, record_status,
                                          require_container)
from shelfmatch.operators.specs import drop_keys, group_specs, parse_noisy_json, resolve_refs


def test_group_specs_last_wins(spark):
    items = spark.createDataFrame([
        (1, 0, "Màn hình", [("Kích thước", "6.1"), (" Kích thước ", "6.7"), ("", "x"), ("Tần số", None)]),
        (1, 1, "  ", [("a", "b")]),
        (1, 2, "Pin", [("Dung lượng", "4000")]),
        (1, 3, "Pin", [("Sạc", "25W")]),
        (1, 4, "Trống", [("", "x")]),
    ], "doc_id long, item_pos int, groupName string, attributes array<struct<displayName:string,value:string>>")
    r = group_specs(items).first()["specs"]
    assert r == {"Màn hình": {"Kích thước": "6.7"}, "Pin": {"Sạc": "25W"}, "Trống": {}}


def test_resolve_refs_chain_cycle_unknown(spark):
    nodes = spark.createDataFrame([
        (1, "a", "$b"), (1, "b", "$c"), (1, "c", "text"), (1, "x", "$y"), (1, "y", "$x"),
        (1, "u", "$nope"), (1, "p", "$q"), (1, "q", "$r"), (1, "r", "$p"), (2, "a", "other"), (1, "s", "$s"),
    ], "doc_id long, key string, value string")
    got = {(r["doc_id"], r["key"]): r["resolved"] for r in resolve_refs(nodes).collect()}
    assert got[(1, "a")] == "text" and got[(1, "b")] == "text" and got[(1, "c")] == "text"
    assert got[(1, "x")] is None and got[(1, "y")] is None and got[(1, "s")] is None
    assert got[(1, "p")] is None and got[(1, "u")] is None and got[(2, "a")] == "other"


def test_drop_keys_nested(spark):
    df = spark.createDataFrame([("u", {"title": "t", "icon": "i"}, [("v", 1, {"thumb": "x", "k": "y"})])],
                               "url string, info struct<title:string,icon:string>, "
                               "items array<struct<imageUrl:string,n:int,m:map<string,string>>>")
    out = drop_keys(df)
    assert out.columns == ["info", "items"]
    r = out.first()
    assert r["info"].asDict() == {"title": "t"}
    assert r["items"][0].asDict() == {"n": 1, "m": {"k": "y"}}


def test_noisy_json(spark):
    df = spark.createDataFrame([("noise [1, 2] more",), ('log {"a": 1} end',), ("nothing",)], "t string")
    r = df.select(parse_noisy_json("t", "array<int>").alias("a")).collect()
    assert r[0]["a"] == [1, 2] and r[1]["a"] is None and r[2]["a"] is None


HTML_FULL = ('<html><head><title>Phone &amp; co</title><script>var s="</p>";</script></head><body>'
             '<div class="box-main"><h1 class="name">Galaxy S24</h1><p>one</p><p>two</p>'
             '<span class="price big">29.990.000₫</span><a href="/x">X</a></div></body></html>')
HTML_SPARSE = '<html><body><div class="box-main"><p>only</p></div></body></html>'
HTML_NONE = '<html><body><div class="other">nothing</div></body></html>'


def test_extract_fields_layout(spark):
    pages = spark.createDataFrame([(1, "u1", HTML_FULL), (2, "u2", HTML_SPARSE), (3, "u3", HTML_NONE)],
                                  "page_id long, url string, html string")
    kept = require_container(pages, Rule("main", "div", cls="box-main"))
    rules = [Rule("title", "title"), Rule("product_name", "h1", cls="name"), Rule("price", "span", cls="price"),
             Rule("n_p", "p", mode="count"), Rule("links", "a", mode="attr", attr="href"),
             Rule("sel", "span", cls="missing", default="")]
    rec = extract_fields(kept, rules).withColumn("status", record_status(F.col("product_name")))
    rows = {r["page_id"]: r for r in rec.collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["title"] == "Phone & co" and rows[1]["product_name"] == "Galaxy S24"
    assert rows[1]["price"] == "29.990.000₫" and rows[1]["n_p"] == 2 and rows[1]["links"] == ["/x"]
    assert rows[1]["status"] == "success" and rows[2]["status"] == "no_name_found"
    assert rows[2]["sel"] == ""


def test_merge_sections_later_wins(spark):
    df = spark.createDataFrame([((1, "a"), ("b", 2))], "s1 struct<x:int,name:string>, s2 struct<name:string,y:int>")
    r = merge_sections(df, ["s1", "s2"]).first()["product_data"].asDict()
    assert r == {"x": 1, "name": "b", "y": 2}


def test_drop_forbidden(spark):
    df = spark.createDataFrame([("a", 200), ("b", 403), ("c", None)], "url string, http_status int")
    assert sorted(r["url"] for r in drop_forbidden(df).collect()) == ["a", "c"]


def test_rules_match_class_tokens_nesting_and_attributes(spark):
    html = ("<div class='price-old'>1</div><DIV CLASS='x price'>a<div>b</div>c &#x41;&#66; &#9999999;</DIV><div class=price>d</div>"
            "<a class=y href='/no'>n</a><a class='x z' data-href='/d' href='/yes'>t</a><a class='x' href=/bare>u</a><abbr class=x href=/q>v</abbr>")
    page = spark.createDataFrame([(1, "u", html), (2, "u", "<div class=price>never ends<div>"), (3, "u", None)], "page_id long, url string, html string")
    rules = [Rule("price", "div", cls="price"), Rule("links", "a", cls="x", mode="attr", attr="href"), Rule("names", "a", cls="x", mode="list"), Rule("n", "div", mode="count")]
    rows = {r["page_id"]: r for r in extract_fields(page, rules).collect()}
    assert rows[1]["price"] == "a b c AB &#9999999;"
    assert rows[1]["links"] == ["/yes", "/bare"] and rows[1]["names"] == ["t", "u"] and rows[1]["n"] == 4
    assert rows[2]["price"] is None and rows[3]["price"] is None


def test_resolve_refs_long_chains_and_long_cycles(spark):
    chain = [(1, f"c{i}", f"$c{i + 1}") for i in range(100)] + [(1, "c100", "end")]
    cycle = [(2, f"k{i}", f"$k{(i + 1) % 37}") for i in range(37)] + [(2, "in", "$k5"), (2, "n", None), (2, "to_null", "$n")]
    got = {(r["doc_id"], r["key"]): r["resolved"] for r in resolve_refs(spark.createDataFrame(chain + cycle, "doc_id long, key string, value string")).collect()}
    assert len(got) == len(chain) + len(cycle)
    assert all(got[1, f"c{i}"] == "end" for i in range(101))
    assert all(v is None for (d, _), v in got.items() if d == 2)
