"""Sections of shop pages (X4-X7, X9, X13, X15, X17, X21) on hand-made pages: nesting, unclosed elements, ties, nulls, plans."""

from pyspark.sql import functions as F

from shelfmatch.operators import layouts as L
from shelfmatch.operators.elements import is_element, tag_rows, texts, whole_text, with_scope

PAGES = "page_id long, url string, html string"


def rows_of(spark, *htmls, url="https://shop-a.example/p"):
    return tag_rows(spark.createDataFrame([(k, url, h) for k, h in enumerate(htmls)], PAGES).repartition(3))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    reused = plan.count("ReusedExchange")
    return plan.count("Exchange hashpartitioning") - reused, reused


def test_ends_follow_levels_of_the_own_name(spark):
    html = "<div a>1<div>2<p>3<b>4</div>5</div>6<p>7</p><br>8<img src=x />9</i>10<li>11<li>12"
    got = {r.pos: (r.tag, r.kind, r.end, r.text) for r in rows_of(spark, html).collect()}
    assert got[0][:3] == ("div", 1, 5) and got[1][:3] == ("div", 1, 4)  # the unclosed p and b end neither
    assert got[2][:3] == ("p", 1, 6)  # up to the next p
    assert got[8][1] == 0 and got[9][1] == 0 and [got[k][3] for k in (8, 9, 10)] == ["8", "9", "10"]
    assert got[11][2] == 12 and got[12][2] > 100  # li up to the next li, the last up to the end


def test_scopes_are_outermost_first_and_nested_in_others(spark):
    html = "<div class='x k'>a<div class=x>b</div>c</div>d<div class=x>e<span>f</span><span>g</span></div><span>h</span>"
    rows = with_scope(rows_of(spark, html), "x", is_element("div", "x"))
    got = rows.groupBy("x").agg(texts(F.lit(True), "|").alias("t")).collect()
    assert {r.t for r in got} == {"a|b|c", "d|h", "e|f|g"}
    first = with_scope(with_scope(rows, "s", is_element("span"), inside="x", first=True), "all", is_element("span"), first=True)
    assert {r.text for r in first.where("s IS NOT NULL").collect()} == {"f"} == {r.text for r in first.where("all IS NOT NULL").collect()}


def test_texts_and_attributes(spark):
    html = "<p id=' q ' class='a  b' title=\"x > y &amp; z\"> one <b>&#233;</b><i> </i>two<br> </p><script>if (a < b) '<p>'</script><!-- <p> -->a < b"
    rows = rows_of(spark, html)
    r = rows.where("pos = 0").select("classes", "id", L.attribute(F.col("attrs"), "title").alias("t"), L.attribute(F.col("attrs"), "href").alias("h")).first()
    assert (r.classes, r.id, r.t, r.h) == (["a", "b"], " q ", "x > y & z", None)
    p = with_scope(rows, "p", is_element("p"))
    got = p.where("p IS NOT NULL").groupBy("page_id").agg(texts(F.lit(True)).alias("a"), texts(F.lit(True), " ").alias("b"), whole_text(F.lit(True)).alias("c")).first()
    assert (got.a, got.b, got.c) == ("oneétwo", "one é two", "one é two")


def test_specifications_worked_example(spark):
    group = "<div class='box-specifi'>{}<ul>{}</ul></div>"
    page = (group.format("<h3> Screen </h3>", "<li><aside>Size:</aside><aside>6.1 <b>inch</b></aside></li><li><aside>one</aside></li>")
            + group.format("", "<li><aside>x</aside><aside>y</aside></li>") + group.format("<h3>Camera</h3>", "") + group.format("<h3>Screen</h3>", "<li><aside>a</aside><aside>1</aside></li><li><aside>a:</aside><aside>2</aside></li>"))
    rows = rows_of(spark, page, None, "", "<p>none</p>", page)
    got = {r.page_id: r.specifications for r in L.specifications(rows).collect()}
    assert got == {k: {"Screen": {"a": "2"}, "Camera": {}} for k in (0, 4)}
    assert L.specifications(tag_rows(spark.createDataFrame([], PAGES))).count() == 0


def test_policies_worked_example(spark):
    whole = ("<ul class=policy__list><li><div class='pl-txt'>a</div></li></ul><div id=popup-baohanh-content><div class=warranty-box><h2 class=title>W</h2><span>12</span></div>"
             "<div class=change-box><div class=block-change><h3>T</h3><div class=content-insider>x<br>y</div></div></div></div>")
    got = {r.page_id: r.policies for r in L.policies(rows_of(spark, whole, whole.replace("<span>12</span>", ""), "<p>x</p>", whole.replace("<h3>T</h3>", ""))).collect()}
    assert got[0].commitments == ["a"] and tuple(got[0].warranty_policy) == ("W", "12") and got[0].change_policy == {"T": "x\ny"}
    assert got[1] is None and got[3] is None  # a part that is missing
    assert got[2].commitments == [] and got[2].warranty_policy is None and got[2].change_policy is None


def test_breadcrumb_forms(spark):
    block = '<script type="application/ld+json">{}</script>'
    crumbs = '{"@type": "BreadcrumbList", "itemListElement": [{"item": {"name": "A"}}, {"x": 1}, {"item": {"name": "B"}}]}'
    pages = [block.format('{"a": 1}') + block.format(crumbs), block.format("BreadcrumbList {"), "", None, block.format('{"@type": "BreadcrumbList"}'), block.format('"BreadcrumbList"')]
    got = spark.createDataFrame([(k, "u", h) for k, h in enumerate(pages)], PAGES).select("page_id", L.breadcrumb(F.col("html")).alias("b")).collect()
    assert [r.b for r in sorted(got)] == [["A", "B"], [], [], [], [], []]


def test_records_isolate_a_failing_section(spark):
    page = "<div class='box-detail-product'><div class='box-product-name'><h1>{}</h1></div>{}</div>"
    variants = "<div class='box-product-variants'><ul><li class='item-variant'>{}<strong class='item-variant-name'>Red</strong></li></ul></div>"
    untitled = "<div class=tech-specs><p>x</p></div>"
    htmls = [page.format("N", variants.format("<a href=/r></a>")), page.format("N", variants.format("")), page.format("", ""), page.format("N", untitled), "<p>no box</p>"]
    pages = spark.createDataFrame([(k, "https://shop-b.example/p", h) for k, h in enumerate(htmls)] + [(99, "https://other.example/", htmls[0]), (100, None, htmls[0])], PAGES)
    got = {r.page_id: r for r in L.assemble_products(pages).collect()}
    assert {k: r.status for k, r in got.items()} == {0: "success", 1: "success", 2: "no_name_found", 3: "error: a section has no title"}
    assert '"Red"' in got[0].product_data and "colors" not in got[1].product_data and got[3].product_name == "N"


def test_a_section_and_a_record_shuffle_the_rows_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pages = spark.range(50).select(F.col("id").alias("page_id"), F.lit("https://shop-a.example/p").alias("url"), F.lit("<section class=detail><h1>x</h1></section>").alias("html"))
        for section in {s for layout in L.LAYOUTS for s in layout.sections}:
            assert exchanges(section(tag_rows(pages))) == (1, 0), section
        assert exchanges(L.assemble_products(pages, L.LAYOUTS[:1])) == (1, 4)  # the container and four sections read the same shuffle
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scopes_found_at_once_equal_those_of_windows(spark):
    import random

    from shelfmatch.operators.elements import Scope, with_scopes

    rng = random.Random(5)
    piece = lambda: rng.choice(["<div class=a>", "<div class='a b'>", "<p>", "<span>", "</div>", "</p>", "</span>", "<img class=a>", "<br/>", "x", " "])
    htmls = ["".join(piece() for _ in range(rng.randint(0, 40))) for _ in range(120)] + [None, "", "no tag"]
    rows = rows_of(spark, *htmls)
    a, p, s = (is_element(*x) for x in (("div", "a"), ("p",), ("span",)))
    scopes = [Scope("x", a), Scope("y", p, "x", True), Scope("z", s, None, True), Scope("w", s, "x", "page"), Scope("v", p, "x")]
    slow = rows
    for scope in scopes:
        slow = with_scope(slow, scope.name, scope.opens, "page_id", scope.inside, scope.first)
    names = [x.name for x in scopes]
    fast = {(r.page_id, r.pos): tuple(r[n] for n in names) for r in with_scopes(rows, scopes).collect()}
    want = {(r.page_id, r.pos): (tuple(r[n] for n in names), r.text) for r in slow.select("page_id", "pos", "text", *names).collect()}
    assert fast and all(want[k][0] == v for k, v in fast.items())
    gone = want.keys() - fast.keys()
    assert all(pos and (not text or not any(x is not None for x in found)) for (_, pos), (found, text) in want.items() if (_, pos) in gone)


def test_whole_pages_whatever_the_batches_are():
    import pyarrow as pa

    from shelfmatch.operators.elements import _whole_pages

    keys, pos = [1, 1, 1, 2, 2, 2, 2, None, None, 3, 3], [0, 1, 2, 0, 1, 0, 1, 0, 1, 4, 5]  # two pages of key 2
    rows = pa.record_batch({"k": pa.array(keys), "pos": pa.array(pos)})
    starts = {0, 3, 5, 7, 9, 11}
    for size in range(1, 12):
        batches = [rows.slice(i, size) for i in range(0, 11, size)]
        got = [t.num_rows for t in _whole_pages(iter(batches))]
        assert sum(got) == 11 and {sum(got[:i]) for i in range(len(got) + 1)} <= starts


def test_derived_pages_are_dealt_before_they_are_cut(spark):
    from shelfmatch.plans.shop_pages import _pages

    assert _pages(spark, "/root/testdata/sf0.001", "a", "<p>{p_name}</p>").rdd.getNumPartitions() >= 32  # the file of parts is one task


def test_tags_without_quotes_are_cut_without_patterns_and_give_the_same_parts(spark):
    html = ("<A>x</A ><a/>y<a b=1>z<a class = 'p  q' x='>' id=\"i>1\">t > u</a><br/><q'r s='>'>v<b c=\"'\">w<d CLASS=k ID=n>e<!-- <i> --><f\t>g"
            "<SCRIPT><h></script>&lt;<u\nclass=\"\">")
    rows = tag_rows(spark.createDataFrame([(1, html), (2, None), (3, "<p>plain")], "page_id long, html string")).orderBy("page_id", "pos").collect()
    got = [(r.page_id, r.kind, r.tag, r.classes, r.id, r.text) for r in rows]
    none = [""]
    assert got == [
        (1, 1, "a", none, None, "x"), (1, -1, "a", none, None, ""), (1, 0, "a", none, None, "y"), (1, 1, "a", none, None, "z"),
        (1, 1, "a", ["p", "q"], "i>1", "t > u"), (1, -1, "a", none, None, ""), (1, 0, "br", none, None, ""), (1, 1, "q'r", none, None, "v"),
        (1, 1, "b", none, None, "w"), (1, 1, "d", ["k"], "n", "e "), (1, 1, "f", none, None, "g <"), (1, 1, "u", none, None, ""), (3, 1, "p", none, None, "plain")]


def test_only_openings_send_attributes_through_the_shuffle(spark):
    from shelfmatch.operators.elements import Scope, is_element, with_scopes

    rows = tag_rows(spark.createDataFrame([(1, "<p class=a>x<b class=c>y</b></p>")], "page_id long, html string"))
    sent = with_scopes(rows, [Scope("s", is_element("p"))], carry=("text", "attrs", "classes")).orderBy("pos").collect()
    assert [(r.text, r.attrs, r.classes, r.s) for r in sent] == [("x", " class=a", ["a"], 0), ("y", None, None, 0)]



def test_tags_cut_by_position_equal_those_of_the_pattern(spark):
    import random

    from shelfmatch.operators.elements import Opens, Scope, with_scopes

    rng = random.Random(3)
    pieces = ["<div class=a>", "<div class='a b'>", "<DIV id=\"q\" CLASS=\"b  a\">", "<div class='&#97;' id='&#113;'>", "<p>", "<span>", "</div>", "</p>", "</Span >", "<br/>", "x", " ",
              "é", "lab", "&amp;&nbsp;", "&#38;#65;", "a < b", "<p\tclass\x0b=\x0ba>", "<div class>", "<p class=''>", "<p class=' a '>", "<span class=c>lab</span>", "<İ>", "\n"]
    odd = ["<img class=a src='x>y'>", "<", "</", "</ p>", "</3>", "<p class='a", "'", "\"", ">", "<a\"b c\">", "<q'r s='>'>", "<p x='\"' y=\"'\">", "<!-- <p> -->", "<style>p > a</style>", "<!--"]
    page = lambda some: "".join(rng.choice(some) for _ in range(rng.randint(0, 40)))
    htmls = [page(pieces) for _ in range(300)] + [page(pieces + odd) for _ in range(300)] + [None, "", "no tag", "<p", "<p>", "<"]
    pages = spark.createDataFrame([(k, f"u{k % 3}", h) for k, h in enumerate(htmls)], PAGES).repartition(3)
    scopes = [Scope("x", Opens("div", ("a",))), Scope("y", Opens("p"), "x", True), Scope("w", Opens("span", without=("c",)), "x", "page"), Scope("i", Opens("div", id="q")),
              Scope("l", Opens("span", text="lab")), Scope("f", Opens("div"), None, False, "l"), Scope("g", Opens(None, ("a",))), Scope("o", None, None, False, None, ("x", "i"))]
    carry, names = ("text", "attrs", "classes", "url"), [s.name for s in scopes]
    by_pattern = {(r.page_id, r.pos): r for r in with_scopes(tag_rows(pages, keep=("url",)), scopes, carry=carry).collect()}
    by_place = {(r.page_id, r.pos): r for r in tag_rows(pages, keep=("url",), scopes=scopes, carry=carry).collect()}
    assert by_place and all(by_pattern[k] == r for k, r in by_place.items())
    gone = [r for k, r in by_pattern.items() if k not in by_place]  # without text, and no scope's element begins there
    assert not any(r.pos == 0 or r.pos in [r[n] for n in names] or (r.text and any(r[n] is not None for n in names)) for r in gone)


def test_sections_of_pages_make_no_row_of_a_tag_they_do_not_read(spark):
    pages = spark.range(9).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("<b>" * 50 + "<p>x</p>").alias("html"))
    for section in {s for layout in L.LAYOUTS for s in layout.sections}:
        plan = section(pages)._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and plan.count("MapInArrow") == 1, section
    assert L.dealt(pages, L.policies).count() == 9  # the first row of each page
    assert sorted(map(tuple, L.policies(pages).collect())) == sorted(map(tuple, L.policies(tag_rows(pages)).collect()))


def test_texts_are_stripped_of_all_white_space(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([" a ", "b", "\u2003é\x1f", "c\n", "", "\xa0", "~", "\x1cd"])], "pos int, text string")
    assert rows.agg(texts(F.lit(True), "|").alias("t")).first().t == "a|b|é|c|~|d"


def test_prices_per_colour_neither_broadcast_pages_nor_cut_them_twice(spark):
    """Derived pages are guessed to be as few bytes as their table's file, so a broadcast of millions of them failed in the driver."""
    link = "<div class=scrolling_inner><div class='box03 color group desk'><a class=box03__item href='{}'>{}</a></div></div>"
    price = "<div class='price-one'><p class='box-price-present'>{}</p></div>"
    made = [(1, "/p/1", link.format("/c/1", "red")), (2, "/p/2", link.format("/c/none", "blue")), (3, "/c/1", price.format("10")), (3, "/c/1", price.format("10")),
            (None, "/p/3", link.format("/c/2", "green")), (4, "/c/2", price.format("20")), (4, "/c/3", None), (5, "/p/5", link.format("/c/3", "grey")), (None, "/c/4", price.format("30")),
            (6, "/p/6", link.format("/c/4", "pink"))]
    found = L.prices_per_colour(spark.createDataFrame(made, PAGES).repartition(3))
    got = [(r.page_id, r.color, r.current_price) for r in found.collect()]
    # a page that comes twice gives its links' rows twice, its price being the joined text; a key names its addresses, a null key none
    assert sorted(got, key=str) == sorted([(1, "red", "1010"), (1, "red", "1010"), (None, "green", "20"), (5, "grey", "20")], key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
    assert plan[:plan.index("== Initial Plan ==")].count("MapInArrow") == 1
