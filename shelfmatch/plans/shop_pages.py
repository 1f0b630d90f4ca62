"""Queries of the shop page sections (X2-X18) and of the product record (X21) over pages derived from ``part``.

Each part gives a page of one layout, written by column expressions with the cases that tell rules apart: missing
parts, repeated names, nested markup, decoys outside the boxes.  The SQL computes the wanted fields from the columns of ``part``
and knows nothing of HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators import layouts as L
from shelfmatch.plans.registry import query
from shelfmatch.plans.tables import table


def _html(*parts: str | Column) -> Column:
    """The parts in a row; text in braces is a column of the table."""
    out = []
    for part in parts:
        if isinstance(part, Column):
            out.append(F.coalesce(part, F.lit("")))
            continue
        for k, piece in enumerate(part.replace("}", "{").split("{")):
            out.append(F.col(piece).cast("string") if k % 2 else F.lit(piece))
    return F.concat(*out)


def _every(n: int, *parts: str | Column, at: int = 0, other: str = "") -> Column:
    """The parts on every n-th product."""
    return F.when(F.col("p_partkey") % n == at, _html(*parts)).otherwise(_html(other))


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    """``part``, dealt to all cores: a row of its few and small files becomes a page of a hundred tags."""
    return table(spark, sf, "part").repartition(max(4 * spark.sparkContext.defaultParallelism, 32), "p_partkey")


def _pages(spark: SparkSession, sf: str, shop: str, *body: str | Column) -> DataFrame:
    part = _parts(spark, sf)
    html = _html("<!DOCTYPE html><html><head><title>t</title><style>p > a {color}".replace("{color}", "color"), "</style></head><body>", *body, "</body></html>")
    return part.select(F.col("p_partkey").alias("page_id"), F.concat(F.lit(f"https://shop-{shop}.example/p/"), F.col("p_partkey").cast("string")).alias("url"), html.alias("html"))


def _layout_a() -> list:
    specs = [
        "<div class='other'><h3>No</h3><ul><li><aside>a</aside><aside>b</aside></li></ul></div>",
        "<div class=\"box-specifi\"><h3><a>Screen</a></h3><ul class='text-specifi'><li><aside><strong>Size:</strong></aside><aside><span>{p_size}</span>\n <span>inch</span></aside></li>",
        "<li><aside>Note</aside></li>", _every(3, "<li><aside>A</aside><aside>B</aside><aside>C</aside></li>"),
        "<li><aside> Type: </aside><aside>{p_type}<br>&amp; more</aside></li><li><aside>Void:</aside><aside></aside></li></ul></div>",
        _every(4, "<div class=box-specifi><ul><li><aside>x</aside><aside>y</aside></li></ul></div>"),
        "<div class='wide box-specifi'><h3>Make</h3><ul><li><aside>Brand:</aside><aside>{p_brand}</aside></li><li><aside>Brand</aside><aside>then {p_brand}</aside></li></ul></div>",
        _every(5, "<div class='box-specifi'><h3>Screen</h3><ul><li><aside>Only</aside><aside>{p_name}</aside></li></ul></div>"),
        _every(7, "<div class='box-specifi'><h3>Empty</h3><ul></ul></div>"),
    ]
    policies = [
        _every(2, "<ul class='x policy__list'><li><div class=pl-txt>Care <b>{p_size}</b> days</div></li><li><div class='pl-txt'></div></li><li>no box</li></ul>"),
        "<div class='pl-txt'>outside</div>",
        _every(3, "", other="<div id='popup-baohanh-content'>"),
        _every(6, "", at=1, other="<div class=warranty-box><h2 class=title>Warranty {p_brand}</h2>"),
        F.when(~F.expr("p_partkey % 12 = 2 OR p_partkey % 6 = 1"), _html("<span>for {p_size} months</span><span>second</span>")), _every(6, "", at=1, other="</div>"),
        "<div class='change-box'><div class='block-change'><h3>Days</h3><div class='content-insider'><p>one</p><p> {p_type} </p></div></div>",
        "<div class='block-change'><h3>Nothing</h3></div><div class='block-change'><h3></h3><div class=content-insider>untitled</div></div>",
        _every(5, "<div class='block-change'><h3>Days</h3><div class='content-insider'>later {p_size}</div></div>"), "</div></div>",
    ]
    basics = [
        _every(3, "", other="<ul class='breadcrumb x'><li><a>Home</a></li><li><a> <b>{p_type}</b> </a></li></ul>"), "<div class='product-name'>",
        _every(11, "", other="<h1>{p_name} <i>{p_partkey}</i></h1>"), _every(2, "<span class='quantity-sale'>Sold {p_size}</span>"),
        "<div class='detail-rate'><p>4.<b>5</b></p></div></div><span class='quantity-sale'>outside</span>",
        _every(5, "", other="<div class='group-box03'>"), "<div class='box03 group'>", _every(4, "", other="<a class='item act'>{p_size}GB</a><a class=act>second</a>"), "<a>1TB</a></div>",
        "<div class='box03 color group'><a class='act'>{p_type}</a><a> Red <i>2</i></a></div>", _every(5, "", other="</div>"),
    ]
    return ["<section class='", _every(13, "broken", other="detail"), "'>", *basics, *specs, *policies, "</section>"]


@query("layout_basics_a", """
SELECT p_partkey AS page_id, CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN NULL ELSE trim(p_name) || p_partkey END AS product_name,
       CASE WHEN p_partkey % 2 = 0 AND p_partkey % 13 <> 0 THEN 'Sold ' || p_size END AS quantity_sale,
       CASE WHEN p_partkey % 13 <> 0 THEN '4.5' END AS detail_rate, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 13 <> 0 THEN 'Home|' || p_type END AS product_type,
       CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN '' ELSE p_size || 'GB' END AS selected_capacity,
       CASE WHEN p_partkey % 5 <> 0 THEN p_type || '|Red2' END AS all_colors
FROM part WHERE p_partkey % 5 <> 0 OR p_partkey % 13 <> 0
""")
def layout_basics_a(spark: SparkSession, sf: str) -> DataFrame:
    """No container, no breadcrumb, no name, no capacity chosen or several, no box of options."""
    rows = L.dealt(_pages(spark, sf, "a", *_layout_a()), L.basics_a, L.options_a)
    both = L.basics_a(rows).join(L.options_a(rows), "page_id", "full")
    return both.withColumns({c: F.array_join(c, "|") for c in ("product_type", "all_colors")})


# ------------------------------------------------------------------- X5 --
@query("layout_specifications", """
WITH s AS (
  SELECT p_partkey AS k, 1 AS g, 'Screen' AS grp, 'Size' AS name, p_size || ' inch' AS value FROM part WHERE p_partkey % 5 <> 0
  UNION ALL SELECT p_partkey, 1, 'Screen', 'Type', p_type || ' & more' FROM part WHERE p_partkey % 5 <> 0
  UNION ALL SELECT p_partkey, 1, 'Screen', 'Void', '' FROM part WHERE p_partkey % 5 <> 0
  UNION ALL SELECT p_partkey, 1, 'Screen', 'Only', trim(p_name) FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT p_partkey, 2, 'Make', 'Brand', 'then ' || p_brand FROM part
  UNION ALL SELECT p_partkey, 3, 'Empty', NULL, NULL FROM part WHERE p_partkey % 7 = 0)
SELECT k AS page_id, grp AS spec_group, name AS spec_name, value AS spec_value FROM s
""")
def layout_specifications(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of one or three cells, a group without heading, a repeated group and key, an empty value and an empty group."""
    found = L.specifications(_pages(spark, sf, "a", *_layout_a()))
    groups = found.select("page_id", F.explode("specifications").alias("spec_group", "pairs"))
    return groups.select("page_id", "spec_group", F.explode_outer("pairs").alias("spec_name", "spec_value"))


# ------------------------------------------------------------------- X6 --
@query("layout_policies", """
SELECT p_partkey AS page_id, p_partkey % 12 = 2 AS broken,
       CASE WHEN p_partkey % 12 = 2 THEN NULL WHEN p_partkey % 2 = 0 THEN 'Care' || p_size || 'days|' ELSE '' END AS commitments,
       CASE WHEN p_partkey % 12 = 2 OR p_partkey % 3 = 0 OR p_partkey % 6 = 1 THEN NULL ELSE 'Warranty ' || p_brand END AS warranty_title,
       CASE WHEN p_partkey % 12 = 2 OR p_partkey % 3 = 0 OR p_partkey % 6 = 1 THEN NULL ELSE 'for ' || p_size || ' months' END AS warranty_details,
       CASE WHEN p_partkey % 12 = 2 OR p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'later ' || p_size ELSE 'one' || chr(10) || p_type END AS days,
       CASE WHEN p_partkey % 12 = 2 OR p_partkey % 3 = 0 THEN NULL ELSE 'untitled' END AS no_title,
       CASE WHEN p_partkey % 12 = 2 OR p_partkey % 3 = 0 THEN NULL ELSE 2 END AS n_blocks
FROM part
""")
def layout_policies(spark: SparkSession, sf: str) -> DataFrame:
    """A commitment without text, blocks without text or title, a repeated title, no pop-up, no warranty box, one that lacks its text."""
    found = L.policies(_pages(spark, sf, "a", *_layout_a()))
    p, change = F.col("policies"), F.col("policies.change_policy")
    return found.select(
        "page_id", p.isNull().alias("broken"), F.array_join(p["commitments"], "|").alias("commitments"), p["warranty_policy"]["title"].alias("warranty_title"),
        p["warranty_policy"]["details"].alias("warranty_details"), change["Days"].alias("days"), change[""].alias("no_title"),
        F.when(change.isNotNull(), F.size(change)).alias("n_blocks"))


# ------------------------------------------------------------------ X17 --
def _layout_c() -> list:
    general = "relative flex flex-col gap-2.5 rounded-[0.375rem] border"
    promotions = [
        "<p>before any box</p>", _every(4, "", other=f"<div class='{general}'><p>Gift <b>{{p_size}}</b></p><div><p> {{p_type}} </p></div><p></p></div>"),
        f"<div class='{general}'><p>a second box</p></div><p class='text-textOnWhitePrimary'>outside</p>",
        _every(5, "", other="<div class='flex flex-col pc:flex-col-reverse pc:gap-3'>"),
        "<div class='swiper-wrapper'><div class='swiper-slide'><img alt=' Pay {p_brand} ' src='/i/{p_partkey}.png?a=1&amp;b=2'></div><div class='swiper-slide'>no image</div>",
        _every(3, "<div class='swiper-slide'><a><img src='/second.png'></a><img alt=third></div>"), "</div>",
        "<div class='flex flex-col gap-3 x'><p class='text-textOnWhitePrimary y'>Extra {p_name} <a>Xem chi tiết</a></p><p class='text-textOnWhitePrimary'><a>Xem chi tiết</a></p><p>plain</p>",
        _every(2, "<p class=text-textOnWhitePrimary>Even</p>"), "</div></div>",
    ]
    button = "<button class='b {0}'>{1}{2}</button>"
    text = "<span class='block text-textOnWhitePrimary b2-medium'>{0}</span>"
    options = [
        "<div class='grid gap-y-3 pb-4 pt-3 pc:gap-y-2 pc:py-0'>", _every(7, "<span>Dung</span><div class=s>", other="<span class=l>Dung lượng</span><div class=s>"),
        button.replace("{0}", "Selection_buttonSelect__7lW_h").replace("{1}", text.replace("{0}", "{p_size} GB")).replace("{2}", ""),
        button.replace("{0}", "").replace("{1}", text.replace("{0}", "<i>2</i> TB")).replace("{2}", ""), "<button>no text</button></div>",
        "<span>Màu sắc</span><div class=s>", button.replace("{0}", "").replace("{1}", text.replace("{0}", "{p_type}")).replace("{2}", "<img src='/c/{p_partkey}'>"),
        button.replace("{0}", "x").replace("{1}", text.replace("{0}", "No image")).replace("{2}", ""), "<button><img src='/no-text'></button>",
        _every(2, button.replace("{0}", "Selection_buttonSelect__7lW_h").replace("{1}", "<img src='/first'>").replace("{2}", text.replace("{0}", "Even"))), "</div></div>",
    ]
    name = _every(11, "<h1>no name</h1>", other="<h1 class='pc:l6-semibold text-textOnWhitePrimary b2-medium'>{p_name}</h1>")
    basics = [
        _every(4, "", other="<nav class='Breadcrumb'><ul><li><a><span>Home</span></a></li><li><a></a></li><li>no link</li><li><a>{p_type}</a><a>second</a></li></ul></nav>"),
        _every(3, "", other="<div class='ml-1.5 flex items-center gap-1'><div class='text-textOnWhitePrimary b2-regular'>4.8</div></div>"),
        "<div class='ml-1 cursor-pointer text-textOnWhiteHyperLink f1-medium pc:b2-medium'>{p_size} votes</div>",
        _every(5, "", other="<section id='tradePrice'>"), "<span class='h4-bold'>{p_size}.990.000<i>₫</i></span>", _every(2, "<span class='text-neutral-gray-5 line-through'>call us</span>"),
        "<span class='text-red-red-7'>10%</span><span class='text-yellow-yellow-7 b2-medium'>+{p_size}.497 Điểm</span>", _every(5, "", other="</section>"),
        _every(7, "", other="<div class='flex flex-col gap-2 px-4 pb-4 pt-3'>"),
        "<div class='relative grid h-14'><p class='line-clamp-2'>Care {p_size}</p><span class='text-textOnWhiteBrand'>1.{p_partkey}₫</span></div>",
        "<div class='relative grid h-14'><span class='text-textOnWhiteDisable line-through'>2.000₫</span></div>", _every(7, "", other="</div>"),
    ]
    return ["<div id=ThongTinSanPham>", name, *basics, *options, *promotions, "</div>"]


@query("layout_basics_c", """
SELECT p_partkey AS page_id, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'Home|' || p_type END AS product_type, CASE WHEN p_partkey % 11 <> 0 THEN trim(p_name) END AS product_name,
       CASE WHEN p_partkey % 3 <> 0 THEN '4.8' END AS rating_score, p_size || ' votes' AS rating_count,
       CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size || '990000' AS BIGINT) END AS current_price, CAST(NULL AS BIGINT) AS original_price,
       CASE WHEN p_partkey % 5 <> 0 THEN '10%' END AS discount_percent, CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size || '497' AS BIGINT) END AS reward_points,
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'Care ' || p_size || ' 1' || p_partkey || ' -|- - 2000' END AS warranties
FROM part
""")
def layout_basics_c(spark: SparkSession, sf: str) -> DataFrame:
    """Empty breadcrumb links, prices that are no numbers, no price box, packages without title or prices."""
    rows = L.dealt(_pages(spark, sf, "c", *_layout_c()), L.basics_c, L.price_c, L.extended_warranty_c)
    out = L.basics_c(rows).join(L.price_c(rows), "page_id").join(L.extended_warranty_c(rows), "page_id")
    line = F.transform("extended_warranty", lambda w: F.concat_ws(" ", *[F.coalesce(w[f].cast("string"), F.lit("-")) for f in ("title", "current_price", "original_price")]))
    return out.withColumns({"product_type": F.array_join("product_type", "|"), "warranties": F.array_join(line, "|")}).drop("extended_warranty")


@query("layout_promotions", """
SELECT p_partkey AS page_id,
       CASE WHEN p_partkey % 4 = 0 THEN 'a second box' ELSE 'Gift' || p_size || '|' || p_type || '|' END AS general_promotions,
       CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'Pay ' || p_brand || ' /i/' || p_partkey || '.png?a=1&b=2' || CASE WHEN p_partkey % 3 = 0 THEN '| /second.png' ELSE '' END END AS payment_promotions,
       CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'Extra ' || trim(p_name) || CASE WHEN p_partkey % 2 = 0 THEN '|Even' ELSE '' END END AS other_promotions
FROM part
""")
def layout_promotions(spark: SparkSession, sf: str) -> DataFrame:
    """Items before any box, a second box, slides without image or description, texts of the label alone, no payment box."""
    found = L.promotions(_pages(spark, sf, "c", *_layout_c()))
    payment = F.transform("payment_promotions", lambda p: F.concat_ws(" ", p["description"], p["image_url"]))
    return found.select("page_id", F.array_join("general_promotions", "|").alias("general_promotions"), F.array_join(payment, "|").alias("payment_promotions"),
                        F.array_join("other_promotions", "|").alias("other_promotions"))


# ------------------------------------------------------------------ X15 --
@query("layout_options", """
SELECT p_partkey AS page_id,
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_size || ' GB true|2TB false' END AS storage_options,
       p_type || ' /c/' || p_partkey || ' false' || CASE WHEN p_partkey % 2 = 0 THEN '|Even /first true' ELSE '' END AS color_options
FROM part
""")
def layout_options(spark: SparkSession, sf: str) -> DataFrame:
    """Buttons without text, colours without image or text, image before text, no storage label."""
    found = L.stateful_options(_pages(spark, sf, "c", *_layout_c()))
    joined = lambda c, *fields: F.array_join(F.transform(c, lambda o: F.concat_ws(" ", *[o[f].cast("string") for f in fields])), "|")
    return found.select("page_id", joined("storage_options", "value", "is_selected").alias("storage_options"),
                        joined("color_options", "name", "image_url", "is_selected").alias("color_options"))


# ------------------------------------------------------------------- X9 --
def _layout_b() -> list:
    options = [
        "<div class='box-product-price'>", _every(3, "", other="<div class='sale-price'>{p_size}.990.000₫</div>"), _every(2, "<del class=base-price>{p_retailprice} đ</del>"), "</div>",
        "<a class='item-linked' href='/decoy'><strong>Decoy</strong></a><div class='box-linked'><a class='item-linked active' href='/v/{p_partkey}?x=1&amp;y=2'><strong>{p_size} GB</strong><span>1</span></a>",
        "<a class='item-linked' href='/none'>no name</a>", _every(4, "", other="<a class='inactive item-linked'><strong>No <b>link</b></strong></a>"),
        _every(5, "<a class=item-linked href=/again><strong>{p_size} GB</strong></a>"), "</div>",
        "<div class='box-product-variants'><ul><li class='item-variant active'><a href='/c/{p_partkey}'><strong class='item-variant-name'>{p_type}</strong></a></li>",
        "<li class='item-variant'><a href='/c/red'><strong class='item-variant-name'>Red</strong><span class='item-variant-price'>{p_partkey} đ</span></a></li>",
        "<li class='item-variant'><a href='/c/x'>no name</a></li>", _every(9, "<li class='item-variant'><strong class='item-variant-name'>No link</strong></li>"), "</ul></div>",
    ]
    row = "<tr class='technical-content-item'><td>{0}</td><td>{1}</td>{2}</tr>"
    table_rows = row.replace("{0}", "Weight").replace("{1}", "{p_size} <b>g</b>").replace("{2}", "<td>third</td>") + "<tr class='technical-content-item'><td>alone</td></tr><tr><td>a</td><td>b</td></tr>"
    section = "<div class='technical-content-section'><p class='title'>{t}</p><table>" + table_rows + "</table></div>"
    tables = [
        _every(6, "<div class='teleport-modal_content'>", section.replace("{t}", "First"), section.replace("{t}", "Second"), "</div>"),
        _every(6, "<div class='modal x'>", section.replace("{t}", "In modal"), "</div>", at=1), _every(6, "<div class='overlay'>", section.replace("{t}", "In overlay"), "</div>", at=2),
        _every(6, "<div class='tech-specs'><p class=title>Specs</p><table>", table_rows, "</table></div>", at=3),
        _every(6, "<div class='popup'><div class='technical-content-section'><p>untitled</p></div></div>", at=4),
        section.replace("{t}", "In no box"), "<div class='tech-specs'><p class=title>Last</p></div>",
    ]
    name = _every(11, "", other="<div class='box-product-name'><h1>{p_name}</h1></div>")
    basics = [
        _every(3, "", other="<div class='box-rating'><span class='total-rating'>({p_size} votes)</span><span>4.9</span><span>x</span></div>"),
        "<div class='box-bottom-item'><span class='label'>Like</span><span class='label'>second</span></div><div class='box-bottom-item'><span>none</span></div>",
        _every(2, "<div class='pdp-compare-button-box'><a class='x label'>Compare <b>{p_type}</b></a></div>"),
    ]
    boxes = [
        _every(2, "<section class='box-product-promotion-header'><i></i><span>Deal {p_brand}</span><span>no</span></section>"),
        "<div class='promotion-pack_item'><p class='box-product-promotion-detail'>Save <b>{p_size}</b> <a href='/d/{p_partkey}'>now</a><a href=/no>!</a></p></div>",
        "<div class='promotion-pack_item'>no detail</div>", _every(4, "", other="<li class='promotion-pack_item'><div class='box-product-promotion-detail'>Plain <a>link</a></div></li>"),
        _every(3, "<div class=box-more-promotion-title><span>Pay</span></div>"), "<div class='render-promotion'><ul><li>One <a href='/1?a=1&amp;b=2'>x</a></li><li></li></ul><li>outside</li></div>",
        "<div class='box-warranty-info'><div class=box-title>", _every(5, "<p>Care</p>"), "</div></div>",
        "<div class='item-warranty-info'><div class='description'>New <i>{p_type}</i></div><div class='description'><a href=/w>Return</a></div></div><div class='description'>outside</div>",
    ]
    return ["<div class='box-detail-product'>", name, *basics, *boxes, *options, *tables, "</div>"]


@query("layout_basics_b", """
SELECT p_partkey AS page_id, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE trim(p_name) END AS product_name, CASE WHEN p_partkey % 3 <> 0 THEN '4.9' END AS rating_score,
       CASE WHEN p_partkey % 3 <> 0 THEN p_size || ' votes' END AS total_ratings, 'Like' || CASE WHEN p_partkey % 2 = 0 THEN '|Compare' || p_type ELSE '' END AS actions FROM part
""")
def layout_basics_b(spark: SparkSession, sf: str) -> DataFrame:
    """No name, no rating, the count before the score, items without a label, no compare button."""
    found = L.basics_b(_pages(spark, sf, "b", *_layout_b()))
    return found.withColumn("actions", F.array_join("actions", "|"))


@query("layout_promotion_boxes", """
SELECT p_partkey AS page_id, CASE WHEN p_partkey % 2 = 0 THEN 'Deal ' || p_brand ELSE 'Khuyến mãi' END AS promotion_title,
       'Save ' || p_size || ' now ! /d/' || p_partkey || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '|Plain link -' END AS promotions,
       CASE WHEN p_partkey % 3 = 0 THEN 'Pay' ELSE 'Ưu đãi thanh toán' END AS payment_title, 'One x /1?a=1&b=2| -' AS payments,
       CASE WHEN p_partkey % 5 = 0 THEN 'Care' ELSE 'Cam kết sản phẩm' END AS commitment_title, 'New ' || p_type || ' -|Return /w' AS commitments
FROM part
""")
def layout_promotion_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Titles and their defaults, several links in an item or none, a link without address, empty items, items outside."""
    rows = L.dealt(_pages(spark, sf, "b", *_layout_b()), L.promotions_b, L.payment_promotions_b, L.commitments_b)
    out = L.promotions_b(rows).join(L.payment_promotions_b(rows), "page_id").join(L.commitments_b(rows), "page_id")
    joined = lambda c: F.array_join(F.transform(c, lambda i: F.concat(i["detail"], F.lit(" "), F.coalesce(i["link"], F.lit("-")))), "|")
    return out.select("page_id", F.col("promotions.title").alias("promotion_title"), joined(F.col("promotions.items")).alias("promotions"),
                      F.col("payment_promotions.title").alias("payment_title"), joined(F.col("payment_promotions.items")).alias("payments"),
                      F.col("commitments.title").alias("commitment_title"), joined(F.col("commitments.items")).alias("commitments"))


@query("layout_versions_colors", """
WITH v AS (
  SELECT p_partkey AS k, 'version' AS kind, p_size || ' GB' AS name, NULL AS price, CASE WHEN p_partkey % 5 = 0 THEN '/again' ELSE '/v/' || p_partkey || '?x=1&y=2' END AS link,
         p_partkey % 5 <> 0 AS is_active FROM part
  UNION ALL SELECT p_partkey, 'version', 'Nolink', NULL, NULL, false FROM part WHERE p_partkey % 4 <> 0
  UNION ALL SELECT p_partkey, 'color', p_type, NULL, '/c/' || p_partkey, true FROM part
  UNION ALL SELECT p_partkey, 'color', 'Red', p_partkey || ' đ', '/c/red', false FROM part)
SELECT k AS page_id, kind, name, v.price, link, is_active, CASE WHEN k % 3 = 0 THEN NULL ELSE p_size || '.990.000₫' END AS sale_price, k % 2 = 0 AS has_base_price
FROM v JOIN part ON p_partkey = k WHERE k % 9 <> 0
""")
def layout_versions_colors(spark: SparkSession, sf: str) -> DataFrame:
    """Missing prices and links shift nothing, items without a name and outside the box are left out, a repeated version, a colour
    without any link empties the section."""
    found = L.priced_options(_pages(spark, sf, "b", *_layout_b())).where("NOT broken")
    versions = F.transform(F.map_entries("versions"), lambda e: F.struct(
        F.lit("version").alias("kind"), e["key"].alias("name"), F.lit(None).cast("string").alias("price"), e["value"]["url"].alias("link"), e["value"]["is_active"].alias("is_active")))
    colours = F.transform(F.map_entries("colors"), lambda e: F.struct(
        F.lit("color").alias("kind"), e["key"].alias("name"), e["value"]["price"].alias("price"), e["value"]["url"].alias("link"), e["value"]["is_active"].alias("is_active")))
    rows = found.select("page_id", "sale_price", F.col("base_price").isNotNull().alias("has_base_price"), F.inline(F.concat(versions, colours)))
    return rows.select("page_id", "kind", "name", "price", "link", "is_active", "sale_price", "has_base_price")


# ------------------------------------------------------------------ X13 --
@query("layout_spec_table", """
SELECT p_partkey AS page_id, section, CASE WHEN section IS NULL OR section = 'Last' THEN NULL ELSE 'Weight' END AS spec_name,
       CASE WHEN section IS NULL OR section = 'Last' THEN NULL ELSE p_size || ' g' END AS spec_value,
       CASE WHEN section IS NULL THEN 'a section has no title' END AS error
FROM (SELECT p_partkey, p_size, unnest(CASE p_partkey % 6 WHEN 0 THEN ['First', 'Second'] WHEN 1 THEN ['In modal'] WHEN 2 THEN ['In overlay']
        WHEN 3 THEN ['Specs', 'Last'] WHEN 4 THEN [NULL] ELSE ['Last'] END) AS section FROM part)
""")
def layout_spec_table(spark: SparkSession, sf: str) -> DataFrame:
    """Each alternative is the first for some pages; rows of one and three cells, rows of another class, a section without title."""
    found = L.spec_table(_pages(spark, sf, "b", *_layout_b()))
    sections = found.select("page_id", "error", F.explode_outer("spec_table").alias("section", "pairs"))
    return sections.select("page_id", "section", "error", F.explode_outer("pairs").alias("spec_name", "spec_value")).select("page_id", "section", "spec_name", "spec_value", "error")


# ------------------------------------------------------------------- X4 --
@query("layout_color_prices", """
WITH c AS (SELECT *, i, p_partkey * 10 + i AS cid FROM part, (SELECT unnest(range(3)) AS i))
SELECT p_partkey AS page_id, p_type || ' ' || i AS color,
       CASE (p_partkey + i) % 3 WHEN 0 THEN p_size || '.000₫' WHEN 1 THEN 'sale ' || cid ELSE '' END AS current_price,
       CASE WHEN (p_partkey + i) % 3 = 0 AND i = 1 THEN 'was ' || cid WHEN (p_partkey + i) % 3 = 1 THEN 'em' ELSE '' END AS original_price,
       CASE (p_partkey + i) % 3 WHEN 1 THEN '-5%' ELSE '' END AS discount,
       CASE (p_partkey + i) % 3 WHEN 0 THEN '0%' ELSE '' END AS installment_info,
       CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS location,
       CASE WHEN i = 2 THEN '' ELSE 'Promo' END AS promo_title, CASE WHEN i = 2 THEN '' ELSE 'a' || p_size || '|b' END AS promo_list,
       '+' || cid AS loyalty_points
FROM c WHERE i < 2 OR p_partkey % 4 <> 0
""")
def layout_color_prices(spark: SparkSession, sf: str) -> DataFrame:
    """A product page links its colours' pages, which have the primary price box, the fallback box or none; a link may lead nowhere."""
    part = _parts(spark, sf)
    link = "<a class='box03__item' href='https://shop-a.example/c/{p_partkey}0'> {p_type} 0</a>"
    links = ["<div class='scrolling_inner'><div class='box03 color group desk'>", *[link.replace("0'>", f"{i}'>").replace(" 0<", f" <i>{i}</i><") for i in range(3)],
             "</div><div class='box03 desk'><a class='box03__item' href='/other'>No</a></div></div>"]
    products = _pages(spark, sf, "a", *links)
    colours = part.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).where("i < 2 OR p_partkey % 4 <> 0").withColumn("cid", F.expr("p_partkey * 10 + i"))
    box = F.expr("(p_partkey + i) % 3")
    price = F.when(box == 0, _html(
        "<div class='bs_title'><div class='bs_price'><strong>not this</strong></div></div><div class='price-one x'><p class='box-price-present'> <b>{p_size}</b>.000₫ </p>",
        F.when(F.col("i") == 1, _html("<p class='box-price-old'>was {cid}</p>")), "<span class='label--black'>0%</span></div><p class='box-price-percent'>outside</p>"))
    price = price.when(box == 1, _html("<div class='bs_title'><div class='bs_price'><strong>sale {cid}</strong><em>em</em><i>-5%</i></div></div>")).otherwise("<strong>none</strong>")
    promo = F.when(F.col("i") < 2, _html("<div class='block__promo'><p class='pr-txtb'>Promo</p><div class='divb-right'><p>a<i>{p_size}</i></p><p>b</p></div><p>c</p></div>"))
    html = _html("<html><body>", price, F.when(F.col("p_partkey") % 2 == 0, _html("<div id='location-detail'><a>{p_brand}</a><a>two</a></div>")), promo,
                 "<p class='loyalty__main__point'>+{cid}</p></body></html>")
    colour_pages = colours.select((-F.col("cid") - 1).alias("page_id"), F.concat(F.lit("https://shop-a.example/c/"), F.col("p_partkey").cast("string"), F.col("i").cast("string")).alias("url"), html.alias("html"))
    return L.prices_per_colour(products.unionByName(colour_pages)).drop("a").withColumn("promo_list", F.array_join("promo_list", "|"))


# ------------------------------------------------------------------- X7 --
@query("layout_breadcrumb", """
SELECT p_partkey AS page_id, CASE WHEN p_partkey % 4 IN (1, 2) THEN '' ELSE 'Home|' || p_type || CASE WHEN p_partkey % 4 = 3 THEN '' ELSE '|' || p_brand END END AS breadcrumb FROM part
""")
def layout_breadcrumb(spark: SparkSession, sf: str) -> DataFrame:
    """Several JSON-LD blocks, items without a name, a block that is no JSON, none at all (D11: the page still gives a record)."""
    other = '<script type="application/ld+json">[["@type", "Product"]]</script><script>var x = "BreadcrumbList";</script>'
    item = '["item": ["name": "{0}"]]'
    block = lambda last: ('<script type="application/ld+json">\n[["@type": "BreadcrumbList", "itemListElement": [|'.replace("[[", "[") + ", ".join(
        [item.replace("{0}", "Home"), '["position": 2]', item.replace("{0}", "{p_type}"), last]) + "|]]</script>")
    as_json = lambda text: text.replace("[|", "\x01").replace("|]", "\x02").replace("[", "\x03").replace("]", "\x04")
    good, nameless = block(item.replace("{0}", "{p_brand}")), block('["item": ["id": 4]]')
    scripts = F.when(F.col("p_partkey") % 4 == 0, _html(as_json(good))).when(F.col("p_partkey") % 4 == 3, _html(as_json(nameless))).when(
        F.col("p_partkey") % 4 == 2, _html('<script type="application/ld+json">\x03"@type": "BreadcrumbList", oops</script>'))
    body = F.translate(_html(as_json(other), scripts), "\x01\x02\x03\x04", "[]{}")
    pages = _pages(spark, sf, "b", body)
    return pages.select("page_id", F.array_join(L.breadcrumb(F.col("html")), "|").alias("breadcrumb"))


# ------------------------------------------------------------------ X21 --
@query("product_records", """
SELECT p_partkey AS page_id, shop AS layout, CASE WHEN p_partkey % 11 = 0 THEN '' WHEN shop = 'A' THEN trim(p_name) || p_partkey ELSE trim(p_name) END AS product_name,
       CASE WHEN shop = 'B' AND p_partkey % 6 = 4 THEN 'error: a section has no title' WHEN p_partkey % 11 = 0 THEN 'no_name_found' ELSE 'success' END AS status,
       CASE WHEN shop = 'A' THEN 'then ' || p_brand END AS brand, CASE WHEN shop = 'B' AND p_partkey % 9 <> 0 THEN '/c/red' END AS red_link,
       CASE WHEN shop = 'C' THEN p_type END AS first_color
FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS shop FROM part) WHERE NOT (shop = 'A' AND p_partkey % 13 = 0)
""")
def product_records(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of three layouts routed by their URL, sections joined per page; pages without container, without name, with a failing section."""
    shops = [_pages(spark, sf, s, *body).where(F.col("page_id") % 3 == k) for k, (s, body) in enumerate((("a", _layout_a()), ("b", _layout_b()), ("c", _layout_c())))]
    records = L.assemble_products(shops[0].unionByName(shops[1]).unionByName(shops[2]))
    data = F.try_parse_json("product_data")
    return records.select("page_id", "layout", "product_name", "status", F.try_variant_get(data, "$.specifications.Make.Brand", "string").alias("brand"),
                          F.try_variant_get(data, "$.colors.Red.url", "string").alias("red_link"), F.try_variant_get(data, "$.color_options[0].name", "string").alias("first_color"))
