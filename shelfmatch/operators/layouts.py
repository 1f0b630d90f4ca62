"""Sections of shop pages (X2-X18) and the product record (X21), over the rows of `elements`.

A section takes tag rows and returns one row per page that has anything of it; scopes tie together what belongs to one element,
and aggregates go from the innermost scope outwards, all on the page's key, so a section adds no shuffle to the one that
dealt the rows.  Where a part that the section cannot do without is missing, the section is null for that page and
the record's others stay.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.functions.prices import parse_price, reward_points
from shelfmatch.functions.text import py_strip
from shelfmatch.operators.elements import Opens, Scope, attribute, later_wins, tag_rows, texts, whole_text, with_scopes
from shelfmatch.operators.extract import record_status

KEY = "page_id"

# --- fixed values: elements of the shops' pages (tag and classes; classes of any tag; tag and id), labels and default titles ---
ELEMENTS = {
    "detail": ("section", "detail"), "name box": ("div", "product-name"), "quantity sold": ("span", "quantity-sale"),
    "rating A": ("div", "detail-rate"), "breadcrumb A": ("ul", "breadcrumb"), "option boxes": ("div", "group-box03"), "option box": ("div", "box03"),
    "chosen option": ("a", "act"), "colour box": ("div", "box03", "color"), "colour slider": ("div", "scrolling_inner"),
    "colour group": ("div", "box03", "color", "group", "desk"), "colour link": ("a", "box03__item"), "price box": ("div", "price-one"),
    "fallback title": ("div", "bs_title"), "fallback price": ("div", "bs_price"), "promotion block": ("div", "block__promo"),
    "promotion title": ("p", "pr-txtb"), "promotion side": ("div", "divb-right"), "loyalty points": ("p", "loyalty__main__point"),
    "spec group": ("div", "box-specifi"), "policy list": ("ul", "policy__list"), "policy text": ("div", "pl-txt"),
    "warranty box": ("div", "warranty-box"), "warranty title": ("h2", "title"), "change box": ("div", "change-box"),
    "change block": ("div", "block-change"), "change text": ("div", "content-insider"), "product box": ("div", "box-detail-product"),
    "product name": ("div", "box-product-name"), "rating B": ("div", "box-rating"), "number of ratings": ("span", "total-rating"),
    "bottom item": ("div", "box-bottom-item"), "label": ("span", "label"), "compare box": ("div", "pdp-compare-button-box"),
    "compare button": ("a", "label"), "product price": ("div", "box-product-price"), "sale price": ("div", "sale-price"),
    "base price": ("del", "base-price"), "versions": ("div", "box-linked"), "version": ("a", "item-linked"),
    "variants": ("div", "box-product-variants"), "variant": ("li", "item-variant"), "variant name": ("strong", "item-variant-name"),
    "variant price": ("span", "item-variant-price"), "commitment text": ("div", "description"), "table title": ("p", "title"),
    "table row": ("tr", "technical-content-item"), "breadcrumb C": ("nav", "Breadcrumb"),
    "name C": ("h1", "text-textOnWhitePrimary", "b2-medium", "pc:l6-semibold"), "rating box C": ("div", "ml-1.5", "flex", "items-center", "gap-1"),
    "rating C": ("div", "text-textOnWhitePrimary", "b2-regular"),
    "number of ratings C": ("div", "ml-1", "cursor-pointer", "text-textOnWhiteHyperLink", "f1-medium", "pc:b2-medium"),
    "current price C": ("span", "h4-bold"), "original price C": ("span", "text-neutral-gray-5", "line-through"),
    "discount C": ("span", "text-red-red-7"), "points C": ("span", "text-yellow-yellow-7", "b2-medium"), "slides": ("div", "swiper-wrapper"),
    "slide": ("div", "swiper-slide"), "promotion text": ("p", "text-textOnWhitePrimary"),
    "warranty list": ("div", "flex", "flex-col", "gap-2", "px-4", "pb-4", "pt-3"), "warranty package": ("div", "relative", "grid", "h-14"),
    "package title": ("p", "line-clamp-2"), "package price": ("span", "text-textOnWhiteBrand"),
    "package original price": ("span", "text-textOnWhiteDisable", "line-through"),
}
CLASSES = {
    "payment list": "render-promotion", "promotion item": "promotion-pack_item", "commitment item": "item-warranty-info",
    "commitments": "box-warranty-info", "commitments head": "box-title", "promotion head": "box-product-promotion-header",
    "promotion detail": "box-product-promotion-detail", "payment head": "box-more-promotion-title",
}
IDS = {"policy pop-up": ("div", "popup-baohanh-content"), "location": ("div", "location-detail"), "product information": ("div", "ThongTinSanPham")}
TRADE_PRICE_ID = "tradePrice"
PROMOTION_TITLE, PAYMENT_TITLE, COMMITMENT_TITLE = "Khuyến mãi", "Ưu đãi thanh toán", "Cam kết sản phẩm"
GENERAL_PROMOTION_BOX = ("relative", "flex", "flex-col", "gap-2.5", "rounded-[0.375rem]", "border")
PAYMENT_BOX = ("flex", "flex-col", "pc:flex-col-reverse", "pc:gap-3")
PROMOTION_LIST = ("flex", "flex-col", "gap-3")
DETAILS_LABEL = "Xem chi tiết"
OPTIONS_BOX = ("grid", "gap-y-3", "pb-4", "pt-3", "pc:gap-y-2", "pc:py-0")
OPTION_TEXT = ("block", "text-textOnWhitePrimary", "b2-medium")
SELECTED = "Selection_buttonSelect__7lW_h"
STORAGE_LABEL, COLOUR_LABEL = "Dung lượng", "Màu sắc"
SPEC_SECTIONS = (("teleport-modal_content", "technical-content-section"), ("modal", "technical-content-section"), ("popup", "technical-content-section"),
                 ("overlay", "technical-content-section"), (None, "specifications-modal"), (None, "tech-specs"))


def _el(name: str) -> Opens:
    """The named element."""
    tag, *classes = ELEMENTS[name]
    return Opens(tag, tuple(classes))


def _by_id(name: str) -> Opens:
    tag, ident = IDS[name]
    return Opens(tag, id=ident)


def _tag(tag: str, *classes: str) -> Opens:
    return Opens(tag, classes)


def _any_tag(*classes: str) -> Opens:
    return Opens(None, classes)


def _scopes(*scopes: tuple) -> list[Scope]:
    """Scopes one after the other: (name, condition, scope around it or None, first one only)."""
    return [Scope(*s) for s in scopes]


def section(scopes: Callable[..., list[Scope]], *carry: str) -> Callable:
    """A section of the rows that lie in its scopes: made of pages (with html), of rows from ``tag_rows``, or of ``dealt`` ones; ``carry``: what it reads
    of them beside ``text``; further arguments are those of its scopes."""
    def of(build: Callable[[DataFrame], DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(build)
        def read(rows: DataFrame, *options) -> DataFrame:
            own = scopes(*options)
            if options or _own(read, own[0].name) not in rows.columns:
                rows = _deal(rows, [(read, own)])
            return build(rows.select(KEY, "pos", "text", *carry, *[F.col(_own(read, s.name)).alias(s.name) for s in own]))

        read.scopes, read.carry = scopes, carry
        return read
    return of


def _own(read: Callable, name: str) -> str:
    return f"{read.__name__}__{name}"


def dealt(rows: DataFrame, *sections: Callable, more: tuple[Scope, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of pages (or rows from ``tag_rows``) that any of the sections (or ``more`` scopes) reads, with all their scopes, dealt by the page's key: one shuffle for all.

    Sections filter what they have aggregated: a filter on the rows would go below the shuffle, and no two would share it.
    """
    return _deal(rows, [(read, read.scopes()) for read in sections], more, keep)


def _deal(rows: DataFrame, sections: list, more: tuple[Scope, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    every = list(more)
    for read, scopes in sections:
        own = functools.partial(_own, read)
        every += [replace(s, name=own(s.name), inside=s.inside and own(s.inside), after=s.after and own(s.after), of=tuple(map(own, s.of))) for s in scopes]
    carry = dict.fromkeys(("text", *(c for read, _ in sections for c in read.carry), *keep))
    if "html" in rows.columns:
        return tag_rows(rows, KEY, keep=keep, scopes=every, carry=tuple(carry))
    return with_scopes(rows, every, KEY, tuple(carry))


def _has(scope: str) -> Column:
    return F.col(scope).isNotNull()


def _any(scope: str) -> Column:
    """Aggregate: whether a row lies in the scope."""
    return F.coalesce(F.max(_has(scope)), F.lit(False))


def _value(scope: str, name: str) -> Column:
    """Aggregate: the attribute of the scope's opening tag."""
    return F.max(F.when(F.col(scope) == F.col("pos"), attribute(F.col("attrs"), name)))


def _class(scope: str, name: str) -> Column:
    """Aggregate: whether the scope's opening tag has the class."""
    return F.coalesce(F.max(F.when(F.col(scope) == F.col("pos"), F.array_contains("classes", name))), F.lit(False))


@section(lambda: _scopes(
    ("g", _el("spec group"), None, False), ("h", _tag("h3"), "g", True), ("u", _tag("ul"), "g", False),
    ("li", _tag("li"), "u", False), ("c", _tag("aside"), "li", False)))
def specifications(rows: DataFrame) -> DataFrame:
    """``specifications``, {group: {key: value}}: list rows of exactly two cells, `:` taken from the key, groups without
    a heading left out; a later group of one name replaces the earlier, a later key the earlier one."""
    read = _has("c") | _has("h")
    cells = rows.groupBy(KEY, "g", "li", "c").agg(texts(read).alias("glued"), texts(read, " ").alias("spaced"), _any("h").alias("titled"))
    lines = cells.groupBy(KEY, "g", "li").agg(
        F.array_sort(F.collect_list(F.when(_has("c"), F.struct("c", "glued", "spaced")))).alias("cells"),
        F.max(F.when(F.col("titled") & F.col("c").isNull(), F.col("glued"))).alias("title"))
    pair = F.struct(F.col("li").alias("pos"), F.replace(F.col("cells")[0]["glued"], F.lit(":"), F.lit("")).alias("key"), F.col("cells")[1]["spaced"].alias("value"))
    groups = lines.groupBy(KEY, "g").agg(F.max("title").alias("key"), later_wins(F.collect_list(F.when(F.size("cells") == 2, pair))).alias("value"))
    groups = groups.where(F.col("key").isNotNull())
    return groups.groupBy(KEY).agg(later_wins(F.collect_list(F.struct(F.col("g").alias("pos"), "key", "value"))).alias("specifications"))


@section(lambda: _scopes(
    ("pl", _el("policy list"), None, True), ("li", _tag("li"), "pl", False), ("item", _el("policy text"), "li", False),
    ("pop", _by_id("policy pop-up"), None, True), ("wb", _el("warranty box"), "pop", True),
    ("wt", _el("warranty title"), "wb", True), ("ws", _tag("span"), "wb", True), ("cb", _el("change box"), "pop", True),
    ("bl", _el("change block"), "cb", False), ("bt", _tag("h3"), "bl", True), ("bc", _el("change text"), "bl", True)))
def policies(rows: DataFrame) -> DataFrame:
    """``policies``: commitments, warranty (title, details) and change_policy {title: text}, where a later block of one title
    wins and a block without text is left out; null where the warranty box lacks a part or a block its title."""
    parts = rows.groupBy(KEY, "item", "bl").agg(
        texts(_has("item")).alias("commitment"), texts(_has("bt")).alias("title"), texts(_has("bc"), "\n").alias("content"),
        texts(_has("wt")).alias("warranty_title"), texts(_has("ws")).alias("warranty_text"),
        *[_any(s).alias(f"has_{s}") for s in ("pop", "wb", "wt", "ws", "bt", "bc")])
    block = F.when(_has("bl") & F.col("has_bc"), F.struct(F.col("bl").alias("pos"), F.col("title").alias("key"), F.col("content").alias("value")))
    found = parts.groupBy(KEY).agg(
        F.array_sort(F.collect_list(F.when(_has("item"), F.struct("item", "commitment")))).alias("items"),
        *[F.max(f"has_{s}").alias(f"has_{s}") for s in ("pop", "wb", "wt", "ws")], F.max("warranty_title").alias("w_title"), F.max("warranty_text").alias("w_details"),
        F.max(_has("bl") & ~F.col("has_bt")).alias("untitled"), later_wins(F.collect_list(block)).alias("change_policy"))
    broken = (F.col("has_wb") & ~(F.col("has_wt") & F.col("has_ws"))) | F.col("untitled")
    whole = F.struct(
        F.transform("items", lambda i: i["commitment"]).alias("commitments"), F.when(F.col("has_wb"), F.struct(F.col("w_title").alias("title"), F.col("w_details").alias("details"))).alias("warranty_policy"),
        F.when(F.col("has_pop"), F.col("change_policy")).alias("change_policy"))
    return found.select(KEY, F.when(~broken, whole).alias("policies"))


@section(lambda: _scopes(
    ("g", _tag("div", *GENERAL_PROMOTION_BOX), None, True), ("gp", _tag("p"), "g", False), ("pay", _tag("div", *PAYMENT_BOX), None, True),
    ("sw", _el("slides"), "pay", True), ("slide", _el("slide"), "sw", False), ("img", _tag("img"), "slide", True),
    ("lst", _tag("div", *PROMOTION_LIST), "pay", True), ("op", _el("promotion text"), "lst", False)), "attrs")
def promotions(rows: DataFrame) -> DataFrame:
    """general_promotions, payment_promotions (description, image_url; slides without an image left out) and
    other_promotions (less the details label, empty ones left out)."""
    parts = rows.groupBy(KEY, "gp", "slide", "op").agg(
        texts(F.lit(True)).alias("text"), _any("img").alias("has_img"), py_strip(F.coalesce(_value("img", "alt"), F.lit(""))).alias("description"),
        py_strip(F.coalesce(_value("img", "src"), F.lit(""))).alias("image_url"))
    other = py_strip(F.replace(F.col("text"), F.lit(DETAILS_LABEL), F.lit("")))
    found = parts.groupBy(KEY).agg(
        F.array_sort(F.collect_list(F.when(_has("gp"), F.struct("gp", "text")))).alias("general"),
        F.array_sort(F.collect_list(F.when(_has("slide") & F.col("has_img"), F.struct("slide", "description", "image_url")))).alias("payment"),
        F.array_sort(F.collect_list(F.when(_has("op") & (other != ""), F.struct("op", other.alias("text"))))).alias("other"))
    return found.select(
        KEY, F.transform("general", lambda x: x["text"]).alias("general_promotions"),
        F.transform("payment", lambda x: F.struct(x["description"].alias("description"), x["image_url"].alias("image_url"))).alias("payment_promotions"),
        F.transform("other", lambda x: x["text"]).alias("other_promotions"))


@section(lambda: _scopes(
    ("pb", _el("product price"), None, True), ("sale", _el("sale price"), "pb", True), ("base", _el("base price"), "pb", True),
    ("vb", _el("versions"), None, True), ("v", _el("version"), "vb", False), ("vn", _tag("strong"), "v", True),
    ("cb", _el("variants"), None, True), ("c", _el("variant"), "cb", False),
    ("cn", _el("variant name"), "c", True), ("cp", _el("variant price"), "c", True), ("ca", _tag("a"), "c", True)), "attrs", "classes")
def priced_options(rows: DataFrame) -> DataFrame:
    """sale_price, base_price, versions {name: (url, is_active)} and colors {name: (price, url, is_active)}: name, URL, price and
    state of one element stay together where some are missing, a later element of one name wins; ``broken`` where a
    colour has no link (the section is then empty)."""
    parts = rows.groupBy(KEY, "v", "c").agg(
        texts(_has("sale")).alias("sale"), texts(_has("base")).alias("base"), texts(_has("vn")).alias("version"), texts(_has("cn")).alias("colour"),
        texts(_has("cp")).alias("price"), _value("v", "href").alias("version_url"), _value("ca", "href").alias("colour_url"),
        _class("v", "active").alias("version_active"), _class("c", "active").alias("colour_active"), *[_any(s).alias(f"has_{s}") for s in ("sale", "base", "vn", "cn", "cp", "ca")])
    version = F.struct(F.col("version_url").alias("url"), F.col("version_active").alias("is_active"))
    colour = F.struct(F.when(F.col("has_cp"), F.col("price")).alias("price"), F.col("colour_url").alias("url"), F.col("colour_active").alias("is_active"))
    found = parts.groupBy(KEY).agg(
        F.max(F.when(F.col("has_sale"), F.col("sale"))).alias("sale_price"), F.max(F.when(F.col("has_base"), F.col("base"))).alias("base_price"),
        later_wins(F.collect_list(F.when(_has("v") & F.col("has_vn"), F.struct(F.col("v").alias("pos"), F.col("version").alias("key"), version.alias("value"))))).alias("versions"),
        later_wins(F.collect_list(F.when(_has("c") & F.col("has_cn"), F.struct(F.col("c").alias("pos"), F.col("colour").alias("key"), colour.alias("value"))))).alias("colors"),
        F.max(_has("c") & F.col("has_cn") & ~F.col("has_ca")).alias("broken"))
    whole = ["sale_price", "base_price", "versions", "colors"]
    return found.select(KEY, *[F.when(~F.col("broken"), F.col(c)).alias(c) for c in whole], "broken")


def _table_scopes(alternatives: tuple = SPEC_SECTIONS) -> list[Scope]:
    scopes = []
    for k, (box, cls) in enumerate(alternatives):
        scopes += [Scope(f"box{k}", _any_tag(box))] if box else []
        scopes.append(Scope(f"sec{k}", _any_tag(cls), f"box{k}" if box else None))
    chosen = Scope("s", first="page", of=tuple(f"sec{k}" for k in range(len(alternatives))))
    return [*scopes, chosen, Scope("t", _el("table title"), "s", True), Scope("r", _el("table row"), "s"), Scope("c", _tag("td"), "r")]


@section(_table_scopes)
def spec_table(rows: DataFrame) -> DataFrame:
    """``spec_table``, {section: {key: value}} from table rows of two cells or more, of the first of the ``alternatives``
    (class of the box or None, class of the section) that the page has any section of; ``error`` where a section has no title."""
    cells = rows.groupBy(KEY, "s", "r", "c").agg(
        whole_text(F.lit(True)).alias("text"), whole_text(_has("t")).alias("title"), _any("t").alias("titled"))
    lines = cells.groupBy(KEY, "s", "r").agg(
        F.array_sort(F.collect_list(F.when(_has("c"), F.struct("c", "text")))).alias("cells"), F.max(F.when(F.col("titled"), F.col("title"))).alias("title"))
    pair = F.struct(F.col("r").alias("pos"), F.col("cells")[0]["text"].alias("key"), F.get(F.col("cells"), F.lit(1))["text"].alias("value"))
    sections = lines.groupBy(KEY, "s").agg(F.max("title").alias("key"), later_wins(F.collect_list(F.when(F.size("cells") >= 2, pair))).alias("value"))
    found = sections.groupBy(KEY).agg(
        _any("s").alias("has_s"), F.max(_has("s") & F.col("key").isNull()).alias("untitled"), later_wins(F.collect_list(F.when(F.col("key").isNotNull(), F.struct(F.col("s").alias("pos"), "key", "value")))).alias("m")).where("has_s")
    return found.select(KEY, F.when(~F.col("untitled"), F.col("m")).alias("spec_table"), F.when(F.col("untitled"), "a section has no title").alias("error"))


def _after_label(name: str, label: str) -> tuple:
    """The first block of the options box behind the label."""
    at = f"{name}_label"
    return (at, Opens("span", text=label), "o", True), (name, _tag("div"), "o", True, at)


@section(lambda: _scopes(
    ("o", _tag("div", *OPTIONS_BOX), None, True), *_after_label("st", STORAGE_LABEL), *_after_label("co", COLOUR_LABEL),
    ("box", None, None, False, None, ("st", "co")), ("b", _tag("button"), "box", False), ("t", _tag("span", *OPTION_TEXT), "b", True), ("i", _tag("img"), "b", True)), "attrs", "classes")
def stateful_options(rows: DataFrame) -> DataFrame:
    """storage_options (value, is_selected) and color_options (name, image_url, is_selected), the buttons of the box after
    each label; a colour needs both text and image."""
    buttons = rows.groupBy(KEY, "st", "co", "b").agg(
        _any("o").alias("has_o"),         texts(_has("t")).alias("text"), _any("t").alias("has_text"), _any("i").alias("has_image"), _value("i", "src").alias("image"), _class("b", SELECTED).alias("selected"))
    storage = F.when(_has("st") & _has("b") & F.col("has_text"), F.struct("b", F.struct(F.col("text").alias("value"), F.col("selected").alias("is_selected")).alias("v")))
    colour = F.when(_has("co") & _has("b") & F.col("has_text") & F.col("has_image"), F.struct(
        "b", F.struct(F.col("text").alias("name"), F.col("image").alias("image_url"), F.col("selected").alias("is_selected")).alias("v")))
    found = buttons.groupBy(KEY).agg(F.max("has_o").alias("has_o"), F.array_sort(F.collect_list(storage)).alias("s"), F.array_sort(F.collect_list(colour)).alias("c")).where("has_o")
    return found.select(KEY, F.transform("s", lambda x: x["v"]).alias("storage_options"), F.transform("c", lambda x: x["v"]).alias("color_options"))


_PRIMARY = (("current", "p", "box-price-present"), ("original", "p", "box-price-old"), ("percent", "p", "box-price-percent"), ("instalment", "span", "label--black"))
_FALLBACK = (("bs_current", "strong"), ("bs_original", "em"), ("bs_percent", "i"))


@section(lambda: _scopes(
    ("one", _el("price box"), None, True), *[(n, _tag(t, c), "one", True) for n, t, c in _PRIMARY], ("bs_title", _el("fallback title"), None, False),
    ("bs", _el("fallback price"), "bs_title", True), *[(n, _tag(t), "bs", True) for n, t in _FALLBACK],
    ("loc", _by_id("location"), None, True), ("loc_a", _tag("a"), "loc", True), ("promo", _el("promotion block"), None, True),
    ("pt", _el("promotion title"), "promo", True), ("right", _el("promotion side"), "promo", False), ("rp", _tag("p"), "right", False),
    ("loyal", _el("loyalty points"), None, True)))
def price_and_promotions(rows: DataFrame) -> DataFrame:
    """X4, one page: prices of the primary box, else of the fallback box, else empty; location, promotions, loyalty points."""
    names = [*[n for n, *_ in _PRIMARY], *[n for n, _ in _FALLBACK], "loc_a", "pt", "loyal"]
    parts = rows.groupBy(KEY, "rp").agg(*[whole_text(_has(n)).alias(n) for n in names], whole_text(F.lit(True)).alias("text"), _any("one").alias("has_one"))
    found = parts.groupBy(KEY).agg(*[F.max(n).alias(n) for n in names], F.max("has_one").alias("has_one"),
                                   F.array_sort(F.collect_list(F.when(_has("rp"), F.struct("rp", "text")))).alias("list"))
    either = lambda a, b: F.when(F.col("has_one"), F.col(a)).otherwise(F.col(b))
    return found.select(
        KEY, either("current", "bs_current").alias("current_price"), either("original", "bs_original").alias("original_price"), either("percent", "bs_percent").alias("discount"),
        F.when(F.col("has_one"), F.col("instalment")).otherwise("").alias("installment_info"), F.col("loc_a").alias("location"), F.col("pt").alias("promo_title"),
        F.transform("list", lambda x: x["text"]).alias("promo_list"), F.col("loyal").alias("loyalty_points"))


@section(lambda: _scopes(
    ("in", _el("colour slider"), None, False), ("box", _el("colour group"), "in", False),
    ("a", _el("colour link"), "box", False)), "attrs")
def colour_links(rows: DataFrame) -> DataFrame:
    """The colours that a product page links to, a row each: their order, name and href."""
    links = rows.groupBy(KEY, "a").agg(whole_text(F.lit(True)).alias("color"), _value("a", "href").alias("href"), _any("a").alias("is_link"))
    return links.where("is_link").drop("is_link")


def prices_per_colour(pages: DataFrame, url: str = "url") -> DataFrame:
    """page_id of the product, color, and the prices and promotions of the colour's own page, a row per colour whose page is known.

    The pages are cut into rows once; links and prices are both read from them, and joined on the address.  Both joins are by sorting: pages are many
    rows of few source bytes, so their size is guessed far too small, and a broadcast would gather them in the driver."""
    rows = dealt(pages, price_and_promotions, colour_links)
    addresses = pages.where(F.col(KEY).isNotNull()).select(F.col(KEY).alias("_at"), url)
    # null-safe: a plain comparison would filter keys below the shuffle, and links and prices would not share it
    prices = price_and_promotions(rows).join(addresses.hint("merge"), F.col(KEY).eqNullSafe(F.col("_at"))).drop(KEY, "_at")
    return colour_links(rows).join(prices.hint("merge"), F.col("href") == F.col(url)).drop("href", url)


def breadcrumb(html: Column) -> Column:
    """The names of the first JSON-LD block that speaks of a breadcrumb list, in its order; an empty list where there is
    none or it is no JSON."""
    blocks = F.regexp_extract_all(html, F.lit(r"""(?is)<script(?=[^>]*\stype\s*=\s*["']?application/ld\+json)[^>]*>(.*?)</script>"""), 1)
    block = F.get(F.filter(blocks, lambda b: b.contains("BreadcrumbList")), 0)
    items = F.try_variant_get(F.try_parse_json(block), "$.itemListElement", "array<variant>")
    names = F.transform(items, lambda i: F.try_variant_get(i, "$.item.name", "string"))
    return F.coalesce(F.filter(names, lambda n: n.isNotNull()), F.array().cast("array<string>"))


def _text(scope: str, separator: str = "") -> Column:
    """Aggregate: the text of the scope, null where the page has no such element."""
    return F.when(_any(scope), texts(_has(scope), separator))


def _list(scope: str, *fields: str) -> Column:
    """Aggregate over parts: the field (or a struct of the fields) of each part in the scope, in page order."""
    found = F.array_sort(F.collect_list(F.when(_has(scope), F.struct(F.col(scope).alias("at"), *fields))), lambda a, b: a["at"] - b["at"])
    return F.transform(found, lambda x: x[fields[0]] if len(fields) == 1 else F.struct(*[x[f].alias(f) for f in fields]))


@section(lambda: _scopes(
    ("d", _el("detail"), None, True), ("n", _el("name box"), "d", True), ("h", _tag("h1"), "n", True),
    ("q", _el("quantity sold"), "n", True), ("r", _el("rating A"), "n", True), ("b", _el("breadcrumb A"), "d", True), ("a", _tag("a"), "b", False)))
def basics_a(rows: DataFrame) -> DataFrame:
    """product_name, quantity_sale, detail_rate, product_type (null without breadcrumb)."""
    parts = rows.groupBy(KEY, "a").agg(*[_text(s).alias(f"t_{s}") for s in ("h", "q", "r", "a")], _any("b").alias("has_b"), _any("d").alias("has_d")).where("has_d")
    return parts.groupBy(KEY).agg(F.max("t_h").alias("product_name"), F.max("t_q").alias("quantity_sale"), F.max("t_r").alias("detail_rate"),
                                  F.max("has_b").alias("has_b"), _list("a", "t_a").alias("types")).select(
        KEY, "product_name", "quantity_sale", "detail_rate", F.when(F.col("has_b"), F.col("types")).alias("product_type"))


@section(lambda: _scopes(
    ("g", _el("option boxes"), None, True), ("cap", replace(_el("option box"), without=("color",)), "g", False),
    ("act", _el("chosen option"), "cap", "page"), ("col", _el("colour box"), "g", False), ("a", _tag("a"), "col", False)))
def options_a(rows: DataFrame) -> DataFrame:
    """selected_capacity (empty where none is), all_colors; null without the box."""
    parts = rows.groupBy(KEY, "a").agg(_text("act").alias("act"), _text("a").alias("t"), _any("g").alias("has_g")).where("has_g")
    return parts.groupBy(KEY).agg(F.coalesce(F.max("act"), F.lit("")).alias("selected_capacity"), _list("a", "t").alias("all_colors"))


@section(lambda: _scopes(
    ("n", _el("product name"), None, False), ("h", _tag("h1"), "n", "page"), ("rb", _el("rating B"), None, True),
    ("rs", Opens("span", without=("total-rating",)), "rb", True), ("rt", _el("number of ratings"), "rb", True),
    ("i", _el("bottom item"), None, False), ("l", _el("label"), "i", True),
    ("cb", _el("compare box"), None, False), ("c", _el("compare button"), "cb", "page")))
def basics_b(rows: DataFrame) -> DataFrame:
    """product_name, rating_score, total_ratings (without brackets), actions (labels, then the compare button's)."""
    parts = rows.groupBy(KEY, "l").agg(*[_text(s).alias(f"t_{s}") for s in ("h", "rs", "rt", "l", "c")])
    found = parts.groupBy(KEY).agg(*[F.max(f"t_{s}").alias(f"t_{s}") for s in ("h", "rs", "rt", "c")], _list("l", "t_l").alias("labels"))
    return found.select(KEY, F.col("t_h").alias("product_name"), F.col("t_rs").alias("rating_score"), F.btrim("t_rt", F.lit("()")).alias("total_ratings"),
                        F.concat("labels", F.when(F.col("t_c").isNull(), F.array().cast("array<string>")).otherwise(F.array("t_c"))).alias("actions"))


def _linked(rows: DataFrame, title: str, default: str, item: str, out: str) -> DataFrame:
    """A title or its default, and the items' texts with their first link (scope ``link``; null without)."""
    parts = rows.groupBy(KEY, item).agg(_text(title).alias("title"), texts(_has(item), " ").alias("detail"), _value("link", "href").alias("link"))
    return parts.groupBy(KEY).agg(F.struct(F.coalesce(F.max("title"), F.lit(default)).alias("title"), _list(item, "detail", "link").alias("items")).alias(out))


@section(lambda: _scopes(
    ("hd", _any_tag(CLASSES["promotion head"]), None, False), ("t", _tag("span"), "hd", "page"),
    ("p", _any_tag(CLASSES["promotion item"]), None, False), ("i", _any_tag(CLASSES["promotion detail"]), "p", True), ("link", _tag("a"), "i", True)), "attrs")
def promotions_b(rows: DataFrame) -> DataFrame:
    """``promotions``: title and items (detail, link)."""
    return _linked(rows, "t", PROMOTION_TITLE, "i", "promotions")


@section(lambda: _scopes(
    ("hd", _any_tag(CLASSES["payment head"]), None, False), ("t", _tag("span"), "hd", "page"),
    ("r", _any_tag(CLASSES["payment list"]), None, False), ("u", _tag("ul"), "r", False), ("i", _tag("li"), "u", False), ("link", _tag("a"), "i", True)), "attrs")
def payment_promotions_b(rows: DataFrame) -> DataFrame:
    """X11: ``payment_promotions``: title and items (detail, link)."""
    return _linked(rows, "t", PAYMENT_TITLE, "i", "payment_promotions")


@section(lambda: _scopes(
    ("w", _any_tag(CLASSES["commitments"]), None, False), ("bt", _any_tag(CLASSES["commitments head"]), "w", False), ("t", _tag("p"), "bt", "page"),
    ("p", _any_tag(CLASSES["commitment item"]), None, False), ("i", _el("commitment text"), "p", False), ("link", _tag("a"), "i", True)), "attrs")
def commitments_b(rows: DataFrame) -> DataFrame:
    """``commitments``: title and items (detail, link), every description of an item."""
    return _linked(rows, "t", COMMITMENT_TITLE, "i", "commitments")


@section(lambda: _scopes(
    ("nav", _el("breadcrumb C"), None, True), ("li", _tag("li"), "nav", False), ("a", _tag("a"), "li", True),
    ("h", _el("name C"), None, True), ("rb", _el("rating box C"), None, False),
    ("rs", _el("rating C"), "rb", "page"),
    ("rc", _el("number of ratings C"), None, True)))
def basics_c(rows: DataFrame) -> DataFrame:
    """product_type (breadcrumb texts that are not empty), product_name, rating_score, rating_count."""
    parts = rows.groupBy(KEY, "a").agg(*[_text(s).alias(f"t_{s}") for s in ("h", "rs", "rc", "a")])
    found = parts.groupBy(KEY).agg(*[F.max(f"t_{s}").alias(f"t_{s}") for s in ("h", "rs", "rc")], _list("a", "t_a").alias("types"))
    return found.select(KEY, F.filter("types", lambda t: t != "").alias("product_type"), F.col("t_h").alias("product_name"), F.col("t_rs").alias("rating_score"), F.col("t_rc").alias("rating_count"))


@section(lambda: _scopes(
    ("b", Opens(None, id=TRADE_PRICE_ID), None, True), ("c", _el("current price C"), "b", True), ("o", _el("original price C"), "b", True),
    ("d", _el("discount C"), "b", True), ("r", _el("points C"), "b", True)))
def price_c(rows: DataFrame) -> DataFrame:
    """current_price and original_price as numbers (null where they are none), discount_percent, reward_points."""
    found = rows.groupBy(KEY).agg(*[_text(s).alias(f"t_{s}") for s in "codr"])
    return found.select(KEY, parse_price("t_c").alias("current_price"), parse_price("t_o").alias("original_price"), F.col("t_d").alias("discount_percent"), reward_points("t_r").alias("reward_points"))


@section(lambda: _scopes(
    ("b", _el("warranty list"), None, True), ("i", _el("warranty package"), "b", False),
    ("t", _el("package title"), "i", True), ("c", _el("package price"), "i", True), ("o", _el("package original price"), "i", True)))
def extended_warranty_c(rows: DataFrame) -> DataFrame:
    """``extended_warranty``: title, current_price, original_price of each package, each null where it is missing."""
    parts = rows.groupBy(KEY, "i").agg(_text("t").alias("title"), parse_price(_text("c")).alias("current_price"), parse_price(_text("o")).alias("original_price"))
    return parts.groupBy(KEY).agg(_list("i", "title", "current_price", "original_price").alias("extended_warranty"))


@dataclass(frozen=True)
class Layout:
    """How the pages of one shop are read: pattern of their URLs, the container, the sections (one of them has product_name),
    and whether the product type comes from JSON-LD."""

    name: str
    url_pattern: str
    container: Callable[[], Opens]
    sections: tuple[Callable[[DataFrame], DataFrame], ...]
    json_breadcrumb: bool = False


LAYOUTS = (
    Layout("A", r"^https?://shop-a\.", lambda: _el("detail"), (basics_a, options_a, specifications, policies)),
    Layout("B", r"^https?://shop-b\.", lambda: _el("product box"),
           (basics_b, priced_options, promotions_b, payment_promotions_b, commitments_b, spec_table), True),
    Layout("C", r"^https?://shop-c\.", lambda: _by_id("product information"), (basics_c, stateful_options, price_c, promotions, extended_warranty_c)),
)


def assemble_products(pages: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """One record per page that has its layout's container: page_id, url, layout, product_name, product_data (JSON of the
    sections), status.

    A page goes to the first layout whose pattern fits its URL.  Each layout cuts its pages into rows with one shuffle; name
    and sections are aggregates on the same key, so their joins need no other.  A section that fails is null, or gives the status its error.
    """
    route = F.lit(None).cast("string")
    for layout in reversed(layouts):
        route = F.when(F.col("url").rlike(layout.url_pattern), layout.name).otherwise(route)
    routed = pages.select(KEY, "url", "html", route.alias("layout"))
    out = None
    for layout in layouts:
        record = _record(routed.where(F.col("layout") == layout.name), layout)
        out = record if out is None else out.unionByName(record)
    return out


def _record(pages: DataFrame, layout: Layout) -> DataFrame:
    keep = ("url", "layout")
    if layout.json_breadcrumb:
        pages = pages.withColumn("breadcrumb", breadcrumb(F.col("html")))
        keep += ("breadcrumb",)
    rows = dealt(pages, *layout.sections, more=(Scope("box", layout.container(), first=True),), keep=keep)
    record = rows.groupBy(KEY, *keep).agg(_any("box").alias("has_box")).where("has_box").drop("has_box")
    fields, error = [F.col("breadcrumb").alias("product_type")] if layout.json_breadcrumb else [], F.lit(None).cast("string")
    for section in layout.sections:
        part = section(rows)
        record = record.join(part, KEY, "left")
        fields += [F.col(c) for c in part.columns if c not in (KEY, "error", "broken")]
        if "error" in part.columns:
            error = F.col("error")
    return record.select(KEY, "url", "layout", F.coalesce("product_name", F.lit("")).alias("product_name"), F.to_json(F.struct(*fields)).alias("product_data"),
                         record_status(F.col("product_name"), error).alias("status"))
