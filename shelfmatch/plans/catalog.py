"""The query catalogue: one Spark plan per operator group of the inventory,
each with the equivalent DuckDB SQL used as the correctness oracle.

Every query reads the driver tables in full (or data Spark derives from
them).  Scores are rounded to 6 decimals on both sides so the oracle can be
compared value by value.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.functions.lists import parse_list_literal
from shelfmatch.functions.prices import (crawl_time, format_price, parse_price, pick_price_text, reward_points,
                                         sku_from_url, strip_label)
from shelfmatch.functions.text import (DASHED_TITLE_DATASET, clean_name, clean_title, join_clean_lines, map_distinct,
                                       normalize_title)
from shelfmatch.operators.dedupe import dedupe_by_title, keep_first
from shelfmatch.operators.extract import Rule, extract_fields, merge_sections, record_status, require_container
from shelfmatch.operators.ingest import batch_stats, insert_all_batches
from shelfmatch.operators.match import MatchConfig, match_catalogues, match_summary, rouge_join
from shelfmatch.operators.sketches import encoded, sketch_topk
from shelfmatch.operators.specs import drop_keys, group_specs_long, parse_noisy_json, resolve_refs
from shelfmatch.operators.urls import contains_brand, keyword_filter, new_urls, url_counts
from shelfmatch.operators.variants import spec_counts, variant_matrix, variant_overlap
from shelfmatch.operators.vector_search import (add_vectors, cosine_join, ivf_topk, load_store, lsh_topk, save_store,
                                                search_topk)
from shelfmatch.plans.registry import ORACLE, QUERIES, query
from shelfmatch.plans.tables import grouped_catalogue, shop_catalogue, table
from shelfmatch.session import ensure_session_defaults, scratch_path
from shelfmatch.sources.files import read_catalogue, read_pages, read_store_keys, write_csv, write_json
from shelfmatch.sources.sitemap import read_sitemap, write_sitemap
from shelfmatch.streaming.ingest import PROFILES, stage_batches, staged_stream, stream_insert_if_absent


# ---------------------------------------------------------------- A1 / N4 --
@query("dedupe_title_part", """
SELECT p_partkey, title, p_brand FROM (
  SELECT p_partkey, trim(p_name) AS title, p_brand,
         row_number() OVER (PARTITION BY trim(p_name) ORDER BY p_partkey) AS rn
  FROM part) WHERE rn = 1
""")
def dedupe_title_part(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("title"), "p_brand")
    return dedupe_by_title(part, "title", ["p_partkey"])


@query("dedupe_exact_documents", """
SELECT doc_id, n_chars FROM (
  SELECT doc_id, n_chars, row_number() OVER (
    PARTITION BY trim(regexp_replace(lower(nfc_normalize(text)), '\\s+', ' ', 'g')) ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1
""")
def dedupe_exact_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Exact de-duplication of documents by normalised text, first ``doc_id`` kept.

    The shuffle key is the SHA-256 of the normalised text, so whole texts
    never cross the network; only (digest, doc_id, n_chars) do.
    """
    docs = table(spark, sf, "documents")
    keyed = docs.select("doc_id", "n_chars", F.sha2(normalize_title("text"), 256).alias("digest"))
    return keep_first(keyed, ["digest"], ["doc_id"]).select("doc_id", "n_chars")


# ------------------------------------------------------------ J1 / F8 / A2 --
_SHOPS_SQL = """
WITH a0 AS (SELECT CAST(p_partkey AS VARCHAR) AS _id, trim(p_name) AS title, p_name AS title_cleaned,
                   '[''' || p_size || 'GB'']' AS capacities, '[''' || upper(p_type[1]) || lower(p_type[2:]) || ''']' AS color_options,
                   p_partkey AS _ord
            FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INT) <= 12),
     b0 AS (SELECT CAST(p_partkey AS VARCHAR) AS _id, trim(p_name) AS title, p_name AS title_cleaned,
                   p_size || 'GB' AS capacities, 'Màu ' || upper(p_type[1]) || lower(p_type[2:]) AS color_options,
                   p_partkey AS _ord
            FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INT) > 12),
     a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY _ord) rn FROM a0) WHERE rn = 1),
     b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY _ord) rn FROM b0) WHERE rn = 1)
"""


@query("match_exact_parts", _SHOPS_SQL + """
SELECT _id1, _id2, title, "references", title_cleaned, references_cleaned, main_score, main_score_type,
       string_score, capacities_1, capacities_2, colors_1, colors_2 FROM (
  SELECT a._id AS _id1, b._id AS _id2, a.title_cleaned AS title, b.title AS "references",
         a.title_cleaned AS title_cleaned, b.title_cleaned AS references_cleaned,
         1.0::DOUBLE AS main_score, 'string' AS main_score_type, 1.0::DOUBLE AS string_score,
         a.capacities AS capacities_1, b.capacities AS capacities_2,
         a.color_options AS colors_1, b.color_options AS colors_2,
         row_number() OVER (PARTITION BY lower(trim(a.title_cleaned)) ORDER BY a._ord, b._ord) AS rk
  FROM a JOIN b ON a.title_cleaned = b.title_cleaned) WHERE rk = 1
""")
def match_exact_parts(spark: SparkSession, sf: str) -> DataFrame:
    a = dedupe_by_title(shop_catalogue(spark, sf, "A"))
    b = dedupe_by_title(shop_catalogue(spark, sf, "B"))
    cfg = MatchConfig(main_score="string", threshold=0.8, use_rouge=False, use_semantic=False)
    pairs = match_catalogues(a, b, cfg)
    return pairs.select("_id1", "_id2", "title", "references", "title_cleaned", "references_cleaned",
                        "main_score", "main_score_type", "string_score", "capacities_1", "capacities_2",
                        "colors_1", "colors_2")


# ------------------------------------------------ L1-L3 / J5 / J6 / U1 / A8 --
@query("variant_overlap_parts", """
WITH va AS (SELECT p_name, p_size, min(p_partkey) AS k,
                   list_sort(list(DISTINCT upper(p_type[1]) || lower(p_type[2:]))) AS colours
            FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INT) <= 12 GROUP BY p_name, p_size),
     a AS (SELECT p_name, min(k) AS _ord FROM va GROUP BY p_name),
     vb AS (SELECT p_name, min(p_partkey) AS _ord, list(DISTINCT p_size || 'GB') AS caps,
                   list(DISTINCT upper(p_type[1]) || lower(p_type[2:])) AS colours
            FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INT) > 12 GROUP BY p_name)
SELECT CAST(a._ord AS VARCHAR) AS _id1, CAST(vb._ord AS VARCHAR) AS _id2, a.p_name AS title_cleaned,
       vb.p_name AS references_cleaned, va.p_size || 'GB' AS capacity,
       array_to_string(list_sort(va.colours), '|') AS colors1_for_cap,
       array_to_string(list_sort(vb.colours), '|') AS colors2_for_row,
       array_to_string(list_sort(list_intersect(va.colours, vb.colours)), '|') AS common_colors,
       CAST(len(list_intersect(va.colours, vb.colours)) AS INT) AS num_common_colors
FROM a JOIN vb ON a.p_name = vb.p_name JOIN va ON va.p_name = a.p_name
WHERE list_contains(vb.caps, va.p_size || 'GB')
""")
def variant_overlap_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Stages 2 and 3 end to end: shops grouped by title, exact match, then
    per shared capacity the colours both shops offer."""
    a = dedupe_by_title(grouped_catalogue(spark, sf, "A"))
    b = dedupe_by_title(grouped_catalogue(spark, sf, "B"))
    pairs = match_catalogues(a, b, MatchConfig(main_score="string", use_rouge=False))
    v = variant_overlap(pairs)
    def joined(c):
        return F.array_join(F.array_sort(c), "|")
    return v.select("_id1", "_id2", "title_cleaned", "references_cleaned", "capacity",
                    joined("colors1_for_cap").alias("colors1_for_cap"),
                    joined("colors2_for_row").alias("colors2_for_row"),
                    joined("common_colors").alias("common_colors"), "num_common_colors")


# ------------------------------------------------------------------- N1 ----
# On ``part`` names the cleaner's effect is the colour fold: the English colour
# words are removed as whole words and blanks collapsed.
_ASCII_COLOURS = "black|white|blue|red|gold|silver|green|yellow|purple|pink|gray|grey|orange|brown|midnightblue|skyblue|neon purple"


@query("clean_names_part", f"""
SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(trim(p_name)), '\\b({_ASCII_COLOURS})\\b', '', 'g'), '\\s+', ' ', 'g'))
       AS title_cleaned
FROM part
""")
def clean_names_part(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return map_distinct(part, "p_name", "title_cleaned", clean_name).select("p_partkey", "title_cleaned")


# ------------------------------------------------------- N1 / N2 / N3 / T4 ----
@query("clean_names_decorated", f"""
SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(trim(p_name)), '\\b({_ASCII_COLOURS})\\b', '', 'g'), '\\s+', ' ', 'g'))
       AS title_cleaned
FROM part
""")
def clean_names_decorated(spark: SparkSession, sf: str) -> DataFrame:
    """N1 on shop-style titles built from ``part``: prefix, storage, colour in
    brackets and the shop suffix are all removed, leaving the model name."""
    part = table(spark, sf, "part")
    title = F.concat(F.lit("Điện thoại "), F.initcap("p_name"), F.lit(" "), F.col("p_size").cast("string"),
                     F.lit("GB (Đen) - Chỉ có tại Shop"))
    named = part.select("p_partkey", title.alias("raw"))
    return map_distinct(named, "raw", "title_cleaned", clean_name).select("p_partkey", "title_cleaned")


@query("clean_names_dashed_part", """
SELECT p_partkey, 'galaxy ' || lower(trim(p_name)) AS title_cleaned FROM part
""")
def clean_names_dashed_part(spark: SparkSession, sf: str) -> DataFrame:
    """N2 + T4 on dashed titles built from ``part``: the leading phone label and
    storage go, the part naming a brand is kept ('galaxy ...')."""
    part = table(spark, sf, "part")
    title = F.concat(F.lit("Điện thoại Galaxy "), F.initcap("p_name"), F.lit(" - Hàng mới "),
                     F.col("p_size").cast("string"), F.lit("GB"))
    named = part.select("p_partkey", title.alias("raw"))
    cleaned = map_distinct(named, "raw", "title_cleaned", lambda c: clean_title(c, DASHED_TITLE_DATASET, True))
    return cleaned.select("p_partkey", "title_cleaned")


# --------------------------------------------------- N3 inside J1 (clean_titles) --
def _decorated_catalogue(spark: SparkSession, sf: str, shop: str) -> DataFrame:
    """Shop titles as the two shops write them: shop A 'Điện thoại <Name> <n>GB - Chính hãng',
    shop B '<Name> <n>GB - Chỉ có tại Shop'."""
    cat = shop_catalogue(spark, sf, shop)
    size = F.regexp_extract("capacities", r"(\d+GB)", 1)
    if shop == "A":
        title = F.concat(F.lit("Điện thoại "), F.initcap("title"), F.lit(" "), size, F.lit(" - Chính hãng"))
    else:
        title = F.concat(F.initcap("title"), F.lit(" "), size, F.lit(" - Chỉ có tại Shop"))
    return cat.withColumn("title", title).withColumn("title_cleaned", F.col("title"))


_INITCAP = "array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@query("match_cleaned_parts", f"""
WITH a2 AS (SELECT CAST(p_partkey AS VARCHAR) AS _id, p_partkey AS _ord, lower(trim(p_name)) AS t,
                   'Điện thoại ' || {_INITCAP.format(x='p_name')} || ' ' || p_size || 'GB - Chính hãng' AS title
            FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INT) <= 12),
     b2 AS (SELECT CAST(p_partkey AS VARCHAR) AS _id, p_partkey AS _ord,
                   trim(regexp_replace(regexp_replace(lower(trim(p_name)), '\\b({_ASCII_COLOURS})\\b', '', 'g'), '\\s+', ' ', 'g')) AS t,
                   {_INITCAP.format(x='p_name')} || ' ' || p_size || 'GB - Chỉ có tại Shop' AS title
            FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INT) > 12),
     a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY _ord) rn FROM a2) WHERE rn = 1),
     b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY _ord) rn FROM b2) WHERE rn = 1)
SELECT _id1, _id2, title, "references", title_cleaned, references_cleaned, main_score FROM (
  SELECT a._id AS _id1, b._id AS _id2, a.title AS title, b.title AS "references", a.t AS title_cleaned,
         b.t AS references_cleaned, 1.0::DOUBLE AS main_score,
         row_number() OVER (PARTITION BY lower(a.title) ORDER BY a._ord, b._ord) AS rk
  FROM a JOIN b ON a.t = b.t) WHERE rk = 1
""")
def match_cleaned_parts(spark: SparkSession, sf: str) -> DataFrame:
    """J1 with ``clean_titles``: shop A titles go through the dashed-title cleaner,
    shop B titles through the generic one (N3), then exact match, one pair per title."""
    a = dedupe_by_title(_decorated_catalogue(spark, sf, "A"))
    b = dedupe_by_title(_decorated_catalogue(spark, sf, "B"))
    cfg = MatchConfig(main_score="string", use_rouge=False, clean_titles=True,
                      dataset1_type=DASHED_TITLE_DATASET, dataset2_type="other")
    pairs = match_catalogues(a, b, cfg)
    return pairs.select("_id1", "_id2", "title", "references", "title_cleaned", "references_cleaned", "main_score")


# ------------------------------------------------------------- R1 / J2 ----
_TOK = "list_filter(string_split(regexp_replace(lower(trim({x})), '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: t <> '')"
_LCS = ("list_reduce({a}, lambda prev, x: list_reduce(range(1, len({b})+1), lambda cur, j: list_append(cur, "
        "CASE WHEN {b}[j] = x THEN prev[j] + 1 ELSE greatest(prev[j+1], cur[j]) END), [0]), "
        "list_resize([0], len({b})+1, 0))[len({b})+1]")
# Page text: scripts/styles/comments removed, tags dropped, entities decoded, blanks collapsed.
_BODY = ("regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', ' ', 'g'), "
         "'(?is)<style\\b.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g')")
_TEXT = ("trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace("
         "regexp_replace({x}, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
         "'&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g'))")


def _elem_sql(tag: str, body: str = "body") -> str:
    pat = f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}>"
    return (f"CASE WHEN regexp_matches({body}, '{pat}') THEN "
            + _TEXT.format(x=f"regexp_extract({body}, '{pat}', 1)") + " END")


_TITLES_SQL = ("WITH pg AS (SELECT page_id, " + _BODY + " AS body FROM pages), "
               "t AS (SELECT min(page_id) AS id, title FROM (SELECT page_id, " + _elem_sql("title") +
               " AS title FROM pg) GROUP BY title), "
               "tk AS (SELECT id, CASE WHEN title IS NULL OR title = '' THEN []::VARCHAR[] ELSE "
               + _TOK.format(x="title") + " END AS toks FROM t) ")


@query("match_rouge_titles", _TITLES_SQL + f"""
SELECT id_l, id_r, rouge_score FROM (
  SELECT l.id AS id_l, r.id AS id_r, len(l.toks) AS m, len(r.toks) AS n,
         {_LCS.format(a='r.toks', b='l.toks')} AS lcs,
         round(2.0 * lcs / (m + n), 6) AS rouge_score
  FROM tk l JOIN tk r ON l.id < r.id WHERE len(l.toks) > 0 AND len(r.toks) > 0)
WHERE 2.0 * lcs / (m + n) >= 0.3
""")
def match_rouge_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate page titles: ROUGE-L F1 >= 0.3 between distinct titles
    (first page per title), prefix-filtered join, each pair once."""
    titles = extract_fields(table(spark, sf, "pages"), [Rule("title", "title")], keep=("page_id",))
    distinct = titles.groupBy("title").agg(F.min("page_id").alias("id")).select("id", F.col("title").alias("text"))
    pairs = rouge_join(distinct, None, 0.3)
    return pairs.select("id_l", "id_r", F.round("score", 6).alias("rouge_score"))


@query("match_rouge_parts", f"""
WITH a AS (SELECT min(p_partkey) AS id, trim(p_name) AS title FROM part
           WHERE CAST(split_part(p_brand, '#', 2) AS INT) <= 12 GROUP BY trim(p_name)),
     b AS (SELECT min(p_partkey) AS id, trim(p_name) AS title FROM part
           WHERE CAST(split_part(p_brand, '#', 2) AS INT) > 12 GROUP BY trim(p_name)),
     ta AS (SELECT id, title, {_TOK.format(x='title')} AS toks FROM a),
     tb AS (SELECT id, title, {_TOK.format(x='title')} AS toks FROM b)
SELECT _id1, _id2, title, "references", rouge_score FROM (
  SELECT CAST(ta.id AS VARCHAR) AS _id1, CAST(tb.id AS VARCHAR) AS _id2, ta.title AS title, tb.title AS "references",
         {_LCS.format(a='ta.toks', b='tb.toks')} AS lcs, len(ta.toks) AS m, len(tb.toks) AS n,
         round(2.0 * lcs / (m + n), 6) AS rouge_score
  FROM ta, tb WHERE len(ta.toks) > 0 AND len(tb.toks) > 0)
WHERE 2.0 * lcs / (m + n) >= 0.5
""")
def match_rouge_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Every shop-A/shop-B title pair with ROUGE-L F1 >= 0.5 (J2 + R1)."""
    a = dedupe_by_title(shop_catalogue(spark, sf, "A"))
    b = dedupe_by_title(shop_catalogue(spark, sf, "B"))
    ids = rouge_join(a.select(F.col("_ord").alias("id"), F.col("title").alias("text")),
                     b.select(F.col("_ord").alias("id"), F.col("title").alias("text")), 0.5)
    out = (ids.join(a.select(F.col("_ord").alias("id_l"), "_id", "title"), "id_l")
              .join(b.select(F.col("_ord").alias("id_r"), F.col("_id").alias("_id2"), F.col("title").alias("references")), "id_r"))
    return out.select(F.col("_id").alias("_id1"), "_id2", "title", "references", F.round("score", 6).alias("rouge_score"))


# ------------------------------------------------------ X1 / X2 / F5 / F6 ----
PAGE_RULES = [
    Rule("title", "title"),
    Rule("product_name", "h1"),
    Rule("ad_text", "div", cls="ad"),
    Rule("nav_links", "a", mode="list"),
    Rule("hrefs", "a", mode="attr", attr="href"),
    Rule("n_paragraphs", "p", mode="count"),
    Rule("footer", "footer"),
]
_AD = "(?is)<div[^>]*\\bclass=\"[^\"]*\\bad\\b[^>]*>(.*?)</div>"


@query("page_fields", "WITH pg AS (SELECT page_id, url, " + _BODY + " AS body FROM pages "
       "WHERE regexp_matches(" + _BODY + ", '(?is)<article\\b[^>]*>(.*?)</article>')) "
       "SELECT page_id, url, " + _elem_sql("title") + " AS title, " + _elem_sql("h1") + " AS product_name, "
       "CASE WHEN regexp_matches(body, '" + _AD + "') THEN "
       + _TEXT.format(x="regexp_extract(body, '" + _AD + "', 1)") + " END AS ad_text, "
       "array_to_string(list_transform(regexp_extract_all(body, '(?is)<a\\b[^>]*>(.*?)</a>', 1), lambda x: "
       + _TEXT.format(x="x") + "), '|') AS nav_links, "
       "array_to_string(regexp_extract_all(body, '(?is)<a\\b[^>]*\\bhref=\"([^\"]*)\"', 1), '|') AS hrefs, "
       "CAST(len(regexp_extract_all(body, '(?is)<p\\b[^>]*>', 0)) AS INT) AS n_paragraphs, "
       + _elem_sql("footer") + " AS footer, "
       "CASE WHEN " + _elem_sql("h1") + " IS NULL OR " + _elem_sql("h1") + " = '' THEN 'no_name_found' ELSE 'success' END AS status "
       "FROM pg")
def page_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction over every page: pages lacking the ``<article>`` container give
    no record (F6), fields by rule (X1/X2), status by name (F5)."""
    rec = extract_fields(table(spark, sf, "pages"), PAGE_RULES, container=Rule("article", "article"))
    return rec.select("page_id", "url", "title", "product_name", "ad_text",
                      F.array_join("nav_links", "|").alias("nav_links"), F.array_join("hrefs", "|").alias("hrefs"),
                      "n_paragraphs", "footer", record_status(F.col("product_name")).alias("status"))


# ------------------------------------------------- T1 / T2 / T3 / J3 / J4 ----
_VEC_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
     u AS (SELECT label, unnest(v) AS x, unnest(generate_series(1, len(v))) AS i FROM e),
     q AS (SELECT label, list(m ORDER BY i) AS qv FROM (SELECT label, i, avg(x) AS m FROM u GROUP BY label, i) GROUP BY label)
"""


def label_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Query vectors derived from the table: the mean embedding of each label."""
    emb = table(spark, sf, "embeddings").select("label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    means = emb.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select(F.col("label").cast("long").alias("qid"), vector_to_array("m").alias("embedding"))


def vector_table(spark: SparkSession, sf: str) -> DataFrame:
    """``embeddings`` as a store whose ids are the table's own."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def embedding_store(spark: SparkSession, sf: str) -> DataFrame:
    """The vector store over ``embeddings``: ids in ``vec_id`` order, metadata = other columns."""
    emb = table(spark, sf, "embeddings")
    return add_vectors(None, emb.select(F.col("vec_id").cast("string").alias("text"), "vec_id", "label", "embedding"),
                       order=["vec_id"])


@query("topk_vectors", _VEC_SQL + """
SELECT label, vec_id, rank, round(score, 6) AS score FROM (
  SELECT q.label, e.vec_id, list_dot_product(q.qv, e.v) / (sqrt(list_dot_product(q.qv, q.qv)) * sqrt(list_dot_product(e.v, e.v))) AS score,
         CAST(row_number() OVER (PARTITION BY q.label ORDER BY list_dot_product(q.qv, e.v) / (sqrt(list_dot_product(q.qv, q.qv)) * sqrt(list_dot_product(e.v, e.v))) DESC, e.vec_id) AS INT) AS rank
  FROM q, e) WHERE rank <= 5
""")
def topk_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Exact top-5 search (T1) over the whole store for each label's mean vector."""
    hits = search_topk(vector_table(spark, sf), label_centroids(spark, sf), k=5)
    return hits.select(F.col("qid").alias("label"), F.col("id").alias("vec_id"), "rank", F.round("score", 6).alias("score"))


@query("topk_vectors_many", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings)
SELECT qid, vec_id, rank FROM (
  SELECT q.vec_id AS qid, e.vec_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, e.v) / (q.n * e.n) DESC, e.vec_id) AS INT) AS rank
  FROM e q, e) WHERE rank <= 3
""")
def topk_vectors_many(spark: SparkSession, sf: str) -> DataFrame:
    """Exact top-3 search (T1) with every vector of the table as a query."""
    store = vector_table(spark, sf)
    return search_topk(store, store.withColumnRenamed("id", "qid"), k=3).select("qid", F.col("id").alias("vec_id"), "rank")


_T1_SQL = ORACLE["topk_vectors"]


@query("ivf_topk_exhaustive", _T1_SQL)
def ivf_topk_exhaustive(spark: SparkSession, sf: str) -> DataFrame:
    """T2 with every list probed: equals the exact search."""
    hits = ivf_topk(vector_table(spark, sf), label_centroids(spark, sf), k=5, nlist=20, nprobe=20)
    return hits.select(F.col("qid").alias("label"), F.col("id").alias("vec_id"), "rank", F.round("score", 6).alias("score"))


#: The settings of the approximate result queries, at which their recall is measured.  100 lists are the reference's; its one
#: probe finds a tenth of the hits on these vectors, which hardly form clusters.  No two unit vectors lie 2.1 apart.
IVF = {"nlist": 100, "nprobe": 80}
LSH = {"bucket_length": 1.0, "tables": 8, "max_distance": 2.1}
RECALL = 0.9


@query("ivf_topk_vectors")
def ivf_topk_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate top-5 (T2): 100 k-means lists, 80 probed per query."""
    hits = ivf_topk(vector_table(spark, sf), label_centroids(spark, sf), k=5, **IVF)
    return hits.select(F.col("qid").alias("label"), "id", "rank", F.round("score", 6).alias("score"))


@query("lsh_topk_vectors")
def lsh_topk_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate top-5 (T3): random-projection LSH buckets as candidate keys."""
    hits = lsh_topk(vector_table(spark, sf), label_centroids(spark, sf), k=5, **LSH)
    return hits.select(F.col("qid").alias("label"), "id", "rank", F.round("score", 6).alias("score"))


def _recall(approximate: DataFrame, exact: DataFrame, floor: float) -> DataFrame:
    """Per query, whether the share of the exact hits that the approximate search found reaches the floor."""
    found = exact.select("qid", "id").join(approximate.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left")
    return found.groupBy("qid").agg((F.count("hit") >= floor * F.count("*")).alias("recall_reached"))


@query("ivf_recall_vectors", "SELECT DISTINCT CAST(label AS BIGINT) AS label, true AS recall_reached FROM embeddings")
def ivf_recall_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """T2 as ``ivf_topk_vectors`` has it finds at least ``RECALL`` of the exact top 5 of every label."""
    store, q = vector_table(spark, sf), label_centroids(spark, sf)
    return _recall(ivf_topk(store, q, k=5, **IVF), search_topk(store, q, k=5), RECALL).withColumnRenamed("qid", "label")


@query("lsh_recall_vectors", "SELECT DISTINCT CAST(label AS BIGINT) AS label, true AS recall_reached FROM embeddings")
def lsh_recall_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """T3 as ``lsh_topk_vectors`` has it finds at least ``RECALL`` of the exact top 5 of every label."""
    store, q = vector_table(spark, sf), label_centroids(spark, sf)
    return _recall(lsh_topk(store, q, k=5, **LSH), search_topk(store, q, k=5), RECALL).withColumnRenamed("qid", "label")


def _rows_as_queries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    store = vector_table(spark, sf)
    return store, store.where("id % 50 = 0").withColumnRenamed("id", "qid")


_ROWS_SQL = "SELECT vec_id AS qid, true AS recall_reached FROM embeddings WHERE vec_id % 50 = 0"


@query("ivf_recall_rows", _ROWS_SQL)
def ivf_recall_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same for T2 with every fiftieth vector of the table as a query."""
    store, q = _rows_as_queries(spark, sf)
    return _recall(ivf_topk(store, q, k=5, **IVF), search_topk(store, q, k=5), RECALL)


@query("lsh_recall_rows", _ROWS_SQL)
def lsh_recall_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same for T3 with every fiftieth vector of the table as a query."""
    store, q = _rows_as_queries(spark, sf)
    return _recall(lsh_topk(store, q, k=5, **LSH), search_topk(store, q, k=5), RECALL)


#: Searches over compact codes: rows re-ranked per hit, and the greatest share of the store that they may read: the bytes of a code
#: over those of a vector, plus the vectors that are re-ranked.
SKETCHES = {"signs": 40, "bytes": 4}
MOST_READ = 0.3


def _sketch_search(spark: SparkSession, sf: str, kind: str) -> tuple[DataFrame, DataFrame]:
    return encoded(vector_table(spark, sf), kind), label_centroids(spark, sf)


@query("sign_topk_vectors")
def sign_topk_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate top-5 (T3): 256 sign bits of random projections as codes, the 200 most alike re-ranked."""
    hits = sketch_topk(*_sketch_search(spark, sf, "signs"), k=5, kind="signs", refine=SKETCHES["signs"])
    return hits.select(F.col("qid").alias("label"), "id", "rank", F.round("score", 6).alias("score"))


@query("byte_topk_vectors")
def byte_topk_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate top-5 (T2's quantised form): a byte per dimension as code, the 20 most alike re-ranked."""
    hits = sketch_topk(*_sketch_search(spark, sf, "bytes"), k=5, kind="bytes", refine=SKETCHES["bytes"])
    return hits.select(F.col("qid").alias("label"), "id", "rank", F.round("score", 6).alias("score"))


@query("sketch_recall", """
SELECT kind, asked, true AS recall_reached, true AS read_bounded FROM (SELECT unnest(['bytes', 'signs']) AS kind), (SELECT unnest(['means', 'rows']) AS asked)
""")
def sketch_recall(spark: SparkSession, sf: str) -> DataFrame:
    """T2, T3 as the two queries have them, for the label means and for every fiftieth row: the share of the exact top 5 found is ``RECALL``
    or more, and codes and re-ranked vectors are at most ``MOST_READ`` of the floats of the store, per query, where that has 2 000 rows."""
    store, rows = _rows_as_queries(spark, sf)
    out = None
    for asked, queries in (("means", label_centroids(spark, sf)), ("rows", rows)):
        exact = search_topk(store, queries, k=5).select("qid", "id")
        for kind, refine in SKETCHES.items():
            found = sketch_topk(encoded(store, kind), queries, k=5, kind=kind, refine=refine).select("qid", "id", F.lit(1).alias("hit"))
            recall = exact.join(found, ["qid", "id"], "left").agg((F.count("hit") >= RECALL * F.count("*")).alias("recall_reached"))
            dims = F.max(F.size("embedding"))
            code_bytes = F.lit(32.0) if kind == "signs" else dims + 4.0
            read = store.agg((code_bytes / (4.0 * dims) + 5.0 * refine / F.greatest(F.count("*"), F.lit(2000)) <= MOST_READ).alias("read_bounded"))
            row = recall.withColumn("kind", F.lit(kind)).join(read.withColumn("kind", F.lit(kind)), "kind").select("kind", F.lit(asked).alias("asked"), "recall_reached", "read_bounded")
            out = row if out is None else out.unionByName(row)
    return out


@query("match_semantic_vectors", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT id_l, id_r, round(score, 6) AS semantic_score FROM (
  SELECT a.vec_id AS id_l, b.vec_id AS id_r,
         list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS score
  FROM e a JOIN e b ON a.vec_id < b.vec_id) WHERE score >= 0.4
""")
def match_semantic_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Exact cosine threshold join (J3, V1, V2): all vector pairs with cosine >= 0.4."""
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    pairs = cosine_join(emb, None, 0.4, clusters=16)
    return pairs.select("id_l", "id_r", F.round("score", 6).alias("semantic_score"))


@query("match_combined_parts", f"""
WITH c AS (SELECT CAST(p_partkey AS VARCHAR) AS _id, trim(p_name) AS title, p_name AS title_cleaned, p_partkey AS _ord,
                  CAST(split_part(p_brand, '#', 2) AS INT) AS bno, CAST(embedding AS DOUBLE[]) AS v
           FROM part LEFT JOIN embeddings ON p_partkey = vec_id),
     a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY _ord) rn FROM c WHERE bno <= 12) WHERE rn = 1),
     b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY _ord) rn FROM c WHERE bno > 12) WHERE rn = 1),
     ta AS (SELECT *, {_TOK.format(x='title_cleaned')} AS toks FROM a),
     tb AS (SELECT *, {_TOK.format(x='title_cleaned')} AS toks FROM b),
     s AS (SELECT ta._id AS _id1, tb._id AS _id2, ta.title_cleaned AS title, tb.title AS "references", ta._ord AS o1, tb._ord AS o2,
                  CASE WHEN len(ta.toks) = 0 OR len(tb.toks) = 0 THEN 0.0
                       ELSE 2.0 * {_LCS.format(a='tb.toks', b='ta.toks')} / (len(ta.toks) + len(tb.toks)) END AS rouge,
                  list_dot_product(ta.v, tb.v) / (sqrt(list_dot_product(ta.v, ta.v)) * sqrt(list_dot_product(tb.v, tb.v))) AS sem
           FROM ta, tb),
     k AS (SELECT *, rouge * 0.7 + coalesce(sem, 0.0) * 0.3 AS comb FROM s)
SELECT _id1, _id2, title, "references", round(comb, 6) AS main_score, round(rouge, 6) AS rouge_score,
       round(sem, 6) AS semantic_score FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(trim(title)) ORDER BY o1, o2) AS rk FROM k WHERE comb >= 0.5)
WHERE rk = 1
""")
def match_combined_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted ROUGE (0.7) + cosine (0.3) matching at 0.5 (J4) of the whole shop
    catalogues (a part without an embedding scores 0 there); one pair per title."""
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("_ord"), "embedding")
    a = dedupe_by_title(shop_catalogue(spark, sf, "A").join(emb, "_ord", "left"))
    b = dedupe_by_title(shop_catalogue(spark, sf, "B").join(emb, "_ord", "left"))
    cfg = MatchConfig(main_score="combined", threshold=0.5, use_rouge=True, use_semantic=True)
    pairs = match_catalogues(a, b, cfg)
    return pairs.select("_id1", "_id2", "title", "references", F.round("main_score", 6).alias("main_score"),
                        F.round("rouge_score", 6).alias("rouge_score"), F.round("semantic_score", 6).alias("semantic_score"))


@query("vector_roundtrip", """
SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS id, CAST(vec_id AS VARCHAR) AS text, vec_id, label,
       CAST(len(embedding) AS INT) AS dims
FROM embeddings
""")
def vector_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Build the store (V3, F9), save it with its info row (K3), load it back
    with the dimension check (S6)."""
    store = embedding_store(spark, sf)
    path = scratch_path(spark, "vector-store")
    save_store(store, path, model_name="embeddings-table", dimension=64)
    loaded, _ = load_store(spark, path, model_name="embeddings-table", dimension=64)
    return loaded.select("id", "text", F.col("metadata.vec_id").alias("vec_id"), F.col("metadata.label").alias("label"),
                         F.size("embedding").alias("dims"))


# ------------------------------------------------ F1 / F2 / F3 / A4 / S2 ----
def _seen_store(spark: SparkSession, sf: str) -> DataFrame:
    """The already-stored collection: the English section crawled earlier."""
    return table(spark, sf, "pages").where(F.col("url").contains("/en/")).select("url")


@query("new_urls", """
SELECT DISTINCT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE contains(url, '/en/'))
""")
def new_urls_pages(spark: SparkSession, sf: str) -> DataFrame:
    """sitemap URLs not in the store (left anti join on the key column)."""
    return new_urls(table(spark, sf, "pages").select("url"), _seen_store(spark, sf))


@query("url_counts", """
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(sum(CASE WHEN url IN (SELECT url FROM pages WHERE contains(url, '/en/')) THEN 0 ELSE 1 END) AS BIGINT) AS new
FROM pages
""")
def url_counts_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A4: total and new URL counts."""
    return url_counts(table(spark, sf, "pages").select("url"), _seen_store(spark, sf))


@query("url_keyword_filter", """
SELECT page_id, url FROM pages
WHERE contains(url, 'https') AND contains(url, 'example') AND NOT contains(url, 'spam') AND NOT contains(url, 'utm_source')
""")
def url_keyword_filter(spark: SparkSession, sf: str) -> DataFrame:
    """F1 with shop-independent keywords: https pages, no spam farm, no tracking links."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return keyword_filter(pages, "url", all_of=("https", "example"), none_of=("spam", "utm_source"))


@query("brand_filter", """
SELECT page_id, url FROM pages WHERE regexp_matches(lower(url),
  'iphone|samsung|xiaomi|oppo|realme|nothing|infinix|vivo|tecno|sony|itel|nubia|masstel|nokia|oneplus|tcl|inoi|benco|asus')
""")
def brand_filter(spark: SparkSession, sf: str) -> DataFrame:
    """URLs naming one of the phone brands."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.where(contains_brand("url"))


@query("sitemap_urls", "SELECT url AS loc FROM pages")
def sitemap_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The page URLs written as a sitemap (urlset/url/loc) and read back one row per loc."""
    path = scratch_path(spark, "sitemap")
    write_sitemap(table(spark, sf, "pages"), path)
    return read_sitemap(spark, path).select("loc")


# ------------------------------------------------ K2 / A3 / ST1-ST5 ---------
_FIRST_EVENT_SQL = """
SELECT user_id, event_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_day FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), ts, event_id) AS rn FROM events
  WHERE user_id IS NOT NULL) WHERE rn = 1
"""


def _events_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """The item stream: events keyed by user, one batch per day (only the columns the store keeps)."""
    return (table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
            .withColumn("batch_day", F.to_date("ts")))


@query("insert_if_absent", _FIRST_EVENT_SQL)
def insert_if_absent_events(spark: SparkSession, sf: str) -> DataFrame:
    """K2 over daily batches of ``events`` keyed by ``user_id``: the store that
    first-write-wins leaves after all batches."""
    stored = insert_all_batches(_events_by_day(spark, sf), "user_id", "batch_day", ["ts", "event_id"])
    return stored.select("user_id", "event_id", "event_type", F.col("batch_day").cast("string").alias("batch_day"))


@query("load_stats", """
WITH f AS (""" + _FIRST_EVENT_SQL + """),
     b AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_day, count(*) AS processed,
                  sum(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS errors FROM events GROUP BY 1),
     i AS (SELECT batch_day, count(*) AS inserted FROM f GROUP BY 1)
SELECT b.batch_day, CAST(processed AS BIGINT) AS processed, CAST(coalesce(inserted, 0) AS BIGINT) AS inserted,
       CAST(processed - errors - coalesce(inserted, 0) AS BIGINT) AS duplicates, CAST(errors AS BIGINT) AS errors
FROM b LEFT JOIN i ON b.batch_day = i.batch_day
""")
def load_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A3 per daily batch: processed, inserted, duplicates, errors."""
    items = _events_by_day(spark, sf)
    stored = insert_all_batches(items, "user_id", "batch_day", ["ts", "event_id"])
    st = batch_stats(items, stored, "user_id", "batch_day")
    return st.select(F.col("batch_day").cast("string").alias("batch_day"), "processed", "inserted", "duplicates",
                     F.col("errors").cast("long").alias("errors"))


def _run_event_stream(spark: SparkSession, sf: str, valid=None, profile: str | None = None) -> str:
    """Run the streaming load of the daily batches, with a profile in micro-batches of its size, a day's in one trigger; the folder
    that holds its store, stats and quarantine."""
    base = scratch_path(spark, "event-stream")
    items = _events_by_day(spark, sf)
    flush = "flush" if profile else None
    stage_batches(items, "batch_day", f"{base}/in", ["ts", "event_id"], PROFILES[profile] if profile else None, flush)
    staged = items.withColumn(flush, F.lit(0).cast("long")) if flush else items
    stream = staged_stream(spark, f"{base}/in", staged.schema, PROFILES[profile or "default"])
    stream_insert_if_absent(stream, f"{base}/store", f"{base}/stats", f"{base}/checkpoint", key="user_id", order=["batch_day", "ts", "event_id"],
                            valid=valid, quarantine=f"{base}/quarantine", flush=flush).awaitTermination()
    return base


@query("stream_profile_batches", """
WITH d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_day, count(*) AS n FROM events GROUP BY 1)
SELECT batch_day, CAST((n + 199) // 200 AS BIGINT) AS n_batches, CAST(n AS BIGINT) AS processed, true AS bounded FROM d
""")
def stream_profile_batches(spark: SparkSession, sf: str) -> DataFrame:
    """ST1: with the profile of 200 items each day comes in as many micro-batches as it needs, none with more.  A trigger takes a day's
    micro-batches together, so their number does not set the number of jobs."""
    base = _run_event_stream(spark, sf, profile="fast")
    per_day = spark.read.parquet(f"{base}/stats").groupBy(F.col("first_item").alias("batch_day"))
    return per_day.agg(F.count("*").alias("n_batches"), F.sum("processed").alias("processed"), (F.max("processed") <= PROFILES["fast"].size).alias("bounded"))


@query("stream_insert_if_absent", _FIRST_EVENT_SQL)
def stream_insert_if_absent_events(spark: SparkSession, sf: str) -> DataFrame:
    """ST2/ST3: ``events`` replayed as one file per day through a file stream;
    each micro-batch is inserted-if-absent; the result is the store."""
    store = _run_event_stream(spark, sf) + "/store"
    return spark.read.parquet(store).select("user_id", "event_id", "event_type",
                                            F.col("batch_day").cast("string").alias("batch_day"))


# ``error`` events, and on the first day all events, are invalid items of these two queries.
_INVALID_SQL = "(event_type = 'error' OR CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events))"


def _valid_event(spark: SparkSession, sf: str):
    first = _events_by_day(spark, sf).agg(F.min("batch_day")).first()[0]
    return (F.col("event_type") != "error") & (F.col("batch_day") != F.lit(first))


@query("stream_stats", f"""
WITH f AS (SELECT user_id, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS batch_day FROM events WHERE NOT {_INVALID_SQL} GROUP BY user_id),
     b AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_day, count(*) AS processed, count(*) FILTER (WHERE {_INVALID_SQL}) AS errors FROM events GROUP BY 1),
     i AS (SELECT batch_day, count(*) AS inserted FROM f GROUP BY 1)
SELECT b.batch_day AS first_item, CAST(processed AS BIGINT) AS processed, CAST(coalesce(inserted, 0) AS BIGINT) AS inserted,
       CAST(processed - errors - coalesce(inserted, 0) AS BIGINT) AS duplicates, CAST(errors AS BIGINT) AS errors
FROM b LEFT JOIN i ON b.batch_day = i.batch_day
""")
def stream_stats(spark: SparkSession, sf: str) -> DataFrame:
    """ST4: the per-micro-batch stats rows of a streaming load with invalid items; its first batch holds nothing else."""
    stats = _run_event_stream(spark, sf, _valid_event(spark, sf)) + "/stats"
    return spark.read.parquet(stats).select("first_item", "processed", "inserted", "duplicates", "errors")


@query("stream_quarantine", f"""
SELECT event_id, user_id, event_type FROM events WHERE {_INVALID_SQL}
""")
def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """ST5: the invalid items that the streaming load set aside."""
    quarantine = _run_event_stream(spark, sf, _valid_event(spark, sf)) + "/quarantine"
    return spark.read.parquet(quarantine).select("event_id", "user_id", "event_type")


# ------------------------------------------------ A6 / J8 / F7 / S5 ---------
@query("group_specs_events", """
SELECT user_id AS doc_id, event_type AS "group", name, value FROM (
  SELECT user_id, event_type, props, value AS v,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type IS NOT NULL AND trim(event_type) <> '') e,
  LATERAL (SELECT 'k' AS name, CAST(json_extract(e.props, '$.k') AS VARCHAR) AS value
           UNION ALL SELECT 'value', CAST(e.v AS VARCHAR)) a
WHERE rn = 1 AND value IS NOT NULL
""")
def group_specs_events(spark: SparkSession, sf: str) -> DataFrame:
    """A6 over ``events``: each event is an attribute item of its user, grouped by
    event type; the latest item of a group wins whole."""
    ev = table(spark, sf, "events")
    items = ev.select(F.col("user_id").alias("doc_id"), F.struct("ts", "event_id").alias("item_pos"),
                      F.col("event_type").alias("groupName"),
                      F.array(F.struct(F.lit("k").alias("displayName"),
                                       F.get_json_object("props", "$.k").alias("value")),
                              F.struct(F.lit("value").alias("displayName"),
                                       F.col("value").cast("string").alias("value"))).alias("attributes"))
    return group_specs_long(items).select("doc_id", "group", "name", "value")


_REF_VALUE_SQL = ("CASE WHEN event_type = 'click' AND event_id > 0 THEN '$' || CAST(event_id // 2 AS VARCHAR) "
                  "WHEN event_type = 'error' THEN '$missing' ELSE event_type END")


@query("resolve_refs_events", f"""
WITH RECURSIVE n AS (SELECT CAST(event_id AS VARCHAR) AS k, {_REF_VALUE_SQL} AS v FROM events),
r AS (SELECT k, v AS cur, 0 AS depth FROM n
      UNION ALL
      SELECT r.k, n.v, r.depth + 1 FROM r JOIN n ON substr(r.cur, 2) = n.k
      WHERE starts_with(r.cur, '$') AND r.depth < 64)
SELECT CAST(k AS VARCHAR) AS "key", CASE WHEN starts_with(cur, '$') THEN NULL ELSE cur END AS resolved FROM (
  SELECT k, cur, row_number() OVER (PARTITION BY k ORDER BY depth DESC) AS rn FROM r) WHERE rn = 1
""")
def resolve_refs_events(spark: SparkSession, sf: str) -> DataFrame:
    """J8 over a node table derived from ``events``: a click points at event
    id//2, an error at a key that does not exist; values resolve transitively."""
    ev = table(spark, sf, "events")
    value = (F.when((F.col("event_type") == "click") & (F.col("event_id") > 0),
                    F.concat(F.lit("$"), (F.col("event_id") / 2).cast("long").cast("string")))
              .when(F.col("event_type") == "error", F.lit("$missing")).otherwise(F.col("event_type")))
    nodes = ev.select(F.lit(0).alias("doc_id"), F.col("event_id").cast("string").alias("key"), value.alias("value"))
    return resolve_refs(nodes).select("key", "resolved")


@query("drop_keys_pages", """
SELECT page_id, to_json({'page_id': page_id, 'links': list_transform(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2), lambda t: {'text': t})}) AS record
FROM pages
""")
def drop_keys_pages(spark: SparkSession, sf: str) -> DataFrame:
    """nested page records lose every ``url`` field, at the top and inside the link list."""
    pages = table(spark, sf, "pages")
    links = F.transform(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)">([^<]*)</a>'), 0),
                        lambda a: F.struct(F.regexp_extract(a, r'href="([^"]*)"', 1).alias("url"),
                                           F.regexp_extract(a, r">([^<]*)<", 1).alias("text")))
    rec = pages.select("page_id", F.struct("url", "page_id", links.alias("links")).alias("record"))
    cleaned = drop_keys(rec)
    return cleaned.select("page_id", F.to_json("record").alias("record"))


@query("noisy_json_events", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def noisy_json_events(spark: SparkSession, sf: str) -> DataFrame:
    """The props JSON wrapped in log noise ('[log] ... done') is recovered."""
    ev = table(spark, sf, "events")
    noisy = F.concat(F.lit("[log] event "), F.col("event_id").cast("string"), F.lit(": "), F.col("props"), F.lit(" done"))
    return ev.select("event_id", parse_noisy_json(noisy, "struct<k bigint>").getField("k").alias("k"))


# ------------------------------------------------ C1-C6 / N5 ----------------
@query("price_parse_orders", """
SELECT o_orderkey, replace(format('{:,}', CAST(round(o_totalprice) AS BIGINT)), ',', '.') || '₫' AS price_text,
       CAST(round(o_totalprice) AS BIGINT) AS price,
       CAST(round(o_totalprice) AS BIGINT) AS reward_points,
       replace(format('{:,}', CAST(round(o_totalprice) AS BIGINT)), ',', '.') || '₫' AS picked_text,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS crawled_at,
       trim(replace(o_orderpriority, '-', '')) AS priority_label
FROM orders
""")
def price_parse_orders(spark: SparkSession, sf: str) -> DataFrame:
    """C1-C6 over ``orders``: totals rendered as shop price text, parsed back,
    read as reward points, picked among candidate texts; order date as crawl time."""
    o = table(spark, sf, "orders")
    text = format_price(F.round("o_totalprice"))
    return o.select("o_orderkey", text.alias("price_text"), parse_price(text).alias("price"),
                    reward_points(F.concat(F.lit("+"), text, F.lit(" Điểm thưởng"))).alias("reward_points"),
                    pick_price_text(F.array("o_orderpriority", "o_orderstatus", text)).alias("picked_text"),
                    crawl_time("o_orderdate").alias("crawled_at"),
                    strip_label("o_orderpriority", "-").alias("priority_label"))


@query("clean_lines_documents", """
SELECT doc_id, CAST(length(c) AS BIGINT) AS n_chars, md5(c) AS digest FROM (
  SELECT doc_id, coalesce(list_reduce(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)),
                                                  lambda x: length(x) >= 2), lambda acc, x: acc || x || chr(10), ''), '') AS c
  FROM documents)
""")
def clean_lines_documents(spark: SparkSession, sf: str) -> DataFrame:
    """N5 over whole documents: lines stripped, those under 2 characters dropped, newline after each."""
    docs = table(spark, sf, "documents")
    c = join_clean_lines(F.split("text", "\n"))
    return docs.select("doc_id", F.length(c).cast("long").alias("n_chars"), F.md5(c).alias("digest"))


# ------------------------------------------------ S1 / K1 / J7 / A5 / K4 / A9 --
@query("csv_roundtrip_pairs", _SHOPS_SQL + """
SELECT _id1, _id2, title, "references", main_score, main_score_type, capacities_1, capacities_2 FROM (
  SELECT a._id AS _id1, b._id AS _id2, a.title_cleaned AS title, b.title AS "references",
         1.0::DOUBLE AS main_score, 'string' AS main_score_type,
         a.capacities AS capacities_1, b.capacities AS capacities_2,
         row_number() OVER (PARTITION BY lower(trim(a.title_cleaned)) ORDER BY a._ord, b._ord) AS rk
  FROM a JOIN b ON a.title_cleaned = b.title_cleaned) WHERE rk = 1
""")
def csv_roundtrip_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """K1 then S1: the stage-2 pair table written as CSV and read back with its schema."""
    pairs = match_exact_parts(spark, sf)
    path = scratch_path(spark, "pairs-csv")
    write_csv(pairs, path)
    schema = ", ".join(f"`{c}` string" for c in pairs.columns)
    back = read_catalogue(spark, path, schema, multi_line=False)
    return back.select("_id1", "_id2", "title", "references", F.col("main_score").cast("double").alias("main_score"),
                       "main_score_type", "capacities_1", "capacities_2")


@query("variant_matrix_parts", """
WITH s AS (SELECT DISTINCT p_name, p_size FROM part), c AS (SELECT DISTINCT p_name, p_type FROM part)
SELECT s.p_name AS product, s.p_size || 'GB' AS storage, c.p_type AS color,
       CAST(3 AS INT) AS specCount
FROM s JOIN c ON s.p_name = c.p_name
""")
def variant_matrix_parts(spark: SparkSession, sf: str) -> DataFrame:
    """J7 + A5 + K4: per product every storage x colour variant with its spec
    section, written as JSON and read back."""
    part = table(spark, sf, "part")
    per = part.groupBy("p_name").agg(
        F.array_sort(F.collect_set(F.concat(F.col("p_size").cast("string"), F.lit("GB")))).alias("storages"),
        F.array_sort(F.collect_set("p_type")).alias("colors"))
    variants, _errors = variant_matrix(per, key="p_name")
    spec = F.array(F.struct(F.lit("general").alias("id"), F.lit("General").alias("title"),
                            F.array(F.struct(F.lit("storage").alias("label"), F.array("storage").alias("value")),
                                    F.struct(F.lit("color").alias("label"), F.array("color").alias("value")),
                                    F.struct(F.lit("product").alias("label"), F.array("p_name").alias("value")))
                            .alias("specifications")))
    counted = spec_counts(variants.withColumn("sections", spec))
    path = scratch_path(spark, "variants-json")
    write_json(counted.select("p_name", "storage", "color", "sections", "totalSpecs"), path)
    back = spark.read.schema("p_name string, storage string, color string, totalSpecs int").json(path)
    return back.select(F.col("p_name").alias("product"), "storage", "color", F.col("totalSpecs").alias("specCount"))


@query("match_summary_parts", _SHOPS_SQL + """
SELECT CAST((SELECT count(*) FROM a) AS BIGINT) AS n1, CAST((SELECT count(*) FROM b) AS BIGINT) AS n2,
       CAST((SELECT count(*) FROM a JOIN b ON a.title_cleaned = b.title_cleaned) AS BIGINT) AS n_results
""")
def match_summary_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue sizes after de-duplication and number of matched pairs."""
    a = dedupe_by_title(shop_catalogue(spark, sf, "A"))
    b = dedupe_by_title(shop_catalogue(spark, sf, "B"))
    return match_summary(a, b, MatchConfig(main_score="string", use_rouge=False))


@query("match_summary_cleaned", f"""
WITH a2 AS (SELECT DISTINCT 'Điện thoại ' || {_INITCAP.format(x='p_name')} || ' ' || p_size || 'GB - Chính hãng' AS title, lower(trim(p_name)) AS t
            FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INT) <= 12),
     b2 AS (SELECT DISTINCT {_INITCAP.format(x='p_name')} || ' ' || p_size || 'GB - Chỉ có tại Shop' AS title,
                   trim(regexp_replace(regexp_replace(lower(trim(p_name)), '\\b({_ASCII_COLOURS})\\b', '', 'g'), '\\s+', ' ', 'g')) AS t
            FROM part WHERE CAST(split_part(p_brand, '#', 2) AS INT) > 12)
SELECT CAST((SELECT count(*) FROM a2) AS BIGINT) AS n1, CAST((SELECT count(*) FROM b2) AS BIGINT) AS n2,
       CAST((SELECT count(*) FROM a2 JOIN b2 ON a2.t = b2.t) AS BIGINT) AS n_results
""")
def match_summary_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """A9 on cleaned titles, where many pairs share a title: all of them count."""
    a = dedupe_by_title(_decorated_catalogue(spark, sf, "A"))
    b = dedupe_by_title(_decorated_catalogue(spark, sf, "B"))
    return match_summary(a, b, MatchConfig(main_score="string", use_rouge=False, clean_titles=True,
                                           dataset1_type=DASHED_TITLE_DATASET, dataset2_type="other"))


# ------------------------------------------------ S1 / S3 / S4 / S2 on awkward files --
@query("csv_columns_by_name", """
SELECT CAST(p_partkey AS VARCHAR) AS _id, p_name AS title, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_size || 'GB' END AS capacities FROM part
""")
def csv_columns_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV with columns in another order, more columns and null tokens is read by name."""
    part = table(spark, sf, "part")
    path = scratch_path(spark, "shuffled-csv")
    write_csv(part.select(F.col("p_name").alias("title"), F.col("p_brand").alias("extra"), F.when(F.col("p_size") % 2 == 0, "NaN")
                          .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("GB"))).alias("capacities"),
                          F.col("p_partkey").alias("_id")), path)
    return read_catalogue(spark, path, "_id string, title string, capacities string", multi_line=False).drop("_ord")


@query("stored_pages", """
SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS html_bytes FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE contains(url, '/en/'))
""")
def stored_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Fetched pages whose URL is not among the keys of a store written as Parquet."""
    path = scratch_path(spark, "seen-store")
    _seen_store(spark, sf).withColumn("extra", F.lit(1)).write.parquet(path)
    pages = read_pages(spark, f"{sf.rstrip('/')}/pages.parquet")
    left = pages.join(read_store_keys(spark, path), "url", "left_anti")
    return left.select("page_id", "url", F.octet_length("html").cast("long").alias("html_bytes"))


@query("sitemap_text_entries", """
SELECT url AS loc, page_id % 5 = 0 AS is_index FROM pages
""")
def sitemap_text_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries that are plain text (every third), entries with a ``loc``, and an index (every fifth page)
    among the files, told apart by their elements."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    path = scratch_path(spark, "sitemap-mixed")
    for index in (False, True):
        for name, column in (("text", "_VALUE"), ("loc", "loc")):
            some = pages.where(((F.col("page_id") % 5 == 0) == F.lit(index)) & ((F.col("page_id") % 3 == 0) == F.lit(name == "text")))
            (some.select(F.col("url").alias(column)).write.format("xml").option("rootTag", "sitemapindex" if index else "urlset")
             .option("rowTag", "sitemap" if index else "url").save(f"{path}/{index}-{name}"))
    return read_sitemap(spark, [f"{path}/{index}-{name}" for index in (False, True) for name in ("text", "loc")]).select("loc", "is_index")


# ------------------------------------------------ F2 / F5 / F6 / F7 / F10 / C4 / C5 / L1 where some rows fail --
@query("brand_filter_derived", """
SELECT page_id, url FROM (SELECT page_id, url || '/' || CASE page_id % 4 WHEN 0 THEN 'Galaxy-SAMSUNG' WHEN 1 THEN 'pixel' WHEN 2 THEN 'iPhone-15' ELSE 'thong' END AS url FROM pages)
WHERE regexp_matches(lower(url), 'samsung|iphone|nothing|vivo|sony|asus|nokia|tcl|oppo')
""")
def brand_filter_derived(spark: SparkSession, sf: str) -> DataFrame:
    """F2 on URLs of which half name a brand."""
    word = F.when(F.col("page_id") % 4 == 0, "Galaxy-SAMSUNG").when(F.col("page_id") % 4 == 1, "pixel").when(F.col("page_id") % 4 == 2, "iPhone-15").otherwise("thong")
    pages = table(spark, sf, "pages").select("page_id", F.concat("url", F.lit("/"), word).alias("url"))
    return pages.where(contains_brand("url"))


@query("page_status_derived", """
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'error: HTTP 500' WHEN page_id % 3 = 0 THEN 'no_name_found' ELSE 'success' END AS status,
       CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'inner ' || page_id || ' tail é' END AS box, page_id || '-b' AS sku
FROM pages WHERE page_id % 5 <> 0
""")
def page_status_derived(spark: SparkSession, sf: str) -> DataFrame:
    """X1, F5, F6, F10, C5 on derived pages: a fifth lacks the container, a third the name, a seventh failed; the box
    is nested, single-quoted, holds a numeric reference and stands after one whose class only starts alike."""
    page_id = F.col("page_id").cast("string")
    name = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.concat(
        F.lit("<h1 class='x name'>N</h1><div class=\"box-old\">old</div><div id=q class='a box'><div>inner "), page_id, F.lit("</div> tail &#233;</div>")))
    body = F.concat(F.lit("<html><body><"), F.when(F.col("page_id") % 5 == 0, "section").otherwise("article"), F.lit(">"), name, F.lit("</article></body></html>"))
    pages = table(spark, sf, "pages").select("page_id", F.concat(F.lit("http://s/p?SKU="), page_id, F.lit("-b")).alias("url"), body.alias("html"))
    rec = extract_fields(require_container(pages, Rule("main", "article")), [Rule("name", "h1", cls="name"), Rule("box", "div", cls="box")])
    error = F.when(F.col("page_id") % 7 == 0, "HTTP 500")
    rec = rec.select("page_id", F.struct("name", F.lit(None).cast("string").alias("box")).alias("a"),
                     F.struct("box", F.concat(sku_from_url("url"), F.lit("-b")).alias("sku")).alias("b"), record_status(F.col("name"), error).alias("status"))
    return merge_sections(rec, ["a", "b"]).select("page_id", "status", "product_data.box", "product_data.sku")


@query("variant_prices_parts", """
SELECT p_partkey, CAST(i AS INT) AS variant, 'SKU' || p_partkey || '_' || i AS sku,
       CASE WHEN p_size % 3 = 0 OR round(p_retailprice) * i < 1000 THEN NULL ELSE replace(format('{:,}', CAST(round(p_retailprice) * i AS BIGINT)), ',', '.') || '₫' END AS price_text,
       CASE WHEN p_size % 3 = 0 OR round(p_retailprice) * i < 1000 THEN NULL ELSE CAST(round(p_retailprice) * i AS BIGINT) END AS price,
       CASE WHEN p_size % 2 = 0 THEN '["null Black"]' WHEN p_size % 3 = 0 THEN '["x, None, y"]' ELSE '[null,"None Blue"]' END AS colours
FROM part, (SELECT unnest(range(1, 4)) AS i)
""")
def variant_prices_parts(spark: SparkSession, sf: str) -> DataFrame:
    """X20 with C4, C5 and L1: price text (padded among other texts) and SKU per variant, and the colour list literal."""
    part = table(spark, sf, "part").select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("variant"))
    text = F.when(F.col("p_size") % 3 != 0, format_price(F.round("p_retailprice") * F.col("variant")))
    url = F.concat(F.lit("https://s/p/sku/SKU"), F.col("p_partkey").cast("string"), F.lit("_"), F.col("variant").cast("string"), F.lit("?c=1"))
    picked = pick_price_text(F.array(F.lit("Trả góp"), F.concat(F.lit("  "), text, F.lit(" \n"))))
    literal = F.when(F.col("p_size") % 2 == 0, "['null Black']").when(F.col("p_size") % 3 == 0, "['x, None, y']").otherwise("[None, 'None Blue']")
    return part.select("p_partkey", "variant", sku_from_url(url).alias("sku"), picked.alias("price_text"), parse_price(picked).alias("price"),
                       F.to_json(parse_list_literal(literal)).alias("colours"))


@query("drop_keys_nullable", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{"event_id":' || event_id || '}' WHEN event_id % 3 = 1
  THEN '{"event_id":' || event_id || ',"meta":{}}' ELSE '{"event_id":' || event_id || ',"meta":{"kind":"' || event_type || '"}}' END AS record
FROM events
""")
def drop_keys_nullable(spark: SparkSession, sf: str) -> DataFrame:
    """F7 with a nested struct that is null in a third of the rows and empty in another: null stays null."""
    ev = table(spark, sf, "events").select("event_id", "event_type")
    meta = F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.struct(
        F.lit("u").alias("url"), F.when(F.col("event_id") % 3 == 2, F.col("event_type")).alias("kind")))
    cleaned = drop_keys(ev.select("event_id", F.struct("event_id", meta.alias("meta"), F.lit("x").alias("icon")).alias("record")))
    return cleaned.select("event_id", F.to_json("record").alias("record"))


from shelfmatch.plans import json_trees, shop_pages  # noqa: E402,F401  these register their queries


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Apply the session settings (UTC, work folder, package shipped to workers) before planning."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ensure_session_defaults(spark)
        return fn(spark, sf)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _prepared(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
