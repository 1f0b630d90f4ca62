"""Catalogue matching.

Two catalogues ``(_id, title, title_cleaned, capacities, color_options,
_ord[, embedding])`` are matched by one main score - exact string, ROUGE-L
F1, embedding cosine, or their weighted sum - and a pair is kept when the
main score reaches the threshold; then one pair per normalised title.

No plan here compares every row with every row:

* ``string``: the threshold (> 0) means equal titles, i.e. an equi-join.
  Because only the first pair per title survives, both sides are first
  reduced to their first row per join key (a partial aggregate), so a hot
  title never multiplies into |L_k| x |R_k| rows.
* ``rouge``: a prefix-filtered token join (``rouge_join``): a pair reaching
  F1 >= t must share an element of the prefixes in an order that has frequent
  elements last, so candidates come from an equi-join on prefix elements (ids and places only) and are verified.
* ``semantic``: an exact cluster-pruned join (``vector_search.cosine_join``).
* ``combined``: ROUGE candidates under the bound the weights imply.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.rouge import lcs_length, lcs_of, min_overlap, rouge_l_f1, rouge_tokens, string_score
from shelfmatch.functions.text import DASHED_TITLE_DATASET, clean_title, map_distinct, normalize_title, py_strip
from shelfmatch.functions.vectors import cosine
from shelfmatch.operators.blocks import _groups, hash_block
from shelfmatch.operators.dedupe import keep_first
from shelfmatch.session import written

# An element is hot if it is one of so many parts of all elements; a hot element's join key is dealt out over so many salts.
HOT_PARTS, SALTS = 4096, 8
# From so many pairs of equal prefix elements on they are compared with what blocks would send; a block's tokens; pairs of texts and of elements held at once.
DENSE_PAIRS, BLOCK_TOKENS, TILE = 1 << 24, 1 << 17, 1 << 21

CATALOGUE_COLUMNS = ("_id", "title", "title_cleaned", "capacities", "color_options", "_ord")

PAIR_COLUMNS = (
    "_id1", "_id2", "title", "references", "title_cleaned", "references_cleaned", "is_cleaned",
    "main_score", "main_score_type", "capacities_1", "capacities_2", "colors_1", "colors_2",
    "string_score", "rouge_score", "semantic_score", "combined_score",
)


@dataclass(frozen=True)
class MatchConfig:
    """The reference's configuration dict, typed.  Defaults are the reference's."""
    main_score: str = "string"
    threshold: float = 0.8
    use_rouge: bool = True
    use_semantic: bool = False
    weights: dict = field(default_factory=lambda: {"rouge": 0.7, "semantic": 0.3})
    clean_titles: bool = False
    dataset1_type: str = DASHED_TITLE_DATASET
    dataset2_type: str = "other"


def require_columns(df: DataFrame, cols, what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")


def _cleaned(df: DataFrame, dataset_type: str, use_clean: bool, dst: str) -> DataFrame:
    """N3 on ``title_cleaned`` into ``dst`` (once per distinct title when cleaning)."""
    if not use_clean:
        return df.withColumn(dst, F.col("title_cleaned"))
    return map_distinct(df, "title_cleaned", dst, lambda c: clean_title(c, dataset_type, True))


def _project(pairs: DataFrame, cfg: MatchConfig) -> DataFrame:
    """F8 + D1: the pair row; scores not computed are null."""
    cols = {
        "_id1": F.col("a._id"), "_id2": F.col("b._id"),
        "title": F.col("a.title_cleaned"), "references": F.col("b.title"),
        "title_cleaned": F.col("a.t"), "references_cleaned": F.col("b.t"),
        "is_cleaned": F.lit(cfg.clean_titles),
        "main_score": F.col(f"{cfg.main_score}_score"), "main_score_type": F.lit(cfg.main_score),
        "capacities_1": F.col("a.capacities"), "capacities_2": F.col("b.capacities"),
        "colors_1": F.col("a.color_options"), "colors_2": F.col("b.color_options"),
    }
    for s in ("string", "rouge", "semantic", "combined"):
        cols[f"{s}_score"] = F.col(f"{s}_score") if f"{s}_score" in pairs.columns else F.lit(None).cast("double")
    cols["main_score"] = cols[f"{cfg.main_score}_score"]
    return pairs.select(*[v.alias(k) for k, v in cols.items()], F.col("a._ord").alias("_ord1"),
                        F.col("b._ord").alias("_ord2"))


def match_catalogues(cat1: DataFrame, cat2: DataFrame, cfg: MatchConfig = MatchConfig(),
                     keep_order: bool = False) -> DataFrame:
    """Stage 2 of the reference: scored pairs at or above the threshold, one per title.

    Inputs should already be de-duplicated by title (``dedupe_by_title``).
    Output: ``PAIR_COLUMNS`` (plus ``_ord1, _ord2`` when ``keep_order``).
    """
    require_columns(cat1, CATALOGUE_COLUMNS, "catalogue 1")
    require_columns(cat2, CATALOGUE_COLUMNS, "catalogue 2")
    if cfg.main_score not in ("string", "rouge", "semantic", "combined"):
        raise ValueError(f"unknown main score {cfg.main_score!r}")
    if cfg.threshold <= 0:
        raise ValueError("threshold <= 0 keeps every pair (a full cross product); not supported")
    a = _cleaned(cat1, cfg.dataset1_type, cfg.clean_titles, "t")
    b = _cleaned(cat2, cfg.dataset2_type, cfg.clean_titles, "t")

    if cfg.main_score == "string":
        # Equal titles only.  First row per (join key, title key) on side 1 and per
        # join key on side 2 gives the same survivors as all pairs + keep-first.
        a1 = keep_first(a.withColumn("__tk", normalize_title("title_cleaned")).where(F.col("t").isNotNull()),
                        ["t", "__tk"], ["_ord"])
        b1 = keep_first(b.where(F.col("t").isNotNull()), ["t"], ["_ord"])
        pairs = a1.alias("a").join(b1.alias("b"), F.col("a.t") == F.col("b.t"))
        pairs = pairs.withColumn("string_score", F.lit(1.0))
        if cfg.use_rouge:
            pairs = pairs.withColumn("rouge_score", rouge_l_f1(F.col("b.t"), F.col("a.t")))
        if cfg.use_semantic:
            pairs = pairs.withColumn("semantic_score", cosine("a.embedding", "b.embedding"))
    else:
        pairs = _scored_candidates(a, b, cfg)

    projected = _kept(pairs, cfg)
    out = keep_first(projected.withColumn("__tk", normalize_title("title")), ["__tk"], ["_ord1", "_ord2"])
    cols = list(PAIR_COLUMNS) + (["_ord1", "_ord2"] if keep_order else [])
    return out.select(*cols)


def _kept(pairs: DataFrame, cfg: MatchConfig) -> DataFrame:
    """the projected pairs whose main score reaches the threshold; a score that is absent counts as 0."""
    if cfg.use_rouge and cfg.use_semantic:
        w = cfg.weights
        pairs = pairs.withColumn("combined_score", F.coalesce("rouge_score", F.lit(0.0)) * float(w.get("rouge", 0)) +
                                 F.coalesce("semantic_score", F.lit(0.0)) * float(w.get("semantic", 0)))
    return _project(pairs, cfg).where(F.coalesce(F.col("main_score"), F.lit(0.0)) >= F.lit(cfg.threshold))


def _scored_candidates(a: DataFrame, b: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Candidate pairs for the rouge/semantic/combined main scores, all scores attached."""
    from shelfmatch.operators.vector_search import cosine_join

    w = cfg.weights
    if cfg.main_score == "semantic":
        ids = cosine_join(a.select(F.col("_ord").alias("id"), F.col("embedding").alias("v")),
                          b.select(F.col("_ord").alias("id"), F.col("embedding").alias("v")),
                          cfg.threshold)
        ids = ids.select(F.col("id_l").alias("o1"), F.col("id_r").alias("o2"), F.col("score").alias("semantic_score"))
    else:
        t_rouge = cfg.threshold
        if cfg.main_score == "combined":
            if not (cfg.use_rouge and cfg.use_semantic):
                raise ValueError("combined score needs use_rouge and use_semantic")
            wr, ws = float(w.get("rouge", 0)), float(w.get("semantic", 0))
            if wr <= 0:
                raise ValueError("combined score with zero rouge weight needs a cross product; not supported")
            # |semantic| <= 1, so rouge must reach this; the slack leaves pairs at the bound to the exact test
            t_rouge = (cfg.threshold - abs(ws)) / wr - 1e-9
            if t_rouge <= 0:
                raise ValueError("weights make every pair a candidate (cross product); not supported")
        ids = rouge_join(a.select(F.col("_ord").alias("id"), F.col("t").alias("text")),
                         b.select(F.col("_ord").alias("id"), F.col("t").alias("text")), t_rouge)
        ids = ids.select(F.col("id_l").alias("o1"), F.col("id_r").alias("o2"), F.col("score").alias("rouge_score"))
    pairs = (ids.join(a.alias("a"), F.col("o1") == F.col("a._ord"))
                .join(b.alias("b"), F.col("o2") == F.col("b._ord")))
    pairs = pairs.withColumn("string_score", string_score(F.col("b.t"), F.col("a.t")))
    if cfg.use_rouge and "rouge_score" not in pairs.columns:
        pairs = pairs.withColumn("rouge_score", rouge_l_f1(F.col("b.t"), F.col("a.t")))
    if cfg.use_semantic and "semantic_score" not in pairs.columns:
        pairs = pairs.withColumn("semantic_score", cosine("a.embedding", "b.embedding"))
    return pairs


def _elements(texts: DataFrame) -> DataFrame:
    """id, toks (64-bit hashes of the tokens, in order), m, keys: the text's elements, (token, occurrence) hashed."""
    empty = F.col("text").isNull() | (F.col("text") == "")
    toks = F.when(empty, F.array().cast("array<string>")).otherwise(rouge_tokens(py_strip("text")))
    hashed = F.transform(toks, lambda x: F.xxhash64(x))
    # bound to lambda variables, so that each step is computed once per text
    made = _bound(hashed, lambda ts: _bound(F.array_sort(ts), lambda ordered: F.struct(
        ts.alias("toks"), F.size(ordered).alias("m"), F.transform(ordered, lambda x, i: F.xxhash64(x, i - F.array_position(ordered, x))).alias("keys"))))
    return texts.select("id", made.alias("e")).select("id", "e.toks", "e.m", "e.keys").where("m > 0")


def _prefixes(elements: DataFrame, hot: DataFrame, t: float) -> DataFrame:
    """key, id, m, pos, n: the prefix elements of each text, the rest of all texts' elements before the hot ones, these by their frequency."""
    rows = elements.select("id", "m", F.explode("keys").alias("key")).join(F.broadcast(hot), "key", "left")
    ordered = rows.groupBy("id", "m").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), "key"))).alias("o"))
    kept = F.slice("o", 1, F.greatest(F.col("m") - min_overlap(F.col("m"), t) + 1, F.lit(0)))
    return ordered.select("id", "m", F.posexplode(kept).alias("pos", "e")).select("e.key", "id", "m", "pos", "e.n")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def rouge_join(left: DataFrame, right: DataFrame | None, t: float) -> DataFrame:
    """All (id_l, id_r, score) with ROUGE-L F1(text_r, text_l) >= t, t > 0.

    Inputs ``(id, text)`` with unique ids; ``right=None`` joins ``left`` with
    itself and, the score being symmetric, returns each pair once
    (``id_l < id_r``).

    F1 >= t forces a multiset overlap of at least alpha(m) = ceil(t*m/(2-t))
    elements, so the first m - alpha + 1 elements of the two texts, in one global
    order, intersect: one equi-join on prefix elements, of ids and places only.  The
    order puts the elements that make 1/``HOT_PARTS`` of all or more (so at most that
    many, broadcast) last, by frequency; their join keys are salted.  The length bound and
    the bound that follows from the places of a common element (no more than the
    elements behind it can be shared) are part of the join.  Tokens are fetched
    once per candidate, and the exact LCS (bit-parallel, Arrow batches) decides.

    Where more pairs of prefix elements are equal than texts are sent to blocks (short texts, a low t: a share of all pairs are candidates, which no
    disk holds), each two blocks of texts meet in a task instead, and only pairs that reach t leave it (``_dense_pairs``).
    Tokens and elements are told apart by 64-bit hashes.
    """
    if t <= 0:
        raise ValueError("rouge_join needs t > 0 (every pair qualifies at 0)")
    if t > 1:  # no score reaches it
        return left.select(F.col("id").alias("id_l"), F.col("id").alias("id_r"), F.lit(0.0).alias("score")).where(F.lit(False))
    self_join = right is None
    sides = _elements(left).withColumn("side", F.lit(0))
    if not self_join:
        sides = sides.unionByName(_elements(right).withColumn("side", F.lit(1)))
    both = written(sides, "rouge-texts")
    texts_l = both.where("side = 0").drop("side")
    texts_r = texts_l if self_join else both.where("side = 1").drop("side")
    n, total = both.agg(F.count("*"), F.coalesce(F.sum("m"), F.lit(0))).first()
    hot = both.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * HOT_PARTS >= total)

    is_hot = F.col("n") > 0
    salt_l = F.when(is_hot, F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    salts_r = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    named = lambda df, suffix: df.select("key", "salt", *[F.col(c).alias(f"{c}_{suffix}") for c in ("id", "m", "pos")])
    pl = named(_prefixes(texts_l, hot, t).withColumn("salt", salt_l), "l")
    pr = named(_prefixes(texts_r, hot, t).withColumn("salt", F.explode(salts_r)), "r")
    blocks = -(-total // BLOCK_TOKENS)
    counts = [p.groupBy("key", "salt").agg(F.count("*").alias(c)) for p, c in ((pl, "n_l"), (pr, "n_r"))]
    equal = counts[0].join(counts[1], ["key", "salt"]).agg(F.sum(F.col("n_l") * F.col("n_r"))).first()[0] or 0
    if equal >= DENSE_PAIRS and equal >= n * (blocks + 1):
        return _dense_pairs(texts_l, None if self_join else texts_r, t, blocks)
    least = F.lit(t) * (F.col("m_l") + F.col("m_r")) / 2.0 - 1e-9
    shared = F.least(F.col("m_l") - F.col("pos_l"), F.col("m_r") - F.col("pos_r"))  # places count from 0
    cand = pl.join(pr, ["key", "salt"]).where((F.least("m_l", "m_r") >= least) & (shared >= least))
    if self_join:
        cand = cand.where(F.col("id_l") < F.col("id_r"))
    pairs = cand.select("id_l", "id_r").distinct()
    pairs = pairs.join(texts_l.select(F.col("id").alias("id_l"), F.col("toks").alias("toks_l"), F.col("m").alias("m_l")), "id_l")
    pairs = pairs.join(texts_r.select(F.col("id").alias("id_r"), F.col("toks").alias("toks_r"), F.col("m").alias("m_r")), "id_r")
    scored = (pairs.withColumn("lcs", lcs_length(F.col("toks_l"), F.col("toks_r")))
                   .withColumn("score", 2.0 * F.col("lcs") / (F.col("m_l") + F.col("m_r"))))
    return scored.where(F.col("score") >= F.lit(t)).select("id_l", "id_r", "score")


def _dense_pairs(left: DataFrame, right: DataFrame | None, t: float, blocks: int) -> DataFrame:
    """The pairs of ``rouge_join`` by blocks: a text is sent to each pair of blocks that its own is in; there the elements that two texts share are
    counted, and the LCS of those that share enough for t decides.  Memory is bounded by two blocks and a tile of pairs."""
    def sent(texts: DataFrame, side: int, partners: Column) -> DataFrame:
        dealt = texts.where(F.col("id").isNotNull()).select("id", "toks", hash_block("id", blocks).alias("own")).withColumn("other", F.explode(partners))
        first, second = (F.col("own"), F.col("other")) if side == 0 else (F.col("other"), F.col("own"))
        return dealt.select(first.alias("first"), second.alias("second"), F.lit(side).alias("side"), "id", "toks")

    every, self_join = F.sequence(F.lit(0), F.lit(blocks - 1)), right is None
    both = sent(left, 0, F.sequence(F.col("own"), F.lit(blocks - 1)) if self_join else every)
    both = both.unionByName(sent(left if self_join else right, 1, F.sequence(F.lit(0), F.col("own")) if self_join else every))
    groups = blocks * (blocks + 1) // 2 if self_join else blocks * blocks
    both = both.repartition(max(min(groups, 4096), 1), "first", "second").sortWithinPartitions("first", "second", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _groups(batches):
            l, r = ([b for side, b in parts if side == k] for k in (0, 1))
            same = self_join and bool(parts) and parts[0][1].column(0)[0].as_py() == parts[0][1].column(1)[0].as_py()
            for ids_l, ids_r, score in _block_pairs(l, r, t) if l and r else ():
                if self_join:
                    once = ids_l < ids_r if same else ids_l != ids_r
                    ids_l, ids_r, score = np.minimum(ids_l, ids_r)[once], np.maximum(ids_l, ids_r)[once], score[once]
                yield pa.RecordBatch.from_arrays([pa.array(ids_l), pa.array(ids_r), pa.array(score)], ["id_l", "id_r", "score"])

    kind = left.schema["id"].dataType.simpleString()
    return both.mapInArrow(run, f"id_l {kind}, id_r {kind}, score double")


def _block(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, tokens, their number in each text, and their elements: (token, occurrence) as one number."""
    ids = np.concatenate([p.column(3).to_numpy(zero_copy_only=False) for p in parts])
    tokens = np.concatenate([p.column(4).flatten().to_numpy(zero_copy_only=False) for p in parts])
    m = np.concatenate([np.diff(p.column(4).offsets.to_numpy()) for p in parts]).astype(np.int64)
    row = np.repeat(np.arange(len(m)), m)
    order = np.lexsort((tokens, row))
    begins = np.concatenate([[True], (np.diff(tokens[order]) != 0) | (np.diff(row[order]) != 0)])
    first = np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
    elements = np.empty(len(tokens), dtype=np.uint64)
    elements[order] = tokens[order].view(np.uint64) + (np.arange(len(order)) - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ids, tokens, m, elements


def _block_pairs(left: list, right: list, t: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids and scores of the pairs of two blocks that reach t."""
    ids_l, tokens_l, m, elements_l = _block(left)
    ids_r, tokens_r, n, elements_r = _block(right)
    at_l, at_r, width = np.cumsum(m) - m, np.cumsum(n) - n, len(n)
    order = np.argsort(elements_r, kind="stable")
    known, rows_r = elements_r[order], np.repeat(np.arange(width), n)[order]
    begin, end = np.searchsorted(known, elements_l, "left"), np.searchsorted(known, elements_l, "right")
    shared = end - begin
    held = np.cumsum(np.add.reduceat(shared, at_l) + width)  # places that the rows so far take
    least = lambda a, b: t * (m[a] + n[b]) / 2.0 - 1e-9
    a = 0
    while a < len(m):
        b = max(a + 1, int(np.searchsorted(held, (held[a - 1] if a else 0) + TILE, "right")))
        some = slice(at_l[a], at_l[b - 1] + m[b - 1])
        count = shared[some]
        behind = np.cumsum(count)
        places = np.repeat(begin[some] - behind + count, count) + np.arange(behind[-1])
        row = np.repeat(np.arange(b - a), m[a:b])
        found = np.bincount(np.repeat(row * width, count) + rows_r[places], minlength=(b - a) * width)
        pairs = np.flatnonzero(found >= max(1, t * (m[a:b].min() + n.min()) / 2.0 - 1e-9))
        l, r = a + pairs // width, pairs % width
        enough = found[pairs] >= least(l, r)
        l, r = l[enough], r[enough]
        score = 2.0 * lcs_of(tokens_l, at_l[l], m[l], tokens_r, at_r[r], n[r]) / (m[l] + n[r])
        reach = score >= t
        yield ids_l[l[reach]], ids_r[r[reach]], score[reach]
        a = b


def matching_pairs(cat1: DataFrame, cat2: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """``(n)``: rows whose sum is the number of pairs at or above the threshold, before one pair per title is chosen.

    Equal titles are counted as a product of counts, so a hot title is never paired out.
    """
    a = _cleaned(cat1, cfg.dataset1_type, cfg.clean_titles, "t")
    b = _cleaned(cat2, cfg.dataset2_type, cfg.clean_titles, "t")
    if cfg.main_score == "string":
        def per_title(df: DataFrame, name: str) -> DataFrame:
            return df.where(F.col("t").isNotNull()).groupBy("t").agg(F.count("*").alias(name))
        return per_title(a, "n1").join(per_title(b, "n2"), "t").select((F.col("n1") * F.col("n2")).alias("n"))
    return _kept(_scored_candidates(a, b, cfg), cfg).select(F.lit(1).cast("long").alias("n"))


def match_summary(cat1: DataFrame, cat2: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """Sizes after de-duplication and number of matching pairs (before one per title), as one row."""
    pairs = matching_pairs(cat1, cat2, cfg)
    sizes = [df.agg(F.count("*").alias("n")).select(F.lit(i).alias("i"), "n") for i, df in enumerate((cat1, cat2))]
    n = [F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).cast("long").alias(name) for i, name in enumerate(("n1", "n2", "n_results"))]
    return sizes[0].unionByName(sizes[1]).unionByName(pairs.select(F.lit(2).alias("i"), "n")).agg(*n)
