import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmatch.operators.dedupe import dedupe_by_title, keep_first
from shelfmatch.operators.match import MatchConfig, match_catalogues, rouge_join

VOCAB = ["a", "b", "c", "d", "e", "f"]


def _lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if x == y else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def _cat(spark, rows):
    return spark.createDataFrame(rows, "_id string, title string, title_cleaned string, capacities string, "
                                       "color_options string, _ord long")


def test_keep_first_by_order_and_nulls(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, None), (5, None), (4, "y")], "o long, t string")
    out = {r["t"]: r["o"] for r in keep_first(df, ["t"], ["o"]).collect()}
    assert out == {"x": 1, None: 2, "y": 4}


def test_dedupe_by_title_strips(spark):
    cat = _cat(spark, [("1", " iphone ", "iphone", None, None, 2), ("2", "iphone", "iphone", None, None, 1)])
    assert [r["_id"] for r in dedupe_by_title(cat).collect()] == ["2"]


def test_exact_match_one_pair_per_title(spark):
    a = _cat(spark, [("a1", "X", "nokia c21", "['128GB']", "['Đen']", 1), ("a2", "Y", "Nokia C21", None, None, 2),
                     ("a3", None, None, None, None, 3)])
    b = _cat(spark, [("b1", "n", "nokia c21", "128GB", "Đen", 10), ("b2", "n2", "nokia c21", None, None, 5),
                     ("b3", "m", "Nokia C21", None, None, 7), ("b4", None, None, None, None, 8)])
    out = match_catalogues(a, b, MatchConfig(use_rouge=False), keep_order=True).collect()
    # 'nokia c21' and 'Nokia C21' normalise to one title: first pair by (_ord1, _ord2) is (a1, b2)
    assert [(r["_id1"], r["_id2"]) for r in out] == [("a1", "b2")]
    assert out[0]["main_score"] == 1.0 and out[0]["rouge_score"] is None


def test_exact_match_plan_is_hash_join_without_cartesian(spark):
    a = _cat(spark, [("a1", "X", "t", None, None, 1)])
    plan = match_catalogues(a, a, MatchConfig(use_rouge=False))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(VOCAB), min_size=0, max_size=6), min_size=1, max_size=12),
       st.sampled_from([0.2, 0.4, 0.5, 0.7, 1.0]))
def test_rouge_join_equals_brute_force(spark, texts, t):
    rows = [(i, " ".join(x)) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {(r["id_l"], r["id_r"]): r["score"] for r in rouge_join(df, df, t).collect()}
    want = {}
    for (i, a), (j, b) in itertools.product(rows, rows):
        ta, tb = a.split(), b.split()
        if not ta or not tb:
            continue
        s = 2 * _lcs(tb, ta) / (len(ta) + len(tb))
        if s >= t:
            want[(i, j)] = s
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-12
    once = {(r["id_l"], r["id_r"]) for r in rouge_join(df, None, t).collect()}
    assert once == {(i, j) for (i, j) in want if i < j}


def test_rouge_and_combined_main_scores(spark):
    a = _cat(spark, [("a1", "x", "galaxy s24 ultra", None, None, 1), ("a2", "y", "iphone 15", None, None, 2)])
    b = _cat(spark, [("b1", "x", "samsung galaxy s24 ultra", None, None, 1), ("b2", "y", "nokia 3210", None, None, 2)])
    out = match_catalogues(a, b, MatchConfig(main_score="rouge", threshold=0.8)).collect()
    assert [(r["_id1"], r["_id2"]) for r in out] == [("a1", "b1")]
    assert abs(out[0]["rouge_score"] - 2 * 3 / 7) < 1e-12
    emb = a.sparkSession.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "_ord long, embedding array<double>")
    cfg = MatchConfig(main_score="combined", threshold=0.8, use_rouge=True, use_semantic=True)
    out2 = match_catalogues(a.join(emb, "_ord"), b.join(emb, "_ord"), cfg).collect()
    assert [(r["_id1"], r["_id2"]) for r in out2] == [("a1", "b1")]
    assert abs(out2[0]["combined_score"] - (0.7 * 6 / 7 + 0.3)) < 1e-9


def test_rouge_join_random_texts_no_miss(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(VOCAB) for _ in range(rnd.randint(1, 8)))) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, text string")
    want = {(i, j) for (i, a), (j, b) in itertools.product(rows, rows)
            if 2 * _lcs(b.split(), a.split()) / (len(a.split()) + len(b.split())) >= 0.6}
    assert {(r["id_l"], r["id_r"]) for r in rouge_join(df, df, 0.6).collect()} == want
    assert rouge_join(df, df, 1.01).count() == 0
    plan = rouge_join(df, df, 0.6)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    low = {(i, j) for (i, a), (j, b) in itertools.product(rows, rows)
           if i < j and 2 * _lcs(b.split(), a.split()) / (len(a.split()) + len(b.split())) >= 0.25}
    assert {(r["id_l"], r["id_r"]) for r in rouge_join(df, None, 0.25).collect()} == low


@pytest.mark.parametrize("t", [0.2, 0.3, 0.6, 1.0])
def test_rouge_join_by_blocks_equals_the_join_of_prefixes(spark, monkeypatch, t):
    """Candidates of short texts at a low t are a share of all pairs, and their shuffles filled the disk."""
    rnd = random.Random(5)
    rows = [(i * 11 % 301, " ".join(rnd.choice(VOCAB + ["the", "the", "of"]) for _ in range(rnd.choice([1, 3, 8, 8, 12, 90])))) for i in range(150)]
    rows += [(400, ""), (401, None), (402, "?"), (403, "the the the the"), (404, "the the")]
    df, other = (spark.createDataFrame(r, "id long, text string").repartition(3) for r in (rows, [(i + 5, x) for i, x in rows[40:]]))
    of = lambda pairs: {(r["id_l"], r["id_r"]): r["score"] for r in pairs.collect()}
    by_prefix = of(rouge_join(df, None, t)), of(rouge_join(df, other, t))
    monkeypatch.setattr("shelfmatch.operators.match.DENSE_PAIRS", 0)
    monkeypatch.setattr("shelfmatch.operators.match.BLOCK_TOKENS", 800)
    monkeypatch.setattr("shelfmatch.operators.match.TILE", 300)
    dense = rouge_join(df, None, t), rouge_join(df, other, t)
    assert (of(dense[0]), of(dense[1])) == by_prefix and len(by_prefix[0]) == dense[0].count() > 0
    if t <= 0.3:  # no pair of ids goes through a shuffle
        assert all("id_l" not in x for d in dense for x in d._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x)
        assert all("Join" not in d._jdf.queryExecution().executedPlan().toString() for d in dense)


def test_rouge_join_of_long_texts_ships_ids(spark):
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    base = [rnd.choice(words) for _ in range(5000)]
    near = [w if rnd.random() > 0.05 else "x" for w in base]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(rnd.choice(words) for _ in range(5000))), (4, "the " * 5000), (5, "the " * 4000)]
    got = {(r["id_l"], r["id_r"]): r["score"] for r in rouge_join(spark.createDataFrame(rows, "id long, text string"), None, 0.8).collect()}
    assert set(got) == {(1, 2), (4, 5)} and abs(got[4, 5] - 8 / 9) < 1e-12
    plan = rouge_join(spark.createDataFrame(rows, "id long, text string"), None, 0.8)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate [id_l"):]  # what candidates are made from
    assert "toks" not in below.split("Relation")[0]


def test_cosine_join_equals_brute_force_at_any_block_size(spark, monkeypatch):
    import numpy as np

    from shelfmatch.operators import blocks, vector_search
    from shelfmatch.operators.vector_search import cosine_join
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 8))
    vecs = np.vstack([base[i % 6] + 0.3 * rng.normal(size=8) for i in range(60)] + [np.zeros(8)])
    rows = [(i, v.tolist()) for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    unit = vecs / np.maximum(np.linalg.norm(vecs, axis=1, keepdims=True), 1e-300)
    sims = unit @ unit.T
    for t in (0.8, 0.0, -0.3):  # the cosine with the zero vector is 0
        want = {(i, j) for i in range(61) for j in range(61) if sims[i, j] >= t}
        for block_bytes in (4 << 20, 400):  # one block, and many
            monkeypatch.setattr(blocks, "BLOCK_BYTES", block_bytes)
            monkeypatch.setattr(vector_search, "BLOCK_BYTES", block_bytes)
            assert {(r["id_l"], r["id_r"]) for r in cosine_join(df, df, t, clusters=6).collect()} == want
            once = [(r["id_l"], r["id_r"]) for r in cosine_join(df, None, t, clusters=6).collect()]
            assert sorted(once) == sorted((i, j) for (i, j) in want if i < j)
    assert cosine_join(df, df.where("id < 0"), 0.5).count() == 0 and cosine_join(df.where("id < 0"), df, 0.5).count() == 0


def test_semantic_main_score_and_threshold_guard(spark):
    import pytest
    a = _cat(spark, [("a1", "x", "alpha", None, None, 1), ("a2", "y", "beta", None, None, 2)])
    b = _cat(spark, [("b1", "x", "gamma", None, None, 1), ("b2", "y", "delta", None, None, 2)])
    emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8])], "_ord long, embedding array<double>")
    cfg = MatchConfig(main_score="semantic", threshold=0.9, use_rouge=False, use_semantic=True)
    out = {(r["_id1"], r["_id2"]): r["semantic_score"]
           for r in match_catalogues(a.join(emb, "_ord"), b.join(emb, "_ord"), cfg).collect()}
    assert set(out) == {("a1", "b1"), ("a2", "b2")}
    with pytest.raises(ValueError):
        match_catalogues(a, b, MatchConfig(threshold=0.0))


def test_keep_first_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}") for i in range(30)], "o long, t string")
    plan = keep_first(df, ["t"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_combined_keeps_pairs_without_vectors_and_on_the_bound(spark):
    a = _cat(spark, [("a1", "x", "one two three", None, None, 1)])
    b = _cat(spark, [("b1", "x", "one two three", None, None, 1)])
    none = spark.createDataFrame([(1, None)], "_ord long, embedding array<double>")
    cfg = MatchConfig(main_score="combined", threshold=0.6, use_rouge=True, use_semantic=True)
    out = match_catalogues(a.join(none, "_ord"), b.join(none, "_ord"), cfg).collect()
    assert [round(r["main_score"], 9) for r in out] == [0.7]
    # ROUGE 2 / 7 = 0.2857..., cosine 1: exactly 0.5
    same = spark.createDataFrame([(1, [1.0, 0.0])], "_ord long, embedding array<double>")
    c = _cat(spark, [("a1", "x", "one two three", None, None, 1)])
    d = _cat(spark, [("b1", "x", "one six seven eight", None, None, 1)])
    cfg = MatchConfig(main_score="combined", threshold=0.5, use_rouge=True, use_semantic=True)
    assert len(match_catalogues(c.join(same, "_ord"), d.join(same, "_ord"), cfg).collect()) == 1
    cfg = MatchConfig(main_score="combined", threshold=0.9, weights={"rouge": 0.3, "semantic": 0.3}, use_rouge=True, use_semantic=True)
    assert match_catalogues(a.join(same, "_ord"), b.join(same, "_ord"), cfg).count() == 0


def test_common_subsequences_of_a_batch_are_found_at_once(monkeypatch):
    import random

    import pyarrow as pa

    from shelfmatch.functions import rouge

    rng = random.Random(1)
    sizes = (None, 0, 1, 2, 7, 8, 9, 16, 17, 33, 63, 64)
    lists = lambda some: [None if k is None else [rng.randint(0, rng.choice((2, 6, 40))) for _ in range(k)] for k in (rng.choice(some) for _ in range(600))]
    one_by_one = rouge._lcs_bits
    plain = lambda x, y: one_by_one(x, rouge._masks(y), len(y)) if x and y else 0
    of_type = lambda rows, word: pa.array(rows if word is None else [r and [word.format(t) for t in r] for r in rows], pa.list_(pa.string() if word else pa.int64()))
    for some, slow in ((sizes, False), ((*sizes, 65, 100), True)):
        a, b = lists(some), lists(some)
        want, calls = [plain(x, y) for x, y in zip(a, b)], []
        monkeypatch.setattr(rouge, "_lcs_bits", lambda *x: calls.append(1) or one_by_one(*x))
        for word in (None, "t{}"):
            got = rouge.lcs_length.func(of_type(a, word), of_type(b, word))
            assert got.to_pylist() == want
            assert rouge.lcs_length.func(of_type(a, word)[50:90], of_type(b, word)[50:90]).to_pylist() == want[50:90]
        assert bool(calls) is slow  # only texts of more than 64 tokens go one by one
