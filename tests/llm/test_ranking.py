import math
import random
import re
from collections import Counter

import numpy as np
from conftest_llm import DOCS, odd_texts, rows_of

from shelfmatch.llm import ranking as R

ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    """(item_id, text) -> ranked (doc_id, score)."""
    tf = [Counter(terms(d[1])) for d in docs]
    n_docs, all_terms = sum(bool(c) for c in tf), sum(sum(c.values()) for c in tf)
    df = Counter(t for c in tf for t in c)
    out = []
    for item_id, text in items:
        rows = []
        for d, c in zip(docs, tf):
            if c:
                m = 100 - 90 + (90 * sum(c.values()) * n_docs) // all_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
                if s > 0:
                    rows.append((-s, d[0] is None, d[0] or 0))
        out += [(item_id, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(rows)[:10])]
    return sorted(out, key=str)


def data(seed=1, n=400):
    r = random.Random(seed)
    vocabulary = [f"t{k}" for k in range(200)] + ["É", "中文", "x9"]
    word = lambda: vocabulary[min(int(r.paretovariate(0.5)) - 1, 202)]
    docs = odd_texts() + [" ".join(word() for _ in range(r.randrange(60))) for _ in range(n)]
    docs += [docs[20]] * 60 + ["T1, t2. T3!"] * 15  # copies and ties
    rows = rows_of(docs)
    r.shuffle(rows)
    items = [(k, " ".join(word() for _ in range(r.randrange(1, 12)))) for k in range(25)]
    return rows, items + [(100, None), (101, ""), (102, "?!"), (103, "nowhere else"), (None, "t1 t5"), (None, "t1 t5"), (3, "t7 t7 T7"), (104, "a b word wörd")]


def rows_found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_equals_brute_force(spark, frame):
    docs, items = data()
    docs += [(None, "t1 t2 t3", None, None, None), docs[50], docs[50]]
    wide = frame([(*d, 1, "x") for d in docs], DOCS + ", item int, score string")
    assert rows_found(R.ranked(wide, frame(items, ITEMS))) == brute(docs, items)


def test_small_chunks_trees_and_blocks(spark, frame, monkeypatch):
    for name, value in (("CHUNK", 30), ("LEAF", 2), ("VOCABULARY", 40), ("TREE_TERMS", 6), ("ITEM_CHARS", 100)):
        monkeypatch.setattr(R, name, value)
    docs, items = data(2, 150)
    assert rows_found(R.ranked(frame(docs, DOCS), frame(items, ITEMS))) == brute(docs, items)


def test_tree_bounds_hold_and_cut():
    r = np.random.default_rng(3)
    n_terms, vectors = 120, []
    for _ in range(3000):
        ranks = np.unique(np.minimum(r.zipf(1.4, 15) - 1, n_terms - 1))
        vectors.append((ranks, r.integers(1, 6, len(ranks))))
    norms = r.integers(20, 400, len(vectors))
    tree = R.Tree(vectors, norms, n_terms)
    assert sorted(tree.order.tolist()) == list(range(3000))
    leaves = [(tree.low[k], tree.high[k]) for k in range(len(tree.low)) if tree.first[k] == tree.last[k]]
    assert sorted(d for a, b in leaves for d in range(a, b)) == list(range(3000))
    weights = r.integers(1, 9000, n_terms)
    scored = 0
    for _ in range(20):
        ranks = np.unique(r.integers(0, n_terms, 12))
        want = R.scores(tree.tf[:, ranks], tree.norm, weights[ranks])
        best = R.Best()
        for rows, score in tree.search(ranks, weights[ranks], best.least):
            scored += len(rows)
            for k, s in zip(rows.tolist(), score.tolist()):
                if s >= best.least():
                    best.add(s, k, k)
        exact = sorted(((-s, d) for s, d in zip(want.tolist(), tree.order.tolist()) if s > 0))[:10]
        assert sorted((-s, d) for d, s in best.rows()) == exact
    assert scored < 0.7 * 20 * 3000  # subtrees were cut off


def test_empty_tables(spark, frame):
    docs, items = data(4, 20)
    assert R.ranked(spark.createDataFrame([], DOCS), frame(items, ITEMS)).count() == 0
    assert R.ranked(frame(docs, DOCS), spark.createDataFrame([], ITEMS)).count() == 0
    got = R.op13_ranked_search(spark, "/root/testdata/sf0.001")
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
