import math
import random
from collections import Counter, defaultdict

import numpy as np
from conftest_llm import DOCS, odd_texts, rows_of

from shelfmatch.llm import graph, near
from shelfmatch.llm.common import normal_words


def brute(rows):
    """class id and number of links of each row of distinct doc_ids."""
    sets = {}
    for i, t, *_ in rows:
        w = normal_words(t)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    root, links = {i: i for i in sets}, Counter()

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in where[x] if j > i).items():
            if k >= 0.8 * (len(s) + len(sets[j]) - k) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: (top(i), links[i]) for i in sets}


def corpus(groups, seed):
    """Texts in groups of near copies (some words replaced), exact copies and texts of other case and marks."""
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(4))
    out = []
    for size in groups:
        base = [word() for _ in range(random.randrange(30, 200))]
        for _ in range(size):
            t = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 4])):
                t[random.randrange(len(t))] = word()
            out.append(random.choice([" ".join(t), " ".join(t), ", ".join(t).upper()]))
    return out


def test_equals_brute_force(spark, frame):
    rows = rows_of(odd_texts() + corpus([1] * 40 + [2, 3, 5] * 6 + [60], 7))
    got = {r.doc_id: (r.class_id, r.n_links) for r in near.near_duplicates(frame(rows, DOCS)).collect()}
    assert got == brute(rows)


def test_groups_over_many_blocks(spark, frame, monkeypatch):
    rows = rows_of(corpus([90, 1, 4], 8))
    # the driver's value sets the number of blocks; 90 near copies are dealt out over more than ten
    monkeypatch.setattr(near, "BLOCK", 8)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near.near_duplicates(frame(rows, DOCS)).collect()}
    assert got == brute(rows)
    monkeypatch.setattr(near, "BLOCK", 512)
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 500)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near.near_duplicates(frame(rows, DOCS)).collect()}
    assert got == brute(rows)


def test_pruning_keeps_pairs_at_the_threshold():
    for n, least in near.least_matches(0.8, near.TOLERANCE):
        lost = sum(math.comb(n, m) * 0.8 ** m * 0.2 ** (n - m) for m in range(least))
        assert least > 0 and lost < 1e-3
    one = np.arange(near.HASHES, dtype=np.uint16)
    others = np.array([one, one + 1, np.where(one % 10 == 0, 7, one)])
    assert near.survivors(one, others, 0.8).tolist() == [0, 2]


def test_intersections_equal_sets(monkeypatch):
    random.seed(9)
    sets = [np.unique(np.array([random.randrange(60) for _ in range(n)], dtype=np.uint64)) for n in (0, 1, 30, 40, 50, 50)]
    monkeypatch.setattr(near, "PART", 7)
    got = near.intersections(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(set(a.tolist()) & set(b.tolist()))


def test_one_of_each_keeps_one_row_and_all_columns(spark, frame):
    text = " ".join(f"w{k}" for k in range(50))
    schema = "doc_id long, text string, key_id int, component string"
    rows = [(3, text, 1, "a"), (2, text.upper(), 2, "b"), (2, text.upper(), 2, "b"), (9, None, 3, "c"), (10, "", 4, "d"), (None, "own words", 5, "e"), (2, "another text", 6, "f")]
    got = near.one_of_each(frame(rows, schema))
    assert got.columns == ["doc_id", "text", "key_id", "component"]
    assert sorted(r.key_id for r in got.collect()) == [2, 3, 4, 5, 6]
    assert near.one_of_each(spark.createDataFrame([], schema)).count() == 0
    assert near.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_components(spark):
    random.seed(10)
    edges = [(random.randrange(80), random.randrange(80)) for _ in range(60)] + [(100 + k, 101 + k) for k in range(30)] + [(500, 200 + k) for k in range(50)] + [(7, 7)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in root}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
