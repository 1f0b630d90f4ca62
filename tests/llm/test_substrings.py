import hashlib
import random
import re
from collections import Counter

import numpy as np
from conftest_llm import DOCS, odd_texts, rows_of
from pyspark.sql import functions as F

from shelfmatch.llm import heat
from shelfmatch.llm import substrings as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=S.WINDOW):
    words = [WORD.findall(r[1] or "") for r in rows]
    starts = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for row, w in zip(rows, words):
        hit = {k for i in range(len(w) - window + 1) if starts[tuple(w[i:i + window])] > 1 for k in range(i, i + window)}
        out.append((row[0], len(w), len(hit), " ".join(x for k, x in enumerate(w) if k not in hit)))
    return out


def texts():
    r = random.Random(7)
    words = lambda n: [f"w{r.randrange(500)}" for _ in range(n)]
    passage, other = words(60), words(34)
    out = odd_texts() + [" ".join(words(r.randrange(120))) for _ in range(40)]
    out += [" ".join(words(r.randrange(50)) + passage[a:a + n] + words(r.randrange(50))) for a in range(12) for n in (34, 35, 36, 48)]
    out += [" ".join(words(k) + other + words(5)) for k in range(8)]  # one word short of a window
    out += ["  ".join(passage), "\n".join(passage)] + [" ".join(words(100))] * 5 + ["a b " * 40, "a b " * 17 + "a", "x\xa0y " * 50]
    long = words(3000)
    out += [" ".join(long), " ".join(long[:1500] + ["changed"] + long[1500:])]
    return out


def test_equals_brute_force(spark, frame):
    rows = rows_of(texts())
    rows += [rows[20], rows[20], (None, rows[60][1], None, None, 1), (None, None, None, None, 1)]
    wide = frame([(*r, "x", 1, "y") for r in rows], DOCS + ", text_1 string, copies int, starts string")
    got = S.without_repeats(wide).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == sorted(brute(rows), key=str)
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_other_windows_and_hot_keys(spark, frame, monkeypatch):
    monkeypatch.setattr(heat, "PARTS", 5)  # many keys are hot
    rows = rows_of(texts())
    for window in (1, 5, 12):
        got = S.without_repeats(frame(rows, DOCS), window).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == sorted(brute(rows, window), key=str)


def test_covers_align_all_shifts():
    for window in (1, 2, 5, 8, 20, 35, 60, 200):
        period, members = S.cover(window)
        assert {(a - b) % period for a in members for b in members} == set(range(period)) and 1 <= period <= window
        at = S.cover_positions(500, window).tolist()
        assert at == [k for k in range(500) if k % period in members]


def test_run_hashes_tell_runs_apart():
    h = np.array([random.Random(1).choice([3, 5]) for _ in range(400)], dtype=np.uint64)
    for n in (1, 2, 3, 15, 35):
        got = S.run_hashes(h, n, S._MULTIPLIERS[0])
        runs = [tuple(h[i:i + n].tolist()) for i in range(len(h) - n + 1)]
        assert len(got) == len(runs) and len(set(got.tolist())) == len(set(runs)) == len(set(zip(got.tolist(), runs)))


def test_query_and_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert S.without_repeats(empty).count() == 0
    got = S.op11_substring_dedup(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and got.count() == 200
    none = [r for r in got.where(F.col("n_words") == F.col("n_removed")).collect()]
    assert all(r.kept_sha256 == hashlib.sha256(b"").hexdigest() for r in none)


def test_join_counted_joins_all_rows_once(spark, frame, monkeypatch):
    rows = frame([(k, v) for v in range(300) for k in ([1] * 5 if v < 100 else [v])], "k long, v long")
    counted = rows.groupBy("k").agg(F.count("*").alias("n")).where("k % 3 = 1")
    for parts in (2, 10, 4096):
        monkeypatch.setattr(heat, "PARTS", parts)
        assert heat.join_counted(rows, counted, ["k"]).count() == rows.where("k % 3 = 1").count()
        left = heat.join_counted(rows, counted, ["k"], how="left")
        assert left.count() == rows.count() and left.where("n IS NULL").count() == rows.where("k % 3 <> 1").count()
        assert heat.hot_keys(counted, ["k"]).count() <= parts
