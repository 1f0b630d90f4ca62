import random
import re

import pytest
import zstandard
from conftest_llm import DOCS, odd_texts, rows_of
from pyspark.sql import functions as F

from shelfmatch.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    repeated = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed


def texts():
    random.seed(1)
    some = [" ".join(random.choice(["a", "b", "c", "the\n", "é#", "x"]) for _ in range(random.randrange(60))) for _ in range(300)]
    line = " ".join(f"w{k}" for k in range(12))
    return odd_texts() + some + [line + "\n" + line, line * 2, " ".join(f"w{k}" for k in range(40)) + " " + " ".join(f"w{k}" for k in range(8))]


def test_base_signals_equal_brute_force(spark, frame):
    rows = rows_of(texts())
    got = frame(rows, DOCS).select("doc_id", Q.quality(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(rows[r.doc_id][1])
        assert not (r.base_failed and r.kept)


def test_bands_reject_repetition_and_noise():
    random.seed(2)
    noise = "".join(chr(random.randrange(33, 127)) for _ in range(4000))
    assert not Q.compression(noise, zstandard.ZstdCompressor(level=Q.LEVEL))[2]
    assert not Q.compression("buy now " * 400, zstandard.ZstdCompressor(level=Q.LEVEL))[2]


def test_chunks_cover_the_text():
    for n in (0, 1, 1023, 1024, 1535, 1536, 5000, 5119, 5633):
        data = bytes(n)
        assert b"".join(Q.chunks(data)) == data
        assert all(len(c) >= Q.LAST_CHUNK_BYTES for c in Q.chunks(data)[1:])


@pytest.mark.parametrize("schema", [DOCS, "doc_id long, text string, signals string, kept int, n_words int"])
def test_filter_keeps_columns_and_takes_empty_tables(spark, schema):
    empty = spark.createDataFrame([], schema)
    assert Q.good_documents(empty).columns == empty.columns and Q.good_documents(empty).count() == 0


def prose(n, alphabet):
    """Words of a fixed vocabulary, frequent ones more often, in letters of the given alphabet."""
    r = random.Random(4)
    letters = [alphabet[k % len(alphabet)] for k in range(26)]
    weights = [8, 1, 3, 4, 13, 2, 2, 6, 7, 1, 1, 4, 2, 7, 8, 2, 1, 6, 6, 9, 3, 1, 2, 1, 2, 1]
    words = ["".join(r.choices(letters, weights, k=r.randrange(2, 10))) for _ in range(3000)]
    out, size = [], 0
    while size < n:
        out.append(words[min(int(r.paretovariate(0.6)), 2999)] + (". " if r.random() < 0.1 else " "))
        size += len(out[-1])
    return "".join(out)


def test_scripts_are_judged_alike():
    packer = zstandard.ZstdCompressor(level=Q.LEVEL)
    latin = "abcdefghijklmnopqrstuvwxyz"
    for n in (400, 1500, 6000, 20000, 100000):
        ratios = [Q.compression(prose(n, a), packer)[0] for a in (latin, [chr(0x430 + k) for k in range(26)], [chr(0x905 + k) for k in range(26)])]
        assert max(ratios) - min(ratios) < 0.04 * max(ratios), ratios  # the packed alphabet itself takes a few bytes
    for alphabet in (latin, [chr(0x430 + k) for k in range(26)], [chr(0x905 + k) for k in range(26)]):
        assert not Q.compression("".join(alphabet[:5]) * 400, packer)[2]
    mixed = "".join(chr(0x4E00 + k) for k in range(300))
    assert Q.script_neutral(mixed) == (mixed.encode(), True)
    assert Q.script_neutral("\u0430b\u0431\u0430") == (b"\x00b\x01\x00", False)


def test_verdict_follows_from_the_bands(spark, frame):
    rows = rows_of([prose(n, "abcdefghijklmnopqrstuvwxyz") for n in (300, 900, 3000, 12000)] + [("word%d " % k) * 30 for k in range(5)] + [" ".join(str(hash((k, j))) for j in range(200)) for k in range(3)])
    got = frame(rows, DOCS).select("doc_id", Q.quality(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    packer = zstandard.ZstdCompressor(level=Q.LEVEL)
    limits = lambda n: [__import__("numpy").interp(__import__("math").log(n), Q._LOG, side) for side in (Q._LOW, Q._HIGH)]
    for r in got:
        data = rows[r.doc_id][1].encode()
        low, high = limits(len(data))
        parts = Q.chunks(data)
        bad = sum(not Q.CHUNK_BAND[0] <= len(p) / len(packer.compress(p)) <= Q.CHUNK_BAND[1] for p in parts) if len(parts) > 1 else 0
        assert r.kept == (not r.base_failed and low <= len(data) / len(packer.compress(data)) <= high and bad <= Q.CHUNK_SHARE * len(parts))
    assert {r.kept for r in got} == {True, False}
