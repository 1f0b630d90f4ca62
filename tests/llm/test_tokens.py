import random
import zlib

import numpy as np
import pytest
import sentencepiece
from conftest_llm import DOCS, odd_texts, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmatch.llm import piece_coding, pieces, records, token_counts
from shelfmatch.session import scratch_path

PIECES = ["a", "the", " ", "  ", "\n", "\t", "▁", "é", "é", "中", "😀", "\x00", "</s>", "<unk>", "ing", "tion", "1", "23", "aa", "'s", "don't",
          "​", "Ж", "<0x0A>", "<|endoftext|>", "The.", "!!", "\xa0", "　", "İ", "Σ", "ß", "...", "\r\n", "\x1c"]


def texts(n=1500, seed=3):
    random.seed(seed)
    return odd_texts() + ["".join(random.choice(PIECES) for _ in range(random.randrange(30))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def test_counts_equal_the_library_for_any_chunk_length(library):
    machine = token_counts.transducer(pieces.default_path())
    for t in texts():
        want = len(library.encode(t or ""))
        assert {machine.count(t or "", n) for n in (1, 2, 7, 65536)} == {want}


def test_scan_is_the_composition_of_all_before():
    machine = token_counts.transducer(pieces.default_path())
    text = " the thing  and ing\nthe   a"
    maps = [machine.chunk_map(text[i:i + 3]) for i in range(0, len(text), 3)]
    for k, (one, whole) in enumerate(zip(machine.scan(maps), (machine.chunk_map(text[:i + 3]) for i in range(0, len(text), 3)))):
        assert machine.read(0, one[0])[1] + one[2] == machine.read(0, whole[0])[1] + whole[2], k


def test_transducer_starts_anew_when_full(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_STATES", 50)
    monkeypatch.setattr(token_counts, "KEPT_UNITS", 5)
    machine = token_counts.Transducer(pieces.Pieces(pieces.default_path()))
    for t in texts(200):
        assert machine.count(t or "") == len(library.encode(t or ""))


def test_piece_coding_equals_the_library(library):
    coder = piece_coding.Coder(pieces.Pieces(pieces.default_path()))
    some = [t or "" for t in texts()]
    for t, ids in zip(some, coder.encode(some)):
        want = library.encode(t)
        assert np.frombuffer(ids, dtype="<u4").tolist() == want
        assert coder.decode(ids) == library.decode(want)
        assert coder.decode(ids) == t or "▁" in t


def test_small_tables_of_units_and_pairs(library, monkeypatch):
    for name, n in (("KEPT_UNITS", 3), ("KEPT_PAIRS", 20), ("INDEX_CHARS", 40)):
        monkeypatch.setattr(piece_coding, name, n)
    coder = piece_coding.Coder(pieces.Pieces(pieces.default_path()))
    some = [t or "" for t in texts(200) if len(t or "") < 1000]
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in coder.encode(some)] == library.encode(some)


def test_suffix_array_sorts_by_the_longest_piece():
    random.seed(4)
    codes = np.array([random.randrange(3) for _ in range(300)])
    order = piece_coding.suffix_array(codes, 16).tolist()
    keys = [codes[i:i + 16].tolist() for i in order]
    assert sorted(order) == list(range(300)) and keys == sorted(keys)


def test_queries_over_odd_rows_and_empty_tables(spark, frame, library):
    rows = rows_of(odd_texts())
    docs = frame(rows, DOCS)
    named = docs.withColumns({"c": F.lit(1), "n_tokens": F.lit("x"), "n_bytes": F.lit(2)})
    got = {r.doc_id: r for r in named.select("doc_id", token_counts.token_counts(F.col("text")).alias("c")).select("doc_id", "c.*").collect()}
    assert {i: (r.n_bytes, r.n_tokens) for i, r in got.items()} == {i: (len((t or "").encode()), len(library.encode(t or ""))) for i, t, *_ in rows}
    clash = docs.withColumn("coded", F.lit("x")).withColumn("token_ids", F.lit(1))
    out = piece_coding.tokenised(clash)
    assert out.columns == [*clash.columns, "_token_ids", "n_tokens", "round_trip"]
    for r in out.collect():
        assert np.frombuffer(r["_token_ids"], dtype="<u4").tolist() == library.encode(r.text or "") and (r.round_trip or "▁" in r.text)
    empty = spark.createDataFrame([], DOCS)
    assert piece_coding.tokenised(empty).count() == 0


def test_records_round_trip(spark, frame):
    tok = Tokenizer.from_file(records.default_path())
    some = texts(300)
    rows = [(i if i != 5 else None, t, None, "x", 1) for i, t in enumerate(some)] + [(7, some[7], None, "y", 2)]
    path = scratch_path(spark, "test-records")
    clash = {name: F.lit("x") for name in ("frame", "place", "ids", "file", "start")}
    records.write_records(frame(rows, DOCS, 4).withColumns(clash), path, records.default_path())
    index = spark.read.parquet(f"{path}/index").orderBy("file", "row").collect()
    want = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert [r.doc_id for r in index] == [i for i, _ in want]
    for r, (_, t) in zip(index, want):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [1], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    shuffled = records.read_shuffled(spark, path, 5).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, tuple(r.ids)) for r in shuffled) == sorted(
        (i is not None, i or 0, tuple(tok.encode(t, add_special_tokens=False).ids + [1])) for i, t in want)
    assert [r.doc_id for r in shuffled] != [r.doc_id for r in index]


def test_offsets_point_to_frames_and_broken_records_are_errors(spark, frame, tmp_path):
    path = f"{tmp_path}/r"
    records.write_records(frame(rows_of(["some words", "more words here", None]), DOCS, 1), path, records.default_path())
    files = {int(p.name.split("-")[1]): p.read_bytes() for p in (tmp_path / "r" / "records").glob("part-*")}
    for r in spark.read.parquet(f"{path}/index").collect():
        frame_ = files[r.file][r.offset:r.offset + r.length - len(records.MARKER.encode())]
        doc_id, ids = records.unframe(frame_)
        assert doc_id == r.doc_id and len(ids) == r.n_tokens
        for k in (3, 9, 14, len(frame_) - 2):
            with pytest.raises(ValueError):
                records.unframe(frame_[:k] + bytes([frame_[k] ^ 1]) + frame_[k + 1:])


def test_empty_tables(spark):
    path = scratch_path(spark, "test-records")
    records.write_records(spark.createDataFrame([], DOCS), path, records.default_path())
    assert spark.read.parquet(f"{path}/index").count() == 0
