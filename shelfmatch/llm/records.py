"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record file is a run of frames, each followed by ``MARKER``:

    length of data   8 bytes, little-endian
    masked CRC-32 of these 8 bytes   4 bytes
    data             flags (1 byte: 1 doc_id is null, 2 ids take 4 bytes), doc_id (8 bytes, signed), ids (2 or 4 bytes each)
    masked CRC-32 of the data        4 bytes

A checksum c is masked as ((c >> 15 | c << 17) + 0xA282EAD8) mod 2**32.  The marker lets Spark's line reader cut
the files (they are splittable at any size, and written and read by Spark's own sources on any store); lengths and
checksums are verified on reading and a broken record is an error.  The marker holds the byte 0xC3 at odd and even
places; ids of a vocabulary below 0xC200 take 2 bytes whose high byte is below it, larger ones 4 bytes with a zero
byte, so no run of ids holds the marker.

Documents are range-partitioned and sorted by doc_id, one file each partition, so the files' names and their rows
are in ascending doc_id order.  The index (Parquet, in the folder `index`) has a row for each record: file number,
row in the file, byte offset and length of the frame, doc_id, n_tokens and start (ids before it in all files).

Defined results: null text is the empty text, whose record holds the end id alone; null doc_ids come first; rows
that repeat a doc_id are records side by side, in the order of their texts; other columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.llm.common import prepare, resident, stored, table
from shelfmatch.session import scratch_path

#: A text that neither starts nor ends like itself, of bytes that ids cannot give.
MARKER = "ÿaÿaÿaÿaÿ\n"
END_ID = 1
#: Chunks of text whose ids are kept in a Python worker, and bytes of them; the tables are dropped and filled anew beyond either.
KEPT_CHUNKS, KEPT_BYTES = 400_000, 64_000_000
_MARKER = MARKER.encode()
_OVERHEAD = 8 + 4 + 9 + 4 + len(_MARKER)


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    """``ids`` as little-endian integers of 2 or, if ``wide``, 4 bytes."""
    data = struct.pack("<Bq", (doc_id is None) | wide << 1, doc_id or 0) + ids
    head = struct.pack("<Q", len(data))
    return b"".join((head, struct.pack("<I", masked_crc(head)), data, struct.pack("<I", masked_crc(data))))


def unframe(raw: bytes) -> tuple[int | None, np.ndarray]:
    """doc_id and ids of a frame."""
    if len(raw) < 25 or masked_crc(raw[:8]) != struct.unpack_from("<I", raw, 8)[0]:
        raise ValueError("the length of a record is broken")
    data = raw[12:-4]
    if len(data) != struct.unpack_from("<Q", raw)[0] or masked_crc(data) != struct.unpack_from("<I", raw, len(raw) - 4)[0]:
        raise ValueError("the data of a record is broken")
    flags, doc_id = struct.unpack_from("<Bq", data)
    return None if flags & 1 else doc_id, np.frombuffer(data, dtype="<u4" if flags & 2 else "<u2", offset=9)


class ChunkTokenizer:
    """The library's ids of whole texts, put together from those of the chunks between ASCII white space.

    The tokenizer drops white space and ends a word at each change between letters and other characters, so a
    chunk's ids do not depend on what stands around it, and a chunk of Latin letters and ASCII punctuation is the
    lower-case word followed by the punctuation; ``__init__`` checks that the file is of this kind.  Words go to
    the library in runs, whose ids are cut behind each token that ends a word.
    """

    RUN = 50
    _LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
    _MARKS = string.punctuation + string.digits

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, suffix = spec["pre_tokenizer"]["pretokenizers"][0], spec["model"]["end_of_word_suffix"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if split["type"] != "Split" or not split["invert"] or split["behavior"] != "Removed" or not suffix or spec["post_processor"] or steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("the tokenizer is not one of lower-case words without white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "I" if self.tokenizer.get_vocab_size() > 0xC200 else "H"
        self.wide = self.kind == "I"
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.chunks: dict[bytes, bytes] = {}
        self.bytes = 0  # of the chunks learnt since the tables were dropped
        self.words: dict[str, bytes] = {}

    def _learn(self, texts: list[str]) -> None:
        """Ids of texts that have no white space into ``words``."""
        for i in range(0, len(texts), 10_000):
            part = texts[i:i + 10_000]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.words.update((t, array(self.kind, e.ids).tobytes()) for t, e in zip(part, found))

    def _learn_words(self, words: list[str]) -> None:
        runs = [words[i:i + self.RUN] for i in range(0, len(words), self.RUN)]
        for i in range(0, len(runs), 500):
            part = runs[i:i + 500]
            for run, e in zip(part, self.tokenizer.encode_batch_fast([" ".join(r) for r in part], add_special_tokens=False)):
                ids = np.array(e.ids, dtype=np.uint32 if self.wide else np.uint16)
                cuts = np.nonzero(self.ends[ids])[0] + 1
                if len(cuts) != len(run):
                    self._learn(run)
                    continue
                raw, size = ids.tobytes(), ids.itemsize
                self.words.update((w, raw[a * size:b * size]) for w, a, b in zip(run, [0, *cuts.tolist()], cuts.tolist()))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, 2 or 4 bytes each."""
        split = [t.encode().split() for t in texts]
        if self.bytes > KEPT_BYTES:
            self.chunks.clear()
            self.words.clear()
            self.bytes = 0
        if len(self.chunks) > KEPT_CHUNKS:
            self.chunks.clear()
        if len(self.words) > KEPT_CHUNKS:
            self.words.clear()
        new = list(set().union(*split).difference(self.chunks))
        self.bytes += sum(map(len, new))
        words, rests, plain, other = [], [], set(), {""}
        for t in map(bytes.decode, new):
            word = t.rstrip(self._MARKS)
            if word.isascii() and word.isalpha() or self._LATIN.fullmatch(word):
                words.append(word := word.lower())
                rests.append(rest := t[len(word):])
                plain.add(word)
                other.add(rest)
            else:
                words.append(t)
                rests.append("")
                other.add(t)
        self._learn_words(list(plain.difference(self.words)))
        self._learn(list(other.difference(self.words)))
        get = self.words.__getitem__
        self.chunks.update(zip(new, map(bytes.__add__, map(get, words), map(get, rests))))
        get = self.chunks.__getitem__
        return [b"".join(map(get, chunks)) for chunks in split]


def tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer per Python worker and path."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return resident(("records", path), lambda: ChunkTokenizer(path))


def _frames(batches, path: str, end_id: int):
    coder = tokenizer(path)
    end = struct.pack("<I" if coder.wide else "<H", end_id)
    for batch in batches:
        doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        framed = [frame(d, ids + end, coder.wide) for d, ids in zip(doc_ids, coder.encode(texts))]
        yield pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], ["frame"])


def _records(batches, with_ids: bool):
    for batch in batches:
        rows = [unframe(raw) for raw in batch.column(1).to_pylist()]
        ids = [i.astype("<u4") for _, i in rows]
        columns = [batch.column(0), pa.array([d for d, _ in rows], pa.int64()), pa.array([len(i) for i in ids], pa.int64()),
                   pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array([len(r) for r in batch.column(1).to_pylist()], pa.int64())]
        if with_ids:
            columns.append(pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays(columns, ["place", "doc_id", "n_tokens", "ids_crc32", "frame_bytes", "ids"][:len(columns)])


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Write doc_id and the ids of text, in ascending doc_id order, as record files and index below ``path``."""
    spark = docs.sparkSession
    prepare(spark)
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    framed = ordered.mapInArrow(functools.partial(_frames, path=tokenizer_path, end_id=end_id), "frame binary")
    framed.select(F.col("frame").cast("string")).write.option("lineSep", MARKER).text(f"{path}/records")
    record_index(stored(read_records(spark, path, ids=False), "records-read")).write.parquet(f"{path}/index")


def read_records(spark, path: str, ids: bool = True) -> DataFrame:
    """Every record, verified: file (number), place (order in the file), doc_id, n_tokens, ids_crc32, frame_bytes, ids."""
    prepare(spark)
    lines = spark.read.option("lineSep", MARKER).text(f"{path}/records")
    place = F.struct(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    schema = ("place struct<file:long,block:long,row:long>, doc_id long, n_tokens long, ids_crc32 long, frame_bytes long"
              + ", ids array<long>" * ids)
    return lines.select(place.alias("place"), F.col("value").cast("binary")).mapInArrow(
        functools.partial(_records, with_ids=ids), schema)


def record_index(records: DataFrame) -> DataFrame:
    """Byte offset of each frame in its file, and the number of ids before each record in all files."""
    in_file = Window.partitionBy("file").orderBy("place")
    rows = records.withColumn("file", F.col("place.file")).withColumn("frame_bytes", F.col("frame_bytes") + len(_MARKER))
    before = F.coalesce(F.sum("n_tokens").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumns({
        "row": F.row_number().over(in_file).cast("long") - 1, "before": before,
        "offset": F.coalesce(F.sum("frame_bytes").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # one row per file
    base = totals.select(F.col("file"), F.coalesce(F.sum("n").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.join(base, "file").select(
        "file", "row", "offset", F.col("frame_bytes").alias("length"), "doc_id",
        (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def read_shuffled(spark, path: str, seed: int) -> DataFrame:
    """The records in an order drawn from ``seed``: the index is dealt out by hash, the records follow it."""
    index = spark.read.parquet(f"{path}/index").select(F.col("file"), "offset", F.xxhash64("file", "row", F.lit(seed)).alias("draw"))
    place = Window.partitionBy("file").orderBy("place")
    records = read_records(spark, path).withColumn("file", F.col("place.file"))
    length = F.col("frame_bytes") + len(_MARKER)
    records = records.withColumn("offset", F.coalesce(F.sum(length).over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return records.join(index, ["file", "offset"]).orderBy("draw", "file", "offset").select("doc_id", "n_tokens", "ids_crc32", "ids")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_records(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "records")
    write_records(docs, path, default_path())
    return spark.read.parquet(f"{path}/index").select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")
