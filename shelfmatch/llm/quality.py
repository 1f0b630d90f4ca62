"""Quality rules: compression bands.

zstandard packs the whole document and each fixed chunk of it, in a form that is the same for all scripts: a document's characters are
re-coded to a byte each (Latin-1 where it fits, else by the document's own alphabet), so that two- and three-byte scripts do not
look repetitive.  Texts of more than 256 different characters (logographic scripts) are packed as UTF-8, with lower least ratios.
A ratio (bytes over packed bytes) below the band
of its length means text that does not pack like language (noise, keys, encoded data), one above it means
repetition.  Bands depend on the length because a longer text packs better: between the listed lengths the limits
are interpolated over the logarithm of the length.  A document fails if its whole ratio is out of band, or if more than
``CHUNK_SHARE`` of its chunks are (a document of one chunk is judged as a whole).

Base rules come first: too few words, or too many words inside repeated 8-word windows.

Defined results: null and empty texts have no words and fail the base rules; whole texts are read whatever their
length; every row gives one row; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import fresh, per_row, prepare, quoted, table

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
LEVEL = 3
CHUNK_BYTES = 1024
#: A last chunk shorter than this joins the one before it.
LAST_CHUNK_BYTES = 512
CHUNK_BAND = (1.25, 1.98)
CHUNK_SHARE = 0.5
#: Bytes of the packed form, lowest and highest ratio of the whole.
WHOLE_BANDS = (
    (100, 0.95, 1.45), (168, 1.00, 1.54), (238, 1.10, 1.64), (336, 1.20, 1.77), (475, 1.28, 1.90), (672, 1.38, 1.96),
    (950, 1.50, 2.04), (1345, 1.60, 2.10), (1900, 1.70, 2.18), (2700, 1.78, 2.22), (3800, 1.86, 2.29), (5400, 1.92, 2.40),
    (9000, 1.98, 2.52), (18000, 2.05, 2.78), (36000, 2.10, 2.95), (100000, 2.15, 3.10),
)
#: The least ratios of texts in UTF-8 are this share of the others'.
WIDE_LOW = 0.7

_LOG = np.log([b for b, _, _ in WHOLE_BANDS])
_LOW = [x for _, x, _ in WHOLE_BANDS]
_HIGH = [x for _, _, x in WHOLE_BANDS]
SIGNALS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "whole_ratio double, chunk_share double, kept boolean")


def repeated_words(words: list[bytes], size: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``size`` words (a power of two) that occur twice or more, exactly.

    Windows are numbered by doubling: equal pairs of equal halves get equal numbers.
    """
    n = len(words)
    if n <= size:
        return 0
    numbers: dict[bytes, int] = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    half, top = 1, len(numbers)
    while half < size:
        pairs, a = np.unique(a[:-half] * top + a[half:], return_inverse=True)
        half, top = 2 * half, len(pairs)
        if top == len(a):  # no window of this length repeats, so no longer one does
            return 0
    starts = np.nonzero(np.bincount(a, minlength=top)[a] > 1)[0]
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[starts] += 1
    edge[starts + size] -= 1
    return int(np.count_nonzero(np.cumsum(edge[:n])))


def duplicate_lines(data: bytes) -> int:
    seen, n = set(), 0
    for line in data.split(b"\n"):
        if line.split():
            n += line in seen
            seen.add(line)
    return n


def script_neutral(text: str) -> tuple[bytes, bool]:
    """A byte for each character, or UTF-8 (and true) if there are too many different characters."""
    try:
        return text.encode("latin-1"), False
    except UnicodeEncodeError:
        alphabet = sorted(set(text))
        if len(alphabet) > 256:
            return text.encode(), True
    low = [c for c in alphabet if c < "\x80"]
    free = iter(sorted(set(range(256)) - set(map(ord, low))))
    return text.translate({ord(c): chr(next(free)) for c in alphabet if c >= "\x80"}).encode("latin-1"), False


def chunks(data: bytes) -> list[bytes]:
    ends = list(range(CHUNK_BYTES, len(data), CHUNK_BYTES)) + [len(data)]
    if len(ends) > 1 and ends[-1] - ends[-2] < LAST_CHUNK_BYTES:
        del ends[-2]
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def compression(text: str, packer: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Whole ratio, share of chunks out of band, and whether the bands accept the document."""
    if not text:
        return 0.0, 0.0, False
    data, wide = script_neutral(text)
    least = WIDE_LOW if wide else 1.0
    whole = len(data) / len(packer.compress(data))
    at = np.log(len(data))
    low, high = least * np.interp(at, _LOG, _LOW), np.interp(at, _LOG, _HIGH)
    out = 0.0
    parts = chunks(data)
    if len(parts) > 1:
        ratios = [len(c) / len(packer.compress(c)) for c in parts]
        out = sum(not least * CHUNK_BAND[0] <= r <= CHUNK_BAND[1] for r in ratios) / len(parts)
    return whole, out, bool(low <= whole <= high) and out <= CHUNK_SHARE


def signals(texts: list) -> list[tuple]:
    packer, out = zstandard.ZstdCompressor(level=LEVEL), []
    for text in texts:
        data = (text or "").encode()
        words = data.split()  # at the bytes 0x20 and 0x09-0x0D
        n = len(words)
        blank = len(data) - sum(map(len, words))
        repeats = repeated_words(words)
        failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
        whole, share, good = compression(text or "", packer)
        out.append((n, len(text or "") - blank, len(data) - len(data.translate(None, SYMBOLS)), duplicate_lines(data),
                    repeats, failed, whole, share, good and not failed))
    return out


def quality(text: Column) -> Column:
    """Struct of ``SIGNALS`` for a text column."""
    return per_row(signals, SIGNALS, text)


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that all rules keep, with all their columns."""
    prepare(docs.sparkSession)
    name = fresh(docs, "signals")
    return docs.withColumn(name, quality(F.col("text"))).where(F.col(name)["kept"]).select(*quoted(docs.columns))


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", quality(F.col("text")).alias("s")).select("doc_id", "s.*")
