import hashlib
import random

from conftest_llm import DOCS, odd_texts, rows_of

from shelfmatch.llm import decontaminate as D
from shelfmatch.llm.common import normal_words

ITEMS = "item_id long, text string"


def brute(docs, items):
    out = {}
    for i, t, *_ in docs:
        words, hit, found = normal_words(t), set(), set()
        for item, text in items:
            w = normal_words(text)
            windows = [w[k:k + 10] for k in range(len(w) - 9)] if len(w) >= 10 else [w] if w else []
            for v in windows:
                for k in range(len(words) - len(v) + 1):
                    if words[k:k + len(v)] == v:
                        hit.update(range(k, k + len(v)))
                        found.add(item)
        out[i] = (len(words), len(hit), sorted(found - {None}))
    return out


def data():
    random.seed(5)
    word = lambda: random.choice("a b c dd E".split())
    items = [(k, " ".join(word() for _ in range(random.choice([0, 1, 3, 9, 10, 11, 14])))) for k in range(1, 40)]
    items += [(1, "one more text of the first item id with more than ten words in it"), (None, "no id but nine words or so in it"), (77, None), (78, ""), (79, "é中 ö"), (80, "...")]
    docs = rows_of(odd_texts() + [" ".join(word() for _ in range(random.randrange(80))) for _ in range(60)]
                   + ["x " + (t or "").upper().replace(" ", "--") + " y" for _, t in items])
    return docs, items


def test_equals_brute_force_in_one_and_in_many_blocks(spark, frame):
    docs, items = data()
    want = brute(docs, items)
    for block_words in (D.BLOCK_WORDS, 60):
        got = D.contamination(frame(docs, DOCS), frame(items, ITEMS), block_words).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want
        for r in got:
            assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_repeated_rows_come_back_once_each(spark, frame):
    rows = [(1, "one two three"), (1, "one two three"), (1, "other"), (None, "one two three"), (None, "one two three"), (None, "one two three"), (None, None), (None, None)]
    for block_words in (D.BLOCK_WORDS, 1):
        got = D.contamination(frame(rows, "doc_id long, text string"), frame([(7, "two three"), (8, "nine")], ITEMS), block_words).collect()
        assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r["items"]) for r in got) == sorted((i or 0, 3, 2, [7]) if t == "one two three" else (i or 0, len((t or "").split()), 0, []) for i, t in rows)


def test_search_skips_but_finds_all():
    random.seed(6)
    patterns = {tuple(random.choice("abc") for _ in range(n)): n for n in (1, 2, 3, 5, 5, 8)}
    words = [random.choice("abcd") for _ in range(3000)]
    want = sorted((k, k + len(p), n) for p, n in patterns.items() for k in range(len(words)) if tuple(words[k:k + len(p)]) == p)
    assert sorted(D.WuManber(patterns).find(words)) == want


def test_filter_and_empty_tables(spark, frame):
    docs, items = data()
    schema = DOCS + ", n_hit string, text_hash int, _id int"
    wide = frame([(*d, "x", 1, 2) for d in docs], schema)
    kept = D.decontaminated(wide, frame(items, ITEMS))
    want = {i for i, (_, n, _) in brute(docs, items).items() if not n}
    assert kept.columns == wide.columns and {r.doc_id for r in kept.collect()} == want
    none = spark.createDataFrame([], ITEMS)
    assert D.decontaminated(wide, none).count() == len(docs)
    assert D.contamination(spark.createDataFrame([], DOCS), none).count() == 0
    assert hashlib.sha256(b"").hexdigest() == spark.sql("SELECT sha2('', 256) AS s").first().s
