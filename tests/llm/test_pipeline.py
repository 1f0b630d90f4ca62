import numpy as np
import sentencepiece
from conftest_llm import DOCS, odd_texts, rows_of
from test_decontaminate import brute as brute_contamination
from test_near import brute as brute_near

import __spark_entry__ as entry
import corpus_pipeline
from shelfmatch.llm import language, pieces, quality
from shelfmatch.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_each_stage_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        if name == "quality rules":
            want = {i for i, t in rows if quality.signals([t])[0][-1]}
        elif name == "language identification":
            model = language.fit(docs)
            want = {i for i, t in rows if not model.predict(t)[2]}
        elif name == "n-gram Jaccard join":
            want = {i for i, (top, _) in brute_near(rows).items() if i == top}
        elif name == "benchmark decontamination":
            want = {i for i, (_, hits, _) in brute_contamination(rows, items).items() if not hits}
        docs = stored(stage(spark, docs, SF), "test-stage")
        assert {r.doc_id for r in docs.select("doc_id").collect()} == want, name
        assert docs.columns[:len(columns)] == columns
        assert docs.count() == len(want)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    for r in docs.collect():
        assert np.frombuffer(r.token_ids, dtype="<u4").tolist() == library.encode(r.text) and r.round_trip
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(want)


def test_stages_take_odd_rows_empty_tables_and_more_columns(spark, frame):
    schema = DOCS + ", signals string, language string, coded int, token_ids string, key_id int, hit_id int"
    rows = [(*r, "a", "b", 1, "c", 2, 3) for r in rows_of(odd_texts())]
    for docs in (frame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns[:len(docs.columns)] == docs.columns and out.count() <= docs.count()


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
