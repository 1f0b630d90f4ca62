"""JSON tree search (A7) and embedded attribute lists (X19) against a recursive search in Python."""

import json
import random

from pyspark.sql import functions as F

from shelfmatch.operators.trees import attribute_items, embedded_specifications, find_attribute_lists, node_table, payload

ROOTS = "doc long, json string"


def search(o):
    if isinstance(o, dict):
        if isinstance(o.get("attributeItem"), list):
            return o["attributeItem"]
        for v in o.values():
            if r := search(v):
                return r
    elif isinstance(o, list):
        for v in o:
            if r := search(v):
                return r
    return []


def tree(r, depth):
    kind = r.random()
    if depth == 0 or kind < 0.3:
        return r.choice([1, None, "x", '{"attributeItem":[1]}', True, [], {}])
    if kind < 0.6:
        return [tree(r, depth - 1) for _ in range(r.randrange(4))]
    names = r.sample(["z", "a", "m", "é", "a b"], r.randrange(1, 4))
    out = {n: tree(r, depth - 1) for n in names}
    if r.random() < 0.25:
        out["attributeItem"] = r.choice([[], [r.randrange(9)], "no", [{"attributeItem": [7]}]])
    return out


def test_search_equals_recursion(spark):
    r = random.Random(3)
    docs = [tree(r, 5) for _ in range(400)]
    texts = [json.dumps(d, ensure_ascii=False) for d in docs] + [None, "", "oops", "[1"]
    got = {x.doc: json.loads(x.json) for x in find_attribute_lists(spark.createDataFrame(list(enumerate(texts)), ROOTS).repartition(3)).collect()}
    want = {k: found for k, d in enumerate(docs) if (found := search(d))}
    assert got == want and len(want) > 50


def test_depth_has_no_limit(spark):
    deep = '{"a":[' * 30 + '{"attributeItem":[5]}' + "]}" * 30
    got = find_attribute_lists(spark.createDataFrame([(1, deep)], ROOTS)).collect()
    assert [(r.doc, r.json) for r in got] == [(1, "[5]")]
    assert find_attribute_lists(spark.createDataFrame([], ROOTS)).count() == 0


def test_items_with_references(spark):
    nodes = {"__root": [{"attributeItem": "$l"}], "l": ["$i", 3, {"groupName": "$g", "attributes": "$a"}], "i": {"groupName": "G", "attributes": [{"displayName": "n", "value": "$c1"}]},
             "g": "H", "a": [{"displayName": "x", "value": "$v"}, "$none", {"displayName": "deep", "value": "$i"}], "v": 5, "c1": "$c2", "c2": "$c1"}
    documents = spark.createDataFrame([(1, json.dumps(nodes)), (2, "[]"), (3, None)], ROOTS)
    table = node_table(documents, "doc", "json")
    roots = table.where(F.col("key") == "__root").select("doc", "json")
    items = {r.item_pos: (r.groupName, [tuple(a) for a in r.attributes]) for r in attribute_items(find_attribute_lists(roots, table), table).collect()}
    assert items[0] == ("G", [("n", None)]) and items[2][0] == "H"
    assert items[2][1][0] == ("x", "5") and items[2][1][1][0] == "deep"


def test_payload_forms(spark):
    push = '<script>self.__next_f.push([1,"16:{}"])</script>'
    htmls = [push.format(r'[\"$1\"],\"1\":{\"a\":\"x\ny\"}'), push.format('["$1"],"1":2'), push.format(r"[1]"), push.format("oops"), "", None, push.format(r'[\"\d\"]')]
    got = [r.p for r in spark.createDataFrame(list(enumerate(htmls)), "k long, h string").coalesce(1).select(payload(F.col("h")).alias("p")).collect()]
    assert got[0] == '{"__root":["$1"],"1":{"a":"xy"}}' and got[1] == '{"__root":["$1"],"1":2}' and got[2] == '{"__root":[1]}'
    assert got[3:6] == [None] * 3
    assert embedded_specifications(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_documents_of_events_are_dealt_to_all_cores(spark):
    from shelfmatch.plans.json_trees import _events

    assert _events(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 32  # the file of events is one task


def test_a_walk_starts_no_job_per_level(spark):
    """Levels were written and nodes shuffled once per level and reference; now a document is walked where its rows meet."""
    deep = '{"a":[' * 30 + '{"x":"$1"}' + "]}" * 30
    documents = spark.createDataFrame([(k, '{"__root":%s,"1":{"attributeItem":["$2"]},"2":{"groupName":"G"}}' % deep) for k in range(20)], ROOTS).repartition(3)
    table = node_table(documents, "doc", "json")
    sc = spark.sparkContext
    sc.setJobGroup("walk", "walk")
    try:
        found = find_attribute_lists(table.where(F.col("key") == "__root").select("doc", "json"), table)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert not sc.statusTracker().getJobIdsForGroup("walk")
    assert sorted((r.doc, r.json, r.seen) for r in found.collect()) == [(k, '["$2"]', ["1"]) for k in range(20)]
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_texts_are_written_as_spark_writes_them(spark):
    texts = ['[ {"a" : 1.50, "b":"\\u00e9\\/\\u001f\\n"} , -0, 1e5, "x", null, [1 , 2.0E+3], true]', "[1.0] junk", "[12345678901234567890123, 0.1e-10]"]
    docs = spark.createDataFrame([(k, '{"x": {"attributeItem":%s}}' % t) for k, t in enumerate(texts)], ROOTS)
    want = {r.doc: r.w for r in docs.select("doc", F.from_json(F.from_json("json", "map<string,string>")["x"], "map<string,string>")["attributeItem"].alias("w")).collect()}
    assert want[0] == '[{"a":1.5,"b":"é/\\u001F\\n"},0,100000.0,"x",null,[1,2000.0],true]'
    assert {r.doc: r.json for r in find_attribute_lists(docs).collect()} == {k: w for k, w in want.items() if k != 1}


def test_documents_that_share_a_key_and_null_keys(spark):
    item = '["$i",{"groupName":"H","attributes":[{"displayName":"a","value":%s}]}]'
    made = [(1, '{"__root":{"x":{"attributeItem":%s}},"i":{"groupName":"G%s"}}' % (item % v, v)) for v in (5, 5, 7)]
    made += [(None, '{"__root":{"attributeItem":["$i",{"groupName":"N"}],"z":[{"attributeItem":[1]}]},"i":{}}'), (2, '{"__root":{"a":{"attributeItem":[]},"b":["$i"]},"i":{"c":{"attributeItem":["$j"]}}}')]
    table = node_table(spark.createDataFrame(made, ROOTS).repartition(3), "doc", "json")
    found = find_attribute_lists(table.where(F.col("key") == "__root").select("doc", "json"), table)
    assert {(r.doc, r.json, tuple(r.seen)) for r in found.collect()} == {
        (1, item % 5, ()), (None, '["$i",{"groupName":"N"}]', ()), (2, '["$j"]', ("i",))}
    got = {(r.doc, r.item_pos, r.groupName, tuple(map(tuple, r.attributes))) for r in attribute_items(found, table).collect()}
    assert got == {(1, 0, "G5", ()), (1, 0, "G7", ()), (1, 1, "H", (("a", "5"),)), (None, 1, None, ())}
