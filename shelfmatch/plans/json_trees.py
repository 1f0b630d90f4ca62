"""Queries of the JSON tree search (A7) and of embedded attribute lists (X19), over documents derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators.trees import embedded_specifications, find_attribute_lists
from shelfmatch.plans.registry import query
from shelfmatch.plans.tables import table


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """``events``, dealt to all cores: a row of its few files becomes a document, and a walk keeps to the tasks that it began with."""
    return table(spark, sf, "events").repartition(max(4 * spark.sparkContext.defaultParallelism, 32), "event_id")


@query("attribute_lists_events", """
SELECT event_id, '[{"groupName":"' || event_type || '"},' || event_id || ']' AS items FROM events WHERE event_id % 7 <> 0
""")
def attribute_lists_events(spark: SparkSession, sf: str) -> DataFrame:
    """Trees of eight depths; before the list stand empty lists, strings that look like one and names that sort behind it, after
    it other lists on higher levels; a seventh has none."""
    ev = _events(spark, sf)
    number = F.col("event_id").cast("string")
    held = F.concat(F.lit('{"attributeItem":[{"groupName":"'), F.col("event_type"), F.lit('"},'), number, F.lit("]}"))
    inner = F.when(F.col("event_id") % 7 == 0, F.lit('{"attributeItem":"no list"}')).otherwise(held)
    after = F.when(F.col("event_id") % 7 == 0, F.lit("null")).otherwise(F.lit('{"attributeItem":["no"]}'))
    tree = F.aggregate(F.sequence(F.lit(1), (F.col("event_id") % 8 + 1).cast("int")), inner, lambda acc, i: F.when(
        i % 2 == 0, F.concat(F.lit('["{\\"attributeItem\\":[0]}",'), acc, F.lit(","), after, F.lit("]"))).otherwise(
        F.concat(F.lit('{"z":{"attributeItem":[]},"m":'), acc, F.lit(',"a":'), after, F.lit("}"))))
    found = find_attribute_lists(ev.select(F.col("event_id").alias("doc"), tree.alias("json")))
    return found.select(F.col("doc").alias("event_id"), F.col("json").alias("items"))


@query("embedded_specs_events", """
WITH p AS (SELECT * FROM events WHERE event_id % 6 <> 0 AND event_id % 11 <> 0)
SELECT event_id, event_type AS spec_group, 'named' AS spec_name, 'v' || event_id AS spec_value FROM p WHERE event_id % 5 <> 0
UNION ALL SELECT event_id, event_type, 'user', CAST(user_id AS VARCHAR) FROM p
UNION ALL SELECT event_id, 'Other', NULL, NULL FROM p
""")
def embedded_specs_events(spark: SparkSession, sf: str) -> DataFrame:
    """J8, A7 and A6 as one job: references to lists, items, names and values, to themselves, around a circle and to nothing;
    pages without payload and with one that is no JSON."""
    ev = _events(spark, sf)
    nodes = F.concat(
        F.lit('["$","$L1",null,{"data":"$2"}],"2":{"loop":"$2","x":"$3"},"3":{"list":{"attributeItem":"$4"}},"4":["$5",{"groupName":"Other","attributes":[]},{"groupName":" "}],'
              '"5":{"groupName":"  '), F.col("event_type"), F.lit(' ","attributes":["$6",{"displayName":"user","value":'), F.col("user_id").cast("string"),
        F.lit('},{"displayName":"circle","value":"$7"},{"displayName":" ","value":1}]},"6":{"displayName":"$8","value":"'),
        F.when(F.col("event_id") % 5 == 0, "$nothing").otherwise("$9"), F.lit('"},"7":"$10","10":"$7","8":" named","9":"v'), F.col("event_id").cast("string"), F.lit('"'))
    text = F.when(F.col("event_id") % 11 == 0, F.lit('["$2"],"2":{oops')).otherwise(nodes)
    script = F.concat(F.lit('<script>self.__next_f.push([1, "15:x"])</script><script>self.__next_f.push([1,"16:'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"])</script>'))
    html = F.concat(F.lit("<html><body>"), F.when(F.col("event_id") % 6 == 0, "").otherwise(script), F.lit("</body></html>"))
    found = embedded_specifications(ev.select(F.col("event_id").alias("page_id"), html.alias("html")))
    groups = found.select(F.col("page_id").alias("event_id"), F.explode("specs").alias("spec_group", "pairs"))
    return groups.select("event_id", "spec_group", F.explode_outer("pairs").alias("spec_name", "spec_value"))
