"""Bindings of the JSON row operators.

An order document is JSON text with its lines as a nested list, each with a list of price adjustments; a
returned line writes its quantity as text (elements of unlike types). Documents of pending orders whose key ends
in 0 arrive cut off (malformed). An event's ``props`` is an object whose entries become rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.arrays import explode_json
from .common import load


def order_documents(spark, d):
    """o_orderkey and the order's document; lines in the order of their fields, so equal tables give equal texts."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
                    F.col("l_quantity").cast("long").alias("qty"), F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
                    F.round(F.col("l_tax") * 100).cast("int").alias("tax"), "l_returnflag")
    g = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))

    def item(x):
        qty = F.when(x["l_returnflag"] == "R", F.concat(F.lit('"'), x["qty"].cast("string"), F.lit('"'))).otherwise(x["qty"].cast("string"))
        adjustment = lambda kind: F.when(x[kind] > 0, F.concat(F.lit(f'{{"kind":"{kind}","percent":'), x[kind], F.lit("}")))
        return F.concat(F.lit('{"part":'), x["l_partkey"], F.lit(',"cents":'), x["cents"], F.lit(',"qty":'), qty, F.lit(',"adjustments":['),
                        F.concat_ws(",", adjustment("discount"), adjustment("tax")), F.lit("]}"))

    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus").join(g.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    text = F.when(F.col("lines").isNull(), F.lit("{}")).otherwise(
        F.concat(F.lit('{"order":{"items":['), F.array_join(F.transform("lines", item), ","), F.lit("]}}")))
    cut = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 10 == 0)
    return o.withColumn("text", text).select(
        "o_orderkey", F.when(cut, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text")).alias("document"))


def order_document_items(spark, d):
    """One row per order x item x adjustment; orders without items and malformed documents keep one row of NULLs."""
    ex = explode_json(order_documents(spark, d), "document", path="$.order.items", keep_empty=True, out="entry", at="item_path")
    ex = ex.select("o_orderkey", F.col("pos").alias("item"), "item_path", F.try_variant_get("entry", "$.part", "long").alias("part"),
                   F.try_variant_get("entry", "$.qty", "int").alias("quantity"), F.try_variant_get("entry", "$.cents", "long").alias("cents"),
                   F.try_variant_get("entry", "$.adjustments", "string").alias("adjustments"))
    adj = explode_json(ex, "adjustments", "struct<kind:string,percent:int>", keep_empty=True, out="adjustment")
    return adj.select("o_orderkey", "item", "item_path", "part", "quantity", "cents", F.col("pos").alias("adjustment"),
                      F.col("adjustment.kind").alias("kind"), F.col("adjustment.percent").alias("percent"))


def order_document_adjustments(spark, d):
    """Adjustments of all items by one path through both lists, summed per kind and position."""
    ex = explode_json(order_documents(spark, d), "document", "struct<kind:string,percent:long>", "$.order.items[*].adjustments[*]")
    return ex.groupBy(F.col("item.kind").alias("kind"), F.col("pos_1").alias("item_position"), F.col("pos_2").alias("adjustment_position")).agg(
        F.count(F.lit(1)).alias("adjustments"), F.sum("item.percent").alias("percent_sum"))


def event_prop_values(spark, d):
    """Every entry of an event's props as a row: key, value as text."""
    e = load(spark, d, "events").select("event_id", "event_type", "props")
    ex = explode_json(e, "props", "string", pos=False, out="value", key="prop")
    return ex.groupBy("event_type", "prop", "value").agg(F.count(F.lit(1)).alias("events"))


QUERIES = {f.__name__: f for f in (order_document_items, order_document_adjustments, event_prop_values)}

_DOCS = """
WITH docs AS (
  SELECT o.o_orderkey,
         CASE WHEN COUNT(l.l_orderkey) = 0 THEN '{}' ELSE CAST(json_object('order', json_object('items', to_json(list(
           json_object('part', l_partkey, 'cents', CAST(ROUND(l_extendedprice * 100, 0) AS BIGINT),
                       'qty', CASE WHEN l_returnflag = 'R' THEN to_json(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) ELSE to_json(CAST(l_quantity AS BIGINT)) END,
                       'adjustments', list_filter([CASE WHEN ROUND(l_discount * 100, 0) > 0 THEN json_object('kind', 'discount', 'percent', CAST(ROUND(l_discount * 100, 0) AS INTEGER)) END,
                                                   CASE WHEN ROUND(l_tax * 100, 0) > 0 THEN json_object('kind', 'tax', 'percent', CAST(ROUND(l_tax * 100, 0) AS INTEGER)) END],
                                                  lambda x: x IS NOT NULL))
           ORDER BY l_linenumber, l_partkey, l_suppkey, ROUND(l_extendedprice * 100, 0), CAST(l_quantity AS BIGINT), ROUND(l_discount * 100, 0),
                    ROUND(l_tax * 100, 0), l_returnflag)))) AS VARCHAR) END AS text, o.o_orderstatus
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_orderstatus),
read AS (
  SELECT o_orderkey, CASE WHEN json_valid(document) THEN CAST(document AS JSON) END AS document
  FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 0 THEN left(text, length(text) - 1) ELSE text END AS document FROM docs)),
items AS (SELECT r.o_orderkey, CAST(j.key AS INTEGER) AS item, j.fullkey AS item_path, j.value AS entry
          FROM read r, json_each(r.document, '$.order.items') j)
"""

ORACLE = {
    "order_document_items": _DOCS + """
SELECT r.o_orderkey, i.item, i.item_path, CAST(i.entry ->> '$.part' AS BIGINT) AS part, CAST(i.entry ->> '$.qty' AS INTEGER) AS quantity,
       CAST(i.entry ->> '$.cents' AS BIGINT) AS cents, a.adjustment, a.value ->> '$.kind' AS kind, CAST(a.value ->> '$.percent' AS INTEGER) AS percent
FROM read r LEFT JOIN items i ON i.o_orderkey = r.o_orderkey
LEFT JOIN (SELECT i.o_orderkey, i.item, CAST(j.key AS INTEGER) AS adjustment, j.value FROM items i, json_each(i.entry, '$.adjustments') j) a
  ON a.o_orderkey = i.o_orderkey AND a.item = i.item
""",
    "order_document_adjustments": _DOCS + """
SELECT j.value ->> '$.kind' AS kind, i.item AS item_position, CAST(j.key AS INTEGER) AS adjustment_position, COUNT(*) AS adjustments,
       CAST(SUM(CAST(j.value ->> '$.percent' AS BIGINT)) AS BIGINT) AS percent_sum
FROM items i, json_each(i.entry, '$.adjustments') j GROUP BY ALL
""",
    "event_prop_values": """
SELECT event_type, j.key AS prop, json_extract_string(j.value, '$') AS value, COUNT(*) AS events
FROM events e, json_each(CAST(e.props AS JSON)) j GROUP BY ALL
""",
}
