"""Registered semi-structured queries.

JSON documents are made from single rows of ``documents`` with ``to_json``
(the text's lines are the items) and parsed back into VARIANT, so the oracle
can state the same question relationally. Making them needs no shuffle, and an
array is as long as the text has lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators import semistructured as js
from cairn.plans.registry import register
from cairn.session import read_table
from cairn.sources import files
from cairn.streaming import ingest


def order_documents(docs: DataFrame) -> DataFrame:
    """``{order_id, customer{name, country, vip}, items[{sku, qty, price}]}``
    of each row (doc_id, text, lang, source, n_chars): an item is a line."""
    size = F.length
    item = lambda line: F.struct(
        F.concat(F.lit("L-"), size(line).cast("string")).alias("sku"), (size(line) % 7 + 1).alias("qty"),
        (size(line) * F.lit(0.25).cast("decimal(3,2)")).cast("decimal(10,2)").alias("price"))
    doc = F.struct(
        F.col("doc_id").alias("order_id"),
        F.struct(F.col("source").alias("name"), F.col("lang").alias("country"), (F.col("n_chars") > 2000).alias("vip")).alias("customer"),
        F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), item).alias("items"))
    return docs.select("doc_id", F.to_json(doc).alias("json"))


def order_variants(spark, root) -> DataFrame:
    """The documents as one VARIANT column ``v``."""
    docs = read_table(spark, root, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return order_documents(docs).select(js.parse(F.col("json")).alias("v"))


_LINES = """
lines AS (SELECT doc_id AS order_id, source, lang, n_chars, string_split(coalesce(text, ''), chr(10)) AS cut FROM documents),
items AS (
  SELECT order_id, idx, 'L-' || CAST(length(cut[idx + 1]) AS VARCHAR) AS sku, CAST(length(cut[idx + 1]) % 7 + 1 AS INTEGER) AS qty,
         CAST(length(cut[idx + 1]) * 0.25 AS DECIMAL(10,2)) AS price
  FROM (SELECT order_id, cut, unnest(range(len(cut))) AS idx FROM lines))"""


@register("json_variant_scan", oracle="WITH " + _LINES + """
SELECT order_id, CAST(len(cut) AS BIGINT) AS n_items FROM lines""")
def json_variant_scan(spark, root):
    """S3: documents land as one VARIANT each; schema on read."""
    v = F.col("v")
    return order_variants(spark, root).select(
        js.get(v, "$.order_id", "bigint").alias("order_id"),
        F.array_size(js.get(v, "$.items", "array<variant>")).cast("bigint").alias("n_items"))


@register("json_parse", oracle="""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_parse(spark, root):
    """PARSE_JSON of a text column, then a typed path."""
    e = read_table(spark, root, "events")
    return e.select("event_id", js.get(js.parse(F.col("props")), "$.k", "int").alias("k"))


@register("json_path", oracle="""
SELECT doc_id AS order_id, source AS customer_name, lang AS country, n_chars > 2000 AS is_vip FROM documents""")
def json_path(spark, root):
    """nested dot paths with casts."""
    v = F.col("v")
    return order_variants(spark, root).select(
        js.get(v, "$.order_id", "bigint").alias("order_id"),
        js.get(v, "$.customer.name", "string").alias("customer_name"),
        js.get(v, "$.customer.country", "string").alias("country"),
        js.get(v, "$.customer.vip", "boolean").alias("is_vip"))


@register("json_array_index", oracle="WITH " + _LINES + """
SELECT order_id, sku AS first_sku, qty AS first_qty FROM items WHERE idx = 0""")
def json_array_index(spark, root):
    """array element by position (``v:items[0].sku``)."""
    v = F.col("v")
    return order_variants(spark, root).select(
        js.get(v, "$.order_id", "bigint").alias("order_id"),
        js.get(v, "$.items[0].sku", "string").alias("first_sku"),
        js.get(v, "$.items[0].qty", "int").alias("first_qty"))


@register("json_typeof", oracle="""
SELECT doc_id AS order_id, 'OBJECT' AS doc_type, 'ARRAY' AS items_type, 'INTEGER' AS id_type,
       'VARCHAR' AS name_type, 'BOOLEAN' AS vip_type, 'DECIMAL' AS price_type, CAST(NULL AS VARCHAR) AS missing_type
FROM documents""")
def json_typeof(spark, root):
    """TYPEOF of variant values of each kind."""
    v = F.col("v")
    return order_variants(spark, root).select(
        js.get(v, "$.order_id", "bigint").alias("order_id"),
        js.typeof(v).alias("doc_type"),
        js.typeof(js.get(v, "$.items", "variant")).alias("items_type"),
        js.typeof(js.get(v, "$.order_id", "variant")).alias("id_type"),
        js.typeof(js.get(v, "$.customer.name", "variant")).alias("name_type"),
        js.typeof(js.get(v, "$.customer.vip", "variant")).alias("vip_type"),
        js.typeof(js.get(v, "$.items[0].price", "variant")).alias("price_type"),
        js.typeof(js.get(v, "$.no_such_key", "variant")).alias("missing_type"))


@register("filter_not_null", oracle="""
SELECT CAST(count(*) FILTER (WHERE json_extract(props, '$.k') IS NOT NULL) AS BIGINT) AS with_k,
       CAST(count(*) FILTER (WHERE json_extract(props, '$.missing') IS NOT NULL) AS BIGINT) AS with_missing
FROM events""")
def filter_not_null(spark, root):
    """IS NOT NULL on a variant path (a missing key is NULL)."""
    v = js.parse(F.col("props"))
    e = read_table(spark, root, "events").select(v.alias("v"))
    return e.agg(
        F.count(F.when(js.get(F.col("v"), "$.k", "variant").isNotNull(), 1)).alias("with_k"),
        F.count(F.when(js.get(F.col("v"), "$.missing", "variant").isNotNull(), 1)).alias("with_missing"))


@register("flatten_items", oracle="WITH " + _LINES + """
SELECT order_id, CAST(idx AS INTEGER) AS index,
       sku, qty, CAST(price AS DECIMAL(10,2)) AS price, CAST(qty * price AS DOUBLE) AS line_total
FROM items""")
def flatten_items(spark, root):
    """LATERAL FLATTEN of ``v:items``, one row per item."""
    rows = js.flatten(order_variants(spark, root), F.col("v"), "$.items")
    item = F.col("value")
    qty = js.get(item, "$.qty", "int")
    price = js.get(item, "$.price", "decimal(10,2)")
    return rows.select(js.get(F.col("v"), "$.order_id", "bigint").alias("order_id"),
                       F.col("index"),
                       js.get(item, "$.sku", "string").alias("sku"),
                       qty.alias("qty"), price.alias("price"),
                       (qty * price).cast("double").alias("line_total"))


@register("order_total_from_json", oracle="WITH " + _LINES + """
SELECT order_id, CAST(sum(qty * price) AS DOUBLE) AS order_total FROM items GROUP BY order_id""")
def order_total_from_json(spark, root):
    """A5: GROUP BY a select-list alias over flattened items."""
    rows = js.flatten(order_variants(spark, root), F.col("v"), "$.items")
    item = F.col("value")
    line = js.get(item, "$.qty", "int") * js.get(item, "$.price", "decimal(10,2)")
    return (rows.select(js.get(F.col("v"), "$.order_id", "bigint").alias("order_id"), line.alias("line"))
                .groupBy("order_id").agg(F.sum("line").cast("double").alias("order_total")))


def event_records(spark, root) -> DataFrame:
    """The events table dressed as Kafka records of topic product_events:
    partition = user_id mod 3, offset = event_id, body = JSON event."""
    e = read_table(spark, root, "events")
    body = F.to_json(F.struct(
        F.col("event_id").alias("event_id"), F.col("event_type").alias("product"),
        F.get_json_object("props", "$.k").cast("int").alias("qty"),
        F.col("value").cast("decimal(10,2)").alias("price")))
    return e.select(F.col("user_id").cast("string").cast("binary").alias("key"),
                    body.cast("binary").alias("value"),
                    F.lit("product_events").alias("topic"),
                    F.pmod(F.col("user_id"), F.lit(3)).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"),
                    F.col("ts").cast("timestamp").alias("timestamp"))


_SHAPED = """
SELECT CAST(event_id AS INTEGER) AS event_id, event_type AS product,
       CAST(json_extract(props, '$.k') AS INTEGER) AS qty, CAST(value AS DECIMAL(10,2)) AS price,
       'product_events' AS topic, CAST(user_id % 3 AS INTEGER) AS partition, event_id AS kafka_offset
FROM events"""


@register("kafka_envelope", oracle="""
SELECT 'OBJECT' AS metadata_type, 'OBJECT' AS content_type,
       CAST(event_id AS BIGINT) AS kafka_offset FROM events""")
def kafka_envelope(spark, root):
    """Records to (record_metadata, record_content) variants; checked
    through TYPEOF of both columns and the offset path."""
    env = js.kafka_envelope(event_records(spark, root))
    return env.select(js.typeof(F.col("record_metadata")).alias("metadata_type"),
                      js.typeof(F.col("record_content")).alias("content_type"),
                      js.get(F.col("record_metadata"), "$.offset", "bigint").alias("kafka_offset"))


@register("shape_events", oracle=_SHAPED)
def shape_events(spark, root):
    """Typed event columns with topic / partition / offset."""
    return js.shape_events(js.kafka_envelope(event_records(spark, root)))


@register("kafka_replayed", oracle=_SHAPED)
def kafka_replayed(spark, root):
    """A connector that delivers every record once, then a part of
    them again (twice in one flush); the stream appends each record once."""
    records = event_records(spark, root)
    landed, table, mark = (files.shared_folder(spark, n) for n in ("records", "event-table", "event-stream"))
    again = records.filter(F.col("offset") % 3 == 0)
    for delivery in (records, again.union(again)):
        delivery.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(records.schema).parquet(landed)
        ingest.stream_to_table(js.kafka_envelope(ingest.once_each(stream)), table, mark, available_now=True).awaitTermination()
    return js.shape_events(spark.read.parquet(table))
