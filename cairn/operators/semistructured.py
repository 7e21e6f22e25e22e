"""Semi-structured values held as Spark VARIANT.

VARIANT cannot be grouped, sorted, compared or hashed, so every operator
here types values out (``variant_get`` with a target type) before they reach
a shuffle. Path semantics: a missing key gives NULL, a failed cast raises
(``try_get`` gives NULL instead).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(text: Column, strict: bool = True) -> Column:
    """PARSE_JSON (``strict=False``: NULL for malformed text)."""
    return F.parse_json(text) if strict else F.try_parse_json(text)


def get(v: Column, path: str, type_: str) -> Column:
    """``v:a.b[0].c::type``. ``path`` is a JSONPath such as
    ``$.customer.name`` or ``$.items[0].sku``."""
    return F.variant_get(v, path, type_)


def try_get(v: Column, path: str, type_: str) -> Column:
    return F.try_variant_get(v, path, type_)


def flatten(df: DataFrame, v: Column, path: str, outer: bool = False,
            index_col: str = "index", value_col: str = "value") -> DataFrame:
    """LATERAL FLATTEN of an array inside a variant: one row per element
    with its position. Without ``outer`` rows whose array is missing or
    empty disappear, as in FLATTEN without OUTER => TRUE. A generator is a
    narrow, per-row operator: it needs no shuffle."""
    arr = F.variant_get(v, path, "array<variant>")
    gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
    return df.select("*", gen.alias(index_col, value_col))


# fixed values: TYPEOF names of the source engine, keyed by the leading
# token of Spark's schema_of_variant
_TYPE_NAMES = {
    "OBJECT": "OBJECT", "ARRAY": "ARRAY", "STRING": "VARCHAR", "BOOLEAN": "BOOLEAN",
    "BIGINT": "INTEGER", "INT": "INTEGER", "SMALLINT": "INTEGER", "TINYINT": "INTEGER",
    "DECIMAL": "DECIMAL", "DOUBLE": "DOUBLE", "FLOAT": "DOUBLE", "VOID": "NULL_VALUE",
    "DATE": "DATE", "TIMESTAMP": "TIMESTAMP_LTZ", "TIMESTAMP_NTZ": "TIMESTAMP_NTZ", "BINARY": "BINARY",
}


def typeof(v: Column) -> Column:
    """TYPEOF of a variant value (OBJECT, ARRAY, VARCHAR, INTEGER,
    DECIMAL, DOUBLE, BOOLEAN, NULL_VALUE; SQL NULL gives NULL). One map
    lookup on the leading token of ``schema_of_variant``, so the schema is
    computed once per value (a CASE chain would re-evaluate it per branch)."""
    names = F.create_map(*[F.lit(x) for kv in _TYPE_NAMES.items() for x in kv])
    head = F.regexp_extract(F.schema_of_variant(v), r"^([A-Z_]+)", 1)
    return F.try_element_at(names, head)


def kafka_envelope(records: DataFrame) -> DataFrame:
    """Kafka-shaped rows (key, value, topic, partition, offset,
    timestamp) to the two-variant table layout: ``record_metadata`` (topic,
    partition, offset, CreateTime) and ``record_content`` (the parsed JSON
    body). Works on ``readStream.format('kafka')`` frames and on batch frames
    alike."""
    meta = F.to_json(F.struct(
        F.col("topic").alias("topic"), F.col("partition").alias("partition"),
        F.col("offset").alias("offset"),
        (F.unix_micros(F.col("timestamp").cast("timestamp")) / 1000).cast("bigint").alias("CreateTime")))
    return records.select(F.parse_json(meta).alias("record_metadata"),
                          F.parse_json(F.col("value").cast("string")).alias("record_content"))


def shape_events(envelope: DataFrame) -> DataFrame:
    """Typed columns out of the envelope, with topic / partition /
    offset lineage."""
    c, m = F.col("record_content"), F.col("record_metadata")
    return envelope.select(
        get(c, "$.event_id", "int").alias("event_id"),
        get(c, "$.product", "string").alias("product"),
        get(c, "$.qty", "int").alias("qty"),
        get(c, "$.price", "decimal(10,2)").alias("price"),
        get(m, "$.topic", "string").alias("topic"),
        get(m, "$.partition", "int").alias("partition"),
        get(m, "$.offset", "bigint").alias("kafka_offset"))


def read_topic(spark, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """S13 source: a Kafka topic as a stream. Needs the Kafka connector on
    the classpath (not present in the test image)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load())
