"""Streaming: load-once ingestion, consuming a change log once, skipping
empty runs, exactly-once aggregate refresh, continuous load, run log, and
the layered ticket chain (S8, C3, C6, C8, C9, C10, C14, S13/C13)."""

import os
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators import changes as ch
from cairn.operators import semistructured as js
from cairn.sources.keyed import KeyedTable
from cairn.streaming import incremental as inc
from cairn.streaming import ingest, runlog
from cairn.streaming.deltas import DeltaAggregate
from cairn.streaming.layers import Layer, Source
from tests.fixtures import KAFKA_VALUES, STREAM_ORDERS_CSV
from tests.test_sources_sinks import ORDERS_SCHEMA


def _files(folder):
    """Data files with their sizes."""
    return {os.path.join(d, n): os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_ingest_new_files_load_once(spark, tmp_dir):
    src, dst, ck = f"{tmp_dir}/stage", f"{tmp_dir}/table", f"{tmp_dir}/ck"
    _write(f"{src}/stream_orders.csv", STREAM_ORDERS_CSV)
    ingest.ingest_new_files(spark, src, dst, ck, "csv", ORDERS_SCHEMA)
    assert spark.read.parquet(dst).count() == 4
    ingest.ingest_new_files(spark, src, dst, ck, "csv", ORDERS_SCHEMA)     # re-run: nothing new
    assert spark.read.parquet(dst).count() == 4
    _write(f"{src}/more.csv", "order_id,customer_name,country,order_ts,status,amount\n"
                              "314,Teo Marsh,NZ,2026-03-10 21:00:00,PAID,10.00\n")
    ingest.ingest_new_files(spark, src, dst, ck, "csv", ORDERS_SCHEMA)
    df = spark.read.parquet(dst)
    assert df.count() == 5
    assert {r["source_file"] for r in df.collect()} == {"stream_orders.csv", "more.csv"}


def test_continuous_load_kafka_shaped(spark, tmp_dir):
    """S13 / C13 / C14 on a file stream dressed as Kafka records."""
    rows = [(None, v, "product_events", 0, i, "2026-07-01 09:00:00") for i, v in enumerate(KAFKA_VALUES)]
    spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, ts string") \
        .withColumn("timestamp", F.to_timestamp("ts")).drop("ts").write.json(f"{tmp_dir}/records")
    schema = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    stream = spark.readStream.schema(schema).json(f"{tmp_dir}/records")
    q = ingest.stream_to_table(js.kafka_envelope(stream), f"{tmp_dir}/events", f"{tmp_dir}/ck",
                               available_now=True)
    q.awaitTermination()
    env = spark.read.parquet(f"{tmp_dir}/events")
    assert env.count() == 5
    assert env.select(js.typeof(F.col("record_content")).alias("t")).distinct().first()["t"] == "OBJECT"
    shaped = js.shape_events(env).orderBy("kafka_offset").collect()
    assert [r["kafka_offset"] for r in shaped] == [0, 1, 2, 3, 4]
    assert shaped[1]["product"] == "Teapot" and str(shaped[1]["price"]) == "18.25"


def test_records_delivered_again_are_appended_once(spark, tmp_dir):
    """Repeated offsets in a batch and across batches; a late record stays; the
    state forgets keys after the time that they are kept for."""
    schema = "topic string, partition int, offset long, value string, timestamp timestamp"
    src, dst, ck = f"{tmp_dir}/src", f"{tmp_dir}/dst", f"{tmp_dir}/ck"

    def deliver(offsets, within="1 hour", when="2026-07-01 09:00:00", into=""):
        rows = [("t", p, o, f"v{p}{o}") for o in offsets for p in (0, 1)]
        df = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
        df.withColumn("timestamp", F.lit(when).cast("timestamp")).coalesce(1).write.mode("append").parquet(src + into)
        stream = spark.readStream.schema(schema).parquet(src + into)
        q = ingest.stream_to_table(ingest.once_each(stream, within=within), dst + into, ck + into, available_now=True)
        q.awaitTermination()
        return q.recentProgress

    deliver([0, 1, 1, 2])
    deliver([2, 2, 3])
    deliver([1, 4], when="2019-01-01 00:00:00")  # long before the others
    got = spark.read.parquet(dst)
    assert got.columns == ["topic", "partition", "offset", "value", "timestamp"]
    assert sorted((r["partition"], r["offset"]) for r in got.collect()) == [(p, o) for p in (0, 1) for o in range(5)]

    for i in range(4):
        held = deliver(range(10 * i, 10 * i + 10), within="1 second", into="-short")[-1].stateOperators[0].numRowsTotal
        time.sleep(1.5)
    assert held <= 40 and spark.read.parquet(f"{dst}-short").count() == 80
    batch = spark.createDataFrame([("t", 0, 1), ("t", 0, 1), ("t", 1, 1), (None, 1, 1)], "topic string, partition int, offset int")
    assert ingest.once_each(batch).count() == 3


def test_consume_once_skip_empty_and_run_log(spark, tmp_dir):
    log, hist, ck, runs = f"{tmp_dir}/changes", f"{tmp_dir}/history", f"{tmp_dir}/ck", f"{tmp_dir}/runs"
    s = "order_id int, customer string, amount int, status string"
    before = spark.createDataFrame([(1, "Ava", 100, "NEW"), (2, "Liam", 200, "NEW")], s)
    after = spark.createDataFrame([(1, "Ava", 100, "SHIPPED"), (3, "Mia", 300, "NEW")], s)
    inc.publish_changes(ch.change_feed(before, after, ["order_id"]), log)
    schema = spark.read.parquet(log).schema
    inc.consume(spark, log, schema, ck, inc.append_history(hist), run_log=runs, name="consume")
    h = spark.read.parquet(hist)
    assert sorted((r["order_id"], r["change_type"]) for r in h.collect()) == [
        (1, "DELETE"), (1, "UPDATE"), (2, "DELETE"), (3, "INSERT")]
    # nothing new: the step does not run, and says so in the run log
    inc.consume(spark, log, schema, ck, inc.append_history(hist), run_log=runs, name="consume")
    assert spark.read.parquet(hist).count() == 4
    states = sorted(r["state"] for r in runlog.read_runs(spark, runs).collect())
    assert states == ["SKIPPED", "SUCCEEDED"]
    # a plain read of the log does not drain it for the consumer
    assert spark.read.parquet(log).count() == 4


def test_streaming_aggregate_exactly_once(spark, tmp_dir):
    s = "order_id int, customer string, amount int"
    base = spark.createDataFrame([(1, "Ava", 100), (4, "Noah", 400)], s)
    state_root = f"{tmp_dir}/agg"
    state = DeltaAggregate(state_root, ("customer",), ("amount",))
    state.start(base)
    nxt = base.unionByName(spark.createDataFrame([(7, "Ava", 150), (8, "Ivy", 700)], s))
    log = f"{tmp_dir}/changes"
    inc.publish_changes(ch.change_feed(base, nxt, ["order_id"]), log)
    fn = inc.maintain_aggregate(state_root, ["customer"], ["amount"])
    inc.consume(spark, log, spark.read.parquet(log).schema, f"{tmp_dir}/ck", fn)
    got = {r["customer"]: (r["row_count"], r["sum_amount"]) for r in state.read(spark).collect()}
    assert got == {"Ava": (2, 250), "Ivy": (1, 700), "Noah": (1, 400)}
    # a replay of an applied batch id is a no-op
    fn(spark.read.parquet(log), 0)
    again = {r["customer"]: (r["row_count"], r["sum_amount"])
             for r in state.read(spark).collect()}
    assert again == got


def test_ticket_chain(spark, tmp_dir):
    """Raw (JSON, lineage) -> clean (typed, NULL ids out) -> enriched
    -> served (masked), each layer from the one before."""
    from cairn.functions import scalars
    from cairn.operators import policies as pol
    from cairn.operators import text as tx
    lines = [
        '{"ticket_id": 1, "customer_name": "Ava", "customer_email": "ava@shop.com", "product": "Laptop", '
        '"region": "east", "channel": "email", "created_at": "2026-07-01 09:00:00", '
        '"message": "The package was damaged and I am not happy"}',
        '{"ticket_id": 2, "customer_name": "Liam", "customer_email": "liam@shop.com", "product": "Desk", '
        '"region": "west", "channel": "chat", "created_at": "2026-07-01 10:00:00", '
        '"message": "Thanks, great service"}',
        '{"customer_name": "NoId", "message": "missing id"}',
        '{"ticket_id": null, "customer_name": "NullId", "message": "null id"}',
    ]
    _write(f"{tmp_dir}/stage/tickets.json", "\n".join(lines) + "\n")
    raw_q = ingest.json_variant_stream(spark, f"{tmp_dir}/stage")
    ingest.stream_to_table(raw_q, f"{tmp_dir}/raw", f"{tmp_dir}/ck", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/raw").count() == 4

    raw = spark.read.parquet(f"{tmp_dir}/raw").select(F.to_json("raw").alias("raw"))
    raw = raw.withColumn("line", F.xxhash64("raw"))

    def clean(df):
        r = F.parse_json("raw")
        return (df.filter(js.get(r, "$.ticket_id", "variant").isNotNull())
                  .select("line", js.get(r, "$.ticket_id", "int").alias("ticket_id"),
                          js.get(r, "$.customer_email", "string").alias("customer_email"),
                          F.upper(js.get(r, "$.region", "string")).alias("region"),
                          js.get(r, "$.created_at", "timestamp_ntz").alias("created_at"),
                          js.get(r, "$.message", "string").alias("message")))

    def enriched(df):
        c = tx.with_sentiment(tx.with_tokens(df, "message"), "_tok")
        return tx.with_label(c, "_tok", tx.CATEGORIES, "category").drop("_tok")

    def served(df):
        e = df.withColumn("priority", scalars.priority_band(F.col("sentiment_score")))
        mask = pol.MaskingPolicy(scalars.mask_email_local, ("ACCOUNTADMIN",))
        return pol.apply_policies(e, "ANALYST", masks={"customer_email": mask})

    source = Source(f"{tmp_dir}/source", ("line",))
    source.log.publish(ch.as_inserts(raw, ["line"]))
    layer = Layer("clean", tmp_dir, source, clean, buckets=4)
    layer = Layer("enriched", tmp_dir, layer, enriched, buckets=4)
    layer = Layer("served", tmp_dir, layer, served, buckets=4)
    layer.refresh(spark, run_log=f"{tmp_dir}/runs")
    out = {r["ticket_id"]: r for r in layer.read(spark).collect()}
    # the JSON null id is kept by IS NOT NULL on the variant path (as in the
    # source), the missing id is not
    assert set(out) == {1, 2, None}
    assert out[1]["customer_email"] == "****@shop.com" and out[1]["region"] == "EAST"
    assert out[1]["priority"] == "HIGH" and out[1]["category"] == "shipping damage"
    assert out[2]["priority"] == "LOW"
    assert runlog.read_runs(spark, f"{tmp_dir}/runs").count() == 3


def test_run_log_schema(spark, tmp_dir):
    runlog.log_run(spark, f"{tmp_dir}/r", "task", "SUCCEEDED", "FULL", 3)
    r = runlog.read_runs(spark, f"{tmp_dir}/r").first()
    assert (r["name"], r["state"], r["rows"]) == ("task", "SUCCEEDED", 3)
    assert isinstance(runlog.RUN_LOG_SCHEMA, T.StructType)


def test_enrichment_kept_incrementally(spark, tmp_dir):
    """Only new or changed messages are scored; deleted ones leave."""
    from cairn.operators import text as tx
    s = "message_id int, raw_text string"
    v0 = spark.createDataFrame([(1, "great service thanks"), (2, "my package is late"), (3, "no idea")], s)
    v1 = spark.createDataFrame([(1, "great service thanks"), (2, "package is late and damaged, not happy"),
                                (4, "love it")], s)
    empty = spark.createDataFrame([], s)
    log, target = f"{tmp_dir}/changes", f"{tmp_dir}/enriched"

    def enrich(df):
        batch_tag = F.lit(enrich.calls)
        enrich.calls += 1
        d = tx.with_sentiment(tx.with_tokens(df, "raw_text"), "_tok").drop("_tok")
        return d.withColumn("scored_in", batch_tag)
    enrich.calls = 0

    fn = inc.maintain_enriched(target, ["message_id"], enrich)
    inc.publish_changes(ch.change_feed(empty, v0, ["message_id"]), log)
    schema = spark.read.parquet(log).schema
    inc.consume(spark, log, schema, f"{tmp_dir}/ck", fn)
    inc.publish_changes(ch.change_feed(v0, v1, ["message_id"]), log)
    inc.consume(spark, log, schema, f"{tmp_dir}/ck", fn)
    table = KeyedTable(target, ("message_id",))
    out = {r["message_id"]: r for r in table.read(spark).collect()}
    assert sorted(out) == [1, 2, 4]
    assert out[1]["scored_in"] == 0                       # unchanged: not rescored
    assert out[2]["scored_in"] == 1 and out[4]["scored_in"] == 1
    assert out[2]["sentiment_score"] < 0 and out[4]["sentiment_score"] > 0
    # a replay of the last batch changes nothing, not even a file
    stored = _files(table.data)
    fn(spark.read.parquet(log), 1)
    assert _files(table.data) == stored and enrich.calls == 2


def test_feeds_of_one_time_apply_in_sequence(spark, tmp_dir):
    """An insert and its delete that are stamped alike: the later feed wins."""
    log, target = f"{tmp_dir}/changes", f"{tmp_dir}/enriched"
    one, none = spark.createDataFrame([(1, "a")], "id int, t string"), spark.createDataFrame([], "id int, t string")
    inc.publish_changes(ch.change_feed(none, one, ["id"]), log, sequence=1)
    inc.publish_changes(ch.change_feed(one, none, ["id"]), log, sequence=2)
    both = spark.read.parquet(log).withColumn("changed_at", F.lit("2026-01-01").cast("timestamp_ntz"))
    inc.maintain_enriched(target, ["id"], lambda df: df)(both, 0)
    assert KeyedTable(target, ("id",)).read(spark).count() == 0


def test_run_log_is_complete_over_many_batches(spark, tmp_dir):
    """A row per micro-batch, however few of them Spark remembers."""
    log, runs = f"{tmp_dir}/changes", f"{tmp_dir}/runs"
    for i in range(6):
        spark.range(i, i + 1).selectExpr("id", "'INSERT' AS action").coalesce(1).write.mode("append").parquet(log)
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        inc.consume(spark, log, spark.read.parquet(log).schema, f"{tmp_dir}/ck", lambda b, i: None, run_log=runs, max_files=1)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    rows = runlog.read_runs(spark, runs).collect()
    assert sorted(r["batch_id"] for r in rows) == list(range(6)) and {r["state"] for r in rows} == {"SUCCEEDED"}
