"""What the load of a larger table rests on: cheap checkpoints, few state groups, one parse, narrow shuffles."""

import os
from datetime import date, timedelta

from pyspark.sql import functions as F

from orderloom.functions.text import typed_rows
from orderloom.operators import orders, wide
from orderloom.operators.keyed import earliest, latest
from orderloom.schemas import BRAND_AMOUNT, COUNTED_LINE, ORDER_DETAIL_WIDE
from orderloom.session import checkpoint_settings, settings, work_dir
from orderloom.sources import topics
from orderloom.sources.colocated import Colocated
from orderloom.sources.tables import BatchTable, KeyedTable
from orderloom.streaming import jobs, stateful
from tests.test_scale import skewed_shop

MANAGER = "spark.sql.streaming.checkpointFileManagerClass"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_streams_on_local_folders_rename_without_processes(spark):
    root = work_dir(spark, "load")
    assert checkpoint_settings(spark, root)[MANAGER].endswith("FileSystemBasedCheckpointFileManager")
    with settings(spark, {MANAGER: "chosen"}):
        assert checkpoint_settings(spark, root) == {}
    assert spark.conf.get(MANAGER, None) is None
    spark.range(3).write.parquet(f"{root}/in")
    seen = []
    stream = spark.readStream.schema("id long").parquet(f"{root}/in")
    handler = lambda batch, _: seen.append((batch.sparkSession.conf.get(MANAGER, None), batch.count()))
    jobs.start(stream, handler, f"{root}/checkpoint", jobs.DRAIN).awaitTermination()
    assert seen == [(checkpoint_settings(spark, root)[MANAGER], 3)]
    assert spark.conf.get(MANAGER, None) is None


def test_rows_that_only_pass_share_few_groups(spark):
    rows = spark.range(50_000).select(F.col("id").alias("order_id"), F.expr("cast(id % 2 - 1 as int)").alias("lane"))
    groups = rows.withColumn("state_key", stateful._grouped(F.col("order_id"), F.col("lane"))).select("state_key", "lane").distinct()
    counts = {r.lane: r["count"] for r in groups.groupBy("lane").count().collect()}
    assert counts == {-1: 25_000, 0: 256}


def test_an_order_over_all_columns_travels_once(spark):
    rows = spark.createDataFrame([(1, 5, None), (1, 5, "a"), (1, None, "z"), (2, 3, "b"), (2, 3, "b"), (None, 1, "c")], "k long, a long, b string")
    first, last = earliest(rows, ["k"], ["a", "b"]), latest(rows, ["k"], ["a", "b"])
    assert "min_by" not in plan(first) and "max_by" not in plan(last)
    key = lambda r: (r.k is None, r.k or 0)
    assert [tuple(r) for r in sorted(first.collect(), key=key)] == [(1, None, "z"), (2, 3, "b"), (None, 1, "c")]
    assert [tuple(r) for r in sorted(last.collect(), key=key)] == [(1, 5, "a"), (2, 3, "b"), (None, 1, "c")]
    # Another column order and an order that leaves a column out.
    assert sorted(tuple(r) for r in earliest(rows.where("k = 1"), ["k"], ["b", "a"]).collect()) == [(1, 5, None)]
    assert earliest(rows.where("k = 2"), ["k"], ["a"]).collect()[0] == (2, 3, "b")


def test_lines_are_shuffled_once_into_their_buckets(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(Colocated, "_store", lambda self, rows, key, table: stored.append(rows))
    order_rows, details = skewed_shop(spark, 300)
    details = orders.without_product(details)
    summed = orders.without_labels(wide.attach_sums(order_rows, details))
    names = spark.createDataFrame([(1, "x"), (2, "y")], "sku_id long, label string")
    named = details.join(F.broadcast(names), "sku_id", "left")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        Colocated("unused", "unused", buckets=4, hot_lines=50).write(summed, named, details)
        text = plan(stored[1])
    # Joined where they are; only the count per order is exchanged, and it does not join the names.
    assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastNestedLoopJoin") == 1


def files_below(root, ending):
    return [os.path.join(folder, name) for folder, _, names in os.walk(root) for name in names if name.endswith(ending)]


def test_a_batch_writes_a_file_a_day_and_cuts_a_hot_day(spark):
    """F1 to F4, F6, F7: the handler of a batch is adaptive even if its stream keeps state, so days are dealt out before they are written."""
    root = work_dir(spark, "days")
    first = date(2021, 1, 1)
    days = spark.range(3000).select(F.date_add(F.lit(first), (F.col("id") % 300).cast("int")).cast("string").alias("dt"), F.col("id").alias("n"))
    days.repartition(6).write.json(f"{root}/in")
    table = BatchTable(f"{root}/out", days.schema, ["dt"], sort_by=["n"])
    adaptive = []

    def handler(batch, batch_id):
        adaptive.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        table.write(batch, batch_id)

    stream = spark.readStream.schema(days.schema).json(f"{root}/in").dropDuplicates(["n"])
    jobs.start(stream, handler, f"{root}/checkpoint", jobs.DRAIN).awaitTermination()
    assert adaptive == ["true"]
    assert len(files_below(f"{root}/out", ".parquet")) == 300
    assert sorted(map(tuple, table.rows(spark).select("dt", "n").collect())) == sorted(map(tuple, days.collect()))
    hot = spark.range(40_000).select(F.lit(str(first + timedelta(days=1))).alias("dt"), F.xxhash64("id").alias("n"))
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}):
        BatchTable(f"{root}/hot", days.schema, ["dt"]).write(hot.repartition(6), 0)
    assert len(files_below(f"{root}/hot", ".parquet")) > 1


def test_wide_messages_are_parsed_once_for_the_columns_in_use(spark, monkeypatch):
    """rejects, ids and sums come from one kept parse of six columns; copies count once."""
    root = work_dir(spark, "brands")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in ORDER_DETAIL_WIDE}
    given = {
        "dt": F.lit("2021-05-21"), "order_id": F.col("id") % 10, "order_detail_id": F.col("id") % 40, "tm_id": F.lit(7).cast("long"),
        "tm_name": F.lit("A:B"), "final_detail_amount": F.lit("1.25").cast("decimal(18,2)"),
    }
    lines = spark.range(80).select(*[value.alias(name) for name, value in (blank | given).items()])
    broken = spark.createDataFrame([(None, "{", "W"), (None, None, "W")], "key string, value string, topic string")
    topics.write_files(topics.as_messages(lines, "W", "order_id").union(broken), f"{root}/topic", 0)
    parsed = []

    def recorded(df, schema, value="value"):
        parsed.append(set(schema.fieldNames()))
        return typed_rows(df, schema, value)

    monkeypatch.setattr(jobs, "typed_rows", recorded)
    sums = BatchTable(f"{root}/sums", BRAND_AMOUNT)
    counted = KeyedTable(f"{root}/lines", COUNTED_LINE, jobs.LINE_KEY, partition_by=["dt"])
    messages = topics.read_files(spark, f"{root}/topic")
    jobs.sum_brands(messages, sums, counted, f"{root}/reject", f"{root}/checkpoint", trigger=jobs.DRAIN).awaitTermination()
    assert parsed == [{*jobs.LINE_KEY, "tm_id", "tm_name", "final_detail_amount"}]
    assert [(r.tm_id, r.tm_name, float(r.amount)) for r in sums.rows(spark).collect()] == [(7, "A:B", 50.0)]
    assert counted.current(spark).count() == 40
    rejected = spark.read.option("recursiveFileLookup", "true").json(f"{root}/reject", schema="value string, topic string, offset long")
    assert sorted((r.value or "", r.topic, r.offset) for r in rejected.collect()) == [("", "W", 0), ("{", "W", 0)]


def test_topics_are_packed(spark):
    """a topic of like messages takes a fraction of their length, read by the same readers."""
    root = work_dir(spark, "packed")
    rows = spark.range(20_000).select("id", F.lit("a name that is the same in all").alias("name"))
    messages = topics.as_messages(rows, "T", "id")
    length = messages.agg(F.sum(F.length("value"))).first()[0]
    for split in (False, True):
        topics.write_files(messages, f"{root}/{split}", 0, split)
        assert not files_below(f"{root}/{split}", ".json")
        assert 0 < sum(map(os.path.getsize, files_below(f"{root}/{split}", ".json.gz"))) * 4 < length
        read = spark.read.option("recursiveFileLookup", "true").json(f"{root}/{split}", schema="key string, value string")
        assert read.distinct().count() == 20_000 and read.where("value like '%the same in all%'").count() == 20_000


def test_a_join_keeps_one_store_a_partition_and_ended_queries_close_theirs(spark):
    """each store sets disk aside for its manifest."""
    root = work_dir(spark, "stores")
    spark.range(10).select("id", F.lit("2021-05-21 12:00:00").cast("timestamp").alias("at")).write.json(f"{root}/in")
    side = lambda: spark.readStream.schema("id long, at timestamp").json(f"{root}/in").withWatermark("at", "10 seconds")
    joined = side().alias("a").join(side().alias("b"), F.expr("a.id = b.id AND a.at = b.at")).select("a.id")
    before = spark.conf.get("spark.sql.streaming.join.stateFormatVersion")
    with stateful.disk_state(spark), settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        writer = joined.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(**jobs.DRAIN).start().awaitTermination()
    assert spark.conf.get("spark.sql.streaming.join.stateFormatVersion") == before
    assert spark.read.parquet(f"{root}/out").count() == 10
    stores = {os.path.dirname(f) for f in files_below(f"{root}/checkpoint/state", ".changelog")}
    assert len(stores) == 2
