"""Streaming jobs: independence from the cut, replay, late pairs, fresh dimensions, reject folders."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.functions.text import record_json
from orderloom.operators import brand, cdc, dashboard, dau
from orderloom.plans.stream_queries import Pipeline, change_messages, drain, feed
from orderloom.plans.warehouse import Warehouse
from orderloom.schemas import DETAIL_SOURCE, ORDER_DETAIL_WIDE, ORDER_INFO, PROVINCE, USER_STATE
from orderloom.session import work_dir
from orderloom.sources import jdbc, topics
from orderloom.sources.mapping import Shop
from orderloom.sources.tables import BatchTable, KeyedTable
from orderloom.streaming import jobs, progress

SF_DIR = "/root/testdata/sf0.001"
NOON = datetime(2021, 5, 21, 12)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def pipeline(spark):
    shop = Shop(spark, SF_DIR)
    return Pipeline(shop, Warehouse(shop))


def days(*numbers):
    return [f"2024-01-{n:02d}" for n in numbers]


@pytest.mark.parametrize("bounds", [[], days(10, 20), days(4, 8, 12, 16, 20, 24)], ids=["1", "3", "7"])
def test_devices_do_not_depend_on_the_cut(spark, pipeline, bounds):
    pipeline.feed_logs(pipeline.route_logs, pipeline.count_devices, bounds=bounds)
    got = {(r.dt, r.mid): (r.ts, r.hr) for r in pipeline.dau.current(spark).collect()}
    want = pipeline.shop.launches.groupBy("dt", "mid").agg(F.min(F.struct("ts", "hr")).alias("first"))
    assert got == {(r.dt, r.mid): tuple(r.first) for r in want.collect()}


def test_late_launch_corrects_the_hour(spark, pipeline):
    early, late = F.col("timestamp") < "2024-01-15 06:00:00", F.col("timestamp") >= "2024-01-15 06:00:00"
    day = F.to_date("timestamp") == "2024-01-15"
    for part in (late, early):
        feed(pipeline.shop.app_log.where(day & part), pipeline.path("APP_LOG"))
        drain(pipeline.route_logs, pipeline.count_devices)
    want = pipeline.shop.launches.where("dt = '2024-01-15'").groupBy("mid").agg(F.min("ts").alias("ts"))
    got = pipeline.dau.current(spark)
    assert {tuple(r) for r in got.select("mid", "ts").collect()} == {tuple(r) for r in want.collect()}


def test_first_days_with_late_launches(spark, pipeline):
    """Whatever the order of days, each device is new on its first day only, and a day is read from its own partition."""
    p = pipeline
    launches = p.shop.launches
    for day in ("2024-01-12", "2024-01-09", "2024-01-15", "2024-01-03"):
        feed(p.shop.app_log.where(F.to_date("timestamp") == day), p.path("APP_LOG"))
        drain(p.route_logs, p.count_devices)
    seen = launches.where(F.col("dt").isin("2024-01-12", "2024-01-09", "2024-01-15", "2024-01-03"))
    new = {r.dt: r.n for r in seen.groupBy("mid").agg(F.min("dt").alias("dt")).groupBy("dt").agg(F.count("*").alias("n")).collect()}
    active = {r.dt: r.n for r in seen.groupBy("dt").agg(F.countDistinct("mid").alias("n")).collect()}
    assert any(r.moved for r in p.first_days.current(spark).collect())
    for day in active:
        figures = p.day_figures(day)
        assert {r.id: r.value for r in figures.collect()} == {"dau": active[day], "new_mid": new.get(day, 0)}
        plan = figures._jdf.queryExecution().executedPlan().toString()
        scans = [line.partition("PartitionFilters")[2] for line in plan.splitlines() if "PartitionFilters" in line]
        assert scans and all(day in s for s in scans)


def forget_last_commit(pipeline, name):
    """Make the next start run the last batch again, as after a crash between output and commit."""
    folder = f"{pipeline.root}/checkpoint/{name}/commits"
    last = max(int(f) for f in os.listdir(folder) if f.isdigit())
    for leftover in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{folder}/{leftover}"):
            os.remove(f"{folder}/{leftover}")
    return last


def content(df):
    return sorted(map(str, df.collect()))


def test_replayed_batches_change_nothing(spark, pipeline):
    p = pipeline
    p.load_dimensions()
    p.feed_orders((p.publish_orders, p.publish_details), p.publish_wide, p.sum_brands)
    state = content(p.state.current(spark))
    wide, brands = content(p.wide.rows(spark)), content(p.brands.rows(spark).drop("stat_time"))
    assert len(wide) == 6000
    for name, job in (("wide", p.publish_wide), ("orders", p.publish_orders), ("brands", p.sum_brands)):
        forget_last_commit(p, name)
        drain(job)
    drain(p.sum_brands)  # what the replayed wide batch sent again
    assert content(p.state.current(spark)) == state
    assert content(p.wide.rows(spark)) == wide
    assert content(p.brands.rows(spark).drop("stat_time")) == brands


def test_replayed_brand_batch_is_not_added_twice(spark, pipeline):
    p = pipeline
    rows = p.warehouse.plain_wide(p.warehouse.details).where("order_id < 50")
    messages = topics.as_messages(rows.drop("line_amount"), "ADS_ORDER_WIDE", "order_id")
    topics.write_files(messages, p.path("ADS_ORDER_WIDE"), 0)
    drain(p.sum_brands)
    once = content(p.brands.rows(spark).drop("stat_time"))
    forget_last_commit(p, "brands")
    drain(p.sum_brands)
    assert once and content(p.brands.rows(spark).drop("stat_time")) == once


def wide_messages(spark, order_times, line_offsets):
    orders_ = spark.createDataFrame([(i, t) for i, t in order_times], "id long, create_time timestamp")
    orders_ = orders_.withColumns({f.name: F.lit(None).cast(f.dataType) for f in ORDER_INFO if f.name not in ("id", "create_time")})
    lines = spark.createDataFrame(
        [(n, 1, NOON + timedelta(seconds=s)) for n, s in line_offsets], "id long, order_id long, create_time timestamp"
    ).withColumns({f.name: F.lit(None).cast(f.dataType) for f in DETAIL_SOURCE if f.name not in ("id", "order_id", "create_time")})
    return topics.as_messages(orders_, "o", "id"), topics.as_messages(lines, "d", "order_id")


def test_pairs_beyond_the_bound_and_copies(spark, pipeline):
    order_rows, lines = wide_messages(spark, [(1, NOON), (1, NOON)], [(1, 9), (2, 11), (3, -10), (3, -10)])
    feed(order_rows, pipeline.path("DWD_ORDER_INFO"))
    feed(lines, pipeline.path("DWD_ORDER_DETAIL"))
    drain(lambda: pipeline.to_table("joined", pipeline.joined()))
    assert sorted(r.order_detail_id for r in pipeline.result("joined").collect()) == [1, 3]


def test_dimensions_are_read_in_every_batch(spark, pipeline):
    p = pipeline
    names = lambda: {
        r.id: r.name
        for r in spark.read.option("recursiveFileLookup", "true")
        .json(p.path("DWD_ORDER_INFO"), schema="value string")
        .select(F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.province_name").alias("name"))
        .collect()
    }
    orders_ = spark.createDataFrame([(1, 1, NOON)], "id long, province_id long, create_time timestamp")
    for number, label in ((1, "old"), (2, "new")):
        dim = spark.createDataFrame([(1, label, 1, "a", "b")], PROVINCE)
        p.dimensions.province.write(dim, number)
        feed(change_messages(orders_.withColumn("id", F.lit(number).cast("long")), "order_info"), p.path("order_info"))
        drain(p.publish_orders)
    assert names() == {"1": "old", "2": "new"}


def test_unreadable_messages_are_set_aside(spark, pipeline):
    p = pipeline
    good = '{"table":"base_trademark","type":"insert","data":{"tm_id":1,"tm_name":"A:B"}}'
    no_key = '{"table":"base_trademark","type":"insert","data":{"tm_id":"x","tm_name":"?"}}'
    raw = spark.createDataFrame([(v, i) for i, v in enumerate([good, no_key, '{"table":'])], "value string, offset long")
    feed(raw, p.path("base_trademark"))
    drain(
        lambda: jobs.route_changes(
            topics.read_files(spark, p.path("base_trademark")),
            topics.to_files(p.path("ods"), split_by_topic=True),
            p.rejected("changes"),
            p._checkpoint("ods"),
            trigger=jobs.DRAIN,
        ),
        lambda: p.keep_dimension("base_trademark", p.dimensions.trademark),
    )
    assert [tuple(r) for r in p.dimensions.trademark.current(spark).collect()] == [(1, "A:B")]
    read = lambda name: spark.read.json(f"{p.root}/reject/{name}", schema="value string").collect()
    assert [r.value for r in read("changes")] == ['{"table":']
    own = spark.read.option("recursiveFileLookup", "true").json(p.rejected("base_trademark"), schema="value string").collect()
    assert sorted(json.loads(r.value)["tm_id"] if '"tm_id"' in r.value else r.value for r in own) == ["x", '{"table":']
    own_topic = topics.read_files(spark, topics.topic_path(p.path("ods"), "ODS_BASE_TRADEMARK"))
    assert own_topic.isStreaming
    rows = spark.read.option("recursiveFileLookup", "true").json(p.path("ods"), schema="value string, offset long")
    typed = cdc.table_rows(jobs.ods_rows(rows, "base_trademark"), "base_trademark")
    assert {(r.tm_id, r.tm_name) for r in typed.collect()} == {(1, "A:B"), (None, "?")}


def test_keyed_table_before_and_compaction(spark):
    table = KeyedTable(f"{work_dir(spark, 'keyed')}/state", USER_STATE, ["user_id"])
    frame = lambda *rows: spark.createDataFrame(list(rows), USER_STATE)
    current = lambda **kw: {r.user_id: r.if_consumed for r in table.current(spark, **kw).collect()}
    assert current() == {}
    table.write(frame(("1", "a"), ("2", "a")), 0)
    table.write(frame(("1", "b")), 1)
    assert current() == {"1": "b", "2": "a"} and current(before=1) == {"1": "a", "2": "a"}
    table.compact(spark, before=1)
    assert current() == {"1": "b", "2": "a"}
    table.write(frame(("1", "c")), 1)  # the same batch again
    table.write(frame(("3", "c")), 2)
    table.compact(spark, before=2)
    assert current() == {"1": "c", "2": "a", "3": "c"}
    assert current(where=F.col("user_id") == "1") == {"1": "c"}


def test_positions_and_start_policy(spark):
    messages = spark.createDataFrame([("t", 0, 4), ("t", 0, 9), ("t", 1, 2)], "topic string, partition int, offset long")
    table = progress.ledger(f"{work_dir(spark, 'ledger')}/progress")
    assert topics.starting_offsets(table.current(spark), "g", "t") == "latest"
    table.write(progress.positions(messages, "g"), 0)
    stored = topics.starting_offsets(table.current(spark), "g", "t")
    assert json.loads(stored) == {"t": {"0": 10, "1": 3}}
    every = json.loads(topics.starting_offsets(table.current(spark), "g", "t", partitions=range(4)))
    assert every == {"t": {"0": 10, "1": 3, "2": topics.EARLIEST, "3": topics.EARLIEST}}
    options = topics.kafka_options("host:1", "t", group="g", starting=stored, max_per_trigger=5)
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "t",
        "startingOffsets": stored,
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "5",
    }


def test_kafka_rows_become_messages(spark):
    raw = spark.sql("SELECT CAST('k' AS BINARY) key, CAST('v' AS BINARY) value, 't' topic, 1 partition, 2L offset, TIMESTAMP'2021-01-01' timestamp")
    row = topics.from_kafka(raw).first()
    assert (row.key, row.value, row.partition, row.offset) == ("k", "v", 1, 2)


def test_jdbc_options():
    assert jdbc.query_options("jdbc:x", "d.Driver", "select 1") == {"url": "jdbc:x", "driver": "d.Driver", "query": "select 1"}
    assert jdbc.APPEND_OPTIONS == {"batchsize": "100", "isolationLevel": "NONE", "numPartitions": "4"}


def test_record_json_time_format(spark):
    frame = spark.createDataFrame([(1, NOON)], "id long, create_time timestamp")
    assert frame.select(record_json(frame)).first()[0] == '{"id":1,"create_time":"2021-05-21 12:00:00"}'


def test_work_dir_follows_the_session(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_orders_begun_in_the_first_batch_of_the_state_store(spark, pipeline):
    from orderloom.streaming import stateful

    def line(number, order=1, at=NOON, paid="10.00", original="30.00"):
        return (order, number, at, paid, original, "10.00")

    schema = "order_id long, order_detail_id long, create_time timestamp, final_total_amount decimal(18,2), original_total_amount decimal(18,2), line_amount decimal(18,2)"
    text = schema.replace("decimal(18,2)", "string")
    source = f"{pipeline.root}/lines"

    def run(horizon, name):
        rows = spark.readStream.schema(schema).parquet(source).withWatermark("create_time", "10 seconds")
        drain(lambda: pipeline.to_table(name, stateful.split_lines(rows, horizon_hours=horizon)))

    batches = ([line(1)], [line(5, 2, NOON + timedelta(hours=2), "7.00", "10.00")], [line(2), line(3)])
    for batch in batches:
        frame = spark.createDataFrame(batch, text)
        frame.select(*[F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], schema).schema]).coalesce(1).write.mode("append").parquet(source)
        run(None, "never")
    parts = {r.order_detail_id: str(r.final_detail_amount) for r in pipeline.result("never").collect()}
    assert parts == {1: "3.33", 2: "3.33", 3: "3.34", 5: "7.00"}
    run(48, "late")  # a horizon counts from the order's own time, not from the epoch watermark
    parts = {r.order_detail_id: str(r.final_detail_amount) for r in pipeline.result("late").collect()}
    assert parts == {1: "3.33", 2: "3.33", 3: "3.34", 5: "7.00"}


def test_hot_order_in_the_state_store_is_spread(spark, pipeline):
    """An order with a third of the lines: the shares of the batch split, from several tasks, over two batches."""
    from orderloom.operators import split
    from orderloom.streaming import stateful

    lines = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700 + 1).alias("order_id"),
        F.col("id").alias("order_detail_id"),
        F.lit(NOON).alias("create_time"),
        (F.col("id") % 97 + 1).cast("decimal(18,2)").alias("line_amount"),
    )
    sums = lines.groupBy("order_id").agg(F.sum("line_amount").cast("decimal(18,2)").alias("original_total_amount"))
    lines = lines.join(sums, "order_id").withColumn("final_total_amount", (F.col("original_total_amount") * F.lit("0.77").cast("decimal(18,2)")).cast("decimal(18,2)"))
    source = f"{pipeline.root}/hot"
    for part in (F.col("order_detail_id") < 5000, F.col("order_detail_id") >= 5000):
        lines.where(part).repartition(3).write.mode("append").parquet(source)
        rows = spark.readStream.schema(lines.schema).parquet(source).withWatermark("create_time", "10 seconds")
        drain(lambda: pipeline.to_table("spread", stateful.split_lines(rows).withColumn("task", F.spark_partition_id())))
    got = pipeline.result("spread")
    assert got.where("order_id = 0").select("task").distinct().count() == 2  # all there are in this test
    parts = {r.order_detail_id: r.final_detail_amount for r in got.collect()}
    paid = {r.order_id: r.final_total_amount for r in lines.select("order_id", "final_total_amount").distinct().collect()}
    last, given, count = {}, dict.fromkeys(paid, 0), 0
    for r in split.with_share(lines, 2).select("order_id", "order_detail_id", "_share").collect():
        count += 1
        last[r.order_id] = max(last.get(r.order_id, -1), r.order_detail_id)
        given[r.order_id] += parts[r.order_detail_id]
    assert count == len(parts) == 9000 and given == paid
    for r in split.with_share(lines, 2).select("order_id", "order_detail_id", "_share").collect():
        if r.order_detail_id != last[r.order_id]:
            assert int(parts[r.order_detail_id] * 100) == r._share


def test_replayed_wide_batch_leaves_brand_sums(spark, pipeline):
    p = pipeline
    rows = p.warehouse.plain_wide(p.warehouse.details).where("order_id < 50").drop("line_amount")
    messages = topics.as_messages(rows, "ADS_ORDER_WIDE", "order_id")
    topics.write_files(messages, p.path("ADS_ORDER_WIDE"), 0)
    drain(p.sum_brands)
    once = content(brand.totals(p.brands.rows(spark)))
    topics.write_files(messages, p.path("ADS_ORDER_WIDE"), 0)  # the same batch under new file names
    topics.write_files(messages.limit(5), p.path("ADS_ORDER_WIDE"), 1)  # and lines sent again later
    drain(p.sum_brands)
    assert once and content(brand.totals(p.brands.rows(spark))) == once


def test_fact_jobs_account_for_every_row(spark, pipeline):
    p = pipeline
    value = lambda table, **data: json.dumps({"table": table, "type": "insert", "data": data})
    good = dict(id=1, province_id=1, user_id=2, create_time="2021-05-21 12:00:00")
    lines = dict(id=1, order_id=1, sku_id=1, create_time="2021-05-21 12:00:00")
    order_rows = [value("order_info", **good), value("order_info", **{**good, "id": "x"}), value("order_info", **{**good, "id": 3, "create_time": "soon"})]
    order_rows += ['{"table":"order_info","data":"text"}', "{"]
    detail_rows = [value("order_detail", **lines), value("order_detail", **{**lines, "id": 2, "order_id": None}), value("order_detail", **{**lines, "id": 3, "create_time": None})]
    sent = []
    for name, rows, job in (("order_info", order_rows, p.publish_orders), ("order_detail", detail_rows, p.publish_details)):
        raw = spark.createDataFrame([(v, name.upper(), 0, i) for i, v in enumerate(rows)], "value string, topic string, partition int, offset long")
        feed(raw, p.path(name))
        drain(lambda: job(send=lambda messages, batch_id: sent.extend(messages.collect())))
        rejects = spark.read.option("recursiveFileLookup", "true").json(p.rejected(name), schema="value string").count()
        assert len(rows) == rejects + sum(r.topic == f"DWD_{name.upper()}" for r in sent)
    assert [(r.key, r.topic, json.loads(r.value)["id"]) for r in sent] == [("1", "DWD_ORDER_INFO", 1), ("1", "DWD_ORDER_DETAIL", 1)]
    assert {(r.group_id, r.topic, r.partition_id, r.topic_offset) for r in p.positions("order_info", "order_detail").collect()} == {
        ("order_info", "ORDER_INFO", 0, 5),
        ("order_detail", "ORDER_DETAIL", 0, 3),
    }


def test_array_envelopes_account_for_every_message(spark):
    rows = ['{"table":"t","data":[{"a":1},{"a":2}]}', '{"table":"t","data":[]}', '{"table":"t","data":{"a":1}}', '{"table":"t","data":"x"}', '{"table":"t","data":[{"a":1},null]}', '{"table":"t","data":[1]}', "{"]
    frame = spark.createDataFrame([(r,) for r in rows], "value string")
    assert [r.value for r in cdc.unwrap_array(frame).collect()] == ['{"a":1}', '{"a":2}']
    assert sorted(r.value for r in cdc.rejects(frame, "array").collect()) == sorted(rows[2:])


def test_state_is_read_by_key_and_stays_compact(spark):
    table = KeyedTable(f"{work_dir(spark, 'bounded')}/state", USER_STATE, ["user_id"])
    for batch in range(40):
        table.compact_every(spark, batch, 5)
        table.write(spark.createDataFrame([(str(batch % 7), str(batch)), ("k", "v")], USER_STATE), batch)
    folders = lambda kind: [f for f in os.listdir(f"{table.path}/{kind}") if "=" in f]
    assert len(folders("changes")) <= 10 and len(folders("base")) <= 2
    assert {r.user_id: r.if_consumed for r in table.current(spark).collect()} == {"k": "v"} | {str(b % 7): str(b) for b in range(40)}
    asked = table.current(spark, keys=spark.createDataFrame([("3",), ("3",), ("none",)], "user_id string"))
    assert [(r.user_id, r.if_consumed) for r in asked.collect()] == [("3", "38")]
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # the restriction lies below the choice of winners


def test_days_prune_the_kept_tables(spark, pipeline):
    pipeline.feed_logs(pipeline.route_logs, pipeline.count_devices)
    day = pipeline.dau.current(spark, where=F.col("dt") == "2024-01-15")
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all("2024-01-15" in line.partition("PartitionFilters")[2] for line in filters)


# --- positions and commits ----------------------------------------------------------------------


def some_wide(p, condition):
    return topics.as_messages(p.warehouse.plain_wide(p.warehouse.details).where(condition).drop("line_amount"), "ADS_ORDER_WIDE", "order_id")


def seen_by_readers(p, spark):
    sums = sorted((r.tm_id, r.sum_amount) for r in brand.totals(p.brands.rows(spark)).collect())
    reached = [r.topic_offset for r in p.ledger("brands").table.current(spark).collect()]
    return sums, reached, p.counted.current(spark).count()


@pytest.mark.parametrize("where", ["record", "mark", "sums"])
def test_sums_and_positions_appear_together(spark, pipeline, monkeypatch, where):
    """A batch that breaks off anywhere between its writes shows nothing; run again, it shows once."""
    from orderloom.sources.tables import BatchTable, Commits

    p = pipeline
    topics.write_files(some_wide(p, "order_id < 30"), p.path("ADS_ORDER_WIDE"), 0)
    drain(p.sum_brands)
    first = seen_by_readers(p, spark)
    assert first[0] and first[1] == [1] and first[2] > 0
    topics.write_files(some_wide(p, "order_id BETWEEN 20 AND 60"), p.path("ADS_ORDER_WIDE"), 1)

    def broken(*_):
        raise RuntimeError("broken off")

    with monkeypatch.context() as patch:
        if where == "sums":
            whole = BatchTable.write
            patch.setattr(BatchTable, "write", lambda self, rows, n: whole(self, rows, n) if "brand_lines" in self.path else broken())
        else:
            patch.setattr(*{"record": (jobs.Ledger, "record"), "mark": (Commits, "mark")}[where], broken)
        with pytest.raises(Exception, match="broken off"):
            drain(p.sum_brands)
        assert seen_by_readers(p, spark) == first
    drain(p.sum_brands)
    want = brand.totals(brand.batch_sums(p.warehouse.plain_wide(p.warehouse.details).where("order_id <= 60"), F.current_timestamp()))
    sums, reached, lines = seen_by_readers(p, spark)
    assert sums == sorted((r.tm_id, r.sum_amount) for r in want.collect())
    assert reached == [2] and lines == p.warehouse.details.where("order_id <= 60").count()


def test_jobs_go_on_without_their_checkpoints(spark, pipeline):
    """The joined stream and the brand job, restarted from the ledger alone, lose and repeat nothing."""
    p = pipeline.listen()
    p.load_dimensions()
    orders, details = p.shop.order_source, p.shop.detail_events
    try:
        for early in (True, False):
            part = (F.col("create_time") < "1997-03-01") == F.lit(early)
            feed(change_messages(orders.where(part), "order_info"), p.path("order_info"))
            feed(change_messages(details.where(part), "order_detail"), p.path("order_detail"))
            read = []

            def begin(job):
                running = job(resume=not early)
                running.awaitTermination()
                read.append(sum(r.numInputRows for r in running.recentProgress))
                return running

            drain((p.publish_orders, p.publish_details), lambda: begin(p.publish_wide), lambda: begin(p.sum_brands))
            if early:
                positions = {(r.group_id, r.topic): r.topic_offset for r in p.positions("wide", "brands").collect()}
                assert positions == {("wide", "DWD_ORDER_INFO"): 1, ("wide", "DWD_ORDER_DETAIL"): 1, ("brands", "ADS_ORDER_WIDE"): 1}
    finally:
        p.stop_listening()
    assert p.wide.rows(spark).count() == 6000 and p.counted.current(spark).count() == 6000
    assert p.wide.rows(spark).select("order_id", "order_detail_id").distinct().count() == 6000
    whole = brand.totals(p.wide.rows(spark).select("tm_id", "tm_name", F.col("final_detail_amount").alias("amount")))
    assert content(brand.totals(p.brands.rows(spark))) == content(whole)


def test_positions_of_a_progress_report():
    from types import SimpleNamespace

    from pyspark.sql import Row

    kafka = SimpleNamespace(endOffset='{"orders":{"0":12,"1":7},"lines":{"0":3}}')
    files = SimpleNamespace(endOffset='{"logOffset":4}')
    empty = SimpleNamespace(endOffset=None)
    seen = {"position of T": Row(**{"0": 5, "1": None}), "other": Row(n=1)}
    report = SimpleNamespace(sources=[kafka, files, empty], observedMetrics=seen)
    assert sorted(progress.reached(report, "g")) == [("g", "T", 0, 5), ("g", "lines", 0, 3), ("g", "orders", 0, 12), ("g", "orders", 1, 7)]


def test_unreadable_wide_messages_and_launches(spark, pipeline):
    p = pipeline
    good = some_wide(p, "order_id < 10")
    odd = spark.createDataFrame([(None, v, "ADS_ORDER_WIDE") for v in ("{", '{"dt":"2021-05-21"}', '{"dt":"x","order_id":1,"order_detail_id":2}')], good.schema)
    topics.write_files(good.union(odd), p.path("ADS_ORDER_WIDE"), 0)
    drain(p.sum_brands)
    assert brand.totals(p.brands.rows(spark)).where("tm_id is null").count() == 0
    read = lambda name: spark.read.option("recursiveFileLookup", "true").json(p.rejected(name), schema="value string")
    assert read("brands").count() == 3 and p.counted.current(spark).count() == good.count()
    day = p.shop.app_log.where(F.to_date("timestamp") == "2024-01-15")
    bad = [None, '{"start":{"a":1},"ts":"5"}', "APP_LOG", 0, 10**6, None], [None, '{"start":{"a":1},"mid":"m","ts":"soon"}', "APP_LOG", 0, 10**6 + 1, None]
    feed(day.union(spark.createDataFrame(bad, day.schema)), p.path("APP_LOG"))
    drain(p.route_logs, p.count_devices)
    assert read("launches").count() == 2


# --- compaction ---------------------------------------------------------------------------------


def files_of(table, day):
    return {
        os.path.join(folder, name)
        for folder, _, names in os.walk(f"{table.path}/base")
        for name in names
        if name.endswith(".parquet") and f"dt={day}" in folder
    }


def counted_table(spark, name):
    from orderloom.schemas import COUNTED_LINE

    table = KeyedTable(f"{work_dir(spark, name)}/lines", COUNTED_LINE, jobs.LINE_KEY, partition_by=["dt"])
    write = lambda n, *rows: table.write(spark.createDataFrame([(f"2021-05-{d:02d}", o, i) for d, o, i in rows], COUNTED_LINE), n)
    return table, write, lambda **kw: sorted((r.dt[-2:], r.order_id, r.order_detail_id) for r in table.current(spark, **kw).collect())


def test_compaction_leaves_untouched_days(spark):
    table, write, rows = counted_table(spark, "touched")
    write(0, (1, 1, 1), (2, 1, 2))
    write(1, (2, 2, 3))
    table.compact(spark, 2)
    first, second = files_of(table, "2021-05-01"), files_of(table, "2021-05-02")
    assert first and second
    write(2, (2, 2, 3), (2, 5, 9), (3, 3, 4))
    everything = rows()
    table.compact(spark, 3)
    assert rows() == everything == [("01", 1, 1), ("02", 1, 2), ("02", 2, 3), ("02", 5, 9), ("03", 3, 4)]
    assert files_of(table, "2021-05-01") == first  # not written again
    assert files_of(table, "2021-05-02") > second  # the old one stays for readers that began with it
    write(3, (3, 3, 5))
    table.compact(spark, 4)
    assert files_of(table, "2021-05-01") == first and not files_of(table, "2021-05-02") & second
    assert rows() == everything + [("03", 3, 5)]
    assert rows(where=F.col("dt") == "2021-05-02") == [r for r in everything if r[0] == "02"]


def test_compaction_by_batches_and_days(spark):
    """Many batches with a bound on days: no more folders than the bound asks for, the newest days whole."""
    table, write, rows = counted_table(spark, "days")
    for n in range(24):
        table.compact_every(spark, n, 4, keep_days=5)
        write(n, (1 + n, n, n), (max(1, n), n, -n))
    table.compact(spark, 24)
    assert {r for r in rows() if r[0] >= "18"} == {(f"{1 + n:02d}", n, n) for n in range(17, 24)} | {(f"{n:02d}", n, -n) for n in range(18, 24)}
    kept = {name for _, folders, _ in os.walk(f"{table.path}/base") for name in folders if name.startswith("dt=")}
    assert len(kept) < 16 and min(kept) > "dt=2021-05-05"


def test_commits(spark):
    from orderloom.sources.tables import BatchTable, Commits

    base = work_dir(spark, "commits")
    commits = Commits(f"{base}/commits")
    table = BatchTable(f"{base}/rows", USER_STATE, commits=commits)
    assert commits.last(spark) == -1 and table.next_batch(spark) == 0
    for n in range(4):
        table.write(spark.createDataFrame([(str(n), "x")], USER_STATE), n)
        assert table.rows(spark).count() == n
        commits.mark(spark, n)
        assert (commits.last(spark), table.rows(spark).count(), table.next_batch(spark)) == (n, n + 1, n + 1)
    assert table.rows(spark, before=2).count() == 2
    assert len([f for f in os.listdir(commits.path) if "=" in f]) <= 2


def test_joined_and_late_lines_are_all_lines(spark, pipeline):
    """A line is given out once, with its order or, after the watermark has passed it, without."""
    p = pipeline
    noon = F.lit(NOON)
    orders_ = p.shop.order_source.orderBy("id").limit(6).withColumns({"create_time": noon, "id": F.row_number().over(Window.orderBy("id")).cast("long")})
    line = p.shop.detail_events.limit(1)
    lines = line.drop("id", "order_id", "create_time").crossJoin(
        spark.createDataFrame([(n, n % 10, NOON + timedelta(seconds=n % 4)) for n in range(1, 41)], "id long, order_id long, create_time timestamp")
    ).select(*line.columns)
    stages = ((p.publish_orders, p.publish_details), lambda: p.publish_wide(unmatched=True))
    p.feed_pair(orders_.where("id <= 3"), lines.where("id <= 30"))
    drain(*stages)
    assert p.late_lines().count() == 0  # the watermark has not passed them: their orders may still come
    p.feed_pair(orders_.where("id > 3"), lines.where("id > 25"))  # five lines come twice
    drain(*stages)
    p.close_orders()
    drain(*stages)
    joined = {r.order_detail_id: r.order_id for r in p.wide.rows(spark).where("order_id > 0").collect()}
    late = [(r.order_detail_id, r.order_id) for r in p.late_lines().collect()]
    assert sorted(joined) + sorted(n for n, _ in late) == sorted(joined) + [n for n in range(1, 41) if n not in joined]
    assert set(joined.values()) == {1, 2, 3, 4, 5, 6} and {o for _, o in late} == {0, 7, 8, 9}
    assert len(joined) == 24 and len(late) == 16


def test_buyers_expire_in_the_state_store_and_hot_users_are_spread(spark, pipeline):
    from orderloom.streaming import stateful

    root = work_dir(spark, "buyers")
    schema = "id long, user_id long, create_time timestamp"
    order = lambda n, user: (n, user, NOON + timedelta(seconds=n))

    def run(name, batches, pause=0, **options):
        for k, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/{name}")
            stream = spark.readStream.schema(schema).parquet(f"{root}/{name}")
            flags = stateful.first_orders(stream, **options).withColumn("task", F.spark_partition_id())
            drain(lambda: pipeline.to_table(name, flags))
            time.sleep(pause if k + 1 < len(batches) else 0)
        return pipeline.result(name)

    twice = [[order(2, 1), order(1, 1), order(3, None)], [order(4, 1), order(5, None), order(6, 2)]]
    flag = lambda df: {r.id: r.if_first_order for r in df.collect()}
    assert flag(run("kept", twice)) == {1: "1", 2: "0", 3: "1", 4: "0", 5: "0", 6: "1"}
    # Batches without data would keep a draining query alive for ever.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        lapsed = run("lapsed", twice, pause=3, ttl_seconds=2)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert flag(lapsed) == {1: "1", 2: "0", 3: "1", 4: "1", 5: "1", 6: "1"}
    hot = run("hot", [[order(n, 7) for n in range(400)]])
    assert [r.id for r in hot.where("if_first_order = '1'").collect()] == [0] and hot.count() == 400
    assert hot.select("task").distinct().count() > 1


def test_day_sketches_merge_and_survive_replays(spark):
    """A month merged from its days stays within three standard errors, and a day counted again changes nothing."""
    launches = spark.range(60_000).select(
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 30 + 1).cast("string"), 2, "0")).alias("dt"),
        F.xxhash64(F.col("id") % 23_000).cast("string").alias("mid"),
    )
    days_ = dau.day_sketches(launches).persist()
    again = dau.day_sketches(launches.where("dt < '2024-01-10'"), days_)
    estimate = lambda df: dau.sketched_devices(dau.merge_sketches(df)).first().devices
    bound = 3 * 1.04 / 2 ** (dau.SKETCH_BITS / 2)
    assert abs(estimate(days_) - 23_000) <= bound * 23_000
    assert days_.count() == 30 and again.count() == 30
    assert estimate(again) == estimate(days_)
    assert dau.day_sketches(launches.limit(0)).count() == 0


def test_later_pages_read_no_more_than_the_first(spark):
    """Seek paging walks all lines in order, and the bound reaches the scan of files sorted by line."""
    table = BatchTable(f"{work_dir(spark, 'pages')}/wide", ORDER_DETAIL_WIDE, ["dt"], sort_by=["order_detail_id"])
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in ORDER_DETAIL_WIDE if f.name not in ("order_detail_id", "dt", "sku_name")]
    lines = spark.range(5000).select(
        (F.col("id") * 7919 % 5000).alias("order_detail_id"), F.lit("2024-01-01").alias("dt"), F.lit("lamp").alias("sku_name"), *blank
    )
    before = spark.sparkContext._jsc.hadoopConfiguration().get("parquet.block.size")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "4096")
    try:
        table.write(lines.coalesce(1), 0)
    finally:
        config = spark.sparkContext._jsc.hadoopConfiguration()
        config.unset("parquet.block.size") if before is None else config.set("parquet.block.size", before)
    page = lambda after: dashboard.page_after(table.rows(spark), "2024-01-01", "lamp", after, 500)
    walked, after = [], None
    while found := [r.order_detail_id for r in page(after).collect()]:
        walked, after = walked + found, found[-1]
    assert walked == list(range(5000))

    def scanned(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()

    assert "GreaterThan(order_detail_id,4400)" in page(4400)._jdf.queryExecution().executedPlan().toString()
    assert scanned(page(4400)) <= scanned(page(None))


def test_backlog_is_worked_off_in_bounded_batches(spark, pipeline):
    """Six files wait; with two files a trigger the change jobs take three batches, and the tables are those of one big batch."""
    shop = pipeline.shop
    bounded = Pipeline(shop, pipeline.warehouse, max_files=2)
    some = F.col("create_time") < "1998-01-01"
    for p in (pipeline, bounded):
        p.load_dimensions()
        for rows, name in ((shop.order_source, "order_info"), (shop.detail_events, "order_detail")):
            for low, high in zip(halves, halves[1:]):
                span = (F.col("create_time") >= low) & (F.col("create_time") < high)
                feed(change_messages(rows.where(some & span), name).coalesce(1), p.path(name))
    batches = {}
    for p in (pipeline, bounded):
        for job in (p.publish_orders, p.publish_details):
            running = job()
            running.awaitTermination()
            batches[p.max_files, job.__name__] = [r.numInputRows for r in running.recentProgress if r.numInputRows]
        drain(p.publish_wide, p.sum_brands)
    assert [len(batches[None, job]) for job in ("publish_orders", "publish_details")] == [1, 1]
    for job in ("publish_orders", "publish_details"):
        assert len(batches[2, job]) == 3 and max(batches[2, job]) < sum(batches[2, job]) / 2
        assert sum(batches[2, job]) == sum(batches[None, job])
    assert content(bounded.state.current(spark)) == content(pipeline.state.current(spark))
    lines = [content(p.wide.rows(spark).drop("batch_id")) for p in (pipeline, bounded)]
    assert lines[0] and lines[0] == lines[1]
    totals = [content(brand.totals(p.brands.rows(spark)).select("tm_id", "sum_amount")) for p in (pipeline, bounded)]
    assert totals[0] == totals[1]


halves = ["1995-01-01", "1995-07-01", "1996-01-01", "1996-07-01", "1997-01-01", "1997-07-01", "1998-01-01"]


def test_writes_side_by_side_all_end_before_an_error_shows(spark):
    done = []

    def broken():
        raise RuntimeError("broken off")

    def slow():
        time.sleep(0.5)
        done.append(spark.range(3).count())

    with pytest.raises(RuntimeError, match="broken off"):
        jobs.together(spark, broken, slow)
    assert done == [3]
