"""Hand-made edge rows for the batch operators."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import clock, people
from orderloom.functions.money import cents, from_cents, prorate
from orderloom.operators import brand, cdc, dashboard, dau, dims, logs, orders, search, split, wide
from orderloom.schemas import (
    BRAND_AMOUNT,
    CATEGORY3,
    DETAIL_SOURCE,
    MONEY,
    ORDER_SOURCE,
    PROVINCE,
    SKU_INFO,
    SPU_INFO,
    TRADEMARK,
    USER_INFO,
    USER_SOURCE,
    USER_STATE,
)

NOON = datetime(2021, 5, 21, 12)


def rows(spark, schema, *values):
    """Frame of ``schema`` from dicts; absent fields are null."""
    return spark.createDataFrame([tuple(v.get(f.name) for f in schema) for v in values], schema)


def order(ident, user=1, moment=NOON, final="10.00", original="30.00", province=1):
    return dict(
        id=ident,
        user_id=user,
        province_id=province,
        create_time=moment,
        final_total_amount=Decimal(final),
        original_total_amount=Decimal(original),
    )


def line(ident, order_id, price="10.00", num=1, sku=1):
    return dict(id=ident, order_id=order_id, sku_id=sku, order_price=Decimal(price), sku_num=num, create_time=NOON)


def messages(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset long")


def shares(spark, order_row, *lines_, scale=2):
    timed = orders.with_time_fields(rows(spark, ORDER_SOURCE, order_row))
    details = rows(spark, DETAIL_SOURCE, *lines_)
    summed = orders.without_labels(wide.attach_sums(timed, details, scale))
    result = wide.order_wide(summed, orders.without_product(details), scale)
    return [str(r[0]) for r in result.orderBy("order_detail_id").select("final_detail_amount").collect()]


# --- orders -------------------------------------------------------------------------------------


def test_missing_dimensions_keep_the_row(spark):
    order_rows = orders.with_time_fields(rows(spark, ORDER_SOURCE, order(1, user=7, province=99)))
    enriched = orders.enrich_orders(order_rows, rows(spark, PROVINCE), rows(spark, USER_INFO)).first()
    assert (enriched.id, enriched.province_name, enriched.user_gender) == (1, None, None)
    product = dims.product(rows(spark, SKU_INFO), rows(spark, SPU_INFO), rows(spark, TRADEMARK), rows(spark, CATEGORY3))
    detail = orders.enrich_details(rows(spark, DETAIL_SOURCE, line(1, 1, sku=5)), product).first()
    assert (detail.spu_id, detail.tm_id, detail.category3_id, detail.tm_name) == (0, 0, 0, None)


def test_known_buyer_is_not_first(spark):
    state = rows(spark, USER_STATE, dict(user_id="1", if_consumed="1"))
    flagged = orders.first_order_flag(rows(spark, ORDER_SOURCE, order(1), order(2, user=2)), state)
    assert {r.id: r.if_first_order for r in flagged.collect()} == {1: "0", 2: "1"}
    assert [tuple(r) for r in orders.new_buyers(flagged).collect()] == [("2", "1")]


def test_lower_id_wins_a_tie(spark):
    later = datetime(2021, 5, 21, 13)
    batch = rows(spark, ORDER_SOURCE, order(9), order(3), order(1, moment=later))
    flagged = orders.first_order_flag(batch)
    assert {r.id: r.if_first_order for r in flagged.collect()} == {9: "0", 3: "1", 1: "0"}


def test_three_equal_lines(spark):
    assert shares(spark, order(1), line(1, 1), line(2, 1), line(3, 1)) == ["3.33", "3.33", "3.34"]


def test_one_line_takes_all(spark):
    assert shares(spark, order(1, final="4.00", original="5.00"), line(1, 1, "5.00")) == ["4.00"]


def test_zero_original(spark):
    assert shares(spark, order(1, final="0.00", original="0.00"), line(1, 1, "0.00")) == ["0.00"]


def test_whole_units(spark):
    assert shares(spark, order(1), line(1, 1), line(2, 1), line(3, 1), scale=0) == ["3.00", "3.00", "4.00"]


@pytest.mark.parametrize(
    "total, base, part, expected",
    [
        ("0.01", "2.00", "1.00", "0.01"),  # half a cent goes up
        ("-0.01", "2.00", "1.00", "-0.01"),
        ("-1.00", "3.00", "1.00", "-0.33"),
        ("9999999999999999.99", "9999999999999999.98", "9999999999999999.98", "9999999999999999.99"),
        ("5000000000.01", "3.00", "1.00", "1666666666.67"),
        ("1.00", "0.00", "1.00", "0.00"),
    ],
)
def test_prorate_is_exact(spark, total, base, part, expected):
    amounts = [cents(F.lit(Decimal(v)).cast(MONEY)) for v in (total, base, part)]
    assert str(spark.range(1).select(from_cents(prorate(*amounts))).first()[0]) == expected


def test_copies_give_one_wide_row(spark):
    twice = orders.with_time_fields(rows(spark, ORDER_SOURCE, order(1), order(1)))
    details = rows(spark, DETAIL_SOURCE, line(1, 1), line(1, 1), line(2, 1))
    once = wide.dedup_sources(twice, details)
    assert [f.count() for f in once] == [1, 2]


def test_wide_dedup_by_order_and_seen(spark):
    timed = orders.without_labels(orders.with_time_fields(rows(spark, ORDER_SOURCE, order(1), order(2))))
    details = orders.without_product(rows(spark, DETAIL_SOURCE, line(1, 1), line(2, 1), line(3, 2)))
    lines = wide.join_orders(timed, details)
    assert [r[0] for r in wide.dedup_wide(lines, "order_id").orderBy("order_id").select("order_detail_id").collect()] == [1, 3]
    seen = lines.where("order_detail_id = 3").select("order_detail_id")
    assert wide.dedup_wide(lines.union(lines), seen=seen).count() == 2


def test_arrivals_are_split_once(spark):
    timed = orders.without_labels(orders.with_time_fields(rows(spark, ORDER_SOURCE, order(1), order(2, final="4.00", original="5.00"))))
    schema = "dt string, order_id long, origin_cents long, split_cents long"
    first = wide.join_orders(
        timed,
        orders.without_product(rows(spark, DETAIL_SOURCE, line(1, 1), line(3, 1), line(4, 2, "5.00"))),
    )
    parts, running = split.split_arrivals(first, spark.createDataFrame([], schema))
    assert [str(r[0]) for r in parts.orderBy("order_detail_id").select("final_detail_amount").collect()] == ["3.33", "3.33", "4.00"]
    assert [tuple(r) for r in running.collect()] == [("2021-05-21", 1, 2000, 666)]
    second = wide.join_orders(timed, orders.without_product(rows(spark, DETAIL_SOURCE, line(2, 1))))
    parts, running = split.split_arrivals(second, running)
    assert [str(r[0]) for r in parts.select("final_detail_amount").collect()] == ["3.34"]
    assert [tuple(r)[1:] for r in running.collect()] == [(1, 3000, 1000)]


# --- change events and logs ---------------------------------------------------------------------


def test_snapshot_markers_and_broken_messages(spark):
    events = messages(
        spark,
        '{"table":"t","type":"bootstrap-start","data":{}}',
        '{"table":"t","type":"bootstrap-insert","data":{"id":1}}',
        '{"table":"t","type":"bootstrap-complete","data":{}}',
        '{"id":',
    )
    kept = cdc.route(cdc.unwrap_object(events)).collect()
    assert [(r.topic, r.value) for r in kept] == [("ODS_T", '{"id":1}')]
    assert [r.value for r in cdc.rejects(events).collect()] == ['{"id":']


def test_array_envelope_sizes(spark):
    events = messages(
        spark,
        '{"table":"t","data":[]}',
        '{"table":"t","data":[{"id":1}]}',
        '{"table":"t","data":[{"id":2},{"id":"3"},{"id":4}]}',
    )
    unwrapped = cdc.unwrap_array(events).groupBy("offset").count().collect()
    assert {r.offset: r["count"] for r in unwrapped} == {1: 1, 2: 3}


def test_typed_rows_take_quoted_numbers_and_absent_fields(spark):
    events = messages(spark, '{"table":"order_info","type":"insert","data":{"id":"7","final_total_amount":"1.50"}}')
    row = cdc.table_rows(cdc.unwrap_object(events), "order_info").first()
    assert (row.id, row.final_total_amount, row.user_id) == (7, Decimal("1.50"), None)


def test_log_routing_and_key(spark):
    logs_ = messages(
        spark,
        '{"start":{"entry":"icon"},"common":{"mid":"m1"},"ts":1}',
        '{"start":"","mid":"m2","ts":1}',
        '{"mid":"m3","ts":1}',
    )
    routed = logs.route(logs_).orderBy("key").collect()
    assert [(r.key, r.topic) for r in routed] == [("m1", "START_LOG"), ("m2", "EVENT_LOG"), ("m3", "EVENT_LOG")]


def launch(mid, moment):
    return f'{{"start":"x","common":{{"mid":"{mid}"}},"ts":{int(moment.timestamp() * 1000)}}}'


def test_devices_once_a_day_and_around_midnight(spark):
    from datetime import timezone

    at = lambda *t: datetime(*t, tzinfo=timezone.utc)
    raw = messages(
        spark,
        launch("a", at(2021, 5, 21, 9)),
        launch("a", at(2021, 5, 21, 8)),
        launch("b", at(2021, 5, 21, 23, 59, 59)),
        launch("b", at(2021, 5, 22, 0, 0, 0)),
    )
    firsts = dau.first_launches(logs.launches(raw)).orderBy("dt", "mid").collect()
    assert [(r.dt, r.mid, r.hr, r.mi) for r in firsts] == [
        ("2021-05-21", "a", "08", "00"),
        ("2021-05-21", "b", "23", "00"),
        ("2021-05-22", "b", "00", "00"),
    ]


def test_hour_gaps_are_zero(spark):
    counts = spark.createDataFrame([("03", 5), ("17", 2)], "hr string, n long")
    dense = dau.dense_hours(counts).collect()
    assert len(dense) == 24 and sum(r.n == 0 for r in dense) == 22


def test_bad_date_is_an_error():
    assert clock.previous_day("2021-03-01") == "2021-02-28"
    with pytest.raises(ValueError):
        clock.previous_day("2021-02-30")


# --- dimensions and dashboard -------------------------------------------------------------------


def test_age_bands_and_gender(spark):
    ages = (17, 18, 45, 46, 69, 70)
    users = [dict(id=a, birthday=f"{2021 - a}-12-31 00:00:00", gender="F" if a % 2 else "M") for a in ages]
    found = dims.user_info(rows(spark, USER_SOURCE, *users, dict(id=0, birthday="2000-01-01")), 2021).orderBy("id").collect()
    assert [r.user_age_group for r in found[1:]] == ["0-17岁", "18-45岁", "18-45岁", "46-69岁", "46-69岁", "70岁及以上"]
    assert [r.gender_name for r in found] == ["男", "女", "男", "女", "男", "女", "男"]
    bands = spark.createDataFrame([(a,) for a in (19, 20, 30, 31)], "age int").select(people.chart_age_band(F.col("age")))
    assert [r[0] for r in bands.collect()] == ["20岁以下", "20-30岁", "20-30岁", "30岁以上"]


def test_brand_names_and_open_range(spark):
    day = lambda d: datetime(2021, 5, d)
    amounts = rows(
        spark,
        BRAND_AMOUNT,
        *[dict(stat_time=day(d), tm_id=1, tm_name="A:B", amount=Decimal("1.00")) for d in (1, 2, 3)],
    )
    assert [tuple(r) for r in brand.totals(amounts, day(1), day(3)).collect()] == [(1, "A:B", Decimal("1.00"))]


def test_brand_tie_goes_to_lower_id(spark):
    totals = spark.createDataFrame([(2, "b", 5), (1, "a", 5), (3, "c", 9)], "tm_id long, tm_name string, sum_amount long")
    assert [r.tm_id for r in brand.top_n(totals, 2).collect()] == [3, 1]


def test_province_levels(spark):
    sold = spark.createDataFrame(
        [("a", Decimal("99.99")), ("b", Decimal("100.00")), ("c", Decimal("900.00"))], "province_name string, final_detail_amount decimal(18,2)"
    )
    assert {r.province_name: r.level for r in dashboard.province_sales(sold).collect()} == {"a": 0, "b": 1, "c": 5}


def test_search_matches_whole_words_and_exact_members(spark):
    docs = spark.createDataFrame(
        [
            (1, "Lantern by the Sea", [("mira vale",)], 8.5),
            (2, "lanterns", [("mira vale",)], 9.0),
            (3, "a LANTERN!", [("mira",)], 9.0),
            (4, "lantern north", [("tov",), ("mira vale",)], 8.0),
        ],
        "id long, name string, members array<struct<name string>>, score double",
    )
    found = search.search(docs, "lantern", "mira vale").collect()
    assert [(r.id, r.name, r.members[-1].name) for r in found] == [(1, "Lantern by the Sea", "mira vale"), (4, "lantern north", "mira vale")]
    assert [r.id for r in search.search(docs, "lantern", "mira vale", start=1).collect()] == [4]
