"""Column layouts per layer. Money is decimal(18,2); ids are long throughout."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
_LONG, _TEXT, _TIME, _DOUBLE = T.LongType(), T.StringType(), T.TimestampType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One message of a topic, whichever connector delivers it.
MESSAGE = _struct(
    key=_TEXT, value=_TEXT, topic=_TEXT, partition=T.IntegerType(), offset=_LONG, timestamp=_TIME
)

ORDER_SOURCE = _struct(
    id=_LONG,
    province_id=_LONG,
    order_status=_TEXT,
    user_id=_LONG,
    final_total_amount=MONEY,
    benefit_reduce_amount=MONEY,
    original_total_amount=MONEY,
    feight_fee=MONEY,
    expire_time=_TIME,
    create_time=_TIME,
    operate_time=_TIME,
)

ORDER_INFO = T.StructType(
    ORDER_SOURCE.fields
    + _struct(
        create_date=_TEXT,
        create_hour=_TEXT,
        if_first_order=_TEXT,
        province_name=_TEXT,
        province_area_code=_TEXT,
        province_iso_code=_TEXT,
        user_age_group=_TEXT,
        user_gender=_TEXT,
    ).fields
)

DETAIL_SOURCE = _struct(
    id=_LONG,
    order_id=_LONG,
    sku_id=_LONG,
    order_price=MONEY,
    sku_num=_LONG,
    sku_name=_TEXT,
    create_time=_TIME,
)

# A source may state the line amount; where it does not, it is price times quantity.
LINE_AMOUNT = _struct(line_amount=MONEY)

ORDER_DETAIL = T.StructType(
    DETAIL_SOURCE.fields
    + _struct(
        spu_id=_LONG,
        tm_id=_LONG,
        category3_id=_LONG,
        spu_name=_TEXT,
        tm_name=_TEXT,
        category3_nam=_TEXT,
    ).fields
)

ORDER_DETAIL_WIDE = _struct(
    order_detail_id=_LONG,
    order_id=_LONG,
    order_status=_TEXT,
    create_time=_TIME,
    user_id=_LONG,
    sku_id=_LONG,
    sku_price=MONEY,
    sku_num=_LONG,
    sku_name=_TEXT,
    benefit_reduce_amount=MONEY,
    original_total_amount=MONEY,
    feight_fee=MONEY,
    final_total_amount=MONEY,
    final_detail_amount=MONEY,
    if_first_order=_TEXT,
    province_name=_TEXT,
    province_area_code=_TEXT,
    user_age_group=_TEXT,
    user_gender=_TEXT,
    dt=_TEXT,
    spu_id=_LONG,
    tm_id=_LONG,
    category3_id=_LONG,
    spu_name=_TEXT,
    tm_name=_TEXT,
    category3_name=_TEXT,
)

ORDER_SPLIT_STATE = _struct(dt=_TEXT, order_id=_LONG, origin_cents=_LONG, split_cents=_LONG)

# Lines whose amounts a brand sum already holds.
COUNTED_LINE = _struct(dt=_TEXT, order_id=_LONG, order_detail_id=_LONG)

DAU_INFO = _struct(
    mid=_TEXT, uid=_TEXT, ar=_TEXT, ch=_TEXT, vc=_TEXT, dt=_TEXT, hr=_TEXT, mi=_TEXT, ts=_LONG
)

# The devices of a day as a mergeable sketch.
DAY_SKETCH = _struct(dt=_TEXT, sketch=T.BinaryType())

# The first day of a device; ``moved`` marks a day that an earlier one has replaced.
FIRST_DAY = _struct(dt=_TEXT, mid=_TEXT, moved=T.BooleanType())

USER_SOURCE = _struct(id=_LONG, user_level=_TEXT, birthday=_TEXT, gender=_TEXT)
USER_INFO = T.StructType(USER_SOURCE.fields + _struct(user_age_group=_TEXT, gender_name=_TEXT).fields)

SKU_INFO = _struct(
    id=_LONG,
    spu_id=_LONG,
    price=MONEY,
    sku_name=_TEXT,
    sku_desc=_TEXT,
    weight=_DOUBLE,
    tm_id=_LONG,
    category3_id=_LONG,
    sku_default_img=_TEXT,
    create_time=_TIME,
)
SPU_INFO = _struct(id=_LONG, spu_name=_TEXT, description=_TEXT, category3_id=_LONG, tm_id=_LONG)
TRADEMARK = _struct(tm_id=_LONG, tm_name=_TEXT)
CATEGORY3 = _struct(id=_LONG, name=_TEXT, category2_id=_LONG)
PROVINCE = _struct(id=_LONG, name=_TEXT, region_id=_LONG, area_code=_TEXT, iso_code=_TEXT)

USER_STATE = _struct(user_id=_TEXT, if_consumed=_TEXT)
BRAND_AMOUNT = _struct(stat_time=_TIME, tm_id=_LONG, tm_name=_TEXT, amount=MONEY)
PROGRESS = _struct(group_id=_TEXT, topic=_TEXT, partition_id=T.IntegerType(), topic_offset=_LONG)

# Change-event table name -> layout of its rows, and the dimension key where it is one.
SOURCE_TABLES = {
    "order_info": ORDER_SOURCE,
    "order_detail": T.StructType(DETAIL_SOURCE.fields + LINE_AMOUNT.fields),
    "user_info": USER_SOURCE,
    "base_province": PROVINCE,
    "sku_info": SKU_INFO,
    "spu_info": SPU_INFO,
    "base_trademark": TRADEMARK,
    "base_category3": CATEGORY3,
}
DIMENSION_KEYS = {
    "user_info": "id",
    "base_province": "id",
    "sku_info": "id",
    "spu_info": "id",
    "base_trademark": "tm_id",
    "base_category3": "id",
}
