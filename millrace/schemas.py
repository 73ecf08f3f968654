"""Declared schemas. Nothing is inferred, on batch or on streams."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def plus(schema: StructType, **fields) -> StructType:
    """A new schema with more fields; ``StructType.add`` would change the old one."""
    return StructType([*schema.fields, *_struct(**fields).fields])


S, L, D = StringType(), LongType(), DoubleType()

# One message of a topic. A Kafka source yields these columns; file-backed
# sources keep the same ones, so every job runs unchanged on either.
MESSAGE = _struct(
    topic=S, partition=IntegerType(), offset=L, timestamp=TimestampType(), key=S, value=S
)

# Raw app log. The array of displays is called "display"; "actions" is plural.
APP_LOG = _struct(
    common=_struct(ar=S, uid=S, os=S, ch=S, is_new=S, md=S, mid=S, vc=S, ba=S),
    ts=L,
    page=_struct(
        page_id=S, item=S, item_type=S, during_time=L, last_page_id=S, source_type=S
    ),
    display=ArrayType(_struct(display_type=S, item=S, item_type=S, pos_id=S, order=S)),
    actions=ArrayType(_struct(action_id=S, item=S, item_type=S, ts=L)),
    start=_struct(entry=S, loading_time=L, open_ad_id=S, open_ad_ms=L, open_ad_skip_ms=L),
    err=S,
)

# Database change record; "data" stays JSON text until its table is known.
CHANGE = _struct(type=S, table=S, data=S)

_COMMON = dict(
    mid=S,
    user_id=S,
    province_id=S,
    channel=S,
    is_new=S,
    model=S,
    operate_system=S,
    version_code=S,
    brand=S,
)
_PAGE = dict(page_id=S, last_page_id=S, page_item=S, page_item_type=S, during_time=L, sourceType=S)

PAGE_LOG = _struct(**_COMMON, **_PAGE, ts=L)
DISPLAY_LOG = _struct(
    **_COMMON,
    **_PAGE,
    display_type=S,
    display_item=S,
    display_item_type=S,
    display_order=S,
    display_pos_id=S,
    ts=L,
)
ACTION_LOG = _struct(
    **_COMMON, **_PAGE, action_id=S, action_item=S, action_item_type=S, action_ts=L, ts=L
)
START_LOG = _struct(
    **_COMMON, entry=S, open_ad_id=S, loading_time_ms=L, open_ad_ms=L, open_ad_skip_ms=L, ts=L
)

USER_INFO = _struct(id=S, gender=S, birthday=S)
BASE_PROVINCE = _struct(id=S, name=S, iso_code=S, iso_3166_2=S, area_code=S)

DAU_INFO = _struct(
    **_COMMON,
    page_id=S,
    page_item=S,
    page_item_type=S,
    sourceType=S,
    during_time=L,
    user_gender=S,
    user_age=S,
    province_name=S,
    province_iso_code=S,
    province_3166_2=S,
    province_area_code=S,
    dt=S,
    hr=S,
    ts=L,
)

_HEADER_AMOUNTS = dict(
    total_amount=D,
    activity_reduce_amount=D,
    coupon_reduce_amount=D,
    original_total_amount=D,
    freight_fee=D,
    freight_fee_reduce=D,
)
_HEADER_TIMES = dict(expire_time=S, refundable_time=S, create_time=S, operate_time=S)

ORDER_INFO = _struct(
    id=L, province_id=S, order_status=S, user_id=S, **_HEADER_AMOUNTS, **_HEADER_TIMES
)
ORDER_DETAIL = _struct(
    id=L,
    order_id=L,
    sku_id=L,
    order_price=D,
    sku_num=L,
    sku_name=S,
    create_time=S,
    split_total_amount=D,
    split_activity_amount=D,
    split_coupon_amount=D,
)
ORDER_WIDE = _struct(
    detail_id=L,
    order_id=L,
    sku_id=L,
    order_price=D,
    sku_num=L,
    sku_name=S,
    split_total_amount=D,
    split_activity_amount=D,
    split_coupon_amount=D,
    province_id=S,
    order_status=S,
    user_id=S,
    **_HEADER_AMOUNTS,
    **_HEADER_TIMES,
    create_date=S,
    create_hour=S,
    province_name=S,
    province_area_code=S,
    province_3166_2_code=S,
    province_iso_code=S,
    user_age=S,
    user_gender=S,
)

# Stored dimension rows: every version that arrived, newest wins on read.
DIMENSION_ROW = _struct(
    table=S, id=S, op=S, data=S, timestamp=TimestampType(), partition=IntegerType(), offset=L
)

# The order wide table as stored: each row's day, and when its two sides arrived.
STORED_ORDER_WIDE = plus(
    ORDER_WIDE, header_at=TimestampType(), line_at=TimestampType(), dt=S
)
