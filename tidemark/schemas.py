"""Record schemas: one flat StructType per input record, given explicitly to every reader."""

from pyspark.sql import types as T

# Input records (timestamps are epoch seconds unless noted).
USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

LOGIN = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("login_state", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

ORDER = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("tx_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

RECEIPT = T.StructType([
    T.StructField("tx_id", T.StringType()),
    T.StructField("pay_channel", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# Marketing events carry epoch milliseconds.
MARKETING = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# Parsed access-log line; timestamp in epoch milliseconds.
ACCESS_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])

BY_NAME = {
    "behavior": USER_BEHAVIOR,
    "ad_click": AD_CLICK,
    "login": LOGIN,
    "order": ORDER,
    "receipt": RECEIPT,
    "marketing": MARKETING,
}
