"""Record types of SURVEY §1 as Spark schemas (after parsing)."""

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


L, S, TS = LongType(), StringType(), TimestampType()

USER_BEHAVIOR = _s(("user_id", L), ("item_id", L), ("category_id", L), ("behavior", S), ("ts", TS))
WEB_LOG = _s(("ip", S), ("user_id", S), ("ts", TS), ("method", S), ("url", S))
AD_CLICK = _s(("user_id", L), ("ad_id", L), ("province", S), ("city", S), ("ts", TS))
LOGIN = _s(("user_id", L), ("ip", S), ("event_type", S), ("ts", TS))
ORDER_EVENT = _s(("order_id", L), ("event_type", S), ("tx_id", S), ("ts", TS))
RECEIPT = _s(("tx_id", S), ("pay_channel", S), ("ts", TS))
MARKETING = _s(("user_id", S), ("behavior", S), ("channel", S), ("ts", TS))

# Outputs
WINDOW_COUNT = _s(("window_start", TS), ("window_end", TS), ("key", S), ("cnt", L))
BLACKLIST_WARNING = _s(("user_id", L), ("ad_id", L), ("ts", TS), ("msg", S))
LOGIN_WARNING = _s(("user_id", L), ("first_ts", TS), ("last_ts", TS), ("msg", S))
ORDER_RESULT = _s(("order_id", L), ("outcome", S))
