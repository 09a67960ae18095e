"""Declared schemas. Money is decimal throughout, so sums are exact."""

from __future__ import annotations

from pyspark.sql import types as T

QUANTITY = T.DecimalType(18, 2)
PRICE = T.DecimalType(18, 4)
VALUE = T.DecimalType(18, 2)
TOTAL = T.DecimalType(28, 2)

TRADES = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("security_id", T.LongType()),
        T.StructField("trader_id", T.LongType()),
        T.StructField("trade_type", T.StringType()),
        T.StructField("quantity", QUANTITY),
        T.StructField("price", PRICE),
        T.StructField("last_modified_ts", T.TimestampNTZType()),
    ]
)

SILVER = T.StructType(
    [f for f in TRADES if f.name != "last_modified_ts"]
    + [
        T.StructField("trade_value", VALUE),
        T.StructField("silver_loaded_ts", T.TimestampNTZType()),
    ]
)

SECURITIES = T.StructType(
    [
        T.StructField("security_id", T.LongType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("security_name", T.StringType()),
        T.StructField("asset_class", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("currency", T.StringType()),
    ]
)

TRADERS = T.StructType(
    [
        T.StructField("trader_id", T.LongType()),
        T.StructField("trader_name", T.StringType()),
        T.StructField("desk", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

TRADER_SNAPSHOT = T.StructType(list(TRADERS) + [T.StructField("snapshot_date", T.DateType())])

AMENDMENTS = T.StructType(
    [f for f in TRADES if f.name != "last_modified_ts"]
    + [
        T.StructField("amendment_reason", T.StringType()),
        T.StructField("amendment_date", T.DateType()),
    ]
)

LOGINS = T.StructType(
    [T.StructField("trader_id", T.LongType()), T.StructField("login_name", T.StringType())]
)
