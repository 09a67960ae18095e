"""Small tables with known results."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

from ledgerlake import schemas

# fixed values: the ten-row seed, trader states and amendments whose results are known
SEED = [
    (100001, "2026-05-01", 1, 1, "BUY", "5000", "1550.25", "2026-05-01 10:12:00"),
    (100002, "2026-05-01", 2, 1, "SELL", "2000", "1625.50", "2026-05-01 11:05:00"),
    (100003, "2026-05-01", 3, 2, "BUY", "100000", "98.75", "2026-05-01 09:47:00"),
    (100004, "2026-05-04", 1, 1, "BUY", "1200", "1580.00", "2026-05-04 14:22:00"),
    (100005, "2026-05-04", 4, 3, "SELL", "800", "3450.10", "2026-05-04 15:01:00"),
    (100006, "2026-05-04", 2, 1, "SELL", "2000", "1625.50", "2026-05-04 11:06:00"),
    (100007, "2026-05-05", 5, 4, "BUY", "1500", "2870.40", "2026-05-05 09:58:00"),
    (100008, "2026-05-05", 6, 6, "BUY", "3000", "1105.20", "2026-05-05 13:14:00"),
    (100009, "2026-05-05", 7, 5, "SELL", "50000", "101.10", "2026-05-05 10:30:00"),
    (100010, "2026-05-06", 8, 3, "BUY", "-400", "9800.00", "2026-05-06 12:00:00"),
]

JANUARY = [
    (1, "t1", "Equities", "APAC"),
    (2, "t2", "Credit", "APAC"),
    (3, "t3", "Equities", "APAC"),
    (4, "t4", "Macro", "APAC"),
    (5, "t5", "Credit", "APAC"),
    (6, "t6", "Equities", "APAC"),
]
JUNE = [
    (1, "t1", "Equities", "APAC"),
    (2, "t2", "Credit", "APAC"),
    (3, "t3", "Equities", "APAC"),
    (4, "t4", "Credit", "APAC"),
    (5, "t5", "Macro", "APAC"),
    (6, "t6", "Equities", "EMEA"),
    (7, "t7", "Equities", "APAC"),
]
SEPTEMBER = [
    (1, "t1", "Equities", "APAC"),
    (2, "t2", "Credit", "APAC"),
    (3, "t3", "Equities", "APAC"),
    (4, "t4", "Equities", "APAC"),
    (5, "t5", "Macro", "APAC"),
    (6, "t6", "Equities", "EMEA"),
    (7, "t7", "Credit", "APAC"),
    (8, "t8", "Macro", "APAC"),
]

AMENDMENTS = [
    (100015, "2026-05-01", 8, 2, "SELL", "90", "902.21", "extra zero"),
    (100035, "2026-05-04", 3, 3, "SELL", "73000", "103.24", "price"),
    (100019, "2026-05-01", 5, 5, "BUY", "4200", "2348.20", "partial fill"),
    (100045, "2026-05-05", 2, 1, "SELL", "3800", "3188.50", "custodian"),
    (100038, "2026-05-04", 7, 1, "SELL", "77000", "104.65", "stale quote"),
]
AMENDED_VALUES = {
    100015: D("81198.90"),
    100019: D("9862440.00"),
    100035: D("7536520.00"),
    100038: D("8058050.00"),
    100045: D("12116300.00"),
}


def trade(t):
    when = t[7] if isinstance(t[7], datetime) else datetime.fromisoformat(t[7])
    quantity, price = (None if v is None else D(str(v)) for v in t[5:7])
    return (t[0], date.fromisoformat(t[1]), *t[2:5], quantity, price, when)


def trades(spark, raw=SEED):
    return spark.createDataFrame([trade(t) for t in raw], schemas.TRADES)


def traders(spark, raw):
    return spark.createDataFrame(raw, schemas.TRADERS)


def amendments(spark, raw=None, dated="2026-05-20"):
    out = [
        (t[0], date.fromisoformat(t[1]), *t[2:5], D(t[5]), D(t[6]), t[7], date.fromisoformat(dated))
        for t in (AMENDMENTS if raw is None else raw)
    ]
    return spark.createDataFrame(out, schemas.AMENDMENTS)
