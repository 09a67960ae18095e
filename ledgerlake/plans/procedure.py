"""The window load as a stored procedure's text: SQL scripting with bound parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.schemas import SILVER
from ledgerlake.session import with_settings
from ledgerlake.sinks.tables import quoted

PROCEDURE = """
BEGIN
  DECLARE window_date DATE DEFAULT CAST(:window_date AS DATE);
  DECLARE loaded_at TIMESTAMP_NTZ DEFAULT CAST(:now AS TIMESTAMP_NTZ);
  DECLARE found BIGINT DEFAULT 0;
  SET found = (SELECT count(*) FROM {bronze} WHERE trade_date = window_date);
  IF found > 0 THEN
    INSERT OVERWRITE {silver}
    WITH newest AS (
      SELECT *, row_number() OVER (
               PARTITION BY trade_id
               ORDER BY last_modified_ts DESC NULLS LAST, security_id DESC NULLS LAST,
                        trader_id DESC NULLS LAST, trade_type DESC NULLS LAST,
                        quantity DESC NULLS LAST, price DESC NULLS LAST) AS place
      FROM {bronze} WHERE trade_date = window_date
    ), loaded AS (
      SELECT trade_id, trade_date, security_id, trader_id, trade_type, quantity, price,
             CAST(round(quantity * price, 2) AS DECIMAL(18, 2)) AS trade_value
      FROM newest
      WHERE place = 1 AND quantity > 0 AND price > 0
        AND IF(trade_id IS NULL, raise_error('a source row has no trade_id'), true)
    ), touched AS (
      SELECT s.trade_date FROM {silver} AS s LEFT SEMI JOIN loaded AS l ON s.trade_id = l.trade_id
      UNION
      SELECT trade_date FROM loaded
    ), stored AS (
      SELECT * FROM {silver} WHERE trade_date IN (SELECT trade_date FROM touched)
    )
    SELECT coalesce(s.trade_id, l.trade_id) AS trade_id,
           IF(s.trade_id IS NULL, l.security_id, s.security_id) AS security_id,
           IF(s.trade_id IS NULL, l.trader_id, s.trader_id) AS trader_id,
           IF(s.trade_id IS NULL, l.trade_type, s.trade_type) AS trade_type,
           IF(l.trade_id IS NULL, s.quantity, l.quantity) AS quantity,
           IF(l.trade_id IS NULL, s.price, l.price) AS price,
           IF(l.trade_id IS NULL, s.trade_value, l.trade_value) AS trade_value,
           IF(l.trade_id IS NULL, s.silver_loaded_ts, loaded_at) AS silver_loaded_ts,
           IF(s.trade_id IS NULL, l.trade_date, s.trade_date) AS trade_date
    FROM stored AS s FULL OUTER JOIN loaded AS l ON s.trade_id = l.trade_id;
  END IF;
  SELECT CAST(window_date AS STRING) AS window_date, found AS bronze_row_count,
         (SELECT count(*) FROM {silver} WHERE trade_date = window_date) AS silver_row_count;
END
"""


def create_silver(spark: SparkSession, name: str, path: str) -> None:
    """Silver as a table of the catalog, one folder a day."""
    fields = [f for f in SILVER if f.name != "trade_date"] + [SILVER["trade_date"]]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING parquet "
        f"PARTITIONED BY (trade_date) LOCATION '{place}'"
    )


def call_window(
    spark: SparkSession, bronze: str, silver: str, window_date, now
) -> DataFrame:
    """Run the procedure for one day; returns its summary row.

    The same rows as ``windows.transform_window``. Date and time are bound, never parts of
    the text; only folders that hold a matched key or get a row are replaced, so a day may
    be run again.
    """
    text = PROCEDURE.format(bronze=quoted(bronze), silver=quoted(silver))
    with with_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        return spark.sql(text, args={"window_date": str(window_date), "now": str(now)})
