"""Fixed schemas of the sources, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import types as T

ID_COLUMNS = ("item_id", "dept_id", "cat_id", "store_id", "state_id")
EVENT_COLUMNS = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")
FLAG_COLUMNS = ("snap_CA", "snap_TX", "snap_WI")


_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
}


def _struct(spec: str) -> T.StructType:
    """``"name type, name type"`` to a nullable StructType, without needing a session."""
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CALENDAR = _struct(
    "date DATE, wm_yr_wk INT, weekday STRING, wday TINYINT, month TINYINT, year SMALLINT, d STRING, "
    "event_name_1 STRING, event_type_1 STRING, event_name_2 STRING, event_type_2 STRING, "
    "snap_CA TINYINT, snap_TX TINYINT, snap_WI TINYINT"
)
PRICES = _struct("store_id STRING, item_id STRING, wm_yr_wk INT, sell_price DOUBLE")
SALES_LONG = _struct(
    "item_id STRING, dept_id STRING, cat_id STRING, store_id STRING, state_id STRING, d STRING, "
    "date DATE, wm_yr_wk INT, weekday STRING, wday TINYINT, month TINYINT, year SMALLINT, "
    "event_name_1 STRING, event_type_1 STRING, event_name_2 STRING, event_type_2 STRING, "
    "snap_CA TINYINT, snap_TX TINYINT, snap_WI TINYINT, units_sold SMALLINT, sell_price DOUBLE"
)

STAR_TABLES = {
    "dim_date": _struct(
        "date DATE, d STRING, wm_yr_wk INT, day_of_week INT, week_of_year INT, month INT, year INT, "
        "event_name_1 STRING, event_type_1 STRING, event_name_2 STRING, event_type_2 STRING, "
        "snap_CA INT, snap_TX INT, snap_WI INT, is_weekend INT"
    ),
    "dim_item": _struct("item_id STRING, dept_id STRING, cat_id STRING"),
    "dim_store": _struct("store_id STRING, state_id STRING"),
    "fact_sales": _struct("item_id STRING, store_id STRING, date DATE, units_sold BIGINT"),
    "fact_prices": _struct("item_id STRING, store_id STRING, wm_yr_wk INT, sell_price DOUBLE"),
}


def wide_sales(header: list[str]) -> T.StructType:
    """Schema of a wide sales file from its header: text ids, then one short per ``d_n``."""
    return T.StructType(
        [
            T.StructField(name, T.ShortType() if name.startswith("d_") else T.StringType())
            for name in header
        ]
    )
