"""All table layouts in one place. The readers of raw, flat and insight files pass them to Spark."""

from pyspark.sql import types as T

# Money is summed as DECIMAL so that a total does not depend on the order of addition.
MONEY = T.DecimalType(20, 6)        # one line
MONEY_TOTAL = T.DecimalType(30, 6)  # one day


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_STRING, _LONG, _DOUBLE, _DATE = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()

ITEM = _struct(
    ("item_id", _STRING), ("item_name", _STRING), ("item_category", _STRING),
    ("price", _DOUBLE), ("quantity", _LONG),
)

PARAM = _struct(
    ("key", _STRING),
    ("value", _struct(("string_value", _STRING), ("int_value", _LONG))),
)

RAW_EVENT = _struct(
    ("event_date", _STRING),        # yyyyMMdd, the partition column of the raw table
    ("event_timestamp", _LONG),     # epoch microseconds
    ("event_name", _STRING),
    ("user_pseudo_id", _STRING),
    ("geo", _struct(("country", _STRING), ("region", _STRING))),
    ("device", _struct(("category", _STRING))),
    ("traffic_source", _struct(("source", _STRING), ("medium", _STRING), ("name", _STRING))),
    ("event_params", T.ArrayType(PARAM)),
    ("items", T.ArrayType(ITEM)),
)

FLAT_EVENT = _struct(
    ("event_dt", _DATE), ("event_timestamp", T.TimestampNTZType()),
    ("event_name", _STRING), ("user_pseudo_id", _STRING),
    ("country", _STRING), ("region", _STRING), ("device_category", _STRING),
    ("source", _STRING), ("medium", _STRING), ("campaign", _STRING),
    ("page_location", _STRING), ("page_referrer", _STRING), ("ga_session_id", _LONG),
    ("item_id", _STRING), ("item_name", _STRING), ("item_category", _STRING),
    ("price", _DOUBLE), ("quantity", _LONG),
)

# Column order of the staging layer; event_timestamp is called event_ts from here on.
STAGED_EVENT = _struct(
    ("event_dt", _DATE), ("event_ts", T.TimestampNTZType()),
    ("user_pseudo_id", _STRING), ("event_name", _STRING),
    ("source", _STRING), ("medium", _STRING), ("campaign", _STRING),
    ("device_category", _STRING), ("country", _STRING), ("region", _STRING),
    ("page_location", _STRING), ("page_referrer", _STRING), ("ga_session_id", _LONG),
    ("item_id", _STRING), ("item_name", _STRING), ("item_category", _STRING),
    ("price", _DOUBLE), ("quantity", _LONG),
    ("row_key", _STRING),
)

CHANNEL = ["source", "medium", "campaign"]

PURCHASES_DAILY = _struct(
    ("date", _DATE), ("revenue", MONEY_TOTAL), ("orders", _LONG), ("aov", _DOUBLE),
)

ATTRIBUTION_DAILY = _struct(
    ("date", _DATE), ("source", _STRING), ("medium", _STRING), ("campaign", _STRING),
    ("revenue", MONEY_TOTAL), ("orders", _LONG),
)

KPI = _struct(
    ("window_start", _DATE), ("window_end", _DATE),
    ("revenue", _DOUBLE), ("orders", _LONG), ("aov", _DOUBLE),
    ("prev_revenue", _DOUBLE), ("prev_orders", _LONG), ("prev_aov", _DOUBLE),
    ("delta_abs", _DOUBLE), ("delta_pct", _DOUBLE),
)

MOVER = _struct(
    ("source", _STRING), ("medium", _STRING), ("campaign", _STRING),
    ("revenue_cur", _DOUBLE), ("revenue_prev", _DOUBLE),
    ("delta_abs", _DOUBLE), ("delta_pct", _DOUBLE), ("impact_score", _DOUBLE),
)

NARRATIVE = _struct(
    ("headline", _STRING), ("bullets", T.ArrayType(_STRING)), ("actions", T.ArrayType(_STRING)),
)

INSIGHT = _struct(
    ("insight_date", _DATE), ("insight_type", _STRING),
    ("window_start", _DATE), ("window_end", _DATE),
    ("headline", _STRING), ("bullets", T.ArrayType(_STRING)), ("actions", T.ArrayType(_STRING)),
    ("top_movers_used", T.ArrayType(MOVER)), ("kpi_used", KPI),
    ("model_name", _STRING), ("prompt_tokens", _LONG),
    ("created_at", T.TimestampNTZType()),
    ("raw_prompt", _STRING), ("raw_response", T.VariantType()),
    ("display_text", _STRING),
)
