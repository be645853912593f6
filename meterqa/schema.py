"""Table schemas and the fixed vocabulary of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
COMPLIANCE_VOLUME = "Compliance Volume"
WATER_METER = "Water Meter"
ACCEPTED_MEASUREMENTS = (
    "Compliance Volume",
    "Water Meter",
    "Volume",
    "Volume [Flow]",
    "Volume [Average Flow]",
)
WAREHOUSE_FLOW = "Flow"
WAREHOUSE_AVERAGE_FLOW = "Average Flow"
ACTIVE_CONSENT = "Issued - Active"
HYDROELECTRIC = "hydroelectric"
CONSENT_DATE_FORMATS = (
    "d/MM/yyyy[ H:mm[:ss]]",
    "yyyy-MM-dd[ HH:mm[:ss]]",
    "yyyy-MM-dd'T'HH:mm[:ss]",
)
SITE_ID_PATTERN = r"[A-Z]+\d\d/\d+"
DEFAULT_SERIES_START = "2000-01-01"
SPIKE_MULTIPLES = (5, 10, 20)
STATUS_NO_WEEK = "No data in last week"
STATUS_MODE_ZERO = "Mode equals 0!"
STATUS_VALUE_ERROR = "Value error"
STATUS_KEY_ERROR = "Key error"
UNKNOWN_REPORT = "Unknown"
# ----------------------------------------------------------------------------


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()
_TS = T.TimestampNTZType()

OBSERVATIONS = _table(site=_S, measurement=_S, date_time=_TS, value=_D)
CATALOG = _table(site=_S, measurement=_S, from_ts=_TS, to_ts=_TS)
SITES = _table(site_name=_S)
WAREHOUSE = _table(
    site_id=_S,
    attribute_name=_S,
    unit_name=_S,
    hydro_year=_S,
    data_source=_S,
    observation_value=_D,
    observation_date_time=_TS,
)
REPORTING_MODES = _table(site=_S, mode=_I, mode_freq=_D, method=_S)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail at the boundary, on the driver, when a table lacks a column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; table has {df.columns}")
    return df
