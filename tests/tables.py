"""Schemas of permit exports, and a reader, for tests."""

from pyspark.sql import types as T

from meterqa.schema import _table

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()

EXT_SITES = _table(ext_site_id=_S, nztmx=_D, nztmy=_D, swaz_name=_S)
CONSENTS = _table(
    record_number=_S,
    activity=_S,
    hydro_group=_S,
    ext_site_id=_S,
    from_date=_S,
    to_date=_S,
    from_month=_I,
    to_month=_I,
    consented_rate=_D,
    consented_multiday_volume=_D,
    consented_multiday_period=_I,
    consented_annual_volume=_D,
    water_use=_S,
    irrigation_area=_D,
    consent_status=_S,
    modified_date=_S,
)


def read_back(spark, path):
    return spark.read.parquet(path)
