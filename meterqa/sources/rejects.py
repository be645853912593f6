"""Values that the library can not use, as a table beside the rows that fit.

Parsing turns such a value into null; here it is kept as it stood, with its place and the reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterqa.functions.names import is_composite, looks_like_site_id
from meterqa.operators.consents import as_timestamp
from meterqa.schema import CONSENT_DATE_FORMATS, require_columns
from meterqa.sources.tables import as_number

NUMBER, DATE, SITE = "number", "date", "site"


def _reason(df: DataFrame, column: str, kind: str, formats: Sequence[str]) -> Column:
    """Why a value is of no use, null where it is of use. A missing value is no fault."""
    value = F.col(column)
    text = isinstance(df.schema[column].dataType, T.StringType)
    blank = F.when(F.trim(column) == "", "blank") if text else F.lit(None).cast("string")
    if kind == NUMBER:
        number = value.try_cast("double") if text else value.cast("double")
        fault = F.when(F.isnan(number), "not a number").when(as_number(df, column).isNull(), "no number")
    elif kind == DATE:
        fault = F.when(as_timestamp(df, column, formats).isNull(), "no date")
    elif kind == SITE:
        fault = F.when(is_composite(value), "several sites").when(~looks_like_site_id(value), "no site id")
    else:
        raise ValueError(f"no kind of value: {kind!r}")
    return F.when(value.isNotNull(), F.coalesce(blank, fault))


def rejected(
    df: DataFrame,
    kinds: Mapping[str, str],
    keys: Sequence[str] = (),
    formats: Sequence[str] = CONSENT_DATE_FORMATS,
) -> DataFrame:
    """One row per value of no use: ``keys``, column, raw, reason.

    ``kinds`` tells what each column should hold (``number``, ``date`` or ``site``). A row with two bad values gives two rows, a
    repeated row repeats them. All columns are looked at in one scan, without a shuffle.
    """
    require_columns(df, *kinds, *keys)
    if clash := {"column", "raw", "reason"} & set(keys):
        raise ValueError(f"key columns have the names of result columns: {sorted(clash)}")
    faults = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("string").alias("raw"),
                _reason(df, c, kind, formats).alias("reason"),
            )
            for c, kind in kinds.items()
        ]
    )
    found = F.filter(faults, lambda x: x["reason"].isNotNull())
    return df.select(*keys, F.inline(found))
