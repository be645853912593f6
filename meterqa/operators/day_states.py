"""Statistics from mergeable day states, with a recount of the few days that may hold spikes.

Only a register needs the reading before. Readings of all other kinds are volumes as they stand: they are aggregated to a state per
site, measurement and day before anything is shuffled, and so are the last readings of buckets, which tell a register's first reading of a
bucket what came before. Registers alone are shuffled and sorted, once.

A state holds counts, sums and extremes, and for positive volumes the number and the sum of squared deviations from their mean, from
which the mean and deviation of a site follow by the pairwise formula. A limit can only be passed on a day whose largest volume
passes it, so flags are counted on those days only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterqa.operators.lagged import GRAINS, with_buckets
from meterqa.operators.series import accepted_measurements
from meterqa.operators.summaries import FLAGS
from meterqa.operators.volumes import limit_rule
from meterqa.schema import SPIKE_MULTIPLES, WATER_METER
from meterqa.sources.tables import as_number

DAY = ["site", "measurement", "date"]
#: Aggregates of the volumes {v} of a day or a bucket. Spark merges the parts of a variance pairwise.
STATE = {
    "reports": "count(case when {v} >= 0 then {v} end)",
    "sum_kept": "sum(case when {v} >= 0 then {v} end)",
    "negatives": "count(case when {v} < 0 then {v} end)",
    "negative_sum": "sum(case when {v} < 0 then {v} end)",
    "min_positive": "min(case when {v} > 0 then {v} end)",
    "sum_positive": "sum(case when {v} > 0 then {v} end)",
    "n_positive": "count(case when {v} > 0 then {v} end)",
    "max_kept": "max(case when {v} >= 0 then {v} end)",
    "squares": "coalesce(var_pop(case when {v} > 0 then {v} end) * count(case when {v} > 0 then {v} end), 0d)",
}
#: What the limits of a site are made of.
BASIS = ("reports", "sum_positive", "n_positive", "squares")
REGISTER = f"measurement = '{WATER_METER}'"


def state_columns(vol: str = "vol", only: Sequence[str] = tuple(STATE), prefix: str = "") -> list[Column]:
    return [F.expr(f"{STATE[c].format(v=vol)} as {prefix}{c}") for c in only]


def site_params(states: DataFrame, prefix: str = "") -> DataFrame:
    """States with the mean and deviation of their site's positive volumes beside them, and the row counts.

    Deviations add up as squares inside the days and squares of the days' means around the common mean, so nothing cancels.
    """
    reports, total, n, squares = (f"{prefix}{c}" for c in BASIS)
    of_site = "over (partition by site)"
    centred = states.selectExpr(
        "*",
        f"sum({reports}) {of_site} as kept_rows",
        f"sum({n}) {of_site} as positive_rows",
        f"try_divide(sum({total}) {of_site}, cast(sum({n}) {of_site} as double)) as mean",
    )
    around = f"{squares} + coalesce({n} * pow(try_divide({total}, cast({n} as double)) - mean, 2), 0d)"
    return centred.selectExpr(
        "*", f"case when positive_rows > 1 then sqrt(sum({around}) {of_site} / (positive_rows - 1)) end as sd"
    )


def merged_params(states: DataFrame) -> DataFrame:
    """Mean and sample deviation of positive volumes, and the row counts, by site; as ``volumes.spike_params``."""
    params = site_params(states).select("site", "mean", "sd", "kept_rows", "positive_rows")
    return params.filter("kept_rows > 0").distinct()


def _held(rows: DataFrame, plan: DataFrame, shown: DataFrame | None, bucket: list[str]) -> DataFrame:
    """Buckets of the planned series: states of volumes as they stand, and for registers the value before their first reading.

    The bucket before is the last one of the stitched series, or the register's own where it is shown by itself.
    """
    vol = f"(case when not {REGISTER} then value end)"
    ends = rows.groupBy(*bucket).agg(F.expr("max_by(value, date_time) as end_value"), *state_columns(vol))
    days = plan.filter("taken").selectExpr("site", "measurement", "start_date as basis_start", "end_date as basis_end")
    kinds = {"basis": "in_basis"}
    if shown is not None:
        own = shown.filter("taken").selectExpr("site", "measurement", "start_date as shown_start", "end_date as shown_end")
        days = days.join(own, ["site", "measurement"], "full")
        kinds["shown"] = f"in_shown and {REGISTER}"
    inside = [f"coalesce(date between {k}_start and {k}_end, false) as in_{k}" for k in kinds]
    held = ends.join(days, ["site", "measurement"]).selectExpr(*ends.columns, *inside)
    earlier = f"over (partition by site order by {', '.join(bucket[2:])} rows between unbounded preceding and 1 preceding)"
    return held.filter(" or ".join(f"in_{k}" for k in kinds)).selectExpr(
        *[c for c in held.columns if c != "end_value"],
        *[
            f"last(case when {chained} then struct(end_value) end, true) {earlier}.end_value as before_{k}"
            for k, chained in kinds.items()
        ],
    )


def _stepped(rows: DataFrame, bucket: Sequence[str], *columns: str) -> DataFrame:
    inside = f"over (partition by {', '.join(bucket)} order by date_time, value)"
    return rows.selectExpr(*columns, f"lag(value) {inside} as _value", f"row_number() {inside} = 1 as _first")


def _difference(name: str) -> str:
    """A register reading less the one before, in the buckets that belong to a plan."""
    return f"(case when in_{name} then value - case when _first then before_{name} else _value end end)"


def _rolled_up(buckets: DataFrame) -> DataFrame:
    """Day rows from rows of smaller buckets."""
    how = {"min_positive": "min", "max_kept": "max"}
    columns = [c for c in (*STATE, *FLAGS) if c != "squares"]
    return buckets.groupBy(*DAY).agg(*[F.expr(f"{how.get(c, 'sum')}({c}) as {c}") for c in columns])


def flagged_days(
    readings: DataFrame,
    plan: DataFrame,
    shown: DataFrame | None = None,
    grain: str = "day",
    rule: str = "sum",
    gate: str = "kept_rows",
) -> DataFrame:
    """Day rows as ``summaries.day_rollup`` gives them for volumes with spike flags.

    ``plan`` is the stitched series; it decides the limits, and its days are the result. With ``shown``, a plan of series that are
    not combined, the days of those are the result, each register starting afresh. Both have one segment a series. Readings without
    a site or a time are in no series.
    """
    known = accepted_measurements(readings).filter("site is not null and date_time is not null")
    rows = with_buckets(known.withColumn("value", as_number(readings, "value")), grain)
    place = ["site", *GRAINS[grain]]
    bucket = ["site", "measurement", *GRAINS[grain]]
    what, prefix = ("basis", "") if shown is None else ("shown", "basis_")
    held = _held(rows, plan, shown, bucket)
    registers = rows.filter(REGISTER).select(*place, "date_time", "value").repartition(*place)
    # Renamed above the window, or the join would sort the registers anew.
    stepped = _stepped(registers, place, *place, "value").withColumnsRenamed({c: f"_{c}" for c in place})
    joined = held.join(stepped, F.expr(" and ".join([REGISTER, *[f"{c} = _{c}" for c in place]])), "left")
    beside = [f"in_{what}", f"before_{what}", *(["in_basis"] if prefix else [])]
    counted = joined.select(*held.columns, F.expr(f"{_difference(what)} as _vol"), F.expr(f"{_difference('basis')} as _basis"))
    basis = state_columns("_basis", BASIS, "r_basis_") if prefix else []
    counted = counted.groupBy(*bucket).agg(
        *[F.first(c).alias(c) for c in (*beside, *STATE)], *state_columns("_vol", prefix="r_"), *basis
    )
    states = counted.selectExpr(
        *bucket,
        *[f"case when {REGISTER} then r_{c} else {c} end as {c}" for c in STATE],
        *[f"case when {REGISTER} then r_basis_{c} when in_basis then {c} end as basis_{c}" for c in BASIS if prefix],
        f"in_{what} as in_shown",
        f"before_{what} as before_shown",
    )
    limit = limit_rule(rule)
    result = [*bucket, *[c for c in STATE if c != "squares"]]
    # Always true of what was before: days without a recount read that column too, so that both parts share one shuffle of the states.
    any_before = "coalesce(before_shown, 0d) >= double('-Infinity')"
    days = site_params(states, prefix).filter(f"in_shown and {any_before}")
    armed = f"sd >= 1 and {gate} > 100"
    days = days.selectExpr(*result, "in_shown", "before_shown", "mean", f"case when {armed} then sd end as sd")
    lowest = f"least({', '.join(limit.format(k=k) for k in SPIKE_MULTIPLES)})"
    may_pass = f"coalesce(max_kept > {lowest}, false)"
    calm = days.filter(f"not {may_pass}").selectExpr(*result, *[f"0l as {f}" for f in FLAGS])
    wild = days.filter(may_pass)
    again = rows.select(*bucket, "date_time", "value").join(wild, bucket)
    again = _stepped(again, bucket, *days.columns, "value")
    again = again.withColumn("vol", F.expr(f"case when {REGISTER} then {_difference('shown')} else value end"))
    over = [F.expr(f"count_if(vol > {limit.format(k=k)}) as {f}") for k, f in zip(SPIKE_MULTIPLES, FLAGS, strict=True)]
    recounted = again.groupBy(*bucket).agg(*[F.first(c).alias(c) for c in result if c not in bucket], *over)
    found = calm.unionByName(recounted)
    return found if grain == "day" else _rolled_up(found)
