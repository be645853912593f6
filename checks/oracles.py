"""``oracle_sql()`` entries: the same results in plain SQL for DuckDB.

The SQL takes the direct route (plain LAG over a whole site, calendars by
series, joins back), not the route of the Spark plans. Shared steps are named
CTEs; a query pulls in the ones it mentions.
"""

from __future__ import annotations

import re

from checks import views as v

ACCEPTED = "('Compliance Volume','Water Meter','Volume','Volume [Flow]','Volume [Average Flow]')"


def _ext(k: str) -> str:
    return f"('BU' || lpad(CAST({k} AS VARCHAR), 2, '0') || '/' || lpad(CAST({k} AS VARCHAR), 4, '0'))"


def _meter(k: str) -> str:
    return f"({_ext(k)} || '-M1')"


def even(x: str, places: int) -> str:
    scale = f"CAST({10**places} AS DOUBLE)"
    return f"round_even(({x}) * {scale}, 0) / {scale}"


def iso(x: str) -> str:
    return f"CAST(CAST({x} AS DATE) AS VARCHAR)"


VALUE = (
    "(CASE WHEN event_id % 40 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END) * value * value "
    f"* CAST({v.VALUE_SCALE} AS DOUBLE)"
)
RATE = "(CAST(1000 AS DOUBLE) / CAST(86400 AS DOUBLE))"

CTES: dict[str, str] = {}

CTES["e"] = f"""
SELECT {_meter("user_id % 10")} AS site,
  CASE WHEN event_type = 'error' THEN 'Stage'
       WHEN event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-20' THEN 'Volume'
       WHEN event_type = 'signup' AND ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-16' THEN 'Volume [Flow]'
       WHEN event_type = 'view' AND ts >= TIMESTAMP '2024-01-18' THEN 'Water Meter'
       WHEN ts < TIMESTAMP '2024-01-12' THEN 'Compliance Volume'
       WHEN ts < TIMESTAMP '2024-01-20' THEN 'Volume'
       ELSE 'Water Meter' END AS measurement,
  ts AS date_time, {VALUE} AS value
FROM events"""
CTES["e_id"] = CTES["e"].replace("SELECT ", "SELECT event_id, ", 1)
CTES["en"] = CTES["e"].replace(
    f"{VALUE} AS value", f"CASE WHEN event_id % 17 <> 3 AND event_id % 29 <> 5 THEN {VALUE} END AS value"
)
CTES["cat"] = """
SELECT site, measurement,
  CASE WHEN measurement = 'Compliance Volume' AND CAST(substr(site, 3, 2) AS INTEGER) % 5 = 0 THEN NULL
       ELSE min(date_time) END AS from_ts, max(date_time) AS to_ts
FROM e GROUP BY site, measurement"""
CTES["cat2"] = "SELECT site, measurement, coalesce(from_ts, TIMESTAMP '2000-01-01') AS from_ts, to_ts FROM cat"
CTES["proc"] = f"""
SELECT *, CAST(from_ts AS DATE) AS from_date, CAST(to_ts AS DATE) AS to_date FROM cat2
WHERE measurement IN {ACCEPTED}"""
CTES["proc_w"] = f"""
SELECT site, measurement, from_ts, to_ts,
  greatest(CAST(from_ts AS DATE), DATE '{v.WINDOW[0]}') AS from_date,
  least(CAST(to_ts AS DATE), DATE '{v.WINDOW[1]}') AS to_date
FROM cat2 WHERE measurement IN {ACCEPTED}
  AND to_ts > TIMESTAMP '{v.WINDOW[0]}' AND from_ts < TIMESTAMP '{v.WINDOW[1]}'"""


def _plan(src: str) -> str:
    return f"""
SELECT site, measurement, segment_no, start_date, to_date AS end_date, start_date <= to_date AS taken FROM (
  SELECT *, row_number() OVER w AS segment_no,
    greatest(first_value(from_date) OVER w,
      coalesce(max(to_date) OVER (PARTITION BY site ORDER BY from_ts, measurement
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, DATE '0001-01-01')) AS start_date
  FROM {src} WINDOW w AS (PARTITION BY site ORDER BY from_ts, measurement)) q"""


def _stitched(plan: str, rows: str = "e") -> str:
    return f"""
SELECT e.*, p.segment_no FROM {rows} e JOIN {plan} p ON e.site = p.site AND e.measurement = p.measurement
  AND p.taken AND CAST(e.date_time AS DATE) BETWEEN p.start_date AND p.end_date"""


def _combined(src: str) -> str:
    return f"""
SELECT site, measurement, date_time, value, CAST(date_time AS DATE) AS date,
  CASE WHEN measurement = 'Water Meter'
    THEN value - lag(value) OVER (PARTITION BY site ORDER BY segment_no, date_time)
    ELSE value END AS vol
FROM {src}"""


CTES["plan"] = _plan("proc")
CTES["plan_w"] = _plan("proc_w")
CTES["stitched"] = _stitched("plan")
CTES["stitched_w"] = _stitched("plan_w")
CTES["stitched_n"] = _stitched("plan", "en")
CTES["vol_n"] = _combined("stitched_n")
CTES["vol_c"] = _combined("stitched")
CTES["vol_w"] = _combined("stitched_w")
CTES["vol_r"] = f"""
SELECT site, measurement, date_time, value, CAST(date_time AS DATE) AS date,
  CASE WHEN measurement = 'Water Meter'
    THEN value - lag(value) OVER (PARTITION BY site, measurement ORDER BY date_time)
    ELSE value END AS vol
FROM e WHERE measurement IN {ACCEPTED}"""
CTES["ev"] = f"""
SELECT {_meter("user_id % 10")} AS site, 'Volume' AS measurement, ts AS date_time,
  CAST(ts AS DATE) AS date, {VALUE} AS vol FROM events"""
CTES["l"] = f"""
SELECT {_meter("l_suppkey % 10")} AS site, 'Volume' AS measurement,
  CASE WHEN month(l_shipdate) = 8 AND day(l_shipdate) <= 12 THEN make_date(year(l_shipdate), 8, 13)
       ELSE CAST(l_shipdate AS DATE) END AS date, l_quantity AS vol FROM lineitem"""
CTES["l_daily"] = "SELECT site, date, count(vol) AS readings, sum(vol) AS volume FROM l GROUP BY site, date"
CTES["l_cal"] = """
SELECT site, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT site, min(date) AS lo, max(date) AS hi FROM l GROUP BY site) q"""
CTES["l_grid"] = "SELECT c.site, c.date, d.readings, d.volume FROM l_cal c LEFT JOIN l_daily d USING (site, date)"
CTES["wy_cal"] = """
SELECT site, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT site, make_date(year(min(date)) - CASE WHEN month(min(date)) <= 6 THEN 1 ELSE 0 END, 7, 1) AS lo,
        max(date) AS hi FROM l GROUP BY site) q"""
CTES["wy_grid"] = "SELECT c.site, c.date, d.readings, d.volume FROM wy_cal c LEFT JOIN l_daily d USING (site, date)"
CTES["c"] = f"""
SELECT 'CRC' || CAST(o_orderkey AS VARCHAR) AS record_number, {_ext("o_custkey % 10")} AS ext_site_id,
  CAST(o_orderdate AS DATE) AS from_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3000 AS INTEGER) AS to_date,
  o_totalprice / CAST(1000 AS DOUBLE) AS consented_rate, o_totalprice AS consented_multiday_volume,
  CAST(1 + (o_custkey % 10) * 3 AS INTEGER) AS consented_multiday_period,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'hydroelectric' WHEN '2-HIGH' THEN NULL ELSE 'agriculture' END AS water_use,
  CASE WHEN o_orderstatus = 'F' AND o_custkey % 10 >= 3 THEN 'Issued - Active'
       WHEN o_orderstatus = 'F' THEN 'Terminated - Replaced'
       WHEN o_orderstatus = 'O' THEN 'Issued - Inactive' ELSE 'Terminated - Expired' END AS consent_status
FROM orders"""
CTES["c_eff"] = """
SELECT c.* FROM c JOIN (SELECT ext_site_id, max(to_date) AS latest,
    count(*) FILTER (consent_status = 'Issued - Active') AS active FROM c GROUP BY ext_site_id) s USING (ext_site_id)
WHERE CASE WHEN active > 0 THEN consent_status = 'Issued - Active' ELSE to_date = latest END"""
CTES["lim"] = f"""
SELECT ext_site_id, sum(consented_rate) AS max_rate, sum(consented_multiday_volume) AS multiday_vol,
  CAST(max(consented_multiday_period) AS BIGINT) AS return_period,
  {even("sum(consented_rate) * CAST(86.4 AS DOUBLE)", 2)} AS max_vol
FROM c_eff GROUP BY ext_site_id"""
CTES["use_c"] = """
SELECT * FROM c WHERE water_use IS DISTINCT FROM 'hydroelectric' AND date_diff('day', from_date, to_date) > 10
  AND from_date < DATE '2100-06-30' AND to_date > DATE '1900-07-01'"""
CTES["req"] = f"SELECT {_meter('n_nationkey')} AS site FROM nation"
CTES["held"] = "SELECT DISTINCT site FROM e"
CTES["faulty"] = f"""
SELECT CASE WHEN n_nationkey % 5 = 4 THEN 'X-' || CAST(n_nationkey AS VARCHAR)
            WHEN n_nationkey % 7 = 6 THEN {_meter("n_nationkey")} || ',' || {_meter("n_nationkey + 1")}
            ELSE {_meter("n_nationkey")} END AS site,
  'Zone ' || CAST(n_regionkey AS VARCHAR) AS swaz_name,
  n_nationkey * CAST(1000 AS DOUBLE) AS nztmx, n_nationkey * CAST(2000 AS DOUBLE) AS nztmy FROM nation"""
CTES["exts"] = """
SELECT CASE WHEN contains(site, ',') THEN site ELSE regexp_replace(site, '-M1$', '') END AS ext_site_id,
  nztmx, nztmy, swaz_name FROM faulty"""
CTES["m"] = f"""
SELECT site, value, CAST(DATE '{v.MODES_AS_OF}' - CAST(CASE WHEN i <= 4 THEN a WHEN i = 5 THEN (a % 91 + 91) % 91
    WHEN i = 9 THEN 3 + 100 * ((a % 3 + 3) % 3) ELSE 92 + 91 * (i - 6) + (a % 90 + 90) % 90 END AS INTEGER) AS TIMESTAMP) AS date_time
FROM (SELECT {_meter("l_suppkey % 10")} AS site, l_suppkey % 10 AS i, l_quantity AS value,
    date_diff('day', CAST(l_shipdate AS DATE), DATE '{v.MODES_AS_OF}') AS a FROM lineitem) q"""
CTES["m_year"] = f"""
SELECT * FROM m WHERE date_time BETWEEN TIMESTAMP '{v.MODES_AS_OF}' - INTERVAL 365 DAY AND TIMESTAMP '{v.MODES_AS_OF}'"""
CTES["win"] = f"""
SELECT 0 AS no, 'Annual' AS method, DATE '{v.MODES_AS_OF}' - 365 AS lo, DATE '{v.MODES_AS_OF}' AS hi
UNION ALL SELECT q, 'Qtr' || CAST(q AS VARCHAR), DATE '{v.MODES_AS_OF}' - 91 * CAST(q AS INTEGER),
  DATE '{v.MODES_AS_OF}' - 91 * CAST(q - 1 AS INTEGER) FROM range(1, 5) r(q)"""
CTES["win_days"] = """
SELECT s.site, w.no, w.method, CAST(w.lo + CAST(k AS INTEGER) AS DATE) AS date
FROM (SELECT DISTINCT site FROM m_year) s CROSS JOIN win w
CROSS JOIN range(0, 366) r(k) WHERE w.lo + CAST(k AS INTEGER) <= w.hi"""
CTES["win_counts"] = """
SELECT d.site, d.no, d.method, d.date, count(m_year.value) AS readings
FROM win_days d JOIN win w ON w.no = d.no
LEFT JOIN m_year ON m_year.site = d.site AND CAST(m_year.date_time AS DATE) = d.date
  AND m_year.date_time <= CAST(w.hi AS TIMESTAMP)
GROUP BY d.site, d.no, d.method, d.date"""
CTES["win_mode"] = """
SELECT site, no, method, readings AS mode, days, total FROM (
  SELECT *, row_number() OVER (PARTITION BY site, no ORDER BY days DESC, readings) AS rn,
    sum(days) OVER (PARTITION BY site, no) AS total
  FROM (SELECT site, no, method, readings, count(*) AS days FROM win_counts GROUP BY site, no, method, readings) h) q
WHERE rn = 1"""
CTES["modes"] = f"""
SELECT a.site, coalesce(p.mode, 0) AS mode,
  CASE WHEN coalesce(p.no, 0) = 0 THEN {even("CAST(a.days AS DOUBLE) / CAST(a.total AS DOUBLE)", 2)} END AS mode_freq,
  coalesce(p.method, 'Annual') AS method
FROM (SELECT * FROM win_mode WHERE no = 0) a
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY no) AS k FROM win_mode WHERE mode <> 0) z
  WHERE k = 1) p ON p.site = a.site"""
CTES["all_modes"] = """
SELECT site, mode FROM modes
UNION ALL SELECT site, 24 FROM req WHERE site NOT IN (SELECT site FROM modes)"""
CTES["wk"] = f"""
SELECT site, count(value) FILTER (date_time >= t0) AS n, max(date_time) FILTER (date_time >= t0) AS week_last,
  max(date_time) AS year_last
FROM (SELECT *, TIMESTAMP '{v.WEEK_END}' - INTERVAL 6 DAY AS t0 FROM m
  WHERE date_time BETWEEN TIMESTAMP '{v.WEEK_END}' - INTERVAL 364 DAY AND TIMESTAMP '{v.WEEK_END}' + INTERVAL 1 DAY) q
GROUP BY site"""
CTES["wk_sites"] = f"SELECT {_meter('n_nationkey')} AS site FROM nation WHERE n_nationkey < 10 OR n_nationkey % 2 = 0"
CTES["wh"] = f"""
SELECT {_meter("user_id % 10")} AS site_id,
  CASE event_type WHEN 'click' THEN 'Compliance Volume' WHEN 'purchase' THEN 'Water Meter' WHEN 'view' THEN 'Flow'
    WHEN 'signup' THEN 'Average Flow' WHEN 'error' THEN 'Volume' END AS attribute_name,
  'S' || CAST(event_id % 3 AS VARCHAR) AS data_source, {VALUE} AS observation_value, ts AS observation_date_time
FROM events"""
CTES["wh_l"] = """
SELECT *, lag(observation_value) OVER w AS prev_value, lag(observation_date_time) OVER w AS prev_time FROM wh
WINDOW w AS (PARTITION BY site_id, attribute_name, data_source ORDER BY observation_date_time, observation_value)"""


def _measured(flow: str, average_flow: str, rows: str = "wh_l") -> str:
    return f"""
SELECT *, CASE attribute_name WHEN 'Water Meter' THEN observation_value - prev_value
    WHEN 'Flow' THEN {flow} WHEN 'Average Flow' THEN {average_flow} ELSE observation_value END AS measured_value
FROM (SELECT *, CAST(date_diff('second', prev_time, observation_date_time) AS DOUBLE) AS secs,
  CAST(date_diff('hour', prev_time, observation_date_time) AS DOUBLE) AS hrs FROM {rows}) q"""


_PUBLISHED = ("observation_value * CAST(1000 AS DOUBLE) / nullif(secs, 0)", "observation_value / nullif(hrs, 0)")
CTES["wh_m"] = _measured(*_PUBLISHED)
CTES["wh_p"] = _measured(
    "observation_value * secs / CAST(1000 AS DOUBLE)", "observation_value * hrs"
)
CTES["whn"] = f"""
SELECT * REPLACE (CASE WHEN event_id % 13 <> 6 THEN attribute_name END AS attribute_name,
  CASE WHEN event_id % 11 <> 4 THEN data_source END AS data_source) FROM (
  {CTES["wh"].replace("SELECT", "SELECT event_id,", 1).strip()}) q"""
CTES["whn_l"] = CTES["wh_l"].replace("FROM wh\n", "FROM whn\n")
CTES["whn_m"] = _measured(*_PUBLISHED, "whn_l")
CTES["whn_d"] = """
SELECT site_id, CAST(observation_date_time AS DATE) AS date, data_source, sum(measured_value) AS daily_measured_value
FROM whn_m WHERE measured_value >= 0 GROUP BY ALL"""
CTES["wh_d"] = """
SELECT site_id, CAST(observation_date_time AS DATE) AS date, data_source, sum(measured_value) AS daily_measured_value
FROM wh_m WHERE measured_value >= 0 GROUP BY ALL"""


def _with(body: str) -> str:
    """Prefix a body with the CTEs it needs, in order of definition."""
    need: set[str] = set()

    def scan(text: str) -> None:
        for name, sql in CTES.items():
            if name not in need and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need.add(name)
                scan(sql)

    scan(body)
    parts = [f"{name} AS ({sql.strip()})" for name, sql in CTES.items() if name in need]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()


def _params(src: str) -> str:
    return f"""SELECT site, avg(vol) FILTER (vol > 0) AS mean, stddev_samp(vol) FILTER (vol > 0) AS sd,
  count(*) FILTER (vol >= 0) AS kept_rows, count(*) FILTER (vol > 0) AS positive_rows
  FROM {src} WHERE vol >= 0 GROUP BY site"""


def _flag(k: int, rule: str = "sum", gate: str = "kept_rows", vol: str = "v.vol") -> str:
    limit = f"p.mean + p.sd * {k}" if rule == "sum" else f"p.mean * p.sd * {k}"
    return f"CASE WHEN p.sd >= 1 AND p.{gate} > 100 AND {vol} > {limit} THEN 1 ELSE 0 END"


def _flagged(src: str, rule: str = "sum", gate: str = "kept_rows", params: str | None = None) -> str:
    flags = ", ".join(f"{_flag(k, rule, gate)} AS sd{k}" for k in (5, 10, 20))
    return f"SELECT v.*, {flags} FROM {src} v LEFT JOIN ({_params(params or src)}) p USING (site) WHERE v.vol >= 0"


def _monthly(src: str) -> str:
    return f"""
WITH f AS ({_flagged(src)}),
dd AS (SELECT site, date, max(measurement) AS measurement, count(vol) AS n, sum(sd5) AS s5, sum(sd10) AS s10, sum(sd20) AS s20
  FROM f GROUP BY site, date),
mm AS (SELECT site, strftime(date, '%Y-%m') AS month, max(measurement) AS meas_type, count(n) AS days_with_data,
  CAST(sum(n) AS BIGINT) AS total_reports, CAST(sum(s5) AS BIGINT) AS spikes_sd5, CAST(sum(s10) AS BIGINT) AS spikes_sd10,
  CAST(sum(s20) AS BIGINT) AS spikes_sd20 FROM dd GROUP BY ALL),
xx AS (SELECT site, strftime(date, '%Y-%m') AS month, {even("min(vol)", 3)} AS min_extraction,
  {even("avg(vol)", 1)} AS mean_extraction, {even("max(vol)", 1)} AS max_extraction
  FROM f WHERE vol > 0 GROUP BY ALL)
SELECT mm.*, min_extraction, mean_extraction, max_extraction FROM mm LEFT JOIN xx USING (site, month)"""


def _nested(body: str) -> str:
    """A body with its own WITH list, preceded by the named CTEs."""
    own = body.strip()
    assert own.startswith("WITH ")
    head = _with(own[len("WITH ") :])
    return head.replace(" " + own[len("WITH ") :], ", " + own[len("WITH ") :], 1)


ORACLES: dict[str, str] = {}


def _add(name: str, body: str) -> None:
    ORACLES[name] = _nested(body) if body.strip().startswith("WITH ") else _with(body)


_add(
    "scan_observations_range",
    "SELECT * FROM e WHERE measurement IN ('Compliance Volume','Volume') "
    "AND date_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-15'",
)
_add(
    "measurement_catalog",
    "SELECT site, measurement, min(date_time) AS from_ts, max(date_time) AS to_ts FROM e GROUP BY ALL",
)
_add("site_list", "SELECT DISTINCT site AS site_name FROM e")
_C_ALL = (
    f"record_number, ext_site_id, {iso('from_date')} AS from_date, {iso('to_date')} AS to_date, consented_rate, "
    "consented_multiday_volume, consented_multiday_period, water_use, consent_status"
)
_add(
    "consents_by_key",
    f"SELECT {_C_ALL} FROM c WHERE ext_site_id IN (SELECT split_part(site, '-', 1) FROM req)",
)
_add(
    "ext_sites_filtered",
    r"SELECT * FROM exts WHERE swaz_name IN ('Zone 1','Zone 2','Zone 4') AND regexp_matches(ext_site_id, '[A-Z]+\d\d/\d+')",
)
_add("wh_scan_sites", "SELECT * FROM wh WHERE site_id IN (SELECT site FROM req)")
_add("measurement_whitelist", f"SELECT * FROM e WHERE measurement IN {ACCEPTED}")
_add(
    "site_slice",
    "SELECT site AS site_name FROM (SELECT site, row_number() OVER (ORDER BY site) - 1 AS pos FROM held) q "
    "WHERE pos >= 3 AND pos < 8",
)
_add("skip_composite_sites", "SELECT site FROM faulty WHERE NOT contains(site, ',')")
_add("remove_negatives", "SELECT site, date_time, vol FROM ev WHERE vol >= 0")
_add(
    "consents_exclude_use",
    "SELECT record_number, water_use FROM c WHERE water_use IS NULL OR water_use <> 'hydroelectric'",
)
_FORMS = ("%d/%m/%Y %H:%M", "%Y-%m-%d", "%Y-%m-%d %H:%M:%S")


def _exported(x: str) -> str:
    first, second, third = (f"strftime({x}, '{form}')" for form in _FORMS)
    return f"CASE WHEN right(record_number, 1) < '4' THEN {first} WHEN right(record_number, 1) < '7' THEN {second} ELSE {third} END"


def _parsed(x: str) -> str:
    return "coalesce(" + ", ".join(f"try_strptime({x}, '{form}')" for form in _FORMS) + ")"


_add(
    "consents_min_duration",
    f"""SELECT record_number, from_date, to_date FROM (
  SELECT record_number, {_parsed("f")} AS from_date, {_parsed("t")} AS to_date
  FROM (SELECT record_number, {_exported("from_date")} AS f,
    CASE WHEN record_number LIKE '%77' THEN 'until further notice' ELSE {_exported("to_date")} END AS t FROM c) x) y
WHERE date_diff('day', from_date, to_date) > 10""",
)
_add(
    "consents_overlap",
    "SELECT record_number, CAST(from_date AS TIMESTAMP) AS from_date, CAST(to_date AS TIMESTAMP) AS to_date FROM c "
    "WHERE from_date < DATE '1997-06-30' AND to_date > DATE '1996-07-01'",
)
_add("site_id_pattern", r"SELECT site FROM faulty WHERE regexp_matches(site, '[A-Z]+\d\d/\d+')")
_P = f"site, measurement, from_ts, to_ts, {iso('from_date')} AS from_date, {iso('to_date')} AS to_date"
_add("clip_catalog", f"SELECT {_P} FROM proc_w")
_add("catalog_default_start", "SELECT * FROM cat2")
_add("catalog_processed", f"SELECT {_P} FROM proc")
_add("valid_sites", "SELECT site FROM req WHERE site IN (SELECT site FROM held)")
_add(
    "missing_sites",
    "SELECT site, 'N' AS in_archive FROM req WHERE site NOT IN (SELECT site FROM held)",
)
_add(
    "stitch_plan",
    f"SELECT site, measurement, segment_no, {iso('start_date')} AS start_date, {iso('end_date')} AS end_date, taken FROM plan",
)
_add("stitched_series", "SELECT * FROM stitched")
_add("register_to_volume", "SELECT site, measurement, date_time, value, vol FROM vol_c")
_add("register_to_volume_laid_out", "SELECT site, measurement, date_time, value, vol FROM vol_c")
_add(
    "reading_accounts",
    """SELECT a.site, a.measurement, a.readings, coalesce(planned, 0) AS planned, coalesce(no_value, 0) AS no_value,
  coalesce(kept, 0) AS kept, coalesce(negative, 0) AS negative, coalesce(no_volume, 0) AS no_volume,
  CAST(0 AS BIGINT) AS unexplained
FROM (SELECT site, measurement, count(*) AS readings FROM en GROUP BY site, measurement) a LEFT JOIN (
  SELECT site, measurement, count(*) AS planned, count(*) FILTER (value IS NULL) AS no_value,
    count(*) FILTER (vol >= 0) AS kept, count(*) FILTER (vol < 0) AS negative,
    count(*) FILTER (value IS NOT NULL AND vol IS NULL) AS no_volume FROM vol_n GROUP BY site, measurement) b
  ON a.site = b.site AND a.measurement = b.measurement""",
)
_add("register_to_volume_reset", "SELECT site, measurement, date_time, value, vol FROM vol_r")
_add(
    "negatives_by_month",
    f"""SELECT site, strftime(date, '%Y-%m') AS month, count(*) AS negative_value_count,
  {even("sum(vol)", 4)} AS negative_value_sum FROM vol_c WHERE vol < 0 GROUP BY ALL""",
)
_add(
    "spike_params",
    f"SELECT site, {even('mean', 4)} AS mean, {even('sd', 4)} AS sd, kept_rows, positive_rows FROM ({_params('vol_c')}) q",
)
_add("spike_flags", f"SELECT site, date_time, vol, sd5, sd10, sd20 FROM ({_flagged('ev')}) q")
_add(
    "spike_flags_product",
    f"SELECT site, date_time, vol, sd5, sd10, sd20 FROM ({_flagged('ev', 'product')}) q",
)
_add(
    "daily_counts",
    f"SELECT site, {iso('date_time')} AS date, count(value) AS readings FROM e WHERE measurement IN {ACCEPTED} GROUP BY ALL",
)
_add("daily_totals", f"SELECT site, {iso('date')} AS date, readings, volume FROM l_daily")
_add(
    "hourly_totals",
    f"""SELECT site, {iso("date_time")} AS date, CAST(hour(date_time) AS INTEGER) AS hour, count(value) AS readings,
  {even("sum(value)", 4)} AS volume FROM e WHERE measurement IN {ACCEPTED} GROUP BY ALL""",
)
_add(
    "daily_grid_zero_fill",
    f"SELECT site, {iso('date')} AS date, coalesce(readings, 0) AS readings FROM l_grid",
)
_add(
    "daily_grid_null_fill",
    f"SELECT site, {iso('date')} AS date, CAST(readings AS DOUBLE) AS readings, volume FROM l_grid",
)

_PLOT_FROM = "2023-12-12"


def _window_rows(start: str, end: str) -> str:
    return (
        "SELECT site, date_time, value FROM e WHERE measurement = 'Compliance Volume' AND date_time BETWEEN "
        f"TIMESTAMP '{start}' AND TIMESTAMP '{end}'"
    )


def _calendar(rows: str, start: str, end: str, keys: str = "site") -> str:
    return (
        f"SELECT {keys}, CAST(d AS DATE) AS date FROM (SELECT DISTINCT {keys} FROM {rows}) s CROSS JOIN "
        f"generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 DAY) g(d)"
    )


_add(
    "missing_dates",
    f"""WITH r AS ({_window_rows(_PLOT_FROM, v.PLOT_AS_OF)}), k AS ({_calendar("r", _PLOT_FROM, v.PLOT_AS_OF)})
SELECT site, {iso("date")} AS date FROM (SELECT site, date FROM k
  EXCEPT SELECT site, CAST(date_time AS DATE) FROM r) q""",
)
_HOURLY = f"""WITH r AS ({_window_rows(_PLOT_FROM, v.PLOT_AS_OF)}), k AS ({_calendar("r", _PLOT_FROM, v.PLOT_AS_OF)}),
h AS (SELECT site, CAST(date_time AS DATE) AS date, CAST(hour(date_time) AS INTEGER) AS hour, count(value) AS readings,
  sum(value) AS volume FROM r GROUP BY ALL),
g AS (SELECT k.site, k.date, coalesce(h.hour, 0) AS hour, coalesce(h.readings, 0) AS readings,
  coalesce(h.volume, CAST(0 AS DOUBLE)) AS volume FROM k LEFT JOIN h USING (site, date))"""
_add(
    "hourly_grid",
    f"{_HOURLY} SELECT site, {iso('date')} AS date, hour, readings, {even('volume', 4)} AS volume FROM g",
)
_add(
    "hourly_plot_table",
    f"""{_HOURLY} SELECT site, {iso("date")} AS date, hour,
  CAST(month(date) AS VARCHAR) || '/' || CAST(day(date) AS VARCHAR) AS day, strftime(date, '%d') AS day_val, readings,
  CAST(trunc(volume) AS BIGINT) AS volume_int, {even("volume", 4)} AS volume FROM g""",
)
_add(
    "daily_plot_table",
    f"""WITH r AS ({_window_rows("2023-01-12", v.PLOT_AS_OF)}), k AS ({_calendar("r", "2023-01-12", v.PLOT_AS_OF)}),
dd AS (SELECT site, CAST(date_time AS DATE) AS date, count(value) AS readings, sum(value) AS volume FROM r GROUP BY ALL)
SELECT k.site, {iso("k.date")} AS date, strftime(k.date, '%Y-%m') AS month, CAST(day(k.date) AS INTEGER) AS day,
  CAST(readings AS DOUBLE) AS readings, {even("volume", 4)} AS volume FROM k LEFT JOIN dd ON dd.site = k.site AND dd.date = k.date""",
)
_add(
    "month_hourly_grid",
    f"""WITH r AS (SELECT site, measurement, date_time, CASE WHEN measurement = 'Water Meter'
    THEN value - lag(value) OVER (PARTITION BY site, measurement ORDER BY date_time) ELSE value END AS vol
  FROM e WHERE measurement IN {ACCEPTED}
    AND date_time BETWEEN TIMESTAMP '{v.MONTH_START}' AND TIMESTAMP '{v.MONTH_START}' + INTERVAL 35 DAY),
k AS ({_calendar("r", v.MONTH_START, "2024-02-12", "site, measurement")}),
h AS (SELECT site, measurement, CAST(date_time AS DATE) AS date, CAST(hour(date_time) AS INTEGER) AS hour,
  count(vol) AS readings, coalesce(sum(vol), CAST(0 AS DOUBLE)) AS volume FROM r GROUP BY ALL),
g AS (SELECT k.site, k.measurement, k.date, coalesce(h.hour, 0) AS hour, coalesce(h.readings, 0) AS readings,
  coalesce(h.volume, CAST(0 AS DOUBLE)) AS volume FROM k LEFT JOIN h USING (site, measurement, date)),
z AS (SELECT *, row_number() OVER (PARTITION BY site, measurement ORDER BY date DESC, hour DESC) AS rn FROM g)
SELECT site, measurement, {iso("date")} AS date, CAST(year(date) AS INTEGER) AS year, hour,
  CAST(year(date) AS VARCHAR) || '/' || CAST(month(date) AS VARCHAR) || '/' || CAST(day(date) AS VARCHAR) AS day,
  strftime(date, '%d') AS day_val, readings, CAST(trunc(volume) AS BIGINT) AS volume_int, {even("volume", 4)} AS volume
FROM z WHERE rn > 1""",
)


def _avg_over(n: str, need: str) -> str:
    frame = f"OVER (PARTITION BY site ORDER BY date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(volume) {frame} >= {need} THEN avg(volume) {frame} END"


_add(
    "moving_avg_30",
    f"SELECT site, {iso('date')} AS date, {even('ma30', 6)} AS ma30 FROM "
    f"(SELECT site, date, {_avg_over('29', '21')} AS ma30 FROM l_grid) q",
)


def _ma_join(grid: str) -> str:
    """Average over each site's own period, by joining each day to its days."""
    return f"""SELECT g.site, g.date, CASE WHEN count(p.volume) = max(lim.return_period)
  THEN sum(p.volume) / CAST(max(lim.return_period) AS DOUBLE) END AS ma
FROM {grid} g JOIN lim ON lim.ext_site_id = split_part(g.site, '-', 1)
JOIN {grid} p ON p.site = g.site AND p.date > g.date - CAST(lim.return_period AS INTEGER) AND p.date <= g.date
GROUP BY g.site, g.date"""


def _rolling(minutes: int, period: str, need: int) -> str:
    """Average over the last steps that have a value, by joining each step to its steps."""
    return f"""WITH h AS (SELECT site, date, CAST(floor((hour(date_time) * 60 + minute(date_time)) / {minutes}) AS INTEGER) AS step,
    count(vol) AS readings, sum(vol) AS volume FROM ev GROUP BY ALL),
p AS (SELECT *, date_diff('day', DATE '1970-01-01', date) * {1440 // minutes} + step AS at, {period} AS period FROM h)
SELECT a.site, {iso("a.date")} AS date, a.step, any_value(a.readings) AS readings, {even("any_value(a.volume)", 6)} AS volume,
  any_value(a.period) AS period, {even(f"CASE WHEN count(b.volume) >= {need} THEN avg(b.volume) END", 6)} AS ma
FROM p a JOIN p b ON a.site = b.site AND b.at > a.at - a.period AND b.at <= a.at GROUP BY a.site, a.date, a.step"""


_add("rolling_avg_hourly", _rolling(60, "24", 12).replace("  any_value(a.period) AS period, ", "  "))
_add("rolling_avg_by_period", _rolling(15, "CAST(4 * (2 + CAST(substr(site, 3, 2) AS INTEGER) % 6) AS INTEGER)", 3))


_add(
    "moving_avg_consent",
    f"""SELECT g.site, {iso("g.date")} AS date, lim.return_period, {even("q.ma", 6)} AS ma FROM l_grid g
LEFT JOIN lim ON lim.ext_site_id = split_part(g.site, '-', 1)
LEFT JOIN ({_ma_join("l_grid")}) q ON q.site = g.site AND q.date = g.date""",
)
_add(
    "daily_stats",
    f"""SELECT site, {iso("date")} AS date, max(measurement) AS measurement, count(vol) AS reports,
  CAST(sum(sd5) AS BIGINT) AS sd5, CAST(sum(sd10) AS BIGINT) AS sd10, CAST(sum(sd20) AS BIGINT) AS sd20
FROM ({_flagged("vol_c")}) f GROUP BY site, f.date""",
)
_add(
    "monthly_extraction",
    f"""SELECT site, strftime(date, '%Y-%m') AS month, {even("min(vol)", 3)} AS min_extraction,
  {even("avg(vol)", 1)} AS mean_extraction, {even("max(vol)", 1)} AS max_extraction FROM l WHERE vol > 0 GROUP BY ALL""",
)
_add("monthly_stats", _monthly("l"))
_add("monthly_stats_stitched", _monthly("vol_c"))
_add("monthly_stats_windowed", _monthly("vol_w"))

_QA_COLUMNS = f"""min(date) FILTER (vol >= 0) AS lo, max(date) FILTER (vol >= 0) AS hi,
  count(DISTINCT date) FILTER (vol >= 0) AS days_with_data, count(*) FILTER (vol >= 0) AS total_reports,
  {even("min(vol) FILTER (vol > 0)", 3)} AS min_extraction, {even("avg(vol) FILTER (vol > 0)", 1)} AS mean_extraction,
  {even("max(vol) FILTER (vol >= 0)", 1)} AS max_extraction, count(*) FILTER (vol < 0) AS negative_values"""
_QA_SHOWN = f"""{iso("lo")} AS start_date, {iso("hi")} AS end_date, CAST(hi - lo + 1 AS DOUBLE) AS total_days,
  CAST(days_with_data AS DOUBLE) AS days_with_data, CAST(total_reports AS DOUBLE) AS total_reports,
  min_extraction, mean_extraction, max_extraction, CAST(negative_values AS DOUBLE) AS negative_values,
  CAST(spikes_sd5 AS DOUBLE) AS spikes_sd5, CAST(spikes_sd10 AS DOUBLE) AS spikes_sd10,
  CAST(spikes_sd20 AS DOUBLE) AS spikes_sd20"""


def _spike_sums(gate: str, vol: str) -> str:
    return ", ".join(f"sum({_flag(k, gate=gate, vol=vol)}) AS spikes_sd{k}" for k in (5, 10, 20))


def _qa_combined(vol: str) -> str:
    return f"""WITH p AS ({_params(vol)}),
s AS (SELECT x.site, count(DISTINCT measurement) FILTER (vol >= 0) AS meas_used, {_QA_COLUMNS},
  {_spike_sums("kept_rows", "x.vol")} FROM {vol} x LEFT JOIN p ON p.site = x.site GROUP BY x.site),
t AS (SELECT site, count(*) AS meas_types FROM proc GROUP BY site)
SELECT req.site, CASE WHEN held.site IS NULL THEN 'N' ELSE 'Y' END AS in_archive,
  CAST(CASE WHEN held.site IS NOT NULL THEN coalesce(meas_types, 0) END AS DOUBLE) AS meas_types,
  CAST(meas_used AS DOUBLE) AS meas_used, {_QA_SHOWN}
FROM req LEFT JOIN held ON held.site = req.site LEFT JOIN s ON s.site = req.site LEFT JOIN t ON t.site = req.site"""


_add("qa_combined", _qa_combined("vol_c"))
_add("nan_readings", _qa_combined("vol_n"))
_add(
    "qa_by_measurement",
    f"""WITH p AS ({_params("vol_c")}),
s AS (SELECT x.site, x.measurement, {_QA_COLUMNS}, {_spike_sums("positive_rows", "x.vol")}
  FROM vol_r x LEFT JOIN p ON p.site = x.site GROUP BY x.site, x.measurement)
SELECT req.site, CASE WHEN held.site IS NULL THEN 'N' ELSE 'Y' END AS in_archive, s.measurement, {_QA_SHOWN}
FROM req LEFT JOIN held ON held.site = req.site LEFT JOIN s ON s.site = req.site""",
)
_add(
    "reporting_mode_annual",
    f"SELECT site, mode, {even('CAST(days AS DOUBLE) / CAST(total AS DOUBLE)', 2)} AS mode_freq FROM win_mode WHERE no = 0",
)
_add("reporting_modes", "SELECT * FROM modes")
_PERC = even(
    "CAST(n - 1 AS DOUBLE) / CAST(nullif(mode, 0) * 7 AS DOUBLE) * CAST(100 AS DOUBLE)", 1
)
_add(
    "weekly_completeness",
    f"SELECT a.site, mode, {_PERC} AS perc_complete, week_last AS last_report FROM all_modes a JOIN wk ON wk.site = a.site "
    "WHERE week_last IS NOT NULL AND mode > 0",
)
_add(
    "weekly_missing_report",
    f"""SELECT a.site, mode,
  CASE WHEN s.site IS NOT NULL AND week_last IS NOT NULL AND mode > 0 THEN {_PERC} END AS perc_complete,
  CASE WHEN s.site IS NULL THEN 'Key error'
       WHEN week_last IS NOT NULL AND mode > 0 THEN NULL
       WHEN week_last IS NOT NULL THEN 'Mode equals 0!'
       WHEN year_last IS NOT NULL THEN 'No data in last week' ELSE 'Value error' END AS status,
  CASE WHEN s.site IS NOT NULL THEN coalesce(week_last, year_last) END AS last_report
FROM all_modes a LEFT JOIN wk_sites s ON s.site = a.site LEFT JOIN wk ON wk.site = a.site""",
)
_add(
    "consents_effective",
    f"SELECT ext_site_id, record_number, {iso('to_date')} AS to_date, consent_status FROM c_eff",
)
_add(
    "consent_limits",
    f"SELECT ext_site_id, {even('max_rate', 2)} AS max_rate, {even('multiday_vol', 2)} AS multiday_vol, return_period, "
    "max_vol FROM lim",
)
ORACLES["consent_site_limits"] = ORACLES["consent_limits"]
_SERIES = f"""site, {iso("date")} AS date, strftime(date, '%Y-%m') AS month, CAST(day(date) AS INTEGER) AS day,
  coalesce(readings, 0) AS readings, volume, {even(f"volume * {RATE}", 6)} AS rate"""
_add(
    "daily_series",
    f"SELECT {_SERIES}, {even('ma30', 6)} AS ma30 FROM (SELECT *, {_avg_over('29', '21')} AS ma30 FROM wy_grid) q",
)
ORACLES["negatives_removed"] = ORACLES["negatives_by_month"]
_add(
    "daily_series_stitched",
    f"""WITH dd AS (SELECT site, date, count(vol) AS readings, sum(vol) AS volume FROM vol_c WHERE vol >= 0 GROUP BY site, date),
k AS (SELECT site, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT site, make_date(year(min(date)) - CASE WHEN month(min(date)) <= 6 THEN 1 ELSE 0 END, 7, 1) AS lo,
    max(date) AS hi FROM dd GROUP BY site) q),
g AS (SELECT k.site, k.date, dd.readings, dd.volume FROM k LEFT JOIN dd USING (site, date))
SELECT site, {iso("date")} AS date, strftime(date, '%Y-%m') AS month, CAST(day(date) AS INTEGER) AS day,
  coalesce(readings, 0) AS readings, {even("volume", 4)} AS volume, {even(f"volume * {RATE}", 4)} AS rate,
  {even("ma30", 4)} AS ma30 FROM (SELECT *, {_avg_over("29", "21")} AS ma30 FROM g) z""",
)
_add(
    "daily_series_null_readings",
    f"SELECT site, {iso('date')} AS date, CAST(readings AS DOUBLE) AS readings FROM wy_grid",
)
_add(
    "daily_series_consent",
    f"""SELECT {_SERIES}, {even("ma", 6)} AS ma, max_vol, ref_line, {even("max_rate", 2)} AS max_rate,
  coalesce(volume > max_vol, false) AS over_max_vol, coalesce(ma > ref_line, false) AS over_ref_line,
  coalesce(volume * {RATE} > max_rate, false) AS over_max_rate
FROM (SELECT g.*, q.ma, lim.max_vol, lim.max_rate,
    {even("lim.multiday_vol / CAST(lim.return_period AS DOUBLE)", 1)} AS ref_line FROM wy_grid g
  LEFT JOIN lim ON lim.ext_site_id = split_part(g.site, '-', 1)
  LEFT JOIN ({_ma_join("wy_grid")}) q ON q.site = g.site AND q.date = g.date) z""",
)
_add(
    "consent_meter_join",
    r"SELECT record_number, ext_site_id, site AS site_name FROM c JOIN held ON "
    r"regexp_extract(upper(site), '[A-Z]+\d\d/\d+', 0) = ext_site_id",
)


def _meter_list(condition: str) -> str:
    return rf"""SELECT record_number, ext_site_id, CAST(from_date AS TIMESTAMP) AS from_date,
  CAST(to_date AS TIMESTAMP) AS to_date, water_use, consent_status, site_name FROM (
  SELECT *, row_number() OVER (PARTITION BY site_name ORDER BY record_number, from_date) AS rn FROM (
    SELECT use_c.*, held.site AS site_name FROM use_c JOIN held ON regexp_extract(upper(held.site), '[A-Z]+\d\d/\d+', 0) = ext_site_id
    WHERE {condition}) j) k WHERE rn = 1"""


_add("meters_from_sites", _meter_list("ext_site_id IN (SELECT split_part(site, '-', 1) FROM req)"))
_add(
    "meters_from_consents",
    _meter_list(
        "record_number IN (SELECT 'CRC' || CAST(l_orderkey AS VARCHAR) FROM lineitem)"
    ),
)
_add(
    "meters_from_catchment",
    _meter_list(
        r"ext_site_id IN (SELECT ext_site_id FROM exts WHERE swaz_name IN ('Zone 1','Zone 2','Zone 3') "
        r"AND regexp_matches(ext_site_id, '[A-Z]+\d\d/\d+'))"
    ),
)
_add(
    "wh_lag",
    "SELECT site_id, attribute_name, data_source, observation_date_time, observation_value, prev_value, prev_time FROM wh_l",
)


def _conversion(src: str) -> str:
    return f"""SELECT site_id, attribute_name, data_source, observation_date_time, {even("measured_value", 6)} AS measured_value,
  {even(f"measured_value * {RATE}", 6)} AS rate, {even("observation_value * CAST(86.4 AS DOUBLE)", 2)} AS max_vol,
  {even("observation_value / nullif(CAST(day(observation_date_time) % 5 AS DOUBLE), 0)", 1)} AS ref_line FROM {src}"""


_add("unit_conversion", _conversion("wh_m"))
_add("unit_conversion_physical", _conversion("wh_p"))
_add(
    "wh_daily_by_source",
    f"SELECT site_id, {iso('date')} AS date, data_source, {even('daily_measured_value', 3)} AS daily_measured_value FROM wh_d",
)


def _reconciled(daily: str, condition: str) -> str:
    return f"""WITH n AS (SELECT site_id, date, count(*) AS duplicate_days, max(daily_measured_value) AS hi,
  min(daily_measured_value) AS lo FROM {daily} WHERE {condition} GROUP BY site_id, date)
SELECT s.site_id, {iso("s.date")} AS date, data_source, {even("daily_measured_value", 3)} AS daily_measured_value,
  duplicate_days, {even("hi", 3)} AS max_value, {even("lo", 3)} AS min_value, {even("hi - lo", 3)} AS difference
FROM {daily} s JOIN n ON n.site_id = s.site_id AND n.date = s.date ORDER BY 1, 2"""


_add("daily_source_reconcile", _reconciled("wh_d", "site_id IN (SELECT site FROM req)"))
_add("wh_null_sources", _reconciled("whn_d", "true"))


def _water_year(x: str) -> str:
    return f"make_date(year({x}) - CASE WHEN month({x}) <= 6 THEN 1 ELSE 0 END, 7, 1)"


_add(
    "calendar_labels",
    f"""SELECT date_time, {iso("date_time")} AS date, CAST(year(date_time) AS INTEGER) AS year,
  CAST(month(date_time) AS INTEGER) AS month_no, CAST(day(date_time) AS INTEGER) AS day_no,
  CAST(hour(date_time) AS INTEGER) AS hour, strftime(date_time, '%Y-%m') AS month,
  CAST(month(date_time) AS VARCHAR) || '/' || CAST(day(date_time) AS VARCHAR) AS month_day,
  CAST(year(date_time) AS VARCHAR) || '/' || CAST(month(date_time) AS VARCHAR) || '/' || CAST(day(date_time) AS VARCHAR)
    AS year_month_day, strftime(date_time, '%d') AS day_val, {iso(_water_year("date_time"))} AS water_year,
  {iso(_water_year("(CAST(date_time AS DATE) + CAST(hour(date_time) * 15 AS INTEGER))"))} AS later_water_year,
  {iso("CAST(date_time AS DATE) - 91")} AS quarter_start, CAST(trunc(value) AS BIGINT) AS whole_value FROM e""",
)
_add(
    "site_name_functions",
    r"""SELECT site, split_part(site, '-', 1) AS external_site,
  nullif(regexp_extract(upper(site), '[A-Z]+\d\d/\d+', 0), '') AS site_id, replace(site, '/', '-') AS file_name,
  trim(site || '  ') AS trimmed, CAST(contains(site, ',') AS INTEGER) AS composite FROM faulty""",
)

# --- day rows, bitmaps and windows -----------------------------------------------------

for _again, _same in (
    ("modes_from_days", "reporting_modes"),
    ("incremental_days", "spike_params"),
    ("weekly_report_from_days", "weekly_missing_report"),
    ("stitched_days_from_stored", "spike_params"),
    ("missing_dates_bitmaps", "missing_dates"),
):
    ORACLES[_again] = ORACLES[_same]

_add(
    "distinct_days_bitmaps",
    f"""SELECT site, count(DISTINCT date) AS days_with_data, {iso("min(date)")} AS start_date, {iso("max(date)")} AS end_date
FROM l GROUP BY site""",
)
_add(
    "daily_series_consent_windowed",
    f"""WITH dd AS (SELECT site, date, count(vol) AS readings, sum(vol) AS volume FROM vol_w WHERE vol >= 0 GROUP BY site, date),
k AS (SELECT site, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT site, make_date(year(min(date)) - CASE WHEN month(min(date)) <= 6 THEN 1 ELSE 0 END, 7, 1) AS lo,
    max(date) AS hi FROM dd GROUP BY site) q),
w_grid AS (SELECT k.site, k.date, dd.readings, dd.volume FROM k LEFT JOIN dd USING (site, date))
SELECT {_SERIES.replace(even(f"volume * {RATE}", 6), even(f"volume * {RATE}", 4)).replace(" volume,", f" {even('volume', 4)} AS volume,")},
  {even("ma", 4)} AS ma, max_vol, ref_line, {even("max_rate", 2)} AS max_rate,
  coalesce(volume > max_vol, false) AS over_max_vol, coalesce(ma > ref_line, false) AS over_ref_line,
  coalesce(volume * {RATE} > max_rate, false) AS over_max_rate
FROM (SELECT g.*, q.ma, lim.max_vol, lim.max_rate,
    {even("lim.multiday_vol / CAST(lim.return_period AS DOUBLE)", 1)} AS ref_line FROM w_grid g
  LEFT JOIN lim ON lim.ext_site_id = split_part(g.site, '-', 1)
  LEFT JOIN ({_ma_join("w_grid")}) q ON q.site = g.site AND q.date = g.date) z""",
)


_FAULTY = f"""(SELECT CASE WHEN n_nationkey % 5 = 4 THEN 'X-' || CAST(n_nationkey AS VARCHAR)
    WHEN n_nationkey % 7 = 6 THEN {_meter("n_nationkey")} || ',' || {_meter("n_nationkey + 1")}
    ELSE {_meter("n_nationkey")} END AS site, 'Zone ' || CAST(n_regionkey AS VARCHAR) AS swaz_name FROM nation) f"""
_add(
    "rejected_readings",
    """SELECT site, measurement, date_time, 'value' AS "column",
  CASE WHEN event_id % 17 = 3 THEN 'NaN' ELSE 'gap' END AS raw,
  CASE WHEN event_id % 17 = 3 THEN 'not a number' ELSE 'no number' END AS reason
FROM e_id WHERE event_id % 17 = 3 OR event_id % 29 = 5""",
)
_add(
    "rejected_permit_dates",
    """SELECT 'CRC' || CAST(o_orderkey AS VARCHAR) AS record_number, 'to_date' AS "column", 'until further notice' AS raw,
  'no date' AS reason FROM orders WHERE o_orderkey % 100 = 77""",
)
_add(
    "rejected_sites",
    f"""SELECT swaz_name, 'site' AS "column", site AS raw,
  CASE WHEN site LIKE '%,%' THEN 'several sites' ELSE 'no site id' END AS reason
FROM {_FAULTY} WHERE site LIKE '%,%' OR site LIKE 'X-%'""",
)
ORACLES["report_read_back"] = ORACLES["monthly_stats"]
_add("site_list_read_back", f"SELECT site FROM {_FAULTY}")
