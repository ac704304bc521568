"""DuckDB SQL with the same results as the queries, on the same tables."""

from __future__ import annotations

from cadenza.functions import geo


def r(expr: str, places: int = 6) -> str:
    """Rounded, with -0.0 turned into 0.0."""
    return f"round({expr}, {places}) + 0.0"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


READINGS = """
readings AS (
  SELECT event_type || '-' || (user_id % 10) AS spot_num, strftime(ts, '%Y%m%d') AS ymd,
    CASE WHEN event_id % 97 = 0 THEN 'x' WHEN event_id % 89 = 0 THEN '24'
         ELSE CAST(hour(ts) AS VARCHAR) END AS hh,
    CAST(user_id % 4 AS VARCHAR) AS lane_num, CAST(user_id % 2 AS VARCHAR) AS io_type,
    CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 = 0 THEN ''
         ELSE CAST(value AS VARCHAR) END AS vol
  FROM events)"""

HOURLY = """
hourly AS (
  SELECT spot_num, datetime, sum(v) AS vol FROM (
    SELECT spot_num, CASE WHEN h BETWEEN 0 AND 23 THEN strptime(ymd, '%Y%m%d') + to_hours(h) END AS datetime, v
    FROM (SELECT *, coalesce(TRY_CAST(hh AS INTEGER), 0) AS h, coalesce(TRY_CAST(vol AS DOUBLE), 0.0) AS v FROM readings))
  WHERE datetime IS NOT NULL GROUP BY spot_num, datetime)"""

HOURLY_STRICT = """
hourly AS (
  SELECT spot_num, datetime, coalesce(sum(v), 0.0) AS vol FROM (
    SELECT spot_num, CASE WHEN h BETWEEN 0 AND 23 THEN strptime(ymd, '%Y%m%d') + to_hours(h) END AS datetime, v
    FROM (SELECT *, TRY_CAST(hh AS INTEGER) AS h, TRY_CAST(vol AS DOUBLE) AS v FROM readings))
  WHERE datetime IS NOT NULL GROUP BY spot_num, datetime)"""

VOLUMES = """
grid AS (
  SELECT spot_num, unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime
  FROM hourly GROUP BY spot_num),
volumes AS (
  SELECT g.spot_num, g.datetime, coalesce(h.vol, 0.0) AS vol
  FROM grid g LEFT JOIN hourly h ON g.spot_num = h.spot_num AND g.datetime = h.datetime)"""

DAILY = """
shipped AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS spot_num, l_shipdate AS datetime, sum(l_quantity) AS vol
  FROM lineitem GROUP BY 1, 2),
days AS (
  SELECT spot_num, unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 DAY)) AS datetime
  FROM shipped GROUP BY spot_num),
daily AS (
  SELECT g.spot_num, g.datetime, coalesce(h.vol, 0.0) AS vol
  FROM days g LEFT JOIN shipped h ON g.spot_num = h.spot_num AND g.datetime = h.datetime)"""

WEATHER = """
station AS (
  SELECT CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN NULL ELSE hour END AS datetime,
    avg(value) FILTER (WHERE event_type = 'view') AS temp_c,
    sum(value) FILTER (WHERE event_type = 'signup') AS rain_mm,
    CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) FILTER (WHERE event_type = 'click') AS BIGINT) % 360 AS wind_dir_deg,
    count(*) AS humidity_pct
  FROM (SELECT *, date_trunc('hour', ts) AS hour FROM events) GROUP BY hour),
station_grid AS (
  SELECT unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime
  FROM station WHERE datetime IS NOT NULL),
station_full AS (
  SELECT g.datetime, s.temp_c, coalesce(s.rain_mm, 0.0) AS rain_mm, CAST(s.wind_dir_deg AS DOUBLE) AS wind_dir_deg,
    sin(radians(s.wind_dir_deg)) AS wind_dir_sin, cos(radians(s.wind_dir_deg)) AS wind_dir_cos,
    CAST(s.humidity_pct AS DOUBLE) AS humidity_pct
  FROM station_grid g LEFT JOIN (SELECT * FROM station WHERE datetime IS NOT NULL) s ON g.datetime = s.datetime),
weather AS (
  SELECT datetime, {fills}, rain_mm FROM station_full
  WINDOW back AS (ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

GAPPY = ["temp_c", "wind_dir_deg", "wind_dir_sin", "wind_dir_cos", "humidity_pct"]
FILLS = ",\n    ".join(
    f"coalesce(last_value({c} IGNORE NULLS) OVER back, first_value({c} IGNORE NULLS) OVER ahead) AS {c}" for c in GAPPY)
WEATHER = WEATHER.format(fills=FILLS)

PANEL = f"""
joined AS (
  SELECT v.spot_num, v.datetime, v.vol, {", ".join("w." + c for c in GAPPY)}, coalesce(w.rain_mm, 0.0) AS rain_mm
  FROM volumes v LEFT JOIN weather w ON v.datetime = w.datetime),
panel AS (
  SELECT spot_num, datetime, vol, {FILLS}, rain_mm FROM joined
  WINDOW back AS (PARTITION BY spot_num ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY spot_num ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

CALENDAR = """
  sin(2 * pi() * hour(datetime) / 24.0) AS hour_sin, cos(2 * pi() * hour(datetime) / 24.0) AS hour_cos,
  sin(2 * pi() * (isodow(datetime) - 1) / 7.0) AS dow_sin, cos(2 * pi() * (isodow(datetime) - 1) / 7.0) AS dow_cos,
  sin(2 * pi() * month(datetime) / 12.0) AS month_sin, cos(2 * pi() * month(datetime) / 12.0) AS month_cos,
  CAST(isodow(datetime) >= 6 AS INTEGER) AS is_weekend"""

FRAME = f"""
frame AS (
  SELECT *, row_number() OVER (PARTITION BY spot_num ORDER BY datetime) - 1 AS rn,
    count(*) OVER (PARTITION BY spot_num) AS n, {CALENDAR}
  FROM panel)"""


def split_of(source: str, name: str = "parts") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (_rn, _n), CASE
      WHEN _rn < floor(_n * CAST(0.7 AS DOUBLE)) THEN 'train'
      WHEN _rn < floor(_n * (CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE))) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY datetime, spot_num) - 1 AS _rn, count(*) OVER () AS _n FROM {source}))"""


BASE = (READINGS, HOURLY, VOLUMES)
FULL = (*BASE, WEATHER, PANEL)
FRAMED = (*FULL, FRAME)
TEST = (*BASE, split_of("volumes"), """
test AS (SELECT spot_num, datetime, vol FROM parts WHERE split = 'test')""")


def metric_columns(by: str = "", places: int | None = 6, base: str = "greatest(abs(y_true), 1e-6)", percent: str = "MAPE") -> str:
    def shown(expr, p=places):
        return r(expr, p) if places else expr
    return f"""{by}
    {shown("avg(abs(y_true - y_pred))")} AS "MAE",
    {shown("sqrt(avg((y_true - y_pred) * (y_true - y_pred)))")} AS "RMSE",
    {shown(f"avg(abs((y_true - y_pred) / ({base}))) * 100", 1)} AS "{percent}" """


def naive(model: str, steps: int) -> str:
    return f"""SELECT '{model}' AS model, spot_num, datetime, vol AS y_true,
      lag(vol, {steps}) OVER (PARTITION BY spot_num ORDER BY datetime) AS y_pred FROM test"""


CANDIDATES = (*TEST, f"""
candidates AS (SELECT * FROM ({naive('Naive_w1', 1)} UNION ALL {naive('Naive_w2', 2)}
  UNION ALL {naive('Naive (w24)', 24)}) WHERE y_pred IS NOT NULL)""")
MODEL_METRICS = (*CANDIDATES, f"""
model_metrics AS (SELECT {metric_columns('model,', None)} FROM candidates GROUP BY model)""")
SPOT_METRICS = (*CANDIDATES, f"""
spot_metrics AS (
  SELECT {metric_columns('spot_num, model,', None, 'greatest(y_true, 1e-6)', 'MAPE(%)')}, count(*) AS n
  FROM candidates GROUP BY spot_num, model HAVING count(*) >= 10)""")

PANEL_OUT = ["vol", *GAPPY, "rain_mm"]
SHORT = ["vol", "hour_sin", "hour_cos", "temp_c"]


def rounds(columns: list[str], places: int = 6) -> str:
    return ", ".join(f"{r(c, places)} AS {c}" for c in columns)


def spread(columns: list[str], source: str, partition: str = "spot_num") -> str:
    """Windows of 24 rows, one row per window and step, for H = 1 and stride 1."""
    return f"""
cells AS (
  SELECT s.{partition.replace(', ', ', s.')}, s.rn AS start, o.datetime AS origin_time, t.datetime AS target_time,
    t.vol AS y, c.rn - s.rn AS step, {", ".join("c." + c for c in columns)}
  FROM {source} s
  JOIN {source} o ON {_same('s', 'o', partition)} AND o.rn = s.rn + 23
  JOIN {source} t ON {_same('s', 't', partition)} AND t.rn = s.rn + 24
  JOIN {source} c ON {_same('s', 'c', partition)} AND c.rn BETWEEN s.rn AND s.rn + 23)"""


def _same(a: str, b: str, partition: str) -> str:
    return " AND ".join(f"{a}.{c.strip()} = {b}.{c.strip()}" for c in partition.split(","))


TRAIN_FRAME = (*FULL, split_of("panel"), f"""
train_frame AS (
  SELECT *, row_number() OVER (PARTITION BY spot_num ORDER BY datetime) - 1 AS rn, {CALENDAR}
  FROM parts WHERE split = 'train')""")


def logged(c: str) -> str:
    return f"ln(1 + greatest({c}, 0.0))"


SCALED = [*SHORT, "rain_mm"]


def value_of(c: str) -> str:
    return logged(c) if c in ("vol", "rain_mm") else c


def scaler_rows(source: str, columns: list[str], logs: list[str], std: str) -> str:
    rows = []
    for c in columns:
        x = logged(c) if c in logs else f"CAST({c} AS DOUBLE)"
        spread_ = std.format(var=f"var_pop({x})")
        rows.append(f"SELECT '{c}' AS feature, {r(f'avg({x})')} AS mean, {r(spread_)} AS std, "
                    f"CAST({int(c in logs)} AS INTEGER) AS log1p FROM {source}")
    return "\nUNION ALL ".join(rows)


FLOORED = "sqrt(greatest({var}, 1e-8))"
FOLD_STD = "CASE WHEN sqrt({var}) < 1e-6 THEN 1.0 ELSE sqrt({var}) END"

IMPORTANCE = (*FRAMED, spread(SHORT, "frame"), f"""
cell_importance AS (
  SELECT * FROM ({" UNION ALL ".join(
      f"SELECT step, '{c}' AS feature, abs(covar_pop({c}, y)) AS importance FROM cells GROUP BY step" for c in SHORT)})),
importance AS (SELECT feature, sum(importance) AS importance FROM cell_importance GROUP BY feature)""")

CORRELATED = ["vol", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "temp_c", "rain_mm", "humidity_pct"]


def lonlat() -> str:
    from math import radians

    k = geo._series_terms()
    return f"""
plane AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS spot_num, s_name AS spot_nm,
    CAST(190000 + (s_suppkey * 137) % 20000 AS DOUBLE) AS grs80tm_x,
    CAST(440000 + (s_suppkey * 211) % 20000 AS DOUBLE) AS grs80tm_y FROM supplier),
mu AS (SELECT *, ({geo._meridian_arc(radians(geo.ORIGIN_LAT))!r}::DOUBLE + (grs80tm_y - {geo.FALSE_NORTHING}::DOUBLE))
    / {k['m_scale']!r}::DOUBLE AS m FROM plane),
foot AS (SELECT *, m + {k['s2']!r}::DOUBLE * sin(2 * m) + {k['s4']!r}::DOUBLE * sin(4 * m)
    + {k['s6']!r}::DOUBLE * sin(6 * m) + {k['s8']!r}::DOUBLE * sin(8 * m) AS f FROM mu),
terms AS (SELECT *, {k['ep2']!r}::DOUBLE * cos(f) * cos(f) AS c, tan(f) * tan(f) AS t,
    1 - {k['e2']!r}::DOUBLE * sin(f) * sin(f) AS w FROM foot),
radii AS (SELECT *, {geo.SEMI_MAJOR}::DOUBLE / sqrt(w) AS n,
    {geo.SEMI_MAJOR * (1 - k['e2'])!r}::DOUBLE / (w * sqrt(w)) AS rho FROM terms),
offset_ AS (SELECT *, (grs80tm_x - {geo.FALSE_EASTING}::DOUBLE) / n AS d FROM radii)
SELECT spot_num, spot_nm, grs80tm_x, grs80tm_y,
  {r(f'''degrees({radians(geo.ORIGIN_LON)!r}::DOUBLE + (d - (1 + 2*t + c) * power(d, 3) / 6
    + (5 - 2*c + 28*t - 3*c*c + 8*{k['ep2']!r}::DOUBLE + 24*t*t) * power(d, 5) / 120) / cos(f))''', 9)} AS lon,
  {r(f'''degrees(f - (n * tan(f) / rho) * (d*d/2 - (5 + 3*t + 10*c - 4*c*c - 9*{k['ep2']!r}::DOUBLE) * power(d, 4) / 24
    + (61 + 90*t + 298*c + 45*t*t - 252*{k['ep2']!r}::DOUBLE - 3*c*c) * power(d, 6) / 720))''', 9)} AS lat
FROM offset_"""


FOLD_BOUNDS = """
targets AS (
  SELECT spot_num, lead(datetime, 24) OVER (PARTITION BY spot_num ORDER BY datetime) AS target_time FROM volumes),
last_day AS (SELECT date_trunc('day', max(target_time)) AS e FROM targets),
folds AS (
  SELECT CAST(k AS INTEGER) AS fold, e - to_days(CAST((4 - k) * 5 + 10 AS INTEGER)) AS train_start,
    e - to_days(CAST((4 - k) * 5 AS INTEGER)) AS train_end, e - to_days(CAST((4 - k) * 5 AS INTEGER)) AS test_start,
    e - to_days(CAST((4 - k) * 5 - 5 AS INTEGER)) AS test_end
  FROM last_day, (SELECT unnest([1, 2, 3]) AS k))"""

BORROWED = """
own AS (
  SELECT date_trunc('hour', ts) AS datetime, 'purchase-' || (user_id % 10) AS spot_num, max(value) AS temp_c
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
gappy AS (
  SELECT v.spot_num, v.datetime, v.vol, o.temp_c FROM volumes v
  LEFT JOIN own o ON v.spot_num = o.spot_num AND v.datetime = o.datetime),
ahead AS (
  SELECT *, last_value(temp_c IGNORE NULLS) OVER (
    PARTITION BY spot_num ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM gappy)"""

HISTOGRAM = """
ends AS (
  SELECT CASE WHEN min(vol) = max(vol) THEN min(vol) - 0.5 ELSE min(vol) END AS lo,
         CASE WHEN min(vol) = max(vol) THEN max(vol) + 0.5 ELSE max(vol) END AS hi FROM volumes),
placed AS (
  SELECT CAST(least(floor((vol - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n
  FROM volumes, ends GROUP BY 1),
bins AS (SELECT CAST(unnest(range(50)) AS INTEGER) AS bin)"""

CHANGING = ["temp_c", "rain_mm", "humidity_pct"]
LAGGED = ["temp_c", "rain_mm", "wind_dir_sin", "wind_dir_cos", "humidity_pct"]

ORACLES = {
    "hourly_sum": with_(READINGS, HOURLY) + f"SELECT spot_num, datetime, {r('vol')} AS vol FROM hourly",
    "hourly_sum_strict": with_(READINGS, HOURLY_STRICT) + f"SELECT spot_num, datetime, {r('vol')} AS vol FROM hourly",
    "densify_hourly": with_(*BASE) + f"SELECT spot_num, datetime, {r('vol')} AS vol FROM volumes",
    "densify_daily": with_(DAILY) + f"SELECT spot_num, datetime, {r('vol')} AS vol FROM daily",
    "extent_by_spot": with_(READINGS, HOURLY)
    + "SELECT spot_num, min(datetime) AS first_time, max(datetime) AS last_time FROM hourly GROUP BY spot_num",
    "history_with_spots": """
SELECT CAST(l_suppkey AS VARCHAR) AS spot_num, l_orderkey AS unit, strftime(l_shipdate, '%Y%m%d') AS "YMD",
  l_linenumber AS "HH", l_quantity AS vol, s_name AS spot_nm,
  CASE WHEN s_suppkey IS NOT NULL THEN CAST(190000 + (s_suppkey * 137) % 20000 AS DOUBLE) END AS grs80tm_x,
  CASE WHEN s_suppkey IS NOT NULL THEN CAST(440000 + (s_suppkey * 211) % 20000 AS DOUBLE) END AS grs80tm_y,
  date_trunc('day', l_shipdate) + to_hours(l_linenumber) AS datetime
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "weather_clean": with_(WEATHER) + f"SELECT datetime, {rounds([*GAPPY, 'rain_mm'])} FROM weather",
    "panel_with_weather": with_(*FULL) + f"SELECT spot_num, datetime, {rounds(PANEL_OUT)} FROM panel",
    "panel_borrowed_weather": with_(*BASE, BORROWED) + f"""
SELECT spot_num, datetime, {r('vol')} AS vol, {r('''coalesce(f, first_value(f IGNORE NULLS) OVER (
    ORDER BY spot_num, datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))''')} AS temp_c FROM ahead""",
    "time_features": with_(*BASE, f"made AS (SELECT *, {CALENDAR} FROM volumes)")
    + f"""SELECT spot_num, datetime, {rounds(['vol', 'hour_sin', 'hour_cos', 'dow_sin', 'dow_cos', 'month_sin', 'month_cos'])},
  is_weekend FROM made""",
    "wind_features": """
WITH station AS (
  SELECT CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN '?'
      ELSE strftime(hour, '%Y-%m-%d %H:%M') END AS hour_text,
    CAST(CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) FILTER (WHERE event_type = 'click') AS BIGINT) % 360 AS VARCHAR) AS wind_dir_deg,
    CAST(count(*) AS DOUBLE) AS humidity_pct
  FROM (SELECT *, date_trunc('hour', ts) AS hour FROM events) GROUP BY hour)
SELECT *, """ + r("sin(radians(coalesce(CAST(wind_dir_deg AS DOUBLE), 0.0)))") + " AS wind_dir_sin, "
    + r("cos(radians(coalesce(CAST(wind_dir_deg AS DOUBLE), 0.0)))") + " AS wind_dir_cos FROM station",
    "delta_features": with_(*FULL) + "SELECT spot_num, datetime, " + ", ".join(
        f"{r(f'coalesce({c} - lag({c}) OVER w, 0.0)')} AS {c}_diff1" for c in CHANGING)
    + " FROM panel WINDOW w AS (PARTITION BY spot_num ORDER BY datetime)",
    "lag_features": with_(*FULL) + "SELECT spot_num, datetime, " + ", ".join(
        f"{r(f'coalesce(lag({c}) OVER w, 0.0)')} AS {c}_lag1" for c in LAGGED)
    + " FROM panel WINDOW w AS (PARTITION BY spot_num ORDER BY datetime)",
    "spot_ids": with_(*BASE) + """
SELECT spot_num, CAST(row_number() OVER (ORDER BY spot_num) - 1 AS INTEGER) AS spot_id, count(*) AS n
FROM volumes GROUP BY spot_num""",
    "id_cardinality": with_(*BASE) + "SELECT CAST(count(DISTINCT spot_num) AS INTEGER) AS n_ids FROM volumes",
    "chrono_split": with_(*BASE, split_of("volumes")) + "SELECT spot_num, datetime, split FROM parts",
    "rolling_folds": with_(*BASE, FOLD_BOUNDS) + """
SELECT f.*, t.n_train, t.n_test, t.n_train >= 1000 AND t.n_test >= 200 AS used
FROM folds f JOIN (
  SELECT fold, count(*) FILTER (WHERE target_time >= train_start AND target_time < train_end) AS n_train,
    count(*) FILTER (WHERE target_time >= test_start AND target_time < test_end) AS n_test
  FROM folds, targets GROUP BY fold) t ON f.fold = t.fold""",
    "backtest_origins": with_(*BASE, """
bounds AS (
  SELECT spot_num, greatest(max(datetime) - to_days(30), min(datetime) + to_hours(25)) AS a, max(datetime) - to_hours(1) AS b
  FROM volumes GROUP BY spot_num HAVING count(*) >= 48)""")
    + "SELECT spot_num, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS origin_time FROM bounds WHERE a <= b",
    "windows_long": with_(*FRAMED, spread(SHORT, "frame"))
    + f"SELECT spot_num, origin_time, CAST(step AS INTEGER) AS step, {rounds(SHORT)} FROM cells",
    "tree_probe": with_(*BASE, """
    pairs AS (
      SELECT CAST(isodow(datetime) >= 6 AS INTEGER) AS is_weekend,
        lead(vol) OVER (PARTITION BY spot_num ORDER BY datetime) AS y FROM volumes)""") + f"""
    SELECT is_weekend, count(*) AS n, {r('avg(y)')} AS lowest, {r('avg(y)')} AS highest
    FROM pairs WHERE y IS NOT NULL GROUP BY is_weekend""",
    "slope_probe": with_(*BASE, f"""
    pairs AS (
      SELECT spot_num, {logged('vol')} AS a, {logged('lead(vol) OVER (PARTITION BY spot_num ORDER BY datetime)')} AS b,
        lead(vol) OVER (PARTITION BY spot_num ORDER BY datetime) AS y FROM volumes)""", """
    centred AS (
      SELECT a - avg(a) OVER (PARTITION BY spot_num) AS a, b - avg(b) OVER (PARTITION BY spot_num) AS c, b,
        avg(b) OVER (PARTITION BY spot_num) AS level FROM pairs WHERE y IS NOT NULL)""", """
    slope AS (SELECT sum(a * c) / sum(a * a) AS s FROM centred)""") + f"""
    SELECT count(*) AS n, {r('sqrt(avg((b - greatest(level + s * a, 0)) * (b - greatest(level + s * a, 0))))', 5)} AS log_rmse
    FROM (SELECT *, (SELECT s FROM slope) AS s FROM centred)""",
    "window_targets": with_(*BASE, """
pos AS (SELECT *, row_number() OVER (PARTITION BY spot_num ORDER BY datetime) - 1 AS rn,
  count(*) OVER (PARTITION BY spot_num) AS n FROM volumes)""") + f"""
SELECT s.spot_num, o.datetime AS origin_time, t.datetime AS target_time, {r('s.vol')} AS first_vol, {r('t.vol')} AS y
FROM pos s JOIN pos o ON s.spot_num = o.spot_num AND o.rn = s.rn + 23
JOIN pos t ON s.spot_num = t.spot_num AND t.rn = s.rn + 25
WHERE s.rn % 3 = 0 AND s.rn < s.n - 24 - 2 + 1""",
    "window_flat": with_(*FRAMED, spread(SHORT, "frame")) + f"""
SELECT spot_num, origin_time, CAST(step * 2 AS INTEGER) AS pos, {r('temp_c')} AS cell FROM cells
UNION ALL SELECT spot_num, origin_time, CAST(step * 2 + 1 AS INTEGER), {r('vol')} FROM cells""",
    "instant_window": with_(*FULL, f"""
ends AS (SELECT spot_num, (SELECT max(datetime) FROM panel) AS end_time FROM panel GROUP BY spot_num),
steps AS (SELECT spot_num, end_time, unnest(generate_series(end_time - INTERVAL 23 HOUR, end_time, INTERVAL 1 HOUR)) AS datetime FROM ends),
made AS (
  SELECT s.spot_num, s.end_time, s.datetime, coalesce(p.vol, 0.0) AS vol, coalesce(p.temp_c, 0.0) AS temp_c,
    coalesce(p.wind_dir_sin, 0.0) AS wind_dir_sin FROM steps s
  LEFT JOIN panel p ON p.spot_num = s.spot_num AND p.datetime = s.datetime),
out_ AS (SELECT *, {CALENDAR} FROM made)""") + f"""
SELECT spot_num, end_time, datetime, {rounds(['vol', 'hour_sin', 'temp_c', 'wind_dir_sin'])},
  CAST(is_weekend AS DOUBLE) AS is_weekend, 0.0::DOUBLE AS spot_id FROM out_""",
    "feature_scaler": with_(*TRAIN_FRAME, spread([*SHORT, "rain_mm"], "train_frame"))
    + scaler_rows("cells", [*SHORT, "rain_mm"], ["vol", "rain_mm"], FLOORED),
    "feature_scaler_fold": with_(*FRAMED, spread([*SHORT, "rain_mm", "humidity_pct"], "frame"), """
fold_cells AS (
  SELECT c.* FROM cells c, (SELECT date_trunc('day', max(datetime)) AS e FROM panel)
  WHERE target_time >= e - INTERVAL 15 DAY AND target_time < e - INTERVAL 5 DAY)""")
    + scaler_rows("fold_cells", [*SHORT, "rain_mm", "humidity_pct"], ["vol", "temp_c", "rain_mm", "humidity_pct"], FOLD_STD),
    "target_scaler": with_(*TRAIN_FRAME) + f"""
SELECT {r(f"avg({logged('vol')})")} AS mean, {r(f"stddev_pop({logged('vol')}) + 1e-8")} AS std
FROM train_frame WHERE rn >= 24""",
    "scaled_panel": with_(*FRAMED, spread(SCALED, "frame"), "state AS (SELECT " + ", ".join(
        f"avg({value_of(c)}) AS m_{c}, sqrt(greatest(var_pop({value_of(c)}), 1e-8)) AS s_{c}" for c in SCALED)
        + " FROM cells)") + "SELECT spot_num, datetime, " + ", ".join(
        f"{r(f'({value_of(c)} - m_{c}) / (s_{c} + 1e-8)')} AS {c}" for c in SCALED) + " FROM frame, state",
    "target_roundtrip": with_(*BASE, f"""
pos AS (SELECT *, row_number() OVER (PARTITION BY spot_num ORDER BY datetime) - 1 AS rn FROM volumes),
state AS (SELECT avg({logged('vol')}) AS m, stddev_pop({logged('vol')}) + 1e-8 AS s FROM pos WHERE rn >= 24)""") + f"""
SELECT spot_num, datetime, {r('vol')} AS vol, {r(f"({logged('vol')} - m) / s")} AS scaled, {r('vol')} AS restored
FROM volumes, state""",
    "naive_last": with_(*TEST) + f"SELECT spot_num, datetime, {r('y_true')} AS y_true, {r('y_pred')} AS y_pred FROM ("
    + naive("m", 1) + ") WHERE y_pred IS NOT NULL",
    "naive_season": with_(DAILY, split_of("daily"), "test AS (SELECT spot_num, datetime, vol FROM parts WHERE split = 'test')")
    + f"SELECT spot_num, datetime, {r('y_true')} AS y_true, {r('y_pred')} AS y_pred FROM ("
    + naive("m", 7) + ") WHERE y_pred IS NOT NULL",
    "metrics_overall": with_(*CANDIDATES) + f"SELECT {metric_columns()} FROM candidates WHERE model = 'Naive_w1'",
    "metrics_by_spot": with_(*SPOT_METRICS)
    + f"""SELECT spot_num, model, {r('"MAE"')} AS "MAE", {r('"RMSE"')} AS "RMSE", {r('"MAPE(%)"', 1)} AS "MAPE(%)", n FROM spot_metrics""",
    "metrics_mean": with_(*SPOT_METRICS)
    + f"""SELECT model, {r('avg("MAE")')} AS "MAE", {r('avg("RMSE")')} AS "RMSE", {r('avg("MAPE(%)")', 1)} AS "MAPE(%)"
FROM spot_metrics GROUP BY model""",
    "model_comparison": with_(*CANDIDATES) + f"SELECT {metric_columns('model,')} FROM candidates GROUP BY model",
    "best_model": with_(*MODEL_METRICS) + f"""
SELECT model, {r('"MAE"')} AS "MAE", {r('"RMSE"')} AS "RMSE", {r('"MAPE"', 1)} AS "MAPE" FROM model_metrics
ORDER BY model_metrics."RMSE", model_metrics."MAPE", model_metrics."MAE" LIMIT 1""",
    "selection_record": with_(*MODEL_METRICS) + f"""
SELECT model AS final_model_name, 'RMSE' AS selected_by, TRY_CAST(regexp_extract(model, 'w([0-9]+)', 1) AS INTEGER) AS "window",
  CAST(1 AS INTEGER) AS horizon, {r('"MAE"')} AS "MAE", {r('"RMSE"')} AS "RMSE", {r('"MAPE"', 1)} AS "MAPE"
FROM model_metrics ORDER BY model_metrics."RMSE", model_metrics."MAPE", model_metrics."MAE" LIMIT 1""",
    "model_tags": with_(*MODEL_METRICS) + f"""
SELECT model, TRY_CAST(regexp_extract(model, 'w([0-9]+)', 1) AS INTEGER) AS "window",
  regexp_replace(model, '[^A-Za-z0-9_-]', '', 'g') AS safe, {r('"MAE"')} AS "MAE" FROM model_metrics""",
    "model_filter": with_(*MODEL_METRICS)
    + f"""SELECT model, {r('"RMSE"')} AS "RMSE" FROM model_metrics WHERE regexp_matches(model, 'w24|W24|w2$')""",
    "importance_by_feature": with_(*IMPORTANCE) + f"""
SELECT feature, {r('importance', 4)} AS importance, {r('importance / sum(importance) OVER () * 100', 4)} AS importance_pct
FROM importance""",
    "topk_features": with_(*IMPORTANCE, """
picked AS (SELECT feature, row_number() OVER (ORDER BY importance DESC, feature) AS p FROM importance WHERE feature <> 'hour_cos'),
every AS (SELECT feature, p FROM picked WHERE p <= 2 UNION ALL SELECT 'vol', -2 UNION ALL SELECT 'is_weekend', -1)""")
    + "SELECT CAST(row_number() OVER (ORDER BY min(p)) AS INTEGER) AS position, feature FROM every GROUP BY feature",
    "overview": with_(*BASE) + """
SELECT count(*) AS n_rows, min(datetime) AS first_time, max(datetime) AS last_time, count(DISTINCT spot_num) AS n_spots FROM volumes""",
    "quality_summary": with_(READINGS, """
typed AS (SELECT spot_num, ymd, TRY_CAST(hh AS DOUBLE) AS hh, lane_num, io_type, TRY_CAST(vol AS DOUBLE) AS vol FROM readings),
totals AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE hh IS NULL) + count(*) FILTER (WHERE vol IS NULL) AS n_missing,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM typed)) AS n_duplicates FROM typed)""") + """
SELECT n_rows, n_missing, round(n_missing * 100.0::DOUBLE / (n_rows * 6), 3) AS missing_pct, n_duplicates,
  round(n_duplicates * 100.0::DOUBLE / n_rows, 3) AS duplicate_pct FROM totals""",
    "histogram_50": with_(*BASE, HISTOGRAM) + f"""
SELECT b.bin, {r('lo + b.bin * ((hi - lo) / 50)')} AS left_edge, {r('lo + (b.bin + 1) * ((hi - lo) / 50)')} AS right_edge,
  coalesce(p.n, 0) AS n FROM bins b CROSS JOIN ends LEFT JOIN placed p ON p.bin = b.bin""",
    "corr_matrix": with_(*FRAMED) + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(f'corr({a}, {b})')} AS correlation FROM frame"
        for a in CORRELATED for b in CORRELATED),
    "mode_spot": with_(READINGS) + "SELECT spot_num, count(*) AS n FROM readings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "top50": with_(*BASE) + f"""
SELECT spot_num, datetime, {r('volumes.vol')} AS vol FROM volumes ORDER BY volumes.vol DESC, spot_num, datetime LIMIT 50""",
    "head50": with_(*BASE) + f"SELECT spot_num, datetime, {r('vol')} AS vol FROM volumes ORDER BY spot_num, datetime LIMIT 50",
    "sorted_spots": with_(READINGS) + "SELECT DISTINCT spot_num FROM readings",
    "label_at_horizon": with_(*BASE) + f"""
SELECT a.spot_num, a.datetime, {r('a.vol')} AS vol, {r('b.vol')} AS y_true FROM volumes a
JOIN volumes b ON a.spot_num = b.spot_num AND b.datetime = a.datetime + INTERVAL 3 HOUR""",
    "forecast_join": with_(*TEST, f"a AS ({naive('a', 1)})", f"b AS ({naive('b', 24)})") + f"""
SELECT a.spot_num, a.datetime, {r('a.y_pred')} AS last_value, {r('b.y_pred')} AS last_day
FROM a JOIN b ON a.spot_num = b.spot_num AND a.datetime = b.datetime WHERE a.y_pred IS NOT NULL""",
    "spots_with_forecast": with_(DAILY) + f"""
SELECT CAST(s_suppkey AS VARCHAR) AS spot_num, s_name AS spot_nm, {r('f.vol')} AS pred_vol FROM supplier
LEFT JOIN (SELECT spot_num, arg_max(vol, datetime) AS vol FROM daily GROUP BY 1) f ON f.spot_num = CAST(s_suppkey AS VARCHAR)""",
    "idle_spots": with_(DAILY) + """
SELECT CAST(s_suppkey AS VARCHAR) AS spot_num FROM supplier WHERE CAST(s_suppkey AS VARCHAR) NOT IN (
  SELECT spot_num FROM shipped WHERE datetime > (SELECT max(datetime) FROM shipped) - INTERVAL 2 DAY)""",
    "union_readings": with_(READINGS, HOURLY, DAILY) + f"""
SELECT 'hourly' AS source, count(*) AS n, {r('sum(vol)', 2)} AS vol FROM hourly
UNION ALL SELECT 'daily', count(*), {r('sum(vol)', 2)} FROM shipped""",
    "tm_to_lonlat": "WITH " + lonlat(),
    "date_functions": """
SELECT event_id,
  CASE WHEN event_id % 27 < 24 THEN date_trunc('day', ts) + to_hours(CAST(event_id % 27 AS INTEGER)) END AS compact,
  CAST(date_trunc('minute', ts) AS TIMESTAMP) AS slashed, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
  CAST(date_trunc('day', ts) + INTERVAL 2 DAY - INTERVAL 5 HOUR AS TIMESTAMP) AS shifted, strftime(ts, '%Y-%m-%d') AS day_text,
  CAST(floor(epoch(ts) / 3600) AS BIGINT) AS tick, CAST(isodow(ts) >= 6 AS INTEGER) AS weekend,
  CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-15') + 1 AS INTEGER) AS days_left FROM events""",
    "value_functions": f"""
SELECT event_id, {r('greatest(value - 20, 0.0)')} AS clipped, {r('ln(1 + greatest(value - 20, 0.0))')} AS logged,
  CAST(round_even(event_id / 2, 0) AS INTEGER) AS half_even,
  CASE WHEN event_id % 1000 < 10 THEN '0' ELSE '' END || CAST(event_id % 1000 AS VARCHAR) AS padded, event_type AS trimmed,
  {r('sin(radians(((event_id * 7 - 900) % 360 + 360) % 360))')} AS bearing_sin,
  {r('cos(radians(((event_id * 7 - 900) % 360 + 360) % 360))')} AS bearing_cos FROM events""",
    "json_records": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events",
    "csv_encodings": with_(READINGS, HOURLY) + f"""
SELECT spot_num, count(*) AS n, {r('sum(vol)', 4)} AS vol, '성산로-' || spot_num AS spot_nm, true AS has_source FROM hourly GROUP BY spot_num""",
    "csv_drift": with_(READINGS, HOURLY) + f"""
SELECT h.spot_num, h.n, h.vol, s.n_lane, s.n_io, s.spot_nm
FROM (SELECT spot_num, count(*) AS n, {r('sum(vol)', 4)} AS vol FROM hourly GROUP BY spot_num) h
JOIN (SELECT spot_num, count(*) FILTER (spot_num NOT LIKE 'error-%') AS n_lane,
    count(*) FILTER (spot_num NOT LIKE 'error-%' AND spot_num NOT LIKE 'view-%') AS n_io,
    CASE WHEN spot_num LIKE 'error-%' THEN '성산로-' || spot_num END AS spot_nm
  FROM readings GROUP BY spot_num) s ON h.spot_num = s.spot_num""",
    "panel_store": with_(*BASE) + f"SELECT spot_num, datetime, {r('vol')} AS vol FROM volumes WHERE spot_num IN ('click-1', 'view-2')",
    "xml_rows": with_(READINGS) + """
SELECT spot_num, ymd, TRY_CAST(hh AS DOUBLE) AS hh, CAST(lane_num AS DOUBLE) AS lane_num, io_type,
  TRY_CAST(vol AS DOUBLE) AS vol, 'pcu' AS unit FROM readings""",
    "pending_work": with_(READINGS) + """
SELECT * FROM (SELECT DISTINCT spot_num FROM readings),
  (SELECT strftime(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)), '%Y%m%d') AS ymd),
  (SELECT lpad(CAST(unnest(range(24)) AS VARCHAR), 2, '0') AS hh)
EXCEPT SELECT spot_num, ymd, lpad(hh, 2, '0') FROM readings""",
    "ingest_resume": with_(READINGS)
    + """SELECT spot_num, count(*) FILTER (ymd <> '20240120') AS total_rows,
  count(DISTINCT CASE WHEN hh <> 'x' AND ymd <> '20240120' THEN ymd || hh END) AS hours_with_rows,
  round(sum(TRY_CAST(vol AS DOUBLE)) FILTER (ymd <> '20240120'), 4) AS total_vol,
  count(DISTINCT hh) FILTER (ymd = '20240120') AS pending
FROM readings GROUP BY 1 HAVING count(*) FILTER (ymd <> '20240120') > 0""",
    "ingest_progress": """
SELECT count(DISTINCT (event_type, user_id % 10, strftime(ts, '%Y%m%d'),
    CASE WHEN event_id % 97 = 0 THEN 'x' WHEN event_id % 89 = 0 THEN '24' ELSE CAST(hour(ts) AS VARCHAR) END, event_id // 1000)) AS total_calls,
  count(*) AS total_rows FROM events""",
    "lag_gappy": with_(READINGS, HOURLY)
    + f"SELECT spot_num, datetime, {r('coalesce(lag(vol) OVER w, 0.0)')} AS vol_lag1 FROM hourly WINDOW w AS (PARTITION BY spot_num ORDER BY datetime)",
}
FOLD_ERRORS = (*BASE, """
pos AS (SELECT *, row_number() OVER (PARTITION BY spot_num ORDER BY datetime) - 1 AS rn FROM volumes)""", FOLD_BOUNDS, """
guesses AS (
  SELECT a.datetime AS t, a.vol AS y_true, b.vol AS y_pred, 'Persist_' || k AS model FROM pos a
  CROSS JOIN (SELECT unnest([1, 24]) AS k) JOIN pos b ON a.spot_num = b.spot_num AND b.rn = a.rn - k WHERE a.rn >= 24)""", f"""
errors AS (
  SELECT fold, model, strftime(train_start, '%Y-%m-%d') AS train_start, strftime(train_end, '%Y-%m-%d') AS train_end,
    strftime(test_start, '%Y-%m-%d') AS test_start, CAST(5 AS INTEGER) AS test_days, {metric_columns('', None)}
  FROM folds JOIN guesses ON t >= test_start AND t < test_end GROUP BY ALL)""")
ORACLES["rolling_naive"] = with_(*FOLD_ERRORS) + f"""
SELECT fold, model, train_start, train_end, test_start, test_days,
  {r('"MAE"')} AS "MAE", {r('"RMSE"')} AS "RMSE", {r('"MAPE"', 1)} AS "MAPE" FROM errors
UNION ALL SELECT 0, model, 'all', 'all', 'all', 15, {r('avg("MAE")')}, {r('avg("RMSE")')}, {r('avg("MAPE")', 1)}
FROM errors GROUP BY model"""
ORACLES["backtest_naive"] = with_(*BASE, """
pos AS (SELECT *, row_number() OVER (PARTITION BY spot_num ORDER BY datetime) - 1 AS rn FROM volumes)""", """
bounds AS (
  SELECT spot_num, greatest(max(datetime) - to_days(30), min(datetime) + to_hours(25)) AS a, max(datetime) - to_hours(1) AS b
  FROM volumes GROUP BY spot_num HAVING count(*) >= 48)""", """
guesses AS (
  SELECT o.spot_num, t.vol AS y_true, g.vol AS y_pred, 'y_' || k AS model
  FROM (SELECT spot_num, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS origin FROM bounds) o
  JOIN pos p ON p.spot_num = o.spot_num AND p.datetime = o.origin
  JOIN pos t ON t.spot_num = p.spot_num AND t.rn = p.rn + 1
  CROSS JOIN (SELECT unnest([1, 24]) AS k)
  JOIN pos g ON g.spot_num = p.spot_num AND g.rn = p.rn + 1 - k)""") + f"""
SELECT spot_num, model, {metric_columns('', 6, 'greatest(y_true, 1e-6)', 'MAPE(%)')}, count(*) AS n
FROM guesses GROUP BY spot_num, model HAVING count(*) >= 10"""
LATEST = """
last_day_values AS (
  SELECT v.spot_num, v.datetime + INTERVAL 24 HOUR AS datetime, v.vol,
    CAST(date_diff('hour', m, v.datetime) + 24 AS INTEGER) AS step
  FROM volumes v JOIN (SELECT spot_num, max(datetime) AS m FROM volumes GROUP BY 1 HAVING count(*) >= 24) e
    ON v.spot_num = e.spot_num WHERE v.datetime > m - INTERVAL 24 HOUR AND v.datetime <= m - INTERVAL 18 HOUR)"""
ORACLES["forecast_naive"] = with_(*BASE, LATEST) + f"SELECT spot_num, step, datetime, {r('vol')} AS pred_vol FROM last_day_values"
ORACLES["busiest_naive"] = with_(*BASE, LATEST) + f"""
SELECT s.spot_num, {r('v.vol')} AS pred_vol FROM (SELECT DISTINCT spot_num FROM readings) s
LEFT JOIN (SELECT * FROM last_day_values WHERE step = 5) v ON v.spot_num = s.spot_num
ORDER BY v.vol DESC NULLS LAST, s.spot_num LIMIT 50"""


def _window_store() -> str:
    y = "({logged} - m) / s".format(logged=logged("vol"))
    x = "({logged} - fm) / (fs + 1e-8)".format(logged=logged("vol"))
    rows = f"""
pos AS (
  SELECT *, row_number() OVER (PARTITION BY split, spot_num ORDER BY datetime) - 1 AS rn,
    count(*) OVER (PARTITION BY split, spot_num) AS n FROM parts),
goal AS (SELECT avg({logged('vol')}) AS m, stddev_pop({logged('vol')}) + 1e-8 AS s FROM pos WHERE split = 'train' AND rn >= 24),
cell AS (
  SELECT avg({logged('c.vol')}) AS fm, sqrt(greatest(var_pop({logged('c.vol')}), 1e-8)) AS fs
  FROM pos a JOIN pos c ON a.split = c.split AND a.spot_num = c.spot_num AND c.rn BETWEEN a.rn AND a.rn + 23
  WHERE a.split = 'train' AND a.rn < a.n - 24),
ends AS (SELECT split, avg(vol) FILTER (WHERE rn >= 24) AS y_raw, avg({y}) FILTER (WHERE rn >= 24) AS y_scaled,
    avg(vol) FILTER (WHERE rn >= 23 AND rn <= n - 2) AS x_raw, avg({x}) FILTER (WHERE rn >= 23 AND rn <= n - 2) AS x_scaled,
    count(*) FILTER (WHERE rn >= 24) AS n_windows FROM pos, goal, cell GROUP BY split)"""
    return with_(*BASE, split_of("volumes"), rows) + f"""
SELECT 'raw' AS variant, split, n_windows, {r('y_raw')} AS mean_y, {r('x_raw')} AS mean_last_vol FROM ends
UNION ALL SELECT 'scaled', split, n_windows, {r('y_scaled')}, {r('x_scaled')} FROM ends"""


ORACLES["window_store"] = _window_store()
ORACLES["metrics_files"] = ORACLES["best_model"]
