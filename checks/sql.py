"""What the registered queries should give, as SQL over the same tables."""

from __future__ import annotations

import math

STEP = "INTERVAL 15 MINUTE"
BASE = f"""base AS (SELECT event_type, time_bucket({STEP}, ts) AS ts, round(avg(value) + 1e-9::DOUBLE, 6) AS y
 FROM events GROUP BY 1, 2)"""
REG = BASE + f""", ends AS (SELECT event_type, min(ts) AS lo, max(ts) AS hi FROM base GROUP BY 1),
spine AS (SELECT event_type, unnest(generate_series(lo, hi, {STEP})) AS ts FROM ends),
reg AS (SELECT s.event_type, s.ts, b.y FROM spine s LEFT JOIN base b USING (event_type, ts))"""
W = "PARTITION BY event_type ORDER BY ts"
FILLED = REG + f""", filled AS (SELECT event_type, ts, coalesce(last_value(y IGNORE NULLS) OVER ({W}),
 first_value(y IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS y FROM reg)"""
DAILY = """daily AS (SELECT o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ts,
 round(avg(o_totalprice) + 1e-9::DOUBLE, 6) AS y FROM orders GROUP BY 1, 2)"""
N_TEST = 1344
LAG_NAMES = {"y_yesterday": 96, "y_last_week": 672, "y_last_year": 34944}


def r(x: str, places: int = 6) -> str:
    """Rounded like queries.rounded: a mean that ends in 5 is moved off the rounding edge."""
    return f"round({x} + 1e-{places + 3}::DOUBLE, {places}) + CAST(0 AS DOUBLE)"


def parts(source: str, n: int = N_TEST) -> str:
    """CTEs train and test of a series CTE."""
    return f"""cut AS (SELECT event_type, max(ts) - {n - 1} * {STEP} AS c FROM {source} GROUP BY 1),
train AS (SELECT s.* FROM {source} s JOIN cut USING (event_type) WHERE ts < c),
test AS (SELECT s.* FROM {source} s JOIN cut USING (event_type) WHERE ts >= c)"""


def naive(name: str, season: int, h: int = N_TEST, train: str = "train") -> str:
    return f"""{name} AS (SELECT f.event_type, f.ts, t.y AS yhat FROM (
 SELECT event_type, last_ts + k * {STEP} AS ts,
  last_ts + (k - CAST(ceil(k / {season}.0) AS BIGINT) * {season}) * {STEP} AS src
 FROM (SELECT event_type, max(ts) AS last_ts FROM {train} GROUP BY 1), range(1, {h + 1}) AS g(k)) f
 LEFT JOIN {train} t ON t.event_type = f.event_type AND t.ts = f.src)"""


ERRORS = """avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
 avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END) AS mape"""
ERRORS_ROUNDED = f"""{r('avg(abs(y - yhat))')} AS mae, {r('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse,
 {r('avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END)')} AS mape,
 count(*) FILTER (y = 0) AS mape_skipped, count(*) AS n"""
LONG = "UNPIVOT (value FOR metric IN (mae, rmse, mape))"

PREDICTIONS = f"""WITH {FILLED}, {parts('filled')}, {naive('d', 96)}, {naive('w', 672)},
long AS (SELECT event_type, ts, 'naive_day' AS model, yhat FROM d
 UNION ALL SELECT event_type, ts, 'naive_week', yhat FROM w
 UNION ALL SELECT event_type, ts, 'naive_blend', (d.yhat + w.yhat) / 2 FROM d JOIN w USING (event_type, ts))"""
PER_MODEL = PREDICTIONS + f""", e AS (SELECT model, {ERRORS} FROM long JOIN test USING (event_type, ts) GROUP BY 1)"""
SCORES = PER_MODEL + """, scores AS (SELECT model, mape, rmse, rmse / m AS nrmse, sqrt(mape * (rmse / m)) AS score
 FROM e, (SELECT avg(y) AS m FROM test))"""

FOLDS = f"""numbered AS (SELECT event_type, ts, y, row_number() OVER ({W}) - 1 AS row_no FROM {{0}}),
n AS (SELECT event_type, count(*) AS n FROM numbered GROUP BY 1),
folds AS (SELECT x.event_type, x.ts, x.y, CAST(f AS BIGINT) AS fold, x.row_no - f + 1 AS fold_step
 FROM numbered x JOIN n USING (event_type) JOIN range(96, 100000, 4) AS g(f)
 ON x.row_no >= f AND x.row_no < f + 8 AND f < n.n - 8)"""
BACKTEST = FOLDS + """, bt AS (SELECT f.event_type, f.ts, f.fold, f.fold_step, f.y, p.y AS yhat
 FROM folds f LEFT JOIN numbered p ON p.event_type = f.event_type AND p.row_no = f.row_no - 96)"""
BACKTEST = BACKTEST.replace("x.row_no - f + 1 AS fold_step", "x.row_no, x.row_no - f + 1 AS fold_step")


def nearest(values: str, q: float) -> str:
    """Element of a sorted list at rank floor((n-1)q + 0.5)."""
    return f"{values}[CAST(floor((len({values}) - 1) * CAST({q} AS DOUBLE) + 0.5) AS BIGINT) + 1]"


def fence(q1: str, q3: str, m: float) -> tuple[str, str]:
    return f"({q1}) - {m}::DOUBLE * (({q3}) - ({q1}))", f"({q3}) + {m}::DOUBLE * (({q3}) - ({q1}))"


LO, HI = fence(nearest("l", 0.25), nearest("l", 0.75), 1.5)
FENCED = f"""f AS (SELECT event_type, {LO} AS lo_b, {HI} AS hi_b FROM
 (SELECT event_type, list_sort(list(y) FILTER (y IS NOT NULL)) AS l FROM base GROUP BY 1))"""


def calendar(ts: str = "ts") -> dict[str, str]:
    hour = f"(hour({ts}) + minute({ts}) / CAST(60 AS DOUBLE))"
    return {
        "decimal_hour": hour, "weekday_int": f"CAST(isodow({ts}) AS INTEGER)",
        "dayofyear_int": f"CAST(dayofyear({ts}) AS INTEGER)",
    }


def cyclic(ts: str = "ts") -> dict[str, str]:
    c = calendar(ts)
    out = {}
    for name, x, p in (("hour", c["decimal_hour"], 24), ("weekday", c["weekday_int"], 7), ("dayofyear", c["dayofyear_int"], 365)):
        out[f"sin_{name}"] = f"sin({x} * {2 * math.pi / p!r}::DOUBLE)"
        out[f"cos_{name}"] = f"cos({x} * {2 * math.pi / p!r}::DOUBLE)"
    return out


def columns(exprs: dict[str, str], rounded: bool = True) -> str:
    return ", ".join(f"{r(x) if rounded else x} AS {n}" for n, x in exprs.items())


def fourier() -> dict[str, str]:
    c = calendar()
    out = {}
    for prefix, x, p, top in (("d", c["decimal_hour"], 24, 5), ("y", c["dayofyear_int"], 365.25, 4)):
        for k in range(1, top + 1):
            out[f"{prefix}_sin_k{k}"] = f"sin({x} * {2 * math.pi * k / p!r}::DOUBLE)"
            out[f"{prefix}_cos_k{k}"] = f"cos({x} * {2 * math.pi * k / p!r}::DOUBLE)"
    return out


def lagged(source: str, lags: dict[str, int], cols: str = "s.*", step: str = STEP, key: str = "event_type") -> str:
    joins = " ".join(f"LEFT JOIN {source} l{i} ON l{i}.{key} = s.{key} AND l{i}.ts = s.ts - {k} * {step}"
                     for i, k in enumerate(lags.values()))
    values = ", ".join(f"{r(f'l{i}.y')} AS {n}" for i, n in enumerate(lags))
    return f"SELECT {cols}, {values} FROM {source} s {joins}"


BAD = "ts IN (TIMESTAMP '2024-01-10 12:00:00', TIMESTAMP '2024-01-20 06:15:00')"


def interpolated(source: str) -> str:
    """CTEs giving column line for a numbered series."""
    return f"""ip AS (SELECT *, row_number() OVER ({W}) AS rn FROM {source}),
iq AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN rn END IGNORE NULLS) OVER ({W}) AS rb,
 last_value(y IGNORE NULLS) OVER ({W}) AS vb,
 first_value(CASE WHEN y IS NOT NULL THEN rn END IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ra,
 first_value(y IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS va FROM ip),
lines AS (SELECT *, CASE WHEN y IS NOT NULL THEN y WHEN ra IS NOT NULL AND rb IS NOT NULL
 THEN vb + (va - vb) * ((rn - rb) / (ra - rb)::DOUBLE) END AS line FROM iq)"""


def gaps(source: str) -> str:
    return f"""SELECT event_type, ts + {STEP} AS missing_start, nxt - {STEP} AS missing_end,
 (epoch(nxt) - epoch(ts))::BIGINT // 900 - 1 AS missing_points
 FROM (SELECT event_type, ts, lead(ts) OVER ({W}) AS nxt FROM {source}) WHERE nxt > ts + {STEP}"""


def chunked(source: str, name: str, value: str = "y") -> str:
    return f"""{name} AS (SELECT event_type, part, v FROM (
 SELECT event_type, (row_number() OVER ({W}) - 1) // 96 AS part, {value} AS v FROM {source}) WHERE v IS NOT NULL)"""


def ks(name: str, chunks: str, ref: str = "train", value: str = "y") -> str:
    return f"""{name} AS (SELECT event_type, part, max(greatest(
  abs(le / nr::DOUBLE - cle / nc::DOUBLE), abs(lt / nr::DOUBLE - clt / nc::DOUBLE))) AS statistic FROM (
 SELECT c.event_type, c.part, c.v,
  (SELECT count(*) FROM {ref} t WHERE t.event_type = c.event_type AND t.{value} <= c.v) AS le,
  (SELECT count(*) FROM {ref} t WHERE t.event_type = c.event_type AND t.{value} < c.v) AS lt,
  (SELECT count(t.{value}) FROM {ref} t WHERE t.event_type = c.event_type) AS nr,
  (SELECT count(*) FROM {chunks} d WHERE d.event_type = c.event_type AND d.part = c.part AND d.v <= c.v) AS cle,
  (SELECT count(*) FROM {chunks} d WHERE d.event_type = c.event_type AND d.part = c.part AND d.v < c.v) AS clt,
  (SELECT count(*) FROM {chunks} d WHERE d.event_type = c.event_type AND d.part = c.part) AS nc
 FROM {chunks} c) GROUP BY 1, 2)"""


JS_REF = """edges AS (SELECT event_type, min(y) AS lo, max(y) AS hi, count(y) AS nref FROM train GROUP BY 1),
bin_no AS (SELECT 0 AS b UNION ALL SELECT unnest(range(1, 21))),
pref AS (SELECT event_type, b, count(*) / first(nref)::DOUBLE AS p FROM (
 SELECT t.event_type, nref, least(CAST(floor((y - lo) / (hi - lo) * 20) AS BIGINT) + 1, 20) AS b
 FROM train t JOIN edges USING (event_type) WHERE y IS NOT NULL) GROUP BY 1, 2)"""


def js(name: str, chunks: str) -> str:
    """All bins, occupied or not."""
    return f"""{name} AS (SELECT event_type, part, sqrt(greatest(sum(
  CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS statistic
 FROM (SELECT k.event_type, k.part, bin_no.b, coalesce(p, 0) AS p, coalesce(c, 0) / k.size::DOUBLE AS q
  FROM (SELECT event_type, part, count(*) AS size FROM {chunks} GROUP BY 1, 2) k CROSS JOIN bin_no
  LEFT JOIN pref ON pref.event_type = k.event_type AND pref.b = bin_no.b
  LEFT JOIN (SELECT event_type, part, b, count(*) AS c FROM (SELECT x.event_type, x.part,
    CASE WHEN v < lo OR v > hi THEN 0 ELSE least(CAST(floor((v - lo) / (hi - lo) * 20) AS BIGINT) + 1, 20) END AS b
    FROM {chunks} x JOIN edges USING (event_type)) GROUP BY 1, 2, 3) o
   ON o.event_type = k.event_type AND o.part = k.part AND o.b = bin_no.b) GROUP BY 1, 2)"""


def alerts(method: str, found: str, ref: str) -> str:
    return f"""SELECT event_type, '{method}' AS method, part, {r('statistic')} AS statistic, {r('lower_limit')} AS lower_limit,
 {r('upper_limit')} AS upper_limit, statistic > upper_limit OR statistic < lower_limit AS alert
 FROM {found} JOIN (SELECT event_type, greatest(avg(statistic) - 3 * stddev_pop(statistic), 0) AS lower_limit,
 avg(statistic) + 3 * stddev_pop(statistic) AS upper_limit FROM {ref} GROUP BY 1) USING (event_type)"""


def box(source: str, by: str, v: str) -> str:
    return f"""WITH x AS (SELECT {by} AS g, {v} AS v FROM {source}),
q AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3 FROM x GROUP BY 1),
z AS (SELECT x.g, v, q1, med, q3, v BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS ok FROM x JOIN q USING (g))"""


def box_select(name: str) -> str:
    return f"""SELECT CAST(g AS INTEGER) AS {name}, {r('min(v)')} AS min_value, {r('first(q1)')} AS q1, {r('first(med)')} AS med,
 {r('first(q3)')} AS q3, {r('max(v)')} AS max_value, {r('min(v) FILTER (ok)')} AS whisker_low,
 {r('max(v) FILTER (ok)')} AS whisker_high, count(*) FILTER (NOT ok) AS outliers, count(*) AS n FROM z GROUP BY g"""


PHASES = "((epoch(ts)::BIGINT // 900) % {0})"
DECOMPOSED = FILLED + f""", t AS (SELECT event_type, ts, y, avg(y) OVER ({W} ROWS BETWEEN 10080 PRECEDING AND 10079 FOLLOWING) AS trend FROM filled),
d0 AS (SELECT *, y - trend AS a, {PHASES.format(96)} AS p1, {PHASES.format(672)} AS p2, {PHASES.format(20160)} AS p3 FROM t),
m1 AS (SELECT event_type, p1, avg(a) AS m FROM d0 GROUP BY 1, 2),
s1 AS (SELECT event_type, p1, m - avg(m) OVER (PARTITION BY event_type) AS s FROM m1),
d1 AS (SELECT d0.*, s AS seasonal_96, a - s AS b FROM d0 JOIN s1 USING (event_type, p1)),
m2 AS (SELECT event_type, p2, avg(b) AS m FROM d1 GROUP BY 1, 2),
s2 AS (SELECT event_type, p2, m - avg(m) OVER (PARTITION BY event_type) AS s FROM m2),
d2 AS (SELECT d1.*, s AS seasonal_672, b - s AS g FROM d1 JOIN s2 USING (event_type, p2)),
m3 AS (SELECT event_type, p3, avg(g) AS m FROM d2 GROUP BY 1, 2),
s3 AS (SELECT event_type, p3, m - avg(m) OVER (PARTITION BY event_type) AS s FROM m3),
d3 AS (SELECT d2.*, s AS seasonal_20160, g - s AS remainder FROM d2 JOIN s3 USING (event_type, p3))"""

Z = FILLED + f""", zz AS (SELECT s.event_type, s.ts, s.y - p.y AS z FROM filled s JOIN filled p
 ON p.event_type = s.event_type AND p.ts = s.ts - 96 * {STEP}),
zr AS (SELECT *, CASE WHEN count(z) OVER ({W} ROWS 3 PRECEDING) >= 4 THEN avg(z) OVER ({W} ROWS 3 PRECEDING) END AS m4,
 CASE WHEN count(z) OVER ({W} ROWS 7 PRECEDING) >= 8 THEN stddev_samp(z) OVER ({W} ROWS 7 PRECEDING) END AS s8,
 list_reduce(list(z) OVER ({W} ROWS 53 PRECEDING), lambda a, x: a * 0.5::DOUBLE + x * 0.5::DOUBLE) AS e FROM zz)"""

# ---- the sheets made from orders -------------------------------------------

MON = "strftime(o_orderdate, '%b')"
P = "substr(o_orderpriority, 1, 1)"
SHEET_KEY = f"""(year(o_orderdate) || '/' || {MON} || '/' || CASE {P}
 WHEN '2' THEN 'H_' || strftime(o_orderdate, '%Y%m%d')
 WHEN '3' THEN 'F_' || strftime(o_orderdate, '%d-02-%Y_') || {MON}
 ELSE 'F_' || strftime(o_orderdate, '%d-%m-%Y') END || '_p' || {P})"""
DAY_TEXT = f"""(day(o_orderdate) || '-' || CASE WHEN month(o_orderdate) = 9 THEN 'Sept' ELSE {MON} END || '-' || year(o_orderdate))"""
FEBRUARY = "try_strptime(strftime(o_orderdate, '%Y-02-%d'), '%Y-%m-%d')"
SHEET_DATE = f"(CASE {P} WHEN '3' THEN {FEBRUARY} ELSE o_orderdate END)"
PERIOD_OF = lambda k: (f"(lpad((({k}) // 4)::VARCHAR, 2, '0') || ':' || lpad(((({k}) % 4) * 15)::VARCHAR, 2, '0'))")
START = PERIOD_OF("o_orderkey % 96")
PERIOD = f"({START} || CASE WHEN o_orderkey % 2 = 0 THEN ' - ' ELSE '-' END || {PERIOD_OF('(o_orderkey + 1) % 96')})"
BAD_ROW = f"({P} = '5' AND o_orderstatus = 'P' AND o_custkey % 10 <> 0)"
SHEETS = f"""WITH o AS (SELECT *, {SHEET_KEY} AS k, {SHEET_DATE} AS sd FROM orders),
checks AS (SELECT k AS partition_key, NOT (first({P}) = '4' AND first(month(o_orderdate)) = 7) AND count(*) FILTER {BAD_ROW.replace('(', '(', 1)} = 0 AS is_valid,
 CASE WHEN first({P}) = '4' AND first(month(o_orderdate)) = 7 THEN 'title'
  WHEN count(*) FILTER {BAD_ROW} > 0 THEN 'data rows' WHEN first(sd) IS NULL THEN 'date' END AS reason,
 count(*) AS data_rows, count(*) FILTER {BAD_ROW} AS bad_rows, first({DAY_TEXT}) AS date_cell, first(sd) AS sheet_date
 FROM o GROUP BY 1),
prim AS (SELECT sd AS date, {PERIOD} AS period, CASE WHEN o_custkey % 10 <> 0 THEN round(o_totalprice, 2) END AS actual_demand_mw,
 o_custkey::DOUBLE AS nrldc_intraday_forecasted_demand_mw, k AS source_key, {START} AS start_text
 FROM o JOIN checks ON k = partition_key WHERE is_valid AND sd IS NOT NULL)"""

LISTED = f"""WITH l AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, {MON} AS month,
 strftime(o_orderdate, '%Y_%m') AS ym, 'F_' || o_orderkey || '.xlsx' AS file_name, o_custkey || ' KB' AS size,
 strftime(o_orderdate, '%Y-%m-%d') AS file_date,
 CASE o_orderkey % 3 WHEN 0 THEN '/files/' || o_orderkey WHEN 1 THEN 'files/' || o_orderkey
  ELSE 'https://other.example/' || o_orderkey END AS download_link,
 CASE o_orderkey % 3 WHEN 2 THEN '' ELSE 'https://base.example/files/' || o_orderkey END AS fixed,
 year(o_orderdate) || '/' || {MON} || '/F_' || o_orderkey AS file_key FROM orders
 UNION ALL SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER), {MON}, strftime(o_orderdate, '%Y_%m'),
 'G_' || o_orderkey || '.XLSX', '1 KB', '', '', '', NULL FROM orders)"""

SQL: dict[str, str] = {}

SQL["hourly_forecast_quality"] = f"""WITH h AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS ts, round(avg(value) + 1e-9::DOUBLE, 6) AS y FROM events GROUP BY 1, 2),
e AS (SELECT event_type, min(ts) AS lo, max(ts) AS hi FROM h GROUP BY 1),
g AS (SELECT s.event_type, s.ts, last_value(y IGNORE NULLS) OVER (PARTITION BY s.event_type ORDER BY s.ts) AS y
 FROM (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM e) s LEFT JOIN h USING (event_type, ts)),
pairs AS (SELECT g.event_type, g.y, t.y AS yhat FROM g JOIN e USING (event_type)
 JOIN g t ON t.event_type = g.event_type AND t.ts = g.ts - CASE WHEN g.ts > hi - INTERVAL 24 HOUR THEN INTERVAL 48 HOUR ELSE INTERVAL 24 HOUR END
 WHERE g.ts > hi - INTERVAL 48 HOUR),
gap AS (SELECT event_type, count(*) AS gap_blocks, sum(d)::BIGINT AS missing_hours FROM (
 SELECT event_type, (epoch(lead(ts) OVER ({W})) - epoch(ts))::BIGINT // 3600 - 1 AS d FROM h) WHERE d > 0 GROUP BY 1)
SELECT p.event_type, 'seasonal_naive' AS model, {ERRORS_ROUNDED},
 coalesce(first(gap_blocks), 0) AS gap_blocks, coalesce(first(missing_hours), 0) AS missing_hours
FROM pairs p LEFT JOIN gap ON gap.event_type = p.event_type GROUP BY 1"""

SQL["spine_quarter_hour"] = f"WITH {REG} SELECT * FROM reg"
SQL["missing_slots"] = f"WITH {REG} SELECT event_type, ts FROM reg WHERE y IS NULL"
SQL["gap_blocks"] = f"WITH {BASE} {gaps('base')}"
SQL["gap_blocks_null_values"] = f"""WITH {REG}, have AS (SELECT event_type, ts FROM reg WHERE y <= 20
 UNION ALL SELECT event_type, lo - {STEP} FROM ends UNION ALL SELECT event_type, hi + {STEP} FROM ends) {gaps('have')}"""
SQL["completeness"] = f"""WITH {REG} SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS expected, count(y) AS present,
 count(*) - count(y) AS missing, count(*) = count(y) AS is_complete FROM reg GROUP BY 1"""
SQL["time_since_previous"] = f"""WITH {BASE} SELECT *, (epoch(ts) - epoch(lag(ts) OVER ({W})))::BIGINT AS seconds_since_previous FROM base"""
SQL["order_violations"] = """SELECT event_type, count(*) AS n_rows, count(*) FILTER (back) AS violations, count(*) FILTER (back) = 0 AS is_sorted
 FROM (SELECT event_type, ts < lag(ts) OVER (PARTITION BY event_type ORDER BY event_id) AS back FROM events) GROUP BY 1"""
SQL["gap_block_ids"] = f"""WITH {BASE}, b AS (SELECT *, CASE WHEN ts - lag(ts) OVER ({W}) > {STEP} THEN 1 ELSE 0 END AS f FROM base)
 SELECT event_type, ts, CAST(sum(f) OVER ({W}) AS BIGINT) AS block_id FROM b"""
SQL["row_positions"] = f"WITH {BASE} SELECT event_type, ts, row_number() OVER ({W}) - 1 AS row_no FROM base"
SQL["future_frame"] = f"""WITH {BASE} SELECT event_type, hi + k * {STEP} AS ts, CAST(k AS INTEGER) AS horizon_step
 FROM (SELECT event_type, max(ts) AS hi FROM base GROUP BY 1), range(1, 97) AS g(k)"""
for keep, direction in (("first", "ASC"), ("last", "DESC")):
    SQL[f"dedup_{keep}"] = f"""SELECT event_type, date_trunc('hour', ts) AS ts, event_id, user_id, value FROM events
 QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id {direction}) = 1"""
SQL["full_duplicates"] = """SELECT l_partkey, l_quantity, l_returnflag, l_tax, count(*) AS copies FROM lineitem
 GROUP BY 1, 2, 3, 4 HAVING count(*) > 1"""

SQL["calendar_features"] = f"""WITH {BASE} SELECT event_type, ts, {r('y')} AS y, {r(calendar()['decimal_hour'])} AS decimal_hour,
 {calendar()['weekday_int']} AS weekday_int, {calendar()['dayofyear_int']} AS dayofyear_int, {columns(cyclic())},
 CAST(month(ts) AS INTEGER) AS month_int, CAST(day(ts) AS INTEGER) AS dayofmonth_int, CAST(year(ts) AS INTEGER) AS year_int,
 dayname(ts) AS day_name, CAST(hour(ts) * 3600 + minute(ts) * 60 AS INTEGER) AS second_of_day,
 month(ts) IN (11, 12, 1, 2, 3) AS is_high_volatility_season FROM base"""
SQL["fourier_features"] = f"WITH {BASE} SELECT event_type, ts, {columns(fourier())} FROM base"
SQL["season_flag"] = f"""WITH {DAILY} SELECT o_orderstatus, ts, CAST(month(ts) IN (11, 12, 1, 2, 3) AS TINYINT) AS is_high_variance_season,
 {r('ln(1 + y)')} AS y_log FROM daily"""
SQL["lag_features"] = f"WITH {REG} " + lagged("reg", LAG_NAMES)
SQL["lag_year_daily"] = f"""WITH {DAILY}, g AS (SELECT s.o_orderstatus, s.ts, y FROM (SELECT o_orderstatus,
 unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM daily GROUP BY 1) s LEFT JOIN daily USING (o_orderstatus, ts))
 """ + lagged("g", {"y_last_week": 7, "y_last_year": 364}, step="INTERVAL 1 DAY", key="o_orderstatus")
SQL["lag_pairs"] = f"WITH {REG} " + lagged("reg", {"lag_1": 1, "lag_2": 2, "lag_97": 97})
SQL["baseline_features"] = f"""WITH {REG}, ok AS (SELECT event_type, ts, CASE WHEN NOT ({BAD}) THEN y END AS y FROM reg)
 """ + lagged("ok", LAG_NAMES, "s.event_type, s.ts, s.y, " + ", ".join(
    f"{x} AS {n}" for n, x in calendar("s.ts").items() if n != "decimal_hour")
    + f", {r(calendar('s.ts')['decimal_hour'])} AS decimal_hour, " + columns(cyclic("s.ts")))
SQL["known_bad_to_null"] = f"WITH {BASE} SELECT event_type, ts, CASE WHEN NOT ({BAD}) THEN y END AS y FROM base"
SQL["flag_update"] = f"WITH {REG} SELECT event_type, ts, y, {BAD} OR y IS NULL AS is_imputed FROM reg"
SQL["rolling_trend"] = f"""WITH {REG} SELECT event_type, ts, y,
 {r(f'avg(y) OVER ({W} ROWS BETWEEN 336 PRECEDING AND 335 FOLLOWING)')} AS macro_trend FROM reg"""
SQL["rolling_volatility"] = f"""WITH {FILLED} SELECT event_type, ts, y, CASE WHEN count(y) OVER ({W} ROWS 671 PRECEDING) >= 672
 THEN {r(f'stddev_samp(y) OVER ({W} ROWS 671 PRECEDING)')} END AS rolling_volatility FROM filled"""
SQL["lag_transforms"] = f"""WITH {Z} SELECT event_type, ts, {r('z')} AS z, """ + ", ".join(
    f"{r(f'lag({c}, {k}) OVER ({W})')} AS {n}" for n, c, k in (
        ("lag_1", "z", 1), ("lag_96", "z", 96), ("lag_97", "z", 97), ("lag_672", "z", 672), ("lag1_mean4", "m4", 1),
        ("lag1_ewm", "e", 1), ("lag96_mean4", "m4", 96), ("lag96_std8", "s8", 96))) + " FROM zr"
SQL["seasonal_difference"] = f"""WITH {REG} SELECT s.event_type, s.ts, s.y, {r('s.y - p.y')} AS seasonal_residual
 FROM reg s JOIN reg p ON p.event_type = s.event_type AND p.ts = s.ts - 96 * {STEP} WHERE s.y IS NOT NULL AND p.y IS NOT NULL"""
SQL["difference_restored"] = f"WITH {FILLED}, {parts('filled')} SELECT event_type, ts, {r('y', 4)} AS restored FROM test"

SQL["forward_fill"] = f"WITH {REG} SELECT event_type, ts, last_value(y IGNORE NULLS) OVER ({W}) AS y FROM reg"
SQL["backward_fill"] = f"""WITH {REG} SELECT event_type, ts,
 first_value(y IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS y FROM reg"""
SQL["repair_fill"] = f"""WITH {BASE}, {FENCED}, kept AS (SELECT b.* FROM base b JOIN f USING (event_type) WHERE y >= lo_b AND y <= hi_b),
sp AS (SELECT event_type, unnest(generate_series(min(ts), max(ts), {STEP})) AS ts FROM kept GROUP BY 1)
SELECT s.event_type, s.ts, last_value(k.y IGNORE NULLS) OVER (PARTITION BY s.event_type ORDER BY s.ts) AS y
FROM sp s LEFT JOIN kept k USING (event_type, ts)"""
SQL["interpolate"] = f"WITH {REG}, {interpolated('reg')} SELECT event_type, ts, {r('line')} AS y FROM lines"
SQL["outlier_interpolate"] = f"""WITH {FILLED}, ok AS (SELECT event_type, ts, CASE WHEN NOT ({BAD}) THEN y END AS y FROM filled),
{interpolated('ok')} SELECT event_type, ts, {r('line')} AS y FROM lines"""
SQL["seasonal_median_impute"] = f"""WITH {REG}, {interpolated('reg')},
tr AS (SELECT event_type, ts, y, avg(line) OVER ({W} ROWS BETWEEN 336 PRECEDING AND 335 FOLLOWING) AS t FROM lines)
SELECT event_type, ts, y, y IS NULL AS is_imputed,
 {r('coalesce(y, t + median(y - t) OVER (PARTITION BY event_type, isodow(ts), CAST(ts AS TIME)))')} AS y_filled FROM tr"""
SQL["zero_fill"] = f"WITH {REG} SELECT event_type, ts, coalesce(y, 0) AS y FROM reg"
SQL["drop_incomplete_rows"] = f"""WITH {REG} SELECT s.event_type, s.ts, s.y, p.y AS y_yesterday FROM reg s JOIN reg p
 ON p.event_type = s.event_type AND p.ts = s.ts - 96 * {STEP} WHERE s.y IS NOT NULL AND p.y IS NOT NULL"""

_lo, _hi = fence("q1", "q3", 0.5)
SQL["iqr_fence"] = f"""WITH l AS (SELECT l_returnflag, list_sort(list(l_extendedprice)) AS l FROM lineitem GROUP BY 1),
q AS (SELECT l_returnflag, {nearest('l', 0.25)} AS q1, {nearest('l', 0.75)} AS q3 FROM l),
b AS (SELECT *, {_lo} AS lower_bound, {_hi} AS upper_bound FROM q)
SELECT b.l_returnflag, {r('first(q1)')} AS q1, {r('first(q3)')} AS q3, {r('first(lower_bound)')} AS lower_bound,
 {r('first(upper_bound)')} AS upper_bound,
 count(*) FILTER (l_extendedprice < lower_bound OR l_extendedprice > upper_bound) AS n_outside,
 count(*) FILTER (l_extendedprice BETWEEN lower_bound AND upper_bound) AS n_inside
FROM lineitem JOIN b USING (l_returnflag) GROUP BY 1"""
SQL["quantiles_three_ways"] = f"""WITH l AS (SELECT l_returnflag, l_linestatus, list_sort(list(l_extendedprice)) AS l FROM lineitem GROUP BY 1, 2),
q AS (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS q)
SELECT l_returnflag, l_linestatus, q, {r("l[CAST(floor((len(l) - 1) * q + 0.5) AS BIGINT) + 1]")} AS value, 'nearest' AS mode FROM l, q
UNION ALL SELECT l_returnflag, l_linestatus, q, {r("l[greatest(CAST(ceil(len(l) * q) AS BIGINT) - 1, 0) + 1]")}, 'disc' FROM l, q
UNION ALL SELECT l_returnflag, l_linestatus, q, {r("l[CAST(floor((len(l) - 1) * q) AS BIGINT) + 1] * (1 - ((len(l) - 1) * q - floor((len(l) - 1) * q)))"
  " + l[CAST(ceil((len(l) - 1) * q) AS BIGINT) + 1] * ((len(l) - 1) * q - floor((len(l) - 1) * q))")}, 'linear' FROM l, q"""
SQL["null_outliers"] = f"""WITH {BASE}, {FENCED} SELECT event_type, ts, CASE WHEN NOT (y < lo_b OR y > hi_b) THEN y END AS y,
 y < lo_b OR y > hi_b AS is_outlier FROM base JOIN f USING (event_type)"""

SQL["train_split"] = f"WITH {REG}, {parts('reg')} SELECT * FROM train"
SQL["test_split"] = f"WITH {REG}, {parts('reg')} SELECT * FROM test"
SQL["tuning_split"] = f"""WITH {REG}, {parts('reg', 96)} SELECT event_type, 'held' AS part, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
 FROM test GROUP BY 1 UNION ALL SELECT event_type, 'fit', count(*), min(ts), max(ts) FROM train GROUP BY 1"""
SQL["cv_folds"] = f"WITH {REG}, {FOLDS.format('reg')} SELECT * FROM folds"
SQL["fold_names"] = f"WITH {REG}, {FOLDS.format('reg')} SELECT DISTINCT fold FROM folds"
SQL["seasonal_naive"] = f"WITH {REG}, {parts('reg')}, {naive('d', 96)} SELECT event_type, ts, 'seasonal_naive' AS model, yhat FROM d"
SQL["naive_metrics"] = f"""WITH {REG}, {parts('reg')}, {naive('d', 96)} SELECT event_type, 'seasonal_naive' AS model, {ERRORS_ROUNDED}
 FROM d JOIN test USING (event_type, ts) WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1"""
SQL["left_joined_predictions"] = f"""WITH {REG}, {parts('reg')}, {naive('d', 96)}
 SELECT event_type, ts, 'seasonal_naive' AS model, yhat, base.y FROM d LEFT JOIN base USING (event_type, ts)"""
SQL["backtest_predictions"] = f"""WITH {REG}, {BACKTEST.format('reg')} SELECT *, 'seasonal_naive' AS model FROM bt"""
SQL["backtest_metrics"] = f"""WITH {REG}, {BACKTEST.format('reg')} SELECT event_type, fold, {ERRORS_ROUNDED} FROM bt
 WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2"""
SQL["fold_metric_means"] = f"""WITH {FILLED}, {BACKTEST.format('filled')}, e AS (SELECT event_type, fold, {ERRORS} FROM bt GROUP BY 1, 2)
 SELECT fold, metric, {r('avg(value)')} AS value FROM (FROM e {LONG}) GROUP BY 1, 2"""
SQL["worst_folds"] = f"""WITH {FILLED}, {BACKTEST.format('filled')}, e AS (SELECT event_type, fold, {ERRORS} FROM bt GROUP BY 1, 2)
 SELECT event_type, fold, {r('mape')} AS mape FROM (SELECT * FROM e ORDER BY e.mape DESC, event_type, fold LIMIT 5)"""
_flo, _fhi = fence(nearest("l", 0.25), nearest("l", 0.75), 1.5)
SQL["backtest_fenced"] = f"""WITH {REG}, numbered AS (SELECT *, row_number() OVER ({W}) - 1 AS row_no FROM reg),
o AS (SELECT event_type, unnest(range(96, n - 8, 4)) AS fold FROM (SELECT event_type, count(*) AS n FROM reg GROUP BY 1)),
pre AS (SELECT event_type, fold, {_flo} AS lo_b, {_fhi} AS hi_b FROM (SELECT o.event_type, fold, list_sort(list(y)) AS l
 FROM numbered x JOIN o ON o.event_type = x.event_type AND row_no < fold WHERE y IS NOT NULL GROUP BY 1, 2))
SELECT x.event_type, x.ts, o.fold, x.row_no - o.fold + 1 AS fold_step, x.y,
 CASE WHEN NOT coalesce(p.y < lo_b OR p.y > hi_b, false) THEN p.y END AS yhat, 'seasonal_naive' AS model
FROM numbered x JOIN o ON o.event_type = x.event_type AND x.row_no >= fold AND x.row_no < fold + 8
LEFT JOIN numbered p ON p.event_type = x.event_type AND p.row_no = x.row_no - 96
LEFT JOIN pre ON pre.event_type = x.event_type AND pre.fold = o.fold"""
SQL["blend"] = PREDICTIONS + f" SELECT event_type, ts, model, {r('yhat')} AS yhat FROM long"
SQL["prediction_metrics"] = PREDICTIONS + f""", e AS (SELECT event_type, model, {ERRORS} FROM long JOIN test USING (event_type, ts) GROUP BY 1, 2)
 SELECT event_type, model, metric, {r('value')} AS value FROM (FROM e {LONG})"""
_ROUND_SCORES = f"model, {r('mape')} AS mape, {r('rmse')} AS rmse, {r('nrmse')} AS nrmse, {r('score')} AS score"
SQL["model_scores"] = SCORES + f" SELECT {_ROUND_SCORES} FROM scores"
SQL["best_model"] = SCORES + f" SELECT {_ROUND_SCORES} FROM (SELECT * FROM scores s ORDER BY s.score, s.model LIMIT 1)"
SQL["named_metrics"] = PER_MODEL + f""" SELECT CASE model WHEN 'naive_day' THEN 'Baseline_Seasonal_Naive' ELSE model END AS model,
 metric, {r('value')} AS value FROM (FROM e {LONG})"""
SQL["selection_record"] = SCORES + f""" SELECT model AS best_model_name, 'candidate' AS model_type,
 'Geometric Mean of MAPE and NRMSE' AS selection_metric, {r('score')} AS score, 3::INTEGER AS n_models
 FROM (SELECT * FROM scores s ORDER BY s.score, s.model LIMIT 1)"""
SQL["known_future"] = f"""WITH {REG}, fr AS (SELECT event_type, hi + k * {STEP} AS ts FROM ends, range(1, 97) AS g(k)),
j AS (SELECT f.event_type, f.ts, p.y FROM fr f LEFT JOIN reg p ON p.event_type = f.event_type AND p.ts = f.ts - INTERVAL 1 DAY)
SELECT event_type, ts, coalesce(last_value(y IGNORE NULLS) OVER ({W}),
 first_value(y IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS y FROM j"""

_PROFILE_COLUMNS = ("event_type", "ts", "y", *LAG_NAMES)
for _name, _alpha in (("ewm_half", 0.5), ("ewm_slow", 0.001)):
    SQL[_name] = f"""WITH RECURSIVE {FILLED}, n AS MATERIALIZED (SELECT *, row_number() OVER ({W}) AS rn FROM filled),
e AS (SELECT event_type, ts, rn, y AS e FROM n WHERE rn = 1
 UNION ALL SELECT n.event_type, n.ts, n.rn, {_alpha}::DOUBLE * n.y + {1 - _alpha}::DOUBLE * e.e FROM e JOIN n ON n.event_type = e.event_type AND n.rn = e.rn + 1)
SELECT event_type, ts, {r('e')} AS mean FROM e"""


def local_lines(window: int, jump: int) -> str:
    """CTE lines: the local line of each series at every jump-th slot."""
    half = (window - 1) // 2
    return f"""{FILLED}, g AS MATERIALIZED (SELECT event_type, ts, y, CAST(epoch(ts) // 900 AS BIGINT) AS t FROM filled),
e AS (SELECT event_type, min(t) AS lo, max(t) AS hi FROM g GROUP BY 1),
p AS (SELECT event_type, lo, hi, unnest(range(lo // {jump}, (hi + {jump} - 1) // {jump} + 1)) * {jump} AS point FROM e),
q AS (SELECT *, least(greatest(point - {half}, lo), greatest(hi - {window - 1}, lo)) AS a FROM p),
f AS (SELECT *, least(a + {window - 1}, hi) AS b, greatest({window} - (hi - lo + 1), 0) // 2 AS short FROM q),
h AS MATERIALIZED (SELECT *, greatest(point - a, b - point) + short AS reach FROM f),
w AS (SELECT h.event_type, point, lo, hi, g.y, CAST(g.t - point AS DOUBLE) AS x, abs(g.t - point) / reach::DOUBLE AS s
 FROM h JOIN g ON g.event_type = h.event_type AND g.t BETWEEN a AND b),
m AS (SELECT event_type, point, first(hi - lo) AS wide, sum(u) AS w, sum(u * x) / sum(u) AS mx, sum(u * y) / sum(u) AS my,
 sum(u * x * x) / sum(u) AS mxx, sum(u * x * y) / sum(u) AS mxy
 FROM (SELECT *, CASE WHEN s <= 0.001 THEN 1 WHEN s <= 0.999 THEN (1 - s ** 3) ** 3 ELSE 0 END AS u FROM w) GROUP BY 1, 2),
lines AS MATERIALIZED (SELECT event_type, point, my - mx * CASE WHEN sqrt(greatest(mxx - mx * mx, 0)) > wide * 0.001
 THEN (mxy - mx * my) / (mxx - mx * mx) ELSE 0 END AS fit FROM m)"""


SQL["loess_smooth"] = f"WITH {local_lines(97, 1)} SELECT g.event_type, ts, {r('fit')} AS smooth FROM g JOIN lines l ON l.event_type = g.event_type AND point = t"
SQL["loess_joined"] = f"""WITH {local_lines(673, 67)} SELECT g.event_type, ts,
 {r('l.fit + CASE WHEN t = l.point THEN 0 ELSE (n.fit - l.fit) * ((t - l.point) / 67::DOUBLE) END')} AS smooth
FROM g JOIN lines l ON l.event_type = g.event_type AND l.point = t // 67 * 67
LEFT JOIN lines n ON n.event_type = g.event_type AND n.point = l.point + 67"""
SQL["series_scores"] = PREDICTIONS + f""", e AS (SELECT event_type, model, {ERRORS}, count(*) FILTER (y = 0) AS mape_skipped, count(*) AS n
 FROM long JOIN test USING (event_type, ts) WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2),
s AS (SELECT e.*, rmse / m AS nrmse, sqrt(mape * (rmse / m)) AS score FROM e JOIN (SELECT event_type, avg(y) AS m FROM test GROUP BY 1) USING (event_type))
SELECT event_type, model, {r('mae')} AS mae, {r('rmse')} AS rmse, {r('mape')} AS mape, {r('nrmse')} AS nrmse, {r('score')} AS score, mape_skipped, n,
 row_number() OVER (PARTITION BY event_type ORDER BY s.score, s.model) = 1 AS is_best FROM s"""
SQL["null_profile"] = f"WITH {REG}, x AS ({lagged('reg', LAG_NAMES)}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS n_rows FROM x" for c in _PROFILE_COLUMNS)
SQL["month_mean"] = f"""WITH {DAILY} SELECT o_orderstatus, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start,
 {r('avg(y)')} AS mean_value FROM daily GROUP BY 1, 2"""
SQL["day_mean"] = f"""WITH {BASE} SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start, {r('avg(y)')} AS mean_value
 FROM base WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1, 2"""
SQL["weekday_mean"] = f"""WITH {DAILY} SELECT o_orderstatus, CAST(isodow(ts) AS INTEGER) AS weekday, {r('avg(y)')} AS mean_value
 FROM daily WHERE year(ts) = 1998 GROUP BY 1, 2"""
SQL["hour_box"] = f"{box('events', 'hour(ts)', 'value')} {box_select('hour')}"
SQL["weekday_box"] = f"{box('orders', 'isodow(o_orderdate)', 'o_totalprice')} {box_select('weekday')}"
SQL["head_rows"] = "SELECT * FROM events ORDER BY ts, event_id LIMIT 100"
SQL["tail_rows"] = "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 5"
SQL["acf"] = f"""WITH {FILLED}, c AS (SELECT event_type, row_number() OVER ({W}) AS rn, y - avg(y) OVER (PARTITION BY event_type) AS v FROM filled)
 SELECT a.event_type, CAST(k AS INTEGER) AS lag, {r('sum(a.v * b.v) / first(s)')} AS acf FROM range(0, 51) AS g(k)
 JOIN c a ON true JOIN c b ON b.event_type = a.event_type AND b.rn = a.rn - k
 JOIN (SELECT event_type, sum(v * v) AS s FROM c GROUP BY 1) t ON t.event_type = a.event_type GROUP BY 1, 2"""

SQL["drift_ks"] = f"WITH {BASE}, {parts('base')}, {chunked('test', 'c')}, {ks('k', 'c')} SELECT event_type, part, {r('statistic')} AS statistic FROM k"
SQL["drift_js"] = f"WITH {BASE}, {parts('base')}, {chunked('test', 'c')}, {JS_REF}, {js('j', 'c')} SELECT event_type, part, {r('statistic')} AS statistic FROM j"
SQL["drift_alerts"] = f"""WITH {BASE}, {parts('base')}, {chunked('test', 'c')}, {chunked('train', 'rc')}, {JS_REF},
{ks('k', 'c')}, {ks('kr', 'rc')}, {js('j', 'c')}, {js('jr', 'rc')}
{alerts('kolmogorov_smirnov', 'k', 'kr')} UNION ALL {alerts('jensen_shannon', 'j', 'jr')}"""
_RESIDUAL = """{0}s AS (SELECT s.event_type, s.ts, round(s.y - p.y + 1e-9::DOUBLE, 6) + CAST(0 AS DOUBLE) AS d FROM {0} s JOIN {0} p
 ON p.event_type = s.event_type AND p.ts = s.ts - INTERVAL 1 DAY)"""

SQL["boxcox_grid"] = f"""WITH {DAILY}, g AS (SELECT unnest(range(0, 17)) * 0.25::DOUBLE - 2 AS lam),
x AS (SELECT o_orderstatus, lam, y, CASE WHEN lam = 0 THEN ln(y) ELSE pow(y, lam) END AS t,
 CASE WHEN lam = 0 THEN 1 ELSE lam * lam END AS l2 FROM daily, g WHERE y > 0)
SELECT o_orderstatus, {r('lam', 3)} AS "lambda", {r('(lam - 1) * sum(ln(y)) - count(*) / 2.0::DOUBLE * ln(var_pop(t) / first(l2))', 3)} AS log_likelihood
FROM x GROUP BY o_orderstatus, lam HAVING var_pop(t) > 0"""
SQL["decomposition"] = f"""WITH {DECOMPOSED} SELECT event_type, ts, y, {r('trend')} AS trend, {r('seasonal_96')} AS seasonal_96,
 {r('seasonal_672')} AS seasonal_672, {r('seasonal_20160')} AS seasonal_20160, {r('remainder')} AS remainder FROM d3"""
SQL["decomposition_forecast"] = f"""WITH {DECOMPOSED}, q AS (SELECT event_type, quantile_cont(remainder, 0.05) AS lo_q,
 quantile_cont(remainder, 0.95) AS hi_q, max(ts) AS last_ts, max_by(trend, ts) AS level FROM d3 GROUP BY 1),
fr AS (SELECT event_type, last_ts + k * {STEP} AS ts, k, lo_q, hi_q, level FROM q, range(1, 97) AS g(k)),
fp AS (SELECT *, {PHASES.format(96)} AS p1, {PHASES.format(672)} AS p2, {PHASES.format(20160)} AS p3 FROM fr),
v AS (SELECT fp.*, level + coalesce(s1.s, 0) + coalesce(s2.s, 0) + coalesce(s3.s, 0) AS yhat FROM fp LEFT JOIN s1 USING (event_type, p1) LEFT JOIN s2 USING (event_type, p2) LEFT JOIN s3 USING (event_type, p3))
SELECT event_type, ts, CAST(k AS INTEGER) AS horizon_step, {r('yhat')} AS yhat, {r('yhat + lo_q')} AS yhat_low, {r('yhat + hi_q')} AS yhat_high FROM v"""

_LINKS = r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, regexp_extract(hits[i], 'href="([^"]*)"', 1) AS href,
 regexp_extract(hits[i], '>([^<>]*)</a>', 1) AS label FROM (SELECT page_id, hits, unnest(generate_series(1, len(hits))) AS i FROM (
 SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS hits FROM pages))"""
SQL["html_links"] = _LINKS
SQL["absolute_links"] = f"""SELECT page_id, pos, CASE WHEN href = '' THEN '' WHEN starts_with(href, '/') THEN 'http://site.example' || href
  WHEN starts_with(href, 'http') THEN href ELSE 'http://site.example/' || href END AS from_root,
 CASE WHEN ltrim(href, '/') = '' THEN '' WHEN starts_with(ltrim(href, '/'), 'http') THEN ltrim(href, '/')
  ELSE 'http://site.example/' || ltrim(href, '/') END AS relative FROM ({_LINKS})"""
SQL["page_records"] = r"""SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
 trim(regexp_replace(regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1), '(?s)<[^>]*>', '', 'g')) AS footer,
 CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS n_paragraphs FROM pages"""
SQL["json_props"] = """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events UNION ALL SELECT event_id, user_id FROM events"""
SQL["json_first_prop"] = """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events"""
SQL["text_grid"] = r"""WITH t AS (SELECT doc_id::VARCHAR AS partition_key, string_split_regex(regexp_replace(text, '\r?\n\z', ''), '\r?\n') AS ls FROM documents),
u AS (SELECT partition_key, i - 1 AS row_idx, string_split(ls[i], ',') AS cells FROM (SELECT *, unnest(generate_series(1, len(ls))) AS i FROM t))
SELECT partition_key, row_idx, CAST(len(cells) AS INTEGER) AS n_cells, cells[1] AS first_cell, coalesce(cells[3], '') AS third_cell FROM u"""
SQL["file_listing"] = LISTED + " SELECT o_orderkey, year, month, file_name, size, file_date, download_link FROM l"
SQL["listing_keys"] = LISTED + """ SELECT o_orderkey, year, month, file_name, size, file_date,
 CASE WHEN fixed = '' THEN download_link ELSE fixed END AS download_link, ym, file_key FROM l"""
SQL["listing_backfill"] = LISTED + " SELECT ym, count(*) AS n, count(file_key) AS n_files FROM l WHERE year BETWEEN 1997 AND 1999 GROUP BY 1"
SQL["listing_live"] = LISTED + " SELECT o_orderkey, file_key, ym FROM l WHERE ym = '1999_06'"
SQL["month_folders"] = f"SELECT {MON} AS month, count(*) AS n, CAST(month(o_orderdate) AS BIGINT) AS month_no FROM orders GROUP BY 1, 3"
SQL["dashboard_samples"] = """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp, event_type AS dashboard_timestamp,
 round(value, 2) AS frequency, -user_id AS state_ui, CAST('1' || lpad(user_id::VARCHAR, 3, '0') AS BIGINT) AS state_demand,
 """ + ", ".join(f"0::BIGINT AS {n}" for n in (
    "thermal", "thermal_ipp", "hydro", "wind", "solar", "other_ncep", "cgs_drawal", "pavagada_kspdcl", "bescom", "hescom",
    "gescom", "cesc", "mescom")) + " FROM events"
SQL["safe_parse"] = """SELECT o_orderkey, round(o_totalprice, 2) AS price, 0::BIGINT AS price_int, o_custkey AS cust,
 0::DOUBLE AS priority_float, 0::BIGINT AS status_int FROM orders"""
SQL["period_parse"] = f"""SELECT {SHEET_KEY} AS partition_key, o_orderkey + 5 AS row_idx, {START} AS start_text,
 CASE WHEN {P} <> '2' THEN {SHEET_DATE} END AS key_date,
 CASE WHEN {P} <> '2' THEN {SHEET_DATE} END + (o_orderkey % 96) * {STEP} AS stamp FROM orders"""

SQL["grid_contract"] = SHEETS + " SELECT * FROM checks"
SQL["grid_quarantine"] = SHEETS + " SELECT partition_key, reason, data_rows, bad_rows FROM checks WHERE reason IS NOT NULL"
SQL["grid_counters"] = SHEETS + """ SELECT count(*) AS raw_partitions_total, count(*) FILTER (is_valid) AS raw_partitions_valid,
 count(*) FILTER (NOT is_valid) AS raw_partitions_invalid FROM checks"""
SQL["grid_valid_rows"] = SHEETS + " SELECT partition_key, data_rows + 5 AS n_rows FROM checks WHERE is_valid"
SQL["grid_primary"] = SHEETS + " SELECT date, period, actual_demand_mw, nrldc_intraday_forecasted_demand_mw, source_key FROM prim"
SQL["primary_violations"] = SHEETS + " SELECT count(*) AS n_rows, 0::BIGINT AS null_dates, 0::BIGINT AS bad_periods FROM prim"
SQL["grid_series"] = SHEETS + """ SELECT strptime(strftime(date, '%Y-%m-%d ') || start_text, '%Y-%m-%d %H:%M') AS timestamp,
 actual_demand_mw, nrldc_intraday_forecasted_demand_mw FROM prim
 QUALIFY row_number() OVER (PARTITION BY timestamp ORDER BY source_key, actual_demand_mw NULLS FIRST, nrldc_intraday_forecasted_demand_mw) = 1"""

SQL["stream_tumbling_means"] = f"""SELECT event_type, time_bucket({STEP}, ts) AS window_start, time_bucket({STEP}, ts) + {STEP} AS window_end,
 {r('avg(value)')} AS value, count(*) AS n FROM events GROUP BY 1, 2, 3"""
SQL["stream_drop_repeats"] = "SELECT DISTINCT event_type, date_trunc('hour', ts) AS ts FROM events"

SQL["drift_seasonal_residual"] = f"""WITH {FILLED}, {parts('filled')}, {_RESIDUAL.format('train')}, {_RESIDUAL.format('test')},
rtrain AS (SELECT event_type, ts, d AS y FROM trains), rtest AS (SELECT event_type, ts, d AS y FROM tests),
{chunked('rtest', 'c')}, {chunked('rtrain', 'rc')}, {JS_REF.replace('train', 'rtrain')},
{ks('k', 'c', 'rtrain')}, {ks('kr', 'rc', 'rtrain')}, {js('j', 'c')}, {js('jr', 'rc')}
{alerts('kolmogorov_smirnov', 'k', 'kr')} UNION ALL {alerts('jensen_shannon', 'j', 'jr')}"""

SQL["table_size"] = "SELECT count(*) AS n_rows, 1::BIGINT AS n_files FROM lineitem"
SQL["quantiles_approximate"] = """SELECT l_returnflag, q, true AS within FROM
 (SELECT DISTINCT l_returnflag FROM lineitem), (SELECT unnest([0.25::DOUBLE, 0.75::DOUBLE]) AS q)"""
_ACF = SQL["acf"].replace(r("sum(a.v * b.v) / first(s)"), "sum(a.v * b.v) / first(s)")
SQL["pacf"] = f"""WITH RECURSIVE a AS (SELECT event_type, list(acf ORDER BY lag) AS r FROM ({_ACF}) GROUP BY 1),
d AS (SELECT event_type, r, 1 AS k, [r[2]] AS phi, r[2] AS last FROM a UNION ALL
 SELECT event_type, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - f * phi[k + 1 - j]), f), f FROM (
  SELECT *, (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])))
   / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1]))) AS f FROM d WHERE k < 50))
SELECT event_type, CAST(k AS INTEGER) AS lag, {r('last')} AS pacf FROM d UNION ALL SELECT event_type, 0, 1.0::DOUBLE FROM a"""

_BOXCOX = f"""{DAILY}, g1 AS (SELECT unnest(range(-60, 61)) / 10.0::DOUBLE AS lam),
x1 AS (SELECT o_orderstatus, lam, y, CASE WHEN lam = 0 THEN ln(y) ELSE pow(y, lam) END AS t,
 CASE WHEN lam = 0 THEN 1 ELSE lam * lam END AS l2 FROM daily, g1 WHERE y > 0),
l1 AS (SELECT o_orderstatus, lam, (lam - 1) * sum(ln(y)) - count(*) / 2.0::DOUBLE * ln(var_pop(t) / first(l2)) AS ll
 FROM x1 GROUP BY 1, 2 HAVING var_pop(t) > 0),
b1 AS (SELECT o_orderstatus, arg_max(lam, ll) AS lam FROM l1 GROUP BY 1),
g2 AS (SELECT o_orderstatus, round(lam + i / 100.0::DOUBLE, 10) AS lam FROM b1, range(-10, 11) AS q(i)),
x2 AS (SELECT o_orderstatus, lam, y, CASE WHEN abs(lam) < 1e-12 THEN ln(y) ELSE pow(y, lam) END AS t,
 CASE WHEN abs(lam) < 1e-12 THEN 1 ELSE lam * lam END AS l2 FROM daily JOIN g2 USING (o_orderstatus) WHERE y > 0),
l2 AS (SELECT o_orderstatus, lam, (lam - 1) * sum(ln(y)) - count(*) / 2.0::DOUBLE * ln(var_pop(t) / first(l2)) AS ll
 FROM x2 GROUP BY 1, 2 HAVING var_pop(t) > 0),
b2 AS (SELECT o_orderstatus, arg_max(lam, ll) AS lam FROM l2 GROUP BY 1)"""
SQL["boxcox_best"] = f"""WITH {_BOXCOX} SELECT o_orderstatus, {r('lam')} AS best_lambda FROM b2"""
SQL["boxcox_transform"] = f"""WITH {_BOXCOX} SELECT o_orderstatus, ts, y, {r('ln(1 + y)')} AS y_log,
 {r('CASE WHEN abs(lam) < 1e-12 THEN ln(y) ELSE (pow(y, lam) - 1) / lam END', 3)} AS y_boxcox
 FROM daily LEFT JOIN b2 USING (o_orderstatus)"""

SQL["phillips_perron"] = f"""WITH {FILLED}, p AS (SELECT event_type, row_number() OVER ({W}) AS i, y, lag(y) OVER ({W}) AS x FROM filled),
f AS (SELECT event_type, count(*) AS n, regr_slope(y, x) AS rho, regr_intercept(y, x) AS c, var_pop(x) AS vx
 FROM p WHERE x IS NOT NULL GROUP BY 1),
u AS (SELECT event_type, i, y - c - rho * x AS u FROM p JOIN f USING (event_type) WHERE x IS NOT NULL),
g0 AS (SELECT event_type, sum(u * u) AS g0 FROM u GROUP BY 1),
ak AS (SELECT event_type, i - k AS i, 2 * (1 - k / 97.0::DOUBLE) * u AS wu FROM u, range(1, 97) AS q(k)),
gk AS (SELECT event_type, sum(wu * u) AS gk FROM ak JOIN u USING (event_type, i) GROUP BY 1),
v AS (SELECT event_type, n, rho, vx, g0 / n AS gamma0, (g0 + gk) / n AS lam2, g0 / (n - 2) AS s2 FROM f JOIN g0 USING (event_type) JOIN gk USING (event_type)),
w AS (SELECT *, sqrt(s2 / (n * vx)) AS sigma FROM v),
t AS (SELECT event_type, n, sqrt(gamma0 / lam2) * (rho - 1) / sigma - 0.5::DOUBLE * (lam2 - gamma0) / sqrt(lam2) * (n * sigma / sqrt(s2)) AS tau FROM w)
SELECT event_type, {r('tau')} AS statistic, n, CASE WHEN tau > 2.74 THEN false WHEN tau < -18.83 THEN true
 WHEN tau <= -1.61 THEN 2.1659 + 1.4412 * tau + 0.038269 * tau * tau < -1.6448536269514722
 ELSE 1.7339 + 0.93202 * tau - 0.12745 * tau * tau - 0.010368 * tau * tau * tau < -1.6448536269514722 END AS is_stationary FROM t"""

SQL["rolling_with_nan"] = f"""WITH {FILLED} SELECT event_type, ts, {r('avg(y) OVER (w2 ROWS 199 PRECEDING)')} AS wide FROM
 (SELECT event_type, ts, CASE WHEN ts = TIMESTAMP '2024-01-10 12:00:00' THEN 'NaN'::DOUBLE ELSE y END AS y FROM filled)
 WINDOW w2 AS (PARTITION BY event_type ORDER BY ts) QUALIFY count(*) OVER (w2 ROWS 199 PRECEDING) = 200"""
SQL["time_since_previous_raw"] = """SELECT event_type, event_id, datediff('second', date_trunc('second', p), date_trunc('second', ts)) AS seconds_since_previous FROM (
 SELECT *, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM
 (SELECT event_type, ts, min(event_id) AS event_id FROM events GROUP BY 1, 2))"""

SQL["whole_table_rewrite"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"
SQL["keyed_rewrite"] = """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 - o_totalprice ELSE o_totalprice END AS price, o_orderpriority
 FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""
SQL["csv_appends"] = "SELECT o_orderkey, o_orderpriority, o_custkey FROM orders"
SQL["metrics_history"] = """SELECT 'candidate' AS prefix, o_orderpriority AS model, 'rmse' AS metric, max(o_totalprice) AS value
 FROM orders GROUP BY 2"""
SQL["json_record"] = f"""WITH m AS (SELECT o_orderpriority AS model, avg(o_totalprice) / 1e6::DOUBLE AS mape, stddev_pop(o_totalprice) AS rmse FROM orders GROUP BY 1),
s AS (SELECT model, sqrt(mape * rmse / (SELECT avg(o_totalprice) FROM orders)) AS score FROM m)
SELECT arg_min(model, score) AS best_model_name, 'candidate' AS model_type, {r('min(score)')} AS score, count(*) AS n_models FROM s"""
SQL["features_without_gaps"] = f"""WITH {REG}, x AS ({lagged('reg', LAG_NAMES)}) SELECT event_type, ts,
 """ + ", ".join(f"coalesce({c}, 0.0)::DOUBLE AS {c}" for c in ("y", *LAG_NAMES)) + " FROM x"

_KEY = """year(o_orderdate) || '/' || strftime(o_orderdate, '%b') || '/F_01-' || strftime(o_orderdate, '%m-%Y')"""
SQL["incremental_ingest"] = f"""WITH o AS (SELECT *, {_KEY} AS source_key, month(o_orderdate) = 7 AS bad FROM orders),
n AS (SELECT count(DISTINCT source_key) AS all_sheets, count(DISTINCT source_key) FILTER (bad) AS refused FROM o)
SELECT source_key, count(*) AS n_rows, {r("sum(CASE WHEN source_key = '1995/Mar/F_01-03-1995' THEN -o_totalprice ELSE o_totalprice END)", 2)} AS total,
 first(all_sheets) AS first_read, 1::BIGINT AS second_read, first(refused) AS refused FROM o, n WHERE NOT bad GROUP BY 1"""
SQL["large_sheets"] = """SELECT l_returnflag AS partition_key,
 row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) - 1 AS row_idx,
 CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, 3::BIGINT AS n_cells FROM lineitem"""
SQL["promotion"] = SCORES + f""", best AS (SELECT * FROM scores s ORDER BY s.score, s.model LIMIT 1)
SELECT event_type, ts, long.model, {r('yhat')} AS yhat, 2::BIGINT AS version, best.model AS recorded, {r('score')} AS score
FROM long JOIN best USING (model)"""
SQL["stream_keep_least"] = f"""SELECT event_type, time_bucket({STEP}, ts) AS ts, min(event_id) AS event_id, arg_min(value, event_id) AS value
 FROM events GROUP BY 1, 2"""
SQL["null_at_keys"] = f"""WITH {BASE} SELECT CASE WHEN event_type <> 'click' THEN event_type END AS event_type, ts,
 CASE WHEN NOT (hour(ts) = 3 AND minute(ts) = 0) THEN y END AS y FROM base"""
SQL["imputed_counts"] = f"WITH {REG} SELECT event_type, count(*) FILTER (y IS NULL) AS imputed_values_count FROM reg GROUP BY 1"
SQL["quoted_cells"] = """SELECT CAST(o_custkey AS VARCHAR) AS partition_key, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS row_idx,
 lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_text, o_orderpriority || ', said "' || o_orderstatus || '"' AS note FROM orders"""
