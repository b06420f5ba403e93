"""DuckDB statements equal to the registered queries (the correctness oracle).

Tables are the driver's views: region nation customer supplier part orders
lineitem events documents embeddings pages benchmark labels conversations.
Every computed column is aliased to the Spark name; doubles are rounded to
6 digits after the last aggregate, like the Spark side.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}


def _positive_zero_rounds(text: str) -> str:
    """Wrap every ``round(<expr>, 6)`` as ``(round(<expr>, 6) + 0.0)``.

    DuckDB keeps the sign of a tiny negative rounded to zero (``-0.0``);
    adding 0.0 turns it into ``0.0`` (as Spark's decimal rounding gives) and
    changes nothing else.
    """
    out, i = [], 0
    while True:
        j = text.find("round(", i)
        if j < 0:
            out.append(text[i:])
            return "".join(out)
        depth, k = 0, j + len("round")
        while k < len(text):
            if text[k] == "(":
                depth += 1
            elif text[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _positive_zero_rounds(text[j + len("round(") : k])
        out.append(text[i:j])
        out.append(f"(round({inner}) + 0.0)")
        i = k + 1


def sql(name: str, text: str) -> None:
    ORACLE_SQL[name] = _positive_zero_rounds(text.strip())


# ------------------------------------------------------------------ shared CTEs

# Events as raw trips, cleaned and kept to the file's month (2024-01).
TRIPS_CLEAN = """
trips AS (
    SELECT ts AS pickup_datetime,
           CAST(trunc(value) AS INTEGER) AS passenger_count,
           CAST(user_id AS INTEGER) AS pickup_location_id
    FROM events
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'
)"""

HOURLY_DEMAND = TRIPS_CLEAN + """,
counts AS (
    SELECT date_trunc('hour', pickup_datetime) AS h, pickup_location_id AS loc,
           count(pickup_location_id) AS n
    FROM trips WHERE pickup_location_id IS NOT NULL GROUP BY ALL
),
locs AS (SELECT DISTINCT loc FROM counts),
hours AS (
    SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00',
                                  INTERVAL 1 HOUR)) AS h
),
hourly AS (
    SELECT strftime(hours.h, '%Y-%m-%d %H:%M:%S.%f') || '-' || CAST(locs.loc AS VARCHAR) AS key,
           hours.h AS pickup_datetime_hour,
           CAST(coalesce(counts.n, 0) AS INTEGER) AS num_pickup,
           locs.loc AS pickup_location_id
    FROM hours CROSS JOIN locs
    LEFT JOIN counts ON counts.h = hours.h AND counts.loc = locs.loc
)"""

# Orders as raw trips; each year's rows claim the January of that year.
ORDERS_TAGGED = """
otrips AS (
    SELECT o_orderdate AS pickup_datetime,
           CAST(trunc(o_totalprice) AS INTEGER) AS passenger_count,
           CAST(o_custkey AS INTEGER) AS pickup_location_id,
           make_date(year(o_orderdate), 1, 1) AS file_month
    FROM orders
)"""

# Orders as raw trips of monthly files; the location is the customer's nation.
ORDERS_MONTHLY = """
otrips AS (
    SELECT o_orderdate AS pickup_datetime,
           CAST(trunc(o_totalprice) AS INTEGER) AS passenger_count,
           c_nationkey AS pickup_location_id,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS file_month
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
)"""

# Complete daily series: orders per (priority, day) on the global day grid.
DAILY = """
ocounts AS (
    SELECT o_orderpriority AS unique_id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ds,
           count(*) AS y
    FROM orders GROUP BY ALL
),
obounds AS (SELECT min(ds) AS lo, max(ds) AS hi FROM ocounts),
ogrid AS (
    SELECT s.unique_id, unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS ds
    FROM (SELECT DISTINCT unique_id FROM ocounts) s CROSS JOIN obounds b
),
daily AS (
    SELECT g.unique_id, g.ds, CAST(coalesce(c.y, 0) AS BIGINT) AS y
    FROM ogrid g LEFT JOIN ocounts c ON c.unique_id = g.unique_id AND c.ds = g.ds
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes)


# ------------------------------------------------------------------------- ETL

sql("month_spine", """
WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders)
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b
""")

sql("month_coverage", """
WITH spine AS (
    SELECT CAST(unnest(generate_series(TIMESTAMP '1994-10-01', TIMESTAMP '2002-03-01', INTERVAL 1 MONTH)) AS DATE) AS month
),
present AS (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS records
    FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
)
SELECT s.month, CAST(coalesce(p.records, 0) AS BIGINT) AS records, p.records IS NOT NULL AS is_present
FROM spine s LEFT JOIN present p ON p.month = s.month
""")

sql("standardize_raw", """
SELECT ts AS pickup_datetime, CAST(trunc(value) AS INTEGER) AS passenger_count,
       CAST(user_id AS INTEGER) AS pickup_location_id
FROM events
""")

VALIDITY = """
SELECT file_month,
       count(pickup_datetime) AS total_records,
       count(pickup_datetime) FILTER (WHERE pickup_datetime >= file_month AND pickup_datetime < file_month + INTERVAL 1 MONTH) AS records_in_range,
       count(pickup_datetime) - count(pickup_datetime) FILTER (WHERE pickup_datetime >= file_month AND pickup_datetime < file_month + INTERVAL 1 MONTH) AS records_deleted,
       round(CAST(count(pickup_datetime) FILTER (WHERE pickup_datetime >= file_month AND pickup_datetime < file_month + INTERVAL 1 MONTH) AS DOUBLE) * 100.0
             / nullif(count(pickup_datetime), 0), 6) AS pct_in_range,
       count(*) FILTER (WHERE pickup_datetime >= file_month AND pickup_datetime < file_month + INTERVAL 1 MONTH AND pickup_location_id IS NULL) AS null_locations
FROM otrips GROUP BY file_month
"""
sql("validity_report", with_(ORDERS_TAGGED) + VALIDITY)
sql("load_report", with_(ORDERS_MONTHLY) + VALIDITY)

sql("filter_in_month", with_(ORDERS_TAGGED) + """
SELECT pickup_datetime, passenger_count, pickup_location_id, file_month
FROM otrips
WHERE pickup_datetime >= file_month AND pickup_datetime < file_month + INTERVAL 1 MONTH
""")

sql("hourly_counts", with_(TRIPS_CLEAN) + """
SELECT DATE '2024-01-01' AS file_month, date_trunc('hour', pickup_datetime) AS pickup_datetime_hour,
       pickup_location_id, count(pickup_location_id) AS num_pickup
FROM trips WHERE pickup_location_id IS NOT NULL GROUP BY ALL
""")

sql("hourly_demand", with_(HOURLY_DEMAND) + " SELECT * FROM hourly")

sql("hourly_demand_multi_month", with_(ORDERS_MONTHLY) + """,
f AS (
    SELECT * FROM otrips
    WHERE pickup_datetime >= file_month AND pickup_datetime < file_month + INTERVAL 1 MONTH
      AND pickup_location_id IS NOT NULL
),
counts AS (
    SELECT file_month AS fm, date_trunc('hour', pickup_datetime) AS h, pickup_location_id AS loc,
           count(pickup_location_id) AS n
    FROM f GROUP BY ALL
),
locs AS (SELECT DISTINCT fm, loc FROM counts),
spine AS (
    SELECT fm, loc, unnest(generate_series(CAST(fm AS TIMESTAMP), CAST(fm + INTERVAL 1 MONTH AS TIMESTAMP) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h
    FROM locs
)
SELECT strftime(s.h, '%Y-%m-%d %H:%M:%S.%f') || '-' || CAST(s.loc AS VARCHAR) AS key,
       s.h AS pickup_datetime_hour, CAST(coalesce(c.n, 0) AS INTEGER) AS num_pickup,
       s.loc AS pickup_location_id
FROM spine s LEFT JOIN counts c ON c.fm = s.fm AND c.h = s.h AND c.loc = s.loc
""")


# ---------------------------------------------------------- generators

from hourglass.functions.draws import (  # noqa: E402
    nearest_rank,
    sql_combine_keys,
    sql_draw_index,
    sql_text_key,
)
from hourglass.plans.inputs import HORIZON, HOURLY_DRAWS, HOURLY_LAGS, LAGS  # noqa: E402

L = max(LAGS)


def hourly_cte(prefix: str, where: str = "") -> str:
    """The hourly demand table of events as CTEs ``{prefix}_*``; ``{prefix}`` is the result."""
    extra = f" AND {where}" if where else ""
    return f"""
{prefix}_trips AS (
    SELECT ts AS pickup_datetime, CAST(user_id AS INTEGER) AS pickup_location_id
    FROM events
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'{extra}
),
{prefix}_counts AS (
    SELECT date_trunc('hour', pickup_datetime) AS h, pickup_location_id AS loc, count(pickup_location_id) AS n
    FROM {prefix}_trips WHERE pickup_location_id IS NOT NULL GROUP BY ALL
),
{prefix}_locs AS (SELECT DISTINCT loc FROM {prefix}_counts),
{prefix}_hours AS (
    SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS h
),
{prefix} AS (
    SELECT strftime(hh.h, '%Y-%m-%d %H:%M:%S.%f') || '-' || CAST(l.loc AS VARCHAR) AS key,
           hh.h AS pickup_datetime_hour,
           CAST(coalesce(c.n, 0) AS INTEGER) AS num_pickup,
           l.loc AS pickup_location_id
    FROM {prefix}_hours hh CROSS JOIN {prefix}_locs l
    LEFT JOIN {prefix}_counts c ON c.h = hh.h AND c.loc = l.loc
)"""


def lag_list(col: str = "y", lags=LAGS) -> str:
    return ", ".join(f"lag({col}, {i}) OVER w AS {col}__{i}__lag" for i in lags)


def mean_expr(cols: list[str]) -> str:
    """Row mean skipping nulls, summed left to right like the Spark side."""
    total = " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in cols)
    cnt = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)
    return f"(({total}) / CAST(nullif({cnt}, 0) AS DOUBLE))"


def mean_lag_predict_cte(src: str, name: str, lags=LAGS, unit: str = "DAY") -> str:
    """``{name}``: (unique_id, ds, y, y_hat) -- history plus one future row per
    series, rows after min(ds) + max_lag steps of ``unit`` (strict)."""
    cols = [f"y__{i}__lag" for i in lags]
    return f"""
{name}_last AS (SELECT unique_id, max(ds) AS last FROM {src} GROUP BY unique_id),
{name}_ext AS (
    SELECT unique_id, ds, y FROM {src}
    UNION ALL SELECT unique_id, last + INTERVAL 1 {unit}, CAST(NULL AS BIGINT) FROM {name}_last
),
{name}_lags AS (
    SELECT unique_id, ds, y, {lag_list('y', lags)}, min(ds) OVER (PARTITION BY unique_id) AS first
    FROM {name}_ext WINDOW w AS (PARTITION BY unique_id ORDER BY ds)
),
{name} AS (
    SELECT unique_id, ds, y, {mean_expr(cols)} AS y_hat
    FROM {name}_lags WHERE ds > first + INTERVAL {max(lags)} {unit}
)"""


def mean_step_sql(h: str, lags=LAGS) -> str:
    total = " + ".join(f"{h}[-{i}]" for i in lags)
    return f"(({total}) / {float(len(lags))})"


def folds_cte(src: str = "daily") -> str:
    return f"""
fb AS (SELECT min(ds) AS lo, max(ds) AS hi FROM {src}),
fs AS (
    SELECT lo, hi, unnest(generate_series(TIMESTAMP '2000-01-01', hi, INTERVAL 3 MONTH)) AS test_from FROM fb
    WHERE TIMESTAMP '2000-01-01' < hi
),
folds AS (
    SELECT CAST(row_number() OVER (ORDER BY test_from) - 1 AS INTEGER) AS fold_id, lo AS train_from, test_from,
           coalesce(lead(test_from) OVER (ORDER BY test_from), hi) AS test_to
    FROM fs WHERE test_from < hi
),
tagged AS (
    SELECT d.unique_id, d.ds, d.y, f.fold_id
    FROM {src} d LEFT JOIN folds f ON d.ds >= f.test_from AND d.ds < f.test_to
),
tb AS (SELECT fold_id, min(ds) AS lo, max(ds) AS hi FROM tagged WHERE fold_id IS NOT NULL GROUP BY fold_id),
cut AS (
    SELECT fold_id, cutoff FROM (
        SELECT fold_id, hi, unnest(generate_series(lo + INTERVAL {L} DAY, hi, INTERVAL {HORIZON} DAY)) AS cutoff
        FROM tb WHERE lo + INTERVAL {L} DAY < hi
    ) WHERE cutoff < hi
)"""


def rolling_ctes(step: str, params: str = "") -> str:
    """Rolling-origin forecasts and their evaluation; ``params``: a join of per-fold parameters."""
    return f""",
trows AS (SELECT fold_id, unique_id, ds, y FROM tagged WHERE fold_id IS NOT NULL),
origin AS (
    SELECT c.fold_id, r.unique_id, c.cutoff, max(r.ds) AS last, list(CAST(r.y AS DOUBLE) ORDER BY r.ds) AS hist_all
    FROM cut c JOIN trows r ON r.fold_id = c.fold_id AND r.ds <= c.cutoff
    GROUP BY c.fold_id, r.unique_id, c.cutoff HAVING count(*) >= {L}
),
rec(fold_id, unique_id, cutoff, last, k, h) AS (
    SELECT fold_id, unique_id, cutoff, last, 0, list_slice(hist_all, len(hist_all) - {L - 1}, len(hist_all)) FROM origin
    UNION ALL
    SELECT fold_id, unique_id, cutoff, last, k + 1, list_append(h, {step}) FROM rec {params} WHERE k < {HORIZON}
),
fc AS (SELECT fold_id, unique_id, cutoff, last + to_days(CAST(k AS INTEGER)) AS ds, h[-1] AS y_pred FROM rec WHERE k >= 1),
rof AS (
    SELECT f.fold_id, f.unique_id, f.ds, f.cutoff, r.y, f.y_pred
    FROM fc f JOIN trows r ON r.fold_id = f.fold_id AND r.unique_id = f.unique_id AND r.ds = f.ds
),
ev1 AS (
    SELECT fold_id, unique_id, datediff('day', cutoff, ds) AS horizon,
           avg(y_pred - y) AS bias, avg(abs(y_pred - y)) AS mae
    FROM rof GROUP BY ALL
),
ev AS (
    SELECT fold_id, CAST(horizon AS INTEGER) AS horizon, avg(bias) AS bias, avg(mae) AS mae,
           avg(mae + abs(bias)) AS score
    FROM ev1 GROUP BY ALL
)"""


ROLLING = folds_cte() + rolling_ctes(mean_step_sql("h"))

MEAN_FORECAST = f"""
mf_rank AS (
    SELECT unique_id, ds, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds DESC) AS rd,
           count(*) OVER (PARTITION BY unique_id) AS n
    FROM daily
),
mf_hist AS (
    SELECT unique_id, max(ds) AS last, list(CAST(y AS DOUBLE) ORDER BY ds) AS h
    FROM mf_rank WHERE rd <= {L} AND n >= {L + 1} GROUP BY unique_id
),
mf_rec(unique_id, last, k, h) AS (
    SELECT unique_id, last, 0, h FROM mf_hist
    UNION ALL
    SELECT unique_id, last, k + 1, list_append(h, {mean_step_sql('h')}) FROM mf_rec WHERE k < {HORIZON}
),
mf AS (
    SELECT unique_id, last + to_days(CAST(k AS INTEGER)) AS ds, h[-1] AS y_pred, CAST(k AS INTEGER) AS step
    FROM mf_rec WHERE k >= 1
)"""

RESIDUAL_POOL = """,
res AS (SELECT unique_id, ds, y - y_hat AS residual FROM mlp WHERE y IS NOT NULL),
pool AS (SELECT row_number() OVER (ORDER BY unique_id, ds) - 1 AS idx, residual FROM res),
pooln AS (SELECT count(*) AS n FROM res),
insample AS (SELECT unique_id, ds, y, y_hat AS y_pred FROM mlp WHERE y IS NOT NULL)"""
RESIDUALS = mean_lag_predict_cte("daily", "mlp") + RESIDUAL_POOL


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


# ------------------------------------------------------------ table ops

_CUR = hourly_cte("cur", "ts < TIMESTAMP '2024-01-20'")
_NEW = hourly_cte("nw", "ts >= TIMESTAMP '2024-01-15'")

sql("upsert_by_key", with_(_CUR, _NEW) + """,
u AS (SELECT *, 1 AS prio FROM cur UNION ALL SELECT *, 0 AS prio FROM nw)
SELECT key, pickup_datetime_hour, num_pickup, pickup_location_id
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY prio) AS rn FROM u) WHERE rn = 1
""")

sql("upsert_update_cols", with_(_CUR, _NEW) + """
SELECT coalesce(n.key, c.key) AS key,
       CASE WHEN c.key IS NOT NULL THEN c.pickup_datetime_hour ELSE n.pickup_datetime_hour END AS pickup_datetime_hour,
       CASE WHEN n.key IS NOT NULL THEN n.num_pickup ELSE c.num_pickup END AS num_pickup,
       CASE WHEN c.key IS NOT NULL THEN c.pickup_location_id ELSE n.pickup_location_id END AS pickup_location_id
FROM cur c FULL OUTER JOIN nw n ON c.key = n.key
""")

sql("fetch_range", with_(hourly_cte("hd")) + """
SELECT * FROM hd WHERE pickup_datetime_hour >= TIMESTAMP '2024-01-10' AND pickup_datetime_hour < TIMESTAMP '2024-01-20'
""")

sql("fetch_range_closed", with_(hourly_cte("hd")) + """
SELECT * FROM hd WHERE pickup_datetime_hour >= TIMESTAMP '2024-01-10' AND pickup_datetime_hour <= TIMESTAMP '2024-01-20'
""")

sql("fetch_locations", with_(hourly_cte("hd")) + """
SELECT * FROM hd WHERE pickup_datetime_hour >= TIMESTAMP '2000-01-01' AND pickup_datetime_hour < TIMESTAMP '2099-01-01'
  AND pickup_location_id IN (3, 7, 42)
""")

# ---------------------------------------------------------------- series

sql("daily_sum", with_(hourly_cte("hd")) + """
SELECT pickup_location_id AS unique_id, CAST(date_trunc('day', pickup_datetime_hour) AS TIMESTAMP) AS ds,
       CAST(sum(num_pickup) AS BIGINT) AS y
FROM hd GROUP BY ALL
""")

sql("daily_series", with_(DAILY) + " SELECT unique_id, ds, y FROM daily")

_LAGCOLS = " AND ".join(f"y__{i}__lag IS NOT NULL" for i in LAGS)
sql("time_lags", with_(DAILY) + f"""
SELECT * FROM (SELECT ds, unique_id, y, {lag_list()} FROM daily WINDOW w AS (PARTITION BY unique_id ORDER BY ds))
WHERE y IS NOT NULL AND {_LAGCOLS}
""")

sql("time_lags_nulls", with_(DAILY) + f"""
SELECT ds, unique_id, y, {", ".join(f"CAST(y__{i}__lag AS DOUBLE) AS y__{i}__lag" for i in LAGS)}
FROM (SELECT ds, unique_id, y, {lag_list()} FROM daily WINDOW w AS (PARTITION BY unique_id ORDER BY ds))
""")

sql("extend_horizon", with_(DAILY) + f""",
lastd AS (SELECT unique_id, max(ds) AS last FROM daily GROUP BY unique_id)
SELECT unique_id, ds, CAST(y AS DOUBLE) AS y FROM daily
UNION ALL
SELECT unique_id, last + to_days(CAST(k AS INTEGER)) AS ds, CAST(NULL AS DOUBLE) AS y
FROM lastd, generate_series(1, {HORIZON}) t(k)
""")

sql("series_slice", with_(DAILY, mean_lag_predict_cte("daily", "p")) + """,
s AS (SELECT * FROM p WHERE ds > TIMESTAMP '2001-01-01' AND unique_id IN ('1-URGENT', '5-LOW'))
SELECT ds, unique_id, 'y_hat' AS variable, round(CAST(y_hat AS DOUBLE), 6) AS value FROM s
UNION ALL
SELECT ds, unique_id, 'y' AS variable, round(CAST(y AS DOUBLE), 6) AS value FROM s
""")

# -------------------------------------------------------------- forecast

sql("mean_lag_predict", with_(DAILY, mean_lag_predict_cte("daily", "p")) + """
SELECT unique_id, ds, CAST(y AS DOUBLE) AS y, round(y_hat, 6) AS y_hat FROM p
""")

sql("mean_lag_residuals", with_(DAILY, mean_lag_predict_cte("daily", "p")) + """
SELECT unique_id, ds, round(y - y_hat, 6) AS residual FROM p WHERE y IS NOT NULL
""")

sql("mean_lag_forecast", "WITH RECURSIVE " + DAILY.strip() + "," + MEAN_FORECAST + """
SELECT unique_id, ds, round(CAST(y AS DOUBLE), 6) AS y, false AS IsForecasted FROM daily
UNION ALL
SELECT unique_id, ds, round(y_pred, 6) AS y, true AS IsForecasted FROM mf
""")

_NE_NAMES = ["intercept"] + [f"y__{i}__lag" for i in LAGS] + ["y"]
_NE_SUMS = ", ".join(
    f"round(sum(CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE)), 6) AS s__{a}__{b}"
    for i, a in enumerate(_NE_NAMES)
    for b in _NE_NAMES[i:]
)
sql("lag_normal_equations", with_(DAILY) + f""",
f AS (
    SELECT *, 1.0 AS intercept FROM (
        SELECT unique_id, ds, y, {lag_list()} FROM daily WINDOW w AS (PARTITION BY unique_id ORDER BY ds)
    ) WHERE y IS NOT NULL AND {_LAGCOLS}
)
SELECT {_NE_SUMS} FROM f
""")

# The multi-lag least-squares fit: the normal equations of the sums, solved by
# unrolled elimination (one CTE per eliminated unknown).
_UNKNOWNS = _NE_NAMES[:-1]
_P = len(_UNKNOWNS)
_RAW_SUMS = ", ".join(
    f"sum(CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE)) AS s__{a}__{b}"
    for i, a in enumerate(_NE_NAMES)
    for b in _NE_NAMES[i:]
)
LAG_FEATURES = f"""
feats AS (
    SELECT *, 1.0 AS intercept FROM (
        SELECT unique_id, ds, y, {lag_list()} FROM daily WINDOW w AS (PARTITION BY unique_id ORDER BY ds)
    ) WHERE y IS NOT NULL AND {_LAGCOLS}
)"""


def solve_ctes(sums: str, keep: str = "") -> str:
    """CTE ``beta`` (``keep`` columns, b0 ...) from the sums of ``sums``."""
    first = ", ".join(
        f"s__{_NE_NAMES[min(i, j)]}__{_NE_NAMES[max(i, j)]} AS a_{i}_{j}" for i in range(_P) for j in range(_P + 1)
    )
    out = [f"m0 AS (SELECT {keep}{first} FROM {sums})"]
    for k in range(_P):
        cells = ", ".join(
            (f"a_{k}_{j} / a_{k}_{k}" if i == k else f"a_{i}_{j} - a_{i}_{k} / a_{k}_{k} * a_{k}_{j}") + f" AS a_{i}_{j}"
            for i in range(_P)
            for j in range(k + 1, _P + 1)
        )
        out.append(f"m{k + 1} AS (SELECT {keep}{cells} FROM m{k})")
    out.append(f"beta AS (SELECT {keep}" + ", ".join(f"a_{i}_{_P} AS b{i}" for i in range(_P)) + f" FROM m{_P})")
    return ",\n".join(out)


_LINEAR_STEP = " + ".join(["b0"] + [f"b{i} * h[-{lag}]" for i, lag in enumerate(LAGS, 1)])
LINEAR_FIT = LAG_FEATURES.strip() + f""",
sums AS (SELECT {_RAW_SUMS} FROM feats),
""" + solve_ctes("sums")

sql("lag_regression_fit", with_(DAILY, LINEAR_FIT) + " SELECT round(b0, 6) AS intercept, "
    + ", ".join(f"round(b{i}, 6) AS coef_lag_{lag}" for i, lag in enumerate(LAGS, 1)) + " FROM beta")

sql("lag_regression_forecast", "WITH RECURSIVE " + DAILY.strip() + "," + MEAN_FORECAST + "," + LINEAR_FIT + f""",
lr(unique_id, last, k, h) AS (
    SELECT unique_id, last, 0, h FROM mf_hist
    UNION ALL
    SELECT unique_id, last, k + 1, list_append(h, {_LINEAR_STEP}) FROM lr, beta WHERE k < {HORIZON}
)
SELECT unique_id, last + to_days(CAST(k AS INTEGER)) AS ds, round(h[-1], 6) AS y_pred, CAST(k AS INTEGER) AS step
FROM lr WHERE k >= 1
""")

# Per fold: the sums over all rows before its test window.
sql("backtest_linear", "WITH RECURSIVE " + DAILY.strip() + "," + folds_cte().strip() + "," + LAG_FEATURES + f""",
sums AS (SELECT folds.fold_id, {_RAW_SUMS} FROM folds JOIN feats ON feats.ds < folds.test_from GROUP BY folds.fold_id),
""" + solve_ctes("sums", "fold_id, ") + rolling_ctes(_LINEAR_STEP, "JOIN beta USING (fold_id)") + """
SELECT fold_id, horizon, round(bias, 6) AS bias, round(mae, 6) AS mae, round(score, 6) AS score FROM ev
""")

# The direct strategy gives the forecasts of the recursion.
ORACLE_SQL["lag_regression_direct"] = ORACLE_SQL["lag_regression_forecast"]
ORACLE_SQL["backtest_direct"] = ORACLE_SQL["backtest_linear"]

sql("time_folds", with_(DAILY, folds_cte()) +" SELECT fold_id, train_from, test_from, test_to FROM folds")

sql("fold_sizes", with_(DAILY, folds_cte()) + """,
seg AS (
    SELECT CASE WHEN ds < (SELECT min(test_from) FROM folds) THEN -1 ELSE fold_id END AS seg, y FROM tagged
),
segs AS (SELECT seg, count(*) AS n, sum(y) AS ys FROM seg WHERE seg IS NOT NULL GROUP BY seg)
SELECT f.fold_id,
       CAST(coalesce((SELECT sum(n) FROM segs WHERE seg < f.fold_id), 0) AS BIGINT) AS train_rows,
       CAST(coalesce((SELECT sum(ys) FROM segs WHERE seg < f.fold_id), 0) AS BIGINT) AS train_y,
       CAST(coalesce((SELECT sum(n) FROM segs WHERE seg = f.fold_id), 0) AS BIGINT) AS test_rows,
       CAST(coalesce((SELECT sum(ys) FROM segs WHERE seg = f.fold_id), 0) AS BIGINT) AS test_y
FROM folds f
""")

sql("rolling_cutoffs", with_(DAILY, folds_cte()) + " SELECT fold_id, cutoff FROM cut")

sql("rolling_origin_forecast", "WITH RECURSIVE " + DAILY.strip() + "," + ROLLING + """
SELECT fold_id, unique_id, ds, cutoff, y, round(y_pred, 6) AS y_pred FROM rof
""")

# Orders per (nation of the customer, day): series with gaps.
NATION_COUNTS = """
ncounts AS (
    SELECT CAST(c_nationkey AS VARCHAR) AS unique_id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ds, count(*) AS y
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL
)"""
sql("rolling_origin_asof", "WITH RECURSIVE " + NATION_COUNTS.strip() + "," + folds_cte("ncounts") + rolling_ctes(mean_step_sql("h")) + """
SELECT fold_id, unique_id, ds, cutoff, y, round(y_pred, 6) AS y_pred FROM rof
""")
sql("lag_normal_equations_gappy", with_(NATION_COUNTS) + f""",
f AS (
    SELECT *, 1.0 AS intercept FROM (
        SELECT unique_id, ds, y, {lag_list()} FROM ncounts WINDOW w AS (PARTITION BY unique_id ORDER BY ds)
    ) WHERE y IS NOT NULL AND {_LAGCOLS}
)
SELECT {_NE_SUMS} FROM f
""")
sql("time_lags_gappy", with_(NATION_COUNTS) + f""",
l AS (SELECT ds, unique_id, y, {lag_list()} FROM ncounts WINDOW w AS (PARTITION BY unique_id ORDER BY ds))
SELECT * FROM l WHERE {_LAGCOLS}
""")

sql("evaluate_forecast", "WITH RECURSIVE " + DAILY.strip() + "," + ROLLING + """
SELECT fold_id, horizon, round(bias, 6) AS bias, round(mae, 6) AS mae, round(score, 6) AS score FROM ev
""")

sql("backtest", ORACLE_SQL["evaluate_forecast"])

_WIDE = ", ".join(
    f"round(max(CASE WHEN horizon = {k} THEN {m} END), 6) AS {m}_{k}"
    for m in ("bias", "mae", "score")
    for k in range(1, HORIZON + 1)
)
sql("metrics_wide", "WITH RECURSIVE " + DAILY.strip() + "," + ROLLING + f"""
SELECT fold_id, {_WIDE} FROM ev GROUP BY fold_id
""")

sql("predict_for_date", with_(hourly_cte("hd")) + """,
f AS (SELECT * FROM hd WHERE pickup_datetime_hour >= TIMESTAMP '2024-01-02' AND pickup_datetime_hour < TIMESTAMP '2024-01-31'),
d AS (
    SELECT pickup_location_id AS unique_id, CAST(date_trunc('day', pickup_datetime_hour) AS TIMESTAMP) AS ds,
           CAST(sum(num_pickup) AS BIGINT) AS y
    FROM f GROUP BY ALL
),""" + mean_lag_predict_cte("d", "p") + """
SELECT unique_id, ds, CAST(y AS DOUBLE) AS y, round(y_hat, 6) AS y_hat FROM p WHERE y IS NULL
""")

# ------------------------------------------------------------- intervals

_SEED = 25
_ROWKEY = sql_combine_keys(sql_text_key("i.unique_id"), "epoch_us(CAST(i.ds AS TIMESTAMP))")


def intervals_cte(draws: int) -> str:
    """``iv``: the bounds of every in-sample row from ``draws`` draws."""
    lo, hi = nearest_rank(draws, 0.025) + 1, nearest_rank(draws, 0.975) + 1
    return f""",
draws AS (
    SELECT i.unique_id, i.ds, i.y, i.y_pred, b,
           {sql_draw_index('k', 'b', '(SELECT n FROM pooln)', _SEED)} AS idx
    FROM (SELECT i.*, {_ROWKEY} AS k FROM insample i) i, generate_series(0, {draws - 1}) t(b)
),
vals AS (
    SELECT d.unique_id, d.ds, d.y, d.y_pred, list_sort(list(d.y_pred + p.residual)) AS s
    FROM draws d JOIN pool p ON p.idx = d.idx GROUP BY d.unique_id, d.ds, d.y, d.y_pred
),
iv AS (
    SELECT unique_id, ds, y, y_pred, s[{lo}] AS lower_bound, s[{hi}] AS upper_bound,
           s[{hi}] - s[{lo}] AS width
    FROM vals
)"""


INTERVALS = RESIDUALS + intervals_cte(500)

sql("bootstrap_interval", with_(DAILY, INTERVALS) + """
SELECT unique_id, ds, y, round(y_pred, 6) AS y_pred, round(lower_bound, 6) AS lower_bound,
       round(upper_bound, 6) AS upper_bound, round(width, 6) AS width
FROM iv
""")

HOURLY_SERIES = hourly_cte("hd") + """,
hs AS (
    SELECT CAST(pickup_location_id AS VARCHAR) AS unique_id, pickup_datetime_hour AS ds,
           CAST(num_pickup AS BIGINT) AS y
    FROM hd
)"""
sql("bootstrap_interval_hourly", with_(HOURLY_SERIES) + ","
    + mean_lag_predict_cte("hs", "mlp", HOURLY_LAGS, "HOUR") + RESIDUAL_POOL + intervals_cte(HOURLY_DRAWS) + """
SELECT unique_id, ds, y, round(y_pred, 6) AS y_pred, round(lower_bound, 6) AS lower_bound,
       round(upper_bound, 6) AS upper_bound, round(width, 6) AS width
FROM iv
""")

sql("interval_coverage", with_(DAILY, INTERVALS) + """
SELECT y BETWEEN lower_bound AND upper_bound AS in_ci, count(y) AS n FROM iv GROUP BY 1
""")

_BP = 1000
_PLO, _PHI = nearest_rank(_BP, 0.025) + 1, nearest_rank(_BP, 0.975) + 1
_PKEY = sql_combine_keys(sql_text_key("m.unique_id"), "m.step")
sql("multi_step_bootstrap", "WITH RECURSIVE " + DAILY.strip() + "," + MEAN_FORECAST + "," + RESIDUALS + f""",
x AS (
    SELECT m.unique_id, m.ds, m.step, b,
           m.y_pred + p.residual AS x
    FROM mf m, generate_series(0, {_BP - 1}) t(b)
    JOIN pool p ON p.idx = {sql_draw_index(_PKEY, 'b', '(SELECT n FROM pooln)', _SEED)}
),
path(unique_id, b, step, ds, v) AS (
    SELECT unique_id, b, step, ds, 0.0 * 0.25 + x FROM x WHERE step = 1
    UNION ALL
    SELECT x.unique_id, x.b, x.step, x.ds, p.v * 0.25 + x.x
    FROM path p JOIN x ON x.unique_id = p.unique_id AND x.b = p.b AND x.step = p.step + 1
),
agg AS (SELECT unique_id, ds, step, avg(v) AS prediction, list_sort(list(v)) AS s FROM path GROUP BY ALL)
SELECT unique_id, ds, step, round(prediction, 6) AS prediction, round(s[{_PLO}], 6) AS lower_bound,
       round(s[{_PHI}], 6) AS upper_bound, round(s[{_PHI}] - s[{_PLO}], 6) AS width
FROM agg
""")

# ------------------------------------------------------------- residuals

sql("mae", with_(DAILY, RESIDUALS) + """
SELECT unique_id, round(avg(abs(y - y_pred)), 6) AS mae, count(y) AS n FROM insample GROUP BY unique_id
""")

sql("residual_moments", with_(DAILY, RESIDUALS) + """
SELECT unique_id, count(residual) AS n, round(avg(residual), 6) AS mean, round(stddev_samp(residual), 6) AS std
FROM res GROUP BY unique_id
""")

sql("residual_histogram", with_(DAILY, RESIDUALS) + """,
b AS (SELECT min(residual) AS lo, max(residual) AS hi FROM res),
h AS (
    SELECT CAST(CASE WHEN b.hi - b.lo = 0 THEN 0
                     ELSE least(floor((r.residual - b.lo) / (b.hi - b.lo) * 20), 19) END AS INTEGER) AS bucket
    FROM res r, b WHERE r.residual IS NOT NULL
)
SELECT h.bucket, round(b.lo + (b.hi - b.lo) * h.bucket / 20, 6) AS lower,
       round(b.lo + (b.hi - b.lo) * (h.bucket + 1) / 20, 6) AS upper, count(*) AS n
FROM h, b GROUP BY h.bucket, b.lo, b.hi
""")

_PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
_QVALUES = ", ".join(f"({q})" for q in _PROBS)
sql("residual_quantiles", with_(DAILY, RESIDUALS) + f""",
rk AS (
    SELECT unique_id, residual, row_number() OVER (PARTITION BY unique_id ORDER BY residual) - 1 AS r,
           count(*) OVER (PARTITION BY unique_id) AS n
    FROM res WHERE residual IS NOT NULL
),
qs AS (SELECT CAST(q AS DOUBLE) AS q FROM (VALUES {_QVALUES}) t(q))
SELECT rk.unique_id, qs.q, round(rk.residual, 6) AS value
FROM rk JOIN qs ON rk.r = CAST(floor(CAST(rk.n - 1 AS DOUBLE) * qs.q + 0.5) AS BIGINT)
""")

_ACF_LAGS = 30
_ACF_SUMS = ", ".join(f"sum(c * l{k}) AS n{k}" for k in range(1, _ACF_LAGS + 1))
_ACF_LAGCOLS = ", ".join(f"lag(c, {k}) OVER w AS l{k}" for k in range(1, _ACF_LAGS + 1))
_ACF_ROWS = " UNION ALL ".join(
    f"SELECT unique_id, {k} AS lag, round(coalesce(n{k}, 0.0) / nullif(den, 0), 6) AS acf FROM sums"
    for k in range(1, _ACF_LAGS + 1)
)
sql("residual_acf", with_(DAILY, RESIDUALS) + f""",
cen AS (
    SELECT unique_id, ds, residual - avg(residual) OVER (PARTITION BY unique_id) AS c FROM res
    WHERE residual IS NOT NULL
),
lg AS (SELECT unique_id, c, {_ACF_LAGCOLS} FROM cen WINDOW w AS (PARTITION BY unique_id ORDER BY ds)),
sums AS (SELECT unique_id, sum(c * c) AS den, {_ACF_SUMS} FROM lg GROUP BY unique_id)
{_ACF_ROWS}
""")

# ------------------------------------------------------------- streaming

sql("stream_hourly_counts", with_(TRIPS_CLEAN) + """
SELECT strftime(date_trunc('hour', pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') || '-' || CAST(pickup_location_id AS VARCHAR) AS key,
       date_trunc('hour', pickup_datetime) AS pickup_datetime_hour,
       CAST(count(pickup_location_id) AS INTEGER) AS num_pickup, pickup_location_id
FROM trips WHERE pickup_location_id IS NOT NULL GROUP BY ALL
""")

# ------------------------------------------------------ more forecast views

sql("horizon_predictions", with_(DAILY) + f""",
lastd AS (SELECT unique_id, max(ds) AS last FROM daily GROUP BY unique_id),
fut AS (
    SELECT unique_id, last + to_days(CAST(k AS INTEGER)) AS ds FROM lastd, generate_series(1, {HORIZON}) t(k)
),
filled AS (SELECT unique_id, ds, y FROM daily UNION ALL SELECT unique_id, ds, CAST(0 AS BIGINT) FROM fut),""" + mean_lag_predict_cte("filled", "p") + """
SELECT p.unique_id, p.ds, p.y, round(p.y_hat, 6) AS y_hat
FROM p SEMI JOIN fut ON fut.unique_id = p.unique_id AND fut.ds = p.ds
""")

sql("lag1_regression_forecast", "WITH RECURSIVE " + DAILY.strip() + f""",
pairs AS (
    SELECT y, lag(y, 1) OVER (PARTITION BY unique_id ORDER BY ds) AS x FROM daily
),
fit AS (SELECT regr_intercept(y, x) AS b0, regr_slope(y, x) AS b1 FROM pairs WHERE x IS NOT NULL),
lastrow AS (
    SELECT unique_id, max(ds) AS last, arg_max(CAST(y AS DOUBLE), ds) AS v, count(*) AS n FROM daily GROUP BY unique_id
),
rec(unique_id, last, k, v) AS (
    SELECT unique_id, last, 0, v FROM lastrow WHERE n >= 2
    UNION ALL
    SELECT r.unique_id, r.last, r.k + 1, f.b0 + f.b1 * r.v FROM rec r, fit f WHERE r.k < {HORIZON}
)
SELECT unique_id, last + to_days(CAST(k AS INTEGER)) AS ds, round(v, 6) AS y_pred, CAST(k AS INTEGER) AS step
FROM rec WHERE k >= 1
""")

sql("hourly_lags", with_(hourly_cte("hd")) + """,
s AS (SELECT pickup_location_id AS unique_id, pickup_datetime_hour AS ds, num_pickup AS y FROM hd),
l AS (
    SELECT ds, unique_id, y, lag(y, 1) OVER w AS y__1__lag, lag(y, 24) OVER w AS y__24__lag,
           lag(y, 168) OVER w AS y__168__lag
    FROM s WINDOW w AS (PARTITION BY unique_id ORDER BY ds)
)
SELECT * FROM l WHERE y__1__lag IS NOT NULL AND y__24__lag IS NOT NULL AND y__168__lag IS NOT NULL
""")

sql("table_fetch", ORACLE_SQL["fetch_range"])

sql("load_table", ORACLE_SQL["hourly_demand_multi_month"])

sql("scan_monthly", with_(ORDERS_MONTHLY) + """
SELECT pickup_datetime, passenger_count, CAST(pickup_location_id AS INTEGER) AS pickup_location_id, file_month FROM otrips
""")

sql("snapshot_fetch", ORACLE_SQL["fetch_range"])

# Days of whole months from the first order's to the last order's, for every nation with orders.
sql("backtest_from_table", "WITH RECURSIVE " + ORDERS_MONTHLY.strip() + """,
ncounts AS (
    SELECT pickup_location_id AS unique_id, CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS ds, count(*) AS y
    FROM otrips WHERE pickup_location_id IS NOT NULL GROUP BY ALL
),
nbounds AS (
    SELECT CAST(date_trunc('month', min(ds)) AS TIMESTAMP) AS lo,
           CAST(date_trunc('month', max(ds)) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS TIMESTAMP) AS hi
    FROM ncounts
),
ngrid AS (
    SELECT s.unique_id, unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS ds
    FROM (SELECT DISTINCT unique_id FROM ncounts) s CROSS JOIN nbounds b
),
daily AS (
    SELECT g.unique_id, g.ds, CAST(coalesce(c.y, 0) AS BIGINT) AS y
    FROM ngrid g LEFT JOIN ncounts c ON c.unique_id = g.unique_id AND c.ds = g.ds
),""" + ROLLING.lstrip().removeprefix(",") + """
SELECT fold_id, horizon, round(bias, 6) AS bias, round(mae, 6) AS mae, round(score, 6) AS score FROM ev
""")

sql("stream_then_close_month", ORACLE_SQL["hourly_demand"])

sql("latest_rows", with_(hourly_cte("hd")) + """
SELECT * FROM hd ORDER BY pickup_datetime_hour DESC, key DESC LIMIT 10
""")
