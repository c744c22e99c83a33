"""DuckDB twins of the registered queries (the correctness oracle).

Each SQL runs on the driver's pre-registered views (``events`` …) and must
return the same columns, names and values as the Spark query of the same key.
``raw_flights`` and ``flights`` are spelled as CTEs following the same rules
as ``sources/events_flights.py`` and ``operators/parse.py``.
"""

from __future__ import annotations

RAW_FLIGHTS = """
raw_flights AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN 'Year' ELSE strftime(ts, '%Y') END AS "Year",
    CASE WHEN event_id % 89 = 1 THEN strftime(ts, '%m/%d/%Y')
         WHEN event_id % 89 = 2 THEN ''
         ELSE strftime(ts, '%Y-%m-%d') END AS FlightDate,
    upper(substr(event_type, 1, 2)) AS Reporting_Airline,
    CAST(user_id AS VARCHAR) AS Flight_Number_Reporting_Airline,
    CAST(10000 + user_id % 20 AS VARCHAR) AS OriginAirportID,
    'City ' || CAST(user_id % 20 AS VARCHAR) || ', ST' AS OriginCityName,
    CASE WHEN event_id % 83 = 3 THEN '2400' WHEN event_id % 83 = 4 THEN ''
         ELSE strftime(ts, '%H%M') END AS WheelsOff,
    CASE WHEN event_id % 79 = 5 THEN '' WHEN event_id % 79 = 6 THEN 'abc'
         ELSE CAST(CAST(floor(value) AS BIGINT) - 20 AS VARCHAR) END AS DepDelay,
    CASE WHEN event_id % 73 = 7 THEN ''
         ELSE CAST(CAST(floor(value) AS BIGINT) - 18 + event_id % 7 AS VARCHAR) END AS ArrDelay,
    CAST(5 + event_id % 30 AS VARCHAR) AS TaxiOut,
    CASE WHEN event_id % 71 = 8 THEN '' ELSE CAST(100 + event_id % 2000 AS VARCHAR) END AS Distance,
    CASE WHEN event_id % 67 = 9 THEN ''
         WHEN event_type = 'error' AND event_id % 5 = 0 THEN '1.00'
         ELSE '0.00' END AS Cancelled,
    CASE WHEN event_id % 61 = 10 THEN '1.00' ELSE '0.00' END AS Diverted
  FROM events
)"""

PARSED = """
typed AS (
  SELECT r.*,
    TRY_CAST(Cancelled AS DOUBLE) AS c_num,
    TRY_CAST(Diverted AS DOUBLE) AS d_num,
    try_strptime(coalesce(FlightDate, '') || 'T' || substr(coalesce(WheelsOff, ''), 1, 2) || ':'
                 || substr(coalesce(WheelsOff, ''), 3, 2) || ':00', '%Y-%m-%dT%H:%M:%S') AS ts_p,
    TRY_CAST(DepDelay AS DOUBLE) AS dep,
    TRY_CAST(ArrDelay AS DOUBLE) AS arr,
    TRY_CAST(TaxiOut AS DOUBLE) AS taxi,
    TRY_CAST(Distance AS DOUBLE) AS dist
  FROM raw_flights r
),
parsed AS (
  SELECT *,
    coalesce("Year", '') = 'Year' AS is_header,
    CASE
      WHEN coalesce("Year", '') = 'Year' THEN NULL
      WHEN length(coalesce(WheelsOff, '')) <> 4 THEN 'wheels_off_length'
      WHEN length(coalesce(FlightDate, '')) <> 10 THEN 'flight_date_length'
      WHEN coalesce(Distance, '') = '' THEN 'distance_missing'
      WHEN c_num IS NULL THEN 'bad_cancelled_flag'
      WHEN NOT (c_num > 0 AND NOT isnan(c_num)) AND d_num IS NULL THEN 'bad_diverted_flag'
      WHEN ts_p IS NULL THEN 'bad_timestamp'
      WHEN dep IS NULL THEN 'bad_departure_delay'
      WHEN arr IS NULL THEN 'bad_arrival_delay'
      WHEN taxi IS NULL THEN 'bad_taxi_out'
      WHEN dist IS NULL THEN 'bad_distance'
    END AS reason
  FROM typed
),
flights AS (
  SELECT event_id,
    ts_p AS "timestamp",
    coalesce(Reporting_Airline, '') || '//' || coalesce(Flight_Number_Reporting_Airline, '') AS flight_number,
    coalesce(OriginAirportID, '') AS origin_airport_id,
    (c_num > 0 AND NOT isnan(c_num)) OR coalesce(d_num > 0 AND NOT isnan(d_num), false) AS is_cancelled,
    dep AS departure_delay_minutes,
    arr AS arrival_delay_minutes,
    taxi AS taxi_out_minutes,
    dist AS distance_miles
  FROM parsed
  WHERE reason IS NULL AND NOT is_header
)"""

AIRPORT_WINDOWS = """
airport_windows AS (
  SELECT time_bucket(INTERVAL 1 HOUR, f."timestamp") - k.i * INTERVAL 1 HOUR AS window_start,
         origin_airport_id, departure_delay_minutes
  FROM flights f, (SELECT unnest(range(0, 4)) AS i) k
),
airport_means AS (
  SELECT window_start, window_start + INTERVAL 4 HOUR AS window_end, origin_airport_id,
         avg(departure_delay_minutes) AS average_departure_delay
  FROM airport_windows GROUP BY window_start, origin_airport_id
)"""

TRAIN = """
completed AS (
  SELECT event_id,
    TRY_CAST(DepDelay AS DOUBLE) AS DepDelay,
    TRY_CAST(TaxiOut AS DOUBLE) AS TaxiOut,
    TRY_CAST(Distance AS DOUBLE) AS Distance,
    TRY_CAST(ArrDelay AS DOUBLE) AS ArrDelay,
    FlightDate
  FROM raw_flights
  WHERE NOT (coalesce(TRY_CAST(Cancelled AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(Cancelled AS DOUBLE)), false)
          OR coalesce(TRY_CAST(Diverted AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(Diverted AS DOUBLE)), false))
),
labelled AS (
  SELECT event_id, DepDelay, TaxiOut, Distance,
    coalesce(CASE WHEN isnan(ArrDelay) THEN NULL ELSE ArrDelay END > 15.0, false) AS target,
    FlightDate
  FROM completed
),
train AS (SELECT event_id, DepDelay, TaxiOut, Distance, target FROM labelled WHERE FlightDate < '2024-01-20'),
test AS (SELECT event_id, DepDelay, TaxiOut, Distance, target FROM labelled WHERE FlightDate >= '2024-01-20')"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_RF = _with(RAW_FLIGHTS)
_FL = _with(RAW_FLIGHTS, PARSED)
_AW = _with(RAW_FLIGHTS, PARSED, AIRPORT_WINDOWS)
_TR = _with(RAW_FLIGHTS, TRAIN)

_RAW_COLS = ["Year", "FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline",
             "OriginAirportID", "OriginCityName", "WheelsOff", "DepDelay", "ArrDelay", "TaxiOut",
             "Distance", "Cancelled", "Diverted"]

_FLIGHT_COLS = ('event_id, "timestamp", flight_number, origin_airport_id, is_cancelled, '
                'departure_delay_minutes, arrival_delay_minutes, taxi_out_minutes, distance_miles')

_SCALE_STATS = """
imp AS (
  SELECT event_id, target,
    coalesce(CASE WHEN isnan(DepDelay) THEN NULL ELSE DepDelay END, avg(CASE WHEN isnan(DepDelay) THEN NULL ELSE DepDelay END) OVER ()) AS DepDelay,
    coalesce(CASE WHEN isnan(TaxiOut) THEN NULL ELSE TaxiOut END, avg(CASE WHEN isnan(TaxiOut) THEN NULL ELSE TaxiOut END) OVER ()) AS TaxiOut,
    coalesce(CASE WHEN isnan(Distance) THEN NULL ELSE Distance END, avg(CASE WHEN isnan(Distance) THEN NULL ELSE Distance END) OVER ()) AS Distance
  FROM train
)"""

# --- logistic regression by Newton's method, unrolled --------------------------
# Standardised features x1..x3 and the constant x0 = 1; ridge 1/2 on the
# weights, none on the constant. Each step is one pass of sums (gradient g,
# Hessian h) and a 4x4 symmetric solve by L D L'.
NEWTON_STEPS = 9
_X = ["1.0", "x1", "x2", "x3"]


def _newton_step(k: int) -> str:
    z = " + ".join(f"b{i} * {x}" for i, x in enumerate(_X))
    g = ", ".join(f"sum((p - y) * {x}) AS s{i}" for i, x in enumerate(_X))
    h = ", ".join(f"sum(p * (1 - p) * {_X[i]} * {_X[j]}) AS r{i}{j}" for i in range(4) for j in range(i + 1))
    ridge = lambda i: 1 if i else 0
    parts = [f"""
t{k} AS MATERIALIZED (SELECT b0, b1, b2, b3, {g}, {h} FROM (
  SELECT *, 1 / (1 + exp(-({z}))) AS p FROM std, w{k - 1}) GROUP BY b0, b1, b2, b3)""", f"""
h{k} AS (SELECT b0, b1, b2, b3, {", ".join(f"s{i} + {ridge(i)} * b{i} AS g{i}" for i in range(4))},
  {", ".join(f"r{i}{j} + {ridge(i) if i == j else 0} AS h{i}{j}" for i in range(4) for j in range(i + 1))} FROM t{k})"""]
    prev, carry = f"h{k}", "*"
    for j in range(4):          # column j of L, and d_j
        d = f"h{j}{j}" + "".join(f" - l{j}{m} * l{j}{m} * d{m}" for m in range(j))
        parts.append(f"\nd{k}_{j} AS (SELECT {carry}, {d} AS d{j} FROM {prev})")
        cols = ", ".join(f"(h{i}{j}" + "".join(f" - l{i}{m} * l{j}{m} * d{m}" for m in range(j)) + f") / d{j} AS l{i}{j}"
                         for i in range(j + 1, 4))
        prev = f"d{k}_{j}"
        if cols:
            parts.append(f"\nl{k}_{j} AS (SELECT *, {cols} FROM {prev})")
            prev = f"l{k}_{j}"
    for i in range(4):          # forward
        parts.append(f"\nf{k}_{i} AS (SELECT *, g{i}" + "".join(f" - l{i}{m} * f{m}" for m in range(i)) + f" AS f{i} FROM {prev})")
        prev = f"f{k}_{i}"
    for i in (3, 2, 1, 0):      # backward
        parts.append(f"\nu{k}_{i} AS (SELECT *, f{i} / d{i}" + "".join(f" - l{m}{i} * u{m}" for m in range(i + 1, 4))
                     + f" AS u{i} FROM {prev})")
        prev = f"u{k}_{i}"
    parts.append(f"\nw{k} AS MATERIALIZED (SELECT {', '.join(f'b{i} - u{i} AS b{i}' for i in range(4))} FROM {prev})")
    return ",".join(parts)


def _filled(c: str, source: str) -> str:
    return f"coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, i.{c})" if source else ""


_FEATURES = ["DepDelay", "TaxiOut", "Distance"]
MODEL = """
means AS MATERIALIZED (SELECT """ + ", ".join(
    f"avg(CASE WHEN isnan({c}) THEN NULL ELSE {c} END) AS {c}" for c in _FEATURES) + """ FROM train),
moments AS MATERIALIZED (SELECT """ + ", ".join(
    f"avg(v{n}) AS m{n}, CASE WHEN stddev_pop(v{n}) > 0 THEN stddev_pop(v{n}) ELSE 1.0 END AS s{n}" for n in (1, 2, 3)) + """
  FROM (SELECT """ + ", ".join(f"{_filled('t.' + c, 'i').replace('i.t.', 'i.')} AS v{n}" for n, c in enumerate(_FEATURES, 1)) + """
        FROM train t, means i)),
std AS MATERIALIZED (SELECT CASE WHEN target THEN 1.0 ELSE 0.0 END AS y, """ + ", ".join(
    f"({_filled('t.' + c, 'i').replace('i.t.', 'i.')} - m{n}) / s{n} AS x{n}" for n, c in enumerate(_FEATURES, 1)) + """
  FROM train t, means i, moments),
w0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS b3),""" \
    + ",".join(_newton_step(k) for k in range(1, NEWTON_STEPS + 1)) + """,
scored AS MATERIALIZED (SELECT event_id, target, 1 / (1 + exp(-(b0 + """ + " + ".join(
    f"b{n} * ({_filled('t.' + c, 'i').replace('i.t.', 'i.')} - m{n}) / s{n}" for n, c in enumerate(_FEATURES, 1)) + f"""))) AS p
  FROM test t, means i, moments, w{NEWTON_STEPS})"""

GRID = "(VALUES (false, false), (false, true), (true, false), (true, true)) g(actual, predicted)"


def _roc(points: str) -> str:
    """ROC points of a relation (score, target)."""
    return f"""
, s AS (SELECT score, sum(CASE WHEN target THEN 1 ELSE 0 END) AS p, sum(CASE WHEN target THEN 0 ELSE 1 END) AS n
        FROM ({points}) GROUP BY score),
c AS (SELECT score, sum(p) OVER w AS tps, sum(n) OVER w AS fps FROM s
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT score, tps, fps, lag(tps) OVER o AS lt, lead(tps) OVER o AS nt, lag(fps) OVER o AS lf, lead(fps) OVER o AS nf
      FROM c WINDOW o AS (ORDER BY score DESC)),
tot AS (SELECT sum(p) AS P, sum(n) AS N, max(score) AS mx FROM s),
roc AS (SELECT mx + 1 AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM tot WHERE mx IS NOT NULL
  UNION ALL
  SELECT score AS threshold, CAST(fps AS DOUBLE) / N AS fpr, CAST(tps AS DOUBLE) / P AS tpr FROM k, tot
  WHERE lt IS NULL OR nt IS NULL OR nt - 2 * tps + lt <> 0 OR nf - 2 * fps + lf <> 0)"""


_MODEL = _with(RAW_FLIGHTS, TRAIN, MODEL)
_SCORES = "SELECT event_id, target, round(p, 4) + 0.0 AS probability, p > 0.5 AS prediction FROM scored"
_CONFUSION = f"""
SELECT g.actual, g.predicted, count(t.target) AS n FROM {GRID}
LEFT JOIN scored t ON t.target = g.actual AND (t.p > 0.5) = g.predicted GROUP BY g.actual, g.predicted"""
_INGESTED = """
, loads AS (
  SELECT 1 AS load_id, * FROM flights WHERE CAST("timestamp" AS DATE) < DATE '2024-01-20'
  UNION ALL
  SELECT 2 AS load_id, event_id, "timestamp", flight_number, origin_airport_id, is_cancelled,
         departure_delay_minutes + 1, arrival_delay_minutes, taxi_out_minutes, distance_miles
  FROM flights WHERE CAST("timestamp" AS DATE) >= DATE '2024-01-15'
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY flight_number, "timestamp"
    ORDER BY load_id DESC, origin_airport_id DESC, is_cancelled DESC, departure_delay_minutes DESC,
             arrival_delay_minutes DESC, taxi_out_minutes DESC, distance_miles DESC) AS rn
  FROM loads
)
SELECT flight_number, "timestamp", origin_airport_id, is_cancelled, departure_delay_minutes,
       arrival_delay_minutes, taxi_out_minutes, distance_miles
FROM ranked WHERE rn = 1"""

# a week of the month stands for a month; an empty field of a CSV is null, and header lines are not stored
_WEEK = "1 + (day(ts) - 1) // 7"
_STORED = ", ".join(f"nullif(\"{c}\", '') AS \"{c}\"" for c in _RAW_COLS)


def _delivery(first: int, last: int) -> str:
    """Scored test rows of the archives ``first``..``last``, by the model of all archives so far."""
    chain = _with(RAW_FLIGHTS, TRAIN.split("train AS (")[0] + f"""stored AS (
  SELECT l.*, {_WEEK} AS week FROM labelled l JOIN events USING (event_id) JOIN raw_flights r USING (event_id)
  WHERE r."Year" <> 'Year' AND l.FlightDate <> ''),
train AS (SELECT event_id, DepDelay, TaxiOut, Distance, target FROM stored WHERE FlightDate < '2024-01-20' AND week <= {last}),
test AS (SELECT * FROM stored WHERE FlightDate >= '2024-01-20' AND week BETWEEN {first} AND {last})""", MODEL)
    return f"SELECT * FROM ({chain} SELECT week, scored.target, p FROM scored JOIN test USING (event_id))"


_DELIVERIES = f"WITH d AS MATERIALIZED ({_delivery(1, 3)} UNION ALL {_delivery(4, 5)})"
_MONTHLY_ROC = """
, s AS (SELECT week, round(p, 4) + 0.0 AS score, sum(CASE WHEN target THEN 1 ELSE 0 END) AS p, sum(CASE WHEN target THEN 0 ELSE 1 END) AS n
        FROM d GROUP BY week, round(p, 4) + 0.0),
c AS (SELECT week, score, sum(p) OVER w AS tps, sum(n) OVER w AS fps FROM s
      WINDOW w AS (PARTITION BY week ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT *, lag(tps) OVER o AS lt, lead(tps) OVER o AS nt, lag(fps) OVER o AS lf, lead(fps) OVER o AS nf
      FROM c WINDOW o AS (PARTITION BY week ORDER BY score DESC)),
tot AS (SELECT week, sum(p) AS P, sum(n) AS N, max(score) AS mx FROM s GROUP BY week)
SELECT 2024 AS file_year, CAST(week AS INTEGER) AS file_month, mx + 1 AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM tot
UNION ALL
SELECT 2024, CAST(week AS INTEGER), score, CASE WHEN N > 0 THEN CAST(fps AS DOUBLE) / N END, CASE WHEN P > 0 THEN CAST(tps AS DOUBLE) / P END
FROM k JOIN tot USING (week)
WHERE lt IS NULL OR nt IS NULL OR nt - 2 * tps + lt <> 0 OR nf - 2 * fps + lf <> 0"""

_LATE = """event_id % 50 = 0 AND CAST("timestamp" AS DATE) < DATE '2024-01-08'"""
_FINAL = _with(RAW_FLIGHTS, PARSED, AIRPORT_WINDOWS.replace("FROM flights f,", f"FROM (SELECT * FROM flights WHERE NOT ({_LATE})) f,"))

_HEAD = ", ".join(f"nullif(\"{c}\", '') AS \"{c}\"" for c in (
    "FlightDate", "Cancelled", "Diverted", "DepDelay", "TaxiOut", "Distance", "ArrDelay"))

SQL = {
    "latest_online_view": _FL + _INGESTED.split("ranked AS (")[0] + """
all_loads AS (
  SELECT * FROM loads
  UNION ALL
  SELECT 3, event_id, "timestamp", flight_number, origin_airport_id, is_cancelled, departure_delay_minutes, arrival_delay_minutes,
         0.0, distance_miles
  FROM loads WHERE load_id = 2 AND CAST("timestamp" AS DATE) >= DATE '2024-01-25' AND event_id % 3 = 0
)
SELECT flight_number, "timestamp", origin_airport_id, is_cancelled, departure_delay_minutes,
       arrival_delay_minutes, taxi_out_minutes, distance_miles
FROM (SELECT *, row_number() OVER (PARTITION BY flight_number
        ORDER BY "timestamp" DESC, load_id DESC, origin_airport_id DESC, is_cancelled DESC, departure_delay_minutes DESC,
                 arrival_delay_minutes DESC, taxi_out_minutes DESC, distance_miles DESC) AS rn FROM all_loads) WHERE rn = 1""",

    "bucketed_table_latest": _FL + _INGESTED.replace("SELECT flight_number, \"timestamp\", origin", "SELECT * EXCLUDE (k) FROM (SELECT flight_number, \"timestamp\", origin") \
        .replace("distance_miles\nFROM ranked WHERE rn = 1", """distance_miles,
  row_number() OVER (PARTITION BY flight_number ORDER BY "timestamp" DESC) AS k
FROM ranked WHERE rn = 1) WHERE k = 1"""),

    "daily_model_confusion": _MODEL + f"""
, t AS (SELECT l.FlightDate AS flight_date, s.target, s.p > 0.5 AS predicted FROM scored s JOIN labelled l USING (event_id))
SELECT d.flight_date, g.actual, g.predicted, count(t.target) AS n
FROM (SELECT DISTINCT flight_date FROM t) d CROSS JOIN {GRID}
LEFT JOIN t ON t.flight_date = d.flight_date AND t.target = g.actual AND t.predicted = g.predicted
GROUP BY ALL""",

    "named_csv_head": _RF + f"SELECT event_id, {_HEAD} FROM raw_flights ORDER BY event_id LIMIT 400",

    "stream_final_windows": _FINAL + """
SELECT window_start, window_end, origin_airport_id, (round(average_departure_delay, 6) + 0.0) AS average_departure_delay FROM airport_means""",

    "stream_late_rows": _FL + f"""
SELECT origin_airport_id, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event
FROM flights WHERE {_LATE} GROUP BY origin_airport_id""",

    "stream_enriched_requests": _FINAL + """
SELECT f.event_id, f.origin_airport_id AS airport, f."timestamp" AS "time", m.window_end AS feature_time,
       (round(m.average_departure_delay, 6) + 0.0) AS average_departure_delay
FROM flights f LEFT JOIN airport_means m
  ON m.origin_airport_id = f.origin_airport_id AND m.window_end <= f."timestamp" AND m.window_end > f."timestamp" - INTERVAL 1 HOUR""",

    "zip_round_trip": _RF + f"""
SELECT 2024 AS file_year, CAST({_WEEK} AS INTEGER) AS file_month, {_STORED}
FROM raw_flights JOIN events USING (event_id) WHERE "Year" <> 'Year'""",

    "monthly_sample": _RF + f"""
SELECT * EXCLUDE (k) FROM (
  SELECT 2024 AS file_year, CAST({_WEEK} AS INTEGER) AS file_month, {_STORED},
         row_number() OVER (PARTITION BY {_WEEK} ORDER BY event_id) AS k
  FROM raw_flights JOIN events USING (event_id) WHERE "Year" <> 'Year') WHERE k <= 100""",

    "monthly_confusion": _DELIVERIES + f"""
SELECT 2024 AS file_year, CAST(m.week AS INTEGER) AS file_month, g.actual, g.predicted, count(d.target) AS n
FROM (SELECT DISTINCT week FROM d) m CROSS JOIN {GRID}
LEFT JOIN d ON d.week = m.week AND d.target = g.actual AND (d.p > 0.5) = g.predicted
GROUP BY ALL""",

    "monthly_roc": _DELIVERIES + _MONTHLY_ROC,

    "csv_decode": _RF + "SELECT event_id, " + ", ".join(
        f"nullif(\"{c}\", '') AS \"{c}\"" for c in _RAW_COLS) + " FROM raw_flights",

    "flight_guard": _RF + """
SELECT event_id, "Year", FlightDate, WheelsOff, Distance FROM raw_flights
WHERE coalesce("Year", '') <> 'Year' AND length(coalesce(WheelsOff, '')) = 4
  AND length(coalesce(FlightDate, '')) = 10 AND coalesce(Distance, '') <> ''""",

    "flight_records": _FL + f"SELECT {_FLIGHT_COLS} FROM flights",

    "flight_rejects": _FL + "SELECT reason, count(*) AS n FROM parsed WHERE reason IS NOT NULL GROUP BY reason",

    "airport_sliding_mean": _AW + """
SELECT window_start, window_end, origin_airport_id, average_departure_delay FROM airport_means""",

    "event_sliding_mean": """
WITH w AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) - k.i * INTERVAL 1 HOUR AS window_start, event_type, value
  FROM events, (SELECT unnest(range(0, 4)) AS i) k
)
SELECT window_start, window_start + INTERVAL 4 HOUR AS window_end, event_type,
       (round(avg(value), 6) + 0.0) AS avg_value
FROM w GROUP BY window_start, event_type""",

    "read_instances": _FL + """
SELECT flight_number AS flight, origin_airport_id AS airport,
       strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS "timestamp" FROM flights""",

    "completed_flights": _TR + "SELECT event_id, DepDelay, TaxiOut, Distance, ArrDelay, FlightDate FROM completed",

    "training_set": _TR + "SELECT * FROM train",

    "test_set": _TR + "SELECT * FROM test",

    "first_n_rows": _RF + "SELECT * FROM raw_flights ORDER BY event_id LIMIT 5000",

    "impute_mean": _with(RAW_FLIGHTS, TRAIN, _SCALE_STATS) + """
SELECT event_id, (round(DepDelay, 6) + 0.0) AS DepDelay, (round(TaxiOut, 6) + 0.0) AS TaxiOut,
       (round(Distance, 6) + 0.0) AS Distance, target FROM imp""",

    "standardise": _with(RAW_FLIGHTS, TRAIN, _SCALE_STATS) + """
, st AS (
  SELECT avg(DepDelay) AS m1, stddev_pop(DepDelay) AS s1, avg(TaxiOut) AS m2, stddev_pop(TaxiOut) AS s2,
         avg(Distance) AS m3, stddev_pop(Distance) AS s3 FROM imp
)
SELECT event_id,
  (round((DepDelay - m1) / CASE WHEN s1 > 0 THEN s1 ELSE 1.0 END, 6) + 0.0) AS DepDelay,
  (round((TaxiOut - m2) / CASE WHEN s2 > 0 THEN s2 ELSE 1.0 END, 6) + 0.0) AS TaxiOut,
  (round((Distance - m3) / CASE WHEN s3 > 0 THEN s3 ELSE 1.0 END, 6) + 0.0) AS Distance,
  target
FROM imp, st""",

    "confusion_matrix": _TR + """
, pred AS (SELECT target AS actual, coalesce(DepDelay > 15, false) AS predicted FROM train),
grid AS (SELECT * FROM (VALUES (false, false), (false, true), (true, false), (true, true)) g(actual, predicted))
SELECT g.actual, g.predicted, count(p.actual) AS n
FROM grid g LEFT JOIN pred p ON p.actual = g.actual AND p.predicted = g.predicted
GROUP BY g.actual, g.predicted""",

    "roc_curve": _TR + """
, s AS (
  SELECT DepDelay AS score, sum(CASE WHEN target THEN 1 ELSE 0 END) AS p,
         sum(CASE WHEN target THEN 0 ELSE 1 END) AS n
  FROM train WHERE DepDelay IS NOT NULL AND NOT isnan(DepDelay) GROUP BY DepDelay
),
c AS (
  SELECT score, sum(p) OVER w AS tps, sum(n) OVER w AS fps FROM s
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
k AS (
  SELECT score, tps, fps, lag(tps) OVER o AS lt, lead(tps) OVER o AS nt,
         lag(fps) OVER o AS lf, lead(fps) OVER o AS nf
  FROM c WINDOW o AS (ORDER BY score DESC)
),
tot AS (SELECT sum(p) AS P, sum(n) AS N, max(score) AS mx FROM s)
SELECT mx + 1 AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM tot WHERE mx IS NOT NULL
UNION ALL
SELECT score AS threshold, CAST(fps AS DOUBLE) / N AS fpr, CAST(tps AS DOUBLE) / P AS tpr
FROM k, tot
WHERE lt IS NULL OR nt IS NULL OR nt - 2 * tps + lt <> 0 OR nf - 2 * fps + lf <> 0""",

    "feature_ingest_flight": _FL + """
, loads AS (
  SELECT 1 AS load_id, * FROM flights WHERE CAST("timestamp" AS DATE) < DATE '2024-01-20'
  UNION ALL
  SELECT 2 AS load_id, event_id, "timestamp", flight_number, origin_airport_id, is_cancelled,
         departure_delay_minutes + 1, arrival_delay_minutes, taxi_out_minutes, distance_miles
  FROM flights WHERE CAST("timestamp" AS DATE) >= DATE '2024-01-15'
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY flight_number, "timestamp"
    ORDER BY load_id DESC, origin_airport_id DESC, is_cancelled DESC, departure_delay_minutes DESC,
             arrival_delay_minutes DESC, taxi_out_minutes DESC, distance_miles DESC) AS rn
  FROM loads
)
SELECT flight_number, "timestamp", origin_airport_id, is_cancelled, departure_delay_minutes,
       arrival_delay_minutes, taxi_out_minutes, distance_miles
FROM ranked WHERE rn = 1""",

    "feature_ingest_airport": _FL + """
, l1 AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") - k.i * INTERVAL 1 HOUR AS ws, origin_airport_id,
         departure_delay_minutes AS d
  FROM flights, (SELECT unnest(range(0, 4)) AS i) k
  WHERE CAST("timestamp" AS DATE) < DATE '2024-01-20'
),
l2 AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") - k.i * INTERVAL 1 HOUR AS ws, origin_airport_id,
         departure_delay_minutes AS d
  FROM flights, (SELECT unnest(range(0, 4)) AS i) k
  WHERE CAST("timestamp" AS DATE) >= DATE '2024-01-15' AND NOT is_cancelled
),
loads AS (
  SELECT 1 AS load_id, ws, origin_airport_id, avg(d) AS v FROM l1 GROUP BY ws, origin_airport_id
  UNION ALL
  SELECT 2 AS load_id, ws, origin_airport_id, avg(d) AS v FROM l2 GROUP BY ws, origin_airport_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY origin_airport_id, ws ORDER BY load_id DESC, v DESC) AS rn
  FROM loads
)
SELECT origin_airport_id, ws AS "timestamp", (round(v, 6) + 0.0) AS average_departure_delay
FROM ranked WHERE rn = 1""",

    "latest_after_loads": _FL + """
, l1 AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") - k.i * INTERVAL 1 HOUR AS ws, origin_airport_id,
         departure_delay_minutes AS d
  FROM flights, (SELECT unnest(range(0, 4)) AS i) k
  WHERE CAST("timestamp" AS DATE) < DATE '2024-01-20'
),
l2 AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") - k.i * INTERVAL 1 HOUR AS ws, origin_airport_id,
         departure_delay_minutes AS d
  FROM flights, (SELECT unnest(range(0, 4)) AS i) k
  WHERE CAST("timestamp" AS DATE) >= DATE '2024-01-15' AND NOT is_cancelled
),
loads AS (
  SELECT 1 AS load_id, ws, origin_airport_id, avg(d) AS v FROM l1 GROUP BY ws, origin_airport_id
  UNION ALL
  SELECT 2 AS load_id, ws, origin_airport_id, avg(d) AS v FROM l2 GROUP BY ws, origin_airport_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY origin_airport_id, ws ORDER BY load_id DESC, v DESC) AS rn
  FROM loads
),
current AS (SELECT origin_airport_id, ws, v FROM ranked WHERE rn = 1)
SELECT origin_airport_id, max(ws) AS "timestamp",
       (round(arg_max(v, ws), 6) + 0.0) AS average_departure_delay
FROM current GROUP BY origin_airport_id""",

    "latest_features": _AW + """
SELECT origin_airport_id, max(window_start) AS window_start,
       arg_max(average_departure_delay, window_start) AS average_departure_delay
FROM airport_means GROUP BY origin_airport_id""",

    "asof_features": _AW + """
SELECT f.event_id, f.flight_number, f.origin_airport_id, f."timestamp",
       a.window_end AS feature_time, a.average_departure_delay
FROM flights f ASOF LEFT JOIN airport_means a
  ON f.origin_airport_id = a.origin_airport_id AND f."timestamp" >= a.window_end""",

    "asof_skewed": _AW + """
, f AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 3 = 0 THEN '10000' ELSE origin_airport_id END
          AS airport, "timestamp" FROM flights),
a AS (SELECT CASE WHEN hour(window_start) % 13 = 0 THEN NULL ELSE origin_airport_id END AS airport, window_end,
        average_departure_delay FROM airport_means)
SELECT f.event_id, f.airport, f."timestamp", a.window_end AS feature_time, a.average_departure_delay
FROM f ASOF LEFT JOIN a ON f.airport = a.airport AND f."timestamp" >= a.window_end""",

    "training_rows": _AW + _INGESTED.replace("SELECT flight_number", ", ft AS (SELECT flight_number", 1) + """),
asked AS (SELECT flight_number AS flight, origin_airport_id AS airport, date_trunc('second', "timestamp") + (event_id % 5 * 45) * INTERVAL 1 MINUTE AS "timestamp" FROM flights),
a AS (SELECT q.*, f."timestamp" AS flight_time, f.origin_airport_id, f.is_cancelled, f.departure_delay_minutes,
        f.arrival_delay_minutes, f.taxi_out_minutes, f.distance_miles
      FROM asked q ASOF LEFT JOIN ft f ON q.flight = f.flight_number AND q."timestamp" >= f."timestamp"),
b AS (SELECT a.*, flight_time + INTERVAL 2 HOUR >= a."timestamp" AS fresh, m.window_end AS airport_time, m.average_departure_delay,
        m.window_end + INTERVAL 30 MINUTE >= a."timestamp" AS near
      FROM a ASOF LEFT JOIN airport_means m ON a.airport = m.origin_airport_id AND a."timestamp" >= m.window_end)
SELECT flight, airport, "timestamp", """ + ", ".join(
        f"CASE WHEN fresh THEN {c} END AS {c}" for c in (
            "flight_time", "origin_airport_id", "is_cancelled", "departure_delay_minutes", "arrival_delay_minutes",
            "taxi_out_minutes", "distance_miles")) + """,
  CASE WHEN near THEN airport_time END AS airport_time, CASE WHEN near THEN average_departure_delay END AS average_departure_delay
FROM b""",

    "model_fit_predict": _MODEL + _SCORES,

    "model_saved_scores": _MODEL + _SCORES,

    "model_refreshed_scores": _MODEL + _SCORES,

    "model_roc": _MODEL + _roc("SELECT round(p, 4) + 0.0 AS score, target FROM scored") + "SELECT * FROM roc",

    "model_confusion": _MODEL + _CONFUSION,

    "training_job_confusion": _MODEL + _CONFUSION,

    "training_job_roc": _MODEL + _roc("SELECT p AS score, target FROM scored") + """
, pts AS (SELECT fpr, tpr, lag(fpr) OVER o AS f0, lag(tpr) OVER o AS t0 FROM roc WINDOW o AS (ORDER BY fpr, tpr))
SELECT max(fpr) AS fpr_end, max(tpr) AS tpr_end, round(sum((fpr - f0) * (tpr + t0) / 2), 4) AS area FROM pts""",

    "train_test_csv": _TR + """
SELECT 'train' AS part, DepDelay, TaxiOut, Distance, target FROM train
UNION ALL SELECT 'test' AS part, DepDelay, TaxiOut, Distance, target FROM test""",

    # an empty field of a CSV file reads as null, and a null date is in neither set
    "named_csv_training": _TR + "SELECT train.* FROM train JOIN raw_flights USING (event_id) WHERE FlightDate <> ''",

    "batch_job_flights": _FL + "SELECT " + _FLIGHT_COLS.replace("event_id, ", "") + " FROM flights",

    "batch_job_airports": _AW + """
SELECT window_start AS "timestamp", origin_airport_id, average_departure_delay FROM airport_means""",

    "batch_job_instances": _FL + """
SELECT flight_number AS flight, origin_airport_id AS airport,
       strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS "timestamp" FROM flights""",

    "feature_table_flight": _FL + _INGESTED,

    "feature_table_compacted": _FL + _INGESTED,

    "delivery_evaluation": _TR + f"""
, t AS (SELECT l.*, 2024 AS file_year, CASE WHEN l.FlightDate >= '2024-01-25' THEN 2 ELSE 1 END AS file_month
        FROM labelled l JOIN raw_flights r USING (event_id) WHERE r."Year" <> 'Year' AND l.FlightDate >= '2024-01-20')
SELECT m.file_year, m.file_month, g.actual, g.predicted, count(t.target) AS n
FROM (SELECT DISTINCT file_year, file_month FROM t) m CROSS JOIN {GRID}
LEFT JOIN t ON t.file_month = m.file_month AND t.target = g.actual AND coalesce(t.DepDelay > 15, false) = g.predicted
GROUP BY ALL""",

    "daily_confusion": _TR + """
, t AS (
  SELECT FlightDate AS flight_date, target AS actual, coalesce(DepDelay > 15, false) AS predicted
  FROM labelled WHERE FlightDate >= '2024-01-20'
),
days AS (SELECT DISTINCT flight_date FROM t),
grid AS (
  SELECT d.flight_date, g.actual, g.predicted
  FROM days d, (VALUES (false, false), (false, true), (true, false), (true, true)) g(actual, predicted)
)
SELECT g.flight_date, g.actual, g.predicted, count(t.actual) AS n
FROM grid g LEFT JOIN t ON t.flight_date = g.flight_date AND t.actual = g.actual AND t.predicted = g.predicted
GROUP BY g.flight_date, g.actual, g.predicted""",

    "csv_file_decode": _RF + "SELECT " + ", ".join(
        f"nullif(\"{c}\", '') AS \"{c}\"" for c in _RAW_COLS) + " FROM raw_flights",

    "read_instances_csv": _FL + """
SELECT flight_number AS flight, origin_airport_id AS airport,
       strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS "timestamp" FROM flights""",

    "stream_airport_mean": _AW + """
SELECT window_start, window_end, origin_airport_id, average_departure_delay FROM airport_means""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
