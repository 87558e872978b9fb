"""DuckDB SQL for every oracle-checked query (tables are pre-registered views).

The CTEs spell the same derivations as ``sources/adapter.py`` and the operators,
written independently in SQL: positional split by ``row_number``, cleaning as a
WHERE clause, statistics as plain aggregates.
"""

from __future__ import annotations

RAW = """raw_trips AS (
  SELECT event_id AS trip_id,
         CAST(1 + user_id % 2 AS BIGINT) AS VendorID,
         ts AS lpep_pickup_datetime,
         ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS lpep_dropoff_datetime,
         CAST(user_id % 25 AS BIGINT) AS PULocationID,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 27 AS BIGINT) AS DOLocationID,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(1 + event_id % 6 AS DOUBLE) END AS passenger_count,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOUBLE) AS trip_distance,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(1 + (event_id % 3) // 2 AS DOUBLE) END AS trip_type,
         CAST(event_id % 20 - 1 AS DOUBLE) AS fare_amount
  FROM events)"""

ZONES = """zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS LocationID, r_name AS Borough, n_name AS Zone,
         CAST(40.5 + 0.02 * n_nationkey AS DOUBLE) AS latitude,
         CAST(-74.2 + 0.015 * n_nationkey AS DOUBLE) AS longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

SPLIT = """ranked AS (
  SELECT *, row_number() OVER (ORDER BY lpep_pickup_datetime NULLS LAST, trip_id) - 1 AS rn,
         count(*) OVER () AS n_all
  FROM raw_trips),
split_trips AS (
  SELECT * EXCLUDE (rn, n_all),
         CASE WHEN rn < CAST(floor(CAST(n_all AS DOUBLE) * CAST(0.6 AS DOUBLE)) AS BIGINT) THEN 'train'
              WHEN rn < CAST(floor(CAST(n_all AS DOUBLE) * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'val'
              ELSE 'test' END AS split
  FROM ranked)"""

PREPARED = """with_duration AS (
  SELECT *, CAST(date_diff('microsecond', lpep_pickup_datetime, lpep_dropoff_datetime) AS DOUBLE)
              / CAST(1000000 AS DOUBLE) / CAST(60 AS DOUBLE) AS duration
  FROM split_trips),
prepared AS (
  SELECT trip_id, split, VendorID, date_trunc('second', lpep_pickup_datetime) AS lpep_pickup_datetime,
         PULocationID, DOLocationID, passenger_count, trip_type, duration
  FROM with_duration
  WHERE trip_distance > 0 AND trip_distance <= 100 AND NOT isnan(trip_distance)
    AND duration > 0 AND duration <= 300
    AND fare_amount >= 0 AND NOT isnan(fare_amount))"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"3958.8 * 2 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2.0), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2.0), 2)))"
    )


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


BASE = (RAW, SPLIT, PREPARED)

ENRICHED_CTE = f"""enriched AS (
  SELECT t.*, pu.Borough AS PU_Borough, pu.Zone AS PU_Zone, du.Borough AS DO_Borough, du.Zone AS DO_Zone,
         {haversine('pu.latitude', 'pu.longitude', 'du.latitude', 'du.longitude')} AS estimated_distance_miles,
         CAST(COALESCE(pu.Borough = du.Borough, false) AS INTEGER) AS same_borough
  FROM raw_trips t LEFT JOIN zones pu ON t.PULocationID = pu.LocationID
                   LEFT JOIN zones du ON t.DOLocationID = du.LocationID)"""

SCORED_TEST = f"""scored AS (
  SELECT p.*, 10.0 + 2.0 * COALESCE({haversine('pu.latitude', 'pu.longitude', 'du.latitude', 'du.longitude')}, 1.0)
              AS prediction
  FROM prepared p LEFT JOIN zones pu ON p.PULocationID = pu.LocationID
                  LEFT JOIN zones du ON p.DOLocationID = du.LocationID
  WHERE p.split = 'test')"""

ORACLE = {
    "prepared_trips": with_ctes(*BASE, body="""
SELECT trip_id, VendorID, strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS lpep_pickup_datetime,
       PULocationID, DOLocationID, passenger_count, trip_type, round(duration, 6) AS duration
FROM prepared"""),
    "chronological_split": with_ctes(RAW, SPLIT, body="SELECT trip_id, split FROM split_trips"),
    "split_report": with_ctes(RAW, SPLIT, body="""
, d AS (SELECT *, CAST(date_diff('microsecond', lpep_pickup_datetime, lpep_dropoff_datetime) AS DOUBLE)
                  / CAST(1000000 AS DOUBLE) / CAST(60 AS DOUBLE) AS duration FROM split_trips)
SELECT split, count(*) AS "rows",
       CAST(count(*) FILTER (WHERE trip_distance > 0 AND trip_distance <= 100 AND NOT isnan(trip_distance)
                              AND duration > 0 AND duration <= 300 AND fare_amount >= 0 AND NOT isnan(fare_amount))
            AS BIGINT) AS clean_rows,
       round(count(*) * 100.0 / (SELECT count(*) FROM raw_trips), 6) AS share_pct,
       strftime(min(lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') AS start,
       strftime(max(lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') AS "end"
FROM d GROUP BY split"""),
    "zone_enriched": with_ctes(RAW, ZONES, ENRICHED_CTE, body="""
SELECT trip_id, PU_Borough, PU_Zone, DO_Borough, DO_Zone, round(estimated_distance_miles, 6) AS estimated_distance_miles,
       same_borough
FROM enriched"""),
    "time_features": with_ctes(*BASE, body="""
SELECT trip_id, CAST(hour(lpep_pickup_datetime) AS INTEGER) AS pickup_hour,
       CAST(isodow(lpep_pickup_datetime) - 1 AS INTEGER) AS day_of_week,
       CAST(month(lpep_pickup_datetime) AS INTEGER) AS pickup_month,
       CAST(day(lpep_pickup_datetime) AS INTEGER) AS day_of_month,
       round(sin(2 * pi() * hour(lpep_pickup_datetime) / 24.0), 6) + 0.0 AS hour_sin,
       round(cos(2 * pi() * hour(lpep_pickup_datetime) / 24.0), 6) + 0.0 AS hour_cos,
       round(sin(2 * pi() * (isodow(lpep_pickup_datetime) - 1) / 7.0), 6) + 0.0 AS day_sin,
       round(cos(2 * pi() * (isodow(lpep_pickup_datetime) - 1) / 7.0), 6) + 0.0 AS day_cos,
       CAST(isodow(lpep_pickup_datetime) - 1 IN (5, 6) AS INTEGER) AS is_weekend,
       CAST(hour(lpep_pickup_datetime) IN (7, 8, 9, 16, 17, 18) AS INTEGER) AS is_rush_hour
FROM prepared"""),
    "segment_metrics": with_ctes(*BASE, ZONES, SCORED_TEST, body="""
, seg AS (
  SELECT CAST(hour(s.lpep_pickup_datetime) AS VARCHAR) AS pickup_hour,
         COALESCE(z.Borough, 'Unknown') AS PU_Borough,
         COALESCE(CAST(s.trip_type AS VARCHAR), '__missing__') AS trip_type,
         s.duration - s.prediction AS e
  FROM scored s LEFT JOIN zones z ON s.PULocationID = z.LocationID)
SELECT CASE WHEN GROUPING(pickup_hour) = 0 THEN 'pickup_hour' WHEN GROUPING(PU_Borough) = 0 THEN 'PU_Borough'
            ELSE 'trip_type' END AS segment_name,
       COALESCE(pickup_hour, PU_Borough, trip_type) AS segment,
       count(*) AS "rows", round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae
FROM seg GROUP BY GROUPING SETS ((pickup_hour), (PU_Borough), (trip_type))
HAVING count(*) >= 100"""),
}

# --------------------------------------------------------------------------- fitted features
FIT = f"""train AS (SELECT * FROM prepared WHERE split = 'train'),
tz AS (
  SELECT t.*, pu.Borough AS PU_Borough, du.Borough AS DO_Borough,
         {haversine('pu.latitude', 'pu.longitude', 'du.latitude', 'du.longitude')} AS dist
  FROM train t LEFT JOIN zones pu ON t.PULocationID = pu.LocationID
               LEFT JOIN zones du ON t.DOLocationID = du.LocationID),
fit_scalars AS (
  SELECT count(*) AS total, COALESCE(quantile_cont(dist, 0.5) FILTER (WHERE dist > 0), 1.0) AS median_distance FROM tz),
fit_mode AS (
  SELECT COALESCE((SELECT trip_type FROM train WHERE trip_type IS NOT NULL GROUP BY trip_type
                   ORDER BY count(*) DESC, trip_type LIMIT 1), 1.0) AS trip_type_mode),
pu_freq AS (SELECT PULocationID AS k, count(*) / (SELECT total FROM fit_scalars) AS f FROM train GROUP BY PULocationID),
do_freq AS (SELECT DOLocationID AS k, count(*) / (SELECT total FROM fit_scalars) AS f FROM train GROUP BY DOLocationID),
route_freq AS (SELECT PULocationID AS pk, DOLocationID AS dk, count(*) / (SELECT total FROM fit_scalars) AS f
               FROM train GROUP BY PULocationID, DOLocationID),
cats AS (
  SELECT DISTINCT 'VendorID' AS col, COALESCE(CAST(VendorID AS VARCHAR), '__missing__') AS cat FROM tz
  UNION SELECT 'trip_type', COALESCE(CAST(trip_type AS VARCHAR), '__missing__') FROM tz
  UNION SELECT 'PU_Borough', COALESCE(PU_Borough, '__missing__') FROM tz
  UNION SELECT 'DO_Borough', COALESCE(DO_Borough, '__missing__') FROM tz),
cats_ranked AS (SELECT col, cat, row_number() OVER (PARTITION BY col ORDER BY cat) AS pos FROM cats)"""

FEAT = f"""feat AS (
  SELECT p.trip_id,
         COALESCE(p.passenger_count, 1.0) AS passenger_count,
         COALESCE(p.trip_type, (SELECT trip_type_mode FROM fit_mode)) AS trip_type_f,
         p.VendorID,
         CAST(month(p.lpep_pickup_datetime) AS DOUBLE) AS pickup_month,
         CAST(day(p.lpep_pickup_datetime) AS DOUBLE) AS day_of_month,
         COALESCE({haversine('pu.latitude', 'pu.longitude', 'du.latitude', 'du.longitude')},
                  (SELECT median_distance FROM fit_scalars)) AS estimated_distance_miles,
         CAST(COALESCE(pu.Borough = du.Borough, false) AS DOUBLE) AS same_borough,
         sin(2 * pi() * hour(p.lpep_pickup_datetime) / 24.0) AS hour_sin,
         cos(2 * pi() * hour(p.lpep_pickup_datetime) / 24.0) AS hour_cos,
         sin(2 * pi() * (isodow(p.lpep_pickup_datetime) - 1) / 7.0) AS day_sin,
         cos(2 * pi() * (isodow(p.lpep_pickup_datetime) - 1) / 7.0) AS day_cos,
         CAST(isodow(p.lpep_pickup_datetime) - 1 IN (5, 6) AS DOUBLE) AS is_weekend,
         CAST(hour(p.lpep_pickup_datetime) IN (7, 8, 9, 16, 17, 18) AS DOUBLE) AS is_rush_hour,
         COALESCE(pf.f, 0.0) AS PU_zone_frequency,
         COALESCE(df.f, 0.0) AS DO_zone_frequency,
         COALESCE(rf.f, 0.0) AS route_frequency,
         pu.Borough AS PU_Borough, du.Borough AS DO_Borough
  FROM prepared p
  LEFT JOIN zones pu ON p.PULocationID = pu.LocationID
  LEFT JOIN zones du ON p.DOLocationID = du.LocationID
  LEFT JOIN pu_freq pf ON p.PULocationID IS NOT DISTINCT FROM pf.k
  LEFT JOIN do_freq df ON p.DOLocationID IS NOT DISTINCT FROM df.k
  LEFT JOIN route_freq rf ON p.PULocationID IS NOT DISTINCT FROM rf.pk AND p.DOLocationID IS NOT DISTINCT FROM rf.dk),
onehot AS (
  SELECT f.trip_id, c.col || '_' || c.cat AS feature,
         CAST((CASE c.col WHEN 'VendorID' THEN COALESCE(CAST(f.VendorID AS VARCHAR), '__missing__')
                          WHEN 'trip_type' THEN COALESCE(CAST(f.trip_type_f AS VARCHAR), '__missing__')
                          WHEN 'PU_Borough' THEN COALESCE(f.PU_Borough, '__missing__')
                          ELSE COALESCE(f.DO_Borough, '__missing__') END) = c.cat AS DOUBLE) AS value
  FROM feat f CROSS JOIN cats_ranked c WHERE c.pos > 1),
base_long AS (
  UNPIVOT (SELECT trip_id, passenger_count, pickup_month, day_of_month, estimated_distance_miles, same_borough,
                  hour_sin, hour_cos, day_sin, day_cos, is_weekend, is_rush_hour, PU_zone_frequency,
                  DO_zone_frequency, route_frequency FROM feat)
  ON passenger_count, pickup_month, day_of_month, estimated_distance_miles, same_borough, hour_sin, hour_cos,
     day_sin, day_cos, is_weekend, is_rush_hour, PU_zone_frequency, DO_zone_frequency, route_frequency
  INTO NAME feature VALUE value)"""

FEATURE_CTES = (*BASE, ZONES, FIT, FEAT)

ORACLE.update({
    "route_frequency": with_ctes(*BASE, ZONES, FIT, body="""
SELECT COALESCE(CAST(pk AS VARCHAR), '__missing__') || '_' || COALESCE(CAST(dk AS VARCHAR), '__missing__') AS PU_DO_route,
       round(f, 6) AS route_frequency
FROM route_freq"""),
    "zone_frequency_lookup": with_ctes(*FEATURE_CTES, body="""
SELECT trip_id, round(PU_zone_frequency, 6) AS PU_zone_frequency, round(DO_zone_frequency, 6) AS DO_zone_frequency,
       round(route_frequency, 6) AS route_frequency
FROM feat"""),
    "distance_median": with_ctes(*BASE, ZONES, FIT, body="""
SELECT round(median_distance, 6) AS median_distance, total AS train_rows FROM fit_scalars"""),
    "trip_type_mode": with_ctes(*BASE, ZONES, FIT, body="""
SELECT trip_id, COALESCE(trip_type, (SELECT trip_type_mode FROM fit_mode)) AS trip_type,
       COALESCE(passenger_count, 1.0) AS passenger_count
FROM prepared"""),
    "categories": with_ctes(*BASE, ZONES, FIT, body="""
SELECT col AS "column", CAST(pos AS INTEGER) AS position, cat AS category FROM cats_ranked"""),
    "one_hot": with_ctes(*FEATURE_CTES, body="""
SELECT trip_id, feature, round(value, 6) + 0.0 AS value FROM onehot"""),
    "feature_matrix": with_ctes(*FEATURE_CTES, body="""
SELECT trip_id, feature, round(value, 6) + 0.0 AS value FROM base_long
UNION ALL
SELECT trip_id, feature, round(value, 6) + 0.0 AS value FROM onehot"""),
})

# --------------------------------------------------------------------------- evaluation and monitoring
SCORED_ALL = f"""scored_all AS (
  SELECT p.*, 10.0 + 2.0 * COALESCE({haversine('pu.latitude', 'pu.longitude', 'du.latitude', 'du.longitude')}, 1.0)
              AS prediction
  FROM prepared p LEFT JOIN zones pu ON p.PULocationID = pu.LocationID
                  LEFT JOIN zones du ON p.DOLocationID = du.LocationID)"""

MON = """mon AS (
  SELECT split, trip_id,
         COALESCE(CAST(VendorID AS VARCHAR), '__MISSING__') AS VendorID,
         COALESCE(CAST(PULocationID AS VARCHAR), '__MISSING__') AS PULocationID,
         COALESCE(CAST(DOLocationID AS VARCHAR), '__MISSING__') AS DOLocationID,
         COALESCE(CAST(trip_type AS VARCHAR), '__MISSING__') AS trip_type,
         CAST(hour(lpep_pickup_datetime) AS VARCHAR) AS pickup_hour,
         CAST(isodow(lpep_pickup_datetime) - 1 AS VARCHAR) AS pickup_day_of_week,
         passenger_count, lpep_pickup_datetime, duration, prediction
  FROM scored_all)"""

MON_CTES = (*BASE, ZONES, SCORED_ALL, MON)
CAT_COLS = "VendorID, PULocationID, DOLocationID, trip_type, pickup_hour, pickup_day_of_week"


def cat_drift_cte(ref: str, cur: str, name: str = "cat_scores") -> str:
    return f"""cat_long_{name} AS (
  UNPIVOT (SELECT CASE WHEN split = '{ref}' THEN 0 ELSE 1 END AS side, {CAT_COLS} FROM mon WHERE split IN ('{ref}', '{cur}'))
  ON {CAT_COLS} INTO NAME "column" VALUE value),
cat_counts_{name} AS (
  SELECT "column", value, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_cur
  FROM cat_long_{name} GROUP BY "column", value),
cat_p_{name} AS (
  SELECT "column", n_ref / sum(n_ref) OVER (PARTITION BY "column") AS p,
         n_cur / sum(n_cur) OVER (PARTITION BY "column") AS q
  FROM cat_counts_{name}),
{name} AS (
  SELECT "column", sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                                     + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS drift_score
  FROM cat_p_{name} GROUP BY "column")"""


def num_drift_cte(ref: str, cur: str, cols: list[str], name: str = "num_scores") -> str:
    c = ", ".join(cols)
    return f"""num_long_{name} AS (
  UNPIVOT (SELECT CASE WHEN split = '{ref}' THEN 0 ELSE 1 END AS side, {c} FROM mon WHERE split IN ('{ref}', '{cur}'))
  ON {c} INTO NAME "column" VALUE value),
num_counts_{name} AS (
  SELECT "column", value, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_cur
  FROM num_long_{name} WHERE NOT isnan(value) GROUP BY "column", value),
num_cdf_{name} AS (
  SELECT "column", value,
         sum(n_ref) OVER w / sum(n_ref) OVER (PARTITION BY "column") AS fr,
         sum(n_cur) OVER w / sum(n_cur) OVER (PARTITION BY "column") AS fc,
         lead(value) OVER (PARTITION BY "column" ORDER BY value) AS nxt
  FROM num_counts_{name}
  WINDOW w AS (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
num_w1_{name} AS (SELECT "column", sum(COALESCE(abs(fr - fc) * (nxt - value), 0)) AS w1 FROM num_cdf_{name} GROUP BY "column"),
num_sd_{name} AS (SELECT "column", stddev_pop(value) FILTER (WHERE side = 0) AS sd FROM num_long_{name}
                  WHERE NOT isnan(value) GROUP BY "column"),
{name} AS (
  SELECT w."column", w.w1 / greatest(COALESCE(s.sd, 0), 0.001) AS drift_score
  FROM num_w1_{name} w JOIN num_sd_{name} s ON w."column" = s."column")"""


DRIFT_COLS = ["VendorID", "PULocationID", "DOLocationID", "trip_type", "pickup_hour", "pickup_day_of_week",
              "passenger_count"]

ORACLE.update({
    "split_metrics": with_ctes(*BASE, ZONES, SCORED_ALL, body="""
SELECT split, count(*) AS "rows", round(sqrt(avg((duration - prediction) * (duration - prediction))), 6) AS rmse,
       round(avg(abs(duration - prediction)), 6) AS mae
FROM scored_all GROUP BY split"""),
    "residual_histogram": with_ctes(*BASE, ZONES, SCORED_TEST, body="""
, res AS (SELECT duration - prediction AS r FROM scored),
b AS (SELECT min(r) AS lo, max(r) AS hi FROM res),
counts AS (
  SELECT CASE WHEN b.hi = b.lo THEN 1
              ELSE least(CAST(floor((r - b.lo) * 40.0 / (b.hi - b.lo)) AS BIGINT) + 1, 40) END AS bin,
         count(*) AS c
  FROM res, b GROUP BY 1),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 41))
SELECT bins.bin AS bin, round(b.lo + (bins.bin - 1) * ((b.hi - b.lo) / 40), 6) AS bin_start,
       round(b.lo + bins.bin * ((b.hi - b.lo) / 40), 6) AS bin_end, CAST(COALESCE(counts.c, 0) AS BIGINT) AS "count"
FROM bins CROSS JOIN b LEFT JOIN counts ON bins.bin = counts.bin"""),
    "axis_limits": with_ctes(*BASE, ZONES, SCORED_TEST, body="""
SELECT round(least(min(duration), min(prediction)), 6) AS axis_min,
       round(greatest(max(duration), max(prediction)), 6) AS axis_max
FROM scored"""),
    "monitoring_frame": with_ctes(*MON_CTES, body="""
SELECT trip_id, VendorID, PULocationID, DOLocationID, trip_type, pickup_hour, pickup_day_of_week, passenger_count,
       strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS lpep_pickup_datetime,
       round(duration, 6) AS duration, round(prediction, 6) AS prediction
FROM mon WHERE split = 'test'"""),
    "missing_share": with_ctes(*MON_CTES, body="""
, m AS (
  SELECT count(*) AS "rows",
         sum(CAST(passenger_count IS NULL AS BIGINT) + CAST(lpep_pickup_datetime IS NULL AS BIGINT)
             + CAST(VendorID IS NULL AS BIGINT) + CAST(trip_type IS NULL AS BIGINT)) AS missing_cells
  FROM mon WHERE split = 'test')
SELECT "rows", CAST(COALESCE(missing_cells, 0) AS BIGINT) AS missing_cells,
       round(COALESCE(missing_cells, 0) / ("rows" * 8.0), 6) AS missing_share
FROM m"""),
    "categorical_drift": with_ctes(*MON_CTES, cat_drift_cte("train", "test"), body="""
SELECT "column", round(drift_score, 6) AS drift_score, CAST(drift_score >= 0.1 AS DOUBLE) AS drift_detected
FROM cat_scores"""),
    "numeric_drift": with_ctes(*MON_CTES, num_drift_cte("train", "test", ["passenger_count", "duration", "prediction"]),
                               body="""
SELECT "column", round(drift_score, 6) AS drift_score, CAST(drift_score >= 0.1 AS DOUBLE) AS drift_detected
FROM num_scores"""),
    "input_report": with_ctes(
        *MON_CTES, cat_drift_cte("train", "test"), num_drift_cte("train", "test", ["passenger_count"]), body=f"""
, s AS (SELECT "column", CAST(drift_score >= 0.1 AS DOUBLE) AS det FROM cat_scores
        UNION ALL SELECT "column", CAST(drift_score >= 0.1 AS DOUBLE) FROM num_scores),
miss AS (
  SELECT sum(CAST(passenger_count IS NULL AS BIGINT) + CAST(lpep_pickup_datetime IS NULL AS BIGINT)) / (count(*) * 8.0)
         AS share
  FROM mon WHERE split = 'test')
SELECT round(sum(det), 6) AS input_drifted_columns_count, round(sum(det) / 7.0, 6) AS input_drifted_columns_share,
       round((SELECT share FROM miss), 6) AS input_missing_value_share,
       {", ".join(f"round(COALESCE(max(det) FILTER (WHERE \"column\" = '{c}'), 0), 6) AS input_{c}_drift_detected"
                  for c in DRIFT_COLS)},
       round(CAST(sum(det) / 7.0 >= 0.3 AS DOUBLE), 6) AS input_drift_warning
FROM s"""),
    "quality_report": with_ctes(*MON_CTES, num_drift_cte("val", "test", ["duration", "prediction"]), body="""
, e AS (
  SELECT split, sqrt(avg((duration - prediction) * (duration - prediction))) AS rmse,
         avg(abs(duration - prediction)) AS mae
  FROM mon WHERE split IN ('val', 'test') GROUP BY split),
cur AS (SELECT * FROM e WHERE split = 'test'),
ref AS (SELECT * FROM e WHERE split = 'val'),
d AS (SELECT max(drift_score) FILTER (WHERE "column" = 'duration') AS ds,
             max(drift_score) FILTER (WHERE "column" = 'prediction') AS ps FROM num_scores)
SELECT round(cur.rmse, 6) AS quality_rmse, round(cur.mae, 6) AS quality_mae,
       round(cur.rmse * cur.rmse, 6) AS quality_mse_from_rmse,
       CAST(CAST((abs(cur.rmse - ref.rmse) > 0.1 * abs(ref.rmse)) AS INTEGER)
            + CAST((abs(cur.mae - ref.mae) > 0.1 * abs(ref.mae)) AS INTEGER)
            + CAST(d.ds >= 0.1 AS INTEGER) + CAST(d.ps >= 0.1 AS INTEGER) AS DOUBLE) AS quality_failed_tests,
       round(d.ds, 6) AS quality_duration_drift_score, round(d.ps, 6) AS quality_prediction_drift_score
FROM cur, ref, d"""),
})

# --------------------------------------------------------------------------- lineage, registry, tuning, serving log
VERSIONS = """versions AS (
  SELECT event_type AS model, event_id AS version, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS rmse_test
  FROM events),
folded AS (
  SELECT *, min(rmse_test) OVER (PARTITION BY model ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              AS champion_metric_before
  FROM versions),
decided AS (
  SELECT *, CASE WHEN rmse_test IS NULL THEN 'challenger'
                 WHEN champion_metric_before IS NULL OR rmse_test <= champion_metric_before THEN 'champion'
                 ELSE 'challenger' END AS decision
  FROM folded)"""

# the row text of the content fingerprint: columns by name, null ~, fractions in millionths
PRINTS = """hashed AS (
  SELECT state, split, CAST('0x' || substr(md5(concat_ws('|',
    coalesce(CAST(DOLocationID AS VARCHAR), '~'), coalesce(CAST(PULocationID AS VARCHAR), '~'),
    coalesce(CAST(VendorID AS VARCHAR), '~'), coalesce(CAST(CAST(round(duration * 1e6) AS BIGINT) AS VARCHAR), '~'),
    coalesce(strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'), '~'),
    coalesce(CAST(CAST(round(passenger_count * 1e6) AS BIGINT) AS VARCHAR), '~'),
    coalesce(CAST(CAST(round(trip_type * 1e6) AS BIGINT) AS VARCHAR), '~'))), 1, 15) AS BIGINT) AS h
  FROM states),
prints AS (
  SELECT state, split, count(*) AS n_rows,
    sha256(count(*) || ':' || CAST(sum(h) AS VARCHAR) || ':' || CAST(bit_xor(h) AS VARCHAR)) AS fingerprint
  FROM hashed GROUP BY state, split)"""

REQUEST_LOG = """log AS (
  SELECT event_id AS request_id, [1, 10, 100][event_id % 3 + 1] AS batch_size,
         [1, 5, 10][(event_id // 3) % 3 + 1] AS concurrency,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         ts AS started_at,
         ts + to_microseconds(CAST(round(round(value / 1000.0, 6) * 1000000) AS BIGINT)) AS ended_at,
         value / 1000.0 AS latency_s
  FROM events)"""

ORACLE.update({
    "lineage_coverage": with_ctes(*BASE, body="""
SELECT split AS dataset, count(*) AS n_rows, strftime(min(lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S') AS start,
       strftime(max(lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S') AS "end"
FROM prepared GROUP BY split"""),
    "lineage_fingerprint": with_ctes(*BASE, body="""
, states AS (SELECT 'now' AS state, * FROM prepared), """ + PRINTS + """
SELECT split AS dataset, n_rows, fingerprint FROM prints"""),
    "lineage_gate": with_ctes(*BASE, body="""
, hit AS (SELECT min(trip_id) AS id FROM prepared WHERE split = 'train'),
states AS (
  SELECT 'untouched' AS state, * FROM prepared
  UNION ALL SELECT 'altered', * REPLACE (DOLocationID + CAST(trip_id = (SELECT id FROM hit) AS BIGINT) AS DOLocationID) FROM prepared
  UNION ALL SELECT 'lost', * FROM prepared WHERE trip_id <> (SELECT id FROM hit)
  UNION ALL SELECT 'added', * FROM prepared
  UNION ALL SELECT 'added', * FROM prepared WHERE trip_id = (SELECT id FROM hit)), """ + PRINTS + """
SELECT p.state, p.split AS dataset, p.n_rows, p.fingerprint = u.fingerprint AS matches
FROM prints p JOIN prints u ON u.state = 'untouched' AND u.split = p.split WHERE p.split IN ('train', 'val')"""),
    "champion_fold": with_ctes(VERSIONS, body="""
SELECT model, version, rmse_test, champion_metric_before, decision FROM decided"""),
    "model_aliases": with_ctes(VERSIONS, body="""
SELECT model, max(version) FILTER (WHERE decision = 'champion') AS champion_version,
       max(version) FILTER (WHERE decision = 'challenger') AS challenger_version, count(*) AS versions
FROM decided GROUP BY model"""),
    "best_trial": """
WITH t AS (
  SELECT user_id AS study, event_id AS trial, value AS rmse_val, event_id % 7 + 3 AS max_depth,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS min_child_weight
  FROM events WHERE value IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY study ORDER BY rmse_val, trial) AS rn,
             count(*) OVER (PARTITION BY study) AS n_trials FROM t)
SELECT study, n_trials, trial AS best_trial, round(rmse_val, 6) AS best_rmse_val, max_depth, min_child_weight
FROM r WHERE rn = 1""",
    "latency_profile": with_ctes(REQUEST_LOG, body="""
SELECT batch_size, concurrency, count(*) AS request_count,
       round(avg(CAST(status = 200 AS DOUBLE)), 6) AS success_rate,
       round(count(*) / (date_diff('microsecond', min(started_at), max(ended_at)) / 1e6), 6) AS requests_per_second,
       round(quantile_cont(latency_s, 0.5) * 1000.0, 6) AS latency_ms_p50,
       round(quantile_cont(latency_s, 0.95) * 1000.0, 6) AS latency_ms_p95,
       round(quantile_cont(latency_s, 0.99) * 1000.0, 6) AS latency_ms_p99
FROM log GROUP BY batch_size, concurrency"""),
    "tiled_batch": """
WITH r AS (
  SELECT event_id // 10 AS request_id, event_id AS trip_id,
         row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1 AS k,
         count(*) OVER (PARTITION BY event_id // 10) AS m
  FROM events)
SELECT r.request_id, CAST(g.range AS INTEGER) AS pos, r.trip_id FROM r JOIN range(0, 100) g ON g.range % r.m = r.k""",
})

# --------------------------------------------------------------------------- requests
REQUESTS = """req_trips AS (
  SELECT trip_id // 10 AS request_id, trip_id,
         '{' || concat_ws(',',
           '"VendorID":' || CASE WHEN trip_id % 101 = 0 THEN '1.5'
                                 WHEN trip_id % 103 = 0 THEN '"2d"'
                                 WHEN trip_id % 107 = 0 THEN '9007199254740993'
                                 WHEN trip_id % 13 = 0 THEN '"' || CAST(VendorID AS VARCHAR) || '"'
                                 ELSE CAST(VendorID AS VARCHAR) END,
           '"lpep_pickup_datetime":"' || CASE WHEN trip_id % 97 = 0 THEN strftime(lpep_pickup_datetime, '%d/%m/%Y')
                                              WHEN trip_id % 89 = 0 THEN strftime(lpep_pickup_datetime, '%Y-%-m-%-d %-H:%-M:%-S')
                                              ELSE strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') END || '"',
           '"PULocationID":' || CAST(PULocationID AS VARCHAR),
           '"DOLocationID":' || CAST(DOLocationID AS VARCHAR),
           '"passenger_count":' || CAST(passenger_count AS VARCHAR),
           '"trip_type":' || CAST(trip_type AS VARCHAR)) || '}' AS j
  FROM raw_trips),
bodies AS (
  SELECT request_id, '{"trips":[' || string_agg(j, ',' ORDER BY trip_id) || ']}' AS body FROM req_trips GROUP BY request_id),
parsed AS (
  SELECT request_id,
         from_json(body, '{"trips":[{"VendorID":"VARCHAR","lpep_pickup_datetime":"VARCHAR","PULocationID":"VARCHAR",
                                     "DOLocationID":"VARCHAR","passenger_count":"VARCHAR","trip_type":"VARCHAR"}]}').trips AS trips
  FROM bodies),
items AS (
  SELECT request_id, generate_subscripts(trips, 1) - 1 AS pos, unnest(trips) AS trip FROM parsed),
checked AS (
  SELECT request_id, pos, trip,
         CASE WHEN NOT COALESCE(TRY_CAST(trip.VendorID AS DOUBLE) = floor(TRY_CAST(trip.VendorID AS DOUBLE)), false)
                THEN 'VendorID'
              WHEN trip.lpep_pickup_datetime IS NULL
                OR NOT regexp_full_match(trip.lpep_pickup_datetime, '[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]) (2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):([0-5][0-9]|[0-9])')
                OR try_strptime(trip.lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') IS NULL THEN 'lpep_pickup_datetime'
              WHEN NOT COALESCE(TRY_CAST(trip.PULocationID AS DOUBLE) = floor(TRY_CAST(trip.PULocationID AS DOUBLE)), false)
                THEN 'PULocationID'
              WHEN NOT COALESCE(TRY_CAST(trip.DOLocationID AS DOUBLE) = floor(TRY_CAST(trip.DOLocationID AS DOUBLE)), false)
                THEN 'DOLocationID'
              WHEN trip.passenger_count IS NOT NULL AND TRY_CAST(trip.passenger_count AS DOUBLE) IS NULL THEN 'passenger_count'
              WHEN trip.trip_type IS NOT NULL AND TRY_CAST(trip.trip_type AS DOUBLE) IS NULL THEN 'trip_type'
         END AS problem
  FROM items),
validated AS (
  SELECT p.request_id, CAST(len(p.trips) AS INTEGER) AS n_trips,
         CAST(count(c.problem) AS INTEGER) AS n_invalid_trips,
         CAST(min(c.pos) FILTER (WHERE c.problem IS NOT NULL) AS INTEGER) AS first_invalid_pos,
         arg_min(c.problem, c.pos) FILTER (WHERE c.problem IS NOT NULL) AS first_invalid_field,
         count(c.problem) = 0 AS valid
  FROM parsed p LEFT JOIN checked c ON p.request_id = c.request_id
  GROUP BY p.request_id, p.trips),
req_scored AS (
  SELECT c.request_id, c.pos,
         10.0 + 2.0 * COALESCE(""" + haversine('pu.latitude', 'pu.longitude', 'du.latitude', 'du.longitude') + """, 1.0)
           AS prediction
  FROM checked c JOIN validated v ON c.request_id = v.request_id AND v.valid
  LEFT JOIN zones pu ON CAST(TRY_CAST(c.trip.PULocationID AS DOUBLE) AS BIGINT) = pu.LocationID
  LEFT JOIN zones du ON CAST(TRY_CAST(c.trip.DOLocationID AS DOUBLE) AS BIGINT) = du.LocationID)"""

ORACLE.update({
    "request_validation": with_ctes(RAW, ZONES, REQUESTS, body="""
SELECT request_id, n_trips, valid, n_invalid_trips, COALESCE(first_invalid_pos, -1) AS first_invalid_pos,
       first_invalid_field
FROM validated"""),
    "request_scoring": with_ctes(RAW, ZONES, REQUESTS, body="""
, per AS (SELECT request_id, count(*) AS n, string_agg(printf('%.6f', prediction), ',' ORDER BY pos) AS txt
          FROM req_scored GROUP BY request_id)
SELECT v.request_id, CASE WHEN v.valid THEN 200 ELSE 422 END AS status,
       CAST(CASE WHEN v.valid THEN COALESCE(per.n, 0) ELSE 0 END AS INTEGER) AS n_predictions,
       CASE WHEN v.valid THEN per.txt END AS predictions_text,
       'trip_duration_model' AS model_name, 1 AS model_version, 'champion' AS model_alias
FROM validated v LEFT JOIN per ON v.request_id = per.request_id"""),
    "stream_scoring": with_ctes(RAW, ZONES, REQUESTS, body="""
SELECT request_id, CAST(pos AS INTEGER) AS pos, round(prediction, 6) AS prediction FROM req_scored"""),
})

ORACLE.update({
    "monthly_union": with_ctes(RAW, body="""
, t AS (SELECT *, date_trunc('day', (SELECT min(lpep_pickup_datetime) FROM raw_trips)) AS d0, trip_id AS e FROM raw_trips),
p AS (SELECT *, CASE WHEN lpep_pickup_datetime < d0 + INTERVAL 10 DAY THEN 0 WHEN lpep_pickup_datetime < d0 + INTERVAL 20 DAY THEN 1 ELSE 2 END AS part FROM t)
SELECT trip_id, 'p' || CAST(part AS VARCHAR) AS period, VendorID, PULocationID, DOLocationID, passenger_count, trip_distance, trip_type,
       CASE WHEN part <> 1 THEN fare_amount END AS fare_amount, CAST(e % 3 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
       CASE WHEN e % 4 <> 0 THEN CAST(e % 9 AS DOUBLE) END AS tip_amount, CAST(e % 2 AS DOUBLE) AS tolls_amount,
       CAST(1 AS DOUBLE) AS improvement_surcharge, fare_amount + e % 3 AS total_amount, CAST(e % 5 + 1 AS DOUBLE) AS payment_type,
       CAST(2.75 AS DOUBLE) AS congestion_surcharge, CAST(0.75 AS DOUBLE) AS cbd_congestion_fee, CAST(NULL AS DOUBLE) AS ehail_fee,
       CASE WHEN e % 6 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag, CAST(e % 7 AS DOUBLE) AS RatecodeID,
       CASE WHEN part = 2 THEN 'h' || CAST(e % 8 AS VARCHAR) END AS hvfhs_license,
       strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS lpep_pickup_datetime
FROM p"""),
    "signature_cast": with_ctes(RAW, ZONES, REQUESTS, body="""
SELECT c.request_id, CAST(c.pos AS INTEGER) AS pos,
       CASE WHEN regexp_full_match(c.trip.VendorID, '[+-]?[0-9]+') THEN TRY_CAST(c.trip.VendorID AS BIGINT) ELSE CAST(trunc(TRY_CAST(c.trip.VendorID AS DOUBLE)) AS BIGINT) END AS VendorID,
       CASE WHEN regexp_full_match(c.trip.PULocationID, '[+-]?[0-9]+') THEN TRY_CAST(c.trip.PULocationID AS BIGINT) ELSE CAST(trunc(TRY_CAST(c.trip.PULocationID AS DOUBLE)) AS BIGINT) END AS PULocationID,
       CASE WHEN regexp_full_match(c.trip.DOLocationID, '[+-]?[0-9]+') THEN TRY_CAST(c.trip.DOLocationID AS BIGINT) ELSE CAST(trunc(TRY_CAST(c.trip.DOLocationID AS DOUBLE)) AS BIGINT) END AS DOLocationID,
       TRY_CAST(c.trip.passenger_count AS DOUBLE) AS passenger_count, TRY_CAST(c.trip.trip_type AS DOUBLE) AS trip_type
FROM checked c JOIN validated v ON c.request_id = v.request_id AND v.valid"""),
})

ORACLE.update({
    "data_summary": with_ctes(*MON_CTES, body=f"""
, cat AS (
  UNPIVOT (SELECT {CAT_COLS} FROM mon WHERE split = 'test')
  ON {CAT_COLS} INTO NAME "column" VALUE value),
cc AS (SELECT "column", value, count(*) AS n FROM cat GROUP BY "column", value),
cc_ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rn FROM cc)
SELECT "column", 'categorical' AS role, CAST(sum(n) AS BIGINT) AS "rows",
       CAST(sum(CASE WHEN value IS NULL THEN n ELSE 0 END) AS BIGINT) AS missing,
       CAST(count(value) AS BIGINT) AS "distinct", max(value) FILTER (WHERE rn = 1) AS top_value,
       CAST(NULL AS DOUBLE) AS "min", CAST(NULL AS DOUBLE) AS "max", CAST(NULL AS DOUBLE) AS mean,
       CAST(NULL AS DOUBLE) AS std
FROM cc_ranked GROUP BY "column"
UNION ALL
SELECT 'passenger_count', 'numerical', count(*), count(*) FILTER (WHERE passenger_count IS NULL),
       count(DISTINCT passenger_count), NULL, round(min(passenger_count), 6), round(max(passenger_count), 6),
       round(avg(passenger_count), 6), round(stddev_samp(passenger_count), 6)
FROM mon WHERE split = 'test'
UNION ALL
SELECT 'lpep_pickup_datetime', 'datetime', count(*), count(*) FILTER (WHERE lpep_pickup_datetime IS NULL),
       count(DISTINCT lpep_pickup_datetime), NULL, round(min(epoch(lpep_pickup_datetime)), 6), round(max(epoch(lpep_pickup_datetime)), 6),
       round(avg(epoch(lpep_pickup_datetime)), 6), round(stddev_samp(epoch(lpep_pickup_datetime)), 6)
FROM mon WHERE split = 'test'
UNION ALL
SELECT 'duration', 'target', count(*), count(*) FILTER (WHERE duration IS NULL), count(DISTINCT duration), NULL,
       round(min(duration), 6), round(max(duration), 6), round(avg(duration), 6), round(stddev_samp(duration), 6)
FROM mon WHERE split = 'test'
UNION ALL
SELECT 'prediction', 'prediction', count(*), count(*) FILTER (WHERE prediction IS NULL), count(DISTINCT prediction), NULL,
       round(min(prediction), 6), round(max(prediction), 6), round(avg(prediction), 6), round(stddev_samp(prediction), 6)
FROM mon WHERE split = 'test'"""),
})

# --------------------------------------------------------------------------- landed tables, sample, history
def _history() -> str:
    """The metrics of the input and the quality report, one row each, beside the run's counts."""
    def stacked(query: str, name: str) -> str:
        return f"{name} AS (UNPIVOT ({ORACLE[query]}) ON COLUMNS(*) INTO NAME metric VALUE value)"

    return f"""
WITH {stacked('input_report', 'i')}, {stacked('quality_report', 'q')},
n AS (SELECT count(*) FILTER (split = 'train') AS r, count(*) FILTER (split = 'test') AS c FROM ({with_ctes(*BASE, body="SELECT split FROM prepared")}))
SELECT 'test' AS current_name, r AS rows_reference, c AS rows_current, true AS has_labels, 'run-1' AS model_run_id,
       'r1' AS code_revision, metric, value
FROM (SELECT * FROM i UNION ALL SELECT * FROM q), n"""


ORACLE.update({
    "split_keyless": with_ctes(RAW, SPLIT, body="""
SELECT split, count(*) AS "rows", strftime(min(lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') AS start,
       strftime(max(lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') AS "end"
FROM split_trips GROUP BY split"""),
    "raw_sorted": with_ctes(RAW, body="""
SELECT count(*) AS "rows", strftime(min(lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') AS first,
       strftime(max(lpep_pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') AS last, CAST(0 AS BIGINT) AS out_of_order,
       CAST(0 AS BIGINT) AS overlapping_files
FROM raw_trips"""),
    "split_roundtrip": with_ctes(*BASE, body="""
SELECT trip_id, split, strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS lpep_pickup_datetime, round(duration, 6) AS duration
FROM prepared"""),
    "zone_csv": with_ctes(ZONES, body="""
SELECT LocationID, Borough, Zone, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM zones"""),
    "monitoring_unlabelled": with_ctes(RAW, body="""
SELECT trip_id, COALESCE(CAST(VendorID AS VARCHAR), '__MISSING__') AS VendorID,
       COALESCE(CAST(PULocationID AS VARCHAR), '__MISSING__') AS PULocationID,
       COALESCE(CAST(DOLocationID AS VARCHAR), '__MISSING__') AS DOLocationID,
       COALESCE(CAST(trip_type AS VARCHAR), '__MISSING__') AS trip_type, CAST(hour(lpep_pickup_datetime) AS VARCHAR) AS pickup_hour,
       CAST(isodow(lpep_pickup_datetime) - 1 AS VARCHAR) AS pickup_day_of_week, passenger_count,
       strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS lpep_pickup_datetime, false AS labelled
FROM raw_trips"""),
    "input_example": with_ctes(*BASE, body="""
SELECT trip_id, VendorID, strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS lpep_pickup_datetime, PULocationID, DOLocationID,
       passenger_count, trip_type
FROM prepared WHERE split = 'train' ORDER BY prepared.lpep_pickup_datetime, trip_id LIMIT 3"""),
    "exact_sample": with_ctes(*MON_CTES, body="""
SELECT trip_id, VendorID, trip_type FROM mon WHERE split = 'test'
ORDER BY CAST('0x' || substr(md5(concat_ws('|', '42', CAST(trip_id AS VARCHAR))), 1, 15) AS BIGINT), trip_id LIMIT 500"""),
    "monitoring_history": _history(),
    "gbt_scoring": with_ctes(*BASE, body="""
SELECT trip_id, split, round(duration, 6) AS duration, true AS finite, true AS sound FROM prepared"""),
    "feature_importance": """
SELECT CAST(range AS INTEGER) AS rank, true AS fitted, true AS falling, true AS within_one FROM range(1, 21)""",
})
