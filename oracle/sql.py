"""DuckDB oracle SQL for every registered query, written from the semantics of
each operator (not from the Spark plan). Tables ``lineitem`` etc. are views.

The trips are derived from ``lineitem`` exactly as FIXTURES.md section 2
states; the CTE blocks below build raw -> classified -> staged -> load ->
model tables, and each query appends its own final SELECT.
"""

from __future__ import annotations

RUN_DAY = "TIMESTAMP '2024-01-15 00:00:00'"


def _cents(e: str) -> str:
    return f"(({e}) // 100)::VARCHAR || '.' || lpad((({e}) % 100)::VARCHAR, 2, '0')"


def _shift(sec: str) -> str:
    return f"strftime(l_shipdate + to_seconds({sec}), '%Y-%m-%d %H:%M:%S')"


def _lon(cell: str) -> str:
    return (f"CASE WHEN k % 53 = 0 THEN '0' WHEN k % 211 = 0 THEN '-86.0' "
            f"WHEN k % 307 = 0 THEN '-73.9.1' "
            f"ELSE '-73.' || (700000 + ({cell}) * 7000 + k % 9)::VARCHAR END")


def _lat(cell: str) -> str:
    return (f"CASE WHEN k % 53 = 0 THEN '0' WHEN k % 211 = 0 THEN '50.0' "
            f"ELSE '40.' || (550000 + ({cell}) * 7000 + k % 11)::VARCHAR END")


RAW_CLEAN = f"""
li AS (
  SELECT l_shipdate,
         (l_orderkey * 7 + l_linenumber + l_partkey * 13 + l_suppkey * 31)::BIGINT AS k
  FROM lineitem
),
trips_clean AS (
  SELECT k,
    CASE WHEN k % 97 = 0 THEN '3' ELSE (1 + k % 2)::VARCHAR END AS VendorID,
    CASE WHEN k % 103 = 0 THEN '2015/04/01 00:00:00' ELSE {_shift('k % 86400')} END
      AS tpep_pickup_datetime,
    {_shift('k % 86400 + CASE WHEN k % 101 = 0 THEN -60 ELSE (k * 37) % 5400 END')}
      AS tpep_dropoff_datetime,
    (k % 7)::VARCHAR AS passenger_count,
    CASE WHEN k % 89 = 0 THEN '0.5.1' WHEN k % 61 = 0 THEN '0'
         ELSE {_cents('10 + (k * 13) % 2000')} END AS trip_distance,
    {_lon('k % 40')} AS pickup_longitude,
    {_lat('(k // 40) % 40')} AS pickup_latitude,
    (1 + k % 7)::VARCHAR AS RateCodeID,
    CASE WHEN k % 5 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    {_lon('(k // 3) % 40')} AS dropoff_longitude,
    {_lat('(k // 7) % 40')} AS dropoff_latitude,
    (1 + k % 6)::VARCHAR AS payment_type,
    CASE WHEN k % 59 = 0 THEN '0' ELSE {_cents('250 + (k * 31) % 9000')} END AS fare_amount,
    CASE WHEN k % 2 = 0 THEN '0.5' ELSE '0' END AS extra,
    '0.5' AS mta_tax,
    {_cents('(k * 17) % 1200')} AS tip_amount,
    CASE WHEN k % 19 = 0 THEN '5.54' ELSE '0' END AS tolls_amount,
    '0.3' AS improvement_surcharge,
    {_cents('330 + (k * 31) % 9000 + (k * 17) % 1200')} AS total_amount,
    'yellow_tripdata_' || strftime(l_shipdate, '%Y-%m') || '_'
      || lpad((k % 23)::VARCHAR, 2, '0') || '.csv.zip' AS source_file
  FROM li
)"""

RAW_COLS = ("VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, "
            "trip_distance, pickup_longitude, pickup_latitude, RateCodeID, store_and_fwd_flag, "
            "dropoff_longitude, dropoff_latitude, payment_type, fare_amount, extra, mta_tax, "
            "tip_amount, tolls_amount, improvement_surcharge, total_amount")

NUM = ["passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
       "tolls_amount", "improvement_surcharge", "total_amount"]
COORD = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]

# Dirty lines (FIXTURES.md section 2): modulus of k, text (None: null), columns.
_DIRTY = [(401, None, "header"), (457, None, COORD + ["tpep_pickup_datetime", "tpep_dropoff_datetime"]),
          (409, "nan", ["pickup_longitude"]), (419, "-inf", ["dropoff_latitude"]),
          (421, "200.5", ["pickup_longitude"]), (433, "0", ["dropoff_longitude", "dropoff_latitude"]),
          (431, "1.5", ["passenger_count"]), (443, None, ["passenger_count", "tip_amount"]),
          (439, "15300000.0", ["trip_distance"]), (449, None, ["trip_distance"]), (461, "1e7", ["extra"]),
          (463, "0.00005", ["extra"]), (479, "10000000.5", ["extra"])]


def _dirty(c: str) -> str:
    whens = ""
    for mod, text, cols in _DIRTY:
        if cols == "header":
            whens += f" WHEN k % {mod} = 0 THEN '{c}'"
        elif c in cols:
            whens += f" WHEN k % {mod} = 0 THEN " + ("NULL" if text is None else f"'{text}'")
    return f"CASE{whens} ELSE {c} END AS {c}"


RAW = RAW_CLEAN + """,
trips_raw AS (SELECT """ + ", ".join(_dirty(c.strip()) for c in RAW_COLS.split(",")) + """, source_file
  FROM trips_clean)"""

# A Python number literal is what casts to a number, has only digits, sign, dot
# and exponent, and is not an integer with a leading zero.
def _is_int(c: str) -> str:
    return f"(ltrim(trim({c}), '+-') <> '' AND translate(ltrim(trim({c}), '+-'), '0123456789', '') = '')"


def _is_number(c: str) -> str:
    t = f"ltrim(trim({c}), '+-')"
    return (f"(TRY_CAST(trim({c}) AS DOUBLE) IS NOT NULL AND translate(lower(trim({c})), '0123456789+-.e', '') = '' "
            f"AND NOT ({_is_int(c)} AND starts_with({t}, '0') AND ltrim({t}, '0') <> ''))")


def _try_num(c: str) -> str:
    return f"CASE WHEN {_is_number(c)} AND isfinite(TRY_CAST(trim({c}) AS DOUBLE)) THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def _num(c: str) -> str:
    return f"coalesce({_try_num(c)}, 0.0)"


def _num_text(c: str) -> str:
    """What Python prints; DuckDB prints doubles of this data the same way,
    but for the exponent form below 1e-4."""
    d = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return (f"CASE WHEN NOT coalesce({_is_number(c)}, false) THEN '0' "
            f"WHEN {_is_int(c)} THEN CASE WHEN translate(trim({c}), '+-0', '') = '' THEN '0' ELSE ltrim(trim({c}), '+') END "
            f"ELSE ({d})::VARCHAR END")


def _coord_text(c: str) -> str:
    return (f"regexp_replace(regexp_replace(CAST(TRY_CAST({c} AS DECIMAL(10,7)) AS VARCHAR), "
            f"'0+$', ''), '\\.$', '.0')")


def _ts(c: str) -> str:
    return f"try_strptime({c}, '%Y-%m-%d %H:%M:%S')"


def _code(c: str, table: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {c} {whens} ELSE ':' END"


_VENDOR = {"1": "Creative Mobile Technologies, LLC.", "2": "VeriFone Inc."}
_RATE = {"1": "standard_rate", "2": "jfk", "3": "newark", "4": "nassau_or_westchester",
         "5": "negotiated_fare", "6": "group_fare"}
_PAY = {"1": "credit_card", "2": "cash", "3": "no_charge", "4": "dispute", "5": "unknown",
        "6": "voided trip"}

CLASSIFIED = f"""
parsed AS (
  SELECT *,
    {', '.join(f"coalesce(round(TRY_CAST({c} AS DOUBLE), 7), 0.0) AS p_{c}" for c in COORD)},
    {_ts('tpep_pickup_datetime')} AS p_pickup_ts,
    {_ts('tpep_dropoff_datetime')} AS p_dropoff_ts,
    {', '.join(f"{_num(c)} AS p_{c}" for c in NUM)}
  FROM trips_raw
),
classified AS (
  SELECT *,
    CASE
      WHEN VendorID = 'VendorID' AND tpep_pickup_datetime = 'tpep_pickup_datetime' THEN 'header'
      WHEN isnan(p_pickup_longitude) OR isnan(p_pickup_latitude) OR isnan(p_dropoff_longitude)
        OR isnan(p_dropoff_latitude) OR isinf(p_pickup_longitude) OR isinf(p_pickup_latitude)
        OR isinf(p_dropoff_longitude) OR isinf(p_dropoff_latitude) THEN 'coord_not_finite'
      WHEN p_pickup_longitude = 0 AND p_pickup_latitude = 0 THEN 'zero_pickup'
      WHEN p_dropoff_longitude = 0 AND p_dropoff_latitude = 0 THEN 'zero_dropoff'
      WHEN NOT (p_pickup_longitude BETWEEN -180 AND 180 AND p_pickup_latitude BETWEEN -90 AND 90
        AND p_dropoff_longitude BETWEEN -180 AND 180 AND p_dropoff_latitude BETWEEN -90 AND 90)
        THEN 'coord_out_of_range'
      WHEN p_pickup_ts IS NULL OR p_dropoff_ts IS NULL THEN 'bad_datetime'
      WHEN p_pickup_ts > p_dropoff_ts THEN 'pickup_after_dropoff'
      WHEN p_passenger_count <> floor(p_passenger_count) OR abs(p_passenger_count) > 2147483647
        THEN 'bad_passenger_count'
    END AS reject_reason
  FROM parsed
)"""

STAGED = f"""
staged AS (
  SELECT
    {_code('VendorID', _VENDOR)} AS VendorID,
    strftime(p_pickup_ts, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
    strftime(p_dropoff_ts, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime,
    CAST(p_passenger_count AS INTEGER) AS passenger_count,
    p_trip_distance AS trip_distance,
    p_pickup_longitude AS pickup_longitude,
    p_pickup_latitude AS pickup_latitude,
    {_code('RateCodeID', _RATE)} AS RateCodeID,
    CAST(CASE store_and_fwd_flag WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS SMALLINT)
      AS store_and_fwd_flag,
    p_dropoff_longitude AS dropoff_longitude,
    p_dropoff_latitude AS dropoff_latitude,
    {_code('payment_type', _PAY)} AS payment_type,
    p_fare_amount AS fare_amount, p_extra AS extra, p_mta_tax AS mta_tax,
    p_tip_amount AS tip_amount, p_tolls_amount AS tolls_amount,
    p_improvement_surcharge AS improvement_surcharge, p_total_amount AS total_amount,
    'POINT(' || {_coord_text('p_pickup_longitude')} || ' ' || {_coord_text('p_pickup_latitude')} || ')'
      AS pickup_geom,
    'POINT(' || {_coord_text('p_dropoff_longitude')} || ' ' || {_coord_text('p_dropoff_latitude')} || ')'
      AS dropoff_geom,
    substr(replace(((p_pickup_latitude + p_dropoff_latitude) / 2)::VARCHAR, '.', ''), 1, 6)
      || '_' || substr(replace(((p_pickup_longitude + p_dropoff_longitude) / 2)::VARCHAR, '.', ''), 1, 6)
      || '_' || substr(replace({_num_text('trip_distance')} || {_num_text('extra')}
                               || {_num_text('tip_amount')}, '.', ''), 1, 6) AS id
  FROM classified WHERE reject_reason IS NULL
)"""

LOAD = """
load AS (
  SELECT id, VendorID, RateCodeID, CAST(store_and_fwd_flag AS BOOLEAN) AS store_and_fwd_flag,
    payment_type, tpep_pickup_datetime, tpep_dropoff_datetime,
    CAST(passenger_count AS DOUBLE) AS passenger_count, trip_distance, fare_amount, extra,
    mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
    pickup_longitude, pickup_latitude, pickup_geom, dropoff_longitude, dropoff_latitude,
    dropoff_geom
  FROM staged
)"""


def geohash_sql(lon: str, lat: str, precision: int = 7) -> str:
    """Geohash written bit by bit: bit j of the code (from the top) is bit j//2
    of the longitude cell index for even j and of the latitude index for odd j."""
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    x = f"least(floor(({lon} + 180.0) / 360.0 * {float(1 << lon_bits)}), {(1 << lon_bits) - 1})::BIGINT"
    y = f"least(floor(({lat} + 90.0) / 180.0 * {float(1 << lat_bits)}), {(1 << lat_bits) - 1})::BIGINT"
    chars = []
    for ch in range(precision):
        terms = []
        for b in range(5):
            j = ch * 5 + b
            if j % 2 == 0:
                src, width, pos = x, lon_bits, j // 2
            else:
                src, width, pos = y, lat_bits, j // 2
            terms.append(f"((({src}) >> {width - 1 - pos}) & 1) * {1 << (4 - b)}")
        chars.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', 1 + {' + '.join(terms)}, 1)")
    inside = f"{lon} BETWEEN -180 AND 180 AND {lat} BETWEEN -90 AND 90"
    return f"CASE WHEN {inside} THEN {' || '.join(chars)} END"


def _points(time_col: str, point: str) -> str:
    return f"""SELECT id AS custom_id,
    {geohash_sql(point + '_longitude', point + '_latitude')} AS geohash,
    {point}_geom AS geom,
    strptime({time_col}, '%Y-%m-%d %H:%M:%S') AS timestmp,
    {RUN_DAY} AS created_at,
    CAST(strptime({time_col}, '%Y-%m-%d %H:%M:%S') AS DATE) AS day
  FROM load"""


MODEL = f"""
trips_pickup AS ({_points('tpep_pickup_datetime', 'pickup')}),
trips_dropoff AS ({_points('tpep_dropoff_datetime', 'dropoff')}),
trips_dropdown_compat AS ({_points('tpep_dropoff_datetime', 'pickup')}),
trips_data AS (
  SELECT id AS custom_id, VendorID, RateCodeID, store_and_fwd_flag, payment_type,
    CAST(round(passenger_count) AS BIGINT) AS passenger_count,
    round(trip_distance, 2) AS trip_distance,
    round(fare_amount, 2) AS fare, round(extra, 2) AS extra, round(mta_tax, 2) AS mta,
    round(tip_amount, 2) AS tip, round(tolls_amount, 2) AS tolls,
    round(improvement_surcharge, 2) AS improvement_surcharge,
    total_amount AS amount_total,
    date_sub('minute', strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'),
                       strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S')) AS trip_minutes,
    strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_timestmp,
    strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_timestmp,
    {RUN_DAY} AS created_at,
    CAST(strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS DATE) AS day
  FROM load
)"""


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip() for b in blocks) + "\n"


UP_TO_RAW = with_ctes(RAW)
UP_TO_CLASSIFIED = with_ctes(RAW, CLASSIFIED)
UP_TO_STAGED = with_ctes(RAW, CLASSIFIED, STAGED)
UP_TO_LOAD = with_ctes(RAW, CLASSIFIED, STAGED, LOAD)
UP_TO_MODEL = with_ctes(RAW, CLASSIFIED, STAGED, LOAD, MODEL)


def _pc(c: str) -> str:
    return f"coalesce(round(TRY_CAST({c} AS DOUBLE), 7), 0.0)"


_ZERO_OK = (f"({_pc('pickup_longitude')} <> 0 OR {_pc('pickup_latitude')} <> 0) AND "
            f"({_pc('dropoff_longitude')} <> 0 OR {_pc('dropoff_latitude')} <> 0)")


def _wkt(lon: str, lat: str) -> str:
    return f"'POINT(' || {_coord_text(_pc(lon))} || ' ' || {_coord_text(_pc(lat))} || ')'"


# Tips are whole cents: the average is rounded once, from integers; that of a
# zone with a tip beyond them is one of doubles.
_SMALL = "abs(round(d.tip * 100)) <= 1000000000000"
_TIP = f"CASE WHEN {_SMALL} THEN round(d.tip * 100)::HUGEINT END"
_LARGE = f"CASE WHEN NOT ({_SMALL}) THEN d.tip END"
_AVG_TIP = (f"CASE WHEN count({_LARGE}) > 0 THEN round((coalesce(sum({_TIP}), 0)::DOUBLE / 100 + sum({_LARGE})) "
            f"/ count(d.tip), 3) WHEN count({_TIP}) > 0 THEN CAST(sign(sum({_TIP})) * ((20 * abs(sum({_TIP})) + "
            f"count({_TIP})) // (2 * count({_TIP}))) AS DOUBLE) / 1000 END")
# The first column that fails to parse ends the test; otherwise the first
# column with |value| >= 0.01 keeps the row (nan is not >= anything).
_C5 = "CASE " + " ".join(
    f"WHEN TRY_CAST({c} AS DOUBLE) IS NULL THEN false "
    f"WHEN NOT isnan(TRY_CAST({c} AS DOUBLE)) AND abs(TRY_CAST({c} AS DOUBLE)) >= 0.01 THEN true" for c in COORD
) + " ELSE false END"

ORACLE: dict[str, str] = {
    "parse_coords": UP_TO_RAW + "SELECT " + ", ".join(f"{_pc(c)} AS {c}" for c in COORD)
    + " FROM trips_raw",
    "wkt_points": UP_TO_RAW + f"""SELECT {_wkt('pickup_longitude', 'pickup_latitude')} AS pickup_geom,
        {_wkt('dropoff_longitude', 'dropoff_latitude')} AS dropoff_geom
      FROM trips_raw WHERE {_ZERO_OK}""",
    "trip_centroid": UP_TO_RAW + f"""SELECT
        ({_pc('pickup_latitude')} + {_pc('dropoff_latitude')}) / 2 AS centroid_latitude,
        ({_pc('pickup_longitude')} + {_pc('dropoff_longitude')}) / 2 AS centroid_longitude
      FROM trips_raw WHERE {_ZERO_OK}""",
    "parse_datetimes": UP_TO_RAW + f"""SELECT {_ts('tpep_pickup_datetime')} AS tpep_pickup_datetime,
        {_ts('tpep_dropoff_datetime')} AS tpep_dropoff_datetime FROM trips_raw""",
    "decode_codes": UP_TO_RAW + f"""SELECT {_code('VendorID', _VENDOR)} AS VendorID,
        {_code('RateCodeID', _RATE)} AS RateCodeID, {_code('payment_type', _PAY)} AS payment_type,
        CAST(CASE store_and_fwd_flag WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS SMALLINT)
          AS store_and_fwd_flag FROM trips_raw""",
    "parse_numbers": UP_TO_RAW + "SELECT " + ", ".join(f"{_num(c)} AS {c}" for c in NUM)
    + " FROM trips_raw",
    "trip_id": UP_TO_STAGED + "SELECT id FROM staged",
    "flag_to_bool": UP_TO_RAW + """SELECT store_and_fwd_flag,
        CASE store_and_fwd_flag WHEN 'Y' THEN true WHEN 'N' THEN false END AS flag FROM trips_raw""",
    "valid_points": UP_TO_RAW + f"""SELECT {RAW_COLS} FROM trips_raw
      WHERE {_pc('pickup_longitude')} BETWEEN -180 AND 180 AND {_pc('pickup_latitude')} BETWEEN -90 AND 90
        AND {_pc('dropoff_longitude')} BETWEEN -180 AND 180 AND {_pc('dropoff_latitude')} BETWEEN -90 AND 90""",
    "geohash7": UP_TO_STAGED + f"""SELECT id AS custom_id,
        {geohash_sql('pickup_longitude', 'pickup_latitude')} AS geohash FROM staged""",
    "trip_minutes": UP_TO_MODEL + "SELECT custom_id, trip_minutes FROM trips_data",
    "conform_schema": UP_TO_LOAD + "SELECT * FROM load",
    "known_columns": UP_TO_STAGED + "SELECT id, VendorID, total_amount FROM staged",
    "drop_zero_points": UP_TO_RAW + f"SELECT {RAW_COLS} FROM trips_raw WHERE {_ZERO_OK}",
    "order_check": UP_TO_RAW + f"""SELECT {RAW_COLS} FROM trips_raw WHERE {_ZERO_OK}
        AND {_ts('tpep_pickup_datetime')} <= {_ts('tpep_dropoff_datetime')}""",
    "any_not_null": UP_TO_RAW + f"""SELECT {RAW_COLS} FROM trips_raw
      WHERE pickup_longitude IS NOT NULL OR pickup_latitude IS NOT NULL
         OR dropoff_longitude IS NOT NULL OR dropoff_latitude IS NOT NULL
         OR tpep_pickup_datetime IS NOT NULL OR tpep_dropoff_datetime IS NOT NULL""",
    "any_coord_nonzero": UP_TO_RAW + f"SELECT {RAW_COLS} FROM trips_raw WHERE {_C5}",
    "quarantine": UP_TO_CLASSIFIED + f"""SELECT {RAW_COLS}, reject_reason FROM classified
      WHERE reject_reason IS NOT NULL""",
    "stage_trips": UP_TO_STAGED + "SELECT * FROM staged",
    "model_pickup": UP_TO_MODEL + "SELECT * FROM trips_pickup",
    "model_dropoff": UP_TO_MODEL + "SELECT * FROM trips_dropoff",
    "model_dropdown_compat": UP_TO_MODEL + "SELECT * FROM trips_dropdown_compat",
    "model_data": UP_TO_MODEL + "SELECT * FROM trips_data",
    "join_trip_pickup": UP_TO_MODEL + """SELECT d.custom_id, d.pickup_timestmp AS timestmp,
        p.geohash, d.tip, d.fare
      FROM trips_data d JOIN trips_pickup p
        ON d.custom_id = p.custom_id AND d.pickup_timestmp = p.timestmp""",
    "join_trip_dropoff": UP_TO_MODEL + """SELECT d.custom_id, d.dropoff_timestmp AS timestmp,
        p.geohash, d.tip, d.fare
      FROM trips_data d JOIN trips_dropoff p
        ON d.custom_id = p.custom_id AND d.dropoff_timestmp = p.timestmp""",
    "avg_fare_per_mile": UP_TO_MODEL + """SELECT round(avg(fare / trip_distance), 3)
        AS avg_fare_per_mile FROM trips_data WHERE fare <> 0 AND trip_distance <> 0""",
    "avg_tip_by_zone": UP_TO_MODEL + f"""SELECT p.geohash,
        {_AVG_TIP} AS avg_tip,
        count(*) AS n_trips
      FROM trips_data d JOIN trips_pickup p
        ON d.custom_id = p.custom_id AND d.pickup_timestmp = p.timestmp
      GROUP BY p.geohash""",
    "top10_pickup_zones": UP_TO_MODEL + f"""SELECT geohash, avg_tip FROM (
        SELECT p.geohash, {_AVG_TIP} AS avg_tip
        FROM trips_data d JOIN trips_pickup p
          ON d.custom_id = p.custom_id AND d.pickup_timestmp = p.timestmp
        GROUP BY p.geohash) ORDER BY avg_tip DESC, geohash LIMIT 10""",
}


def _nullcode(c: str, table: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {c} {whens} END"


def _fc(c: str) -> str:
    """A coordinate of the profile: null unless it is a finite number."""
    v = f"round(TRY_CAST({c} AS DOUBLE), 7)"
    return f"CASE WHEN isfinite({v}) THEN {v} END"


TYPED = with_ctes(RAW, f"""
typed AS (
  SELECT {_nullcode('VendorID', _VENDOR)} AS VendorID,
    {_ts('tpep_pickup_datetime')} AS tpep_pickup_datetime,
    {_ts('tpep_dropoff_datetime')} AS tpep_dropoff_datetime,
    {_try_num('passenger_count')} AS passenger_count,
    {_try_num('trip_distance')} AS trip_distance,
    {_fc('pickup_longitude')} AS pickup_longitude,
    {_fc('pickup_latitude')} AS pickup_latitude,
    {_nullcode('RateCodeID', _RATE)} AS RateCodeID,
    store_and_fwd_flag,
    {_fc('dropoff_longitude')} AS dropoff_longitude,
    {_fc('dropoff_latitude')} AS dropoff_latitude,
    {_nullcode('payment_type', _PAY)} AS payment_type,
    {', '.join(f"{_try_num(c)} AS {c}" for c in NUM[2:])}
  FROM trips_raw
)""")

_TRIM_BOUNDS = """
b_lon AS (
  SELECT quantile_cont(pickup_longitude, 0.02) AS plo_a, quantile_cont(pickup_longitude, 0.98) AS plo_b,
         quantile_cont(dropoff_longitude, 0.02) AS dlo_a, quantile_cont(dropoff_longitude, 0.98) AS dlo_b
  FROM typed
),
b_plat AS (
  SELECT quantile_cont(pickup_latitude, 0.02) AS pla_a, quantile_cont(pickup_latitude, 0.98) AS pla_b
  FROM typed, b_lon WHERE pickup_longitude BETWEEN plo_a AND plo_b
),
b_dlat AS (
  SELECT quantile_cont(dropoff_latitude, 0.02) AS dla_a, quantile_cont(dropoff_latitude, 0.98) AS dla_b
  FROM typed, b_lon WHERE dropoff_longitude BETWEEN dlo_a AND dlo_b
),
trimmed AS (
  SELECT typed.* FROM typed, b_lon, b_plat, b_dlat
  WHERE pickup_longitude BETWEEN plo_a AND plo_b AND pickup_latitude BETWEEN pla_a AND pla_b
    AND dropoff_longitude BETWEEN dlo_a AND dlo_b AND dropoff_latitude BETWEEN dla_a AND dla_b
)"""

_DUR = ("date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) > 1 AND "
        "date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) < 86400")
_CODES_KNOWN = "VendorID IS NOT NULL AND RateCodeID IS NOT NULL AND payment_type IS NOT NULL"
_AMOUNTS_NONZERO = ("passenger_count <> 0 AND trip_distance <> 0 AND fare_amount <> 0 "
                    "AND total_amount <> 0")
_ALL = [c.strip() for c in RAW_COLS.split(",")]


def _stack(select_per_col: str, cols: list[str]) -> str:
    return " UNION ALL ".join(select_per_col.format(c=c) for c in cols)


ORACLE.update({
    "coord_ranges": TYPED + _stack(
        "SELECT '{c}' AS column, min({c}) AS min_value, max({c}) AS max_value FROM typed", COORD),
    "coord_quantiles": TYPED + " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST({p} AS DOUBLE) AS p, quantile_cont({c}, {p}) AS value FROM typed"
        for c in COORD for p in (0.02, 0.98)),
    "quantile_trim": TYPED.rstrip() + "," + _TRIM_BOUNDS + "\nSELECT * FROM trimmed",
    "duration_check": UP_TO_STAGED + """SELECT * FROM staged
      WHERE date_diff('second', strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'),
                      strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S')) > 1
        AND date_diff('second', strptime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'),
                      strptime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S')) < 86400""",
    "drop_unknown_codes": TYPED + f"SELECT * FROM typed WHERE {_CODES_KNOWN}",
    "drop_zero_amounts": TYPED + f"SELECT * FROM typed WHERE {_AMOUNTS_NONZERO}",
    "profile_clean": TYPED.rstrip() + "," + _TRIM_BOUNDS + f"""
      SELECT * FROM trimmed WHERE {_DUR} AND {_CODES_KNOWN} AND {_AMOUNTS_NONZERO}""",
    "null_counts": TYPED + _stack(
        "SELECT '{c}' AS column, count(*) - count({c}) AS n_null FROM typed", _ALL),
    "zero_counts": TYPED + _stack(
        "SELECT '{c}' AS column, count(*) FILTER (WHERE {c} = 0) AS n_zero FROM typed",
        NUM + COORD),
    "flag_counts": UP_TO_RAW + """SELECT store_and_fwd_flag, count(*) AS n FROM trips_raw
      WHERE store_and_fwd_flag IS NOT NULL GROUP BY store_and_fwd_flag""",
    "stage_retention": UP_TO_CLASSIFIED + """,
      steps AS (
        SELECT * FROM (VALUES (0, 'raw'), (1, 'header'), (2, 'coord_not_finite'),
          (3, 'zero_pickup'), (4, 'zero_dropoff'), (5, 'coord_out_of_range'),
          (6, 'bad_datetime'), (7, 'pickup_after_dropoff'), (8, 'bad_passenger_count'))
          AS s(step, rule)
      ),
      reason_rank AS (
        SELECT s.step AS reason_step, count(*) AS n
        FROM classified c JOIN steps s ON c.reject_reason = s.rule GROUP BY s.step
      ),
      total AS (SELECT count(*) AS raw FROM classified)
      SELECT s.step, s.rule,
        CAST(raw - coalesce((SELECT sum(n) FROM reason_rank WHERE reason_step <= s.step), 0)
             AS BIGINT) AS rows_left,
        round((raw - coalesce((SELECT sum(n) FROM reason_rank WHERE reason_step <= s.step), 0))
              / raw, 6) AS share_left
      FROM steps s, total""".replace("\n      steps", "\nsteps", 1),
})


_MONTH_FILTER = ("(source_file LIKE 'yellow_tripdata_1996-03_%.csv.zip' "
                 "OR source_file LIKE 'yellow_tripdata_1998-11_%.csv.zip')")
_FILES = """,
files AS (
  SELECT source_file AS file_name,
         CAST(sum(length(concat_ws(chr(9), """ + ", ".join(
    f"coalesce({c.strip()}, '')" for c in RAW_COLS.split(",")) + """)) + 1) AS BIGINT) AS length
  FROM trips_raw GROUP BY source_file
),
manifest AS (
  SELECT file_name, length,
         regexp_replace(file_name, '\\.csv\\.zip$', '') AS name,
         substr(file_name, 17, 7) AS month,
         regexp_extract(file_name, '_([0-9]+)\\.csv\\.zip$', 1) AS part
  FROM files WHERE suffix(file_name, '.csv.zip')
)
"""

_VENDORS = """SELECT r.VendorID, r.trip_distance, coalesce(s.s_name, ':') AS vendor_name
  FROM trips_raw r LEFT JOIN supplier s ON s.s_suppkey::VARCHAR = r.VendorID"""

ORACLE.update({
    "select_months": UP_TO_RAW + f"SELECT * FROM trips_raw WHERE {_MONTH_FILTER}",
    "file_manifest": UP_TO_RAW.rstrip() + _FILES + """SELECT file_name, length, name, month, part,
        '/data/source/' || file_name AS source_path,
        '/data/raw/' || name || '.csv' AS raw_path,
        '/data/staging/' || name AS staging_path
      FROM manifest WHERE contains(file_name, '1996')""",
    "new_files": UP_TO_RAW.rstrip() + _FILES + """SELECT 'stream' AS step, file_name, length FROM manifest
      WHERE month NOT LIKE '%-0_'
      UNION ALL SELECT 'wrong', file_name, length FROM manifest WHERE name = 'yellow_tripdata_1996-03_04'""",
    "load_ledger": UP_TO_RAW.rstrip() + _FILES + """SELECT file_name, length,
        CASE WHEN name = 'yellow_tripdata_1996-03_04' THEN 3 ELSE 1 END::BIGINT AS n_loads FROM manifest""",
    "file_count": UP_TO_RAW.rstrip() + _FILES + """SELECT count(*) AS n_files
      FROM manifest WHERE contains(file_name, '1996')""",
    "model_incremental": UP_TO_MODEL + "SELECT * FROM trips_pickup",
    "model_incremental_data": UP_TO_MODEL + "SELECT * FROM trips_data",
    "index_days": UP_TO_MODEL + "SELECT day, count(*) AS n_rows FROM trips_pickup GROUP BY day",
    "trips_in_range": UP_TO_MODEL + """SELECT * FROM trips_pickup WHERE day BETWEEN DATE '1995-02-01' AND DATE '1997-08-15'
      AND geohash BETWEEN 'dr5r' AND 'dr5x5'""",
    "tables_by_name": UP_TO_MODEL + "SELECT * FROM trips_dropoff",
    "columns_by_file": UP_TO_LOAD.replace("1, 6) AS id", "1, 6) AS id, source_file").replace(
        "    dropoff_geom\n", "    dropoff_geom, source_file\n") + """SELECT * EXCLUDE (source_file) REPLACE (
        CASE WHEN regexp_extract(source_file, '_([0-9]+)[.]csv', 1)::INTEGER % 2 = 0 THEN 0.0
        WHEN passenger_count = 0 THEN NULL ELSE improvement_surcharge END AS improvement_surcharge) FROM load""",
    "lookup_vendor": UP_TO_RAW + _VENDORS,
    "lookup_vendor_shuffled": UP_TO_RAW + _VENDORS,
    "profile_retention": TYPED.rstrip() + "," + _TRIM_BOUNDS + f""",
kept AS (SELECT 1 AS step, count(*) AS n FROM trimmed UNION ALL
  SELECT 2, count(*) FROM trimmed WHERE {_DUR} UNION ALL
  SELECT 3, count(*) FROM trimmed WHERE {_DUR} AND {_CODES_KNOWN} UNION ALL
  SELECT 4, count(*) FROM trimmed WHERE {_DUR} AND {_CODES_KNOWN} AND {_AMOUNTS_NONZERO} UNION ALL
  SELECT 0, count(*) FROM typed)
SELECT step::INTEGER AS step, ['raw', 'quantile_trim', 'duration', 'unknown_code', 'zero_amount'][step + 1] AS rule,
  n AS rows_left, round(n / first_value(n) OVER w, 6) AS share_left,
  round(n / coalesce(lag(n) OVER w, n), 6) AS share_kept FROM kept WINDOW w AS (ORDER BY step)""",
    "read_raw": UP_TO_RAW + f"SELECT {RAW_COLS} FROM trips_raw",
    "read_staged": UP_TO_STAGED + "SELECT * FROM staged",
    "append_tmp": UP_TO_LOAD + "SELECT * FROM load",
    "extract_raw": UP_TO_RAW + f"""SELECT {RAW_COLS} FROM trips_raw WHERE {_MONTH_FILTER}
      AND (pickup_longitude IS NOT NULL OR pickup_latitude IS NOT NULL OR dropoff_longitude IS NOT NULL
        OR dropoff_latitude IS NOT NULL OR tpep_pickup_datetime IS NOT NULL OR tpep_dropoff_datetime IS NOT NULL)
      AND {_C5}""",
})
