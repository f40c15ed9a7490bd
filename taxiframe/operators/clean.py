"""Raw trip text -> staged trips, with every rejected row kept and explained.

One narrow pass: each rule becomes a column expression, the first rule a row
breaks names its ``reject_reason``. Staged rows (reason null) and quarantined
rows (reason set) are two filters over the same classified frame, so there is
no shuffle anywhere in the chain and ``staged + quarantined = raw`` holds by
construction. Order of the rules follows the reference: geometry, then
datetimes, then numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxiframe.functions import codes, datetimes, geo, numbers
from taxiframe.schemas import (COORDINATES, DATETIMES, NUMBERS, RAW_COLUMNS,
                               STAGED_COLUMNS)

P = "_p_"  # prefix of parsed columns inside the classified frame

# Reject reasons, in the order the rules apply.
REASONS = [
    "header",                # a header line inside a part
    "coord_not_finite",      # nan / inf coordinate text
    "zero_pickup",           # pickup longitude and latitude both 0
    "zero_dropoff",          # dropoff longitude and latitude both 0
    "coord_out_of_range",    # outside [-180,180] x [-90,90]
    "bad_datetime",          # pickup or dropoff text not a datetime
    "pickup_after_dropoff",  # pickup later than dropoff
    "bad_passenger_count",   # a fraction or beyond INT range
]


def p(name: str) -> Column:
    return F.col(P + name)


def parse_geometry(df: DataFrame) -> DataFrame:
    """Parsed coordinates (B1), WKT points (B2) and the centroid."""
    out = df.withColumns({P + c: geo.parse_coord(c) for c in COORDINATES})
    return out.withColumns({
        P + "pickup_geom": geo.wkt_point(p("pickup_longitude"), p("pickup_latitude")),
        P + "dropoff_geom": geo.wkt_point(p("dropoff_longitude"), p("dropoff_latitude")),
        P + "centroid_latitude": geo.midpoint(p("pickup_latitude"), p("dropoff_latitude")),
        P + "centroid_longitude": geo.midpoint(p("pickup_longitude"), p("dropoff_longitude")),
    })


def parse_datetimes(df: DataFrame) -> DataFrame:
    """Both trip times as TIMESTAMP (B4); null where the text is not a datetime."""
    return df.withColumns({P + c: datetimes.parse_datetime(c) for c in DATETIMES})


def parse_numbers(df: DataFrame) -> DataFrame:
    """The 9 amounts as DOUBLE."""
    return df.withColumns({P + c: numbers.parse_number(c) for c in NUMBERS})


def decode_codes(df: DataFrame) -> DataFrame:
    """Code labels (B6, unknown -> ':') and the flag as 1/0/null."""
    return df.withColumns({
        P + "VendorID": codes.decode("VendorID"),
        P + "RateCodeID": codes.decode("RateCodeID"),
        P + "payment_type": codes.decode("payment_type"),
        P + "store_and_fwd_flag": codes.flag_code("store_and_fwd_flag"),
    })


def trip_id(df: DataFrame) -> DataFrame:
    """``lat6_lon6_m6`` id (B8): 6 leading characters, dots removed, of the
    centroid latitude, centroid longitude and of distance+extra+tip text."""
    def head6(text: Column) -> Column:
        return F.substring(F.replace(text, F.lit("."), F.lit("")), 1, 6)

    mult = F.concat(*[numbers.number_text(c) for c in ("trip_distance", "extra", "tip_amount")])
    return df.withColumn(P + "id", F.concat_ws(
        "_", head6(p("centroid_latitude").cast("string")),
        head6(p("centroid_longitude").cast("string")), head6(mult)))


def _reason() -> Column:
    coords = [p(c) for c in COORDINATES]
    pu_lon, pu_lat, do_lon, do_lat = coords
    pc = p("passenger_count")
    rules = [
        ("header", (F.col("VendorID") == "VendorID")
         & (F.col("tpep_pickup_datetime") == "tpep_pickup_datetime")),
        ("coord_not_finite", ~(geo.is_finite(pu_lon) & geo.is_finite(pu_lat)
                               & geo.is_finite(do_lon) & geo.is_finite(do_lat))),
        ("zero_pickup", (pu_lon == 0) & (pu_lat == 0)),
        ("zero_dropoff", (do_lon == 0) & (do_lat == 0)),
        ("coord_out_of_range", ~(geo.in_range(pu_lon, pu_lat) & geo.in_range(do_lon, do_lat))),
        ("bad_datetime", p("tpep_pickup_datetime").isNull()
         | p("tpep_dropoff_datetime").isNull()),
        ("pickup_after_dropoff", p("tpep_pickup_datetime") > p("tpep_dropoff_datetime")),
        ("bad_passenger_count", ~numbers.is_whole(pc) | (F.abs(pc) > 2147483647)),
    ]
    assert [r for r, _ in rules] == REASONS
    expr = None
    for name, cond in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def classify(raw: DataFrame) -> DataFrame:
    """Raw columns (kept as text) + parsed ``_p_*`` columns + ``reject_reason``."""
    return (raw.transform(parse_geometry).transform(parse_datetimes)
            .transform(decode_codes).transform(parse_numbers).transform(trip_id)
            .withColumn("reject_reason", _reason()))


def _staged_projection() -> list[Column]:
    out = []
    for c in STAGED_COLUMNS:
        if c in DATETIMES:
            out.append(datetimes.datetime_text(p(c)).alias(c))
        elif c == "passenger_count":
            out.append(p(c).cast("int").alias(c))
        else:
            out.append(p(c).alias(c))
    return out


def staged_view(classified: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The 22 staged columns of the accepted rows (``trips_staged``), and those
    named in ``extra``.

    Accepted rows are emitted by exploding a zero-or-one element array rather
    than by a filter: the acceptance test needs every parsed value, and a
    filter would be pushed below the parsing projection by Catalyst and parse
    each row twice. This way each row is parsed once, in one codegen stage.
    """
    row = F.struct(*_staged_projection())
    kept = F.when(F.col("reject_reason").isNull(), F.array(row))
    return classified.select(F.explode(kept).alias("_staged"), *extra).select("_staged.*", *extra)


def quarantine_view(classified: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rejected rows: the raw text as read, plus the reason."""
    keep = RAW_COLUMNS + (extra or []) + ["reject_reason"]
    return classified.filter(F.col("reject_reason").isNotNull()).select(*keep)


def stage_trips(raw: DataFrame) -> DataFrame:
    """Full chain raw -> staged (H5): geometry, datetimes, numbers."""
    return staged_view(classify(raw))


def quarantine(raw: DataFrame) -> DataFrame:
    extra = [c for c in raw.columns if c not in RAW_COLUMNS]
    return quarantine_view(classify(raw), extra)


# --- single rules, usable on their own (filters over raw text) --------------

def drop_zero_points(raw: DataFrame) -> DataFrame:
    """C1, pickup then dropoff: keep a row if any coordinate of a point is non-zero."""
    parsed = {c: geo.parse_coord(c) for c in COORDINATES}
    keep = (((parsed["pickup_longitude"] != 0) | (parsed["pickup_latitude"] != 0))
            & ((parsed["dropoff_longitude"] != 0) | (parsed["dropoff_latitude"] != 0)))
    return raw.filter(keep)


def order_check(df: DataFrame, pickup: str = "tpep_pickup_datetime",
                dropoff: str = "tpep_dropoff_datetime") -> DataFrame:
    """Keep rows with both times parseable and pickup <= dropoff."""
    return df.filter(datetimes.parse_datetime(pickup) <= datetimes.parse_datetime(dropoff))


def any_not_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C4 (older job): keep if any coordinate or datetime is not null."""
    cols = cols or COORDINATES + DATETIMES
    return df.filter(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def any_coord_nonzero(df: DataFrame, cols: list[str] | None = None,
                      threshold: float = 0.01) -> DataFrame:
    """C5 (older job): columns are tried in order; a column that does not parse
    (or is null) ends the test with False, one with ``abs >= threshold`` ends
    it with True, otherwise the next column decides."""
    cols = cols or COORDINATES
    expr = F.lit(False)
    for c in reversed(cols):
        v = numbers.parse_float(c)
        # NaN compares above every number in Spark; float('nan') fails ``>=``.
        expr = (F.when(v.isNull(), F.lit(False))
                .when(~F.isnan(v) & (F.abs(v) >= threshold), F.lit(True)).otherwise(expr))
    return df.filter(expr)
