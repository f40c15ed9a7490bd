"""Schemas, code tables and the name-suffix role selectors of the trip data."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: must equal the reference's for identical results --------
# Column order of a raw trip line (tab separated, no header handling).
RAW_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "passenger_count", "trip_distance", "pickup_longitude", "pickup_latitude",
    "RateCodeID", "store_and_fwd_flag", "dropoff_longitude",
    "dropoff_latitude", "payment_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
]
# Staged columns = raw columns + these three, in this order.
STAGED_EXTRA = ["pickup_geom", "dropoff_geom", "id"]
# Code tables (code text -> label); unknown codes become ":".
PAYMENT_TYPE = {"1": "credit_card", "2": "cash", "3": "no_charge",
                "4": "dispute", "5": "unknown", "6": "voided trip"}
RATE_CODE = {"1": "standard_rate", "2": "jfk", "3": "newark",
             "4": "nassau_or_westchester", "5": "negotiated_fare",
             "6": "group_fare"}
VENDOR = {"1": "Creative Mobile Technologies, LLC.", "2": "VeriFone Inc."}
FLAG = {"Y": 1, "N": 0}
UNKNOWN_CODE = ":"
SOURCE_NAME = "yellow_tripdata"
DATETIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Defaults of the load step for columns absent from the staged file, by type.
LOAD_DEFAULTS = {"double": 0.0, "boolean": False, "string": ":",
                 "geography": "POINT(0 0)"}
# --- end of fixed values ----------------------------------------------------

CODE_TABLES = {"payment_type": PAYMENT_TYPE, "RateCodeID": RATE_CODE,
               "VendorID": VENDOR}

STAGED_COLUMNS = RAW_COLUMNS + STAGED_EXTRA

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


def _staged_type(name: str) -> T.DataType:
    if name == "passenger_count":
        return T.IntegerType()
    if name == "store_and_fwd_flag":
        return T.ShortType()
    if name in ("VendorID", "RateCodeID", "payment_type") or name in STAGED_EXTRA:
        return T.StringType()
    if name.endswith("datetime"):
        return T.StringType()
    return T.DoubleType()


STAGED_SCHEMA = T.StructType([T.StructField(c, _staged_type(c)) for c in STAGED_COLUMNS])

# --- fixed values: the load table ``tripdata_tmp``, (name, load type) in order -
LOAD_FIELDS = [
    ("id", "string"), ("VendorID", "string"), ("RateCodeID", "string"),
    ("store_and_fwd_flag", "boolean"), ("payment_type", "string"),
    ("tpep_pickup_datetime", "string"), ("tpep_dropoff_datetime", "string"),
    ("passenger_count", "double"), ("trip_distance", "double"),
    ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
    ("tip_amount", "double"), ("tolls_amount", "double"),
    ("improvement_surcharge", "double"), ("total_amount", "double"),
    ("pickup_longitude", "double"), ("pickup_latitude", "double"),
    ("pickup_geom", "geography"), ("dropoff_longitude", "double"),
    ("dropoff_latitude", "double"), ("dropoff_geom", "geography"),
]
# --- fixed values: amounts that may be 0 in the profile, by the start of the name
OPTIONAL_AMOUNTS = ("tip", "tolls", "extra", "improvement", "mta")
# --- end of fixed values ----------------------------------------------------
LOAD_COLUMNS = [n for n, _ in LOAD_FIELDS]


# --- role selectors: a column's role is chosen by its name suffix ----------

def coordinate_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c.endswith("itude")]


def datetime_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c.endswith("datetime")]


def geometry_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c.endswith("geom")]


def code_columns(columns: list[str]) -> list[str]:
    """Coded columns: names ending in id (any case), flag or type."""
    return [c for c in columns
            if c.lower().endswith("id") or c.endswith("flag") or c.endswith("type")]


def numeric_columns(columns: list[str]) -> list[str]:
    """Everything that is not a coordinate, datetime, geometry or code."""
    skip = set(coordinate_columns(columns) + datetime_columns(columns)
               + geometry_columns(columns) + code_columns(columns))
    return [c for c in columns if c not in skip]


def nonzero_amount_columns(columns: list[str]) -> list[str]:
    """Numeric columns that must be non-zero in the profile (tips etc. may be 0)."""
    return [c for c in numeric_columns(columns) if not c.startswith(OPTIONAL_AMOUNTS)]


COORDINATES = coordinate_columns(RAW_COLUMNS)
DATETIMES = datetime_columns(RAW_COLUMNS)
CODES = code_columns(RAW_COLUMNS)
NUMBERS = numeric_columns(RAW_COLUMNS)
