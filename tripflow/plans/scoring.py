"""Request validation and request scoring.

A request is ``{"trips": [trip, ...]}``. Fields are read as *strings* so lax
numeric forms (``"2"``, ``2.0``) can be validated instead of silently nulled,
then each trip is checked with column expressions over the array (no explode,
no shuffle): required integral ids, a ``YYYY-MM-DD HH:MM:SS`` pickup (unpadded
fields accepted, calendar-checked), optional numeric passenger count and trip
type. One bad trip rejects its whole request, with the first bad position and
field as the reason.

Scoring explodes the trips of valid requests, runs any scorer (``DataFrame -> DataFrame`` adding ``prediction``:
the fitted pipeline or a formula), and rebuilds each request's predictions in
trip order; a valid request without trips answers with an empty list. Requests
hold few trips, so the regrouping shuffle moves one small row per trip and no
group is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.columns import integer_or_null, number_or_null
from tripflow.schema import PICKUP, TRIP_REQUEST, TRIP_REQUEST_FIELDS

# fixed validation rules of the request contract
REQUIRED_INT_FIELDS = ["VendorID", "PULocationID", "DOLocationID"]
OPTIONAL_FLOAT_FIELDS = ["passenger_count", "trip_type"]
FIELD_ORDER = ["VendorID", PICKUP, "PULocationID", "DOLocationID", "passenger_count", "trip_type"]
DATETIME_PATTERN = (r"^[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]) "
                    r"(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):([0-5][0-9]|[0-9])$")
REJECTED_STATUS, OK_STATUS = 422, 200


def parse_requests(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """JSON text -> ``trips`` array of string-typed trip structs (a malformed body gives null)."""
    return bodies.withColumn("trips", F.from_json(F.col(body_col), TRIP_REQUEST)["trips"]).drop(body_col)


def parse_requests_typed(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """S7 by JSON type: as ``parse_requests``, but what the text alone cannot tell apart is told apart by VARIANT.

    The contract accepts numbers, numbers in quotes and, as 1 and 0, ``true`` and ``false`` (in quotes they are text and
    no number); arrays and objects are no value of any field. A pickup must be text. A body that is no JSON, or whose
    ``trips`` is no array of objects, has null ``trips``; of a field given twice, as of one that is null, nothing is said
    here beyond what the parser keeps.
    """
    whole = F.try_parse_json(F.col(body_col))
    trips = F.try_variant_get(whole, "$.trips", "array<variant>")

    def field(t: Column, name: str) -> Column:
        value = F.try_variant_get(t, f"$.{name}", "variant")
        kind = F.schema_of_variant(value)
        text = F.try_variant_get(t, f"$.{name}", "string")
        if name == PICKUP:
            return F.when(kind == "STRING", text).when(value.isNull() | (kind == "VOID"), F.lit(None)).otherwise(F.lit("?"))
        flag = F.try_variant_get(t, f"$.{name}", "boolean")
        return (F.when(value.isNull() | (kind == "VOID"), F.lit(None))
                .when(kind == "BOOLEAN", F.when(flag, F.lit("1")).otherwise(F.lit("0")))
                .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.lit("?")).otherwise(text))

    typed = F.transform(trips, lambda t: F.struct(*[field(t, n).alias(n) for n in FIELD_ORDER]))
    objects = F.forall(trips, lambda t: F.coalesce(F.schema_of_variant(t).startswith("OBJECT"), F.lit(False)))
    return bodies.withColumn("trips", F.when(objects, typed)).drop(body_col)


def _numeric(s: Column) -> Column:
    return number_or_null(s).isNotNull() | F.coalesce(s.rlike(r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"), F.lit(False))


def _pickup(s: Column) -> Column:
    """Typed pickup, or null when the text is not a valid ``YYYY-MM-DD HH:MM:SS`` wall-clock time."""
    parts = [F.regexp_extract(s, r"^([0-9]+)-([0-9]+)-([0-9]+) ([0-9]+):([0-9]+):([0-9]+)$", i).cast("int")
             for i in range(1, 7)]
    made = F.try_make_timestamp_ntz(*parts[:5], parts[5].cast("decimal(16,6)"))
    return F.when(s.rlike(DATETIME_PATTERN), made)


def trip_problem(t: Column) -> Column:
    """Name of the first invalid field of one trip struct, or null when the trip is valid."""
    out = None
    for name in FIELD_ORDER:
        v = t[name]
        if name in REQUIRED_INT_FIELDS:
            bad = integer_or_null(v).isNull()
        elif name == PICKUP:
            bad = v.isNull() | _pickup(v).isNull()
        else:
            bad = v.isNotNull() & ~_numeric(v)
        out = F.when(bad, F.lit(name)) if out is None else out.when(bad, F.lit(name))
    return out


def typed_trip(t: Column) -> Column:
    return F.struct(
        integer_or_null(t["VendorID"]).alias("VendorID"),
        _pickup(t[PICKUP]).alias(PICKUP),
        integer_or_null(t["PULocationID"]).alias("PULocationID"),
        integer_or_null(t["DOLocationID"]).alias("DOLocationID"),
        t["passenger_count"].try_cast("double").alias("passenger_count"),
        t["trip_type"].try_cast("double").alias("trip_type"),
    )


def validate_requests(parsed: DataFrame, raw_col: str | None = None) -> DataFrame:
    """Adds valid, n_trips, n_invalid_trips, first_invalid_pos (0-based), first_invalid_field, typed ``trips``
    (and, under ``raw_col``, the trips as they came)."""
    trips = F.col("trips")
    problems = F.transform(trips, trip_problem)
    first = F.array_position(F.transform(problems, lambda p: p.isNotNull()), F.lit(True))
    n_invalid = F.size(F.filter(problems, lambda p: p.isNotNull()))
    return parsed.select(
        *[c for c in parsed.columns if c != "trips"],
        F.when(trips.isNotNull(), F.size(trips)).alias("n_trips"),
        F.when(trips.isNull(), F.lit(None).cast("int")).otherwise(n_invalid).alias("n_invalid_trips"),
        F.when(first > 0, (first - 1).cast("int")).alias("first_invalid_pos"),
        F.when(trips.isNull(), F.lit("trips")).when(first > 0, F.element_at(problems, first.cast("int")))
        .alias("first_invalid_field"),
        (trips.isNotNull() & (n_invalid == 0)).alias("valid"),
        F.when(trips.isNotNull(), F.transform(trips, typed_trip)).alias("trips"),
        *([trips.alias(raw_col)] if raw_col else []),
    )


def explode_trips(validated: DataFrame, key: str = "request_id") -> DataFrame:
    """One row per trip of each valid request, with its position (a request without trips gives no row)."""
    ok = validated.where("valid")
    return ok.select(key, F.posexplode("trips").alias("pos", "trip")).select(key, "pos", "trip.*")


def neutral_trips(validated: DataFrame, key: str, *more: str) -> DataFrame:
    """A row for each trip of a valid request, with its position; any other request is one neutral trip without one."""
    trips = F.when(F.col("valid"), F.col("trips"))
    rows = validated.select(key, "valid", *more, F.posexplode_outer(trips).alias("pos", "trip"))
    neutral = {"VendorID": F.lit(0), PICKUP: F.lit("2000-01-01 00:00:00").cast(T.TimestampNTZType()),
               "PULocationID": F.lit(0), "DOLocationID": F.lit(0)}
    fields = [F.coalesce(F.col(f"trip.{c}"), neutral[c]).alias(c) if c in neutral else F.col(f"trip.{c}").alias(c) for c in FIELD_ORDER]
    return rows.select(key, "valid", *more, "pos", *fields)


def score_requests(validated: DataFrame, scorer, metadata: dict, key: str = "request_id", more: tuple[str, ...] = ()) -> DataFrame:
    """M9: per request: status, predictions in trip order, model metadata (rejected: 422, no predictions), and the
    columns ``more`` of the request.

    One pass: every request gives at least one row. A request without trips to score travels as a neutral trip, so
    the scorer only ever sees whole trips, and its prediction is left out when the requests are put together again.
    """
    scored = scorer.transform(neutral_trips(validated, key, *more))
    answers = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "prediction"))))
    per_request = scored.groupBy(key, "valid", *more).agg(answers.alias("__p"))
    return per_request.select(
        key, F.when(F.col("valid"), F.lit(OK_STATUS)).otherwise(F.lit(REJECTED_STATUS)).alias("status"),
        F.when(F.col("valid"), F.transform("__p", lambda x: x["prediction"])).alias("predictions"),
        F.lit(metadata.get("model_name")).cast("string").alias("model_name"),
        F.lit(metadata.get("model_version")).cast("int").alias("model_version"),
        F.lit(metadata.get("model_alias")).cast("string").alias("model_alias"), *more,
    )


def request_schema_with_key(key: str = "request_id") -> T.StructType:
    """Schema of one JSON line of a request stream: the key plus the trips array."""
    return T.StructType([T.StructField(key, T.LongType()), T.StructField("trips", T.ArrayType(TRIP_REQUEST_FIELDS))])
