"""Fitted trip features as a Spark ML Estimator / Model (M1, M2, M3; A1-A4, J3, F5-F11, P8-P13).

Fit plan (train rows only): ONE grouped count over the training rows keyed by
(pickup zone, dropoff zone, vendor, trip type). Map-side partial aggregation
means a hot key costs nothing extra, and the result is bounded by
zones^2 x vendors x trip types, independent of the row count. It is checkpointed
to the shared checkpoint folder (lineage cut, survives executor loss). Every
statistic is then derived from that small table:

* median of positive zone-to-zone distance: exact ``percentile(d, 0.5, n)`` weighted by counts
* normalised value counts of pickup zone, dropoff zone and route (nulls kept as keys)
* mode of trip type (lowest value on ties, nulls ignored, fallback 1.0)
* sorted categories of vendor, trip type, pickup/dropoff borough (null -> sentinel)

Transform plan: column expressions plus three lookup joins (pickup, dropoff and
route tables, materialised once per model) whose sizes are bounded by the fit and
which are broadcast only under the limit; no shuffle otherwise, and it is
streaming-safe (stream-static joins).
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.columns import lax_double, safe_names, same_value_flag, with_sentinel
from tripflow.functions.geo import haversine_miles
from tripflow.functions.timefeat import as_timestamp, cyclical, hour, is_rush_hour, is_weekend, weekday_monday0
from tripflow.operators.joins import BROADCAST_MAX_ROWS, Dimension
from tripflow.schema import (
    BASE_FEATURES,
    CATEGORICAL_FEATURE_COLUMNS,
    DEFAULT_DISTANCE,
    DEFAULT_PASSENGER_COUNT,
    DEFAULT_TRIP_TYPE,
    FEATURE_MISSING,
    PICKUP,
)
from tripflow.session import ensure_checkpoint_dir

#: Categories a column may have: each becomes a feature column.
MAX_CATEGORIES = 2000

PU, DO = "PULocationID", "DOLocationID"


def fit_summary(train: DataFrame) -> DataFrame:
    """The single pass over training rows: counts per (zone pair, vendor, trip type)."""
    return train.groupBy(
        F.col(PU).cast("bigint").alias(PU),
        F.col(DO).cast("bigint").alias(DO),
        F.col("VendorID").cast("bigint").alias("VendorID"),
        lax_double(F.col("trip_type")).alias("trip_type"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _zone_side(zones: Dimension, prefix: str) -> DataFrame:
    return zones.df.select(
        F.col("LocationID").alias(f"__{prefix}_key"),
        F.col("Borough").alias(f"{prefix}_Borough"),
        F.col("latitude").alias(f"{prefix}_lat"),
        F.col("longitude").alias(f"{prefix}_long"),
    )


def enrich_summary(summary: DataFrame, zones: Dimension) -> DataFrame:
    pu, do = _zone_side(zones, "PU"), _zone_side(zones, "DO")
    out = summary.join(zones.side(pu), F.col(PU) == F.col("__PU_key"), "left")
    out = out.join(zones.side(do), F.col(DO) == F.col("__DO_key"), "left")
    return out.withColumn(
        "estimated_distance_miles", haversine_miles(F.col("PU_lat"), F.col("PU_long"), F.col("DO_lat"), F.col("DO_long"))
    )


class _FeatureParams(Params):
    labelCol = Param(Params._dummy(), "labelCol", "target column that must be present at fit", TypeConverters.toString)
    broadcastMaxRows = Param(Params._dummy(), "broadcastMaxRows", "largest lookup table to broadcast",
                             TypeConverters.toInt)
    keepCols = Param(Params._dummy(), "keepCols", "input columns passed through transform", TypeConverters.toListString)
    featuresCol = Param(Params._dummy(), "featuresCol", "when not empty, also assemble the features into this vector",
                        TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="duration", broadcastMaxRows=BROADCAST_MAX_ROWS, keepCols=[], featuresCol="")


class TripFeatures(Estimator, _FeatureParams):
    """Estimator over raw model inputs; ``zones`` is the checked zone dimension."""

    @keyword_only
    def __init__(self, *, zones: Dimension = None, labelCol: str = "duration", broadcastMaxRows: int = BROADCAST_MAX_ROWS,
                 keepCols=None, featuresCol: str = ""):
        super().__init__()
        self.zones = zones
        kwargs = {k: v for k, v in self._input_kwargs.items() if k != "zones" and v is not None}
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "TripFeaturesModel":
        label = self.getOrDefault(self.labelCol)
        if label not in dataset.columns:
            raise ValueError(f"the target column {label!r} is required to fit TripFeatures")
        ensure_checkpoint_dir(dataset.sparkSession)
        summary = fit_summary(dataset).checkpoint(eager=True)
        model = TripFeaturesModel.from_summary(summary, self.zones, self.getOrDefault(self.broadcastMaxRows),
                                               self.getOrDefault(self.keepCols))
        model._set(featuresCol=self.getOrDefault(self.featuresCol))
        return model


class TripFeaturesModel(Model, _FeatureParams, MLWritable, MLReadable):
    def __init__(self):
        super().__init__()
        self.zones: Dimension | None = None
        self.summary: DataFrame | None = None
        self.total_rows = 0
        self.median_distance = DEFAULT_DISTANCE
        self.trip_type_fallback = DEFAULT_TRIP_TYPE
        self.categories: dict[str, list[str]] = {}
        self.feature_names: list[str] = []
        self.route_rows = 0
        self.pu_rows = 0
        self.do_rows = 0
        self._tables: dict[str, tuple[DataFrame, int]] | None = None

    # ------------------------------------------------------------------ fit
    @classmethod
    def from_summary(cls, summary: DataFrame, zones: Dimension, broadcast_max_rows: int, keep_cols) -> "TripFeaturesModel":
        model = cls()
        model._set(broadcastMaxRows=broadcast_max_rows, keepCols=list(keep_cols or []))
        model.zones, model.summary = zones, summary
        enriched = enrich_summary(summary, zones)
        d = F.col("estimated_distance_miles")
        cats = [
            F.array_sort(F.collect_set(with_sentinel(F.col(c), FEATURE_MISSING))).alias(c)
            for c in CATEGORICAL_FEATURE_COLUMNS
        ]
        row = enriched.agg(
            F.sum("n").alias("total"),
            F.percentile(F.when(d > 0, d), F.lit(0.5), F.col("n")).alias("median"),
            F.count(F.lit(1)).alias("summary_rows"),
            *cats,
        ).first()
        model.total_rows = int(row["total"] or 0)
        model.median_distance = float(row["median"]) if row["median"] is not None else DEFAULT_DISTANCE
        # the summary row count bounds every lookup table's size (used for the broadcast decision)
        model.route_rows = model.pu_rows = model.do_rows = int(row["summary_rows"])
        model.categories = {c: list(row[c]) for c in CATEGORICAL_FEATURE_COLUMNS}
        for c, found in model.categories.items():
            if len(found) > MAX_CATEGORIES:
                raise ValueError(f"{c} has {len(found)} categories; one column each is only sensible up to {MAX_CATEGORIES}")
        mode = (
            summary.where(F.col("trip_type").isNotNull())
            .groupBy("trip_type").agg(F.sum("n").alias("c"))
            .agg(F.min_by(F.col("trip_type"), F.struct(-F.col("c"), F.col("trip_type"))).alias("mode"))
            .first()["mode"]
        )
        model.trip_type_fallback = float(mode) if mode is not None else DEFAULT_TRIP_TYPE
        model.feature_names = BASE_FEATURES + [
            f"{c}_{cat}" for c in CATEGORICAL_FEATURE_COLUMNS for cat in model.categories[c][1:]
        ]
        return model

    # ------------------------------------------------------------ fitted tables
    def _freq(self, *keys: str) -> DataFrame:
        total = F.lit(float(max(self.total_rows, 1)))
        return self.summary.groupBy(*keys).agg((F.sum("n") / total).alias("frequency"))

    def route_frequency_table(self) -> DataFrame:
        return self._freq(PU, DO).withColumnRenamed("frequency", "route_frequency")

    def zone_frequency_table(self, side: str) -> DataFrame:
        key = PU if side == "PU" else DO
        return self._freq(key).withColumnRenamed("frequency", f"{side}_zone_frequency")

    def _lookup(self, side: str) -> DataFrame:
        """Zone attributes and train frequency of one side, keyed null-safely (unseen zones -> 0.0 later)."""
        key = PU if side == "PU" else DO
        freq = self.zone_frequency_table(side).withColumnRenamed(key, f"__{side}_fkey")
        zone = _zone_side(self.zones, side)
        joined = zone.join(freq, F.col(f"__{side}_key").eqNullSafe(F.col(f"__{side}_fkey")), "full_outer")
        return joined.select(
            F.coalesce(F.col(f"__{side}_key"), F.col(f"__{side}_fkey")).alias(f"__{side}_lk"),
            f"{side}_Borough", f"{side}_lat", f"{side}_long", f"{side}_zone_frequency",
        )

    def lookup_tables(self) -> dict[str, tuple[DataFrame, int]]:
        """The three lookup tables, materialised once per model (checkpointed) with proven row bounds.

        They are small (bounded by the fit summary) and every transform, batch or micro-batch,
        then only broadcasts them instead of re-deriving them from the summary.
        """
        if self._tables is None:
            ensure_checkpoint_dir(self.summary.sparkSession)
            route = self.route_frequency_table().select(
                F.col(PU).alias("__r_pu"), F.col(DO).alias("__r_do"), "route_frequency")
            # row bounds known from the fit (no extra job): a zone side holds at most zones + seen keys,
            # the route table at most the fit-summary rows
            bounds = {"PU": self.pu_rows + self.zones.rows, "DO": self.do_rows + self.zones.rows,
                      "route": self.route_rows}
            self._tables = {name: (df.checkpoint(eager=True), bounds[name])
                            for name, df in (("PU", self._lookup("PU")), ("DO", self._lookup("DO")), ("route", route))}
        return self._tables

    def _side(self, df: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(df) if rows <= self.getOrDefault(self.broadcastMaxRows) else df

    # ------------------------------------------------------------ transform
    def physical_names(self) -> list[str]:
        return safe_names(self.feature_names)

    def getFeatureNamesOut(self) -> list[str]:
        return list(self.feature_names)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = set(dataset.columns)
        types = {f.name: f.dataType for f in dataset.schema.fields}
        passenger = (F.coalesce(lax_double(F.col("passenger_count")), F.lit(DEFAULT_PASSENGER_COUNT))
                     if "passenger_count" in cols else F.lit(DEFAULT_PASSENGER_COUNT))
        trip_type = (F.coalesce(lax_double(F.col("trip_type")), F.lit(self.trip_type_fallback))
                     if "trip_type" in cols else F.lit(self.trip_type_fallback))
        ts = as_timestamp(F.col(PICKUP), types[PICKUP])
        keep = [c for c in self.getOrDefault(self.keepCols) if c in cols]
        base = dataset.select(
            *keep,
            F.col("VendorID").cast("bigint").alias("__vendor"),
            F.col(PU).cast("bigint").alias("__pu"),
            F.col(DO).cast("bigint").alias("__do"),
            passenger.alias("__passenger"),
            trip_type.alias("__trip_type"),
            ts.alias("__ts"),
        )
        tables = self.lookup_tables()
        (pu_l, pu_n), (do_l, do_n), (route, route_n) = tables["PU"], tables["DO"], tables["route"]
        out = base.join(self._side(pu_l, pu_n), F.col("__pu").eqNullSafe(F.col("__PU_lk")), "left")
        out = out.join(self._side(do_l, do_n), F.col("__do").eqNullSafe(F.col("__DO_lk")), "left")
        out = out.join(self._side(route, route_n),
                       F.col("__pu").eqNullSafe(F.col("__r_pu")) & F.col("__do").eqNullSafe(F.col("__r_do")), "left")

        h, dow = hour(F.col("__ts")), weekday_monday0(F.col("__ts"))
        hs, hc = cyclical(h, 24.0)
        ds, dc = cyclical(dow, 7.0)
        dist = haversine_miles(F.col("PU_lat"), F.col("PU_long"), F.col("DO_lat"), F.col("DO_long"))
        values = {
            "passenger_count": F.col("__passenger"),
            "pickup_month": F.month(F.col("__ts")),
            "day_of_month": F.dayofmonth(F.col("__ts")),
            "estimated_distance_miles": F.coalesce(dist, F.lit(self.median_distance)),
            "same_borough": same_value_flag(F.col("PU_Borough"), F.col("DO_Borough")),
            "hour_sin": hs,
            "hour_cos": hc,
            "day_sin": ds,
            "day_cos": dc,
            "is_weekend": is_weekend(dow),
            "is_rush_hour": is_rush_hour(h),
            "PU_zone_frequency": F.coalesce(F.col("PU_zone_frequency"), F.lit(0.0)),
            "DO_zone_frequency": F.coalesce(F.col("DO_zone_frequency"), F.lit(0.0)),
            "route_frequency": F.coalesce(F.col("route_frequency"), F.lit(0.0)),
        }
        source = {"VendorID": F.col("__vendor"), "trip_type": F.col("__trip_type"),
                  "PU_Borough": F.col("PU_Borough"), "DO_Borough": F.col("DO_Borough")}
        for c in CATEGORICAL_FEATURE_COLUMNS:
            as_text = with_sentinel(source[c], FEATURE_MISSING)
            for cat in self.categories[c][1:]:
                values[f"{c}_{cat}"] = (as_text == F.lit(cat)).cast("int")
        out = out.select(*keep, *[values[n].alias(p) for n, p in zip(self.feature_names, self.physical_names())])
        vec = self.getOrDefault(self.featuresCol)
        if vec:
            from pyspark.ml.feature import VectorAssembler

            # every feature is null-free by construction (fills and 0/1 flags), so "error" never trips
            out = VectorAssembler(inputCols=self.physical_names(), outputCol=vec, handleInvalid="error").transform(out)
        return out

    def long_form(self, transformed: DataFrame, id_cols) -> DataFrame:
        """(ids..., feature, value): one row per feature, display names, doubles. A narrow Generate, no shuffle."""
        pairs = [F.struct(F.lit(n).alias("feature"), F.col(p).cast("double").alias("value"))
                 for n, p in zip(self.feature_names, self.physical_names())]
        return transformed.select(*id_cols, F.inline(F.array(*pairs)))

    def assert_no_nulls(self, transformed: DataFrame) -> None:
        """The learner rejects nulls: count nulls over all features in one aggregate."""
        physical = self.physical_names()
        row = transformed.agg(*[F.count_if(F.col(p).isNull()).alias(p) for p in physical]).first()
        bad = [n for n, p in zip(self.feature_names, physical) if row[p]]
        if bad:
            raise ValueError(f"null feature values in {bad}")

    # ------------------------------------------------------------ persistence
    def write(self) -> "TripFeaturesWriter":
        return TripFeaturesWriter(self)

    @classmethod
    def read(cls) -> "TripFeaturesReader":
        return TripFeaturesReader(cls)


#: What the fit learned beside the tables, stored with the parameters.
_FITTED = ("total_rows", "median_distance", "trip_type_fallback", "categories", "feature_names", "route_rows", "pu_rows", "do_rows")


class TripFeaturesWriter(MLWriter):
    """Parameters and fitted values as ML metadata, the fit summary and the zones as tables beside it, so the stage is
    saved and loaded as part of a ``PipelineModel``."""

    def __init__(self, instance: TripFeaturesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        model = self.instance
        fitted = {k: getattr(model, k) for k in _FITTED}
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession, extraMetadata={"fitted": fitted, "zone_rows": model.zones.rows})
        model.summary.write.mode("overwrite").parquet(f"{path}/summary")
        model.zones.df.write.mode("overwrite").parquet(f"{path}/zones")


class TripFeaturesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TripFeaturesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.summary = self.sparkSession.read.parquet(f"{path}/summary")
        model.zones = Dimension(self.sparkSession.read.parquet(f"{path}/zones"), rows=metadata["zone_rows"])
        for k in _FITTED:
            setattr(model, k, metadata["fitted"][k])
        return model
