import pytest
from pyspark.sql import functions as F

from conftest import ts
from tripflow.operators.prepare import prepare_training_data
from tripflow.plans.features import BASE_FEATURES, TripFeatures


@pytest.fixture()
def fitted(spark, zones, labelled):
    train = prepare_training_data(labelled)
    return TripFeatures(zones=zones).fit(train), train


def test_fit_needs_target(spark, zones, labelled):
    with pytest.raises(ValueError, match="target"):
        TripFeatures(zones=zones).fit(prepare_training_data(labelled).drop("duration"))


def test_fitted_state(fitted):
    m, train = fitted
    assert m.total_rows == 6
    assert m.trip_type_fallback == 1.0  # mode, nulls ignored
    assert m.categories["VendorID"] == ["1", "2"]
    assert m.categories["trip_type"] == ["1.0", "2.0", "__missing__"]
    assert m.categories["DO_Borough"] == ["Brooklyn", "Manhattan", "Queens", "__missing__"]
    assert m.feature_names[: len(BASE_FEATURES)] == BASE_FEATURES
    # first category dropped; the always-zero missing trip-type column is kept for schema parity
    assert "VendorID_1" not in m.feature_names and "VendorID_2" in m.feature_names
    assert "trip_type___missing__" in m.feature_names


def test_frequencies_sum_to_one(fitted):
    m, _ = fitted
    for t in (m.route_frequency_table(), m.zone_frequency_table("PU"), m.zone_frequency_table("DO")):
        col = [c for c in t.columns if c.endswith("frequency")][0]
        assert abs(t.agg(F.sum(col)).first()[0] - 1.0) < 1e-12


def test_median_of_positive_distances_and_fallback(spark, zones, labelled):
    m = TripFeatures(zones=zones).fit(prepare_training_data(labelled))
    # distances: 1-2, 2-3, 1-3, 3-1 are positive; 2-2 is zero (excluded); 3-99 unknown (null)
    assert m.median_distance > 0
    same_zone = labelled.withColumn("DOLocationID", F.col("PULocationID"))
    m0 = TripFeatures(zones=zones).fit(prepare_training_data(same_zone))
    assert m0.median_distance == 1.0


def test_unseen_row_has_same_columns(spark, fitted):
    m, _ = fitted
    row = spark.createDataFrame([(99, ts("2026-02-04 08:00:00"), 1, 3, None, None)],
                                "VendorID bigint, lpep_pickup_datetime timestamp_ntz, PULocationID bigint, "
                                "DOLocationID bigint, passenger_count double, trip_type double")
    out = m.transform(row)
    assert out.columns == m.physical_names()
    r = out.first().asDict()
    assert r["passenger_count"] == 1.0
    assert r["VendorID_2"] == 0  # unseen vendor encodes like the dropped first category
    assert r["trip_type___missing__"] == 0
    assert r["same_borough"] == 0 and r["is_rush_hour"] == 1
    assert abs(r["route_frequency"] - 1 / 6) < 1e-12  # route 1->3 is seen once among six train rows
    assert "historical_avg_speed" not in out.columns


def test_optional_inputs_absent_get_defaults(spark, fitted):
    m, _ = fitted
    row = spark.createDataFrame([(1, "2026-02-04 08:00:00", 1, 2)],
                                "VendorID bigint, lpep_pickup_datetime string, PULocationID bigint, DOLocationID bigint")
    r = m.transform(row).first().asDict()
    assert r["passenger_count"] == 1.0 and r["trip_type_2_0"] == 0


def test_no_null_features_on_train(fitted):
    m, train = fitted
    m.assert_no_nulls(m.transform(train))


def test_train_only_fit(spark, zones, labelled):
    train = prepare_training_data(labelled)
    a = TripFeatures(zones=zones).fit(train)
    b = TripFeatures(zones=zones).fit(train.repartition(3))
    assert (a.median_distance, a.trip_type_fallback, a.categories) == (b.median_distance, b.trip_type_fallback, b.categories)


def test_mode_tie_takes_lowest_and_all_null_falls_back(spark, zones, labelled):
    tie = labelled.withColumn("trip_type", F.when(F.col("VendorID") == 1, 2.0).otherwise(1.0))  # 3 vs 3
    assert TripFeatures(zones=zones).fit(prepare_training_data(tie)).trip_type_fallback == 1.0
    none = labelled.withColumn("trip_type", F.lit(None).cast("double"))
    m = TripFeatures(zones=zones).fit(prepare_training_data(none))
    assert m.trip_type_fallback == 1.0 and m.categories["trip_type"] == ["__missing__"]


def test_unknown_zones_give_zero_same_borough(spark, fitted):
    m, _ = fitted
    row = spark.createDataFrame([(1, ts("2026-02-04 12:00:00"), 98, 97, 1.0, 1.0)],  # zones never seen
                                "VendorID bigint, lpep_pickup_datetime timestamp_ntz, PULocationID bigint, "
                                "DOLocationID bigint, passenger_count double, trip_type double")
    r = m.transform(row).first().asDict()
    assert r["same_borough"] == 0 and r["estimated_distance_miles"] == m.median_distance
    assert r["PU_zone_frequency"] == 0.0 and r["DO_zone_frequency"] == 0.0


def test_physical_names_are_injective():
    from tripflow.functions.columns import safe_names

    names = ["A B", "A-B", "a b", "A_B", "plain"]
    out = safe_names(names)
    assert len({n.lower() for n in out}) == len(names) and out[-1] == "plain"
