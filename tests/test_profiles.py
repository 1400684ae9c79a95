import json

import pytest
from pyspark.sql import functions as F

from kerbstream.functions import traffic_factor
from kerbstream.operators import expected_vs_observed, parse_profiles, with_profiles
from kerbstream.plans.event_view import PROFILES, profile_documents, readings_view, sensor_name
from kerbstream.sources import read_profiles

from helpers import READING, final_plan, rows


def test_profile_file(spark, tmp_path):
    path = tmp_path / "profiles.json"
    path.write_text(json.dumps(
        {"Quay": {"base_volume": 77, "base_speed": 31},
         "Mill": {"base_volume": 12, "base_speed": 58}}, indent=2))
    assert rows(read_profiles(spark, str(path))) == [("Mill", 12, 58), ("Quay", 77, 31)]


@pytest.mark.parametrize("partitions", [1, 5])
@pytest.mark.parametrize("first, second", [("a.json", "b.json"), ("b.json", "a.json")])
def test_the_file_that_sorts_last_counts(spark, tmp_path, changed_conf, first, second, partitions):
    changed_conf("spark.sql.shuffle.partitions", str(partitions))
    changed_conf("spark.sql.files.openCostInBytes", "128MB" if partitions > 1 else "1KB")
    old = {"s": {"base_volume": 1, "base_speed": 2}, "only": {"base_volume": 5, "base_speed": 6}}
    new = {"x": {"base_volume": 7, "base_speed": 8}, "s": {"base_volume": 3, "base_speed": 4}}
    for name in (first, second):
        (tmp_path / name).write_text(json.dumps(new if name == "b.json" else old))
    assert rows(read_profiles(spark, str(tmp_path))) == [
        ("only", 5, 6), ("s", 3, 4), ("x", 7, 8)]


def test_documents_without_an_order_must_not_disagree(spark):
    texts = ['{"a": {"base_volume": 1, "base_speed": 2}}',
             '{"a": {"base_volume": 1, "base_speed": 3}}', '{"b": {"base_volume": 1}}']
    documents = spark.createDataFrame([(t,) for t in texts], "value string")
    with pytest.raises(Exception, match="several documents have a profile of a"):
        parse_profiles(documents).collect()
    same = spark.createDataFrame([(texts[0],), (texts[0],), (texts[2],)], "value string")
    assert rows(parse_profiles(same)) == [("a", 1, 2), ("b", 1, None)]


def test_profile_document(spark):
    got = rows(parse_profiles(profile_documents(spark)))
    assert got == [(sensor_name(i), *pair) for i, pair in enumerate(PROFILES)]


def test_a_sensor_named_twice_has_one_profile(spark):
    text = ('{"a": {"base_volume": 1, "base_speed": 2}, "b": {"base_volume": 9}, '
            '"a": {"base_volume": 3, "base_speed": 4}}')
    documents = spark.createDataFrame([(text,)], "value string")
    assert rows(parse_profiles(documents)) == [("a", 3, 4), ("b", 9, None)]


@pytest.mark.parametrize("text", ["broken", '{"a": 5}'])
def test_a_broken_profile_document_is_an_error(spark, text):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse_profiles(spark.createDataFrame([(text,)], "value string")).collect()


def test_bands(spark):
    hours = spark.range(24).select(
        F.col("id").cast("int").alias("h"),
        F.make_timestamp(F.lit(2026), F.lit(2), F.lit(20), "id", F.lit(59), F.lit(59)).alias("t"))
    got = {r.h: r.f for r in hours.select("h", traffic_factor("t").alias("f")).collect()}
    expected = dict.fromkeys(range(24), 1.0)
    expected.update(dict.fromkeys((7, 8, 9), 2.2))
    expected.update(dict.fromkeys((12, 13, 14), 1.5))
    expected.update(dict.fromkeys((17, 18, 19), 2.5))
    expected.update(dict.fromkeys((22, 23, 0, 1, 2, 3, 4, 5), 0.5))
    assert got == expected


def test_expected_and_scores(spark, at):
    readings = spark.createDataFrame([("junction-000", at("08:00:00"), 250, 12.0)], READING)
    row = expected_vs_observed(readings, parse_profiles(profile_documents(spark))).first()
    volume, speed = PROFILES[0]
    assert row.expected_volume == pytest.approx(volume * 2.2)
    assert row.expected_speed == pytest.approx(speed / 2.2)
    assert row.volume_z == pytest.approx((250 - volume * 2.2) / (volume * 0.15))
    assert row.speed_z == pytest.approx((12 - speed / 2.2) / 3)


def test_sensor_without_a_profile_keeps_its_readings(spark, events):
    readings = readings_view(events)
    known = parse_profiles(profile_documents(spark)).filter("sensor_id <> 'junction-015'")
    compared = expected_vs_observed(readings, known)
    assert compared.count() == readings.count()
    missing = compared.filter("sensor_id = 'junction-015'")
    assert missing.count() == readings.filter("sensor_id = 'junction-015'").count()
    assert missing.filter("expected_volume is not null or speed_z is not null").count() == 0


def test_zero_base_volume_gives_null(spark, at):
    readings = spark.createDataFrame([("a", at("08:00:00"), 1, 1.0)], READING)
    profiles = spark.createDataFrame(
        [("a", 0, 30)], "sensor_id string, base_volume int, base_speed int")
    assert expected_vs_observed(readings, profiles).first()["volume_z"] is None


def test_spark_broadcasts_by_size(spark, events, changed_conf):
    readings = readings_view(events)
    profiles = parse_profiles(profile_documents(spark))
    small = with_profiles(readings, profiles)
    assert "BroadcastHashJoin" in final_plan(small)
    found = rows(small)
    changed_conf("spark.sql.autoBroadcastJoinThreshold", "10")
    large = with_profiles(readings, profiles)
    assert "SortMergeJoin" in final_plan(large)
    assert rows(large) == found


def test_hot_sensor_of_a_large_join_is_split(spark, changed_conf):
    changed_conf("spark.sql.autoBroadcastJoinThreshold", "10")
    changed_conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    changed_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    changed_conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    changed_conf("spark.sql.shuffle.partitions", "16")
    readings = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("s"), (F.col("id") % 500).cast("string"))).alias("sensor_id"),
        F.timestamp_seconds("id").alias("timestamp"), F.lit(1).alias("vehicle_count"),
        F.col("id").cast("double").alias("avg_speed"))
    profiles = readings.select("sensor_id").distinct().select(
        "sensor_id", F.lit(10).alias("base_volume"), F.lit(5).alias("base_speed"))
    joined = with_profiles(readings, profiles)
    assert "skew=true" in final_plan(joined)
    assert joined.filter("base_volume = 10").count() == 60000
