import datetime as dt

from isochron.operators import star

HOUR = dt.datetime(2024, 1, 1)


def test_cumulative_types_that_do_not_occur_add_no_rows(spark):
    weather = spark.createDataFrame(
        [("a", HOUR, 5.0, 0.0, 10.0), ("b", HOUR, -3.0, 0.0, 10.0), ("c", HOUR, 25.0, 0.0, 10.0), ("d", HOUR, 5.0, 3.0, 10.0), ("e", HOUR, None, 0.0, 10.0)],
        "region_clean string, ts_utc timestamp, temp_c double, precip_mm double, wind_kph double",
    )
    types = spark.createDataFrame(
        [("1", "very_cold", "dry", "light_wind"), ("2", "cold", "dry", "light_wind"), ("3", "cool", "dry", "light_wind")],
        ["weather_type_id", *star.WEATHER_CATEGORIES],
    )
    found = star.with_weather_type(weather, types, cumulative=True)
    assert found.columns == [*weather.columns, "weather_type_id"]
    # One row for each type that fits; of a row that fits none, one with a null type.
    assert sorted((r["region_clean"], r["weather_type_id"] or "") for r in found.collect()) == [
        ("a", "2"), ("a", "3"), ("b", "1"), ("b", "2"), ("b", "3"), ("c", ""), ("d", ""), ("e", "")]
