import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from isochron.functions import buckets, clock, numeric, text
from isochron.operators import regions


def column(spark, values, kind, build):
    """build(v) for each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_decimal_comma(spark):
    values = ["1 234,5", "1 234,5", "1 234,5", "ND", "-", "", None, "-3", "1e3"]
    assert column(spark, values, "string", numeric.decimal_comma) == [1234.5, 1234.5, 1234.5, None, None, None, None, -3, 1000]


def test_number_or_zero(spark):
    assert column(spark, ["1.5", "x", None], "string", numeric.number_or_zero) == [1.5, 0.0, 0.0]


def test_canonicalize(spark):
    values = [None, "", "nan", "NaN", "Île-de-France", "Provence-Alpes-Côte d'Azur", "été", "œuvre", "a_b.c,(d)/\\e"]
    expected = ["", "", "", "", "ile de france", "provence alpes cote d azur", "ete", "œuvre", "a b c d e"]
    assert column(spark, values, "string", text.canonicalize) == expected


def test_strip_accents_expands_ligatures(spark):
    assert column(spark, ["ﬁn ½ Ŀ", "plain", "ÀÉ"], "string", text.strip_accents) == ["fin 1⁄2 L·", "plain", "AE"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aéÎ'’-_.,()/\\ ßœ\tZ9", max_size=12), min_size=30, max_size=60))
def test_canonicalize_is_idempotent(spark, values):
    once = column(spark, values, "string", text.canonicalize)
    assert column(spark, once, "string", text.canonicalize) == once


def test_normalize_city(spark):
    values = ["St Etienne", "Ste Marie", "Mont St Michel", "L'Haÿ-les-Roses", "Paris 15", None, "Best"]
    expected = ["saint etienne", "sainte marie", "mont saint michel", "l hay-les-roses", "paris", "", "best"]
    assert column(spark, values, "string", text.normalize_city) == expected


def test_parse_list(spark):
    values = ["['a', 'b']", "a, b,,c", "", None, "['a'"]
    found = column(spark, values, "string", text.parse_list)
    assert found[:4] == [["a", "b"], ["a", "b", "c"], [], []]
    assert found[4] in (["['a'"], ["a"])


def test_regions(spark):
    values = [None, "PACA", "Rhone-Alpe", "Guadeloupe", "Île-de-France", "Unknownland", "Picardie", ""]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, region string")
    found = regions.add_regions(rows).orderBy("i").select("region_canon", "region_clean").collect()
    assert [r[0] for r in found] == [
        None, "provence alpes cote d azur", "auvergne rhone alpes", None, "ile de france", "unknownland", "hauts de france", ""]
    assert [r[1] for r in found][:3] == [None, "Provence-Alpes-Cote d'Azur", "Rhone-Alpe"]


def test_harmonize(spark):
    values = ["paca", "Pays de Loire", "Provence–Alpes", "Grand Est", "Unknownland", "", None, "Île-de-France", "Occitanie!"]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, region_clean string")
    found = [r[0] for r in regions.harmonize(rows).orderBy("i").select("region_clean").collect()]
    paca = "Provence-Alpes-Côte d'Azur"
    assert found == [paca, "Pays-de-la-Loire", "Provence–Alpes", "Grand-Est", "Unknownland", None, None, "Île-de-France", "Occitanie"]


def test_local_to_utc_at_the_clock_changes(spark):
    values = [("2024-03-31", "02:30"), ("2024-10-27", "02:30"), ("2024-07-01", "00:00"), ("2024-07-01", "24:00"), (None, "01:00")]
    rows = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, d string, h string")
    wall = clock.parse_local(F.col("d"), F.col("h"))
    policies = ["earliest", "latest", "null"]
    found = rows.orderBy("i").select(*[
        F.date_format(clock.local_to_utc(wall, overlap=p), "MM-dd HH:mm").alias(p) for p in policies]).collect()
    assert [r["earliest"] for r in found] == ["03-31 01:00", "10-27 00:30", "06-30 22:00", None, None]
    assert found[1]["latest"] == "10-27 01:30" and found[1]["null"] is None


def test_epoch_nanoseconds_are_exact(spark):
    found = column(spark, [1704067200123456789], "bigint", lambda v: clock.epoch_ns_to_timestamp(v).cast("string"))
    assert found == ["2024-01-01 00:00:00.123456"]


def test_easter(spark):
    known = {1995: (4, 16), 2000: (4, 23), 2024: (3, 31), 2025: (4, 20), 1961: (4, 2), 2038: (4, 25), 1954: (4, 18), 2049: (4, 18)}
    assert column(spark, list(known), "int", clock.easter) == [dt.date(y, *md) for y, md in known.items()]


@pytest.mark.parametrize("build, values, expected", [
    (buckets.temperature_category, [-0.1, 0.0, 10.0, 20.0, 30.0, None], ["very_cold", "cold", "cool", "warm", "hot", None]),
    (buckets.precipitation_category, [0.0, 1.0, 5.0, 5.1, None], ["dry", "drizzle", "light_rain", "heavy_rain", None]),
    (buckets.wind_category, [15.0, 30.0, 30.1, None], ["light_wind", "moderate_wind", "strong_wind", None]),
    (buckets.weather_severity, [-1.0, 30.0, 30.1, None], ["cold", "moderate", "hot", None]),
    (buckets.performance_rating, [99.0, 100.0, 999.0, 1000.0, None], ["Excellent", "Good", "Fair", "Poor", "Unrated"]),
])
def test_buckets(spark, build, values, expected):
    assert column(spark, values, "double", build) == expected


def test_coordinates(spark):
    values = ['{"lat":1,"lon":2}', '{"latitude":1,"longitude":2}', "[2,1]", "POINT (2 1)", "point(2 1)", "junk", None]
    lat = column(spark, values, "string", lambda v: numeric.coordinates(v)[0])
    lon = column(spark, values, "string", lambda v: numeric.coordinates(v)[1])
    assert lat == [1.0] * 5 + [None] * 2 and lon == [2.0] * 5 + [None] * 2


def test_accents_of_every_block(spark):
    import unicodedata

    samples = [chr(c) for c in (
        0xE9, 0x1EA5, 0x212B, 0x2460, 0x3300, 0x3392, 0xF900, 0xFB01, 0xFB1D, 0xFDFA, 0xFE8D, 0xFF21, 0xFF76, 0x1D400, 0x1D7D8, 0x1EE00, 0x1F130, 0x2F800
    )]
    rows = [(f"a{c}b",) for c in samples] + [("plain",), (None,), ("각",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(text.strip_accents(F.col("t"))).collect()]
    want = ["a" + "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) + "b" for c in samples]
    assert got == [*want, "plain", None, "각"]
