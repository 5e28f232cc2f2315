import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isochron.operators import merge, shape
from isochron.sources import delimited, records, tables

DEMAND = ["Date;Heures;Périmètre;Consommation;Eolien", "01/07/2024;00:00;l’été;1 234,5;ND", "31/03/2024;02:30;France;7;1", ""]


@pytest.fixture
def files(tmp_path):
    (tmp_path / "Bretagne_encours_mensuel.csv").write_bytes("\n".join(DEMAND).encode("utf-8"))
    tabbed = "\n".join(DEMAND).replace(";", "\t")
    (tmp_path / "Île de France_encours_mensuel.xls").write_bytes(tabbed.encode("cp1252"))
    (tmp_path / "Occitanie.csv").write_text('"Date\tHeures\tPompage"\n"02/07/2024\t01:00\t3"\n"02/07/2024\t02:00\t4"\n')
    (tmp_path / "Corse.txt").write_bytes("Date|Heures|Solaire\n27.10.2024|02:30|-3\n28.10.2024|2:30|1,5\n".encode())
    return str(tmp_path)


def test_dialects(spark, files):
    found = {os.path.basename(r["path"])[:4]: (r["separator"], r["encoding"]) for r in delimited.dialects(spark, files).collect()}
    assert found == {"Bret": (";", "UTF-8"), "Île ": ("\t", "ISO-8859-1"), "Cors": ("|", "UTF-8"), "Occi": ("\t", "UTF-8")}


def test_demand_table(spark, files):
    found = delimited.demand_table(spark, files)
    assert found.columns[:4] == ["region", "date", "heure", "ts_local"]
    rows = {(r["region"], r["date"]): r for r in found.collect()}
    assert len(rows) == 7 and found.count() == 8
    assert rows["Occitanie", "02/07/2024"]["pompage_mw"] in (3.0, 4.0)
    july = rows["Île de France", "01/07/2024"]
    assert july["consommation_mw"] == 1234.5 and july["eolien_mw"] is None and july["perimetre"] == "l’été"
    assert july["solaire_mw"] is None and july["zip_name"] == "Île de France_encours_mensuel.xls"
    assert rows["Bretagne", "31/03/2024"]["ts_local"] == dt.datetime(2024, 3, 31, 3, 0)
    assert rows["Corse", "27.10.2024"]["ts_local"] is None
    assert rows["Corse", "28.10.2024"]["ts_local"] == dt.datetime(2024, 10, 28, 2, 30)
    assert rows["Corse", "28.10.2024"]["solaire_mw"] == 1.5


def test_unknown_headers_quotes_and_doubled_columns(spark, tmp_path):
    lines = ['Date;Heures;Weather  note;Eolien;Éolien;Weather note', '01/07/2024;00:00;"a;b ""c""";;5;', '02/07/2024;00:00;plain;4;5;second', '03/07/2024;01:00', ';;;;;']
    (tmp_path / "zip one").mkdir()
    (tmp_path / "zip one" / "x.csv").write_text("\ufeff" + "\n".join(lines))
    (tmp_path / "zip one" / "empty.csv").write_text("")
    found = {r["date"]: r for r in delimited.load(spark, str(tmp_path / "*"), archives=True).collect()}
    assert set(found) == {"01/07/2024", "02/07/2024", "03/07/2024", None}
    first, second, third = (found[f"0{i}/07/2024"] for i in (1, 2, 3))
    assert first["other"] == {"Weather note": 'a;b "c"'} and second["other"] == {"Weather note": "plain"} and third["other"] == {}
    assert (first["eolien_mw"], second["eolien_mw"], third["eolien_mw"]) == ("5", "4", None)
    assert third["heure"] == "01:00" and first["zip_name"] == "zip one" and first["zip_member"] == "x.csv" and first["region"] == "zip one"


def test_names_as_an_expression_equal_clean_names(spark):
    names = [" Date ", "\ufeffHeures", "Taux\u00a0de  Co2", "Éolien\u2003offshore", "x\ty", "", " free  text "]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(delimited.clean_name(F.col("n"))).collect()] == shape.clean_names(names)


@pytest.mark.parametrize("separator", delimited.DELIMITERS)
def test_cells_equal_the_csv_module(spark, separator):
    import csv

    lines = ["a,b", "", "|;,\t", '"x|;,\ty"|1;2,3\t4', '"say ""hi""",a;b|c\td', "a||;;,,\t\tb", "é;漢|ü,\t"]
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    found = [r[0] for r in df.select(delimited.cells(F.col("t"), F.lit(separator))).collect()]
    for line, got in zip(lines, found, strict=True):
        expected = next(csv.reader([line], delimiter=separator), []) or [""]
        assert got == [c or None for c in expected]


def test_the_plan_does_not_grow_with_layouts(spark, files, tmp_path):
    one = str(tmp_path / "one")
    os.mkdir(one)
    with open(f"{one}/x.csv", "w") as out:
        out.write("Date;Heures\n1;2\n")

    def nodes(path):
        return delimited.load(spark, path)._jdf.queryExecution().analyzed().toString().count("\n")

    assert nodes(one) == nodes(files)


def test_timestamps_are_recovered_row_by_row(spark):
    t = dt.datetime(2024, 3, 31, 0, 30)
    rows = [
        (t, t + dt.timedelta(hours=5), None, None, None), (None, t, t, None, None), (None, None, dt.datetime(2024, 7, 1, 2), None, None),
        (None, None, dt.datetime(2024, 10, 27, 2, 30), "2024-01-01", None), (None, None, None, "2024-01-02 03:04:05", 1), (None, None, None, "junk", 1704067200000),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "ts_hour_utc timestamp, ts_utc timestamp, ts_paris timestamp, day_date string, at_time bigint")
    found = [r["ts_utc"] for r in merge.recover_timestamps(df, overlap="null").collect()]
    assert found == [t, t, dt.datetime(2024, 7, 1, 0), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 1), None]
    only = merge.recover_timestamps(df.select("day_date"), stamp=F.lit("2000-01-01").cast("timestamp")).collect()
    assert [r["ts_utc"] for r in only][3:] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1)]
    assert only[3]["ts_paris"] == dt.datetime(2024, 1, 1, 1)
    assert merge.recover_timestamps(spark.range(1)).first()["ts_utc"] is None


def test_headers_and_packed_columns(spark):
    df = spark.createDataFrame([("1\t2", "x")], T.StructType.fromDDL("`Date\tSolaire` string, ` Éolien  offshore ` string"))
    found = shape.clean_headers(shape.split_all_packed(df))
    assert found.columns == ["eolien_offshore_mw", "date", "solaire_mw"]
    assert tuple(found.first()) == ("x", "1", "2")


def test_with_defaults_and_observed(spark):
    df = spark.createDataFrame([(1, None), (2, 2.0)], "a int, b double")
    full = shape.with_defaults(df, T.StructType.fromDDL("a int, c double"), 0)
    assert full.columns == ["a", "b", "c"] and full.first()["c"] == 0.0
    counted, observation = shape.observed(df, "probe", "b")
    counted.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 2, "b_nulls": 1}


def test_flatten_records(spark):
    payloads = [json.dumps(p) for p in (
        {"results": [{"k": 1}, {"k": 2}]}, {"records": [{"fields": {"k": 3}}]}, {"results": [], "records": [{"k": 4}]}, {"x": 1})]
    df = spark.createDataFrame(list(enumerate([*payloads, None, "junk"])), "i int, p string")
    assert sorted(tuple(r) for r in records.flatten_records(df, "p", "k bigint").collect()) == [(0, 1), (0, 2), (1, 3), (2, 4)]


def test_expand_series_is_end_exclusive(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, t + dt.timedelta(hours=3), 3600, [1.0, 2.0, 3.0]), ("b", t, t, 3600, []), ("c", t, t + dt.timedelta(hours=1), 1800, [5.0, 6.0])]
    df = spark.createDataFrame(rows, "city string, t0 timestamp, t1 timestamp, step int, v array<double>")
    found = records.expand_series(df, "t0", "t1", "step", ["v"]).orderBy("city", "ts_utc").collect()
    assert [(r["city"], r["v"], (r["ts_utc"] - t).seconds) for r in found] == [
        ("a", 1.0, 0), ("a", 2.0, 3600), ("a", 3.0, 7200), ("c", 5.0, 0), ("c", 6.0, 1800)]


def test_section_links(spark):
    html = """<h1>x</h1><section data-level="1"><h2 class="h1 title"><a href="r"> Bretagne </a></h2>
      <ul class="x list-disc"><li><div><a href="1"><b>Brest</b></a></div></li><li><div><a>Rennes</a></div></li></ul>
      <ul><li><a>Not a city</a></li></ul></section>
      <section class="s" data-level="1"><h2 class="h1"><a>Corse</a></h2><ul><li><a>Ajaccio</a></li><li><a>Ajaccio</a></li></ul></section>"""
    df = spark.createDataFrame([(html, "host"), ("<ul><li><a>Plain</a></li></ul>", "host")], "html string, host string")
    found = sorted(tuple(r) for r in records.section_links(df, "html", F.col("host")).collect())
    assert found == [("Bretagne", "Brest"), ("Bretagne", "Rennes"), ("Corse", "Ajaccio"), ("host", "Plain")]


def test_city_records(spark):
    rows = [("1", "A", "fr", "tz", "10", '{"lat":1,"lon":2}'), ("1", "B", "FR", "tz", "20", "[2,1]"),
            ("2", "C", "de", "tz", "5", "[2,1]"), ("3", "D", "FR", "tz", None, "junk")]
    df = spark.createDataFrame(rows, "geoname_id string, name string, country_code string, timezone string, population string, coordinates string")
    found = records.city_records(df)
    assert [tuple(r)[:2] for r in found.collect()] == [("1", "B")]
    assert records.largest_cities(found, 5).count() == 1


def test_optional_table(spark, tmp_path):
    assert tables.scan_optional(spark, str(tmp_path / "none")) is None
    tables.write_table(spark.range(3), str(tmp_path / "t"))
    assert tables.scan_optional(spark, str(tmp_path / "t")).count() == 3
    assert tables.scan(spark, str(tmp_path / "t"), "id bigint", legacy_calendar=True).count() == 3


def test_catalog_table(spark, tmp_path):
    tables.write_table(spark.range(4), str(tmp_path / "t"), "isochron_test_table")
    assert tables.catalog_table(spark, "isochron_test_table").count() == 4
    spark.sql("DROP TABLE isochron_test_table")


def test_partitioned_write_is_idempotent_and_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(100).select("id", F.when(F.col("id") < 90, "a").otherwise("b").alias("region_clean"))
    tables.write_partitioned(rows, path)
    tables.write_partitioned(rows.where("region_clean = 'a'"), path)
    assert {r[0]: r[1] for r in spark.read.parquet(path).groupBy("region_clean").count().collect()} == {"a": 90, "b": 10}
    assert len([f for f in os.listdir(os.path.join(path, "region_clean=a")) if f.endswith(".parquet")]) <= 8


def test_append_run_replaces_a_repeated_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, n in (("r1", 2), ("r2", 3), ("r1", 4)):
        tables.append_run(spark.range(n), path, run)
    assert {r[0]: r[1] for r in spark.read.parquet(path).groupBy("run_ts").count().collect()} == {"r1": 4, "r2": 3}


def test_sample(spark, tmp_path):
    tables.write_sample(spark.range(500), str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 100


def test_incremental_read_takes_only_new_files(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    schema = "id bigint"
    for size, total in ((3, 3), (0, 3), (4, 7)):
        if size:
            spark.range(size).coalesce(1).write.mode("append").parquet(source)
        assert tables.drain_new_files(spark, source, schema, target, checkpoint).count() == total


def test_merges(spark):
    left = spark.createDataFrame([(1, "l1", 0), (2, "l2", 0), (None, "l3", 0)], "k int, a string, c int")
    right = spark.createDataFrame([(1, 5, 9), (1, 4, 8), (3, 1, 7)], "k int, b int, c int")
    merged = merge.merge_unique(left, right, ["k"], F.col("b"))
    assert merged.columns == ["k", "a", "c", "b", "c_right"]
    assert {(r["a"], r["b"], r["c_right"]) for r in merged.collect()} == {("l1", 4, 8), ("l2", None, None), ("l3", None, None)}
    assert merge.merge_first_match(left, right, [["z"]], ["b"]) is left
    assert merge.merge_metrics(left, right, ["k"]).first()["right_duplicates"] == 1


def test_number_rows(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    found = merge.number_rows(rows, ["v"], "n").collect()
    assert len(found) == 1000 and all(r["v"] == r["n"] for r in found)


def test_no_machine_local_folder_on_a_cluster():
    import pytest

    from isochron.session import own_folder

    assert own_folder("local[4]") and own_folder("local")
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
            own_folder(master)
