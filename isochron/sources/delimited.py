"""Delimited text of unknown dialect: detection per file as a Spark aggregation, then one scan in which each line is parsed by its file's layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.fixed_values import HEADER_SYNONYMS
from isochron.functions.binding import literal
from isochron.functions.clock import local_to_utc, parse_local_day_first, utc_to_local
from isochron.functions.numeric import coerce_numeric
from isochron.operators.shape import lead_with
from isochron.session import stored

# Delimiters in order of preference, and the encodings of valid and invalid UTF-8 files.
DELIMITERS = ["\t", ";", "|", ","]
ENCODINGS = ("UTF-8", "ISO-8859-1")
# Columns of a loaded table: what known header spellings stand for.
KNOWN = list(dict.fromkeys(HEADER_SYNONYMS.values()))
# Windows files read as Latin-1 hold control codes where code page 1252 has letters and quotes.
CONTROLS = "".join(map(chr, range(0x80, 0xA0)))
WINDOWS = bytes(range(0x80, 0xA0)).decode("cp1252", errors="replace")


def dialects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, separator, encoding) per file, whatever the file's extension.

    Lines are scanned where they lie and counted per file with map-side combine: no file passes through one task. The
    separator is the first one that stands in the header and splits most lines into as many fields as the header.
    """
    lines = spark.read.text(paths).select(_path(), "value")
    counts = {f"n{i}": F.regexp_count("value", F.lit(_escaped(d))) for i, d in enumerate(DELIMITERS)}
    counted = lines.where(F.trim("value") != "").withColumns(counts)
    per_width = counted.groupBy("path", *counts).agg(
        F.count("*").alias("lines"), F.bool_and(F.is_valid_utf8("value")).alias("utf8")
    )
    pairs = F.array(*[F.struct(F.lit(i).alias("rank"), F.col(f"n{i}").alias("width")) for i in range(len(DELIMITERS))])
    widths = per_width.select("path", "lines", "utf8", F.explode(pairs).alias("d")).groupBy("path", "d.rank", "d.width").agg(
        F.sum("lines").alias("lines"), F.bool_and("utf8").alias("utf8")
    )
    utf8 = F.bool_and("utf8").alias("utf8")
    # Share of lines with the commonest non-zero width, rounded so that near-perfect separators go by preference.
    best = widths.groupBy("path", "rank").agg(
        F.max(F.when(F.col("width") > 0, F.col("lines"))).alias("agreeing"), F.sum("lines").alias("all"), utf8
    ).groupBy("path").agg(
        F.max_by("rank", F.when(F.col("agreeing").isNotNull(),
                                F.struct(F.round(F.col("agreeing") / F.col("all"), 1), -F.col("rank")))).alias("rank"), utf8,
    )
    separators = F.array(*map(F.lit, DELIMITERS))
    return best.select(
        "path", F.coalesce(F.get(separators, F.col("rank")), F.lit(",")).alias("separator"),
        F.when(F.col("utf8"), ENCODINGS[0]).otherwise(ENCODINGS[1]).alias("encoding"),
    )


def _path() -> Column:
    """The path of a row's file as readers take it: the metadata column holds it URL-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path")


def _escaped(delimiter: str) -> str:
    return "\\" + delimiter if delimiter == "|" else delimiter


def region_of(file_name: Column) -> Column:
    """The region in a file name: what stands before '_encours_mensuel', else the name without extension."""
    return F.regexp_extract(file_name, r"^(.*?)(?:_encours_mensuel.*|\.[^.]*)?$", 1)


def _decoded(text: Column, encoding: Column) -> Column:
    """Text of a file that is not UTF-8, from its bytes."""
    latin = F.translate(F.decode(text.cast("binary"), ENCODINGS[1]), CONTROLS, WINDOWS)
    return F.when(encoding == ENCODINGS[1], latin).otherwise(text)


def cells(text: Column, separator: Column) -> Column:
    """The cells of a line; an empty cell is null. A cell in quotes may hold separators, and a doubled quote stands for one.

    Each of the known separators has a pattern that consumes the separator before a cell, so lines are cut in one pass.
    """
    found = F.array().cast("array<string>")
    for d in DELIMITERS:
        pattern = f'{_escaped(d)}("[^"]*+(?:""[^"]*+)*+"[^{_escaped(d)}]*+|[^{_escaped(d)}]*+)'
        found = F.when(separator == d, F.regexp_extract_all(F.concat(F.lit(d), text), F.lit(pattern), F.lit(1))).otherwise(found)
    quoted = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'
    bare = F.transform(found, lambda c: F.when(F.rlike(c, F.lit(quoted)), F.concat(
        F.replace(F.regexp_extract(c, quoted, 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, quoted, 2)
    )).otherwise(c))
    return F.transform(bare, lambda c: F.when(c != "", c))


def clean_name(name: Column) -> Column:
    """clean_names as an expression: white space around and within a name, byte order mark, known spellings."""
    spaced = F.regexp_replace(F.regexp_replace(name, "^\ufeff", ""), r"(?U)[\s&&[^\t]]+", " ")
    trimmed = F.regexp_replace(spaced, r"(?U)^\s+|\s+$", "")
    return F.coalesce(F.element_at(literal(HEADER_SYNONYMS, "map<string, string>"), trimmed), trimmed)


def layouts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per file: path, separator, encoding, head (its first line), places and others.

    A place is (cell, part): the cell's number in a line, and the part of it where a header name is packed with tabs, else null. `places` maps a
    known column to its places in order; `others` holds the other names of the header with theirs.
    """
    lines = spark.read.text(paths).select(_path(), "value", F.col("_metadata.file_block_start").alias("start"))
    placed = lines.withColumn("at", F.monotonically_increasing_id()).where(F.trim("value") != "")
    heads = placed.groupBy("path").agg(F.min_by("value", F.struct("start", "at")).alias("head"))
    files = dialects(spark, paths).join(heads, "path").withColumn("head", _decoded(F.col("head"), F.col("encoding")))

    def parts(cell: Column, i: Column) -> Column:
        packed = F.contains(cell, F.lit("\t"))
        return F.transform(F.split(F.coalesce(cell, F.lit("")), "\t"), lambda part, j: F.struct(
            clean_name(part).alias("name"), F.struct(i.alias("cell"), F.when(packed, j).alias("part")).alias("place")
        ))

    fields = F.filter(F.flatten(F.transform(cells(F.col("head"), F.col("separator")), parts)), lambda f: f["name"] != "")
    named = files.withColumn("_fields", fields)
    known = literal(KNOWN, "array<string>")
    own = F.array_distinct(F.transform("_fields", lambda f: f["name"]))
    places = F.map_from_entries(F.transform(F.array_intersect(own, known), lambda name: F.struct(
        name, F.transform(F.filter("_fields", lambda f: f["name"] == name), lambda f: f["place"])
    )))
    others = F.filter("_fields", lambda f: ~F.array_contains(known, f["name"]))
    return named.select("path", "separator", "encoding", "head", places.alias("places"), others.alias("others"))


def _cell(line: Column, place: Column) -> Column:
    whole = F.get(line, place["cell"])
    return F.when(place["part"].isNull(), whole).otherwise(F.nullif(F.get(F.split(whole, "\t"), place["part"]), F.lit("")))


def _first(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def load(spark: SparkSession, paths: str | list[str], archives: bool = False) -> DataFrame:
    """All files as one table of texts: region, the known columns, `other` (a map of all further headers), zip_member and zip_name.

    Layouts are rows, not plans: a line meets its file's layout in a join, is cut by its separator, and each column looks its cells up in
    the layout's map. So the plan is the same for any number of layouts and files, and nothing comes to the driver. Of several headers
    that mean the same column the first with a value counts. With `archives` files lie in folders that carry their archives' names, and those give
    zip_name and the region.
    """
    files = stored(layouts(spark, paths), "file-layouts")
    lines = spark.read.text(paths).select(_path(), "value").join(files, "path").withColumn("text", _decoded(F.col("value"), F.col("encoding")))
    lines = lines.where((F.trim("text") != "") & (F.col("text") != F.col("head")))
    cut = lines.withColumn("_line", cells(F.col("text"), F.col("separator")))
    line = F.col("_line")

    def column(name: str) -> Column:
        return _first(F.transform(F.element_at("places", F.lit(name)), lambda place: _cell(line, place))).alias(name)

    given = F.filter(F.transform("others", lambda f: F.struct(f["name"].alias("key"), _cell(line, f["place"]).alias("value"))), lambda e: e["value"].isNotNull())
    names = F.array_distinct(F.transform(given, lambda e: e["key"]))
    other = F.map_from_entries(F.transform(names, lambda n: F.struct(n, _first(F.transform(F.filter(given, lambda e: e["key"] == n), lambda e: e["value"])))))
    parts = F.split("path", "/")
    member, archive = F.element_at(parts, -1), F.element_at(parts, -2 if archives else -1)
    return cut.select(
        region_of(archive).alias("region"), *[column(name) for name in KNOWN], other.alias("other"),
        member.alias("zip_member"), archive.alias("zip_name"),
    )


def add_local_timestamp(df: DataFrame) -> DataFrame:
    """ts_local from date and heure: gap times move forward, ambiguous times are null."""
    if not {"date", "heure"} <= set(df.columns):
        return df
    instant = local_to_utc(parse_local_day_first(F.col("date"), F.col("heure")), overlap="null")
    return df.withColumn("ts_local", utc_to_local(instant))


def demand_table(spark: SparkSession, paths: str | list[str], archives: bool = False) -> DataFrame:
    """Loaded files with clean headers, timestamps, numeric measures and leading columns first."""
    return lead_with(coerce_numeric(add_local_timestamp(load(spark, paths, archives))))
