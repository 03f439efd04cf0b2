"""Text formats as tables (S10-S15). Lines are numbered over byte ranges, then parsing is columns and segmented scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.arrays import column_major
from tidemark.functions.strings import key_value
from tidemark.functions.times import day_of_year, timestamp_60
from tidemark.functions.values import axis, knots
from tidemark.operators.groups import multi_values
from tidemark.operators.scan import MOST_BROADCAST, segmented_scan
from tidemark.session import scratch

TRACK_COLUMNS = ["DELTA_T", "LATITUDE", "LONGITUDE", "DIRECTION", "SPEED", "RMAX", "VMAX", "NAME"]


PIECE = r"^(.*)/part-(\d+)-[^/]*c(\d+)[^/]*$"  # fixed value: how Spark's writers name the pieces of an output


def lines(spark: SparkSession, path: str | list[str], pieces: bool = False) -> DataFrame:
    """file, start, line_no (from 0), value of text files of any size, which many tasks read by byte ranges.

    A line belongs to the range in which it begins. The ranges' line counts are added up per file, so a line's number needs
    its range's sum and its place in the range alone. ``start`` ascends within a file and marks a range: rows of one come in
    order, which ``segmented_scan`` takes as ``part``. With ``pieces`` a folder of Spark's part files is one file, in the
    order of their numbers (below 2 ** 17, of files below 1 TB). Ranges are as long as
    ``spark.sql.files.maxPartitionBytes`` says; compressed files are one range. Empty files have no line.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_begin"), F.monotonically_increasing_id().alias("_id"), "value")
    counts = rows.groupBy("_path", "_begin").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    at, begin = F.col("_path"), F.col("_begin")
    if pieces:  # names are taken apart once for each range; for each line that would cost more than all else
        number, part = (F.regexp_extract(at, PIECE, i).cast("long") for i in (2, 3))
        far = (number >= 1 << 17) | (part >= 1 << 6) | (begin >= 1 << 40)
        begin = F.when(far, F.raise_error(F.concat(F.lit("too many pieces: "), at)).cast("long")).otherwise(F.shiftleft(number, 46) + F.shiftleft(part, 40) + begin)
        at = F.regexp_extract(at, PIECE, 1)
    kept = scratch(spark, "ranges")
    counts.select("_path", "_begin", at.alias("file"), begin.alias("start"), "_first", "_n").write.parquet(kept)
    ranges = spark.read.schema("_path string, _begin long, file string, start long, _first long, _n long").parquet(kept)
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("start")) - F.col("_n")
    sums = ranges.select("_path", "_begin", "file", "start", (before - F.col("_first")).alias("_shift"))
    few = ranges.count() <= MOST_BROADCAST
    out = rows.join(F.broadcast(sums) if few else sums, ["_path", "_begin"]).withColumn("line_no", F.col("_id") + F.col("_shift"))
    return out.select("file", *(["start"] if few else []), "line_no", "value")  # a shuffle loses the order within ranges


def scanned(rows: DataFrame, **wanted) -> DataFrame:  # noqa: ANN003
    """A scan over each file's lines: by the ranges in which they were read, or in the order of line_no."""
    if "start" in rows.columns:
        return segmented_scan(rows, ["file"], part="start", **wanted)
    return segmented_scan(rows, ["file"], [F.col("line_no")], **wanted)


def body_lines(rows: DataFrame, first: int) -> DataFrame:
    """Lines from ``first`` on that aren't blank. Their values are tied to their numbers, so that no later test on a value is
    made on a heading line: a filter on values alone would be pushed below the join that numbers lines."""
    own = F.col("line_no") >= first
    return rows.filter(own).withColumn("value", F.when(own, F.col("value"))).filter("trim(value) <> ''")


def words(value: Column) -> Column:
    return F.split(F.trim(value), r"\s+")


def control_file(rows: DataFrame) -> DataFrame:
    """File, key, values in file order, single. A line without exactly one '=' is an error."""
    pairs = rows.select("file", "line_no", key_value(F.col("value")).alias("kv")).select("file", "line_no", "kv.key", "kv.value")
    grouped = multi_values(pairs.withColumn("key", F.struct("file", "key")), pos="line_no")
    return grouped.select("key.file", "key.key", "values", "single")


def control_input(found: DataFrame | dict, required: list[str], spark: SparkSession | None = None) -> DataFrame:
    """A control table from files' rows or a dict, with every required key in each file, or an error that lists those that the first file lacks."""
    from tidemark.errors import InputError

    if isinstance(found, dict):
        rows = [("", k, v if isinstance(v, list) else [v], not isinstance(v, list)) for k, v in found.items()]
        found = spark.createDataFrame(rows, "file string, key string, values array<string>, single boolean")
    keys = F.array_except(F.array(*map(F.lit, sorted(required))), F.collect_set("key")).alias("lacking")
    first = found.groupBy("file").agg(keys).filter(F.size("lacking") > 0).orderBy("file").first()  # each file is a configuration
    if first or required and found.isEmpty():
        raise InputError(f"missing: {', '.join(first.lacking if first else sorted(required))}")
    return found


def track_table(rows: DataFrame, where: tuple[str, float] | None = None, time_format: str = "yyyyMMdd HHmm") -> DataFrame:
    """The typed rows of a track table; three heading lines and the last column are skipped. where: (column, value) kept."""
    if where and where[0] not in TRACK_COLUMNS:
        from tidemark.errors import InputError

        raise InputError(f"no column {where[0]}")
    w = words(F.col("value"))
    table = body_lines(rows, 3).select("file", "line_no", w.alias("w"))
    types = ["int", *["double"] * 6, "string"]
    out = table.select("file", "line_no", F.to_timestamp(F.concat_ws(" ", F.col("w")[0], F.col("w")[1]), time_format).alias("DATETIME"), *(F.col("w")[i + 2].cast(t).alias(c) for i, (c, t) in enumerate(zip(TRACK_COLUMNS, types, strict=True))))
    return out.filter(F.col(where[0]) == where[1]) if where else out


def sparse_variables(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of self-describing sparse arrays the heads (file, var, rank, dims, type) and the values (file, var, pos, i0, i1, value)."""
    var = F.regexp_extract(F.substring_index("file", "/", -1), "[^.]+", 0)
    after = lambda i: F.max(F.when(F.col("line_no") == i, F.element_at(F.split("value", ":"), 2)))
    heads = rows.filter("line_no < 3").groupBy("file").agg(after(0).cast("int").alias("rank"), F.transform(F.split(after(1), ","), lambda x: x.cast("int")).alias("dims"), after(2).alias("type"))
    bad = ~F.col("type").isin("int", "float")
    heads = heads.withColumn("type", F.when(bad, F.raise_error(F.concat(F.lit("unknown type "), F.col("type"))).cast("string")).otherwise(F.col("type"))).withColumn("var", var)
    f = F.split(F.rtrim("value"), ",")
    values = body_lines(rows, 3).select("file", var.alias("var"), (F.col("line_no") - 3).alias("pos"), f.alias("f"))
    return heads, values.select("file", "var", "pos", F.col("f")[0].cast("int").alias("i0"), F.when(F.size("f") == 3, F.col("f")[1].cast("int")).alias("i1"), F.element_at("f", -1).cast("double").alias("value"))


def storm_headers(rows: DataFrame) -> DataFrame:
    """One row per field file from its two heading lines."""
    one = lambda i: F.max(F.when(F.col("line_no") == i, words(F.col("value"))))
    h = rows.filter("line_no < 2").groupBy("file").agg(one(0).alias("a"), one(1).alias("s"))
    wrong = (F.size("a") != 14) | (F.size("s") != 7)
    h = h.filter(F.when(wrong, F.raise_error(F.concat(F.lit("bad heading in "), F.col("file"))).cast("boolean")).otherwise(True))
    part = lambda i, start, n, kind="int": F.substring(F.col("a")[i], start, n).cast(kind)
    first = {"ayear": part(1, 1, 4), "amonth": part(1, 5, 2), "aday": part(1, 7, 2), "ajday": part(2, 5, 3), "ahour": part(2, 8, 2)}
    first |= {n: F.col("a")[i].cast("double") for n, i in (("alat", 3), ("alon", 4), ("alatm12", 5), ("alonm12", 6))} | {n: F.col("a")[i].cast("int") for n, i in (("adir", 7), ("aspeed", 8), ("armw", 9), ("avmx", 10), ("avmxm12", 11))}
    first |= {"abasin": F.substring(F.col("a")[12], 1, 2), "asnum": part(12, 3, 2), "asyear": part(12, 5, 2), "asname": F.col("a")[13]}
    s = F.col("s")
    date = day_of_year(F.substring(s[1], 1, 4).cast("int"), F.substring(s[1], 5, 3).cast("int"))
    time = [F.substring(s[2], i, 2).cast("int") for i in (1, 3, 5)]
    second = {"swath_time": timestamp_60(F.year(date), F.month(date), F.dayofmonth(date), *time)} | {n: s[i].cast("double") for n, i in (("slat", 3), ("slon", 4), ("clat", 5), ("clon", 6))}
    return h.select("file", *(c.alias(n) for n, c in (first | second).items()))


def pressure_fields(rows: DataFrame, convert: bool = True, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Of gridded field files the pressure-level cells and the surface cells, long.

    Cells are numbered column-major within a block (longitude index first), by their distance from its heading. Winds become knots if asked for; ``compat``
    leaves the surface v as it is, as an old rule had it. Blank lines are skipped; other unexpected lines are an error.
    """
    body = body_lines(rows, 2).withColumn("w", words(F.col("value")))
    first = F.col("w")[0]
    is_cell = first.rlike(r"^[-+]?\d")
    known = first.isin("Pressure", "Lat", "Surface") | is_cell
    body = body.filter(F.when(~known, F.raise_error(F.concat(F.lit("unexpected line in "), F.col("file"))).cast("boolean")).otherwise(first != "Lat"))
    level = F.regexp_extract("value", r"=\s*([0-9.]+)\s+nlat", 1)
    nlon = F.regexp_extract("value", r"nlon=\s*(\d+)", 1)
    pressure, surface = first == "Pressure", first == "Surface"
    heads = {"h_level": F.when(pressure, level.cast("double")), "h_nlon": F.when(pressure, nlon.cast("int")), "h_surface": F.when(surface, True), "h_block": F.when(~is_cell, F.col("line_no"))}
    body = scanned(body.withColumns(heads), fill={"level": "h_level", "nlon": "h_nlon", "surface": "h_surface"}, since={"in_block": "h_block"})
    cells = body.filter(is_cell).withColumn("ordinal", F.col("in_block") - 1).withColumn("surface", F.coalesce("surface", F.lit(False)))
    number = lambda i: F.col("w")[i].cast("double")
    wind = lambda i: knots(number(i)) if convert else number(i)
    i, j = F.col("ordinal") % F.col("nlon"), F.floor(F.col("ordinal") / F.col("nlon"))
    place = [F.col("file"), i.cast("int").alias("i"), j.cast("int").alias("j"), number(0).alias("lat"), number(1).alias("lon"), wind(2).alias("u")]
    levels = cells.filter("NOT surface").select("level", *place, wind(3).alias("v"), number(4).alias("t"), number(5).alias("z"))
    surface = cells.filter("surface").select(*place, (number(3) if compat else wind(3)).alias("v"), number(4).alias("t"), number(5).alias("slp"), number(6).alias("clw"))
    return levels, surface


def radial_fields(rows: DataFrame, convert: bool = True) -> DataFrame:
    """File, var, r_idx, z_idx, radius, height, value of radius-height files: free-format numbers under named headings, column-major."""
    heads = rows.filter("line_no = 2").select("file", words(F.col("value")).alias("w"))
    heads = heads.select("file", F.col("w")[4].cast("int").alias("nr"), axis(F.col("w")[5].cast("double"), F.col("w")[6].cast("double"), F.col("w")[4].cast("int")).alias("radii"), axis(F.col("w")[9].cast("double"), F.col("w")[10].cast("double"), F.col("w")[8].cast("int")).alias("heights"))
    body = body_lines(rows, 3).withColumn("w", words(F.col("value")))
    name = F.when(F.col("w")[0].isin("PRESSURE", "DENSITY", "TEMPERATURE", "GRADIENT"), F.lower(F.col("w")[0]))
    known = name.isNotNull() | F.col("w")[0].rlike(r"^[-+]?\d")
    body = body.filter(F.when(~known, F.raise_error(F.concat(F.lit("unexpected line in "), F.col("file"))).cast("boolean")).otherwise(True))
    place = ["start"] if "start" in rows.columns else []
    numbers = body.select("file", *place, "line_no", name.alias("h_var"), F.posexplode(F.when(name.isNull(), F.col("w")).otherwise(F.array(F.lit(None).cast("string")))).alias("at", "x"))
    wanted = {"fill": {"var": "h_var"}, "since": {"in_block": "h_var"}}
    numbers = scanned(numbers, **wanted) if place else segmented_scan(numbers, ["file"], [F.col("line_no"), F.col("at")], **wanted)
    values = numbers.filter("h_var IS NULL").withColumn("value", F.col("x").cast("double")).withColumn("ordinal", F.col("in_block") - 1).join(heads, "file")
    value = F.when(F.col("var") == "gradient", knots(F.col("value"))).otherwise(F.col("value")) if convert else F.col("value")
    r, z = F.col("ordinal") % F.col("nr"), F.floor(F.col("ordinal") / F.col("nr"))
    return values.select("file", "var", r.cast("int").alias("r_idx"), z.cast("int").alias("z_idx"), F.col("radii")[r.cast("int")].alias("radius"), F.col("heights")[z.cast("int")].alias("height"), value.alias("value"))


def pressure_slice(levels: DataFrame, label: str) -> DataFrame:
    """The cells of one level, given as hPa with one decimal."""
    from tidemark.functions.values import level_label

    return levels.filter(level_label(F.col("level")) == label)


def grid_axes(levels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latitudes along i = 0 and longitudes along j = 0 of the first level."""
    from tidemark.functions.values import checked_latitude, checked_longitude

    first = levels.join(levels.groupBy("file").agg(F.min("level").alias("level")), ["file", "level"])
    return first.filter("i = 0").select("file", "j", checked_latitude(F.col("lat")).alias("lat")), first.filter("j = 0").select("file", "i", checked_longitude(F.col("lon")).alias("lon"))


def index_of(pos: Column, *sizes: int) -> tuple[Column, ...]:
    return column_major(pos, *sizes)
