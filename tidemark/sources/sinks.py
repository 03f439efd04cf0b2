"""Lines and files to write (K1-K8, K11-K15). Each function gives a DataFrame; ``write_lines`` puts it in order into one file set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.strings import storm_id
from tidemark.functions.times import epoch_fields, formatted


def write_lines(rows: DataFrame, path: str, order: list[str], mode: str = "overwrite") -> None:
    """Text in a total order. The sort is by range, so part files follow each other; no single task writes all."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode(mode).text(path)


def sparse_lines(heads: DataFrame, values: DataFrame, kind: str | None = None) -> DataFrame:
    """K1: file, pos, value: three heading lines, then %09d[,%09d],%015.5f with indices regenerated row-major from positions."""
    h = heads.withColumn("type", F.lit(kind) if kind else F.col("type"))
    head = F.array(F.format_string("rank:%03d", "rank"), F.concat(F.lit("dimensions:"), F.array_join(F.transform("dims", lambda d: F.format_string("%09d", d)), ",")), F.concat(F.lit("type:"), F.col("type")))
    top = h.select("file", F.posexplode(head).alias("p", "value")).select("file", (F.col("p") - 3).alias("pos"), "value")
    last = F.col("dims")[1]
    index = F.when(F.col("rank") == 2, F.format_string("%09d,%09d", F.floor(F.col("pos") / last), F.col("pos") % last)).otherwise(F.format_string("%09d", "pos"))
    body = values.join(h, "file").select("file", "pos", F.concat(index, F.lit(","), F.format_string("%015.5f", "value")).alias("value"))
    return top.unionByName(body)


def time_components(values: DataFrame) -> DataFrame:
    """K2: field, pos, value: epoch seconds as six integer tables; write with partitionBy('field')."""
    parts = epoch_fields(F.col("value"))
    names = ["years", "months", "days", "hours", "minutes", "seconds"]
    rows = values.select("pos", "i0", parts.alias("t")).select("pos", F.explode(F.array(*(F.struct(F.lit(n).alias("field"), F.format_string("%09d,%09d", F.col("i0"), F.col(f"t.{n}")).alias("value")) for n in names))).alias("x"))
    return rows.select("x.field", "pos", "x.value")


def coordinate_times(coords: DataFrame, times: DataFrame, satellite: str, instrument: str) -> DataFrame:
    """K3: coordinate lines, time lines, satellite, instrument, in this order (part, pos, value)."""
    spark = coords.sparkSession
    tail = spark.createDataFrame([(0, satellite), (1, instrument)], "pos long, value string")
    parts = [coords.select(F.col("pos").cast("long").alias("pos"), "value"), times.select(F.col("pos").cast("long").alias("pos"), "value"), tail]
    return reduce(DataFrame.unionByName, (p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)))


def control_lines(attrs: DataFrame) -> DataFrame:
    """K6: key=value lines of (pos, key, value); other columns, such as the file, stay."""
    return attrs.select(*(c for c in attrs.columns if c not in ("key", "value")), F.concat_ws("=", "key", "value").alias("value"))


def product_list(names: DataFrame, path: str) -> None:
    """K5: one name a line, appended."""
    names.select(F.col("name").alias("value")).write.mode("append").text(path)


def manifests(files: DataFrame, path: str) -> None:
    """A folder of name lists for each channel."""
    files.select("channel", F.col("name").alias("value")).write.mode("overwrite").partitionBy("channel").text(path)


def params_json(row: Column) -> Column:
    """Conversion parameters as JSON."""
    return F.to_json(row)


def published_names(files: DataFrame, rename: Column) -> DataFrame:
    """Moving and linking as a mapping of names: path, new path in the same folder."""
    return files.select("path", F.concat(F.regexp_extract("path", r"^(.*/)?[^/]*$", 1), rename).alias("new_path"))


def array_dataset(levels: DataFrame, surface: DataFrame, header: DataFrame, created: Column, satellite: str, instrument: str) -> DataFrame:
    """One row per field file: axes, wide arrays in output order (level, lat, lon), and an attribute map.

    Cells go into arrays sorted by their indices, so a file's grid (tens of thousands of cells) is the largest group.
    """
    grid = lambda df, cols, order, tag: df.groupBy("file").agg(*(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(c).alias("v")))), lambda x: x["v"]).alias(f"{tag}{c}") for c in cols))
    wide = grid(levels, ["u", "v", "t", "z"], ["level", "j", "i"], "").join(grid(surface, ["u", "v", "t", "slp", "clw"], ["j", "i"], "s"), "file")
    from tidemark.sources.texts import grid_axes

    lat, lon = grid_axes(levels)
    lats = lat.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "lat"))), lambda x: x["lat"]).alias("lats"))
    lons = lon.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "lon"))), lambda x: x["lon"]).alias("lons"))
    plevs = levels.groupBy("file").agg(F.array_sort(F.collect_set("level")).alias("levels"))
    east = lambda c: F.when(F.col(c) < 0, F.col(c) + 360).otherwise(F.col(c))
    storm = F.to_timestamp(F.format_string("%04d%02d%02d%02d", "ayear", "amonth", "aday", "ahour"), "yyyyMMddHH")
    attrs = {  # fixed values: the attributes' names
        "date_created": formatted(created), "satellite_name": F.lit(satellite), "instrument_name": F.lit(instrument), "atcf_storm_id": storm_id(F.col("abasin"), F.col("asnum"), F.col("ayear")),
        "atcf_storm_basin": F.upper("abasin"), "atcf_storm_number": F.col("asnum"), "atcf_storm_name": F.col("asname"), "atcf_storm_date_time": formatted(storm), "atcf_storm_latitude_degrees_north": F.col("alat"),
        "atcf_storm_longitude_degrees_east": east("alon"), "atcf_storm_speed_knots": F.col("aspeed"), "atcf_storm_direction_degrees": F.col("adir"), "atcf_storm_intensity_knots": F.col("avmx"),
        "atcf_storm_radius_of_maximum_winds_nautical_miles": F.col("armw"), "swath_date_time": formatted(F.col("swath_time")), "swath_storm_extrapolated_latitude_degrees_north": F.col("clat"),
        "swath_storm_extrapolated_longitude_degrees_east": east("clon"), "cmd_data_type": F.lit("grid"), "geospatial_lat_min": F.element_at("lats", 1), "geospatial_lat_max": F.element_at("lats", -1),
        "geospatial_lon_min": F.element_at("lons", 1), "geospatial_lon_max": F.element_at("lons", -1),
    }
    out = wide.join(lats, "file").join(lons, "file").join(plevs, "file").join(header, "file")
    pairs = F.map_from_arrays(F.array(*map(F.lit, attrs)), F.array(*(c.cast("string") for c in attrs.values())))
    return out.select("file", "levels", "lats", "lons", "u", "v", "t", "z", "su", "sv", "st", "sslp", "sclw", pairs.alias("attributes"))
