"""Queries of sources and sinks: files are written from the driver's tables, read back as tables, and compared with SQL.

Files go to the folder that driver and executors share, one text file for each name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import tables
from tidemark.operators.scan import segmented_scan
from tidemark.plans.catalogue import query, text_of
from tidemark.session import scratch, table
from tidemark.sources import array_files, binaries, folders, named_files, names, sinks, texts


def through_files(rows: DataFrame, label: str) -> DataFrame:
    """Rows of (file, pos, value) written as text files and read back as file, start, line_no, value.

    Ranges of (file, pos) go to tasks, each of which writes its piece of a file; the pieces are read as the file they make up.
    """
    path = scratch(rows.sparkSession, label)
    at = [F.col("file"), F.col("pos")]
    rows.repartitionByRange(*at).sortWithinPartitions(*at).select("file", "value").write.partitionBy("file").text(path)
    return texts.lines(rows.sparkSession, path, pieces=True).withColumn("file", F.substring_index("file", "/file=", -1))


def in_order(*lines: Column) -> Column:
    """pos and value of lines given as columns, for an inline of rows."""
    return F.array(*(F.struct(F.lit(i).cast("long").alias("pos"), x.alias("value")) for i, x in enumerate(lines)))


@query("""SELECT o_orderkey, 'nhc' AS source, 'al' || printf('%02d', o_orderkey % 100) || year(o_orderdate)::VARCHAR AS "stormId", 'Atlantic' AS basin, (o_orderkey % 100)::INT AS "stormNum",
year(o_orderdate)::INT AS year, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS created, (o_orderkey % 100)::VARCHAR || 'A' AS "jtwcId" FROM orders""")
def q58_track_names(spark: SparkSession, sf: str) -> DataFrame:
    """S7."""
    name = F.concat(F.lit("nhc_aal"), F.format_string("%02d", F.col("o_orderkey") % 100), F.date_format("o_orderdate", "yyyy"), F.lit(".dat."), F.date_format("o_orderdate", "yyyyMMddHHmm"))
    found = names.track.read(table(spark, sf, "orders").select("o_orderkey", name.alias("name")))
    return found.select("o_orderkey", "source", "stormId", "basin", "stormNum", "year", text_of("createDTG").alias("created"), "jtwcId")


@query("""SELECT event_id, (hour(ts) // 6 * 6)::INT AS hour, (event_id % 385)::INT AS fhour, strftime(date_trunc('day', ts) + to_hours(hour(ts) // 6 * 6), '%Y-%m-%d %H:00:00') AS run FROM events""")
def q59_forecast_names(spark: SparkSession, sf: str) -> DataFrame:
    """S8."""
    hour = F.floor(F.hour("ts") / 6) * 6
    name = F.concat(F.lit("gfs.t"), F.format_string("%02d", hour), F.lit("z.pgrb2.1p00.f"), F.format_string("%03d", F.col("event_id") % 385), F.lit("."), F.date_format("ts", "yyyyMMdd"))
    found = names.forecast.read(table(spark, sf, "events").select("event_id", name.alias("name")))
    return found.select("event_id", "hour", "fhour", text_of("runDTG").alias("run"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'SND' ELSE 'IMG' END AS type, 'v11' AS version, 'NPP' AS satellite, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS start,
strftime(date_trunc('second', ts) + INTERVAL 9 MINUTE, '%Y-%m-%d %H:%M:%S') AS stop FROM events""")
def q60_satellite_names(spark: SparkSession, sf: str) -> DataFrame:
    """S9."""
    ts = F.col("ts").cast("timestamp")
    at = lambda t: F.concat(F.date_format(t, "yyyyMMddHHmmss"), F.lit("5"))
    name = F.concat(F.lit("NPR-MIRS-"), F.when(F.col("event_id") % 2 == 0, "SND").otherwise("IMG"), F.lit("_v11_NPP_s"), at(ts), F.lit("_e"), at(ts + F.expr("INTERVAL 9 MINUTES")), F.lit("_c"), at(ts), F.lit(".nc"))
    found = names.satellite.read(table(spark, sf, "events").select("event_id", name.alias("name")))
    return found.select("event_id", "type", "version", "satellite", text_of("startDT").alias("start"), text_of("endDT").alias("stop"))


@query("""SELECT o_orderstatus AS file, strftime(o_orderdate, '%Y-%m-%d 06:30:00') AS at, (o_orderkey % 4)::INT AS delta, (o_custkey % 180 - 90) / 2.0::DOUBLE AS lat, (o_custkey % 360)::DOUBLE AS lon, 'ORDER' || o_orderkey AS name
FROM orders WHERE o_orderkey % 4 = 0""")
def q61_track_table(spark: SparkSession, sf: str) -> DataFrame:
    """The analysis rows of a file for each status, below three heading lines."""
    orders = table(spark, sf, "orders")
    heads = orders.select(F.col("o_orderstatus").alias("file")).distinct().select("file", F.inline(in_order(*map(F.lit, ("track", "columns", "----")))))
    fields = ["o_orderkey % 4", "(o_custkey % 180 - 90) / 2.0", "o_custkey % 360", "1", "2", "3", "4"]
    line = F.concat_ws("  ", F.date_format("o_orderdate", "yyyyMMdd"), F.lit("0630"), *(F.expr(f"CAST({x} AS STRING)") for x in fields), F.concat(F.lit("ORDER"), F.col("o_orderkey")), F.lit("B"))
    body = orders.select(F.col("o_orderstatus").alias("file"), (F.col("o_orderkey") + 10).cast("long").alias("pos"), line.alias("value"))
    found = texts.track_table(through_files(heads.unionByName(body), "tracks"), ("DELTA_T", 0))
    return found.select("file", text_of("DATETIME").alias("at"), F.col("DELTA_T").alias("delta"), F.col("LATITUDE").alias("lat"), F.col("LONGITUDE").alias("lon"), F.col("NAME").alias("name"))


@query("""SELECT 'vec' || label AS var, (dense_rank() OVER (PARTITION BY label ORDER BY vec_id) - 1)::INT AS i0, i1::INT AS i1, trunc(embedding[i1 + 1]::DOUBLE * 1000)::BIGINT::DOUBLE AS value
FROM (SELECT vec_id, label, embedding FROM embeddings WHERE label IS NOT NULL), range(64) r(i1)""")
def q62_sparse_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """A rank-2 variable for each label, written and read back."""
    vectors = table(spark, sf, "embeddings").filter("label IS NOT NULL").select(F.concat(F.lit("vec"), "label").alias("file"), "vec_id", "embedding")
    numbered = segmented_scan(vectors, ["file"], [F.col("vec_id")], ordinal="n").select("file", "embedding", (F.col("n") - 1).alias("row"))
    cells = numbered.select("file", "row", F.posexplode("embedding").alias("i", "x")).select("file", (F.col("row").cast("long") * 64 + F.col("i")).alias("pos"), F.expr("CAST(CAST(CAST(x AS DOUBLE) * 1000 AS BIGINT) AS DOUBLE)").alias("value"))
    heads = vectors.groupBy("file").agg(F.array(F.count(F.lit(1)).cast("int"), F.lit(64)).alias("dims")).withColumn("rank", F.lit(2)).withColumn("type", F.lit("float"))
    found = texts.sparse_variables(through_files(sinks.sparse_lines(heads, cells), "sparse"))[1]
    return found.select("var", "i0", "i1", "value")


@query("""SELECT field, i::INT AS i, value::INT AS value FROM (SELECT row_number() OVER (ORDER BY event_id) - 1 AS i, year(ts) AS years, month(ts) AS months, day(ts) AS days, hour(ts) AS hours, minute(ts) AS minutes, second(ts) AS seconds FROM events)
UNPIVOT (value FOR field IN (years, months, days, hours, minutes, seconds))""")
def q63_time_files(spark: SparkSession, sf: str) -> DataFrame:
    """K2: six files of time components."""
    events = tables.numbered(table(spark, sf, "events").select("event_id", "ts"), ["event_id"])
    values = events.select((F.col("line") - 1).alias("pos"), (F.col("line") - 1).alias("i0"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("value"))
    found = through_files(sinks.time_components(values).withColumnRenamed("field", "file"), "times")
    part = F.split("value", ",")
    return found.select(F.col("file").alias("field"), part[0].cast("int").alias("i"), part[1].cast("int").alias("value"))


@query("""SELECT c_mktsegment AS file, 'nation' || c_nationkey AS key, string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) AS vals, count(*) = 1 AS single FROM customer GROUP BY ALL""")
def q64_control_files(spark: SparkSession, sf: str) -> DataFrame:
    """A control file for each segment; repeated keys become lists in file order."""
    key = F.concat(F.lit("nation"), "c_nationkey").alias("key")
    attrs = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("file"), F.col("c_custkey").alias("pos"), key, F.col("c_custkey").cast("string").alias("value"))
    path = scratch(spark, "control")
    named_files.write_text_files(sinks.control_lines(attrs), path)
    lines = texts.lines(spark, path).withColumn("file", F.substring_index("file", "/", -1))
    return texts.control_file(lines).select("file", "key", F.array_join("values", ",").alias("vals"), "single")


@query("""SELECT printf('%07.2f', (s_suppkey % 360)::DOUBLE) || ' ' || printf('%06.2f', s_nationkey::DOUBLE) || ' ---- ' || coalesce(printf('%010.5f', max(s_suppkey::DOUBLE) FILTER (s_suppkey % 2 = 0)), '----------') || ' '
|| coalesce(printf('%010.5f', max(s_suppkey::DOUBLE) FILTER (s_suppkey % 2 = 1)), '----------') || ' ' AS line FROM supplier GROUP BY s_suppkey % 360, s_nationkey""")
def q65_wide_file(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of a wide table, as they come back from a file."""
    supplier = table(spark, sf, "supplier")
    number = F.col("s_suppkey").cast("double")
    samples = supplier.select((F.col("s_suppkey") % 360).cast("double").alias("lon"), F.col("s_nationkey").cast("double").alias("lat"), F.lit(None).cast("int").alias("i1"), F.when(F.col("s_suppkey") % 2 == 0, "even").otherwise("odd").alias("var"), number.alias("value"), F.col("s_suppkey").alias("pos"))
    wide = tables.wide_lines(tables.wide(samples, ["even", "odd"]), ["even", "odd"])
    path = scratch(spark, "wide")
    sinks.write_lines(wide, path, ["value"])
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("""SELECT 0::INT AS part, printf('%09d %015.5f %015.5f', n_nationkey, n_regionkey::DOUBLE, n_nationkey / 2.0::DOUBLE) AS value FROM nation UNION ALL
SELECT 1::INT, printf('%09d', n_nationkey) || ',' || printf('%09d', n_regionkey) FROM nation UNION ALL SELECT 2::INT, unnest(['npp', 'atms'])""")
def q66_coordinate_times(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinate lines, time lines, satellite and instrument, in one file."""
    nation = table(spark, sf, "nation")
    coords = tables.coordinates(nation.select(F.col("n_nationkey").alias("i0"), F.col("n_regionkey").cast("double").alias("value")), nation.select(F.col("n_nationkey").alias("i0"), (F.col("n_nationkey") / F.lit(2.0)).alias("value")))
    lines = tables.index_lines(coords).withColumn("pos", F.substring("value", 1, 9).cast("long"))
    times = nation.select(F.col("n_nationkey").alias("pos"), F.format_string("%09d,%09d", "n_nationkey", "n_regionkey").alias("value"))
    rows = sinks.coordinate_times(lines, times, "npp", "atms").select(F.lit("coords").alias("file"), (F.col("part") * 1_000_000 + F.col("pos")).alias("pos"), "value")
    found = through_files(rows, "coords")
    part = F.when(F.col("value").contains(","), 1).when(F.col("value").rlike("^[0-9]"), 0).otherwise(2)
    return found.select(part.cast("int").alias("part"), "value")


@query("""SELECT n_nationkey::INT AS line, 'k' || n_nationkey || ' x y ' || n_regionkey || ' ' || (n_regionkey + 1) || ' ' || n_nationkey || ' ' || (n_nationkey * 2) || ' ' AS value FROM nation""")
def q67_interleaved_file(spark: SparkSession, sf: str) -> DataFrame:
    """Two files of lines as one, the fields beyond the keys side by side."""
    nation = table(spark, sf, "nation").withColumn("pos", F.col("n_nationkey"))
    lines = lambda name, a, b: through_files(nation.select(F.lit(name).alias("file"), "pos", F.expr(f"concat_ws(' ', concat('k', n_nationkey), 'x', 'y', {a}, {b})").alias("value")), name)
    first, second = lines("first", "n_regionkey", "n_nationkey"), lines("second", "n_regionkey + 1", "n_nationkey * 2")
    return tables.interleaved_lines(first, second).select(F.col("line_no").alias("line"), "value")


@query("""SELECT c_mktsegment AS channel, 'c' || c_custkey AS name FROM customer""")
def q68_manifests(spark: SparkSession, sf: str) -> DataFrame:
    """A list of names for each channel."""
    path = scratch(spark, "manifests")
    sinks.manifests(table(spark, sf, "customer").select(F.col("c_mktsegment").alias("channel"), F.concat(F.lit("c"), "c_custkey").alias("name")), path)
    return spark.read.text(path).select("channel", F.col("value").alias("name"))


# Heading lines in the documented layout.
HEADING = ("01 20121027 201230118   29.8  -75.6   28.1  -76.9 034 010 075 065 065 AL1812  SANDY", "01 2012301 180860    29.70   -76.38    29.82   -75.58")
KNOTS = 1.943844492457398


def grid_lines(nation: DataFrame) -> DataFrame:
    """A gridded field file for each nation: two pressure levels and the surface, three by two cells."""
    number = lambda x: F.expr(f"CAST(CAST({x} AS DOUBLE) AS STRING)")

    def cell(j: int, i: int, *more: str) -> Column:
        return F.concat_ws(" ", F.lit(f"{10 + j}.0 {300 + i}.0"), *map(number, (f"n_nationkey + {i}", f"n_regionkey + {j}", f"n_nationkey + {j} / 2D", *more)))

    at = [(j, i) for j in range(2) for i in range(3)]
    cells = [cell(j, i, f"n_regionkey + {100 + i}") for j, i in at]
    block = lambda p: [F.lit(f"Pressure level (Pa)= {p} nlat= 2 nlon= 3"), F.lit("Lat Lon U V T Z"), *cells]
    below = [cell(j, i, f"n_regionkey + {1000 + i}", f"n_nationkey / 4D + {j}") for j, i in at]
    surface = [F.lit("Surface"), F.lit("Lat Lon U V T SLP CLW"), *below]
    lines = in_order(*map(F.lit, HEADING), *block("10000.0"), *block("85000.0"), *surface)
    return nation.select(F.concat(F.lit("n"), "n_nationkey").alias("file"), F.inline(lines))


@query(f"""SELECT 'n' || n_nationkey AS file, level, i::INT AS i, j::INT AS j, 10.0::DOUBLE + j AS lat, 300.0::DOUBLE + i AS lon,
(n_nationkey + i) * {KNOTS}::DOUBLE AS u, (n_regionkey + j) * {KNOTS}::DOUBLE AS v, n_nationkey + j / 2.0::DOUBLE AS t, (n_regionkey + 100 + i)::DOUBLE AS z
FROM nation, range(3) a(i), range(2) b(j), (SELECT unnest([10000.0::DOUBLE, 85000.0::DOUBLE]) AS level)""")
def q69_pressure_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of pressure levels."""
    return texts.pressure_fields(through_files(grid_lines(table(spark, sf, "nation")), "grids"))[0]


@query(f"""SELECT 'n' || n_nationkey AS file, i::INT AS i, j::INT AS j, 10.0::DOUBLE + j AS lat, 300.0::DOUBLE + i AS lon, (n_nationkey + i) * {KNOTS}::DOUBLE AS u,
(n_regionkey + j) * {KNOTS}::DOUBLE AS v, n_nationkey + j / 2.0::DOUBLE AS t, (n_regionkey + 1000 + i)::DOUBLE AS slp, n_nationkey / 4.0::DOUBLE + j AS clw
FROM nation, range(3) a(i), range(2) b(j)""")
def q70_surface_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of the surface."""
    return texts.pressure_fields(through_files(grid_lines(table(spark, sf, "nation")), "grids"))[1]


@query(f"""SELECT 'n' || n_nationkey AS file, var, r::INT AS r_idx, z::INT AS z_idx, r * 300.0::DOUBLE AS radius, z * 20.0::DOUBLE AS height, (n_regionkey + r + 3 * z) * CASE WHEN var = 'gradient' THEN {KNOTS}::DOUBLE ELSE 1.0::DOUBLE END AS value
FROM nation, range(3) a(r), range(2) b(z), (SELECT unnest(['pressure', 'gradient']) AS var)""")
def q71_radial_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Radius-height files with free-format numbers."""
    head = (*HEADING, "AL1812 102718 10271808  r(km): 3    0.0  600.0 z(km): 2    0.0   20.0 lat= 29.82 lon= -75.59")
    numbers = lambda first, n: F.concat_ws(" ", *((F.col("n_regionkey") + first + k).cast("string") for k in range(n)))
    lines = [*map(F.lit, head), F.lit("PRESSURE"), numbers(0, 2), numbers(2, 4), F.lit("GRADIENT"), numbers(0, 5), numbers(5, 1)]
    rows = table(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("file"), F.inline(in_order(*lines)))
    return texts.radial_fields(through_files(rows, "radial"))


@query(r"""SELECT event_id, '\d{4}-\d{3}' || (event_id % 3) AS pattern, '%04d%d_' || (event_id % 3) AS printf FROM events""")
def q72_date_formats(spark: SparkSession, sf: str) -> DataFrame:
    """C4."""
    from tidemark.functions.strings import date_format_pattern, date_format_printf

    tail = (F.col("event_id") % 3).cast("string")
    return table(spark, sf, "events").select("event_id", date_format_pattern(F.concat(F.lit("%Y-%j"), tail)).alias("pattern"), date_format_printf(F.concat(F.lit("%Y%w_"), tail)).alias("printf"))


@query("""SELECT 'c' || c_custkey AS file, 2012::INT AS ayear, (c_custkey % 12 + 1)::INT AS amonth, (c_custkey % 28 + 1)::INT AS aday, (c_custkey % 24)::INT AS ahour, (c_custkey % 90)::DOUBLE AS alat,
(c_nationkey * 2)::DOUBLE AS alon, (c_custkey % 150)::INT AS avmx, 'AL' AS abasin, (c_custkey % 100)::INT AS asnum, 'STORM' || c_nationkey AS asname,
strftime(TIMESTAMP '2012-01-01' + INTERVAL 1 DAY * (c_custkey % 366)::INT + INTERVAL 1 HOUR * (c_custkey % 24)::INT + INTERVAL 1 MINUTE * (c_custkey % 60)::INT + INTERVAL 1 SECOND * (c_custkey % 61)::INT, '%Y-%m-%d %H:%M:%S') AS swath,
(c_custkey % 180 - 90)::DOUBLE AS clat FROM customer""")
def q73_storm_headings(spark: SparkSession, sf: str) -> DataFrame:
    """The two heading lines of a field file for each customer; some swaths are at second 60."""
    f = lambda form, x: F.expr(f"format_string('{form}', {x})")
    date = F.concat(F.lit("2012"), f("%02d", "c_custkey % 12 + 1"), f("%02d", "c_custkey % 28 + 1"))
    numbers = lambda *x: [F.expr(f"CAST(CAST({y} AS DOUBLE) AS STRING)") for y in x]
    name = F.concat(F.lit("AL"), f("%02d", "c_custkey % 100"), F.lit("12"))
    first = F.concat_ws(" ", F.lit("01"), date, F.concat(F.lit("2012001"), f("%02d", "c_custkey % 24")), *numbers("c_custkey % 90", "c_nationkey * 2", "0", "0"),
        F.lit("034 010 075"), f("%03d", "c_custkey % 150"), F.lit("065"), name, F.concat(F.lit("STORM"), "c_nationkey"))
    clock = [f("%02d", f"c_custkey % {n}") for n in (24, 60, 61)]
    second = F.concat_ws(" ", F.lit("01"), F.concat(F.lit("2012"), f("%03d", "c_custkey % 366 + 1")), F.concat(*clock), *numbers("1", "2", "c_custkey % 180 - 90", "3"))
    rows = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("file"), F.inline(in_order(first, second)))
    path = scratch(spark, "headings")
    rows.select(F.concat_ws("|", "file", F.col("pos").cast("string"), "value").alias("value")).write.text(path)
    part = F.split("value", r"\|")
    found = texts.storm_headers(spark.read.text(path).select(part[0].alias("file"), part[1].cast("long").alias("line_no"), part[2].alias("value")))
    return found.select("file", "ayear", "amonth", "aday", "ahour", "alat", "alon", "avmx", "abasin", "asnum", "asname", text_of("swath_time").alias("swath"), "clat")


def grid_datasets(spark: SparkSession, sf: str) -> str:
    """K4: the folder of an array file for each nation's grids."""
    rows = through_files(grid_lines(table(spark, sf, "nation")), "grids")
    levels, surface = texts.pressure_fields(rows)
    path = scratch(spark, "arrays")
    created = F.lit("2013-01-01 00:00:00").cast("timestamp")
    array_files.write_arrays(sinks.array_dataset(levels, surface, texts.storm_headers(rows), created, "NPP", "ATMS"), path)
    return path


@query(f"""WITH cells AS (SELECT 'n' || n_nationkey || '.nc' AS file, l, j, i, (n_nationkey + i) * {KNOTS}::DOUBLE AS u, (n_regionkey + j) * {KNOTS}::DOUBLE AS v, n_nationkey + j / 2.0::DOUBLE AS t,
(n_regionkey + 100 + i)::DOUBLE AS z, (n_regionkey + 1000 + i)::DOUBLE AS slp, n_nationkey / 4.0::DOUBLE + j AS clw FROM nation, range(2) c(l), range(2) b(j), range(3) a(i))
SELECT file, 'u' AS var, (l * 2 + j) * 3 + i AS at, u AS value FROM cells UNION ALL SELECT file, 'v', (l * 2 + j) * 3 + i, v FROM cells
UNION ALL SELECT file, 't', (l * 2 + j) * 3 + i, t FROM cells UNION ALL SELECT file, 'z', (l * 2 + j) * 3 + i, z FROM cells
UNION ALL SELECT file, 'su', j * 3 + i, u FROM cells WHERE l = 0 UNION ALL SELECT file, 'sv', j * 3 + i, v FROM cells WHERE l = 0
UNION ALL SELECT file, 'st', j * 3 + i, t FROM cells WHERE l = 0 UNION ALL SELECT file, 'sslp', j * 3 + i, slp FROM cells WHERE l = 0
UNION ALL SELECT file, 'sclw', j * 3 + i, clw FROM cells WHERE l = 0 UNION ALL SELECT file, 'levels', l, 10000.0::DOUBLE + 75000 * l FROM cells WHERE j = 0 AND i = 0
UNION ALL SELECT file, 'lats', j, 10.0::DOUBLE + j FROM cells WHERE l = 0 AND i = 0 UNION ALL SELECT file, 'lons', i, 300.0::DOUBLE + i FROM cells WHERE l = 0 AND j = 0""")
def q75_array_values(spark: SparkSession, sf: str) -> DataFrame:
    """The arrays of each nation's grids, written with a commit and read back by ranges."""
    return array_files.read_values(spark, grid_datasets(spark, sf))


@query("""SELECT 'n' || n_nationkey || '.nc' AS file, kind, var, name, value FROM nation, (VALUES ('dimension', '', 'pressure', '2'), ('dimension', '', 'lat', '2'), ('dimension', '', 'lon', '3'),
('attribute', 'u', 'units', 'kt'), ('attribute', '', 'satellite_name', 'NPP'), ('attribute', '', 'atcf_storm_name', 'SANDY'), ('attribute', '', 'geospatial_lat_max', '11.0'),
('variable', 't', 'dimensions', 'pressure,lat,lon'), ('variable', 'sclw', 'dimensions', 'lat,lon')) AS h(kind, var, name, value)""")
def q76_array_heads(spark: SparkSession, sf: str) -> DataFrame:
    """K4: dimensions, attributes and shapes of each nation's array file."""
    heads = array_files.read_heads(spark, grid_datasets(spark, sf))
    shown = (F.col("kind") == "dimension") | F.concat_ws(".", "var", "name").isin("u.units", ".satellite_name", ".atcf_storm_name", ".geospatial_lat_max", "t.dimensions", "sclw.dimensions")
    return heads.filter(shown)


@query("""SELECT 'TC-' || c_custkey || '_' || lower(c_mktsegment) AS line FROM customer""")
def q77_product_list(spark: SparkSession, sf: str) -> DataFrame:
    """K5: names of products, appended to one list in two runs."""
    path = scratch(spark, "products")
    products = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("TC-"), "c_custkey", F.lit("_"), F.lower("c_mktsegment")).alias("name"))
    for half in range(2):
        sinks.product_list(products.filter(F.col("c_custkey") % 2 == half), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("""SELECT 'day=' || strftime(ts, '%Y-%m-%d') AS tier, sum(length(event_id::VARCHAR) + 1)::BIGINT AS bytes FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1""")
def q78_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of the files in the folders of some days; the other days' folders are not opened."""
    path = scratch(spark, "days")
    events = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").cast("string").alias("value"))
    events.repartition("day").write.partitionBy("day").text(path)
    files = folders.listed(spark, [f"{path}/^day=.*$"], "part-").filter("tier_0 >= 'day=2024-01-10' AND tier_0 < 'day=2024-01-20' AND length > 0 AND modified > TIMESTAMP '2020-01-01'")
    return files.groupBy(F.col("tier_0").alias("tier")).agg(F.sum("length").alias("bytes"))


@query("""SELECT 'n' || c_nationkey || '.tar' AS file, 'c' || c_custkey || '.txt' AS member, c_name || ' ' || c_mktsegment AS content FROM customer WHERE c_custkey % 10 < 5""")
def q80_archive_members(spark: SparkSession, sf: str) -> DataFrame:
    """A tar archive of customers for each nation; the members whose names end with certain digits, read by ranges."""
    import tarfile
    from collections.abc import Iterator

    import pyarrow as pa

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each member's header and data, padded to blocks of 512 bytes."""
        for batch in batches:
            out = []
            for name, text in zip(batch.column("member").to_pylist(), batch.column("text").to_pylist(), strict=True):
                info, data = tarfile.TarInfo(name), text.encode()
                info.size = len(data)
                out.append(info.tobuf() + data + bytes(-len(data) % 512))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("pos"), pa.array(out, pa.binary())], ["file", "pos", "data"])

    customers = table(spark, sf, "customer").select(
        F.concat(F.lit("n"), "c_nationkey", F.lit(".tar")).alias("file"), F.col("c_custkey").cast("long").alias("pos"), F.concat(F.lit("data/c"), "c_custkey", F.lit(".txt")).alias("member"),
        F.concat_ws(" ", "c_name", "c_mktsegment").alias("text"),
    )
    ends = customers.select("file").distinct().select("file", F.lit((1 << 63) - 1).alias("pos"), F.lit(bytearray(1024)).alias("data"))
    path = scratch(spark, "archives")
    named_files.write_files(customers.mapInArrow(blocks, "file string, pos long, data binary").unionByName(ends), path)
    found = binaries.members(spark, path, "tar", r"c\d*[0-4]\.txt$", strip=1, run_bytes=1 << 20)
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "member", F.decode("content", "UTF-8").alias("content"))


@query("""SELECT 'p' || p_partkey AS file, p_partkey::BIGINT AS number, p_size::BIGINT AS size, p_retailprice AS price, p_brand AS brand FROM part""")
def q81_binary_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Binary files of parts with a header of four fields and a longer body; only headers are read back."""
    import struct
    from collections.abc import Iterator

    import pyarrow as pa

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            data = [struct.pack(">IHd12s", r["p_partkey"], r["p_size"], r["p_retailprice"], r["p_brand"].encode()) + bytes(4096) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([f"p{r['p_partkey']}" for r in rows]), pa.array([0] * len(rows), pa.int64()), pa.array(data, pa.binary())], ["file", "pos", "data"])

    path = scratch(spark, "headers")
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    named_files.write_files(parts.mapInArrow(packed, "file string, pos long, data binary"), path)
    layout = {"number": ("I", 1), "size": ("H", 1), "price": ("d", 1), "brand": ("s", 12)}
    return binaries.headers(spark, path, layout, ">").withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1)).drop("path")
