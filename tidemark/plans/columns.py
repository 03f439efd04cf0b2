"""Queries of column functions, gates, projections and task types that the main catalogue leaves out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import arrays, strings, times, values
from tidemark.operators import select, sets
from tidemark.plans import plugins, registry
from tidemark.plans.catalogue import SECONDS, query, text_of, utc
from tidemark.session import table


@query("""SELECT p_partkey, '/|data|' || lower(p_brand) || '|f' || p_partkey || '.tar.gz' AS parts, 'f' || p_partkey || '.tar.gz' AS name, '.gz' AS ext,
CASE WHEN p_partkey % 2 = 0 THEN '/abs/f' ELSE '/data/f' END || p_partkey AS whole, p_type AS words FROM part""")
def q82_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Parts, names and endings of paths, relative paths made absolute, headings split and joined."""
    path = F.concat(F.lit("/data/"), F.lower("p_brand"), F.lit("/f"), "p_partkey", F.lit(".tar.gz"))
    given = F.concat(F.when(F.col("p_partkey") % 2 == 0, "/abs/f").otherwise("f"), "p_partkey")
    spaced = F.replace(F.col("p_type"), F.lit(" "), F.lit("   "))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(strings.path_parts(path), "|").alias("parts"), strings.base_name(path).alias("name"), strings.extension(path).alias("ext"),
        strings.absolute(F.lit("/data/"), given).alias("whole"), F.array_join(strings.split_header(spaced), " ").alias("words"),
    )


@query("""SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS dtg, CASE WHEN o_custkey % 360 > 180 THEN o_custkey % 360 - 360 ELSE o_custkey % 360 END::DOUBLE AS lon,
'nhc_aep' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || '2024.dat.' || strftime(o_orderdate, '%Y%m%d0000') AS track,
'gfs.t00z.pgrb2.1p00.f' || lpad((o_orderkey % 385)::VARCHAR, 3, '0') || '.' || strftime(o_orderdate, '%Y%m%d') AS forecast FROM orders WHERE o_orderkey % 4 = 0""")
def q83_analysis_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Analysis rows with a signed longitude, chosen and renamed columns, operational names of their files."""
    orders = table(spark, sf, "orders")
    track = orders.select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("DATETIME"), (F.col("o_orderkey") % 4).alias("DELTA_T"), (F.col("o_custkey") % 360).cast("double").alias("LONGITUDE"), F.lit("x").alias("BOGUS"))
    name = F.concat(F.lit("aep"), strings.padded(F.col("o_orderkey") % 100, "%02d"), F.lit("2024.dat"))
    rows = select.analysis_row(track).withColumns({"track": strings.track_name(name, F.lit("ep"), F.col("DTG")), "forecast": strings.forecast_name(F.col("DTG"), F.col("o_orderkey") % 385)})
    wanted = ["o_orderkey", "DTG", "LONGITUDE", "track", "forecast"]
    return select.projected(rows, wanted, {"o_orderkey": "id", "DTG": "dtg", "LONGITUDE": "lon"}, ["BOGUS"]).withColumn("dtg", text_of("dtg"))


@query("""SELECT vec_id, (list_transform(embedding, lambda x: CASE WHEN x < 0 THEN x::DOUBLE + 360 ELSE x::DOUBLE END))[1 + vec_id % 64] AS east, embedding[1 + vec_id % 64]::DOUBLE AS second,
(vec_id % 22)::BIGINT AS level, 6 * (vec_id % 21)::INT AS step, 'k' || (vec_id % 5) AS key FROM embeddings""")
def q84_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Masked updates, zipped rows, level labels, constant steps, maps turned round."""
    at = (F.col("vec_id") % 64).cast("int")
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    labels = F.transform(F.sequence(F.lit(0), F.lit(21)), lambda i: F.concat(i.cast("string"), F.lit(".0")))
    five = F.array(*(F.lit(i) for i in range(5)))
    turned = arrays.inverted(arrays.as_map(F.transform(five, lambda i: F.concat(F.lit("k"), i.cast("string"))), five))
    return table(spark, sf, "embeddings").select(
        "vec_id", arrays.masked_add(doubles, lambda x: x < 0, 360.0)[at].alias("east"), arrays.zipped(doubles.alias("a"), doubles.alias("b"))[at]["b"].alias("second"),
        arrays.level_index(labels, F.concat((F.col("vec_id") % 22).cast("string"), F.lit(".0"))).alias("level"), arrays.steps(0, 127, 6)[(F.col("vec_id") % 21).cast("int")].alias("step"),
        turned[(F.col("vec_id") % 5).cast("int")].alias("key"),
    )


@query("""SELECT c_custkey, c_custkey % 3 = 0 AS numeric, c_acctbal AS balance, (c_custkey % 1000)::BIGINT AS number, (c_custkey % 181 - 90)::DOUBLE AS lat,
CASE WHEN c_custkey % 361 - 180 < 0 THEN c_custkey % 361 + 180 ELSE c_custkey % 361 - 180 END::DOUBLE AS lon FROM customer""")
def q85_checked_values(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of numbers, texts as numbers, coordinates in range."""
    line = F.when(F.col("c_custkey") % 3 == 0, " -1.5 2").otherwise(".5 2")
    lat, lon = (F.col("c_custkey") % 181 - 90).cast("double"), (F.col("c_custkey") % 361 - 180).cast("double")
    return table(spark, sf, "customer").select(
        "c_custkey", values.numeric_line(line).alias("numeric"), values.typed(F.col("c_acctbal").cast("string"), "float").alias("balance"),
        values.typed((F.col("c_custkey") % 1000).cast("string"), "int").alias("number"), values.checked_latitude(lat).alias("lat"), values.checked_longitude(lon).alias("lon"),
    )


@query("""SELECT c_nationkey, string_agg(c_name, ',' ORDER BY c_custkey) AS names, count(*) FILTER (c_custkey % 2 = 0) > 0 AS complete FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders) GROUP BY c_nationkey""")
def q86_gates(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without orders are skipped; properties that must be there; lists of both kinds of keys."""
    kept, _ = select.with_results(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name"), table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])
    odd = F.create_map(F.lit("name"), F.col("c_name"))
    even = F.create_map(F.lit("name"), F.col("c_name"), F.lit("even"), F.lit("yes"))
    props = kept.withColumn("p", F.when(F.col("c_custkey") % 2 == 0, even).otherwise(odd)).withColumn("name", arrays.required_property(F.col("p"), "name"))
    names = select.key_list(props, "name", "c_custkey", ["c_nationkey"])
    keys = props.groupBy("c_nationkey").agg(F.collect_set(F.when(arrays.has_keys(F.col("p"), ["name", "even"]), "even")).alias("k"))
    gate = sets.complete(F.array(F.lit("name"), F.lit("even")), sets.joined(F.array(F.lit("name")), F.col("k")))
    return names.join(keys, "c_nationkey").select("c_nationkey", F.array_join("name", ",").alias("names"), gate.alias("complete"))


@query("""SELECT event_id, strftime(date_trunc('hour', ts) - INTERVAL 43200 SECOND, '%Y-%m-%d %H:%M:%S') AS start, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS stop,
'AL' || (event_id % 30) || '2024' AS storm, lpad((event_id % 10000)::VARCHAR, 4, '0')[3:4] AS tail FROM events""")
def q87_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Hours covered by a run, ids in upper case, substrings at fixed places."""
    window = times.job_coverage(utc("ts"), 43_200)
    cut = strings.cut_at(F.lpad((F.col("event_id") % 10_000).cast("string"), 4, "0"), {"tail": (3, 2)})
    storm = strings.storm_id(F.lit("al"), F.col("event_id") % 30, F.lit(2024))
    return table(spark, sf, "events").select("event_id", F.date_format(window["start"], SECONDS).alias("start"), F.date_format(window["end"], SECONDS).alias("stop"), storm.alias("storm"), cut["tail"].alias("tail"))


@query("""SELECT s_suppkey, s_acctbal AS balance, s_suppkey * 1.943844492457398::DOUBLE AS wind, (s_nationkey * 2)::DOUBLE AS lat FROM supplier""")
def q88_converted(spark: SparkSession, sf: str) -> DataFrame:
    """Output columns from data columns by the names of their converters."""
    rows = table(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").cast("string").alias("b"), F.col("s_suppkey").cast("double").alias("w"), (F.col("s_nationkey") * 2).cast("double").alias("y"))
    outputs = {"s_suppkey": {"from": ["s_suppkey"]}, "balance": {"from": ["b"], "convert": "convert2float"}, "wind": {"from": ["w"], "convert": "knots"}, "lat": {"from": ["y"], "convert": "latitude"}}
    return registry.converted(rows, outputs)


@query("""WITH files AS (SELECT event_id, date_trunc('hour', ts) AS dts, user_id % 4 + 12 AS sat, event_id % 5 + 1 AS chan,
'/in/' || event_id || '/' || strftime(ts, '%Y%j%H0000') || 'i' || (user_id % 4 + 12) || '.c0' || (event_id % 5 + 1) AS path FROM events)
SELECT strftime(dts, '%Y-%m-%d %H:%M:%S') AS dts, sat::VARCHAR AS satellite, string_agg('0' || chan, ',' ORDER BY event_id) AS channels, string_agg(path, ',' ORDER BY event_id) AS files, 'sector' || sat AS sector
FROM files WHERE sat < 15 AND chan < 5 GROUP BY dts, sat""")
def q89_geostationary_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """A task for each hour and satellite, with the channels and files that have a header, a channel and a sector."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    name = F.concat(F.date_format("ts", "yyyyDDDHH"), F.lit("0000i"), F.col("user_id") % 4 + 12, F.lit(".c0"), F.col("event_id") % 5 + 1)
    files = events.select(F.concat(F.lit("/in/"), "event_id", F.lit("/"), name).alias("path"), F.col("event_id").alias("dir_pos"), name.alias("name"))
    headers = files.select("path", F.lit(10).cast("long").alias("num_line"), F.lit(20).cast("long").alias("num_elem"))
    channels = spark.createDataFrame([(f"0{i}", "kind") for i in range(1, 5)], "channel string, kind string")
    sectors = spark.createDataFrame([(str(i), "10x20", f"sector{i}") for i in (12, 13, 14)], "satellite string, sector_id string, sector_name string")
    tasks = plugins.geostationary_tasks(files, headers, channels, sectors)[0]
    return tasks.select(text_of("dts").alias("dts"), "satellite", F.array_join("channels", ",").alias("channels"), F.array_join("files", ",").alias("files"), F.col("sector.name").alias("sector"))


@query("""WITH recent AS (SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 12:30:00' - INTERVAL 43200 SECOND)
SELECT '2024-01-20 12:00:00' AS dts, '2024-01-20 00:00:00' AS start, (SELECT string_agg('/in/v' || event_id, ',' ORDER BY event_id) FROM recent WHERE event_type = 'view') AS tracks,
'/in/gfs.2024012006.pgrb2.0p25.f000' AS gfs, (SELECT string_agg('/in/c' || event_id, ',' ORDER BY event_id) FROM recent WHERE event_type = 'click') AS images,
(SELECT string_agg('/in/p' || event_id, ',' ORDER BY event_id) FROM recent WHERE event_type = 'purchase') AS soundings""")
def q90_storm_task(spark: SparkSession, sf: str) -> DataFrame:
    """The task of a run: three kinds of recently modified files and the newest forecast run within the look-back."""
    events = table(spark, sf, "events").select("event_id", utc("ts").alias("modified"), "event_type")
    of = lambda kind, mark: events.filter(F.col("event_type") == kind).select(F.concat(F.lit(f"/in/{mark}"), "event_id").alias("path"), F.lit(0).alias("dir_pos"), F.col("event_id").alias("name"), "modified")
    days = events.select(F.date_format("modified", "yyyyMMdd").alias("day")).distinct()
    runs = days.select(F.explode(F.transform(F.array(F.lit("00"), F.lit("06")), lambda h: F.concat(F.lit("gfs."), F.col("day"), h, F.lit(".pgrb2.0p25.f000")))).alias("name")).filter("name < 'gfs.2024012012'")
    forecasts = runs.select(F.concat(F.lit("/in/"), "name").alias("path"), "name")
    run = F.lit("2024-01-20 12:30:00").cast("timestamp")
    task = plugins.storm_tasks(of("view", "v"), forecasts, of("click", "c"), of("purchase", "p"), run)
    lists = [F.array_join(c, ",").alias(c) for c in ("tracks", "images", "soundings")]
    return task.select(text_of("dts").alias("dts"), text_of("job_coverage_start").alias("start"), "gfs", *lists)


@query("""SELECT o_orderkey, 'o' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '.stderr' ELSE '.stdout' END AS name FROM orders WHERE o_orderkey % 3 < 2""")
def q91_kept_names(spark: SparkSession, sf: str) -> DataFrame:
    """only logs are kept; the other names would go."""
    ending = F.when(F.col("o_orderkey") % 3 == 0, ".stderr").when(F.col("o_orderkey") % 3 == 1, ".stdout").otherwise(".tmp")
    files = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("o"), "o_orderkey", ending).alias("name"))
    gone = select.by_name(files, r".*\.std(err|out)$", negate=True)
    return files.join(gone, "o_orderkey", "left_anti")


@query("""SELECT p_partkey, '/work/' || p_brand || '/f' || p_partkey || '.out' AS path, '/work/' || p_brand || '/f' || p_partkey || '_' || lower(p_brand) || '.out' AS new_path,
'{"name":"f' || p_partkey || '","size":' || p_size || '}' AS params FROM part""")
def q92_published(spark: SparkSession, sf: str) -> DataFrame:
    """New names of finished files in their folders, and the parameters of a conversion as JSON."""
    from tidemark.sources import sinks

    parts = table(spark, sf, "part")
    files = parts.select("p_partkey", F.concat(F.lit("/work/"), "p_brand", F.lit("/f"), "p_partkey", F.lit(".out")).alias("path"), F.lower("p_brand").alias("sector"))
    stem = F.regexp_extract(strings.base_name(F.col("path")), r"^(.*)\.[^.]*$", 1)
    named = sinks.published_names(files.select("path", "sector"), F.concat(stem, F.lit("_"), "sector", strings.extension(F.col("path"))))
    params = sinks.params_json(F.struct(F.concat(F.lit("f"), "p_partkey").alias("name"), F.col("p_size").alias("size")))
    made = parts.select(F.concat(F.lit("/work/"), "p_brand", F.lit("/f"), "p_partkey", F.lit(".out")).alias("path"), "p_partkey", params.alias("params"))
    return made.join(named, "path").select("p_partkey", "path", "new_path", "params")


@query("""WITH fields AS (SELECT kind, short, level FROM (VALUES ('UGRD', 'u'), ('VGRD', 'v'), ('HGT', 'height'), ('TMP', 'temp'), ('RH', 'relh')) AS k(kind, short),
(SELECT unnest([70, 100, 150, 200, 250, 300, 400, 500, 600, 700, 850, 925, 1000]) AS level))
SELECT event_id, short || level AS field FROM (SELECT event_id, ['UGRD', 'VGRD', 'HGT', 'TMP', 'RH', 'CAPE'][1 + event_id % 6] AS kind, [70, 100, 500, 925, 1000, 975, 5][1 + event_id % 7] AS level FROM events) m
JOIN fields USING (kind, level)""")
def q93_wanted_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of forecast files by the table of wanted fields, in one scan."""
    from tidemark.sources.binaries import wanted_fields

    kinds, levels = F.array(*map(F.lit, ("UGRD", "VGRD", "HGT", "TMP", "RH", "CAPE"))), F.array(*map(F.lit, (70, 100, 500, 925, 1000, 975, 5)))
    descr = F.concat(F.col("event_id"), F.lit(":d=2024010100:"), kinds[(F.col("event_id") % 6).cast("int")], F.lit(":"), levels[(F.col("event_id") % 7).cast("int")], F.lit(" mb:anl:"))
    return wanted_fields(table(spark, sf, "events").select("event_id", descr.alias("descr")), spark).select("event_id", "field")


@query("""SELECT s_nationkey, string_agg(level::VARCHAR, ', ' ORDER BY level) AS known FROM (SELECT DISTINCT s_nationkey, (s_suppkey % 9)::DOUBLE AS level FROM supplier) GROUP BY s_nationkey""")
def q94_known_levels(spark: SparkSession, sf: str) -> DataFrame:
    """The levels that an error text lists, in order."""
    levels = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.collect_set((F.col("s_suppkey") % 9).cast("double")).alias("levels"))
    return levels.select("s_nationkey", arrays.sorted_levels(F.transform(F.array_sort("levels"), lambda x: x.cast("string"))).alias("known"))
