"""Files as rows: listings, directory patterns, and typed file names."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.strings import base_name, basin_name, fields, short_id
from tidemark.functions.times import parse_seconds

# The file-name patterns.
TRACK = r"^(?P<source>jtwc|nhc)_a(?P<stormId>(?P<basinId>\w{2})(?P<stormNum>\d{2})(?P<year>\d{4}))\.dat\.?(?P<createDTG>\d{12})$"
FORECAST = r"^gfs\.t(?P<hour>\d{2})z\.pgrb2\.1p00\.f(?P<fhour>\d{3})\.(?P<runDate>\d{8})$"
SATELLITE = r"^NPR-MIRS-(?P<type>SND|IMG)_(?P<version>\w+)_(?P<satellite>\w+)_s(?P<startDT>\d{14,15})_e(?P<endDT>\d{14,15})_c(?P<createDT>\d{14,15})\.nc$"
GEOSTATIONARY = r"^(?P<DTS>\d{13})i(?P<satellite>\d{2}).c(?P<channel>\d{2})$"
DUST = r"^(?P<DTS>\d{4}_\d{3}_\d{4})_MSG03(_\d{14})*.zip$"
FORECAST_QUARTER = r"^gfs.(?P<DTS>\d{10}).pgrb2.0p25.f(?P<fcst>\d{3})$"


def listing(spark: SparkSession, directories: list[str], pattern: str | None = None) -> DataFrame:
    """Path, dir_pos, name, modified and length of files directly in directories; names match from their start.

    Paths may be globs (S3). Only metadata is read: the content column is pruned. Order by dir_pos and name (O3).
    """
    from tidemark.operators.select import by_name

    rows = None
    for i, directory in enumerate(directories):
        one = spark.read.format("binaryFile").load(directory).select("path", F.lit(i).alias("dir_pos"), base_name(F.col("path")).alias("name"), F.col("modificationTime").alias("modified"), "length")
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        return spark.createDataFrame([], "path string, dir_pos int, name string, modified timestamp, length long")
    return by_name(rows, pattern) if pattern else rows


def tiers(path: str) -> str:
    """S3: a path whose tiers may be ^patterns$ as a glob that covers it; the exact test is ``tier_match``."""
    return "/".join("*" if t.startswith("^") else t for t in path.split("/"))


def tier_match(path: Column, template: str) -> Column:
    """S3: whether a directory path fits; a pattern tier matches as a prefix, other tiers as they are."""
    parts = F.split(path, "/")
    test = F.lit(True)
    for i, tier in enumerate(template.split("/")):
        part = F.get(parts, F.lit(i))
        test = test & (part.rlike("^(?:" + tier.strip("^$") + ")") if tier.startswith("^") else part == tier)
    return F.coalesce(test, F.lit(False))


@dataclass(frozen=True)
class NameKind:
    """A kind of file by its name's pattern, and the typed columns made of its fields."""

    pattern: str
    columns: dict = field(default_factory=dict)  # name -> function of the dict of field columns

    def read(self, files: DataFrame, strict: bool = True) -> DataFrame:
        """Adds the typed columns. ``strict``: a name that doesn't match is an error; else its columns are null."""
        found = fields(F.col("name"), self.pattern)
        if strict:
            first = next(iter(found))
            found[first] = F.coalesce(found[first], F.raise_error(F.concat(F.lit("file name doesn't match: "), F.col("name"))).cast("string"))
        made = {n: f(found) for n, f in self.columns.items()} if self.columns else found
        return files.select("*", *(c.alias(n) for n, c in made.items()))


def field_of(name: str, kind: str = "string"):  # noqa: ANN201
    return lambda f: f[name].cast(kind)


track = NameKind(TRACK, {  # S7
    "source": field_of("source"), "stormId": field_of("stormId"), "basinId": field_of("basinId"), "basin": lambda f: basin_name(f["basinId"]), "stormNum": field_of("stormNum", "int"),
    "year": field_of("year", "int"), "createDTG": lambda f: F.to_timestamp(f["createDTG"], "yyyyMMddHHmm"), "jtwcId": lambda f: short_id(f["stormNum"].cast("int"), f["basinId"]),
})
forecast = NameKind(FORECAST, {  # S8
    "hour": field_of("hour", "int"), "fhour": field_of("fhour", "int"), "runDTG": lambda f: F.to_timestamp(F.concat(f["runDate"], f["hour"]), "yyyyMMddHH"),
})
satellite = NameKind(SATELLITE, {  # S9
    "type": field_of("type"), "version": field_of("version"), "satellite": field_of("satellite"),
    "startDT": lambda f: parse_seconds(f["startDT"]), "endDT": lambda f: parse_seconds(f["endDT"]), "createDT": lambda f: parse_seconds(f["createDT"]),
})
geostationary = NameKind(GEOSTATIONARY, {"DTS": lambda f: F.to_timestamp(f["DTS"], "yyyyDDDHHmmss"), "satellite": field_of("satellite"), "channel": field_of("channel")})
dust = NameKind(DUST, {"DTS": lambda f: F.to_timestamp(f["DTS"], "yyyy_DDD_HHmm")})
forecast_quarter = NameKind(FORECAST_QUARTER, {"DTS": lambda f: F.to_timestamp(f["DTS"], "yyyyMMddHH"), "fcst": field_of("fcst", "int")})
KINDS = {"track": track, "forecast": forecast, "satellite": satellite, "geostationary": geostationary, "dust": dust, "forecast_quarter": forecast_quarter}
