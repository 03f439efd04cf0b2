"""Names, templates and patterns as columns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters of date formats, with the pattern that matches each and its width in digits.
DATE_FIELDS = {
    "%Y": r"\d{4}", "%y": r"\d{2}", "%m": r"\d{2}", "%w": r"\d{1}", "%j": r"\d{3}", "%d": r"\d{2}", "%H": r"\d{2}", "%M": r"\d{2}", "%S": r"\d{2}",
}
BASINS = {"al": "Atlantic", "ep": "Eastern Pacific", "cp": "Central Pacific", "wp": "Western Pacific", "io": "Indian Ocean", "sh": "Southern Hemisphere"}


def named_groups(pattern: str) -> list[str]:
    return re.findall(r"\(\?P?<(\w+)>", pattern)


def java_pattern(pattern: str) -> str:
    """A pattern with named groups, anchored at its start, as Spark takes it."""
    plain = pattern.replace("(?P<", "(?<")
    return plain if plain.startswith("^") else f"^{plain}"


def fields(text: Column, pattern: str) -> dict[str, Column]:
    """A column for each named group, null where the pattern doesn't match."""
    java = java_pattern(pattern)
    names = named_groups(pattern)
    order = [m.group(1) for m in re.finditer(r"\((?:\?P?<(\w+)>|(?!\?))", pattern)]  # None for plain groups
    return {n: F.when(text.rlike(java), F.regexp_extract(text, java, order.index(n) + 1)) for n in names}


def alternation(values: Column) -> Column:
    """(a|b) of distinct values, sorted."""
    return F.concat(F.lit("("), F.array_join(F.array_sort(F.array_distinct(values)), "|"), F.lit(")"))


def filled(template: Column, scalars: dict[str, Column], lists: dict[str, Column] | None = None, left: str = "%", right: str = "") -> Column:
    """Keys between delimiters replaced by strings, or by the alternation of a list; a template with lists is anchored at both ends."""
    out = reduce(lambda t, kv: F.replace(t, F.lit(left + kv[0] + right), kv[1]), scalars.items(), template)
    for key, values in (lists or {}).items():
        out = F.replace(out, F.lit(left + key + right), alternation(values))
    return F.concat(F.lit("^"), out, F.lit("$")) if lists else out


def date_format_pattern(text: Column) -> Column:
    """C4: a date format as a regular expression."""
    return reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), DATE_FIELDS.items(), text)


def date_format_printf(text: Column) -> Column:
    """C4: a date format as a printf format of zero-padded integers; a field of one digit is %d."""
    width = {k: re.search(r"\{(\d)\}", v).group(1) for k, v in DATE_FIELDS.items()}
    one_digit_last = sorted(width.items(), key=lambda kv: kv[1] == "1")  # its %d is a field of dates itself
    return reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit("%d" if kv[1] == "1" else f"%0{kv[1]}d")), one_digit_last, text)


def path_parts(path: Column) -> Column:
    """Components, the root as '/'."""
    return F.filter(F.concat(F.when(path.startswith("/"), F.array(F.lit("/"))).otherwise(F.array().cast("array<string>")), F.split(path, "/")), lambda x: x != "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """With its dot; empty for none and for names that only begin with one."""
    return F.regexp_extract(base_name(path), r"^.+?(\.[^.]*)$", 1)


def short_id(number: Column, basin: Column) -> Column:
    """The number, unpadded, and the basin's first letter."""
    return F.concat(number.cast("string"), F.upper(F.substring(basin, 1, 1)))


def basin_name(code: Column) -> Column:
    """An error for unknown codes."""
    known = F.create_map(*(F.lit(x) for kv in BASINS.items() for x in kv))[code]
    return F.when(code.isNull() | known.isNotNull(), known).otherwise(F.raise_error(F.concat(F.lit("unknown basin "), code)).cast("string"))


def source_of(basin: Column) -> Column:
    """C13."""
    return F.when(basin.isin("al", "ep"), F.lit("nhc")).otherwise(F.lit("jtwc"))


def split_header(line: Column) -> Column:
    """C11."""
    return F.split(F.rtrim(line), " +")


def key_value(line: Column) -> Column:
    """Key and value of a line with exactly one '='; an error otherwise."""
    parts = F.split(F.rtrim(line), "=")
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("key"), parts[1].alias("value"))).otherwise(F.struct(F.raise_error(F.concat(F.lit("not key=value: "), line)).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))


def padded(value: Column, fmt: str) -> Column:
    """Printf with the C rules, except that ties round half up."""
    return F.format_string(fmt, value)


def product_name(storm: Column, version: Column, satellite: Column, start: Column, end: Column, created: Column, variable: Column | None = None, level: Column | None = None) -> Column:
    """TC-<storm>[-<var>-<level>]_<version>_<satellite>_s<start>_e<end>_c<created>."""
    head = F.concat_ws("-", F.lit("TC"), storm, *([variable] if variable is not None else []), *([level] if level is not None else []))
    stamp = lambda c: F.date_format(c, "yyyyMMddHHmmss")
    return F.concat_ws("_", head, version, satellite, F.concat(F.lit("s"), stamp(start)), F.concat(F.lit("e"), stamp(end)), F.concat(F.lit("c"), stamp(created)))


def track_name(name: Column, basin: Column, modified: Column) -> Column:
    """A track file with its source before it and its time after it."""
    return F.concat(source_of(basin), F.lit("_"), name, F.lit("."), F.date_format(modified, "yyyyMMddHHmm"))


def forecast_name(run: Column, hour: Column) -> Column:
    """A forecast file's name from its run and forecast hour."""
    return F.concat(F.lit("gfs.t"), F.date_format(run, "HH"), F.lit("z.pgrb2.1p00.f"), F.lpad(hour.cast("string"), 3, "0"), F.lit("."), F.date_format(run, "yyyyMMdd"))


def storm_id(basin: Column, number: Column, year: Column) -> Column:
    """Basin in upper case, number and year."""
    return F.concat(F.upper(basin), number.cast("string"), year.cast("string"))


def absolute(base: Column, path: Column) -> Column:
    """A path below ``base`` unless it is absolute already; a null base is an error for others."""
    joined = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), path)
    return F.when(path.startswith("/"), path).when(base.isNull(), F.raise_error(F.concat(F.lit("no base for "), path)).cast("string")).otherwise(joined)


def random_id(size: int = 8) -> Column:
    """A random id of up to 32 hexadecimal characters; another one for each row and run."""
    return F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, size)


def cut_at(text: Column, places: dict[str, tuple[int, int]]) -> dict[str, Column]:
    """C14: substrings at fixed places, name -> (start from 1, length)."""
    return {n: F.substring(text, start, size) for n, (start, size) in places.items()}
