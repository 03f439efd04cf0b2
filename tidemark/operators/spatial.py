"""Selection around moving targets in space and time.

A pure range join would compare every target with every sample. Samples and boxes share integer cells as wide as the box
(and time slots), so a box touches at most three cells in each direction, and the join has an equi-key; exact predicates
follow. Cells that hold more samples than a bound are cut into eight parts (north and south, east and west, early and
late), again and again where a part still holds more; what stays too large at the deepest level, such as one place at one
time, is dealt out by a hash, and the targets go to each share.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scan import MOST_BROADCAST, segmented_scan
from tidemark.session import scratch

DEPTH = 8  # how often a busy cell is cut at most
MOST_SAMPLES = 1_000_000  # samples of one key of the range join
KEY = ["_y", "_x", "_t", "_d", "_ly", "_lx", "_lt", "_share"]


@dataclass(frozen=True)
class Box:
    height: float = 28.0
    width: float = 28.0
    before: int = 21_600  # seconds
    slot: int = 21_600  # seconds in a time slot of the key


def lon_apart(a: Column, b: Column) -> Column:
    """Shortest signed distance in longitude, -180 to 180: crosses the date line."""
    return F.pmod(a - b + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def cells_of(samples: DataFrame, box: Box) -> DataFrame:
    """Samples with their cell (_y, _x, _t) and their place in it (_fy, _fx, _ft: the parts at the deepest level)."""
    width = 360.0 / lon_cells(box)
    y, x = F.col("lat") / F.lit(box.height), F.pmod(F.col("lon"), F.lit(360.0)) / F.lit(width)
    t = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(box.slot * 1_000_000.0)
    fine = lambda v: F.least(F.floor((v - F.floor(v)) * (1 << DEPTH)), F.lit((1 << DEPTH) - 1)).cast("int")
    cells = {"_y": F.floor(y).cast("int"), "_x": (F.floor(x).cast("int") % lon_cells(box)), "_t": F.floor(t).cast("long")}
    return samples.withColumns(cells | {"_fy": fine(y), "_fx": fine(x), "_ft": fine(t)})


def lon_cells(box: Box) -> int:
    return max(1, int(360.0 // box.width))


def leaves_of(placed: DataFrame, most: int) -> DataFrame:
    """The parts into which cells with more than ``most`` samples are cut: cell, deepest part, and the leaf (_d, _ly, _lx, _lt,
    _shares) that holds it. A row for each part of such a cell that has samples: counts are added up before they are dealt."""
    cell, fine = ["_y", "_x", "_t"], ["_fy", "_fx", "_ft"]
    counts = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(*cell)
    parts = placed.select(*cell, *fine).join(counts, cell, "left_semi").groupBy(*cell, *fine).agg(F.count(F.lit(1)).alias("_n"))
    up = lambda c, d: F.call_function("shiftright", F.col(c), F.lit(DEPTH) - d)
    levels = parts.withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))))
    levels = levels.withColumns({f"_l{c[2]}": up(c, F.col("_d")) for c in fine})
    node = [*cell, "_d", "_ly", "_lx", "_lt"]
    sizes = levels.groupBy(*node).agg(F.sum("_n").alias("_size"))
    held = levels.join(sizes, node)
    first = F.min_by(F.struct("_d", "_ly", "_lx", "_lt", "_size"), F.when(F.col("_size") <= most, F.col("_d")).otherwise(F.lit(DEPTH)))
    leaf = held.filter((F.col("_size") <= most) | (F.col("_d") == DEPTH)).groupBy(*cell, *fine).agg(first.alias("_leaf"))
    shares = F.ceil(F.col("_leaf._size") / F.lit(most)).cast("int").alias("_shares")
    return leaf.select(*cell, *fine, "_leaf._d", "_leaf._ly", "_leaf._lx", "_leaf._lt", shares)


def spread(targets: DataFrame, samples: DataFrame, box: Box, after: str, most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns of their common key, KEY: at most ``most`` samples, as far as they hash evenly, have one."""
    n, width = lon_cells(box), 360.0 / lon_cells(box)
    cell = lambda x, w: F.floor(x / F.lit(w)).cast("int")
    slot = lambda t: F.floor(F.unix_micros(t.cast("timestamp")) / F.lit(box.slot * 1_000_000.0)).cast("long")
    start, end = F.col("t_ts") - F.make_interval(secs=F.lit(box.before)), F.col("t_ts") + F.make_interval(secs=F.col(after))
    t = targets.filter("t_lat IS NOT NULL AND t_lon IS NOT NULL AND t_ts IS NOT NULL")
    t = t.withColumn("_y", F.explode(F.sequence(cell(F.col("t_lat") - box.height / 2, box.height), cell(F.col("t_lat") + box.height / 2, box.height))))
    xs = F.transform(F.sequence(cell(F.col("t_lon") - box.width / 2, width), cell(F.col("t_lon") + box.width / 2, width)), lambda x: F.pmod(x, F.lit(n)).cast("int"))
    t = t.withColumn("_x", F.explode(F.array_distinct(xs))).withColumn("_t", F.explode(F.sequence(slot(start), slot(end))))
    s = cells_of(samples, box)
    path = scratch(samples.sparkSession, "leaves")
    leaves_of(s, most).write.parquet(path)
    leaves = samples.sparkSession.read.parquet(path)
    parts = leaves.count()
    whole = {c: F.lit(0) for c in ("_d", "_ly", "_lx", "_lt", "_share")}
    if not parts:
        return t.withColumns(whole), s.drop("_fy", "_fx", "_ft").withColumns(whole)
    hint = F.broadcast if parts <= MOST_BROADCAST else (lambda df: df)
    fine = ["_y", "_x", "_t", "_fy", "_fx", "_ft"]
    s = s.join(hint(leaves), fine, "left").withColumn("_share", F.when(F.col("_shares") > 1, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_shares")).cast("int")))
    s = s.drop("_fy", "_fx", "_ft", "_shares").fillna(0, ["_d", "_ly", "_lx", "_lt", "_share"])
    cut = leaves.select("_y", "_x", "_t", "_d", "_ly", "_lx", "_lt", "_shares").distinct()
    t = t.join(hint(cut), ["_y", "_x", "_t"], "left").fillna(0, ["_d", "_ly", "_lx", "_lt"])
    part = F.lit(1.0) / F.call_function("shiftleft", F.lit(1), F.col("_d"))
    middle = lambda base, c, size: (base + (F.col(c) + 0.5) * part) * F.lit(size)
    reach = lambda own, size: own / 2 + F.lit(size) * part / 2 + 1e-6
    touches = F.abs(middle(F.col("_y"), "_ly", box.height) - F.col("t_lat")) <= reach(F.lit(box.height), box.height)
    touches &= F.abs(lon_apart(middle(F.col("_x"), "_lx", width), F.col("t_lon"))) <= reach(F.lit(box.width), width)
    seconds = lambda ts: F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)
    touches &= (F.col("_t") + F.col("_lt") * part) * box.slot <= seconds(end) + 1e-3
    touches &= (F.col("_t") + (F.col("_lt") + 1) * part) * box.slot >= seconds(start) - 1e-3
    t = t.filter(touches).withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))).drop("_shares")
    return t, s


def range_join(targets: DataFrame, samples: DataFrame, box: Box = Box(), after: str = "after", most: int = MOST_SAMPLES) -> DataFrame:
    """Samples (lat, lon, ts, ...) within each target's box and time (t_lat, t_lon, t_ts and ``after`` in seconds).

    Both ends are inclusive; longitudes may be signed or positive. Rows with a null coordinate or time match nothing. No key
    of the join has more than about ``most`` samples, however many share a place and time.
    """
    samples = samples.filter("lat IS NOT NULL AND lon IS NOT NULL AND ts IS NOT NULL")
    start, end = F.col("t_ts") - F.make_interval(secs=F.lit(box.before)), F.col("t_ts") + F.make_interval(secs=F.col(after))
    t, s = spread(targets, samples, box, after, most)
    near = (F.abs(F.col("lat") - F.col("t_lat")) <= box.height / 2) & (F.abs(lon_apart(F.col("lon"), F.col("t_lon"))) <= box.width / 2) & F.col("ts").between(start, end)
    return t.join(s, KEY).filter(near).drop(*KEY)


def value_range_join(left: DataFrame, right: DataFrame, a: str, b: str, width: float, most: int = MOST_SAMPLES) -> DataFrame:
    """J8 in one dimension: pairs whose values differ by at most ``width``, through cells of that width.

    A cell with more than ``most`` right rows is dealt out in shares, and left rows go to each. Nulls match nothing.
    """
    cells = F.floor(F.col(a) / F.lit(width)).cast("long")
    l_ = left.withColumn("_c", F.explode(F.array(cells - 1, cells, cells + 1)))
    r = right.filter(F.col(b).isNotNull()).withColumn("_c", F.floor(F.col(b) / F.lit(width)).cast("long"))
    path = scratch(right.sparkSession, "shares")
    r.groupBy("_c").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_shares")).filter("_shares > 1").write.parquet(path)
    busy = right.sparkSession.read.schema("_c long, _shares int").parquet(path)
    n = busy.count()
    if n:
        busy = F.broadcast(busy) if n <= MOST_BROADCAST else busy
        shares = F.coalesce("_shares", F.lit(1))
        l_ = l_.join(busy, "_c", "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")
        r = r.join(busy, "_c", "left").withColumn("_share", F.pmod(F.xxhash64(F.monotonically_increasing_id()), shares).cast("int")).drop("_shares")
    keys = ["_c", "_share"] if n else ["_c"]
    return l_.join(r, keys).filter(F.abs(F.col(a) - F.col(b)) <= width).drop(*keys)


def nearest_value(left: DataFrame, right: DataFrame, a: str, b: str, width: float, pos: str) -> DataFrame:
    """J8 in one dimension, with J10's choice: for each left row the right row nearest in value, at most ``width`` away; of equal ones the first by ``pos``.

    Pairs within ``width`` grow with the product of both sides. Here both are put in order together, a right row for each
    value, and two scans fill in the one below and the one above. Repeated left rows each have a result; those without a match
    go; nulls and NaN match nothing. Distances are those of the columns' type; of two right values on one side that are
    apart by less than the rounding of a distance, the nearer counts.
    """
    if clash := sorted(set(left.columns) & set(right.columns)):
        raise ValueError(f"columns of both sides: {clash}")
    r = right.filter(F.col(b).isNotNull()).filter(F.col(b) <= F.lit(float("inf"))).groupBy(F.col(b).alias("v"))
    r = r.agg(F.min_by(F.struct(*right.columns), pos).alias("r")).withColumn("tie", F.lit(0).cast("long"))
    tie = F.xxhash64(F.monotonically_increasing_id())  # so that left rows of one value can go to several ranges
    l_ = left.filter(F.col(a).isNotNull()).select(F.col(a).alias("v"), F.struct(*left.columns).alias("l"), tie.alias("tie"))
    both = l_.unionByName(r, allowMissingColumns=True).withColumn("k", F.lit(0))
    own = F.col("l").isNotNull()  # right rows come before left ones of their value
    down = segmented_scan(both, ["k"], [F.col("v"), own, F.col("tie")], fill={"below": "r"})
    near = segmented_scan(down, ["k"], [F.col("v").desc(), own, F.col("tie")], fill={"above": "r"}).filter("l IS NOT NULL")
    at = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"l.{a}") - F.col(f"{c}.{b}")).alias("d"), F.col(f"{c}.{pos}").alias("p"), F.col(c).alias("row")))
    near = near.withColumns({"one": at("below"), "two": at("above")})
    second = F.col("one").isNull() | (F.col("two.d") < F.col("one.d")) | ((F.col("two.d") == F.col("one.d")) & (F.col("two.p") < F.col("one.p")))
    best = near.withColumn("best", F.when(F.coalesce(second, F.lit(False)), F.col("two")).otherwise(F.col("one"))).filter(F.col("best.d") <= width)
    return best.select("l.*", "best.row.*")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], lts: str, rts: str, pos: str, within: int) -> DataFrame:
    """For each left row the right row nearest in time, at most ``within`` seconds away; of equal ones the first by ``pos``.

    Slots of ``within`` seconds make an equi-key, so a left row meets three slots and not a key's whole history. Repeated
    left rows each have a result; those without a match go.
    """
    own = left.columns
    left = left.withColumn("_row", F.monotonically_increasing_id())
    at = F.unix_micros(F.col(lts).cast("timestamp"))
    there = F.unix_micros(F.col(rts).cast("timestamp"))
    slot = lambda x: F.floor(x / (within * 1_000_000)).cast("long")
    l_ = left.withColumn("_at", at).withColumn("_slot", F.explode(F.array(slot(F.col("_at")) - 1, slot(F.col("_at")), slot(F.col("_at")) + 1)))
    r = right.withColumn("_there", there).withColumn("_slot", slot(F.col("_there")))
    extra = [c for c in right.columns if c not in keys]
    near = l_.join(r, [*keys, "_slot"]).withColumn("_d", F.abs(F.col("_at") - F.col("_there"))).filter(F.col("_d") <= within * 1_000_000)
    best = near.groupBy(*left.columns).agg(F.min_by(F.struct(*extra), F.struct("_d", pos)).alias("_r"))
    return best.select(*own, *(F.col(f"_r.{c}").alias(c) for c in extra))


def nearest_ever(left: DataFrame, right: DataFrame, keys: list[str], lts: str, rts: str, pos: str) -> DataFrame:
    """J10 without a bound in time: for each left row the right row of its key nearest in time; of equal ones the first by ``pos``.

    Both sides are put in order together; a scan fills the last right row down, one in reverse order the next one up. A key's
    rows may lie in many tasks. Repeated left rows each have a result; those whose key has no right row, or whose time is
    null, go; right rows without a time match nothing. ``pos`` is a number.
    """
    extra = [c for c in right.columns if c not in keys]
    if clash := sorted(set(extra) & set(left.columns)):
        raise ValueError(f"columns of both sides: {clash}")
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias("t")
    l_ = left.filter(F.col(lts).isNotNull()).select(*keys, at(lts), F.lit(None).cast("double").alias("p"), F.struct(*left.columns).alias("l"))
    r = right.filter(F.col(rts).isNotNull()).select(*keys, at(rts), F.col(pos).cast("double").alias("p"), F.struct(*extra).alias("r"))
    r = r.withColumn("r", F.struct("t", "p", F.col("r").alias("row")))
    both = l_.unionByName(r, allowMissingColumns=True)
    later = F.col("p").desc_nulls_last()  # of right rows at one time the first comes last; left rows follow them all
    down = segmented_scan(both, keys, [F.col("t"), later], fill={"before": "r"})
    up = segmented_scan(down, keys, [F.col("t").desc(), later], fill={"behind": "r"}).filter("l IS NOT NULL")
    apart = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("t") - F.col(f"{c}.t")).alias("d"), F.col(f"{c}.p").alias("p"), F.col(f"{c}.row").alias("row")))
    first, second = apart("before"), apart("behind")
    closer = (first["d"] < second["d"]) | ((first["d"] == second["d"]) & (first["p"] <= second["p"]))
    best = F.when(second.isNull() | closer, first).otherwise(second)
    return up.withColumn("best", best).filter("best IS NOT NULL").select("l.*", *(F.col(f"best.row.{c}").alias(c) for c in extra))
