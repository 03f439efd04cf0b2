"""Mixing sources to target weights, with DataFrame functions only.

A source's words, document after document, form fixed-length blocks. Output shards draw how many blocks they take from
each source; a source's draws are numbered through all shards, and a keyed permutation of its block numbers turns the
numbers into blocks, one pass over the source after the other. Documents then join the drawn blocks by number.

The counts of the shards are a multinomial draw, given that each source's sum over all shards is its target: a keyed
permutation, a Feistel network, deals as many slots as each source has over the shards. So shards differ by chance and sources meet their
targets to a block. A block is never taken in more than ``max_repeats`` passes, so no document is.

Sources are few beside documents: a table of one row for each is put in order by one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import written

PRIME = 2_147_483_647
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    max_repeats: int = 3
    block_words: int = 64
    shard_slots: int = 4096
    buckets: int = 1024  # of a source's documents, and one more for each ``bucket_rows`` documents
    bucket_rows: int = 1_000_000
    cells: int = 4096
    rounds: int = 12  # of the permutation of blocks
    deal_rounds: int = 4  # of the permutation of slots
    seed: int = 7

    def round_keys(self, rounds: int | None = None) -> list[tuple[int, int, int, int]]:
        """Of each round of a permutation two multipliers and two offsets, from a linear congruence."""
        out, x = [], self.seed
        for _ in range(self.rounds if rounds is None else rounds):
            row = []
            for _ in range(4):
                x = (x * 48271 + 11) % PRIME
                row.append(x)
            out.append(tuple(row))
        return out


def sized(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *keep: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    buckets = mix.buckets + docs.count() // mix.bucket_rows
    bucket = (F.pmod(F.coalesce(F.col(id_col), F.lit(-1)), F.lit(PRIME)) * 48271 + mix.seed) % PRIME % buckets
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), bucket.alias("bucket"), *keep)


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: sid (its place by code point, null last), source, source_size, target, blocks, slots.

    The shares are those at which no target is over ``max_repeats`` times its source: in the order of size by weight, the
    first sources whose fair share would be over stop there, and the rest share what is left.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("sid") % len(mix.weights) + 1).cast("int"))
    cap = F.col("source_size") * mix.max_repeats
    per = per.withColumn("weight", weight.cast("long")).withColumn("cap", cap)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = per.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("share", F.sum("weight").over(rest))
    per = per.withColumn("level", F.col("left").cast("double") / F.col("share"))
    fair = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "sid", "level"))).over(everything)
    per = per.withColumn("fair", fair["level"])
    per = per.withColumn("target", F.when(F.col("fair").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("fair") * F.col("weight"), F.col("cap").cast("double"))))
    blocks = F.ceil(F.col("source_size") / mix.block_words)
    per = per.withColumn("blocks", blocks)
    slots = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    return per.select("sid", "source", "source_size", "target", "blocks", slots.alias("slots"))


def permuted(i: Column, n: Column, key: Column, mix: Mix) -> Column:
    """A permutation of 0 to n - 1 (swap-or-not): each round pairs i with K - i mod n, and a bit of the larger decides whether to swap."""
    keys = F.array(*(F.array(*(F.lit(v).cast("long") for v in row)) for row in mix.round_keys()))

    def step(x: Column, k: Column) -> Column:
        own = (key + 1) % PRIME
        other = F.pmod((k[0] * own + k[1]) % PRIME * PRIME + (k[2] * own + k[3]) % PRIME - x, n)
        bit = (k[2] * (F.greatest(x, other) % PRIME) + k[3] + key) % PRIME % 2
        return F.when(bit == 1, other).otherwise(x)

    return F.aggregate(keys, i.cast("long"), step)


def permuted_sql(i: str, n: str, key: str, mix: Mix) -> str:
    """``permuted`` in DuckDB's SQL."""
    keys, p = ", ".join(f"[{', '.join(map(str, row))}]" for row in mix.round_keys()), PRIME
    own = f"(({key} + 1) % {p})"
    other = f"((((r[1] * {own} + r[2]) % {p} * {p} + (r[3] * {own} + r[4]) % {p} - x[1]) % {n} + {n}) % {n})"
    return f"list_reduce(list_prepend([{i}], [{keys}]), lambda x, r: [CASE WHEN (r[3] * (greatest(x[1], {other}) % {p}) + r[4] + {key}) % {p} % 2 = 1 THEN {other} ELSE x[1] END])[1]"


def sides(total: int) -> tuple[int, int]:
    """A square that holds ``total`` slots, and less than one more row."""
    rows = max(1, math.ceil(math.sqrt(total)))
    return rows, -(-total // rows)


def dealt(slots: DataFrame, total: int, mix: Mix) -> DataFrame:
    """Adds p, a permutation of the numbers below rows * columns of ``sides``: a Feistel network over row and column of ``id``,
    whose rounds add a quadratic function of one to the other in turn."""
    na, nb = sides(total)
    rounds = [(*row, r % 2) for r, row in enumerate(mix.round_keys(mix.deal_rounds))]
    keys = F.array(*(F.array(*(F.lit(v).cast("long") for v in row)) for row in rounds))

    def step(s: Column, k: Column) -> Column:
        even = k[4] == 0
        y = (F.when(even, s["b"]).otherwise(s["a"]) * k[0] + k[1]) % PRIME
        more = ((y * y + k[2]) % PRIME * k[3] + y) % PRIME
        return F.struct(F.when(even, (s["a"] + more) % na).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise((s["b"] + more) % nb).alias("b"))

    start = F.struct(F.floor(F.col("id") / F.lit(nb)).cast("long").alias("a"), (F.col("id") % nb).cast("long").alias("b"))
    return slots.withColumn("p", F.aggregate(keys, start, step, lambda s: s["a"] * nb + s["b"]))


def dealt_sql(i: str, na: str, nb: str, mix: Mix) -> str:
    """``dealt`` in DuckDB's SQL, from and to a number below na * nb."""
    keys = ", ".join(f"[{', '.join(map(str, row))}, {r % 2}]" for r, row in enumerate(mix.round_keys(mix.deal_rounds)))
    y = f"((CASE WHEN r[5] = 0 THEN x[2] ELSE x[1] END * r[1] + r[2]) % {PRIME})"
    more = f"((({y} * {y} + r[3]) % {PRIME} * r[4] + {y}) % {PRIME})"
    step = f"CASE WHEN r[5] = 0 THEN [(x[1] + {more}) % {na}, x[2]] ELSE [x[1], (x[2] + {more}) % {nb}] END"
    return f"list_reduce(list_prepend([{i} // {nb}, {i} % {nb}], [{keys}]), lambda x, r: {step})"


RUN_SHARDS = 1024  # shards whose draws are numbered in one window


def draws(sources: DataFrame, mix: Mix) -> DataFrame:
    """sid, block and passes: the numbers of the passes over the source in which the mix takes the block (a bit for each)."""
    spark = sources.sparkSession
    whole = F.floor(F.col("slots") + 0.5)
    total = int(sources.agg(F.coalesce(F.sum(whole), F.lit(0)).alias("n")).first()["n"])
    spans = sources.select("sid", "blocks", whole.alias("n")).filter("n > 0")
    spans = spans.withColumn("hi", F.sum("n").over(Window.orderBy("sid"))).withColumn("lo", F.col("hi") - F.col("n")).drop("n")
    cell = lambda p: F.floor(p * mix.cells / total) if total else p
    spans = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))))
    rows, columns = sides(total)  # the slots that this is more than ``total`` stay empty
    slot = dealt(spark.range(rows * columns), total, mix).select(F.floor(F.col("id") / mix.shard_slots).alias("shard"), "p")
    counts = slot.withColumn("cell", cell(F.col("p"))).join(spans, "cell").filter("p >= lo AND p < hi").groupBy("shard", "sid", "blocks").agg(F.count(F.lit(1)).alias("n"))
    # a source's draws are numbered within runs of shards, and runs by the draws of the runs before
    counts = counts.withColumn("run", F.floor(F.col("shard") / RUN_SHARDS))
    runs = counts.groupBy("sid", "run").agg(F.sum("n").alias("m"))
    runs = runs.select("sid", "run", (F.sum("m").over(Window.partitionBy("sid").orderBy("run")) - F.col("m")).alias("before"))
    counts = counts.withColumn("base", F.sum("n").over(Window.partitionBy("sid", "run").orderBy("shard")) - F.col("n"))
    counts = counts.join(runs, ["sid", "run"]).withColumn("base", F.col("base") + F.col("before"))
    counts = counts.repartition(max(1, total // 100_000), "sid", "shard")  # few small rows, but each makes many below
    taken = counts.select("sid", "blocks", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("n") - 1)).alias("k")).filter(F.col("k") < F.col("blocks") * mix.max_repeats)
    taken = taken.withColumn("pass", F.floor(F.col("k") / F.col("blocks")))
    block = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.col("sid") * mix.max_repeats + F.col("pass"), mix)
    return taken.select("sid", block.alias("block"), F.pow(F.lit(2), F.col("pass")).cast("int").alias("bit")).groupBy("sid", "block").agg(F.sum("bit").cast("int").alias("passes"))


def drawn_spans(sizes: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """A row per document and block it has words in: doc_id, sid, row (tells equal ids apart), size, start (in words of the document), words, passes (0: not taken).

    An empty document has one row with 0 words. Offsets within a source are prefix sums over hashed buckets of documents,
    so a hot source is many windows. A column "_row" of ``sizes`` stays.
    """
    own = [c for c in sizes.columns if c == "_row"]
    keyed = sizes.join(sources.select("sid", F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "source")
    totals = keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    totals = totals.withColumn("base", F.sum("n").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("n")).drop("n")
    order = Window.partitionBy("sid", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "size", *own)
    placed = keyed.withColumn("row", F.row_number().over(order)).withColumn("at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(totals, ["sid", "bucket"]).withColumn("at", F.col("at") + F.col("base"))
    b = mix.block_words
    numbers = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("at") / b), F.floor((F.col("at") + F.col("size") - 1) / b)))
    spread = placed.select("doc_id", "sid", "bucket", "row", *own, "size", "at", F.explode_outer(numbers).alias("block"))
    start = F.greatest(F.col("block") * b - F.col("at"), F.lit(0))
    end = F.least((F.col("block") + 1) * b - F.col("at"), F.col("size"))
    spread = spread.select("doc_id", "sid", "bucket", "row", *own, "size", "block", F.coalesce(start, F.lit(0)).alias("start"), F.coalesce(end - start, F.lit(0)).alias("words"))
    return spread.join(draws(sources, mix), ["sid", "block"], "left").withColumn("passes", F.coalesce("passes", F.lit(0)))


def mix_report(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``; taken counts repeats.

    A null text has size 0; a null source is a source of its own; rows with equal ids each have a result; a null id is
    kept. An empty table gives an empty result. Other columns are ignored.
    """
    sizes = written(sized(docs, mix, id_col, text_col, source_col), "sizes")
    sources = written(targets(sizes, mix), "sources")
    spans = drawn_spans(sizes, sources, mix)
    taken = spans.groupBy("doc_id", "sid", "bucket", "row", "size").agg(F.sum(F.col("words") * F.bit_count("passes")).cast("long").alias("taken"))
    return taken.join(sources.select("sid", "source_size", "target"), "sid").select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents that the mix takes, with the words it takes: for each pass the document's taken stretches in its own order.

    Passes are separated by a newline; stretches keep the white space between their words. Rows of which nothing is taken
    go. Rows with equal or null ids each have their own words; columns stay as they are, n_chars (if there) is that of the
    new text. A column "_row" of ``docs`` is not allowed.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")  # written once, so that a row keeps its number
    sizes = written(sized(rows, mix, id_col, text_col, source_col, "_row"), "sizes")
    sources = written(targets(sizes, mix), "sources")
    spans = drawn_spans(sizes, sources, mix).filter("passes > 0 AND words > 0")
    lists = spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "words", "passes"))).alias("_spans"))
    pieces = F.regexp_extract_all(text_col, F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))

    def one(x: Column, number: Column) -> Column:
        own = F.filter(x["spans"], lambda s: F.getbit(s["passes"], number) == 1)
        return F.rtrim(F.array_join(F.flatten(F.transform(own, lambda s: F.slice(x["words"], (s["start"] + 1).cast("int"), s["words"].cast("int")))), ""))

    def joined(x: Column) -> Column:
        return F.array_join(F.filter(F.transform(F.sequence(F.lit(0), F.lit(mix.max_repeats - 1)), lambda number: one(x, number)), lambda t: t != ""), "\n")

    # transform over one array of a struct, so that a text is split into words once and not for each of its stretches
    text = F.transform(F.array(F.struct(pieces.alias("words"), F.col("_spans").alias("spans"))), joined)[0]
    out = rows.join(lists, "_row").withColumn(text_col, text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast("long"))
    return out.select(*docs.columns)


def report_sql(mix: Mix = Mix()) -> str:
    """``mix_report`` over documents in DuckDB's SQL."""
    b, p = mix.block_words, PRIME
    deal = dealt_sql("i", "na", "nb", mix)
    block = permuted_sql("k % blocks", "blocks", "key", mix)
    return f"""
WITH sizes AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    (((coalesce(doc_id, -1) % {p}) + {p}) % {p} * 48271 + {mix.seed}) % {p} % ({mix.buckets} + count(*) OVER () // {mix.bucket_rows}) AS bucket FROM documents),
per AS (
  SELECT *, source_size * {mix.max_repeats} AS cap, list_extract({list(mix.weights)}, (sid % {len(mix.weights)} + 1)::INT)::BIGINT AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM sizes GROUP BY source)),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM per),
fair AS (SELECT level AS fair FROM levels WHERE level * weight <= cap ORDER BY cap / weight, sid LIMIT 1),
sources AS (
  SELECT sid, source, source_size, target, blocks, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0 END AS slots
  FROM (SELECT *, ceil(source_size / {b})::BIGINT AS blocks, coalesce(least((SELECT fair FROM fair) * weight, cap::DOUBLE), cap::DOUBLE) AS target FROM per)),
whole AS (SELECT sid, blocks, floor(slots + 0.5)::BIGINT AS n FROM sources),
spans AS (SELECT *, (sum(n) OVER (ORDER BY sid))::BIGINT AS hi FROM whole WHERE n > 0),
square AS (SELECT na, (total + na - 1) // na AS nb FROM (SELECT total, greatest(1, ceil(sqrt(total)))::BIGINT AS na FROM (SELECT sum(n)::BIGINT AS total FROM whole))),
slot AS (SELECT i // {mix.shard_slots} AS shard, x[1] * nb + x[2] AS p FROM (SELECT i, nb, {deal} AS x FROM (SELECT unnest(range(na * nb)) AS i, na, nb FROM square))),
counts AS (
  SELECT *, (sum(n) OVER (PARTITION BY sid ORDER BY shard))::BIGINT - n AS base
  FROM (SELECT shard, sid, blocks, count(*) AS n FROM slot JOIN spans ON p >= hi - spans.n AND p < hi GROUP BY ALL)),
taken AS (SELECT sid, blocks, unnest(range(base, base + n)) AS k FROM counts),
draws AS (
  SELECT sid, block, count(*) AS times FROM (
    SELECT sid, {block} AS block
    FROM (SELECT *, sid * {mix.max_repeats} + k // blocks AS key FROM taken WHERE k < blocks * {mix.max_repeats})) GROUP BY ALL),
keyed AS (SELECT s.*, sid, source_size, target FROM sizes s JOIN sources t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (SELECT *, (sum(size) OVER (PARTITION BY sid ORDER BY bucket, doc_id NULLS FIRST, size, r ROWS UNBOUNDED PRECEDING))::BIGINT - size AS pos FROM keyed),
spread AS (SELECT *, unnest(range(pos // {b}, (pos + size - 1) // {b} + 1)) AS block FROM placed WHERE size > 0),
words AS (SELECT r, sum((least((block + 1) * {b} - pos, size) - greatest(block * {b} - pos, 0)) * times) AS taken FROM spread JOIN draws USING (sid, block) GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN words USING (r)"""
