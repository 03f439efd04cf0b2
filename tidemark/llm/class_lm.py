"""Language-model scores of texts by Brown class-based bigrams: P(class | class before) * P(word | class).

Exchange clustering is a number of distributed sweeps over all words of the training texts. As many of the most frequent
words as there are classes start with a class each, the others with none. In a sweep the neighbours of every word are
counted by class over the whole corpus, and each word moves to the class that, to first order, raises the likelihood of
the class bigrams most; all move at once. The first sweep always stands, each later one only if it raises the
likelihood; sweeps end when one gains less than ``least_gain`` of it. Counts are whole numbers, so no class depends on how the texts are grouped.

Texts are staged in groups of about ``group_bytes``, each a file with its distinct words and its tokens as places among
them. Word tables are never gathered: they are dealt by hash into parts, and each group gets the classes of its own words
back, a byte for a word.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import discard, fresh_dir, open_fs, publish, utf8_slices, written
from tidemark.llm.textbytes import Words

END_WORD = np.int64(0x0E4D)  # the hash that stands for a text's end


@dataclass(frozen=True)
class ClassLm:
    classes: int = 32
    least_gain: float = 0.001  # the share of the log-likelihood that a sweep must gain for another to follow
    prior: float = 20.0  # tokens that the classes' overall shares weigh in a class's transitions
    group_bytes: int = 8 << 20
    slice_groups: int = 4096  # groups whose counts are added in one task

    @property
    def end(self) -> int:
        return self.classes

    @property
    def unknown(self) -> int:
        return self.classes + 1


def tokens(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts (words, then an end for each text) and where each text's begin."""
    words = Words(texts)
    count = np.diff(words.first)
    out = np.full(len(words.start) + len(texts), END_WORD)
    ends = np.cumsum(count + 1) - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside] = words.hashes().view(np.int64)
    return out, np.append(0, ends + 1)


@dataclass(frozen=True)
class Group:
    """A file of texts: its rows, its distinct words by part and hash, and its tokens as places among them."""

    doc_id: pa.Array
    train: pa.Array
    count: np.ndarray  # of each text's tokens
    words: np.ndarray
    tokens: np.ndarray

    @property
    def learn(self) -> np.ndarray:
        """Whether each token is one to learn from."""
        return np.repeat(self.train.to_numpy(zero_copy_only=False), self.count)

    def save(self, uri: str) -> None:
        columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (self.doc_id, self.train)]
        columns += [pa.array([x.tobytes()], pa.large_binary()) for x in (self.count, self.words, self.tokens)]
        batch, sink = pa.RecordBatch.from_arrays(columns, names=["doc_id", "train", "count", "words", "tokens"]), pa.BufferOutputStream()
        with pa.ipc.new_file(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        publish(uri, sink.getvalue())

    @staticmethod
    def load(uri: str) -> Group:
        system, path = open_fs(uri)
        with system.open_input_file(path) as source:
            batch = pa.ipc.open_file(source).get_batch(0)
        doc_id, train = (batch.column(i).flatten() for i in range(2))
        return Group(doc_id, train, *(np.frombuffer(batch.column(i)[0].as_buffer(), t) for i, t in ((2, np.int64), (3, np.int64), (4, np.int32))))


def bounds_of(words: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts of a group's words, and where each part's begin."""
    part = part_of(words, parts)
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    return part[first], np.append(first, len(words))


def listed(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


def staged(docs: DataFrame, folder: str, parts: int, lm: ClassLm) -> DataFrame:
    """grp, part, words, counts: of each group that it writes to ``folder`` the distinct words and their training counts."""

    def save(rows: list[pa.RecordBatch], values: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        words, at = np.unique(np.concatenate(values), return_inverse=True)
        order = np.argsort(part_of(words, parts), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        doc_id, train = (pa.concat_arrays([r.column(c) for r in rows]) for c in ("doc_id", "train"))
        group = Group(doc_id, train, np.concatenate(counts).astype(np.int64), words[order], place[at])
        number = uuid.uuid4().int >> 65  # a repeated task writes files of its own
        group.save(f"{folder}/{number:016x}")
        n = np.bincount(group.tokens, group.learn, len(words)).astype(np.int64)
        used, bounds = bounds_of(group.words, parts)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(used), number)), pa.array(used, pa.int32()), listed(bounds, group.words), listed(bounds, n)], names=["grp", "part", "words", "counts"])

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, values, counts, size = [], [], [], 0
        for batch in batches:
            for part, texts in utf8_slices(batch, "text", lm.group_bytes // 4):
                value, first = tokens(texts)
                rows.append(part.select(["doc_id", "train"]))
                values.append(value)
                counts.append(np.diff(first))
                size += texts.nbytes
                if size >= lm.group_bytes:
                    yield save(rows, values, counts)
                    rows, values, counts, size = [], [], [], 0
        if rows:
            yield save(rows, values, counts)

    return docs.mapInArrow(stage, "grp long, part int, words array<long>, counts array<long>")


def combined(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)


def part_of(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words.view(np.uint64) >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)


def flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy()


def gathered(found: DataFrame, slices: int) -> DataFrame:
    """Rows of words and their ``columns`` added up within each part and slice of the groups, so that no word, however many groups have it, brings more than one row a slice to what follows."""

    def add(rows: pa.Table) -> pa.Table:
        words, n = combined([flat(rows, "words")], [flat(rows, "counts")])
        return pa.table({"part": rows.column("part")[:1], "words": listed(np.array([0, len(words)]), words), "counts": listed(np.array([0, len(n)]), n)})

    return found.groupBy("part", F.pmod("grp", F.lit(slices))).applyInArrow(add, "part int, words array<long>, counts array<long>")


def vocabulary(counts: DataFrame, slices: int, lm: ClassLm) -> tuple[int, int, int, np.ndarray]:
    """Tokens, distinct tokens, tokens seen once, and as many of the most frequent words as there are classes (ties by hash), ascending."""

    def add(table: pa.Table) -> pa.Table:
        words, n = combined([flat(table, "words")], [flat(table, "counts")])
        words, n = words[n > 0], n[n > 0]  # the others are only in texts held out
        top = np.lexsort((words, -n))
        top = top[words[top] != END_WORD][: lm.classes]
        return pa.table({"word": pa.array([None, *words[top].tolist()], pa.int64()), "n": pa.array([int(n.sum()), *n[top].tolist()], pa.int64()), "types": pa.array([len(words)] + [None] * len(top), pa.int64()), "once": pa.array([int((n == 1).sum())] + [None] * len(top), pa.int64())})

    rows = counts.select("grp", "part", "words", "counts")
    rows = gathered(rows, slices) if slices > 1 else rows.drop("grp")
    found = written(rows.groupBy("part").applyInArrow(add, "word long, n long, types long, once long"), "vocabulary")
    total = found.filter("word IS NULL").agg(F.sum("n"), F.sum("types"), F.sum("once")).first()
    top = found.filter("word IS NOT NULL").orderBy(F.desc("n"), "word").limit(lm.classes).select("word").collect()  # a row for each class
    return *(x or 0 for x in total), np.sort(np.array([r[0] for r in top], np.int64))


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def per_group(classes: DataFrame, folder: str, parts: int, function: Callable, schema: str) -> DataFrame:
    """What ``function`` makes of each group, the classes of its words and their counts in the corpus."""

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # the order of the group's words
        return function(table.column("grp")[0].as_py(), Group.load(f"{folder}/{table.column('grp')[0].as_py():016x}"), flat(table, "classes").view(np.uint8).astype(np.int64), flat(table, "counts"))

    return classes.repartition(parts, "grp").groupBy("grp").applyInArrow(one, schema)


def neighbours(classes: DataFrame, folder: str, parts: int, lm: ClassLm) -> DataFrame:
    """grp, part, words, sizes, keys, counts: for each group its words, and how often a class is before (keys below classes + 2) or after each in training texts."""
    width = lm.classes + 2

    def tally(number: int, group: Group, of: np.ndarray, _: np.ndarray) -> pa.Table:
        learn, code, token = group.learn, of[group.tokens].astype(np.int32), group.tokens * np.int32(2 * width)  # a group has fewer than 2**24 words
        left, right = np.append(np.int32(lm.end), code[:-1]), np.append(code[1:], np.int32(lm.end))
        inner = learn & (code != lm.end)
        cell = np.sort(np.concatenate([token[learn] + left[learn], token[inner] + np.int32(width) + right[inner]]))
        new = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[: len(cell)])
        n, cell = np.diff(np.append(new, len(cell))), cell[new]
        sizes = np.bincount(cell // (2 * width), minlength=len(group.words))
        used, bounds = bounds_of(group.words, parts)
        places = np.append(0, np.cumsum(sizes))[bounds]
        return pa.table({"grp": pa.array(np.full(len(used), number)), "part": pa.array(used, pa.int32()), "words": listed(bounds, group.words), "sizes": listed(bounds, sizes.astype(np.int32)), "keys": listed(places, (cell % (2 * width)).astype(np.int16)), "counts": listed(places, n.astype(np.int64))})

    return per_group(classes, folder, parts, tally, NEIGHBOURS)


NEIGHBOURS = "grp long, part int, words array<long>, sizes array<int>, keys array<short>, counts array<long>"
CLASSES = "grp long, part int, classes array<byte>, counts array<long>"


def joined(rows: pa.Table) -> pa.Table:
    """Neighbours of groups of one slice as one row, whose ``grp`` is the slice."""
    words, at = np.unique(flat(rows, "words"), return_inverse=True)
    cells, n = combined([np.repeat(at, flat(rows, "sizes")) * np.int64(1 << 15) + flat(rows, "keys")], [flat(rows, "counts")])
    whole = lambda x: listed(np.array([0, len(x)]), x)
    sizes = np.bincount(cells >> 15, minlength=len(words)).astype(np.int32)
    return pa.table({"grp": rows.column("slice")[:1], "part": rows.column("part")[:1], "words": whole(words), "sizes": whole(sizes), "keys": whole((cells & 0x7FFF).astype(np.int16)), "counts": whole(n)})


def handed_down(rows: pa.Table, settled: pa.Table) -> pa.Table:
    """The classes and counts of each group's words, from those of its slice."""
    known, classes, counts = flat(settled, "words"), flat(settled, "classes"), flat(settled, "counts")
    at = np.searchsorted(known, flat(rows, "words"))
    bounds = rows.column("words").combine_chunks().offsets.to_numpy()
    return pa.table({"grp": rows.column("grp"), "part": rows.column("part"), "classes": listed(bounds - bounds[0], classes[at]), "counts": listed(bounds - bounds[0], counts[at])})


def suits(table: np.ndarray, lm: ClassLm) -> np.ndarray:
    """How well a class (column) suits a neighbour of each class before, then after it: log P(neighbour's class | class), in whole 1024ths so that sums are exact."""
    smooth = table + 0.5
    before, after = np.log(smooth / smooth.sum(0)), np.log(smooth / smooth.sum(1, keepdims=True)).T
    return np.rint(1024 * np.concatenate([before[:, : lm.classes], after[:, : lm.classes]]))


def settled(found: DataFrame, table: np.ndarray, slices: int, lm: ClassLm) -> DataFrame:
    """grp, part, classes, counts: the best class of each group's words and their training count, both by the whole corpus.

    A word's counts are added within slices of the groups first, and its class is handed down the same way, so that a word
    which every group has is not one row of each group in one task.
    """
    width, weights = 2 * lm.classes + 4, suits(table, lm)

    def settle(rows: pa.Table) -> pa.Table:
        distinct, at = np.unique(flat(rows, "words"), return_inverse=True)
        cell = np.repeat(at, flat(rows, "sizes")) * width + flat(rows, "keys")
        count = np.bincount(cell, flat(rows, "counts"), len(distinct) * width).reshape(-1, width)
        n = count[:, : width // 2].sum(1).astype(np.int64)  # a token has one neighbour before it
        of = (count @ weights).argmax(1)
        of[n == 0] = lm.unknown
        of[distinct == END_WORD] = lm.end
        bounds = rows.column("words").combine_chunks().offsets.to_numpy()
        bounds = bounds - bounds[0]
        return pa.table({"grp": rows.column("grp"), "part": rows.column("part"), "classes": listed(bounds, of[at].astype(np.uint8).view(np.int8)), "counts": listed(bounds, n[at]), **({"words": rows.column("words")} if slices > 1 else {})})

    if slices == 1:
        return found.groupBy("part").applyInArrow(settle, CLASSES)
    found = written(found.withColumn("slice", F.pmod("grp", F.lit(slices))), "neighbours")
    above = found.groupBy("part", "slice").applyInArrow(joined, NEIGHBOURS).groupBy("part").applyInArrow(settle, CLASSES + ", words array<long>")
    return found.select("grp", "part", "words", "slice").groupBy("part", "slice").cogroup(above.groupBy("part", "grp")).applyInArrow(handed_down, CLASSES)


def class_bigrams(classes: DataFrame, folder: str, parts: int, lm: ClassLm) -> np.ndarray:
    """Counts of class bigrams over all training tokens, the first of a text after an end."""
    width = lm.classes + 2

    def count(number: int, group: Group, of: np.ndarray, _: np.ndarray) -> pa.Table:
        code = of[group.tokens][group.learn]
        n = np.bincount(np.append(lm.end, code[:-1])[: len(code)] * width + code, minlength=width * width)
        cell = np.flatnonzero(n)
        return pa.table({"cell": cell, "n": n[cell]})

    table = np.zeros(width * width)
    for r in per_group(classes, folder, parts, count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # one row for each pair of classes
        table[r["cell"]] = r["n"]
    return table.reshape(width, width)


def likelihood(table: np.ndarray) -> float:
    """What the exchange raises: the log-likelihood of the training tokens, but for a constant."""
    return float(xlogx(table).sum() - xlogx(table.sum(0)).sum() - xlogx(table.sum(1)).sum())


def classed(asked: DataFrame, folder: str, top: np.ndarray, parts: int, slices: int, lm: ClassLm) -> tuple[DataFrame, np.ndarray]:
    """grp, part, classes, counts of all words after the sweeps, and their class bigrams. The words of ``top`` start with a class each, all others with the class of unknown words."""
    code = np.append(np.arange(len(top)), [lm.end, lm.unknown])

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            words = flat(rows, "words")
            at = np.minimum(np.searchsorted(top, words), max(len(top) - 1, 0))
            found = top[at] == words if len(top) else np.zeros(len(words), bool)
            of = code[np.where(found, at, np.where(words == END_WORD, len(top), len(top) + 1))]
            bounds = rows.column("words").combine_chunks().offsets.to_numpy()
            yield from pa.table({"grp": rows.column("grp"), "part": rows.column("part"), "classes": listed(bounds - bounds[0], of.astype(np.uint8).view(np.int8)), "counts": rows.column("counts")}).to_batches()

    now, old, best = asked.mapInArrow(starts, CLASSES), None, None
    table = class_bigrams(now, folder, parts, lm)
    while True:
        new = written(settled(neighbours(now, folder, parts, lm), table, slices, lm), "classes")
        found = class_bigrams(new, folder, parts, lm)
        if best is not None and likelihood(found) <= best:
            discard(new)
            break
        if old is not None:
            discard(old)
        gain = np.inf if best is None else likelihood(found) - best
        now, old, table, best = new, new, found, likelihood(found)
        if gain < lm.least_gain * abs(best):
            break
    return now, table


def coded(classes: DataFrame, folder: str, totals: np.ndarray, n: int, v: int, parts: int) -> DataFrame:
    """Each text's counts, base score, log10 of its words' emissions, and its classes as bytes."""
    schema = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, emission double, classes binary"

    def code(number: int, group: Group, of: np.ndarray, counts: np.ndarray) -> pa.Table:
        base = np.log10((counts + 1) / (n + v + 1))
        emission = np.where(counts > 0, np.log10(np.maximum(counts, 1) / np.maximum(totals[of], 1)), 0.0)
        first = np.append(0, np.cumsum(group.count))
        sums = lambda x: np.add.reduceat(x[group.tokens], first[:-1])
        own = of[group.tokens].astype(np.uint8).tobytes()
        return pa.table({"doc_id": group.doc_id, "train": group.train, "n_tokens": pa.array(group.count), "n_known": pa.array(sums((counts > 0).astype(np.int64))), "base_score": pa.array(sums(base)), "emission": pa.array(sums(emission)), "classes": pa.array([own[a:b] for a, b in zip(first, first[1:], strict=False)], pa.binary())})

    return per_group(classes, folder, parts, code, schema)


def steps(batch: pa.RecordBatch, width: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Class bigrams of texts (before * width + after, the first after an end) and where each text's begin."""
    column = batch.column("classes")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.int64)
    return np.append(end, data[:-1]) * width + data, offsets[:-1] - offsets[0]


def transitions(texts: DataFrame, n: int, once: int, lm: ClassLm) -> np.ndarray:
    """log10 P(class | class before), from all training tokens. An unknown word has the chance of a token seen once (Good-Turing)."""
    width = lm.classes + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(steps(batch, width, lm.end)[0], minlength=width * width)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(width * width), "n": total})

    rows = texts.filter("train").select("classes").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # one row for each pair of classes
    table = np.zeros(width * width)
    for r in rows:
        table[r[0]] = r[1]
    table = table.reshape(width, width)
    share = (table.sum(0) + 1e-3) / (table.sum(0) + 1e-3).sum()
    share[lm.unknown] = 0
    share /= share.sum()
    new = (once + 0.5) / (n + 1)
    known = (table + lm.prior * share) / (table.sum(1, keepdims=True) + lm.prior) * (1 - new)
    known[:, lm.unknown] = new
    return np.log10(np.maximum(known, 1e-300))


def scored(docs: DataFrame, held_out: Column, lm: ClassLm = ClassLm(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row; learns from rows not held out.

    A null text counts as empty: one token, its end. A null in ``held_out`` counts as false. Rows with equal ids each have
    a result, and repeated rows count as often as they are there. With nothing to learn from, every word is unknown. An
    empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~F.coalesce(held_out, F.lit(False))).alias("train"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(max(64, size >> 24))
    folder = fresh_dir(docs.sparkSession, "groups")
    asked = written(staged(rows, folder, parts, lm), "words")
    slices = 1 + (size // lm.group_bytes) // lm.slice_groups
    n, v, once, top = vocabulary(asked, slices, lm)
    classes, table = classed(asked, folder, top, parts, slices, lm)
    codes = written(coded(classes, folder, table.sum(0), n, v, parts), "coded")
    chance = transitions(codes, n, once, lm)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                step, first = steps(batch, lm.classes + 2, lm.end)
                total = np.add.reduceat(chance.reshape(-1)[step], first) + batch.column("emission").to_numpy()
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "train", "n_tokens", "n_known", "base_score")), pa.array(total)], names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    out = codes.select("doc_id", "train", "n_tokens", "n_known", "base_score", "emission", "classes").mapInArrow(score, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
