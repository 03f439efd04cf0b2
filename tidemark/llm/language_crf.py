"""Language identification by a linear-chain conditional random field over words.

A word's features are hashed: its first and last one to four bytes (affixes), its byte trigrams, and the whole word
(lexicon), in lower case without the punctuation around it. A chain is a line of a text. Emission and transition weights
maximise the conditional likelihood (forward-backward, Adagrad) of code-switched lines spliced from stretches of labelled
documents, so that transitions learn how long a language lasts. A document's language is the one with the largest mean
word posterior, and its score that mean.

Training takes a bounded sample: about ``sample_rows`` documents of each language, whole. One task learns from it, in slices
of ``train_slice_bytes``; only the weights come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import bound_batches, utf8_slices
from tidemark.llm.textbytes import Words, mix

LETTER = np.zeros(256, bool)  # bytes of letters: a-z, and all of other scripts
LETTER[97:123] = LETTER[128:] = True


@dataclass(frozen=True)
class Crf:
    sample_rows: int = 300  # documents of each language to learn from: the bound of the sample
    bits: int = 17
    epochs: int = 2
    chain: int = 64
    batch: int = 64
    rate: float = 0.3
    seed: int = 11
    slice_bytes: int = 1 << 20  # of text that a task works on at once
    train_slice_bytes: int = 1 << 18  # of the sample, whose features are kept


@dataclass
class Model:
    langs: list[str]
    emit: np.ndarray = field(repr=False, default=None)
    turn: np.ndarray = field(repr=False, default=None)


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each start in turn."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


class Lines:
    """Words of texts with their features: ``word`` numbers distinct cores, whose features are ``feature[first[w]:first[w + 1]]``."""

    def __init__(self, texts: pa.LargeBinaryArray, bits: int):
        words = Words(texts)
        start, end = words.start.copy(), words.end.copy()
        for at, step, edge in ((start, 1, 0), (end, -1, -1)):
            todo = np.flatnonzero(start < end)
            while len(todo := todo[~LETTER[words.data[at[todo] + edge]]]):
                at[todo] += step
                todo = todo[start[todo] < end[todo]]
        breaks = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum(words.data == 10, out=breaks[1:])
        self.doc, self.texts = words.doc, len(texts)
        line = breaks[words.start]
        fresh = np.ones(len(line), bool)
        fresh[1:] = (line[1:] != line[:-1]) | (self.doc[1:] != self.doc[:-1])
        self.begin = np.flatnonzero(fresh)
        self.length = np.diff(np.append(self.begin, len(line)))
        self.spoken = start < end
        hashes = words.spans(start, np.maximum(start, end))
        _, some, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        s, e = start[some], np.maximum(start, end)[some]
        parts, owners = [np.zeros(len(s), np.uint64)], [np.arange(len(s))]  # each core has one feature at least

        def add(kind: int, own: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            parts.append(mix(words.spans(a, b) + np.uint64(kind * 0x9E3779B97F4A7C15 % (1 << 64))))
            owners.append(own)

        size = e - s
        add(1, *(x[size > 0] for x in (np.arange(len(s)), s, e)))
        for n in range(1, 5):
            own = np.flatnonzero(size >= n)
            add(1 + n, own, s[own], s[own] + n)
            add(5 + n, own, e[own] - n, e[own])
        windows = np.maximum(size - 2, 0)
        at = ragged(s, windows)
        add(10, np.repeat(np.arange(len(s)), windows), at, at + 3)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.feature = (np.concatenate(parts)[order] >> np.uint64(64 - bits)).astype(np.int64)
        self.first = np.searchsorted(owner[order], np.arange(len(s) + 1))

    def scores(self, emit: np.ndarray) -> np.ndarray:
        """Of each distinct core and language."""
        return np.add.reduceat(emit[self.feature], self.first[:-1]) if len(self.first) > 1 else np.zeros((0, emit.shape[1]))


def marginals(scores: np.ndarray, begin: np.ndarray, length: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word and language, and expected transitions; chains are rows begin to begin + length of scores.

    Forward and backward run over all chains at once, the longest first, so that step t has the first so many of them.
    """
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    weight = np.exp(scores - scores.max(1, keepdims=True, initial=-1e30))
    move = np.exp(turn - turn.max())
    active = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1 if len(length) else 1), side="right")
    forward = np.empty_like(weight)
    now = None
    for t, n in enumerate(active):
        rows = begin[:n] + t
        now = weight[rows] if t == 0 else (now[:n] @ move) * weight[rows]
        now /= now.sum(1, keepdims=True)
        forward[rows] = now
    back = np.ones_like(weight)
    used = np.zeros_like(turn)
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        after = begin[:n] + t + 1
        pull = weight[after] * back[after]
        own = pull @ move.T
        total = (forward[after - 1] * own).sum(1, keepdims=True)
        used += (forward[after - 1] / total).T @ pull * move
        back[after - 1] = own / own.sum(1, keepdims=True)
    both = forward * back
    return both / both.sum(1, keepdims=True), used


@dataclass
class Spoken:
    """Words with a letter of all texts: each one's text and core, and the features of core w, ``feature[first[w]:first[w + 1]]``."""

    doc: np.ndarray
    word: np.ndarray
    feature: np.ndarray
    first: np.ndarray


def spoken_words(texts: list[str], crf: Crf) -> Spoken:
    """Features are made slice by slice, and cores are distinct within a slice."""
    doc, word, feature, count = [], [], [], []
    texts_before = cores_before = 0
    for part, raw in utf8_slices(pa.record_batch({"text": pa.array(texts, pa.large_string())}), "text", crf.train_slice_bytes):
        lines = Lines(raw, crf.bits)
        doc.append((lines.doc[lines.spoken] + texts_before).astype(np.int32))
        word.append((lines.word[lines.spoken] + cores_before).astype(np.int32))
        feature.append(lines.feature.astype(np.int32))
        count.append(np.diff(lines.first))
        texts_before, cores_before = texts_before + part.num_rows, cores_before + len(lines.first) - 1
    return Spoken(*map(np.concatenate, (doc, word, feature)), np.concatenate([[0], np.cumsum(np.concatenate(count))]))


def fit(texts: list[str], langs: list[str], crf: Crf) -> Model:
    """Learns from whole labelled texts. The size of the slices makes no difference to the weights."""
    names = sorted(set(langs))
    model = Model(names, np.zeros((1 << crf.bits, len(names)), np.float32), np.zeros((len(names), len(names))))
    if not texts:
        return model
    rng = np.random.default_rng(crf.seed)
    spoken = spoken_words(texts, crf)
    label_of = np.array([names.index(x) for x in langs])
    past, past_turn = np.full(model.emit.shape, 1e-2, np.float32), np.full(model.turn.shape, 1e-2)
    for _ in range(crf.epochs):
        lengths = rng.integers(3, 41, len(spoken.word) // 3 + 1)
        ends = np.minimum(np.cumsum(lengths), len(spoken.word))
        starts = np.concatenate([[0], ends[:-1]])
        keep = ends > starts
        pieces = rng.permutation(np.flatnonzero(keep))
        stream = ragged(starts[pieces], (ends - starts)[pieces])
        for at in range(0, len(stream), crf.chain * crf.batch):
            now = stream[at : at + crf.chain * crf.batch]
            word, label = spoken.word[now], label_of[spoken.doc[now]]
            begin = np.arange(0, len(now), crf.chain)
            length = np.minimum(crf.chain, len(now) - begin)
            count = spoken.first[word + 1] - spoken.first[word]
            feature = spoken.feature[ragged(spoken.first[word], count)]
            where = np.concatenate([[0], np.cumsum(count)[:-1]])
            scores = np.add.reduceat(model.emit[feature], where)
            posterior, used = marginals(scores, begin, length, model.turn)
            change = -posterior
            change[np.arange(len(now)), label] += 1
            distinct, inverse = np.unique(feature, return_inverse=True)
            grad = np.zeros((len(distinct), len(names)), np.float32)
            np.add.at(grad, inverse, np.repeat(change, count, axis=0).astype(np.float32))
            past[distinct] += grad * grad
            model.emit[distinct] += crf.rate * grad / np.sqrt(past[distinct])
            seen = np.zeros_like(model.turn)
            inside = np.ones(len(now), bool)
            inside[begin] = False
            later = np.flatnonzero(inside)
            np.add.at(seen, (label[later - 1], label[later]), 1)
            grad_turn = seen - used
            past_turn += grad_turn * grad_turn
            model.turn += crf.rate * grad_turn / np.sqrt(past_turn)
    return model


def train(docs: DataFrame, crf: Crf = Crf(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits on a sample of ``docs``, in one task: rows with a null text or language teach nothing. The sample is chosen by a hash of the id."""
    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}  # one row for each language
    if not counts:
        return fit([], [], crf)
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, crf.sample_rows / n))))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(crf.seed)), F.lit(1_000_000)) / 1_000_000
    sample = known.filter(draw < share[F.col(lang_col)]).select(F.col(id_col), text_col, lang_col).limit(2 * crf.sample_rows * len(counts))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(column.to_pylist() for column in batch.columns), strict=True)]
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        model = fit([r[1] for r in rows], [r[2] for r in rows], crf)
        yield pa.record_batch([pa.array([model.langs], pa.list_(pa.string())), pa.array([model.emit.tobytes()]), pa.array([model.turn.tobytes()])], names=["langs", "emit", "turn"])

    bound_batches(docs.sparkSession)
    found = sample.coalesce(1).mapInArrow(learn, "langs array<string>, emit binary, turn binary").first()
    if not found:
        return fit([], [], crf)
    n = len(found["langs"])
    return Model(list(found["langs"]), np.frombuffer(found["emit"], np.float32).reshape(1 << crf.bits, n), np.frombuffer(found["turn"]).reshape(n, n))


def predict(docs: DataFrame, model: Model, crf: Crf = Crf(), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """doc_id (and the columns ``keep``), lang_pred and score (or as ``names`` calls them) for every row.

    A null text, one without a letter, and any text where no language was learned have lang_pred ``und`` and score 0.
    Equal texts have equal results; repeated rows stay. Of two languages that score alike the first by code point is taken.
    An empty table gives an empty result. A kept column called as in ``names`` is an error. Texts are worked on in slices
    of ``crf.slice_bytes``, or alone where they are longer; working memory is about 150 bytes for each byte of a slice.
    """
    columns = [id_col, *keep]
    if clash := set(names) & set(columns):
        raise ValueError(f"columns kept and made are both called {sorted(clash)}")
    sent = columns if text_col in columns else [*columns, text_col]
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes for each hashed feature and language

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, emit, turn = np.array([*shared.value.langs, "und"], object), shared.value.emit, shared.value.turn
        for batch in batches:
            for part, texts in utf8_slices(batch, text_col, crf.slice_bytes):
                lang, score = np.full(len(texts), len(langs) - 1), np.zeros(len(texts))
                lines = Lines(texts, crf.bits)
                if len(langs) > 1 and len(lines.word):
                    posterior, _ = marginals(lines.scores(emit)[lines.word], lines.begin, lines.length, turn)
                    posterior[~lines.spoken] = 0
                    share = np.stack([np.bincount(lines.doc, posterior[:, i], len(texts)) for i in range(len(langs) - 1)], 1)
                    words = np.bincount(lines.doc, lines.spoken, len(texts))
                    spoken = np.flatnonzero(words)
                    lang[spoken] = share[spoken].argmax(1)
                    score[spoken] = np.clip(share[spoken].max(1) / words[spoken], 0, 1)
                for i in np.flatnonzero(lang < len(langs) - 1):
                    raw = texts[int(i)].as_py()
                    if not any(97 <= c < 123 or 65 <= c < 91 for c in raw[:4096]) and not any(c.isalpha() for c in raw.decode("utf-8", "replace")):
                        lang[i], score[i] = len(langs) - 1, 0
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(langs[lang].tolist(), pa.string()), pa.array(score)], names=[*columns, *names])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*sent).mapInArrow(label, f"{fields}, `{names[0]}` string, `{names[1]}` double")
