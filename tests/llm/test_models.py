"""Mixing, vectors, language and scores against SQL, brute force or held-out accuracy."""

import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import class_lm, language_crf, mixing, near_vectors
from tidemark.llm.mixing import Mix


def mix_rows(spark, docs, mix):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, source string, size string, sid int").repartition(3)
    return sorted(((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in mixing.mix_report(df, mix).collect()), key=str), df


@pytest.mark.parametrize("mix", [Mix(), Mix(block_words=5, shard_slots=32, cells=8, buckets=4, rounds=5)])
def test_mix_equals_sql(spark, mix):
    rng = random.Random(3)
    docs = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 40, 200])), rng.choice(["a", "a", "a", "a", "é", "Z", None])) for i in range(300)] + [(5, None, "a"), (5, "x y", "a"), (None, "p q", "b")]
    got, _ = mix_rows(spark, docs, mix)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    rel = con.sql(mixing.report_sql(mix))
    want = sorted((tuple(r[rel.columns.index(c)] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in rel.fetchall()), key=str)
    assert got == want
    assert all(t <= 3 * n for _, n, _, _, t in got)


def test_sources_come_near_their_targets(spark, sf_dir):
    rows = mixing.mix_report(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source"), "doc_id")
    for r in rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size")).collect():
        assert abs(r.taken - r.target) <= 4 * 64
        assert r.target <= 3 * r["size"]


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 17, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(4).cast("long"), Mix()).alias("x"))
        assert sorted(r.x for r in df.collect()) == list(range(n))


@pytest.mark.parametrize("total", [1_000_000, 400_000])
def test_shares_of_shards_spread_as_a_multinomial(spark, total):
    """Of sources with 60, 35 and 5 % the variance of a shard's count, over that of the multinomial given the sums, is 0.8 to 1.2."""
    mix = Mix()
    rows, columns = mixing.sides(total)
    n, m = rows * columns, 512
    p = mixing.dealt(spark.range(n), total, mix)
    assert p.select("p").distinct().count() == n and p.agg(F.max("p")).first()[0] == n - 1
    source = F.when(F.col("p") < 0.6 * total, 0).when(F.col("p") < 0.95 * total, 1).when(F.col("p") < total, 2)
    counts = p.groupBy(F.floor(F.col("id") / m).alias("shard")).agg(*(F.count_if(source == s).alias(f"n{s}") for s in range(3))).filter(f"shard < {n // m}").toPandas()
    for s, share in enumerate((0.6, 0.35, 0.05)):
        q = share * total / n
        ratio = ((counts[f"n{s}"] - m * q) ** 2).mean() / (m * q * (1 - q) * (n - m) / (n - 1))
        assert 0.8 < ratio < 1.2, (s, ratio)


def test_mixed_documents_hold_what_the_report_says(spark):
    rng = random.Random(5)
    docs = [(i, "  ".join(f"d{i}w{k}" for k in range(rng.choice([0, 2, 30, 120]))), rng.choice(["a", "a", "b", "c"])) for i in range(60)]
    mix = Mix(block_words=7, shard_slots=64)
    report, df = mix_rows(spark, docs, mix)
    taken = {i: t for i, _, _, _, t in report}
    out = {r.doc_id: r.text for r in mixing.mixed_documents(df, mix).collect()}
    for i, text, _ in docs:
        words = out.get(i, "").split()
        assert len(words) == taken[i]
        assert max(Counter(words).values(), default=0) <= 3
        assert set(words) <= set(text.split())


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_report(empty).count() == 0
    assert [r.taken for r in mixing.mix_report(spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")).collect()] == [0]


def vectors(n):
    rng = np.random.default_rng(n)
    out = []
    for _ in range(n):
        x = rng.standard_normal(16)
        out.append(x)
        for _ in range(int(rng.integers(0, 4))):
            out.append(x * rng.uniform(0.1, 5) + rng.standard_normal(16) * rng.choice([0, 0.1, 0.3]) * 0.4)
    return [(i, [float(np.float32(v)) for v in x], int(rng.integers(0, 2))) for i, x in enumerate(out)]


@pytest.mark.parametrize("lsh", [near_vectors.Lsh(), near_vectors.Lsh(chunk=16, part_rows=500)])
def test_near_vectors_against_all_pairs(spark, lsh):
    rows = vectors(150)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(40)] + [(2000 + i, [1.0 + 0.01 * i] + [0.5] * 15, 0) for i in range(60)]
    bad = [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] + [1.0] * 15, 1), (3003, [None] + [1.0] * 15, 1), (3004, [1.0] * 16, None), (3005, [], 1), (3006, [float("inf")] + [1.0] * 15, 1), (None, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows + bad], "vec_id long, embedding array<float>, label int, id int, x string").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(df, lsh).collect()}
    links, parent = Counter(), {r[0]: r[0] for r in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, x, a), (j, y, b) in itertools.combinations(rows, 2):
        if a == b and np.dot(x, y) / math.sqrt(np.dot(x, x) * np.dot(y, y)) >= 0.93:
            links[i] += 1
            links[j] += 1
            p, q = root(i), root(j)
            parent[max(p, q)] = min(p, q)
    for i, *_ in rows:
        assert got[i] == (links[i], root(i), root(i) == i)
    for i, *_ in bad[:-1]:
        assert got[i] == (0, i, True)
    assert got[None] == (0, None, False)
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(64)
        y -= x * (x @ y)
        y /= np.linalg.norm(y)
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, (0.9301 * x + math.sqrt(1 - 0.9301**2) * y).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = near_vectors.near_vectors(df).filter("n_links > 0").count()
    assert found >= 0.97 * 800


def test_marginals_against_enumeration():
    rng = np.random.default_rng(4)
    scores, turn = rng.standard_normal((9, 3)), rng.standard_normal((3, 3))
    begin, length = np.array([0, 4, 5]), np.array([4, 1, 4])
    posterior, used = language_crf.marginals(scores, begin, length, turn)
    want, moves = np.zeros((9, 3)), np.zeros((3, 3))
    for b, n in zip(begin, length, strict=True):
        paths = list(itertools.product(range(3), repeat=int(n)))
        weight = np.array([math.exp(sum(scores[b + t, p[t]] for t in range(n)) + sum(turn[p[t], p[t + 1]] for t in range(n - 1))) for p in paths])
        for p, w in zip(paths, weight / weight.sum(), strict=True):
            for t in range(n):
                want[b + t, p[t]] += w
                if t:
                    moves[p[t - 1], p[t]] += w
    assert np.allclose(posterior, want)
    assert np.allclose(used, moves)


def test_language_model_is_learned_in_a_task_and_in_slices(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text, r.lang) for r in docs.collect() if r.text is not None and r.lang is not None)
    texts, langs = [r[1] for r in rows], [r[2] for r in rows]
    whole = language_crf.fit(texts, langs, language_crf.Crf(train_slice_bytes=1 << 30))
    sliced = language_crf.fit(texts, langs, language_crf.Crf(train_slice_bytes=1000))
    monkeypatch.setattr(language_crf, "Lines", None)  # the driver's; tasks have their own
    learned = language_crf.train(docs)
    for model in (sliced, learned):
        assert model.langs == whole.langs
        assert (model.emit == whole.emit).all() and (model.turn == whole.turn).all()


def test_memory_to_learn_languages_is_bounded():
    texts = [" ".join(f"w{i * 7919 % 1009}x{(i + j) % 4001}" for j in range(400)) for i in range(1000)]
    size = sum(map(len, texts))
    tracemalloc.start()
    language_crf.fit(texts, ["a", "b"] * 500, language_crf.Crf(epochs=1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * size + (48 << 20), (peak, size)


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    crf = language_crf.Crf(sample_rows=100)
    model = language_crf.train(docs.filter(~held), crf)
    rows = language_crf.predict(docs.filter(held), model, crf, keep=("lang",)).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert model.turn.diagonal().min() > model.turn[~np.eye(len(model.turn), dtype=bool)].max()
    switched = "der und die einer nicht Straße, " * 12 + "\n" + "the and of reading with that " * 14
    odd = [(1, None), (2, ""), (3, " 12 34 --- !"), (4, "… — 。"), (5, "日本"), (6, switched), (None, "the and of"), (7, "the and of " * 30_000)]
    got = {r.doc_id: r for r in language_crf.predict(spark.createDataFrame([(*o, "de", "x") for o in odd], "doc_id long, text string, lang_pred string, score string"), model, crf).collect()}
    assert [(got[i].lang_pred, got[i].score) for i in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert got[5].lang_pred != "und"
    assert got[6].lang_pred == "en"
    assert 0.3 < got[6].score < 0.8
    assert got[None].lang_pred == "en"
    assert got[7].score > 0.9
    empty = docs.limit(0)
    assert language_crf.train(empty).langs == []
    assert [r.lang_pred for r in language_crf.predict(docs.limit(2), language_crf.train(empty)).collect()] == ["und"] * 2
    assert language_crf.predict(empty, model, crf).count() == 0


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + ["\n"]


def test_scores(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(9001, None), (9002, ""), (None, "the of"), (9003, "unseenword " * 20_000), (9003, "the")], "doc_id long, text string")
    docs = docs.unionByName(extra).withColumn("train", F.lit("clash")).withColumn("grp", F.lit(0)).repartition(3)
    lm = class_lm.ClassLm(classes=8, group_bytes=20_000, slice_groups=3)
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    rows = class_lm.scored(docs, held, lm).collect()
    plain = [(r.doc_id, words(r.text)) for r in docs.collect()]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, ws in plain if not out(i) for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted(((i is None, i or 0, out(i), len(ws), sum(count[w] > 0 for w in ws), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in plain))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert all(abs(a[5] - b[5]) <= 1e-6 * abs(b[5]) + 2e-4 for a, b in zip(got, want, strict=True))
    assert {r.train_tokens for r in rows} == {n}
    held_rows = [r for r in rows if r.held_out]
    assert sum(r.score for r in held_rows) > sum(r.base_score for r in held_rows)


def plain_class_scores(docs, lm):
    """The model's log10 probability of each of (id, tokens, learned from), by the definition of the sweeps."""
    hashed = {w: int(h) for w in {w for _, ws, _ in docs for w in ws} - {"\n"} for h in class_lm.tokens(pa.array([w.encode()], pa.large_binary()))[0][:1]}
    learned = [ws for _, ws, train in docs if train]
    count = Counter(w for ws in learned for w in ws)
    top = sorted(sorted((w for w in count if w != "\n"), key=lambda w: (-count[w], hashed[w]))[: lm.classes], key=lambda w: hashed[w])
    of = {w: lm.end if w == "\n" else top.index(w) if w in top else lm.unknown for _, ws, _ in docs for w in ws}
    width, pairs = lm.classes + 2, [p for ws in learned for p in zip(["\n", *ws], ws)]

    def bigrams(of):
        table = np.zeros((width, width))
        for a, b in pairs:
            table[of[a], of[b]] += 1
        return table

    def fit_of(table):
        cell = lambda x: sum(n * math.log(n) for n in x.ravel() if n > 0)
        return cell(table) - cell(table.sum(0)) - cell(table.sum(1))

    table, best = bigrams(of), None
    while True:
        smooth = table + 0.5
        gain = {w: np.zeros(lm.classes) for w in count if w != "\n"}
        for a, b in pairs:
            for c in range(lm.classes):
                if b != "\n":
                    gain[b][c] += round(1024 * math.log(smooth[of[a], c] / smooth[:, c].sum()))
                if a != "\n":
                    gain[a][c] += round(1024 * math.log(smooth[c, of[b]] / smooth[c].sum()))
        new = {w: k if w == "\n" else int(gain[w].argmax()) if w in gain else lm.unknown for w, k in of.items()}
        found = bigrams(new)
        if best is not None and fit_of(found) <= best:
            break
        gain = math.inf if best is None else fit_of(found) - best
        of, table, best = new, found, fit_of(found)
        if gain < lm.least_gain * abs(best):
            break
    n, once = sum(count.values()), sum(c == 1 for c in count.values())
    share = table.sum(0) + 1e-3
    share = share / share.sum()
    share[lm.unknown] = 0
    share = share / share.sum()
    fresh = (once + 0.5) / (n + 1)

    def step(a, b):
        if of[b] == lm.unknown:
            return math.log10(fresh)
        chance = (table[of[a], of[b]] + lm.prior * share[of[b]]) / (table[of[a]].sum() + lm.prior) * (1 - fresh)
        return math.log10(chance) + math.log10(count[b] / table[:, of[b]].sum())

    return {i: sum(step(a, b) for a, b in zip(["\n", *ws], ws)) for i, ws, _ in docs}


@pytest.mark.parametrize("lm", [class_lm.ClassLm(classes=5), class_lm.ClassLm(classes=9, least_gain=0.02, group_bytes=600, slice_groups=2)])
def test_scores_against_the_definition(spark, lm):
    rng = random.Random(12)
    kinds = [[f"{k}{i}" for i in range(n)] for k, n in (("a", 4), ("b", 30), ("c", 60))]
    docs = []
    for i in range(150):
        text = " ".join(rng.choice(kinds[(j + rng.randrange(2)) % 3]) for j in range(rng.choice([0, 1, 5, 25])))
        docs.append((i, None if i == 7 else text.upper() if i % 5 == 0 else text))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.score for r in class_lm.scored(df, F.col("doc_id") % 6 == 2, lm).collect()}
    want = plain_class_scores([(i, words(t), i % 6 != 2) for i, t in docs], lm)
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) <= 1e-6 * abs(want[i]) for i in want)


def test_transitions_sum_to_one(spark):
    lm = class_lm.ClassLm(classes=3)
    texts = spark.createDataFrame([(True, bytearray([0, 1, 2, 3])), (True, bytearray([0, 0, 3])), (False, bytearray([4, 3]))], "train boolean, classes binary")
    chance = 10 ** class_lm.transitions(texts, 7, 2, lm)
    assert np.allclose(chance.sum(1), 1)
    assert np.allclose(chance[:, lm.unknown], 2.5 / 8)
    assert chance[3, 0] > chance[3, 1]


def test_scores_with_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = class_lm.scored(df, F.lit(True)).first()
    assert (row.n_known, row.train_tokens, row.n_tokens) == (0, 0, 3)
    assert class_lm.scored(df.limit(0), F.lit(False)).count() == 0


def test_classes_do_not_depend_on_groups(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    rows = [{r.doc_id: r.score for r in class_lm.scored(docs.repartition(n), held, class_lm.ClassLm(classes=8, group_bytes=size)).collect()} for n, size in ((1, 4 << 20), (4, 3_000))]
    assert rows[0].keys() == rows[1].keys()
    assert all(abs(rows[0][i] - rows[1][i]) <= 1e-6 * abs(rows[0][i]) for i in rows[0])


def test_words_among_rare_words_get_classes(spark):
    rng = random.Random(8)
    word = lambda slot: f"{slot}{rng.randrange(30)}"
    texts = []
    for _ in range(1500):  # the rare x and y stand only beside rare words, x where the frequent fx does and y where fy does
        a, x, p = ("a", "x", "p") if rng.random() < 0.5 else ("b", "y", "q")
        kind = rng.random()
        inner = [word(a), f"f{x}", word(p)] if kind < 0.4 else [word(a), word(x), word(p)] if kind < 0.8 else [f"f{a}", f"f{x}", f"f{p}"]
        texts.append(" ".join(["the", *inner, "of"] if a == "a" else ["of", *inner, "the"]))
    odd = [(5000, "the a1 x1 p1 of"), (5001, "the a1 y1 p1 of"), (5002, "of b1 y1 q1 the"), (5003, "of b1 x1 q1 the")]
    docs = spark.createDataFrame([*enumerate(texts), *odd], "doc_id long, text string")
    score = {r.doc_id: r.score for r in class_lm.scored(docs, F.col("doc_id") >= 5000, class_lm.ClassLm(classes=8)).collect()}
    assert score[5000] > score[5001] + 1
    assert score[5002] > score[5003] + 1


def test_mixed_documents_tell_rows_with_equal_ids_apart(spark):
    rng = random.Random(9)
    docs = [(rng.choice([None, 1, 2]), " ".join(f"d{i}w{k}" for k in range(rng.choice([2, 30, 120]))), rng.choice(["a", "b"])) for i in range(60)]
    mix = Mix(block_words=7, shard_slots=64)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    report = mixing.mix_report(df, mix).groupBy("doc_id").agg(F.sum("taken").alias("n"), F.count_if(F.col("taken") > 0).alias("rows")).collect()
    got = mixing.mixed_documents(df, mix).collect()
    assert {r.doc_id: r.rows for r in report} == Counter(r.doc_id for r in got)
    by_text = {t: i for i, t, _ in docs}
    words_of = {w: t for t in by_text for w in t.split()}
    taken = Counter()
    for r in got:
        own = {words_of[w] for w in r.text.split()}
        assert len(own) == 1
        assert by_text[own.pop()] == r.doc_id
        assert max(Counter(r.text.split()).values()) <= 3
        taken[r.doc_id] += len(r.text.split())
    assert sum(taken.values()) == sum(r.n for r in report)
