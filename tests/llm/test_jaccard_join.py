import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import jaccard_join
from tidemark.llm.jaccard_join import Join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def plain(docs):
    """(n_shingles, component) of each id, comparing all pairs."""
    sets = defaultdict(list)
    for i, t in docs:
        sets[i].append(shingles(t))
    parent = {i: i for i in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, all_ in sets.items() if i is not None for s in all_ if s]
    for k, (i, s) in enumerate(flat):
        for j, t in flat[:k]:
            both = len(s & t)
            if 100 * both >= 80 * (len(s) + len(t) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(60))
    passage = [word() for _ in range(55)]
    docs = []
    while len(docs) < n:
        size = rng.choice([1, 2, 4, 5, 6, 9, 12, 20, 40, 80, 200, 600])
        words = [word() for _ in range(size)]
        if rng.random() < 0.3:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        docs.append(words)
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, max(1, len(copy) // 40)])):
                if copy and rng.random() < 0.5:
                    copy[rng.randrange(len(copy))] = word()
                elif copy:
                    del copy[rng.randrange(len(copy))]
            docs.append(copy)
    return [(i, rng.choice([" ", "  ", "\n", "\t"]).join(w)) for i, w in enumerate(docs[:n])]


@pytest.mark.parametrize(("seed", "join"), [(1, Join()), (2, Join(chunk=8, part_entries=500)), (3, Join(entry_cost=0.0, slack=1.0)), (4, Join(entry_cost=1e9, ratio=1.2, slack=1.0)), (5, Join(chunk_shingles=50))])
def test_against_all_pairs(spark, seed, join):
    docs = corpus(seed, 260)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, join).collect()}
    want = plain(docs)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in docs}
    assert len(set(want.values())) < len(docs)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (7, "A B C D E"), (7, "other words in a row here"), (8, "other words in a row here"), (None, "a b"), (9, "x " * 20_000), (10, "x " * 30_000)]
    df = spark.createDataFrame([(i, t, 0, "s") for i, t in docs], "doc_id long, text string, component_id int, set string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect()]
    want = {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 9: 9, 10: 9, None: None}
    assert len(got) == len(docs)
    assert all(c == want[i] for i, _, c in got)
    assert {i: n for i, n, _ in got if i in (1, 2, 3, 4, 6, 9)} == {1: 0, 2: 0, 3: 0, 4: 1, 6: 1, 9: 1}
    kept = jaccard_join.deduplicated(df)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 9]
    assert kept.columns == df.columns


def test_different_texts_under_one_id(spark):
    text = lambda *w: " ".join(f"w{i}" for i in range(40)) + " " + " ".join(w)
    docs = [(5, text("a")), (5, "nothing of the kind is in this one"), (6, text("b")), (7, "nothing of the kind is in this one")]
    got = jaccard_join.jaccard_components(spark.createDataFrame(docs * 3, "doc_id long, text string").repartition(4)).select("doc_id", "component_id").distinct().collect()
    assert sorted(map(tuple, got)) == [(5, 5), (6, 5), (7, 5)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_components(spark):
    from tidemark.llm.components import connected_components

    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (95, 100), (7, 7), (None, 3)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 90: 90, 95: 90, 100: 90}


def test_deduplicated_keeps_one_of_equal_rows(spark):
    a, b = "one two three four five six", "other words that are not like those"
    rows = [(1, a), (1, a), (1, b), (2, b), (None, a), (None, a), (None, b), (None, None), (None, None)]
    kept = jaccard_join.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, a), (1, b), (None, a), (None, b), (None, None), (None, None)], key=str)


def test_a_hot_signature_is_dealt_out(spark):
    """100,000 sets of one size share the signature of an empty segment; those that chose it meet all of them, in shares."""
    rng = np.random.default_rng(4)
    ids = np.unique(rng.integers(-(1 << 62), 1 << 62, 100_000)) << 1
    entry = ids | (np.arange(len(ids)) % 1000 == 7)
    sig, shares = np.full(len(ids), 12345, np.uint64), np.full(len(ids), 16)
    dealt, out = jaccard_join.dealt_out(sig, entry, shares)
    sizes = np.unique(dealt, return_counts=True)[1]
    chosen = int((entry & 1).sum())
    assert len(sizes) == 16 and sizes.max() < 0.08 * len(ids) + chosen and sizes.sum() == len(ids) + 15 * chosen
    rows = [(i, [int(x) for x in dealt[dealt == d].view(np.int64)], [int(x) for x in out[dealt == d]]) for i, d in enumerate(np.unique(dealt))]
    met = jaccard_join.meetings(spark.createDataFrame(rows, "part int, sigs array<long>, entries array<long>"))
    least = int((entry[(entry & 1) == 1] & -2).min())
    assert met.select("center").distinct().collect()[0].center == least
    assert met.count() == len(ids)


def test_results_are_the_same_in_shares(spark):
    docs = corpus(8, 250)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df, Join(part_entries=3)).collect()}
    assert got == plain(docs)
    known = jaccard_join.costs(jaccard_join.describe_sets(df, Join(part_entries=3)), Join(part_entries=3))
    assert known.shares.max() > 1


def test_unlinked_copies_of_one_text_cost_no_comparison_of_shingles(spark):
    """A cluster whose members are mostly just below the threshold: 1,800 sets of 396 shingles took 19 s, sketches rule them out in less than one."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 396, dtype=np.uint64)
    sets = []
    for k in range(1800):
        own = base.copy()
        changed = int(rng.integers(20, 60))
        own[rng.choice(396, changed, replace=False)] = rng.integers(0, 1 << 63, changed, dtype=np.uint64)
        sets.append(np.unique(own))
    values, first = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    bits = jaccard_join.parity_sketches(values, first)
    for a, b in rng.integers(0, len(sets), (200, 2)):
        assert np.bitwise_count(bits[a] ^ bits[b]).sum() <= len(np.setxor1d(sets[a], sets[b]))
    begin = time.perf_counter()
    edges = jaccard_join.forest(values, first, np.arange(len(sets)), np.zeros(len(sets), int), Join())
    assert time.perf_counter() - begin < 5
    links = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
    assert edges and all(links(a, b) for a, b in edges)
    few = 120
    got = jaccard_join.forest(values[: first[few]], first[: few + 1], np.arange(few), np.zeros(few, int), Join())
    want = {(a, b) for a in range(few) for b in range(a) if links(a, b)}
    assert reached(got, few) == reached(want, few)


def test_sets_that_chose_nothing_are_not_compared_with_each_other(spark):
    """Of 40,000 sets with one empty segment three chose its signature: each of the rest goes to one task, and meets those three."""
    rows = [(1, i, i < 4) for i in range(1, 40_001)] + [(0, i, i < 2) for i in range(3)]
    met = spark.createDataFrame(rows, "center long, member long, chose boolean")
    got = jaccard_join.in_tasks(met, spark.range(40_001).selectExpr("id AS member", "36L AS size"), Join(chunk=4096)).collect()
    assert sum(r.center == 1 and not r.chose for r in got) == 39_997
    tasks = defaultdict(lambda: ([], []))
    for r in got:
        tasks[r.center, r.task][r.chose].append((r.member, r.side))
    assert max(len(a) for a, _ in tasks.values()) < 2 * 4096
    assert all({m for m, _ in b} >= {1, 2, 3} for (c, _), (_, b) in tasks.items() if c == 1)
    assert [(len(a), len(b)) for (c, _), (a, b) in tasks.items() if c == 0] == [(1, 2)]
    # pairs of many that chose, in chunks, are all there
    rows = [(0, i, i % 3 > 0) for i in range(90)]
    met = spark.createDataFrame(rows, "center long, member long, chose boolean")
    tasks = defaultdict(list)
    for r in jaccard_join.in_tasks(met, spark.range(90).selectExpr("id AS member", "5L AS size"), Join(chunk=8)).collect():
        tasks[r.task].append(r)
    pairs = {frozenset((a.member, b.member)) for t in tasks.values() for a in t for b in t if a.member != b.member and (a.chose or b.chose) and (len({x.side for x in t}) == 1 or a.side != b.side)}
    assert pairs == {frozenset((a, b)) for a in range(90) for b in range(a) if a % 3 or b % 3}
    rng = np.random.default_rng(7)
    values = np.sort(rng.integers(0, 1 << 63, (8000, 36), dtype=np.uint64), axis=1)
    values[5000] = values[17]  # chose[17] finds its copy; 6000 and 7000 are copies as well, but other groups have them
    values[7000] = values[6000]
    begin = time.perf_counter()
    edges = jaccard_join.forest(values.ravel(), np.arange(8001) * 36, np.arange(8000), np.zeros(8000, int), Join(), np.arange(8000) == 17)
    assert {frozenset(e) for e in edges} == {frozenset((17, 5000))}
    assert time.perf_counter() - begin < 2


def reached(edges, n):
    least = list(range(n))
    for _ in range(n):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    return least


def test_plan_without_near_copies_is_small(spark):
    """Sets and their first documents are planned once, not for each use of them (52 aggregates when they were)."""
    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, "h i j k l m", "z")], "doc_id long, text string, source string")
    out = jaccard_join.deduplicated(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bAggregate\b", plan)) <= 30, plan
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]
