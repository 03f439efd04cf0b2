"""The trie against a plain one: deep conversations over several cells, shared heads, copies, nulls, ties, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    return {c: own.get(c - c % 20, [])[: (h := zlib.crc32(str(c).encode()) % 4)] + turns[h:] for c, turns in own.items()}


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    saved, leaves = Counter(), Counter()
    for k, found in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(found) - 1) * words
            leaves[k[:d]] += k not in children
    out = []
    for k, found in members.items():
        ends = ",".join(str(c) for c in found if len(convs[c]) == len(k))
        parent = members[k[:-1]][0] if k else None
        out.append((found[0], len(k), parent, len(found), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, convs, most):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(draw.choice([1, 2, 3, 5, most])):
            text = f"turn {t} " * draw.choice([1, 1, 1, 2]) if draw.random() < 0.97 else draw.choice([None, "", f"own {c}"])
            rows.append((c if c % 9 else c + 1000, t if t else None, draw.choice(["user", "user", "user", None]), text))
    return rows


def result(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    out = trie.prefix_trie(*trie.rebuilt(trie.turns_of(df.withColumn("label", F.lit("mine")))), **how)
    assert tuple(out.columns) == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("cell,most,convs", [(64, 7, 150), (2, 19, 60), (4, 70, 30)])
def test_equals_a_plain_trie(spark, cell, most, convs):
    rows = made(most, convs, most)
    assert result(spark, rows, height=cell, chunk=60) == plain_trie(plain_rebuilt(rows))


def test_copies_prefixes_and_turnless(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 90) for t in range(4)]
    rows += [(105, 0, "user", "gone"), (None, 0, "user", "no id"), (7, 9, None, None), (7, 9, None, None), (-41, 1, "a", "b")]
    want = plain_rebuilt([r for r in rows if r[0] != -41])
    want[-41] = [("a", "b")][zlib.crc32(b"-41") % 4 :]  # -41 - (-41 % 20) is -40 by SQL's sign, which is absent
    assert result(spark, rows) == plain_trie(want)
    assert any(not turns for turns in want.values())


def test_names_do_not_depend_on_what_follows():
    labels = [bytes([i]) * 32 for i in range(64)]
    whole, block = trie.cut(trie.ROOT, labels, 64)
    assert len(set(whole)) == 64 and block is not None
    for n in (1, 2, 3, 16, 31, 32, 33, 63):
        assert trie.cut(trie.ROOT, labels[:n], 64)[0] == whole[:n]


def test_empty(spark):
    assert result(spark, []) == []
    df = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert trie.prefix_trie(*trie.rebuilt(trie.turns_of(df))).count() == 0
