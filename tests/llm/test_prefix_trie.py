import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from mailsync.llm import prefix_trie as P

DDL = "conv_id long, turn long, role string, text string"


def brute(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    by = {c: [(x[2], x[3]) for x in sorted(turns)] for c, turns in by.items()}
    rebuilt = {}
    for c, turns in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = by.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members, kids, totals, out = {}, {}, {}, []
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = kids.get(node, [])
        totals[node] = (sum(totals[x][0] for x in below) if below else 1,
                        sum(totals[x][1] for x in below) + (len(members[node]) - 1) * words)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
                    *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _got(turns, **kw):
    return sorted((tuple(r) for r in P.prefix_trie(turns, **kw).collect()), key=repr)


@pytest.mark.parametrize("most", [4096, 8])
def test_table(spark, most):
    turns = spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
    assert _got(turns, most=most) == brute([tuple(r) for r in turns.collect()])


@pytest.mark.parametrize("most", [4096, 40])
def test_edges(spark, most):
    rng = random.Random(2)
    rows = [(c, rng.choice([None, t, t]), rng.choice(["u", "a", None]), rng.choice(["x", "y  z\x0b", None, "", "é"]))
            for c in [*range(-30, 70), None] for t in range(rng.choice([1, 1, 2, 3, 8, 20]))]
    rows += [(5, t, "u", "deep") for t in range(2500)] + [(205, t, "u", "deep") for t in range(1500)]  # deep chains, over a block
    rows += rows[:30]                                                                                  # repeated rows
    rows += [(c, 0, "same", "same") for c in range(1000, 1400)]                                        # many equal conversations
    turns = spark.createDataFrame(rows, DDL)
    for name in ("id", "conv", "r", "h", "depth", "top", "size", "words", "parent", "rep"):
        turns = turns.withColumn(name, F.lit("clash"))
    assert _got(turns, most=most) == brute(rows)


def test_empty(spark):
    assert _got(spark.createDataFrame([], DDL)) == []
    assert _got(spark.createDataFrame([(None, 1, "u", "x")], DDL)) == []


def test_component_totals_of_random_trees():
    rng = np.random.default_rng(5)
    for n, back in ((1, 1), (200, 1), (300, 3), (300, 300)):  # one node, a chain, deep and flat trees; two trees each
        parent = np.array([-1] + [int(rng.integers(max(0, k - back), k)) for k in range(1, n)])
        parent = np.concatenate([parent, np.where(parent < 0, -1, parent + n)])
        order = rng.permutation(2 * n)
        moved = np.empty(2 * n, int)
        moved[order] = [-1 if parent[k] < 0 else -2 for k in range(2 * n)]
        place = np.empty(2 * n, int)
        place[np.arange(2 * n)] = order
        for k in range(2 * n):
            moved[place[k]] = -1 if parent[k] < 0 else place[parent[k]]
        values = rng.integers(0, 9, (2 * n, 2))
        size, want = np.ones(2 * n, int), values.copy()
        for k in range(2 * n):
            up = moved[k]
            while up >= 0:
                size[up] += 1
                want[up] += values[k]
                up = moved[up]
        assert (P.component_totals(moved, size, values, np.zeros_like(values)) == want).all()
