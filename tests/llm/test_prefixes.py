"""Prefix trees beside trees of dictionaries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from cellferry.llm import prefixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "conv_id long, turn long, role string, text string, conv string, depth int, at int"


def original(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, ts in turns.items()}


def rebuilt(rows):
    own, out = original(rows), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        path = tuple(convs[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs_in in members.items():
        words = (len(convs_in) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += words
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def made(spark, rows):
    df = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], COLUMNS)
    return df.repartition(5)


def some(seed, n, longest, kinds):
    rng, rows = random.Random(seed), []
    for c in range(-3, n):
        for turn in range(rng.choice([0, 1, 2, rng.randrange(longest)])):
            text = rng.choice([None, "", " "] + [f"w{k} x" * (1 + k % 3) for k in range(kinds)])
            rows.append((c if rng.random() < 0.97 else None, rng.choice([None, turn, turn, turn]), rng.choice(["user", None, "bot"]), text))
    return rows + rows[:20]


@pytest.mark.parametrize("seed, n, longest, kinds", [(1, 150, 6, 2), (2, 60, 12, 1), (3, 90, 5, 40)])
def test_as_by_hand(spark, seed, n, longest, kinds):
    rows = some(seed, n, longest, kinds)
    df = made(spark, rows)
    assert rows_of(prefixes.prefix_tree(prefixes.with_shared_starts(df))) == brute(rebuilt(rows))


def test_long_chains_and_copies(spark):
    rng = random.Random(4)
    trunk = [("u", f"turn {i}") for i in range(150)]
    rows = []
    for c in range(40):
        turns = trunk[: rng.choice([150, 149, 70, 3])] + [("b", f"tail {rng.randrange(3)}")] * rng.randrange(30)
        rows += [(c * 7, i, *t) for i, t in enumerate(turns if c % 4 else trunk)]
    df = made(spark, rows)
    assert rows_of(prefixes.prefix_tree(prefixes.as_they_are(df))) == brute(original(rows))


def test_edges(spark):
    assert prefixes.prefix_tree(prefixes.with_shared_starts(made(spark, []))).count() == 0
    assert prefixes.prefix_tree(prefixes.with_shared_starts(made(spark, [(None, 1, "a", "b")]))).count() == 0
    one = [(5, None, None, "w " * 400_000)]
    assert rows_of(prefixes.prefix_tree(prefixes.with_shared_starts(made(spark, one)))) == brute(rebuilt(one))
