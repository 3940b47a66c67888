"""Mixes beside a plain computation of targets, thresholds and repeats."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from cellferry.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    ended, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in ended]
        left = total - sum(ended.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] >= most * sizes[s]]
        if not over or len(over) == len(free):
            return {**ended, **{s: min(share[s], most * sizes[s]) for s in free}}
        ended |= {s: most * sizes[s] for s in over}


def hash_of(doc_id, text):
    parts = [str(doc_id)] if doc_id is not None else []
    return int(hashlib.md5("\n".join(parts + ([text] if text is not None else [])).encode()).hexdigest()[:15], 16)


def brute(rows):
    """Documents of a source in the order of their hashes, taken one after the other."""
    sized = [(i, len(WORD.findall(t or "")), s, hash_of(i, t)) for i, t, s in rows]
    sizes, groups = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for _, n, s, h in sized:
        sizes[s] += n
        groups[s][h] += n
    target, taken_at = plain_targets(sizes), {}
    for s, hashes in groups.items():
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        need, before = target[s] - whole * sizes[s], 0
        for h in sorted(hashes):
            taken_at[s, h] = whole + (before < need and 2 * (need - before) >= hashes[h])
            before += hashes[h]
    return Counter((i, n, sizes[s], round(target[s], 6), n * taken_at[s, h]) for i, n, s, h in sized)


def rows_of(df):
    return Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def made(spark, rows):
    return spark.createDataFrame([(i, t, s, 5) for i, t, s in rows], "doc_id long, text string, source string, at int").repartition(3)


@pytest.mark.parametrize("seed", range(4))
def test_as_by_hand(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", "É", "zz", "", None, "hot"][: 3 + seed]
    rows = [
        (i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 3, 9, 40]))) or None,
         "hot" if rng.random() < 0.4 else rng.choice(names))
        for i in range(400)
    ]
    rows += rows[:25]
    found = mixing.mix(made(spark, rows))
    assert rows_of(found) == brute(rows)
    by_source = defaultdict(lambda: [0, 0.0, 0])
    source = {i: s for i, _, s in rows}
    for r in found.collect():
        entry = by_source[source[r.doc_id]]
        entry[0] += r.taken
        entry[1], entry[2] = r.target, max(entry[2], r["size"])
        assert r.taken <= 3 * r["size"] and r.taken == r.repeats * r["size"]
    # repeated rows go together
    assert all(abs(t - g) <= 2 * largest for t, g, largest in by_source.values())
    assert rows_of(mixing.mix(made(spark, rows[::-1]))) == rows_of(found)


def test_a_larger_budget_takes_all_that_a_smaller_one_takes(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(300)]
    small = {r.doc_id: r.repeats for r in mixing.mix(made(spark, rows), weights=(1, 3)).collect()}
    large = {r.doc_id: r.repeats for r in mixing.mix(made(spark, rows), weights=(2, 3)).collect()}
    assert all(small[i] <= large[i] for i in small if i % 2 == 0) and sum(small.values()) != sum(large.values())


def test_the_mix_itself(spark):
    docs = made(spark, [(i, "w " * (i + 1), "abc"[i % 3]) for i in range(30)])
    mixed = mixing.mix(docs)
    rows = mixing.repeated(docs, mixed)
    assert rows.columns == docs.columns and rows.count() == mixed.agg({"repeats": "sum"}).first()[0]


def test_edges(spark, docs, none):
    assert mixing.mix(none).count() == 0
    assert rows_of(mixing.mix(docs)) == brute([(r.doc_id, r.text, r.source) for r in docs.collect()])
    empty = made(spark, [(1, None, "a"), (2, " \t", None)])
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0, 0.0, 0)] * 2
    long = made(spark, [(1, "word " * 300_000, "a"), (2, "x", "b")])
    assert sum(r.taken for r in mixing.mix(long).collect()) in (300_000, 300_003)
