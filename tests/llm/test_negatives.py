"""Hard negatives beside all inner products."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from cellferry.llm import negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, label int, embedding array<double>, id long, row int, score string, block long"


def brute(rows, anchors, positives=5, most=5, low=80, high=100):
    sound = [
        (i, lab, [int(x) for x in v]) for i, lab, v in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for at, (a, label, v) in enumerate(sound):
        if not anchors(a):
            continue
        score = [sum(x * y for x, y in zip(v, w)) for _, _, w in sound]
        order = sorted(range(len(sound)), key=lambda k: (-score[k], sound[k][0]))
        same = [k for k in order if k != at and sound[k][1] == label][:positives]
        for p in same:
            found = [k for k in order if sound[k][1] != label and low * score[p] <= high * score[k] <= high * score[p]][:most]
            for rank, k in enumerate(found, 1):
                out[a, sound[p][0], rank, sound[k][0], score[p], score[k]] += 1
    return out


def found_in(spark, rows, anchors=lambda c: c % 3 == 0, **named):
    df = spark.createDataFrame([(*r, 1, 2, "s", 3) for r in rows], SCHEMA).repartition(4)
    got = negatives.hard_negatives(df, anchors(F.col("vec_id")), **named)
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


def some(seed, n, size=8, spread=40, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-spread, spread, (6, size))
    rows = []
    for i in range(n):
        v = (centres[rng.integers(6)] + rng.integers(-4, 5, size)) * int(rng.choice([1, 1, 2, 5]))
        rows.append((i, int(rng.integers(labels)), [float(x) for x in v]))
    return rows


@pytest.mark.parametrize("seed, n, size", [(1, 300, 8), (2, 500, 3), (3, 200, 1)])
def test_as_by_all_products(spark, monkeypatch, seed, n, size):
    rows = some(seed, n, size)
    assert found_in(spark, rows) == brute(rows, lambda a: a % 3 == 0)
    monkeypatch.setattr(negatives, "TILE", 64)
    monkeypatch.setattr(negatives, "SPAN", 150)
    assert found_in(spark, rows, positives=3, negatives=4, low=50) == brute(rows, lambda a: a % 3 == 0, 3, 4, 50)


def test_pruning_loses_nothing_and_leaves_rows_out():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 16)) * 60
    vectors = np.rint(centres[rng.integers(30, size=900)] + rng.standard_normal((900, 16)) * 8)
    vectors[:3] = 0
    bucket, seen = negatives.Bucket(vectors), 0
    for v in np.rint(centres + rng.standard_normal((30, 16)) * 8):
        anchor = negatives.Anchor(0, 0, v, [])
        scores = vectors @ v
        for part in (0.3, 0.8, 0.9, 1.0, 1.2):
            least = float(scores.max() * part)
            near = bucket.candidates(anchor, least)
            assert set(np.flatnonzero(scores >= least)) <= set(near.tolist())
            seen += len(near)
            assert (bucket.scores(anchor, near) == scores[near]).all()
    assert seen < 0.6 * 900 * 30 * 5


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (3, 1, [1.0, 2.0]), (3, 1, [1.0, 2.0]), (4, 2, [1.0, 2.0]), (5, 2, [0.0, 0.0]), (6, 0, [0.0, 0.0]), (7, 0, [0.0, 0.0]),
            (8, None, [1.0, 2.0]), (9, 1, None), (12, 1, [None, 1.0]), (15, 1, [nan, 1.0]), (18, 2, [inf, 1.0]), (None, 1, [1.0, 2.0]),
            (21, 3, []), (24, 3, [1.0]), (27, 4, [-5.0, 1.0]), (30, 4, [9.0, -1.0]), (33, 5, [1.0, 2.0, 3.0]), (36, 5, [2.0])]
    assert found_in(spark, rows) == brute(rows, lambda a: a % 3 == 0)
    assert found_in(spark, []) == Counter() and found_in(spark, rows, lambda c: c < -1) == Counter()


def test_scores_beyond_double_precision(spark):
    big = float(1 << 31)
    rng = random.Random(2)
    rows = [(i, i % 2, [big - rng.randrange(3), float(rng.randrange(5)), 1.0]) for i in range(60)]
    assert found_in(spark, rows) == brute(rows, lambda a: a % 3 == 0)


def test_equal_rows_and_a_hot_label(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 100)
    monkeypatch.setattr(negatives, "BUCKET", 32)
    rows = [(i, 7 if i % 3 else i % 5, [3.0, 4.0, float(i % 4 == 0)]) for i in range(600)]
    assert found_in(spark, rows, lambda c: c % 40 == 0) == brute(rows, lambda a: a % 40 == 0)


def test_floors(spark):
    values = [0.0, 0.25, -0.25, 1e300, -1e18, -3.0, 255.9999]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    assert [r[0] for r in df.select(negatives.floored(F.col("v"))).collect()] == [float(math.floor(v)) for v in values]
