"""Range layouts: stored split points, manifests, cuts, pruned reads."""

import random

import pytest
from plans_of import plan_of
from pyspark.sql import functions as F

from cellferry.operators.layout import range_number, weighted_split_points
from cellferry.sinks import ranged
from cellferry.sinks.files import observed
from cellferry.sinks.ranged import RANGE, RangedTable


def made(spark, keys, value="v"):
    return spark.createDataFrame([(k, f"{value}{k}") for k in keys], "row_key string, x string")


def rows_of(df):
    return {r.row_key: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 300, 4100])
def test_range_numbers_by_search(spark, one, n):
    rng = random.Random(n)
    points = sorted({"".join(rng.choices("ab\n,\"é~", k=rng.randint(1, 9))) for _ in range(n)})
    keys = points[:40] + ["", "~~~~", "b"] + ["".join(rng.choices("ab\n,\"é~", k=5)) for _ in range(60)]
    expected = [sum(p.encode() <= k.encode() for p in points) for k in keys]
    assert one(lambda c: range_number(c, points), keys) == expected


def test_points_by_weight(spark):
    rng = random.Random(5)
    rows = [(f"{i:05d}", 1 + rng.randrange(50) if i % 3 else 400) for i in range(3000)]
    rows += rows[:500]
    summed = {}
    for k, w in rows:
        summed[k] = summed.get(k, 0) + w
    share, sofar, first = sum(summed.values()) / 7, 0, {}
    for k in sorted(summed):
        first.setdefault(int(sofar // share) + 1, k)
        sofar += summed[k]
    df = spark.createDataFrame(rows, "row_key string, weight long").repartition(5)
    assert {r.tile: r.first_key for r in weighted_split_points(df, 7, "weight").collect()} == first
    assert weighted_split_points(df.where("false"), 7, "weight").count() == 0


def test_two_batches_have_the_same_ranges(spark, tmp_path):
    table = RangedTable(spark, str(tmp_path / "t"), range_bytes=4000)
    assert table.records().count() == 0 and table.splits() == []
    keys = [f"{i:05d}" for i in range(2000)]
    assert table.put(made(spark, keys)).rows == 2000
    points = table.splits()
    assert 8 <= len(points) <= 20
    later = made(spark, keys[1990:] + ["x1", "0"], "w").withColumn("y", F.lit("new"))
    assert table.put(later).rows == 12 and table.splits() == points
    bounds = {}
    for r in table.manifest().collect():
        low, high = bounds.get(r[RANGE], (r.first_key, r.last_key))
        bounds[r[RANGE]] = (min(low, r.first_key), max(high, r.last_key))
    ordered = [bounds[r] for r in sorted(bounds)]
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))
    expected = {k: {"row_key": k, "x": f"v{k}", "y": None} for k in keys[:1990]}
    expected |= {k: {"row_key": k, "x": f"w{k}", "y": "new"} for k in keys[1990:] + ["x1", "0"]}
    assert rows_of(table.records()) == expected
    part = table.records("00100", "00120")
    assert rows_of(part) == {k: v for k, v in expected.items() if "00100" <= k < "00120"}
    assert len(table.files("00100", "00120")) <= 2 < len(table.files())
    assert len(part.inputFiles()) <= 2 and "GreaterThanOrEqual(row_key,00100)" in plan_of(part)
    assert rows_of(table.records(stop="00003")).keys() == {"0", "00000", "00001", "00002"}
    assert table.put(made(spark, [])).rows == 0 and rows_of(table.records()) == expected


def test_skewed_records_get_ranges_of_equal_bytes(spark, tmp_path):
    """A hundredth of the keys holds most of the bytes."""
    df = spark.range(4000).select(
        F.format_string("%05d", "id").alias("row_key"),
        F.expr("concat_ws('', transform(sequence(1, if(id < 40, 400, 4)), i -> md5(concat(id, i))))").alias("x"),
    )
    table = RangedTable(spark, str(tmp_path / "t"), range_bytes=200_000)
    table.put(df)
    weights = df.select("row_key", (F.length("x") + 7).alias("b"))
    sizes = [r[1] for r in weights.groupBy(range_number(F.col("row_key"), table.splits())).sum("b").collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2 * min(sizes)


def test_a_range_that_outgrows_its_limit_is_cut(spark, tmp_path):
    text = "concat_ws('', transform(sequence(1, 20), i -> md5(concat(id, i, '{}'))))"

    def batch(low, high, salt):
        rows = spark.range(low, high).select(F.format_string("%05d", "id").alias("row_key"), F.expr(text.format(salt)).alias("x"))
        return rows.repartition(4)

    table = RangedTable(spark, str(tmp_path / "t"), range_bytes=400_000)
    table.put(batch(0, 3000, "a"))
    assert table.cut() == []
    for n, salt in enumerate("bcd"):
        table.put(batch(100 + n * 1000, 1100 + n * 1000, salt))
        table.put(batch(100, 700, salt))
    before, points, newest = table.manifest().collect(), table.splits(), rows_of(table.records())
    whole = table.records()
    large = {r[RANGE] for r in table.range_sizes().where("bytes > 400000").collect()}
    assert large and set(table.cut()) == large
    assert set(points) < set(table.splits())
    assert rows_of(table.records()) == newest and rows_of(whole) == newest
    after = {r.file for r in table.manifest().collect()}
    assert {r.file for r in before if r[RANGE] not in large} <= after
    assert table.range_sizes().where("bytes > 400000").count() == 0 and table.cut() == []
    table.put(batch(0, 10, "e"))
    assert rows_of(table.records("00000", "00020"))["00003"]["x"] != newest["00003"]["x"]


def test_a_batch_beside_another_writer(spark, tmp_path, monkeypatch):
    table, other = RangedTable(spark, str(tmp_path / "t")), RangedTable(spark, str(tmp_path / "t"))
    table.put(made(spark, "abc", "1"))
    plain, done = RangedTable._write, []

    def write(self, *rest, **named):
        if self is table and not done:
            done.append(1)
            other.put(made(spark, "bd", "2"))
        return plain(self, *rest, **named)

    monkeypatch.setattr(RangedTable, "_write", write)
    table.put(made(spark, "ab", "3"))
    # the other one took its number while this one was writing
    assert {k: v["x"] for k, v in rows_of(other.records()).items()} == {"a": "3a", "b": "2b", "c": "1c", "d": "2d"}


def test_search_names_its_points_once(spark):
    """However many steps a search takes, its expression grows with the points only, and keys are found as before."""
    points = [f"{i:05d}" for i in range(0, 20_000, 4)]
    found = range_number(F.col("k"), points)
    assert str(found).count("from_json") == 1
    keys = spark.createDataFrame([(k,) for k in ("", "00000", "00003", "00004", "09999", "19996", "2", None)], "k string")
    assert [r[0] for r in keys.select(found).collect()] == [0, 1, 1, 2, 2500, 5000, 5000, 0]


def test_keys_are_searched_after_they_are_dealt(spark, tmp_path, monkeypatch):
    """Dealing rows to tasks needs their keys alone: no search before the shuffle, which would run again to draw its bounds."""
    dealt = []
    monkeypatch.setattr(ranged, "range_number", lambda key, splits: dealt.append(splits) or F.length(F.lit("ab")))
    plans = []
    monkeypatch.setattr(ranged, "observed", lambda df, cursor: plans.append(df) or observed(df, cursor))
    RangedTable(spark, str(tmp_path / "t")).put(spark.range(10).selectExpr("cast(id as string) as row_key", "'x' as a"))
    plan = plans[0]._jdf.queryExecution().analyzed().toString()
    assert len(dealt) == 1 and plan.index("length(ab)") < plan.index("RepartitionByExpression")
