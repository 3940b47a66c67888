"""Operators on small tables, beside plain Python."""

import datetime as dt
import itertools
import random

import pytest
from plans_of import plan_of
from pyspark.sql import functions as F

from cellferry import names
from cellferry.functions.dates import digits14
from cellferry.operators import cells, dedupe, keys, layout, quality, typemap, upsert, windows
from cellferry.sources import tables


# ---- names and scans ---------------------------------------------------------------------


def test_names_bind_in_any_case(spark):
    df = spark.sql("select 1 as Ab, 2 as CD_1")
    assert names.bind(df, "aB") == "Ab" and names.bind_all(df, " cd_1 ,, AB") == ["CD_1", "Ab"]
    for wrong in ("x", ""):
        with pytest.raises(ValueError):
            names.bind(df, wrong)
    with pytest.raises(ValueError, match="empty"):
        names.bind_all(df, " , ")
    assert names.rename_case(df, upper=True).columns == ["AB", "CD_1"]
    assert names.rename_case(df, keep=["Ab"]).columns == ["Ab", "cd_1"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="collide"):
            names.rename_case(spark.sql("select 1 as a, 2 as A"))
        with pytest.raises(ValueError, match="ambiguous"):
            names.bind(spark.sql("select 1 as a, 2 as A"), "a")
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_scan_of_a_named_database(spark, small):
    spark.sql("create database if not exists scans")
    spark.sql(f"create table if not exists scans.regions using parquet location '{small}/region.parquet'")
    assert tables.read_table(spark, "scans.regions").count() == 5
    row = tables.read_table(spark, "scans.regions", "upper(r_name) as n, concat('{', r_regionkey, ',', '}') as b").orderBy("b").first()
    assert tuple(row) == (row.n.upper(), "{0,}")


def test_key_range(spark):
    keys_ = ["20200322_9", "20200323", "20200323_1", "20200324_z", "20200324~", "20200325", None]
    df = spark.createDataFrame([(k,) for k in keys_], "row_key string")
    assert sorted(r[0] for r in tables.key_range(df, "20200323", "20200324~").collect()) == keys_[1:4]


def test_key_range_with_a_day_bound_keeps_the_same_rows(spark):
    start = dt.datetime(2020, 3, 20)
    rows = [(start + dt.timedelta(hours=5 * i), i) for i in range(60)] + [(None, 99)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, i int")
    key = F.concat_ws("_", F.coalesce(F.substring(digits14(F.col("ts")), 1, 8), F.lit("null")), "i")
    for low, high in [("20200323", "20200324~"), ("20200323_1", "20200325_4"), ("2020", "20200326"), ("20200330", "zzz"), ("n", "o")]:
        plain = {r.i for r in tables.key_range(df, low, high, key).collect()}
        assert {r.i for r in tables.key_range(df, low, high, key, day_column="ts").collect()} == plain


def test_read_cell(spark):
    wide = spark.sql("select 'k' as row_key, 'v' as Zjhm")
    assert tables.read_cell(wide, "zjhm").first()[0] == "v"
    assert tables.read_cell(cells.to_cells(wide), "Zjhm").first()[0] == "v"


def test_control_query(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "a", "y")], "Id int, Kind string, Note string")
    out = tables.control_query(df, [("KIND", "=", "a"), ("id", ">", None), ("note", "=", "  ")], ("ID", "desc"))
    assert [tuple(r) for r in out.collect()] == [("3", "a", "y"), ("1", "a", None)]
    assert out.columns == ["id", "kind", "note"]
    assert tables.control_query(df).count() == 3
    assert tables.control_query(df, [("note", "like", "%x%")], columns=["ID"]).collect()[0][0] == "2"
    with pytest.raises(KeyError):
        tables.control_query(df, [("id", "; drop", 1)])


# ---- literal rows: keep one, distinct, collected cells --------------------------------------

def _cell_log(seed: int) -> list[tuple[int, str, str | None, str | None]]:
    """Writes to cells of some stations, in order: repeats anywhere, and values that are null."""
    rng = random.Random(seed)
    names = ["depth", "flow", "ice", "ph", "turbid"]
    return [
        (at, f"st-{rng.randrange(4)}", rng.choice(names), None if rng.random() < 0.2 else f"{rng.randrange(90) / 10}")
        for at in range(60)
    ]


@pytest.mark.parametrize("seed", [2, 11])
def test_literal_rows(spark, seed):
    log = _cell_log(seed)
    df = tables.literal_table(spark, log, "i int, key string, name string, value string").repartition(3)
    last_row, first_cell = {}, {}
    for at, key, name, value in log:
        last_row[key] = (at, name, value)
        first_cell.setdefault((key, name), value)
    assert {r.key: (r.i, r.name, r.value) for r in dedupe.keep_latest(df, "key", ["i"]).collect()} == last_row
    assert {tuple(r) for r in dedupe.distinct_values(df, "key,name").collect()} == set(first_cell)
    assert dedupe.distinct_records(df.drop("i")).count() == len({row[1:] for row in log})
    assert dedupe.distinct_records(df.unionByName(df.where("i % 4 = 1"))).count() == len(log)
    long = df.select("i", F.col("key").alias("row_key"), F.col("name").alias("qualifier"), "value")
    expected = {}
    for key, name in sorted(first_cell):
        expected.setdefault(key, []).append((name, first_cell[key, name]))
    assert {r.row_key: [tuple(c) for c in r.cells] for r in cells.collect_cells(long, ["i"]).collect()} == expected


def test_the_survivor_does_not_depend_on_partitioning(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(6), rng.choice([None, 1, 2]), rng.randrange(5), rng.choice("abc")) for _ in range(400)]
    best = {}
    for row in rows:
        rank = (row[1] is not None, row[1] or 0, row[2], row[3])
        best[row[0]] = max(best.get(row[0], rank), rank)
    for parts in (1, 3, 9):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, t int, n int, s string").repartition(parts)
        got = {r.k: (r.t is not None, r.t or 0, r.n, r.s) for r in dedupe.keep_latest(df, "k", ["t"]).collect()}
        assert got == best


def test_keep_latest_limits_each_key_before_the_shuffle(spark, small):
    plan = plan_of(dedupe.keep_latest(spark.read.parquet(f"{small}/lineitem.parquet"), "l_suppkey", ["l_shipdate"]))
    assert plan.count("Exchange") == 1
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def nodes_of(node):
    """All nodes of a plan that has run, inside adaptive stages as well."""
    yield node
    kind = node.getClass().getSimpleName()
    inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
    children = node.children()
    for child in inner + [children.apply(i) for i in range(children.size())]:
        yield from nodes_of(child)


def shuffled_rows(df) -> int:
    df.collect()
    written = [n.metrics().get("shuffleRecordsWritten") for n in nodes_of(df._jdf.queryExecution().executedPlan())]
    return sum(m.get().value() for m in written if m.isDefined())


def test_a_hot_key_sends_one_row_per_task(spark):
    # two thirds of the rows share a key
    df = spark.range(60_000, numPartitions=8).selectExpr("if(id % 3 = 0, id, -1) as k", "id as t", "repeat('x', 20) as pad")
    kept = dedupe.keep_latest(df, "k", ["t"])
    assert kept.where("k = -1").first().t == 59_999
    assert kept.count() == 20_001
    assert shuffled_rows(dedupe.keep_latest(df, "k", ["t"])) <= 20_000 + 8


def test_hot_keys_are_merged_before_other_shuffles(spark):
    df = spark.range(40_000, numPartitions=8).selectExpr("'hot' as row_key", "cast(id % 5 as string) as qualifier", "cast(id as string) as value", "id")
    assert shuffled_rows(cells.collect_cells(df, ["id"])) <= 8 * 5 + 8
    assert shuffled_rows(upsert.newest_cells(df.selectExpr("row_key", "'f' as family", "qualifier", "value", "id as __batch_no"))) <= 8 * 5
    assert shuffled_rows(dedupe.greatest_row(df, "id", ["row_key"])) <= 8
    assert shuffled_rows(layout.bucket_report(df, layout.stay_splits())) <= 8 + 8


def test_greatest_row(spark):
    rows = [("a", "12", 1), ("a", "9", 2), ("a", "x", 3), ("b", "0x99", 4), ("b", None, 5), ("c", "7", 6), ("c", "7", 8)]
    df = spark.createDataFrame(rows, "g string, c string, i int")
    assert {(r.g, r.i) for r in dedupe.greatest_row(df, "C", ["g"]).collect()} == {("a", 1), ("b", 4), ("c", 8)}
    assert dedupe.greatest_row(df, "c").first().i == 1
    assert dedupe.greatest_row(df.where("false"), "c").count() == 0


# ---- keys and cells ----------------------------------------------------------------------


def test_row_key(spark):
    df = spark.sql("select 7 as a, cast(null as string) as b, 'a' as c, ' ' as d, timestamp_ntz'2020-03-23 10:11:12.5' as e")
    assert keys.with_row_key(df, "A,b,c,D,e").first().row_key == "7_null_a_null_20200323101112"
    with pytest.raises(ValueError):
        keys.row_key(df, " , ")


def test_cells_there_and_back(spark):
    records = spark.createDataFrame([("k2", "x", None), ("k1", "", "y")], "row_key string, b string, a string")
    long = cells.to_cells(records)
    assert {tuple(r) for r in long.collect()} == {
        ("k1", "cf1", "a", "y"), ("k1", "cf1", "b", ""), ("k2", "cf1", "a", ""), ("k2", "cf1", "b", "x")}
    assert {tuple(r) for r in cells.from_cells(long, ["a", "b"]).collect()} == {("k1", "y", ""), ("k2", "", "x")}
    assert {tuple(r) for r in cells.lookup_cell(long, "a", "d").collect()} == {("k1", "y"), ("k2", "d")}
    assert {tuple(r) for r in cells.lookup_cell(long, "zz", "d").collect()} == {("k1", "d"), ("k2", "d")}
    assert "Exchange" not in plan_of(long)
    assert plan_of(cells.from_cells(long, ["a", "b"])).count("Exchange") == 1


def test_upsert(spark):
    target = spark.createDataFrame([("a", "1", "1"), ("b", "1", "1")], "row_key string, x string, y string")
    first = spark.createDataFrame([("b", "2"), ("c", "2")], "row_key string, x string")
    second = spark.createDataFrame([("b", "", "3")], "row_key string, y string, z string")
    expected = {("a", "1", "1", None), ("b", "2", "", "3"), ("c", "2", None, None)}
    merged = upsert.upsert_records(target, first, second)
    assert {tuple(r) for r in merged.collect()} == expected
    again = upsert.upsert_records(target, first, second, second)
    assert {tuple(r) for r in again.collect()} == expected
    merged_cells = upsert.upsert_cells(cells.to_cells(target), cells.to_cells(first))
    assert {(r.row_key, r.qualifier, r.value) for r in merged_cells.collect()} == {
        ("a", "x", "1"), ("a", "y", "1"), ("b", "x", "2"), ("b", "y", "1"), ("c", "x", "2")}


# ---- windows and cursors -----------------------------------------------------------------


def test_windows():
    of = windows.CursorWindow.of
    assert of(None) == of(" ") == windows.CursorWindow()
    assert of("20240105000000", "").stop is None and of("20240105000000", "0").stop is None and of("20240105000000", 0).stop is None
    assert of("20240105000000", " 7 ").stop == "20240112000000"
    assert of("2024/2/28", 1).stop == "20240229000000" and of("20240228", 2).stop == "20240301000000"
    with pytest.raises(ValueError):
        of("nonsense", 3)
    assert windows.read_cursor("2024年01月05日") == dt.datetime(2024, 1, 5)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_window_bounds_by_type(spark, kind):
    days = [f"2024-01-{d:02d}" for d in range(1, 20)]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast(kind).alias("c"))
    count = lambda w: windows.in_window(df, "C", w).count()
    assert count(windows.CursorWindow.of("20240105000000", 7)) == 7
    assert count(windows.CursorWindow.of("20240105000000")) == 15
    assert count(windows.CursorWindow.of("20240105000000", inclusive=False)) == 14
    assert count(windows.CursorWindow.of("")) == 19


STARTS, STOP, NOW = "20240105000000", "20240112000000", dt.datetime(2024, 1, 10)


@pytest.mark.parametrize(
    "policy, greatest, now, expected",
    [
        ("carry", None, NOW, STARTS),
        ("carry", dt.datetime(2024, 1, 6, 1), NOW, "20240106010000"),
        ("advance", None, NOW, "20240110000000"),
        ("advance", None, dt.datetime(2025, 1, 1), STOP),
        ("advance", None, dt.datetime(2020, 1, 1), STARTS),
        ("advance", dt.datetime(2024, 1, 6, 1), NOW, "20240106010000"),
        ("advance", dt.datetime(2024, 1, 5, 0, 0, 0, 700), NOW, "20240110000000"),
    ],
)
def test_next_cursor(spark, policy, greatest, now, expected):
    window = windows.CursorWindow.of(STARTS, 7)
    assert windows.next_cursor(greatest, window, policy, now) == expected
    df = spark.createDataFrame([(greatest,)], "g timestamp_ntz")
    column = windows.next_cursor_column(
        digits14(F.col("g")), F.lit(window.start), F.lit(window.stop), policy, F.lit(now.strftime("%Y%m%d%H%M%S"))
    )
    assert df.select(column).first()[0] == expected


def test_next_cursor_without_window_end(spark):
    for window, greatest, expected in [
        (windows.CursorWindow.of(STARTS), None, STARTS),
        (windows.CursorWindow.of(STARTS), dt.datetime(2024, 1, 5), STARTS),
        (windows.CursorWindow.of(""), None, None),
        (windows.CursorWindow.of(""), dt.datetime(2024, 1, 5), STARTS),
    ]:
        assert windows.next_cursor(greatest, window, "advance", NOW) == expected
        df = spark.createDataFrame([(greatest, window.start, window.stop)], "g timestamp_ntz, a string, b string")
        column = windows.next_cursor_column(digits14(F.col("g")), F.col("a"), F.col("b"), "advance", F.lit("20240110000000"))
        assert df.select(column).first()[0] == expected
    with pytest.raises(ValueError):
        windows.next_cursor(None, windows.CursorWindow(), "other")


def test_cursor_time_of_text(spark):
    df = spark.createDataFrame([("20240105",), ("2024/1/6 1:2:3",), ("2024-01-07 00:00:00.5",), ("x",)], "c string").coalesce(1)
    assert [r[0] for r in df.select(windows.cursor_time(df, "C")).collect()] == [
        dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6, 1, 2, 3), dt.datetime(2024, 1, 7), None]


# ---- layout ------------------------------------------------------------------------------


def test_split_sets():
    general = layout.general_splits()
    assert len(general) == len(set(general)) == 90 + 35 * 35
    assert general[0] == "010" and general[89] == "099" and general[90] == "11" and general[-1] == "ZZ"
    assert layout.two_digit_splits()[0] == "00" and layout.two_digit_splits()[-1] == "69"
    assert general == sorted(general)


@pytest.mark.parametrize("which", sorted(layout.SPLIT_SETS))
def test_bucket_numbers(spark, which):
    points = layout.SPLIT_SETS[which]()
    rng = random.Random(which)
    texts = ["".join(rng.choice("019AZ_a甲") for _ in range(rng.randrange(5))) for _ in range(300)] + points[:40] + points[-40:]
    df = spark.createDataFrame([(t,) for t in texts], "row_key string")
    expected = {t: sum(p.encode() <= t.encode() for p in points) for t in texts}
    got = {r.row_key: r.b for r in df.select("row_key", layout.bucket_number(F.col("row_key"), points).alias("b")).collect()}
    assert got == expected
    report = {r.bucket: r.row_count for r in layout.bucket_report(df, points).collect()}
    counted = [expected[t] for t in texts]
    assert report == {b: counted.count(b) for b in set(counted)}


@pytest.mark.parametrize("n, tiles", [(100, 7), (96, 8), (5, 9), (1, 1), (0, 4), (2000, 16)])
def test_split_points_follow_ntile(spark, n, tiles):
    values = sorted(f"{i * 7919 % 100003:06d}" for i in range(n))
    df = spark.createDataFrame([(v,) for v in values + values[:3]], "row_key string").repartition(5)
    got = {r.tile: r.first_key for r in layout.split_points(df, tiles).collect()}
    size, extra = divmod(n, tiles)
    starts = list(itertools.accumulate([size + (t < extra) for t in range(tiles)], initial=0))
    assert got == {t + 1: values[starts[t]] for t in range(tiles) if starts[t] < starts[t + 1]}


def test_hash_sample(spark):
    df = spark.range(4000).selectExpr("cast(id % 2000 as string) as row_key")
    small, large = ({r[0] for r in layout.sample_keys_by_hash(df, f).collect()} for f in (0.05, 0.2))
    assert small < large and 50 < len(small) < 160
    assert layout.sample_keys_by_hash(df, 1.0).count() == 2000 and layout.sample_keys_by_hash(df, 0.0).count() == 0
    with pytest.raises(ValueError):
        layout.sample_keys_by_hash(df, 1.5)
    plan = plan_of(layout.sample_keys_by_hash(df, 0.05))
    assert plan.index("Exchange") < plan.index("md5")


def test_union_distinct_drops_nulls(spark):
    a, b = spark.createDataFrame([("1",), (None,)], "v string"), spark.createDataFrame([("1",), ("2",)], "v string")
    assert sorted(r[0] for r in layout.union_distinct(a, b, a).collect()) == ["1", "2"]
    assert plan_of(layout.union_distinct(a, b, a)).count("Exchange") == 1


# ---- quality and types -------------------------------------------------------------------


def test_row_filters(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, " ", "b"), (3, "a", None)], "i int, x string, y string")
    assert sorted(r.i for r in quality.rows_with_blank(df, "X,y").collect()) == [2, 3]
    assert [r.i for r in quality.rows_listed(df, "y", "b,c").where("i = 1").collect()] == [1]
    with pytest.raises(ValueError):
        quality.rows_with_blank(df, "")


def test_sink_types(spark):
    df = spark.sql(
        "select 1.23456D as d, cast(0.1 as float) as f, timestamp_ntz'2020-01-01 01:02:03.9' as t, true as b, 'x' as s, date'2020-01-01' as e"
    )
    out = typemap.cast_for_sink(df)
    assert dict(out.dtypes) == {"d": "decimal(19,4)", "f": "decimal(19,4)", "t": "timestamp_ntz", "b": "boolean", "s": "string", "e": "date"}
    row = out.first()
    assert (str(row.d), str(row.f), row.t) == ("1.2346", "0.1000", dt.datetime(2020, 1, 1, 1, 2, 3))
    assert typemap.create_column_types(df) == "`d` DECIMAL(19,4), `f` DECIMAL(19,4), `b` DECIMAL(1), `s` VARCHAR(255)"
    assert typemap.SINK_TYPES["bigint"] == "NUMBER(19)" and typemap.SINK_TYPES["timestamp"] == "DATE"


def test_sink_report_counts_misfits(spark):
    df = spark.createDataFrame([("x" * 256, 1e20), ("x" * 255, 1.0), (None, None)], "s string, d double")
    assert {r.column_name: r.misfits for r in typemap.sink_report(df).collect()} == {"s": 1, "d": 1}
    assert typemap.sink_report(df.selectExpr("1 as i")).count() == 0
    assert plan_of(typemap.sink_report(df)).count("Exchange") == 1


@pytest.mark.parametrize(
    "size, scale, kind",
    [(0, 5, "decimal(38,10)"), (1, 0, "boolean"), (3, 0, "int"), (5, 0, "int"), (10, 0, "int"), (19, 0, "bigint"), (19, 4, "float"),
     (19, 2, None), (38, -127, "decimal(38,10)"), (12, 2, None)],
)
def test_source_types(size, scale, kind):
    assert typemap.source_type(size, scale) == kind


def test_source_casts(spark):
    df = spark.sql("select cast(1 as decimal(1,0)) as a, cast(5 as decimal(12,2)) as b, 'x' as c")
    out = typemap.cast_from_source(df, {"A": (1, 0), "b": (12, 2)})
    assert dict(out.dtypes) == {"a": "boolean", "b": "decimal(12,2)", "c": "string"}
    assert typemap.source_schema({"A": (1, 0), "b": (12, 2), "n": (0, 0)}) == "A boolean, n decimal(38,10)"
