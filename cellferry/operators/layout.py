"""Order, samples, key buckets and split points."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import ROW_KEY

# The alphabet of the general split-point set.
SPLIT_ALPHABET = "123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Fixed value: share of the keys that a key sample takes.
SAMPLE_FRACTION = 0.001
# The five-prefix split-point set.
STAY_SPLITS = ("43", "53", "54", "62", "65")


def general_splits() -> list[str]:
    """``010`` to ``099``, then every pair of letters of the alphabet."""
    return [f"0{n}" for n in range(10, 100)] + [a + b for a in SPLIT_ALPHABET for b in SPLIT_ALPHABET]


def two_digit_splits() -> list[str]:
    """``00`` to ``69``."""
    return [f"{n:02d}" for n in range(70)]


def stay_splits() -> list[str]:
    """Five fixed prefixes."""
    return list(STAY_SPLITS)


SPLIT_SETS = {"general": general_splits, "two_digit": two_digit_splits, "stay": stay_splits}


def _literal_array(texts: Sequence[str]) -> Column:
    """A constant array, folded when the plan is optimised."""
    return F.split(F.lit("\n".join(texts)), "\n")


def bucket_number(key: Column, splits: Sequence[str]) -> Column:
    """Number of split points not above the key: 0 is the bucket before the first point.

    The points are searched in two steps, first every n-th one and then one stretch of n,
    so that a key is compared with about twice the square root of their number.
    """
    points = sorted(splits)
    width = max(1, round(len(points) ** 0.5))
    heads, every = _literal_array(points[::width]), _literal_array(points)
    stretch = F.size(F.filter(heads, lambda p: p <= key))
    begin = (stretch - 1) * width
    inside = F.size(F.filter(F.slice(every, begin + 1, F.lit(width)), lambda p: p <= key))
    return F.when(stretch == 0, F.lit(0)).otherwise(begin + inside)


# points that one step of a search compares with
_FANOUT = 16


def range_number(key: Column, splits: Sequence[str]) -> Column:
    """Number of split points not above the key, for any number of points and any keys.

    As :func:`bucket_number`, in as many steps as the points need: each compares with 16 of them
    at most, so 100,000 points take five steps. The points are constants of the plan.
    """
    points = sorted(set(splits))
    if not points:
        return F.lit(0)
    widths = [1]
    while widths[-1] * _FANOUT < len(points):
        widths.append(widths[-1] * _FANOUT)
    steps = F.from_json(F.lit(json.dumps([points[::width] for width in reversed(widths)])), "array<array<string>>")

    def step(found: Column, heads: Column) -> Column:
        # of every width-th point, those in the stretch found so far; found counts points of the step before
        begin = F.greatest((found - 1) * _FANOUT, F.lit(0))
        hits = F.size(F.filter(F.slice(heads, begin + 1, F.lit(_FANOUT)), lambda p: p <= key))
        return F.when(found == 0, F.lit(0)).otherwise(begin + hits)

    # the state of a fold is worked out once a step, however often a step names it; the first step has one stretch
    return F.aggregate(steps, F.lit(1), step)


def bucket_report(df: DataFrame, splits: Sequence[str], key: str = ROW_KEY) -> DataFrame:
    """Rows per bucket, a skew report.

    No split point is longer than the longest one, so a key's bucket follows from that many
    characters. Rows are counted per such prefix first and buckets are searched per prefix.
    """
    longest = max(len(p) for p in splits)
    counted = df.groupBy(F.substring(key, 1, longest).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    bucket = bucket_number(F.col("prefix"), splits).cast("bigint")
    return counted.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("row_count"))


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in order; each task keeps n, no full sort."""
    return df.orderBy(*order).limit(n)


def total_order(df: DataFrame, *order: str) -> DataFrame:
    """All rows in order, range partitioned."""
    return df.orderBy(*(order or (ROW_KEY,)))


def sorted_layout(df: DataFrame, files: int | None = None, order: Sequence[str] = (ROW_KEY,)) -> DataFrame:
    """Range partitions that are sorted within, for files with narrow key ranges."""
    spread = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order)


def sample_keys(df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int | None = None, key: str = ROW_KEY) -> DataFrame:
    """Distinct keys, each taken with the given chance."""
    return df.select(key).distinct().sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_keys_by_hash(df: DataFrame, fraction: float = SAMPLE_FRACTION, key: str = ROW_KEY) -> DataFrame:
    """Distinct keys whose hash is below the fraction: the same keys on every run.

    The choice depends on the key alone, so it is made before the distinct step and only
    the sample is shuffled.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    if fraction == 1:
        return df.select(key).distinct()
    cut = f"{int(fraction * 16**8):08x}"
    return df.select(key).where(F.substring(F.md5(F.col(key)), 1, 8) < F.lit(cut)).distinct()


def split_points(keys: DataFrame, tiles: int, key: str = ROW_KEY) -> DataFrame:
    """First key of each of ``tiles`` equal parts of the sorted distinct keys.

    Numbers follow ``ntile``: the first parts take one key more when they do not divide
    evenly. The sort is distributed: keys are range partitioned and numbered within their
    partition, and only the partition sizes are summed up in one place. The numbered keys
    are checkpointed, since both later steps must see the same partitions. Starts a job.
    """
    spark = keys.sparkSession
    ensure_checkpoint_dir(spark)
    ordered = sorted_layout(keys.select(key).distinct(), order=(key,))
    # the low 33 bits of this id count rows within a partition, the others number partitions
    ident = F.monotonically_increasing_id()
    numbered = ordered.select(
        key, F.shiftright(ident, 33).alias("part"), ident.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")
    ).checkpoint()
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, however many keys there are
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
        F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    placed = numbered.join(F.broadcast(offsets), "part")
    rank = F.col("ahead") + F.col("at")
    small = F.floor(F.col("total") / tiles)
    extra = F.col("total") % tiles
    in_large = extra * (small + 1)
    tile = F.when(rank < in_large, F.floor(rank / (small + 1))).otherwise(
        extra + F.floor((rank - in_large) / F.greatest(small, F.lit(1)))
    )
    return placed.groupBy((tile + 1).cast("int").alias("tile")).agg(F.min(key).alias("first_key"))


def weighted_split_points(rows: DataFrame, tiles: int, weight: str, key: str = ROW_KEY) -> DataFrame:
    """First key of each of at most ``tiles`` parts of the sorted keys with equal sums of weight.

    A part ends with the key that fills it, so it exceeds its share by less than one key's
    weight. Weights are summed per key before the keys are shuffled by range; running sums are
    taken inside a partition and only partition sums meet in one place. Starts a job.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    summed = rows.groupBy(key).agg(F.sum(weight).cast("bigint").alias("weight"))
    ordered = sorted_layout(summed, order=(key,))
    ident = F.monotonically_increasing_id()
    numbered = ordered.select(key, "weight", F.shiftright(ident, 33).alias("part"), ident.alias("at")).checkpoint()
    sums = numbered.groupBy("part").agg(F.sum("weight").alias("w"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, however many keys there are
    offsets = sums.select(
        "part",
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("ahead"),
        F.sum("w").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = numbered.withColumn("sofar", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
    placed = placed.join(F.broadcast(offsets), "part")
    share = (F.col("total").cast("double") / tiles)
    tile = F.when(F.col("total") > 0, F.floor((F.col("ahead") + F.col("sofar")) / share)).otherwise(F.lit(0))
    tile = F.least(tile, F.lit(tiles - 1))
    return placed.groupBy((tile + 1).cast("int").alias("tile")).agg(F.min(key).alias("first_key"))


def union_distinct(*identifiers: DataFrame) -> DataFrame:
    """Distinct values over any number of one-column scans; null values are left out."""
    stacked = reduce(DataFrame.unionByName, identifiers)
    return stacked.where(F.col(stacked.columns[0]).isNotNull()).distinct()
