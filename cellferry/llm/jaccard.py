"""Exact Jaccard join of shingle sets by parity sketches.

The shingles of a document are dealt by hash to the parts of a sketch, and each part is the XOR of
its shingles. A shingle that only one of two documents has changes one part, so at most as many
parts differ as the symmetric difference has members. A pair with sizes a and b links only if that
difference is at most (a + b) / 9 (at a similarity of 0.8), so a sketch of more parts than that has
an equal part in both: the pigeonhole. Documents meet on equal parts, inside bands of set size.

The first of the equal parts that are not empty has at most as many full parts before it as the
difference has members, so a document posts only that many and one more.

An equal part must not be empty. A document whose empty parts could be the only equal ones posts a
second sketch by another hash, and so on; a partner that needs it does the same, and after
``SKETCHES`` of them, the shingles themselves are posted. So no link is lost.

Each document is verified first with the one earlier document that it meets on most keys, which
joins most groups. Then, round by round, each is verified with the closest document of its keys that
is not connected to it yet, by a parity sketch of single bits, whose Hamming distance is a lower
bound of the symmetric difference. When that links nothing more, all pairs inside keys that are
still not connected, and that sizes and sketches allow, are verified by their sets. No key gives out
its other pairs, and a key of very many documents is cut into tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, in_arrow, ship, small_enough, text_bytes, texts
from .components import components
from .shingles import mix, shingle_set, text_words

SKETCHES = 8
POSTING_SLICE = 4 << 20
TILE = 4000
BLOCK, PAIRS_AT_ONCE = 256, 1 << 15


@lru_cache(maxsize=None)
def band_of(size: int) -> tuple[int, int]:
    """First and last size of the band of a size. A band ends at twice its start."""
    low = 1
    while True:
        high = 2 * low - 1
        if size <= high:
            return low, high
        low = high + 1


def bands(size: int, percent: int) -> list[tuple[int, int]]:
    """The bands in which a document of this size can have a partner of its size or more."""
    most, out = size * 100 // percent, [band_of(size)]
    while out[-1][1] < most:
        out.append(band_of(out[-1][1] + 1))
    return out


def differing(a: int, b: int, percent: int) -> int:
    """The greatest symmetric difference of linked sets of sizes a and b."""
    return (a + b) * (100 - percent) // (100 + percent)


def postings(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Join keys of one document: the parts of its sketches in each band."""
    out, size = [], len(shingles)
    for low, high in bands(size, percent):
        bound = differing(high, high, percent)
        parts = bound + 1 + (bound + 4) // 5 if bound else 1
        own = differing(size, min(high, size * 100 // percent), percent)
        for sketch in range(SKETCHES + 1):
            salt = np.full(1, (low << 8) + sketch, np.uint64)
            mixed = mix(shingles + salt * np.uint64(0x9E3779B97F4A7C15))
            if sketch == SKETCHES:
                out.append(mixed)
                break
            part = ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            sums = np.zeros(parts, np.uint64)
            np.bitwise_xor.at(sums, part, mixed)
            full = np.flatnonzero(np.bincount(part, minlength=parts))
            # The first full part that is equal in both has at most ``own`` full parts before it.
            used = full[: own + 1]
            out.append(mix(sums[used] + used.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + salt))
            if len(full) > own:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """A parity sketch of single bits, two or more for each member: it may be folded to any smaller size."""
    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    flat = np.zeros(bits, np.uint8)
    np.bitwise_xor.at(flat, (mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & np.uint64(bits - 1)).astype(np.int64), 1)
    return np.packbits(flat, bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def possible(n: int, sketch: np.ndarray, others: list[tuple[int, np.ndarray]], percent: int) -> np.ndarray:
    """Which of the other sets may be similar enough: their sizes and the Hamming distance allow it."""
    out = np.zeros(len(others), bool)
    for words in {min(len(sketch), len(s)) for _, s in others}:
        mine = [i for i, (_, s) in enumerate(others) if min(len(sketch), len(s)) == words]
        apart = np.bitwise_count(np.stack([folded(others[i][1], words) for i in mine]) ^ folded(sketch, words)).sum(1, dtype=np.int64)
        size = np.array([others[i][0] for i in mine])
        fits = (100 * np.minimum(size, n) >= percent * np.maximum(size, n)) & (apart <= (size + n) * (100 - percent) // (100 + percent))
        out[np.array(mine)[fits]] = True
    return out


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _sets(batch: pa.RecordBatch, words: int) -> list[np.ndarray]:
    return [shingle_set(hashes, words) for hashes in text_words(*text_bytes(batch.column("text")))]


def shingle_sets(docs: DataFrame, words: int, with_set: bool = False) -> DataFrame:
    """``id``, ``n``, two hashes ``h1``, ``h2`` of the set, and its parity sketch, or its members ``with_set``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets(batch, words)
        one = np.array([np.add.reduce(s, dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
        two = np.array([np.bitwise_xor.reduce(mix(s)) if len(s) else 0 for s in sets], np.uint64)
        arrays = [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), signed(one), signed(two)]
        arrays.append(pa.array([(s if with_set else parity(s)).tobytes() for s in sets], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, ["id", "n", "h1", "h2", kind])

    kind = "members" if with_set else "sketch"
    return in_arrow(docs, work, f"id long, n long, h1 long, h2 long, {kind} binary", POSTING_SLICE)


def posted(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows of (place, key, node, leader, leads). Of a slice's documents, only one per set is posted.

    Of one key's documents in a slice, the first leads: its row is placed by the key and meets
    other slices there. The rows of those it leads are placed apart, so a key that very many
    documents share brings one row per slice to its place.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        seen: set[bytes] = set()
        keys, nodes = [], []
        for i, members in zip(ids.tolist(), _sets(batch, words)):
            raw = members.tobytes()
            if len(members) and raw not in seen:
                seen.add(raw)
                made = postings(members, percent)
                keys.append(made)
                nodes.append(np.full(len(made), i, np.int64))
        if not keys:
            return None
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.argsort(key, kind="stable")
        key, node = key[order], node[order]
        first = np.append(True, key[1:] != key[:-1])
        leader = node[first][np.cumsum(first) - 1]
        place = np.where(first, key, mix(key ^ node.astype(np.uint64)))
        own = pa.array(leader, pa.int64(), mask=first)  # null: it leads itself
        leads = pa.array(first & ~np.append(first[1:], True))
        return pa.RecordBatch.from_arrays(
            [signed(place), pa.array(key.view(np.int64), pa.int64(), mask=first), pa.array(node, pa.int64()), own, leads],
            ["place", "key", "node", "leader", "leads"],
        )

    return in_arrow(docs, work, "place long, key long, node long, leader long, leads boolean", POSTING_SLICE)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by the sets themselves."""
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", F.col("right").alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for left, right in zip(batch.column("left").to_pylist(), batch.column("text").to_pylist()):
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
            keep.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return in_arrow(joined, work, "a long, b long")


def sketched(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out."""
    left = sketches.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("left"))
    right = sketches.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("text"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides = zip(*[batch.column(c).to_pylist() for c in ("na", "left", "nb", "text")])
        keep = [
            bool(possible(na, np.frombuffer(x, np.uint64), [(nb, np.frombuffer(y, np.uint64))], percent)[0]) for na, x, nb, y in sides
        ]
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return in_arrow(joined, work, "a long, b long")


def _allowed(rows: list[tuple], percent: int, nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of the rows (side, rep, component, n, sketch) of one tile, in blocks, with their Hamming distance."""
    if len(rows) < 2:
        return
    side, rep, component, n = (np.array(c, np.int64) for c in list(zip(*rows))[:4])
    sketches = [np.frombuffer(r[4], np.uint64) for r in rows]
    words = min(map(len, sketches))
    flat = np.stack([folded(s, words) for s in sketches])
    for start in range(0, len(rows), BLOCK):
        i = slice(start, start + BLOCK)
        pick = (component[i, None] != component) & ((side[i, None] < 0) | (side[i, None] != side))
        pick &= 100 * np.minimum(n[i, None], n) >= percent * np.maximum(n[i, None], n)
        if not nearest:
            pick &= rep[i, None] < rep
        one, two = np.nonzero(pick)
        one += start
        for part in range(0, len(one), PAIRS_AT_ONCE):
            a, b = one[part : part + PAIRS_AT_ONCE], two[part : part + PAIRS_AT_ONCE]
            apart = np.bitwise_count(flat[a] ^ flat[b]).sum(1, dtype=np.int64)
            fits = apart <= (n[a] + n[b]) * (100 - percent) // (100 + percent)
            a, b, apart = a[fits], b[fits], apart[fits]
            if nearest:  # of one row's partners, the one least apart
                order = np.lexsort([apart, a])
                a, b, apart = a[order], b[order], apart[order]
                first = np.append(True, a[1:] != a[:-1])[: len(a)]
                a, b, apart = a[first], b[first], apart[first]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b]), pa.array(apart)], ["a", "b", "apart"])


def across(rows: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """Of rows (key, x, y, side, rep, component, n, sketch): pairs of one tile in different components
    that sizes and sketches do not rule out; with ``nearest``, only the closest partner of each row.
    A key of more than ``TILE`` rows is several tiles."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile: tuple | None = None
        held: list[tuple] = []  # at most about two groups of TILE / 2 rows
        for batch in batches:
            for *place, side, rep, component, n, sketch in zip(*[c.to_pylist() for c in batch.columns]):
                if place != tile:
                    yield from _allowed(held, percent, nearest)
                    tile, held = place, []
                held.append((side, rep, component, n, sketch))
        yield from _allowed(held, percent, nearest)

    ship(rows)
    ordered = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "rep")
    return ordered.select("key", "x", "y", "side", "rep", "component", "n", "sketch").mapInArrow(meet, "a long, b long, apart long")


def tiled(rows: DataFrame) -> DataFrame:
    """Rows with the tile (x, y) of their key and their side in it; -1 where all pairs of the tile count."""
    there = F.count("*").over(Window.partitionBy("key"))
    groups = F.ceil(there * 2 / TILE).cast("int")
    cut = rows.withColumn("groups", F.when(there > TILE, groups).otherwise(1))
    cut = cut.withColumn("group", F.pmod(F.xxhash64("rep"), "groups").cast("int"))
    cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    side = F.when(F.col("group") == F.col("with"), -1).otherwise((F.col("group") > F.col("with")).cast("int"))
    return cut.withColumns({"x": F.least("group", "with"), "y": F.greatest("group", "with"), "side": side})


def jaccard_groups(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``id_col``, ``n_shingles``, ``component_id`` (least id reachable by links).

    A null text, or one without words, has no shingles and links with nothing. A row without an id
    links with nothing and has a null component. Rows that share an id are one document to the
    links. An empty table gives an empty result; other columns are not read.
    """
    source = texts(docs, id_col, text_col)
    own = checkpointed(shingle_sets(source, words))
    # Equal sets are one class, held by its least id.
    classes = own.where("id is not null and n > 0").groupBy("n", "h1", "h2").agg(F.min("id").alias("rep"), F.min("sketch").alias("sketch"))
    member = checkpointed(own.where("id is not null and n > 0").drop("sketch").join(classes.drop("sketch"), ["n", "h1", "h2"]).select("id", "rep"))
    sketches = classes.select("rep", "n", "sketch")
    rows = posted(source.where("id is not null"), words, percent)
    by_place = Window.partitionBy("place").orderBy("node")
    alone = F.col("leader").isNull()
    near = rows.select(
        F.coalesce("key", "place").alias("key"),
        "node",
        F.coalesce("leader", F.lag("node").over(by_place)).alias("before"),
        (F.col("leads") | (alone & F.lead("node").over(by_place).isNotNull())).alias("leads"),
    ).where("before is not null or leads")
    shared = checkpointed(near.drop("leads"))
    ids = shared.select(F.col("node").alias("id")).distinct()
    reps = small_enough(checkpointed(member.join(ids, "id", "left_semi")))  # classes of the documents that share a key

    met = shared.where("before <> node").groupBy("before", "node").agg(F.count("*").alias("keys"))
    met = met.join(reps.toDF("before", "p"), "before").join(reps.toDF("node", "q"), "node").where("p <> q")
    met = met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "keys")
    # Of a document's earlier neighbours, the one it meets on most keys is verified first.
    best = met.groupBy("a", "b").agg(F.sum("keys").alias("keys")).groupBy("b").agg(F.max_by("a", "keys").alias("a"))
    first = checkpointed(sketched(best, sketches, percent))

    def members_of(pairs: DataFrame) -> DataFrame:
        wanted = checkpointed(pairs.select("a").union(pairs.select("b")).toDF("id").distinct())
        return shingle_sets(source.join(small_enough(wanted), "id", "left_semi"), words, True).select("id", "members")

    # Rows that share an id tie their classes together.
    least = member.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).where("a <> most")
    tied = least.join(member, "id").select("a", F.col("rep").alias("b")).where("a <> b")
    links = checkpointed(verified(first, checkpointed(members_of(first)), percent).union(tied))
    found = components(links)

    sketches = small_enough(checkpointed(sketches), 64, "length(sketch)")

    def unconnected(nearest: bool) -> DataFrame:
        """Pairs inside keys whose documents are not connected yet."""
        placed = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left")
        placed = checkpointed(placed.select("id", "rep", F.coalesce("component", "rep").alias("component")))
        by_key = Window.partitionBy("key")
        grouped = shared.select("key", F.col("node").alias("id")).join(small_enough(placed), "id").select("key", "rep", "component")
        ends = {"low": F.min("component").over(by_key), "high": F.max("component").over(by_key)}
        open_ = grouped.withColumns(ends).where("low <> high").select("key", "rep", "component").distinct()
        # Many keys have the same documents: they are one key, named by a hash of these.
        members = [F.bit_xor(F.xxhash64(F.lit(seed), "rep")).over(by_key) for seed in (1, 2)]
        same = open_.select(F.xxhash64(F.count("*").over(by_key), *members).alias("key"), "rep", "component").distinct()
        # Sketches are long, so rows get them when they are cut into tiles.
        return across(tiled(same).join(sketches, "rep"), percent, nearest)

    # As long as it links components, each document is verified with the closest one outside its own;
    # then all pairs that are still open are.
    tried = first.select("a", "b")
    while True:
        near = unconnected(nearest=True).groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
        near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        near = checkpointed(near.join(tried, ["a", "b"], "left_anti"))
        more = checkpointed(verified(near, checkpointed(members_of(near)), percent))
        tried = checkpointed(tried.union(near))
        if more.isEmpty():
            break
        links = checkpointed(links.union(more))
        found = components(links)
    rest = checkpointed(unconnected(nearest=False).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        found = components(links.union(verified(rest, checkpointed(members_of(rest)), percent)))

    kept = member.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    kept = kept.groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    return own.join(kept, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
