"""Near-duplicate vectors by lattice hashing.

Each table projects the unit vectors to eight dimensions at random and decodes every projection to
its nearest point of the E8 lattice. A vector is a member of that cell and a visitor of the
``probes`` neighbouring cells that its projection leans to most; in each cell, members meet members
and visitors, and every pair is verified by its cosine in double precision.

Equal vectors are one class, so copies never meet. A pair counts in the first cell that it shares,
which both vectors tell by themselves, so pairs need not be gathered to count links. A cell of more
than ``TILE`` rows is cut into tiles, each of two groups of its rows, so no task holds more.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, ship
from .components import components
from .shingles import mix

TILE = 4000
BLOCK = 512

# The 240 minimal vectors of E8: two coordinates of +-1, or eight of +-1/2 with an even number of minus signs.
_PAIRS = [np.eye(8)[i] * a + np.eye(8)[j] * b for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
_HALVES = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
NEIGHBOURS = np.array(_PAIRS + _HALVES)
_COORDINATE = np.random.default_rng(8).integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    point = np.rint(x)
    error = x - point
    row, worst = np.arange(len(x)), np.abs(error).argmax(1)
    odd = point.sum(1) % 2 != 0
    point[row[odd], worst[odd]] += np.where(error[row, worst] >= 0, 1.0, -1.0)[odd]
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: even-sum integers, or those moved by a half."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def cell_keys(points: np.ndarray, table: int) -> np.ndarray:
    whole = np.rint(points * 2).astype(np.int64).view(np.uint64)
    return mix((whole * _COORDINATE).sum(-1, dtype=np.uint64) + np.full(1, table, np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Tables:
    """The cells of vectors: ``own`` is rows x tables, ``visited`` rows x tables x probes."""

    def __init__(self, dimensions: int, tables: int, probes: int, width: float, seed: int = 11):
        random = np.random.default_rng(seed)
        self.project = [random.standard_normal((dimensions, 8)) / width for _ in range(tables)]
        self.shift = [random.random(8) for _ in range(tables)]
        self.tables, self.probes = tables, probes

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = np.empty((len(unit), self.tables), np.uint64)
        visited = np.empty((len(unit), self.tables, self.probes), np.uint64)
        for t in range(self.tables):
            x = unit @ self.project[t] + self.shift[t]
            point = nearest_e8(x)
            own[:, t] = cell_keys(point, t)
            lean = (x - point) @ NEIGHBOURS.T
            best = np.argsort(-lean, axis=1, kind="stable")[:, : self.probes]
            visited[:, t] = cell_keys(point[:, None, :] + NEIGHBOURS[best], t)
        return own, visited


def units(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def first_shared(own: np.ndarray, visited: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The key of the first table's cell that each pair shares, the lesser one where it shares two."""
    out, open_ = np.zeros(len(a), np.uint64), np.ones(len(a), bool)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    for t in range(own.shape[1]):
        x, y = own[a, t], own[b, t]
        at_x = (x == y) | (x[:, None] == visited[b, t]).any(1)
        at_y = (y[:, None] == visited[a, t]).any(1)
        key = np.minimum(np.where(at_x, x, most), np.where(at_y, y, most))
        found = open_ & (at_x | at_y)
        out[found] = key[found]
        open_ &= ~found
    return out


def linked(cell: np.uint64, ids: np.ndarray, copies: np.ndarray, side: np.ndarray, unit: np.ndarray, tables: Tables, least: float):
    """Per vector of a cell: copies of the partners whose pair counts here, and the least id it is linked to here.

    ``side``: 0 and 1 are the two groups of a tile, of which only pairs across count; -1 is a whole cell.
    """
    counted, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    cells: tuple[np.ndarray, np.ndarray] | None = None
    for start in range(0, len(ids), BLOCK):
        near = unit[start : start + BLOCK] @ unit.T >= least
        a, b = np.nonzero(near)
        a += start
        keep = (a < b) & ((side[a] < 0) | (side[a] != side[b]))
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        cells = cells or tables.cells(unit)
        here = first_shared(*cells, a, b) == cell
        np.add.at(counted, a[here], copies[b[here]])
        np.add.at(counted, b[here], copies[a[here]])
        a, b = a[here], b[here]
        while len(a):  # least root over both ends, until none moves
            low = np.minimum(root[a], root[b])
            before = root.copy()
            for end in (a, b, before[a], before[b]):
                np.minimum.at(root, end, low)
            root = root[root]
            if (root == before).all():
                break
    return counted, root


def near_vectors(
    vectors: DataFrame,
    least: float = 0.9,
    tables: int = 4,
    probes: int = 8,
    width: float = 1.4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row: ``id_col``, ``n_links`` (other vectors linked directly), ``component_id``, ``kept``.

    A vector that is null, empty, zero, or holds null or non-finite parts links with nothing, and so
    does one of another length than its partner. A row without an id links with nothing, has a null
    component and is not kept. Rows that share an id are one document to the components; ``n_links``
    counts rows that the row's own vector is linked with, copies included, so rows of one id with
    different vectors have counts of their own. More than 64 different vector lengths are an error. An
    empty table gives an empty result; other columns are not read.
    """
    given = vectors.select(vectors[id_col].cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = (
        F.col("id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists("vector", lambda x: x != 0)
    )
    hashes = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(7), "vector").alias("h2")]
    own = given.select("id", F.when(usable, F.col("vector")).alias("vector"))
    classes = checkpointed(
        own.where("vector is not null")
        .groupBy(*hashes)
        .agg(F.min("id").alias("least_id"), F.count("*").alias("copies"), F.min_by("vector", "id").alias("vector"))
        .withColumn("rep", F.monotonically_increasing_id())  # a class has a name of its own: two may share an id
    )
    sizes = [r[0] for r in classes.select(F.size("vector")).distinct().orderBy(F.size("vector")).limit(65).collect()]
    if len(sizes) > 64:
        raise ValueError("vectors of more than 64 lengths")
    found: DataFrame | None = None
    for dimensions in sizes:
        part = classes.where(F.size("vector") == dimensions)
        made = _meetings(part, dimensions, Tables(dimensions, tables, probes, width), least)
        found = made if found is None else found.unionByName(made)
    spark = vectors.sparkSession
    if found is None:
        found = spark.createDataFrame([], "node long, links long, root long")
    found = checkpointed(found)
    names = classes.select("rep", "least_id")
    # Rows that share an id tie their classes together, so components are made of ids.
    ends = found.join(names.toDF("node", "a"), "node").join(names.toDF("root", "b"), "root").select("a", "b")
    member = own.where("vector is not null").select("id", *hashes).join(classes.drop("vector"), ["h1", "h2"])
    tied = member.select("id", "least_id").union(member.select("least_id", "id"))
    joined = components(ends.union(tied).where("a <> b").toDF("node", "root"))
    # Every row counts for the class that its own vector is in.
    links = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "rep")
    counted = member.join(links, "rep", "left").select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    alone = own.where("vector is null").select("id", F.lit(0).cast("long").alias("n_links"))
    whole = counted.union(alone).join(joined.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return whole.select(
        F.col("id").alias(id_col),
        F.col("n_links").cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _meetings(classes: DataFrame, dimensions: int, tables: Tables, least: float) -> DataFrame:
    """``node``, ``links`` and ``root`` of every class that has a link, by cell."""
    ship(classes)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                own, visited = tables.cells(units(flat.reshape(part.num_rows, dimensions)))
                keys = np.concatenate([own, visited.reshape(len(own), -1)], axis=1)
                of = pa.array(np.repeat(np.arange(len(keys)), keys.shape[1]))
                role = np.tile(np.arange(keys.shape[1]) >= tables.tables, len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), pa.array(role)] + [part.column(c).take(of) for c in ("rep", "copies", "vector")],
                    ["cell", "visits", "rep", "copies", "vector"],
                )

    rows = classes.select("rep", "copies", "vector").mapInArrow(
        placed, "cell long, visits boolean, rep long, copies long, vector array<double>"
    )
    large = checkpointed(rows.groupBy("cell").agg(F.count("*").alias("there")).where(F.col("there") > TILE))
    if large.isEmpty():
        tiles = rows.withColumns({"x": F.lit(0), "y": F.lit(0), "side": F.lit(-1)})
    else:
        groups = F.ceil(F.col("there") * 2 / TILE).cast("int")
        cut = rows.join(large, "cell").withColumn("groups", groups).withColumn("group", F.pmod(F.xxhash64("rep"), "groups").cast("int"))
        cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        across = F.when(F.col("group") == F.col("with"), -1).otherwise((F.col("group") > F.col("with")).cast("int"))
        cut = cut.withColumns({"x": F.least("group", "with"), "y": F.greatest("group", "with"), "side": across})
        whole = rows.join(large, "cell", "left_anti").withColumns({"x": F.lit(0), "y": F.lit(0), "side": F.lit(-1)})
        columns = ["cell", "visits", "rep", "copies", "vector", "x", "y", "side"]
        tiles = whole.select(*columns).union(cut.select(*columns))
    ordered = tiles.repartition("cell", "x", "y").sortWithinPartitions("cell", "x", "y", "rep")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def worked(table: pa.Table) -> pa.RecordBatch:
            cell, x, y, visits, rep, copies, side = (
                table.column(c).to_numpy() for c in ("cell", "x", "y", "visits", "rep", "copies", "side")
            )
            vector = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(cell), dimensions)
            new = np.append(True, (cell[1:] != cell[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
            bounds = np.append(np.flatnonzero(new), len(cell))
            nodes, links, roots = [], [], []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if end - start < 2 or visits[start:end].all():
                    continue
                part = slice(start, end)
                counted, root = linked(
                    cell[start : start + 1].view(np.uint64)[0], rep[part], copies[part], side[part], units(vector[part]), tables, least
                )
                some = np.flatnonzero(counted)
                nodes.append(rep[part][some])
                links.append(counted[some])
                roots.append(rep[part][root[some]])
            empty = [np.zeros(0, np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c or empty)) for c in (nodes, links, roots)], ["node", "links", "root"])

        for batch in batches:  # the last tile of a batch may go on in the next
            if not batch.num_rows:
                continue
            last = tuple(batch.column(c)[-1].as_py() for c in ("cell", "x", "y"))
            same = np.ones(batch.num_rows, bool)
            for c, value in zip(("cell", "x", "y"), last):
                same &= batch.column(c).to_numpy() == value
            begins = batch.num_rows - int(same.sum())
            if begins:
                yield worked(pa.Table.from_batches([*held, batch.slice(0, begins)]))
                held = [batch.slice(begins)]
            else:
                first = tuple(held[0].column(c)[0].as_py() for c in ("cell", "x", "y")) if held else last
                if first != last:
                    yield worked(pa.Table.from_batches(held))
                    held = []
                held.append(batch)
        if held:
            yield worked(pa.Table.from_batches(held))

    return ordered.mapInArrow(meet, "node long, links long, root long")
