"""Hard negatives by coordinate pruning of inner products.

Rows stand in order of label and length and are cut into tiles of equal size; anchors are dealt to the
tiles that may hold what they look for. In a task a tile goes by in buckets of rows of about the same
length. A bucket keeps, for every coordinate, its unit vectors' values in order. What an anchor needs
to score becomes a least cosine for the bucket by the bucket's greatest length. With an angle of
that cosine around the anchor, each of the anchor's largest coordinates leaves a range of values that a
partner may have there; the ranges are looked up in the ordered lists, the rows in them intersected,
and only those are verified exactly. What an anchor has found raises what the next bucket must reach.

Positives are searched first, among the tiles of the anchor's label. Their scores bound the search for
negatives from both sides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, numbered, ship

TILE, BUCKET, SPAN = 8192, 1024, 65536
# coordinates of an anchor that are looked up in a bucket
FOCUS = 4
# pruning is done in floating point; bounds are this much wider than they need be
SLACK = 1e-9
EXACT = float(1 << 53)


def floored(x: Column) -> Column:
    """The floor of a double as a double, also where no long holds it."""
    return F.when(F.abs(x) >= EXACT, x).otherwise(F.floor(x).cast("double"))


class Bucket:
    """Rows of one bucket: exact vectors, unit vectors and their ordered coordinates."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        scale = np.maximum(np.abs(vectors).max(1, initial=0.0), 1e-300)[:, None]
        lengths = np.linalg.norm(vectors / scale, axis=1) * scale[:, 0]
        self.longest = float(lengths.max(initial=0.0))
        self.greatest = float(np.abs(vectors).max(initial=0.0))
        self.unit = np.divide(vectors / scale, (lengths / scale[:, 0])[:, None], out=np.zeros_like(vectors), where=lengths[:, None] > 0)
        self._order: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def ordered(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows in the order of one coordinate, and its values."""
        if at not in self._order:
            rows = np.argsort(self.unit[:, at], kind="stable")
            self._order[at] = rows, self.unit[rows, at]
        return self._order[at]

    def candidates(self, anchor: Anchor, least: float | None) -> np.ndarray:
        """Rows that may score ``least`` with the anchor; all of them where nothing is asked."""
        everything = np.arange(len(self.vectors))
        if least is None or least <= 0:
            return everything
        reach = anchor.length * self.longest
        if not np.isfinite(reach):
            return everything
        cosine = least / reach - SLACK if reach > 0 else 2.0
        if cosine > 1:
            return everything[:0]
        angle = np.arccos(max(cosine, -1.0))
        lists = []
        for at, value in zip(anchor.focus, anchor.angles):
            rows, values = self.ordered(at)
            low = np.searchsorted(values, np.cos(min(np.pi, value + angle)) - SLACK, "left")
            high = np.searchsorted(values, np.cos(max(0.0, value - angle)) + SLACK, "right")
            lists.append(rows[low:high])
        lists.sort(key=len)
        met = np.zeros(len(self.vectors), np.int8)
        for rows in lists:
            met[rows] += 1
        return lists[0][met[lists[0]] == len(lists)] if lists else everything

    def scores(self, anchor: Anchor, rows: np.ndarray) -> np.ndarray:
        """Exact inner products: in double precision where it holds them, else in whole numbers of any size."""
        n = max(self.vectors.shape[1], 1)
        if anchor.greatest * self.greatest * n < EXACT:
            return (self.vectors[rows] @ anchor.vector).astype(np.int64)
        whole = np.array([[int(x) for x in row] for row in self.vectors[rows]], dtype=object).reshape(len(rows), -1)
        return whole @ np.array([int(x) for x in anchor.vector], dtype=object)


class Anchor:
    def __init__(self, row: int, label: int, vector: np.ndarray, positives: list[int]):
        self.row, self.label, self.vector, self.positives = row, label, vector, positives
        scale = float(np.abs(vector).max(initial=0.0))
        self.greatest = scale
        inner = np.linalg.norm(vector / scale) if scale > 0 else 0.0
        self.length = float(inner * scale)
        unit = vector / scale / inner if scale > 0 else vector
        self.focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS].tolist()
        self.angles = [float(np.arccos(np.clip(unit[f], -1.0, 1.0))) for f in self.focus]
        self.best: list[list[tuple]] = [[] for _ in (positives or [0])]


def _kept(held: list[tuple], scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int) -> list[tuple]:
    """The first ``most`` of those held and those found: highest score, least id, least row."""
    if len(scores) > most and scores.dtype != object:
        cut = np.partition(scores, len(scores) - most)[len(scores) - most]
        more = scores >= cut
        scores, ids, rows = scores[more], ids[more], rows[more]
    found = [(-int(s), int(i), int(r)) for s, i, r in zip(scores.tolist(), ids.tolist(), rows.tolist())]
    return sorted(held + found)[:most]


def _same_label(anchor: Anchor, bucket: Bucket, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int, low: int, high: int) -> None:
    held = anchor.best[0]
    least = float(-held[-1][0]) if len(held) == most else None
    near = bucket.candidates(anchor, least)
    near = near[(labels[near] == anchor.label) & (rows[near] != anchor.row)]
    if len(near):
        anchor.best[0] = _kept(held, bucket.scores(anchor, near), ids[near], rows[near], most)


def _between(anchor: Anchor, bucket: Bucket, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int, low: int, high: int) -> None:
    needs = []
    for positive, held in zip(anchor.positives, anchor.best):
        if positive >= 0:
            needs.append(max(low * positive / high, -held[-1][0]) if len(held) == most else low * positive / high)
    if not needs or (labels == anchor.label).all():
        return
    near = bucket.candidates(anchor, float(min(needs)))
    near = near[labels[near] != anchor.label]
    if not len(near):
        return
    scores = bucket.scores(anchor, near)
    if scores.dtype != object and max(anchor.positives) * high < 1 << 62 and np.abs(scores).max() < (1 << 62) // max(high, 1):
        for i, positive in enumerate(anchor.positives):
            inside = (low * positive <= high * scores) & (scores <= positive)
            if inside.any():
                anchor.best[i] = _kept(anchor.best[i], scores[inside], ids[near][inside], rows[near][inside], most)
        return
    for i, positive in enumerate(anchor.positives):
        at = [k for k, s in enumerate(scores.tolist()) if low * positive <= high * s and s <= positive]
        if at:
            anchor.best[i] = _kept(anchor.best[i], scores[at].astype(object), ids[near][at], rows[near][at], most)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; what a shorter one lacks is zero."""
    out = np.zeros((len(column), width))
    sizes = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    begin = 0
    for i, n in enumerate(sizes.tolist()):
        out[i, :n] = flat[begin : begin + n]
        begin += n
    return out


def _searched(pieces: DataFrame, visit: Callable, width: int, most: int, low: int, high: int) -> DataFrame:
    """Best partners of every anchor and tile: ``anchor``, ``positive_rank``, ``score``, ``id``, ``row``.

    ``pieces`` holds anchors (with the scores of their positives) and rows by block and tile. A task reads a
    tile's anchors and then its rows, a bucket at a time.
    """
    ship(pieces)
    ordered = pieces.repartition("block", "tile").sortWithinPartitions("block", "tile", "kind", "row")
    names = ["anchor", "positive_rank", "score", "id", "row"]
    least, greatest = -(1 << 63), (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[Anchor] = []
        waiting: list[pa.RecordBatch] = []

        def search() -> None:
            if not waiting:
                return
            table = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            bucket = Bucket(_matrix(table.column("vector").combine_chunks(), width))
            labels, ids, rows = (table.column(c).to_numpy() for c in ("label", "id", "row"))
            for anchor in anchors:
                visit(anchor, bucket, labels, ids, rows, most, low, high)

        def told() -> Iterator[pa.RecordBatch]:
            search()
            found = [(a.row, i + 1, min(max(-s, least), greatest), d, r) for a in anchors for i, best in enumerate(a.best) for s, d, r in best]
            anchors.clear()
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, names)

        here = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "tile", "kind")], axis=1)
            bounds = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for start, end in zip([0, *bounds.tolist()], [*bounds.tolist(), len(keys)]):
                block, tile, kind = keys[start].tolist()
                if (block, tile) != here:
                    yield from told()
                    here = (block, tile)
                part = batch.slice(start, end - start)
                if kind == 0:
                    vectors = _matrix(part.column("vector"), width)
                    for i in range(part.num_rows):
                        scores = part.column("scores")[i].as_py() or []
                        anchors.append(Anchor(part.column("row")[i].as_py(), part.column("label")[i].as_py(), vectors[i], [int(s) for s in scores]))
                    continue
                for at in range(0, part.num_rows, BUCKET):
                    room = BUCKET - sum(w.num_rows for w in waiting)
                    piece = part.slice(at, BUCKET)
                    waiting.append(piece.slice(0, room))
                    if piece.num_rows >= room:
                        search()
                        if piece.num_rows > room:
                            waiting.append(piece.slice(room))
        yield from told()

    return ordered.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _pieces(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Anchors and rows of every block and tile that ``anchors`` (with ``block`` and ``tiles``) ask for."""
    dealt = anchors.withColumn("tile", F.explode("tiles"))
    pairs = checkpointed(dealt.select("block", "tile").distinct())
    columns = ["block", "tile", "kind", "row", "label", "id", "vector", "scores"]
    own = dealt.withColumn("kind", F.lit(0)).select(*columns)
    nothing = F.lit(None).cast("array<string>").alias("scores")
    met = rows.drop("block").join(pairs, "tile").select("block", "tile", F.lit(1).alias("kind"), "row", "label", "id", "vector", nothing)
    return own.unionByName(met)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per anchor and positive: the first negatives that score between ``low`` / ``high`` of the positive and the positive.

    ``vectors`` holds whole numbers as doubles; scores are exact inner products, and where they exceed a
    long they are ordered exactly and reported as the nearest long. Columns: ``anchor_id``, ``positive_id``,
    ``rank``, ``negative_id``, ``positive_score``, ``negative_score``, ``positive_rank``. Positives of an anchor
    are the first ``positives`` other rows of its label, negatives the first ``negatives`` rows of another
    label, by score and then by least id. A positive of negative score has none.

    Rows without a label, with a null vector, or with null or non-finite parts take no part; nor do rows without
    an id. Parts that a shorter vector lacks are zero. Rows that share an id are rows of their own. An
    empty table gives an empty result; other columns are not read.
    """
    given = vectors.select(
        vectors[id_col].cast("long").alias("id"),
        vectors[label_col].cast("long").alias("label"),
        vectors[vector_col].cast("array<double>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    sound = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    usable = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: F.hypot(a, x))
    order = [F.col("label"), F.col("length").desc(), F.col("id")]
    placed = numbered(usable.withColumn("length", length), order, ["id", "label", "vector", "asks"], "row")
    rows = checkpointed(placed.withColumns({"tile": F.floor(F.col("row") / TILE), "block": F.floor(F.col("row") / SPAN)}))
    there, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    anchors = rows.where("asks").drop("tile", "asks")
    labels = rows.groupBy("label").agg(F.min("tile").alias("first"), F.max("tile").alias("last"))
    asking = anchors.join(labels, "label").withColumn("tiles", F.sequence("first", "last")).withColumn("scores", F.lit(None).cast("array<string>"))
    met = _searched(_pieces(rows, asking), _same_label, width, positives, low, high)
    first = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row")
    ranked = met.withColumn("positive_rank", F.row_number().over(first)).where(F.col("positive_rank") <= positives)
    chosen = checkpointed(ranked.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "positive_rank"))
    # at most ``positives`` entries each
    scores = F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score")))
    held = chosen.groupBy(F.col("anchor").alias("row")).agg(F.transform(scores, lambda s: s["positive_score"].cast("string")).alias("scores"))
    tiles = F.sequence(F.lit(0).cast("long"), F.lit(max((there - 1) // TILE, 0)).cast("long"))
    asking = anchors.join(held, "row").withColumn("tiles", tiles)
    met = _searched(_pieces(rows, asking), _between, width, negatives, low, high).withColumnsRenamed(
        {"id": "negative_id", "score": "negative_score", "row": "negative_row"}
    )
    first = Window.partitionBy("anchor", "positive_rank").orderBy(F.col("negative_score").desc(), "negative_id", "negative_row")
    found = met.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    ids = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    whole = found.join(chosen, ["anchor", "positive_rank"]).join(ids, "anchor")
    return whole.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score", "positive_rank"
    )
