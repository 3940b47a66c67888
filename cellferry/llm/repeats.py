"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash picks a trigger in every string of ``length`` bytes: its leftmost ``GRAM`` bytes of
least hash. The strings with the same trigger place are neighbours and make up one phrase, which is
as long as they reach. Equal strings have equal triggers at equal offsets, so the parse of the corpus
into phrases and the dictionary of distinct phrases hold every comparison that is needed:

1. An occurrence of a phrase that is not its first one repeats all its strings.
2. A string reaches far from its trigger to one side at least: half of what is not trigger lies there.
   So of two phrases that share a string, the bytes from the trigger so far to the left, or so far to
   the right, are equal. A phrase that has them in common with no other phrase repeats nothing.
3. The other phrases may share strings with another phrase. Their suffixes of ``length`` bytes are
   brought into order (a suffix array of that part of the dictionary, by bytes, for each slice of
   text), equal neighbours are one string, and one row for each goes on to find the first
   occurrence over all slices.

Rows are keyed by two hashes together (128 bits; the phrases of one trigger by 64 bits of their
content), and a slice sends one row for each distinct phrase or string, however often it has
it. Copies of a whole text are one class, of which only the first is parsed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, in_arrow, ship, small_enough, text_bytes
from .shingles import mix

GRAM = 32
SLICE = 4 << 20  # places fit into 24 bits; one longer text makes a slice of its own
PART = 1 << 19  # bytes of a slice that are hashed at once, or one longer text
_BYTE = np.random.default_rng(4).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Rolling:
    """Hashes of any byte range of a text slice, from running sums."""

    def __init__(self, flat: np.ndarray):
        n = len(flat) + 1
        power = np.full(n, _BASE, np.uint64)
        self.inverse = np.full(n, _INVERSE, np.uint64)
        power[0] = self.inverse[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_BYTE[flat] * power[:-1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value of every run of ``width``, leftmost of equal ones (by the upper 40 bits).

    A run too long for 24-bit places is done in overlapping parts.
    """
    most = (1 << 24) - width
    out = []
    for start in range(0, max(1, len(values) - width + 1), most):
        part = values[start : start + most + width - 1]
        if len(part) < width:
            break
        now = (part & ~np.uint64((1 << 24) - 1)) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span < width:
            step = min(span, width - span)
            now = np.minimum(now[: len(now) - step], now[step:])
            span += step
        out.append((now & np.uint64((1 << 24) - 1)).astype(np.int64) + start)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def parts(bounds: np.ndarray) -> Iterator[slice]:
    """The texts in order, of about ``PART`` bytes together: running sums take many times the bytes they are over."""
    start = 0
    while start < len(bounds) - 1:
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + PART, "right")) - 1)
        yield slice(start, end)
        start = end


def parse(flat: np.ndarray, bounds: np.ndarray, length: int):
    """Phrases of the texts: document, first and last start of its strings, trigger hash, content hash, sides."""
    kinds = np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int32
    found: list[tuple[np.ndarray, ...]] = [tuple(np.zeros(0, kind) for kind in kinds)]
    for part in parts(bounds):
        at = bounds[part.start]
        if bounds[part.stop] - at >= length:
            doc, low, high, *rest = _parsed(flat[at : bounds[part.stop]], bounds[part.start : part.stop + 1] - at, length)
            found.append((doc + part.start, low + at, high + at, *rest))
    return tuple(map(np.concatenate, zip(*found)))


def _parsed(flat: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The same, at once."""
    none = np.zeros(0, np.int64)
    rolling = Rolling(flat)
    at = np.arange(len(flat) - GRAM + 1)
    grams = rolling.ranges(at, at + GRAM)
    trigger = sliding_argmin(grams, length - GRAM + 1)
    starts = np.arange(len(trigger))
    doc = np.searchsorted(bounds, starts, "right") - 1
    inside = starts + length <= bounds[doc + 1]
    starts, doc, trigger = starts[inside], doc[inside], trigger[inside]
    new = np.append(True, (trigger[1:] != trigger[:-1]) | (doc[1:] != doc[:-1]))[: len(starts)]
    first = np.flatnonzero(new)
    low, high = starts[first], starts[np.append(first[1:], len(starts)) - 1] if len(first) else none
    at = trigger[first]
    place = mix(((at - low) << 32 | (high - low)).astype(np.uint64))
    return doc[first], low, high, grams[at], mix(rolling.ranges(low, high + length) + place), sides(rolling, at, low, high + length, length)


def sides(rolling: Rolling, at: np.ndarray, low: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Hashes of 15 bits of what lies left and right of the triggers, as ``left << 16 | right``; 0 where a phrase does not reach so far."""
    far = (length - GRAM + 1) // 2

    def hashed(start: np.ndarray, stop: np.ndarray, there: np.ndarray) -> np.ndarray:
        found = rolling.ranges(np.where(there, start, at), np.where(there, stop, at)) % np.uint64((1 << 15) - 1)
        return np.where(there, found.astype(np.int64) + 1, 0)

    left, right = hashed(at - far, at + GRAM, at - far >= low), hashed(at, at + GRAM + far, at + GRAM + far <= end)
    return (left << 16 | right).astype(np.int32)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def suffix_classes(flat: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Class number of the ``length`` bytes at each start: neighbours in suffix order that are equal share one."""
    words = -(-length // 8)
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([flat, np.zeros(8 * words, np.uint8)]), 8)

    def column(k: int) -> np.ndarray:
        raw = eights[starts + 8 * k]
        raw[:, max(0, length - 8 * k) :] = 0
        return raw.view(">u8").ravel().astype(np.uint64)

    order = np.arange(len(starts))
    for k in reversed(range(words)):  # suffixes in byte order; only one column is held at a time
        order = order[np.argsort(column(k)[order], kind="stable")]
    differs = np.zeros(len(starts), bool)
    for k in range(words):
        ranked = column(k)[order]
        differs[1:] |= ranked[1:] != ranked[:-1]
    classes = np.empty(len(starts), np.int64)
    classes[order] = np.cumsum(differs)
    return classes


def string_hashes(flat: np.ndarray, bounds: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the ``length`` bytes at each of the ascending starts."""
    one, two = np.empty(len(start), np.uint64), np.empty(len(start), np.uint64)
    for part in parts(bounds):
        first, last = np.searchsorted(start, bounds[[part.start, part.stop]])
        if first < last:
            rolling = Rolling(flat[bounds[part.start] : bounds[part.stop]])
            at = start[first:last] - bounds[part.start]
            one[first:last] = whole = rolling.ranges(at, at + length)
            two[first:last] = mix(rolling.ranges(at, at + length // 2) + whole * np.uint64(3))
    return one, two


def runs(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges [low, high) as separate runs."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.append(True, low[1:] > high[:-1])
    return low[new], high[np.append(np.flatnonzero(new)[1:], len(low)) - 1]


def _packed(low: np.ndarray, high: np.ndarray) -> bytes:
    return np.stack([low, high], axis=1).astype("<i8").tobytes()


def _unpacked(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _blobs(ids: np.ndarray, ties: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int, bytes]]:
    """One (ord, tie, ranges) per document."""
    out = []
    for d in np.unique(doc).tolist():
        mine = doc == d if len(doc) < 64 else slice(*np.searchsorted(doc, [d, d + 1]))
        out.append((int(ids[d]), int(ties[d]), _packed(*runs(low[mine], high[mine]))))
    return out


ROWS = "place long, ctx long, spot long, ord long, tie int, ranges binary"


def _rows(place, ctx, ords, ties, spot, blobs: list[tuple[int, int, bytes]], near: np.ndarray | None = None) -> pa.RecordBatch:
    """Candidate rows, then rows that only carry ranges of one document; ``near`` is a column more."""
    n, names = len(blobs), ["place", "ctx", "spot", "ord", "tie", "ranges"]
    one = [signed(place), signed(ctx), pa.array(spot), pa.array(ords), pa.array(ties), pa.nulls(len(place), pa.binary())]
    own = np.array([b[0] for b in blobs], np.int64)
    apart = mix(own.view(np.uint64) + np.arange(n, dtype=np.uint64) * np.uint64(_BASE))
    two = [
        signed(apart),
        pa.array(np.zeros(n, np.int64)),
        pa.array(np.zeros(n, np.int64)),
        pa.array(own),
        pa.array(np.array([b[1] for b in blobs], np.int32)),
        pa.array([b[2] for b in blobs], pa.binary()),
    ]
    if near is not None:
        names, one, two = [*names, "near"], [*one, pa.array(near)], [*two, pa.array(np.zeros(n, np.int32))]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(one, two)], names)


def _first_of(groups: list[np.ndarray], doc: np.ndarray, ids: np.ndarray, ties: np.ndarray, low: np.ndarray) -> np.ndarray:
    """True for the first row, in corpus order, of each group of equal keys."""
    order = np.lexsort([low, ties[doc], ids[doc], *groups[::-1]])
    differs = np.zeros(len(low), bool)
    differs[:1] = True
    for g in groups:
        differs[1:] |= g[order][1:] != g[order][:-1]
    out = np.zeros(len(low), bool)
    out[order[differs]] = True
    return out


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    flat, bounds = text_bytes(batch.column("text"))
    return flat, bounds, batch.column("ord").to_numpy(), batch.column("tie").to_numpy()


def phrases(docs: DataFrame, length: int) -> DataFrame:
    """The parse: one row per distinct phrase of a slice, at its first place there."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        # Of a text's copies in the slice, only the first is parsed.
        order = np.lexsort([batch.column("tie").to_numpy(), batch.column("ord").to_numpy()])
        seen: set[bytes] = set()
        kept = []
        for i in order.tolist():
            raw = hashlib.md5(batch.column("text")[i].as_buffer()).digest()
            if raw not in seen:
                seen.add(raw)
                kept.append(i)
        flat, bounds, ids, ties = _columns(batch.take(pa.array(kept, pa.int64())))
        doc, low, high, key, ctx, near = parse(flat, bounds, length)
        if not len(doc):
            return None
        first = _first_of([key, ctx], doc, ids, ties, low)
        again = ~first
        begin = bounds[doc]
        blobs = _blobs(ids, ties, doc[again], (low - begin)[again], (high - begin)[again] + length)
        spot = ((low - begin) << 8 | (high - low))[first]
        return _rows(key[first], ctx[first], ids[doc[first]], ties[doc[first]], spot, blobs, near[first])

    return in_arrow(docs, work, ROWS + ", near int", SLICE)


def _others(side: Column) -> Column:
    """Whether another phrase of the trigger has the same bytes on that side."""
    by_side = Window.partitionBy("place", side)
    return (side > 0) & (F.min("ctx").over(by_side) != F.max("ctx").over(by_side))


def strings(docs: DataFrame, length: int) -> DataFrame:
    """The strings of the phrases in ``spots``: one row per distinct string of a slice, at its first place there."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        own = list(zip(batch.column("ord").to_pylist(), batch.column("tie").to_pylist()))
        batch = batch.take(pa.array(sorted({k: i for i, k in enumerate(own)}.values()), pa.int64()))  # repeated rows once
        flat, bounds, ids, ties = _columns(batch)
        spots = [np.asarray(s, np.int64) for s in batch.column("spots").to_pylist()]
        doc = np.repeat(np.arange(len(spots)), [len(s) for s in spots])
        spot = np.concatenate(spots) if spots else np.zeros(0, np.int64)
        low, count = (spot >> 8) + bounds[doc], (spot & 255) + 1
        of = np.repeat(np.arange(len(spot)), count)
        start = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        doc = doc[of]
        order = np.argsort(start, kind="stable")
        start, doc = start[order], doc[order]
        if not len(start):
            return None
        one, two = string_hashes(flat, bounds, start, length)
        first = _first_of([suffix_classes(flat, start, length)], doc, ids, ties, start)
        again = ~first
        begin = bounds[doc]
        blobs = _blobs(ids, ties, doc[again], (start - begin)[again], (start - begin)[again] + length)
        return _rows(one[first], two[first], ids[doc[first]], ties[doc[first]], ((start - begin) << 8)[first], blobs)

    return in_arrow(docs, work, ROWS, SLICE)


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]) -> DataFrame:
    """Texts with their place in corpus order: by id, rows without one last; one id's texts by hash."""
    id_ = docs[id_col].cast("long").alias("id")
    made = docs.select(id_, F.coalesce(docs[text_col], F.lit("")).alias("text"), F.struct(*[docs[c] for c in (id_col, *carry)]).alias("row"))
    hashes = F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2")
    made = made.select("*", *hashes, F.coalesce("id", F.lit((1 << 63) - 1)).alias("ord"))
    return made.withColumn("tie", F.shiftright("h1", 32).cast("int"))


def _spans(rows: DataFrame, dup: Column, length: int) -> DataFrame:
    """``ord``, ``tie``, ``ranges`` of the rows that repeat an earlier one, and of those that carry ranges."""
    low = F.shiftright("spot", 8)
    made = F.array(low, low + F.col("spot").bitwiseAND(255) + length)
    return rows.where(dup | F.col("ranges").isNotNull()).select("ord", "tie", "ranges", F.when(F.col("ranges").isNull(), made).alias("range"))


def _merged(rows: DataFrame) -> DataFrame:
    """``ord``, ``tie``, ``ranges``: the union of all ranges of a text, as one value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packed, pairs in zip(batch.column("ranges").to_pylist(), batch.column("range").to_pylist()):
                low, high = _unpacked(packed)
                if pairs:
                    both = np.array(pairs, np.int64)
                    low, high = np.append(low, both[:, 0]), np.append(high, both[:, 1])
                out.append(_packed(*runs(low, high)))
            yield pa.RecordBatch.from_arrays([batch.column("ord"), batch.column("tie"), pa.array(out, pa.binary())], ["ord", "tie", "ranges"])

    ship(rows)
    return rows.mapInArrow(run, "ord long, tie int, ranges binary")


def without_repeats(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] | None = None
) -> DataFrame:
    """Per row: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Removes each byte covered by a string of ``length`` bytes that also starts earlier: in a row of
    smaller id, or earlier in the same text. A null text counts as empty. Rows without an id come
    last; the different texts of one id are ordered by hash, and repeated rows count as one and
    give equal rows. A text shorter than ``length`` loses nothing. An empty table gives an empty
    result; other columns are not read. With ``carry`` (names of columns, or none: ``()``), these
    columns and ``kept_text`` are added: the bytes left, without those of a character cut apart.
    """
    if not GRAM < length < 256 + GRAM:
        raise ValueError(f"length must lie between {GRAM} and {256 + GRAM}")
    source = _keyed(docs, id_col, text_col, carry or ())
    spot = F.struct("ord", "tie", "spot")  # a repeated row has the same spots
    by_phrase = Window.partitionBy("place", "ctx").orderBy("ord", "tie", "spot")
    found = checkpointed(
        phrases(source.where(F.octet_length("text") >= length).select("ord", "tie", "text"), length)
        .repartition("place")
        .withColumns({"left": F.shiftright("near", 16), "right": F.col("near").bitwiseAND(0xFFFF)})
        .withColumns({"first": F.first(spot).over(by_phrase), "open": _others(F.col("left")) | _others(F.col("right"))})
        .select("ord", "tie", "spot", "ranges", (F.col("first") != spot).alias("dup"), "open")
        .where("dup or open or ranges is not null")
    )
    spots = found.where("open and not dup and ranges is null").groupBy("ord", "tie").agg(F.collect_list("spot").alias("spots"))
    spots = small_enough(checkpointed(spots), 64, "8L * size(spots)")
    opened = source.select("ord", "tie", "text").join(spots, ["ord", "tie"])
    again = (
        strings(opened, length)
        .repartition("place")
        .withColumn("first", F.first(spot).over(by_phrase))
        .select("ord", "tie", "spot", "ranges", (F.col("first") != spot).alias("dup"))
    )
    spans = _spans(found.where("dup or ranges is not null"), F.col("dup"), length).unionByName(_spans(again, F.col("dup"), length))
    per_text = _merged(spans.groupBy("ord", "tie").agg(F.collect_list("ranges").alias("ranges"), F.collect_list("range").alias("range")))
    classes = source.select("h1", "h2", "ord", "tie").groupBy("h1", "h2").agg(F.min("ord").alias("ord"), F.min("tie").alias("tie"), F.count("*").alias("copies"))
    # Only texts that lose something, or have copies, are looked up; all others stay as they are.
    removed = checkpointed(
        classes.join(per_text, ["ord", "tie"], "left")
        .where("ranges is not null or copies > 1")
        .select("h1", "h2", F.col("ord").alias("first"), "ranges")
    )
    looked_up = small_enough(removed, 64, "coalesce(octet_length(ranges), 0)")
    joined = source.select("row", "ord", "h1", "h2", "text").join(looked_up, ["h1", "h2"], "left")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        copies = [first is not None and own != first for own, first in zip(batch.column("ord").to_pylist(), batch.column("first").to_pylist())]
        for text, copy, ranges in zip(batch.column("text"), copies, batch.column("ranges").to_pylist()):
            buffer = text.as_buffer()
            raw = bytes(buffer) if buffer is not None else b""
            low, high = _unpacked([ranges] if ranges else [])
            if copy and len(raw) >= length:
                low, high = np.array([0]), np.array([len(raw)])
            ends = np.append(0, high).tolist()
            kept = b"".join(raw[a:b] for a, b in zip(ends, [*low.tolist(), len(raw)]))
            rows.append((len(raw), len(raw) - len(kept), len(low), hashlib.sha256(kept).hexdigest(), kept))
        n, gone, spans, digest, kept = zip(*rows)
        arrays = [batch.column("row"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest)]
        if carry is not None:
            arrays.append(pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names)

    names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * (carry is not None)
    schema = f"row {joined.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    made = in_arrow(joined, work, schema + ", kept_text string" * (carry is not None))
    return made.select(F.col("row")[id_col].cast("long").alias(id_col), *[F.col("row")[c].alias(c) for c in carry or ()], *names[1:])
