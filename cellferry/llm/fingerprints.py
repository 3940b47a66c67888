"""Homomorphic multiset hashes of texts, by SQL functions only.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to a wide vector, and the
fingerprint is their sum, lane by lane, modulo powers of two: the order of paragraphs does not
matter, and inserting or deleting one adds or subtracts its vector.

* ``EXACT`` lanes add 62-bit hashes of the paragraph modulo 2^62; they tell multisets apart.
* The other lanes add bits of hashes of the paragraph's runs: each clause is cut into runs of at most
  four words, so a text without punctuation has as many as another; in scripts without spaces each
  character is a word. A long holds two sums, modulo 2^30 each, more than a text can have runs. A bit
  stands for +1 or -1, so the inner product of two fingerprints estimates the number of runs that both
  texts have, and the cosine is a likeness of the texts.
* One lane counts the runs, modulo 2^30.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

EXACT = 4
SHIFTS = 30
HASHES = 2
WIDE = SHIFTS * HASHES
_PLACES = (0, 31)
_BITS = sum(1 << at for at in _PLACES)
_COUNT = (1 << 30) - 1
# a chunk's sums: every tenth bit of a lane's two, each counting to 1023
STEP, CHUNK = 10, 1023
_FIELDS = sum(1 << (place + at) for place in _PLACES for at in range(0, SHIFTS, STEP))
_SUMS = sum(_COUNT << at for at in _PLACES)
_LANE = (1 << 62) - 1
MASKS = [_LANE] * EXACT + [_SUMS] * WIDE + [_COUNT]
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_WORD = rf"(?:[{UNSPACED}]|[^\s.,;:!?|。，、；：！？{UNSPACED}]++)"
RUN = rf"{_WORD}(?:[^\S\n]*{_WORD}){{0,3}}"


def _masks() -> Column:
    return F.array(*[F.lit(m).cast("long") for m in MASKS])


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0).cast("long"), n)


def _shifted(x: Column, by: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, by)


def _exact_lanes(paragraphs: Column) -> Column:
    """Sums of the paragraphs' hashes, one seed a lane."""
    most = F.lit(_LANE).cast("long")

    def add(state: Column, p: Column) -> Column:
        return F.transform(state, lambda x, seed: (x + F.xxhash64(seed, p).bitwiseAND(most)).bitwiseAND(most))

    return F.aggregate(paragraphs, _zeros(EXACT), add)


def _sign_lanes(runs: Column) -> Column:
    """One long per shift of each hash, with two bits summed apart, and the number of runs.

    Runs are hashed once and bound to a name, since an expression inside a lambda is worked out again
    each time. They are summed ``CHUNK`` at a time with six bits of a hash to a long, which so few
    cannot overflow, and the sums of a chunk are then spread over the lanes. A text of two billion
    bytes has too few runs for a lane's sum to reach the next one, so the powers are taken at the end.
    """
    hashed = F.transform(runs, lambda r: F.struct(F.xxhash64(F.lit(100), r).alias("a"), F.xxhash64(F.lit(101), r).alias("b")))
    fields, few, sums = (F.lit(v).cast("long") for v in (_FIELDS, CHUNK, _SUMS))
    one = F.lit(1).cast("long")
    narrow = F.struct(_zeros(STEP).alias("a"), _zeros(STEP).alias("b"), F.lit(0).cast("long").alias("n"))
    wide = F.struct(_zeros(SHIFTS).alias("a"), _zeros(SHIFTS).alias("b"), F.lit(0).cast("long").alias("n"))

    def added(state: Column, h: Column) -> Column:
        def sums_of(name: str) -> Column:
            return F.transform(state[name], lambda x, i: x + _shifted(h[name], i).bitwiseAND(fields)).alias(name)

        return F.struct(sums_of("a"), sums_of("b"), (state["n"] + one).alias("n"))

    def spread(state: Column, chunk: Column) -> Column:
        def lanes(name: str) -> Column:
            def lane(x: Column, i: Column) -> Column:
                packed, at = F.element_at(chunk[name], (i % STEP + 1).cast("int")), F.floor(i / STEP).cast("int") * STEP
                low, high = (_shifted(packed, at + place).bitwiseAND(few) for place in _PLACES)
                return x + low + F.shiftleft(high, _PLACES[1])

            return F.transform(state[name], lane).alias(name)

        return F.struct(lanes("a"), lanes("b"), (state["n"] + chunk["n"]).alias("n"))

    def total(all_: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor(F.size(all_) / CHUNK).cast("int"))
        chunks = F.transform(starts, lambda c: F.aggregate(F.slice(all_, c * CHUNK + 1, F.lit(CHUNK)), narrow, added))
        return F.aggregate(chunks, wide, spread, lambda s: F.concat(s["a"], s["b"], F.array(s["n"])))

    summed = F.element_at(F.transform(F.array(hashed), total), 1)
    return F.transform(summed, lambda x: x.bitwiseAND(sums))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text, as an array of longs; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    paragraphs = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n", -1))
    return F.concat(_exact_lanes(paragraphs), _sign_lanes(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))))


# lanes of so few runs go into half a long
FEW = (1 << 15) - 1


def folded(vector: Column) -> Column:
    """The fingerprint with less room for texts of few runs, to be written and sent."""
    wide, count = F.slice(vector, EXACT + 1, WIDE), F.element_at(vector, -1)
    half = F.transform(wide, lambda x: (x.bitwiseAND(FEW) + F.shiftleft(_shifted(x, F.lit(_PLACES[1])), 15)).cast("int"))
    return F.struct(
        F.slice(vector, 1, EXACT).alias("exact"),
        F.when(count <= FEW, half).alias("half"),
        F.when(count > FEW, wide).alias("wide"),
        count.alias("count"),
    )


def unfolded(made: Column) -> Column:
    """The fingerprint that was folded."""
    full = F.transform(
        made["half"],
        lambda x: x.bitwiseAND(FEW).cast("long") + F.shiftleft(F.shiftright(x, 15).cast("long"), _PLACES[1]),
    )
    return F.concat(made["exact"], F.coalesce(full, made["wide"]), F.array(made["count"]))


def combined(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of both: inserts ``b`` into ``a``."""
    return F.transform(F.arrays_zip(a.alias("x"), b.alias("y"), _masks().alias("m")), lambda z: (z["x"] + z["y"]).bitwiseAND(z["m"]))


def without(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` after deleting the paragraphs of ``b``."""
    # Guard bits are set before, so that no lane borrows from the next one.
    return F.transform(
        F.arrays_zip(a.alias("x"), b.alias("y"), _masks().alias("m")),
        lambda z: (z["x"].bitwiseOR(_guards(z["m"])) - z["y"]).bitwiseAND(z["m"]),
    )


def _guards(mask: Column) -> Column:
    """The bit above each lane of a mask; the sign bit is not one."""
    return (mask + F.lit(_BITS).cast("long")).bitwiseAND(F.bitwise_not(mask)).bitwiseAND(F.lit((1 << 63) - 1).cast("long"))


def printed(vector: Column) -> Column:
    """The fingerprint as text: every lane in hexadecimal."""
    return F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _signs(vector: Column) -> Column:
    """Signed sums: twice the ones less the count of runs."""
    wide, count = F.slice(vector, EXACT + 1, WIDE), F.element_at(vector, -1)
    return F.flatten(
        F.transform(
            wide,
            lambda x: F.transform(
                F.array(*[F.lit(s) for s in _PLACES]),
                lambda s: (F.call_function("shiftrightunsigned", x, s).bitwiseAND(F.lit(_COUNT)) * 2 - count).cast("double"),
            ),
        )
    )


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the cosine of the signed sums, cut to 0..1."""
    x, y = _signs(a), _signs(b)
    zero = F.lit(0.0)
    dot = F.aggregate(F.zip_with(x, y, lambda p, q: p * q), zero, lambda s, v: s + v)
    norm = F.sqrt(F.aggregate(x, zero, lambda s, v: s + v * v)) * F.sqrt(F.aggregate(y, zero, lambda s, v: s + v * v))
    cosine = F.when(norm > 0, dot / norm).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(zero, cosine)))


def next_ids(ids: DataFrame) -> DataFrame:
    """``ids`` (k, n) with ``next``, the k that follows in descending order; the first follows the last.

    Ids are range-partitioned and numbered inside their partition, so no task has them all; only the
    first id of each partition, a row per partition, is looked at together.
    """
    sorted_ = checkpointed(ids.orderBy(F.desc("k")).withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("row", 33)
    inner = Window.partitionBy("part").orderBy("row")
    rows = sorted_.withColumn("part", part).withColumn("after", F.lead("k").over(inner))
    heads = sorted_.withColumn("part", part).groupBy("part").agg(F.min_by("k", "row").alias("head"))
    ring = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(ring), F.first("head").over(whole)).alias("head"))
    return rows.join(F.broadcast(heads), "part").select("k", "n", F.coalesce("after", "head").alias("next"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: fingerprints of its text and of its edited text, and likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document, in descending order of id, the last followed by the first. A null
    text counts as empty. Rows without an id come last; the different texts of one id are ordered
    by hash; repeated rows count as one and give equal rows; a single document follows itself. An
    empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    key = F.struct(docs[id_col].cast("long").alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"))
    rows = docs.select(key.alias("k"), text.alias("text")).select("k", F.xxhash64("k").alias("at"), "text")
    ids = docs.select(key.alias("k"), F.length(text).cast("long").alias("n")).distinct()
    order = checkpointed(next_ids(ids))
    # Of the next text only its beginning is sent to the one before it.
    wanted = order.select(F.col("next").alias("k"), F.col("k").alias("to"), "n").withColumn("at", F.xxhash64("k"))
    given = rows.join(wanted, ["at", "k"]).select(
        F.xxhash64("to").alias("at"), F.col("to").alias("k"), F.substring("text", F.lit(1), F.floor(F.col("n") / 2).cast("int")).alias("head")
    )
    n = F.length("text")
    joined = rows.join(given.dropDuplicates(["at", "k"]), ["at", "k"]).select(
        "k",
        n.cast("long").alias("n_chars"),
        "text",
        F.concat(F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")), F.col("head")).alias("edited"),
    )
    # Every text's fingerprint is worked out once and written; after that only fingerprints move.
    made = checkpointed(
        joined.select(
            "k",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("text")).alias("own_print"),
            fingerprint(F.col("edited")).alias("edited_print"),
        ).withColumns({name: folded(F.col(name)) for name in ("own_print", "edited_print")})
    )
    after = made.select(F.col("k").alias("next"), F.col("own_print").alias("next_print")).dropDuplicates(["next"])
    before = order.select("k", "next").join(after, "next").select("k", "next_print")
    joined = made.join(before, "k").withColumns({name: unfolded(F.col(name)) for name in ("own_print", "edited_print", "next_print")})
    return joined.select(
        F.col("k.id").alias(id_col),
        "n_chars",
        "edited_sha256",
        printed(F.col("own_print")).alias("fingerprint"),
        printed(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("own_print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("own_print"), F.col("next_print")).alias("near_next"),
    )
