"""Language ID by a string kernel.

The kernel of two texts counts the n-grams of bytes (n = 1..4, lower case, hashed) that are present
in both, over the root of the product of both counts: a blended spectrum presence kernel. Landmark
texts span a Nystrom feature space, in which one ridge regression per language tells it from the
rest. As the kernel is linear in the presence vector, landmarks and regressions fold into one weight
per n-gram and language, and a batch of texts is scored by one matrix product.

The learning sample is bounded: about ``per_language`` labelled rows per language, chosen by hash,
and ``landmarks`` of them in all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, text_bytes

GRAMS = (1, 2, 3, 4)
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
ROWS_AT_ONCE = 128


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray


def presence(texts: pa.Array) -> np.ndarray:
    """One row per text: 1 for every bucket that an n-gram of the text falls into."""
    flat, bounds = text_bytes(pc.utf8_lower(texts))
    out = np.zeros((len(texts), BUCKETS), np.uint8)
    code = np.zeros(len(flat), np.uint64)
    for n in GRAMS:
        if len(flat) < n:
            break
        code = code[: len(flat) - n + 1] * np.uint64(256) + flat[n - 1 :]
        mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        for i in range(len(texts)):
            out[i, bucket[bounds[i] : max(bounds[i], bounds[i + 1] - n + 1)]] = 1
    return out


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(1.0, rows.sum(1, dtype=np.float64)))


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Kernel values between packed presence rows, in blocks."""
    right = np.unpackbits(landmarks, axis=1).astype(np.float32)
    right /= norms(right)[:, None].astype(np.float32)
    out = np.empty((len(rows), len(right)))
    for start in range(0, len(rows), ROWS_AT_ONCE):
        left = np.unpackbits(rows[start : start + ROWS_AT_ONCE], axis=1).astype(np.float32)
        out[start : start + ROWS_AT_ONCE] = (left @ right.T) / norms(left)[:, None]
    return out


def learn(rows: np.ndarray, labels: list[str], landmarks: int = 256, ridge: float = 1e-2) -> LanguageModel:
    """Nystrom features of the packed ``rows`` and one ridge regression per label."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    label = np.array([languages.index(x) for x in labels])
    by_label = [np.flatnonzero(label == k) for k in range(len(languages))]
    share = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.unique(k[np.linspace(0, len(k) - 1, min(share, len(k))).astype(int)]) for k in by_label])
    values, vectors = np.linalg.eigh(kernel(rows[chosen], rows[chosen]))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel(rows, rows[chosen]) @ root
    targets = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Each language weighs the same, however many rows the sample has of it.
    weight = (len(label) / len(languages) / np.bincount(label))[label][:, None]
    bias = (weight * targets).sum(0) / weight.sum()
    gram = features.T @ (weight * features) + ridge * len(label) * np.eye(features.shape[1])
    beta = np.linalg.solve(gram, features.T @ (weight * (targets - bias)))
    marks = np.unpackbits(rows[chosen], axis=1).astype(np.float32)
    marks /= norms(marks)[:, None].astype(np.float32)
    return LanguageModel(languages, (marks.T @ (root @ beta).astype(np.float32)), bias)


def scores(model: LanguageModel, texts: pa.Array) -> np.ndarray:
    """Regression values of each text and language, by one matrix product a block."""
    out = np.empty((len(texts), len(model.languages)))
    for start in range(0, len(texts), ROWS_AT_ONCE):
        rows = presence(texts.slice(start, ROWS_AT_ONCE)).astype(np.float32)
        out[start : start + ROWS_AT_ONCE] = (rows @ model.weights) / norms(rows)[:, None] + model.bias
    return out


def fit(labelled: DataFrame, per_language: int = 600, landmarks: int = 256, ridge: float = 1e-2) -> LanguageModel:
    """Learn from ``labelled`` (id, text, lang). Presence bits come to the driver, never texts."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    million = 1_000_000
    share: Column = F.lit(0)
    for lang, there in counts.items():
        share = F.when(F.col("lang") == lang, int(min(1.0, per_language / there) * million) + 1).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(million)) < share).select("text", "lang")

    def bits(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = np.packbits(presence(batch.column("text")), axis=1)
        return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([r.tobytes() for r in packed], pa.binary())], ["lang", "bits"])

    learned = sorted((r["lang"], bytes(r["bits"])) for r in in_arrow(sample, bits, "lang string, bits binary", 1 << 19).collect())
    packed = np.frombuffer(b"".join(b for _, b in learned), np.uint8).reshape(len(learned), BUCKETS // 8)
    return learn(packed, [lang for lang, _ in learned], landmarks, ridge)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score``.

    The score is (1 + lead) / 2, where the lead is half the distance of the best language's
    regression value to the next one's, cut to 0..1. A null text, a text without letters, or a
    model of no languages gives ``und`` and 0. Repeated rows are scored alike; ties go to the
    language that sorts first; an empty table gives an empty result. Columns of ``docs`` that are
    called ``lang_pred`` or ``score`` are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    inner = [f"c{i}" for i in range(len(kept))]
    given = docs.select(*[docs[c].alias(i) for c, i in zip(kept, inner)], F.coalesce(docs[text_col], F.lit("")).alias("text"))
    carried = [docs.schema[c].dataType.simpleString() for c in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, texts = shared.value, batch.column("text")
        named, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if model.languages:
            values = scores(model, texts)
            letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            best = values.argmax(1)
            ordered = np.sort(values, axis=1)
            lead = (ordered[:, -1] - ordered[:, -2]) / 2 if values.shape[1] > 1 else np.ones(len(texts))
            sure = np.where(letters, np.clip((1 + lead) / 2, 0, 1), 0.0)
            named = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
        arrays = [batch.column(i) for i in range(len(inner))] + [pa.array(named, pa.string()), pa.array(sure, pa.float64())]
        return pa.RecordBatch.from_arrays(arrays, [*inner, "lang_pred", "score"])

    schema = ", ".join([f"{i} {kind}" for i, kind in zip(inner, carried)] + ["lang_pred string", "score double"])
    made = in_arrow(given, work, schema, 1 << 21)
    return made.select(*[F.col(i).alias(c) for i, c in zip(inner, kept)], "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
