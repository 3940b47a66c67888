"""Masked pseudo-likelihood of documents under a bidirectional window network, trained in numpy.

Every word of a document is hidden in turn and predicted from the words around it: the network adds
one vector per neighbour place and word, squashes the sum, and gives the word by two softmaxes, one
over frequency classes and one over the members of the class. The sum of all log-probabilities is
the document's pseudo-log-likelihood.

Words are counted by their full hash, in Spark, where the counts stay. A word of at least a threshold
count has an outcome of its own. The threshold grows more slowly than the corpus (``least_count``), so
that the outcomes, and with them the network, grow with it. The other words share outcomes, and the
probability of a word within its outcome is its count by the count of the outcome: what is summed is the
likelihood of the words themselves.

Training is data-parallel: in each round every task starts from the same weights, learns from its share
of the documents of that round (each document belongs to one round), and the weights are averaged by
the words that each task saw. As many tasks train as keep what they send together below the bytes of
the texts: the network grows with the cube root of the corpus, so the tasks grow with the rest. They
send blocks of one size, which are summed in a tree, ``FAN`` at a time.

The driver and each worker hold one network. It has at most GROWTH * words^(1/3) outcomes of words, 4/3 as
many in all, and 4 * (4 * WIDTH + WIDTH + 2) bytes or less for each: 24 MB for 80 million words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, in_arrow, ship, sliced, small_enough, text_bytes, texts
from .shingles import text_words

SIDE = 64  # classes, and members of a class, of the least network
OUTCOMES = SIDE * SIDE
OWN = OUTCOMES * 3 // 4  # so many words have outcomes of their own in the least network
GROWTH = 128
BINS = 8  # bins of word counts for each power of two
FIXED = 1 << 30  # sums of logarithms are whole numbers of this part, so that their order does not matter
PLACES = (-2, -1, 1, 2)
WIDTH = 16
BLOCK = 1 << 16  # weights sent in one row
FAN = 64
WORD_BYTES = 8  # of text for each word, about
LEARN_ROWS, SCORE_ROWS = 4096, 32768
SLICE, COUNT_SLICE = 2 << 20, 8 << 20
SENT = pa.schema({"block": pa.int32(), "task": pa.int32(), "seen": pa.int64(), "moved": pa.binary()})


class Network:
    """The weights, as one flat vector with named views."""

    @staticmethod
    def shapes(side: int) -> dict[str, tuple[int, ...]]:
        return {
            "near": (len(PLACES), side * side + 1, WIDTH),
            "bias": (WIDTH,),
            "to_class": (WIDTH, side),
            "class_bias": (side,),
            "to_member": (side, WIDTH, side),
            "member_bias": (side, side),
        }

    def __init__(self, flat: np.ndarray, side: int = SIDE):
        self.flat, self.side, at = flat, side, 0
        for name, shape in self.shapes(side).items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def size(cls, side: int = SIDE) -> int:
        return sum(int(np.prod(s)) for s in cls.shapes(side).values())

    @classmethod
    def fresh(cls, counts: np.ndarray, seed: int = 1) -> "Network":
        """Small random vectors; the biases give the outcome frequencies."""
        side = math.isqrt(len(counts))
        made = cls(np.random.default_rng(seed).normal(0, 0.1, cls.size(side)).astype(np.float32), side)
        made.bias[:] = 0
        share = (counts + 1.0).reshape(side, side)
        made.class_bias[:] = np.log(share.sum(1) / share.sum())
        made.member_bias[:] = np.log(share / share.sum(1, keepdims=True))
        return made

    def forward(self, around: np.ndarray, word: np.ndarray, grads: "list | None" = None) -> np.ndarray:
        """Log-probabilities of the words; with ``grads``, adds the gradients of their negative mean.

        A gradient is the name of a view, an index of it, and the values there; all else has none.
        """
        order = np.argsort(word // self.side, kind="stable")  # rows of one class lie together
        around, cls, member = around[order], word[order] // self.side, word[order] % self.side
        hidden = self.bias + sum(self.near[p][around[:, p]] for p in range(len(PLACES)))
        np.tanh(hidden, out=hidden)
        row = np.arange(len(word))
        out, slope, scale = _log_softmax(hidden @ self.to_class + self.class_bias, row, cls)
        if grads is not None:
            grads.append(("to_class", ..., (hidden * scale[:, None]).T @ slope))
            grads.append(("class_bias", ..., scale @ slope))
            back = slope @ self.to_class.T * scale[:, None]
        ends = np.searchsorted(cls, np.arange(self.side + 1))
        for c in np.flatnonzero(np.diff(ends)).tolist():
            mine = slice(ends[c], ends[c + 1])
            near = hidden[mine]
            logs, slope, scale = _log_softmax(near @ self.to_member[c] + self.member_bias[c], row[: len(near)], member[mine])
            out[mine] += logs
            if grads is not None:
                scale *= len(near) / len(word)
                grads.append(("to_member", c, (near * scale[:, None]).T @ slope))
                grads.append(("member_bias", c, scale @ slope))
                back[mine] += slope @ self.to_member[c].T * scale[:, None]
        if grads is not None and len(word):
            back *= 1 - hidden * hidden
            grads.append(("bias", ..., back.sum(0)))
            for p in range(len(PLACES)):
                by_row = np.argsort(around[:, p], kind="stable")
                place = around[by_row, p]
                first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                grads.append(("near", (p, place[first]), np.add.reduceat(back[by_row], first, axis=0)))
        unsorted = np.empty_like(out)
        unsorted[order] = out
        return unsorted


def _log_softmax(x: np.ndarray, row: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-probability of each row's target; the slopes of their negative mean are a row of the second by the third.

    The greatest number of a row is taken off first, so that no exponential overflows and not all vanish.
    """
    x -= x.max(axis=1, keepdims=True)
    out = x[row, target]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    x[row, target] -= total
    return out - np.log(total), x, 1 / (total * max(1, len(row)))


@dataclass
class Vocabulary:
    """Words that have an outcome each, by signed hash, and the counts of all outcomes."""

    own: np.ndarray  # in order
    rank: np.ndarray  # outcome of each of them
    side: int
    counts: np.ndarray

    def outcomes(self, words: np.ndarray) -> np.ndarray:
        shared = shared_outcome(words, len(self.own), self.side)
        if not len(self.own):
            return shared
        at = np.minimum(np.searchsorted(self.own, words), len(self.own) - 1)
        return np.where(self.own[at] == words, self.rank[at], shared)


def shared_outcome(words, own: int, side: int):
    return own + words % (side * side - own)


def words_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The word hashes of each text, signed as Spark has them."""
    return [words.view(np.int64) for words in text_words(*text_bytes(batch.column("text")))]


def windows(words: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Outcomes around each word, and of the word. Nothing beyond a text is around its words."""
    reach, none = max(PLACES), vocabulary.side**2
    lengths = np.array([len(w) for w in words], np.int64)
    row = np.full(int(lengths.sum()) + reach * (len(words) + 1), none, np.int64)
    at = np.arange(int(lengths.sum())) + reach * (1 + np.repeat(np.arange(len(words)), lengths))
    row[at] = vocabulary.outcomes(np.concatenate([np.zeros(0, np.int64), *words]))
    return np.stack([row[at + p] for p in PLACES], axis=1), row[at]


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``: how often each word hash occurs in all texts. A slice sends a word once."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        some, n = np.unique(np.concatenate([np.zeros(0, np.int64), *words_of(batch)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array(n.astype(np.int64))], ["word", "n"])

    made = in_arrow(docs.select("text"), work, "word long, n long", COUNT_SLICE)
    return checkpointed(made.groupBy("word").agg(F.sum("n").alias("n")))


def least_count(bins: list[tuple[int, int, int]], total: int) -> int:
    """The count from which words have outcomes of their own.

    ``bins``: number, least count and number of words of each bin of counts. The threshold is
    total^(2/3) / GROWTH, so at most GROWTH * total^(1/3) words are above it, or less if that
    leaves places of the least network free.
    """
    least, held = total + 1, 0
    for _, low, there in sorted(bins, reverse=True):
        held += there
        if held > OWN:
            break
        least = low
    return min(least, max(1, math.ceil(total ** (2 / 3) / GROWTH)))


def vocabulary(counted: DataFrame) -> Vocabulary:
    """The driver gathers the words above the threshold, and one count for each shared outcome."""
    number = F.floor(F.log2("n") * BINS).cast("int")
    bins = counted.groupBy(number.alias("bin")).agg(F.min("n"), F.count("*"), F.sum("n")).collect()
    least = least_count([tuple(b[:3]) for b in bins], sum(b[3] for b in bins))
    top = counted.where(F.col("n") >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])
    side = max(SIDE, math.ceil(math.sqrt(len(top) * 4 / 3)))
    counts = np.zeros(side * side)
    counts[: len(top)] = top["n"]
    at = F.pmod(F.col("word"), F.lit(side * side - len(top))) + len(top)
    for outcome, n in counted.where(F.col("n") < least).groupBy(at.alias("at")).agg(F.sum("n")).collect():
        counts[outcome] = n
    hashes = top["word"].to_numpy(np.int64)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], order, side, counts)


def learn(network: Network, around: np.ndarray, word: np.ndarray, memory: Network, rate: float) -> None:
    """Adagrad steps over the words, in a fixed order. ``memory`` sums the squares of the gradients."""
    order = np.random.default_rng(len(word)).permutation(len(word))
    for start in range(0, len(word), LEARN_ROWS):
        some, grads = order[start : start + LEARN_ROWS], []
        network.forward(around[some], word[some], grads)
        for name, at, slope in grads:
            squares = getattr(memory, name)
            squares[at] += slope * slope
            getattr(network, name)[at] -= rate * slope / (np.sqrt(squares[at]) + 1e-6)


def averaged(moved: DataFrame, tasks: int) -> DataFrame:
    """``block``, ``seen`` and ``moved``: weights times words, summed over the tasks 0 to ``tasks`` - 1, in a tree."""

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("task")  # so that sums are alike in each run
        total = sum(np.frombuffer(m, np.float32).astype(np.float64) for m in frame["moved"])
        first = frame.iloc[:1]
        return first.assign(task=first["task"] // FAN, seen=frame["seen"].sum(), moved=[total.astype(np.float32).tobytes()])

    while True:
        moved = moved.groupBy("block", F.floor(F.col("task") / FAN)).applyInPandas(added, "block int, task int, seen long, moved binary")
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            return moved


def train(docs: DataFrame, rounds: int = 2, rate: float = 0.1) -> tuple[Network, Vocabulary, DataFrame]:
    """The network after ``rounds`` rounds over disjoint shares of all documents, the vocabulary, and the word counts."""
    context = docs.sparkSession.sparkContext
    counted = count_words(docs)
    known = vocabulary(counted)
    network = Network.fresh(known.counts)
    tasks = max(context.defaultParallelism, int(known.counts.sum()) * WORD_BYTES // network.flat.nbytes)
    for k in range(rounds):
        shared = context.broadcast((network.flat, known))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start, known = shared.value
            own, memory, seen = Network(start.copy(), known.side), Network(np.full(len(start), 1e-8, np.float32), known.side), 0
            for part in sliced(batches, SLICE):
                around, word = windows(words_of(part), known)
                learn(own, around, word, memory, rate)
                seen += len(word)
            if seen:
                task = TaskContext.get().partitionId()
                for block, at in enumerate(range(0, len(start), BLOCK)):
                    piece = (own.flat[at : at + BLOCK] - start[at : at + BLOCK]) * np.float32(seen)
                    row = {"block": block, "task": task, "seen": seen, "moved": piece.tobytes()}
                    yield pa.RecordBatch.from_pylist([row], SENT)

        share = docs.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).select("text").coalesce(tasks)
        sent = share.mapInArrow(run, "block int, task int, seen long, moved binary")
        for r in averaged(sent, tasks).toLocalIterator():  # one block at a time, together one network
            at = r["block"] * BLOCK
            network.flat[at : at + BLOCK] += np.frombuffer(r["moved"], np.float32) / np.float32(r["seen"])
        shared.unpersist()
    return network, known, counted


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2, rate: float = 0.1) -> DataFrame:
    """Per row: ``id_col``, ``n_words``, ``log_likelihood`` (summed) and ``mean_log_likelihood``.

    The network learns from all of ``docs``. A null text, or one without words, has 0 words, a sum
    of 0 and a null mean. Null ids are kept, repeated rows are scored alike, an empty table gives an
    empty result, other columns are not read.
    """
    source = texts(docs, id_col, text_col)
    network, known, counted = train(source, rounds, rate)
    shared = docs.sparkSession.sparkContext.broadcast((network.flat, known))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, known = shared.value
        network, words = Network(flat, known.side), words_of(batch)
        around, word = windows(words, known)
        logs = np.empty(len(word))
        for start in range(0, len(word), SCORE_ROWS):
            some = slice(start, start + SCORE_ROWS)
            logs[some] = network.forward(around[some], word[some])
        rare = word >= len(known.own)
        logs[rare] -= np.log(known.counts[word[rare]])
        counts = np.array([len(w) for w in words], np.int64)
        bounds = np.append(0, np.cumsum(counts))
        total = np.diff(np.append(0, np.cumsum(logs))[bounds])
        offsets = np.append(0, np.cumsum(rare))[bounds].astype(np.int32)
        looked_up = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *words])[rare]))
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts), pa.array(total), looked_up], ["id", "n_words", "base", "rare"])

    # The counts of words that share outcomes are joined; a count of 1 adds nothing.
    made = in_arrow(source, work, "id long, n_words long, base double, rare array<long>", SLICE)
    made = checkpointed(made.withColumn("row", F.monotonically_increasing_id()))
    several = small_enough(counted.where("n > 1"), 16)
    part = F.round(F.log("n") * FIXED).cast("long")
    added = made.select("row", F.explode("rare").alias("word")).join(several, "word").groupBy("row").agg(F.sum(part).alias("more"))
    total = F.col("base") + F.coalesce("more", F.lit(0)) / FIXED
    scored = made.drop("rare").join(added, "row", "left")
    return scored.select(
        F.col("id").alias(id_col),
        "n_words",
        total.alias("log_likelihood"),
        F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_likelihood"),
    )
