"""Token counts by a two-tier table of pre-token lengths, with no shuffle of pre-tokens.

A pre-token here is the text between two single spaces, with the space before it. Where such a
piece neither begins nor ends with white space, the split pattern of byte-level BPE cuts it in
the same way wherever it stands, so its token count can be looked up. All other texts, and texts
that hold an added token's string, are encoded whole by the library.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, text_sizes, texts, worker_cache

SAMPLE_ROWS = 1000
FREQUENT = 50_000
CACHE_ENTRIES = 600_000


class PieceCounter:
    """Token counts of texts in one worker: a fixed table of frequent pieces, then a bounded cache."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.frequent, self.cache = frequent, dict(frequent)

    def counts(self, batch: list[str]) -> list[int]:
        split = [text.split(" ") for text in batch]
        missing = set().union(*[p[1:] for p in split]).difference(self.cache) if split else set()
        if missing:
            if len(self.cache) > CACHE_ENTRIES:
                self.cache = dict(self.frequent)
                missing = set().union(*[p[1:] for p in split]).difference(self.cache)
            self.learn(missing)
        look = self.cache.__getitem__
        heads = self.encoded([p[0] for p in split])
        out = []
        for text, pieces, head in zip(batch, split, heads):
            total = sum(map(look, pieces[1:])) + head
            if total < 0 or pieces[0][-1:].isspace() or any(a in text for a in self.added):
                total = self.encoded([text])[0]
            out.append(total)
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Counts of new pieces; one that can't be looked up counts far below zero."""
        usual, odd = [], []
        for p in pieces:
            (usual if p and not p[0].isspace() and not p[-1].isspace() else odd).append(p)
        self.cache.update(zip(usual, self.encoded([" " + p for p in usual])))
        self.cache.update((p, -(1 << 50)) for p in odd)

    def encoded(self, batch: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(batch, add_special_tokens=False)]


def frequent_lengths(docs: DataFrame, path: str, rows: int = SAMPLE_ROWS, most: int = FREQUENT) -> dict[str, int]:
    """Lengths of the pieces that are frequent in about ``rows`` rows chosen by hash.

    Only speed depends on the sample: whatever it lacks is encoded where it is met.
    """
    there = docs.count()
    share = min(1.0, rows / max(1, there))
    chosen = docs.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).limit(2 * rows)
    seen: Counter[str] = Counter()
    for row in chosen.toLocalIterator():
        seen.update(row["text"].split(" ")[1:])
    counter = PieceCounter(path, {})
    counter.learn(p for p, _ in seen.most_common(most))
    return counter.cache


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    A null text counts as empty: 0 bytes, 0 tokens. A null id is kept. Repeated rows each give a
    row. An empty table gives an empty result. Other columns are not read.
    """
    source = texts(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(source, path))
    key = f"{path}#{shared.id if hasattr(shared, 'id') else id(shared)}"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counters = worker_cache("tokens")
        counter = counters.get(key)
        if counter is None:
            counters.clear()
            counter = counters[key] = PieceCounter(path, shared.value)
        column = batch.column("text")
        counted = counter.counts(column.to_pylist())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(text_sizes(column), pa.int64()),
                pa.array(counted, pa.int64()),
                pa.array([n > limit for n in counted], pa.bool_()),
            ],
            [id_col, "n_bytes", "n_tokens", "over_limit"],
        )

    return in_arrow(source, work, f"{id_col} long, n_bytes long, n_tokens long, over_limit boolean", owner="tokens")
