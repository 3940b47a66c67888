"""Best-fit packing of documents into sequences under several capacities.

Tokens come from a word-level cache per worker over the given tokenizer. Documents are cut into
pieces no longer than a sequence. Full pieces are sequences of their own. The others are dealt at
random into groups of bounded size, and each group packs its pieces, longest first: a bin must have
room for the piece's tokens, its document and its attention cost (squared length); of those, the one
whose weighted residual after placing has the least norm takes it ("residual"), or the one with the
greatest weighted dot product of piece and residual ("dot"). A group leaves at most a few bins
unfilled, so the count stays within a small fraction of a global packing at any size.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Recent
from .common import checkpointed, in_arrow, ship, texts, worker_cache

GROUP_PIECES = 40_000
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # as in the tokenizer's own file
# A text of these characters alone is cut beside every word that is not of letters, as ``SPLIT`` would.
ODD = "[^ -~¡-įı-ž]"  # ſ is an s to RE2
APART = r" ?('[sS]|'[tT]|'[rR][eE]|'[vV][eE]|'[mM]|'[lL][lL]|'[dD]|\p{N}|[^ \p{L}\p{N}]+) ?"


class WordIds:
    """Ids of texts in one worker, as little-endian 32-bit bytes, by cached words.

    White space only separates words for this tokenizer, so a text may be cut at every space. A
    piece of Latin letters is lower-cased and split into words here; any other piece, and a text
    with an added token's string, goes to the library whole. A text without other characters is cut
    into words by Arrow, so that its pieces are words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.library, self.split = Tokenizer.from_file(path), regex.compile(SPLIT)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words, self.pieces = Recent(), Recent()

    def whole(self, batch: list[str]) -> list[bytes]:
        made = self.library.encode_batch_fast(batch, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def learn_words(self, words: list[str]) -> None:
        """Ids of distinct words, by one call over all of them; the library says whose each id is."""
        if not words:
            return
        made = self.library.encode(" ".join(words), add_special_tokens=False)
        ids, owner = np.array(made.ids, "<u4"), np.array(made.word_ids, np.int64)
        ends = np.searchsorted(owner, np.arange(len(words)), "right")
        if len(owner) and owner[-1] == len(words) - 1:
            raw, start = ids.tobytes(), 0
            for word, end in zip(words, ends.tolist()):
                self.words[word] = raw[4 * start : 4 * end]
                start = end
        else:
            self.words.update(zip(words, self.whole(words)))

    def learn(self, pieces: set[str]) -> None:
        usual = [p for p in pieces if p.isascii() or (max(p) < "ƀ" and "İ" not in p)]
        odd = list(pieces.difference(usual))
        split = [[p.lower()] if p.isalpha() else self.split.findall(p.lower()) for p in usual]
        self.learn_words(list(self.words.missing({w for words in split for w in words})))
        look = self.words.__getitem__
        self.pieces.update((p, b"".join(map(look, words))) for p, words in zip(usual, split))
        self.pieces.update(zip(odd, self.whole(odd)))

    def joined(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the n + 1 bounds of the texts in them.

        Only the distinct pieces of the column are seen one by one; the others are looked up as a whole.
        """
        lines = pc.replace_substring(column, "\n", " ")
        odd = pc.match_substring_regex(lines, ODD)
        lists = pc.split_pattern(pc.if_else(odd, lines, pc.replace_substring_regex(lines, APART, r" \1 ")), " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        self.learn(self.pieces.missing(set(pieces)))
        found = list(map(self.pieces.__getitem__, pieces))
        table = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter((len(ids) // 4 for ids in found), np.int64, len(found))
        codes = coded.indices.to_numpy()
        n = sizes[codes]
        ends = np.cumsum(n)
        ids = table[np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.append(0, ends)[at - at[0]]

    def encoded(self, column: pa.Array | list[str]) -> list[bytes]:
        """The ids of each text."""
        if isinstance(column, list):
            column = pa.array(column, pa.large_string())
        ids, bounds = self.joined(column)
        raw = ids.tobytes()
        out = [raw[4 * start : 4 * end] for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        special = np.zeros(len(column), bool)
        for token in self.added:
            special |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(special)
        for i, whole in zip(rest.tolist(), self.whole(column.take(pa.array(rest)).to_pylist())):
            out[i] = whole
        return out


def cut_pieces(docs: DataFrame, path: str, length: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    tail = np.array([end_id], "<u4").tobytes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoders = worker_cache("packing")
        if path not in encoders:
            encoders[path] = WordIds(path)
        rows: list[tuple[int, int, int, int, int]] = []
        for i, ids in enumerate(encoders[path].encoded(batch.column("text"))):
            ids += tail
            for k, at in enumerate(range(0, len(ids), 4 * length)):
                part = ids[at : at + 4 * length]
                rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
        of, piece, start, n, crc = (np.array(c, np.int64) for c in zip(*rows))
        arrays = [batch.column("id").take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(n), pa.array(crc)]
        return pa.RecordBatch.from_arrays(arrays, ["id", "piece", "start", "length", "ids_crc32"])

    schema = "id long, piece int, start long, length long, ids_crc32 long"
    return in_arrow(texts(docs, id_col, text_col), work, schema, owner="packing")


def fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "residual") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first. ``capacity``: tokens, documents, attention cost."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    scale = weights / capacity**2
    # Bins with the same residual are alike: each state holds the bins that are in it.
    states: dict[tuple[int, int, int], list[int]] = {}
    by_tokens: list[set[tuple[int, int, int]]] = [set() for _ in range(int(capacity[0]) + 1)]
    room = np.zeros(int(capacity[0]) + 1, bool)
    made = 0
    for i in order.tolist():
        n = int(lengths[i])
        need = np.array([n, 1, n * n], np.float64)
        best, score = None, np.inf
        for tokens in np.flatnonzero(room[n:]) + n:
            # Less room left in tokens bounds the score from below, so later states can't win.
            if rule == "residual" and scale[0] * float(tokens - n) ** 2 >= score:
                break
            for state in by_tokens[tokens]:
                left = np.array(state, np.float64)
                if (left >= need).all():
                    now = float((scale * (left - need) ** 2).sum()) if rule == "residual" else -float((scale * left * need).sum())
                    if now < score:
                        best, score = state, now
        if best is None:
            bin_, left = made, tuple(int(c) for c in capacity)
            made += 1
        else:
            bin_, left = states[best].pop(), best
            if not states[best]:
                del states[best]
                by_tokens[best[0]].discard(best)
                room[best[0]] = bool(by_tokens[best[0]])
        bins[i], offsets[i] = bin_, int(capacity[0]) - left[0]
        state = (left[0] - n, left[1] - 1, left[2] - n * n)
        if state[0] > 0 and state[1] > 0:
            states.setdefault(state, []).append(bin_)
            by_tokens[state[0]].add(state)
            room[state[0]] = True
    return bins, offsets


def pack(
    docs: DataFrame,
    path: str,
    length: int = 2048,
    documents: int | None = None,
    attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "residual",
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    ``documents`` and ``attention`` bound the pieces and the summed squared lengths of a sequence;
    by default neither binds before the tokens do. A null text counts as empty: one piece that
    holds ``end_id`` alone. Null ids and repeated rows are packed like others. An empty table gives
    an empty result; other columns are not read.
    """
    documents, attention = documents or length, attention or length * length
    if attention < length * length:
        raise ValueError("a full piece alone needs length * length of attention cost")
    capacity = np.array([length, documents, attention], np.float64)
    share = np.array(weights, np.float64)
    # Written once: the group of a piece must not change when a lost task runs again.
    pieces = checkpointed(cut_pieces(docs, path, length, end_id, id_col, text_col))
    full = F.col("length") == length
    groups = max(1, -(-pieces.where(~full).count() // GROUP_PIECES))
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(groups))
    names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = fit(frame["length"].to_numpy(), capacity, share, rule)
        return frame.assign(sequence_id=bins * groups + frame["group"].to_numpy(), offset=offsets)[names]

    schema = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    ship(docs)
    rest = pieces.where(~full).withColumn("group", dealt).groupBy("group").applyInPandas(packed, schema)
    alone = pieces.where(full).select(
        *names[:5], (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return rest.unionByName(alone).withColumnRenamed("id", id_col)
