"""Byte-level BPE by recursive queries in DuckDB, one small database per worker.

Rows of (word, position, token) join the merge table; each round contracts the leftmost pair of
least rank of every word, until no word has a pair. Tokens come back in order, and their bytes decode
the ids. Every distinct pre-token of a batch goes through the query once; a bounded cache per worker
keeps what it gave. A run-on pre-token of more than ``LONG`` bytes would take as many rounds as it
has bytes, so a heap contracts its pairs in the same order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow, texts, worker_cache

LONG = 400
GENERATION = 300_000
WORDS_AT_ONCE = 50_000
# The recursion keeps a row for every token of every round: about half the square of a word's bytes.
SQUARES_AT_ONCE = 1_000_000

ENCODE_SQL = """
WITH RECURSIVE state(round, word, pos, tok, nxt, after) AS (
    SELECT 0::SMALLINT, word, pos, tok, nxt, after FROM given
  UNION ALL
    (WITH best AS (
        SELECT s.word, min((m.rank << 20) + s.pos::INTEGER * 1024 + s.after) AS choice, any_value(s.round) AS round
        FROM state s JOIN merges m ON m.a = s.tok AND m.b = s.nxt GROUP BY s.word),
     pair AS (
        SELECT word, (round + 1)::SMALLINT AS round, (choice >> 20)::INTEGER AS tok,
               (choice >> 10 & 1023)::SMALLINT AS pos, (choice & 1023)::SMALLINT AS gone FROM best)
     SELECT p.round, s.word, s.pos,
            CASE WHEN s.pos = p.pos THEN p.tok ELSE s.tok END,
            CASE WHEN s.pos = p.pos THEN g.nxt WHEN s.after = p.pos THEN p.tok ELSE s.nxt END,
            CASE WHEN s.pos = p.pos THEN g.after ELSE s.after END
     FROM state s JOIN pair p ON p.word = s.word JOIN state g ON g.word = p.word AND g.pos = p.gone
     WHERE s.pos <> p.gone)
), rounds AS (
    SELECT word, max(round) AS round FROM state GROUP BY word
)
SELECT s.word, s.tok FROM state s JOIN rounds r ON r.word = s.word AND r.round = s.round ORDER BY s.word, s.pos
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every pair of tokens whose joined bytes are a token, with that token's rank."""
    pairs = [
        (ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
    ]
    a, b, rank = (np.array(c, np.int64) for c in zip(*pairs))
    return pa.table({"a": a.astype(np.int32), "b": b.astype(np.int32), "rank": rank})


def in_parts(words: list[bytes]) -> Iterator[list[bytes]]:
    """The words in order, a few at a time: so many that the query's rows stay within its memory."""
    start, held = 0, 0
    for i, word in enumerate(words):
        area = len(word) ** 2
        if i > start and (held + area > SQUARES_AT_ONCE or i - start == WORDS_AT_ONCE):
            yield words[start:i]
            start, held = i, 0
        held += area
    if start < len(words):
        yield words[start:]


# Stands for a piece that can't be looked up: any sum that it is in is below zero.
NO_PIECE = (-(1 << 50), b"", b"")


def together(parts: list[tuple[int, bytes, bytes]]) -> tuple[int, bytes, bytes]:
    """Count, ids and decoded bytes of parts that follow one another."""
    if not parts:
        return 0, b"", b""
    n, ids, decoded = zip(*parts)
    return sum(n), b",".join(ids), b"".join(decoded)


class Recent(dict):
    """A bounded cache: when a generation is full, the one before it goes, but for what is used again."""

    def __init__(self):
        super().__init__()
        self.older: dict = {}

    def missing(self, keys: set[str]) -> set[str]:
        """The keys that neither generation has; those of the older one move to the younger."""
        if len(self) > GENERATION:
            self.older = dict(self)
            self.clear()
        wanted = keys.difference(self)
        again = wanted.intersection(self.older)
        self.update((k, self.older[k]) for k in again)
        return wanted.difference(again)


class WordEncoder:
    """Ids and decoded bytes of texts in one worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        self.names = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = merge_table(self.ranks)  # noqa: F841  read by name
        self.db.execute("CREATE TABLE merges AS FROM merges")
        self.words, self.pieces = Recent(), Recent()

    def queried(self, words: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        """Count, ids as decimal text, and decoded bytes of each distinct word, by the query."""
        found: list[tuple[int, bytes, bytes]] = []
        for part in in_parts(words):
            sizes = np.array([len(w) for w in part], np.int64)
            flat = np.frombuffer(b"".join(part), np.uint8)
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            tok = self.byte_ids[flat]
            nxt = np.append(tok[1:], -1)
            nxt[np.cumsum(sizes) - 1] = -1  # the last of a word has no pair
            columns = {"word": np.repeat(np.arange(len(part)), sizes), "pos": pos, "tok": tok, "nxt": nxt, "after": pos + 1}
            kinds = {"word": np.int32, "pos": np.int16, "tok": np.int32, "nxt": np.int32, "after": np.int16}
            given = pa.table({name: c.astype(kinds[name]) for name, c in columns.items()})  # noqa: F841  read by name
            rows = self.db.execute(ENCODE_SQL).fetchnumpy()
            ends = np.searchsorted(rows["word"], np.arange(len(part)), "right").tolist()
            tokens = rows["tok"].tolist()
            numbers, names, start = list(map(b"%d".__mod__, tokens)), list(map(self.names.__getitem__, tokens)), 0
            for end in ends:
                found.append((end - start, b",".join(numbers[start:end]), b"".join(names[start:end])))
                start = end
        return found

    def contracted(self, word: bytes) -> tuple[int, bytes, bytes]:
        """The same for one run-on word."""
        token = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(word):
                rank = self.ranks.get(token[i] + token[after[i]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, token[i], token[after[i]]))

        for i in range(len(word)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if token[i] != left or j >= len(word) or token[j] != right:
                continue
            token[i], token[j], after[i] = left + right, b"", after[j]
            if after[i] < len(word):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        ids = [self.ranks[t] for t in token if t]
        return len(ids), ",".join(map(str, ids)).encode(), b"".join(self.names[i] for i in ids)

    def learn_words(self, words: set[str]) -> None:
        short: dict[str, bytes] = {}
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.words[word] = (1, str(rank).encode(), self.names[rank])
            elif len(raw) > LONG:
                self.words[word] = self.contracted(raw)
            else:
                short[word] = raw
        # Words of one length take about as many rounds, so few rounds are left to a last long word.
        ordered = sorted(short, key=lambda word: len(short[word]))
        self.words.update(zip(ordered, self.queried([short[word] for word in ordered])))

    def joined(self, split: list[list[str]]) -> list[tuple[int, bytes, bytes]]:
        """What each list of words gives together."""
        self.learn_words(self.words.missing(set(itertools.chain.from_iterable(split))))
        look = self.words.__getitem__
        out = []
        for words in split:
            if len(words) == 1:
                out.append(look(words[0]))
                continue
            out.append(together(list(map(look, words))))
        return out

    def encoded(self, batch: list[str]) -> list[tuple[int, bytes, bytes]]:
        """Pieces between single spaces are looked up; where one is odd, the whole text is split."""
        split = [t.split(" ") for t in batch]
        missing = self.pieces.missing(set().union(*[p[1:] for p in split]) if split else set())
        usual = [p for p in missing if p and not p[0].isspace() and not p[-1].isspace()]
        self.pieces.update(dict.fromkeys(missing.difference(usual), NO_PIECE))
        split_up = [[" " + p] if p.isascii() and p.isalpha() else self.pattern.findall(" " + p) for p in usual]
        self.pieces.update(zip(usual, self.joined(split_up)))
        heads = self.joined([self.pattern.findall(p[0]) for p in split])
        look, out, odd = self.pieces.__getitem__, [], []
        for i, (pieces, head) in enumerate(zip(split, heads)):
            parts = list(map(look, pieces[1:]))
            if head[0]:
                parts.insert(0, head)
            made = together(parts)
            if made[0] < 0 or pieces[0][-1:].isspace():
                odd.append(i)
            out.append(made)
        for i, whole in zip(odd, self.joined([self.pattern.findall(batch[i]) for i in odd])):
            out[i] = whole
        return out


def encode_decode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row: ``id_col``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas) and
    ``decoded_sha256`` (bytes that the ids decode to); ``with_ids`` adds ``ids`` and ``decoded``.

    A null text counts as empty: no ids, hashes of nothing. A null id is kept, repeated rows each
    give a row, an empty table gives an empty result, other columns are not read.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoders = worker_cache("bpe")
        encoder = encoders.get((path, pattern))
        if encoder is None:
            encoder = encoders[path, pattern] = WordEncoder(path, pattern)
        made = encoder.encoded(batch.column("text").to_pylist())
        arrays = [
            batch.column("id"),
            pa.array([n for n, _, _ in made], pa.int64()),
            pa.array([hashlib.sha256(ids).hexdigest() for _, ids, _ in made], pa.string()),
            pa.array([hashlib.sha256(text).hexdigest() for _, _, text in made], pa.string()),
        ]
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            arrays += [
                pa.array([[int(i) for i in ids.split(b",") if i] for _, ids, _ in made], pa.list_(pa.int32())),
                pa.array([text for _, _, text in made], pa.binary()),
            ]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(arrays, names)

    schema = f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return in_arrow(texts(docs, id_col, text_col), work, schema + ", ids array<int>, decoded binary" * with_ids, owner="bpe")
