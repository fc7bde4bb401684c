"""Packing documents into token sequences of a fixed length with minimum bin slack.

Every task tokenizes and packs the documents it reads; nothing is shuffled. Whole windows are
cut from long documents, what is left of each document enters a pool of lengths. For each window
a bitset subset-sum over that pool finds the multiset that comes closest to the capacity, with
backtracked counts. At the end of a task the last windows are filled by cutting.
"""

import base64
import functools
import json
import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The ranks of the vocabulary, and the file of the same vocabulary that also tells its added tokens.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
DEFINITION = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
END_ID = 1
#: Tokens that a task gathers before it packs them; bounds its memory.
BLOCK_TOKENS = 2_000_000
#: Tokens that may wait for a better window from one block to the next.
POOL_TOKENS = 2_000_000
#: The last window of a task is padded if that takes at most so many tokens.
LAST_PADDING = 32

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
#: Only this branch of the pattern looks ahead, and it can only match where two blanks meet.
_LOOK_AHEAD = r"|\s+(?!\S)"
_TWO_BLANKS = re.compile(r"\s\s")


def added_tokens(path: str = DEFINITION) -> dict[str, int]:
    """The strings that the tokenizer of the file takes out of a text before it splits it, and their ids."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    for token in found:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"an added token that isn't matched as it stands: {token}")
    return {token["content"]: token["id"] for token in found}


class Encoder:
    """Texts to their ids as little-endian unsigned 32-bit integers.

    Texts are cut at the added tokens, of those that start together at the longest; each piece between
    is encoded by itself. Pieces without adjacent blanks take the pattern without its look-ahead
    branch, which gives the same ids there and lets a faster matcher run.
    """

    def __init__(self, path: str, added: tuple[tuple[str, int], ...] = ()):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        full = public_tokenizers.PATTERN
        self.full, self.plain = (
            tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            for name, pattern in (("full", full), ("plain", full.replace(_LOOK_AHEAD, "")))
        )

        self.added = {content: np.array([i], "<u4").tobytes() for content, i in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def ids(self, text: str) -> bytes:
        if self.cuts is None:
            return self._ranked(text)
        pieces = self.cuts.split(text)
        return b"".join(self.added[x] if i % 2 else self._ranked(x) for i, x in enumerate(pieces))

    def _ranked(self, text: str) -> bytes:
        tokens = self.full if _TWO_BLANKS.search(text) else self.plain
        return np.array(tokens.encode_ordinary(text), "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str, added: tuple[tuple[str, int], ...] = ()) -> Encoder:
    return Encoder(path, added)


def fullest(lengths: list[int], count: Callable[[int], int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, ``count(n)`` of each at most, with the largest sum up to ``capacity``.

    ``lengths`` ascend and fit; the multiset holds the largest. Bit i of a bitset says that sum i
    can be reached; the bitset before each group of equal lengths is kept, for backtracking.
    Stops at a perfect fill.
    """
    first = lengths[-1]
    room = capacity - first
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        n = lengths[i]
        left, times = min(count(n) - (n == first), room // n), 1
        while left > 0:
            take = min(times, left)
            steps.append((n, take, reach))
            reach |= (reach << (n * take)) & full
            left, times = left - take, times * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {first: 1}
    for n, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[n] = chosen.get(n, 0) + take
            total -= n * take
    return chosen


class Packer:
    """Holds the unfinished documents of one task and hands out finished pieces."""

    def __init__(self, task: int, capacity: int):
        self.capacity = capacity
        self.next_id = task << 33
        self.pool: dict[int, list] = {}  # by length: (document, start) of remainders
        self.pooled = 0  # tokens of the remainders
        self.lengths: list[int] = []  # of the pool, ascending
        self.rows: list[tuple] = []

    def sequence(self, pieces: list[tuple]) -> None:
        """pieces: ((doc_id, ids, place of the first of them, tokens of the document), start, length)."""
        at = 0
        for (doc, ids, base, total), start, n in pieces:
            own = ids[4 * (start - base) : 4 * (start - base + n)]
            self.rows.append((doc, start, n, own, total, self.next_id, at))
            at += n
        self.next_id += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self.sequence([((doc, ids, 0, total), start, self.capacity)])
        if total > whole:  # the pool keeps the ids of the remainder only
            self._put((doc, ids[4 * whole :], whole, total), whole, total - whole)

    def _put(self, document: tuple, start: int, length: int) -> None:
        if length not in self.pool:
            self.pool[length] = []
            insort(self.lengths, length)
        self.pool[length].append((document, start))
        self.pooled += length

    def _take(self, length: int) -> tuple:
        document, start = self.pool[length].pop()
        self.pooled -= length
        if not self.pool[length]:
            del self.pool[length]
            del self.lengths[bisect_left(self.lengths, length)]
        return document, start, length

    def pack(self, last: bool) -> None:
        """Fills windows from the pool; but for the last call, what fills none stays for the next block.

        No more than ``POOL_TOKENS`` stay: beyond, the fullest windows are closed by cutting.
        """
        while self.pool:
            chosen = fullest(self.lengths, lambda n: len(self.pool[n]), self.capacity)
            slack = self.capacity - sum(n * k for n, k in chosen.items())
            if slack and not last and self.pooled <= POOL_TOKENS:
                return
            for _ in range(1 if slack else min(len(self.pool[n]) // k for n, k in chosen.items())):
                pieces = [self._take(n) for n, k in chosen.items() for _ in range(k)]
                while (missing := self.capacity - sum(p[2] for p in pieces)) and self.pool:
                    document, start, n = self._take(self.lengths[-1])
                    pieces.append((document, start, min(n, missing)))
                    if n > missing:
                        self._put(document, start + missing, n - missing)
                self._close(pieces)

    def _close(self, pieces: list[tuple]) -> None:
        """The last window needs no padding where its length is a power of two: split it into such."""
        length = sum(p[2] for p in pieces)
        while LAST_PADDING < self.capacity - length and length & (length - 1):
            part, room = [], 1 << (length.bit_length() - 1)
            length -= room
            while room:
                document, start, n = pieces.pop(0)
                part.append((document, start, min(n, room)))
                if n > room:
                    pieces.insert(0, (document, start + room, n - room))
                room -= part[-1][2]
            self.sequence(part)
        self.sequence(pieces)

    def batches(self) -> Iterator[pa.RecordBatch]:
        rows, self.rows = self.rows, []
        for i in range(0, len(rows), 4096):
            columns = zip(*rows[i : i + 4096], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """One row per piece of a document (``SCHEMA``; ``ids`` are little-endian unsigned 32-bit).

    A document is the ids of its text and then ``end_id``; a null text counts as empty, a null id
    stays null, repeated rows are packed as often as they occur, an empty table gives no rows.
    Strings of ``added`` get their one id wherever they stand, as ``tokenizers`` gives it with those of
    ``added_tokens``; by default there are none, and strings of special tokens are ordinary text.
    Pieces of a sequence follow each other gaplessly by ``offset``. Sequence ids are unique and, for the same input splits, the same in every run.
    Memory: a block of tokens and a pool of at most ``POOL_TOKENS``, plus the longest single document.
    """

    special = tuple((added or {}).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(vocabulary, special), np.array([end_id], "<u4").tobytes()
        packer, tokens = Packer(TaskContext.get().partitionId(), capacity), 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.ids(text.as_py() or "") + end
                packer.add(doc, ids)
                tokens += len(ids) // 4
                if tokens >= BLOCK_TOKENS:
                    packer.pack(last=False)
                    yield from packer.batches()
                    tokens = 0
        packer.pack(last=True)
        yield from packer.batches()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, SCHEMA)
