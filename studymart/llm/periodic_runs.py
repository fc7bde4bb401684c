"""Periodic runs of words by recompression.

The words of many documents, each document closed by a symbol of its own, are compressed in rounds:
one round names every block of equal symbols, the next names pairs of a left and a right symbol,
with the sides of symbols dealt by a hash. What lies between two boundaries of a level is named
alike wherever it occurs, up to its ends, so the levels form a run-length grammar in which a
common extension is found by climbing while both positions stand at boundaries and descending after
the first difference. A run of period q and at least four periods holds a multiple of 3 q (5, where
q is 1) whose word is equal to the word q later; those grid positions are the candidates, harmonic
in number, and their exact extension to both sides comes from the grammar. No suffixes are sorted.
"""

import functools
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Periods that a run has at least, and words.
LEAST_PERIODS, LEAST_WORDS = 4, 6
#: Words that are compressed together; documents are never cut.
BLOCK_WORDS = 200_000
#: Longest document whose grid is remembered, and candidates of longer ones that are looked at together.
GRID_WORDS, GRID_PART = 1 << 15, 1 << 20

RUNS = "array<struct<start: long, length: long, period: long>>"
SCHEMA = f"doc_id long, n_words long, runs {RUNS}, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
)


class Level:
    """Symbols of one level, and which symbol of the next level each is part of."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, blocks: bool):
        self.symbols = symbols
        #: Index of the parent of each symbol, and of the end.
        self.parent = np.append(np.cumsum(first) - 1, np.count_nonzero(first))
        #: Where the symbols of the next level begin; the end last.
        self.starts = np.append(np.flatnonzero(first), len(symbols))
        self.blocks = blocks

    def stands(self, at: np.ndarray) -> np.ndarray:
        """Whether boundaries of this level are boundaries of the next."""
        return self.starts[self.parent[at]] == at

    def run_after(self, at: np.ndarray) -> np.ndarray:
        return self.starts[self.parent[at] + 1] - at

    def run_before(self, at: np.ndarray) -> np.ndarray:
        return at - self.starts[self.parent[at - 1]]


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    found, names = np.unique(keys, return_inverse=True)
    return names, len(found)


def _sides(symbols: np.ndarray, round_: int) -> np.ndarray:
    """A fixed bit of each symbol: the left side of pairs or the right one."""
    h = (symbols.astype(np.uint64) + np.uint64(round_ * 2 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(61) & np.uint64(1)).astype(bool)


class Grammar:
    """The levels of a sequence, up to the one in which all symbols differ."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[Level] = []
        for round_ in itertools.count():
            names, n = _names(symbols)
            if n == len(symbols):
                self.top = names
                return
            first = np.ones(len(names), bool)
            first[1:] = names[1:] != names[:-1]
            level = Level(names, first, blocks=True)
            self.levels.append(level)
            sizes = np.diff(level.starts)
            symbols, _ = _names(names[level.starts[:-1]] * (len(names) + 1) + sizes)
            left = _sides(symbols, round_)
            first = np.ones(len(symbols), bool)
            first[1:] = ~(left[:-1] & ~left[1:])
            level = Level(symbols, first, blocks=False)
            self.levels.append(level)
            heads, paired = level.starts[:-1], np.diff(level.starts) == 2
            second = np.where(paired, symbols[np.minimum(heads + 1, len(symbols) - 1)] + 1, 0)
            symbols = symbols[heads] * (len(symbols) + 1) + second

    def extend(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on (or before them) are equal; a and b differ.

        A symbol that occurs once must lie between any two equal extensions and the end.
        """
        n = len(a)
        at, to = a.astype(np.int64), b.astype(np.int64)
        # Positions that climb, level by level; the others wait where they met a difference.
        climbing, met = np.arange(n), np.full(n, len(self.levels))
        for k, level in enumerate(self.levels):
            x, y = at[climbing], to[climbing]
            up = level.stands(x) & level.stands(y)
            step = np.flatnonzero(~up)
            if len(step):
                xs, ys = x[step], y[step]
                same, xs, ys, ended = _step(level, xs, ys, forward)
                x[step], y[step] = xs, ys
                # after an equal symbol both stand at boundaries, unless one run was longer
                up[step] = same & ~ended
            at[climbing], to[climbing] = x, y
            met[climbing[~up]] = k
            climbing = climbing[up]
            at[climbing], to[climbing] = level.parent[x[up]], level.parent[y[up]]
            if not len(climbing):
                break
        # Descend: at each level the children of what differs above, equal for one step at most.
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            below = np.flatnonzero(met == k + 1)
            if len(below):
                at[below], to[below] = level.starts[at[below]], level.starts[to[below]]
                _, at[below], to[below], _ = _step(level, at[below], to[below], forward)
                met[below] = k
        return at - a if forward else a - at


def _step(level: Level, x: np.ndarray, y: np.ndarray, forward: bool) -> tuple:
    """(equal, new x, new y, one run was longer) after the symbol, or the run, next to x and y."""
    n = len(level.symbols)
    if forward:
        inside = (x < n) & (y < n)
        same = inside & (level.symbols[np.minimum(x, n - 1)] == level.symbols[np.minimum(y, n - 1)])
    else:
        inside = (x > 0) & (y > 0)
        same = inside & (level.symbols[np.maximum(x - 1, 0)] == level.symbols[np.maximum(y - 1, 0)])
    length, ended = same.astype(np.int64), ~same
    if level.blocks and same.any():
        left = level.run_after if forward else level.run_before
        rx, ry = left(x[same]), left(y[same])
        length[same] = np.minimum(rx, ry)
        ended[same] = rx != ry
    length = length if forward else -length
    return same, x + length, y + length, ended


def _grid_part(low: int, high: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid positions of the periods from low to below high, and the positions a period later."""
    periods = np.arange(low, high)
    steps = np.where(periods == 1, LEAST_WORDS - 1, (LEAST_PERIODS - 1) * periods)
    counts = np.maximum(0, -(-(n - periods) // steps))
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at *= np.repeat(steps, counts)
    return at, at + np.repeat(periods, counts)


@functools.lru_cache(maxsize=1)
def _grid() -> tuple[np.ndarray, np.ndarray]:
    """The grid of the longest remembered document; that of a shorter one is where it begins."""
    at, to = _grid_part(1, GRID_WORDS // LEAST_PERIODS + 1, GRID_WORDS)
    order = np.argsort(to, kind="stable")
    return at[order].astype(np.int32), to[order].astype(np.int32)


def candidates(symbols: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid positions of symbols[begin:end] whose word is that of a period later, and those later ones."""
    n, own = end - begin, symbols[begin:end]
    found = []
    if n <= GRID_WORDS:
        at, to = _grid()
        n_pairs = np.searchsorted(to, n)
        at, to = at[:n_pairs], to[:n_pairs]
        keep = (own[at] == own[to]) & ((to - at) * LEAST_PERIODS <= n)
        found.append((at[keep], to[keep]))
    else:
        low = 1
        while low <= n // LEAST_PERIODS:
            high = min(n // LEAST_PERIODS + 1, low + max(1, GRID_PART * LEAST_PERIODS * low // n))
            at, to = _grid_part(low, high, n)
            keep = own[at] == own[to]
            found.append((at[keep], to[keep]))
            low = high
    at, to = (np.concatenate([f[i] for f in found]).astype(np.int64) + begin for i in (0, 1))
    return at, to


def runs(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in the documents that ``bounds`` cuts the symbols into.

    The last symbol of each document occurs only there. Ordered by start, then period.
    """
    pairs = [candidates(symbols, b, e - 1) for b, e in itertools.pairwise(bounds.tolist()) if e - b > LEAST_WORDS]
    at, to = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, np.int64) for i in (0, 1))
    if not len(at):
        return at, at, at
    grammar = Grammar(symbols)
    period = to - at
    start = at - grammar.extend(at, to, forward=False)
    length = to + grammar.extend(at, to, forward=True) - start
    keep = (length >= LEAST_PERIODS * period) & (length >= LEAST_WORDS)
    start, length, period = start[keep], length[keep], period[keep]
    # Of the periods of one stretch the smallest counts; its multiples extend to the same ends.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _documents(block: list[tuple]) -> pa.RecordBatch:
    """block: (doc_id, list of words)."""
    ids: dict = defaultdict(itertools.count().__next__)
    symbols: list[int] = []
    bounds = [0]
    for _, words in block:
        symbols.extend(map(ids.__getitem__, words))
        symbols.append(-len(bounds))  # occurs once
        bounds.append(len(symbols))
    bounds = np.array(bounds)
    start, length, period = runs(np.array(symbols, np.int64), bounds)
    cut = np.searchsorted(start, bounds)
    columns: list[list] = [[], [], [], []]
    for i, (doc, words) in enumerate(block):
        base, own = int(bounds[i]), slice(cut[i], cut[i + 1])
        found = list(zip((start[own] - base).tolist(), length[own].tolist(), period[own].tolist()))
        if found:
            kept = np.ones(len(words), bool)
            for s, n, q in found:
                kept[s + q : s + n] = False
            words = itertools.compress(words, kept.tolist())
        for column, value in zip(columns, (doc, int(bounds[i + 1]) - base - 1, found, b" ".join(words).decode())):
            column.append(value)
    arrays = [
        pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in c] if i == 2 else c, f.type)
        for i, (c, f) in enumerate(zip(columns, _ARROW))
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", altered=None) -> DataFrame:
    """Per row of ``docs`` (``SCHEMA``): its words, its runs, and the text without what runs repeat.

    Words are what blanks (space and U+0009 to U+000D) separate, compared byte by byte, numbered from
    0. A run is a stretch of at least 6 words and four times its smallest period that neither
    neighbour extends. ``collapsed`` keeps the first period of each run, words joined by one space.
    ``altered(doc_id, words)`` may return other words to look at. Null and empty texts have no word
    and no run; null ids stay null; repeated rows are looked at each; an empty table gives no rows.
    No shuffle. Memory of a task: a block of documents, or the longest single one, with its grammar.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()
                words = altered(doc, words) if altered else words
                if size and size + len(words) > BLOCK_WORDS:
                    yield _documents(block)
                    block, size = [], 0
                block.append((doc, words))
                size += len(words) + 1
        if block:
            yield _documents(block)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, SCHEMA)
