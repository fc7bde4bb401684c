"""Spelling variants by Bloom-guided neighbourhoods.

Words one edit apart are found from one side: a word generates its deletions and those replacements
that put a later character in place. Each generated edit is probed against blocked Bloom filters of
the vocabulary, one for each length of words; only positives become strings and are shuffled to an
exact join with the vocabulary, which removes the false ones. The filters that are broadcast
together have a fixed size: where all don't fit, they are probed in several passes, each over the
lengths and blocks whose filters it holds.
"""

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studymart.session import materialise

#: Words of a vocabulary: least code points and least occurrences.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent.
RATIO = 2
#: Bytes of filters that one pass broadcasts.
FILTER_BYTES = 32 << 20
#: Words that one block of a filter is meant for; a block has eight lanes of 32 bits.
BLOCK_WORDS, LANES = 20, 8
#: Different words that a task counts before it hands the counts on, and edits it probes at once.
COUNTED_WORDS, PROBED = 400_000, 1 << 18

#: What belongs to a word: letters of ASCII and U+00C0 to U+00FF.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)
#: Words are hashed as polynomials, so that the hash of an edit follows from sums over the word.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def text_words(text: str) -> list[bytes]:
    """The maximal runs of letters in Latin-1, A-Z in lower case."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def planted_variants(doc: int | None, words: Counter) -> Counter:
    """The words with one code point deleted where 97 divides the CRC-32 of ``<doc>:<word>``."""
    start = zlib.crc32(b"%s:" % ("" if doc is None else str(doc)).encode())
    out: Counter = Counter()
    for word, n in words.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % 97 == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", altered=None) -> DataFrame:
    """(word, n): occurrences of every word over all texts, counted in each task before the shuffle.

    ``altered(doc_id, counts of words)`` may return other counts for a document. Words are Latin-1
    bytes there; words that it empties don't count. Null and empty texts have no words.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            words = [w.decode("latin-1") for w in counts]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)
            counts.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = text_words(text.as_py() or "")
                counts.update(altered(doc, Counter(own)) if altered else own)
                if len(counts) >= COUNTED_WORDS:
                    yield flush()
        if counts:
            yield flush()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = chosen.mapInArrow(run, "word string, n long").filter("word <> ''")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# --- Hashes of words and of their edits ------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _characters(codes: np.ndarray) -> np.ndarray:
    return _mixed(codes.astype(np.uint64) + np.uint64(1))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]))


def code_points(words: list[str], length: int) -> np.ndarray:
    """A row of code points for each of the words, all of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def hashes(codes: np.ndarray) -> np.ndarray:
    """Raw hashes of words given as rows of code points."""
    return (_characters(codes) * _powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def place(raw: np.ndarray, blocks: int) -> tuple[np.ndarray, Callable]:
    """The block of each raw hash in a filter of so many, and the 5-bit place of some of them in a lane."""
    h = _mixed(raw)
    low = _mixed(h)

    def spots(some: np.ndarray | slice, lane: int) -> np.ndarray:
        return ((low[some] >> np.uint64(5 * lane)) & np.uint64(31)).astype(np.uint32)

    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), spots


def n_blocks(words: int) -> int:
    return max(1, -(-words // BLOCK_WORDS))


def filter_blocks(vocabulary: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """(length, block, lane0 .. lane7) of the filters of a vocabulary (word, length)."""
    lanes = [f"lane{i}" for i in range(LANES)]
    schema = "length int, block long, " + ", ".join(f"{x} long" for x in lanes)
    arrow = pa.schema([("length", pa.int32()), ("block", pa.int64()), *((x, pa.int64()) for x in lanes)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, lengths = batch.column(0).to_pylist(), np.array(batch.column(1))
            for n in np.unique(lengths).tolist():
                codes = code_points([words[i] for i in np.flatnonzero(lengths == n)], n)
                block, spots = place(hashes(codes), blocks[n])
                bits = [(np.uint32(1) << spots(slice(None), lane)).astype(np.int64) for lane in range(LANES)]
                columns = [np.full(len(block), n, np.int32), block, *bits]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

    rows = vocabulary.select("word", "length").mapInArrow(run, schema)
    return rows.groupBy("length", "block").agg(*(F.bit_or(x).alias(x) for x in lanes))


def passes(blocks: dict[int, int], most_bytes: int) -> list[dict[int, tuple[int, int]]]:
    """The filters dealt into passes of bounded size: by length, the first block and the one after the last."""
    most, room, out = max(1, most_bytes // (4 * LANES)), 0, []
    for length, n in sorted(blocks.items()):
        first = 0
        while first < n:
            if not room:
                out.append({})
                room = most
            last = min(n, first + room)
            out[-1][length] = (first, last)
            room, first = room - (last - first), last
    return out


# --- Edits -----------------------------------------------------------------------


def _hits(raw: np.ndarray, part: np.ndarray, blocks: int, bounds: tuple[int, int]) -> np.ndarray:
    """Which of the raw hashes a part of a filter holds."""
    block, spots = place(raw, blocks)
    kept = np.flatnonzero((block >= bounds[0]) & (block < bounds[1]))
    for lane in range(LANES):
        bits = part[block[kept] - bounds[0], lane] >> spots(kept, lane)
        kept = kept[(bits & np.uint32(1)).astype(bool)]
    return kept


def edits(words: list[str], alphabet: np.ndarray, filters: dict, blocks: dict[int, int], bounds: dict) -> Iterator[tuple]:
    """(index of the word, edit) for those deletions and later replacements of words that the filters hold.

    The words are all of one length.
    """
    length = len(words[0])
    codes = code_points(words, length)
    terms = _characters(codes) * _powers(length)[:-1]
    total = terms.sum(axis=1, dtype=np.uint64)
    if length - 1 in filters:
        # without position i: what is before it, and what is after it a power lower
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        raw = before + (total[:, None] - before - terms) * _INVERSE
        # of equal neighbours only the first is deleted, else an edit is found twice
        new = np.ones(codes.shape, bool)
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]
        rows, at = np.nonzero(new)
        for i in _hits(raw[rows, at], filters[length - 1], blocks[length - 1], bounds[length - 1]).tolist():
            word, k = words[rows[i]], int(at[i])
            yield int(rows[i]), word[:k] + word[k + 1 :]
    if length in filters:
        powers = _powers(length)[:-1]
        letters, spelled = _characters(alphabet), [chr(c) for c in alphabet.tolist()]
        for k in range(length):
            later = np.searchsorted(alphabet, codes[:, k], side="right")
            counts = len(alphabet) - later
            rows = np.repeat(np.arange(len(words)), counts)
            letter = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(later, counts)
            raw = (total - terms[:, k])[rows] + letters[letter] * powers[k]
            for i in _hits(raw, filters[length], blocks[length], bounds[length]).tolist():
                word = words[rows[i]]
                yield int(rows[i]), word[:k] + spelled[letter[i]] + word[k + 1 :]


def _load(stored: DataFrame, bounds: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
    """The filters of one pass; their size is bounded by ``passes``."""
    wanted = F.lit(False)
    for length, (first, last) in bounds.items():
        wanted = wanted | ((F.col("length") == length) & F.col("block").between(first, last - 1))
    filters = {n: np.zeros((last - first, LANES), np.uint32) for n, (first, last) in bounds.items()}
    for batch in stored.filter(wanted).toArrow().to_batches():
        lengths, block = np.array(batch.column("length")), np.array(batch.column("block"))
        lanes = np.stack([np.array(batch.column(f"lane{i}")) for i in range(LANES)], axis=1).astype(np.uint32)
        for n in np.unique(lengths).tolist():
            own = lengths == n
            filters[n][block[own] - bounds[n][0]] = lanes[own]
    return filters


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, n_near_word): words of a vocabulary (word, n, length), one edit apart, once a pair.

    The vocabulary should be stored: it is read several times. Its alphabet goes to every task; it
    can't be larger than the letters that words are made of.
    """
    spark = vocabulary.sparkSession
    blocks = {r["length"]: n_blocks(r["n_words"]) for r in vocabulary.groupBy("length").agg(F.count("*").alias("n_words")).collect()}
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("c")).distinct().collect()
    alphabet = np.array(sorted(ord(r.c) for r in letters if r.c), np.uint32)
    stored = materialise(filter_blocks(vocabulary, blocks), "spelling_filters")
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("edit", pa.string())])
    found = spark.createDataFrame([], "word string, n long, edit string")
    for number, bounds in enumerate(passes(blocks, filter_bytes)):
        shared = spark.sparkContext.broadcast(_load(stored, bounds))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, bounds=bounds) -> Iterator[pa.RecordBatch]:
            filters = shared.value
            for batch in batches:
                words, counts, lengths = batch.column(0).to_pylist(), np.array(batch.column(1)), np.array(batch.column(2))
                for length in np.unique(lengths).tolist():
                    own = np.flatnonzero(lengths == length)
                    step = max(1, PROBED // max(length, len(alphabet)))
                    for i in range(0, len(own), step):
                        some = own[i : i + step]
                        pairs = list(edits([words[k] for k in some], alphabet, filters, blocks, bounds))
                        rows = some[[k for k, _ in pairs]] if pairs else some[:0]
                        columns = [words[k] for k in rows], counts[rows], [edit for _, edit in pairs]
                        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
                        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        probing = vocabulary.filter(F.col("length").isin([*bounds, *(length + 1 for length in bounds)]))
        positives = probing.select("word", "n", "length").mapInArrow(run, found.schema)
        found = found.unionByName(materialise(positives, f"spelling_positives_{number}"))
        shared.destroy()
    exact = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.withColumnRenamed("edit", "near").join(exact, "near").select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) rows, a step of all open chains a round.

    Counts at least double along a chain, so there are no more rounds than a count has bits. Words
    whose chain has ended leave.
    """
    forms = materialise(forms, "spelling_forms")
    steps = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    open_, out = forms.select("word", F.col("form").alias("root")), None
    while True:
        moved = materialise(open_.join(steps, "root", "left").select("word", "root", "next"), "spelling_steps")
        ended = moved.filter("next IS NULL").select("word", "root")
        out = ended if out is None else out.unionByName(ended)
        open_ = moved.filter("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if open_.isEmpty():
            return out


def variants(
    counts: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for the words of (word, n) that are long and frequent enough.

    Two words are near if exactly one inserted, deleted or replaced code point makes one the other.
    The form of a word is its most frequent near word (ties: the smallest in code-point order) if
    that has at least ``ratio`` (2 or more) times its count, else null; the root is where following forms ends, the word
    itself if it has none. Null and short words don't count; words must not repeat; an empty table
    gives no rows. ``filter_bytes`` bounds what is broadcast at a time.
    """
    if ratio < 2:
        raise ValueError("forms may go in circles")
    words = counts.select("word", F.col("n").cast("long").alias("n"), F.length("word").alias("length"))
    words = materialise(words.filter((F.col("length") >= least_length) & (F.col("n") >= least_count)), "spelling_words")
    pairs = materialise(near_pairs(words, filter_bytes), "spelling_pairs")
    turned = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = pairs.unionByName(turned).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    near = materialise(
        near.select(
            "word",
            "n_near",
            F.when(is_form, F.col("best.form")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "spelling_near",
    )
    roots = _roots(near.filter("form IS NOT NULL").select("word", "form"))
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
