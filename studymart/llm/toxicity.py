"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled texts: one of the words of ordinary documents,
and one that also has words that recur in toxic documents and are much rarer in ordinary ones, by
more than chance allows; documents that are near copies of each other count once for that. A window, one word between its blanks, is compressed with both. What the toxic dictionary saves is its
distance, and figures of a document's distances are turned into a chance by a logistic model that
was calibrated on labelled documents that the dictionaries haven't seen.

Dictionaries are of raw content: the trainer that comes with the codec picks long segments and
loses words of five letters. A window stands between two strings that both dictionaries hold, since
the codec leaves short inputs, and their last bytes, uncompressed.
"""

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studymart.session import materialise

#: Labelled documents that are learned from, the first by a hash of the id.
SAMPLE_ROWS = 20_000
#: Bytes of the ordinary dictionary's words, and of the toxic words added to it.
ORDINARY_BYTES, TOXIC_BYTES = 1 << 17, 1 << 16
#: A toxic word is so many times likelier in toxic documents than in ordinary ones, and the
#: log-likelihood ratio of its counts is at least that of a one-sided chance of 1 in 10,000.
LEAST_RATIO, LEAST_EVIDENCE = 4.0, 13.83
LEVEL = 13
#: Texts scoring as much are predicted toxic.
THRESHOLD = 0.3
CACHED_WORDS, CACHED_LENGTH = 400_000, 48

_WORD = re.compile(r"[^\W\d_]+")
_HEAD, _TAIL = b"0123456789" * 7, b"~" * 12
FEATURES = 7
#: Words of a shingle, and the odd factors of the hashes whose smallest values tell near copies.
SHINGLE = 3
_FACTORS = np.random.default_rng(1).integers(0, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def signature(found: list[str]) -> np.ndarray:
    """Smallest hashes of the shingles of a text, one for each factor: near copies have most in common."""
    starts = range(max(1, len(found) - SHINGLE + 1))
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(found[i : i + SHINGLE])) for i in starts], np.uint64)
    mixed = hashes[:, None] * _FACTORS
    return ((mixed ^ mixed >> np.uint64(32)) * _FACTORS).min(0).view(np.int64)


def evidence(toxic: Column, ordinary: Column, n_toxic: int, n_ordinary: int) -> Column:
    """Log-likelihood ratio of a word's document counts against equal rates on both sides."""
    found, n = toxic + ordinary, n_toxic + n_ordinary
    cells = [
        (toxic, found * n_toxic / n),
        (ordinary, found * n_ordinary / n),
        (n_toxic - toxic, (n - found) * n_toxic / n),
        (n_ordinary - ordinary, (n - found) * n_ordinary / n),
    ]
    return 2 * sum(F.when(x > 0, x * F.log(x / expected)).otherwise(0.0) for x, expected in cells)


def _content(counts: Counter, most: int) -> bytes:
    """Words by falling count, as many as fit; the commonest last, where they are cheapest to refer to."""
    chosen, size = [], 1
    for word, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        data = word.encode()
        if size + len(data) + 1 > most:
            break
        chosen.append(data)
        size += len(data) + 1
    return b" " + b" ".join(reversed(chosen)) + b" "


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def chance(self, x: np.ndarray) -> np.ndarray:
        odds = self.weights[0] + (x - self.mean) / self.scale @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


class Distances(dict):
    """Words to the bytes that the toxic dictionary saves on them."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.with_ordinary, self.with_toxic = (
            self._compressor(x + _HEAD + _TAIL) for x in (ordinary, ordinary + toxic)
        )

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def __missing__(self, word: str) -> int:
        window = _HEAD + b" " + word.encode("utf-8", "surrogatepass") + b" " + _TAIL
        saved = len(self.with_ordinary.compress(window)) - len(self.with_toxic.compress(window))
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = saved
        return saved


@functools.lru_cache(maxsize=2)
def distances(ordinary: bytes, toxic: bytes) -> Distances:
    return Distances(ordinary, toxic)


def figures(saved: np.ndarray) -> list[float]:
    """How often windows are clearly nearer to the toxic texts, in number and in share, and by how much."""
    counts = [float((saved >= t).sum()) for t in (2, 3, 5)]
    total = len(saved) + 20.0
    gain = float(np.maximum(saved, 0).sum())
    return [*np.log1p(counts), gain / total, counts[1] / total, counts[2] / total, float(saved.max(initial=0))]


def _saved(text: str | None, known: Distances) -> np.ndarray:
    return np.array([known[w] for w in words(text)], np.int64)


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(y):
        return np.zeros(FEATURES), np.ones(FEATURES), np.r_[-3.0, np.zeros(FEATURES)]
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z, weights = np.c_[np.ones(len(y)), (x - mean) / scale], np.zeros(FEATURES + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        weights = weights - np.linalg.solve(
            (z * (p * (1 - p))[:, None]).T @ z + np.eye(FEATURES + 1), z.T @ (p - y) + weights
        )
    return mean, scale, weights


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: Column | None = None) -> Model:
    """Dictionaries from the labelled documents of parts 0 and 1, calibration on all other parts but 2.

    ``part`` gives a label row's part, by default the CRC-32 of its id as text, modulo 4. Part 2 is
    held out. A bounded sample of the labelled documents is read; only its distinct words and
    figures reach the driver. A word that only near copies of one text hold isn't learned. Labels of an id that contradict each other count as toxic.
    """
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 if part is None else part
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.select(F.col("doc_id").alias("labelled"), part.cast("int").alias("part"), F.col("toxic").cast("int").alias("y"))
    known = known.filter(F.col("part") != 2).groupBy("labelled", "part").agg(F.max("y").alias("y"))
    known = materialise(known.orderBy(F.xxhash64("labelled"), "labelled").limit(SAMPLE_ROWS), "toxic_labels")
    texts = docs.select(F.col(id_col).alias("labelled"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(known), "labelled").dropDuplicates(["labelled"])
    found = materialise(found.select("part", "y", "text"), "toxic_sample")

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[int(y > 0)].update(set(words(text.as_py())))
            rows = [(y, w, n) for y, counts in seen.items() for w, n in counts.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 3, (pa.int32(), pa.string(), pa.int64()))],
                ["y", "word", "n"],
            )

    base = found.filter(F.col("part") < 2)
    sizes = {r["y"]: r["n"] for r in base.groupBy("y").agg(F.count("*").alias("n")).collect()}
    counted = base.select("y", "text").mapInArrow(used, "y int, word string, n long").groupBy("word").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("ordinary"),
    )
    counted = materialise(counted, "toxic_words")
    n_toxic, n_ordinary = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    # The commonest words alone can enter the dictionaries, so no more are fetched.
    plain = counted.filter("ordinary > 0").orderBy(F.desc("ordinary"), "word").limit(ORDINARY_BYTES // 2).collect()
    rate = F.col("toxic") / n_toxic > LEAST_RATIO * F.col("ordinary") / n_ordinary
    sure = rate & (evidence(F.col("toxic"), F.col("ordinary"), n_toxic, n_ordinary) >= LEAST_EVIDENCE)
    likely = counted.filter(sure)
    candidates = frozenset(r["word"] for r in likely.select("word").collect())

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0):
                found = words(text.as_py())
                if held := candidates.intersection(found):
                    own = signature(found)
                    rows += [(w, own) for w in held]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.list_(pa.int64()))],
                ["word", "signature"],
            )

    # A word's toxic documents once more, near copies as one: the fewest values that any hash takes in them.
    holders = base.filter("y = 1").select("text").mapInArrow(signed, "word string, signature array<long>")
    values = [F.size(F.collect_set(F.get("signature", F.lit(i)))) for i in range(len(_FACTORS))]
    apart = holders.groupBy("word").agg(F.least(*values).cast("long").alias("toxic"))
    marked = apart.join(likely.select("word", "ordinary"), "word").filter(sure)
    marked = marked.orderBy(F.desc("toxic"), "word").limit(TOXIC_BYTES // 2).collect()
    ordinary = _content(Counter({r["word"]: r["ordinary"] for r in plain}), ORDINARY_BYTES)
    toxic = _content(Counter({r["word"]: r["toxic"] for r in marked}), TOXIC_BYTES)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = distances(ordinary, toxic)
        for batch in batches:
            x = [figures(_saved(t.as_py(), near)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    rows = found.filter(F.col("part") > 2).select("y", "text").mapInArrow(measured, "y int, x array<double>")
    rows = sorted((tuple(r["x"]), r["y"]) for r in rows.collect())
    return Model(ordinary, toxic, *_calibrate(np.array([x for x, _ in rows]), np.array([y for _, y in rows], float)))


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, n_windows, n_near) of every row, from its whole text alone.

    Null and empty texts have no window; their score is the model's for that. Null ids stay null,
    repeated rows are scored each, an empty table gives no rows. Without labels all scores are even.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = distances(model.ordinary, model.toxic)
        for batch in batches:
            saved = [_saved(t.as_py(), near) for t in batch.column(1)]
            score = model.chance(np.array([figures(s) for s in saved]).reshape(-1, FEATURES))
            columns = [
                (score, pa.float64()),
                ((score >= threshold).astype(int), pa.int32()),
                ([len(s) for s in saved], pa.int64()),
                ([int((s >= 3).sum()) for s in saved], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in columns)],
                ["doc_id", "score", "predicted", "n_windows", "n_near"],
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, score double, predicted int, n_windows long, n_near long")
