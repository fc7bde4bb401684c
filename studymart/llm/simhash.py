"""Near duplicates by SimHash with a generalised pigeonhole search.

The 64 bits are split into parts, correlated bits together. Two fingerprints that differ in at most
d bits must, in some part i, differ in at most t_i bits, if the t_i (-1 or more) add up to d - parts
+ 1. A dynamic program allots the t_i, and the number of parts, by estimated candidate counts.
Fingerprints meet in buckets of equal part values, one side probing all values within t_i, and are
verified on all bits.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studymart.llm.components import connected_components
from studymart.session import materialise

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
#: Rows of a bucket that one task compares at once; larger buckets are split into pairs of blocks.
BUCKET_ROWS = 16384
#: Buckets up to this size may give all their links, larger ones give a spanning forest.
SMALL_BUCKET = 48
#: Weight of a compared pair against a row that is shuffled.
PAIR_COST = 0.02

FINGERPRINT = "doc_id long, fp long"


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """Bits set in over half the XXH64 values of all n-word shingles, A-Z lower-cased; zero without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII blanks and letters only
    if not found:
        return 0
    runs = map(b" ".join, zip(*(found[i:] for i in range(n)))) if len(found) >= n else [b" ".join(found)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(r, SEED) for r in runs), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i : i + 4096].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t.as_py(), n) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], ["doc_id", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, FINGERPRINT)


def bit_counts(prints: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j set, for all i and j; 4,096 numbers whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((64, 64))
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint8)
            bits = np.unpackbits(values, bitorder="little").reshape(-1, 64).astype(np.float32)
            both += bits.T @ bits
        cell = pa.array(np.arange(4096, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([cell, pa.array(both.ravel().astype(np.int64))], ["cell", "n"])

    sums = prints.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(4096)
    for row in sums.collect():
        out[row["cell"]] = row["n"]
    return out.reshape(64, 64)


def group_bits(counts: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of like size; each group grows by the bit most correlated with it."""
    p = np.diag(counts) / total
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs(counts / total - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    left, groups = set(range(64)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        group = [max(sorted(left), key=lambda b: tie[b, sorted(left)].sum())]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(sorted(left), key=lambda b: tie[b, group].sum()))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def _within(chances: np.ndarray, most: int) -> list[float]:
    """Chance that at most 0, 1, ... ``most`` of independent bits differ."""
    exact = [1.0] + [0.0] * most
    for c in chances:
        exact = [exact[k] * (1 - c) + (exact[k - 1] * c if k else 0) for k in range(most + 1)]
    return list(itertools.accumulate(exact))


def allot(counts: np.ndarray, total: int, max_bits: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts that are probed: the cheapest allotment over numbers of parts."""
    total = max(total, 1)
    p = np.diag(counts) / total
    best: tuple[float, list] = (math.inf, [])
    for parts in range(1, max_bits + 2):
        groups = group_bits(counts, total, parts)
        # By the sum of thresholds so far, each counted from -1: cost and thresholds.
        table = {0: (0.0, [])}
        for bits in groups:
            near = _within((2 * p * (1 - p))[bits], max_bits)
            after: dict[int, tuple[float, list]] = {}
            for (s, (cost, chosen)), t in itertools.product(table.items(), range(-1, max_bits + 1)):
                probes = sum(math.comb(len(bits), d) for d in range(t + 1))
                if s + t + 1 > max_bits + 1 or probes > 5000:
                    continue
                more = (t >= 0) * (total * (probes + (t > 0)) + PAIR_COST * total**2 * near[max(t, 0)])
                if cost + more < after.get(s + t + 1, (math.inf,))[0]:
                    after[s + t + 1] = (cost + more, [*chosen, t])
            table = after
        # The thresholds add up to max_bits - parts + 1, that is to max_bits + 1 counted from -1.
        if max_bits + 1 in table and table[max_bits + 1][0] < best[0]:
            cost, chosen = table[max_bits + 1]
            best = cost, [(b, t) for b, t in zip(groups, chosen) if t >= 0]
    return best[1]


def _keys(prints: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, fp, role): role 0 only offers, 1 only asks, 2 does both."""
    masks, flips = [], []
    for bits, t in parts:
        masks.append(np.uint64(sum(1 << b for b in bits)))
        some = [sum(1 << b for b in c) for d in range(t + 1) for c in itertools.combinations(bits, d)]
        flips.append(np.array(some, np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.ascontiguousarray(batch.column(0).to_numpy())
            for start in range(0, len(whole), 2048):
                fp = whole[start : start + 2048]
                for i, (mask, flip) in enumerate(zip(masks, flips)):
                    value = fp.view(np.uint64) & mask
                    key, own, role = value, fp, np.full(len(fp), 2 if len(flip) == 1 else 0, np.int8)
                    if len(flip) > 1:
                        key = np.concatenate([value, (value[:, None] ^ flip).ravel()])
                        own = np.concatenate([fp, np.repeat(fp, len(flip))])
                        role = np.concatenate([role, np.ones(len(fp) * len(flip), np.int8)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), i, np.int32)), pa.array(key.view(np.int64)), pa.array(own), pa.array(role)],
                        ["part", "key", "fp", "role"],
                    )

    return prints.select("fp").mapInArrow(run, "part int, key long, fp long, role tinyint")


def _split_large(keys: DataFrame) -> DataFrame:
    """Adds the block pair (x, y) in which rows of a bucket meet.

    A bucket over BUCKET_ROWS is dealt into blocks by hash; each row goes to every pair with its block.
    """
    large = keys.groupBy("part", "key").count().filter(F.col("count") > BUCKET_ROWS)
    large = materialise(large.select("part", "key", F.ceil(F.col("count") / BUCKET_ROWS).alias("blocks")), "large_buckets")
    zero = F.lit(0)
    if large.isEmpty():
        return keys.withColumns({"x": zero, "y": zero})
    dealt = keys.join(large, ["part", "key"], "left").fillna(1, ["blocks"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    other = F.explode(F.sequence(zero, (F.col("blocks") - 1).cast("int"))).alias("other")
    pairs = dealt.select("part", "key", "fp", "role", "own", other)
    return pairs.select("part", "key", "fp", "role", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))


def _forest(fp: np.ndarray, asks: np.ndarray, offers: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Links that join all that is linked within one bucket, fewer than its rows; compared in blocks."""
    label, out = np.arange(len(fp)), []
    offered = np.flatnonzero(offers)
    for i in np.flatnonzero(asks):
        near = offered[np.bitwise_count(fp[offered] ^ fp[i]) <= max_bits]
        near = near[label[near] != label[i]]
        if len(near):
            olds, first = np.unique(label[near], return_index=True)
            out.append(np.stack([np.full(len(first), fp[i]), fp[near[first]]], 1))
            label[np.isin(label, olds)] = label[i]
    return out


def _bucket_links(fp: np.ndarray, role: np.ndarray, bucket: np.ndarray, max_bits: int) -> np.ndarray:
    """Links within sorted buckets; ``bucket`` numbers them. Returns rows of two fingerprints."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(bucket)])
    out = [np.zeros((0, 2), np.uint64)]
    small = np.repeat(sizes <= SMALL_BUCKET, sizes)
    at = np.flatnonzero(small & np.repeat(sizes > 1, sizes))
    end = np.repeat(starts + sizes, sizes)
    d = 0
    while len(at := at[at + (d := d + 1) < end[at]]):
        a, b = at, at + d
        meet = ((role[a] != 1) & (role[b] != 0)) | ((role[a] != 0) & (role[b] != 1))
        near = meet & (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits)
        out.append(np.stack([fp[a[near]], fp[b[near]]], 1))
    for s, n in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET]):
        rows = slice(s, s + n)
        out += _forest(fp[rows], role[rows] != 0, role[rows] != 1, max_bits)
    return np.concatenate(out)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints (fp) that connect whatever is connected.

    Every pair within ``max_bits`` is found; of a crowded bucket, links that span it are returned.
    """
    total = prints.count()
    parts = allot(bit_counts(prints), total, max_bits)
    dealt = _split_large(_keys(prints, parts))
    dealt = dealt.repartition("part", "key", "x", "y").sortWithinPartitions("part", "key", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: np.ndarray) -> pa.RecordBatch:
            bucket = np.cumsum(np.r_[False, (rows[1:, :4] != rows[:-1, :4]).any(1)])
            pairs = _bucket_links(rows[:, 4].copy().view(np.uint64), rows[:, 5], bucket, max_bits)
            pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        rest = np.zeros((0, 6), np.int64)
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
            rows = np.concatenate([rest, rows])
            if not len(rows):
                continue
            last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(1))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield found(rows[:cut])
            rest = rows[cut:]
        if len(rest):
            yield found(rest)

    return dealt.select("part", "key", "x", "y", "fp", "role").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id it is linked to.

    Equal fingerprints, and such that differ in at most ``max_bits`` bits, are linked, directly or
    over others. Null and empty texts have fingerprint zero and are linked like any other. Null ids
    don't count for the smallest unless there is no other; repeated rows have a row each. An empty
    table gives no rows. Documents of one fingerprint are folded before anything is compared.
    """
    marked = materialise(fingerprints(docs, id_col, text_col, n), "fingerprints")
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct_fingerprints")
    roots = materialise(connected_components(links(distinct.select("fp"), max_bits)), "fingerprint_roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(firsts, "root").select(F.col("fp").alias("mark"), "component_id")
    return marked.join(named, marked["fp"] == named["mark"]).select("doc_id", "fp", "component_id")


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each group, that with the smallest id; rows that repeat an id stay or go together."""
    kept = near_duplicates(docs, id_col=id_col, **options)
    kept = kept.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    kept = materialise(kept, "kept_documents")
    return docs.join(kept, docs[id_col].eqNullSafe(kept["kept_id"]), "left_semi")
