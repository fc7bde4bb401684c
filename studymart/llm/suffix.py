"""Repeated byte strings across documents, found by merging Burrows-Wheeler transforms.

Strings of WINDOW bytes are dealt out by content: each belongs to the anchor, the smallest hash of
the short strings within it, so equal ones meet. Consecutive strings of one anchor form a segment.
Anchors that occur once are dropped before any text moves, and equal segments are folded into their
first place. What is left, different segments of one anchor, is compared in buckets of bounded size:
pieces that may share a window stay, the bucket's shards are turned into Burrows-Wheeler transforms, and these are merged by refining
their interleave character by character. Rows that stay in one block down to WINDOW characters are
equal strings; a block's first place is kept.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studymart.session import materialise

WINDOW = 100
#: Length of the strings among which anchors are chosen.
ANCHOR = 24
#: Windows that are hashed at once; bounds memory in long documents.
CHUNK = 1 << 20
#: Characters that are sorted at once to begin with; 9 bits each.
PACKED = 7
#: Bytes of a bucket and of a shard within it.
BUCKET_BYTES, SHARD_BYTES = 1 << 20, 1 << 18
#: An anchor with more different segments is dealt out by both its sides, and a group of more pieces
#: than LARGE_GROUP by single windows.
CROWDED, LARGE_GROUP = 200, 10_000
#: Distinct windows of large groups that a task folds before it passes them on.
FOLDED_WINDOWS = 100_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _byte_codes() -> np.ndarray:
    """A random number a byte, by a fixed rule."""
    with np.errstate(over="ignore"):
        x = np.arange(1, 257, dtype=np.uint64) * _ODD
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


_CODES = _byte_codes()


def _hashes(x: np.ndarray, length: int) -> np.ndarray:
    """A hash of every substring of ``length`` bytes, by doubling."""
    h, n, done, done_n = _CODES[x], 1, None, 0
    power = _ODD
    with np.errstate(over="ignore"):
        while True:
            if length & n:
                if done is None:
                    done, done_n = h, n
                else:  # the longer part first, then what was gathered
                    size = len(h) - done_n if len(h) - done_n < len(done) - n else len(done) - n
                    done = h[:size] * _power(done_n) + done[n : n + size]
                    done_n += n
            if done_n == length:
                break
            h = h[:-n] * power + h[n:]
            power, n = power * power, n * 2
        done = (done ^ (done >> np.uint64(32))) * _ODD
        return done ^ (done >> np.uint64(29))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_ODD), n, 1 << 64))


def segments(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, anchor hash, anchor's offset) of the segments of a text.

    Together they have all its windows.
    """
    starts, sizes, anchors, offsets = [], [], [], []
    total, span = len(data) - WINDOW + 1, WINDOW - ANCHOR + 1
    for base in range(0, max(total, 0), CHUNK):
        count = min(CHUNK, total - base)
        h = _hashes(np.frombuffer(data, np.uint8, count + WINDOW - 1, base), ANCHOR)
        # Smallest upper half first, then the leftmost: the choice depends on the window's bytes only.
        low = h & ~np.uint64(0xFFFFFFFF) | np.arange(len(h), dtype=np.uint64)
        n = 1
        while 2 * n <= span:
            low = np.minimum(low[:-n], low[n:])
            n *= 2
        low = np.minimum(low[: len(low) - (span - n)], low[span - n :]) if span > n else low
        at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)[:count]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        starts.append(base + first)
        sizes.append(np.diff(np.r_[first, count]))
        anchors.append(h[at[first]].view(np.int64))
        offsets.append(at[first] - first)
    if not starts:
        return (np.zeros(0, np.int64),) * 4
    return tuple(map(np.concatenate, (starts, sizes, anchors, offsets)))


_PLACE = "doc long, copy int"


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, rest, doc, copy, data): doc orders the ids, nulls first; copy tells rows of one id apart.

    ``rest`` holds the columns that aren't the text.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("rest"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"),
    )
    again = rows.groupBy("doc").count().filter("count > 1").select(F.col("doc").alias("again"))
    again = materialise(again, "repeated_ids")
    if again.isEmpty():
        return rows.withColumn("copy", F.lit(0))
    order = Window.partitionBy("doc").orderBy("data")
    one = rows.join(again, rows["doc"] == again["again"], "left_anti").withColumn("copy", F.lit(0))
    more = rows.join(again, rows["doc"] == again["again"], "left_semi")
    return materialise(one.unionByName(more.withColumn("copy", F.row_number().over(order) - 1)), "numbered_documents")


def _batch(columns: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _all_segments(rows: DataFrame, anchors_only: bool) -> DataFrame:
    """(anchor) or (anchor, seg, doc, copy, start, n, at) of all documents; seg hashes the segment's bytes."""
    digest = xxhash.xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, have = [], 0
            for doc, copy, data in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)):
                data = data.as_py()
                start, n, anchor, at = segments(data)
                if anchors_only:
                    out.append((anchor,))
                else:
                    ends = (start + n + (WINDOW - 1)).tolist()
                    seg = np.fromiter((digest(data[a:b]) for a, b in zip(start.tolist(), ends)), np.uint64, len(start))
                    out.append((anchor, seg.view(np.int64), np.full(len(start), doc), np.full(len(start), copy, np.int32), start, n, at))
                have += len(start)
                if have > 100_000:
                    yield flush(out)
                    out, have = [], 0
            if out:
                yield flush(out)

    def flush(out: list) -> pa.RecordBatch:
        names = ["anchor", "seg", "doc", "copy", "start", "n", "at"]
        columns = [np.concatenate(c) for c in zip(*out)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int16(), pa.int16()]
        return _batch(columns, names[: len(columns)], kinds)

    kinds = "anchor long" if anchors_only else "anchor long, seg long, doc long, copy int, start long, n smallint, at smallint"
    return rows.select("doc", "copy", "data").mapInArrow(run, kinds)


_PIECE = "group long, data binary, doc long, copy int, start long, n int, at int"
_NAMES = ["group", "data", "doc", "copy", "start", "n", "at"]
_KINDS = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
#: A window holds its anchor and, on one side of it, at least so many of its other bytes.
HALF = -(-(WINDOW - ANCHOR) // 2)


def _sides(data: bytes, at: int) -> tuple[bytes | None, bytes | None]:
    """The anchor with what lies on its left, and on its right, as far as a shared window must reach."""
    return (
        data[at - HALF : at + ANCHOR] if at >= HALF else None,
        data[at : at + ANCHOR + HALF] if len(data) >= at + ANCHOR + HALF else None,
    )


def _hash(data: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(data, seed) - (1 << 63)


def _pieces(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted segments, each with the group in which it may meet equal windows.

    That is the anchor's, or, for a crowded anchor, those of the anchor with its left and its right.
    """
    mine = wanted.groupBy(F.col("doc").alias("d"), F.col("copy").alias("c")).agg(
        F.collect_list(F.struct("start", "n", "at", "anchor", "crowded")).alias("list")
    )
    held = rows.join(mine, (rows["doc"] == mine["d"]) & (rows["copy"] == mine["c"])).select("doc", "copy", "data", "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, copy, data, found in zip(*(c.to_pylist() for c in batch.columns)):
                out = []
                for s in found:
                    start, n, at = s["start"], s["n"], s["at"]
                    piece = data[start : start + n + WINDOW - 1]
                    groups = [s["anchor"]]
                    if s["crowded"]:
                        groups = [_hash(side, i) for i, side in enumerate(_sides(piece, at)) if side is not None]
                    out += [(g, piece, doc, copy, start, n, at) for g in groups]
                if out:
                    yield _batch(list(zip(*out)), _NAMES, _KINDS)

    return held.mapInArrow(run, _PIECE)


def _by_window(pieces: DataFrame) -> DataFrame:
    """Pieces cut into single windows, each in a group of its own bytes; for groups that are too large.

    Equal windows are folded in the task. A window whose earlier place the task knows has no group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded: dict[bytes, tuple] = {}

        def passed_on() -> pa.RecordBatch:
            out = [(_hash(w, 2), w, *place, 1, -1) for w, place in folded.items()]
            folded.clear()
            return _batch(list(zip(*out)), _NAMES, _KINDS)

        for batch in batches:
            for _, data, doc, copy, start, n, _ in zip(*(c.to_pylist() for c in batch.columns)):
                out = []
                for i in range(n):
                    window, place = data[i : i + WINDOW], (doc, copy, start + i)
                    known = folded.get(window)
                    if known is None or place < known:
                        folded[window] = place
                        place = known
                    if place is not None and place != folded[window]:
                        out.append((None, None, *place, 1, -1))
                if out:
                    yield _batch(list(zip(*out)), _NAMES, _KINDS)
                if len(folded) >= FOLDED_WINDOWS:
                    yield passed_on()
        if folded:
            yield passed_on()

    return pieces.mapInArrow(run, _PIECE)


def transform(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rotations of the strings of one shard: (row to position, position to row).

    ``text`` holds the strings, each ended by 0; a string follows itself. By doubling, until rows
    differ or agree on more than WINDOW characters, which the merge doesn't look beyond.
    """
    ahead = _rotated(ends, len(text))
    rank, jump = text.astype(np.int64), ahead
    for _ in range(PACKED - 1):  # several characters in one number to begin with
        rank = rank << 9 | text[jump]
        jump = ahead[jump]
    depth, classes, enough = PACKED, 0, min(WINDOW, int(np.diff(np.r_[-1, ends]).max()))
    while True:
        order = np.argsort(rank, kind="stable")
        step = np.r_[0, np.cumsum(rank[order][1:] != rank[order][:-1])]
        if step[-1] + 1 in (len(text), classes) or depth >= enough:
            break
        classes, number = int(step[-1]) + 1, np.empty_like(rank)
        number[order] = step
        rank = number * classes + number[jump]
        jump, depth = jump[jump], depth * 2
    back = np.empty(len(text), np.int64)
    back[order] = np.arange(len(text))
    return order, back


def _rotated(ends: np.ndarray, size: int) -> np.ndarray:
    """The position after each, within its string."""
    ahead = np.arange(1, size + 1)
    ahead[ends] = np.r_[0, ends[:-1] + 1]
    return ahead


def merged_blocks(shards: list[tuple[np.ndarray, np.ndarray]], depth: int) -> np.ndarray:
    """For each position of the shards' texts, in order, the block of its first ``depth`` characters.

    The rows of all shards' transforms start side by side. One round moves each row, in the order of
    the interleave so far, behind the rows of its preceding character (a stable deal by the transform's
    character, then the step back in the text): thereby the interleave is right for one character
    more. A block ends where the characters differ or where the blocks one character shorter did, so
    common prefixes come with the rounds. Rows that are alone in their block leave the work: what
    precedes them is alone one round later.
    """
    last, back_row, position, base = [], [], [], 0
    for text, ends in shards:
        order, row = transform(text, ends)
        before = np.arange(-1, len(text) - 1)
        before[np.r_[0, ends[:-1] + 1]] = ends
        last.append(text[before[order]])
        back_row.append(base + row[before[order]])
        position.append(base + order)
        base += len(text)
    last, back_row, position = map(np.concatenate, (last, back_row, position))
    codes = np.unique(last, return_inverse=True)[1].astype(np.uint8 if len(np.unique(last)) <= 256 else np.uint16)
    back_row = back_row.astype(np.int32)
    # Rows that share their block; a row alone in its block is settled, as are those before it.
    interleave, block = np.arange(base, dtype=np.int32), np.zeros(base, np.int32)
    for _ in range(depth):
        dealt = codes[interleave]
        order = np.argsort(dealt, kind="stable")
        came, char = interleave[order], dealt[order]
        shorter = block[came]
        new = np.r_[True, (char[1:] != char[:-1]) | (shorter[1:] != shorter[:-1])]
        shared = ~(new & np.r_[new[1:], True])
        interleave = back_row[came[shared]]
        if not len(interleave):
            break
        block[interleave] = np.cumsum(new[shared], dtype=np.int32) - 1
    alone = np.ones(base, bool)
    alone[interleave] = False
    block[alone] = base + np.flatnonzero(alone)
    out = np.empty(base, np.int32)
    out[position] = block
    return out


_RUN = pa.schema([("doc", pa.int64()), ("copy", pa.int32()), ("start", pa.int64()), ("n", pa.int32())])


def _promising(data: list[bytes], at: list[int]) -> np.ndarray:
    """Pieces that may share a window with another: those that share one side of the anchor.

    Pieces without an anchor (at: -1) are single windows; they share all or nothing.
    """
    sides = [_sides(d, a) if a >= 0 else (d, None) for d, a in zip(data, at)]
    seen = [Counter(s[i] for s in sides if s[i] is not None) for i in (0, 1)]
    return np.array([seen[0][x] > 1 or seen[1][y] > 1 for x, y in sides], bool)


def _repeats(pieces: pa.Table) -> pa.Table:
    """Runs of windows (doc, copy, start, n) of one bucket that start at an earlier place as well."""
    chosen = _promising(pieces["data"].to_pylist(), pieces["at"].to_pylist())
    pieces = pieces.filter(pa.array(chosen))
    if not pieces.num_rows:
        return pa.table({"doc": [], "copy": [], "start": [], "n": []}, _RUN)
    data = pieces["data"].combine_chunks()
    flat = np.frombuffer(b"\0".join(data.to_pylist()) + b"\0", np.uint8)
    sizes = np.array([len(d.as_py()) for d in data], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    text = flat.astype(np.uint16) + 1
    text[ends] = 0
    shard = np.cumsum(sizes) // SHARD_BYTES
    cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
    shards = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo = ends[a - 1] + 1 if a else 0
        shards.append((text[lo : ends[b - 1] + 1], ends[a:b] - lo))
    block = merged_blocks(shards, WINDOW)
    n, start = pieces["n"].to_numpy().astype(np.int64), pieces["start"].to_numpy()
    piece = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    group = block[(ends - sizes)[piece] + inside]
    doc, copy = pieces["doc"].to_numpy()[piece], pieces["copy"].to_numpy()[piece]
    place = start[piece] + inside
    order = np.lexsort((place, copy, doc))
    moved = (doc[order][1:] != doc[order][:-1]) | (copy[order][1:] != copy[order][:-1]) | (place[order][1:] != place[order][:-1])
    number = np.empty(len(order), np.int64)  # of the place: a piece can be here for each side of its anchor
    number[order] = np.r_[0, np.cumsum(moved)]
    earliest = np.full(int(block.max()) + 1, len(order))
    np.minimum.at(earliest, group, number)
    later = number > earliest[group]
    # Runs of later windows within a piece.
    hit = np.flatnonzero(later)
    new = np.r_[True, (np.diff(hit) != 1) | (piece[hit][1:] != piece[hit][:-1])] if len(hit) else np.zeros(0, bool)
    first = hit[new]
    length = np.diff(np.r_[np.flatnonzero(new), len(hit)])
    return pa.table(
        {"doc": doc[first], "copy": copy[first].astype(np.int32), "start": place[first], "n": length.astype(np.int32)}, _RUN
    )


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(doc, copy, start, n): runs of windows that occur at an earlier place too."""
    twice = _all_segments(rows, True).groupBy("anchor").count().filter("count > 1")
    twice = materialise(twice.select(F.col("anchor").alias("a")), "repeated_anchors")
    found = _all_segments(rows, False)
    found = found.join(twice, found["anchor"] == twice["a"], "left_semi")
    found = materialise(found, "repeated_segments")
    place = F.struct("doc", "copy", "start")
    firsts = found.groupBy("anchor", "seg").agg(F.min(place).alias("first"), F.first(F.struct("n", "at")).alias("size"), F.count("*").alias("times"))
    firsts = materialise(firsts, "first_segments")

    # Segments equal to an earlier one are repeated as a whole.
    copied = firsts.filter("times > 1").select(F.col("anchor").alias("a"), F.col("seg").alias("s"), "first")
    whole = found.join(copied, (found["anchor"] == copied["a"]) & (found["seg"] == copied["s"])).filter(place != F.col("first"))
    whole = whole.select("doc", "copy", "start", F.col("n").cast("int").alias("n"))

    # Different segments of one anchor may share windows.
    mixed = firsts.groupBy("anchor").agg(F.count("*").alias("segs")).filter("segs > 1")
    mixed = mixed.select(F.col("anchor").alias("a"), (F.col("segs") > CROWDED).alias("crowded"))
    wanted = firsts.join(mixed, firsts["anchor"] == mixed["a"]).select("first.*", "size.*", "anchor", "crowded")
    wanted = materialise(wanted, "mixed_segments")
    pieces = materialise(_pieces(rows, wanted), "segment_pieces")
    large = pieces.groupBy(F.col("group").alias("g")).count().filter(F.col("count") > LARGE_GROUP).select("g")
    large = materialise(large, "large_groups")
    known = pieces.limit(0)
    if not large.isEmpty():
        single = _by_window(pieces.join(large, pieces["group"] == large["g"], "left_semi"))
        single = materialise(single, "single_windows")
        pieces = pieces.join(large, pieces["group"] == large["g"], "left_anti")
        pieces = pieces.unionByName(single.filter("group IS NOT NULL"))
        known = single.filter("group IS NULL")
    known = known.select("doc", "copy", "start", "n")
    total = pieces.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    bucket = F.pmod(F.xxhash64("group"), F.lit(buckets)).alias("bucket")
    compared = pieces.select(bucket, "data", "doc", "copy", "start", "n", "at")
    compared = compared.groupBy("bucket").applyInArrow(_repeats, "doc long, copy int, start long, n int")
    return whole.unionByName(known).unionByName(compared)


def _spans(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (start, length) of bytes that the windows cover."""
    out: list[list[int]] = []
    for start, n in sorted(found):
        end = start + n + WINDOW - 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b - a) for a, b in out]


def _cut(docs: DataFrame, id_col: str, text_col: str, kept_type: str) -> DataFrame:
    rows = _numbered(docs, id_col, text_col)
    runs = materialise(repeated_windows(rows), "repeated_windows")
    mine = runs.groupBy(F.col("doc").alias("d"), F.col("copy").alias("c")).agg(F.collect_list(F.struct("start", "n")).alias("list"))
    held = rows.join(mine, (rows["doc"] == mine["d"]) & (rows["copy"] == mine["c"]), "left")
    held = held.select("doc_id", "copy", "rest", "data", "list")
    names = ["doc_id", "copy", "rest", "n_bytes", "spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("start", pa.int64()), ("length", pa.int64())])
        for batch in batches:
            size, cut, kept = [], [], []
            for data, found in zip(batch.column(3), batch.column(4)):
                data, found = data.as_py(), found.as_py()
                spans = _spans([(x["start"], x["n"]) for x in found]) if found else []
                at, parts = 0, []
                for start, length in spans:
                    parts.append(data[at:start])
                    at = start + length
                whole = b"".join([*parts, data[at:]])
                size.append(len(data))
                cut.append([{"start": a, "length": n} for a, n in spans])
                kept.append(whole if kept_type == "binary" else whole.decode("utf-8", "ignore"))
            kinds = (pa.int64(), pa.list_(pair), pa.binary() if kept_type == "binary" else pa.string())
            rest = [pa.array(c, k) for c, k in zip((size, cut, kept), kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *rest], names)

    schema = held.select("doc_id", "copy", "rest").schema
    pair = T.StructType().add("start", T.LongType()).add("length", T.LongType())
    schema = schema.add("n_bytes", T.LongType()).add("spans", T.ArrayType(pair)).add("kept", kept_type)
    return held.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, copy, n_bytes, spans, kept): what each document loses to strings that start earlier.

    Texts are UTF-8 bytes, null is empty. ``spans`` are the maximal removed runs (start, length),
    ``kept`` the other bytes. Places are ordered by id, nulls first, then by byte; rows that repeat
    an id are ordered by their bytes and numbered by ``copy``, each with its own result. Texts
    shorter than WINDOW bytes lose nothing. An empty table gives no rows. Equal segments are told by
    128 bits of hash, everything else by its bytes.
    """
    chosen = docs.select(F.col(id_col), F.col(text_col))
    return _cut(chosen, id_col, text_col, "binary").drop("rest")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with what ``remove_repeats`` keeps of their texts; other columns as they are.

    Null texts become empty. A character of which only a part is kept is dropped.
    """
    cut = _cut(docs, id_col, text_col, "string")
    return cut.select(*((F.col("kept") if c == text_col else F.col("rest")[c]).alias(c) for c in docs.columns))
