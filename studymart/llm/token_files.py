"""Token ids in flat binary files with 64-bit document offsets.

Documents are sorted by range, each task writes the files of its range: ``.bin`` holds nothing but
ids, ``.idx`` the document ids and where each begins in its file. A manifest with one line a file is
written last. How many ids all files before a file hold is a prefix sum over the manifest, so no
task needs to know of another. Readers map the files that the manifest lists into memory: files of
tasks that ran twice or died are never read, and are removed at the end.
"""

import functools
import json
import re
import struct
import sys
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from studymart.llm.warc import store

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: Text that one range of the sort is meant to hold.
RANGE_BYTES = 64 << 20
#: A task begins a new file after so many bytes of ids, or so many documents.
ROLL_BYTES, ROLL_DOCUMENTS = 256 << 20, 1 << 20
#: Pieces and words whose ids a worker remembers, twice so many at most, and the longest it does so for.
REMEMBERED, REMEMBERED_WORDS, REMEMBERED_LENGTH = 150_000, 50_000, 40
#: Characters of the texts that are encoded together.
TEXT_TOGETHER = 1 << 20
#: The normalizer and cut that ``WordEncoder`` knows, as the tokenizer's file states them.
KNOWN_CUT = [
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
]
#: Characters whose lower case, composition and letters need no tables, and the tokenizer's pattern over them.
_SIMPLE = "!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")

#: Lines of the manifest that one prefix sum goes over; sums of such groups make the next level.
SUM_GROUP = 4096

MANIFEST = "task int, number int, file string, documents long, tokens long, width int"
_MANIFEST = pa.schema(
    [
        ("task", pa.int32()),
        ("number", pa.int32()),
        ("file", pa.string()),
        ("documents", pa.int64()),
        ("tokens", pa.int64()),
        ("width", pa.int32()),
    ]
)
ROWS = "doc_id long, start long, n_tokens long, ids binary"
_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

_MAGIC = b"TOKIDX01"
#: Magic, bytes of an id, documents, documents without an id (they come first).
_HEADER = struct.Struct("<8sIIQQ")


class TextEncoder:
    """The ids of whole texts, as little-endian integers in the width of the files."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype(f"<u{width_of(self.tokenizer.get_vocab_size(with_added_tokens=True))}")
        self.width = self.type.itemsize

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; the texts lie in memory together."""
        return [self.pack(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def forget(self) -> None:
        """Give back what a task remembered; its worker may idle for long."""


class Remembered(dict):
    """Keys to what ``make`` gives for them, in bounded memory: two generations, the older goes when one is full."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > REMEMBERED_LENGTH:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder(TextEncoder):
    """The same ids for tokenizers that cut like ``KNOWN_CUT``, with the ids of pieces and words remembered.

    The tokenizer drops blanks; none of its patterns or added tokens reaches over one and no
    character composes with one. So the ids of a text are those of the pieces between blanks, one
    after the other. Pieces of ASCII and precomposed Latin letters are cut into the tokenizer's own
    words, which go straight to its model; other pieces are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__(path)
        self.pieces, self.words = Remembered(self._piece, REMEMBERED), Remembered(self._word, REMEMBERED_WORDS)
        self.added = self.tokenizer.get_added_tokens_decoder().values()
        self.odd = re.compile("|".join([f"[^{_SIMPLE}]", *(re.escape(t.content) for t in self.added)]))
        self.model = self.tokenizer.model
        # How the tokenizer spells the bytes of a letter for its model; ASCII is as it is.
        spelled = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {code: spelled(chr(code))[0][0] for code in range(0xC0, 0x100)}
        # Whether letters, with one more character at their end, can't hold an added token.
        self.letters_are_words = not any(re.fullmatch("[A-Za-z]*.", t.content) for t in self.added)

    def forget(self) -> None:
        for memory in (self.pieces, self.words):
            memory.clear()
            memory.older.clear()

    def _word(self, word: str) -> bytes:
        tokens = self.model.tokenize(word if word.isascii() else word.translate(self.spelling))
        return self.pack([t.id for t in tokens])

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        if self.letters_are_words and text.isascii():
            if text.isalpha():
                return self.words[text.lower()]
            if text[:-1].isalpha() and "!" <= text[-1] <= "~":
                return self.words[text[:-1].lower()] + self.words[text[-1]]
        if self.odd.search(text):
            return super().encode([text])[0]
        return b"".join(map(self.words.__getitem__, _WORDS.findall(text.lower())))

    def encode(self, texts: list[str]) -> list[bytes]:
        return [b"".join(map(self.pieces.__getitem__, text.encode().split())) for text in texts]


def width_of(vocabulary_size: int) -> int:
    return 2 if vocabulary_size <= 1 << 16 else 4


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    with open(path, encoding="utf-8") as file:
        definition = json.load(file)
    cut = [definition["normalizer"], definition["pre_tokenizer"]]
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in definition["added_tokens"])
    return WordEncoder(path) if cut == KNOWN_CUT and plain else TextEncoder(path)


class FileWriter:
    """The files of one task; their names are new in every attempt."""

    def __init__(self, folder: str, task: int, width: int, roll_bytes: int, roll_documents: int):
        self.files, self.root = store(folder)
        self.task, self.width, self.roll = task, width, (roll_bytes, roll_documents)
        self.done: list[tuple] = []
        self.out = None

    def add(self, doc: int | None, ids: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.task:06d}-{len(self.done):05d}-{uuid.uuid4().hex}"
            self.out = self.files.open_output_stream(f"{self.root}/{self.name}.bin")
            self.docs, self.offsets, self.nulls = array("q"), array("Q", [0]), 0
        self.out.write(ids)
        self.nulls += doc is None
        self.docs.append(0 if doc is None else doc)
        self.offsets.append(self.offsets[-1] + len(ids) // self.width)
        if self.offsets[-1] * self.width >= self.roll[0] or len(self.docs) >= self.roll[1]:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        with self.files.open_output_stream(f"{self.root}/{self.name}.idx") as index:
            index.write(_HEADER.pack(_MAGIC, self.width, 0, len(self.docs), self.nulls))
            for numbers in (self.docs, self.offsets):
                if sys.byteorder == "big":
                    numbers.byteswap()
                index.write(numbers.tobytes())
        tokens = int(np.frombuffer(self.offsets.tobytes()[-8:], "<u8")[0])
        self.done.append((self.task, len(self.done), self.name, len(self.docs), tokens, self.width))
        self.out = None


def write_token_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    roll_bytes: int = ROLL_BYTES,
    roll_documents: int = ROLL_DOCUMENTS,
) -> DataFrame:
    """Writes the ids of all documents in ascending id order and returns the manifest.

    A document is the ids of its text and then ``end_id``; a null text counts as empty. Null ids
    come first; rows that repeat an id are a document each, ordered by a hash of their text (equal
    rows as they are read), and may lie in several files. An empty table gives an empty manifest.
    Ids take two bytes where the vocabulary has at most 65,536 entries, else four. ``folder`` must be
    one that all executors reach. Memory of a task: the longest single text (or a group of short ones), the offsets of one file,
    and the remembered pieces.
    """
    spark = docs.sparkSession
    files, root = store(folder)
    files.create_dir(root, recursive=True)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    total = chosen.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = chosen.select("doc_id", "text", order[1].alias("h"), order[2].alias("place"))
    ordered = ordered.repartitionByRange(max(1, -(-total // RANGE_BYTES)), "doc_id", "h", "place")
    ordered = ordered.sortWithinPartitions("doc_id", "h", "place").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        if end_id >= 1 << 8 * known.width:
            raise ValueError(f"id {end_id} needs more than {known.width} bytes")
        end = np.array([end_id], known.type).tobytes()
        out = FileWriter(folder, TaskContext.get().partitionId(), known.width, roll_bytes, roll_documents)
        group, size = [], 0

        def flush():
            for doc, ids in zip((doc for doc, _ in group), known.encode([text for _, text in group])):
                out.add(doc, ids + end)
            group.clear()

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                group.append((doc, value.as_py()))
                size += len(group[-1][1])
                if size >= TEXT_TOGETHER:
                    flush()
                    size = 0
        flush()
        out.close()
        known.forget()
        columns = list(zip(*out.done)) or [()] * len(_MANIFEST)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MANIFEST)], schema=_MANIFEST)

    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    _remove_unlisted(listed, folder)
    return listed


def _remove_unlisted(listed: DataFrame, folder: str) -> None:
    """Removes the files of attempts that lost; none of them is ever read, so a failure here harms nothing."""
    files, root = store(folder)
    found = [
        (entry.path, entry.base_name.rpartition(".")[0])
        for entry in files.get_file_info(pafs.FileSelector(root))
        if entry.type == pafs.FileType.File and entry.base_name.startswith("part-")
    ]
    if len(found) > 2 * listed.count():
        kept = {r.file for r in listed.select("file").toLocalIterator()}
        for path, name in found:
            if name not in kept:
                files.delete_file(path)


def with_bases(listed: DataFrame) -> DataFrame:
    """The manifest with ``base``, the ids in all files before each; sums go by groups of its lines."""
    before = (Window.unboundedPreceding, -1)
    group = F.col("task").cast("long").bitwiseAND(F.lit(-SUM_GROUP)).alias("sum_group")
    rows = listed.select("*", group)
    sums = rows.groupBy("sum_group").agg(F.sum("tokens").alias("of_group"))
    sums = sums.select(
        "sum_group", F.sum("of_group").over(Window.orderBy("sum_group").rowsBetween(*before)).alias("of_groups")
    )
    inside = F.sum("tokens").over(Window.partitionBy("sum_group").orderBy("task", "number").rowsBetween(*before))
    rows = rows.withColumn("inside", inside).join(sums, "sum_group")
    zero = F.lit(0).cast("long")
    return rows.withColumn("base", F.coalesce("of_groups", zero) + F.coalesce("inside", zero)).drop(
        "sum_group", "inside", "of_groups"
    )


class TokenFile:
    """One file and its index, mapped into memory where the file system is local, else read by parts."""

    def __init__(self, folder: str, name: str):
        files, root = store(folder)
        local = isinstance(files, pafs.LocalFileSystem)
        self._open = (lambda p: pa.memory_map(p)) if local else files.open_input_file
        with self._open(f"{root}/{name}.idx") as index:
            magic, self.width, _, n, self.nulls = _HEADER.unpack(index.read(_HEADER.size))
            data = index.read()
        if magic != _MAGIC or len(data) != 8 * (2 * n + 1):
            raise ValueError(f"{name}.idx is damaged")
        self.docs = np.frombuffer(data, "<i8", n)
        self.offsets = np.frombuffer(data, "<u8", n + 1, 8 * n).astype(np.int64)
        self.ids = self._open(f"{root}/{name}.bin")
        if self.ids.size() != self.offsets[-1] * self.width:
            raise ValueError(f"{name}.bin is damaged")

    def __len__(self) -> int:
        return len(self.docs)

    def doc(self, i: int) -> int | None:
        return None if i < self.nulls else int(self.docs[i])

    def __getitem__(self, i: int) -> np.ndarray:
        first, last = (int(x) * self.width for x in self.offsets[i : i + 2])
        return np.frombuffer(self.ids.read_at(last - first, first), f"<u{self.width}")

    def close(self) -> None:
        self.ids.close()


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of the files that the manifest lists (``ROWS``).

    ``start`` counts the ids of all documents before, ``ids`` are little-endian unsigned 32-bit.
    Raises ValueError where the length of a file doesn't fit its index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns)):
                shard = TokenFile(folder, name)
                rows, size = [], 0
                for i in range(len(shard)):
                    ids = shard[i]
                    rows.append((shard.doc(i), base + int(shard.offsets[i]), len(ids), ids.astype("<u4").tobytes()))
                    size += 4 * len(ids) + 64
                    if size >= 8 << 20 or i == len(shard) - 1:
                        columns = zip(*rows)
                        arrays = [pa.array(c, f.type) for c, f in zip(columns, _ROWS)]
                        yield pa.RecordBatch.from_arrays(arrays, schema=_ROWS)
                        rows, size = [], 0
                shard.close()

    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    tasks = max(1, listed.count())
    spread = with_bases(listed).repartitionByRange(tasks, "task", "number")
    return spread.select("file", "base").mapInArrow(run, ROWS)
