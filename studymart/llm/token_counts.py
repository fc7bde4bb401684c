"""Word-piece counts by a longest-match automaton in linear time.

The vocabulary becomes a trie. Where a character has no edge, the failure link leads to the node
that holds what remains after the greedy longest matches on the way are popped; how many pieces
that pops is stored beside the link. So counting needs one pass over a word, and no piece is built.
"""

import functools
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Marks the start of a word in the vocabulary.
WORD_START = "▁"
#: Counts of words that a worker remembers, and the longest word it does so for.
CACHED_WORDS, CACHED_LENGTH = 500_000, 40

SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64())])


class PieceCounter:
    """Number of greedy longest-match pieces of a word; 0 if it can't be cut into pieces."""

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                node = self.next[node][c]
            ends[node] = node != 0 or ends[node]
        # Link and number of popped pieces; -1: nothing on the way to this node is a piece.
        self.link, self.popped = [-1] * len(self.next), [0] * len(self.next)
        level = [0]
        while level:  # breadth first: links lead to shallower nodes
            deeper = []
            for node in level:
                for c, child in self.next[node].items():
                    deeper.append(child)
                    if ends[child]:
                        self.link[child], self.popped[child] = 0, 1
                        continue
                    at, n = self.link[node], self.popped[node]
                    while at >= 0 and c not in self.next[at]:
                        n += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[child], self.popped[child] = self.next[at][c], n
            level = deeper

    def count(self, word: str) -> int:
        node = total = 0
        for c in word:
            while (to := self.next[node].get(c)) is None:
                total += self.popped[node]
                node = self.link[node]
                if node < 0 or node == 0 and c not in self.next[0]:
                    return 0
            node = to
        while node > 0:  # what is left is cut the same way
            total += self.popped[node]
            node = self.link[node]
        return total if node == 0 else 0


class WordCounts(dict):
    """Words to their piece counts, computed at the first sight of a word."""

    def __init__(self, pieces: Iterable[str]):
        self.counter = PieceCounter(pieces)

    def __missing__(self, word: str) -> int:
        n = self.counter.count(WORD_START + word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n


@functools.lru_cache(maxsize=2)
def word_counts(path: str) -> WordCounts:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return WordCounts(
        model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    )


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Per row of ``docs``: words, word pieces and unknown words of its whole text.

    Words are what blanks separate, case as it is. A word takes the longest vocabulary entry at its
    start (with the mark of a word start), then the longest for the rest, and so on; a word that
    gets stuck is one unknown token. Null and empty texts have none of each; null ids stay null;
    repeated rows are counted each; an empty table gives no rows. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_counts(vocabulary)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column(1):
                counts = [known[w] for w in (text.as_py() or "").split()]
                words.append(len(counts))
                unknown.append(stuck := counts.count(0))
                tokens.append(sum(counts) + stuck)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], schema=_ARROW
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, SCHEMA)
