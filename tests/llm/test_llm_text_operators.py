"""Packing, chat formatting and token counts against brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from studymart.llm import chat, packing, token_counts

DOCS = "doc_id long, text string, length string"
TEXTS = [None, "", " ", "a  b\n\n c \t", "don't stop <|endoftext|> 12 été", "x" * 3000, "word " * 2500, "word " * 2500]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", ""), (4, TEXTS[4], "again")]
    return spark.createDataFrame(rows, DOCS)


def test_pieces_hold_every_token_once(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rows = packing.pack(docs).collect()
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048
    assert sum(2048 - n for n in at.values() if n & (n - 1)) <= 8 * packing.LAST_PADDING
    for doc, text, _ in docs.collect():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        own = sorted({(r.start, r.length, bytes(r.ids)) for r in rows if r.doc_id == doc})
        times = sum(r.doc_id == doc and r.start == 0 for r in rows)
        assert times == sum(d.doc_id == doc for d in docs.collect())
        if times == 1:
            assert b"".join(x[2] for x in own) == ids
            assert [x[0] for x in own] == [0, *itertools.accumulate(x[1] for x in own)][:-1]
        assert {r.doc_tokens for r in rows if r.doc_id == doc} == {len(ids) // 4}


def test_added_tokens_get_their_ids(spark, tmp_path):
    import corpus_pipeline
    from studymart.llm import queries

    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"a  {end}  b\n\n{end}\t", f"x{end}y", "<|endoftext|", f"<|{end}|>", f"{'w ' * 3000}{end} é", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]
    assert whole[0].tolist() == [64, 220, 50256, 275, 1]
    for pieces in (queries.op2_packing(spark, str(tmp_path)), corpus_pipeline.packing_stage(spark, docs, str(tmp_path))):
        rows, length = pieces.collect(), {}
        for r in rows:
            ids = whole[r.doc_id]
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            length[r.doc_id] = length.get(r.doc_id, 0) + r.length
        assert length == {i: len(ids) for i, ids in enumerate(whole)}


def test_longest_added_token_wins():
    words = packing.Encoder(packing.VOCABULARY, (("<a", 1), ("<a>", 2)))
    assert np.frombuffer(words.ids("<a><a"), "<u4").tolist() == [2, 1]


def test_crc_is_that_of_the_ids(docs):
    from pyspark.sql import functions as F

    for r in packing.pack(docs).select("ids", F.crc32("ids").alias("c")).collect():
        assert r.c == zlib.crc32(bytes(r.ids))


def test_fullest_is_the_best_subset():
    rng = random.Random(3)
    for _ in range(300):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 5))}
        capacity = max(counts) + rng.randrange(0, 40)
        chosen = packing.fullest(sorted(counts), counts.__getitem__, capacity)
        assert chosen[max(counts)] >= 1 and all(k <= counts[n] for n, k in chosen.items())
        best = max(
            s
            for k in itertools.product(*(range(c + 1) for c in counts.values()))
            if dict(zip(counts, k))[max(counts)] and (s := sum(n * x for n, x in zip(counts, k))) <= capacity
        )
        assert sum(n * k for n, k in chosen.items()) == best


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert packing.pack(none).count() == 0
    assert token_counts.token_counts(none).count() == 0


def greedy(word, pieces):
    n = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        n, at = n + 1, end
    return n


def test_counts_are_those_of_greedy_matching():
    rng = random.Random(5)
    for _ in range(60):
        pieces = {"".join(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(rng.randrange(1, 12))}
        counter = token_counts.PieceCounter(sorted(pieces))
        for _ in range(60):
            word = "".join(rng.choices("abcd", k=rng.randrange(1, 12)))
            assert counter.count(word) == greedy(word, pieces), (word, pieces)


def test_token_counts_of_texts(docs):
    known = token_counts.word_counts(token_counts.VOCABULARY)
    rows = token_counts.token_counts(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0][1:] == by_id[1][1:] == by_id[2][1:] == (0, 0, 0)
    assert by_id[3].n_words == 3 and by_id[6].n_words == 2500
    assert by_id[6].n_tokens == 2500 * known["word"]


EVENTS = "conv_id long, seq long, kind string, message long, role string, text string, extra string"


def test_events_fold(spark):
    rows = [
        (1, 3, "delta", 2, "assistant", "lo", ""),
        (1, 1, "message", 1, "user", "hi", ""),
        (1, 2, "delta", 2, "assistant", "hel", ""),
        (1, 4, "edit", 1, "user", "hi there", ""),
        (1, 5, "delta", 1, None, "!", ""),
        (1, 6, "message", 3, "user", "more", ""),
        (1, 7, "regenerate", 2, None, None, ""),
        (1, 8, "delta", 2, "assistant", "bye", ""),
        (2, None, None, 1, None, None, ""),
        (None, 1, "message", 1, "user", "x", ""),
        (3, 1, "unknown", 1, "user", "x", ""),
    ]
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.final_messages(spark.createDataFrame(rows, EVENTS)).collect()}
    assert got == {
        (1, 1): ("user", "hi there!"),
        (1, 2): ("assistant", "bye"),
        (2, 1): (None, ""),
        (None, 1): ("user", "x"),
    }


def test_format_reads_back(spark):
    control = ["<|", "<|role|>", "[INST]", "[/INST]", "</s>", "<s>", "\\", "<\\|", "[\\\\/INST]", "a", "\n", "é", "<", "[", ""]
    rng = random.Random(7)
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", None, "</s>"]), "".join(rng.choices(control, k=6)))
        for c in range(40)
        for t in range(3)
    ] + [(7, 1, "user", None), (7, 1, "user", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.render(chat.final_messages(chat.turn_events(table)))).collect()
    for r in back:
        own = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: (x[1], x[2] or "", x[3] is not None, x[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in own]
        assert [t.loss_text for t in r.turns] == [(x[3] or "") if x[2] == "assistant" else "" for x in own]
    assert chat.render(chat.final_messages(chat.turn_events(table.limit(0)))).count() == 0


def test_the_pool_of_remainders_is_bounded(monkeypatch):
    """Equal lengths that never fill a window: what waits stays bounded, and little is padded."""
    monkeypatch.setattr(packing, "POOL_TOKENS", 100_000)
    packer, most, pieces = packing.Packer(0, 2048), 0, []
    ids = np.arange(1500, dtype="<u4").tobytes()
    for block in range(30):
        for i in range(200):
            packer.add(block * 200 + i, ids)
        packer.pack(last=False)
        most = max(most, packer.pooled)
        kept = sum(len(d[1]) for waiting in packer.pool.values() for d, _ in waiting)
        assert kept <= 4 * 1500 * len([d for waiting in packer.pool.values() for d in waiting])
        pieces += packer.rows
        packer.rows = []
    packer.pack(last=True)
    pieces += packer.rows
    assert most <= 100_000
    whole, windows = {}, {}
    for doc, start, n, own, total, sequence, offset in sorted(pieces, key=lambda r: (r[0], r[1])):
        assert (start, total) == (whole.get(doc, 0), 1500) and own == ids[4 * start : 4 * (start + n)]
        whole[doc] = start + n
        windows[sequence] = windows.get(sequence, 0) + n
    assert len(whole) == 6000 and set(whole.values()) == {1500}
    assert max(windows.values()) <= 2048 and len(windows) * 2048 - 6000 * 1500 < 3 * 2048
