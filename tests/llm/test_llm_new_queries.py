"""Spelling variants, periodic runs and token files: whole queries against plain Python, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from conftest import DATA
from tokenizers import Tokenizer


from studymart.llm import periodic_runs, queries, spelling, token_files

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


# --- Spelling ----------------------------------------------------------------------


def near_words(words):
    """One deletion or one replacement, by what is left when a position is taken out."""
    known, out = set(words), defaultdict(set)
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[i, len(w), w[:i] + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in known:
                out[w].add(w[:i] + w[i + 1 :])
                out[w[:i] + w[i + 1 :]].add(w)
    for group in holes.values():
        for w in group:
            out[w] |= group - {w}
    return out


def plain_variants(counts):
    near = near_words(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    rows = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (w, n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root)
    return rows


def as_rows(df):
    return {r.word: (r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_spelling_query_against_plain_python(spark, documents):
    counts = Counter()
    for doc, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    df = queries.op11_spelling(spark, DATA)
    assert df.count() == len(counts) > 1000
    assert as_rows(df) == plain_variants(counts)


@pytest.mark.parametrize("filter_bytes", [1, 100, spelling.FILTER_BYTES])
def test_variants_in_several_passes(spark, frame, filter_bytes):
    """The same rows however few blocks a pass may hold; many words of one length, chains of forms."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abé×") for _ in range(rng.randint(5, 9))) for _ in range(500)}
    counts = {w: rng.choice([3, 3, 4, 6, 12, 25, 60, 130]) for w in words}
    got = as_rows(spelling.variants(frame(list(counts.items()), "word string, n long"), filter_bytes=filter_bytes))
    assert got == plain_variants(counts)
    assert any(form and root != form for _, _, _, form, _, root in got.values())


def test_passes_are_bounded():
    blocks = {5: 7, 6: 1, 9: 30}
    for most in (1, 3, 10, 100):
        dealt = spelling.passes(blocks, most * 4 * spelling.LANES)
        assert all(sum(b - a for a, b in p.values()) <= most for p in dealt)
        for length, n in blocks.items():
            assert [x for p in dealt if length in p for x in range(*p[length])] == list(range(n))


def test_words_and_edge_cases(spark, frame):
    docs = frame(
        [(1, None), (None, "Ärger ÄRGER ärger"), (2, ""), (2, "x" * 70000), (3, "ab1cd_ef 漢字gh É×÷́i"), (4, "ab ab"), (4, "ab ab")],
        DOCS,
    ).selectExpr("*", "1 AS n", "2 AS length")
    got = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    expected = {"ab": 5, "cd": 1, "ef": 1, "gh": 1, "É×÷": 1, "i": 1, "x" * 70000: 1, "Ärger": 2, "ärger": 1}
    assert got == expected
    assert spelling.word_counts(frame([], DOCS)).count() == 0
    assert spelling.variants(frame([], "word string, n long")).count() == 0
    assert as_rows(spelling.variants(frame([(None, 9), ("abcd", 9), ("abcde", 2), ("abcdf", 3)], "word string, n long"))) == {
        "abcdf": ("abcdf", 3, 0, None, None, "abcdf")
    }
    with pytest.raises(ValueError):
        spelling.variants(frame([("abcde", 3)], "word string, n long"), ratio=1)


def test_ties_take_the_smallest_word(frame):
    rows = [("abcde", 3), ("abcdz", 9), ("abcda", 9), ("abcdé", 9)]
    assert as_rows(spelling.variants(frame(rows, "word string, n long")))["abcde"][3] == "abcda"


# --- Periodic runs -----------------------------------------------------------------


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                x = words[i : i + length]
                if all(any(x[k] != x[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_query_against_plain_python(spark, documents):
    rows = {r.doc_id: r for r in queries.op12_periodic_runs(spark, DATA).collect()}
    assert len(rows) == len(documents)
    total = 0
    for doc, text in documents:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        n, h = len(words), zlib.crc32(str(doc).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = plain_runs(words)
        total += len(found)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        r = rows[doc]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, found).encode()).hexdigest()
    assert total > 5


def drawn_words(rng):
    k = rng.choice([1, 2, 3, 5, 50])
    words = [b"%d" % rng.randint(1, k) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 4)):
        unit = [b"%d" % rng.randint(1, k) for _ in range(rng.randint(1, 6))]
        words += (unit * 12)[: rng.randint(1, 70)] + [b"%d" % rng.randint(1, k) for _ in range(rng.randint(0, 5))]
    return words


@pytest.mark.parametrize("grid_words", [10, periodic_runs.GRID_WORDS])
def test_runs_of_drawn_words(monkeypatch, grid_words):
    """Small alphabets, many documents at once; and the grid cut into small parts."""
    monkeypatch.setattr(periodic_runs, "GRID_WORDS", grid_words)
    monkeypatch.setattr(periodic_runs, "GRID_PART", 16)
    periodic_runs._grid.cache_clear()
    rng = random.Random(grid_words)
    for _ in range(150):
        docs = [(i, drawn_words(rng)) for i in range(rng.randint(1, 8))]
        for row, (_, words) in zip(periodic_runs._documents(docs).to_pylist(), docs):
            found = [(x["start"], x["length"], x["period"]) for x in row["runs"]]
            assert found == plain_runs(words)
            assert row["collapsed"] == plain_collapsed([w.decode() for w in words], found)
    periodic_runs._grid.cache_clear()


def test_extensions_are_exact():
    rng = np.random.default_rng(1)
    for k in (1, 2, 3, 30):
        symbols = np.append(rng.integers(0, k, 300), -1)
        grammar = periodic_runs.Grammar(symbols)
        a, b = rng.integers(0, 150, 400), rng.integers(151, 300, 400)
        s = symbols.tolist()
        for forward, step, first in ((True, 1, 0), (False, -1, -1)):
            for x, y, n in zip(a.tolist(), b.tolist(), grammar.extend(a, b, forward).tolist()):
                m = 0
                while 0 <= x + first + step * m and y + first + step * m < len(s) and s[x + first + step * m] == s[y + first + step * m]:
                    m += 1
                assert n == m


def test_periodic_edge_cases(frame):
    long = "ja nein " * 40000
    rows = [(1, None), (None, "a a a a a a"), (2, ""), (3, " \x0b\t "), (4, "b b b b b"), (5, long), (5, long), (6, "x x " * 6)]
    docs = frame(rows, DOCS).selectExpr("*", "1 AS runs", "'x' AS collapsed", "2 AS start")
    got = sorted(
        ((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(docs).collect())
    )
    assert got == [
        (0, 6, [(0, 6, 1)], "a"),
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 0, [], ""),
        (4, 5, [], "b b b b b"),
        (5, 80000, [(0, 80000, 2)], "ja nein"),
        (5, 80000, [(0, 80000, 2)], "ja nein"),
        (6, 6, [(0, 6, 1)], "x x"),
    ]
    assert periodic_runs.periodic_runs(frame([], DOCS)).count() == 0


# --- Token files -------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_files.VOCABULARY)


def expected_rows(library, rows):
    """(doc_id, start, n_tokens, crc) for rows in order."""
    out, start = [], 0
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_query_against_the_library(spark, documents, library):
    got = sorted(tuple(r) for r in queries.op13_token_files(spark, DATA).collect())
    assert got == expected_rows(library, sorted(documents))


def test_encoder_gives_the_ids_of_the_library(library):
    encoder = token_files.encoder(token_files.VOCABULARY)
    assert isinstance(encoder, token_files.WordEncoder)
    rng = random.Random(9)
    parts = [*"aAbzé ßİΣσςñ \t\n\x0b\x0c\r\x1c\x1f\x85\xa0 　'0١²🙂ﬁ가ᄀ.,-#&", "'s", "'ll", "ñ", "<|startoftext|>", "<|endoftext|>", "<|"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for i in range(0, len(texts), 100):
        for text, ids in zip(texts[i : i + 100], encoder.encode(texts[i : i + 100])):
            assert np.frombuffer(ids, encoder.type).tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_files_hold_nulls_repeats_and_long_texts(spark, frame, library, base):
    long = "wort " * 200_000
    rows = [(3, "c"), (None, "n"), (1, None), (2, long), (1, ""), (7, "x y"), (7, "x y"), (7, "z"), (-5, "minus")]
    docs = frame(rows, DOCS).selectExpr("*", "1 AS start", "'x' AS ids", "5 AS h")
    listed = token_files.write_token_files(docs, f"{base}/files", roll_documents=2)
    assert listed.count() >= 5 and all(r.documents <= 2 for r in listed.collect())
    got = token_files.read_token_files(spark, f"{base}/files").collect()
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == [None, -5, 1, 1, 2, 3, 7, 7, 7]
    by_start, at = sorted(got, key=lambda r: r.start), 0
    for r in by_start:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    texts = defaultdict(list)
    for doc, text in rows:
        texts[doc].append(tuple(library.encode(text or "", add_special_tokens=False).ids) + (1,))
    for r in got:
        texts[r.doc_id].remove(tuple(np.frombuffer(r.ids, "<u4").tolist()))
    assert not any(texts.values())


def test_files_can_be_mapped_and_damage_is_told(spark, frame, library, base):
    docs = frame([(i, f"word {i}") for i in range(50)], DOCS)
    listed = token_files.write_token_files(docs, base).collect()
    names = [r.file for r in listed]
    shards = [token_files.TokenFile(base, n) for n in names]
    seen = {s.doc(i): s[i].tolist() for s in shards for i in range(len(s))}
    assert seen == {i: [*library.encode(f"word {i}").ids, 1] for i in range(50)}
    (damaged := Path(base, f"{names[0]}.bin")).write_bytes(damaged.read_bytes()[:-2])
    with pytest.raises(ValueError):
        token_files.TokenFile(base, names[0])


def test_empty_tables_and_left_over_files(spark, frame, base):


    root = Path(base, "left")
    root.mkdir()
    for i in range(9):
        (root / f"part-000000-00000-{i}.bin").write_bytes(b"lost attempt")
    token_files.write_token_files(frame([(1, "a")], DOCS), str(root))
    assert len(list(root.glob("part-*"))) == 2
    assert [r.doc_id for r in token_files.read_token_files(spark, str(root)).collect()] == [1]
    token_files.write_token_files(frame([], DOCS), f"{base}/none")
    assert token_files.read_token_files(spark, f"{base}/none").count() == 0


def test_bases_are_prefix_sums(frame):
    rng = random.Random(2)
    rows = [(t, k, f"f{t}-{k}", 1, rng.randint(1, 9), 2) for t in range(5000) for k in range(rng.randint(1, 2))]
    shuffled = rng.sample(rows, len(rows))
    got = {r.file: r.base for r in token_files.with_bases(frame(shuffled, token_files.MANIFEST)).collect()}
    at = 0
    for _, _, file, _, tokens, _ in rows:
        assert got[file] == at
        at += tokens
