"""SimHash groups, repeated strings and benchmark items against brute force."""

import random
import re

import numpy as np
import pytest

from studymart.llm import components, decontamination, simhash, suffix

DOCS = "doc_id long, text string, fp string, start string, lang string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)


def groups(values, linked):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("bucket", [16384, 40])
def test_links_connect_what_is_near(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(150):  # a crowded neighbourhood, and pairs at every small distance
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 6))))
        prints.add(rng.choice(sorted(prints)) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    prints = sorted(prints)
    table = spark.createDataFrame([(x - (x >> 63 << 64),) for x in prints], "fp long")
    found = simhash.links(table).collect()
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    near = set(edges) | {(b, a) for a, b in edges}
    assert groups(prints, lambda a, b: (a, b) in near) == groups(prints, lambda a, b: (a ^ b).bit_count() <= 3)


def test_thresholds_add_up():
    counts = np.full((64, 64), 25.0) + np.eye(64) * 25
    for total in (10, 10**6, 10**9, 10**12):
        parts = simhash.allot(counts / 100 * total, total, 3)
        bits = [b for group, _ in parts for b in group]
        assert len(set(bits)) == len(bits) and parts


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(-40, 80), rng.randrange(-40, 80)) for _ in range(60)]
    nodes = sorted({x for e in edges for x in e})
    both = set(edges) | {(b, a) for a, b in edges}
    want = groups(nodes, lambda a, b: (a, b) in both)
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert [got.get(n, n) for n in nodes] == [nodes[i] for i in want]
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_edges(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(5, "One two three four"), (3, "one TWO  three\tfour"), (9, None), (8, ""), (8, " "), (None, "alone here"), (7, long), (6, long + " x"), (7, long)]
    got = sorted((r.doc_id is None, r.doc_id, r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect())
    assert [x[1:] for x in got] == [(3, 3), (5, 3), (6, 6), (7, 6), (7, 6), (8, 8), (8, 8), (9, 8), (None, None)]
    kept = simhash.without_duplicates(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "start", "lang"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "6", "8", "8", "None"]
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def brute_cut(rows):
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                covered[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        out.append((_, len(data), sum(covered), bytes(x for x, c in zip(data, covered) if not c)))
    return out


@pytest.mark.parametrize("crowded, large", [(200, 10_000), (1, 10_000), (1, 2)])
def test_repeats_are_cut(spark, monkeypatch, crowded, large):
    monkeypatch.setattr(suffix, "CROWDED", crowded)
    monkeypatch.setattr(suffix, "LARGE_GROUP", large)
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgé", k=rng.randrange(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(30), text(22), text(60), "ab" * 90]
    rows = [(None, text(40)), (1, None), (2, ""), (3, "short"), (4, "é" * 300), (4, text(50)), (5, "y" * 99)]
    for i in range(10, 50):
        rows.append((i, text(rng.randrange(0, 12)) + rng.choice(passages)[rng.randrange(20) :] + text(rng.randrange(0, 12))))
    rows += [(60, rows[10][1]), (61, rows[10][1]), (61, rows[10][1])]
    got = suffix.remove_repeats(frame(spark, rows)).collect()
    mine = sorted((str(r.doc_id), r.n_bytes, sum(s.length for s in r.spans), bytes(r.kept)) for r in got)
    assert mine == sorted((str(i), *x) for i, *x in brute_cut(rows))
    cut = suffix.without_repeats(frame(spark, rows))
    assert cut.columns == ["doc_id", "text", "fp", "start", "lang"] and cut.count() == len(rows)
    assert {r.fp for r in cut.collect()} == {"x"}


def test_repeats_of_nothing(spark):
    assert suffix.remove_repeats(frame(spark, [])).count() == 0


def test_segments_cover_all_windows_across_chunks(monkeypatch):
    data = bytes(random.Random(6).choices(range(256), k=5000))
    whole = suffix.segments(data)
    assert whole[1].sum() == 4901 and list(whole[0]) == [0, *np.cumsum(whole[1])[:-1]]
    monkeypatch.setattr(suffix, "CHUNK", 700)
    pieces = suffix.segments(data)
    assert pieces[1].sum() == 4901 and set(whole[2]) == set(pieces[2])


def test_items_in_documents(spark):
    words = [f"w{i}" for i in range(400)]
    item = lambda a, n: " ".join(words[a : a + n])
    items = [(1, item(0, 30)), (2, item(50, 12)), (3, "tiny one"), (4, None), (5, ""), (None, item(200, 20)), (2, item(50, 12))]
    docs = [
        (10, "x " * 5000 + item(0, 30).upper() + " y" * 5000),
        (11, item(0, 28)),  # 24 of 26 shingles
        (12, item(0, 20)),  # 16 of 26
        (13, item(50, 6) + ", " + item(56, 6).replace(" ", " - ")),
        (14, "a tiny one"),
        (15, "Tiny... ONE"),
        (16, None),
        (17, ""),
        (None, item(200, 20)),
        (10, "nothing"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_shingles) for r in decontamination.contained_items(frame(spark, docs), table).collect()}
    assert got == {(10, 1): (26, 26), (11, 1): (24, 26), (13, 2): (8, 8), (14, 3): (1, 1), (15, 3): (1, 1), (None, None): (16, 16)}
    kept = decontamination.without_items(frame(spark, docs), table)
    assert sorted(r.doc_id for r in kept.collect()) == [12, 16, 17]
    assert decontamination.contained_items(frame(spark, docs), table.limit(0)).count() == 0
    assert decontamination.contained_items(frame(spark, []), table).count() == 0


def plain_containment(docs, items, n=5):
    """Every row of a document against every row of an item; the best share of each pair of ids."""
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    best = {}
    for doc, text in docs:
        words = cut(text)
        for item, wanted in items:
            wanted = cut(wanted)
            k = min(len(wanted), n)
            own = {tuple(wanted[i : i + k]) for i in range(len(wanted) - k + 1)} if k else set()
            hit = len(own & {tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
            if own and hit >= 0.8 * len(own) - 1e-9:
                best[doc, item] = max(best.get((doc, item), (0, 0, 0)), (hit / len(own), hit, len(own)))
    return {pair: found[1:] for pair, found in best.items()}


def test_rows_of_an_item_are_judged_apart(spark):
    """A second, longer row of an item must not hide the first; short items lie inside long documents."""
    words = [f"w{i}" for i in range(1200)]
    items = [(1, " ".join(words[:20])), (1, " ".join(words[100:1100])), (2, "what is two"), (3, "one")]
    docs = [(1, "x y z " + " ".join(words[:20]) + " z"), (2, "so what is two then"), (3, "what two is"), (4, "no one"), (5, "ones")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_matched, r.n_shingles) for r in decontamination.contained_items(frame(spark, docs), table).collect()}
    assert got == plain_containment(docs, items) == {(1, 1): (16, 16), (2, 2): (1, 1), (4, 3): (1, 1)}


@pytest.mark.parametrize("most", [0, decontamination.BROADCAST_BYTES])
def test_drawn_items_of_all_lengths(spark, monkeypatch, most):
    """Item ids that repeat, lengths 1 to 30, few different words; joins with and without broadcast."""
    monkeypatch.setattr(decontamination.bounded, "__defaults__", (most,))
    rng = np.random.default_rng(4)
    word = lambda k: " ".join(f"w{x}" for x in rng.integers(0, 6, k))
    items = [(int(rng.integers(0, 25)), word(int(rng.integers(1, 31)))) for _ in range(60)]
    docs = []
    for i in range(60):
        parts = [word(int(rng.integers(0, 40)))]
        for at in rng.integers(0, len(items), 2):
            kept = items[at][1].split()
            parts += [" ".join(kept[: max(1, int(len(kept) * rng.uniform(0.7, 1)))]), word(3)]
        docs.append((i // 2, " ".join(parts)))
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS words", "1 AS key", "2 AS n")
    found = decontamination.contained_items(frame(spark, docs), table).collect()
    assert {(r.doc_id, r.item_id): (r.n_matched, r.n_shingles) for r in found} == plain_containment(docs, items)
