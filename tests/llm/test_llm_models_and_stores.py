"""Exact search, archives and the two classifiers."""

import random

import pytest

from studymart.llm import quality, topk, toxicity, warc

VECTORS = "vec_id long, embedding array<float>, v string, cell string"


@pytest.mark.parametrize("block", [4096, 3])
def test_topk_is_exact(spark, block):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.26]) for _ in range(4)], "a", "b") for i in range(120)]
    rows += [(200, None, "", ""), (201, [0.1, None, 0.2, 0.3], "", ""), (202, [float("nan")] * 4, "", "")]
    rows += [(203, [float("inf"), 0.0, 0.0, 0.0], "", ""), (None, [0.1] * 4, "", ""), (204, [9.0, 9.0], "", "")]
    table = spark.createDataFrame(rows, VECTORS)
    queries = table.filter("vec_id % 10 = 0")
    got = {}
    for r in topk.exact_topk(table, queries, k=7, block=block).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    import math

    whole = {i: [math.floor(64 * x) for x in v] for i, v, *_ in rows[:120]}
    assert set(got) == {i for i in whole if i % 10 == 0}
    for q, answers in got.items():
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)
        assert sorted(answers) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores[:7])]


def test_topk_of_little(spark):
    two = spark.createDataFrame([(1, [1.0], "", ""), (2, [2.0], "", "")], VECTORS)
    assert {(r.query_id, r.vec_id) for r in topk.exact_topk(two, two, k=5).collect()} == {(1, 2), (2, 1)}
    assert topk.exact_topk(two.limit(0), two.limit(0), k=5).count() == 0
    assert topk.exact_topk(two, two.limit(0), k=5).count() == 0


PAGES = "page_id long, url string, html string, payload string"


def test_archives_round_trip(spark, base):
    body = "<p>é\r\n\r\nWARC/1.1</p>" * 20
    rows = [
        (4, "http://a/\r\nX: y\\n", body, "c"),
        (2, None, body, "c"),
        (9, "http://b", body, "c"),
        (9, "http://b", body, "c"),
        (5, "", "short", "c"),
        (6, "u", "short", "c"),
        (7, "u", None, "c"),
        (None, "u", "", "c"),
        (8, "u", "z" * 300_000, "c"),
    ]
    manifest = warc.archive(spark.createDataFrame(rows, PAGES), base + "/w", roll=600).collect()
    assert sum(m.records for m in manifest) == len(rows) and len(manifest) > 1
    got = warc.read_archives(spark, base + "/w").collect()
    assert sorted((str(r.page_id), r.url) for r in got) == sorted((str(i), u or "") for i, u, *_ in rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[2].record_type == "response" and bytes(by_id[2].payload).decode() == body
    for i in (4, 9):
        assert (by_id[i].record_type, by_id[i].refers_to, by_id[i].payload) == ("revisit", 2, None)
        assert by_id[i].payload_bytes == len(body.encode()) and by_id[i].payload_digest == by_id[2].payload_digest
    assert {by_id[i].record_type for i in (5, 6, 7, 8, None)} == {"response"}
    again = warc.archive(spark.createDataFrame(rows[::-1], PAGES), base + "/x", roll=600).collect()
    assert sorted(m.sha256 for m in again) == sorted(m.sha256 for m in manifest)
    assert warc.archive(spark.createDataFrame([], PAGES), base + "/y").count() == 0
    assert warc.read_archives(spark, base + "/y").count() == 0


def test_damaged_record_is_told(spark, base):
    import gzip
    import io

    good = warc.record_bytes(1, "u", b"x" * 200, 200, "00", None)
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(gzip.compress(good))))
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(gzip.compress(good[:-20]))))


DOCS = "doc_id long, text string, lang string, source string, score string"


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 8)))
    docs, labels = [], []
    for i in range(400):
        bad, toxic = i % 5 == 0, i % 7 == 0
        words = [word() for _ in range(rng.randrange(20, 120))]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zzmoron", "qvile", "xscum"]))
        text = " | ".join(w.upper() + "!!" for w in words) if bad else " ".join(words).capitalize() + "."
        docs.append((i, text, "en" if i % 2 else None, "junk" if bad else "fine", "c"))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(1000, None, None, None, None), (1001, "", "en", "fine", ""), (None, "plain words here", "en", "fine", ""), docs[1], (1002, "a b " * 30_000, "", "", "")]
    labels += [(5000, 1, 0), (None, 0, 1), (3, None, None)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_separates_and_sites_shrink(judged):
    docs, labels = judged
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 < r.score < 1 for r in rows)
    wrong = sum(r.keep == (r.doc_id % 5 == 0) for r in rows if r.doc_id is not None and r.doc_id < 400)
    assert wrong <= 8
    scores = {r.doc_id: r for r in rows}
    assert scores[0].host_score < 0.3 < scores[1].host_score
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.keep for r in rows)


def test_site_posteriors_follow_the_formula(spark):
    rows = [(i, "a" if i < 30 else "b", "p" if i % 3 else None, 0.9 if i < 30 else 0.2) for i in range(33)]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double")
    sites, overall = quality.site_posteriors(scored)
    assert abs(overall - sum(r[3] for r in rows) / 33) < 1e-9
    got = {(r.host, r.path): r for r in sites.collect()}
    assert len(got) == 4
    assert 0.2 < got["b", "p"].host_score < overall < got["a", "p"].host_score < 0.9


def test_quality_without_labels_or_rows(judged):
    docs, labels = judged
    assert all(r.keep for r in quality.quality_scores(docs, labels.limit(0)).collect())
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_toxic_texts_are_told(judged):
    docs, labels = judged
    model = toxicity.fit(docs, labels)
    rows = toxicity.toxicity(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    wrong = sum(r.predicted != (r.doc_id % 7 == 0) for r in rows if r.doc_id is not None and r.doc_id < 400)
    assert wrong <= 12
    assert all(r.predicted == 0 for r in rows if r.doc_id in (1000, 1001, 1002, None))
    assert toxicity.toxicity(docs.limit(0), model).count() == 0
    even = {r.score for r in toxicity.toxicity(docs, toxicity.fit(docs, labels.limit(0))).collect()}
    assert len(even) == 1


def test_rare_sure_words_are_learned_and_words_of_copies_are_not(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    text = lambda: ["".join(rng.choices("abcdefgh", k=3)) for _ in range(40)]
    copied, docs, labels = text() + ["zqcopied"], [], []
    for i in range(1500):
        words = text()
        if i < 5:  # a minority's word: in 5 of 300 toxic documents, in no other
            words.insert(20, "bomente")
        elif i < 17:  # near copies of one document
            words = copied[: i + 20] + ["edited"] + copied[i + 20 :]
        elif i < 300:
            words.insert(20, "zzmoron")
        docs.append((i, " ".join(words), "es", "", ""))
        labels.append((i, 1, int(i < 300)))
    docs = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, part=F.col("doc_id") % 2)
    assert b" zzmoron " in model.toxic
    assert b" bomente " in model.toxic
    assert b" zqcopied " not in model.toxic
