"""Document quality by hierarchical empirical Bayes.

A logistic model on figures of the text gives each document's own evidence. Sites shrink towards
what is above them: a path's mean evidence towards its host's, the host's towards the mean of all
documents, the more so the fewer documents a site has. How strongly is estimated from how much sites
differ. A document's score joins its evidence with the posterior of its path.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studymart.llm.decontamination import bounded
from studymart.session import materialise

#: The model is fitted on at most so many labelled documents, the first by a hash of the id.
SAMPLE_ROWS = 20_000
#: Documents that score below are rejected.
THRESHOLD = 0.3
#: Share of the site's log-odds, against those of all documents, that is added to a document's own.
SITE_WEIGHT = 0.5
#: Evidence stays this far from 0 and 1.
EDGE = 1e-4

FEATURES = 14


def features(text: str | None) -> list[float]:
    """Figures of a whole text; all finite, also for an empty one."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    n = max(len(data), 1)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    nw, nl = max(len(words), 1), max(len(lines), 1)
    return [
        np.log(n),
        count[65:91].sum() / n,
        (count[97:123].sum() + count[128:].sum()) / n,
        count[48:58].sum() / n,
        count[[35, 36, 37, 38, 42, 64, 94, 126]].sum() / n,
        count[[123, 124, 125, 60, 61, 62, 91, 92, 93, 95]].sum() / n,
        count[[33, 63]].sum() / n,
        count[[44, 46, 58, 59]].sum() / nw,
        sum(map(len, words)) / nw,
        len(set(words)) / nw,
        1 - len(set(lines)) / nl if lines else 0.0,
        sum(len(w) <= 3 for w in words) / nw,
        count[10] / n,
        sum(w[0].isupper() for w in words) / nw,
    ]


@dataclass(frozen=True)
class Evidence:
    """A logistic model: the chance that a document is good."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def chance(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        odds = self.weights[0] + z @ self.weights[1:]
        return np.clip(1 / (1 + np.exp(-np.clip(odds, -30, 30))), EDGE, 1 - EDGE)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> Evidence:
    """Newton's method; without rows of both classes the chance is the same for all."""
    if not len(y):
        return Evidence(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1))
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.c_[np.ones(len(y)), np.clip((x - mean) / scale, -8, 8)]
    weights, penalty = np.zeros(z.shape[1]), np.diag(np.r_[1e-3, np.full(x.shape[1], ridge)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ weights)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return Evidence(mean, scale, weights)


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality") -> Evidence:
    """The model of the labelled documents, from a bounded sample of them."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("labelled")).agg(F.min(F.col(label_col).cast("int")).alias("y"))
    sample = known.orderBy(F.xxhash64("labelled"), "labelled").limit(SAMPLE_ROWS)
    texts = docs.select(F.col(id_col).alias("labelled"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [[float(v) for v in features(t.as_py())] for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["labelled", "y", "x"]
            )

    found = texts.join(F.broadcast(materialise(sample, "label_sample")), "labelled").select("labelled", "y", "text")
    rows = found.mapInArrow(run, "labelled long, y int, x array<double>").dropDuplicates(["labelled"])
    rows = rows.orderBy(F.xxhash64("labelled"), "labelled").collect()
    return fit_logistic(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float))


def evidence(docs: DataFrame, model: Evidence, id_col: str, text_col: str, host: Column, path: Column) -> DataFrame:
    """(doc_id, host, path, evidence) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(3)], float).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(model.chance(x))], ["doc_id", "host", "path", "evidence"]
            )

    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        F.col(text_col).cast("string").alias("text"),
    )
    return chosen.mapInArrow(run, "doc_id long, host string, path string, evidence double")


def _strength(sites: DataFrame, mean: Column, above: Column) -> float:
    """Pseudo-documents that a site's parent counts for, by moments.

    Sites' means vary around their parents' by a variance that is both sampling, v / n, and between
    sites; documents of a site vary by v. The ratio of v to the variance between sites is the
    strength: large where sites differ no more than samples would.
    """
    row = sites.agg(
        F.sum("n").alias("n"),
        F.count("*").alias("sites"),
        F.sum(F.col("n") * (mean - above) ** 2).alias("between"),
        F.sum(F.col("squares") - F.col("n") * mean**2).alias("within"),
    ).first()
    if not row["n"]:
        return 1.0
    inner = max(row["within"], 0.0) / max(row["n"] - row["sites"], 1) + 1e-9
    outer = max(row["between"] - row["sites"] * inner, 0.0) / row["n"]
    return float(min(max(inner / (outer + 1e-9), 1.0), 1e6))


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, host_score, path_score) and the mean of all documents."""
    base = scored.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("evidence").alias("sum"), F.sum(F.col("evidence") ** 2).alias("squares")
    )
    paths = materialise(base, "quality_paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).first()
    overall = total["sum"] / total["n"] if total["n"] else 0.5
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "sum", "squares")))
    mean = F.col("sum") / F.col("n")
    k = _strength(hosts, mean, F.lit(overall))
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("sum") + k * overall) / (F.col("n") + k)).alias("host_score"))
    joined = paths.join(hosts, F.col("host").eqNullSafe(F.col("h")))
    k = _strength(joined, mean, F.col("host_score"))
    path_score = (F.col("sum") + k * F.col("host_score")) / (F.col("n") + k)
    return joined.select("host", "path", "host_score", path_score.alias("path_score")), overall


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, evidence, host_score, path_score, score, keep) of every row of ``docs``.

    ``host`` and ``path`` name a document's site, by default its source, and its language below it;
    nulls are a site of their own. Empty and null texts are scored as they are. ``labels`` has
    doc_id and quality (1: good); without labels all evidence is even and all is kept. Repeated rows
    count each. An empty table gives no rows.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    model = fit(docs, labels, id_col, text_col)
    scored = materialise(evidence(docs, model, id_col, text_col, host, path), "quality_evidence")
    sites, overall = site_posteriors(scored)
    sites = materialise(sites, "quality_sites").withColumnRenamed("host", "h").withColumnRenamed("path", "p")
    odds = lambda c: F.log(c / (1 - c))
    safe = lambda c: F.least(F.greatest(c, F.lit(EDGE)), F.lit(1 - EDGE))
    shift = SITE_WEIGHT * (odds(safe(F.col("path_score"))) - odds(safe(F.lit(overall))))
    score = 1 / (1 + F.exp(-(odds(F.col("evidence")) + shift)))
    same = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))
    return scored.join(bounded(sites), same).select(
        "doc_id", "evidence", "host_score", "path_score", score.alias("score"), (score >= threshold).alias("keep")
    )


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that aren't rejected; columns as they are. Rows that repeat an id go together."""
    scores = quality_scores(docs, labels, id_col=id_col, **options)
    rejected = materialise(scores.filter(~F.col("keep")).select(F.col("doc_id").alias("rejected_id")).distinct(), "rejected")
    return docs.join(bounded(rejected), docs[id_col].eqNullSafe(rejected["rejected_id"]), "left_anti")
