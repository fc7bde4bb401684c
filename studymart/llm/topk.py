"""Exact top-k by inner product as a Voronoi join.

Vectors are dealt to the cell of their nearest pivot. Bounds come from small summaries of the cells:
a query knows from the cells' counts and radii a score that its k-th best can't be below, and for
each cell a score that no member can exceed. Only cells that may matter are replicated to a block of
queries, where they are scored in blocks of matrices.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studymart.session import materialise

#: Pivots: at most so many, taken from a hash-ordered sample. Their number bounds every summary.
PIVOTS = 64
#: Queries that are solved together against one replica of the cells they need.
QUERY_BLOCK = 4096
#: Rows of a block of candidates in the local solver.
CANDIDATE_BLOCK = 8192

RESULT = "query_id long, rank int, vec_id long, score long"
_PART = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): v holds floor(scale * x) of every component; unusable vectors are left out."""
    x = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(id_col).isNotNull()
        & x.isNotNull()
        & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    )
    return vectors.filter(usable).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("v"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(-1, width))


def _cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivot's number and the distance to it."""
    squares = (pivots**2).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column(1), pivots.shape[1])
            cell = np.argmin(squares - 2 * m @ pivots.T, axis=1) if len(m) else np.zeros(0, int)
            away = np.sqrt(((m - pivots[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(away, pa.float64())],
                ["vec_id", "v", "cell", "away"],
            )

    return vectors.mapInArrow(run, "vec_id long, v array<double>, cell int, away double")


def _routes(queries: DataFrame, pivots: np.ndarray, summary: list, k: int, blocks: int) -> DataFrame:
    """(block, cell) that some query of the block may need.

    For q and a member x of the cell of pivot p with radius r: q.p - |q|r <= q.x <= q.p + |q|r. The
    cells with the best lower bounds that hold k+1 rows together (one may be the query itself)
    guarantee a k-th score; a cell whose upper bound is below that can't contribute.
    """
    cells = np.array([s["cell"] for s in summary], int)
    counts = np.array([s["n"] for s in summary], float)
    radii = np.array([s["radius"] for s in summary], float) * (1 + 1e-9) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.zeros((blocks, len(cells)), bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column(1), pivots.shape[1])
            middle = q @ pivots[cells].T
            spread = np.sqrt((q**2).sum(1))[:, None] * radii
            low, high = middle - spread, middle + spread
            order = np.argsort(-low, axis=1)
            enough = np.cumsum(counts[order], axis=1) >= k + 1
            at = np.where(enough.any(1), enough.argmax(1), len(cells) - 1)
            floor = np.take_along_axis(low, np.take_along_axis(order, at[:, None], 1), 1)
            floor[~enough.any(1)] = -np.inf
            np.logical_or.at(needed, batch.column(2).to_numpy(), high >= floor)
        block, column = np.nonzero(needed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block, pa.int32()), pa.array(cells[column], pa.int32())], ["block", "cell"]
        )

    return queries.mapInArrow(run, "block int, cell int").distinct()


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row by (score descending, id)."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def _solve(key: tuple, left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Top k of each query of one block among the candidates that were sent to this part."""
    if not left.num_rows or not right.num_rows:
        return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
    left, right = left.combine_chunks(), right.combine_chunks()
    width = len(left["v"][0])
    qid, q = left["vec_id"].to_numpy(), _matrix(left["v"].chunk(0), width)
    cid, c = right["vec_id"].to_numpy(), _matrix(right["v"].chunk(0), width)
    top_ids = np.full((len(qid), k), np.iinfo(np.int64).max)
    top = np.full((len(qid), k), -np.inf)
    for i in range(0, len(qid), 256):
        for j in range(0, len(cid), CANDIDATE_BLOCK):
            ids = cid[j : j + CANDIDATE_BLOCK]
            scores = q[i : i + 256] @ c[j : j + CANDIDATE_BLOCK].T
            scores[qid[i : i + 256, None] == ids[None, :]] = -np.inf
            keep = min(k, len(ids))
            kth = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1 : keep]
            # ties at the k-th score must all stay until ids decide
            most = int((scores >= np.maximum(kth, top[i : i + 256, -1:])).sum(1).max())
            if most:
                order = np.argsort(-scores, axis=1, kind="stable")[:, :most] if most > keep else np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
                ids2 = np.concatenate([top_ids[i : i + 256], ids[order]], 1)
                both = np.concatenate([top[i : i + 256], np.take_along_axis(scores, order, 1)], 1)
                top_ids[i : i + 256], top[i : i + 256] = _best(ids2, both, k)
    real = np.isfinite(top)
    return pa.table(
        {
            "query_id": np.repeat(qid, real.sum(1)),
            "vec_id": top_ids[real],
            "score": top[real].astype(np.int64),
        }
    )


def exact_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """For every query its k best vectors by integer inner product: query_id, rank, vec_id, score.

    ``queries`` are rows of the same shape; a vector with the query's own id is never its answer.
    Ties go to the smaller id. Components are floor(scale * x). Vectors that are null, hold a null
    or non-finite component, have a null id, or another width than the most common one, take no
    part; fewer than k candidates give fewer rows, an empty table gives none. Repeated rows of an id
    count as one candidate each and as one query.
    """
    spark = vectors.sparkSession
    all_rows = quantised(vectors, id_col, vector_col, scale)
    widths = all_rows.groupBy(F.size("v").alias("n")).count().filter("n > 0")
    common = widths.orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], RESULT)
    all_rows = all_rows.filter(F.size("v") == common["n"])
    sample = all_rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("v").collect()
    pivots = np.unique(np.array([r["v"] for r in sample]), axis=0)
    base = materialise(_cells(all_rows, pivots), "topk_cells")
    summary = base.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()

    asked = quantised(queries, id_col, vector_col, scale).filter(F.size("v") == common["n"]).dropDuplicates(["vec_id"])
    n = asked.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    blocks = -(-n // block)
    # Queries of a cell go together: their needs are alike. Cells of many queries have several blocks.
    located = _cells(asked, pivots)
    position = F.pmod(F.xxhash64("cell", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks // PIVOTS)))), F.lit(blocks))
    located = located.select("vec_id", "v", position.cast("int").alias("block"))
    routes = _routes(located, pivots, summary, k, blocks)
    # The candidates of a block are spread over parts, each solved apart; the parts' answers are merged.
    parts = max(1, -(-sum(s["n"] for s in summary) // (8 * CANDIDATE_BLOCK)))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    sent = base.join(routes, "cell").select("block", part.alias("part"), "vec_id", "v")
    spread = located.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<int>")))

    def solve(key, left, right):
        return _solve(key, left, right, k)

    scored = spread.groupBy("block", "part").cogroup(sent.groupBy("block", "part")).applyInArrow(solve, _PART)
    return ranked(scored, k)


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """The k best of the parts' answers; at most k rows a query and part come in."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
