"""Exact top-k inner products by distributed histogram selection.

Queries are scored against all rows in blocks.  Each round counts every query's scores in 128 bins over the range that
still holds its k-th best; the range shrinks to a single integer, the k-th score itself.  A last round keeps what lies
above it and, of the rows that tie with it, the smallest ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.llm.common import store

BINS = 128
QUERY_BLOCK = 1024
ROW_BLOCK = 8192


def usable(docs: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and integer vector of the rows that take part: id and all components present and finite."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return docs.where(F.col(id_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("v"), F.size(v).alias("dim")
    )


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score: each query's k best rows but its own, ties to the smaller id; all rows if fewer than k.

    Vectors that are null or hold null or non-finite components, and rows without id, take no part.  Vectors of another
    length than the query's are not scored with it.  A repeated id counts once per row, except the query's own.  Scores
    must stay below 2^53 in size.  An empty table or no queries give no rows.
    """
    rows = store(usable(vectors, id_col, vector_col), "vectors")
    asked = rows.where(is_query).dropDuplicates(["id", "dim"])
    n, n_asked = rows.count(), asked.count()
    bound = int(rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 0)
    row_blocks, query_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-n_asked // QUERY_BLOCK))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = rows.select(F.col("id").alias("r_id"), F.col("v").alias("r_v"), F.col("dim").alias("r_dim"), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(row_blocks)).cast("int").alias("r_rb"), each(query_blocks).alias("r_qb")).groupBy("r_dim", "r_rb", "r_qb")
    placed = asked.select("id", "v", "dim", F.pmod(F.xxhash64("id", F.lit(4)), F.lit(query_blocks)).cast("int").alias("qb"), each(row_blocks).alias("rb"))

    def left(state):
        return placed.join(state, ["id", "dim"]).groupBy("dim", "rb", "qb")

    def scored(q: pd.DataFrame, r: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return matrix(q["v"]) @ matrix(r["r_v"]).T, q["id"].to_numpy()[:, None] != r["r_id"].to_numpy()[None, :]

    def counter(span: int, width: int):
        def count(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(r):
                return pd.DataFrame({"id": [], "dim": [], "bin": [], "n": []})
            s, other = scored(q, r)
            above = s - q["low"].to_numpy()[:, None]
            inside = other & (above >= 0) & (above < span)
            bins = np.floor_divide(above, width)
            flat = (np.arange(len(q))[:, None] * BINS + bins)[inside].astype(np.int64)
            found, n = np.unique(flat, return_counts=True)
            return pd.DataFrame({"id": q["id"].to_numpy()[found // BINS], "dim": q["dim"].iloc[0], "bin": found % BINS, "n": n})

        return count

    width, state = 2 * bound + 1, asked.select("id", "dim", F.lit(-bound).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))
    while width > 1:
        span, width = width, -(-width // BINS)

        hist = left(state).cogroup(right).applyInPandas(counter(span, width), "id long, dim int, bin int, n long").groupBy("id", "dim", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id", "dim").orderBy(F.col("bin").desc())
        # the bin in which the count from above reaches what is still needed; with fewer rows than that, the range's foot
        reached = (
            hist.withColumn("upto", F.sum("n").over(down)).join(state, ["id", "dim"])
            .where("upto >= need").groupBy("id", "dim").agg(F.max_by(F.struct("bin", (F.col("upto") - F.col("n")).alias("above")), "bin").alias("at"))
        )
        state = store(
            state.join(reached, ["id", "dim"], "left").select(
                "id", "dim", (F.col("low") + F.coalesce(F.col("at.bin") * F.lit(width), F.lit(0))).alias("low"), (F.col("need") - F.coalesce("at.above", F.lit(0))).alias("need"),
            ), "kth_scores",
        )

    def keep(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        r = r.sort_values("r_id", kind="stable", ignore_index=True)
        s, other = scored(q, r)
        low = q["low"].to_numpy()[:, None]
        ties = other & (s == low)
        take = (other & (s > low)) | (ties & (np.cumsum(ties, axis=1) <= k))
        i, j = np.nonzero(take)
        return pd.DataFrame({"query_id": q["id"].to_numpy()[i], "id": r["r_id"].to_numpy()[j], "score": s[i, j].astype(np.int64)})

    best = left(state).cogroup(right).applyInPandas(keep, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def oracle(k: int = 5) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}
"""
