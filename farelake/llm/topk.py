"""Exact top-k by inner product with buckets of like norms.

Candidates are dealt into buckets by their length (norm), and large buckets into blocks of bounded size. A first pass
over the bucket of the longest vectors gives every query a lower bound for its k-th score. A block can then only add
something for a query if the product of the lengths reaches that bound; the bound divided by that product is the least
cosine that counts there. Where this local threshold is high, candidates are pruned by coordinates: the query's
largest coordinates confine those of any vector within that angle. Where it is low, they are pruned by length alone.
What is left is verified by its exact integer product.

Queries travel in packed chunks, once to every block that they can gain from. There they meet the block's rows only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.session import materialize

_BUCKETS = 48
_BLOCK_ROWS = 4096
_CHUNK_QUERIES = 256
_COSINE = 0.35  # local thresholds from here on are pruned by coordinates
_FOCUS = 3
_MOST = 2**63 - 1
_NO_BOUND = -_MOST

_FOUND = "query_id long, vec_id long, score long"


def integer_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v, norm): components as floor(256 x), those beyond 64 bits as the nearest 64-bit integer. Rows without an
    id, and vectors that are null or hold a null or non-finite component, are left out."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    valid = table.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = valid.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x.cast("double"))))


def _matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Rows of a list column; shorter ones are filled with 0."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    width = max([width or 0, *sizes.tolist()]) if len(sizes) else width or 0
    result = np.zeros((len(sizes), width), np.int64)
    result[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return result


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where that is exact, else in integers of sufficient size. A product beyond
    64 bits counts as the greatest or least there is."""
    most = float(np.abs(rows.astype(np.float64)).max(initial=0)) * float(np.abs(query.astype(np.float64)).max(initial=0)) * max(1, len(query))
    if most < 2**53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if most < 2**63:
        return rows @ query
    if len(rows) > 1:  # a few long vectors do not make the others slow
        large = np.abs(rows.astype(np.float64)).max(axis=1, initial=0) * most >= 2**62 * np.abs(rows.astype(np.float64)).max()
        if not large.all():
            scores = np.empty(len(rows), np.int64)
            for some in (large, ~large):
                scores[some] = _products(rows[some], query)
            return scores
    exact = (sum(a * b for a, b in zip(row, query.tolist(), strict=True)) for row in rows.tolist())
    return np.array([max(-_MOST, min(_MOST, score)) for score in exact], np.int64)


def _search(block: pa.Table, chunks: pa.Table, k: int) -> pa.Table:
    """The best ``k`` of a block's candidates for each query of the chunks, as far as they reach the query's bound."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if block.num_rows and chunks.num_rows:
        norms = block.column("norm").to_numpy()
        order = np.argsort(-norms, kind="stable")
        norms, ids, vectors = norms[order], block.column("vec_id").to_numpy()[order], _matrix(block.column("v"))[order]
        unit = vectors / np.maximum(norms, 1e-300)[:, None]
        for chunk in chunks.to_pylist():
            query_ids = np.frombuffer(chunk["ids"], np.int64)
            bounds = np.frombuffer(chunk["bounds"], np.int64)
            queries = np.frombuffer(chunk["vectors"], np.int64).reshape(len(query_ids), -1)
            for query_id, bound, query in zip(query_ids.tolist(), bounds.tolist(), queries, strict=True):
                found.append(_one(query_id, bound, query, ids, vectors, unit, norms, k))
    columns = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3)]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))


def _one(query_id, bound, query, ids, vectors, unit, norms, k):
    width = min(len(query), vectors.shape[1])  # missing components count as 0
    query = query[:width]
    length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
    rows = np.arange(len(ids))
    if bound > 0 and length > 0:
        # By length: a product is at most that of the lengths.
        rows = rows[: int(np.searchsorted(-norms, -(bound / length) * (1 - 1e-9), "right"))]
        if len(rows):
            cosine = bound / (length * norms[0])
            if _COSINE <= cosine <= 1:
                direction = query / length
                for f in np.argsort(-np.abs(direction))[:_FOCUS]:
                    spread = np.sqrt(max(0.0, 1 - cosine**2) * max(0.0, 1 - direction[f] ** 2)) + 1e-9
                    value = unit[rows, f]
                    low, high = cosine * direction[f] - spread, cosine * direction[f] + spread
                    # A cosine above the threshold confines the coordinate less far on the query's own side.
                    low, high = (low, np.inf) if direction[f] >= 0 else (-np.inf, high)
                    rows = rows[(value >= low) & (value <= high)]
    rows = rows[ids[rows] != query_id]
    scores = _products(vectors[rows][:, :width], query)
    keep = scores >= bound
    rows, scores = rows[keep], scores[keep]
    if len(rows) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least  # with all ties, of which the smallest ids go on
        rows, scores = rows[keep], scores[keep]
    best = np.lexsort((ids[rows], -scores))[:k]
    return np.full(len(best), query_id, np.int64), ids[rows][best], scores[best]


def _need(queries: DataFrame) -> DataFrame:
    """``need``: the least norm of a candidate that can reach the query's bound. A zero query scores 0 everywhere; without
    a positive bound every length matters."""
    least = F.col("bound") / F.greatest("norm", F.lit(1e-300)) * (1 - 1e-9)
    return queries.withColumn("need", F.when((F.col("bound") > 0) & (F.col("norm") > 0), least).otherwise(0.0))


def _level(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts, at most 47, are at or below the value."""
    return sum((F.when(value >= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))


def _packed(queries: DataFrame, chunks: int) -> DataFrame:
    """Queries (vec_id, v, norm, bound) in packed chunks; ``reach``: the least candidate norm that any of them needs.

    Queries of like needs go together, so that one that needs short candidates does not take others there.
    """

    def pack(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("v"))
        return pa.table(
            {
                "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
                "bounds": pa.array([table.column("bound").to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
                "reach": [pc.min(table.column("need")).as_py()],
            }
        )

    needing = _need(queries)
    share = [i / _BUCKETS for i in range(1, _BUCKETS)]
    cuts = sorted(set(needing.agg(F.percentile_approx("need", share, 10_000)).first()[0] or [])) if chunks > 1 else []
    salts = max(1, -(-chunks // (len(cuts) + 1)))
    dealt = needing.withColumns({"_level": _level(F.col("need"), cuts), "_salt": F.pmod(F.xxhash64("vec_id"), F.lit(salts))})
    return dealt.groupBy("_level", "_salt").applyInArrow(pack, "ids binary, bounds binary, vectors binary, reach double")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` highest integer inner products of every query with all other rows.

    ``vectors``: (vec_id, v, norm) of ``integer_vectors``. Returns query_id, rank (from 1), vec_id, score; ties go to the
    smaller vec_id; all candidates if there are fewer. A query's own id is no candidate, also where rows repeat it;
    a repeated query is one query, a repeated candidate takes several ranks. Vectors of other lengths count as filled
    with 0. A score beyond 64 bits is the greatest or least 64-bit integer (but -2**63 + 1), so that such scores tie. An
    empty table gives no rows; columns other than vec_id and the vector are ignored.
    """
    stored = materialize(vectors, "vectors")
    share = [i / _BUCKETS for i in range(1, _BUCKETS)]
    row = stored.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("norm", share, 10_000).alias("cuts")).first()
    cuts = sorted(set(row["cuts"] or []))
    dealt = stored.withColumn("_bucket", _level(F.col("norm"), cuts))
    sizes = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most")).collect()  # one row per bucket
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = {r["_bucket"]: -(-r["n"] // _BLOCK_ROWS) for r in sizes}
    salt = F.element_at(F.create_map(*[F.lit(x).cast("long") for p in blocks.items() for x in p]), F.col("_bucket").cast("long"))
    dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "norm"), salt).cast("int"))
    top = max(blocks)

    queries = stored.where(is_query).dropDuplicates(["vec_id"])
    chunks = max(1, -(-queries.count() // _CHUNK_QUERIES))

    def meet(candidates: DataFrame, asked: DataFrame, among: list) -> DataFrame:
        places = F.array(*[F.struct(F.lit(r["_bucket"]).alias("_bucket"), F.lit(r["most"]).alias("most"), F.lit(blocks[r["_bucket"]]).alias("n")) for r in among])
        sent = asked.select("ids", "bounds", "vectors", "reach", F.explode(places).alias("p")).where(F.col("p.most") >= F.col("reach"))
        sent = sent.select("ids", "bounds", "vectors", F.col("p._bucket").alias("_bucket"), F.explode(F.sequence(F.lit(0), (F.col("p.n") - 1).cast("int"))).alias("_salt"))
        return candidates.groupBy("_bucket", "_salt").cogroup(sent.groupBy("_bucket", "_salt")).applyInArrow(lambda a, b: _search(a, b, k), _FOUND)

    unbound = queries.withColumn("bound", F.lit(_NO_BOUND).cast("long"))
    first = meet(dealt.where(F.col("_bucket") == top), _packed(unbound, chunks), [r for r in sizes if r["_bucket"] == top])
    first = materialize(first, "first-bucket")
    # Each block gave its best k, so the k-th of a query among all of them is a bound.
    by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    kth = first.withColumn("r", F.row_number().over(by_query)).where(F.col("r") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    bounded = queries.join(kth, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(_NO_BOUND).cast("long")))
    others = [r for r in sizes if r["_bucket"] != top]
    found = first
    if others:
        found = first.unionByName(meet(dealt.where(F.col("_bucket") != top), _packed(bounded, chunks), others))
    ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_topk(spark, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP6_SQL = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM valid q JOIN valid c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""
