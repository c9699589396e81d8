"""Nearest neighbours by a block matrix join.

Vectors are packed into tiles of about ``TILE_ROWS`` rows, tiles into sides of about
``SIDE_BYTES``. A side of queries meets a side of candidates in one task, tile by
tile: each row is rounded to int8 with a scale of its own, once a task; the int8
product and the norms of both rounding errors bound each inner product, and a pair
whose upper bound is below the k-th best lower bound is out. Survivors are computed
in double precision from the original vectors and merged into the k best of each
query (sorted runs of k, which serve as heaps); those of different tasks merge by
rank. Nothing is approximate about the result: the bounds never drop a true
neighbour. Each side is sent once for each side it meets, so wide sides keep down
what moves; the product of two tiles is what bounds memory.

Defined results: vectors that are NULL, empty, all zero or hold a NULL or
non-finite component take no part, nor do rows without an id; vectors meet only
vectors of their length; of rows that repeat an id the smallest vector of each
length counts, by the order of components; equal scores rank by the smaller id;
fewer candidates than k give fewer rows; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.session import ship_package

TILE_ROWS = 1024
#: Vectors, as doubles, of the queries and of the candidates of one task.
SIDE_BYTES = 16 << 20
_TILE = "dim int, side long, ids binary, vectors binary"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def tiles(rows: DataFrame, n_tiles: int, n_sides: int) -> DataFrame:
    """Rows (dim, _id, _v) packed by a hash of the id; tiles are dealt to sides."""

    def pack(table):
        import pyarrow as pa

        ids = table.column("_id").to_numpy()
        dim = table.column("dim")[0].as_py()
        flat = table.column("_v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "side": pa.array([table.column("tile")[0].as_py() % n_sides], pa.int64()),
            "ids": [ids.tobytes()], "vectors": [flat.astype(np.float64).tobytes()],
        })

    return rows.withColumn("tile", F.pmod(F.xxhash64("_id"), F.lit(n_tiles))).groupBy("dim", "tile").applyInArrow(pack, _TILE)


class Tile:
    def __init__(self, dim: int, ids: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.exact = np.frombuffer(vectors, dtype=np.float64).reshape(len(self.ids), dim)
        scale = np.abs(self.exact).max(axis=1) / 127
        self.small = np.rint(self.exact / scale[:, None]).astype(np.int8)
        near = self.small * scale[:, None]
        norm = lambda m: np.sqrt(np.einsum("ij,ij->i", m, m))
        self.scale, self.norm, self.near_norm, self.error = scale, norm(self.exact), norm(near), norm(self.exact - near)


def survivors(q: Tile, c: Tile, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose upper bound reaches the k-th best lower bound of the tile and
    ``floor``, the k-th best exact score so far."""
    # int8 products summed over a row fit a double (a float up to 1,040 dims).
    kind = np.float32 if q.small.shape[1] <= 1040 else np.float64
    product = (q.small.astype(kind) @ c.small.astype(kind).T) * np.outer(q.scale, c.scale)
    slack = np.outer(q.error, c.norm) + np.outer(q.near_norm, c.error)
    slack += 1e-9 * np.outer(q.norm, c.norm)  # rounding of the bounds themselves
    own = q.ids[:, None] == c.ids
    low = np.where(own, -np.inf, product - slack)
    if low.shape[1] > k:
        floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
    return np.nonzero((product + slack >= floor[:, None]) & ~own)


def exact_scores(q: Tile, c: Tile, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Inner products summed in the order of the components."""
    out = np.zeros(len(at))
    for d in range(q.exact.shape[1]):
        out += q.exact[at, d] * c.exact[to, d]
    return out


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The k best of each query: largest score, then smallest id."""
    order = np.lexsort([ids, -scores, query])
    query, ids, scores = query[order], ids[order], scores[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], ids[rank < k], scores[rank < k]


def neighbours(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's
    k nearest rows by inner product. ``is_query`` is over ``id_col``."""
    ship_package(vectors.sparkSession)
    known = (
        vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"), is_query.alias("_q"))
        .withColumn("dim", F.size("_v"))
    )
    asks = F.coalesce(F.col("_q").cast("int"), F.lit(0))
    size = known.agg(F.count("*"), F.sum("dim"), F.sum(asks), F.sum(asks * F.col("dim"))).first()
    n_tiles, n_asked_tiles = (max(1, -(-(rows or 0) // TILE_ROWS)) for rows in (size[0], size[2]))
    n_sides, n_asked = (max(1, -(-(numbers or 0) * 8 // SIDE_BYTES)) for numbers in (size[1], size[3]))
    # Combined before the shuffle, so rows of one id never gather in a task.
    rows = known.groupBy("dim", "_id").agg(F.min("_v").alias("_v"), F.max("_q").alias("_q"))
    sequence = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = tiles(rows.where("_q").drop("_q"), n_asked_tiles, n_asked).withColumnRenamed("side", "asked").withColumn("part", sequence(n_sides))
    right = tiles(rows.drop("_q"), n_tiles, n_sides).withColumnRenamed("side", "part").withColumn("asked", sequence(n_asked))

    def meet(ours, theirs):
        import pyarrow as pa

        queries = [Tile(row["dim"], row["ids"], row["vectors"]) for row in ours.to_pylist()]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) for _ in queries]
        floor = [np.full(len(q.ids), -np.inf) for q in queries]
        for i in range(theirs.num_rows if queries else 0):
            c = Tile(theirs.column("dim")[i].as_py(), theirs.column("ids")[i].as_py(), theirs.column("vectors")[i].as_py())
            for j, q in enumerate(queries):
                at, to = survivors(q, c, floor[j], k)
                new = at, c.ids[to], exact_scores(q, c, at, to)
                found[j] = best(*(np.concatenate(x) for x in zip(found[j], new, strict=True)), k)
                ends = np.searchsorted(found[j][0], np.arange(len(q.ids)), side="right")
                full = np.bincount(found[j][0], minlength=len(q.ids)) >= k
                floor[j][full] = found[j][2][ends[full] - 1]
        out = [pa.table({"query_id": q.ids[f[0]], "vec_id": f[1], "score": f[2]}) for q, f in zip(queries, found, strict=True)]
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.concat_tables([*out, empty])

    heaps = (
        left.groupBy("dim", "asked", "part")
        .cogroup(right.groupBy("dim", "asked", "part"))
        .applyInArrow(meet, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return heaps.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
