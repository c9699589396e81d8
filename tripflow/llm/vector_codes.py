"""Vector codes by product quantisation, with Lloyd rounds over cover trees.

Vectors become integers and are cut into equal parts; each part position has a
codebook of its own. Every block of rows gets one cover tree for each part, built
once by the task that reads the rows and kept in the shared folder: a node's
children are points of the node more than half its radius apart, each point below
a child is within half the radius of it, and the points below a node are one
stretch of the block's order, so cumulative sums give the sum of any subtree.

A round walks the trees level by level. Where the entry nearest to a node's point
is nearer than any other by more than twice the node's radius, the triangle
inequality gives it all points below, in one subtraction of cumulative sums. Only
ambiguous nodes go down, at last to exact comparisons of single points. Distances
are integers throughout, so ties and sums are exact and reruns agree. Between
rounds, sums and counts of (part, entry, position) are added up by Spark; only
the codebooks, whose size does not depend on the data, reach the driver.

Defined results: vectors that are NULL or empty, or hold a NULL or non-finite
component, take no part, nor do vectors whose length is no multiple of the parts
or is not that of the first vector. Rows are in the order of the id (NULL last),
then of the vector; rows that repeat an id are coded one by one, and equal rows
may start equal entries, of which the lower index is used. With fewer rows than
entries every row starts one. NULL labels are one label. An empty table gives an
empty table. Components so large that squared distances would not fit a long
raise ``ValueError``. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow.llm.words import written
from tripflow.session import ship_package

#: Rows of one tree, and points that a node without children may hold.
BLOCK_ROWS = 8192
LEAF_POINTS = 16
#: Copies of each label's sum, so that a frequent label is several join keys.
LABEL_SALT = 32
#: Up to here a sum of squares is exact in a double.
_EXACT = 1 << 53


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def squares(a: np.ndarray, b: np.ndarray, fit: bool) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``; ``fit``:
    every term is exact in a double, so a matrix product may be used."""
    if fit:
        a, b = a.astype(np.float64), b.astype(np.float64)
        near = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
        return near.astype(np.int64)
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for k in range(a.shape[1]):
        out += (a[:, k, None] - b[None, :, k]) ** 2
    return out


class Tree:
    """Cover tree of a block's points: ``order`` of the points, and of every node
    its stretch [start, end) of them, its point, radius and children."""

    NODES = ("start", "end", "center", "child", "children")

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.points, self.order, self.nodes, self.radius = points[order], order, nodes, radius
        self.start, self.end, self.center, self.child, self.children = nodes.astype(np.int64)
        self.sums = np.zeros((len(points) + 1, points.shape[1]), dtype=np.int64)
        np.cumsum(self.points, axis=0, out=self.sums[1:])

    @classmethod
    def build(cls, points: np.ndarray) -> "Tree":
        work = points.astype(np.float64)

        def far(at: int, idx: np.ndarray) -> np.ndarray:
            d = work[idx] - work[at]
            return np.sqrt(np.einsum("ij,ij->i", d, d)) * (1 + 1e-12)

        order = np.arange(len(points))
        start, end, center, radius, child, children = [0], [len(points)], [0], [0.0], [0], [0]
        away = [far(0, order)]
        radius[0] = float(away[0].max())
        node = 0
        while node < len(start):
            lo, hi, r = start[node], end[node], radius[node] / 2
            d, away[node] = away[node], None
            if hi - lo > LEAF_POINTS and r > 0:
                child[node] = len(start)
                rest, at, place = order[lo:hi].copy(), center[node], lo
                while len(rest):
                    mine = d <= r
                    own, dist = rest[mine], d[mine]
                    order[place: place + len(own)] = own
                    start.append(place)
                    place += len(own)
                    end.append(place)
                    center.append(int(at))
                    radius.append(float(dist.max()))
                    away.append(dist)
                    child.append(0)
                    children.append(0)
                    rest = rest[~mine]
                    if len(rest):
                        at = rest[0]
                        d = far(at, rest)
                children[node] = len(start) - child[node]
            node += 1
        inverse = np.empty(len(order), dtype=np.int64)
        inverse[order] = np.arange(len(order))
        nodes = np.array([start, end, inverse[center], child, children], dtype=np.int32)
        return cls(points, order, nodes, np.array(radius))

    def assign(self, entries: np.ndarray, fit: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, entry) of stretches of points whose nearest entry it is."""
        active = np.zeros(1, dtype=np.int64)
        while len(active):
            near = squares(self.points[self.center[active]], entries, fit)
            best = near.argmin(axis=1)
            row = np.arange(len(active))
            first = np.sqrt(near[row, best].astype(np.float64))
            near[row, best] = np.iinfo(np.int64).max
            second = np.sqrt(near.min(axis=1).astype(np.float64))
            # Equal points stand or fall together, ties and all.
            whole = (second - first > 2 * self.radius[active] + 1e-9 * (second + 1)) | (self.radius[active] == 0)
            yield self.start[active[whole]], self.end[active[whole]], best[whole]
            active = active[~whole]
            leaf = self.children[active] == 0
            size = self.end[active[leaf]] - self.start[active[leaf]]
            at = np.repeat(self.start[active[leaf]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if len(at):
                yield at, at + 1, squares(self.points[at], entries, fit).argmin(axis=1)
            down = active[~leaf]
            n = self.children[down]
            active = np.repeat(self.child[down], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


_BLOCK = "ids array<{id}>, labels array<{label}>, points binary, trees array<struct<place: binary, nodes: binary, radius: binary>>"


def plant(schema, dim: int, parts: int, kind: str):
    """Blocks of rows (_id, _label, _v), with a tree of each part."""
    width = dim // parts

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def block(held):
            ids, labels, v = (pa.concat_arrays([b.column(k) for b in held]) for k in range(3))
            points = np.floor(v.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * 1024).astype(np.int64).reshape(len(ids), dim)
            trees = [Tree.build(points[:, p * width: (p + 1) * width]) for p in range(parts)]
            whole = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(whole, ids), pa.ListArray.from_arrays(whole, labels),
                pa.array([points.astype(kind).tobytes()], pa.binary()),
                pa.array([[{"place": t.order.astype(np.int32).tobytes(), "nodes": t.nodes.tobytes(), "radius": t.radius.tobytes()} for t in trees]], arrow.field("trees").type),
            ], schema=arrow)

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, BLOCK_ROWS - n)
                batch = batch.slice(take.num_rows)
                held.append(take)
                n += take.num_rows
                if n == BLOCK_ROWS:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    return run


def grown(row: dict, dim: int, kind: str) -> Iterator[Tree]:
    """The trees of a block, part by part."""
    points = np.frombuffer(row["points"], kind).reshape(-1, dim).astype(np.int64)
    width = dim // len(row["trees"])
    for p, t in enumerate(row["trees"]):
        nodes = np.frombuffer(t["nodes"], np.int32).reshape(len(Tree.NODES), -1)
        yield Tree(points[:, p * width: (p + 1) * width], np.frombuffer(t["place"], np.int32), nodes, np.frombuffer(t["radius"]))


def gather(books: np.ndarray, dim: int, kind: str, fit: bool):
    """Sum and count of what each entry gets in a task: (part, entry, position,
    total, count)."""
    def run(batches):
        import pyarrow as pa

        parts, entries, width = books.shape
        sums, counts = np.zeros(books.shape, dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for p, tree in enumerate(grown(row, dim, kind)):
                    for start, end, entry in tree.assign(books[p], fit):
                        np.add.at(sums[p], entry, tree.sums[end] - tree.sums[start])
                        np.add.at(counts[p], entry, end - start)
        part, entry = np.nonzero(counts)
        n = len(part)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(np.repeat(part, width), pa.int32()), "entry": pa.array(np.repeat(entry, width), pa.int32()),
            "position": pa.array(np.tile(np.arange(width), n), pa.int32()),
            "total": sums[part, entry].ravel(), "count": np.repeat(counts[part, entry], width),
        })

    return run


def label_rows(books: np.ndarray, dim: int, kind: str, fit: bool, schema):
    """Each row's entry of every part, and its squared distance from them."""
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        for batch in batches:
            for k, row in enumerate(batch.select(["points", "trees"]).to_pylist()):
                ids, labels = (batch.column(c).slice(k, 1).flatten() for c in (0, 1))
                codes, error = np.zeros((len(ids), len(books)), dtype=np.int32), np.zeros(len(ids), dtype=np.int64)
                for p, tree in enumerate(grown(row, dim, kind)):
                    of = np.zeros(len(ids), dtype=np.int64)
                    for start, end, entry in tree.assign(books[p], fit):
                        n = end - start
                        of[np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())] = np.repeat(entry, n)
                    codes[tree.order, p] = of
                    error[tree.order] += ((tree.points - books[p][of]) ** 2).sum(axis=1)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * len(books), pa.int32()), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([ids, labels, flat, pa.array(error)], schema=to_arrow_schema(schema))

    return run


def start_of(rows: DataFrame, entries: int, parts: int) -> tuple[np.ndarray, int] | None:
    """The first codebooks (part, entry, position) and the length of vectors."""
    order = F.col("_id").asc_nulls_last(), F.col("_v").asc()
    first = rows.orderBy(*order).select(F.size("_v")).first()
    if first is None:
        return None
    same = rows.where(F.size("_v") == first[0])
    # The codebooks' size is a parameter, whatever the number of rows.
    chosen = [r[0] for r in same.orderBy(*order).limit(entries).select("_v").collect()]
    books = np.floor(np.array(chosen, dtype=np.float64) * 1024)
    return books.reshape(len(chosen), parts, -1).transpose(1, 0, 2), first[0]


def encode(
    vectors: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """``id_col``, ``label_col``, ``codes`` (an entry for each part) and ``error``
    (squared distance from them) of every row; and the final codebooks by part,
    entry and position."""
    spark = vectors.sparkSession
    ship_package(spark)
    ids, labels = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))
    out = f"_id {ids}, _label {labels}, codes array<int>, error long"
    named = lambda df: df.select(F.col("_id").alias(id_col), F.col("_label").alias(label_col), "codes", "error")
    rows = (
        vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).cast("array<double>").alias("_v"))
        .where(usable(F.col("_v")) & (F.size("_v") % parts == 0))
    )
    began = start_of(rows, entries, parts)
    if began is None:
        return named(spark.createDataFrame([], out)), np.zeros((parts, 0, 0), dtype=np.int64)
    books, dim = began
    rows = rows.where(F.size("_v") == dim)
    most = rows.agg(F.max(F.array_max(F.transform("_v", lambda x: F.abs(x))))).first()[0] * 1024 + 1
    if 4 * dim * most * most >= 1 << 63:
        raise ValueError(f"a component of {most / 1024:g}: squared distances of the vectors would pass a long")
    books, fit = books.astype(np.int64), 4 * (dim // parts) * most * most < _EXACT
    kind = "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "int64"
    block = StructType.fromDDL(_BLOCK.format(id=ids, label=labels))
    trees = written(rows.mapInArrow(plant(block, dim, parts, kind), block), "code_trees")
    for _ in range(rounds):
        got = trees.select("points", "trees").mapInArrow(gather(books, dim, kind, fit), "part int, entry int, position int, total long, count long")
        got = got.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("count").alias("count")).toPandas()
        books = books.copy()
        books[got["part"], got["entry"], got["position"]] = got["total"].to_numpy() // got["count"].to_numpy()
    schema = StructType.fromDDL(out)
    return named(trees.mapInArrow(label_rows(books, dim, kind, fit, schema), schema)), books


def book_text(books: np.ndarray) -> str:
    """All components by part, entry and position within the part."""
    return ",".join(map(str, books.ravel().tolist()))


def code_text(codes: Column) -> Column:
    """Two hex digits for each part, in order."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 2, "0")), ""))


def with_label_error(coded: DataFrame, label_col: str = "label", error_col: str = "error") -> DataFrame:
    """``coded`` with ``label_error``, the sum over all rows of the label. Labels'
    sums are copied ``LABEL_SALT`` times, and rows ask one of the copies each."""
    coded = written(coded, "vector_codes")
    sums = coded.groupBy(F.col(label_col).alias("_l")).agg(F.sum(error_col).alias("label_error"))
    copies = sums.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALT - 1))))
    dealt = coded.withColumn("_s", F.pmod(F.monotonically_increasing_id(), F.lit(LABEL_SALT)).cast("int"))
    on = dealt[label_col].eqNullSafe(copies["_l"]) & (dealt["_s"] == copies["_s"])
    return dealt.join(copies.hint("merge"), on).select(*[dealt[c] for c in coded.columns], "label_error")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(book_text(books).encode()).hexdigest()


def sql(entries: int = 256, parts: int = 4, rounds: int = 4) -> str:
    """The same in SQL, of ``embeddings``: every part against every entry."""
    steps = [f"""
v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), t AS MATERIALIZED (
  SELECT r, p, x, list_inner_product(x, x) AS xx
  FROM (SELECT r, p, e[p * len(e) // {parts} + 1 : (p + 1) * len(e) // {parts}] AS x FROM v, range({parts}) parts(p))
), c0 AS MATERIALIZED (SELECT p, r - 1 AS j, x AS y, xx AS yy FROM t WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, p, x, min((xx - 2 * list_inner_product(x, y) + yy)::BIGINT * {entries} + j) AS m
  FROM t JOIN c{k} USING (p) GROUP BY r, p, x
)""")
        if k < rounds:
            steps.append(f"""
s{k} AS (
  SELECT p, j, list(floor(total / n) ORDER BY i) AS z FROM (
    SELECT p, m % {entries} AS j, i, sum(x[i + 1]) AS total, count(*) AS n FROM a{k}, range(4096) pos(i) WHERE i < len(x) GROUP BY ALL
  ) GROUP BY p, j
), c{k + 1} AS MATERIALIZED (
  SELECT p, j, y, list_inner_product(y, y) AS yy FROM (SELECT p, j, coalesce(z, y) AS y FROM c{k} LEFT JOIN s{k} USING (p, j))
)""")
    return "WITH " + ",".join(steps) + f""",
d AS (
  SELECT r, string_agg(printf('%02x', (m % {entries})::INTEGER), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error FROM a{rounds} GROUP BY r
), b AS (
  SELECT sha256(string_agg(array_to_string(list_transform(y, lambda u: u::BIGINT), ','), ',' ORDER BY p, j)) AS h FROM c{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM v JOIN d USING (r) CROSS JOIN b
"""


SQL = sql()
