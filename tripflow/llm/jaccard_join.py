"""N-gram Jaccard join by a blocked sparse matrix product.

Documents are rows, word n-grams columns of a 0/1 matrix; overlaps are the
entries of its product with itself. The columns are cut into k blocks by hash, k
by the size class of the rows. Two rows of sizes a and b whose similarity
reaches p % differ in at most (a + b) (100 - p) / (100 + p) columns, so at least
k less that many blocks of theirs are equal. A row's block is one number, its
signature; a row with too few signatures that another row has too is out, and
of the others only the rarest ones are looked at, as many as the bound leaves
open. Pairs that meet in one of those are multiplied: overlaps are counted over
the rows themselves, and pairs below p % are dropped. No pair that reaches p %
is lost, whatever the data.

Equal rows are one row (a class) from the start. In a large group of similar
rows each is first set against the one that shares most signatures with all;
what that connects needs no further pairs, and the rest is set against the best of
another group, as long as that connects anything (``HUB_ROUNDS`` at most). Only rows
of different groups are multiplied then: two groups that share a signature are one
block, into which each of their rows that meet goes once, however many signatures
they share. Where more than ``MANY`` groups share a signature, the rows of the
signature are multiplied by squares instead; signatures with the same rows are one.
Blocks and squares hold at most ``SQUARE`` rows and ``SQUARE_GRAMS`` n-grams a side
(or one longer row), and return links, never all pairs.

Defined results: NULL or empty text, or one without words, has the empty set
and links with nothing; a text of fewer words than n is one n-gram; rows that
repeat an id are one document with all their links; a NULL id links with nothing
and has no component; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.components import connected
from tripflow.llm.lm_score import pack_keys, unpack_keys
from tripflow.llm.words import U64, mix, pieces, text_buffer, word_hashes, written
from tripflow.session import ship_package

KEY_BITS = 48
#: Text of one block of rows, whose signatures travel together.
BLOCK_BYTES = 32 << 20
#: Column blocks for each difference that the bound allows.
SPARE = 1.25
_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | U64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, flat, with offsets."""
    h, by_text = word_hashes(data, offsets)
    words = np.diff(by_text)
    doc = np.repeat(np.arange(len(words)), words)
    size = max(len(h) - n + 1, 0)
    gram = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        gram += h[j: j + size] * _ODD[j]
    whole = doc[:size] == doc[n - 1: n - 1 + size]
    grams, owner = [mix(gram[whole])], [doc[:size][whole]]
    for d in np.flatnonzero((words > 0) & (words < n)):
        w = h[by_text[d]: by_text[d + 1]]
        grams.append(mix((w * _ODD[: len(w)]).sum(keepdims=True) + _ODD[32 + len(w) % 32]))
        owner.append(np.array([d]))
    gram, owner = np.concatenate(grams), np.concatenate(owner)
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    first = np.ones(len(gram), dtype=bool)
    first[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[first], owner[first]
    return gram, np.searchsorted(owner, np.arange(len(words) + 1))


def run_sums(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[U64(0)], np.cumsum(x, dtype=np.uint64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


class Bounds:
    """Size classes, and what a similarity of at least p % asks of two sizes."""

    def __init__(self, p: int):
        self.p = p
        top = [1]
        while top[-1] < 1 << 40:
            top.append(max(top[-1] + 1, top[-1] * 10000 // (p * p)))
        self.top = np.array(top)
        self.blocks = np.ceil(SPARE * ((100 - p) * 2 * self.top // (100 + p) + 1)).astype(np.int64)

    def of(self, sizes: np.ndarray, up: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, number of blocks, and least number of equal blocks, in the own
        class (``up`` 0) or the next one, as the smaller row (1). Zero blocks
        where the next class is out of reach."""
        own = np.searchsorted(self.top, sizes)
        reach = sizes * 100 // self.p
        use = (sizes > 0) if not up else (sizes > 0) & (reach > self.top[own])
        c = np.minimum(own + up, len(self.top) - 1)
        differ = (100 - self.p) * (sizes + np.minimum(reach, self.top[c])) // (100 + self.p)
        k = np.where(use, self.blocks[c], 0)
        return c, k, np.maximum(k - differ, 1)


def signatures(gram: np.ndarray, offsets: np.ndarray, bounds: Bounds, up: int):
    """One number for each (row, column block), and each row's offsets."""
    sizes = np.diff(offsets)
    c, k, _ = bounds.of(sizes, up)
    ends = np.concatenate([[0], np.cumsum(k)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    live = k[owner] > 0
    owner, g = owner[live], gram[live]
    block = (mix(g ^ _ODD[40]) >> U64(32)) * k[owner].astype(np.uint64) >> U64(32)
    at = ends[owner] + block.astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, g = at[order], mix(g + _ODD[41])[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
    total = np.zeros(ends[-1], dtype=np.uint64)
    if len(at):
        total[at[first]] = np.add.reduceat(g, first)
    row = np.repeat(np.arange(len(sizes)), k)
    place = np.arange(ends[-1]) - ends[row]
    return mix(total + place.astype(np.uint64) * _ODD[42] + c[row].astype(np.uint64) * _ODD[43]) >> U64(64 - KEY_BITS), row


def _sets(n: int, column: str = "_text"):
    """(id, sorted n-gram hashes) of documents."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in pieces(offsets):
                gram, ends = shingles(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], n)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([gram[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
                ], names=["_id", "grams"])

    return run


# Rows of the first pass, by kind: members (ids with sizes and fingerprints of a
# block's documents), shared (signatures that several rows of a block have, with
# those rows), sent (a shard's part of the block's signatures).
_MEMBERS, _SHARED, _SENT = -1, -2, 0
_FIRST = "kind int, block long, ids array<long>, n array<long>, f1 array<long>, f2 array<long>, keys binary, rows binary, times binary"


def _first_pass(n: int, p: int, bits: int):
    def run(batches):
        import pyarrow as pa

        bounds = Bounds(p)
        kinds = [pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 4, *[pa.binary()] * 3]
        names = [x.split()[0] for x in _FIRST.split(", ")]
        task = TaskContext.get().partitionId() << 24
        seq = 0

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        def flush(held):
            nonlocal seq
            block = task + seq
            seq += 1
            ids = pa.concat_arrays([x[0] for x in held])
            sizes, f1, f2 = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
            yield table([(_MEMBERS, block, ids.to_pylist(), sizes.tolist(), f1.view(np.int64).tolist(), f2.view(np.int64).tolist(), None, None, None)])
            # Rows of equal fingerprints send one set of signatures, that of the
            # first with an id.
            known = np.flatnonzero(np.asarray(ids.is_valid()))
            leads = np.zeros(len(sizes), dtype=bool)
            if len(known):
                _, lead = np.unique(np.stack([f1, f2])[:, known], axis=1, return_index=True)
                leads[known[lead]] = True
            keys, rows, base = [], [], 0
            for _, s, _, _, sigs in held:
                for up, (key, row) in enumerate(sigs):
                    use = leads[base + row]
                    keys.append(key[use])
                    rows.append((base + row[use]) * 2 + up)
                base += len(s)
            key, row = np.concatenate(keys), np.concatenate(rows)
            order = np.argsort(key, kind="stable")
            key, row = key[order], row[order].astype(np.uint32)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            times = np.diff(np.append(first, len(key)))
            several = np.repeat(times > 1, times)
            if several.any():
                yield table([(_SHARED, block, None, None, None, None, key[several].tobytes(), row[several].tobytes(), None)])
            key, row = key[first], row[first]
            edges = np.searchsorted((key >> U64(KEY_BITS - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64), np.arange((1 << bits) + 1))
            out = []
            for s in np.flatnonzero(np.diff(edges)).tolist():
                a, b = edges[s], edges[s + 1]
                out.append((_SENT + s, block, None, None, None, None, pack_keys(key[a:b] - U64(s << (KEY_BITS - bits))), row[a:b].tobytes(), np.minimum(times[a:b], 255).astype(np.uint8).tobytes()))
            if out:
                yield table(out)

        held, size = [], 0
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in pieces(offsets):
                gram, ends = shingles(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], n)
                sizes = np.diff(ends)
                f1, f2 = run_sums(mix(gram ^ _ODD[50]), ends), run_sums(mix(gram ^ _ODD[51]), ends)
                held.append((batch.column(0).slice(lo, hi - lo), sizes, f1, f2, [signatures(gram, ends, bounds, up) for up in (0, 1)]))
                size += int(offsets[hi] - offsets[lo])
                if size >= BLOCK_BYTES:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


_ANSWER = "block long, keys binary, rows binary, counts binary"


def _meet(bits: int):
    """A shard's signatures of all blocks: those found twice or more go back to
    their blocks, with how often they were found."""
    def run(key, table):
        import pyarrow as pa

        shard = key[0].as_py()
        rows = table.to_pylist()
        keys = [unpack_keys(r["keys"]) + U64(shard << (KEY_BITS - bits)) for r in rows]
        times = np.concatenate([np.frombuffer(r["times"], np.uint8) for r in rows]).astype(np.int64)
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(at, weights=times, minlength=len(distinct)).astype(np.int64)[at]
        out, done = [], 0
        for r, k in zip(rows, keys, strict=True):
            c = count[done: done + len(k)]
            done += len(k)
            if (c > 1).any():
                out.append((r["block"], k[c > 1].tobytes(), np.frombuffer(r["rows"], np.uint32)[c > 1].tobytes(), c[c > 1].astype(np.uint32).tobytes()))
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table({x.split()[0]: pa.array(c, t) for x, c, t in zip(_ANSWER.split(", "), cols, [pa.int64(), *[pa.binary()] * 3], strict=True)})

    return run


_ROWS = "id long, opened array<long>"


def _open(p: int):
    """Of each row that shares enough signatures the rarest ones, as many as the
    bound leaves open."""
    def run(own, answers):
        import pyarrow as pa

        bounds = Bounds(p)
        if not answers.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "opened": pa.array([], pa.list_(pa.int64()))})
        read = lambda t, c, kind: np.concatenate([np.frombuffer(x, kind) for x in t.column(c).to_pylist()])
        key, row, count = read(answers, "keys", np.uint64), read(answers, "rows", np.uint32), read(answers, "counts", np.uint32)
        members, shared = None, None
        for r in own.to_pylist():
            if r["kind"] == _MEMBERS:
                members = r
            else:
                shared = np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["rows"], np.uint32)
        if shared is not None:
            # A shared signature was sent for its first row; add the others.
            order = np.argsort(key, kind="stable")
            k2, r2 = shared
            at = order[np.searchsorted(key[order], k2)]
            other = row[at] != r2
            key, row, count = np.append(key, k2[other]), np.append(row, r2[other]), np.append(count, count[at][other])
        sizes = np.array(members["n"], dtype=np.int64)
        need = np.stack([bounds.of(sizes, up)[2] for up in (0, 1)], axis=1).ravel()
        order = np.lexsort((key, count, row))
        key, row = key[order].astype(np.int64), row[order].astype(np.int64)
        ends = np.searchsorted(row, np.arange(len(need) + 1))
        live = np.flatnonzero(np.diff(ends) >= need).tolist()
        return pa.table({
            "id": pa.array([members["ids"][r >> 1] for r in live], pa.int64()),
            "opened": pa.array([key[ends[r]: ends[r + 1] - need[r] + 1] for r in live], pa.list_(pa.int64())),
        })

    return run


#: Rounds of setting rows against the best of another group.
HUB_ROUNDS = 4
#: A signature of more groups than this is multiplied by squares.
MANY = 16
#: Rows of one side of a product, their n-grams, and columns taken at a time.
SQUARE = 1024
SQUARE_GRAMS = 1 << 21
COLUMNS = 4096


def overlaps(rows: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Product of two lists of rows' 0/1 matrices, some columns at a time. Columns
    that only one side has need no product."""
    key = np.concatenate([*rows, *others])
    row = np.repeat(np.arange(len(rows) + len(others)), [len(x) for x in (*rows, *others)])
    _, column = np.unique(key, return_inverse=True)
    left = row < len(rows)
    both = np.bincount(column[left], minlength=1)
    other = np.bincount(column[~left], minlength=1)
    width = max(len(both), len(other))
    use = (np.pad(both, (0, width - len(both))) > 0) & (np.pad(other, (0, width - len(other))) > 0)
    number = np.cumsum(use) - 1
    keep = use[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    product = np.zeros((len(rows), len(others)), dtype=np.float32)
    total = int(use.sum())
    for first in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((len(rows) + len(others), min(COLUMNS, total - first)), dtype=np.float32)
        part[row[a:b], column[a:b] - first] = 1
        product += part[: len(rows)] @ part[len(rows):].T
    return product


def linked_pairs(rows: list[np.ndarray], others: list[np.ndarray], p: int) -> np.ndarray:
    """Which rows reach p % with which others."""
    sizes, more = (np.array(list(map(len, x)), dtype=np.float64) for x in (rows, others))
    both = overlaps(rows, others).astype(np.float64)
    return 100 * both >= p * (sizes[:, None] + more - both)


def _square(p: int):
    """Multiplies the rows (node, side, grams) of a block or square; its links as
    links of each row with the smallest of its group. Rows of side 0 and 1 are
    multiplied with each other, rows of side 2 with all of theirs."""
    def run(table):
        import pyarrow as pa

        node, side = table.column("node").to_numpy(), table.column("side").to_numpy()
        grams = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        left, right = (np.flatnonzero(side != s) for s in (1, 0))
        linked = linked_pairs([grams[k] for k in left], [grams[k] for k in right], p)
        first = node.copy()
        while True:
            low = first.copy()
            a = np.where(linked, first[right][None, :], np.iinfo(np.int64).max)
            low[left] = np.minimum(low[left], a.min(axis=1, initial=np.iinfo(np.int64).max))
            b = np.where(linked, low[left][:, None], np.iinfo(np.int64).max)
            low[right] = np.minimum(low[right], b.min(axis=0, initial=np.iinfo(np.int64).max))
            if (low == first).all():
                break
            first = low
        other = first != node
        return pa.table({"a": first[other], "b": node[other]})

    return run


def _multiply(p: int):
    """Pairs of rows whose overlap reaches p % of their union."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= p * (len(x) + len(y) - common) and len(both) > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good, pa.bool_())], names=["a", "b", "linked"])

    return run


def sets_of(ids: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """The n-grams of the documents (_id, _text) that ``ids`` (_asked) names."""
    asked = ids.distinct().hint("merge")
    found = docs.join(asked, docs["_id"] == asked["_asked"], "left_semi")
    return written(found.mapInArrow(_sets(n), "_id long, grams binary"), "join_sets")


def product(pairs: DataFrame, sets: DataFrame, p: int) -> DataFrame:
    """``pairs`` (a, b) whose sets (_id, grams) reach p %."""
    left = sets.select(F.col("_id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("_id").alias("b"), F.col("grams").alias("gb"))
    rows = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "ga", "gb")
    return rows.mapInArrow(_multiply(p), "a long, b long, linked boolean").where("linked").select("a", "b").distinct()


def grouped(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """``rows`` with ``g``, the group of ``node`` so far (itself if in none)."""
    if groups is None:
        return rows.withColumn("g", F.col("node"))
    own = rows.join(groups.withColumnRenamed("id", "node").hint("merge"), "node", "left")
    return own.withColumn("g", F.coalesce("component", "node")).drop("component")


def across(shared: DataFrame, groups: DataFrame | None) -> DataFrame:
    """The rows of signatures that several groups share, and how many those are."""
    rows = grouped(shared, groups)
    several = rows.select("sig", "g").distinct().groupBy("sig").agg(F.count("*").alias("groups")).where("groups > 1")
    return rows.join(several.hint("merge"), "sig")


def hub_pairs(rows: DataFrame, tried: DataFrame | None) -> DataFrame:
    """(a, b): every row with the one that shares most with all among those that
    it meets outside its group and wasn't set against, best by the signatures they
    share."""
    hub = rows.groupBy("sig").agg(F.max(F.struct("weight", (-F.col("node")).alias("m"), "g")).alias("h"))
    meets = rows.join(hub.select("sig", (-F.col("h.m")).alias("hub"), F.col("h.g").alias("hub_g")).hint("merge"), "sig").where("g <> hub_g")
    met = meets.groupBy("node", "hub").agg(F.count("*").alias("c")).select("node", "hub", "c", F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    if tried is not None:
        met = met.join(tried.hint("merge"), ["a", "b"], "left_anti")
    best = met.groupBy("node").agg(F.max(F.struct("c", (-F.col("hub")).alias("m"), "a", "b")).alias("h"))
    return best.select("h.a", "h.b").distinct()


def tiles(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (keys, side, node, n) with ``mine``, the tile of its side, and
    ``n_tiles`` of the other side (of the same one for side 2)."""
    size = rows.groupBy(*keys, "side").agg(F.greatest(F.ceil(F.count("*") / SQUARE), F.ceil(F.sum("n") / SQUARE_GRAMS)).cast("long").alias("parts"))
    other = size.select(*keys, F.when(F.col("side") < 2, 1 - F.col("side")).otherwise(2).alias("side"), F.col("parts").alias("n_tiles"))
    out = rows.join(size.hint("merge"), [*keys, "side"]).join(other.hint("merge"), [*keys, "side"])
    return out.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts"))).withColumn("_t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tiles") - 1)))


def blocks_of(rows: DataFrame) -> DataFrame:
    """Blocks of two groups: each row once for each group that it meets."""
    few = rows.where(F.col("groups") <= MANY)
    met = few.select("sig", F.col("g").alias("h")).distinct()
    pairs = few.join(met.hint("merge"), "sig").where("g <> h").select("node", "n", F.least("g", "h").alias("lo"), F.greatest("g", "h").alias("hi"), (F.col("g") > F.col("h")).cast("int").alias("side")).distinct()
    tiled = tiles(pairs, ["lo", "hi"])
    i, j = F.when(F.col("side") == 0, F.col("mine")).otherwise(F.col("_t")), F.when(F.col("side") == 0, F.col("_t")).otherwise(F.col("mine"))
    return tiled.select(F.col("lo").alias("k1"), F.col("hi").alias("k2"), i.alias("i"), j.alias("j"), "side", "node")


def squares_of(rows: DataFrame) -> DataFrame:
    """Squares of the rows of signatures that many groups share; of signatures
    with the same rows only one."""
    many = rows.where(F.col("groups") > MANY)
    same = many.groupBy("sig").agg(F.count("*").alias("c"), *[F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(38,0)")).alias(f"h{k}") for k in (1, 2)])
    one = same.groupBy("c", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig")
    tiled = tiles(many.join(one.hint("merge"), "sig", "left_semi").select("sig", F.lit(2).alias("side"), "node", "n"), ["sig"])
    low, high = F.least("mine", "_t"), F.greatest("mine", "_t")
    # A row in a square of two tiles is on the side of its tile.
    side = F.when(low == high, 2).otherwise((F.col("mine") == high).cast("int"))
    return tiled.select(F.col("sig").alias("k1"), F.lit(-1).cast("long").alias("k2"), low.alias("i"), high.alias("j"), side.alias("side"), "node")


def join_groups(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` (smallest id reachable by
    links) of every row. ``id_col`` is an integer."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = max(0, (size // BLOCK_BYTES).bit_length())
    first = written(rows.mapInArrow(_first_pass(n, percent, bits), _FIRST), "join_first")
    zipped = F.explode(F.arrays_zip("ids", "n", "f1", "f2")).alias("m")
    members = first.where(F.col("kind") == _MEMBERS).select(zipped).select(F.col("m.ids").alias("id"), "m.n", "m.f1", "m.f2")
    classes = members.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("id").alias("node"))
    answers = first.where(F.col("kind") >= _SENT).select("kind", "block", "keys", "rows", "times").groupBy("kind").applyInArrow(_meet(bits), _ANSWER)
    own = first.where(F.col("kind") < _SENT).select("kind", "block", "ids", "n", "keys", "rows")
    met = own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_open(percent), _ROWS)
    # Joins are merges whatever the sizes, so that a plan does not change with them.
    of_id = members.where("n > 0").join(classes.hint("merge"), ["n", "f1", "f2"]).select("id", "node")
    found = met.select("id", F.explode("opened").alias("sig")).join(of_id.hint("merge"), "id").select("sig", "node").distinct()
    found = written(found, "join_signatures")
    times = found.groupBy("sig").agg(F.count("*").alias("times")).where("times > 1")
    shared = written(found.join(times.hint("merge"), "sig"), "join_shared")
    # Every set that may be multiplied, once.
    sets = sets_of(shared.select(F.col("node").alias("_asked")), rows, n)
    weight = shared.groupBy("node").agg(F.sum("times").alias("weight"))
    sized = shared.join(weight.hint("merge"), "node").join(sets.select(F.col("_id").alias("node"), F.floor(F.octet_length("grams") / 8).alias("n")).hint("merge"), "node")
    sized = written(sized, "join_sized")
    links, near, tried = None, None, None
    for _ in range(HUB_ROUNDS):
        # Every row against the one that shares most with all, among those it meets.
        pairs = written(hub_pairs(across(sized, near), tried), "join_tried")
        found = written(product(pairs, sets, percent), "join_links")
        some = found.limit(1).count() > 0
        links, tried = (found, pairs) if links is None else (links.union(found), tried.union(pairs))
        if not some:
            break
        near = connected(links)
    # What meets across the groups so far.
    rest = written(across(sized, near), "join_across")
    squares = written(blocks_of(rest).union(squares_of(rest)), "join_squares")
    with_sets = squares.join(sets.withColumnRenamed("_id", "node").hint("merge"), "node").select("k1", "k2", "i", "j", "side", "node", "grams")
    more = written(with_sets.groupBy("k1", "k2", "i", "j").applyInArrow(_square(percent), "a long, b long").distinct(), "join_more")
    # Documents that repeat an id tie their classes together.
    ties = of_id.where("id <> node").select(F.col("node").alias("a"), F.col("id").alias("b"))
    repeated = members.where("n > 0").groupBy("id").agg(F.count("*").alias("c")).where("c > 1 AND id IS NOT NULL").select(F.col("id").alias("b"))
    links = more if links is None else links.union(more)
    final = connected(links.union(ties.join(repeated, "b", "left_semi")))
    return (
        members.join(classes.hint("merge"), ["n", "f1", "f2"], "left")
        .join(final.withColumnRenamed("id", "node").hint("merge"), "node", "left")
        .select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"),
        )
    )
