"""Suffix-array dedup: every byte in a string of ``LENGTH`` bytes that also starts
earlier (smaller id, or same document and earlier start) goes; the first one
stays. Texts are UTF-8 bytes, strings never cross documents.

Which suffixes are sorted: each string of ``LENGTH`` bytes has an anchor, its
``GRAM``-byte substring of least hash (the last of equals). Equal strings have
equal anchors, so only suffixes around anchors that occur twice or more can
matter, and all suffixes that can be equal meet in one shard, dealt by anchor.

How a shard sorts them: external induced sorting. Suffix tuples (document,
position, rank) wait in queues by first byte. A round goes through the suffixes
in order and puts the one that starts a byte earlier behind its byte's queue:
the queues in byte order are the next, longer suffixes in order, so each order
is induced from the one before, from the last byte of a window back to the
``LENGTH - GRAM`` bytes before the anchor. The common prefix of neighbours is
carried along: one more than the least prefix between them. Neighbours that
share ``LENGTH`` bytes start equal strings. Queues and prefixes live in arrays
that go to temporary files of the task beyond ``MEMORY_BYTES``, worked through
in runs, so that a shard may be larger than memory.

Defined results: NULL text is empty; a NULL id counts as the smallest; rows that
repeat an id are documents of their own, in the order of their texts; an empty
table gives an empty table; columns other than the id are not returned.
"""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.lm_score import pack_keys, unpack_keys
from tripflow.llm.words import U64, prefix_sums, range_hash, text_buffer, written
from tripflow.session import ship_package

LENGTH = 100
GRAM = 32
#: Places of an anchor in a string: 0 .. LEFT bytes before it.
LEFT = LENGTH - GRAM
WIDTH = LEFT + LENGTH
BLOCK_BYTES = 6 << 20
CHUNK = 2 << 20
KEY_BITS = 48
#: Bytes of a shard's arrays in memory; what goes beyond is on disk.
MEMORY_BYTES = 256 << 20
RUN = 1 << 20


class Texts:
    """A block's documents in order of id and text, as one buffer."""

    def __init__(self, table):
        import pyarrow as pa

        ids = table.column("_id")
        # NULL ids first; equal ids in the order of their texts.
        table = table.append_column("_known", pa.array(np.asarray(ids.is_valid()).astype(np.int8)))
        repeats = len(set(ids.to_pylist())) < len(ids)
        keys = [("_known", "ascending"), ("_id", "ascending")] + [("_text", "ascending")] * repeats
        table = table.sort_by(keys)
        self.ids = table.column("_id").combine_chunks()
        self.data, self.offsets = text_buffer(table.column("_text"))
        self.known = table.column("_known").to_numpy()
        plain = self.ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.id = plain
        same = np.zeros(len(plain), dtype=np.int64)
        if len(plain) > 1:
            again = (plain[1:] == plain[:-1]) & (self.known[1:] == self.known[:-1])
            for k in np.flatnonzero(again):
                same[k + 1] = same[k] + 1
        self.same = same  # which of the rows with its id

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all anchors, ascending, and the keys of their bytes."""
        n, window = len(self.data), LEFT + 1
        across = np.zeros(n + 1, dtype=np.int32)  # strings that cross an end
        ends = self.offsets[1:]
        np.add.at(across, np.maximum(ends - LENGTH + 1, self.offsets[:-1]), 1)
        np.add.at(across, ends, -1)
        bad = np.cumsum(across[:-1], dtype=np.int32) > 0 if n else np.zeros(0, dtype=bool)
        at, keys = [], []
        for a in range(0, max(n - LENGTH + 1, 0), CHUNK):
            part = self.data[a: a + CHUNK + LENGTH - 1]
            sums = prefix_sums(part)
            start = np.arange(len(part) - GRAM + 1)
            h = range_hash(sums, start, start + GRAM)
            order = (h & ~U64(0xFFFFFFFF)) | (U64(0xFFFFFFFF) - start.astype(np.uint64))
            least = sliding_min(order, window)
            least = least[~bad[a: a + len(least)]]
            pick = (U64(0xFFFFFFFF) - (least & U64(0xFFFFFFFF))).astype(np.int64)
            pick = pick[np.concatenate([[True], pick[1:] != pick[:-1]])] if len(pick) else pick
            pick = np.unique(pick)
            at.append(pick + a)
            keys.append(h[pick] >> U64(64 - KEY_BITS))
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at, keys = np.concatenate(at), np.concatenate(keys)
        _, first = np.unique(at, return_index=True)  # found from two chunks
        return at[first], keys[first]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours: from running minima to both sides of every
    w-th place."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = np.full(-len(x) % w, ~U64(0), dtype=np.uint64)
    m = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(m, axis=1).ravel()
    back = np.minimum.accumulate(m[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1: w - 1 + n])


class Store:
    """Arrays in memory up to a limit, then in unnamed temporary files."""

    def __init__(self, limit: int = MEMORY_BYTES):
        self.left = limit

    def empty(self, shape, kind) -> np.ndarray:
        size = int(np.prod(shape)) * np.dtype(kind).itemsize
        if size <= self.left or not size:
            self.left -= size
            return np.empty(shape, dtype=kind)
        return np.memmap(tempfile.TemporaryFile(), dtype=kind, mode="w+", shape=shape)

    def done(self, *arrays: np.ndarray) -> None:
        self.left += sum(a.nbytes for a in arrays if not isinstance(a, np.memmap))


class RangeLeast:
    """Least prefix in a range of neighbours: minima over 1, 2, 4, ... places."""

    def __init__(self, prefix: np.ndarray, store: Store):
        n = len(prefix)
        levels = max(1, n.bit_length())
        self.store, self.table = store, store.empty((levels, n), np.uint8)
        self.table[0] = prefix
        for k in range(1, levels):
            half = 1 << (k - 1)
            self.table[k, half:] = np.minimum(self.table[k - 1, half:], self.table[k - 1, : n - half])
            self.table[k, :half] = self.table[k - 1, :half]

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, last], self.table[level, first + (1 << level.astype(np.int64)) - 1])

    def close(self) -> None:
        self.store.done(self.table)


def induce(order: np.ndarray, prefix: np.ndarray, byte: np.ndarray, on: np.ndarray, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes of the suffixes one byte longer. ``order``
    lists windows by their suffix so far, ``byte`` is each window's next byte to
    the left; windows not ``on`` end here."""
    n = len(order)
    least = RangeLeast(prefix, store)
    runs = [(a, min(a + RUN, n)) for a in range(0, n, RUN)]
    count = sum((np.bincount(byte[o[on[o]]], minlength=256) for o in (order[a:b] for a, b in runs)), np.zeros(256, np.int64))
    queue = np.cumsum(count) - count  # where each byte's queue goes on
    last = np.full(256, -1, dtype=np.int64)  # place of its last suffix in ``order``
    total = int(count.sum())
    new_order, new_prefix = store.empty(total, np.int64), store.empty(total, np.uint8)
    for a, b in runs:
        o = order[a:b]
        use = np.flatnonzero(on[o])
        by = byte[o[use]]
        sort = np.argsort(by, kind="stable")
        use, by = use[sort], by[sort]
        here = np.bincount(by, minlength=256)
        at = a + use
        before = np.concatenate([[-1], at[:-1]])[: len(at)]
        heads = (np.cumsum(here) - here)[here > 0]
        before[heads] = last[here > 0]
        low = np.zeros(len(at), dtype=np.uint8)
        after_one = before >= 0
        low[after_one] = np.minimum(least(before[after_one] + 1, at[after_one]), LENGTH - 1) + 1
        place = queue[by] + np.arange(len(by)) - (np.cumsum(here) - here)[by]
        new_order[place], new_prefix[place] = o[use], low
        queue += here
        last[here > 0] = at[np.cumsum(here)[here > 0] - 1]
    least.close()
    store.done(order, prefix)
    return new_order, new_prefix


def repeated_starts(windows: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray, store: Store | None = None) -> np.ndarray:
    """For each window and x in 0 .. LEFT: does the string that starts x bytes
    before the anchor also start in a window of lower ``rank``?

    ``windows``: LEFT bytes before the anchor and LENGTH from it, of which
    ``left`` and ``right`` are there."""
    store = store or Store()
    n = len(windows)
    out = store.empty((n, LEFT + 1), bool)
    out[:] = False
    order, prefix = np.zeros(0, np.int64), np.zeros(0, np.uint8)
    for r in range(LENGTH - 1, -LEFT - 1, -1):
        new = np.flatnonzero(right == r + 1) if r >= 0 else np.zeros(0, np.int64)
        if len(new):  # they begin as empty suffixes, before all others
            if len(prefix):
                prefix[0] = 0
            order, prefix = np.concatenate([new, order]), np.concatenate([np.zeros(len(new), np.uint8), prefix])
        on = left >= -r if r < 0 else np.ones(n, dtype=bool)
        order, prefix = induce(order, prefix, windows[:, LEFT + r], on, store)
        if r <= 0 and len(order):
            begins = np.flatnonzero(np.concatenate([[True], prefix[1:] < LENGTH]))
            first = np.minimum.reduceat(rank[order], begins)
            size = np.diff(np.append(begins, len(order)))
            out[order, -r] = rank[order] > np.repeat(first, size)
    return out


def _shards(keys: np.ndarray, bits: int) -> np.ndarray:
    tops = (keys >> U64(KEY_BITS - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    return np.searchsorted(tops, np.arange((1 << bits) + 1))


def _send(bits: int):
    def run(key, table):
        import pyarrow as pa

        _, keys = Texts(table).anchors()
        keys = np.unique(keys)
        edges = _shards(keys, bits)
        some = np.flatnonzero(np.diff(edges)).tolist()
        packed = [pack_keys(keys[edges[s]: edges[s + 1]] - U64(s << (KEY_BITS - bits))) for s in some]
        return pa.table({"shard": pa.array(some, pa.int32()), "block": pa.array([key[0].as_py()] * len(some), pa.int64()), "keys": pa.array(packed, pa.binary())})

    return run


def _meet(key, table):
    """One bit for each key of each block: do other blocks have it?"""
    import pyarrow as pa

    keys = [unpack_keys(x) for x in table.column("keys").to_pylist()]
    distinct, at, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    both = np.split(times[at] > 1, np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({"block": table.column("block"), "shard": table.column("shard"), "bits": pa.array([np.packbits(b).tobytes() for b in both], pa.binary())})


class Windows:
    """A block's distinct windows around anchors that occur twice or more."""

    def __init__(self, texts: Texts, answers, bits: int):
        at, keys = texts.anchors()
        distinct, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        edges, shared = _shards(distinct, bits), times > 1
        for s, b in zip(answers.column("shard").to_pylist(), answers.column("bits").to_pylist(), strict=True):
            n = edges[s + 1] - edges[s]
            shared[edges[s]: edges[s + 1]] |= np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
        use = shared[which]
        self.at, keys = at[use], keys[use]
        doc = texts.doc_of(self.at)
        self.left = np.minimum(self.at - texts.offsets[doc], LEFT)
        self.right = np.minimum(texts.offsets[doc + 1] - self.at, LENGTH)
        start, end = self.at - self.left, self.at + self.right
        h = np.zeros(len(self.at), dtype=np.uint64)
        for a in range(0, len(texts.data), CHUNK):
            part = (start >= a) & (start < a + CHUNK)
            if part.any():
                sums = prefix_sums(texts.data[a: a + CHUNK + WIDTH])
                h[part] = range_hash(sums, start[part] - a, end[part] - a)
        h += self.left.astype(np.uint64) * U64(0x9E3779B97F4A7C15)  # the anchor's place
        # The first of equal windows stands for all in the block.
        _, self.first, self.window = np.unique(h, return_index=True, return_inverse=True)
        self.keys, self.doc = keys, doc
        self.texts = texts


_WINDOW = "anchor long, block long, i int, known int, id long, same long, pos long, left int, right int, bytes binary"


def _windows(bits: int):
    def run(docs, answers):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        names = [x.split()[0] for x in _WINDOW.split(", ")]
        texts = Texts(docs)
        w = Windows(texts, answers, bits)
        f = w.first
        data, d = texts.data.tobytes(), w.doc[f]
        start, end = (w.at - w.left)[f].tolist(), (w.at + w.right)[f].tolist()
        block = docs.column("block")[0].as_py() if docs.num_rows else 0
        cols = [
            w.keys[f].astype(np.int64), np.full(len(f), block), np.arange(len(f)), texts.known[d], texts.id[d], texts.same[d],
            w.at[f] - texts.offsets[d], w.left[f], w.right[f], [data[a:b] for a, b in zip(start, end, strict=True)],
        ]
        return pa.table({x: pa.array(c, k) for x, c, k in zip(names, cols, kinds, strict=True)})

    return run


def _sort(batches):
    """The windows of a shard, sorted; each answers its block."""
    import pyarrow as pa

    store, files = Store(), tempfile.TemporaryFile()
    meta, n = [], 0
    for batch in batches:
        left, right = batch.column(7).to_numpy(), batch.column(8).to_numpy()
        data, offsets = text_buffer(batch.column(9))
        rows = np.zeros((batch.num_rows, WIDTH), dtype=np.uint8)
        size = np.diff(offsets)
        owner = np.repeat(np.arange(len(size)), size)
        rows[owner, np.arange(len(data)) - np.repeat(offsets[:-1], size) + np.repeat(LEFT - left, size)] = data
        files.write(rows.tobytes())
        meta.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 7)] + [left, right])
        n += batch.num_rows
    if not n:
        return
    files.flush()
    saved = np.memmap(files, dtype=np.uint8, mode="r", shape=(n, WIDTH))
    windows = store.empty((WIDTH, n), np.uint8)
    for a in range(0, n, RUN):
        windows[:, a: a + RUN] = saved[a: a + RUN].T
    block, i, known, ids, same, pos, left, right = (np.concatenate(c) for c in zip(*meta, strict=True))
    rank = np.empty(n, dtype=np.int64)
    rank[np.lexsort((pos, same, ids, known))] = np.arange(n)
    out = repeated_starts(windows.T, left, right, rank, store)
    some = np.flatnonzero(out.any(axis=1))
    for a in range(0, len(some), RUN):
        at = some[a: a + RUN]
        bits = np.packbits(out[at], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block[at], pa.int64()), pa.array(i[at], pa.int32()), pa.array([b.tobytes() for b in bits], pa.binary())],
            names=["block", "i", "starts"],
        )


def _cut(bits: int):
    """Spans and what is left of every document of a block."""
    def run(docs, answers):
        import pyarrow as pa
        import pyarrow.compute  # noqa: F401

        texts = Texts(docs)
        found = answers.filter(pa.compute.is_valid(answers.column("shard")))
        w = Windows(texts, found, bits)
        starts = np.ones((len(w.at), LEFT + 1), dtype=bool)  # all but a window's first
        own = np.zeros((len(w.first), LEFT + 1), dtype=bool)
        flags = answers.filter(pa.compute.is_valid(answers.column("i")))
        if flags.num_rows:
            packed = np.frombuffer(b"".join(flags.column("starts").to_pylist()), np.uint8).reshape(flags.num_rows, -1)
            own[flags.column("i").to_numpy()] = np.unpackbits(packed, axis=1, count=LEFT + 1).astype(bool)
        starts[w.first] = own
        before = np.arange(LEFT + 1)
        starts &= (before <= w.left[:, None]) & (LENGTH - before <= w.right[:, None])
        at, x = np.nonzero(starts)
        begin = w.at[at] - x
        n = len(texts.data)
        level = np.zeros(n + 1, dtype=np.int32)
        hit = np.zeros(n + 1, dtype=np.int32)
        hit[begin] = 1
        level[:-1] += hit[:-1]
        if n >= LENGTH:
            level[LENGTH:] -= hit[: n + 1 - LENGTH]
        gone = np.cumsum(level[:-1], dtype=np.int32) > 0
        edge = np.zeros(n + 1, dtype=bool)
        edge[texts.offsets] = True
        begins = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1] | edge[1:-1]])) if n else np.zeros(0, np.int64)
        ends = np.flatnonzero(gone & np.concatenate([~gone[1:] | edge[1:-1], [True]])) + 1 if n else begins
        by_doc = np.searchsorted(begins, texts.offsets).tolist()
        offsets = texts.offsets.tolist()
        spans, kept = [], []
        for d in range(len(offsets) - 1):
            s = slice(by_doc[d], by_doc[d + 1])
            spans.append([{"start": int(p) - offsets[d], "end": int(q) - offsets[d]} for p, q in zip(begins[s], ends[s], strict=True)])
            part = texts.data[offsets[d]: offsets[d + 1]]
            kept.append(part[~gone[offsets[d]: offsets[d + 1]]].tobytes() if spans[-1] else part.tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"_id": texts.ids, "n_bytes": pa.array(np.diff(texts.offsets), pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})

    return run


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` (an integer), ``n_bytes``, ``spans`` (removed runs of bytes) and
    ``kept`` (the other bytes) of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    bits = (blocks - 1).bit_length()
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("_id"), F.lit(blocks).cast("long")))
    sent = dealt.groupBy("block").applyInArrow(_send(bits), "shard int, block long, keys binary")
    answers = written(sent.groupBy("shard").applyInArrow(_meet, "block long, shard int, bits binary"), "suffix_anchors")
    windows = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_windows(bits), _WINDOW)
    starts = written(
        windows.repartition("anchor").mapInArrow(_sort, "block long, i int, starts binary"), "suffix_starts"
    )
    told = answers.select("block", "shard", "bits", F.lit(None).cast("int").alias("i"), F.lit(None).cast("binary").alias("starts")).unionByName(
        starts.select("block", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("binary").alias("bits"), "i", "starts")
    )
    return (
        dealt.groupBy("block").cogroup(told.groupBy("block"))
        .applyInArrow(_cut(bits), "_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
        .withColumnRenamed("_id", id_col)
    )
