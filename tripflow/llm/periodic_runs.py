"""Periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and length >= max(``LEAST``, ``TIMES`` * q) that no neighbouring word
extends keeping that period. Every word of a run occurs ``TIMES`` times in it or
more, so a word that occurs less often within its segment is in no run and splits
the segment; its parts are judged again by their own counts, until nothing
splits. All segments of a batch of texts are judged together, and only those that
a split touched are judged again.

Surviving segments are scanned lag by lag. A run of period q holds four multiples
of q in a row whatever its start, all of the same word, so a lag probes only the
multiples of itself; where three neighbouring probes agree in a row the run is
measured by comparing words both ways. Lags whose probes agree all over the
segment are compared in full instead. A run has the same start and end under
multiples of its smallest period, so only the smallest counts, and a lag does not
look again at what a divisor of it has found.

Words of a batch are numbered exactly, not by hashes. Texts do not meet, so
nothing is shuffled; the memory of a task is that of one piece of texts.

Defined results: NULL or empty text, or one of white space, has no words and no
run; equal rows and rows that repeat an id are worked one by one; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import pieces, text_buffer, word_bounds, words_of
from tripflow.session import ship_package

#: A run has at least so many words, and so many periods.
LEAST = 6
TIMES = 4


def numbered(data: np.ndarray, offsets: np.ndarray):
    """The words of some texts as an Arrow array, the number of each, equal words
    alike, and each text's offsets."""
    import pyarrow as pa

    start, end, by_text = word_bounds(data, offsets)
    size = end - start
    upto = np.concatenate([[0], np.cumsum(size)])
    letters = data[np.arange(upto[-1]) + np.repeat(start - upto[:-1], size)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(letters)])
    number = words.dictionary_encode().indices.to_numpy().astype(np.int64) if len(size) else np.zeros(0, np.int64)
    return words, number, by_text


def split(number: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Segments [start, end) that hold no word too rare for a run of theirs."""
    lo, hi = bounds[:-1], bounds[1:]
    keep = hi - lo >= LEAST
    lo, hi = lo[keep], hi[keep]
    done = []
    while len(lo):
        size = hi - lo
        owner = np.repeat(np.arange(len(lo)), size)
        at = np.arange(len(owner)) + np.repeat(lo - np.cumsum(size) + size, size)
        key = owner * (int(number.max()) + 1) + number[at]
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
        times = np.diff(np.append(first, len(order)))
        rare = np.zeros(len(at), dtype=bool)
        rare[order] = np.repeat(times < TIMES, times)
        whole = np.bincount(owner, weights=rare, minlength=len(lo)) == 0
        done += zip(lo[whole].tolist(), hi[whole].tolist(), strict=True)
        use = ~rare & ~whole[owner]
        at, owner = at[use], owner[use]
        new = np.append(True, (np.diff(at) > 1) | (np.diff(owner) > 0)) if len(at) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(at)))
        keep = size >= LEAST
        lo, hi = at[start[keep]], at[start[keep]] + size[keep]
    return sorted(done)


def agree(x: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words match from ``a`` and ``b`` on, going ``step`` (1 or -1)."""
    room = len(x) - b if step > 0 else a + 1
    n, width = 0, 16
    while n < room:
        take = min(width, room - n)
        if step > 0:
            differ = x[a + n: a + n + take] != x[b + n: b + n + take]
        else:
            differ = (x[a - n - take + 1: a - n + 1] != x[b - n - take + 1: b - n + 1])[::-1]
        stop = int(differ.argmax())
        if differ[stop]:
            return n + stop
        n, width = n + take, width * 4
    return n


def stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of stretches of at least ``least`` set places."""
    edge = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= least
    return start[long], (end - start)[long]


#: One measured run costs about as much as so many compared words.
_PROBE_COST = 4096


def scan(x: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment."""
    n, found, known, live = len(x), [], set(), []

    def add(start: int, length: int, q: int) -> None:
        if (start, length) not in known:
            known.add((start, length))
            found.append((start, length, q))
            live.append(found[-1])

    for q in range(1, n // TIMES + 1):
        least = max(LEAST, TIMES * q) - q
        probe = x[::q]
        same = probe[1:] == probe[:-1]
        # What is found and has q words or more is its own run at multiples of
        # its period; places in it need no further look.
        live = [r for r in live if r[1] > q]
        for s, size, p in live:
            if q % p == 0:
                same[-(-s // q): max(0, (s + size - 1) // q)] = False
        start, length = stretches(same, TIMES - 1)
        if not len(start):
            continue
        if q == 1 or _PROBE_COST * int(length.sum()) > n * TIMES:
            start, length = stretches(x[q:] == x[:-q], least)
            for s, size in zip(start.tolist(), length.tolist(), strict=True):
                add(s, size + q, q)
            continue
        for k, size in zip(start.tolist(), length.tolist(), strict=True):
            at, last = k * q, (k + size - TIMES + 1) * q
            # A run with its first multiple of q at ``at`` begins less than q before.
            while at <= last:
                ahead = agree(x, at, at + q, 1)
                if ahead:
                    back = agree(x, at - 1, at + q - 1, -1) if at else 0
                    if back + ahead >= least:
                        add(at - back, back + ahead + q, q)
                at += q * (ahead // q + 1)
    return found


def runs_of(number: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of all texts, by start, then period; starts are places in ``number``."""
    found = [(lo + s, size, q) for lo, hi in split(number, bounds) for s, size, q in scan(number[lo:hi])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that a run holds after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    if runs:
        start, size, q = np.array(runs, dtype=np.int64).T
        np.add.at(edge, start + q, 1)
        np.add.at(edge, start + size, -1)
    return np.cumsum(edge[:-1]) > 0


_OUT = "_id {id}, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``runs`` (by start, then period) and ``collapsed`` (the words
    that no run repeats, joined by one space) of every row."""
    ship_package(docs.sparkSession)

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            data, offsets = text_buffer(text)
            for lo, hi in pieces(offsets):
                words, number, by_text = numbered(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                runs = runs_of(number, by_text)
                stay = ~dropped(len(number), runs)
                upto = np.concatenate([[0], np.cumsum(stay)])[by_text]
                lists = pa.LargeListArray.from_arrays(pa.array(upto, pa.int64()), words.filter(pa.array(stay)))
                joined = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
                start, size, q = np.array(runs, dtype=np.int64).reshape(-1, 3).T
                of = np.searchsorted(by_text, start, side="right") - 1
                ends = np.searchsorted(of, np.arange(hi - lo + 1))
                rows = pa.StructArray.from_arrays([pa.array(start - by_text[of]), pa.array(size), pa.array(q)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows), joined.cast(pa.large_string()).cast(pa.string()),
                ], names=["_id", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, _OUT.format(id=kind)).withColumnRenamed("_id", id_col)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``text_col``, where every tenth document (h = crc32 of its
    id divisible by 10) has a periodic end: word i >= a is word a + (i - a) mod p
    with g = floor(h / 10), a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8)).
    Others are as they are, so are those without an id."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    n, g, a, p = F.size("_w"), F.floor(F.col("_h") / 10), F.col("_a"), F.col("_p")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), h.alias("_h"), F.when(h % 10 == 0, words_of(F.col(text_col))).alias("_w"))
    rows = rows.withColumn("_a", F.when(n > 0, g % n).cast("int")).withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("_w", a + 1, p), F.ceil((n - a) / p).cast("int")))
    whole = F.slice(F.concat(F.slice("_w", F.lit(1), a), again), F.lit(1), n)
    return rows.select(F.col("_id").alias(id_col), F.when(n > 0, F.array_join(whole, " ")).otherwise(F.col("_text")).alias(text_col))
