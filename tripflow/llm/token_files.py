"""Token ids in binary files, by a static range asymmetric numeral system.

One table of frequencies, counted over all documents and scaled to a power of
two, serves every file. A file holds whole documents in order, its ids cut into
blocks that know nothing of each other. A block is coded by ``LANES`` interleaved
states (id k belongs to lane k mod LANES), which share one stream of 32-bit words.
Every ``STEP_IDS`` ids a checkpoint keeps the states and the place in the stream,
with a checksum of the ids up to the next one, so a decoder starts at all
checkpoints of a file at once: they are rows of one array that advance together.

Files are written and read by Spark (any store that it reaches): the writer puts
each file's bytes down as one record, the reader takes files whole. A file has
about ``FILE_IDS`` ids, or one longer document.

Layout (little-endian): ``MAGIC``, crc32 of the rest of the header, then the
header: format version, crc32 of the frequency table, partition and number of the
file, numbers of documents, blocks, checkpoints; documents (id, valid, length);
blocks (ids, words, checksum of the words); checkpoints (ids, place, checksum, states); then the blocks'
words. A checksum that doesn't match raises ``ValueError``.

Order: by id, NULL last; rows that share an id by length, then by their ids, so
equal rows may take each other's place and nothing else is open. Texts that are
NULL or empty have only the end id, where one is appended. An empty table gives
files without documents. Columns other than the id are not returned.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.bpe import byte_letters, spread
from tripflow.llm.words import SOLID, pieces, shuffles_dropped, text_buffer, word_bounds, written
from tripflow.session import ship_package

LANES = 256
STEP_IDS = 1 << 16
BLOCK_IDS = 1 << 18
FILE_IDS = 1 << 22
MAGIC = b"TFIDS\x00\x01\x00"
VERSION = 1
#: Lower end of a state; a state below it takes in a word.
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_CHECK = np.dtype([("block", "<u4"), ("first", "<u4"), ("n", "<u4"), ("place", "<u4"), ("crc", "<u4"), ("states", "<u8", (LANES,))])
_DOC = np.dtype([("id", "<i8"), ("valid", "u1"), ("n", "<u8")])
_HEAD = np.dtype([("version", "<u4"), ("table", "<u4"), ("part", "<i8"), ("seq", "<i8"), ("docs", "<u8"), ("blocks", "<u8"), ("checks", "<u8")])
_BLOCK = np.dtype([("n", "<u8"), ("words", "<u8"), ("crc", "<u4")])


class Table:
    """Frequencies scaled to 2 ** ``bits``, every id that occurs at least 1."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = ids[order].astype(np.uint32), counts[order].astype(np.int64)
        self.bits = max(12, min(28, len(ids).bit_length() + 4))
        whole, total = 1 << self.bits, int(counts.sum())
        freq = np.maximum(1, [c * whole // total for c in counts.tolist()]).astype(np.int64) if total else counts
        by_size = np.argsort(-freq, kind="stable")
        over = int(freq.sum()) - whole if total else 0
        if over < 0:
            freq[by_size[0]] -= over
        while over > 0:
            # What rounding up took, from the most frequent ids.
            for k in by_size.tolist():
                less = min(over, int(freq[k]) // 2)
                freq[k] -= less
                over -= less
                if not over:
                    break
        self.freq, self.first = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)
        self.common = int(by_size[0]) if total else 0
        self.place = np.zeros(0, np.int32)
        if total and int(self.ids[-1]) < 1 << 24:
            self.place = np.zeros(int(self.ids[-1]) + 1, np.int32)
            self.place[self.ids] = np.arange(len(self.ids))
        self.crc = zlib.crc32(self.ids.tobytes() + self.freq.tobytes())

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        return self.place[ids] if len(self.place) else np.searchsorted(self.ids, ids)

    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))


def code(symbols: np.ndarray, table: Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Blocks (block, step, lane) of symbols: each block's words, and the states
    before each checkpoint with their places (block, checkpoint, ...)."""
    blocks, steps, lanes = symbols.shape
    every = STEP_IDS // LANES
    bits, wide = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full((blocks, lanes), _LOW)
    out, words = np.zeros((steps, blocks, lanes), dtype=bool), np.zeros((steps, blocks, lanes), dtype=np.uint32)
    states = np.zeros((blocks, -(-steps // every), lanes), dtype=np.uint64)
    for k in range(steps - 1, -1, -1):
        freq, first = table.freq[symbols[:, k]], table.first[symbols[:, k]]
        full = state >= freq << wide
        out[k], words[k] = full, state.astype(np.uint32)
        state = np.where(full, state >> _WORD, state)
        more = state // freq
        state = (more << bits) + (state - more * freq) + first
        if k % every == 0:
            states[:, k // every] = state
    place = np.zeros((blocks, steps + 1), dtype=np.int64)
    np.cumsum(out.sum(axis=2).T, axis=1, out=place[:, 1:])
    return [words[:, b][out[:, b]] for b in range(blocks)], states, place[:, :-1:every]


def decode(states: np.ndarray, place: np.ndarray, words: np.ndarray, steps: int, table: Table, slots: np.ndarray) -> np.ndarray:
    """Symbols (checkpoint, step, lane) from the states and places of checkpoints."""
    out = np.zeros((len(states), steps, states.shape[1]), dtype=np.int32)
    mask, bits = np.uint64((1 << table.bits) - 1), np.uint64(table.bits)
    state, place = states.copy(), place.copy()
    for k in range(steps):
        low = state & mask
        out[:, k] = s = slots[low.astype(np.int64)]
        state = table.freq[s] * (state >> bits) + low - table.first[s]
        need = state < _LOW
        row, lane = np.nonzero(need)
        if len(row):
            rank = np.cumsum(need, axis=1)
            at = place[row] + rank[row, lane] - 1
            state[row, lane] = state[row, lane] << _WORD | words[np.minimum(at, len(words) - 1)]
            place += rank[:, -1]
    return out


def file_bytes(table: Table, part: int, seq: int, docs: np.ndarray, ids: np.ndarray) -> bytes:
    """One file of documents (``_DOC``) and all their ids."""
    symbols = table.symbols(ids)
    cut = len(ids) // BLOCK_IDS * BLOCK_IDS
    blocks, checks, streams = [], [], []
    for lo, hi, size in ((0, cut, BLOCK_IDS), (cut, len(ids), -(-(len(ids) - cut) // LANES) * LANES)):
        if lo == hi:
            continue
        padded = np.append(symbols[lo:hi], np.full(-(hi - lo) % size, table.common)).reshape(-1, size // LANES, LANES)
        words, states, place = code(padded, table)
        for b, stream in enumerate(words):
            n = min(size, hi - lo - b * size)
            for c in range(states.shape[1]):
                some = ids[lo + b * size + c * STEP_IDS: lo + b * size + min(n, (c + 1) * STEP_IDS)]
                checks.append((len(blocks), c * STEP_IDS, len(some), place[b, c], zlib.crc32(some.astype("<u4").tobytes()), states[b, c]))
            streams.append(stream.astype("<u4").tobytes())
            blocks.append((n, len(stream), zlib.crc32(streams[-1])))
    head = np.array([(VERSION, table.crc, part, seq, len(docs), len(blocks), len(checks))], _HEAD).tobytes()
    head += docs.tobytes() + np.array(blocks, _BLOCK).tobytes() + np.array(checks, _CHECK).tobytes()
    return MAGIC + zlib.crc32(head).to_bytes(4, "little") + head + b"".join(streams)


def header(data) -> tuple:
    """A file's head, documents, blocks and checkpoints, and where words begin."""
    data = memoryview(data)
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a file of token ids")
    at = begin = len(MAGIC) + 4
    try:
        head = np.frombuffer(data, _HEAD, 1, at)[0]
        at += _HEAD.itemsize
        tables = []
        for kind, name in ((_DOC, "docs"), (_BLOCK, "blocks"), (_CHECK, "checks")):
            tables.append(np.frombuffer(data, kind, int(head[name]), at))
            at += tables[-1].nbytes
    except ValueError as e:
        raise ValueError(f"a file of token ids is cut short: {e}") from None
    if zlib.crc32(data[begin:at]) != int.from_bytes(data[len(MAGIC): begin], "little"):
        raise ValueError("the header's checksum does not match")
    return head, *tables, at


def read_bytes(data, table: Table, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents and ids of a file."""
    head, docs, blocks, checks, at = header(data)
    if head["version"] != VERSION or head["table"] != table.crc:
        raise ValueError("another version or frequency table")
    try:
        words = np.frombuffer(data, "<u4", int(blocks["words"].sum()), at)
    except ValueError as e:
        raise ValueError(f"a file of token ids is cut short: {e}") from None
    ends = np.cumsum(blocks["words"]).tolist()
    for lo, hi, crc in zip([0, *ends], ends, blocks["crc"].tolist(), strict=False):
        if zlib.crc32(words[lo:hi].tobytes()) != crc:
            raise ValueError("a block's checksum does not match")
    base, ids_base = (np.cumsum(blocks[k]) - blocks[k] for k in ("words", "n"))
    ids = np.zeros(int(blocks["n"].sum()), dtype="<u4")
    words = np.append(words, np.uint32(0)).astype(np.uint64)
    # All checkpoints of as many steps together.
    steps = -(-checks["n"].astype(np.int64) // LANES)
    for size in np.unique(steps).tolist():
        some = checks[steps == size]
        block = some["block"].astype(np.int64)
        place = base[block].astype(np.int64) + some["place"]
        found = decode(some["states"].astype(np.uint64), place, words, size, table, slots)
        for got, c, b in zip(table.ids[found.reshape(len(some), -1)], some, block.tolist(), strict=True):
            lo, n = int(ids_base[b]) + int(c["first"]), int(c["n"])
            ids[lo: lo + n] = got[:n]
            if zlib.crc32(ids[lo: lo + n].tobytes()) != c["crc"]:
                raise ValueError(f"checksum of ids {lo} to {lo + n} does not match")
    return docs, ids


#: What a task remembers of the words it has met.
REMEMBERED_WORDS = 400_000
REMEMBERED_BYTES = 1 << 24
#: New words that go to the tokenizer as one text, and how a word's last id ends.
GROUP = 256
END = "</w>"
#: Letters below are letters to everyone, and composed.
LATIN = "\u0250"
#: Texts are cut into words in pieces of as many bytes, and as many have their words
#: looked up together: the words met are hashed again each time.
TEXT_BYTES = 1 << 20
LOOKED_UP_BYTES = 1 << 23
_BLANKS = np.flatnonzero(~SOLID).astype(np.uint8).tobytes()
_LETTERS = {k: c for k, c in enumerate(byte_letters()) if k != 0x20}


#: As many marks at a word's end are looked at.
MARKS = 16
_PLAIN, _MARK = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = _PLAIN


def simple_spec(source: str) -> str | None:
    """The tokenizer file for words of small Latin letters, which its normalizer
    leaves as they are and its pattern leaves whole, so neither is needed; nor are
    byte letters, which the words come in (those of a to z are themselves). None if
    the file is of another kind."""
    spec = json.loads(source)
    steps = lambda part, name: [x["type"] for x in (spec[part] or {}).get(name, [])]
    if steps("normalizer", "normalizers") != ["NFC", "Replace", "Lowercase"] or steps("pre_tokenizer", "pretokenizers") != ["Split", "ByteLevel"]:
        return None
    split, letters = spec["pre_tokenizer"]["pretokenizers"]
    if r"[\p{L}]+" not in split["pattern"].get("Regex", "").split("|") or letters.get("add_prefix_space", True) or letters.get("use_regex", True):
        return None
    spec |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}
    return json.dumps(spec)


def marks_behind(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (by number) that end in marks behind an ASCII letter or digit, and
    where the marks begin. Words of more marks at their end stay whole."""
    word, at = np.arange(len(end)), end - 1
    cut, first = [], []
    for _ in range(MARKS):
        word, at = word[more := _KIND[data[at]] == _MARK], at[more]
        at = at - 1
        word, at = word[more := at >= start[word]], at[more]
        done = _KIND[data[at]] == _PLAIN
        cut.append(word[done])
        first.append(at[done] + 1)
        word, at = word[~done], at[~done]
    cut, first = np.concatenate(cut), np.concatenate(first)
    order = np.argsort(cut, kind="stable")
    return cut[order], first[order]


class Tokens:
    """Ids of texts by a ``tokenizers`` file whose pre-tokens hold no white space:
    words between blanks are encoded once, in lower case, as the tokenizer makes
    them, and without the marks behind them, which are a pre-token of their own.
    All words met lie in one Arrow array, ``known``, and their ids in another;
    a word's number is its place in the first. Pieces of text that hold a special
    token are left as they are."""

    def __init__(self, source: str, simple: str | None = None):
        """``simple``: what ``simple_spec`` makes of the file."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import pyarrow as pa
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.simple = Tokenizer.from_str(simple) if simple else None
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, dtype=bool)
        self.ends[[i for name, i in names.items() if name.endswith(END)]] = True
        self.known = pa.array([], pa.large_binary())
        self.ids, self.letters = np.zeros(0, np.uint32), 0
        self.first, self.count, self.hits = (np.zeros(0, np.int32) for _ in range(3))

    def forget(self) -> None:
        """Keeps the words that were met more than once, the more the longer."""
        old = np.flatnonzero(self.hits > 1)
        self.known, self.hits, self.count = self.known.take(old), self.hits[old] // 2, self.count[old]
        self.ids, self.first = self.ids[spread(self.first[old], self.count)], np.cumsum(self.count, dtype=np.int32) - self.count
        self.letters = len(text_buffer(self.known)[0])

    def each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, flat, and how many each has."""
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.fromiter(map(len, coded), np.int64, len(coded))
        return np.fromiter(chain.from_iterable(coded), np.uint32, int(count.sum())), count

    def together(self, text: str, n: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the ``n`` simple words of a text, and how many each has; None if
        not as many word ends as words tell them apart."""
        flat = np.array(self.simple.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        last = np.flatnonzero(self.ends[flat])
        return (flat, np.diff(last, prepend=-1)) if len(last) == n and last[-1] == len(flat) - 1 else None

    def learn(self, words) -> None:
        """Encodes new words (an Arrow array), which get the next numbers. Words of
        a to z are never looked at one by one."""
        import pyarrow as pa

        data, offsets = text_buffer(words)
        small = np.logical_and.reduceat((data >= 0x61) & (data <= 0x7A), offsets[:-1]) & (self.simple is not None)
        order, found = [np.flatnonzero(small)], []
        data, offsets = text_buffer(words.filter(pa.array(small)))
        spaced = np.insert(data, offsets[1:], 0x20).tobytes().decode()
        at = offsets + np.arange(len(offsets))
        for a in range(0, len(at) - 1, GROUP):
            b = min(a + GROUP, len(at) - 1)
            text = spaced[at[a]: at[b] - 1]
            found.append(self.together(text, b - a) or self.each(text.split(" ")))
        rest = np.flatnonzero(~small)
        texts = [w.decode() for w in words.take(rest).to_pylist()]
        easy = np.array([self.simple is not None and t.isalpha() and max(t) < LATIN and t.islower() for t in texts], dtype=bool)
        for simple in (True, False):
            own = np.flatnonzero(easy == simple)
            order.append(rest[own])
            for a in range(0, len(own), GROUP):
                some = [texts[k] for k in own[a: a + GROUP]]
                letters = " ".join(some).encode().decode("latin-1").translate(_LETTERS)
                found.append((simple and self.together(letters, len(some))) or self.each(some))
        order, flat = np.concatenate(order), [f[0] for f in found]
        count = np.concatenate([f[1] for f in found])
        first, counts = np.empty((2, len(order)), np.int32)
        first[order], counts[order] = len(self.ids) + np.cumsum(count) - count, count
        self.ids, self.first, self.count = np.concatenate([self.ids, *flat]), np.append(self.first, first), np.append(self.count, counts)
        self.hits = np.append(self.hits, np.zeros(len(order), np.int32))

    def cut(self, data: np.ndarray, offsets: np.ndarray):
        """The words of some texts, an Arrow array, and each text's offsets in it."""
        import pyarrow as pa

        start, end, by_text = word_bounds(data, offsets)
        whole = data.tobytes()
        low = whole.lower()  # A-Z alone
        if len(start) and not any(t in low for t in self.special):
            whole, data = low, np.frombuffer(low, np.uint8)
            cut, last = marks_behind(data, start, end)
            start, end = np.insert(start, cut + 1, last), np.insert(end, cut, last)
            by_text = by_text + np.searchsorted(cut, by_text)
        upto = np.concatenate([[0], np.cumsum(end - start)])
        buffers = [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(whole.translate(None, _BLANKS))]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), buffers), by_text

    def numbers(self, words: list) -> list[np.ndarray]:
        """The numbers of the words of each array; new words are encoded."""
        import pyarrow as pa

        if len(self.known) > REMEMBERED_WORDS or self.letters > REMEMBERED_BYTES:
            self.forget()
        # Known words come first, so they keep their numbers; new ones get the next.
        old, ends = len(self.known), np.cumsum([len(w) for w in words])
        coded = pa.chunked_array([self.known, *words]).dictionary_encode().chunks  # without empty ones
        if coded and len(met := coded[0].dictionary) > old:
            self.learn(met.slice(old))
            self.known, self.letters = met, int(text_buffer(met)[1][-1])
        number = np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in coded)])[old:]
        return np.split(number, ends[:-1])

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ranges of texts, flat ids of each, and its texts' offsets in them."""
        for first, last in pieces(offsets, LOOKED_UP_BYTES):
            ranges = [(first + lo, first + hi) for lo, hi in pieces(offsets[first: last + 1], TEXT_BYTES)]
            cut = [self.cut(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]) for lo, hi in ranges]
            for (lo, hi), number, (_, by_text) in zip(ranges, self.numbers([c[0] for c in cut]), cut, strict=True):
                self.hits += np.bincount(number, minlength=len(self.hits)).astype(np.int32)
                counts = self.count[number]
                yield lo, hi, self.ids[spread(self.first[number], counts)], np.concatenate([[0], np.cumsum(counts)])[by_text]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of some texts, and each text's offsets."""
        parts = list(self.parts(data, offsets))
        sizes = [np.zeros(1, np.int64), *(np.diff(ends) for _, _, _, ends in parts)]
        return np.concatenate([np.zeros(0, np.uint32), *(p[2] for p in parts)]), np.cumsum(np.concatenate(sizes))


_TOKENS: dict[int, Tokens] = {}
_CODED = "kind int, _id long, n long, ids binary"
_IDS, _COUNTS = 0, 1


def squeezed(ids: np.ndarray, kind: str) -> bytes:
    """Ids on their way to the files: narrow, and compressed."""
    import pyarrow as pa

    return pa.compress(ids.astype(kind, copy=False).tobytes(), codec="zstd", asbytes=True) if len(ids) else b""


def unsqueezed(data: bytes, n: int, kind: str) -> np.ndarray:
    import pyarrow as pa

    if not n:
        return np.zeros(0, np.uint32)
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind).astype(np.uint32)


def tokenize(source, end_id: int | None, kind: str):
    """Rows of ids of each text; at last the task's counts of each id."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        text, simple = source.value
        key = hash(text)
        if key not in _TOKENS:
            _TOKENS.clear()
            _TOKENS[key] = Tokens(text, simple)
        tokens, counts = _TOKENS[key], np.zeros(0, dtype=np.int64)
        names, kinds = ["kind", "_id", "n", "ids"], [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi, ids, ends in tokens.parts(data, offsets):
                if end_id is not None:
                    ids, ends = np.insert(ids, ends[1:], np.uint32(end_id)), ends + np.arange(len(ends))
                got = np.bincount(ids, minlength=len(counts))
                got[: len(counts)] += counts
                counts = got
                ids = ids.astype(kind)
                rows = [squeezed(ids[a:b], kind) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(hi - lo, _IDS), pa.int32()), batch.column(0).slice(lo, hi - lo), pa.array(np.diff(ends), pa.int64()), pa.array(rows, pa.binary()),
                ], names=names)
        used = np.flatnonzero(counts)
        if len(used):
            both = used.astype("<i8").tobytes() + counts[used].astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip([_COUNTS, None, len(used), both], kinds, strict=True)], names=names)

    return run


def _unpack(batches) -> Iterator:
    """(token, count) rows of tasks' counts."""
    import pyarrow as pa

    for batch in batches:
        for data in batch.column(0).to_pylist():
            both = np.frombuffer(data, "<i8").reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["token", "count"])


def _files(shared, kind: str):
    """Sorted rows (_id, n, ids) as files' bytes."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        table, part = Table(*shared.value), TaskContext.get().partitionId()
        docs, held, size, seq = [], [], 0, 0

        def record():
            nonlocal docs, held, size, seq
            data = file_bytes(table, part, seq, np.array(docs, _DOC), np.concatenate(held))
            docs, held, size, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])

        for batch in batches:
            for name, n, ids in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if docs and size + n > FILE_IDS:
                    yield record()
                docs.append((name or 0, name is not None, n))
                held.append(unsqueezed(ids, n, kind))
                size += n
        if docs:
            yield record()

    return run


#: What the text writer puts behind each record, here each file.
_TAIL = "\n"


def write_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes all texts and writes ``folder``: ``table`` (the frequencies) and
    ``ids`` (the files, named in order of ``id_col``, an integer)."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship_package(spark)
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    last = max([*Tokenizer.from_str(text).get_vocab().values(), end_id or 0])
    kind, source = "<u2" if last < 1 << 16 else "<u4", spark.sparkContext.broadcast((text, simple_spec(text)))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    coded = written(rows.mapInArrow(tokenize(source, end_id, kind), _CODED), "token_ids")
    counts = coded.where(F.col("kind") == _COUNTS).select("ids").mapInArrow(_unpack, "token long, count long")
    counts.groupBy("token").agg(F.sum("count").alias("count")).coalesce(1).write.parquet(f"{folder}/table")
    # As large as the vocabulary, whatever the number of documents.
    shared = spark.sparkContext.broadcast(frequencies(spark, folder))
    # The row's place splits a frequent id; it decides only between equal rows.
    keys = F.col("_id").asc_nulls_last(), F.col("n"), F.col("hash"), F.col("place")
    ids = coded.where(F.col("kind") == _IDS).select("_id", "n", "ids", F.sha2("ids", 256).alias("hash"), F.monotonically_increasing_id().alias("place"))
    dealt = ids.repartitionByRange(*keys).sortWithinPartitions(*keys).select("_id", "n", "ids")
    files = dealt.mapInArrow(_files(shared, kind), "value binary").select(F.col("value").cast("string"))
    with shuffles_dropped(spark):
        files.write.option("lineSep", _TAIL).option("maxRecordsPerFile", 1).option("compression", "none").text(f"{folder}/ids")


def frequencies(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray]:
    got = spark.read.parquet(f"{folder}/table").toPandas()
    return got["token"].to_numpy(dtype=np.int64), got["count"].to_numpy(dtype=np.int64)


def _opened(folder: str, spark: SparkSession) -> DataFrame:
    """The files' bytes, with the partition and number that their names give."""
    name = F.col("_metadata.file_name")
    number = lambda pattern: F.regexp_extract(name, pattern, 1).cast("long")
    files = spark.read.format("binaryFile").load(f"{folder}/ids").where("length > 0")
    return files.select(number(r"^part-(\d+)").alias("part"), number(r"-c(\d+)\.").alias("seq"), "content")


def _lengths(batches) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        heads = [header(x.as_buffer()) for x in batch.column(2)]
        n = [int(docs["n"].sum()) for _, docs, *_ in heads]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["part", "seq", "n"])


def file_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``part``, ``seq`` and ``start`` (ids in the files before) of every file,
    from the files' headers."""
    sizes = written(_opened(folder, spark).mapInArrow(_lengths, "part long, seq long, n long"), "token_file_sizes")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each task of the sort.
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", before(Window.orderBy("part")).alias("base"))
    within = sizes.withColumn("at", before(Window.partitionBy("part").orderBy("seq")))
    return within.join(parts, "part").select("part", "seq", (F.col("base") + F.col("at")).alias("start"))


def read_files(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``start`` (ids of all documents before), ``n_tokens`` and
    ``ids`` (little-endian unsigned 32-bit integers) of every document, from the
    files alone."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(frequencies(spark, folder))

    def run(batches) -> Iterator:
        import pyarrow as pa

        table = Table(*shared.value)
        slots = table.slots()
        for batch in batches:
            for content, start in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                docs, ids = read_bytes(content.as_buffer(), table, slots)
                ends = np.concatenate([[0], np.cumsum(docs["n"].astype(np.int64))])
                words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(docs), [None, pa.py_buffer(ends * 4), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs["id"], pa.int64(), mask=docs["valid"] == 0), pa.array(start + ends[:-1]), pa.array(np.diff(ends)), words.cast(pa.binary()),
                ], names=["_id", "start", "n_tokens", "ids"])

    files = _opened(folder, spark).join(file_starts(spark, folder), ["part", "seq"]).select("content", "start")
    return files.mapInArrow(run, "_id long, start long, n_tokens long, ids binary").withColumnRenamed("_id", id_col)
