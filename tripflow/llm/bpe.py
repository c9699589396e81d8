"""Byte-pair encoding by a segment tree over adjacent pair ranks.

A pre-token's adjacent pairs are the leaves of a segment tree whose nodes hold
the least (rank, position): the root is the leftmost lowest-rank merge. A merge
changes at most three leaves, each updated along its path to the root, until
the root holds no mergeable pair. Trees of many short pre-tokens are rows of one
array and advance together; a long pre-token has a tree of its own.

Follows a ``tokenizers`` file with a BPE model, NFC and lower-casing, byte-level
letters and a word-end suffix. The vocabulary's path is a parameter; the file is
read once on the driver and broadcast (a vocabulary has a fixed size).

Defined results: NULL text counts as empty and has no tokens; one row in, one
row out, whatever the ids; an empty table gives an empty table; columns other
than the id are not returned.
"""

from __future__ import annotations

import json
import unicodedata
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import pieces, text_buffer
from tripflow.session import ship_package

#: Pre-tokens of more symbols than this are merged one by one.
LONG = 128
#: Nodes in one array of trees.
TREE_NODES = 1 << 20
#: Words remembered by a task, of at most 32 letters on average.
REMEMBERED = 400_000
TEXT_BYTES = 1 << 20
_NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next
    letter from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class Encoder:
    """Encodes pre-tokens; built from the text of a tokenizer file."""

    def __init__(self, source: str):
        import regex

        spec = json.loads(source)
        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for table in (vocab, self.special):
            for name, i in table.items():
                self.names[i] = name
        self.shown = np.array(self.names, dtype=object)
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.final = np.array([vocab[x + end] for x in letters], dtype=np.int64)
        self.width = len(self.names)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"]).findall
        self.gaps = regex.compile(r"\s+").split
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def words(self, text: str) -> list[str]:
        """The text cut at white space, which no pre-token holds, and around
        special tokens, which stand for themselves."""
        if any(s in text for s in self.special):
            return [w for part in self.specials(text) for w in ([part] if part in self.special else self.words(part))]
        # str.split() also cuts at these four, which are not white space here.
        return self.gaps(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def pretokens(self, word: str) -> list[str]:
        if word in self.special:
            return [word]
        if not word.isascii():
            # Letters are lowered one by one, so no final sigma.
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ")
        return self.split(word.lower())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the largest number if it doesn't merge."""
        want = left * self.width + right
        at = np.searchsorted(self.keys, want)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == want, self.order[at], _NONE)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, flat, and each word's number of them."""
        n = len(words)
        raw = [w.encode() for w in words]
        lens = np.fromiter(map(len, raw), dtype=np.int64, count=n)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        end = np.cumsum(lens)
        start = end - lens
        symbols = self.inner[data]
        symbols[end - 1] = self.final[data[end - 1]]
        ids, counts = [symbols[:0]], np.zeros(n, dtype=np.int64)
        order = [np.zeros(0, dtype=np.int64)]
        size_class = np.ceil(np.log2(np.maximum(lens - 1, 1))).astype(np.int64)
        size_class[lens > LONG] = -1
        special = [k for k, w in enumerate(words) if w in self.special]
        size_class[special] = -1
        for bits in np.unique(size_class):
            rows = np.flatnonzero(size_class == bits)
            step = 1 if bits < 0 else max(1, TREE_NODES >> (int(bits) + 1))
            for lo in range(0, len(rows), step):
                some = rows[lo: lo + step]
                if bits < 0:
                    k = some[0]
                    known = self.special.get(words[k])
                    got = self.merge_long(symbols[start[k]: end[k]]) if known is None else np.array([known])
                    counts[k] = len(got)
                else:
                    flat = symbols[spread(start[some], lens[some])]
                    got, counts[some] = self.merge_many(flat, lens[some], 1 << int(bits))
                ids.append(got)
                order.append(some)
        # The chunks' words follow one another; put them in the words' order.
        rows = np.concatenate(order)
        place = np.zeros(n, dtype=np.int64)
        place[rows] = np.cumsum(counts[rows]) - counts[rows]
        return np.concatenate(ids)[spread(place, counts)], counts

    def merge_many(self, symbols: np.ndarray, lens: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """All merges of some words of at most ``leaves`` + 1 symbols: what is
        left of them, flat, and how much of each."""
        n, size = len(lens), leaves + 1
        ids = np.full((n, size + 1), -1, dtype=np.int64)
        ids[:, :size][np.arange(size) < lens[:, None]] = symbols
        # Neighbours: place ``size`` is past either end and holds no symbol.
        after = np.tile(np.arange(1, size + 2), (n, 1))
        after[np.arange(n), lens - 1] = size
        before = np.tile(np.arange(-1, size), (n, 1))
        before[:, 0] = size
        tree = np.full((n, 2 * leaves), _NONE, dtype=np.int64)
        place = np.arange(leaves)

        def keyed(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank == _NONE, _NONE, rank * leaves + at)

        both = np.arange(1, size) < lens[:, None]
        first = np.full((n, leaves), _NONE, dtype=np.int64)
        first[both] = self.ranks(ids[:, : size - 1][both], ids[:, 1:size][both])
        tree[:, leaves:] = keyed(first, place)
        for lo in (1 << k for k in reversed(range(leaves.bit_length() - 1))):
            tree[:, lo: 2 * lo] = np.minimum(tree[:, 2 * lo: 4 * lo: 2], tree[:, 2 * lo + 1: 4 * lo: 2])
        top = 1
        live = np.flatnonzero(tree[:, top] != _NONE)
        while len(live):
            root = tree[live, top]
            at = root % leaves
            gone = after[live, at]
            ids[live, at] = self.made[root // leaves]
            ids[live, gone] = -1
            follow = after[live, gone]
            after[live, at] = follow
            before[live, follow] = at
            prior = before[live, at]
            # Leaves of the merged pair, of the symbol that is gone, and before.
            rows, spots = np.concatenate([live] * 3), np.concatenate([at, np.minimum(gone, leaves - 1), np.minimum(prior, leaves - 1)])
            left = ids[rows, spots]
            right_at = after[rows, spots]
            right = np.where(right_at < size, ids[rows, np.minimum(right_at, size)], -1)
            rank = np.full(len(rows), _NONE, dtype=np.int64)
            real = (left >= 0) & (right >= 0)
            rank[real] = self.ranks(left[real], right[real])
            tree[rows, leaves + spots] = keyed(rank, spots)
            node = (leaves + spots) >> 1
            while node[0]:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node >>= 1
            live = live[tree[live, top] != _NONE]
        left = ids[:, :size] >= 0
        return ids[:, :size][left], left.sum(axis=1)

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one long word, in plain lists."""
        ids, n = symbols.tolist(), len(symbols)
        leaves = 1 << (n - 2).bit_length()
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        rank_of, width, none = self.rank_of, self.width, int(_NONE)

        def key(k: int) -> int:
            if k < 0 or ids[k] < 0 or after[k] < 0:
                return none
            rank = rank_of.get(ids[k] * width + ids[after[k]])
            return none if rank is None else rank * leaves + k

        tree = [none] * (2 * leaves)
        tree[leaves: leaves + n] = map(key, range(n)) if leaves >= n else [key(k) for k in range(n - 1)]
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] != none:
            rank, at = divmod(tree[1], leaves)
            gone = after[at]
            ids[at], ids[gone] = int(self.made[rank]), -1
            after[at] = after[gone]
            if after[at] >= 0:
                before[after[at]] = at
            for k in (at, gone, before[at]):
                if 0 <= k < leaves:
                    node = leaves + k
                    tree[node] = key(k)
                    while node > 1:
                        node >>= 1
                        tree[node] = min(tree[2 * node], tree[2 * node + 1])
        return np.array([x for x in ids if x >= 0], dtype=np.int64)


def spread(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start[k] .. start[k] + counts[k] - 1, one run after another."""
    upto = np.cumsum(counts)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - upto + counts, counts)


class Memory:
    """Encodings of the words between white space that a task has met: flat
    ids, and each word's number, start and count in them."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.start = self.count = self.hits = np.zeros(0, np.int64)
        self.letters = 0

    def forget(self) -> None:
        """Keeps the words met most often, a quarter of what fits."""
        stay = np.argsort(-self.hits, kind="stable")[: REMEMBERED // 4]
        stay = stay[self.hits[stay] > 1]
        chosen = np.zeros(len(self.hits), dtype=bool)
        chosen[stay] = True
        words = [w for w, k in self.number.items() if chosen[k] and len(w) <= LONG]
        old = np.array([self.number[w] for w in words], dtype=np.int64)
        ids, counts, hits = self.ids[spread(self.start[old], self.count[old])], self.count[old], self.hits[old]
        self.clear()
        self.number = dict(zip(words, range(len(words)), strict=True))
        self.ids, self.count, self.start = ids, counts, np.cumsum(counts) - counts
        self.hits = hits // 2
        self.letters = sum(map(len, words))

    def learn(self, words: list[str]) -> None:
        """Encodes new words; equal pre-tokens of theirs only once."""
        split = [self.encoder.pretokens(w) for w in words]
        parts = {p: k for k, p in enumerate(set().union(*split))}
        ids, counts = self.encoder.encode(list(parts))
        of = np.array([parts[p] for one in split for p in one], dtype=np.int64)
        sizes = counts[of]
        flat = ids[spread((np.cumsum(counts) - counts)[of], sizes)].astype(np.int32)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        bounds = upto[np.concatenate([[0], np.cumsum([len(one) for one in split])]).astype(np.int64)]
        self.number.update(zip(words, range(len(self.start), len(self.start) + len(words)), strict=True))
        self.start = np.concatenate([self.start, bounds[:-1] + len(self.ids)])
        self.count = np.concatenate([self.count, np.diff(bounds)])
        self.ids = np.concatenate([self.ids, flat])
        self.hits = np.concatenate([self.hits, np.zeros(len(words), np.int64)])
        self.letters += sum(map(len, words))


_MEMORY: dict[int, Memory] = {}


def memory_of(source: str) -> Memory:
    """A Python worker goes on with what its earlier tasks have met."""
    key = hash(source)
    if key not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[key] = Memory(Encoder(source))
    return _MEMORY[key]


def encode_batch(memory: Memory, texts: list[str]):
    """Token ids (flat, with offsets) and decoded text of each text."""
    split = [memory.encoder.words(t or "") for t in texts]
    met = set().union(*split)
    if len(memory.number) + len(met) > REMEMBERED or memory.letters > LONG * REMEMBERED // 4:
        memory.forget()
    if new := [w for w in met if w not in memory.number]:
        memory.learn(new)
    number = memory.number
    ks = np.array([number[w] for words in split for w in words], dtype=np.int64)
    memory.hits += np.bincount(ks, minlength=len(memory.hits))
    counts = memory.count[ks]
    flat = memory.ids[spread(memory.start[ks], counts)]
    upto = np.concatenate([[0], np.cumsum(counts)])
    offsets = upto[np.concatenate([[0], np.cumsum([len(one) for one in split])]).astype(np.int64)]
    shown = memory.encoder.shown[flat].tolist()
    bounds = offsets.tolist()
    decoded = [" ".join(shown[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    return flat, offsets, decoded


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array of token ids) and ``decoded`` of every text."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(vocabulary, encoding="utf-8") as f:
        source = spark.sparkContext.broadcast(f.read())

    def run(batches):
        import pyarrow as pa

        memory = memory_of(source.value)
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            _, offsets = text_buffer(text)
            for lo, hi in pieces(offsets, TEXT_BYTES):
                flat, offs, decoded = encode_batch(memory, text.slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat, pa.int32())), pa.array(decoded, pa.string())],
                    names=["_id", "ids", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return out.mapInArrow(run, f"_id {kind}, ids array<int>, decoded string").withColumnRenamed("_id", id_col)
