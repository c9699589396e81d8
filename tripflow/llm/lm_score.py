"""Language-model scoring by deleted interpolation.

P(w | h) mixes the maximum-likelihood bigram c(h, w) / c(h), the unigram
c(w) / N and the uniform 1 / (V + 1); the weights depend on how often the
context h was seen (one bucket for each power of two). They are learned by
expectation-maximisation on held-out counts: the documents of one fold are
deleted from the counts and predicted by the rest. Scores then use the counts
of all training documents.

How it runs: documents are dealt into blocks of about ``BLOCK_BYTES`` of text. A
block sends each distinct n-gram once, with its count, to the shard that holds
the n-gram's key range; the shard adds up and answers each block with counts in
the order of its keys, no keys. So what moves grows with the distinct n-grams of
the blocks, a frequent n-gram is one entry a block, and no table of the model is
ever broadcast. Words are told apart by 64-bit hashes; bigram keys have
``KEY_BITS`` bits.

Defined results: NULL text counts as empty and has one token, the end; a NULL id
counts as the empty text when folds are drawn; every row is scored, and counts
where its fold does, also if it repeats another; without training documents
every count is zero; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import U64, mix, pieces, text_buffer, word_hashes, written
from tripflow.session import ship_package

BLOCK_BYTES = 10 << 20
KEY_BITS = 48
END, START = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
BUCKETS = 48
#: Folds of a document: scored only, deleted for the weights, all else.
SCORED, DELETED, KEPT = 0, 1, 2
_FULL = (1 << 32) - 1


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as 4-byte steps; a long step is filled up by full ones."""
    steps = np.diff(keys, prepend=U64(0))
    fill, rest = np.divmod(steps, U64(_FULL))
    out = np.full(len(keys) + int(fill.sum()), _FULL, dtype=np.uint32)
    out[np.cumsum(fill.astype(np.int64) + 1) - 1] = rest
    return out.tobytes()


def unpack_keys(b: bytes) -> np.ndarray:
    steps = np.frombuffer(b, dtype=np.uint32)
    return np.cumsum(steps, dtype=np.uint64)[steps != _FULL]


def pack_counts(counts: np.ndarray) -> bytes:
    """One byte a count; larger ones follow, eight bytes each."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return np.int64(len(counts)).tobytes() + small.tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def unpack_counts(b: bytes) -> np.ndarray:
    n = int(np.frombuffer(b, dtype=np.int64, count=1)[0])
    out = np.frombuffer(b, dtype=np.uint8, count=n, offset=8).astype(np.int64)
    out[out == 255] = np.frombuffer(b, dtype=np.uint8, offset=8 + n).view(np.int64)
    return out


class Block:
    """Tokens of some texts, and their distinct words and bigrams."""

    def __init__(self, text):
        data, offsets = text_buffer(text)
        parts, ends, done = [], [], 0
        for lo, hi in pieces(offsets):
            h, by_text = word_hashes(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
            parts.append(np.insert(h, by_text[1:], END))
            ends.append(by_text[1:] + np.arange(1, hi - lo + 1) + done)
            done += len(parts[-1])
        token = np.concatenate([*parts, np.zeros(0, np.uint64)])
        self.end = np.concatenate([*ends, np.zeros(0, np.int64)])
        self.start = np.concatenate([[0], self.end[:-1]]).astype(np.int64)[: len(self.end)]
        self.context = np.concatenate([[START], token[:-1]])[: len(token)]
        self.context[self.start] = START
        self.words, self.word, self.word_n = np.unique(token, return_inverse=True, return_counts=True)
        pair = mix(self.context * U64(3) + token) >> U64(64 - KEY_BITS)
        self.pairs, self.pair, self.pair_n = np.unique(pair, return_inverse=True, return_counts=True)

    def context_count(self, word_c: np.ndarray) -> np.ndarray:
        """Count of each token's context: of its word; the start is seen as
        often as the end."""
        ends = word_c[np.searchsorted(self.words, END)] if len(self.words) else 0
        before = np.concatenate([[0], self.word[:-1]])[: len(self.word)]
        out = word_c[before] if len(before) else word_c[:0]
        out[self.start] = ends
        return out

    def doc_sums(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(np.repeat(np.arange(len(self.end)), self.end - self.start), weights=x, minlength=len(self.end))


def _shard_bounds(keys: np.ndarray, bits: int, key_bits: int) -> np.ndarray:
    tops = (keys >> U64(key_bits - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    return np.searchsorted(tops, np.arange((1 << bits) + 1))


_SENT = "shard int, block long, fold int, words binary, word_n binary, pairs binary, pair_n binary"
_ANSWER = "block long, shard int, words binary, pairs binary, kept_words binary, kept_pairs binary, v long, kept_v long, n long, kept_n long"


def _send(bits: int):
    def run(key, table):
        import pyarrow as pa

        block, fold = key[0].as_py(), key[1].as_py()
        b = Block(table.column("_text"))
        ws, ps = _shard_bounds(b.words, bits, 64), _shard_bounds(b.pairs, bits, KEY_BITS)
        rows = []
        for s in range(1 << bits):
            w, p = slice(ws[s], ws[s + 1]), slice(ps[s], ps[s + 1])
            if ws[s] < ws[s + 1] or ps[s] < ps[s + 1]:
                low = b.pairs[p] - U64(s << (KEY_BITS - bits))
                rows.append((s, block, fold, b.words[w].tobytes(), pack_counts(b.word_n[w]), pack_keys(low), pack_counts(b.pair_n[p])))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
        return pa.table({n.split()[0]: pa.array(c, k) for n, c, k in zip(_SENT.split(", "), cols, kinds, strict=True)})

    return run


def _totals(keys: list[np.ndarray], counts: list[np.ndarray], folds: list[int]):
    """Each part's keys' counts over all training parts and over the kept ones."""
    sizes = list(map(len, keys))
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    fold, n = np.repeat(folds, sizes), np.concatenate(counts)
    both = [np.bincount(at, weights=n * use, minlength=len(distinct)).astype(np.int64) for use in (fold != SCORED, fold == KEPT)]
    ends = np.cumsum(sizes)[:-1]
    return both, [np.split(c[at], ends) for c in both]


def _answer(key, table):
    import pyarrow as pa

    shard = key[0].as_py()
    rows = table.to_pylist()
    folds = [r["fold"] for r in rows]
    both_w, (words, kept_words) = _totals([np.frombuffer(r["words"], np.uint64) for r in rows], [unpack_counts(r["word_n"]) for r in rows], folds)
    _, (pairs, kept_pairs) = _totals([unpack_keys(r["pairs"]) for r in rows], [unpack_counts(r["pair_n"]) for r in rows], folds)
    out = []
    for k, r in enumerate(rows):
        kept = [pack_counts(kept_words[k]), pack_counts(kept_pairs[k])] if r["fold"] == DELETED else [None, None]
        out.append((r["block"], shard, pack_counts(words[k]), pack_counts(pairs[k]), *kept, 0, 0, 0, 0))
    size = [int((c > 0).sum()) for c in both_w] + [int(c.sum()) for c in both_w]
    out.append((-1, shard, None, None, None, None, *size))
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4, *[pa.int64()] * 4]
    return pa.table({n.split()[0]: pa.array(c, k) for n, c, k in zip(_ANSWER.split(", "), zip(*out, strict=True), kinds, strict=True)})


def _counts(answers, column: str) -> np.ndarray:
    parts = answers.select(["shard", column]).sort_by("shard").column(column).to_pylist()
    return np.concatenate([*(unpack_counts(p) for p in parts), np.zeros(0, np.int64)])


def _parts(b: Block, word_c: np.ndarray, pair_c: np.ndarray, n: int):
    """Bucket, bigram and unigram probability of each token."""
    context = b.context_count(word_c)
    two = np.divide(pair_c[b.pair], context, out=np.zeros(len(context)), where=context > 0)
    one = word_c[b.word] / max(n, 1)
    bucket = np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)
    return bucket, two, one


@dataclass
class Model:
    """Weights of bigram, unigram and uniform for each bucket, and sizes."""

    weights: np.ndarray
    n: int
    v: int


def _events(n: int):
    """Held-out tokens of a block as a histogram: for each bucket and cell of a
    quarter octave of both probabilities, how many and their sums."""
    def cell(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, np.rint(np.log2(np.maximum(p, 2.0**-60)) * 4).astype(np.int64), -999)

    def run(docs, answers):
        import pyarrow as pa

        b = Block(docs.column("_text"))
        bucket, two, one = _parts(b, _counts(answers, "kept_words"), _counts(answers, "kept_pairs"), n)
        keys, at, times = np.unique(np.stack([bucket, cell(two), cell(one)]), axis=1, return_inverse=True, return_counts=True)
        sums = [np.bincount(at.ravel(), weights=x, minlength=len(times)) for x in (two, one)]
        return pa.table({"b": keys[0], "c2": keys[1], "c1": keys[2], "times": times, "two": sums[0], "one": sums[1]})

    return run


def mixture(cells, v: int, rounds: int = 100) -> np.ndarray:
    """Weights by expectation-maximisation; a token's worth of belief in each
    part keeps every weight above zero, but for the bigram of an unseen
    context, which has none."""
    out = np.full((BUCKETS, 3), 1 / 3)
    for b in range(BUCKETS):
        own = cells[cells["b"] == b]
        times = own["times"].to_numpy(dtype=float)
        p = np.stack([own["two"] / times, own["one"] / times, np.full(len(own), 1 / (v + 1))], axis=1) if len(own) else np.zeros((0, 3))
        live = np.array([b > 0, True, True], dtype=float)
        w = live / live.sum()
        for _ in range(rounds):
            part = p * w
            share = (part / part.sum(axis=1, keepdims=True) * times[:, None]).sum(axis=0) + live
            new = share / share.sum()
            done = np.abs(new - w).max() < 1e-9
            w = new
            if done:
                break
        out[b] = w
    return out


def _score(model: Model):
    def run(docs, answers):
        import pyarrow as pa

        b = Block(docs.column("_text"))
        word_c = _counts(answers, "words")
        bucket, two, one = _parts(b, word_c, _counts(answers, "pairs"), model.n)
        w = model.weights[bucket]
        p = w[:, 0] * two + w[:, 1] * one + w[:, 2] / (model.v + 1)
        c = word_c[b.word]
        base = np.log10((c + 0.1) / (model.n + 0.1 * (model.v + 1)))
        return pa.table({
            "_id": docs.column("_id"), "n_tokens": b.end - b.start, "n_known": b.doc_sums(c > 0).astype(np.int64),
            "base_score": b.doc_sums(base), "score": b.doc_sums(np.log10(p)),
        })

    return run


def score_documents(docs: DataFrame, fold: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    and ``score`` (log10 probability) of every text. ``fold`` says which
    documents are only scored, deleted for the weights, or kept throughout."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), fold.alias("fold"))
    size = {r["fold"]: r["b"] for r in rows.groupBy("fold").agg(F.sum(F.octet_length("_text")).alias("b")).collect()}
    blocks = [max(1, -(-(size.get(f) or 0) // BLOCK_BYTES)) for f in (SCORED, DELETED, KEPT)]
    bits = (sum(blocks) - 1).bit_length()
    n_of = F.element_at(F.array(*map(F.lit, blocks)), F.col("fold") + 1).cast("long")
    first = F.element_at(F.array(F.lit(0), F.lit(blocks[0]), F.lit(blocks[0] + blocks[1])), F.col("fold") + 1).cast("long")
    dealt = rows.withColumn("block", first + F.pmod(F.xxhash64(F.col("_id").cast("string"), F.octet_length("_text")), n_of))
    sent = dealt.groupBy("block", "fold").applyInArrow(_send(bits), _SENT)
    answers = written(sent.groupBy("shard").applyInArrow(_answer, _ANSWER), "lm_counts")
    sizes = answers.where("block < 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("v", "kept_v", "n", "kept_n"))).first()
    held = answers.where((F.col("block") >= blocks[0]) & (F.col("block") < blocks[0] + blocks[1])).select("block", "shard", "kept_words", "kept_pairs")
    cells = (
        dealt.where(F.col("fold") == DELETED).select("block", "_text").groupBy("block")
        .cogroup(held.groupBy("block")).applyInArrow(_events(sizes["kept_n"]), "b long, c2 long, c1 long, times long, two double, one double")
        .groupBy("b", "c2", "c1").agg(*(F.sum(c).alias(c) for c in ("times", "two", "one"))).toPandas()  # cells, not tokens
    )
    model = Model(mixture(cells, sizes["kept_v"]), sizes["n"], sizes["v"])
    return (
        dealt.select("block", "_id", "_text").groupBy("block")
        .cogroup(answers.where("block >= 0").select("block", "shard", "words", "pairs").groupBy("block"))
        .applyInArrow(_score(model), f"_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double")
        .withColumn("train_tokens", F.lit(sizes["n"]).cast("long"))
        .withColumnRenamed("_id", id_col)
    )
