"""Vector codes, token files and periodic runs against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.data import frame, odd_rows, prose, words
from tripflow.llm import periodic_runs, token_files, vector_codes
from tripflow.llm.queries import QUERIES, vocabulary
from tripflow.llm.words import documents, text_buffer

# ------------------------------------------------------------ vector codes

VECTORS = "vec_id long, embedding array<double>, label int, _id string, codes string, error string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECTORS)


def odd_vectors(n=300, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    rows = [(int(i), v.tolist(), int(i) % 3 or None) for i, v in zip(rng.permutation(n), rng.normal(size=(n, dim)), strict=True)]
    same = [0.25] * dim
    rows += [(1000 + k, same, 7) for k in range(60)] + [(5, same, 1), (5, same, 1), (None, same, None)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.5] * (dim - 4), 1), (2003, [0.5] * (dim - 1), 1)]
    rows += [(2004, [math.nan] + same[1:], 1), (2005, [math.inf] + same[1:], 1), (2006, [None] + same[1:], 1), (2007, [0.0] * dim, None)]
    return rows


def plain_codes(rows, entries, parts=4, rounds=4):
    good = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    whole = [[math.floor(1024 * x) for x in r[1]] for r in good]
    width = len(whole[0]) // parts
    codes, error, books = [[] for _ in good], [0] * len(good), []
    for p in range(parts):
        xs = [v[p * width: (p + 1) * width] for v in whole]
        book = xs[:entries]

        def nearest(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), j) for j, y in enumerate(book))

        for _ in range(rounds):
            of = [nearest(x, book)[1] for x in xs]
            mine = [[x for x, j in zip(xs, of, strict=True) if j == k] for k in range(len(book))]
            book = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else y for m, y in zip(mine, book, strict=True)]
        for k, x in enumerate(xs):
            d, j = nearest(x, book)
            codes[k].append(j)
            error[k] += d
        books.append(book)
    return Counter((r[0], r[2], tuple(c), e) for r, c, e in zip(good, codes, error, strict=True)), books


@pytest.mark.parametrize("entries", [1, 7, 500])
def test_vector_codes_equal_plain(spark, monkeypatch, entries):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 64)
    rows = odd_vectors()
    out, books = vector_codes.encode(vector_frame(spark, rows), entries=entries)
    want, plain_books = plain_codes(rows, entries)
    assert Counter((r["vec_id"], r["label"], tuple(r["codes"]), r["error"]) for r in out.collect()) == want
    assert books.tolist() == plain_books
    total = Counter()
    for (_, label, _, e), n in want.items():
        total[label] += e * n
    got = vector_codes.with_label_error(out).collect()
    assert len(got) == want.total() and all(r["label_error"] == total[r["label"]] for r in got)


def test_whole_subtrees_are_assigned():
    rng = np.random.default_rng(1)
    centers = rng.integers(-5000, 5000, (10, 6))
    points = np.repeat(centers, 400, axis=0) + rng.integers(-20, 20, (4000, 6))
    tree = vector_codes.Tree.build(points)
    stretches = [(a, b, e) for s, t, k in tree.assign(centers, True) for a, b, e in zip(s, t, k, strict=True)]
    assert len(stretches) < 100
    of, near = np.full(len(points), -1), vector_codes.squares(points, centers, True)
    for a, b, e in stretches:
        assert (tree.sums[b] - tree.sums[a] == tree.points[a:b].sum(axis=0)).all()
        of[tree.order[a:b]] = e
    assert (of == near.argmin(axis=1)).all()
    assert (near == vector_codes.squares(points, centers, False)).all()


def test_cover_tree_covers():
    points = np.random.default_rng(3).integers(-100, 100, (3000, 3))
    tree = vector_codes.Tree.build(points)
    assert sorted(tree.order) == list(range(len(points)))
    for k in range(len(tree.start)):
        own = tree.points[tree.start[k]: tree.end[k]] - tree.points[tree.center[k]]
        assert (own ** 2).sum(axis=1).max() <= tree.radius[k] ** 2
        kids = slice(tree.child[k], tree.child[k] + tree.children[k])
        if tree.children[k]:
            assert tree.start[kids][0] == tree.start[k] and tree.end[kids][-1] == tree.end[k]
            assert (tree.radius[kids] <= tree.radius[k] / 2 * (1 + 1e-9)).all()
            apart = vector_codes.squares(tree.points[tree.center[kids]], tree.points[tree.center[kids]], True)
            np.fill_diagonal(apart, 1 << 40)
            assert (np.sqrt(apart) * (1 + 1e-9) >= tree.radius[k] / 2).all()


def test_vector_codes_of_nothing_and_of_giants(spark):
    none = vector_frame(spark, [(1, None, 1)])
    out, books = vector_codes.encode(none)
    assert out.count() == 0 and out.columns == ["vec_id", "label", "codes", "error"] and books.size == 0
    assert vector_codes.with_label_error(out).count() == 0
    big = [(k, [float(k * 1000)] * 4, 1) for k in range(20)]
    out, books = vector_codes.encode(vector_frame(spark, big), entries=3)
    want, plain_books = plain_codes(big, 3)
    assert Counter((r["vec_id"], r["label"], tuple(r["codes"]), r["error"]) for r in out.collect()) == want and books.tolist() == plain_books
    with pytest.raises(ValueError, match="pass a long"):
        vector_codes.encode(vector_frame(spark, [(1, [1e30] * 4, 1)]))


# ------------------------------------------------------------ token files


@cache
def library():
    return Tokenizer.from_file(vocabulary())


def plain_ids(text, end_id=1):
    return library().encode(text or "", add_special_tokens=False).ids + [end_id]


def test_token_files_equal_the_library(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 3000)
    rows = odd_rows() + [(30, "<|endoftext|>x<|startoftext|> ’s İstanbul ǅ x\x1cy\x85z　q ﬁ á"), (31, "don't we'll 3rd 12 ... ½²")]
    rows += [(9, "")] * 30 + [(40, "w w")] * 30
    token_files.write_files(frame(spark, rows), vocabulary(), str(tmp_path / "f"))
    out = token_files.read_files(spark, str(tmp_path / "f")).collect()
    coded = [(i, np.frombuffer(r["ids"], "<u4").tolist(), r["start"], r["n_tokens"]) for r in out for i in [r["doc_id"]]]
    assert Counter((i, tuple(ids)) for i, ids, _, _ in coded) == Counter((i, tuple(plain_ids(t))) for i, t in rows)
    coded.sort(key=lambda r: r[2])
    at = 0
    for _, ids, start, n in coded:
        assert start == at and n == len(ids)
        at += n
    keys = [(i is None, i or 0, n) for i, _, _, n in coded]
    assert keys == sorted(keys)
    files = sorted(f for f in (tmp_path / "f" / "ids").iterdir() if f.name.startswith("part") and f.stat().st_size)
    assert len(files) > 5 and all(f.read_bytes().startswith(token_files.MAGIC) for f in files)


def test_token_files_of_nothing(spark, tmp_path):
    for k, rows in enumerate(([], [(None, None), (3, "")])):
        folder = str(tmp_path / str(k))
        token_files.write_files(frame(spark, rows), vocabulary(), folder)
        got = token_files.read_files(spark, folder).collect()
        assert sorted((r["doc_id"] is None, r["start"], bytes(r["ids"])) for r in got) == [(False, 0, b"\1\0\0\0"), (True, 1, b"\1\0\0\0")][: len(rows)]
    folder = str(tmp_path / "no_end")
    token_files.write_files(frame(spark, [(1, None), (2, "a"), (3, "")]), vocabulary(), folder, end_id=None)
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in token_files.read_files(spark, folder).orderBy("doc_id").collect()] == [(1, 0, 0), (2, 0, 1), (3, 1, 0)]


@pytest.mark.parametrize("n", [1, 255, 256, 257, 65535, 65536, 65537, 262144, 262145, 600000])
def test_blocks_and_checkpoints_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n) * 7, 70000).astype(np.uint32)
    ids[0] = 1 << 31
    table = token_files.Table(*np.unique(ids, return_counts=True))
    assert int(table.freq.sum()) == 1 << table.bits and table.freq.min() >= 1
    docs = np.array([(5, 1, n)], token_files._DOC)
    data = token_files.file_bytes(table, 0, 0, docs, ids)
    got_docs, got = token_files.read_bytes(data, table, table.slots())
    assert (got == ids).all() and got_docs["n"][0] == n
    p = np.unique(ids, return_counts=True)[1] / n
    _, _, blocks, checks, at = token_files.header(data)
    assert 32 * blocks["words"].sum() <= n * -(p * np.log2(p)).sum() * 1.02 + 64 * token_files.LANES
    assert len(checks) == sum(-(-int(b) // token_files.STEP_IDS) for b in blocks["n"])
    # Any one checkpoint decodes alone.
    c = checks[-1]
    words = np.frombuffer(data, "<u4", int(blocks["words"].sum()), at).astype(np.uint64)
    base = int(blocks["words"][: c["block"]].sum()) + int(c["place"])
    alone = token_files.decode(c["states"][None].astype(np.uint64), np.array([base]), np.append(words, np.uint64(0)), -(-int(c["n"]) // token_files.LANES), table, table.slots())
    assert (table.ids[alone.ravel()[: c["n"]]] == ids[n - int(c["n"]):]).all()


def test_damage_is_found():
    ids = np.arange(5000, dtype=np.uint32) % 97
    table = token_files.Table(*np.unique(ids, return_counts=True))
    data = token_files.file_bytes(table, 0, 0, np.array([(5, 1, 5000)], token_files._DOC), ids)
    rng = random.Random(4)
    for _ in range(200):
        k = rng.randrange(len(data))
        with pytest.raises(ValueError):
            token_files.read_bytes(data[:k] + bytes([data[k] ^ (1 << rng.randrange(8))]) + data[k + 1:], table, table.slots())
    for cut in (0, 5, 40, 2000, len(data) - 1):
        with pytest.raises(ValueError):
            token_files.read_bytes(data[:cut], table, table.slots())
    other = token_files.Table(np.arange(97), np.arange(1, 98))
    with pytest.raises(ValueError, match="table"):
        token_files.read_bytes(data, other, other.slots())


def test_op12_equals_the_library(spark):
    got = QUERIES["op12_token_files"](spark, SMALL).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in documents(spark, SMALL).select("doc_id", "text").collect()), key=lambda r: (r[0] is None, r[0]))
    at, want = 0, []
    for i, t in rows:
        ids = plain_ids(t)
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got)) == sorted(want)


def test_memory_of_words_can_be_small(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_WORDS", 20)
    source = open(vocabulary(), encoding="utf-8").read()
    tokens = token_files.Tokens(source, token_files.simple_spec(source))
    assert tokens.simple is not None and token_files.Tokens(source).simple is None
    rng = random.Random(6)
    import pyarrow as pa

    for _ in range(5):
        texts = [prose(rng, 100, 60) + " Ünï é́ İx ß12" for _ in range(10)]
        ids, ends = tokens.encode(*text_buffer(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [plain_ids(t)[:-1] for t in texts]


def test_new_and_known_words_cost_no_calls_each():
    import sys

    import pyarrow as pa

    source = open(vocabulary(), encoding="utf-8").read()
    rng = random.Random(8)
    letters = lambda: "".join(rng.choice("etaoinshr") for _ in range(9))
    tokens, many = token_files.Tokens(source, token_files.simple_spec(source)), sorted({letters() for _ in range(20000)})
    for texts in ([" ".join(many[k::50]).capitalize() + "." for k in range(50)], [" ".join(many)]):
        data, calls = text_buffer(pa.array(texts)), Counter()
        sys.setprofile(lambda _, event, __: calls.update([event]))
        try:
            ids, ends = tokens.encode(*data)
        finally:
            sys.setprofile(None)
        assert calls["call"] + calls["c_call"] < len(many) / 4
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [plain_ids(t)[:-1] for t in texts]


def test_words_are_looked_up_over_many_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_files, "TEXT_BYTES", 300)
    monkeypatch.setattr(token_files, "LOOKED_UP_BYTES", 1000)
    monkeypatch.setattr(token_files, "REMEMBERED_WORDS", 50)
    source = open(vocabulary(), encoding="utf-8").read()
    rng = random.Random(9)
    texts = ["", " \t ", *(prose(rng, 40) + rng.choice([" Élève, straße.", " ǅ ſ ŉ ª", " <|ENDOFTEXT|>x", "", "..."]) for _ in range(60)), "\n", "", prose(rng, 900)]
    for spec in (token_files.simple_spec(source), None):
        tokens = token_files.Tokens(source, spec)
        for some in (texts, texts[::-1], [], [""], ["", " "]):
            ids, ends = tokens.encode(*text_buffer(pa.array(some, pa.string())))
            assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [plain_ids(t)[:-1] for t in some]


# ------------------------------------------------------------ periodic runs


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_planted(i, t):
    w = words(t)
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def periodic_rows(seed=8):
    rng = random.Random(seed)
    rows = []
    for k in range(120):
        base = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        tail = (base * 30)[: rng.randrange(0, 120)]
        w = [rng.choice("abcdefgh"[: rng.randrange(1, 8)]) for _ in range(rng.randrange(0, 40))] + tail + [rng.choice("abc") for _ in range(rng.randrange(0, 20))]
        rows.append((100 + k, rng.choice([" ", "\n", "\t "]).join(w)))
    return rows + [(300, "Word word " * 3), (301, "x " * 5), (302, "x " * 6), (303, "p q " * 4), (304, "p q " * 3 + "p"), (305, "ß 中 " * 9)]


@pytest.mark.parametrize("cost", [1, 1 << 12, 1 << 40])
def test_runs_equal_plain(spark, monkeypatch, cost):
    monkeypatch.setattr(periodic_runs, "_PROBE_COST", cost)
    rows = odd_rows() + periodic_rows()
    out = periodic_runs.find_runs(frame(spark, rows)).collect()
    want = Counter((i, tuple(plain_runs(words(t))), collapsed(words(t), plain_runs(words(t)))) for i, t in rows if len(words(t)) < 5000)
    got = Counter((r["doc_id"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in out if len(words(dict(rows)[r["doc_id"]] if r["doc_id"] == 21 else "")) < 5000)
    assert got == want


def test_rare_words_split_until_stable():
    #          run of a b        c is rare; then d occurs four times only with the left part
    w = list("ababababab") + ["c"] + list("dxdxd") + ["e"] + list("d") + list("aaaaaa")
    number = np.array([ord(x) for x in w])
    assert periodic_runs.split(number, np.array([0, len(w)])) == [(0, 10), (18, 24)]
    assert periodic_runs.runs_of(number, np.array([0, len(w)])) == [(0, 10, 2), (18, 6, 1)]


def test_long_periodic_texts_are_quick():
    for x in (np.zeros(300000, np.int64), np.tile(np.random.default_rng(1).integers(0, 500, 999), 300)):
        assert [r[1:] for r in periodic_runs.runs_of(x, np.array([0, len(x)]))] == [(len(x), 1 if not x.any() else 999)]


def test_op13_equals_plain(spark, tmp_path):
    rows = odd_rows() + periodic_rows()
    rows += [(k, " ".join(f"w{j % 37}" for j in range(60))) for k in range(400, 500)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for i, t in rows:
        w = plain_planted(i, t)
        runs = plain_runs(w)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        text = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        want[i, len(runs), s, n, q, 1000 * n // q if runs else None, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest()] += 1
    got = Counter(map(tuple, QUERIES["op13_periodic_runs"](spark, str(tmp_path)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()))
    assert got == want
    assert any(k[1] for k in want if k[0] and k[0] >= 400)
    assert dict(QUERIES["op13_periodic_runs"](spark, str(tmp_path)).dtypes)["exponent_milli"] == "bigint"


def test_op13_of_nothing(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op13_periodic_runs"](spark, str(tmp_path)).count() == 0
    assert periodic_runs.find_runs(frame(spark, [(1, None)])).select(F.size("runs")).first()[0] == 0
