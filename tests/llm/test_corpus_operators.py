"""Suffix dedup, scoring, joins, mixing, neighbours and the pipeline, each held
against a plain version on small inputs."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import frame, lower, odd_rows, prose, words
from tripflow.llm import components, jaccard_join, lm_score, mixing, nearest, suffix_dedup


# Suffix dedup ---------------------------------------------------------------

def plain_spans(rows, length=100):
    out, seen = [], set()
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for q in range(len(b) - length + 1):
            if (w := b[q: q + length]) in seen:
                gone[q: q + length] = b"\1" * length
            else:
                seen.add(w)
        edges = [k for k in range(len(b) + 1) if (gone[k] if k < len(b) else 0) != (gone[k - 1] if k else 0)]
        spans = tuple(zip(edges[::2], edges[1::2], strict=True))
        out.append((i, len(b), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return Counter(out)


def spans_of(df):
    return Counter((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in suffix_dedup.dedup_bytes(df).collect())


def test_suffix_dedup_equals_plain(spark):
    rows = odd_rows()
    assert spans_of(frame(spark, rows)) == plain_spans(rows)


def test_suffix_dedup_across_blocks_and_runs(spark, monkeypatch):
    rng = random.Random(8)
    shared = [prose(rng, n) for n in (30, 40, 80)]
    rows = []
    for k in range(80):
        parts = [prose(rng, rng.randrange(5, 60)) for _ in range(3)]
        if k % 3 == 0:
            parts.insert(rng.randrange(4), rng.choice(shared))
        rows.append((k, " ".join(parts)))
    rows += [(100 + k, rows[k][1][3:]) for k in range(0, 80, 7)] + [(200, "ab" * 200), (201, "ab" * 120), (202, "c" * 99), (203, "c" * 100), (204, "c" * 101)]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    assert spans_of(frame(spark, rows)) == plain_spans(rows)


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.dedup_bytes(frame(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_induced_order_in_memory_and_on_disk(limit, monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(suffix_dedup, "RUN", 7)
    n, left_max, length = 60, suffix_dedup.LEFT, suffix_dedup.LENGTH
    windows = np.zeros((n, suffix_dedup.WIDTH), np.uint8)
    windows[:] = rng.integers(97, 99, (1, suffix_dedup.WIDTH))
    for k in range(n):
        windows[k, rng.integers(0, suffix_dedup.WIDTH, 2)] = 99
    left, right = rng.integers(0, left_max + 1, n), rng.integers(60, length + 1, n)
    rank = rng.permutation(n)
    got = suffix_dedup.repeated_starts(windows, left, right, rank, suffix_dedup.Store(limit))
    first = {}
    for k in np.argsort(rank):
        for x in range(left_max + 1):
            there = x <= left[k] and length - x <= right[k]
            key = (x, windows[k, left_max - x: left_max - x + length].tobytes())
            assert got[k, x] == (there and key in first)
            if there:
                first.setdefault(key, k)


# Language model -------------------------------------------------------------

def fold():
    r = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10, F.lit(0))
    return F.when(r == 0, lm_score.SCORED).when(r == 1, lm_score.DELETED).otherwise(lm_score.KEPT)


def remainder(i):
    return zlib.crc32(str(i).encode()) % 10 if i is not None else 0


def test_lm_counts_and_score_equal_plain(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 20000)
    rng = random.Random(4)
    rows = odd_rows() + [(300 + k, prose(rng, 80)) for k in range(120)]
    got = Counter()
    seen = {}
    original = lm_score.mixture

    def remember(cells, v, **kw):
        seen["w"], seen["cells"] = original(cells, v, **kw), cells
        return seen["w"]

    monkeypatch.setattr(lm_score, "mixture", remember)
    out = lm_score.score_documents(frame(spark, rows), fold()).collect()
    c, pairs = Counter(), Counter()
    for i, t in rows:
        if remainder(i):
            tokens = [None, *words(lower(t)), "</>"]
            c.update(tokens[1:])
            pairs.update(itertools.pairwise(tokens))
    n, v = sum(c.values()), len(c)
    assert seen["cells"]["times"].sum() == sum(len(words(t)) + 1 for i, t in rows if remainder(i) == 1)

    def plain(t):
        tokens = [None, *words(lower(t)), "</>"]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[1:])
        total = 0.0
        for h, w in itertools.pairwise(tokens):
            ch = c["</>"] if h is None else c[h]
            w3 = seen["w"][min(ch.bit_length(), lm_score.BUCKETS - 1)]
            total += math.log10(w3[0] * (pairs[h, w] / ch if ch else 0) + w3[1] * c[w] / n + w3[2] / (v + 1))
        return len(tokens) - 1, sum(c[w] > 0 for w in tokens[1:]), n, round(base, 6), round(total, 6)

    got = Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in out)
    assert got == Counter((i, *plain(t)) for i, t in rows)


def test_lm_weights_sum_to_one_and_fit():
    import pandas as pd

    cells = pd.DataFrame({"b": [3, 3], "c2": [0, 1], "c1": [0, 1], "times": [90, 10], "two": [45.0, 0.0], "one": [0.09, 0.01]})
    w = lm_score.mixture(cells, 1000)
    assert np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0 and w[3, 0] > 0.8 and (w[3] > 0).all()


def test_lm_packs():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 48, 500, dtype=np.uint64))
    assert (lm_score.unpack_keys(lm_score.pack_keys(keys)) == keys).all()
    counts = np.array([0, 1, 254, 255, 256, 1 << 40])
    assert (lm_score.unpack_counts(lm_score.pack_counts(counts)) == counts).all()
    assert len(lm_score.unpack_keys(lm_score.pack_keys(keys[:0]))) == 0


def test_lm_without_training_or_rows(spark):
    df = frame(spark, [(k, t) for k, t in enumerate(["a b", None, ""])])
    out = lm_score.score_documents(df, F.lit(lm_score.SCORED)).collect()
    assert [r["n_known"] for r in out] == [0, 0, 0] and all(np.isfinite(r["score"]) for r in out)
    assert lm_score.score_documents(frame(spark, []), fold()).count() == 0


# Jaccard join ---------------------------------------------------------------

def plain_groups(rows, n, percent):
    sets = defaultdict(list)
    for i, t in rows:
        w = words(lower(t))
        sets[i].append(frozenset(tuple(w[k: k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    parent = {i: i for i in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    items = [(i, s) for i, many in sets.items() if i is not None for s in many if s]
    for (i, a), (j, b) in itertools.combinations(items, 2):
        both = len(a & b)
        if both and 100 * both >= percent * (len(a) + len(b) - both):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return Counter((i, len(s), find(i) if i is not None else None) for i, many in sets.items() for s in many)


def groups_of(df, n, percent):
    return Counter(map(tuple, jaccard_join.join_groups(df, n, percent).select("doc_id", "n_shingles", "component_id").collect()))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_join_equals_plain(spark, n, percent):
    rng = random.Random(n)
    rows = odd_rows()
    key = 1000
    for size in (6, 15, 40, 130):  # groups of near copies, near and past the bound
        base = prose(rng, size, 5000).split(" ")
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = "z%d" % rng.randrange(9)
            rows.append((key, " ".join(copy)))
            key += 1
    chain = prose(rng, 300, 5000).split(" ")
    for k in range(12):  # each like the next, the ends unlike
        rows.append((key + (k * 7) % 12, " ".join(chain[k * 6: k * 6 + 200])))
    passage = prose(rng, 60, 5000)
    rows += [(2000 + k, passage + " " + prose(rng, 60, 5000)) for k in range(25)]
    assert groups_of(frame(spark, rows), n, percent) == plain_groups(rows, n, percent)


def test_join_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 5000)
    rng = random.Random(9)
    base = [prose(rng, 80, 3000) for _ in range(20)]
    rows = [(k, base[k % 20].replace("w1", "v%d" % rng.randrange(5), 1)) for k in range(120)]
    assert groups_of(frame(spark, rows).repartition(5), 3, 90) == plain_groups(rows, 3, 90)


def test_join_looks_past_copies_without_an_id(spark):
    rng = random.Random(12)
    base = prose(rng, 120, 5000)
    rows = [(None, base), (7, base), (3, base + " end"), (None, "x y z"), (None, base)]
    assert groups_of(frame(spark, rows).coalesce(1), 3, 90) == plain_groups(rows, 3, 90)
    assert groups_of(frame(spark, rows[-2:]).coalesce(1), 3, 90) == plain_groups(rows[-2:], 3, 90)


def test_join_of_nothing(spark):
    assert jaccard_join.join_groups(frame(spark, [])).count() == 0


def test_bounds_lose_no_pair():
    for p in (80, 90):
        b = jaccard_join.Bounds(p)
        for a in range(1, 300):
            for c in range(a, a * 100 // p + 1):
                differ = (100 - p) * (a + c) // (100 + p)
                sizes = np.array([a, c])
                own = np.searchsorted(b.top, sizes)
                up = int(own[1] - own[0])
                assert up in (0, 1)
                ka, kc = b.of(sizes[:1], up), b.of(sizes[1:], 0)
                assert ka[0] == kc[0] and ka[1] == kc[1] > 0
                assert max(ka[2], kc[2]) <= max(1, ka[1] - differ) and ka[1] > differ


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = dict(map(tuple, components.connected(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)}


# Mixing ---------------------------------------------------------------------

def test_mix_meets_targets(spark):
    rng = random.Random(6)
    rows = [(k, prose(rng, rng.randrange(1, 300)), f"s{k % 5}" if k % 9 else None) for k in range(200)]
    rows += [(500 + k, prose(rng, 30), "tiny") for k in range(3)] + [(0, rows[0][1], rows[0][2]), (None, "a b c", "s1"), (601, None, "s1"), (602, "", "only empty")]
    df = frame(spark, rows)
    out = mixing.taken(mixing.mix(df)).toPandas()
    assert Counter(out["size"]) == Counter(len(words(t)) for _, t, _ in rows)
    assert (out["taken"] <= 3 * out["size"]).all()
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(len(words(r[1])) for r in rows if r[2] == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, open_ = {}, list(sources)
    rest = sum(size.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * size[s]
            rest -= target[s]
            open_.remove(s)
    target |= share
    for s in sources:
        own = out[out["source"].isna() if s is None else out["source"] == s]
        assert own["target"].iloc[0] == pytest.approx(target[s]) and own["source_size"].iloc[0] == size[s]
        assert abs(own["taken"].sum() - target[s]) <= 2 * mixing.BLOCK_WORDS
    again = mixing.taken(mixing.mix(df)).toPandas()
    cols = ["_id", "source", "size", "taken"]
    assert out[cols].sort_values(cols).values.tolist().__repr__() == again[cols].sort_values(cols).values.tolist().__repr__()


def test_mixed_texts_hold_the_words_taken(spark):
    rng = random.Random(7)
    rows = [(k, "  " * (k % 2) + prose(rng, rng.randrange(1, 200)), f"s{k % 4}") for k in range(60)] + [(3, prose(rng, 5), "s3"), (99, None, "s0")]
    df = frame(spark, rows)
    m = mixing.mix(df)
    want = Counter()
    for r in mixing.taken(m).collect():
        want[r["_id"]] += r["taken"]
    out = mixing.mixed_documents(df, m)
    assert out.columns == df.columns
    got = Counter()
    for r in out.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    assert +got == +want


def test_slots_are_dealt_once_and_shards_vary(spark):
    rng = random.Random(1)
    df = frame(spark, [(k, prose(rng, 300), f"s{k % 3}") for k in range(120)])
    m = mixing.mix(df)
    slots = m.slots.toPandas()
    assert not slots.duplicated(["shard", "place"]).any() and not slots.duplicated(["s", "epoch", "block"]).any()
    assert len(slots) == m.sources.select(F.sum("n_slots")).first()[0]
    n = 1000
    images = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("y")).toPandas()["y"]
    assert sorted(images) == list(range(n)) and abs(np.corrcoef(images, np.arange(n))[0, 1]) < 0.15


def test_mix_of_nothing(spark):
    m = mixing.mix(frame(spark, []))
    assert mixing.taken(m).count() == 0 and mixing.mixed_documents(frame(spark, []), m).count() == 0


# Nearest neighbours ---------------------------------------------------------

def plain_neighbours(rows, k, ask):
    seen = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            seen[i] = min(seen.get(i, v), v)
    out = Counter()
    for q in seen:
        if not ask(q):
            continue
        scored = []
        for i, v in seen.items():
            if i != q and len(v) == len(seen[q]):
                s = 0.0
                for a, b in zip(seen[q], v, strict=True):
                    s += a * b
                scored.append((-s, i))
        out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k]))
    return out


@pytest.mark.parametrize("side_bytes", [512, 4096, 16 << 20])  # 8, 64 and all vectors a side
def test_neighbours_equal_plain(spark, monkeypatch, side_bytes):
    monkeypatch.setattr(nearest, "TILE_ROWS", 32)
    monkeypatch.setattr(nearest, "SIDE_BYTES", side_bytes)
    rng = np.random.default_rng(2)
    as32 = lambda v: [float(np.float32(x)) for x in v]
    rows = [(k, as32(rng.normal(size=8))) for k in range(260)]
    rows += [(300 + k, rows[40][1]) for k in range(60)]  # a common vector
    rows += [(5, rows[5][1]), (6, as32(rng.normal(size=8))), (400, [0.0] * 8), (401, None), (402, []), (403, [1.0, None] + [0.0] * 6)]
    rows += [(404, [float("nan")] * 8), (420, [float("inf")] * 8), (None, rows[1][1]), (405, [1.0, 2.0]), (440, [3.0, 1.0])]
    rows += [(7, as32(rng.normal(size=8))) for _ in range(100)]  # a common id
    df = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], "vec_id long, embedding array<float>, tile string, label int, _v string")
    got = Counter(map(tuple, nearest.neighbours(df, F.col("vec_id") % 20 == 0, k=7).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == plain_neighbours(rows, 7, lambda q: q % 20 == 0)


def test_neighbours_of_few_and_none(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert list(map(tuple, nearest.neighbours(df, F.col("vec_id") % 20 == 0).collect())) == [(20, 1, 1, 0.5)]
    assert nearest.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_products_are_only_across_groups(spark, monkeypatch):
    """Near copies, and one row that meets all of them and links with none: as many
    rows are multiplied as there are copies, however many signatures they share."""
    monkeypatch.setattr(jaccard_join, "SQUARE", 16)
    rng = random.Random(11)
    base = [f"w{rng.randrange(4000)}" for _ in range(300)]

    def changed(k):
        out = list(base)
        for at in range(5, 5 + 40 * k, 40):
            out[at] = f"x{rng.randrange(10 ** 9)}"
        return " ".join(out)

    seen = {}
    real = jaccard_join.written

    def count(df, name):
        out = real(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "written", count)
    for t in (60, 180):
        rows = [(k, changed(1)) for k in range(t)] + [(1000, changed(6))]
        got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join_groups(frame(spark, rows)).collect()}
        assert got == set(plain_groups(rows, 3, 90)) and len({c for _, _, c in got}) == 2
        assert 0 < seen["join_squares"] <= 2 * t + 2 * t // 16 + 16


@pytest.mark.parametrize(("many", "hubs"), [(0, 0), (16, 0), (2, 4)])
def test_blocks_and_squares_lose_no_link(spark, monkeypatch, many, hubs):
    monkeypatch.setattr(jaccard_join, "MANY", many)
    monkeypatch.setattr(jaccard_join, "HUB_ROUNDS", hubs)
    monkeypatch.setattr(jaccard_join, "SQUARE", 3)
    monkeypatch.setattr(jaccard_join, "SQUARE_GRAMS", 700)
    rng = random.Random(12)
    rows = odd_rows()
    for family in range(6):
        text = prose(rng, rng.randrange(60, 220)).split(" ")
        for _ in range(9):
            own = list(text)
            for _ in range(rng.randrange(0, 7)):
                own[rng.randrange(len(own))] = f"z{rng.randrange(99)}"
            rows.append((100 + len(rows), " ".join(own)))
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join_groups(frame(spark, rows)).collect())
    assert got == Counter(plain_groups(rows, 3, 90))


def test_rows_of_one_id_and_text_stay_with_their_source(spark):
    rng = random.Random(14)
    text = prose(rng, 640)
    rows = [(1, text, "x"), (1, text, "y"), *((k, prose(rng, 500), rng.choice("xy")) for k in range(10, 30))]
    df = frame(spark, rows)
    m = mixing.mix(df)
    want = Counter()
    for r in mixing.taken(m).collect():
        want[r["_id"], r["source"]] += r["taken"]
        assert (r["first_shard"] is None) == (r["last_shard"] is None) == (r["taken"] == 0)
    got = Counter()
    for r in mixing.mixed_documents(df, m).collect():
        got[r["doc_id"], r["source"]] += len(words(r["text"]))
    assert +got == +want and got[1, "x"] and got[1, "y"]


def test_the_dealt_slots_decide(spark):
    m = mixing.mix(frame(spark, [(k, prose(random.Random(k), 900), "ab"[k % 2]) for k in range(40)]))
    plan = mixing.taken(m)._jdf.queryExecution().optimizedPlan().toString()
    assert "shard" in plan and "place" in plan
    slots, spans, size = m.slots.toPandas(), m.spans.toPandas(), {}
    for s, block in zip(slots["s"], slots["block"], strict=True):
        for r in spans[(spans["s"] == s) & (spans["block"] == block)].itertuples():
            size[r._1] = size.get(r._1, 0) + r.to_word - r.from_word
    assert {r["_id"]: r["taken"] for r in mixing.taken(m).collect() if r["taken"]} == size


def test_other_columns_of_any_kind_are_kept(spark):
    df = frame(spark, [(1, "a b c d e f g h i j k l m n o p"), (1, "a b c d e f g h i j k l m n o p")]).withColumn("tags", F.create_map(F.lit("k"), F.col("doc_id")))
    out = mixing.mixed_documents(df, mixing.mix(df)).collect()
    assert out and all(r["tags"] == {"k": 1} for r in out)
