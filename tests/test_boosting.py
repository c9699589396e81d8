"""Boosting against plain versions."""

import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.operators import boosting
from tripflow.session import scratch_path

ZONES = ["a", "b", "c", "d"]


def rows(n=900, seed=5):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        zone, hour, lag = rng.randrange(4), rng.randrange(24), rng.choice([None, float(rng.randrange(40))])
        y = [3, 30, 8, 0][zone] * (1 + (hour > 7) * 2) + (lag or 0) / 4 + rng.gauss(0, 1)
        out.append((float(zone) if k % 50 else 4.0, float(hour), lag, round(max(y, 0.0), 2) if k % 97 else None))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "zone DOUBLE, hour DOUBLE, lag DOUBLE, y DOUBLE")


FEATURES = ["zone", "hour", "lag"]
SETTINGS = {"max_rounds": 6, "num_leaves": 9, "min_child_samples": 15, "feature_fraction": 1.0, "bagging_fraction": 1.0, "learning_rate": 0.3}


def plain_fit(data, s, zones=True):
    """Rounds in plain Python: exact splits over bins of distinct values."""
    known = [(r[0], r[1], np.nan if r[2] is None else r[2], r[3]) for r in data if r[3] is not None]
    x, y = np.array([r[:3] for r in known]), np.array([r[3] for r in known])
    base = float(np.sort(y)[(len(y) + 1) // 2 - 1])
    scale = max(np.abs(y - base).mean() / 8, 1e-9)
    score, trees = np.full(len(y), base), []

    def t(g, n):
        return max(abs(g) - s.reg_alpha, 0) ** 2 / (n + s.reg_lambda)

    def best(rows_, g):
        top = None
        for f in range(3):
            v = x[rows_, f]
            if f == 0 and zones:
                cats = sorted(set(v), key=lambda c: (g[rows_][v == c].sum() / ((v == c).sum() + s.category_smooth), c))
                cuts = [(set(cats[: k + 1]), np.isin(v, cats[: k + 1])) for k in range(len(cats) - 1)]
            else:
                cuts = [(c, v <= c) for c in sorted(set(v[~np.isnan(v)]))]
            for cut, go in cuts:
                if min(go.sum(), (~go).sum()) < s.min_child_samples:
                    continue
                gl, gr = g[rows_][go].sum(), g[rows_][~go].sum()
                gain = t(gl, go.sum()) + t(gr, (~go).sum()) - t(gl + gr, len(rows_))
                if gain > 1e-9 and (top is None or gain > top[0] + 1e-12):
                    top = gain, f, cut, go
        return top

    for _ in range(s.max_rounds):
        rest = y - score
        g = -np.sign(rest)
        heap, leaves, done, splits = [], [], 0, []
        count = 0

        def add(rows_):
            nonlocal count
            b = best(rows_, g)
            count += 1
            if b:
                heapq.heappush(heap, (-b[0], count, rows_, b))
            else:
                leaves.append(rows_)

        add(np.arange(len(y)))
        done = 1
        while heap and done < s.num_leaves:
            _, _, rows_, (gain, f, cut, go) = heapq.heappop(heap)
            splits.append((f, round(gain, 6), go.sum()))
            done += 1
            add(rows_[go])
            add(rows_[~go])
        leaves += [h[2] for h in heap]
        for rows_ in leaves:
            score[rows_] += s.learning_rate * boosting.median_of_rows(rest[rows_], scale)
        trees.append(splits)
    return score, trees, y, x


@pytest.mark.parametrize("local", [1 << 16, 200, 1])
def test_trees_equal_plain(spark, monkeypatch, local):
    """All three ways to a leaf: in one task, by steps, and steps first."""
    monkeypatch.setattr(boosting, "LOCAL_ROWS", local)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 250)
    data, s = rows(), boosting.Settings(**SETTINGS)
    model, losses = boosting.fit(frame(spark, data), None, FEATURES, "y", ZONES, s)
    want, trees, y, x = plain_fit(data, s)
    assert not losses and model.rounds == s.max_rounds
    assert np.abs(model.predict(x) - want).max() < 1e-9
    for k, splits in enumerate(trees):
        lo, hi = model.root[k], model.root[k + 1] if k + 1 < model.rounds else len(model.feature)
        own = [(int(f), round(float(g), 6)) for f, g in zip(model.feature[lo:hi], model.gain[lo:hi], strict=True) if f >= 0]
        assert sorted(own) == sorted((f, g) for f, g, _ in splits)
    total = np.zeros(3)
    for splits in trees:
        for f, g, _ in splits:
            total[f] += g
    assert np.abs(model.importance() - total / total.sum()).max() < 1e-6


def test_histograms_equal_plain(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    data, s = rows(400), boosting.Settings(**SETTINGS)
    bins = boosting.find_bins(frame(spark, data).where("y IS NOT NULL"), FEATURES, 5)
    state = frame(spark, data).where("y IS NOT NULL").withColumn("valid", F.col("hour") == 3).mapInArrow(boosting.pack(bins, 2.0), boosting._BLOCK)
    trainer = boosting.Trainer(state, 400, bins, 0.5, s)
    tree = boosting.Tree(bins, np.arange(3), s)
    hist, spread, errors = trainer.sums(tree, [0], 0, loss=True)
    known = [r for r in data if r[3] is not None]
    train, valid = [r for r in known if r[1] != 3], [r for r in known if r[1] == 3]
    assert abs(errors[0] - np.mean([abs(r[3] - 2) for r in train])) < 1e-9 and abs(errors[1] - np.mean([abs(r[3] - 2) for r in valid])) < 1e-9
    x = np.array([[np.nan if v is None else v for v in r[:3]] for r in train])
    codes, rest = bins.codes(x), np.array([r[3] - 2 for r in train])
    for f in range(3):
        for b in range(bins.width):
            mine = codes[:, f] == b
            assert hist[0, f, b].tolist() == [-np.sign(rest[mine]).sum(), mine.sum()]
    assert boosting.median_of(spread[0]) == pytest.approx(boosting.median_of_rows(rest, 0.5))
    assert abs(boosting.median_of(spread[0]) - np.median(rest)) < 0.02 * (1 + abs(np.median(rest)))


def test_codes_agree_with_thresholds():
    bins = boosting.Bins([np.zeros(0), np.array([1.0, 2.5]), np.array([0.0])], 3)
    x = np.array([[0, 1, 0], [2, 1.1, -1], [9, np.nan, np.nan], [np.nan, 2.5, 0.1], [1, 99, 5]], dtype=float)
    assert bins.codes(x).tolist() == [[0, 0, 0], [2, 1, 0], [2, 2, 1], [2, 1, 1], [1, 2, 1]]


def test_stops_by_patience_and_is_cut_at_the_best(spark):
    data = rows(1500, seed=9)
    s = boosting.Settings(patience=5, learning_rate=0.5, num_leaves=31)
    model, losses = boosting.fit(frame(spark, data[:1000]), frame(spark, data[1000:]), FEATURES, "y", ZONES, s)
    assert len(losses) == model.rounds + 5 < s.max_rounds
    assert losses[model.rounds - 1] <= min(losses) + s.tolerance * losses[0]
    known = [r for r in data[1000:] if r[3] is not None]
    x = np.array([[np.nan if v is None else v for v in r[:3]] for r in known])
    error = np.abs(model.predict(x) - [r[3] for r in known]).mean()
    assert error == pytest.approx(losses[model.rounds - 1])
    again, same = boosting.fit(frame(spark, data[:1000][::-1]), frame(spark, data[1000:][::-1]), FEATURES, "y", ZONES, s)
    assert same == pytest.approx(losses) and (again.feature == model.feature).all()


def test_nothing_to_learn_from(spark):
    empty, _ = boosting.fit(frame(spark, []), None, FEATURES, "y", ZONES)
    assert empty.predict(np.zeros((3, 3))).tolist() == [0, 0, 0] and empty.importance().tolist() == [0, 0, 0]
    flat, _ = boosting.fit(frame(spark, [(0.0, 1.0, 2.0, 7.0)] * 60), None, FEATURES, "y", ZONES, boosting.Settings(max_rounds=2))
    assert flat.predict(np.zeros((2, 3))).tolist() == [7, 7]


def test_save_and_load(spark):
    data, s = rows(500), boosting.Settings(**SETTINGS)
    model, _ = boosting.fit(frame(spark, data), None, FEATURES, "y", ZONES, s)
    back = boosting.Ensemble.load(spark, model.save(spark, scratch_path(spark, "ensemble")))
    x = np.random.default_rng(1).uniform(-2, 30, (200, 3))
    x[::7] = np.nan
    assert (back.predict(x) == model.predict(x)).all() and back.labels == ZONES and back.features == FEATURES
    short = model.cut(2)
    assert short.rounds == 2 and model.cut(99) is model
    assert np.abs(short.predict(x) - (model.base + model.value[model.leaves(x)[:, :2]].sum(axis=1))).max() < 1e-12
