"""Digest columns of the registered queries against plain values, and the fitted
parts of the rules and of the classifier against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.data import frame, odd_rows, prose
from tests.llm.test_corpus_operators import plain_groups, plain_spans
from tripflow.llm import quality_classifier, quality_rules
from tripflow.llm.queries import QUERIES, vocabulary
from tripflow.llm.words import text_buffer


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    frame(spark, odd_rows()).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, k % 2, 0) for k, (i, _) in enumerate(odd_rows())] + [(None, 1, 0), (3, None, 0), (999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def got(spark, name, folder, *columns):
    return Counter(map(tuple, QUERIES[name](spark, folder).select(*columns).collect()))


def test_op1_digests(spark, odd_dir):
    want = Counter()
    for (i, n, spans, kept), times in plain_spans(odd_rows()).items():
        want[i, n, sum(b - a for a, b in spans), len(spans), sha(kept)] += times
    assert got(spark, "op1_suffix_dedup", odd_dir, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_op5_columns(spark, odd_dir):
    assert got(spark, "op5_jaccard_join", odd_dir, "doc_id", "n_shingles", "component_id") == plain_groups(odd_rows(), 3, 90)


def test_op9_digests(spark, odd_dir):
    library = Tokenizer.from_file(vocabulary())
    want = Counter()
    for i, t in odd_rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert got(spark, "op9_bpe", odd_dir, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


@pytest.mark.parametrize(("name", "m", "r"), [("op2_lm_score", 10, 0), ("op10_quality_classifier", 4, 2)])
def test_folds(spark, odd_dir, name, m, r):
    held = {(i, zlib.crc32(str(i).encode()) % m == r) for i, _ in odd_rows() if i is not None}
    rows = QUERIES[name](spark, odd_dir).collect()
    assert {(x["doc_id"], x["held_out"]) for x in rows if x["doc_id"] is not None} == held and len(rows) == len(odd_rows())
    if name.startswith("op10"):
        assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.7) for x in rows)


# ------------------------------------------------------------ weak supervision


def plain_em(documents, rounds=40, tolerance=1e-4, strength=20.0, false_alarms=0.01):
    """Document by document: responsibilities, then rates of good votes."""
    rules = list(quality_rules.RULES)
    prior, good, bad = 0.8, dict.fromkeys(rules, 1 - false_alarms), dict.fromkeys(rules, 0.8)

    def quality(d):
        p, q = prior, 1 - prior
        for r in rules:
            if d[r]:
                p *= good[r] if d[r] > 0 else 1 - good[r]
                q *= bad[r] if d[r] > 0 else 1 - bad[r]
        return p / (p + q)

    for _ in range(rounds):
        share = [quality(d) for d in documents]
        new_good, new_bad = {}, {}
        for r in rules:
            voting = [(d[r], s) for d, s in zip(documents, share, strict=True) if d[r]]
            g = (sum(s for v, s in voting if v > 0) + strength * (1 - false_alarms)) / (sum(s for _, s in voting) + strength)
            b = (sum(1 - s for v, s in voting if v > 0) + strength * 0.8) / (sum(1 - s for _, s in voting) + strength)
            new_good[r] = max(g, 1 - false_alarms)
            new_bad[r] = min(b, new_good[r])
        moved = max(abs(new_good[r] - good[r]) + abs(new_bad[r] - bad[r]) for r in rules)
        prior = (sum(share) + strength * 0.8) / (len(documents) + strength)
        good, bad = new_good, new_bad
        if moved < tolerance:
            break
    return prior, good, bad, quality


def test_rules_learn_and_judge_as_plain(spark):
    rng = random.Random(17)
    rules = list(quality_rules.RULES)
    documents = []
    for k in range(500):
        fine = k % 5 > 0
        documents.append({r: rng.choices([1, -1, 0], [8, 0.1, 2] if fine else [2, 5, 3])[0] for r in rules})
    failed = [k % 11 == 0 for k in range(500)]
    rows = [(k, *(d[r] for r in rules), f) for k, (d, f) in enumerate(zip(documents, failed, strict=True))]
    voted = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"v_{r} int" for r in rules) + ", base_failed boolean")
    learned = quality_rules.learn(voted)
    prior, good, bad, quality = plain_em([d for d, f in zip(documents, failed, strict=True) if not f])
    assert learned.prior == pytest.approx(prior) and learned.good_if_good == pytest.approx(good) and learned.good_if_bad == pytest.approx(bad)
    judged = {r["doc_id"]: r for r in quality_rules.judge(voted, learned).collect()}
    for k, d in enumerate(documents):
        assert judged[k]["quality"] == pytest.approx(quality(d))
        assert judged[k]["kept"] == (not failed[k] and judged[k]["quality"] >= 0.5)
    assert 300 < sum(r["kept"] for r in judged.values()) < 450


# ------------------------------------------------------------ quality classifier


def labelled(n=240, seed=21):
    rng = random.Random(seed)
    return [(k, prose(rng, rng.randrange(20, 120), 60 if k % 3 else 400) + (" !!! ### $$$" * (k % 3 == 0)), int(k % 3 > 0)) for k in range(n)]


def test_classifier_learns_as_plain(spark):
    rows = labelled()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality_classifier.train(docs, labels)
    at, ends = quality_classifier.indicators(*text_buffer(pa.array([t for _, t, _ in rows])))
    sets = [set(at[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)]
    # Log-count ratios: documents of a class that show an indicator, plus one, as
    # shares of all such counts of the class.
    count = [Counter(), Counter()]
    for s, (_, _, y) in zip(sets, rows, strict=True):
        count[y].update(s)
    total = [sum(c.values()) + quality_classifier.WIDTH for c in count]
    seen = set(count[0]) | set(count[1])
    for f in random.Random(1).sample(sorted(seen), 300):
        assert model.ratio[f] == pytest.approx(math.log((count[1][f] + 1) / total[1]) - math.log((count[0][f] + 1) / total[0]))
    assert set(np.flatnonzero(model.ratio)) <= seen
    # Scores: unit rows of ratios times the weights, through the logistic curve.
    scores = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, model).collect()}
    for s, (i, _, y) in zip(sets, rows, strict=True):
        norm = math.sqrt(sum(model.ratio[f] ** 2 for f in s))
        margin = sum(model.ratio[f] * model.weight[f] for f in s) / norm
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.offset))))
        assert (scores[i] > 0.5) == (y == 1)


def test_descent_reaches_the_optimum():
    """Weak duality: at the optimum the primal and dual objectives meet."""
    rng = np.random.default_rng(3)
    width, n = 40, 120
    rows = [np.sort(rng.choice(width, rng.integers(1, 9), replace=False)) for _ in range(n)]
    truth = rng.normal(size=width)
    y = np.where([truth[r].sum() + rng.normal() > 0.4 for r in rows], 1.0, -1.0)
    ratio = rng.normal(size=width)
    weight = quality_classifier.descend(rows, y, ratio, rounds=3000)
    x = np.zeros((n, width))
    for k, r in enumerate(rows):
        x[k, r] = ratio[r] / np.linalg.norm(ratio[r])
    cost = np.where(y > 0, n / (2 * (y > 0).sum()), n / (2 * (y < 0).sum()))
    primal = weight @ weight / 2 + (cost * np.maximum(0, 1 - y * (x @ weight))).sum()

    # The dual by plain projected gradient on the whole matrix.
    q = (y[:, None] * x) @ (y[:, None] * x).T
    dual, step = np.zeros(n), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(60000):
        dual = np.clip(dual + step * (1 - q @ dual), 0, cost)
    assert primal == pytest.approx(dual.sum() - dual @ q @ dual / 2, rel=2e-3)
    assert np.abs(x.T @ (dual * y) - weight).max() < 0.02 * np.abs(weight).max()
