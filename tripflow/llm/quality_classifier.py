"""Quality classifier: naive-Bayes support vectors.

A document is a set of n-gram indicators: hashed words and word pairs, and
1- to 3-grams of word shapes (capital, upper case, symbol run, repeat of one of
the two words before, ...), a shape n-gram once for each grade of its share of
the text. Indicators are scaled by the log ratio of their smoothed counts in the
two classes, counted over all labelled training documents, and a linear
hinge-loss model is fitted to unit-length rows by dual coordinate descent on a
sample of about ``FIT_ROWS`` labelled documents (all, if there are fewer), drawn
by a hash of the id. A sigmoid fitted to margins of
rows left out of the descent turns the margin into a probability.

Defined results: NULL and empty text have no indicators and get the score of a
zero margin; rows are scored one by one, whatever their ids; NULL or unknown
labels teach nothing, several labels of one document each count; without labels
of both classes every score is the smoothed share of class 1; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import U64, mix, pieces, prefix_sums, range_hash, text_buffer, word_bounds, written
from tripflow.session import ship_package

#: Labelled documents that the descent sees; counts see all of them.
FIT_ROWS = 8000
WORD_BUCKETS = 1 << 17
#: A shape n-gram's indicator for each share of the windows it reaches.
GRADES = (0.0, 1 / 32, 1 / 8, 1 / 2)
#: symbols only, repeat, upper case, mark run, digits, very long, capital, sentence end, other
SHAPES = 9
SHAPE_GRAMS = SHAPES + SHAPES**2 + SHAPES**3
WIDTH = WORD_BUCKETS + SHAPE_GRAMS * len(GRADES)


def _table(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], dtype=np.int64)


_UPPER = _table(lambda b: 65 <= b <= 90)
_DIGIT = _table(lambda b: 48 <= b <= 57)
_LETTER = _table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_MARK = _table(lambda b: b > 32 and not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128))


def shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A shape number for each word."""
    count = lambda table: (c := np.concatenate([[0], np.cumsum(table[data])]))[end] - c[start]
    letters, upper, digits, marks = map(count, (_LETTER, _UPPER, _DIGIT, _MARK))
    last = data[end - 1] if len(end) else data[:0]
    again = np.zeros(len(h), dtype=bool)
    for back in (1, 2):
        again[back:] |= (h[back:] == h[:-back]) & (doc[back:] == doc[:-back])
    first_upper = _UPPER[data[start]] > 0 if len(start) else again
    return np.select(
        [letters + digits == 0, again, (upper == letters) & (letters >= 2), marks >= 2, digits > 0, end - start > 20, first_upper, np.isin(last, [33, 46, 63])],
        list(range(8)), 8,
    )


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted indicator numbers of each text, flat, and each text's offsets."""
    start, end, by_text = word_bounds(data, offsets)
    h = range_hash(prefix_sums(data), start, end)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(by_text))
    pair = mix(h[:-1] * U64(3) + h[1:])[doc[:-1] == doc[1:]] if len(h) else h
    keys = [doc * WIDTH + (h % U64(WORD_BUCKETS)).astype(np.int64), doc[:-1][doc[:-1] == doc[1:]] * WIDTH + (pair % U64(WORD_BUCKETS)).astype(np.int64)]
    code, base = shapes(data, start, end, h, doc), WORD_BUCKETS
    gram = code
    for k in range(3):
        at = doc[: len(doc) - k]
        if k:
            inside = at == doc[k:]
            gram = gram[: len(at)] * SHAPES + code[k:]
        else:
            inside = np.ones(len(at), dtype=bool)
        found, times = np.unique(at[inside] * SHAPES**3 + gram[inside], return_counts=True)
        owner, what = np.divmod(found, SHAPES**3)
        share = times / np.bincount(at[inside], minlength=max(n, 1))[owner]
        for grade, least in enumerate(GRADES):
            reach = share >= least
            keys.append(owner[reach] * WIDTH + base + what[reach] * len(GRADES) + grade)
        base += SHAPES ** (k + 1) * len(GRADES)
    owner, what = np.divmod(np.unique(np.concatenate(keys)), WIDTH)
    return what.astype(np.int32), np.searchsorted(owner, np.arange(n + 1))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, rounds: int = 12, cost: float = 1.0, seed: int = 7) -> np.ndarray:
    """Weights of a linear hinge-loss model by dual coordinate descent. The two
    classes weigh the same."""
    weight = np.zeros(len(ratio))
    values = [unit(ratio[r]) for r in rows]
    share = max(1, int((y > 0).sum())), max(1, int((y < 0).sum()))
    top = np.where(y > 0, cost * len(y) / (2 * share[0]), cost * len(y) / (2 * share[1]))
    dual, rng = np.zeros(len(y)), np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            at, x = rows[i], values[i]
            if not len(at) or not x.any():
                continue
            step = y[i] * (weight[at] @ x) - 1  # rows have unit length
            new = min(max(dual[i] - step, 0.0), top[i])
            if new != dual[i]:
                weight[at] += (new - dual[i]) * y[i] * x
                dual[i] = new
    return weight


def unit(x: np.ndarray) -> np.ndarray:
    n = np.sqrt(x @ x)
    return x / n if n > 0 else x


def sigmoid_fit(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with smoothed targets."""
    pos, neg = int((y > 0).sum()), int((y < 0).sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    x = np.stack([margin, np.ones(len(margin))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(a * margin + b)))
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x * w) @ x.T + 1e-3 * np.eye(2), x @ (p - t))
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass
class Model:
    """Margin: unit-length rows of ``ratio`` times ``weight``."""

    ratio: np.ndarray
    weight: np.ndarray
    slope: float
    offset: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        at, ends = indicators(data, offsets)
        owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        sums = lambda v: np.bincount(owner, weights=v, minlength=len(ends) - 1)
        r = self.ratio[at]
        norm = np.sqrt(sums(r * r))
        margin = np.divide(sums(r * self.weight[at]), norm, out=np.zeros_like(norm), where=norm > 0)
        return 1 / (1 + np.exp(-(self.slope * margin + self.offset)))


def _texts(batch, column: int):
    data, offsets = text_buffer(batch.column(column))
    for lo, hi in pieces(offsets):
        yield lo, hi, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """``labels`` holds ``id_col`` and ``label_col`` (0 or 1) of the documents
    that may teach."""
    ship_package(docs.sparkSession)
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    rows = written(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .join(known.hint("merge"), "_id").select(F.xxhash64("_id").alias("_order"), "_y", "_text"),
        "classifier_rows",
    )

    def count(batches):
        import pyarrow as pa

        total = np.zeros((2, WIDTH), dtype=np.int64)
        seen = np.zeros(2, dtype=np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in _texts(batch, 1):
                at, ends = indicators(data, offsets)
                of = np.repeat(y[lo:hi], np.diff(ends))
                for c in (0, 1):
                    total[c] += np.bincount(at[of == c], minlength=WIDTH)
                    seen[c] += (y[lo:hi] == c).sum()
        at = np.flatnonzero(total.any(axis=0))
        cols = [np.append(at, -1), np.append(total[0, at], seen[0]), np.append(total[1, at], seen[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["f", "n0", "n1"])

    counts = (
        rows.select("_y", "_text").mapInArrow(count, "f long, n0 long, n1 long")
        .groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # at most WIDTH + 1 rows
    )
    table = np.zeros((2, WIDTH))
    at = counts["f"].to_numpy()
    inside = at >= 0
    for c in (0, 1):
        table[c, at[inside]] = counts[f"n{c}"].to_numpy()[inside]
    n0, n1 = (int(counts.loc[~inside, f"n{c}"].sum()) for c in (0, 1))
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    if not n0 or not n1:
        return Model(np.zeros(WIDTH), np.zeros(WIDTH), 0.0, prior)
    p = table + 1
    ratio = np.log(p[1] / p[1].sum()) - np.log(p[0] / p[0].sum())
    ratio[~table.any(axis=0)] = 0.0

    def fit(batches):
        import pyarrow as pa

        sets, ys = [], []
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in _texts(batch, 1):
                at, ends = indicators(data, offsets)
                sets += [at[a:b] for a, b in zip(ends, ends[1:], strict=False)]
                ys.append(y[lo:hi])
        if not sets:
            return
        y = np.where(np.concatenate(ys) > 0, 1.0, -1.0)
        left_out = np.arange(len(y)) % 5 == 4
        use = np.flatnonzero(~left_out)
        weight = descend([sets[i] for i in use], y[use], ratio)
        margin = np.array([unit(ratio[s]) @ weight[s] for s in sets])
        both = left_out if len(set(y[left_out])) == 2 else np.ones(len(y), dtype=bool)
        a, b = sigmoid_fit(margin[both], y[both])
        yield pa.RecordBatch.from_arrays([pa.array([weight.tolist()]), pa.array([a]), pa.array([b])], names=["weight", "slope", "offset"])

    # The same share of the hash's range as of the rows.
    share = min(1.0, fit_rows / (n0 + n1))
    drawn = rows.where(F.col("_order") <= int(-(2**63) + share * (2**64 - 2048)))
    sample = drawn.repartition(1).sortWithinPartitions("_order", "_y", F.xxhash64("_text")).select("_y", "_text")
    model = sample.mapInArrow(fit, "weight array<double>, slope double, offset double").first()
    return Model(ratio, np.array(model["weight"]), model["slope"], model["offset"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of every document."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH numbers

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [shared.value.score(data, offsets) for _, _, data, offsets in _texts(batch, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*found, np.zeros(0)]))], names=["_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return out.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)
