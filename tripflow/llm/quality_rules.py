"""Quality rules as weak supervision.

Every rule votes good (1), bad (-1) or abstains (0). The label of a document is
hidden; expectation-maximisation over the counts of vote patterns estimates how
often each rule votes right on good and on bad documents, and the posterior
probability of "good" decides. No single rule has a veto, except for the base
rules of the caller's choice.

Defined results: NULL or empty text has no words and fails the base rule; rows
are judged one by one, so NULL or repeated ids give one row each; an empty
table gives an empty table; further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import WORD_PATTERN, words_of


@dataclass(frozen=True)
class Band:
    """A rule over one ratio: bad inside ``bad``, good inside ``good``, else
    abstains. Bounds are half-open ``[lo, hi)``."""

    ratio: str
    good: tuple[float, float]
    bad: tuple[tuple[float, float], ...]

    def vote(self) -> Column:
        x = F.col(self.ratio)
        inside = lambda b: (x >= b[0]) & (x < b[1])
        bad = reduce(lambda a, b: a | b, [inside(b) for b in self.bad])
        return F.when(bad, -1).when(inside(self.good), 1).otherwise(0)


INF = float("inf")
RULES = {
    "length": Band("n_words", (80, INF), ((0, 50),)),
    "repetition": Band("repeat_share", (0, 0.2), ((0.4, INF),)),
    "symbols": Band("symbols_per_word", (0, 0.05), ((0.15, INF),)),
    "duplicate_lines": Band("dup_line_share", (0, 0.1), ((0.3, INF),)),
    "word_length": Band("mean_word_length", (3.0, 9.0), ((0, 2.0), (14.0, INF))),
    "upper_case": Band("upper_share", (0, 0.15), ((0.3, INF),)),
    "punctuation": Band("stops_per_word", (0, 0.3), ((0.5, INF),)),
    "vocabulary": Band("distinct_share", (0.2, INF), ((0, 0.1),)),
}
SYMBOLS = "#*$%&|<>"
STOPS = ".!?"


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Counts of every whole text, beside the input's row as struct ``row``.

    ``_pin``: a filter that names it stays above the counts; pushed below, it
    would compute them again for every use.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines`` (lines with a word that equal an earlier line),
    ``n_repeat_words`` (words in a 3-word window that is found twice or more),
    and what the rules' ratios need. One row in, one row out, no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    without = lambda chars: (F.length("_marks") - F.length(F.translate("_marks", chars, ""))).cast("long")
    first = (
        docs.select(F.struct("*").alias("row"), text.alias("_text"))
        .select(
            "row",
            words_of(F.col("_text")).alias("_words"),
            F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD_PATTERN)).alias("_lines"),
            F.regexp_replace("_text", rf"[^{SYMBOLS}{STOPS}\p{{Lu}}]+", "").alias("_marks"),
        )
        .select(
            "row", "_words",
            F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            without(SYMBOLS).alias("n_symbols"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.length(F.translate("_marks", SYMBOLS + STOPS, "")).cast("long").alias("n_upper"),
            without(STOPS).alias("n_stops"),
        )
    )
    # A window is one long: its hash above, its position in the low bits. Equal
    # windows stand side by side once sorted; the words themselves confirm.
    h, w = F.col("_hashes"), F.col("_words")
    bits = F.length(F.bin(F.col("n_words"))).alias("_bits")
    window = F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))),
        lambda x, i: F.call_function("shiftleft", F.xxhash64(x, h[i + 1], h[i + 2]), F.col("_bits")).bitwiseOR(i.cast("long")),
    )
    keys = F.col("_keys")
    top = lambda x: F.call_function("shiftrightunsigned", x, F.col("_bits"))
    at = lambda x: (x - F.call_function("shiftleft", top(x), F.col("_bits"))).cast("int")
    twins = F.filter(F.transform(keys, lambda x, i: F.when((i > 0) & (top(x) == top(keys[F.greatest(i - 1, F.lit(0))])), F.struct(at(keys[i - 1]).alias("a"), at(x).alias("b")))), lambda p: p.isNotNull())
    same = lambda p: reduce(lambda x, y: x & y, [w[p["a"] + k] == w[p["b"] + k] for k in (0, 1, 2)])
    covered = F.transform(F.filter("_twins", same), lambda p: F.array(*(p[e] + k for e in "ab" for k in (0, 1, 2))))
    return (
        first.withColumn("_bits", bits)
        .withColumn("_keys", F.sort_array(window))
        .withColumn("_twins", twins)
        .withColumn("n_distinct", F.size(F.array_distinct(h)).cast("long"))
        .withColumn("n_repeat_words", F.size(F.array_distinct(F.flatten(covered))).cast("long"))
        .drop("_words", "_hashes", "_bits", "_keys", "_twins")
        .withColumn("_pin", F.monotonically_increasing_id())
    )


def with_ratios(m: DataFrame) -> DataFrame:
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return m.withColumns({
        "repeat_share": per("n_repeat_words", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "mean_word_length": per("word_chars", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
        "stops_per_word": per("n_stops", "n_words"),
        # A long text repeats its vocabulary, so the share is of the root.
        "distinct_share": F.coalesce(F.try_divide(F.col("n_distinct"), F.sqrt("n_words") * 10), F.lit(0.0)),
    })


@dataclass(frozen=True)
class Accuracies:
    """Prior of "good", and each rule's chance to vote good, given that it
    votes, on good and on bad documents."""

    prior: float
    good_if_good: dict[str, float]
    good_if_bad: dict[str, float]

    def weight(self, rule: str, vote: int) -> float:
        """Log odds that a vote adds to "good"."""
        g, b = self.good_if_good[rule], self.good_if_bad[rule]
        return {1: log(g / b), -1: log((1 - g) / (1 - b)), 0: 0.0}[vote]

    def start(self) -> float:
        return log(self.prior / (1 - self.prior))

    def quality(self, votes: dict[str, int]) -> float:
        return 1 / (1 + exp(-self.start() - sum(self.weight(r, votes[f"v_{r}"]) for r in RULES)))

    def posterior(self) -> Column:
        odds = F.lit(self.start())
        for r in RULES:
            v = F.col(f"v_{r}")
            odds += F.when(v == 1, self.weight(r, 1)).when(v == -1, self.weight(r, -1)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def learn(votes: DataFrame, max_rounds: int = 40, tolerance: float = 1e-4, strength: float = 20.0, false_alarms: float = 0.01) -> Accuracies:
    """Expectation-maximisation over vote patterns of what the base lets pass:
    the rest needs no verdict and would fill the bad class.

    Documents with equal votes are one row with a count: at most 2 * 3 ** 8
    rows whatever the corpus holds, which the driver works through. ``strength`` documents'
    worth of prior belief keep every probability inside (0, 1), also on an
    empty table, and a rule is trusted to fail at most ``false_alarms`` of the
    good documents, which keeps the two classes from changing places.
    """
    names = [f"v_{r}" for r in RULES]
    counts = votes.groupBy(*names, "base_failed").agg(F.count("*").alias("n")).collect()
    patterns = [r.asDict() for r in counts if not r["base_failed"]]
    start_good, start_bad = 1 - false_alarms, 0.8
    now = Accuracies(start_bad, dict.fromkeys(RULES, start_good), dict.fromkeys(RULES, start_bad))
    for _ in range(max_rounds):
        # Expected number of good and of bad documents behind each pattern.
        split = [(p, p["n"] * (q := now.quality(p)), p["n"] * (1 - q)) for p in patterns]

        def rate(r: str, side: int, belief: float, split=split) -> float:
            voting = sum(x[side] for x in split if x[0][f"v_{r}"])
            good = sum(x[side] for x in split if x[0][f"v_{r}"] == 1)
            return (good + strength * belief) / (voting + strength)

        good = {r: max(rate(r, 1, start_good), start_good) for r in RULES}
        new = Accuracies(
            (sum(x[1] for x in split) + strength * start_bad) / (sum(p["n"] for p in patterns) + strength),
            good,
            # A vote for good never speaks against a document.
            {r: min(rate(r, 2, start_bad), good[r]) for r in RULES},
        )
        moved = max(abs(new.good_if_good[r] - now.good_if_good[r]) + abs(new.good_if_bad[r] - now.good_if_bad[r]) for r in RULES)
        now = new
        if moved < tolerance:
            break
    return now


def votes(docs: DataFrame, text_col: str = "text", min_words: int = 50) -> DataFrame:
    """Measures, every rule's vote, and ``base_failed``: fewer than
    ``min_words`` words, or more than half of them in repeated windows."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = with_ratios(measures(docs, text_col))
    return measured.withColumns({f"v_{r}": b.vote() for r, b in RULES.items()} | {"base_failed": failed})


def judge(voted: DataFrame, accuracies: Accuracies, least: float = 0.5) -> DataFrame:
    """``voted`` with ``quality``, the posterior probability of "good", and
    ``kept``: base passed and ``quality`` >= ``least``."""
    judged = voted.withColumn("quality", accuracies.posterior())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep. The texts are measured twice,
    to learn and to judge, and never shuffled."""
    voted = votes(docs, text_col)
    return judge(voted, learn(voted)).where("kept AND _pin >= 0").select("row.*")
