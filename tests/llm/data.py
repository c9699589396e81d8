"""Small inputs with every awkward row, and plain helpers."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that the operators use inside, as columns of the input.
CLASH = ["_id", "_text", "row", "id", "n_words", "n_lines", "size", "block", "kept", "score", "s", "node", "sig", "_row", "start", "_y"]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return WORD.findall(t or "")


def schema(clash=True):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in CLASH if clash])


def frame(spark, rows, clash=True):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "a", len(r[1] or "")) + ("x",) * (len(CLASH) if clash else 0) for r in rows]
    return spark.createDataFrame(full, schema(clash))


def prose(rng, n, vocabulary=400):
    out = []
    for k in range(n):
        w = "w" + str(rng.randrange(vocabulary))
        out.append(w + rng.choice(["", "", "", ",", "."]))
        if k % 12 == 11:
            out.append("\n")
    return " ".join(out)


def odd_rows(seed=3):
    """NULLs, empties, white space, repeated rows and ids, ties, copies, near
    copies, one long text, letters outside ASCII."""
    rng = random.Random(seed)
    base = [prose(rng, n) for n in (5, 60, 120, 200, 300)]
    near = base[3].replace("w1 ", "w399 ", 1)
    shared = prose(rng, 70)
    return [
        (1, base[0]), (2, base[1]), (3, base[2]), (4, base[3]), (5, base[4]),
        (6, base[3]), (7, near), (8, None), (9, ""), (10, " \t\n\x0b\x0c\r "), (11, "one"), (12, "One"), (13, "two words"),
        (14, shared + "\n" + base[1]), (15, prose(rng, 90) + "\n" + shared), (15, prose(rng, 50)), (2, base[1]),
        (None, base[2]), (None, None), (16, "Ünïcode ß Σ 中文 " * 30), (17, "a" * 250), (18, "a" * 300 + "b" + "a" * 120),
        (19, "x y z " * 60), (20, "the | cat | sat | " * 40), (-5, base[4] + " end"), (21, prose(rng, 20000)),
        (22, "same line here\nsame line here\nother\n" * 4),
    ]
