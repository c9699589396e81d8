"""The registered queries against SQL and their contracts, and the pipeline."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.data import frame, odd_rows, words
from tests.llm.test_corpus_operators import plain_groups
from tests.llm.test_text_operators import plain_line_dedup
from tests.oracle_check import duck, fingerprint
from tripflow.llm import bpe, mixing
from tripflow.llm.queries import ORACLE_SQL, QUERIES, vocabulary

COLUMNS = {
    "op1": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5": "doc_id n_shingles component_id",
    "op6": "doc_id size source_size target taken",
    "op7": "query_id rank vec_id score",
    "op8": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10": "doc_id held_out score predicted",
    "op11": "vec_id code error label_error codebooks_sha256",
    "op12": "doc_id start n_tokens ids_crc32",
    "op13": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def test_all_operators_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_its_columns(spark, name):
    out = QUERIES[name](spark, SMALL)
    assert set(COLUMNS.get(name.split("_")[0], "").split()) <= set(out.columns)
    rows = out.count()
    if "doc_id" in out.columns:
        assert rows == spark.read.parquet(f"{SMALL}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got = fingerprint(QUERIES[name](spark, SMALL).toPandas())
    want = fingerprint(duck(SMALL).execute(ORACLE_SQL[name]).df())
    assert got[:3] == want[:3]


def test_pipeline_stages_take_anything_and_keep_columns(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "jaccard_join", "mix_sources", "bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, frame(spark, []), "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(rows)


def test_pipeline_stages_equal_plain(spark):
    rows = [r for r in odd_rows() if r != (15, odd_rows()[15][1])]
    docs = frame(spark, rows)
    stage = dict(corpus_pipeline.STAGES)
    want = plain_line_dedup(rows)
    got = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in stage["line_dedup"](spark, docs, "").collect())
    assert got == Counter((i, want[i, t][0], len(want[i, t][0]) if t is not None else None) for i, t in rows)

    kept = Counter(r["doc_id"] for r in stage["jaccard_join"](spark, docs, "").collect())
    groups = plain_groups(rows, 5, 80)
    assert kept == Counter({i: 1 for i, _, c in groups if i is not None and i == c} | {None: sum(r[0] is None for r in rows)})

    taken = Counter()
    for r in mixing.taken(mixing.mix(docs)).collect():
        taken[r["_id"]] += r["taken"]
    mixed = Counter()
    for r in stage["mix_sources"](spark, docs, "").collect():
        mixed[r["doc_id"]] += len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert +mixed == +taken

    coded = Counter((r["doc_id"], tuple(r["ids"])) for r in stage["bpe"](spark, docs, "").collect())
    memory = bpe.Memory(bpe.Encoder(open(vocabulary(), encoding="utf-8").read()))
    ids, offsets, _ = bpe.encode_batch(memory, [t for _, t in rows])
    assert coded == Counter((i, tuple(ids[offsets[k]: offsets[k + 1]].tolist())) for k, (i, _) in enumerate(rows))


def test_pipeline_keeps_unlike_texts_of_one_id(spark):
    rows = odd_rows()
    unlike = [t for i, t in rows if i == 15]
    rows += [(15, unlike[1] + " end"), (16, unlike[0] + " end"), (1, unlike[1] + " end")]
    out = corpus_pipeline.drop_near_copies(spark, frame(spark, rows), "").collect()
    number = list(dict.fromkeys((i, t or "") for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or ""))))
    # Each text under a number of its own, in the order of ids; its group's first stays.
    groups = plain_groups([(k, t) for k, (_, t) in enumerate(number)], 5, 80)
    assert Counter(r["doc_id"] for r in out) == Counter([number[k][0] for k, _, c in groups if k == c] + [None] * 2)
    kept = Counter(r["text"] for r in out)
    assert kept[unlike[0]] == 1 and kept[unlike[1]] + kept[unlike[1] + " end"] == 1


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0 and "doc_id" in out.columns
