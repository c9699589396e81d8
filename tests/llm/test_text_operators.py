"""Quality rules, line dedup, classifier, HTML and the encoder."""

import random
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest

from tests.llm.data import frame, odd_rows, prose, words
from tripflow.llm import bpe, html_text, line_dedup, quality_classifier, quality_rules
from tripflow.llm.queries import vocabulary


def repeat_words(ws):
    at = Counter(tuple(ws[k: k + 3]) for k in range(len(ws) - 2))
    hit = {k + j for k in range(len(ws) - 2) if at[tuple(ws[k: k + 3])] > 1 for j in range(3)}
    return len(hit)


def dup_lines(t):
    seen, n = set(), 0
    for line in (t or "").split("\n"):
        if words(line):
            n += line in seen
            seen.add(line)
    return n


def test_measures_equal_plain_counts(spark):
    rows = odd_rows()
    voted = quality_rules.votes(frame(spark, rows))
    got = Counter(
        (r["row"]["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in voted.collect()
    )
    want = Counter()
    for i, t in rows:
        ws = words(t)
        rep = repeat_words(ws)
        want[(i, len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t or ""), dup_lines(t), rep, len(ws) < 50 or 100 * rep > 50 * len(ws))] += 1
    assert got == want


def test_rules_keep_prose_and_drop_junk(spark):
    rng = random.Random(5)
    good = [(k, prose(rng, rng.randrange(80, 400), 3000)) for k in range(300)]
    table = [(1000 + k, " | ".join("w%d" % rng.randrange(3000) for _ in range(150))) for k in range(30)]
    shout = [(2000 + k, " ".join("W%d!!" % rng.randrange(3000) for _ in range(150)).upper()) for k in range(30)]
    left = {r["doc_id"] for r in quality_rules.keep_good(frame(spark, good + table + shout)).collect()}
    assert left == {k for k, _ in good}


def test_rules_weights_come_from_votes():
    a = quality_rules.Accuracies(0.8, dict.fromkeys(quality_rules.RULES, 0.99), dict.fromkeys(quality_rules.RULES, 0.6))
    votes = {f"v_{r}": 1 for r in quality_rules.RULES}
    best = a.quality(votes)
    assert a.quality(dict.fromkeys(votes, 0)) == pytest.approx(0.8)
    assert a.quality(votes | {"v_symbols": -1}) < a.quality(votes | {"v_symbols": 0}) < best


def test_rules_keep_columns_and_take_empty_tables(spark):
    df = frame(spark, odd_rows())
    assert quality_rules.keep_good(df).columns == df.columns
    assert quality_rules.keep_good(frame(spark, [])).count() == 0


def plain_line_dedup(rows):
    """Documents in order of id (NULL first); equal rows are one document."""
    out, seen = {}, set()
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        if t is None:
            out[i, t] = (None, 0, 0)
            continue
        lines = t.split("\n")
        full = [k for k, x in enumerate(lines) if words(x)]
        gone = set()
        for a in range(len(full) - 2):
            key = tuple(lines[full[a + j]] for j in range(3))
            if key in seen:
                gone |= set(full[a: a + 3])
            seen.add(key)
        out[i, t] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out


def test_line_dedup_equals_plain(spark):
    rows = [r for r in odd_rows() if r != (15, odd_rows()[15][1])]  # one text an id
    df = frame(spark, rows)
    out = line_dedup.dedup_lines(df)
    assert set(df.columns) <= set(out.columns)
    want = plain_line_dedup(rows)
    got = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect())
    assert got == Counter((i, *want[i, t]) for i, t in rows)
    assert sum(v[2] for v in want.values()) > 20


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_encoder_equals_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    t.no_padding()
    t.no_truncation()
    rng = random.Random(2)
    letters = "aàbÉçDêfΣσİßﬁ 0١Ⅷ'sst\x00\x1c\x1f\x85\xa0 \t\n中文字😀한국어"
    rows = odd_rows() + [(100 + k, "".join(rng.choice(letters) for _ in range(rng.randrange(80)))) for k in range(300)]
    rows += [(900, "<|endoftext|>hello <|startoftext|><|endoftext|> x"), (901, "a" * 3000), (902, "ha" * 64), (903, "x" * 129), (904, "'S 'RE I'LL don't")]
    out = bpe.encode_documents(frame(spark, rows), vocabulary())
    got = Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in out.collect())
    want = Counter()
    for (i, x) in rows:
        e = t.encode(x or "", add_special_tokens=False)
        want[i, tuple(e.ids), t.decode(e.ids, skip_special_tokens=False)] += 1
    assert got == want


def test_encoder_forgets_and_goes_on():
    memory = bpe.Memory(bpe.Encoder(open(vocabulary(), encoding="utf-8").read()))
    texts = ["the cat sat on the mat", "unheard ofwords here", "the cat"]
    first = bpe.encode_batch(memory, texts)
    memory.forget()
    again = bpe.encode_batch(memory, texts)
    assert [x.tolist() for x in first[:2]] == [x.tolist() for x in again[:2]] and first[2] == again[2]


def test_encoder_of_nothing(spark):
    assert bpe.encode_documents(frame(spark, []), vocabulary()).count() == 0


class Visible(HTMLParser):
    def __init__(self):
        super().__init__()
        self.off, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        if self.off or tag in ("script", "style", "title", "head"):
            self.off += tag not in html_text.VOID

    def handle_endtag(self, tag):
        self.off -= bool(self.off)

    def handle_data(self, data):
        if not self.off:
            self.out += data.split()


def test_html_words_equal_a_plain_parser(spark):
    from tests.conftest import MEDIUM

    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        p = Visible()
        p.feed(r["html"])
        p.close()
        text = got[r["page_id"]]
        assert "".join(w for w in text.split() if w != "-") == "".join(p.out)


@pytest.mark.parametrize(("source", "text"), [
    (None, ""), ("", ""), ("a<b", "a"), ("<p>one<p>two", "one\n\ntwo"), ("a<br>b", "a\nb"), ("x <b> y</b>z", "x yz"),
    ("<ul><li>a<li>b<ol start=3><li>c</ol></ul>", "- a\n- b\n  3. c"),
    ("<table><tr><th>n<th>name<tr><td>12345<td>x</table>", "n      name\n12345  x"),
    ("<p hidden>a</p>b<div style='display: none'>c<p>d</div>", "b"),
    ("<div style='visibility:hidden'>a<i style='visibility:visible'>b</i></div>", "b"),
    ("<pre> a\n  b</pre>", " a\n  b"), ("&amp;&lt;&eacute;", "&<é"), ("<script>if (a<b) x('</p>')</script>y", "y"),
    ("<!-- a --> b <!-- c", "b"), ("</p></div>x", "x"), ("<td>a<td>b", "a\nb"), ("<h1>t</h1><div>x<div>y</div></div>", "t\n\nx\ny"),
    ("<a title='>'>x</a>", "x"), ("<dl><dt>t<dd>d</dl>", "t\n    d"),
])
def test_html_layout(source, text):
    assert (html_text.render(source) if source else "") == text


@pytest.mark.parametrize(("source", "text"), [
    ("<html><head><title>t</title><body><p>text</p>", "text"), ("<head><title>t</title><p>text</p>", "text"),
    ("<head><title>t</title>\n text <b>x</b>", "text x"), ("<head><meta charset=a><style>p{}</style><script>1</script>\n<h1>x</h1>", "x"),
    ("<head><noscript><img></noscript><template><p>no</p></template><body>x", "x"), ("<head><html><head><div>x</div>", "x"),
    ("<head>\n<link rel=a>&nbsp;</head>x", "\xa0x"), ("<body>a<head>b</head>c", "abc"),
])
def test_html_head_ends_by_itself(source, text):
    assert html_text.render(source) == text


@pytest.mark.parametrize(("source", "text"), [
    ("a <math><mfrac><mn>1</mn><mn>2</mn></mfrac><mo>=</mo><mi>x</mi></math> b", "a 1 2 =x b"),
    ("<math><semantics><mi>x</mi><annotation encoding=t>tex</annotation></semantics><mphantom><mi>p</mi></mphantom></math>y", "xy"),
    ("<svg><title>t</title><desc>d</desc><defs><text>no</text></defs>stray<text>one</text><text>two</text></svg> z", "one two z"),
    ("<svg><title/><defs/><style/><g><text>a<tspan>b</tspan></text></g><path d='m'/></svg>c", "ab c"),
    ("<svg><text><![CDATA[a<b]]></text><foreignObject><p>x<p>y</foreignObject></svg>", "a<b\n\nx\n\ny"),
    ("<p>q<svg><defs><p>out</p>", "q\n\nout"), ("<svg style='display:none'><text>a</text></svg>b", "b"), ("<desc>d</desc>", "d"),
    ("x<textarea>\n a\n  b &amp;</textarea>y", "x\n a\n  b &\ny"), ("<textarea hidden>a</textarea>b", "b"),
    ("x <select><option>a<option selected>b<option>c</select>y", "x b y"), ("<select><option disabled>a<optgroup label=g><option>b</select>", "b"),
    ("<select><option selected hidden>pick</option><option>b</option></select>", "pick"), ("<select><option label=l>a</select>", "l"),
    ("x<select multiple><option>a<option hidden>no<option>b</select>y", "x\na\nb\ny"), ("<select hidden><option>a</select>b", "b"),
])
def test_html_shows_formulas_labels_and_forms(source, text):
    assert html_text.render(source) == text


def test_html_survives_depth_and_cut_markup(spark):
    assert html_text.render("<div>" * 50000 + "x") == "x"
    assert html_text.render("<a " * 100000) == ""
    rows = spark.createDataFrame([(1, None, "q"), (1, "<p>x", "q"), (None, "<b>y", "q")], "page_id long, html string, text string")
    assert Counter(map(tuple, html_text.extract(rows).collect())) == Counter([(1, ""), (1, "x"), (None, "y")])
    assert html_text.extract(rows.limit(0)).count() == 0


def test_classifier_on_held_out_rows(spark):
    from tests.conftest import MEDIUM

    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    model = quality_classifier.train(docs, labels.where("doc_id % 3 > 0"))
    r = quality_classifier.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert ((r["score"] >= 0.7) == (r["quality"] == 1)).mean() > 0.97
    assert r["score"].between(0, 1).all()


def test_classifier_takes_anything(spark):
    df = frame(spark, odd_rows())
    labels = spark.createDataFrame([(2, 1), (2, 0), (4, None), (5, 7), (None, 1), (19, 0), (3, 1)], "doc_id long, quality int")
    model = quality_classifier.train(df, labels)
    got = quality_classifier.score(df, model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    none = quality_classifier.train(df, labels.limit(0))
    assert {r["score"] for r in quality_classifier.score(df, none).collect()} == {0.5}
    assert quality_classifier.score(frame(spark, []), model).count() == 0


def test_descent_separates():
    rng = np.random.default_rng(0)
    y = np.where(rng.random(200) < 0.5, 1.0, -1.0)
    rows = [np.sort(rng.choice(40, 5, replace=False)) + (0 if v > 0 else 40) for v in y]
    w = quality_classifier.descend(rows, y, np.ones(80))
    assert all(np.sign(w[r].sum()) == v for r, v in zip(rows, y, strict=True))




@pytest.mark.parametrize(("source", "text"), [
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    ("<table><tr><td>a<td rowspan=0>long<td>c<tr><td>d<td>e<tr><td>f</table>", "a  long  c\nd        e\nf"),
    ("<table><tr><td rowspan=2 colspan=2>A<td>B<tr><td>C<tr><td>xx<td>yy<td>D</table>", "A       B\n        C\nxx  yy  D"),
    ("<table><tr><td>" + "x" * 59 + "<td>B<tr><td>s<td>C</table>", "x" * 59 + "  B\ns" + " " * 60 + "C"),
    ("<table><tr><td>" + "word " * 20 + "<td>B<tr><td>s<td>C</table>", "word " * 14 + " B\n" + ("word " * 6).strip() + "\ns" + " " * 70 + "C"),
    ("<table><tr><td>" + "y" * 100 + "<td>B<tr><td>s<td>C</table>", "y" * 100 + "  B\ns  C"),
    ("<details><summary>S</summary>body<p>more<details open>in</details></details>after", "S\nafter"),
    ("<details open><summary>S</summary>body</details>", "S\nbody"),
    ("<details>text<summary>S<b>s</b></summary><summary>T</summary></details>", "Ss"),
])
def test_spans_wide_cells_and_details(source, text):
    assert html_text.render(source) == text


@pytest.mark.parametrize("unit", [("<b>", "</tr>"), ("<b>", "<td>"), ("<table>", "</td>"), ("<p>", "<li>"), ("<td>", "</table>")])
def test_time_of_a_page_grows_with_its_length(unit):
    import time

    start = time.process_time()
    html_text.render(unit[0] * 32000 + unit[1] * 32000)
    assert time.process_time() - start < 10


def test_wrapping_loses_no_word():
    rng = random.Random(3)
    cells = [" ".join("w" * rng.randrange(1, 90) for _ in range(rng.randrange(0, 60))) for _ in range(40)]
    page = "<table>" + "".join(("<tr>" if k % 4 == 0 else "") + f"<td>{c}" for k, c in enumerate(cells)) + "</table>"
    assert sorted(html_text.render(page).split()) == sorted(" ".join(cells).split())
