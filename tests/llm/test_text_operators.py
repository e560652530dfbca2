import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cases import PROSE, documents, empty, items, labels
from conftest import plan_of
from veleta.llm import decontaminate as dc
from veleta.llm import quality, span_dedup, toxicity
from veleta.llm.html_text import render, visible_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_spans_leave_the_first_occurrence_and_what_is_unique(spark):
    passage = "Every word of this passage comes again elsewhere in full. So does all of this second sentence of it. And a third one closes the passage."
    rows = [(1, f"My own start here. {passage} And my own end of it."), (2, f"Another start there.\n{passage}\nAnother end there."), (3, "Nothing shared here. At all. Yes. No."), (4, "Yes. No.")]
    got = {r.doc_id: r for r in span_dedup.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "Another start there.\nAnother end there."
    assert got[3].text == rows[2][1] and got[4].n_removed == 0 and got[2].n_removed == 3


def brute_runs(sizes, least, words):
    n, out = len(sizes), set()
    ok = lambda a, b: b - a + 1 >= least and sum(sizes[a : b + 1]) >= words
    for a in range(n):
        out |= set([(a, b) for b in range(a, n) if ok(a, b)][:1])
    for b in range(n):
        out |= set([(a, b) for a in range(b, -1, -1) if ok(a, b)][:1])
    return sorted(out)


@pytest.mark.parametrize("sizes", [[], [3], [9, 1], [1] * 30, [12, 0, 3, 4, 5, 1, 1, 20], [5, 6, 5, 6]])
def test_runs(sizes):
    assert span_dedup.runs(sizes, 2, 10) == brute_runs(sizes, 2, 10)


def test_span_edges(spark):
    got = span_dedup.dedup_spans(documents(spark))
    rows = got.collect()
    assert len(rows) == 14 and {r.row for r in rows} == {"clash"} and got.columns.count("n_removed") == 1
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[3] == [None] and texts[4] == [""] and texts[2][0] == texts[2][1]
    assert span_dedup.dedup_spans(empty(spark)).count() == 0
    assert all("".join(t[a:b] for a, b in span_dedup.sentences(t)) == t for ts in texts.values() for t in ts if t)


def measures(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_brute_force_and_stay_native(spark):
    docs = documents(spark)
    out = quality.measure(docs, quality.fit_ratio(docs, quality.trusted_texts(docs, labels(spark))))
    rows = out.select("row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score").collect()
    assert len(rows) == 14
    for r in rows:
        want = measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
        assert (r.score is None) == (want[0] == 0)
    assert not re.search("Python|Pandas|Arrow", plan_of(out))
    kept = out.filter("kept").select("row.*")
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    none = quality.measure(empty(spark), quality.fit_ratio(empty(spark), empty(spark).select("text")))
    assert none.count() == 0


def test_ratio_prefers_the_target(spark):
    good = [(i, " ".join(f"g{(i * 7 + k) % 40}" for k in range(80))) for i in range(30)]
    bad = [(100 + i, " ".join(f"b{(i * 5 + k) % 40}!!" for k in range(80))) for i in range(10)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    marks = labels(spark, [(i, 1, 0) for i, _ in good[:20]])
    scored = quality.measure(docs, quality.fit_ratio(docs, quality.trusted_texts(docs, marks))).select("row.doc_id", "score").collect()
    assert min(r.score for r in scored if r.doc_id < 100) > quality.THRESHOLD > max(r.score for r in scored if r.doc_id >= 100)


def test_contained_items(spark):
    found = dc.contained_items(documents(spark), items(spark))
    got = sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (None, 1), (6, 2), (9, None)], key=str)
    assert not re.search("Python|Pandas|Arrow", plan_of(found))
    left = dc.clean_documents(documents(spark), items(spark))
    assert left.columns == documents(spark).columns
    assert sorted(((r.doc_id, r.text is None) for r in left.collect()), key=str) == sorted(
        [(3, True), (4, False), (None, True), (5, False), (7, False), (8, False), (10, False), (11, False)], key=str
    )
    assert dc.contained_items(empty(spark), items(spark)).count() == 0
    assert dc.contained_items(documents(spark), items(spark).limit(0)).count() == 0


def test_containment_threshold(spark):
    words = [f"q{i}" for i in range(44)]  # 40 runs of five
    cut = lambda n: " ".join(f"x{i}" for i in range(3000)) + " " + " ".join(words[: n + 4]) + " " + " ".join(f"y{i}" for i in range(3000))
    docs = spark.createDataFrame([(n, cut(n)) for n in range(26, 41)], "doc_id long, text string")
    item = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: r.n_shared for r in dc.contained_items(docs, item).collect()}
    assert got == {n: n for n in range(32, 41)}


def test_exact_containment_finds_the_same(spark):
    search = lambda exact: sorted(map(str, dc.contained_items(documents(spark), items(spark), exact=exact).collect()))
    assert search(True) == search(False)


def test_toxicity_learns_and_bears_everything(spark):
    rows = [(i, f"calm text number {i % 17} about rivers and hills " * 4 + ("you utter blockhead" if i % 3 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = labels(spark, [(i, 1, int(i % 3 == 0)) for i in range(200)])
    weights = toxicity.fit(docs, marks.filter(~toxicity.held_out(F.col("doc_id"))))
    got = toxicity.score(docs, weights).collect()
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in got) and 0 < len(weights) < 100
    assert {r.doc_id for r in marks.filter(toxicity.held_out(F.col("doc_id"))).collect()} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0}
    odd = toxicity.score(documents(spark), weights).collect()
    assert len(odd) == 14 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in odd)
    assert toxicity.score(empty(spark), weights).count() == 0
    nothing = toxicity.fit(empty(spark), marks)
    assert nothing == {} and {r.score for r in toxicity.score(documents(spark), nothing).collect()} == {0.5}


def test_html(spark):
    page = """<title>t</title><p>One<p>Two <b>bold
 </b>text<br>next<ul><li>a<li>b<ul><li>c</ul><ol start=3><li>x<li>y</ol></ul>
<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>fig<td>10</table>
<div style="display: none">no</div><div style="visibility:hidden">no<span style="visibility:visible">yes</span></div><pre>
 a
   b</pre><select><option>s1<option selected>s2</select><details><summary>sum</summary>no</details><p hidden>no</p>a&amp;&lt;b <script>no</script><!-- no -->end"""
    assert render(page).split("\n") == [
        "One", "", "Two bold text", "next", "", "- a", "- b", "  - c", "  3. x", "  4. y", "", "Cap", "Name  | Qty", "apple | 3", "fig   | 10", "", "yes", "", " a", "   b", "", "s2", "sum", "a&<b end",
    ]


def test_html_breaks_and_bars():
    assert render("a<br><br>b<br>c").split("\n") == ["a", "", "b", "c"]
    assert render("<table><tr><td>a |<td>|<td></table>") == "a | | |"
    assert render("<ul><li><p>x</p><li>y</ul>").split("\n") == ["- x", "- y"]
    wide = render("<table><tr><td colspan=120>w<td>end<tr>" + "".join(f"<td>{k}" for k in range(121)) + "</table>")
    assert wide.split("\n")[0].count("|") == 120


@pytest.mark.parametrize("page", ["<" * 3000, "<a" * 3000, "<div>" * 20_000 + "x", "<table><tr><td>" * 2000 + "y", "<p " + "\"'" * 3000, "<!--", "</td></table>z", "<b><i></b>x</i>", None, ""])
def test_broken_html_does_not_fail(page):
    assert isinstance(render(page), str)


def test_all_visible_text_is_there():
    page = "".join(f"<{t}>w{k} <i>v{k}</i></{t}>" for k, t in enumerate(["p", "div", "li", "td", "h1", "section", "span", "pre", "dd", "blockquote"] * 5))
    found = render(page)
    assert all(f"w{k}" in found and f"v{k}" in found for k in range(50))


def test_html_edges(spark):
    pages = spark.createDataFrame([(1, "<p>a", "x"), (1, "<p>a", "x"), (None, None, "x"), (2, "", "x")], "page_id long, html string, text string")
    assert sorted((str(r.page_id), r.text) for r in visible_text(pages).collect()) == [("1", "a"), ("1", "a"), ("2", ""), ("None", "")]
    assert visible_text(pages.limit(0)).count() == 0 and PROSE
