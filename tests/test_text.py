import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from ragstone.functions import similarity, text
from ragstone.operators import chunking


def values(spark, expression, *rows):
    return [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string").orderBy("i").select(expression(F.col("x"))).collect()]


def test_strip_is_unicode(spark):
    assert values(spark, text.strip, " x ", "\t x y\n", " x\x1c", "") == ["x", "x y", "x", ""]


def test_html_and_normal_form(spark):
    html = "<p>One</p><script>var a='</p>';</script><li>Two<br/>three &amp; four</li><style>p{}</style>end"
    clean = lambda x: text.normalise_text(text.strip_html(x))
    assert values(spark, clean, html, "a\r\n\r\n\r\n\r\nb\tc \x0b d", " \n ", "x \n y") == ["One\nTwo\nthree &amp; four\nend", "a\n\nb c d", "", "x\ny"]


def test_ids_and_hashes(spark):
    assert values(spark, text.page_path_id, " /a/b/ ", "a") == ["gov-uk/a/b", "gov-uk/a"]
    assert values(spark, text.content_hash, "abc") == [hashlib.sha256(b"abc").hexdigest()[:16]]


def test_words_and_sentences(spark):
    assert values(spark, text.tokens, "Ab-1 c's é2") == [["ab", "1", "c", "s", "2"]]
    assert values(spark, text.content_tokens, "The tax of the TAX year") == [["tax", "year"]]
    assert values(spark, text.sentences, "One. Two? three! £4 is. Five") == [["One.", "Two? three!", "£4 is.", "Five"]]
    assert values(spark, text.normalise_question, "  What  is it?! ", "?A. ß") == ["what is it", "a. ss"]


def test_figures(spark):
    passage = "Pay £1000 by 5 April 2024, at 20% or 12.5 %."
    rows = spark.createDataFrame([("£1,000 and £5,000 on 31 January", passage), ("SA100 in 2024", passage), ("7", " ")], "a string, p string")
    assert [r[0] for r in rows.select(text.unsupported_figures(F.col("a"), F.col("p"))).collect()] == [["£5,000", "31 January"], ["SA100"], []]


@pytest.mark.parametrize(
    "question, refers",
    [("According to this GOV.UK guidance, what is due?", True), ("According to HS320, when?", True), ("What is the vision as set out in its strategy?", False), ("As stated above, what?", True), ("According to the rules, what?", False), (None, False)],
)
def test_self_reference(spark, question, refers):
    assert values(spark, text.is_self_referential, question) == [refers]


def test_questions(spark):
    assert values(spark, text.reads_as_question, "While studying, what is it?", "how to pay", "The rules are set out", "", None) == [True, True, False, False, False]


def test_parsers(spark):
    verdict = '```json\n{"relevance": "PASS", "source_support": false, "confidence": 1.5, "duplicate": true, "decision": "maybe"}\n```'
    got = values(spark, text.parse_verdict, verdict)[0]
    assert (got.relevance, got.source_support, got.confidence, got.duplicate, got.decision) == ("pass", "fail", None, True, "")
    raw = '[{"question": " Q? ", "difficulty": "odd"}, {"question": " "}]'
    assert [[(x.question, x.difficulty) for x in r] for r in values(spark, text.parse_candidates, raw, "no json")] == [[("Q?", "single_hop")], []]


def test_similarities(spark):
    rows = spark.createDataFrame([("red green blue", "green blue", [1.0, 0.0], [0.0, 0.0])], "a string, b string, u array<float>, v array<float>")
    a, b = F.col("a"), F.col("b")
    got = rows.select(similarity.similarity(a, b), similarity.overlap(a, b), similarity.token_f1(a, b), similarity.cosine(F.col("u"), F.col("v")), similarity.cosine(F.col("u"), F.col("u"))).first()
    assert list(got) == [pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(0.8), 0.0, 1.0]


@pytest.mark.parametrize("size, overlap", [(10, 3), (7, 0), (10, 9), (200, 40)])
def test_simple_windows(spark, size, overlap):
    x = "Lorem ipsum  dolor 😀 sit\n\n amet   " * 6
    want = [w for i in range(0, len(x), size - overlap) if (w := x[i : i + size].strip())]
    assert values(spark, lambda c: chunking.simple_windows(c, size, overlap), x, "") == [want, []]


def test_splitter_arguments(spark):
    for size, overlap in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            chunking.simple_windows(F.col("x"), size, overlap)
    with pytest.raises(ValueError):
        chunking.chunk_pages(spark.createDataFrame([], "base_path string, body string"), "other")


def test_recursive_split():
    split = lambda x, size, overlap: chunking.recursive_split(x, size, overlap, ("\n\n", "\n", ". ", " ", ""))
    assert split("aa bb cc dd", 5, 2) == ["aa bb", "bb cc", "cc dd"]
    assert split("one\n\ntwo", 100, 0) == ["one\n\ntwo"]
    assert split("abcdefgh", 3, 1) == ["abc", "cde", "efg", "gh"]
    words = " ".join(f"w{i}" for i in range(200))
    pieces = split("intro\n\n" + words, 50, 10)
    assert all(len(p) <= 50 for p in pieces)
    assert {w for p in pieces for w in re.findall(r"\w+", p)} == {"intro", *words.split()}


def test_chunk_ids(spark):
    pages = spark.createDataFrame([("/a/", "x" * 25)], "base_path string, body string")
    got = chunking.chunk_pages(pages, "simple", 10, 0).orderBy("chunk_index").collect()
    assert [(r.chunk_id, len(r.text)) for r in got] == [("gov-uk/a#chunk-0", 10), ("gov-uk/a#chunk-1", 10), ("gov-uk/a#chunk-2", 5)]


def test_long_texts_take_linear_time(spark):
    """Twice the text takes about twice the time, for windows and for figures."""
    cases = {
        lambda: F.size(chunking.simple_windows(F.col("x"), 200, 50)): "some words and 17 more ",
        lambda: F.size(text.unsupported_figures(F.col("x"), F.lit("one of 3"))): "it was 1{i} in 19{i} and ",
    }
    for make, part in cases.items():
        spent = []
        for n in (8_000, 16_000):
            rows = spark.createDataFrame([("".join(part.replace("{i}", str(i % 90)) for i in range(n)),)], "x string")
            start = time.perf_counter()
            rows.select(make()).collect()
            spent.append(time.perf_counter() - start)
        assert spent[1] < 3 * spent[0] + 3
