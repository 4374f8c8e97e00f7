import time
from html.parser import HTMLParser

import pytest

from posttrend.llm import extract
from posttrend.llm.html_blocks import blocks

PAGES = "page_id long, url string, html string"


def test_blocks():
    page = (
        "<head><title>T</title><style>p{}</style></head><body>lead<p class='a b'>one <b>two<br>three<p>four&nbsp;&amp; five"
        "<ul><li>x<li>y</ul><script>var t='</p>';</script><!-- <p>no</p> --><div>a<span>b</span>c</div>1 < 2 &lt;p&gt;"
    )
    found = blocks(page)
    assert [b.text for b in found] == ["lead", "one two three", "four & five", "x", "y", "abc", "1 < 2 <p>"]
    assert found[1].path[-2:] == (("p", "a b"), ("b", "")) and [t for t, _ in found[3].path][-2:] == ["ul", "li"]
    assert blocks(None) == blocks("") == blocks("<p> </p>") == [] and blocks("<p>x<!-- open") [0].text == "x"


def test_head_without_its_end():
    head = "<html><HEAD><meta charset=x><title>T</title>\n<link rel=x><style>p{}</style><script>var t='<p>no</p>';</script> "
    for body in ("<body><p>one<p>two</body></html>", "<p>one<p>two", "\n<main>one<div>two</div>", "one<p>two</html>", "</body>one<p>two"):
        assert [b.text for b in blocks(head + body)] == ["one", "two"], body
        assert not any(tag == "head" for b in blocks(head + body) for tag, _ in b.path)
        assert blocks(head + body) == blocks(head + "</head>" + body)
    assert blocks(head) == blocks(head + "</head></html>") == []


def test_page_without_head_end_is_extracted(make):
    body = "<body><article><h1>Title here</h1><p>First paragraph with words, long enough to read.</p></article></body></html>"
    rows = [(1, "u", "<html><head><title>T</title>" + body), (2, "u", "<html><head><title>T</title></head>" + body)]
    a, b = extract.extract_text(make(rows, PAGES)).orderBy("page_id").collect()
    assert a.text == b.text == "Title here First paragraph with words, long enough to read." and a.n_chars == b.n_chars > 0


def test_held_out_accuracy():
    field = extract.default_field()
    wrong = total = 0
    for page, labels in extract.labelled_pages(150, seed=1234):
        got = field.label(blocks(page))
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong < 0.03 * total


def test_viterbi_is_the_best_run():
    import itertools

    field = extract.default_field()
    for page, _ in itertools.islice(extract.labelled_pages(30, seed=5), 30):
        found = blocks(page)[:9]
        scores = [sum(field.weights.get(f, 0.0) for f in fs) for fs in extract.features(found)]

        def value(y):
            return sum(s for s, v in zip(scores, y) if v) + sum(field.moves[a][b] for a, b in zip(y, y[1:]))

        best = max(itertools.product((0, 1), repeat=len(found)), key=value)
        assert abs(value(field.label(found)) - value(best)) < 1e-9


def test_extraction(make, by_id):
    page = (
        "<html><body><nav><ul><li><a href='/a'>Menu one</a></li></ul></nav><div class=\"ad\">Buy now.</div><article><h1>Title here</h1>"
        "<p>First para&shy;graph with words, long enough to read.<br>And more.</p><p>Second one,  spaced\n out.</p>"
        "<section class='comments'><p>I disagree with all of this.</p></section></article><footer>&copy; x</footer></body></html>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p></p>"), (1, "u", page)]
    got = extract.extract_text(make([(*r, "t") for r in rows], PAGES + ", text string"))
    assert got.count() == 5
    r = by_id(got, "page_id")
    assert r[1].text == "Title here First para\xadgraph with words, long enough to read. And more. Second one, spaced out."
    assert r[1].n_chars == len(r[1].text) and (r[2].text, r[3].text, r[4].n_chars, r[2].url) == ("", "", 0, None)
    assert extract.extract_text(make([], PAGES)).count() == 0


class PlainBlocks(HTMLParser):
    """Texts between block tags, by the parser of the standard library."""

    BREAKS = set("html head body title nav ul ol li div aside section header footer article main h1 h2 p blockquote form dialog".split())

    def __init__(self, page):
        super().__init__()
        self.texts, self.now, self.off = [], "", 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        if self.now.split():
            self.texts.append(" ".join(self.now.split()))
        self.now = ""

    def handle_starttag(self, tag, attrs):
        self.off += tag == "title"
        if tag in self.BREAKS:
            self.flush()
        if tag in ("br", "input"):
            self.now += " "

    def handle_endtag(self, tag):
        if tag in self.BREAKS:
            self.flush()
        self.off -= tag == "title"

    def handle_data(self, data):
        self.now += "" if self.off else data


def test_blocks_and_text_against_another_parser():
    field = extract.default_field()
    for page, labels in extract.labelled_pages(120, seed=77):
        texts = PlainBlocks(page).texts
        assert [b.text for b in blocks(page)] == texts
        got = field.label(blocks(page))
        assert extract.main_text(page, field) == " ".join(t for t, y in zip(texts, got) if y)
        if got == labels:
            assert extract.main_text(page, field) == " ".join(t for t, y in zip(texts, labels) if y)


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p data-x='it's'>First para.</p><p>Don't stop.</p>", ["First para.", "Don't stop."]),
        ('<p title="5" tall">Next paragraph</p>', ["Next paragraph"]),
        ('<p title="5>Open quote</p><p>more', ["Open quote", "more"]),
        ("<p title='a>b' class=x>one</p><p title=a>b", ["one", "b"]),
        ("if a <b c d", ["if a <b c d"]),
        ("x </3> y</> z </", ["x y z </"]),
        ("<p>a<!-->b<!--->c<!-- d --!>e<?php f ?>g<![CDATA[h]]>i", ["abcegi"]),
        ("<p a=b/>t<svg/>u<script>no</scripts>no</script >v", ["tuv"]),
        ("<p>&#" + "9" * 5000 + "; &#0000000000065;x", ["\ufffd Ax"]),
        ('<p a="=<p >b="=<p >c="=x', ['c="=x']),
        ('<p a="x>y" z', ['y" z']),
    ],
)
def test_malformed_markup(page, texts):
    assert [b.text for b in blocks(page)] == texts


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 330_000, '<p title="' * 100_000, "<p a='>\" b=\">" * 70_000, '<p a="=<p >a="=' * 66_000 + '"', "<div>" * 200_000 + "x",
        "<div>" * 100_000 + "</i>" * 100_000 + "x", "<div>" * 100_000 + "<td></td>" * 50_000 + "x", "<p><b>" + "<b>" * 150_000 + "<hr>" * 100_000 + "x",
        "<b>x" * 250_000, "<!--" * 250_000, "<" * 1_000_000, "<p " + "= " * 500_000 + ">x", "".join(f"<x{i}>t" for i in range(100_000)),
    ],
)
def test_hostile_megabyte(page):
    start = time.monotonic()
    extract.main_text(page, extract.default_field())
    assert time.monotonic() - start < 15  # some seconds at most; a quadratic reading takes hours


def test_nested_blocks_share_their_path():
    found = blocks("".join(f"<div class=c{i % 3}>t" for i in range(20_000)))
    assert len(found) == 20_000 and found[2].path == (("div", "c0"), ("div", "c1"), ("div", "c2"))
    assert found[-1].node.parent is found[-2].node


def test_very_long_page_and_clashing_columns(make):
    body = "<article><h1>Title here</h1>" + "<p>One of very many paragraphs, long enough to read.</p>" * 20_000 + "</article>"
    schema = "page_id long, url string, html string, text string, n_chars string"
    got = extract.extract_text(make([(7, "u", "<nav><ul><li><a href='/'>Menu</a></li></ul></nav>" + body, "x", None)] * 2, schema)).collect()
    want = " ".join(["Title here"] + ["One of very many paragraphs, long enough to read."] * 20_000)
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(7, want, len(want))] * 2
