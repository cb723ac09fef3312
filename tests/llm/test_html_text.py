import html
import re

import pytest

from vaultspark.llm import html_text
from vaultspark.llm.html_pages import labelled_pages
from vaultspark.llm.registry import QUERIES


@pytest.fixture(scope="module")
def field():
    return html_text.train(labelled_pages(html_text.TRAIN_PAGES))


def test_held_out_blocks(field):
    wrong = total = 0
    for page, labels in labelled_pages(150, seed=4242):
        blocks = html_text.blocks_of(page)
        assert {b.text for b in blocks} == set(labels)
        wrong += sum(k != labels[b.text] for b, k in zip(blocks, field.decode(blocks)))
        total += len(blocks)
    assert wrong < 0.01 * total


def test_viterbi_is_the_best_labelling(field):
    page = labelled_pages(1, seed=77)[0][0]
    blocks = html_text.blocks_of(page)[:8]
    score = [field.score(b) for b in blocks]

    def total(y):
        return field.first * y[0] + sum(s * k for s, k in zip(score, y)) + sum(field.follow[a, b] for a, b in zip(y, y[1:]))

    best = max((total(y := [m >> k & 1 for k in range(len(blocks))]), y) for m in range(1 << len(blocks)))[1]
    assert field.decode(blocks) == [bool(k) for k in best]


def test_whole_table_gives_the_articles(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op2_html_text"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text)


def test_broken_markup_nulls_and_clashes(spark, make_tables, field):
    odd = "<article><p>One sentence, as it is&hellip;<p>Two <b>bold<br> words here.<div class=ad>Buy<!-- <p>no"
    folder = make_tables(extra="text string, n_chars int", pages=[
        (1, "u", None), (2, "u", ""), (3, None, odd), (3, None, odd), (4, "u", "no markup < at all &amp; so on"), (5, "u", "<script>x"),
        (6, "u", "<p " + "a=\"" * 2000), (7, "u", "<div>" * 3000 + "deep")])
    got = sorted(QUERIES["op2_html_text"](spark, folder).collect(), key=lambda r: r.page_id)
    assert [r.page_id for r in got] == [1, 2, 3, 3, 4, 5, 6, 7]
    assert got[0].text == got[1].text == got[5].text == ""
    assert got[2].text == got[3].text == "One sentence, as it is…\nTwo bold words here."
    assert QUERIES["op2_html_text"](spark, make_tables()).collect() == []


def test_blocks():
    found = html_text.blocks_of('<ul><li>a<li>b <a href="/x">c  d</a></ul><style>p{}</style><p>e&nbsp;f<script>"</p>"</script>g<h2>h</h2>')
    assert [(b.text, b.linked) for b in found] == [("a", 0), ("b c d", 4), ("e fg", 0), ("h", 0)]


@pytest.mark.parametrize("tag", sorted(html_text.UNREAD - {"head", "title"}))
def test_elements_that_are_not_read(tag):
    inside = f"<article><p>Before <{tag} class=x>hidden <b>bold</b> words</{tag}>after.</p><{tag}><p>hidden block</{tag}><p>Next.</p></article>"
    found = html_text.blocks_of(inside)
    assert " ".join(b.text for b in found) == "Before after. Next."
    assert [t for t, _ in found[0].context] == ["article", "p"]


def test_head_and_elements_left_open():
    page = "<html><head>loose words<title>T</title><body><p>One.</p><div><svg><text>lost</div><p>Two <object>lost<p>lost</object>here."
    assert [b.text for b in html_text.blocks_of(page)] == ["One.", "Two", "here."]
    assert html_text.blocks_of("<p><video><a href=x>lost") == []
