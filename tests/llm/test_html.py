"""The page reader on hostile markup and the labeller on pages of other make."""

import time

import pytest

from vintage.llm import html

ARTICLE = [
    "The council met on Tuesday evening to discuss the new bridge over the river, which has been planned for nearly ten years.",
    "Engineers said that the work would take about two years, and that the old crossing would stay open until the new one is finished.",
    "Several residents asked how the noise would be kept down at night. The mayor promised that no heavy work would be done after eight.",
    "The cost is now put at forty million, a third more than was thought last year, because steel has become dearer.",
    "A final vote is expected in March. If it passes, the first piles could be driven in early summer.",
    "Until then, the council wants to hear from anyone who uses the bridge every day."]
OTHERS = ["You may also like these stories.", "Ten bridges you must see.", "Great article, thanks for sharing this!",
          "I disagree with the mayor on this one.", "We use cookies to improve your experience."]
#: Container of the article, container of the rest, whether the names are usual ones.
MAKES = [("article", "div class=comments", True), ("div class=article", "div class=comments", True), ("main", "div class=cookie", True),
         ("div", "div class=discussion", True), ("div class=c1x", "div class=c2y", False), ("div class=prose", "div class=feedback", False),
         ("div class=story", "div class=talk", False), ("section class=q9", "section class=q8", False)]


def _page(holder, rest, place):
    a, o = ([f"<p>{x}</p>" for x in texts] for texts in (ARTICLE, OTHERS))
    other = f"<{rest}>{''.join(o)}</{rest.split()[0]}>"
    inner = "".join([*a[:3], *([other] if place == "inside" else []), *a[3:]])
    return f"<html><body>{other * (place == 'before')}<{holder}>{inner}</{holder.split()[0]}>{other * (place == 'after')}</body></html>"


@pytest.fixture(scope="module")
def net(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").filter("html <> ''").orderBy("page_id").limit(html.TRAIN_PAGES)
    return html._learnt([r.html for r in rows.collect()])


def test_pages_of_other_make(net):
    """The article stays whole under every name; what stands under a usual name
    of something else goes whole, of the rest under names that say nothing at
    most one line in five stays."""
    stays = lines = 0
    for holder, rest, usual in MAKES:
        for place in ("after", "inside", "before"):
            page = html.blocks(_page(holder, rest, place))
            kept = {t for (_, t, _), y in zip(page, html.probabilities(net, [html.vectors(page)])[0]) if y >= 0.5}
            assert set(ARTICLE) <= kept, (holder, rest, place)
            assert not usual or not kept & set(OTHERS), (holder, rest, place)
            stays, lines = stays + len(kept & set(OTHERS)), lines + len(OTHERS) * (not usual)
    assert stays <= 0.2 * lines


def test_pages_that_were_not_learnt(spark, net):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("html <> ''").select("html").collect()
    learnt = {r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()}
    pages = [html.blocks(r.html) for r in rows if r.html not in learnt][:800]
    right = 0
    for page, p in zip(pages, html.probabilities(net, [html.vectors(x) for x in pages])):
        right += all((y >= 0.5) == bool(m) for (path, _, _), y in zip(page, p) if (m := html._meaning(path)) is not None)
    assert len(pages) >= 500 and right >= 0.99 * len(pages)


@pytest.mark.parametrize("piece", ["<a ", '<x a="', "<!--", "<b>", "<div>x", "<b></i>", "<b>x<hr>", "<", "<![", "</", "&amp", "<script>", "<p>x<b>", "<a b=c "])
def test_reading_is_linear(piece):
    def took(n):
        began = time.process_time()
        html.blocks(piece * n)
        return time.process_time() - began
    took(1000)
    base = min(took(10_000) for _ in range(3)) + 0.02
    for times in (10, 20, 40):
        assert took(10_000 * times) < 4 * times * base


def test_what_is_never_closed_takes_the_rest():
    for odd in ("<!-- open", '<a href="x', "<a href=", "<script>var a;", "</p"):
        assert [t for _, t, _ in html.blocks(f"<p>Before.</p>{odd}<p>second" if odd[-1] not in "p=" else f"<p>Before.</p>{odd}")] == ["Before."], odd
    assert [t for _, t, _ in html.blocks("<p>3 < 4<!--> and <!-- - -- -->5<?php x?> 6</p>")] == ["3 < 4 and 5 6"]
