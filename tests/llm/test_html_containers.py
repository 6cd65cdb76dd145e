"""Containers are known by whole names of their own class, id and role; articles are kept or dropped with what is around them."""

import pytest

from quern.llm import html_text

GOOD = "The cat sat on the mat and it was one of the best in the house of them all."


@pytest.mark.parametrize(
    "page",
    [
        "<div style='overflow: hidden'><p>{0}</p></div>",
        "<article style='overflow:hidden'><p>{0}</p></article>",
        "<div data-hidden='false'><p>{0}</p></div>",
        "<div class='content has-sidebar'><p>{0}</p></div>",
        "<div class='post comments-closed'><p>{0}</p></div>",
        "<article class='post no-comments'><p>{0}</p></article>",
        "<article class='comments'><p>{0}</p></article>",
        "<div data-role='search'><p>{0}</p></div>",
        "<body class='widget menu'><p>{0}</p></body>",
        "<p title='class=ad'>{0}</p>",
    ],
)
def test_whole_articles_stay(page):
    assert html_text.main_text(page.format(GOOD)) == GOOD


@pytest.mark.parametrize(
    "page",
    [
        "<p>{0}</p><div class='related'><article><p>{0}</p></article></div>",
        "<main><p>{0}</p></main><section id='comments'><article><p>{0}</p></article></section>",
        "<article><p>{0}</p></article><section id='comments'><article><p>{0}</p></article></section>",
        "<article><p>{0}</p><section class='comments'><article><p>{0}</p></article></section></article>",
        "<div class='site-nav'>Home</div><p>{0}</p><div class='cookie-banner'>{0}</div><div hidden>{0}</div>",
        "<div class=page><div class=ad>buy<article><p>{0}</p></article></div>",
        "<div class=wrap><nav>x</nav><div class='ad'>y<main><p>{0}</p></main></div>",
        "<aside>see also<article><p>{0}</p></article>",
    ],
)
def test_only_the_article_stays(page):
    assert html_text.main_text(page.format(GOOD)) == GOOD
