"""Class words on a page's own frame, words with several meanings, and prose outside a host's path."""

import pytest
from pyspark.sql import functions as F

from loam.llm import htmltext

LONG = "<p>" + "words of a long paragraph " * 8 + "</p>"
PLAIN = ("words of a long paragraph " * 8).strip()


@pytest.mark.parametrize("page", [
    "<div id='content' class='has-sidebar'>{}</div>",
    "<div role='main' class='site-content no-sidebar'>{}</div>",
    "<div class='wrapper nav-open'>{}</div>",
    "<article><div class='entry-content share-enabled'>{}</div></article>",
    "<div class='sidebar-layout'><article>{}</article></div>",
    "<div class='page menu'><div>{}</div></div><div class='menu'><a href=x>Home</a></div>",
    "<form id='aspnetForm'><div class='top menu'><a href=x>Home</a></div><div>{}</div></form>",
    "<div class='widget'><div class='ad'>{0}</div></div>".replace("{0}", "{}"),
    "<article><section class='discussion'><h2>Discussion</h2>{}</section></article>",
    "<div class='paper'><section class='discussion'><h2>Discussion</h2>{}</section><section>{}</section></div>",
    "<main><p class='social'>Social life is prose here.</p>{}</main>",
    "<div class='widget'>{}</div><div class='widget'>{}</div>",
])
def test_frames_and_words_of_other_meanings_stay(page):
    text = htmltext.Page(f"<body>{page.replace('{}', LONG)}</body>").text([])
    assert text.count(PLAIN) == page.count("{}")
    assert ("Discussion" in text) == ("<h2>" in page) and ("Social life" in text) == ("social" in page)
    assert "Home" not in text


@pytest.mark.parametrize("part", [
    "<div class='sidebar'><p>A sidebar with some words of its own, a line or so.</p></div>",
    "<div class='ad'>Buy this thing now, it is the best of all the things.</div>",
    "<section class='discussion'><div class='comment'><p>First of all, I don't agree with this at all.</p></div></section>",
    "<div class='social'><a href=x>Share this page with all of your friends</a> now</div>",
    "<div class='respond'><p>Leave a reply, we read all of them every day.</p><textarea></textarea></div>",
    "<form><p>Give us your mail and a password to read on here.</p><input></form>",
    "<div id='cookie-notice'><p>We use cookies, as all others do, for this and that.</p></div>",
    "<div class='newsletter-signup is-wide'><p>Subscribe to our letter, it comes every week.</p></div>",
])
def test_boilerplate_goes(part):
    for page in ("<body>{}{}</body>", "<body><article>{}{}</article></body>", "<body><div class='content'>{}</div>{}</body>"):
        assert htmltext.Page(page.format(LONG, part)).text([]) == PLAIN


def test_comments_longer_than_the_article_go():
    page = f"<body><div class='post'>{LONG}</div><div class='comments'>{LONG * 4}</div></body>"
    assert htmltext.Page(page).text([]) == PLAIN


def test_a_host_path_takes_no_prose_from_a_page(spark):
    other = "<p>" + "prose of another division " * 5 + "</p>"
    usual = [(k, f"http://h.org/{k}", f"<body><div class='x'>{LONG}</div><div class='y'>Last seen today</div></body>") for k in range(4)]
    two = [(9, "http://h.org/9", f"<body><div class='x'>{LONG}</div><div class='z'>{other}</div></body>")]
    out = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(usual + two, "page_id long, url string, html string").withColumn("out", F.lit(1))).collect()}
    assert out[0] == PLAIN and out[9] == PLAIN + "\n" + ("prose of another division " * 5).strip()


def test_a_page_that_is_marked_all_over_keeps_its_prose():
    page = f"<body><div class='menu'>{LONG}</div><div class='sidebar'>{LONG}</div></body>"
    assert htmltext.Page(page).text([]).count(PLAIN) == 2
    assert htmltext.Page("<body><div class='ad'>A line that nobody needs to read here.</div><div class='ad'>Another line that nobody needs to read.</div></body>").text([]) == ""
