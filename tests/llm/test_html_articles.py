"""Operator 10: what belongs to an article stays, what does not goes, and votes decide between containers."""

import pytest

from aerolag.llm.html import extract, host_paths, main_texts, votes

LONG = "Sentences of the article go on for a while and say one thing after another. " * 6
LONG = LONG.strip()


def article(inner: str, before: str = "", after: str = "") -> str:
    return f"<body><nav><a href=x>Home</a></nav>{before}<article><h1>Head</h1><p>{LONG}</p>{inner}</article>{after}<footer>f</footer></body>"


@pytest.mark.parametrize(
    "inner",
    [
        '<div class="related-work">Earlier studies.</div>',
        '<p id="notice-period">Thirty days.</p>',
        '<section id="search-methods">We asked.</section>',
        '<h2 class="comment">A remark</h2>',
        '<div class="social">Of society.</div>',
        '<blockquote class="replies-quote">Quoted.</blockquote>',
        '<div class="discussion">What follows from it.</div>',
        '<label>Figure 3</label>',
        '<p class="share">A share of the whole.</p>',
        '<div class="comment">One editorial remark.</div>',
    ],
)
@pytest.mark.parametrize("around", ["article", "div"])
def test_parts_of_an_article_stay(inner, around):
    page = article(inner)
    if around == "div":
        page = page.replace("<article>", '<div class="story">').replace("</article>", "</div>")
    text = inner[inner.index(">") + 1 : inner.index("</")]
    assert extract(page, None) == f"Head\n{LONG}\n{text}"


@pytest.mark.parametrize(
    "inner",
    [
        '<div class="ad">Buy this.</div>',
        '<div class="cookie-banner">We use them.</div>',
        '<div class="newsletter">Sign up.</div>',
        '<div class="share"><a href=a>Post</a> <a href=b>Mail</a></div>',
        '<div class="related"><a href=a>One more</a><a href=b>And another</a></div>',
        '<aside>Beside it.</aside>',
        '<div class="comments"><p>Nice.</p></div>',
        '<section class="discussion"><div class="comment">Nice.</div></section>',
        '<div class="comment">Nice.</div><div class="comment">Bad.</div>',
        '<form><label>Name</label></form>',
        '<footer>By me</footer>',
    ],
)
def test_what_is_no_part_goes(inner):
    assert extract(article(inner), None) == f"Head\n{LONG}"


def test_headers():
    own = f"<body><header><h1>Site</h1></header><article><header><h1>Head</h1><p>By me</p></header><p>{LONG}</p></article></body>"
    assert extract(own, None) == f"Head\nBy me\n{LONG}"
    bare = f"<body><article><header><a href=x>Back</a></header><p>{LONG}</p></article></body>"
    assert extract(bare, None) == LONG
    said = f'<body><article><header role="banner"><h2>Site</h2></header><p>{LONG}</p></article></body>'
    assert extract(said, None) == LONG


def test_a_small_box_on_the_winning_path_is_not_the_article():
    page = f'<body><div class="content">Short teaser box.</div><section class="story"><article><p>{LONG}</p></article></section></body>'
    assert extract(page, "/body/div.content") == LONG


def pages_of_a_host():
    """On one page a box of notes and links outweighs the story; the host's other pages show which is which."""
    links = "".join(f"<p><a href=/{i}>One more page of the site to go to, number {i}</a></p>" for i in range(9))
    page = '<body><div class="story"><p>{}</p></div><div class="box"><p>{}</p>' + links + "</div></body>"
    usual = [page.format(f"{LONG} {i}", f"Notes {i}.") for i in range(4)]
    story = "The short story of the day is told here in a few words, and then it ends as it began."
    box = "Notes of all kinds, terms and hints that the site puts on those of its pages it has little else to say on today."
    return usual, page.format(story, box), story, box


def test_votes_change_a_page(spark):
    usual, odd, story, box = pages_of_a_host()
    assert votes(odd)["/body/div.story"] < 1.0
    alone, voted = extract(odd, None), extract(odd, "/body/div.story")
    rows = [(i, "http://h.example/a", page) for i, page in enumerate([*usual, odd])]
    given = spark.createDataFrame(rows, "page_id long, url string, html string")
    (winner,) = host_paths(given.selectExpr("'h' AS host", "html")).collect()
    assert winner.path == "/body/div.story"
    texts = {r.page_id: r.text for r in main_texts(given).collect()}
    assert texts[4] == voted == story
    assert box in alone


def test_equal_votes_and_odd_rows(spark):
    page = "<body><div class='a'><p>{0}</p></div><div class='b'><p>{0}</p></div></body>".format("x" * 300)
    rows = [(1, "http://t/", page), (1, "http://t/", page), (None, None, page), (2, "no host", None), (3, "http://u/", "<p>" + "y" * 200_000)]
    given = spark.createDataFrame([(*r, "clash", "c") for r in rows], "page_id long, url string, html string, path string, host string")
    found = main_texts(given).collect()
    assert len(found) == 5
    assert len({r.text for r in found if r.page_id in (1, None)}) == 1
    assert {r.page_id: r.n_chars for r in found if r.page_id in (2, 3)} == {2: 0, 3: 200_000}
