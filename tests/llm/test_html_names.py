"""What an article's names may not take from it, what comments may not add to it, and linear time."""

import time

import pytest

from tamis.llm.html_text import main_text

BODY = "<p>First long paragraph, with commas, and more words than any line of small print could have in it.</p>"


@pytest.mark.parametrize("name", "ad-hoc social-sciences search-results share-price legal disclaimer related comment alert login-guide hidden-gems".split())
def test_names_inside_an_article(name):
    page = f"<body><article><h1>T</h1>{BODY}<p class='{name}'>Kept text here.</p><h3 class='{name}'>A heading</h3><ul class='{name}'><li>one</li></ul></article></body>"
    kept = ["Kept text here.", "A heading", "one"]
    assert main_text(page).split("\n")[2:] == kept[: 2 if name == "comment" else 3]  # a list of comments is one


@pytest.mark.parametrize("name", ["ad", "top-ad-box", "cookie-notice", "related-posts", "share-buttons", "newsletter-signup", "sidebar", "site-footer", "comments-area", "sponsored-content"])
def test_named_containers_go(name):
    page = f"<body><article><h1>T</h1>{BODY}<div class='{name}'><p>Something else, not of the article.</p></div></article><div id='{name}'><p>More of it, and more.</p></div></body>"
    assert main_text(page).count("\n") == 1


@pytest.mark.parametrize("name", ["ad-free", "has-sidebar", "no-ads", "entry-header", "social-sciences", "search-results"])
def test_names_that_say_otherwise(name):
    assert main_text(f"<body><article>{BODY}<div class='{name}'><p>Kept, as it should be.</p></div></article></body>").endswith("\nKept, as it should be.")


@pytest.mark.parametrize("name", "discussion responses feedback conversation comments thread".split())
def test_comments_by_name_and_form(name):
    one = "<div class=r><span class=author>Ann</span><p>What a silly piece of writing, I must say.</p></div>"
    block = f"<section class='{name}'>{one}<div class=r><time>1 May</time><p>Ann is right, of course, as ever she is.</p></div></section>"
    assert main_text(f"<body><article>{BODY}{BODY}</article>{block}</body>").count("\n") == 1
    assert main_text(f"<body><article>{BODY}{BODY}{block}</article></body>").count("\n") == 1
    assert main_text(f"<body><div class=x>{BODY}{BODY}</div>{block}</body>").count("\n") == 1
    unnamed = block.replace(f" class='{name}'", "")
    assert main_text(f"<body><div class=x>{BODY}{BODY}</div>{unnamed}</body>").count("\n") == 1
    if name != "comments":  # a section of a paper may be called so
        assert main_text(f"<body><article>{BODY}<section class='{name}'><p>The results, in short.</p></section></article></body>").endswith("The results, in short.")


def test_siblings_with_text():
    page = f"<body><div id=wrap><div><p>The lead of it all, in a line.</p></div><div>{BODY * 3}</div><div><p>And a closing word from the author.</p></div><div><a href=x>More</a></div></div></body>"
    got = main_text(page).split("\n")
    assert got[0].startswith("The lead") and got[-1].startswith("And a closing") and len(got) == 5


@pytest.mark.parametrize("share", [1, 30])
def test_no_size_decides(share):
    """A wrapper with a noisy name holds the article, whatever its share of the page."""
    rest = "<div><p>x</p></div>" * share
    for page in (f"<div class=widget><article>{BODY}</article></div>{rest}", f"<form id=form><h1>Title</h1>{BODY}</form>{rest}"):
        assert BODY[3:-4] in main_text(f"<body>{page}</body>")
    assert main_text(f"<body><article>{BODY}</article><div class=ad><p>{'buy this, ' * 300 * share}</p></div></body>") == BODY[3:-4]


N = 20_000
PAGES = [
    "<table><tr><td><table>" + "<b>" * N + "<td></td>" * N,
    "<ul><li>" + "<b>" * N + "<li>x" * N,
    "<div>" * N + "<header>x</header>" * N,
    "<div class=discussion>" * N + "x",
    "<p><table><tr>" * N + "<td>x" * N,
    "</p>" * N,
    "<a href=x>" * N + "<div class=ad>y</div>" * N,
]


@pytest.mark.parametrize("page", PAGES, ids=range(len(PAGES)))
def test_linear_time(page):
    began = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - began < 15
