"""Page shapes that lost text: hidden look-alikes, wrappers, headers inside articles, unclosed tags."""

from __future__ import annotations

import time

import pytest

from demandloom.llm.html import main_text

LONG = ("The river rose through the night and by morning the lower fields were under water, so the farmers moved their "
        "animals to the hill and waited there for the rain to stop.")
MORE = "Nobody in the village could remember such a flood, not even the oldest of the people who lived along the river."


@pytest.mark.parametrize("attribute", ['class="overflow-hidden"', 'style="overflow:hidden"', 'aria-hidden="false"', 'data-hidden="false"',
                                       'class="hidden-print"', 'title="hidden"', "data-x='a hidden b'", 'style="display:block"'])
def test_not_hidden(attribute):
    assert main_text(f"<body><article {attribute}><p>{LONG}</p><p>{MORE}</p></article></body>") == f"{LONG} {MORE}"


@pytest.mark.parametrize("attribute", ["hidden", 'hidden=""', 'class="a" hidden', 'aria-hidden="true"', "aria-hidden=true", 'style="color:red; display: none"'])
def test_hidden(attribute):
    assert main_text(f"<body><article><p>{LONG}</p><div {attribute}><p>{MORE}</p></div></article></body>") == LONG


@pytest.mark.parametrize("before,after", [('<form id="aspnetForm">', "</form>"), ('<div class="wrap has-sidebar">', "</div>"),
                                          ('<div class="no-header with-menu">', "</div>"), ('<div id="page-header">', "</div>")])
def test_wrappers_of_the_page(before, after):
    inner = f"<h1>The flood</h1><p>{LONG}</p><p>{MORE}</p><p>{LONG}</p>"
    got = main_text(f"<body><nav><a>Home</a> <a>News</a></nav>{before}{inner}{after}<footer>all rights reserved</footer></body>")
    assert LONG in got and MORE in got and "Home" not in got and "rights" not in got


def test_small_forms_and_large_comments_stay_out():
    page = (f"<body><article><h1>The flood</h1><p>{LONG}</p></article><form><p>Your name and address, please, before you go on</p></form>"
            f'<section id="comments">{f"<p>{MORE}</p>" * 9}</section></body>')
    assert main_text(page) == f"The flood {LONG}"


@pytest.mark.parametrize("header", ["<header><h1>The flood</h1><p>by a reporter</p></header>",
                                    '<div class="post-header"><h2>The flood</h2><span>3 May</span></div>'])
def test_title_in_the_article_header(header):
    assert main_text(f"<header><h2>The Paper</h2></header><article>{header}<p>{LONG}</p></article>") == f"The flood {LONG}"


@pytest.mark.parametrize("piece", ["<a ", "<div class=", "<!-", "<", "<a href='x"])
def test_unclosed_tags_take_linear_time(piece):
    page = f"<p>{LONG}</p>" + piece * (1_000_000 // len(piece))
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 3


def test_unclosed_comment_and_script():
    assert main_text(f"<article><p>{LONG}</p></article><!-- {MORE}") == LONG
    assert main_text(f"<article><p>{LONG}</p></article><script> {MORE}") == LONG
