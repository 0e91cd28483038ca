"""Pages whose markup is cut short or never closed."""

import time

import pytest

from chunkloom.llm.html_extract import FEATURES, PRIOR, Model, Page

MODEL = Model(
    {f: PRIOR.get(f, 0.0) for f in FEATURES}, [[[0.99, 0.01], [0.1, 0.9]], [[0.5, 0.5], [0.1, 0.9]]], 0.5
)
ARTICLE = "<article><h1>Tides</h1><p>The sea comes and goes, twice a day. It always has.</p></article>"
WANT = "Tides\nThe sea comes and goes, twice a day. It always has."


@pytest.mark.parametrize("name", "svg math object canvas template noscript".split())
def test_an_unclosed_element_leaves_the_article(name):
    assert MODEL.text(f"<body><{name}>drawn {ARTICLE}</body>") == WANT
    assert MODEL.text(f"<body><div><{name}>drawn</div>{ARTICLE}") == WANT
    assert MODEL.text(f"<body><{name}>drawn<p>more</p></{name}>{ARTICLE}") == WANT


@pytest.mark.parametrize("name", "script style title textarea iframe".split())
def test_an_unclosed_script_takes_the_rest(name):
    assert MODEL.text(f"<body>{ARTICLE}<{name}>x <p>rest</p>") == WANT


def test_a_quote_that_never_ends():
    assert MODEL.text(f"<body><a title=\"x>{ARTICLE}") == WANT
    assert MODEL.text(f"<body><a title='1 > 0' href=\"a>b\">{ARTICLE}") == WANT


@pytest.mark.parametrize("part", ["<a ", "<!", "<a \"x>", "<a '\"", "<svg>", "</svg", "<!-- ", "<", "<a\"<b'>"])
def test_time_grows_with_the_length(part):
    def taken(n):
        start = time.process_time()
        page = Page(ARTICLE + part * n)
        assert any("twice a day" in text for _, _, text in page.texts)
        return time.process_time() - start

    taken(2_000)
    # Twice the length: quadratic reading takes four times as long, and minutes here.
    assert taken(200_000) < 3


def test_nothing_is_lost_behind_the_last_tag():
    assert MODEL.text("<article><p>One, two. Three < four and <b>five</b> <six").endswith("<six")
