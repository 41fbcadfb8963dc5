"""Pages whose wrappers carry furniture words, broken markup, and the windows against their definition."""

import random

import pytest

from tabkit.llm import html

BODY = ("The body of this page stands in a plain element and is what readers came for. " * 5).strip()

PAGES = {
    "layout word around the page": (f'<body><div class="wrapper has-sidebar"><p>{BODY}</p><p>{BODY}</p></div></body>', f"{BODY}\n{BODY}"),
    "widget inside the article": (f'<main><div class="elementor-widget-container"><p>{BODY}</p></div></main>', BODY),
    "widget around the article": (f'<div class="widget"><article><p>{BODY}</p></article></div><div class="sidebar"><p>{BODY}</p></div>', BODY),
    "words inside other names": (f'<article><p>{BODY}</p><p class="related-work">Work before.</p><p class="post-social-impact">Its impact was large.</p></article>',
                                 f"{BODY}\nWork before.\nIts impact was large."),
    "names that say nothing else": (f'<article><p>{BODY}</p><div class="related-posts">More <a href=1>here</a></div><div id="ad">Buy</div></article>', BODY),
    "links under such a name": (f'<article><p>{BODY}</p><div class="my-related-reads"><a href=1>More of the same</a></div></article>', BODY),
    "page inside a form": (f'<body><form id=f><div><p>{BODY}</p></div><p>{BODY}</p></form></body>', f"{BODY}\n{BODY}"),
    "comments marked as articles": (f'<article><p>{BODY}</p></article><div class="comments"><article class="comment">{BODY * 9}</article></div>', BODY),
    "comments inside the article": (f'<article><p>{BODY}</p><ol class="comment-list"><li>{BODY * 9}</li></ol></article>', BODY),
    "nothing but an advert": (f'<div class="ad">{BODY}</div><article></article>', ""),
    "button inside a paragraph": (f'<article><p>{BODY} <button>Share</button> On.</p></article>', f"{BODY} On."),
    "open quote": (f'<article><p class="x>text one two</p><p title=\'a > b\'>{BODY}</p></article>', f"text one two\n{BODY}"),
    "open quote before links": (f'<p class="x>text one two</p><a href="/foo">no</a><p class="y">{BODY}</p>', f"text one two\n{BODY}"),
    "markup inside values": (f'<article><p data-x="<b>x</b> > y" class=\'q\'>{BODY}</p></article>', BODY),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, text = PAGES[name]
    assert html.extract(page) == text


def test_hostile_pages_take_linear_time():
    assert html.extract('<div class="ad">' * 20_000 + "<p>y" * 20_000) == ""
    assert "<" not in html.extract('<p class="x>y' * 20_000)


def chosen(weights: list[int], window: int, surge: int) -> list[int]:
    """By definition: a line with weight belongs to the text if a surge point stands at or before it and no window between them is empty."""
    sums = [sum(weights[i:i + window]) for i in range(len(weights))]
    threshold = min(surge, max(sums, default=0))
    return [j for j, w in enumerate(weights) if w > 0 and any(
        weights[i] > 0 and sums[i] >= threshold and all(sums[k] > 0 for k in range(i, j + 1)) for i in range(j + 1))]


def test_windows_against_their_definition():
    rng = random.Random(5)
    for _ in range(3_000):
        weights = [rng.choice([0, 0, 0, rng.randint(1, 30), rng.randint(30, 90)]) for _ in range(rng.randint(0, 25))]
        window, surge = rng.randint(1, 5), rng.choice([1, 20, 60, 500])
        found = html.main_range(weights, window, surge)
        assert [i for a, b in found for i in range(a, b + 1) if weights[i]] == chosen(weights, window, surge)
        assert all(b < c for (_, b), (c, _) in zip(found, found[1:]))
