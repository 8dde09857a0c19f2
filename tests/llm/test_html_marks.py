"""Operator 8: what names say is weighed against the text, and labels are those of a minimum cut."""

from itertools import product

import numpy as np
import pytest

from stemfold.llm.html import MOST_AWAY, MOST_TEXT, MOST_TOWARD, PRIOR, WITHIN, gains, label_blocks, main_text, read_page, smoothness

PARA = "<p>The quick brown fox jumped over the lazy dog, and nobody in the village was surprised. It had done so every day for years, as far as anyone could tell.</p>"
#: As fitted on pages of plain articles.
FITTED = np.array([-4.6, -0.2, 0.4, -2.4, 0.3, 2.5, 5.9, 3.5, -0.9, 1.8, -1.1, -1.3, -5.0, 5.1, -4.6, 4.5])


def page(inner, after=""):
    return f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>A title here</h1>{PARA * 3}{inner}{PARA * 3}</article>{after}<footer>About us</footer></body></html>"


@pytest.mark.parametrize(("inner", "kept"), [
    ('<p class="recommended">Doctors recommended this treatment for many years before the new one came, he said.</p>', True),
    ('<p class="form">Form follows function, as the architect used to say in those days.</p>', True),
    ('<p class="text-widget-area">The area of a widget is hard to measure, as every engineer knows by now.</p>', True),
    ('<p class="' + "x " * 500 + 'recommended">Doctors recommended this treatment for many years, and it did no harm.</p>', True),
    ('<div class="share"><a href="/s">Share</a> <a href="/t">Post</a></div>', False),
    ('<section class="comments"><h3>Comments</h3>' + '<div class="comment"><p>I think this is wrong, and I said so to my neighbour. She agreed.</p></div>' * 5 + "</section>", False),
])
def test_text_is_weighed_against_names(inner, kept):
    whole = "\n".join(b.text for b in read_page(inner).blocks)
    got = main_text(page(inner), FITTED)
    assert (whole in got) == kept
    assert got.startswith("A title here") and "Home" not in got and "About us" not in got and got.count("quick brown") == 6


def test_no_mark_outweighs_a_text_and_an_edge():
    assert max(MOST_AWAY, MOST_TOWARD) < MOST_TEXT + WITHIN and 2 * MOST_AWAY < MOST_TEXT + WITHIN
    blocks = read_page(page('<p class="ad">x</p>')).blocks
    marks = gains(blocks, np.concatenate([np.zeros(12), FITTED[12:]]))
    assert (marks >= -2 * MOST_AWAY).all() and (marks <= 2 * MOST_TOWARD).all()


@pytest.mark.parametrize("weights", [PRIOR, FITTED, np.concatenate([PRIOR[:12] / 4, PRIOR[12:] / 8])])
def test_labels_of_small_pages_are_the_cheapest_of_all(weights):
    pages = [
        "<article><h1>One</h1><p>Short.</p><p class='ad'>Buy this, it is good for you and for all of your friends.</p></article><footer>End</footer>",
        "<div><p>Some words, and some more words.</p><ul><li><a href='/'>Link one</a></li><li>Plain item, longer than a link.</li></ul></div><div class='menu'><p>Menu</p></div>",
        "<nav>Home</nav><p>A text that stands alone, with a comma.</p><aside><p>Beside it, a text.</p></aside><table><tr><td>1</td><td>2</td></tr></table>",
        "<main><section><p>a b c d e f g, h.</p></section><section class='related'><p>Related things, of which there are many.</p><p>x</p></section></main>",
    ]
    for html in pages:
        p = read_page(html)
        g, edges = gains(p.blocks, weights), smoothness(p)
        cost = lambda y: sum(-x if own else 0.0 for x, own in zip(g, y, strict=True)) + sum(w for a, b, w in edges if y[a] != y[b])  # noqa: E731, B023
        got = label_blocks(p, weights)
        assert 1 < len(got) <= 12 and cost(got) == pytest.approx(min(map(cost, product([False, True], repeat=len(got)))))
