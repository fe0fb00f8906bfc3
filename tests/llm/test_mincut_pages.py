"""Extraction on awkward and hostile pages: no article text lost, time linear in the length."""

import time

import pytest

from tidemark.llm import mincut


def _text(body):
    return mincut.extract(f"<html><body><article>{body}</article></body></html>", mincut.fit([]))


@pytest.mark.parametrize("body, whole", [
    ("<p>We write <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math> here, and it holds for all.</p>",
     "We write x=2 here, and it holds for all."),
    ("<p>One <img src='a.png'> picture and one <canvas>drawn</canvas> figure stand in the line, as they do in print.</p>",
     "One picture and one drawn figure stand in the line, as they do in print."),
    ("<p>A very<wbr>long word may break, but it has no space in it, and the<br>line goes on.</p>",
     "A verylong word may break, but it has no space in it, and the line goes on."),
    ("<object data='f'><p>What an object says, where it can't be shown, is text too.</p></object>",
     "What an object says, where it can't be shown, is text too."),
    ("<p title='a > b'>A quoted sign ends no tag, so this sentence stands alone, whole.</p>",
     "A quoted sign ends no tag, so this sentence stands alone, whole."),
    ("<p>One sentence stands before the rule, and it is long.</p><hr><p>Another stands after it, just as long as that.</p>",
     "One sentence stands before the rule, and it is long.\n\nAnother stands after it, just as long as that."),
])
def test_article_text_is_kept(body, whole):
    assert _text(body) == whole


def test_a_quote_that_never_ends():
    got = _text('<p>The first one is fine, and long enough to stay.</p><p class="x>The second lost a quote, and it stays as well.</p>'
                "<p>So does the third, which comes after it.</p>")
    assert got == ("The first one is fine, and long enough to stay.\n\nThe second lost a quote, and it stays as well."
                   "\n\nSo does the third, which comes after it.")


def test_text_after_the_last_tag():
    w = mincut.fit([])
    assert mincut.extract("<article><p>Here a < b and <b never closes, which is no tag. <!-- gone", w) == \
        "Here a < b and <b never closes, which is no tag."


HOSTILE = {
    "open anchors": lambda n: "<a " * n,
    "open divs": lambda n: "<div>" * n + "x",
    "unmatched ends": lambda n: "<div>" * n + "</x>" * n,
    "ends within skipped": lambda n: "<svg>" + "<g>" * n + "</x>" * n,
    "open quotes": lambda n: '<a "' * n + ">",
    "mixed quotes": lambda n: "<a '\">" * n,
    "deep text": lambda n: "<div>t" * n,
    "comments": lambda n: "<!--" * n,
    "declarations": lambda n: "<!x" * n,
}


@pytest.mark.parametrize("kind", sorted(HOSTILE))
def test_hostile_markup_takes_linear_time(kind):
    """100,000 pieces of each: the quadratic way takes minutes, this one seconds."""
    page = HOSTILE[kind](100_000)
    t = time.time()
    mincut.extract(page, mincut.fit([]))
    assert time.time() - t < 20
