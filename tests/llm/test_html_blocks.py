"""Block rules without the article tag, markup of any length, and time in step with a page's length."""

import re
import time
from collections import Counter

import pytest

from cairn.llm import htmltext as h
from cairn.llm.htmltext import main_text

PROSE = "The house was on the hill and it had been there for a long time, as they told us when we came to see it with them in May."


def brute_tags(page):
    """Tag ends by walking every character with its quoting state, from each tag's begin anew."""
    out, at = [], 0
    while (at := page.find("<", at)) >= 0:
        m = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)").match(page, at)
        if not m:
            at += 1
            continue
        i, end = m.end(), None
        while i < len(page):
            c = page[i]
            if c == ">":
                end = i
                break
            if c in "\"'" and page[:i].rstrip(" \t\n\r\f\v").endswith("=") and page.find(c, i + 1) >= 0:
                i = page.find(c, i + 1)
            i += 1
        if end is None:
            j, other = page.find(">", m.end()), page.find("<", m.end())
            if j < 0 or 0 <= other < j:
                at = m.end()
                continue
            end = j
        out.append((at, end + 1, m[1].lower()))
        at = end + 1
    return out


def test_tags_as_by_walking():
    import random
    r = random.Random(5)
    for _ in range(3000):
        page = "".join(r.choice(["<p", "<b ", "</p", ">", "\"", "'", "=", " ", "x", "a='", "=\"", "<", "/"]) for _ in range(r.randint(0, 25)))
        assert [t[:3] for t in h._tags(page)] == brute_tags(page), page


def pages(spark):
    return [(r.page_id, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]


def test_blocks_are_found_without_the_article_tag(spark):
    """The table's pages with article and main turned into div: the densities and neighbours find the same blocks."""
    right = wrong = missed = 0
    for _, page in pages(spark):
        want = Counter(filter(None, main_text(page).split("\n\n")))
        got = Counter(filter(None, main_text(re.sub(r"<(/?)(?:article|main)\b", r"<\1div", page or "")).split("\n\n")))
        both = sum((want & got).values())
        right, wrong, missed = right + both, wrong + sum(got.values()) - both, missed + sum(want.values()) - both
    assert right > 0.95 * (right + missed) and right > 0.95 * (right + wrong)


def test_first_pass_decides_by_density(monkeypatch):
    thin = "Widget gadget gizmo doodad thing contraption machine device apparatus tool instrument utensil appliance engine."
    page = f"<div><p>{PROSE}</p><p>{thin}</p><p>Short one.</p><p>{PROSE}</p><p><a href=x>{PROSE}</a></p></div>"
    blocks = h.blocks_of(page)
    h.decide(blocks)
    assert [b.label for b in blocks] == ["good", "bad", "", "good", "bad"]
    assert main_text(page) == f"{PROSE}\n\nShort one.\n\n{PROSE}"
    monkeypatch.setattr(h, "_stop_share", lambda _: 0.0)
    assert main_text(page) != f"{PROSE}\n\nShort one.\n\n{PROSE}", "without the density the result is another"
    monkeypatch.undo()
    assert main_text(f"<article><p>{PROSE}</p><p>{thin}</p></article>") == f"{PROSE}\n\n{thin}"
    assert main_text(f"<p>{thin}</p><p>Short.</p>") == f"{thin}\n\nShort.", "no running text anywhere"


def test_second_pass_takes_the_nearest_neighbour():
    links = f"<p><a href=x>{'Some other page ' * 8}</a></p>"
    assert main_text(f"<p>{PROSE}</p><p>near text</p><p>near links</p>{links}<p>near links</p>") == f"{PROSE}\n\nnear text"
    assert main_text(f"<nav>menu</nav><h1>Title</h1><p>{PROSE}</p><footer>end</footer><h2>Links</h2>{links}") == f"Title\n\n{PROSE}"


def test_quoted_values_of_any_length():
    long = "x > y " * 3000
    assert main_text(f'<article><p title="{long}">One</p><p data-a=\'{long}\'>Two</p></article>') == "One\n\nTwo"
    assert main_text("<article><p title=Bob's>One</p><p>Two's</p></article>") == "One\n\nTwo's"
    assert main_text('<article><p title="open>One</p><p>Two</p></article>') == "One\n\nTwo"


@pytest.mark.parametrize("name", sorted(h.SKIPPED))
def test_unclosed_elements_swallow_no_text(name):
    page = f"<article><p>One</p><{name} class=x><p>Two</p></article>"
    assert main_text(page) == ("One" if name in h.RAW else "One\n\nTwo")
    assert main_text(f"<article><p>One</p><{name}>gone <i>too</i></{name} ><p>Two</p></article>") == "One\n\nTwo"
    assert main_text(f"<article><p>One</p><{name}/><p>Two</p></article>") == "One\n\nTwo"


def test_nested_and_repeated_skipped_elements():
    assert main_text("<article><svg><svg>a</svg>b</svg><p>One</p></article>") == "One"
    assert main_text("<article><button>Go<p>One</p><button>Stop</button><p>Two</p></article>") == "Go\n\nOne\n\nTwo"
    assert main_text("<article><p>One</p><!-- <p>two</p> --><p>Three</p><!-- open <p>four</p></article>") == "One\n\nThree"


@pytest.mark.parametrize("piece", ["<a ", '<p "', "<p '", "<p a='", '<p a="', "<", "</", "<!--", "<button>", "<svg>", "<div>", "</section>", "<header><p>x",
                                   "<body>", "<p>", "&am", "<article>", '<p a=">" ', "<script", "<textarea>x</", "class   ", "<style>a</style>"])
def test_time_goes_with_length(piece):
    """Ten times the page takes some ten times as long, with and without a > at the end."""
    for end in ("", ">", "' > \"", "</p>x"):
        took = []
        for n in (30_000, 300_000):
            page = piece * (n // len(piece)) + end
            t = time.perf_counter()
            main_text(page)
            took.append(time.perf_counter() - t)
        assert took[1] < 25 * took[0] + 0.3
