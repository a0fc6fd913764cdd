"""Main text of pages: whole articles, the best region against brute force, broken markup."""

import random
import time
from collections import Counter
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from conftest import TABLES

from adlumen.llm import html_text


class Article(HTMLParser):
    """The text of the article by the standard library's parser, its blocks apart."""

    def __init__(self, html):
        super().__init__()
        self.inside, self.blocks = 0, [""]
        self.feed(html)
        self.close()
        self.text = " ".join(" ".join(b.split()) for b in self.blocks if b.strip())

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag not in html_text.INLINE:
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag not in html_text.INLINE:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


@pytest.fixture(scope="module")
def pages():
    return pq.read_table(f"{TABLES}/pages.parquet").column("html").to_pylist()


@pytest.fixture(scope="module")
def learned(pages):
    """The weights of the table, counted here without Spark."""
    counts, seen = Counter(), Counter()
    for page in pages:
        found = html_text.labelled_counts(page)
        counts.update(found)
        seen.update(feat for feat, _ in found)
    return html_text.Weights({f: (counts[f, True], counts[f, False]) for f in seen if seen[f] >= html_text.SEEN})


def test_every_article_of_the_table_comes_out_whole(pages, learned):
    for page in pages:
        assert html_text.main_text(page, learned) == Article(page).text


def test_best_region_against_all_regions():
    random.seed(5)
    for _ in range(400):
        scores = [random.randint(-4, 4) for _ in range(random.randint(0, 14))]
        regions = [(sum(scores[a:b]), -b, a, (a, b)) for b in range(len(scores) + 1) for a in range(b)]
        best = max(regions, default=(0,))
        assert html_text.best_region(scores) == (best[3] if best[0] > 0 else (0, 0))


def words(n, tag=None, stem="w"):
    return " ".join(f"<{tag}>{stem}{k}</{tag}>" if tag else f"{stem}{k}" for k in range(n))


NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav>"
P12 = f"<p>{words(12)}</p>"
WHOLE = {
    "linked words": f"<p>{words(40, 'a')}</p>",
    "words in spans": f"<p>{words(40, 'span')}</p>",
    "a long list of short items": f"<p>{words(10)}</p><ul>{words(40, 'li', 'item')}</ul>",
    "linked references at the end": f"{P12}<ol>{''.join(f'<li><a href=/r{k}>reference{k}</a></li>' for k in range(12))}</ol>",
    "linked names first": f"<ul>{''.join(f'<li><a href=/n{k}>name{k}</a></li>' for k in range(30))}</ul>{P12}",
    "a table of short cells first": f"<table>{''.join(f'<tr><td>a{k}</td><td>b{k}</td></tr>' for k in range(20))}</table>{P12}",
    "named lists and cells": f"{P12}<ul class=facts>{words(9, 'li')}</ul><table class=data><tr><td class=num>1</td></tr></table>",
    "a header of its own": f"<header><h2>Heading</h2><p class=byline>By one</p></header>{P12}",
    "a header by name": f"<div class=post-header><h2>Heading</h2></div>{P12}",
    "a quote in a bare value": f"<p data-x=it's>{words(9)}</p><p>{words(9, stem='v')}</p><p>it's</p>",
    "a quote that never ends": f"<p title=\"x>{words(9)}</p><p>{words(9, stem='v')}</p>",
    "in-line tags across blocks": f"<b><p>{words(9)}</b></p><p>{words(9)}</p>",
    "unknown elements": f"<x-body><x-part>{words(9)}</x-part><x-part>{words(9)}</x-part></x-body>",
}


@pytest.mark.parametrize("case", WHOLE)
@pytest.mark.parametrize("weights", ["learned", "meant"])
def test_nothing_of_the_article_is_lost(case, weights, learned):
    weights = learned if weights == "learned" else html_text.Weights({})
    article = f"<article><h1>The title</h1>{WHOLE[case]}</article>"
    page = f'<html><body>{NAV}<div class="ad">Buy this now</div>{article}<footer>All rights {words(6)}</footer></body></html>'
    plain = article.replace('title="x>', ">").replace("it's>", ">")
    assert html_text.main_text(page, weights) == Article(plain).text
    # A form around everything, as some servers write it.
    assert html_text.main_text(page.replace("<body>", "<body><form id=f>"), weights) == Article(plain).text


@pytest.mark.parametrize("part", [
    f"<form><p>{words(30)}</p><button>Send</button></form>", f"<aside>{words(30)}</aside>", f"<div class=commentlist><p>{words(50)}</p></div>",
    f"<section id=comments><article><p>{words(5)}</p></article></section>", f"<footer>{words(30)}</footer>", f"<noscript><p>{words(30)}</p></noscript>",
    f"<select>{words(30, 'option')}</select>", f"<svg><text>{words(30)}</text></svg>", f"<script>{words(30)}</script>", f"<div class='cookie-notice x'>{words(30)}</div>",
])
def test_parts_around_stay_out(part, learned):
    article = f"<article><h1>The title</h1>{P12}%s{P12}</article>"
    text = Article(article % "").text
    for weights in (learned, html_text.Weights({})):
        assert html_text.main_text(f"<body>{part}{article % ''}{part}</body>", weights) == text
        assert html_text.main_text(f"<body>{NAV}{article % part}</body>", weights) == text


@pytest.mark.parametrize("name", ["select", "button", "iframe", "video", "title", "textarea", "object"])
def test_what_is_never_closed_hides_nothing(name, learned):
    page = f"<body>{NAV}<div><{name}></div><article><h1>The title</h1><{name}>{P12}<p>end</p></article><footer>rights</footer>"
    assert html_text.main_text(page, learned) == f"The title {words(12)} end"


def test_pages_without_an_article(learned):
    content = f"<h1>The title</h1><p>{words(60)}</p><ul>{words(20, 'li')}</ul>"
    page = f"<body><div id=a>{NAV}</div><div id=b>{content}</div><div class=commentlist>{words(30)}</div><footer>rights</footer></body>"
    assert html_text.main_text(page, learned) == Article(f"<article>{content}</article>").text


def test_a_teaser_is_not_taken_for_the_content(learned):
    page = f"<body><div id=c><h1>The title</h1><p>{words(80)}</p></div><div id=s><article><p>read this too</p></article></div></body>"
    assert words(80) in html_text.main_text(page, learned)


@pytest.mark.parametrize("markup", [
    "<a b='", "<div>", "<title>", "</title ", "<article>x ", "<nav><article><h1>", "<!-- ", "<p class=ad>x</b>", "<li><ul>x", "<", "</p>", "<i class=ad><p>",
])
def test_broken_markup_takes_linear_time(markup, learned):
    page = markup * (1_000_000 // len(markup))
    start = time.process_time()
    html_text.main_text(page, learned)
    html_text.labelled_counts(page + "<article>x</article>")
    assert time.process_time() - start < 20
