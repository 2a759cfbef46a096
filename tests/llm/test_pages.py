"""Main text of pages: ratios, smoothing and threshold against plain versions, boxes without telling names."""

import math
import random

import numpy as np

from cardproof.llm import html_extract
from cardproof.llm.html_extract import ASIDE, main_text

LONG = "A paragraph of some length that tells the story of the page in plain words, as most of them do. " * 2
PAGE = f"""<html><body><nav><a href=1>One</a> <a href=2>Two</a></nav><article><h1>A title of the page</h1>
<div class="x1"><span>By</span> <a href=j><b>Jane</b></a> <i>3</i> <i>May</i> <b>2</b> <i>min</i></div>
<p>{LONG}</p><p>Short one.</p><p>{LONG}</p>
<div class="k9"><b>Get</b> <i>our</i> <a href=p>paper</a> <b>now</b> <u>and</u> <b>here</b> <img src=x></div>
<div><ul><li><a href=a>First other story of the day</a></li><li><a href=b>Second other story of the day</a></li></ul></div>
<p>{LONG}</p></article><footer>{LONG}</footer></body></html>"""


def plain_smoothed(values, regions):
    out = []
    for i, value in enumerate(values):
        top = bottom = 0.0
        for step in range(-html_extract.RADIUS, html_extract.RADIUS + 1):
            j = i + step
            if 0 <= j < len(values) and len(set(regions[min(i, j) : max(i, j) + 1])) == 1:
                weight = math.exp(-step * step / (2 * html_extract.SIGMA**2))
                top, bottom = top + weight * values[j], bottom + weight
        out.append(top / bottom)
    return out


def plain_threshold(values):
    border = sum(values) / len(values)
    for _ in range(20):
        high, low = [v for v in values if v >= border], [v for v in values if v < border]
        if not high or not low:
            break
        border = (sum(high) / len(high) + sum(low) / len(low)) / 2
    return min(border, max(values))


def test_ratios_smoothing_and_threshold_match_plain_versions():
    draw = random.Random(8)
    for _ in range(200):
        n = draw.randint(1, 30)
        regions = sorted(draw.choices([ASIDE, 1, 2, 3], k=n)) if draw.random() < 0.5 else draw.choices([ASIDE, 1, 2], k=n)
        blocks = []
        for region in regions:
            size = draw.randint(1, 300)
            linked = draw.choice([0, 0, size, draw.randint(0, size)])
            blocks.append(("x" * size, linked, draw.randint(0, 6), region, region == 2 and draw.random() < 0.5))
        marked = any(b[4] for b in blocks)
        held = [b[3] != ASIDE and (b[4] or not marked) for b in blocks]
        links_count = all(len(b[0]) == b[1] for b, h in zip(blocks, held) if h)
        want = [
            math.log(1 + (len(b[0]) - (0 if links_count else b[1])) / max(b[2], 1)) if h else 0.0 for b, h in zip(blocks, held)
        ]
        got = html_extract.ratios(blocks)
        np.testing.assert_allclose(got, want, rtol=1e-12)
        values = html_extract.smoothed(got, np.array(regions))
        np.testing.assert_allclose(values, plain_smoothed(want, regions), rtol=1e-9, atol=2e-9)
        assert math.isclose(html_extract.threshold(values), plain_threshold(list(values)), rel_tol=1e-9, abs_tol=1e-8)


def test_boxes_inside_an_article_go_without_telling_names():
    paragraph = LONG.strip()
    assert main_text(PAGE) == f"A title of the page\n{paragraph}\nShort one.\n{paragraph}\n{paragraph}"


def test_the_ratio_decides(monkeypatch):
    real = main_text(PAGE)
    monkeypatch.setattr(html_extract, "smoothed", lambda values, regions: np.ones(len(values)))
    flat = main_text(PAGE)
    assert flat != real and "Jane" in flat and "paper" in flat and "other story" in flat and flat.endswith(LONG.strip())


def test_lists_tables_and_linked_text_stay():
    page = f"<article><p>{LONG}</p><ul><li>Flour of wheat</li><li>Eggs and butter</li></ul><p>{LONG}</p></article>"
    assert "Flour of wheat\nEggs and butter" in main_text(page)
    assert main_text(f"<main><a href=x><p>{LONG}</p></a></main>") == LONG.strip()
    assert main_text("<nav>One Two</nav>") == "" and main_text("<p></p>") == ""


def test_many_unclosed_elements_are_read_in_one_pass():
    page = "<article>" + "<b>x " * 60_000 + "</i>" * 60_000 + "</b>" * 60_000 + "</article>"
    assert main_text(page).count("x") == 60_000
