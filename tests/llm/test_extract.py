import os
import re

import numpy as np
import pytest

from fieldcast.llm import extract as X

PAGES = "/root/testdata/sf0.01/pages.parquet"
LONG = "Some text of the page that is longer than any link, and it ends as texts do."
MORE = "A second text of the page, which says as much as the first one does, and ends."


def text(page, weights=X.PRIOR):
    return X.main_text(page, weights).split("\n")


@pytest.mark.parametrize("page, want", [
    (f'<article><p>{LONG}</p><p class="legal">{MORE}</p></article>', [LONG, MORE]),
    (f'<article><div class="header"><p>{LONG}</p></div><p class="tags alert">{MORE}</p></article>', [LONG, MORE]),
    (f'<div class="legal">{LONG}</div><article><p>{MORE}</p></article>', [MORE]),
    ("<article><p>The energy is <math><mi>E</mi><mo>=</mo><mi>mc2</mi><annotation>E=mc^2</annotation></math> in all cases.</p></article>",
     ["The energy is E=mc2 in all cases."]),
    (f"<article><p>See <object data=x>the chart of all years</object> here.</p><noscript><p>{LONG}</p></noscript>"
     "<canvas>A drawing of the house.</canvas></article>", ["See the chart of all years here.", LONG, "A drawing of the house."]),
    (f'<article><p>{LONG}</p><h3>3 Comments</h3><div><p>{MORE}</p></div></article>', [LONG]),
    (f"<div><p>{LONG}</p><p>{MORE}</p></div><div><h2>Comments (12)</h2><div><p>I do not agree with any word of this, it is all wrong.</p></div></div>",
     [LONG, MORE]),
    (f"<div>Home | News | About</div><div><p>{LONG}</p><p>{MORE}</p></div><div>Copyright 2024 Some Firm</div>", [LONG, MORE]),
    (f"<article><p>{LONG} Copyright law is old.</p></article>", [f"{LONG} Copyright law is old."]),
    (f"<p>{LONG}</p><div><a href=x><b><i><u><s><em>Go there now and then</em></s></u></i></b></a></div>", [LONG]),
])
def test_nothing_else_is_dropped_or_kept(page, want):
    assert text(page) == want


@pytest.mark.parametrize("depth", [3, 600, 30_000])
def test_depth_changes_nothing(depth):
    page = f'<article>{"<div>" * depth}<p>{LONG}</p><div class="ad">{MORE}</div>{"</div>" * depth}<p>{MORE}</p></article>'
    assert text(page) == [LONG, MORE]
    assert text(f"<article><p>{LONG}{'<b>' * depth} it goes on {'<p>x</p>' * 50}</article>")[0] == f"{LONG} it goes on"


def test_the_cut_decides_where_the_classifier_errs():
    """A short block between two paragraphs of its parent; the same block among links stays out."""
    page = f"<div><p>{LONG}</p><div>Yes</div><p>{MORE}</p></div>"
    blocks = X.blocks_of(page)
    lean = X.page_features(blocks) @ X.PRIOR
    assert (lean > 0).tolist() == [True, False, True]
    assert X.minimum_cut(lean, X.ties(blocks)).tolist() == [True, True, True]
    links = "<ul><li><a href=a>One</a></li></ul><div>Yes</div><ul><li><a href=b>Two</a></li></ul>"
    assert text(f"{links}<article><p>{LONG}</p></article>") == [LONG]


def bare(page):
    page = re.sub(r"<(/?)(article|nav|footer|header|main|aside)\b[^>]*>", r"<\1div>", page)
    return re.sub(r' class="[^"]*"', "", page)


@pytest.mark.skipif(not os.path.exists(PAGES), reason="no table of pages here")
def test_pages_without_landmarks(spark):
    """Fitted on the landmarks of some pages, measured on others whose landmarks are taken away."""
    table = spark.read.parquet(PAGES)
    weights = X.fit(table.where("page_id % 2 = 0"))
    right = wrong = hit = false = missed = 0
    for page in (r["html"] for r in table.where("page_id % 2 = 1").select("html").collect()):
        truth = [X.weak_label(b) for b in X.blocks_of(page)]
        blocks = X.blocks_of(bare(page))
        assert len(blocks) == len(truth)
        lean = X.page_features(blocks) @ weights
        for y, label, alone in zip(truth, X.minimum_cut(lean, X.ties(blocks)), lean > 0):
            right, wrong = right + (label != alone and label == y), wrong + (label != alone and label != y)
            hit, false, missed = hit + (label and y == 1), false + (label and y == 0), missed + (not label and y == 1)
    assert 2 * hit / (2 * hit + false + missed) > 0.93
    assert right > 2 * wrong  # where the cut overrules the classifier, it is right


@pytest.mark.skipif(not os.path.exists(PAGES), reason="no table of pages here")
def test_pages_with_landmarks_follow_them(spark):
    table = spark.read.parquet(PAGES)
    got = {r["page_id"]: r["text"] for r in X.extracted(table).collect()}
    for r in table.collect():
        assert got[r["page_id"]] == "\n".join(b.text for b in X.blocks_of(r["html"]) if X.weak_label(b) == 1)
    assert np.isfinite(X.PRIOR).all() and len(X.PRIOR) == len(X.FEATURES)
