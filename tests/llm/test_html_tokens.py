"""Tags and attributes as HTML's tokenizer reads them, against Python's own parser; Viterbi against all labelings."""

import itertools
import random
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from lakemart.llm import html_pages, html_text


def _read(page):
    return [b.text for b in html_text.leaves(page)]


def test_quotes_open_a_value_behind_an_equals_sign_alone():
    assert _read("<article><p data-x=it's>One.</p><p>It's two.</p><p>Three.</p></article>") == ["One.", "It's two.", "Three."]
    assert _read('<p>a<img alt="5" screen">b</p><p>c</p>') == ["ab", "c"]
    assert _read("<p>a<a \"b' href=x>c</a></p><p>d</p>") == ["ac", "d"]
    assert _read("<p x='a>b' y=\"c>d\" z=e>f</p>") == ["f"]
    assert _read("<p = 'a'>b</p><p =x>c</p><p x= y>d</p><p x = 'z'>e</p>") == ["b", "c", "d", "e"]


def test_what_is_left_open_is_no_text():
    assert _read('<p>a</p><p title="b>One.') == ["a"]
    assert _read("<p>a</p><p title='b") == ["a"] and _read("<p>a</p><div") == ["a"] and _read("<p>a</p></div") == ["a"]
    assert _read("<p>a</p><!doctype") == ["a"] and _read("<p>a</p><?php echo 1; ") == ["a"]
    assert _read("<p>1 < 2 and 3 <4</p>") == ["1 < 2 and 3 <4"] and _read("<p>a</ b>c</>d</p>") == ["acd"]


def test_ends_of_comments():
    assert _read("<p>a<!-- x --!>b</p><p>c</p>") == ["ab", "c"]
    assert _read("<p>a<!-->b<!--->c<!-- -- > --->d</p>") == ["abcd"]
    assert _read("<p>a</p><!-- b") == ["a"]


@pytest.mark.parametrize("part", ["<font>", '<a "', "<b><div>", "<div", "<!--", "<p x='", "<script>", "<noscript>", "<svg>", "</script ",
                                  "<button><p>", "<li><ul>", "&amp", "<i></b>"])
def test_time_grows_with_the_page(part):
    chain = html_text.Chain()
    page = part * ((1 << 20) // len(part))
    start = time.process_time()
    html_text.main_text(page, chain)
    html_text.main_text("<p><button>" + part * (100_000 // len(part)) + "<h1>x</h1></b>" * 10_000, chain)
    assert time.process_time() - start < 20


class _Plain(HTMLParser):
    """All text outside elements that hold none, without white space."""

    HIDDEN = {*html_text._RAW, *html_text._HIDDEN}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.text = [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.inside.append(tag)

    def handle_endtag(self, tag):
        if tag in self.inside:
            del self.inside[self.inside.index(tag):]

    def handle_data(self, data):
        if not self.inside:
            self.text.append("".join(data.split()))


def test_leaves_hold_all_text_of_made_pages():
    rng = random.Random(4)
    for _ in range(150):
        page = html_pages.page(rng)
        plain = _Plain()
        plain.feed(page)
        plain.close()
        assert "".join("".join(t.split()) for t in _read(page)) == "".join(plain.text)


def test_viterbi_matches_all_labelings():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 7):
        for _ in range(30):
            chain = html_text.Chain()
            chain.steps = rng.normal(size=(2, 2))
            features = [[f"f{i}", f"g{i % 2}"] for i in range(n)]
            chain.weights = {f: float(rng.normal()) for fs in features for f in fs}
            more = rng.normal(size=n).tolist()

            def score(labels):
                s = sum((chain.scores([features[i]])[0] + more[i]) * y for i, y in enumerate(labels))
                return s + sum(chain.steps[a, b] for a, b in zip(labels[:-1], labels[1:], strict=True))

            assert chain.decode(features, more) == list(max(itertools.product((0, 1), repeat=n), key=score))
