"""Main text of web pages by a linear-chain CRF over leaf blocks (operator 2).

A page becomes its sequence of leaf blocks: the text between two block-level
tags.  A block's features are its ancestors' tags and name parts (class, id,
role) at any depth, and marks of its text: length, share of links, punctuation.  The chain
has two labels, main text or not, with weights for features and for steps
between neighbours; it is trained on labelled pages that ``html_pages`` makes
from a seed, and pages are decoded by Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import html_pages
from lakemart.llm.textblocks import map_batches

#: Labelled pages made for training, and passes over them.
PAGES, EPOCHS = 700, 6

# An attribute as HTML's tokenizer reads it: a quote opens a value behind "=" alone, elsewhere it is part of a name.
_VALUE = r"""\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+"""
# What is left open at the page's end goes on to it, so each character is read once.
_TOKEN = re.compile(r"<!--(?:-?>|(.*?)(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/(?![a-zA-Z]|\Z))[^>]*+(?:>|\Z)"
                    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>"'][^\s>]*+))?+)?+""")
_NAMING = frozenset(("class", "id", "role"))
_SPACE = re.compile(r"[ \t\n\r\f\v   -     　\u0085]+")
#: Contents of these elements are no text of the page.  Raw ones have no tags inside and, left open, go on to the
#: page's end; the others hold tags, and left open they end with their parent or at a block's tag.
_RAW = frozenset("script style textarea title iframe".split())
_HIDDEN = frozenset("noscript template svg object audio video canvas select datalist".split())
_ANY_HIDDEN = re.compile(rf"<(?:{'|'.join(sorted(_HIDDEN))})(?=[\s/>])", re.I)
_NOSCRIPT = re.compile(r"<(/?)noscript(?=[\s/>])[^>]*+(?:>|\Z)", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for t in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(("address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer "
                    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
                    "summary table tbody td tfoot th thead tr ul caption").split())
#: An opening tag ends these when they are open: tags by the ones they close, and where the search stops.
_ENDS = {"li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
         "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"})}
_SCOPE = frozenset("table td th button article section div main aside nav header footer form ul ol body blockquote".split())


class Open:
    """An open element: its tag, the names no element above it has, the nearest block's tag, and its parent."""

    __slots__ = ("tag", "names", "block", "up")

    def __init__(self, tag, names, block, up):
        self.tag, self.names, self.block, self.up = tag, names, block, up


class Leaf:
    """A leaf block: its text, the innermost open element, the characters in links, and a training label."""

    __slots__ = ("text", "inside", "tag", "linked", "label")

    def __init__(self, text, inside, tag, linked, label):
        self.text, self.inside, self.tag, self.linked, self.label = text, inside, tag, linked, label

    @property
    def names(self) -> set[str]:
        """The names of all ancestors, however deep."""
        out, e = set(), self.inside
        while e is not None:
            out.update(e.names)
            e = e.up
        return out


def _open_names(tag: str, attributes: str) -> tuple[str, ...]:
    names = ["<" + tag]
    if attributes and "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            if m[1].lower() not in _NAMING:
                continue
            value = (m[2] or m[3] or m[4] or "").lower()
            names += ["." + w for w in re.split(r"[^a-z0-9]+", value) if w]
            names += ["." + w for w in value.split() if not w.isalnum()]
    return tuple(names)


class Places:
    """Where the open elements of each tag stand in a stack, so that none has to be looked for along it."""

    def __init__(self):
        self._of: dict[str, list[int]] = {}

    def push(self, tag: str, at: int) -> None:
        self._of.setdefault(tag, []).append(at)

    def pop(self, tag: str) -> None:
        self._of[tag].pop()

    def last(self, tag: str) -> int:
        """The innermost open element of the tag, -1 if there is none."""
        own = self._of.get(tag)
        return own[-1] if own else -1

    def innermost(self, tags) -> int:
        return max(map(self.last, tags))


def _hidden_ends(page: str) -> dict[int, int]:
    """Where each hidden element that has an end tag of its own ends, by its start; the others were left open."""
    found: dict[int, int] = {}
    if not _ANY_HIDDEN.search(page):
        return found
    stack: list[tuple[str, int]] = []
    places, walls, at = Places(), [], 0  # walls: blocks that an inline end tag doesn't reach beyond

    def cut(i):
        for t, _ in reversed(stack[i:]):
            places.pop(t)
            if t in _BLOCK and t != "option":
                walls.pop()
        del stack[i:]

    while m := _TOKEN.search(page, at):
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:
            i = places.last(tag)
            if i < 0 or (tag not in _BLOCK and tag not in _HIDDEN and walls and walls[-1] > i):
                continue
            if tag in _HIDDEN:
                found[stack[i][1]] = at
            cut(i)
        elif m[4].endswith("/") or tag in _VOID:
            continue
        elif tag in _RAW and places.last("svg") < 0:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag == "noscript" and (end := _NOSCRIPT.search(page, at)) and end[1]:
            at = found[m.start()] = end.end()
        else:
            places.push(tag, len(stack))
            if tag in _BLOCK and tag != "option":
                walls.append(len(stack))
            stack.append((tag, m.start()))
    return found


def leaves(page: str) -> list[Leaf]:
    """The page's leaf blocks with text, in order."""
    out: list[Leaf] = []
    stack: list[Open] = []
    held: set[str] = set()  # the names of all open elements
    run: list[str] = []
    linked, label, at = 0, 0, 0
    places, walls = Places(), []
    ends, muted = _hidden_ends(page), None  # muted: the place in the stack of a hidden element that was left open

    def close_block():
        nonlocal linked
        if run:
            text = _SPACE.sub(" ", "".join(run)).strip(" ")
            if text:
                inside = stack[-1] if stack else None
                out.append(Leaf(text, inside, inside.block if inside else "", min(linked, len(text)), label))
            run.clear()
        linked = 0

    def add(raw):
        nonlocal linked
        if raw and muted is None:
            text = html.unescape(raw) if "&" in raw else raw
            run.append(text)
            if "<a" in held:
                linked += len(text)

    def push(tag, names):
        up = stack[-1] if stack else None
        own = [*dict.fromkeys(n for n in names if n not in held)]
        held.update(own)
        places.push(tag, len(stack))
        if tag in _BLOCK:
            walls.append(len(stack))
        stack.append(Open(tag, own, tag if tag in _BLOCK else up.block if up else "", up))

    def cut(i):
        nonlocal muted
        if muted is not None and i <= muted:
            muted = None
        for e in reversed(stack[i:]):
            held.difference_update(e.names)
            places.pop(e.tag)
            if e.tag in _BLOCK:
                walls.pop()
        del stack[i:]

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1] in ("L0", "L1"):
                close_block()
                label = int(m[1] == "L1")
            continue
        tag = tag.lower()
        if muted is not None and tag in _BLOCK and not (tag == "option" and stack[muted].tag in ("select", "datalist")):
            cut(muted)
        if m[2]:
            if tag in _BLOCK and muted is None:
                close_block()
            i = places.last(tag)
            if i >= 0 and (tag in _BLOCK or not walls or walls[-1] < i):
                cut(i)
            continue
        if tag in _RAW and not m[4].endswith("/") and "<svg" not in held:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _HIDDEN and not m[4].endswith("/"):
            if m.start() in ends:
                at = ends[m.start()]
                continue
            if muted is None:
                muted = len(stack)
        elif muted is not None and tag in _BLOCK:
            continue  # an option of a list
        elif tag in _BLOCK:
            close_block()
            closes, stop = _ENDS.get(tag, ({"p"}, _SCOPE))
            while (i := places.innermost(closes)) >= 0 and i >= places.innermost(stop):
                cut(i)
        elif tag in ("br", "wbr"):
            run.append(" " if tag == "br" else "")
        if tag not in _VOID and not m[4].endswith("/"):
            push(tag, _open_names(tag, m[4]))
    close_block()
    return out


def describe(blocks: list[Leaf]) -> list[list[str]]:
    """Names of each block's features."""
    return [[*b.names, *own] for b, own in zip(blocks, marks(blocks))]


def marks(blocks: list[Leaf]) -> list[list[str]]:
    """Names of each block's features beside its ancestors' names."""
    out = []
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        share = b.linked / len(b.text)
        out.append(["tag=" + b.tag, f"words={min(6, words.bit_length())}", f"links={0 if not b.linked else 1 if share < 0.5 else 2}",
                    "end=" + ("." if b.text[-1] in ".!?…:;\"'”»)" else "-"), "bar" if "|" in b.text else "no-bar",
                    "©" if b.text[0] == "©" else "no-©", "first" if i == 0 else "last" if i == len(blocks) - 1 else "within", "bias"])
    return out


class Chain:
    """Two-label linear chain: weights of features for label 1 and of steps between labels."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.steps = np.zeros((2, 2))
        self._squares: dict[str, float] = {}
        self._step_squares = np.zeros((2, 2))

    def scores(self, features: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in fs]) for fs in features]

    def inherited(self, blocks: list[Leaf]) -> list[float]:
        """Summed weights of each block's ancestor names; each element's sum is taken once, so depth costs no more."""
        get, out = self.weights.get, []
        sums: dict[Open | None, float] = {None: 0.0}
        for b in blocks:
            path, e = [], b.inside
            while e not in sums:
                path.append(e)
                e = e.up
            total = sums[e]
            for e in reversed(path):
                total = sums[e] = total + sum([get(n, 0.0) for n in e.names])
            out.append(total)
        return out

    def learn(self, features: list[list[str]], labels: list[int], rate: float = 0.3, decay: float = 1e-5) -> None:
        """One step up the log-likelihood of a page's labels (forward-backward)."""
        n, s = len(labels), self.scores(features)
        local = np.stack([np.zeros(n), np.array(s)], axis=1)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = local[0]
        for i in range(1, n):
            forward[i] = local[i] + np.logaddexp(forward[i - 1, 0] + self.steps[0], forward[i - 1, 1] + self.steps[1])
        for i in range(n - 2, -1, -1):
            nxt = local[i + 1] + backward[i + 1]
            backward[i] = np.logaddexp(self.steps[:, 0] + nxt[0], self.steps[:, 1] + nxt[1])
        total = np.logaddexp(*forward[-1])
        one = np.exp(forward[:, 1] + backward[:, 1] - total)
        pull = np.array(labels) - one
        for fs, g in zip(features, pull.tolist()):
            for f in fs:
                w = self.weights.get(f, 0.0)
                q = self._squares[f] = self._squares.get(f, 1e-3) + g * g
                self.weights[f] = w + rate * (g - decay * w) / q ** 0.5
        if n > 1:
            pairs = np.exp(forward[:-1, :, None] + self.steps + (local[1:] + backward[1:])[:, None, :] - total).sum(axis=0)
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            g = seen - pairs
            self._step_squares += g * g
            self.steps += 0.1 * g / np.sqrt(self._step_squares + 1e-3)

    def decode(self, features: list[list[str]], inherited: list[float] | None = None) -> list[int]:
        """The likeliest labels (Viterbi); ties go to 0.  Scores of features left out can be given beside them."""
        if not features:
            return []
        scores = self.scores(features)
        if inherited is not None:
            scores = [a + b for a, b in zip(scores, inherited)]
        (a, b), (c, d) = self.steps.tolist()
        zero, one, back = 0.0, 0.0, []
        for i, s in enumerate(scores):
            if i == 0:
                zero, one = 0.0, s
                continue
            to0, to1 = one + c > zero + a, one + d > zero + b
            back.append((to0, to1))
            zero, one = (one + c if to0 else zero + a), (one + d if to1 else zero + b) + s
        label, out = int(one > zero), []
        for step in reversed(back):
            out.append(label)
            label = int(step[label])
        return [*reversed([*out, label])]


@lru_cache(maxsize=1)
def model(pages: int = PAGES, epochs: int = EPOCHS) -> Chain:
    """The chain trained on labelled pages (the same for the same numbers)."""
    rng, chain = random.Random(11), Chain()
    made = []
    for _ in range(pages):
        blocks = leaves(html_pages.page(rng))
        if blocks:
            made.append((describe(blocks), [b.label for b in blocks]))
    for _ in range(epochs):
        rng.shuffle(made)
        for features, labels in made:
            chain.learn(features, labels)
    return chain


def main_text(page: str, chain: Chain) -> str:
    blocks = leaves(page)
    labels = chain.decode(marks(blocks), chain.inherited(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, labels) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``.

    Nulls: a null html has the empty text; null ids and urls are carried
    along.  Repeated rows give a row each; other columns are left aside; an
    empty table gives no rows; a page without main text has the empty text.
    Pages are read whole, and broken markup is read as far as it goes.  What is
    in scripts, styles, titles, text areas, frames, noscript, templates, svg,
    media and lists of options is no text; formulas (math) are.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model())

    def rows(batch):
        chain = sent.value
        texts = [main_text(h, chain) if h else "" for h in batch.column("html").to_pylist()]
        yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    return map_batches(own, rows, "page_id long, url string, text string, n_chars long")
