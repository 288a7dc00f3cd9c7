"""Personal data: candidates, boosted trees, calibrated thresholds (operator 1).

Base spans follow fixed formats and always count.  Beside them, generators of
high recall propose further spans (spelled-out or spaced addresses, local
telephone numbers, cards with other separators), which may overlap.  Boosted
trees score each from its format and the text around it; a score is turned
into a redaction where held-out examples of its kind were right at least 98
times in 100.  Of overlapping accepted spans the best score stays.

The trees are trained on a fixed number of labelled examples that are made
here from a seed; no row of any table is used for training.
"""

from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.textblocks import map_batches

KINDS = ("email", "ip", "card", "phone")
#: Labelled examples made for training, and the precision asked of each kind.
EXAMPLES, PRECISION = 6000, 0.98

_SIGN = re.compile(r"[0-9@]")  # in every span of the fixed formats
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ to both sides so that long words cost no retries."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", max(free, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed formats, by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


_GENERATORS = (
    ("email", re.compile(r"(?<![\w.+-])[\w.+-]{1,64}+ ?(?:\[at\]|\(at\)|\{at\}|@| at ) ?[\w-]{1,64}+"
                         r"(?: ?(?:\[dot\]|\(dot\)|\{dot\}|\.| dot ) ?[\w-]{2,64}+)+")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|\[dot\]|\.) ?[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ .\-/_]?[0-9]){12,18}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])(?:\+|00)?\(?[0-9]{2,5}\)?(?:[ .\-/]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9])")),
)
_CUES = {"email": ("mail", "contact", "write", "reach", "correo"), "ip": ("ip", "host", "server", "address", "login"),
         "card": ("card", "visa", "credit", "payment", "karte", "tarjeta"),
         "phone": ("phone", "tel", "call", "fax", "mobile", "whatsapp", "cell"),
         "other": ("version", "order", "invoice", "isbn", "id", "ref", "price", "page", "date", "serial", "release", "build",
                   "section", "total", "token", "chapter", "sku")}


#: What every match of a kind's generator has in it.
_NEEDS = {kind: re.compile(r"@|[\[({]at[\])}]| at " if kind == "email" else "[0-9]") for kind in KINDS}


def candidates(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in _GENERATORS:
        if _NEEDS[kind].search(text):
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context features of a candidate."""
    span, digits = text[start:end], _digits(text[start:end])
    before, after = text[max(0, start - 24):start].lower(), text[end:end + 12].lower()
    words = re.findall(r"[a-z]+", before)[-3:]
    parts = [len(p) for p in re.findall(r"[0-9]+", span)]
    numbers = [int(p) for p in re.findall(r"[0-9]{1,9}", span)]
    cue = [float(any(w.startswith(c) for w in words for c in _CUES[k])) for k in (kind, "other")]
    dots = span.count(".") + span.lower().count("dot")
    return [
        float(KINDS.index(kind)), len(span), len(digits), len(parts), max(parts, default=0), min(parts, default=0),
        float(parts[-1]) if parts else 0.0, float(parts[0]) if parts else 0.0, float(max(numbers, default=0) <= 255),
        float(13 <= len(digits) <= 19 and luhn(digits)), float(span[0] == "+"), float("(" in span), float("@" in span),
        float("at]" in span or "at)" in span or "at}" in span), float(" at " in span), dots, span.count(" "), span.count("-"),
        span.count("/"), float(len({c for c in span if c in " .-/_"})), float(bool(parts) and parts[:-1] == [4] * (len(parts) - 1)),
        *cue, float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before.rstrip()[-1:] == ":"),
        float(before.rstrip()[-1:] in "$€£#="), float(bool(numbers) and 1800 <= numbers[0] <= 2100 and parts[0] == 4),
        float(bool(re.fullmatch(r"[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}", span))),
        sum(c.isalpha() for c in span) / len(span), float(span[0] == "0"),
    ]


# --- labelled examples -------------------------------------------------------

def _example(rng: random.Random) -> tuple[str, str, int, int, int]:
    """(text, kind, start, end, label) of one example."""
    word = lambda: "".join(rng.choice(("er", "an", "th", "on", "re", "la", "ci", "sch", "ou", "in")) for _ in range(rng.randint(1, 4)))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    kind, label = rng.choice(KINDS), rng.random() < 0.5
    cue = ""
    if kind == "email":
        if label:
            at, dot = rng.choice(((" [at] ", "[dot]"), ("[at]", "."), (" (at) ", " (dot) "), ("(at)", "."), (" @ ", "."), (" at ", " dot ")))
            span = word() + at + word() + dot + rng.choice(("com", "org", "net", "de", "es"))
            cue = rng.choice(("", "mail ", "contact: ", "write to ", ""))
        else:
            span = rng.choice((f"{word()} at {word()}.{word()}", f"{word()} at {word()}. {word()}", f"{word()}@{word()} .{word()}",
                               f"{word()} at {word()} . {word()}"))
    elif kind == "ip":
        if label:
            sep = rng.choice(("[.]", "(.)", " . ", "[dot]", "[.]"))
            span = sep.join(str(rng.randint(0, 255)) for _ in range(4))
            cue = rng.choice(("", "host ", "ip: ", "server "))
        else:
            span = rng.choice((". ".join(num(rng.randint(1, 3)) for _ in range(4)), ".".join(str(rng.randint(256, 999)) for _ in range(4))))
            cue = rng.choice(("", "section ", "version ", ""))
    elif kind == "card":
        groups = rng.choice(((4, 4, 4, 4), (4, 6, 5), (16,), (4, 4, 4, 3), (4, 4, 4, 4, 3)))
        digits = num(sum(groups))
        if label:
            digits = next(d for d in (digits[:-1] + str(c) for c in range(10)) if luhn(d))
            sep, cue = rng.choice((".", "/", "_", ".")), rng.choice(("card ", "visa: ", "", ""))
        else:
            while luhn(digits):
                digits = num(sum(groups))
            sep, cue = rng.choice(("", " ", "-", ".")), rng.choice(("", "order ", "serial ", "id: ", "= "))
        at, pieces = 0, []
        for g in groups:
            pieces.append(digits[at:at + g])
            at += g
        span = sep.join(pieces)
    else:
        if label:
            span = rng.choice((f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"0{num(3)} {num(3)} {num(4)}",
                               f"00{num(2)} {num(3)} {num(3)} {num(3)}", f"{num(3)}.{num(3)}.{num(4)}", f"0{num(3)}/{num(4)}-{num(2)}"))
            cue = rng.choice(("tel ", "phone: ", "call ", "mobile ", "fax: "))
        else:
            span = rng.choice((f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{num(2)}/{num(2)}/{num(4)}",
                               f"{num(3)} {num(3)}", f"978-{num(2)}-{num(5)}-{num(3)}", f"{num(4)} {num(4)} {num(4)} {num(4)}", f"{num(2)}.{num(2)}",
                               f"{num(3)} {num(3)} {num(3)}", f"{num(5)}-{num(4)}"))
            cue = rng.choice(("", "isbn ", "page ", "price $", "order ", "ref: ", "total "))
    left = " ".join(word() for _ in range(rng.randint(0, 4)))
    text = (left + " " if left else "") + cue
    start = len(text)
    return text + span + rng.choice((" ", ". ", ", ", "")) + word(), kind, start, start + len(span), int(label)


class Trees:
    """Boosted trees of depth 3 for logistic loss over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2):
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 17)[1:-1])) for c in x.T]
        self.trees, self.rate = [], rate
        binned, total = self._bin(x), np.zeros(len(y))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-total))
            tree = self._grow(binned, y - p, p * (1 - p), np.arange(len(y)), 3)
            self.trees.append(tree)
            total += rate * self._walk(tree, binned)

    def _bin(self, x):
        return np.stack([np.searchsorted(c, v, "right") for c, v in zip(self.cuts, x.T)], axis=1)

    def _grow(self, b, g, h, at, depth):
        best = (1e-6, None)
        value = g[at].sum() / (h[at].sum() + 1.0)
        if depth and len(at) > 20:
            base = g[at].sum() ** 2 / (h[at].sum() + 1.0)
            for f in range(b.shape[1]):
                n = len(self.cuts[f]) + 1
                gs, hs = np.cumsum(np.bincount(b[at, f], g[at], n))[:-1], np.cumsum(np.bincount(b[at, f], h[at], n))[:-1]
                if len(gs):
                    gain = gs ** 2 / (hs + 1) + (g[at].sum() - gs) ** 2 / (h[at].sum() - hs + 1) - base
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], (f, k))
        if best[1] is None:
            return value
        f, k = best[1]
        low = b[at, f] <= k
        return f, k, self._grow(b, g, h, at[low], depth - 1), self._grow(b, g, h, at[~low], depth - 1)

    def _walk(self, node, b):
        if not isinstance(node, tuple):
            return np.full(len(b), node)
        f, k, low, high = node
        return np.where(b[:, f] <= k, self._walk(low, b), self._walk(high, b))

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        return 1 / (1 + np.exp(-self.rate * sum(self._walk(t, b) for t in self.trees)))


@lru_cache(maxsize=1)
def model(examples: int = EXAMPLES, precision: float = PRECISION) -> tuple[Trees, dict[str, float]]:
    """The trees, and each kind's threshold from the third of the examples that is held out."""
    rng = random.Random(7)
    made = [_example(rng) for _ in range(examples)]
    x = np.array([describe(t, k, a, b) for t, k, a, b, _ in made])
    y = np.array([e[-1] for e in made], float)
    test = np.arange(examples) % 3 == 0
    trees = Trees(x[~test], y[~test])
    score, limits = trees.predict(x[test]), {}
    for i, kind in enumerate(KINDS):
        own = x[test][:, 0] == i
        order = np.argsort(-score[own], kind="stable")
        right = np.cumsum(y[test][own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= precision)
        limits[kind] = max(0.5, float(score[own][order][good[-1]])) if len(good) else 2.0
    return trees, limits


def _name(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted) for each row of ``docs``.

    spans: base and added ones as kind:start:end (code points, end exclusive);
    redacted: the text with each span replaced by its kind.  Nulls: a null text
    counts as empty; a row without id is searched all the same.  Repeated rows
    give a row each; other columns are left aside; an empty table gives no
    rows.  Texts are taken whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model())

    def rows(batch):
        trees, limits = sent.value
        texts = [t or "" for t in batch.column("text").to_pylist()]
        base = [base_spans(t) if _SIGN.search(t) else [] for t in texts]
        offered = []
        for i, t in enumerate(texts):
            taken = sorted((a, b) for _, a, b in base[i])
            for kind, a, b in candidates(t):
                if all(b <= lo or a >= hi for lo, hi in taken):
                    offered.append((i, kind, a, b))
        spans = [list(b) for b in base]
        if offered:
            score = trees.predict(np.array([describe(texts[i], k, a, b) for i, k, a, b in offered]))
            for at in sorted(range(len(offered)), key=lambda j: (-score[j], offered[j][0], offered[j][2])):
                i, kind, a, b = offered[at]
                if score[at] >= limits[kind] and all(b <= lo or a >= hi for _, lo, hi in spans[i]):
                    spans[i].append((kind, a, b))
        counts = {f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in KINDS}
        yield {"doc_id": batch.column("doc_id"), **counts,
               "base_sha256": [hashlib.sha256(_name(b).encode()).hexdigest() for b in base],
               "spans": [_name(s) for s in spans], "redacted": [_redact(t, s) for t, s in zip(texts, spans)]}

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(texts, rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                    "base_sha256 string, spans string, redacted string")


def _redact(text: str, spans) -> str:
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b > at:
            out += [text[at:max(a, at)], f"[{kind}]" if a >= at else ""]
            at = b
    return "".join([*out, text[at:]])
