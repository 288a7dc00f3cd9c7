"""Labelled pages for the extraction model, made from a seed.

A page is a list of (html, label) parts with furniture around and inside an
article; every leaf block's label follows from the part it was put into, so no
page of a table has to be labelled by hand.  Names of classes and ids are ones
that sites commonly give such parts.
"""

from __future__ import annotations

import random

#: Common names of page parts.
ARTICLE = ("article", "post", "content", "entry", "entry-content", "post-body", "main-content", "story", "article-body", "text", "body")
FURNITURE = {
    "nav": ("nav", "menu", "navbar", "breadcrumb", "breadcrumbs", "navigation", "topnav", "tabs", "pagination", "pager", "skip", "toc"),
    "header": ("header", "masthead", "site-header", "topbar", "branding", "logo", "banner", "search"),
    "footer": ("footer", "site-footer", "bottom", "copyright", "legal", "colophon", "credits"),
    "aside": ("sidebar", "side", "widget", "related", "recommended", "popular", "trending", "rail", "more", "tags", "tagcloud", "teaser"),
    "notice": ("cookie", "cookie-banner", "consent", "notice", "gdpr", "alert", "popup", "modal", "overlay", "paywall", "privacy", "cookies", "toast"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor", "banner-ad", "adbox", "promotion", "affiliate"),
    "form": ("newsletter", "subscribe", "signup", "login", "search-form", "contact-form", "form"),
    "comment": ("comment", "comments", "comment-list", "discussion", "replies", "reply", "respond", "disqus", "reader-comments", "comment-body"),
    "share": ("share", "social", "sharing", "follow", "share-buttons", "byline-share", "social-links"),
}
_SYLLABLES = ("er", "an", "th", "on", "re", "la", "ci", "sch", "ou", "in", "ment", "tion", "es", "de", "al", "é", "ung", "the", "of", "and", "to", "que")


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join("".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high)))


def _prose(rng: random.Random) -> str:
    out = [(_words(rng, 1, 25) + rng.choice((".", ".", ".", "!", "?", ",", ""))).capitalize() for _ in range(rng.choice((1, 1, 2, 3, 6)))]
    text = " ".join(out)
    if rng.random() < 0.1:  # symbols, capitals and bars also stand in articles
        text = rng.choice((" | ".join(text.split()), text.upper(), "*** ".join(text.split()), text + " &amp; &copy; " + _words(rng, 1, 3)))
    if rng.random() < 0.15:
        text = text.replace(" ", f' <a href="/{_words(rng, 1, 1)}">{_words(rng, 1, 3)}</a> ', 1)
    return text


def _attribute(rng: random.Random, names) -> str:
    name = rng.choice(names)
    if rng.random() < 0.3:
        name += " " + rng.choice(("x", "col-8", "clearfix", "wide", "js", "block", "container"))
    return f'{rng.choice(("class", "class", "id"))}="{name}"' if rng.random() < 0.9 else f'role="{name}"'


def _furniture(rng: random.Random, kind: str) -> str:
    tags = {"nav": ("nav", "div", "ul"), "header": ("header", "div"), "footer": ("footer", "div"), "aside": ("aside", "div", "section"),
            "form": ("form", "div"), "comment": ("section", "div", "ol", "article"), "share": ("div", "ul"), "ad": ("div", "aside", "ins"),
            "notice": ("div", "section", "dialog")}[kind]
    tag = rng.choice(tags)
    plain = tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5
    attribute = "" if plain else " " + _attribute(rng, FURNITURE[kind])
    n = rng.randint(1, 6)
    link = lambda: f'<a href="/{_words(rng, 1, 1)}">{_words(rng, 1, 3)}</a>'
    if kind in ("nav", "share") or kind in ("aside", "footer", "header") and rng.random() < 0.5:
        items = "".join(f"<li>{link()}</li>" for _ in range(n))
        inner = items if tag in ("ul", "ol") else f"<ul>{items}</ul>" if rng.random() < 0.7 else " | ".join(link() for _ in range(n))
    elif kind == "form":
        inner = f"<label>{_words(rng, 1, 4)}</label><input type=text><p>{_prose(rng)}</p><button>{_words(rng, 1, 2)}</button>"
    elif kind == "comment":
        item = "li" if tag == "ol" else "div"
        inner = rng.choice(("", f"<h3>{_words(rng, 1, 4)}</h3>")) + "".join(
            f'<{item} {_attribute(rng, FURNITURE["comment"])}><b>{_words(rng, 1, 2)}</b><p>{_prose(rng)}</p></{item}>' for _ in range(n))
    elif kind == "footer":
        inner = f"&copy; {_words(rng, 1, 3)} &middot; {_prose(rng)}"
    else:
        inner = rng.choice(("", f"<h4>{_words(rng, 1, 4)}</h4>")) + rng.choice((_prose(rng), f"<p>{_prose(rng)}</p>" * rng.randint(1, 3)))
    return f"<{tag}{attribute}>{inner}</{tag}>"


def _article(rng: random.Random) -> str:
    parts = [f"<h1>{_words(rng, 2, 9)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 14)):
        roll = rng.random()
        if roll < 0.62:
            parts.append(f"<p>{_prose(rng)}</p>")
        elif roll < 0.68:
            parts.append(f"<p><b>{_prose(rng)}<br>")  # tags left open
        elif roll < 0.74:
            parts.append(f"<{(h := rng.choice(('h2', 'h3')))}>{_words(rng, 1, 7)}</{h}>")
        elif roll < 0.80:
            parts.append("<ul>" + "".join(f"<li>{_prose(rng)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
        elif roll < 0.84:
            parts.append(f"<blockquote><p>{_prose(rng)}</p></blockquote>")
        elif roll < 0.88:
            parts.append(f"<table><tr><td>{_words(rng, 1, 4)}</td><td>{_words(rng, 1, 4)}</td></tr></table>")
        elif roll < 0.90:
            parts.append(f"<figure><img src=x><figcaption>{_prose(rng)}</figcaption></figure>")
        elif roll < 0.92:
            parts.append(f"<pre>{_words(rng, 3, 20)}</pre>")
        else:
            parts.append("\0" + _furniture(rng, rng.choice(("ad", "aside", "share", "form", "notice", "comment"))))
    if rng.random() < 0.3:
        parts.append("\0" + _furniture(rng, rng.choice(("comment", "share", "aside"))))
    inner = "".join(f"<!--L0-->{p[1:]}<!--L1-->" if p[0] == "\0" else p for p in parts)
    roll = rng.random()
    if roll < 0.45:
        attribute = f" {_attribute(rng, ARTICLE)}" if rng.random() < 0.4 else ""
        return f"<article{attribute}>{inner}</article>"
    if roll < 0.6:
        return f"<main>{inner}</main>"
    return f"<{(t := rng.choice(('div', 'section')))} {_attribute(rng, ARTICLE)}>{inner}</{t}>"


def page(rng: random.Random) -> str:
    """A page's html; comments <!--L1--> and <!--L0--> switch the label of what follows."""
    above = [k for k in ("notice", "header", "nav", "ad") if rng.random() < 0.5]
    below = [k for k in ("aside", "comment", "ad", "form", "footer", "notice") if rng.random() < 0.4]
    body = "".join(_furniture(rng, k) for k in above) + "<!--L1-->" + _article(rng) + "<!--L0-->" + "".join(_furniture(rng, k) for k in below)
    if rng.random() < 0.3:
        body = f'<div class="{rng.choice(("container", "wrapper", "page", "layout", "row"))}">{body}</div>'
    end = "" if rng.random() < 0.1 else "</body></html>"
    return f"<!DOCTYPE html><html><head><title>{_words(rng, 1, 6)}</title><style>p{{}}</style></head><body>{body}{end}"
