"""The text operators against plain Python on small tables, with their edge cases."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest
import tiktoken

from lakemart.llm import (bpe, decontaminate, html_text, license_scan, line_dedup, ngram_join, pii, quality_model,
                          quality_rules, warc)
from lakemart.llm.queries import tokenizer

LOWER = {c: c + 32 for c in range(65, 91)}
SPACE = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, n long, key string, set_id string, row int"


def _docs(spark, rows):
    """Rows (id, text) with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, t, 1, "k", "s", 0) for i, t in rows], DOCS)


def _edge_rows(seed=5):
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha beta gamma delta the of É漢 x1 END.".split())
    rows = []
    for i in range(60):
        base = "\n".join(" ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6)))
        rows.append((i, base))
        if i % 3 == 0:
            w = base.split(" ")
            w[rng.randrange(len(w))] = "changed"
            rows.append((100 + i, " ".join(w)))
        if i % 7 == 0:
            rows.append((200 + i, base))
    long = " ".join(f"w{rng.randint(0, 900)}" for _ in range(30_000))
    return rows + [(300, ""), (301, None), (302, " \n\t "), (303, "one"), (304, "one two"), (305, "One TWO"), (306, long),
                   (307, long + " tail"), (None, "one two"), (0, rows[0][1])]


def test_ngram_join_matches_all_pairs(spark):
    rows = _edge_rows()
    for k, num, den in ((3, 90, 100), (5, 80, 100), (2, 60, 100)):
        def shingles(t):
            w = re.findall(SPACE, (t or "").translate(LOWER))
            return frozenset(zip(*[w[i:] for i in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])
        sets = [(i, shingles(t)) for i, t in rows]
        parent = list(range(len(sets)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for x in range(len(sets)):
            for y in range(x):
                a, b = sets[x][1], sets[y][1]
                if a and b and sets[x][0] is not None and sets[y][0] is not None and den * len(a & b) >= num * len(a | b):
                    parent[root(x)] = root(y)
        least = {}
        for x, (i, _) in enumerate(sets):
            if i is not None:
                least[root(x)] = min(i, least.get(root(x), i))
        want = sorted(((i, len(s), least.get(root(x)) if i is not None else None) for x, (i, s) in enumerate(sets)), key=str)
        got = ngram_join.ngram_components(_docs(spark, rows), k=k, threshold=(num, den)).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_ngram_join_blocks_and_full_keys_give_the_same(spark, monkeypatch):
    rows = _edge_rows(8)
    one = sorted(map(tuple, ngram_join.ngram_components(_docs(spark, rows)).collect()), key=str)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 2)
    monkeypatch.setattr(ngram_join, "FULL_KEY", 1)
    assert sorted(map(tuple, ngram_join.ngram_components(_docs(spark, rows)).collect()), key=str) == one


def test_ngram_join_second_pass_finds_what_block_0_misses(spark, monkeypatch):
    """Two chains that link only nearby; a document between them shares keys but links with neither."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i:i + 100])) for i in range(40)]
    rows += [(100 + i, " ".join(words[200 + i:300 + i])) for i in range(15)]
    rows += [(200, " ".join(words[10:50] + ["x"] * 10 + words[60:110])), (201, " ".join(words[20:120]))]
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 2)
    monkeypatch.setattr(ngram_join, "FULL_KEY", 1)
    met = []
    first = ngram_join._tree_joins
    monkeypatch.setattr(ngram_join, "_tree_joins", lambda *a: met.append(first(*a)) or met[-1])
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(_docs(spark, rows)).collect()}
    assert got == {i: 0 if i < 40 or i == 201 else 200 if i == 200 else 100 for i, _ in rows}
    assert met[1].count() > 0


def test_prefix_tree_links_equal_brute_force():
    rng = np.random.default_rng(3)
    t = ngram_join.Threshold(80, 100)
    base = [np.unique(rng.integers(0, 400, 60)) for _ in range(6)]
    sets = [np.unique(np.concatenate([rng.choice(b, len(b) - d, replace=False), rng.integers(0, 400, d)]))
            for b in base for d in (0, 2, 5, 8, 12)]
    tree, marks = ngram_join.PrefixTree(sets, t), np.zeros(500, bool)
    for i, p in enumerate(sets):
        want = {j for j, s in enumerate(sets) if 100 * len(np.intersect1d(p, s)) >= 80 * len(np.union1d(p, s))}
        assert set(tree.linked(p, marks).tolist()) == want


def _runs_removed(rows, min_words):
    """Lines by (id, number) of runs of min_words that stand earlier (brute force over all runs)."""
    lines = {i: [(n, x) for n, x in enumerate(t.split("\n")) if re.search(SPACE, x)] for i, t in rows}
    places = collections.defaultdict(list)
    for i, ls in lines.items():
        for a in range(len(ls)):
            words = 0
            for b in range(a, len(ls)):
                words += len(re.findall(SPACE, ls[b][1]))
                if words >= min_words:
                    places[tuple(x for _, x in ls[a:b + 1])].append((i, a, b))
    return {(i, lines[i][x][0]) for at in places.values() for i, a, b in sorted(at)[1:] for x in range(a, b + 1)}


def test_line_dedup_matches_all_runs(spark):
    rng = random.Random(2)
    pool = [" ".join(f"p{i}w{j}" for j in range(rng.randint(1, 12))) for i in range(12)]
    rows = [(i, "\n".join(rng.choice([*pool, "", " "]) for _ in range(rng.randint(1, 14)))) for i in range(50)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(_docs(spark, rows), min_words=15).collect()}
    gone = _runs_removed(rows, 15)
    assert gone
    for i, t in rows:
        kept, follows = [], False
        for n, x in enumerate(t.split("\n")):
            out = (i, n) in gone
            follows = out or (follows and not x.strip())
            if not follows:
                kept.append(x)
        assert got[i] == "\n".join(kept)


def test_line_dedup_edges(spark):
    text = " ".join(["word"] * 60)
    rows = [(1, text), (2, "a b\n" + text + "\nc d"), (None, text), (3, None), (4, ""), (2, "other")]
    out = line_dedup.dedup_lines(_docs(spark, rows))
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in out.collect()), key=str)
    assert got == sorted([(1, text, 0), (2, "a b\nc d", 1), (None, text, 0), (3, None, 0), (4, "", 0), (2, "other", 0)], key=str)
    assert {"n", "key", "set_id", "row"} <= set(out.columns)


def test_decontamination_matches_every_window(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(n))
    items = [(i, prose(rng.randint(8, 50))) for i in range(20)] + [(20, "short one"), (21, None), (None, "x y z"), (3, None)]
    rows = []
    for i in range(60):
        w = prose(80).split()
        if i % 2:
            leak = items[i % 20][1].split()
            for _ in range(i % 5):
                leak[rng.randrange(len(leak))] = "edit"
            w[30:30] = [x.upper() + "," for x in leak]
        rows.append((i, "\n".join([" ".join(w[:40]), " ".join(w[40:])])))
    rows += [(100, None), (101, ""), (102, "Short, one!"), (None, items[0][1])]
    words = lambda t: re.findall(r"[0-9a-z\x80-\xff]+", t.translate(LOWER).encode().decode("latin-1"))

    def bag(w, k):
        return collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    want = set()
    for d, t in rows:
        dw = words(t or "")
        for i, it in items:
            iw = words(it or "")
            if i is None or not iw or not dw:
                continue
            k = min(5, len(iw))
            n, b, best = min(len(iw), len(dw)), bag(iw, k), 0
            for s in range(len(dw) - n + 1):
                c = bag(dw[s:s + n], k)
                w = lambda g: sum(map(len, g))
                both = sum(w(g) * min(c[g], b[g]) for g in c)
                union = sum(w(g) * x for g, x in c.items()) + sum(w(g) * x for g, x in b.items()) - both
                best = max(best, both / union if union else 0)
            if best >= 0.8:
                want.add((d, i, round(best, 9)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (5000, 7):
        got = decontaminate.contaminated(_docs(spark, rows), bench, item_block=block).collect()
        assert {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in got} == want
    assert (102, 20, 1.0) in want and len(want) >= 8


def test_rows_of_one_id_go_by_their_own_text(spark):
    rng = random.Random(12)
    text = lambda: " ".join(f"w{rng.randint(0, 5000)}" for _ in range(60))
    a, b, c, item = text(), text(), text(), text()
    rows = [(3, b), (5, a), (5, b), (7, a), (9, c), (9, a), (None, a), (None, None), (5, None), (5, "")]
    got = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(_docs(spark, rows)).collect()), key=str)
    assert got == sorted([(3, b), (5, a), (9, c), (None, a), (None, None), (5, None), (5, "")], key=str)
    rows = [(1, a), (1, "lead " + item), (2, b), (None, c), (None, item + " tail"), (4, None), (None, None)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in decontaminate.drop_contaminated(_docs(spark, rows), bench).collect()), key=str)
    assert got == sorted([(1, a), (2, b), (None, c), (4, None), (None, None)], key=str)


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    sized = decontaminate.Sized(9, 5)
    sized.ids, sized.prints = list(range(300)), list(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    sized.close()
    probes = sized.prints ^ (np.uint64(1) << rng.integers(0, 64, (18, 300)).astype(np.uint64)).sum(axis=0, dtype=np.uint64)
    window, item = sized.near(probes)
    found = set(zip(window.tolist(), item.tolist()))
    for i in range(300):
        for j in range(300):
            assert ((i, j) in found) == (bin(int(probes[i] ^ sized.prints[j])).count("1") <= decontaminate.RADIUS)


def test_quality_rules_counts(spark):
    rows = _edge_rows() + [(400, "a | b | c | d"), (401, "\n".join(["good line of words here."] * 30 + ["x | y | z | w"] * 2)), (402, "AB CD*** #1\r\nAB")]
    got = sorted((tuple(r) for r in quality_rules.judge(_docs(spark, rows)).collect()), key=str)
    want = []
    for i, t in rows:
        t = t or ""
        w = re.findall(SPACE, t)
        seen, dup = set(), 0
        for x in t.split("\n"):
            if re.search(SPACE, x):
                dup += x in seen
                seen.add(x)
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        cover = {p + d for p in range(len(w) - 2) if tri[tuple(w[p:p + 3])] > 1 for d in range(3)}
        want.append((i, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(cover),
                     len(w) < 50 or 100 * len(cover) > 50 * len(w)))
    assert [g[:7] for g in got] == [w for w in sorted(want, key=lambda w: str(next(g for g in got if g[:7] == w)))]


def test_quality_rules_lines_and_labels(spark, sf001):
    fine = " ".join(f"word{i}," for i in range(60)) + " end."
    rows = [(1, fine), (2, fine + "\nHome | News | Sport | Contact"), (3, fine + "\n" + " | ".join(f"x{i}" for i in range(50)))]
    got = {r.doc_id: r.text for r in quality_rules.clean(_docs(spark, rows)).collect()}
    assert got == {1: fine, 2: fine}
    docs, labels = (spark.read.parquet(f"{sf001}/{t}.parquet") for t in ("documents", "labels"))
    both = quality_rules.judge(docs).join(labels, "doc_id").collect()
    assert all(r.kept or r.base_failed for r in both if r.quality == 1)
    assert not any(r.kept for r in both if r.quality == 0)


def test_quality_rules_marks_of_other_scripts(spark):
    prose = {"hi": ("यह एक लंबा वाक्य है", "।"), "ar": ("هذه جملة طويلة جدا هنا", "،"), "ur": ("یہ ایک لمبا جملہ ہے", "۔"), "fa": ("آیا این جمله بلند است", "؟"),
             "am": ("ይህ ረጅም ዓረፍተ ነገር ነው", "።"), "hy": ("սա երկար նախադասություն է այստեղ", "։"), "ko": ("이것은 긴 문장 입니다 여기", "。"), "my": ("ဒါက ရှည်လျားတဲ့ ဝါကျ တစ်ခု ဖြစ်တယ်", "။"),
             "km": ("នេះ ជា ប្រយោគ វែង មួយ", "។"), "bo": ("འདི ནི ཚིག རིང་པོ ཡིན", "།"), "zh": ("这 是 一个 长 句子", "，"), "en": ("and so it went on", "…"), "chakma": ("a b c d e", "\U00011141")}
    lines = [(i, lang, " ".join([words] * 3 + [words + mark])) for i, (lang, (words, mark)) in enumerate(sorted(prose.items()))]
    rows = [(i, "\n".join(t + f" {n}" for n in range(6))) for i, _, t in lines] + [(100 + i, t.replace(prose[lang][1], "")) for i, lang, t in lines]
    got = {r.doc_id: (r.n_bad_lines, r.lost_words) for r in quality_rules.judge(_docs(spark, rows)).collect()}
    assert {lang: got[i] for i, lang, _ in lines} == {lang: (0, 0) for _, lang, _ in lines}
    assert all(got[100 + i][0] == 1 for i, _, _ in lines)  # without the mark the line still fails
    # a mark counts for its own line only, also where lines and texts are neighbours
    bare = " ".join(["wörter"] * 20)
    near = [(1, bare + "\n" + bare + "।\n" + bare), (2, "।"), (3, bare), (4, "")]
    assert {r.doc_id: r.n_bad_lines for r in quality_rules.judge(_docs(spark, near)).collect()} == {1: 2, 2: 0, 3: 1, 4: 0}
    kept = " ".join(f"शब्द{i}" for i in range(30)) + " अंत।\n" + " ".join(f"बात{i}" for i in range(30)) + " अंत।"
    assert [r.text for r in quality_rules.clean(_docs(spark, [(1, kept)])).collect()] == [kept]


def test_quality_model_held_out_accuracy(spark, sf01):
    docs, labels = (spark.read.parquet(f"{sf01}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_model.score(docs, quality_model.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    edge = quality_model.score(_docs(spark, [(None, "a"), (1, None), (1, "")]), quality_model.train(docs.limit(0), labels)).collect()
    assert [r.score for r in edge] == [0.5] * 3


def test_bpe_equals_the_library(spark):
    data, pattern = tokenizer()
    ranks = bpe.read_ranks(data)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    own, rng = bpe.Encoder(ranks, pattern), random.Random(3)
    parts = [" ", "  ", "\n", "\n\n", "\t", "'s", "'re", "a", "thethe", "é", "漢字", "12", "3", "!!", "\xa0", "😀", "_", "Zx", "\r\n", "\x00", "don't", "<|endoftext|>"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert own.encode(t) == np.array(library.encode_ordinary(t), "<u4").tobytes()
        assert own.decode(own.encode(t)) == t.encode()
    rows = _edge_rows()
    got = bpe.encode_documents(_docs(spark, rows), data, pattern).collect()
    for r, (_, t) in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)), sorted(rows, key=lambda x: (str(x[0]), len(library.encode_ordinary(x[1] or ""))))):
        assert r.ids == library.encode_ordinary(t or "")
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_append_and_replace():
    ranks = bpe.read_ranks(tokenizer()[0])
    v, rng = bpe.Vocabulary(ranks), random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("thering ou") for _ in range(rng.randint(1, 20))).encode() for _ in range(2))
        assert bpe.Prefixes(v, a).append(b).ids() == bpe.Prefixes(bpe.Vocabulary(ranks) if rng.random() < 0.02 else v, a + b).ids() == v.merge(a + b)
        lo, hi = sorted((rng.randint(0, len(a)), rng.randint(0, len(a))))
        assert bpe.Prefixes(v, a).replace(lo, hi, b).ids() == v.merge(a[:lo] + b + a[hi:])


def test_pii_base_equals_the_patterns(spark):
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    rng = random.Random(6)
    parts = ["a", "@", ".", "b.c", "4111 1111 1111 1111", "1.2.3.4", "+49 (30) 123-4567", " ", "-", "9", "256.1.1.1", "é", "x@y.z", "+", "\n", "%", "000001.2.3.4"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))) for i in range(1500)]
    rows += [(2000, None), (2001, "a" * 50_000 + "@" * 3), (2002, "1" * 50_000), (None, "me@host.org")]
    for r, (_, t) in zip(sorted(pii.find_spans(_docs(spark, rows)).collect(), key=lambda r: str(r.doc_id)), sorted(rows, key=lambda x: str(x[0]))):
        base = []
        for kind, pattern in kinds:
            for m in re.finditer(pattern, (t or "")[:2000] if r.doc_id in (2001, 2002) else t or ""):
                digits = re.sub("[^0-9]", "", m.group())
                if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                        or kind == "card" and 13 <= len(digits) <= 19 and pii.luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                    base.append(f"{kind}:{m.start()}:{m.end()}")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_pii_added_spans():
    trees, limits = pii.model()
    for text, kind, span in (("please mail anna [at] example [dot] org now", "email", "anna [at] example [dot] org"), ("call (555) 123-4567 now", "phone", "(555) 123-4567")):
        a = text.index(span)
        assert trees.predict(np.array([pii.describe(text, kind, a, a + len(span))]))[0] >= limits[kind]


def test_pii_spans_need_no_digit(spark):
    forms = [(a, d) for a in ("[at]", "(at)", "{at}", " [at] ", " {at} ", " at ", " @ ") for d in ("[dot]", "(dot)", "{dot}", " [dot] ", " {dot} ", " dot ", ".")]
    texts = [f"please mail anna{at}example{dot}org, we answer every letter that comes in from anywhere" for at, dot in forms]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " within 3 days") for i, t in enumerate(texts)]
    got = {r.doc_id: r.spans for r in pii.find_spans(_docs(spark, rows)).collect()}
    assert [t for i, t in enumerate(texts) if got[i] != got[100 + i]] == []
    assert got[forms.index((" {at} ", " {dot} "))] == "email:12:39"
    pattern = dict(pii._GENERATORS)["email"]
    assert all(pattern.search(t) and pii.candidates(t) for t in texts)


def test_html_text(spark, sf001):
    import html as H
    page = ("<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=/x>Menu</a></li></ul></nav>"
            "<div class=\"cookie-banner\">We use cookies.</div><article><h1>Title &amp; more</h1><p>First\n  line,&nbsp;with <b>bold</b> text.<p>Second one."
            "</article><div id=comments><p>Nice post!</p></div><footer>&copy; x</footer>")
    rows = [(1, "u", page), (2, None, None), (None, "u", ""), (3, "u", "<p"), (4, "u", "<footer>&copy; a</footer>")]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "Title & more\nFirst line, with bold text.\nSecond one." and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[None].text == got[4].text == ""
    pages = spark.read.parquet(f"{sf001}/pages.parquet")
    out = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(H.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:h1|p)>", inner))
        assert out[r.page_id] == "\n".join(x for x in parts if x)


def test_html_text_names_of_all_ancestors():
    chain = html_text.model()
    deep = "".join(f"<ul><li><div><p>Reply {i}, a comment that some reader wrote here.</p>" for i in range(30))
    text = "The first paragraph of the story, which is told in whole sentences."
    page = f"<article><p>{text}</p></article><section class=comments>{deep}{'</div></li></ul>' * 30}</section>"
    assert all({"<section", ".comments"} <= b.names for b in html_text.leaves(page)[1:])
    assert html_text.main_text(page, chain) == text
    inner = "<article><h1>Title</h1>" + "<div>" * 40 + f"<p>{text}</p>" + "</div>" * 40 + "</article>"
    for b in html_text.leaves(inner):
        assert "<article" in b.names and not b.names & {".comments"}
    assert html_text.main_text(f"<nav><a href=/>Home</a></nav>{inner}<footer>&copy; x</footer>", chain) == f"Title\n{text}"
    blocks = html_text.leaves(page)
    assert chain.decode(html_text.describe(blocks)) == chain.decode(html_text.marks(blocks), chain.inherited(blocks))
    wide = "".join(f"<div class=u{i}>word {i}" for i in range(20_000))  # names in all 20,000 squared / 2
    assert len(html_text.leaves(wide)) == 20_000 and len(html_text.main_text(wide, chain)) >= 0


@pytest.mark.parametrize("tag", "svg noscript select video audio canvas object template datalist".split())
def test_html_text_elements_left_open(tag):
    read = lambda page: [b.text for b in html_text.leaves(page)]
    story = "<article><p>One.</p><p>Two.</p></article>"
    inside = "<option>a<option>b" if tag in ("select", "datalist") else "not shown <i>nor this</i>"
    for before, after in ((f"<div><{tag} class=x>{inside}", "</div>"), (f"<div><{tag}>{inside}</div>", ""), (f"<a href=/><{tag}>{inside}</a>", "")):
        assert read(f"<body>{before}{story}{after}</body>") == ["One.", "Two."]
        # a later element of the kind has its own end tag
        assert read(f"<body>{before}{story}{after}<p>x<{tag}>{inside}</{tag}>y</p>") == ["One.", "Two.", "xy"]
    assert read(f"<p>a<{tag}>{inside}</{tag}>b <b><{tag}>{inside}</b> c") == ["ab c"]
    assert read(f"<div>a<{tag}>z<{tag}>{inside}</{tag}>{story}</div>") == ["a", "One.", "Two."]
    assert read(f"<div><{tag}><p>Fallback</p><div>more</div></{tag}>shown</div>") == ["shown"]
    many = f"<div><{tag}>" * 5_000 + story
    assert read(many) == ["One.", "Two."]


def test_html_text_raw_elements_and_formulas():
    read = lambda page: [b.text for b in html_text.leaves(page)]
    for tag in ("script", "style", "textarea", "title"):
        assert read(f"<p>a<{tag}><p>no</p></{tag}>b</p><p>c<{tag}>d</p><p>e") == ["ab", "c"]
    assert read("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p>") == ["So x=1 holds."]
    assert read("<svg><title>Icon<path d=x></svg><p>Text</p><svg><title>t</title></svg><svg><style>a{}<p>Last") == ["Text", "Last"]
    assert read("<noscript><iframe src=x></noscript><p>Text</p><iframe>i</iframe>") == ["Text"]
    assert read("<!-- <svg> --><script>'<svg>'</script><p>Text</p>") == ["Text"]


def test_warc_round_trip(spark, tmp_path):
    rows = [(5, "u5", "same é"), (3, "u3", "same é"), (9, None, None), (2, "a b", ""), (7, "u", "x" * 100_000), (None, "n", "same é"),
            (None, "n", "alone"), (3, "u3", "same é"), (11, "u", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name, least in (("a", 0), ("b", 3)):
        files = warc.write_warc(pages, str(tmp_path / name), file_bytes=300, min_bytes=least)
        assert files.count() > 1 and files.agg({"records": "sum"}).first()[0] == len(rows)
        back = warc.read_warc(spark, str(tmp_path / name)).collect()
        digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
        assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in back) == sorted((str(i), len((t or "").encode()), digest(t)) for i, _, t in rows)
        kinds = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in back)
        assert kinds[(3, "response", None)] == 1 and kinds[(3, "revisit", 3)] == 1 and kinds[(5, "revisit", 3)] == 1 and kinds[(None, "revisit", 3)] == 1
        assert kinds[(9, "revisit", 2)] == (least == 0) and kinds[(9, "response", None)] == (least > 0)
        assert {r.payload.decode() for r in back if r.record_type == "response"} >= {"same é", "x" * 100_000, "alone", "other", ""}
    assert [r.sha256 for r in warc.write_warc(pages, str(tmp_path / "c"), 300).sort("file").collect()] == \
        [r.sha256 for r in spark.read.parquet(str(tmp_path / "a/manifest")).sort("file").collect()]


def test_license_scan(spark):
    rows = _edge_rows() + [(400, "Licensed under CC BY-NC 4.0. All  rights, reserved!"), (401, "General Public License general public license"),
                           (402, "Released, under THE mit license"), (403, "released under mit license"), (404, "cc by")]
    got = license_scan.scan(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        at = [(p, label) for q, label in license_scan.PHRASES for p in range(len(w)) if w[p:p + len(q.split())] == q.split()]
        want.append((i, len(w), len(at), min((p for p, _ in at), default=None), max((p for p, _ in at), default=None), ",".join(sorted({x for _, x in at}))))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    by = {r.doc_id: r for r in got}
    assert by[400].labels == "cc-by,cc-by-nc,reserved" and by[402].labels == "mit" and by[402].score == 1.0 and by[300].score == 0.0


@pytest.mark.parametrize("run", [
    ngram_join.ngram_components, line_dedup.dedup_lines, quality_rules.judge, quality_rules.clean, pii.find_spans, license_scan.scan,
    lambda d: bpe.encode_documents(d, *tokenizer()), lambda d: quality_model.score(d, np.zeros(quality_model.SLOTS + 1))])
def test_empty_tables(spark, run):
    assert run(_docs(spark, [])).collect() == []


def test_pipeline_keeps_clean_documents(spark, sf001):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    cur = docs
    for _, stage in P.STAGES[:-1]:
        cur = spark.createDataFrame(stage(spark, cur, sf001).collect(), docs.schema)
        assert cur.columns == docs.columns
    leaks = {r.doc_id for r in decontaminate.contaminated(cur, spark.read.parquet(f"{sf001}/benchmark.parquet")).collect()}
    assert not leaks and {r.doc_id for r in P.run(spark, sf001).collect()} == {r.doc_id for r in cur.collect()}


CLASHING = "doc_id long, text string, __id long, __mark long, n_lines long, n_removed long, `row` string, mark long, bad long, `a.b` string"


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Stage functions on documents with columns named like their own, without n_chars, with nulls and repeated rows."""
    import corpus_pipeline as pipeline

    rng = random.Random(12)
    prose = lambda n: " ".join(rng.choice("alpha, beta gamma. delta the of É漢 x1 end.".split()) + str(rng.randint(0, 400)) for _ in range(n))
    run = "\n".join(prose(20) for _ in range(4))
    texts = [(i, prose(80)) for i in range(30)]
    texts += [(40, f"{prose(60)}\n{run}"), (41, f"{prose(60)}\n{run}\n{prose(70)}"), (42, None), (43, ""), (None, prose(90)), (None, prose(90))]
    texts += [texts[3]] * 3 + [(50, texts[4][1])]
    item = texts[9][1]
    spark.createDataFrame([(1, item, "x")], "item_id long, text string, __id string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, t, 7, 8, 77, 78, "r", 9, 10, "dot") for i, t in texts], CLASHING).repartition(3)
    for name, stage in pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert {tuple(r)[2:] for r in rows} == {(7, 8, 77, 78, "r", 9, 10, "dot")}, name
        assert stage(spark, docs.where("false"), str(tmp_path)).collect() == [], name
    kept = {r.doc_id for r in pipeline.rules(spark, docs, "").collect()}
    assert kept == {i for i, t in texts if t and len(t.split()) >= 50}
    lines = {r.doc_id: r.text for r in pipeline.lines(spark, docs, "").collect()}
    assert lines[42] is None and lines[43] == "" and run not in lines[41] and run in lines[40]
    near = [r.doc_id for r in pipeline.near_duplicates(spark, docs, "").collect()]
    assert 50 not in near and near.count(3) == 4 and near.count(None) == 2 and 42 in near
    clean = [r.doc_id for r in pipeline.decontamination(spark, docs, str(tmp_path)).collect()]
    assert 9 not in clean and len(clean) == len(texts) - 1
    assert pipeline.encoding(spark, docs, "").count() == len(texts)


def test_repeated_rows_lose_the_same_lines(spark):
    run = "\n".join(f"line {i} of twelve words that stand here again and again, ok." for i in range(6))
    rows = [(1, run)] + [(2, f"{run}\nown words")] * 200
    got = line_dedup.dedup_lines(_docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.text, r.n_removed) for r in got) == [(1, run, 0)] + [(2, "own words", 6)] * 200


def test_bpe_memories_are_bounded_and_emptied():
    data, pattern = tokenizer()
    encoder = bpe.Encoder(bpe.read_ranks(data), pattern)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 30))) for _ in range(3000)]
    text = " ".join(words)
    want = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(data), special_tokens={}).encode_ordinary(text)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
    assert 0 < encoder._bytes <= bpe.WORDS_BYTES
    encoder.forget()
    assert not encoder and not encoder._older and not encoder.vocabulary.heads and not encoder.vocabulary._apart
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_bpe_memories_renew_themselves(monkeypatch):
    data, pattern = tokenizer()
    monkeypatch.setattr(bpe, "WORDS_BYTES", 4000)
    monkeypatch.setattr(bpe, "HEADS_BYTES", 4000)
    monkeypatch.setattr(bpe, "APART_BYTES", 4000)
    encoder = bpe.Encoder(bpe.read_ranks(data), pattern)
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdeé.") for _ in range(rng.randint(1, 12))) for _ in range(2000))
    want = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(data), special_tokens={}).encode_ordinary(text)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
    assert encoder._bytes <= 4000 and len(encoder.vocabulary._apart) <= 4000 // 100


def test_routing_keys_meet_for_every_linked_pair():
    """Also with many ranges, empty ones, and sets whose shingles crowd into a few of them."""
    rng = np.random.default_rng(9)
    for num, den in ((90, 100), (80, 100), (50, 100)):
        t = ngram_join.Threshold(num, den)
        for trial in range(300):
            n = int(rng.choice([1, 2, 5, 12, 40, 150, 700]))
            width = int(rng.choice([64, 64, 40, 52]))  # narrow ones fill few ranges
            base = np.unique(rng.integers(0, 1 << 63, n * 2, dtype=np.uint64) >> np.uint64(64 - width))[:n]
            a = base.copy()
            change = int(rng.integers(0, max(1, t.apart(2 * len(a))) + 1))
            b = a.copy()
            b = np.delete(b, rng.choice(len(b), min(change // 2, len(b) - 1), replace=False)) if change > 1 else b
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, change - change // 2, dtype=np.uint64) >> np.uint64(64 - width)]))
            overlap = len(np.intersect1d(a, b))
            if t.links(overlap, len(a) + len(b)) and not np.array_equal(a, b):
                assert len(np.intersect1d(ngram_join.routing_keys(a, t), ngram_join.routing_keys(b, t))), (num, n, width, trial)


def test_ngram_join_blocks_by_shingles_give_the_same(spark, monkeypatch):
    rows = _edge_rows(8)
    one = sorted(map(tuple, ngram_join.ngram_components(_docs(spark, rows)).collect()), key=str)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 50)
    assert sorted(map(tuple, ngram_join.ngram_components(_docs(spark, rows)).collect()), key=str) == one


def test_memories_last_until_another_operator_runs(spark):
    from lakemart.llm import textblocks

    rows = spark.range(4).selectExpr("id AS doc_id", "repeat('some words here ', 50) AS text").coalesce(1)

    def kept(batch):
        yield {"n": [len(textblocks._kept)] * batch.num_rows}

    assert bpe.encode_documents(rows, *tokenizer()).count() == 4
    names = []
    textblocks.keep("a", lambda: names.append("a"))
    textblocks.keep("b", lambda: names.append("b"))
    textblocks._release("b")
    assert names == ["a"] and list(textblocks._kept) == ["b"]
    textblocks._release(None)
    assert names == ["a", "b"] and not textblocks._kept
    assert [r.n for r in textblocks.map_batches(rows, kept, "n long").collect()] == [0] * 4
