"""Text operators against brute force, on small inputs with the awkward cases."""

from __future__ import annotations

import hashlib
import html
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalroot.llm import common, decontaminate, exact_dedup, html_text, jaccard_join, language_id, packing, pseudo_likelihood, quality, substring_dedup, trees, url_filter

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kept string, id string, sha string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """Rows (doc_id, text) with extra columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)


def awkward() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "Ünï", "naïve,"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, shared = text(80), text(20)
    near = base.split()
    near[40] = "changed"
    rows = [(1, base), (2, base.upper()), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "ONE two"), (9, "one two three"), (None, base), (None, None)]
    rows += [(20 + k, text(30) + "\n" + shared + "\t" + text(30)) for k in range(12)]
    rows += [(50 + k, base) for k in range(5)] + [(60, base), (60, base), (70, text(60_000)), (71, "É" * 50), (72, "same " * 200), (73, "same " * 300)]
    for k in range(6):  # a group of copies edited one by one
        w = base.split()
        w[5 * k + 10] = f"edit{k}"
        rows.append((80 + k, " ".join(w)))
    return rows


def lower(text):
    return (text or "").encode().lower()


def words(text, fold=False):
    return WORD.findall(lower(text) if fold else (text or "").encode())


def test_exact_dedup(spark):
    rows = awkward()
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    for bits in (64, 12):  # few bits make collisions, never wrong groups
        got = exact_dedup.exact_dedup(documents(spark, rows), fingerprint_bits=bits).collect()
        assert len(got) == len(rows)
        want = []
        for i, t in rows:
            ids = groups[lower(t)]
            keep = max((x for x in ids if x is not None), default=None)
            want.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t)).hexdigest()))
        key = lambda r: tuple(str(x) for x in r)
        assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert exact_dedup.exact_dedup(documents(spark, rows[:0])).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**20 - 1)), st.lists(st.integers(0, 2**20 - 1)), st.integers(1, 8), st.integers(1, 8))
def test_filters_merge_losslessly(a, b, p, q):
    one = lambda x, bits: exact_dedup.QuotientFilter.loads(exact_dedup.QuotientFilter.build(np.array(x, np.uint64), np.ones(len(x)), bits, 20 - bits).dumps())
    both = one(a, p).merge(one(b, q))
    want = {x: (a + b).count(x) for x in set(a + b)}
    assert dict(zip(both.fingerprints().tolist(), both.counts.tolist())) == want


def brute_components(rows, percent=80):
    sets = {}
    for i, t in rows:
        w = words(t, True)
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    ids = sorted(x for x in sets if x is not None)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sets, {i: find(i) for i in ids}


def test_jaccard_join(spark):
    rows = awkward()
    sets, component = brute_components(rows)
    got = jaccard_join.jaccard_join(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), len(s), str(component.get(i))) for i, found in sets.items() for s in found)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want
    assert jaccard_join.jaccard_join(documents(spark, rows[:0])).count() == 0


def test_jaccard_join_tells_long_words_apart(spark):
    """Words of more bytes than there are place weights, in one task: equal parts in another order are other words."""
    x, y = "a" * 4096 + "b" * 4096, "b" * 4096 + "a" * 4096
    rest = " one two three four five"
    rows = [(1, x), (2, y), (3, x.upper()), (4, x + rest), (5, y + rest), (6, y + rest + " ")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(documents(spark, rows).coalesce(1)).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 1), 4: (2, 4), 5: (2, 5), 6: (2, 5)}


def test_jaccard_join_of_a_crowd_with_a_common_passage(spark):
    """Documents that share a passage and little else, and copies edited one by one, against all pairs."""
    rng = random.Random(8)
    vocabulary = [f"v{k}" for k in range(4000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, base = text(40), text(120)
    rows = []
    for _ in range(60):
        rows.append(text(25) + passage + text(25))
    for _ in range(120):
        w = list(base)
        for k in rng.sample(range(len(w)), rng.randrange(1, 7)):
            w[k] = rng.choice(vocabulary)
        rows.append(w)
    for _ in range(40):  # copies of copies, and shortened ones
        w = list(rng.choice(rows[60:]))
        w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append(w[: rng.randrange(100, 121)])
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    sets = {i: jaccard_join.exact_shingles(t.encode().split()) for i, t in rows}
    least = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and least[a] != least[b]:
            lo, hi = sorted((least[a], least[b]))
            least = {i: lo if c == hi else c for i, c in least.items()}
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(documents(spark, rows)).collect()}
    assert got == least and len(set(least.values())) > 70


def test_jaccard_join_loses_no_link_at_the_threshold(spark):
    rng = random.Random(9)
    rows = []
    for size in (5, 6, 8, 9, 12, 30, 45, 90, 200):
        for k in range(14):
            base = [f"s{size}k{k}w{j}" for j in range(size)]
            edited = list(base)
            for j in rng.sample(range(size), min(size, rng.randint(0, 1 + size // 30))):
                edited[j] = f"edit{j}"
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(edited)), (len(rows) + 2, " ".join(base[: size - rng.randint(0, size // 4)]))]
    _, component = brute_components(rows)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(documents(spark, rows)).collect()}
    assert got == component and len(set(component.values())) < len(rows)


def test_jaccard_join_moves_no_texts_of_pairs_that_are_far_apart(spark, monkeypatch):
    """Documents with a common passage make many pairs; their texts stay where they are, and no link is lost."""
    rng = random.Random(12)
    text = lambda n: [f"v{rng.randrange(9000)}" for _ in range(n)]
    passage, rows = text(60), []
    for _ in range(80):
        rows.append(text(35) + passage + text(35))
    for w in rows[:6]:
        rows.append([*w[:3], "edited", *w[4:]])
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    moved, old = [], jaccard_join._oriented
    monkeypatch.setattr(jaccard_join, "_oriented", lambda pairs: moved.extend((r.a, r.b) for r in pairs.collect()) or old(pairs))
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(documents(spark, rows)).collect()}
    assert got == {k: k - 80 if k >= 80 else k for k, _ in rows}
    assert {(k, 80 + k) for k in range(6)} <= set(moved) and len(moved) < 20


def test_jaccard_join_moves_texts_to_pivots_in_slices(spark, monkeypatch):
    """Where documents have more pivots than may be broadcast, texts go to them slice by slice; no text outside of the lists moves."""
    rng = random.Random(13)
    text = lambda n: [f"v{rng.randrange(9000)}" for _ in range(n)]
    passage, rows = text(60), []
    for _ in range(40):
        rows.append(text(35) + passage + text(35))
    for w in rows[:6]:
        rows.append([*w[:3], "edited", *w[4:]])
    rows = [(k, " ".join(w)) for k, w in enumerate(rows)]
    made, old = [], common.Scratch.table
    monkeypatch.setattr(common.Scratch, "table", lambda self, df, name: made.append(name) or old(self, df, name))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 25)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(documents(spark, rows)).collect()}
    assert got == {k: k - 40 if k >= 40 else k for k, _ in rows}
    assert {"placed0", "placed1"} <= set(made)


def test_parities_never_pass_the_difference():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 63, 64, 65, 300, 5000):
        for change in (0, 1, n // 5, n):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[change:], rng.integers(0, 1 << 63, change // 2).astype(np.uint64)]))
            apart = len(np.setxor1d(x, y))
            found = jaccard_join._least_apart(jaccard_join._parity(x), jaccard_join._parity(y))
            assert found <= apart and (found - apart) % 2 == 0
            assert found == jaccard_join._least_apart(jaccard_join._parity(y), jaccard_join._parity(x))
            assert len(jaccard_join._parity(x)) == jaccard_join._parity_bytes(len(x))


def test_signatures_keep_the_pigeonhole():
    rng = np.random.default_rng(4)
    for n in (4, 7, 20, 33, 60, 150, 700):
        for _ in range(60):
            x = np.unique(rng.integers(1, 1 << 63, n).astype(np.uint64))
            h = len(x) * 20 // 180  # deleted and inserted elements that leave 80 percent
            gone = rng.choice(len(x), min(h, len(x) - 1), replace=False)
            y = np.unique(np.concatenate([np.delete(x, gone), rng.integers(1, 1 << 63, h).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                assert len(np.intersect1d(jaccard_join.signatures(x, 80), jaccard_join.signatures(y, 80)))


def test_substring_dedup(spark):
    rows = [(i, t) for i, t in awkward() if i != 60] + [(90, " ".join(["again"] * 40)), (91, " ".join(["again"] * 13))]
    first = {}
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - 12):
            if i is not None:
                first[tuple(w[s : s + 13])] = min(i, first.get(tuple(w[s : s + 13]), i))
    want = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for s in range(len(w) - 12):
            if i is not None and first[tuple(w[s : s + 13])] < i:
                gone.update(range(s, s + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((str(i), len(w), len(gone), kept.decode(), hashlib.sha256(kept).hexdigest()))
    got = substring_dedup.substring_dedup(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text, r.kept_sha256) for r in got) == sorted(want)
    assert substring_dedup.substring_dedup(documents(spark, rows[:0])).count() == 0


def test_packing(spark):
    from tokenizers import Tokenizer

    rows = [*awkward(), (100, "áb É’s it's don't <|endoftext|> x<|startoftext|>y ΣΑΣ, İstanbul 12３ ²³ foo_bar 😀!! ﬁ ạ̈ \x1cz\u2003k é"), (101, "'S ''ll 'LL K ẞ")]
    tok = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(documents(spark, rows).coalesce(1), shard_docs=20).collect()
    by_sequence, by_doc = {}, {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0
    for i in {i for i, _ in rows}:
        texts = [t for j, t in rows if j == i]
        all_ids = [np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for t in texts]
        assert sum(r.length for r in by_doc[i]) == sum(map(len, all_ids))
        if len(texts) == 1:
            at = 0
            for r in sorted(by_doc[i], key=lambda r: r.start):
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(all_ids[0]), zlib.crc32(all_ids[0][at : at + r.length].tobytes()))
                at += r.length
    assert packing.pack(documents(spark, rows[:0])).count() == 0


def test_packing_seeds_take_lexical_neighbours():
    docs = [np.array([k % 3 * 100 + j for j in range(90)] * 6 + [1], np.uint16) for k in range(30)]
    together = sum(len({d % 3 for d, _, _ in s}) == 1 for s in packing.pack_shard(docs, 1024))
    assert together >= 10


PAGES = [
    ("<html><head><title>t</title><script>var x='</p>'</script></head><body><header>Top</header><nav><a href=a>Menu one</a></nav><article><h1>Head &amp; line</h1><p>Be.</p>"
     "<p>Some <b>bold</b>\n text&nbsp;here &#233;.<br>more<aside>side words here</aside><form>Your name<input></form><p class=\"ad-box\">Buy now things</p><section class='comments'><p>Nice post, said a reader with many words</p></section></article>"
     "<div class=sidebar>Long sidebar text with a good number of words in it, more than ten</div><footer>&copy; x</footer></body></html>", "Head & line\n\nBe.\n\nSome bold text here é. more"),
    ("", ""), (None, ""), ("<p>", ""), ("<!-- only a comment", ""), ("<div>" + "word " * 40 + "</div><ul><li><a href=x>link</a></li></ul>", " ".join(["word"] * 40)),
    ("<article><p>cut off in a ta<b", "cut off in a ta"), ("<article><p>5 < 6 &am</p></article>", "5 < 6 &am"),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_html_text(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page", [
    '<div class="content has-sidebar"><article>%s</article></div>', '<div id="content-sidebar-wrap"><main>%s</main></div>', '<article class="post comments-open">%s</article>',
    '<main class="with-sidebar"><div class="content has-sidebar"><article>%s</article></div></main>', '<div class="has-sidebar"><div class="comments-open"><article id="search">%s</article></div></div>',
])
def test_html_text_wrappers_do_not_decide(page):
    held = '<p>Short text.</p><div class="ad">Buy now</div><section class="comments"><article class="comment"><p>Nice post</p></article></section>'
    assert html_text.main_text(f"<body>{page % held}<div class=sidebar>More of this</div></body>") == "Short text."
    assert html_text.main_text(f"<body>{page % held}<div id=comments><article>Another reader's post</article></div></body>") == "Short text."
    assert html_text.main_text(f"<body><div hidden>{page % held}</div></body>") == ""
    assert html_text.main_text("<div class=sidebar><article><p>Nothing else here</p></article></div>") == "Nothing else here"


def test_html_tree_on_other_pages():
    """Held-out accuracy by block; neighbours' words and links are among what the tree splits on."""
    right = total = inside = 0
    for page, main in html_text.labelled_pages(200, 77):
        found = html_text.blocks(page)
        for b, row in zip(found, html_text.features(found)):
            good = (trees.score(html_text.tree(), row) > 0) == (b[0] in main)
            right, total = right + good, total + 1
            inside += not good and b[4] and not b[3]
    assert right >= 0.98 * total and not inside  # nothing that an article holds without a name is lost
    used = set()

    def walk(node):
        if node and node.feature >= 0:
            used.add(html_text.FEATURES[node.feature])
            walk(node.low)
            walk(node.high)

    walk(html_text.tree())
    assert {"words", "links", "words_before", "links_before", "words_after", "links_after", "named", "shut"} <= used


LONG = " ".join(f"x{k}" for k in range(40))


@pytest.mark.parametrize(("page", "want"), [
    (f"<div><a>Home</a></div><article><p>{LONG}</p></article>", [LONG]),
    (f"<div>We use cookies to help you. <a>OK</a></div><article><p>{LONG}</p><p>Short.</p></article>", [LONG, "Short."]),
    (f'<article><h1>T</h1><p class="social-history">{LONG}</p><div id="related-work"><p>{LONG}</p></div></article>', ["T", LONG, LONG]),
    (f"<div><a>Home</a> <a>More</a></div><div><h1>A title</h1><p>{LONG}</p><p>{LONG}</p></div><div>\u00a9 2020 x</div>", ["A title", LONG, LONG]),
    (f"<ul><li><a>a</a></li><li><a>b</a></li></ul><div><p>{LONG}</p><p>Yes, a short one.</p><p>{LONG}</p></div><footer>End</footer>", [LONG, "Yes, a short one.", LONG]),
])
def test_html_text_by_blocks_and_neighbours(page, want):
    assert html_text.main_text(page).split("\n\n") == want


def test_html_text_of_a_page_with_one_sentence():
    page = "<html><body><nav><a href='/'>Home.</a></nav><div class='ad'>Buy now!</div><p>One sentence of main text only here.</p><footer>All rights.</footer></body></html>"
    assert html_text.main_text(page) == "One sentence of main text only here."
    assert html_text.main_text("<nav><a href='/'>Home.</a></nav><p><a href='/x'>More links here.</a></p>") == ""


def test_html_text_keeps_formulas():
    page = "<html><body><article><p>Let <math><mi>E</mi><mo>=</mo><mi>m</mi></math> be what the long and plain sentence of this paragraph is about, so that it is kept.</p></article></body></html>"
    assert html_text.main_text(page).startswith("Let E=m be what")


def test_html_text_of_deep_long_and_odd_pages(spark):
    import time

    began = time.process_time()
    deep = "<div>" * 60_000 + f"<p>{LONG}</p>" + "</p></div></b>" * 60_000
    assert html_text.main_text(deep) == LONG
    assert html_text.main_text("<svg><head>" * 20_000) == "" and html_text.main_text("<article><p>" + "a b " * 500_000).count("a") == 500_000
    assert time.process_time() - began < 20
    kinds = "page_id long, url string, html string, text string, id string, n_chars int, inside int"
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "x", "y", 1, 1)] * 2 + [(2, None, "", "x", "y", 1, 1), (3, "v", "<p", "x", "y", 1, 1)]
    pages = spark.createDataFrame(rows, kinds)
    assert [(r.page_id, r.text) for r in html_text.html_text(pages).orderBy("page_id").collect()] == [(1, LONG), (1, LONG), (2, ""), (3, "")]
    assert html_text.html_text(pages.limit(0)).collect() == []


def test_html_text_query(spark):
    got = html_text.html_text(spark.createDataFrame([(1, "u", PAGES[0][0], "x"), (None, None, None, "x")], "page_id long, url string, html string, text string")).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, "u", len(PAGES[0][1])), (None, None, 0)]
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    truth = {r.page_id: r.html for r in pages.collect()}
    for r in html_text.html_text(pages).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", truth[r.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>?", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(p for p in parts if p)


def test_url_filter(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]
    urls = ["http://WWW.example.com/en/1?x=/de/", "https://a.example.com/en/1", "http://example.com", "http://notexample.com/en/", "x://h.net/es/#a", "http://best-casino-win.org/", "http://museum.example.org/x", None, "nothing", "http://"]
    got = url_filter.url_filter(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string"), rules).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in got[:5]] == [("www.example.com/en/", "allow"), ("example.com/en/", "block"), (None, got[2].verdict), ("com/", "allow"), ("net/es/", "block")]
    rates, forest = dict(url_filter.suffix_rates(url_filter.composed_urls())), url_filter.model(url_filter.composed_urls())
    for r, u in zip(got, urls):
        assert (r.host, r.path) == url_filter.split_url(u)
        assert abs(r.margin - sum(trees.score(t, url_filter.features(u, rates)) for t in forest)) < 1e-9


def test_url_trees_on_urls_of_other_words():
    """Held-out accuracy; no one feature tells the classes apart, and all six kinds are used."""
    labelled = url_filter.composed_urls()
    rates, forest = dict(url_filter.suffix_rates(labelled)), url_filter.model(labelled)
    words = tuple("harbor cinder pillow marble thistle acorn beacon compass dolphin ember falcon granite hammock ivory juniper".split())
    held = url_filter.composed_urls(800, 5, words)
    x, y = np.array([url_filter.features(u, rates) for u, _ in held]), np.array([b for _, b in held])
    right = np.mean([(sum(trees.score(t, r) for t in forest) > 0) == b for r, b in zip(x, y)])
    alone = max(max(np.mean((v > t) == y), np.mean((v <= t) == y)) for v in x.T for t in np.unique(v))
    assert right >= 0.85 and alone < right
    used = set()

    def walk(node):
        if node and node.feature >= 0:
            used.add(url_filter.NAMES[node.feature])
            walk(node.low)
            walk(node.high)

    for t in forest:
        walk(t)
    assert {"url_len", "host_len", "depth", "digit_ratio", "entropy", "params", "suffix_rate"} <= used


def test_url_filter_on_awkward_input(spark):
    kinds = "page_id long, url string, host string, path string, rule string, u string, rest string, margin int"
    urls = ["http://a.o'neil.com/it's/x", "http://a.o'neil.com/", "http://b\\c.com/", "http://x.com/" + "p/" * 100_000, None, "", "http://x.com/1", "http://x.com/1"]
    rows = [(None if i == 6 else 1, u, *"abcde", 3) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, kinds)
    rules = [("block", "o'neil.com/it's/"), ("allow", "b\\c.com/")]
    got = url_filter.url_filter(pages, rules).collect()
    assert [r.rule for r in got] == ["o'neil.com/it's/", None, "b\\c.com/", None, None, None, None, None]
    assert [r.path for r in got[:2]] == ["/it's/x", "/"] and got[3].path == "/" + "p/" * 100_000 and (got[4].host, got[4].path) == ("", "")
    assert [r.page_id for r in got] == [1] * 6 + [None, 1] and got[6].verdict == got[7].verdict
    plain = url_filter.url_filter(pages, [], labelled=()).collect()
    assert {(r.rule, r.verdict, r.margin) for r in plain} == {(None, "allow", 0.0)}
    assert url_filter.url_filter(pages.limit(0), rules).collect() == []


def test_language_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.language_id(docs).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 !! ··", "en"), (None, "the cat", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language_id.language_id(odd).collect()] == [("und", 0.0)] * 4
    assert language_id.language_id(odd.limit(0)).count() == 0


def test_language_id_learns_every_language(spark):
    """450 languages of a dozen rows each, more than there are dimensions: all are learned, and told apart on rows held out."""
    rng = random.Random(9)
    rows = []
    for k in range(450):
        vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzàéîõüñß") for _ in range(rng.randrange(3, 8))) for _ in range(12)]
        rows += [(12 * k + j, " ".join(rng.choice(vocabulary) for _ in range(40)), f"l{k:03}") for j in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.language_id(docs, per_lang=8).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len({r.lang_pred for r in got}) >= 445 and sum(r.lang_pred == r.lang for r in held) >= 0.9 * len(held)


def test_language_id_on_awkward_tables(spark):
    """Long and repeated rows, columns named like those of the result, a sample bounded in bytes."""
    rows = [(k, "the cat sat on the mat and the dog ran" if k % 2 else "le chat est sur la table et le chien court", "en" if k % 2 else "fr") for k in range(60)]
    rows += [(100, "the cat and the dog " * 60_000, "en"), (101, "the cat sat", "en"), (101, "the cat sat", "en"), (None, "le chien est sur la table", None)]
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], "doc_id long, text string, lang string, lang_pred string, held_out int, spread int, size string")
    got = language_id.language_id(docs).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((r[0] or -1) for r in rows)
    said = {r.doc_id: r.lang_pred for r in got}
    assert said[100] == said[101] == "en" and said[None] == "fr" and sum(r.doc_id == 101 for r in got) == 2
    assert all(said[k] == lang for k, _, lang in rows[:60])


def test_quality(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, test = labels.filter("doc_id % 4 != 0"), labels.filter("doc_id % 4 = 0")
    got = quality.quality_scores(docs, train).join(test, "doc_id").collect()
    assert sum(r.kept == bool(r.quality) for r in got) >= 0.95 * len(got)
    assert all(r.kept for r in got if r.quality and r.score > 0.5)
    odd = documents(spark, [(1, None), (2, ""), (None, "x"), (3, "a b")])
    assert quality.quality_scores(odd, labels.limit(0)).filter("kept").count() == 4
    kept = quality.quality_filter(docs.withColumn("score", F.lit("clash")), train)
    assert kept.columns == [*docs.columns, "score"] and 800 < kept.count() < 1000
    assert quality.quality_scores(docs.limit(0), train).count() == 0


def test_quality_on_awkward_tables(spark):
    """Metadata of other types, cases and names, nulls, a long text, repeated rows: one score each, the same in both forms."""
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, "x"), (-2, "", "en", "s", None), (-3, "long word. " * 100_000, None, "s", "12"), (-4, "same.", "en", "s", "3"), (-4, "same.", "en", "s", "3"), (None, "no id", "en", None, "3.5")], "doc_id long, text string, lang string, source string, n_chars string")
    mixed = docs.withColumn("n_chars", F.col("n_chars").cast("string")).select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd)
    mixed = mixed.select("doc_id", "text", F.col("lang").alias("Lang"), F.col("source").alias("SOURCE"), F.col("n_chars").alias("N_chars"), F.lit(1).alias("view_0"), F.lit("y").alias("id"))
    scores = quality.quality_scores(mixed, labels).collect()
    kept = quality.quality_filter(mixed, labels)
    assert kept.columns == mixed.columns and len(scores) == docs.count() + 6
    key = lambda rows: sorted(str(r.doc_id) for r in rows)
    assert key(kept.collect()) == key([r for r in scores if r.kept])
    plain = {r.doc_id: round(r.score, 9) for r in quality.quality_scores(docs.unionByName(odd.withColumn("n_chars", F.col("n_chars").try_cast("long"))), labels).collect()}
    assert {r.doc_id: round(r.score, 9) for r in scores} == plain
    assert quality.quality_filter(mixed.limit(0), labels).count() == 0


def test_quality_views_lend_labels():
    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.7).astype(float)
    text = np.zeros((400, quality.TEXT_DIM), np.float32)
    meta = np.zeros((400, quality.META_DIM), np.float32)
    text[:, 0], meta[:, 0] = y + rng.normal(0, 0.2, 400), y
    model = quality.co_train(text[:100], meta[:100], y[:100], text[100:], meta[100:])
    assert np.mean((text[100:] @ model.text[0] + model.text[1] > 0) == (y[100:] > 0)) > 0.95
    assert quality.co_train(text[:10], meta[:10], np.ones(10), text, meta) is None


def test_pseudo_likelihood(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    vocabulary, weights = pseudo_likelihood.fit(docs, rounds=3)
    texts = [r.text for r in docs.collect()]
    total = lambda w: sum(_score(vocabulary, w, t) for t in texts[:200])
    assert total(weights) > total(pseudo_likelihood.Network().weights)
    odd = documents(spark, [(1, None), (2, "  "), (3, "the of and"), (3, "the of and"), (None, "x")])
    got = pseudo_likelihood.pseudo_likelihood(odd, rounds=1).collect()
    assert [(r.n_tokens, r.log_prob == 0, r.mean_log_prob is None) for r in got] == [(0, True, True), (0, True, True), (3, False, False), (3, False, False), (1, False, False)]
    assert got[2].log_prob == got[3].log_prob
    assert pseudo_likelihood.pseudo_likelihood(odd.limit(0), rounds=1).count() == 0
    # against a plain loop
    by_hand = _score(vocabulary, weights, texts[0])
    shared = type("S", (), {"value": (vocabulary, weights)})
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([texts[0].encode()], pa.binary())], names=["id", "text"])
    assert abs(next(iter(pseudo_likelihood._score(shared)(iter([batch]))))["log_prob"][0].as_py() - by_hand) < 1e-3 * abs(by_hand)


def _score(vocabulary, weights, text):
    import pyarrow as pa

    net = pseudo_likelihood.Network(weights)
    h = np.concatenate([x for _, got in common.word_streams(pa.array([text.encode()]), lower=True) for x in got])
    x, y, inside = vocabulary(h)
    out = 0.0
    for t in range(len(x)):
        near = [x[t + o] if 0 <= t + o < len(x) else pseudo_likelihood.EDGE for o in pseudo_likelihood.OFFSETS]
        z = np.tanh(sum(net.emb[k, n] for k, n in enumerate(near))) @ net.out + net.bias
        out += z[y[t]] - np.log(np.exp(z).sum()) + inside[t]
    return out


def test_pseudo_likelihood_uses_the_own_count_of_every_word(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "CHUNK_RARE", 700)  # many chunks
    words = [f"w{i}" for i in range(3 * pseudo_likelihood.VOCABULARY)]
    names = np.array(words)
    h = np.concatenate([x for _, got in common.word_streams(pa_array(words), lower=True) for x in got])
    out = pseudo_likelihood.shared_out(h)
    rare = [int(i) for i in np.flatnonzero(out == out[-1])[-3:]]  # of one output; the last one is more common
    texts = [" ".join(names[lo : lo + 64]) for lo in range(0, len(words), 64)] * 2
    texts += [words[rare[2]]] + [" ".join(words[: pseudo_likelihood.VOCABULARY + 300])] * 3
    rows = [(k, t) for k, t in enumerate(texts)] + [(-1, words[rare[0]]), (-2, words[rare[2]]), (-2, words[rare[2]])]
    got = {r.doc_id: r for r in pseudo_likelihood.pseudo_likelihood(documents(spark, rows), rounds=1).collect()}
    assert len(got) == len(texts) + 2
    # alone in a text, words of one output differ by the logarithm of their counts: 3 and 5
    assert abs(got[-2].log_prob - got[-1].log_prob - np.log(5 / 3)) < 1e-6


def pa_array(words):
    import pyarrow as pa

    return pa.array([w.encode() for w in words])


def test_pseudo_likelihood_trains_on_every_position():
    import pyarrow as pa

    texts = [b"one two three", b"", b"four", b"one two three four five six seven"] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    none = np.zeros(pseudo_likelihood.SHARED_OUT)
    v = pseudo_likelihood.Vocabulary.build(np.empty(0, np.uint64), np.empty(0, np.int64), none, none)
    shared = type("S", (), {"value": (v, pseudo_likelihood.Network().weights)})
    seen = sum(np.frombuffer(out["data"][0].as_py(), "<f4")[0] for turn in range(3) for out in pseudo_likelihood._fit(shared, turn, 3)(iter([batch])))
    assert seen == 20 * 11
    # the choice doesn't hang on how rows are batched
    (_, h, words, *_), = common.word_spans(batch.column(0), lower=True)
    for turn in range(3):
        together = pseudo_likelihood.targets(h, words, turn, 3)
        alone = pseudo_likelihood.targets(h[4:11], words[3:4], turn, 3)
        assert set(alone) == {k - 4 for k in together if 4 <= k < 11} == {k - 15 for k in together if 15 <= k < 22}


def test_encoder_equals_the_tokenizer_on_any_text():
    from tokenizers import Tokenizer

    rng = random.Random(6)
    kinds = [(0x20, 0x7F), (0x80, 0x600), (0x80, 0xD800), (0xE000, 0x10000), (0x10000, 0x110000)]
    texts = ["".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(1, 40))) for _ in range(6000)]
    texts += [f"{chr(c)} a{chr(c)}b é{chr(c)}" for c in range(1, 0x3100)]
    texts += ["a" * 4096 + "b" * 4096, "b" * 4096 + "a" * 4096, "", " ", "it's <|endoftext|> don't", "ΑΣ ΣΑΣ", "\u208f\u209d a\u209e"]
    path = packing.tokenizer_path()
    plain, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    for lo, got in encoder.encode(pa.array([t.encode() for t in texts], pa.large_binary())):
        for t, ids in zip(texts[lo:], got):
            assert ids.tolist() == [*plain.encode(t, add_special_tokens=False).ids, 1], t
    chunk = [np.frombuffer(b"one two", np.uint8), np.array([0, 4]), np.array([3, 3])]
    ids, n = encoder.ids(np.array([5, 5], np.uint64), *chunk)  # two chunks with one hash
    assert ids.tolist() == plain.encode("one two", add_special_tokens=False).ids


def test_encoder_sets_capitals_and_marks_aside():
    """A word is encoded once, however it is capitalised and whatever marks follow it, with the tokenizer's ids."""
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    plain, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    texts = ["Größe größe, GRÖSSE? GRÖßE! größe... Größe$$$ größe's", "größe", "Größe;"]
    for lo, got in encoder.encode(pa.array([t.encode() for t in texts], pa.large_binary())):
        for t, ids in zip(texts[lo:], got):
            assert ids.tolist() == [*plain.encode(t, add_special_tokens=False).ids, 1], t
    assert len(encoder.keys) == 9  # two words, seven kinds of marks
    letters = [*"AHJTWYZahz\u00c4\u00d6\u00d7\u00df\u00e4\u00f7\u00ff\u0130\u03a3\u00b5"]
    marks = [*"',.<=>`|-_9", "'s", "'LL", "'ve'D", "\u0301", "\u0308", "\u030a", "\u030c", "\u0331", "\u0338", "\u2019", "\u00a0", "\x00", "\x1c", "\x7f", ""]
    words = [a + m + b + n for a in letters for m in marks for b in letters[:12] for n in marks]
    texts = [" ".join(words[k : k + 50]) for k in range(0, len(words), 50)]
    texts += ["ends in a letter", ",begins with a mark", "Ends in A", "\u0308begins with one that combines", "Special X<|endoftext|>.Y, <|ENDOFTEXT|>"]
    for some in (texts, texts[-5:], texts[-5:-1]):
        for lo, got in encoder.encode(pa.array([t.encode() for t in some], pa.large_binary())):
            for t, ids in zip(some[lo:], got):
                assert ids.tolist() == [*plain.encode(t, add_special_tokens=False).ids, 1], t
    texts = [b"ab\xc3", b"\xa4, x", b"\xc3", None, b"\xa4\xa4"]  # not UTF-8: each text by itself, as ever
    (_, together), = encoder.encode(pa.array(texts, pa.large_binary()))
    for t, ids in zip(texts, together):
        assert ids.tolist() == [*plain.encode((t or b"").decode("utf-8", "replace"), add_special_tokens=False).ids, 1], t


def test_packing_index_scores_as_a_plain_loop():
    """Weights of the index, with ids of two and of four bytes, against the formula."""
    rng = np.random.default_rng(4)
    for top, kind in ((300, np.uint16), (1 << 30, np.uint32)):
        pool = rng.integers(0, top, 80)
        docs = [rng.choice(pool, rng.integers(1, 60)).astype(kind) for _ in range(40)]
        index, mean = packing.Bm25(docs), np.mean([len(d) for d in docs])
        df = {t: sum(t in d for d in docs) for t in pool}
        for seed in range(40):
            want = np.zeros(40)
            for t in set(docs[seed].tolist()):
                for j, d in enumerate(docs):
                    n = int((d == t).sum())
                    if n:
                        want[j] += n * (packing.K1 + 1) / (n + packing.K1 * (1 - packing.B + packing.B * len(d) / mean)) * max(np.log((40 - df[t] + 0.5) / (df[t] + 0.5)), 0)
            assert np.allclose(index.scores(seed), want, rtol=1e-5)


def test_vocabulary_is_a_distribution():
    rng = np.random.default_rng(5)
    h = rng.integers(1, 1 << 63, 9000).astype(np.uint64)
    n = np.sort(rng.zipf(1.5, 9000).clip(1, 10**6))[::-1]
    out = pseudo_likelihood.shared_out(h)
    top = pseudo_likelihood.VOCABULARY
    v = pseudo_likelihood.Vocabulary.build(h[:top], n[:top], np.bincount(out, n, pseudo_likelihood.SHARED_OUT), np.bincount(out, minlength=pseudo_likelihood.SHARED_OUT))
    _, y, inside = v(h)
    mass = np.bincount(y, np.exp(inside), pseudo_likelihood.OUTPUTS)
    assert np.all(mass < 1.0001) and np.all(mass[: pseudo_likelihood.OWN] > 0.999) and np.all(mass[pseudo_likelihood.OWN :] > 0.8)


def test_decontamination(spark):
    docs, benchmark = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    items = {r.item_id: plain(r.text) for r in benchmark.collect()}
    source = {r.item_id: r.text for r in benchmark.collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    clean = next(t for _, t in rows if len(t) > 3000 and not any(p in plain(t) for p in items.values()))
    edited = {5000 + k: source[k].split() for k in list(items)[:20]}
    for w in edited.values():  # every ninth word changed: a paraphrase
        w[::9] = ["changed"] * len(w[::9])
    rows += [(i, f"{clean[:600]} {' '.join(w).upper()} {clean[600:1500]}") for i, w in edited.items()]
    rows += [(9000, None), (9001, ""), (None, " ".join(source[0].split()))]
    got = decontaminate.leaks(documents(spark, rows), benchmark).collect()
    assert len(got) == len(rows)
    found = {}
    for r, (i, t) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(rows, key=lambda x: (x[0] is None, x[0]))):
        found[i] = set(r.item_ids)
        assert r.contaminated == bool(r.item_ids)
        assert {k for k, p in items.items() if p in plain(t)} <= found[i]
    assert sum(i - 5000 in found[i] for i in edited) >= 18
    truth = {i for i, t in rows if any(p in plain(t) for p in items.values())} | set(edited)
    assert not [i for i in found if found[i] and i not in truth]
    assert decontaminate.leaks(documents(spark, rows[:5]), benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.leaks(documents(spark, []), benchmark).count() == 0
    kept = decontaminate.decontaminate(documents(spark, rows), benchmark)
    assert kept.count() == sum(not r.contaminated for r in got) and kept.columns == documents(spark, []).columns


def test_decontamination_samples_rows_not_texts(spark):
    """Of 200,000 equal rows no more than the bound are drawn."""
    rows = spark.range(200_000).select(F.lit("the same text in every row").alias("text"))
    n = rows.filter(decontaminate._chosen(20_000, 200_000)).count()
    assert 18_000 < n <= 20_000
    assert rows.limit(10).filter(decontaminate._chosen(20_000, 10)).count() == 10


def test_decontamination_learns_from_every_row(spark):
    """Term weights and axes of more rows than were once drawn are those of a plain loop over all, however rows are dealt."""
    texts = [" ".join(f"w{(k * k + 7 * j * j) % 997}" for j in range(k % 90)) for k in range(24_000)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    w, n, df, sketch = decontaminate.random_matrix().astype(np.float64), 0, np.zeros(decontaminate.TERMS), np.zeros((decontaminate.TERMS, decontaminate.RANK))
    known = {f"w{k}": decontaminate.bucket(decontaminate.terms_of(f"w{k}"))[0] for k in range(997)}
    for t in texts:
        ids = [known[x] for x in t.split()]
        for lo in range(0, len(ids), decontaminate.PASSAGE):
            one = ids[lo : lo + decontaminate.PASSAGE]
            n += 1
            df[list(set(one))] += 1
            np.add.at(sketch, one, w[one].sum(axis=0))
    for rows in (docs, docs.repartition(7)):
        (block,) = decontaminate.fit(rows, items, "text", "item_id", "text")
        assert np.array_equal(block.idf, decontaminate.inverse(n, df).astype(np.float32))
        assert np.array_equal(block.latent, decontaminate.latent_space(n, df, sketch))


def test_decontamination_sums_of_any_size():
    """Sums beyond four bytes go on in eight; a long run of one word is summed whole."""
    import pyarrow as pa

    rows = np.arange(decontaminate.TERMS // decontaminate.SLICES * (1 + decontaminate.RANK)).reshape(-1, 1 + decontaminate.RANK)
    for x in (rows - 9, rows - (1 << 40)):
        assert np.array_equal(decontaminate._unpacked(decontaminate._packed(x)), x)
    text = b"word " * 200_000
    batch = pa.RecordBatch.from_arrays([pa.array([text, None, b"", text], pa.binary())], names=["text"])
    parts = list(decontaminate._add_up(decontaminate._sketch(iter([batch, batch]))))
    total = np.concatenate([decontaminate._unpacked(p["data"][0].as_py()) for p in parts])
    term = decontaminate.bucket(decontaminate.terms_of("word"))[0]
    assert parts[0]["passages"][0].as_py() == total[term, 0] == 4 * 3125
    assert np.array_equal(total[term, 1:], 4 * 3125 * 64 * 64 * decontaminate.random_matrix()[term].astype(np.int64))


def test_decontamination_in_several_blocks(spark, monkeypatch):
    """Items in blocks of three: the same findings, with one Python stage in the plan."""
    docs, benchmark = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    facts = lambda df: sorted((r.doc_id, sorted(r.item_ids), round(r.share, 9)) for r in df.collect())
    whole, kept = facts(decontaminate.leaks(docs, benchmark)), decontaminate.decontaminate(docs, benchmark).count()
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 15)
    found = decontaminate.leaks(docs, benchmark)
    assert facts(found) == whole and any(items for _, items, _ in whole)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert decontaminate.decontaminate(docs, benchmark).count() == kept


def test_decontamination_equals_judging_every_window(spark):
    """Every window of every document judged against every item, without cosines or word counts; long and repeated rows too."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    source = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(12).collect()]
    filler = rows[1][1].split()
    for k, (_, text) in enumerate(source):
        w = text.split()
        w[:: 5 + k] = ["other"] * len(w[:: 5 + k])
        rows.append((1000 + k, " ".join([*filler[: 40 * k], *w, *filler[:200]])))
    rows += [rows[-1], (3000, " ".join(filler * 30 + source[0][1].split() + filler * 30))]
    want = {}
    for doc, text in rows:
        terms = decontaminate.terms_of(text or "")
        for item, words in source:
            one = decontaminate.Item(item, decontaminate.terms_of(words), decontaminate.terms_of(decontaminate.answer_of(words)))
            size = next(n for n in decontaminate.LENGTHS if len(one.terms) <= n)
            starts = sorted({*range(0, max(len(terms) - size, 0) + 1, size // 4), max(len(terms) - size, 0)}) if len(terms) else []
            cache: dict = {}
            for a in starts:
                passage = terms[max(a - size // 4, 0) : a + size + size // 4].tolist()
                if decontaminate.judge(one, passage, cache)[1]:
                    want.setdefault(doc, set()).add(item)
    got = {r.doc_id: set(r.item_ids) for r in decontaminate.leaks(documents(spark, rows), spark.createDataFrame(source, "item_id long, text string")).collect() if r.item_ids}
    assert got == want and len(want) >= 12 and 3000 in want


def test_decontamination_recall_of_paraphrases(spark):
    """Passages with 10 to 40 % of their words replaced and the answer kept, of short items and of long ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) > 6000").orderBy("doc_id").limit(40)
    texts = [r.text for r in docs.collect()]
    source = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").limit(40).collect()]
    words = [t.split() for t in texts]
    source += [(900 + k, " ".join(words[k][100 : 100 + n])) for k, n in enumerate((80, 120, 200, 300, 600, 700))]
    rng, rows, planted = random.Random(4), [], []
    for rate in (10, 20, 30, 40):
        for item, text in source:
            w = text.split()
            tail = len(decontaminate.answer_of(text).split())
            free = range(len(w) - tail) if tail < len(w) // 2 else range(len(w))
            for k in rng.sample(free, min(len(free), len(w) * rate // 100)):
                w[k] = rng.choice(words[len(words) // 2 + item % 10])
            filler = words[-1 - item % 10]
            rows.append((len(rows), " ".join([*filler[:150], *w, *filler[150:300]])))
            planted.append((rate, item))
    benchmark = spark.createDataFrame(source, "item_id long, text string")
    got = {r.doc_id: set(r.item_ids) for r in decontaminate.leaks(documents(spark, rows), benchmark).collect()}
    for rate in (10, 20, 30, 40):
        hits = [item in got[k] for k, (r, item) in enumerate(planted) if r == rate]
        assert sum(hits) >= 0.9 * len(hits), (rate, sum(hits), len(hits))
    assert not [k for k, (_, item) in enumerate(planted) if got[k] - {item}]


def test_decontamination_keeps_every_passage_that_the_exact_checks_accept():
    terms = np.arange(1, 21, dtype=np.uint64) << np.uint64(50)
    idf = np.full(decontaminate.TERMS, 0.1, np.float32)
    idf[decontaminate.bucket(terms[:8])] = 10  # the rare words are replaced
    item = decontaminate.Item(7, terms, terms[14:])
    finder = decontaminate.Finder(decontaminate.Block([item], np.ones((decontaminate.TERMS, 1), np.float32), idf))
    other = np.arange(100, 108, dtype=np.uint64) << np.uint64(50)
    passage = np.r_[other, terms[8:]]
    assert decontaminate.judge(item, passage.tolist(), {})[1]
    filler = np.arange(200, 300, dtype=np.uint64) << np.uint64(50)
    assert [set(x) for x in finder([passage, np.r_[filler, passage, filler], filler, np.repeat(terms[14:15], 40)])] == [{7}, {7}, set(), set()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30))
def test_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    assert decontaminate.lcs(decontaminate.masks_of(np.array(a, np.int64)), len(a), b) == table[-1][-1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\nabÉé,.x", max_size=30)), max_size=12))
def test_word_streams(texts):
    import pyarrow as pa

    got = [x for _, some in common.word_streams(pa.array(texts, pa.string())) for x in some]
    assert [len(x) for x in got] == [len(words(t)) for t in texts]
    seen = {}
    for h, t in zip(got, texts):
        for value, word in zip(h.tolist(), words(t)):
            assert seen.setdefault(value, word) == word


def test_long_texts_are_hashed_whole(monkeypatch):
    import pyarrow as pa

    texts = ["ab " * 500 + "c" * 300, "x y", " ".join(str(i) for i in range(400))]
    whole = [x for _, some in common.word_streams(pa.array(texts)) for x in some]
    monkeypatch.setattr(common, "SLICE_BYTES", 64)
    parts = [x for _, some in common.word_streams(pa.array(texts)) for x in some]
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts)) and len(whole) == 3


def test_letters_are_not_numerals():
    found = [t for t in ("²", "½ Ⅷ", "12 _ !", "é", "1 ж", "字") if language_id._LETTER.search(t)]
    assert found == ["é", "1 ж", "字"]
