"""Main text of web pages: flat text blocks judged by a small decision tree.

A page is cut at its block-level tags into flat blocks. Each block is described
by its word count and link density, those of its neighbours, and what encloses
it; a decision tree, trained on the blocks of labelled pages, keeps or drops it.
The work is one Arrow pass over the pages: no shuffle, memory bounded by a batch.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import trees

# Element names of the HTML standard by their role here.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg object canvas audio video select button datalist head".split())
BOILER_TAGS = frozenset("nav aside footer form menu dialog fieldset search".split())
# Words in class, id and role attributes that name what is not main text.
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored commercial nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar side aside rail comment comments "
    "commentlist disqus reply replies respond responses discussion reactions cookie cookies consent gdpr notice notices alert warning "
    "popup modal overlay dialog newsletter subscribe subscription signup login register search searchbox form share sharing social "
    "related recommended recommendations widget widgets toolbar copyright legal pagination pager skip toc hidden contentinfo "
    "complementary disclaimer paywall feedback".split()
)
MAIN_TAGS = ("article", "main")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?P<end>>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"(?:^|[\s/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")

#: Of a block: words and link density, the same of the blocks before and after it, whether
#: a tag or attribute shuts it out, how far names around it speak against it, whether it is
#: in an article or main, whether the page has one, whether it is a heading or a paragraph.
FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "shut", "named", "inside", "marked", "heading", "paragraph"]


def labelled_pages(n: int = 2400, seed: int = 23) -> list[tuple[str, set[str]]]:
    """(page, its main texts): pages composed by a rule, whose blocks the tree is trained on.

    They differ in what they are marked up with: some have an article or main and
    some don't, menus and notices have names or none, an article may hold
    adverts, reader comments, short paragraphs, link lists and names that only
    look like boilerplate.
    """
    rng = random.Random(seed)
    made = iter(range(1 << 30))
    words = lambda k: " ".join(f"w{next(made)}" for _ in range(k))
    maybe = lambda p: rng.random() < p
    link = lambda k=1: f'<a href="/">{words(k)}</a>'
    named = lambda *names: rng.choice(("", *(f' {rng.choice(("class", "id"))}="{x}"' for x in names)))
    links = lambda least, most: "<ul>" + "".join(f"<li>{link(rng.randrange(1, 4))}</li>" for _ in range(rng.randrange(least, most))) + "</ul>"
    out = []
    for _ in range(n):
        main: set[str] = set()

        def kept(k: int) -> str:
            text = words(k)
            main.add(text)  # noqa: B023
            return text

        def story() -> str:
            parts = [f"<h1>{kept(rng.randrange(1, 12))}</h1>"] if maybe(0.75) else []
            for _ in range(rng.choice((1, 2, 3, 4, 5, 6, 8))):
                kind = rng.random() if len(parts) > 1 or parts and mark != "div" else 0.3 * rng.random()  # noqa: B023
                if kind < 0.55:
                    tag = "div" if maybe(0.15) else "p"
                    parts.append(f"<{tag}{named('lead', 'social-history', 'text') if maybe(0.2) else ''}>{kept(rng.randrange(18, 120))}</{tag}>")
                elif kind < 0.72:
                    parts.append(f"<p>{kept(rng.randrange(1, 14))}</p>")
                elif kind < 0.8:
                    parts.append(f"<h2>{kept(rng.randrange(1, 7))}</h2><p>{kept(rng.randrange(20, 60))}</p>")
                elif kind < 0.87:
                    parts.append("<ul>" + "".join(f"<li>{kept(rng.randrange(2, 16))}</li>" for _ in range(rng.randrange(2, 5))) + "</ul>")
                elif kind < 0.93:
                    text, more = words(rng.randrange(6, 30)), words(rng.randrange(1, 8))
                    main.add(f"{text} {more}")  # noqa: B023
                    parts.append(f'<p>{text} <a href="/">{more}</a></p>')
                else:
                    parts.append(f"<div{named('related-work', 'notice-of-terms')}><p>{kept(rng.randrange(20, 60))}</p></div>")
                if maybe(0.08):
                    parts.append(f'<div class="{rng.choice(("ad", "advert", "promo", "newsletter"))}">{words(rng.randrange(4, 40))}</div>')
            return "".join(parts)

        mark = rng.choice(("article", "main", "div", "div"))
        tag = rng.choice(("div", "p"))  # of a page with one block
        body = story() if maybe(0.8) else f"<{tag}>{kept(rng.randrange(20, 130) if mark == 'div' or maybe(0.5) else rng.randrange(1, 12))}</{tag}>"
        comments = f'<div class="{rng.choice(("comments", "comment-list"))}"><h3>{words(2)}</h3>' + "".join(f"<p>{words(rng.randrange(3, 60))}</p>" for _ in range(rng.randrange(1, 4))) + "</div>" if maybe(0.3) else ""
        within = mark != "div" and maybe(0.3)
        page = [f"<{mark}>{body}{comments if within else ''}</{mark}>"]
        if maybe(0.3):
            page.append(links(1, 5) if maybe(0.6) else f"<p>{link(2)}</p>")
        if maybe(0.35):
            tag = rng.choice(("div", "div", "p"))
            page.insert(0, f"<{tag}>{words(rng.randrange(5, 16))} {link() if maybe(0.6) else ''}</{tag}>")  # a notice without a name
        if maybe(0.3):
            page.insert(0, f"<div>{link()} {link()} {link(2)}</div>")
        if maybe(0.8):
            inner = f"{f'<div>{words(2)}</div>' if maybe(0.4) else ''}{links(3, 9) if maybe(0.7) else f'<div>{link()}</div>'}"
            page.insert(0, rng.choice((f"<nav>{inner}</nav>", f"<header>{inner}</header>", f"<div{named('menu', 'topbar', 'site-menu')}>{inner}</div>")))
        if maybe(0.2):
            page.append(f'<div class="ad">{words(rng.randrange(4, 30))}</div>')
        if comments and not within:
            page.append(comments)
        if maybe(0.5):
            inner = f"<h3>{words(2)}</h3>{links(2, 7)}" + (f"<p>{words(rng.randrange(10, 40))}</p>" if maybe(0.4) else "")
            page.append(rng.choice((f"<aside>{inner}</aside>", f'<div class="sidebar">{inner}</div>', f"<div><h3>{words(2)}</h3>{links(2, 7)}</div>")))
        if maybe(0.9):
            inner = f"{words(rng.randrange(2, 12))} {link() if maybe(0.5) else ''}"
            page.append(rng.choice((f"<footer>{inner}</footer>", f"<footer>{inner}</footer>", f"<div{named('footer', 'legal')}>{inner}</div>", f"<div>{link()} {link()} {words(3)}</div>", f"<p>{inner}</p>")))
        out.append((f"<html><body>{''.join(page)}</body></html>", main))
    return out


@lru_cache(1)
def tree() -> trees.Node:
    rows, truth = [], []
    for page, main in labelled_pages():
        found = blocks(page)
        rows += features(found)
        truth += [1.0 if b[0] in main else -1.0 for b in found]
    return trees.grow(np.array(rows, float), -np.array(truth), np.ones(len(rows)), depth=14, least=3, ridge=0.01)


#: What says that something is boilerplate: names around its article, which hold if there is
#: other main text; a word among the names (class, id, role); all of the names; a tag, or being hidden.
WEAK, NAMED, WHOLLY, CERTAIN = 1, 2, 3, 4
# Words that don't change what a name says.
_FILLER = frozenset(
    "area areas list section block box container item items posts post articles stories s body text author thread slot unit wrapper wrap "
    "inner outer holder bar panel pane links link left right top bottom buttons button icons".split()
)


def _boiler(name: str, attrs: str, inside: bool, named: bool) -> int:
    """0, NAMED, WHOLLY or CERTAIN; without `named` the words of class, id and role don't count."""
    if name in BOILER_TAGS or (name == "header" and not inside):
        return CERTAIN
    if not attrs:
        return 0
    found, names = 0, set()
    for key, a, b, c in _NAMED.findall(attrs):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            return CERTAIN
        if not named or key not in ("class", "id", "role"):
            continue
        names.update(_SPLIT.split(value))
        if name not in ("body", "html") and not BOILER_WORDS.isdisjoint(_SPLIT.split(value)):
            if inside and name in ("header", "h1") and not {"comment", "comments", "ad", "ads"} & set(_SPLIT.split(value)):
                continue
            found = NAMED
    return WHOLLY if found and names <= BOILER_WORDS | _FILLER | {""} else found


Block = tuple[str, int, int, int, int, int, int]


def blocks(page: str) -> list[Block]:
    """(text, words, linked words, boilerplate, inside, heading, paragraph) of each flat block, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # of open elements: name, boilerplate, inside
    depth: Counter[str] = Counter()  # how many of a name are open
    unclosed: set[str] = set()
    weak: list[int] = []
    links, own, heading, paragraph, at = 0, 0, False, False, 0

    def text(until: int) -> None:
        if until > at:
            piece = page[at:until]
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if links:
                linked.append(piece)

    def flush() -> None:
        words = "".join(parts).split()
        if words:
            boiler, inside = (stack[-1][1], stack[-1][2]) if stack else (0, False)
            if boiler == WEAK and not own:
                weak.append(len(out))
            out.append((" ".join(words), len(words), len("".join(linked).split()), max(boiler if boiler > WEAK else 0, own), int(inside), int(heading), int(paragraph)))
        parts.clear()
        linked.clear()

    length = len(page)
    while at < length:
        m = _TAG.search(page, at)
        if m is None:
            text(length)
            break
        text(m.start())
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["close"]:
            if name == "a":
                links = max(0, links - 1)
            if name in BLOCK_TAGS:
                flush()
                own, heading, paragraph = 0, False, False
                while depth[name]:
                    last = stack.pop()[0]
                    depth[last] -= 1
                    if last == name:
                        break
            elif name == "br":
                parts.append(" ")
            continue
        if name in RAW_TAGS:
            if not m["attrs"].endswith("/"):
                end = None if name in unclosed else re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if end is None:
                    unclosed.add(name)
                at = end.end() if end else (length if name != "head" else at)
            continue
        if name == "br":
            parts.append(" ")
            linked.append(" ")
        elif name == "a":
            links = 1
        elif name in BLOCK_TAGS:
            flush()
            links = 0
            boiler, inside = (stack[-1][1], stack[-1][2]) if stack else (0, False)
            # names of layout wrappers, and of an article or main itself, say nothing of what it
            # holds; an article inside an article is a comment or a teaser, for which they do
            first = name in MAIN_TAGS and not depth["article"]
            if first and boiler in (NAMED, WHOLLY):
                boiler = WEAK if boiler == WHOLLY and name == "article" else 0
            mine = _boiler(name, m["attrs"], inside, not first)
            heading = name[0] == "h" and name[1:].isdigit()
            paragraph = name in ("p", "blockquote", "pre")
            own = mine if heading or name == "p" else 0
            if name not in ("p", "hr") and not heading and name not in VOID_TAGS:
                stack.append((name, max(boiler, mine), inside or name in MAIN_TAGS))
                depth[name] += 1
    flush()
    held = set(weak)
    if any(b[4] and not b[3] and i not in held for i, b in enumerate(out)):
        for i in weak:
            out[i] = (*out[i][:3], WHOLLY, *out[i][4:])
    return out


def features(found: list[Block]) -> list[tuple]:
    """A row of FEATURES for each block."""
    marked = int(any(b[4] and b[3] < WHOLLY for b in found))
    ends = [0.0, 0.0]
    sizes = [ends, *([float(b[1]), b[2] / b[1]] for b in found), ends]
    return [(*sizes[i + 1], *sizes[i], *sizes[i + 2], int(b[3] == CERTAIN), {NAMED: 0.5, WHOLLY: 1.0}.get(b[3], 0.0), b[4], marked, b[5], b[6]) for i, b in enumerate(found)]


def main_text(page: str | None, root: trees.Node | None = None) -> str:
    if not page:
        return ""
    root = root or tree()
    found = blocks(page)
    lower = page.lower()
    if "<article" in lower and "<main" in lower:  # the narrower element counts
        found = _inside_article(page, found)
    rows = features(found)
    kept = [b[0] for b, row in zip(found, rows) if trees.score(root, row) > 0]
    if not kept:  # a page of a sentence or two: nothing speaks against them but their length
        at = {name: k for k, name in enumerate(FEATURES)}
        kept = [b[0] for b, row in zip(found, rows) if not row[at["shut"]] and not row[at["named"]] and row[at["links"]] < 0.5 and b[0].endswith((".", "!", "?", "…"))]
    return "\n\n".join(kept)


def _inside_article(page: str, found: list[Block]) -> list[Block]:
    narrow = blocks(re.sub(r"<(/?)main\b", r"<\1section", page, flags=re.I))
    if len(narrow) == len(found):
        narrow = [(*a[:4], *b[4:]) for a, b in zip(found, narrow)]
    return narrow if len(narrow) == len(found) and any(b[4] and not b[3] for b in narrow) else found


def _run(root: trees.Node):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x, root) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    return run


def html_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text (main text, '' if none), n_chars.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined in page order by a blank line; `<br>` is white space.

    - null, empty and text-free pages give the empty string; null ids and urls pass through.
    - markup that is cut off or badly nested is read to its end; nothing is truncated.
    - repeated rows each give a row; an empty table gives an empty result; other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(_run(tree()), schema).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
