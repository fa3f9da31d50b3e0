"""HTML extraction: a linear-chain conditional random field over DOM leaf blocks.

A page becomes a sequence of leaf blocks (text between block-level tags, with its open
elements); each block gets features of its ancestor tags, their class and id words, and its
text; the field labels every block main text or not, and Viterbi decodes the whole page.
It is trained on labelled pages drawn from a small grammar of page layouts (``labelled_pages``:
their number is a parameter, so training is bounded), by gradient ascent on the exact
conditional log-likelihood.

Text rules: character references are decoded (each in its own piece of text, so a tag ends
one), white space inside a block (line breaks included) becomes one blank, blocks are trimmed
and joined in page order by an empty line.  Contents of script, style, title, textarea and
iframe (up to their end tag, else to the end of the page), comments and markup are no text.
Media, svg, noscript and template elements hide their contents up to their own end tag; one
that its parent or the page ends first hides nothing, so no text is lost.  Formulas (math) are
text, without their annotations.

Defined cases: null or empty html gives the empty text; a page without text blocks too;
unclosed, stray and badly nested tags are read as browsers do (an end tag closes up to its
element or is ignored); repeated pages give equal rows; an empty table gives an empty result.
Columns other than id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm.shared import per_block, sql_type

# HTML element classes.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea iframe".split())
HIDDEN_TAGS = frozenset("noscript template svg object video audio canvas annotation annotation-xml".split())
#: A start tag of the key closes an open element of the value (up to the nearest of SCOPE).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}} | {x: {"p"} for x in BLOCK_TAGS - {"li", "dt", "dd", "tr", "td", "th", "option", "body", "html", "head", "label", "button", "caption"}}
SCOPE = frozenset("html body article section aside nav main div td th table button ul ol dl form header footer blockquote figure".split())

TELLING = frozenset("article main aside nav header footer form".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
RAW_END = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*>", re.I) for x in RAW_TAGS}
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]     # open elements, outermost first: tag and its class words
    links: int                # characters inside links
    inline: frozenset[str]


def page_tags(page: str) -> list[tuple[int, int, str | None, bool, str]]:
    """(start, end, name, closing, attributes) of the tags in page order; name None: a comment, a
    declaration, or a raw element with its contents."""
    out, pos, n = [], 0, len(page)
    while pos < n:
        m = TOKEN.search(page, pos)
        if m is None:
            break
        pos = m.end()
        name = m[2] or m[5]
        tag, close, rest = name.lower() if name else None, bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW_TAGS and not close:
            if not rest.endswith("/"):
                end = RAW_END[tag].search(page, pos)
                pos = end.end() if end else n
            tag = None
        out.append((m.start(), pos, tag, close, rest))
    return out


def hidden_spans(tags: list[tuple[int, int, str | None, bool, str]]) -> dict[int, int]:
    """Tag number -> number of its end tag, of the hidden elements that are closed by their own end
    tag.  One that its parent or the page ends first was left open by mistake and hides nothing."""
    spans: dict[int, int] = {}
    if not any(x[2] in HIDDEN_TAGS for x in tags):
        return spans
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    for i, (_, _, tag, close, rest) in enumerate(tags):
        if tag is None or tag in VOID_TAGS:
            continue
        if not close:
            if not rest.endswith("/"):
                stack.append((tag, i))
                opened[tag] += 1
        elif opened[tag]:
            top, at = stack.pop()
            opened[top] -= 1
            while top != tag:
                top, at = stack.pop()
                opened[top] -= 1
            if tag in HIDDEN_TAGS:
                spans[at] = i
    return spans


def page_blocks(page: str) -> list[Block]:
    """Leaf blocks in page order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []          # (tag, "tag word word")
    opened: Counter[str] = Counter()           # the tags on the stack
    parts: list[str] = []
    links, inline, pos, n = 0, set(), 0, len(page)

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, tuple(x[1] for x in stack if x[0] in BLOCK_TAGS), links, frozenset(inline)))
            parts.clear()
        links = 0
        inline.clear()

    def say(a: int, b: int) -> None:
        nonlocal links
        if a < b:
            parts.append(entities.unescape(page[a:b]))  # a reference ends with its piece of text
            if opened["a"]:
                links += b - a
            inline.update(x for x, k in opened.items() if k and x not in BLOCK_TAGS)

    def leave(at: int) -> None:
        for x in stack[at:]:
            opened[x[0]] -= 1
        del stack[at:]

    tags = page_tags(page)
    hidden = hidden_spans(tags)
    i = 0
    while i < len(tags):
        start, end, tag, close, rest = tags[i]
        say(pos, start)
        pos, here, i = end, i, i + 1
        if tag is None:
            continue
        if close:
            if not opened[tag]:
                if tag in BLOCK_TAGS:
                    flush()
                continue
            at = next(j for j in range(len(stack) - 1, -1, -1) if stack[j][0] == tag)
            if any(x[0] in BLOCK_TAGS for x in stack[at:]):
                flush()
            leave(at)
            continue
        if tag in HIDDEN_TAGS:
            if here in hidden:
                i = hidden[here] + 1
                pos = tags[i - 1][1]
            continue
        if tag in BLOCK_TAGS:
            flush()
            closing = CLOSES.get(tag)
            if closing:
                for j in range(len(stack) - 1, -1, -1):
                    if stack[j][0] in closing:
                        leave(j)
                        break
                    if stack[j][0] in SCOPE:
                        break
        if tag in VOID_TAGS:
            if tag == "br":
                parts.append(" ")
            continue
        if rest.endswith("/"):
            continue
        words = []
        if "=" in rest:
            for a in ATTRIBUTE.finditer(rest):
                words += NAME_PART.findall((a[1] or a[2] or a[3] or "").lower())
        stack.append((tag, " ".join([tag, *words])))
        opened[tag] += 1
    say(pos, n)
    flush()
    return out


def path_features(path: tuple[str, ...]) -> list[str]:
    out = set()
    for depth, x in enumerate(path):
        tag, *words = x.split(" ")
        out.add("in:" + tag)
        out.update("name:" + w for w in words)
        if depth == len(path) - 1:
            out.add("own:" + tag)
    for x in reversed(path):  # the innermost element that says what it is
        tag, *words = x.split(" ")
        if words or tag in TELLING:
            out.update("near:" + w for w in (words or [tag]))
            break
    return sorted(out)


def text_features(b: Block, place: int, total: int) -> list[str]:
    words = b.text.count(" ") + 1
    share = b.links / max(1, len(b.text))
    return [
        "bias",
        f"words:{min(words, 400).bit_length()}",
        f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
        f"ends:{b.text[-1] in '.!?…”\"'}",
        f"mark:{b.text[0] in '©|»›·•' or '©' in b.text}",
        f"place:{min(3, 4 * place // max(1, total))}",
        *("inline:" + x for x in sorted(b.inline)),
    ]


def features(page: str) -> tuple[list[Block], list[tuple[tuple[str, ...], list[str]]]]:
    own = page_blocks(page)
    return own, [(b.path, text_features(b, i, len(own))) for i, b in enumerate(own)]


# ---- labelled pages ----------------------------------------------------------------------

MAIN, OTHER = "\ue001", "\ue002"  # label marks in generated text (private use); taken off before features


class _Grammar:
    """Draws pages: each text run starts with its label mark."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, a: int, b: int) -> str:
        w = ["".join(self.r.choices("abcdefghijklmnoprstuvwz", k=self.r.randint(1, 9))) for _ in range(self.r.randint(a, b))]
        return " ".join(w).capitalize()

    def sentence(self, a: int, b: int) -> str:
        return self.words(a, b) + self.r.choice(["."] * 8 + ["!", "?", "", ""])

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def prose(self, mark: str, a: int = 1, b: int = 8) -> str:
        out = []
        for _ in range(self.r.randint(a, b)):
            kind = self.r.random()
            text = mark + self.sentence(*self.pick((1, 4), (4, 20), (20, 120), (20, 200)))
            if kind < 0.62:
                out.append(self.pick("<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p><a href='/x'>{}</a></p>", "<p class='lead'>{}</p>", "<div>{}</div>").format(text))
            elif kind < 0.74:
                out.append(self.pick("<h2>{}</h2>", "<h3>{}</h3>", "<h4 id='part'>{}</h4>").format(mark + self.words(1, 9)))
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{mark}{self.sentence(1, 25)}</li>" for _ in range(self.r.randint(1, 5))) + "</ul>")
            elif kind < 0.9:
                out.append(self.pick("<blockquote>{}</blockquote>", "<blockquote><p>{}</p></blockquote>", "<pre>{}</pre>", "<figure><img src='i.png'><figcaption>{}</figcaption></figure>").format(text))
            elif kind < 0.95:
                out.append("<table>" + "".join(f"<tr><td>{mark}{self.words(1, 4)}</td><td>{mark}{self.words(1, 6)}</td></tr>" for _ in range(self.r.randint(1, 4))) + "</table>")
            else:
                out.append(f"<dl><dt>{mark}{self.words(1, 3)}</dt><dd>{mark}{self.sentence(3, 20)}</dd></dl>")
        return "".join(out)

    def links(self, a: int = 2, b: int = 8) -> str:
        return "<ul>" + "".join(f"<li><a href='/{i}'>{OTHER}{self.words(1, 4)}</a></li>" for i in range(self.r.randint(a, b))) + "</ul>"

    def box(self, names: str, tags: str = "div section aside") -> str:
        name, tag = self.pick(*names.split()), self.pick(*tags.split())
        attr = self.pick(f'class="{name}"', f'id="{name}"', f"class='{name} box'", f'class="wide {name}"')
        inner = self.pick("text", "prose", "prose", "links", "head")
        if inner == "text":
            body = OTHER + self.sentence(2, 40)
        elif inner == "links":
            body = self.links()
        elif inner == "head":
            body = f"<h3>{OTHER}{self.words(1, 4)}</h3>" + self.prose(OTHER, 1, 2)
        else:
            body = self.prose(OTHER, 1, 4)
        return f"<{tag} {attr}>{body}</{tag}>"

    def clutter(self) -> str:
        kind = self.r.randrange(9)
        if kind == 0:
            return self.box("ad ads advert advertisement sponsor sponsored promo banner adbox")
        if kind == 1:
            return self.box("sidebar related recommended trending widget aside links more")
        if kind == 2:
            return self.box("notice cookie cookies consent alert message popup modal newsletter subscribe privacy gdpr")
        if kind == 3:
            return self.box("share social breadcrumb breadcrumbs pagination pager tags toolbar")
        if kind == 4:
            return f"<form action='/s'><label>{OTHER}{self.words(1, 3)}</label><input name='q'><button>{OTHER}{self.words(1, 2)}</button>{OTHER}{self.words(1, 12)}</form>"
        if kind == 5:
            return f"<aside>{self.prose(OTHER, 1, 4)}</aside>"
        if kind == 6:
            return f"<nav>{self.links()}</nav>"
        if kind == 7:
            return f"<div role='{self.pick('navigation', 'complementary', 'banner', 'contentinfo', 'search')}'>{self.pick(self.links(), self.prose(OTHER, 1, 2))}</div>"
        return self.pick("<script>var a='<p>x</p>';</script>", "<style>p{margin:0}</style>", "<!-- part -->", "<noscript>x</noscript>")

    def comments(self) -> str:
        name = self.pick("comments", "comment", "replies", "discussion", "responses", "disqus")
        each = "".join(self.pick(f"<div class='comment'>{self.prose(OTHER, 1, 2)}</div>", f"<li class='comment'><p>{OTHER}{self.sentence(3, 80)}</p></li>",
                                 f"<article class='comment'><p>{OTHER}{self.sentence(3, 80)}</p></article>", f"<p>{OTHER}{self.sentence(3, 80)}</p>") for _ in range(self.r.randint(1, 5)))
        tag = self.pick("section", "div", "ol")
        return f"<{tag} {self.pick('class', 'id')}='{name}'><h3>{OTHER}{self.words(1, 3)}</h3>{each}</{tag}>"

    def page(self) -> str:
        top = self.pick("", f"<header><h1>{OTHER}{self.words(1, 4)}</h1><p>{OTHER}{self.words(2, 8)}</p>{self.pick('', '<nav>' + self.links() + '</nav>')}</header>",
                        f"<div class='header'>{self.prose(OTHER, 1, 2)}</div>", f"<div id='{self.pick('masthead', 'top', 'topbar', 'header')}'>{OTHER}{self.words(1, 6)}</div>")
        menu = self.pick("", f"<nav>{self.links()}</nav>", f"<nav>{self.links()}</nav>", f"<nav class='menu'>{self.links()}</nav>", f"<div class='{self.pick('menu', 'nav', 'navbar', 'navigation')}'>{self.links()}</div>",
                         f"<ul class='menu'>{''.join(f'<li><a href=/{i}>{OTHER}{self.words(1, 3)}</a></li>' for i in range(4))}</ul>")
        title = self.pick("", f"<h1>{MAIN}{self.words(2, 40)}</h1>", f"<h1>{MAIN}{self.words(2, 12)}</h1>", f"<h1 class='title'>{MAIN}{self.words(2, 12)}</h1>")
        body = title
        for _ in range(self.r.randint(1, 3)):
            body += self.prose(MAIN)
            if self.r.random() < 0.3:
                body += self.clutter()
        if self.r.random() < 0.15:
            body += f"<footer>{OTHER}{self.sentence(1, 12)}</footer>"
        if self.r.random() < 0.15:
            body += self.comments()
        name = self.pick("content", "article", "post", "entry", "main", "story", "text", "body")
        wrap = self.pick("<article>{}</article>", "<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>", "<main id='main'>{}</main>",
                         f"<div class='{name}'>{{}}</div>", f"<div id='{name}'>{{}}</div>", f"<article class='{name}'>{{}}</article>", f"<section class='{name}'>{{}}</section>", "<div role='main'>{}</div>")
        side = [self.clutter() for _ in range(self.r.randint(0, 3))]
        after = [self.clutter() for _ in range(self.r.randint(0, 2))] + ([self.comments()] if self.r.random() < 0.3 else [])
        foot = self.pick(f"<footer>&copy; {OTHER}{self.words(1, 3)} &middot; {self.sentence(2, 20)}</footer>", f"<footer>&copy; {OTHER}{self.sentence(2, 20)}</footer>",
                         f"<footer>{self.links()}<p>{OTHER}{self.sentence(2, 20)}</p></footer>", f"<div class='footer'>{self.prose(OTHER, 1, 2)}</div>", "")
        inner = top + menu + "".join(side) + wrap.format(body) + "".join(after) + foot
        inner = self.pick("{}", "{}", "<div class='page'>{}</div>", "<div id='wrapper'>{}</div>", "<div class='container'>{}</div>").format(inner)
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{inner}" + self.pick("</body></html>", "")


def labelled_pages(n: int, seed: int = 0) -> list[str]:
    g = _Grammar(seed)
    return [g.page() for _ in range(n)]


def labels_and_clean(page: str) -> tuple[list[int], list[tuple[tuple[str, ...], list[str]]], list[str]]:
    """Labels of the blocks of a generated page; features and texts as if the marks were not there."""
    own = page_blocks(page)
    y = [int(MAIN in b.text) for b in own]
    for b in own:
        b.text = b.text.replace(MAIN, "").replace(OTHER, "").strip() or "-"
    return y, [(b.path, text_features(b, i, len(own))) for i, b in enumerate(own)], [b.text for b in own]


# ---- the field ---------------------------------------------------------------------------

@dataclass
class Field:
    """Weights of a two-label linear chain (difference main - other for block features)."""
    weights: dict[str, float]
    step: np.ndarray               # 2 x 2 transition weights
    known: dict = field(default_factory=dict)  # score of each ancestor path seen so far

    def emission(self, path: tuple[str, ...], own: list[str]) -> float:
        base = self.known.get(path)
        if base is None:
            if len(self.known) > 20_000:
                self.known.clear()
            base = self.known[path] = sum(self.weights.get(x, 0.0) for x in path_features(path))
        return base + sum(self.weights.get(x, 0.0) for x in own)

    def decode(self, feats) -> list[int]:
        """Viterbi."""
        if not feats:
            return []
        (a00, a01), (a10, a11) = self.step.tolist()
        s0, s1, back = 0.0, self.emission(*feats[0]), []
        for path, own in feats[1:]:
            e = self.emission(path, own)
            f0, f1 = s0 + a00 < s1 + a10, s0 + a01 < s1 + a11
            back.append((f0, f1))
            s0, s1 = (s1 + a10 if f0 else s0 + a00), (s1 + a11 if f1 else s0 + a01) + e
        y = [int(s1 > s0)]
        for b in reversed(back):
            y.append(int(b[y[-1]]))
        return y[::-1]


def train_field(pages: int = 1200, seed: int = 7, rounds: int = 120, ridge: float = 0.02) -> Field:
    """Maximises the conditional log-likelihood (forward-backward, all pages at once, Adam)."""
    data = [labels_and_clean(p)[:2] for p in labelled_pages(pages, seed)]
    data = [(y, f) for y, f in data if y]
    names = sorted({x for _, f in data for path, own in f for x in [*path_features(path), *own]})
    place = {x: i for i, x in enumerate(names)}
    longest = max(len(y) for y, _ in data)
    rows, cols, seat = [], [], []
    labels = np.zeros((len(data), longest), np.int64)
    mask = np.zeros((len(data), longest), bool)
    for i, (y, f) in enumerate(data):
        labels[i, : len(y)], mask[i, : len(y)] = y, True
        for t, (path, own) in enumerate(f):
            at = {place[x] for x in [*path_features(path), *own]}
            rows += [len(seat)] * len(at)
            cols += sorted(at)
            seat.append((i, t))
    rows, cols, seat = np.array(rows), np.array(cols), np.array(seat)
    w, step = np.zeros(len(names)), np.zeros((2, 2))
    m1, m2, s1, s2 = np.zeros_like(w), np.zeros_like(w), np.zeros((2, 2)), np.zeros((2, 2))
    ends = mask.sum(axis=1) - 1
    for k in range(1, rounds + 1):
        e = np.zeros((len(data), longest, 2))
        e[seat[:, 0], seat[:, 1], 1] = np.bincount(rows, weights=w[cols], minlength=len(seat))
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, longest):
            alpha[:, t] = e[:, t] + np.logaddexp(alpha[:, t - 1, :1] + step[0], alpha[:, t - 1, 1:] + step[1])
        for t in range(longest - 2, -1, -1):
            nxt = e[:, t + 1] + beta[:, t + 1]
            beta[:, t] = np.where(mask[:, t + 1, None], np.logaddexp(nxt[:, :1] + step[:, 0], nxt[:, 1:] + step[:, 1]), 0.0)
        z = np.logaddexp.reduce(alpha[np.arange(len(data)), ends], axis=1)
        p1 = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None])
        gap = (labels - p1)[seat[:, 0], seat[:, 1]]
        g = np.bincount(cols, weights=gap[rows], minlength=len(names)) / len(data) - ridge * w / len(data)
        gs = np.zeros((2, 2))
        pair = mask[:, 1:]
        for a in range(2):
            for b in range(2):
                want = ((labels[:, :-1] == a) & (labels[:, 1:] == b) & pair).sum()
                p = np.exp(alpha[:, :-1, a] + step[a, b] + e[:, 1:, b] + beta[:, 1:, b] - z[:, None])
                gs[a, b] = (want - p[pair].sum()) / len(data) - ridge * step[a, b] / len(data)
        for x, grad, u, v in ((w, g, m1, m2), (step, gs, s1, s2)):
            u += 0.1 * (grad - u)
            v += 0.01 * (grad * grad - v)
            x += 0.25 * (u / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Field(dict(zip(names, w.tolist())), step)


def main_text(page: str | None, model: Field) -> str:
    own, feats = features(page or "")
    return "\n\n".join(b.text for b, y in zip(own, model.decode(feats)) if y)


def extract_main_text(pages: DataFrame, model: Field, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) per page."""
    def run(t: pa.Table) -> pa.Table:
        texts = [main_text(x, model) for x in t.column("h").to_pylist()]
        return pa.table({"k": t.column("k"), "u": t.column("u"), "text": pa.array(texts, pa.string()),
                         "n_chars": pa.array([len(x) for x in texts], pa.int64())})

    out = per_block(pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(html).alias("h")), "h", run,
                    f"k {sql_type(pages, key)}, u {sql_type(pages, url)}, text string, n_chars long")
    return out.withColumnRenamed("k", key).withColumnRenamed("u", url)
