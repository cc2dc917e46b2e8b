"""Main-text extraction: boosted trees over DOM nodes, decoded by hierarchy.

A page is parsed into block nodes (elements that lay out as boxes) with the
text, links and inline markup they hold.  Every node gets features: share and
density of text, links and paragraphs in its subtree, depth, place among its
siblings, their sizes, and signs for words in its tag, class, id and role and
in its ancestors'.  Gradient-boosted trees, grown here on histograms of the
features with logistic loss, give the chance that a node belongs to the article.

Training pages are a bounded sample of the given ones, of any length (``SAMPLE_``
figures bound what is taken of each).  Their article and
page furniture are set anew into layouts of many kinds (other wrappers, names,
orders, sidebars, notices, forms, comments), so that labels are known by how
a page was made and features do not hinge on one template.

Decoding goes down the tree: for each node the better of "this whole subtree is
furniture" and the sum over its children and own text is kept, so no
descendant of a dropped node is kept and no article node hangs below a dropped
one.  Scripts, styles, forms and the like never have text.

Cases: null html is empty; pages without kept text give the empty string;
unclosed tags end as browsers end them, and a cut-off tag at the end is
ignored; very long pages are read whole; repeated rows get equal rows; with no
page to learn from all text is kept; other columns but page_id and url are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatcast.llm.common import least_hashes

# Training: pages learned from; of each, article blocks in a row and other texts; characters of a text.
SAMPLE, SAMPLE_BLOCKS, SAMPLE_TEXTS, SAMPLE_CHARS = 300, 100, 100, 2_000
COMPOSED_BLOCKS, NAME_TEXTS, NAME_WORDS = 40, 2_000, 8    # blocks of a made-up page; texts and words of each for its names
ROUNDS, DEPTH, RATE, BINS, LEAST, L2 = 60, 4, 0.25, 32, 10, 1.0

# Fixed values of the HTML language.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li legend main menu nav ol p pre
    section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes".split())
QUIET = frozenset("template svg button select option object canvas audio video datalist".split())    # inline, text dropped
SILENT = RAW | QUIET | {"head", "form"}
NODES = BLOCKS | {"head", "xmp"}           # elements that are nodes
ENDS_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "dd", "dt", "li", "legend", "summary"} | {"li", "dd", "dt"}
SAME = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
# Words of tags, classes, ids and roles, by what they hint at.
HINTS = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs pagination pager toc sitemap topbar toolbar",
    "head": "header masthead banner branding logo hero top",
    "foot": "footer foot copyright colophon contentinfo legal bottom",
    "side": "sidebar aside side rail widget related recommended popular trending complementary more teaser",
    "note": "cookie cookies consent notice alert gdpr popup modal overlay newsletter subscribe signup message privacy",
    "ad": "ad ads advert advertisement adverts sponsor sponsored promo promotion banner-ad adsense adslot adbox commercial",
    "talk": "comment comments reply replies discussion disqus respond commentlist thread reader responses",
    "share": "share social sharing follow tags meta byline buttons toolbar login search searchform",
    "text": "article content post entry story body main text maincontent articlebody post-content entry-content prose page",
}
HINT_OF = {w: k for k, words in HINTS.items() for w in words.split()}
HINT_NO = {k: i for i, k in enumerate(HINTS)}
TAGS = ("p", "h", "li", "ul", "div", "section", "article", "main", "nav", "header", "footer", "aside", "td", "blockquote", "pre", "body")
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
CUT_OFF = re.compile(r"<[a-zA-Z/!][^<>]*$")
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    hints: int = 0                     # bit set of HINT_NO
    items: list = field(default_factory=list)   # own text (str) and child numbers (int), in order
    links: int = 0                     # characters of own text inside links
    silent: bool = False
    label: int = 0


def hints_of(tag: str, attrs: str) -> int:
    found = 0
    words = [tag]
    for m in ATTR.finditer(attrs):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower()
        words += value.split()
        words += WORDS.findall(value)
    for w in words:
        if w in HINT_OF:
            found |= 1 << HINT_NO[HINT_OF[w]]
    return found


def parse(html: str) -> list[Node]:
    """The block nodes of a page in document order, node 0 the page itself."""
    nodes = [Node("html", -1, 0)]
    stack: list[tuple[str, int]] = [("html", 0)]      # open elements and the block each one writes to
    in_link = quiet = 0
    pos, end = 0, len(html)
    cut = CUT_OFF.search(html[-2000:])
    if cut:
        end = max(0, len(html) - 2000) + cut.start()

    def put(text: str):
        node = nodes[stack[-1][1]]
        if quiet:
            return
        node.items.append(text)
        if in_link:
            node.links += len(text.strip())

    def close(upto: int):
        nonlocal in_link, quiet
        while len(stack) > upto:
            tag, _ = stack.pop()
            in_link -= tag == "a"
            quiet -= tag in SILENT

    while pos < end:
        m = TOKEN.search(html, pos, end)
        if m is None:
            put(html[pos:end])
            break
        if m.start() > pos:
            put(html[pos:m.start()])
        pos = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if stack[k][0] in ("td", "th", "table") and tag not in BLOCKS:
                    break
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                close(next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == "p"), len(stack)))
            continue
        if tag in ("html", "body"):
            nodes[0].hints |= hints_of("", m[3])
            continue
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if tag in SAME:
            shut, stop = SAME[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in shut:
                    close(k)
                    break
                if stack[k][0] in stop:
                    break
        if tag in RAW:
            shut = re.compile(rf"</{tag}\s*>", re.I).search(html, pos, end)
            pos = shut.end() if shut else end
            continue
        block = stack[-1][1]
        if tag in NODES:
            node = Node(tag, block, nodes[block].depth + 1, hints_of(tag, m[3]), silent=tag in SILENT)
            nodes[block].items.append(len(nodes))
            block = len(nodes)
            nodes.append(node)
        stack.append((tag, block))
        in_link += tag == "a"
        quiet += tag in SILENT
        if tag == "xmp":                   # its content is text as it stands
            shut = re.compile(r"</xmp\s*>", re.I).search(html, pos, end)
            put(escape(html[pos:shut.start() if shut else end]))
            pos = shut.end() if shut else end
            close(len(stack) - 1)
        elif m[3].endswith("/") and (tag in ("object", "template") or any(t in ("svg", "math") for t, _ in stack)):
            close(len(stack) - 1)          # drawings and formulas take the slash at its word
    return nodes


def own_lines(node: Node) -> list:
    """Text lines and child numbers of a node: inline text between two child
    blocks is one line, white space made one blank, ends trimmed."""
    out, run = [], []
    for it in [*node.items, -1]:
        if isinstance(it, str):
            run.append(it)
            continue
        if run:
            line = SPACE.sub(" ", unescape("".join(run))).strip()
            if line:
                out.append(line)
            run = []
        if it >= 0:
            out.append(it)
    return out


N_FEATURES = 14 + 2 * len(HINTS) + len(TAGS) + 4


def features(nodes: list[Node]) -> tuple[np.ndarray, list[list], np.ndarray]:
    """(nodes, N_FEATURES), each node's lines and child numbers, own characters."""
    n = len(nodes)
    lines = [own_lines(x) for x in nodes]
    own = np.array([sum(len(t) for t in ls if isinstance(t, str)) for ls in lines], float)
    text, link = own.copy(), np.array([x.links for x in nodes], float)
    paras = np.array([x.tag == "p" for x in nodes], float) * (own > 0)
    items = np.array([x.tag == "li" for x in nodes], float)
    stops = np.array([sum(t.count(".") + t.count(",") for t in ls if isinstance(t, str)) for ls in lines], float)
    size = np.ones(n)
    for i in range(n - 1, 0, -1):            # children follow their parent
        p = nodes[i].parent
        for a in (text, link, paras, items, stops, size):
            a[p] += a[i]
    total = max(text[0], 1)
    kids = np.zeros(n)
    before = np.zeros(n)
    seen = np.zeros(n)                       # text before the node in the page
    run = 0.0
    above = np.zeros(n, np.int64)
    for i, x in enumerate(nodes):
        seen[i] = run
        run += own[i]
        if i:
            p = x.parent
            before[i] = kids[p]
            kids[p] += 1
            above[i] = above[p] | nodes[p].hints
    parent = np.array([max(x.parent, 0) for x in nodes])
    f = np.zeros((n, N_FEATURES), np.float32)
    cols = [np.log1p(text), text / total, link / np.maximum(text, 1), text / size, np.log1p(own), own / np.maximum(text, 1),
            paras / size, items / size, stops / np.maximum(text, 1), np.array([x.depth for x in nodes], float), before,
            kids[parent] - before, seen / total, text / np.maximum(text[parent], 1)]
    tag_no = {t: k for k, t in enumerate(TAGS)}
    for k, c in enumerate(cols):
        f[:, k] = c
    at = len(cols)
    for i, x in enumerate(nodes):
        h, a = x.hints, above[i]
        for k in range(len(HINTS)):
            f[i, at + k] = h >> k & 1
            f[i, at + len(HINTS) + k] = a >> k & 1
        t = "h" if len(x.tag) == 2 and x.tag[0] == "h" and x.tag[1].isdigit() else x.tag
        if t in tag_no:
            f[i, at + 2 * len(HINTS) + tag_no[t]] = 1
    at += 2 * len(HINTS) + len(TAGS)
    f[1:, at] = np.log1p(text[:-1]) * (parent[1:] == parent[:-1])           # the sibling before, if a leaf
    f[:-1, at + 1] = np.log1p(own[1:])                                       # the node after
    f[:, at + 2] = np.log1p(paras[parent])
    f[:, at + 3] = link[parent] / np.maximum(text[parent], 1)
    return f, lines, own


@dataclass
class Trees:
    """Boosted regression trees of equal depth, as arrays."""
    edges: list[np.ndarray]
    column: np.ndarray      # (trees, inner nodes)
    split: np.ndarray       # bins: to the right if greater
    leaf: np.ndarray        # (trees, leaves)
    base: float

    def bins(self, f: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, f[:, k], "left") for k, e in enumerate(self.edges)], 1).astype(np.uint8)

    def logits(self, f: np.ndarray) -> np.ndarray:
        b, rows = self.bins(f), np.arange(len(f))
        z = np.full(len(f), self.base)
        for col, cut, leaf in zip(self.column, self.split, self.leaf):
            at = np.zeros(len(f), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[rows, col[at]] > cut[at])
            z += leaf[at - (2 ** DEPTH - 1)]
        return z


def boost(f: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Newton boosting with logistic loss on binned features."""
    edges = [np.unique(np.quantile(f[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(f.shape[1])]
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    t = Trees(edges, np.zeros((0, 2 ** DEPTH - 1), int), np.zeros((0, 2 ** DEPTH - 1), int), np.zeros((0, 2 ** DEPTH)),
              float(np.log(share / (1 - share))))
    b = t.bins(f)
    n_f = f.shape[1]
    z = np.full(len(y), t.base)
    flat = b.astype(np.int64) + np.arange(n_f) * BINS
    columns, splits, leaves = [], [], []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), np.int64)
        col, cut = np.zeros(2 ** DEPTH - 1, int), np.full(2 ** DEPTH - 1, 255)
        for level in range(DEPTH):
            for node in range(2 ** level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) >= 2 * LEAST:
                    idx = flat[rows].ravel()
                    gs = np.bincount(idx, np.repeat(g[rows], n_f), n_f * BINS).reshape(n_f, BINS).cumsum(1)
                    hs = np.bincount(idx, np.repeat(h[rows], n_f), n_f * BINS).reshape(n_f, BINS).cumsum(1)
                    cs = np.bincount(idx, minlength=n_f * BINS).reshape(n_f, BINS).cumsum(1)
                    g_all, h_all = gs[:, -1:], hs[:, -1:]
                    gain = gs ** 2 / (hs + L2) + (g_all - gs) ** 2 / (h_all - hs + L2) - g_all ** 2 / (h_all + L2)
                    gain[(cs < LEAST) | (len(rows) - cs < LEAST)] = 0
                    best = int(gain.argmax())
                    if gain.ravel()[best] > 1e-6:
                        col[node], cut[node] = divmod(best, BINS)
                at[rows] = 2 * node + 1 + (b[rows, col[node]] > cut[node])
        at -= 2 ** DEPTH - 1
        leaf = -RATE * np.bincount(at, g, 2 ** DEPTH) / (np.bincount(at, h, 2 ** DEPTH) + L2)
        z += leaf[at]
        columns.append(col)
        splits.append(cut)
        leaves.append(leaf)
    return Trees(edges, np.array(columns), np.array(splits), np.array(leaves), t.base)


def decode(nodes: list[Node], lines: list[list], own: np.ndarray, z: np.ndarray) -> np.ndarray:
    """keep (bool) per node: the labelling of greatest total log-odds (weighed
    by own text) in which a node is kept only below kept nodes."""
    value = z * np.sqrt(np.maximum(own, 0) + 1)
    best = value.copy()
    for i in range(len(nodes) - 1, 0, -1):
        if nodes[i].silent:
            best[i] = -np.inf
        elif best[i] > 0:
            best[nodes[i].parent] += best[i]
    keep = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):            # the page itself is kept; its own text only if its log-odds say so
        keep[i] = i == 0 or (keep[x.parent] and best[i] > 0 and not x.silent)
    return keep


def render(nodes: list[Node], lines: list[list], keep: np.ndarray, root_text: bool = True) -> str:
    out = []
    stack = [iter(lines[0])]
    at = [0]
    while stack:
        for it in stack[-1]:
            if isinstance(it, str):
                if at[-1] or root_text:
                    out.append(it)
            elif keep[it]:
                stack.append(iter(lines[it]))
                at.append(it)
                break
        else:
            stack.pop()
            at.pop()
    return "\n".join(out)


def extract(pages: list[str | None], model: Trees | None) -> list[str]:
    parsed = [parse(h or "") for h in pages]
    found = [features(p) for p in parsed]
    if model is None:
        return [render(p, ls, np.array([not x.silent for x in p])) for p, (_, ls, _) in zip(parsed, found)]
    z = model.logits(np.concatenate([f for f, *_ in found])) if found else np.zeros(0)
    out, at = [], 0
    for p, (_, lines, own) in zip(parsed, found):
        zs = z[at:at + len(p)]
        at += len(p)
        out.append(render(p, lines, decode(p, lines, own, zs), zs[0] > 0))
    return out


# --- training pages -----------------------------------------------------------------------------------------------

def _article_and_rest(html: str) -> tuple[list[tuple[str, str]], list[str]]:
    """Block texts of a page's article ((tag, text) in order) and short texts
    of its furniture: by <article>/<main> where there is one, else by paragraphs."""
    nodes = parse(html)
    lines = [own_lines(x) for x in nodes]
    inside = np.zeros(len(nodes), bool)
    bad = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):
        p = x.parent
        inside[i] = x.tag in ("article", "main") or (p >= 0 and inside[p])
        bad[i] = x.silent or x.tag in ("nav", "footer", "aside", "header", "form") or (p >= 0 and bad[p])
    if not inside.any():
        inside = ~bad
    text, rest = [], []
    for x, ls, good in zip(nodes, lines, inside & ~bad):
        for t in ls:
            if isinstance(t, str):
                if good:
                    text.append((x.tag if x.tag in ("p", "h1", "h2", "h3", "li", "blockquote", "pre") else "p", t))
                elif not x.silent:
                    rest.append(t)
    return text, rest


def _names(rng, kind: str) -> str:
    """An attribute that a page maker might give a box of this kind (or none)."""
    words = HINTS[kind].split()
    w = words[rng.integers(len(words))]
    if rng.random() < 0.3:
        w += rng.choice(["-box", "-area", " clearfix", "-wrap", "_1", "-list", " widget"])
    return f' {rng.choice(["class", "id", "class", "class"])}="{w}"'


def compose(rng, article: list[tuple[str, str]], texts: list[str], words: list[str]) -> tuple[str, set[str]]:
    """A page around the article, with furniture made of other pages' texts;
    and the marks of the article's blocks (``data-a``)."""
    pick = lambda k: [escape(texts[rng.integers(len(texts))]) for _ in range(k)]
    word = lambda: escape(words[rng.integers(len(words))])

    def box(tags, kind, inner, plain=0.15):
        tag = tags[rng.integers(len(tags))]
        name = "" if tag not in ("div", "section", "ul", "p") and rng.random() < 0.5 or rng.random() < plain * (tag not in ("div", "p")) \
            else _names(rng, kind)
        return f"<{tag}{name}>{inner}</{tag}>"

    def link_list(k):
        links = [f'<a href="/{j}">{" ".join(word() for _ in range(rng.integers(1, 4)))}</a>' for j in range(k)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>" if rng.random() < 0.7 else " | ".join(links)

    def menu(): return box(["nav", "div", "ul", "nav"], "menu", link_list(rng.integers(3, 9)))
    def head(): return box(["header", "div"], "head", f"<h1>{word()}</h1>" * (rng.random() < 0.4) + (menu() if rng.random() < 0.6 else f"<p>{pick(1)[0]}</p>"))
    def foot(): return box(["footer", "div", "footer"], "foot", (f"<p>{pick(1)[0]}</p>" if rng.random() < 0.5 else "&copy; 2020 " + pick(1)[0]) + (link_list(3) if rng.random() < 0.4 else ""))
    def side(): return box(["aside", "div", "aside"], "side", f"<h3>{word()}</h3>" * (rng.random() < 0.6) + (link_list(rng.integers(3, 7)) if rng.random() < 0.6 else "".join(f"<p>{t}</p>" for t in pick(rng.integers(1, 4)))))
    def note(): return box(["div", "section", "p", "div"], "note", "".join(f"<p>{t}</p>" for t in pick(rng.integers(1, 3))) if rng.random() < 0.5 else pick(1)[0])
    def ad(): return box(["div", "div", "section", "aside", "p"], "ad", pick(1)[0] if rng.random() < 0.6 else f"<p>{pick(1)[0]}</p><a href='#'>{word()}</a>")
    def share(): return box(["div", "ul", "div"], "share", link_list(rng.integers(2, 5)))
    def form(): return f"<form{_names(rng, 'share')}><label>{word()}</label><input name=q><p>{pick(1)[0]}</p><button>{word()}</button></form>"

    def talk():
        many = [box(["div", "li", "article", "div"], "talk", (f"<b>{word()}</b>" if rng.random() < .5 else "") + "".join(
            f"<p>{t}</p>" for t in pick(rng.integers(1, 4)))) for _ in range(rng.integers(1, 6))]
        return box(["section", "div", "ol", "div", "aside"], "talk", f"<h2>{word()}</h2>" * (rng.random() < .6) + "".join(many))

    marked = lambda tag, t: f"<{tag} data-a>{t}</{tag}>"
    body, plain_div = [], rng.random() < 0.12
    for tag, t in article:
        t = escape(t)
        if tag == "p" and plain_div:
            tag = "div"
        if rng.random() < 0.1:
            cut = t.split(" ")
            k = rng.integers(0, len(cut))
            cut[k] = rng.choice(["<b>{}</b>", "<a href='/x'>{}</a>", "<i>{}</i>"]).format(cut[k])
            t = " ".join(cut)
        if tag == "p" and rng.random() < 0.04:
            body.append(f"<ul data-a>{''.join(marked('li', x) for x in t.split('. '))}</ul>")
        elif tag == "p" and rng.random() < 0.04:
            body.append(f"<blockquote data-a>{marked('p', t)}</blockquote>")
        elif tag == "p" and rng.random() < 0.04:
            body.append(marked("h2", t[:60]))
        else:
            body.append(marked(tag, t))
    for make, chance in ((ad, .25), (share, .15), (note, .1), (side, .1)):
        if rng.random() < chance:
            body.insert(int(rng.integers(0, len(body) + 1)), make())
    inner = "".join(body)
    wrap = rng.integers(7)
    if wrap == 0:
        inner = f"<article data-a>{inner}</article>"
    elif wrap == 1:
        inner = f"<main data-a><article data-a>{inner}</article></main>"
    elif wrap in (2, 3):
        inner = f"<div data-a{_names(rng, 'text')}>{inner}</div>"
    elif wrap == 4:
        inner = f"<main data-a{_names(rng, 'text')}>{inner}</main>"
    elif wrap == 5:
        inner = f"<section data-a>{inner}</section>"
    tail = [m() for m, chance in ((share, .25), (talk, .45), (side, .4), (form, .2), (ad, .3)) if rng.random() < chance]
    lead = [m() for m, chance in ((note, .3), (head, .5), (menu, .6), (ad, .35), (form, .15), (side, .2)) if rng.random() < chance]
    rng.shuffle(lead)
    rng.shuffle(tail)
    end = [foot()] if rng.random() < 0.8 else []
    if rng.random() < 0.2:
        end.append(note())
    middle = "".join([inner, *tail])
    if rng.random() < 0.4:
        middle = f"<div data-a{rng.choice(['', ' class=wrapper', ' id=page', ' class=container', ' class=row'])}>{middle}</div>"
    return f"<html><head><title>{word()}</title></head><body>{''.join(lead)}{middle}{''.join(end)}</body></html>"


def training_parts(html: str, seed: int) -> tuple[list[tuple[str, str]], list[str]]:
    """A bounded part of a page to train on: article blocks in a row from a
    random place, other texts spread over the page, a random cut of a long text."""
    rng = np.random.default_rng(seed)

    def cut(t: str) -> str:
        lo = int(rng.integers(0, len(t) - SAMPLE_CHARS)) if len(t) > SAMPLE_CHARS else 0
        return t[lo:lo + SAMPLE_CHARS]

    article, rest = _article_and_rest(html)
    lo = int(rng.integers(0, len(article) - SAMPLE_BLOCKS)) if len(article) > SAMPLE_BLOCKS else 0
    step = max(1, -(-len(rest) // SAMPLE_TEXTS))
    return [(tag, cut(t)) for tag, t in article[lo:lo + SAMPLE_BLOCKS]], [cut(t) for t in rest[::step]]


def training_set(parts: list[tuple[list[tuple[str, str]], list[str]]], seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    articles = [a for a, _ in parts if a]
    texts = [t for _, r in parts for t in r if len(t) > 20] + [t for a in articles for _, t in a[:3] if len(t) < 300]
    words = [w for t in texts[:NAME_TEXTS] for w in t.split()[:NAME_WORDS]]
    if not articles or not texts or not words:
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0), np.zeros(0)
    xs, ys, ws = [], [], []
    for a in articles * 2:
        if len(a) > COMPOSED_BLOCKS:
            lo = int(rng.integers(0, len(a) - COMPOSED_BLOCKS))
            a = a[lo:lo + COMPOSED_BLOCKS]
        html = compose(rng, a, texts, words)
        nodes = parse(html)
        marks = [m[3].lstrip().startswith("data-a") for m in TOKEN.finditer(html)
                 if m[2] and not m[1] and m[2].lower() in NODES
                 and m[2].lower() not in ("html", "body", "hr") and m[2].lower() not in VOID]
        y = np.array([0.0, *marks])
        if len(y) != len(nodes):
            raise AssertionError("labels and nodes differ")
        f, _, own = features(nodes)
        xs.append(f)
        ys.append(y)
        ws.append(np.log1p(own) + 0.5)
    return np.concatenate(xs), np.concatenate(ys), np.concatenate(ws)


def train(pages: DataFrame) -> Trees | None:
    """Fit on pages of low hash (of id and page), whatever their length; the
    parts to learn from are taken in the tasks.  Equal pages count once."""
    @F.arrow_udf("struct<article: array<struct<tag: string, text: string>>, rest: array<string>>")
    def parts(html: pa.Array, h: pa.Array) -> pa.Array:
        made = [training_parts(page, seed % (1 << 32)) for page, seed in zip(html.to_pylist(), h.to_pylist())]
        text = pa.struct([("tag", pa.string()), ("text", pa.string())])
        return pa.array([{"article": [{"tag": t, "text": x} for t, x in a], "rest": r} for a, r in made],
                        pa.struct([("article", pa.list_(text)), ("rest", pa.list_(pa.string()))]))

    usable = pages.where(F.col("html").isNotNull()).select("html", F.xxhash64(F.lit("pages"), "page_id", "html").alias("h"))
    sample = least_hashes(usable, "h", SAMPLE).groupBy("h").agg(F.min("html").alias("html"))
    found = sorted(sample.select("h", parts("html", "h").alias("p")).collect(), key=lambda r: r["h"])
    f, y, w = training_set([([(b["tag"], b["text"]) for b in r["p"]["article"]], r["p"]["rest"]) for r in found])
    return boost(f, y, w) if len(y) and 0 < y.sum() < len(y) else None


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(train(pages))

    @F.arrow_udf("string")
    def of(html: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(html), 64):
            out += extract(html.slice(at, 64).to_pylist(), shared.value)
        return pa.array(out, pa.string())

    got = pages.select("page_id", "url", of("html").alias("text"))
    return got.select("*", F.char_length("text").cast("bigint").alias("n_chars"))
