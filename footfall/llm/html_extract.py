"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, in page order. Each block becomes a vector: hashed
tags, classes and ids of its path, hashed words, and a few measures of its text. A bidirectional LSTM in numpy
reads the whole sequence, so a block is labelled with the page before and after it in view. Blocks labelled as article text are kept.

The model is trained here, on the driver, from a bounded set of sequences: ``SYNTHETIC`` pages made by a small grammar, and at most ``SAMPLE``
given pages of at most ``SAMPLE_CHARS`` characters whose own tags (article, main, nav, footer …) say what a block is. Labelling runs in Spark tasks on whole pages.

Defined results: a null html is empty; a page without article blocks has an empty text; an unclosed script, style, title, textarea or
iframe swallows the rest, as in browsers; a head ends at the first tag or text that cannot stand in it; an unclosed noscript, object or template
ends with the element around it, an unclosed svg also at the first tag that is none of SVG; a null url stays null; repeated rows are labelled each; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.words import mix, slices, word_hashes

PATH_SLOTS, PATH_SIZE = 1024, 24
WORD_SLOTS, WORD_SIZE = 1024, 12
MEASURES = 6
HIDDEN = 20
INPUT = PATH_SIZE + WORD_SIZE + MEASURES
SYNTHETIC, SAMPLE, SAMPLE_CHARS, EPOCHS = 500, 200, 20_000, 8
CELLS = 20_000  # steps x pages that are labelled together; a longer page goes alone

# Fixed values of HTML: tags that end a block, tags without content, tags whose content is no text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td "
    "textarea tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_TAGS = frozenset("head iframe noscript object script style svg template title".split())
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
NOT_SVG = BLOCK_TAGS | frozenset("b big br code em embed i img meta nobr ruby s small span strike strong sub sup tt u var".split())
RAW_TAGS = ("script", "style", "title", "textarea", "iframe")

# A tag by the rules of HTML: a quote opens a value only right after "="; elsewhere it is an ordinary character. Nothing is
# tried twice, and without its ">" a tag runs to the end of the page.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)*+)(>?)")
_END_TAG = re.compile(r"</([a-zA-Z][^\s/>]*+)")
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_GAP = re.compile(r"[ \t\n\r\f\v  -   　]+")


def _slot(name: str) -> int:
    h = 0
    for b in name.encode():
        h = (h * 1_000_003 + b + 1) & 0xFFFFFFFF
    return (h ^ h >> 15) % PATH_SLOTS


def _name_slots(attributes: str) -> list[int]:
    slots = []
    for m in _NAMES.finditer(attributes):
        for piece in _PIECE.findall(m[1] or m[2] or m[3] or ""):
            piece = piece.lower()
            slots.append(_slot("." + (piece[:-1] if len(piece) > 3 and piece.endswith("s") else piece)))
    return slots


class Node:
    """An open block element: its own slots and the elements around it."""

    __slots__ = ("tag", "own", "parent")

    def __init__(self, tag: str, own: list[int], parent: "Node | None"):
        self.tag, self.own, self.parent = tag, own, parent

    def path(self) -> list["Node"]:
        """From the outermost element to this one."""
        nodes, node = [], self
        while node is not None:
            nodes.append(node)
            node = node.parent
        return nodes[::-1]


class Block:
    """A leaf block. Its path is shared with its neighbours; ``slots`` and ``tags`` spell it out."""

    __slots__ = ("text", "node", "linked", "spelt")

    def __init__(self, text: str, node: Node | None, linked: float):
        self.text, self.node, self.linked, self.spelt = text, node, linked, None

    @property
    def leaf(self) -> int:
        return _slot("leaf:" + (self.node.tag if self.node else ""))

    @property
    def slots(self) -> list[int]:
        if self.spelt is not None:
            return self.spelt
        return [s for n in (self.node.path() if self.node else []) for s in n.own] + [self.leaf]

    @property
    def tags(self) -> list[str]:
        return [n.tag for n in self.node.path()] if self.node else []


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, with white space inside as one space. Takes time in proportion to the page."""
    out: list[Block] = []
    stack: list[Node] = []
    open_blocks: Counter[str] = Counter()
    pieces: list[str] = []
    linked = total = 0
    in_link = at = 0
    inline: Counter[str] = Counter()  # open visible elements that are no blocks
    inside: list[str] = []  # open elements from the outermost hidden one on
    hidden: Counter[str] = Counter()  # the same, counted
    last_end: dict[str, int] | None = None

    def push(tag: str, own: list[int]) -> None:
        stack.append(Node(tag, own, stack[-1] if stack else None))
        open_blocks[tag] += 1

    def pop(k: int) -> None:
        while len(stack) > k:
            open_blocks[stack.pop().tag] -= 1

    def leave(k: int) -> None:
        while len(inside) > k:
            hidden[inside.pop()] -= 1

    def last(names: list[str], tag: str) -> int:
        k = len(names) - 1
        while names[k] != tag:
            k -= 1
        return k

    def close() -> None:
        nonlocal linked, total
        if pieces:
            text = _GAP.sub(" ", "".join(pieces)).strip()
            if text:
                out.append(Block(text, stack[-1] if stack else None, linked / max(1, total)))
            pieces.clear()
        linked = total = 0

    def unclosed(tag: str) -> bool:
        nonlocal last_end
        if last_end is None:
            last_end = {m[1].lower(): m.start() for m in _END_TAG.finditer(page)}
        return last_end.get(tag, -1) < at

    def leave_head() -> None:
        if inside and inside[0] == "head" and (len(inside) == 1 or unclosed(inside[1])):
            leave(0)

    def leave_svg() -> None:
        while hidden["svg"]:
            k = len(inside) - 1
            while inside[k] not in ("svg", "foreignobject", "desc"):
                k -= 1
            if inside[k] != "svg":
                break
            leave(k)

    def add(text: str) -> None:
        nonlocal linked, total
        if inside and text.strip(" \t\n\r\f"):
            leave_head()
        if text and not inside:
            if "&" in text:
                text = entities.unescape(text)
            pieces.append(text)
            total += len(text)
            linked += len(text) if in_link else 0

    def past(end: str, start: int) -> int:
        k = page.find(end, start)
        return len(page) if k < 0 else k + len(end)

    text_from = 0
    while True:
        start = page.find("<", at)
        if start < 0:
            add(page[text_from:])
            break
        m = _TAG.match(page, start)
        after = page[start + 1 : start + 4]
        if m is None and not after.startswith(("!", "?", "/")):
            at = start + 1  # a "<" of the text
            continue
        add(page[text_from:start])
        if m is None:
            # Comments, declarations and what browsers read as such.
            at = past("-->", start + 2) if after == "!--" else past(">", start + 1)
            text_from = at
            continue
        at = text_from = m.end()
        if not m[4]:
            break
        tag = m[2].lower()
        if m[1]:
            if inside:
                if not hidden[tag] and (tag in ("body", "html") or inline[tag] > 0 or open_blocks[tag] > 0):
                    leave(0)  # an element around the hidden one ends
                else:
                    if hidden[tag]:
                        leave(last(inside, tag))
                    if tag in BLOCK_TAGS:
                        close()
                    continue
            if tag == "a":
                in_link = inline[tag] = 0
            elif tag in BLOCK_TAGS:
                close()
                if open_blocks[tag]:
                    k = len(stack) - 1
                    while stack[k].tag != tag:
                        k -= 1
                    pop(k)
            elif inline[tag]:
                inline[tag] -= 1
            continue
        if tag == "body":
            leave(0)
        if inside and tag not in HEAD_TAGS:
            leave_head()
        if inside and tag in NOT_SVG:
            leave_svg()
        ended = m[3].endswith("/")
        if tag in RAW_TAGS and not (ended and hidden["svg"]):
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if tag == "textarea":
                close()
                push(tag, [_slot(tag)])
                add(page[at:stop])
                close()
                pop(len(stack) - 1)
            at = text_from = end.end() if end else stop
        elif inside or tag in HIDDEN_TAGS:
            if tag in BLOCK_TAGS:
                close()
            if not ended and tag not in VOID_TAGS:
                inside.append(tag)
                hidden[tag] += 1
        elif tag == "br":
            add("\n")
        elif tag == "a":
            in_link = inline[tag] = 1
        elif tag in BLOCK_TAGS:
            close()
            if tag == "p" or tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
                same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
                if stack and stack[-1].tag in same:
                    pop(len(stack) - 1)
            elif stack and stack[-1].tag == "p":
                pop(len(stack) - 1)
            if tag not in VOID_TAGS:
                push(tag, [_slot(tag), *_name_slots(m[3])])
        elif tag not in VOID_TAGS:
            inline[tag] += 1
    close()
    return out


# ------------------------------------------------------------------------------ vectors


def path_slots(parts: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Path slots of all blocks, one after the other, and their starts: spelt out, for training pages."""
    spelt = [b.slots for b in parts]
    return np.array([s for x in spelt for s in x], np.int64), np.cumsum([0, *map(len, spelt)])


def path_means(parts: list[Block], table: np.ndarray) -> np.ndarray:
    """Mean of the table's rows over each block's path; an element's sum is its parent's and its own, computed once."""
    number: dict[int, int] = {}
    nodes: list[Node] = []
    for b in parts:
        fresh, node = [], b.node
        while node is not None and id(node) not in number:
            fresh.append(node)
            number[id(node)] = -1
            node = node.parent
        for node in reversed(fresh):
            number[id(node)] = len(nodes)
            nodes.append(node)
    sums = np.zeros((len(nodes) + 1, table.shape[1]))  # the last row is that of no element
    count = np.zeros(len(nodes) + 1, np.int64)
    for k, node in enumerate(nodes):
        up = number[id(node.parent)] if node.parent is not None else -1
        sums[k] = sums[up] + table[node.own].sum(axis=0)
        count[k] = count[up] + len(node.own)
    at = np.array([number[id(b.node)] if b.node is not None else -1 for b in parts], np.int64)
    leaf = np.array([b.leaf for b in parts], np.int64)
    return ((sums[at] + table[leaf]) / (count[at] + 1)[:, None]).astype(np.float32)


def vectors(parts: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots of all blocks, one after the other, their starts, and the measures."""
    words, firsts, before = [], [np.zeros(1, np.int64)], 0
    for _, _, data, offsets in slices(pa.array([b.text for b in parts], pa.string())):
        h, first = word_hashes(data, offsets)
        words.append((mix(h) % np.uint64(WORD_SLOTS)).astype(np.int64))
        firsts.append(first[1:] + before)
        before += len(h)
    word, word_at = np.concatenate(words), np.concatenate(firsts)
    size = np.array([len(b.text) for b in parts], np.float32)
    n = np.diff(word_at).astype(np.float32)
    measures = np.stack(
        [
            np.log1p(size) / 6, np.log1p(n) / 5, np.array([b.linked for b in parts], np.float32), (n < 4).astype(np.float32),
            np.array([b.text[-1] in ".!?\"”…" for b in parts], np.float32), size / np.maximum(n, 1) / 10,
        ],
        axis=1,
    ).astype(np.float32)
    return word, word_at, measures


def _sum_rows(table: np.ndarray, slots: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mean of the table's rows per block; blocks are taken in parts to bound memory."""
    out = np.zeros((len(at) - 1, table.shape[1]), np.float32)
    a = 0
    while a < len(out):
        b = max(a + 1, int(np.searchsorted(at, at[a] + 200_000, "right")) - 1)
        sums = np.zeros((at[b] - at[a] + 1, table.shape[1]))
        np.cumsum(table[slots[at[a] : at[b]]], axis=0, out=sums[1:])
        here = at[a : b + 1] - at[a]
        out[a:b] = (sums[here[1:]] - sums[here[:-1]]) / np.maximum(1, np.diff(here))[:, None]
        a = b
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Parameters and passes of the network; arrays are (time, page, feature), padded at the end."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        def init(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {
            "path": (rng.standard_normal((PATH_SLOTS, PATH_SIZE)) * 0.3).astype(np.float32),
            "word": (rng.standard_normal((WORD_SLOTS, WORD_SIZE)) * 0.1).astype(np.float32),
            "out": init(2 * HIDDEN + INPUT, 1), "out_b": np.zeros(1, np.float32),
        }
        for d in ("f", "b"):
            self.p |= {f"{d}_x": init(INPUT, 4 * HIDDEN), f"{d}_h": init(HIDDEN, 4 * HIDDEN), f"{d}_b": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"{d}_b"][HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def inputs(self, parts: list[Block], spelt: bool):
        """Vectors of all blocks, and with ``spelt`` the slots they come from."""
        word, word_at, measures = vectors(parts)
        path, path_at = path_slots(parts) if spelt else (None, None)
        paths = _sum_rows(self.p["path"], path, path_at) if spelt else path_means(parts, self.p["path"])
        x = np.concatenate([paths * 3, _sum_rows(self.p["word"], word, word_at), measures], axis=1)
        return x, (path, path_at, word, word_at)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, trace: list | None):
        steps, n, _ = x.shape
        pre = x @ self.p[f"{d}_x"] + self.p[f"{d}_b"]
        h = c = np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ self.p[f"{d}_h"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if trace is not None:
                trace.append((t, i, f, o, g, c, tanh_c, h))
            # Padding leaves the state as it is, so both directions see only the page.
            h, c = m * (o * tanh_c) + (1 - m) * h, m * new_c + (1 - m) * c
            out[t] = h
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, traces: dict | None = None):
        f = self._run(x, mask, "f", None if traces is None else traces.setdefault("f", []))
        b = self._run(x, mask, "b", None if traces is None else traces.setdefault("b", []))
        both = np.concatenate([f, b, x], axis=2)
        return both, _sigmoid(both @ self.p["out"] + self.p["out_b"])[:, :, 0]

    def gradients(self, x, mask, y):
        traces: dict[str, list] = {}
        both, prob = self.forward(x, mask, traces)
        d_logit = ((prob - y) * mask / mask.sum())[:, :, None].astype(np.float32)
        g = {"out": np.einsum("tnf,tno->fo", both, d_logit), "out_b": d_logit.sum((0, 1))}
        d_both = d_logit @ self.p["out"].T
        d_x = d_both[:, :, 2 * HIDDEN :].copy()
        for d, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[:, :, HIDDEN : 2 * HIDDEN])):
            w_h = self.p[f"{d}_h"]
            g_h, d_z = np.zeros_like(w_h), np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            d_h = d_c = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, i, f, o, gg, c, tanh_c, h in reversed(traces[d]):
                m = mask[t][:, None]
                d_h = d_h + part[t]
                own_h, own_c = d_h * m, d_c * m
                d_cell = own_c + own_h * o * (1 - tanh_c**2)
                z = np.concatenate([d_cell * gg * i * (1 - i), d_cell * c * f * (1 - f), own_h * tanh_c * o * (1 - o), d_cell * i * (1 - gg**2)], axis=1)
                d_z[t] = z
                g_h += h.T @ z
                d_h, d_c = d_h * (1 - m) + z @ w_h.T, d_c * (1 - m) + d_cell * f
            g[f"{d}_h"], g[f"{d}_x"], g[f"{d}_b"] = g_h, np.einsum("tni,tnz->iz", x, d_z), d_z.sum((0, 1))
            d_x += d_z @ self.p[f"{d}_x"].T
        return g, d_x

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Per page the probability of every block to be article text."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:
            # The longest pages first, as many as fit the cells at their length.
            many = max(1, CELLS // len(pages[order[-1]]))
            order, some = order[:-many], order[-many:]
            x, mask, _ = self._padded([pages[i] for i in some], spelt=False)
            _, prob = self.forward(x, mask)
            for j, i in enumerate(some):
                out[i] = prob[: len(pages[i]), j]
        return out

    def _padded(self, pages: list[list[Block]], spelt: bool):
        flat, slots = self.inputs([b for p in pages for b in p], spelt)
        sizes = [len(p) for p in pages]
        x = np.zeros((max(sizes), len(pages), INPUT), np.float32)
        mask = np.zeros((max(sizes), len(pages)), np.float32)
        at = 0
        for j, n in enumerate(sizes):
            x[:n, j], mask[:n, j] = flat[at : at + n], 1
            at += n
        return x, mask, slots

    def train(self, pages: list[list[Block]], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        first, second, step = {}, {}, 0
        for epoch in range(epochs):
            for some in np.array_split(rng.permutation(len(pages)), max(1, len(pages) // 25)):
                use = [pages[i] for i in some]
                x, mask, (path, path_at, word, word_at) = self._padded(use, spelt=True)
                y = np.zeros_like(mask)
                for j, i in enumerate(some):
                    y[: len(labels[i]), j] = labels[i]
                g, d_x = self.gradients(x, mask, y)
                d_flat = np.concatenate([d_x[: len(p), j] for j, p in enumerate(use)])
                for name, slots, at, cols, by in (("path", path, path_at, slice(0, PATH_SIZE), 3), ("word", word, word_at, slice(PATH_SIZE, PATH_SIZE + WORD_SIZE), 1)):
                    n = np.diff(at)
                    g[name] = np.zeros_like(self.p[name])
                    np.add.at(g[name], slots, np.repeat(d_flat[:, cols] * by / np.maximum(1, n)[:, None], n, axis=0))
                step += 1
                scale = min(1.0, 1.0 / (np.sqrt(sum(float((v**2).sum()) for v in g.values())) + 1e-9))
                for k, v in g.items():
                    v = v * scale
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * v
                    second[k] = 0.999 * second.get(k, 0) + 0.001 * v**2
                    move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] = (self.p[k] - rate * (1 - epoch / (epochs + 1)) * move).astype(np.float32)


# ------------------------------------------------------------------------------ training pages

# Names that pages give their parts. Each is (tag, class names).
_ARTICLE_AT = [("article", ""), ("main", ""), ("div", "content"), ("div", "post entry-content"), ("section", "article-body"), ("div", "story text"), ("div", "")]
_ASIDE_AT = {
    "menu": [("nav", ""), ("div", "menu navbar"), ("ul", "nav navigation"), ("div", "breadcrumb"), ("div", "topbar links"), ("nav", "pagination")],
    "header": [("header", ""), ("div", "header masthead"), ("div", "site-header logo"), ("header", "banner")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "site-footer copyright"), ("div", "bottom legal")],
    "side": [("aside", ""), ("div", "sidebar widget"), ("div", "related recommended"), ("aside", "popular trending"), ("section", "newsletter teaser"), ("div", "share social"), ("div", "tags meta")],
    "notice": [("div", "cookie notice"), ("div", "alert banner"), ("div", "consent gdpr popup"), ("div", "subscribe modal"), ("div", "notice"), ("section", "notification disclaimer")],
    "ad": [("div", "ad"), ("div", "advert sponsored"), ("div", "ads promo"), ("aside", "advertisement"), ("div", "promotion banner")],
    "form": [("form", ""), ("form", "search"), ("form", "login signup"), ("div", "contact-form")],
    "comment": [("div", "comments"), ("section", "comment-list discussion"), ("ol", "commentlist"), ("div", "reader-comments replies"), ("section", "responses"), ("ul", "comment-thread")],
}
_SAYINGS = {
    "menu": "home about contact news sports world login more next previous page products services blog".split(),
    "header": "welcome daily home subscribe search menu sign in edition".split(),
    "footer": "copyright © all rights reserved privacy policy terms of use imprint sitemap contact &middot; &copy;".split(),
    "side": "related popular most read also like latest trending share tags newsletter more from by posted in".split(),
    "notice": "we use cookies accept this site your privacy consent settings agree subscribe please enable notice".split(),
    "ad": "advertisement sponsored buy now sale off offer click here best deal free shop".split(),
    "form": "name email search submit password send message your log in register".split(),
    "comment": "reply says on great thanks i think you posted by anonymous agree comment like am lol ago".split(),
}
_SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ch ei ie ung qu é ció ä ñ".split()


def _invented(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def _sentence(rng: random.Random, n: int, extra: list[str] = (), share: float = 0.0) -> str:
    words = [rng.choice(extra) if extra and rng.random() < share else w for w in _invented(rng, n)]
    return " ".join(words).capitalize() + rng.choice([".", ".", ".", "", "!"])


def _wrap(tag: str, names: str, inner: str, rng: random.Random) -> str:
    quote = rng.choice('"\'')
    key = rng.choice(["class", "class", "id"])
    return f"<{tag}{f' {key}={quote}{names}{quote}' if names else ''}>{inner}</{tag}>"


def _aside(rng: random.Random, kind: str) -> str:
    tag, names = rng.choice(_ASIDE_AT[kind])
    said = _SAYINGS[kind]
    share = rng.choice([0.0, 0.3, 0.7])
    short = lambda: _sentence(rng, rng.randint(1, 6), said, share)
    long = lambda: _sentence(rng, rng.randint(6, 40), said, share / 2)
    if kind in ("menu",):
        items = [f'<a href="/{i}">{short()}</a>' for i in range(rng.randint(2, 9))]
        inner = "".join(f"<li>{x}</li>" for x in items) if tag in ("ul", "ol") else rng.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " ".join(items)])
    elif kind == "form":
        inner = f"<label>{short()}</label><input name=q>" + rng.choice([f"<button>{short()}</button>", f"<p>{short()}</p><select><option>{short()}<option>{short()}</select>", f"<textarea>{short()}</textarea>"])
    elif kind == "comment":
        one = lambda: rng.choice([f"<p>{long()}</p>", f"<div class=author>{short()}</div><p>{long()}</p><a href=#>{short()}</a>"])
        item = "li" if tag in ("ul", "ol") else rng.choice(["div", "article", "p"])
        inner = rng.choice(["", f"<h3>{short()}</h3>"] if tag not in ("ul", "ol") else [""]) + "".join(f"<{item}>{one()}</{item}>" for _ in range(rng.randint(1, 6)))
    else:
        inner = rng.choice([short(), long(), f"<h3>{short()}</h3><p>{long()}</p>", f"<p>{long()}</p>", f"<h4>{short()}</h4><ul><li><a href=/x>{short()}</a></li><li><a href=/y>{short()}</a></li></ul>", f'<a href="/a">{short()}</a> {short()}'])
    return f"\x01{_wrap(tag, names, inner, rng)}\x02"


def synthetic_page(rng: random.Random) -> str:
    """A page of the grammar; \\x01 and \\x02 enclose what is not article text."""
    body = [f"<{t}>{_sentence(rng, rng.randint(2, 10))}</{t}>" for t in [rng.choice(["h1", "h1", "h2"])] if rng.random() < 0.9]
    for _ in range(rng.randint(1, 14)):
        text = " ".join(_sentence(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 5)))
        body.append(
            rng.choice(
                [f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<p>{text} <a href=/l>{_sentence(rng, 2)}</a></p>", f"<blockquote>{text}</blockquote>",
                 f"<h2>{_sentence(rng, rng.randint(1, 6))}</h2><p>{text}</p>", f"<ul><li>{_sentence(rng, 6)}</li><li>{_sentence(rng, 3)}</li></ul>", f"<div>{text}</div>",
                 f"<table><tr><td>{_sentence(rng, 2)}</td><td>{_sentence(rng, 3)}</td></tr></table>", f"<pre>{text}</pre>", f"<p>{_sentence(rng, rng.randint(1, 3))}</p>"]
            )
        )
        if rng.random() < 0.06:
            body.append(_aside(rng, rng.choice(["ad", "side", "form", "notice"])))
    tag, names = rng.choice(_ARTICLE_AT)
    kinds = lambda pool: [_aside(rng, rng.choice(pool)) for _ in range(rng.randint(0, 3))]
    before = kinds(["menu", "header", "notice", "ad", "side", "form"])
    after = kinds(["comment", "comment", "side", "form", "ad", "notice"]) + kinds(["footer", "menu", "notice"])
    inside = rng.random()
    article = _wrap(tag, names, "".join(body) + ("".join(after[:1]) if inside < 0.2 else ""), rng)
    if rng.random() < 0.2:
        article = f"<div class={rng.choice(['page', 'wrapper', 'container', 'main'])}>{article}</div>"
    return "<html><head><title>x</title></head><body>" + "".join(before) + article + "".join(after[1:] if inside < 0.2 else after) + "</body></html>"


def labelled(page: str) -> tuple[list[Block], np.ndarray]:
    """Blocks and labels of a page of the grammar: the marks are read as a tag of their own, then forgotten."""
    found = blocks(page.replace("\x01", "<section class=zzmark>").replace("\x02", "</section>"))
    mark = _slot(".zzmark")
    y = np.array([mark not in b.slots for b in found], np.float32)
    for b in found:
        slots = b.slots
        while mark in slots:  # and the section before it
            k = slots.index(mark)
            del slots[k - 1 : k + 1]
        b.spelt = slots
    return found, y


_MAIN, _NOT_MAIN = frozenset(("article", "main")), frozenset(("nav", "header", "footer", "aside", "form", "button", "select", "textarea", "menu"))


def weakly_labelled(page: str) -> tuple[list[Block], np.ndarray] | None:
    """Blocks and labels of a given page by its own tags, if they say where the article is."""
    found = blocks(page)
    if not any(_MAIN & set(b.tags) for b in found):
        return None
    return found, np.array([bool(_MAIN & set(b.tags)) and not _NOT_MAIN & set(b.tags) for b in found], np.float32)


def train(pages: DataFrame) -> Labeller:
    """Fit on the grammar's pages and at most ``SAMPLE`` given ones, chosen by a hash of the page."""
    rng = random.Random(11)
    data = [labelled(synthetic_page(rng)) for _ in range(SYNTHETIC)]
    short = pages.select("html").where(F.char_length("html") <= SAMPLE_CHARS).withColumn("_h", F.xxhash64("html"))
    # Hashes first: tasks send SAMPLE numbers each, and only the chosen pages follow.
    chosen = [r["_h"] for r in short.select("_h").distinct().orderBy("_h").limit(SAMPLE).collect()]
    some = short.where(F.col("_h") <= chosen[-1]).dropDuplicates(["_h"]).collect() if chosen else []
    data += [x for html in sorted(r["html"] for r in some) if (x := weakly_labelled(html)) is not None]
    data = [(b, y) for b, y in data if b]
    model = Labeller()
    model.train([b for b, _ in data], [y for _, y in data])
    return model


def extract_batch(model: Labeller, texts: list[str]) -> list[str]:
    found = [blocks(t) for t in texts]
    return ["\n\n".join(b.text for b, p in zip(page, prob, strict=True) if p >= 0.5) for page, prob in zip(found, model.label(found), strict=True)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = train(pages)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for a, b, _, _ in slices(batch.column(2)):
                texts = extract_batch(model, batch.column(2)[a:b].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
