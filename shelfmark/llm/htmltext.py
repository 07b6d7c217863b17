"""Main text of web pages by a recurrent block labeller.

A page is read as the sequence of its blocks: the texts between block-level tags, in page order,
each with its tag path (tags and the words of classes and ids) and its words. Both are hashed to
vectors, a bidirectional LSTM (numpy) reads the sequence from both sides, and every block is
labelled as main text or not with the context of the whole page.

Training is on the driver, by backpropagation through time and Adam, on two bounded sets: pages
composed by a seeded generator from many layouts, and `SAMPLE` pages of the table (by a hash of
the id, of at most `SAMPLE_CHARS` characters) that name their article and their other parts by
HTML's own elements. The weights are sent to the tasks. Pages are read whole.

Character references are decoded, white space inside a block becomes one space, blocks are
joined by two line breaks. A line break element is white space. Inline elements belong to their
block. Scripts, styles, comments and markup are no text.

Defined results: a null or empty page has empty text; malformed markup is read as far as it goes;
repeated rows are rows each; a null id or url is kept; an empty table gives no rows; other
columns are ignored."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.frames import slices

HIDDEN = 16
PATH_SIZE, WORD_SIZE, PLAIN_SIZE = 96, 32, 6
INPUT = PATH_SIZE + WORD_SIZE + PLAIN_SIZE
# deeper paths look alike to the network
DEEPEST = 100
# blocks of a long page that are held as vectors at a time
LONG_PAGE = 20_000
SAMPLE = 120
SAMPLE_CHARS = 20_000
COMPOSED = 400
STEPS = 300

# Fixed values of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements of a formula, which is read as part of its block
MATH = frozenset(
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
UNREAD = frozenset("script style noscript template svg iframe object textarea select annotation annotation-xml".split())
#: unread elements that hold no blocks; a block that starts inside ends them, as they were left open
NO_BLOCKS = frozenset("svg select annotation annotation-xml".split())
#: block elements that such an element may hold all the same
HELD = {"select": frozenset(("option", "optgroup", "hr"))}
#: elements of HTML that a drawing cannot hold; its own elements are not listed
BREAKOUT = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: elements that end an open one of the same kind
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}

MAIN = frozenset(("<article>", "<main>"))
ASIDE = frozenset(("<nav>", "<footer>", "<aside>", "<form>", "<header>", "<head>", "<title>", "<button>", "<dialog>"))
_ASIDE_WORDS = frozenset("ad ads advert comments comment sidebar menu cookie notice banner related share".split())


class Node:
    """An open element, tied to the one around it, so that all blocks of a page share their paths."""

    __slots__ = ("aside", "depth", "main", "mask", "part", "up")

    def __init__(self, up: "Node | None", part: str) -> None:
        words = part.split()
        self.up, self.part = up, part
        self.depth: int = up.depth + 1 if up else 1
        self.mask: int = _mask(part) | (up.mask if up else 0)
        self.main: bool = bool(up and up.main) or not MAIN.isdisjoint(words)
        self.aside: bool = bool(up and up.aside) or not ASIDE.isdisjoint(words) or not _ASIDE_WORDS.isdisjoint(words)

    def path(self) -> tuple[str, ...]:
        parts, node = [], self
        while node:
            parts.append(node.part)
            node = node.up
        return tuple(reversed(parts))


Block = tuple[Node | None, str, int]
"""Innermost element, text, characters inside links."""


class _Blocks(HTMLParser):
    """Collects the blocks of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._open: list[tuple[str, Node]] = []
        #: places in _open by tag
        self._at: dict[str, list[int]] = {}
        self._parts: list[str] = []
        self._links = self._in_link = 0
        #: an unread element and what is open inside it, with the number of each tag
        self._unread: list[str] = []
        self._inside: dict[str, int] = {}

    def _end_block(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.blocks.append((self._open[-1][1] if self._open else None, text, self._links))
        self._parts, self._links = [], 0

    def _leave(self, at: int) -> None:
        """Close the open elements from a place on."""
        while len(self._open) > at:
            self._at[self._open.pop()[0]].pop()

    def _end_unread(self) -> None:
        self._unread, self._inside = [], {}

    def _start_unread(self, tag: str) -> bool:
        """A start tag inside an unread element: whether it belongs there."""
        first = self._unread[0]
        if first in NO_BLOCKS and tag in BREAKOUT and tag not in HELD.get(first, ()):
            self._end_unread()
            return False
        if tag not in VOID:
            self._unread.append(tag)
            self._inside[tag] = self._inside.get(tag, 0) + 1
        return True

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._unread and self._start_unread(tag):
            return
        if tag in UNREAD:
            self._unread, self._inside = [tag], {tag: 1}
            self._parts.append(" ")
        elif tag in INLINE or tag in MATH:
            if tag == "a":
                self._in_link += 1
            if tag in ("br", "img", "wbr"):
                self._parts.append(" " if tag != "wbr" else "")
        else:
            self._end_block()
            if tag in VOID:
                return
            self._in_link = 0
            ends = CLOSES.get(tag, ())
            for at in range(len(self._open) - 1, -1, -1):
                name = self._open[at][0]
                if name == "p" or name in ends:
                    self._leave(at)
                elif name not in ("li", "dt", "dd", "td", "th", "tr") or not ends:
                    break
            named = [v for k, v in attrs if k in ("class", "id", "role") and v]
            words = sorted(set(re.findall(r"[a-z]+", " ".join(named).lower())))
            self._at.setdefault(tag, []).append(len(self._open))
            self._open.append((tag, Node(self._open[-1][1] if self._open else None, " ".join([f"<{tag}>", *words]))))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID or tag in INLINE or tag in MATH:
            self.handle_starttag(tag, attrs)
        elif not self._unread:
            self._end_block()

    def handle_endtag(self, tag: str) -> None:
        if self._unread:
            if self._inside.get(tag):
                while True:
                    name = self._unread.pop()
                    self._inside[name] -= 1
                    if name == tag:
                        break
                return
            if not self._at.get(tag):
                return
            # the end of an element around it
            self._end_unread()
        if tag == "a":
            self._in_link = max(self._in_link - 1, 0)
        elif tag not in INLINE and tag not in MATH:
            self._end_block()
            if self._at.get(tag):
                self._leave(self._at[tag][-1])

    def handle_data(self, data: str) -> None:
        if not self._unread:
            self._parts.append(data)
            if self._in_link:
                self._links += len(data.strip())

    def finish(self) -> list[Block]:
        self.close()
        self._end_block()
        return self.blocks


def blocks(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    return parser.finish()


# --- vectors ------------------------------------------------------------------------------


_SEEN_PARTS: dict[str, int] = {}
_SEEN_WORDS: dict[str, int] = {}
REMEMBERED = 50_000  # elements and words whose slots a task remembers


def _mask(part: str, before: str = "") -> int:
    """Slots of the words of an element as bits."""
    key = before + part
    mask = _SEEN_PARTS.get(key)
    if mask is None:
        if len(_SEEN_PARTS) >= REMEMBERED:
            _SEEN_PARTS.clear()
        mask = 0
        for word in part.split():
            mask |= 1 << zlib.crc32((before + word).encode()) % PATH_SIZE
        _SEEN_PARTS[key] = mask
    return mask


def _path_bits(node: Node | None) -> bytes:
    """Slots of a path: its words anywhere, and the innermost element's on their own."""
    return (node.mask | _mask(node.part, "in ") if node else 0).to_bytes(PATH_SIZE // 8, "little")


def _word_slot(word: str) -> int:
    slot = _SEEN_WORDS.get(word)
    if slot is None:
        if len(_SEEN_WORDS) >= REMEMBERED:
            _SEEN_WORDS.clear()
        slot = _SEEN_WORDS[word] = zlib.crc32(word.encode()) % WORD_SIZE
    return slot


def vectors(page: list[Block], start: int = 0, stop: int | None = None) -> np.ndarray:
    """(blocks, INPUT) of a page, or of its blocks from `start` to `stop`."""
    part = page[start:stop]
    x = np.zeros((len(part), INPUT), np.float32)
    bits = np.frombuffer(b"".join(_path_bits(node) for node, _, _ in part), np.uint8).reshape(len(part), -1)
    x[:, :PATH_SIZE] = np.unpackbits(bits, axis=1, bitorder="little")
    for i, (node, text, links) in enumerate(part):
        words = text.lower().split(" ")
        counts = np.bincount([_word_slot(w) for w in words], minlength=WORD_SIZE)
        x[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = counts / math.sqrt(float((counts * counts).sum()))
        x[i, PATH_SIZE + WORD_SIZE :] = (
            math.log1p(len(words)) / 5,
            min(links / len(text), 1.0),
            sum(text.count(c) for c in ".,;:!?") / len(words),
            text[-1] in ".!?:\"'",
            (start + i) / len(page),
            min(node.depth if node else 0, DEEPEST) / 10,
        )
    return x


# --- the network --------------------------------------------------------------------------
# Rows of the gates: input, forget, output, candidate. States are (lanes, HIDDEN).

Weights = dict[str, np.ndarray]


def _start(rng: np.random.Generator) -> Weights:
    weights: Weights = {"out": rng.normal(0, 0.3, 2 * HIDDEN), "bias": np.zeros(1)}
    for side in "fb":
        weights[f"w{side}"] = rng.normal(0, 0.15, (INPUT, 4 * HIDDEN))
        weights[f"u{side}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        weights[f"v{side}"] = np.zeros(4 * HIDDEN)
        weights[f"v{side}"][HIDDEN : 2 * HIDDEN] = 1
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


State = tuple[np.ndarray, np.ndarray]


def _unroll(x: np.ndarray, mask: np.ndarray, weights: Weights, side: str, keep: bool, start: State | None = None) -> tuple[np.ndarray, list, State]:
    """States (steps, lanes, HIDDEN) over inputs (steps, lanes, INPUT), and the last one; padding leaves the
    state as it is."""
    w, u, v = (weights[k + side] for k in "wuv")
    steps, lanes, _ = x.shape
    a = x @ w + v
    h, c = start or (np.zeros((lanes, HIDDEN)), np.zeros((lanes, HIDDEN)))
    states, saved = np.empty((steps, lanes, HIDDEN)), []
    for t in range(steps):
        g = a[t] + h @ u
        gates = _sigmoid(g[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        n = np.tanh(g[:, 3 * HIDDEN :])
        inside = mask[t][:, None]
        before = (h, c)
        c = np.where(inside, f * c + i * n, c)
        tc = np.tanh(c)
        h = np.where(inside, o * tc, h)
        if keep:
            saved.append((before, i, f, o, n, tc))
        states[t] = h
    return states, saved, (h, c)


def _back(x: np.ndarray, mask: np.ndarray, weights: Weights, side: str, saved: list, into: np.ndarray) -> Weights:
    u = weights["u" + side]
    du = np.zeros_like(u)
    dg_all = np.zeros((*x.shape[:2], 4 * HIDDEN))
    dh = np.zeros((x.shape[1], HIDDEN))
    dc = np.zeros_like(dh)
    for t in reversed(range(len(x))):
        (h, c), i, f, o, n, tc = saved[t]
        inside = mask[t][:, None]
        dh = dh + into[t]
        here = np.where(inside, dh, 0)
        dc_here = np.where(inside, dc, 0) + here * o * (1 - tc * tc)
        dg = np.concatenate((dc_here * n * i * (1 - i), dc_here * c * f * (1 - f), here * tc * o * (1 - o), dc_here * i * (1 - n * n)), axis=1)
        dg_all[t] = dg
        du += h.T @ dg
        dh = np.where(inside, dg @ u.T, dh)
        dc = np.where(inside, dc_here * f, dc)
    flat = dg_all.reshape(-1, 4 * HIDDEN)
    return {"w" + side: x.reshape(-1, INPUT).T @ flat, "u" + side: du, "v" + side: flat.sum(axis=0)}


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for lane, page in enumerate(pages):
        x[: len(page), lane] = page
        mask[: len(page), lane] = True
    return x, mask


def _logits(x: np.ndarray, mask: np.ndarray, weights: Weights, keep: bool = False) -> tuple:
    forward, saved_f, _ = _unroll(x, mask, weights, "f", keep)
    backward, saved_b, _ = _unroll(x[::-1], mask[::-1], weights, "b", keep)
    both = np.concatenate((forward, backward[::-1]), axis=2)
    return both @ weights["out"] + weights["bias"], both, saved_f, saved_b


def train(pages: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, lanes: int = 24, seed: int = 11) -> Weights:
    """Weights from pages given as (vectors, labels)."""
    rng = np.random.default_rng(seed)
    weights = _start(rng)
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, steps + 1):
        chosen = [pages[i] for i in rng.integers(0, len(pages), lanes)]
        x, mask = _padded([p for p, _ in chosen])
        label = np.zeros(mask.shape)
        for lane, (_, y) in enumerate(chosen):
            label[: len(y), lane] = y
        logits, both, saved_f, saved_b = _logits(x, mask, weights, True)
        d = np.where(mask, _sigmoid(logits) - label, 0) / mask.sum()
        into = d[:, :, None] * weights["out"]
        gradient: Weights = {"out": np.einsum("tl,tlh->h", d, both), "bias": np.array([d.sum()])}
        gradient |= _back(x, mask, weights, "f", saved_f, into[:, :, :HIDDEN])
        gradient |= _back(x[::-1], mask[::-1], weights, "b", saved_b, into[::-1, :, HIDDEN:])
        norm = np.sqrt(sum((g * g).sum() for g in gradient.values()))
        rate = 0.015 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, g in gradient.items():
            g = g * min(1.0, 1.0 / (norm + 1e-12))
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return weights


def _long_logits(page: list[Block], weights: Weights) -> np.ndarray:
    """As `_logits` of one page, with the vectors and states of LONG_PAGE blocks at a time."""
    total = np.full(len(page), float(weights["bias"][0]))
    edges = list(range(0, len(page), LONG_PAGE))
    for side, order, out in (("f", edges, weights["out"][:HIDDEN]), ("b", edges[::-1], weights["out"][HIDDEN:])):
        step, state = 1 if side == "f" else -1, None
        for a in order:
            x = vectors(page, a, a + LONG_PAGE)[:, None][::step]
            states, _, state = _unroll(x, np.ones(x.shape[:2], bool), weights, side, False, state)
            total[a : a + LONG_PAGE] += (states[:, 0] @ out)[::step]
    return total


def label(pages: list[list[Block]], weights: Weights, most_cells: int = 60_000) -> list[np.ndarray]:
    """For each page, which of its blocks are main text."""
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    result: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    group: list[int] = []

    def run() -> None:
        if group:
            x, mask = _padded([vectors(pages[i]) for i in group])
            logits = _logits(x, mask, weights)[0]
            for lane, i in enumerate(group):
                result[i] = logits[: len(pages[i]), lane] > 0
            group.clear()

    for i in order:
        if len(pages[i]) > LONG_PAGE:
            result[i] = _long_logits(pages[i], weights) > 0
        elif pages[i]:
            if group and (len(group) + 1) * len(pages[i]) > most_cells // 10:
                run()
            group.append(i)
    run()
    return result


# --- training pages -----------------------------------------------------------------------

def own_labels(page: list[Block]) -> np.ndarray | None:
    """Labels of a page that names its parts by HTML's own elements; None if it names no article."""
    labels = [bool(node and node.main and not node.aside) for node, _, _ in page]
    return np.array(labels) if any(labels) else None


class _Composer:
    """Pages from many layouts, with the label of every block known."""

    def __init__(self, seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        letters = "aeioubcdfghlmnprstvwz"
        self.words = ["".join(letters[k] for k in self.rng.integers(0, len(letters), self.rng.integers(2, 10))) for _ in range(2000)]

    def pick(self, *choices: str) -> str:
        return choices[self.rng.integers(len(choices))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, low: int, high: int) -> int:
        return int(self.rng.integers(low, high + 1))

    def text(self, low: int, high: int, stop: bool = True) -> str:
        n = self.some(low, high)
        words = [self.words[k] for k in self.rng.integers(0, len(self.words), n)]
        out = [w + self.pick("", "", "", "", "", ",", ".") for w in words]
        return (" ".join(out)).rstrip(",.").capitalize() + ("." if stop else "")

    def links(self, n: int, tag: str = "li") -> list[tuple[str, int]]:
        return [(f'<{tag}><a href="/x">{self.text(1, 4, False)}</a></{tag}>', 0) for _ in range(n)]

    def body(self) -> list[tuple[str, int]]:
        parts: list[tuple[str, int]] = []
        if self.chance(0.8):
            parts.append((f"<h1>{self.text(2, 14, self.chance(0.5))}</h1>", 1))
        for _ in range(self.some(0, 16)):
            kind = self.rng.random()
            inner = self.text(1, 90 if self.chance(0.7) else 6)
            if self.chance(0.15):
                inner = f'{inner} <a href="/y">{self.text(1, 5, False)}</a> {self.text(1, 12)}'
            if kind < 0.62:
                end = self.pick("</p>", "</p>", "</p>", "")
                parts.append((f"<p>{'<b>' if self.chance(0.15) else ''}{inner}{'<br>' if self.chance(0.1) else ''}{end}", 1))
            elif kind < 0.7:
                parts.append((f"<{(h := self.pick('h2', 'h3', 'h4'))}>{self.text(1, 8, False)}</{h}>", 1))
            elif kind < 0.78:
                parts += [("<ul>", -1), *[(f"<li>{self.text(2, 25)}</li>", 1) for _ in range(self.some(1, 5))], ("</ul>", -1)]
            elif kind < 0.84:
                parts.append((f"<blockquote>{inner}</blockquote>", 1))
            elif kind < 0.88:
                parts.append((f"<pre>{self.text(3, 30, False)}</pre>", 1))
            elif kind < 0.92:
                cells = [(f"<td>{self.text(1, 5, False)}</td>", 1) for _ in range(self.some(2, 8))]
                parts += [("<table><tr>", -1), *cells, ("</tr></table>", -1)]
            elif kind < 0.96:
                parts.append((f"<div>{inner}</div>", 1))
            else:
                parts += self.other(inside=True)
        if self.chance(0.25):
            parts.append((f"<p>{self.pick('Licensed under', 'Copyright', 'Released under', 'This work is licensed under')} {self.text(1, 8)}</p>", 1))
        return parts

    def other(self, inside: bool = False) -> list[tuple[str, int]]:
        kind = self.some(0, 8)
        if kind == 0:
            shell = self.pick("<aside>", '<div class="sidebar">', '<div id="sidebar">', '<section class="widget">')
            return self.wrap(shell, [(f"<h3>{self.text(1, 4, False)}</h3>", 0), *[(f"<p>{self.text(3, 40)}</p>", 0) for _ in range(self.some(0, 3))], *self.links(self.some(0, 6))])
        if kind == 1:
            shell = f'<div class="{self.pick("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-box")}">'
            return self.wrap(shell, [(self.text(3, 25), 0)])
        if kind == 2:
            shell = f'<div class="{self.pick("cookie", "notice", "cookie-notice", "banner", "alert", "consent", "newsletter", "subscribe")}">'
            return self.wrap(shell, [(f"<p>{self.text(5, 30)}</p>", 0), (f"<button>{self.text(1, 2, False)}</button>", 0)])
        if kind == 3:
            return self.wrap("<form>", [(f"<label>{self.text(1, 3, False)}</label>", 0), (f"<button>{self.text(1, 2, False)}</button>", 0)])
        if kind in (4, 5):
            shell = self.pick('<section class="comments">', '<div class="comments">', '<div id="comments">', '<ol class="comment-list">', '<div class="replies">')
            said = []
            for _ in range(self.some(1, 5)):
                tag = self.pick("p", "div", "li")
                said += [(f'<{tag} class="comment">{self.text(3, 60)}</{tag}>', 0)]
            return self.wrap(shell, [(f"<h3>{self.text(1, 3, False)}</h3>", 0), *said])
        if kind == 6:
            shell = f'<div class="{self.pick("related", "share", "social", "tags", "breadcrumb", "breadcrumbs", "pagination", "recommended")}">'
            return self.wrap(shell, self.links(self.some(1, 6), self.pick("li", "span", "p", "div")))
        if kind == 7 and not inside:
            shell = self.pick("<nav>", '<div class="menu">', '<ul class="nav">', '<div id="nav">', '<div class="navbar">')
            return self.wrap(shell, self.links(self.some(2, 9)))
        return self.wrap(f'<div class="{self.pick("byline", "meta", "author", "popup", "modal", "login")}">', [(f"<p>{self.text(2, 12)}</p>", 0)])

    def wrap(self, shell: str, parts: list[tuple[str, int]]) -> list[tuple[str, int]]:
        tag = re.match(r"<(\w+)", shell)[1]
        return [(shell, -1), *parts, (f"</{tag}>", -1)]

    def page(self) -> tuple[str, list[int]]:
        parts: list[tuple[str, int]] = [(f"<!DOCTYPE html><html><head><title>{self.text(2, 12, False)}</title><style>p{{}}</style><script>var t;</script></head><body>", -1)]
        title = [0]
        if self.chance(0.5):
            shell = self.pick("<header>", '<div class="header">', '<div id="header">', '<div class="masthead">')
            parts += self.wrap(shell, [(f"<{(h := self.pick('p', 'h1', 'h2', 'div'))}>{self.text(1, 6, False)}</{h}>", 0), *self.links(self.some(0, 5))])
        if self.chance(0.85):
            shell = self.pick("<nav><ul>", "<nav>", '<div class="menu">', '<ul class="menu">', '<div id="menu">', '<div class="navigation">')
            closing = "</ul></nav>" if shell == "<nav><ul>" else f"</{re.match(r'<(\w+)', shell)[1]}>"
            parts += [(shell, -1), *self.links(self.some(2, 10)), (closing, -1)]
        for _ in range(self.some(0, 2)):
            parts += self.other()
        shell = self.pick(
            "<article>", "<article>", "<article>", "<main>", "<main><article>", '<div class="content">', '<div id="content">', '<div class="post">',
            '<div class="article">', '<div class="entry-content">', '<section class="story">', '<div id="main">', '<div class="text">', '<div class="article-body">',
        )
        closing = "</article></main>" if shell == "<main><article>" else f"</{re.match(r'<(\w+)', shell)[1]}>"
        parts += [(shell, -1), *self.body(), (closing, -1)]
        for _ in range(self.some(0, 3)):
            parts += self.other()
        if self.chance(0.85):
            shell = self.pick("<footer>", "<footer>", '<div class="footer">', '<div id="footer">')
            parts += self.wrap(shell, [(f"&copy; {self.text(2, 20)}", 0), *(self.links(self.some(1, 5)) if self.chance(0.4) else [])])
        if self.chance(0.9):
            parts.append(("</body></html>", -1))
        return "".join(p for p, _ in parts), title + [y for _, y in parts if y >= 0]


def composed_pages(n: int = COMPOSED, seed: int = 5) -> list[tuple[list[Block], np.ndarray]]:
    """Generated pages; the few whose blocks fall together otherwise than composed are left out."""
    composer, found = _Composer(seed), []
    for _ in range(n):
        html, labels = composer.page()
        page = blocks(html)
        if len(page) == len(labels):
            found.append((page, np.array(labels)))
    return found


def training_pages(pages: DataFrame) -> list[str]:
    """At most SAMPLE pages of the table, those with the least hashes. Pages are counted first, and only
    hashes so low that about four times as many are expected are ranked."""
    usable = pages.where(F.length("html").between(1, SAMPLE_CHARS)).select(F.xxhash64("page_id", "html").alias("_o"), "html")
    highest = min(2**64 * 4 * SAMPLE // max(usable.count(), 1), 2**64 - 1) - 2**63
    return [r["html"] for r in usable.where(F.col("_o") <= highest).orderBy("_o").limit(SAMPLE).collect()]


def fit(pages: DataFrame) -> Weights:
    labelled = composed_pages()
    for page in map(blocks, training_pages(pages)):
        labels = own_labels(page)
        if labels is not None:
            labelled.append((page, labels))
    return train([(vectors(page), labels) for page, labels in labelled])


def _text_batches(batches: Iterable[pa.RecordBatch], weights: Weights) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", 4 << 20):
        pages = [blocks(html or "") for html in batch.column("html").to_pylist()]
        texts = ["\n\n".join(b[1] for b, main in zip(page, mains) if main) for page, mains in zip(pages, label(pages, weights))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of `pages` (page_id, url, html)."""
    weights = pages.sparkSession.sparkContext.broadcast(fit(pages))
    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(lambda b: _text_batches(b, weights.value), "page_id bigint, url string, text string, n_chars bigint")
