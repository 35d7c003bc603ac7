"""HTML extraction by a recurrent block labeller.

A page is read into its leaf blocks: stretches of text between block-level
tags, each with the path of open elements (tags, classes, ids). A block
becomes a vector of hashed path tokens, hashed words and a few numbers
(length, share of link text, signs at the end, place in the page, share of
the page's text that its container holds, known names in its path). A
bidirectional LSTM reads the page's blocks in both directions, so every
block is judged in the light of the whole document, and labels each as main
text or not. Network and training are plain numpy.

Training needs no hand labels: a bounded sample of ``TRAIN_PAGES`` pages (a
parameter; smallest hash of the page id) is labelled by the meaning of its
elements (article and main against nav, header, footer, aside, form and
containers named after such things), and varied: main text moves into
containers with usual, strange or no names, and blocks from elsewhere are
put in as menus, sidebars, notices, adverts, forms and reader comments, also
under strange names; in half of the pages letters are exchanged. So names,
text form and neighbourhood are all learnt, and none is needed.

Reading is linear: a comment, tag or quoted value that is never closed takes
the rest of the page, as in browsers. Of paths deeper than 32 elements the 8
outermost and 24 innermost count.

Both training and extraction are Arrow map stages; extraction has no
shuffle, and texts are never cut.

Defined results: null html is an empty page; a page without text blocks, or
without a block labelled as main text, has an empty text; repeated rows are
extracted each for itself; an empty page table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import one_row
from vintage.llm.textbatch import PUNCT, U, hashed, prefix, slices, spans

TRAIN_PAGES = 400
EPOCHS = 6
#: Varied forms of every training page.
VARIED = 4
HIDDEN = 16
PATH_DIM, WORD_DIM = 48, 256
#: Pages whose recurrences run together.
TOGETHER = 64

#: Elements that begin a block, whose text is never text of the
#: page, and that have no content.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead title tr ul".split())
SILENT = frozenset("script style template textarea select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content follows the rules of XML.
FOREIGN = frozenset(("svg", "math"))
#: Names of containers, by what they usually hold.
MAIN_NAMES = "article content main post entry story body text page-content post-content entry-content article-body article-text".split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation breadcrumb toc tabs pagination",
    "head": "header masthead banner topbar branding site-header",
    "foot": "footer bottom copyright site-footer credits legal",
    "side": "sidebar aside widget related recommended trending rail",
    "note": "cookie notice consent gdpr alert popup modal paywall",
    "advert": "ad ads advert advertisement sponsored promo promotion",
    "form": "form login signup newsletter subscribe search",
    "comment": "comment comments reply replies discussion respond reader-comments",
    "share": "share social meta byline tags author-box",
}
_OTHER = {w for names in OTHER_NAMES.values() for w in names.split()}
_OTHER_TAGS = frozenset("nav header footer aside form title head menu button".split())
_NAME = re.compile(r"[A-Za-z]+")


#: A tag's or an attribute's name, and the raw content's end of the elements whose content is no markup.
_TAG = re.compile(r"[A-Za-z][^\s/>]*+")
_BETWEEN = re.compile(r"[\s/]*+")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+)?+")
_PLAIN = re.compile(r"[^\s>]*+")
_SHORT = re.compile("-?>")
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style")}
#: Elements of a path that count: so many outermost and innermost ones.
OUTER, INNER = 8, 24


class _Blocks:
    """Leaf blocks as (path, text, characters of link text), in one pass: a
    comment, tag or quoted value that nothing closes takes the rest of the
    page, as in browsers, so no position is read twice."""

    def __init__(self):
        self.open: list[tuple[str, str]] = []
        self.count: Counter = Counter()
        self.nearest: list[int] = []
        self.blocks: list[tuple[str, str, int]] = []
        self.text: list[str] = []
        self.linked = self.silent = 0

    def end_block(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                path = self.open if len(self.open) <= OUTER + INNER else self.open[:OUTER] + self.open[-INNER:]
                self.blocks.append((" ".join(t for _, t in path), text, self.linked))
            self.text, self.linked = [], 0

    def close(self, at: int):
        while len(self.open) > at:
            tag, _ = self.open.pop()
            self.count[tag] -= 1
            self.silent -= tag in SILENT
            if self.nearest and self.nearest[-1] == len(self.open):
                self.nearest.pop()

    def begin(self, tag: str, attributes: list[tuple[str, str]]):
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCKS:
            self.end_block()
            # a paragraph ends where the next block begins, an item where the next one does
            for same in ("p", "li") if tag == "li" else ("p",):
                if self.nearest and self.open[self.nearest[-1]][0] == same:
                    self.close(self.nearest[-1])
        if tag in VOID:
            return
        names = [tag]
        for key, value in attributes:
            if key in ("class", "id", "role") and value:
                names += [f".{w}" for w in [value.lower(), *value.lower().split(), *_NAME.findall(value.lower())]]
        if tag in BLOCKS:
            self.nearest.append(len(self.open))
        self.open.append((tag, " ".join(dict.fromkeys(n.replace(" ", "_") for n in names))))
        self.count[tag] += 1
        self.silent += tag in SILENT

    def end(self, tag: str):
        if tag in BLOCKS:
            self.end_block()
        if self.count[tag]:
            at = len(self.open) - 1
            while self.open[at][0] != tag:
                at -= 1
            self.close(at)

    def data(self, data: str):
        if data and not self.silent:
            self.text.append(data)
            if self.count["a"]:
                self.linked += len(data)

    def _start_tag(self, html: str, at: int) -> int:
        """Reads the tag at ``at``; where to go on."""
        name = _TAG.match(html, at + 1)
        tag, i, attributes = name[0].lower(), name.end(), []
        while True:
            i = _BETWEEN.match(html, i).end()
            if i >= len(html):
                return i
            if html[i] == ">":
                break
            m = _ATTRIBUTE.match(html, i)
            key, value, i = m[1], "", m.end()
            if m.end() > m.end(1):
                if html[i:i + 1] in ("'", '"') and i < len(html):
                    to = html.find(html[i], i + 1)
                    if to < 0:
                        return len(html)
                    value, i = html[i + 1:to], to + 1
                else:
                    value = _PLAIN.match(html, i)[0]
                    i += len(value)
            attributes.append((key.lower(), unescape(value)))
        self.begin(tag, attributes)
        if html[i - 1] == "/":
            if tag not in VOID:
                self.end(tag)
        elif tag in _RAW:
            stop = _RAW[tag].search(html, i)
            return stop.start() if stop else len(html)
        return i + 1

    def read(self, html: str):
        def after(sign: str, i: int) -> int:
            to = html.find(sign, i)
            return to + len(sign) if to >= 0 else len(html)

        at = 0
        while at < len(html):
            to = html.find("<", at)
            if to < 0:
                to = len(html)
            if to > at:
                self.data(unescape(html[at:to]))
            at = to
            if at >= len(html):
                break
            if _TAG.match(html, at + 1):
                at = self._start_tag(html, at)
            elif html.startswith("</", at):
                name = _TAG.match(html, at + 2)
                stop = after(">", at + 2)
                if name and html[stop - 1] == ">":
                    self.end(name[0].lower())
                at = stop
            elif html.startswith("<!--", at):
                short = _SHORT.match(html, at + 4)
                at = short.end() if short else after("-->", at + 4)
            elif html.startswith("<![CDATA[", at) and any(self.count[t] for t in FOREIGN):
                # a section of foreign markup is text, any other "<!" a comment up to the next ">"
                stop = html.find("]]>", at)
                if stop < 0:
                    stop = len(html)
                self.data(html[at + 9:stop])
                at = stop + 3
            elif html[at + 1:at + 2] in ("!", "?") and at + 1 < len(html):
                at = after(">", at + 2)
            else:
                self.data("<")
                at += 1
        self.end_block()


def blocks(html: str | None) -> list[tuple[str, str, int]]:
    """(path, text, characters of link text) of the leaf blocks, in page order."""
    reader = _Blocks()
    reader.read(html or "")
    return reader.blocks


NUMBERS = 14
DIM = PATH_DIM + WORD_DIM + NUMBERS
_paths: dict[str, np.ndarray] = {}


def _path_vector(path: str) -> np.ndarray:
    have = _paths.get(path)
    if have is None:
        have = np.zeros(PATH_DIM)
        tokens = path.split()
        for k, token in enumerate(tokens):
            rng = random.Random(token)
            # every token has its own direction; the innermost ones weigh more
            have += np.array([rng.gauss(0, 1) for _ in range(PATH_DIM)]) * (0.5 if k < len(tokens) - 4 else 0.8)
        if len(_paths) > 20_000:
            _paths.clear()
        _paths[path] = have
    return have


@lru_cache(20_000)
def _known(path: str) -> tuple[float, float]:
    meaning = _meaning(path)
    return 1.0 * (meaning == 1), 1.0 * (meaning == 0)


@lru_cache(20_000)
def _holder(path: str) -> str:
    """The path without its innermost element."""
    tokens = path.split()
    at = len(tokens) - 1
    while at > 0 and tokens[at].startswith("."):
        at -= 1
    return " ".join(tokens[:max(at, 0)])


def vectors(page: list[tuple[str, str, int]]) -> np.ndarray:
    """One row per block."""
    out = np.zeros((len(page), DIM))
    for first, data, bounds in slices(pa.array([t for _, t, _ in page], pa.string())):
        start, end, row = spans(data, bounds, PUNCT)
        h = hashed(prefix(data), start, end)
        sign = np.where((h >> U(40)) & U(1), 1.0, -1.0)
        at = (h >> U(60 - 0)).astype(np.int64) % WORD_DIM
        np.add.at(out, (first + row, PATH_DIM + at), sign)
    words = out[:, PATH_DIM:PATH_DIM + WORD_DIM]
    words /= np.maximum(1.0, np.sqrt((words ** 2).sum(axis=1, keepdims=True)))
    n = len(page)
    # where the page's running text lies, and what the names of elements mean
    held: Counter = Counter()
    holders = [_holder(path) for path, _, _ in page]
    for holder, (_, text, linked) in zip(holders, page):
        held[holder] += len(text) - linked
    number = Counter(holders)
    most, whole = max(held.values(), default=0) or 1, sum(held.values()) or 1
    for i, (path, text, linked) in enumerate(page):
        out[i, :PATH_DIM] = _path_vector(path) / 3
        size = len(text)
        out[i, PATH_DIM + WORD_DIM:] = (
            np.log1p(size) / 5, linked / size, text[-1] in ".!?…", text.count(" ") > 8, i / n, n / 50, text.count(".") / size * 20, 1.0,
            held[holders[i]] / whole, held[holders[i]] / most, held[holders[i]] == most, np.log1p(held[holders[i]] / number[holders[i]]) / 5, *_known(path))
    return out


# ------------------------------------------------------------------ network

def _start(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    net = {}
    for way in ("f", "b"):
        net["x" + way] = rng.normal(0, 1 / np.sqrt(DIM), (DIM, 4 * HIDDEN))
        net["h" + way] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        net["c" + way] = np.zeros(4 * HIDDEN)
        net["c" + way][HIDDEN:2 * HIDDEN] = 1.0
    net["out"] = rng.normal(0, 0.1, (2 * HIDDEN + DIM, 1))
    net["bias"] = np.zeros(1)
    return net


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(net, way, x, mask):
    """States over x (pages, blocks, DIM); masked steps keep the state."""
    pages, steps, _ = x.shape
    h = c = np.zeros((pages, HIDDEN))
    into = x @ net["x" + way] + net["c" + way]
    states, kept = np.zeros((pages, steps, HIDDEN)), []
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        z = into[:, t] + h @ net["h" + way]
        i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[:, t, None]
        c1 = f * c + i * g
        tc = np.tanh(c1)
        kept.append((t, h, c, i, f, o, g, tc, m))
        c = m * c1 + (1 - m) * c
        h = m * (o * tc) + (1 - m) * h
        states[:, t] = h
    return states, kept


def _back(net, way, x, kept, d_states, grad):
    dh = np.zeros((x.shape[0], HIDDEN))
    dc = np.zeros_like(dh)
    for t, h, c, i, f, o, g, tc, m in reversed(kept):
        dh = dh + d_states[:, t]
        dnew, dh = dh * m, dh * (1 - m)
        dc1 = dc * m + dnew * o * (1 - tc ** 2)
        dz = np.concatenate([dc1 * g * i * (1 - i), dc1 * c * f * (1 - f), dnew * tc * o * (1 - o), dc1 * i * (1 - g ** 2)], axis=1)
        grad["x" + way] += x[:, t].T @ dz
        grad["h" + way] += h.T @ dz
        grad["c" + way] += dz.sum(axis=0)
        dh = dh + dz @ net["h" + way].T
        dc = dc * (1 - m) + dc1 * f


def _stack(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), steps, DIM)), np.zeros((len(pages), steps))
    for k, p in enumerate(pages):
        x[k, :len(p)], mask[k, :len(p)] = p, 1
    return x, mask


def probabilities(net: dict[str, np.ndarray], pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of main text for every block of every page."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        # pages of like length together, and few when they are long
        size = max(1, min(TOGETHER, 20_000 // len(pages[order[min(at + TOGETHER, len(order)) - 1]])))
        group = order[at:at + size]
        x, mask = _stack([pages[k] for k in group])
        p = _sigmoid(np.concatenate([_lstm(net, "f", x, mask)[0], _lstm(net, "b", x, mask)[0], x], axis=2) @ net["out"] + net["bias"])
        for j, k in enumerate(group):
            out[k] = p[j, :len(pages[k]), 0]
        at += size
    return out


def fit(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Network trained on (vectors, labels) by back-propagation through time."""
    net = _start()
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    rng, step = np.random.default_rng(5), 0
    for epoch in range(epochs):
        order = sorted(rng.permutation(len(pages)).tolist(), key=lambda k: len(pages[k][1]) + 3 * rng.random())
        groups = [order[a:a + 16] for a in range(0, len(order), 16)]
        for k in rng.permutation(len(groups)):
            x, mask = _stack([pages[j][0] for j in groups[k]])
            y = np.zeros(mask.shape)
            for a, j in enumerate(groups[k]):
                y[a, :len(pages[j][1])] = pages[j][1]
            f, kf = _lstm(net, "f", x, mask)
            b, kb = _lstm(net, "b", x, mask)
            both = np.concatenate([f, b, x], axis=2)
            p = _sigmoid(both @ net["out"] + net["bias"])[..., 0]
            d = ((p - y) * mask / mask.sum())[..., None]
            grad = {n: np.zeros_like(v) for n, v in net.items()}
            grad["out"] += np.einsum("psk,psj->kj", both, d)
            grad["bias"] += d.sum(axis=(0, 1))
            back = d @ net["out"].T
            _back(net, "f", x, kf, back[..., :HIDDEN], grad)
            _back(net, "b", x, kb, back[..., HIDDEN:2 * HIDDEN], grad)
            step += 1
            for n, v in net.items():
                g = np.clip(grad[n], -1, 1)
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                v -= 0.01 * (first[n] / (1 - 0.9 ** step)) / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8)
    return net


# ----------------------------------------------------------------- training

def _meaning(path: str) -> int | None:
    """Label that the elements' meaning gives: 1, 0 or none."""
    tokens = path.split()
    if any(t in _OTHER_TAGS or t[1:] in _OTHER and t[0] == "." for t in tokens):
        return 0
    if any(t in ("article", "main") or t[0] == "." and t[1:] in MAIN_NAMES for t in tokens):
        return 1
    return None


def _strange(rng: random.Random) -> str:
    """A name that says nothing."""
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(rng.randint(2, 9)))


def _varied(page: list[tuple[str, str, int]], pool: list[str], rng: random.Random) -> tuple[list, list]:
    """A page with its main text in another container and other blocks put in;
    names are usual ones, strange ones or missing, and in half of the pages the
    letters are exchanged, so that words say nothing."""
    main = rng.choice([rng.choice([f"div .{n}" for n in MAIN_NAMES] + ["main", "article"]), rng.choice(["", "div", "section"]),
                       f"{rng.choice(['div', 'section'])} .{_strange(rng)}"])
    out, labels = [], []

    def other(n: int, inside: str):
        kind = rng.choice([*OTHER_NAMES, "comment", "note"])
        name = rng.choice(OTHER_NAMES[kind].split())
        tag = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}.get(kind, "div")
        holder = rng.choice([f"{tag} .{name}", f"div .{name}", f"section .{name}", tag if tag != "div" else f"div .{name}"])
        if rng.random() < 0.55:
            holder = f"{rng.choice(['div', 'section', 'ul', 'div div'])} .{_strange(rng)}"
        leaf = {"menu": "ul li a", "form": "label", "comment": "p"}.get(kind, rng.choice(["p", "p", "div", "ul li a", "span", "h3"]))
        for _ in range(n):
            words = rng.choice(pool).split()
            short = kind in ("menu", "head", "form", "share") or leaf == "ul li a"
            at = rng.randrange(len(words))
            text = " ".join(words[at:at + (rng.randint(1, 4) if short else rng.choice([rng.randint(3, 20), rng.randint(3, 60)]))]) or "x"
            if not short and rng.random() < 0.7:
                text = text[0].upper() + text[1:] + ("" if text[-1] in ".!?" else rng.choice("...!?"))
            path = " ".join(x for x in (inside, holder, leaf) if x)
            out.append((path, text, len(text) if "a" in leaf.split() else 0))
            labels.append(0)

    for _ in range(rng.randint(0, 2)):
        other(rng.randint(1, 6), "html body")
    for path, text, linked in page:
        label = _meaning(path)
        if label is None:
            continue
        if label:
            tokens = path.split()
            at = next(k for k, t in enumerate(tokens) if t in ("article", "main") or t[0] == "." and t[1:] in MAIN_NAMES)
            at -= tokens[at][0] == "."
            path = " ".join(x for x in (*tokens[:at], main, *[t for t in tokens[at + 1:] if t[0] != "." and t not in ("article", "main")]) if x)
        out.append((path, text, linked))
        labels.append(label)
        if label and rng.random() < 0.03:
            other(rng.randint(1, 3), path.rpartition(" ")[0])
    for _ in range(rng.randint(0, 3)):
        other(rng.randint(1, 6), "html body")
    if rng.random() < 0.5:
        letters = "abcdefghijklmnopqrstuvwxyz"
        other_letters = "".join(rng.sample(letters, 26))
        swap = str.maketrans(letters + letters.upper(), other_letters + other_letters.upper())
        out = [(path, text.translate(swap), linked) for path, text, linked in out]
    return out, labels


def _learnt(htmls: list[str]) -> dict[str, np.ndarray]:
    """The network that the pages teach, each as it is and varied."""
    read = [p for p in map(blocks, htmls) if p]
    pool = [t for p in read for _, t, _ in p] or ["x"]
    rng, made = random.Random(11), []
    for p in read:
        plain = [(b, y) for b in p if (y := _meaning(b[0])) is not None]
        made.append(([b for b, _ in plain], [y for _, y in plain]))
        made += [_varied(p, pool, rng) for _ in range(VARIED)]
    made = [(vectors(b), np.array(y, float)) for b, y in made if b]
    return fit(made) if made else _start()


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = TRAIN_PAGES) -> dict[str, np.ndarray]:
    """Network from at most ``most`` pages, one of every id. One task learns from the bounded
    sample; what it returns has a fixed size."""
    ids = pages.filter(F.col(html_col).isNotNull()).select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64("id")).limit(most)
    rows = pages.filter(F.col(html_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    sample = one_row(rows, ids, "html").select("html", F.xxhash64("html").alias("rank"))

    def learn(batches):
        rows = sorted((r, h) for b in batches for h, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if h)
        net = _learnt([h for _, h in rows])
        yield pa.RecordBatch.from_arrays([pa.array(list(net)), pa.array([v.astype("<f8").tobytes() for v in net.values()], pa.binary())], names=["k", "v"])

    shapes = {k: v.shape for k, v in _start().items()}
    got = sample.repartition(1).mapInArrow(learn, "k string, v binary").collect()
    return {r["k"]: np.frombuffer(r["v"], "<f8").reshape(shapes[r["k"]]) for r in got} or _start()


def extract(pages: DataFrame, net: dict[str, np.ndarray], html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with ``html_col`` replaced by the main text."""
    shared = pages.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            k = batch.schema.get_field_index(html_col)
            names = [n for n in batch.schema.names if n != html_col]
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                read = [blocks(h) for h in part.column(k).to_pylist()]
                chosen = probabilities(shared.value, [vectors(p) for p in read])
                texts = ["\n".join(t for (_, t, _), y in zip(p, q) if y >= 0.5) for p, q in zip(read, chosen)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(n)) for n in names], pa.array(texts, pa.string())], names=[*names, text_col])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html_col] + [f"`{text_col}` string"])
    return pages.mapInArrow(run, schema)
