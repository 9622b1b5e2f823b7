"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes its sequence of leaf blocks: runs of text between block-level
tags. Features of a block are the tags above it, the words in their class, id
and role, and numbers about its text. The field labels each block main text or
not; its weights are trained here on labelled pages, and Viterbi decodes.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.llm.common import batches_of, map_rows

# ------------------------------------------------------------------- blocks

#: Fixed sets of HTML: elements whose text is no page text, elements without end, elements that break no line.
RAW = frozenset("script style template noscript textarea title iframe noembed noframes xmp svg math select datalist object".split())
#: Of these, the ones that hold the rest of the page where their end is missing; of others only the tag itself is lost.
TO_THE_END = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q ruby rp rt s samp small span strike strong sub sup time tt u var wbr img".split())
#: What an opening tag closes by itself: a paragraph ends at any of these, items and cells at their like.
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: What holds items, rows and cells: an opening one ends what is open of its like up to there, and all within it.
_AROUND = "article aside blockquote details dl fieldset figure footer form header main menu nav ol section table td th ul".split()
HOLDS = {"li": _AROUND, "dt": _AROUND, "dd": _AROUND, "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
#: Elements of a path that features look at: where there are more, sections above, and the last ones, half each.
DEEPEST = 200
#: Elements that say what their part of a page is.
SECTIONS = frozenset("article main nav aside header footer form body section".split())

TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>?"
    r"|(/?)([a-zA-Z][a-zA-Z0-9:-]*+)(?:([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)(?:>|\Z)|([^>]*+)(?:>|\Z)))",
    re.S,
)
END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I) for tag in RAW}
DIGIT = re.compile("[0-9]")
NAMED = re.compile(r"""(class|id|role|itemprop|aria-label|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile(r"[a-z]+")

Path = tuple[str, ...]


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, Path], ...]  # tag and words of class, id and role, from the top
    linked: int  # characters within links


def words_of(attributes: str) -> Path:
    out = []
    if not attributes:
        return ()
    for m in NAMED.finditer(attributes):
        if m[1].lower() == "hidden":
            out.append("hidden")
        elif m[2]:
            out += WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2]).lower())
    return tuple(dict.fromkeys(out))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; character references decoded, white space one space."""
    out: list[Block] = []
    stack: list[tuple[str, Path]] = []
    parts: list[str] = []
    search = TOKEN.search
    linked = links = 0
    at = 0
    places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag
    endless: set[str] = set()

    def cut(depth: int) -> None:
        for gone, _ in reversed(stack[depth:]):
            places[gone].pop()
        del stack[depth:]

    def end_like(tag: str) -> None:
        around = max((places[t][-1] for t in HOLDS[tag] if places.get(t)), default=-1)
        open_ = (held[bisect_right(held, around)] for t in LIKE[tag] if (held := places.get(t)) and held[-1] > around)
        cut(min(open_, default=len(stack)))

    def seen() -> tuple[tuple[str, Path], ...]:
        if len(stack) <= DEEPEST:
            return tuple(stack)
        near = len(stack) - DEEPEST // 2
        far = sorted(i for t in SECTIONS for i in places.get(t, ())[-DEEPEST // 2 :] if i < near)[-(DEEPEST // 2) :]
        return tuple([stack[i] for i in far] + stack[near:])

    def text(piece: str) -> None:
        nonlocal linked
        if "&" in piece:
            piece = html.unescape(piece)
        parts.append(piece)
        if links:
            linked += len(piece)

    def close() -> None:
        nonlocal linked
        if parts:
            joined = " ".join("".join(parts).split())
            if joined and not places.get("option"):
                out.append(Block(joined, seen(), linked))
            parts.clear()
        linked = 0

    while at < len(page):
        m = search(page, at)
        if m is None:
            text(page[at:])
            break
        start, ends, tag, attributes, rough = m.start(), *m.groups()
        if start > at:
            text(page[at:start])
        at = m.end()
        if not tag:
            continue
        tag, attributes = tag.lower(), rough if attributes is None else attributes
        if not ends:
            if tag in RAW:
                if tag in ("svg", "math") and attributes.endswith("/"):
                    continue
                end = None if tag in endless else END[tag].search(page, at)
                if end:
                    at = end.end()
                elif tag in TO_THE_END:
                    at = len(page)
                else:
                    endless.add(tag)  # no end is ahead: none is looked for again
                continue
            if tag == "br":
                parts.append(" ")
                continue
            if tag not in INLINE:
                close()
                if places.get("option") and tag not in ("option", "optgroup"):
                    cut(places["option"][0])
                if tag in LIKE:
                    end_like(tag)
                if tag in CLOSES_P or tag in LIKE:
                    while stack and stack[-1][0] == "p":
                        cut(len(stack) - 1)
                if tag not in VOID and not attributes.endswith("/"):
                    places.setdefault(tag, []).append(len(stack))
                    stack.append((tag, words_of(attributes)))
            elif tag == "a":
                links += 1
        elif tag == "a":
            links = max(0, links - 1)
        elif tag not in INLINE and tag != "br":
            close()
            if places.get(tag):
                cut(places[tag][-1])
    close()
    return out


# ----------------------------------------------------------------- features

WIDTH = 1 << 14
Features = list[int]


def hashed(name: str) -> int:
    return zlib.crc32(name.encode()) % WIDTH


def path_features(path: tuple[tuple[str, Path], ...]) -> Features:
    names = {f"tag {tag}" for tag, _ in path}
    for tag, words in path:
        names.update(f"word {w}" for w in words)
        names.update(f"word {tag} {w}" for w in words)
    last = path[-1][0] if path else ""
    names.add(f"last {last}")
    names.add(f"last two {path[-2][0] if len(path) > 1 else ''} {last}")
    names.update(f"last word {w}" for w in (path[-1][1] if path else ()))
    at = next((i for i in range(len(path) - 1, -1, -1) if path[i][0] in SECTIONS), -1)
    below = "named" if any(words for _, words in path[at + 1 :]) else "bare"
    names.add(f"section {path[at][0] if at >= 0 else ''} {below}")
    return [hashed(n) for n in names]


def steps(name: str, *edges: float) -> tuple[tuple[float, ...], Features]:
    """Edges, and the feature between each two of them."""
    return edges, [hashed(f"text {name} {i}") for i in range(len(edges) + 1)]


WORDS, WORDS_ROUGH = steps("words", 2, 4, 8, 15, 30, 60), (4, 15, 40)
LINKS = steps("links", 0.01, 0.3, 0.7, 0.95)
LINKED_WORDS = [[hashed(f"text links {i} words {j}") for j in range(4)] for i in range(5)]
COMMAS, DIGITS, PLACE = steps("commas", 1, 3, 8), steps("digits", 0.01, 0.1, 0.3), steps("place", 0.1, 0.3, 0.7, 0.9)
STOP, LETTER, OTHER_END = (hashed(f"text ends {x}") for x in ("stop", "letter", "mark"))
SIGN, BAR, EVERY, FIRST, END_OF_PAGE = (hashed(f"text {x}") for x in ("sign", "bar", "every", "first", "end"))


def text_features(block: Block, k: int, n: int) -> Features:
    text, size = block.text, len(block.text)
    words, share, last = text.count(" ") + 1, min(block.linked / size, 1.0), text[-1]
    linked = bisect_right(LINKS[0], share)
    out = [
        EVERY,
        WORDS[1][bisect_right(WORDS[0], words)],
        LINKS[1][linked],
        LINKED_WORDS[linked][bisect_right(WORDS_ROUGH, words)],
        STOP if last in ".!?:;…" else LETTER if last.isalnum() else OTHER_END,
        COMMAS[1][bisect_right(COMMAS[0], text.count(","))],
        DIGITS[1][bisect_right(DIGITS[0], len(DIGIT.findall(text)) / size)],
        PLACE[1][bisect_right(PLACE[0], k / n)],
    ]
    if "©" in text:
        out.append(SIGN)
    if "|" in text or "»" in text or "›" in text:
        out.append(BAR)
    if k == 0:
        out.append(FIRST)
    if k == n - 1:
        out.append(END_OF_PAGE)
    return out


class Marker:
    """Feature numbers of the blocks of a page. Paths repeat within and across pages, so their features are kept, up to a bound."""

    def __init__(self) -> None:
        self.paths: dict = {}

    def __call__(self, page: list[Block]) -> list[Features]:
        if len(self.paths) > 20_000:
            self.paths.clear()
        out, held = [], self.paths
        for k, b in enumerate(page):
            features = held.get(b.path)
            if features is None:
                features = held[b.path] = path_features(b.path)
            out.append(features + text_features(b, k, len(page)))
        return out


# -------------------------------------------------------------------- field


@dataclass
class Field:
    """Weights of each feature for either label (0 other, 1 main) and of each pair of neighbouring labels."""

    weight: np.ndarray
    step: np.ndarray
    edge: np.ndarray  # of the first label

    def labels(self, page: list[Features]) -> list[int]:
        """Viterbi."""
        if not page:
            return []
        sizes = np.fromiter(map(len, page), np.int64, len(page))
        flat = np.fromiter((f for block in page for f in block), np.int64, int(sizes.sum()))
        scores = np.add.reduceat(self.weight[flat], np.r_[0, np.cumsum(sizes)[:-1]], axis=0).tolist()
        (aa, ab), (ba, bb) = self.step.tolist()
        a, b = scores[0][0] + float(self.edge[0]), scores[0][1] + float(self.edge[1])
        back = []
        for x, y in scores[1:]:
            back.append((a + aa < b + ba, a + ab < b + bb))
            a, b = max(a + aa, b + ba) + x, max(a + ab, b + bb) + y
        label = int(b > a)
        out = [label]
        for pair in reversed(back):
            label = int(pair[label])
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[str, list[int]]] | None = None, rounds: int = 60, rate: float = 0.15, penalty: float = 1e-4) -> Field:
    """Maximum likelihood by Adam: forward and backward sums over all pages at once, padded to the longest."""
    mark = Marker()
    seen = [(mark(blocks(p)), y) for p, y in pages or labelled_pages()]
    seen = [(x, y) for x, y in seen if x]
    n, t, f = len(seen), max(len(x) for x, _ in seen), max(len(b) for x, _ in seen for b in x)
    x, y, on = np.full((n, t, f), WIDTH, np.int64), np.zeros((n, t), np.int64), np.zeros((n, t), bool)
    for i, (page, labels) in enumerate(seen):
        if len(page) != len(labels):
            raise ValueError("a label for each block is wanted")
        for j, b in enumerate(page):
            x[i, j, : len(b)] = b
        y[i, : len(page)], on[i, : len(page)] = labels, True
    used, x = np.unique(x, return_inverse=True)
    x = x.reshape(n, t, f)
    w = {"weight": np.zeros((len(used), 2)), "step": np.zeros((2, 2)), "edge": np.zeros(2)}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    rows, flat = np.arange(n), x.ravel()
    for at in range(1, rounds + 1):
        scores = w["weight"][x].sum(axis=2)
        alpha, beta = np.zeros((t, n, 2)), np.zeros((t, n, 2))
        alpha[0] = scores[:, 0] + w["edge"]
        for k in range(1, t):
            moved = np.logaddexp(alpha[k - 1][:, :1] + w["step"][0], alpha[k - 1][:, 1:] + w["step"][1]) + scores[:, k]
            alpha[k] = np.where(on[:, k, None], moved, alpha[k - 1])
        total = np.logaddexp(alpha[-1][:, 0], alpha[-1][:, 1])
        for k in range(t - 2, -1, -1):
            ahead = scores[:, k + 1] + beta[k + 1]
            moved = np.logaddexp(w["step"][:, 0] + ahead[:, :1], w["step"][:, 1] + ahead[:, 1:])
            beta[k] = np.where(on[:, k + 1, None], moved, 0.0)
        chance = np.exp(alpha + beta - total[None, :, None]).transpose(1, 0, 2)
        chance[rows[:, None], np.arange(t)[None, :], y] -= 1
        chance *= on[:, :, None]
        step = np.zeros((2, 2))
        for k in range(1, t):
            both = np.exp(alpha[k - 1][:, :, None] + w["step"] + (scores[:, k] + beta[k])[:, None, :] - total[:, None, None])
            step += both[on[:, k]].sum(axis=0)
            np.add.at(step, (y[on[:, k], k - 1], y[on[:, k], k]), -1)
        each = np.repeat(chance.reshape(-1, 2), f, axis=0)
        slope = {
            "weight": np.column_stack([np.bincount(flat, each[:, c], len(used)) for c in (0, 1)]) / n + penalty * w["weight"],
            "step": step / n, "edge": chance[:, 0].sum(axis=0) / n,
        }
        for k, g in slope.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] -= rate * (first[k] / (1 - 0.9**at)) / (np.sqrt(second[k] / (1 - 0.99**at)) + 1e-8)
    weight = np.zeros((WIDTH + 1, 2))
    weight[used] = w["weight"]
    return Field(weight[:WIDTH], w["step"], w["edge"])


# ------------------------------------------------------------ labelled pages

#: Starts every block of main text while a labelled page is made; a private character.
MARK = "\ue000"
#: Names that pages give to their parts: what the labelled pages draw from.
MAIN_NAMES = "content main article post entry story text body article-body post-content entry-content main-content page-content article-text story-body single prose".split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation main-menu top-menu breadcrumb breadcrumbs site-nav topbar links pager pagination".split(),
    "header": "header site-header masthead top banner branding page-header logo tagline".split(),
    "footer": "footer site-footer bottom copyright legal colophon page-footer foot credits".split(),
    "side": "sidebar side widget related aside recommended more trending popular tags toc archive categories rail".split(),
    "notice": "notice cookie cookie-notice cookies consent gdpr alert message banner popup modal overlay disclaimer paywall subscribe".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promoted adbox ad-slot banner-ad commercial".split(),
    "form": "form search login newsletter signup contact subscribe search-form comment-form".split(),
    "comment": "comment comments comment-list discussion replies reply responses reader-comments user-comment disqus feedback".split(),
    "share": "share social sharing buttons follow toolbar author-box meta byline".split(),
}


def labelled_pages(n: int = 500, seed: int = 3) -> list[tuple[str, list[int]]]:
    """Pages drawn from many layouts, with the label of every block."""
    draw = random.Random(seed)
    pick, chance = draw.choice, lambda p: draw.random() < p

    def word() -> str:
        return "".join(draw.choices(("an", "re", "ti", "on", "é", "ou", "st", "la", "ü", "ed", "os", "er", "ñ", "k"), k=draw.randint(1, 4)))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(draw.randint(low, high)))

    def sentences(low: int, high: int) -> str:
        out = [words(pick((1, 3, 3)), 14).capitalize() + pick(("", f", {words(1, 4)}")) + pick((".", ".", ".", "?", "!")) for _ in range(draw.randint(low, high))]
        return " ".join(out)

    def named(tag: str, names: list[str], plain: float) -> str:
        name = pick(names) + (f" {word()}" if chance(0.2) else "")
        return f"<{tag}>" if chance(plain) else f'<{tag} {pick(("class", "class", "id"))}="{name}">'

    def within(tag: str, text: str) -> str:
        return f"<{tag}>{text}</{tag}>"

    def links() -> str:
        return "".join(within("li", f'<a href="/{word()}">{words(1, 3).title()}</a>') for _ in range(draw.randint(2, 8)))

    def part(kind: str) -> str:
        """A part that is not main text. A bare div or section would give no clue, so only tags that say what they are stand without a name."""
        tag = pick({"menu": ("nav", "nav", "div", "ul"), "header": ("header", "header", "div"), "footer": ("footer", "footer", "div"), "side": ("aside", "aside", "div", "section"), "form": ("form",)}.get(kind, ("div", "div", "section", "aside", "p")))
        head = within(pick(("h2", "h3", "h4", "p")), words(1, 3).title()) if chance(0.3) else ""
        if kind == "menu" or kind == "side" and chance(0.6):
            body = links() if tag == "ul" else f"{head}<ul>{links()}</ul>"
        elif kind == "form":
            body = f"<p>{words(1, 6).title()}</p><label>{words(1, 3)}</label><input name=q><button>{word()}</button>"
        elif tag == "p":
            body = sentences(1, 4)
        elif kind == "comment":
            body = head + "".join(within(pick(("div", "p", "li")), sentences(1, 5)) for _ in range(draw.randint(1, 5)))
        else:
            text = {"header": lambda: words(1, 7).title(), "footer": lambda: pick((f"&copy; {word()}.example.com &middot; {sentences(1, 3)}", sentences(1, 4))), "share": lambda: words(1, 6).title()}.get(kind, lambda: sentences(1, 4))
            body = text() if chance(0.5) else head + "".join(within("p", text()) for _ in range(draw.randint(1, 3)))
        return named(tag, OTHER_NAMES[kind], 0.35 if tag in ("nav", "header", "footer", "aside", "form") else 0.0) + body + f"</{tag}>"

    def structure() -> str:
        """A table, definition list, figure or listing of the main text."""
        short = lambda: MARK + pick((words(1, 3).capitalize(), str(draw.randint(1, 2100)), f"{draw.randint(1, 99)}.{draw.randint(0, 9)} %"))
        end = lambda tag: pick((f"</{tag}>", f"</{tag}>", ""))
        kind = draw.randrange(4)
        if kind == 0:
            across = draw.randint(2, 4)
            row = lambda tag: "<tr>" + "".join(f"<{tag}>{short()}{end(tag)}" for _ in range(across)) + end("tr")
            return f"<table>{row('th') if chance(0.6) else ''}{''.join(row('td') for _ in range(draw.randint(1, 5)))}</table>"
        if kind == 1:
            return "<dl>" + "".join(f"<dt>{short()}{end('dt')}<dd>{MARK}{sentences(1, 2) if chance(0.6) else words(1, 4)}{end('dd')}" for _ in range(draw.randint(1, 5))) + "</dl>"
        if kind == 2:
            return f"<figure><img src='/{word()}.png'><figcaption>{MARK}{words(2, 8).capitalize()}{pick(('.', ''))}</figcaption></figure>"
        return within("pre", f"{MARK}{word()} = {word()}({draw.randint(0, 99)})\n{word()}: {words(1, 4)}")

    def piece() -> str:
        """A part of the main text; every block of it starts with the mark."""
        kind = draw.randrange(10)
        if kind == 9 and chance(0.5):
            return structure()
        if kind == 0:
            return within(pick(("h2", "h3")), MARK + words(2, 6).capitalize())
        if kind == 1:
            return within("blockquote", MARK + sentences(1, 4))
        if kind == 2:
            return within(pick(("ul", "ol")), "".join(within("li", MARK + (sentences(1, 2) if chance(0.7) else words(1, 5))) for _ in range(draw.randint(1, 5))))
        if kind == 3:
            return f"<p>{MARK}{sentences(1, 3)} <a href='/{word()}'>{words(1, 5)}</a> {sentences(1, 3)}</p>"
        if kind == 4:
            return f"<p>{MARK}{words(1, 6).upper()}!! {words(1, 6).upper()}!!</p>"
        if kind == 5:
            return f"<p>{MARK}<b>{words(1, 6)}</b> {sentences(1, 3)}<br>{sentences(1, 3)}" + pick(("", "</p>"))
        if kind == 6:
            return f"<p>{MARK}{words(1, 3).capitalize()}.</p>"
        return f"<p>{MARK}{sentences(1, 8)}</p>"

    def article() -> str:
        body = ""
        if chance(0.8):
            title = within("h1", MARK + words(2, 8).capitalize())
            body = within("header", title) if chance(0.15) else title
        if chance(0.2):
            body += part("share")
        for _ in range(draw.randint(1, 12)):
            body += piece() + (part(pick(("advert", "advert", "side", "form", "notice", "share"))) if chance(0.08) else "")
        body += part("comment") if chance(0.25) else ""
        if chance(0.12):
            return body  # straight in what is around it
        tag = pick(("article", "article", "main", "div", "section"))
        if tag in ("div", "section") and chance(0.4):
            # a container whose name, if any, says nothing
            name = f'<{tag} class="{pick((word(), word() + str(draw.randint(1, 9)), "x" + str(draw.randint(1, 99)), "row", "col", "inner", "box"))}">'
            return pick((f"<{tag}>", name)) + body + f"</{tag}>"
        return named(tag, MAIN_NAMES, 0.5 if tag in ("article", "main") else 0.0) + body + f"</{tag}>"

    out = []
    for _ in range(n):
        before = "".join(part(k) for k in draw.sample(("header", "menu", "notice", "advert", "form"), draw.randint(1, 4)))
        after = "".join(part(k) for k in draw.sample(("comment", "side", "advert", "share", "form", "menu"), draw.randint(0, 3)))
        middle = article()
        if chance(0.3):
            middle = pick(("<main>{}</main>", '<div class="container">{}</div>', '<div id="page">{}</div>', "<div>{}</div>", "<div><div>{}</div></div>")).format(middle)
        page = before + middle + after + (part("footer") if chance(0.85) else "")
        page = f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{margin:0}}</style></head><body>{within('div', page) if chance(0.3) else page}</body></html>"
        out.append((page.replace(MARK, ""), [int(MARK in b.text) for b in blocks(page)]))
    return out


# ----------------------------------------------------------------- operator


def main_blocks(page: str | None, field: Field, mark: Marker) -> list[str]:
    page = blocks(page or "")
    return [b.text for b, label in zip(page, field.labels(mark(page)), strict=True) if label]


def main_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of (page_id, url, html).

    ``text`` joins the main blocks in order by one space; a null or empty page,
    or one without main text, gives an empty text of no characters. Repeated
    rows and null ids or addresses come back as they are; other columns are not
    looked at; an empty table gives an empty one. Broken markup is read as far
    as it goes: an open tag at the end is no text.
    """
    field = field or train()

    def extract(ids: pa.Array, urls: pa.Array, held: pa.Array) -> Iterator:
        mark = Marker()
        texts = [" ".join(main_blocks(p, field, mark)) for p in held.to_pylist()]
        return [ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    batches_of(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_rows(rows, "page_id long, url string, text string, n_chars long", extract, "page_id", "url", "html")
