"""Main text of web pages by a linear-chain conditional random field (operator 5).

A page becomes its leaf blocks: runs of text between block-level tags, in page
order.  Each block has features of its ancestor tags, their class and id words
and its own text; a two-label chain (main text or not) over the blocks is
trained on labelled pages and decoded by Viterbi.
"""

from __future__ import annotations

import html as html_lib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W

#: Labelled pages the field is trained on at most (those with the smallest hashed ids), and layouts made of each.
TRAIN_PAGES, LAYOUTS = 150, 9
STEPS, RATE, L2 = 200, 0.2, 0.002

# Fixed values of HTML: block-level elements, elements without content, and those whose content is no text.
BLOCK = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()) - {"br"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.  The first four run to their end tag, or to the end of the page;
#: the others without an end tag, or closed in their start tag, are empty.
TO_END = set("script style textarea title".split())
RAW = TO_END | set("noscript template iframe svg object canvas audio video noembed noframes xmp".split())
# Elements that a start tag closes, up to the element that holds them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"})}
MAIN_TAGS = {"article", "main"}
OTHER_TAGS = {"nav", "aside", "footer", "form", "header", "button", "select", "menu", "dialog"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_PART = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block(NamedTuple):
    """A leaf block: its text, its ancestors' features and how much of the text lies in links."""

    text: str
    tags: frozenset
    parent: str
    linked: int


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order; character references decoded, white space single.

    Comments, scripts, styles, the head and other elements without readable
    content give nothing.  Tags left open are closed as browsers do it for
    paragraphs, list items and table cells; stray end tags are ignored.
    """
    out: list[Block] = []
    stack: list[tuple[str, frozenset]] = []  # (tag, features of it and its ancestors)
    parts: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                holder = next((t for t, _ in reversed(stack) if t in BLOCK), "")
                out.append(Block(text, stack[-1][1] if stack else frozenset(), holder, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal links
        if any(t in BLOCK for t, _ in stack[upto:]):
            flush()
        links -= sum(t == "a" for t, _ in stack[upto:])
        del stack[upto:]

    def words(raw: str) -> None:
        nonlocal linked
        if raw:
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        words(page[at:m.start()])
        at = m.end()
        if not m.group(2):
            continue
        end, tag = m.group(1), m.group(2).lower()
        if end:
            where = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if where >= 0:
                close(where)
            continue
        if tag in RAW or tag == "head":
            stop = re.compile(rf"</{tag}\s*>" if tag != "head" else r"</head\s*>|<body\b", re.I).search(page, at)
            if tag not in TO_END and (stop is None or m.group(3).rstrip().endswith("/")):
                continue
            at = len(page) if stop is None else stop.start() if stop.group().lower().startswith("<body") else stop.end()
            continue
        if tag in VOID:
            if tag == "br":
                parts.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            flush()
            for i in range(len(stack) - 1, -1, -1):  # an open paragraph ends here
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        if tag in CLOSES:
            ends, holders = CLOSES[tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    close(i)
                    break
                if stack[i][0] in holders:
                    break
        own = [f"t:{tag}"] if tag in BLOCK or tag in ("button", "label", "a") else []
        if "=" in m.group(3):
            for _, a, b, c in ATTRIBUTE.findall(m.group(3)):
                own += [f"c:{w}" for w in NAME_PART.findall(CAMEL.sub(" ", a or b or c).lower())]
        above = stack[-1][1] if stack else frozenset()
        stack.append((tag, above.union(own) if own else above))
        links += tag == "a"
    words(page[at:] if not page[at:].startswith("<") else "")
    flush()
    return out


def features(block: Block, number: int, total: int) -> list[str]:
    n = block.text.count(" ") + 1
    share = block.linked / len(block.text)
    last = block.text[-1]
    return [
        "bias", *block.tags, f"p:{block.parent}",
        f"n:{(n > 2) + (n > 5) + (n > 10) + (n > 20) + (n > 50)}",
        f"l:{(share > 0) + (share > 0.33) + (share > 0.66)}",
        f"e:{'stop' if last in '.!?…\"”»' else 'colon' if last in ':,;' else 'none'}",
        f"m:{'©' in block.text}", f"o:{4 * number // total}", f"s:{', ' in block.text or '. ' in block.text}",
    ]


class Field:
    """A linear-chain conditional random field with two labels; label 1 is main text."""

    def __init__(self, names: list[str]):
        self.index = {f: i for i, f in enumerate(names)}
        self.emit, self.move = np.zeros((len(names), 2)), np.zeros((2, 2))

    def rows(self, page: list[Block]) -> list[list[int]]:
        known = self.index.get
        return [[i for f in features(b, k, len(page)) if (i := known(f)) is not None] for k, b in enumerate(page)]

    def train(self, pages: list[list[list[int]]], labels: list[list[int]], steps: int = STEPS, rate: float = RATE, l2: float = L2) -> None:
        """Maximum likelihood by Adam; every gradient is the exact forward-backward one over all pages."""
        count, most = len(pages), max(map(len, pages))
        # blocks with the same features share one pattern
        number: dict[tuple[int, ...], int] = {}
        pattern = np.array([number.setdefault(tuple(r), len(number)) for p in pages for r in p])
        feature = np.concatenate([np.array(r, np.int64) for r in number])
        holder = np.repeat(np.arange(len(number)), [len(r) for r in number])
        place = np.array([i * most + j for i, p in enumerate(pages) for j in range(len(p))])
        length = np.array([len(p) for p in pages])
        real = np.arange(most) < length[:, None]
        gold = np.zeros((count, most), np.int64)
        for i, y in enumerate(labels):
            gold[i, :len(y)] = y
        pair = np.zeros((2, 2))
        np.add.at(pair, (gold[:, :-1][real[:, 1:]], gold[:, 1:][real[:, 1:]]), 1)

        def per_feature(weight: np.ndarray) -> np.ndarray:
            """Sums over blocks (count * most, 2) for every feature and label."""
            own = (np.bincount(pattern, weights=weight[place, y], minlength=len(number)) for y in (0, 1))
            return np.stack([np.bincount(feature, weights=w[holder], minlength=len(self.emit)) for w in own], axis=1)

        seen = per_feature(np.eye(2)[gold.reshape(-1)])
        total = real.sum()
        state = [np.zeros_like(self.emit), np.zeros_like(self.emit), np.zeros((2, 2)), np.zeros((2, 2))]
        for step in range(1, steps + 1):
            score = np.zeros((count * most, 2))
            for y in (0, 1):
                score[place, y] = np.bincount(holder, weights=self.emit[feature, y], minlength=len(number))[pattern]
            score = score.reshape(count, most, 2)
            fore, back = score.copy(), np.zeros_like(score)
            for j in range(1, most):
                fore[:, j] += np.where(real[:, j, None], np.logaddexp.reduce(fore[:, j - 1, :, None] + self.move, axis=1), 0)
            for j in range(most - 2, -1, -1):
                back[:, j] = np.where(real[:, j + 1, None], np.logaddexp.reduce(self.move + (score[:, j + 1] + back[:, j + 1])[:, None, :], axis=2), 0)
            norm = np.logaddexp.reduce(fore[np.arange(count), length - 1], axis=1)
            alone = np.exp(fore + back - norm[:, None, None]) * real[:, :, None]
            both = np.exp(fore[:, :-1, :, None] + self.move + (score + back)[:, 1:, None, :] - norm[:, None, None, None]) * real[:, 1:, None, None]
            expected = per_feature(alone.reshape(-1, 2))
            for k, (weight, slope) in enumerate(((self.emit, (seen - expected) / total - l2 * self.emit / len(self.emit)), (self.move, (pair - both.sum(axis=(0, 1))) / total))):
                m, v = state[2 * k], state[2 * k + 1]
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                weight += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The likeliest labels (Viterbi); ties go to label 0."""
        if not rows:
            return []
        move = self.move.tolist()
        best, back = None, []
        for r in rows:
            e0, e1 = self.emit[r].sum(axis=0).tolist()
            if best is None:
                best = (e0, e1)
                continue
            a, b, c, d = best[0] + move[0][0], best[1] + move[1][0], best[0] + move[0][1], best[1] + move[1][1]
            back.append((int(b > a), int(d > c)))
            best = (max(a, b) + e0, max(c, d) + e1)
        labels = [int(best[1] > best[0])]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


# Words that class and id names of page parts are made of.
MAIN_NAMES = "content main article post entry story body text page single prose markdown".split()
OTHER_NAMES = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs links toc pager pagination tabs".split(),
    "header": "header masthead banner top logo branding site".split(),
    "footer": "footer bottom copyright legal colophon credits".split(),
    "side": "sidebar side aside widget related recommended popular trending rail more tags".split(),
    "notice": "notice cookie consent gdpr alert popup modal overlay paywall subscribe newsletter message warning disclaimer".split(),
    "advert": "ad ads advert advertisement sponsored promo promoted sponsor banner commercial outbrain taboola".split(),
    "form": "form search login signup register contact input field".split(),
    "comments": "comment comments reply replies discussion respond disqus responses thread reader readers".split(),
    "share": "share sharing social byline meta follow author date buttons print".split(),
}


def layouts(main: list[str], other: list[str], prose: list[str], rng: np.random.Generator, count: int) -> list[tuple[str, list[int]]]:
    """(page, labels of its blocks): the same texts in pages of other layouts.

    Main blocks stand as paragraphs, headings, list items, quotes or cells in
    a container of some name; menus, headers, footers, side bars, notices,
    adverts, forms and reader comments stand around and among them.  ``other``
    gives the short texts of these parts, ``prose`` (main texts of any page)
    those of comments and of some adverts, notices and side bars.
    """
    def pick(xs):
        return xs[int(rng.integers(len(xs)))]

    def cut(text: str, n: int) -> str:
        return html_lib.escape(" ".join(text.split()[:n]))

    def long(n: int) -> str:
        """A text of a part that may look like main text."""
        return some(n) if rng.random() < 0.5 else cut(pick(prose), n) + pick([".", "!", ""])

    def some(n: int) -> str:
        words = " ".join(pick(other).split() or ["-"])[: int(rng.integers(8, 200))].split()
        return html_lib.escape(" ".join(words[: max(1, n)]))

    def name(words: list[str]) -> str:
        n = pick(words)
        return f' {pick(["class", "class", "id"])}="{pick([n, n, f"{pick(words)}-{n}", f"site-{n}", f"{n}-{pick(["box", "area", "wrap", "list", "item", "block", "section"])}"])}"'

    def part(kind: str) -> tuple[str, int]:
        """One part that is no main text, and its number of blocks."""
        names, n = OTHER_NAMES[kind], int(rng.integers(1, 6))
        attr = name(names)
        if kind in ("menu", "share"):
            tag = pick(["nav", "div", "ul"]) if kind == "menu" else "div"
            attr = pick(["", attr]) if tag == "nav" else attr
            items = "".join(f'<li><a href="/x">{some(2)}</a></li>' for _ in range(n))
            return f"<{tag}{attr}>{items if tag == 'ul' else f'<ul>{items}</ul>'}</{tag}>", n
        if kind == "comments":
            tag = pick(["div", "section", "ol", "aside"])
            inner = "".join(f"<{t}{name(names)}><p>{cut(pick(prose), 60) if rng.random() < 0.8 else some(20)}</p></{t}>" for t in [pick(["div", "li", "article"]) for _ in range(n)])
            return f"<{tag}{attr}><h3>{some(2)}</h3>{inner}</{tag}>", n + 1
        if kind == "form":
            inner = "".join(f"<label>{some(2)}</label><input>" for _ in range(n))
            return f"<form{pick(['', attr])}><p>{some(6)}</p>{inner}<button>{some(1)}</button></form>", 2
        if kind in ("header", "footer"):
            tag = pick([kind, kind, "div"])
            lead = "&copy; " if kind == "footer" and rng.random() < 0.7 else ""
            return f"<{tag}{attr if tag == 'div' else pick(['', attr])}>{lead}{some(8)}</{tag}>", 1
        tag = pick({"side": ["aside", "aside", "div", "section"], "notice": ["div", "div", "section", "p", "aside"], "advert": ["div", "div", "aside", "ins", "section"]}[kind])
        attr = pick(["", attr]) if tag == "aside" else attr
        if tag in ("p", "ins") or rng.random() < 0.5:
            return f"<{tag}{attr}>{long(30)}</{tag}>", 1
        return f"<{tag}{attr}>" + "".join(f"<p>{long(60)}</p>" for _ in range(n)) + f"</{tag}>", n

    out = []
    for _ in range(count):
        body, labels = [], []

        def add(markup: str, n: int, label: int, body=body, labels=labels) -> None:
            body.append(markup)
            labels.extend([label] * n)

        def others(chance: float, kinds: list[str], add=add) -> None:
            while rng.random() < chance:
                add(*part(pick(kinds)), 0)

        others(0.7, ["menu", "header", "notice", "advert", "form"])
        tag = pick(["article", "main", "div", "div", "section", "td"])
        attr = "" if tag in ("article", "main", "td") and rng.random() < 0.6 else name(MAIN_NAMES)
        body.append(f"{'<table><tr>' if tag == 'td' else ''}<{tag}{attr}>")
        for i, text in enumerate(main):
            text = cut(text, 60)
            kind = "h1" if i == 0 and rng.random() < 0.7 else pick(["p"] * 12 + ["li", "blockquote", "h2", "pre", "div", "figcaption"])
            add({"li": f"<ul><li>{text}</li></ul>", "p": f"<p>{text}</p>"}.get(kind, f"<{kind}>{text}</{kind}>"), 1, 1)
            others(0.08, ["side", "notice", "advert", "share", "form"])
        others(0.3, ["share", "comments", "side", "advert"])
        body.append(f"</{tag}>{'</tr></table>' if tag == 'td' else ''}")
        others(0.7, ["comments", "side", "menu", "advert", "notice", "form", "footer", "comments"])
        if rng.random() < 0.8:
            add(*part("footer"), 0)
        out.append((f"<html><body>{''.join(body)}</body></html>", labels))
    return out


def labelled(page: str) -> tuple[list[Block], list[int]]:
    """A page's blocks, labelled by its own structure: within article or main, and in no other part."""
    found = blocks(page)
    inside, outside = {f"t:{t}" for t in MAIN_TAGS}, {f"t:{t}" for t in OTHER_TAGS}
    return found, [int(bool(b.tags & inside) and not b.tags & outside) for b in found]


def train(pages: list[str], layouts_each: int = LAYOUTS, seed: int = 5) -> Field:
    """The field, trained on pages labelled by their structure and on the same texts in other layouts.

    Pages without an article or main element teach nothing; without any
    teaching page the layouts are made of a fixed placeholder text.
    """
    rng = np.random.default_rng(seed)
    taught = [(b, y) for b, y in map(labelled, pages) if any(y)]
    texts = [([b.text for b, l in zip(p, y, strict=True) if l], [b.text for b, l in zip(p, y, strict=True) if not l]) for p, y in taught]
    every = [t for _, o in texts for t in o] or ["Home", "Contact us today."]
    texts = texts or [(["A heading", "A sentence of some words, then more of them."], [])]
    prose = [t for m, _ in texts for t in m]
    for main, _ in texts:
        for page, y in layouts(main[:10], every, prose, rng, layouts_each):
            found = blocks(page)
            if len(found) == len(y):
                taught.append((found, y))
    names = sorted({f for p, _ in taught for k, b in enumerate(p) for f in features(b, k, len(p))})
    field = Field(names)
    field.train([field.rows(p) for p, _ in taught], [y for _, y in taught])
    return field


def main_text(page: str, field: Field) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, field.decode(field.rows(found)), strict=True) if y)


def fitted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES) -> Field:
    """A field trained on the ``train_pages`` pages with the smallest hashed ids that have an article or main element."""
    d = pages.select(pages[id_col].alias("key"), pages[html_col].cast("string").alias("html")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    order = [F.xxhash64("key"), F.col("key")]
    ids = [r["key"] for r in d.where("key is not null").select("key").distinct().orderBy(*order).limit(train_pages).collect()]
    rows = d.where(F.col("key").isin(ids)).groupBy("key").agg(F.min("html").alias("html")).orderBy(*order).collect()  # one page an id
    return train([r["html"] for r in rows])


def extracted(pages: DataFrame, field: Field, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(id, keep..., text, n_chars) of every page, repeats included.

    Null or empty html, and pages without main text, have an empty text.
    Repeated pages come back each; a very long page is read whole; an empty
    table gives no rows; only the named columns are read, so others cannot
    clash.
    """
    W.small_batches(pages.sparkSession)
    known = pages.sparkSession.sparkContext.broadcast(field)  # a few thousand weights

    def run(batches):
        for rows in W.slices(batches):
            texts = [main_text(h, known.value) if h else "" for h in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *rows.columns[2:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[f.name for i, f in enumerate(rows.schema) if i != 1] + ["out_text", "out_chars"])

    d = pages.select(pages[id_col].alias("key"), pages[html_col].cast("string").alias("html"), *(pages[c].alias(f"keep{i}") for i, c in enumerate(keep)))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields if f.name != "html"]
    out = d.mapInArrow(run, ", ".join([*fields, "out_text string", "out_chars long"]))
    return out.select(F.col("key").alias(id_col), *(F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)), F.col("out_text").alias("text"), F.col("out_chars").alias("n_chars"))
