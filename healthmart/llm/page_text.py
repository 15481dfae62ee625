"""Main-text extraction from web pages by a recurrent block labeller.

A page is cut into blocks: runs of text between block-level tags, in page order.  Each block has the
hashed tokens of its tag path (tag names, words of class and id values), a hashed bag of its words
and a few measures.  A bidirectional LSTM in numpy reads the blocks of the whole page and labels each as main text or
not, so a block is judged with what stands before and behind it.  Main blocks are joined by two
newlines.

The model is trained here, on the driver, from pages that ``training_page`` makes up: known main
blocks among menus, headers, notices, adverts, forms, sidebars, comments and footers in many
markups.  It learns from a fixed number of pages (``TRAIN_PAGES``) and is a few hundred kilobytes.

Defined results: a null or empty page gives an empty text with 0 characters, as does a page without
main blocks; broken markup is read as far as it goes (an unclosed comment, script, style or other raw text drops
the rest, other unclosed hidden elements end with their parent, an unclosed tag is text); pages are independent, so ties, repeated rows and null ids pass through; an empty
table gives an empty table; only the id, URL and HTML columns are read, so others cannot clash.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

PATH_DIMS, WORD_DIMS, HIDDEN = 512, 32, 12
TRAIN_PAGES, EPOCHS, SEED, RATE = 700, 16, 7, 0.02
#: Pages that are labelled together, at most; blocks that are held for it; and cells of the array of pages by the
#: longest of them, unless one page has more blocks.
PAGES_AT_ONCE, BLOCKS_AT_ONCE, CELLS_AT_ONCE = 256, 60_000, 30_000

# Tags of the HTML standard that end a line of text, hold no text, or hold text that is not shown.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
optgroup option p pre section select summary table tbody td textarea tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("canvas iframe math noembed noframes noscript object script style svg template title".split())
# Of the hidden ones, those that hold elements and not raw text; those of them that may be self-closed; what
# ends them when it starts inside, and the elements inside them in which it does not.
NESTED_TAGS = frozenset("canvas math object svg template".split())
FOREIGN_TAGS = frozenset("math svg".split())
LEAVES_FOREIGN = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing
menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
HTML_INSIDE = frozenset("annotation-xml canvas desc foreignobject mi mn mo ms mtext object template title".split())
CLOSES_P = BLOCK_TAGS - {"body", "html", "head", "button", "option", "optgroup", "caption", "tr", "td", "th", "tbody", "thead", "tfoot"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>", re.S)
_OPEN = re.compile(r"<!--.*|<[!?].*", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNQUOTED = re.compile(r"""=\s*[^\s"']*/\Z""")          # a slash that ends a value, not the tag
_PART = re.compile(r"[a-z]+|[0-9]+")
_ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in HIDDEN_TAGS}


def blocks(page: str) -> list[tuple[int, str, float]]:
    """Blocks of a page: the hashed tokens of the tag path (a bit for each), the text, and the part of it inside links."""
    out: list[tuple[int, str, float]] = []
    stack: list[tuple[str, int]] = []          # open elements, with the bits of the path down to them
    parts: list[str] = []
    path: int | None = None
    linked, links = 0, 0
    hidden = -1                                # place of the outermost open hidden element in the stack
    opened: Counter = Counter()                # how often each name is open

    def text(raw: str) -> None:
        nonlocal path, linked
        if hidden >= 0:
            return
        if "&" in raw:
            raw = html.unescape(raw)
        parts.append(raw)
        if not raw.isspace():
            if path is None:
                path = stack[-1][1] if stack else 0
            if links:
                linked += len(raw)

    def end() -> None:
        nonlocal path, linked
        if path is not None:
            said = " ".join("".join(parts).split())
            if said:
                out.append((path, said, min(1.0, linked / len(said))))
        parts.clear()
        path, linked = None, 0

    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        # Behind the last ">" nothing but a comment or declaration that is left open can start.
        m = _TAG.search(page, at) if at <= last else _OPEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        name = m.group(2) if m.re is _TAG else None
        if name is None:
            continue
        name = name.lower()
        if not m.group(1):
            if hidden >= 0 and name in LEAVES_FOREIGN and stack[hidden][0] in FOREIGN_TAGS and not any(t in HTML_INSIDE for t, _ in stack[hidden:]):
                links -= _cut(stack, opened, hidden)
                hidden = -1
            foreign = name in FOREIGN_TAGS or hidden >= 0 and any(t in FOREIGN_TAGS for t, _ in stack[hidden:])
            if foreign and m.group(3).endswith("/") and not _UNQUOTED.search(m.group(3)):
                continue
            if name in HIDDEN_TAGS and name not in NESTED_TAGS and not (foreign and name == "title"):
                close = _ENDS[name].search(page, at)
                at = close.end() if close else n
                continue
            if name in NESTED_TAGS and hidden < 0:
                hidden = len(stack)
            if hidden >= 0:
                if name not in VOID_TAGS:
                    stack.append((name, 0))
                    opened[name] += 1
                    links += name == "a"
                continue
            if name == "br":
                parts.append(" ")
                continue
            if name in BLOCK_TAGS:
                end()
                if name in CLOSES_P:
                    links -= _pop(stack, opened, "p", ("button", "td", "th"))
                if name in ("li", "dd", "dt", "option", "td", "th", "tr"):
                    links -= _pop(stack, opened, name, ("ul", "ol", "dl", "table"))
            if name not in VOID_TAGS:
                stack.append((name, _path_bits(name, m.group(3)) | (stack[-1][1] if stack else 0)))
                opened[name] += 1
                links += name == "a"
        else:
            links -= _pop(stack, opened, name, ())
            if len(stack) <= hidden:           # it has ended, by its own end tag or with its parent
                hidden = -1
            if hidden < 0 and name in BLOCK_TAGS:
                end()
    end()
    return out


def _cut(stack: list, opened: Counter, at: int) -> int:
    """Close all elements from this place on; links closed by it."""
    gone = Counter(t for t, _ in stack[at:])
    opened.subtract(gone)
    del stack[at:]
    return gone["a"]


def _pop(stack: list, opened: Counter, name: str, stops: tuple[str, ...]) -> int:
    """Close the innermost open ``name``, if it is open before any of ``stops``; links closed by it."""
    if not opened[name]:
        return 0
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            return _cut(stack, opened, i)
        if stack[i][0] in stops:
            break
    return 0


@lru_cache(maxsize=20_000)
def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    out = [name]
    for found in _NAMED.finditer(attributes):
        out += ["." + w for w in _PART.findall((found[1] or found[2] or found[3] or "").lower())]
    return tuple(out)


@lru_cache(maxsize=20_000)
def _path_bits(name: str, attributes: str) -> int:
    bits = 0
    for t in _tokens(name, attributes):
        bits |= 1 << zlib.crc32(t.encode()) % PATH_DIMS
    return bits


@lru_cache(maxsize=20_000)
def _path_ids(path: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(path.to_bytes(PATH_DIMS // 8, "little"), np.uint8), bitorder="little"))


class _Hash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = zlib.crc32(word.encode()) % WORD_DIMS
        return h


_word = _Hash()


def measures(said: str, linked: float) -> np.ndarray:
    """Hashed bag of words (all of them, relative), length, words, part in links, sentence ends."""
    words = said.split(" ")
    bag = np.bincount(np.fromiter(map(_word.__getitem__, words), np.int64, len(words)), minlength=WORD_DIMS) / len(words)
    ends = said.count(". ") + said.endswith(".")
    return np.concatenate([bag, [np.log1p(len(said)) / 8, np.log1p(len(words)) / 6, linked, min(ends, 5) / 5]])


EXTRA = WORD_DIMS + 4


class Labeller:
    """Bidirectional LSTM over the blocks of a page, with a logistic label for each block."""

    def __init__(self, rng: np.random.Generator):
        h = HIDDEN
        self.w = {"path": rng.normal(0, .1, (PATH_DIMS, 8 * h)), "extra": rng.normal(0, .1, (EXTRA, 8 * h)), "bias": np.zeros(8 * h),
                  "rec0": rng.normal(0, .2, (h, 4 * h)), "rec1": rng.normal(0, .2, (h, 4 * h)),
                  "out": rng.normal(0, .2, 2 * h), "cut": np.zeros(1)}
        for d in (0, 1):
            self.w["bias"][4 * h * d + h:4 * h * d + 2 * h] = 1.0          # forget gates start open

    def inputs(self, pages: list[list[tuple]]) -> tuple[np.ndarray, np.ndarray, list]:
        """Gate inputs of all blocks, padded to (pages, longest, 8 h), and the mask of real blocks."""
        longest = max(map(len, pages))
        x = np.zeros((len(pages), longest, 8 * HIDDEN))
        real = np.zeros((len(pages), longest), bool)
        kept = []
        for i, page in enumerate(pages):
            if page:
                ids = [_path_ids(p) for p, _, _ in page]
                extra = np.array([measures(t, a) for _, t, a in page])
                x[i, :len(page)] = np.array([self.w["path"][k].sum(0) for k in ids]) + extra @ self.w["extra"] + self.w["bias"]
                real[i, :len(page)] = True
                kept.append((ids, extra))
            else:
                kept.append(([], np.zeros((0, EXTRA))))
        return x, real, kept

    def _pass(self, x: np.ndarray, real: np.ndarray, d: int, keep: bool = True) -> tuple[np.ndarray, list]:
        h, n = HIDDEN, x.shape[0]
        x, rec = x[:, :, 4 * h * d:4 * h * (d + 1)], self.w[f"rec{d}"]
        hid, cell, out, tape = np.zeros((n, h)), np.zeros((n, h)), np.zeros((n, x.shape[1], h)), []
        for t in range(x.shape[1])[::-1 if d else 1]:
            z = x[:, t] + hid @ rec
            s = 1 / (1 + np.exp(-z[:, :3 * h]))
            i, f, o, g = s[:, :h], s[:, h:2 * h], s[:, 2 * h:], np.tanh(z[:, 3 * h:])
            on = real[:, t, None]
            new = f * cell + i * g
            tc = np.tanh(new)
            if keep:
                tape.append((t, i, f, o, g, cell, tc, hid, on))
            cell, hid = np.where(on, new, cell), np.where(on, o * tc, hid)
            out[:, t] = hid
        return out, tape

    def score(self, pages: list[list[tuple]]) -> list[np.ndarray]:
        """For each page the log-odds of its blocks to be main text."""
        x, real, _ = self.inputs(pages)
        both = np.concatenate([self._pass(x, real, d, keep=False)[0] for d in (0, 1)], axis=2)
        z = both @ self.w["out"] + self.w["cut"]
        return [z[i, :len(p)] for i, p in enumerate(pages)]

    def gradients(self, pages: list[list[tuple]], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss over all blocks, by back-propagation through the page."""
        h = HIDDEN
        x, real, kept = self.inputs(pages)
        outs, tapes = zip(*(self._pass(x, real, d) for d in (0, 1)), strict=True)
        both = np.concatenate(outs, axis=2)
        y = np.zeros(real.shape)
        for i, label in enumerate(labels):
            y[i, :len(label)] = label
        p = 1 / (1 + np.exp(-(both @ self.w["out"] + self.w["cut"])))
        dz = np.where(real, p - y, 0) / real.sum()
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["out"], grad["cut"] = np.einsum("nt,nth->h", dz, both), np.array([dz.sum()])
        dx = np.zeros_like(x)
        for d in (0, 1):
            dh_out = dz[:, :, None] * self.w["out"][h * d:h * (d + 1)]
            dh, dc, rec = np.zeros((len(pages), h)), np.zeros((len(pages), h)), self.w[f"rec{d}"]
            for t, i, f, o, g, cell, tc, hid, on in reversed(tapes[d]):
                dh = dh + dh_out[:, t]
                new_c = np.where(on, dc + dh * o * (1 - tc * tc), 0)
                da = np.concatenate([new_c * g * i * (1 - i), new_c * cell * f * (1 - f), np.where(on, dh * tc, 0) * o * (1 - o), new_c * i * (1 - g * g)], axis=1)
                dx[:, t, 4 * h * d:4 * h * (d + 1)] = da
                grad[f"rec{d}"] += hid.T @ da
                dh = np.where(on, da @ rec.T, dh)
                dc = np.where(on, new_c * f, dc)
        grad["bias"] = dx[real].sum(0)
        for i, (ids, extra) in enumerate(kept):
            if len(ids):
                own = dx[i, :len(ids)]
                grad["extra"] += extra.T @ own
                np.add.at(grad["path"], np.concatenate(ids), np.repeat(own, [len(k) for k in ids], axis=0))
        return grad


# Names that pages commonly give to the parts of a page.
MAIN_NAMES = "content post entry article story body text main page-content post-content entry-content article-body story-body main-content post-body prose".split()
PART_NAMES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topnav main-menu toc-menu links pagination pager".split(),
    "header": "header masthead top-bar site-header topbar banner-top logo branding".split(),
    "footer": "footer site-footer copyright legal bottom colophon imprint".split(),
    "side": "sidebar side widget related recommended trending popular aside rail read-more most-read tags share social".split(),
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion adsense banner-ad ad-slot".split(),
    "notice": "cookie cookie-notice cookie-banner consent gdpr notice alert popup modal newsletter subscribe paywall message warning".split(),
    "comments": "comments comment comment-list disqus replies discussion respond reader-comments user-comments".split(),
}
MARK = "mainblock"


def training_page(rng: random.Random) -> str:
    """A made-up page; main blocks start with the word MARK."""
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(1, 9))) for _ in range(60)]

    def words(low: int, high: int) -> str:
        out = [rng.choice(vocabulary) for _ in range(rng.randint(low, high))]
        if rng.random() < .7:
            out = [w + "." if rng.random() < .12 else w for w in out]
            out[-1] += "."
        return " ".join(out)

    def name(kind: str) -> str:
        return f'{rng.choice(["class", "class", "id"])}="{rng.choice(PART_NAMES[kind])}"'

    def items(low: int, high: int, link: bool = True) -> str:
        one = (lambda: f'<a href="/{rng.choice(vocabulary)}">{words(1, 4)}</a>') if link else (lambda: words(1, 30))
        return "<ul>" + "".join(f"<li>{one()}</li>" for _ in range(rng.randint(low, high))) + "</ul>"

    def shell(kind: str, tags: list[str], inner: str) -> str:
        tag = rng.choice(tags)
        bare = tag not in ("div", "section", "ul", "ol") and rng.random() < .6
        return f"<{tag}{'' if bare else ' ' + name(kind)}>{inner}</{tag}>"

    def prose(low: int = 3, high: int = 40) -> str:
        return rng.choice([words(low, high), f"<p>{words(low, high)}</p>", f"<p>{words(low, high)}</p><p>{words(low, high)}</p>", f"<span>{words(low, high)}</span>"])

    def part(kind: str) -> str:
        if kind == "menu":
            return shell(kind, ["nav", "nav", "div", "menu"], items(2, 9))
        if kind == "header":
            return shell(kind, ["header", "header", "div"], rng.choice([words(1, 6), f"<h1>{words(1, 4)}</h1>", f"<a href='/'>{words(1, 3)}</a><p>{words(3, 9)}</p>"]))
        if kind == "footer":
            return shell(kind, ["footer", "footer", "div"], rng.choice(["&copy; ", ""]) + rng.choice([prose(), words(2, 30), items(2, 5)]))
        if kind == "side":
            return shell(kind, ["aside", "aside", "div", "section"], rng.choice([prose(), f"<h3>{words(1, 4)}</h3>" + items(2, 6), items(1, 5, False)]))
        if kind == "form":
            fields = "".join(rng.choice([f"<label>{words(1, 4)}</label><input name=q>", f"<select><option>{words(1, 2)}</option><option>{words(1, 2)}</option></select>",
                                         f"<textarea>{words(1, 9) if rng.random() < .5 else ''}</textarea>", f"<p>{words(3, 20)}</p>"]) for _ in range(rng.randint(1, 3)))
            return f"<form{rng.choice(['', ' class=search', ' id=login'])}>{fields}<button>{words(1, 2)}</button></form>"
        if kind == "comments":
            one = lambda: rng.choice([f"<p>{words(3, 60)}</p>", f'<div class="comment"><b>{words(1, 2)}</b><p>{words(3, 60)}</p></div>', f"<li>{words(3, 60)}</li>"])
            return shell(kind, ["section", "div", "ol", "ul"], rng.choice(["", f"<h2>{words(1, 3)}</h2>"]) + "".join(one() for _ in range(rng.randint(1, 5))))
        if rng.random() < .2:
            return shell(kind, ["p", "div"], words(3, 30))
        return shell(kind, ["div", "section"] if kind == "ad" else ["div", "section", "dialog"], prose(3, 30))

    def main_block() -> str:
        said = lambda: f"{MARK} {words(1, 90) if rng.random() < .8 else words(1, 4)}"
        return rng.choice([
            lambda: f"<p>{said()}</p>", lambda: f"<p>{said()}</p>", lambda: f"<p>{said()}</p>", lambda: f"<p><b>{said()}<br><p>{said()}</p>",
            lambda: f"<p>{said()} <a href='/x'>{words(1, 4)}</a> <em>{words(1, 3)}</em></p>", lambda: f"<h2>{said()}</h2><p>{said()}</p>",
            lambda: f"<blockquote>{said()}</blockquote>", lambda: "<ul>" + "".join(f"<li>{said()}</li>" for _ in range(rng.randint(1, 5))) + "</ul>",
            lambda: f"<pre>{said()}</pre>", lambda: f"<table><tr><td>{said()}</td><td>{said()}</td></tr></table>",
            lambda: f"<figure><img src=x><figcaption>{said()}</figcaption></figure>", lambda: f"<div>{said()}</div>"])()

    inner = f"<h1>{MARK} {words(1, 12)}</h1>" if rng.random() < .8 else ""
    for _ in range(rng.randint(1, 9)):
        inner += main_block()
        if rng.random() < .12:
            inner += part(rng.choice(["ad", "side", "form", "notice"]))
    if rng.random() < .25:
        # Long runs of short paragraphs, some of them alike.
        short = [words(1, 5) for _ in range(rng.choice([1, 3, 20]))]
        inner += "".join(f"<p>{MARK} {rng.choice(short)}</p>" for _ in range(rng.randint(4, 40)))
    if rng.random() < .15:
        inner += part("comments")
    named = f'{rng.choice(["class", "id"])}="{rng.choice(MAIN_NAMES)}"'
    body = rng.choice([lambda: f"<article>{inner}</article>", lambda: f"<article>{inner}</article>", lambda: f"<main>{inner}</main>", lambda: f"<div {named}>{inner}</div>",
                       lambda: f"<main><article>{inner}</article></main>", lambda: f"<main><div {named}>{inner}</div></main>", lambda: f"<article {named}>{inner}</article>",
                       lambda: f"<div class='wrapper'><div {named}>{inner}</div></div>", lambda: inner])()
    pick = lambda kinds, most: "".join(part(k) for k in rng.sample(kinds, rng.randint(0, most)))
    before = pick(["menu", "header", "notice", "ad", "form"], 4)
    after = pick(["comments", "side", "ad", "form", "notice"], 3) + pick(["footer", "menu"], 2)
    return f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title></head><body>{before}{body}{after}</body></html>"


def examples(pages: int, seed: int) -> tuple[list[list[tuple]], list[np.ndarray]]:
    rng = random.Random(seed)
    xs, ys = [], []
    while len(xs) < pages:
        found = blocks(training_page(rng))
        if found:
            ys.append(np.array([float(t.startswith(MARK)) for _, t, _ in found]))
            xs.append([(p, t.removeprefix(MARK + " "), a) for p, t, a in found])
    return xs, ys


@lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """The labeller, trained by Adam on made-up pages; the same for the same parameters."""
    rng = np.random.default_rng(seed)
    model = Labeller(rng)
    xs, ys = examples(pages, seed)
    mean, square = ({k: np.zeros_like(v) for k, v in model.w.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(xs))
        for i in range(0, len(xs), 25):
            part = order[i:i + 25]
            grad = model.gradients([xs[k] for k in part], [ys[k] for k in part])
            step += 1
            for k, g in grad.items():
                mean[k] = .9 * mean[k] + .1 * g
                square[k] = .99 * square[k] + .01 * g * g
                model.w[k] -= RATE * (1 - epoch / epochs) * (mean[k] / (1 - .9 ** step)) / (np.sqrt(square[k] / (1 - .99 ** step)) + 1e-8)
    return model


def extract(df: DataFrame, *, model: Labeller | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of each page."""
    bound_batches(df.sparkSession)
    model = model or trained()
    rows = df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = [""] * batch.num_rows
            held: list[tuple[int, list]] = []

            def label() -> None:
                # Pages of like length share an array.
                held.sort(key=lambda x: len(x[1]))
                i = 0
                while i < len(held):
                    # Sorted by length: the last page of a part is its longest.
                    end = i + 1
                    while end < len(held) and end - i < PAGES_AT_ONCE and (end + 1 - i) * len(held[end][1]) <= CELLS_AT_ONCE:
                        end += 1
                    part, i = held[i:end], end
                    for (row, found), score in zip(part, model.score([b for _, b in part]), strict=True):
                        texts[row] = "\n\n".join(t for (_, t, _), s in zip(found, score, strict=True) if s > 0)
                held.clear()

            size = 0
            for row, page in enumerate(batch.column(2)):
                found = blocks(page.as_py())
                if found:
                    size += len(found)
                    held.append((row, found))
                if size >= BLOCKS_AT_ONCE:
                    label()
                    size = 0
            label()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             [id_col, url_col, "text", "n_chars"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars bigint")
