"""HTML extraction: a recurrent labeller of blocks.

A page becomes the sequence of its leaf blocks in page order: the text between two block tags, with character references
decoded and white space folded, and the path of open tags with their class and id words. Each block is a vector: hashed
path words, hashed words of its whole text, and a few figures (length, share of text in links, end of sentence). A
bidirectional LSTM reads the sequence both ways and labels every block with the whole page as context; the blocks called
main text are joined by line breaks.

The labeller is trained on a bounded sample: TRAIN_PAGES pages of the corpus in the order of a hash of their id, labelled
by the meaning of HTML's own sectioning tags, and TRAIN_PAGES made-up layouts around their paragraphs, so that layouts
without such tags are known too. Every page and every block is then labelled.

Defined cases: null or empty html gives the empty text; tags left open are closed by what follows; a page without any
main block gives the empty text; repeated rows are judged one by one; with no labelled page in the corpus the layouts
around filler words serve alone; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.arrow import by_batch
from tillbook.llm.lstm import BiLstm

TRAIN_PAGES, HIDDEN, EPOCHS = 300, 24, 8
PATH_SIZE, WORD_SIZE, FIGURES = 64, 24, 6
INPUTS = PATH_SIZE + WORD_SIZE + FIGURES
#: Characters of html whose blocks are in memory at a time, and bytes of text whose words are hashed at a time.
PAGE_CHARS, SLICE = 4_000_000, 500_000
POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64)

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
RAW = frozenset("script style noscript template iframe svg".split())
CLOSED_BY_P = frozenset("p h1 h2 h3 h4 h5 h6".split())
OPENS_BLOCK = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
PART = re.compile(r"[a-z]+")
ENDS = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
#: What the sectioning tags say: text inside one of the first and none of the second is main text.
MAIN_TAGS, OTHER_TAGS = frozenset(("article", "main")), frozenset(("nav", "header", "footer", "aside", "form", "button", "select", "textarea", "title", "head", "dialog", "menu"))


class Block:
    """A leaf: its text, the path words of its open tags, and the number of characters in links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def _words_of_tag(name: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (name,)
    named = " ".join(a or b or c for a, b, c in NAMED.findall(attributes))
    return (name, *(f"{name}.{w}" for w in PART.findall(named.lower())), *(f".{w}" for w in PART.findall(named.lower())))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    path: tuple[str, ...] = ()
    linked = links = 0

    def flush() -> None:
        nonlocal linked, path
        if pieces:
            text = "".join(pieces)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(text, path, linked))
            pieces.clear()
        linked, path = 0, ()

    def close(names: frozenset[str] | set[str]) -> None:
        nonlocal links
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                links -= sum(s[0] == "a" for s in stack[k:])
                del stack[k:]
                return
            if names is CLOSED_BY_P and stack[k][0] not in INLINE:
                return

    def text_to(end: int) -> None:
        nonlocal linked, path
        if end > at:
            text = page[at:end]
            pieces.append(text)
            if not path and not text.isspace():
                path = tuple(w for _, words in stack for w in words)
            if links:
                linked += len(text.strip())

    at = 0
    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            text_to(len(page))
            break
        if page.startswith("<!--", lt):
            text_to(lt)
            end = page.find("-->", lt + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page[lt + 1 : lt + 2] in ("!", "?"):
            text_to(lt)
            end = page.find(">", lt)
            at = len(page) if end < 0 else end + 1
            continue
        m = TAG.match(page, lt)
        if not m:
            if re.match(r"</?[a-zA-Z]", page[lt : lt + 3]):  # a tag that never ends
                text_to(lt)
                break
            text_to(lt + 1)
            at = lt + 1
            continue
        text_to(lt)
        at = m.end()
        slash, name, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        name = name.lower()
        if slash:
            if name not in INLINE:
                flush()
            close({name})
        elif name in VOID:
            if name in ("br", "hr"):
                flush()
        elif name in RAW:
            end = ENDS[name].search(page, at)
            at = end.end() if end else len(page)
        else:
            if name not in INLINE:
                flush()
            if name in OPENS_BLOCK:
                close(CLOSED_BY_P)
            elif name in ("li", "dt", "dd", "tr", "td", "th", "option") and any(s[0] == name for s in stack[-2:]):
                close({name})
            if not attributes.endswith("/"):
                stack.append((name, _words_of_tag(name, attributes)))
                links += name == "a"
    flush()
    return out


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """Slot and sign of each hash, as one number below 2 * size."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    return (mixed % np.uint64(2 * size)).astype(np.int64)


def _signed(counts: np.ndarray) -> np.ndarray:
    return counts[:, 0::2] - counts[:, 1::2]


def word_vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed-word vectors of unit length, and the number of words, of texts with single blanks; SLICE bytes at a time."""
    counts, words = np.zeros((len(texts), 2 * WORD_SIZE)), np.zeros(len(texts), np.int64)
    part: list[tuple[int, bytes]] = []
    held = 0

    def add() -> None:
        data = np.frombuffer(b" ".join(t for _, t in part), np.uint8).astype(np.uint64)
        blank = np.flatnonzero(data == 32)
        starts = np.concatenate(([0], blank + 1))
        lengths = np.diff(np.concatenate((starts, [len(data) + 1])))
        place = np.arange(len(data) + 1) - np.repeat(starts, lengths)
        hashes = np.add.reduceat(np.append(data, np.uint64(0)) * POWERS[np.minimum(place, len(POWERS) - 1)], starts)
        owner = np.repeat([i for i, _ in part], [t.count(b" ") + 1 for _, t in part])
        first = part[0][0]
        span = slice(first, part[-1][0] + 1)
        words[span] += np.bincount(owner - first)
        counts[span] += np.bincount((owner - first) * (2 * WORD_SIZE) + _slots(hashes, WORD_SIZE), minlength=(part[-1][0] + 1 - first) * 2 * WORD_SIZE).reshape(-1, 2 * WORD_SIZE)

    for i, text in enumerate(texts):
        for at in range(0, len(text), SLICE):
            part.append((i, text[at : at + SLICE]))
            held += len(part[-1][1])
            if held >= SLICE:
                add()
                part, held = [], 0
    if part:
        add()
    signed = _signed(counts)
    return signed / np.maximum(1, np.linalg.norm(signed, axis=1, keepdims=True)), words


class Vectors:
    """Feature vectors of blocks."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 50_000:
                self.paths.clear()
            hashes = np.array([zlib.crc32(w.encode()) for w in path], np.uint64)
            self.paths[path] = np.clip(_signed(np.bincount(_slots(hashes, PATH_SIZE), minlength=2 * PATH_SIZE)[None].astype(np.float32))[0], -3, 3)
        return self.paths[path]

    def pages(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """One matrix for each page, a row for each block."""
        found = [b for page in pages for b in page]
        if not found:
            return [np.zeros((0, INPUTS), np.float32) for _ in pages]
        out = np.zeros((len(found), INPUTS), np.float32)
        vectors, words = word_vectors([b.text.encode("utf-8", "replace") for b in found])
        out[:, :PATH_SIZE] = [self.path(b.path) for b in found]
        out[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = vectors
        size = np.array([len(b.text) for b in found])
        few = np.repeat([len(page) < 8 for page in pages], [len(page) for page in pages])
        figures = (np.log1p(size) / 6, np.log1p(words) / 4, np.minimum(1, np.array([b.linked for b in found]) / size), [b.text[-1] in ".!?" for b in found], few, np.ones(len(found)))
        out[:, -FIGURES:] = np.column_stack(figures)
        return np.split(out, np.cumsum([len(page) for page in pages])[:-1])


def semantic_labels(found: list[Block]) -> np.ndarray | None:
    """Labels from the sectioning tags, None where a page has none of the main ones or marks parts by class only."""
    if not any(MAIN_TAGS.intersection(b.path) for b in found):
        return None
    return np.array([bool(MAIN_TAGS.intersection(b.path)) and not OTHER_TAGS.intersection(b.path) and not any(_other_class(w) for w in b.path) for b in found], np.float32)


#: Class and id words of the made-up layouts, by what they mark.
MAIN_WORDS = "content article post entry story body text main page prose markdown".split()
OTHER_WORDS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topbar links tabs pagination pager".split(),
    "header": "header masthead banner branding logo top hero".split(),
    "footer": "footer foot bottom copyright legal colophon imprint".split(),
    "aside": "sidebar aside widget related recommended trending popular tags rail newsletter share social".split(),
    "notice": "notice cookie consent alert popup modal gdpr overlay message subscribe paywall".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense".split(),
    "comments": "comments comment replies reply discussion disqus respond".split(),
    "form": "form search login signup".split(),
}
_OTHERS = frozenset(f".{w}" for words in OTHER_WORDS.values() for w in words)


def _other_class(word: str) -> bool:
    return word in _OTHERS


def made_up(paragraphs: list[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A random layout around paragraphs, as html, with the label of each of its blocks."""

    def pick(x):
        return x[int(rng.integers(len(x)))]

    def some(lo: int, hi: int) -> list[str]:
        return [html.escape(pick(paragraphs)) for _ in range(int(rng.integers(lo, hi)))]

    def short() -> str:
        return html.escape(" ".join(pick(paragraphs).split()[: int(rng.integers(1, 9))]))

    def other(kind: str) -> str:
        word = pick(OTHER_WORDS[kind])
        mark = f'class="{pick(("", "site-", "page-", "block ", "c-"))}{word}{pick(("", "-box", " box", "-list", "1"))}"' if rng.random() < 0.7 else f'id="{word}"'
        tag = kind if kind in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.6 else pick(("div", "div", "section", "ul" if kind == "nav" else "div"))
        if tag == kind and rng.random() < 0.7:
            mark = ""
        inner = {
            "nav": lambda: "<ul>" + "".join(f'<li><a href="#">{short()}</a></li>' for _ in range(int(rng.integers(2, 9)))) + "</ul>",
            "header": lambda: pick((f"<div>{short()}</div>", f'<a href="/">{short()}</a>', f"<h2>{short()}</h2><p>{short()}</p>")),
            "footer": lambda: pick((f"&copy; {short()}", f"<p>{short()}</p>", f'<a href="#">{short()}</a> {short()}', f"<p>{pick(some(1, 2))}</p>")),
            "aside": lambda: f"<h3>{short()}</h3><ul>" + "".join(f'<li><a href="#">{short()}</a></li>' for _ in range(int(rng.integers(1, 5)))) + "</ul>" if rng.random() < 0.6 else "".join(f"<p>{p}</p>" for p in some(1, 3)),
            "form": lambda: f'<label>{short()}</label><input name="q"><button>{short()}</button>',
        }.get(kind, lambda: pick((pick(some(1, 2)), f"<p>{pick(some(1, 2))}</p>", f"<p>{short()}</p><button>{short()}</button>", f"<div><p>{pick(some(1, 2))}</p><p>{pick(some(1, 2))}</p></div>")))()
        return f"<{tag} {mark}>\x01{inner}\x02</{tag}>"

    def body() -> str:
        parts = [f"<h1>{short()}</h1>"] if rng.random() < 0.8 else []
        for p in some(1, 9):
            if rng.random() < 0.1:
                parts.append(f"<h2>{short()}</h2>")
            if rng.random() < 0.08:
                parts.append("<ul>" + "".join(f"<li>{short()}</li>" for _ in range(int(rng.integers(2, 5)))) + "</ul>")
            parts.append(pick((f"<p>{p}</p>", f"<p>{p}</p>", f"<p><b>{p}<br>", f"<p>{p}", f'<p>{p} <a href="#">{short()}</a></p>', f"<blockquote>{p}</blockquote>")))
            if rng.random() < 0.12:
                parts.append(other(pick(("ad", "aside", "notice", "form", "nav"))))
        return "".join(parts)

    container = pick(("article", "article", "main", "div", "div", "section"))
    mark = f' class="{pick(("", "site-", "main-"))}{pick(MAIN_WORDS)}"' if container in ("div", "section") or rng.random() < 0.3 else ""
    if container == "div" and rng.random() < 0.15:
        mark = ""
    before = [other(k) for k in ("nav", "header", "notice", "ad", "aside", "form") if rng.random() < 0.45]
    after = [other(k) for k in ("comments", "aside", "ad", "nav", "notice", "footer") if rng.random() < 0.45]
    page = "".join((f"<html><head><title>\x01{short()}\x02</title></head><body>\x01", *before, f"\x02<{container}{mark}>{body()}</{container}>\x01", *after, "\x02</body></html>"))
    # \x01 and \x02 bracket what is not main text; they may nest, and travel with the blocks' text.
    found, labels, depth = [], [], 0
    for b in blocks(page):
        depth += b.text.count("\x01", 0, len(b.text) - len(b.text.lstrip("\x01\x02 "))) - b.text.count("\x02", 0, len(b.text) - len(b.text.lstrip("\x01\x02 ")))
        lead = b.text.lstrip("\x01\x02 ")
        text = lead.replace("\x01", "").replace("\x02", "").strip()
        if text:
            found.append(Block(text, b.path, min(b.linked, len(text))))
            labels.append(depth == 0)
        depth += lead.count("\x01") - lead.count("\x02")
    return found, np.array(labels, np.float32)


def train(pages: list[str], made: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 7) -> BiLstm:
    """A labeller from sampled pages and as many made-up layouts around their paragraphs."""
    rng, vectors = np.random.default_rng(seed), Vectors()
    sequences, labels, paragraphs = [], [], []
    for page in pages:
        found = blocks(page)
        known = semantic_labels(found)
        if known is not None:
            sequences.append(found)
            labels.append(known)
            paragraphs += [b.text for b, y in zip(found, known, strict=True) if y]
    paragraphs = paragraphs or ["Filler words stand here, as no page of the corpus has a known layout."]
    for _ in range(made):
        found, known = made_up(paragraphs, rng)
        sequences.append(found)
        labels.append(known)
    keep = [i for i, s in enumerate(sequences) if len(s)]
    model = BiLstm(INPUTS, HIDDEN, seed)
    model.fit(vectors.pages([sequences[i] for i in keep]), [labels[i] for i in keep], epochs=epochs, seed=seed)
    return model


def extract(pages: list[str], model: BiLstm, vectors: Vectors) -> list[str]:
    """The main text of each page."""
    found = [blocks(p) for p in pages]
    picked = model.label(vectors.pages(found))
    return ["\n".join(b.text for b, y in zip(f, ys, strict=True) if y) for f, ys in zip(found, picked, strict=True)]


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html", sample: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars), one row for each page."""
    spread = F.xxhash64(F.col(page_id).cast("string"))
    known = pages.where(F.col(body).isNotNull())
    first = known.select(spread.alias("spread")).orderBy("spread").limit(sample).agg(F.max("spread")).first()[0]
    taken = known.where(spread <= first).select(F.col(body).alias("html")).limit(sample).collect() if first is not None else []
    model = train([r.html for r in taken])
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(body).alias("html"))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, texts, part, held = Vectors(), [], [], 0
        for body in batch.column(2):
            part.append(body.as_py() or "")
            held += len(part[-1])
            if held >= PAGE_CHARS:
                texts += extract(part, model, vectors)
                part, held = [], 0
        texts += extract(part, model, vectors)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = [f.dataType.simpleString() for f in slim.schema.fields]
    return slim.mapInArrow(by_batch(rows), f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
