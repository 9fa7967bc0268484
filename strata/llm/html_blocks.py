"""Main text of web pages: a bidirectional LSTM labels every leaf block.

A page's leaf blocks (the texts between block-level tags) are read in order. Each is a
vector: hashed names of its tag path (tags, and tags with each class or id), hashed
words, and its length, link share and place. A bidirectional LSTM written in numpy reads
the whole sequence, so a block is judged in the light of all others of its page, and the
blocks judged main are joined. Character references are decoded and white space inside a
block becomes one space; markup, scripts, styles, comments and the head are never text.

Training uses at most FIT_PAGES pages (those of least hash), whose labels come from page
structure: inside an article or main element and not inside an element that says menu,
header, footer, aside, form, advert, notice or reader comments. Half of the training
reads the same pages with those two element names masked, so that words, links and
neighbours must tell too; some pages are read once more with their main blocks many
times over, so that long pages are known. The fitted weights (a fixed size) are broadcast; every page is
labelled in the task that reads it.

Defined cases: null or empty html has no text; without any page that has an article or
main element the labels fall back to the structural rule for all body text; repeated
pages give equal rows; an unclosed comment, script or tag ends the text; other columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.words import column, hash_words

FIT_PAGES = 400
EPOCHS = 8
LONG_BLOCKS = 300
PATH_SLOTS, WORD_SLOTS, HIDDEN = 64, 32, 24
BATCH = 64

# fixed values: element and class names with their usual meaning
_BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li "
                   "main menu nav noscript ol optgroup option p pre section select summary table tbody td textarea tfoot "
                   "th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea select svg math object".split())
_AROUND = frozenset("nav header footer aside form menu button dialog".split())
_AROUND_NAMES = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies "
                          "disclaimer footer form header menu nav navbar navigation newsletter notice pagination popup promo "
                          "related share sidebar social sponsor sponsored subscribe tags widget".split())
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
                      "ol p pre section table ul".split())

_TOKEN = re.compile(r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+|[^<>]*+)>|<[!?][^>]*+>""",
                    re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)


class Block:
    """A leaf's text, the path names of its elements, and its characters inside links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def leaf_blocks(source: str) -> list[Block]:
    """The page's non-empty leaf blocks in order."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    path: tuple[str, ...] | None = None
    linked = at = 0

    def close() -> None:
        nonlocal parts, path, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            blocks.append(Block(text, path or (), linked))
        parts, path, linked = [], None, 0

    def take(text: str) -> None:
        nonlocal path, linked
        if text and not any(tag in ("head", "title") for tag, _ in stack):
            parts.append(text)
            if not text.isspace():
                if path is None:
                    path = tuple(n for tag, names in stack for n in (tag, *names))
                if any(tag == "a" for tag, _ in stack):
                    linked += len(text)

    pos, end = 0, len(source)
    while pos < end:
        found = _TOKEN.search(source, pos)
        if found is None:
            rest = source[pos:]
            cut = re.search(r"<[a-zA-Z/!]", rest)
            take(rest[:cut.start()] if cut else rest)
            break
        take(source[pos:found.start()])
        pos = found.end()
        tag = (found.group(2) or "").lower()
        if not tag:
            continue
        if found.group(1):
            if tag in _BLOCK:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*+>?", re.I).search(source, pos)
            pos = stop.end() if stop else end
            if tag in _BLOCK:
                close()
            else:
                parts.append(" ")
            continue
        if tag in _BLOCK:
            close()
        elif tag == "br":
            parts.append(" ")
        if tag == "body":
            stack = [s for s in stack if s[0] not in ("head", "title")]
        if tag in _CLOSES_P or tag == "li":
            same = "li" if tag == "li" else "p"
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == same:
                    del stack[k:]
                    break
                if stack[k][0] in ("ul", "ol", "div", "article", "section", "td", "body"):
                    break
        if tag not in _VOID and not (found.group(3) or "").endswith("/"):
            names = tuple(f"{tag}.{n.lower()}" for m in _NAMES.finditer(found.group(3) or "")
                          for n in (m.group(1) or m.group(2) or m.group(3) or "").split())
            stack.append((tag, names))
    close()
    return blocks


def structural_label(block: Block) -> bool:
    """Inside an article or main element and outside everything that surrounds an article."""
    words = {w for n in block.path if "." in n for w in re.split(r"[-_.]", n.split(".", 1)[1])}
    return (not {"article", "main"}.isdisjoint(block.path) and _AROUND.isdisjoint(block.path)
            and words.isdisjoint(_AROUND_NAMES))


def _slot(name: str) -> int:
    data = np.frombuffer(name.encode(), np.uint8)
    return int(hash_words(data, np.array([0, len(data)]))[0][0] % np.uint64(PATH_SLOTS))


_SLOTS: dict[str, int] = {}


def block_vectors(pages: list[list[Block]], masked: frozenset[str] = frozenset()) -> np.ndarray:
    """One row per block of all pages in a row."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), PATH_SLOTS + WORD_SLOTS + 4), np.float32)
    encoded = [b.text.encode() for b in blocks]
    bounds = np.r_[0, np.cumsum([len(e) for e in encoded])].astype(np.int64)
    hashes, rows = hash_words(np.frombuffer(b"".join(encoded), np.uint8), bounds)
    sizes = np.diff(rows)
    of = np.repeat(np.arange(len(blocks)), sizes)
    np.add.at(out, (of, PATH_SLOTS + (hashes % np.uint64(WORD_SLOTS)).astype(np.int64)), 1)
    out[:, PATH_SLOTS:-4] /= np.sqrt(np.maximum(sizes, 1))[:, None]
    for i, b in enumerate(blocks):
        for name in b.path:
            if name.split(".", 1)[0] in masked:
                continue
            if name not in _SLOTS:
                if len(_SLOTS) > 50_000:
                    _SLOTS.clear()
                _SLOTS[name] = _slot(name)
            out[i, _SLOTS[name]] = 1
    out[:, -4] = np.log1p(sizes) / 5
    out[:, -3] = [min(1.0, b.linked / len(b.text)) for b in blocks]
    out[:, -2] = np.concatenate([np.arange(len(p)) / max(1, len(p)) for p in pages]) if blocks else 0
    out[:, -1] = np.concatenate([np.full(len(p), np.log1p(len(p)) / 5) for p in pages]) if blocks else 0
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Bidirectional LSTM with a logistic output per block; padded batches, numpy only."""

    def __init__(self, width: int, hidden: int = HIDDEN, seed: int = 5):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.hidden = hidden
        self.weights = {}
        for side in ("f", "b"):
            self.weights["x" + side] = draw.normal(0, width ** -0.5, (width, 4 * hidden))
            self.weights["h" + side] = draw.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden:2 * hidden] = 1
            self.weights["c" + side] = bias
        self.weights["out"] = draw.normal(0, hidden ** -0.5, 2 * hidden)
        self.weights["bias"] = np.zeros(1)

    def _walk(self, x: np.ndarray, mask: np.ndarray, side: str):
        """States over time; the steps' gates for the way back. Padding keeps the state."""
        batch, length, _ = x.shape
        n, w = self.hidden, self.weights
        before = x @ w["x" + side] + w["c" + side]
        h, c = np.zeros((batch, n)), np.zeros((batch, n))
        states, steps = np.zeros((batch, length, n)), []
        for t in (range(length) if side == "f" else range(length - 1, -1, -1)):
            z = before[:, t] + h @ w["h" + side]
            i, f, o, g = _sigmoid(z[:, :n]), _sigmoid(z[:, n:2 * n]), _sigmoid(z[:, 2 * n:3 * n]), np.tanh(z[:, 3 * n:])
            m = mask[:, t, None]
            c_new = m * (f * c + i * g) + (1 - m) * c
            squashed = np.tanh(c_new)
            h_new = m * o * squashed + (1 - m) * h
            steps.append((t, h, c, i, f, o, g, squashed, m))
            h, c = h_new, c_new
            states[:, t] = h
        return states, steps

    def _back(self, x: np.ndarray, steps, grad_states: np.ndarray, side: str) -> dict[str, np.ndarray]:
        n, w = self.hidden, self.weights
        dz_all = np.zeros((*x.shape[:2], 4 * n))
        dwh = np.zeros_like(w["h" + side])
        dh, dc = np.zeros((len(x), n)), np.zeros((len(x), n))
        for t, h, c, i, f, o, g, squashed, m in reversed(steps):
            total = dh + grad_states[:, t]
            inner = m * total
            dcell = dc + inner * o * (1 - squashed ** 2)
            step = m * dcell
            dz = np.concatenate([step * g * i * (1 - i), step * c * f * (1 - f), inner * squashed * o * (1 - o),
                                 step * i * (1 - g ** 2)], axis=1)
            dwh += h.T @ dz
            dz_all[:, t] = dz
            dh = dz @ w["h" + side].T + (1 - m) * total
            dc = step * f + (1 - m) * dcell
        flat = dz_all.reshape(-1, 4 * n)
        return {"x" + side: x.reshape(-1, x.shape[2]).T @ flat, "h" + side: dwh, "c" + side: flat.sum(0)}

    def odds(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        n = self.hidden
        both = np.concatenate([self._walk(x, mask, "f")[0], self._walk(x, mask, "b")[0]], axis=2)
        return both @ self.weights["out"][:2 * n] + self.weights["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        forward, f_steps = self._walk(x, mask, "f")
        backward, b_steps = self._walk(x, mask, "b")
        both = np.concatenate([forward, backward], axis=2)
        error = (_sigmoid(both @ self.weights["out"] + self.weights["bias"]) - y) * mask / mask.sum()
        states = error[:, :, None] * self.weights["out"]
        n = self.hidden
        return {"out": np.einsum("bt,btn->n", error, both), "bias": np.array([error.sum()]),
                **self._back(x, f_steps, states[:, :, :n], "f"), **self._back(x, b_steps, states[:, :, n:], "b")}

    def fit(self, samples: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.02, seed: int = 6) -> None:
        """Adam over shuffled batches of (vectors, labels) per page."""
        draw = np.random.Generator(np.random.PCG64(seed))
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        samples = sorted(samples, key=lambda pair: len(pair[1]))  # batches of like length, in shuffled order
        starts = np.arange(0, len(samples), BATCH // 2)
        for _ in range(epochs):
            for k in draw.permutation(starts):
                x, mask, y = padded(*zip(*samples[k:k + BATCH // 2]))
                step += 1
                for name, g in self.gradients(x, mask, y).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    self.weights[name] -= (rate * (first[name] / (1 - 0.9 ** step))
                                           / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8))


def padded(vectors: list[np.ndarray], labels: list[np.ndarray] | None = None):
    length = max(map(len, vectors))
    x = np.zeros((len(vectors), length, vectors[0].shape[1]))
    mask, y = np.zeros((len(vectors), length)), np.zeros((len(vectors), length))
    for i, v in enumerate(vectors):
        x[i, :len(v)], mask[i, :len(v)] = v, 1
        if labels is not None:
            y[i, :len(v)] = labels[i]
    return x, mask, y


def fit_labeller(pages: DataFrame, fit_pages: int = FIT_PAGES) -> BlockLabeller | None:
    """Fit on at most ``fit_pages`` pages that have an article or main element; None without any."""
    named = pages.where(F.lower("html").rlike("<(article|main)[^a-z]")).select(F.xxhash64("page_id", "url").alias("h"), "html")
    last = named.select("h").orderBy("h").limit(fit_pages).agg(F.max("h")).first()[0]
    if last is None:
        return None
    samples = []
    masked = frozenset(("article", "main"))
    sample = named.where(F.col("h") <= last).select("html").limit(fit_pages).collect()  # the bounded sample
    for i, r in enumerate(sorted(sample)):
        blocks = leaf_blocks(r["html"])
        labels = np.array([structural_label(b) for b in blocks], float)
        if not labels.any():
            continue
        samples += [(block_vectors([blocks]), labels), (block_vectors([blocks], masked), labels)]
        if i % 8 == 0:  # and now and then as a long page, its main blocks many times over
            first, last = int(labels.argmax()), len(labels) - int(labels[::-1].argmax())
            times = 1 + LONG_BLOCKS // (last - first)
            blocks = blocks[:first] + blocks[first:last] * times + blocks[last:]
            labels = np.concatenate([labels[:first], np.tile(labels[first:last], times), labels[last:]])
            samples.append((block_vectors([blocks]), labels))
    if not samples:
        return None
    model = BlockLabeller(samples[0][0].shape[1])
    model.fit(samples)
    return model


def main_blocks(model: BlockLabeller | None, sources: list[str]) -> list[list[str]]:
    """The main blocks' texts of each page."""
    pages = [leaf_blocks(s) for s in sources]
    if model is None:
        return [[b.text for b in p if _AROUND.isdisjoint(b.path)] for p in pages]
    out: list[list[str]] = [[] for _ in pages]
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    for k in range(0, len(order), BATCH):
        chosen = order[k:k + BATCH]
        vectors = np.split(block_vectors([pages[i] for i in chosen]), np.cumsum([len(pages[i]) for i in chosen])[:-1])
        x, mask, _ = padded(vectors)
        for i, odds in zip(chosen, model.odds(x, mask)):
            out[i] = [b.text for b, o in zip(pages[i], odds) if o > 0]
    return out


def extract_main_text(pages: DataFrame, fit_pages: int = FIT_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main blocks joined by line feeds."""
    sent = pages.sparkSession.sparkContext.broadcast(fit_labeller(pages, fit_pages))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4 * BATCH):
                batch = whole.slice(at, 4 * BATCH)
                texts = ["\n".join(p) for p in main_blocks(sent.value, [s or "" for s in column(batch, "html").to_pylist()])]
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "page_id").cast(pa.int64()), column(batch, "url").cast(pa.string()), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
