"""Operator 2, HTML extraction: a linear-chain conditional random field over leaf blocks.

A page becomes the sequence of its leaf blocks: pieces of text that no block-level
tag interrupts, each with the elements it lies in. Every block has features of
its ancestors (tags, words of their class, id and role) and of its text (length,
share of linked characters, punctuation, capitals, digits). The field scores a
labelling by the features' weights and by the labels that follow each other; it
is trained by maximum likelihood on labelled pages and decoded by Viterbi. The
blocks labelled as article, joined by line ends, are the main text.

Markup need not be well formed: end tags may lack, blocks close what is open
inside them, comments, scripts and styles that never end run to the end.

Defined cases: a null page counts as empty; a page without text has an empty
text; ties between labellings choose "not article"; rows are handled one by one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import query, read_columns
from .html_pages import labelled_pages

TRAIN_PAGES = 500
EPOCHS = 12
CONTEXTS_KEPT = 50_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>", re.S)
_NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search section select summary "
    "table tbody td textarea tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style template title noscript iframe object svg math canvas audio video head".split())
RAW = frozenset("script style title iframe noscript textarea".split())
# A start tag of the first kind closes an open element of the second, up to the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
CLOSES_P = BLOCKS - {"body", "html", "button", "label", "option", "optgroup", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "legend", "noscript"}


class Block:
    __slots__ = ("text", "context", "linked")

    def __init__(self, text: str, context: tuple, linked: int):
        self.text, self.context, self.linked = text, context, linked


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page, in order. A context is a tuple of ``(tag, attributes)`` from the root."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    context: tuple | None = None
    parts: list[str] = []
    linked = links = unread = 0  # unread: open elements whose text is not part of the page's
    low = None

    def flush() -> None:
        nonlocal linked, context
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                if context is None:
                    context = tuple(x for x in stack if x[0] in BLOCKS)
                out.append(Block(text, context, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close_to(depth: int) -> None:
        nonlocal links, unread, context
        links -= sum(t == "a" for t, _ in stack[depth:])
        unread -= sum(t in UNREAD for t, _ in stack[depth:])
        del stack[depth:]
        context = None

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        if found is None:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/][^>]*\Z", rest)
            if not unread:
                parts.append(rest[: cut.start()] if cut else rest)
                if links:
                    linked += len(parts[-1])
            break
        if found.start() > at and not unread:
            parts.append(page[at: found.start()])
            if links:
                linked += found.start() - at
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag in BLOCKS:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close_to(k)
                    break
                if stack[k][0] in BLOCKS and tag not in BLOCKS and tag not in UNREAD:
                    break  # an inline end tag does not reach beyond its block
            continue
        if tag in RAW:
            if low is None:
                low = page.lower()
            end = low.find(f"</{tag}", at)
            if tag == "textarea":
                flush()
            close = page.find(">", end) if end >= 0 else -1
            at = close + 1 if close >= 0 else size
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            context = None
            if tag == "body":
                for k, (open_tag, _) in enumerate(stack):
                    if open_tag == "head":  # its end tag may be left out
                        close_to(k)
                        break
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        close_to(k)
                        break
                    if stack[k][0] in BLOCKS or stack[k][0] in UNREAD:
                        break
            if tag in CLOSES:
                same, roof = CLOSES[tag]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in same:
                        close_to(k)
                        break
                    if stack[k][0] in roof or stack[k][0] in UNREAD:
                        break
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            continue
        stack.append((tag, found[3]))
        links += tag == "a"
        unread += tag in UNREAD
    flush()
    return out


def context_features(context: tuple) -> list[str]:
    """Features of the elements around a block."""
    out = set()
    for tag, attributes in context:
        out.add("in " + tag)
        for found in _NAMED.finditer(attributes):
            value = (found[1] or found[2] or found[3] or "").lower()
            out.update("named " + w for w in _WORD.findall(value))
    tags = [t for t, _ in context if t not in ("html", "body")]
    out.add("leaf " + (tags[-1] if tags else "-"))
    out.add("path " + ">".join(tags[-2:]))
    return sorted(out)


def text_features(block: Block) -> list[str]:
    """Features of a block's own text."""
    text = block.text
    words = text.count(" ") + 1
    size = len(text)
    length = "1" if words == 1 else "2" if words < 4 else "3" if words < 10 else "4" if words < 25 else "5" if words < 80 else "6"
    share = block.linked / size
    out = ["words " + length, "linked " + ("0" if share == 0 else "1" if share < 0.3 else "2" if share < 0.9 else "3")]
    out.append("ends " + ("stop" if text[-1] in ".?!…\"”»" else "colon" if text[-1] in ":," else "open"))
    if text[0] == "©":
        out.append("copyright")
    if text[0].isupper():
        out.append("capital")
    if any(c.isdigit() for c in text[:40]):
        out.append("digit")
    if words > 3 and text.count(",") + text.count(".") > words // 12:
        out.append("prose")
    return out


class Field:
    """Weights of the field for two labels; those of "article" are relative to "not article"."""

    def __init__(self, names: dict[str, int], weight: np.ndarray, follow: np.ndarray, first: float):
        self.names, self.weight, self.follow, self.first = names, weight, follow, first
        self.contexts: dict[tuple, float] = {}

    def __getstate__(self):
        return self.names, self.weight, self.follow, self.first

    def __setstate__(self, state):
        self.__init__(*state)

    def _sum(self, features: list[str]) -> float:
        names = self.names
        return float(sum(self.weight[names[f]] for f in features if f in names))

    def score(self, block: Block) -> float:
        around = self.contexts.get(block.context)
        if around is None:
            if len(self.contexts) >= CONTEXTS_KEPT:
                self.contexts.clear()
            around = self.contexts[block.context] = self._sum(context_features(block.context))
        return around + self._sum(text_features(block))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The best labelling, by Viterbi."""
        if not blocks:
            return []
        (f00, f01), (f10, f11) = self.follow.tolist()
        no, yes = 0.0, self.first + self.score(blocks[0])
        back = []
        for b in blocks[1:]:
            s = self.score(b)
            from_no, from_yes = yes + f10 <= no + f00, yes + f11 <= no + f01
            no, yes = (no + f00 if from_no else yes + f10), (no + f01 if from_yes else yes + f11) + s
            back.append((not from_no, not from_yes))
        label = yes > no
        out = [label]
        for to_no, to_yes in reversed(back):
            label = to_yes if label else to_no
            out.append(label)
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        blocks = blocks_of(page or "")
        return "\n".join(b.text for b, keep in zip(blocks, self.decode(blocks)) if keep)


def train(pages: list[tuple[str, dict[str, bool]]], epochs: int = EPOCHS, seed: int = 5) -> Field:
    """Maximum likelihood with a small penalty, by forward-backward and adaptive steps.

    ``pages`` have the label of each block by its text; blocks of other texts count as not article.
    """
    names: dict[str, int] = {}
    data = []
    for page, labels in pages:
        rows, y = [], []
        for b in blocks_of(page):
            features = context_features(b.context) + text_features(b)
            rows.append(np.array([names.setdefault(f, len(names)) for f in features]))
            y.append(int(labels.get(b.text, False)))
        if rows:
            data.append((rows, y))
    weight, follow, first = np.zeros(len(names)), np.zeros((2, 2)), 0.0
    g_weight, g_follow, g_first = np.full(len(names), 1e-6), np.full((2, 2), 1e-6), 1e-6
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            rows, y = data[k]
            n = len(rows)
            e = np.zeros((n, 2))
            e[:, 1] = [weight[r].sum() for r in rows]
            e[0, 1] += first
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = e[0]
            for t in range(1, n):
                forward[t] = e[t] + np.logaddexp(forward[t - 1, 0] + follow[0], forward[t - 1, 1] + follow[1])
            for t in range(n - 2, -1, -1):
                nxt = e[t + 1] + backward[t + 1]
                backward[t] = np.logaddexp(follow[:, 0] + nxt[0], follow[:, 1] + nxt[1])
            total = np.logaddexp(*forward[-1])
            p = np.exp(forward + backward - total)
            d = p[:, 1] - np.array(y)
            gw = np.zeros(len(names))
            for r, x in zip(rows, d):
                gw[r] += x
            touched = np.unique(np.concatenate(rows))
            gw[touched] += 1e-3 * weight[touched]
            gf = 1e-3 * follow
            for t in range(1, n):
                gf += np.exp(forward[t - 1][:, None] + follow + (e[t] + backward[t])[None, :] - total)
                gf[y[t - 1], y[t]] -= 1
            gs = p[0, 1] - y[0]
            g_weight += gw * gw
            g_follow += gf * gf
            g_first += gs * gs
            weight -= 0.3 * gw / np.sqrt(g_weight)
            follow -= 0.3 * gf / np.sqrt(g_follow)
            first -= 0.3 * gs / np.sqrt(g_first)
    return Field(names, weight, follow, float(first))


def extract_text(df: DataFrame, field: Field, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """All columns of ``df`` but the page, with its main text."""
    shipped = df.sparkSession.sparkContext.broadcast(field)
    keep = [k for k, c in enumerate(df.columns) if c not in (html_col, text_col)]
    at = df.columns.index(html_col)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shipped.value
        for batch in batches:
            texts = [crf.main_text(page.as_py()) for page in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(texts, pa.string())],
                names=[*(batch.schema.names[k] for k in keep), text_col])

    return df.mapInArrow(extracted, T.StructType([*(df.schema[k] for k in keep), T.StructField(text_col, T.StringType())]))


@query("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_columns(spark, sf_dir, "pages", page_id="long", url="string", html="string")
    found = extract_text(pages, train(labelled_pages(TRAIN_PAGES)))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
