"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page becomes the sequence of its leaf blocks: runs of text between the borders of block
elements, each with its ancestors. Features of a block are its ancestors' tags and the
words of their class, id and role, and the text's length, links and marks. The field has
two labels, main text and other; it is trained on labelled pages by the gradient of their
likelihood (forward-backward over all pages at once) and decoded by Viterbi.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.html_pages import labelled_pages

TOKEN = re.compile(
    r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*+>?"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b|(display\s*:\s*none)""", re.I)
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Never page text; without a closing tag these reach to the end of the page.
RAW = {"script", "style", "template", "iframe", "textarea", "noembed", "noframes"}
#: Not shown with the text; without a closing tag of their own only the opening tag is passed over.
HIDDEN = {"svg", "noscript", "select", "annotation", "annotation-xml"}
HIDDEN_TAGS = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<({"|".join(sorted(RAW))})(?=[\s/>])(?:.*?</\1(?=[\s/>])|.*)"""
    rf"""|<(/?)({"|".join(sorted(HIDDEN))})(?=[\s/>])((?>[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.S | re.I,
)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
    "q", "ruby", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr",
    "object", "param", "math", "semantics", "maction", "menclose", "merror", "mfenced", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover",
    "mpadded", "mphantom", "mprescripts", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable",
    "mtd", "mtext", "mtr", "munder", "munderover",
}
#: An opening tag closes an open element of these, up to the nearest of the borders.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
P_CONTAINERS = {"button", "td", "th", "caption", "object"}


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: int


def _names(attributes: str) -> tuple[str, ...]:
    out = []
    for m in ATTRIBUTE.finditer(attributes):
        if m[5] or m[6]:
            out.append("hidden")
        else:
            value = m[2] or m[3] or m[4] or ""
            out += [p.lower() for p in NAME_PARTS.findall(value)]
    return tuple(dict.fromkeys(out))


def _hidden_ends(page: str) -> dict[int, int]:
    """Where the hidden elements that have a closing tag of their own begin and end."""
    begun: dict[str, list[int]] = {}
    out = {}
    for m in HIDDEN_TAGS.finditer(page):
        if not m[3]:
            continue
        open_at = begun.setdefault(m[3].lower(), [])
        if m[2] and open_at:
            out[open_at.pop()] = m.end()
        elif not m[2] and not m[4].endswith("/"):
            open_at.append(m.start())
    return out


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order; char references decoded, white space joined and trimmed."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    texts: list[str] = []
    linked, links, at = 0, 0, 0
    base: tuple = ()
    hidden: dict[int, int] | None = None

    def flush():
        nonlocal texts, linked
        text = " ".join("".join(texts).split())
        if text:
            out.append(Block(text, base, linked))
        texts, linked = [], 0

    def cut(depth: int):
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[depth:])
        del stack[depth:]

    def put(raw: str):
        nonlocal linked, base
        if not raw:
            return
        text = html.unescape(raw)
        if not texts or not "".join(texts[-1:]).strip() and len(texts) == 1:
            base = tuple(stack)
        texts.append(text)
        if links:
            linked += len(text)

    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                put(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag, closing = m[2].lower(), m[1] == "/"
        if tag == "br":
            texts.append(" ")
            continue
        if not closing and tag in RAW:
            if tag != "template" or not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag in HIDDEN:
            if hidden is None:
                hidden = _hidden_ends(page)
            at = max(at, hidden.get(m.start(), at))
            continue
        if tag not in INLINE:
            flush()
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    cut(depth)
                    break
            continue
        if tag in CLOSES:
            same, border = CLOSES[tag]
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in same:
                    cut(depth)
                    break
                if stack[depth][0] in border:
                    break
        elif tag not in INLINE and tag not in VOID:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    cut(depth)
                    break
                if stack[depth][0] in P_CONTAINERS:
                    break
        if tag not in VOID and not m[3].endswith("/"):
            stack.append((tag, _names(m[3]) if m[3] else ()))
            links += tag == "a"
    flush()
    return out


def features(block: Block, at: int, count: int) -> set[str]:
    tags = [t for t, _ in block.path if t not in ("html", "body")]
    out = {"all"} | {f"in {t}" for t in tags} | {f"named {n}" for _, names in block.path for n in names}
    outer = [t for t in tags if t not in INLINE]
    out.add("leaf " + (outer[-1] if outer else "-"))
    out.add("parent " + (outer[-2] if len(outer) > 1 else "-"))
    near = next((t for t in reversed(outer) if t in ("article", "main", "nav", "aside", "header", "footer", "form", "head", "section")), "-")
    out.add("section " + near)
    words = block.text.count(" ") + 1
    out.add(f"words {min(words.bit_length(), 6)}")
    out.add(f"links {round(3 * min(1, block.linked / len(block.text)))}")
    out.add("ends" if block.text[-1] in ".!?:;\"'" else "open")
    out.add(f"copyright {'©' in block.text[:40]}")
    out.add(f"place {4 * at // count}")
    return out


@dataclass
class Field:
    """Weights: emission (feature, label), transition (label, label), first and last label."""

    index: dict[str, int]
    emission: np.ndarray
    step: np.ndarray
    ends: np.ndarray

    def scores(self, sequence: list[Block]) -> np.ndarray:
        out = np.zeros((len(sequence), 2))
        for i, b in enumerate(sequence):
            known = [self.index[f] for f in features(b, i, len(sequence)) if f in self.index]
            out[i] = self.emission[known].sum(0)
        return out

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best labels, by Viterbi; ties go to label 0."""
        n = len(scores)
        labels, back = np.zeros(n, int), np.zeros((n, 2), int)
        best = self.ends[0] + scores[0]
        for i in range(1, n):
            through = best[:, None] + self.step
            back[i] = through.argmax(0)
            best = through.max(0) + scores[i]
        labels[-1] = (best + self.ends[1]).argmax()
        for i in range(n - 1, 0, -1):
            labels[i - 1] = back[i, labels[i]]
        return labels

    def main_text(self, page: str | None) -> str:
        sequence = blocks(page or "")
        if not sequence:
            return ""
        labels = self.decode(self.scores(sequence))
        return " ".join(b.text for b, y in zip(sequence, labels, strict=True) if y)


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[str, list[int]]], rounds: int = 120, rate: float = 0.15, decay: float = 0.002) -> Field:
    """Fits the field by Adam on the mean log likelihood of whole labelled pages."""
    parsed = [(blocks(p), y) for p, y in pages]
    parsed = [(b, y) for b, y in parsed if b and len(b) == len(y)]
    index: dict[str, int] = {}
    for sequence, _ in parsed:
        for i, b in enumerate(sequence):
            for f in sorted(features(b, i, len(sequence))):
                index.setdefault(f, len(index))
    longest = max(len(b) for b, _ in parsed)
    owner, feature = [], []
    mask, truth = np.zeros((len(parsed), longest), bool), np.zeros((len(parsed), longest), int)
    for p, (sequence, y) in enumerate(parsed):
        mask[p, : len(y)], truth[p, : len(y)] = True, y
        for i, b in enumerate(sequence):
            known = sorted(index[f] for f in features(b, i, len(sequence)))
            feature += known
            owner += [p * longest + i] * len(known)
    owner, feature = np.array(owner), np.array(feature)
    size = np.array([len(y) for _, y in parsed])
    last = np.arange(len(parsed)), size - 1
    weights = [np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros((2, 2))]
    first_moment, second_moment = ([np.zeros_like(w) for w in weights] for _ in range(2))
    one = np.eye(2)[truth] * mask[..., None]
    for k in range(1, rounds + 1):
        emission, step, ends = weights
        z = np.stack([np.bincount(owner, emission[feature, c], mask.size) for c in (0, 1)], -1).reshape(*mask.shape, 2)
        ahead, behind = np.zeros_like(z), np.zeros_like(z)
        ahead[:, 0] = ends[0] + z[:, 0]
        for i in range(1, longest):
            ahead[:, i] = np.where(mask[:, i, None], z[:, i] + _sum(ahead[:, i - 1, :, None] + step, 1), ahead[:, i - 1])
        total = _sum(ahead[last] + ends[1], 1)
        behind[last] = ends[1]
        for i in range(longest - 2, -1, -1):
            on = (i + 1 < size)[:, None]
            behind[:, i] = np.where(on, _sum(step + (z[:, i + 1] + behind[:, i + 1])[:, None, :], 2), behind[:, i])
        node = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        pair = ahead[:, :-1, :, None] + step + (z[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        pair = np.exp(np.where(mask[:, 1:, None, None], pair, -np.inf))
        seen = (one[:, :-1, :, None] * one[:, 1:, None, :] * mask[:, 1:, None, None]).sum((0, 1))
        off = (one - node).reshape(-1, 2)
        slope = [
            np.stack([np.bincount(feature, off[owner, c], len(index)) for c in (0, 1)], -1),
            seen - pair.sum((0, 1)),
            np.stack([(one - node)[:, 0].sum(0), (one - node)[last].sum(0)]),
        ]
        for w, g, m, v in zip(weights, slope, first_moment, second_moment, strict=True):
            g = g / len(parsed) - decay * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)
    return Field(index, *weights)


def main_texts(pages: DataFrame, examples: int = 800) -> DataFrame:
    """page_id, url, text, n_chars of every row, from its whole html (null: empty).

    The text is empty, not null, where a page has no main text. Other columns are ignored;
    repeated rows are extracted alike. The field is trained on `examples` labelled pages
    and broadcast; its size follows their features.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train(labelled_pages(examples)))

    def extract(batches):
        for batch in batches:
            texts = [shared.value.main_text(p) for p in common.text_array(batch.column(2)).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kept = pages.select("page_id", "url", F.col("html"))
    return kept.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
