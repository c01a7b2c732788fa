"""Main-text extraction by a linear-chain conditional random field over a page's leaf blocks.

A block's features are the tags and class or id words of the elements around it, its length, links
and wording, its place on the page and what its neighbours look like; the chain learns how article
and other blocks follow each other. Viterbi decoding labels a page's blocks together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.html_blocks import Block, Node, blocks_of, root
from loglake.llm.html_training import MAIN, OTHER, drawn_pages
from loglake.llm.ragged import slices

#: Words of texts around an article.
HINTS = frozenset(
    "accept advertisement archive author banner by categories click comment comments contact cookie cookies copyright "
    "discussion email follow home leave log login menu more newsletter policy popular posted previous privacy recent "
    "register related replies reply reserved responses rights search send share sign sponsored subscribe tags terms tweet".split())
WORD = re.compile(r"[a-z]+")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def node_features(node: Node) -> list[str]:
    return [f"parent:{node.tag}", *(f"in:{t}" for t in node.tags), *(f"name:{n}" for n in node.around),
            *(f"own:{n}" for n in node.names)]


def _size(words: int) -> str:
    return "0123"[words] if words < 4 else "6" if words < 7 else "12" if words < 13 else "25" if words < 26 else "60" if words < 61 else "long"


def page_features(blocks: list[Block]) -> list[list[str]]:
    """The text features of each block; those of its surroundings come from its node."""
    shapes, out, heading = [], [], []
    for block in blocks:
        text = block.text
        words = text.count(" ") + 1
        share = block.linked / max(len(text), 1)
        shapes.append((_size(words), "none" if share == 0 else "some" if share < 0.5 else "most", block.node.tag))
    last = len(blocks) - 1
    for i, (block, (size, link, tag)) in enumerate(zip(blocks, shapes)):
        text = block.text
        features = [f"words:{size}", f"links:{link}", f"shape:{tag}:{size}:{link}"]
        if text[-1] in ".!?:;\"'":
            features.append("stop")
        if "|" in text:
            features.append("bar")
        if "©" in text:
            features.append("copyright")
        # The whole block is read; what stands at its beginning has a feature of its own.
        said = [(m.start(), h) for m in WORD.finditer(text.lower()) if (h := m.group()) in HINTS]
        head = 200 if len(text) < 400 else 60
        hints = {h for at, h in said if at < head}
        features += [f"says:{h}" for h in hints] + [f"later:{h}" for h in {h for _, h in said} - hints]
        features += [f"under:{h}" for h in heading]
        if tag in HEADINGS:
            heading = list(hints)
        place = i / last if last else 0.5
        features.append("place:" + ("first" if i == 0 else "last" if i == last else str(int(place * 5))))
        for side, j in (("before", i - 1), ("after", i + 1)):
            if 0 <= j <= last:
                features += [f"{side}:{shapes[j][0]}:{shapes[j][1]}", f"{side}:{shapes[j][2]}"]
                if blocks[j].node is block.node:
                    features.append(f"{side}:same")
            else:
                features.append(f"{side}:none")
        out.append(features)
    return out


@dataclass
class Model:
    weights: dict[str, float]
    start: np.ndarray
    change: np.ndarray

    def emission(self, blocks: list[Block], known: dict[int, tuple[Node, float]]) -> list[float]:
        """How much each block's features speak for the article. ``known`` remembers the nodes' part."""
        get, out = self.weights.get, []
        for block, features in zip(blocks, page_features(blocks)):
            node = block.node
            found = known.get(id(node))
            if found is None:
                found = known[id(node)] = (node, sum(get(f, 0.0) for f in node_features(node)))
            total = found[1]
            for f in features:
                total += get(f, 0.0)
            out.append(total)
        return out

    def viterbi(self, emission: list[float]) -> list[int]:
        """The likeliest labels (1: article) of one page's blocks; of equal ones, other."""
        (s0, s1), ((c00, c01), (c10, c11)) = self.start.tolist(), self.change.tolist()
        back = []
        a, b = s0, s1 + emission[0]
        for e in emission[1:]:
            from0, from1 = a + c00 < b + c10, a + c01 < b + c11
            back.append((from0, from1))
            a, b = max(a + c00, b + c10), max(a + c01, b + c11) + e
        label = int(b > a)
        labels = [label]
        for pair in reversed(back):
            label = int(pair[label])
            labels.append(label)
        return labels[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 250, penalty: float = 2e-4, least: int = 3) -> Model:
    """Maximum likelihood by gradient ascent, with the forward-backward sums of all pages at once."""
    count: dict[str, int] = {}
    for features, _ in pages:
        for block in features:
            for f in block:
                count[f] = count.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, n in count.items() if n >= least))}
    lengths = np.array([len(labels) for _, labels in pages])
    n, longest = len(pages), int(lengths.max())
    feature, slot, gold = [], [], np.zeros((n, longest), int)
    for p, (features, labels) in enumerate(pages):
        gold[p, :len(labels)] = labels
        for t, block in enumerate(features):
            own = [index[f] for f in block if f in index]
            feature += own
            slot += [p * longest + t] * len(own)
    feature, slot = np.array(feature), np.array(slot)
    real = np.arange(longest) < lengths[:, None]
    w, start, change = np.zeros(len(index)), np.zeros(2), np.zeros((2, 2))
    gold_start = np.array([(gold[:, 0] == y).sum() for y in (0, 1)])
    both = real[:, 1:]
    gold_change = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)])
    total = real.sum()
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, start, change)]
    log_sum = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for step in range(1, rounds + 1):
        emission = np.zeros((n, longest, 2))
        emission[:, :, 1] = np.bincount(slot, w[feature], minlength=n * longest).reshape(n, longest)
        forward = np.zeros((n, longest, 2))
        forward[:, 0] = start + emission[:, 0]
        for t in range(1, longest):
            new = log_sum(forward[:, t - 1, :, None] + change, 1) + emission[:, t]
            forward[:, t] = np.where(real[:, t, None], new, forward[:, t - 1])
        backward = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            new = log_sum(change + (emission[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], new, 0)
        norm = log_sum(forward[:, -1], 1)
        share = np.exp(forward + backward - norm[:, None, None]) * real[:, :, None]
        pair = np.exp(forward[:, :-1, :, None] + change + (emission[:, 1:] + backward[:, 1:])[:, :, None, :]
                      - norm[:, None, None, None]) * both[:, :, None, None]
        off = ((gold == 1) * real - share[:, :, 1]).ravel()
        slopes = (np.bincount(feature, off[slot], minlength=len(w)) / total - penalty * w,
                  (gold_start - share[:, 0].sum(0)) / total - penalty * start,
                  (gold_change - pair.sum((0, 1))) / total - penalty * change)
        for value, slope, (first, second) in zip((w, start, change), slopes, moments):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            value += 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Model({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-4}, start, change)


def all_features(blocks: list[Block]) -> list[list[str]]:
    return [node_features(b.node) + f for b, f in zip(blocks, page_features(blocks))]


def marked_page(html: str) -> tuple[list[list[str]], list[int]] | None:
    """Features and labels of a page whose texts carry the marks."""
    blocks = blocks_of(html, root())
    labels = [int(MAIN in b.text) for b in blocks]
    for b in blocks:
        b.text = " ".join(b.text.replace(MAIN, "").replace(OTHER, "").split())
    kept = [(b, y) for b, y in zip(blocks, labels) if b.text]
    return (all_features([b for b, _ in kept]), [y for _, y in kept]) if kept else None


def own_labels(html: str) -> tuple[list[list[str]], list[int]] | None:
    """Features of a page that names its article by one article or main element, which gives the labels."""
    blocks = blocks_of(html, root())
    marked = len(re.findall(r"<article[\s>]", html, re.I)) == 1 or len(re.findall(r"<main[\s>]", html, re.I)) == 1
    labels = [int(bool({"article", "main"} & b.node.tags) and not {"nav", "aside", "form", "footer"} & b.node.tags) for b in blocks]
    return (all_features(blocks), labels) if marked and any(labels) else None


def train(pages: DataFrame, own: int = 100, drawn: int = 500, longest: int = 50_000) -> Model:
    """Learn from ``drawn`` random layouts and at most ``own`` pages of the table that label themselves.

    Those are the ids of smallest hash among pages that hold one article or main element and are no
    longer than ``longest`` code points.
    """
    known = pages.filter((F.length("html") <= longest) & F.col("html").rlike("(?i)<(article|main)[ >]")).select(
        F.xxhash64("page_id", "html").alias("order"), "html")
    # Only hashes are ranked; then the few texts are fetched.
    first = [row["order"] for row in known.select("order").orderBy("order").limit(own).collect()]
    few = known.filter(F.col("order").isin(first)).dropDuplicates(["order"]).orderBy("order").collect()
    labelled = [own_labels(row["html"]) for row in few] + [marked_page(html) for html in drawn_pages(drawn)]
    return fit([page for page in labelled if page is not None])


def main_text(html: str, model: Model, top: Node, known: dict[int, tuple[Node, float]]) -> str:
    blocks = blocks_of(html, top)
    if not blocks:
        return ""
    labels = model.viterbi(model.emission(blocks, known))
    return " ".join(b.text for b, y in zip(blocks, labels) if y)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text`` of every page from its whole html.

    A null or empty html, or one without article blocks, has an empty text. Repeated rows stay;
    other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html", 2 << 20):
            top, known = root(), {}
            texts = [main_text(html or "", model, top, known) for html in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(
        run, f"page_id {kind}, url string, text string")
