"""Main text of pages by a linear-chain conditional random field over leaf blocks (operator 10).

Each leaf block is described by the tags and names of its ancestors and by its text; the field
weighs these descriptions and the transitions between neighbouring blocks. It is fitted on
labelled pages by conditional likelihood and decoded by Viterbi on every whole page.

Labelled pages are a sample of at most ``Fit.pages`` rows whose markup names the main text
(``article`` or ``main``). Each also serves as text for ``Fit.layouts`` pages with a known layout, in
which menus, notices, adverts, forms, comments and the article stand under names that are drawn at
random, so that the field does not hang on one way to mark up a page. Everything else covers all
pages; the fitted weights are broadcast, and their number is bounded by the sample.

Defined cases: a null or empty page, or one without main text, gives the empty text. A null id is
kept, repeated rows are repeated, an empty table gives an empty result and fits nothing. Other
columns are carried only if named.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import slices
from slotcast.llm.html_blocks import Block, leaf_blocks

SLICE = 8 << 20
MAIN, ASIDE = {"article", "main"}, {"nav", "header", "footer", "aside", "form", "button", "select"}
LETTERS = "©®•·|»›"


@dataclass(frozen=True)
class Fit:
    pages: int = 240  # labelled rows, the bound of the sample
    page_bytes: int = 1 << 18  # larger pages are not used for fitting
    layouts: int = 4
    rounds: int = 100
    penalty: float = 0.001
    seed: int = 5


# ---- description of blocks -----------------------------------------------------------------


def _path_features(path: tuple) -> tuple[str, ...]:
    out = {f"tag={path[-1][0]}" if path else "tag="}
    for tag, names in path:
        out.add(f"in={tag}")
        out.update(f"name={n}" for n in names)
    return tuple(sorted(out))


def _text_features(block: Block) -> list[str]:
    text, n = block.text, len(block.text)
    words = text.count(" ") + 1
    out = [
        f"words={min(words.bit_length(), 8)}",
        f"linked={int(block.linked * 4)}",
        f"end={text[-1] if text[-1] in '.!?:;,' else 'x'}",
        f"commas={min(text.count(','), 3)}",
    ]
    if any(c in text for c in LETTERS):
        out.append("sign")
    if sum(map(str.isdigit, text)) * 4 > n:
        out.append("digits")
    return out


class Describer:
    """Features of the blocks of a page; those of paths are remembered."""

    def __init__(self):
        self._paths: dict[tuple, tuple[str, ...]] = {}

    def __call__(self, blocks: list[Block]) -> list[list[str]]:
        out = []
        for block in blocks:
            known = self._paths.get(block.path)
            if known is None:
                if len(self._paths) > 50_000:
                    self._paths.clear()
                known = self._paths[block.path] = _path_features(block.path)
            out.append([*known, *_text_features(block)])
        return out


# ---- the field -----------------------------------------------------------------------------


@dataclass
class Field:
    weights: dict[str, tuple[float, float]]
    first: np.ndarray  # label of the first block
    step: np.ndarray  # from label to label

    def decode(self, described: list[list[str]]) -> list[int]:
        """The most likely labels of a page's blocks (Viterbi)."""
        if not described:
            return []
        get, none = self.weights.get, (0.0, 0.0)
        (s00, s01), (s10, s11) = self.step.tolist()
        back: list[tuple[int, int]] = []
        best0, best1 = self.first.tolist()
        for place, features in enumerate(described):
            e0 = e1 = 0.0
            for feature in features:
                w = get(feature, none)
                e0 += w[0]
                e1 += w[1]
            if place:
                a, b = best0 + s00, best1 + s10
                c, d = best0 + s01, best1 + s11
                back.append((int(b > a), int(d > c)))
                best0, best1 = max(a, b), max(c, d)
            best0, best1 = best0 + e0, best1 + e1
        label = int(best1 > best0)
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        labels.reverse()
        return labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit_field(pages: list[tuple[list[list[str]], list[int]]], fit: Fit) -> Field:
    """Maximum conditional likelihood by adaptive gradient steps over all pages at once."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for described, _ in pages for block in described for f in block})
    number = {name: k for k, name in enumerate(names)}
    longest = max(len(labels) for _, labels in pages)
    shape = (len(pages), longest)
    there, label = np.zeros(shape, bool), np.zeros(shape, np.int64)
    place, feature = [], []
    for p, (described, labels) in enumerate(pages):
        there[p, : len(labels)], label[p, : len(labels)] = True, labels
        for t, block in enumerate(described):
            place += [p * longest + t] * len(block)
            feature += [number[f] for f in block]
    place, feature = np.array(place), np.array(feature)
    rows = np.arange(len(pages))
    size = 2 * len(names)
    theta, mass, speed = np.zeros(size + 6), np.zeros(size + 6), np.zeros(size + 6)
    truth = np.zeros((*shape, 2))
    truth[there, label[there]] = 1
    pairs = there[:, 1:] & there[:, :-1]
    true_step = np.zeros((2, 2))
    np.add.at(true_step, (label[:, :-1][pairs], label[:, 1:][pairs]), 1)
    for turn in range(1, fit.rounds + 1):
        weight, first, step = theta[:size].reshape(-1, 2), theta[size : size + 2], theta[size + 2 :]
        step = step.reshape(2, 2)
        emit = np.zeros((shape[0] * shape[1], 2))
        for k in range(2):
            emit[:, k] = np.bincount(place, weight[feature, k], shape[0] * shape[1])
        emit = emit.reshape(*shape, 2)
        ahead, behind = np.zeros((*shape, 2)), np.zeros((*shape, 2))
        ahead[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            moved = _log_sum(ahead[:, t - 1, :, None] + step, 1) + emit[:, t]
            ahead[:, t] = np.where(there[:, t, None], moved, ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            moved = _log_sum(step + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(there[:, t + 1, None], moved, behind[:, t + 1])
        share = np.exp(ahead + behind - total[:, None, None]) * there[..., None]
        between = (
            ahead[:, :-1, :, None] + step + (emit + behind)[:, 1:, None, :] - total[:, None, None, None]
        )
        between = np.exp(between) * pairs[..., None, None]
        off = (truth - share).reshape(-1, 2)
        slope = np.zeros(size + 6)
        for k in range(2):
            slope[k:size:2] = np.bincount(feature, off[place, k], len(names))
        slope[size : size + 2] = truth[rows, 0].sum(0) - share[rows, 0].sum(0)
        slope[size + 2 :] = (true_step - between.sum((0, 1))).reshape(-1)
        slope = slope / len(pages) - fit.penalty * theta
        mass = 0.9 * mass + 0.1 * slope
        speed = 0.99 * speed + 0.01 * slope * slope
        theta = theta + 0.2 * (mass / (1 - 0.9**turn)) / (np.sqrt(speed / (1 - 0.99**turn)) + 1e-8)
    weight = theta[:size].reshape(-1, 2)
    weights = {name: (float(a), float(b)) for name, (a, b) in zip(names, weight, strict=True)}
    return Field(weights, theta[size : size + 2], theta[size + 2 :].reshape(2, 2))


# ---- labelled pages ------------------------------------------------------------------------

#: Names under which parts of pages stand, by part; drawn at random for laid-out pages.
NAMES = {
    "main": "article content post entry story body main text page copy",
    "menu": "menu nav navigation navbar breadcrumb breadcrumbs topbar tabs toc",
    "head": "header masthead banner branding logo top",
    "foot": "footer foot copyright bottom colophon legal",
    "side": "sidebar side aside widget related recommended popular trending more share social",
    "note": "notice cookie cookies consent alert popup modal message gdpr privacy",
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion banner adsense",
    "form": "form subscribe newsletter signup login search contact",
    "comments": "comments comment discussion replies reply responses disqus respond",
}
TAGS = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}


def label_by_markup(blocks: list[Block]) -> list[int] | None:
    """1 inside the named main text and outside of parts named as something else."""
    others = {w for part, words in NAMES.items() if part != "main" for w in words.split()}
    labels = []
    for block in blocks:
        tags = [tag for tag, _ in block.path]
        inner = [k for k, tag in enumerate(tags) if tag in MAIN]
        spoiled = any(tag in ASIDE for tag in tags) or any(
            set(names) & others for _, names in block.path
        )
        labels.append(int(bool(inner) and not spoiled))
    return labels if any(labels) else None


def laid_out(paragraphs: list[str], draw: random.Random) -> tuple[str, list[int]]:
    """A page of known layout around the given paragraphs, and the labels of its leaf blocks."""
    labels: list[int] = []
    words = " ".join(paragraphs).split() or ["text"]

    def some(low: int, high: int) -> str:
        begin = draw.randrange(len(words))
        chosen = words[begin : begin + draw.randint(low, high)]
        return " ".join(chosen).replace("&", "&amp;").replace("<", "&lt;")

    def named_by(name: str) -> str:
        name += draw.choice(["", "", "-box", "-inner", "-wrapper", "-block", " col", " clearfix"])
        return f'{draw.choice(["class", "id"])}="{name}"'

    def marked(part: str, inside: str, strict: bool = True) -> str:
        tag = TAGS.get(part, "section" if draw.random() < 0.3 else "div")
        name = draw.choice(NAMES[part].split())
        if strict and tag != "div" and draw.random() < 0.5:
            return f"<{tag}>{inside}</{tag}>"
        tag = tag if draw.random() < 0.4 else "div"
        named = named_by(name)
        return f"<{tag} {named}>{inside}</{tag}>"

    def lines(n: int, low: int, high: int, link: bool, tag: str) -> str:
        labels.extend([0] * n)
        text = [some(low, high) for _ in range(n)]
        return "".join(f"<{tag}><a href='#'>{t}</a></{tag}>" if link else f"<{tag}>{t}</{tag}>" for t in text)

    def aside(part: str) -> str:
        n = draw.randint(1, 5)
        if part in ("menu", "side") and draw.random() < 0.7:
            return marked(part, "<ul>" + lines(n, 1, 4, True, "li") + "</ul>")
        if part == "comments":
            return marked(part, lines(n, 3, 60, False, draw.choice(["p", "div", "li"])), False)
        if part == "foot":
            labels.append(0)
            return marked(part, f"&copy; {some(1, 12)}")
        low, high = (2, 25) if part != "form" else (1, 4)
        plain = draw.random() < 0.4
        if plain:
            labels.append(0)
            return marked(part, some(low, high), part == "head")
        return marked(part, lines(min(n, 3), low, high, False, "p"), part in ("head", "form"))

    before = [p for p in ("note", "head", "menu", "advert", "form") if draw.random() < 0.6]
    draw.shuffle(before)
    html = "".join(aside(p) for p in before)
    middle = ""
    for k, text in enumerate(paragraphs):
        labels.append(1)
        tag = "h1" if k == 0 and draw.random() < 0.6 else draw.choice(["p", "p", "p", "p", "li", "blockquote", "div", "h2"])
        safe = text.replace("&", "&amp;").replace("<", "&lt;")
        middle += f"<{tag}>{safe}</{tag}>"
        if draw.random() < 0.12:
            middle += aside(draw.choice(["advert", "side", "note", "form"]))
    if draw.random() < 0.3:
        middle += aside("comments")
    kind = draw.random()
    if kind < 0.4:
        html += f"<{draw.choice(['article', 'main'])}>{middle}</>"
        html = html.replace("</>", "</article>" if "<article>" in html else "</main>")
    elif kind < 0.95:
        name = draw.choice(NAMES["main"].split())
        tag = "section" if draw.random() < 0.3 else "div"
        html += f"<{tag} {named_by(name)}>{middle}</{tag}>"
    else:
        html += middle
    after = [p for p in ("side", "comments", "advert", "form", "foot") if draw.random() < 0.6]
    html += "".join(aside(p) for p in after)
    return f"<html><body>{html}</body></html>", labels


def train(samples: list[str], fit: Fit) -> Field:
    draw, describe = random.Random(fit.seed), Describer()
    pages = []
    for html in samples:
        blocks = leaf_blocks(html)
        labels = label_by_markup(blocks)
        if labels is None:
            continue
        pages.append((describe(blocks), labels))
        main = [b.text for b, label in zip(blocks, labels, strict=True) if label]
        for _ in range(fit.layouts):
            page, labels = laid_out(main[: draw.randint(1, 30)], draw)
            blocks = leaf_blocks(page)
            if len(blocks) == len(labels):
                pages.append((describe(blocks), labels))
    if not pages:
        # No page says what its main text is: fit on layouts alone, around their longest blocks.
        for html in [*samples, "<p>text</p>"]:
            texts = sorted((b.text for b in leaf_blocks(html)), key=len)[-12:] or ["text"]
            for _ in range(fit.layouts):
                page, labels = laid_out(texts, draw)
                blocks = leaf_blocks(page)
                if len(blocks) == len(labels):
                    pages.append((describe(blocks), labels))
    return fit_field(pages, fit)


def sample(pages: DataFrame, html_col: str, fit: Fit) -> list[str]:
    """At most ``fit.pages`` pages for fitting, chosen by a hash of the page."""
    html = F.col(html_col).cast("string")
    named = html.rlike("(?i)<(article|main)[ >]")
    small = F.octet_length(html) <= fit.page_bytes
    other, by = (~named).cast("int").alias("other"), F.xxhash64(html).alias("by")
    chosen = pages.where(small).select(html.alias("html"), other, by)
    # First the hashes alone, so that no task sends pages that are not used.
    last = chosen.select("other", "by").distinct().orderBy("other", "by").limit(fit.pages).collect()
    if not last:
        return []
    edge = F.struct(F.lit(last[-1]["other"]), F.lit(last[-1]["by"]))
    rows = chosen.where(F.struct("other", "by") <= edge)
    # Copies of a page are one row, so no more than ``fit.pages`` come back.
    rows = rows.groupBy("other", "by").agg(F.min("html").alias("html")).collect()
    return [row["html"] for row in sorted(rows, key=lambda r: (r["other"], r["by"]))]


def main_text(blocks: list[Block], labels: list[int]) -> str:
    return "\n\n".join(b.text for b, label in zip(blocks, labels, strict=True) if label)


def extract(
    pages: DataFrame,
    fit: Fit = Fit(),
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """page_id, url, text, n_blocks (all leaf blocks of the page)."""
    samples = sample(pages, html_col, fit)
    field = train(samples, fit) if samples else None
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describe = Describer()
        for part in slices(batches, "html", SLICE):
            texts, counts = [], []
            for html in part.column("html").to_pylist():
                blocks = leaf_blocks(html or "")
                labels = shared.value.decode(describe(blocks)) if shared.value else [0] * len(blocks)
                texts.append(main_text(blocks, labels))
                counts.append(len(blocks))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(counts, pa.int64()),
                ],
                names=["page_id", "url", "text", "n_blocks"],
            )

    own = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return own.mapInArrow(run, "page_id bigint, url string, text string, n_blocks bigint")
