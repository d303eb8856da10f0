"""Main text of HTML pages: flat text blocks, classified by a decision tree over word counts and link densities of a block and its
neighbours and over the containers it stands in.  The tree is trained on the small labelled table below."""
from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import groups, pick

# ---- fixed values: element and class names, and hand-labelled blocks ----------------------------------------------
BLOCK_TAGS = set("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                 "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
                 "title tr ul".split())
CONTAINERS = set("article aside body details dialog div dl fieldset figure footer form header main menu nav ol section table td tr ul".split())
NOT_CONTENT = set("aside dialog fieldset footer form menu nav".split())
RAW = "script style textarea title iframe".split()                              # hold no markup
SKIPPED = set("noscript template object svg math select button video audio canvas".split())
ENDED_BY_BLOCKS = {"select", "button"}                                          # where they are left open
HINTS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
            "header login menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies reply search "
            "share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget alert complementary contentinfo".split())
FEATURES = "words link_density words_before density_before words_after density_after in_article in_other heading hinted".split()
LABELLED = [  # the features in this order, then 1 for main text
    # inside an article, any length
    (1, 0, 6, 0, 8, 0, 1, 0, 1, 0, 1), (9, 0, 0, 0, 30, 0, 1, 0, 1, 0, 1), (1, 0, 40, 0, 25, 0, 1, 0, 0, 0, 1), (3, 0, 2, 0, 2, 0, 1, 0, 0, 0, 1),
    (12, 0, 9, 1, 60, 0, 1, 0, 0, 0, 1), (55, 0.04, 70, 0, 8, 0.5, 1, 0, 0, 0, 1), (180, 0, 20, 0, 0, 0, 1, 0, 0, 0, 1), (4, 1, 30, 0, 45, 0, 1, 0, 0, 0, 1),
    (25, 0.6, 14, 0, 14, 0, 1, 0, 0, 0, 1), (7, 0, 0, 0, 0, 0, 1, 0, 0, 0, 1), (2, 0, 1, 1, 5, 0, 1, 0, 1, 0, 1), (30, 0, 1, 1, 7, 0, 1, 0, 0, 0, 1),
    (1, 0, 0, 0, 1, 1, 1, 0, 0, 0, 1), (12, 0, 3, 0, 2, 1, 1, 0, 0, 0, 1), (9, 0.7, 50, 0, 1, 1, 1, 0, 0, 0, 1),
    (2, 0, 0, 0, 0, 0, 1, 0, 0, 0, 1), (3, 0, 60, 0, 3, 1, 1, 0, 1, 0, 1), (200, 0.5, 0, 0, 6, 0.9, 1, 0, 0, 0, 1),
    # inside menus, headers, footers, sidebars, notices, adverts, forms, comments, in an article or out of it
    (1, 1, 0, 0, 1, 1, 0, 1, 0, 0, 0), (2, 1, 1, 1, 1, 1, 0, 1, 0, 0, 0), (14, 0, 1, 1, 9, 0, 0, 1, 0, 0, 0), (60, 0, 5, 0, 40, 0, 0, 1, 0, 0, 0),
    (9, 0, 44, 0, 0, 0, 0, 1, 0, 0, 0), (120, 0.02, 50, 0, 20, 0, 0, 1, 0, 0, 0), (25, 0, 3, 0, 60, 0, 0, 1, 1, 0, 0), (35, 0, 90, 0, 30, 0, 1, 1, 0, 0, 0),
    (6, 0, 20, 0, 50, 0, 1, 1, 1, 0, 0), (2, 1, 30, 0, 2, 1, 1, 1, 0, 0, 0), (80, 0, 60, 0, 10, 0, 1, 1, 0, 0, 0), (5, 0.8, 5, 0.8, 5, 0.8, 0, 1, 0, 0, 0),
    # pages without an article element: long runs of text, their headings and short lines between them
    (40, 0, 8, 0, 50, 0, 0, 0, 0, 0, 1), (80, 0.1, 60, 0, 3, 1, 0, 0, 0, 0, 1), (18, 0, 2, 1, 30, 0, 0, 0, 0, 0, 1), (150, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1),
    (22, 0.05, 40, 0, 2, 0.9, 0, 0, 0, 0, 1), (6, 0, 50, 0, 45, 0, 0, 0, 0, 0, 1), (2, 0, 35, 0, 60, 0, 0, 0, 0, 0, 1), (8, 0, 3, 1, 55, 0, 0, 0, 1, 0, 1),
    (5, 0, 0, 0, 28, 0, 0, 0, 1, 0, 1), (2, 0, 3, 1, 42, 0, 0, 0, 1, 0, 1), (3, 0, 6, 0.5, 90, 0, 0, 0, 1, 0, 1), (1, 0, 2, 1, 33, 0, 0, 0, 1, 0, 1), (12, 0, 24, 0, 11, 0, 0, 0, 0, 0, 1), (60, 0.2, 3, 1, 18, 0, 0, 0, 0, 0, 1), (11, 0, 18, 0, 70, 0.1, 0, 0, 0, 0, 1),
    # and what stands around it
    (1, 1, 0, 0, 1, 1, 0, 0, 0, 0, 0), (3, 1, 2, 1, 4, 1, 0, 0, 0, 0, 0), (2, 0, 3, 1, 3, 1, 0, 0, 1, 0, 0), (3, 0, 30, 0, 4, 1, 0, 0, 1, 0, 0), (4, 0, 1, 1, 2, 1, 0, 0, 0, 0, 0), (12, 0.9, 3, 1, 8, 0.7, 0, 0, 0, 0, 0),
    (30, 0.8, 20, 0.9, 25, 0.7, 0, 0, 0, 0, 0), (2, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0), (3, 0, 2, 0, 3, 1, 0, 0, 0, 0, 0), (9, 0.6, 40, 0, 5, 1, 0, 0, 0, 0, 0),
    (7, 0, 2, 1, 3, 0, 0, 0, 0, 0, 0), (3, 0, 3, 0, 0, 0, 0, 0, 0, 0, 0), (5, 0.5, 60, 0, 0, 0, 0, 0, 0, 0, 0), (18, 1, 50, 0, 40, 0, 0, 0, 0, 0, 0),
    # paragraphs of middle length between others, headings and last lines
    (14, 0, 95, 0, 250, 0, 1, 0, 0, 0, 1), (25, 0, 52, 0, 11, 0, 1, 0, 0, 0, 1), (31, 0, 140, 0, 60, 0, 1, 0, 0, 0, 1), (18, 0.1, 60, 0, 9, 0, 1, 0, 0, 0, 1), (8, 0, 70, 0, 90, 0, 1, 0, 0, 0, 1),
    (22, 0, 60, 0, 70, 0, 1, 0, 0, 0, 1), (34, 0, 55, 0, 34, 0, 1, 0, 0, 0, 1), (11, 0.4, 48, 0, 20, 0, 1, 0, 0, 0, 1), (6, 0, 120, 0, 45, 0, 1, 0, 0, 0, 1), (28, 0, 80, 0, 0, 0, 1, 0, 0, 0, 1),
    (16, 0, 30, 0, 4, 1, 1, 0, 0, 0, 1), (26, 0, 64, 0, 12, 0.9, 1, 0, 0, 0, 1), (3, 0, 80, 0, 2, 0, 1, 0, 0, 0, 1), (5, 0, 3, 1, 33, 0, 1, 0, 0, 0, 1), (9, 0, 2, 1, 5, 1, 1, 0, 0, 0, 1), (2, 0, 7, 1, 3, 1, 1, 0, 0, 0, 1),
    (20, 0, 50, 0, 40, 0, 0, 0, 0, 0, 1), (30, 0.1, 46, 0, 60, 0, 0, 0, 0, 0, 1), (14, 0, 55, 0, 33, 0.2, 0, 0, 0, 0, 1), (26, 0, 33, 0, 0, 0, 0, 0, 0, 0, 1),
    # runs of links alone inside an article are menus; one such block between paragraphs is not
    (4, 1, 4, 1, 4, 1, 1, 0, 0, 0, 0), (2, 1, 3, 1, 2, 1, 1, 0, 0, 0, 0), (6, 1, 5, 0.9, 4, 1, 1, 0, 0, 0, 0), (3, 1, 2, 1, 5, 0.95, 1, 0, 0, 0, 0),
    (30, 0, 5, 1, 4, 1, 1, 0, 0, 0, 1), (5, 0, 4, 1, 5, 1, 1, 0, 1, 0, 1), (4, 1, 12, 0, 4, 1, 1, 0, 0, 0, 1), (4, 1, 4, 1, 30, 0, 1, 0, 0, 0, 1), (40, 0.95, 30, 0.9, 20, 0.9, 1, 0, 0, 0, 1),
    # paragraphs whose own class is a hint: short ones are notices, long ones between text are text
    (1, 0, 1, 0, 0, 0, 1, 0, 0, 1, 0), (6, 0, 40, 0, 50, 0, 1, 0, 0, 1, 0), (14, 0.2, 30, 0, 30, 0, 1, 0, 0, 1, 0), (20, 0, 4, 0, 60, 0, 1, 0, 1, 1, 0), (9, 1, 60, 0, 0, 0, 1, 0, 0, 1, 0), (3, 0, 0, 0, 30, 0, 0, 0, 0, 1, 0), (25, 0, 50, 0, 40, 0, 0, 0, 0, 1, 0),
    (60, 0, 45, 0, 50, 0, 1, 0, 0, 1, 1), (90, 0.05, 30, 0, 70, 0, 1, 0, 0, 1, 1), (150, 0, 80, 0, 30, 0, 0, 0, 0, 1, 1), (70, 0, 40, 0, 90, 0, 0, 0, 0, 1, 1),
    # without an article: what is before a short line and what follows it tell text from its surroundings
    (3, 0, 40, 0, 0, 0, 0, 0, 0, 0, 1), (3, 0, 4, 1, 0, 0, 0, 0, 0, 0, 0), (8, 0, 45, 0, 6, 1, 0, 0, 0, 0, 1), (8, 0, 2, 1, 6, 1, 0, 0, 0, 0, 0), (6, 0, 30, 0, 30, 1, 0, 0, 0, 0, 1), (6, 0, 30, 1, 30, 1, 0, 0, 0, 0, 0),
    (2, 1, 42, 0, 0, 0, 0, 0, 0, 0, 0), (4, 0.9, 60, 0, 0, 0, 0, 0, 0, 0, 0), (3, 1, 44, 0, 6, 0, 0, 0, 0, 0, 0), (5, 1, 30, 0, 3, 0.5, 0, 0, 0, 0, 0),
    (2, 1, 42, 0, 0, 0, 1, 0, 0, 0, 1), (5, 1, 60, 0, 4, 0, 1, 0, 0, 0, 1), (6, 0.9, 44, 0, 10, 0, 1, 0, 0, 0, 1),
]
# -------------------------------------------------------------------------------------------------------------------

# an attribute's value may be unquoted and hold quotes; a quote that is never closed is a part of it
_ATTRIBUTES = r"""((?:[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+|[\s/"'=]++)*+)"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+){_ATTRIBUTES}(?:>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_END = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in [*RAW, *SKIPPED]}


def _hinted(attributes: str, article: bool) -> bool:
    """Whether an element's names hint at something other than main text."""
    return "=" in attributes and any(w in HINTS and not (article and w == "header") for m in _NAMES.finditer(attributes) for w in re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower()))


def _aside(tag: str, attributes: str, article: bool) -> bool:
    """Whether a container holds something other than main text."""
    return tag in NOT_CONTENT or tag == "header" and not article or tag not in ("body", "html", "main") and _hinted(attributes, article)


def blocks(page: str) -> list[tuple[str, int, float, bool, bool, bool, bool]]:
    """(text, words, link density, in an article, in other matter, heading, own hint) of each flat text block that has a word."""
    out, stack, parts = [], [], []          # stack: (tag, article so far, other matter so far)
    state, link, heading, hinted, at = (False, False), False, False, False, 0
    skipped, inner = "", 0                  # the element whose content is left out, containers opened inside it
    last_end: dict[str, int] = {}           # of each element, where its last end tag is: one without never closes and holds nothing

    def closes(tag: str, after: int) -> bool:
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in _END[tag].finditer(page)), default=-1)
        return last_end[tag] >= after

    def flush():
        nonlocal parts
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            n = text.count(" ") + 1
            linked = sum(len(t.split()) for t, a in parts if a)
            out.append((text, n, min(1.0, linked / n), state[0], state[1], heading, hinted))
        parts = []

    while m := _TOKEN.search(page, at):
        if m.start() > at and not skipped:
            parts.append((html.unescape(page[at:m.start()]), link))
        at = m.end()
        tag, closing, attributes = (m[2] or "").lower(), bool(m[1]), m[3] or ""
        if not tag:
            continue
        if skipped:
            if tag == skipped and closing:
                skipped = ""
                continue
            if tag in CONTAINERS:
                inner += -1 if closing else 1
            if inner >= 0 and not (tag in BLOCK_TAGS and skipped in ENDED_BY_BLOCKS):
                continue
            skipped = ""                    # left open: ends with what it stands in
        if tag in RAW and not closing:
            if closes(tag, at):
                at = _END[tag].search(page, at).end()
            elif tag in ("script", "style"):
                at = len(page)
            continue
        if tag in SKIPPED:
            if not closing and not attributes.endswith("/") and closes(tag, at):
                skipped, inner = tag, 0
            continue
        if tag == "a":
            link = not closing
        if tag not in BLOCK_TAGS:
            continue
        flush()
        hinted = False
        if tag in CONTAINERS:
            link = False
            if not closing:
                article = state[0] or tag in ("article", "main")
                stack.append((tag, state))
                state = article, state[1] or _aside(tag, attributes, state[0])
            elif any(t == tag for t, _ in stack):
                while True:
                    t, state = stack.pop()
                    if t == tag:
                        break
        else:
            hinted = not closing and _hinted(attributes, state[0])
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                heading = not closing
            elif tag in ("p", "li"):
                heading = False
    if at < len(page) and not skipped:
        parts.append((html.unescape(page[at:]), link))
    flush()
    return out


def features(found: list[tuple[str, int, float, bool, bool, bool, bool]]) -> np.ndarray:
    own = np.array([b[1:] for b in found], float).reshape(-1, 6)
    near = np.vstack([np.zeros((1, 2)), own[:, :2], np.zeros((1, 2))])
    return np.hstack([own[:, :2], near[:-2], near[2:], own[:, 2:]])


def train(rows: list[tuple], depth: int = 8) -> dict | float:
    """A binary classification tree (Gini), split until pure: {"by", "at", "low", "high"} or the label."""
    data = np.array(rows, float)
    y = data[:, -1]
    if depth == 0 or y.min() == y.max():
        return float(y.mean() >= 0.5)
    best = None
    for by in range(data.shape[1] - 1):
        for at in (lambda v: (v[1:] + v[:-1]) / 2)(np.unique(data[:, by])):
            low = data[:, by] <= at
            cost = sum(s.sum() * y[s].mean() * (1 - y[s].mean()) for s in (low, ~low))
            if best is None or cost < best[0] - 1e-12:
                best = cost, by, at, low
    if best is None:
        return float(y.mean() >= 0.5)
    _, by, at, low = best
    return {"by": by, "at": float(at), "low": train(data[low].tolist(), depth - 1), "high": train(data[~low].tolist(), depth - 1)}


def classify(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, dict):
        return np.full(len(x), tree > 0)
    low, out = x[:, tree["by"]] <= tree["at"], np.zeros(len(x), bool)
    out[low], out[~low] = classify(tree["low"], x[low]), classify(tree["high"], x[~low])
    return out


def main_text(page: str, tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return " ".join(b[0] for b, yes in zip(found, classify(tree, features(found))) if yes)


def extract(pages: DataFrame, labelled: list[tuple] = LABELLED, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Blocks are the texts between block-level tags, with references decoded and white space as one space; the kept ones are
    joined in page order by one space.  Null, empty and textless pages give an empty text; unclosed elements end with their
    container or the page, and one that should hold no text but never closes hides none; repeated rows stay; an empty table gives an empty result; other columns are dropped.
    """
    tree = train(labelled)
    source = pick(pages, page_id=id_col, url=url_col, html=html_col)

    def run(batches):
        for found, rows, b in groups(batches, "html", 1 << 22):
            texts, own = [main_text(t.decode("utf-8"), tree) for t in found], b.slice(rows[0], len(rows))
            yield pa.RecordBatch.from_arrays([own.column("page_id"), own.column("url"), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
