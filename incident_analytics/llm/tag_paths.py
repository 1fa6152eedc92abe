"""Main text of HTML pages by tag-path ratios.

The text nodes of a page are grouped by their tag path, from the root to the leaf, classes
and ids included. For each path the text length and the punctuation per node are aggregated,
both are smoothed over neighbouring paths in page order and fused by their product; paths
at or above a threshold are content, and so are all their nodes. The threshold is the mean
minus a part of the deviation, at least a share of the mean weighted by text. The content
root is the least element around all content nodes, or the article or main element around
that; lists, tables, quotations and sections alone are no root, but what they stand in.

All text of the root is the result, headings and short lines beside content nodes included,
without two kinds of parts:

- What the page declares by tag or role to be no content: menus, headers and footers of the
  page, sidebars, dialogs, forms and their fields, scripts, styles, frames, hidden parts. An
  article or main element opens content again, so an unclosed menu before it does no harm.
- Parts that a class or id word hints at (adverts, notices, sidebars, comments, ...), and
  lists of nothing but links, if the ratios don't choose their path. A hint only lowers the
  score of its paths, by `HINT_FACTOR`. It counts for nothing on a part that holds an article
  or main element, or most of the text around it: more than half, or more than nine tenths
  where the whole name is the word (`comments`, not `has-comments`). Around means the article
  or main element, or the page. A part outside of all articles whose whole name is the word
  never outweighs them.

Character references are decoded, white space inside a block becomes one space, blocks
are trimmed, empty ones left out, and the others joined by a line feed in page order.
Formulas (math) and the text within object elements are text; CDATA sections are comments,
as HTML has them; noscript, svg, template and title are markup.
Null or empty HTML gives an empty text; a cut-off tag at the end is dropped; plain text
without markup is its own content. A page is one row whatever its length; repeated rows
give repeated results, and columns besides the key, address and HTML aren't read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.common import ship, text_or_empty

SMOOTHING = np.array([0.25, 0.5, 0.25])
DEVIATIONS = 0.5
LEAST_SHARE = 0.15  # of the text-weighted mean of the scores, for a path to be content
HINT_FACTOR = 0.1   # on the score of a path that a class, id or list of links hints at
HOLDS_MOST = {1: 0.5, 2: 0.9}  # shares of the text around above which a hint counts for nothing
LINK_ITEMS = 3      # items of nothing but links that make a list a menu

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Fixed words: tags and roles that declare a part to be no content, and words of classes and ids that hint at it.
NO_CONTENT_TAGS = frozenset("nav footer aside form head button menu dialog".split())
NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NO_CONTENT_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adbox sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside widget footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay comment "
    "comments disqus replies discussion share sharing social related recommended newsletter subscribe signup login form toolbar pager "
    "pagination".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_ENDS = {"li": ("p", "li"), "dd": ("p", "dd", "dt"), "dt": ("p", "dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_WORDS = re.compile(r"[a-z0-9]+")
_SIGNS = re.compile(r"[.,;:!?。、，；：！？…]")
#: Fixed tags of parts of a text, which never are the whole of it.
_PARTS = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup header pre li ul ol dl dt dd blockquote section details summary figure figcaption table caption thead "
    "tbody tfoot tr".split()
)


@lru_cache(maxsize=4096)
def _declared(tag: str, attributes: str) -> tuple[str, bool, int]:
    """The element's label in a path, whether tag or role declare it to be no content, and what its names hint at:
    2 if a whole name is a word of no content, 1 if a part of one is, 0 otherwise."""
    words, names, roles, hidden = set(), set(), set(), False
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        value = "".join(values).lower()
        if name.lower() == "role":
            roles.update(value.split())
        elif name.lower() in ("class", "id"):
            words.update(_WORDS.findall(value))
            names.update(value.split())
        else:
            hidden |= name.lower() == "hidden" or value == "true"
    no_content = tag in NO_CONTENT_TAGS or tag not in ("html", "body") and (hidden or bool(roles & NO_CONTENT_ROLES))
    hint = 2 if names & NO_CONTENT_WORDS else 1 if words & NO_CONTENT_WORDS else 0
    return f"{tag}.{'.'.join(sorted(words))}" if words else tag, no_content, 0 if tag in ("html", "body", "article", "main") else hint


class _Page:
    """Elements of a page in the order of their start tags; a parent stands before its children."""

    def __init__(self):
        self.tags, self.parents, self.paths, self.content, self.in_article, self.hints = ["#page"], [-1], [0], [True], [False], [0]
        self._path_ids: dict[tuple[int, str], int] = {}

    def add(self, tag: str, attributes: str, parent: int) -> int:
        label, no_content, hint = _declared(tag, attributes if len(attributes) < 500 else _hints(attributes))
        opens = tag in ("article", "main")
        in_article = self.in_article[parent] or opens
        no_content |= tag == "header" and not in_article
        self.tags.append(tag)
        self.parents.append(parent)
        self.paths.append(self._path_ids.setdefault((self.paths[parent], label), len(self._path_ids) + 1))
        self.content.append(not no_content and (self.content[parent] or opens or tag in ("html", "body")))
        self.in_article.append(in_article)
        self.hints.append(hint)
        return len(self.tags) - 1


def _hints(attributes: str) -> str:
    """Only the attributes that matter, so that long others aren't remembered."""
    return " ".join(f'{name}="{"".join(values)}"' for name, *values in _ATTRIBUTE.findall(attributes))


def text_nodes(html: str) -> tuple[_Page, list[tuple[int, str, bool]]]:
    """The page's elements, and (element, decoded text, whether a new block begins before it) in page order."""
    page = _Page()
    stack, nodes, at, new_block = [0], [], 0, True
    open_tags: Counter[str] = Counter()

    def text(raw: str) -> None:
        nonlocal new_block
        if raw:
            nodes.append((stack[-1], html_lib.unescape(raw), new_block))
            new_block = False

    def close(k: int) -> None:
        for element in stack[k:]:
            open_tags[page.tags[element]] -= 1
        del stack[k:]

    while True:
        token = _TOKEN.search(html, at)
        text(html[at:token.start()] if token else html[at:])
        if not token:
            return page, nodes
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        if token["tag2"] and not token[0].endswith(">"):
            return page, nodes
        closing, rest = token["end"] or token["end2"], token["rest"] or token["rest2"] or ""
        if tag in BLOCKS:
            new_block = True
        if closing:
            for k in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if page.tags[stack[k]] == tag:
                    close(k)
                    break
                if page.tags[stack[k]] in ("article", "main") and tag not in ("body", "html"):
                    break
        elif tag == "br":
            text(" ")
        elif tag in VOID:
            continue
        elif tag in RAW:
            if not rest.rstrip().endswith("/"):
                end = _end_of(tag).search(html, at)
                at = end.end() if end else len(html)
        else:
            ended = _ENDS.get(tag, ("p",) if tag in BLOCKS else ())
            if any(open_tags[t] for t in ended):  # a block ends an open paragraph, an item the item before it
                for k in range(len(stack) - 1, 0, -1):
                    if page.tags[stack[k]] in ended:
                        close(k)
                        break
                    if page.tags[stack[k]] in BLOCKS:
                        break
            stack.append(page.add(tag, rest, stack[-1]))
            open_tags[tag] += 1


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I)


def _link_lists(page: _Page, lengths: list[tuple[int, int]]) -> list[int]:
    """Lists of at least LINK_ITEMS items whose whole text is links."""
    n = len(page.tags)
    plain, linked, items = [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for element in range(1, n):
        in_link[element] = page.tags[element] == "a" or in_link[page.parents[element]]
    for element, length in lengths:
        (linked if in_link[element] else plain)[element] += length
    for element in range(n - 1, 0, -1):
        parent = page.parents[element]
        plain[parent] += plain[element]
        linked[parent] += linked[element]
        items[parent] += page.tags[element] == "li" and linked[element] > 0
    return [e for e in range(1, n) if page.tags[e] in ("ul", "ol") and items[e] >= LINK_ITEMS and not plain[e]]


def _hinted(page: _Page, lengths: list[tuple[int, int]]) -> list[bool]:
    """For each element whether it is in a part that a hint counts against."""
    n = len(page.tags)
    hints = list(page.hints)
    for element in _link_lists(page, lengths):
        hints[element] = max(hints[element], 1)
    if not any(hints):
        return [False] * n
    held, around, holds_article = [0] * n, [0] * n, [False] * n
    for element, length in lengths:
        held[element] += length
    for element in range(n - 1, 0, -1):
        parent = page.parents[element]
        held[parent] += held[element]
        holds_article[parent] |= holds_article[element] or page.tags[element] in ("article", "main")
    articles = any(held[e] and page.tags[e] in ("article", "main") for e in range(1, n))
    hinted = [False] * n
    for element in range(1, n):
        parent = page.parents[element]
        opens = page.tags[element] in ("article", "main")
        around[element] = element if opens else around[parent]
        counts = hints[element] and not holds_article[element] and (
            hints[element] == 2 and articles and not around[element]
            or held[element] <= HOLDS_MOST[hints[element]] * held[around[element]])
        hinted[element] = not opens and (hinted[parent] or bool(counts))
    return hinted


def content(page: _Page, nodes: list[tuple[int, str, bool]]) -> list[bool]:
    """For each node whether it belongs to the main text, by ratios of the tag paths."""
    lengths = [(element, len(text.strip()) if page.content[element] else 0) for element, text, _ in nodes]
    hinted = _hinted(page, lengths)
    per_path: dict[tuple[int, bool], list[float]] = {}
    for (element, n), (_, text, _) in zip(lengths, nodes):
        if n:
            sums = per_path.setdefault((page.paths[element], hinted[element]), [0.0, 0.0, 0.0])
            sums[0] += n
            sums[1] += len(_SIGNS.findall(text))
            sums[2] += 1
    if not per_path:
        return [False] * len(nodes)
    table = np.array(list(per_path.values()))
    text_ratio, sign_ratio = table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]
    fused = _smoothed(text_ratio) * (1 + _smoothed(sign_ratio))
    fused *= np.where([hint for _, hint in per_path], HINT_FACTOR, 1.0)
    weighted = float((fused * table[:, 0]).sum() / table[:, 0].sum())
    threshold = max(fused.mean() - DEVIATIONS * fused.std(), LEAST_SHARE * weighted)
    chosen = dict(zip(per_path, (fused >= threshold).tolist()))
    root = _root(page, [element for element, n in lengths if n and chosen[page.paths[element], hinted[element]]])
    inside = [False] * len(page.tags)
    for element, parent in enumerate(page.parents):
        inside[element] = element == root or parent >= 0 and inside[parent]
    return [page.content[e] and inside[e] and (not hinted[e] or n == 0 or chosen[page.paths[e], True]) for e, n in lengths]


def _root(page: _Page, chosen: list[int]) -> int:
    """The least element around the elements of all content nodes that may be a root."""
    held = [0] * len(page.tags)  # content nodes in each element
    for element in chosen:
        held[element] += 1
    for element in range(len(held) - 1, 0, -1):
        held[page.parents[element]] += held[element]
    root = 0
    for element in range(1, len(held)):  # at most one child of an element holds them all
        if page.parents[element] == root and held[element] == held[0]:
            root = element
    around = root
    while around > 0 and page.tags[around] not in ("article", "main"):
        around = page.parents[around]
    if around > 0:
        return around
    while root > 0 and (page.tags[root] not in BLOCKS or page.tags[root] in _PARTS):
        root = page.parents[root]
    return root


def _smoothed(values: np.ndarray) -> np.ndarray:
    """Average with the neighbours in page order; ends lean on themselves."""
    padded = np.concatenate([values[:1], values, values[-1:]])
    return np.convolve(padded, SMOOTHING, mode="valid")


def main_text(html: str) -> str:
    page, nodes = text_nodes(html)
    blocks: list[list[str]] = []
    new_block = True
    for (_, text, begins), kept in zip(nodes, content(page, nodes)):
        new_block |= begins or not kept
        if kept:
            if new_block:
                blocks.append([])
                new_block = False
            blocks[-1].append(text)
    joined = (" ".join("".join(block).split()) for block in blocks)
    return "\n".join(block for block in joined if block)


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text and n_chars of every page."""
    ship(df.sparkSession)
    source = df.select(F.col(key), F.col(url), text_or_empty(html).alias("_html"))
    schema = source.select(F.col(key), F.col(url), F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [key, url, "text", "n_chars"])

    return source.mapInArrow(run, schema)
