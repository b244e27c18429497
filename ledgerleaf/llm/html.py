"""Main text of web pages as a maximum-scoring subsequence.

A page is read as a sequence of words, which score positive, and tags, which score negative. One linear scan
finds the contiguous region with the largest sum: the main content. The weights are learnt from labelled pages,
those whose authors marked the main text with an ``article`` element: where the best region of a labelled page
is not the marked one, the tags in which they differ are corrected. Elements that are never main text by
their name, role or class (menus, adverts, forms, scripts, reader comments and so on) are taken out first.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_lists, read

_PARTS = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(?P<raw>script|style|textarea|title|noscript|iframe|template|xmp)\b(?:"[^"]*"|'[^']*'|[^'">])*+(?:>.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attributes>(?:"[^"]*"|'[^']*'|[^'">])*+)(?:>|\Z)"""
    r"""|<[a-z/][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)""",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s"'>]+))?""")
# Elements that hold no main text, by name, by role and by a part of their class or id.
DROPPED = frozenset("nav header footer aside form head button select option datalist dialog menu svg canvas object embed audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar tablist".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promotion related respond share sharing sidebar social sponsor sponsored subscribe widget".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one of these closes an open one of the second kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WHOLE = frozenset(("html", "body", "main", "article"))
#: Bytes of a page to learn from, at most.
LONGEST = 200_000
WORD, SPACE = "word", re.compile(r"\s+")


def _dropped(name: str, attributes: str) -> bool:
    if name in DROPPED:
        return True
    if not attributes or name in WHOLE:
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and MARKS.intersection(re.split(r"[^a-z0-9]+", value)):
            return True
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def tokens(page: str, drop: bool = True) -> Iterator[tuple[str, str]]:
    """``(tag, "")`` for tags, as ``p`` and ``/p``, and ``("word", text)`` for text, raw. With ``drop``, without
    the elements that are never main text."""
    open_tags: list[str] = []
    skip = -1  # how many elements stay open when the dropped one ends
    at = 0
    for m in _PARTS.finditer(page):
        if m.start() > at and skip < 0:
            yield WORD, page[at : m.start()]
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            if name in open_tags:
                while open_tags.pop() != name:
                    pass
                was, skip = skip, -1 if len(open_tags) <= skip else skip
                if was >= 0:
                    continue
        else:
            # What a new element closes by itself; the closed one must not lie outside the element around.
            closed = CLOSES.get(name) or ({"p"} if name in BLOCKS else ())
            if closed:
                for i in range(len(open_tags) - 1, -1, -1):
                    if open_tags[i] in closed:
                        del open_tags[i:]
                        break
                    if open_tags[i] in BLOCKS and open_tags[i] != "p":
                        break
                if len(open_tags) <= skip:
                    skip = -1
            if name not in VOID and not m["attributes"].endswith("/"):
                if drop and skip < 0 and _dropped(name, m["attributes"]):
                    skip = len(open_tags)
                open_tags.append(name)
        if skip < 0:
            yield (f"/{name}" if m["end"] else name), ""
    if at < len(page) and skip < 0:
        tail = page[at:]
        yield WORD, tail[: tail.index("<")] if re.search(r"<\Z", tail) else tail


def best_region(items: list[tuple[str, str]], weights: dict[str, float]) -> tuple[int, int]:
    """First and one past the last item of the region with the largest sum; the first such region, and without
    words the empty one."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    word, other = weights.get(WORD, 1.0), weights.get("", -1.0)
    for i, (kind, text) in enumerate(items):
        if total <= 0:
            total, start = 0.0, i
        total += word * len(text.split()) if kind == WORD else weights.get(kind, other)
        if total > best + 1e-9:
            best, best_at = total, (start, i + 1)
    return best_at


def learn(pages: list[str], rounds: int = 8, step: float = 0.5, lowest: float = -60.0) -> dict[str, float]:
    """Weights from pages that hold exactly one ``article``: words 1; tags that stand mostly inside -0.05, others from
    -1 on downwards or up to -0.05. Whole pages are used here, with the elements that ``tokens`` can drop. Tags that
    no labelled page has get -0.5."""
    weights: dict[str, float] = {WORD: 1.0, "": -0.5}
    inside: Counter[str] = Counter()
    labelled = []
    for page in pages:
        items = list(tokens(page, drop=False))
        starts = [i for i, x in enumerate(items) if x[0] == "article"]
        if len(starts) == 1:
            end = next((i for i in range(starts[0], len(items)) if items[i][0] == "/article"), len(items))
            labelled.append((items, starts[0] + 1, end))
            for i, (kind, _) in enumerate(items):
                inside[kind] += 1 if starts[0] < i < end else -1
    weights |= {kind: -0.05 if n > 0 else -1.0 for kind, n in inside.items() if kind != WORD}
    for _ in range(rounds):
        wrong = 0
        for items, first, last in labelled:
            a, b = best_region(items, weights)
            # Tags at the edge without words don't matter.
            missed, extra = [*range(first, min(a, last)), *range(max(b, first), last)], [*range(a, min(b, first)), *range(max(a, last), b)]
            for places, sign in (missed, step), (extra, -step):
                if any(items[i][0] == WORD and items[i][1].strip() for i in places):
                    wrong += 1
                    for i in places:
                        if items[i][0] != WORD:
                            kind = items[i][0]
                            weights[kind] = min(-0.05, max(lowest, weights.get(kind, -1.0) + sign))
        if not wrong:
            break
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best region, one per line; empty for a null page or one without text."""
    if not page:
        return ""
    items = list(tokens(page))
    first, last = best_region(items, weights)
    blocks, block = [], []
    for kind, text in items[first:last]:
        if kind == WORD:
            block.append(text)
        elif kind == "br":
            block.append(" ")
        elif kind.lstrip("/") in BLOCKS:
            blocks.append("".join(block))
            block = []
    blocks.append("".join(block))
    clean = (SPACE.sub(" ", html.unescape(b)).strip() for b in blocks)
    return "\n".join(b for b in clean if b)


def fit(pages: DataFrame, sample: int = 300) -> dict[str, float]:
    """Weights learnt from at most ``sample`` labelled pages of at most ``LONGEST`` bytes, drawn by a hash of the id. They
    alone come to the driver: 60 MB at most."""
    labelled = pages.where(F.col("html").contains("<article") & (F.octet_length("html") <= LONGEST)).select("html", F.xxhash64("page_id", "url").alias("place"))
    share = min(1.0, 4 * sample / max(1, labelled.count()))
    drawn = labelled.where(F.pmod("place", F.lit(1 << 20)) < int(share * (1 << 20))).orderBy("place", "html").limit(sample)
    return learn([r.html for r in drawn.select("html").collect()])


def extract(pages: DataFrame, weights: dict[str, float] | None = None, sample: int = 300) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from its whole HTML; one row per input row.

    A null or empty page, and one without main text, gives the empty text. Ids and urls may be null or repeated;
    other columns are ignored. Map-only once the weights are learnt."""
    weights = fit(pages, sample) if weights is None else weights

    def run(ids, urls, pages_):
        texts = [main_text(p, weights) for p in pages_]
        return [ids, urls, texts, list(map(len, texts))]

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_lists(pages, run, f"page_id {kind}, url string, text string, n_chars long", "page_id", "url", "html")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
