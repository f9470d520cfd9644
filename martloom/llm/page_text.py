"""Main text of web pages by line-block distribution.

Markup is stripped into lines: every block element's boundary ends a line, boundaries of containers
leave an empty line, and what lies inside scripts, styles, menus, page headers, footers, sidebars, notices,
adverts, forms or reader comments leaves a gap of empty lines. Over the line lengths the sums of
sliding windows are taken. Where a sum surges above the threshold and stays up, the main text begins;
where it dives to (nearly) nothing, it ends; text between the two is kept.

The threshold is SURGE characters, and lines that are mostly links count as empty. Where the page marks
its article (`article`, `main`, or a container named so), the lines inside and those outside have a
distribution each, and the mark moves its threshold. Inside, links are text and one MARKED-th of SURGE is a
surge, or of the article's densest block if that is less, so short articles stay whole. Outside, a surge
has to reach SURGE and one AROUND-th of the article's densest block.

A null page has an empty text. Character references are decoded, white space inside a line becomes
one space, lines are trimmed and empty ones dropped; nothing else is changed or cut.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW = 3  # lines in a block
SURGE = 60  # characters in a block that start the main text
MARKED = 20  # part of SURGE, or of a shorter article's densest block, that starts it inside
AROUND = 2  # part of the article's densest block that starts it outside of marks, where that is more than SURGE
LINKS = 0.5  # share of link text from which a line outside of marks is a menu

# Element names of the HTML standard
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
LINE_ENDS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = set("article aside body center div dl fieldset footer form header html main nav ol section table ul".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())  # markup inside is plain text
OUTSIDE = set(
    "aside audio button canvas datalist dialog footer form head header iframe map menu nav noembed noframes noscript object script search "
    "select style svg template textarea title video xmp".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
OUTSIDE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())

# Words in class or id that mark parts outside the article; the second list holds beginnings.
OUTSIDE_WORDS = set(
    "ad ads adbox adsense adslot banner colophon copyright dialog disqus footer gdpr header login masthead menu modal nav navbar navigation notice "
    "notices notification overlay pager popup promo promoted promotion promotions register related reply replies respond responses "
    "search share sharing sharebar signin signup skip social teaser teasers toolbar topbar tracking widget widgets".split()
)
OUTSIDE_STARTS = ("advert", "breadcrumb", "comment", "consent", "cookie", "newsletter", "paginat", "recommend", "sidebar", "sponsor", "subscri")
ARTICLE_WORDS = ("article", "articlebody", "content", "entry", "main", "maincontent", "post", "story")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[a-z0-9]+")


@dataclass
class Tag:
    name: str
    start: int
    end: int
    closing: bool
    attributes: str


def _tags(page: str) -> list[Tag]:
    """Tags in page order; comments and declarations have no name, raw elements are one tag to their end."""
    found, at = [], 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            return found
        name = (m[2] or m[5] or "").lower()
        closing = bool(m[1] or m[4])
        at = m.end()
        found.append(Tag(name, m.start(), at, closing, m[3] or m[6] or ""))
        if name in RAW and not closing and not found[-1].attributes.endswith("/"):
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            end, after = (stop.start(), stop.end()) if stop else (len(page), len(page))
            found.append(Tag(name, end, after, True, ""))
            at = after


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(text)}


def _outside(tag: Tag) -> bool:
    """Whether the element lies outside any article by its name, role, class, id or because it is hidden."""
    if tag.name in OUTSIDE:
        return True
    if not tag.attributes or tag.name in ("html", "body", "article", "main") and "comment" not in tag.attributes.lower():
        return False
    found = _attributes(tag.attributes)
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True
    if found.get("role", "").lower() in OUTSIDE_ROLES:
        return True
    words = _WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}".lower())
    return any(w in OUTSIDE_WORDS or w.startswith(OUTSIDE_STARTS) for w in words)


def _named_article(tag: Tag) -> bool:
    if tag.name not in ("div", "section", "td") or not tag.attributes:
        return False
    found = _attributes(tag.attributes)
    if found.get("role") == "main" or found.get("itemprop") == "articleBody":
        return True
    return any(w in ARTICLE_WORDS for w in _WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))


def _closings(tags: list[Tag]) -> list[int | None]:
    """For each opening tag the index of the tag that closes it, counting nested elements of its name."""
    out: list[int | None] = [None] * len(tags)
    open_: dict[str, list[int]] = {}
    for i, tag in enumerate(tags):
        if not tag.name or tag.name in VOID:
            continue
        if not tag.closing:
            open_.setdefault(tag.name, []).append(i)
        elif open_.get(tag.name):
            out[open_[tag.name].pop()] = i
    return out


BORDERS = ("article", "main", "footer", "aside", "nav", "header")


def _regions(tags: list[Tag]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Tag ranges outside the article, and article ranges."""
    closings = _closings(tags)
    starts = [i for i, t in enumerate(tags) if not t.closing and t.name in ("article", "main") and not _outside(t)]
    if not starts:
        starts = [i for i, t in enumerate(tags) if not t.closing and _named_article(t) and not _outside(t) and closings[i] is not None]
    known = set(starts)

    def end_of(i):
        if closings[i] is not None:
            return closings[i]
        # never closed: up to the next part of the page
        for j in range(i + 1, len(tags)):
            if (tags[j].name in BORDERS and not tags[j].closing) or (tags[j].closing and tags[j].name in ("article", "main", "body", "html")):
                return j - 1 if not tags[j].closing else j
        return len(tags) - 1

    outside, i = [], 0
    while i < len(tags):
        tag = tags[i]
        if tag.name and not tag.closing and tag.name not in VOID and i not in known and _outside(tag):
            end = end_of(i)
            # a wrapper around the article is no part of the surroundings
            later = bisect_right(starts, i)
            if later == len(starts) or starts[later] > end or tag.name in RAW:
                outside.append((i, end))
                i = end
        i += 1
    articles = []
    for s in starts:
        end = closings[s]
        if end is None:
            later = [j for j in range(s + 1, len(tags)) if tags[j].name in ("footer", "body", "html") and (tags[j].closing or tags[j].name == "footer")]
            end = later[0] if later else len(tags)
        articles.append((s, end))
    return outside, articles


def lines_of(page: str) -> list[tuple[str, float, bool]]:
    """(text, share of link text, inside an article) of each line; empty lines are gaps."""
    tags = _tags(page)
    outside, articles = _regions(tags)
    inside = [False] * (len(tags) + 1)
    for a, b in articles:
        for k in range(a, min(b, len(tags))):
            inside[k] = True
    skipped = [False] * (len(tags) + 1)
    heading = [False] * (len(tags) + 1)
    for a, b in outside:
        keeps = tags[a].name != "head" and inside[a] and (tags[a].name == "header" or "header" in tags[a].attributes.lower())
        depth = 0
        for k in range(a, min(b, len(tags) - 1) + 1):
            skipped[k] = k < b or b >= len(tags) - 1 and not tags[b].closing
            if keeps and tags[k].name in HEADINGS:
                depth += -1 if tags[k].closing else 1
            heading[k] = keeps and depth > 0
    lines: list[tuple[str, float, bool]] = []
    parts: list[str] = []
    link, total, linked, here = 0, 0, 0, False

    def close(gap: int):
        nonlocal parts, total, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((text, linked / max(total, 1), here))
        lines.extend([("", 0.0, here)] * gap)
        parts, total, linked = [], 0, 0

    at = 0
    for k in range(len(tags) + 1):
        until = tags[k].start if k < len(tags) else len(page)
        if until > at and (k == 0 or not skipped[k - 1] or heading[k - 1]):
            piece = page[at:until]
            here = inside[k - 1] if k else False
            parts.append(piece)
            size = len(piece.strip())
            total += size
            linked += size if link else 0
        if k == len(tags):
            break
        tag, at = tags[k], tags[k].end
        if tag.name == "a":
            link = 0 if tag.closing else 1
        if skipped[k] and not (k and skipped[k - 1]):
            close(WINDOW if tag.name not in RAW else 0) if tag.name not in ("script", "style", "svg", "button") else None
        elif tag.name in LINE_ENDS:
            close(1 if tag.name in CONTAINERS else 0)
    close(0)
    return lines


def _sums(lengths: list[int]) -> list[int]:
    """Block distribution: characters of the windows that start at each line."""
    return [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]


def _kept(lengths: list[int], sums: list[int], surge: int, dive: int) -> list[bool]:
    """Lines with text between a surge and the next dive of the block distribution."""
    n = len(lengths)
    kept, on = [False] * n, False
    for i in range(n):
        if not on and sums[i] >= surge and lengths[i] > 0:
            on = True
        elif on and lengths[i] == 0 and sums[i] <= dive:
            on = False
        kept[i] = on and lengths[i] > 0
    return kept


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = lines_of(page)
    article = [len(text) if here else 0 for text, _, here in lines]
    around = [len(text) if links < LINKS and not here else 0 for text, links, here in lines]
    inside, outside = _sums(article), _sums(around)
    densest = max(inside, default=0)
    low = -(-min(SURGE, densest) // MARKED)
    # an unmarked page shorter than the threshold has its densest block as its surge
    high = max(SURGE, densest // AROUND) if densest else min(SURGE, max(outside, default=1) or 1)
    kept = zip(_kept(article, inside, low, low // 2), _kept(around, outside, high, high // 2))
    return "\n".join(text for (text, _, _), sides in zip(lines, kept) if any(sides))


def extracted(pages: DataFrame, page: str, out: str = "text") -> DataFrame:
    """Add the main text of every page and drop the page's column; a column named `out` is replaced."""
    kept = [c for c in pages.columns if c not in (page, out)]
    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField(out, T.StringType())])

    def step(batches):
        import pyarrow as pa

        for big in batches:
            for at in range(0, big.num_rows, 512):
                batch = big.slice(at, 512)
                texts = [main_text(p.as_py()) for p in batch.column(len(kept))]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string())], names=[*kept, out])

    return pages.select(*kept, page).mapInArrow(step, schema)
