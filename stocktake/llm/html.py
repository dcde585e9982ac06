"""Main text of web pages by the distribution of their line blocks.

Markup is stripped into lines, one for each block element. Menus, headers, footers, sidebars, notices, adverts, forms and
reader comments become empty lines, and so do lines that are mostly links. The header of an article element, with its title, stays. What an element's class, id or role only marks as such stays
if the element holds most of the page's unlinked text; reader comments beside text that surges and a single line beside an article's
own text do not. The text lengths of WINDOW lines in a row are summed;
text surges where the sum passes SURGE and dives where it falls to nothing. What lies between, from the first
to the last line of the run, is kept. If nothing surges, the run with most text is kept. All lines take part, with or without an
article or main element; a line inside one weighs up to SURGE more, in full if the element holds half of the page's unlinked text or more, else
by its share: a teaser or a comment in an article element of its own gains little.

Defined results: a null or empty page, or one without text, gives an empty string; ties between runs go to the first; an element that is
never closed hides nothing; repeated rows are extracted one by one; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stocktake.llm.common import bounded_batches, table

WINDOW, SURGE = 3, 80

#: Raw elements with all they hold, comments and declarations, or one tag with its attributes. Quotes count after an equals sign only and may
#: hold anything of any length; a tag that is never closed is text.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|math|iframe|title)\b[^>]*+>.*?(?:</\1\s*+>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("nav header footer aside form menu dialog button select fieldset head".split())
#: Elements that are hidden as such outside of an article only: inside they hold its title or its notes.
PAGE_PARTS = frozenset(["header", "footer"])
#: Lines, not containers of lines.
LINES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption td th tr caption summary address".split())
#: Words that mark what is not the article, as a name in class, id or role or as the first or last part of one ...
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs complementary contentinfo cookie cookies consent "
    "footer form menu modal nav navbar navigation newsletter notice popup promo promos promoted promotion related search share sharing sidebar "
    "social sponsor sponsored sponsors subscribe toolbar widget".split()
)
#: ... as the first part only, or the last behind one of these: the header of an entry holds its title ...
LEADING, SITE = frozenset(["header"]), frozenset(["site", "global", "top", "web"])
#: ... and as any part: reader comments, which may well be longer than the article.
THREAD = frozenset("comment comments commentlist commentform disqus respond replies".split())
#: "with-sidebar" and "no-comments" mark nothing.
WRAPPERS = frozenset(["with", "no", "has", "without", "non", "not", "hide", "show", "is"])
PARTS = re.compile(r"[-_:]+")
#: Whether attributes are worth a closer look.
TELLING = re.compile(r"class|id|role|hidden|style", re.I)


def _parts(name: str) -> list[str]:
    parts = [p for p in PARTS.split(name.lower()) if p]
    while len(parts) > 1 and parts[-1].isdigit():
        parts.pop()
    # What a wrapper speaks of is not what it is.
    for k, p in enumerate(parts):
        if p in WRAPPERS:
            return parts[:k]
    return parts


def _marks(name: str) -> bool:
    parts = _parts(name)
    if not parts:
        return False
    ends = parts[-1] in MARKS or parts[-1] in LEADING and parts[0] in SITE
    return parts[0] in MARKS or parts[0] in LEADING or ends or _is_thread(name)


def _is_thread(name: str) -> bool:
    return not THREAD.isdisjoint(_parts(name))


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _names(attributes: dict[str, str]) -> list[str]:
    return [n for key in ("class", "id", "role") for n in attributes.get(key, "").split()]


def _concealed(attributes: dict[str, str]) -> bool:
    style = "".join(attributes.get("style", "").lower().split())
    return "hidden" in attributes or "hidden" in _names(attributes) or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style


def _unlinked(text: str, links: int) -> int:
    return 0 if 2 * links > len(text) else len(text)


def _closing(tags: list[tuple[int, int, bool, str, str]]) -> dict[int, int]:
    """For each opening tag the number of its closing tag, by name; tags that are never closed are missing."""
    open_by_name: dict[str, list[int]] = {}
    found = {}
    for k, (_, _, closes, name, _) in enumerate(tags):
        if closes:
            if stack := open_by_name.get(name):
                found[stack.pop()] = k
        elif name not in VOID:
            open_by_name.setdefault(name, []).append(k)
    return found


def lines_of(page: str) -> list[tuple[str, int, float]]:
    """(text, length of its links, share of the page's unlinked text that its article or main element holds, 0 outside of one) of every
    block. What is hidden leaves WINDOW empty lines, one less if it stands alone between lines of one container, which it does not part."""
    tags, pieces, at = [], [], 0
    for m in TOKEN.finditer(page):
        pieces.append(page[at : m.start()])
        at = m.end()
        tags.append((m.start(), m.end(), bool(m[2]), (m[3] or "").lower(), m[4] or ""))
    pieces.append(page[at:])
    closing = _closing(tags)
    hides, marked, threads = set(), set(), set()
    article_ends: list[int] = []
    for k in sorted(closing):
        _, _, _, name, text = tags[k]
        while article_ends and article_ends[-1] < k:
            article_ends.pop()
        if name in ("article", "main"):
            article_ends.append(closing[k])
        if name in HIDDEN and not (name in PAGE_PARTS and article_ends):
            hides.add(k)
        elif text and name not in ("html", "body") and TELLING.search(text):
            attributes = _attributes(text)
            names = _names(attributes)
            if _concealed(attributes):
                hides.add(k)
            elif any(map(_marks, names)):
                marked.add(k)
                if any(map(_is_thread, names)):
                    threads.add(k)
    if marked:
        titles = [k for k, tag in enumerate(tags) if not tag[2] and tag[3] in ("h1", "main")]
        # A page's title does not stand among its comments.
        threads = {k for k in threads if bisect_right(titles, closing[k]) == bisect_right(titles, k)}
        hides |= marked - _spared(pieces, tags, closing, hides, marked, threads)
    return _with_gaps(_walk(pieces, tags, closing, hides))


def _with_gaps(lines: list[tuple[str, int, float, int, int]]) -> list[tuple[str, int, float]]:
    out: list[tuple[str, int, float]] = []
    hidden, before = 0, None
    for text, links, share, _, container in lines:
        if not text:
            hidden += 1
            continue
        if hidden:
            together = hidden == 1 and container == before
            out.extend([("", 0, 0.0)] * (WINDOW - 1 if together else WINDOW * hidden))
        out.append((text, links, share))
        hidden, before = 0, container
    return out


def _spared(pieces: list[str], tags: list[tuple], closing: dict[int, int], hides: set[int], marked: set[int], threads: set[int]) -> set[int]:
    """Marked elements that stay: they hold most of the page's unlinked text. Not so reader comments beside text that surges, and
    a single line beside an article's own text."""
    lines = _walk(pieces, tags, closing, hides, marked | {closing[k] for k in marked})
    ends = [at for _, _, _, at, _ in lines]
    size = [_unlinked(text, links) for text, links, _, _, _ in lines]
    held, full = [0, *accumulate(size)], [0, *accumulate(n > 0 for n in size)]
    own = [0, *accumulate(n if share else 0 for n, (_, _, share, _, _) in zip(size, lines))]
    out = set()
    for k in marked:
        begin, end = bisect_right(ends, k), bisect_right(ends, closing[k])
        inside = held[end] - held[begin]
        thread = held[-1] - inside > SURGE and k in threads
        beside = full[end] - full[begin] < 2 and own[-1] > own[end] - own[begin]
        if 2 * inside > held[-1] and not thread and not beside:
            out.add(k)
    return out


def _walk(
    pieces: list[str], tags: list[tuple], closing: dict[int, int], hides: set[int], edges: set[int] | frozenset[int] = frozenset()
) -> list[tuple[str, int, float, int, int]]:
    """(text, length of its links, share as in lines_of, number of the tag it ends at, number of its container's tag) of every line; what the tags
    `hides` open is hidden and leaves one empty line, and tags in `edges` end a line."""
    out: list[tuple[str, int, int, int, int]] = []
    words: list[str] = []
    links, in_link, hidden_until = 0, 0, -1
    articles: list[list[int]] = [[0, 0]]  # first line and line after the last; number 0 stands for none
    within: list[tuple[int, int]] = []  # closing tag and number of the articles around this place
    containers: list[tuple[int, int]] = [(len(tags), -1)]  # closing and opening tag of the containers around this place

    def flush(k: int) -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            out.append((text, links, within[-1][1] if within else 0, k, containers[-1][1]))
        words.clear()
        links = 0

    for k, piece in enumerate(pieces):
        if k > hidden_until and piece:
            words.append(piece)
            if in_link:
                links += len(piece)
        if k == len(tags) or k < hidden_until:
            continue
        _, _, closes, name, _ = tags[k]
        if k == hidden_until or not name:
            continue
        if name in INLINE and k not in hides:
            if k in edges:
                flush(k)
            if name == "a":
                in_link = max(0, in_link + (-1 if closes else k in closing))
            elif name == "br":
                words.append(" ")
            continue
        flush(k)
        while within and within[-1][0] <= k:
            articles[within.pop()[1]][1] = len(out)
        while containers[-1][0] <= k:
            containers.pop()
        if closes or k not in closing:
            continue
        if k in hides:
            hidden_until = closing[k]
            out.append(("", 0, 0, k, -1))
            continue
        if name in ("article", "main"):
            within.append((closing[k], len(articles)))
            articles.append([len(out), len(out)])
        if name not in LINES:
            containers.append((closing[k], k))
    flush(len(tags))
    for _, number in within:
        articles[number][1] = len(out)
    held = [0, *accumulate(_unlinked(text, n) for text, n, _, _, _ in out)]
    share = [(held[end] - held[begin]) / held[-1] if held[-1] else 1.0 for begin, end in articles]
    return [(text, n, share[a] if a else 0.0, at, container) for text, n, a, at, container in out]


def main_text(page: str | None) -> str:
    lines = lines_of(page or "")
    size = [_unlinked(text, links) + (round(SURGE * min(1.0, 2 * share)) if text else 0) for text, links, share in lines]
    n = len(size)
    block = [sum(size[k : k + WINDOW]) for k in range(n)]
    kept, runs, k = [], [], 0
    while k < n:
        if not size[k]:
            k += 1
            continue
        end = k
        while end < n and block[end]:  # up to where the text dives: WINDOW empty lines
            end += 1
        runs.append((k, end))
        k = end
    surging = [r for r in runs if max(block[r[0] : r[1]]) > SURGE]
    if not surging and runs:
        surging = [max(runs, key=lambda r: (sum(size[r[0] : r[1]]), -r[0]))]
    for begin, end in surging:
        kept += [lines[k][0] for k in range(begin, end) if size[k]]
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names
            )

    names = ["page_id", "url", "text", "n_chars"]
    kinds = dict(pages.dtypes)
    bounded_batches(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
