"""Main text of pages: page differencing against the nearest URLs of the host.

A page is cut into text lines, one per block element. Pages are put in order
of (host, path); the pages before and after in that order, if on the same
host, are the nearest ones. The lines are aligned with each neighbour's by
longest common subsequence, and shared lines are deleted: they are the site's,
not the page's.

Differencing alone is wrong in two cases, so a line's place in the page rules
first. Lines in an element that is a menu, header, footer, sidebar, notice,
advert, form, script, style or comment section go, shared or not (a menu may
be the page's own). Lines of an ``article`` or ``main`` stay, shared or not (a
text may be published twice), and whatever the element lies in; only noise
opened inside it goes. All other lines are the diff's to decide.

Blocks are joined by one ``\\n``, white space inside a block is one space and
character references are decoded. NULL and empty pages have no text. A NULL
or odd URL has its own order place and no neighbour but equal hosts. Rows with
equal url and html are one page, so copies do not delete each other's lines.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm._common import global_rank, portions
from stationlake.session import materialize

# Elements by what they do to the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style noscript template textarea title iframe svg math object noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROP = frozenset("nav header footer aside form head dialog menu button select".split()) | RAW
MAIN = frozenset("article main".split())
NOISE = re.compile(
    r"(?<![a-z])(ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|copyright|disqus|footer|gdpr|header|masthead"
    r"|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo\w*|replies|respond"
    r"|related(?![-_](?!articles?|content|items|links?|news|pages|posts?|stories|topics))|share|sharing"
    r"|sidebar|signup|skip|social|sponsor\w*|subscribe|toolbar|widgets?)(?![a-z])"
)
# Noise that no wrapper of the page is: an article in it is a comment, a teaser or an advert.
NEVER_MAIN = frozenset("aside nav footer dialog menu".split())
NEVER_MAIN_WORD = re.compile(r"(?<![a-z])(advert\w*|comments?|disqus|promo\w*|related|replies|respond|sponsor\w*)(?![a-z])")
NEVER_MAIN_ROLES = frozenset("complementary contentinfo navigation dialog".split())
# Classes of articles that are no main part themselves.
NO_ARTICLE = re.compile(r"(?:ads?|advert\w*|comment|promo\w*|related|reply|sponsor\w*|teaser)(?:[-_].*)?")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
ATTR = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)

MAIN_LINE, OPEN_LINE, DROP_LINE = 2, 1, 0


def _values(attrs: str) -> list[tuple[str, str]]:
    return [(name.lower(), value.strip("\"'").lower()) for name, value in ATTR.findall(attrs)]


def _is_noise(tag: str, attrs: str, inside: bool) -> bool:
    # An article's own header (title, by-line) is part of it.
    if tag in DROP and not (tag == "header" and inside):
        return True
    for name, value in _values(attrs):
        if name == "role":
            if value in ROLES:
                return True
        elif tag == "article":
            if name == "class" and any(NO_ARTICLE.fullmatch(c) for c in value.split()):
                return True
        elif tag not in ("main", "body", "html") and NOISE.search(value):
            return True
    return False


def _holds_no_main(tag: str, attrs: str) -> bool:
    """Whether what this noise holds is never the main part (a form or an odd wrapper may hold the page)."""
    return tag in NEVER_MAIN or any(
        value in NEVER_MAIN_ROLES if name == "role" else NEVER_MAIN_WORD.search(value) for name, value in _values(attrs)
    )


def page_lines(page: str | None) -> list[tuple[int, str]]:
    """(place, text) of every line: in the main part, in boilerplate, or open."""
    page = page or ""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int, int, int]] = []  # element, depths in noise, in main and in noise that never holds it
    noise = main = never = 0
    ended = False  # a main part has ended

    def flush() -> None:
        line = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if line:
            out.append((DROP_LINE if noise else MAIN_LINE if main else OPEN_LINE, line))

    at = 0
    while m := TOKEN.search(page, at):
        text.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        closing, tag = m[1], m[2].lower()
        if tag == "br":
            text.append(" ")
        if tag in BLOCKS or tag in RAW:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    ended = ended or (main > 0 and not noise and not stack[k][2])
                    _, noise, main, never = stack[k]
                    del stack[k:]
                    break
                if stack[k][0] in MAIN and tag not in ("body", "html"):
                    break  # a stray end tag does not close the article
        elif tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag == "body":  # what came before is over, closed or not
            stack, noise, main, never = [(tag, 0, 0, 0)], int(_is_noise(tag, m[3], False)), 0, 0
        elif tag not in VOID and not m[3].endswith("/"):
            if tag == "p":  # a paragraph ends where the next one starts
                while stack and stack[-1][0] == "p":
                    _, noise, main, never = stack.pop()
            stack.append((tag, noise, main, never))
            own = _is_noise(tag, m[3], main > 0)
            # What lies around the main part is not noise in it; an article in a comment list, a
            # sidebar or the like, or in noise that follows the main part, is none.
            if tag in MAIN and not main and not own and not never and not (noise and ended):
                noise = 0
            noise += own
            never += own and tag not in MAIN and _holds_no_main(tag, m[3])
            main += tag in MAIN and not own
    tail = page[at:]
    cut = tail.find("<")
    # A tag that the page breaks off in is markup, not text.
    text.append(tail[:cut] if cut >= 0 and re.match(r"</?[a-zA-Z!]", tail[cut:]) else tail)
    flush()
    return out


def _suffix_row(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of ``x`` with every suffix of ``y``."""
    row = np.zeros(len(y) + 1, np.int32)
    for v in x[::-1]:
        # By prefix maxima from the right: equal heads extend the diagonal.
        best = np.maximum(row[:-1], np.where(y == v, row[1:] + 1, 0))
        row[:-1] = np.maximum.accumulate(best[::-1])[::-1]
    return row


def _common(x: np.ndarray, y: np.ndarray, at: int, out: np.ndarray) -> None:
    """Mark in ``out`` (from ``at`` on) the elements of ``x`` in a longest common
    subsequence with ``y``. Equal ends align; the rest is halved (in ``x``, with
    the cut in ``y`` that keeps the length), so memory is one row."""
    while len(x) and len(y) and x[0] == y[0]:
        out[at] = True
        x, y, at = x[1:], y[1:], at + 1
    while len(x) and len(y) and x[-1] == y[-1]:
        out[at + len(x) - 1] = True
        x, y = x[:-1], y[:-1]
    if not len(x) or not len(y):
        return
    if len(x) == 1:
        out[at] = bool((y == x[0]).any())
        return
    half = len(x) // 2
    head = _suffix_row(x[:half][::-1], y[::-1])[::-1]
    cut = int(np.argmax(head + _suffix_row(x[half:], y)))
    _common(x[:half], y[:cut], at, out)
    _common(x[half:], y[cut:], at + half, out)


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of ``a`` a longest common subsequence with ``b`` has."""
    shared = np.zeros(len(a), bool)
    # Lines that only one page has are in no alignment.
    ia, jb = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    if len(ia):
        found = np.zeros(len(ia), bool)
        _common(a[ia], b[jb], 0, found)
        shared[ia] = found
    return shared


def page_key() -> Column:
    """Names a page by its url and html; rows that agree in both are one page of the order."""
    return F.unhex(F.md5(F.concat_ws("\n", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))))


def line_hashes(pages: DataFrame) -> DataFrame:
    """key, host, path, places, hashes: the lines of every page as a byte and eight bytes each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (part.copy() for batch in batches for part in portions(batch, 128)):
            cut = [page_lines(x) for x in b.pop("html")]
            b["places"] = [bytes(p for p, _ in c) for c in cut]
            b["hashes"] = [np.array([xxhash.xxh64_intdigest(t) for _, t in c], np.uint64).tobytes() for c in cut]
            yield b

    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(url, r"^[^/?#]*", 0))
    path = F.regexp_extract(url, r"^[^/?#]*([^?#]*)", 1)
    rows = pages.select(page_key().alias("key"), host.alias("host"), path.alias("path"), "html")
    return rows.mapInPandas(run, "key binary, host string, path string, places binary, hashes binary")


def shared_lines(pages: DataFrame) -> DataFrame:
    """key, gone: the open lines (their places from 0) that a page shares with a nearest one.

    Every page is aligned with the next one of its host, once for both. A hot
    host is many partitions of one range sort.
    """
    distinct = line_hashes(pages).dropDuplicates(["key"])
    ranked, _ = global_rank(distinct, ["host", "path", "key"], "page-order")
    lines = ("key", "places", "hashes")
    first = ranked.select("host", "rank", *[F.col(c).alias(f"{c}_1") for c in lines])
    second = ranked.select("host", (F.col("rank") - 1).alias("rank"), *[F.col(c).alias(f"{c}_2") for c in lines])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, gone = [], []
            for one, two in zip(b[[f"{c}_1" for c in lines]].values, b[[f"{c}_2" for c in lines]].values):
                for (key, places, own), (_, _, other) in ((one, two), (two, one)):
                    place = np.frombuffer(places, np.uint8)
                    # What the article holds stays and need not be aligned.
                    free = np.flatnonzero(place != MAIN_LINE)
                    same = free[common_lines(np.frombuffer(own, np.uint64)[free], np.frombuffer(other, np.uint64))]
                    same = same[place[same] == OPEN_LINE]
                    if len(same):
                        keys.append(key)
                        gone.append(same.tolist())
            yield pd.DataFrame({"key": keys, "gone": gone}, dtype=object)

    pairs = first.join(second, ["host", "rank"]).drop("host", "rank")
    found = pairs.mapInPandas(run, "key binary, gone array<int>")
    return found.groupBy("key").agg(F.flatten(F.collect_list("gone")).alias("gone"))  # two neighbours at most


def extract(pages: DataFrame) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``.

    The pages are cut twice: once for the hashes of their lines, and once,
    beside the lines to delete, for the text. So no text is shuffled for the
    order. The lines to delete are written first; Spark broadcasts them if the
    files are below its own threshold and shuffles both sides otherwise.
    """
    gone = materialize(shared_lines(pages), "shared-lines")
    rows = pages.select(F.col("page_id").cast("string"), "url", "html", page_key().alias("key"))  # NULLs keep ids exact
    joined = rows.join(gone, "key", "left").select("page_id", "url", "html", "gone")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (part for batch in batches for part in portions(batch, 128)):
            texts = []
            for page, gone in zip(b["html"], b["gone"]):
                shared = frozenset(gone if gone is not None else ())
                kept = (t for k, (p, t) in enumerate(page_lines(page)) if p == MAIN_LINE or (p == OPEN_LINE and k not in shared))
                texts.append("\n".join(kept))
            out = b[["page_id", "url"]].copy()
            out["text"], out["n_chars"] = texts, [len(t) for t in texts]
            yield out

    out = joined.mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return out.withColumn("page_id", F.col("page_id").cast("long"))
