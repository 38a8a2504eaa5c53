"""Main text of web pages by markup regions and repeated runs within a host (operator 2).

A tolerant scanner cuts a page into blocks and knows the elements that are open around each. What a page
marks (article, main or their roles) is main text, without the menus, forms, adverts, comments and the like
inside. All text without a mark, on pages with and without marked parts, is told by the page's host: the
token streams of all blocks outside of marked parts are read as one text per host, and runs of at least
MIN_RUN tokens that occur on several pages of the host (the common prefixes of its suffix array at that
depth) are boilerplate; beside a marked part, shorter blocks that the host repeats are too. Covered tokens go,
the unique runs stay, in page order with the marked parts.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partition_id, read_table
from .url_filter import host_of

#: Tokens of a run that is long enough to be boilerplate.
MIN_RUN = 8

#: HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object textarea xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
BOILER = frozenset("head title nav footer aside form menu dialog select button search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id attributes that name boilerplate.
NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices"
    " newsletter subscribe subscription signup login sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead"
    " share sharing social related recommended popup modal overlay pagination pager widget widgets copyright toolbar skip".split()
)
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
#: An open paragraph ends where one of these begins.
ENDS_P = BLOCK - frozenset("head title body html option optgroup".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

ARTICLE, MAIN, OPEN, BOILERPLATE = "article", "main", "open", "boilerplate"


def _region(name: str, attributes: str, around: str, in_comments: bool) -> tuple[str, bool]:
    """Region inside an element, and whether it holds reader comments."""
    values = {}
    if attributes.strip():
        for m in _ATTRIBUTE.finditer(attributes):
            values.setdefault(m[1].lower(), m[2] if m[2] is not None else m[3] if m[3] is not None else m[4])
    names = {w.lower() for key in ("class", "id") for w in _WORD.findall(values.get(key, ""))}
    role = values.get("role", "").lower()
    if in_comments or names & COMMENTS and name not in ("html", "body"):
        return BOILERPLATE, True
    if name in BOILER or role in ROLES or name == "header" and around == OPEN:
        return BOILERPLATE, False
    if name == "article" or role == "article" or values.get("itemprop", "").lower() == "articlebody":
        return ARTICLE, False
    if name == "main" or role == "main":
        return (MAIN if around == OPEN else around), False
    if names & NAMES and name not in ("html", "body") and not name[1:].isdigit():
        return BOILERPLATE, False
    return around, False


def blocks(page: str) -> list[tuple[str, str]]:
    """(region, text) of the page's blocks in order; references decoded, white space single, no empty blocks."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str, bool, bool]] = []  # name, region, comments, fixed by a tag
    region, in_comments, part = OPEN, False, []

    def close_block():
        if part:
            text = " ".join("".join(part).split())
            if text:
                out.append((region, text))
            part.clear()

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        piece = m.group()
        if piece[0] != "<" or piece == "<":
            part.append(entities.unescape(piece))
            continue
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = bool(m[1] or m[4])
        if name in RAW:
            if not closing and not piece.endswith("/>"):
                end = re.compile(r"</" + re.escape(name) + r"(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if name == "br":
            part.append(" ")
            continue
        if name in BLOCK:
            close_block()
        if name in VOID:
            continue
        if closing:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None:
                close_block() if stack[depth][1] != region else None
                del stack[depth:]
                region, in_comments = (stack[-1][1], stack[-1][2]) if stack else (OPEN, False)
                if depth == 0:
                    region, in_comments = OPEN, False
        else:
            if name in ENDS_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        region, in_comments = (stack[-1][1], stack[-1][2]) if stack else (OPEN, False)
                        break
                    if stack[k][0] in BLOCK:
                        break
            attributes = m[3] if m[2] else m[6]
            fixed = name in BOILER or stack[-1][3] if stack else name in BOILER
            inner, comments = _region(name, attributes or "", region, in_comments)
            # A layout's class around an article doesn't make it boilerplate; a nav, a form or comments do.
            if region == BOILERPLATE and not (inner == ARTICLE and not fixed and not comments):
                inner = BOILERPLATE
            if inner != region:
                close_block()
            stack.append((name, inner, comments, fixed))
            region, in_comments = inner, comments
    close_block()
    return out


def split_page(page: str) -> tuple[str | None, list[str], list[str], list[int]]:
    """(text that the page marks or None, unmarked blocks, blocks that are evidence for the host, marked blocks before each unmarked one)."""
    marked, unmarked, evidence, before = [], [], [], []
    for region, text in blocks(page):
        if region in (ARTICLE, MAIN):
            marked.append(text)
            continue
        evidence.append(text)
        if region == OPEN:
            unmarked.append(text)
            before.append(len(marked))
    return "\n".join(marked) if marked else None, unmarked, evidence, before


def runs(stream: list[str], size: int = MIN_RUN) -> np.ndarray:
    """64-bit keys of all runs of ``size`` tokens, by place."""
    import xxhash

    n = len(stream) - size + 1
    if n < 1:
        return np.zeros(0, np.int64)
    return np.array([xxhash.xxh3_64_intdigest("\0".join(stream[i:i + size])) for i in range(n)], np.uint64).astype(np.int64)


def short_blocks(found: list[str], size: int = MIN_RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, lengths, 64-bit keys) of the blocks that have fewer than ``size`` tokens."""
    import xxhash

    words = [block.split() for block in found]
    starts = np.cumsum([0, *map(len, words)])
    short = [(at, len(w), xxhash.xxh3_64_intdigest("\0".join(w))) for at, w in zip(starts, words) if len(w) < size]
    places, lengths, keys = zip(*short) if short else ((), (), ())
    return np.array(places, np.int64), np.array(lengths, np.int64), np.array(keys, np.uint64).astype(np.int64)


def _streams(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id"), F.col("url"), host_of(F.col("url").cast("string")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def host_runs(rows: DataFrame, size: int) -> DataFrame:
    """host, run: runs of tokens, and whole shorter blocks, outside of marked parts that occur on more than one page of their host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys = [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                evidence = split_page(page.as_py())[2]
                k = np.unique(np.concatenate([runs(" ".join(evidence).split(), size), short_blocks(evidence, size)[2]]))
                hosts += [host] * len(k)
                keys.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(np.concatenate([*keys, np.zeros(0, np.int64)]))], names=["host", "run"])

    grams = rows.select("host", "html").mapInArrow(run, "host string, run long")
    return grams.groupBy("host", "run").agg(F.count("*").alias("n")).where("n > 1").select("host", "run")


def without_covered(found: list[str], covers: list[tuple[int, int]]) -> list[str]:
    """What is left of each block without the tokens that the runs (place, length) cover; empty if nothing is."""
    covered, at, out = set(), 0, []
    for place, length in covers:
        covered.update(range(place, place + length))
    for block in found:
        words = block.split()
        out.append(" ".join(w for k, w in enumerate(words, at) if k not in covered))
        at += len(words)
    return out


def in_page_order(marked: str | None, left: list[str], before: list[int]) -> str:
    """Marked blocks and what is left of the unmarked ones, each after as many marked blocks as it had ``before`` it."""
    out, parts, done = [], marked.split("\n") if marked is not None else [], 0
    for text, n in zip(left, before):
        out += parts[done:n]
        done = n
        if text:
            out.append(text)
    return "\n".join(out + parts[done:])


def main_text(pages: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """page_id, url, text, n_chars: one row per input row.

    Null and empty pages, and pages without any text outside of boilerplate, have an empty text. Unmarked text
    beside a marked part stays unless the host repeats it; a page without a mark whose blocks all occur
    elsewhere is a copy, not a template, and keeps them. Urls without a host
    share one. Repeated rows are pages of their own; an empty table gives an empty result; columns other than
    page_id, url and html are not read.
    """
    rows = _streams(pages)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = partition_id() << 33
        for batch in batches:
            parts = [split_page(p.as_py()) for p in batch.column(3)]
            # A page without unmarked blocks beside its marked parts has no ``found`` and is done.
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2), pa.array(np.arange(key, key + len(parts))), pa.array([p[0] for p in parts], pa.string()),
                    pa.array([p[1] if p[0] is None or p[1] else None for p in parts], pa.list_(pa.string())), pa.array([p[3] for p in parts], pa.list_(pa.int32())),
                ],
                names=["page_id", "url", "host", "key", "text", "found", "before"],
            )
            key += len(parts)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    split = rows.mapInArrow(marked, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, key long, text string, found array<string>, before array<int>")
    done = split.where("found is null").select("page_id", "url", "text")

    # Pages with unmarked text, with the runs that their host repeats.
    from .common import materialize

    rest = materialize(split.where("found is not null"), "op2-unmarked")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, key, found, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
                k = runs(" ".join(found).split(), min_run)
                place, length = np.arange(len(k)), np.full(len(k), min_run)
                if text is not None:
                    short = short_blocks(found, min_run)
                    place, length, k = (np.concatenate(p) for p in zip((place, length, k), short))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * len(k), pa.string()), pa.array(np.full(len(k), key, np.int64)), pa.array(place), pa.array(length), pa.array(k)],
                    names=["host", "key", "place", "length", "run"],
                )

    places = rest.select("host", "key", "found", "text").mapInArrow(placed, "host string, key long, place long, length long, run long")
    known = places.join(host_runs(rows, min_run), ["host", "run"]).groupBy("key").agg(
        F.collect_list("place").alias("places"), F.collect_list("length").alias("lengths"),
    )

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found, before, places, lengths in zip(*(batch.column(c).to_pylist() for c in range(2, 7))):
                left = without_covered(found, list(zip(places or [], lengths or [])))
                out.append(in_page_order(text, left if text is not None or any(left) else found, before))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    told = rest.join(known, "key", "left").select("page_id", "url", "text", "found", "before", "places", "lengths").mapInArrow(
        strip, f"page_id {kinds['page_id']}, url {kinds['url']}, text string",
    )
    return done.unionByName(told).withColumn("n_chars", F.char_length("text").cast("long"))


def op2_html_extract(spark, sf_dir):
    return main_text(read_table(spark, sf_dir, "pages"))
