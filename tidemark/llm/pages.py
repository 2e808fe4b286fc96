"""Main text of web pages: structure where a page has it, host suffix arrays where it has not.

Pages are cut into blocks. Blocks in menus, footers, adverts and the like never count. A page that
marks its article keeps the blocks in it. In every other page it shows by repetition what is not
the article: the token streams of a host's pages are concatenated and sorted as a suffix array to
a fixed depth, neighbours that agree to that depth and stem from distinct pages are repeated, and
only the runs of tokens that no repeated substring covers are kept. Marked articles go through
suffix arrays of their own: whole blocks that substrings of many distinct articles cover go too.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import lean, objects, release, stored
from tidemark.llm.url_lists import host_of

DEPTH = 8  # tokens of the shortest repeated substring; a power of two
MANY = 5  # distinct articles of a host that share a notice
MOST = 4  # times the words elsewhere that a marked part needs to be heard against its class names
BLOCK_TOKENS = 2_000_000  # tokens in one suffix array; larger hosts get several, then merged
PART = 256  # pages that are cut into blocks before their rows go on

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|object|select|button)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?/][^>]*>|[^<]+|<",
    re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q "
             "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSED_BY_LISTS = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body"}
CHROME = set("head nav footer aside form menu dialog fieldset".split())
STRONG = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
             "nav navbar navigation menu breadcrumb breadcrumbs footer cookie cookies consent gdpr "
             "comment comments disqus sidebar newsletter subscribe popup modal login signup".split())
WEAK = set("header masthead banner widget related recommended recommendations share sharing social "
           "notice notification alert overlay reply replies respond search pagination pager "
           "toolbar tags copyright disclaimer".split())
BODY = set("article content entry post story main body text".split())
WRAPPERS = {"has", "with", "no", "is"}
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu "
            "menubar note status form".split())
NEUTRAL, MAIN, ARTICLE, OUT = 0, 1, 2, -1  # MAIN | ARTICLE: an article in the main part


def zone_of(tag: str, attributes: str, outer: int, by_name: bool = True) -> int:
    """What an element's text is: OUT, in the article, in the main part, or not yet known.

    Unless `by_name` no class or id can say OUT.
    """
    if outer == OUT or tag in CHROME:
        return OUT
    zone = {"article": outer | ARTICLE, "main": max(outer, MAIN)}.get(tag, outer)
    if tag == "header" and outer < ARTICLE:
        return OUT
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return zone
    given = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attributes)}
    role = given.get("role", "").lower()
    style = given.get("style", "").replace(" ", "").lower()
    if role in ROLES or given.get("aria-hidden") == "true" or "display:none" in style \
            or re.search(r"(?:^|\s)hidden(?:\s|=|$|/)", attributes):
        return OUT
    if role in ("main", "article"):
        zone = max(zone, MAIN) if role == "main" else zone | ARTICLE
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or words[0] in WRAPPERS or tag in ("html", "body"):
            continue
        if STRONG.intersection(words) or WEAK.intersection(words) and not BODY.intersection(words):
            if by_name:
                return OUT
            continue
        if words[-1] in BODY and len(words) <= 2 and set(words) <= BODY:
            zone = zone | ARTICLE if words[0] in ("article", "entry", "post", "story") else max(zone, MAIN)
    if given.get("itemprop", "").lower() == "articlebody":
        zone |= ARTICLE
    return zone


def blocks_of(html: str | None) -> list[tuple[int, str, int]]:
    """(zone, text, article) of every block with text, in page order, character references decoded.

    `article` numbers the outermost article that the block stands in, 0 if it stands in none.
    Names of classes do not decide alone that a page has no text: where they leave no marked part,
    and without them a marked part holds most of the page's words, they are not heard.
    """
    blocks = cut_blocks(html, True)
    if blocks and not any(chosen(blocks)):
        left = sum(len(t.split()) for z, t, _ in blocks if z != OUT)
        if left * MOST < sum(len(t.split()) for z, t, _ in blocks if z == OUT):
            again = cut_blocks(html, False)
            marked = sum(len(t.split()) for (_, t, _), own in zip(again, chosen(again)) if own)
            if left * MOST < marked:
                return again
    return blocks


def cut_blocks(html: str | None, by_name: bool) -> list[tuple[int, str, int]]:
    """`blocks_of` with or without regard to what class names say against a block."""
    out: list[tuple[int, str, int]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int, int]] = [("", NEUTRAL, 0)]
    articles = 0

    def push(tag: str, zone: int):
        nonlocal articles
        number = stack[-1][2]
        if zone >= ARTICLE and not number:
            number = articles = articles + 1
        stack.append((tag, zone, number))

    def flush():
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((stack[-1][1], text, stack[-1][2]))
            pieces.clear()

    for m in TOKEN.finditer(html or ""):
        tag = m[3]
        if tag is None:
            whole = m[0]
            if whole == "<" or whole[0] != "<":
                pieces.append(markup.unescape(whole) if "&" in whole else whole)
            continue
        tag = tag.lower()
        if m[2]:
            if tag in ("br", "p") and not any(t == tag for t, *_ in stack):
                pieces.append(" ")
                continue
            places = [k for k, (t, *_) in enumerate(stack) if t == tag]
            if tag not in INLINE:
                flush()
            elif places and stack[places[-1]][1] != stack[places[-1] - 1][1]:
                flush()
            if places:
                del stack[places[-1]:]
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag != "wbr":
                pieces.append(" ")
            continue
        if tag in INLINE:
            zone = zone_of(tag, m[4], stack[-1][1], by_name)
            if zone != stack[-1][1]:
                flush()
                push(tag, zone)
            continue
        flush()
        if tag == "body":  # also where the head was never closed
            del stack[1:]
        ends = IMPLIED.get(tag, {"p"})
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in ends:
                del stack[k:]
                break
            if stack[k][0] in CLOSED_BY_LISTS:
                break
        if not m[4].endswith("/"):
            push(tag, zone_of(tag, m[4], stack[-1][1], by_name))
    flush()
    return out


def chosen(blocks: list[tuple[int, str, int]]) -> list[bool]:
    """Which blocks are the marked article; none if the page marks none.

    The main part goes before its articles if more words of it stand outside them than in the
    longest one: then they are cards, teasers or quotes. Otherwise the articles are the text.
    """
    words = [len(t.split()) for _, t, _ in blocks]
    longest: dict[int, int] = {}
    for (z, _, article), n in zip(blocks, words):
        if z >= ARTICLE:
            longest[article] = longest.get(article, 0) + n
    outside = sum(n for (z, _, _), n in zip(blocks, words) if z == MAIN)
    if outside > max(longest.values(), default=0):
        return [z > NEUTRAL and bool(z & MAIN) for z, _, _ in blocks]
    return [z >= ARTICLE for z, _, _ in blocks]


def article_blocks(blocks: list[tuple[int, str, int]]) -> list[str]:
    return [t for (_, t, _), own in zip(blocks, chosen(blocks)) if own]


def article_of(blocks: list[tuple[int, str, int]]) -> str | None:
    """The marked article's text; None if the page marks none."""
    kept = article_blocks(blocks)
    return " ".join(kept) if kept else None


def without_notices(texts: list[str], starts: np.ndarray) -> list[str]:
    """An article's blocks without those that repeated substrings cover whole.

    Where such blocks hold more than half of its words, the article is a near copy of others, and
    all of it is kept.
    """
    sizes = np.array([len(t.split()) for t in texts], np.int64)
    covered = np.zeros(sizes.sum() + DEPTH, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + DEPTH, -1)
    covered = np.cumsum(covered)[:sizes.sum()] > 0
    before = np.concatenate([[0], np.cumsum(covered)])
    ends = np.cumsum(sizes)
    keep = before[ends] - before[ends - sizes] < sizes
    return [t for t, k in zip(texts, keep) if k] if sizes[keep].sum() * 2 >= sizes.sum() else texts


def stream_of(blocks: list[tuple[int, str, int]]) -> list[tuple[int, str]]:
    """(zone, word) of everything outside a marked article."""
    return [(z, w) for (z, t, _), own in zip(blocks, chosen(blocks)) if not own for w in t.split()]


def hashed(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) for w in words),
                       np.uint64, len(words))


def windows(tokens: np.ndarray) -> np.ndarray:
    """A key for the DEPTH tokens from each position on, by prefix doubling."""
    keys, step = tokens, 1
    while step < DEPTH and len(keys) > step:
        left, right = keys[:-step], keys[step:]
        keys = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x632BE59BD9B4E019))
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(32)
        step *= 2
    return keys if step == DEPTH else keys[:0]


def page_key(words: list[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(words).encode("utf-8", "replace")) >> 1


def parsed(pages: DataFrame) -> DataFrame:
    return pages.select(F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
                        F.col("html"), F.col("page_id"), F.col("url"))


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, PART):
            yield batch.slice(i, PART)


def both_streams(pages: DataFrame) -> DataFrame:
    """(host, inside, page, narrow, wide): each page's streams inside and outside its article, pages
    named by content, from one cutting of the page.

    Tokens inside are 32 bits wide (`narrow`), half the files: a window still differs in eight of
    them, and several articles must agree by chance, not two. Those outside are `wide`.
    """
    @lean
    def run(batches):
        for part in parts(batches):
            at, inner, keys, tokens = [], [], [], ([], [])
            for i, text in enumerate(part.column(1).to_pylist()):
                blocks = blocks_of(text)
                outside = [w for _, w in stream_of(blocks)]
                for inside, words in ((True, " ".join(article_blocks(blocks)).split()), (False, outside)):
                    if len(words) >= DEPTH:
                        at.append(i)
                        inner.append(inside)
                        keys.append(page_key(words))
                        own = hashed(words).view(np.int64)
                        tokens[0].append(own.astype(np.int32) if inside else None)
                        tokens[1].append(None if inside else own)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(at, pa.int64())), pa.array(inner, pa.bool_()),
                 pa.array(keys, pa.int64()), pa.array(tokens[0], pa.list_(pa.int32())),
                 pa.array(tokens[1], pa.list_(pa.int64()))],
                ["host", "inside", "page", "narrow", "wide"])

    return parsed(pages).select("host", "html").mapInArrow(
        run, "host string, inside boolean, page long, narrow array<int>, wide array<long>")


def streams_of(both: DataFrame, inside: bool) -> DataFrame:
    """(host, page, tokens): the streams inside articles, or those outside."""
    return both.where(F.col("inside") if inside else ~F.col("inside")).select(
        "host", "page", F.col("narrow" if inside else "wide").alias("tokens"))


def token_streams(pages: DataFrame, inside: bool = False) -> DataFrame:
    """(host, page, tokens): each page's stream outside or inside its article."""
    return streams_of(both_streams(pages), inside)


def suffix_array(pages: np.ndarray, streams: list[np.ndarray], least: int = 1) -> pd.DataFrame:
    """Distinct substrings of DEPTH tokens in sorted order that stand in `least` distinct pages, with
    the first and last page of each and the number of its distinct pages.

    Streams are concatenated without letting a substring run over a page's end. Sorting suffixes
    by the key of their DEPTH-prefix puts equal substrings side by side, in the order of pages.
    """
    known, place = np.unique(pages, return_inverse=True)
    place = place.astype(np.int32)
    turn = np.argsort(place, kind="stable")
    keys = [windows(streams[i]) for i in turn]
    owner = np.repeat(place[turn], [len(k) for k in keys])
    key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    del keys
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    del order
    start = np.append(True, key[1:] != key[:-1])[:len(key)]
    first = np.flatnonzero(start)
    last = np.append(first[1:], len(key)) - 1 if len(key) else first
    start[1:] |= owner[1:] != owner[:-1]
    held = np.add.reduceat(start, first, dtype=np.int64) if len(key) else first
    if least > 1:
        enough = held >= least
        first, last, held = first[enough], last[enough], held[enough]
    return pd.DataFrame({"window": key[first].view(np.int64), "first": known[owner[first]],
                         "last": known[owner[last]], "pages": held})


def placed_streams(streams: DataFrame) -> DataFrame:
    """(host, block, blocks, page, tokens): every distinct stream of a host once, with its block.

    Copies of a page share its key and would all meet in one block, whatever its size.
    """
    streams = stored(streams.dropDuplicates(["host", "page"]))
    release(streams.sparkSession)
    return dealt_streams(streams)


def dealt_streams(streams: DataFrame) -> DataFrame:
    """`placed_streams` of stored streams that are distinct."""
    sizes = streams.groupBy("host").agg(F.sum(F.size("tokens")).alias("n"))
    blocks = stored(sizes.select("host", F.ceil(F.col("n") / BLOCK_TOKENS).cast("int").alias("blocks")))
    return streams.join(blocks, "host").select(
        "host", F.pmod(F.col("page"), F.col("blocks")).cast("int").alias("block"), "blocks", "page",
        "tokens")


def repeated_windows(placed: DataFrame, least: int = 2) -> DataFrame:
    """(host, window): substrings of DEPTH tokens that stand in `least` distinct pages of a host.

    Hosts are split into blocks of bounded size, each with a suffix array of its own. Blocks hand
    on every distinct substring with its number of pages, so merging them misses nothing. The only
    block of a host hands on what is repeated.
    """
    def sort(key, data):
        arrays = [np.asarray(t, np.int64).view(np.uint64) for t in data["tokens"]]
        found = suffix_array(data["page"].to_numpy(), arrays, least if key[2] == 1 else 1)
        found.insert(0, "host", key[0])
        return found[["host", "window", "pages"]]

    local = placed.groupBy("host", "block", "blocks").applyInPandas(
        sort, "host string, window long, pages long")
    return (local.groupBy("host", "window").agg(F.sum("pages").alias("pages"))
            .where(F.col("pages") >= least).select("host", "window"))


def repeated_places(placed: DataFrame, repeated: DataFrame) -> DataFrame:
    """(host, page, starts): where the repeated substrings stand, for pages that have some.

    A host's substrings meet each of its blocks in one task, so pages are never laid out by token.
    """
    blocks = placed.select(F.col("host").alias("h"), "block").distinct()
    dealt = repeated.join(blocks, F.col("host") == F.col("h")).select(
        F.col("host").alias("host"), F.col("block").alias("block"), "window")

    def find(data, held):
        known = np.sort(held["window"].to_numpy(np.int64))
        pages, starts = [], []
        if len(known):
            for page, tokens in zip(data["page"], data["tokens"]):
                at = windows(np.asarray(tokens, np.int64).view(np.uint64)).view(np.int64)
                near = np.minimum(np.searchsorted(known, at), len(known) - 1)
                hit = np.flatnonzero(known[near] == at).astype(np.int32)
                if len(hit):
                    pages.append(page)
                    starts.append(hit)
        host = data["host"].iloc[0] if len(data) else ""
        return pd.DataFrame({"host": objects([host] * len(pages)), "page": np.array(pages, np.int64),
                             "starts": objects(starts)})

    return placed.select("host", "block", "page", "tokens").groupBy("host", "block").cogroup(
        dealt.groupBy("host", "block")).applyInPandas(find, "host string, page long, starts array<int>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    A null or empty html has an empty text. A null URL belongs to the host with the empty name.
    Pages with the same stream are one page to the suffix array, so a copied page does not make
    its own text boilerplate, and repeated rows get equal texts. White space of any kind becomes
    one space. An empty table gives an empty result; other columns are not read.
    """
    @lean
    def split(batches):
        for part in parts(batches):
            inside, keys, texts, free = [], [], [], []
            for text in part.column(0).to_pylist():
                blocks = blocks_of(text)
                own = article_blocks(blocks)
                stream = [] if own else stream_of(blocks)
                words = " ".join(own).split() if own else [w for _, w in stream]
                inside.append(bool(own))
                keys.append(page_key(words))
                texts.append(own or words)
                free.append(None if own else [z == NEUTRAL for z, _ in stream])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(inside, pa.bool_()), pa.array(keys, pa.int64()),
                 pa.array(texts, pa.list_(pa.string())), pa.array(free, pa.list_(pa.bool_()))],
                ["host", "page_id", "url", "inside", "page", "texts", "open"])

    @lean
    def clear(batches):
        for part in parts(batches):
            texts = [" ".join(left_of(*row)) for row in zip(
                *[part.column(i).to_pylist() for i in (2, 3, 4)])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    rows = parsed(pages)
    kind = pages.schema["page_id"].dataType.simpleString()
    both = stored(both_streams(pages).dropDuplicates(["host", "inside", "page"]))
    release(pages.sparkSession)
    marks = []
    for inside, least in ((False, 2), (True, MANY)):
        placed = dealt_streams(streams_of(both, inside))
        shared = stored(repeated_windows(placed, least))
        release(pages.sparkSession)
        marks.append(stored(repeated_places(placed, shared)).withColumn("inside", F.lit(inside)))
        release(pages.sparkSession)
    held = rows.select("html", "host", "page_id", "url").mapInArrow(
        split, f"host string, page_id {kind}, url string, inside boolean, page long, "
               "texts array<string>, open array<boolean>")
    return held.join(marks[0].unionByName(marks[1]), ["host", "inside", "page"], "left").select(
        "page_id", "url", "texts", "open", "starts").mapInArrow(
        clear, f"page_id {kind}, url string, text string").withColumn(
        "n_chars", F.char_length("text").cast("long"))


def left_of(texts: list[str], free: list[bool] | None, starts: list[int] | None) -> list[str]:
    """What repeated substrings leave of a page: blocks of its article, or words where it marks none
    (`free`: whether a word stands where no name or mark says what it is)."""
    if free is None:
        return texts if starts is None else without_notices(texts, np.array(starts, np.int64))
    keep = np.array(free, bool)
    for s in starts or ():
        keep[s:s + DEPTH] = False
    return [w for w, k in zip(texts, keep) if k]
