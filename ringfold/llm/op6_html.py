"""Main text of web pages: block structure, and the runs that repeat over each whole host.

Parsing. One pass over the tags keeps a stack of open elements. Elements that are never main text (navigation,
footers, forms, scripts, ...) and elements that a class, an id or a role calls so outright (`comments`, `ad`, ...) are left out.
The rest becomes blocks: white space within one is a single space, character references are decoded.
A page with an article or main element has its text there. A block of it is in doubt if the name of an element around it only
contains such a word (`widget-intro`, `related-links`). On a page without an article element every block is in doubt.

Host runs settle the doubt. The blocks in doubt of each page, one after another, are its token stream. A run is RUN
tokens of it, and repeated if it stands on two or more pages of different text of its host: identical pages
count as one, so they keep what one of them would. Of a page without an article
element the tokens that repeated runs cover go and its unique runs stay; within an article a
block in doubt goes if repeated runs cover half of its tokens or more, and stays whole otherwise.

A suffix array sorts a host's suffixes; to find runs of RUN tokens only their equality to that depth counts, so hashes name
the runs instead (Karp, Miller and Rosenberg's naming), which needs no host in one task. Equal runs have the same anchor, the
smallest hash of their GRAM-token parts; about one hash in seven tokens is posted
first, and its smallest and largest page (by a hash of its text) combine on the map side. Only runs whose anchor is
shared are posted in turn, by 128 bits of hash with the anchor. What comes back to a stream is the set of its own
runs that repeat. No step holds more than one page, however large a host is.

Edge cases: null or empty html gives empty text; a null url is a host of its own; unclosed
elements and tags end with the page; repeated rows give each their text; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.llm.common import map_rows, salted, table, utf8
from ringfold.llm.op7_minhash import WordHash
from ringfold.plans.shared import cut

RUN = 16
GRAM = 4

# Elements by their part in a page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("head nav footer aside form menu dialog button select option".split()) | RAW
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_SELF = frozenset("li dt dd tr td th option".split())
#: Words that, as a whole class, id or role, mark what is no main text, and as a part of one put it in doubt.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr menu nav navbar navigation newsletter notice pager pagination popup promo replies respond share sharing sidebar social sponsor sponsored subscribe toolbar contentinfo complementary".split()
)
#: Words that put in doubt wherever they stand.
DOUBTS = NAMES | frozenset("modal promoted related search widget".split())
HEADER_NAMES = frozenset("header masthead topbar".split())

_OPEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)|<[!?/]")
_COMMENT_END = re.compile(r"--!?>")
_STOP = re.compile(r"[>\"']")
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_MAIN = re.compile(r"role\s*=\s*[\"']?main\b", re.I)


def named(attrs: str) -> tuple[set[str], set[str]]:
    """The class, id and role names of a tag, and the words they are made of."""
    names = {w for m in _NAMED.finditer(attrs) for w in next(filter(None, m.groups()), "").lower().split()}
    return names, {w for n in names for w in re.split(r"[^a-z0-9]+", n)}


class Tags:
    """The tags and comments of a page in order; each character is looked at a bounded number of times."""

    def __init__(self, html: str) -> None:
        self.html, self.never = html, set()

    def end(self, at: int) -> int:
        """Where the tag ends whose attributes begin at `at`; a > within quotes is no end, an unclosed quote is a character like others."""
        while m := _STOP.search(self.html, at):
            at = m.end()
            if m[0] == ">":
                return at
            if m[0] not in self.never:
                close = self.html.find(m[0], at)
                if close < 0:
                    self.never.add(m[0])  # nor does any later one close
                else:
                    at = close + 1
        return len(self.html)

    def next(self, at: int) -> tuple[int, int, bool, str, str]:
        """(start, end, closing, name, attributes) of the next tag from `at`; the name is empty for comments and the like."""
        m = _OPEN.search(self.html, at)
        if m is None:
            return len(self.html), -1, False, "", ""
        if m[2]:
            end = self.end(m.end())
            return m.start(), end, bool(m[1]), m[2].lower(), self.html[m.end() : end]
        if m[0] == "<!--":
            if self.html.startswith((">", "->"), m.end()):
                return m.start(), self.html.index(">", m.end()) + 1, False, "", ""
            stop = _COMMENT_END.search(self.html, m.end())
            return m.start(), stop.end() if stop else len(self.html), False, "", ""
        stop = self.html.find(">", m.end())
        return m.start(), stop + 1 if stop >= 0 else len(self.html), False, "", ""


SURE, DOUBT, OUTSIDE = 0, 1, 2


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(SURE or DOUBT in an article, or OUTSIDE of one; text) for each block of a page that can be main text, in page order."""
    if not html:
        return []
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, left out, in an article, in doubt
    opened: dict[str, int] = defaultdict(int)
    skip = inside = doubt = False
    tags, at, size = Tags(html), 0, len(html)

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(((DOUBT if doubt else SURE) if inside else OUTSIDE, text))
            parts.clear()

    def pop_to(n: int) -> None:
        nonlocal skip, inside, doubt
        if any(x[0] in BLOCK for x in stack[n:]):
            flush()
        for x in stack[n:]:
            opened[x[0]] -= 1
        del stack[n:]
        skip, inside, doubt = stack[-1][1:] if stack else (False, False, False)

    while at < size:
        start, end, close, name, attrs = tags.next(at)
        if not skip and start > at:
            parts.append(entities.unescape(html[at:start]))
        if end < 0:
            break
        at = end
        if not name:
            continue
        if name == "br" and not skip:
            parts.append(" ")
        if close:
            if opened[name]:
                n = len(stack) - 1
                while stack[n][0] != name:
                    n -= 1
                pop_to(n)
            continue
        if name in BLOCK:
            for i in range(len(stack) - 1, -1, -1):
                open_ = stack[i][0]
                if open_ == "p" or (open_ == name and name in CLOSED_BY_SELF):
                    pop_to(i)
                    break
                if open_ in BLOCK:
                    break
            flush()
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = stop.end() if stop else size
            continue
        if name in VOID:
            continue
        names, words = named(attrs) if attrs and not skip else ((), ())
        main = name in ("article", "main") or bool(attrs and _MAIN.search(attrs))
        header = not inside and (name == "header" or bool(words and HEADER_NAMES & words))
        out_of = skip or name in CHROME or header or bool(names and not main and NAMES & names)
        unsure = doubt or bool(words and not main and DOUBTS & words)
        if (out_of, unsure, inside or (main and not out_of)) != (skip, doubt, inside):
            flush()
        skip, inside, doubt = out_of, inside or (main and not out_of), unsure
        stack.append((name, skip, inside, doubt))
        opened[name] += 1
    flush()
    return out


def mixed(h: np.ndarray, size: int, seed: int) -> np.ndarray:
    """64-bit hashes of each `size` neighbours of h."""
    n = len(h) - size + 1
    out = np.full(n, seed, dtype=np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def runs(host: str, texts: list[str], cache: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, hash) of each run of RUN tokens of a page, in order."""
    words = [w for t in texts for w in utf8(t).split(b" ")]
    if len(words) < RUN:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
    seed = xxhash.xxh3_64_intdigest(utf8(host))
    parts = np.lib.stride_tricks.sliding_window_view(mixed(h, GRAM, seed), RUN - GRAM + 1)
    return parts.min(axis=1).view(np.int64), mixed(h, RUN, seed ^ 0x5BD1E995).view(np.int64)


def in_doubt(kinds: list[int]) -> list[bool]:
    """Of the blocks of a page, those that its stream has; a page with an article has no OUTSIDE ones here."""
    return [k != SURE for k in kinds]


def _parsed(rows: Iterable[tuple]) -> Iterator[tuple]:
    cache = WordHash()
    for page_id, url, host, html in rows:
        found = blocks(html)
        if any(k != OUTSIDE for k, _ in found):
            found = [x for x in found if x[0] != OUTSIDE]
        texts, kinds = [t for _, t in found], [k for k, _ in found]
        open_ = [t for t, d in zip(texts, in_doubt(kinds), strict=True) if d]
        stream = xxhash.xxh3_64_intdigest(utf8("\0".join([host, *texts]))) - (1 << 63)
        yield page_id, url, host, stream, texts, kinds, np.unique(runs(host, open_, cache)[0]).tolist()


def _shared(rows: Iterable[tuple]) -> Iterator[tuple]:
    cache = WordHash()
    for stream, host, texts, kinds, shared in rows:
        a, w = runs(host, [t for t, d in zip(texts, in_doubt(kinds), strict=True) if d], cache)
        both = np.unique(np.stack([a, w])[:, np.isin(a, shared)], axis=1)
        yield stream, both[0].tolist(), both[1].tolist()


_OUT = "page_id long, url string, text string, n_chars long, n_tokens long, n_repeated long"


def _cleaned(rows: Iterable[tuple]) -> Iterator[tuple]:
    cache = WordHash()
    for page_id, url, host, texts, kinds, again in rows:
        words = [t.split(" ") if d else [] for t, d in zip(texts, in_doubt(kinds), strict=True)]
        mask = np.zeros(sum(map(len, words)), dtype=bool)
        if again:
            found = runs(host, [t for t, d in zip(texts, in_doubt(kinds), strict=True) if d], cache)[1]
            for at in np.flatnonzero(np.isin(found, again)).tolist():
                mask[at : at + RUN] = True
        at, kept = 0, []
        for text, kind, b in zip(texts, kinds, words, strict=True):
            covered, at = mask[at : at + len(b)], at + len(b)
            if kind == SURE or (kind == DOUBT and 2 * covered.sum() < len(b)):
                kept.append(text)
            elif kind == OUTSIDE and not covered.all():
                kept.append(" ".join(w for w, c in zip(b, covered, strict=True) if not c))
        text = "\n".join(kept)
        yield page_id, url, text, len(text), len(mask), int(mask.sum())


def in_two_streams(posts: DataFrame, *keys: str) -> DataFrame:
    """The keys that stand in two or more streams."""
    return posts.groupBy(*keys).agg(F.min("stream").alias("lo"), F.max("stream").alias("hi")).where("lo < hi").select(*keys)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_tokens (in doubt), n_repeated (of these) for each row of pages (page_id, url, html)."""
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html")
    parsed = cut(map_rows(p, _parsed, "page_id long, url string, host string, stream long, texts array<string>, kinds array<int>, anchors array<bigint>"), "html-parsed")
    open_ = parsed.where(F.size("anchors") > 0)
    anchors = open_.select("stream", F.explode("anchors").alias("a"))
    mine = salted(anchors, cut(in_two_streams(anchors, "a"), "html-anchors"), ["a"], ["stream"], "left_semi").groupBy("stream").agg(F.collect_set("a").alias("shared"))
    posts = map_rows(open_.join(cut(mine, "html-shared"), "stream").select("stream", "host", "texts", "kinds", "shared"), _shared, "stream long, a array<bigint>, w array<bigint>")
    posts = cut(posts.select("stream", F.explode(F.arrays_zip("a", "w")).alias("x")).select("stream", "x.a", "x.w"), "html-runs")
    again = salted(posts, cut(in_two_streams(posts, "a", "w"), "html-repeated"), ["a", "w"], ["stream"], "left_semi").groupBy("stream").agg(F.collect_set("w").alias("again"))
    columns = ["page_id", "url", "host", "texts", "kinds", "again"]
    sure = parsed.where(F.size("anchors") == 0).withColumn("again", F.lit(None).cast("array<bigint>")).select(*columns)
    return map_rows(sure.unionByName(open_.join(cut(again, "html-again"), "stream", "left").select(*columns)), _cleaned, _OUT)


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
