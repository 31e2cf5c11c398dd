"""Benchmark decontamination with a BM25 inverted index and block-max WAND.

The index holds the benchmark items. A term's weight in an item is its BM25
impact over the item's own total, so an item scores 1 for a passage with all
its terms. Every document is read whole as overlapping passages of 2 * L words
at a stride of L, L being the words of the longest item, so each place that
could hold an item lies in one passage as a whole. Every passage queries the
index: block-max WAND finds all items with a score of THRESHOLD or more. Its
first bound (the sum of the terms' maxima in each block of items) is taken for
all passages of a text at once, and only blocks that reach the threshold are walked.
A candidate is verified on words in order: the share of the three-word grams of
its question and of its answer that the passage has must reach QUESTION and ANSWER. Items are one text here;
the answer is its last third unless the caller gives answers of its own.

The index is sent to executors in shards of about SHARD_WORDS words; a larger benchmark makes more
shards and more passes, with the document frequencies of the whole benchmark in each. Rows that repeat an item are one item, so
hashing spreads the items evenly; items of over LONG words have shards of their own, so that they do not lengthen the
passages of the others. With several shards the matches of each are a table, and its broadcast is released before the next.

Edge cases: null or empty text matches nothing; an item without a word is left
out; items under three words are matched as a whole; equal items all match;
repeated rows each give their matches; an empty benchmark or document table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.llm.common import filter_rows, map_rows, table, utf8
from ringfold.plans.shared import cut

THRESHOLD = 0.6
QUESTION, ANSWER = 0.7, 0.5
K1, B = 1.2, 0.75
#: Items in a block at least, and blocks of an index at most (a bound on the size of the table of maxima).
LEAST_BLOCK, MOST_BLOCKS = 4, 64
SHARD_WORDS = 500_000
LONG = 1000
GRAM = 3

_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def words(text: str | None) -> list[bytes]:
    """Words in lower case with ASCII punctuation taken as white space."""
    return utf8(text.lower()).translate(_PLAIN).split() if text else []


class Index:
    """Postings of normalised BM25 impacts by term, in blocks with their maxima."""

    def __init__(self, items: list[tuple[int, list[bytes], int]], df: dict[bytes, int], n_items: int, mean_len: float) -> None:
        """items: (item_id, words, words of the question). df, n_items, mean_len: of the whole benchmark."""
        self.ids = [i for i, _, _ in items]
        self.words = [w for _, w, _ in items]
        self.split = [q for _, _, q in items]
        self.longest = max((len(w) for w in self.words), default=1)
        lists: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for k, w in enumerate(self.words):
            tf: dict[bytes, int] = defaultdict(int)
            for t in w:
                tf[t] += 1
            norm = K1 * (1 - B + B * len(w) / mean_len)
            raw = {t: math.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm) for t, n in tf.items()}
            total = sum(raw.values()) or 1.0
            for t, x in raw.items():
                lists[t].append((k, x / total))
        self.terms = {t: i for i, t in enumerate(lists)}
        self.docs = [[k for k, _ in p] for p in lists.values()]
        self.impacts = [[x for _, x in p] for p in lists.values()]
        self.block = max(LEAST_BLOCK, -(-len(items) // MOST_BLOCKS))
        self.top = np.zeros((len(lists) + 1, max(1, -(-len(items) // self.block))), dtype=np.float32)
        for t, (p, x) in enumerate(zip(self.docs, self.impacts, strict=True)):
            np.maximum.at(self.top[t], np.array(p) // self.block, np.array(x, dtype=np.float32))

    def search(self, query: list[int], least: float) -> list[tuple[int, float]]:
        """(item, score) of every item with score >= least, by block-max WAND over the query's term numbers.

        A block whose maxima add up to less is skipped; within one, WAND moves
        the lists by pivot, with the block's maxima as the terms' bounds.
        """
        least -= 1e-6
        found = []
        for b in np.flatnonzero(self.top[query].sum(axis=0) >= least):
            lo, hi = int(b) * self.block, (int(b) + 1) * self.block
            at, end = {}, {}
            for t in query:
                i, j = bisect_left(self.docs[t], lo), bisect_left(self.docs[t], hi)
                if i < j:
                    at[t], end[t] = i, j
            live, bounds = list(at), {t: float(self.top[t, b]) for t in at}
            while live:
                live.sort(key=lambda t: self.docs[t][at[t]])
                total, pivot = 0.0, -1
                for n, t in enumerate(live):
                    total += bounds[t]
                    if total >= least:
                        pivot = n
                        break
                if pivot < 0:
                    break
                item = self.docs[live[pivot]][at[live[pivot]]]
                if self.docs[live[0]][at[live[0]]] == item:
                    score = sum(self.impacts[t][at[t]] for t in live if self.docs[t][at[t]] == item)
                    if score >= least:
                        found.append((item, score))
                    item += 1
                for t in live:
                    at[t] = bisect_left(self.docs[t], item, at[t], end[t])
                live = [t for t in live if at[t] < end[t]]
        return found

    def verify(self, item: int, passage: list[bytes]) -> tuple[float, float]:
        """Shares of the grams of question and answer that the passage has."""
        w, q = self.words[item], self.split[item]
        n = min(GRAM, len(w))
        have = set(zip(*(passage[i:] for i in range(n)), strict=False))
        grams = list(zip(*(w[i:] for i in range(n)), strict=False))
        asked = [g in have for g in grams[: max(1, q - n + 1)]]
        told = [g in have for g in grams[max(0, min(q, len(w) - n)) :]] or asked
        return sum(asked) / len(asked), sum(told) / len(told)

    def matches(self, text: str | None) -> list[tuple[int, int, int, float, float, float]]:
        """(item_id, passage, first word, score, question share, answer share): the best passage for each item found."""
        w = words(text)
        if not w or not self.ids:
            return []
        get, none = self.terms.get, len(self.terms)
        nums = np.array([get(x, none) for x in w], dtype=np.int64)
        known = np.flatnonzero(nums < none)
        if not len(known):
            return []
        stride = self.longest
        found: dict[int, tuple] = {}
        # block maxima by stretches of `stride` words, each term once; a passage is two stretches, so their sum bounds it
        pairs = np.unique(known // stride * (none + 1) + nums[known])
        cell, term = pairs // (none + 1), pairs % (none + 1)
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        bound = np.zeros((cell[-1] + 2, self.top.shape[1]), dtype=np.float32)
        bound[cell[starts]] = np.add.reduceat(self.top[term], starts, axis=0)
        edges = np.searchsorted(cell, np.arange(len(bound) + 2))
        for k in np.flatnonzero((bound[:-1] + bound[1:]).max(axis=1) >= THRESHOLD - 1e-4):
            query = np.unique(term[edges[k] : edges[k + 2]]).tolist()
            passage = w[k * stride : (k + 2) * stride]
            for item, score in self.search(query, THRESHOLD):
                asked, told = self.verify(item, passage)
                if asked >= QUESTION and told >= ANSWER and (item not in found or score > found[item][3]):
                    found[item] = (self.ids[item], int(k), int(k) * stride, score, asked, told)
        return sorted(found.values())


def shards(benchmark: DataFrame, limit: int = SHARD_WORDS) -> tuple[int, Iterator[Index]]:
    """How many indexes the benchmark (item_id, text, optionally answer) makes, each of about `limit` words, and these one by one; driver memory holds one."""
    has_answer = "answer" in benchmark.columns
    b = benchmark.select("item_id", "text", F.col("answer") if has_answer else F.lit(None).cast("string").alias("answer")).distinct()
    split_ = lambda c: F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "), " "), lambda x: x != "")
    b = b.withColumn("w", split_("text")).where(F.size("w") > 0).withColumn("w", F.concat("w", split_("answer"))).withColumn("long", F.size("w") > LONG)
    sizes = b.groupBy("long").agg(F.count("*").alias("n"), F.sum(F.size("w")).alias("words")).collect()  # two rows at most
    parts = [(r.long, k, -(-r.words // limit)) for r in sizes for k in range(-(-r.words // limit))]
    n, total = sum(r.n for r in sizes), sum(r.words for r in sizes)

    def indexes() -> Iterator[Index]:
        for long, part, of in parts:
            rows = b.where((F.col("long") == long) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(of)) == part)).select("item_id", "text", "answer").collect()
            items = []
            for r in sorted(rows, key=lambda r: (r.item_id is None, r.item_id or 0, r.text or "", r.answer or "")):
                question, answer = words(r.text), words(r.answer)
                items.append((r.item_id, question + answer, len(question) if answer else -(-2 * len(question) // 3)))
            mine = {t for _, w, _ in items for t in w}
            df: dict[bytes, int] = defaultdict(int)
            if len(parts) == 1:
                for _, w, _ in items:
                    for t in set(w):
                        df[t] += 1
            else:
                counts = b.select(F.explode(F.array_distinct("w")).alias("t")).groupBy("t").count()
                for r in counts.toLocalIterator():
                    if (t := utf8(r.t)) in mine:
                        df[t] = r["count"]
            yield Index(items, defaultdict(lambda: 1, df), n, total / n)

    return len(parts), indexes()


def each_shard(docs: DataFrame, benchmark: DataFrame, step) -> Iterator[DataFrame]:
    """step(docs so far, broadcast index) for each shard; with several, as a table, after which the index is released."""
    many, indexes = shards(benchmark)
    for index in indexes:
        sent = docs.sparkSession.sparkContext.broadcast(index)
        out = step(sent)
        if many > 1:
            out = cut(out, "benchmark-shard")
            sent.unpersist()
        yield out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, passage, first_word, score, question, answer: every verified match."""
    schema = "doc_id long, item_id long, passage long, first_word long, score double, question double, answer double"
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = list(each_shard(docs, benchmark, lambda sent: map_rows(texts, _Matcher(sent), schema)))
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a verified match: one pass over the texts a shard, no shuffle."""
    left = [docs]
    for out in each_shard(docs, benchmark, lambda sent: filter_rows(left[-1], "text", _Clean(sent))):
        left[:] = [out]
    return left[-1]


class _Clean:
    def __init__(self, index) -> None:
        self.index = index

    def __call__(self):
        index = self.index.value
        return lambda text: not index.matches(text)


class _Matcher:
    def __init__(self, index) -> None:
        self.index = index

    def __call__(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        index = self.index.value
        for doc_id, text in rows:
            for match in index.matches(text):
                yield (doc_id, *match)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
