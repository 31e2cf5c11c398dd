"""MinHash near-dedup by a signature-coordinate inverted join.

Two documents are linked if their sets of five-word shingles (lower-cased A-Z, whole texts)
have 100 * |intersection| >= percent * |union|. Components of links are the groups. The query's
contract is 85 percent (PERCENT); other callers of near_duplicates() give their own, and the figures
below, which are those of 85, follow from it.

1. One pass over the texts gives each document the size and a digest of its set,
   and a signature of K = 64 minima. Equal digests form a class; from here on
   the smallest doc_id stands for its class, so copies are never paired.
2. A link is looked for among pairs whose signatures agree in matches(85) = 40 or more
   of 64 coordinates; a pair at the threshold has fewer with a probability below
   one in 250,000 (MISS). Of 25 bands of two or three coordinates at least one then
   agrees entirely (24 misses cannot touch all), so only documents that share a
   band, the contested ones, are posted at all.
3. Contested documents are posted under every (coordinate, value). Postings are
   ordered rarest first; two documents with 40 collisions share one of the
   first 25 of each (prefix merging). Values that nobody shares are skipped.
4. In each posting list the document with the most common signature is the hub.
   Each document meets first the most common of the hubs of its prefix, then those of
   the others that are in another component by then: one pair for a document of a
   group around a common one, however large it is, at most 25 for any other. Collisions
   are counted, pairs under 40 or out of size dropped, the rest confirmed on their full sets.
5. Lists that still hold several components are settled exactly. A shingle that no
   other document of those lists has can be in no intersection; the count of the
   others, r, bounds every overlap. The lists are merged in blocks of bounded size; for pairs of
   different components with min(r) >= 0.85 / 1.85 * (n + n') and 40 collisions
   the merge itself counts the common shingles, by their hashes. A pair that reaches the threshold
   leaves the merge and makes one component of two there, so a block puts out fewer pairs than it
   has documents; they are confirmed likewise. Pairs that are refuted make no rows.

Edge cases: null text or text without words has n_shingles 0, is linked with
nothing and kept; fewer than five words are one shingle; rows that repeat a
doc_id are one document (linked if any of its texts are), each row returned; a null doc_id keeps
its row with component null and kept true; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.llm.common import WORD, map_rows, table, utf8
from ringfold.operators.components import connected_components
from ringfold.plans.shared import cut

SHINGLE = 5
PERCENT = 85
K = 64
MISS = 4e-6
CHUNK = 2048
#: Documents and shingles of a side of a block, about.
BLOCK, WEIGHT = 4096, 1 << 21

_RNG = np.random.default_rng(20250101)
_FACTORS = (_RNG.integers(0, 1 << 63, size=K, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def matches(percent: int) -> int:
    """The most coordinates of K that a pair at `percent` has in common with a probability of 1 - MISS or more."""
    p, fewer, m = percent / 100, 0.0, 0
    while m < K and (fewer := fewer + comb(K, m) * p**m * (1 - p) ** (K - m)) <= MISS:
        m += 1
    return m


class WordHash(dict):
    """64-bit hashes by word, kept for as many words as memory is meant for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(text: str | None, cache: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = utf8(text).lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - SHINGLE + 1)
    s = np.zeros(n, dtype=np.uint64)
    for k in range(min(SHINGLE, len(h))):
        s = (s ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        s ^= s >> np.uint64(29)
    s += np.uint64(min(SHINGLE, len(h)))
    return np.unique(s)


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(K, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), CHUNK):
        np.minimum(low, (_FACTORS[:, None] * hashes[None, at : at + CHUNK]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signed(rows: Iterable[tuple]) -> Iterator[tuple]:
    cache = WordHash()
    for doc_id, text in rows:
        s = shingle_hashes(text, cache)
        yield doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), signature(s).tolist() if len(s) else None


def shingles(text: str) -> set:
    words = utf8(text).lower().split()
    return set(zip(*(words[i:] for i in range(min(SHINGLE, len(words)))), strict=False)) if words else set()


def _confirmed(rows: Iterable[tuple], percent: int) -> Iterator[tuple]:
    last, held = None, set()
    for a, b, ta, tb in rows:
        if tb is not last:
            last, held = tb, shingles(tb)
        other = shingles(ta)
        both = len(held & other)
        if both and 100 * both >= percent * (len(held) + len(other) - both):
            yield a, b


def _spelled(rows: Iterable[tuple]) -> Iterator[tuple]:
    cache = WordHash()
    for rep, text in rows:
        s = shingle_hashes(text, cache)
        yield rep, xxhash.xxh3_128_digest(s.tobytes()), len(s), s.view(np.int64).tolist()


def prefix_length(percent: int) -> int:
    """Two documents with matches(percent) collisions share one of so many rarest coordinates of each."""
    return K - matches(percent) + 1


def bands(percent: int) -> list[tuple[int, int]]:
    """(first coordinate from 1, length) of the bands that divide the K coordinates, one more than a pair can miss."""
    n = prefix_length(percent)
    edges = [round(K * i / n) for i in range(n + 1)]
    return [(a + 1, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut(map_rows(docs, _signed, "doc_id long, n_shingles long, digest binary, sig array<int>"), "minhash-signed")
    # copies meet here before any pairing; the minimum combines on the map side
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut(named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "minhash-classes")
    links = cut(find_links(docs, classes, percent), "minhash-links")
    # a class is a node by its representative; rows that repeat a doc_id tie their classes together
    tied = named.select("digest", "doc_id").distinct().groupBy("doc_id").agg(F.min("digest").alias("d1"), F.max("digest").alias("d2")).where("d1 <> d2").select("doc_id")
    ties = named.join(tied, "doc_id", "left_semi").join(classes, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    groups = connected_components(links.unionByName(ties))
    of_class = classes.join(groups, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest")).join(of_class, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def find_links(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) pairs of representatives whose components are those of all links."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.slice("sig", at, n)) for i, (at, n) in enumerate(bands(percent))])
    posts = classes.select("rep", F.explode(keys).alias("band"))
    shared = cut(posts.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("band"), "minhash-bands")
    contested = posts.join(shared, "band", "left_semi").select("rep").distinct()
    sigs = cut(classes.join(contested, "rep", "left_semi").select("rep", "n", "sig"), "minhash-contested")
    texts = cut(docs.withColumnRenamed("doc_id", "rep").join(sigs.select("rep").distinct(), "rep", "left_semi").dropDuplicates(["rep", "text"]), "minhash-texts")

    ranked = cut(rarest(sigs, prefix_length(percent)), "minhash-prefix")
    prefix = ranked.select(F.explode("prefix").alias("key"), "rep", "common")
    # hubs and all other sides that aggregates make are tables, so that Spark can split a join on a key with very many rows
    hub = prefix.groupBy("key").agg(F.max(F.struct("common", F.negative("rep").alias("m"))).alias("h"), F.count("*").alias("c")).where("c > 1")
    hub = cut(hub.select("key", F.col("h.common").alias("weight"), (-F.col("h.m")).alias("b")), "minhash-hubs")
    best = prefix.select("key", "rep").join(hub, "key").where("rep <> b").groupBy("rep").agg(F.max(F.struct("weight", F.negative("b").alias("m"))).alias("h"))
    met = cut(best.select(F.col("rep").alias("a"), (-F.col("h.m")).alias("b")), "minhash-met")
    links = cut(confirm(collide(met, sigs, percent), texts, percent), "minhash-first")

    placed, keyed = grouped(ranked, links)
    theirs = cut(hub.join(placed.select(F.col("rep").alias("b"), F.col("part").alias("hub_part")), "b").select("key", "b", "hub_part"), "minhash-hub-parts")
    others = keyed.join(theirs, "key").where("part <> hub_part").select(F.col("rep").alias("a"), "b").distinct().join(met, ["a", "b"], "left_anti")
    others = cut(others, "minhash-met")
    links = cut(links.unionByName(confirm(collide(others, sigs, percent), texts, percent)), "minhash-second")

    placed, keyed = grouped(ranked, links)
    open_keys = cut(keyed.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("c")).where("lo < hi").select("key", "c"), "minhash-open")
    left = across(placed, keyed.join(open_keys, "key"), texts, sigs, percent)
    return links.unionByName(confirm(left, texts, percent))


def grouped(ranked: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rep, n, prefix, part) and its postings (key, rep, part): the component that the links so far give each document."""
    parts = connected_components(links)
    placed = ranked.join(parts, F.col("rep") == F.col("node"), "left").select("rep", "n", "prefix", F.coalesce("component", "rep").alias("part"))
    placed = cut(placed, "minhash-parts")
    return placed, placed.select(F.explode("prefix").alias("key"), "rep", "part")


def rarest(sigs: DataFrame, length: int) -> DataFrame:
    """rep, n, common, prefix: each document's `length` rarest coordinate values, those that nobody shares skipped.

    Postings are (coordinate, value) pairs; `common` grows with how many documents share the values of a document.
    """
    posts = sigs.select("rep", "n", F.posexplode("sig").alias("at", "value")).select("rep", "n", F.xxhash64("at", "value").alias("key"))
    times = cut(posts.groupBy("key").agg(F.count("*").alias("times")).where("times > 1"), "minhash-times")
    each = posts.join(times, "key").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("times", "key"))).alias("p"), F.sum(F.log2(F.col("times").cast("double"))).alias("common"))
    # a value that nobody shares is rarer than any that is shared: those a document lacks in p stand before it
    return each.select("rep", "n", "common", F.transform(F.slice("p", 1, F.greatest(F.lit(0), length - (K - F.size("p")))), lambda x: x["key"]).alias("prefix"))


def collide(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with matches(percent) equal coordinates or more and sizes that allow the threshold."""
    one = sigs.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    two = sigs.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x)
    both = pairs.join(one, "a").join(two, "b").where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (same >= matches(percent)))
    return both.select("a", "b")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    a, b = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    return map_rows(pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb"), lambda rows: _confirmed(rows, percent), "a long, b long")


def supported(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """rep, r, s, sizes, lengths: the shingles that at least one other document of reps has as well, as hashes.

    s has them text by text, lengths how many each text has of them, r of all, sizes how many shingles a text has in all.
    """
    rows = map_rows(texts.join(reps, "rep", "left_semi"), _spelled, "rep long, set binary, n long, s array<bigint>").select("rep", "set", "n", F.explode("s").alias("s"))
    rows = cut(rows, "minhash-shingles")
    shared = rows.groupBy("s").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("s")
    each = rows.join(cut(shared, "minhash-common"), "s", "left_semi").groupBy("rep", "set").agg(F.first("n").alias("n"), F.collect_set("s").alias("s"))
    all_ = each.groupBy("rep").agg(F.collect_list(F.struct("n", "s")).alias("x"))
    lengths = F.transform("x", lambda x: F.size(x["s"]).cast("long"))
    return all_.select("rep", F.size(F.flatten("x.s")).cast("long").alias("r"), F.flatten("x.s").alias("s"), F.col("x.n").alias("sizes"), lengths.alias("lengths"))


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _merged(block: pa.Table, percent: int) -> pa.Table:
    """Links that make the components of the links in one posting list, or in two blocks of a long one.

    A pair is looked at under the smallest value that both prefixes have, so in one list alone.
    """
    c = {name: block.column(name).to_numpy() for name in ("key", "rep", "n", "r", "part", "side")}
    sigs = np.array(block.column("sig").to_pylist(), dtype=np.int32).reshape(-1, K)
    prefixes, sizes, lengths = (block.column(name).to_pylist() for name in ("prefix", "sizes", "lengths"))
    lists = block.column("s").combine_chunks()
    starts, ids = lists.offsets.to_numpy().tolist(), np.unique(lists.values.to_numpy(), return_inverse=True)[1]
    held = np.zeros(len(ids), dtype=bool)
    part = np.unique(c["part"], return_inverse=True)[1]
    two = bool(c["side"].max() != c["side"].min())
    key, least, out = int(c["key"][0]), matches(percent), ([], [])

    def texts(i: int) -> Iterator[tuple[int, np.ndarray]]:
        at = starts[i]
        for n, length in zip(sizes[i], lengths[i], strict=True):
            yield n, ids[at : at + length]
            at += length

    for i in range(len(sigs)):
        other = np.arange(i + 1, len(sigs)) if not two else np.flatnonzero(c["side"] > c["side"][i])
        low, n, m = np.minimum(c["r"][other], c["r"][i]), c["n"][other], c["n"][i]
        fits = (part[other] != part[i]) & ((100 + percent) * low >= percent * (n + m)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
        other = other[fits]
        mine = set(prefixes[i])
        other = [j for j in other[(sigs[other] == sigs[i]).sum(axis=1) >= least].tolist() if min(mine.intersection(prefixes[j])) == key]
        for n, own in texts(i) if other else ():
            held[own] = True
            for j in other:
                if part[j] != part[i] and any(100 * (both := int(np.count_nonzero(held[its]))) >= percent * (n + m - both) for m, its in texts(j)):
                    x, y = int(c["rep"][i]), int(c["rep"][j])
                    out[0].append(min(x, y))
                    out[1].append(max(x, y))
                    part[part == part[j]] = part[i]
            held[own] = False
    return pa.Table.from_arrays([pa.array(v, pa.int64()) for v in out], schema=_PAIRS)


def across(placed: DataFrame, posted: DataFrame, texts: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components whose shingle hashes reach the threshold, as many as join what they can join in a block.

    placed: rep, n, prefix, part. posted: key, rep, c of the lists that hold several components, c documents each.
    Lists are merged in blocks of about BLOCK documents or WEIGHT shingles: a short list is one group, a long one as many
    groups as it has pairs of blocks, each dealt on its own.
    """
    posted = cut(posted.select("key", "rep", "c"), "minhash-posted")
    support = supported(posted.select("rep").distinct(), texts)
    able = placed.join(support, "rep").where(100 * F.col("r") >= percent * F.col("n")).join(sigs.select("rep", "sig"), "rep")
    able = cut(able, "minhash-able")
    heavy = cut(posted.join(able.select("rep", "r"), "rep").groupBy("key").agg(F.sum("r").alias("w")), "minhash-weights")
    rows = posted.join(able, "rep").join(heavy, "key")
    rows = rows.withColumn("blocks", F.ceil(F.greatest(F.col("c") / BLOCK, F.col("w") / WEIGHT))).withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    rows = rows.select("key", "rep", "n", "r", "part", "side", "sig", "prefix", "s", "sizes", "lengths", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    rows = rows.withColumns({"lo": F.least("side", "other"), "hi": F.greatest("side", "other")}).drop("other")
    return rows.repartition("key", "lo", "hi").groupBy("key", "lo", "hi").applyInArrow(lambda block: _merged(block, percent), "a long, b long")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: All pairs that share a shingle, counted: the exact links of the contract.
SQL = rf"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+{SHINGLE - 1}], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
pair AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
walk AS (SELECT a AS node, a AS reached FROM pair UNION SELECT w.node, p.b FROM walk w JOIN pair p ON w.reached = p.a),
part AS (SELECT node, least(node, min(reached)) AS component FROM walk GROUP BY node)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, t.doc_id) AS component_id, coalesce(component, t.doc_id) = t.doc_id AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN part ON node = t.doc_id"""
