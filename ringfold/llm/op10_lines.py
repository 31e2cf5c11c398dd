"""Line dedup by winnowing over line hashes, in DataFrame functions only.

Lines without a word are skipped over and never removed. A window is the shortest run of consecutive lines that
begins at a line and has MIN_WORDS words or more.

1. Winnowing. In every window the line of the smallest hash (the last one of equal ones) is its fingerprint;
   neighbouring windows mostly share it and post it once. As equal runs have equal windows, every run of
   MIN_WORDS words that stands in two places has a fingerprint in both: it is guaranteed.
2. Positions are joined on the fingerprint alone: of all windows only those go on whose
   fingerprint stands at two places.
3. A shared fingerprint is extended both ways, line by line until MIN_WORDS words are reached: to the right to the ends of its
   windows, and to the left to the shortest runs that end at a line and begin with one of its windows. A repeated run
   is covered by its extensions from its first line to its last. Extensions of equal content meet by
   their hashes (96 bits beside the fingerprint); only the first place of each is kept, so no pairs of places are formed.
4. A line goes if it lies in an extension that stands earlier, in order of
   (doc_id, hash of the text, line), in any document or the same one.

A fingerprint is never collected: first places are minima with map-side combination, and both joins deal a key to
SALTS tasks, so a line that stands in a third of all documents is no hot task.

Edge cases: null text stays null and empty text empty; lines are compared without
leading and trailing ASCII white space; rows with equal doc_id and text are one
document to this operator and each keeps the same lines; a null doc_id orders
first; an empty table stays empty; further columns are returned as they are
by dedup_lines, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.llm.common import BLANKS, WORD, fresh, salted, table
from ringfold.plans.shared import cut

MIN_WORDS = 25


def content(text: Column) -> Column:
    """array<struct(pos, h, g, nw)> of the lines with a word: place, two hashes, words."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.trim(x, F.lit(BLANKS)))
    seen = F.transform(lines, lambda x, i: F.struct(i.alias("pos"), F.xxhash64(x).alias("h"), F.hash(x).alias("g"), F.regexp_count(x, F.lit(WORD)).alias("nw")))
    return F.filter(seen, lambda s: s["nw"] > 0)


def reach(nw: Column, least: int) -> Column:
    """How many leading entries of the array nw add up to `least`; 0 if all of them don't. One long holds (words, entries)."""
    done = F.lit(least << 32).cast("long")
    more = lambda a, x: F.when(a >= done, a).otherwise(a + F.shiftleft(x.cast("long"), 32) + 1)
    return F.aggregate(nw, F.lit(0).cast("long"), more, lambda a: F.when(a >= done, a.bitwiseAND(F.lit((1 << 32) - 1).cast("long"))).otherwise(0).cast("int"))


def fingerprinted(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, th, pos, h, g, nw, ahead, fp: the lines of each document as arrays, with the length of the window at each line
    (0: no window) and the place of its fingerprint, from 1."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), content(F.col("text")).alias("c"))
    d = d.select("doc_id", "th", *[F.col(f"c.{n}").alias(n) for n in ("pos", "h", "g", "nw")])
    at = F.transform("pos", lambda _, k: k + 1)
    # a line that has the words alone, as most have, needs no look at those after it
    one = lambda i: F.element_at("nw", i) >= least
    d = d.withColumn("ahead", F.transform(at, lambda i: F.when(one(i), 1).otherwise(reach(F.slice("nw", i, least), least))))
    lowest = lambda i, n: F.negative(F.array_min(F.transform(F.slice("h", i, n), lambda x, k: F.struct(x.alias("h"), F.negative(i + k).alias("m"))))["m"])
    return d.withColumn("fp", F.transform("ahead", lambda n, k: F.when(n == 1, k + 1).when(n > 1, lowest(k + 1, n)).otherwise(0)))


def extensions(lines: DataFrame, least: int) -> DataFrame:
    """fp, key, more, doc_id, th, first, last: for each window, and each shortest run that ends at a line, the hash of the
    fingerprint it is extended from, its own content's hashes and its place by original line numbers."""
    at = F.transform("pos", lambda _, k: k + 1)
    right = F.transform("ahead", lambda n, k: F.struct((k + 1).alias("a"), n.alias("n")))
    low = lambda i: F.greatest(F.lit(1), i - (least - 1))
    back = lambda i: F.when(F.element_at("nw", i) >= least, 1).otherwise(reach(F.reverse(F.slice("nw", low(i), i - low(i) + 1)), least))
    left = F.transform(F.transform(at, lambda i: F.struct(i.alias("b"), back(i).alias("n"))), lambda s: F.struct((s["b"] - s["n"] + 1).alias("a"), s["n"].alias("n")))
    each = lines.select("doc_id", "th", "pos", "h", "g", "fp", F.explode(F.array_distinct(F.filter(F.concat(right, left), lambda s: s["n"] > 0))).alias("s"))
    run = lambda c: F.slice(F.col(c), F.col("s.a"), F.col("s.n"))
    place = lambda c, k: F.element_at(c, k)
    fp = place("h", place("fp", F.col("s.a")))
    return each.select(fp.alias("fp"), F.xxhash64(run("h")).alias("key"), F.hash(run("g")).alias("more"), "doc_id", "th", place("pos", F.col("s.a")).alias("first"), place("pos", F.col("s.a") + F.col("s.n") - 1).alias("last"))


def repeats(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, th, gone: the numbers of the lines (from 0, blank ones within a run among them) to remove."""
    lines = cut(fingerprinted(docs, least), "line-fingerprints")
    posts = lines.select("doc_id", "th", "h", F.explode(F.array_distinct(F.filter("fp", lambda k: k > 0))).alias("k")).select(F.element_at("h", F.col("k")).alias("fp"), F.struct("doc_id", "th", "k").alias("place"))
    shared = cut(posts.groupBy("fp").agg(F.min("place").alias("lo"), F.max("place").alias("hi")).where("lo <> hi").select("fp"), "line-shared")
    runs = cut(salted(extensions(lines, least), shared, ["fp"], ["doc_id", "th"], "left_semi"), "line-runs")
    content_ = ["fp", "key", "more"]
    place = F.struct("doc_id", "th", "first")
    firsts = cut(runs.groupBy(*content_).agg(F.min(place).alias("origin"), F.max(place).alias("end")).where("origin <> end").drop("end"), "line-firsts")
    later = salted(runs, firsts, content_, ["doc_id", "th"], "inner").where(~place.eqNullSafe(F.col("origin")))
    return later.groupBy("doc_id", "th").agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last")))).alias("gone"))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs with `text` cleaned, and as the last two columns the lines there were and those removed."""
    old, id_, th, lost = (fresh(docs, f"__{n}") for n in ("text", "id", "th", "gone"))
    gone = repeats(docs.select("doc_id", "text"), least).toDF(id_, th, lost)
    d = docs.withColumnRenamed("text", old)
    joined = d.join(gone, d["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(old) == F.col(th)), "left")
    lines = F.split(F.col(old), "\n", -1)
    removed = F.filter(F.col(lost), lambda i: F.regexp_like(F.element_at(lines, i + 1), F.lit(WORD)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    text = F.when(F.col(lost).isNull(), F.col(old)).otherwise(F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n"))
    n_lines = F.when(F.col(old).isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_removed = F.when(F.col(lost).isNull(), 0).otherwise(F.size(removed)).cast("long")
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns], n_lines.alias(fresh(docs, "__lines")), n_removed.alias(fresh(docs, "__removed")))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed and the cleaned text of every document."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), "text")


SQL = rf"""
WITH d AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents WHERE text IS NOT NULL),
l AS (SELECT r, doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM d),
c AS (SELECT *, trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) AS t, len(regexp_extract_all(line, '{WORD}')) AS nw FROM l),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY pos) AS i, sum(nw) OVER (PARTITION BY r ORDER BY pos) AS cum FROM c WHERE nw > 0),
f AS (SELECT a.r, a.i AS a, min(b.i) AS b FROM k a JOIN k b ON a.r = b.r AND b.cum - a.cum + a.nw >= {MIN_WORDS} AND b.i >= a.i GROUP BY 1, 2),
g AS (SELECT b.r, max(a.i) AS a, b.i AS b FROM k a JOIN k b ON a.r = b.r AND b.cum - a.cum + a.nw >= {MIN_WORDS} AND b.i >= a.i GROUP BY b.r, b.i),
s AS (SELECT r, a, b FROM f UNION SELECT r, a, b FROM g),
w AS (SELECT s.r, s.a, s.b, string_agg(k.t, chr(10) ORDER BY k.i) AS run FROM s JOIN k ON s.r = k.r AND k.i BETWEEN s.a AND s.b GROUP BY ALL),
o AS (SELECT w.*, row_number() OVER (PARTITION BY run ORDER BY doc_id, a) AS nth FROM w JOIN d USING (r)),
x AS (SELECT DISTINCT k.r, k.pos FROM o JOIN k ON o.r = k.r AND k.i BETWEEN o.a AND o.b WHERE nth > 1),
y AS (SELECT c.r, string_agg(line, chr(10) ORDER BY c.pos) FILTER (WHERE x.r IS NULL) AS text, count(*) AS n, count(x.r) AS gone FROM c LEFT JOIN x ON c.r = x.r AND c.pos = x.pos GROUP BY c.r)
SELECT doc_id, n::BIGINT AS n_lines, gone::BIGINT AS n_removed, coalesce(y.text, '') AS text FROM d JOIN y USING (r)
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL"""
