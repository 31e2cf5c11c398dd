r"""Secret scan in DataFrame functions only: three fixed kinds, and a randomness test battery.

Fixed kinds (leftmost, not overlapping within a kind): assign, access and hex, by BASE.

Battery. Candidates are runs of 20 or more characters of [A-Za-z0-9+/_=-]. The encoding is
inferred from the characters: hex (lower or upper), base32, base36 (lower or upper, with a digit), base62 and
base64 with a digit and both cases, else none. Under the hypothesis that a candidate is uniform over its encoding's
alphabet, three tests give two-sided normal scores:
- chi-squared uniformity over cells of the alphabet of nearly equal width, at least four, with five
  characters or more expected in each (Wilson-Hilferty); each cell is held against its own width,
- runs above and below the middle of the alphabet (Wald-Wolfowitz),
- serial correlation of neighbouring characters at lag one.
The p-value of the smallest of the three is 1 - (1 - p)^3 (Sidak).

Length-aware false-discovery control. Uniform strings have uniform p-values,
words and identifiers have values near 0. For each encoding and length class (powers of
two) the share of uniform strings is estimated from the upper half of the
p-values (Storey), and the smallest of the BINS thresholds t is taken at which the estimated
share of non-uniform strings among those with p >= t is at most FDR. Each estimate starts from
PRIOR uniform and PRIOR other strings, of which the tests miss a share that halves with every HALF
characters. So a long string that is alone in its class is judged by its length, a short one
is not reported without others like it, and where there are many the counts decide. Candidates
that reach their threshold are spans of kind random, unless a span of a fixed kind overlaps them.

The histograms of p-values have at most 5 * 32 * 64 cells whatever the input; texts
are read once, what passes on is the spans and candidates of the documents that have any.

Positions are code points of the whole text, end exclusive; of an assign match
the whole match is the span. Edge cases: null text is empty; no span gives
empty strings (their digest is that of the empty string); repeated rows are returned each; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringfold.llm.common import let, running, table
from ringfold.plans.shared import cut

#: kind: (pattern, group whose length counts, least length), in the order of the list.
BASE = {
    "assign": (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
FDR = 0.1
BINS = 64
PRIOR = 16.0
HALF = 8.0
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
ALPHABETS = {"hex": DIGITS + "abcdef", "base32": UPPER + "234567", "base36": DIGITS + LOWER, "base62": UPPER + LOWER + DIGITS, "base64": UPPER + LOWER + DIGITS + "+/"}


def spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """array<struct(s, e, m)> of the leftmost matches that do not overlap; m is the match.

    The running sum of the pieces between matches and the matches gives the positions, in linear time.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def placed_(x: Column) -> Column:
        steps = F.transform(x["found"], lambda m, k: F.length(m) + F.length(x["pieces"][k]))
        return F.transform(F.arrays_zip(running(steps).alias("at"), x["found"].alias("m"), F.slice(x["pieces"], 1, F.size(x["found"])).alias("p")), lambda y: let((y["at"] + F.length(y["p"])).cast("int"), lambda s: F.struct(s.alias("s"), (s + F.length(y["m"])).alias("e"), y["m"].alias("m"))))

    all_ = let(F.struct(found.alias("found"), pieces.alias("pieces")), placed_)
    measured = (lambda m: F.length(F.regexp_extract(m, pattern, group))) if group else F.length
    kept = F.filter(all_, lambda x: measured(x["m"]) >= least)
    # most texts have no match at all: a plain search is much cheaper than taking them apart
    return F.when(F.regexp_like(text, F.lit(pattern)), kept).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def encoding(token: Column) -> Column:
    """The encoding a token is written in, or null: its padding is no part of it."""
    body = F.rtrim(token, F.lit("="))
    like = lambda p: F.regexp_like(body, F.lit(p))
    hex_ = like(r"^(?:[0-9a-f]+|[0-9A-F]+)$") & like("[0-9]") & like("[a-fA-F]")
    base32 = like(r"^[A-Z2-7]+$") & like("[2-7]") & like("[A-Z]")
    base64 = like(r"^[A-Za-z0-9+/_-]+$") & like("[a-z]") & like("[A-Z]") & like("[0-9]")
    base36 = like(r"^(?:[0-9a-z]+|[0-9A-Z]+)$") & like("[0-9]") & like("[a-zA-Z]")
    return F.when(hex_, "hex").when(base32, "base32").when(base36, "base36").when(base64 & ~like("[+/_-]"), "base62").when(base64, "base64")


def numbers(token: Column, code: Column) -> Column:
    """The characters of a token as numbers from 0 within its encoding's alphabet."""
    body = F.translate(F.rtrim(token, F.lit("=")), "-_", "+/")
    body = F.when(code.isin("hex", "base36"), F.lower(body)).otherwise(body)
    alphabet = reduce(lambda acc, kv: F.when(code == kv[0], F.lit(kv[1])).otherwise(acc), ALPHABETS.items(), F.lit(None))
    return F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.instr(alphabet, c) - 1)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, z >= 0 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / 2.5066282746310002 * poly


def battery(x: Column, size: Column) -> Column:
    """p-value in [0, 1] of an array of numbers under uniformity over 0 .. size - 1."""
    n = F.size(x).cast("double")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)
    # cells of the alphabet, so many that five characters or more are expected in each, four at least
    cells = F.least(size, F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(F.lit(4.0), n / 5)))))
    width = lambda c: F.ceil((c + 1) * size / cells) - F.ceil(c * size / cells)
    squares = lambda cell: total(F.transform(F.array_distinct(cell), lambda c: F.pow(F.size(F.filter(cell, lambda y: y == c)).cast("double"), 2) / width(c)))
    df = cells - 1
    chi = let(F.transform(x, lambda v: F.floor(v * cells / size)), squares) * size / n - n
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    pairs = lambda a: F.zip_with(F.slice(a, 1, F.size(a) - 1), F.slice(a, 2, F.size(a) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    runs = 1 + total(F.transform(pairs(x), lambda s: ((s["p"] * 2 >= size) != (s["q"] * 2 >= size)).cast("double")))
    z_runs = (runs - (1 + (n - 1) / 2)) / (F.sqrt(n - 1) / 2)
    mean, var = (size - 1) / 2, (size * size - 1) / 12
    serial = total(F.transform(pairs(x), lambda s: (s["p"] - mean) * (s["q"] - mean))) / var
    z_serial = serial / F.sqrt(n - 1)
    worst = F.greatest(F.abs(z_chi), F.abs(z_runs), F.abs(z_serial))
    return 1 - F.pow(1 - F.least(F.lit(1.0), 2 * upper_tail(worst)), F.lit(3.0))


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, base and random spans (array<struct(s, k, kind, e)>) for each row of docs (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    kinds = [placed(spans(F.col("text"), p, g, n), k, kind) for k, (kind, (p, g, n)) in enumerate(BASE.items())]
    tested = F.transform(F.filter(spans(F.col("text"), CANDIDATE), lambda x: encoding(x["m"]).isNotNull()), scored)
    found = cut(d.select("doc_id", F.sort_array(F.concat(*kinds)).alias("base"), tested.alias("tested")), "secret-spans")
    cells = found.select(F.explode("tested").alias("t")).groupBy("t.code", "t.class", F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.count("*").alias("n"))
    # at most 5 * 32 rows whatever the input
    limit = [(r.code, r["class"], r.least) for r in thresholds(cells, fdr).collect()]
    at = lambda t: reduce(lambda acc, v: F.when((t["code"] == v[0]) & (t["class"] == v[1]), F.lit(v[2])).otherwise(acc), limit, F.lit(2.0))
    passed = F.filter("tested", lambda t: (t["p"] >= at(t)) & ~F.exists("base", lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"])))
    return found.select("doc_id", "base", placed(passed, len(BASE), "random").alias("random"))


def placed(found: Column, k: int, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), F.lit(kind).alias("kind"), x["e"].alias("e")))


def scored(x: Column) -> Column:
    """struct(s, e, code, class, p) of a candidate struct(s, e, m)."""

    def coded(code: Column) -> Column:
        size = reduce(lambda acc, kv: F.when(code == kv[0], F.lit(float(len(kv[1])))).otherwise(acc), ALPHABETS.items(), F.lit(None).cast("double"))
        p = let(F.struct(numbers(x["m"], code).alias("x"), size.alias("size")), lambda v: battery(v["x"], v["size"]))
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), code.alias("code"), F.floor(F.log2(F.length(x["m"]).cast("double"))).alias("class"), p.alias("p"))

    return let(encoding(x["m"]), coded)


def thresholds(cells: DataFrame, fdr: float = FDR) -> DataFrame:
    """code, class, least: by Storey's estimate from the histograms of p-values (code, class, bin, n), smoothed by PRIOR strings of each sort."""
    every = cells.select("code", "class").distinct().select("code", "class", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin"), F.lit(0).alias("n"))
    c = cells.select("code", "class", "bin", "n").union(every).groupBy("code", "class", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("code", "class")
    up = group.orderBy(F.col("bin").desc())
    half = F.sum(F.when(F.col("bin") >= BINS // 2, F.col("n")).otherwise(0)).over(group)
    c = c.withColumn("uniform", F.least(2.0 * half, F.sum("n").over(group).cast("double"))).withColumn("called", F.sum("n").over(up))
    # of the strings assumed beforehand, those the tests miss have p-values as uniform ones have; the others are in the first bin
    above = 1 - F.col("bin") / BINS
    missed = F.pow(F.lit(0.5), F.pow(F.lit(2.0), F.col("class").cast("double")) / HALF)
    other = PRIOR * F.when(F.col("bin") == 0, 1.0).otherwise(missed * above)
    wrong = F.greatest(F.lit(0.0), F.col("called") - F.col("uniform") * above) + other
    ok = wrong / (F.col("called") + PRIOR * above + other) <= fdr
    return c.groupBy("code", "class").agg(F.min(F.when(ok, F.col("bin") / BINS)).alias("least")).where("least IS NOT NULL")


def joined(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.sort_array(F.concat("base", "random"))).alias("spans"), F.size("random").cast("long").alias("n_random"))
