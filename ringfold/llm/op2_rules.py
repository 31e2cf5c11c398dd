"""Quality rules as a bitmask ledger.

Every rule is evaluated once a document. The ledger keeps the measurements and
one long whose bit k says that rule k failed. A policy is a versioned set of
rules; applying it is `mask & policy = 0`, so a new policy or an ablation needs
no second look at the texts. ablation() aggregates the ledger bitwise: how many
documents each rule fails, and how many it alone fails, under a policy.

Measurements are counted in Python (hashing five-word windows is no SQL
strength) on Arrow batches; the rules are Column expressions over them.

Edge cases: null or empty text has no words, all measurements 0, and fails the
base rules; repeated rows are measured each by itself; an empty table gives an
empty ledger; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.llm.common import BLANKS, map_rows, table, utf8

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits", "n_stutter")

#: Rule k is bit k and fails where its condition, over integers alone, is true.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("short_words", "10 * word_chars < 20 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("digits", "100 * n_digits > 60 * word_chars"),
    ("stutter", "100 * n_stutter > 30 * n_words"),
)
BASE = ("few_words", "repeated_windows")
#: Policies by version; kept means that no rule of the policy failed.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": tuple(name for name, _ in RULES),
}
CURRENT = "v2"


def measure(text: str | None) -> tuple[int, ...]:
    """MEASURES of one whole text."""
    if not text:
        return (0,) * len(MEASURES)
    words = utf8(text).split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    chars = len(text) - sum(map(text.count, BLANKS))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated(words), len(lines), sum(map(text.count, "0123456789")), sum(map(eq, words, words[1:]))


def repeated(words: list[bytes], n: int = 5) -> int:
    """How many words stand in an n-word window that occurs twice or more."""
    total = len(words) - n + 1
    if total < 2 or len(set(zip(*(words[i:] for i in range(n)), strict=False))) == total:
        return 0
    times = Counter(zip(*(words[i:] for i in range(n)), strict=False))
    count, upto = 0, 0
    for i, window in enumerate(zip(*(words[i:] for i in range(n)), strict=False)):
        if times[window] > 1:
            count += i + n - max(i, upto)
            upto = i + n
    return count


def _measured(rows: Iterable[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        yield (doc_id, *measure(text))


def policy_mask(version: str = CURRENT) -> int:
    return sum(1 << k for k, (name, _) in enumerate(RULES) if name in POLICIES[version])


def passes(mask: Column, version: str = CURRENT) -> Column:
    return mask.bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and `mask`, one row for each row of docs."""
    measured = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), _measured, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, condition) in enumerate(RULES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return measured.withColumn("mask", mask)


def ablation(book: DataFrame, version: str = CURRENT) -> DataFrame:
    """rule, n_failed, n_only (failed by it alone under the policy): one aggregation with map-side sums."""
    on = book.select(F.col("mask").bitwiseAND(F.lit(policy_mask(version)).cast("long")).alias("m"))
    sums = on.groupBy("m").count()
    rules = [F.struct(F.lit(name).alias("rule"), F.lit(1 << k).cast("long").alias("bit")) for k, (name, _) in enumerate(RULES) if name in POLICIES[version]]
    each = sums.select("m", "count", F.explode(F.array(*rules)).alias("r")).select("m", "count", "r.*")
    failed = F.col("m").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(F.sum(F.when(failed, F.col("count")).otherwise(0)).alias("n_failed"), F.sum(F.when(F.col("m") == F.col("bit"), F.col("count")).otherwise(0)).alias("n_only"))


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(table(spark, sf_dir, "documents"))
    return book.select("doc_id", *MEASURES[:5], (~passes(F.col("mask"), "base")).alias("base_failed"), passes(F.col("mask")).alias("kept"), "mask")


def _sql() -> str:
    bits = " + ".join(f"CASE WHEN {condition} THEN {1 << k} ELSE 0 END" for k, (_, condition) in enumerate(RULES))
    word, char = r"[^\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
a AS (SELECT r, doc_id, text, regexp_extract_all(text, '{word}') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{char}')) AS l FROM t),
p AS (SELECT r, w, len(w) AS n, unnest(range(1, len(w) - 3)) AS i FROM a WHERE len(w) > 4),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS c FROM p),
q AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM g, range(5) o(k) WHERE c > 1 GROUP BY r),
m AS (SELECT a.r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
  length(regexp_replace(text, '[^0-9]+', '', 'g'))::BIGINT AS n_digits,
  len(list_filter(range(1, len(w)), lambda k: w[k] = w[k+1]))::BIGINT AS n_stutter FROM a LEFT JOIN q USING (r)),
b AS (SELECT *, ({bits})::BIGINT AS mask FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (mask & {policy_mask("base")}) <> 0 AS base_failed, (mask & {policy_mask()}) = 0 AS kept, mask FROM b"""


SQL = _sql()
