"""The corpus pipeline against a brute-force version of its stages on a small fixture."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ringfold.llm import op3_decontaminate, op7_minhash, op10_lines
from ringfold.llm.common import table

from .test_operators import groups, prose, water


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    bench = [(i, prose(rng, 25)) for i in range(12)]
    rows = [(i, prose(rng, rng.randrange(20, 90)), "en", f"s{i % 4}", None) for i in range(80)]
    base = prose(rng, 150).split()
    for i in range(10):
        w = list(base)
        w[10 * i] = "edited"
        rows.append((100 + i, " ".join(w), "en", "s1", None))
    rows += [(200, rows[0][1], "en", "s0", None), (201, "12 34 !!", "en", "s0", None), (202, None, None, None, None), (203, prose(rng, 30) + " " + bench[4][1] + " " + prose(rng, 30), "en", "s2", None), (204, rows[5][1] + "\nown words here", "en", "s3", None)]
    path = f"file://{tmp_path_factory.mktemp('corpus')}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, bench


def brute(rows, bench):
    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(r[0], r[1]) for r in kept])
    cleaned = dict(con.sql(f"SELECT doc_id, text FROM ({op10_lines.SQL})").fetchall())
    kept = [(r[0], cleaned[r[0]], r[3]) for r in kept if cleaned[r[0]].split()]
    parts = groups([(d, t) for d, t, _ in kept])
    kept = [r for r in kept if parts[r[0]] == r[0]]
    has = lambda t: any(b" ".join(op3_decontaminate.words(b)) in b" ".join(op3_decontaminate.words(t)) for _, b in bench)
    return [r for r in kept if not has(r[1])]


def test_stages_match_brute_force(spark, folder):
    path, rows, bench = folder
    got = corpus_pipeline.run(spark, path).collect()
    want = brute(rows, bench)
    assert {r.doc_id for r in got} == {d for d, _, _ in want}
    assert {200, 201, 202, 203}.isdisjoint(r.doc_id for r in got)
    size = {d: len(t.encode().split()) for d, t, _ in want}
    by = {}
    for d, _, s in want:
        by[s] = by.get(s, 0) + size[d]
    target = water(by)
    for r in got:
        assert r.size == size[r.doc_id] and r.target == pytest.approx(target[r.source]) and r.taken <= 3 * r.size


def test_stage_columns_and_emptiness(spark, folder):
    path, *_ = folder
    docs = table(spark, path, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "source_mixing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), path)
        assert out.columns == docs.columns and out.count() == 0, name


def test_near_dedup_keeps_one_of_each_group(spark, folder):
    path, rows, _ = folder
    out = corpus_pipeline.near_dedup(spark, table(spark, path, "documents"), path)
    parts = groups([(r[0], r[1]) for r in rows])
    assert {r.doc_id for r in out.collect()} == {d for d, p in parts.items() if d == p}
    assert op7_minhash.PERCENT == 85


def test_near_dedup_removes_copies_between_80_and_85(spark):
    """Each copy shares 0.80 to 0.85 of its shingles with the original, so a threshold of 85 keeps it."""
    rng = random.Random(22)
    rows = []
    for i in range(40):
        w = prose(rng, 100).split()
        rows.append((2 * i, " ".join(w)))
        w[33] = w[66] = "edited"
        rows.append((2 * i + 1, " ".join(w)))
        a, b = (op7_minhash.shingles(t) for _, t in rows[-2:])
        assert 80 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {2 * i for i in range(40)}
    assert all(r.kept for r in op7_minhash.near_duplicates(docs).collect())
    assert (op7_minhash.matches(85), op7_minhash.matches(80)) == (40, 35)


def test_line_dedup_removes_common_short_lines(spark):
    """One line of nine words in every document stays in the first alone; lines of under LINE_WORDS words that repeat alone stay."""
    rng = random.Random(24)
    line = prose(rng, 9)
    rows = [(i, f"{prose(rng, 12)}\n{line}\n{prose(rng, 12)}\nshort line\n{prose(rng, 12)}") for i in range(50)]
    got = dict(corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect())
    assert [i for i, t in sorted(got.items()) if line in t.split("\n")] == [0]
    assert all(got[i].split("\n") == [x for x in t.split("\n") if i == 0 or x != line] for i, t in rows)


def test_run_on_odd_rows_and_on_nothing(spark, tmp_path):
    """Nulls, repeats, ties, a long text and columns with names that the stages use themselves."""
    rng = random.Random(41)
    long, same = prose(rng, 20_000), prose(rng, 40)
    rows = [(1, same, "en", "s"), (1, same, "en", "s"), (2, same, None, None), (None, prose(rng, 40), "en", None), (None, None, None, None), (4, "", "en", "s"), (5, long, "en", "s"), (6, long + " end", "de", "t"), (7, prose(rng, 40), "de", "t")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, rep long, digest string, `__text` string, gone string"
    spark.createDataFrame([(*r, 0, 1, "x", "y", "z") for r in rows], schema).write.parquet(f"file://{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], schema).write.parquet(f"file://{tmp_path}/b/documents.parquet")
    for d in "ab":
        spark.createDataFrame([(1, prose(rng, 30))], "item_id long, text string").write.parquet(f"file://{tmp_path}/{d}/benchmark.parquet")
    got = sorted((r.doc_id or 0, r.size) for r in corpus_pipeline.run(spark, f"file://{tmp_path}/a").collect())
    assert got == [(0, 40), (1, 40), (1, 40), (5, 20_000), (7, 40)]
    empty = corpus_pipeline.run(spark, f"file://{tmp_path}/b")
    assert empty.count() == 0 and "taken" in empty.columns
