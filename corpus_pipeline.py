"""The corpus pipeline: documents through five operators, each stage a table of its own.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and
returns a DataFrame; run() writes it as Parquet in the shared folder and reads
it again as the next stage's docs. All but the last return the columns of docs.

ORACLE_SQL is None: the support vector machines of the first stage have no SQL
form. tests/llm/test_pipeline.py checks run() against a brute-force version.

Edge cases: null text, empty text and text without a letter go in the first stage; a null lang or source keeps its
document; rows with equal doc_id and text stay together or go together; a null doc_id passes the near-dedup
stage, as nothing can name it; ties go to the smaller doc_id; an empty table gives an empty result with the same columns; further
columns, whatever their names, pass all stages but the last, which returns the columns of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.llm.common import WORD, table
from ringfold.llm.op1_mix import mix
from ringfold.llm.op3_decontaminate import decontaminate
from ringfold.llm.op7_minhash import near_duplicates
from ringfold.llm.op8_language import fit, recognised, training_rows
from ringfold.llm.op10_lines import dedup_lines
from ringfold.plans.shared import cut

#: Percent of five-word shingles that near copies share at least; the 85 of op7_minhash is that query's alone.
NEAR = 80

#: Least words of a repeated line or run of lines that the line stage removes; the 25 of op10_lines is that query's, as its SQL.
LINE_WORDS = 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language the model has learned; those predicted `und` go."""
    return recognised(docs, fit(training_rows(docs)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines of LINE_WORDS words or more are removed; a document with no word left goes."""
    out = dedup_lines(docs, LINE_WORDS)
    out = out.where((F.col(f"`{out.columns[-1]}`") == 0) | F.regexp_like("text", F.lit(WORD)))
    fix = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return out.withColumns(fix).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (NEAR percent of shingles or more) stays: the one with the smallest doc_id."""
    gone = near_duplicates(docs, NEAR).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: how many copies of each document that is left, and the words they take."""
    return mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
