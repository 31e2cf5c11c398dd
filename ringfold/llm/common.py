"""What the operators of this subpackage share: words, tables and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space ones; bytes.split() parts UTF-8 at the same places.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(lengths: Column, block: int = 64) -> Column:
    """For each entry of an array of numbers the sum of those before it, in linear time: sums of blocks, then sums within a block."""
    add = lambda acc, x: acc + x
    zero = F.lit(0).cast("long")

    def before(sums: Column) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(sums, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    def of(all_: Column) -> Column:
        firsts = F.filter(F.transform(all_, lambda _, k: F.when(k % block == 0, k + 1)), lambda k: k.isNotNull())
        sums = F.transform(firsts, lambda k: F.aggregate(F.slice(all_, k, block), zero, add))
        place = lambda k: F.floor(k / block).cast("int")
        return let(before(sums), lambda p: F.transform(all_, lambda _, k: F.element_at(p, place(k) + 1) + F.aggregate(F.slice(all_, place(k) * block + 1, k % block), zero, add)))

    return let(F.transform(lengths, lambda x: x.cast("long")), of)


SALTS = 16


def salted(rows: DataFrame, few: DataFrame, keys: list[str], by: list[str], how: str) -> DataFrame:
    """rows joined with few, which has each key once; the rows of a key are dealt to SALTS tasks by the columns `by`.

    few is SALTS times its table here, which Spark's size estimate does not see, so it is never broadcast.
    """
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    few = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    return rows.join(few, [*keys, "__salt"], how).drop("__salt")


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def bounded(spark: SparkSession) -> None:
    """Arrow batches of 500 rows and 16 MB at most. Spark reads this when the plan runs, so it stays set in the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


#: An output batch ends at so many rows or so many characters, bytes and entries.
ROWS, WEIGHT = 500, 8 << 20


def map_rows(df: DataFrame, fn: Callable[[Iterable[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """mapInArrow with a generator over row tuples; batches in and out are bounded by rows and by size.

    fn gets an iterator over the input rows of one task and yields output tuples.
    """
    spark = df.sparkSession
    bounded(spark)
    arrow = pa.schema([(f.name, _arrow(f.dataType.simpleString())) for f in spark.createDataFrame([], schema).schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        held: list[tuple] = []
        weight = 0
        for out in fn(rows()):
            held.append(out)
            weight += sum(len(x) for x in out if isinstance(x, (str, bytes, list)))
            if len(held) >= ROWS or weight >= WEIGHT:
                yield _batch(held, arrow)
                held, weight = [], 0
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, column: str, keep: Callable[[], Callable[[object], bool]]) -> DataFrame:
    """The rows of df whose value in `column` passes; whole Arrow batches stay as they are otherwise.

    keep() is called once a task and returns the test.
    """
    bounded(df.sparkSession)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = keep()
        for batch in batches:
            yield batch.filter(pa.array([test(v) for v in batch.column(at).to_pylist()], type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow(kind: str) -> pa.DataType:
    plain = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return plain[kind]
