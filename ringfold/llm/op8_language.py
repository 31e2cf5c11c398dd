"""Language identification by hierarchical discrimination.

A text becomes counts of hashed byte n-grams of its words (one to four bytes,
ASCII letters lower-cased). A linear one-versus-rest stage picks the language
family; within a family of several languages, one linear support vector machine
for each pair of languages votes, with summed margins as the tie-break.

The families come from a small fixed table of language codes; a code that is not in it
is a family of its own. Models are trained in one executor task from at most SAMPLE labelled texts, or
LEAST a language where that is more (the documented bound: with four languages 500 each): in each language
the distinct texts with the smallest hashes. Every language that has a labelled text with a letter is
learned, however many languages or copies there are. Everything else covers all rows and whole texts;
what comes back to the driver is the weights.

Edge cases: null text or text without a letter is `und` with score 0; a table
without labelled rows predicts `und` throughout; one known language alone is
predicted with score 1; repeated rows get equal predictions; further columns
are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringfold.llm.common import filter_rows, map_rows, table, utf8
from ringfold.plans.shared import cut

SAMPLE = 2000
LEAST = 16
BITS = 12
UND = "und"

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
}


def family(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang.lower() in codes), f"={lang}")


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:65] = 32  # blanks, digits and signs part words
_FOLD[91:97] = 32
_FOLD[123:128] = 32


def features(text: str, bits: int = BITS, block: int = 1 << 20) -> np.ndarray:
    """Counts of hashed 1- to 4-byte grams of the whole text, float32, square-rooted and of length 1."""
    data = np.frombuffer(b" " + utf8(text) + b"   ", dtype=np.uint8)
    counts = np.zeros(1 << bits, dtype=np.int64)
    for at in range(0, len(data) - 3, block):  # bounded memory for texts of any length
        b = _FOLD[data[at : at + block + 3]].astype(np.uint32)
        n = len(b) - 3
        gram = np.zeros(n, dtype=np.uint32)
        for k in range(4):
            gram = (gram << np.uint32(8)) | b[k : k + n]
            mixed = (gram + np.uint32(k)) * np.uint32(2654435761)
            mixed ^= mixed >> np.uint32(15)
            counts += np.bincount((mixed * np.uint32(2246822519)) >> np.uint32(32 - bits), minlength=1 << bits)
    x = np.sqrt(counts.astype(np.float32))
    return x / (np.linalg.norm(x) or 1)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Machines:
    """Linear support vector machines side by side, one a column of y: averaged subgradient steps on the hinge loss with L2 decay."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, decay: float = 1e-4, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        w, mean = np.zeros((x.shape[1] + 1, y.shape[1])), np.zeros((x.shape[1] + 1, y.shape[1]))
        x = np.hstack([x, np.full((len(x), 1), 0.1, dtype=x.dtype)])
        weight = np.where(y > 0, len(y) / (2 * np.maximum(1, (y > 0).sum(axis=0))), len(y) / (2 * np.maximum(1, (y < 0).sum(axis=0))))
        step, seen = 0, 0
        for epoch in range(epochs):
            for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 32)):
                step += 1
                rate = 4.0 / (1 + step * 0.01)
                bad = y[rows] * (x[rows] @ w) < 1
                w *= 1 - rate * decay
                if bad.any():
                    w += rate / len(rows) * (x[rows].T @ (bad * weight[rows] * y[rows]))
                if epoch >= epochs // 3:
                    mean += w
                    seen += 1
        w = mean / max(1, seen)
        self.w, self.b = w[:-1].T.astype(np.float32), w[-1] * 0.1

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.w @ x + self.b


class Hierarchy:
    """First the family, then pairs of languages within it."""

    def __init__(self, x: np.ndarray, langs: list[str]) -> None:
        names, lang = sorted(set(langs)), np.array(langs, dtype=object)
        groups: dict[str, list[str]] = {}
        for name in names:
            groups.setdefault(family(name), []).append(name)
        self.groups = groups
        fam = np.array([family(v) for v in langs], dtype=object)
        self.first = Machines(x, np.where(fam[:, None] == np.array(list(groups), dtype=object), 1.0, -1.0)) if len(groups) > 1 else None
        self.pairs: dict[tuple[str, str], Machines] = {}
        for members in groups.values():
            for a, b in combinations(members, 2):
                rows = (lang == a) | (lang == b)
                self.pairs[a, b] = Machines(x[rows], np.where(lang[rows] == a, 1.0, -1.0)[:, None])

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The language, and the weaker of the two stages' logistic scores."""
        scores, group = [], next(iter(self.groups))
        if self.first:
            margins = self.first.margins(x)
            best, second = np.argsort(-margins, kind="stable")[:2]
            group = list(self.groups)[best]
            scores.append(float(margins[best] - margins[second]))
        members = self.groups[group]
        votes, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for a, b in combinations(members, 2):
            m = float(self.pairs[a, b].margins(x)[0])
            votes[a if m >= 0 else b] += 1
            sums[a], sums[b] = sums[a] + m, sums[b] - m
        ranked = sorted(members, key=lambda v: (-votes[v], -sums[v], v))
        if len(members) > 1:
            best, second = ranked[:2]
            m = float(self.pairs[min(best, second), max(best, second)].margins(x)[0])
            scores.append(abs(m) * 2)
        return ranked[0], float(min((1 / (1 + np.exp(-2 * s)) for s in scores), default=1.0))


def fit(labelled: DataFrame, sample: int = SAMPLE, least: int = LEAST) -> Hierarchy | None:
    """Train from (doc_id, text, lang) in one task; the driver gets the weights."""
    keyed = labelled.where(F.col("lang").isNotNull() & F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"\p{L}"))).select("lang", "text", F.xxhash64("text").alias("key"))
    # a share of the hash space for each language by how many different texts it has; few texts are all taken
    kinds = cut(keyed.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")), "language-kinds")
    each = F.greatest(F.lit(least), F.floor(F.lit(sample) / F.greatest(F.lit(1), F.count("*").over(Window.partitionBy()))))
    edges = kinds.withColumn("each", each).select(F.col("lang").alias("__lang"), "each", F.when(F.col("n") > 4 * F.col("each"), 1.5 * F.col("each") / F.col("n")).otherwise(1.0).alias("edge"))
    picked = keyed.join(edges, F.col("lang") == F.col("__lang"))
    picked = picked.where(F.pmod("key", F.lit(1 << 20)) < F.col("edge") * (1 << 20)).groupBy("lang", "key").agg(F.first("text").alias("text"), F.first("each").alias("each"))
    picked = picked.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 20)), "key"))).where(F.col("nth") <= F.col("each"))
    vectors = map_rows(picked.select("lang", "text", "key"), _counted, "lang string, key long, x binary")
    weights = map_rows(cut(vectors, "language-sample").coalesce(1), _trained, "model binary").collect()
    return pickle.loads(bytes(weights[0].model)) if weights else None


def _counted(rows: Iterable[tuple]) -> Iterator[tuple]:
    for lang, text, key in rows:
        if has_letter(text):
            yield lang, key, features(text).tobytes()


def _trained(rows: Iterable[tuple]) -> Iterator[tuple]:
    got = sorted(rows)
    if got:
        yield (pickle.dumps(Hierarchy(np.stack([np.frombuffer(x, dtype=np.float32) for _, _, x in got]), [v for v, _, _ in got])),)


def predictor(model: Hierarchy | None) -> Callable[[str | None], tuple[str, float]]:
    def predict(text: str | None) -> tuple[str, float]:
        return model.predict(features(text)) if model and has_letter(text) else (UND, 0.0)

    return predict


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, model: Hierarchy | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, lang_pred and score for each row of docs. The model is a few hundred KB at four languages."""
    predict = predictor(model)

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for text, *rest in rows:
            yield (*rest, *predict(text))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return map_rows(docs.select(F.col("text").alias("__text"), *keep), run, f"{schema}, lang_pred string, score double")


def recognised(docs: DataFrame, model: Hierarchy | None) -> DataFrame:
    """docs without the documents that are rejected: those predicted `und`."""
    return filter_rows(docs, "text", _Recognised(model))


class _Recognised:
    def __init__(self, model: Hierarchy | None) -> None:
        self.model = model

    def __call__(self) -> Callable[[str | None], bool]:
        predict = predictor(self.model)
        return lambda text: predict(text)[0] != UND


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "text", "lang")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.withColumn("held_out", held_out()), fit(training_rows(docs)), ("doc_id", "held_out"))
    return found.select(F.col("doc_id").cast("long"), "held_out", "lang_pred", "score")
