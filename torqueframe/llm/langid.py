"""Language identification by hierarchical discrimination.

One-versus-one linear SVMs first choose among language families, then among
the languages of that family, where relatives are hard to tell apart. Features
are hashed byte trigrams of the whole text's letters, scaled to unit length.
The SVMs are fitted by Spark ML on a bounded sample: at most about
``max_per_lang`` labelled rows of each language, chosen by a hash of the id.
Only text and label are learned from; text alone is predicted from.

A text that is null, empty or without a letter is ``und`` with score 0, as is
every text if no labelled row can be learned from. With one known language all
others texts are of it, score 1. Rows whose label or id is null are not learned
from; repeated rows count as often as they occur. Very long texts are read
whole. The result adds columns of its own names to no other table than its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import written

UNKNOWN = "und"

# fixed values: ISO 639-1 codes of languages that share a family; a language
# that is not listed is a family of its own
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "bn", "mr", "ur", "pa", "gu", "ne"],
    "semitic": ["ar", "he", "mt"],
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

DIM = 2048

# letters stay (ASCII ones in lower case), every other ASCII byte is a blank
_BYTE = np.arange(256, dtype=np.uint32)
_BYTE[65:91] += 32
_BYTE[:65] = _BYTE[91:97] = _BYTE[123:128] = 32


def features(texts: pa.Array):
    """Yield (first row, matrix of documents by DIM, unit rows or zero)."""
    for row, data, offsets in T.runs(texts):
        n = len(offsets) - 1
        b = _BYTE[data]
        if len(b) < 3:
            yield row, np.zeros((n, DIM), dtype=np.float32)
            continue
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        doc = np.repeat(np.arange(n), np.diff(offsets))
        ok = (doc[2:] == doc[:-2]) & (code != 0x202020)
        slot = (code * np.uint32(2654435761)) >> np.uint32(21)
        x = np.bincount(doc[:-2][ok] * DIM + slot[ok], minlength=n * DIM).reshape(n, DIM)
        x = np.sqrt(x.astype(np.float32))
        yield row, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    families: list[tuple[str, list[str]]]
    duels: dict[tuple[str, str], tuple[np.ndarray, float]]  # margin > 0: the first

    def choose(self, names: list[str], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the index of the winner (votes, then margins) and how sure its duels were."""
        votes = np.zeros((len(x), len(names)))
        sure = np.ones((len(x), len(names)))
        for i, j in combinations(range(len(names)), 2):
            w, b = self.duels[names[i], names[j]]
            p = 1 / (1 + np.exp(-3 * np.clip(x @ w + b, -20, 20)))
            votes[:, i] += (p >= 0.5) + p * 1e-3
            votes[:, j] += (p < 0.5) + (1 - p) * 1e-3
            sure[:, i] *= p
            sure[:, j] *= 1 - p
        best = votes.argmax(axis=1)
        return best, sure[np.arange(len(x)), best]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        langs = np.full(len(x), UNKNOWN, dtype=object)
        family, score = self.choose([f for f, _ in self.families], x)
        for k, (_, members) in enumerate(self.families):
            own = np.flatnonzero(family == k)
            if len(own):
                lang, sure = self.choose(members, x[own])
                langs[own] = np.asarray(members, dtype=object)[lang]
                score[own] *= sure
        return langs, score


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_per_lang: int = 1000, reg: float = 1e-4, max_iter: int = 40) -> Model | None:
    """Fit the hierarchy on rows of known language; None without any."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
                          & F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    rows = rows.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, max_per_lang / n))])
    part = F.pmod(F.xxhash64("i", F.lit("language sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))

    @F.arrow_udf("array<float>")
    def vector(t: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array(list(x), pa.list_(pa.float32())) for _, x in features(t)]
                                or [pa.array([], pa.list_(pa.float32()))])

    train = written(rows.where(part < F.element_at(share, F.col("l"))).select("l", vector("t").alias("x")),
                    "language-sample").select("l", array_to_vector(F.col("x").cast("array<double>")).alias("features"))
    groups: dict[str, list[str]] = {}
    for lang in sorted(counts):
        groups.setdefault(FAMILY_OF.get(lang, f"={lang}"), []).append(lang)
    names = sorted(groups)
    train = train.persist()
    duels = {}
    try:
        for a, b, own, other in ([(f, g, groups[f], groups[g]) for f, g in combinations(names, 2)]
                                 + [(p, q, [p], [q]) for f in names for p, q in combinations(groups[f], 2)]):
            pair = train.where(F.col("l").isin(own + other)).select(
                "features", F.col("l").isin(own).cast("double").alias("label"))
            svm = LinearSVC(regParam=reg, maxIter=max_iter, standardization=False).fit(pair)
            duels[a, b] = (svm.coefficients.toArray().astype(np.float32), float(svm.intercept))
    finally:
        train.unpersist()
    return Model([(f, groups[f]) for f in names], duels)


def predicted(text: Column, model: Model | None) -> Column:
    """Struct of lang_pred and score of a text column."""
    out = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def predict(t: pa.Array) -> pa.Array:
        langs, scores = [], []
        for _, x in features(t):
            lang, score = model.predict(x)
            langs.extend(lang)
            scores.extend(score)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                          fields=list(out))

    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return none
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), predict(text)).otherwise(none)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column ``language`` (lang_pred, score), which
    replaces a column of that name."""
    return docs.withColumn("language", predicted(F.col(text_col), model))
