"""Language identification in two steps: the family, then the language within it.

Texts become hashed counts of letter pairs and triples.  A multinomial logistic model
names the family; inside a family every two languages have a linear support vector
machine of their own and the language that wins most of them is taken.  All models are
trained here with Spark ML on a sample of the labelled rows, at most
``SAMPLE_PER_LANGUAGE`` of each language, taken by a hash of the doc_id so that it is
the same on every run.  Predictions read whole texts, never the label columns.

Defined results: a null text, or one without any letter, is ``und`` with score 0, and so
is every text if no language could be learned; one learned language is predicted for
all others, as far as its family goes; of languages that win equally many duels the one with
the larger sum of beliefs is taken, then the first by name; rows with null lang or null doc_id are not
learned from; equal texts get equal results; an empty table gives an empty result; the
columns lang_pred and score replace any of these names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawl.llm.common import free_name, stored

SAMPLE_PER_LANGUAGE = 500
PAIR_SLOTS, TRIPLE_SLOTS = 512, 1536
PIECE_BYTES = 1 << 20
MAX_ITER, REG = 25, 1e-3
UNKNOWN = "und"

#: Languages of a family; any other language is a family of its own.
FAMILIES: dict[str, tuple[str, ...]] = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "bs"),
    "indo-aryan": ("hi", "bn", "mr", "gu", "pa", "ne", "ur", "si"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt", "am"),
    "sinitic": ("zh", "yue"),
    "austronesian": ("id", "ms", "tl", "jv"),
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
_NOT_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0], lang)


def features(text: str) -> np.ndarray:
    """Square roots of the slot counts, scaled to length one.  Counted piece by piece."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_NOT_LETTERS).split()) + b" "
    slots = PAIR_SLOTS + TRIPLE_SLOTS
    total = np.zeros(slots, np.int64)
    for at in range(0, len(raw) - 1, PIECE_BYTES):
        a = np.frombuffer(raw, np.uint8, min(PIECE_BYTES + 2, len(raw) - at), at).astype(np.uint32)
        pairs = (a[:-1] * 2654435761 + a[1:] * 40503) >> 7
        triples = (pairs[:len(a) - 2] * 31 + a[2:] * 2246822519) >> 9
        total += np.bincount(pairs[:PIECE_BYTES] % PAIR_SLOTS, minlength=slots)
        total += np.bincount(PAIR_SLOTS + triples[:PIECE_BYTES] % TRIPLE_SLOTS, minlength=slots)
    x = np.sqrt(total).astype(np.float32)
    return x / max(float(np.linalg.norm(x)), 1e-9)


@dataclass
class LanguageModel:
    """Family weights (rows of ``family_w``), and for each family its languages and
    the weights of each pair: positive margins speak for the second."""

    families: list[str] = field(default_factory=list)
    family_w: np.ndarray | None = None
    family_b: np.ndarray | None = None
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[str, list[tuple[int, int, np.ndarray, float]]] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x = features(text)
        family, score = 0, 1.0
        if self.family_w is not None:
            z = self.family_w @ x + self.family_b
            p = np.exp(z - z.max())
            family, score = int(p.argmax()), float(p.max() / p.sum())
        name = self.families[family]
        langs = self.languages[name]
        votes, belief = np.zeros(len(langs)), np.zeros(len(langs))
        for i, j, w, b in self.pairs[name]:
            for_second = 1.0 / (1.0 + np.exp(-2.0 * np.clip(w @ x + b, -30, 30)))
            votes[j if for_second > 0.5 else i] += 1
            belief[j] += for_second
            belief[i] += 1.0 - for_second
        best = int(np.lexsort((-np.arange(len(langs)), belief, votes))[-1])
        return langs[best], float(min(1.0, score * (belief[best] / (len(langs) - 1) if len(langs) > 1 else 1.0)))


def training_sample(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows ``(doc_id, text, lang)`` of each language, those
    with the smallest hashes of their doc_id.  A cut on the hash, set from the
    language's count to let about twice as many through, comes before the sort, so
    that no group in it grows with the input."""
    share = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    hashed = labelled.withColumn("h", F.xxhash64(F.col("doc_id"), F.lit("sample")))
    unit = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    return (hashed.join(F.broadcast(share), "lang")  # a row for each language
            .where(unit < 2.0 * per_language / F.col("n")).withColumn("r", F.row_number().over(first))
            .where(F.col("r") <= per_language).select("doc_id", "text", "lang"))


def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fit on rows ``(doc_id, text, lang)``; rows without lang, doc_id or letters are left out."""
    @F.pandas_udf("array<float>")
    def vector(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t).tolist())

    usable = labelled.where("lang is not null and doc_id is not null").where(F.col("text").rlike(r"\p{L}"))
    sample = stored(training_sample(usable, per_language).select("lang", vector("text").alias("x")), "language-sample")
    langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
    model = LanguageModel(sorted({family_of(x) for x in langs}))
    model.languages = {f: [x for x in langs if family_of(x) == f] for f in model.families}
    points = sample.select("lang", array_to_vector("x").alias("features"))

    def numbered(number: dict[str, int]) -> DataFrame:
        pick = F.create_map(*[F.lit(v) for kv in number.items() for v in kv])
        return points.where(F.col("lang").isin(*number)).select(
            "features", F.try_element_at(pick, F.col("lang")).cast("double").alias("label"))

    if len(model.families) > 1:
        rows = numbered({x: model.families.index(family_of(x)) for x in langs})
        fit = LogisticRegression(maxIter=MAX_ITER, regParam=REG, family="multinomial").fit(rows)
        model.family_w = fit.coefficientMatrix.toArray().astype(np.float32)
        model.family_b = fit.interceptVector.toArray().astype(np.float32)
    for f, own in model.languages.items():
        model.pairs[f] = []
        for i in range(len(own)):
            for j in range(i + 1, len(own)):
                fit = LinearSVC(maxIter=MAX_ITER, regParam=REG).fit(numbered({own[i]: 0, own[j]: 1}))
                model.pairs[f].append((i, j, fit.coefficients.toArray().astype(np.float32), float(fit.intercept)))
    return model


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    @F.pandas_udf("lang_pred string, score double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.DataFrame([model.predict(t) for t in s], columns=["lang_pred", "score"])

    guess = free_name(docs, "__guess")
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.select(*kept, of(F.col(text)).alias(guess)).select(*kept, f"{guess}.lang_pred", f"{guess}.score")
