"""Language identification by nearest centroid.

A text becomes a vector of character n-grams hashed to ``DIMENSIONS`` places, damped counts times inverse document
frequencies, of length one. Each language has a few centroids, clustered from a bounded sample; the language of the
nearest centroid by cosine wins, and a text too far from it is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import hand_back, spare_name

DIMENSIONS = 4096
GRAMS = (1, 2, 3)
# Labelled texts per language, as expected number, that centroids are fitted on. All texts count for frequencies.
SAMPLE = 600
CENTROIDS = 4
# A text is rejected if its cosine to the nearest centroid is below this share of what the lowest hundredth of the sample
# has to its own centroid. A text of fewer than FULL_GRAMS different n-grams can only come so near, so that for it the
# limit falls with the root of their number.
REJECT_QUANTILE = 0.01
REJECT_SHARE = 0.65
FULL_GRAMS = 150
# Characters of a text that are counted at once.
PIECE = 1 << 18
UNDETERMINED = "und"

_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point, itself if it is a letter, else 32."""
    global _LETTERS
    if _LETTERS is None:
        codes = np.arange(0x110000, dtype=np.uint32)
        is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        _LETTERS = np.where(is_letter, codes, 32).astype(np.uint32)
    return _LETTERS


def gram_counts(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Counts of the hashed n-grams of a text in lower case, anything but letters read as a blank; None without letter.

    Long texts are counted piece by piece, each with the last characters of the one before, so that the arrays stay small.
    """
    text = (text or "").lower()
    counts = np.zeros(dimensions, dtype=np.int64)
    before, new, lettered = np.array([32], dtype=np.uint32), 0, False
    for at in range(0, len(text), PIECE):
        raw = text[at : at + PIECE].encode("utf-32-le", "surrogatepass")
        codes = letters()[np.frombuffer(raw, dtype=np.uint32)]
        lettered = lettered or bool((codes != 32).any())
        end = [32] if at + PIECE >= len(text) else []
        codes = np.concatenate((before, codes, end)).astype(np.uint32)
        codes = codes[(codes != 32) | np.concatenate(([True], codes[:-1] != 32))]  # runs of blanks as one
        hashed = np.zeros(len(codes), dtype=np.uint32)
        for n in range(1, max(GRAMS) + 1):
            hashed = hashed[: len(codes) - n + 1] * np.uint32(0x9E3779B1) + codes[n - 1 :]
            fresh = hashed[max(new - n + 1, 0) :]  # the others end in the piece before
            if n in GRAMS and len(fresh):
                mixed = (fresh ^ (fresh >> np.uint32(15))) * np.uint32(0x85EBCA77)
                mixed = (mixed ^ (mixed >> np.uint32(13))) % np.uint32(dimensions)
                counts += np.bincount(mixed, minlength=dimensions)
        before = codes[1 - max(GRAMS) :]
        new = len(before)
    return counts if lettered else None


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vector of damped counts times inverse document frequencies."""
    v = np.log1p(counts) * idf
    norm = np.sqrt((v * v).sum())
    return (v / norm if norm > 0 else v).astype(np.float32)


def cluster(vectors: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Unit centroids by k-means on the sphere; starts from rows far apart, so it is deterministic."""
    centroids = [vectors.sum(axis=0)]
    nearest = vectors @ (centroids[0] / max(np.linalg.norm(centroids[0]), 1e-12))
    chosen = [vectors[int(nearest.argmax())]]
    for _ in range(min(k, len(vectors)) - 1):
        closest = np.max(vectors @ np.array(chosen).T, axis=1)
        chosen.append(vectors[int(closest.argmin())])
    centers = np.array(chosen)
    for _ in range(rounds):
        own = (vectors @ centers.T).argmax(axis=1)
        sums = np.array([vectors[own == j].sum(axis=0) for j in range(len(centers))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centers)
    return centers.astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    """Inverse document frequencies, unit centroids, the language of each, and the least cosine of each."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: tuple[str, ...]
    least: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """``(language, cosine to its nearest centroid, rejected)``."""
        counts = gram_counts(text, len(self.idf))
        if counts is None or not len(self.languages):
            return UNDETERMINED, 0.0, True
        cosines = self.centroids @ vector(counts, self.idf)  # of equal ones, the first language by name
        best = int(cosines.argmax())
        score = float(min(max(cosines[best], 0.0), 1.0))
        limit = self.least[best] * min(1.0, np.sqrt(np.count_nonzero(counts) / FULL_GRAMS))
        return self.languages[best], score, bool(score < limit)


def fit(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    sample: int = SAMPLE,
    centroids: int = CENTROIDS,
    dimensions: int = DIMENSIONS,
) -> LanguageModel:
    """Fit on rows with a text with letters and a language.

    Document frequencies are counted over all rows. Centroids come from about ``sample`` rows per language, those with
    the lowest hash of id and text, clustered in one task per language. An empty table gives a model that knows no
    language and rejects everything. What reaches the driver is bounded by the languages, centroids and dimensions.
    """
    rows = labelled.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(language_column).alias("lang")
    ).where("text IS NOT NULL AND lang IS NOT NULL")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(dimensions, dtype=np.int64)
        per_language: dict[str, int] = {}
        for batch in batches:
            for text, language in zip(batch["text"], batch["lang"]):
                counts = gram_counts(text, dimensions)
                if counts is not None:
                    found += counts > 0
                    per_language[language] = per_language.get(language, 0) + 1
            hand_back()
        at = np.flatnonzero(found)
        yield pd.DataFrame({"place": at, "lang": pd.Series([None] * len(at), dtype=object), "n": found[at]})
        names = pd.Series(list(per_language), dtype=object)
        yield pd.DataFrame({"place": np.full(len(names), -1), "lang": names, "n": np.array(list(per_language.values()), dtype=np.int64)})

    counted = (
        rows.select("text", "lang")
        .mapInPandas(frequencies, "place int, lang string, n bigint")
        .groupBy("place", "lang")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    per_language = {r["lang"]: r["n"] for r in counted if r["place"] < 0}
    if not per_language:
        return LanguageModel(np.ones(dimensions), np.zeros((0, dimensions), dtype=np.float32), (), np.zeros(0))
    found = np.zeros(dimensions)
    for r in counted:
        if r["place"] >= 0:
            found[r["place"]] = r["n"]
    idf = np.log((1 + sum(per_language.values())) / (1 + found)) + 1

    def fit_language(group: pd.DataFrame) -> pd.DataFrame:
        counts = [c for c in (gram_counts(t, dimensions) for t in group["text"]) if c is not None]
        vectors = np.array([vector(c, idf) for c in counts], dtype=np.float32).reshape(-1, dimensions)
        centers = cluster(vectors, centroids) if len(vectors) else np.zeros((0, dimensions), dtype=np.float32)
        cosines = (vectors @ centers.T).max(axis=1) if len(vectors) else np.zeros(1)
        least = float(np.quantile(cosines, REJECT_QUANTILE)) * REJECT_SHARE
        return pd.DataFrame(
            {"lang": group["lang"].iloc[0], "center": [c.astype("<f4").tobytes() for c in centers], "least": least}
        )

    # share of each language's rows that is sampled, as an expression; languages are few
    share: Column = F.lit(0.0)
    for language, n in sorted(per_language.items()):
        share = F.when(F.col("lang") == language, F.lit(min(1.0, sample / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    fitted = (
        rows.where(draw < share)
        .select("lang", "text")
        .groupBy("lang")
        .applyInPandas(fit_language, "lang string, center binary, least double")
        .collect()
    )
    fitted.sort(key=lambda r: (r["lang"], r["center"]))
    centers = np.array([np.frombuffer(r["center"], dtype="<f4") for r in fitted], dtype=np.float32)
    return LanguageModel(
        idf, centers.reshape(-1, dimensions), tuple(r["lang"] for r in fitted), np.array([r["least"] for r in fitted])
    )


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``; columns of these names are replaced.

    A text that is NULL or has no letter is ``und``, score 0, rejected. Any other text gets the language of its nearest
    centroid, of equally near ones the language that comes first by name, and is rejected if that is farther than the model
    allows. Repeated rows are judged alike. Only the text is looked at, all of it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])
            hand_back()

    predicted = F.pandas_udf(predict, "lang_pred string, score double, rejected boolean")
    name = spare_name(docs, "_language")
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    return docs.withColumn(name, predicted(text_column)).select(*kept, f"{name}.*")


def identified_only(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns unchanged."""
    others = [c for c in docs.columns if c != "text"]
    judged = identify(docs.select("text", F.struct(*others).alias("_others")), model)
    return judged.where("NOT rejected").select(*["text" if c == "text" else f"_others.{c}" for c in docs.columns])
