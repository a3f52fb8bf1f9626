"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound from its letters' vectors, each
rotated by its place, by multiplying them; a text bundles its n-grams by adding them; a language's
prototype bundles the texts of its labelled documents. A document gets the language whose prototype
has the largest cosine with its own bundle.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.tables import map_arrow, slices

DIMENSIONS = 1024
SEED = 8
SYMBOLS = 128
UNDETERMINED = "und"
MAX_LANGUAGES = 4096
#: N-grams whose vectors a task stores, at 4 KB each, and those it binds at a time.
GRAMS_KEPT, BLOCK_GRAMS = 16_384, 4096
#: N-gram shares of texts that a task adds up before it bundles them, at 16 bytes each.
SHARES_HELD = 400_000

_GRAMS = SYMBOLS**3


@functools.cache
def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 no letter, 1-26 a-z, then other letters, which share the rest."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            out[code] = low - 96 if 97 <= low <= 122 else 27 + (low - 0xDF) % (SYMBOLS - 27)
    return out


def grams(text: str | None) -> np.ndarray:
    """Codes of all letter trigrams; every run of other characters is one blank, as is each end."""
    if not text:
        return np.empty(0, dtype=np.int64)
    codes = _symbols()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    padded = np.concatenate([[0], codes, [0]]).astype(np.int64)
    padded = padded[(padded > 0) | (np.concatenate([[1], padded[:-1]]) > 0)]
    if len(padded) < 3:
        return np.empty(0, dtype=np.int64)
    return (padded[:-2] * SYMBOLS + padded[1:-1]) * SYMBOLS + padded[2:]


class Letters:
    """Vectors of n-grams. The first ``kept`` ones seen are stored; the others are bound anew, in blocks."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED, kept: int = GRAMS_KEPT):
        signs = np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dimensions)) * 2 - 1
        self.by_place = [np.roll(signs, place, axis=1).astype(np.int8) for place in range(3)]
        self.slot = np.full(_GRAMS, -1, dtype=np.int32)
        self.vectors = np.empty((min(1024, kept), dimensions), dtype=np.float32)
        self.known, self.kept = 0, kept

    def _bound(self, codes: np.ndarray) -> np.ndarray:
        first, second, third = (codes // SYMBOLS**2, codes // SYMBOLS % SYMBOLS, codes % SYMBOLS)
        return self.by_place[2][first] * self.by_place[1][second] * self.by_place[0][third]

    def bundle(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The weighted sum of the vectors of distinct n-grams."""
        new = codes[self.slot[codes] < 0][: self.kept - self.known]
        if len(new):
            while self.known + len(new) > len(self.vectors):
                more = min(len(self.vectors), self.kept - len(self.vectors))
                self.vectors = np.concatenate([self.vectors, np.empty((more, self.vectors.shape[1]), np.float32)])
            self.vectors[self.known : self.known + len(new)] = self._bound(new)
            self.slot[new] = np.arange(self.known, self.known + len(new))
            self.known += len(new)
        slots = self.slot[codes]
        weights = weights.astype(np.float32)
        if len(codes) <= BLOCK_GRAMS and slots.min(initial=0) >= 0:
            return weights @ self.vectors[slots]
        total = np.zeros(self.vectors.shape[1])
        for stored in (True, False):
            places = np.flatnonzero((slots >= 0) == stored)
            for start in range(0, len(places), BLOCK_GRAMS):
                some = places[start : start + BLOCK_GRAMS]
                vectors = self.vectors[slots[some]] if stored else self._bound(codes[some]).astype(np.float32)
                total += weights[some] @ vectors
        return total


def _bundles_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language the sum over its texts of their n-gram shares, bundled."""
    letters, held, size = Letters(), {}, 0
    totals: dict[str, np.ndarray] = {}

    def bundle_held() -> None:
        for lang, parts in held.items():
            codes, places = np.unique(np.concatenate([codes for codes, _ in parts]), return_inverse=True)
            shares = np.bincount(places, np.concatenate([shares for _, shares in parts]))
            total = totals.setdefault(lang, np.zeros(DIMENSIONS))
            for start in range(0, len(codes), BLOCK_GRAMS):
                total += letters.bundle(codes[start : start + BLOCK_GRAMS], shares[start : start + BLOCK_GRAMS])
        held.clear()

    for batch in slices(batches):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            codes, counts = np.unique(grams(text), return_counts=True)
            if len(codes):
                held.setdefault(lang, []).append((codes, counts / counts.sum()))
                size += len(codes)
                if size >= SHARES_HELD:
                    bundle_held()
                    size = 0
    bundle_held()
    for lang, total in totals.items():
        yield pa.RecordBatch.from_pydict({"lang": [lang], "bundle": [total.tolist()]})


def learn_prototypes(documents: DataFrame) -> dict[str, np.ndarray]:
    """A unit vector per language from all rows of ``documents`` (text, lang) with a language.

    Every text counts the same, whatever its length. Tasks add up their texts; only one vector per
    language reaches the driver, and more than ``MAX_LANGUAGES`` languages are an error.
    """
    labelled = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    parts = map_arrow(labelled, _bundles_of_task, "lang string, bundle array<double>")
    sums = parts.select("lang", F.posexplode("bundle").alias("place", "value")).groupBy("lang", "place")
    whole = sums.agg(F.sum("value").alias("value")).groupBy("lang")
    found = whole.agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("bundle"))
    rows = found.select("lang", "bundle.value").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # Sums of floats come in any order; rounding keeps predictions the same in every run.
    vectors = {row["lang"]: np.round(np.array(row["value"]), 6) for row in sorted(rows, key=lambda r: r["lang"])}
    return {lang: vector / (np.linalg.norm(vector) or 1.0) for lang, vector in vectors.items()}


def identify(documents: DataFrame, prototypes: dict[str, np.ndarray], columns: list[str]) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``has_letters`` to ``columns`` of ``documents``, from ``text`` alone.

    A null or empty text, one without letters, or no prototypes at all: ``und`` with score 0. Of
    equal cosines the first language in alphabetical order wins; a negative cosine scores 0.
    ``has_letters`` tells texts without a letter from those ``und`` for another reason.
    """
    languages = sorted(prototypes)
    matrix = np.array([prototypes[lang] for lang in languages])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in slices(batches):
            names, scores, lettered = [], [], []
            for text in batch.column(len(columns)).to_pylist():
                codes, counts = np.unique(grams(text), return_counts=True)
                name, score = UNDETERMINED, 0.0
                if len(codes) and languages:
                    bundle = letters.bundle(codes, counts).astype(np.float64)
                    cosines = np.round(matrix @ bundle / (np.linalg.norm(bundle) or 1.0), 9)
                    best = int(np.argmax(cosines))
                    name, score = languages[best], float(min(1.0, max(0.0, cosines[best])))
                names.append(name)
                scores.append(score)
                lettered.append(len(codes) > 0)
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lettered, pa.bool_())],
                [*columns, "lang_pred", "score", "has_letters"],
            )

    rows = documents.select(*columns, F.col("text").cast("string").alias("_text_to_read"))
    schema = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in columns)
    return map_arrow(rows, predict, f"{schema}, lang_pred string, score double, has_letters boolean")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify_documents(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows not held out."""
    rows = documents.select("doc_id", "text", "lang", held_out().alias("held_out"))
    prototypes = learn_prototypes(rows.filter("NOT held_out"))
    return identify(rows, prototypes, ["doc_id", "held_out"]).drop("has_letters")
