"""Language identification with a string kernel, Nyström landmarks and one-versus-rest kernel ridge regression.

The blended-spectrum presence kernel of two texts is the number of n-grams (1 to 3 bytes, ASCII folded) that occur in
both, divided by the geometric mean of how many occur in each. N-grams are hashed to a fixed number of places, so a text is
one row of bits however long it is. A bounded, documented sample of labelled texts is learned from: up to ``per_language`` texts
for each language, chosen by a hash of the id; landmarks from all of them span the kernel. Scoring
is two batched matrix products per Arrow chunk: bits x landmark bits, then kernel values x weights.

Defined cases: ``und`` with score 0 for a null text, a text without letters, and any text when nothing could be learned;
rows with a null id or language are not learned from; a null id is not held out; repeated rows are predicted each for
itself; empty tables give empty results; extra columns are ignored. Ties go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from llm.text import BASE, chunks, field, giving_back, small_batches, utf8
from shelfwise.session import materialize

UNDETERMINED = "und"
PLACES = 8192
ROWS_AT_ONCE = 512
LEAST_SCORE, EVIDENCE = 0.37, 60  # of 10,000 documents at sf0.1 none with so many n-grams scores below 0.377; letters at random score 0.29 to 0.37


def _folded() -> np.ndarray:
    """Byte table: A-Z lower-cased, ASCII that is no letter becomes a space."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 0x20
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


FOLDED = _folded()


def presence(data: np.ndarray, offsets: np.ndarray, places: int = PLACES, longest: int = 3) -> np.ndarray:
    """Rows x places: 1 where an n-gram with that hash occurs in the row's text."""
    rows = len(offsets) - 1
    bits = np.zeros((rows, places), np.uint8)
    if not len(data):
        return bits
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    codes = FOLDED[data].astype(np.uint32)
    gram = codes
    shift = np.uint32(32 - int(np.log2(places)))
    flat = bits.reshape(-1)
    for n in range(1, longest + 1):
        if n > 1:
            gram = (gram[:-1] << np.uint32(8)) | codes[n - 1 :]
            if not len(gram):
                break
        place = ((gram * np.uint32(BASE & np.uint64(0xFFFFFFFF)) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)) >> shift
        own = row[: len(gram)]
        at = own * places + place
        if n > 1:
            at = at[own == row[n - 1 :]]
        flat[at] = 1
    return bits


def kernel(bits: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel; an empty text has the value 0 with everything."""
    a, b = bits.astype(np.float32), landmarks.astype(np.float32)
    norm = np.sqrt(np.outer(a.sum(1), b.sum(1)))
    return np.divide(a @ b.T, norm, out=np.zeros_like(norm), where=norm > 0)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray

    def margins(self, bits: np.ndarray) -> np.ndarray:
        return kernel(bits, self.landmarks) @ self.weights[:-1] + self.weights[-1]


def fit(bits: np.ndarray, languages: np.ndarray, n_landmarks: int, ridge: float) -> Model | None:
    """Kernel ridge in the span of the landmarks, targets +1 and -1; None when nothing was given."""
    if not len(bits):
        return None
    names = tuple(sorted(set(languages.tolist())))
    # Landmarks in turn from each language, so that a rare one has its share.
    place = np.zeros(len(languages), np.int64)
    for name in names:
        own = languages == name
        place[own] = np.arange(own.sum())
    chosen = np.lexsort((languages, place))[:n_landmarks]
    marks = bits[chosen]
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    use = values > 1e-6
    whiten = vectors[:, use] / np.sqrt(values[use])
    mapped = kernel(bits, marks).astype(np.float64) @ whiten
    target = np.where(languages[:, None] == np.array(names)[None, :], 1.0, -1.0)
    counts = np.array([(languages == x).sum() for x in languages], dtype=np.float64)
    weight = 1.0 / counts
    weight *= len(weight) / weight.sum()
    center, offset = np.average(mapped, axis=0, weights=weight), np.average(target, axis=0, weights=weight)
    x, y = mapped - center, target - offset
    w = np.linalg.solve((x * weight[:, None]).T @ x + ridge * np.eye(x.shape[1]), (x * weight[:, None]).T @ y)
    return Model(names, marks, np.vstack([whiten @ w, offset - center @ w]).astype(np.float32))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        packed = []
        for a in range(0, batch.num_rows, ROWS_AT_ONCE):
            b = min(a + ROWS_AT_ONCE, batch.num_rows)
            bits = presence(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            packed += [x.tobytes() for x in np.packbits(bits, axis=1)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(packed, pa.binary())], names=["doc_id", "lang", "bits"])


def learn(
    labelled: DataFrame, per_language: int = 400, n_landmarks: int = 256, ridge: float = 1.0, sample_texts: int = 25_600, least_texts: int = 20
) -> Model | None:
    """Model from (doc_id, text, lang), of all its languages.

    The sample has up to ``per_language`` texts (one kilobyte of bits each) of a language, fewer where languages are so many that ``sample_texts`` would
    be exceeded, but ``least_texts`` at least; there are four landmarks for each language, and no fewer than ``n_landmarks``.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", "lang").where("doc_id is not null and lang is not null and text is not null")
    counts = materialize(rows.groupBy("lang").count(), "languages")
    known = counts.count()
    per_language = max(min(per_language, sample_texts // max(known, 1)), least_texts)
    n_landmarks = max(n_landmarks, 4 * known)
    share = counts.select(F.col("lang").alias("known"), (F.lit(2.0 * per_language) / F.col("count")).alias("share"))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Twice the share is drawn and cut to size afterwards, as a share by hash is not exact.
    drawn = rows.join(F.broadcast(share), (F.col("lang") == F.col("known")) & (spread < F.col("share"))).select("doc_id", "text", "lang")
    got = drawn.mapInArrow(giving_back(_featurise), "doc_id bigint, lang string, bits binary").collect()
    got.sort(key=lambda r: (r.lang, hash_order(r.doc_id), r.bits))
    kept, seen = [], {}
    for r in got:
        seen[r.lang] = seen.get(r.lang, 0) + 1
        if seen[r.lang] <= per_language:
            kept.append(r)
    bits = np.array([np.unpackbits(np.frombuffer(r.bits, np.uint8)) for r in kept], np.uint8)
    return fit(bits, np.array([r.lang for r in kept], dtype=object), n_landmarks, ridge)


def hash_order(doc_id: int) -> int:
    """Order of the learned sample, free of any order of the ids."""
    return (doc_id * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 64) >> 11


def predictions(model: Model | None, texts: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language and score of each text, and from how many different n-grams."""
    names, scores, seen = np.full(len(texts), UNDETERMINED, dtype=object), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    if model is None or not len(texts):
        return names, scores, seen
    data, offsets = utf8(texts)
    for first, last in chunks(offsets):
        for a in range(first, last, ROWS_AT_ONCE):
            b = min(a + ROWS_AT_ONCE, last)
            bits = presence(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            margins, seen[a:b] = model.margins(bits), bits.sum(axis=1)
            best = margins.argmax(1)
            names[a:b] = np.array(model.languages, dtype=object)[best]
            scores[a:b] = np.clip((margins[np.arange(b - a), best] + 1) / 2, 0, 1)
    names[~letters], scores[~letters] = UNDETERMINED, 0.0
    return names, scores, seen


def _predict(shared, filtering: bool):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            names, scores, seen = predictions(shared.value, field(batch, "text"), letters)
            if filtering:
                foreign = (scores < LEAST_SCORE) & (seen >= EVIDENCE)
                out = {"row": batch.column("row").filter(pa.array((names != UNDETERMINED) & ~foreign))}
            else:
                out = {"doc_id": field(batch, "doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return giving_back(predict)


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score for each row of (doc_id, text)."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), "text").alias("row"), _has_letter())
    return rows.mapInArrow(_predict(shared, False), "doc_id bigint, lang_pred string, score double")


def determined(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows, with all their columns, of documents in one of the learned languages.

    Rejected are texts without letters and those that no language claims: a score below LEAST_SCORE from at least EVIDENCE different n-grams. Shorter
    texts say too little and stay.
    """
    if model is None:
        return documents.where(F.col("text").rlike(r"\p{L}"))
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.struct(*documents.columns).alias("row"), _has_letter())
    return rows.mapInArrow(_predict(shared, True), f"row {documents.schema.simpleString()}").select("row.*")


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn_from_documents(documents: DataFrame) -> Model | None:
    """The contract's model: learned from documents that are not held out."""
    return learn(documents.where(~held_out(F.col("doc_id"))))
