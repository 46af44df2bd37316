"""Quality classifier: a sparse ensemble of rules.

1. One Arrow pass turns each whole text into a row of statistics (``STATISTICS``), which is stored once.
2. Shallow trees are grown on a bounded sample of labelled rows; each path from a root to any node is a rule, a
   conjunction of bounds on statistics.
3. A lasso logistic regression over the rules' 0/1 values keeps few of them with weights.
4. The kept rules become one Spark column expression over the statistics, so scoring is plain generated code.

Defined cases: a null text is an empty one and gets the score of its all-zero statistics; without labels of both kinds
every score is the smoothed share of label 1; labels with a null doc_id or quality are not learned from, repeated equal labels
count once, and an id with contradicting labels is not learned from; a null id is not held out; repeated documents
are scored each for itself; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from llm.text import chunks, field, giving_back, lower_ascii, shingles, small_batches, spaced_words, utf8, word_hashes, word_spans
from shelfwise.session import materialize

THRESHOLD = 0.3
SAMPLE_ROWS = 20_000
_WORDS, _LOWER = spaced_words(), lower_ascii()

STATISTICS = (
    "log_bytes", "log_words", "word_length", "longest_word", "upper", "digits", "spaces", "line_ends", "commas_stops",
    "exclaims", "bars", "symbols", "brackets", "other_signs", "beyond_ascii", "different_words", "repeated_neighbours",
    "repeated_triples", "words_per_line",
)


def _byte_classes() -> dict[str, np.ndarray]:
    def of(chars: bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(chars)] = True
        return table

    letters = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B))
    named = {
        "upper": bytes(range(0x41, 0x5B)), "digits": b"0123456789", "spaces": b" \t", "line_ends": b"\n\r", "commas_stops": b",.;:'\"-?",
        "exclaims": b"!", "bars": b"|", "symbols": b"*#%&$@^~=+_", "brackets": b"()[]{}<>/\\",
    }
    known = letters + b"".join(named.values())
    named["other_signs"] = bytes(x for x in range(128) if x not in known)
    named["beyond_ascii"] = bytes(range(128, 256))
    return {k: of(v) for k, v in named.items()}


CLASSES = _byte_classes()


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x STATISTICS of a run of texts; all zero for an empty text."""
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    starts, stops, row = word_spans(data, offsets, _WORDS)
    n_words = np.bincount(row, minlength=rows).astype(np.float64)
    per = lambda top, bottom: np.divide(top, bottom, out=np.zeros(rows), where=bottom > 0)
    out = {"log_bytes": np.log1p(size), "log_words": np.log1p(n_words)}
    lengths = (stops - starts).astype(np.float64)
    out["word_length"] = per(np.bincount(row, lengths, rows), n_words)
    longest = np.zeros(rows)
    np.maximum.at(longest, row, lengths)
    out["longest_word"] = np.log1p(longest)
    totals = {}
    for name, table in CLASSES.items():
        run = np.concatenate([[0], np.cumsum(table[data])])
        totals[name] = (run[offsets[1:]] - run[offsets[:-1]]).astype(np.float64)
        out[name] = per(totals[name], size)
    hashes = word_hashes(_LOWER[data], starts, stops)
    out["different_words"] = per(_different(hashes, row, rows), n_words)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    out["repeated_neighbours"] = per(np.bincount(row[same], minlength=rows), n_words)
    triples, triple_row = shingles(hashes, row, rows, 3)
    n_triples = np.bincount(triple_row, minlength=rows).astype(np.float64)
    out["repeated_triples"] = per(n_triples - _different(triples, triple_row, rows), n_triples)
    out["words_per_line"] = np.log1p(per(n_words, totals["line_ends"] + (size > 0)))
    return np.column_stack([out[name] for name in STATISTICS])


def _different(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of different values of each row."""
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return np.bincount(row[new], minlength=rows).astype(np.float64)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(field(batch, "text"))
        out = np.zeros((batch.num_rows, len(STATISTICS)))
        for a, b in chunks(offsets):
            out[a:b] = statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        first = batch.column("row") if "whole" in batch.schema.names else field(batch, "doc_id")
        yield pa.RecordBatch.from_arrays([first, *(pa.array(c) for c in out.T)], names=["first", *STATISTICS])


_MEASURED = ", ".join(f"{s} double" for s in STATISTICS)


def measure(documents: DataFrame) -> DataFrame:
    """doc_id and the statistics of each whole text."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), "text").alias("row"))
    return rows.mapInArrow(giving_back(_measure), f"first bigint, {_MEASURED}").withColumnRenamed("first", "doc_id")


def good(documents: DataFrame, ensemble: Ensemble, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, of documents that score at least the threshold."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.lit(True).alias("whole"))
    measured = rows.mapInArrow(giving_back(_measure), f"first {documents.schema.simpleString()}, {_MEASURED}")
    return measured.where(ensemble.score() >= threshold).select("first.*")


@dataclass(frozen=True, order=True)
class Bound:
    """One comparison of a rule."""

    statistic: str
    above: bool
    value: float

    def column(self) -> Column:
        return F.col(self.statistic) > self.value if self.above else F.col(self.statistic) <= self.value


Rule = tuple[Bound, ...]


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The whole ensemble as one column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(applies(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def applies(rule: Rule) -> Column:
    return reduce(and_, (b.column() for b in rule))


def simplified(bounds: list[Bound]) -> Rule:
    """The tightest bound of each side of each statistic."""
    tight: dict[tuple[str, bool], float] = {}
    for b in bounds:
        key = (b.statistic, b.above)
        tight[key] = b.value if key not in tight else (max if b.above else min)(tight[key], b.value)
    return tuple(sorted(Bound(s, above, v) for (s, above), v in tight.items()))


def paths(node, bounds: tuple[Bound, ...] = ()) -> list[Rule]:
    """Rules of all paths below a node of a fitted tree."""
    found = [simplified(list(bounds))] if bounds else []
    if node.numDescendants():
        split = node.split()
        name, value = STATISTICS[split.featureIndex()], float(split.threshold())
        found += paths(node.leftChild(), (*bounds, Bound(name, False, value)))
        found += paths(node.rightChild(), (*bounds, Bound(name, True, value)))
    return found


def sample(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label) of about ``sample_rows`` labelled rows at most, drawn by a hash of the id.

    Fitting needs no more rows, and the bound keeps it the same work at every size.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").where("doc_id is not null and quality in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("label")).where("low = label").select("doc_id", "label")
    known = materialize(known, "quality-labels")
    total = known.count()
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(total)) < sample_rows) if total > sample_rows else known


def learn(stats: DataFrame, known: DataFrame, trees: int = 20, depth: int = 3, lasso: float = 0.001) -> Ensemble:
    """Ensemble from statistics of documents and a sample of labels."""
    # Of rows that share an id the one with the least statistics is learned from, whatever order they come in.
    rows = stats.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(*STATISTICS)).alias("own")).select("doc_id", "label", "own.*")
    train = materialize(
        rows.select("doc_id", F.col("label").cast("double").alias("label"), array_to_vector(F.array(*STATISTICS)).alias("features"), *STATISTICS)
        .repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id"),
        "quality-sample",
    )
    ones, n = train.agg(F.sum("label"), F.count("*")).first()
    ones = ones or 0.0
    if not 0 < ones < n:
        share = (ones + 1) / (n + 2)
        return Ensemble(float(np.log(share / (1 - share))), ())
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=10, featureSubsetStrategy="0.5", subsamplingRate=0.7, seed=7
    ).fit(train)
    rules = sorted({rule for tree in forest.trees for rule in paths(tree._call_java("rootNode"))})
    if not rules:
        return Ensemble(float(np.log(ones / (n - ones))), ())
    flags = F.array(*(F.when(applies(r), F.lit(1.0)).otherwise(F.lit(0.0)) for r in rules))
    design = materialize(train.select("label", array_to_vector(flags).alias("features")), "quality-rules")
    fitted = LogisticRegression(regParam=lasso, elasticNetParam=1.0, maxIter=60, standardization=False).fit(design)
    weights = fitted.coefficients.toArray()
    return Ensemble(round(float(fitted.intercept), 9), tuple((r, round(float(w), 9)) for r, w in zip(rules, weights) if round(float(w), 9)))


def classify(stats: DataFrame, ensemble: Ensemble, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted."""
    scored = stats.select("doc_id", ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: learned from labels that are not held out, applied to every document."""
    stats = materialize(measure(documents), "quality-statistics")
    ensemble = learn(stats, sample(labels.where(~held_out(F.col("doc_id")))))
    return classify(stats, ensemble).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def ensemble_for(documents: DataFrame, labels: DataFrame) -> Ensemble:
    """Ensemble learned from the documents' labels that are not held out, measuring only the sample.

    The sample is bounded by ``SAMPLE_ROWS``, so its ids may be broadcast.
    """
    known = sample(labels.where(~held_out(F.col("doc_id"))))
    return learn(measure(documents.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")), known)
