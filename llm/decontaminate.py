"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows, one scan per text.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of anything beyond ASCII. A window is 13 consecutive
words of an item; an item with fewer words is one window. A whole Arrow chunk of texts is normalised at once (words
with one space between, a line end between texts) and scanned by a single pass of the automaton; matches are kept when they begin
and end with words. Word numbers map matches back to character offsets of the original text.

Benchmarks are small, but their size is checked: items are dealt into parts of at most ``part_bytes`` of pattern bytes,
only one part at a time comes to the driver, and each part is one more scan of the same rows, without a shuffle.

Defined cases: a null or wordless text has no words and no hits and is not contaminated; items without words or
without an id are left out; items with equal texts all count; an item of a single word may hit anywhere; repeated
documents are judged each for itself; empty tables give empty results, an empty benchmark no hits; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from llm.text import alnum_words, chunks, field, giving_back, lower_ascii, small_batches, utf8, word_spans

WINDOW = 13
PART_BYTES = 32 << 20
KEEP, LOWER = alnum_words(), lower_ascii()
_AUTOMATA: dict[str, ahocorasick.Automaton] = {}

_INTS = pa.list_(pa.int64())
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def item_words(text: str | None) -> list[str]:
    """Normalised words; each byte is one character, as in the scanned text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    starts, stops, _ = word_spans(data, np.array([0, len(data)]), KEEP)
    low = LOWER[data].tobytes().decode("latin-1")
    return [low[a:b] for a, b in zip(starts.tolist(), stops.tolist())]


def windows(items: list[tuple[str | None, str | None]], size: int = WINDOW) -> dict[str, tuple[int, list[str]]]:
    """Window text to (number of words, ids of its items)."""
    out: dict[str, tuple[int, list[str]]] = {}
    for item, text in items:
        words = item_words(text)
        made = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
        for window in made:
            own = out.setdefault(" ".join(window), (len(window), []))[1]
            if item is not None:
                own.append(item)
    return out


def _automaton(key: str, patterns: Broadcast) -> ahocorasick.Automaton:
    """Built once per worker process; several parts of one benchmark stay side by side, older ones go."""
    if key not in _AUTOMATA:
        made = ahocorasick.Automaton()
        for text, (n_words, items) in patterns.value.items():
            made.add_word(text, (len(text), n_words, items))
        if patterns.value:
            made.make_automaton()
        while len(_AUTOMATA) > 1:
            _AUTOMATA.pop(next(iter(_AUTOMATA)))
        _AUTOMATA[key] = made
    return _AUTOMATA[key]


def _normalised(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, rows: np.ndarray) -> tuple[str, np.ndarray]:
    """The chunk's words, one space or, after a text's last word, a line end behind each; start of each word in it."""
    lengths = stops - starts
    firsts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(starts)), lengths)
    chars = np.arange(int(lengths.sum()))
    out = np.full(len(chars) + len(starts), 0x20, np.uint8)
    out[chars + word] = LOWER[data[starts[word] + chars - firsts[word]]]
    places = firsts + np.arange(len(starts))
    last = np.ones(len(rows), dtype=bool)
    last[:-1] = rows[1:] != rows[:-1]
    out[places[last] + lengths[last]] = 0x0A
    return out.tobytes().decode("latin-1"), places


def find(data: np.ndarray, offsets: np.ndarray, automaton: ahocorasick.Automaton) -> tuple[np.ndarray, dict[int, list]]:
    """Words per row; for rows with matches a list of (first word, last word, items), words counted within the row."""
    starts, stops, rows = word_spans(data, offsets, KEEP)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    found: dict[int, list] = {}
    if not len(starts) or not len(automaton):
        return counts, found
    text, places = _normalised(data, starts, stops, rows)
    ends = places + (stops - starts)
    before = np.cumsum(counts) - counts
    for end, (length, n_words, items) in automaton.iter(text):
        first = int(np.searchsorted(places, end - length + 1))
        last = first + n_words - 1
        if last < len(places) and places[first] == end - length + 1 and ends[last] == end + 1:
            row = int(rows[first])
            found.setdefault(row, []).append((first - int(before[row]), last - int(before[row]), items))
    return counts, found


def _scan(key: str, patterns: Broadcast, last: bool, carry: bool):
    """One pass over rows; the last one adds hit words and character spans, and keeps the whole row only if asked to."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            automaton = _automaton(key, patterns)
            data, offsets = utf8(field(batch, "text"))
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            words = np.zeros(batch.num_rows, np.int64)
            for a, b in chunks(offsets):
                counts, found = find(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], automaton)
                words[a:b] = counts
                for row, matches in found.items():
                    spans = _merged([*zip(*[iter(hits[a + row])] * 2), *((m[0], m[1]) for m in matches)])
                    hits[a + row] = [x for span in spans for x in span]
                    items[a + row] = sorted({*items[a + row], *(i for m in matches for i in m[2])})
            out = {"row": batch.column("row"), "n_words": pa.array(words), "hits": pa.array(hits, _INTS), "items": pa.array(items, pa.list_(pa.string()))}
            if last:
                spans = [_characters(data[offsets[k] : offsets[k + 1]], flat) for k, flat in enumerate(hits)]
                out["n_hit"] = pa.array([sum(b - a + 1 for a, b in zip(f[::2], f[1::2])) for f in hits], pa.int64())
                out["spans"] = pa.array(spans, _SPANS)
                del out["hits"]
                if not carry:
                    out["row"] = pa.StructArray.from_arrays([field(batch, "doc_id")], ["doc_id"])
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return giving_back(scan)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans (first, last) without overlaps, ascending."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _characters(data: np.ndarray, flat: list[int]) -> list[dict[str, int]]:
    """Word spans of one text to spans of its characters."""
    if not flat:
        return []
    starts, stops, _ = word_spans(data, np.array([0, len(data)]), KEEP)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [{"start": int(chars[starts[a]]), "end": int(chars[stops[b]])} for a, b in zip(flat[::2], flat[1::2])]


def judged(documents: DataFrame, benchmark: DataFrame, carry: bool, window: int, part_bytes: int) -> DataFrame:
    """row (all columns if carried, else doc_id), n_words, items, n_hit, spans, contaminated."""
    spark = documents.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text is not null")
    # A window repeats the words that follow its first one, so patterns have at most this many bytes.
    size = items.agg(F.sum(F.octet_length("text") * window)).first()[0] or 0
    parts = -(-size // part_bytes) or 1
    columns = [F.col(c) for c in documents.columns] if carry else [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")]
    state = documents.select(
        F.struct(*columns).alias("row"), F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    row = state.schema["row"].dataType.simpleString()
    for part in range(parts):
        last = part == parts - 1
        chosen = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part) if parts > 1 else items
        patterns = spark.sparkContext.broadcast(windows([tuple(r) for r in chosen.collect()], window))
        kept = row if carry or not last else "struct<doc_id: bigint>"
        more = "n_hit bigint, spans array<struct<start: bigint, end: bigint>>"
        schema = f"row {kept}, n_words bigint, items array<string>, {more}" if last else f"row {row}, n_words bigint, hits array<bigint>, items array<string>"
        state = state.mapInArrow(_scan(uuid.uuid4().hex, patterns, last, carry), schema)
    return state.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids, sorted as strings), spans (character offsets of hit words), contaminated."""
    found = judged(documents, benchmark, False, window, part_bytes)
    return found.select("row.doc_id", "n_words", "n_hit", "items", "spans", "contaminated")


def uncontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows, with all their columns, of documents that are not contaminated."""
    return judged(documents, benchmark, True, window, part_bytes).where("not contaminated").select("row.*")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from the operator's output."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def sql() -> str:
    """The same as SQL: windows of each text joined to windows of each item, by length."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH items AS (
            SELECT item_id, regexp_extract_all({low}, '{word}') AS w FROM benchmark WHERE text IS NOT NULL),
        patterns AS (
            SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[k:k + least(len(w), {WINDOW}) - 1], ' ') AS p
            FROM items, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS t(k) WHERE len(w) > 0),
        lengths AS (SELECT DISTINCT n FROM patterns),
        docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce({low}, ''), '{word}') AS w FROM documents),
        places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM docs),
        grams AS (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS p FROM places, lengths WHERE k + n - 1 <= len(w)),
        hits AS (SELECT DISTINCT r, k, n, item_id FROM grams JOIN patterns USING (n, p)),
        words AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM hits) GROUP BY r),
        found AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""
