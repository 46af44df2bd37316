import hashlib
import re

from llm import decontaminate
from tests.llm.common import MESSY, documents, plain

W = "a b c d e f g h i j k l m n o p q r s t".split()
ITEMS = [
    (1, " ".join(W[:15])), (2, " ".join(W[:15]).upper()), (10, "short one"), (3, None), (4, "..."), (None, "orphan item words"), (5, "été — naïve"), (6, "round trip"),
]
DOCS = MESSY + [
    (20, "X " + ", ".join(W[:13]) + "! X"), (21, " ".join(W[1:14])), (22, " ".join(W[2:16])), (23, "so Short, one; more"), (24, "tooshort one"), (25, "short oneself"),
    (26, "short one " * 3), (27, "w " * 200 + "short one"), (28, "orphan item words"),
]


def brute(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    found = []
    for doc in docs:
        own, hit, ids = words(doc[1]), set(), set()
        for item, text in items:
            w = words(text)
            if not w:
                continue
            n = min(13, len(w))
            made = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in made:
                    hit.update(range(k, k + n))
                    ids |= {str(item)} - {"None"}
        found.append((doc[0], len(own), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(found, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.collect()), key=repr)


def test_same_as_brute_force(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for parts in (1 << 30, 100):  # one automaton, many automata
        got = decontaminate.contamination(documents(spark, DOCS, clashing=True), items, part_bytes=parts)
        assert result(got) == brute(DOCS, ITEMS)


def test_items_without_an_id_count_but_have_no_name(spark):
    items = spark.createDataFrame([(None, " ".join(W[:14])), (None, "other words")], "item_id bigint, text string")
    got = decontaminate.contamination(documents(spark, [(1, " ".join(W[:13]) + " tail"), (2, "no other"), (3, "the other words")]), items)
    assert result(got) == [(1, 14, 13, [], True), (2, 2, 0, [], False), (3, 3, 2, [], True)]


def test_spans_are_places_of_the_original(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    texts = {20: DOCS[len(MESSY)][1], 29: "\u6771 \U0001f600 \u00e9t\u00e9, na\u00efve\u2014short ONE"}
    cut = {
        r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans]
        for r in decontaminate.contamination(documents(spark, list(texts.items())), items).collect()
    }
    assert cut == {20: [", ".join(W[:13])], 29: []}
    one = decontaminate.contamination(documents(spark, [(1, "\u6771 \U0001f600 Short,  oNE x")]), items).first()
    assert ["\u6771 \U0001f600 Short,  oNE x"[s.start : s.end] for s in one.spans] == ["Short,  oNE"]


def test_uncontaminated_rows_keep_all_columns(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = documents(spark, DOCS, clashing=True)
    bad = {r[0] for r in brute(DOCS, ITEMS) if r[4]}
    kept = decontaminate.uncontaminated(docs, items)
    assert kept.columns == docs.columns
    assert plain(kept.select("doc_id", "text", "score")) == sorted(((d[0], 7, d[1]) for d in DOCS if d[0] not in bad), key=repr)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.contamination(documents(spark, []), items).count() == 0
    none = decontaminate.contamination(documents(spark, DOCS), items.limit(0))
    assert {(r.n_hit, r.contaminated) for r in none.collect()} == {(0, False)}
    assert {r.items_sha256 for r in decontaminate.digests(none).collect()} == {hashlib.sha256(b"").hexdigest()}
