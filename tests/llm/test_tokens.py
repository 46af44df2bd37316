import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm import packing, simple8b, token_files
from llm.tokens import Encoder, vocabulary_path
from tests.llm.common import MESSY, documents

TOKENIZER = Tokenizer.from_file(vocabulary_path())
ENCODER = Encoder(vocabulary_path(), cached_parts=50)
MORE = [(30 + k, "Wort! " * (k * 97) + "end.") for k in range(12)]
DOCS = MESSY + MORE


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def crc(ids):
    return zlib.crc32(ids.tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'st \n\t.,!|1é  　東\x1c\x85"), max_size=30), max_size=4))
def test_parts_give_the_ids_of_the_whole_text(texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode(texts)] == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_strings_of_special_tokens_are_those_tokens():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext", None, "plain text"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER.encode(texts)] == [TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert any(t.content in "a <|endoftext|> b" for t in TOKENIZER.get_added_tokens_decoder().values())


class Counted(dict):
    lookups = 0

    def get(self, *args):
        self.lookups += 1
        return super().get(*args)


def test_a_part_is_looked_up_once_per_run():
    """However often it occurs: the ids of a run are put together from its different parts."""
    own = Encoder(vocabulary_path())
    own.after_space = Counted()
    texts = ["Wort und Zahl, " * 50 + "end.\nNext \u00e9t\u00e9", None, "", "Zahl und Wort", "x  y", " Wort", "a <|endoftext|> Wort"] * 40
    ((first, found),) = own.runs(pa.array(["left out", *texts]).slice(1))
    assert first == 0 and [np.frombuffer(x, "<u4").tolist() for x in found] == [TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert own.after_space.lookups < 20


def test_letters_are_one_piece():
    """Words that go to the model as they are: any ASCII letters, long ones, beside words with other letters and marks."""
    words = ["a", "Z", "s", "ll", "x" * 3000, "Anblewh", "erinreaouentionhe", "caf\u00e9", "don't", "re", "o'clock", "\u00aa", "two.", "T\u200db"]
    text = "head " + " ".join(words) + "\n" + " ".join(reversed(words))
    assert np.frombuffer(Encoder(vocabulary_path()).encode([text])[0], "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400))
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    words = simple8b.encode(values)
    assert (simple8b.decode(words) == values).all() and len(simple8b.decode(words)) == len(values)


def test_simple8b_packs_small_values():
    assert len(simple8b.encode(np.ones(600, np.uint64))) == 10
    assert len(simple8b.encode(np.full(30, 50_000, np.uint64))) == 10


def test_token_files(spark):
    docs = documents(spark, DOCS, clashing=True)
    path = token_files.write(docs, block_ids=500)
    order = sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for doc, text, *_ in order:
        ids = ids_of(text)
        expected.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.digests(spark, path).collect()), key=lambda r: r[1])
    assert got == expected
    read = collections.Counter((r.doc_id, tuple(r.ids)) for r in token_files.read_ids(spark, path).collect())
    assert read == collections.Counter((d, tuple(ids_of(t).tolist())) for d, t, *_ in DOCS)


def test_token_files_of_an_empty_table(spark):
    assert token_files.digests(spark, token_files.write(documents(spark, []))).count() == 0


@pytest.mark.parametrize("tasks", [1, 5])
def test_packing(spark, tasks):
    found = packing.pieces(documents(spark, DOCS, clashing=True), 64)
    rows = packing.pack(found, 64, open_bins=4, task_rows=1000 if tasks == 1 else 8).collect()
    texts = collections.defaultdict(list)
    for doc, text, *_ in DOCS:
        texts[doc].append(ids_of(text))
    pieces, bins = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    expected = collections.Counter()
    for doc, all_ids in texts.items():
        for ids in all_ids:
            for k, (start, size) in enumerate(packing.cuts(len(ids), 64)):
                assert size == 64 or k == 0
                expected[(doc, k, start, size, crc(ids[start : start + size]))] += 1
    assert pieces == expected
    for places in bins.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end <= 64


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert bins.add(6) == (0, 0) and bins.add(7) == (1, 0)  # free: 4 and 3
    assert bins.add(3) == (1, 7)  # fits exactly where less is free
    assert bins.add(5) == (2, 0) and bins.add(8) == (3, 0)  # the fullest (4 free) closed
    assert bins.add(4) == (2, 5) and bins.open_numbers() == {2, 3}


def test_packing_comes_close_to_the_bound():
    sizes = np.random.Generator(np.random.PCG64(1)).integers(1, 1024, 20_000)
    bins = packing.BestFit(1024, packing.OPEN_BINS)
    for s in sizes.tolist():
        bins.add(s)
    assert bins.n_bins <= 1.02 * np.ceil(sizes.sum() / 1024)


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_the_pipeline_packs_with_a_small_cache(spark, monkeypatch):
    """Its executors still hold what other stages took: a stage of many different words keeps few of them, in short runs."""
    import corpus_pipeline

    kept = []
    monkeypatch.setattr(packing, "_cut", lambda path, end, length, cached, cut=packing._cut: kept.append(cached) or cut(path, end, length, cached))
    docs = documents(spark, DOCS, clashing=True)
    assert corpus_pipeline.pack(spark, docs, "").count() == packing.pack_documents(docs).count()
    assert kept[0] <= 100_000 < kept[1]
    own = Encoder(vocabulary_path(), cached_parts=1000)
    words = [f"w{k:x}q" for k in range(60_000)]
    texts = pa.array([" ".join(words[a : a + 100]) for a in range(0, len(words), 100)])
    assert [x for _, found in own.runs(texts) for x in found] == Encoder(vocabulary_path()).encode(texts)
    one_run = own.run_bytes // len(words[-1])
    assert len(own.after_space) + len(own.older) <= 2 * (1000 + one_run) < len(words) + 100_000


@pytest.mark.parametrize("parts, kept", [(100, False), (800_000, True)])
def test_a_small_cache_goes_with_its_task(parts, kept):
    from llm.tokens import encoder

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two three", "two four"]})
    rows = [b.num_rows for b in packing._cut(vocabulary_path(), 2, 64, parts)(iter([batch]))]
    own = encoder(vocabulary_path(), parts)
    assert sum(rows) == 2 and bool(own.after_space or own.older or own.bare) is kept
