"""Token ids of whole texts, with the tokenizers library.

A byte-level BPE never joins what stands on both sides of a single space between two other characters: the space opens the
next piece. So texts are cut there, each different part is looked up once per run of texts and encoded once per worker
process (a bounded cache), and a text's ids are the concatenated ids of its parts. The result is that of encoding the whole
text, which a test compares.

A text that holds the string of an added (special) token is encoded whole, as the library does it by default.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from llm.text import chunks, utf8

VOCABULARY = "byte_bpe_50k.json"
CACHED_PARTS = 800_000
JOINED_PARTS = 2_000
RUN_BYTES, LEAST_RUN_BYTES = 4 << 20, 1 << 18
END_ID = 2
SPACE = "\u0120"  # as the vocabulary writes it
_TAILS = ".,!?;:|*#%&$"
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, cached_parts: int = CACHED_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.cached_parts = cached_parts
        self.run_bytes = max(RUN_BYTES * cached_parts // CACHED_PARTS, LEAST_RUN_BYTES)  # a smaller cache goes with shorter runs
        # Two generations of at most cached_parts: a full one becomes the older, from which parts still in use come back.
        self.after_space: dict[str, bytes] = {}  # no ids: the part can't be cut off
        self.older: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that begin with a space
        for token, number in self.tokenizer.get_vocab().items():
            self.opens[number] = token.startswith(SPACE)

    def forget(self) -> None:
        """Empties the cache."""
        self.after_space, self.older, self.bare = {}, {}, {}

    def _batch(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _after_space(self, parts: list[str]) -> list[bytes]:
        """Ids of parts with a space before them: many parts are one text, cut again where tokens begin with a space."""
        out: list[bytes] = []
        for a in range(0, len(parts), JOINED_PARTS):
            some = parts[a : a + JOINED_PARTS]
            data = self._batch([" " + " ".join(some)])[0]
            edges = [*(4 * np.flatnonzero(self.opens[np.frombuffer(data, "<u4")])).tolist(), len(data)]
            whole = len(edges) == len(some) + 1 and edges[0] == 0
            out += [data[i:j] for i, j in zip(edges[:-1], edges[1:])] if whole else self._batch([" " + x for x in some])
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of ASCII letters with a space before them: each word is one piece, which the model takes as the vocabulary writes it."""
        found, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for word in words:
            ids += [token.id for token in found(SPACE + word)]
            ends.append(4 * len(ids))
        data = np.array(ids, dtype="<u4").tobytes()
        return [data[i:j] for i, j in zip(ends[:-1], ends[1:])]

    def _learn(self, parts: Iterable[str]) -> None:
        """Encodes parts that follow a space. Letters with punctuation behind them are two pieces, learned one by one."""
        cache, older = self.after_space, self.older
        split, fresh = [], []
        for part in parts:
            if part in older:
                cache[part] = older[part]
            elif part.isalpha():
                fresh.append(part)
            elif not part or part[0].isspace() or part[-1].isspace():
                cache[part] = b""
            else:
                core = part.rstrip(_TAILS)
                if len(core) < len(part) and core and core[-1].isalpha():
                    split.append((part, core))
                else:
                    fresh.append(part)
        cores = {core for _, core in split if core not in cache}.difference(fresh)
        cache.update((core, older[core]) for core in cores if core in older)
        fresh += [core for core in cores if core not in older]
        words = [x for x in fresh if x.isascii() and x.isalpha()]
        cache.update(zip(words, self._words(words)))
        others = [x for x in fresh if not (x.isascii() and x.isalpha())]
        cache.update(zip(others, self._after_space(others)))
        self._learn_bare([part[len(core) :] for part, core in split])
        for part, core in split:
            cache[part] = cache[core] + self.bare[part[len(core) :]]

    def _learn_bare(self, texts: Iterable[str]) -> None:
        fresh = [x for x in set(texts) if x not in self.bare]
        self.bare.update(zip(fresh, self._batch(fresh)))

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text; a null is an empty text."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), "")
        whole = np.zeros(len(texts), bool)
        for string in self.added:
            whole |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._encode(texts)
        out = self._encode(pc.if_else(pa.array(whole), "", texts))
        for i, data in zip(np.flatnonzero(whole).tolist(), self._batch(texts.filter(pa.array(whole)).to_pylist())):
            out[i] = data
        return out

    def runs(self, texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
        """Ids of the texts of a column, in runs of about ``run_bytes``: the number of the first text, and the ids of each."""
        for first, last in chunks(utf8(texts)[1], self.run_bytes):
            yield first, self.encode(texts.slice(first, last - first))

    def _encode(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        if len(self.after_space) > self.cached_parts:
            self.older, self.after_space = self.after_space, {}
        if len(self.bare) > self.cached_parts // 8:
            self.bare = {}
        cut = pc.split_pattern(texts.cast(pa.large_string()), " ")
        edges = cut.offsets.to_numpy()
        heads = cut.values.take(cut.offsets[:-1]).to_pylist()
        coded = cut.values.dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # far faster than to_pylist
        found = list(map(self.after_space.get, parts))
        unknown = [k for k, data in enumerate(found) if data is None]
        self._learn([parts[k] for k in unknown])
        for k in unknown:
            found[k] = self.after_space[parts[k]]
        self._learn_bare(heads)
        found += map(self.bare.__getitem__, heads)
        # A part's number is its place in the dictionary; heads, which follow no space, have numbers of their own.
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        numbers[edges[:-1]] = np.arange(len(parts), len(found))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        unsafe = sizes == 0
        unsafe[len(parts) :] = [not x or x[-1].isspace() for x in heads] & (np.diff(edges) > 1)
        taken = sizes[numbers]
        ends = np.cumsum(taken)
        # Each id's place in the ids of all different parts: where its own part begins there, and how far it is inside.
        places = np.repeat((np.cumsum(sizes) - sizes)[numbers] - (ends - taken), taken)
        places += np.arange(len(places))
        ids = np.frombuffer(b"".join(found), "<u4")[places].tobytes()
        last = (4 * ends[edges[1:] - 1]).tolist()
        out = [ids[a:b] for a, b in zip([0, *last], last)]
        if unsafe.any():
            for i in np.unique(np.searchsorted(edges, np.flatnonzero(unsafe[numbers]), "right") - 1).tolist():
                head, *others = texts[i].as_py().split(" ")
                out[i] = self._merged(head, others)
        return out

    def _merged(self, head: str, parts: list[str]) -> bytes:
        """For texts with runs of white space: cuts only where it is safe."""
        runs = [head]
        for part in parts:
            last = runs[-1]
            if last and not last[-1].isspace() and part and not part[0].isspace():
                runs.append(" " + part)
            else:
                runs[-1] = last + " " + part
        return b"".join(self._batch(runs))


def encoder(path: str, cached_parts: int = CACHED_PARTS) -> Encoder:
    """One encoder per worker process, vocabulary and size of its cache."""
    if (path, cached_parts) not in _ENCODERS:
        _ENCODERS[path, cached_parts] = Encoder(path, cached_parts)
    return _ENCODERS[path, cached_parts]


def end_bytes(end_id: int) -> bytes:
    return np.array([end_id], dtype="<u4").tobytes()
