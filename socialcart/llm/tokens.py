"""Token ids of whole texts by a public tokenizer file, with a bounded cache.

The tokenizer drops white space and never joins pieces across it, so a text's
ids are the ids of its blank-separated chunks in order.  Texts are split and
their distinct chunks found by Arrow, a batch at a time, so Python sees each
distinct chunk of a batch once.  Each worker keeps the ids of the chunks seen
so far (at most ``CACHE_CHUNKS``, then it starts afresh) and encodes new ones
together; the ids of all texts are then put side by side by numpy.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_CHUNKS = 400_000

# a comma or full stop after an ASCII letter or digit
_TAIL = re.compile(rb"[a-z0-9][,.]\Z")


class ChunkEncoder:
    """Texts → their ids as little-endian numbers (``dtype``)."""

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.word_end = self._word_ends()
        self.cache: dict[bytes, bytes] = {}
        self.cache_chunks = cache_chunks

    def _word_ends(self) -> np.ndarray | None:
        """Which ids end a word, if the vocabulary marks word ends."""
        vocab = self.tokenizer.get_vocab()
        out = np.zeros(max(vocab.values(), default=0) + 1, bool)
        out[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        return out if out.any() else None

    def encode(self, texts: Iterable[bytes]) -> list[bytes]:
        """The ids of each text as bytes."""
        ids, ends = self.encode_array(pa.array([t.decode() for t in texts], pa.string()))
        return [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=False)]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts side by side, where each text's end); a null text
        has none.  Chunks are lower-cased, which changes no id; texts that may
        hold a special token stay as they are."""
        texts = pc.fill_null(texts, "")
        own = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(own)
        chunks = lists.flatten().dictionary_encode()
        coded = self._ids(chunks.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(coded), self.dtype)
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // self.dtype.itemsize
        which = chunks.indices.to_numpy()
        length = size[which]
        done = np.concatenate([[0], np.cumsum(length)])
        shift = (np.cumsum(size) - size)[which] - done[:-1]
        ids = flat[np.repeat(shift, length) + np.arange(done[-1])]
        return ids, done[np.cumsum(pc.list_value_length(lists).to_numpy())]

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks.  A comma or full stop after a letter or
        digit is encoded apart from the word, which changes no id, so words
        are learnt once."""
        if len(self.cache) > self.cache_chunks:
            self.cache.clear()
        get = self.cache.get
        found = list(map(get, chunks))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            cut = [len(c) - 1 if _TAIL.search(c) and b"<|" not in c else len(c) for c in (chunks[i] for i in new)]
            bodies = [chunks[i][:n] for i, n in zip(new, cut, strict=True)]
            tails = [chunks[i][n:] for i, n in zip(new, cut, strict=True)]
            self._learn([c for c in {*bodies, *tails} if c not in self.cache])
            for i, body, tail in zip(new, bodies, tails, strict=True):
                found[i] = get(body) + get(tail)
        return found

    def _learn(self, new: list[bytes]) -> None:
        text = [c.decode() for c in new]
        for alone, encode in ((True, self._words), (False, self._each)):
            at = [i for i, t in enumerate(text) if t.isalpha() == alone]
            self.cache.update(zip([new[i] for i in at], encode([text[i] for i in at]), strict=True))

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words made of letters only: many are encoded as one text and
        told apart by the tokens that end a word."""
        if self.word_end is None:
            return self._each(words)
        out, size = [], self.dtype.itemsize
        joined = [" ".join(words[i:i + 1000]) for i in range(0, len(words), 1000)]
        for i, e in enumerate(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            cuts = ((np.flatnonzero(self.word_end[ids]) + 1) * size).tolist()
            some = words[1000 * i:1000 * (i + 1)]
            if len(cuts) != len(some):
                out += self._each(some)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        return out


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and file."""
    return ChunkEncoder(path)


def public_path(name: str) -> str:
    """Place of a public tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)
