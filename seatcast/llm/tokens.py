"""Token ids of whole texts with a public tokenizer file, Arrow batch by batch.

Tokenizers that drop white space give the ids of a text as those of its
blank-separated words in a row, so each distinct word of a batch is encoded
once and the ids are gathered by index; a bounded per-worker cache keeps words
between batches.  That property is probed when a tokenizer is loaded; where it
does not hold whole texts go through the library instead.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 250_000        # entries kept by a worker before it starts afresh
SLICE_BYTES = 2 << 20        # text handled at a time (one longer text alone)
LETTERS, MARKS = "a-zß-öø-ÿ", r"!-&(-/:;=>?@\[-`{}~"   # without ', < and |, which the pattern or special tokens use
PLAIN = re.compile(f"[{LETTERS}]+|[{MARKS}]+")      # a run that the tokenizer never cuts
BORDER = f"([{LETTERS}])([{MARKS}])"                 # where it always cuts
PROBES = ("the", "Straße,", "déjà.", "ÈUX!!", "über###", "nto$$$", "a%%%", "ab&&&", "zz", "|", "x;", "ñandú")
#: Printable stand-ins of the byte-level alphabet for the bytes without one.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(_HIDDEN)}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark has the cores
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}
        by_word = [i for w in PROBES for i in self._ids(w)]
        self.splits = self._ids("  \n".join(PROBES) + "\t ") == by_word
        self.plain = self.splits and all(
            np.frombuffer(b"".join(map(self._plain, PLAIN.findall(w.lower()))), self.dtype).tolist() == self._ids(w)
            for w in PROBES if "|" not in w)
        self.cache.clear()

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _pack(self, ids) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _plain(self, run: str) -> bytes:
        chars = run if run.isascii() else run.encode().decode("latin-1").translate(BYTE_CHARS)
        return self._pack([t.id for t in self.model.tokenize(chars)])

    def _word(self, word: str) -> bytes:
        got = self._plain(word) if self.plain and PLAIN.fullmatch(word) else self._pack(self._ids(word))
        self.cache[word] = got
        return got

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.splits:
            ids = [e.ids for e in self.tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            flat = np.fromiter((i for x in ids for i in x), self.dtype)
            return np.cumsum([0, *map(len, ids)]), flat
        if self.plain and not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), BORDER, r"\1 \2")
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        index = words.indices.to_numpy(zero_copy_only=False)
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        get, word = self.cache.get, self._word
        parts = [word(w) if (got := get(w)) is None else got for w in words.dictionary.to_pylist()]
        length = np.fromiter(map(len, parts), np.int64, len(parts)) // self.dtype.itemsize
        start = np.cumsum(length) - length
        pool = np.frombuffer(b"".join(parts), self.dtype)
        each = length[index]
        ends = np.cumsum(each)
        at = np.repeat(start[index] - (ends - each), each)
        at += np.arange(len(at))
        word_ends = np.concatenate([[0], ends])
        list_at = lists.offsets.to_numpy()
        return word_ends[list_at - list_at[0]], pool[at]

    def encode(self, texts: pa.Array):
        """Yield the id array of each text in order; null counts as empty."""
        texts = pc.fill_null(texts, "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        first, total = 0, 0
        for i, n in enumerate([*size, SLICE_BYTES + 1]):
            if i > first and total + n > SLICE_BYTES:
                offsets, ids = self._slice(texts.slice(first, i - first))
                for a, b in zip(offsets[:-1], offsets[1:]):
                    yield ids[a:b]
                first, total = i, 0
            total += n


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder a tokenizer file and Python worker."""
    return WordEncoder(path)
