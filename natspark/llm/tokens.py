"""Token ids of whole texts by a public tokenizer, at a fraction of the cost of encoding each text by itself.

The tokenizer lower-cases, drops white space and never lets a token span it, so a text's ids are its words' ids laid
end to end. Words are lower-cased, and closing signs after a letter are a word of their own, as to the tokenizer. A
batch's distinct words are found by Arrow, encoded once, and gathered back by numpy. White space here is the ASCII kind
only; any other stays inside a "word" and is left to the tokenizer.

Words met once are forgotten when there are too many; those met again stay.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Bytes of text encoded at a time, and words remembered; both bound a task's memory.
BLOCK_BYTES = 3 << 20
CACHE_WORDS = 300_000
_JOINED = 200
_SIGN, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_SIGN[list(b"!\"#$%&()*+,-./:;=?@[]^_`{}~")] = _LETTER[list(b"abcdefghijklmnopqrstuvwxyz")] = True


class WordEncoder:
    def __init__(self, path: str, remembered: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.path, self.remembered = path, remembered
        self.tokenizer = Tokenizer.from_file(path)
        #: The same model, held once, for words that the normalizer and the pattern leave as they are.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.index: dict[str, int] = {"": 0}
        self.pool = np.empty(1 << 20, np.uint32)
        self.start, self.length, self.uses = (np.zeros(1 << 18, kind) for kind in (np.int64, np.int32, np.int32))
        self.used = 0

    def _forget(self) -> None:
        """Keep the empty word and those met in several blocks, unless these are too many themselves."""
        words = [w for w, i in self.index.items() if not w or self.uses[i] > 1]
        words = words if len(words) <= self.remembered // 2 else [""]
        old = np.fromiter((self.index[w] for w in words), np.int64, len(words))
        start, length = self.start[old], self.length[old]
        to = np.cumsum(length)
        pool = self.pool[np.arange(to[-1]) + np.repeat(start - (to - length), length)]
        self.pool[: len(pool)], self.used = pool, len(pool)
        self.start[: len(old)], self.length[: len(old)], self.uses[:] = to - length, length, 0
        self.index = dict(zip(words, range(len(words))))

    def _add(self, words: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        n, k, m = len(self.index), len(words), len(flat)
        while n + k > len(self.start):
            self.start, self.length, self.uses = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.uses))
        while self.used + m > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + m] = flat
        self.length[n : n + k] = lengths
        self.start[n : n + k] = self.used + np.cumsum(lengths) - lengths
        self.used += m
        self.index.update(zip(words, range(n, n + k)))

    def _learn(self, words: list[str]) -> None:
        """Words of lower-case letters are encoded many at a time and told apart by the tokens that end a word; if their
        number isn't as foreseen, and for all other words, each is encoded alone by the whole tokenizer."""
        plain, alone = [], []
        for w in words:
            (plain if w.isalpha() and w == w.lower() and (w.isascii() or is_normalized("NFC", w)) else alone).append(w)
        parts = [plain[i : i + _JOINED] for i in range(0, len(plain), _JOINED)]
        for part, got in zip(parts, self.plain.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            flat = np.array(got.ids, np.uint32)
            last = np.flatnonzero(self.ends[flat])
            if len(last) == len(part):
                self._add(part, flat, np.diff(last, prepend=-1))
            else:
                alone += part
        if alone:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
            self._add(alone, np.array([i for x in got for i in x], np.uint32), np.fromiter(map(len, got), np.int64, len(got)))

    def encode(self, texts: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these texts, each text's closed by ``end_id``, and the number of ids of each; null is empty."""
        if len(self.index) > self.remembered:
            self._forget()
        words, n_words = split_signs(texts)
        words = words.dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = self.index
        new = [w for w in distinct if w not in index]
        if new:
            self._learn(new)
        of_word = np.fromiter(map(index.__getitem__, distinct), np.int64, len(distinct))
        self.uses[of_word] += 1
        of = of_word[words.indices.to_numpy()] if len(distinct) else np.empty(0, np.int64)
        stop = np.cumsum(n_words)
        lengths = np.insert(self.length[of], stop, 1)
        starts = np.insert(self.start[of], stop, -1)
        to = np.cumsum(lengths)
        ids = np.ones(int(to[-1]) if len(to) else 0, np.int64)
        full = lengths > 0
        first, begin = (to - lengths)[full], starts[full]
        if len(ids):  # a running sum of steps gives each id's place in the pool
            ids[first[1:]] = begin[1:] - (begin[:-1] + lengths[full][:-1] - 1)
            ids[0] = begin[0]
            np.cumsum(ids, out=ids)
        closing = to[stop + np.arange(len(stop))] - 1
        ids[closing] = 0
        out = self.pool[ids]
        out[closing] = end_id
        return out, np.diff(closing, prepend=-1)


def split_signs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words in lower case, closing signs after a letter apart, and the number of words of each text. Texts that may
    hold a special token keep their capitals, as these tell it from other text."""
    texts = pc.fill_null(texts, "")
    if not pc.any(pc.match_substring(texts, "<|")).as_py():
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    words, of_text = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    _, offsets, data = words.buffers()
    if not len(words) or data is None:
        return words, np.diff(of_text)
    at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
    letters = np.frombuffer(data, np.uint8)
    cut = _sign_starts(letters, at)
    inside = cut > 0
    new = np.insert(at, np.flatnonzero(inside) + 1, cut[inside])
    more = np.concatenate([[0], np.cumsum(inside)])
    return pa.StringArray.from_buffers(len(new) - 1, pa.py_buffer(new), data), np.diff(of_text + more[of_text - of_text[0]])


def _sign_starts(letters: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the closing signs of each word begin, if there are up to eight of them after a Latin letter; else 0."""
    cut = np.zeros(len(at) - 1, np.int32)
    word = np.flatnonzero(np.diff(at) > 1)
    begin, end = at[word], at[word + 1]
    for k in range(1, 9):
        going = _SIGN[letters[end - k]] & (end - k > begin)
        word, begin, end = word[going], begin[going], end[going]
        before = letters[end - k - 1]
        second = (end - k - 1 > begin) & (before & 0xC0 == 0x80)
        lead = letters[end - k - 1 - second]
        # Two-byte letters; not the two signs among them, nor the dotted I, whose small form ends with a mark.
        wide = second & (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & (before & 0xDF == 0x97)) & ~((lead == 0xC4) & (before == 0xB0))
        done = _LETTER[before] | wide
        cut[word[done]] = end[done] - k
        word, begin, end = word[~done], begin[~done], end[~done]
    return cut


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None) -> WordEncoder:
    """The encoder of this Python worker; ``path`` defaults to the public tokenizer file of the box."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return WordEncoder(path)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries than glibc don't have it
        ctypes.CDLL(None).malloc_trim(0)


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows whose texts hold about ``limit`` bytes; a longer text stands alone. After each
    one, memory that Arrow and the allocator keep for later goes back to the system: else what the blocks of a batch
    leave adds up beside the executor's heap, and a worker lives on for other stages."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield batch.slice(begin, i - begin)
            _give_back()
            begin, total = i, 0
        total += int(size)
    if len(sizes) > begin:
        yield batch.slice(begin)
    _give_back()
