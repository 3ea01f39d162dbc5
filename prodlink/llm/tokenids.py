"""Token ids of whole texts by the public tokenizers, with a per-word cache.

Both tokenizers never merge across a word border, so the ids of a text are the ids of its
words one after another. Encoding each distinct word once and joining the stored bytes is
several times faster than encoding texts; the ids are the library's own in every case
(``tests/llm/test_tokenids.py`` compares whole texts).
"""

from __future__ import annotations

import os
import re
from functools import cache
from unicodedata import is_normalized

import numpy as np

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
CACHE_WORDS = 800_000    # words kept by one Python worker; the cache starts anew beyond that
CACHE_PIECES = 200_000   # and pre-tokens
CACHE_CHARS = 64        # longer words (bytes) are encoded each time

_SPACED_WORDS = re.compile(" +[^ ]*")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; resolved where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Words(dict):
    """word -> value, filled on first use and emptied when it holds CACHE_WORDS words."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES * 2:
                self.clear()
            self[word] = value
        return value


_PLAIN = re.compile("[\\x21-\u024f]+")              # characters whose class and case need no newer Unicode table
_PRE_TOKENS = re.compile(                              # fixed value: the split pattern of this tokenizer (and line ends)
    r"\n|'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")
_ODD = re.compile("[\x7f-\xa0\xb2\xb3\xb9\xbc-\xbe]")  # spaces and digits of other classes: left to the library
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD_END = np.array([0xFFFFFFFF], np.uint32)          # no id
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SLOT_BITS = 21                                        # slots of the word table: over two a word kept (25 MB)
_INVERSE = pow(_BASE, -1, 1 << 64)


class WordBpe:
    """``word_bpe_49k.json`` without added special tokens, for runs of whole texts.

    Words (between ASCII white space, which this tokenizer drops) are looked up by a 64-bit
    hash; new ones are encoded by the library, many in one call.
    """

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path or tokenizer_path(WORD_BPE))
        # The same model for pre-tokens that are already split, in lower case and composed.
        self._pre_split = Tokenizer.from_str(self._tokenizer.to_str())
        self._pre_split.normalizer = normalizers.Sequence([])
        self._pre_split.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocab.values()) + 1, bool)
        self._ends[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self._power = self._inverse = np.zeros(0, np.uint64)
        self._forget()

    def _forget(self) -> None:
        self._pieces: dict[str, bytes] = {}
        # Open addressing by the keys' upper bits: a word's key (0 is a free slot) and its number.
        self._slots, self._number = np.zeros(1 << _SLOT_BITS, np.uint64), np.zeros(1 << _SLOT_BITS, np.int32)
        self._at, self._len = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._pool, self._pool_size = np.zeros(1 << 16, np.uint32), 0

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the words, -1 for unknown ones."""
        out = np.full(len(keys), -1, np.int64)
        slot, todo = (keys >> np.uint64(64 - _SLOT_BITS)).astype(np.int64), np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            there = self._slots[at]
            hit = there == keys[todo]
            out[todo[hit]] = self._number[at[hit]]
            todo = todo[~hit & (there != 0)]
            slot[todo] = slot[todo] + 1 & (1 << _SLOT_BITS) - 1
        return out

    def _add(self, keys: np.ndarray) -> None:
        """Give distinct new words the next numbers."""
        slot, todo = (keys >> np.uint64(64 - _SLOT_BITS)).astype(np.int64), np.arange(len(keys))
        while len(todo):
            free = todo[self._slots[slot[todo]] == 0]
            self._slots[slot[free]] = keys[free]  # of several for one slot, one stays
            todo = todo[self._slots[slot[todo]] != keys[todo]]
            slot[todo] = slot[todo] + 1 & (1 << _SLOT_BITS) - 1
        self._number[slot] = np.arange(len(self._at), len(self._at) + len(keys))

    def plain(self, text: str) -> np.ndarray:
        """The library's ids of one text."""
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    @staticmethod
    def _is_plain(w: str) -> bool:
        """Can the word be split here, as the tokenizer would?"""
        if w.isascii():
            return w.isprintable() and "<|" not in w
        return bool(_PLAIN.fullmatch(w)) and "<|" not in w and not _ODD.search(w) and is_normalized("NFC", w)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Encode new words and add them to the table."""
        if len(self._pieces) > CACHE_PIECES:
            self._pieces = {}
        pieces = self._pieces
        plain = np.array([self._is_plain(w) for w in words], bool)
        tokens = _PRE_TOKENS.findall("\n".join([w for w, p in zip(words, plain) if p]).lower() + "\n")
        new = [t for t in dict.fromkeys(tokens) if t not in pieces and t != "\n"]
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            ids = np.array(self._pre_split.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids,
                           np.uint32)
            cut = np.flatnonzero(self._ends[ids]) + 1
            if len(cut) == len(part) and cut[-1] == len(ids):
                flat, cut = ids.tobytes(), [0, *(4 * cut).tolist()]
                pieces.update((p, flat[a:b]) for p, a, b in zip(part, cut, cut[1:]))
            else:
                pieces.update((p, self.plain(p).tobytes()) for p in part)
        pieces["\n"] = _WORD_END.tobytes()
        ids = np.frombuffer(b"".join(map(pieces.__getitem__, tokens)), np.uint32)
        ends = np.flatnonzero(ids == _WORD_END[0])[:int(plain.sum())]
        lens = np.diff(np.r_[-1, ends]) - 1
        ids = ids[ids != _WORD_END[0]]
        other = [self.plain(w) for w, p in zip(words, plain) if not p]
        keys = np.concatenate([keys[plain], keys[~plain]])
        lens = np.concatenate([lens, np.array([len(x) for x in other], np.int64)])
        ids = np.concatenate([ids, *other])
        need = self._pool_size + len(ids)
        if need > len(self._pool):
            self._pool = np.concatenate([self._pool[:self._pool_size], np.zeros(2 * need - self._pool_size, np.uint32)])
        at = self._pool_size + np.cumsum(lens) - lens
        self._pool[self._pool_size:need] = ids
        self._pool_size = need
        self._add(keys)
        self._at, self._len = np.concatenate([self._at, at]), np.concatenate([self._len, lens])

    def __call__(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of some texts and their offsets -> ids of all, and each text's offsets into them."""
        n = len(raw)
        if len(self._power) <= n:
            self._power, self._inverse = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(n + n // 8, b, np.uint64)])
                                          for b in (np.uint64(_BASE), np.uint64(_INVERSE)))
        data = raw.tobytes()
        if b"<|" not in data:  # else case may decide whether a marker is one
            raw = np.frombuffer(data.translate(_LOWER), np.uint8)  # the tokenizer does so anyway; fewer distinct words
        word = ~_ASCII_SPACE[raw]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before = np.r_[False, word[:-1]] if n else word
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.r_[word[1:], False] if n else word
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._power[:n], out=prefix[1:])
        keys = (prefix[ends] - prefix[starts]) * self._inverse[starts]
        keys ^= keys >> np.uint64(32)
        keys = np.maximum(keys * np.uint64(_MIX), np.uint64(1))
        size = ends - starts
        # Long words are told apart by position, not by hash, and encoded each time.
        long_words = np.flatnonzero(size > CACHE_CHARS)
        at, lens = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        short = np.flatnonzero(size <= CACHE_CHARS)
        k = keys[short]
        for _ in range(2):
            where = self._find(k)
            miss = np.flatnonzero(where < 0)
            if not len(miss):
                break
            new, first = np.unique(k[miss], return_index=True)
            if len(self._at) + len(new) > CACHE_WORDS and len(self._at):
                self._forget()  # begin anew with all words of this run
                new, first = np.unique(k, return_index=True)
                miss = np.arange(len(k))
            pick = short[miss[first]]
            if len(self._at) > CACHE_WORDS:
                self._forget()
            # All new words in one string, each with a line end in place of what follows it.
            after = np.cumsum(size[pick] + 1)
            text = raw[np.minimum(np.repeat(starts[pick] - (after - size[pick] - 1), size[pick] + 1)
                                  + np.arange(after[-1]), n - 1)]
            text[after - 1] = 10
            self._learn(new, text.tobytes().decode().split("\n")[:-1])
        if len(k):
            at[short], lens[short] = self._at[where], self._len[where]
        pool = self._pool
        if len(long_words):
            extra = [self.plain(raw[starts[i]:ends[i]].tobytes().decode()) for i in long_words]
            more = np.array([len(x) for x in extra], np.int64)
            at[long_words], lens[long_words] = self._pool_size + np.cumsum(more) - more, more
            pool = np.concatenate([self._pool[:self._pool_size], *extra])
        total = np.r_[0, np.cumsum(lens)]
        ids = pool[np.repeat(at - total[:-1], lens) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, off)]


@cache
def word_bpe(path: str | None = None) -> WordBpe:
    """One per Python worker, so the words stay known from task to task."""
    return WordBpe(path)


def with_end(ids: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` appended to each document's ids."""
    return np.insert(ids, off[1:], end), off + np.arange(len(off))


class PieceCount:
    """Number of ids ``piece_bpe_32k.model`` gives for a text, without begin or end ids."""

    def __init__(self, path: str | None = None):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path or tokenizer_path(PIECE_BPE))
        spanning = [p for p in map(model.id_to_piece, range(model.get_piece_size())) if re.search("[^▁]▁", p)]
        if spanning:
            raise ValueError(f"pieces cross word borders, words cannot be counted alone: {spanning[:3]}")
        # One space before the text is the model's own; a word is encoded behind it as well.
        self._get = _Words(lambda w: len(model.encode(w))).__getitem__

    def __call__(self, text: str) -> int:
        # The model writes a space as U+2581, so one in the text is a space like any other.
        words = (text.replace("▁", " ") if "▁" in text else text).split(" ")
        if "" not in words:
            return sum(map(self._get, words))
        if not text:
            return 0
        # Runs of spaces: each run but its first space belongs to the following word.
        parts = [w[1:] for w in _SPACED_WORDS.findall(" " + " ".join(words))]
        lone = not parts[-1]  # a single space at the end is one id of its own
        return sum(map(self._get, parts[:-1] if lone else parts)) + lone


@cache
def piece_count(path: str | None = None) -> PieceCount:
    return PieceCount(path)
