"""Cached encoders against the libraries on whole texts."""

import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from edge_docs import edge_rows
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from prodlink.llm import tokenids as T
from prodlink.llm.common import utf8_slices


def cases():
    rng = random.Random(3)
    alphabet = list("ab \n\t\x1c\x1f'sté́ΣİA1.,!<|endoftext|>　_ªº²½·\xa0\xad\x85ßþǅ\x00\x7f") + ["'s", "'re", "A'LL"]
    odd = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(1500)]
    return odd + ["<|endoftext|> x", "<|ENDOFTEXT|>", "it's don't I'LL", " ", " a", "a ", "  ", "a  b", "", " \n", "x" * 500 + "é" * 70] \
        + [chr(c) + "a" + chr(c) for c in range(1, 0x500)] + [r[1] or "" for r in edge_rows() if r[0] != 5]


@pytest.mark.parametrize("limit", [1_500_000, 50])
def test_word_ids(monkeypatch, limit):
    monkeypatch.setattr(T, "CACHE_WORDS", limit)
    library, ours = Tokenizer.from_file(T.tokenizer_path(T.WORD_BPE)), T.WordBpe()
    texts = cases()
    for i, j, raw, off in utf8_slices(pa.array(texts, pa.string()), 4000):
        ids, at = ours(raw, off)
        for d in range(j - i):
            assert ids[at[d]:at[d + 1]].tolist() == library.encode(texts[i + d], add_special_tokens=False).ids, texts[i + d][:50]


def test_piece_counts():
    library, ours = SentencePieceProcessor(model_file=T.tokenizer_path(T.PIECE_BPE)), T.PieceCount()
    for text in cases():
        assert ours(text) == len(library.encode(text)), text[:50]


def test_piece_counts_of_all_short_texts():
    """Every text of up to six characters over a letter, a space, the model's own space mark and a line end."""
    library, ours = SentencePieceProcessor(model_file=T.tokenizer_path(T.PIECE_BPE)), T.PieceCount()
    texts = ["".join(t) for n in range(7) for t in product("a ▁\n", repeat=n)]
    wrong = [t for t, ids in zip(texts, library.encode(texts)) if ours(t) != len(ids)]
    assert not wrong, wrong[:5]


def test_with_end():
    ids, at = T.with_end(np.array([5, 6, 7], np.uint32), np.array([0, 0, 2, 3]), 2)
    assert ids.tolist() == [2, 5, 6, 2, 7, 2] and at.tolist() == [0, 1, 4, 6]
