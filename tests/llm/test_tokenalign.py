"""Operator 11 against both libraries, whole texts and a brute-force count."""

import hashlib
import random
from collections import Counter

import pytest
from edge_docs import DOCS, SF, edge_docs, edge_rows, empty_docs
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from prodlink.llm import tokenalign as T
from prodlink.llm.common import stored
from prodlink.llm.tokenids import PIECE_BPE, tokenizer_path


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(tokenizer_path(T.BYTE_BPE))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))


def cases():
    rng = random.Random(1)
    alphabet = list("ab  \n\t'sté́İA1.,!>　_ªº²½·\xa0\xad\x85ßþ\x00\x7f▁日本😀​﻿×÷") \
        + ["'s", "<|endoftext|>", "<s>", "<0x41>", "  ", " the", " of"]
    return (["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(2500)]
            + ["".join(rng.choices("a ▁\n", k=rng.randint(0, 7))) for _ in range(800)])


def groups_of(text, both):
    """(groups in writing, n_a, n_b, links) from the two libraries' whole encodings."""
    units = T.aligner()
    a = both[0].encode(" " + text, add_special_tokens=False).ids if text else []
    b = both[1].encode(text) if text else []
    bytes_a, bytes_b = [units.bytes_a[i] for i in a], [units.bytes_b[i] for i in b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return "", 0, 0, []
    groups, links, i, j = [], [], 0, 0
    while i < len(a):
        x, y, end_a, end_b = i + 1, j + 1, len(bytes_a[i]), len(bytes_b[j])
        while end_a != end_b:
            if end_a < end_b:
                end_a += len(bytes_a[x])
                x += 1
            else:
                end_b += len(bytes_b[y])
                y += 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        links.append((a[x - 1], b[y - 1]))
        i, j = x, y
    return ";".join(groups), len(a), len(b), links


def brute(rows, both):
    found = [(r[0], *groups_of(r[1] or "", both)) for r in rows]
    count = Counter(link for f in found for link in f[4])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(((i, a, b, len(links), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for i, g, a, b, links in found), key=str)


@pytest.mark.parametrize("units", [500_000, 40])
def test_units_are_whole_texts(monkeypatch, both, units):
    monkeypatch.setattr(T, "UNITS", units)
    align, texts = T.Aligner(), cases()
    for i in range(0, len(texts), 50):
        for text, (groups, counts, pairs) in zip(texts[i:i + 50], align(texts[i:i + 50])):
            g, n_a, n_b, links = groups_of(text, both)
            assert (groups, *counts) == (g, n_a, n_b, len(links)), text
            assert [divmod(int(p) & 0xFFFFFFFF, 1 << 16) for p in pairs] == links


def test_identity_map():
    units, same = T.aligner(), T.identity_map()
    assert len(same) == len(units.bytes_a)
    assert all(units.bytes_a[i] == units.bytes_b[b] for i, b in enumerate(same) if b >= 0)
    assert {units.bytes_a[i] for i in range(len(same)) if same[i] < 0}.isdisjoint(x for x in units.bytes_b if x)


def test_bytes_of_all_ids(both):
    units = T.aligner()
    assert units._fast is not None
    for i in range(0, len(units.bytes_a) - 1, 7):
        assert both[0].decode([i]) == units.bytes_a[i].decode(errors="replace")


def scored(spark, docs):
    aligned = stored(T.aligned_groups(docs).selectExpr("*", "monotonically_increasing_id() AS row"), "aligned")
    counts = stored(T.link_counts(aligned), "link-counts")
    rows = T.scored_documents(aligned, counts).selectExpr(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "IF(groups = '', '', sha2(groups, 256)) AS g")
    return sorted(map(tuple, rows.collect()), key=str), counts


@pytest.mark.parametrize("share", [T.HEAD_SHARE, 0.01, 2.0])
def test_scores(spark, both, monkeypatch, share):
    monkeypatch.setattr(T, "HEAD_SHARE", share)  # all pairs from the head, some, none
    rows, counts = scored(spark, edge_docs(spark))
    assert rows == brute(edge_rows(), both)
    same = T.identity_map()
    assert all((same[r.a] == r.b) == r.regular for r in counts.collect())


def test_spaces_and_marks(spark, both):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(cases()[::5] + ["a ▁ b", None, ""])]
    assert scored(spark, spark.createDataFrame(rows, DOCS))[0] == brute(rows, both)


def test_empty(spark):
    assert scored(spark, empty_docs(spark))[0] == []


def test_query(spark, both):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = T.op11_token_alignment(spark, SF)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, both)
