"""Packing: places are gapless, nothing is lost, and few sequences are used."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from edge_docs import edge_docs, edge_rows, empty_docs
from tokenizers import Tokenizer

from prodlink.llm import grouppack as G
from prodlink.llm import tokenids as T


def check_places(rows, capacity=2048):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_places(spark):
    library = Tokenizer.from_file(T.tokenizer_path(T.WORD_BPE))
    rows = G.packed_documents(edge_docs(spark)).collect()
    check_places(rows)
    want = []
    for i, text, *_ in edge_rows():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for p in range(-(-len(ids) // 2048)):
            part = ids[p * 2048:(p + 1) * 2048]
            want.append((i, p, p * 2048, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_few_sequences(spark, monkeypatch):
    monkeypatch.setattr(G, "INSTANCE", 256)  # several instances and rounds
    rows = G.op3_packing(spark, "/root/testdata/sf0.01").collect()
    least = -(-sum(r.length for r in rows) // 2048)
    assert check_places(rows) <= least + max(2, least // 200)


def test_empty(spark):
    assert G.packed_documents(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_evolution_keeps_every_piece(seed):
    rng = random.Random(seed)
    length = [rng.randint(1, 100) for _ in range(200)]
    a = G.evolve(length, [], 100, seed)
    b = G.mutate(a, length, 100, rng)
    c = G.crossover(a, b, length, 100, rng)
    for bins in (a, b, c, G.evolve(length, [c, b], 100, seed)):
        assert sorted(p for x in bins for p in x) == list(range(200))
        assert all(0 < sum(length[p] for p in x) <= 100 for x in bins)
    decreasing = []
    G.best_fit(sorted(range(200), key=lambda p: -length[p]), length, [], decreasing, 100)
    assert len(a) <= len(decreasing)


def test_texts_reach_the_workers_in_small_batches(spark, monkeypatch):
    setting, seen, stored = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, G.stored
    before = spark.conf.get(setting)

    def watched(df, name):
        seen[name] = spark.conf.get(setting)
        return stored(df, name)

    monkeypatch.setattr(G, "stored", watched)
    assert G.packed_documents(edge_docs(spark)).count() >= len(edge_rows())
    assert int(seen["pieces"]) <= 500 and spark.conf.get(setting) == before
