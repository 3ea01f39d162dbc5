"""Near-duplicate groups against exact links; large buckets forced, so the block path runs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from edge_docs import DOCS, edge_docs, edge_rows, empty_docs

from prodlink.llm import neardup as N
from prodlink.llm.common import LOWER, UPPER
from prodlink.llm.components import components
from prodlink.llm.superminhash import shingle_sets, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CASE = str.maketrans(UPPER, LOWER)


def sets_of(rows):
    out = {}
    for i, text, *_ in rows:
        w = WORD.findall((text or "").translate(CASE))
        out[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute(rows):
    """{id: component} by all pairs; ids not null."""
    sets = sets_of(rows)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def family_rows(n=220, seed=0, edits=(0, 1, 2, 4, 8)):
    """One text with more or fewer words changed: links in chains, not all to the first."""
    rng = random.Random(seed)
    words = [f"u{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(160)]
    rows = []
    for i in range(n):
        text = list(base) if rng.random() < 0.8 else [rng.choice(words) for _ in range(50)]
        for _ in range(rng.choice(edits)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((rng.randrange(10_000) * 1000 + i, " ".join(text), None, None, None))
    return rows


@pytest.mark.parametrize("small,block", [(64, 1024), (4, 16)])
def test_components(spark, monkeypatch, small, block):
    monkeypatch.setattr(N, "SMALL_BUCKET", small)
    monkeypatch.setattr(N, "BLOCK", block)
    rows = family_rows()
    got = {r.key: r.component for r in N.near_groups(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute(rows)


def test_edge_rows(spark):
    rows = edge_rows()
    out = N.near_groups(edge_docs(spark)).collect()
    assert len(out) == len(rows)
    known = [r for r in rows if r[0] is not None]
    want, sizes = brute(known), {i: len(s) for i, s in sets_of(known).items()}
    # The two rows without an id: one equals row 103 and leads its group, the other is alone.
    lead = {r.key: r.component for r in out if r.key >= 0}
    first = rows[3][0]
    same = {i for i in want if want[i] == want[first]}
    assert {i: c for i, c in lead.items() if i not in same} == {i: c for i, c in want.items() if i not in same}
    assert len({lead[i] for i in same}) == 1 and lead[first] < 0
    assert all(sizes[r.key] == r.n for r in out if r.key >= 0)
    assert sum(r.key < 0 and r.key == r.component for r in out) == 2
    kept = N.near_dedup_stage(spark, edge_docs(spark), "").collect()
    assert sum(r.doc_id == 9 for r in kept) == 1 and sum(r.doc_id is None for r in kept) == 2


def test_empty(spark):
    assert N.near_groups(empty_docs(spark)).count() == 0


def test_links_in_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1002, 1001), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(links.repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1001: 1000, 1002: 1000}
    assert components(links.filter("false")).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    wrong = defaultdict(list)
    for size in (20, 400):
        for _ in range(60):
            a = rng.integers(0, 2**63, 2 * size).astype(np.uint64)
            x, y = a[:size], a[size // 4:size + size // 4]
            sig = signatures(np.concatenate([x, y]), np.array([0, size, 2 * size]), N.PLACES)
            wrong[size].append((sig[0] == sig[1]).mean() - 0.6)
    for size, errors in wrong.items():
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_shingle_sets_are_those_of_each_text():
    texts = ["A b c d e f", "", "a B c", " \n", "a b c d e f a b c d e f"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    sets, at = shingle_sets(raw, off)
    assert np.diff(at).tolist() == [2, 0, 1, 0, 6]
