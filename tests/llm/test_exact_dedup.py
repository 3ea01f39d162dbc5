"""Block naming against grouping by text; block and bucket sizes made small, so all levels and hot keys occur."""

import hashlib
import random
from collections import defaultdict

import pytest
from edge_docs import DOCS, edge_docs, edge_rows, empty_docs

from prodlink.llm import blocknames as B

LOWER = str.maketrans(B.UPPER, B.LOWER)


def brute(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[(text or "").translate(LOWER)].append(i)
    out, seen = [], set()
    for i, text, *_ in rows:
        norm = (text or "").translate(LOWER)
        keep = max((x for x in groups[norm] if x is not None), default=None)
        kept = i == keep and (i, norm) not in seen
        seen.add((i, norm))
        out.append((i, keep, len(groups[norm]), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,run,bucket,hot", [(4096, 64, 1024, 4096), (16, 2, 4, 8)])
def test_groups(spark, monkeypatch, block, run, bucket, hot):
    for name, value in (("BLOCK_BYTES", block), ("RUN", run), ("BUCKET_ROWS", bucket), ("HOT_KEYS", hot)):
        monkeypatch.setattr(B, name, value)
    if block < 100:
        monkeypatch.setattr(B, "HOT_LEAST", 2)
    rows = edge_rows() if block > 100 else [r for r in edge_rows() if r[0] not in (4, 5)]
    docs = edge_docs(spark) if block > 100 else spark.createDataFrame(rows, DOCS)
    got = sorted(map(tuple, B.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)
    assert got == brute(rows)


def test_hot_group(spark, monkeypatch):
    monkeypatch.setattr(B, "HOT_LEAST", 4)
    monkeypatch.setattr(B, "HOT_KEYS", 16)
    monkeypatch.setattr(B, "BLOCK_BYTES", 8)
    rng = random.Random(1)
    rows = [(i, "the same text of some blocks" if i % 3 == 0 else f"text {rng.randint(0, 40)} of some blocks", None, None, None)
            for i in range(300)]
    got = sorted(map(tuple, B.exact_groups(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark):
    assert B.exact_groups(empty_docs(spark)).count() == 0
