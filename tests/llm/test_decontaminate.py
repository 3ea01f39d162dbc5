"""Decontamination against windows looked up one by one, in one block of items and in several."""

import hashlib
import random
import re

import pytest
from edge_docs import DOCS, edge_rows, empty_docs

from prodlink.llm import decontaminate as D
from prodlink.llm.common import LOWER, UPPER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CASE = str.maketrans(UPPER, LOWER)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(CASE))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).add("null" if item is None else str(item))
    out = []
    for i, text, *_ in docs:
        w = WORD.findall((text or "").translate(CASE))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[k:k + size])):
                    found |= owners
                    hit |= set(range(k, k + size))
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("words", [4_000_000, 200])
def test_hits(spark, monkeypatch, words):
    monkeypatch.setattr(D, "BLOCK_WORDS", words)
    rng = random.Random(5)
    vocabulary = [f"b{i}" for i in range(80)] + ["Ä", "x-y"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 12, 13, 14, 40])))) for i in range(20)]
    items += [(3, items[5][1]), (None, "no id but thirteen words " * 3), (98, ""), (99, None), (97, "... !")]
    docs = [(i, t, *r) for i, t, *r in edge_rows() if i != 5]
    for i in range(60):
        parts = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), (rng.choice(items)[1] or "").upper())
        docs.append((1000 + i, " ".join(parts), None, None, None))
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS n_words", "2 AS item")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted([(r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated)
                  for r in D.find_hits(df, bench, ["doc_id"]).collect()], key=str)
    assert got == brute(docs, items)
    assert D.find_hits(df, bench.filter("false"), ["doc_id"]).filter("contaminated OR n_hit > 0").count() == 0
    assert D.find_hits(empty_docs(spark), bench, ["doc_id"]).count() == 0


def test_query_on_a_fixture(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(i, n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), c) for i, n, h, f, c in brute(docs, items)]
    got = sorted([tuple(r) for r in D.op9_decontamination(spark, sf).collect()], key=str)
    assert got == sorted(want, key=str) and any(r[5] for r in got)
