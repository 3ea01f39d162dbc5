"""Token-id files: exact round trips, random access, and the cache of counts."""

import random
import zlib

import numpy as np
from edge_docs import edge_docs, edge_rows, empty_docs
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from prodlink.llm import digestcache as C
from prodlink.llm import regrammar as R
from prodlink.llm import tokenids as T
from prodlink.llm.common import shared_path


def test_grammar_round_trip():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(0, np.uint32), np.zeros(1000, np.uint32), np.array([7] * 7 + [8, 7] * 50),
                rng.integers(0, 3, 5000), np.tile(rng.integers(0, 50_000, 300), 40), rng.zipf(1.3, 20_000) % 50_000):
        base, rules, expansion, symbols = R.compress(np.asarray(ids, np.uint32))
        assert R.expand(symbols, base, rules).tolist() == list(ids)
        for k, (a, b) in enumerate(rules.tolist()):
            parts = [1 if x < base else int(expansion[x - base]) for x in (a, b)]
            assert expansion[k] == sum(parts)
    assert len(symbols) < len(ids)


def test_whole_shards_are_copied_rule_by_rule():
    rng = np.random.default_rng(5)
    phrases = [rng.integers(0, 400, 7) for _ in range(20)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 20, 900)]).astype(np.uint32)
    # No ids, ids without rules, runs of one id, and ids too wide for two of them and a place in 64 bits.
    for case in (ids, ids[:0], np.arange(50, dtype=np.uint32), np.zeros(99, np.uint32), np.concatenate([ids, ids + (1 << 26)]).astype(np.uint32)):
        base, rules, expansion, symbols = R.compress(case)
        assert np.array_equal(R.expand_whole(symbols, base, rules, expansion), case)
        assert np.array_equal(R.expand(symbols, base, rules), case)
        assert len(rules) == 0 or len(symbols) < len(case)


def test_files_and_random_access(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_IDS", 3000)
    library = Tokenizer.from_file(T.tokenizer_path(T.WORD_BPE))
    path = shared_path(spark, "test-ids")
    R.write_ids(edge_docs(spark), path)
    shards = sorted((r.asDict() for r in R.read_files(spark, path).collect()), key=lambda r: (r["part"], r["shard"]))
    want = sorted(((i, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
                   for i, t, *_ in edge_rows()), key=lambda x: (x[0] is not None, x[0] or 0))
    # The shards joined in order are the documents in order (rows without an id in any order among themselves).
    flat = np.concatenate([R.expand(R.unpack(s)[3], s["base"], R.unpack(s)[1]) for s in shards])
    nulls = sum(len(x) for i, x in want if i is None)
    assert flat[nulls:].tolist() == np.concatenate([x for i, x in want if i is not None]).tolist()
    assert [i for s in shards for i in s["doc_id"]][2:] == [i for i, _ in want][2:]
    rng = random.Random(0)
    for s in shards:
        ids = R.expand(R.unpack(s)[3], s["base"], R.unpack(s)[1])
        for _ in range(20):
            a = rng.randrange(len(ids))
            n = rng.randint(0, len(ids) - a)
            assert R.decode_range(s, a, n).tolist() == ids[a:a + n].tolist()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(T.tokenizer_path(T.WORD_BPE))
    at, want = 0, []
    for i, text in sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, R.op7_token_ids(spark, sf).collect())) == want


def test_empty(spark):
    path = shared_path(spark, "test-ids")
    R.write_ids(empty_docs(spark), path)
    files = R.read_files(spark, path)
    assert R.read_documents(files).join(R.shard_starts(files), ["part", "shard"]).count() == 0
    assert C.count_tokens(empty_docs(spark), shared_path(spark, "test-cache")).count() == 0


def test_counts_come_from_the_cache(spark):
    library = SentencePieceProcessor(model_file=T.tokenizer_path(T.PIECE_BPE))
    path, docs = shared_path(spark, "test-cache"), edge_docs(spark)
    want = sorted([(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, *_ in edge_rows()], key=str)
    assert sorted(map(tuple, C.count_tokens(docs, path).collect()), key=str) == want
    stored = spark.read.parquet(path)
    distinct = len({t or "" for _, t, *_ in edge_rows()})
    assert stored.count() == distinct
    # A second run encodes nothing; new texts are appended; a stored count is used as it is.
    assert sorted(map(tuple, C.count_tokens(docs, path).collect()), key=str) == want
    assert spark.read.parquet(path).count() == distinct
    more = spark.createDataFrame([(1, "brand new text"), (2, "")], "doc_id long, text string")
    assert C.count_tokens(more, path).count() == 2 and spark.read.parquet(path).count() == distinct + 1
