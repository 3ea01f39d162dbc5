"""Kneser-Ney models: probabilities sum to one, languages are told apart, odd rows get a defined result."""

import zlib

import numpy as np
from edge_docs import edge_docs, edge_rows, empty_docs

from prodlink.llm.langid import windows
from prodlink.llm import langid as I
from prodlink.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = I.op5_language(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.97


def test_probabilities_sum_to_one():
    grams, _ = I.windows(["the cat sat on the mat", "a cat and a dog and the end"])
    keys, n = np.unique(grams, return_counts=True)
    model = I.build({"x": (keys, n.astype(float))})
    context = np.uint64(int(keys[0]) >> 16)
    chars = sorted({int(k) & 0xFFFF for k in keys})
    follow = np.array([(int(context) << 16) | c for c in chars], np.uint64)
    total = np.exp(model.log_probability(follow)[:, 0].astype(float)).sum()
    unseen = np.exp(model.log_probability(np.array([(int(context) << 16) | 0x4E00], np.uint64))[0, 0])
    assert abs(total + unseen - 1) < 1e-4


def test_windows_of_documents_do_not_touch():
    alone = [I.windows([t])[0].tolist() for t in ("one two", "", "12", "é", "x\0y")]
    grams, at = I.windows(["one two", "", "12", "é", "x\0y"])
    assert [grams[a:b].tolist() for a, b in zip(at, at[1:])] == alone and alone[1] == alone[2] == []


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = I.identify(docs, I.fit(docs), ["doc_id"]).collect()
    assert len(rows) == len(edge_rows())
    by = {r.doc_id: r for r in rows}
    assert by[1].lang_pred == by[2].lang_pred == by[3].lang_pred == by[8].lang_pred == "und"
    assert all(r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1 for r in rows)
    none = I.fit(empty_docs(spark))
    assert {r.lang_pred for r in I.identify(docs, none, ["doc_id"]).collect()} == {"und"}
    assert I.identify(empty_docs(spark), none, ["doc_id"]).count() == 0


def test_rejection(spark):
    en = "the quick brown fox jumps over the lazy dog and runs away from the house in the morning "
    de = "der schnelle braune fuchs springt über den faulen hund und rennt am morgen aus dem haus weg "
    rows = [(i, (en if i % 2 else de) * 3, "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = I.fit(docs)
    odd = spark.createDataFrame([(1, en), (2, de), (3, "zqxj wvkq jjxz qqwv kzxq")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in I.identify(odd, model, ["doc_id"], reject=True).collect()}
    assert got == {1: "en", 2: "de", 3: "und"}


def large_alphabet(lang, n, rng):
    """Texts over 3,000 common characters that all languages share; which follow which differs by language."""
    weights = 1 / np.arange(1, 3001)
    draws = rng.choice(3000, (n, 60), p=weights / weights.sum())
    for k in range(1, 60):
        draws[:, k] = (draws[:, k] + draws[:, k - 1] * (lang + 2)) % 3000
    return ["".join(chr(0x4E00 + c) for c in row) for row in draws]


def test_no_window_is_cut(spark, monkeypatch):
    """The tables give what all windows give in memory, however few are broadcast."""
    rng = np.random.default_rng(3)
    rows = [(i, t, f"l{k}") for k in range(3) for i, t in enumerate(large_alphabet(k, 60, rng), 1000 * k)]
    rows += [(i, "only here: qqq \U00020000 " + t, "en" if i % 2 else None) for i, (_, t, _) in enumerate(rows[:20], 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {}
    for i, t, lang in rows:
        if lang and zlib.crc32(str(i).encode()) % 5:
            counts.setdefault(lang, []).append(I.windows([t])[0])
    full = I.build({x: np.unique(np.concatenate(g), return_counts=True) for x, g in counts.items()})
    want, _ = full.cross_entropy([t for _, t, _ in rows])
    for entries in (1 << 17, 40):
        monkeypatch.setattr(I, "ENTRIES", entries)
        model = I.fit(docs)
        got = {r.doc_id: r for r in I.identify(docs, model, ["doc_id"]).collect()}
        assert sum(n for _, n in [(x, len(set(np.concatenate(g)))) for x, g in counts.items()]) > 8000
        assert np.allclose(model.reject_above, full.reject_above, atol=1e-4)
        for (i, _, _), h in zip(rows, want):
            assert abs(got[i].cross_entropy - h.min()) < 1e-4 and got[i].lang_pred == full.langs[int(h.argmin())]


def test_large_alphabet(spark):
    rng = np.random.default_rng(4)
    rows = [(i, t, f"l{k}") for k in range(2) for i, t in enumerate(large_alphabet(k, 5000, rng), 10_000 * k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in I.identify(docs, I.fit(docs), ["doc_id"]).collect()}
    out = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(got[i] == lang for i, lang in out) / len(out)
    assert right > 0.97, right


def test_letters_beyond_16_bits():
    """They are letters, differ from all others, and a text of them alone has windows."""
    def of(text):
        return tuple(windows([text])[0].tolist())

    plain = {of(chr(c)) for c in range(0x110000) if c <= 0xFFFF and chr(c).isalpha() and chr(c).lower() == chr(c)}
    far = [chr(c) for c in (0x10020, 0x20020, 0x20061, 0x20062, 0x2F800, 0x1D400, 0x1E900 + 0x22)]
    assert all(of(c) and of(c) not in plain for c in far)
    assert of("\U00020061\U00020062") != of("ab") and len({of(c) for c in far}) == len(far)
    assert of(" ") == of("12") == ()
