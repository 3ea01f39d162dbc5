"""Operator 12 against plain Python over whole texts."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from edge_docs import DOCS, SF, edge_docs, edge_rows, empty_docs

from prodlink.llm import divergence as D

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return words, (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed)


def classes(text):
    def kind(c):
        return (0 if c in SPACE else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3 if "0" <= c <= "9"
                else 4 if c in ".,;:!?'\"()-" else 5 if c < "\x80" else 6)
    count = Counter(map(kind, text))
    return [count[k] for k in range(7)]


def distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(x + y) / 2 for x, y in zip(p, q)]

    def part(a):
        return sum(x * math.log2(x / z) for x, z in zip(a, m) if x > 0)

    return math.sqrt(max(part(p) + part(q), 0) / 2)


def brute(rows):
    """rows of (doc_id, text, lang)."""
    texts = [(i, t or "", lang, *plain(t or "")) for i, t, lang in rows]
    counts, kinds = defaultdict(Counter), defaultdict(lambda: [0] * 7)
    for _, t, lang, words, base in texts:
        if not base[-1] and lang is not None:
            counts[lang].update(map(lower, words))
            kinds[lang] = [a + b for a, b in zip(kinds[lang], classes(t))]
    every = sum(sum(c.values()) for c in counts.values())
    refs = {}
    for lang, c in counts.items():
        total = sum(c.values())
        if total >= every / 1000:
            common = sorted((w for w in c if c[w] >= total / 2000), key=lambda w: (-c[w], w))[:D.COMMON]
            refs[lang] = common, [c[w] for w in common] + [total - sum(c[w] for w in common)], kinds[lang]
    out = []
    for i, t, lang, words, base in texts:
        kept = not base[-1]
        if kept and refs and (lang is None or lang in refs):
            own = Counter(map(lower, words))
            char = min(distance(classes(t), r[2]) for r in refs.values())
            word = min(distance([own[w] for w in r[0]] + [len(words) - sum(own[w] for w in r[0])], r[1]) for r in refs.values())
            kept = (char <= D.CHAR_BOUND + D.CHAR_SLACK / math.sqrt(len(t))
                    and word <= D.WORD_BOUND + D.WORD_SLACK / math.sqrt(len(words)))
        out.append((i, *base, kept))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def mixed():
    """Rows of the given table, edge rows and texts that the rules are about."""
    word = ["the", "of", "and", "house", "river", "walks", "green", "over", "under", "quickly", "seven", "stones"]
    rng = random.Random(5)
    sound = [" ".join(rng.choice(word) + rng.choice(["", "", "", "s", ",", "ly."]) for _ in range(60 + 9 * i)) for i in range(30)]
    odd = [sound[3].upper() + "!!!", " | ".join(sound[5].split()), "é" * 400, "a b c " * 40, "x\ny\n\nx\n \n \ny" + sound[7],
           "\x1c".join(sound[2].split()), "1 2 " + " ".join(map(str, range(90))), "\xa0".join(sound[4].split()) + " tail" * 60]
    return ([(1000 + i, t, "en", "s", 1) for i, t in enumerate(sound)] + [(2000 + i, t, "en", "s", 1) for i, t in enumerate(odd)]
            + [(3001, odd[1], None, "s", 1), (3002, sound[0], None, "s", 1)])


@pytest.mark.parametrize("counted", [300_000, 20])
def test_rules(spark, monkeypatch, counted):
    monkeypatch.setattr(D, "COUNTED", counted)
    rows = mixed()
    got = rows_of(D.quality_measures(spark.createDataFrame(rows, DOCS)))
    assert got == brute([(r[0], r[1], r[2]) for r in rows])
    verdict = {r[0]: r[-1] for r in got}
    assert not verdict[2000] and not verdict[2001] and not verdict[2003]
    assert all(verdict[1000 + i] for i in range(5, 30))


def test_edge_rows(spark):
    assert rows_of(D.quality_measures(edge_docs(spark))) == brute([(r[0], r[1], r[2]) for r in edge_rows()])


def test_language_without_reference(spark):
    """A language under the least share has no reference: its documents are kept, not judged."""
    rng = random.Random(6)
    big = [(i, " ".join(f"w{rng.randrange(200)}" for _ in range(3000)), "en", "s", 1) for i in range(40)]
    small = [(100, " ".join(f"Ж{k}" for k in range(60)), "ru", "s", 1)]
    got = D.quality_measures(spark.createDataFrame(big + small, DOCS))
    row = got.filter("doc_id = 100").first()
    assert row.kept and row.word_distance is None
    assert rows_of(got) == brute([(r[0], r[1], r[2]) for r in big + small])


def test_empty(spark):
    assert D.quality_measures(empty_docs(spark)).collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = D.op12_quality_rules(spark, SF)
    assert out.columns == COLUMNS
    assert rows_of(out) == brute(rows)


def test_clean_documents_stay(spark):
    """Labelled good documents of enough words are kept, bad ones go."""
    sf = "/root/testdata/sf0.01"
    rows = D.op12_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("n_words >= 50")
    kept = dict(map(tuple, rows.selectExpr("quality", "CAST(kept AS INT) AS k").groupBy("quality").avg("k").collect()))
    assert kept[1] > 0.97 and kept[0] < 0.1
