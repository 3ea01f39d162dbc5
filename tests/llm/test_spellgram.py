"""Operator 13 against a brute-force count and edits of all pairs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from edge_docs import DOCS, SF, edge_docs, edge_rows, empty_docs

from prodlink.llm import spellgram as S

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def words_of(rows):
    """word -> n by the contract, from (doc_id, text) rows."""
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def gaps(word):
    """The word with each letter left out, and with each letter blanked: near words share one."""
    return [word[:i] + "-" + word[i + 1:] for i in range(len(word))], [word[:i] + word[i + 1:] for i in range(len(word))]


def brute(rows):
    n = words_of(rows)
    near, blanked = defaultdict(set), defaultdict(list)
    for w in n:
        blanks, shorter = gaps(w)
        for b in blanks:
            blanked[b].append(w)
        for s in shorter:
            if s in n:
                near[w].add(s)
                near[s].add(w)
    for group in blanked.values():
        for w in group:
            near[w] |= set(group) - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def variants(seed=2):
    """Texts of words with typing errors at several depths, so that forms lead on over several steps."""
    rng = random.Random(seed)
    letters = "abcdeéÀß×zy"

    def edit(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])

    out = []
    for base in ["abcdeab", "aabbccdd", "zyzyzyzyzy", "éàéàéàé", "deedeedee", "abcabcabc", "aaaaaa"]:
        words, times = [base], 700
        while times >= 5:
            out += [w for w in words for _ in range(times)]
            words, times = [edit(w) for w in words for _ in range(3)][:12], times // rng.choice([2, 5, 6])
    rng.shuffle(out)
    return [(i, " ".join(out[k:k + 50]) + rng.choice(["", "!\n", " 12"]), "en", "s", 1) for i, k in enumerate(range(0, len(out), 50))]


@pytest.mark.parametrize("groups, cell", [(S.GROUPS, S.CELL), (1, 7), (3, 20)])
def test_groups(spark, groups, cell):
    rows = variants()
    got = rows_of(S.spelling_groups(spark.createDataFrame(rows, DOCS), groups, cell))
    assert got == brute([r[:2] for r in rows])
    steps = {w: f for w, f, *_ in got}
    assert any(f and steps[f] for f in steps.values()), "no way of two steps in the fixture"


def test_long_words(spark):
    rows = [(i, f"{'x' * 5000} {'x' * 4999} {'x' * 2500}y{'x' * 2499}" + (f" {'x' * 5000}" * 40 if i == 3 else ""), "en", "s", 1)
            for i in range(6)]
    assert rows_of(S.spelling_groups(spark.createDataFrame(rows, DOCS))) == brute([r[:2] for r in rows])


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "COUNTED", 3)
    assert rows_of(S.spelling_groups(edge_docs(spark))) == brute([r[:2] for r in edge_rows()])


def test_empty(spark):
    assert rows_of(S.spelling_groups(empty_docs(spark))) == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(S.op13_spelling_variants(spark, SF)) == brute(rows)
