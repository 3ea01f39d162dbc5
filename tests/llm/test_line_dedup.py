"""Line dedup against brute force over all pairs of lines."""

import pytest
from edge_docs import DOCS, edge_docs, edge_rows, empty_docs

from prodlink.llm import linejoin as L


def brute(rows):
    """{(id, place)} to remove; ids must be unique and not null."""
    lines = [(i, p, line.lower()) for i, text, *_ in rows if text is not None for p, line in enumerate(text.split("\n"))]
    sets = sorted((i, p, line, frozenset(line.split())) for i, p, line in lines)
    sets = [x for x in sets if x[3]]
    gone = set()
    for k, (i, p, line, s) in enumerate(sets):
        if any(line == other or (min(len(s), len(t)) >= L.LEAST_WORDS and 9 * len(s & t) >= 4 * (len(s) + len(t)))
               for _, _, other, t in sets[:k]):
            gone.add((i, p))
    return gone


def line_rows(seed=0):
    import random
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 40))] for _ in range(30)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                line[rng.randrange(len(line))] = rng.choice(words)
            text.append(rng.choice([" ", " ", " ", "\t", "\u3000"]).join(line))
        rows.append((i, "\n".join(text), None, None, None))
    return rows


@pytest.mark.parametrize("keys,rows", [(3, line_rows()), (1, line_rows(1)), (3, [r for r in edge_rows() if r[0] not in (None, 9)])])
def test_against_all_pairs(spark, monkeypatch, keys, rows):
    monkeypatch.setattr(L, "FAMILY_KEYS", keys)
    docs = spark.createDataFrame(rows, DOCS)
    got = {(r.id.doc, r.place) for r in L.repeated_lines(docs).collect()}
    assert got == brute(rows)
    left = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    for i, text, *_ in rows:
        want = None if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if (i, p) not in got)
        assert left[i] == want


def test_edge_rows_and_extra_columns(spark):
    docs = edge_docs(spark)
    out = L.dedup_lines(docs)
    assert set(docs.columns) < set(out.columns) and out.count() == len(edge_rows())
    assert L.dedup_lines(empty_docs(spark)).count() == 0
    # The row without an id ranks first, so the row with its text loses the line.
    nulls = [r for r in edge_rows() if r[0] is None]
    kept = {r.text for r in out.filter("doc_id IS NULL").collect()}
    assert kept == {r[1] for r in nulls}


def test_short_and_unspaced_lines(spark):
    """Equal lines go whatever their words; near ones need words enough."""
    texts = ["Hi all\n日本語の同じ文章です\n \n", "hi ALL\nx", "日本語の同じ文章です\n\n \nown", "a\tb\tc", "a b c", "A\tB\tC\nHi  all", "x\nx"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    left = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    assert left == {0: texts[0], 1: "x", 2: "\n \nown", 3: "a\tb\tc", 4: "a b c", 5: "Hi  all", 6: ""}


def test_rows_of_one_id_keep_their_own_lines(spark):
    line = "a line that three documents hold word for word"
    rows = [(1, line), (2, f"{line}\nfirst own line nobody else has here"), (2, f"second own line nobody else has here\n{line}"),
            (2, f"second own line nobody else has here\n{line}"), (None, f"{line}\nthird"), (None, "fourth")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    left = sorted(((r.doc_id or 0), r.text) for r in L.dedup_lines(docs).collect())
    # Rows without an id come first, so one of them leads.
    assert left == [(0, f"{line}\nthird"), (0, "fourth"), (1, ""), (2, "first own line nobody else has here"),
                    (2, "second own line nobody else has here"), (2, "second own line nobody else has here")]


def test_stage_drops_documents_without_own_content(spark):
    long_line = "one two three four five six seven"
    docs = spark.createDataFrame([(1, long_line, "en", "s", 9), (2, f"Hi.\n{long_line}", "en", "s", 9), (3, "Hi.", "en", "s", 3),
                                  (4, f"{long_line}\nan own line of more than five words", "en", "s", 9)], DOCS)
    rows = {r.doc_id: (r.text, r.n_chars) for r in L.line_dedup_stage(spark, docs, "").collect()}
    own = "an own line of more than five words"
    assert rows == {1: (long_line, 9), 2: ("Hi.", 3), 4: (own, len(own))}


def test_stage_keeps_short_lines_found_nowhere_else(spark):
    long_line = "one two three four five six seven"
    texts = [long_line, f"{long_line}\nroses\nare red", f"日本語の文章です\n{long_line}", f"{long_line}\na\tb\tc", f"{long_line}\n \t\u3000",
             f"Hi.\n{long_line}", "Hi.", f"{long_line}\nyes\nno", "yes", "no", "", " \n"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    rows = {r.doc_id: r.text for r in L.line_dedup_stage(spark, docs, "").collect()}
    assert rows == {0: long_line, 1: "roses\nare red", 2: "日本語の文章です", 3: "a\tb\tc", 5: "Hi.", 7: "yes\nno", 10: "", 11: " \n"}


@pytest.mark.parametrize("lines,length,vocabulary", [(1000, 79, 400), (200, 150, 700)])
def test_unlike_lines_hardly_meet(spark, lines, length, vocabulary):
    """Long lines under common words: chance must let no share of all pairs through the parities."""
    import random
    rng = random.Random(3)
    words = [f"v{i}" for i in range(vocabulary)]
    rows = [(i, " ".join(rng.sample(words, length)), None, None, None) for i in range(lines)]
    docs = L._with_ids(spark.createDataFrame(rows, DOCS))
    classes = L._classes(docs)
    nothing = classes.select("id", "place").limit(0)
    assert L._prefix_pairs(classes, nothing).count() <= 1


def test_words_of_prefixes_are_shuffled_once(spark):
    rows = line_rows(2)
    classes = L._classes(L._with_ids(spark.createDataFrame(rows, DOCS))).filter("n IS NOT NULL")
    settled = L.stored(classes.select("id", "place").orderBy("same").limit(5), "settled")
    pairs = L._prefix_pairs(classes, settled)
    got = pairs.collect()
    done = {tuple(r) for r in settled.collect()}
    # A settled line looks for no partner, but is one.
    assert not done & {(r.id, r.place) for r in got} and done & {(r.id2, r.place2) for r in got}
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning(word" in x]
    assert len([x for x in shuffles if "ReusedExchange" not in x]) == 1 and len(shuffles) == 2


def test_few_lines_of_a_family_meet_all_others(spark):
    """Edited copies of one line: most are near to the earliest of some part, and only lines in pairs are fetched again."""
    import random
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(600):
        line = list(base)
        for at in rng.sample(range(60), rng.randint(1, 5)):
            line[at] = f"o{rng.randrange(10_000)}"
        rows.append((i, " ".join(line), None, None, None))
    docs = L._with_ids(spark.createDataFrame(rows, DOCS))
    classes = L._classes(docs)
    pairs = L.stored(L._family_pairs(classes), "pairs")
    assert pairs.count() <= 600 * L.FAMILY_KEYS * L.FAMILY_PARTS
    settled = L._similar(docs, classes, pairs)
    # 25,884 pairs with the earliest line of each whole family alone.
    assert L._prefix_pairs(classes, settled).count() < 5_000


def test_only_lines_in_pairs_are_fetched(spark, monkeypatch):
    rows = line_rows(3) + [(1000 + i, f"lone{i} a{i} b{i} c{i} d{i} e{i}", None, None, None) for i in range(300)]
    sizes, stored = {}, L.stored

    def counted(df, name):
        out = stored(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(L, "stored", counted)
    gone = {(r.id.doc, r.place) for r in L.repeated_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert gone == brute(rows)
    for ends, fetched in zip(sizes["line-ends"][::2], sizes["line-prefixes"]):
        assert fetched == ends <= sizes["classes"][0] - 300


def at_the_bound(seed, words):
    """Lines of 5 to 60 words, each with edited copies of just the similarity that counts or just less."""
    import random
    rng = random.Random(seed)
    rows = []
    for n in range(5, 60, 3):
        base = rng.sample(words, n)
        rows.append(" ".join(base))
        for less in (0, 1):
            for m in {n, -(-4 * n // 5), 5 * n // 4}:
                common = min(-(-4 * (n + m) // 9), n, m) - less
                line = rng.sample(base, common) + rng.sample([w for w in words if w not in base], m - common)
                rng.shuffle(line)
                rows.append(" ".join(line))
    rng.shuffle(rows)
    return [(i, text, None, None, None) for i, text in enumerate(rows)]


@pytest.mark.parametrize("seed,words", [(1, [f"w{i:04}" for i in range(2000)]), (2, ["x" * (i % 150) + f"{i:x}" for i in range(2000)])])
def test_lines_at_the_bound(spark, seed, words):
    rows = at_the_bound(seed, words)
    gone = {(r.id.doc, r.place) for r in L.repeated_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert gone == brute(rows) and len(gone) > len(rows) // 4


def test_white_space_of_all_kinds(spark):
    words = "these six words are one line"
    texts = [words, "caf\u00e9 \u2014 unlike all others here, with no odd space"] + [words.replace(" ", c) for c in L._SPACES] + list(L._SPACES)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    assert [r.odd for r in docs.orderBy("doc_id").select(L._odd(L.F.col("text")).alias("odd")).collect()] == [i > 1 for i in range(len(texts))]
    left = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    blank = len(texts) - len(L._SPACES)
    assert left == {i: t if i < 2 or i >= blank else "" for i, t in enumerate(texts)}


def test_lines_with_words_in_common_hardly_meet(spark):
    """Every word stands in many lines, so pairs of lines that meet under a word of their prefixes grow with the square of the table
    (40,000 and more here); hardly any have neighbours in common."""
    import random
    rng = random.Random(7)
    words = [f"{rng.randrange(1 << 40):x}"[:rng.randint(3, 10)] for _ in range(2000)]
    rows = [(i, " ".join(rng.sample(words, 40)), None, None, None) for i in range(1500)]
    spread = spark.createDataFrame(rows, DOCS)
    met = L._neighbours(L._classes(L._with_ids(spread)), "line").groupBy("word").count().selectExpr("sum(count * (count - 1) / 2)").first()[0]
    assert (met or 0) < 4_000


def test_texts_are_split_once(spark):
    """Not once more for each line that stays."""
    plan = L.dedup_lines(spark.createDataFrame(line_rows(4), DOCS))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
