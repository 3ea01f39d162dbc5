"""Anchor equi-join linking equals a brute-force scan over every (post, keyword) pair."""

import random
import re

import pytest
from pyspark.sql import functions as F

from prodlink.operators import link as L

VOCAB = ["sky", "walker", "sky-walker", "torvin", "maleko", "(tori)", "marlow", "beyond", "ver", "v2",
         "figure", "series", "zentrix", "gallant", "oshiro", "kiran", "rook", "falcon", "x-ray",
         "kit", "(kit)", "ver.1.5", "gear", "ring", "café", "ninja", "gaiden"]
TEXT_EXTRA = ["kirans", "kiran's", "skywalker", "marlows", "the", "a", "!!", "--", "tori)", "(kit", "rings",
              "ninja-gaiden", "café's", "falcons", "x-rays"]


def _names(rng, n):
    out = []
    for i in range(n):
        k = rng.randint(1, 4)
        out.append(" ".join(rng.choice(VOCAB) for _ in range(k)))
    return out


def _texts(rng, n):
    pool = VOCAB + TEXT_EXTRA
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def _brute(texts, kws):
    """Pure-Python reference: ASCII word boundaries, text and hyphen-free text."""
    best = {}
    for pid, txt in texts:
        t = txt.lower()
        nh = t.replace("-", "")
        top = None
        for (cat_ord, kw_ord, kw, prio, typ, name) in kws:
            if len(kw) < 4:
                continue
            rx = re.compile(r"\b" + re.escape(kw) + r"(?:'?s)?\b", re.ASCII)
            if rx.search(t) or rx.search(nh):
                score = {1: 1000, 2: 500, 3: 300, 4: 100}[prio] + len(kw) + (50 if typ == "phrase" else 0)
                key = (score, -cat_ord, -kw_ord)
                if top is None or key > top[0]:
                    top = (key, name, kw)
        best[pid] = (top[1], top[2]) if top else ("", "")
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_anchor_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    names = _names(rng, 25)
    series = _names(rng, 25)
    cat = spark.createDataFrame([(i, names[i], f"B{i % 3}", "L", series[i] if i % 3 else "")
                                 for i in range(25)], "cat_ord long, name string, brand string, "
                                                      "product_line string, series_title string")
    texts = list(enumerate(_texts(rng, 60)))
    posts = spark.createDataFrame([(i, "", t, "a", "d", "/p") for i, t in texts],
                                  "post_id long, title string, selftext string, author string, "
                                  "created_date string, permalink string")
    got = {r.post_id: (r.figure_name, r.matched_keyword)
           for r in L.match_posts(posts, cat).collect()}
    kws = [(r.cat_ord, r.kw_ord, r.keyword, r.priority, r.match_type, r.name)
           for r in L.keyword_table(cat).collect()]
    # search text is title + ' ' + body; title is empty here
    want = _brute([(i, " " + t) for i, t in texts], kws)
    assert got == want


def test_non_word_keywords_are_matched(spark):
    cat = spark.createDataFrame([(1, "!!!!", "B", "L", "")],
                                "cat_ord long, name string, brand string, product_line string, series_title string")
    posts = spark.createDataFrame([(1, "", "a!!!!b", "u", "d", "/p"), (2, "", "!!!! b", "u", "d", "/p")],
                                  "post_id long, title string, selftext string, author string, "
                                  "created_date string, permalink string")
    got = {r.post_id: r.matched_keyword for r in L.match_posts(posts, cat).collect()}
    assert got == {1: "!!!!", 2: ""}


def test_tie_break_is_deterministic_under_repartition(spark):
    cat = spark.createDataFrame([(i, "twin figure name", f"B{i}", "L", "") for i in range(5)],
                                "cat_ord long, name string, brand string, product_line string, series_title string")
    posts = spark.createDataFrame([(i, "", "i love my twin figure name", "u", "d", "/p") for i in range(20)],
                                  "post_id long, title string, selftext string, author string, "
                                  "created_date string, permalink string")
    a = {r.post_id: r.brand for r in L.match_posts(posts, cat).collect()}
    b = {r.post_id: r.brand for r in L.match_posts(posts.repartition(7), cat.repartition(3)).collect()}
    assert a == b and set(a.values()) == {"B0"}


def test_detect_labels_default_dictionary(spark):
    df = spark.createDataFrame([("my figure has loose joints and a paint chip",), ("box damage!",), ("fine",)], "t string")
    got = [r.l for r in df.select(F.array_join(L.detect_labels(F.col("t")), ", ").alias("l")).collect()]
    assert got == ["loose_joints, paint_defect", "packaging_damage", ""]


def test_required_literals_are_conservative():
    assert L.required_literals(r"\b(loose|floppy)\s*x") == ["loose", "floppy"]
    assert L.required_literals(r"\bab?c") == ["a"]
    assert L.required_literals(r"(?:ab|cd)") is None
    assert L.required_literals(r"[a-z]+@x") is None
    assert L.required_literals(r"\b(ab)?cd") is None          # optional group
    assert L.required_literals(r"abc|xyz") is None             # top-level alternation
    assert L.required_literals(r"\b(ab)|cd") is None
    assert L.required_literals(r"\b(a\)b|cd)x") == ["a", "cd"]


def test_label_regex_boundary_rewrite_is_safe(spark):
    # the look-behind rewrite only applies when every alternative starts with a word char
    assert L.label_regex(r"\b(ab|cd)\b").startswith("(?<![A-Za-z0-9_])")
    assert not L.label_regex(r"\b(ab|-x)").startswith("(?<!")
    assert not L.label_regex(r"\b(ab)?-x").startswith("(?<!")
    pats = {"mixed": r"\b(ab|-x)", "optional": r"\b(zz)?-y", "alt": r"foo|\bbar"}
    df = spark.createDataFrame([("q-x",), ("q-y",), ("a bar",), ("ab",), ("-x",)], "t string")
    got = [r.l for r in df.select(F.array_join(L.detect_labels(F.col("t"), pats), ",").alias("l")).collect()]
    assert got == ["mixed", "optional", "alt", "mixed", ""]


@pytest.mark.parametrize("seed", [4])
def test_shuffle_path_equals_broadcast_path(spark, seed):
    rng = random.Random(seed)
    names = _names(rng, 20)
    cat = spark.createDataFrame([(i, names[i], f"B{i % 3}", "L", names[(i + 7) % 20] if i % 2 else "")
                                 for i in range(20)], "cat_ord long, name string, brand string, "
                                                      "product_line string, series_title string")
    posts = spark.createDataFrame([(i, "", t, "a", "d", "/p") for i, t in enumerate(_texts(rng, 50))],
                                  "post_id long, title string, selftext string, author string, "
                                  "created_date string, permalink string")
    bc = sorted(map(tuple, L.match_posts(posts, cat).collect()))
    sh = sorted(map(tuple, L.match_posts(posts, cat, broadcast_rows=0).collect()))
    assert bc == sh
    assert any(r[1] for r in bc)


CATALOG = "cat_ord long, name string, brand string, product_line string, series_title string"
POSTS = "post_id long, title string, selftext string, author string, created_date string, permalink string"


def _post_rows(spark, texts):
    return spark.createDataFrame([(i, "", t, "a", "d", "/p") for i, t in enumerate(texts)], POSTS)


def _link_all(spark, names, series, texts, **kw):
    cat = spark.createDataFrame([(i, n, f"B{i}", "L", s) for i, (n, s) in enumerate(zip(names, series))], CATALOG)
    got = {r.post_id: (r.figure_name, r.matched_keyword) for r in L.match_posts(_post_rows(spark, texts), cat, **kw).collect()}
    kws = [(r.cat_ord, r.kw_ord, r.keyword, r.priority, r.match_type, r.name) for r in L.keyword_table(cat).collect()]
    return got, _brute([(i, " " + t) for i, t in enumerate(texts)], kws)


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
@pytest.mark.parametrize("seed", [11, 12])
def test_odd_gaps_equal_brute_force(spark, seed, broadcast_rows):
    """Names and texts of few words with every kind of gap, apostrophe, hyphen and letter beyond ASCII at any place."""
    rng = random.Random(seed)
    glue = [" ", " ", "-", "--", "'", "' ", "!!", "!!!!", ".", "é", " é ", "日本", "'s ", "s", "'s", "  "]
    words = ["aaaa", "bbbbbb", "s", "cc", "aaaas", "bbbbbbs", "x_1"]

    def phrase(n):
        return "".join(rng.choice(["", "", *glue]) + rng.choice(words) for _ in range(n)) + rng.choice(["", "", *glue])

    names = [phrase(rng.randint(1, 4)) for _ in range(30)] + ["!!!!", "-----", "é!!é'"]
    texts = [phrase(rng.randint(0, 9)) for _ in range(90)]
    texts += [rng.choice(["", "x", " "]) + rng.choice(names) + rng.choice(["", "s", "'s", "' s", "x", " x", "'", "'sx"]) for _ in range(60)]
    got, want = _link_all(spark, names, [""] * len(names), texts, broadcast_rows=broadcast_rows)
    assert got == want and sum(bool(v[1]) for v in want.values()) > 50


def _hot_fixture(spark):
    """Every name holds a word that is long and in every post, and one that is short and in few."""
    names = [f"collectables zq{i}" for i in range(40)]
    cat = spark.createDataFrame([(i, n, "B", "L", "") for i, n in enumerate(names)], CATALOG)
    texts = [f"collectables on the shelf, collectables zq{i % 400} too" for i in range(400)]
    return cat, _post_rows(spark, texts).select("post_id", L.search_text(F.col("title"), F.col("selftext")).alias("txt"))


def _candidates(posts, anchors):
    places = L.post_places(posts, "post_id", (), False, outer=False)
    return places.join(anchors, F.col("term") == F.col("anchor")).count()


def test_rare_anchor_spares_candidates(spark):
    """Of the join rows before verification at most a fifth is left, and the result is the same."""
    cat, posts = _hot_fixture(spark)
    best = L.best_per_keyword(L.keyword_table(cat)).where("keyword LIKE '% zq%'")
    longest = L.token_frequencies(posts, L.anchor_terms(best), True).withColumn("n", F.lit(1).cast("long"))
    rare = L.keyword_anchors(best, L.token_frequencies(posts, L.anchor_terms(best), True))
    hot = L.keyword_anchors(best, longest)  # ties go to the longest run, as before
    assert {r.anchor for r in hot.collect()} == {"collectables"}
    assert all(r.anchor.startswith("zq") for r in rare.collect())
    assert 5 * _candidates(posts, rare) <= _candidates(posts, hot)
    pairs = [sorted(map(tuple, L.match_candidates(posts, a, "post_id", False, ok).select("post_id", "keyword").distinct().collect()))
             for a in (rare, hot) for ok in (True, False)]
    assert pairs[0] and all(p == pairs[0] for p in pairs)


def test_token_frequencies(spark):
    posts = spark.createDataFrame([(1, "a-b ab ab zz"), (2, "ab"), (3, "b"), (4, "")], "post_id long, txt string")
    terms = spark.createDataFrame([("ab",), ("b",), ("none",)], "term string")
    for ok in (True, False):
        assert {r.term: r.n for r in L.token_frequencies(posts, terms, ok).collect()} == {"ab": 6, "b": 2}


def test_position_join_moves_no_text(spark):
    """Beyond the limits no exchange carries a string of the post's text and nothing is broadcast."""
    cat, posts = _hot_fixture(spark)
    a = L.prepare_anchors(cat, posts, broadcast_rows=0)
    assert not a.broadcast
    plan = L.match_candidates(posts, a.anchors, "post_id", a.with_runs, False)._jdf.queryExecution().executedPlan()

    def nodes(p):
        yield p
        for i in range(p.children().size()):
            yield from nodes(p.children().apply(i))

    todo = [plan.initialPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan]
    found = [n for p in todo for n in nodes(p)]
    assert not [n for n in found if "Broadcast" in n.nodeName()]
    exchanges = [n for n in found if n.nodeName() == "Exchange"]
    assert len(exchanges) >= 4
    for n in exchanges:
        names = {n.output().apply(i).name() for i in range(n.output().size())}
        assert names.isdisjoint({"txt", "t", "words", "gaps", "term"})


def test_position_join_shuffles_only_runs_of_keywords(spark):
    """A word of every keyword does not bring every place to every keyword, and keywords of any length are settled in one row."""
    long_name = "saga of the " + " ".join(f"part{i}" for i in range(12)) + " (gold)"
    names = [f"saga hero{i}" for i in range(40)] + [long_name, "saga of"]
    cat = spark.createDataFrame([(i, n, "B", "L", "") for i, n in enumerate(names)], CATALOG)
    texts = ["saga saga saga " * 30, "the saga hero7's end", "saga hero3s, saga-hero4", long_name + "s", long_name[:-1], long_name.replace("part9", "x"), "", "!"]
    posts = spark.createDataFrame(list(enumerate(texts)), "post_id long, txt string")
    a = L.prepare_anchors(cat, posts, broadcast_rows=0)
    asked = L.asked_windows(a.anchors)
    assert asked.where("m > 8 and start is null").count() == 0 and asked.where("m > 8").count() > 0
    runs = L.hashed_windows(posts, "post_id", a.with_runs, asked)
    pairs = [sorted(map(tuple, L.match_candidates(posts, a.anchors, "post_id", a.with_runs, ok).select("post_id", "keyword").distinct().collect()))
             for ok in (True, False)]
    assert pairs[0] == pairs[1] and any(len(k.split()) > 8 for _, k in pairs[0])
    words_of_keywords = sum(len(t.split()) for t in texts)
    assert runs.count() < words_of_keywords + 20, "a place is shuffled once for each run that a keyword has, not for each keyword"
    assert runs.where("post_id = 0").count() <= asked.where("m = 1").count() * 90


def test_keyword_pattern_agrees_with_places(spark):
    """The boundary pattern on the text and the check of places name the same pairs."""
    names = ["sky-walker (tori)", "kit 'n gear", "ver.1.5", "rook falcon"]
    cat = spark.createDataFrame([(i, n, "B", "L", "") for i, n in enumerate(names)], CATALOG)
    texts = ["skywalker", "my sky-walker (tori)s", "sky-walker (tori)", "kit 'n gears!", "ver.1.5's", "rook falcons", "rook  falcon"]
    posts = spark.createDataFrame(list(enumerate(texts)), "post_id long, txt string")
    a = L.prepare_anchors(cat, posts)
    placed = {tuple(r) for r in L.match_candidates(posts, a.anchors, "post_id", a.with_runs, True).select("post_id", "keyword").collect()}
    pattern = L.keyword_pattern(F.col("keyword"))
    pairs = posts.crossJoin(a.best_per_keyword.select("keyword")).where(
        F.rlike("txt", pattern) | F.rlike(L.dehyphen(F.col("txt")), pattern))
    assert placed == {tuple(r) for r in pairs.select("post_id", "keyword").collect()} and placed


def test_label_guard_by_a_literal_inside():
    assert L.required_inner_literal(r"\b[a-z0-9._]+@[a-z0-9.]+\.[a-z]+\b") == "@"
    assert L.required_inner_literal(r"\d+ab?c{0,2}xyz*(q|r)") == "xy"
    assert L.required_inner_literal(r"[ab(\]c]+d\+e(f[)]g)?") == "d+e"
    for none in (r"a@|b", r"(?i)[a]@", r"\x40@", r"\w+", r"(a@)?", r"[@]", r"@?"):
        assert L.required_inner_literal(none) is None, none


def test_labels_scan_for_an_address_only_where_one_can_be(spark):
    email = {"email": r"\b[a-z0-9._]+@[a-z0-9.]+\.[a-z]+\b"}
    df = spark.createDataFrame([("write to a.b@c.org now",), ("a@b",), ("none.here",), ("",), (None,)], "t string")
    plan = df.select(L.detect_labels(F.col("t"), email).alias("l"))
    assert [r.l for r in plan.collect()] == [["email"], [], [], [], []]
    assert "Contains(t" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_one_pass_checks_a_place_once(spark):
    catalog = spark.createDataFrame([(1, "wonderful heroine", "b", "l", "")],
                                    "cat_ord long, name string, brand string, product_line string, series_title string")
    posts = spark.createDataFrame([(1, "the wonderful heroine-wonderful heroines"), (2, ""), (3, "a post"), (4, "!")],
                                  "post_id long, txt string")
    linked = L._one_pass(posts, L.prepare_anchors(catalog), "post_id", [])
    assert {r.post_id: r.best and r.best.figure_name for r in linked.collect()} == {1: "wonderful heroine", 2: None, 3: None, 4: None}
    plan = linked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("slice(words") == 1, "a check repeated in the columns runs again for each hit"
