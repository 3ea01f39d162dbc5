"""Small tables with every awkward case, in the shape of the given ones."""

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed=0, n=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["été", "Über", "naïve", "日本"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) + rng.choice(["", ".", "\n", "\n\nend"])
            for _ in range(n)]
    near = [b.replace("w1", "w2", 1) for b in base[:10]]
    return base + near + [base[0], base[0].upper(), base[1] + " "]


def edge_rows(seed=0):
    rows = [(i, t, "en" if i % 2 else "de", "s", len(t)) for i, t in enumerate(texts(seed), 100)]
    long_text = " ".join(f"long{i % 5000}" for i in range(40_000)) + "\n" + "x" * 30_000
    rows += [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "  \n\t ", "en", "s", 5), (4, long_text, "en", "s", 1),
             (5, long_text, "en", "s", 1), (6, "a b c", "en", "s", 5), (7, "A B C", "de", "s", 5), (8, "...", "de", "s", 3),
             (None, rows[3][1], "en", "s", 1), (None, "only here without an id, told apart by text", "en", "s", 1),
             (9, "twice the same row of words here", "en", "s", 1), (9, "twice the same row of words here", "en", "s", 1),
             (10, "nul \0 byte and <|endoftext|> mark", "en", "s", 1)]
    return rows


def edge_docs(spark, seed=0):
    """Edge rows plus columns whose names clash with inner ones."""
    df = spark.createDataFrame(edge_rows(seed), DOCS)
    return df.selectExpr("*", "'x' AS id", "1 AS v", "'y' AS name", "2 AS bucket", "3 AS t", "4 AS label", "5 AS node")


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
