"""The pipeline stage by stage: columns, decisions, and clean documents kept."""

import corpus_pipeline as C
import pytest
from edge_docs import DOCS, SF, edge_docs, edge_rows, empty_docs

import __spark_entry__ as E
from prodlink.llm import registry
from prodlink.llm.common import table
from prodlink.llm.decontaminate import find_hits
from prodlink.llm.linejoin import repeated_lines
from prodlink.llm.neardup import STAGE_PERCENT, near_groups
from prodlink.llm.subword import fit, score

COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = table(spark, SF, "documents")
    for name, stage in C.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = stage(spark, docs, SF).cache()
        if name == "packing":
            assert {r.doc_id for r in after.collect()} == set(before)
            break
        assert after.columns == COLS
        left = {r.doc_id: r.text for r in after.collect()}
        if name == "quality":
            good = score(docs, fit(docs, table(spark, SF, "labels")), ["doc_id"]).filter("score >= 0.3")
            assert left == {r.doc_id: before[r.doc_id] for r in good.collect()}
        elif name == "line_dedup":
            gone = {(r.id.doc, r.place) for r in repeated_lines(docs).collect()}
            for i, text in left.items():
                assert text == "\n".join(x for p, x in enumerate(before[i].split("\n")) if (i, p) not in gone)
            assert all(any(i == g for g, _ in gone) for i in set(before) - set(left))
        elif name == "near_dedup":
            assert left == {r.key: before[r.key] for r in near_groups(docs, STAGE_PERCENT).collect() if r.key == r.component}
        else:
            clean = find_hits(docs, table(spark, SF, "benchmark"), ["doc_id"]).filter("NOT contaminated").collect()
            assert left == {r.doc_id: before[r.doc_id] for r in clean}
        docs = after


def test_run_equals_its_stages(spark):
    rows = C.run(spark, SF).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_on_edge_rows_and_empty_tables(spark):
    """Null ids, texts and languages, empty and very long texts, repeated rows, clashing columns, no rows."""
    for name, stage in C.STAGES:
        assert stage(spark, empty_docs(spark), SF).collect() == [], name
        out = stage(spark, edge_docs(spark), SF)
        assert name == "packing" or out.columns == COLS
        got = {r.doc_id for r in out.collect()}
        assert got <= {r[0] for r in edge_rows()} and got, name


def test_near_dedup_without_ids(spark):
    """Rows without an id are told apart by their texts; a group keeps one; they rank before all ids."""
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, text, None, None, None), (None, text.upper(), None, None, None), (None, text, None, None, None),
            (None, "another text of its own with words enough", "en", "s", 1), (None, None, None, None, None), (None, "", None, None, None),
            (7, text + " end", "en", "s", 1), (7, text + " end", "en", "s", 1), (9, "", None, None, None)]
    left = dict(C.STAGES)["near_dedup"](spark, spark.createDataFrame(rows, DOCS), SF).collect()
    near = [r for r in left if r.text and r.text.lower().startswith("word0")]
    assert len(near) == 1 and near[0].doc_id is None
    rest = [r for r in left if r not in near]
    assert sorted((r.doc_id or 0, r.text or "") for r in rest) in (
        [(0, ""), (0, "another text of its own with words enough"), (9, "")],
        [(0, ""), (0, ""), (0, "another text of its own with words enough"), (9, "")])


def test_queries_are_registered():
    names = E.queries()
    assert "pipeline" in names and set(registry.QUERIES) <= set(names)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.execute(registry.ORACLES[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = [sorted(map(str, df[cols].itertuples(index=False, name=None))) for df in (got, want)]
    assert rows[0] == rows[1]
