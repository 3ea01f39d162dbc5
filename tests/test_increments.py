"""Posts once over several dumps, the last-wins snapshot, counts by observation, reports in one pass."""

import json
import os
import random
import time

from pyspark.sql import functions as F

from prodlink import run_folders
from prodlink.operators import enrich as N
from prodlink.operators import posts as P
from prodlink.operators import report as R
from prodlink.operators import snapshot as SN
from prodlink.sources.json_dump import read_listing_dumps
from prodlink.streaming import dumps as ST

CATALOG = ("cat_ord long, name string, brand string, product_line string, series_title string, sculptor string, "
           "material string, spec string, release_date string")


def _dump(path, posts):
    path.write_text(json.dumps({"data": {"children": [
        {"data": {"id": i, "title": t, "link_flair_text": "Quality Issues", "created_utc": 1.0, "selftext": ""}} for i, t in posts]}}))


def test_distinct_posts_keeps_the_first_copy(spark, tmp_path):
    _dump(tmp_path / "b.txt", [("1", "later"), ("3", "c"), (None, "no id"), (None, "no id")])
    _dump(tmp_path / "a.txt", [("2", "b"), ("1", "first"), ("1", "again"), ("", "no id")])
    children = read_listing_dumps(spark, str(tmp_path))
    rows = P.distinct_posts(children.repartition(5))
    assert rows.columns == children.columns
    got = sorted((r.post.id or "", r.post.title) for r in rows.collect())
    assert got == [("", "no id")] * 3 + [("1", "first"), ("2", "b"), ("3", "c")]


def test_stream_drops_posts_of_earlier_dumps(spark, tmp_path):
    dumps, out, ckpt = tmp_path / "dumps", str(tmp_path / "out"), str(tmp_path / "ckpt")
    dumps.mkdir()
    _dump(dumps / "a.txt", [("1", "x"), ("2", "x"), ("2", "x")])
    ST.run_posts_stream(spark, str(dumps), out, ckpt, distinct=True)
    _dump(dumps / "b.txt", [("2", "x"), ("3", "x")])
    _dump(dumps / "c.txt", [("3", "x"), ("1", "x"), ("4", "x")])
    ST.run_posts_stream(spark, str(dumps), out, ckpt, distinct=True)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3", "4"]


def test_stream_takes_a_backlog_as_one_batch(spark, tmp_path):
    dumps, out, ckpt = tmp_path / "dumps", str(tmp_path / "out"), tmp_path / "ckpt"
    dumps.mkdir()
    for i in range(120):
        _dump(dumps / f"{i}.txt", [(str(i), "a"), (str(i // 2), "a")])
    ST.run_posts_stream(spark, str(dumps), out, str(ckpt), distinct=True)
    assert sorted(int(r.id) for r in spark.read.parquet(out).collect()) == list(range(120))
    with_files = [p for p in (ckpt / "sources" / "0").iterdir() if p.name.isdigit()]
    assert len(with_files) == 1, "every batch goes through the whole state: their number must not grow with the files"
    assert "RocksDB" in (ckpt / "offsets" / "0").read_text()


def test_stream_forgets_after_its_horizon(spark, tmp_path):
    """State is bounded: an identity last brought by a dump long before the newest one is forgotten."""
    dumps, out, ckpt = tmp_path / "dumps", str(tmp_path / "out"), str(tmp_path / "ckpt")
    dumps.mkdir()
    for day, posts in enumerate([[("1", "x")], [("2", "x")], [("3", "x")], [("1", "x")]]):
        path = dumps / f"{day}.txt"
        _dump(path, posts)
        os.utime(path, (time.time() + 86400 * 10 * day,) * 2)
        ST.run_posts_stream(spark, str(dumps), out, ckpt, distinct=True, remember="5 days")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "1", "2", "3"]


def _catalog(spark, seed=0, n=300):
    rng = random.Random(seed)
    return spark.createDataFrame([(i, rng.choice(["Ann", "ANN", "bob", "Cy"]) + str(rng.randrange(20)), f"B{rng.randrange(3)}", "L",
                                   f"series {i}", "S", "M", f"Scale: 1/{i}", "Mar-2020") for i in range(n)], CATALOG)


def _rows(df):
    return sorted(map(tuple, df.select("k_name", "k_brand", "cat_ord", "series_title").collect()))


def test_snapshot_equals_the_full_run(spark, tmp_path):
    rows, path = _catalog(spark), str(tmp_path / "snap")
    for step, part in enumerate((2, 0, 1, 0)):  # mixed order, one delivery twice
        SN.add_rows(rows.where(F.col("cat_ord") % 3 == part), path)
        if step == 1:
            SN.compact(spark, path)
    assert _rows(SN.read_snapshot(spark, path)) == _rows(N.dedupe_last(rows))
    SN.compact(spark, path)
    assert os.listdir(path) == [d for d in os.listdir(path) if d.startswith("base-")] and len(os.listdir(path)) == 1
    SN.add_rows(rows.where("false"), path)
    assert len(os.listdir(path)) == 1
    assert _rows(SN.read_snapshot(spark, path)) == _rows(N.dedupe_last(rows))


def test_snapshot_ignores_what_a_dead_run_left(spark, tmp_path):
    rows, path = _catalog(spark, n=40), str(tmp_path / "snap")
    SN.add_rows(rows.where("cat_ord < 20"), path)
    before = _rows(SN.read_snapshot(spark, path))
    for left in ("delta-000000002", "base-000000002"):  # folders without _SUCCESS
        N.dedupe_last(rows).write.parquet(f"{path}/{left}")
        os.remove(f"{path}/{left}/_SUCCESS")
    assert _rows(SN.read_snapshot(spark, path)) == before
    SN.add_rows(rows.where("cat_ord >= 20"), path)
    assert _rows(SN.read_snapshot(spark, path)) == _rows(N.dedupe_last(rows))


def test_stream_enriches_from_the_snapshot(spark, tmp_path):
    rows, path = _catalog(spark).withColumn("name", F.concat(F.lit("wonderful heroine "), "name")), str(tmp_path / "snap")
    SN.add_rows(rows, path)
    (tmp_path / "dumps").mkdir()
    _dump(tmp_path / "dumps" / "a.txt", [("1", "my wonderful heroine bob3 is bent"), ("2", "nothing")])
    ST.run_link_stream(spark, str(tmp_path / "dumps"), rows, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                       enrich=ST.enrich_from_snapshot(spark, path, 2024))
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.figure_name, r.found, r.age, r.issues) for r in out] == [("wonderful heroine bob3", True, "4 Years", '["warped_parts"]')]


def test_stage_counts_observe_one_run(spark):
    counts = R.StageCounts()
    evaluated = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            evaluated.add(b.num_rows)
            yield b

    source = counts.watch(spark.range(100).mapInArrow(touch, "id long"), "source", even=F.col("id") % 2 == 0)
    counts.watch(source.where("id < 30"), "kept").write.format("noop").mode("overwrite").save()
    assert counts.values() == {"source": 100, "even": 50, "kept": 30}
    assert evaluated.value == 100
    assert {r.stage: r.n for r in counts.table(spark).collect()} == counts.values()


def test_stages_that_were_not_needed_are_counted(spark):
    counts = R.StageCounts()
    full, none = counts.watch(spark.range(7), "full"), counts.watch(spark.range(5).where("id > 9"), "none")
    full.join(none, "id").write.format("noop").mode("overwrite").save()
    assert counts.values() == {"full": 7, "none": 0}


def test_top_errors(spark):
    rng = random.Random(3)
    rows = [(p, e, f"m{p}.{e}") for p in range(40) for e in range(rng.randint(1, 3))]
    errors = spark.createDataFrame(rows, "post_id long, err_ord int, message string").repartition(6)
    evaluated = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            evaluated.add(b.num_rows)
            yield b

    got = R.top_errors(errors.mapInArrow(touch, errors.schema), n=7)
    assert sorted(map(tuple, got.collect())) == [(*r, len(rows) - 7) for r in sorted(rows)[:7]]
    assert evaluated.value == len(rows), "the errors are computed once"
    assert [r.more for r in R.top_errors(errors, n=len(rows) + 1).collect()] == [0] * len(rows)
    assert R.top_errors(errors.where("false")).collect() == []


def test_rollup_tells_totals_from_nulls(spark):
    rows = [("right", "used", "a")] * 3 + [("right", "unused", "b")] * 2 + [(None, "unused", None)] * 4 + [("wrong", None, "c")]
    df = spark.createDataFrame(rows, "right string, use string, category string")
    got = {(r.right, r.use, r.category, r.level): (r.n, round(r.pct, 6)) for r in R.accuracy_rollup(df, ("right", "use")).collect()}
    assert got[None, None, None, 7] == (10, 100.0)                 # all
    assert got[None, None, None, 3] == (4, 40.0)                   # the class null of the first scheme
    assert got[None, None, None, 2] == (4, 40.0)                   # its category null
    assert got["right", None, None, 3] == (5, 50.0) and got[None, "unused", None, 5] == (6, 60.0)
    assert got[None, "unused", None, 4] == (4, 40.0) and got[None, "unused", "b", 4] == (2, 20.0)
    assert len(got) == 4 + 3 + 4 + 3 + 1


def _section(code, name, brand="Acme"):
    return "\n".join([f"FIGURE-{code}", "About this item", "Release Date\tMar-2017\tList Price\t1,000 JPY",
                      f"Brand\t{brand}", "Product Line\tLine", f"Character Name    {name}", "Specifications\tScale: 1/6"])


def test_folder_run_counts_sections_and_takes_posts_once(spark, tmp_path):
    (tmp_path / "in" / "v1").mkdir(parents=True)
    (tmp_path / "in" / "v2").mkdir()
    (tmp_path / "in" / "v1" / "raw.txt").write_text(
        "\n-\n".join([_section("1", "Wonderful Heroine"), "no code here", " ", _section("2", "Other", brand="").replace("Brand\t", "Maker")]))
    (tmp_path / "in" / "v2" / "raw.txt").write_text("nothing")
    (tmp_path / "dumps").mkdir()
    _dump(tmp_path / "dumps" / "a.txt", [("1", "wonderful heroine"), ("2", "nothing")])
    _dump(tmp_path / "dumps" / "b.txt", [("1", "wonderful heroine")])
    args = dict(listings=f"{tmp_path}/in", dumps=f"{tmp_path}/dumps", as_of_year=2026, run_date="2026-01-01")
    every = run_folders(spark, out=f"{tmp_path}/out1", **args)
    once = run_folders(spark, out=f"{tmp_path}/out2", distinct_posts=True, **args)
    assert (every["posts"], every["matched"], once["posts"], once["matched"]) == (3, 2, 2, 1)
    report = spark.read.option("header", True).csv(f"{tmp_path}/out1/reports/run_date=2026-01-01/sources").collect()
    assert {r.source: (r.sections, r.parsed, r.kept, r.products) for r in report} == {
        "v1": ("3", "2", "1", "1"), "v2": ("1", "0", "0", "0")}
