"""The folder-to-folder run: whole bodies, earlier outputs, absent inputs, order over many vendors."""

import json

from pyspark.sql import functions as F

from prodlink import run_folders
from prodlink.operators import posts as P
from prodlink.operators.catalog import union_catalogs
from prodlink.plans import derived as D
from prodlink.sources.csv_lenient import read_csv_lenient, write_stage_csv
from prodlink.sources.json_dump import read_listing_dumps


def _section(code, name, brand="Acme"):
    return "\n".join([f"FIGURE-{code}", "About this item", "Release Date\tMar-2017\tList Price\t1,000 JPY",
                      f"Brand\t{brand}", "Product Line\tLine", f"Character Name    {name}", "Sculptor\tS ",
                      "Specifications\tScale: 1/6", "Material: PVC"])


def _dump(path, posts, flair="Quality Issues"):
    path.write_text(json.dumps({"data": {"children": [
        {"data": {"id": str(i), "title": "t", "author": "a", "link_flair_text": flair, "created_utc": 1.0,
                  "selftext": body, "permalink": "/p"}} for i, body in enumerate(posts)]}}))


def test_run_folders_links_whole_bodies_and_reports(spark, tmp_path):
    for v in range(300):  # more vendor folders than a byte counts
        (tmp_path / "in" / f"v{v:03}").mkdir(parents=True)
        (tmp_path / "in" / f"v{v:03}" / "raw.txt").write_text(_section(f"{v:06}", f"Wonderful Heroine {v}"))
    (tmp_path / "more.csv").write_text("brand,name\nBeta,Wonderful Heroine 7\n")
    (tmp_path / "dumps").mkdir()
    _dump(tmp_path / "dumps" / "a.txt", ["x " * 400 + "wonderful heroine 7 came warped", "nothing here"])
    (tmp_path / "dumps" / "b.txt").write_text('[{"data": {"children": [{"data": {"id": "9"}}]}}]')
    (tmp_path / "dumps" / "c.txt").write_text('{"data": ')
    args = dict(listings=f"{tmp_path}/in", dumps=f"{tmp_path}/dumps", out=f"{tmp_path}/out",
                catalog_csvs=[f"{tmp_path}/more.csv", f"{tmp_path}/absent.csv"], as_of_year=2026)
    counts = run_folders(spark, **args, run_date="2026-01-01")
    assert counts["catalog"] == 301 and counts["posts"] == 2
    assert (counts["matched"], counts["unmatched"]) == (1, 1)
    assert counts["combined"] == counts["found_in_catalog"] + counts["missing_from_catalog"] == 1
    match = spark.read.option("header", True).csv(f"{tmp_path}/out/matches").where("figure_name <> ''").first()
    # The listing vendor comes first, so its row wins the tie with the CSV's.
    assert (match.figure_name, match.brand, match.detected_issues) == ("Wonderful Heroine 7", "Acme", "warped_parts")
    sources = spark.read.option("header", True).csv(f"{tmp_path}/out/reports/run_date=2026-01-01/sources")
    assert sources.count() == 301
    run_folders(spark, **args, run_date="2026-01-02")
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/combined").groupBy("run_date").count().count() == 2
    # Absent dumps: the run goes on, and the earlier posts export stays.
    left = run_folders(spark, **(args | {"dumps": f"{tmp_path}/nowhere"}), run_date="2026-01-03")
    assert left["posts"] == 0 and left["passed"]
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/posts").count() == 2


def test_posts_keep_the_whole_body(spark, tmp_path):
    _dump(tmp_path / "a.txt", ["é\n" * 600])
    row = P.build_posts(read_listing_dumps(spark, str(tmp_path))).first()
    assert row.selftext == "é\n" * 600 and row.preview == "é " * 250


def test_csv_columns_by_name_and_arity_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("brand,name\nB1,N1\nB2\n")
    (tmp_path / "b.csv").write_text("name,extra,brand\nN3,x,B3\nN4,B4\n")
    (tmp_path / "c.csv").write_text("")
    rows = read_csv_lenient(spark, str(tmp_path), ["name", "brand", "line"]).collect()
    assert sorted(map(tuple, rows)) == [("N1", "B1", ""), ("N3", "B3", "")]
    assert read_csv_lenient(spark, f"{tmp_path}/none", ["name"]).count() == 0


def test_sink_keeps_other_partitions_and_skips_empty(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "v string, day string")
    out = f"{tmp_path}/out"
    assert write_stage_csv(df, out, ["day"])
    assert write_stage_csv(df.where("day = '2'").withColumn("v", F.lit("c")), out, ["day"])
    assert not write_stage_csv(df.where("false"), out, ["day"])
    back = spark.read.option("header", True).csv(out)
    assert sorted((r.v, str(r.day)) for r in back.collect()) == [("a", "1"), ("c", "2")]


def test_union_orders_by_vendor_then_place(spark):
    big = 1 << 45
    a = spark.createDataFrame([(big, "x")], "cat_ord long, name string")
    b = spark.createDataFrame([(1, "y")], "cat_ord long, name string")
    rows = union_catalogs([a, b]).orderBy("link_ord").collect()
    assert [r.name for r in rows] == ["x", "y"]


def test_codes_are_never_cut(spark, tmp_path):
    spark.createDataFrame([(1234567,), (12345678,), (1234567890123,)], "p_partkey long").selectExpr(
        "p_partkey", "'n' p_name", "'b' p_brand", "'t' p_type", "1 p_size", "900.0D p_retailprice") \
        .write.parquet(f"{tmp_path}/part.parquet")
    codes = {r.section.split("\n")[0] for r in D.listing_sections(spark, str(tmp_path)).collect()}
    assert {"FIGURE-000001234567", "FIGURE-000012345678", "FIGURE-1234567890123"} >= codes - {"NOCODE"} and len(codes) >= 2
