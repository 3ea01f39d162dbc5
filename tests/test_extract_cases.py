"""Listing extraction on hand-written sections covering the edge cases of the source format."""

import os
import tempfile

from prodlink.operators import extract as X
from prodlink.sources import listing as SL

SECTIONS = [
    # tab-separated, no sculptor line
    "FIGURE-000001\nAbout this item\nRelease Date\tJan-2025\tList Price\t12,100 JPY\nBrand\tAcme\n"
    "Product Line\tLine A\nSeries Title\tSeries A\nCharacter Name\tHero One\n"
    "Specifications\tScale: 1/12\nSize: H150mm\nMaterial: PVC & ABS\n[Set Contents]\nMain body",
    # comment line first, space-separated labels, other order, sculptor on the name line
    "# Page 1 of 2\nFIGURE-000002\nCharacter Name  Villain Two Sculptor  Someone Else\nBrand  Acme\n"
    "Release Date  Aug-2026 List Price 9,900 JPY",
    # price 0,000 and date UNKNOWN
    "FIGURE-000003\nRelease Date\tUNKNOWN\tList Price\t0,000 JPY\nBrand\tOther\nCharacter Name\tThing Three",
    # no code: skipped
    "Brand\tAcme\nCharacter Name\tNo Code Here At All, Long Enough To Pass Fifty",
    # too short: skipped
    "FIGURE-000005\nBrand\tX",
    # no brand: parsed, then filtered
    "FIGURE-000006\nCharacter Name\tNameless Brandless Figure\nProduct Line\tLine Z",
    # duplicate code: both kept
    "FIGURE-000001\nBrand\tAcme\nCharacter Name\tHero One Again\nSculptor\tS. One  \nCopyright x",
]
# "- " (trailing blank) does not separate records: the last two pieces form one section
TAIL = "FIGURE-000008\nBrand\tTail\nCharacter Name\tFirst Half\n- \nFIGURE-000009\nBrand\tIgnored"


def _write(root):
    doc = "\ufeff" + "\n-\n".join(SECTIONS + [TAIL])
    os.makedirs(os.path.join(root, "vendor_a"))
    with open(os.path.join(root, "vendor_a", "raw.txt"), "w", encoding="utf-8", newline="") as fh:
        fh.write(doc.replace("\n", "\r\n"))
    os.makedirs(os.path.join(root, "not_a_source"))
    with open(os.path.join(root, "not_a_source", "other.txt"), "w") as fh:
        fh.write("FIGURE-000099\nBrand\tNope\nCharacter Name\tShould Not Be Read At All")


def test_listing_edge_cases(spark):
    root = tempfile.mkdtemp(prefix="prodlink-listing-")
    _write(root)
    docs = SL.read_listing_text(spark, root)
    rows = {(r.gcode, r.name): r for r in X.build_catalog(docs).collect()}
    assert set(rows) == {("FIGURE-000001", "Hero One"), ("FIGURE-000002", "Villain Two"),
                         ("FIGURE-000003", "Thing Three"), ("FIGURE-000001", "Hero One Again"),
                         ("FIGURE-000008", "First Half")}
    a = rows[("FIGURE-000001", "Hero One")]
    assert (a.brand, a.product_line, a.series_title, a.release_date, a.sculptor) == \
        ("Acme", "Line A", "Series A", "Jan-2025", "")
    assert a.spec == "Scale: 1/12\nSize: H150mm\nMaterial: PVC & ABS"
    assert (a.material, a.price_jpy, a.price_usd, a.status) == ("PVC & ABS", "12100", "83.49", "")
    b = rows[("FIGURE-000002", "Villain Two")]
    assert (b.sculptor, b.release_date, b.price_jpy, b.price_usd) == \
        ("Someone Else", "Aug-2026 List Price 9,900 JPY", "9900", "68.31")
    c = rows[("FIGURE-000003", "Thing Three")]
    assert (c.release_date, c.price_jpy, c.price_usd, c.spec) == ("UNKNOWN", "0", "0.00", "")
    d = rows[("FIGURE-000001", "Hero One Again")]
    assert d.sculptor == "S. One"
    assert {r.source for r in rows.values()} == {"vendor_a"}

    counts = X.count_sections(X.split_records(docs)).collect()
    assert [(r.source, r.sections, r.parsed, r.kept) for r in counts] == [("vendor_a", 8, 6, 5)]
