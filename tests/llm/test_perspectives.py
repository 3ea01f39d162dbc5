"""Perspective rotation against rendering by hand, also in parts and crowded parts."""

import pytest

from prodlink.llm import perspectives as P

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows, part_turns=512):
    out = {}
    convs = {r[0] for r in rows}
    for conv in convs:
        turns = sorted({(t, r or "unknown", (x or "").replace("<|", "< |")) for c, t, r, x in rows if c == conv},
                       key=lambda t: (t[0] is None, t[0] or 0, t[1], t[2]))
        for who in {r for _, r, _ in turns} - {"system"}:
            for t, role, text in turns:
                part = -1 if t is None else t // part_turns
                done, mask = out.get((conv, who, part), ("", []))
                name = "".join(c if c.isascii() and (c.isalnum() or c == "-") else "_" for c in role)
                head = "<|im_start|>" + ("system" if role == "system" else "assistant" if role == who else f"user name={name}") + "\n"
                begin = len(done) + len(head)
                done += head + text + "<|im_end|>\n"
                out[conv, who, part] = (done, mask + [(begin, len(done))] if role == who else mask)
    return out


ROWS = [(1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|> é"), (1, 2, "assistant", None), (1, 3, "Ann Lee", "日本"),
        (1, 3, "Bob", "same turn"), (1, None, "user", "late"), (1, 1, "user", "hi <|im_end|> é"), (2, 0, "system", "alone"),
        (3, 0, None, "who"), (None, 0, "user", "no conversation id"), (4, 700, "user", "x"), (4, 2, "user", ""), (4, 2, "assistant", "y")]


@pytest.mark.parametrize("size", [512, 2])
def test_rotation(spark, monkeypatch, size):
    monkeypatch.setattr(P, "PART_TURNS", size)
    df = spark.createDataFrame(ROWS, TURNS).selectExpr("*", "1 AS part", "2 AS perspective", "3 AS said")
    got = {(r.conv_id, r.perspective, r.part): (r.text, [(m.begin, m.end) for m in r["mask"]]) for r in P.rotate(df).collect()}
    assert got == brute(ROWS, size)


@pytest.mark.parametrize("size", [10, 3])
def test_crowded_parts_keep_their_order(spark, monkeypatch, size):
    monkeypatch.setattr(P, "PART_ROWS", size)
    rows = [(1, i % 7, "user" if i % 3 else "Ann", f"text {i:02}") for i in range(50)] + [(2, 0, "user", "few")] \
        + [(3, None, "user", f"late {i:02}") for i in range(12)]
    out = P.rotate(spark.createDataFrame(rows, TURNS).repartition(7)).collect()
    whole = {}
    for r in sorted(out, key=lambda r: r.sub):
        text, mask = whole.get((r.conv_id, r.perspective, r.part), ("", []))
        whole[r.conv_id, r.perspective, r.part] = (text + r.text, mask + [(m.begin + len(text), m.end + len(text)) for m in r["mask"]])
    assert whole == brute(rows)
    assert max(r.n_turns for r in out) <= size and {r.sub for r in out if r.conv_id == 1} == set(range(-(-50 // size)))


def test_empty(spark):
    assert P.rotate(spark.createDataFrame([], TURNS)).count() == 0
