"""Operators whose groups may be hot, against plain folds over whole groups."""

import random

import pytest
from pyspark.sql import functions as F

from corvox.operators import ranking, synthesis, timeline


def recordings(draw, n):
    """A recording with most of the rows, with long and short pauses, overlaps and ties, and some small ones."""
    rows, at = [], {}
    for i in range(n):
        rec = "hot" if draw.random() < 0.8 else f"r{draw.randrange(4)}"
        at[rec] = at.get(rec, -5000.0) + draw.choice([0.0, 0.5, 3.0, 8.0, 40.0, 2500.0])
        rows.append((rec, i, "s", at[rec], at[rec] + draw.choice([0.5, 2.0, 9.0, 30.0])))
    draw.shuffle(rows)
    return rows


def by_recording(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[3], r[4], r[1])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.fixture(scope="module")
def table(spark):
    rows = recordings(random.Random(5), 1500)
    return rows, spark.createDataFrame(rows, "recording string, seg_id long, speaker string, start double, end double").repartition(5)


def test_greedy_windows(table):
    rows, segments = table
    want = {}
    for own in by_recording(rows).values():
        window, begin, n = 0, None, 0
        for _, i, _, s, e in own:
            if begin is None or e - begin > 30 or n >= 6:
                window, begin, n = window + 1, s, 0
            n += 1
            want[i] = window
    out = timeline.greedy_windows(segments, 30.0, 6)
    assert out.columns == [*segments.columns, "window"]
    assert {r["seg_id"]: r["window"] for r in out.collect()} == want
    assert timeline.greedy_windows(segments.limit(0), 30.0, 6).count() == 0


def test_chains(table):
    rows, segments = table
    want = []
    for rec, own in by_recording(rows).items():
        kept, open_ = [], None
        for _, i, _, s, e in own:
            if open_ and (s - open_[1] > 5 or open_[2] + e - s > 40):
                kept.append(open_)
                open_ = None
            open_ = open_ or [s, e, 0.0, []]
            open_ = [open_[0], max(open_[1], e), open_[2] + e - s, [*open_[3], i]]
            if open_[2] >= 10 and i % 3 == 0:
                kept.append(open_)
                open_ = None
        kept += [open_] if open_ else []
        want += [(rec, k, *c[:3], c[3]) for k, c in enumerate(c for c in kept if 10 <= c[2] <= 40)]
    out = timeline.chains(segments, 5.0, 40.0, 10.0, F.col("seg_id") % 3 == 0)
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


@pytest.mark.parametrize("share", [0.2, 0.9])
def test_negative_pairs_of_a_hot_speaker(spark, share):
    draw = random.Random(1)
    rows = [(i, "hot" if draw.random() < share else f"s{draw.randrange(3)}") for i in range(700)]
    out = synthesis.negative_pairs(spark.createDataFrame(rows, "clip long, speaker string").repartition(4), "clip", "speaker", "x").collect()
    speaker = dict(rows)
    assert sorted(r["clip"] for r in out) == [i for i, _ in rows]
    assert all(speaker[r["clip"]] != speaker[r["other"]] for r in out)
    alone = spark.createDataFrame([(1, "a"), (2, "a")], "clip long, speaker string")
    assert synthesis.negative_pairs(alone, "clip", "speaker", "x").count() == 0
    assert synthesis.negative_pairs(alone.limit(0), "clip", "speaker", "x").count() == 0


def test_numbers_of_a_hot_group(spark):
    rows = [(i, None if i % 7 == 0 else "a", (i * 37 % 101) / 101) for i in range(500)]
    out = ranking.numbered(spark.createDataFrame(rows, "id long, lang string, u double").repartition(3), ["lang"], F.col("u"), ["id"], "n").collect()
    for lang in (None, "a"):
        own = sorted((r for r in out if r["lang"] == lang), key=lambda r: (r["u"], r["id"]))
        assert [r["n"] for r in own] == [*range(len(own))]


def test_turns_are_split_before_they_are_windowed(spark):
    words = [{"start": float(k), "end": k + 0.5, "text": f"w{k}"} for k in range(10)]
    rows = [("r", 1, "a", 0.0, 9.5, "all", words), ("r", 2, "b", 20.0, 27.0, "untimed", None), ("r", 3, "c", 30.0, 32.0, "short", [])]
    turns = spark.createDataFrame(rows, "recording string, seg_id long, speaker string, start double, end double, text string, words array<struct<start:double,end:double,text:string>>")
    out = [tuple(r) for r in timeline.split_turns(turns, 3.0).orderBy("seg_id", "piece").collect()]
    assert [(r[1], r[2], r[4], r[5], r[6]) for r in out] == [
        (1, 0, 0.0, 2.5, "w0 w1 w2"), (1, 1, 3.0, 5.5, "w3 w4 w5"), (1, 2, 6.0, 8.5, "w6 w7 w8"), (1, 3, 9.0, 9.5, "w9"),
        (2, 0, 20.0, 23.0, "untimed"), (2, 1, 23.0, 26.0, ""), (2, 2, 26.0, 27.0, ""), (3, 0, 30.0, 32.0, "short"),
    ]
    windows = {(r["seg_id"], r["piece"]): r["window"] for r in timeline.turn_windows(turns, 3.0, 5).collect()}
    assert windows == {(1, 0): 1, (1, 1): 2, (1, 2): 3, (1, 3): 4, (2, 0): 5, (2, 1): 6, (2, 2): 7, (3, 0): 8}


@pytest.mark.parametrize("together", [3, 1_000_000])
def test_recordings_are_cut_or_not_alike(spark, monkeypatch, together):
    """Gaps, runs and islands of a recording with nearly all rows, cut into bins or ordered whole."""
    monkeypatch.setattr(timeline, "TOGETHER", together)
    draw = random.Random(8)
    rows, t = [], 0.0
    for k in range(400):
        t += draw.choice([0.0, 0.2, 0.9, 1.5, 4.0])
        rows.append(("hot" if k % 20 else f"r{k}", k, draw.choice(["a", "b", None]), t, t + draw.choice([0.1, 1.0, 6.0]), f"w{k}"))
    s = spark.createDataFrame(rows, "recording string, seg_id long, speaker string, start double, end double, text string")
    got = {r["seg_id"]: (r["recording"], r["island"]) for r in timeline.runs(s, 1.0).collect()}
    want, number, last, speaker, began = {}, {}, {}, {}, {}
    for rec, i, who, a, b, _ in sorted(rows, key=lambda r: (r[0], r[3], r[4], r[1])):
        change = rec not in number or speaker[rec] is None or who is None or who != speaker[rec]
        if change or a - last[rec] > 1.0:
            number[rec] = number.get(rec, 0) + 1
            began[rec] = change or began[rec]
        last[rec] = b if change else max(last[rec], b)
        speaker[rec], want[i] = who, (rec, number[rec])
    assert got == want
    ends, gaps = {}, []
    for rec, i, _, a, b, _ in sorted(rows, key=lambda r: (r[0], r[3], r[4], r[1])):
        if rec in ends and 1 <= a - ends[rec][0] <= 10:
            gaps.append((rec, round(a - ends[rec][0], 6), ends[rec][2], i))
        ends[rec] = max(ends.get(rec, (-1.0, -1.0, -1)), (b, a, i))
    assert sorted((r["recording"], round(r["gap"], 6), r["previous_id"], r["next_id"]) for r in timeline.gaps(s, 1, 10).collect()) == sorted(gaps)
