"""Meeting rows, sentences, cues and events on small inputs, and what they do with nulls, ties and gaps."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corvox.operators import cues, events, meetings, metadata, qa, turns

WORDS = "meeting string, file string, id string, pos long, text string, start double, end double, join string, lex boolean"
RANGES = "meeting string, agent string, owner string, child long, start double, end double, file string, first_word string, last_word string"


def words_of(*rows):
    """Words of one file: (text, start, end, join, lex)."""
    return [("m", "A.words.xml", f"w{k}", k, *r) for k, r in enumerate(rows)]


def test_speaker_rows(spark):
    said = words_of(
        ("I", 0.0, 0.2, None, True), ("'m", 0.2, 0.3, None, True), ("<gap>", None, None, None, False), ("<gap>", None, None, None, False), ("here", 5.0, 5.5, None, True),
        (".", None, None, "left", False), ("(", 9.0, 9.1, "right", False), ("so", 9.1, 9.4, None, True), ("it", 9.4, 9.5, None, True), ("<vocalsound:laugh>", 20.0, 21.0, None, False),
    )
    segments = [
        ("m", "A", "s1", 0, None, None, "A.words.xml", "w0", "w8"), ("m", "A", "s2", 0, 20.0, 21.0, "A.words.xml", "w9", None), ("m", "A", "s3", 0, 0.0, 9.0, "A.words.xml", "nowhere", "w1"),
        ("m", "B", "s4", 0, 9.0, 9.5, "A.words.xml", "w7", "nowhere"), ("m", "A", "s5", 0, 3.0, 2.0, "A.words.xml", "w0", "w1"), ("m", "A", "s6", 0, 0.0, 3.0, None, None, None),
    ]
    w, s = spark.createDataFrame(said, WORDS), spark.createDataFrame(segments, RANGES)
    channels = spark.createDataFrame([("m", "A", 7)], "meeting string, agent string, channel int")
    rows = {r["id"]: r for r in meetings.speaker_rows(s, w, channels, 0.1, 6.0).collect()}
    told = {i: (r["offset"], r["duration"], r["text"]) for i, r in rows.items()}
    assert told == {"s1.0": (0.0, 2.65, "I'm <gap>"), "s1.1": (2.65, 4.6, "here."), "s1.2": (7.25, 2.25, "(so it"), "s4": (9.0, 0.5, "so")}
    assert rows["s4"]["audio"] == "m.Headset-1.wav" and all(r["audio"] == "m.Headset-7.wav" for i, r in rows.items() if i != "s4")
    assert meetings.speaker_rows(s.limit(0), w, channels, 0.1, 6.0).count() == 0


def test_cuts_stop_where_nothing_can_be_cut():
    assert meetings.cuts([0.0, 0.5], [0.4, 30.0], 0.0, 30.0, 10.0, 1.0) == [(0.0, 30.0, 0, 2)]
    assert meetings.cuts([0.0, None, 20.0], [1.0, None, 21.0], 0.0, 21.0, 15.0, 1.0) == [(0.0, 10.5, 0, 2), (10.5, 21.0, 2, 3)]
    assert meetings.cuts([], [], 0.0, 99.0, 10.0, 1.0) == [(0.0, 99.0, 0, 0)]


def test_built_sentences(spark):
    words = [("Well", 0.0, 0.2), (",", -1.0, -1.0), ("yes", 0.3, 0.5), (".", -1.0, -1.0), ("»", -1.0, -1.0), ("lost", -1.0, -1.0), ("", 1.0, 1.0), (None, 1.0, 1.0)]
    words += [(f"w{k}", 2.0 + 0.2 * k, 2.1 + 0.2 * k) for k in range(40)] + [("late", 30.0, 30.1), ("one", 60.0, 79.0), ("end", 80.0, 80.1)]
    rows = spark.createDataFrame([(1, words), (2, []), (3, None)], f"id int, words {qa.WORDS}")
    out = {r["id"]: r["s"] for r in rows.select("id", qa.built_sentences(F.col("words")).alias("s")).collect()}
    assert [(s["text"][:12], s["start"], round(s["end"], 6), s["n"]) for s in out[1]] == [("Well, yes.", 0.0, 0.5, 2), ("w0 w1 w2 w3 ", 2.0, 8.9, 35), ("w35 w36 w37 ", 9.0, 9.9, 5), ("late one", 30.0, 79.0, 2), ("end", 80.0, 80.1, 1)]
    assert out[2] == [] and out[3] is None


def test_cue_runs_in_a_hot_recording(spark):
    draw = random.Random(4)
    rows, t = [], 0.0
    for k in range(600):
        t += draw.choice([0.1, 0.8, 2.0])
        rows.append(("hot" if k % 30 else "cold", f"c{k}", round(t, 3), round(t + draw.choice([0.3, 0.7, 4.0]), 3), f"cue {k}"))
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want, segments = {}, []
    for rec, own in by.items():
        own.sort(key=lambda r: (r[2], r[3], r[1]))
        for i in range(0, len(own), 4):
            end = own[min(i + draw.randrange(4), len(own) - 1)][3] + draw.choice([0.0, 0.001, 0.4])
            run, at = [own[i]], own[i][3]
            for c in own[i + 1 :]:
                if abs(at - end) <= 0.002 or c[2] - at > 1.0 or c[3] - own[i][2] > 30:
                    break
                run.append(c)
                at = c[3]
            segments.append((rec, own[i][1], own[i][2], end))
            want[own[i][1]] = [c[1] for c in run] if abs(at - end) <= 0.002 else None
    s = spark.createDataFrame(segments, "recording string, seg_id string, start double, end double")
    c = spark.createDataFrame(rows, "recording string, cue_id string, start double, end double, text string")
    got = {r["seg_id"]: r["cues"] and [x["cue_id"] for x in r["cues"]] for r in cues.cue_runs(s, c).collect()}
    assert got == want and any(v and len(v) > 1 for v in want.values())


def test_cue_texts(spark):
    texts = ["-Mais *rires* il (dit) oui", "*Cris*", "Oui. - Non", "p%tain", "a*b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [" ".join(r[0].split()) for r in rows.select(cues.cue_text(F.col("t"))).collect()] == ["Mais [laughter] il dit oui", "", "Oui. Non", "p%tain", "a*b"]


def test_rendered_events(spark):
    item = "array<struct<kind:string,text:string,type:string,extent:string>>"
    items = [("text", " bonjour  toi", None, None), ("event", "RIRE fort", "noise", "begin"), ("event", "rires", "noise", "end"), ("event", "b", "noise", "instantaneous"), ("event", "porte", "noise", "instantaneous"), ("speaker", "Ann", None, None), ("text", "quoi?", None, None), ("event", "pause", "noise", "instantaneous"), ("event", "pi", "pronounce", "instantaneous"), ("comment", "x", None, None), ("text", None, None, None)]
    rows = spark.createDataFrame([(items,), ([],)], f"items {item}")
    assert [r[0] for r in rows.select(events.rendered(F.col("items"))).collect()] == ["bonjour toi [laughter] [noise] quoi? [inaudible]", ""]
    assert rows.select(events.rendered(F.col("items"), comment=lambda t: F.concat(F.lit("("), t, F.lit(")")))).first()[0].endswith("[inaudible] (x)")


@pytest.mark.parametrize("n", [1, 700])
def test_draws_in_groups(spark, n):
    draw = random.Random(n)
    rows = [("hot" if draw.random() < 0.9 else f"g{draw.randrange(3)}", k, draw.choice("ab"), draw.random()) for k in range(n)]
    df = spark.createDataFrame(rows, "g string, i long, a string, u double")
    own = defaultdict(list)
    for g, i, a, u in sorted(rows, key=lambda r: (r[3], r[1])):
        own[g].append((i, a, u))
    pairs = {(g, x[k][0], x[k + 1][0]) for g, x in own.items() for k in range(0, len(x) - 1, 2)}
    assert {tuple(r) for r in turns.drawn_pairs(df, "g", "i", F.col("u")).collect()} == pairs
    best = {(g, i) for g, x in own.items() for i, _, _ in sorted(x, key=lambda y: (-y[2], y[0]))[:3]}
    assert {(r["g"], r["i"]) for r in turns.best_of(df, ["g"], [F.desc("u"), F.col("i")], 3, F.col("i"), 4).collect()} == best
    chunks = {}
    for g, x in own.items():
        nth, seen = [], defaultdict(int)
        for i, a, u in x:
            nth.append((seen[a], a, i))
            seen[a] += 1
        chunks |= {i: k // 5 for k, (_, _, i) in enumerate(sorted(nth))}
    assert {r["i"]: r["chunk"] for r in turns.spread_chunks(df, "g", "a", ["u", "i"], F.floor(F.col("u") * 7), 5).collect()} == chunks


def test_metadata(spark):
    rows = spark.createDataFrame([("TownCouncil_01022020_X-1",), ("BigCityCouncil_1022020_9",), ("Town_01022020_1",), (None,)], "uid string")
    files = spark.createDataFrame([("Town", "/a/Town 01022020.mp3"), ("Town", "/a/A01022020b.mp3"), ("Big", "/b/x101022020.mp3"), ("Big", "/b/none.mp3")], "city string, path string")
    assert {r["uid"]: r["audio"] for r in metadata.meeting_audio(rows, files).collect()} == {"TownCouncil_01022020_X-1": "/a/A01022020b.mp3", "BigCityCouncil_1022020_9": "/b/x101022020.mp3", "Town_01022020_1": None, None: None}
    assert metadata.with_metadata(spark.createDataFrame([([],), (None,), ([" ", None],), (["x"],)], "g array<string>"), "g").count() == 1
