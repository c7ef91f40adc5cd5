import json

from pyspark.sql import functions as F

from corvox.operators import cleaning
from corvox.sources import markup as M
from corvox.sources import readers as R
from corvox.sources import writers as W
from corvox.streaming import streams


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_tolerant_manifest(spark, tmp_path):
    p = put(tmp_path / "m.jsonl", '{"id":"a","conversations":[]}\n\n{broken\n{"id":"b"}\n')
    assert sorted(r["id"] for r in R.manifest(spark, p).collect()) == ["a", "b"]
    assert [(r["bad"], r["good"]) for r in R.malformed(spark, p).collect()] == [(1, 2)]


def test_index_and_shard_names(spark, tmp_path):
    p = put(tmp_path / "m.idx", b"\0" * 32)
    assert R.index_rows(spark, p).first()["rows"] == 3
    assert R.expanded("a_OP_0..2_CL_b") == ["a0b", "a1b", "a2b"] and R.expanded("x") == ["x"]


def test_fields_and_lists(spark, tmp_path):
    p = put(tmp_path / "segments.txt", "a\tb\t1\t2\nshort\tline\n")
    assert R.fields(spark, p, ["i", "u", "s", "e"]).count() == 1
    q = put(tmp_path / "t.csv", "id,words\n1,\"['a','b']\"\n2,\n")
    assert [r["words"] for r in R.delimited(spark, q, "id long, words string", lists=["words"]).orderBy("id").collect()] == [["a", "b"], None]
    k = put(tmp_path / "clips.tsv", 'path\ttext\nx/a.mp3\tsay "hi\nx/b.mp3\tno\n')
    keep = spark.createDataFrame([("a",)], "stem string")
    assert [r["text"] for r in R.clip_index(spark, k, "path string, text string", "path", keep).collect()] == ['say "hi']


def test_srt_and_words(spark, tmp_path):
    p = put(tmp_path / "a.srt", "1\r\n00:00:01,500 --> 00:00:02,000\r\nAnna: hello\r\nthere\r\n\r\n2\n01:00:00,000 --> 01:00:01,250\nbye\n")
    rows = [(r["number"], r["start"], r["end"], r["speaker"], r["text"]) for r in R.srt(spark, p).orderBy("number").collect()]
    assert rows == [(1, 1.5, 2.0, "Anna", "hello there"), (2, 3600.0, 3601.25, None, "bye")]
    w = put(tmp_path / "w.json", json.dumps({"segments": [{"words": [{"word": "a", "start": 0, "end": 1}]}, {"words": [{"word": "b", "start": 1, "end": 2}]}]}))
    assert [r["word"] for r in R.whisper_words(spark, w).orderBy("pos").collect()] == ["a", "b"]


def test_results_and_audio(spark, tmp_path):
    for step in (10, 20):
        put(tmp_path / f"r/step={step}/results.json", json.dumps({"d": {"wer": step / 100, "lang": "fr"}}))
    rows = R.results(spark, str(tmp_path / "r")).orderBy("step").collect()
    assert [(r["step"], r["dataset"], r["metric"], r["value"]) for r in rows] == [(10, "d", "wer", 0.1), (20, "d", "wer", 0.2)]
    put(tmp_path / "au/s1/a.wav", b"x")
    put(tmp_path / "au/s1/note.txt", b"x")
    got = R.audio_index(spark, str(tmp_path / "au")).first()
    assert (got["name"], got["stem"], got["parent"]) == ("a.wav", "a", "s1")


NITE = 'xmlns:nite="http://nite.sourceforge.net/"'


def test_annotations(spark, tmp_path):
    words = f'<nite:root {NITE}><w nite:id="w0" starttime="0.1" endtime="0.2">He</w><w nite:id="w1" trunc="true">sa</w><w nite:id="w2" punc="true">.</w><vocalsound nite:id="v" type="laugh"/></nite:root>'
    p = put(tmp_path / "w.xml", words)
    put(tmp_path / "bad.xml", "<a>")
    rows = M.parsed(spark, [p, str(tmp_path / "bad.xml")], M.nxt_words, M.WORDS).orderBy("pos").collect()
    assert [(r["text"], r["join"], r["lex"]) for r in rows] == [("He", None, True), ("sa-", None, True), (".", "left", False), ("[laugh]", None, False)]
    seg = f'<nite:root {NITE}><segment nite:id="s" transcriber_start="1" transcriber_end="2"><nite:child href="x.xml#id(w0)..id(w2)"/></segment></nite:root>'
    assert M.nxt_segments(seg.encode()) == [("s", 1.0, 2.0, "w0", "w2")]
    top = f'<nite:root {NITE}><topic nite:id="t" description="open"><nite:child href="x#id(w0)..id(w1)"/><topic nite:id="u" description="sub"/></topic></nite:root>'
    assert M.nxt_topics(top.encode()) == [("t", None, "open", "w0", "w1"), ("u", "t", "sub", None, None)]
    act = f'<nite:root {NITE}><dact nite:id="a"><nite:pointer role="da-aspect" href="t.xml#id(k)"/><nite:child href="x#id(w1)"/></dact></nite:root>'
    assert M.nxt_acts(act.encode()) == [("a", "k", "w1", "w1")]
    link = f'<nite:root {NITE}><summlink><nite:pointer role="extractive" href="d#id(a)"/><nite:pointer role="abstractive" href="s#id(x)"/></summlink></nite:root>'
    assert M.nxt_links(link.encode()) == [("x", "a")]
    text = f'<nite:root {NITE}><abstract><sentence nite:id="x">All.</sentence></abstract></nite:root>'
    assert M.nxt_abstracts(text.encode()) == [("abstract", 0, "x", "All.")]


def test_transcriber_textgrid_tei():
    trs = b'<Trans><Speakers><Speaker id="s1" name="Ann"/><Speaker id="s2" name="Bob"/></Speakers><Turn speaker="s1 s2" startTime="0" endTime="5"><Sync time="0"/><Who nb="1"/>hi <Event desc="rire"/><Who nb="2"/>oh<Sync time="2"/>next</Turn></Trans>'
    assert M.transcriber(trs) == [(0, "Ann", 0.0, 2.0, "hi [rire]", 1), (0, "Bob", 0.0, 2.0, "oh", 0), (0, "Ann", 2.0, 5.0, "next", 0)]
    grid = 'File type = "ooTextFile"\nObject class = "TextGrid"\n\n0\n2\n<exists>\n1\n"IntervalTier"\n"spk"\n0\n2\n2\n0\n1\n"a ""b"""\n1\n2\n""\n'
    want = [("spk", 0.0, 1.0, 'a "b"'), ("spk", 1.0, 2.0, "")]
    assert M.textgrid(grid.encode()) == want and M.textgrid(grid.encode("utf-16")) == want
    assert M.decoded("é".encode("cp1252")) == "é"
    tei = b'<TEI xmlns="http://www.tei-c.org/ns/1.0"><timeline><when xml:id="T0"/><when xml:id="T1" interval="1.5" since="#T0"/><when xml:id="T2" interval="3" since="#T0"/></timeline><u who="#A" start="#T0" end="#T2">one<anchor synch="#T1"/>two</u></TEI>'
    assert M.tei(tei) == [(0.0, 1.5, "A", "one"), (1.5, 3.0, "A", "two")]


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(i, "en" if i % 2 else "fr", f"t{i}") for i in range(10)], "id long, lang string, text string")
    W.outputs(rows.withColumn("output", F.lit("base")), str(tmp_path / "o"))
    W.outputs(rows.limit(1).withColumn("output", F.lit("events")), str(tmp_path / "o"))
    assert {r["output"]: r["count"] for r in spark.read.json(str(tmp_path / "o")).groupBy("output").count().collect()} == {"base": 10, "events": 1}
    assert W.resumed(rows, str(tmp_path / "none"), "id long").count() == 10
    W.shards(rows.coalesce(1), str(tmp_path / "s"), 4)
    state = W.shard_state(spark, str(tmp_path / "s")).first()
    assert (state["rows"], state["shards"]) == (10, 3)
    W.statistics_csv(rows.groupBy("lang").count(), str(tmp_path / "c"), ["lang"])
    assert [r[0] for r in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()] == ["en", "fr"]
    assert W.markdown_table(rows.groupBy("lang").count().orderBy("lang")).splitlines()[2] == "| en | 5 |"
    nodes = [{"node_id": 0, "parent_id": -1, "kind": "group", "manifest": None}, {"node_id": 1, "parent_id": 0, "kind": "leaf", "manifest": "a"}, {"node_id": 2, "parent_id": -1, "kind": "leaf", "manifest": "b"}]
    assert "manifest_filepath: a  # 25.000 %" in W.weighted_yaml(nodes, {1: 0.25, 2: 0.75})


def test_streams(spark, tmp_path):
    put(tmp_path / "in/a.json", "".join(json.dumps({"text": t, "ts": f"2024-01-01 00:{m:02d}:00"}) + "\n" for t, m in (("a  b", 0), ("c [odd]", 3), ("d", 30))))
    rows = streams.manifest_stream(spark, str(tmp_path / "in"), "text string, ts timestamp")
    steps = cleaning.resolved(["normalize_spacing", "drop_unknown_brackets"], {})

    def drained(df, name, mode):
        q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name).collect()

    assert sorted((r["text"], r["dropped_by"]) for r in drained(streams.cleaned_stream(rows, steps), "cleaned", "append")) == [("a b", None), ("c [odd]", "drop_unknown_brackets"), ("d", None)]
    assert sorted(r["n"] for r in drained(streams.sessions(rows.withColumn("k", F.lit(1)), "ts", ["k"], "10 minutes", "1 hour"), "gaps", "complete")) == [1, 2]
    assert sorted(r["n"] for r in drained(streams.windowed_counts(rows.withColumn("k", F.lit(1)), "ts", ["k"], "10 minutes", "1 hour"), "counts", "complete")) == [1, 2]
