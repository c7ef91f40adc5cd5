import random

import pytest
from pyspark.sql import functions as F

from corvox.functions import hashing, text
from corvox.operators import cleaning as C
from corvox.operators import french
from corvox.operators import evaluation as E
from corvox.operators import lexicon, mixture, qa, rebuild
from corvox.operators import timeline as L
from corvox.operators import turns as T


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "name,options,before,after",
    [
        ("add_final_period", {}, "hello there,", "hello there."),
        ("add_final_period", {}, "hello there [noise]", "hello there. [noise]"),
        ("add_final_period", {}, "really? ", "really? "),
        ("normalize_punctuation", {}, "wait....what !!!", "wait...what !"),
        ("normalize_spacing", {}, "  a  ( b )  c .", "a ( b ) c."),
        ("uncased_no_punctuation", {}, "no, capitals.", "no capitals"),
        ("replace", {"rules": [("(a)b", "$1c")]}, "ab", "ac"),
        ("map_tags", {"rules": [("<laugh>", "[laughter]")]}, "ha<laugh>", "ha [laughter] "),
        ("normalize_unicode", {}, "é", "é"),
        ("strip_html", {}, "a&amp;lt;b&amp;gt; <i>c</i>", "a   c "),
        ("replace_keeping_case", {"rules": [("ok", "okay")]}, "Ok ok", "Okay okay"),
        ("all_caps", {}, "so WE ARE HERE now. THIS IS IT NOW", "so we are here now. This is it now"),
        ("fix_mixed_case", {}, "AciCLOvir iPhone NASA PCs", "Aciclovir iphone NASA PCs"),
        ("fix_spurious_caps", {"function_words": ["the", "of"]}, "He saw The cat. The end Of Paris", "He saw the cat. The end Of Paris"),
        ("numbers_to_words", {"units": {"%": "pour cent"}}, "21 et 80 et 1 234 à 3,5%", "vingt et un et quatre-vingts et mille deux cent trente-quatre à trois virgule cinq pour cent"),
        ("numbers_to_words", {"language": "en"}, "342 and 7.25", "three hundred and forty-two and seven point twenty-five"),
        ("disfluencies", {}, "Euh, il il va à la gar- gare euh.", "  Il va à la gare. "),
        ("disfluencies", {"mode": "keep"}, "euh well", "euh well"),
        ("fix_punctuation", {"common": ["the"]}, "he left. the dog. barked", "he left. The dog. Barked"),
        ("speaker_labels", {}, "Jean Paul : bonjour. AB : oui", "bonjour. oui"),
        ("restore_elisions", {}, "l eau et d or", "l'eau et d'or"),
        ("join_split_compounds", {"vocabulary": ["peut-être"]}, "peut- être mais- non", "peut-être mais- non"),
        ("normalize_interjections", {"spellings": {"ah": ["aah", "ahh"]}}, "Aah, ahh", "Ah, ah"),
        ("flagged_disfluencies", {"flags": lambda ws: [w == "to" and i == 1 for i, w in enumerate(ws)]}, "go to to it", "go to it"),
    ],
)
def test_filter(spark, name, options, before, after):
    row = C.cleaned(spark.createDataFrame([(before,)], "text string"), [C.Step(name, options, name)]).first()
    assert row["text"] == after and row["dropped_by"] is None and row["changed"] == ([name] if before != after else [])


@pytest.mark.parametrize(
    "name,options,value,dropped",
    [
        ("drop_if_match", {"patterns": ["x{3}"]}, "axxx", True),
        ("drop_unknown_brackets", {}, "a [noise]", False),
        ("drop_unknown_brackets", {}, "a [odd]", True),
        ("events", {}, "a [inaudible]", True),
        ("events", {"mode": "keep"}, "a [inaudible]", False),
        ("all_caps", {"action": "drop"}, "THIS IS ALL caps", True),
        ("empty", {}, "[noise] …", True),
        ("drop_ocr", {"vocabulary": ["le", "chat"]}, "l'xhat qsd zzz", True),
        ("drop_ocr", {"vocabulary": ["le", "chat"]}, "le chat", False),
    ],
)
def test_drops(spark, name, options, value, dropped):
    row = C.cleaned(spark.createDataFrame([(value,)], "text string"), [C.Step(name, options, name)]).first()
    assert (row["dropped_by"] == name) == dropped and (not dropped or row["text"] == value)


def test_pipeline_configuration(spark):
    blocks = {"a": ["normalize_spacing", {"block": "b"}], "b": ["normalize_spacing"], "c": [{"block": "c"}]}
    steps = C.resolved([{"block": "a"}, "events"], blocks)
    assert [s.label for s in steps] == ["normalize_spacing", "normalize_spacing#2", "events"]
    assert C.for_output(steps, "events")[-1].options == {"mode": "keep"} and C.for_output(steps, "base") == steps
    for bad in ([{"block": "c"}], [{"block": "d"}], ["nothing"]):
        with pytest.raises(ValueError):
            C.resolved(bad, blocks)
    with pytest.raises(ValueError):
        C.map_tags([("x", "[odd]")])
    out = C.cleaned(spark.createDataFrame([("a  b",), (None,), ("[inaudible]",)], "text string"), steps)
    stats = {r["filter"]: (r["changed"], r["dropped"]) for r in C.statistics(out).collect()}
    assert stats == {"normalize_spacing": (1, 0), "events": (0, 1)}
    C.text_filter("shout")(lambda: str.upper)
    assert C.cleaned(spark.createDataFrame([("a",)], "text string"), C.resolved(["shout"], {})).first()["text"] == "A"


def test_numbers():
    assert [french.number(n) for n in (0, 16, 22, 71, 81, 91, 100, 200, 201, 1000, 80_000, 2_000_001)] == [
        "zéro", "seize", "vingt-deux", "soixante et onze", "quatre-vingt-un", "quatre-vingt-onze", "cent", "deux cents", "deux cent un", "mille", "quatre-vingt mille", "deux millions un",
    ]
    assert C.english_number(1_000_015) == "one million and fifteen" and C.english_number(-21) == "minus twenty-one"


def test_transfer():
    text_, ratio = rebuild.transfer("hello world this is a peut- test", "Hello, world. This is a test.")
    assert text_ == "Hello, world. This is a peut- test." and ratio == 1
    assert rebuild.transfer("one two", "Entirely other words here") == ("one two", 0.0)
    assert rebuild.transfer("is it so? yes", "Is it so. Yes.")[0] == "Is it so? Yes."
    assert rebuild.transfer("", "") == ("", 0.0)


def test_redistribute():
    assert rebuild.redistribute("a x b c d", ["a b", "c d"]) == ["a x b", "c d"]
    assert rebuild.redistribute("x y", ["", "a"]) == ["x y", ""]
    assert rebuild.redistribute("", ["a"]) == [""]
    assert rebuild.ordered_by_raw(["c d", "a b"], "a b c d") == ["a b", "c d"]


def test_repaired(spark):
    words = spark.createDataFrame([("été", 3), ("ata", 9), ("etes", 1)], "w string, n long")
    out = rebuild.repaired(spark.createDataFrame([("�t�",), ("ok",)], "w0 string"), "w0", words)
    assert {r["w0"]: r["repaired"] for r in out.collect()} == {"�t�": "été", "ok": "ok"}


def test_splits_at_pauses():
    words = [(0, 10), (10.5, 20), (26, 40), (40.2, 45)]
    assert L.split_at_pauses(words, 30) == [(0, 23.0), (23.0, 45)]
    assert L.split_at_pauses([(0, 100)], 30) == [(0, 100)]
    assert L.split_long_turns([(0, 5, "a"), (5, 9, "b"), (9, 12, "c")], 10) == [(0, 9, "a b"), (9, 12, "c")]


def test_running_gap_and_merge(spark):
    rows = [("r", 1, "a", 0.0, 10.0, "x"), ("r", 2, "a", 2.0, 3.0, "y"), ("r", 3, "a", 10.5, 11.0, "z"), ("r", 4, "b", 15.0, 16.0, "w"), ("r", 5, "a", 16.0, 17.0, "v")]
    s = spark.createDataFrame(rows, "recording string, seg_id long, speaker string, start double, end double, text string")
    assert [(r["previous_id"], r["next_id"], r["gap"]) for r in L.gaps(s, 1, 10).collect()] == [(3, 4, 4.0)]
    merged = sorted((r["start"], r["end"], r["text"]) for r in L.merge_same_speaker(s, 1.0).collect())
    assert merged == [(0.0, 11.0, "x y z"), (15.0, 16.0, "w"), (16.0, 17.0, "v")]
    assert len(L.merge_same_speaker(s, None).collect()) == 3
    assert [r["n_segments"] for r in L.neighbour_runs(s, 0.5).collect()] == [2, 2]
    assert L.gaps(s.limit(0), 1, 10).count() == 0
    lines = L.silence_lines(L.gaps(s, 1, 10).withColumn("previous_dur", F.lit(40.0)).withColumn("next_dur", F.lit(1.0)), 30.0, "k").collect()
    assert lines[0]["kind"] in ("alone", "before") and lines[0]["total"] <= 30
    told = L.sentence_follows(spark.createDataFrame([("r", 1, "a", 0.0, 1.0, "He left"), ("r", 2, "a", 1.0, 2.0, "The end")], s.schema), ["the"])
    assert [r["text"] for r in told.orderBy("seg_id").collect()] == ["He left.", "The end"]


def test_overlaps_are_found_once(spark):
    draw = random.Random(1)
    rows = [("r", i, draw.choice("ab"), s, s + draw.random() * 30, "") for i, s in enumerate(draw.random() * 200 for _ in range(60))]
    s = spark.createDataFrame(rows, "recording string, seg_id long, speaker string, start double, end double, text string")
    found = sorted((r["a_id"], r["b_id"]) for r in L.overlaps(s, s, 7.0).collect())
    assert found == sorted((a[1], b[1]) for a in rows for b in rows if a[3] < b[4] and b[3] < a[4])


def test_windows_and_chains_hold_their_bounds(spark):
    draw = random.Random(2)
    rows, t = [], 0.0
    for i in range(200):
        t += draw.random() * 4
        rows.append(("r", i, "a", t, t + draw.random() * 8, ""))
    s = spark.createDataFrame(rows, "recording string, seg_id long, speaker string, start double, end double, text string")
    windows = L.greedy_windows(s, 30, 5).groupBy("window").agg(F.count(F.lit(1)).alias("n"), (F.max("end") - F.min("start")).alias("d")).collect()
    assert sum(w["n"] for w in windows) == 200 and all(w["n"] <= 5 and (w["d"] <= 30 or w["n"] == 1) for w in windows)
    chains = L.chains(s, 3.0, 60.0, 10.0, hashing.hash_u("s", "seg_id") < 0.1).collect()
    ids = [i for c in chains for i in c["ids"]]
    assert chains and len(ids) == len(set(ids)) and all(10 <= c["duration"] <= 60 for c in chains)


def test_word_errors():
    assert E.word_errors("a b c d".split(), "a x c".split()) == (0, 1, 1)
    assert E.word_errors([], ["a"]) == (1, 0, 0) and E.word_errors(["a"], []) == (0, 1, 0)

    def cost(a, b):
        if not a or not b:
            return len(a) + len(b)
        return min(cost(a[1:], b[1:]) + (a[0] != b[0]), cost(a[1:], b) + 1, cost(a, b[1:]) + 1)

    draw = random.Random(3)
    for _ in range(60):
        a, b = ([draw.choice("xyz") for _ in range(draw.randint(0, 6))] for _ in range(2))
        assert sum(E.word_errors(a, b)) == cost(a, b)


def filled_by_rounds(shares, sizes, limit):
    """Shares held at limit times their size, the rest dealt to the others, round after round; None if all are held."""
    held = set()
    while True:
        free = [k for k in range(len(shares)) if k not in held]
        if not free:
            return None
        left = (1 - sum(limit * sizes[k] for k in held)) / sum(shares[k] for k in free)
        over = [k for k in free if left * shares[k] > limit * sizes[k] * (1 + 1e-12)]
        if not over:
            return [limit * sizes[k] if k in held else left * shares[k] for k in range(len(shares))]
        held |= set(over)


def test_caps(spark):
    draw = random.Random(11)
    rows = []
    for task in range(6):
        sizes = [draw.choice([1, 5, 5, 40, 300, 2000]) for _ in range(draw.randrange(1, 9))]
        raw = [draw.choice([1.0, 1.0, 3.0]) * n**0.5 for n in sizes]
        rows += [(f"t{task}", "l", f"d{k}", n, w / sum(raw), 1.0, (task + 1) / 21) for k, (n, w) in enumerate(zip(sizes, raw))]
    df = spark.createDataFrame(rows, "task string, lang string, dataset string, size long, dataset_w double, lang_w double, task_w double")
    total = sum(r[3] for r in rows)
    for cap in (0.4, 1.05, 3.0):
        got = {(r["task"], r["dataset"]): r["dataset_w"] for r in mixture.flat_capped(df, cap).collect()}
        for task in {r[0] for r in rows}:
            own = [r for r in rows if r[0] == task]
            want = filled_by_rounds([r[4] for r in own], [r[3] for r in own], cap / total / own[0][6]) or [1 / len(own)] * len(own)
            assert [got[task, r[2]] for r in own] == pytest.approx(want)
    leaves = mixture.leaves_capped(df.withColumn("p", F.col("dataset_w") * F.col("task_w")), 1.05)
    got = {(r["task"], r["dataset"]): r["p"] for r in leaves.collect()}
    want = filled_by_rounds([r[4] * r[6] for r in rows], [r[3] for r in rows], 1.05 / total)
    assert [got[r[0], r[2]] for r in rows] == pytest.approx(want) and sum(want) == pytest.approx(1)


TREE = [
    {"type": "group", "weight": 3, "tags": {"task": "asr"}, "input_cfg": [{"weight": 1, "manifest_filepath": "a", "tags": {"lang": "en"}}, {"manifest_filepath": "b"}]},
    {"type": "multimodal_conversation", "weight": 0, "manifest_filepath": "c"},
]


def test_tree(spark):
    nodes = mixture.tree_frame(spark, TREE)
    got = {r["manifest"]: (r["share"], r["task"], r["lang"]) for r in mixture.sibling_normalised(nodes).collect()}
    assert got == {"a": (0.375, "asr", "en"), "b": (0.375, "asr", None), "c": (0.25, None, None)}
    raw = {r["manifest"]: r["share"] for r in mixture.raw_products(nodes).collect()}
    assert raw == pytest.approx({"a": 3 / 7, "b": 3 / 7, "c": 1 / 7})
    flat = mixture.flattened_tree([{"type": "group", "weight": 0.6, "input_cfg": [{"manifest_filepath": "a"}, {"manifest_filepath": "b"}]}, {"manifest_filepath": "c"}])
    assert mixture.tree_leaf_shares(flat, {1: 4.0, 2: 16.0, 3: 1.0}) == pytest.approx({1: 0.2, 2: 0.4, 3: 0.4})


def test_turns(spark):
    words = [("don", None), ("'t", "left"), ("go", None), ("(", "right"), ("now", None), (")", "left")]
    kind = "array<struct<text:string,join:string>>"
    assert one(spark, words, T.detokenised, kind) == "don't go (now)"
    turns = [("Assistant", "audio", "w", 2.0, 0.0), ("User", None, "q", None, None), ("Assistant", "text", "a", None, None)]
    kind = "array<struct<from:string,type:string,value:string,duration:double,offset:double>>"
    assert one(spark, turns, lambda c: T.first_user_text(c), kind) is None and one(spark, turns, lambda c: T.first_user_text(c, "text"), kind) == "q"
    assert one(spark, [], T.last_assistant_text, kind) is None and one(spark, [], T.valid, kind) is False
    assert one(spark, [("User", "text", "q", None, None)], lambda c: T.asks_one_of(c, ["q"]), kind) is True
    rec = T.qa_record(spark.createDataFrame([("i", "q", "p", 1.0, "a")], "id string, q string, p string, d double, a string"), "id", "q1", "q", "p", "d", "a").first()
    assert rec["id"] == "i_q1" and [t["from"] for t in rec["conversations"]] == ["User", "User", "Assistant"]


WORDS = [("Hello", 0.0, 0.4), (",", -1.0, -1.0), ("big", 0.5, 0.7), ("world", 0.8, 1.2), (".", -1.0, -1.0), ("Bye", 2.0, 2.4), ("world", 2.45, 2.6)]


def test_word_times(spark):
    ask = lambda f: one(spark, WORDS, f, qa.WORDS)
    assert ask(lambda w: qa.occurrences(w, F.lit("World"))) == [0.8, 2.45]
    assert ask(lambda w: qa.phrase_occurrences(w, F.lit("big world"))) == [0.5]
    assert ask(lambda w: qa.phrase_end(w, F.lit(0.5), F.lit(2))) == 1.2
    assert ask(lambda w: qa.cased_answer(w, F.lit(0.5), F.lit(1.2), F.lit("BIG world"))) == "big world"
    assert ask(lambda w: qa.window_words(w, F.lit(0.0), F.lit(1.0))) == "Hello, big"
    assert [(s["text"], s["start"], s["end"], s["n"]) for s in ask(qa.sentences)] == [("Hello, big world.", 0.0, 1.2, 3), ("Bye world", 2.0, 2.6, 2)]
    assert ask(lambda w: qa.sentence_at(qa.sentences(w), F.lit(1.9)))["text"] == "Bye world"
    assert ask(lambda w: qa.trailing_gap(w, F.lit(3.0))) == pytest.approx(0.4) and ask(qa.longest_pause) == pytest.approx(0.8)
    assert ask(qa.content_words) == ["hello"] and len(ask(lambda w: qa.unambiguous(w, 0.46))) == 1
    assert one(spark, [], qa.longest_pause, qa.WORDS) is None and one(spark, [], qa.sentences, qa.WORDS) == []
    units = lambda w: qa.sentences(w)
    for name in (*qa.FORMATS, "json"):
        assert ask(lambda w, n=name: qa.rendered(units(w), n))
    z = spark.createDataFrame([(["a", "b"], [0.0], [1.0, 2.0])], "w array<string>, s array<double>, e array<double>")
    assert z.select(F.size(qa.zipped(F.col("w"), F.col("s"), F.col("e"))).alias("n")).first()["n"] == 1


def test_lexicon(spark):
    docs = spark.createDataFrame([(1, "Hello Paris. We met Jean Marie of Lyon in Paris! The the IBM IBM"), (2, None), (3, "")], "doc_id long, text string")
    t = lexicon.token_table(docs)
    assert [r["surface"] for r in t.where("starts").orderBy("pos").collect()] == ["Hello", "We", "The"]
    words = {r["key"]: r for r in lexicon.ranked(lexicon.classified(lexicon.scanned(t))).collect()}
    assert words["ibm"]["is_acronym"] and words["paris"]["is_proper"] and not words["the"]["is_proper"] and words["ibm"]["rank"] == 0
    assert [r["phrase"] for r in lexicon.entity_runs(t, ["of"]).collect()] == ["Jean Marie of Lyon"]
    assert lexicon.cutoff(spark.createDataFrame([(k,) for k in range(10)], "max_rank long"), 0.3) == 3


def test_draws(spark):
    u = hashing.hash_u("s", "id")
    rows = spark.range(4000).select(u.alias("u"), hashing.weighted_pick([("a", 1), ("b", 3)], u).alias("w"), *(hashing.list_size(k, u, 2, 9).alias(k) for k in ("loguniform", "uniform", "exponential", "geometric")), hashing.decaying_count(u, 0.5, 1, 4).alias("c")).collect()
    assert all(0 <= r["u"] < 1 and all(2 <= r[k] <= 9 for k in ("loguniform", "uniform", "exponential", "geometric")) and 1 <= r["c"] <= 4 for r in rows)
    assert abs(sum(r["w"] == "b" for r in rows) / 4000 - 0.75) < 0.03
    assert sum(w for _, w in hashing.truncated_geometric(0.4, 1, 5)) == pytest.approx(1)
    with pytest.raises(ValueError):
        hashing.list_size("odd", u, 1, 2)


def test_text_functions(spark):
    assert one(spark, ["a", "b", "c"], text.oxford, "array<string>") == "a, b, and c" and one(spark, [], text.oxford, "array<string>") == ""
    assert one(spark, ["a", "b", "c"], lambda a: text.ngrams(a, 2), "array<string>") == ["a b", "b c"] and one(spark, ["a"], lambda a: text.ngrams(a, 2), "array<string>") == []
    assert one(spark, 93784.0, text.duration_text, "double") == "1d 02h 03m 04s" and one(spark, 3661.5, text.clock, "double") == "01:01:01.500"
    assert one(spark, 1234.0, text.short_number, "double") == "1.2K"


def test_synthesis(spark):
    from corvox.operators import export, synthesis as S

    qas = [("a?", "x"), ("Bee?", "y"), ("C?", "z")]
    kind = "array<struct<question:string,answer:string>>"
    assert [t["value"] for t in one(spark, qas, S.sequential, kind)] == ["a?", "x", "Bee?", "y", "C?", "z"]
    assert [t["value"] for t in one(spark, qas, S.compound, kind)] == ["a? And bee? And c?", "X Y Z"]
    assert [t["value"] for t in one(spark, qas, S.hybrid, kind)] == ["a? And bee?", "X Y", "C?", "z"]
    items = spark.createDataFrame([(g, i) for g in range(3) for i in range(11)], "g long, i long")
    cut = S.disjoint_chunks(items, "g", F.col("i"), "s", [(2, 0.5), (3, 0.5)]).collect()
    assert len(cut) == 33 and all(r["place"] < 3 for r in cut)
    pool = spark.createDataFrame([(1, "a", True, None, "q1", "x"), (1, "a", True, None, "q2", "y"), (1, "b", False, "a", "q3", "z"), (1, "c", False, "none", "q4", "w")], "item long, name string, opener boolean, needs string, question string, answer string")
    assert [r["name"] for r in S.selected_tasks(pool, "item", 5, "s").orderBy("place").collect()] == ["a", "b"]
    steps = S.walks(spark.range(5).select(F.lit(1).alias("r"), F.col("id").alias("k")), "r", "k", "s", 0.3, 5).collect()
    assert all(r["start"] - r["left"] >= 0 and r["start"] + r["right"] <= 4 for r in steps)
    talks = S.random_conversations(spark.range(50).select("id", F.lit("en").alias("lang"), F.lit(10.0).alias("duration")), spark.range(30).select(F.col("id").alias("out_id"), F.lit("en").alias("lang")), "s", 0.3, 6, 35.0).collect()
    assert talks and max(sum(1 for t in talks if t["out_id"] == k) for k in range(30)) <= 3
    assert "fisik" not in S.respellings("Phone") and "Fone" in S.respellings("Phone") and S.respellings("cat", {"cat": ["kat"]}) == ["kat"]
    assert S.perturbed("New York and york", {"new york": "nu york", "york": "yorck"}) == "Nu york and yorck" and S.perturbed("a", {}) == "a"
    assert export.resolved_env("${oc.env:A,b}/${oc.env:C}", {"C": "d"}) == "b/d"
    assert one(spark, "x/data/My Set/fr/manifest.json.gz", export.config_name) == "fr_manifest"
    assert one(spark, "Woman", export.normalised_gender) == "female" and one(spark, None, export.normalised_gender) is None


def test_word_errors_against_a_table():
    import random

    draw = random.Random(1)
    for _ in range(200):
        r, h = ([draw.choice("abc") for _ in range(draw.randint(0, 8))] for _ in range(2))
        row = [(j, j) for j in range(len(h) + 1)]
        for x in r:
            new = [(row[0][0] + 1, 0)]
            for j, y in enumerate(h):
                new.append(min((row[j][0] + (x != y), row[j][1]), (row[j + 1][0] + 1, row[j + 1][1]), (new[j][0] + 1, new[j][1] + 1)))
            row = new
        cost, ins = row[-1]
        gone = ins + len(r) - len(h)
        assert E.word_errors(r, h) == (ins, gone, cost - ins - gone)
