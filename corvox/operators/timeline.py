"""Intervals on recordings: gaps, islands, overlaps, windows, splits, chains."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TAG, spoken_word_count
from . import french
from .ranking import handed_on, running_total

ORDER = ["start", "end", "seg_id"]


#: Seconds of a time bin in which a recording's rows are ordered together.
BIN = 3600.0


#: Rows of a recording that are ordered together; where all rows are fewer, recordings aren't cut at all.
TOGETHER = 1_000_000


def cut_width(segments: DataFrame) -> float | None:
    """Seconds in which one recording would have TOGETHER rows, if it had all; None if there are no more rows than that."""
    n, low, high = segments.agg(F.count("*"), F.min("start"), F.max("start")).first()
    return None if n <= TOGETHER else max((high - low) * TOGETHER / n, 1e-6)


def _before(segments: DataFrame, width: float | None, **wanted: tuple[str, Column]) -> DataFrame:
    """segments with running values over those before them in their recording, in time bins of a width (see handed_on)."""
    return handed_on(segments, ["recording"], ORDER, None if width is None else F.floor(F.col("start") / width), **wanted)


def gaps(segments: DataFrame, least: float, most: float) -> DataFrame:
    """Gaps between the union of a recording's segments, with the segment before and the one behind.

    The segment before is the latest row that reaches the running end; the size is in [least, most].
    """
    out = _before(segments, cut_width(segments), __last=("max", F.struct("end", "start", "seg_id"))).where(F.col("__last").isNotNull())
    gap = F.col("start") - F.col("__last.end")
    return out.where((gap >= least) & (gap <= most)).select(
        "recording", F.col("__last.end").alias("gap_start"), F.col("start").alias("gap_end"), gap.alias("gap"), F.col("__last.seg_id").alias("previous_id"), F.col("seg_id").alias("next_id")
    )


def runs(segments: DataFrame, gap: float | None, same_speaker: bool = True) -> DataFrame:
    """segments with `island`: it rises where the speaker changes or the pause since all before in the run is above gap."""
    names, width = segments.columns, cut_width(segments)
    before = _before(segments, width, __start=("last", F.col("start")), __speaker=("last", F.col("speaker")))
    first = F.col("__start").isNull()
    change = first | F.coalesce(F.col("__speaker") != F.col("speaker"), F.lit(True)) if same_speaker else first
    run = _before(before.withColumn("__change", change.cast("int")), width, __run=("sum", F.col("__change"))).withColumn("__run", F.col("__run") + F.col("__change"))
    if gap is None:
        return run.select(*names, F.col("__run").alias("island"))
    last = _before(run, width, __last=("max", F.struct(F.col("__run").alias("run"), F.col("end").alias("end"))))
    inside = F.col("__last.run") == F.col("__run")
    new = F.when(F.coalesce(inside, F.lit(False)), (F.col("start") - F.col("__last.end") > gap).cast("int")).otherwise(1)
    out = _before(last.withColumn("__new", new), width, __island=("sum", F.col("__new")))
    return out.select(*names, (F.col("__island") + F.col("__new")).alias("island"))


def merge_same_speaker(segments: DataFrame, gap: float | None) -> DataFrame:
    """Neighbouring segments of one speaker, joined while the pause is at most gap; texts in order."""
    return (
        runs(segments, gap)
        .groupBy("recording", "island", "speaker")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.count(F.lit(1)).alias("n_segments"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*ORDER, "text"))), lambda s: s["text"]), " ").alias("text"),
        )
    )


def neighbour_runs(segments: DataFrame, gap: float, least: int = 2) -> DataFrame:
    """Islands of segments with pauses under gap, of at least `least` segments."""
    width = cut_width(segments)
    before = _before(segments, width, __end=("last", F.col("end")))
    new = F.coalesce(F.col("start") - F.col("__end") >= gap, F.lit(True)).cast("int")
    out = _before(before.withColumn("__new", new), width, run=("sum", F.col("__new"))).withColumn("run", F.col("run") + F.col("__new"))
    return out.groupBy("recording", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_segments")).where(F.col("n_segments") >= least)


def binned(df: DataFrame, start: str, end: str, width: float, out: str = "bin") -> DataFrame:
    """A row for each time bin that an interval touches: the key of a range join on long recordings."""
    return df.withColumn(out, F.explode(F.sequence(F.floor(F.col(start) / width), F.greatest(F.floor(F.col(start) / width), F.floor(F.col(end) / width)))))


def overlaps(a: DataFrame, b: DataFrame, width: float) -> DataFrame:
    """Pairs of a and b of one recording that overlap by more than nothing, once each, with `overlap`.

    Both sides are dealt to bins of `width` seconds; a pair is counted in the bin where it begins to overlap, so no
    recording, however long, has all its pairs tried.
    """
    left = binned(a.select("recording", F.col("seg_id").alias("a_id"), F.col("speaker").alias("a_speaker"), F.col("start").alias("a_start"), F.col("end").alias("a_end")), "a_start", "a_end", width)
    right = binned(b.select("recording", F.col("seg_id").alias("b_id"), F.col("speaker").alias("b_speaker"), F.col("start").alias("b_start"), F.col("end").alias("b_end")), "b_start", "b_end", width)
    both = left.join(right, ["recording", "bin"]).where((F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end")))
    both = both.where(F.col("bin") == F.floor(F.greatest("a_start", "b_start") / width))
    return both.withColumn("overlap", F.least("a_end", "b_end") - F.greatest("a_start", "b_start")).drop("bin")


def other_speech(segments: DataFrame, width: float) -> DataFrame:
    """segments with `other`: how long others speak during them, overlaps of several others counted each."""
    pairs = overlaps(segments, segments, width).where("a_speaker <> b_speaker")
    spoken = pairs.groupBy("recording", F.col("a_id").alias("seg_id")).agg(F.sum("overlap").alias("other"))
    return segments.join(spoken, ["recording", "seg_id"], "left").withColumn("other", F.coalesce("other", F.lit(0.0)))


def best_overlap(spans: DataFrame, topics: DataFrame, width: float) -> DataFrame:
    """(recording, span id, topic id, overlap): each span's topic with the largest overlap, the first one on ties."""
    pairs = overlaps(spans, topics, width)
    best = F.min(F.struct(-F.col("overlap"), F.col("b_start"), F.col("b_id")))
    return pairs.groupBy("recording", F.col("a_id").alias("seg_id")).agg(best.alias("__b")).select("recording", "seg_id", F.col("__b.b_id").alias("topic_id"), (-F.col("__b.col1")).alias("overlap"))


def contained(cues: DataFrame, windows: DataFrame, width: float, eps: float = 0.0) -> DataFrame:
    """Pairs of a window and a cue that lies in it, both ends within eps."""
    w = binned(windows.select("recording", F.col("seg_id").alias("window_id"), F.col("start").alias("w_start"), F.col("end").alias("w_end")).withColumn("__s", F.col("w_start") - eps), "__s", "w_end", width)
    c = cues.select("recording", F.col("seg_id").alias("cue_id"), F.col("start").alias("c_start"), F.col("end").alias("c_end"), "text").withColumn("bin", F.floor(F.col("c_start") / width))
    return w.join(c, ["recording", "bin"]).where((F.col("c_start") >= F.col("w_start") - eps) & (F.col("c_end") <= F.col("w_end") + eps)).drop("bin", "__s")


def window_text(pairs: DataFrame) -> DataFrame:
    """(recording, window_id, n_cues, text): the texts of a window's cues, in their order."""
    return pairs.groupBy("recording", "window_id").agg(
        F.count(F.lit(1)).alias("n_cues"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_start", "c_end", "cue_id", "text"))), lambda s: s["text"]), " ").alias("text")
    )


def nearest_within(points: DataFrame, cues: DataFrame, steps: list[float]) -> DataFrame:
    """Each point's cue at the same time, else the nearest within the tolerances, tried in order."""
    most = max(steps)
    width = max(most * 4, 1.0)
    p = points.select("recording", "point_id", "at").withColumn("bin", F.explode(F.array_distinct(F.array(F.floor((F.col("at") - most) / width), F.floor((F.col("at") + most) / width)))))
    c = cues.select("recording", F.col("seg_id").alias("cue_id"), F.col("start").alias("c_start")).withColumn("bin", F.floor(F.col("c_start") / width))
    near = p.join(c, ["recording", "bin"]).withColumn("off", F.abs(F.col("at") - F.col("c_start"))).where(F.col("off") <= most)
    step = F.coalesce(*(F.when(F.col("off") <= s, F.lit(k)) for k, s in enumerate(steps)))
    return near.groupBy("recording", "point_id").agg(F.min(F.struct(step.alias("step"), "off", "c_start", "cue_id")).alias("__b")).select("recording", "point_id", F.col("__b.cue_id").alias("cue_id"), F.col("__b.step").alias("step"))


def relabelled(pieces: DataFrame, window: str) -> DataFrame:
    """Speakers numbered from 1 by first appearance in their window, times from the window's start, two decimals half to even."""
    inside = Window.partitionBy("recording", window)
    first = F.min(F.struct(*ORDER)).over(Window.partitionBy("recording", window, "speaker"))
    begin = F.min("start").over(inside)
    out = pieces.withColumn("__first", first).withColumn("rel_start", F.bround(F.col("start") - begin, 2)).withColumn("rel_end", F.bround(F.col("end") - begin, 2))
    return out.withColumn("speaker_no", F.dense_rank().over(inside.orderBy("__first"))).drop("__first")


def parent_windows(segments: DataFrame) -> DataFrame:
    """(recording, parent, start, end, pieces) of the segments that were cut, from their pieces, whose ids end in _cutNN."""
    parent = F.regexp_extract("seg_id", r"^(.*)_cut\d+$", 1)
    return segments.withColumn("parent", parent).where("parent <> ''").groupBy("recording", "parent").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("pieces"))


def deduplicated_windows(windows: DataFrame) -> DataFrame:
    """One row for each (recording, start, end) at three decimals: the one with the lowest id."""
    rank = Window.partitionBy("recording", F.bround("start", 3), F.bround("end", 3)).orderBy("seg_id")
    return windows.withColumn("__rn", F.row_number().over(rank)).where("__rn = 1").drop("__rn")


def stretches(rows: DataFrame, breaks: str, gap: float) -> DataFrame:
    """rows with `__bin` and `__run`: numbers of stretches of a recording that no window or chain can reach across.

    breaks "start": a row begins a run if it ends more than `gap` after the start of the row before it; "end": if it
    starts more than `gap` after the end of all rows before it. Rows are ordered in time bins; what a bin hands on to the
    next one is found on a table of a row for each bin. So a long recording is spread over tasks.
    """
    binned_rows = rows.withColumn("__bin", F.floor(F.col("start") / BIN))
    own = F.max("start") if breaks == "start" else F.max("end")
    along = Window.partitionBy("recording").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    handed = binned_rows.groupBy("recording", "__bin").agg(own.alias("__last")).select("recording", "__bin", F.max("__last").over(along).alias("__handed"))
    inside = Window.partitionBy("recording", "__bin").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    before = F.greatest(F.max("start" if breaks == "start" else "end").over(inside), F.col("__handed"))
    new = F.when(before.isNull() | ((F.col("end") if breaks == "start" else F.col("start")) - before > gap), 1).otherwise(0)
    marked = binned_rows.join(handed, ["recording", "__bin"]).withColumn("__new", new)
    out = running_total(marked, ["recording"], F.col("__bin"), ORDER, F.col("__new"), "__run")
    return out.withColumn("__run", F.col("__run") + F.col("__new")).drop("__handed", "__new")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _by_run(rows: DataFrame) -> DataFrame:
    """The rows of each run of a recording one after the other, in order, in one partition: for folds of constant memory."""
    return rows.repartition("recording", "__run").sortWithinPartitions("recording", "__run", *ORDER)


def greedy_windows(units: DataFrame, max_dur: float, max_turns: int) -> DataFrame:
    """units with `window`: a unit joins the open window if it ends within max_dur of its start and there is room.

    A fold over the rows of each run of a recording (see stretches), which holds one window's beginning and size: a unit
    that ends more than max_dur after the start of the one before it begins a window whatever went before. Windows are
    then numbered along the recording.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, begin, n = None, 0.0, 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("recording", "__run", "start", "end")]
            first = []
            for rec, run, s, e in zip(*columns):
                opens = (rec, run) != key or e - begin > max_dur or n >= max_turns
                if opens:
                    key, begin, n = (rec, run), s, 0
                n += 1
                first.append(opens)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.bool_()).cast(pa.int32())], [*batch.schema.names, "__first"])

    cut = stretches(units, "start", max_dur)
    folded = _by_run(cut).mapInArrow(fold, _ddl(cut) + ", __first int")
    out = running_total(folded, ["recording"], F.col("__bin"), ORDER, F.col("__first"), "window")
    return out.withColumn("window", (F.col("window") + F.col("__first")).cast("long")).select(*units.columns, "window")


def split_at_pauses(words: list[tuple[float, float]], longest: float, least: float = 1.0) -> list[tuple[float, float]]:
    """The pieces of a segment of timed words: cut in the middle of the largest pause while longer than `longest`."""
    start, end = words[0][0], words[-1][1]

    def cut(ws: list[tuple[float, float]], s: float, e: float) -> list[tuple[float, float]]:
        if e - s <= longest:
            return [(s, e)]
        best = None
        for k in range(len(ws) - 1):
            middle = (ws[k][1] + ws[k + 1][0]) / 2
            pause = ws[k + 1][0] - ws[k][1]
            if middle - s >= least and e - middle >= least and (best is None or pause > best[0]):
                best = (pause, middle, k)
        if best is None:
            return [(s, e)]
        return cut(ws[: best[2] + 1], s, best[1]) + cut(ws[best[2] + 1 :], best[1], e)

    return cut(words, start, end)


def split_long_turns(words: list[tuple[float, float, str]], max_dur: float) -> list[tuple[float, float, str]]:
    """Greedy pieces of a turn: a word that ends more than max_dur after the piece's start begins the next."""
    pieces: list[list] = []
    for s, e, text in words:
        if not pieces or e - pieces[-1][0] > max_dur:
            pieces.append([s, e, [text]])
        else:
            pieces[-1][1] = max(pieces[-1][1], e)
            pieces[-1][2].append(text)
    return [(s, e, " ".join(t)) for s, e, t in pieces]


def pieces(turns: DataFrame, max_dur: float, at_pauses: bool = False) -> DataFrame:
    """(recording, seg_id, piece, start, end) of turns(recording, seg_id, words array<struct<start,end,text>>)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec, seg, words in zip(pdf["recording"], pdf["seg_id"], pdf["words"]):
                timed = [(w["start"], w["end"], w["text"]) for w in words if w["start"] is not None and w["start"] >= 0]
                if timed:
                    own = split_at_pauses([w[:2] for w in timed], max_dur) if at_pauses else [p[:2] for p in split_long_turns(timed, max_dur)]
                    out += [(rec, seg, k, float(s), float(e)) for k, (s, e) in enumerate(own)]
            yield pd.DataFrame(out, columns=["recording", "seg_id", "piece", "start", "end"])

    kind = {f.name: f.dataType.simpleString() for f in turns.schema.fields}
    return turns.mapInPandas(run, f"recording {kind['recording']}, seg_id {kind['seg_id']}, piece long, start double, end double")


def split_turns(turns: DataFrame, max_dur: float) -> DataFrame:
    """(recording, seg_id, piece, speaker, start, end, text) of turns with start, end, text and words: none over max_dur.

    A turn that isn't too long stays as it is; a longer one is cut before the words that end too late (split_long_turns),
    and one without timed words by time, with its text in the first piece.
    """

    def cut(start: float, end: float, text: str, words: list) -> list[tuple[float, float, str]]:
        if end - start <= max_dur:
            return [(start, end, text)]
        timed = [(w["start"], w["end"], w["text"]) for w in words if w["start"] is not None and w["end"] is not None and w["text"]]
        if timed:
            return split_long_turns(timed, max_dur)
        starts = [start]
        while starts[-1] + max_dur < end:
            starts.append(starts[-1] + max_dur)
        return [(s, min(s + max_dur, end), "" if k else text) for k, s in enumerate(starts)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec, seg, who, start, end, text, words in zip(*(pdf[c] for c in ("recording", "seg_id", "speaker", "start", "end", "text", "words"))):
                own = cut(float(start), float(end), text or "", [] if words is None else list(words))
                out += [(rec, seg, k, who, float(s), float(e), t) for k, (s, e, t) in enumerate(own)]
            yield pd.DataFrame(out, columns=["recording", "seg_id", "piece", "speaker", "start", "end", "text"])

    kind = {f.name: f.dataType.simpleString() for f in turns.schema.fields}
    return turns.mapInPandas(run, f"recording {kind['recording']}, seg_id {kind['seg_id']}, piece long, speaker {kind['speaker']}, start double, end double, text string")


def turn_windows(turns: DataFrame, max_dur: float, max_turns: int) -> DataFrame:
    """The pieces of turns (see split_turns) with `window` (see greedy_windows)."""
    return greedy_windows(split_turns(turns, max_dur), max_dur, max_turns)


def chains(segments: DataFrame, gap: float, longest: float, enough: float, stop: Column, stop_single: Column | None = None) -> DataFrame:
    """Chains of neighbouring segments while the pause is at most gap and the speech at most `longest`.

    Once a chain has `enough` speech it ends where the row's `stop`, a reproducible draw, is true; while it is a single
    segment, `stop_single` decides, a rarer draw, if it is given. Chains with speech
    in [enough, longest] stay, as (recording, chain, start, end, duration, ids). A fold over each run of a recording: a
    segment that starts more than gap after all before it begins a chain whatever went before.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["recording", "start", "end", "duration", "ids", "run", "place"]
        key, place, open_ = None, 0, None
        done: list[tuple] = []

        def close() -> None:
            nonlocal open_, place
            if open_ and enough <= open_[2] <= longest:
                done.append((key[0], open_[0], open_[1], open_[2], open_[3], key[1], place))
            place += open_ is not None
            open_ = None

        types = None
        for batch in batches:
            at = {c: batch.schema.get_field_index(c) for c in ("recording", "__run", "seg_id", "start", "end", "__stop", "__alone")}
            types = [batch.schema.field(at["recording"]).type, *[pa.float64()] * 3, pa.list_(batch.schema.field(at["seg_id"]).type), pa.int64(), pa.int64()]
            for rec, run, i, s, e, halt, alone in zip(*(batch.column(k).to_pylist() for k in at.values())):
                if (rec, run) != key:
                    close()
                    key, place = (rec, run), 0
                if open_ and (s - open_[1] > gap or open_[2] + e - s > longest):
                    close()
                if open_ is None:
                    open_ = [s, e, 0.0, []]
                open_[1] = max(open_[1], e)
                open_[2] += e - s
                open_[3].append(i)
                if open_[2] >= enough and (halt if len(open_[3]) > 1 else alone):
                    close()
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(types)], names)
            done.clear()
        close()
        if types:
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(types)], names)

    kind = {f.name: f.dataType.simpleString() for f in segments.schema.fields}
    ddl = f"recording {kind['recording']}, start double, end double, duration double, ids array<{kind['seg_id']}>, run long, place long"
    cut = stretches(segments.withColumn("__stop", stop).withColumn("__alone", stop if stop_single is None else stop_single), "end", gap)
    found = _by_run(cut.withColumns({c: F.col(c).cast("double") for c in ("start", "end")})).mapInArrow(fold, ddl)
    out = running_total(found, ["recording"], F.floor(F.col("start") / BIN), ["run", "place"], None, "chain")
    return out.select("recording", F.col("chain").cast("long").alias("chain"), "start", "end", "duration", "ids")


def sentence_follows(cues: DataFrame, common: list[str], nocasepunc: int | None = None) -> DataFrame:
    """cues(recording, seg_id, start, end, text) with a period where the next cue of the recording starts a sentence.

    The next cue starts one if its first word is a common one, or one that can't end a sentence, with a capital and not
    in capitals throughout. The period goes before tags at the end. A cue stays if it ends in a mark, holds no capital,
    ends in a word that can't end a sentence, or has no mark at all in `nocasepunc` words or more.
    """
    known = F.lit("|" + "|".join(sorted({w.lower() for w in common} | french.NO_END)) + "|")
    listed = lambda w: F.contains(known, F.concat(F.lit("|"), w, F.lit("|"))) & (w != "")
    verbs = F.lit("|" + "|".join(sorted({w.lower() for w in common})) + "|")
    after = F.regexp_extract(F.col("next_text"), r"^\s*(\S+)", 1)
    said = french.plain_column(after)
    verb = F.regexp_replace(said, "(-t)?-(" + "|".join(sorted(french.INVERTED)) + ")$", "")
    starts = after.rlike(r"^\p{Lu}") & (after != F.upper(after)) & (listed(said) | (F.contains(verbs, F.concat(F.lit("|"), verb, F.lit("|"))) & (verb != "")))
    body = F.rtrim(F.regexp_replace("text", rf"((?:\s*{TAG})*)\s*$", ""))
    tail = F.regexp_extract("text", rf"((?:\s*{TAG})*)\s*$", 1)
    untagged = F.regexp_replace("text", TAG, " ")
    last = french.plain_column(F.regexp_extract(body, r"(\S+)$", 1))
    ends = F.concat(F.lit("|"), F.lit("|".join(sorted(french.NO_END))), F.lit("|"))
    open_ = (body != "") & ~body.rlike(r"""[.?!…,;:"»”)'-]$""") & untagged.rlike(r"\p{Lu}") & ~F.contains(ends, F.concat(F.lit("|"), last, F.lit("|")))
    if nocasepunc:
        open_ &= untagged.rlike("[.,;:!?…]") | (spoken_word_count(F.col("text")) < nocasepunc)
    followed = _before(cues, cut_width(cues), next_text=("next", F.col("text")))
    return followed.withColumn("text", F.when(F.coalesce(starts & open_, F.lit(False)), F.concat(body, F.lit("."), tail)).otherwise(F.col("text"))).drop("next_text")


def silence_lines(found: DataFrame, most: float, seed: str) -> DataFrame:
    """A kind for each gap: alone (trimmed by 0.1 s), after, before or between, by a reproducible order of the feasible ones."""
    from ..functions.hashing import hash_u

    span = {"alone": F.col("gap") - 0.2, "after": F.col("gap") + F.col("previous_dur"), "before": F.col("gap") + F.col("next_dur"), "between": F.col("gap") + F.col("previous_dur") + F.col("next_dur")}
    ranked = F.array_sort(F.array(*(F.struct(hash_u(seed + k, "recording", "gap_start").alias("u"), F.lit(k).alias("kind"), v.alias("total")) for k, v in span.items())))
    first = F.get(F.filter(ranked, lambda s: (s["total"] > 0) & (s["total"] <= most)), F.lit(0))
    return found.withColumn("kind", first["kind"]).withColumn("total", first["total"]).where("kind is not null")
