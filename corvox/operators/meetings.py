"""Rows of annotated meetings: references by document order become ordinal intervals, then times, pieces and texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timeline import binned

#: Suffixes that annotators cut off their words; they join the word before them. Fixed values.
CONTRACTIONS = ("'s", "'m", "'re", "'ve", "'ll", "'d", "n't")
#: A word of a segment, as the functions below collect it.
WORD = "struct<child:long,pos:long,text:string,start:double,end:double,join:string,lex:boolean>"


def resolved(ranges: DataFrame, words: DataFrame) -> DataFrame:
    """ranges(meeting, file, first_word, last_word, ...) with lo and hi, the places of these words in their file.

    words(meeting, file, id, pos, ...) number the words of each file in document order. A range whose first word isn't
    in its file is left out; one whose last word is null or unknown has its first word alone.
    """
    at = words.select("meeting", "file", "id", "pos")
    first = at.select("meeting", "file", F.col("id").alias("first_word"), F.col("pos").alias("lo"))
    last = at.select("meeting", "file", F.col("id").alias("last_word"), F.col("pos").alias("hi"))
    both = ranges.join(first, ["meeting", "file", "first_word"]).join(last, ["meeting", "file", "last_word"], "left")
    return both.withColumn("hi", F.coalesce("hi", "lo"))


def range_words(ranges: DataFrame, words: DataFrame) -> DataFrame:
    """A row for each range and word in it: the columns of `resolved` ranges, and the word's.

    Each range is spelled out as places, as many as it has words, and these meet the words by equality; so no file's
    ranges and words are all compared, and a long meeting is spread by place.
    """
    spelled = resolved(ranges, words).where("lo <= hi").withColumn("pos", F.explode(F.sequence("lo", "hi")))
    return spelled.join(words, ["meeting", "file", "pos"])


def spans(ranges: DataFrame, words: DataFrame) -> DataFrame:
    """(meeting, owner, start, end) from the first start to the last end of the words of all ranges of an owner."""
    own = range_words(ranges, words.select("meeting", "file", "id", "pos", "start", "end"))
    return own.groupBy("meeting", "owner").agg(F.min("start").alias("start"), F.max("end").alias("end")).where("start is not null and end is not null")


def linked_spans(links: DataFrame, acts: DataFrame, words: DataFrame) -> DataFrame:
    """(meeting, sentence, start, end) over the acts that links(meeting, sentence, act) give a sentence; acts are ranges."""
    own = spans(acts, words).select("meeting", F.col("owner").alias("act"), "start", "end")
    return links.join(own, ["meeting", "act"]).groupBy("meeting", "sentence").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def channel(agent: Column, known: Column) -> Column:
    """The headset channel of a speaker: the known one, else by the letter, A for 0."""
    return F.coalesce(known, F.ascii(F.upper(agent)) - 65)


def meeting_text(words: Column) -> Column:
    """The text of words (text, join, lex): joined as they say, contractions to the word before, repeated markers once.

    A marker is no word and begins with <; one that equals all that was put together since the last space is left out.
    """
    begin = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("last"), F.lit(False).alias("glue"))
    full = F.filter(words, lambda w: F.coalesce(w["text"], F.lit("")) != "")

    def add(acc: Column, w: Column) -> Column:
        some = acc["last"] != ""
        again = some & ~F.coalesce(w["lex"], F.lit(False)) & w["text"].startswith("<") & (w["text"] == acc["last"])
        joins = some & (acc["glue"] | F.coalesce(w["join"].isin("left", "both"), F.lit(False)) | F.lower(w["text"]).isin(*CONTRACTIONS))
        done = F.when(joins | ~some, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["last"])))
        last = F.when(joins, F.concat(acc["last"], w["text"])).otherwise(w["text"])
        now = F.struct(done.alias("done"), last.alias("last"), F.coalesce(w["join"].isin("right", "both"), F.lit(False)).alias("glue"))
        return F.when(again, acc).otherwise(now)

    return F.aggregate(full, begin, add, lambda acc: F.trim(F.array_join(F.concat(acc["done"], F.array(acc["last"])), " ")))


def cuts(starts: list, ends: list, start: float, end: float, longest: float, least: float) -> list[tuple[float, float, int, int]]:
    """(start, end, first, behind) of the pieces of a segment, in order; first and behind number its words.

    A piece longer than `longest` is cut in the middle of its longest pause between neighbouring timed words, the
    first of equals, that leaves `least` seconds on either side; one that can't be cut stays.
    """
    timed = [k for k, (a, b) in enumerate(zip(starts, ends)) if a is not None and b is not None]
    pauses = [(starts[k] - ends[j], (ends[j] + starts[k]) / 2, k) for j, k in zip(timed, timed[1:])]
    todo, out = [(start, end, 0, len(starts))], []
    while todo:
        a, b, first, behind = todo.pop()
        inner = [(p, -k, at) for p, at, k in pauses if first < k < behind and at - a >= least and b - at >= least and any(first <= j < k for j in timed)] if b - a > longest else []
        if inner:
            _, k, at = max(inner)
            todo += [(at, b, -k, behind), (a, at, first, -k)]
        else:
            out.append((a, b, first, behind))
    return out


def split_long(segments: DataFrame, longest: float, least: float = 1.0) -> DataFrame:
    """segments(..., start, end, words) in pieces: piece, n_pieces, start, end, and the words of each piece.

    Only segments longer than `longest` go through Python, one at a time; the others stay in the JVM.
    """
    kind = "array<struct<start:double,end:double,first:int,behind:int>>"
    whole = F.array(F.struct("start", "end", F.lit(0).alias("first"), F.size("words").alias("behind"))).cast(kind)
    short = segments.where(F.col("end") - F.col("start") <= longest).withColumn("__pieces", whole)
    long = segments.where(F.col("end") - F.col("start") > longest)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in long.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        type_ = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64()), ("first", pa.int32()), ("behind", pa.int32())]))
        for batch in batches:
            at = {n: k for k, n in enumerate(batch.schema.names)}
            rows = zip(*(batch.column(at[c]) for c in ("words", "start", "end")))
            told = []
            for words, a, b in rows:
                own = words.as_py()
                found = cuts([w["start"] for w in own], [w["end"] for w in own], a.as_py(), b.as_py(), longest, least)
                told.append([dict(zip(("start", "end", "first", "behind"), p)) for p in found])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(told, type_)], [*batch.schema.names, "__pieces"])

    cut = short.unionByName(long.mapInArrow(run, f"{fields}, __pieces {kind}"))
    others = [c for c in segments.columns if c not in ("start", "end", "words")]
    out = cut.select(*others, "words", F.size("__pieces").alias("n_pieces"), F.posexplode("__pieces").alias("piece", "__p"))
    return out.select(*others, "n_pieces", "piece", "__p.start", "__p.end", F.slice("words", F.col("__p.first") + 1, F.col("__p.behind") - F.col("__p.first")).alias("words"))


def speaker_rows(segments: DataFrame, words: DataFrame, channels: DataFrame, shortest: float, longest: float, least: float = 1.0) -> DataFrame:
    """(id, meeting, agent, audio, offset, duration, text): a row for each piece of a speaker's segments, on their own headset.

    segments(meeting, agent, owner, child, start, end, file, first_word, last_word) has a row for each range of words
    that a segment (owner) refers to, in the order of `child`; words are in `words`(meeting, file, id, pos, text,
    start, end, join, lex), channels(meeting, agent, channel) may lack a speaker. Segments without a real word are
    left out; a bound that the annotators left open is that of the words. Segments longer than `longest` are cut at
    their longest pauses; pieces without text or outside [shortest, longest] are left out.
    """
    found = range_words(segments.withColumnsRenamed({"start": "seg_start", "end": "seg_end"}), words)
    word = F.struct("child", "pos", "text", "start", "end", "join", "lex").cast(WORD)
    own = found.groupBy("meeting", "agent", "owner").agg(
        F.array_sort(F.collect_list(word)).alias("words"), F.coalesce(F.min("seg_start"), F.min("start")).alias("start"), F.coalesce(F.max("seg_end"), F.max("end")).alias("end"), F.max("lex").alias("real")
    )
    own = own.where("real and end > start").drop("real")
    told = split_long(own, longest, least).withColumn("text", meeting_text(F.col("words"))).withColumn("duration", F.col("end") - F.col("start"))
    told = told.where((F.col("text") != "") & F.col("duration").between(shortest, longest)).join(channels.select("meeting", "agent", "channel"), ["meeting", "agent"], "left")
    name = F.when(F.col("n_pieces") == 1, F.col("owner")).otherwise(F.concat_ws(".", "owner", "piece"))
    audio = F.concat(F.col("meeting").cast("string"), F.lit(".Headset-"), channel(F.col("agent"), F.col("channel")).cast("string"), F.lit(".wav"))
    return told.select(name.alias("id"), "meeting", "agent", audio.alias("audio"), F.round("start", 3).alias("offset"), F.round("duration", 3).alias("duration"), "text")


def sentence_rows(sentences: DataFrame, links: DataFrame, acts: DataFrame, words: DataFrame, mixes: DataFrame, shortest: float, longest: float) -> DataFrame:
    """(id, meeting, section, n_acts, offset, duration, text): a row for each summary sentence, over its linked acts.

    sentences(meeting, sentence, section, pos, text); mixes(meeting, length): the length of the meeting's audio, where a
    row ends at the latest. n_acts counts all links, those to unknown acts too. Sentences without text or time, and
    rows that aren't longer than nothing and in [shortest, longest], are left out.
    """
    counted = links.groupBy("meeting", "sentence").agg(F.count("*").alias("n_acts"))
    timed = linked_spans(links, acts, words).join(sentences, ["meeting", "sentence"]).join(counted, ["meeting", "sentence"]).join(mixes, "meeting")
    timed = timed.withColumn("duration", F.least("end", "length") - F.col("start")).withColumn("text", F.trim("text"))
    kept = timed.where((F.col("duration") > 0) & F.col("duration").between(shortest, longest) & (F.col("text") != ""))
    return kept.select(F.col("sentence").alias("id"), "meeting", "section", "n_acts", F.round("start", 3).alias("offset"), F.round("duration", 3).alias("duration"), "text")


def topic_of(spans_: DataFrame, topics: DataFrame, width: float) -> DataFrame:
    """(meeting, sentence, topic) of the topic that a sentence's span overlaps most, of equals the first in document order.

    Both sides are dealt to time bins of `width` seconds; a pair is counted in the bin where it begins to overlap.
    """
    left = binned(spans_.select("meeting", "sentence", "start", "end"), "start", "end", width)
    right = binned(topics.select("meeting", F.col("owner").alias("topic"), "ordinal", F.col("start").alias("t_start"), F.col("end").alias("t_end")), "t_start", "t_end", width)
    both = left.join(right, ["meeting", "bin"]).where((F.col("start") < F.col("t_end")) & (F.col("t_start") < F.col("end")))
    both = both.where(F.col("bin") == F.floor(F.greatest("start", "t_start") / width))
    shared = F.greatest("start", "t_start") - F.least("end", "t_end")
    best = both.groupBy("meeting", "sentence").agg(F.min(F.struct(shared.alias("off"), "ordinal", "topic")).alias("b"))
    return best.select("meeting", "sentence", F.col("b.topic").alias("topic"))


def topic_rows(topics: DataFrame, sentences: DataFrame, links: DataFrame, acts: DataFrame, words: DataFrame, mixes: DataFrame, shortest: float, longest: float, per_section: bool = False, width: float = 60.0) -> DataFrame:
    """(id, meeting, topic, section, label, n_sentences, offset, duration, text): the summary of each topic, on its time.

    topics(meeting, owner, ordinal, label, file, first_word, last_word) has a row for each range of words of a topic.
    Each summary sentence goes to the topic that its linked acts overlap most; a topic's text is its sentences in the
    summary's order. With per_section there is a row for each section of a topic, else section is null. Topics without
    time or sentences, or outside [shortest, longest], are left out.
    """
    facts = topics.groupBy("meeting", "owner").agg(F.min("ordinal").alias("ordinal"), F.max("label").alias("label"))
    timed = spans(topics, words).join(facts, ["meeting", "owner"])
    dealt = topic_of(linked_spans(links, acts, words), timed, width).join(sentences, ["meeting", "sentence"])
    keys = ["meeting", "topic", "section"] if per_section else ["meeting", "topic"]
    texts = dealt.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("them"))
    texts = texts.select(*keys, F.size("them").alias("n_sentences"), F.trim(F.array_join(F.transform("them", lambda s: s["text"]), " ")).alias("text"))
    rows = timed.withColumnRenamed("owner", "topic").join(mixes, "meeting").withColumn("duration", F.least("end", "length") - F.col("start"))
    rows = rows.where(F.col("duration").between(shortest, longest)).join(texts, ["meeting", "topic"]).where("text <> ''")
    name = F.concat_ws(".", "topic", "section") if per_section else F.col("topic")
    section = F.col("section") if per_section else F.lit(None).cast("string")
    return rows.select(name.alias("id"), "meeting", "topic", section.alias("section"), "label", "n_sentences", F.round("start", 3).alias("offset"), F.round("duration", 3).alias("duration"), "text")
