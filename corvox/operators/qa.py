"""Time-aligned questions: words array<struct<word,start,end>>, in which punctuation has the time -1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clock, oxford

WORDS = "array<struct<word:string,start:double,end:double>>"
LETTERS = r"[\p{L}\p{N}]"


def zipped(word: Column, start: Column, end: Column) -> Column:
    """Parallel arrays as words; where they differ in length the shortest counts."""
    n = F.least(F.size(word), F.size(start), F.size(end))
    cut = lambda a: F.slice(a, F.lit(1), n)
    return F.arrays_zip(cut(word).alias("word"), cut(start).alias("start"), cut(end).alias("end")).cast(WORDS)


def timed(words: Column) -> Column:
    """The words that have a time."""
    return F.filter(words, lambda w: w["start"] >= 0)


def attached(words: Column) -> Column:
    """Pure punctuation joined to the word before it."""
    start = F.array().cast(WORDS)

    def add(acc: Column, w: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        glue = ~w["word"].rlike(LETTERS) & (F.size(acc) > 0)
        joined = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(last.withField("word", F.concat(last["word"], w["word"]))))
        return F.when(glue, joined).otherwise(F.concat(acc, F.array(w))).cast(WORDS)

    return F.aggregate(words, start, add)


def trailing_gap(words: Column, duration: Column) -> Column:
    """How long after the last timed word the audio ends."""
    return duration - F.array_max(F.transform(timed(words), lambda w: w["end"]))


def occurrences(words: Column, term: Column) -> Column:
    """The start times of a word, in any case."""
    return F.transform(F.filter(timed(words), lambda w: F.lower(F.regexp_replace(w["word"], r"[^\p{L}\p{N}'-]", "")) == F.lower(term)), lambda w: w["start"])


def phrase_occurrences(words: Column, phrase: Column) -> Column:
    """The start times of a phrase in neighbouring timed words, in any case."""
    def of(own: Column) -> Column:
        terms = F.split(F.lower(phrase), " ")
        n = F.size(terms)
        keys = F.transform(own, lambda w: F.lower(F.regexp_replace(w["word"], r"[^\p{L}\p{N}'-]", "")))
        last = F.size(own) - n + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        hit = F.filter(starts, lambda i: F.slice(keys, i, n) == terms)
        return F.transform(hit, lambda i: F.get(own, i - 1)["start"])

    return F.flatten(F.transform(F.array(timed(words)), of))


def phrase_end(words: Column, start: Column, n: Column) -> Column:
    """The end of the n-th timed word from the one that begins at `start`."""
    from_ = F.filter(timed(words), lambda w: w["start"] >= start)
    return F.try_element_at(from_, n)["end"]


def answer_words(words: Column, start: Column, end: Column, eps: float = 0.001) -> Column:
    """The text of the words from the one that begins within eps of `start` to `end`."""
    own = F.filter(timed(words), lambda w: (w["start"] >= start - eps) & (w["end"] <= end + eps))
    return F.array_join(F.transform(own, lambda w: w["word"]), " ")


def cased_answer(words: Column, start: Column, end: Column, answer: Column) -> Column:
    """The words of the span in their own case, if they are the answer but for case."""
    said = answer_words(words, start, end)
    return F.when(F.lower(said) == F.lower(answer), said).otherwise(answer)


def window_words(words: Column, a: Column, b: Column) -> Column:
    """The text of the words inside [a, b]; punctuation follows its word."""
    own = F.filter(attached(words), lambda w: (w["start"] >= a) & (w["end"] <= b))
    return F.array_join(F.transform(own, lambda w: w["word"]), " ")


def sentences(words: Column) -> Column:
    """Sentences (text, start, end, n): words are attached, a sentence ends behind . ? or !."""
    kind = "array<struct<text:string,start:double,end:double,n:int>>"
    start = F.struct(F.array().cast(kind).alias("done"), F.lit(True).alias("new"))

    def add(acc: Column, w: Column) -> Column:
        done, last = acc["done"], F.try_element_at(acc["done"], F.lit(-1))
        fresh = F.struct(w["word"].alias("text"), w["start"].alias("start"), w["end"].alias("end"), F.lit(1).alias("n"))
        more = F.struct(F.concat_ws(" ", last["text"], w["word"]).alias("text"), last["start"].alias("start"), F.greatest(last["end"], w["end"]).alias("end"), (last["n"] + 1).alias("n"))
        grown = F.when(acc["new"], F.concat(done, F.array(fresh))).otherwise(F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(more)))
        return F.struct(grown.cast(kind).alias("done"), w["word"].rlike(r"[.?!]$").alias("new"))

    return F.aggregate(attached(words), start, add, lambda acc: acc["done"])


def built_sentences(words: Column, pause: float = 1.0, least: int = 5, most: int = 35, longest: float = 18.0) -> Column:
    """Sentences (text, start, end, n) of transcripts that may lack marks: n words each, from start to end in seconds.

    A sentence ends behind a word or a lone mark that ends in . ? or !. Where none comes, it ends before a word that
    begins `pause` seconds or more after the last one, if it has `least` words by then, and behind the word with which
    it has `most` words or lasts `longest` seconds. Lone marks join the word before them, and belong to no sentence
    between two; a word without a time (null or below 0) and an empty one aren't read. An unfinished last sentence is
    one. Null or empty words give none.

    The fold holds where the present sentence began and the bounds of those that are done, no text; texts are put
    together from the bounds afterwards.
    """
    bound = "array<struct<first:int,last:int,start:double,end:double,n:int>>"
    token = lambda w: F.trim(F.coalesce(w["word"], F.lit("")))
    letters = lambda w: token(w).rlike(LETTERS)
    read = F.filter(words, lambda w: (token(w) != "") & (~letters(w) | F.coalesce(w["start"] >= 0, F.lit(False))))
    tokens = F.transform(
        read, lambda w, i: F.struct(i.alias("i"), token(w).alias("word"), letters(w).alias("letters"), token(w).rlike("[.?!]$").alias("stop"), w["start"].cast("double").alias("start"), w["end"].cast("double").alias("end"))
    )
    begin = F.struct(F.lit(False).alias("open"), F.lit(0).alias("first"), F.lit(0.0).alias("start"), F.lit(0.0).alias("end"), F.lit(0).alias("n"), F.array().cast(bound).alias("done"))

    def told(first: Column, last: Column, start: Column, end: Column, n: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), start.alias("start"), end.alias("end"), n.alias("n"))

    def add(acc: Column, w: Column) -> Column:
        silent = acc["open"] & w["letters"] & (w["start"] - acc["end"] >= pause) & (acc["n"] >= least)
        new = w["letters"] & (~acc["open"] | silent)
        first, start = F.when(new, w["i"]).otherwise(acc["first"]), F.when(new, w["start"]).otherwise(acc["start"])
        end = F.when(w["letters"], w["end"]).otherwise(acc["end"])
        n = F.when(new, 0).otherwise(acc["n"]) + w["letters"].cast("int")
        is_open = acc["open"] | w["letters"]
        full = is_open & (w["stop"] | w["letters"] & ((n >= most) | (end - start >= longest)))
        before = F.when(silent, F.array(told(acc["first"], w["i"] - 1, acc["start"], acc["end"], acc["n"]))).otherwise(F.array().cast(bound))
        now = F.when(full, F.array(told(first, w["i"], start, end, n))).otherwise(F.array().cast(bound))
        done = F.when(silent | full, F.concat(acc["done"], before, now)).otherwise(acc["done"])
        return F.struct((is_open & ~full).alias("open"), first.alias("first"), start.alias("start"), end.alias("end"), n.alias("n"), done.cast(bound).alias("done"))

    def close(acc: Column) -> Column:
        rest = F.array(told(acc["first"], F.lit(2**31 - 2), acc["start"], acc["end"], acc["n"]))
        return F.when(acc["open"], F.concat(acc["done"], rest)).otherwise(acc["done"]).cast(bound)

    def of(own: Column) -> Column:
        spelled = lambda w, k: F.when(w["letters"] & (k > 0), F.concat(F.lit(" "), w["word"])).otherwise(w["word"])
        text = lambda b: F.array_join(F.transform(F.slice(own, b["first"] + 1, b["last"] - b["first"] + 1), spelled), "")
        return F.transform(F.aggregate(own, begin, add, close), lambda b: F.struct(text(b).alias("text"), b["start"].alias("start"), b["end"].alias("end"), b["n"].alias("n")))

    return F.flatten(F.transform(F.array(tokens), of))


def sentence_at(found: Column, t: Column) -> Column:
    """The sentence that holds t, else the one whose middle is nearest."""
    inside = F.get(F.filter(found, lambda s: (s["start"] <= t) & (s["end"] >= t)), F.lit(0))
    near = F.array_min(F.transform(found, lambda s: F.struct(F.abs((s["start"] + s["end"]) / 2 - t).alias("off"), s.alias("s"))))["s"]
    return F.coalesce(inside, near)


def sentences_between(found: Column, a: Column, b: Column) -> Column:
    """The sentences whose middle lies in [a, b]."""
    return F.filter(found, lambda s: ((s["start"] + s["end"]) / 2).between(a, b))


def unambiguous(words: Column, gap: float = 0.15) -> Column:
    """The timed words whose neighbours begin at least `gap` away."""
    def of(own: Column) -> Column:
        far = lambda i, j: F.coalesce(F.abs(F.get(own, i)["start"] - F.get(own, j)["start"]) >= gap, F.lit(True))
        index = F.filter(F.transform(own, lambda w, i: i), lambda i: far(i, i - 1) & far(i, i + 1))
        return F.transform(index, lambda i: F.get(own, i))

    return F.flatten(F.transform(F.array(timed(words)), of))


def content_words(words: Column, least: int = 5) -> Column:
    """The words of at least so many letters that occur once."""
    def of(own: Column) -> Column:
        keys = F.filter(F.transform(own, lambda w: F.lower(F.regexp_replace(w["word"], r"[^\p{L}]", ""))), lambda k: F.length(k) >= least)
        return F.filter(F.array_distinct(keys), lambda k: F.size(F.filter(keys, lambda o: o == k)) == 1)

    return F.flatten(F.transform(F.array(timed(words)), of))


def out_of_vocabulary(candidates: Column, words: Column, u: Column) -> Column:
    """One of the candidates that isn't said, by a reproducible draw."""
    free = F.array_sort(F.array_except(candidates, F.transform(words, lambda w: F.lower(w["word"]))))
    return F.get(free, F.floor(u * F.size(free)).cast("int"))


def longest_pause(words: Column) -> Column:
    """The longest time between neighbouring timed words."""
    def of(own: Column) -> Column:
        return F.array(F.array_max(F.transform(own, lambda w, i: F.when(i > 0, w["start"] - F.get(own, i - 1)["end"]))))

    return F.get(F.flatten(F.transform(F.array(timed(words)), of)), F.lit(0))


def times_text(starts: Column) -> Column:
    """Times in seconds as a, b, and c."""
    return oxford(F.transform(starts, lambda s: F.format_string("%.2f s", s)))


#: Line formats of timestamped transcriptions: name -> (line of a unit, joint).
FORMATS = {
    "brackets": (lambda u: F.concat(F.lit("["), F.format_string("%.2f", u["start"]), F.lit("-"), F.format_string("%.2f", u["end"]), F.lit("] "), u["text"]), "\n"),
    "arrow": (lambda u: F.concat(clock(u["start"]), F.lit(" --> "), clock(u["end"]), F.lit("\n"), u["text"]), "\n\n"),
    "tabs": (lambda u: F.concat_ws("\t", F.format_string("%.2f", u["start"]), F.format_string("%.2f", u["end"]), u["text"]), "\n"),
    "seconds": (lambda u: F.concat(F.format_string("%.2fs: ", u["start"]), u["text"]), "\n"),
    "inline": (lambda u: F.concat(F.format_string("<%.2f> ", u["start"]), u["text"], F.format_string(" <%.2f>", u["end"])), " "),
    "parentheses": (lambda u: F.concat(u["text"], F.format_string(" (%.2f-%.2f)", u["start"], u["end"])), "\n"),
    "clock": (lambda u: F.concat(F.substring(clock(u["start"]), 4, 5), F.lit(" "), u["text"]), "\n"),
}


def rendered(units: Column, name: str) -> Column:
    """Units (text, start, end) in a line format, or as JSON."""
    if name == "json":
        return F.to_json(F.transform(units, lambda u: F.struct(u["start"].alias("start"), u["end"].alias("end"), u["text"].alias("text"))))
    line, joint = FORMATS[name]
    return F.array_join(F.transform(units, line), joint)


#: Diarization formats: name -> line of a unit with a speaker; srt and vtt are numbered or headed.
SPEAKERS = {
    "colon": lambda u: F.concat(u["speaker"], F.lit(": "), u["text"]),
    "brackets": lambda u: F.concat(F.lit("["), u["speaker"], F.lit("] "), u["text"]),
    "rttm": lambda u: F.concat(F.lit("SPEAKER audio 1 "), F.format_string("%.2f %.2f", u["start"], u["end"] - u["start"]), F.lit(" <NA> <NA> "), u["speaker"], F.lit(" <NA> <NA>")),
    "times": lambda u: F.concat(F.format_string("%.2f-%.2f ", u["start"], u["end"]), u["speaker"]),
    "tsv": lambda u: F.concat_ws("\t", F.format_string("%.2f", u["start"]), F.format_string("%.2f", u["end"]), u["speaker"], u["text"]),
    "angle": lambda u: F.concat(F.lit("<"), u["speaker"], F.lit("> "), u["text"]),
}


def rendered_speakers(units: Column, name: str) -> Column:
    """Units (speaker, text, start, end) in a diarization format."""
    if name == "srt":
        return F.array_join(F.transform(units, lambda u, i: F.concat((i + 1).cast("string"), F.lit("\n"), clock(u["start"], ","), F.lit(" --> "), clock(u["end"], ","), F.lit("\n"), u["speaker"], F.lit(": "), u["text"], F.lit("\n"))), "\n")
    if name == "vtt":
        return F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(units, lambda u: F.concat(clock(u["start"]), F.lit(" --> "), clock(u["end"]), F.lit("\n<v "), u["speaker"], F.lit(">"), u["text"], F.lit("\n"))), "\n"))
    if name == "json":
        return F.to_json(F.transform(units, lambda u: F.struct(u["speaker"].alias("speaker"), u["start"].alias("start"), u["end"].alias("end"), u["text"].alias("text"))))
    return F.array_join(F.transform(units, SPEAKERS[name]), "\n")


def is_backchannel(text: Column, fillers: list[str], most: int = 4) -> Column:
    """Whether a turn is at most so many words, all of them fillers."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}'-]+"), lambda w: w != "")
    return (F.size(words) > 0) & (F.size(words) <= most) & F.forall(words, lambda w: w.isin(fillers))


def without_fillers(text: Column, fillers: list[str]) -> Column:
    """The text without its filler words."""
    return F.array_join(F.filter(F.split(text, " "), lambda w: ~F.lower(F.regexp_replace(w, r"[^\p{L}'-]", "")).isin(fillers)), " ")


#: Task builders: name -> (question, answer) over the columns words, term and at.
def tasks(rows: DataFrame) -> DataFrame:
    """A row for each record and task that it supports: (task, question, answer), over words, term (a word) and at (a time)."""
    w, term, at = F.col("words"), F.col("term"), F.col("at")
    starts, found = occurrences(w, term), sentences(w)
    spoken_at = F.get(F.filter(timed(w), lambda x: (x["start"] <= at) & (x["end"] >= at)), F.lit(0))["word"]
    there = F.get(F.filter(found, lambda s: F.lower(s["text"]).contains(F.lower(term))), F.lit(0))
    options = {
        "word2time": (F.concat(F.lit("When is "), term, F.lit(" said?")), F.when(F.size(starts) > 0, times_text(starts)).otherwise("It is not said.")),
        "time2word": (F.format_string("Which word is said at %.2f s?", at), spoken_at),
        "time2sentence": (F.format_string("Which sentence is said at %.2f s?", at), sentence_at(found, at)["text"]),
        "word2sentence": (F.concat(F.lit("In which sentence is "), term, F.lit(" said?")), there["text"]),
        "answer_with_json": (F.concat(F.lit("Give the times of "), term, F.lit(" as JSON.")), F.to_json(F.struct(term.alias("word"), starts.alias("starts")))),
    }
    every = F.array(*(F.struct(F.lit(n).alias("task"), q.alias("question"), a.alias("answer")) for n, (q, a) in options.items()))
    return rows.withColumn("__t", F.explode(every)).where("__t.answer is not null").select(*(c for c in rows.columns if c not in ("words", "term", "at")), "__t.task", "__t.question", "__t.answer")
