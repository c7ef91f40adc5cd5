"""Linked chains of questions on time-aligned words: each question points back at the answer before it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_u
from . import qa as Q

ITEMS = "array<struct<task:string,question:string,answer:string,alone:string>>"
#: Widths in seconds of the passage around a moment, and how near the ends of the audio no moment is asked about.
WIDTHS, MARGIN = (6, 8, 10), 3.0
#: What is said, by language; {t}, {a}, {b} are times, {w} is a word, {n} a number of seconds, {q} a question.
WORDINGS = {
    "en": {
        "word_at_time": "Which word begins at {t} seconds?", "sentence_at_time": "What is the whole sentence at {t} seconds?", "zoom_sentence": "What is the sentence around it?",
        "zoom_window": "Now write down the {n} seconds around that moment.", "window_between": "Write down what is said from {a} to {b} seconds.", "word_time": "At what time is “{w}” said?", "time": "At {t} seconds.",
        "sentence_with_word": "Which sentence has the word “{w}”?", "locate_sentence": "Which sentence does it stand in?", "word_next": "Which word follows “{w}”?", "locate_next": "Which word follows it?",
        "qa_answer": "Answer by the recording: {q}", "qa_time": "At what time is this answer said?", "qa_sentence": "Which sentence does the answer come from?",
    },
    "fr": {
        "word_at_time": "Quel mot débute à {t} secondes ?", "sentence_at_time": "Quelle est la phrase entière à {t} secondes ?", "zoom_sentence": "Quelle phrase l'entoure ?",
        "zoom_window": "Transcris maintenant les {n} secondes autour de ce moment.", "window_between": "Transcris ce qui est dit de {a} à {b} secondes.", "word_time": "Quand entend-on « {w} » ?", "time": "À {t} secondes.",
        "sentence_with_word": "Quelle phrase contient « {w} » ?", "locate_sentence": "Dans quelle phrase est-il ?", "word_next": "Quel mot suit « {w} » ?", "locate_next": "Quel mot le suit ?",
        "qa_answer": "Réponds d'après l'enregistrement : {q}", "qa_time": "À quel moment cette réponse est-elle dite ?", "qa_sentence": "De quelle phrase vient la réponse ?",
    },
}


def phrase(template: str, **values: Column) -> Column:
    """A template with its {names} filled in."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(values[p].cast("string") if k % 2 else F.lit(p) for k, p in enumerate(parts)))


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def bare(word: Column) -> Column:
    """A word without the marks around it."""
    return F.regexp_replace(word, r"""^[.,;:!?()"'»«]+|[.,;:!?()"'»«]+$""", "")


def _seconds(t: Column) -> Column:
    """A time with one decimal, the nearest one to its exact value, of two the even one: 14.25 is 14.2, 14.35 is 14.3.

    format_string would round the digits that are printed for it, and up: 14.3, 14.4.
    """
    return F.call_function("format_number", t, F.lit("0.0"))


def _item(task: str, question: Column, answer: Column, alone: Column | None = None) -> Column:
    return F.struct(F.lit(task).alias("task"), question.alias("question"), answer.alias("answer"), (question if alone is None else alone).alias("alone"))


def _some(items: list[Column]) -> Column:
    """The items up to the first without an answer: a later one would point at nothing."""
    every = F.array(*items).cast(ITEMS)
    full = F.aggregate(every, F.struct(F.array().cast(ITEMS).alias("done"), F.lit(True).alias("on")), lambda acc, x: _next(acc, x), lambda acc: acc["done"])
    return full


def _next(acc: Column, x: Column) -> Column:
    on = acc["on"] & (F.coalesce(x["answer"], F.lit("")) != "")
    return F.struct(F.when(on, F.concat(acc["done"], F.array(x))).otherwise(acc["done"]).cast(ITEMS).alias("done"), on.alias("on"))


def zoom(words: Column, duration: Column, u_word: Column, u_width: Column, said: dict[str, str]) -> Column:
    """A moment, the word at it, its sentence, the passage around it. None where no word is clear enough to be asked for."""
    clear = F.filter(Q.unambiguous(words), lambda w: (w["start"] > MARGIN) & (w["start"] < duration - MARGIN))

    def of(w: Column) -> Column:
        t = w["start"]
        n = F.get(F.array(*map(F.lit, WIDTHS)), F.floor(u_width * len(WIDTHS)).cast("int"))
        a, b = F.greatest(F.lit(0.0), t - n / 2), F.least(duration, t + n / 2)
        ask = phrase(said["word_at_time"], t=_seconds(t))
        return _some([
            _item("word_at_time", ask, bare(w["word"])),
            _item("sentence_at_time", F.lit(said["zoom_sentence"]), Q.sentence_at(Q.sentences(words), t)["text"], phrase(said["sentence_at_time"], t=_seconds(t))),
            _item("window_between", phrase(said["zoom_window"], n=n), Q.window_words(words, a, b), phrase(said["window_between"], a=_seconds(a), b=_seconds(b))),
        ])

    picked = bound(clear, lambda c: F.get(c, F.floor(u_word * F.size(c)).cast("int")))
    return F.coalesce(bound(picked, lambda w: F.when(w.isNotNull(), of(w))), F.array().cast(ITEMS))


def locate(words: Column, u_word: Column, said: dict[str, str]) -> Column:
    """A word said once, its time, its sentence, the word behind it. None where no word of five letters is said once."""

    def of(own: Column) -> Column:
        keys = F.transform(own, lambda w: F.lower(bare(w["word"])))
        once = F.filter(F.transform(own, lambda w, i: i), lambda i: F.get(keys, i).rlike(r"^\p{L}{5,}$") & (F.size(F.filter(keys, lambda k: k == F.get(keys, i))) == 1))
        at = F.get(once, F.floor(u_word * F.size(once)).cast("int"))
        return F.struct(bare(F.get(own, at)["word"]).alias("word"), F.get(own, at)["start"].alias("start"), bare(F.get(own, at + 1)["word"]).alias("after"))

    def items(x: Column) -> Column:
        holder = F.get(F.filter(Q.sentences(words), lambda s: F.lower(s["text"]).contains(F.lower(x["word"]))), F.lit(0))["text"]
        return _some([
            _item("word_time", phrase(said["word_time"], w=x["word"]), phrase(said["time"], t=_seconds(x["start"]))),
            _item("sentence_with_word", F.lit(said["locate_sentence"]), holder, phrase(said["sentence_with_word"], w=x["word"])),
            _item("word_next", F.lit(said["locate_next"]), x["after"], phrase(said["word_next"], w=x["word"])),
        ])

    found = bound(bound(Q.timed(words), of), lambda x: F.when(x["word"].isNotNull(), items(x)))
    return F.coalesce(found, F.array().cast(ITEMS))


def answered(words: Column, question: Column, answer: Column, start: Column, said: dict[str, str]) -> Column:
    """A question, its answer, the answer's time, its sentence. None where there is no question."""
    ask = phrase(said["qa_answer"], q=question)
    items = _some([
        _item("qa_answer", ask, answer),
        _item("qa_time", F.lit(said["qa_time"]), phrase(said["time"], t=_seconds(start))),
        _item("qa_sentence", F.lit(said["qa_sentence"]), Q.sentence_at(Q.sentences(words), start)["text"]),
    ])
    return F.when(question.isNotNull() & answer.isNotNull() & start.isNotNull(), items).otherwise(F.array().cast(ITEMS))


def linked(records: DataFrame, key: str, lang: str = "en", seed: str = "chain") -> DataFrame:
    """(key, chain, step, task, question, answer, alone): one chain of two or three steps for each record.

    records(key, words, duration, question, answer, answer_start). Which chain, which word, how wide a passage and how
    many steps are draws of the seed and the key. Where the drawn chain has fewer than two steps, the next of
    (zoom, locate, qa), in a circle, stands in; a record that supports none has no rows. `alone` asks the same without
    the steps before. No task comes twice, as a chain's tasks differ. All is one projection: nothing is shuffled.
    """
    said, w = WORDINGS[lang], F.col("words")
    u = lambda what: hash_u(f"{seed}:{what}", key)
    chains = F.array(
        F.struct(F.lit("zoom").alias("chain"), zoom(w, F.col("duration"), u("word"), u("width"), said).alias("items")),
        F.struct(F.lit("locate").alias("chain"), locate(w, u("word"), said).alias("items")),
        F.struct(F.lit("qa").alias("chain"), answered(w, F.col("question"), F.col("answer"), F.col("answer_start"), said).alias("items")),
    )
    turned = bound(chains, lambda c: bound(F.floor(u("kind") * 3).cast("int"), lambda k: F.concat(F.slice(c, k + 1, F.lit(3)), F.slice(c, F.lit(1), k))))
    first = F.get(F.filter(turned, lambda c: F.size(c["items"]) >= 2), F.lit(0))
    steps = F.when(u("steps") < 0.5, 2).otherwise(3)
    out = records.select(key, first.alias("c"), steps.alias("n")).where("c is not null")
    out = out.select(key, "c.chain", F.posexplode(F.slice("c.items", F.lit(1), F.col("n"))).alias("step", "x"))
    return out.select(key, "chain", "step", "x.task", "x.question", "x.answer", "x.alone")
