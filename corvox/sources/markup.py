"""Readers of XML annotations, TextGrids: one file is one small document, parsed where it is read."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

NITE = "{http://nite.sourceforge.net/}"
#: Rows that a task holds at most, besides those of one file.
ROWS = 50_000


def parsed(spark: SparkSession, paths: str | list[str], parse: Callable[[bytes], list[tuple]], schema: str) -> DataFrame:
    """(file, fields of the schema): parse(content) over files; a file that can't be parsed gives no rows."""
    names = ["file", *(f.split()[0] for f in re.split(r",\s*(?![^<]*>)", schema))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows += [(path, *r) for r in parse(bytes(content))]
                except (ET.ParseError, UnicodeDecodeError, ValueError):
                    continue
                if len(rows) >= ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, f"file string, {schema}")


def _time(e: ET.Element, name: str) -> float | None:
    v = e.get(name)
    return float(v) if v not in (None, "", "?") else None


def nxt_words(content: bytes) -> list[tuple]:
    """(id, pos, text, start, end, join, lexical) of a words file: words, punctuation and markers in document order."""
    return _words(ET.fromstring(content))


def _words(root: ET.Element) -> list[tuple]:
    out = []
    for pos, e in enumerate(root):
        kind = e.tag.rpartition("}")[2]
        text = (e.text or "").strip()
        if kind == "w":
            punctuation = e.get("punc") == "true" or not re.search(r"\w", text)
            if e.get("trunc") == "true":
                text += "-"
            out.append((e.get(f"{NITE}id"), pos, text, _time(e, "starttime"), _time(e, "endtime"), "left" if punctuation else e.get("join"), not punctuation))
        else:
            label = e.get("type") or kind
            out.append((e.get(f"{NITE}id"), pos, f"[{label}]", _time(e, "starttime"), _time(e, "endtime"), None, False))
    return out


def nxt_raw_words(content: bytes) -> list[tuple]:
    """The same with raw markers for the cleaning filters: <vocalsound:laugh>, <gap>, <gap:foreign>; others without text."""

    def marker(e: ET.Element) -> str | None:
        kind = e.tag.rpartition("}")[2]
        more = {"vocalsound": ":" + (e.get("type") or "other"), "gap": ":foreign" if e.get("pron") == "foreign" else ""}.get(kind)
        return None if more is None else f"<{kind}{more}>"

    root = ET.fromstring(content)
    return [row if e.tag.rpartition("}")[2] == "w" else (*row[:2], marker(e), *row[3:]) for row, e in zip(_words(root), root)]


WORDS = "id string, pos long, text string, start double, end double, join string, lex boolean"


def _range(href: str) -> tuple[str, str]:
    ids = re.findall(r"id\(([^)]+)\)", href)
    return ids[0], ids[-1]


def nxt_segments(content: bytes) -> list[tuple]:
    """(id, start, end, first word, last word) of a segments file."""
    out = []
    for e in ET.fromstring(content):
        child = e.find(f"{NITE}child")
        first, last = _range(child.get("href")) if child is not None else (None, None)
        out.append((e.get(f"{NITE}id"), _time(e, "transcriber_start") or _time(e, "starttime"), _time(e, "transcriber_end") or _time(e, "endtime"), first, last))
    return out


SEGMENTS = "id string, start double, end double, first_word string, last_word string"


def nxt_topics(content: bytes) -> list[tuple]:
    """(id, parent, label, first word, last word) of a topics file, nested topics included."""
    out: list[tuple] = []

    def walk(e: ET.Element, parent: str | None) -> None:
        for t in e:
            if t.tag.rpartition("}")[2] == "topic":
                me = t.get(f"{NITE}id")
                refs = [_range(c.get("href")) for c in t.findall(f"{NITE}child")]
                out.append((me, parent, t.get("other_description") or t.get("description"), refs[0][0] if refs else None, refs[-1][1] if refs else None))
                walk(t, me)

    walk(ET.fromstring(content), None)
    return out


TOPICS = "id string, parent string, label string, first_word string, last_word string"


def nxt_acts(content: bytes) -> list[tuple]:
    """(id, type, first word, last word) of a dialogue-act file."""
    out = []
    for e in ET.fromstring(content):
        child, kind = e.find(f"{NITE}child"), e.find(f"{NITE}pointer")
        first, last = _range(child.get("href")) if child is not None else (None, None)
        out.append((e.get(f"{NITE}id"), _range(kind.get("href"))[0] if kind is not None else None, first, last))
    return out


ACTS = "id string, type string, first_word string, last_word string"


def nxt_ranges(content: bytes) -> list[tuple]:
    """(owner, ordinal, label, start, end, child, words_file, first_word, last_word): a row for each reference to words.

    Owners are the segments, topics or acts that stand at the top of a file, in document order; references of parts of
    an owner count as its own. One without a reference to a words file has a row with nulls.
    """
    out = []
    for ordinal, e in enumerate(ET.fromstring(content)):
        start, end = (_time(e, f"transcriber_{x}") if _time(e, f"transcriber_{x}") is not None else _time(e, f"{x}time") for x in ("start", "end"))
        own = (e.get(f"{NITE}id") or e.get("id"), ordinal, e.get("other_description") or e.get("description"), start, end)
        hrefs = [c.get("href") or "" for c in e.iter(f"{NITE}child")]
        refs = [(h.partition("#")[0], *_range(h)) for h in hrefs if h.partition("#")[0].endswith(".words.xml") and "id(" in h]
        out += [(*own, k, *r) for k, r in enumerate(refs or [(None, None, None)])]
    return out


RANGES = "owner string, ordinal long, label string, start double, end double, child long, words_file string, first_word string, last_word string"


def nxt_channels(content: bytes) -> list[tuple]:
    """(meeting, agent, channel) of a meetings file: the headset channel of each speaker; those without one aren't told."""
    out = []
    for m in ET.fromstring(content).iter():
        name = m.get("observation") or m.get("id") or m.get(f"{NITE}id")
        if m.tag.rpartition("}")[2].lower() == "meeting" and name:
            for s in m.iter():
                agent, channel = s.get("nxt_agent") or s.get("agent"), s.get("channel")
                if s.tag.rpartition("}")[2].lower() == "speaker" and agent and (channel or "").strip().isdigit():
                    out.append((name, agent, int(channel)))
    return out


CHANNELS = "meeting string, agent string, channel int"


def nxt_links(content: bytes) -> list[tuple]:
    """(sentence, act) of a summary-link file."""
    out = []
    for e in ET.fromstring(content):
        ends = {p.get("role"): _range(p.get("href"))[0] for p in e.findall(f"{NITE}pointer")}
        if "abstractive" in ends and "extractive" in ends:
            out.append((ends["abstractive"], ends["extractive"]))
    return out


LINKS = "sentence string, act string"


def nxt_abstracts(content: bytes) -> list[tuple]:
    """(section, pos, id, text) of an abstractive summary file; pos numbers the sentences of the whole file."""
    every = [(s.tag.rpartition("}")[2], x) for s in ET.fromstring(content) for x in s.iter("sentence")]
    return [(section, k, x.get(f"{NITE}id"), (x.text or "").strip()) for k, (section, x) in enumerate(every)]


ABSTRACTS = "section string, pos long, id string, text string"


def transcriber_items(content: bytes) -> list[tuple]:
    """(chunk, start, end, pos, kind, text, type, extent) of a .trs file: what it holds, in document order.

    A chunk reaches from a time mark to the next one of its turn, or to the turn's end; what stands before a turn's
    first mark belongs to none. Kinds: text, speaker (the name of who goes on), event (described by text) and comment.
    """
    root, out, chunk = ET.fromstring(content), [], -1
    names = {s.get("id"): s.get("name") for s in root.iter("Speaker")}
    for turn in root.iter("Turn"):
        marks = [float(e.get("time")) for e in turn.iter("Sync")] + [float(turn.get("endTime"))]
        ids, at, pos = (turn.get("speaker") or "").split(), -1, 0
        for e in turn.iter():
            told = []
            if e.tag == "Sync":
                at, chunk, pos = at + 1, chunk + 1, 0
            elif e.tag == "Who":
                k = int(e.get("nb") or 1) - 1
                told.append(("speaker", names.get(ids[k], ids[k]) if k < len(ids) else None, None, None))
            elif e.tag == "Event":
                told.append(("event", e.get("desc") or "", e.get("type") or "noise", e.get("extent") or "instantaneous"))
            elif e.tag == "Comment":
                told.append(("comment", e.get("desc") or "", None, None))
            after = "" if e is turn else (e.tail or "").strip()
            told += [("text", after, None, None)] * bool(after)
            if at >= 0:
                out += [(chunk, marks[at], marks[at + 1], pos + k, *t) for k, t in enumerate(told)]
                pos += len(told)
    return out


ITEMS = "chunk long, start double, end double, pos long, kind string, text string, type string, extent string"


def transcriber(content: bytes) -> list[tuple]:
    """(turn, speaker, start, end, text, events) of a .trs file: an utterance for each Sync, and each Who behind it.

    An utterance ends where the next Sync is, the last one where the turn ends. Events are tags in the text.
    """
    root = ET.fromstring(content)
    names = {s.get("id"): s.get("name") for s in root.iter("Speaker")}
    out = []
    for k, turn in enumerate(root.iter("Turn")):
        ids = (turn.get("speaker") or "").split()
        end = float(turn.get("endTime"))
        chunks: list[list] = []
        who, at = 0, float(turn.get("startTime"))

        def add(text: str | None, event: str | None = None) -> None:
            if not chunks or chunks[-1][:2] != [at, who]:
                chunks.append([at, who, [], 0])
            if event:
                chunks[-1][2].append(f"[{event}]")
                chunks[-1][3] += 1
            if text and text.strip():
                chunks[-1][2].append(" ".join(text.split()))

        add(turn.text)
        for e in turn:
            if e.tag == "Sync":
                at, who = float(e.get("time")), 0
            elif e.tag == "Who":
                who = int(e.get("nb")) - 1
            elif e.tag == "Event":
                add(None, e.get("desc"))
            add(e.tail)
        times = sorted({c[0] for c in chunks}) + [end]
        for start, w, parts, events in chunks:
            if parts:
                speaker = names.get(ids[w], ids[w]) if w < len(ids) else None
                out.append((k, speaker, start, next(t for t in times if t > start or t == end), " ".join(parts), events))
    return out


TRANSCRIBER = "turn long, speaker string, start double, end double, text string, events long"


def decoded(content: bytes) -> str:
    """Text of unknown encoding: UTF-16 by its mark, else UTF-8, else Windows-1252."""
    if content[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return content.decode("utf-16")
    try:
        return content.decode("utf-8-sig")
    except UnicodeDecodeError:
        return content.decode("cp1252")


def textgrid(content: bytes) -> list[tuple]:
    """(tier, start, end, text) of a TextGrid's interval tiers, in the long or the short format."""
    text = decoded(content)
    values = re.findall(r'"((?:[^"]|"")*)"|(?<![\w"])(-?\d+(?:\.\d+)?)(?![\w"])|(<exists>)', re.sub(r"\[\d+\]|\w+ \[\d*\]:", " ", text))
    flat: list = [s.replace('""', '"') if not n and not x else float(n) if n else x for s, n, x in values]
    flat = flat[flat.index("<exists>") + 1 :] if "<exists>" in flat else flat
    out, i = [], 1
    for _ in range(int(flat[0])):
        kind, name, size = flat[i], flat[i + 1], int(flat[i + 4])
        i += 5
        for _ in range(size):
            if kind == "IntervalTier":
                out.append((name, flat[i], flat[i + 1], flat[i + 2]))
                i += 3
            else:
                i += 2
    return out


TEXTGRID = "tier string, start double, end double, text string"


def tei(content: bytes) -> list[tuple]:
    """(start, end, speaker, text) of a TEI transcript: the utterances between anchors, by the timeline's points."""
    root = ET.fromstring(content)
    name = lambda e: e.tag.rpartition("}")[2]
    ident = lambda e: e.get("{http://www.w3.org/XML/1998/namespace}id")
    times: dict[str, float] = {}
    for w in root.iter():
        if name(w) == "when" and ident(w):
            times[ident(w)] = float(w.get("interval") or 0) + times.get((w.get("since") or "").lstrip("#"), 0.0)
    out = []
    for u in root.iter():
        if name(u) != "u":
            continue
        at, parts = times.get((u.get("start") or "").lstrip("#")), [u.text or ""]
        for e in u:
            if name(e) == "anchor":
                t = times.get((e.get("synch") or "").lstrip("#"))
                if "".join(parts).strip():
                    out.append((at, t, (u.get("who") or "").lstrip("#"), " ".join("".join(parts).split())))
                at, parts = t, []
            else:
                parts.append("".join(e.itertext()))
            parts.append(e.tail or "")
        if "".join(parts).strip():
            out.append((at, times.get((u.get("end") or "").lstrip("#")), (u.get("who") or "").lstrip("#"), " ".join("".join(parts).split())))
    return out


TEI = "start double, end double, speaker string, text string"
