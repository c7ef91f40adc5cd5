"""Queries of §2.1 and §2.3 on annotated meetings: users are meetings, event types their speakers, events their words.

The annotation files are written from the events, a folder a meeting, in parts of bounded size, and read back by the parsers.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import meetings as G
from ..operators.ranking import running_total
from ..sources import markup as M
from ..sources.scratch import scratch
from .tables import query, table

ROOT = '<nite:root xmlns:nite="http://nite.sourceforge.net/">'

#: Ids that are counted together, and rows of a speaker's file (8 at least, see _events) or ids of a meeting's file in one part.
IDS, PART, SPAN = 100_000, 50_000, 1_000_000
#: How far the ids of linked sentences and acts lie apart at most.
REACH = 400

#: The words in SQL: every ninth is a mark, every seventh a contraction, every thirteenth a sound; some have no time.
WORDS = """evs as (select * replace (user_id % 25 as user_id) from events),
ev as (select *, row_number() over (partition by user_id, event_type order by event_id) - 1 as pos, count(*) over (partition by user_id, event_type) as size from evs),
words as (select user_id as meeting, event_type as agent, pos, event_id, case when event_id % 13 = 0 then '<vocalsound:laugh>' when event_id % 9 = 0 then '.' when event_id % 7 = 0 then '''s' else 'w' || event_id end as text,
 case when event_id % 10 = 3 then null else round(event_id * 0.01, 2) end::double as "start", case when event_id % 10 = 3 then null else round(event_id * 0.01 + 0.3 + floor(value) * 0.02, 2) end::double as "end",
 case when event_id % 13 <> 0 and event_id % 9 = 0 then 'left' end as "join", event_id % 13 <> 0 and event_id % 9 <> 0 as lex from ev)"""
#: Ranges of words: (kind, meeting, agent, owner, child, first and last place).
ACTS = """acts as (select user_id as meeting, event_type as agent, 'a' || event_id as owner, pos as lo, least(pos + event_id % 3, size - 1) as hi from ev where event_id % 2 = 0),
act_spans as (select a.meeting, a.owner as act, min(w."start") as s, max(w."end") as e from acts a join words w on w.meeting = a.meeting and w.agent = a.agent and w.pos between a.lo and a.hi group by all having s is not null and e is not null),
sentences as (select user_id as meeting, 'x' || event_id as sentence, case when event_id % 4 = 0 then 'decisions' else 'abstract' end as section, row_number() over (partition by user_id order by event_id % 4 = 0, event_id) - 1 as pos, 'About ' || event_type || ' ' || event_id || '.' as text from ev where event_id % 6 < 2),
links as (select s.meeting, s.sentence, 'a' || e.event_id as act from sentences s join ev e on e.user_id = s.meeting and e.event_id % 5 = substr(s.sentence, 2)::bigint % 5 and abs(e.event_id - substr(s.sentence, 2)::bigint) < 400),
linked as (select meeting, sentence, min(s) as s, max(e) as e from links join act_spans using (meeting, act) group by all)"""


def _id() -> Column:
    return F.col("event_id")


def _meetings(spark: SparkSession, d: str) -> DataFrame:
    """Events with their user's meeting, one of 25, as user_id."""
    return table(spark, d, "events").withColumn("user_id", F.col("user_id") % 25)


@cache
def _events(app: str, spark: SparkSession, d: str) -> DataFrame:
    """Events with their place in the file of their speaker, its part, and the up to 8 ids behind; written once in a session.

    Places are counted in buckets of ids. Parts know the first rows of the next one, so no task orders a whole file.
    """
    path, own = scratch(spark, "placed"), ["user_id", "event_type"]
    rows = _meetings(spark, d).select(*own, "event_id", "value")
    placed = running_total(rows, own, F.floor(F.col("event_id") / IDS), ["event_id"], None, "place")
    part = F.floor(F.col("place") / PART)
    shared = placed.withColumn("of", part).withColumn("part", F.explode(F.when(F.col("place") % PART < 8, F.array(part, part - 1)).otherwise(F.array(part))))
    behind = Window.partitionBy(*own, "part").orderBy("place").rowsBetween(1, 8)
    shared.withColumn("behind", F.collect_list("event_id").over(behind)).where("part = of").drop("of").write.parquet(path)
    return spark.read.parquet(path)


def _files(rows: DataFrame, by: list[str], head: str, line: Column, tail: str, name: str, order: list[str]) -> str:
    """A file for each group, with a line for each of its rows in order; the pattern of their paths.

    The groups are parts of a meeting's or a speaker's file, so no file and no task grows with the meeting.
    """
    path = scratch(rows.sparkSession, name)
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("__line")))), lambda s: s["__line"])
    whole = rows.groupBy(*by).agg(F.concat(F.lit(head), F.array_join(lines, ""), F.lit(tail)).alias("value"))
    whole.write.partitionBy(*by).text(path)
    return path + "".join(f"/{c}=*" for c in by)


def _part(c: str = "file") -> Column:
    return F.regexp_extract(c, r"/part=(\d+)/", 1).cast("long")


def _along(place: str) -> Column:
    """A number that rises along the parts of a file and inside them."""
    return _part() * (1 << 32) + F.col(place)


def links_of(said: DataFrame, events: DataFrame) -> DataFrame:
    """(user_id, x, a): the events a that a sentence x links to, less than REACH ids away and with the same rest by 5.

    Ids are dealt to bins of REACH; a sentence meets the bins in its reach, so no meeting has all its pairs tried.
    """
    bins = F.sequence(F.floor((F.col("x") - REACH) / REACH), F.floor((F.col("x") + REACH) / REACH))
    left = said.withColumn("rest", F.col("x") % 5).withColumn("bin", F.explode(bins))
    right = events.withColumn("rest", F.col("a") % 5).withColumn("bin", F.floor(F.col("a") / REACH))
    return left.join(right, ["user_id", "rest", "bin"]).where(F.abs(F.col("a") - F.col("x")) < REACH).select("user_id", "x", "a")


def _meeting(c: str = "file") -> Column:
    return F.regexp_extract(c, r"user_id=(\d+)", 1).cast("long").alias("meeting")


def _agent(c: str = "file") -> Column:
    return F.regexp_extract(c, r"event_type=(\w+)", 1)


def _href(agent: Column, first: Column, last: Column) -> Column:
    return F.concat(F.lit('<nite:child href="'), agent, F.lit(".words.xml#id(w"), first, F.lit(")..id(w"), last, F.lit(')"/>'))


@cache
def _written(app: str, spark: SparkSession, d: str, name: str) -> str:
    """The paths of the annotation files of one kind, of all meetings, written once in a session."""
    number = lambda x: F.format_string("%.2f", x)
    own, end = ["user_id", "event_type", "part"], "</nite:root>"
    if name == "channels":
        channels = scratch(spark, "channels")
        meeting = F.concat(F.lit('<meeting observation="'), F.col("user_id"), F.lit('">'), F.array_join(F.transform(F.array_sort(F.collect_set("event_type")), lambda a, i: F.when(a != "view", F.concat(F.lit('<speaker nxt_agent="'), a, F.lit('" channel="'), (i + F.col("user_id") % 3).cast("string"), F.lit('"/>'))).otherwise("")), ""), F.lit("</meeting>"))
        _meetings(spark, d).groupBy("user_id").agg(F.concat(F.lit("<root>"), meeting, F.lit("</root>")).alias("value")).write.partitionBy("user_id").text(channels)
        return channels + "/user_id=*"
    said = _meetings(spark, d).where("event_id % 6 < 2")
    of_meeting = F.floor(_id() / SPAN).alias("part")
    if name == "sentences":
        section = F.when(_id() % 4 == 0, "decisions").otherwise("abstract")
        sentence = F.concat(F.lit('<sentence nite:id="x'), _id(), F.lit('">About '), F.col("event_type"), F.lit(" "), _id(), F.lit(".</sentence>"))
        later = F.when(section == "decisions", 1 << 30).otherwise(0)  # the parts of the second section follow all of the first
        told = said.select("user_id", (of_meeting + later).alias("part"), section.alias("section"), "event_id", sentence.alias("line"))
        turn = told.select("user_id", "part").distinct().select("*", F.lit("decisions").alias("section"), F.lit(-1).cast("long").alias("event_id"), F.lit("</abstract><decisions>").alias("line"))
        return _files(told.unionByName(turn), ["user_id", "part"], ROOT + "<abstract>", F.col("line"), "</decisions>" + end, name, ["section", "event_id"])
    if name == "links":
        pairs = links_of(said.select("user_id", _id().alias("x")), _meetings(spark, d).select("user_id", _id().alias("a")))
        link = F.concat(F.lit('<summlink><nite:pointer role="extractive" href="d#id(a'), F.col("a"), F.lit(')"/><nite:pointer role="abstractive" href="s#id(x'), F.col("x"), F.lit(')"/></summlink>'))
        return _files(pairs.withColumn("part", F.floor(F.col("x") / SPAN)), ["user_id", "part"], ROOT, link, end, name, ["x", "a"])
    e = _events(app, spark, d)
    last = lambda n: F.coalesce(F.try_element_at(F.slice("behind", 1, n), F.lit(-1)), _id())
    if name == "words":
        time = F.when(_id() % 10 == 3, "").otherwise(F.concat(F.lit(' starttime="'), number(F.round(_id() * 0.01, 2)), F.lit('" endtime="'), number(F.round(_id() * 0.01 + 0.3 + F.floor("value") * 0.02, 2)), F.lit('"')))
        tag = lambda more, text: F.concat(F.lit('<w nite:id="w'), _id(), F.lit('"'), time, F.lit(more), text, F.lit("</w>"))
        sound = F.concat(F.lit('<vocalsound nite:id="w'), _id(), F.lit('" type="laugh"'), time, F.lit("/>"))
        word = F.when(_id() % 13 == 0, sound).when(_id() % 9 == 0, tag(' punc="true">', F.lit("."))).when(_id() % 7 == 0, tag(">", F.lit("'s"))).otherwise(tag(">", F.concat(F.lit("w"), _id())))
        return _files(e, own, ROOT, word, end, name, ["place"])
    if name == "segments":
        seg_time = F.when(_id() % 5 == 0, "").otherwise(F.concat(F.lit(' transcriber_start="'), number(F.round(_id() * 0.01 - 0.2, 2)), F.lit('" transcriber_end="'), number(F.round(_id() * 0.01 + 8, 2)), F.lit('"')))
        segs = e.withColumn("last", last(4)).withColumn("later", F.get("behind", F.lit(4))).where("place % 6 = 0")
        second = F.when(F.col("later").isNull(), "").otherwise(_href(F.col("event_type"), F.col("later"), F.col("later")))
        segment = F.concat(F.lit('<segment nite:id="s'), _id(), F.lit('"'), seg_time, F.lit(">"), _href(F.col("event_type"), _id(), F.col("last")), second, F.lit("</segment>"))
        return _files(segs, own, ROOT, segment, end, name, ["place"])
    if name == "acts":
        acts = e.withColumn("last", F.when(_id() % 3 == 0, _id()).when(_id() % 3 == 1, last(1)).otherwise(last(2))).where("event_id % 2 = 0")
        act = F.concat(F.lit('<dact nite:id="a'), _id(), F.lit('">'), _href(F.col("event_type"), _id(), F.col("last")), F.lit("</dact>"))
        return _files(acts, own, ROOT, act, end, name, ["place"])
    tops = e.withColumn("last", last(8)).where("place % 9 = 0").withColumn("part", of_meeting)
    topic = F.concat(F.lit('<topic nite:id="t'), _id(), F.lit('" other_description="'), F.col("event_type"), F.lit('">'), _href(F.col("event_type"), _id(), F.col("last")), F.lit("</topic>"))
    return _files(tops, ["user_id", "part"], ROOT, topic, end, name, ["event_id"])


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    parsers = {"words": (M.nxt_raw_words, M.WORDS), "sentences": (M.nxt_abstracts, M.ABSTRACTS), "links": (M.nxt_links, M.LINKS), "channels": (M.nxt_channels, M.CHANNELS)}
    parse, schema = parsers.get(name, (M.nxt_ranges, M.RANGES))
    rows = M.parsed(spark, _written(spark.sparkContext.applicationId, spark, d, name), parse, schema)
    if name == "words":
        return rows.select(_meeting(), F.concat(_agent(), F.lit(".words.xml")).alias("file"), "id", (_part() * PART + F.col("pos")).alias("pos"), "text", "start", "end", "join", "lex")
    if name == "segments":
        return rows.select(_meeting(), _agent().alias("agent"), "owner", "child", "start", "end", F.col("words_file").alias("file"), "first_word", "last_word")
    if name in ("acts", "topics"):
        return rows.select(_meeting(), "owner", _along("ordinal").alias("ordinal"), "label", F.col("words_file").alias("file"), "first_word", "last_word")
    if name == "sentences":
        return rows.select(_meeting(), F.col("id").alias("sentence"), "section", _along("pos").alias("pos"), "text")
    if name == "links":
        return rows.select(_meeting(), "sentence", "act")
    return rows.select(F.col("meeting").cast("long").alias("meeting"), "agent", "channel")


def _mixes(spark: SparkSession, d: str) -> DataFrame:
    return _meetings(spark, d).groupBy(F.col("user_id").alias("meeting")).agg((F.max("event_id") * 0.01).alias("length"))


@query("""select user_id as meeting, event_type as agent, (row_number() over (partition by user_id order by event_type) - 1 + user_id % 3)::int as channel from (select distinct user_id % 25 as user_id, event_type from events) qualify event_type <> 'view'""")
def channel_map(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "channels")


@query(rf"""with recursive {WORDS},
seg as (select user_id as meeting, event_type as agent, 's' || event_id as owner, pos as lo, least(pos + 4, size - 1) as hi, case when pos + 5 < size then pos + 5 end as later, case when event_id % 5 = 0 then null else round(event_id * 0.01 - 0.2, 2) end::double as s, case when event_id % 5 = 0 then null else round(event_id * 0.01 + 8, 2) end::double as e from ev where pos % 6 = 0),
sw as (select seg.meeting, seg.agent, owner, seg.s, seg.e, w.*, row_number() over (partition by seg.meeting, owner order by w.pos) as k from seg join words w on w.meeting = seg.meeting and w.agent = seg.agent and (w.pos between lo and hi or w.pos = later)),
own as (select meeting, owner, agent, coalesce(min(s), min("start")) as s, coalesce(max(e), max("end")) as e, count(*) as n from sw group by all having bool_or(lex) and e > s),
pauses as (select meeting, owner, k, "start" - before as gap, (before + "start") / 2 as at, before_k from (select *, lag("end") over o as before, lag(k) over o as before_k from sw where "start" is not null and "end" is not null window o as (partition by meeting, owner order by k)) where before is not null),
p(meeting, owner, path, s, e, lo, hi, done) as (
 select meeting, owner, '', s, e, 1::bigint, n + 1, false from own
 union all
 select meeting, owner, u.path, u.s, u.e, u.lo, u.hi, u.done from (
  select p.meeting, p.owner, unnest(case when any_value(x.k) is null then [struct_pack(path := p.path, s := p.s, e := p.e, lo := p.lo, hi := p.hi, done := true)]
   else [struct_pack(path := p.path || '0', s := p.s, e := arg_max(x.at, (x.gap, -x.k)), lo := p.lo, hi := arg_max(x.k, (x.gap, -x.k)), done := false), struct_pack(path := p.path || '1', s := arg_max(x.at, (x.gap, -x.k)), e := p.e, lo := arg_max(x.k, (x.gap, -x.k)), hi := p.hi, done := false)] end) as u
  from p left join pauses x on x.meeting = p.meeting and x.owner = p.owner and p.e - p.s > 4 and x.before_k >= p.lo and x.k > p.lo and x.k < p.hi and x.at - p.s >= 1 and p.e - x.at >= 1
  where not p.done group by p.meeting, p.owner, p.path, p.s, p.e, p.lo, p.hi)),
piece as (select *, row_number() over (partition by meeting, owner order by lo) - 1 as piece, count(*) over (partition by meeting, owner) as n_pieces from p where done),
told as (select piece.meeting, piece.owner, piece.piece, n_pieces, piece.s, piece.e, w.k, w.text, w.agent, w."join", lag(w.text) over (partition by piece.meeting, piece.owner, piece.piece order by w.k) as before from piece join sw w on w.meeting = piece.meeting and w.owner = piece.owner and w.k >= piece.lo and w.k < piece.hi),
glued as (select *, case when row_number() over (partition by meeting, owner, piece order by k) = 1 or "join" = 'left' or text = '''s' then '' else ' ' end as gap from told where not (text like '<%' and before is not distinct from text)),
texts as (select meeting, owner, piece, trim(string_agg(gap || text, '' order by k)) as text from glued group by all)
select case when n_pieces = 1 then owner else owner || '.' || piece end as id, meeting, agent, meeting || '.Headset-' || case when agent = 'view' then 21 else (select count(distinct event_type) from evs v where v.user_id = g.meeting and v.event_type < g.agent) + meeting % 3 end || '.wav' as audio,
 round(s, 3) as "offset", round(e - s, 3) as duration, text from (select distinct meeting, owner, agent, piece, n_pieces, s, e from told) g join texts using (meeting, owner, piece) where e - s between 0.5 and 4""")
def meeting_speaker_rows(spark: SparkSession, d: str) -> DataFrame:
    return G.speaker_rows(_read(spark, d, "segments"), _read(spark, d, "words"), _read(spark, d, "channels"), 0.5, 4.0)


@query(f"""with {WORDS}, {ACTS}, c as (select meeting, sentence, count(*) as n_acts from links group by all), mix as (select user_id as meeting, max(event_id) * 0.01::double as length from evs group by all)
select sentence as id, meeting, section, n_acts, round(s, 3) as "offset", round(least(e, length) - s, 3) as duration, text from linked join sentences using (meeting, sentence) join c using (meeting, sentence) join mix using (meeting) where least(e, length) - s between 0.2 and 6""")
def meeting_sentence_rows(spark: SparkSession, d: str) -> DataFrame:
    return G.sentence_rows(_read(spark, d, "sentences"), _read(spark, d, "links"), _read(spark, d, "acts"), _read(spark, d, "words"), _mixes(spark, d), 0.2, 6.0)


def _topics_sql(per_section: bool) -> str:
    section = "section" if per_section else "null::varchar"
    return f"""with {WORDS}, {ACTS}, mix as (select user_id as meeting, max(event_id) * 0.01::double as length from evs group by all),
tr as (select user_id as meeting, event_type as agent, 't' || event_id as topic, event_id, event_type as label, pos as lo, least(pos + 8, size - 1) as hi from ev where pos % 9 = 0),
topics as (select tr.meeting, topic, tr.event_id, label, min(w."start") as ts, max(w."end") as te from tr join words w on w.meeting = tr.meeting and w.agent = tr.agent and w.pos between lo and hi group by all having ts is not null and te is not null),
dealt as (select l.meeting, sentence, topic from linked l join topics t on t.meeting = l.meeting and l.s < t.te and t.ts < l.e qualify row_number() over (partition by l.meeting, sentence order by least(l.e, te) - greatest(l.s, ts) desc, event_id) = 1),
texts as (select meeting, topic, {section} as section, count(*)::int as n_sentences, string_agg(text, ' ' order by pos) as text from dealt join sentences using (meeting, sentence) group by meeting, topic{", section" if per_section else ""})
select topic{" || '.' || x.section" if per_section else ""} as id, meeting, topic, x.section, label, n_sentences, round(ts, 3) as "offset", round(least(te, length) - ts, 3) as duration, text from topics join texts x using (meeting, topic) join mix using (meeting) where least(te, length) - ts between 5 and 300"""


@query(_topics_sql(False))
def meeting_topic_rows(spark: SparkSession, d: str) -> DataFrame:
    return _topic_rows(spark, d, False)


@query(_topics_sql(True))
def meeting_topic_sections(spark: SparkSession, d: str) -> DataFrame:
    return _topic_rows(spark, d, True)


def _topic_rows(spark: SparkSession, d: str, per_section: bool) -> DataFrame:
    return G.topic_rows(*(_read(spark, d, n) for n in ("topics", "sentences", "links", "acts", "words")), _mixes(spark, d), 5.0, 300.0, per_section, 10.0)


@query(f"""with {WORDS}, {ACTS} select a.meeting, a.owner, w.text, w.pos from acts a join words w on w.meeting = a.meeting and w.agent = a.agent and w.pos between a.lo and a.hi""")
def reference_range_join(spark: SparkSession, d: str) -> DataFrame:
    """The words that each dialogue act refers to, by the first and the last one's id."""
    return G.range_words(_read(spark, d, "acts"), _read(spark, d, "words")).select("meeting", "owner", "text", "pos")


@query(f"""with {WORDS}, {ACTS} select meeting, sentence, round(s, 2) as span_start, round(e, 2) as span_end from linked""")
def link_table_span(spark: SparkSession, d: str) -> DataFrame:
    """The time of each summary sentence, over the acts that links give it."""
    out = G.linked_spans(_read(spark, d, "links"), _read(spark, d, "acts"), _read(spark, d, "words"))
    return out.select("meeting", "sentence", F.round("start", 2).alias("span_start"), F.round("end", 2).alias("span_end"))
