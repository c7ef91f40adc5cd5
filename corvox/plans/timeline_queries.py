"""Queries of §2.5 and §2.6 on intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_u
from ..operators import timeline as L
from .tables import query, segments, segments_sql, table

HOUR = 3600.0
DAY = 86400.0


def _r(*names: str):  # noqa: ANN202
    return [F.round(n, 3).alias(n) for n in names]


@query(f"""with {segments_sql()}, p as (select *, max(struct_pack(e := "end", s := "start", i := seg_id)) over (partition by recording order by "start", "end", seg_id rows between unbounded preceding and 1 preceding) as m from segments)
select recording, round(m.e, 3) as gap_start, round("start", 3) as gap_end, round("start" - m.e, 3) as gap, m.i as previous_id, seg_id as next_id from p where m is not null and "start" - m.e between 60 and 7200""")
def gap_finder(spark: SparkSession, d: str) -> DataFrame:
    return L.gaps(segments(spark, d), 60.0, 2 * HOUR).select("recording", *_r("gap_start", "gap_end", "gap"), "previous_id", "next_id")


MERGE = """, a as (select *, case when lag(speaker) over w is distinct from speaker then 1 else 0 end as c from {s} window w as (partition by recording order by "start", "end", seg_id)),
b as (select *, sum(c) over (partition by recording order by "start", "end", seg_id) as run from a),
c as (select *, max("end") over (partition by recording, run order by "start", "end", seg_id rows between unbounded preceding and 1 preceding) as e from b),
i as (select *, sum(case when e is null or "start" - e > {gap} then 1 else 0 end) over (partition by recording order by "start", "end", seg_id) as island from c)
select recording, island::bigint as island, speaker, round(min("start"), 3) as "start", round(max("end"), 3) as "end", count(*) as n_segments, string_agg(text, ' ' order by "start", "end", seg_id) as text from i group by recording, island, speaker"""


@query(f"with {segments_sql()}" + MERGE.format(s="segments", gap=36000.0))
def same_speaker_merge(spark: SparkSession, d: str) -> DataFrame:
    return L.merge_same_speaker(segments(spark, d), 10 * HOUR).select("recording", "island", "speaker", *_r("start", "end"), "n_segments", "text")


@query(f"""with {segments_sql()}, a as (select *, case when "start" - lag("end") over w < 36000 then 0 else 1 end as n from segments window w as (partition by recording order by "start", "end", seg_id)),
b as (select *, sum(n) over (partition by recording order by "start", "end", seg_id) as run from a)
select recording, run::bigint as run, round(min("start"), 3) as "start", round(max("end"), 3) as "end", count(*) as n_segments from b group by recording, run having count(*) >= 2""")
def neighbour_runs(spark: SparkSession, d: str) -> DataFrame:
    return L.neighbour_runs(segments(spark, d), 10 * HOUR).select("recording", "run", *_r("start", "end"), "n_segments")


PAIRS = """select a.recording, a.seg_id as a_id, b.seg_id as b_id, a.speaker as a_speaker, b.speaker as b_speaker, a."start" as a_start, b."start" as b_start, least(a."end", b."end") - greatest(a."start", b."start") as overlap
 from segments a join segments b on a.recording = b.recording and a."start" < b."end" and b."start" < a."end\""""


@query(f"with {segments_sql(600)} select recording, a_id, b_id, round(overlap, 3) as overlap from ({PAIRS}) where a_id < b_id")
def interval_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d, 600.0)
    return L.overlaps(s, s, DAY).where("a_id < b_id").select("recording", "a_id", "b_id", *_r("overlap"))


@query(f"""with {segments_sql(600)}, o as (select recording, a_id, sum(overlap) as other from ({PAIRS}) where a_speaker <> b_speaker group by all)
select s.recording, s.seg_id, round(coalesce(o.other, 0), 2) as other, coalesce(o.other, 0) <= 3600 as kept from segments s left join o on o.recording = s.recording and o.a_id = s.seg_id""")
def other_speaker_leakage(spark: SparkSession, d: str) -> DataFrame:
    return L.other_speech(segments(spark, d, 600.0), DAY).select("recording", "seg_id", F.round("other", 2).alias("other"), (F.col("other") <= HOUR).alias("kept"))


@query(f"""with {segments_sql(600)}, p as ({PAIRS.replace('segments b', "(select * from segments where speaker = 'click') b").replace('segments a', "(select * from segments where speaker <> 'click') a")})
select recording, seg_id, topic_id, overlap from (select recording, a_id as seg_id, b_id as topic_id, round(overlap, 3) as overlap, row_number() over (partition by recording, a_id order by overlap desc, b_start, b_id) as rn from p) where rn = 1""")
def best_overlap_assignment(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d, 600.0)
    return L.best_overlap(s.where("speaker <> 'click'"), s.where("speaker = 'click'"), DAY).select("recording", "seg_id", "topic_id", *_r("overlap"))


@query(f"""with {segments_sql(60)}, w as (select recording, seg_id, "start" as w_start, "start" + 86400 as w_end from segments),
p as (select w.recording, w.seg_id as window_id, c.* exclude (recording) from w join segments c on c.recording = w.recording and c."start" >= w_start and c."end" <= w_end)
select recording, window_id, count(*) as n_cues, string_agg(text, ' ' order by "start", "end", seg_id) as text from p group by all""")
def cue_containment(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d)
    windows = s.withColumn("end", F.col("start") + DAY)
    return L.window_text(L.contained(s, windows, DAY))


@query(f"""with {segments_sql()}, p as (select recording, seg_id as point_id, "start" + (seg_id % 5) * 400.0 as pt from segments),
n as (select p.recording, point_id, seg_id as cue_id, case when abs(pt - "start") <= 0 then 0 when abs(pt - "start") <= 600 then 1 else 2 end as step, abs(pt - "start") as off, "start" from p join segments s on s.recording = p.recording and abs(pt - "start") <= 1200)
select recording, point_id, cue_id, step from (select *, row_number() over (partition by recording, point_id order by step, off, "start", cue_id) as rn from n) where rn = 1""")
def nearest_key_lookup(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d)
    points = s.select("recording", F.col("seg_id").alias("point_id"), (F.col("start") + (F.col("seg_id") % 5) * 400.0).alias("at"))
    return L.nearest_within(points, s, [0.0, 600.0, 1200.0])


@query(f"""with {segments_sql()}, w as (select *, floor("start" / 864000)::bigint as "window" from segments), f as (select *, min(struct_pack(a := "start", b := "end", c := seg_id)) over (partition by recording, "window", speaker) as f, min("start") over (partition by recording, "window") as b0 from w)
select recording, seg_id, dense_rank() over (partition by recording, "window" order by f)::int as speaker_no, round_even("start" - b0, 2) as rel_start, round_even("end" - b0, 2) as rel_end from f""")
def relative_relabel(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).withColumn("window", F.floor(F.col("start") / (10 * DAY)))
    return L.relabelled(s, "window").select("recording", "seg_id", "speaker_no", "rel_start", "rel_end")


@query(f"""with {segments_sql()}, x as (select recording, seg_id, floor("start" / 3600) as "start", floor("end" / 3600) as "end" from segments)
select recording, min(seg_id) as seg_id from x group by recording, round_even("start", 3), round_even("end", 3)""")
def window_dedup(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).withColumn("start", F.floor(F.col("start") / HOUR).cast("double")).withColumn("end", F.floor(F.col("end") / HOUR).cast("double"))
    return L.deduplicated_windows(s).select("recording", "seg_id")


@query(f"""with recursive {segments_sql()}, o as (select *, row_number() over (partition by recording order by "start", "end", seg_id) as k from segments),
g as (select recording, seg_id, k, 1::bigint as "window", "start" as b, 1 as n from o where k = 1
 union all select o.recording, o.seg_id, o.k, case when o."end" - g.b > 864000 or g.n >= 10 then g."window" + 1 else g."window" end, case when o."end" - g.b > 864000 or g.n >= 10 then o."start" else g.b end, case when o."end" - g.b > 864000 or g.n >= 10 then 1 else g.n + 1 end
 from g join o on o.recording = g.recording and o.k = g.k + 1) select recording, seg_id, "window" from g""")
def greedy_windowing(spark: SparkSession, d: str) -> DataFrame:
    return L.greedy_windows(segments(spark, d), 10 * DAY, 10).select("recording", "seg_id", "window")


@query(f"""with recursive {segments_sql()}, o as (select recording, seg_id, "start" as s, "end" as e, row_number() over (partition by recording order by "start", "end", seg_id) as k, ('0x' || substr(md5('stop:' || recording || ':' || seg_id), 1, 8))::bigint / 4294967296.0::double as u from segments),
f(recording, k, seg_id, cid, s, till, dur, n, closed) as (
 select recording, k, seg_id, 1::bigint, s, e, e - s, 1::bigint, e - s >= 3600 and u < 0.05 from o where k = 1
 union all
 select recording, k, seg_id, cid + fresh::int, case when fresh then s else began end, case when fresh then e else greatest(till, e) end, case when fresh then e - s else dur + e - s end, case when fresh then 1 else n + 1 end,
  case when fresh then e - s else dur + e - s end >= 3600 and u < case when fresh then 0.05 else 0.1 end from (
  select o.recording, o.k, o.seg_id, o.s, o.e, o.u, f.cid, f.s as began, f.till, f.dur, f.n, f.closed or o.s - f.till > 86400 or f.dur + o.e - o.s > 18000 as fresh from f join o on o.recording = f.recording and o.k = f.k + 1)),
c as (select recording, cid, min(s) as s, arg_max(till, k) as e, arg_max(dur, k) as d, string_agg(seg_id, ',' order by k) as ids from f group by all having arg_max(dur, k) between 3600 and 18000)
select recording, row_number() over (partition by recording order by cid) - 1 as chain, round(s, 3) as "start", round(e, 3) as "end", round(d, 3) as duration, ids from c""")
def chain_planner(spark: SparkSession, d: str) -> DataFrame:
    u = hash_u("stop", "recording", "seg_id")
    out = L.chains(segments(spark, d), DAY, 5 * HOUR, HOUR, u < 0.1, u < 0.05)
    rounded = (F.round(c, 3).alias(c) for c in ("start", "end", "duration"))
    return out.select("recording", "chain", *rounded, F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


#: Turns of ten days: their words are the events in them, and pieces of them.
TURNS = f"""{segments_sql(1.0)}, w as (select recording, floor("start" / 864000)::bigint as seg_id, "start" as s, "end" as e, speaker as t, row_number() over (partition by recording, floor("start" / 864000) order by "start", "end", speaker) as k, count(*) over (partition by recording, floor("start" / 864000)) as n from segments)"""
GREEDY = """g(recording, seg_id, k, piece, b) as (select recording, seg_id, k, 0::bigint, s from w where k = 1
 union all select w.recording, w.seg_id, w.k, case when w.e - g.b > {0} then g.piece + 1 else g.piece end, case when w.e - g.b > {0} then w.s else g.b end from g join w on w.recording = g.recording and w.seg_id = g.seg_id and w.k = g.k + 1)"""


def _turns(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d, 1.0)
    word = F.struct("start", "end", F.col("speaker").alias("text"))
    return s.groupBy("recording", F.floor(F.col("start") / (10 * DAY)).alias("seg_id")).agg(F.array_sort(F.collect_list(word)).alias("words"))


@query(f"""with recursive {TURNS}, {GREEDY.format(172800)}, whole as (select recording, seg_id, min(s) as s, arg_max(e, k) as e, string_agg(t, ' ' order by k) as text from w group by all),
p as (select recording, seg_id, 0::bigint as piece, s, e, text from whole where e - s <= 172800
 union all select recording, seg_id, piece, min(s), max(e), string_agg(t, ' ' order by k) from g join w using (recording, seg_id, k) join (select recording, seg_id from whole where e - s > 172800) using (recording, seg_id) group by all),
o as (select *, row_number() over (partition by recording order by s, e, seg_id, piece) as j from p),
v(recording, j, win, b, n) as (select recording, j, 1::bigint, s, 1::bigint from o where j = 1
 union all select o.recording, o.j, case when fresh then v.win + 1 else v.win end, case when fresh then o.s else v.b end, case when fresh then 1 else v.n + 1 end
 from v join o on o.recording = v.recording and o.j = v.j + 1, lateral (select o.e - v.b > 172800 or v.n >= 20 as fresh))
select o.recording, o.seg_id, o.piece, 'sp' || o.seg_id % 3 as speaker, round(o.s, 3) as "start", round(o.e, 3) as "end", o.text, v.win as "window" from o join v using (recording, j)""")
def turn_windows(spark: SparkSession, d: str) -> DataFrame:
    """Turns of up to ten days, cut at their words where they last over two days, in windows of two days and 20 pieces."""
    words = F.col("words")
    turns = _turns(spark, d).select(
        "recording", "seg_id", F.concat(F.lit("sp"), F.col("seg_id") % 3).alias("speaker"), F.get(words, F.lit(0))["start"].alias("start"), F.element_at(words, -1)["end"].alias("end"),
        F.array_join(F.transform(words, lambda w: w["text"]), " ").alias("text"), "words",
    )
    out = L.turn_windows(turns, 2 * DAY, 20)
    return out.select("recording", "seg_id", "piece", "speaker", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "text", "window")


@query(f"""with recursive {TURNS}, {GREEDY.format(86400)} select recording, seg_id, piece, round(min(s), 3) as "start", round(max(e), 3) as "end" from g join w using (recording, seg_id, k) group by recording, seg_id, piece""")
def long_turn_split(spark: SparkSession, d: str) -> DataFrame:
    return L.pieces(_turns(spark, d), DAY).select("recording", "seg_id", "piece", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query(f"""with recursive {TURNS}, pauses as (select a.recording, a.seg_id, a.k, b.s - a.e as gap, (a.e + b.s) / 2 as mid from w a join w b on b.recording = a.recording and b.seg_id = a.seg_id and b.k = a.k + 1),
p(recording, seg_id, path, s, e, lo, hi, done) as (
 select recording, seg_id, '', min(s), arg_max(e, k), 1::bigint, max(n), false from w group by recording, seg_id
 union all
 select recording, seg_id, u.path, u.s, u.e, u.lo, u.hi, u.done from (
  select p.recording, p.seg_id, unnest(case when any_value(x.k) is null then [struct_pack(path := p.path, s := p.s, e := p.e, lo := p.lo, hi := p.hi, done := true)]
   else [struct_pack(path := p.path || '0', s := p.s, e := arg_max(x.mid, (x.gap, -x.k)), lo := p.lo, hi := arg_max(x.k, (x.gap, -x.k)), done := false), struct_pack(path := p.path || '1', s := arg_max(x.mid, (x.gap, -x.k)), e := p.e, lo := arg_max(x.k, (x.gap, -x.k)) + 1, hi := p.hi, done := false)] end) as u
  from p left join pauses x on x.recording = p.recording and x.seg_id = p.seg_id and p.e - p.s > 172800 and x.k >= p.lo and x.k < p.hi and x.mid - p.s >= 1 and p.e - x.mid >= 1
  where not p.done group by p.recording, p.seg_id, p.path, p.s, p.e, p.lo, p.hi))
select recording, seg_id, row_number() over (partition by recording, seg_id order by lo) - 1 as piece, round(s, 3) as "start", round(e, 3) as "end" from p where done""")
def longest_pause_split(spark: SparkSession, d: str) -> DataFrame:
    return L.pieces(_turns(spark, d), 2 * DAY, at_pauses=True).select("recording", "seg_id", "piece", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query(f"""with {segments_sql()} select recording, count(*) as n, round(max("start" - lag_end), 3) as longest_pause, round(count(*) / (max("end") - min("start")), 9) as rate from (select *, lag("end") over (partition by recording order by "start", "end", seg_id) as lag_end from segments) group by recording""")
def pauses_and_rates(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    s = segments(spark, d).withColumn("lag_end", F.lag("end").over(Window.partitionBy("recording").orderBy(*L.ORDER)))
    return s.groupBy("recording").agg(F.count(F.lit(1)).alias("n"), F.round(F.max(F.col("start") - F.col("lag_end")), 3).alias("longest_pause"), F.round(F.count(F.lit(1)) / (F.max("end") - F.min("start")), 9).alias("rate"))


@query("""with m as (select event_type, list_sort(list(value))[count(*) // 2 + 1] as med from events where value > 1 group by event_type)
select e.event_id from events e join m using (event_type) where value >= med / 4 and value <= med * 4""")
def median_rate_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Rows within a factor 4 of the upper middle value of their group, which a rank finds without collecting the group."""
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    n = e.where("value > 1").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.expr("percentile_disc(0.5) within group (order by value)").alias("low"), F.expr("percentile_disc(0.5) within group (order by value desc)").alias("high"))
    med = n.select("event_type", F.when(F.col("n") % 2 == 0, F.col("high")).otherwise(F.col("low")).alias("med"))
    return e.join(med, "event_type").where((F.col("value") >= F.col("med") / 4) & (F.col("value") <= F.col("med") * 4)).select("event_id")


@query(f"""with {segments_sql()}, named as (select recording, 's' || seg_id // 10 || case when seg_id % 10 = 0 then '' else '_cut' || lpad((seg_id % 10)::varchar, 2, '0') end as id, "start", "end" from segments)
select recording, regexp_extract(id, '^(.*)_cut[0-9]+$', 1) as parent, round(min("start"), 3) as "start", round(max("end"), 3) as "end", count(*) as pieces from named where regexp_matches(id, '_cut[0-9]+$') group by recording, parent""")
def parent_windows(spark: SparkSession, d: str) -> DataFrame:
    """The windows of the segments that pieces were cut from, by the pieces' ids; what wasn't cut has none."""
    number = F.col("seg_id") % 10
    name = F.concat(F.lit("s"), F.floor(F.col("seg_id") / 10), F.when(number == 0, "").otherwise(F.concat(F.lit("_cut"), F.lpad(number.cast("string"), 2, "0"))))
    out = L.parent_windows(segments(spark, d).withColumn("seg_id", name))
    return out.select("recording", "parent", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "pieces")


@query(f"""with {segments_sql()} select recording, seg_id, round(coalesce(lead("start") over (partition by recording order by "start", "end", seg_id), "end"), 3) as until from segments""")
def utterance_end_inference(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    nxt = F.lead("start").over(Window.partitionBy("recording").orderBy(*L.ORDER))
    return segments(spark, d).select("recording", "seg_id", F.round(F.coalesce(nxt, F.col("end")), 3).alias("until"))


@query("""select page_id, policy from (select page_id, policy, row_number() over (partition by page_id order by length(m) desc, m) as rn from pages join (values ('http', 'web'), ('/a', 'a'), ('e', 'e'), ('.com', 'com'), ('https://', 'secure')) v(m, policy) on contains(url, m)) where rn = 1""")
def longest_substring_policy(spark: SparkSession, d: str) -> DataFrame:
    """The longest policy text that a path holds; the registry is a short configured list, so it is compiled, longest first."""
    policies = [("http", "web"), ("/a", "a"), ("e", "e"), (".com", "com"), ("https://", "secure")]
    cond = None
    for m, p in sorted(policies, key=lambda x: (-len(x[0]), x[0])):
        cond = F.when(F.col("url").contains(m), p) if cond is None else cond.when(F.col("url").contains(m), p)
    return table(spark, d, "pages").select("page_id", cond.alias("policy")).where("policy is not null")
