"""Queries of §2.8 on ordered transcript items and on words with damaged letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as E
from ..operators import rebuild as R
from ..operators import similarity as S
from ..sources import markup as M
from ..sources.scratch import scratch
from .tables import query, table

#: Transcripts: a turn for each event of a user, with two time marks, a speaker, two sounds, a comment and a pronunciation.
SAID = """ev as (select *, row_number() over (partition by user_id order by event_id) - 1 as turn, (event_id % 1000)::double as t from events),
item(user_id, chunk, pos, s, e, kind, said, type, extent) as (
 select user_id, 2 * turn, 0, t, t + 1, 'speaker', 'Ann', null, null from ev
 union all select user_id, 2 * turn, 1, t, t + 1, 'text', event_type || ' /' || event_id || ', b/', null, null from ev
 union all select user_id, 2 * turn, 2, t, t + 1, 'event', case event_id % 5 when 0 then 'rire' when 1 then 'b' when 2 then 'pause' when 3 then 'TX' else 'porte' end, 'noise', case when event_id % 7 = 0 then 'begin' else 'instantaneous' end from ev
 union all select user_id, 2 * turn, 3, t, t + 1, 'event', case event_id % 5 when 0 then 'rires' when 1 then 'b' else 'bip' end, 'noise', case when event_id % 7 = 0 then 'end' else 'instantaneous' end from ev
 union all select user_id, 2 * turn, 4, t, t + 1, 'comment', 'note', null, null from ev
 union all select user_id, 2 * turn + 1, 0, t + 1, t + 2, 'text', case when event_id % 3 = 0 then '? oh' else 'next' end, null, null from ev
 union all select user_id, 2 * turn + 1, 1, t + 1, t + 2, 'event', case when event_id % 2 = 0 then 'pi' else 'sic' end, 'pronounce', 'instantaneous' from ev)"""
ALTERNATIVES = "replace(regexp_replace(regexp_replace({0}, '/\\s*0\\s*,[^/]*/', '', 'g'), '/([^/,]*),[^/]*/', '\\1', 'g'), '/', ' ')"


def _items(spark: SparkSession, d: str) -> DataFrame:
    """(recording, chunk, start, end, pos, kind, text, type, extent): the transcripts, written as files and read back."""
    i, t = F.col("event_id"), (F.col("event_id") % 1000)
    extent = F.when(i % 7 == 0, "begin").otherwise("instantaneous")
    sound = lambda what, extent: F.concat(F.lit('<Event type="noise" desc="'), what, F.lit('" extent="'), extent, F.lit('"/>'))
    first = F.when(i % 5 == 0, "rire").when(i % 5 == 1, "b").when(i % 5 == 2, "pause").when(i % 5 == 3, "TX").otherwise("porte")
    second = F.when(i % 5 == 0, "rires").when(i % 5 == 1, "b").otherwise("bip")
    line = F.concat(
        F.lit('<Turn speaker="s1" startTime="'), t, F.lit('" endTime="'), t + 2, F.lit('">early<Sync time="'), t, F.lit('"/><Who nb="1"/>'), F.col("event_type"), F.lit(" /"), i, F.lit(", b/"), sound(first, extent),
        sound(second, F.when(i % 7 == 0, "end").otherwise("instantaneous")), F.lit('<Comment desc="note"/><Sync time="'), t + 1, F.lit('"/>'), F.when(i % 3 == 0, "? oh").otherwise("next"),
        F.lit('<Event type="pronounce" desc="'), F.when(i % 2 == 0, "pi").otherwise("sic"), F.lit('"/></Turn>'),
    )
    lines = F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))), lambda s: s["line"])
    head = '<Trans><Speakers><Speaker id="s1" name="Ann"/></Speakers><Episode><Section>'
    whole = table(spark, d, "events").groupBy("user_id").agg(F.concat(F.lit(head), F.array_join(lines, ""), F.lit("</Section></Episode></Trans>")).alias("value"))
    path = scratch(spark, "items")
    whole.write.partitionBy("user_id").text(path)
    rows = M.parsed(spark, f"{path}/user_id=*", M.transcriber_items, M.ITEMS)
    return rows.select(F.regexp_extract("file", r"user_id=(\d+)", 1).cast("long").alias("recording"), "chunk", "start", "end", "pos", "kind", "text", "type", "extent")


@query(f"""with {SAID} select user_id as recording, chunk, pos, s as "start", e as "end", kind, said as text, type, extent from item""")
def transcript_items(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d)


@query(rf"""with {SAID}, win as (select user_id as recording, event_id as seg_id, t as a, t + case when event_id % 4 = 0 then 5 else 2 end as b from ev where event_id % 2 = 0),
tokens as (select recording, seg_id, s, chunk, pos, case kind when 'text' then {ALTERNATIVES.format('said')} when 'comment' then null when 'speaker' then null
  else case when extent = 'end' then null when type = 'noise' then case lower(said) when 'rire' then '[laughter]' when 'rires' then '[laughter]' when 'b' then '[noise]' when 'pause' then null when 'tx' then '[cough]' when 'bip' then '[beep]' else '[noise]' end when said = 'pi' then '[inaudible]' end end as token
 from win join item on user_id = recording and s >= a - 0.01 and e <= b + 0.01),
whole as (select recording, seg_id, trim(regexp_replace(string_agg(nullif(token, ''), ' ' order by s, chunk, pos), '\s+', ' ', 'g')) as text, count(*)::int as n from tokens group by all),
marks as (select *, string_split(text, ' ') as w from whole)
select recording, seg_id, n as n_items, regexp_replace(array_to_string(list_filter(list_transform(range(1, len(w) + 1), lambda i: case when i > 1 and w[i] = w[i - 1] and regexp_matches(w[i], '^\[[a-z]+\]$') then null else w[i] end), lambda x: x is not null), ' '), '\s+([?!])', ' \1', 'g') as text from marks""")
def event_rendering(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    start = (i % 1000).cast("double")
    windows = table(spark, d, "events").where("event_id % 2 = 0").select(F.col("user_id").alias("recording"), i.alias("seg_id"), start.alias("start"), (start + F.when(i % 4 == 0, 5).otherwise(2)).alias("end"))
    out = E.window_items(windows, _items(spark, d), 30.0)
    return out.select("recording", "seg_id", F.size("items").alias("n_items"), E.rendered(F.col("items"), clean=E.alternatives).alias("text"))


#: Every third accented letter of a text is damaged, in the documents whose id is no multiple of 3.
DAMAGED = """damaged as (select doc_id, text, array_to_string(list_transform(range(1, len(c) + 1), lambda i: case when doc_id % 3 > 0 and i % 3 = 0 and contains('àâäçéèêëîïôöùûüœÀÂÇÉÈÊÎÔ', c[i]) then '�' else c[i] end), '') as hurt from (select doc_id, text, string_split(text, '') as c from documents))"""


@query(rf"""with {DAMAGED}, vocabulary as (select w, count(*) as n from (select unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_''-]+')) as w from documents where doc_id % 3 = 0) group by w),
tokens as (select doc_id, pos, t, regexp_extract(t, '^([^\p{{L}}\p{{N}}_�]*)(.*?)([^\p{{L}}\p{{N}}_�]*)$', 1) as a, regexp_extract(t, '^([^\p{{L}}\p{{N}}_�]*)(.*?)([^\p{{L}}\p{{N}}_�]*)$', 2) as core, regexp_extract(t, '^([^\p{{L}}\p{{N}}_�]*)(.*?)([^\p{{L}}\p{{N}}_�]*)$', 3) as b
 from (select doc_id, unnest(range(len(w))) as pos, unnest(w) as t from (select doc_id, string_split_regex(trim(hurt), '\s+') as w from damaged where contains(hurt, '�')))),
cores as (select distinct core from tokens where contains(core, '�')),
shapes as (select core, length(core) as l, translate(replace(core, '�', '?'), 'àâäçéèêëîïôöùûüœÀÂÇÉÈÊÎÔ', '???????????????????????') as s from cores),
known as (select w, n, length(w) as l, translate(w, 'àâäçéèêëîïôöùûüœÀÂÇÉÈÊÎÔ', '???????????????????????') as s from vocabulary),
best as (select core, arg_max(w, (n, w)) as w from shapes join known using (l, s) where len(list_filter(range(1, l + 1), lambda i: core[i] <> '�' and core[i] <> w[i])) = 0 group by core),
texts as (select doc_id, string_agg(a || coalesce(best.w, replace(core, '�', 'é')) || b, ' ' order by pos) as fixed from tokens left join best using (core) group by doc_id)
select doc_id, md5(coalesce(fixed, hurt)) as text_md5, contains(hurt, '�') as damaged from damaged left join texts using (doc_id)""")
def character_repair(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    letters = F.transform(F.split("text", ""), lambda c, i: F.when((F.col("doc_id") % 3 > 0) & ((i + 1) % 3 == 0) & F.contains(F.lit(R.ACCENTED), c) & (c != ""), "�").otherwise(c))
    hurt = docs.select("doc_id", F.array_join(letters, "").alias("text")).withColumn("damaged", F.contains("text", F.lit("�")))
    words = F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_'-]+"), 0)).alias("w")
    vocabulary = docs.where("doc_id % 3 = 0").select(words).groupBy("w").agg(F.count("*").alias("n"))
    return R.repaired_texts(hurt, "doc_id", "text", vocabulary).select("doc_id", F.md5("text").alias("text_md5"), "damaged")


#: The third word of each held-out text, with its middle letter struck, and all words of these texts.
SPELLINGS = r"""said as (select item_id, list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda w: w <> '') as w from benchmark),
asked as (select distinct w[3][1:len(w[3]) // 2] || 'x' || w[3][len(w[3]) // 2 + 2:] as a from said where len(w) > 2), known as (select distinct unnest(w) as b from said)"""


@query(rf"""with recursive {SPELLINGS}, pairs as (select row_number() over () as id, a, b, length(a) as la, length(b) as lb from asked, known where least(length(a), length(b)) * 2 >= 0.75 * (length(a) + length(b))),
cell as (select id, i, j, i - j as diagonal from pairs, unnest(range(la)) x(i), unnest(range(lb)) y(j) where a[i + 1] = b[j + 1]),
block as (select id, i, j, count(*) over (partition by id, diagonal, i - n order by i desc) as k from (select *, row_number() over (partition by id, diagonal order by i) as n from cell)),
walk(id, alo, ahi, blo, bhi, size) as (
 select id, 0::bigint, la, 0::bigint, lb, 0::bigint from pairs
 union all
 select id, unnest([alo, m.i + m.k]), unnest([m.i, ahi]), unnest([blo, m.j + m.k]), unnest([m.j, bhi]), unnest([m.k, 0]) from (
  select w.id, w.alo, w.ahi, w.blo, w.bhi, arg_max(struct_pack(i := c.i, j := c.j, k := least(c.k, w.ahi - c.i, w.bhi - c.j)), (least(c.k, w.ahi - c.i, w.bhi - c.j), -c.i, -c.j)) as m
  from walk w join block c on c.id = w.id and c.i >= w.alo and c.i < w.ahi and c.j >= w.blo and c.j < w.bhi group by all)),
ratios as (select a, b, 2.0::double * coalesce(sum(size), 0) / (la + lb) as ratio from pairs join walk using (id) group by id, a, b, la, lb),
best as (select a, b, ratio, row_number() over (partition by a order by a <> b, -ratio, b) as n from ratios where ratio >= 0.75)
select a as w, b as spelling, round(ratio, 6) as ratio from best where n = 1""")
def closest_spellings(spark: SparkSession, d: str) -> DataFrame:
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    said = table(spark, d, "benchmark").select(words.alias("w"))
    third = F.get("w", F.lit(2))
    half = F.floor(F.length(third) / 2).cast("int")
    asked = said.where(F.size("w") > 2).select(F.concat(F.substring(third, 1, half), F.lit("x"), F.substring(third, half + 2, F.length(third))).alias("w"))
    return S.closest(asked, said.select(F.explode("w").alias("w"))).select("w", "spelling", F.round("ratio", 6).alias("ratio"))
