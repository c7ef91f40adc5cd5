"""Queries of §2.6 and §2.10 on linked chains of questions and on runs of subtitle cues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chains as H
from ..operators import cues as K
from .qa_queries import ALIGNED, _aligned
from .tables import query, table


def _u(what: str, key: str) -> str:
    """A uniform draw in SQL."""
    return f"(('0x' || substr(md5('{what}:' || {key}), 1, 8))::bigint / 4294967296.0::double)"


BARE = """regexp_replace({0}, '^[.,;:!?()"''»«]+|[.,;:!?()"''»«]+$', '', 'g')"""


@query(rf"""with {ALIGNED}, e as (select item_id, unnest(words) as w, unnest(range(1, len(words) + 1)) as pos from aligned),
s as (select item_id, pos, w, coalesce(sum(regexp_matches(w.word, '[.?!]$')::int) over (partition by item_id order by pos rows between unbounded preceding and 1 preceding), 0) as s from e),
sentences as (select item_id, s, string_agg(w.word, ' ' order by pos) as text, min(w."start") as a, max(w."end") as b from s group by item_id, s),
r as (select item_id, words, words[-1]."end" + 1 as duration, floor({_u('chain:kind', 'item_id')} * 3)::int as kind, {_u('chain:word', 'item_id')} as u, ([6, 8, 10])[floor({_u('chain:width', 'item_id')} * 3)::int + 1] as n, case when {_u('chain:steps', 'item_id')} < 0.5 then 2 else 3 end as steps,
 list_transform(words, lambda w: lower({BARE.format('w.word')})) as keys from aligned),
p as (select *, list_filter(range(1, len(words) + 1), lambda i: (i = 1 or words[i]."start" - words[i - 1]."start" >= 0.15) and (i = len(words) or words[i + 1]."start" - words[i]."start" >= 0.15) and words[i]."start" > 3 and words[i]."start" < duration - 3) as clear,
 list_filter(range(1, len(words) + 1), lambda i: regexp_matches(keys[i], '^\p{{L}}{{5,}}$') and len(list_filter(keys, lambda k: k = keys[i])) = 1) as once from r),
q as (select *, clear[floor(u * len(clear))::int + 1] as zi, once[floor(u * len(once))::int + 1] as li from p),
t as (select *, words[zi]."start" as zt, words[li]."start" as lt, {BARE.format('words[li].word')} as lw, words[5]."start" as qt from q),
near as (select item_id, which, arg_min(s.text, (not (s.a <= x.at and s.b >= x.at), case when s.a <= x.at and s.b >= x.at then s.s else abs((s.a + s.b) / 2 - x.at) end, s.s)) as text from (select item_id, 'z' as which, zt as at from t union all select item_id, 'q', qt from t) x join sentences s using (item_id) where x.at is not null group by all),
holds as (select item_id, arg_min(s.text, s.s) as text from t join sentences s using (item_id) where contains(lower(s.text), lower(lw)) group by all),
items as (
 select item_id, 'zoom' as chain, 0 as k, 0 as step, 'word_at_time' as task, 'Which word begins at ' || printf('%.1f', zt) || ' seconds?' as question, {BARE.format('words[zi].word')} as answer, 'Which word begins at ' || printf('%.1f', zt) || ' seconds?' as alone from t where zi is not null
 union all select t.item_id, 'zoom', 0, 1, 'sentence_at_time', 'What is the sentence around it?', near.text, 'What is the whole sentence at ' || printf('%.1f', zt) || ' seconds?' from t join near on near.item_id = t.item_id and which = 'z'
 union all select item_id, 'zoom', 0, 2, 'window_between', 'Now write down the ' || n || ' seconds around that moment.', array_to_string(list_transform(list_filter(words, lambda w: w."start" >= greatest(0, zt - n / 2) and w."end" <= least(duration, zt + n / 2)), lambda w: w.word), ' '),
  'Write down what is said from ' || printf('%.1f', greatest(0, zt - n / 2)) || ' to ' || printf('%.1f', least(duration, zt + n / 2)) || ' seconds.' from t where zi is not null
 union all select item_id, 'locate', 1, 0, 'word_time', 'At what time is “' || lw || '” said?', 'At ' || printf('%.1f', lt) || ' seconds.', 'At what time is “' || lw || '” said?' from t where li is not null
 union all select item_id, 'locate', 1, 1, 'sentence_with_word', 'Which sentence does it stand in?', holds.text, 'Which sentence has the word “' || lw || '”?' from t join holds using (item_id) where li is not null
 union all select item_id, 'locate', 1, 2, 'word_next', 'Which word follows it?', {BARE.format('words[li + 1].word')}, 'Which word follows “' || lw || '”?' from t where li is not null
 union all select item_id, 'qa', 2, 0, 'qa_answer', 'Answer by the recording: What comes fifth?', words[5].word, 'Answer by the recording: What comes fifth?' from t where item_id % 3 > 0
 union all select item_id, 'qa', 2, 1, 'qa_time', 'At what time is this answer said?', 'At ' || printf('%.1f', qt) || ' seconds.', 'At what time is this answer said?' from t where item_id % 3 > 0
 union all select t.item_id, 'qa', 2, 2, 'qa_sentence', 'Which sentence does the answer come from?', near.text, 'Which sentence does the answer come from?' from t join near on near.item_id = t.item_id and which = 'q' where t.item_id % 3 > 0),
good as (select *, count(*) filter (where coalesce(answer, '') = '') over (partition by item_id, chain order by step) as gaps from items),
full_ as (select *, count(*) over (partition by item_id, chain) as size from good where gaps = 0),
first_ as (select item_id, arg_min(chain, (f.k - t.kind + 3) % 3) as chain from full_ f join t using (item_id) where size >= 2 group by item_id)
select item_id, chain, step::int as step, task, question, answer, alone from full_ join first_ using (item_id, chain) join t using (item_id) where step < steps""")
def linked_chains(spark: SparkSession, d: str) -> DataFrame:
    w = _aligned(spark, d).withColumn("duration", F.try_element_at("words", F.lit(-1))["end"] + 1)
    fifth = F.get("words", F.lit(4))
    asked = F.when(F.col("item_id") % 3 > 0, "What comes fifth?")
    return H.linked(w.withColumns({"question": asked, "answer": fifth["word"], "answer_start": fifth["start"]}), "item_id")


#: Cues of a user's events; a segment begins at every third cue and ends where the cue some places on does, or nearly.
CUES = """cues as (select user_id as recording, event_id, 'c' || event_id as cue_id, round(event_id * 0.01, 4)::double as s, round(event_id * 0.01 + 0.4 + value % 3, 4)::double as e, row_number() over (partition by user_id order by event_id) as k,
 case event_id % 11 when 0 then '*rires*' when 1 then '(' || event_type || ' ' || event_id || ')' when 2 then '-' || upper(event_type) when 3 then 'p%ta' || event_id when 4 then '' when 5 then '*Cris*' when 6 then upper(event_type) || ' *rit* end.' else event_type || ' ' || event_id end as text from events),
segs as (select *, coalesce(lead(e, 2) over o, e) as e2, coalesce(lead(e, 1) over o, e) as e1 from cues window o as (partition by recording order by s, k))"""


@query(rf"""with recursive {CUES}, seg as (select recording, cue_id as seg_id, k, s, case event_id % 4 when 0 then e when 1 then e1 + 0.001 when 2 then e2 else e2 + 0.5 end as target, 'now ' || event_id as now from segs where event_id % 3 = 0),
walk(recording, seg_id, s, target, k, till) as (
 select seg.recording, seg_id, seg.s, target, seg.k, e from seg join cues using (recording, k)
 union all
 select w.recording, w.seg_id, w.s, w.target, c.k, c.e from walk w join cues c on c.recording = w.recording and c.k = w.k + 1 where not abs(w.till - w.target) <= 0.002 and not c.s - w.till > 1 and not c.e - w.s > 30),
ended as (select recording, seg_id, max(k) as last_k, arg_max(abs(till - target) <= 0.002, k) as ok from walk group by all),
texts as (select w.recording, w.seg_id, w.k, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(c.text, '[()]', ' ', 'g'), '\*(rires|rit)\*', ' [laughter] ', 'g'), '\*Cris\*', ' ', 'g'), '^[ ]*-+\s*([A-Za-z])', '\1')) as t, c.text as raw from walk w join cues c using (recording, k) join ended using (recording, seg_id) where ok),
parts as (select *, lag(t) over (partition by recording, seg_id order by k) as before from texts where t <> ''),
told as (select recording, seg_id, trim(regexp_replace(string_agg(case when before is null then '' when regexp_matches(t, '^\p{{Lu}}') and not regexp_matches(before, '[\p{{P}}\p{{S}}]$') then '. ' else ' ' end || t, '' order by k), '\s+', ' ', 'g')) as new from parts group by all),
some_ as (select recording, seg_id, count(*)::int as n_cues, bool_or(raw <> '') as any_text from texts group by all)
select recording, seg_id, coalesce(n_cues, 0)::int as n_cues, case when any_text is null then 'unmatched' when regexp_matches(coalesce(new, ''), '\w[%*#@]+\w') then 'censored' when coalesce(new, '') <> '' then 'rebuilt' when any_text then 'sound_note_only' else 'empty' end as outcome,
 case when any_text is null or coalesce(new, '') = '' and not any_text then now when regexp_matches(coalesce(new, ''), '\w[%*#@]+\w') then null when new <> '' then new end as text
from seg left join some_ using (recording, seg_id) left join told using (recording, seg_id)""")
def cue_run_texts(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    i = F.col("event_id")
    text = (
        F.when(i % 11 == 0, "*rires*").when(i % 11 == 1, F.concat(F.lit("("), F.concat_ws(" ", "event_type", i), F.lit(")"))).when(i % 11 == 2, F.concat(F.lit("-"), F.upper("event_type"))).when(i % 11 == 3, F.concat(F.lit("p%ta"), i))
        .when(i % 11 == 4, "").when(i % 11 == 5, "*Cris*").when(i % 11 == 6, F.concat(F.upper("event_type"), F.lit(" *rit* end."))).otherwise(F.concat_ws(" ", "event_type", i))
    )
    cues = table(spark, d, "events").select("event_id", F.col("user_id").alias("recording"), F.concat(F.lit("c"), i).alias("cue_id"), F.round(i * 0.01, 4).alias("start"), F.round(i * 0.01 + 0.4 + F.col("value") % 3, 4).alias("end"), text.alias("text"))
    order = Window.partitionBy("recording").orderBy("start", "event_id")
    later = lambda n: F.coalesce(F.lead("end", n).over(order), "end")
    target = F.when(i % 4 == 0, F.col("end")).when(i % 4 == 1, later(1) + 0.001).when(i % 4 == 2, later(2)).otherwise(later(2) + 0.5)
    segs = cues.withColumn("target", target).where("event_id % 3 = 0").select("recording", F.col("cue_id").alias("seg_id"), "start", F.col("target").alias("end"), F.concat(F.lit("now "), i).alias("text"))
    return K.rebuilt_from_cues(segs, cues.drop("event_id")).select("recording", "seg_id", "n_cues", "outcome", "text")
