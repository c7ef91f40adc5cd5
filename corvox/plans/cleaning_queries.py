"""Queries of §2.7 on the cleaning pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import cleaning as C
from ..sources.scratch import scratch
from .tables import query, table
from .turn_queries import u_sql

MAP = [(r"https?://\S+", "[noise]"), (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "[inaudible]"), (r"[*%$&]{3,}", "[laughter]")]
TAGS = r"\[(?:noise|laughter|inaudible|silence|music|breath)\]"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text", "lang")


def _one(spark: SparkSession, d: str, name: str, half_lower: bool = False, **options) -> DataFrame:  # noqa: ANN003
    docs = _docs(spark, d)
    if half_lower:  # so that the rule for texts without capitals meets some
        docs = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.lower("text")).otherwise(F.col("text")))
    out = C.cleaned(docs, [C.Step(name, options, name)])
    return out.select("doc_id", "text", F.col("dropped_by").isNotNull().alias("dropped"))


def chain(column: str, rules: list[tuple[str, str]]) -> str:
    """Ordered replacements in SQL."""
    for p, by in rules:
        p, by = p.replace("'", "''").replace(r" ", " ").replace(r" ", " ").replace(r" ", " "), by.replace("'", "''").replace("$1", r"\1").replace("$2", r"\2")
        column = f"regexp_replace({column}, '{p}', '{by}', 'g')"
    return column


@query(f"select doc_id, {chain('text', [(p, f' {t} ') for p, t in MAP])} as text, false as dropped from documents")
def map_tags(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "map_tags", rules=MAP)


@query("select doc_id, text, regexp_matches(text, '(?:lorem)|(?:[0-9]{5})') as dropped from documents")
def drop_if_match(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "drop_if_match", patterns=["lorem", "[0-9]{5}"])


@query(r"""select doc_id, case when regexp_matches(regexp_replace(text, '\[[^\[\]]+\]', ' ', 'g'), '\p{Lu}') then text
 else trim(regexp_replace(regexp_replace(text, '[.,;:!?…]+(\s|$)', ' ', 'g'), '\s+', ' ', 'g')) end as text, false as dropped from (select doc_id, case when doc_id % 2 = 0 then lower(text) else text end as text from documents)""")
def uncased_no_punctuation(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "uncased_no_punctuation", half_lower=True)


@query(rf"select doc_id, text, regexp_matches(regexp_replace(text, '{TAGS}', '', 'g'), '[\[\]]') as dropped from documents")
def drop_unknown_brackets(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "drop_unknown_brackets")


@query(rf"""with s as (select doc_id, text, regexp_replace(text, '((?:\s*{TAGS})*)\s*$', '') as body, regexp_extract(text, '((?:\s*{TAGS})*)\s*$', 1) as tail from documents)
select doc_id, case when regexp_matches(body, '[.?!…]["»”)'']*$') or body = '' then text else regexp_replace(body, '\s*[,;:]$', '') || '.' || tail end as text, false as dropped from s""")
def add_final_period(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "add_final_period")


@query(f"""with m as (select doc_id, {chain('text', [(p, f' {t} ') for p, t in MAP])} as t from documents) select doc_id, case when contains(t, '[inaudible]') then t else regexp_replace(t, '{TAGS}', ' ', 'g') end as text, contains(t, '[inaudible]') as dropped from m""")
def events_stripped(spark: SparkSession, d: str) -> DataFrame:
    out = C.cleaned(_docs(spark, d), C.resolved([{"map_tags": {"rules": MAP}}, "events"], {}))
    return out.select("doc_id", "text", F.col("dropped_by").isNotNull().alias("dropped"))


def stages(*rules: tuple[str, str]) -> str:
    """One WITH clause for each ordered replacement of `text`, for an engine without looks around a match."""
    out = ["r0 as (select doc_id, text as t from documents)"]
    for k, (p, by) in enumerate(rules):
        q, b = p.replace("'", "''"), by.replace("'", "''")
        out.append(f"r{k + 1} as (select doc_id, regexp_replace(t, '{q}', '{b}', 'g') as t from r{k})")
    return "with " + ", ".join(out) + f" select doc_id, t as text, false as dropped from r{len(rules)}"


#: The rules without looks around: three dots are held as one sign, so that a dot alone is one that has no other beside it.
DOTS = "\x01"


@query(stages(
    ("[\ufeff\u200b\u200c\u200d\u2060]", ""), (r"^[\s.,;:?!…]+", ""), (r"\.{4,}", "..."), (r"\.\.\.", DOTS), (r"\.\.", "."), (r"\?+", "?"), ("!+", "!"),
    (r"([?!])\s*\.", r"\1"), (r"\.\s*([?!])", r"\1"), (rf"([.?!…{DOTS}])\s*[,;](\s|$)", r"\1\2"), (rf"\s*,\s*(\.|[?!]([^.{DOTS}]|$))", r"\1"), (DOTS, "..."),
))
def normalize_punctuation(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "normalize_punctuation")


@query(stages(
    (r"\s+", " "), (r"([.?!…])[,;:]+", r"\1"), (r"([,;:])(?:\s*[,;:])+", r"\1"), (r"[,;:]\s*([.?!…])", r"\1"), (r"(^|[^.])([.?!…])\s+\.([^.]|$)", r"\1\2\3"), (r"\s+([,.])", r"\1"),
    (r"\(\s*\)", ""), (r"^[\s,;:.]*(\.[\p{L}\p{N}_])", r"\1"), (r"^[\s,;:]+", ""), (r"^\.[\s,;:.]*([^\s,;:.\p{L}\p{N}_]|$)", r"\1"), (r"^\.[\s,;:.]*[\s,;:]([\p{L}\p{N}_])", r"\1"), (r"\s+$", ""),
))
def normalize_spacing(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "normalize_spacing")


@query(stages(
    ("[’‘ʼ']+", "'"), ("[“”„‟]", '"'), (r"(^|[.?!»:])\s*[-–—]\s+(\p{L})", r"\1 \2"), ("…", "..."), ("[\u00a0\u202f\u2009]", " "), (r"([^\s(\[«;:!?])\s*([;:!?]+)(\s|$|[»\"”])", r"\1 \2\3"),
    (r"(\p{L})\s*([;:!?]+)(\p{L})", r"\1 \2 \3"), (r"«\s*", "« "), (r"\s*»", " »"), (r"\s+", " "), ("^ | $", ""),
))
def french_typography(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "french_typography")


@query(rf"select doc_id, text, not regexp_matches(regexp_replace(text, '{TAGS}', '', 'g'), '[\p{{L}}\p{{N}}]') as dropped from documents")
def empty_line_rule(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d, "empty")


BARE = "replace(lower(trim(w, '«»\"“”()[].,;:?!…')), '’', chr(39))"


@query(rf"""with v as (select distinct w from (select unnest(string_split_regex(lower(text), '[^\p{{L}}]+')) as w from benchmark) where w <> ''),
d as (select doc_id, replace(text, ', ', ' l' || chr(39)) as text from documents),
w as (select doc_id, {BARE} as w from (select doc_id, unnest(string_split_regex(text, '\s+')) as w from d)),
c as (select doc_id, count(*) as n, count(*) filter (where w not in (select w from v) and regexp_replace(w, '^(?:c|d|j|l|m|n|s|t|qu|jusqu|lorsqu|puisqu)['']', '') not in (select w from v)) as missing
 from w where regexp_matches(w, '\p{{L}}') group by doc_id)
select doc_id, text, coalesce(regexp_matches(text, '(?i)(?:^|[^\p{{L}}\p{{N}}_])[a-zàâäéèêëîïôöùûüç][''’][bcdfgjklmnpqrstvwxzç]') and missing > 0.9::double * n, false) as dropped from d left join c using (doc_id)""")
def drop_ocr(spark: SparkSession, d: str) -> DataFrame:
    """Texts whose commas were read as an elided l; known words are those of the benchmark."""
    words = table(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w")).where("w <> ''")
    docs = _docs(spark, d).withColumn("text", F.replace("text", F.lit(", "), F.lit(" l'")))
    return C.badly_read(docs, "doc_id", "text", words, 0.9).select("doc_id", "text", "dropped")


ANY = r"\[[^\[\]]+\]"
SPOKEN = rf"len(list_filter(string_split_regex(regexp_replace(text, '{ANY}', ' ', 'g'), '\s+'), lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]')))"


@query(rf"""with r as (select doc_id, lang, nullif(n_chars, 7) / 15.0::double as dur, 10 * len(regexp_extract_all(text, '{ANY}')) as tags, {SPOKEN} as words, length(regexp_replace(regexp_replace(text, '{ANY}', ' ', 'g'), '[^\p{{L}}]', '', 'g')) as letters from documents),
m as (select lang, percentile_disc(0.5) within group (order by case when dur - tags > 1 then words / (dur - tags) end desc) as med from r where dur - tags > 1 group by lang)
select doc_id, coalesce(dur < 0.1 or words > coalesce(med, 0) * 4 * dur or letters > 30 * dur or (dur - tags > 5 and words < greatest(0.3, coalesce(med, 0) / 4) * (dur - tags)), false) as dropped from r left join m on r.lang is not distinct from m.lang""")
def speech_rate(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", "lang", "text", (F.nullif("n_chars", F.lit(7)) / 15.0).alias("dur"))
    med = C.median_rates(t, "text", "dur", "lang").withColumnRenamed("lang", "__lang")
    joined = t.join(med, F.col("lang").eqNullSafe(F.col("__lang")), "left")
    return joined.select("doc_id", C.speech_rate_dropped(F.col("text"), F.col("dur"), F.col("median_wps")).alias("dropped"))


PROMPTS = {"default_contexts": {0.75: ["Transcribe.", "Write what you hear."], 0.25: ["Listen and write."]}, "nocasepunc": {1.0: ["No capitals, no marks."]}, "no_events": {1.0: ["No events."]},
           "no_events_nocasepunc": {1.0: ["No events, no capitals."]}, "no_disfluencies": {1.0: ["No hesitations."]}, "no_events_no_disfluencies": {1.0: ["Neither."]}}


@query(rf"""with d as (select doc_id, case when doc_id % 2 = 0 then lower(regexp_replace(text, '[.,;:!?…]', '', 'g')) when doc_id % 3 = 0 then regexp_replace(text, '[.,;:!?…]', '', 'g') else text end as text from documents),
f as (select *, regexp_replace(text, '{ANY}', ' ', 'g') as o, {SPOKEN} as n from d),
g as (select *, not regexp_matches(o, '[.,;:!?…]') and not regexp_matches(o, '\p{{Lu}}') as uncased, not regexp_matches(o, '[.,;:!?…]') and n >= 100 as long from f),
c as (select *, case when {u_sql("events", "doc_id")} < 0.2 then case when {u_sql("both", "doc_id")} < 0.5 then 'no_events_no_disfluencies' else 'no_events' end when {u_sql("disfluencies", "doc_id")} < 0.2 then 'no_disfluencies'
 when uncased or long then 'nocasepunc' else 'default_contexts' end as base from g),
k as (select *, case when (uncased or long) and base <> 'nocasepunc' then base || '_nocasepunc' else base end as c0 from c),
p as (select *, case when c0 = 'no_events_no_disfluencies_nocasepunc' then 'no_events_nocasepunc' when c0 = 'no_disfluencies_nocasepunc' then '_nocasepunc' else c0 end as category from k)
select doc_id, case when long and not uncased then lower(text) else text end as text, category, case category when 'nocasepunc' then 'No capitals, no marks.' when 'no_events' then 'No events.' when 'no_events_nocasepunc' then 'No events, no capitals.'
 when 'no_disfluencies' then 'No hesitations.' when 'no_events_no_disfluencies' then 'Neither.' else case when {u_sql("group", "doc_id")} >= 0.75 then 'Listen and write.' when {u_sql("prompt", "doc_id")} < 0.5 then 'Transcribe.' else 'Write what you hear.' end end as prompt
from p where category <> '_nocasepunc'""")
def choose_prompt(spark: SparkSession, d: str) -> DataFrame:
    bare = F.regexp_replace("text", "[.,;:!?…]", "")
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lower(bare)).when(F.col("doc_id") % 3 == 0, bare).otherwise(F.col("text")).alias("text"))
    return C.chosen_prompts(docs, PROMPTS, explicit={"events": 0.2, "disfluencies": 0.2}, nocasepunc=100, draws=lambda name: hashing.hash_u(name, "doc_id"))


@query(rf"""select doc_id, {SPOKEN}::int as n_words, regexp_matches(regexp_replace(text, '{ANY}', ' ', 'g'), '\p{{Lu}}') as cased from documents""")
def word_helpers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.spoken_word_count(F.col("text")).alias("n_words"), text.has_case(F.regexp_replace("text", text.ANY_TAG, " ")).alias("cased"))


#: A pipeline over all kinds of filters.
BLOCKS = {"marks": [{"map_tags": {"rules": MAP}}, "events"], "finish": ["normalize_spacing", "normalize_punctuation", "add_final_period", "normalize_spacing", "empty"]}
PIPELINE = [
    "normalize_unicode", "strip_html", {"block": "marks"}, {"all_caps": {"least": 5, "action": "drop"}}, "all_caps", "fix_mixed_case", {"fix_spurious_caps": {"function_words": ["the", "of", "and", "de", "la", "und"]}},
    {"numbers_to_words": {"language": "en"}}, "speaker_labels", "restore_elisions", {"join_split_compounds": {"vocabulary": ["peut-être"]}}, {"normalize_interjections": {"spellings": {"ah": ["aah", "ahh"]}}},
    {"disfluencies": {"language": "en"}}, {"fix_punctuation": {"common": ["the", "and", "of"]}}, {"block": "finish"},
]


@query()
def cleaning_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """All outputs; the steps that they share are done once and written."""
    steps = C.resolved(PIPELINE, BLOCKS)
    k, path = C.shared_steps(steps), scratch(spark, "cleaned")
    first = C.cleaned(_docs(spark, d), steps[:k])
    first.write.parquet(path)
    shared = spark.read.schema(first.schema).parquet(path)
    parts = [C.cleaned(shared, C.for_output(steps, o)[k:], traced=True).select("doc_id", F.lit(o).alias("output"), "text", "dropped_by", F.array_join("changed", ",").alias("changed")) for o in C.OUTPUTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query()
def cleaning_statistics(spark: SparkSession, d: str) -> DataFrame:
    return C.statistics(C.cleaned(_docs(spark, d), C.resolved(PIPELINE, BLOCKS)), "lang")
