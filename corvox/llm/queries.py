"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, embed_dedup, mixing, permutation_index, personal_data, prefix_trie, rendezvous, resampling, simhash, token_counts, token_store, toxicity
from .common import new_folder, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _spans(name: str) -> Column:
    """Spans as start-end, start-end."""
    return F.array_join(F.transform(name, lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of all conversations that share their first turn, formatted; one without a partner has -1 there."""
    convs = written(chat_format.conversations(_table(spark, sf_dir, "conversations")), "conversations")
    out = chat_format.formatted(chat_format.paired(convs, convs.count()))
    return out.select(
        "chosen_id", F.coalesce("rejected_id", F.lit(-1)).alias("rejected_id"), "prefix_turns", "prompt", "chosen_completion", _spans("chosen_spans"), "rejected_completion", _spans("rejected_spans")
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all documents, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, _tokenizer()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings with cosine 0.9 or more, and the components they make."""
    out = embed_dedup.linked(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.9)
    return out.select(F.col("item").alias("vec_id"), "n_links", "component_id", "kept")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to the file format and read back."""
    path = new_folder(spark, "tokens")
    token_store.write_tokens(_table(spark, sf_dir, "documents"), path, _tokenizer())
    rows = written(token_store.with_checksums(token_store.read_tokens(spark, path)), "checked")
    return token_store.with_starts(rows).select(F.col("item").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23."""
    return rendezvous.document_shards(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents, learned outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    out = toxicity.scored(docs, model)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest others of every embedding whose id is divisible by 20."""
    out = permutation_index.search(_table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0, "vec_id", "embedding", 20)
    return out.select("query_id", "rank", F.col("item").alias("vec_id"), "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.counted(docs, _tokenizer("piece_bpe_32k.model")).select("doc_id", "n_words", "n_tokens")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups that their links make."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = written(simhash.fingerprints(docs).drop("text"), "prints")
    out = simhash.groups(prints, "doc_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all documents takes, and where in training each document comes first (-1: not at all), in that order."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    out = mixing.mixed(written(docs, "documents"))
    first = F.round(F.coalesce(F.get("positions", F.lit(0)), F.lit(-1.0)), 8)
    out = out.select("doc_id", "size", "source_size", "target", "taken", F.col("copies").cast("long").alias("copies"), first.alias("first_position"))
    return out.orderBy("first_position", "doc_id")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and disguised identifiers of all documents; counts are of all spans, n_added of those behind disguises."""
    out = personal_data.identifiers(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    told = lambda name: F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end_"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in personal_data.KINDS]
    added = (F.size("spans") - F.size("base_spans")).cast("long").alias("n_added")
    return out.select("doc_id", *counts, F.sha2(told("base_spans"), 256).alias("base_sha256"), told("spans").alias("spans"), added)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's texts, and the twentieth of them that is drawn."""
    return resampling.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OPERATORS = (
    op1_chat_format, op2_bpe, op3_embed_dedup, op4_token_store, op5_sharding, op6_toxicity, op7_permutation_index, op8_token_counts, op9_simhash, op10_mixing,
    op11_personal_data, op12_prefix_trie, op13_resampling,
)
QUERIES = {f.__name__: f for f in OPERATORS}
ORACLES: dict[str, str] = {
    "op1_chat_format": r"""
with t as (select conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns from conversations group by conv_id),
k as (select *, md5(concat_ws(':', length(turns[1].role), turns[1].role, turns[1].text)) as opening, md5('pair:' || coalesce(conv_id::varchar, '')) as h from t),
r as (select *, row_number() over (partition by opening order by h, conv_id nulls first) - 1 as place from k),
p as (select opening, place // 2 as pair, max(conv_id) filter (where place % 2 = 0) as chosen_id, any_value(turns) filter (where place % 2 = 0) as a, max(conv_id) filter (where place % 2 = 1) as rejected_id,
 coalesce(any_value(turns) filter (where place % 2 = 1), []) as b from r group by all),
n as (select *, coalesce(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] is distinct from b[i])[1] - 1, least(len(a), len(b)))::int as n from p),
c as (select chosen_id, rejected_id, n as prefix_turns, a[1:n] as pre, a[n + 1:] as x, b[n + 1:] as y from n)
select chosen_id, coalesce(rejected_id, -1) as rejected_id, prefix_turns, array_to_string(list_transform(pre, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') as prompt,
 array_to_string(list_transform(x, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') as chosen_completion,
 array_to_string(list_filter(list_transform(range(1, len(x) + 1), lambda i: case when x[i].role = 'assistant' then (coalesce(list_sum(list_transform(x[1:i - 1], lambda t: length(t.role) + length(t.text) + 13)), 0) + 14)::bigint || '-' || (list_sum(list_transform(x[1:i], lambda t: length(t.role) + length(t.text) + 13)))::bigint end), lambda s: s is not null), ',') as chosen_spans,
 array_to_string(list_transform(y, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '') as rejected_completion,
 array_to_string(list_filter(list_transform(range(1, len(y) + 1), lambda i: case when y[i].role = 'assistant' then (coalesce(list_sum(list_transform(y[1:i - 1], lambda t: length(t.role) + length(t.text) + 13)), 0) + 14)::bigint || '-' || (list_sum(list_transform(y[1:i], lambda t: length(t.role) + length(t.text) + 13)))::bigint end), lambda s: s is not null), ',') as rejected_spans
from c""",
    "op10_mixing": r"""
with s as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size, md5('mix:' || coalesce(doc_id::varchar, '')) as h from documents),
g as (select source, sum(size)::bigint as source_size from s group by source),
w as (select *, ([5.0, 2.0, 1.0])[n % 3 + 1]::double as weight, ([-0.5, 0.5, 0.0])[n % 3 + 1]::double as tilt from (select *, row_number() over (order by source nulls last) - 1 as n from g)),
l as (select *, (1.5::double * sum(source_size) over () - 2.0::double * coalesce(sum(source_size) over u, 0)) / (sum(weight) over () - coalesce(sum(weight) over u, 0)) as level
 from w window u as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
f as (select *, level * weight >= 2.0::double * source_size as is_full from l),
t as (select source, source_size, tilt, coalesce(case when is_full then 2.0::double * source_size else v.level * weight end, 0) as target from f, (select arg_min(level, source_size / weight) as level from f where not is_full) v),
o as (select *, coalesce(sum(size) over (partition by source order by h, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0) + size / 2.0::double as middle from s),
j as (select o.*, source_size, target, tilt, (middle < target)::bigint + (middle + source_size < target)::bigint as copies from o join t on o.source is not distinct from t.source)
select doc_id, size, source_size, target, copies * size as taken, copies, round(case when copies = 0 then -1.0::double else least(1.0::double, 2.0 * (middle / target) / (1 + tilt + sqrt(greatest((1 + tilt) * (1 + tilt) - 4.0 * tilt * (middle / target), 0)))) end, 8) as first_position from j""",
    "op12_prefix_trie": r"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos from conversations where conv_id is not null),
c as (select conv_id, count(*) as n, xor(4294967295, list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint), lambda a, b: list_reduce(range(8), lambda y, i: case when y & 1 = 1 then xor(y >> 1, 3988292384) else y >> 1 end, xor(a, b)), 4294967295::bigint)) % 6 as h, conv_id - conv_id % 100 as family from t group by conv_id),
k as (select c.*, least(c.h, coalesce(b.n, 0)) as taken, least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) as len from c left join c b on b.conv_id = c.family),
r as (select conv_id, len, taken + pos - h as depth, role, text from t join k using (conv_id) where pos > h union all select k.conv_id, len, pos, role, text from k join t on t.conv_id = k.family where pos <= taken union all select conv_id, len, 0, '', '' from k),
p as (select conv_id, len, depth, length(text) as chars, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') over (partition by conv_id order by depth)) as node from r),
q as (select *, lag(node) over (partition by conv_id order by depth) as parent from p),
nodes as (select node, parent, depth, chars, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(case when depth = len then conv_id::varchar end, ',' order by conv_id), '')) as ends_sha256 from q group by all),
n as (select a.*, b.conv_id as parent_conv_id, coalesce(m, 0) as n_children from nodes a left join nodes b on b.node = a.parent left join (select parent as node, count(*) as m from nodes where parent is not null group by parent) z on z.node = a.node),
sums as (select q.node, count(*) filter (where u.n_children = 0) as n_leaves, sum((u.n_convs - 1) * u.chars)::bigint as saved_tokens from n u join q on q.conv_id = u.conv_id and q.depth <= u.depth group by q.node)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 from n join sums using (node)""",
    "op13_resampling": r"""
with crc_table as (select list(list_reduce(range(8), lambda y, i: case when y & 1 = 1 then xor(y >> 1, 3988292384) else y >> 1 end, b) order by b) as c from (select unnest(range(256)) as b)),
words as (select doc_id as id, false as target, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
 union all select item_id, true, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
grams as (select id, target, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as g from words),
counted as (select id, target, g, count(*) as n from grams group by all),
hashed as (select g, xor(4294967295, list_reduce(list_transform(range(octet_length(encode(g))), lambda i: ('0x' || substr(hex(encode(g)), 2 * i + 1, 2))::bigint), lambda a, b: xor(a >> 8, c[(xor(a, b) & 255) + 1]), 4294967295::bigint)) % 10000 as bucket from (select distinct g from counted), crc_table),
f as (select id, target, bucket, sum(n) as n from counted join hashed using (g) group by all),
totals as (select coalesce(sum(n) filter (where not target), 0)::double as s, coalesce(sum(n) filter (where target), 0)::double as t from f),
gains as (select bucket, floor(1000 * ln((coalesce(sum(n) filter (where target), 0)::double + 1) * (any_value(totals.s) + 10000) / ((coalesce(sum(n) filter (where not target), 0)::double + 1) * (any_value(totals.t) + 10000))))::bigint as gain from f, totals group by bucket),
d as (select id as doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight from f join gains using (bucket) where not target group by id),
e as (select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint as score from (select id as doc_id, w from words where not target) left join d using (doc_id)),
o as (select doc_id, row_number() over (order by score desc, doc_id) as rank from e where n_words >= 20)
select doc_id, n_features, weight, score, case when rank <= 5 * (select count(*) from o) // 100 then rank end as rank from e left join o using (doc_id)""",
}
