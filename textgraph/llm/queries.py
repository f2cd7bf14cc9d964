"""The thin opN_ queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.llm import bpe, chat, decontaminate, lines, negatives, packing, pii, prefixes, quality_cnn, quality_rules, repeats, simhash, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",", "null"), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"),
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    vocabulary = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    return chat.read_back(chat.trees(rows, *vocabulary), *vocabulary)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality_cnn.score(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "row.doc_id",
        F.coalesce(quality_cnn.fold("row.doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "text", "n_lines", "n_removed")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), max_docs=1000).drop("text")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.number_of("base", k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS[:4], 1)]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, word_tokenizer()).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, P.PATTERN, carry=["doc_id"]), path)
    return found.select("row.doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    return prefixes.trie(table(spark, sf_dir, "conversations"), conv - conv % 100, F.crc32(conv.cast("string")) % 6)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_chat, op3_warc, op4_quality_cnn, op5_lines, op6_quality_rules, op7_repeats, op8_simhash, op9_personal_data, op10_packing, op11_bpe, op12_hard_negatives, op13_prefix_trie)}

OP6_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(source, '') as host, coalesce(text, '') as t from documents),
w as (select r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from d),
k as (select r, i, array_to_string(ws[i:i+4], ' ') as k from (select r, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)),
c as (select distinct r, i + unnest(range(5)) as i from (select r, i from k qualify count(*) over (partition by r, k) > 1)),
rep as (select r, count(*) as n from c group by r),
l as (select r, host, unnest(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) as x from d),
dup as (select r, count(*) - count(distinct x) as n, sum(length(x)) as total from l group by r),
n as (select r, host, length(x) as c, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')) as h from l),
f as (select host, h from (select host, h, count(distinct r) as n from n group by host, h) join (select host, count(*) as docs from d group by host) using (host)
      where n > 20 and n > 0.05 * docs or n > 1000),
gone as (select r, sum(c) as n from n where (host, h) in (select (host, h) from f) group by r),
m as (select d.doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines,
      coalesce(rep.n, 0)::bigint as n_repeat_words, coalesce(gone.n, 0)::bigint as removed_chars, coalesce(dup.total, 0)::bigint as line_chars
      from d join w using (r) left join rep using (r) left join dup using (r) left join gone using (r))
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and line_chars - removed_chars >= 0.5 * line_chars as kept from m
"""

OP3_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h)::bigint as payload_bytes, sha1(h) as payload_digest from p),
r as (select payload_digest, max(page_id) as response from d where payload_bytes >= 1000 group by payload_digest)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < response then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < response then response end as refers_to
from d left join r using (payload_digest)
"""

#: Windows by their words; spans as start:end of runs of hit words, in code points.
OP1_SQL = r"""
with t as (select row_number() over () as r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
d as (select r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws, regexp_extract_all(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') as gaps,
      regexp_matches(t, '^[\x00-\x2F\x3A-\x60\x7B-\x7F]') as led from t),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
v as (select item_id, least(13, len(ws)) as n, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) as i from b where len(ws) > 0),
win as (select distinct item_id, n, array_to_string(ws[i:i+n-1], ' ') as win from v),
p as (select r, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, (select distinct n from win) where len(ws) >= n),
found as (select r, i, n, item_id from (select r, i, n, array_to_string(ws[i:i+n-1], ' ') as win from p) join win using (n, win)),
hit as (select distinct r, i + unnest(range(n)) as i from (select distinct r, i, n from found)),
h as (select r, count(*) as n_hit from hit group by r),
m as (select r, count(distinct item_id) as n_items, array_to_string(list_sort(list(distinct item_id::varchar)), ',') as items from found group by r),
w as (select r, i, length(ws[i]) as c, coalesce(length(gaps[if(led, i, i - 1)]), 0) as g from (select r, ws, gaps, led, unnest(range(1, len(ws) + 1)) as i from d where r in (select r from hit))),
places as (select r, i, (sum(g) over o + sum(c) over o - c)::bigint as start, (sum(g) over o + sum(c) over o)::bigint as stop from w window o as (partition by r order by i)),
runs as (select r, i - row_number() over (partition by r order by i) as run, start, stop from hit join places using (r, i)),
spans as (select r, string_agg(start || ':' || stop, ',' order by start) as spans from (select r, min(start) as start, max(stop) as stop from runs group by r, run) group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated, coalesce(spans, '') as spans
from d left join h using (r) left join m using (r) left join spans using (r)
"""

#: A turn's frame is 13 characters and a line feed, or 7 and a line feed for the assistant; a backslash is added for each match.
OP2_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
      coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
      sum(if(role = 'assistant', 8, 14) + length(role) + length(text) + len(regexp_extract_all(role, '\\|\n|\[INST\]|\[/INST\]|<s>|</s>'))
          + len(regexp_extract_all(text, '\\|\[INST\]|\[/INST\]|<s>|</s>'))) as chars from c group by conv_id)
select conv_id, n_turns::bigint as n_turns, sha256(turns) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256, chars::bigint as formatted_chars from g
"""

#: Every string of 100 bytes by itself, in the order of the corpus; runs of removed ones; the bytes between them.
OP7_SQL = """
with d as (select row_number() over (order by doc_id nulls first, text nulls first) as r, doc_id, encode(coalesce(text, '')) as b from documents),
s as (select r, i, b[i+1:i+100] as s from (select r, b, unnest(range(octet_length(b) - 99)) as i from d where octet_length(b) >= 100)),
gone as (select r, i from (select r, i, row_number() over (partition by s order by r, i) as k from s) where k > 1),
runs as (select r, i, sum(new) over (partition by r order by i) as run from (select r, i, if(i <= lag(i) over (partition by r order by i) + 100, 0, 1) as new from gone)),
spans as (select r, min(i) as start, max(i) + 100 as stop from runs group by r, run),
edges as (select r, start, stop from spans union all select r, octet_length(b), null from d),
pieces as (select r, coalesce(lag(stop) over (partition by r order by start, stop nulls last), 0) as a, start as z, stop from edges),
kept as (select r, count(stop) as n_spans, sum(z - a) as n_kept, string_agg(hex(b[a+1:z]), '' order by a, z) as kept from pieces join d using (r) group by r)
select doc_id, octet_length(b)::bigint as n_bytes, (octet_length(b) - n_kept)::bigint as n_removed, n_spans::bigint as n_spans, sha256(unhex(kept)) as kept_sha256
from d join kept using (r)
"""

OP12_SQL = """
with v as (select vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
           where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, list_inner_product(a.e, r.e)::bigint as score from v a join v r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id),
p as (select anchor_id, id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (select anchor_id, positive_id, id as negative_id, positive_score, score as negative_score, row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank
      from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score)
select * from n where rank <= 5
"""

#: The CRC bit by bit; nodes by the lists of their turns; sums over subtrees by each node's ancestors.
OP13_SQL = """
with c as (select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as ts
           from conversations where conv_id is not null group by conv_id),
x as (select conv_id, ts, list_transform(string_split(conv_id::varchar, ''), lambda a: ascii(a)::bigint) as bytes from c),
h as (select conv_id, ts, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b:
             list_reduce(list_prepend(xor(a, b), range(8)), lambda v, k: if(v % 2 = 1, xor(v // 2, 3988292384), v // 2))), 4294967295) % 6 as h from x),
b as (select h.conv_id, list_concat(coalesce(o.ts[1:h.h], []), h.ts[h.h+1:]) as ts from h left join c o on o.conv_id = h.conv_id - h.conv_id % 100),
m as (select conv_id, depth, ts[1:depth] as prefix, len(ts) = depth as ended from (select conv_id, ts, unnest(range(0, len(ts) + 1)) as depth from b)),
n as (select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * coalesce(length(prefix[depth].t), 0) as saved,
             coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '') as ids from m group by prefix, depth),
k as (select prefix[1:depth-1] as prefix, count(*) as n_children from n where depth > 0 group by 1),
j as (select n.*, coalesce(n_children, 0) as n_children from n left join k using (prefix)),
s as (select prefix[1:up] as prefix, sum(saved) as saved, count(*) filter (n_children = 0) as leaves from (select *, unnest(range(0, depth + 1)) as up from j) group by 1)
select j.conv_id, j.depth, p.conv_id as parent_conv_id, j.n_convs, j.n_children, s.leaves as n_leaves, s.saved::bigint as saved_tokens, sha256(j.ids) as ends_sha256
from j join s using (prefix) left join n p on j.depth > 0 and p.prefix = j.prefix[1:j.depth-1]
"""

ORACLE_SQL: dict[str, str] = {"op1_decontaminate": OP1_SQL, "op2_chat": OP2_SQL, "op7_repeats": OP7_SQL, "op3_warc": OP3_SQL, "op6_quality_rules": OP6_SQL, "op12_hard_negatives": OP12_SQL, "op13_prefix_trie": OP13_SQL}
