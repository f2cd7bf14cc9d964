"""Queries over the driver's tables, one or more for each operator, with independent DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textgraph.functions import replies as R
from textgraph.functions import text as X
from textgraph.functions.chunking import aligned_windows, fixed_windows
from textgraph.functions.sentences import group_sentences, split_sentences
from textgraph.functions.vocabulary import CANONICAL_PREDICATES, EVENT_WORDS, FILTER_WORDS, PREDICATE_MAP, QUESTION_TYPES, SUFFIXES, TITLES
from textgraph.operators import evidence as E
from textgraph.operators import longbooks as LB
from textgraph.operators import longtext as L
from textgraph.operators import sections as S
from textgraph.operators import triples as T
from textgraph.plans import recipes as P
from textgraph.plans import runs
from textgraph.sources.workspace import kept, work_folder

#: The offline model's calls cost nothing, so a task commits many at a time.
OFFLINE = 100_000

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its DuckDB SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.recipe(spark, sf_dir, P.TRIPLES)


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select(F.col("doc_id").alias("book"), "text")


# --- books and windows -------------------------------------------------------------------------------------------

G1 = r"""
with recursive d as (select doc_id, text as t, length(text) as n from documents where length(text) > 0),
w as (select doc_id, t, n, 0 as st, 1 as k from d
      union all
      select doc_id, t, n, raw + case when m > 0 then m else sp end, k + 1 from (
        select *, length(regexp_extract(substring(t, raw + 1, 200), '(?s)^.*?[.!?。！？…]["''」』]?\s+')) as m,
               length(regexp_extract(substring(t, raw + 1, 200), '(?s)^.*?\s')) as sp
        from (select doc_id, t, n, st + 3000 as raw, k from w where st + 3000 < n))),
e as (select *, case when least(st + 4000, n) < n and f > 0 and low + f > st then low + f else least(st + 4000, n) end as fin from (
        select *, length(regexp_extract(substring(t, low + 1, least(st + 4000, n) - low), '(?s)^.*[.!?。！？…]["''」』]?')) as f
        from (select *, greatest(st, least(st + 4000, n) - 200) as low from w))),
g1 as (select doc_id, st as start, fin as "end", regexp_replace(substring(t, st + 1, fin - st), '^\s+|\s+$', '', 'g') as text from e)
"""
G2 = r"""
with d as (select doc_id, text as t, length(text) as n from documents where length(text) > 0),
w as (select doc_id, t, n, unnest(generate_series(0, n - 1, 3000)) as st from d),
e as (select *, case when least(st + 4000, n) < n and f > 0 and low + f > st then low + f else least(st + 4000, n) end as fin from (
        select *, length(regexp_extract(substring(t, low + 1, least(st + 4000, n) - low), '(?s)^.*[.!?]')) as f
        from (select *, greatest(st, least(st + 4000, n) - 200) as low from w))),
g2 as (select doc_id, st as start, fin as "end", regexp_replace(substring(t, st + 1, fin - st), '^\s+|\s+$', '', 'g') as text from e),
s as (select doc_id as book, start, "end", text, row_number() over (partition by doc_id order by start) as section_idx,
             count(*) over (partition by doc_id) as section_total, row_number() over (order by doc_id, start) as global_idx from g2 where text <> '')
"""


@query(G1 + """, c as (select doc_id, count(*) as windows from g1 where text <> '' group by doc_id)
select cast(d.doc_id as varchar) as name, strlen(t) // 1024 as size_kb, n as chars, n // 4 as est_tokens, windows from d join c using (doc_id)""")  # fmt: skip
def book_catalog(spark, sf_dir):
    return S.catalog(docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("name"), "text"))


@query(r"""select name, case when name = 'Dracula.cleaned.txt' then 'Dracula' else regexp_replace(split_part(text, chr(10), 1), '^\s+|\s+$', '', 'g') end as title
from (select case when doc_id % 7 = 0 then 'Dracula.cleaned.txt' else doc_id || '.cleaned.txt' end as name, text from documents)""")
def book_title(spark, sf_dir):
    name = F.when(F.col("doc_id") % 7 == 0, "Dracula.cleaned.txt").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".cleaned.txt")))
    return docs(spark, sf_dir).select(name.alias("name"), S.title(name, F.col("text")).alias("title"))


@query(G1 + """select doc_id, start, "end", text from g1 where text <> ''""")
def chunk_sentence_aligned(spark, sf_dir):
    return X.each(docs(spark, sf_dir), aligned_windows(F.col("text")), "doc_id").select("doc_id", "c.*")


@query(G1 + """select doc_id, start, "end", text from g1 where text <> ''""")
def chunk_aligned_pieces(spark, sf_dir):
    """The same windows of texts that lie in pieces of some thousand characters, no row of which holds a text."""
    size, folder = 5000, work_folder(spark)
    many = docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("book"), "text").where("text <> ''")
    many = many.select("book", "text", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / size))).alias("k"))
    pieces = many.select("book", F.col("k").cast("long").alias("k"), F.substring("text", (F.col("k") * size + 1).cast("int"), F.lit(size)).alias("text"))
    found = LB.aligned(pieces, lambda df, name: kept(df, folder, name))
    return found.select(F.col("book").cast("long").alias("doc_id"), "start", "end", "text")


@query(G2 + """select doc_id, start, "end", text from g2 where text <> ''""")
def chunk_fixed_stride(spark, sf_dir):
    return X.each(docs(spark, sf_dir), fixed_windows(F.col("text")), "doc_id").select("doc_id", "c.*")


@query(G2 + """select book, section_idx, section_total, start, "end", global_idx from s""")
def section_numbering(spark, sf_dir):
    return S.tasks(books(spark, sf_dir), aligned=False, texts=False)


@query(G2 + """select global_idx, book, section_idx as section_within_book, start, "end" from s""")
def registry_slim(spark, sf_dir):
    return S.registry_slim(S.tasks(books(spark, sf_dir), aligned=False, texts=False))


@query(G2 + """select book, string_agg('[Section ' || section_idx || ']' || chr(10) || text, chr(10) || chr(10) order by section_idx) as text from s group by book""")
def section_concat(spark, sf_dir):
    return S.ordered_concat(S.windows(books(spark, sf_dir), aligned=False), ["book"], "section_idx", S.labelled("section_idx", "text"), "\n\n")


@query(G2 + "select count(*) as total_windows, count(distinct book) as books from s")
def windows_total(spark, sf_dir):
    return S.windows(books(spark, sf_dir), aligned=False, texts=False).agg(F.count("*").alias("total_windows"), F.countDistinct("book").alias("books"))


SENTENCES = r"""
with d as (select doc_id, text as t, length(text) as n from documents where length(text) > 0),
c as (select doc_id, t, n, list_filter(range(1, n + 1), lambda i: substring(t, i, 1) in ('.', '!', '?')) as ends from d),
e as (select doc_id, t, n, list_concat([0], list_filter(ends, lambda i: i = n or regexp_matches(substring(t, i + 1), '^\s*$')
        or (regexp_matches(substring(t, i + 1, 100), '^\s*\p{Lu}') and contains(substring(t, i + 1, 2), ' '))), [n]) as cut from c),
p as (select doc_id, unnest(list_transform(range(1, len(cut)), lambda k: struct_pack(k := k, s := regexp_replace(substring(t, cut[k] + 1, cut[k + 1] - cut[k]), '^\s+|\s+$', '', 'g')))) as x from e),
q as (select doc_id, row_number() over (partition by doc_id order by x.k) as pos, x.s as sentence from p where x.s <> '')
"""


@query(SENTENCES + "select doc_id, pos, sentence from q")
def sentence_split(spark, sf_dir):
    found = X.each(docs(spark, sf_dir), split_sentences(F.col("text")), "doc_id", value="sentence")
    return found.select("doc_id", (F.col("k") + 1).alias("pos"), "sentence")


@query(SENTENCES.replace("with d", "with recursive d") + r""",
r as (select doc_id, pos, sentence as now, 1 as grp from q where pos = 1
      union all
      select r.doc_id, q.pos, case when length(now) + length(sentence) > 800 then sentence else now || ' ' || sentence end,
             case when length(now) + length(sentence) > 800 then grp + 1 else grp end
      from r join q on q.doc_id = r.doc_id and q.pos = r.pos + 1)
select doc_id, grp as pos, arg_max(now, r.pos) as chunk from r group by doc_id, grp""")  # fmt: skip
def sentence_group(spark, sf_dir):
    found = X.each(docs(spark, sf_dir), group_sentences(split_sentences(F.col("text"))), "doc_id", value="chunk")
    return found.select("doc_id", (F.col("k") + 1).alias("pos"), "chunk")


#: Documents bound in volumes, each one text: of every fiftieth document, joined by empty lines.
VOLUMES = r"""
with recursive d as (select 'v' || (doc_id % 50) as text_id, string_agg(t, chr(10) || chr(10) order by doc_id, t) as t
  from (select doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') as t from documents) where t <> '' group by 1),
c as (select text_id, unnest(string_split(t, '')) as c, generate_subscripts(string_split(t, ''), 1) as i from d),
n as (select text_id, t, length(t) as n from d),
e as (select text_id, i from c join n using (text_id) where c in ('.', '!', '?') and (i = n or regexp_matches(substring(t, i + 1), '^\s*$')
  or (regexp_matches(substring(t, i + 1, 100), '^\s*\p{Lu}') and contains(substring(t, i + 1, 2), ' ')))),
f as (select text_id, i as fin, coalesce(lag(i) over (partition by text_id order by i), 0) as st from (select text_id, i from e union select text_id, n from n)),
p as (select text_id, fin, regexp_replace(substring(t, st + 1, fin - st), '^\s+|\s+$', '', 'g') as s from f join n using (text_id)),
u as (select text_id, fin, case when length(s) > 1600 and contains(s, chr(10) || chr(10)) then string_split(s, chr(10) || chr(10)) else [s] end as l from p where s <> ''),
v as (select text_id, fin, unnest(range(1, len(l) + 1)) as k, regexp_replace(unnest(l), '^\s+|\s+$', '', 'g') as sentence from u),
q as (select text_id, sentence, row_number() over (partition by text_id order by fin, k) as pos from v where sentence <> ''),
r as (select text_id, pos, sentence as now, 0::bigint as grp from q where pos = 1
      union all
      select r.text_id, q.pos, case when length(now) + length(sentence) > 800 then sentence else now || ' ' || sentence end,
             case when length(now) + length(sentence) > 800 then grp + 1 else grp end
      from r join q on q.text_id = r.text_id and q.pos = r.pos + 1),
g as (select text_id, grp as pos, arg_max(now, r.pos) as text from r group by text_id, grp)
"""


def _volumes(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.concat(F.lit("v"), (F.col("doc_id") % 50).cast("string")).alias("text_id"), "doc_id", X.strip(F.col("text")).alias("text")).where("text <> ''")
    order = Window.partitionBy("text_id").orderBy("doc_id", "text")
    return rows.select("text_id", (F.row_number().over(order) - 1).cast("long").alias("k"), "text")


@query(VOLUMES + "select text_id, pos, text from g")
def long_text_groups(spark, sf_dir):
    """Sentences grouped over whole volumes, no row of which holds a volume."""
    folder = work_folder(spark)
    return L.groups(_volumes(spark, sf_dir), "\n\n", lambda df, name: kept(df, folder, name))


@query(VOLUMES + r""", z as (select text_id, pos, coalesce(nullif(regexp_replace(left(text, greatest(1, length(text) // 2)), '\s+$', ''), ''), text) as text from g)
select d.text_id, case when length(t) > 4000 then x else t end as text from d join (select text_id, string_agg(text, ' ' order by pos) as x from z group by text_id) using (text_id)""")  # fmt: skip
def compress_round(spark, sf_dir):
    """Volumes after a round of compression by the offline model, which keeps the first half of each group."""
    return runs.compress(_volumes(spark, sf_dir), work_folder(spark), rounds=1, workers=runs.WORKERS, commit=OFFLINE)


# --- replies -----------------------------------------------------------------------------------------------------


@query(f"select ord as reply_id, subject, predicate, object from ({P.TRIPLES}) t")
def parse_triples_block(spark, sf_dir):
    return P.recipe(spark, sf_dir, P.BLOCK_REPLIES).select("reply_id", F.inline(R.triples_of_block(F.col("reply"))))


@query(f"select ord as reply_id, subject, case when ord % 3 = 0 then predicate else '' end as predicate, object from ({P.TRIPLES}) t where ord % 3 < 2")
def parse_triples_lines(spark, sf_dir):
    return P.recipe(spark, sf_dir, P.LINE_REPLIES).select("reply_id", F.inline(R.triples_of_lines(F.col("reply"))))


@query(rf"""select reply_id, contains(v, 'PASS') and not contains(v, 'FAIL') as passed, regexp_extract(reply, '(?is)\[FEEDBACK\]\s*(.*?)\s*\[/FEEDBACK\]', 1) as feedback
from (select *, upper(regexp_extract(reply, '(?is)\[VERDICT\]\s*(.*?)\s*\[/VERDICT\]', 1)) as v from ({P.VERDICTS}))""")
def parse_verdict(spark, sf_dir):
    return P.recipe(spark, sf_dir, P.VERDICTS).select("reply_id", R.verdict(F.col("reply")).alias("v")).select("reply_id", "v.*")


@query(f"""with t as ({P.TRIPLES}), l as (select ord, 0 as g, 0 as k, object as variant, object as canonical from t union all select ord, 0, 1, subject, object from t
union all select ord, 1, 0, subject, subject from t union all select ord, 1, 1, predicate, subject from t)
select variant, arg_max(canonical, row(ord, g, k)) as canonical from l where k = 0 or variant <> canonical group by variant""")
def parse_groups(spark, sf_dir):
    return T.mapping_of(P.recipe(spark, sf_dir, P.GROUPS))


@query(f"select book, win, string_agg(subject || '||' || predicate || '||' || object, chr(10) order by ord) as text from ({P.TRIPLES}) t group by book, win")
def format_triples(spark, sf_dir):
    each = F.array_sort(F.collect_list(F.struct("ord", "subject", "predicate", "object")))
    return triples(spark, sf_dir).groupBy("book", "win").agg(each.alias("t")).select("book", "win", R.format_triples(F.col("t")).alias("text"))


# --- triples -----------------------------------------------------------------------------------------------------

_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in PREDICATE_MAP.items())
_CANONICAL = ", ".join(f"'{p}'" for p in CANONICAL_PREDICATES)
NORMALIZED = f"""select ord, subject, p as predicate, object, book, win from (
select t.*, case when predicate in ({_CANONICAL}) then predicate when m.k is not null then case when m.v in ({_CANONICAL}) then m.v end
  when upper(predicate) in ({_CANONICAL}) then upper(predicate) end as p
from ({P.TRIPLES}) t left join (select * from (values {_VALUES}) as m(k, v)) m on m.k = trim(predicate)) where p is not null"""
CANONICALIZED = f"""select * from (with t as ({P.TRIPLES}), m as ({P.MAPPING}),
n as (select t.*, coalesce(a.canonical, subject) as ns, coalesce(b.canonical, object) as no from t left join m a on a.variant = subject left join m b on b.variant = object),
x as (select ord, 0 as side, ns as subject, subject as object, book, win from n where ns <> subject
      union all select ord, 1, no, object, book, win from n where no <> object and no <> ns)
select 0 as part, ord, ns as subject, predicate, no as object, book, win from n
union all select 1, ord, subject, 'ALIAS', object, book, win from x qualify row_number() over (partition by subject, object order by ord, side) = 1)"""


def _ruled(source: str, main: bool) -> str:
    own = r"contains(object, '''') or regexp_matches(lower(object), '\b(at|on|in|near|by|from|for|with|of|to|over|under)\b')"
    if not main:
        own = "contains(object, '''s') or " + " or ".join(f"contains(lower(object), '{w}')" for w in EVENT_WORDS)
    first = r"lower(regexp_extract(object, '^\s*(\S+)', 1))"
    words = r"len(list_filter(string_split_regex(object, '\s+'), lambda x: x <> ''))"
    return f"""select * from (with r as ({source})
select *, case when subject = object then 'self_ref'
  when predicate = 'ALIAS' and subject in (select object from r where predicate = 'HAS_ATTRIBUTE') then 'alias_attr_subj'
  when predicate = 'ALIAS' and subject in (select object from r where predicate = 'HAS_ROLE') then 'alias_role_subj'
  when predicate = 'ALIAS' and ({own} or {words} > 5 or contains(lower(object), 'of ' || subject) or ({first} like '%ing' and {first} not in ('nothing', 'something', 'everything'))) then 'alias_event_desc'
  when predicate = 'PARTICIPATES_IN' and object in (select subject from r) then 'participates_entity'
  when predicate = 'PARTICIPATES_IN' and contains(object, '''s') then 'participates_possessive'
  when predicate = 'HAS_ATTRIBUTE' and {words} > 5 then 'attr_too_long'
  when predicate = 'HAS_ATTRIBUTE' and object in (select subject from r) then 'attr_is_entity'
  when predicate = 'HAS_ATTRIBUTE' and contains(object, '''s') then 'attr_possessive'
  when predicate = 'HAS_ROLE' and object in (select subject from r) then 'role_is_entity'
  when predicate = 'OWNS' and object in (select subject from r) then 'owns_person'
  when predicate in ('LOVES', 'MARRIES', 'REJECTS', 'PROPOSES_TO', 'RIVALS') and lower(object) in ('nobody', 'someone', 'soldier', 'anyone') then 'relation_vague_obj' end as rule
from r)"""


def _merged(source: str) -> str:
    return f"""select subject, predicate, object, string_agg(book || ':' || win, '; ' order by book, win) as evidence, count(*) as evidence_count
from (select distinct subject, predicate, object, book, win from ({source})) group by all"""


def _first(source: str) -> str:
    return f"select subject, predicate, object, min(ord) as first_ord from ({source}) group by all"


@query(NORMALIZED)
def normalize_predicates(spark, sf_dir):
    return T.normalize_predicates(triples(spark, sf_dir))


@query(f"select entity from (select subject as entity from ({P.TRIPLES}) t union select object from ({P.TRIPLES}) u) where length(entity) >= 2")
def entity_candidates(spark, sf_dir):
    return T.entity_candidates(triples(spark, sf_dir))


@query(CANONICALIZED)
def canonicalize(spark, sf_dir):
    return T.canonicalize(triples(spark, sf_dir), spark.sql(P.MAPPING))


@query(f"select subject, object, ord, book, win from ({CANONICALIZED}) where part = 1")
def alias_emission(spark, sf_dir):
    return T.canonicalize(triples(spark, sf_dir), spark.sql(P.MAPPING)).where("part = 1").select("subject", "object", "ord", "book", "win")


def _rule_queries(main: bool) -> None:
    name = "main" if main else "hier"
    QUERIES[f"quality_filter_{name}"] = lambda spark, sf_dir: T.ruled(triples(spark, sf_dir), main)
    ORACLE_SQL[f"quality_filter_{name}"] = _ruled(P.TRIPLES, main)
    QUERIES[f"quality_counts_{name}"] = lambda spark, sf_dir: T.rule_counts(triples(spark, sf_dir), main)
    ORACLE_SQL[f"quality_counts_{name}"] = f"select coalesce(rule, 'kept') as rule, count(*) as n from ({_ruled(P.TRIPLES, main)}) group by 1"


_rule_queries(True)
_rule_queries(False)


@query(_merged(P.TRIPLES))
def dedup_evidence(spark, sf_dir):
    return T.dedup_evidence(triples(spark, sf_dir))


@query(_first(P.TRIPLES))
def dedup_plain(spark, sf_dir):
    return T.dedup_plain(triples(spark, sf_dir))


@query(_merged(f"select * from ({_ruled(CANONICALIZED, True)}) where rule is null"))
def post_process_main(spark, sf_dir):
    return T.post_process_main(triples(spark, sf_dir), spark.sql(P.MAPPING))


@query(_first(f"select * from ({_ruled(NORMALIZED, False)}) where rule is null"))
def post_process_hier(spark, sf_dir):
    return T.post_process_hier(triples(spark, sf_dir))


@query(f"select predicate, list_sort(list(distinct object)) as objects from ({P.TRIPLES}) t where predicate in ('HAS_ATTRIBUTE', 'HAS_ROLE') group by predicate")
def predicate_sets(spark, sf_dir):
    return triples(spark, sf_dir).where(F.col("predicate").isin("HAS_ATTRIBUTE", "HAS_ROLE")).groupBy("predicate").agg(F.array_sort(F.collect_set("object")).alias("objects"))


@query(f"select distinct on (subject, object) subject, object, predicate, ord from ({P.TRIPLES}) t order by subject, object, ord")
def first_occurrence(spark, sf_dir):
    return T.first_occurrence(triples(spark, sf_dir), ["subject", "object"], ["ord"]).select("subject", "object", "predicate", "ord")


# --- cleaning ----------------------------------------------------------------------------------------------------


def _stripped(name: str) -> str:
    suffix = rf"(?:\s*,\s*)?\s+(?:{SUFFIXES})$"
    for _ in range(5):
        name = rf"trim(regexp_replace(regexp_replace({name}, '^(?:{TITLES})(?:\s+|$)', '', 'i'), '{suffix}', '', 'i'))"
    return name


_WORD_LIST = ", ".join(f"'{w}'" for w in FILTER_WORDS)
REASONS = rf"""select ord, subject, predicate, object, book, win, case when len(w) > 0 then w[1] when oc = '' then 'low_value_alias' when sc = '' then null
  when sc = oc or sc like '% ' || oc or sc like oc || ' %' then 'low_value_alias' end as reason
from (select *, list_filter([{_WORD_LIST}], lambda x: regexp_matches(subject, '(?i)\b' || x || '\b') or regexp_matches(object, '(?i)\b' || x || '\b')) as w,
      lower({_stripped("subject")}) as sc, lower({_stripped("object")}) as oc from ({P.TRIPLES}) t)"""


@query(f"select name, {_stripped('name')} as core from ({P.NAMES}) n")
def strip_titles(spark, sf_dir):
    return P.recipe(spark, sf_dir, P.NAMES).select("name", X.strip_titles(F.col("name")).alias("core"))


@query(REASONS)
def clean_reasons(spark, sf_dir):
    return T.clean_reasons(triples(spark, sf_dir))


@query(f"select ord, subject, predicate, object, book, win from ({REASONS}) where reason is null")
def clean_filter(spark, sf_dir):
    return T.clean_filter(triples(spark, sf_dir))


@query(f"""select count(*) as total, count(*) filter (reason <> 'low_value_alias') as phase1, count(*) filter (reason = 'low_value_alias') as phase2,
count(*) filter (reason is null) as kept from ({REASONS})""")
def clean_counts(spark, sf_dir):
    return T.clean_counts(triples(spark, sf_dir))


# --- answers and evidence ----------------------------------------------------------------------------------------

CITED = f"""select qa_idx, unnest([cast(qa_idx % 20 + 1 as int), cast(qa_idx % 20 + 2 as int), 9999]) as section from ({P.ANSWERS}) a"""


@query(f"""select qa_idx, 'Claim A [' || (qa_idx % 20 + 1) || ']. Claim B [' || (qa_idx % 20 + 1) || '][' || (qa_idx % 20 + 2) || '] end [9999]' as text from ({P.ANSWERS}) a""")
def citations_normalize(spark, sf_dir):
    return P.recipe(spark, sf_dir, P.ANSWERS).select("qa_idx", X.normalize_citations(F.col("answer")).alias("text"))


@query(CITED)
def citations_extract(spark, sf_dir):
    return E.cited(P.recipe(spark, sf_dir, P.ANSWERS).withColumn("response", F.lit("")))


@query(f"select qa_idx, 'Claim A. Claim B [' || (qa_idx % 20 + 1) || ', ' || (qa_idx % 20 + 2) || '] end' as text from ({P.ANSWERS}) a")
def citations_strip(spark, sf_dir):
    return P.recipe(spark, sf_dir, P.ANSWERS).select("qa_idx", X.strip_citations(F.col("answer")).alias("text"))


@query(G2 + f"""select qa_idx, count(*) as n_cited, string_agg('[' || section || '] (' || book || ', chars ' || start || '-' || "end" || ')' || chr(10) || text,
chr(10) || chr(10) || '---' || chr(10) || chr(10) order by section) as text from ({CITED}) c join s on s.global_idx = c.section group by qa_idx""")
def cited_sections(spark, sf_dir):
    return _cited_text(spark, sf_dir, citations_extract(spark, sf_dir))


def _cited_text(spark, sf_dir, references):
    limits = S.limits(books(spark, sf_dir), aligned=False)
    return E.cited_text(references, _texts(spark, sf_dir, limits, references), numbers=limits)


def _texts(spark, sf_dir, limits, references):
    """The sections that are cited at all, with their texts."""
    return S.texts_of(limits.join(references.select(F.col("section").alias("global_idx")).distinct(), "global_idx", "left_semi"), books(spark, sf_dir))


MANY = """select distinct doc_id // 40 as qa_idx, (doc_id * 7919) % n + 1 as section from documents cross join (select count(*) as n from documents)"""


@query(G2 + f""", m as (select qa_idx, section, book, start, "end", text, row_number() over (partition by qa_idx order by section) as k, count(*) over (partition by qa_idx) as n_cited
  from ({MANY}) c join s on s.global_idx = c.section)
select qa_idx, n_cited, string_agg('[' || section || '] (' || book || ', chars ' || start || '-' || "end" || ')' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by section)
  || case when n_cited > 30 then chr(10) || chr(10) || '---' || chr(10) || chr(10) || '{E.OMITTED}' else '' end as text from m where k <= 30 group by qa_idx, n_cited""")  # fmt: skip
def cited_sections_capped(spark, sf_dir):
    """Answers that cite forty sections, from all over the books."""
    rows = docs(spark, sf_dir)
    number = (F.col("doc_id") * 7919) % F.lit(rows.count()) + 1
    answers = rows.groupBy(F.floor(F.col("doc_id") / 40).alias("qa_idx")).agg(F.concat_ws(" and ", F.collect_list(F.concat(F.lit("["), number.cast("string"), F.lit("]")))).alias("answer"))
    return _cited_text(spark, sf_dir, E.cited(answers.withColumn("response", F.lit(""))))


@query("""select doc_id, doc_id % 5 in (0, 3) as auto from documents""")
def auto_answers(spark, sf_dir):
    d = F.col("doc_id")
    text = F.when(d % 5 == 0, F.concat(F.lit('[{"question": "q", "answer": "'), d.cast("string"), F.lit('"}]'))).when(d % 5 == 1, '{"a": [1]}').when(d % 5 == 2, "[no list").when(d % 5 == 3, " [] ")
    return docs(spark, sf_dir).select("doc_id", X.is_list(text).alias("auto"))


@query("""select doc_id as reply_id, 0 as qa_idx, 'b' as book, 'q' || doc_id as question, case when doc_id % 3 = 0 then 'a [1]' else 'a' end as answer, cast(null as varchar) as response from documents where doc_id % 3 < 2
union all select doc_id, 1, null, 'r', null, 's' || doc_id from documents where doc_id % 3 = 1""")
def qa_explode(spark, sf_dir):
    return E.qa_items(P.recipe(spark, sf_dir, P.ITEMS)).drop("item")


@query("""select doc_id as reply_id, 1 as pos, 'q' || doc_id as question, case when doc_id % 3 = 0 then 'a [1]' else 'a' end as answer from documents where doc_id % 3 < 2
union all select doc_id, 2, 'r', '' from documents where doc_id % 3 = 1""")
def qa_pairs(spark, sf_dir):
    found = E.qa_items(P.recipe(spark, sf_dir, P.ITEMS))
    blank = F.lit("")
    return found.select("reply_id", (F.col("qa_idx") + 1).alias("pos"), F.coalesce("question", blank).alias("question"), F.coalesce("answer", blank).alias("answer"))


@query(r"select doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') as text from documents")
def strip_fence(spark, sf_dir):
    fenced = F.concat(F.lit(" ```JSON \n"), "text", F.lit("\n``` "))
    return docs(spark, sf_dir).select("doc_id", X.strip_code_fence(fenced).alias("text"))


@query("""select doc_id, case doc_id % 3 when 0 then '[{"a":1},{"b":' || doc_id || '}]' when 1 then '[' || doc_id || ']' else '{"a":' || doc_id || '}' end as text from documents""")
def repair_json(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    broken = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('x [{"a":1} {"b":'), n, F.lit("},] y"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("so: ["), n, F.lit("] ok"))).otherwise(F.concat(F.lit(' {"a":'), n, F.lit("} ")))
    return docs(spark, sf_dir).select("doc_id", X.repair_json(broken).alias("text"))


@query(r"""select doc_id, lower(regexp_replace(regexp_replace('say "' || nfc_normalize(text) || '" -- - x', '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) as text from documents""")
def normalize_text(spark, sf_dir):
    raw = F.concat(F.lit('say \\"'), F.col("text"), F.lit('\\" — –\\nx'))
    return docs(spark, sf_dir).select("doc_id", X.normalize_text(raw).alias("text"))


CONFIDENCE = rf"""select qa_idx, ev_idx, evidence, case when contains(src, ev) then 1.0::double else
  coalesce(list_max(list_transform(range(0, length(ev)), lambda i: coalesce(list_max(list_filter(range(20, length(ev) - i + 1), lambda n: contains(src, substring(ev, i + 1, n)))), 0))), 0) / length(ev)::double end as conf
from (select e.*, lower(regexp_replace(regexp_replace(evidence, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) as ev,
             lower(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) as src from ({P.EVIDENCE}) e join documents d on d.doc_id = e.qa_idx)"""


def _scored(spark, sf_dir):
    return E.scored(P.recipe(spark, sf_dir, P.EVIDENCE), docs(spark, sf_dir).select(F.col("doc_id").alias("qa_idx"), "text"))


@query(f"select qa_idx, ev_idx, conf = 1 as contained from ({CONFIDENCE})")
def evidence_match(spark, sf_dir):
    return _scored(spark, sf_dir).select("qa_idx", "ev_idx", (F.col("conf") == 1).alias("contained"))


@query(f"select qa_idx, ev_idx, evidence, conf from ({CONFIDENCE})")
def evidence_confidence(spark, sf_dir):
    return _scored(spark, sf_dir)


@query(rf"""select qa_idx, ev_idx, evidence, case when ev_idx = 0 then 1.0::double when length(ev) < 120 then 0.0::double else (length(ev) - 100) / length(ev)::double end as conf
from (select *, regexp_replace(regexp_replace(evidence, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') as ev from ({P.LONG_EVIDENCE}) e)""")
def evidence_long(spark, sf_dir):
    """Evidence of some hundred characters, half of which is quoted in part only."""
    return E.scored(P.recipe(spark, sf_dir, P.LONG_EVIDENCE), docs(spark, sf_dir).select(F.col("doc_id").alias("qa_idx"), "text"))


@query(f"select qa_idx, ev_idx, replace(left(evidence, 80), chr(10), ' ') as snippet, conf from ({CONFIDENCE}) where conf < 0.5")
def low_conf_audit(spark, sf_dir):
    return E.low_confidence(_scored(spark, sf_dir))


@query(f"select count(*) as total, count(*) filter (conf < 0.5) as low, count(*) filter (conf >= 0.5) as good from ({CONFIDENCE})")
def evidence_counts(spark, sf_dir):
    return E.evidence_counts(_scored(spark, sf_dir))


@query(r"""select doc_id as qa_idx, row_number() over (partition by doc_id order by k) - 1 as ev_idx, x as evidence
from (select doc_id, unnest(range(1, len(l) + 1)) as k, unnest(l) as x from (select doc_id, list_transform(string_split(text, chr(10)), lambda y: regexp_replace(y, '^\s+|\s+$', '', 'g')) as l from documents)) where x <> ''""")
def evidence_lines(spark, sf_dir):
    return E.evidence_lines(docs(spark, sf_dir).select(F.col("doc_id").alias("qa_idx"), F.concat(F.lit("```\n"), F.col("text"), F.lit("\n```")).alias("reply")))


TITLES_SQL = "select doc_id as ord, 'file ' || doc_id || '.cleaned.txt' as file, 'Title ' || doc_id as title from documents"
RAW_NAMES = "select distinct case doc_id % 4 when 0 then 'Title ' || (doc_id * 2) when 1 then cast(doc_id as varchar(9)) when 2 then '' else 'unknown ' || doc_id end as raw from documents"


@query(f"""select raw, coalesce(arg_min(title, ord), raw) as book from ({RAW_NAMES}) n left join ({TITLES_SQL}) t on raw = title or contains(file, raw) group by raw""")
def title_repair(spark, sf_dir):
    return E.repaired_titles(P.recipe(spark, sf_dir, RAW_NAMES), P.recipe(spark, sf_dir, TITLES_SQL))


@query(G2 + f"""select qa_idx, 'Title ' || qa_idx as book, 'q' as question, 'Claim A. Claim B [' || (qa_idx % 20 + 1) || ', ' || (qa_idx % 20 + 2) || '] end' as answer, cast(null as varchar) as response,
  coalesce(ev, []) as evidence, context
from ({P.ANSWERS}) a left join (select qa_idx as q, list(evidence order by ev_idx) as ev from ({P.EVIDENCE}) e group by 1) v on q = qa_idx
left join (select qa_idx as q2, list(text order by section) as context from ({CITED}) c join s on s.global_idx = c.section group by 1) x on q2 = qa_idx""")
def qa_assemble(spark, sf_dir):
    qa = P.recipe(spark, sf_dir, P.ANSWERS).select("qa_idx", F.concat(F.lit("file "), F.col("qa_idx").cast("string"), F.lit(".cleaned")).alias("book"), F.lit("q").alias("question"), "answer", F.lit(None).cast("string").alias("response"))
    registry = _texts(spark, sf_dir, S.limits(books(spark, sf_dir), aligned=False), E.cited(qa))
    return E.assembled(qa, P.recipe(spark, sf_dir, P.EVIDENCE), registry, P.recipe(spark, sf_dir, TITLES_SQL))


# --- control -----------------------------------------------------------------------------------------------------


@query("select doc_id, n_chars from documents where doc_id not in (select doc_id from labels)")
def pending_tasks(spark, sf_dir):
    done = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return S.pending(docs(spark, sf_dir).select("doc_id", "n_chars"), done, "doc_id")


@query("select d.doc_id, case when l.doc_id is null then text else 'done ' || quality end as text from documents d left join labels l on l.doc_id = d.doc_id")
def stage_overwrite(spark, sf_dir):
    done = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.concat(F.lit("done "), F.col("quality").cast("string")).alias("text"))
    return S.overwritten(docs(spark, sf_dir).select("doc_id", "text"), done, "doc_id")


_TYPE_ROWS = ", ".join("('{}', '{}', {}, {}, '{}')".format(k, label, "null" if b is None else "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in b) + "]", t, n) for k, label, b, t, n in QUESTION_TYPES)
TYPES_SQL = f"select * from (values {_TYPE_ROWS}) as t(type, label, books, temperature, num_questions)"


@query(f"select type, label, books, temperature::double as temperature, num_questions, (select count(*) from documents where list_contains(books, doc_id || '.cleaned.txt')) as available from ({TYPES_SQL})")
def type_registry(spark, sf_dir):
    """The question types, and how many of a type's books there are."""
    types = S.question_types(spark)
    names = docs(spark, sf_dir).select(F.concat(F.col("doc_id").cast("string"), F.lit(".cleaned.txt")).alias("name"))
    found = S.type_books(types, names).groupBy("type").agg(F.count("*").alias("available"))
    return types.join(found, "type", "left").withColumn("available", F.coalesce("available", F.lit(0)))


@query(f"""select w.wanted, t.type, t.label, t.books, t.temperature::double as temperature, t.num_questions from (select distinct case when doc_id % 2 = 0 then 'timeline' else 'type ' || doc_id % 5 end as wanted from documents) w
join ({TYPES_SQL}) t on t.type = case when w.wanted in (select type from ({TYPES_SQL})) then w.wanted else 'default' end""")
def type_config(spark, sf_dir):
    name = F.when(F.col("doc_id") % 2 == 0, "timeline").otherwise(F.concat(F.lit("type "), (F.col("doc_id") % 5).cast("string")))
    return S.type_config(spark, docs(spark, sf_dir).select(name.alias("type")).distinct())


@query(f"""select type, k, book from (select type, unnest(range(0, len(books))) as k, unnest(books) as book from ({TYPES_SQL}) where books is not null) where book in (select doc_id || '.cleaned.txt' from documents)""")
def type_books(spark, sf_dir):
    available = docs(spark, sf_dir).select(F.concat(F.col("doc_id").cast("string"), F.lit(".cleaned.txt")).alias("name"))
    return S.type_books(S.question_types(spark), available)


@query("""select doc_id, list_sort(list_distinct(list_filter(list_concat([doc_id % 9], range(doc_id % 5, doc_id % 7 + 1)), lambda i: i < 6)))::int[] as picked from documents""")
def index_selection(spark, sf_dir):
    d = F.col("doc_id")
    choice = F.concat((d % 9).cast("string"), F.lit("，"), (d % 5).cast("string"), F.lit(" - "), (d % 7).cast("string"), F.lit(", x"))
    return docs(spark, sf_dir).select("doc_id", R.index_range(choice, F.lit(6)).alias("picked"))


@query("select doc_id, (doc_id * 35 // 8) // 60 as main_min, ((doc_id * 2 + 33) // 2) * 15 // 60 as hier_min from documents")
def cost_estimate(spark, sf_dir):
    d = F.col("doc_id")
    return docs(spark, sf_dir).select("doc_id", S.estimate_main(d).alias("main_min"), S.estimate_hier(d).alias("hier_min"))


@query("select doc_id, 'Write ' || doc_id || ' questions, not 3-5.' as prompt from documents")
def num_questions(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", X.with_number(F.lit("Write 3-5 questions, not 3-5."), F.col("doc_id").cast("string")).alias("prompt"))


@query("select doc_id, case when n_chars = 0 then 0.0::double else (1 - (n_chars // 2)::double / n_chars) * 100 end as pct from documents")
def compression_ratio(spark, sf_dir):
    n = F.col("n_chars")
    return docs(spark, sf_dir).select("doc_id", S.reduction(n, F.floor(n / 2)).alias("pct"))


@query("select doc_id, case when doc_id % 3 = 0 then 'a' when doc_id % 3 = 1 then lang else '' end as answer from documents")
def answer_text(spark, sf_dir):
    d = F.col("doc_id") % 3
    return docs(spark, sf_dir).select("doc_id", X.answer_of(F.when(d == 0, "a").when(d == 1, ""), F.when(d < 2, F.col("lang"))).alias("answer"))


# --- runs with the offline model ---------------------------------------------------------------------------------


def _questions(number: int) -> str:
    """The offline model's items: so many a book, each citing the book's first section and quoting its first line."""
    return G1 + f""", s as (select cast(doc_id as varchar) as book, text, row_number() over (order by cast(doc_id as varchar), start) as global_idx from g1 where text <> ''),
b as (select book, arg_min(text, global_idx) as t from s group by book),
f as (select b.book, min(o.book) as title from b join b o on contains(o.book, b.book) group by b.book)
select row_number() over (order by book, k) - 1 as qa_idx, title as book, 'Q ' || k || '?' as question, 'A' as answer, cast(null as varchar) as response,
  [regexp_replace(left(split_part(t, chr(10), 1), 80), '^\\s+|\\s+$', '', 'g')] as evidence, [t] as context
from (select book, t, title, unnest(generate_series(1, {number})) as k from b join f using (book))"""


def _books(spark, sf_dir):
    return docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("book"), "text")


@query(_questions(3))
def adversarial_offline(spark, sf_dir):
    """Automatic questions over all documents; work files go to the session's own folder for intermediate results."""
    return runs.automatic(_books(spark, sf_dir), work_folder(spark), commit=OFFLINE)["items"]


@query(_questions(4))
def typed_offline(spark, sf_dir):
    """The same with the prompts and the number of questions of another type, without triples."""
    return runs.automatic(_books(spark, sf_dir), work_folder(spark), commit=OFFLINE, triples_on=False, question_type="relationship")["items"]


@query(G1 + """select count(*) as total, 0 as low, count(*) as good from (select doc_id from g1 where text <> '' group by doc_id) cross join range(3)""")
def soft_check_offline(spark, sf_dir):
    """The soft check of an automatic run: every quoted line is found in the section that it is from."""
    return runs.automatic(_books(spark, sf_dir), work_folder(spark), commit=OFFLINE, triples_on=False)["counts"]


@query()
def hierarchy_offline(spark, sf_dir):
    return runs.hierarchical(_books(spark, sf_dir), "Who?", work_folder(spark), commit=OFFLINE)["answer"]
