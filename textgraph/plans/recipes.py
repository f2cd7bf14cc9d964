"""Deterministic inputs for the operators' queries, made from the driver's tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRIPLES = """
with subj(i,s) as (values (0,'Jabez Wilson'),(1,'Mr. Jabez Wilson'),(2,'Irene Adler'),(3,'Neville St. Clair'),(4,'William Boldwood'),(5,'Gabriel Oak'),(6,'Bathsheba Everdene'),(7,'James Ryder'),(8,'John Clay'),(9,'the banker'),(10,'Weatherbury'),(11,'brave'),(12,'Farmer')),
     pred(i,p) as (values (0,'ALIAS'),(1,'ALIAS'),(2,'HAS_ROLE'),(3,'HAS_ATTRIBUTE'),(4,'LOVES'),(5,'MARRIES'),(6,'PARTICIPATES_IN'),(7,'OWNS'),(8,'KNOWS'),(9,'RIVALS'),(10,'alias'),(11,'外号'),(12,'杀死'),(13,'LIKES'),(14,'HAS_ROLE'),(15,'HAS_ATTRIBUTE'),(16,'REJECTS')),
     obj(i,o) as (values (0,'Wilson'),(1,'Mr. Wilson'),(2,'Jabez Wilson'),(3,'Irene'),(4,'St. Clair'),(5,'Farmer'),(6,'brave'),(7,'nobody'),(8,'Gabriel Oak'),(9,'Jem'),(10,'Vincent Spaulding'),(11,'the old man'),(12,'Oak''s farm'),(13,'shooting of Francis Troy'),(14,'King Arthur'),(15,'Edward'),(16,'Colonel'),(17,'very tall and brave and rich man'),(18,'Weatherbury'),(19,'Little Weatherbury'),(20,'Boldwood'),(21,'her stepfather'),(22,'Someone'),(23,'Mr. Boldwood'),(24,'Harvest Feast'))
select e.event_id as ord, s as subject, p as predicate, o as object,
       concat('src', cast(e.user_id % 5 as varchar(9))) as book, cast(e.event_id % 12 + 1 as int) as win
from events e join subj on e.event_id % 13 = subj.i
  join pred on e.event_id % 17 = pred.i
  join obj on e.event_id % 25 = obj.i
where not (p='HAS_ATTRIBUTE' and o in ('Weatherbury','Farmer'))
"""

MAPPING = """
select * from (values ('Wilson','Jabez Wilson'),('Mr. Wilson','Jabez Wilson'),('Mr. Jabez Wilson','Jabez Wilson'),('Boldwood','William Boldwood'),
('Mr. Boldwood','William Boldwood'),('Jem','James Ryder'),('Little Weatherbury','Weatherbury'),('Jabez Wilson','Jabez Wilson'),
('William Boldwood','William Boldwood'),('James Ryder','James Ryder'),('Weatherbury','Weatherbury')) as t(variant, canonical)
"""

BLOCK_REPLIES = f"select ord as reply_id, 'noise [triples]' || chr(10) || '- ' || subject || '||' || predicate || '||' || object || chr(10) || 'bad||line' || chr(10) || '[/TRIPLES]' as reply from ({TRIPLES}) t"
LINE_REPLIES = f"select ord as reply_id, case when ord % 3 = 0 then 'x' || chr(10) || subject || '||' || predicate || '||' || object when ord % 3 = 1 then subject || '||||' || object else subject end as reply from ({TRIPLES}) t"
VERDICTS = f"select ord as reply_id, case ord % 4 when 0 then '[VERDICT] pass [/VERDICT]' when 1 then '[VERDICT]FAIL[/VERDICT] [FEEDBACK] drop ' || subject || ' [/FEEDBACK]' when 2 then '[verdict]NOT PASS[/verdict]' else 'nothing' end as reply from ({TRIPLES}) t"
GROUPS = f"select ord as reply_id, '[GROUP]' || chr(10) || object || chr(10) || subject || chr(10) || '[/GROUP] [GROUP]' || chr(10) || subject || chr(10) || predicate || chr(10) || '[/GROUP]' as reply from ({TRIPLES}) t"
ANSWERS = "select doc_id as qa_idx, 'Claim A [' || (doc_id % 20 + 1) || ']. Claim B [' || (doc_id % 20 + 1) || ', ' || (doc_id % 20 + 2) || '] end [9999]' as answer from documents"
ITEMS = """select doc_id as reply_id, case when doc_id % 3 = 0 then '{"book":"b","question":"q' || doc_id || '","answer":"a [1]"}'
  when doc_id % 3 = 1 then '```json' || chr(10) || '[{"book":"b","question":"q' || doc_id || '","answer":"a"} {"question":"r","response":"s' || doc_id || '"},]' || chr(10) || '```'
  else 'no json' end as reply from documents"""
EVIDENCE = """select doc_id as qa_idx, cast(k as int) as ev_idx, case k when 0 then substring(text, place, 40) when 1 then substring(text, place, 30) || 'zzzzzzzzzz' else 'qqqq' end as evidence
from (select doc_id, text, cast((doc_id * 7919) % greatest(length(text) - 40, 1) + 1 as int) as place from documents) d cross join (select 0 as k union all select 1 union all select 2) v"""
#: Up to 500 characters of each text, by themselves and before a hundred characters that no text has.
LONG_EVIDENCE = """select doc_id as qa_idx, cast(k as int) as ev_idx, substring(text, place, 500) || case k when 0 then '' else repeat('\u2603', 100) end as evidence
from (select doc_id, text, cast((doc_id * 7919) % greatest(length(text) - 500, 1) + 1 as int) as place from documents) d cross join (select 0 as k union all select 1) v"""
NAMES = f"select distinct prefix || name || suffix as name from (select subject as name from ({TRIPLES}) t union select object from ({TRIPLES}) u) n cross join (select '' as prefix union all select 'Mr. ' union all select 'Lady Old ') p cross join (select '' as suffix union all select ', Jr.' union all select ' the elder') s"

TABLES = ("documents", "events", "labels")


def recipe(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a recipe over the driver's tables."""
    for name in TABLES:
        if f" {name}" in sql:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(sql)
