"""Relational operators on knowledge-graph triples.

A triple row has subject, predicate, object, and where it matters book, win (window) and ord, which stands for the order in
which triples were found.  The small sets that rows are tested against are joined as distinct keys with a flag; Spark
decides by their size whether to broadcast them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgraph.functions.text import low_value_alias, strip, tokens, whole_word
from textgraph.functions.vocabulary import CANONICAL_PREDICATES, EVENT_WORDS, FEELINGS, FILTER_WORDS, NO_GERUNDS, PREDICATE_MAP, PREPOSITIONS, VAGUE_OBJECTS

KEY = ["subject", "predicate", "object"]


def normalized_predicate(predicate: Column) -> Column:
    """The canonical predicate, or null where there is none."""
    p = strip(predicate)
    known = lambda x: x.isin(*CANONICAL_PREDICATES)
    table = F.create_map(*[F.lit(x) for k, v in PREDICATE_MAP.items() if v in CANONICAL_PREDICATES for x in (k, v)])
    dead = p.isin(*[k for k, v in PREDICATE_MAP.items() if v not in CANONICAL_PREDICATES])
    return F.when(known(p), predicate).when(dead, None).otherwise(F.coalesce(F.element_at(table, p), F.when(known(F.upper(p)), F.upper(p))))


def normalize_predicates(triples: DataFrame) -> DataFrame:
    return triples.withColumn("predicate", normalized_predicate(F.col("predicate"))).where("predicate is not null")


def entity_candidates(triples: DataFrame) -> DataFrame:
    """Distinct subjects and objects of two characters or more."""
    both = triples.select(F.col("subject").alias("entity")).union(triples.select("object")).distinct()
    return both.where(F.length("entity") >= 2)


def group_lines(replies: DataFrame, reply: str = "reply", order: str = "reply_id") -> DataFrame:
    """(r, g, k, variant, canonical): the lines of [GROUP] blocks, each with its group's first."""
    from textgraph.functions.replies import groups

    each = replies.select(F.col(order).alias("r"), F.posexplode(groups(F.col(reply))).alias("g", "lines")).where(F.size("lines") > 0)
    return each.select("r", "g", F.element_at("lines", 1).alias("canonical"), F.posexplode("lines").alias("k", "variant")).where("k = 0 or variant <> canonical")


def last_lines(lines: DataFrame) -> DataFrame:
    """(variant, canonical): the last line that names a variant wins."""
    return lines.groupBy("variant").agg(F.max_by("canonical", F.struct("r", "g", "k")).alias("canonical"))


def mapping_of(replies: DataFrame, reply: str = "reply", order: str = "reply_id") -> DataFrame:
    return last_lines(group_lines(replies, reply, order))


def canonicalize(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Subjects and objects replaced once by their canonical names, and an ALIAS row for each replaced name, the first of
    equal ones.  ord orders the rows: aliases come after all triples."""
    names = mapping.select("variant", "canonical")
    subjects, objects = names.toDF("subject", "new_subject"), names.toDF("object", "new_object")
    found = triples.join(subjects, "subject", "left").join(objects, "object", "left")
    found = found.withColumns({"new_subject": F.coalesce("new_subject", "subject"), "new_object": F.coalesce("new_object", "object")})
    own = found.select(F.lit(0).alias("part"), "ord", F.col("new_subject").alias("subject"), "predicate", F.col("new_object").alias("object"), "book", "win")
    return own.unionByName(aliases(found))


def aliases(found: DataFrame) -> DataFrame:
    """ALIAS rows of triples with new_subject and new_object."""
    pair = lambda side, new, old: F.struct(F.lit(side).alias("side"), F.col(new).alias("subject"), F.col(old).alias("object"))
    both = F.array(
        F.when(F.col("new_subject") != F.col("subject"), pair(0, "new_subject", "subject")),
        F.when((F.col("new_object") != F.col("object")) & (F.col("new_object") != F.col("new_subject")), pair(1, "new_object", "object")),
    )
    each = found.select("ord", "book", "win", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x")).select("ord", "book", "win", "x.*")
    first = each.groupBy("subject", "object").agg(F.min_by(F.struct("book", "win"), F.struct("ord", "side")).alias("w"), F.min(F.struct("ord", "side")).alias("o"))
    return first.select(F.lit(1).alias("part"), F.col("o.ord").alias("ord"), "subject", F.lit("ALIAS").alias("predicate"), "object", "w.book", "w.win")


def _gerund(object_: Column) -> Column:
    first = F.lower(F.get(tokens(object_), 0))
    return F.coalesce(F.endswith(first, F.lit("ing")) & ~first.isin(*NO_GERUNDS), F.lit(False))


def bad_alias(subject: Column, object_: Column, main: bool) -> Column:
    """A descriptive alias: main looks for any apostrophe and for prepositions, otherwise for 's and for words of events."""
    low = F.lower(object_)
    if main:
        own = F.contains(object_, F.lit("'")) | whole_word(low, PREPOSITIONS)
    else:
        own = F.contains(object_, F.lit("'s")) | low.rlike("|".join(EVENT_WORDS))
    return own | (F.size(tokens(object_)) > 5) | F.contains(low, F.concat(F.lit("of "), subject)) | _gerund(object_)


def ruled(triples: DataFrame, main: bool = True, scope: list[str] | None = None) -> DataFrame:
    """Each triple with the first rule that it breaks, or null.  The sets of subjects and of attributes and roles are those of
    all triples of a scope (of all, without scope columns)."""
    scope = scope or []
    flag = lambda rows, column, name: rows.select(*scope, F.col(column[0]).alias(column[1])).distinct().withColumn(name, F.lit(True))
    of = lambda p: triples.where(F.col("predicate") == p)
    df = triples.join(flag(triples, ("subject", "object"), "is_subject"), [*scope, "object"], "left")
    df = df.join(flag(of("HAS_ATTRIBUTE"), ("object", "subject"), "is_attribute"), [*scope, "subject"], "left")
    df = df.join(flag(of("HAS_ROLE"), ("object", "subject"), "is_role"), [*scope, "subject"], "left")
    p, s, o = F.col("predicate"), F.col("subject"), F.col("object")
    possessive = F.contains(o, F.lit("'s"))
    rules = [
        ("self_ref", s == o),
        ("alias_attr_subj", (p == "ALIAS") & F.col("is_attribute")),
        ("alias_role_subj", (p == "ALIAS") & F.col("is_role")),
        ("alias_event_desc", (p == "ALIAS") & bad_alias(s, o, main)),
        ("participates_entity", (p == "PARTICIPATES_IN") & F.col("is_subject")),
        ("participates_possessive", (p == "PARTICIPATES_IN") & possessive),
        ("attr_too_long", (p == "HAS_ATTRIBUTE") & (F.size(tokens(o)) > 5)),
        ("attr_is_entity", (p == "HAS_ATTRIBUTE") & F.col("is_subject")),
        ("attr_possessive", (p == "HAS_ATTRIBUTE") & possessive),
        ("role_is_entity", (p == "HAS_ROLE") & F.col("is_subject")),
        ("owns_person", (p == "OWNS") & F.col("is_subject")),
        ("relation_vague_obj", p.isin(*FEELINGS) & F.lower(o).isin(*VAGUE_OBJECTS)),
    ]
    broken = F.when(F.lit(False), "")
    for name, condition in rules:
        broken = broken.when(condition, name)
    return df.withColumn("rule", broken).select(*triples.columns, "rule")


def quality_filter(triples: DataFrame, main: bool = True, scope: list[str] | None = None) -> DataFrame:
    return ruled(triples, main, scope).where("rule is null").drop("rule")


def rule_counts(triples: DataFrame, main: bool = True) -> DataFrame:
    return ruled(triples, main).groupBy(F.coalesce("rule", F.lit("kept")).alias("rule")).agg(F.count("*").alias("n"))


def dedup_evidence(triples: DataFrame) -> DataFrame:
    """Equal triples merged, with their distinct book:window places sorted by book and number."""
    places = F.array_sort(F.collect_set(F.struct("book", "win")))
    out = triples.groupBy(*KEY).agg(places.alias("places"))
    text = F.array_join(F.transform("places", lambda x: F.concat(x["book"], F.lit(":"), x["win"].cast("string"))), "; ")
    return out.select(*KEY, text.alias("evidence"), F.size("places").alias("evidence_count"))


def dedup_plain(triples: DataFrame) -> DataFrame:
    return triples.groupBy(*KEY).agg(F.min("ord").alias("first_ord"))


def post_process_main(triples: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Canonical names, quality rules, merged evidence."""
    named = canonicalize(triples, mapping) if mapping is not None else triples
    return dedup_evidence(quality_filter(named, main=True))


def post_process_hier(triples: DataFrame) -> DataFrame:
    return dedup_plain(quality_filter(normalize_predicates(triples), main=False))


def word_reason(subject: Column, object_: Column) -> Column:
    """The first pronoun or article, in list order, that stands in either name; null if none does."""
    names = F.lower(F.concat_ws(" ", subject, object_))
    first = F.coalesce(*[F.when(whole_word(names, (w,)), w) for w in FILTER_WORDS])
    return F.when(whole_word(names, FILTER_WORDS), first)


def clean_reasons(triples: DataFrame) -> DataFrame:
    """Why a row is filtered: the word, or low_value_alias; null keeps it."""
    s, o = F.col("subject"), F.col("object")
    return triples.withColumn("reason", F.coalesce(word_reason(s, o), F.when(low_value_alias(s, o), "low_value_alias")))


def clean_filter(triples: DataFrame) -> DataFrame:
    return clean_reasons(triples).where("reason is null").drop("reason")


def clean_counts(triples: DataFrame) -> DataFrame:
    r = clean_reasons(triples)
    low = F.col("reason") == "low_value_alias"
    return r.agg(
        F.count("*").alias("total"), F.count_if(F.col("reason").isNotNull() & ~low).alias("phase1"), F.count_if(low).alias("phase2"), F.count_if(F.col("reason").isNull()).alias("kept")
    )


def latest(pairs: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    return pairs.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def first_occurrence(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
