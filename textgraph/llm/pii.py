"""Personal data by weak supervision (operator 9); DataFrame functions only.

Base spans follow fixed patterns.  Beyond them, a wide pattern proposes candidates, and labelers vote on each for, against
or not at all: regex shapes, gazetteers of cue words and titles, and the words around.  Expectation-maximisation over
the counts of vote patterns (at most 3 ** labelers rows) estimates the labelers' reliabilities and each pattern's
probability.  A naive Bayes classifier over the span's own features is trained on those probabilities, in one
aggregation over a bounded set of features, and decides which candidates become spans.  Base spans always stay.

Texts are read once; what follows works on a short table of spans.  Places come from the lengths of matches and of what
stands between them, in code points.  The patterns are written without backtracking over runs, so long texts cost linear time.

Defined cases: a null or empty text has no spans; where no candidate has a vote none is added; null and equal ids stay
separate rows; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import stored

_LOCAL = "[A-Za-z0-9._%+-]"
#: Leftmost matches, as the plain patterns give them: a run that fails from its first character fails from all others.
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "name", "secret")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Monsieur", "Madame", "Señor", "Señora")
CUES_FOR = ("phone", "tel", "telephone", "mobile", "fax", "call", "email", "mail", "contact", "card", "visa", "account", "iban", "ssn", "passport",
            "token", "password", "secret", "key", "name", "telefon", "konto", "nummer", "passwort", "courriel", "carte", "correo", "teléfono", "tarjeta", "numéro")
CUES_AGAINST = ("page", "pages", "vol", "volume", "chapter", "isbn", "issn", "year", "seite", "kapitel", "version", "figure", "table", "página", "part")
CANDIDATE = (
    r"(?<![0-9A-Za-z])[0-9a-f]{32,}+(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z+.])\(?[0-9](?:[\x20().-]{0,2}+[0-9]){7,}+(?![0-9A-Za-z])"
    rf"|(?<!{_LOCAL}){_LOCAL}++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"
    rf"|\b(?:{'|'.join(TITLES)})\.?\x20\p{{Lu}}\p{{Ll}}++(?:\x20\p{{Lu}}\p{{Ll}}++)?+"
)
#: Matches whose limits are added up at a time.
STEP = 512


def running(values: Column) -> Column:
    """Running sums of an array of numbers: blocks are summed first, so no fold builds more than a block or the list of blocks."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STEP).cast("int"))
    part = lambda k: F.slice(values, k * STEP + 1, F.lit(STEP))
    start = lambda first: F.struct(first.alias("now"), F.expr("cast(array() as array<int>)").alias("out"))
    after = lambda a, x: F.struct((a["now"] + x).alias("now"), F.concat(a["out"], F.array(a["now"] + x)).alias("out"))
    before = lambda a, x: F.struct((a["now"] + x).alias("now"), F.concat(a["out"], F.array(a["now"])).alias("out"))
    totals = F.transform(blocks, lambda k: F.aggregate(part(k), F.lit(0), lambda n, x: n + x))
    firsts = F.aggregate(totals, start(F.lit(0)), before, lambda a: a["out"])
    sums = F.transform(firsts, lambda first, k: F.aggregate(part(k), start(first), after, lambda a: a["out"]))
    return F.when(F.size(values) > 0, F.flatten(sums)).otherwise(F.array().cast("array<int>"))


def located(pieces: Column, found: Column) -> Column:
    """Matches with their limits, from the matches and the texts between them."""
    lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.length(p) + F.length(m))
    ends = F.get(F.transform(F.array(lengths), running), F.lit(0))
    return F.zip_with(found, ends, lambda m, e: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        x = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(x > 9, x - 9).otherwise(x)

    places = F.sequence(F.lit(0), F.length(number) - 1)
    return F.when(F.length(number) > 0, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(False)


def _small(part: Column) -> Column:
    rest = F.regexp_replace(part, "^0+", "")
    return (F.length(rest) <= 3) & (F.coalesce(rest.try_cast("int"), F.lit(0)) <= 255)


def _kept(kind: str, m: Column) -> Column:
    n = F.length(digits(m))
    if kind == "ip":
        return F.forall(F.split(m, r"\."), _small)
    if kind == "card":
        return n.between(13, 19) & luhn(digits(m))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _keeps(kind: str):
    return lambda x: _kept(kind, x["m"])


def _numbered(kind: int):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"))


def number_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def _word(text: Column, pattern: str) -> Column:
    return F.lower(F.regexp_extract(text, pattern, 1))


def votes(m: Column, before: Column, after: Column) -> Column:
    """One character for each labeler: 1 for, 0 against, - for no vote."""
    n, number = F.length(digits(m)), ~m.rlike(r"\p{L}")
    grouped = number & m.rlike(r"[0-9][\x20().-]+[0-9]")
    title, shaped = m.rlike(rf"^(?:{'|'.join(TITLES)})\b"), m.rlike(r"[0-9a-f]{32,}") & m.rlike("[0-9]") & m.rlike("[a-f]")
    vote = lambda yes, no: F.when(yes, "1").when(no, "0").otherwise("-")
    return F.concat(
        vote((grouped & n.between(9, 15)) | m.rlike(r"at[)\]]"), number & ((n < 9) | (n > 19))),  # regex: shape
        vote((n.between(13, 19) & number & luhn(digits(m))) | shaped, number & ~grouped & (n > 15) & ~luhn(digits(m))),  # regex: check digit, key
        vote(before.isin(*CUES_FOR), before.isin(*CUES_AGAINST)),  # gazetteer: cue word before
        vote(title, F.lit(False)),  # gazetteer: titles
        vote(after.isin(*CUES_FOR), after.isin(*CUES_AGAINST)),  # context: word after
        vote(F.lit(False), number & (before == "") & ~grouped),  # context: bare number without a word before it
    )


def features(m: Column, before: Column, after: Column) -> Column:
    """Names of a bounded set: shape, number of digits, and the words around in 64 buckets each."""
    shape = F.when(m.rlike("[0-9a-f]{32,}"), "hex").when(m.rlike(r"at[)\]]"), "mail").when(m.rlike(r"^\p{L}"), "name").when(m.rlike(r"[\x20().-]"), "grouped").otherwise("plain")
    bucket = lambda name, x: F.concat(F.lit(name), F.when(x == "", "").otherwise(F.pmod(F.xxhash64(x), F.lit(64)).cast("string")))
    return F.array(F.concat(F.lit("shape:"), shape), F.concat(F.lit("digits:"), F.least(F.length(digits(m)), F.lit(20)).cast("string")), bucket("before:", before), bucket("after:", after))


def kind_of(m: Column) -> Column:
    n = F.length(digits(m))
    return F.when(m.rlike("[0-9a-f]{32,}"), 6).when(m.rlike(r"at[)\]]"), 1).when(m.rlike(r"^\p{L}"), 5).when(n.between(13, 19) & luhn(digits(m)), 3).otherwise(4)


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (kind, s, e) and candidates (kind, s, e, votes, features), from one reading of the texts."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("t"))
    guards = {"email": F.contains("t", F.lit("@")), "ip": F.col("t").rlike(r"[0-9]\.[0-9]"), "card": F.col("t").rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), "phone": F.contains("t", F.lit("+"))}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "more": CANDIDATE}
    none = F.array().cast("array<string>")
    for kind, pattern in patterns.items():
        guard = guards.get(kind, F.lit(True))
        df = df.withColumn(f"f_{kind}", F.when(guard, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none))
    for kind, pattern in patterns.items():
        df = df.withColumn(f"p_{kind}", F.when(F.size(f"f_{kind}") > 0, F.split("t", pattern, -1)).otherwise(none))
    df = df.drop("t")
    base = []
    for k, kind in enumerate(KINDS[:4]):
        df = df.withColumn(f"s_{kind}", F.filter(located(F.col(f"p_{kind}"), F.col(f"f_{kind}")), _keeps(kind)))
        base.append(F.transform(f"s_{kind}", _numbered(k + 1)))
    df = df.withColumn("base", F.concat(*base)).withColumn("s_more", located(F.col("p_more"), F.col("f_more")))
    before = lambda i: _word(F.right(F.get("p_more", i), F.lit(40)), r"(\p{L}+)[^\p{L}]{0,8}$")
    after = lambda i: _word(F.left(F.get("p_more", i + 1), F.lit(40)), r"^[^\p{L}]{0,8}(\p{L}+)")
    around = F.transform("s_more", lambda x, i: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), before(i).alias("b"), after(i).alias("a")))
    return df.select("doc_id", "base", around.alias("around")).select(
        "doc_id",
        "base",
        F.transform("around", lambda x: F.struct(kind_of(x["m"]).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), votes(x["m"], x["b"], x["a"]).alias("votes"), features(x["m"], x["b"], x["a"]).alias("features"))).alias("more"),
    )


def reliabilities(counts: dict[str, int], rounds: int = 50) -> tuple[dict[str, float], list[tuple[float, float]]]:
    """Expectation-maximisation over vote patterns: each pattern's probability, and each labeler's chances of a vote for."""
    labelers = len(next(iter(counts), ""))
    p = {v: (v.count("1") + 0.5) / (v.count("1") + v.count("0") + 1) for v in counts}
    chances = [(0.8, 0.2)] * labelers
    for _ in range(rounds):
        total = sum(counts.values())
        prior = min(0.95, max(0.05, sum(n * p[v] for v, n in counts.items()) / total)) if total else 0.5
        chances = []
        for j in range(labelers):
            voted = [(v, n) for v, n in counts.items() if v[j] != "-"]
            rate = lambda y: (0.8 if y else 0.2) if not voted else (sum(n * (p[v] if y else 1 - p[v]) * (v[j] == "1") for v, n in voted) + (1.6 if y else 0.4)) / (sum(n * (p[v] if y else 1 - p[v]) for v, n in voted) + 2)
            chances.append((min(0.98, max(0.02, rate(True))), min(0.98, max(0.02, rate(False)))))
        for v in counts:
            odds = math.log(prior / (1 - prior))
            for (a, b), x in zip(chances, v):
                odds += {"1": math.log(a / b), "0": math.log((1 - a) / (1 - b)), "-": 0.0}[x]
            p[v] = 1 / (1 + math.exp(-odds))
    return p, chances


def classified(rows: DataFrame) -> DataFrame:
    """Train the span classifier on the voted candidates and add the spans that it finds and that touch no base span."""
    spans = rows.select(F.explode("more").alias("x")).select("x.votes", "x.features")
    counts = {r.votes: r.n for r in spans.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    voted = {v: n for v, n in counts.items() if v.strip("-")}
    if not voted:
        return rows.withColumn("spans", F.col("base"))
    p, _ = reliabilities(voted)
    soft = F.create_map(*[F.lit(x) for v in voted for x in (v, float(p[v]))])
    soft = spans.where(F.col("votes").rlike("[01]")).withColumn("p", F.element_at(soft, F.col("votes")))
    trained = soft.select("p", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    yes, no = (sum(n * (p[v] if y else 1 - p[v]) for v, n in voted.items()) + 1 for y in (True, False))
    weights = {r.feature: math.log((r.yes + 1) / (yes + 2)) - math.log((r.no + 1) / (no + 2)) for r in trained}
    table = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, float(w))])
    score = lambda x: F.aggregate(x["features"], F.lit(math.log(yes / no)), lambda total, f: total + F.coalesce(F.try_element_at(table, f), F.lit(0.0)))
    free = lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    added = F.transform(F.filter("more", lambda x: free(x) & (score(x) > 0)), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return rows.withColumn("spans", F.concat("base", added))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans: arrays of (kind, s, e), kinds numbered as in KINDS from 1, limits in code points."""
    return classified(stored(spans_of(docs, id_col, text_col), "spans")).select("doc_id", "base", "spans")


def joined(spans: str) -> Column:
    """kind:start:end by kind and start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"] - 1), x["s"], x["e"])), ",")
