"""Golden rows of the text functions, one for each quirk."""

import pytest
from pyspark.sql import functions as F

from textgraph.functions import replies as R
from textgraph.functions import text as X
from textgraph.functions.chunking import aligned_windows, fixed_windows
from textgraph.functions.sentences import group_sentences, split_sentences
from textgraph.operators import sections as S
from textgraph.operators import triples as T


@pytest.fixture(scope="module")
def one(spark):
    def evaluate(column):
        return spark.range(1).select(column.alias("x")).first().x

    return evaluate


def columns(spark, f, *values):
    return spark.createDataFrame([values], ", ".join(f"c{k} string" for k in range(len(values)))).select(f(*[F.col(f"c{k}") for k in range(len(values))]).alias("x")).first().x


def test_windows(spark):
    text = "Ab cd. " * 500
    spans = lambda f, t: [(c.start, c.end) for c in columns(spark, f, t)]
    assert spans(lambda c: aligned_windows(c), text) == [(0, 3500), (3003, 3500)]
    assert spans(lambda c: fixed_windows(c), text) == [(0, 3500), (3000, 3500)]
    assert spans(lambda c: aligned_windows(c), "") == spans(lambda c: fixed_windows(c), "") == []
    words = "word " * 3000
    got = columns(spark, lambda c: aligned_windows(c), words)
    for a, b in zip(got, got[1:]):
        assert a.start < b.start < a.end
    assert all(c.text == words[c.start : c.end].strip() for c in got)
    wide = "字。 " * 2500
    assert all(c.text == wide[c.start : c.end].strip() for c in columns(spark, lambda c: aligned_windows(c), wide))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Mr. Smith ran. He fell.", ["Mr.", "Smith ran.", "He fell."]),
        ("Go! now. Yes", ["Go! now.", "Yes"]),
        ("end.\nNext", ["end.\nNext"]),
        ("J.R Smith left.", ["J.", "R Smith left."]),
        ("See Mr.. Smith now. ", ["See Mr.. Smith now."]),
        ("", []),
        ("a" * 1700 + "\n\n" + "b.", ["a" * 1700, "b."]),
    ],
)
def test_sentences(spark, text, want):
    assert columns(spark, lambda c: split_sentences(c), text) == want


def test_groups_of_sentences(spark):
    got = spark.createDataFrame([(["aaaa", "bbbb", "cc"],), ([],), (["x" * 20, "y"],)], "s array<string>").select(group_sentences(F.col("s"), 8).alias("x")).collect()
    assert [r.x for r in got] == [["aaaa bbbb", "cc"], [], ["x" * 20, "y"]]


def test_triples_of_replies(spark):
    block = "[TRIPLES]\n||a||b||c\n- x||y||z||w\na||||b\n[/TRIPLES] [TRIPLES]n||n||n[/TRIPLES]"
    assert [tuple(t) for t in columns(spark, lambda c: R.triples_of_block(c), block)] == [("a", "b", "c"), ("x", "y", "z")]
    assert columns(spark, lambda c: R.triples_of_block(c), "none") == []
    assert [tuple(t) for t in columns(spark, lambda c: R.triples_of_lines(c), "x\n a||||b \nc||d")] == [("a", "", "b")]


def test_verdicts(spark):
    said = lambda t: tuple(columns(spark, lambda c: R.verdict(c), t))
    assert said("[VERDICT] NOT PASS [/VERDICT]") == (True, "")
    assert said("nothing") == (False, "")
    assert said("[verdict]PASS or FAIL[/verdict][FEEDBACK] a\nb [/FEEDBACK]") == (False, "a\nb")


def test_choices(spark):
    picked = lambda t, n=6: columns(spark, lambda c: R.index_range(c, F.lit(n)), t)
    assert picked("0,2-4，9") == [0, 2, 3, 4]
    assert picked("5-3, x") == [] and picked("1-2z") == [1, 2]
    assert picked("ALL", 3) == [0, 1, 2] and picked("all", 0) == []


@pytest.mark.parametrize(
    ("evidence", "source", "want"),
    [("b" * 30 + "z" * 10, "a" + "b" * 30 + "c", 0.75), ("short and absent", "nothing here", 0.0), ("", "x", 1.0), ("Quote “x”", "a quote “X” b", 1.0), ("ﬁne", "FINE", 1.0)],
)
def test_confidence(spark, evidence, source, want):
    assert columns(spark, lambda e, s: X.confidence(X.normalize_text(e), X.normalize_text(s)), evidence, source) == pytest.approx(want)


def test_longest_common_by_brute_force():
    import random

    r = random.Random(2)
    for _ in range(200):
        a, b = ("".join(r.choice("ab") for _ in range(r.randint(0, 14))) for _ in range(2))
        best = max((j - i for i in range(len(a)) for j in range(i + 1, len(a) + 1) if a[i:j] in b), default=0)
        assert X.longest_common(a, b, 3) == (best if best >= 3 else 0)


def test_confidences_of_many_lines(spark):
    """All lines of a source, short and long ones, against all pairs of places."""
    import random

    from textgraph.operators import evidence as E

    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 6)))
    sources = [" ".join(word() for _ in range(300)) for _ in range(3)] + ["ab " * 400, "", "x"]
    rows = []
    for q, t in enumerate(sources):
        for k in range(8):
            at = r.randrange(max(1, len(t) - 200))
            rows.append((q, k, t[at : at + r.choice([5, 30, 150, 700])] + r.choice(["", "q" * 30, " Zz"]) + t[:k]))
    rows += [(0, 9, ""), (0, 10, None), (0, 2500, sources[0][:50] + "q"), (7, 0, "no source")]

    def best(e, t):
        if e in t:
            return 1.0
        n = max((j - i for i in range(len(e)) for j in range(i + 20, len(e) + 1) if e[i:j] in t), default=0)
        return n / len(e)

    norm = lambda x: " ".join(x.split()).lower()
    got = E.scored(spark.createDataFrame(rows, "qa_idx int, ev_idx int, evidence string"), spark.createDataFrame(list(enumerate(sources)), "qa_idx int, text string")).collect()
    want = {(q, k, e): 0.0 if e is None else best(norm(e), norm(sources[q])) for q, k, e in rows if q < 7}
    assert {(x.qa_idx, x.ev_idx, x.evidence): x.conf for x in got} == pytest.approx(want) and len(got) == len(want)


def test_citations(spark):
    assert columns(spark, lambda c: X.normalize_citations(c), "x [46, 47] y [1,2 , 3] z [5]") == "x [46][47] y [1][2][3] z [5]"
    assert columns(spark, lambda c: X.strip_citations(c), "Fact [3][4]. More [5, 6]") == "Fact. More [5, 6]"
    assert columns(spark, lambda c: X.citations(c), "[3][1] [3] [x]") == [1, 3]


def test_json(spark):
    fixed = lambda t: columns(spark, lambda c: X.repair_json(c), t)
    assert fixed('[{"a":1} {"b":2},]') == '[{"a":1},{"b":2}]'
    assert fixed(' {"a":1} ') == '{"a":1}' and fixed("so [1] ok") == "[1]"
    assert columns(spark, lambda c: X.strip_code_fence(c), "```JSON\n[1]\n```  ") == "[1]"


@pytest.mark.parametrize(("name", "want"), [("Mr. Mr. Sr", ""), ("Mr. Jabez Wilson, Jr.", "Jabez Wilson"), ("old Tom the elder", "Tom"), ("", ""), ("Colonel", ""), (" Mr. A", "Mr. A")])
def test_titles(spark, name, want):
    assert columns(spark, lambda c: X.strip_titles(c), name) == want


@pytest.mark.parametrize(
    ("subject", "object_", "low"),
    [
        ("Jabez Wilson", "Wilson", True), ("Jabez Wilson", "Mr. Wilson", True), ("Mary Holder", "Miss Holder", True), ("Irene Adler", "Irene", True),
        ("Neville St. Clair", "St. Clair", True), ("Gabriel Oak", "Colonel", True), ("James Ryder", "Jem", False), ("John Clay", "Vincent Spaulding", False),
        ("Francis Hay Moulton", "Francis H. Moulton", False), ("Mr.", "Oak", False),
    ],
)
def test_low_value_aliases(spark, subject, object_, low):
    assert columns(spark, lambda s, o: X.low_value_alias(s, o), subject, object_) is low


def test_reasons(spark):
    reason = lambda s, o: columns(spark, lambda a, b: T.word_reason(a, b), s, o)
    assert reason("x", "her stepfather and me") == "me"
    assert reason("A. Smith", "x") == "a" and reason("Théa", "éa") is None


def test_bad_aliases(spark):
    bad = lambda o, main: columns(spark, lambda s, x: T.bad_alias(s, x, main), "S", o)
    assert bad("King Arthur", True) and bad("King Arthur", False)
    assert not bad("Edward", True) and bad("Edward", False)
    assert bad("O'Brien", True) and not bad("O'Brien", False)
    assert not bad("nothing", True) and not bad("", True)


def test_predicates(spark):
    to = lambda p: columns(spark, lambda c: T.normalized_predicate(c), p)
    assert (to("杀死"), to("alias"), to("外号"), to("LIKES"), to("KNOWS")) == (None, "ALIAS", "ALIAS", None, "KNOWS")


def test_estimates(one):
    assert one(S.estimate_main(F.lit(100))) == 7 and one(S.estimate_hier(F.lit(100))) == 29
    assert one(S.reduction(F.lit(0), F.lit(0))) == 0
    assert one(X.with_number(F.lit("a 3-5 b 3-5"), F.lit("4"))) == "a 4 b 3-5"
    assert one(X.answer_of(F.lit(""), F.lit("r"))) == "r"
    assert one(X.snippet(F.lit("a\nb" * 50))) == ("a\nb" * 50)[:80].replace("\n", " ")


def test_groups_of_very_many_sentences(spark):
    """Beyond a block of the fold, against the plain greedy rule; and in linear time."""
    import random
    import time

    r = random.Random(5)
    texts = [["w" * r.randint(0, 30) for _ in range(n)] for n in (0, 1, 255, 256, 257, 2000)]
    want = []
    for sentences in texts:
        groups, size = [], 0
        for s in sentences:
            if size == 0 or size + len(s) > 40:
                groups.append([s])
                size = len(s)
            else:
                groups[-1].append(s)
                size += 1 + len(s)
        want.append([x for x in (" ".join(g).strip() for g in groups) if x])
    got = spark.createDataFrame([(x,) for x in texts], "s array<string>").select(group_sentences(F.col("s"), 40).alias("x"))
    assert [r.x for r in got.collect()] == want
    seconds = []
    for n in (416_000, 416_000, 832_000):
        df = spark.createDataFrame([(("Anna met Ben in the old town by the river. " * (n // 43)),)], "t string")
        began = time.time()
        assert df.select(F.size(group_sentences(split_sentences(F.col("t")))).alias("n")).first().n > n // 900
        seconds.append(time.time() - began)
    assert seconds[2] < 2.2 * max(seconds[1], 1)


def test_both_parsers_of_replies_agree(spark):
    """The row functions of the model stages and the column functions, on random replies."""
    import random

    from textgraph.operators import models as M

    r = random.Random(9)
    parts = ["[TRIPLES]", "[/TRIPLES]", "[triples]", "\n", "- ", "-- ", "||", "|", "a", "B c", " ", "[VERDICT]", "[/VERDICT]", "PASS", "pass", "FAIL", "[FEEDBACK]", "[/FEEDBACK]", "x\ny", "[/triples]"]
    replies = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(1500)]
    replies += ["[TRIPLES]\n" + "\n".join("||".join(r.choice(["a", " b ", "", "- c"]) for _ in range(r.randint(1, 5))) for _ in range(6)) + "\n[/TRIPLES]" for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(replies)), "k int, t string").select("k", R.triples_of_block(F.col("t")).alias("block"), R.verdict(F.col("t")).alias("verdict"))
    for x in df.collect():
        assert [tuple(t) for t in x.block] == M.parse_block(replies[x.k]), replies[x.k]
        assert tuple(x.verdict) == M.passed(replies[x.k]), replies[x.k]


def test_longest_parts_take_few_searches():
    """Long parts are found by few searches, and right with plain text, index and what begins plainly and gets an index."""
    import random

    r = random.Random(3)

    class Counted:
        def __init__(self, text):
            self.text, self.n = text, 0

        def __contains__(self, part):
            self.n += 1
            return part in self.text

    source = "".join(r.choice("abcdefgh ") for _ in range(20000))
    counted = Counted(source)
    assert X.longest_part(source[5000:5500] + "#" * 100, counted, 20) == 500 and counted.n < 50
    for _ in range(200):
        a, b = ("".join(r.choice("ab") for _ in range(r.randint(0, 60))) for _ in range(2))
        best = max((j - i for i in range(len(a)) for j in range(i + 1, len(a) + 1) if a[i:j] in b), default=0)
        late = X.Searched(b)
        late.left = 5
        assert {X.longest_part(a, own, 3) for own in (b, X.Suffixes(b), X.Searched(b), late)} == {best if best >= 3 else 0}
