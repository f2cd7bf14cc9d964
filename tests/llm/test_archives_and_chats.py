"""WARC round trips, chat trees, components and the pipeline's stages."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textgraph.llm import chat, queries, warc
from textgraph.llm.common import components


@pytest.fixture(scope="module")
def pages(spark):
    r = random.Random(4)
    big = "".join(r.choice("abcdefé <>\n") for _ in range(3000))
    rows = [(k, f"http://h/{k} x\n", "".join(r.choice("abcdef <>") for _ in range(r.randint(0, 9000)))) for k in range(30)]
    rows += [(40, "u", big), (41, None, big), (42, "", big), (43, "u", None), (44, "u", ""), (45, "u", "tiny"), (46, "u", "tiny"), (None, "n", big), (42, "", big)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "salt": F.lit("s")}).repartition(3)


@pytest.mark.parametrize("split", [97, 1000, 1 << 22])
def test_warc(spark, pages, split):
    got = warc.read(warc.write(pages), split_bytes=split).collect()
    rows = pages.collect()
    assert len(got) == len(rows)
    last = {}
    for r in rows:
        b = (r.html or "").encode()
        if len(b) >= 1000 and r.page_id is not None:
            last[b] = max(r.page_id, last.get(b, r.page_id))

    def wanted(r):
        b = (r.html or "").encode()
        refers = last.get(b) if b in last and (r.page_id is None or r.page_id < last[b]) else None
        return (r.page_id is None, r.page_id or 0, len(b), hashlib.sha1(b).hexdigest(), "response" if refers is None else "revisit", refers or -1)

    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1) for r in got) == sorted(map(wanted, rows))
    assert all(r.digest_ok for r in got if r.record_type == "response")
    assert {r.url for r in got} >= {None, "u", "http://h/3%20x%0A"}


def test_warc_skips_false_magic_and_damage(spark, pages, tmp_path):
    manifest = warc.write(pages.where("page_id < 30").coalesce(1), folder=f"file://{tmp_path}/w").collect()
    path = manifest[0].path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    starts = [k for k in range(len(data)) if data[k : k + 3] == warc.MAGIC]
    data[starts[3] + 60] ^= 0xFF
    open(path, "wb").write(warc.MAGIC + b"junk" * 5 + bytes(data))
    df = spark.createDataFrame([(f"file://{path}", len(data) + 23, 30)], "path string, bytes long, records long")
    assert warc.read(df, 1000).count() in (28, 29)


def test_time_of_a_split_of_many_records(tmp_path):
    """A member is decoded from what it holds, not from a copy of all that follows it."""
    import time

    rows = [warc.record(k, "u", f"payload {k} ".encode() * 30, 330, hashlib.sha1(str(k).encode()).digest(), None) for k in range(6700)]
    path = tmp_path / "many.warc.gz"
    path.write_bytes(b"".join(rows))
    began = time.process_time()
    assert sum(1 for _ in warc.owned(f"file://{path}", 0, path.stat().st_size)) == 6700
    assert time.process_time() - began < 1


def test_warc_of_nothing(spark, pages):
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def vocabulary():
    import public_tokenizers as P

    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def test_chat_round_trip(spark):
    said = ["hello", "</s>[INST] ok [/INST]", "a\\b\\\\[INST]", None, "", "<s>\n\\", "é日本\n\n", "[/INST", "x" * 5000]
    rows = []
    for c in range(40):
        for t in range(c % 7 + 1):
            rows.append((c, t, "assistant" if t % 2 else "user", said[(t * 3 + (c if t > 2 else 0)) % len(said)]))
    rows += [(100, 0, None, "r"), (100, 1, "to\\ol\n", "[INST]"), (100, None, "system", "s"), (101, 5, "user", "b"), (101, 5, "user", "b"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"chain": F.lit(1), "tokens": F.lit(2)}).repartition(5)
    trees = chat.trees(df, *vocabulary(), tree_tokens=500)
    got = {r.conv_id: r for r in chat.read_back(trees, *vocabulary()).collect()}
    convs = {}
    for c, t, r, x in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(convs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    own = trees.collect()
    assert sum(len(t.tokens) for t in own) < sum(sum(i.end - i.start for i in t.nodes[x.node].attends) for t in own for x in t.leaves)
    for t in own:
        for n in t.nodes:
            seen = [p for i in n.attends for p in t.positions[i.start : i.end]]
            assert seen == list(range(len(seen)))
    assert chat.trees(df.limit(0), *vocabulary()).count() == 0


def test_escapes():
    for t in ("", "\\", "[INST]", "\\[INST]", "[[INST]]", "</s></s>", "\\\\<s>", "a\nb"):
        for role in (False, True):
            e = chat.escape(t, role)
            assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROL)


def test_components(spark):
    edges = [(k + 1, k) for k in range(60)] + [(200 + k, 200) for k in range(1, 50)] + [(-5, -9), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 200 for k in range(200, 250)} | {-5: -9, -9: -9}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents")
    columns, before = docs.columns, None
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf)
        if name != "pack":
            assert out.columns == columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
            out = out.persist()
            ids = {r.doc_id for r in out.select("doc_id").collect()}
            assert before is None or ids <= before
            before, docs = ids, out
            if name != "quality":
                assert out.where("n_chars <> length(text)").count() == 0
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == before


def test_pipeline_stages_of_odd_tables(spark, docs, no_docs):
    """Nulls, repeated rows, clashing columns and empty tables through every stage by itself, and through all of them."""
    import corpus_pipeline as P

    sf, count = "/root/testdata/sf0.001", docs.count()
    kept, chain = {}, docs
    for name, stage in P.STAGES:
        for df in (docs, chain):
            out = stage(spark, df, sf)
            if name != "pack":
                assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            rows = out.collect()
            if df is docs:
                kept[name] = rows
        chain = spark.createDataFrame(rows, out.schema) if name != "pack" else None
        empty = stage(spark, no_docs, sf)
        assert empty.count() == 0 and (name == "pack" or empty.columns == no_docs.columns)
    assert len(kept["line_dedup"]) == count and sum(r.text is None for r in kept["line_dedup"]) == docs.where("text is null").count()
    texts = [r.text for r in kept["near_dedup"] if r.text and len(r.text.split()) > 2]
    assert len(texts) == len(set(texts))
    assert len(kept["decontaminate"]) == count
    assert len({(r.doc_id, r.doc_tokens) for r in kept["pack"]}) > 10


def test_pipeline_against_brute_force(spark):
    """The stages that have one answer: near_dedup keeps the least id of each component of fingerprints, decontaminate what the
    rule leaves, and pack every token once."""
    import re

    import corpus_pipeline as P
    import xxhash
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents")
    rows = docs.collect()
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    def fingerprint(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    prints = {r.doc_id: fingerprint(r.text) for r in rows}
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and least[b] < least[a]:
                    least[a], changed = least[b], True
    stages = dict(P.STAGES)
    assert {r.doc_id for r in stages["near_dedup"](spark, docs, sf).collect()} == {i for i, c in least.items() if i == c}

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in queries.table(spark, sf, "benchmark").collect():
        w = word.findall(lower(r.text))
        windows |= {tuple(w[k : k + 13]) for k in range(max(len(w) - 13, 0) + 1 if w else 0)}
    sizes = {len(x) for x in windows}

    def clean(t):
        w = word.findall(lower(t))
        hit = {j for n in sizes for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for j in range(k, k + n)}
        return not hit or 20 * len(hit) < len(w)

    assert {r.doc_id for r in stages["decontaminate"](spark, docs, sf).collect()} == {r.doc_id for r in rows if clean(r.text)}

    tokens = Tokenizer.from_file(queries.word_tokenizer())
    packed = stages["pack"](spark, docs, sf).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {r.doc_id: len(tokens.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in rows}
