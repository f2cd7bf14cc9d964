"""Operators on documents against brute force."""

import json
import os
import random
import re
import subprocess
import sys
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textgraph.llm import decontaminate, lines, packing, pii, quality_cnn, quality_rules, queries, repeats, simhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_passages(spark, docs, texts, monkeypatch):
    items = [(1, " ".join(WORD.findall(lower(texts[0]))[5:30])), (2, " ".join(WORD.findall(lower(texts[3]))[:4])), (2, "never seen here"), (None, texts[4].upper()[:200]), (7, ""), (8, None), ("null", " ".join(WORD.findall(lower(texts[1]))[3:18]))]
    items = [(None if i is None else str(i), t) for i, t in items]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        for k in range(max(len(w) - 13, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(i)
    for block, piece in ((1 << 20, 1 << 16), (100, 1 << 16), (1000, 3)):
        monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece)
        got = decontaminate.find_passages(docs, bench, carry=docs.columns, block_bytes=block).select("row.*", "n_words", "hits", "items", "spans").collect()
        assert len(got) == docs.count()
        for r in got:
            w = WORD.findall(lower(r.text))
            hit, found = set(), set()
            for n in {len(x) for x in windows}:
                for k in range(len(w) - n + 1):
                    if (x := tuple(w[k : k + n])) in windows:
                        hit |= set(range(k, k + n))
                        found |= windows[x]
            assert r.n_words == len(w) and r["items"] == sorted(found, key=lambda x: (x is None, x or ""))
            assert {k for h in r.hits for k in range(h.start, h.end)} == hit
            for h, s in zip(r.hits, r.spans):
                assert WORD.findall(lower(r.text[s.start : s.end])) == w[h.start : h.end]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_passages(docs, empty).where("n_hit > 0").count() == 0
    assert decontaminate.find_passages(docs.limit(0), bench).count() == 0


def test_windows_of_a_large_benchmark_stay_small():
    """A block holds its words once, however many windows there are, and takes no more than some bytes a word."""
    import tracemalloc

    r = random.Random(5)
    words = ["w%d" % k for k in range(20_000)]
    items = [(str(k), " ".join(r.choices(words, k=2000)).encode()) for k in range(300)]
    tracemalloc.start()
    windows = decontaminate.Windows(items, 13)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(windows.starts[13]) == 300 * 1988 and windows.items[windows.of(windows.starts[13][-1:])[0]] == "299"
    assert held < 30 * 600_000


def test_a_preamble_that_all_items_share(spark):
    """14,000 items and 1,000 documents with one common window, which is sought and located once."""
    import hashlib

    preamble = "answer the question below with the letter of the right choice and nothing else"
    items = [(f"i{k}", f"{preamble} own words {k}") for k in range(14_000)]
    rows = [(k, f"before {k} it all {preamble.upper()} then more words {k}") for k in range(1000)] + [(1000, "none of it")]
    found = decontaminate.find_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id string, text string"))
    got = found.select("row.doc_id", "n_hit", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("h")).collect()
    every = hashlib.sha256(",".join(sorted(i for i, _ in items)).encode()).hexdigest()
    assert {(r.n_hit, r.n, r.h) for r in got if r.doc_id < 1000} == {(14, 14_000, every)}
    assert [(r.n_hit, r.n) for r in got if r.doc_id == 1000] == [(0, 0)]


def test_equal_hashes_of_windows_are_told_apart(monkeypatch):
    items = [("a", b"x y z"), ("b", b"x y q"), ("c", b"x y z"), ("d", b"u v w"), (None, b"x y z")]
    monkeypatch.setattr(decontaminate, "mixed", lambda x: x * np.uint64(0))
    windows = decontaminate.Windows(items, 3)
    starts, limits, places = windows.distinct[3]
    named = sorted(sorted((windows.ids[int(p)].as_py() or "null") for p in places[a:z]) for a, z in zip(limits, limits[1:]))
    assert len(starts) == 3 and named == [["a", "c", "null"], ["b"], ["d"]]


def test_fm_index_finds_all_occurrences():
    r = np.random.default_rng(3)
    text = r.integers(1, 5, 600)
    text[::37] = 0
    text[-1] = 0
    index = decontaminate.FMIndex(text.astype(np.int64), 5)
    windows = np.array([text[k : k + 3] for k in range(1, 500) if text[k : k + 3].all()])
    rows, low, high = index.search(windows)
    assert len(rows) == len(windows)
    for w, a, b in zip(windows[rows], low, high):
        assert sorted(index.locate(np.arange(a, b))) == [k for k in range(598) if (text[k : k + 3] == w).all()]


def test_repeats(docs, no_docs):
    for df in (docs.where("doc_id is not null").dropDuplicates(["doc_id"]), docs):
        rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect()))
        seen, want = set(), []
        for _, i, t in rows:
            b = t.encode()
            gone = np.zeros(len(b), bool)
            for k in range(len(b) - 99):
                x = b[k : k + 100]
                gone[k : k + 100] |= x in seen
                seen.add(x)
            want.append((len(b), int(gone.sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
        got = [(r.n_bytes, r.n_removed, bytes(r.kept)) for r in repeats.remove_repeats(df).collect()]
        assert sorted(got) == sorted(want)
    assert repeats.remove_repeats(no_docs).count() == 0


def test_repeats_crowded_and_split(spark, monkeypatch):
    """Very common passages, and texts beyond a block."""
    from tests.llm.conftest import prose

    common = prose(99, 40)[:150]
    rows = [(k, prose(200 + k, 20) + common + prose(300 + k, 20)) for k in range(40)] + [(100, prose(400, 3000) + common + prose(1, 100) + prose(400, 3000))]
    monkeypatch.setattr(repeats, "CROWD_MET", 3)
    monkeypatch.setattr(repeats, "MERGED_ROWS", 50)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen, want = set(), {}
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            x = b[k : k + 100]
            gone[k : k + 100] |= x in seen
            seen.add(x)
        want[i] = int(gone.sum())
    assert {r.doc_id: r.n_removed for r in repeats.remove_repeats(df).collect()} == want


def test_equal_hashes_of_different_phrases(monkeypatch):
    """Where the first hash tells nothing apart, the second one does, and a block's phrases stay as they are."""
    from tests.llm.conftest import prose

    raw = np.frombuffer((prose(1, 400) + prose(2, 400) + prose(1, 400)).encode(), np.uint8)
    limits = np.array([0, len(raw)])

    def distinct():
        start, n, k1, k2, k3 = repeats.Block(raw).phrases(limits, 100)
        _, new = repeats._first_of(k1, k2, k3, np.zeros(len(start), np.int64), start)
        return len({raw[a : a + m + 99].tobytes() for a, m in zip(start, n)}), int(new.sum()), len(start)

    want = distinct()
    assert want[0] == want[1] < want[2]
    of = repeats.Block.hashes
    monkeypatch.setattr(repeats.Block, "hashes", lambda self, a, b, k=0: of(self, a, b, k) if k else np.zeros(len(a), np.uint64))
    assert distinct() == want


def test_simhash(docs, no_docs):
    def fingerprint(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        if not w:
            return 0
        s = [" ".join(w)] if len(w) < 3 else [" ".join(w[k : k + 3]) for k in range(len(w) - 2)]
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    got = simhash.near_duplicates(docs).collect()
    prints = sorted((r.id is not None, r.id or 0, r.fp % 2**64) for r in got)
    want = sorted((r.doc_id is not None, r.doc_id or 0, fingerprint(r.text)) for r in docs.collect())
    assert prints == want
    nodes = list({p for *_, p in want})
    root = {p: p for p in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for known, i, p in want:
        if known:
            least[find(p)] = min(i, least.get(find(p), i))
    assert all(r.component == least.get(find(r.fp % 2**64)) for r in got)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_tiles_lose_no_link():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << r.integers(0, 64, 40, dtype=np.uint64)) for _ in range(60)]))
    a, b = simhash.tile_links(fps, 3)
    assert (np.bitwise_count(a ^ b) >= 0).all()
    want = {frozenset((int(x), int(y))) for x in fps for y in fps if x < y and int(x ^ y).bit_count() <= 3}
    root = {int(x): int(x) for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        root[find(x)] = find(y)
    assert all(len({find(x) for x in pair}) == 1 for pair in want)
    assert len({find(x) for x in root}) == len(root) - len({(int(x), int(y)) for x, y in zip(a, b)})


def test_crowded_block_values(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 8)
    values = [(k << 40) | 5 for k in range(60)]
    prints = spark.createDataFrame([(v, 1) for v in values], "fp long, least long")
    found = {frozenset((r.a, r.b)) for r in simhash.links(prints, 3).collect()}
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for pair in found:
        a, b = pair
        assert (a ^ b).bit_count() <= 3
        root[find(a)] = find(b)
    for a in values:
        for b in values:
            assert (a ^ b).bit_count() > 3 or find(a) == find(b)


def test_line_dedup(docs, no_docs, spark):
    got = lines.dedup_lines(docs).select("row.doc_id", "row.text", "row.size", F.col("text").alias("left"), "n_removed").collect()
    assert len(got) == docs.count()
    kept = [x for r in got if r.left is not None for x in r.left.split("\n") if len(x.strip(" ")) >= lines.MIN_CHARS]
    sets = [shingles(x.strip(" ").lower()) for x in kept]
    assert not any(similar(a, b) for k, a in enumerate(sets) for b in sets[:k])
    every = [x for r in got if r.text for x in r.text.split("\n") if len(x.strip(" ")) >= lines.MIN_CHARS]
    assert all(any(similar(shingles(x.strip(" ").lower()), s) for s in sets) for x in every)
    short = lambda t: [x for x in (t or "").split("\n") if x and len(x.strip(" ")) < lines.MIN_CHARS]
    assert all(short(r.text) == short(r.left) and (r.text is None) == (r.left is None) for r in got)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[2].n_removed == 0 and by_id[5].left.strip() == ""
    assert lines.dedup_lines(no_docs).count() == 0


def test_line_dedup_of_small_edits(spark):
    """One character or one word is changed in lines of 30 to 100 characters; likeness is that of 5-character shingles."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuw") for _ in range(r.randint(2, 8)))

    def likeness(a, b):
        a, b = ({x[k : k + 5] for k in range(len(x) - 4)} for x in (a, b))
        return len(a & b) / len(a | b)

    pairs = []
    for k in range(600):
        words = [word()]
        while len(" ".join(words)) < 30 + 62 * k // 600:
            words.append(word())
        line = " ".join(words)
        at = r.randrange(len(words)) if k % 2 else r.randrange(len(line))
        pairs.append((line, " ".join([*words[:at], word(), *words[at + 1 :]]) if k % 2 else line[:at] + "#" + line[at + 1 :]))
    assert all(30 <= len(line) <= 100 for line, _ in pairs)
    df = spark.createDataFrame([(2 * k + j, x) for k, pair in enumerate(pairs) for j, x in enumerate(pair)], "doc_id long, text string")
    got = {x.doc_id: x.n_removed for x in lines.dedup_lines(df).select("row.doc_id", "n_removed").collect()}
    near = [k for k, pair in enumerate(pairs) if likeness(*pair) >= 0.8]
    assert min(sum(k % 2 == j for k in near) for j in (0, 1)) > 80
    for j in (0, 1):
        found = [got[2 * k + 1] for k in near if k % 2 == j]
        assert sum(found) >= 0.96 * len(found)
    assert not any(got[2 * k] for k in range(600)) and not any(got[2 * k + 1] for k in set(range(600)) - set(near))


def test_short_line_dedup(spark):
    """Of short lines, exact copies go from the second on, and blank lines stay; from five characters on, likeness counts."""
    texts = ["Les.\n\nown line of the first text\n-", "  les. \n\t\n \nand ornd.\nété", "ÉTÉ\nand ornd.\nles\n\t\n-\r", "abcdefghijklmno\nles.\nLES.", "abcdefghijklmn\nabcd\nabcde"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.left for r in lines.dedup_lines(df).select("row.doc_id", F.col("text").alias("left")).collect()}
    assert got == {0: texts[0], 1: "\t\n \nand ornd.\nété", 2: "les\n\t\n-\r", 3: "abcdefghijklmno", 4: "abcd\nabcde"}


def shingles(line):
    return {line[k : k + lines.SHINGLE] for k in range(max(1, len(line) - lines.SHINGLE + 1))}


def similar(a, b):
    return 10 * len(a & b) >= 8 * len(a | b)


def joined(n, pairs):
    """Component of each of n nodes, by the smallest."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def some_lines(seed, n):
    """Lines in families of edits, of 5 to 3,000 characters, and unrelated ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuwé") for _ in range(r.randint(2, 8)))
    out = []
    while len(out) < n:
        words = [word() for _ in range(r.choice([1, 2, 8, 12, 30, 400]))]
        for _ in range(r.choice([1, 1, 4, 9])):
            out.append(" ".join(words))
            words[r.randrange(len(words))] = word()
    return list(dict.fromkeys(x for x in out if len(x) >= lines.SHINGLE))


@pytest.mark.parametrize("few", [32, 2])
def test_line_links_against_all_pairs(monkeypatch, few):
    """The sketch loses no pair, within small groups and in tiles of large ones."""
    import pyarrow as pa

    monkeypatch.setattr(lines, "FEW", few)
    monkeypatch.setattr(lines, "TILE", 16)
    own = some_lines(3, 240)
    limits = np.array([0, 1, 3, 40, 60, 200, len(own)])
    found = lines.Lines(pa.array(own)).links(limits[:-1], limits[1:])
    sets = [shingles(x) for x in own]
    assert all(similar(sets[a], sets[b]) for a, b in found)
    group = np.searchsorted(limits, np.arange(len(own)), "right")
    want = [(a, b) for a in range(len(own)) for b in range(a) if group[a] == group[b] and similar(sets[a], sets[b])]
    got = joined(len(own), found)
    assert len(want) > 100 and got == joined(len(own), want)
    assert len(found) == len(own) - len(set(got))


def test_signatures_of_a_line_do_not_depend_on_its_neighbours(monkeypatch):
    whole = lines.LONG
    own = some_lines(4, 200)
    one = lambda xs: lines.signatures(np.frombuffer("".join(xs).encode(), np.uint8), np.cumsum([0, *(len(x.encode()) for x in xs)]))
    want = one(own)
    for most in (whole, 700):
        monkeypatch.setattr(lines, "LONG", most)
        assert (want == np.concatenate([one([x]) for x in own])).all() and (want == one(own)).all()
    assert max(map(len, own)) > lines.LONG


@pytest.mark.parametrize("part", [4096, 2])
def test_line_components_against_brute_force(spark, monkeypatch, part):
    """Recall of the links that brute force finds, and no false ones; with every band value dealt in cells as well."""
    monkeypatch.setattr(lines, "PART_LINES", part)
    monkeypatch.setattr(lines, "COUNTED", 1 if part == 2 else 64)
    own = some_lines(6, 900)
    df = spark.createDataFrame([(k, x) for k, x in enumerate(own)], "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(df).select("row.doc_id", "n_removed").collect()}
    sets = [shingles(x) for x in own]
    near = [(a, b) for a in range(len(own)) for b in range(a) if similar(sets[a], sets[b])]
    removed = {k for k, c in enumerate(joined(len(own), near)) if c != k}
    gone = {k for k, n in got.items() if n}
    assert len(removed) > 200 and gone <= removed and len(gone) >= 0.97 * len(removed)


@pytest.mark.parametrize("span,values", [(1 << 16, 1 << 20), (50, 1 << 20), (1 << 16, 40)])
def test_band_values_in_blocks(spark, monkeypatch, span, values):
    """Lines that share a band value, against plain grouping: numbers jump between files, some lines have no bands, and band
    values that are left out don't come back.  Values are not dealt row by row."""
    monkeypatch.setattr(lines, "BLOCK_LINES", span)
    monkeypatch.setattr(lines, "BUCKET_VALUES", values)
    rng = np.random.default_rng(5)
    numbers = [*range(300), *range(1 << 33, (1 << 33) + 300), 1 << 40]
    value = lambda k: int(lines.mixed(np.array([k], np.uint64)).view(np.int64)[0])
    bands = {k: [] if k % 7 == 3 else [value(x) for x in rng.choice(900, lines.BANDS, replace=False)] for k in numbers}
    df = spark.createDataFrame(list(bands.items()), "name long, bands array<long>").repartition(3).sortWithinPartitions("name")
    by = defaultdict(set)
    for k, own in bands.items():
        for x in own:
            by[x].add(k)
    several = {x: own for x, own in by.items() if len(own) > 1}
    assert several and any(len(own) == 1 for own in by.values())
    hot = sorted(several)[::5]
    got = lines.in_blocks(df, spark.createDataFrame([(x,) for x in hot], "band long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, k) for x, own in several.items() if x not in hot for k in own)
    found = lines.shared_bands(df)
    sets = defaultdict(set)
    for r in found.collect():
        sets[r.key].add(r.name)
    assert sorted(map(sorted, sets.values())) == sorted(map(list, {tuple(sorted(own)) for own in several.values()}))
    assert "Generate" not in found._jdf.queryExecution().toString()


def test_hot_lines(spark):
    """One line in nearly all texts, and one template with very many fillings, meet in cells."""
    df = spark.range(6000).selectExpr("id as doc_id", "concat('all rights are reserved by the owners of this site\n', 'the best offer of this week is made for customer number ', id, ' of ours, do not miss it, we say') as text")
    got = lines.dedup_lines(df).agg(F.sum("n_removed")).first()[0]
    assert got >= 5999 * 2 - 30


def test_very_many_fillings_of_a_template(spark):
    """40,000 lines that all are alike, and a few that are like some of them only, in linear time."""
    import time

    df = spark.range(40_000).selectExpr("id as doc_id", "concat('the best offer of this week is made for customer number ', id, ' of ours, do not miss it, we say, as it ends soon') as text")
    odd = spark.range(50).selectExpr("100000 + id as doc_id", "concat('word', id, ' and nothing that is like the rest, number ', id * 7919, ' stands alone') as text")
    began = time.time()
    got = lines.dedup_lines(df.union(odd)).groupBy(F.col("row.doc_id") >= 100_000).agg(F.sum("n_removed").alias("n")).collect()
    assert time.time() - began < 120
    got = {r[0]: r.n for r in got}
    assert got[False] >= 39_999 - 40 and got[True] == 0


NOTHING_COLLECTED = r"""
import glob, json, os, sys, time
from pyspark.sql import SparkSession
from textgraph.llm import common, lines

at = sys.argv[1]
conf = {"spark.cleaner.referenceTracking": "false", "spark.local.dir": f"{at}/local", "spark.checkpoint.dir": f"file://{at}/shared", "spark.sql.warehouse.dir": f"{at}/warehouse", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
spark = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
left = []

def size():
    return sum(os.path.getsize(f) for f in glob.glob(f"{at}/local/**/shuffle_*.data", recursive=True))

class Watched(common.Scratch):
    def __call__(self, df, kind="table", release=False):
        before = size()
        out = super().__call__(df, kind, release)
        end = time.time() + 10  # files go while the driver goes on
        while size() > before and time.time() < end:
            time.sleep(0.1)
        left.append((kind, size() - before))
        return out

texts = spark.range(3000).selectExpr("id", "concat_ws('\n', transform(sequence(0, 7), k -> concat(sha2(cast(id % 2900 as string), 256), k, sha2(cast(id % 2900 * 8 + k as string), 256)))) as text")
n = lines.removed_lines(texts, Watched()).count()
print(json.dumps([n, left]))
"""


def test_shuffles_go_with_their_table(tmp_path):
    """No shuffle file outlives the table it was made for, though the driver never collects what refers to it."""
    env = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
    run = subprocess.run([sys.executable, "-c", NOTHING_COLLECTED, str(tmp_path)], env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    n, left = json.loads(run.stdout.splitlines()[-1])
    assert n == 100 and {"lines", "hot", "candidates", "found", "links", "several"} <= {kind for kind, _ in left}
    assert all(size <= 0 for _, size in left), left


@pytest.mark.parametrize("first", [0, 1, 8])
def test_tiles_join_what_pairs_join(monkeypatch, first):
    """Components of a large group, with lines that are known to be linked, against all pairs."""
    import pyarrow as pa

    monkeypatch.setattr(lines, "FIRST", first)
    monkeypatch.setattr(lines, "TILE", 16)
    own = some_lines(first, 160)
    sets, n = [shingles(x) for x in own], len(own)
    known = np.zeros(n, np.int64)
    known[[3, 40, 77]] = 5  # linked elsewhere, alike or not
    elsewhere = [(40, 3), (77, 40)]
    want = joined(n, [(a, b) for a in range(n) for b in range(a) if similar(sets[a], sets[b])] + elsewhere)
    found = lines.Lines(pa.array(own)).links(np.array([0]), np.array([n]), known)
    assert all(similar(sets[a], sets[b]) for a, b in found)
    assert joined(n, found + elsewhere) == want and 3 < len(set(want)) < n


def test_many_lines_of_one_document(spark):
    df = spark.createDataFrame([(0, "\n".join(f"a line of its own, {k * k}" for k in range(9))), (1, "again and again the same\n" * 30_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(df).select("row.doc_id", "text", "n_removed").collect()}
    assert got[1].n_removed == 29_999 and got[1].text == "again and again the same\n"


def test_quality_rules(docs, no_docs):
    got = {(r.doc_id, r.n_words, r.word_chars) for r in quality_rules.apply_rules(docs).collect()}
    want = {(r.doc_id, len(w := re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), len("".join(w))) for r in docs.collect()}
    assert got == want
    for r in quality_rules.apply_rules(docs).join(docs.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        again = {j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(k, k + 5)}
        assert r.n_repeat_words == len(again)
        assert r.base_failed == (len(w) < 10 or 100 * len(again) > 20 * len(w))
    assert quality_rules.apply_rules(no_docs).count() == 0


def test_boilerplate_lines(spark):
    rows = [(k, f"Subscribe to our letter\nown line number {k} with ten words or more in it, as asked", "h") for k in range(40)]
    rows += [(100, "Subscribe to our letter\n" * 5 + "a b c d e f g h i j", "h"), (101, "Subscribe to our letter\nand more words of our own here, ten or more of these", "other")]
    got = {r.doc_id: r for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[3].removed_chars == len("Subscribe to our letter") and got[3].kept
    assert not got[100].kept
    assert got[101].removed_chars == 0 and got[101].kept


def test_very_many_boilerplate_lines_in_one_text(spark):
    """Linear in the lines of a text; blank lines stay where they are."""
    import time

    lines_ = [f"common line number {k}" for k in range(30_000)]
    rows = [(k, "\n".join(lines_[:3000]), "h") for k in range(22)] + [(99, "\n \n".join(lines_[:3000]) + "\nown line\n", "h")]
    began = time.time()
    got = {r.doc_id: r for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert time.time() - began < 60
    assert got[99].text == "\n".join([" "] * 2999 + ["own line", ""]) and got[0].text == "" and not got[0].kept


def test_boilerplate_by_number_on_a_large_host(spark):
    """100 of 4,000 documents are under the share; the absolute limit takes the line all the same."""
    rows = [(k, ("Subscribe to our letter\n" if k % 40 == 0 else "") + f"own line {k} with ten words or more in it, as asked", "h") for k in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for limit, removed in ((99, 100), (100, 0), (None, 0)):
        assert quality_rules.apply_rules(df, max_docs=limit).where("removed_chars > 0").count() == removed


def test_texts_without_boilerplate_lines(spark):
    own = "own line number {} with ten words or more in it, as asked"
    rows = [(k, f"  Subscribe to\tOUR letter \n\n{own.format(k)}\nsubscribe to our letter", "h") for k in range(40)]
    rows += [(7, "Subscribe to our letter", "h"), (None, None, "h"), (101, "Subscribe to our letter\n" + own.format(101), "other"), (102, "", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = quality_rules.apply_rules(df).collect()
    want = [(k, f"\n{own.format(k)}", 49, True) for k in range(40)] + [(7, "", 23, False), (None, None, 0, False), (101, rows[-2][1], 0, True), (102, "", 0, False)]
    key = lambda x: (x[0] or -1, x[1] or "")
    assert sorted([(r.doc_id, r.text, r.removed_chars, r.kept) for r in got], key=key) == sorted(want, key=key)


def test_classifier(spark, docs, no_docs):
    from tests.llm.conftest import prose

    rows = [(k, prose(k, 80) if k % 3 else " ".join(w.upper() + "!!" for w in prose(k, 80).split())) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(300)] + [(5, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    net = quality_cnn.fit(df, labels)
    got = {r.doc_id: r.score for r in quality_cnn.score(df, net).select("row.doc_id", "score").collect()}
    held = [k for k in range(300) if __import__("zlib").crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(got[k] >= 0.3) == (k % 3 > 0) for k in held]) > 0.95
    odd = quality_cnn.score(docs, net, docs.columns).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality_cnn.score(no_docs, net).count() == 0
    with pytest.warns(UserWarning, match="no labelled document"):
        quality_cnn.fit(df, labels.withColumn("doc_id", F.col("doc_id") + 1000))
    assert set(quality_cnn.scores(quality_cnn.fit(df, labels.limit(0)), *__import__("textgraph.llm.common", fromlist=["x"]).text_bytes(__import__("pyarrow").array(["a", None])))) == {0.5}


def test_classifier_with_a_giant_text(spark):
    """A first text far beyond the bytes of the sample costs its own bytes alone, and all rows train."""
    from tests.llm.conftest import prose

    assert quality_cnn.piece_bytes([5, 100, 7], 32) == 20 and quality_cnn.piece_bytes([5, 7], 32) == 7 and quality_cnn.piece_bytes([], 1) == 1
    giant = "lorem ipsum dolor " * 60_000
    rows = [(k, giant if k % 50 == 1 else prose(k, 60) if k % 3 else " ".join(w.upper() + "!!" for w in prose(k, 60).split())) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(300)], "doc_id long, quality int")
    net = quality_cnn.fit(df, labels, sample_bytes=200_000)
    got = {r.doc_id: r.score for r in quality_cnn.score(df, net).select("row.doc_id", "score").collect()}
    assert np.mean([(got[k] >= 0.3) == (k % 3 > 0) for k in range(300) if k % 50 != 1]) > 0.95


def area(scores, labels):
    """Area under the curve of hits over false alarms."""
    rank = np.argsort(np.argsort(scores)) + 1.0
    yes = labels.astype(bool)
    return (rank[yes].sum() - yes.sum() * (yes.sum() + 1) / 2) / (yes.sum() * (~yes).sum())


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op4_quality_cnn(spark, sf).where("held_out").join(queries.table(spark, sf, "labels"), "doc_id").select("score", "quality").toPandas()
    assert len(found) > 50 and area(found.score.to_numpy(), found.quality.to_numpy()) > 0.95


def test_network_gradient():
    """The gradient against differences."""
    net = quality_cnn.Network.fresh(1)
    texts = [b"abc def ghi " * 30, b"HELLO!! WORLD!! " * 25, b"x"]
    limits = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    raw, y = np.frombuffer(b"".join(texts), np.uint8), np.array([1, 0, 1], np.float32)

    def loss():
        p = quality_cnn.scores(net, raw, limits)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = quality_cnn.gradient(net, raw, limits, y)
    r = np.random.default_rng(0)
    for part, grad in zip(net.parts(), grads):
        flat, g = part.reshape(-1), grad.reshape(-1)
        for k in r.choice(np.flatnonzero(np.abs(g) >= np.abs(g).max() * 0.3), 3):
            old = flat[k]
            flat[k] = old + 2e-3
            up = loss()
            flat[k] = old - 2e-3
            down = loss()
            flat[k] = old
            assert (up - down) / 4e-3 == pytest.approx(g[k], rel=0.25, abs=2e-3)


def test_personal_data(spark, docs, no_docs):
    texts = [
        "mail a.b@c.de, x@y@z.org and q@r.s_t@u.v", "ip 1.2.3.4.5.6.7.8 or 999.1.1.1 and 0001.2.3.255", "card 4111 1111 1111 1111 or 4111-1111-1111-1112; é 4111111111111111",
        "call +1 (017) 555-7713 now, or +49 30, +1234567890123456", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "", None, "@" * 50 + "." * 50, "1 " * 3000, "+" + "1-" * 3000,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(df).select("doc_id", pii.joined("base").alias("base"), pii.joined("spans").alias("spans")).collect()}

    def luhn(s):
        return sum((x := int(c) * (1 + k % 2)) - 9 * (x > 9) for k, c in enumerate(reversed(s))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    for k, t in enumerate(texts):
        want = [f"{kind}:{m.start()}:{m.end()}" for kind, p, ok in kinds for m in re.finditer(p, t or "") if ok(m[0])]
        assert got[k].base == ",".join(want), k
        assert set(filter(None, want)) <= set(got[k].spans.split(","))
    assert pii.find_personal_data(docs).count() == docs.count()
    assert pii.find_personal_data(no_docs).count() == 0


def test_reliabilities():
    p, chances = pii.reliabilities({"11-": 40, "00-": 50, "10-": 3, "1--": 5})
    assert p["11-"] > 0.9 > 0.1 > p["00-"]
    assert chances[0][0] > chances[0][1]


def test_packing(docs, no_docs):
    from tokenizers import Tokenizer

    path = queries.word_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    got = packing.pack(docs, path, capacity=256, pool_sequences=4).collect()
    want = sorted([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect())
    made = []
    for r in got:
        assert r.length > 0 and len(r.ids) == 4 * r.length
    # repeated rows share an id: rebuild documents from starts
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for (_, n), parts in by.items():
        parts.sort()
        heads = [p for p in parts if p[0] == 0]
        for _ in heads:
            at, ids = 0, []
            while at < n:
                k = next(i for i, p in enumerate(parts) if p[0] == at)
                ids += parts.pop(k)[1]
                at = len(ids)
            made.append(ids)
        assert not parts
    assert sorted(made) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256 and (at == 256 or at & (at - 1) == 0)
    assert packing.pack(no_docs, path).count() == 0


def test_tokens_of_odd_words():
    from pyarrow import array
    from tokenizers import Tokenizer

    texts = ["Don't STOP'll 'sound !'s", "<|endoftext|> <|ENDOFTEXT|> a<|endoftext|>b", "İstanbul ΣΑΣ ςσ Ǆ é ﬁ ½ x²", "a b c\x1cd", "日本語 テスト", "12ab_3 __", "", None]
    words = packing.WordTokenizer(queries.word_tokenizer())
    ids, limits = words.ids(array(texts))
    tokenizer = Tokenizer.from_file(queries.word_tokenizer())
    for k, t in enumerate(texts):
        assert ids[limits[k] : limits[k + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_suffix_ranks():
    r = np.random.default_rng(5)
    text = r.integers(97, 99, 400).astype(np.uint8)
    for width in (3, 8, 13, 40):
        starts = np.arange(0, 400 - width, 3)
        rank = repeats.suffix_ranks(text, starts, width)
        strings = [text[s : s + width].tobytes() for s in starts]
        assert [sorted(set(strings)).index(x) for x in strings] == rank.tolist()


def test_dealing_follows_the_rule():
    """Descending lengths, the lowest cost among those with room, cuts only where none has any: against a plain version."""
    r = random.Random(8)
    for capacity, count in ((16, 5), (64, 9), (64, 40)):
        lengths = [r.choice([1, 2, 3, 5, 5, 5, capacity // 2, capacity - 1]) for _ in range(count)]
        packer = packing.Packer(capacity, 1 << 30, float(capacity))
        for doc, n in enumerate(lengths):
            packer.add(doc, np.arange(n, dtype=np.uint32))
        sizes = [capacity] * (sum(lengths) // capacity)
        packer.deal(sizes)
        got = {(doc, start): (len(ids) // 4, sequence, offset) for doc, start, _, ids, _, sequence, offset in packer.rows}
        room, used, cost, want, left = list(sizes), [0] * len(sizes), [0.0] * len(sizes), {}, 0
        for n, _, doc in sorted((-n, doc, doc) for doc, n in enumerate(lengths)):
            n, start = -n, 0
            while n:
                able = [k for k in range(len(sizes)) if room[k] >= n] or [k for k in range(len(sizes)) if room[k]]
                if not able:
                    left += n
                    break
                k = min(able, key=lambda k: (cost[k], k))
                part = min(n, room[k])
                want[doc, start] = (part, k, used[k])
                room[k], used[k], cost[k] = room[k] - part, used[k] + part, cost[k] + part + part * part / capacity
                n, start = n - part, start + part
        assert got == want and packer.tokens == left < capacity and not any(room)


def test_added_personal_data_by_planted_spans(spark):
    """Precision and recall of the spans that the classifier adds, over planted ones and decoys, in cues never seen together."""
    r = random.Random(11)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name = lambda: r.choice(["Alma", "Bruno", "Celia", "Dario", "Elif"]) + " " + r.choice(["Okafor", "Lindgren", "Moreau", "Tanaka"])
    plant = [
        lambda: ("phone ", f"0{number(2)} {number(3)} {number(4)}"), lambda: ("call ", f"({number(3)}) {number(3)}-{number(4)}"), lambda: ("token ", "".join(r.choice("0123456789abcdef") for _ in range(40))),
        lambda: ("mail ", f"{r.choice(['jo', 'max.b', 'x_y'])} (at) example (dot) org"), lambda: ("", f"{r.choice(['Mr.', 'Dr.', 'Frau', 'Mme'])} {name()}"), lambda: ("contact ", f"{r.choice(['ann', 'bob'])}[at]mail[dot]net"),
    ]
    decoy = [lambda: ("page ", number(8)), lambda: ("isbn ", f"{number(1)}-{number(4)}-{number(4)}-{number(1)}"), lambda: ("volume ", number(9)), lambda: ("chapter ", number(10)), lambda: ("table ", f"{number(4)}.{number(4)}.{number(3)}")]
    rows, planted, decoys = [], set(), set()
    for doc in range(400):
        text = ""
        for _ in range(r.randint(1, 5)):
            text += " ".join("".join(r.choice(["th", "er", "in", "ou", "an", "é"]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(4, 20))) + ". "
            kind = r.random()
            if kind < 0.8:
                cue, span = r.choice(plant if kind < 0.5 else decoy)()
                text += cue
                (planted if kind < 0.5 else decoys).add((doc, len(text), len(text) + len(span)))
                text += span + " , "
        rows.append((doc, text))
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    base = {(x.doc_id, s["s"], s["e"]) for x in found for s in x.base}
    added = {(x.doc_id, s["s"], s["e"]) for x in found for s in x.spans} - base
    wanted = planted - base
    assert len(wanted) > 200 and len(decoys) > 100
    recall, precision = len(added & wanted) / len(wanted), len(added & wanted) / len(added)
    assert recall >= 0.9 and precision >= 0.9, (recall, precision, sorted(added - wanted)[:5], sorted(wanted - added)[:5])
