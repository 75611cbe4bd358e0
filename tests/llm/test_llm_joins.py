from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import final_plan
from pyspark.sql import functions as F

from footfall.llm import suffix_dedup as suffix
from footfall.llm.common import stage
from footfall.llm.components import components, tied
from footfall.llm.decontamination import decontamination, winnow
from footfall.llm.jaccard_join import jaccard_join
from footfall.llm.loser_tree import merge as merge_tuples
from footfall.llm.prefix_merge import common_prefix, front_code, front_decode, merge

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- decontamination ----------------------------------------------------------------------------

def brute_hits(text, items):
    windows = defaultdict(set)
    for item, item_text in items:
        words = ITEM_WORD.findall(lower(item_text))
        for i in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[i:i + 13])].add(item)
    words, hit, found = ITEM_WORD.findall(lower(text)), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found |= windows[tuple(words[i:i + size])]
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


@pytest.fixture(scope="module")
def items(plain):
    texts = {r.doc_id: r.text for r in plain.collect()}
    passage = texts[27].split(" ")
    return [(10, " ".join(passage[:13])), (2, " ".join(passage[20:45])), (3, "One, two: THREE"), (4, ""),
            (5, None), (2, "one"), (None, " ".join(passage[50:60])), (6, texts[6]), (7, " ".join(passage[5:14])),
            (8, "of of of of"), (9, "never seen in any text of all these words at all my friend ok")]


def test_hits_are_those_of_brute_force(spark, plain, items):
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING").withColumnRenamed("text", "text")
    texts = {r.doc_id: r.text for r in plain.collect()}
    rows = decontamination(plain, benchmark).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words, hit, found = brute_hits(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items) == (words, hit, len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= words)
    assert sum(r.contaminated for r in rows) > 5


def test_decontamination_takes_whatever_comes(spark, hostile, no_documents, items):
    benchmark = spark.createDataFrame([(a, b, "r") for a, b in items], "item_id BIGINT, text STRING, row STRING")
    assert decontamination(hostile, benchmark).count() == hostile.count()
    assert decontamination(no_documents, benchmark).count() == 0
    assert decontamination(hostile, benchmark.limit(0)).filter("n_hit > 0").count() == 0


def test_winnowing_keeps_one_of_every_span():
    keys = np.random.default_rng(3).integers(0, 6, 200)
    kept = winnow(keys, 5)
    for i in range(196):
        inside = [k for k in kept if i <= k < i + 5]
        assert inside and keys[inside].min() == keys[i:i + 5].min()


# --- Jaccard join -------------------------------------------------------------------------------

def brute_components(rows, percent=85):
    sets, parent = {}, {}
    for key, text in rows:
        words = SPACE_WORD.findall(lower(text))
        sets[key] = {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()
        parent[key] = key

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_components_are_those_of_brute_force(plain):
    expected = brute_components([tuple(r) for r in plain.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(plain).collect()}
    assert got == expected
    assert max(Counter(c for _, c in expected.values()).values()) > 10


@pytest.mark.parametrize("seed", range(3))
def test_random_families_of_near_copies(spark, seed):
    rng, rows = random.Random(seed), []
    for family in range(6):
        source = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, 14)):
            copy = list(source)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(30)}"
            rows.append((rng.randrange(10**6), " ".join(copy[:rng.randrange(len(copy) - 2, len(copy) + 1)])))
    rows = list(dict(rows).items())
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(df, slices=7).collect()}
    assert got == brute_components(rows)


def test_join_takes_whatever_comes(spark, hostile, no_documents):
    rows = jaccard_join(hostile).collect()
    assert len(rows) == hostile.count()
    assert {r.component_id for r in rows if r.doc_id == 7} == {7}
    assert [r.component_id for r in rows if r.doc_id is None] == [7]  # the same words in capitals
    assert all(r.component_id == r.doc_id for r in rows if r.n_shingles == 0)
    assert jaccard_join(no_documents).count() == 0


def test_a_node_with_most_links_is_split(spark, splitting):
    hub = stage(spark.range(1, 60_001, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("a"), F.lit("").alias("b")), "hub")
    least = stage(hub.unionByName(hub.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(
        F.min("b").alias("m")), "least")
    result = tied(hub, least, True).agg(F.count("*"), F.max("b"))
    assert tuple(result.collect()[0]) == (60_000, "")
    assert "skew=true" in final_plan(result)
    assert components(hub).filter("root = ''").count() == 60_001


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 300), (5, 200), (200, 5)]
    df = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 0, **{i: 100 for i in range(100, 160)}}
    assert components(df.limit(0)).count() == 0


# --- loser trees --------------------------------------------------------------------------------

@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 8])
def test_loser_tree_merges(runs):
    rng = random.Random(runs)
    parts = [sorted((rng.randrange(50), r, i) for i in range(rng.randrange(0, 40))) for r in range(runs)]
    assert list(merge_tuples(parts)) == sorted(x for part in parts for x in part)


@pytest.mark.parametrize("runs", [0, 1, 2, 5, 9])
def test_prefix_tree_merges_and_knows_shared_prefixes(runs):
    rng = random.Random(runs + 10)
    parts = [sorted(bytes(rng.choice(b"\x00ab") for _ in range(rng.randrange(0, 70))) for _ in range(60))
             for _ in range(runs)]
    if runs > 1:
        parts[1] = parts[0][:30]
    coded = [front_code(part) for part in parts]
    assert [[t for _, t in front_decode(*c)] for c in coded] == parts
    merged = list(merge([front_decode(*c) for c in coded]))
    assert [t for _, _, t in merged] == sorted(t for part in parts for t in part)
    last = b""
    for _, shared, text in merged:
        assert shared == common_prefix(last, text)
        last = text


# --- suffix dedup -------------------------------------------------------------------------------

def brute_removed(texts):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i:i + 200] for d in data for i in range(len(d) - 199))
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 199):
            if counts[d[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        yield len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()


def compare_removed(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix.suffix_dedup(df, **options).collect()}
    assert [got[i] for i in range(len(texts))] == list(brute_removed(texts))
    return got


def test_removed_bytes_are_those_of_brute_force(spark, plain):
    got = compare_removed(spark, [r.text for r in sorted(plain.collect())], parts=5)
    assert sum(r[1] for r in got.values()) > 10_000


@pytest.mark.parametrize("seed", range(4))
def test_random_edits_and_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix, "RUN_ENTRIES", 40)
    rng = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcdefghijklmnop é"
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(150, 420))) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            passage = list(rng.choice(passages))
            for _ in range(rng.choice((0, 0, 1, 2))):
                passage[rng.randrange(len(passage))] = rng.choice(alphabet)
            cut = rng.randrange(0, 60)
            parts += ["".join(passage[cut:]), "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 80)))]
        texts.append("".join(parts))
    compare_removed(spark, texts, parts=3)


def test_blocks_of_long_texts_make_no_difference(spark, monkeypatch):
    data = "".join(random.Random(1).choice("abcdef") for _ in range(3000)).encode() * 2
    whole = [(f + i, f + m) for f, n, m, _ in suffix.anchors(data) for i in range(n)]
    monkeypatch.setattr(suffix, "BLOCK", 500)
    assert [(f + i, f + m) for f, n, m, _ in suffix.anchors(data) for i in range(n)] == whole


def test_dedup_takes_whatever_comes(hostile, no_documents):
    rows = suffix.suffix_dedup(hostile, keep_text=True).collect()
    assert len(rows) == hostile.count()
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in rows)
    assert all(r.n_removed == r.n_bytes for r in rows if r.doc_id == 7)
    assert suffix.suffix_dedup(no_documents).count() == 0
