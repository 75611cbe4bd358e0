from __future__ import annotations

import base64
import hashlib
import io
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import final_plan
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import files
from footfall.llm.best_fit_packing import best_fit_packing, fullest, packing_plan
from footfall.llm.common import stage
from footfall.llm.queries import VOCABULARY
from footfall.llm.token_files import best_fit_decreasing, read_token_files, write_shard, write_token_files
from footfall.llm.tokens import WordCoder
from footfall.llm.warc import capture_time, mark_revisits, merge_index, read_captures, safe_key, tell_revisits, warc, write_archives

ODD = ["don't it's we'll'x 12345 x", "a<|endoftext|>b  c", "\t\r\nfoo\x0bbar\x85baz", "İstanbul ẞ Σας ÀÉ, naïve.,!",
       "é́ ́a", "", None, "  ", "THE,the.The! ...", "日本語 text", "a\x1cb"]


def test_ids_are_the_tokenizers_own(plain):
    coder, whole = WordCoder.of(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for text in [*ODD, *(r.text for r in plain.collect())]:
        expected = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(coder.ids(text), "<u4").tolist() == expected
    texts = [*ODD, *(r.text for r in plain.collect())]
    texts += ["".join(random.Random(i).choices("aBé ß.,!'1ÿıx-\n<", k=25)) for i in range(2000)]
    texts += ["".join(random.Random(i).choices("sTÀ$#~_\t\v\f\r '̸́\u00a0µªk<|>", k=25)) for i in range(3000)]
    for most in (400_000, 50):
        coder = WordCoder(VOCABULARY, most)
        for text, got in zip(texts, coder.texts(pa.array(texts, pa.string()), 3000), strict=True):
            expected = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
            assert np.frombuffer(got, "<u4").tolist() == expected
    assert list(coder.texts(pa.array([], pa.string()))) == []


def test_fullest_combination_is_that_of_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(5)}
        room, sums = rng.randrange(1, 60), {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        chosen = fullest(counts, room)
        assert sum(length * n for length, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[length] for length, n in chosen.items())


def test_plan_places_every_piece_once():
    rng = random.Random(3)
    counts = Counter(min(100, int(rng.expovariate(0.05)) + 1) for _ in range(3000))
    segments, n = packing_plan(counts, 100)
    used = defaultdict(list)
    for length, rows in segments.items():
        assert rows[0][0] == 0 and rows[-1][1] == counts[length]
        assert all(a[1] == b[0] for a, b in zip(rows, rows[1:]))
        for first, end, copies, sequence, offset in rows:
            for k in range(end - first):
                used[sequence + k // copies].append((offset + k % copies * length, length))
    assert len(used) == n
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    assert n <= math.ceil(sum(k * v for k, v in counts.items()) / 100) + 1


def check_packed(rows, ids, sequence, capacity):
    """``ids`` in the order of the documents; every document is there whole, every sequence gapless."""
    places, found = defaultdict(list), Counter()
    for r in rows:
        places[sequence(r)].append((r.offset, r.length))
        found[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    expected = Counter()
    for doc_id, tokens in ids:
        for at in range(0, len(tokens), capacity):
            part = tokens[at:at + capacity]
            expected[(doc_id, at // capacity, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert found == expected
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def tokens_of(df):
    whole = Tokenizer.from_file(VOCABULARY)
    return [(r.doc_id, [*whole.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in df.collect()]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_round_trip(hostile, capacity, no_documents):
    rows = best_fit_packing(hostile, VOCABULARY, capacity).collect()
    ids = tokens_of(hostile)
    check_packed(rows, ids, lambda r: r.sequence_id, capacity)
    assert len({r.sequence_id for r in rows}) <= 1.01 * -(-sum(len(x) for _, x in ids) // capacity)
    assert best_fit_packing(no_documents, VOCABULARY).count() == 0


def test_best_fit_decreasing_is_that_of_brute_force():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.randrange(1, 65) for _ in range(rng.randrange(0, 60))]
        places, n = best_fit_decreasing(lengths, 64)
        rooms = []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [r for r in rooms if r >= lengths[i]]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - lengths[i])
            else:
                rooms.append(64 - lengths[i])
        assert n == len(rooms)
        filled = Counter()
        for (sequence, offset), length in zip(places, lengths):
            filled[sequence] += length
        assert sorted(64 - x for x in filled.values()) == sorted(rooms)


def test_token_files_round_trip(spark, hostile, tmp_path, no_documents):
    shards = write_token_files(hostile, VOCABULARY, f"file://{tmp_path}/t", 128, shard_tokens=3000)
    assert shards.count() > 3
    rows = read_token_files(shards).collect()
    check_packed(rows, tokens_of(hostile), lambda r: (r.shard, r.sequence), 128)
    for shard in shards.collect():
        matrix = np.load(io.BytesIO(files.read(f"{shard.path}.ids.npy")))
        ends = np.load(io.BytesIO(files.read(f"{shard.path}.lengths.npy")))
        resets = np.load(io.BytesIO(files.read(f"{shard.path}.resets.npy")))
        assert matrix.shape == (shard.sequences, 128) and ends[-1] == shard.tokens
        for (row, at, first), length in zip(resets, np.diff(ends)):
            assert at + length <= 128 and first % 128 == 0
    assert write_token_files(no_documents, VOCABULARY, f"file://{tmp_path}/e").count() == 0


def test_ids_that_do_not_fit_or_were_changed_are_errors(spark, tmp_path):
    def shard(ids, id_type):
        data = np.array(ids, "<u4").tobytes()
        return write_shard(f"file://{tmp_path}/s", [(1, 0, 0, data)], 8, id_type, pa.int64())[0]

    with pytest.raises(ValueError, match="70000"):
        shard([5, 70_000], "<u2")
    path = shard([5, 70_000], "<u4")
    shards = spark.createDataFrame([(path,)], "path STRING")
    assert read_token_files(shards).first().ids_crc32 == zlib.crc32(np.array([5, 70_000], "<u4").tobytes())
    matrix = np.load(io.BytesIO(files.read(f"{path}.ids.npy")))
    np.save(f"{path.removeprefix('file://')}.ids.npy", matrix + 1)
    with pytest.raises(Exception, match="not those that were written"):
        read_token_files(shards).collect()


PAGES = [
    (1, "https://b.example.com/x?q=1#frag", "<p>one</p>"), (2, "http://a.example.com/", "<p>one</p>"),
    (3, "http://a.example.com/", None), (4, None, ""), (5, "not a url [", "<p>ü</p>"), (6, "http://A.example.com/", "x"),
    (6, "http://A.example.com/", "x"), (None, "http://c.example.com/", "x"), (9, "http://d\r\nx/", "line\r\n\r\nend"),
]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "r", 1) for p in PAGES],
                                  "page_id BIGINT, url STRING, html STRING, digest STRING, row INT").repartition(3)
    captures = write_archives(mark_revisits(pages), f"file://{tmp_path}/w", archive_bytes=600)
    rows = read_captures(merge_index(captures, 3)).collect()
    assert len(rows) == len(PAGES)
    keys = [(r.url_key, r.captured, r.page_id is None, r.page_id or 0) for r in rows]
    assert keys == sorted(keys)
    first = {}
    for page_id, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(html or "", page_id)
    expected, seen = Counter(), set()
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = first[html or ""] != page_id or (page_id, html) in seen
        seen.add((page_id, html))
        expected[(page_id, len(payload), digest, "revisit" if again else "response",
                  first[html or ""] if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in rows) == expected


def test_capture_times_follow_the_page_ids():
    assert capture_time(None) == capture_time(0) == "1970-01-01T00:00:00Z"
    assert capture_time(1_800_000_001) == "2027-01-15T08:00:01Z"
    assert capture_time(253_402_300_799) == "9999-12-31T23:59:59Z"
    ids = [0, 10**9 - 1, 10**9, 10**9 + 1, 10**11]
    assert sorted(ids, key=capture_time) == ids


def test_a_digest_of_half_the_pages_is_split(spark, splitting):
    pages = spark.range(40_000, numPartitions=8).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") % 2 == 0, "same").otherwise(F.concat(F.lit("p"), "id")).alias("html"))
    marked = mark_revisits(pages)
    found = [r for r in marked.select("page_id", "revisit", "refers_to").collect() if r.revisit]
    assert len(found) == 19_999 and {r.refers_to for r in found} == {0}
    known = stage(pages.select("page_id", F.col("page_id").alias("row"), F.col("html").alias("digest")), "known")
    firsts = stage(known.groupBy("digest").agg(
        F.min(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1"), "firsts")
    told = tell_revisits(known, firsts).agg(F.max("refers_to"), F.count_if("revisit"))
    assert tuple(told.collect()[0]) == (0, 19_999)
    assert "skew=true" in final_plan(told)


def test_payloads_of_revisits_and_single_pages_stay_where_they_are(spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("copy"), F.col("id") % 30)).otherwise(
            F.concat(F.lit("p"), "id")).alias("html"))
    marked = mark_revisits(pages)
    assert marked.filter("revisit").count() == 990
    assert marked.filter("revisit and payload is not null or not revisit and payload is null").count() == 0
    moved = marked.select("payload")
    moved.collect()
    plan = final_plan(moved)  # the least of each repeated digest alone may cross a shuffle, by row
    branches = plan[:plan.index("== Initial Plan ==")].count("Scan parquet")
    assert branches == 4 and "hashpartitioning(digest" not in plan


def test_the_index_is_the_same_for_any_number_of_ranges(spark, tmp_path):
    pages = spark.range(500).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), F.col("id") % 7).alias("url"),
        F.col("id").cast("string").alias("html"))
    captures = write_archives(mark_revisits(pages), f"file://{tmp_path}/w", archive_bytes=3000)
    orders = [merge_index(captures, n).collect() for n in (1, 5, None)]
    assert orders[0] == orders[1] == orders[2] and len(orders[0]) == 500


def test_small_payloads_can_all_be_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id BIGINT, url STRING, html STRING")
    assert warc(pages, least=5).filter("record_type = 'revisit'").count() == 1
    assert warc(pages.limit(0)).count() == 0


def test_url_keys():
    assert safe_key("HTTPS://www.Example.com:80/A/b?c=D#e") == "com,example,www)/a/b?c=d"
    assert safe_key(None) == ")/"
    assert safe_key("http://[bad") == "http://[bad"
