"""Language model scores, fill-in-middle and token alignment."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import lm_scoring as lm
from footfall.llm.common import stage
from footfall.llm.fill_in_middle import (
    ExceptionIndex, digests, fill_in_middle, restored, transform, unit_starts,
)
from footfall.llm.frequent import frequent
from footfall.llm.hidden_markov import Chunks, Counts, HiddenMarkov
from footfall.llm.queries import BYTE_LEVEL, PIECES
from footfall.llm.token_alignment import TwoEncoders, align, gallop, pair_counts, aligned, token_alignment
from pyspark.sql import functions as F


# --- hidden Markov model ------------------------------------------------------------------------

def paths(model, codes):
    """Every state path with the probability of path and symbols."""
    for path in itertools.product(range(len(model.start)), repeat=len(codes)):
        p = model.start[path[0]] * model.emit[codes[0], path[0]]
        for j, k, code in zip(path, path[1:], codes[1:]):
            p *= model.follow[j, k] * model.emit[code, k]
        yield path, p


@pytest.fixture(scope="module")
def small_model():
    rng = np.random.default_rng(0)
    model = HiddenMarkov.fresh(rng.dirichlet(np.ones(6)), 3)
    model.follow = rng.dirichlet(np.ones(3), 3)
    model.start = rng.dirichlet(np.ones(3))
    sequences = [rng.integers(0, 6, n).astype(np.uint16) for n in (1, 5, 3, 7, 2, 6, 4, 1, 7)]
    return model, sequences


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_likelihoods_and_counts_are_those_of_all_paths(small_model, size):
    model, sequences = small_model
    expected = Counts(np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3)))
    for codes, log in zip(sequences, model.log_likelihoods(sequences, size)):
        found = list(paths(model, codes))
        total = sum(p for _, p in found)
        assert math.isclose(log, math.log(total), rel_tol=1e-12)
        for path, p in found:
            expected.start[path[0]] += p / total
            for j, k in zip(path, path[1:]):
                expected.follow[j, k] += p / total
            for code, k in zip(codes, path):
                expected.emit[code, k] += p / total
    counts = model.expected_counts(sequences, size)
    for got, wanted in zip((counts.start, counts.follow, counts.emit), (expected.start, expected.follow, expected.emit)):
        assert np.allclose(got, wanted, atol=1e-10)


def test_long_sequences_neither_vanish_nor_depend_on_the_cut():
    rng = np.random.default_rng(3)
    model = HiddenMarkov.fresh(rng.dirichlet(np.full(500, 0.1)), 4)
    codes = [rng.integers(0, 500, 30_000).astype(np.uint16), rng.integers(0, 500, 3).astype(np.uint16)]
    one, other = model.log_likelihoods(codes, 1 << 20), model.log_likelihoods(codes, 512)
    assert np.isfinite(one).all() and np.allclose(one, other, rtol=1e-10)
    a, b = model.expected_counts(codes, 1 << 20), model.expected_counts(codes, 512)
    assert np.allclose(a.emit, b.emit, atol=1e-6) and np.allclose(a.follow, b.follow, atol=1e-6)
    assert math.isclose(a.emit.sum(), 30_003, rel_tol=1e-9)


def test_chunks_cover_every_symbol_once():
    sequences = [np.arange(n, dtype=np.uint16) for n in (5, 1, 9, 4)]
    chunks = Chunks.of(sequences, 4)
    assert [chunks.codes[s:s + n].tolist() for s, n in zip(chunks.start, chunks.length)] == [
        [0, 1, 2, 3], [4], [0], [0, 1, 2, 3], [4, 5, 6, 7], [8], [0, 1, 2, 3]]
    rows = np.concatenate(list(chunks.slabs(np.arange(7), 8)))
    assert sorted(rows.tolist()) == list(range(7))


def objective(model, share, sequences, prior=1.0):
    return (model.log_likelihoods(sequences).sum() + prior * (np.log(model.start).sum() + np.log(model.follow).sum())
            + prior * (share[:, None] * np.log(model.emit)).sum())


def test_every_round_raises_what_it_maximises():
    rng = np.random.default_rng(5)
    topics = rng.dirichlet(np.full(40, 0.2), 3)
    sequences = [rng.choice(40, 50, p=topics[i % 3]).astype(np.uint16) for i in range(60)]
    share = np.bincount(np.concatenate(sequences), minlength=40) + 0.5
    share = share / share.sum()
    model = HiddenMarkov.fresh(share, 3)
    before = objective(model, share, sequences)
    for _ in range(6):
        model = model.next(model.expected_counts(sequences), share)
        after = objective(model, share, sequences)
        assert after > before - 1e-9
        before = after
    assert model.log_likelihoods(sequences).sum() > sum(np.log(share[s]).sum() for s in sequences) + 100


def test_rare_symbols_neither_vanish_nor_overflow():
    """Symbols of 1e-30 in a row, in states that hardly follow one another, against a rescaling at every step."""
    follow = np.array([[1 - 2e-12, 1e-12, 1e-12], [1e-12, 1 - 2e-12, 1e-12], [0.3, 0.3, 0.4]])
    emit = np.array([[1e-30, 1e-30, 1e-30], [0.5, 1e-30, 1e-30], [1e-30, 0.5, 1e-30], [0.5, 0.5, 1.0]])
    model = HiddenMarkov(np.full(3, 1 / 3), follow, emit)
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 4, n).astype(np.uint16) for n in (1, 7, 8, 9, 16, 17, 400)]
    sequences += [np.repeat([0, 1, 2, 0], 60).astype(np.uint16), np.zeros(200, np.uint16)]
    start, pairs, used = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for codes, log in zip(sequences, model.log_likelihoods(sequences)):
        alphas, total = [], 0.0
        for t, code in enumerate(codes):
            alpha = (alphas[-1] @ follow if t else model.start) * emit[code]
            total += math.log(alpha.sum())
            alphas.append(alpha / alpha.sum())
        assert math.isclose(log, total, rel_tol=1e-12)
        beta = np.ones(3)
        for t in range(len(codes) - 1, -1, -1):
            both = alphas[t] * beta / (alphas[t] * beta).sum()
            used[codes[t]] += both
            if t:
                ahead = emit[codes[t]] * beta
                pair = alphas[t - 1][:, None] * follow * ahead
                pairs += pair / pair.sum()
                beta = follow @ ahead / (follow @ ahead).sum()
        start += both
    counts = model.expected_counts(sequences)
    for got, wanted in zip((counts.start, counts.follow, counts.emit), (start, pairs, used)):
        assert np.allclose(got, wanted, rtol=1e-9, atol=1e-9)


# --- words of documents -------------------------------------------------------------------------

ODD_BYTES = [b"", b" ", b"a", b" a", b"a ", b"\t\n\v\f\r ", b" A\x0bZ\x0c[ ", b"\x1c\x1d\x1e\x1f \x85\xa0", b"\x00 \x00",
             "Ünï İ \u00a0\u2003x\u3000 ẞ".encode(), b"\xff\xfe B\xc3 \x80", b"aB1-\n\nC", b"x" * 5000, b"q " * 3000]


@pytest.mark.parametrize("size", [1, 7, 4000, 1 << 20])
def test_words_are_those_of_plain_python(size):
    rng = random.Random(size)
    texts = [*ODD_BYTES, None, *(bytes(rng.choice(b" \t\nAaZz09.\x1f\xc3\xa9") for _ in range(rng.randrange(30)))
                                 for _ in range(200))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], names=["i", "t"])
    ids, got = [], []
    for piece in lm.pieces([batch.slice(0, 9), batch.slice(9, 0), batch.slice(9)], size):
        assert 0 < piece.num_rows and (piece.num_rows == 1 or sum(map(len, piece.column(1).to_pylist())) <= size)
        words, number = lm.words_of(piece.column(1))
        ids += piece.column(0).to_pylist()
        assert lm.shapes(words).tolist() == [lm.shape(word) for word in words.to_pylist()]
        ends = np.cumsum(number)
        got += [words.to_pylist()[end - n:end] for end, n in zip(ends, number)]
    assert ids == list(range(len(texts)))
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", (text or b"").lower()) for text in texts]


@pytest.mark.parametrize("pool_bytes", [1, 500, lm.POOL_BYTES])
def test_words_are_counted_whatever_the_pool_holds(hostile, pool_bytes):
    expected = Counter()
    for r in hostile.collect():
        if not lm.is_held_out(r.doc_id):
            expected.update(re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower()))
            expected[lm.END] += 1
    got = lm.word_counts(hostile.select("doc_id", "text"), pool_bytes).collect()
    assert sorted((bytes(r.word), r["shape"], r.n) for r in got) == sorted(
        (word, lm.shape(word) if word else lm.SHAPES, n) for word, n in expected.items())


def test_encoding_costs_no_more_than_looking_every_word_up():
    """Per word, encoding takes less than a search in a dictionary; word by word it took 1.6 times as long."""
    rng = np.random.default_rng(8)
    words = [b"%xw" % int(i) for i in rng.integers(0, 1 << 40, 300_000)]
    known = words[:262_144]
    counts = {lm.END: 9} | {word: 9 for word in known}
    lexicon = lm.Lexicon(10_000_000, 300_001, {lm.END: lm.SHAPES}, counts, 7.0, np.full(lm.SHAPES, 5.0), np.ones(1))
    texts = [b" ".join(words[i] for i in rng.integers(0, len(words), 500)) for _ in range(2000)]
    encoder, numbers, column = lm.Encoder(lexicon), {word: i for i, word in enumerate(known)}, pa.array(texts)

    def seconds(run):
        began = time.process_time()
        run()
        return time.process_time() - began

    def look_up():
        return [np.fromiter(map(numbers.get, text.lower().split(), itertools.repeat(-1)), np.int32) for text in texts]

    look_up()
    assert min(seconds(lambda: encoder.encode(column)) for _ in range(3)) < min(seconds(look_up) for _ in range(3))


# --- scores of documents ------------------------------------------------------------------------

def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), b""]


def base_scores(rows):
    counts = Counter()
    for doc_id, text in rows:
        if zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % 5 != 1:
            counts.update(tokens(text))
    n, v = counts.total(), len(counts)
    for doc_id, text in rows:
        words = tokens(text)
        yield (doc_id, zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % 5 == 1, len(words),
               sum(counts[w] > 0 for w in words), n,
               round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), 6))


def comparable(rows):
    return sorted(((r[0], *r[1:5], round(r[5], 6)) for r in rows), key=repr)


@pytest.mark.parametrize("own, known", [(16_384, 262_144), (20, 60), (0, 0)])
def test_base_scores_whatever_is_known_to_tasks(hostile, own, known):
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    got = lm.lm_scoring(hostile, 3, 2, own_symbols=own, known_words=known).collect()
    assert comparable(got) == sorted(base_scores(rows), key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_are_the_models(spark, hostile):
    """The score of a text is that of its symbols, and each word its share among those of its shape."""
    narrow = hostile.select("doc_id", "text").sort(F.length("text").desc_nulls_last()).limit(30)
    narrow = spark.createDataFrame(narrow.collect(), narrow.schema).coalesce(2)
    got = lm.lm_scoring(narrow, 3, 2, own_symbols=15, known_words=40).collect()
    counts = stage(lm.word_counts(narrow), "counts")
    lexicon = lm.Lexicon.of(counts, 15, 40)
    assert len(lexicon.symbols) <= 16 and len(lexicon.counts) <= 41
    model = lm.train(lm.encoded(narrow, lexicon), lexicon, 3, 2)
    for part in (model.start, *model.follow, *model.emit.T):
        assert math.isclose(part.sum(), 1, rel_tol=1e-9)
    every = {r.word: r.n for r in counts.collect()}
    used, words = Counter(), Counter()
    for word, n in every.items():
        if bytes(word) not in lexicon.symbols:
            used[lm.shape(word)] += n
            words[lm.shape(word)] += 1
    expected = []
    for r in narrow.collect():
        codes, inner = [], 0.0
        for word in tokens(r.text):
            code = lexicon.symbols.get(word)
            codes.append(lm.shape(word) if code is None else code)
            if code is None:
                s = lm.shape(word)
                inner += math.log10((every.get(word, 0) + 0.5) / (used[s] + 0.5 * (words[s] + 1)))
        alpha, log = model.start, 0.0
        for t, code in enumerate(codes):
            alpha = (alpha @ model.follow if t else alpha) * model.emit[code]
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        expected.append((repr(r.doc_id), round(log + inner, 5)))
    assert sorted((repr(r.doc_id), round(r.score, 5)) for r in got) == sorted(expected)


def test_the_model_beats_the_base_on_held_out_texts(spark):
    """Texts in two made-up languages: which one a text is in tells the model what to expect."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        language = "ab"[i % 2]
        rows.append((i, " ".join(f"{language}{int(rng.expovariate(0.05))}" for _ in range(60))))
    got = lm.lm_scoring(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4), 2, 8).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 30 and sum(r.score > r.base_score for r in held) > 0.95 * len(held)


def test_scoring_takes_whatever_comes(spark, hostile, no_documents):
    assert lm.lm_scoring(no_documents).count() == 0
    held = [i for i in range(40) if lm.is_held_out(i)]
    alone = spark.createDataFrame([(held[0], "a b"), (held[1], None)], "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in lm.lm_scoring(alone, 2, 1).collect()}
    assert [(r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in (got[held[0]], got[held[1]])] == [
        (3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    long = spark.createDataFrame([(1, "word other " * 120_000), (2, "x" * 1_000_000), (3, "")], "doc_id BIGINT, text STRING")
    assert sorted((r.doc_id, r.n_tokens) for r in lm.lm_scoring(long, 2, 1).collect()) == [(1, 240_001), (2, 2), (3, 1)]


def test_frequent_keys_are_whole_classes(spark):
    rng = random.Random(1)
    counts = spark.createDataFrame([(i, int(rng.paretovariate(0.7))) for i in range(3000)], "k INT, n BIGINT")
    every = sorted((r.n for r in counts.collect()), reverse=True)
    for most in (0, 1, 50, 700, 3000, 9000):
        found = frequent(counts, "n", most)["n"].to_pylist()
        assert len(found) <= most and sorted(found, reverse=True) == every[:len(found)]
        assert len(found) == len(every) or not found or every[len(found)] < min(found)
    assert len(frequent(counts, "n", 9000)) == 3000


# --- fill-in-middle -----------------------------------------------------------------------------

PIECES_OF_TEXT = ["a", "Zz", " ", "\n", "é", "日本", "😀", "́", "<P", ">", "1", "<", "\x00", "ß", "\U0010ffff"]


def odd_texts(n=400, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES_OF_TEXT, k=rng.randrange(1, 30))) for _ in range(n)]


def test_exceptions_tell_bytes_from_code_points():
    for text in ["", "abc", *odd_texts()]:
        index = ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
        chars = np.arange(len(text) + 1)
        cuts = np.array([len(text[:i].encode()) for i in chars])
        assert index.to_bytes(chars).tolist() == cuts.tolist()
        assert index.to_chars(cuts).tolist() == chars.tolist()
    assert len(ExceptionIndex(np.frombuffer(b"plain text" * 1000, np.uint8)).bytes) == 0


def brute_form(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_forms_are_those_of_brute_force(spark, hostile, no_documents):
    texts = [*odd_texts(), "a<P>b", "<M>", "<S", "", None, "😀", "x" * 300_000 + "é" * 300_000 + " y" * 200_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING").repartition(5)
    for frame in (docs, hostile):
        made = fill_in_middle(frame)
        rows = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
        given = [(r.doc_id, r.text) for r in frame.collect()]
        expected = Counter((d, *brute_form(d, t), t or "") for d, t in given)
        assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in rows) == expected
        for r in rows:
            if r.form != "plain":
                text = r.back.encode()
                assert len(text[:r.prefix_bytes].decode()) == r.prefix_chars
                assert len(text[r.prefix_bytes:r.prefix_bytes + r.middle_bytes].decode()) == r.middle_chars
    assert {r.form for r in fill_in_middle(docs).collect()} == {"plain", "psm", "spm"}
    assert fill_in_middle(no_documents).count() == 0 == digests(no_documents).count()


def test_units_begin_where_the_pattern_says():
    for text in odd_texts(200, 5):
        starts = unit_starts(np.frombuffer(text.encode(), np.uint8)).tolist()
        assert starts == [len(text[:m.start()].encode()) for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text, re.S)]
    assert transform(b"", (1, 2, 3, 4)) == (0, "plain", None, None, None, None, b"")


# --- token alignment ----------------------------------------------------------------------------

ODD = ["a  b", "  a", " a b ", "a b c", "x́ ́y", "<s> </s> <unk> <|endoftext|> a", "▁a ▁", "a\tb c\n d",
       "日本語 テキスト", "it's 's don't ' s", "a\x1cb c", "é ﬁ ½", "\x00 a", "😀 😀😀", "<0x41> b", " ", "　 x", "", None]


def brute_alignment(texts):
    """Tokens, groups, links and corpus-wide counts from the pair of tokens that each byte belongs to."""
    encoders = TwoEncoders.of(BYTE_LEVEL, PIECES)
    rows, links, counts = [], [], Counter()
    for text in texts:
        a = encoders.a.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = encoders.b.encode(text) if text else []
        whole = f" {text}".encode()
        linked, groups = [], []
        if text and b"".join(encoders.bytes_a[i] for i in a) == whole == b"".join(encoders.bytes_b[i] for i in b):
            of_byte = [[k for k, i in enumerate(ids) for _ in table[i]]
                       for ids, table in ((a, encoders.bytes_a), (b, encoders.bytes_b))]
            linked = [(a[i], b[j]) for i, j in dict.fromkeys(zip(*of_byte))]
            i = j = 0
            for k, (x, y) in enumerate(zip(*of_byte)):
                if k + 1 == len(whole) or of_byte[0][k + 1] != x and of_byte[1][k + 1] != y:
                    groups.append("|".join(",".join(map(str, ids)) for ids in (a[i:x + 1], b[j:y + 1])))
                    i, j = x + 1, y + 1
        else:
            a = b = []
        rows.append((len(a), len(b), len(groups), len(linked), ";".join(groups)))
        links.append(linked)
        counts.update(linked)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for (n_a, n_b, n_groups, n_links, groups), linked in zip(rows, links):
        yield (n_a, n_b, n_groups, n_links, sum(counts[p] == best[p[1]] for p in linked), sum(counts[p] for p in linked),
               hashlib.sha256(groups.encode()).hexdigest() if groups else "", groups)


def test_galloping_finds_the_first_end_not_before():
    rng = random.Random(3)
    for _ in range(300):
        top = rng.randrange(1, 200)
        short, long = (sorted({*rng.sample(range(1, top + 1), rng.randrange(0, top)), top}) for _ in range(2))
        assert gallop(short, long) == [sum(x < end for x in long) for end in short]
        last_a, last_b, link_a, link_b = align(np.array(short), np.array(long))
        assert [short[i] for i in last_a] == [long[j] for j in last_b] == sorted({*short} & {*long})
        spans = [list(zip([0, *ends], ends)) for ends in (short, long)]
        assert sorted(zip(link_a.tolist(), link_b.tolist())) == [
            (i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, u) in enumerate(spans[1]) if t < e and s < u]


def test_ids_of_parts_are_those_of_whole_texts(plain):
    encoders = TwoEncoders(BYTE_LEVEL, PIECES)
    assert encoders.by_part
    rng = random.Random(1)
    texts = [t for t in ODD if t] + [r.text for r in plain.collect() if r.text]
    texts += ["".join(rng.choices("ab 's.,!0\n\t ▁é😀  ́", k=rng.randrange(1, 30))) for _ in range(3000)]
    fits = 0
    for text, got in zip(texts, encoders.texts(texts, 2000)):
        a, b = encoders.a.encode(f" {text}", add_special_tokens=False).ids, encoders.b.encode(text)
        same = (b"".join(encoders.bytes_a[i] for i in a) == f" {text}".encode()
                == b"".join(encoders.bytes_b[i] for i in b))
        fits += same
        assert (got is not None) == same
        assert not same or (got[0].tolist(), got[1].tolist()) == (a, b)
    assert 500 < fits
    encoders.by_part = False
    assert [None if g is None else g[0].tolist() for g in encoders.texts(texts[:50])] == [
        None if g is None else g[0].tolist() for g in TwoEncoders.of(BYTE_LEVEL, PIECES).texts(texts[:50])]


@pytest.mark.parametrize("known", [262_144, 100, 0])
def test_alignment_is_that_of_brute_force(spark, hostile, known):
    texts = [r.text for r in hostile.collect()] + ODD
    rows = [(None if i % 9 == 0 else i // 2, t, "x", 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, pairs STRING, n INT").repartition(3)
    got = token_alignment(docs, BYTE_LEVEL, PIECES, known, with_groups=True).collect()
    assert Counter(map(tuple, got)) == Counter((r[0], *e) for r, e in zip(rows, brute_alignment(texts)))


def test_alignment_takes_whatever_comes(spark, no_documents):
    assert token_alignment(no_documents, BYTE_LEVEL, PIECES).count() == 0
    long = spark.createDataFrame([(1, "1" * 200_000), (2, "a b" * 150_000), (3, "é" * 100_000)], "doc_id BIGINT, text STRING")
    begin = time.time()
    rows = token_alignment(long, BYTE_LEVEL, PIECES).collect()
    assert {r.doc_id: r.n_links == r.n_a + r.n_b - r.n_groups for r in rows} == {1: True, 2: True, 3: True}
    assert time.time() - begin < 120


def test_pair_counts_add_up(spark, plain):
    texts = aligned(plain, BYTE_LEVEL, PIECES)
    one = {r.pair: (r.n, r.best) for r in pair_counts(texts).collect()}
    assert one == {r.pair: (r.n, r.best) for r in pair_counts(texts, most=50).collect()}
    assert sum(n for n, _ in one.values()) == sum(r.n_links for r in texts.collect())
