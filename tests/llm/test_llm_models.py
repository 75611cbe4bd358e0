from __future__ import annotations

import hashlib
import os
import random
import re
import time
import zlib

import numpy as np
import pytest

from footfall.llm import personal_data as pii
from footfall.llm import quality_classifier as classifier
from footfall.llm.char_tagger import SYMBOLS, Tagger

SF_DIR = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


def test_scores_are_log_density_differences():
    rng = np.random.default_rng(2)
    d = len(classifier.FEATURES)
    factors = np.array([np.linalg.cholesky(np.eye(d) * 2 + 0.1), np.linalg.cholesky(np.eye(d) + 0.3)])
    means = rng.normal(size=(2, d))
    model = classifier.Discriminant(means, factors, -np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(1), 1.0)
    x = rng.normal(size=(5, d))
    for row, got in zip(x, model.scores(x)):
        logs = []
        for mean, factor in zip(means, factors):
            sigma = factor @ factor.T
            logs.append(-0.5 * np.log(np.linalg.det(sigma)) - 0.5 * (row - mean) @ np.linalg.inv(sigma) @ (row - mean))
        assert abs(got - 1 / (1 + np.exp(logs[0] - logs[1]))) < 1e-9


def test_fit_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, len(classifier.FEATURES)))
    y = np.arange(60) % 2
    rows = [(i, *map(float, row), int(label)) for i, (row, label) in enumerate(zip(x, y))]
    fields = ", ".join(["doc_id BIGINT", *(f"{n} DOUBLE" for n in classifier.FEATURES), "label INT"])
    model = classifier.fit(spark.createDataFrame(rows, fields), "label", shrinkage=0.2)
    for c in (0, 1):
        assert np.allclose(model.means[c], x[y == c].mean(0))
        own = np.cov(x[y == c].T, bias=True)
        pooled = sum(np.cov(x[y == k].T, bias=True) for k in (0, 1)) / 2
        expected = 0.8 * own + 0.2 * np.diag(np.diag(pooled)) + 0.2 * 1e-3 * np.eye(len(own))
        assert np.allclose(model.factors[c] @ model.factors[c].T, expected)


@given
def test_held_out_accuracy_and_folds(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = classifier.quality_classifier(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_classifier_takes_whatever_comes(spark, hostile, no_documents):
    labels = spark.createDataFrame([(100, 1, "x"), (None, 0, "y"), (95, None, "z")],
                                   "doc_id BIGINT, quality INT, score STRING")
    rows = classifier.quality_classifier(hostile, labels).collect()
    assert len(rows) == hostile.count() and {r.score for r in rows} == {0.5}
    assert classifier.quality_classifier(no_documents, labels).count() == 0
    both = spark.createDataFrame([(i, i % 2) for i in range(60, 100)], "doc_id BIGINT, quality INT")
    assert all(0 <= r.score <= 1 for r in classifier.quality_classifier(hostile, both).collect())


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    model = Tagger.fresh(5, size=3, embedding=4)
    ids, gold = rng.integers(0, SYMBOLS, (4, 7)), rng.integers(0, 5, (4, 7))
    for name in ("next", "start"):
        model.weights[name] = rng.normal(size=model.weights[name].shape)
    _, grads = model.gradient(ids, gold)
    for name, weight in model.weights.items():
        for at in [tuple(rng.integers(0, s) for s in weight.shape) for _ in range(3)]:
            held = weight[at]
            weight[at] = held + 1e-5
            above, _ = model.gradient(ids, gold)
            weight[at] = held - 1e-5
            below, _ = model.gradient(ids, gold)
            weight[at] = held
            assert abs((above - below) / 2e-5 - grads[name][at]) < 1e-6


def test_viterbi_finds_the_best_path():
    from itertools import product

    rng = np.random.default_rng(1)
    model = Tagger.fresh(3, size=3, embedding=4)
    for name in ("next", "start"):
        model.weights[name] = rng.normal(size=model.weights[name].shape)
    ids = rng.integers(0, SYMBOLS, (3, 5))
    scores, _ = model.emissions(ids)
    paths, shares = model.decode(ids)
    w = model.weights
    for row in range(3):
        def value(path):
            return (w["start"][path[0]] + sum(scores[row, t, k] for t, k in enumerate(path))
                    + sum(w["next"][a, b] for a, b in zip(path, path[1:])))
        every = list(product(range(3), repeat=5))
        assert tuple(paths[row]) == max(every, key=value)
        weights = np.exp([value(p) for p in every])
        share = sum(x for x, p in zip(weights, every) if p[2] == paths[row, 2]) / weights.sum()
        assert abs(share - shares[row, 2]) < 1e-9


PII_TEXTS = [
    None, "", "no data at all", "write to a.b+c@mail-1.example.co.uk, or x@y", "1.2.3.4 999.1.1.1 1.2.3.4.5 010.0.0.255",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 41111111111111110000", "+1 (273) 555-7228 or +12 34 or + 4",
    "é€ q@w.e 4111111111111111\n" + "z" * 70_000 + " +49 30 1234567", "1" * 3000, "@" * 200 + "a@b.c",
]


def brute_pii(text):
    text = text or ""
    found = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        odd = sum(digits[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in digits[-2::-2])
        if 16 <= len(digits) <= 19 and odd % 10 == 0:
            found.append((2, m.start(), m.end()))
    return found + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                    if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_known_forms_are_those_of_brute_force(spark, hostile, no_documents):
    df = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id BIGINT, text STRING")
    for r in pii.personal_data(df, train_on=0).collect():
        spans = brute_pii(PII_TEXTS[r.doc_id])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans == joined
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in spans) for i in range(4)]
    assert pii.personal_data(hostile, train_on=0).count() == hostile.count()
    assert pii.personal_data(no_documents).count() == 0


def mails(rng, n):
    for i in range(n):
        left, right = ("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(2))
        number = rng.integers(10, 99)
        a, b = f"{left} {right} ", f"{left}.{number}@{right}.example"
        text = f"{a}{b} and {right} 3 or {number}{number}"
        yield text, [(0, len(a), len(a) + len(b))]


def test_base_scan_equals_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(30_000):
        text = "".join(rng.choices(["a", "b@", "@", "1", "25", "256.", ".", "-", "_", "%", " ", "é", "0"],
                                   k=rng.randrange(1, 22)))
        expected = [(0, m.start(), m.end()) for m in pii.EMAIL.finditer(text)] + [
            (1, m.start(), m.end()) for m in pii.IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
        assert [s for s in pii.known_spans(text) if s[0] < 2] == expected


@pytest.mark.parametrize("text, n", [
    ("1" * 10**6, 0), ("a" * 10**6 + "@x", 0), ("1." * 500_000, 125_000), ("0" * 10**6 + ".1.2.3", 1),
    ("a@b.c " * 170_000, 170_000), ("a@" * 500_000, 0), ("+1" + "(" * 10**6, 0)])
def test_base_scan_of_a_megabyte_takes_seconds(text, n):
    began = time.process_time()
    assert len(pii.known_spans(text)) == n
    assert time.process_time() - began < 10


def test_tagger_learns_labelled_spans_and_windows_are_reconciled():
    rng = np.random.default_rng(6)
    model = pii.train(list(mails(rng, 300)), steps=120)
    held = list(mails(rng, 40))
    found = pii.learned_spans(model, [text for text, _ in held])
    assert sum([s[:3] for s in got] == gold for got, (_, gold) in zip(found, held)) >= 36
    long = " word" * 30 + " " + " ".join(text for text, _ in held[:6])
    got = [s[:3] for s in pii.learned_spans(model, [long])[0]]
    assert all(a[2] <= b[1] for a, b in zip(got, got[1:]))
    wanted = {long[s:e] for _, s, e in got}
    assert len(wanted & {t[s:e] for t, [(_, s, e)] in held[:6]}) >= 5
    assert pii.train([("nothing 1 here", [])]) is None


def test_windows_cover_every_sign():
    for text in filter(None, PII_TEXTS):
        covered = {i for a, b in pii.windows(text) for i in range(a, b)}
        assert all(b - a <= pii.WINDOW for a, b in pii.windows(text))
        assert {m.start() for m in re.finditer("[0-9@]", text)} <= covered


def test_masking():
    assert pii.mask("é a@b.c, 1.2.3.4!", [(0, 2, 7), (1, 9, 16)]) == "é <EMAIL>, <IP>!"
    assert pii.mask("abc", []) == "abc"
    assert pii.mask("0123456789", [(2, 2, 6), (3, 4, 8)]) == "01<CARD>89"
