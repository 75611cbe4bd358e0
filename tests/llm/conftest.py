from __future__ import annotations

import random

import pytest


def prose(rng, n, words=400):
    """``n`` words of an invented vocabulary."""
    return " ".join(f"{'abcdefghij'[rng.randrange(10)]}w{rng.randrange(words)}" for _ in range(n))


def hostile_texts():
    """Texts that share, repeat and nearly repeat passages, with empty, odd and long ones among them."""
    rng = random.Random(5)
    base, passage, other = prose(rng, 120), prose(rng, 60), prose(rng, 90)
    edited = base.split(" ")
    edited[40] = "changed"
    more = list(edited)
    more[80:84] = ["quite", "another", "wording", "here"]
    heavy = [w if i % 5 else "x%d" % i for i, w in enumerate(base.split(" "))]
    near = []
    for i in range(12):
        copy = base.split(" ")
        copy[9 * i] = f"edit{i}"
        near.append(" ".join(copy))
    return [
        None, "", " \n\t ", "one", "One two three", "one two three", base, base, base.upper(),
        " ".join(edited), " ".join(more), " ".join(heavy), *near,
        f"{other} {passage} {prose(rng, 30)}", f"{prose(rng, 40)} {passage} {other}",
        f"{passage} {passage}", passage, passage[3:], prose(rng, 20) + "\n" + passage[:250] + "é€" + passage[250:],
        "\n".join(["The same line of the text is here."] * 12), "Of " * 300, "ab" * 700,
        "Ünï" * 120 + passage, passage + "x", "\x00" + passage + "\x00", prose(rng, 6000),
        prose(rng, 3000) + other, f"{other}\n{other}", "a b c d e f g h " * 3,
    ]


@pytest.fixture(scope="session")
def hostile(spark):
    """The texts above as documents whose ids repeat, are null, and whose other columns have the names
    that operators use inside."""
    rows = [(None if i == 8 else 7 if i in (6, 7) else 100 - i, text, i, "x", 1.5, None, "k")
            for i, text in enumerate(hostile_texts())]
    return spark.createDataFrame(
        rows, "doc_id BIGINT, text STRING, row INT, keys STRING, score DOUBLE, data BINARY, n STRING"
    ).repartition(3)


@pytest.fixture(scope="session")
def plain(spark):
    """The same texts with ids of their own."""
    rows = list(enumerate(hostile_texts()))
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING")


@pytest.fixture
def splitting(spark):
    """Settings under which AQE splits hot partitions of small tables and broadcasts nothing."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
