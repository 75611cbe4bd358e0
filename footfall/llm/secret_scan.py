"""Secrets: known patterns, and a battery of randomness tests on other long tokens."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import named, stage

# The patterns of the known kinds, in the order of their rank.
ASSIGN = (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"(AKIA[A-Z0-9]{16,})"
HEX = r"((?<![0-9a-f])[0-9a-f]{24,})"
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"((?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2})"
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters from the frequent to the rare ones, so that words stay in the first half of an alphabet.
COMMON_FIRST = "etaoinsrhldcumgpfbwvkyzxjq"
#: Encoding: what its tokens match, its alphabet, and a first picture of ordinary tokens written with these
#: characters: the sum of squared character shares, the share of steps between the halves of the alphabet,
#: and the correlation of neighbours about the alphabet's middle. z is measured against this picture; what
#: ordinary tokens of a corpus really show is learnt from all its candidates (``ordinary_z``).
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])(?:[0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef", 0.1, 0.35, 0.3),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", COMMON_FIRST.upper() + "234567", 0.07, 0.3, 0.6),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", COMMON_FIRST + DIGITS, 0.07, 0.3, 0.6),
    ("base64", r"[+/_-]|[0-9].*[A-Za-z]|[A-Za-z].*[0-9]", LOWER + "+/" + DIGITS + UPPER, 0.05, 0.15, 0.8),
    ("figures", r"^[0-9]+=*$", DIGITS, 0.18, 0.35, 0.3),
    ("small letters", r"^[a-z]+=*$", COMMON_FIRST, 0.075, 0.35, 0.3),
    ("capitals", r"^[A-Z]+=*$", COMMON_FIRST.upper(), 0.075, 0.35, 0.3),
    ("letters", r"", COMMON_FIRST + COMMON_FIRST[::-1].upper(), 0.065, 0.15, 0.8),
)
LENGTH_CLASSES = (16, 24, 40, 64)
BINS_PER_UNIT, LEAST_Z, MOST_Z = 20, -40, 10
#: The first picture counts as so many tokens of an encoding and length class; the least spread; rounds of the
#: fit; longer tokens count as so long there.
PICTURED, LEAST_SPREAD, ROUNDS, LONGEST = 20, 0.5, 100, 1024
SPAN = "array<struct<start:bigint,rank:int,end:bigint,token:string>>"


def spans(text: Column, pattern: str, rank: int, value_group: int = 0, least: int = 0) -> Column:
    """Non-overlapping matches from the left as spans in code points, as built-in functions.

    The pieces between the matches, from ``split``, give the positions: lengths are summed by blocks of
    as many matches as there are blocks, then within each block, so the work grows as n to the power
    1.5. Group ``value_group`` has to have ``least`` characters.
    """
    def total(lengths: Column) -> Column:
        return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x["gap"] + x["own"])

    def found(pieces: Column, matches: Column, values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(matches))).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), ((F.size(matches) - 1) / width).cast("int")),
            lambda b: F.transform(F.sequence(b * width, F.least((b + 1) * width, F.size(matches)) - 1), lambda i: F.struct(
                F.length(F.get(pieces, i)).alias("gap"), F.length(F.get(matches, i)).alias("own"),
                F.get(values, i).alias("token"))))

        def placed(block: Column, at: Column) -> Column:
            def span(x: Column, i: Column) -> Column:
                begin = at + total(F.slice(block, 1, i)) + x["gap"]
                return F.struct(begin.alias("start"), F.lit(rank).alias("rank"),
                                (begin + x["own"]).alias("end"), x["token"].alias("token"))

            return F.transform(block, span)

        def all_placed(blocks: Column) -> Column:
            return named(F.transform(blocks, total), lambda sums: F.flatten(F.transform(
                blocks, lambda block, b: placed(block, F.aggregate(
                    F.slice(sums, 1, b), F.lit(0).cast("bigint"), lambda a, x: a + x)))))

        return F.filter(named(blocks, all_placed), lambda s: F.length(s["token"]) >= least).cast(SPAN)

    parts = F.struct(F.split(text, pattern, -1).alias("p"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("v"))
    return F.when(text.rlike(pattern), named(parts, lambda x: found(x["p"], x["m"], x["v"]))
                  ).otherwise(F.array().cast(SPAN))


def clear_of(candidates: Column, found: Column, length: Column) -> Column:
    """The candidates that no span of ``found`` touches, in a text of ``length`` characters.

    The text is cut into as many blocks as the root of the number of spans found, and a candidate is
    held against the spans of its own blocks.
    """
    def touches(span: Column, start: Column, end: Column) -> Column:
        return (span["start"] < end) & (start < span["end"])

    def clear(state: Column) -> Column:
        width, near = state["width"], state["near"]

        def block(at: Column) -> Column:
            return F.floor(at / width).cast("int")

        return F.filter(state["candidates"], lambda s: ~F.exists(
            F.slice(near, block(s["start"]) + 1, block(s["end"] - 1) - block(s["start"]) + 1),
            lambda some: F.exists(some, lambda k: touches(k, s["start"], s["end"]))))

    def by_block(state: Column) -> Column:
        found, number, width = state["found"], state["number"], state["width"]
        near = F.transform(F.sequence(F.lit(0), number - 1), lambda b: F.filter(
            found, lambda k: touches(k, b * width, (b + 1) * width)))
        return F.struct(width.alias("width"), near.alias("near"), state["candidates"].alias("candidates"))

    def sized(state: Column) -> Column:
        number = F.greatest(F.ceil(F.sqrt(F.size(state["found"]))).cast("int"), F.lit(1))
        return F.struct(state["found"].alias("found"), state["candidates"].alias("candidates"), number.alias("number"),
                        (F.floor(state["length"] / number).cast("bigint") + 1).alias("width"))

    # Every step is bound once: within a function of an array Spark computes what it is given anew.
    given = F.struct(found.alias("found"), candidates.alias("candidates"), length.alias("length"))
    return named(named(named(given, sized), by_block), clear)


def battery(token: Column) -> Column:
    """z of a token against the first picture of ordinary text: the lower, the more random.

    Chi-squared distance from a uniform use of the alphabet, changes between the halves of the
    alphabet (runs) and lag-one correlation, each as a normal deviate of what that picture says of
    tokens of that length, added by Stouffer's rule.
    """
    bare = F.rtrim(token, F.lit("="))
    folded = F.when(token.rlike(r"^(?=.*[0-9])[0-9A-F]+$"), F.lower(bare)).otherwise(F.translate(bare, "-_", "+/"))

    def of(alphabet: str, squares: float, ordinary_changes: float, ordinary_tie: float) -> Column:
        k = len(alphabet)
        codes = F.transform(F.split(folded, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
        middle, spread, excess = (k - 1) / 2, (k * k - 1) / 12, k * squares - 1

        def tests(x: Column) -> Column:
            n = F.size(x).cast("double")
            squared = F.aggregate(
                F.array_distinct(x), F.lit(0.0),
                lambda a, c: a + F.pow(F.size(F.filter(x, lambda y: y == c)).cast("double"), F.lit(2.0)))
            pairs = F.slice(F.transform(x, lambda c, i: F.struct(
                c.alias("a"), F.get(x, i + 1).alias("b"))), 1, F.size(x) - 1)
            changes = F.size(F.filter(pairs, lambda p: (p["a"] > middle) != (p["b"] > middle)))
            product = F.aggregate(pairs, F.lit(0.0),
                                  lambda a, p: a + (p["a"] - middle) * (p["b"] - middle))
            chi = k * squared / n - n
            chi_z = (chi - (k - 1) - n * excess) / F.sqrt(2 * (k - 1) + 4 * n * excess)
            runs_z = -(changes - ordinary_changes * (n - 1)) / F.sqrt(
                ordinary_changes * (1 - ordinary_changes) * (n - 1))
            serial_z = (product / ((n - 1) * spread) - ordinary_tie) * F.sqrt(n - 1)
            return (chi_z + runs_z + serial_z) / math.sqrt(3)

        return named(codes, tests)

    result = None
    for _, shape, *parameters in reversed(ENCODINGS):
        value = of(*parameters)
        result = value if result is None else F.when(token.rlike(shape), value).otherwise(result)
    return result


def encoding(token: Column) -> Column:
    """The place in ``ENCODINGS`` of the encoding that a token looks like."""
    result = None
    for i, (_, shape, *_) in reversed(list(enumerate(ENCODINGS))):
        result = F.lit(i) if result is None else F.when(token.rlike(shape), i).otherwise(result)
    return result


def uniform_z(place: int, n: float) -> tuple[float, float]:
    """Mean and spread of z for tokens of ``n`` characters drawn evenly from an encoding's alphabet."""
    _, _, alphabet, squares, often, tie = ENCODINGS[place]
    k = len(alphabet)
    excess, step = k * squares - 1, math.sqrt(often * (1 - often))
    scale = math.sqrt(2 * (k - 1) + 4 * n * excess)
    mean = -n * excess / scale - ((0.5 - often) / step + tie) * math.sqrt(n - 1)
    # changes and correlation of neighbours go together, the use of the alphabet with neither
    together = 3 * k * k / (4 * (k * k - 1))
    variance = 2 * (k - 1) * (n - 1) / n / scale ** 2 + 0.25 / step ** 2 + 1 + together / step
    return mean / math.sqrt(3), math.sqrt(variance / 3)


def below(z: float) -> float:
    """The standard normal distribution below ``z``."""
    return math.erfc(-z / math.sqrt(2)) / 2


def ordinary_z(z: np.ndarray, n: np.ndarray, random: tuple[float, float]) -> tuple[float, float, float]:
    """Median, spread below it and number of the ordinary tokens among ``n`` of each ``z``.

    The tokens are a mixture of even ones, whose z is known (``random``), and ordinary ones, whose z is
    learnt: normal on each side of its median. So random tokens do not count as ordinary, be they few
    or nearly all. The first picture takes part as ``PICTURED`` tokens, in the end only as far as there
    are fewer ordinary ones.
    """
    first = np.linspace(-2.4, 2.4, 9)
    pictured = np.exp(-first ** 2 / 2)
    pictured *= PICTURED / pictured.sum()
    at = np.concatenate([z, first])
    order = np.argsort(at, kind="stable")
    even = np.exp(-(np.maximum(z - random[0], 0) / random[1]) ** 2 / 2) / random[1]
    ordinary = np.where(z > random[0] + 2 * random[1], 1.0, 0.5)
    for i in range(ROUNDS):
        lacking = 1.0 if 2 * i < ROUNDS else max(0.0, 1 - (n * ordinary).sum() / PICTURED)
        weight = np.concatenate([n * ordinary, pictured * lacking])
        reached = np.cumsum(weight[order])
        center = at[order][np.searchsorted(reached, reached[-1] / 2)]
        center = max(center, random[0] + random[1])
        low, high = (max(LEAST_SPREAD, math.sqrt(
            (weight[side] * (at[side] - center) ** 2).sum() / max(weight[side].sum(), 1e-9)))
            for side in (at <= center, at >= center))
        share = min(1.0, ((n * ordinary).sum() + 1) / (n.sum() + 1))
        width = np.where(z < center, low, high)
        density = share * np.exp(-((z - center) / width) ** 2 / 2) * 2 / (low + high) + 1e-300
        ordinary = density / (density + (1 - share) * even)
    return float(center), float(low), min(float(n.sum()), float((n * ordinary).sum()) + 1)


def length_class(token: Column) -> Column:
    return sum((F.when(F.length(token) >= n, 1).otherwise(0) for n in LENGTH_CLASSES), F.lit(0))


def z_bin(z: Column) -> Column:
    return F.ceil(F.greatest(F.lit(float(LEAST_Z)), F.least(F.lit(float(MOST_Z)), z))
                  * BINS_PER_UNIT).cast("int")


def discovery_limits(candidates: DataFrame, rate: float) -> dict[int, int]:
    """The largest bin of z that the step-up rule for false discoveries accepts, per group of candidates
    (length class and encoding).

    Only counts per group and bin meet, and at most a thousand of them a group reach the driver, whatever
    the corpus.
    """
    length = F.least("n", F.lit(LONGEST)).cast("double")
    counts = candidates.groupBy("group", "bin").agg(
        F.count(F.lit(1)).alias("tokens"), F.sum(length).alias("length"),
        F.sum(length * length).alias("square")).collect()
    limits = {}
    for group in {row["group"] for row in counts}:
        rows = sorted((row for row in counts if row["group"] == group), key=lambda row: row["bin"])
        bins, n = np.array([r["bin"] for r in rows]), np.array([float(r["tokens"]) for r in rows])
        mean = sum(r["length"] for r in rows) / n.sum()
        spread = math.sqrt(max(0.0, sum(r["square"] for r in rows) / n.sum() - mean * mean))
        place = group % len(ENCODINGS)
        (center, width), (short, _), (long, _) = (
            uniform_z(place, m) for m in (mean, max(LENGTH_CLASSES[0], mean - spread), mean + spread))
        edges = bins / BINS_PER_UNIT
        middle, low, ordinary = ordinary_z(
            edges - 0.5 / BINS_PER_UNIT, n, (center, math.hypot(width, (short - long) / 2)))
        for z, limit, found in zip(edges, bins, np.cumsum(n)):
            if ordinary * below((z - middle) / low) <= rate * found:
                limits[group] = int(limit)
    return limits


def joined(found: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(documents: DataFrame, rate: float = 0.01, text: str = "text") -> DataFrame:
    """Spans of secrets, one row per row of ``documents``, without user functions.

    Known kinds come from their patterns. Every other token of 16 or more letters, figures and
    ``+/_-``, words and plain numbers included, is tested for randomness within the encoding it looks
    like, against what the ordinary candidates of the table with that encoding and length class
    show; at most ``rate`` of those accepted in a length class are expected to be ordinary.
    They are reported as ``random`` where they touch no known span. A null text is empty. Repeated
    rows and null ids each give their own row; an empty table gives none; further columns are
    ignored. The text is read once; what the scan found is staged.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    known = F.concat(spans(F.col("t"), ASSIGN, 0, 2, 6), spans(F.col("t"), ACCESS, 1),
                     spans(F.col("t"), HEX, 2))

    def other(found: Column) -> Column:
        free = clear_of(spans(F.col("t"), TOKEN, 3), found, F.length("t"))
        return F.transform(free, lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
            (length_class(s["token"]) * len(ENCODINGS) + encoding(s["token"])).alias("group"),
            z_bin(battery(s["token"])).alias("bin")))

    def bare(found: Column) -> Column:
        return F.transform(found, lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))

    scanned = stage(
        documents.select("doc_id", value.alias("t")).select("doc_id", "t", known.alias("known"))
        .select("doc_id", bare(F.col("known")).alias("known"), other(F.col("known")).alias("other")),
        "secrets")
    limits = discovery_limits(
        scanned.select(F.explode("other").alias("c")).select(
            "c.group", "c.bin", (F.col("c.end") - F.col("c.start")).alias("n")), rate)
    accepted = F.lit(False)
    if limits:
        table = F.create_map(*[F.lit(x) for item in sorted(limits.items()) for x in item])
        extra = F.filter("other", lambda c: c["bin"] <= F.coalesce(
            F.try_element_at(table, c["group"]), F.lit(LEAST_Z * BINS_PER_UNIT - 1)))
    else:
        extra = F.filter("other", lambda c: accepted)

    def count(rank: int) -> Column:
        return F.size(F.filter("known", lambda s: s["rank"] == rank)).cast("bigint")

    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.size(extra).cast("bigint").alias("n_random"),
        F.sha2(joined(F.col("known")), 256).alias("base_sha256"),
        joined(F.concat(F.col("known"), bare(extra))).alias("spans"))
