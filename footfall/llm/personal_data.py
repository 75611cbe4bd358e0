"""Personal data: known forms, and spans that a character tagger learned from labelled ones."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from footfall.llm.char_tagger import PAD, WINDOW, Tagger, codes

KINDS = ("email", "ip", "card", "phone")
# The patterns of the known forms.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@]")
# The same matches in linear time: a match begins where its run of characters does, or where the match
# before it ended, so no run is tried again from each of its characters.
_IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_LOCAL_PARTS = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")

#: Every known form holds a figure or the sign @, so a window without either has no span to learn or
#: to find. Windows reach this far around each of those, and overlap by this much.
REACH, OVERLAP = 20, 24
SAMPLE_WINDOWS = 1200
LEAST_SHARE, LEAST_CHARS = 0.9, 7

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """The matches of ``EMAIL``, found from each sign @ and the run of characters before it."""
    last = 0
    for m in _LOCAL_PARTS.finditer(text):
        start = max(m.start(), last)
        domain = _DOMAIN.match(text, m.end()) if start < m.end() - 1 else None
        if domain:
            last = domain.end()
            yield start, last


def known_spans(text: str) -> list[Span]:
    """``kind, start, end`` of the known forms, in the order of kind and start."""
    found: list[Span] = []
    if "@" in text:
        found += [(0, start, end) for start, end in email_spans(text)]
    if _SIGNAL.search(text):
        for m in _IP_RUNS.finditer(text):
            parts = [part.lstrip("0") for part in m[0].split(".")]
            if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
                found.append((1, m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((3, m.start(), m.end()))
    return found


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the overlapping windows that cover every figure and @ with its surroundings."""
    low = high = -1
    for m in _SIGNAL.finditer(text):
        if low >= 0 and m.start() - REACH <= high:
            high = min(len(text), m.end() + REACH)
            continue
        if low >= 0:
            yield from _cut(low, high)
        low, high = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
    if low >= 0:
        yield from _cut(low, high)


def _cut(low: int, high: int) -> Iterator[tuple[int, int]]:
    while high - low > WINDOW:
        yield low, low + WINDOW
        low += WINDOW - OVERLAP
    yield low, high


def tags_of(spans: Iterable[Span], low: int, high: int) -> np.ndarray:
    """0 outside, then for each kind one tag for the first character and one for the others."""
    tags = np.zeros(WINDOW, np.int64)
    for kind, start, end in spans:
        if start < high and end > low:
            tags[max(start, low) - low:min(end, high) - low] = 2 + 2 * kind
            if start >= low:
                tags[start - low] = 1 + 2 * kind
    return tags


def window_codes(text: str, low: int, high: int) -> np.ndarray:
    ids = np.full(WINDOW, PAD)
    ids[:high - low] = codes(text[low:high])
    return ids


def train(labelled: Iterable[tuple[str, list[Span]]], **options: object) -> Tagger | None:
    """A tagger from texts with labelled spans; None where no window has a span."""
    ids, tags = [], []
    for text, spans in labelled:
        near = _Near(spans)
        for low, high in windows(text):
            ids.append(window_codes(text, low, high))
            tags.append(tags_of(near(low, high), low, high))
    if not tags or not np.any(tags):
        return None
    return Tagger.fresh(1 + 2 * len(KINDS)).fit(np.array(ids), np.array(tags), **options)


def learned_spans(model: Tagger, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """The spans the tagger sees in each text, with their weight, reconciled over its windows.

    All windows are decoded on their own. The spans of a text's windows then compete as a whole: the
    set without overlaps that has the greatest sum of weights is kept, a weight being the mean share
    of the span's tags times its length. A span that a window's edge cuts is only kept if no other
    window sees more of it.
    """
    places = [(i, low, high) for i, text in enumerate(texts) for low, high in windows(text)]
    found: list[set] = [set() for _ in texts]
    for at in range(0, len(places), 512):
        some = places[at:at + 512]
        paths, shares = model.decode(np.array([window_codes(texts[i], a, b) for i, a, b in some]))
        for (i, low, high), path, share in zip(some, paths, shares):
            start = 0
            while start < high - low:
                tag = path[start]
                if tag == 0:
                    start += 1
                    continue
                kind, end = (tag - 1) // 2, start + 1
                while end < high - low and path[end] == 2 + 2 * kind:
                    end += 1
                mean = float(share[start:end].mean())
                if mean >= LEAST_SHARE and end - start >= LEAST_CHARS:
                    found[i].add((int(kind), low + start, low + end, round(mean * (end - start), 6)))
                start = end
    return [_heaviest(sorted(spans, key=lambda s: (s[2], s))) for spans in found]


def _heaviest(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Weighted choice of spans without overlaps; ``spans`` are sorted by their end."""
    ends = [s[2] for s in spans]
    best, taken = [0.0], []
    for i, (_, start, _, weight) in enumerate(spans):
        before = bisect_right(ends, start, 0, i)
        taken.append((best[before] + weight > best[i], before))
        best.append(max(best[i], best[before] + weight))
    chosen, i = [], len(spans)
    while i:
        take, before = taken[i - 1]
        if take:
            chosen.append(spans[i - 1])
        i = before if take else i - 1
    return chosen[::-1]


class _Near:
    """Which spans of a text overlap a range; a kind's spans lie apart and in order, so two searches find them."""

    def __init__(self, spans: Iterable[Span]):
        kinds: dict[int, list[Span]] = {}
        for span in sorted(spans):
            kinds.setdefault(span[0], []).append(span)
        self.kinds = [(some, [a for _, a, _ in some], [b for _, _, b in some]) for some in kinds.values()]

    def __call__(self, start: int, end: int) -> list[Span]:
        return [span for some, starts, ends in self.kinds
                for span in some[bisect_right(ends, start):bisect_left(starts, end)]]


def all_spans(model: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Known spans, and learned ones that touch no known one, of each text."""
    known = [known_spans(text) for text in texts]
    learned = learned_spans(model, texts) if model else [[] for _ in texts]
    result = []
    for base, more in zip(known, learned):
        near = _Near(base)
        result.append((base, [(kind, start, end) for kind, start, end, _ in more if not near(start, end)]))
    return result


def labelled_sample(documents: DataFrame, most: int = SAMPLE_WINDOWS, text: str = "text"
                    ) -> list[tuple[str, list[Span]]]:
    """At most ``most`` windows with their known spans, those with the least hashes of their text.

    Two thirds hold a span, as far as there are so many. Everything that is not a known form counts
    as labelled too: as outside.
    """
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for value in batch.column(0).to_pylist():
                if value and _SIGNAL.search(value):
                    near = _Near(known_spans(value))
                    for low, high in windows(value):
                        inside = [(k, max(a, low) - low, min(b, high) - low) for k, a, b in near(low, high)]
                        piece = value[low:high]
                        mark = xxhash.xxh64_intdigest(piece.encode("utf-8", "surrogatepass")) >> 1
                        rows.append((mark, bool(inside), piece,
                                     [x for span in inside for x in span]))
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()),
                 pa.array(columns[2], pa.string()), pa.array(columns[3], pa.list_(pa.int32()))],
                names=["mark", "has", "piece", "spans"])

    found = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(
        run, "mark BIGINT, has BOOLEAN, piece STRING, spans ARRAY<INT>").dropDuplicates(["mark", "piece"])
    rank = F.when(F.col("has"), F.col("mark")).otherwise(F.col("mark") / 2 + 2.0 ** 62)
    rows = found.orderBy(F.col("has").desc(), rank, "piece").limit(most).collect() if most else []
    plain = found.filter("NOT has").orderBy("mark", "piece").limit(most // 3).collect() if most else []
    kept = [row for row in rows if row["has"]][:most - len(plain)] + plain
    return [(row["piece"], list(zip(*[iter(row["spans"])] * 3))) for row in kept]


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans))


def personal_data(documents: DataFrame, model: Tagger | None = None, train_on: int = SAMPLE_WINDOWS,
                  text: str = "text") -> DataFrame:
    """Counts of the known forms and all spans, one row per row of ``documents``.

    Without a given ``model`` one is trained on at most ``train_on`` windows that the known forms
    label. Its spans are added where they touch no known one. A null text is empty. Repeated rows and
    null ids each give their own row; an empty table gives none; further columns are ignored.
    """
    if model is None and train_on:
        model = train(labelled_sample(documents, train_on, text))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = [value or "" for value in batch.column(1).to_pylist()]
            counts, marks, spans, extra = [[] for _ in KINDS], [], [], []
            for base, more in all_spans(model, texts):
                for kind, column in enumerate(counts):
                    column.append(sum(k == kind for k, _, _ in base))
                marks.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + more))
                extra.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(marks, pa.string()),
                 pa.array(spans, pa.string()), pa.array(extra, pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_learned"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    narrow = documents.select("doc_id", F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(
        run, f"doc_id {kind}, n_email BIGINT, n_ip BIGINT, n_card BIGINT, n_phone BIGINT, "
             "base_sha256 STRING, spans STRING, n_learned BIGINT")


def mask(text: str, spans: Iterable[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for start, end, kind in sorted((start, end, kind) for kind, start, end in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def masked_documents(documents: DataFrame, model: Tagger | None = None,
                     train_on: int = SAMPLE_WINDOWS, text: str = "text",
                     changed: str = "masked") -> DataFrame:
    """``documents`` with masked texts, and whether a text is ``changed``. Null texts stay null."""
    if model is None and train_on:
        model = train(labelled_sample(documents, train_on, text))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts, flags = batch.column(at).to_pylist(), []
            for i, (base, more) in enumerate(all_spans(model, [value or "" for value in texts])):
                flags.append(bool(base or more))
                if flags[-1]:
                    texts[i] = mask(texts[i], base + more)
            columns = [*batch.columns, pa.array(flags, pa.bool_())]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, changed])

    return documents.mapInArrow(run, StructType([*documents.schema.fields,
                                                 StructField(changed, BooleanType())]))
