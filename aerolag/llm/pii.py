"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans they miss.

Around every sign of an entity the text is cut into tokens. Each run of tokens up to a bounded length
that could be an entity of a kind is a candidate segment, scored as a whole by features of its span:
digits, separators, check sums, groups, edges and the word before it. Dynamic programming over the
tokens and the kind of the last segment chooses boundaries and kinds jointly; tokens outside score
zero. The weights are fitted by conditional likelihood on a bounded sample of the corpus's own base
spans, as they stand and rewritten into forms the patterns miss.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from aerolag.llm.tables import map_arrow, slices

KINDS = ("email", "ip", "card", "phone")
#: Regions of text the field is fitted on, and their longest length. Spans are searched in all texts.
FIT_REGIONS = 1200
FIT_CHARACTERS = 400
FIT_ROUNDS = 16
MAX_TOKENS = 24
MAX_CHARACTERS = 64
#: A span is added if its score, against leaving it out, is at least this.
MARGIN = 2.0
SEED = 5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]|\[at\]|\(at\)")
_WORD = re.compile(r"\S+")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\S")
_DIGITS = re.compile("[0-9]+")
_JOINS_LEFT = re.compile(r"[0-9][ ().-]{0,2}$")
_JOINS_RIGHT = re.compile(r"[ ().-]{0,2}[0-9]")
_AT = re.compile(r"\s?(?:@|\(at\)|\[at\])\s?")
_DOT = re.compile(r"\s?(?:\(dot\)|\[dot\])\s?")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the fixed patterns find, by kind and start; in time linear in the text for any text."""
    found = []
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            free = domain.end()
            found.append(("email", start, free))
        at = text.find("@", max(at + 1, free))
    for chain in _CHAIN.finditer(text):
        if chain[0].count(".") >= 3:
            runs = list(_DIGITS.finditer(text, chain.start(), chain.end()))
            for first in range(0, len(runs) - 3, 4):
                four = runs[first : first + 4]
                if all(len(part := run[0].lstrip("0")) <= 3 and int(part or 0) <= 255 for run in four):
                    found.append(("ip", four[0].start(), four[3].end()))
    for kind, pattern, low, high in (("card", _CARD, 13, 19), ("phone", _PHONE, 9, 15)):
        for match in pattern.finditer(text):
            if match.end() - match.start() >= low:
                digits = "".join(_DIGITS.findall(match[0]))
                if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                    found.append((kind, match.start(), match.end()))
    return found


def _regions(text: str) -> list[tuple[int, int]]:
    """Stretches of text: words with a sign of an entity, and neighbouring words as far as an entity reaches."""
    words = [match.span() for match in _WORD.finditer(text)]
    out: list[list[int]] = []
    for place, (start, end) in enumerate(words):
        sign = _SIGN.search(text, start, end)
        if not sign:
            continue
        spelled = text.find("at)", start, end) >= 0 or text.find("at]", start, end) >= 0
        low = max(words[max(0, place - 1)][0], start - MAX_CHARACTERS)
        high = min(words[min(len(words) - 1, place + (8 if spelled else 1))][1], end + MAX_CHARACTERS)
        if out and low <= out[-1][1]:
            out[-1][1] = max(high, out[-1][1])
        else:
            out.append([low, high])
    return [(low, high) for low, high in out]


def _features(kind: str, text: str, start: int, end: int, left: str) -> list[str] | None:
    """Names of the features of a span as ``kind``, or None where it cannot be one."""
    span = text[start:end]
    before, after = text[start - 1 : start], text[end : end + 1]
    names = ["bias"]
    if kind == "email":
        plain = _DOT.sub(".", _AT.sub("@", span))
        local, mark, domain = plain.partition("@")
        if not mark or not local or not domain or "@" in domain or not set(local) <= _LOCAL:
            return None
        parts = domain.split(".")
        if not all(re.fullmatch("[A-Za-z0-9-]+", part) for part in parts):
            return None
        names += [f"parts{min(4, len(parts))}", "as it is" if plain == span else "rewritten"]
        names.append("end word" if parts[-1].isalpha() and 2 <= len(parts[-1]) <= 10 else "end other")
        names.append(f"right {'@' if after == '@' else '.' if after == '.' and text[end + 1 : end + 2].isalnum() else '-' if after == '-' else ''}")
    else:
        digits = "".join(_DIGITS.findall(span))
        count = len(digits)
        if kind == "phone":
            if not 7 <= count <= 15 or span[0] not in "+(0123456789" or not set(span) <= set("0123456789+ ().-/"):
                return None
            if "+" in span[1:] or span.count("(") != span.count(")"):
                return None
            groups = [len(group) for group in _DIGITS.findall(span)]
            names += [f"digits{count}", f"groups{min(6, len(groups))}", f"last{min(5, groups[-1])}"]
            names.append("plus" if span[0] == "+" else "paren" if "(" in span else "dash" if "-" in span else "bare")
            names.append(f"shape {'+' * (span[0] == '+')}{'(' * ('(' in span)}{len(groups)}.{groups[-1]}")
        elif kind == "card":
            if not 13 <= count <= 19 or not set(span) <= set("0123456789 .-"):
                return None
            kinds = set(span) - set("0123456789")
            if len(kinds) > 1 or re.search("[ .-]{2}", span):
                return None
            names += [f"luhn {luhn(digits)}", f"digits{count}", f"parted {''.join(kinds)}"]
            names.append(f"luhn {luhn(digits)} groups {min(6, len(_DIGITS.findall(span)))}")
        else:
            plain = span.replace("[.]", ".")
            if not re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", plain):
                return None
            names += [f"low {all(int(part) <= 255 for part in plain.split('.'))}", "as it is" if plain == span else "rewritten"]
    if kind != "email":
        names.append(f"joins left {bool(_JOINS_LEFT.search(text, max(0, start - 4), start))}")
        names.append(f"joins right {bool(_JOINS_RIGHT.match(text, end))}")
    names += [f"before {'d' if before.isdigit() else 'a' if before.isalnum() else before if before in '.+-@/_$#' else ''}"]
    names += [f"after {'d' if after.isdigit() else 'a' if after.isalnum() else after if after in '-@/_%:' else ''}"]
    if after == "." and text[end + 1 : end + 2].isdigit():
        names.append("after .d")
    if before in ".-" and text[start - 2 : start - 1].isdigit():
        names.append("before d.")
    names.append(f"left {left}")
    return names


_CUES = ("phone", "tel", "call", "fax", "mobile", "mail", "email", "contact", "card", "visa", "ip", "address", "host")


def _cue(text: str, start: int) -> str:
    word = re.search(r"([A-Za-z]+)\W{0,3}$", text[max(0, start - 24) : start])
    return word[1].lower() if word and word[1].lower() in _CUES else ""


Candidate = tuple[int, int, int, list[str], int, int]


def _candidates(text: str, low: int, high: int, taken: list[list[int]]) -> tuple[int, list[Candidate]]:
    """Number of tokens between ``low`` and ``high``, and the segments that could be entities there.

    A segment: first token, end token (exclusive), kind, features, start and end in the text.
    Segments that overlap one of ``taken`` are left out.
    """
    tokens = [match.span() for match in _TOKEN.finditer(text, low, high)]
    has_digit = [text[start].isdigit() and text[start].isascii() for start, _ in tokens]
    is_open = [digit or text[start] in "+(" for digit, (start, _) in zip(has_digit, tokens)]
    is_at = [text[start] == "@" or text[start - 1 : end + 1] in ("(at)", "[at]") for start, end in tokens]
    at_before = np.cumsum([0, *is_at])
    digits_before = np.cumsum([0, *[(end - start) * digit for digit, (start, end) in zip(has_digit, tokens)]])
    starts, ends = [start for start, _ in tokens], [end for _, end in tokens]
    is_taken = np.zeros(len(tokens), dtype=np.int64)
    for start, end in taken:
        is_taken[bisect_right(ends, start) : bisect_left(starts, end)] = 1
    taken_before = np.cumsum([0, *is_taken.tolist()])
    out: list[Candidate] = []
    for first, (start, _) in enumerate(tokens):
        word = text[start].isalnum() or text[start] in "_%"
        if not word and not is_open[first]:
            continue
        cue = None
        for end in range(first + 1, min(len(tokens), first + MAX_TOKENS) + 1):
            stop = tokens[end - 1][1]
            if stop - start > MAX_CHARACTERS:
                break
            kinds = []
            if word and text[stop - 1].isalnum() and at_before[end] - at_before[first] == 1:
                kinds.append(0)
            if has_digit[end - 1] and is_open[first]:
                count = digits_before[end] - digits_before[first]
                kinds += [1] if 4 <= count <= 12 else []
                kinds += [2] if 13 <= count <= 19 else []
                kinds += [3] if 7 <= count <= 15 else []
            if not kinds or taken_before[end] > taken_before[first]:
                continue
            cue = _cue(text, start) if cue is None else cue
            for kind in kinds:
                names = _features(KINDS[kind], text, start, stop, cue)
                if names:
                    out.append((first, end, kind, [f"{KINDS[kind]} {name}" for name in names], start, stop))
    return len(tokens), out


class Field:
    """Weights of features and of neighbouring kinds (the last index is none)."""

    def __init__(self, weights: dict[str, float] | None = None, turns: np.ndarray | None = None):
        self.weights = weights or {}
        self.turns = turns if turns is not None else np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def scores(self, candidates: list[Candidate]) -> list[float]:
        get = self.weights.get
        return [sum(get(name, 0.0) for name in candidate[3]) for candidate in candidates]

    def best(self, tokens: int, candidates: list[Candidate]) -> list[int]:
        """Indexes of the segments of the best segmentation."""
        if not candidates:
            return []
        scores = self.scores(candidates)
        ending: dict[int, list[int]] = {}
        for index, candidate in enumerate(candidates):
            ending.setdefault(candidate[1], []).append(index)
        none = len(KINDS)
        value = np.full((tokens + 1, none + 1), -np.inf)
        value[0, none] = 0.0
        back: dict[tuple[int, int], tuple[int, int, int]] = {}
        for at in range(1, tokens + 1):
            out = value[at - 1] + self.turns[:, none]
            before = int(np.argmax(out))
            value[at, none] = out[before]
            back[at, none] = (at - 1, before, -1)
            for index in ending.get(at, ()):
                first, _, kind = candidates[index][:3]
                into = value[first] + self.turns[:, kind]
                before = int(np.argmax(into))
                if into[before] + scores[index] > value[at, kind]:
                    value[at, kind] = into[before] + scores[index]
                    back[at, kind] = (first, before, index)
        at, kind, chosen = tokens, int(np.argmax(value[tokens])), []
        while at > 0:
            at, kind, index = back[at, kind]
            if index >= 0:
                chosen.append(index)
        return [index for index in reversed(chosen) if scores[index] >= MARGIN]

    def expected(self, tokens: int, candidates: list[Candidate]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each segment, and expected number of each pair of neighbours."""
        scores = self.scores(candidates)
        none = len(KINDS)
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for index, candidate in enumerate(candidates):
            by_end.setdefault(candidate[1], []).append(index)
            by_start.setdefault(candidate[0], []).append(index)
        ahead = np.full((tokens + 1, none + 1), -np.inf)
        ahead[0, none] = 0.0
        for at in range(1, tokens + 1):
            ahead[at, none] = np.logaddexp.reduce(ahead[at - 1] + self.turns[:, none])
            for index in by_end.get(at, ()):
                first, _, kind = candidates[index][:3]
                ahead[at, kind] = np.logaddexp(ahead[at, kind], scores[index] + np.logaddexp.reduce(ahead[first] + self.turns[:, kind]))
        behind = np.full((tokens + 1, none + 1), -np.inf)
        behind[tokens] = 0.0
        chance, turns = np.zeros(len(candidates)), np.zeros_like(self.turns)
        total = np.logaddexp.reduce(ahead[tokens])
        for at in range(tokens - 1, -1, -1):
            through = self.turns[:, none] + behind[at + 1, none]
            turns[:, none] += np.exp(ahead[at] + through - total)
            ways = [through]
            for index in by_start.get(at, ()):
                _, end, kind = candidates[index][:3]
                through = self.turns[:, kind] + scores[index] + behind[end, kind]
                here = np.exp(ahead[at] + through - total)
                chance[index] = here.sum()
                turns[:, kind] += here
                ways.append(through)
            behind[at] = np.logaddexp.reduce(ways, axis=0)
        return chance, turns


def _rewritten(kind: str, span: str, rng: random.Random) -> str:
    """The entity in a form the fixed patterns do not match."""
    if kind == "email":
        at, dot = rng.choice([("(at)", "."), ("[at]", "."), (" (at) ", "."), (" [at] ", " [dot] "), ("[at]", "[dot]")])
        local, _, domain = span.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return span.replace(".", "[.]")
    if kind == "card":
        digits = "".join(_DIGITS.findall(span))
        return ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    groups = _DIGITS.findall(span)
    rest = groups[1:] if len(groups) > 2 else groups
    return rng.choice(["({}) {}", "{}-{}"]).format(rest[0], "-".join(rest[1:]) or "555-0100")


def _others(rng: random.Random) -> str:
    """A number that is no personal data."""
    n = rng.randrange
    return rng.choice([
        f"{n(1900, 2030)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29):02}.{n(1, 13):02}.{n(1900, 2030)}", f"{n(10)}.{n(30)}.{n(30)}",
        f"{n(10**6, 10**12)}", f"{n(1, 999)}.{n(100, 999)}.{n(100, 999)}", f"{n(100, 999)},{n(100, 999)}", f"{n(24):02}:{n(60):02}:{n(60):02}",
        f"{n(1900, 2030)}-{n(1900, 2030)}", f"{n(256)}.{n(256)}.{n(256)}.{n(256)}.{n(256)}", f"{n(10**15, 10**16)}", f"{n(10**3, 10**4)} {n(10**3, 10**4)}",
    ])


def _neighbours(tokens: int, candidates: list[Candidate], gold: np.ndarray) -> np.ndarray:
    """How often each kind follows each along the given segments, tokens outside counted one by one."""
    pairs = np.zeros((len(KINDS) + 1, len(KINDS) + 1))
    starting = {candidates[i][0]: candidates[i] for i in np.flatnonzero(gold)}
    at, last = 0, len(KINDS)
    while at < tokens:
        kind, at = (starting[at][2], starting[at][1]) if at in starting else (len(KINDS), at + 1)
        pairs[last, kind] += 1
        last = kind
    return pairs


def fit(regions: list[str], rounds: int = FIT_ROUNDS, seed: int = SEED) -> Field:
    """A field fitted on regions of text: their base spans, the same rewritten, and other numbers."""
    rng = random.Random(seed)
    examples = []

    def add(text: str, spans: set[tuple[str, int, int]]) -> None:
        for low, high in _regions(text):
            tokens, candidates = _candidates(text, low, high, [])
            gold = np.array([float((KINDS[c[2]], c[4], c[5]) in spans) for c in candidates])
            if candidates:
                examples.append((tokens, candidates, gold, _neighbours(tokens, candidates, gold)))

    for text in regions:
        spans = base_spans(text)
        add(text, set(spans))
        for kind, start, end in spans[:2]:
            new = _rewritten(kind, text[start:end], rng)
            left = text[max(0, start - 24) : start].rpartition(" ")[2] if start and not text[start - 1].isspace() else ""
            other = f"{text[:start]}{new} {_others(rng)} {left}" if not left else f"{new} {_others(rng)}"
            at = start if not left else 0
            add(other, {(kind, at, at + len(new))} | {s for s in base_spans(other) if s[2] <= at or s[1] >= at + len(new)})
    field = Field()
    squares: dict[str, float] = {}
    for _ in range(rounds):
        rng.shuffle(examples)
        for tokens, candidates, gold, pairs in examples:
            chance, expected_pairs = field.expected(tokens, candidates)
            field.turns += 0.02 * (pairs - expected_pairs - 0.01 * field.turns)
            step: dict[str, float] = {}
            for candidate, difference in zip(candidates, gold - chance):
                if abs(difference) > 1e-4:
                    for name in candidate[3]:
                        step[name] = step.get(name, 0.0) + difference
            for name, value in step.items():
                value -= 1e-3 * field.weights.get(name, 0.0)
                squares[name] = squares.get(name, 1e-6) + value * value
                field.weights[name] = field.weights.get(name, 0.0) + 0.5 * value / squares[name] ** 0.5
    field.weights = {name: round(value, 6) for name, value in field.weights.items()}
    field.turns = np.round(field.turns, 6)
    return field


def fit_on(documents: DataFrame, regions: int = FIT_REGIONS) -> Field:
    """Fit on at most ``regions`` stretches of ``documents`` (text) that hold base spans, chosen by hash."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for text in batch.column("text").to_pylist():
                if text and _SIGN.search(text):
                    spans = base_spans(text)
                    for low, high in _regions(text) if spans else ():
                        if high - low <= FIT_CHARACTERS and any(low <= s and e <= high for _, s, e in spans):
                            found.append(text[low:high])
            if found:
                yield pa.RecordBatch.from_pydict({"region": sorted(set(found))})

    found = map_arrow(documents.select(F.col("text").cast("string").alias("text")), read, "region string").distinct()
    rows = found.orderBy(F.xxhash64("region"), "region").limit(regions).collect()
    return fit([row["region"] for row in rows])


def all_spans(text: str | None, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: those and what the field adds beside them; by kind, then start."""
    if not text or not _SIGN.search(text):
        return [], []
    base = base_spans(text)
    joined: list[list[int]] = []
    for start, end in sorted(span[1:] for span in base):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(end, joined[-1][1])
        else:
            joined.append([start, end])
    added = []
    for low, high in _regions(text):
        taken = joined[bisect_right(joined, low, key=lambda s: s[1]) : bisect_left(joined, high, key=lambda s: s[0])]
        tokens, candidates = _candidates(text, low, high, taken)
        chosen = field.best(tokens, candidates)
        added += [(KINDS[candidates[i][2]], candidates[i][4], candidates[i][5]) for i in chosen]
    order = {kind: place for place, kind in enumerate(KINDS)}
    return base, sorted({*base, *added}, key=lambda span: (order[span[0]], span[1], span[2]))


_SPANS = ArrayType(StructType().add("kind", "string").add("start", "integer").add("end", "integer"))


def find_spans(documents: DataFrame, field: Field) -> DataFrame:
    """The columns of ``documents`` packed in ``_row``, with ``base`` and ``spans`` of its text.

    Spans are places in code points, the end exclusive. A null or empty text has none.
    """
    weights, turns = field.weights, field.turns
    schema = StructType().add("_row", documents.schema).add("base", _SPANS).add("spans", _SPANS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Field(weights, turns)
        spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches):
            found = [all_spans(text, known) for text in batch.column("_text").to_pylist()]
            columns = [
                pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in pair[place]] for pair in found], spans_type)
                for place in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *columns], ["_row", "base", "spans"])

    rows = documents.select(F.struct(*documents.columns).alias("_row"), F.col("text").cast("string").alias("_text"))
    return map_arrow(rows, read, schema)


def _count(kind: str) -> Column:
    # A second parameter of the inner function would be the place in the array.
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every document (doc_id, text).

    A null or empty text has counts of zero, the digest of an empty string and no spans. Repeated rows
    give repeated results; other columns are not read.
    """
    found = find_spans(documents.select("doc_id", "text"), fit_on(documents))
    # The text is not needed beyond this point.
    text_of = lambda column: F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    counts = [_count(kind) for kind in KINDS]
    return found.select(
        "_row.doc_id", *counts, F.sha2(text_of("base").cast("binary"), 256).alias("base_sha256"), text_of("spans").alias("spans")
    )


def redact(documents: DataFrame, field: Field) -> DataFrame:
    """``documents`` with every span of their text replaced by its kind in square brackets.

    Overlapping spans are replaced together, by the kind of the first. All columns stay.
    """
    names, weights, turns = documents.columns, field.weights, field.turns

    def hidden(text: str | None, known: Field) -> str | None:
        parts, at = [], 0
        for kind, start, end in sorted(all_spans(text, known)[1], key=lambda span: (span[1], -span[2])):
            if start >= at:
                parts += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        return "".join(parts) + text[at:] if parts else text

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Field(weights, turns)
        for batch in slices(batches):
            texts = pa.array([hidden(text, known) for text in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if name == "text" else batch.column(name) for name in names], names)

    return map_arrow(documents, read, documents.schema)
