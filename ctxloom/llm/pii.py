"""Personal data: exact patterns, and a semi-Markov conditional random field over whole spans that adds to them.

The field scores segments, not tokens: a candidate span's features look at all of it and at what stands
beside it. A dynamic program over segments of bounded length chooses boundaries and kinds together.
It is trained here, on patterns' finds in a bounded sample of texts and on made-up variants of them.
"""

from __future__ import annotations

import random
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import texts, with_doc_id
from ctxloom.runtime import ship_package

KINDS = ("email", "ip", "card", "phone")
SAMPLE_REGIONS = 300
MAX_ATOMS = 16
MAX_CHARS = 80
_EPOCHS = 30
_SLICE = 1 << 10  # atoms scored at once
_FEATURES = 1 << 10

# The patterns of the contract. An address cannot begin inside a run of digits: a match that fails from
# the run's beginning fails from there too, and one that ends takes the whole run, so each run is looked at once.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TRIGGER = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[\[(](?:at|dot)[\])]|.", re.DOTALL)
_AT = re.compile(r"@|[\[(]at[\])]")


# ---------------------------------------------------------------- patterns


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = [2 * d - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by the patterns: leftmost, not overlapping within a kind; matches that fail a check are left out."""
    out = []
    if "@" in text:
        # A match begins where the characters before an @ begin, so each @ is looked at once.
        end, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, at) if start < at else None
            if match:
                end = match.end()
                out.append((start, end, "email"))
            at = text.find("@", max(at + 1, end))
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if _is_ip(m.group())]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=_order)


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


# ---------------------------------------------------------------- regions and candidate segments


def regions(text: str) -> list[tuple[int, int]]:
    """Where a span can be: pieces between white space that hold a trigger, with a piece on either side, joined if they touch."""
    out: list[list[int]] = []
    limit = MAX_CHARS
    for m in _TRIGGER.finditer(text):
        if out and m.start() < out[-1][2]:
            continue
        a, b = m.start(), m.end()
        left, spaces = a, 0
        while left > 0 and a - left < limit:
            if text[left - 1].isspace():
                spaces += 1
                if spaces > 1:
                    break
            left -= 1
        right, spaces, core = b, 0, b
        while right < len(text) and right - b < limit:
            if text[right].isspace():
                spaces += 1
                if spaces > 1:
                    break
            elif not spaces:
                core = right + 1
            right += 1
        if out and left <= out[-1][1]:
            out[-1][1:] = [right, core]
        else:
            out.append([left, right, core])
    return [(a, b) for a, b, _ in out]


@dataclass
class Region:
    """Atoms of a region and its candidate segments (first atom, end atom)."""

    text: str
    begins: list[int]
    ends: list[int]
    segments: list[tuple[int, int]]


def _segments(text: str, begins: list[int], ends: list[int], count: int) -> list[tuple[int, int]]:
    """Candidate segments that begin at one of the first ``count`` atoms."""
    segments = []
    for i, a in enumerate(begins[:count]):
        first = text[a]
        if not (first.isalnum() or first in "+("):
            continue
        trigger = False
        for j in range(i, min(len(begins), i + MAX_ATOMS)):
            if ends[j] - a > MAX_CHARS or text[begins[j]] in "\r\n":
                break
            last = text[ends[j] - 1]
            trigger = trigger or "0" <= text[begins[j]] <= "9" or bool(_AT.match(text, begins[j]))
            if trigger and last.isalnum() and last.isascii() and j > i - 1 and ends[j] - a > 5:
                segments.append((i, j + 1))
    return segments


def region_of(text: str) -> Region:
    found = [(m.start(), m.end()) for m in _ATOM.finditer(text)]
    begins, ends = [a for a, _ in found], [b for _, b in found]
    return Region(text, begins, ends, _segments(text, begins, ends, len(begins)))


def _slices(text: str) -> Iterator[tuple[Region, int]]:
    """A region's atoms a slice at a time, with those after it that a segment can reach; the number of the slice's own."""
    begins: list[int] = []
    ends: list[int] = []
    for m in _ATOM.finditer(text):
        begins.append(m.start())
        ends.append(m.end())
        if len(begins) == _SLICE + MAX_ATOMS - 1:
            yield Region(text, begins, ends, _segments(text, begins, ends, _SLICE)), _SLICE
            begins, ends = begins[_SLICE:], ends[_SLICE:]
    if begins:
        yield Region(text, begins, ends, _segments(text, begins, ends, len(begins))), len(begins)


def _side(char: str) -> str:
    return "edge" if not char else "space" if char.isspace() else "word" if char.isalnum() else char if char.isascii() else "other"


def span_features(text: str, start: int, end: int) -> list[int]:
    """Numbers of the features that hold for the whole span."""
    own = text[start:end]
    digits = _digits(own)
    groups = re.findall(r"[0-9]+", own)
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 9)), own))
    before, after = text[start - 1 : start], text[end : end + 1]
    names = [
        "bias", f"digits {min(len(digits), 20)}", f"groups {min(len(groups), 8)}", f"shape {shape[:40]}",
        f"before {_side(before)}", f"after {_side(after)}", f"first {_side(own[0])}", f"at {min(len(_AT.findall(own)), 2)}",
        f"letters {bool(re.search('[A-Za-z]', own))}", f"spaces {min(sum(map(str.isspace, own)), 5)}",
        f"plus {own[0] == '+'}", f"dots {min(own.count('.'), 5)}",
        f"luhn {luhn(digits)} {12 <= len(digits) <= 19}", f"ip {bool(_IP.fullmatch(own)) and _is_ip(own)}",
        f"end {bool(re.search(r'(?:[.]|[(]dot[)]|\[dot\]) ?[A-Za-z]{2,6}$', own))} {min(len(_AT.findall(own)), 2)}",
        f"sides {_side(before) in ('edge', 'space')} {_side(after) in ('edge', 'space', '.', ',')}",
        f"phone {bool(re.fullmatch(r'(?:[+]?[0-9]{1,3}[ .-]?)?(?:[(][0-9]{3}[)]|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}', own))}",
    ]
    return [hash_name(n) for n in names]


@lru_cache(1 << 16)
def hash_name(name: str) -> int:
    value = 2166136261
    for byte in name.encode():
        value = (value ^ byte) * 16777619 & 0xFFFFFFFF
    return (value ^ value >> 15) % _FEATURES


# ---------------------------------------------------------------- the field


def _scores(region: Region, weights: np.ndarray) -> np.ndarray:
    """(segments, kinds)."""
    rows = [span_features(region.text, region.begins[i], region.ends[j - 1]) for i, j in region.segments]
    return weights[np.array(rows)].sum(axis=1) if rows else np.zeros((0, len(KINDS)))


def best_spans(text: str, weights: np.ndarray, free: Callable[[int, int], bool]) -> list[tuple[int, int, str]]:
    """The best division of a region into spans and single atoms outside; an atom outside scores zero. Spans must be ``free``.

    A region can be as long as a text. Segments are made and scored a slice of atoms at a time; of the places
    behind only the last value is kept, and for each atom where it begins and the best span that ends with it.
    """
    places, lengths, kinds = array("q"), bytearray(1), bytearray(1)
    ahead: dict[int, tuple[float, int, int]] = {}  # by end: the best span among those begun so far
    value, at = 0.0, 0
    for region, count in _slices(text):
        region.segments = [(i, j) for i, j in region.segments if free(region.begins[i], region.ends[j - 1])]
        scores = _scores(region, weights)
        kind_of, best = (scores.argmax(axis=1).tolist(), scores.max(axis=1).tolist()) if len(scores) else ([], [])
        s = 0
        for i in range(count):
            while s < len(best) and region.segments[s][0] == i:
                end = region.segments[s][1]
                v = value + best[s]
                if at + end not in ahead or v > ahead[at + end][0]:
                    ahead[at + end] = v, end - i, kind_of[s]
                s += 1
            v, length, kind = ahead.pop(at + i + 1, (value, 0, 0))
            if v > value:
                value = v
            else:
                length = 0
            lengths.append(length)
            kinds.append(kind)
        places.extend(region.begins[:count])
        at += count
    places.append(len(text))
    out, end = [], at
    while end > 0:
        if not lengths[end]:
            end -= 1
            continue
        i = end - lengths[end]
        out.append((places[i], places[end], KINDS[kinds[end]]))
        end = i
    return out[::-1]


def _marginals(region: Region, scores: np.ndarray) -> np.ndarray:
    """Probability of each segment and kind under the field: forward and backward sums over all divisions."""
    n = len(region.begins)
    total = np.logaddexp.reduce(scores, axis=1)
    forward, backward = np.zeros(n + 1), np.zeros(n + 1)
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    starts: list[list[int]] = [[] for _ in range(n + 1)]
    for s, (i, j) in enumerate(region.segments):
        ends[j].append(s)
        starts[i].append(s)
    for at in range(1, n + 1):
        forward[at] = np.logaddexp.reduce([forward[at - 1], *(forward[region.segments[s][0]] + total[s] for s in ends[at])])
    for at in range(n - 1, -1, -1):
        backward[at] = np.logaddexp.reduce([backward[at + 1], *(backward[region.segments[s][1]] + total[s] for s in starts[at])])
    first, last = np.array(region.segments).T
    return np.exp(scores + (forward[first] + backward[last] - forward[n])[:, None])


def fit(examples: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = _EPOCHS) -> np.ndarray:
    """Weights (features, kinds) by gradient ascent on the likelihood of the spans given for each region's text."""
    weights, seen = np.zeros((_FEATURES, len(KINDS))), np.full((_FEATURES, len(KINDS)), 1.0)
    weights[hash_name("bias")] = -2.0
    prepared = []
    for text, spans in examples:
        region = region_of(text)
        if not region.segments:
            continue
        rows = np.array([span_features(text, region.begins[i], region.ends[j - 1]) for i, j in region.segments])
        truth = np.zeros((len(rows), len(KINDS)))
        for s, (i, j) in enumerate(region.segments):
            for a, b, kind in spans:
                if (a, b) == (region.begins[i], region.ends[j - 1]):
                    truth[s, KINDS.index(kind)] = 1.0
        prepared.append((region, rows, truth))
    for _ in range(epochs):
        gradient = -0.01 * weights
        for region, rows, truth in prepared:
            np.add.at(gradient, rows, (truth - _marginals(region, weights[rows].sum(axis=1)))[:, None, :])
        seen += gradient**2
        weights += 0.5 * gradient / np.sqrt(seen)
    return weights


def made_examples(n: int = 240, seed: int = 5) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Regions made up by rule: usual and disguised forms of each kind, and numbers that are none of them."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))

    def card() -> str:
        own = digits(15)
        return next(own + c for c in "0123456789" if luhn(_digits(own + c)))

    def no_card() -> str:
        own = digits(16)
        return own if not luhn(_digits(own)) else own[:-1] + str((int(own[-1]) + 1) % 10)

    four = lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))
    forms = [
        ("email", lambda: f"{word()}.{digits(2)}@{word()}{digits(1)}.{word()}.com"),
        ("email", lambda: f"{word()}@{word()}.{rng.choice(['org', 'net', 'com', 'de'])}"),
        ("email", lambda: f"{word()} [at] {word()} [dot] {rng.choice(['org', 'net', 'com', 'de'])}"),
        ("email", lambda: f"{word()}(at){word()}.{rng.choice(['org', 'net', 'com', 'de'])}"),
        ("ip", four), ("ip", four),
        ("card", card), ("card", lambda: re.sub(r"(\d{4})(?=\d)", r"\1 ", card())), ("card", lambda: re.sub(r"(\d{4})(?=\d)", r"\1-", card())),
        ("phone", lambda: f"+1 ({digits(3)}) 555-{digits(4)}"), ("phone", lambda: f"({digits(3)}) 555-{digits(4)}"),
        ("phone", lambda: f"{digits(3)}-555-{digits(4)}"), ("phone", lambda: f"+{digits(2)} {digits(3)} {digits(3)} {digits(4)}"),
        ("", no_card), ("", no_card), ("", lambda: digits(rng.randint(1, 18))), ("", lambda: f"{digits(1)}.{digits(1)}."), ("", lambda: f"{digits(1)}.{digits(2)}.{digits(1)}"),
        ("", lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))), ("", lambda: f"{digits(4)}-{digits(2)}-{digits(2)}"),
        ("", lambda: f"{digits(3)}.{rng.randint(256, 999)}.{digits(2)}.{digits(3)}"), ("", lambda: f"{word()}{digits(3)}"), ("", lambda: f"{digits(2)}:{digits(2)}"),
        ("", lambda: f"{word()} @ {word()}"), ("", lambda: f"AKIA{digits(8).translate(str.maketrans('0123456789', 'ABCDEFGHIJ'))}{digits(4)}"),
    ]
    out = []
    for k in range(n):
        kind, make = forms[k % len(forms)]
        own, left, right = make(), rng.choice(["", word() + " ", word() + ", "]), rng.choice(["", " " + word(), ".", "!! " + word(), "### " + word()])
        out.append((left + own + right, [(len(left), len(left) + len(own), kind)] if kind else []))
    return out


def train(docs: DataFrame, sample: int = SAMPLE_REGIONS) -> np.ndarray:
    """Weights of the field, from ``sample`` regions of the table, drawn by their hash, and made-up ones.

    In the table's regions the patterns' finds are spans and everything else is not. The number of regions
    is the only bound; each has a bounded length.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t[a:b] for t in texts(batch) for a, b in regions(t) if b - a <= 4 * MAX_CHARS]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["region"])

    rows = docs.select("text").filter(F.col("text").rlike("[0-9@]")).mapInArrow(run, "region string")
    drawn = rows.distinct().orderBy(F.xxhash64("region"), "region").limit(sample).collect()
    return fit([(r["region"], base_spans(r["region"])) for r in drawn] + made_examples())


def find_personal_data(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, spans): spans (kind, start, end, base) of each whole text, in characters, end exclusive.

    Spans by the patterns have ``base`` set and all stay; those that the field adds overlap none of them.
    They are sorted by start, then by kind as in ``KINDS``. One row per row of ``docs``; null and empty
    texts have no spans. doc_id is only carried along and other columns are not looked at.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(weights)
    kind_type = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[dict(kind=k, start=a, end=b, base=own) for a, b, k, own in all_spans(t, shared.value)] for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(kind_type))], ["doc_id", "spans"])

    schema = with_doc_id(docs, "spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def all_spans(text: str, weights: np.ndarray) -> list[tuple[int, int, str, bool]]:
    if not _TRIGGER.search(text):
        return []
    base = base_spans(text)
    covered = np.zeros(len(text) + 1, np.int64)
    for a, b, _ in base:
        covered[a + 1 : b + 1] = 1
    covered = covered.cumsum()
    added: list[tuple[int, int, str]] = []
    for a, b in regions(text):
        found = best_spans(text[a:b], weights, lambda x, y, a=a: covered[a + y] == covered[a + x])
        added += [(a + x, a + y, kind) for x, y, kind in found]
    return sorted([(*s, True) for s in base] + [(*s, False) for s in added], key=_order)
