"""Quality rules: a decision list learnt from labelled documents by sequential covering.

Each rule is a conjunction of thresholds on statistics of a text. A rule is grown on two thirds of the
sample, one condition at a time, by information gained, until it covers no good document; its last
conditions are pruned as long as the other third speaks for that; what it covers is set aside and the next
rule is grown. The list is emitted as one Spark conditional expression in the order of the rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import release_memory, with_doc_id
from ctxloom.llm.runs import may_repeat, word_numbers
from ctxloom.runtime import ship_package

SAMPLE_ROWS = 20_000  # about as many labelled documents are learnt from
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
MIN_PRECISION = 0.9  # of a rule, on the part of the sample that pruned it
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER, _DIGITS, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?.,;:'\"()[]{}-_/\\@+=~^`"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks",
    "n_different_words", "n_doubled_words", "longest_word",
)
#: The statistics that rules speak of: a count over another, 0 where that is 0.
RATIOS = {
    "symbol_share": ("n_symbols", "word_chars"), "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digits", "word_chars"), "mark_share": ("n_marks", "word_chars"),
    "different_share": ("n_different_words", "n_words"), "doubled_share": ("n_doubled_words", "n_words"), "mean_word": ("word_chars", "n_words"),
}
FEATURES = (*RATIOS, "n_words", "longest_word")


# ---------------------------------------------------------------- statistics


def repeated_words(ids: np.ndarray, width: int = WINDOW) -> int:
    """Words in a window of so many that occurs more than once, each of its occurrences counted."""
    if not may_repeat(ids, width):
        return 0
    size = int(ids.max()) + 1
    code, have = ids, 1
    while have < width:
        step = min(have, width - have)
        other = code if step == have else _codes(ids, step, size)
        code = np.unique(code[: len(code) - step] * (int(other.max()) + 1) + other[have : have + len(code) - step], return_inverse=True)[1]
        have += step
    twice = np.bincount(code)[code] > 1
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.nonzero(twice)[0]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _codes(ids: np.ndarray, width: int, size: int) -> np.ndarray:
    code = ids
    for k in range(1, width):
        code = np.unique(code[: len(ids) - k] * size + ids[k:], return_inverse=True)[1]
    return code


def _count(data: bytes, these: bytes) -> int:
    return len(data) - len(data.translate(None, these))


def counts_of(data: bytes) -> tuple[int, ...]:
    """``COUNTS`` of a text's UTF-8 bytes."""
    words = data.split()
    ids = word_numbers(words)
    lines = [line for line in data.split(b"\n") if line.strip(_SPACE)]
    solid = data.translate(None, _SPACE)
    # Code points are the bytes that do not continue one.
    points = int((np.frombuffer(solid, np.int8) >= -64).sum())
    return (
        len(words), points, _count(data, _SYMBOLS), len(lines) - len(set(lines)), repeated_words(ids), len(lines), _count(data, _UPPER),
        _count(data, _DIGITS), _count(data, _MARKS), int(ids.max(initial=-1)) + 1, int((ids[1:] == ids[:-1]).sum()),
        max(map(len, words), default=0),
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS...) of each text, one row per row of ``docs``.

    Words are what stands between ASCII white space; a line counts if it has a word, and as a duplicate if an
    equal one comes before it. Null texts have neither. doc_id is only carried along, other columns are not
    looked at.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 256):
                rows += [counts_of(t or b"") for t in batch.column("text").slice(at, 256).cast(pa.binary()).to_pylist()]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *COUNTS])
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, with_doc_id(docs, ", ".join(f"{c} bigint" for c in COUNTS)))


def feature(name: str) -> Column:
    if name not in RATIOS:
        return F.col(name).cast("double")
    over, under = RATIOS[name]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(0.0)


def base_failed() -> Column:
    """Too short, or too much of it in windows that come again."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


# ---------------------------------------------------------------- rules


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # else at most
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, values: np.ndarray) -> np.ndarray:
        own = values[:, FEATURES.index(self.feature)]
        return own > self.threshold if self.above else own <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), bool)
        for condition in self.conditions:
            out &= condition.holds(values)
        return out

    def column(self) -> Column:
        out = self.conditions[0].column()
        for condition in self.conditions[1:]:
            out = out & condition.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first that holds says bad, and what none covers is good."""

    rules: tuple[Rule, ...] = field(default=())

    def rule_number(self) -> Column:
        """Number of the first rule that holds, from 1; 0 where none does."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            out = F.when(rule.column(), k) if out is None else out.when(rule.column(), k)
        return F.lit(0) if out is None else out.otherwise(0)

    def good(self) -> Column:
        return self.rule_number() == 0

    def __str__(self) -> str:
        return "\n".join([f"{k}. bad if {rule}" for k, rule in enumerate(self.rules, 1)] + ["else good"])


def _best_condition(values: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The condition that gains most information about the rows covered so far; the first feature, then the lowest threshold, among equals."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    before = np.log2(p0 / (p0 + n0))
    best: tuple[float, Condition | None] = (0.0, None)
    for k, name in enumerate(FEATURES):
        order = np.argsort(values[:, k], kind="stable")
        own, hit = values[order, k], bad[order]
        cut = np.nonzero(own[1:] > own[:-1])[0]
        if not len(cut):
            continue
        thresholds = (own[cut] + own[cut + 1]) / 2
        for above in (True, False):
            p = np.cumsum(hit)[cut].astype(float)
            n = (cut + 1) - p
            if above:
                p, n = p0 - p, n0 - n
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0.0)
            i = int(np.argmax(gain))
            if gain[i] > best[0] + 1e-9:
                best = (float(gain[i]), Condition(name, above, float(thresholds[i])))
    return best


def grow(values: np.ndarray, bad: np.ndarray) -> Rule | None:
    """A rule that covers bad rows, with conditions added until it covers no others or none helps."""
    conditions: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while bad[inside].any() and not bad[inside].all():
        _, condition = _best_condition(values[inside], bad[inside])
        if condition is None:
            break
        conditions.append(condition)
        inside &= condition.holds(values)
    return Rule(tuple(conditions)) if conditions else None


def prune(rule: Rule, values: np.ndarray, bad: np.ndarray) -> Rule:
    """The beginning of the rule that does best on rows it was not grown on: (bad - good) / covered; the shortest among equals."""

    def worth(conditions: tuple[Condition, ...]) -> float:
        inside = Rule(conditions).holds(values)
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    beginnings = [rule.conditions[: k + 1] for k in range(len(rule.conditions))]
    return Rule(max(beginnings, key=lambda c: (worth(c), -len(c))))


def learn(values: np.ndarray, bad: np.ndarray, for_pruning: np.ndarray, min_precision: float = MIN_PRECISION) -> DecisionList:
    """A decision list for rows of FEATURES; rows ``for_pruning`` are kept out of growing.

    It ends with the first rule that is right less often than ``min_precision`` on the rows for pruning
    (on those it was grown on if it covers none of the others), and when no bad row is left to cover. Rows of
    one kind alone give an empty list, which calls everything good.
    """
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while True:
        growing, pruning = left & ~for_pruning, left & for_pruning
        rule = grow(values[growing], bad[growing]) if growing.any() else None
        if rule is None:
            break
        rule = prune(rule, values[pruning], bad[pruning])
        inside = rule.holds(values)
        judged = inside & pruning if (inside & pruning).any() else inside & growing
        if not bad[inside & left].any() or bad[judged].mean() < min_precision:
            break
        rules.append(rule)
        left &= ~inside
    return DecisionList(tuple(rules))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DecisionList:
    """Rules learnt from the documents of about ``sample_rows`` labelled ids, chosen by the ids' hashes.

    ``labels`` are (doc_id, quality): 0 is bad, other values are good, null is no label; an id with several
    labels is bad if one of them is. Ids without document, rows without id and documents that fail the base
    rules are not learnt from; of several documents with one id, the one with the least statistics counts.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = known.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # At most a little over sample_rows ids and numbers: a size that is bounded, so they are sent to every task.
    sample = known.filter(share < min(1.0, sample_rows / max(1, total))).select(F.col("doc_id").alias("_id"), (F.col("quality") == 0).alias("bad"))
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"), "left_semi")
    counted = text_statistics(chosen).filter(~base_failed())
    one = counted.groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("c")).select("doc_id", "c.*")
    rows = one.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("doc_id", "bad", *[feature(f).alias(f"f_{f}") for f in FEATURES])
    got = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3))).orderBy("doc_id").toPandas()
    values = got[[f"f_{f}" for f in FEATURES]].to_numpy(float).reshape(-1, len(FEATURES))
    return learn(values, got["bad"].to_numpy(bool), got["part"].to_numpy() == 0)


def apply_rules(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``text_statistics`` with ``base_failed``, ``rule`` (number of the rule that holds, 0 if none) and ``kept``."""
    judged = text_statistics(docs).withColumn("base_failed", base_failed()).withColumn("rule", rules.rule_number())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
