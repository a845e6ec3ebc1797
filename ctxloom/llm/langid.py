"""Language identification by unigrams over a fixed vocabulary, summed over all segmentations.

Each language gives every piece of a public vocabulary a probability. A word's probability is the sum over
all ways to cut it into pieces (a forward pass over its lattice), a text's is the product over its words.
Training is expectation maximisation over the same lattices.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import release_memory, stored, texts, worker_state
from ctxloom.runtime import ship_package

UNKNOWN = "und"
TRAINING_TEXTS = 1000  # about as many different texts of each language are learnt from
ROUNDS = 3
_SMOOTHING = 0.1
_LONG_WORD = 64  # letters; a longer word's lattice is walked place by place, to the same sums
_CELLS = 1 << 20
_REMEMBERED_WORDS = 3 << 17
_REMEMBERED_LETTERS = 1 << 25
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _bytes_of(word: str) -> bytes:
    """A space before each word stands for its beginning."""
    return b" " + word.encode("utf-8", "replace")


class Pieces(dict):
    """Piece to number; ``reach`` has the length of the longest piece that begins with the given two bytes."""

    def __init__(self, numbers: dict[bytes, int]) -> None:
        super().__init__(numbers)
        self.reach: dict[bytes, int] = {}
        for piece in self:
            self.reach[piece[:2]] = max(len(piece), self.reach.get(piece[:2], 1))
        self.longest = max(map(len, self), default=1)

    @classmethod
    def of(cls, numbers: dict[bytes, int]) -> Pieces:
        return numbers if isinstance(numbers, cls) else cls(numbers)

    def at(self, data: bytes, start: int) -> list[tuple[int, int]]:
        """(end, number) of each piece of the data at this place."""
        get = self.get
        stop = min(len(data), start + self.reach.get(data[start : start + 2], 1))
        found = [(end, get(data[start:end])) for end in range(start + 1, stop + 1)]
        return [e for e in found if e[1] is not None]


@dataclass
class Lattice:
    """Edges of many words' segmentations: pieces from a start to an end, sorted by end."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    length: np.ndarray  # bytes of each word


def lattice(words: list[str], pieces: Pieces) -> Lattice:
    edges: list[tuple[int, int, int, int]] = []
    get, reach = pieces.get, pieces.reach.get
    lengths = []
    for k, word in enumerate(words):
        data = _bytes_of(word)
        n = len(data)
        lengths.append(n)
        for start in range(n):
            for end in range(start + 1, min(n, start + reach(data[start : start + 2], 1)) + 1):
                piece = get(data[start:end])
                if piece is not None:
                    edges.append((k, start, end, piece))
    table = np.array(edges, np.int32).reshape(-1, 4)
    table = table[np.lexsort((table[:, 0], table[:, 2]))]
    return Lattice(*table.T, np.array(lengths, np.int64))


def _sum_by(group: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of sums over runs of equal groups."""
    first = np.concatenate([[0], np.nonzero(np.diff(group))[0] + 1])
    most = np.maximum.reduceat(values, first, axis=0)
    size = np.diff(np.append(first, len(group)))
    total = np.add.reduceat(np.exp(values - np.repeat(most, size, axis=0)), first, axis=0)
    return group[first], most + np.log(total)


def forward(lat: Lattice, log_p: np.ndarray) -> np.ndarray:
    """(words, bytes + 1, languages): log probability of each beginning of each word."""
    n = len(lat.length)
    alpha = np.full((n, int(lat.length.max(initial=0)) + 1, log_p.shape[1]), -np.inf)
    alpha[:, 0] = 0.0
    cuts = np.searchsorted(lat.end, np.arange(1, alpha.shape[1] + 1))
    for end in range(1, alpha.shape[1]):
        own = slice(cuts[end - 1], cuts[end])
        if own.start == own.stop:
            continue
        word, value = _sum_by(lat.word[own], alpha[lat.word[own], lat.start[own]] + log_p[lat.piece[own]])
        alpha[word, end] = value
    return alpha


def long_word_score(word: str, pieces: Pieces, log_p: np.ndarray) -> np.ndarray:
    """(languages): the forward pass over one word, holding no more places than the longest piece spans."""
    data = _bytes_of(word)
    size = pieces.longest + 1
    alpha = np.full((size, log_p.shape[1]), -np.inf)
    alpha[0] = 0.0
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(size)]  # (start, piece), by end
    for start in range(len(data)):
        for end, piece in pieces.at(data, start):
            waiting[end % size].append((start % size, piece))
        end = (start + 1) % size
        starts, numbers = zip(*waiting[end], strict=True) if waiting[end] else ((), ())
        alpha[end] = np.logaddexp.reduce(alpha[list(starts)] + log_p[list(numbers)], axis=0) if starts else -np.inf
        waiting[end] = []
    return alpha[len(data) % size]


def word_scores(words: list[str], pieces: dict[bytes, int], log_p: np.ndarray) -> np.ndarray:
    """(words, languages): log probability of each word, all segmentations taken together."""
    pieces = Pieces.of(pieces)
    out = np.zeros((len(words), log_p.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    while order and len(words[order[-1]]) > _LONG_WORD:
        last = order.pop()
        out[last] = long_word_score(words[last], pieces, log_p)
    while order:
        step = max(1, min(4096, _CELLS // ((4 * len(words[order[min(len(order), 4096) - 1]]) + 2) * log_p.shape[1])))
        part, order = order[:step], order[step:]
        lat = lattice([words[i] for i in part], pieces)
        alpha = forward(lat, log_p)
        out[part] = alpha[np.arange(len(part)), lat.length]
    return out


def _count_long_word(word: str, weight: float, pieces: Pieces, log_p: np.ndarray, out: np.ndarray) -> None:
    """Adds one long word's expected counts: a backward pass, then each place's share of all segmentations."""
    data = _bytes_of(word)
    n = len(data)
    beta = np.full(n + 1, -np.inf)
    beta[n] = 0.0
    for start in range(n - 1, -1, -1):
        if own := pieces.at(data, start):
            ends, numbers = map(list, zip(*own, strict=True))
            beta[start] = np.logaddexp.reduce(log_p[numbers, 0] + beta[ends])
    share = np.zeros(n + 1)
    share[0] = weight
    for start in range(n):
        if share[start] and (own := pieces.at(data, start)):
            ends, numbers = map(list, zip(*own, strict=True))
            flow = share[start] * np.exp(log_p[numbers, 0] + beta[ends] - beta[start])
            share[ends] += flow
            out[numbers] += flow


def expected_counts(words: list[str], weights: np.ndarray, pieces: dict[bytes, int], log_p: np.ndarray) -> np.ndarray:
    """How often each piece is used, in expectation over all segmentations; ``log_p`` of one language, as a column."""
    pieces, weights = Pieces.of(pieces), np.asarray(weights)
    long = np.array([len(w) > _LONG_WORD for w in words], bool)
    if long.any():
        short = np.nonzero(~long)[0]
        out = expected_counts([words[i] for i in short], weights[short], pieces, log_p) if len(short) else np.zeros(len(log_p))
        for i in np.nonzero(long)[0]:
            _count_long_word(words[i], float(weights[i]), pieces, log_p, out)
        return out
    lat = lattice(words, pieces)
    alpha = forward(lat, log_p)[:, :, 0]
    n, width = alpha.shape
    # Backward: the same pass over the mirrored lattice.
    length = lat.length[lat.word]
    mirrored = np.lexsort((lat.word, length - lat.start))
    back = Lattice(
        lat.word[mirrored], (length - lat.end)[mirrored], (length - lat.start)[mirrored], lat.piece[mirrored], lat.length
    )
    beta = forward(back, log_p)[:, :, 0]
    total = alpha[np.arange(n), lat.length]
    share = alpha[lat.word, lat.start] + log_p[lat.piece, 0] + beta[lat.word, length - lat.end] - total[lat.word]
    return np.bincount(lat.piece, np.exp(share) * weights[lat.word], minlength=len(log_p))


# ---------------------------------------------------------------- training


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: Pieces
    log_p: np.ndarray  # (pieces, languages)


def _training_texts(labelled: DataFrame, languages: dict[str, int], most: int) -> DataFrame:
    """About ``most`` different texts of each language, chosen by the texts' hashes; ``languages`` has the different texts of each."""
    rate = F.create_map(*[F.lit(x) for lang, n in languages.items() for x in (lang, min(1.0, most / n))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    return labelled.filter(draw < rate[F.col("lang")]).dropDuplicates(["lang", "text"])


def _word_counts(sample: DataFrame, names: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                counts.update((names.index(lang), w) for w in words_of(text))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["lang", "word", "n"],
            )

    rows = sample.select("lang", "text").mapInArrow(run, "lang int, word string, n bigint")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, vocabulary: dict[bytes, int], most: int = TRAINING_TEXTS, rounds: int = ROUNDS) -> LanguageModel:
    """A model of the languages in ``labelled`` (text, lang), learnt from about ``most`` different texts of each.

    The sample's size is the only bound; it is drawn by hash over the whole table. Rows with null text or
    lang are not learnt from. Each round sums expected counts in tasks; a count per piece and language
    reaches the driver. Without any labelled row the model has no language.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    usable = labelled.select("text", "lang").filter("text is not null and lang is not null")
    # Copies count once, as in the sample; an estimate will do for a rate.
    different = F.greatest(F.approx_count_distinct(F.xxhash64("text")), F.lit(1)).alias("n")
    found = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(different).collect()}
    names = sorted(found)
    pieces = Pieces({p: i for i, p in enumerate(sorted(vocabulary))})
    if any(bytes([b]) not in pieces for b in range(256)):
        raise ValueError("a vocabulary with every single byte, so that each word can be segmented")
    log_p = np.full((len(pieces), len(names)), -np.log(len(pieces)))
    if not names:
        return LanguageModel([], pieces, log_p)
    words = stored(_word_counts(_training_texts(usable, found, most), names), "words")
    known = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(log_p)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            table = now.value
            sums = np.zeros(table.shape)
            for batch in batches:
                lang, n = batch.column("lang").to_numpy(), batch.column("n").to_numpy()
                own = batch.column("word").to_pylist()
                order = np.lexsort((np.char.str_len(np.array(own, str)) if own else lang, lang))
                for at in range(0, len(order), 2048):
                    part = order[at : at + 2048]
                    for k in np.unique(lang[part]):
                        mine = part[lang[part] == k]
                        sums[:, k] += expected_counts([own[i] for i in mine], n[mine], known.value, table[:, k : k + 1])
            piece, k = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(k, pa.int32()), pa.array(sums[piece, k])], ["piece", "lang", "n"]
            )
            release_memory()

        sums = words.mapInArrow(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        got = sums.toPandas()
        counts = np.full(log_p.shape, _SMOOTHING)
        counts[got["piece"], got["lang"]] += got["n"]
        log_p = np.log(counts / counts.sum(axis=0))
    return LanguageModel(names, pieces, log_p)


# ---------------------------------------------------------------- prediction


class _Scorer:
    """Scores of texts; keeps those of words seen before, up to a fixed number."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.number: dict[str, int] = {}
        self.letters = 0
        self.table = np.zeros((0, len(model.languages)))

    def scores(self, many: list[str]) -> list[np.ndarray | None]:
        """Log probabilities by language; nothing for texts without letters."""
        if not self.model.languages:
            return [None] * len(many)
        if len(self.number) > _REMEMBERED_WORDS or self.letters > _REMEMBERED_LETTERS:
            self.number, self.letters, self.table = {}, 0, self.table[:0]
        places, fresh = [], []
        for text in many:
            own = words_of(text)
            for w in own:
                if w not in self.number:
                    self.number[w] = len(self.number)
                    fresh.append(w)
            places.append(np.fromiter(map(self.number.__getitem__, own), np.int64, len(own)))
        if fresh:
            self.letters += sum(map(len, fresh))
            self.table = np.concatenate([self.table, word_scores(fresh, self.model.pieces, self.model.log_p)])
        return [self.table[p].sum(axis=0) if len(p) else None for p in places]


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` put after the other columns; only the text decides.

    ``lang_pred`` is a language of the model, the first by name of those that fit equally; ``score`` is its
    posterior probability, all languages being as likely beforehand. Texts that are null or have no letter
    get ``und`` and 0, as does any text under a model without languages. All rows and columns stay; columns
    that already have these names are replaced.
    """
    import uuid

    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = worker_state(name, lambda: _Scorer(shared.value))
        names = scorer.model.languages
        for part in parts:
            found, fits = [], []
            for at in range(0, len(part), 256):
                for s in scorer.scores([t or "" for t in part.slice(at, 256).to_pylist()]):
                    best = None if s is None else int(np.argmax(s))
                    found.append(UNKNOWN if s is None else names[best])
                    fits.append(0.0 if s is None else float(1.0 / np.exp(s - s[best]).sum()))
            yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(fits, pa.float64())], ["lang_pred", "score"])
        release_memory()

    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), score(F.col(text)).alias("_found"))
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("lang_pred", "score")]
    return packed.select(*kept, F.col("_found.lang_pred").alias("lang_pred"), F.col("_found.score").alias("score"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of training: one in five, by its id's checksum. Ids that are null are."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))
