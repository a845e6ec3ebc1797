"""Near-duplicates by SimHash: Golay-code keys find all fingerprints that differ in few bits."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import stored, texts, with_doc_id, worker_state
from ctxloom.llm.components import connected_components
from ctxloom.runtime import ship_package

SHINGLE = 4
MAX_BITS = 4
_SEED = 42
_CHUNK = 1 << 16
# Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, which generates the binary Golay code of length 23.
_GENERATOR = 0b110001110101
_PIECE = (1 << 23) - 1
_RECENT = 1 << 20


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is set if it is set in more than half of the shingles' hashes, repeats included."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    width = min(shingle, len(words))
    starts = [0, *ends[: len(words) - width]]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at + width - 1 : at + width - 1 + _CHUNK], strict=True)
        hashes = np.array([digest(joined[a : b - 1], _SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = counts * 2 > len(starts)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, the fingerprint as a signed long. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("simhash", GolayKeys)
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, with_doc_id(docs, "fp bigint"))


# ---------------------------------------------------------------- Golay keys


def _remainders() -> np.ndarray:
    """Syndrome of each 12-bit head, followed by eleven zeros."""
    out = np.zeros(1 << 12, np.int64)
    for head in range(1 << 12):
        rest = head << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= _GENERATOR << (bit - 11)
        out[head] = rest
    return out


def _error_patterns(remainders: np.ndarray) -> np.ndarray:
    """For each syndrome the errors of up to 4 bits that cause it: one of 3 bits or less, and none or five of 4; -1 fills."""
    out = np.full((1 << 11, 6), -1, np.int64)
    used = np.zeros(1 << 11, np.int64)
    for weight in range(5):
        for bits in itertools.combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            syndrome = int(remainders[error >> 11]) ^ (error & 0x7FF)
            out[syndrome, used[syndrome]] = error
            used[syndrome] += 1
    return out


class GolayKeys:
    """Numbers of the codewords within 4 bits of a 23-bit piece: one, or six where the nearest is 3 bits away.

    The code is perfect: every piece is within 3 bits of one codeword. Two pieces that differ in up to 2
    bits have a piece between them at 1 bit or less from each, whose codeword is within 4 bits of both, so
    they share a number.
    """

    def __init__(self) -> None:
        self.remainders = _remainders()
        self.errors = _error_patterns(self.remainders)

    def numbers(self, pieces: np.ndarray) -> np.ndarray:
        """(n, 6) numbers below 4096, -1 where there is none."""
        errors = self.errors[self.remainders[pieces >> 11] ^ (pieces & 0x7FF)]
        return np.where(errors < 0, -1, (pieces[:, None] ^ errors) >> 11)

    def keys(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) such that fingerprints that differ in 4 bits or less share a key.

        Pieces A and B have 23 bits, C has 18 (and five zeros). Of 4 differing bits,
        - none in C: A or B has at most 2, so C and a number of A or B agree;
        - else A and B have 3 together. If one of them has none, the other has 2 at most, or else C has 1:
          the one and a number of the other or of C agree;
        - else both have 1 or 2 and C at most 2: a number of each and one of three thirds of C agree.
        """
        v = fps.view(np.int64)
        a, b, c = v & _PIECE, (v >> 23) & _PIECE, (v >> 46) & 0x3FFFF
        na, nb, nc = self.numbers(a), self.numbers(b), self.numbers(c)
        rows, keys = [], []

        def add(tag: int, exact: np.ndarray, numbers: np.ndarray) -> None:
            row, col = np.nonzero(numbers >= 0)
            rows.append(row)
            keys.append(tag << 58 | exact[row] << 24 | numbers[row, col])

        for tag, exact, numbers in ((1, c, na), (2, c, nb), (3, a, nb), (4, a, nc), (5, b, na), (6, b, nc)):
            add(tag, exact, numbers)
        pairs = np.where((na < 0)[:, :, None] | (nb < 0)[:, None, :], -1, na[:, :, None] << 12 | nb[:, None, :])
        for third in range(3):
            add(7 + third, (c >> 6 * third) & 0x3F, pairs.reshape(len(v), 36))
        return np.concatenate(rows), np.concatenate(keys)


# ---------------------------------------------------------------- links


def _near(one: np.uint64, many: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(many ^ one) <= bits


def spanning_links(members: np.ndarray, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links between distinct fingerprints that hold together whatever links of up to ``bits`` bits hold together.

    A centre is compared with all members and takes in those near it, until none is left over. Centres
    near a member of another's class join the two; classes still apart are compared in full. A family
    of copies costs a few passes and as many links as it has members, not all pairs.
    """
    n = len(members)
    if n == 2:
        return [(0, 1)] if _near(members[0], members[1:], bits)[0] else []
    label, out = np.full(n, -1), []
    for i in range(n):
        if label[i] >= 0:
            continue
        near = np.nonzero(_near(members[i], members, bits))[0]
        classes = np.unique(label[near])
        for other in classes[classes >= 0]:
            out.append((i, int(near[label[near] == other][0])))
            label[label == other] = i
        fresh = near[label[near] < 0]
        out += [(i, int(j)) for j in fresh if j != i]
        label[fresh] = i
    for root in np.unique(label):
        while True:
            mine, rest = np.nonzero(label == root)[0], np.nonzero(label != root)[0]
            met = None
            for i in mine if len(mine) <= len(rest) else rest:
                against = rest if len(mine) <= len(rest) else mine
                hit = np.nonzero(_near(members[i], members[against], bits))[0]
                if len(hit):
                    met = (int(i), int(against[hit[0]]))
                    break
            if met is None:
                break
            out.append(met)
            label[label == label[met[0] if label[met[0]] != root else met[1]]] = root
    return out


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal keys; rows come sorted by key, and a run may cross batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    recent: set[tuple[int, int]] = set()

    def links_of(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        borders = np.concatenate([[0], np.nonzero(np.diff(keys))[0] + 1, [len(keys)]])
        size = np.diff(borders)
        two = borders[:-1][size == 2]
        near = np.bitwise_count(fps[two] ^ fps[two + 1]) <= MAX_BITS
        found = list(zip(fps[two[near]].view(np.int64).tolist(), fps[two[near] + 1].view(np.int64).tolist()))
        for at, n in zip(borders[:-1][size > 2].tolist(), size[size > 2].tolist()):
            own = fps[at : at + n]
            signed = own.view(np.int64)
            found += [(int(signed[i]), int(signed[j])) for i, j in spanning_links(own)]
        found = [(min(x), max(x)) for x in found]
        fresh = [x for x in dict.fromkeys(found) if x not in recent]
        if len(recent) > _RECENT:
            recent.clear()
        recent.update(fresh)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in fresh], pa.int64()) for i in (0, 1)], schema=schema)

    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
        if not len(keys) or keys[0] == keys[-1]:
            continue
        last = int(np.searchsorted(keys, keys[-1]))  # keys are sorted
        yield links_of(keys[:last], fps[:last])
        keys, fps = keys[last:].copy(), fps[last:].copy()
    if len(keys):
        yield links_of(keys, fps)


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints ``fp`` just as all links of up to 4 bits would."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = worker_state("simhash", GolayKeys)
        for batch in batches:
            column = batch.column("fp").to_numpy()
            for at in range(0, len(column), 4096):
                part = column[at : at + 4096].view(np.uint64)
                rows, keys = golay.keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part.view(np.int64)[rows])], ["key", "fp"])

    ship_package(fps.sparkSession)
    keyed = fps.mapInArrow(spread, "key bigint, fp bigint")
    grouped = keyed.repartition("key").sortWithinPartitions("key", "fp")
    return grouped.mapInArrow(_linked, "a bigint, b bigint").distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links of fingerprints with up to 4 differing bits.

    One row per row of ``docs``, whose other columns are not looked at. Texts without words, null ones
    included, have fingerprint zero and link like any other. A null doc_id keeps its row and never is a
    component_id unless the whole component has none. Rows with equal fingerprints are one node of the
    graph, so copies cost nothing, however many there are.
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(fingerprint_links(nodes.select("fp")))
    classes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    classes = stored(classes.select("fp", "least", F.coalesce("root", "fp").alias("root")), "classes")
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicates_removed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component stays, the one with the smallest doc_id.

    All columns pass through. Rows that repeat that doc_id are kept together. Rows without a doc_id cannot
    be named, so they all stay.
    """
    stay = simhash_components(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("_stay")).distinct()
    packed = docs.select(F.col("doc_id").alias("_id"), F.struct("*").alias("_row"))
    joined = packed.join(stay, F.col("_id") == F.col("_stay"), "left")
    return joined.filter("_id is null or _stay is not null").select("_row.*")
