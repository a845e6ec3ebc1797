"""Hashes of byte windows against plain arithmetic and windows made to be alike."""

import numpy as np

from ctxloom.llm import suffix_dedup
from ctxloom.llm.suffix_dedup import LENGTH, WindowHashes


def test_residues_are_the_polynomials_of_the_bytes(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 512)
    data = np.random.default_rng(1).integers(0, 256, 3000, np.uint8)
    starts = np.arange(0, len(data) - LENGTH + 1, 7)
    hashes = WindowHashes(5)
    prime, bases = suffix_dedup._PRIME, [int(p[1]) for p in hashes.powers]
    values = [int(v) for v in hashes.of_byte[data]]
    got = hashes.residues(data, starts, LENGTH)
    for k, base in enumerate(bases):
        want = [sum(v * pow(base, i, prime) for i, v in enumerate(values[s : s + LENGTH])) % prime for s in starts]
        assert got[k].tolist() == want


def _twins(order):
    """Two texts whose sums of powers agree modulo a power of two far beyond their size, for every odd base."""
    one, other = b"a", b"b"
    for _ in range(order):
        one, other = one + other, other + one
    return one, other


def test_hashes_differ_where_windows_differ_by_a_made_pattern():
    for order in (5, 6, 7):
        one, other = _twins(order)
        windows = [w.ljust(LENGTH, b".")[:LENGTH] for w in (one, other, one + other, other + one)]
        data = np.frombuffer(b"".join(windows), np.uint8)
        starts = np.arange(len(windows)) * LENGTH
        for seed in range(20):
            first, second = WindowHashes(seed).at(data, starts, LENGTH)
            kinds = len(set(windows))
            assert len(set(first.tolist())) == kinds and len(set(second.tolist())) == kinds


def test_equal_windows_have_equal_hashes_wherever_they_are():
    rng = np.random.default_rng(2)
    window = rng.integers(0, 256, LENGTH, np.uint8)
    gap = rng.integers(0, 256, suffix_dedup._SEGMENT - 50, np.uint8)
    data = np.concatenate([window, gap, window, gap, window])
    starts = np.array([0, LENGTH + len(gap), 2 * (LENGTH + len(gap))])
    for h in WindowHashes(9).at(data, starts, LENGTH):
        assert len(set(h.tolist())) == 1
