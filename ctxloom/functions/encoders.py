"""Catalyst-only encoders, for tables whose token ids must be checkable in plain SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_VOCAB = 50000


def encode_bytes(text: Column) -> Column:
    """UTF-8 bytes as ids 0..255."""
    pairs = F.regexp_extract_all(F.hex(F.encode(text, "UTF-8")), F.lit(".."), F.lit(0))
    return F.transform(pairs, lambda p: F.conv(p, 16, 10).cast("int"))


def byte_count(text: Column) -> Column:
    """Length of ``encode_bytes`` without building it."""
    return F.octet_length(text)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, " "), "")


def encode_word_hash(text: Column) -> Column:
    """Blank-separated words hashed to ids 1..50000 (0 stays free for the end-of-text id)."""
    return F.transform(
        _words(text),
        lambda w: (F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int") % HASH_VOCAB + 1),
    )


def word_count(text: Column) -> Column:
    """Length of ``encode_word_hash`` without hashing a word."""
    return F.size(_words(text))
