"""What several corpus operators share: table reads, held-out folds, byte tables and word hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANK = re.compile(rb"[\x20\x09-\x0D]")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
STEP = 0xD6E8FEB86659FD93
STEP_INVERSE = pow(STEP, -1, 2**64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def utf8(column: str) -> Column:
    """The text's bytes, NULL read as empty. Python then sees bytes and decodes only where it has to."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def byte_table(keep: str, lower: bool = False) -> bytes:
    """A ``bytes.translate`` table that blanks every byte outside the regular expression class ``keep``."""
    inside = re.compile(b"[" + keep.encode("latin-1") + b"]")
    kept = [b if inside.match(bytes([b])) else 32 for b in range(256)]
    return bytes(b + 32 if lower and 65 <= b <= 90 else b for b in kept)


#: Words are runs of ASCII letters and digits and of bytes above 0x7F.
WORD_TABLE = byte_table(r"0-9A-Za-z\x80-\xff", lower=True)


def folded(text: bytes) -> bytes:
    """Lower case, every other byte than a word's blanked."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode("utf-8", "replace")
    return text.translate(WORD_TABLE)


def word_runs(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between ASCII blanks, some ``size`` bytes of text at a time, so that a long text needs no long list."""
    start = 0
    while start < len(text):
        cut = BLANK.search(text, start + size) if start + size < len(text) else None
        stop = cut.start() if cut else len(text)
        yield text[start:stop].split()
        start = stop


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = (values ^ (values >> np.uint64(32))) * MULTIPLIER
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if count else out


class PrefixHash:
    """Polynomial hashes of any byte range of a buffer, modulo 2**64, by prefix sums over randomised byte codes."""

    _tables: dict[int, np.ndarray] = {}
    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        step = pow(STEP, 2 * seed + 1, 2**64)
        if seed not in self._tables:
            codes = np.arange(1, 257, dtype=np.uint64) + np.uint64(1000 * seed)
            self._tables[seed] = mixed(codes * MULTIPLIER) | np.uint64(1)
        have = self._powers.get(seed)
        if have is None or len(have[0]) <= len(data):
            room = max(1 << 16, 1 << (len(data) + 1).bit_length())
            have = self._powers[seed] = (powers(step, room), powers(pow(step, -1, 2**64), room))
        self.inverse = have[1]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._tables[seed][data] * have[0][: len(data)], out=self.sums[1:])

    @staticmethod
    def spread(values: np.ndarray) -> np.ndarray:
        return mixed(values.astype(np.uint64) * MULTIPLIER)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.inverse[start])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no ASCII blank."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
