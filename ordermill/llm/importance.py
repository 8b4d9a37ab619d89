"""Importance resampling towards a target corpus by hashed word features.

Features are runs of one to ``longest`` consecutive words, hashed into buckets by CRC-32. Both corpora are counted
by bucket over all their texts; a bucket's gain is its smoothed log ratio, a document's weight the mean gain of its
features. Gumbel noise from a hash of the document's id turns the weights into a draw without replacement: the
highest noisy scores are kept.

CRCs are computed for the distinct features of some megabytes of text at a time. Their bytes are gathered into one
uint8 matrix per length, all rows of a matrix are updated column by column, and the buckets are scattered back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ordermill.llm.common import WORD_TABLE, utf8, word_runs
from ordermill.session import materialise

BUCKETS, LONGEST = 10_000, 2
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
GROUP = 1 << 21  # bytes of text whose features are hashed together
SEGMENT = 256  # bytes of a feature in one matrix row; longer features are several rows
CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_TABLE = np.where(CRC_TABLE & 1, (CRC_TABLE >> 1) ^ np.uint32(0xEDB88320), CRC_TABLE >> 1).astype(np.uint32)


def advance(crc: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes of each row of a uint8 matrix, one column at a time."""
    for column in columns.T:
        crc = CRC_TABLE[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return crc


#: What ``SEGMENT`` zero bytes make of each byte of a register; the register is the exclusive or of its bytes.
_BYTES = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
ZEROS = advance(_BYTES.ravel(), np.zeros((1024, SEGMENT), np.uint8)).reshape(4, 256)


def crc32(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC-32 of many byte ranges of ``data``."""
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    head = length % SEGMENT
    order = np.argsort(head, kind="stable")
    edges = np.flatnonzero(np.diff(head[order], prepend=-1))
    for rows in np.split(order, edges[1:]):
        if len(rows) and head[rows[0]]:
            out[rows] = advance(out[rows], data[start[rows][:, None] + np.arange(head[rows[0]])])
    for row in np.flatnonzero(length >= SEGMENT):
        # All further segments from a register of zero, side by side; then one after another, as registers add up.
        body = data[start[row] + head[row] : start[row] + length[row]].reshape(-1, SEGMENT)
        crc = int(out[row])
        for own in advance(np.zeros(len(body), np.uint32), body).tolist():
            crc = own ^ int(ZEROS[0, crc & 255] ^ ZEROS[1, crc >> 8 & 255] ^ ZEROS[2, crc >> 16 & 255] ^ ZEROS[3, crc >> 24])
        out[row] = crc
    return ~out


class Features:
    """Buckets of the features of some texts' words, text after text."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest = buckets, longest

    def of(self, words: list[bytes], piece: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, bucket) of each feature. Features stay within a piece; those that end in a word that is not ``fresh`` are left out."""
        number: dict[bytes, int] = {}
        for word in words:
            number.setdefault(word, len(number))
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        lengths = np.fromiter(map(len, number), np.int64, len(number))
        # Every distinct word with a blank behind it, so that a run of words is a range of bytes once its words stand together.
        flat = np.frombuffer(b" ".join(number) + b" ", np.uint8)
        offsets = np.cumsum(lengths + 1) - lengths - 1
        owners, found = [], []
        runs = np.arange(len(words))  # where runs of this size start
        code, codes = ids, number  # the run's number among distinct ones
        for size in range(1, self.longest + 1):
            if size > 1:
                runs = runs[runs + size <= len(words)]
                inside = piece[runs] == piece[runs + size - 1]
                runs = runs[inside]
                code = code[: len(inside)][inside] * len(number) + ids[runs + size - 1]
            ends = runs + size - 1
            distinct, first, back = np.unique(code, return_index=True, return_inverse=True)
            members = ids[runs[first][:, None] + np.arange(size)]
            crc = self.hashed(flat, offsets, lengths, members)
            wanted = fresh[ends]
            owners.append(piece[runs][wanted])
            found.append((crc.astype(np.int64) % self.buckets)[back][wanted])
            # Numbers of distinct runs stay small, so that the next size fits 64 bits.
            code = back
        return np.concatenate(owners), np.concatenate(found)

    @staticmethod
    def hashed(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, members: np.ndarray) -> np.ndarray:
        """CRCs of distinct features, each a row of word numbers: their bytes are laid out in one buffer first."""
        if members.shape[1] == 1:
            return crc32(flat, offsets[members[:, 0]], lengths[members[:, 0]])
        sizes = lengths[members].ravel() + 1
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(offsets[members].ravel() - ends + sizes, sizes) if len(sizes) else np.zeros(0, np.int64)
        whole = lengths[members].sum(1) + members.shape[1]
        return crc32(flat[at], np.cumsum(whole) - whole, whole - 1)

    def groups(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For some megabytes of words at a time: row and bucket of each feature, and row and count of fresh words."""
        words: list[bytes] = []
        rows: list[int] = []  # of each piece
        counts: list[int] = []
        carried: list[int] = []
        size = 0

        def take() -> tuple:
            piece = np.repeat(np.arange(len(rows)), counts)
            fresh = np.ones(len(words), bool)
            first = np.cumsum(counts) - counts
            for k in np.flatnonzero(carried):
                fresh[first[k] : first[k] + carried[k]] = False
            owner, bucket = self.of(words, piece, fresh)
            row = np.array(rows)
            return row[owner], bucket, row, np.array(counts) - np.array(carried)

        for row, text in enumerate(texts):
            tail: list[bytes] = []
            for some in word_runs(text.translate(WORD_TABLE), GROUP):
                words += tail + some
                rows.append(row)
                counts.append(len(tail) + len(some))
                carried.append(len(tail))
                size += sum(map(len, some))
                tail = (tail + some)[-(self.longest - 1) :] if self.longest > 1 else []
                if size >= GROUP:
                    yield take()
                    words, rows, counts, carried, size = [], [], [], [], 0
        if words:
            yield take()


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, features) over all texts; a task sends on one row per bucket at most."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, total = Features(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _, _ in features.groups(list(batch["text"])):
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "features": total[held]})

    parts = docs.select(utf8(text_col).alias("text")).mapInPandas(counted, "bucket long, features long")
    return parts.groupBy("bucket").agg(F.sum("features").alias("features"))


def gains(docs: DataFrame, target: DataFrame, text_col: str, target_text: str, buckets: int, longest: int) -> np.ndarray:
    """Each bucket's gain in thousandths: one number per bucket, however large the corpora are."""
    raw = bucket_counts(docs, text_col, buckets, longest).withColumnRenamed("features", "s")
    wanted = bucket_counts(target, target_text, buckets, longest).withColumnRenamed("features", "t")
    counts = raw.join(wanted, "bucket", "full").na.fill(0).toPandas()
    s, t = (np.zeros(buckets, np.int64) for _ in range(2))
    s[counts["bucket"]], t[counts["bucket"]] = counts["s"], counts["t"]
    above, below = (t + 1.0) * (s.sum() + float(buckets)), (s + 1.0) * (t.sum() + float(buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in above / below], np.int64)


def weigh(text: str, gain: np.ndarray, longest: int, spark) -> Column:
    """A struct of n_words, n_features and weight for each text."""
    shared = spark.sparkContext.broadcast(gain)

    @pandas_udf("n_words long, n_features long, weight long")
    def weighed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gain = shared.value
        features = Features(len(gain), longest)
        for batch in batches:
            n_words, n_features, total = (np.zeros(len(batch), np.int64) for _ in range(3))
            for row, bucket, piece_row, words in features.groups(list(batch)):
                np.add.at(n_words, piece_row, words)
                n_features += np.bincount(row, minlength=len(batch))
                # Integers in doubles: exact as long as a group's gains stay below 2**53.
                total += np.bincount(row, weights=gain[bucket], minlength=len(batch)).astype(np.int64)
            yield pd.DataFrame({"n_words": n_words, "n_features": n_features, "weight": total // np.maximum(1, n_features)})

    return weighed(utf8(text))


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
    buckets: int = BUCKETS, longest: int = LONGEST, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (NULL: not drawn).

    Lower case is A-Z only; words are runs of ASCII letters, digits and bytes above 0x7F. ``percent`` of the
    documents with at least ``least_words`` words are drawn, rounded down, highest scores first, ties to the smaller
    id. NULL and empty texts have no features and weigh 0. A NULL id hashes as an empty one and comes last among
    ties; rows that repeat an id share their noise, and rows alike in id and score rank in any order, which
    shows nowhere. An empty target gives every bucket the gain of the raw corpus alone. Other columns
    are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    gain = gains(docs, target, text_col, target_text, buckets, longest)
    held = docs.select(F.col(id_col).alias("doc_id"), weigh(text_col, gain, longest, spark).alias("w"))
    scored = held.select("doc_id", "w.*").withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = materialise(scored, "importance-scores")  # narrow: no text
    eligible = scored.where(F.col("n_words") >= least_words)
    wanted = eligible.count() * percent // 100
    # How many rows score higher. Scores are thousandths of a log, so there are some ten thousands of different
    # ones at any size, and rows of equal score are what is sorted together.
    histogram = eligible.groupBy(F.col("score").alias("at")).agg(F.count("*").alias("rows"))
    higher = F.coalesce(F.sum("rows").over(Window.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = histogram.select("at", higher.alias("higher")).where(F.col("higher") < wanted)
    chosen = scored.join(ahead, (F.col("score") == F.col("at")) & (F.col("n_words") >= least_words), "left")
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    drawn = chosen.where(F.col("at").isNotNull()).withColumn("place", F.col("higher") + place)
    rank = F.when(F.col("place") <= wanted, F.col("place"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    rest = chosen.where(F.col("at").isNull()).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.select(*columns, rank.cast("long").alias("rank")).unionByName(rest)
