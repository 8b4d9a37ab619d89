"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector's residual to the mean is normalised, padded with zeros, rotated at random and kept as one sign bit per
rotated dimension, with two scalars: the residual's length and how much of it the code holds. A query is rotated
alike and cut into four bit planes. The bits that a code and a plane share, counted on packed words, give
with the scalars an estimate of the inner product and a bound on its error. A vector is reranked on its original
components wherever estimate plus bound reaches the query's k-th best score known so far.

Several bits per dimension make the bound narrow: its width falls with the root of the number of bits.

Queries are a stated set and go out in blocks of bounded size; every block meets every indexed row. A query
starts from its k-th best score within a bounded sample of rows, found in the tasks that read the queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.session import materialise

NEAREST = 20
CONFIDENCE = 3.0  # standard errors in the bound; 1.9 already misses few
BITS_PER_DIMENSION, MOST_BITS = 8, 1024  # beyond that many dimensions a code has one bit for each
PLANES = 4  # bits of a query's rotated components
QUERY_BLOCK = 16_384
SAMPLE_ROWS = 4096  # rows that give the mean and each query's first threshold
TILE = 256  # rows and queries whose codes are compared at once
PAIRS = 1 << 15  # pairs reranked at once
HELD = 1 << 18  # scores a task keeps before it cuts them to the best of each query
SEED = 11
CODES = "vec_id long, embedding array<float>, code binary, length double, held double"


@dataclass(frozen=True)
class Planes:
    """Queries cut into bit planes: component = low + step * (sum of 2**p over the planes p that have its bit)."""

    words: np.ndarray  # plane, query, word
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray  # of a query's rotated components, as cut
    lost: np.ndarray  # length of what the cut lost
    centre: np.ndarray  # inner product with the centre
    norm: np.ndarray


@dataclass(frozen=True)
class Rotation:
    """What the codes of all rows share."""

    centre: np.ndarray
    matrix: np.ndarray  # width x bits, its rows orthonormal

    @classmethod
    def of(cls, sample: np.ndarray, seed: int = SEED) -> Rotation:
        width = sample.shape[1]
        bits = -(-max(width, min(BITS_PER_DIMENSION * width, MOST_BITS)) // 64) * 64
        q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, width)))
        return cls(sample.mean(0), (q * np.sign(np.diag(r))).T)

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed sign bits, residual lengths, and the inner product of each unit residual with its code."""
        residual = vectors - self.centre
        length = np.sqrt((residual * residual).sum(1))
        turned = residual @ self.matrix / np.where(length > 0, length, 1)[:, None]
        held = np.abs(turned).sum(1) / np.sqrt(self.matrix.shape[1])
        return np.packbits(turned > 0, axis=1), length, held

    def planes(self, queries: np.ndarray) -> Planes:
        turned = queries @ self.matrix
        low, high = turned.min(1), turned.max(1)
        step = np.where(high > low, (high - low) / ((1 << PLANES) - 1), 1.0)
        cut = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
        words = np.stack([np.packbits(cut >> p & 1, axis=1).view(np.uint64) for p in range(PLANES)])
        kept = low[:, None] + step[:, None] * cut
        lost = np.sqrt(((turned - kept) ** 2).sum(1))
        return Planes(words, low, step, kept.sum(1), lost, queries @ self.centre, np.sqrt((queries * queries).sum(1)))

    def reach(self, codes: np.ndarray, length: np.ndarray, held: np.ndarray, planes: Planes, some: slice, confidence: float) -> np.ndarray:
        """For each row and query of a slice: the estimated inner product plus its error bound."""
        bits = self.matrix.shape[1]
        words = planes.words[:, some]
        shared = np.zeros((len(codes), words.shape[1]), np.int32)
        for w in range(words.shape[2]):
            for p in range(PLANES):
                shared += np.left_shift(np.bitwise_count(codes[:, w, None] & words[p, None, :, w]), p, dtype=np.int32)
        ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
        # The sum of a query's components where the code's bit is 1, then twice that less the sum of all.
        signed = 2 * (planes.low[some][None, :] * ones[:, None] + planes.step[some][None, :] * shared) - planes.total[some][None, :]
        safe = np.where(held > 0, held, 1)
        scale = length / safe / np.sqrt(bits)
        spread = np.sqrt(np.maximum(0, 1 - held**2) / max(1, bits - 1) * bits)
        error = np.sqrt((spread[:, None] * planes.norm[some][None, :]) ** 2 + planes.lost[some][None, :] ** 2)
        out = planes.centre[some][None, :] + scale[:, None] * (signed + confidence * error)
        return out + 1e-9 * (1 + np.abs(out))  # sums in another order round differently


def exact(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, added up component after component."""
    total = np.zeros(len(rows))
    for k in range(rows.shape[1]):
        total += rows[:, k] * queries[:, k]
    return total


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part: an id and a vector of finite components that are not all zero."""
    held = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    whole = F.forall("embedding", lambda x: F.coalesce(finite(x), F.lit(False)))
    return held.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole & F.exists("embedding", lambda x: x != 0))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(-1, width)


def index(vectors: DataFrame, rotation: Rotation) -> DataFrame:
    """Every usable row with its code and scalars."""
    width = len(rotation.centre)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, length, held = rotation.encode(_matrix(batch["embedding"], width))
            yield batch.assign(code=[c.tobytes() for c in codes], length=length, held=held)

    return materialise(vectors.mapInPandas(coded, CODES), "one-bit-codes")


def with_floor(queries: DataFrame, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> DataFrame:
    """Queries with the k-th best exact score among the sample, the query itself left out; minus infinity for want of k."""
    shared = queries.sparkSession.sparkContext.broadcast((sample_ids, sample))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample_ids, sample = shared.value
        for batch in batches:
            ids, vectors = batch["vec_id"].to_numpy(), _matrix(batch["embedding"], sample.shape[1])
            floor = np.full(len(ids), -np.inf)
            for first in range(0, len(ids) if len(sample_ids) > k else 0, TILE):
                part = slice(first, first + TILE)
                # A product of matrices adds up in another order than `exact`; the floor gives way by more than that.
                scores = vectors[part] @ sample.T
                scores[ids[part][:, None] == sample_ids[None, :]] = -np.inf
                best = np.partition(scores, -k, axis=1)[:, -k]
                floor[part] = best - 1e-9 * (1 + np.abs(best))
            yield batch.assign(floor=floor)

    return queries.mapInPandas(run, "vec_id long, embedding array<float>, floor double")


class Best:
    """A task's best rows per query, and the score a further row has to reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k, self.parts, self.size = floor.copy(), k, [], 0
        self.at, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.floor[at]
        self.parts.append((at[good], ids[good], scores[good]))
        self.size += int(good.sum())
        if self.size >= HELD:
            self.cut()

    def cut(self) -> None:
        at, ids, scores = (np.concatenate(x) for x in zip((self.at, self.ids, self.scores), *self.parts))
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        kth = rank == self.k - 1
        self.floor[at[kth]] = np.maximum(self.floor[at[kth]], scores[kth])
        keep = rank < self.k
        self.at, self.ids, self.scores = at[keep], ids[keep], scores[keep]
        self.parts, self.size = [], 0


def search_block(indexed: DataFrame, rotation: Rotation, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int, confidence: float) -> DataFrame:
    """(query_id, vec_id, score): for one block of queries, from each task at most k rows per query."""
    shared = indexed.sparkSession.sparkContext.broadcast((rotation, ids, queries, floor))

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rotation, ids, queries, floor = shared.value
        best, planes = Best(floor, k), rotation.planes(queries)
        for batch in batches:
            rows, names = _matrix(batch["embedding"], queries.shape[1]), batch["vec_id"].to_numpy()
            codes = np.frombuffer(b"".join(batch["code"]), np.uint64).reshape(len(batch), -1)
            length, held = batch["length"].to_numpy(), batch["held"].to_numpy()
            for a in range(0, len(batch), TILE):
                for b in range(0, len(ids), TILE):
                    part, some = slice(a, a + TILE), slice(b, b + TILE)
                    reach = rotation.reach(codes[part], length[part], held[part], planes, some, confidence)
                    row, at = np.nonzero((reach >= best.floor[some][None, :]) & (names[part][:, None] != ids[some][None, :]))
                    for first in range(0, len(row), PAIRS):
                        r, q = row[first : first + PAIRS] + a, at[first : first + PAIRS] + b
                        best.add(q, names[r], exact(rows[r], queries[q]))
        best.cut()
        yield pd.DataFrame({"query_id": ids[best.at], "vec_id": best.ids, "score": best.scores})

    return indexed.mapInPandas(searched, "query_id long, vec_id long, score double")


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST,
    confidence: float = CONFIDENCE, query_block: int = QUERY_BLOCK, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest rows by inner product, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``. Vectors that are NULL, zero or hold a NULL or non-finite component,
    and rows without id, take no part; vectors of another length than the first usable one raise an error.
    Rows that repeat an id are candidates of their own, but never of a query of that id. Other columns are
    ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    total = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    share = min(1.0, sample_rows / total)
    drawn = rows if share == 1 else rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = drawn.toPandas()
    width = len(sample["embedding"].iloc[0]) if len(sample) else len(rows.first()["embedding"])
    known = _matrix(sample["embedding"], width)
    rotation = Rotation.of(known if len(known) else np.zeros((1, width)))
    indexed = index(rows, rotation)
    asked = with_floor(indexed.where(is_query).select("vec_id", "embedding"), sample["vec_id"].to_numpy(), known, k)
    asked = materialise(asked, "search-queries")
    blocks = -(-asked.count() // query_block)
    found = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).dropDuplicates(["vec_id"]).orderBy("vec_id").toPandas()
        if not len(part):
            continue
        ids, queries = part["vec_id"].to_numpy(), _matrix(part["embedding"], width)
        hits = search_block(indexed, rotation, ids, queries, part["floor"].to_numpy(), k, confidence)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = materialise(ranked.select("query_id", "rank", "vec_id", "score"), "nearest")
        found = ranked if found is None else found.unionAll(ranked)
    return empty if found is None else found
