"""Near duplicates by SimHash: 64-bit fingerprints of word shingles, compared exactly in tiles.

Fingerprints are grouped into tiles by the population counts of their two halves. Two fingerprints within
``radius`` bits differ by at most ``radius`` in the two counts together, so only tiles that near each other
are paired; a pair is compared whole by exclusive-or and bit counts. A pair of tiles gives no pairs of
rows but a star per group that it links, so copies and dense groups cost a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ordermill.llm.common import utf8, word_runs
from ordermill.session import materialise

SHINGLE, RADIUS, SEED = 3, 3, 42
TILE_ROWS = 1 << 16
BLOCK = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The signed 64-bit fingerprint: a bit is set where over half the shingles' hashes set it; 0 without words."""
    ones, total, last = np.zeros(64, np.int64), 0, []
    for words in word_runs(text.lower()):
        words = last + words
        if len(words) >= shingle:
            texts = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, texts, repeat(seed)), np.uint64)
            for start in range(0, len(hashes), 4096):
                part = hashes[start : start + 4096]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.uint16)
            total += len(hashes)
        last = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if not total and last:
        value = np.array([xxhash.xxh64_intdigest(b" ".join(last), seed)], np.uint64)
        return int(value.view(np.int64)[0])
    packed = np.packbits(2 * ones > total, bitorder="little") if total else np.zeros(8, np.uint8)
    return int(packed.view(np.int64)[0])


def fingerprint_column(text: str, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    @pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(x, shingle, seed) for x in batch], dtype="int64")

    return of(utf8(text))


def unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the groups of each pair in ``label``, which holds the smallest index of every index's group."""
    while len(left):
        a, b = label[left], label[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def _ordered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values sorted by the bit counts of their four 16-bit words, and those counts."""
    counts = np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int16)
    order = np.lexsort(counts.T)
    return values[order], counts[order]


def _ranges(counts: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    return [(k, counts[k : k + BLOCK].min(0), counts[k : k + BLOCK].max(0)) for k in range(0, len(counts), BLOCK)]


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles of distinct values (within one tile if ``right`` is None), as stars.

    Every value is linked to the first value of its group, so the links number fewer than the values.
    """
    left, left_counts = _ordered(left)
    same = right is None
    right, right_counts = (left, left_counts) if same else _ordered(right)
    values = left if same else np.concatenate([left, right])
    shift = 0 if same else len(left)
    label = np.arange(len(values))
    others = _ranges(right_counts)
    for i, low, high in _ranges(left_counts):
        for j, other_low, other_high in others:
            if same and j < i:
                continue
            if np.maximum(0, np.maximum(low - other_high, other_low - high)).sum() > radius:
                continue
            near = np.bitwise_count(left[i : i + BLOCK, None] ^ right[None, j : j + BLOCK]) <= radius
            a, b = np.nonzero(near)
            if same and i == j:
                a, b = a[a < b], b[a < b]
            unite(label, a + i, b + j + shift)
    member = np.flatnonzero(label != np.arange(len(label)))
    return values[member], values[label[member]]


def links(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b) over distinct fingerprints ``fp``: connects exactly what chains of links connect.

    A cell of population counts with more than ``tile_rows`` values is cut into several tiles by hash.
    """
    spark = prints.sparkSession
    celled = prints.select(
        "fp",
        F.bit_count(F.shiftrightunsigned("fp", 32)).alias("high"),
        F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    )
    # At most 33 x 33 rows, whatever the number of documents.
    cells = celled.groupBy("high", "low").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles")).collect()
    if not cells:
        return spark.createDataFrame([], "a long, b long")
    near = spark.createDataFrame(
        [
            (a["high"], a["low"], a["tiles"], b["high"] * 64 + b["low"], b["tiles"])
            for a in cells
            for b in cells
            if abs(a["high"] - b["high"]) + abs(a["low"] - b["low"]) <= radius
        ],
        "high int, low int, own_tiles int, cell int, tiles int",
    )
    own = F.shiftleft((F.col("high") * 64 + F.col("low")).cast("long"), 32) + F.pmod(F.xxhash64("fp"), F.col("own_tiles"))
    paired = (
        celled.join(F.broadcast(near), ["high", "low"])
        .select("fp", own.alias("own"), "cell", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("sub"))
        .select("fp", "own", (F.shiftleft(F.col("cell").cast("long"), 32) + F.col("sub")).alias("other"))
        .select("fp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") <= F.col("other")).alias("first"))
    )

    def compare(rows: pa.Table) -> pa.Table:
        values = rows["fp"].to_numpy().view(np.uint64)
        first = rows["first"].to_numpy(zero_copy_only=False)
        within = rows["x"][0].as_py() == rows["y"][0].as_py()
        a, b = tile_links(values[first], None if within else values[~first], radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return paired.groupBy("x", "y").applyInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable over ``edges`` (a, b), by alternating star contractions.

    Each step aggregates before it joins, and the edges are stored after each round.
    """
    edges = materialise(edges.where("a <> b"), name)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        outward = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = outward.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        inward = down.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(inward.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """One row per document: id, ``fp`` and ``component_id``, the smallest id that links reach.

    NULL, empty and blank texts have fingerprint zero and link like any other; fewer words than a shingle
    make one shingle. Rows that share an id or a text are rows of their own. A NULL id is larger than any
    id, so a group has a NULL component only if none of its rows has an id. Other columns are ignored; an
    empty table gives no rows.
    """
    prints = materialise(
        docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(text_col, shingle).alias("fp")), "fingerprints"
    )
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    distinct = materialise(distinct, "distinct-fingerprints")
    found = components(links(distinct.select("fp"), radius, tile_rows), "simhash-links")
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    # Only linked fingerprints need their group's smallest id; the rest keep their own.
    grouped = rooted.join(found.select(F.col("root")).distinct(), "root")
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(least.withColumn("linked", F.lit(True)), "root", "left").select(
        "fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least_id")).alias("component_id")
    )
    return prints.join(classes, "fp").select(F.col("doc_id").alias(id_col), "fp", "component_id")


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """``docs`` with one document of each group, all its columns as they were.

    The document with the smallest id stays, one without id only if none of the group has one; of rows that share
    it the one with the smallest fingerprint, then the smallest hash of the row. Fingerprints are made once and
    written beside the documents; texts move once.
    """
    row, fp, tie = "__simhash_row", "__simhash_fp", "__simhash_tie"
    numbered = docs.withColumns(
        {fp: fingerprint_column(text_col, shingle), tie: F.xxhash64(*docs.columns), row: F.monotonically_increasing_id()}
    )
    # Written once, so that a row's number is the same for all that follows.
    printed = materialise(numbered, "printed-documents")
    first = F.min(F.struct(F.col(id_col).isNull().alias("nameless"), F.col(id_col).alias("id"), fp, tie, row)).alias("first")
    # Within a fingerprint first, on the map side: a group of copies of any size is one row from there on.
    distinct = materialise(printed.groupBy(F.col(fp).alias("fp")).agg(first), "distinct-fingerprints")
    found = components(links(distinct.select("fp"), radius, tile_rows), "simhash-links")
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    kept = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    survivors = kept.select(F.col(f"first.{row}").alias(row))
    return printed.join(survivors.hint("shuffle_hash"), row, "left_semi").select(*docs.columns)
