"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

A short item inside a long document has next to no Jaccard similarity with it. So items are partitioned by
size, and for each partition documents are seen as overlapping windows of about that partition's size: an
item that stands in a document lies whole in a window at most some three times as large. Item and window
are matched on any of ``HASHES`` minimum hashes. Minima of all window lengths come from those of blocks of
four shingles by doubling. What matches is verified against the whole document's shingles, as bytes.
Items of fewer words than a shingle stand as their whole word sequence, which is looked up directly.

Items are a stated query set: they go out in blocks of bounded size, and every block meets all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ordermill.llm.common import BLANK, PrefixHash, folded, mixed, utf8, word_bounds

SHINGLE, CONTAINMENT = 5, 0.8
HASHES, BLOCK = 64, 4
ITEM_BLOCK_BYTES = 16 << 20  # of item text in one broadcast
CHUNK_BYTES = 1 << 20  # of document text hashed at once
LONG = 1 << 21  # bytes from which on a text is searched in pieces
FACTORS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
MASKS = mixed(np.arange(1001, HASHES + 1001, dtype=np.uint64)).astype(np.uint32)


@dataclass
class Words:
    """The folded words of some texts in one buffer, and the hash of each text's shingles."""

    data: bytes
    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray  # of shingles, text after text
    first: np.ndarray  # of each text: its first shingle, with one entry more for the end
    at: np.ndarray  # of each shingle: its first word

    def shingle(self, k: int, length: int) -> bytes:
        word = self.at[k]
        return b" ".join(self.data[self.starts[word + i] : self.stops[word + i]] for i in range(length))


def shingled(texts: list[bytes], length: int) -> Words:
    parts = [folded(x) for x in texts]
    data = b" ".join(parts)
    codes = np.frombuffer(data, np.uint8)
    starts, stops = word_bounds(codes)
    ends = np.cumsum([len(p) + 1 for p in parts]) if parts else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    counts = np.maximum(0, np.diff(bounds) - length + 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(first[-1]) + np.repeat(bounds[:-1] - first[:-1], counts)
    total = np.zeros(len(at), np.uint64)
    if len(at):
        words = PrefixHash(codes).of(starts, stops)
        for k in range(length):
            total = total * np.uint64(0xD1342543DE82EF95) + words[at + k]
    return Words(data, starts, stops, mixed(total), first, at)


@dataclass
class SizeClass:
    """Items whose windows are ``1 << level`` blocks long; per hash, sorted minima with their items."""

    level: int
    items: np.ndarray
    minima: list[np.ndarray] = field(default_factory=list)
    owners: list[np.ndarray] = field(default_factory=list)
    filters: list[np.ndarray] = field(default_factory=list)


class Items:
    """The searched side: one block of benchmark items, partitioned by size."""

    def __init__(self, ids: list, texts: list[bytes], length: int = SHINGLE):
        words = shingled(texts, length)
        self.ids, self.length, self.longest = ids, length, max(map(len, texts), default=0)
        self.hashes = [np.unique(words.hashes[a:b]) for a, b in zip(words.first, words.first[1:])]
        self.shingles = [{words.shingle(k, length) for k in range(a, b)} for a, b in zip(words.first, words.first[1:])]
        # Items shorter than a shingle: per number of words, sorted hashes of their sequences, and who has each.
        self.short: dict[int, tuple[np.ndarray, dict[bytes, list[int]]]] = {}
        counts = np.diff(np.searchsorted(words.starts, np.cumsum([0] + [len(folded(x)) + 1 for x in texts])))
        for size in sorted(set(counts.tolist()) & set(range(1, length))):
            members = np.flatnonzero(counts == size)
            held = shingled([texts[i] for i in members], size)
            owners: dict[bytes, list[int]] = {}
            for k, item in enumerate(members.tolist()):
                owners.setdefault(held.shingle(k, size), []).append(item)
            self.short[size] = np.unique(held.hashes), owners
        sizes = np.diff(words.first)
        # A window starts at every block, so one of size + BLOCK - 1 shingles holds the item wherever it stands.
        blocks = -(-(sizes + BLOCK - 1) // BLOCK)
        levels = np.array([int(b - 1).bit_length() for b in blocks], np.int64)
        self.classes = []
        for level in np.unique(levels[sizes > 0]) if len(sizes) else []:
            members = np.flatnonzero((levels == level) & (sizes > 0))
            self.classes.append(self._class(int(level), members))

    def _class(self, level: int, members: np.ndarray) -> SizeClass:
        out = SizeClass(level, members)
        width = 1 << max(14, int(len(members) * 16 - 1).bit_length())
        for factor, mask in zip(FACTORS, MASKS):
            minima = np.array([(((self.hashes[i] >> np.uint64(32)).astype(np.uint32) ^ mask) * factor).min() for i in members], np.uint32)
            order = np.argsort(minima, kind="stable")
            out.minima.append(minima[order])
            out.owners.append(members[order])
            marks = np.zeros(width, bool)
            marks[minima & np.uint32(width - 1)] = True
            out.filters.append(marks)
        return out

    def candidates(self, words: Words) -> set[tuple[int, int]]:
        """(text, item) pairs in which some window shares a minimum hash with the item."""
        counts = np.diff(words.first)
        blocks = -(-counts // BLOCK)
        total = int(blocks.sum())
        if not total or not self.classes:
            return set()
        owner = np.repeat(np.arange(len(counts)), blocks)
        start = np.concatenate([[0], np.cumsum(blocks)])
        inside = np.arange(total) - start[owner]
        high = (words.hashes >> np.uint64(32)).astype(np.uint32)
        last = words.first[owner + 1] - 1
        # The k-th shingle of every block; a text's last block repeats its last shingle, which changes no minimum.
        lanes = [high[np.minimum(words.first[owner] + inside * BLOCK + k, last)] for k in range(BLOCK)]
        top = max(c.level for c in self.classes)
        onward = [np.minimum(np.arange(total) + (1 << level), start[owner + 1] - 1) for level in range(top)]
        found = set()
        for j in range(HASHES):
            lows = [(lane ^ MASKS[j]) * FACTORS[j] for lane in lanes]
            level_minima = np.minimum(np.minimum(lows[0], lows[1]), np.minimum(lows[2], lows[3]))
            level = 0
            for size in self.classes:
                while level < size.level:
                    level_minima = np.minimum(level_minima, level_minima[onward[level]])
                    level += 1
                marks, minima = size.filters[j], size.minima[j]
                hits = np.flatnonzero(marks[level_minima & np.uint32(len(marks) - 1)])
                if not len(hits):
                    continue
                values = level_minima[hits]
                low, high_end = np.searchsorted(minima, values), np.searchsorted(minima, values, "right")
                for text, a, b in set(zip(owner[hits].tolist(), low.tolist(), high_end.tolist())):
                    found.update((text, int(i)) for i in size.owners[j][a:b])
        return found

    def contained(self, texts: list[bytes], threshold: float) -> list[list[tuple]]:
        """For each text: (item id, shingles found, the item's shingles) of the items it holds."""
        short = [text for text in texts if len(text) <= LONG]
        words = shingled(short, self.length)
        found: list[list[tuple]] = [[] for _ in short]
        for text, item in sorted(self.candidates(words)):
            self._judge(found[text], item, self._held(words, text, item), threshold)
        for text, items in self.short_hits(short).items():
            found[text] += [(self.ids[item], 1, 1) for item in sorted(items)]
        rest = iter(found)
        return [next(rest) if len(text) <= LONG else self._contained_in_long(text, threshold) for text in texts]

    def short_hits(self, texts: list[bytes]) -> dict[int, set[int]]:
        """Items of fewer words than a shingle, by the texts that hold their word sequence."""
        out: dict[int, set[int]] = {}
        for size, (hashes, owners) in self.short.items():
            words = shingled(texts, size)
            at = np.minimum(np.searchsorted(hashes, words.hashes), len(hashes) - 1)
            # Each text's equal sequences are looked at once.
            places = np.flatnonzero(hashes[at] == words.hashes)
            text = np.searchsorted(words.first, places, "right") - 1
            _, first = np.unique(np.column_stack([text, at[places]]), axis=0, return_index=True)
            for k in first.tolist():
                for item in owners.get(words.shingle(int(places[k]), size), ()):
                    out.setdefault(int(text[k]), set()).add(item)
        return out

    def _held(self, words: Words, text: int, item: int) -> set[bytes]:
        """Which of the item's shingles a text has, compared as bytes."""
        a, b = words.first[text], words.first[text + 1]
        own, wanted = words.hashes[a:b], self.hashes[item]
        at = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
        places = np.flatnonzero(wanted[at] == own)
        return {words.shingle(a + k, self.length) for k in places} & self.shingles[item]

    def _judge(self, out: list[tuple], item: int, held: set[bytes], threshold: float) -> None:
        total = len(self.shingles[item])
        if len(held) >= threshold * total:
            out.append((self.ids[item], len(held), total))

    def _contained_in_long(self, text: bytes, threshold: float) -> list[tuple]:
        """A long text piece by piece: first the candidates of all pieces, then what the pieces together hold of each.

        Pieces overlap by the longest item and its window, so an item lies whole in one of them.
        """
        overlap, at, pieces = 4 * self.longest + 1000, 0, []
        size = max(LONG, 3 * overlap)
        while at < len(text):
            end = BLANK.search(text, min(len(text), at + size))
            pieces.append((at, end.start() if end else len(text)))
            if not end:
                break
            start = BLANK.search(text, max(at + 1, end.start() - overlap))
            at = start.start()
        candidates, brief = set(), set()
        for a, b in pieces:
            brief |= self.short_hits([text[a:b]]).get(0, set())
            candidates |= {item for _, item in self.candidates(shingled([text[a:b]], self.length))}
        held: dict[int, set[bytes]] = {item: set() for item in sorted(candidates)}
        for a, b in pieces if held else ():
            words = shingled([text[a:b]], self.length)
            for item in held:
                held[item] |= self._held(words, 0, item)
        out: list[tuple] = []
        for item, shingles in held.items():
            self._judge(out, item, shingles, threshold)
        return out + [(self.ids[item], 1, 1) for item in sorted(brief)]


_indexes: dict[int, Items] = {}


def _index(rows: list[tuple], length: int) -> Items:
    """One per worker and block of items, however many tasks it runs."""
    key = hash((length, *rows))
    if key not in _indexes:
        _indexes.clear()
        ids, texts = zip(*rows)
        _indexes[key] = Items(list(ids), list(texts), length)
    return _indexes[key]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int = ITEM_BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in lists of some ``block_bytes`` of text each. Only one list at a time is on the driver."""
    kept = items.select(F.col(id_col).alias("item_id"), utf8(text_col).alias("text"))
    total = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        part = kept if blocks == 1 else kept.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        rows = [(r["item_id"], bytes(r["text"])) for r in part.collect()]
        if rows:
            yield rows


def hits_column(text: str, rows: list[tuple], spark, id_type: str = "bigint", length: int = SHINGLE, threshold: float = CONTAINMENT) -> Column:
    """An array of (item_id, matched, total) for each text, searched against one block of items."""
    shared = spark.sparkContext.broadcast(rows)

    @pandas_udf(f"array<struct<item_id:{id_type},matched:int,total:int>>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = _index(shared.value, length)
        for batch in batches:
            held, size, out = [], 0, []
            for text in batch:
                held.append(text)
                size += len(text)
                if size >= CHUNK_BYTES:
                    out += items.contained(held, threshold)
                    held, size = [], 0
            out += items.contained(held, threshold)
            yield pd.Series([[{"item_id": i, "matched": m, "total": t} for i, m, t in hits] for hits in out])

    return search(utf8(text))


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = SHINGLE,
    threshold: float = CONTAINMENT,
    block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, matched, total, containment): every document row that holds ``threshold`` of an item's shingles.

    Shingles are sets of ``length`` words, lower case; words are runs of ASCII letters, digits and bytes
    above 0x7F. An item of fewer words is one shingle, its whole word sequence, found wherever these words stand in
    that order. NULL and empty texts, and documents shorter than the item's shingle, match nothing. Rows and
    items that repeat give a row each; ids may be NULL. Other columns are ignored.
    """
    id_type = dict(items.dtypes)[item_id]
    spark = docs.sparkSession
    found = None
    for rows in item_blocks(items, item_id, item_text, block_bytes):
        hits = hits_column(text_col, rows, spark, id_type, length, threshold)
        part = docs.select(F.col(id_col).alias("doc_id"), F.explode(hits).alias("hit"))
        part = part.select("doc_id", "hit.*", (F.col("hit.matched") / F.col("hit.total")).alias("containment"))
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = docs.select(
            F.col(id_col).alias("doc_id"),
            F.lit(None).cast(id_type).alias("item_id"),
            F.lit(0).alias("matched"),
            F.lit(0).alias("total"),
            F.lit(0.0).alias("containment"),
        ).where(F.lit(False))
    return found


def decontaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    length: int = SHINGLE, threshold: float = CONTAINMENT,
) -> DataFrame:
    """``docs`` without the rows that hold an item, all columns as they were; decided row by row, without a shuffle."""
    id_type = dict(items.dtypes)[item_id]
    for rows in item_blocks(items, item_id, item_text):
        docs = docs.where(F.size(hits_column(text_col, rows, docs.sparkSession, id_type, length, threshold)) == 0)
    return docs
