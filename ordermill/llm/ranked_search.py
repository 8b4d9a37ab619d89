"""Ranked lexical search by Block-Max MaxScore over a sharded, compressed index.

A shard is a bounded stretch of documents. For each term that is asked for it holds one posting list: document
numbers and frequencies, compressed in blocks, with the highest impact of the list and of each block. Documents of
a shard are numbered by length, so that the documents of a block are alike and its maximum says much.

Within a shard a query adds up its lists from the highest bound down. As soon as the bounds of the lists
that are left cannot lift a new document among the best, those lists are non-essential: documents found so far
are looked up in them, and only where the maxima of the blocks they would fall in still can carry them to the
threshold are those blocks decompressed. Each shard gives its best documents, and these heaps are merged.

Queries are a stated set: they go out in blocks of bounded size, and every block meets all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import WORD_TABLE, utf8, word_runs
from ordermill.session import materialise

BEST = 10
QUERY_BYTES = 4 << 20  # of query text in one broadcast
SHARD_BYTES, SHARD_DOCS = 16 << 20, 1 << 16
BLOCK = 128  # postings
NULL_ID = np.iinfo(np.int64).max  # sorts last; told from a real id by the mask beside it
# One row per shard and term, and with term -1 one of the shard's documents: ``body`` their ids, ``tops`` m, ``lasts`` a mask.
INDEX = "shard long, term int, df long, top long, lasts binary, tops binary, ends binary, body binary"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms, some megabytes of text at a time: runs of ASCII letters, digits and bytes above 0x7F, A-Z lower-cased."""
    return word_runs(text.translate(WORD_TABLE))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count is worth in a document of relative length ``m``, before the term's weight."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# Posting lists


def packed(values: np.ndarray) -> tuple[int, bytes]:
    """Unsigned numbers in as many bytes each as the largest needs, and which of the three widths that is."""
    width = int(np.searchsorted([1 << 8, 1 << 16], int(values.max()), "right"))
    return width, values.astype(f"<u{1 << width}").tobytes()


def compress(docs: np.ndarray, tf: np.ndarray, worth: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Per block: the last document, the highest impact, where its bytes end, and the bytes themselves."""
    starts = np.arange(0, len(docs), BLOCK)
    gaps = np.diff(docs, prepend=0)
    parts, ends, size = [], [], 0
    for start in starts:
        wide, some = packed(gaps[start : start + BLOCK])
        tall, counts = packed(tf[start : start + BLOCK])
        parts += [bytes([wide << 2 | tall]), some, counts]
        size += 1 + len(some) + len(counts)
        ends.append(size)
    lasts = docs[np.minimum(starts + BLOCK, len(docs)) - 1]
    return (
        lasts.astype("<u4").tobytes(),
        np.maximum.reduceat(worth, starts).astype("<u4").tobytes(),
        np.array(ends, "<u4").tobytes(),
        b"".join(parts),
    )


class Postings:
    """One compressed list; blocks are decompressed once, when they are first asked for."""

    def __init__(self, top: int, lasts: bytes, tops: bytes, ends: bytes, body: bytes, m: np.ndarray):
        self.top, self.body, self.m = int(top), body, m
        self.lasts, self.tops, self.ends = (np.frombuffer(x, "<u4").astype(np.int64) for x in (lasts, tops, ends))
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and their impacts."""
        held = self.blocks.get(k)
        if held is None:
            raw = self.body[int(self.ends[k - 1]) if k else 0 : int(self.ends[k])]
            wide, tall = 1 << (raw[0] >> 2), 1 << (raw[0] & 3)
            count = (len(raw) - 1) // (wide + tall)
            gaps = np.frombuffer(raw, f"<u{wide}", count, 1).astype(np.int64)
            docs = np.cumsum(gaps) + (self.lasts[k - 1] if k else 0)
            tf = np.frombuffer(raw, f"<u{tall}", count, 1 + count * wide).astype(np.int64)
            held = self.blocks[k] = docs, impact(tf, self.m[docs])
        return held

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            docs, worth = zip(*(self.block(k) for k in range(len(self.ends))))
            self.whole = np.concatenate(docs), np.concatenate(worth)
        return self.whole

    def bounds(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block each document would be in, and that block's highest impact (0 beyond the last)."""
        at = np.searchsorted(self.lasts, docs)
        return at, np.where(at < len(self.tops), self.tops[np.minimum(at, len(self.tops) - 1)], 0)

    def of(self, docs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The impacts of documents whose blocks ``at`` are known; 0 where the list lacks one."""
        out = np.zeros(len(docs), np.int64)
        for k in np.unique(at):
            held, worth = self.block(int(k))
            rows = np.flatnonzero(at == k)
            place = np.minimum(np.searchsorted(held, docs[rows]), len(held) - 1)
            out[rows] = np.where(held[place] == docs[rows], worth[place], 0)
        return out


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th highest score, or 1, the least that counts, for want of k."""
    return max(1, int(np.partition(scores, -k)[-k])) if len(scores) >= k else 1


def best_of_shard(lists: list[tuple[int, Postings]], size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and scores of a query's best in a shard; all that tie with the k-th. ``lists``: (weight, list)."""
    lists = sorted(((w, p) for w, p in lists if w > 0 and p.top > 0), key=lambda x: -x[0] * x[1].top)
    caps = [w * p.top for w, p in lists]
    left, seen, floor, done = sum(caps), 0, 1, 0
    score = np.zeros(size, np.int64)
    # Essential lists: a document in none of them cannot reach the floor any more.
    for (w, postings), cap in zip(lists, caps):
        if left < floor:
            break
        docs, worth = postings.all()
        score[docs] += w * worth
        left, seen, done = left - cap, seen + cap, done + 1
        if left < seen:
            floor = max(floor, kth(score, k))
    docs = np.flatnonzero((score > 0) & (score + left >= floor))
    score = score[docs]
    # Non-essential lists: what the blocks of each document could add at most, list after list.
    rest = lists[done:]
    spots, caps = [], np.zeros((len(rest) + 1, len(docs)), np.int64)
    for row, (w, postings) in enumerate(rest):
        at, top = postings.bounds(docs)
        spots.append(at)
        caps[row] = w * top
    reach = caps[::-1].cumsum(0)[::-1]
    for row, (w, postings) in enumerate(rest):
        keep = score + reach[row] >= floor
        docs, score, reach, spots = docs[keep], score[keep], reach[:, keep], [at[keep] for at in spots]
        inside = np.flatnonzero(spots[row] < len(postings.tops))
        score[inside] += w * postings.of(docs[inside], spots[row][inside])
        floor = max(floor, kth(score, k))
    keep = score >= max(floor, kth(score, k))
    return docs[keep], score[keep]


# The index


def totals(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Documents with a term, and terms with repeats, over all rows."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, terms = 0, 0
        for batch in batches:
            for text in batch["text"]:
                own = sum(map(len, terms_of(text)))
                held, terms = held + (own > 0), terms + own
        yield pd.DataFrame({"held": [held], "terms": [terms]})

    parts = docs.select(utf8(text_col).alias("text")).mapInPandas(counted, "held long, terms long")
    row = parts.agg(F.sum("held").alias("held"), F.sum("terms").alias("terms")).first()
    return int(row["held"] or 0), int(row["terms"] or 0)


class Shard:
    """The documents of one shard while it is being filled."""

    def __init__(self) -> None:
        self.ids: list = []
        self.sizes: list[int] = []
        self.found: list[np.ndarray] = []  # document << 32 | term, with repeats
        self.bytes = 0

    def add(self, doc_id, text: bytes, vocabulary: dict[bytes, int]) -> None:
        size, place = 0, np.int64(len(self.ids) << 32)
        for terms in terms_of(text):
            size += len(terms)
            known = [vocabulary[t] for t in terms if t in vocabulary]
            self.found.append(np.array(known, np.int64) | place)
        if size:
            self.ids.append(doc_id)
            self.sizes.append(size)
        self.bytes += len(text)

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or len(self.ids) >= SHARD_DOCS

    def rows(self, shard: int, n_docs: int, n_terms: int) -> pd.DataFrame:
        sizes = np.array(self.sizes, np.int64)
        order = np.argsort(sizes, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        m = 25 + np.array([75 * int(n) * n_docs // n_terms for n in sizes[order]], np.int64)
        pairs, tf = np.unique(np.concatenate(self.found), return_counts=True)
        terms, docs = pairs & 0xFFFFFFFF, number[pairs >> 32]
        by = np.lexsort((docs, terms))
        terms, docs, tf = terms[by], docs[by], tf[by]
        worth = impact(tf, m[docs])
        first = np.flatnonzero(np.diff(terms, prepend=-1))
        out = []
        for a, b in zip(first, np.append(first[1:], len(terms))):
            out.append((shard, int(terms[a]), b - a, int(worth[a:b].max()), *compress(docs[a:b], tf[a:b], worth[a:b])))
        ids = [self.ids[k] for k in order]
        mask = np.array([x is None for x in ids], np.uint8)
        held = np.array([NULL_ID if x is None else x for x in ids], np.int64)
        out.append((shard, -1, 0, 0, mask.tobytes(), m.astype("<i8").tobytes(), b"", held.tobytes()))
        return pd.DataFrame(out, columns=["shard", "term", "df", "top", "lasts", "tops", "ends", "body"])


def index(docs: DataFrame, id_col: str, text_col: str, terms: list[bytes], n_docs: int, n_terms: int) -> DataFrame:
    """The posting lists of the listed terms over all rows, written to the shared folder."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = {term: k for k, term in enumerate(shared.value)}
        first, made, shard = TaskContext.get().partitionId() << 32, 0, Shard()
        for batch in batches:
            ids = [None if null else doc for doc, null in zip(batch["doc_id"], batch["no_id"])]
            for doc_id, text in zip(ids, batch["text"]):
                shard.add(doc_id, text, vocabulary)
                if shard.full():
                    if shard.ids:
                        yield shard.rows(first + made, n_docs, n_terms)
                    made, shard = made + 1, Shard()
        if shard.ids:
            yield shard.rows(first + made, n_docs, n_terms)

    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc_id"), F.col(id_col).isNull().alias("no_id"), utf8(text_col).alias("text")
    )
    return materialise(rows.mapInPandas(build, INDEX), "search-index")


# The search


def query_blocks(queries: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """(id, counts of terms) in lists of some ``block_bytes`` of text each. Only one list at a time is on the driver."""
    kept = queries.select(F.col(id_col).alias("item_id"), utf8(text_col).alias("text")).distinct()
    total = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        part = kept if blocks == 1 else kept.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        rows = [(r["item_id"], Counter(t for some in terms_of(bytes(r["text"])) for t in some)) for r in part.collect()]
        rows = [row for row in rows if row[1]]
        if rows:
            yield rows


def search_block(indexed: DataFrame, items: list[tuple], terms: list[bytes], n_docs: int, k: int, id_type: str) -> DataFrame:
    """(item, item_id, doc_id, score): each shard's best for one block of queries."""
    # One row per term that was asked for.
    df = {r["term"]: r["df"] for r in indexed.where("term >= 0").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    number = {term: at for at, term in enumerate(terms)}
    asked = [(item_id, [(number[t], n * weight(n_docs, df[number[t]])) for t, n in counts.items() if number[t] in df]) for item_id, counts in items]
    shared = indexed.sparkSession.sparkContext.broadcast(asked)

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        about = rows[rows["term"] < 0].iloc[0]
        m, ids = np.frombuffer(about["tops"], "<i8"), np.frombuffer(about["body"], "<i8")
        mask = np.frombuffer(about["lasts"], np.uint8)
        lists = {
            r.term: Postings(r.top, r.lasts, r.tops, r.ends, r.body, m) for r in rows[rows["term"] >= 0].itertuples(index=False)
        }
        found = []
        for at, (item_id, wanted) in enumerate(shared.value):
            held = [(w, lists[t]) for t, w in wanted if t in lists]
            if held:
                docs, score = best_of_shard(held, len(m), k)
                order = np.lexsort((ids[docs], mask[docs], -score))[:k]
                found += [(at, item_id, None if mask[d] else int(ids[d]), int(s)) for d, s in zip(docs[order], score[order])]
        out = pd.DataFrame(found, columns=["item", "item_id", "doc_id", "score"])
        return out.astype({"doc_id": "Int64"})

    return indexed.groupBy("shard").applyInPandas(search, f"item long, item_id {id_type}, doc_id long, score long")


def search(
    docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id",
    query_text: str = "text", k: int = BEST, block_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each query's ``k`` highest-scoring documents with a score above 0.

    Ties go to the smaller doc_id, NULL last. NULL and empty texts have no terms: such documents count
    nowhere, such queries find nothing. Rows that repeat a doc_id are documents of their own; queries that
    repeat id and text are one, and those that share an id but not the text are ranked each by itself. Other columns
    are ignored; no documents or no queries give no rows.
    """
    spark = docs.sparkSession
    id_type = dict(queries.dtypes)[query_id]
    out = None
    n_docs, n_terms = totals(docs, text_col)
    for items in query_blocks(queries, query_id, query_text, block_bytes) if n_docs else ():
        terms = sorted(set().union(*(counts for _, counts in items)))
        indexed = index(docs, id_col, text_col, terms, n_docs, n_terms)
        heaps = search_block(indexed, items, terms, n_docs, k, id_type)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        part = ranked.select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionAll(part)
    if out is None:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    return out
