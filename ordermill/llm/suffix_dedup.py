"""Exact removal of repeated byte strings by prefix-free parsing.

A rolling hash of ``TRIGGER`` bytes runs over every text. The smallest hash of all triggers inside a string
of ``length`` bytes marks that string's trigger; strings next to each other that share their trigger make
a phrase, which reaches from its first string's start to its last one's end. Equal strings have equal
triggers at equal places, so they meet wherever phrases with equal triggers do, and no string is missed.

The dictionary has every phrase once. The parse is sorted by phrase and place: as a string lies within one phrase,
its suffixes need no more than their first phrase to be in order, and all but the earliest occurrence of a phrase
are repeats as a whole. What is left are strings that different phrases of one trigger share. They are found in
the suffix array of these phrases, cut at ``length`` bytes: equal suffixes stand together in it, and the earliest
place that the parse has for their phrases decides which of them repeat. A suffix whose rolling hash is alone
among its trigger's has no equal and is left out of the array before it is sorted. Copied text thus costs a row
per phrase and group of texts, not a row per byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType

from ordermill.llm.common import PrefixHash, utf8
from ordermill.session import materialise

LENGTH, TRIGGER = 100, 32
CHUNK = 1 << 20  # bytes of text parsed at once
PHRASES = 1 << 20  # phrases combined in a task before they are sent on
# Phrases of one trigger from which on they are compared string by string, over many tasks. Below, one task holds
# their strings: at 69 strings a phrase and some 300 bytes a string, this many take 85 MB.
HOT = 4096
GROUPED = 1 << 13  # phrases whose strings are ordered at once, or one trigger's
PLACE = np.uint64((1 << 28) - 1)  # room for a place within a chunk
# A row of the parse: ``spot`` packs a start (31 bits), 25 bits of the text's hash and a number of strings (7 bits).
# With 0 strings it is a repeated stretch, and ``phrase`` holds its end. ``sides``: see `parse`.
ROW = "trigger long, phrase long, doc long, spot long, sides long"
COLUMNS = ["trigger", "phrase", "doc", "spot", "sides"]
TEXT_BITS, COUNT_BITS = 25, 7


def _minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` keys from each on, by doubling."""
    have = 1
    while 2 * have <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    rest = width - have
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def parse(texts: list[bytes], length: int = LENGTH, trigger: int = TRIGGER) -> tuple[np.ndarray, ...]:
    """Phrases of some texts: text, first string's start, number of strings, trigger hash, phrase hash, sides.

    A string reaches beyond its trigger, on one side at least, by half of its other bytes. So phrases that share a string
    agree on the trigger and that many bytes to its left, or to its right. ``sides`` has a hash of either in 32 bits,
    0 where the phrase does not reach so far.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(sizes) - sizes
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none, none
    rolled = PrefixHash(data)
    at = np.arange(len(data) - trigger + 1)
    hashes = rolled.of(at, at + trigger)
    # The place in the low bits, falling, lets the last of equal hashes win and tells where the minimum is.
    keys = (hashes & ~PLACE) | (PLACE - at.astype(np.uint64))
    smallest = _minima(keys, length - trigger + 1)
    place = (PLACE - (smallest & PLACE)).astype(np.int64)
    start = np.arange(len(place))
    text = np.repeat(np.arange(len(texts)), sizes)[: len(place)]
    inside = start + length <= (base + sizes)[text]
    first = np.flatnonzero(inside & (np.diff(place, prepend=-1) != 0) | (inside & (start == base[text])))
    if not len(first):
        return none, none, none, none, none, none
    count = np.add.reduceat(inside.astype(np.int64), first)
    whole = PrefixHash(data, 2).of(first, first + count - 1 + length)
    reach, spot, stop = (length - trigger + 1) // 2, place[first], first + count - 1 + length
    sides = np.zeros(len(first), np.uint64)
    for room, shift, begin, end in ((spot - first, 32, spot - reach, spot + trigger), (stop - spot - trigger, 0, spot, spot + trigger + reach)):
        far = np.flatnonzero(room >= reach)
        sides[far] |= (rolled.of(begin[far], end[far]) >> np.uint64(32) | np.uint64(1)) << np.uint64(shift)
    mark = (hashes[spot] >> np.uint64(33)).astype(np.int64)
    return text[first], first - base[text[first]], count, mark, whole.view(np.int64), sides.view(np.int64)


def pack(start: np.ndarray, text: np.ndarray, count) -> np.ndarray:
    return (start << (TEXT_BITS + COUNT_BITS)) | (text << COUNT_BITS) | count


def unpack(spot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spot >> (TEXT_BITS + COUNT_BITS), (spot >> COUNT_BITS) & ((1 << TEXT_BITS) - 1), spot & ((1 << COUNT_BITS) - 1)


def stretches(doc: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Byte ranges, overlapping and touching ones of a text as one."""
    order = np.lexsort((start, text, doc))
    doc, text, start, stop = doc[order], text[order], start[order], stop[order]
    if not len(doc):
        return doc, text, start, stop
    other = (np.diff(doc, prepend=doc[0] - 1) != 0) | (np.diff(text, prepend=-1) != 0)
    # The furthest end so far within the text: texts are lifted above one another, so one running maximum does.
    lift = np.cumsum(other) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift) - lift
    fresh = np.append(True, (start[1:] > reach[:-1]) | other[1:])
    first = np.flatnonzero(fresh)
    return doc[first], text[first], start[first], reach[np.append(first[1:], len(doc)) - 1]


def repeat_rows(doc: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pd.DataFrame:
    doc, text, start, stop = stretches(doc, text, start, stop)
    # Any trigger does; these spread the rows over tasks.
    spread = (PrefixHash.spread(doc) >> np.uint64(33)).astype(np.int64)
    return pd.DataFrame({"trigger": spread, "phrase": stop, "doc": doc, "spot": pack(start, text, 0), "sides": 0})


def combined(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Only the earliest occurrences of each phrase, and what the others cover."""
    trigger, phrase, doc, spot, sides = (rows[c].to_numpy() for c in COLUMNS)
    order = np.lexsort((spot, doc, phrase, trigger))
    trigger, phrase, doc, spot, sides = trigger[order], phrase[order], doc[order], spot[order], sides[order]
    fresh = np.append(True, (trigger[1:] != trigger[:-1]) | (phrase[1:] != phrase[:-1]))
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    start, text, count = unpack(spot)
    # An occurrence at the same place of a row with the same id is no earlier one.
    later = (doc != doc[first]) | (start != start[first])
    again = ~later & ~fresh & (spot == spot[first])
    keep = ~later & ~again
    kept = pd.DataFrame(dict(zip(COLUMNS, (x[keep] for x in (trigger, phrase, doc, spot, sides)))))
    return pd.concat([kept, repeat_rows(doc[later], text[later], start[later], start[later] + count[later] - 1 + length)])


def parsed(docs: DataFrame, length: int, trigger: int) -> DataFrame:
    """The parse of all texts, combined within tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        pending: list[tuple[int, int, int, bytes]] = []
        size = 0

        def take() -> None:
            nonlocal size
            text, start, count, mark, phrase, sides = parse([p[3] for p in pending], length, trigger)
            doc, name, shift = (np.array([p[k] for p in pending], np.int64)[text] for k in range(3))
            held.append(pd.DataFrame({"trigger": mark, "phrase": phrase, "doc": doc, "spot": pack(start + shift, name, count), "sides": sides}))
            pending.clear()
            size = 0

        for batch in batches:
            for doc, name, text in zip(batch["doc"], batch["name"], batch["text"]):
                # A long text goes in pieces that overlap by all but one byte of a string.
                for at in range(0, max(1, len(text) - length + 1), CHUNK):
                    piece = text[at : at + CHUNK + length - 1]
                    if len(piece) >= length:
                        pending.append((doc, name, at, piece))
                        size += len(piece)
                    if size >= CHUNK:
                        take()
                        if sum(map(len, held)) >= PHRASES:
                            yield combined(pd.concat(held), length)
                            held.clear()
        if pending:
            take()
        if held:
            yield combined(pd.concat(held), length)

    return docs.mapInPandas(run, ROW)


def agreeing(group: np.ndarray, sides: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of ``some`` rows have a side that another of them in their group has too."""
    out = np.zeros(len(group), bool)
    for side in (sides >> np.uint64(32), sides & np.uint64(0xFFFFFFFF)):
        rows = np.flatnonzero(some & (side > 0))
        _, back, times = np.unique(group[rows].astype(np.uint64) << np.uint64(32) | side[rows], return_inverse=True, return_counts=True)
        out[rows[times[back] > 1]] = True
    return out


class Resolver:
    """Reads rows sorted by trigger, phrase and place; holds one batch and the last phrase, however long a group is."""

    def __init__(self, length: int):
        # The last phrase's earliest occurrences wait until it is known whether another phrase follows.
        self.length, self.waiting, self.shared, self.begin = length, None, False, None

    def feed(self, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        _, _, count = unpack(batch["spot"].to_numpy())
        yield batch[count == 0]
        rows = batch[count > 0]
        if not len(rows):
            return
        if self.waiting is not None:
            rows = pd.concat([self.waiting, rows])
        trigger, phrase, doc, spot, sides = (rows[c].to_numpy() for c in COLUMNS)
        new_trigger = np.append(True, trigger[1:] != trigger[:-1])
        fresh = new_trigger | np.append(True, phrase[1:] != phrase[:-1])
        first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        start, text, count = unpack(spot)
        later = (doc != doc[first]) | (start != start[first])
        group = np.cumsum(new_trigger) - 1
        several = np.bincount(group, weights=fresh) > 1
        several[0] |= self.shared and self.waiting is not None and trigger[0] == self.begin
        last = first == first[-1]
        out = pd.DataFrame(dict(zip(COLUMNS, (trigger, phrase, doc, spot, sides))))
        ambiguous = several[group] & ~later & ~last
        # Phrases that agree with no other one of their trigger on either side share no string with it. A trigger
        # that goes on in another batch is not seen whole here, and keeps all of its phrases.
        open_ended = (group == group[-1]) | ((group == 0) & (trigger[0] == self.begin))
        yield out[ambiguous & (open_ended | agreeing(group, sides.view(np.uint64), ambiguous))]
        yield repeat_rows(doc[later], text[later], start[later], start[later] + count[later] - 1 + self.length)
        self.begin, self.shared = trigger[-1], bool(several[group[-1]])
        self.waiting = out[last & ~later]

    def finish(self) -> Iterator[pd.DataFrame]:
        if self.waiting is not None and self.shared:
            yield self.waiting


def resolved(parse_rows: DataFrame, length: int) -> DataFrame:
    """Repeated stretches (0 strings), and the dictionary's phrases that share their trigger with another phrase."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolver = Resolver(length)
        for batch in batches:
            yield from resolver.feed(batch)
        yield from resolver.finish()

    return parse_rows.repartition("trigger").sortWithinPartitions("trigger", "phrase", "doc", "spot").mapInPandas(run, ROW)


@pandas_udf(BinaryType())
def squeezed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts as they travel: what is shuffled is written to disk."""
    pack_text = zstandard.ZstdCompressor(level=1).compress
    for batch in texts:
        yield pd.Series([pack_text(x) for x in batch], dtype="object")


def restored(batch: pd.Series) -> Iterator[bytes]:
    unpack_text = zstandard.ZstdDecompressor().decompress
    return map(unpack_text, batch)


def strings(docs: DataFrame, shared: DataFrame, length: int) -> DataFrame:
    """The bytes of ``shared`` phrases; those of a crowded trigger as single strings (``bytes`` NULL, hash as phrase)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole, single = [], []
            for doc, text, phrases in zip(batch["doc"], restored(batch["text"]), batch["phrases"]):
                data = None
                for phrase in phrases:
                    start, name, count = (int(x) for x in unpack(np.int64(phrase["spot"])))
                    if not phrase["crowded"]:
                        whole.append((phrase["trigger"], 0, doc, phrase["spot"], 0, text[start : start + count - 1 + length]))
                        continue
                    data = np.frombuffer(text[start : start + count - 1 + length], np.uint8)
                    at = np.arange(count)
                    mark = (PrefixHash(data).of(at, at + length) >> np.uint64(33)).astype(np.int64)
                    value = PrefixHash(data, 2).of(at, at + length).view(np.int64)
                    spots = pack(start + at, np.full(count, name), 1)
                    single.append(pd.DataFrame({"trigger": mark, "phrase": value, "doc": doc, "spot": spots, "sides": 0}))
            yield pd.DataFrame(whole, columns=[*COLUMNS, "bytes"])
            if single:
                yield combined(pd.concat(single), length).assign(bytes=None)

    listed = shared.groupBy("doc", "name").agg(F.collect_list(F.struct("trigger", "spot", "crowded")).alias("phrases"))
    # A document's list is bounded by its own length.
    texts = docs.select("doc", "name", squeezed("text").alias("text"))
    return texts.join(listed, ["doc", "name"]).select("doc", "text", "phrases").mapInPandas(run, ROW + ", bytes binary")


def shared_strings(trigger: np.ndarray, doc: np.ndarray, spot: np.ndarray, data: list[bytes], length: int) -> pd.DataFrame:
    """Repeated stretches among some phrases, all of each trigger: in suffix order, every string but the earliest of its equals."""
    start, name, count = unpack(spot)
    sizes = count - 1 + length
    buffer = np.frombuffer(b"".join(data), np.uint8)
    owner = np.repeat(np.arange(len(doc)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = (np.cumsum(sizes) - sizes)[owner] + inside
    # A suffix that is alone with its hash has no equal.
    hashes = PrefixHash(buffer).of(at, at + length) ^ PrefixHash.spread(trigger[owner])
    _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[back] > 1)
    owner, inside, at = owner[some], inside[some], at[some]
    # The suffix array of the rest: texts of one length compare as bytes, trailing zeros included.
    suffixes = np.lib.stride_tricks.sliding_window_view(buffer, length)[at].view(f"S{length}").ravel() if len(at) else np.zeros(0, f"S{length}")
    place = start[owner] + inside
    _, rank = np.unique(suffixes, return_inverse=True)
    order = np.lexsort((place, doc[owner], rank, trigger[owner]))
    owner, place, rank = owner[order], place[order], rank[order]
    mark = trigger[owner]
    fresh = np.append(True, (rank[1:] != rank[:-1]) | (mark[1:] != mark[:-1]))[: len(rank)]
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(rank) else rank
    # An occurrence at the same place of a row with the same id is no earlier one.
    again = (doc[owner] != doc[owner[first]]) | (place != place[first])
    owner, place = owner[again], place[again]
    return repeat_rows(doc[owner], name[owner], place, place + length)


def ordered(rows: DataFrame, length: int, phrases: int = GROUPED) -> DataFrame:
    """Repeated stretches among phrases of one trigger; single strings of crowded triggers go by their hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolver, held = Resolver(length), None

        def compare(part: pd.DataFrame) -> pd.DataFrame:
            return shared_strings(*(part[c].to_numpy() for c in ("trigger", "doc", "spot")), part["bytes"].tolist(), length)

        for batch in batches:
            whole = batch["bytes"].notna().to_numpy()
            if not whole.all():
                for out in resolver.feed(batch[~whole].drop(columns="bytes")):
                    yield out[unpack(out["spot"].to_numpy())[2] == 0]
            if not whole.any():
                continue
            held = batch[whole] if held is None else pd.concat([held, batch[whole]])
            # The last trigger's phrases wait for the rest of theirs.
            trigger = held["trigger"].to_numpy()
            closed = int(np.searchsorted(trigger, trigger[-1]))
            for first, stop in _groups(trigger[:closed], phrases):
                yield compare(held.iloc[first:stop])
            held = held.iloc[closed:]
        if held is not None and len(held):
            yield compare(held)

    single = F.col("bytes").isNull()
    sorted_rows = rows.repartition("trigger").sortWithinPartitions(F.desc(single), "trigger", "phrase", "doc", "spot")
    return sorted_rows.mapInPandas(run, ROW)


def _groups(trigger: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of about ``size`` rows that part no trigger."""
    first = 0
    while first < len(trigger):
        last = trigger[min(first + size, len(trigger)) - 1]
        stop = int(np.searchsorted(trigger, last, "right"))
        yield first, stop
        first = stop


def repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, trigger: int = TRIGGER, hot: int = HOT
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of ``length`` bytes over it also starts earlier: in a row with a smaller id, or
    earlier in a row with the same id. Strings do not cross texts, and all are judged on the input. NULL and
    empty texts have no bytes and keep the hash of none. Rows that repeat id and text are one document, and
    all of them show its result. Rows without id come after all others, in the order of a hash of the text.
    Other columns are ignored; no rows give no rows.
    """
    if not 1 <= length - trigger < 1 << COUNT_BITS:
        raise ValueError("a phrase must have at least one and at most 127 strings")
    name = F.xxhash64(text_col)
    nameless = F.lit(1 << 62) + name.bitwiseAND(F.lit((1 << 62) - 1))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), nameless).alias("doc"),
        name.bitwiseAND(F.lit((1 << TEXT_BITS) - 1)).alias("name"),
        utf8(text_col).alias("text"),
    )
    found = materialise(resolved(parsed(rows.select("doc", "name", "text"), length, trigger), length), "repeated-phrases")
    strings_left = F.col("spot").bitwiseAND(F.lit((1 << COUNT_BITS) - 1))
    shared = found.where(strings_left > 0)
    crowds = shared.groupBy("trigger").agg(F.count("*").alias("phrases")).where(F.col("phrases") > hot)
    crowds = crowds.select("trigger", F.lit(True).alias("listed"))
    text_name = F.shiftright("spot", COUNT_BITS).bitwiseAND(F.lit((1 << TEXT_BITS) - 1))
    crowded = F.coalesce("listed", F.lit(False))
    shared = shared.join(crowds, "trigger", "left").withColumns({"name": text_name, "crowded": crowded})
    texts = rows.select("doc", "name", "text", "doc_id")
    covered = (
        found.where(strings_left == 0)
        .unionByName(ordered(strings(texts, shared, length), length))
        .select("doc", text_name.alias("name"), F.struct(F.shiftright("spot", TEXT_BITS + COUNT_BITS).alias("start"), F.col("phrase").alias("stop")).alias("part"))
        .groupBy("doc", "name")
        .agg(F.collect_list("part").alias("parts"))
    )

    @pandas_udf("n_removed long, n_spans long, kept_sha256 string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in batches:
            out = []
            for text, parts in zip(restored(texts), lists):
                if parts is None:
                    out.append((0, 0, hashlib.sha256(text).hexdigest()))
                    continue
                same = np.zeros(len(parts), np.int64)
                _, _, start, stop = stretches(same, same, *(np.array([p[c] for p in parts], np.int64) for c in ("start", "stop")))
                kept, at = hashlib.sha256(), 0
                for a, b in zip(start, stop):
                    kept.update(text[at:a])
                    at = b
                kept.update(text[at:])
                out.append((int((stop - start).sum()), len(start), kept.hexdigest()))
            yield pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"])

    travelling = texts.select("doc", "name", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), squeezed("text").alias("text"))
    joined = travelling.join(covered, ["doc", "name"], "left").select("doc_id", "n_bytes", cut("text", "parts").alias("cut"))
    return joined.select("doc_id", "n_bytes", "cut.*")
