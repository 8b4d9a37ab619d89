"""Byte-pair encoding and decoding by batched merge rounds.

The bytes of many words lie in one flat array of symbols. A round looks up the rank of every pair that is new by
binary search over the sorted pair keys, finds each word's lowest rank, and merges that pair everywhere in
its word; words without a pair left drop out. Only what a worker has not met yet goes through the rounds.

A word is first cut wherever two neighbouring bytes stand together in no token of the vocabulary: no merge can
cross such a place, so the parts are independent, and a long run of letters does not make one long word.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ordermill.llm.common import utf8

VOCABULARY = "byte_bpe_50k.json"
REMEMBERED = 1 << 18  # stretches whose ids a worker keeps
GROUP = 1 << 21  # characters of text encoded together
NONE = np.int64(1 << 40)  # the rank of a pair that does not merge

# The split expression of byte-level vocabularies for ASCII text, and what counts as white space in it.
ASCII_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# A stretch is white space with what follows up to the next white space. No word of the split crosses its ends.
ASCII_STRETCHES = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
STRETCHES = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
INSIDE = re.compile(f"[{SPACE}].*[^{SPACE}]\\Z", re.DOTALL)
BETWEEN = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where it is printable Latin-1, else the next one from 256 on."""
    out, spare = [], 256
    for byte in range(256):
        shown = 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255
        out.append(chr(byte if shown else spare))
        spare += not shown
    return out


def slices(text: str, size: int = GROUP) -> Iterator[str]:
    """The text in slices of about ``size`` characters, cut where a stretch starts."""
    start = 0
    while start < len(text):
        cut = BETWEEN.search(text, start + size) if start + size < len(text) else None
        stop = cut.start() if cut else len(text)
        yield text[start:stop]
        start = stop


class Codec:
    """Encodes and decodes with a byte-level vocabulary given as the text of its JSON file."""

    def __init__(self, definition: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        model, splitter = parts["model"], parts["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or parts["normalizer"] or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("not a plain byte-level vocabulary")
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in parts["added_tokens"]):
            raise ValueError("added tokens are matched in the text as it stands only")
        alphabet = byte_alphabet()
        self.byte_of = {ord(c): chr(byte) for byte, c in enumerate(alphabet)}
        ids = model["vocab"]
        self.symbol = np.array([ids[c] for c in alphabet], np.int64)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        # Of a pair that is listed twice the first place holds.
        self.keys, first = np.unique(keys, return_index=True)
        self.ranks = first.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        tokens = {i: token.translate(self.byte_of).encode("latin-1") for token, i in ids.items()}
        self.special = {x["content"]: np.uint32(x["id"]).tobytes() for x in parts["added_tokens"]}
        tokens |= {x["id"]: x["content"].encode() for x in parts["added_tokens"]}
        listed = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.lengths = np.array([len(t) for t in listed] + [0], np.int64)  # the last one is for ids beyond the vocabulary
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(listed), np.uint8)
        inside = np.arange(1, len(self.bytes))
        inside = inside[~np.isin(inside, self.offsets)]
        self.apart = np.ones(1 << 16, bool)
        self.apart[self.bytes[inside - 1].astype(np.int64) << 8 | self.bytes[inside]] = False
        self.split = Tokenizer.from_str(definition).pre_tokenizer.pre_tokenize_str
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known, self.remembered = dict(self.special), remembered

    # Encoding

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def rounds(self, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the symbols of many parts (``part``: rising numbers); ids and their parts, in order."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbols), NONE)
        inner = np.flatnonzero(part[1:] == part[:-1])
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            first = np.flatnonzero(np.diff(part, prepend=-1))
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(part))))
            over = lowest == NONE
            if over.any():
                done.append((symbols[over], part[over]))
                symbols, part, rank, lowest = (x[~over] for x in (symbols, part, rank, lowest))
            at = np.flatnonzero(rank == lowest)
            if not len(at):
                continue
            # Of pairs that overlap (a run of one symbol) every second one merges, from the left.
            fresh = np.diff(at, prepend=-2) != 1
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, part, rank = symbols[keep], part[keep], rank[keep]
            at = at - np.arange(len(at))
            rank[at] = NONE
            changed = np.concatenate([at, at - 1])
            changed = changed[(changed >= 0) & (changed < len(part) - 1)]
            changed = changed[part[changed] == part[changed + 1]]
            rank[changed] = self.rank(symbols[changed], symbols[changed + 1])
        ids, owner = (np.concatenate(x) for x in zip(*done)) if done else (symbols, part)
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]

    def words(self, text: str) -> list[int]:
        """The lengths in bytes of the words a text splits into."""
        if text.isascii():
            return list(map(len, ASCII_WORDS.findall(text)))
        # In the byte alphabet a character is a byte.
        return [len(word) for word, _ in self.split(text)]

    def learn(self, stretches: list[str]) -> None:
        """Put the ids of stretches that are not known yet into ``known``, all in one flat array.

        Stretches that start with white space and end without split alike alone and behind one another, so
        they are split together; the others, such as the first of a text, by themselves.
        """
        loose, ascii_ones, others = [], [], []
        for x in stretches:
            (loose if INSIDE.match(x) is None else ascii_ones if x.isascii() else others).append(x)
        lengths = np.array([n for x in ["".join(ascii_ones), "".join(others), *loose] for n in self.words(x)], np.int64)
        stretches = [*ascii_ones, *others, *loose]
        raw = [x.encode() for x in stretches]
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return
        fresh = np.append(True, self.apart[data[:-1].astype(np.int64) << 8 | data[1:]])
        fresh[(np.cumsum(lengths) - lengths)] = True
        part = np.cumsum(fresh) - 1
        ids, owner = self.rounds(self.symbol[data], part)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        # Where each stretch's last part ends among the ids.
        stops = np.searchsorted(owner, part[ends - 1], "right")
        coded = ids.astype("<u4").tobytes()
        start = 0
        for stretch, stop in zip(stretches, (4 * stops).tolist()):
            self.known[stretch] = coded[start:stop]
            start = stop

    def stretches(self, text: str) -> Iterator[list[str]]:
        """The stretches of a text, special strings as stretches of their own, in lists of bounded size."""
        for part in self.marks.split(text) if self.marks else (text,):
            if part in self.special:
                yield [part]
                continue
            for piece in slices(part):
                yield (ASCII_STRETCHES if piece.isascii() else STRETCHES).findall(piece)

    def encode(self, texts: Iterator[bytes]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if len(self.known) >= self.remembered:
            self.known = dict(self.special)
        held: list[tuple[int, list[str]]] = []
        out: list[list[bytes]] = []
        size = 0

        def flush() -> None:
            unknown = set().union(*(x for _, x in held)) - self.known.keys()
            self.learn(list(unknown))
            for row, some in held:
                out[row].append(b"".join(map(self.known.__getitem__, some)))
            held.clear()
            if len(self.known) >= self.remembered:
                self.known = dict(self.special)
            else:
                for stretch in unknown:
                    if len(stretch) > 64:
                        del self.known[stretch]

        for row, text in enumerate(texts):
            out.append([])
            for some in self.stretches(text.decode("utf-8", "replace")):
                held.append((row, some))
                size += sum(map(len, some))
                if size >= GROUP:
                    flush()
                    size = 0
        flush()
        return map(b"".join, out)

    # Decoding

    def decode(self, ids: bytes) -> str:
        """The text of some ids; ids beyond the vocabulary give nothing, bytes that are no UTF-8 the replacement sign."""
        listed, out = np.frombuffer(ids, "<u4"), []
        for start in range(0, len(listed), GROUP):
            some = np.minimum(listed[start : start + GROUP], len(self.lengths) - 1).astype(np.int64)
            length = self.lengths[some]
            ends = np.cumsum(length)
            out.append(self.bytes[np.arange(ends[-1]) + np.repeat(self.offsets[some] - ends + length, length)].tobytes())
        return b"".join(out).decode("utf-8", "replace")


_codecs: dict[int, Codec] = {}


def _codec(definition: str) -> Codec:
    """One per worker and vocabulary, so that what it remembers outlives a task."""
    key = hash(definition)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(definition)
    return _codecs[key]


def _definition(vocabulary: str | None) -> str:
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return file.read()


def codec_column(definition: str, spark: SparkSession, kind: str, work) -> Callable[[Column], Column]:
    """A column function that hands a worker's codec and a batch to ``work``. ``definition``: the vocabulary
    file's text, a few MB whatever the corpus."""
    shared = spark.sparkContext.broadcast(definition)

    @pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared.value)
        for batch in batches:
            yield work(codec, batch)

    return run


def _encoded(codec: Codec, batch: pd.Series) -> pd.Series:
    return pd.Series(list(codec.encode(batch)), dtype="object")


def _decoded(codec: Codec, batch: pd.Series) -> pd.Series:
    return pd.Series([codec.decode(x) for x in batch], dtype="object")


def _both(codec: Codec, batch: pd.Series) -> pd.DataFrame:
    ids = _encoded(codec, batch)
    return pd.DataFrame({"ids": ids, "decoded": _decoded(codec, ids)})


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, ids (binary, little-endian unsigned 32-bit integers), n_tokens.

    No begin, end or padding tokens; a special string inside a text is its one token. NULL and empty texts
    have no ids. Rows are encoded one by one, so ids may be NULL or repeat; other columns are ignored.
    """
    ids = codec_column(_definition(vocabulary), docs.sparkSession, "binary", _encoded)
    held = docs.select(F.col(id_col).alias("doc_id"), ids(utf8(text_col)).alias("ids"))
    return held.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decode(encoded: DataFrame, ids_col: str = "ids", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with the text of its ids, special tokens included; NULL ids give the empty text.

    A column that is called ``text_col`` already is replaced.
    """
    text = codec_column(_definition(vocabulary), encoded.sparkSession, "string", _decoded)
    return encoded.withColumn(text_col, text(F.coalesce(F.col(ids_col), F.lit(b""))))


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``encode`` with the text its ids decode to as ``decoded``, in one pass: a round trip of every row."""
    both = codec_column(_definition(vocabulary), docs.sparkSession, "ids binary, decoded string", _both)
    held = docs.select(F.col(id_col).alias("doc_id"), both(utf8(text_col)).alias("both")).select("doc_id", "both.*")
    return held.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
