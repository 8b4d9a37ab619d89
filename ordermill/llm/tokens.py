"""Token counts of a byte-pair vocabulary: symbols at the start minus merges, without making token ids.

Merging pops the lowest-rank adjacent pair off a heap and splices a linked list of symbols. Only the
vocabulary file is read; the library it belongs to normalises and splits text and is the yardstick in tests.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ordermill.llm.common import utf8, word_runs

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
# Fixed value: the split expression of the default vocabulary, and what it comes to for lower-case printable ASCII.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
CACHED = 1 << 19  # words and chunks each that a worker remembers


def merge_count(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges byte-pair encoding makes of ``symbols``; ``merges``: pair -> (rank, merged symbol)."""
    size = len(symbols)
    symbols = list(symbols)
    following, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = []
    for at in range(size - 1):
        found = merges.get((symbols[at], symbols[at + 1]))
        if found:
            heap.append((found[0], at, found[1]))
    heapq.heapify(heap)
    done = 0
    while heap:
        rank, at, merged = heapq.heappop(heap)
        after = following[at]
        # A symbol that went is -1; a pair that changed since it was pushed has another rank or none.
        if symbols[at] < 0 or after >= size or merges.get((symbols[at], symbols[after])) != (rank, merged):
            continue
        done += 1
        symbols[at], symbols[after] = merged, -1
        right = following[at] = following[after]
        if right < size:
            before[right] = at
            found = merges.get((merged, symbols[right]))
            if found:
                heapq.heappush(heap, (found[0], at, found[1]))
        left = before[at]
        if left >= 0:
            found = merges.get((symbols[left], merged))
            if found:
                heapq.heappush(heap, (found[0], left, found[1]))
    return done


class Counter:
    """Counts the tokens of texts with a vocabulary given as the text of its JSON file."""

    def __init__(self, definition: str, cached: int = CACHED):
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        model = parts["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("not a plain byte-pair vocabulary")
        self.ids = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((self.ids[left], self.ids[right]), (rank, self.ids[left + right]))
        library = Tokenizer.from_str(definition)
        self.normalise = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.plain = SPLIT in [x.get("pattern", {}).get("Regex") for x in parts["pre_tokenizer"].get("pretokenizers", [])] and {
            "type": "Lowercase"
        } in (parts["normalizer"] or {}).get("normalizers", [])
        special = [x["content"] for x in parts["added_tokens"]]
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in parts["added_tokens"]):
            raise ValueError("added tokens are matched in the text as it stands only")
        # The longest of several that start alike goes first.
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))).encode()) if special else None
        self.words, self.chunks, self.cached = {}, {}, cached

    def word(self, symbols: str) -> int:
        """Tokens of one split word, in the library's byte alphabet."""
        count = self.words.get(symbols)
        if count is None:
            last = len(symbols) - 1
            start = [self.ids[c + self.suffix if at == last else c] for at, c in enumerate(symbols)]
            count = len(start) - merge_count(start, self.merges)
            if len(self.words) >= self.cached:
                self.words.clear()
            if len(symbols) <= 256:
                self.words[symbols] = count
        return count

    def chunk(self, text: bytes) -> int:
        """Tokens of a stretch without ASCII blanks, at which every vocabulary this class reads splits."""
        count = self.chunks.get(text)
        if count is None:
            count = 0
            if self.plain and text.isascii() and b"<" not in text and (plain := text.decode()).isprintable():
                # Printable ASCII stands for itself in the byte alphabet, so the library's steps come to this.
                return self.remember(text, sum(map(self.word, ASCII_SPLIT.findall(plain.lower()))))
            specials = self.special.findall(text) if self.special and b"<" in text else ()
            for part in self.special.split(text) if specials else (text,):
                if part:
                    split = self.split(self.normalise(part.decode("utf-8", "replace")))
                    count += sum(self.word(word) for word, _ in split)
            self.remember(text, count := count + len(specials))
        return count

    def remember(self, text: bytes, count: int) -> int:
        if len(self.chunks) >= self.cached:
            self.chunks.clear()
        if len(text) <= 256:
            self.chunks[text] = count
        return count

    def count(self, text: bytes) -> int:
        known, total = self.chunks.get, 0
        for words in word_runs(text):
            for word in words:
                found = known(word)
                total += self.chunk(word) if found is None else found
        return total


_counters: dict[int, Counter] = {}


def _counter(definition: str) -> Counter:
    """One per worker and vocabulary, so that what it remembers outlives a task."""
    key = hash(definition)
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(definition)
    return _counters[key]


def token_count(text: str, definition: str, spark) -> Column:
    """``definition``: the vocabulary file's text, a few MB whatever the corpus."""
    shared = spark.sparkContext.broadcast(definition)

    @pandas_udf("bigint")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(shared.value)
        for batch in batches:
            yield pd.Series([counter.count(x) for x in batch], dtype="int64")

    return counted(utf8(text))


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    No begin, end or padding tokens; special strings inside a text are one token each, as the library has
    it. NULL and empty texts have no bytes and no tokens. Rows are counted one by one, so ids may be NULL
    or repeat; other columns are ignored.
    """
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        definition = file.read()
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(text_col, definition, docs.sparkSession).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
