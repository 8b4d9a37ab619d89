"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage becomes a vector of measured features
and is encoded by a learned layer; gated attention weighs the encodings, and a logistic layer scores their
weighted mean. Labels exist for documents only, so the attention learns which passages decide.

The fit reads a bounded sample of labelled documents, every passage of each. Their features are stored once, a
long document's in several rows, and dealt to shards; in every round each shard improves the current parameters
by itself in a task of its own, and the driver averages the shards' parameters by their documents. The more
passages, the more shards; a shard goes over its passages in blocks, whose attention sums are combined per
document. Scoring covers every passage of every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ordermill.llm.common import BLANK, PrefixHash, utf8, word_bounds
from ordermill.session import materialise

PASSAGE = 512
FIT_DOCUMENTS = 4096  # bound of the sample
SHARD_PASSAGES, BLOCK = 1 << 18, 1 << 16  # passages of a shard, beyond which there are more, and those encoded at once
SHARDS, ROUNDS, STEPS, RATE, DECAY = 4, 4, 30, 0.04, 1e-4
ENCODED, ATTENTION = 16, 8
CHUNK = 1 << 20  # bytes of text measured at once

# Byte groups: letters, digits, blanks, line ends and bytes above 0x7F one each, other ASCII signs each by itself.
SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
GROUPS = 6 + len(SIGNS)
GROUP_OF = np.zeros(256, np.uint8)
GROUP_OF[65:91], GROUP_OF[48:58], GROUP_OF[[9, 11, 12, 13, 32]], GROUP_OF[10], GROUP_OF[128:] = 1, 2, 3, 4, 5
GROUP_OF[SIGNS] = np.arange(6, GROUPS)
LAGS = (1, 2, 3)
FEATURES = GROUPS + 3 + len(LAGS) + 2


def passages(sizes: np.ndarray, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of the passages of texts laid end to end, and each passage's text."""
    counts = -(-sizes // size)
    owner = np.repeat(np.arange(len(sizes)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.concatenate([[0], np.cumsum(sizes)])
    starts = base[owner] + inside * size
    return starts, np.minimum(starts + size, base[owner + 1]), owner


def features(texts: list[bytes], size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for every passage, and the text that each passage is of."""
    # A blank closes every text, so that no word runs on into the next one.
    data = np.frombuffer(b"".join(x + b" " for x in texts), np.uint8)
    starts, stops, owner = passages(np.array([len(x) + 1 for x in texts], np.int64), size)
    count = len(starts)
    length = np.maximum(1, stops - starts)
    out = np.zeros((count, FEATURES), np.float32)
    if len(data):
        of_byte = np.repeat(np.arange(count), stops - starts)
        held = np.bincount(of_byte * GROUPS + GROUP_OF[data], minlength=count * GROUPS)
        out[:, :GROUPS] = held.reshape(count, GROUPS) / length[:, None]
        same = np.flatnonzero((data[1:] == data[:-1]) & (of_byte[1:] == of_byte[:-1]))
        out[:, GROUPS] = np.bincount(of_byte[same], minlength=count) / length
        word, end = word_bounds(data)
        if len(word):
            hashes, at = PrefixHash(data).of(word, end), of_byte[word]
            number = np.bincount(at, minlength=count)
            words = np.maximum(1, number)
            out[:, GROUPS + 1] = number / length * 5
            out[:, GROUPS + 2] = np.bincount(at, (end - word) ** 2, minlength=count) / words / 100
            for k, lag in enumerate(LAGS):
                repeated = (hashes[lag:] == hashes[:-lag]) & (at[lag:] == at[:-lag])
                out[:, GROUPS + 3 + k] = np.bincount(at[lag:][repeated], minlength=count) / words
            # A capital first and a sign last: sentences and decorated words.
            first, last = GROUP_OF[data[word]], GROUP_OF[data[end - 1]]
            out[:, FEATURES - 2] = np.bincount(at[first == 1], minlength=count) / words
            out[:, FEATURES - 1] = np.bincount(at[last > 5], minlength=count) / words
    return np.sqrt(out), owner


def long_features(text: bytes) -> Iterator[np.ndarray]:
    """What ``features`` gives for one text, ``CHUNK`` bytes of text at a time.

    A piece is measured with the passage before it, where its first word may start, and up to the end of its
    last word, at most another ``CHUNK``.
    """
    for at in range(0, max(1, len(text)), CHUNK):
        first, stop = max(0, at - PASSAGE), min(len(text), at + CHUNK)
        upto = stop
        if stop < len(text) and (not at or BLANK.search(text, at, stop)):
            end = BLANK.search(text, stop, stop + CHUNK)
            upto = end.start() if end else min(len(text), stop + CHUNK)
        skip = (at - first) // PASSAGE
        count = -(-(stop - at + (stop == len(text))) // PASSAGE)
        yield features([text[first:upto]])[0][skip : skip + count]


def shapes(encoded: int = ENCODED, attention: int = ATTENTION) -> list[tuple[int, ...]]:
    return [(FEATURES, encoded), (encoded,), (encoded, attention), (encoded, attention), (attention,), (encoded,), (1,)]


def unpacked(flat: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes():
        size = int(np.prod(shape))
        out.append(flat[at : at + size].reshape(shape))
        at += size
    return out


def start_parameters(seed: int = 7) -> np.ndarray:
    draw = np.random.default_rng(seed)
    return np.concatenate([(draw.normal(size=s) / np.sqrt(s[0]) if len(s) > 1 else np.zeros(s) + 0.1).ravel() for s in shapes()])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _encode(x: np.ndarray, p: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    h = np.tanh(x @ p[0] + p[1])
    v, u = np.tanh(h @ p[2]), sigmoid(h @ p[3])
    return h, v, u, (v * u) @ p[4]


def bag_loss(flat: np.ndarray, x: np.ndarray, starts: np.ndarray, bag: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean log loss over bags and its gradient. ``starts``: each bag's first passage; ``bag``: each passage's bag."""
    p = unpacked(flat)
    peak, weight, z = np.full(len(starts), -np.inf), np.zeros(len(starts)), np.zeros((len(starts), len(p[5])))
    blocks = [slice(at, at + BLOCK) for at in range(0, len(x), BLOCK)]
    for part in blocks:
        encoded = h, _, _, s = _encode(x[part], p)
        inner = np.flatnonzero(np.diff(bag[part], prepend=-1))
        held = bag[part][inner]
        now = np.maximum(peak[held], np.maximum.reduceat(s, inner))
        fade = np.exp(peak[held] - now)
        peak[held] = now
        e = np.exp(s - peak[bag[part]])
        weight[held] = weight[held] * fade + np.add.reduceat(e, inner)
        z[held] = z[held] * fade[:, None] + np.add.reduceat(e[:, None] * h, inner)
    z /= weight[:, None]
    score = sigmoid(z @ p[5] + p[6])
    loss = -np.mean(np.where(y == 1, np.log(score + 1e-12), np.log(1 - score + 1e-12)))
    d_out = (score - y) / len(y)
    d_z = d_out[:, None] * p[5]
    d_mean = (d_z * z).sum(1)
    total = np.zeros_like(flat)
    for part in blocks:
        own = bag[part]
        h, v, u, s = encoded if len(blocks) == 1 else _encode(x[part], p)
        a = np.exp(s - peak[own]) / weight[own]
        d_s = a * ((d_z[own] * h).sum(1) - d_mean[own])
        d_v = d_s[:, None] * p[4] * u * (1 - v * v)
        d_u = d_s[:, None] * p[4] * v * u * (1 - u)
        d_h = (a[:, None] * d_z[own] + d_v @ p[2].T + d_u @ p[3].T) * (1 - h * h)
        grads = [x[part].T @ d_h, d_h.sum(0), h.T @ d_v, h.T @ d_u, (v * u).T @ d_s]
        total[: -len(p[5]) - 1] += np.concatenate([g.ravel() for g in grads])
    total[-len(p[5]) - 1 :] = np.append(z.T @ d_out, d_out.sum())
    return float(loss), total + DECAY * flat


def improve(flat: np.ndarray, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = RATE) -> np.ndarray:
    """``steps`` steps of Adam on one shard's bags."""
    starts = np.cumsum(sizes) - sizes
    bag = np.repeat(np.arange(len(sizes)), sizes)
    mean, square, flat = np.zeros_like(flat), np.zeros_like(flat), flat.copy()
    for step in range(1, steps + 1):
        _, grad = bag_loss(flat, x, starts, bag, y)
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        flat -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return flat


@dataclass
class Model:
    """Parameters and the features' centre and spread; ``flat`` None: the labels did not differ, all score ``prior``."""

    flat: np.ndarray | None
    centre: np.ndarray
    spread: np.ndarray
    prior: float

    def _encoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, _, _, s = _encode((x - self.centre) / self.spread, unpacked(self.flat))
        return h, s

    def _out(self, z: np.ndarray) -> np.ndarray:
        p = unpacked(self.flat)
        return sigmoid(z @ p[5] + p[6])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The score of each of some texts, which are measured together."""
        x, owner = features(texts)
        h, s = self._encoded(x)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(np.append(starts, len(s)))
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), sizes))
        return self._out(np.add.reduceat(e[:, None] * h, starts) / np.add.reduceat(e, starts)[:, None])

    def long_score(self, text: bytes) -> float:
        """What ``scores`` gives for a long text, piece by piece: the attention's sums are carried with their greatest exponent."""
        peak, weight, total = -np.inf, 0.0, 0.0
        for x in long_features(text):
            h, s = self._encoded(x)
            now = max(peak, s.max())
            e = np.exp(s - now)
            weight, total = weight * np.exp(peak - now) + e.sum(), total * np.exp(peak - now) + e @ h
            peak = now
        return float(self._out((total / weight)[None, :])[0])

    def score_all(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if self.flat is None:
            return out
        held, size = [], 0
        for k, text in enumerate(texts):
            if len(text) > CHUNK:
                out[k] = self.long_score(text)
                continue
            held.append(k)
            size += len(text)
            if size >= CHUNK:
                out[held] = self.scores([texts[i] for i in held])
                held, size = [], 0
        if held:
            out[held] = self.scores([texts[i] for i in held])
        return out


def _bags(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, and each bag's size and label. The rows of a bag follow each other."""
    rows = rows.sort_values(["draw", "y", "row", "piece"], kind="stable")
    x = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in rows["bag"]]
    first = np.flatnonzero(rows["piece"].to_numpy() == 0)
    return np.concatenate(x), np.add.reduceat([len(b) for b in x], first), rows["y"].to_numpy()[first]


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    documents: int = FIT_DOCUMENTS, rounds: int = ROUNDS, shards: int = SHARDS,
) -> Model:
    """Fit on about ``documents`` labelled documents where ``learn`` holds, drawn by a hash of the id, each whole.

    Several labels of one document count as their mean. Only the sampled labels go out to the documents.
    """
    plain = Model(None, np.zeros(FEATURES), np.ones(FEATURES), 0.5)
    known = labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.avg(label_col).alias("y"))
    total, prior = known.agg(F.count("*"), F.avg("y")).first()
    if not total:
        return plain
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 40))
    drawn = known.withColumn("draw", draw).where(F.col("draw") < int((1 << 40) * min(1.0, documents / total)))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, draw, y, text in zip(batch["row"], batch["draw"], batch["y"], batch["text"]):
                for piece, x in enumerate(long_features(text)):
                    yield pd.DataFrame({"draw": [draw], "y": [int(y >= 0.5)], "row": [row], "piece": [piece], "passages": [len(x)], "bag": [x.tobytes()]})

    # The sampled labels number some ``documents`` rows of three numbers, so they may go to every task.
    texts = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("text")).join(F.broadcast(drawn), "doc_id")
    columns = "draw long, y int, row long, piece int, passages int, bag binary"
    numbered = texts.select("draw", "y", "text", F.monotonically_increasing_id().alias("row"))
    sample = materialise(numbered.mapInPandas(measured, columns), "quality-bags")
    count = sample.agg(F.sum("passages")).first()[0] or 0
    sharded = sample.drop("passages").withColumn("shard", F.col("draw") % max(shards, -(-count // SHARD_PASSAGES)))

    def moments(rows: pd.DataFrame) -> pd.DataFrame:
        x, _, y = _bags(rows)
        x = x.astype(np.float64)
        return pd.DataFrame({"n": [float(len(x))], "sums": [x.sum(0)], "squares": [(x * x).sum(0)], "bags": [float(len(y))], "ones": [float(y.sum())]})

    parts = sharded.groupBy("shard").applyInPandas(moments, "n double, sums array<double>, squares array<double>, bags double, ones double").collect()
    n, bags, ones = (sum(r[c] for r in sorted(parts)) for c in ("n", "bags", "ones"))
    if not bags or ones in (0, bags):
        plain.prior = float(prior)
        return plain
    centre = np.sum([r["sums"] for r in sorted(parts)], axis=0) / n
    spread = np.sqrt(np.maximum(0, np.sum([r["squares"] for r in sorted(parts)], axis=0) / n - centre**2)) + 0.02
    flat = start_parameters()
    for turn in range(rounds):
        current, rate = flat, RATE * 0.7**turn

        def improved(rows: pd.DataFrame) -> pd.DataFrame:
            x, sizes, y = _bags(rows)
            better = improve(current, (x - centre) / spread, sizes, y, STEPS, rate)
            return pd.DataFrame({"bags": [float(len(y))], "flat": [better]})

        parts = sorted(sharded.groupBy("shard").applyInPandas(improved, "bags double, flat array<double>").collect())
        flat = np.average([r["flat"] for r in parts], axis=0, weights=[r["bags"] for r in parts])
    return Model(flat, centre, spread, float(prior))


def score_column(text: str, model: Model, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.score_all(list(batch)), dtype="float64")

    return scored(utf8(text))


def classify(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", **fitted) -> DataFrame:
    """One row per document: doc_id, score (of label 1) and predicted (1 from 0.5 up).

    Only the text is an input of a score. NULL and empty texts are one blank passage. Without labels every
    score is 0.5; where all sampled labels agree it is their mean. Rows are scored one by one, so ids may
    be NULL or repeat; other columns are ignored.
    """
    model = fit(docs, labels, learn, id_col, text_col, **fitted)
    scored = docs.select(F.col(id_col).alias("doc_id"), score_column(text_col, model, docs.sparkSession).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def kept(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", **fitted) -> DataFrame:
    """``docs`` without the rows that score below 0.5, all columns as they were; decided row by row, without a shuffle."""
    model = fit(docs, labels, learn, id_col, text_col, **fitted)
    return docs.where(score_column(text_col, model, docs.sparkSession) >= 0.5)
