"""Secret scans in SQL functions alone: known shapes by regular expression, unknown ones by windowed entropy.

A scan first asks whether a text matches at all, so clean text is read once per expression. Positions come
from the pieces between matches. For the entropy kinds, every maximal run of a character class is a
candidate; a window slides over it, and each step adds the character that enters to the window's counts
and takes off the one that leaves, which also updates the sum of c * log2(c). The entropy of a window of n
is log2(n) - sum / n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shape:
    """A kind of secret by its form: matches whose ``group`` has at least ``least`` characters.

    ``pattern`` is what is matched, short matches included where they use up text that a longer one could
    start in. ``present`` holds in every text that has a long enough match.
    """

    kind: str
    pattern: str
    present: str
    group: int
    least: int


@dataclass(frozen=True)
class EntropyClass:
    """A kind of secret by its randomness: ``alphabet`` is both the class and the order of its counters."""

    kind: str
    alphabet: str
    window: int
    bits: float
    mixed: str  # a candidate has to match this too


# Kinds, expressions and least lengths.
KEYWORD = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
SHAPES = (
    Shape("assign", KEYWORD + r"([A-Za-z0-9+/_.=-]+)", KEYWORD + r"[A-Za-z0-9+/_.=-]{6}", 2, 6),
    # A run of one class matches whole or not at all, so the least length can stand in the expression.
    Shape("access", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}", 0, 20),
    Shape("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}", 0, 24),
)
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Random hexadecimal has 3.4 bits or more in a window of 24, random base 64 over 4; words stay below.
CLASSES = (
    EntropyClass("entropy_hex", DIGITS + "ABCDEF", 24, 3.01, r"^(?=.*[0-9])(?=.*[A-F])"),
    EntropyClass("entropy_base64", DIGITS + UPPER + LOWER + "+/_-", 24, 3.81, r"[0-9]"),
)
#: No secrets: UUIDs, paths and slugs of words, examples, one repeated unit. A pattern that starts with ^ allows the
#: candidate that it matches whole; the others allow only what they match, and what stands beside it is judged by itself.
#: None needs more than a pass over a long candidate, nor a stack that grows with it (hence the `*+`).
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example|sample|placeholder|changeme|your[_-]",
    r"^[/_-]?(?:[A-Za-z]+|[0-9]+)(?:[/_+-](?:[A-Za-z]+|[0-9]+))*+[/_-]?$",
    r"(?i)0123456789|abcdefghijkl",
    r"^(.{1,8})\1+$",
)
HIDDEN = "[secret]"
#: Counts are a text with one sign per character of the class, of which each step changes two; this sign stands for 0.
NONE = 65


PLACES = "array<struct<start:int,hit:string>>"


def _places(text: Column, pattern: str, present: str, valid) -> Column:
    """The ``valid`` ones of all matches, as (start, hit); start in code points.

    The pieces between matches and the matches take turns; the last piece has no match after it.
    """
    turns = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def walk(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        place = F.array(F.struct(start.alias("start"), x["hit"].alias("hit")))
        return F.struct(
            (start + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
            F.when(x["hit"].isNotNull() & valid(x["hit"]), F.concat(state["found"], place)).otherwise(state["found"]).alias("found"),
        )

    none = F.array().cast(PLACES)
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return F.when(text.rlike(present), F.aggregate(turns, begin, walk, lambda state: state["found"])).otherwise(none)


def _span(kind: str, rank: int, start: Column, stop: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"))


def shape_spans(text: Column, shape: Shape, rank: int) -> Column:
    def valid(hit: Column) -> Column:
        return F.length(F.regexp_extract(hit, shape.pattern, shape.group)) >= shape.least

    found = _places(text, shape.pattern, shape.present, valid)
    return F.transform(found, lambda x: _span(shape.kind, rank, x["start"], x["start"] + F.length(x["hit"])))


def hot_stretch(candidate: Column, kind: EntropyClass) -> Column:
    """(first, last): starts of the first and last window over the threshold; -1 where there is none."""
    # The characters as an array, made once: looking one up takes as long at the end as at the start.
    return F.transform(F.array(F.split(candidate, "")), lambda characters: _hot_stretch(characters, kind))[0]


def _hot_stretch(characters: Column, kind: EntropyClass) -> Column:
    def place(at: Column) -> Column:
        return F.instr(F.lit(kind.alphabet), F.get(characters, (at - 1).cast("int")))

    def weight(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))

    def count(counts: Column, at: Column) -> Column:
        return F.ascii(F.substring(counts, at, F.lit(1))) - NONE

    def put(counts: Column, at: Column, number: Column) -> Column:
        return F.overlay(counts, F.char(number + NONE), at, F.lit(1))

    def slid(state: Column, at: Column) -> Column:
        enters = place(at)
        leaves = F.when(at > kind.window, place(at - kind.window)).otherwise(0)
        more = count(state["counts"], enters)
        entered = F.struct(put(state["counts"], enters, more + 1).alias("counts"), more.alias("more"), leaves.alias("leaves"))

        def left(x: Column) -> Column:
            less = count(x["counts"], x["leaves"])
            gone = F.when(x["leaves"] > 0, weight(less - 1) - weight(less)).otherwise(0.0)
            total = state["total"] + weight(x["more"] + 1) - weight(x["more"]) + gone
            entropy = F.log2(F.lit(float(kind.window))) - total / kind.window
            hot = (at >= kind.window) & (entropy >= kind.bits)
            start = at - kind.window
            return F.struct(
                F.when(x["leaves"] > 0, put(x["counts"], x["leaves"], less - 1)).otherwise(x["counts"]).alias("counts"),
                total.alias("total"),
                F.when(hot & (state["first"] < 0), start).otherwise(state["first"]).alias("first"),
                F.when(hot, start).otherwise(state["last"]).alias("last"),
            )

        # Worked out once, then used several times.
        return F.transform(F.array(entered), left)[0]

    empty = F.struct(
        F.lit(chr(NONE) * len(kind.alphabet)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )
    ends = F.sequence(F.lit(1), F.size(characters))
    return F.aggregate(ends, empty, slid, lambda state: F.struct(state["first"].alias("first"), state["last"].alias("last")))


def _parts(run: Column, words: str, suspect) -> Column:
    """The ``suspect`` ones of the parts of a run between matches of ``words``, as (start, hit)."""
    turns = F.arrays_zip(F.split(run, words, -1).alias("gap"), F.regexp_extract_all(run, F.lit(words), F.lit(0)).alias("hit"))

    def walk(state: Column, x: Column) -> Column:
        part = F.array(F.struct(state["at"].alias("start"), x["gap"].alias("hit")))
        return F.struct(
            (state["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
            F.when(suspect(x["gap"]), F.concat(state["found"], part)).otherwise(state["found"]).alias("found"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("found"))
    return F.aggregate(turns, begin, walk, lambda state: state["found"])


def entropy_spans(text: Column, kind: EntropyClass, rank: int, allowed: tuple[str, ...]) -> Column:
    """One span per candidate: from its first to its last window over the threshold.

    A candidate is a run of the class, or where allowed words stand in the run, each part beside them.
    """
    run = "[" + kind.alphabet.replace("-", r"\-") + "]{" + str(kind.window)
    whole = [p for p in allowed if p.removeprefix("(?i)").startswith("^")]
    words = "|".join(f"(?:{p})" for p in allowed if p not in whole)

    def suspect(hit: Column, bare: Column) -> Column:
        keep = hit.rlike(kind.mixed)
        for pattern in whole:
            keep = keep & ~bare.rlike(pattern)
        return keep

    def suspect_part(part: Column) -> Column:
        # The sign between an allowed word and the part counts for its entropy, not for its shape.
        return (F.length(part) >= kind.window) & suspect(part, F.regexp_replace(part, "^[/_+-]|[/_+-]$", ""))

    candidates = _places(text, run + ",}", run + "}", lambda hit: suspect(hit, hit))
    if words:

        def cut(x: Column) -> Column:
            parts = F.transform(_parts(x["hit"], words, suspect_part), lambda p: F.struct((x["start"] + p["start"]).alias("start"), p["hit"].alias("hit")))
            return F.when(x["hit"].rlike(words), parts).otherwise(F.array(F.struct(x["start"].alias("start"), x["hit"].alias("hit"))))

        candidates = F.flatten(F.transform(candidates, cut))
    judged = F.transform(candidates, lambda x: F.struct(x["start"].alias("start"), hot_stretch(x["hit"], kind).alias("hot")))
    return F.transform(
        F.filter(judged, lambda x: x["hot"]["first"] >= 0),
        lambda x: _span(kind.kind, rank, x["start"] + x["hot"]["first"], x["start"] + x["hot"]["last"] + kind.window),
    )


def found_spans(text: Column, shapes=SHAPES, classes=CLASSES, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """All spans of a text, sorted by start, then kind as listed; those of ``shapes`` have the lower ranks."""
    base = [shape_spans(text, shape, rank) for rank, shape in enumerate(shapes)]
    more = [entropy_spans(text, kind, len(shapes) + rank, allowed) for rank, kind in enumerate(classes)]
    return F.array_sort(F.concat(*base, *more))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shapes=SHAPES, classes=CLASSES, allowed=ALLOWED
) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy.

    ``spans``: kind:start:end of base and entropy spans by start, then kind as listed; code points, end
    exclusive. The allow-list suppresses entropy spans only, and only what it matches, not what stands beside it. NULL and empty texts have no span and the hash
    of an empty string. Every row is judged by itself: ids may be NULL or repeat, other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = docs.select(F.col(id_col).alias("doc_id"), found_spans(text, shapes, classes, allowed).alias("found"))
    base = F.filter("found", lambda x: x["rank"] < len(shapes))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    return held.select(
        "doc_id",
        *[number(shape.kind).alias(f"n_{shape.kind}") for shape in shapes],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        (F.size("found") - F.size(base)).cast("long").alias("n_entropy"),
    )


def redacted(docs: DataFrame, text_col: str = "text", hidden: str = HIDDEN, shapes=SHAPES, classes=CLASSES, allowed=ALLOWED) -> DataFrame:
    """``docs`` with each stretch of spans (overlapping ones as one) replaced by ``hidden``.

    Every row stays; a text without a span, and a NULL text, stays as it is, as do all other columns.
    """
    column, text = "__secret_spans", F.col(text_col)
    every = found_spans(F.coalesce(text, F.lit("")), shapes, classes, allowed)
    # One pass in order of starts: copy what lies between the last stretch and this span, then its marker.
    state = F.aggregate(
        column,
        F.struct(F.lit(0).alias("upto"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["upto"], x["stop"]).alias("upto"),
            F.when((x["start"] < s["upto"]) & (s["upto"] > 0), s["out"])
            .otherwise(F.concat(s["out"], F.substring(text, s["upto"] + 1, x["start"] - s["upto"]), F.lit(hidden)))
            .alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["upto"] + 1, F.length(text))),
    )
    clean = F.when(F.size(column) > 0, state).otherwise(text)
    return docs.withColumn(column, every).withColumn(text_col, clean).select(*docs.columns)
