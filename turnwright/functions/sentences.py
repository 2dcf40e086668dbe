"""Sentence splitting, and dropping of listed phrases from messages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnwright.functions.text import DIGIT, SOLID, bound, drop_at_boundary, squeeze, strip

# Stand-ins for a dot that ends nothing, and for the ends of a URL.
DOT, FENCE = "\x01", "\x02"
SLICE = 35


def split_sentences(c: Column) -> Column:
    """array<string> of the parts between periods and line ends, stripped, none empty.

    A dot between digits or within a URL doesn't split. One trailing punctuation mark of a URL is dropped where a
    space, a line end or the end of the text follows it.
    """
    text = F.regexp_replace(c, rf"\.(?<={DIGIT}\.)(?={DIGIT})", DOT)
    fenced = F.regexp_replace(text, rf"(https?://{SOLID}++)", f"{FENCE}$1{FENCE}")
    fenced = F.regexp_replace(fenced, rf"[.,;:!?)\]]{FENCE}(?=[ \n]|\z)", FENCE)
    whole = F.transform(F.split(fenced, FENCE), lambda part, i: F.when(i % 2 == 1, F.replace(part, F.lit("."), F.lit(DOT))).otherwise(part))
    text = F.when(F.contains(c, F.lit("://")), F.array_join(whole, "")).otherwise(text)
    parts = F.split(F.replace(text, F.lit("\n"), F.lit(".")), r"\.")
    return F.filter(F.transform(parts, lambda x: F.replace(strip(x), F.lit(DOT), F.lit("."))), lambda x: x != "")


def phrase_slices(phrase: str, size: int = SLICE) -> list[str]:
    """Slices of a phrase that stand for it, in order of their offset; the last window isn't among them."""
    found = dict.fromkeys(phrase[i : i + size] for i in range(max(1, len(phrase) - size)))
    return list(found)


def mentions_any(c: Column, phrases: Sequence[str]) -> Column:
    """Does the text hold a slice of any phrase?"""
    slices = list(dict.fromkeys(s for p in phrases for s in phrase_slices(p)))
    return F.exists(F.array(*map(F.lit, slices)), lambda s: F.contains(c, s))


def may_mention(c: Column, phrases: Sequence[str]) -> Column:
    """Does the text hold a piece of which every slice of a phrase, and the phrase, has one? Where it doesn't, it holds no
    slice; pieces are fewer than slices by far."""
    half = (SLICE + 1) // 2
    pieces = dict.fromkeys(p[i : i + half] for p in phrases for i in range(0, max(1, len(p) - half + 1), half))
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(s)) for s in pieces])


def strip_phrases(body: Column, phrases: Sequence[str]) -> Column:
    """struct<text, changed>: for each phrase in turn, the phrase or else its first slice that can go goes."""
    tries = F.array(*(F.array(*map(F.lit, [p, *phrase_slices(p)])) for p in phrases))

    def step(acc: Column, candidates: Column) -> Column:
        outcomes = F.filter(F.transform(candidates, lambda p: drop_at_boundary(acc["text"], p)), lambda t: t != acc["text"])
        changed = F.size(outcomes) > 0
        return F.struct(F.when(changed, F.get(outcomes, F.lit(0))).otherwise(acc["text"]).alias("text"), (acc["changed"] | changed).alias("changed"))

    return F.aggregate(tries, F.struct(body.alias("text"), F.lit(False).alias("changed")), step)


def filter_phrases(body: Column, phrases: Sequence[str]) -> Column:
    """struct<text, dropped>: a message without the listed phrases; text is null if nothing is left.

    Of a message of several sentences those that mention a phrase go, and the rest are joined anew; from a single
    sentence phrases are stripped at its ends. dropped counts sentences gone, or 1 for a stripped message.
    """
    if not phrases:
        return F.struct(F.nullif(body, F.lit("")).alias("text"), F.lit(0).alias("dropped"))

    def judged(parts: Column) -> Column:
        def one(plain: Column) -> Column:
            return F.when(may_mention(plain, phrases), searched(parts)).otherwise(F.struct(F.nullif(plain, F.lit("")).alias("text"), F.lit(0).alias("dropped")))

        return bound(F.when(F.size(parts) > 1, F.array_join(parts, ". ")).otherwise(body), one)

    def searched(parts: Column) -> Column:
        kept = F.filter(parts, lambda s: ~mentions_any(s, phrases))
        several = F.struct(F.nullif(F.array_join(kept, ". "), F.lit("")).alias("text"), (F.size(parts) - F.size(kept)).alias("dropped"))
        fold = strip_phrases(body, phrases)
        single = F.element_at(F.transform(F.array(fold), lambda f: F.struct(F.nullif(F.when(f["changed"], squeeze(f["text"])).otherwise(f["text"]), F.lit("")).alias("text"), f["changed"].cast("int").alias("dropped"))), 1)
        return F.when(F.size(parts) > 1, several).otherwise(single)

    return F.element_at(F.transform(F.array(split_sentences(body)), judged), 1)
