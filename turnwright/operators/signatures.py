"""Template signatures: short windows of text that recur across messages, and the longest one a message holds."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnwright.functions.text import URL, squeeze
from turnwright.functions.windows import Clean, best_windows, frequent_hashes, text_hashes, window_texts
from turnwright.operators.ranking import spare
from turnwright.storage import cut


@dataclass(frozen=True)
class MiningRule:
    """Windows of ``size`` characters are signatures from ``least`` occurrences on."""

    size: int
    least: int


LONG, SHORT = MiningRule(25, 5), MiningRule(15, 30)
STEPS = 30


def sampled(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many windows a text of each length gives to mining, and how far apart: starts a thirtieth of the length
    apart, the last possible start left out."""
    steps = np.maximum(1, lengths // STEPS)
    return np.where(lengths >= size, -(-np.maximum(1, lengths - size) // steps), 0), steps


def mining_texts(turns: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Messages as they are mined: white space squeezed, URLs as [url], at least as long as the long window."""
    body = F.regexp_replace(squeeze(F.col("content")), URL, "[url]")
    return turns.select(*keep, body.alias("body")).where(F.length("body") >= LONG.size)


def squeezed(content: str) -> str:
    """The same as ``squeeze``, in Python, where it takes a tenth of the time: the white space of both is the same."""
    return " ".join(content.split())


def mining_text(content: str) -> str | None:
    """The body that ``mining_texts`` gives a message, if it does."""
    body = squeezed(content)
    if "://" in body:
        body = re.sub(r"https?://\S+", "[url]", body)
    return body if len(body) >= LONG.size else None


def window_counts(texts: DataFrame, size: int, keep: Sequence[str] = (), least: int = 1) -> DataFrame:
    """(keep, sig, freq): how often each sampled window occurs, if it does ``least`` times; every occurrence counts."""
    return _mined(texts, (MiningRule(size, least),), keep)[0].select(*keep, "sig", "freq")


def _mined(texts: DataFrame, rules: Sequence[MiningRule], keep: Sequence[str], clean: Clean | None = None) -> tuple[DataFrame, DataFrame]:
    """((keep, sig, freq) of the windows that a rule makes frequent, (keep, n) of texts).

    Windows are first counted by their hashes, so no window that is rare is ever made a string or shuffled as one; those
    whose hash is frequent are then counted as they are. Where one occurrence is enough, all are.
    """
    sizes, least = [r.size for r in rules], [r.least for r in rules]
    if min(least) > 1:
        hashes, number = frequent_hashes(texts, keep, sizes, sampled, least, clean)
    else:
        hashes, number = [None], texts.groupBy(*keep).agg(F.count("*").alias("n"))
    counted = _union([window_texts(texts, keep, sizes, sampled, part, clean) for part in hashes] or [window_texts(texts.where("false"), keep, sizes, sampled, None)])
    # each batch has counted its own, so they are dealt out as they are
    counted = counted.repartition(*keep, "sig").groupBy(*keep, "sig").agg(F.sum("n").alias("freq"))
    bound = F.lit(None)
    for r in rules:
        bound = F.when(F.length("sig") == r.size, F.lit(r.least)).otherwise(bound)
    return counted.where(F.col("freq") >= bound), number


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def mine(turns: DataFrame, keep: Sequence[str] = (), rules: tuple[MiningRule, ...] = (LONG, SHORT)) -> DataFrame:
    """(keep, sig, sig_len, freq) of all signatures. A group with fewer messages than the long rule's least has none."""
    found, texts = _mined(turns.select(*keep, F.make_valid_utf8("content").alias("body")), rules, keep, mining_text)
    enough = texts.where(F.col("n") >= LONG.least).select(*keep)
    found = found.join(enough, list(keep), "left_semi") if keep else found.where(enough.exists())
    return cut(found.select(*keep, "sig", F.length("sig").alias("sig_len"), "freq"))


def longest_match(turns: DataFrame, signatures: DataFrame, key: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(key, sig): the longest signature within each message, the first in code-point order among equals.

    Signatures have few lengths, so a message's windows of these lengths are looked up in the set of the signatures'
    hashes (128 bits each, of two hashes), rather than each signature searched for in each message; a message gives at
    most one row. ``keep`` must be part of ``key``; rows of equal key are one message.
    """
    (group,) = spare(turns, "_group")
    whose = F.xxhash64(*keep).alias(group) if keep else F.lit(0).cast("long").alias(group)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    bodies = turns.where(known).select(*key, whose, F.make_valid_utf8("content").alias("body"))
    grouped = signatures.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (*keep, "sig")])).select("sig", whose)
    parts = [best_windows(bodies, key, group, [LONG.size, SHORT.size], part, squeezed) for part in text_hashes(grouped, "sig", group)]
    held = _union(parts) if parts else turns.where("false").select(*key, F.lit(None).cast("string").alias("sig"))
    best = held.groupBy(*key).agg(F.min(F.struct((-F.length("sig")).alias("n"), "sig")).alias("_b"))
    return best.select(*key, F.col("_b.sig").alias("sig"))


def keep_first(rows: DataFrame, groups: Sequence[str], order: Sequence[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group. Spark limits groups before the shuffle, so a very common group is no
    large task; count what went as rows before less rows after."""
    (rank,) = spare(rows, "_rank")
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col(rank) <= most).drop(rank)
