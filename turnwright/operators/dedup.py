"""Limiting repeated, listed and template-like messages. All of it is per split and keeps the earliest copies.

Turns are (split, conv_pos, turn_pos, role, content, …); (conv_pos, turn_pos) is the order. Neighbours that come to
share a role stay separate turns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnwright.functions.sentences import filter_phrases, split_sentences
from turnwright.functions.text import drop_signature, same_text_key, squeeze
from turnwright.operators.ranking import spare
from turnwright.operators.signatures import keep_first, longest_match, mine
from turnwright.operators.turns import without_broken

CONVERSATION = ("split", "conv_pos")
TURN = ("split", "conv_pos", "turn_pos")
COVERAGE, LEAST_LEFT = 0.6, 10


def limit_copies(turns: DataFrame, most: int) -> DataFrame:
    """At most ``most`` turns of each text, by its key, in each split. What is sorted and shuffled beside a turn is its
    key's SHA-256 rather than a second copy of the text; it comes first, as it tells turns apart in its first bytes."""
    (key,) = spare(turns, "_text")
    keyed = turns.withColumn(key, F.unhex(F.sha2(same_text_key(F.col("content")), 256)))
    return keep_first(keyed, (key, "split"), ("conv_pos", "turn_pos"), most).drop(key)


def exact(turns: DataFrame, most: int) -> DataFrame:
    """Copies limited; conversations left with fewer than two turns dropped."""
    return without_broken(limit_copies(turns, most), CONVERSATION)


def phrases(turns: DataFrame, listed: Sequence[str]) -> DataFrame:
    """Turns without the listed phrases, with the count ``dropped``; content is null where nothing is left."""
    (f,) = spare(turns, "_f")
    judged = turns.withColumn(f, filter_phrases(F.col("content"), list(listed)))
    return judged.withColumn("content", F.col(f"{f}.text")).withColumn("dropped", F.col(f"{f}.dropped")).drop(f)


def canned(turns: DataFrame, most: int) -> DataFrame:
    """Every turn with ``sig``, ``action`` (none, kept, dropped or stripped) and ``changed``, in place of columns of
    these names; content is null for dropped turns.

    A turn of which its signature covers COVERAGE is kept up to ``most`` times for the signature; from others the
    phrase is stripped if it is at an end, and the turn goes if fewer than LEAST_LEFT characters are left.
    ``changed`` tells stripped turns whose text did change.
    """
    turns = turns.drop("sig", "action", "changed")
    dominant, rank, left = spare(turns, "_dominant", "_rank", "_left")
    matched = turns.join(longest_match(turns, mine(turns, ("split",)), TURN, ("split",)), list(TURN), "left")
    share = F.when(F.col("sig").isNotNull(), F.length("sig") / F.greatest(F.length(squeeze(F.col("content"))), F.lit(1)))
    matched = matched.withColumn(dominant, F.coalesce(share >= COVERAGE, F.lit(False)))
    order = F.row_number().over(Window.partitionBy("split", "sig").orderBy("conv_pos", "turn_pos"))
    covered = matched.where(F.col(dominant)).withColumn(rank, order)
    covered = covered.withColumn("action", F.when(F.col(rank) <= most, F.lit("kept")).otherwise(F.lit("dropped"))).drop(rank).withColumn("changed", F.lit(False)).withColumn("content", F.when(F.col("action") == "kept", F.col("content")))
    others = matched.where(~F.col(dominant)).withColumn(left, F.when(F.col("sig").isNotNull(), drop_signature(F.col("content"), F.col("sig"))))
    fine = F.coalesce(F.length(left) >= LEAST_LEFT, F.lit(False))
    action = F.when(F.col("sig").isNull(), F.lit("none")).when(fine, F.lit("stripped")).otherwise(F.lit("dropped"))
    others = others.withColumn("action", action).withColumn("changed", F.coalesce(fine & (F.col(left) != F.col("content")), F.lit(False)))
    others = others.withColumn("content", F.when(F.col("action") == "none", F.col("content")).when(F.col("action") == "stripped", F.col(left))).drop(left)
    return covered.unionByName(others).drop(dominant)


def sentence_counts(turns: DataFrame, longer_than: int = 15, order: Sequence[str] = ("conv_pos", "turn_pos")) -> DataFrame:
    """(sentence, freq, role, first_seen) of sentences that occur twice or more; role and place are the first's."""
    parts = turns.select(*order, "role", F.posexplode(split_sentences(F.col("content"))).alias("sent_pos", "sentence")).where(F.length("sentence") > longer_than)
    place = F.struct(*order, "sent_pos")
    return parts.groupBy("sentence").agg(F.count("*").alias("freq"), F.min_by("role", place).alias("role"), F.min(place).alias("first_seen")).where("freq > 1")


def top_sentences(turns: DataFrame, n: int, **options) -> DataFrame:
    """The n most frequent sentences; of equal frequency those seen first."""
    return sentence_counts(turns, **options).orderBy(F.desc("freq"), "first_seen").limit(n)
