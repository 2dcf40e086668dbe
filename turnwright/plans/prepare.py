"""The whole preparation: turns to deduplicated, split chat records, with every counter as data."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.operators import dedup
from turnwright.operators.ranking import mersenne_positions, shuffled_positions, split_by_ratio
from turnwright.operators.turns import chat_records, conversation_stats, with_both_roles
from turnwright.sources.settings import PrepareSettings
from turnwright.storage import cut

KEY = ("split", "conv_pos")


@dataclass
class Prepared:
    """Turns that are left, and what went on the way."""

    turns: DataFrame
    counters: dict[str, int]

    def records(self, system_prompt: str) -> DataFrame:
        return chat_records(self.turns, system_prompt, KEY)

    def stats(self, split: str) -> dict[str, Any]:
        row = conversation_stats(self.turns.where(F.col("split") == split), KEY).first().asDict()
        return row if row["total_conversations"] else {"total_conversations": 0}


def placed(turns: DataFrame, settings: PrepareSettings) -> DataFrame:
    """Turns with split and conv_pos: conversations in the seed's order, the first share of them for training.

    The order is that of a seeded hash, or with ``python_shuffle`` the one that Python's seeded shuffle gives the
    conversations in order of their files, for datasets that must match such a run.
    """
    if settings.python_shuffle:
        first = F.min("file") if "file" in turns.columns else F.min("ticket_id")
        ids = mersenne_positions(turns.groupBy("ticket_id").agg(first.alias("_first")), "ticket_id", settings.shuffle_seed, "_first", "conv_pos").select("ticket_id", "conv_pos")
    else:
        ids = shuffled_positions(turns.select("ticket_id").distinct(), "ticket_id", settings.shuffle_seed, "conv_pos")
    where = split_by_ratio(ids, settings.train_ratio, "conv_pos")
    return turns.join(where, "ticket_id").select("split", "conv_pos", "ticket_id", "turn_pos", "role", "content", "comment_ids")


def prepare(turns: DataFrame, settings: PrepareSettings, total_raw: int | None = None) -> Prepared:
    """Both-roles filter, split, exact copies, listed phrases, templates, both-roles filter again.

    Counters: skip_count (of total_raw, without a usable conversation), duplicate_dropped, broken_dropped,
    sentence_dropped, canned_dropped, canned_stripped, canned_changed. An empty input has nothing left and zeros.
    Stages that are counted are kept in the shared folder.
    """
    s = settings
    now = cut(placed(with_both_roles(turns), s))
    counters = {k: 0 for k in ("total_raw", "skip_count", "duplicate_dropped", "broken_dropped", "sentence_dropped", "canned_dropped", "canned_stripped", "canned_changed")}
    built = turns.select("ticket_id").distinct().count()
    counters["total_raw"] = built if total_raw is None else total_raw
    counters["skip_count"] = counters["total_raw"] - built
    if s.dedupe_exact:
        limited = cut(dedup.limit_copies(now, s.max_duplicate_count))
        counters["duplicate_dropped"] = now.count() - limited.count()
        before = now.select(*KEY).distinct().count()
        now = cut(dedup.without_broken(limited, KEY))
        counters["broken_dropped"] = before - now.select(*KEY).distinct().count()
    if s.dedupe_sentences and s.filter_sentences:
        judged = cut(dedup.phrases(now, s.filter_sentences))
        counters["sentence_dropped"] = judged.agg(F.coalesce(F.sum("dropped"), F.lit(0))).first()[0]
        now = judged.where("content is not null").drop("dropped")
    if s.dedupe_canned:
        acted = cut(dedup.canned(now, s.max_duplicate_count))
        found = acted.agg(F.count_if(F.col("action") == "dropped"), F.count_if(F.col("action") == "stripped"), F.count_if("changed")).first()
        counters["canned_dropped"], counters["canned_stripped"], counters["canned_changed"] = found
        now = acted.where("content is not null").drop("sig", "action", "changed")
    return Prepared(cut(with_both_roles(now, KEY)), counters)


def summary(prepared: Prepared) -> dict[str, Any]:
    train, valid = prepared.stats("train"), prepared.stats("valid")
    if not train["total_conversations"] and not valid["total_conversations"]:
        return {"error": "no_conversations", **prepared.counters}
    return {**prepared.counters, "train_stats": train, "valid_stats": valid}
