"""The quality rubric of a prepared dataset: measures in one pass over the records, points from a table of rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwright.functions.text import find_pii, has_url, is_garbled, strip

# Dimensions and their weights, and the settings that a described configuration has.
WEIGHTS = {"pipeline_integrity": 15, "content_safety": 20, "cleaning_dedup": 25, "dataset_fitness": 25, "config_engineering": 15}
SETTINGS = (
    "train_ratio", "shuffle_seed", "agent_names", "clean_attachments", "clean_urls", "redact_pii", "pii_safe_patterns",
    "dedupe_canned", "dedupe_exact", "dedupe_sentences", "clean_fillers", "drop_filler_only", "min_message_length", "filter_sentences",
)
# Other names under which counters come.
ALIASES = {
    "duplicate_dropped": "duplicate_occurrences_dropped",
    "broken_dropped": "broken_conversations_dropped",
    "sentence_dropped": "sentence_occurrences_dropped",
    "canned_dropped": "canned_dominated_dropped",
    "canned_stripped": "canned_suffix_stripped",
}
PASS_MARK = 70
# Points of the rubric. Each list goes from the best step down, and a value that fits none has none.
AT_LEAST = {
    "made": ((0.98, 10), (0.95, 7), (0.90, 4)),
    "duplicates": ((100, 4), (1, 3)),
    "length": ((80, 4), (50, 3), (30, 2)),
}
AT_MOST = {
    "skipped": ((0, 5), (5, 3)),
    "pii": ((0, 10), (3, 7), (10, 4)),
    "urls": ((0, 6), (5, 4), (20, 2)),
    "empty": ((0, 4), (0.001, 3), (0.01, 1)),
    "spoilt": ((0, 6), (3, 4)),
}
WITHIN = {
    "stripped": ((0.3, 2.0, 8),),
    "sentences": ((0.5, 3.0, 6),),
    "share": ((0.45, 0.55, 8), (0.35, 0.65, 5)),
    "held": ((0.08, 0.15, 5), (0.05, 0.20, 3)),
}
# Points for what is neither a step nor a range.
URLS_KEPT, NO_CANNED, SOME_CANNED, SOME_SENTENCES, SPOILT, UNBALANCED, SEEDED, LOGGED, SETTINGS_POINTS = 6, 4, 5, 4, 2, 2, 5, 5, 5
# Fixed values: (least average of turns, most share of one-turn conversations, least turns of any, points).
TURNS = ((5, 0.01, 2, 8), (4, 0.05, 0, 5), (3, 1.0, 0, 3))


def measure(records: DataFrame, safe: Iterable[str] = ()) -> DataFrame:
    """One row of measures from (split, messages); message 0 is the prompt and counts for garbling alone.

    Records of fewer than two messages count as conversations and for nothing else.
    """
    safe = list(safe)
    said = F.when(F.size("messages") >= 2, F.slice("messages", F.lit(2), F.greatest(F.size("messages") - 1, F.lit(0)))).otherwise(F.slice("messages", 1, 0))

    def text(m: Column) -> Column:
        return F.coalesce(m["content"], F.lit(""))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)

    each = records.select("split", said.alias("s"), F.exists("messages", lambda m: is_garbled(text(m))).alias("garbled")).select(
        "split",
        "garbled",
        F.when(F.size("s") > 0, F.size("s")).alias("turns"),
        F.size(F.filter("s", lambda m: m["role"] == "user")).alias("user"),
        F.size(F.filter("s", lambda m: m["role"] == "assistant")).alias("assistant"),
        total(F.transform("s", lambda m: F.length(text(m)).cast("long"))).alias("chars"),
        F.size(F.filter("s", lambda m: strip(text(m)) == "")).alias("empty"),
        total(F.transform("s", lambda m: F.size(find_pii(text(m), safe)).cast("long"))).alias("pii"),
        F.size(F.filter("s", lambda m: has_url(text(m)))).alias("urls"),
    )

    def summed(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)

    return each.agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "valid").alias("valid"),
        F.count("turns").alias("talks"),
        summed("turns"),
        F.coalesce(F.min("turns"), F.lit(0)).cast("long").alias("min_turns"),
        F.coalesce(F.max("turns"), F.lit(0)).cast("long").alias("max_turns"),
        F.count_if(F.col("turns") == 1).alias("one_turn"),
        *(summed(c) for c in ("user", "assistant", "chars", "empty", "pii", "urls")),
        F.coalesce(F.bool_or("garbled"), F.lit(False)).alias("garbled"),
    )


@dataclass
class Counters:
    """What earlier stages dropped, as data."""

    total_raw: int = 0
    skip_count: int = 0
    duplicate_dropped: int = 0
    broken_dropped: int = 0
    sentence_dropped: int = 0
    canned_dropped: int = 0
    canned_stripped: int = 0

    @classmethod
    def read(cls, stats: Mapping[str, int] | None) -> Counters:
        stats = stats or {}
        return cls(**{k: stats.get(k, 0) or stats.get(ALIASES.get(k, ""), 0) or 0 for k in cls.__dataclass_fields__})


@dataclass
class Score:
    dimensions: dict[str, float]
    metrics: dict = field(default_factory=dict)

    @property
    def total(self) -> float:
        return round(sum(self.dimensions.values()), 1)

    @property
    def passed(self) -> bool:
        return self.total >= PASS_MARK


def _points(name: str, value: float) -> int:
    if name in AT_LEAST:
        return next((points for bound, points in AT_LEAST[name] if value >= bound), 0)
    if name in AT_MOST:
        return next((points for bound, points in AT_MOST[name] if value <= bound), 0)
    return next((points for low, high, points in WITHIN[name] if low <= value <= high), 0)


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0


def _cleaning(m: Mapping, counters: Counters) -> int:
    stripped, sentences = counters.canned_stripped / m["talks"], counters.sentence_dropped / m["talks"]
    if not counters.canned_dropped and not counters.canned_stripped:
        canned = NO_CANNED
    else:
        canned = _points("stripped", stripped) or (SOME_CANNED if stripped > 0 else 0)
    listed = _points("sentences", sentences) or (SOME_SENTENCES if sentences > 0 else 0)
    spoilt = 0 if m["garbled"] else _points("spoilt", m["empty"])
    return canned + listed + _points("duplicates", counters.duplicate_dropped) + (spoilt or SPOILT)


def _fitness(m: Mapping) -> int:
    said = m["user"] + m["assistant"]
    balance = (_points("share", m["user"] / said) or UNBALANCED) if said else 0
    average, single = m["turns"] / m["talks"], m["one_turn"] / m["talks"]
    depth = next((points for turns, lonely, least, points in TURNS if average >= turns and single <= lonely and m["min_turns"] >= least), 0)
    return balance + depth + _points("held", _share(m["valid"], m["train"] + m["valid"])) + _points("length", m["chars"] / max(m["turns"], 1))


def rate(m: Mapping, counters: Counters, settings: Mapping, logging_on: bool = True) -> Score:
    """Points of each dimension from one row of measures. Skips are inferred after measuring, where only the raw
    total is known."""
    talks, conversations, said = m["talks"], m["train"] + m["valid"], m["user"] + m["assistant"]
    skipped = counters.skip_count or (max(0, counters.total_raw - conversations) if counters.total_raw else 0)
    urls = _points("urls", m["urls"]) if settings.get("clean_urls", False) else URLS_KEPT
    seeded = settings.get("shuffle_seed") is not None
    points = (
        _points("made", _share(conversations, conversations + skipped)) + _points("skipped", skipped),
        _points("pii", m["pii"]) + urls + _points("empty", m["empty"] / max(talks, 1)),
        _cleaning(m, counters) if talks else 0,
        _fitness(m) if talks else 0,
        SETTINGS_POINTS * sum(k in settings for k in SETTINGS) / len(SETTINGS) + SEEDED * seeded + LOGGED * logging_on,
    )
    metrics = dict(m) | {
        "conversation_count": conversations,
        "skip_count": skipped,
        "avg_turns": round(m["turns"] / max(talks, 1), 1),
        "user_ratio": round(m["user"] / max(said, 1), 3),
        "avg_chars": round(m["chars"] / max(m["turns"], 1), 1),
        "counters": vars(counters),
    }
    return Score({k: round(float(p), 1) for k, p in zip(WEIGHTS, points, strict=True)}, metrics)


def leaks(records: DataFrame, safe: Iterable[str] = ()) -> DataFrame:
    """(split, role, value) of every leak that ``measure`` counts."""
    safe = list(safe)
    rows = records.where(F.size("messages") >= 2).select("split", F.posexplode("messages").alias("i", "m")).where("i > 0")
    return rows.select("split", F.col("m.role").alias("role"), F.explode(find_pii(F.coalesce("m.content", F.lit("")), safe)).alias("value"))


def report(score: Score, found: Iterable[tuple[str, str, str]] = ()) -> str:
    """The score as Markdown: a table of the dimensions, the measures as a list, and the first ten leaks given."""
    m = score.metrics
    verdict = "passed" if score.passed else "not passed"
    table = [f"| {name} | {points:g} | {WEIGHTS[name]} |" for name, points in score.dimensions.items()]
    dropped = ", ".join(f"{k} {v}" for k, v in m["counters"].items() if v) or "none"
    measures = [
        f"{m['conversation_count']} conversations: {m['train']} to train on, {m['valid']} held back, {m['skip_count']} skipped",
        f"{m['turns']} turns: {m['min_turns']} to {m['max_turns']} a conversation, {m['avg_turns']} on average",
        f"{m['user']} by users, {m['assistant']} by the assistant (share of users {m['user_ratio']})",
        f"{m['avg_chars']} characters a turn on average, {m['empty']} turns empty",
        f"{m['pii']} phone numbers and addresses, {m['urls']} turns with links, garbled text: {'yes' if m['garbled'] else 'no'}",
        f"counters: {dropped}",
    ]
    out = [f"# {score.total:g} of {sum(WEIGHTS.values())} points: {verdict}, {PASS_MARK} are needed", "", "| dimension | points | of |", "|-|-|-|", *table, "", *(f"- {line}" for line in measures)]
    listed = [f"- {split}, {role}: `{value}`" for split, role, value in list(found)[:10]]
    return "\n".join([*out, *(["", "Leaks:", *listed] if listed else [])])
