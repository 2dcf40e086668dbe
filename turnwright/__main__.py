"""python -m turnwright export | prepare | analyze | score"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from turnwright.operators import score
from turnwright.operators.dedup import top_sentences
from turnwright.plans.export import export
from turnwright.plans.prepare import placed, prepare, summary
from turnwright.sources.settings import load_settings
from turnwright.sources.tickets import build_turns, read_records, read_summary, read_tickets, write_records, write_summary


def phrase_settings(sentences: list[str]) -> str:
    """The sentences as settings to paste: JSON strings are YAML ones too, whatever they hold."""
    return "\n".join(["prepare:", "  filter_sentences:", *(f"    - {json.dumps(s, ensure_ascii=False)}" for s in sentences)])


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="turnwright")
    parser.add_argument("command", choices=["export", "prepare", "analyze", "score"])
    parser.add_argument("--config")
    parser.add_argument("--input", default="data/raw")
    parser.add_argument("--output", default="data")
    parser.add_argument("--train", default="data/train")
    parser.add_argument("--valid", default="data/valid")
    parser.add_argument("--stats", help="counters: a file or inline JSON")
    parser.add_argument("--start")
    parser.add_argument("--end")
    parser.add_argument("--top", type=int, default=60)
    parser.add_argument("--listed", type=int, default=5, help="sentences that analyze writes as settings")
    parser.add_argument("--verbose", action="store_true")
    a = parser.parse_args(arguments)
    settings = load_settings(a.config, start=a.start, end=a.end)
    spark = SparkSession.builder.appName("turnwright").getOrCreate()
    p = settings.prepare
    if a.command == "export":
        done = export(spark, settings.export, a.output)
        print(json.dumps(done))
        return int("error" in done)
    if a.command in ("prepare", "analyze"):
        raw = read_tickets(spark, a.input)
        turns = build_turns(raw, p)
        if a.command == "analyze":
            found = top_sentences(placed(turns, p), a.top).collect()
            for row in found:
                print(f"{row.freq:6d}  {row.role:8s}  {row.sentence}")
            print(phrase_settings([row.sentence for row in found[: a.listed]]))
            return 0
        done = prepare(turns, p, raw.select("file").distinct().count())
        found = summary(done)
        if "error" not in found:
            records = done.records(p.system_prompt)
            for split in ("train", "valid"):
                write_records(records.where(F.col("split") == split), f"{a.output}/{split}")
            write_summary(spark, found, f"{a.output}/score_stats")
        print(json.dumps(found))
        return int("error" in found)
    records = read_records(spark, a.train).withColumn("split", F.lit("train")).unionByName(read_records(spark, a.valid).withColumn("split", F.lit("valid")))
    measured = score.measure(records, p.pii_safe_patterns).first().asDict()
    described = settings.raw.get("prepare") or settings.raw.get("dataset") or {}
    result = score.rate(measured, score.Counters.read(read_summary(a.stats)), described)
    leaks = [tuple(r) for r in score.leaks(records, p.pii_safe_patterns).limit(10).collect()] if a.verbose else []
    print(score.report(result, leaks))
    return int(not result.passed)


if __name__ == "__main__":
    sys.exit(main())
