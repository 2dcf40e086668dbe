from tests.test_pipeline import S, land
from turnwright.sources.tickets import read_tickets
from turnwright.streaming.ingest import ingest


def test_tickets_come_once(spark, tmp_path):
    raw, out, state = tmp_path / "raw", tmp_path / "out", tmp_path / "state"
    raw.mkdir()
    land(raw, 1, [(1, "hello there"), (2, "hi, how can I help")], note=None)
    ingest(spark, str(raw), str(out), str(state), S).awaitTermination()
    land(raw, 2, [(1, "another one"), (2, "of course")], note=None)
    (raw / "ticket_1b.json").write_text((raw / "ticket_1.json").read_text())
    ingest(spark, str(raw), str(out), str(state), S).awaitTermination()
    rows = spark.read.parquet(str(out / "turns"))
    assert sorted((r.ticket_id, r.turn_pos) for r in rows.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_exported_lines_come_once(spark, tmp_path):
    raw, landed, out, state = (tmp_path / name for name in ("raw", "landed", "out", "state"))
    raw.mkdir()
    for i in (1, 2):
        land(raw, i, [(1, f"hello there {i}"), (2, "hi, how can I help")], note=None)
        read_tickets(spark, str(raw)).where(f"ticket_id = {i}").drop("file", "_corrupt").write.json(f"{landed}/batch={i}")
        ingest(spark, str(landed), str(out), str(state), S, lines=True).awaitTermination()
    rows = spark.read.parquet(str(out / "turns"))
    assert sorted((r.ticket_id, r.turn_pos) for r in rows.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]
