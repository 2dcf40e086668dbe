import json
import shutil
import threading
from http.server import HTTPServer

import pytest

from tests.test_pipeline import Api, land
from turnwright.__main__ import main
from turnwright.operators.examples import IGNORED, example, render, tokenized
from turnwright.plans.export import export
from turnwright.sources.settings import ExportSettings
from turnwright.sources.tickets import read_tickets


class Talks(Api):
    def comments(self, ticket):
        return [{"id": 10 * ticket + i, "author_id": a, "created_at": f"x{i}", "body": b} for i, (a, b) in enumerate([(None, f"question {ticket} about the app"), (7, f"answer {ticket} with every detail")])]


def test_prepare_then_score(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(1, 21):
        land(raw, i, [(1, f"my question number {i} about the app"), (2, f"here is answer {i} with every detail")], note=None)
    assert main(["prepare", "--input", str(raw), "--output", str(tmp_path / "out")]) == 0
    found = json.loads(capsys.readouterr().out)
    assert found["train_stats"]["total_conversations"] == 18 and found["valid_stats"]["total_conversations"] == 2
    main(["score", "--train", str(tmp_path / "out/train"), "--valid", str(tmp_path / "out/valid"), "--stats", json.dumps(found), "--verbose"])
    assert " of 100 points: " in capsys.readouterr().out
    assert main(["analyze", "--input", str(raw)]) == 0
    assert "  filter_sentences:\n" in capsys.readouterr().out


def test_export_resumes_and_prepare_reads_it(spark, tmp_path, monkeypatch, capsys):
    server = HTTPServer(("127.0.0.1", 0), Talks)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        given = {"BASE_URL": f"http://127.0.0.1:{server.server_port}", "USER": "u", "TOKEN": "t", "RETRIES": "0"}
        for k, v in given.items():
            monkeypatch.setenv(f"TURNWRIGHT_{k}", v)
        command = ["export", "--output", str(tmp_path), "--start", "2024-01-01", "--end", "2024-01-05"]
        assert main(command) == 0
        assert json.loads(capsys.readouterr().out) == {"found": 40, "to_do": 40, "failed": 1, "already_done": 0, "exported": 39}
        shutil.rmtree(tmp_path / "done")  # as if the run had ended before it was done
        assert main(command) == 0 and json.loads(capsys.readouterr().out)["exported"] == 39
        assert main(command) == 0 and json.loads(capsys.readouterr().out) == {"found": 40, "to_do": 1, "failed": 1, "already_done": 39, "exported": 0}
        raw = read_tickets(spark, f"{tmp_path}/raw")
        assert raw.count() == raw.select("ticket_id").distinct().count() == 39
        land(tmp_path / "raw", 500, [(1, "one more question of theirs"), (2, "and the answer to that one")], note=None)
        assert main(["prepare", "--input", f"{tmp_path}/raw", "--output", f"{tmp_path}/out"]) == 0
        found = json.loads(capsys.readouterr().out)
        assert found["train_stats"]["total_conversations"] + found["valid_stats"]["total_conversations"] == found["total_raw"] == 40 and found["skip_count"] == 0
    finally:
        server.shutdown()
    assert export(spark, ExportSettings(), str(tmp_path))["error"] == "missing_credentials"
    assert export(spark, ExportSettings(base_url="x", token="t"), str(tmp_path))["error"] == "missing_start_date"


def test_examples(spark):
    talk = [{"role": "user", "content": "hello there"}, {"role": "assistant", "content": "good day"}]
    encode = lambda t: list(t.encode())
    ids, labels = example(talk, encode, 1000)
    reply = len(render(talk)) - len(render(talk[:1], True))
    assert labels[-reply:] == ids[-reply:] and set(labels[:-reply]) == {IGNORED}
    ids, labels = example(talk, encode, 20)
    assert len(ids) == 20 and labels == ids
    tokenizers = pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([([("user", "hello there"), ("assistant", "good day")],), ([],)], "messages array<struct<role:string,content:string>>")
    rows = tokenized(df, tokenizers.path("byte_bpe_50k.json")).collect()
    assert len(rows) == 1 and len(rows[0].input_ids) == len(rows[0].labels) == len(rows[0].attention_mask) and IGNORED in rows[0].labels


def test_examples_are_handed_back_some_at_a_time():
    import pyarrow as pa

    from turnwright.operators import examples

    tokenizers = pytest.importorskip("public_tokenizers")
    given = []

    class Records:
        where = select = lambda self, *_: self

        def mapInArrow(self, run, schema):  # noqa: N802
            talk = [[{"role": "user", "content": f"number {i}"}, {"role": "assistant", "content": "yes"}] for i in range(1000)]
            given.extend(run(iter([pa.RecordBatch.from_pylist([{"messages": m} for m in talk])])))

    examples.tokenized(Records(), tokenizers.path("byte_bpe_50k.json"), 512)
    assert sum(b.num_rows for b in given) == 1000 and max(b.num_rows for b in given) <= examples.ROWS
    assert len({tuple(r["input_ids"]) for b in given for r in b.to_pylist()}) == 1000
