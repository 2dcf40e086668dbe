"""Tickets to records, deduplication, scoring, settings and the search source."""

import json
import re
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from turnwright.operators import dedup, score, signatures, turns
from turnwright.operators.ranking import mersenne_positions, shuffled_positions, split_by_ratio
from turnwright.plans import prepare as prepare_module
from turnwright.plans.prepare import prepare, summary
from turnwright.sources import tickets
from turnwright.sources.rest import TicketSearch, fetch_comments, midpoint
from turnwright.sources.settings import PrepareSettings, load_settings, validate_models

S = PrepareSettings(agent_names=("Support Team",), min_message_length=1)


def land(folder, number, bodies, requester=1, note="Conversation with Ann"):
    comments = [{"id": 100 * number, "author_id": 9, "created_at": "a", "public": False, "body": note}] if note else []
    comments += [{"id": 100 * number + i, "author_id": a, "created_at": f"b{i}", "public": True, "body": b} for i, (a, b) in enumerate(bodies, 1)]
    doc = {"ticket_id": number, "channel": "web", "metadata": {"id": number, "requester_id": requester}, "comments": comments}
    (folder / f"ticket_{number}.json").write_text(json.dumps(doc, ensure_ascii=False, indent=1), encoding="utf-8")


def built(spark, folder, settings=S):
    rows = tickets.build_turns(tickets.read_tickets(spark, str(folder)), settings)
    return [(r.ticket_id, r.role, r.content) for r in rows.orderBy("ticket_id", "turn_pos").collect()]


def test_ticket_dialects(spark, tmp_path):
    land(tmp_path, 1, [(-1, "(08:00:00) Ann: my app does not open\n(08:01:00) Support Team: please reinstall it"), (-1, "(08:02:00) Ann: it works again now")])
    land(tmp_path, 2, [(1, "hello there"), (7, "hi, how can I help"), (7, "still here")], note=None)
    land(tmp_path, 3, [(-1, "(08:00:00) aNN: call 0801234567 or ann@example.com\n(08:01:00) Zed: hi there")])
    land(tmp_path, 4, [(-1, "(08:00:00) Ann: no name here")], note=None)
    land(tmp_path, 5, [])
    (tmp_path / "ticket_6.json").write_text("{bad")
    assert built(spark, tmp_path) == [
        (1, "customer", "my app does not open"), (1, "agent", "please reinstall it"), (1, "customer", "it works again now"),
        (2, "customer", "hello there"), (2, "agent", "hi, how can I help\nstill here"),
        (3, "customer", "call [phone] or [email]"), (3, "agent", "hi there"),
        (4, "agent", "(08:00:00) Ann: no name here"),
    ]
    raw = tickets.read_tickets(spark, str(tmp_path)).cache()
    assert raw.where("_corrupt is not null").count() == 1 and raw.count() == 6


def talk(spark, rows, split="train"):
    return spark.createDataFrame([(split, c, c, i, r, t, [i]) for c, i, r, t in rows], "split string, conv_pos long, ticket_id long, turn_pos int, role string, content string, comment_ids array<long>")


def test_exact_copies(spark):
    rows = talk(spark, [(c, i, r, t) for c in range(4) for i, (r, t) in enumerate([("customer", f"question {c}"), ("agent", "Same  Answer" if c % 2 else "same answer")])])
    left = dedup.exact(rows, 2).select("conv_pos").distinct().orderBy("conv_pos").collect()
    assert [r[0] for r in left] == [0, 1]
    again = dedup.exact(dedup.exact(rows, 2), 2)
    assert again.count() == 4


def test_columns_of_the_names_used_inside(spark):
    """Further columns pass through, whatever they are called."""
    rows = talk(spark, [(c, 0, "agent", "a message of thirty characters" if c < 8 else f"message {c} of its own") for c in range(10)])
    own = ("_rank", "_text", "_f", "_key", "_range", "_start", "_n", "_dominant", "_left", "body")
    for name in own:
        rows = rows.withColumn(name, F.concat(F.lit(name), "conv_pos"))
    done = dedup.phrases(dedup.canned(dedup.limit_copies(rows, 9), 2).where("content is not null"), ["of its"])
    ids = split_by_ratio(shuffled_positions(rows.drop("split", "conv_pos"), "ticket_id", 1), 0.5)
    for found in (done, ids):
        for r in found.collect():
            assert all(r[name] == f"{name}{r.ticket_id}" for name in own)
    assert done.count() == 4 and ids.count() == 10


def test_splits_are_deduplicated_apart(spark):
    rows = talk(spark, [(0, 0, "agent", "x"), (1, 0, "agent", "x")]).unionByName(talk(spark, [(2, 0, "agent", "x")], "valid"))
    assert dedup.limit_copies(rows, 1).count() == 2


def test_merge_and_fold_agree(spark):
    rows = talk(spark, [(0, 0, "customer", "a"), (0, 1, "customer", "b"), (0, 2, "agent", "c"), (0, 3, "customer", "d")])
    merged = [(r.role, r.content, r.comment_ids) for r in turns.merge_runs(rows).orderBy("turn_pos").collect()]
    assert merged == [("customer", "a\nb", [0, 1]), ("agent", "c", [2]), ("customer", "d", [3])]


def test_split_is_exact_and_ignores_partitions(spark):
    ids = spark.range(1000).withColumnRenamed("id", "ticket_id")
    one, two = (split_by_ratio(shuffled_positions(ids.repartition(n), "ticket_id", 7, "conv_pos"), 0.9, "conv_pos").orderBy("conv_pos").collect() for n in (1, 7))
    assert one == two and [r.conv_pos for r in one] == list(range(1000))
    assert sum(r.split == "train" for r in one) == 900


def test_shuffle_as_python_does(spark):
    import random

    want = list(range(50))
    random.Random(42).shuffle(want)
    rows = mersenne_positions(spark.range(50).withColumnRenamed("id", "t"), "t", 42)
    assert [r.t for r in rows.orderBy("pos").collect()] == want


def test_signatures(spark):
    phrase = "this very phrase is used in every single message of theirs"
    rows = talk(spark, [(i, 0, "agent", f"prefix{i}. {phrase}") for i in range(6)])
    assert signatures.mine(rows, ("split",)).where("sig_len = 25").count() >= 1
    assert signatures.mine(talk(spark, [(i, 0, "agent", phrase) for i in range(4)]), ("split",)).count() == 0
    urls = talk(spark, [(i, 0, "agent", f"https://host.example/{'p' * 60} plus{i}") for i in range(6)])
    assert signatures.mine(urls, ("split",)).where("sig like '%host%'").count() == 0
    dominant = talk(spark, [(i, 0, "agent", "a message of thirty characters"[:30]) for i in range(8)])
    found = {r.action: r["count"] for r in dedup.canned(dominant, 2).groupBy("action").count().collect()}
    assert found == {"kept": 2, "dropped": 6}


def test_long_message_windows(spark, monkeypatch):
    from turnwright.functions import windows

    long = "".join(f"{i:06d} " for i in range(3000))
    rows = talk(spark, [(0, 0, "agent", long), (1, 0, "agent", "x"), (2, 0, "agent", "é" + long[14000:14025] + "😀")])
    sigs = spark.createDataFrame([("train", long[14000:14025], 25), ("train", "nowhere to be found in it", 25), ("train", long[:15], 15)], "split string, sig string, sig_len int")
    for chunk in (windows.CHUNK, 1000):
        monkeypatch.setattr(windows, "CHUNK", chunk)
        found = signatures.longest_match(rows, sigs, dedup.TURN, ("split",)).orderBy("conv_pos").collect()
        assert [(r.conv_pos, r.sig) for r in found] == [(0, long[14000:14025]), (2, long[14000:14025])]


def test_mining_equals_plain_counts(spark, monkeypatch):
    import random
    from collections import Counter

    from turnwright.functions import windows

    rng = random.Random(3)
    phrases = ["ขอบคุณที่ติดต่อเรา ครับ ", "thank you for writing to us 😀 ", "see https://e.com/x now "]
    texts = ["".join(rng.choice([*phrases, "a b c ", f"{rng.random()} "]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    want = Counter()
    for n, t in enumerate(texts):
        body = re.sub(r"https?://\S+", "[url]", " ".join(t.split()))
        for size in (25, 15) if len(body) >= 25 else ():
            for i in range(0, max(1, len(body) - size), max(1, len(body) // 30)):
                want["train" if n % 2 else "valid", body[i : i + size]] += 1
    rows = spark.createDataFrame([("train" if n % 2 else "valid", n, n, 0, "agent", t, [0]) for n, t in enumerate(texts)], "split string, conv_pos long, ticket_id long, turn_pos int, role string, content string, comment_ids array<long>")
    want = {(k, s): n for (k, s), n in want.items() if n >= (5 if len(s) == 25 else 30)}
    assert len(want) > 20
    for chunk in (windows.CHUNK, 300):
        monkeypatch.setattr(windows, "CHUNK", chunk)
        assert {(r.split, r.sig): r.freq for r in signatures.mine(rows, ("split",)).collect()} == want


def test_mined_bodies_are_the_same_in_python(spark):
    parts = ["a", "é😀", "https://e.com/x", "http://", "https:// x", " ", "  ", "\n", "\x1c", "\x85", "\u2028", "\xa0", "words that are some more than a few"]
    values = [a + b + c + d for a in parts for b in parts for c in parts for d in ("", " and then the end of it all")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], "i int, content string")
    found = {r.i: r.body for r in signatures.mining_texts(rows, ["i"]).collect()}
    assert found == {i: signatures.mining_text(v) for i, v in enumerate(values) if signatures.mining_text(v) is not None} and len(found) > 100
    squeezed = {r.i: r.body for r in rows.select("i", signatures.squeeze(F.col("content")).alias("body")).collect()}
    assert squeezed == {**{i: signatures.squeezed(v) for i, v in enumerate(values)}, len(values): None}


def test_copies_are_told_apart_without_their_texts(spark):
    """Beside a turn, its key's 32 bytes are sorted and shuffled, not its text once more."""
    rows = talk(spark, [(i, 0, "agent", f"{'long ' * 400}{i % 7}") for i in range(70)])
    plan = dedup.limit_copies(rows, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert dedup.limit_copies(rows, 2).count() == 14 and "sha2" in plan


def test_longer_signature_of_a_later_piece_wins(spark, monkeypatch):
    from turnwright.functions import windows

    short, long = "short signature", "a signature of 25 letters"
    sigs = spark.createDataFrame([("train", short), ("train", long), ("train", "a signature of 25 lettert")], "split string, sig string")
    bodies = [short + " " + "x" * 300 + long + " " + short, "y" * 90 + short + "z" * 200, "q" * 500, long[:-1] + "t " + "w" * 80 + long, ""]
    rows = talk(spark, [(i, 0, "agent", b) for i, b in enumerate(bodies)])
    for chunk in (windows.CHUNK, 100, 64):
        monkeypatch.setattr(windows, "CHUNK", chunk)
        found = {r.conv_pos: r.sig for r in signatures.longest_match(rows, sigs, dedup.TURN, ("split",)).collect()}
        assert found == {0: long, 1: short, 3: long}


def test_large_sets_let_no_other_windows_through(spark, monkeypatch):
    """A set that has outgrown a bitmap of fixed size, whole and in several passes."""
    import random

    from turnwright.functions import windows

    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abcdefghij ก😀", k=n))
    listed, bodies = [text(25) for _ in range(120_000)], [f"x{text(300)}y" for _ in range(200)]
    planted = {i: min(listed[i], listed[i + 1]) for i in range(0, 200, 4)}
    bodies = [f"{b} {listed[i]} {listed[i + 1]}" if i in planted else b for i, b in enumerate(bodies)]
    sigs = spark.createDataFrame([(t, 7) for t in listed], "sig string, g long").repartition(4)
    rows = spark.createDataFrame(list(enumerate([*bodies, None, ""])), "k int, body string").withColumn("g", F.when(F.col("k") % 8 == 4, 8).otherwise(7).cast("long"))
    for most, least in ((windows.MOST, 1), (50_000, 3)):
        monkeypatch.setattr(windows, "MOST", most)
        parts = windows.text_hashes(sigs, "sig", "g")
        assert len(parts) >= least
        found = [r for p in parts for r in windows.best_windows(rows, ["k"], "g", [25, 15], p).collect()]
        assert {r.k: min(x.sig for x in found if x.k == r.k) for r in found} == {i: s for i, s in planted.items() if i % 8 == 0}
        assert len(found) <= 2 * len(planted)


def test_mining_in_passes(spark, monkeypatch):
    from turnwright.functions import windows

    rows = talk(spark, [(i, 0, "agent", f"{i % 40} is the number of a phrase that comes {i % 40} times and then some {i}") for i in range(400)])
    once = {(r.sig, r.freq) for r in signatures.mine(rows, ("split",)).collect()}
    match = {tuple(r) for r in signatures.longest_match(rows, signatures.mine(rows, ("split",)), dedup.TURN, ("split",)).collect()}
    monkeypatch.setattr(windows, "MOST", 100)
    assert len(once) > 200 and {(r.sig, r.freq) for r in signatures.mine(rows, ("split",)).collect()} == once
    assert {tuple(r) for r in signatures.longest_match(rows, signatures.mine(rows, ("split",)), dedup.TURN, ("split",)).collect()} == match
    assert signatures.mine(rows.limit(0)).count() == 0


def test_tickets_of_one_file_are_parsed_by_all_cores(spark):
    note = [(1, -1, "2024", False, "Conversation with Ann", None), (2, -1, "2025", True, "(08:00:00) ANN: it does not open\n(08:01:00) Bo: please reinstall it", None)]
    rows = spark.createDataFrame([(i, i, (i,), note) for i in range(200)], f"ticket_id bigint, id bigint, metadata struct<requester_id:bigint>, comments array<{tickets.COMMENT}>").coalesce(1)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        built = tickets.build_turns(rows, PrepareSettings()).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len({r.task for r in built}) == 4
    assert {(r.ticket_id, r.turn_pos, r.role, r.content) for r in built} == {(i, *t) for i in range(200) for t in ((0, "customer", "it does not open"), (1, "agent", "please reinstall it"))}


def test_shared_folder(spark):
    from types import SimpleNamespace as Fake

    from turnwright.storage import scratch, shared_dir

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")
    unset = Fake(get=lambda *_: None)
    lost = Fake(sparkContext=Fake(getConf=lambda: unset, getCheckpointDir=lambda: None, master="spark://host:7077"), conf=unset)
    with pytest.raises(RuntimeError):
        shared_dir(lost)


def test_python_order(spark):
    import random

    rows = talk(spark, [(c, i, r, f"{r} {c}") for c in range(30) for i, r in enumerate(["customer", "agent"])]).drop("split", "conv_pos").withColumn("file", F.format_string("ticket_%d.json", "ticket_id"))
    want = sorted(range(30), key=lambda i: f"ticket_{i}.json")
    random.Random(42).shuffle(want)
    found = prepare_module.placed(rows, PrepareSettings(python_shuffle=True)).select("ticket_id", "conv_pos").distinct().orderBy("conv_pos").collect()
    assert [r.ticket_id for r in found] == want


def test_prepare_and_empty(spark):
    rows = talk(spark, [(c, i, r, f"{r} says number {c} and {i} of all") for c in range(10) for i, r in enumerate(["customer", "agent"])])
    done = prepare(rows.drop("split", "conv_pos"), PrepareSettings(), total_raw=12)
    found = summary(done)
    assert found["skip_count"] == 2 and found["train_stats"]["total_conversations"] == 9 and found["valid_stats"]["total_conversations"] == 1
    empty = prepare(rows.drop("split", "conv_pos").limit(0), PrepareSettings())
    assert summary(empty)["error"] == "no_conversations"


def test_record_files(spark, tmp_path):
    rows = turns.chat_records(talk(spark, [(0, 0, "customer", "สวัสดี"), (0, 1, "agent", "ok")]), "Be kind.", ("conv_pos",))
    tickets.write_records(rows, str(tmp_path / "out"), "conv_pos", single_file=True)
    back = tickets.read_records(spark, str(tmp_path / "out")).first().messages
    assert [(m.role, m.content) for m in back] == [("system", "Be kind."), ("user", "สวัสดี"), ("assistant", "ok")]
    assert tickets.read_records(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        tickets.read_records(spark, str(tmp_path / "none"), required=True)
    (tmp_path / "s.json").write_text('{"total_raw": 5}')
    assert tickets.read_summary(str(tmp_path / "s.json")) == tickets.read_summary('{"total_raw": 5}') == {"total_raw": 5}
    assert tickets.read_summary(None, (str(tmp_path / "no.json"), str(tmp_path / "s.json"))) == {"total_raw": 5}


def test_archived_score_is_reproduced():
    m = {"train": 1808, "valid": 206, "talks": 2014, "turns": 12672, "min_turns": 2, "max_turns": 76, "one_turn": 0, "user": 6391, "assistant": 6281, "chars": 1717056, "empty": 0, "pii": 0, "urls": 945, "garbled": True}
    counters = score.Counters.read({"total_raw": 2039, "skip_count": 25, "duplicate_occurrences_dropped": 180, "broken_dropped": 38, "sentence_dropped": 1356, "canned_stripped": 3041, "canned_dropped": 23})
    found = score.rate(m, counters, dict.fromkeys(score.SETTINGS, 1) | {"clean_urls": False})
    assert found.dimensions == {"pipeline_integrity": 10, "content_safety": 20, "cleaning_dedup": 20, "dataset_fitness": 25, "config_engineering": 15}
    assert found.total == 90 and found.passed
    assert score.report(found).startswith("# 90 of 100 points: passed") and score.report(found, [("train", "user", "x")] * 20).count("train, user: `x`") == 10


def test_measures(spark):
    rows = spark.createDataFrame([("train", [("system", "s"), ("user", "call 0801234567"), ("assistant", " ")]), ("valid", [("system", "broken bscription")])], "split string, messages array<struct<role:string,content:string>>")
    m = score.measure(rows).first()
    assert (m.train, m.valid, m.talks, m.turns, m.empty, m.pii, m.garbled) == (1, 1, 1, 2, 1, 1, True)
    assert [(r.split, r.role, r.value) for r in score.leaks(rows).collect()] == [("train", "user", "0801234567")]
    assert score.measure(rows.limit(0)).first().talks == 0


def test_settings(tmp_path):
    path = tmp_path / "c.yaml"
    try:
        import yaml  # noqa: F401

        path.write_text("dataset:\n  train_ratio: 0.8\n  agent_names: [A, B]\n")
        found = load_settings(str(path), {"TURNWRIGHT_SHUFFLE_SEED": "7", "TURNWRIGHT_CLEAN_URLS": "false"}, train_ratio=0.7).prepare
        assert (found.train_ratio, found.agent_names, found.shuffle_seed, found.clean_urls) == (0.7, ("A", "B"), 7, False)
    except ImportError:
        pass
    assert load_settings(None, {}).prepare == PrepareSettings()
    assert validate_models("a", "a") == [] and len(validate_models("a", "b")) == 1
    with pytest.raises(ValueError):
        validate_models("", "b")


class Api(BaseHTTPRequestHandler):
    rows = [{"id": i, "subject": f"s{i}", "created_at": f"2024-01-{1 + i // 10:02d}T00:00:00Z", "tags": None, "via": {"channel": "web"}} for i in range(100)]

    def do_GET(self):
        url = urlparse(self.path)
        q = {k: v[0] for k, v in parse_qs(url.query).items()}
        if "/comments" in url.path:
            ticket = int(url.path.split("/")[2])
            code, body = (404, {}) if ticket == 13 else (200, {"comments": self.comments(ticket), "next_page": None})
        else:
            terms = dict(t.split(":", 1) for t in q["query"].split() if ":" in t)
            start, end = q["query"].split("created>=")[1].split()[0], q["query"].split("created<")[1].split()[0] if "created<" in q["query"] else "9"
            found = [r for r in self.rows if start <= r["created_at"] < end and terms.get("via", "web") == "web"]
            page, size = int(q.get("page", 1)), int(q["per_page"])
            part = found[(page - 1) * size : page * size]
            more = f"http://127.0.0.1:{self.server.server_port}{self.path.split('&page=')[0]}&page={page + 1}" if page * size < len(found) else None
            code, body = 200, {"count": len(found), "results": part, "next_page": more}
        self.send_response(code)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def comments(self, ticket):
        return [{"id": ticket, "author_id": 1, "created_at": "x", "body": "b"}]

    def log_message(self, *_):
        pass


class Crowded(Api):
    """All tickets within one day, and no more than 20 of a search."""

    rows = [{"id": i, "subject": f"s{i}", "created_at": f"2024-01-01T{i // 60:02d}:{i % 60:02d}:07Z", "tags": None} for i in range(100)]


def test_a_day_above_the_cap_is_cut_finer(spark):
    from datetime import datetime

    from turnwright.sources.rest import instant

    assert instant(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1)) is None
    server = HTTPServer(("127.0.0.1", 0), Crowded)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(TicketSearch)
        reader = spark.read.format("ticket_search").options(base_url=f"http://127.0.0.1:{server.server_port}", start="2024-01-01", end="2024-01-02", page_size="7", retries="0")
        assert sorted(r.id for r in reader.option("most_rows", "20").load().collect()) == list(range(100))
        with pytest.raises(Exception, match="in the second"):
            reader.option("most_rows", "1").load().collect()
    finally:
        server.shutdown()


def test_search_source(spark):
    from datetime import date

    assert midpoint(date(2024, 1, 1), date(2024, 1, 2)) is None and midpoint(date(2024, 1, 1), date(2024, 1, 5)) == date(2024, 1, 3)
    server = HTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        base = f"http://127.0.0.1:{server.server_port}"
        spark.dataSource.register(TicketSearch)
        df = spark.read.format("ticket_search").options(base_url=base, start="2024-01-01", end="2024-02-01", most_rows="30", page_size="7", retries="1").load()
        assert sorted(r.id for r in df.collect()) == list(range(100))
        assert df.rdd.getNumPartitions() > 1
        late = df.where((F.col("channel") == "web") & (F.col("created_at") >= "2024-01-09"))
        assert sorted(r.id for r in late.collect()) == list(range(80, 100))
        done = spark.range(50)
        assert tickets.not_yet_done(df.select("id"), done).count() == 50
        found = fetch_comments(df.where("id < 20").select("id"), base)
        rows = found.collect()
        assert sorted(r.ticket_id for r in rows if r.failed) == [13]
        assert sorted(r.id for r in rows if not r.failed) == [i for i in range(20) if i != 13]
    finally:
        server.shutdown()
