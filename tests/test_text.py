"""Hand-derived cases and a property test of the text rules against plain Python models of them."""

import re
import time
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnwright.functions import sentences, text


def apply(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r.o for r in rows.select("i", f(F.col("c")).alias("o")).orderBy("i").collect()]


PARTS = st.lists(
    st.sampled_from(["ครับ", "อีเมล", "test@example.com", "a@b-c.co.th", "0801234567", "+66 81 234 5678", "https://e.com/a.b).", " ", "\n", "\xa0", "\x85", "\x1c", "\r", "๑๒", "1.5", ". ", "x", "é", "😀", "ๆ", "[image]", "[image]", "[link] ", "a.png\nURL: https://e.com/a\nType: image/png\nSize: 12", "b-c.pdf\nURL:\nhttp://x\nType: ", "\nSize: 3", "Type:", "URL:"]),
    max_size=12,
).map("".join)


def test_strip_and_squeeze_know_unicode_space(spark):
    values = ["\n\xa0 x \xa0\n", "a \t\x85 b", "", "　", None]
    assert apply(spark, values, text.strip) == ["x", "a \t\x85 b", "", "", None]
    assert apply(spark, values, text.squeeze) == ["x", "a b", "", "", None]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PARTS, min_size=40, max_size=40))
def test_rules_equal_python_models(spark, values):
    email, phone = re.compile(r"[\w.+-]+@[\w.-]+\.\w+"), re.compile(r"(?:\+66[-\s]?|0)\d{1,2}[-\s]?\d{3}[-\s]?\d{4}")
    assert apply(spark, values, text.strip) == [v.strip() for v in values]
    assert apply(spark, values, text.squeeze) == [" ".join(v.split()) for v in values]
    assert apply(spark, values, lambda c: text.redact_phones(text.redact_emails(c))) == [phone.sub("[phone]", email.sub("[email]", v)) for v in values]
    assert apply(spark, values, sentences.split_sentences) == [model_sentences(v) for v in values]
    assert apply(spark, values, text.replace_attachments) == [model_attachments(v) for v in values]
    assert apply(spark, values, text.strip_leading_placeholder) == [re.sub(r"\A\[link\]\s*", "", re.sub(r"\A\[image\]\s*", "", v)) for v in values]
    words = "|".join(map(re.escape, text.longest_first(text.FILLERS)))
    assert apply(spark, values, text.strip_trailing_filler) == [re.sub(rf"\s*(?:{words})\s*$", "", v).strip() or None for v in values]


def model_attachments(t):
    t = re.sub(r"[\w.-]+\.(?:jpe?g|png|gif|mp4|pdf|webp|bmp)\nURL:\s*https?://[^\n]+\nType:\s*[^\n]+\nSize:\s*\d+", "[image]", t).strip()
    return re.sub(r"(\[image\]\s*){2,}", "[images]", t)


N = 100_000
LONG = ["a" * N, "a." * (N // 2), "é" * N, "x" + " " * N + "y", " \n" * (N // 2), "1" * N, "0." * (N // 2), "a@" * (N // 2), "@" + "a" * N, "[image]" * (N // 7), "[image] \n" * (N // 9), "http://" * (N // 7), "http://" + "." * N,
        "a.png\nURL: https://e\nType:" + " " * N + "\nZ", "a.png\nURL: https://e\nType:" + "\n" * N + "Z", ("a.png\nURL: https://e\nType: t\nSize: 1\n" * (N // 40)), "ครับ" * (N // 4), " ครับ" * (N // 5), "ๆ" * N, "+66" * (N // 3), "," * N, "." * N]


RULES = {
    "clean_message": text.clean_message, "squeeze": text.squeeze, "split_sentences": sentences.split_sentences, "find_pii": text.find_pii, "has_url": text.has_url, "is_garbled": text.is_garbled, "is_filler_only": text.is_filler_only,
    "safe": lambda c: text.redact_emails(c, ["help@x.com", "a@a"]), "signature": lambda c: text.drop_signature(c, F.lit("a" * 25)), "boundary": lambda c: text.drop_at_boundary(c, F.lit("aa")), "phrases": lambda c: sentences.filter_phrases(c, ["x" * 50]),
}


@pytest.mark.parametrize("rule", RULES)
def test_long_runs_take_no_longer_than_their_length(spark, rule):
    apply(spark, ["warm up"], RULES[rule])
    start = time.perf_counter()
    apply(spark, LONG, RULES[rule])
    assert time.perf_counter() - start < 0.5 * len(LONG)


def model_sentences(t):
    t = re.sub(r"(?<=\d)\.(?=\d)", "\x00", t)
    t = re.sub(r"(https?://\S*)[.,;:!?)\]](?=[ \n]|\Z)", r"\1", t)
    t = re.sub(r"https?://\S+", lambda m: m[0].replace(".", "\x00"), t)
    return [p.strip().replace("\x00", ".") for p in t.replace("\n", ".").split(".") if p.strip()]


@pytest.mark.parametrize(
    "given, expected",
    [("a. b. c", ["a", "b", "c"]), ("l1\nl2", ["l1", "l2"]), ("", []), ("open 09.00-18.00 (x)", ["open 09.00-18.00 (x)"]), ("v 2.5.1 x. y", ["v 2.5.1 x", "y"]), ("a. b https://f.o/abc. c. d", ["a", "b https://f.o/abc c", "d"]), ("https://a.b/c). z", ["https://a.b/c) z"])],
)
def test_sentences(spark, given, expected):
    assert apply(spark, [given], sentences.split_sentences) == [expected]


def test_redaction(spark):
    assert apply(spark, ["0801234567", "080-123-4567", "02-123-4567", "+66801234567"], text.redact_phones) == ["[phone]"] * 4
    safe = lambda c: text.redact_emails(c, ["help@x.com"])
    assert apply(spark, ["a help@x.com b", "zhelp@x.com", "help@x.com.th", "help@x.com."], safe) == ["a help@x.com b", "[email]", "[email]", "help@x.com."]
    assert apply(spark, ["อีเมลtest@example.com"], text.redact_emails) == ["อี[email]"]
    assert unicodedata.category("ี") == "Mn"


def test_fillers(spark):
    assert apply(spark, ["สวัสดีครับ", "ได้เลยค่ะ", "ครับ", "ครับ ผม"], text.strip_trailing_filler) == ["สวัสดี", "ได้เลย", None, "ครับ ผม"]
    assert apply(spark, ["ครับ", "ฮะ", "ๆ", "โอเค"], text.is_filler_only) == [True, True, True, False]


def test_clean_message(spark):
    block = "look here\nshot.png\nURL: https://e.com/a\nType: image/png\nSize: 12"
    assert apply(spark, [block, "https://e.com/t", "see e.com now", "  "], text.clean_message) == ["look here\n[image]", None, "see e.com now", None]


def test_drop_signature(spark):
    sig = "we are glad to help you all"
    cases = {f"start of it {sig} and then more text here": f"start of it {sig} and then more text here", f"thank you {sig}": "thank you", f"{sig}, bye now": ", bye now", sig: None, "other": "other"}
    assert apply(spark, list(cases), lambda c: text.drop_signature(c, F.lit(sig))) == list(cases.values())


def test_phrase_filter(spark):
    phrase = "If you need more help please write to us at any time of the day"
    run = lambda listed: lambda c: sentences.filter_phrases(c, listed)["text"]
    assert apply(spark, ["s1. s2. s3"], run(["s2"])) == ["s1. s3"]
    assert apply(spark, ["s1. s2"], run(["s1", "s2"])) == [None]
    turn = "Thanks a lot and you need more help please write to us at any time of the day"
    assert apply(spark, [turn, phrase[:40], "unrelated"], run([phrase])) == ["Thanks a lot and you need more help plea ay", "to us", "unrelated"]
    assert apply(spark, ["same"], run([])) == ["same"]


def test_phrase_filter_skips_texts_without_a_piece_alone(spark, monkeypatch):
    import random

    rng = random.Random(5)
    phrases = ["If you need more help please write to us at any time of the day", "a short one", "exactly thirty-five characters, it is", "x" * 90]
    parts = [*phrases, *(p[i : i + k] for p in phrases for i, k in [(0, 35), (3, 35), (20, 35), (9, 17), (1, 40)]), ". ", ".", " ", "\n", "\x01", "\x02", "https://e.com/a.b).", "1.5", "ครับ"]
    values = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(400)] + [None, ""]
    run = lambda c: sentences.filter_phrases(c, phrases)
    found = apply(spark, values, run)
    monkeypatch.setattr(sentences, "may_mention", lambda c, phrases: F.lit(True))
    assert found == apply(spark, values, run) and len({r.dropped for r in found}) > 2


def test_texts_without_a_piece_are_not_searched_for_slices(spark, monkeypatch):
    phrase = "If you need more help please write to us at any time of the day"
    monkeypatch.setattr(sentences, "mentions_any", lambda c, phrases: F.raise_error(F.concat(F.lit("searched "), c)).cast("boolean"))
    run = lambda c: sentences.filter_phrases(c, [phrase])["text"]
    assert apply(spark, ["one. two. three", "If you need. more help", "one"], run) == ["one. two. three", "If you need. more help", "one"]
    with pytest.raises(Exception, match="searched"):
        apply(spark, [f"one. {phrase}"], run)


def test_squeeze_looks_at_every_kind_of_text(spark):
    assert {chr(i) for i in range(0x110000) if chr(i).isspace()} == set(text.BLANKS)
    values = [f"{a}{b}{c}" for a in ("", " ", "x", "é", "😀 ") for b in (*text.BLANKS, "  ", "") for c in ("", " ", "y", " é")]
    assert apply(spark, values, text.squeeze) == [" ".join(v.split()) for v in values]


def test_epoch(spark):
    assert apply(spark, ["2024-01-01T00:00:00Z", "2024-01-01", "no date", None], text.to_epoch) == [1704067200, 1704067200, None, None]
