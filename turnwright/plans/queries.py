"""Registered queries of the core operators, each beside its oracle SQL.

``conversations`` stands in for built turns (user: customer, assistant: agent), ``documents`` for a corpus of one-turn
conversations, and orders with their lineitems for tickets with their comments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.functions import sentences, speakers, text
from turnwright.operators import dedup, score, signatures, turns
from turnwright.operators.examples import tokenized
from turnwright.operators.ranking import shuffled_positions, split_by_ratio
from turnwright.plans.prepare import prepare
from turnwright.sources.settings import PrepareSettings
from turnwright.sources.tickets import assemble_tickets, build_turns, not_yet_done, read_records, read_tickets, turns_of_conversations, turns_of_documents, write_records
from turnwright.storage import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# RE2 spellings of the character classes in functions.text.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
SOLID = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+"
PHONE = rf"(\+66[-\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]?|0)\p{{Nd}}{{1,2}}[-\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]?\p{{Nd}}{{3}}[-\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]?\p{{Nd}}{{4}}"
LOCAL = PHONE.replace(r"(\+66[-\s\x0b\x1c-\x1f\x{85}\p{Z}]?|0)", "0")
TURNS = """
t AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'customer' ELSE 'agent' END AS role, coalesce(text, '') AS content
  FROM conversations WHERE role IN ('user', 'assistant')
)"""


def squeezed(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'), ' ')"


def stripped(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return turns_of_conversations(_table(spark, d, "conversations"))


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return turns_of_documents(_table(spark, d, "documents"))


# --- conversations --------------------------------------------------------------------------------------------------

STATS = """
SELECT count(*) AS total_conversations, CAST(sum(n) AS BIGINT) AS total_turns, CAST(sum(c) AS BIGINT) AS customer_turns,
       CAST(sum(n) - sum(c) AS BIGINT) AS agent_turns, round_even(avg(n), 1) AS avg_turns, min(n) AS min_turns, max(n) AS max_turns
FROM (SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE role = 'customer') AS c FROM {src} GROUP BY conv_id)"""


@query(f"WITH {TURNS} {STATS.format(src='t')}")
def conv_stats(spark: SparkSession, d: str) -> DataFrame:
    return turns.conversation_stats(_turns(spark, d))


# Short turns are left out first, so that runs of one role come about.
MERGED = f"""WITH {TURNS}, f AS (SELECT * FROM t WHERE length(content) >= 120),
m AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) OR
             row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 THEN 1 ELSE 0 END AS fresh FROM f),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) - 1 AS run FROM m),
g AS (SELECT conv_id, CAST(run AS INT) AS turn_pos, any_value(role) AS role, string_agg(content, chr(10) ORDER BY turn) AS content,
             string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS comment_ids FROM r GROUP BY conv_id, run)
"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    return turns.merge_runs(_turns(spark, d).where(F.length("content") >= 120))


@query(MERGED + "SELECT conv_id AS ticket_id, turn_pos, role, content, comment_ids FROM g")
def merge_consecutive(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).withColumn("comment_ids", F.array_join("comment_ids", ","))


@query(MERGED + STATS.format(src="g"))
def merged_conversation_stats(spark: SparkSession, d: str) -> DataFrame:
    return turns.conversation_stats(_merged(spark, d))


@query(MERGED + "SELECT conv_id AS ticket_id, turn_pos, role, content FROM g")
def merge_by_array_fold(spark: SparkSession, d: str) -> DataFrame:
    rows = _turns(spark, d).where(F.length("content") >= 120)
    item = F.struct("turn_pos", F.col("role"), F.col("content").alias("text"), F.col("turn_pos").cast("bigint").alias("comment_id"))
    each = rows.groupBy("ticket_id").agg(F.array_sort(F.collect_list(item)).alias("ms"))
    return each.select("ticket_id", F.posexplode(turns.fold_runs(F.col("ms"))).alias("turn_pos", "m")).select("ticket_id", "turn_pos", "m.role", "m.content")


@query(f"""WITH {TURNS}, f AS (SELECT * FROM t WHERE length(content) >= 120)
SELECT conv_id AS ticket_id, CAST(turn AS INT) AS turn_pos, role FROM f WHERE conv_id IN
  (SELECT conv_id FROM f GROUP BY conv_id HAVING count(DISTINCT role) = 2)""")
def valid_conversations(spark: SparkSession, d: str) -> DataFrame:
    return turns.with_both_roles(_turns(spark, d).where(F.length("content") >= 120)).select("ticket_id", "turn_pos", "role")


@query(f"""WITH {TURNS}, f AS (SELECT * FROM t WHERE length(content) >= 120)
SELECT conv_id AS ticket_id, count(*) AS turns FROM f GROUP BY conv_id HAVING count(*) >= 2""")
def unbroken_conversations(spark: SparkSession, d: str) -> DataFrame:
    return turns.without_broken(_turns(spark, d).where(F.length("content") >= 120)).groupBy("ticket_id").agg(F.count("*").alias("turns"))


PLACED = """
k AS (SELECT conv_id, row_number() OVER (ORDER BY md5('42:' || CAST(conv_id AS VARCHAR)), conv_id) - 1 AS conv_pos,
             count(*) OVER () AS n FROM (SELECT DISTINCT conv_id FROM t)),
p AS (SELECT conv_id, conv_pos, CASE WHEN conv_pos < greatest(1, CAST(floor(n * CAST(0.9 AS DOUBLE)) AS BIGINT)) THEN 'train' ELSE 'valid' END AS split FROM k)"""


@query(f"WITH {TURNS}, {PLACED} SELECT conv_id AS ticket_id, conv_pos, split FROM p")
def split_train_valid(spark: SparkSession, d: str) -> DataFrame:
    ids = _turns(spark, d).select("ticket_id").distinct()
    return split_by_ratio(shuffled_positions(ids, "ticket_id", 42, "conv_pos"), 0.9, "conv_pos")


@query(f"""WITH {TURNS}, c AS (
  SELECT conv_id, 0 AS pos, 'system' AS role, 'You help.' AS content FROM (SELECT DISTINCT conv_id FROM t)
  UNION ALL SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn), CASE role WHEN 'customer' THEN 'user' ELSE 'assistant' END, content FROM t)
SELECT conv_id AS ticket_id, CAST(pos AS INT) AS pos, role, content FROM c""")
def chat_format(spark: SparkSession, d: str) -> DataFrame:
    rows = turns.chat_records(_turns(spark, d), "You help.")
    return rows.select("ticket_id", F.posexplode("messages").alias("pos", "m")).select("ticket_id", "pos", "m.role", "m.content")


@query(f"""WITH {TURNS}, l AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back, count(*) OVER (PARTITION BY conv_id) AS n FROM t)
SELECT conv_id AS ticket_id, CAST(n AS INT) AS prompt_messages, CASE role WHEN 'customer' THEN 'user' ELSE 'assistant' END AS reply_role, content AS reply FROM l WHERE back = 1""")
def prompt_reply_split(spark: SparkSession, d: str) -> DataFrame:
    rows = turns.prompt_and_reply(turns.chat_records(_turns(spark, d), "You help."))
    return rows.select("ticket_id", F.size("prompt").alias("prompt_messages"), F.col("reply.role").alias("reply_role"), F.col("reply.content").alias("reply"))


# --- cleaning -------------------------------------------------------------------------------------------------------


def _mapped(spark: SparkSession, d: str, f: Callable) -> DataFrame:
    return _table(spark, d, "documents").select("doc_id", f(F.coalesce("text", F.lit(""))).alias("out"))


@query(f"SELECT page_id, regexp_replace('see ' || url || ' now', 'https?://{SOLID}+', '[link]', 'g') AS out, url LIKE 'http%' AS had_url FROM pages")
def clean_urls(spark: SparkSession, d: str) -> DataFrame:
    body = F.concat(F.lit("see "), F.col("url"), F.lit(" now"))
    return _table(spark, d, "pages").select("page_id", text.replace_urls(body).alias("out"), text.has_url(body).alias("had_url"))


@query(f"SELECT doc_id, regexp_replace(coalesce(text, ''), '{EMAIL}', '[email]', 'g') AS out FROM documents")
def redact_email(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d, text.redact_emails)


@query(f"SELECT doc_id, regexp_replace(coalesce(text, ''), '{PHONE}', '[phone]', 'g') AS out FROM documents")
def redact_phone(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d, text.redact_phones)


# The safe address stands by itself in the literal rows, so the oracle can put a stand-in in its place.
@query(f"""SELECT doc_id, replace(regexp_replace(replace(coalesce(text, '') || ' help@x.com end', ' help@x.com ', chr(1)), '{EMAIL}', '[email]', 'g'), chr(1), ' help@x.com ') AS out
FROM documents""")
def redact_safe_list(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d, lambda c: text.redact_emails(F.concat(c, F.lit(" help@x.com end")), ["help@x.com"]))


@query(f"""SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '{LOCAL}')) + len(regexp_extract_all(coalesce(text, ''), '{EMAIL}')) AS INT) AS leaks,
       regexp_matches(coalesce(text, ''), 'https?://{SOLID}+') AS url FROM documents""")
def pii_and_url_leaks(spark: SparkSession, d: str) -> DataFrame:
    c = F.coalesce("text", F.lit(""))
    return _table(spark, d, "documents").select("doc_id", F.size(text.find_pii(c)).alias("leaks"), text.has_url(c).alias("url"))


ATTACHED = r"'see' || chr(10) || 'shot' || CAST({k} AS VARCHAR) || '.png' || chr(10) || 'URL: https://e.com/' || CAST({k} AS VARCHAR) || chr(10) || 'Type: image/png' || chr(10) || 'Size: 12' || chr(10)"


@query(f"""WITH b AS (SELECT page_id, {ATTACHED.format(k='page_id')} || CASE WHEN page_id % 2 = 0 THEN substr({ATTACHED.format(k='page_id + 1')}, 5) ELSE '' END AS body FROM pages)
SELECT page_id, regexp_replace({stripped(r"regexp_replace(body, '[\p{L}\p{N}_.-]+\.(jpe?g|png|gif|mp4|pdf|webp|bmp)\nURL:\s*https?://[^\n]+\nType:\s*[^\n]+\nSize:\s*\d+', '[image]', 'g')")}, '(\\[image\\]{WS}*){{2,}}', '[images]', 'g') AS out FROM b""")
def attachment_clean(spark: SparkSession, d: str) -> DataFrame:
    def block(k):
        n = k.cast("string")
        return F.concat(F.lit("see\nshot"), n, F.lit(".png\nURL: https://e.com/"), n, F.lit("\nType: image/png\nSize: 12\n"))

    k = F.col("page_id")
    second = F.when(k % 2 == 0, F.substring(block(k + 1), F.lit(5), F.length(block(k + 1)))).otherwise(F.lit(""))
    return _table(spark, d, "pages").select("page_id", text.replace_attachments(F.concat(block(k), second)).alias("out"))


@query(f"SELECT doc_id, regexp_replace(regexp_replace('[image] [link]  ' || coalesce(text, ''), '^\\[image\\]{WS}*', ''), '^\\[link\\]{WS}*', '') AS out FROM documents")
def leading_placeholder(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d, lambda c: text.strip_leading_placeholder(F.concat(F.lit("[image] [link]  "), c)))


FILLER_LIST = ", ".join(f"'{w}'" for w in text.longest_first(text.FILLERS))
FILLER_ALTERNATIVES = "|".join(text.longest_first(text.FILLERS))


@query(f"""WITH w AS (SELECT unnest([{FILLER_LIST}]) AS w), b AS (SELECT region.r_regionkey, w.w, chr(10) || 'ได้' || region.r_name || ' ' || w.w || ' ' AS body FROM region, w)
SELECT CAST(r_regionkey AS INT) AS r_regionkey, w, nullif({stripped(f"regexp_replace(body, '{WS}*({FILLER_ALTERNATIVES}){WS}*$', '')")}, '') AS out FROM b""")
def trailing_filler(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "region").select("r_regionkey", "r_name", F.explode(F.array(*map(F.lit, text.FILLERS))).alias("w"))
    body = F.concat(F.lit("\nได้"), F.col("r_name"), F.lit(" "), F.col("w"), F.lit(" "))
    return rows.select("r_regionkey", "w", text.strip_trailing_filler(body).alias("out"))


def _nested_replace() -> str:
    out = f"lower({stripped('body')})"
    for w in [*text.longest_first(text.FILLERS), text.REPEAT_MARK]:
        out = f"replace({out}, '{w.lower()}', ' ')"
    return out


@query(f"""WITH w AS (SELECT unnest([{FILLER_LIST}]) AS w), b AS (SELECT w, w || 'ๆ ' || w AS body FROM w UNION ALL SELECT w, 'โอเค' || w FROM w)
SELECT w, body, {stripped(_nested_replace())} = '' AS only_filler FROM b""")
def filler_only(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame([(w,) for w in text.FILLERS], "w string")
    rows = words.select("w", F.explode(F.array(F.concat("w", F.lit("ๆ "), "w"), F.concat(F.lit("โอเค"), "w"))).alias("body"))
    return rows.select("w", "body", text.is_filler_only(F.col("body")).alias("only_filler"))


@query(f"""WITH b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), 'https?://{SOLID}+', '[link]', 'g'), '{EMAIL}', '[email]', 'g'), '{PHONE}', '[phone]', 'g') AS body FROM documents)
SELECT doc_id, {stripped('body')} AS out, length({stripped('body')}) >= 10 AS long_enough FROM b""")
def clean_message(spark: SparkSession, d: str) -> DataFrame:
    rows = _mapped(spark, d, lambda c: text.clean_message(c, fillers=False))
    return rows.withColumn("long_enough", F.length("out") >= 10)


BLOCK = r"[\p{L}\p{N}_.-]+\.(jpe?g|png|gif|mp4|pdf|webp|bmp)\nURL:\s*https?://[^\n]+\nType:\s*[^\n]+\nSize:\s*\d+"


def _cleaned() -> str:
    """Every cleaning step over body, in the order of the engine."""
    c = stripped(f"regexp_replace(body, '{BLOCK}', '[image]', 'g')")
    c = f"regexp_replace(regexp_replace({c}, '(\\[image\\]{WS}*){{2,}}', '[images]', 'g'), 'https?://{SOLID}+', '[link]', 'g')"
    c = f"regexp_replace(regexp_replace({c}, '^\\[image\\]{WS}*', ''), '^\\[link\\]{WS}*', '')"
    c = f"regexp_replace(regexp_replace({c}, '{EMAIL}', '[email]', 'g'), '{PHONE}', '[phone]', 'g')"
    return f"nullif({stripped(f"regexp_replace({c}, '{WS}*({FILLER_ALTERNATIVES}){WS}*$', '')")}, '')"


PLANTED = "chr(10) || 'shot.png' || chr(10) || 'URL: https://e.com/a' || chr(10) || 'Type: image/png' || chr(10) || 'Size: 12' || chr(10)"


@query(f"""WITH b AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN {PLANTED} WHEN 2 THEN {PLANTED} || {PLANTED} ELSE '[image] [link] ' END
  || CASE WHEN doc_id % 7 = 0 THEN '' ELSE coalesce(text, '') END || CASE WHEN doc_id % 3 = 0 THEN ' see https://e.com/x นะครับ ' ELSE '' END AS body FROM documents)
SELECT doc_id, {_cleaned()} AS out FROM b""")
def clean_message_whole(spark: SparkSession, d: str) -> DataFrame:
    """All cleaning steps with their defaults, over texts with attachments, placeholders, links and particles."""
    block = F.lit("\nshot.png\nURL: https://e.com/a\nType: image/png\nSize: 12\n")
    k = F.col("doc_id")
    head = F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, block).when(k % 4 == 2, F.concat(block, block)).otherwise(F.lit("[image] [link] "))
    tail = F.when(k % 3 == 0, F.lit(" see https://e.com/x นะครับ ")).otherwise(F.lit(""))
    body = F.concat(head, F.when(k % 7 == 0, F.lit("")).otherwise(F.coalesce("text", F.lit(""))), tail)
    return _table(spark, d, "documents").select("doc_id", text.clean_message(body).alias("out"))


GARBLES = ("a bscription of", "a subscription of", "see https://forms.example", "ftp://forms.x", "ต่าหาก", "ไม่สะดวก", "fine")


@query("WITH g AS (SELECT n_nationkey, n_name || ' ' || [" + ", ".join(f"'{g}'" for g in GARBLES) + r"""][n_nationkey % 7 + 1] AS body FROM nation)
SELECT n_nationkey, regexp_matches(body, '(^|[^\p{L}\p{N}_])bscription|ม่สะดวก|ต่าหาก|https://forms|://forms\.') AS garbled FROM g""")
def garbled_texts(spark: SparkSession, d: str) -> DataFrame:
    body = F.concat("n_name", F.lit(" "), F.element_at(F.array(*map(F.lit, GARBLES)), (F.col("n_nationkey") % 7 + 1).cast("int")))
    return _table(spark, d, "nation").select("n_nationkey", text.is_garbled(body).alias("garbled"))


@query("SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) AS epoch FROM orders")
def dates_to_epoch(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "orders").select("o_orderkey", text.to_epoch(F.col("o_orderdate").cast("string")).alias("epoch"))


# --- sentences ------------------------------------------------------------------------------------------------------

# The documents have no http URLs; dots between digits are given a stand-in by two passes, as RE2 has no lookaround.
def sentences_of(c: str) -> str:
    dots = f"regexp_replace({c}, '(\\p{{Nd}})\\.(\\p{{Nd}})', '\\1' || chr(1) || '\\2', 'g')"
    dots = f"regexp_replace({dots}, '(\\p{{Nd}})\\.(\\p{{Nd}})', '\\1' || chr(1) || '\\2', 'g')"
    return f"list_filter(list_transform(string_split(replace({dots}, chr(10), '.'), '.'), lambda x: replace({stripped('x')}, chr(1), '.')), lambda x: x <> '')"


PARTS = f"s AS (SELECT doc_id, {sentences_of("coalesce(text, '')")} AS parts FROM documents)"


@query(f"""WITH {PARTS} SELECT doc_id, CAST(len(parts) AS INT) AS n_sentences, array_to_string(parts, '|') AS joined FROM s""")
def split_sentences(spark: SparkSession, d: str) -> DataFrame:
    rows = _mapped(spark, d, sentences.split_sentences)
    return rows.select("doc_id", F.size("out").alias("n_sentences"), F.array_join("out", "|").alias("joined"))


@query(f"""WITH {PARTS}, e AS (SELECT doc_id, unnest(parts) AS sentence FROM s)
SELECT sentence, count(*) AS freq, min(doc_id) AS first_doc FROM e WHERE length(sentence) > 15 GROUP BY sentence HAVING count(*) > 1""")
def sentence_freq(spark: SparkSession, d: str) -> DataFrame:
    return dedup.sentence_counts(_docs(spark, d)).select("sentence", "freq", F.col("first_seen.conv_pos").alias("first_doc"))


@query(f"""WITH {PARTS}, e AS (SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS sentence FROM s),
g AS (SELECT sentence, count(*) AS freq, min(struct_pack(d := doc_id, i := i)) AS first FROM e WHERE length(sentence) > 15 GROUP BY sentence HAVING count(*) > 1)
SELECT sentence, freq, 'customer' AS role FROM g ORDER BY freq DESC, first LIMIT 60""")
def top_sentences(spark: SparkSession, d: str) -> DataFrame:
    return dedup.top_sentences(_docs(spark, d), 60).select("sentence", "freq", "role")


PHRASES = ("Licensed under the Apache License, Version 2.0", "And therhean is the is esndha and so on to the end of it")
SLICE_LIST = ", ".join(f"'{s}'" for p in PHRASES for s in sentences.phrase_slices(p))


@query(f"""WITH {PARTS}, f AS (SELECT doc_id, parts, list_filter(parts, lambda x: len(list_filter([{SLICE_LIST}], lambda y: contains(x, y))) = 0) AS kept FROM s WHERE len(parts) > 1)
SELECT doc_id, nullif(array_to_string(kept, '. '), '') AS out, CAST(len(parts) - len(kept) AS INT) AS dropped FROM f""")
def sentence_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d).where(F.size(sentences.split_sentences(F.col("content"))) > 1)
    return dedup.phrases(rows, PHRASES).select(F.col("conv_pos").alias("doc_id"), F.col("content").alias("out"), "dropped")


def _at_boundary(body: str, phrase: str) -> str:
    at, n = f"instr({body}, {phrase})", f"length({phrase})"
    left = f"regexp_replace(substr({body}, 1, {at} - 1), '{WS}+$', '')"
    right = f"regexp_replace(substr({body}, {at} + {n}), '^{WS}+', '')"
    joined = stripped(f"({left} || ' ' || {right})")
    return f"CASE WHEN {at} > 0 AND ({at} - 1 <= 2 OR length({body}) - ({at} + {n}) + 1 <= 2) THEN {joined} ELSE {body} END"


@query(f"""SELECT n_nationkey, n_name, {_at_boundary("n_name || ' please write to us at any time'", "' please write to us at any time'")} AS at_end,
       {_at_boundary("'please write ' || n_name", "'please write'")} AS at_start, {_at_boundary("n_name || ' please write ' || n_name", "'please write'")} AS inside FROM nation""")
def strip_at_boundary(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_name")
    return _table(spark, d, "nation").select(
        "n_nationkey",
        "n_name",
        text.drop_at_boundary(F.concat(n, F.lit(" please write to us at any time")), F.lit(" please write to us at any time")).alias("at_end"),
        text.drop_at_boundary(F.concat(F.lit("please write "), n), F.lit("please write")).alias("at_start"),
        text.drop_at_boundary(F.concat(n, F.lit(" please write "), n), F.lit("please write")).alias("inside"),
    )


def _first_that_changes(body: str, phrase: str) -> str:
    tries = ", ".join(f"'{x}'" for x in [phrase, *sentences.phrase_slices(phrase)])
    return f"list_filter(list_transform([{tries}], lambda q: {_at_boundary(body, 'q')}), lambda x: x <> {body})[1]"


@query(f"""WITH b AS (SELECT n_nationkey, [n_name || ' {PHRASES[0]}', '{PHRASES[1]}, ' || n_name, '{PHRASES[0][:40]}', n_name || ' {PHRASES[1]}!', n_name][n_nationkey % 5 + 1] AS body FROM nation),
o AS (SELECT *, {_first_that_changes("body", PHRASES[0])} AS one FROM b), t AS (SELECT *, coalesce(one, body) AS c FROM o), w AS (SELECT *, {_first_that_changes("c", PHRASES[1])} AS two FROM t)
SELECT n_nationkey, nullif(CASE WHEN one IS NULL AND two IS NULL THEN body ELSE {squeezed("coalesce(two, c)")} END, '') AS out, CAST(one IS NOT NULL OR two IS NOT NULL AS INT) AS dropped FROM w""")
def phrase_fold(spark: SparkSession, d: str) -> DataFrame:
    """Messages of a single sentence: each listed phrase, or the first of its slices that can go, goes from their ends."""
    n = F.col("n_name")
    kinds = F.array(F.concat(n, F.lit(f" {PHRASES[0]}")), F.concat(F.lit(f"{PHRASES[1]}, "), n), F.lit(PHRASES[0][:40]), F.concat(n, F.lit(f" {PHRASES[1]}!")), n)
    body = F.element_at(kinds, (F.col("n_nationkey") % 5 + 1).cast("int"))
    return _table(spark, d, "nation").select("n_nationkey", sentences.filter_phrases(body, PHRASES).alias("f")).select("n_nationkey", F.col("f.text").alias("out"), "f.dropped")


# --- copies and templates -------------------------------------------------------------------------------------------

TEXT_KEY = squeezed("lower(content)")
DOCS = "d AS (SELECT doc_id, coalesce(text, '') AS content FROM documents)"


@query(f"""WITH {DOCS}, r AS (SELECT doc_id, row_number() OVER (PARTITION BY {TEXT_KEY} ORDER BY doc_id) AS rn FROM d)
SELECT doc_id FROM r WHERE rn <= 2""")
def exact_dedup_keep_k(spark: SparkSession, d: str) -> DataFrame:
    return dedup.limit_copies(_docs(spark, d), 2).select(F.col("conv_pos").alias("doc_id"))


@query(f"""WITH {DOCS}, r AS (SELECT row_number() OVER (PARTITION BY {TEXT_KEY} ORDER BY doc_id) AS rn FROM d)
SELECT count(*) AS total, count(*) FILTER (WHERE rn <= 2) AS kept, count(*) FILTER (WHERE rn > 2) AS dropped FROM r""")
def dedup_counters(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d)
    total = rows.agg(F.count("*").alias("total"))
    kept = dedup.limit_copies(rows, 2).agg(F.count("*").alias("kept"))
    return total.select("total", kept.scalar().alias("kept")).withColumn("dropped", F.col("total") - F.col("kept"))


MINED = f"""u AS (SELECT conv_id, turn, regexp_replace({squeezed("content")}, 'https?://{SOLID}+', '[url]', 'g') AS body FROM t),
b AS (SELECT * FROM u WHERE length(body) >= 25),
g25 AS (SELECT substr(body, CAST(i AS INT) + 1, 25) AS sig FROM (SELECT body, unnest(range(0, greatest(1, length(body) - 25), greatest(1, length(body) // 30))) AS i FROM b)),
g15 AS (SELECT substr(body, CAST(i AS INT) + 1, 15) AS sig FROM (SELECT body, unnest(range(0, greatest(1, length(body) - 15), greatest(1, length(body) // 30))) AS i FROM b)),
c25 AS (SELECT sig, count(*) AS freq FROM g25 WHERE length(sig) >= 25 GROUP BY sig),
c15 AS (SELECT sig, count(*) AS freq FROM g15 WHERE length(sig) >= 15 GROUP BY sig)"""
LINES = """t AS (SELECT doc_id AS conv_id, pos AS turn, line AS content FROM
  (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)))"""
SIGS = "z AS (SELECT sig, 25 AS sig_len, freq FROM c25 WHERE freq >= 5 UNION ALL SELECT sig, 15, freq FROM c15 WHERE freq >= 30)"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as turns: they repeat, as messages of support desks do."""
    rows = _table(spark, d, "documents").select(F.lit("all").alias("split"), F.col("doc_id").alias("conv_pos"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("turn_pos", "content"))
    return rows.withColumn("role", F.lit("agent"))


@query(f"WITH {TURNS}, {MINED} SELECT sig, freq, 25 AS size FROM c25 UNION ALL SELECT sig, freq, 15 FROM c15")
def ngram_windows(spark: SparkSession, d: str) -> DataFrame:
    texts = signatures.mining_texts(_turns(spark, d))
    parts = [signatures.window_counts(texts, r.size).withColumn("size", F.lit(r.size)) for r in (signatures.LONG, signatures.SHORT)]
    return parts[0].unionByName(parts[1])


@query(f"WITH {LINES}, {MINED}, {SIGS} SELECT * FROM z")
def canned_signatures(spark: SparkSession, d: str) -> DataFrame:
    return signatures.mine(_lines(spark, d))


# Windows of the squeezed text, found by equality as in the engine: the oracle's check of containment is the same.
MATCHED = f"""n AS (SELECT conv_id, turn, content, {squeezed('content')} AS body FROM t),
w AS (SELECT DISTINCT conv_id, turn, substr(body, CAST(i AS INT), k) AS sig FROM (SELECT conv_id, turn, body, k, unnest(range(1, greatest(1, length(body) - k + 1) + 1)) AS i FROM n, (VALUES (25), (15)) AS q(k))),
h AS (SELECT conv_id, turn, arg_min(z.sig, struct_pack(a := -z.sig_len, b := z.sig)) AS sig FROM w JOIN z ON w.sig = z.sig GROUP BY conv_id, turn)"""


@query(f"WITH {LINES}, {MINED}, {SIGS}, {MATCHED} SELECT conv_id AS doc_id, CAST(turn - 1 AS INT) AS line, sig FROM h")
def signature_match_longest(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d)
    found = signatures.longest_match(rows, signatures.mine(rows, ("split",)), dedup.TURN, ("split",))
    return found.select(F.col("conv_pos").alias("doc_id"), F.col("turn_pos").alias("line"), "sig")


@query(f"""WITH {LINES}, {MINED}, {SIGS}, {MATCHED},
j AS (SELECT n.*, h.sig, instr(n.body, h.sig) AS pos, length(h.sig) AS k, length(n.body) AS len FROM n LEFT JOIN h ON n.conv_id = h.conv_id AND n.turn = h.turn),
x AS (SELECT *, sig IS NOT NULL AND k / greatest(len, 1) >= 0.6 AS dominant,
  CASE WHEN pos - 1 <= 2 OR (len - (pos + k) + 1 < 10 AND (pos = 1 OR substr(body, pos - 1, 1) = ' '))
       THEN nullif(regexp_replace({squeezed("(substr(body, 1, pos - 1) || ' ' || substr(body, pos + k))")}, '[,;:!?。，；：！？]+$', ''), '') ELSE content END AS rest FROM j),
y AS (SELECT *, row_number() OVER (PARTITION BY dominant, sig ORDER BY conv_id, turn) AS rn FROM x),
a AS (SELECT conv_id, turn, content, rest, CASE WHEN sig IS NULL THEN 'none' WHEN dominant AND rn <= 3 THEN 'kept' WHEN dominant THEN 'dropped' WHEN length(rest) >= 10 THEN 'stripped' ELSE 'dropped' END AS action FROM y)
SELECT conv_id AS doc_id, CAST(turn - 1 AS INT) AS line, action, CASE action WHEN 'stripped' THEN rest WHEN 'dropped' THEN NULL ELSE content END AS content FROM a""")
def canned_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.canned(_lines(spark, d), 3).select(F.col("conv_pos").alias("doc_id"), F.col("turn_pos").alias("line"), "action", "content")


# --- tickets --------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_mktsegment IN ('BUILDING', 'MACHINERY') AS is_agent FROM customer")
def agent_lookup(spark: SparkSession, d: str) -> DataFrame:
    role = speakers.classify(F.col("c_mktsegment"), F.col("c_name"), ("BUILDING", "MACHINERY"))
    rows = _table(spark, d, "customer").withColumn("c_name", F.lower("c_mktsegment"))
    return rows.select("c_custkey", (role == "agent").alias("is_agent"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def done_ids_anti(spark: SparkSession, d: str) -> DataFrame:
    done = _table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return not_yet_done(_table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), done)


@query("""SELECT o.o_orderkey AS ticket_id, count(l.l_orderkey) AS comments,
  coalesce(string_agg(CAST(l.l_linenumber AS VARCHAR), ',' ORDER BY strftime(l.l_shipdate, '%Y-%m-%d'), l.l_linenumber), '') AS in_order
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey""")
def comments_nest(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None)
    tickets = _table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), none.cast("string").alias("subject"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("string").alias("created_at"), none.cast("string").alias("updated_at"), F.col("o_custkey").alias("requester_id"), *(none.cast("bigint").alias(c) for c in ("submitter_id", "assignee_id", "group_id")), none.cast("array<string>").alias("tags"))
    comments = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ticket_id"), F.col("l_linenumber").cast("bigint").alias("id"), F.col("l_suppkey").alias("author_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("created_at"), F.lit(True).alias("public"), F.lit("").alias("body"), none.cast("array<struct<file_name:string,content_url:string>>").alias("attachments"))
    made = assemble_tickets(tickets, comments, "web")
    return made.select("ticket_id", F.size("comments").cast("bigint").alias("comments"), F.array_join(F.transform("comments", lambda c: c["id"].cast("string")), ",").alias("in_order"))


@query("""SELECT c_custkey AS ticket_id, 0 AS turn_pos, 'customer' AS role, 'my app does not open ' || c_name AS content FROM customer
UNION ALL SELECT c_custkey, 1, 'agent', 'please reinstall it' || chr(10) || 'and ' || c_mktsegment || ' too' FROM customer
UNION ALL SELECT c_custkey, 2, 'customer', 'it works again now' FROM customer""")
def embedded_speaker_parse(spark: SparkSession, d: str) -> DataFrame:
    """Tickets made of customers: a private note with the name, and stamped messages of customer, agent and stranger."""
    name = F.col("c_name")
    first = F.concat(F.lit("(08:00:00) "), F.upper(name), F.lit(": my app does not open "), name, F.lit("\n(08:01:00) Support Team: please reinstall it\n(08:01:30) Zed uploaded: and "), F.col("c_mktsegment"), F.lit(" too"))
    last = F.concat(F.lit("(08:02:00) "), name, F.lit(": it works again now"))

    def comment(i: int, public: bool, body):
        return F.struct(F.lit(i).cast("bigint").alias("id"), F.lit(-1).cast("bigint").alias("author_id"), F.lit(f"2024-01-0{i}").alias("created_at"), F.lit(public).alias("public"), body.alias("body"), F.lit(None).cast("array<struct<file_name:string,content_url:string>>").alias("attachments"))

    comments = F.array(comment(1, False, F.concat(F.lit("Conversation with "), name)), comment(2, True, first), comment(3, True, last))
    tickets = _table(spark, d, "customer").select(F.col("c_custkey").alias("ticket_id"), F.col("c_custkey").alias("id"), F.struct(F.col("c_custkey").alias("requester_id")).alias("metadata"), comments.alias("comments"))
    built = build_turns(tickets, PrepareSettings(agent_names=("Support Team",), redact_pii=False))
    return built.select("ticket_id", "turn_pos", "role", "content")


def _native(spark: SparkSession, d: str) -> DataFrame:
    """Tickets made of customers: no stamped speakers, a private note, an image alone, and a message without an author.
    Each third ticket has no requester, each fifth nothing public."""
    k = F.col("c_custkey")

    def comment(i: int, public: bool, author, body):
        return F.struct(F.lit(i).cast("bigint").alias("id"), author.cast("bigint").alias("author_id"), F.lit(f"2024-01-0{i}").alias("created_at"), F.lit(public).alias("public"), body.alias("body"), F.lit(None).cast("array<struct<file_name:string,content_url:string>>").alias("attachments"))

    note = comment(3, False, F.lit(0), F.lit("internal note only"))
    comments = F.array(
        comment(1, True, k, F.concat(F.lit("my app does not open "), "c_name")),
        comment(2, True, F.lit(0), F.concat(F.lit("please reinstall "), "c_mktsegment", F.lit(" now"))),
        note,
        comment(4, True, k, F.lit("[image]")),
        comment(5, True, F.lit(None), F.lit("a message without an author")),
    )
    return _table(spark, d, "customer").select(k.alias("ticket_id"), k.alias("id"), F.struct(F.when(k % 3 != 0, k).alias("requester_id")).alias("metadata"), F.when(k % 5 == 0, F.array(note)).otherwise(comments).alias("comments"))


NATIVE = """c AS (SELECT * FROM customer WHERE c_custkey % 5 <> 0), n AS (
  SELECT c_custkey AS ticket_id, 0 AS turn_pos, 'customer' AS role, 'my app does not open ' || c_name AS content FROM c WHERE c_custkey % 3 <> 0
  UNION ALL SELECT c_custkey, 1, 'agent', 'please reinstall ' || c_mktsegment || ' now' || chr(10) || 'a message without an author' FROM c WHERE c_custkey % 3 <> 0
  UNION ALL SELECT c_custkey, 0, 'agent', 'my app does not open ' || c_name || chr(10) || 'please reinstall ' || c_mktsegment || ' now' FROM c WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, 1, 'customer', 'a message without an author' FROM c WHERE c_custkey % 3 = 0)"""


@query(f"WITH {NATIVE} SELECT * FROM n")
def native_roles(spark: SparkSession, d: str) -> DataFrame:
    return build_turns(_native(spark, d), PrepareSettings(redact_pii=False)).select("ticket_id", "turn_pos", "role", "content")


@query(f"WITH {NATIVE} SELECT (SELECT count(*) FROM customer) AS total, count(DISTINCT ticket_id) AS usable, (SELECT count(*) FROM customer) - count(DISTINCT ticket_id) AS skipped FROM n")
def skipped_tickets(spark: SparkSession, d: str) -> DataFrame:
    raw = _native(spark, d)
    usable = build_turns(raw, PrepareSettings()).agg(F.count_distinct("ticket_id").alias("usable"))
    return raw.agg(F.count("*").alias("total")).withColumn("usable", usable.scalar()).withColumn("skipped", F.col("total") - F.col("usable"))


@query("""SELECT c_custkey AS ticket_id, 'ticket_' || c_custkey || '.json' AS file, CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 5 END AS comments, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS requester_id FROM customer""")
def ticket_files(spark: SparkSession, d: str) -> DataFrame:
    """Tickets written as an export lands them and read back."""
    folder = scratch(spark, "query")
    _native(spark, d).write.json(f"{folder}/batch=0")
    return read_tickets(spark, folder).select("ticket_id", "file", F.size("comments").alias("comments"), "metadata.requester_id")


@query(f"""WITH {TURNS}, {PLACED} SELECT p.split, count(DISTINCT t.conv_id) AS records, count(*) + count(DISTINCT t.conv_id) AS messages,
  CAST(sum(length(t.content)) + count(DISTINCT t.conv_id) * length('You help.') AS BIGINT) AS characters FROM t JOIN p ON t.conv_id = p.conv_id GROUP BY p.split""")
def record_files(spark: SparkSession, d: str) -> DataFrame:
    """Records of both splits written as JSON lines, read back and labelled."""
    folder, rows = scratch(spark, "query"), _records(spark, d)
    read = []
    for split in ("train", "valid"):
        write_records(rows.where(F.col("split") == split), f"{folder}/{split}")
        read.append(read_records(spark, f"{folder}/{split}", required=True).withColumn("split", F.lit(split)))
    characters = F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"]))
    return read[0].unionByName(read[1]).groupBy("split").agg(F.count("*").alias("records"), F.sum(F.size("messages")).alias("messages"), F.sum(characters).alias("characters"))


@query()
def training_examples(spark: SparkSession, d: str) -> DataFrame:
    """Token ids and labels of each record, cut to 512 ids."""
    import public_tokenizers

    return tokenized(_records(spark, d), public_tokenizers.path("byte_bpe_50k.json"), 512)


# --- the rubric and the whole ---------------------------------------------------------------------------------------

MEASURED = f"""WITH {TURNS}, {PLACED}, m AS (
  SELECT p.split, t.conv_id, count(*) AS turns, count(*) FILTER (WHERE role = 'customer') AS u, sum(length(content)) AS chars,
         count(*) FILTER (WHERE {stripped('content')} = '') AS empty,
         sum(len(regexp_extract_all(content, '{LOCAL}')) + len(regexp_extract_all(content, '{EMAIL}'))) AS pii,
         count(*) FILTER (WHERE regexp_matches(content, 'https?://{SOLID}+')) AS urls
  FROM t JOIN p ON t.conv_id = p.conv_id GROUP BY p.split, t.conv_id)
SELECT count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'valid') AS valid, count(*) AS talks, CAST(sum(turns) AS BIGINT) AS turns,
       min(turns) AS min_turns, max(turns) AS max_turns, count(*) FILTER (WHERE turns = 1) AS one_turn, CAST(sum(u) AS BIGINT) AS "user",
       CAST(sum(turns) - sum(u) AS BIGINT) AS assistant, CAST(sum(chars) AS BIGINT) AS chars, CAST(sum(empty) AS BIGINT) AS empty,
       CAST(sum(pii) AS BIGINT) AS pii, CAST(sum(urls) AS BIGINT) AS urls, false AS garbled FROM m"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    rows = _turns(spark, d)
    where = split_by_ratio(shuffled_positions(rows.select("ticket_id").distinct(), "ticket_id", 42, "conv_pos"), 0.9, "conv_pos")
    return turns.chat_records(rows, "You help.").join(where, "ticket_id")


@query(MEASURED)
def score_metrics(spark: SparkSession, d: str) -> DataFrame:
    return score.measure(_records(spark, d))


SETTING_LIST = ", ".join(f"'{k}'" for k in score.SETTINGS)


@query(f"""WITH m AS ({MEASURED}), r AS (SELECT *, "user" / (turns) AS share, turns / talks AS average, one_turn / talks AS single, valid / (train + valid) AS held, chars / turns AS len FROM m)
SELECT unnest(['pipeline_integrity', 'content_safety', 'cleaning_dedup', 'dataset_fitness', 'config_engineering']) AS dimension,
 unnest([15.0::DOUBLE, (CASE WHEN pii = 0 THEN 10 WHEN pii <= 3 THEN 7 WHEN pii <= 10 THEN 4 ELSE 0 END + 6 +
   CASE WHEN empty = 0 THEN 4 WHEN empty / talks <= 0.001 THEN 3 WHEN empty / talks <= 0.01 THEN 1 ELSE 0 END)::DOUBLE,
   (4 + CASE WHEN empty = 0 THEN 6 WHEN empty <= 3 THEN 4 ELSE 2 END)::DOUBLE,
   (CASE WHEN share BETWEEN 0.45 AND 0.55 THEN 8 WHEN share BETWEEN 0.35 AND 0.65 THEN 5 ELSE 2 END +
    CASE WHEN average >= 5 AND single <= 0.01 AND min_turns >= 2 THEN 8 WHEN average >= 4 AND single <= 0.05 THEN 5 WHEN average >= 3 THEN 3 ELSE 0 END +
    CASE WHEN held BETWEEN 0.08 AND 0.15 THEN 5 WHEN held BETWEEN 0.05 AND 0.20 THEN 3 ELSE 0 END +
    CASE WHEN len >= 80 THEN 4 WHEN len >= 50 THEN 3 WHEN len >= 30 THEN 2 ELSE 0 END)::DOUBLE,
   round(5 * len(list_intersect([{SETTING_LIST}], ['shuffle_seed', 'unknown'])) / {len(score.SETTINGS)} + 5 + 5, 1)::DOUBLE]) AS points FROM r""")
def score_dimensions(spark: SparkSession, d: str) -> DataFrame:
    found = score.rate(score.measure(_records(spark, d)).first().asDict(), score.Counters(), {"shuffle_seed": 42, "unknown": 1}, logging_on=True)
    return spark.createDataFrame(list(found.dimensions.items()), "dimension string, points double")


def _mined(rule: signatures.MiningRule) -> str:
    starts = f"unnest(range(0, greatest(1, length(body) - {rule.size}), greatest(1, length(body) // 30)))"
    return f"SELECT split, sig FROM (SELECT split, substr(body, CAST(i AS INT) + 1, {rule.size}) AS sig FROM (SELECT split, body, {starts} AS i FROM b)) GROUP BY split, sig HAVING count(*) >= {rule.least}"


def _windows(k: int) -> str:
    return f"SELECT DISTINCT split, conv_pos, turn, substr(body, CAST(i AS INT), {k}) AS sig FROM (SELECT *, unnest(range(1, greatest(1, length(body) - {k} + 1) + 1)) AS i FROM n)"


# Each step over the one before: usable turns, places, exact copies, listed phrases, templates, both roles again.
PREPARED = f"""WITH {LINES.replace("t AS (", "lines AS (")},
t AS (SELECT conv_id, turn - 1 AS turn, CASE WHEN turn % 2 = 1 THEN 'customer' ELSE 'agent' END AS role, content FROM lines WHERE length(content) >= 10),
usable AS (SELECT * FROM t WHERE conv_id IN (SELECT conv_id FROM t GROUP BY conv_id HAVING count(DISTINCT role) = 2)),
{PLACED.replace("FROM t)", "FROM usable)")},
m AS (SELECT split, conv_pos, turn, role, content FROM usable JOIN p ON usable.conv_id = p.conv_id),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split, {TEXT_KEY} ORDER BY conv_pos, turn) AS rn FROM m) WHERE rn <= 3),
s AS (SELECT *, {sentences_of("content")} AS parts FROM e WHERE (split, conv_pos) IN (SELECT (split, conv_pos) FROM e GROUP BY split, conv_pos HAVING count(*) >= 2)),
o AS (SELECT *, list_filter(parts, lambda x: len(list_filter([{SLICE_LIST}], lambda y: contains(x, y))) = 0) AS kept, CASE WHEN len(parts) < 2 THEN {_first_that_changes("content", PHRASES[0])} END AS one FROM s),
c AS (SELECT *, coalesce(one, content) AS folded FROM o),
w2 AS (SELECT *, CASE WHEN len(parts) < 2 THEN {_first_that_changes("folded", PHRASES[1])} END AS two FROM c),
f AS (SELECT split, conv_pos, turn, role, nullif(CASE WHEN len(parts) > 1 THEN array_to_string(kept, '. ') WHEN one IS NULL AND two IS NULL THEN content
      ELSE {squeezed("coalesce(two, folded)")} END, '') AS content FROM w2),
n AS (SELECT *, {squeezed("content")} AS body FROM f WHERE content IS NOT NULL),
b AS (SELECT split, regexp_replace(body, 'https?://{SOLID}+', '[url]', 'g') AS body FROM n WHERE length(regexp_replace(body, 'https?://{SOLID}+', '[url]', 'g')) >= 25),
z AS (SELECT * FROM ({_mined(signatures.LONG)} UNION ALL {_mined(signatures.SHORT)}) WHERE split IN (SELECT split FROM b GROUP BY split HAVING count(*) >= {signatures.LONG.least})),
w AS ({_windows(25)} UNION ALL {_windows(15)}),
h AS (SELECT w.split, conv_pos, turn, arg_min(z.sig, struct_pack(a := -length(z.sig), b := z.sig)) AS sig FROM w JOIN z ON w.split = z.split AND w.sig = z.sig GROUP BY w.split, conv_pos, turn),
j AS (SELECT n.*, h.sig, instr(n.body, h.sig) AS pos, length(h.sig) AS k, length(n.body) AS len FROM n LEFT JOIN h ON n.split = h.split AND n.conv_pos = h.conv_pos AND n.turn = h.turn),
x AS (SELECT *, sig IS NOT NULL AND k / greatest(len, 1) >= 0.6 AS dominant,
  CASE WHEN pos - 1 <= 2 OR (len - (pos + k) + 1 < 10 AND (pos = 1 OR substr(body, pos - 1, 1) = ' '))
       THEN nullif(regexp_replace({squeezed("(substr(body, 1, pos - 1) || ' ' || substr(body, pos + k))")}, '[,;:!?。，；：！？]+$', ''), '') ELSE content END AS rest FROM j),
y AS (SELECT *, row_number() OVER (PARTITION BY split, dominant, sig ORDER BY conv_pos, turn) AS nth FROM x),
a AS (SELECT split, conv_pos, turn, role, CASE WHEN sig IS NULL THEN content WHEN dominant AND nth <= 3 THEN content WHEN dominant THEN NULL WHEN length(rest) >= 10 THEN rest END AS content FROM y),
left_ AS (SELECT * FROM a WHERE content IS NOT NULL),
done AS (SELECT * FROM left_ WHERE (split, conv_pos) IN (SELECT (split, conv_pos) FROM left_ GROUP BY split, conv_pos HAVING count(DISTINCT role) = 2))
SELECT split, conv_pos, CAST(row_number() OVER (PARTITION BY split, conv_pos ORDER BY turn) AS INT) AS pos, CASE role WHEN 'customer' THEN 'user' ELSE 'assistant' END AS role, content FROM done
UNION ALL SELECT DISTINCT split, conv_pos, 0, 'system', 'You help.' FROM done"""


@query(PREPARED)
def prepare_dataset(spark: SparkSession, d: str) -> DataFrame:
    """The whole preparation over lines of documents as turns, customer and agent by turns, with every stage on."""
    lines = _lines(spark, d).withColumn("role", F.when(F.col("turn_pos") % 2 == 0, F.lit("customer")).otherwise(F.lit("agent")))
    rows = lines.select(F.col("conv_pos").alias("ticket_id"), "turn_pos", "role", "content", F.array(F.col("turn_pos").cast("bigint")).alias("comment_ids"))
    done = prepare(rows.where(F.length("content") >= 10), PrepareSettings(filter_sentences=PHRASES))
    return done.records("You help.").select("split", "conv_pos", F.posexplode("messages").alias("pos", "m")).select("split", "conv_pos", "pos", "m.role", "m.content")
