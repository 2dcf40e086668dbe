"""Secret scans with DataFrame functions only (operator 9).

Base kinds are regular expressions; the method adds spans of high Shannon entropy. Candidate strings are runs of token
characters that hold a digit. For each character class a window slides over the candidate's runs of that class; its
entropy comes from counts that are changed by one character in and one out. A span is a maximal stretch covered by
windows that reach the class's threshold. Left out are candidates that an allow-list pattern with both anchors matches,
windows that another one matches, path parts (between slashes) with a placeholder's name, and spans within a base span.

``split`` and ``regexp_extract_all`` use the same matches, so a match ends where the running sum of the gaps and matches
up to it ends; lengths are in code points.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwright.llm.arrays import bound, scanned

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
CANDIDATE = r"[A-Za-z0-9+/_=-]+"
WINDOW = 20
#: name, characters as a regular expression's class and in full, least entropy in bits of a window
CLASSES = (
    ("entropy_hex", "0-9a-f", string.digits + "abcdef", 3.25),
    ("entropy_base64", "A-Za-z0-9+/_-", string.ascii_letters + string.digits + "+/_-", 3.85),
)
#: Path parts that hold one of these are no secrets.
NAMES = r"(?i)example|sample|placeholder|changeme|dummy|xxxx"
#: A longer path part may hold a name by chance; there only the windows with the name are left out.
NAMED = 64
#: Candidates (with both anchors) or windows that match one of these are no secrets.
ALLOW = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"(.)\1{5}", r"^[0-9+/_=-]+$", r"0123456789|abcdefgh")
SPANS = "array<struct<start:int,end:int,kind:string,rank:int>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, hit, part>> of the leftmost non-overlapping matches; part is the group's text."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.transform(hits, lambda h: F.lit(None).cast("string"))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), parts.alias("part"))

    def placed(found: Column) -> Column:
        ends = scanned(F.transform(found, lambda x: x["gap"] + F.length(x["hit"])))
        whole = F.arrays_zip(ends.alias("end"), found.alias("m"))
        return F.transform(whole, lambda x: F.struct((x["end"] - F.length(x["m"]["hit"])).alias("start"), x["end"].alias("end"), x["m"]["hit"].alias("hit"), x["m"]["part"].alias("part")))

    return bound(F.filter(zipped, lambda x: x["hit"].isNotNull()), placed)


def _as_spans(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank")))


def _none() -> Column:
    return F.expr(f"cast(array() as {SPANS})")


HELD = 48  # a count is kept as the character of this code plus the count


def hot_spans(run: Column, alphabet: str, least: float, window: int = WINDOW, allow: tuple[str, ...] = ()) -> Column:
    """array<struct<start, end>>: the maximal stretches of a run of the class covered by windows whose entropy reaches
    ``least``. Windows that match a pattern of ``allow`` don't count.

    The counts are a string with a character for each member of the class, so that a step changes two characters. The
    entropy of a window is log2(window) less the sum of n * log2(n) over its counts by window, and that sum is kept.
    """
    if window + HELD > 126:
        raise ValueError("a window is too long for its counts")
    terms = F.array(*(F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 1)))
    chars = F.filter(F.split(run, ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c))
    steps = bound(F.arrays_zip(chars.alias("c"), codes.alias("into")), lambda x: F.slice(F.arrays_zip(x.alias("x"), F.concat(F.array_repeat(F.lit(0), window), F.transform(x, lambda y: y["into"])).alias("out")), F.lit(1), F.size(x)))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("text"), F.lit(chr(HELD) * len(alphabet)).alias("n"), F.lit(0.0).alias("s"), F.lit(-1).alias("open"), F.lit(-1).alias("last"), none.alias("done"))

    def changed(state: Column, code: Column, by: int) -> Column:
        """Counts and sum with one more or less of a code."""
        def put(held: Column) -> Column:
            n = F.overlay(state["n"], F.char(held + by + HELD), code, F.lit(1))
            return F.struct(n.alias("n"), (state["s"] - F.element_at(terms, held + 1) + F.element_at(terms, held + 1 + by)).alias("s"))

        return bound(F.ascii(F.substring(state["n"], code, F.lit(1))) - HELD, put)

    def step(acc: Column, move: Column) -> Column:
        here = F.struct(acc["n"].alias("n"), acc["s"].alias("s"))
        less = F.when(move["out"] > 0, changed(here, move["out"], -1)).otherwise(here)
        now = bound(less, lambda state: changed(state, move["x"]["into"], 1))
        text = F.substring(F.concat(acc["text"], move["x"]["c"]), F.lit(-window), F.lit(window))
        end = acc["i"] + 1

        def judged(found: Column) -> Column:
            state, text = found["state"], found["text"]
            hot = (end >= window) & (F.lit(math.log2(window)) - state["s"] / window >= least - 1e-9)
            if allow:
                hot &= ~_any(text, allow)

            def moved(is_hot: Column) -> Column:
                fresh = is_hot & ((acc["open"] < 0) | (end - window > acc["last"]))
                closed = F.when(fresh & (acc["open"] >= 0), F.concat(acc["done"], F.array(F.struct(acc["open"].alias("start"), acc["last"].alias("end"))))).otherwise(acc["done"])
                return F.struct(end.alias("i"), text.alias("text"), state["n"].alias("n"), state["s"].alias("s"), F.when(fresh, end - window).otherwise(acc["open"]).alias("open"), F.when(is_hot, end).otherwise(acc["last"]).alias("last"), closed.alias("done"))

            return bound(hot, moved)

        return bound(F.struct(now.alias("state"), text.alias("text")), judged)

    return F.aggregate(steps, start, step, lambda acc: F.when(acc["open"] >= 0, F.concat(acc["done"], F.array(F.struct(acc["open"].alias("start"), acc["last"].alias("end"))))).otherwise(acc["done"]))


def _any(text: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (text.rlike(p) for p in patterns), F.lit(False))


def without_names(hit: Column, names: str) -> Column:
    """The candidate with blanks for its path parts of at most NAMED characters that hold one of the names."""
    parts = F.transform(F.split(hit, "/", -1), lambda p: F.when((F.length(p) <= NAMED) & p.rlike(names), F.regexp_replace(p, ".", " ")).otherwise(p))
    return F.when(hit.rlike(names), F.array_join(parts, "/")).otherwise(hit)


def entropy_spans(text: Column, window: int, allow: tuple[str, ...], names: str) -> Column:
    """Spans of every class over the candidates of a text."""
    whole = tuple(p for p in allow if p.startswith("^") and p.endswith("$"))
    inner = (*(p for p in allow if p not in whole), names)
    found = F.filter(matches(text, f"{CANDIDATE[:-1]}{{{window},}}"), lambda m: m["hit"].rlike("[0-9]") & ~_any(m["hit"], whole))
    found = F.transform(found, lambda m: F.struct(m["start"].alias("start"), without_names(m["hit"], names).alias("hit")))

    def of_class(candidates: Column, rank: int, kind: str, members: str, alphabet: str, least: float) -> Column:
        def of_run(base: Column, run: Column) -> Column:
            spans = hot_spans(run["hit"], alphabet, least, window, inner)
            return F.transform(spans, lambda s: F.struct((base + run["start"] + s["start"]).alias("start"), (base + run["start"] + s["end"]).alias("end"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank")))

        runs = F.transform(candidates, lambda m: F.flatten(F.transform(matches(m["hit"], f"[{members}]{{{window},}}"), lambda run: of_run(m["start"], run))))
        return F.flatten(runs)

    return bound(found, lambda c: F.concat(*(of_class(c, rank, *kind) for rank, kind in enumerate(CLASSES, 4))))


def scan_secrets(docs: DataFrame, window: int = WINDOW, allow: tuple[str, ...] = ALLOW, names: str = NAMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added) for each row: arrays of struct<start, end, kind, rank> over the whole text, in code points.

    A null text counts as empty and has no spans. Rows are independent, so ids may be null or repeat; other columns
    are ignored. Nothing is shuffled. Each pattern first has a cheap test for whether it can match at all. A text of any
    length and with any number of matches is worked through within its row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select("id", text.alias("text"))
    text = F.col("text")
    assign = F.filter(matches(text, ASSIGN, 1), lambda m: F.length(m["part"]) >= 6)
    access = F.filter(matches(text, ACCESS), lambda m: F.length(m["hit"]) >= 20)
    # a run of hex digits is whole, so asking for 24 in the pattern keeps the same matches
    hexes = matches(text, r"[0-9a-f]{24,}")
    rows = rows.select(
        "id",
        "text",
        F.when((text.contains(":") | text.contains("=")) & text.rlike(ASSIGN), _as_spans(assign, "assign", 1)).otherwise(_none()).alias("assign"),
        F.when(text.contains("AKIA"), _as_spans(access, "access", 2)).otherwise(_none()).alias("access"),
        F.when(text.rlike(r"[0-9a-f]{24}"), _as_spans(hexes, "hex", 3)).otherwise(_none()).alias("hex"),
        F.when(text.rlike(rf"{CANDIDATE[:-1]}{{{window}}}"), entropy_spans(text, window, allow, names)).otherwise(_none()).alias("hot"),
    )
    # in order of their starts, a span lies within a base span if one before it ends no earlier
    rows = rows.select("id", F.array_sort(F.concat("assign", "access", "hex", "hot"), _by_start).alias("all"))
    reach = scanned(F.transform("all", lambda s: F.when(s["rank"] < 4, s["end"]).otherwise(F.lit(0))), F.greatest)
    rows = rows.select("id", F.filter("all", lambda s: s["rank"] < 4).alias("base"), F.arrays_zip(F.col("all").alias("s"), reach.alias("reach")).alias("reached"))
    added = F.transform(F.filter("reached", lambda x: (x["s"]["rank"] >= 4) & (x["reach"] < x["s"]["end"])), lambda x: x["s"])
    return rows.select(F.col("id").alias(id_col), "base", added.alias("added"))


def _by_start(a: Column, b: Column) -> Column:
    return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["rank"] < b["rank"], -1).when(a["rank"] > b["rank"], 1).otherwise(0)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of scan_secrets' spans."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    first = scanned.columns[0]
    return scanned.select(first, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", "added"), _by_start)).alias("spans"))


def _oracle() -> str:
    """The same in SQL: matches are placed by the lengths of the gaps, windows are counted anew one by one."""

    def sql(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def placed(rows: str, text: str, pattern: str, group: int = 0) -> str:
        hits, gaps = f"regexp_extract_all({text}, {sql(pattern)})", f"string_split_regex({text}, {sql(pattern)})"
        return f"""SELECT * EXCLUDE (gap, nth), CAST(sum(gap + length(hit)) OVER (PARTITION BY rid, base_at ORDER BY nth) AS INT) AS stop FROM (
          SELECT rid, base_at, unnest({hits}) AS hit, unnest(regexp_extract_all({text}, {sql(pattern)}, {group})) AS part,
                 unnest(list_transform({gaps}[1:len({hits})], lambda g: length(g))) AS gap, generate_subscripts({hits}, 1) AS nth FROM {rows})"""

    kinds = " UNION ALL ".join(
        f"SELECT rid, base_at + stop - length(hit) AS start, base_at + stop AS stop, '{kind}' AS kind, {rank} AS rank FROM ({placed('d', 't', pattern, group)}) WHERE length({'part' if group else 'hit'}) >= {least}"
        for rank, (kind, pattern, group, least) in enumerate((("assign", ASSIGN, 1, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24)), 1)
    )
    whole = " OR ".join(f"regexp_matches(hit, {sql(p)})" for p in ALLOW if p.startswith("^"))
    inner = " OR ".join([f"regexp_matches(w, {sql(p)})" for p in (*(p for p in ALLOW if not p.startswith("^") and "\\1" not in p), NAMES)])
    runs = " UNION ALL ".join(
        f"SELECT rid, base_at + stop - length(hit) AS base_at, hit, '{kind}' AS kind, {rank} AS rank, {least} AS least FROM ({placed('n', 'hit', f'[{members}]{{{WINDOW},}}')})"
        for rank, (kind, members, _, least) in enumerate(CLASSES, 4)
    )
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, 0 AS base_at, coalesce(text, '') AS t FROM documents),
base AS ({kinds}),
c AS (SELECT rid, stop - length(hit) AS base_at, hit FROM ({placed("d", "t", f"{CANDIDATE[:-1]}{{{WINDOW},}}")}) WHERE regexp_matches(hit, '[0-9]') AND NOT ({whole})),
n AS (SELECT rid, base_at, array_to_string(list_transform(string_split(hit, '/'), lambda p: CASE WHEN length(p) <= {NAMED} AND regexp_matches(p, {sql(NAMES)}) THEN repeat(' ', length(p)) ELSE p END), '/') AS hit FROM c),
r AS ({runs}),
w AS (SELECT rid, base_at, kind, rank, least, CAST(i AS INT) AS i, substr(hit, CAST(i AS INT) + 1, {WINDOW}) AS w FROM (SELECT *, unnest(range(0, length(hit) - {WINDOW} + 1)) AS i FROM r)),
e AS (SELECT *, string_split(w, '') AS cs FROM w),
h AS (SELECT rid, base_at, kind, rank, base_at + i AS start FROM e WHERE log2({WINDOW}) - list_sum(list_transform(cs, lambda c: log2({WINDOW} - length(replace(w, c, ''))))) / {WINDOW} >= least - 1e-9
      AND NOT ({inner}) AND len(list_filter(cs, lambda c: contains(w, repeat(c, 6)))) = 0),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY rid, base_at, rank ORDER BY start ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CAST(start > coalesce(lag(start) OVER (PARTITION BY rid, base_at, rank ORDER BY start) + {WINDOW}, -1) AS INT) AS fresh FROM h)),
s AS (SELECT rid, min(start) AS start, max(start) + {WINDOW} AS stop, kind, rank FROM g GROUP BY rid, base_at, kind, rank, island),
a AS (SELECT *, true AS own FROM base UNION ALL SELECT *, false FROM s WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = s.rid AND b.start <= s.start AND s.stop <= b.stop)),
j AS (SELECT *, kind || ':' || start || ':' || stop AS said FROM a)
SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(said, ',' ORDER BY start, rank) FILTER (WHERE own), '')) AS base_sha256, coalesce(string_agg(said, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN j ON d.rid = j.rid GROUP BY d.rid, doc_id"""


ORACLE = _oracle()
