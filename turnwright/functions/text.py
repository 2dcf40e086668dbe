"""Text rules as Column -> Column expressions, with Unicode meanings of white space, words and digits.

All of them are built-in expressions; a switched-off step is left out when the plan is built. Null stays null.

Texts may be of any length and content, so every rule takes time in proportion to a text: patterns have one class for
each run (a repeated group of alternatives would recurse once a character), begin only where a run begins or the match
before ended, and take runs possessively; ends are trimmed, not searched for. A rule whose pattern needs a certain
substring looks for that first.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes in Java's syntax: its own \s and \w know ASCII only.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
SOLID = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"

#: The members of WS, for trimming.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _run(members: str) -> str:
    """A whole run of a class, from its first character or from the end of the match before."""
    return rf"(?:(?<![{members}])|\G)[{members}]++"


# What a message may hold and what it is replaced with.
FILE_ENDINGS = "jpe?g|png|gif|mp4|pdf|webp|bmp"
# The type's value may be blank, but not empty: either something solid follows on its line, or blanks up to the line's end.
ATTACHMENT = (
    rf"{_run(WORD[1:-1] + '.-')}(?<=[{WORD[1:-1]}.-]\.(?:{FILE_ENDINGS}))\nURL:{WS}*+https?://[^\n]++\n"
    rf"Type:(?:{WS}*+[^\n]++\nSize:|{WS}*+(?<=[{WS[1:-1]}&&[^\n]]\n)Size:){WS}*+{DIGIT}++"
)
URL = rf"https?://{SOLID}++"
EMAIL = rf"{_run(WORD[1:-1] + '.+-')}@[{WORD[1:-1]}.-]+\.{WORD}++"
PHONE = rf"(?:\+66[-{WS[1:-1]}]?|0){DIGIT}{{1,2}}[-{WS[1:-1]}]?{DIGIT}{{3}}[-{WS[1:-1]}]?{DIGIT}{{4}}"
PHONE_LOCAL = rf"0{DIGIT}{{1,2}}[-{WS[1:-1]}]?{DIGIT}{{3}}[-{WS[1:-1]}]?{DIGIT}{{4}}"
GARBLED = (rf"(?<!{WORD})bscription", "ม่สะดวก", "ต่าหาก", "https://forms", r"://forms\.")

# Thai particles that end a message without adding to it.
FILLERS = (
    "ครับ", "ครับผม", "คับ", "คะ", "ค่ะ", "ค้า",
    "นะครับ", "นะคะ", "นะฮะ", "นะ", "นะจ๊ะ",
    "ฮะ", "ฮ่ะ", "จ้า", "จร้า", "เด้อ", "เลย",
    "อ่ะ", "อะ", "น่ะ", "คะน้า", "ค่า", "คร้าบ",
)
REPEAT_MARK = "ๆ"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def _holding(c: Column, needle: str, change: Column) -> Column:
    """The change where the text holds what its pattern needs."""
    return F.when(F.contains(c, F.lit(needle)), change).otherwise(c)


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, none at the ends. Most ASCII texts are so already, which takes a fifth of
    the time to see."""

    def squeezed(x: Column) -> Column:
        blanks = [b for b in BLANKS if b.isascii() and b != " "] + ["  "]
        other = reduce(lambda p, q: p | q, [F.contains(x, F.lit(b)) for b in blanks])
        done = (F.octet_length(x) == F.length(x)) & ~F.startswith(x, F.lit(" ")) & ~F.endswith(x, F.lit(" ")) & ~other
        return F.when(done, x).otherwise(F.trim(F.regexp_replace(x, f"{WS}++", " ")))

    return bound(c, squeezed)


def same_text_key(c: Column) -> Column:
    """Messages with equal keys count as copies."""
    return squeeze(F.lower(c))


def longest_first(words: Iterable[str]) -> list[str]:
    return sorted(words, key=lambda w: -len(w))


def bound(c: Column, use) -> Column:  # noqa: ANN001
    """use(c) with c worked out once, however often use refers to it within a lambda."""
    return F.element_at(F.transform(F.array(c), lambda x: use(x)), 1)


def _collapse_images(c: Column) -> Column:
    """Two or more [image] with at most white space between become [images], and white space after them goes."""

    def collapsed(parts: Column) -> Column:
        def one(i: Column) -> Column:
            text, before = F.element_at(parts, i + 1), F.element_at(parts, i)
            joined = (i > 1) & (strip(before) == "")  # to the image before
            more = (i < F.size(parts) - 1) & (strip(text) == "")
            return F.when(more, F.when(joined, F.lit("")).otherwise(F.lit("[images]"))).when(joined, F.ltrim(text, F.lit(BLANKS))).otherwise(F.concat(F.lit("[image]"), text))

        return F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), one), ""))

    return F.when(c.rlike(rf"\[image\]{WS}*+\[image\]"), bound(F.split(c, r"\[image\]", -1), collapsed)).otherwise(c)


def replace_attachments(c: Column) -> Column:
    """Each attachment block becomes [image]; two or more in a row become [images]."""
    return _collapse_images(strip(_holding(c, "\nURL:", F.regexp_replace(c, ATTACHMENT, "[image]"))))


def replace_urls(c: Column) -> Column:
    return _holding(c, "://", F.regexp_replace(c, URL, "[link]"))


def strip_leading_placeholder(c: Column) -> Column:
    for mark in ("[image]", "[link]"):
        c = F.when(F.startswith(c, F.lit(mark)), F.ltrim(F.substring(c, F.lit(len(mark) + 1), F.length(c)), F.lit(BLANKS))).otherwise(c)
    return c


def redact_emails(c: Column, safe: Iterable[str] = ()) -> Column:
    """E-mail addresses become [email], but not those that equal a safe one.

    The safe test is made at the start of an address and asks that no longer address starts there; an address like
    ``safe@x.com-a.b`` is kept in its first part, where a match by match replacement would redact it whole.
    """
    safe = [re.escape(s) for s in safe]
    guard = rf"(?!(?<![{WORD[1:-1]}.+-])(?:{'|'.join(safe)})(?!{WORD}|[.-]*\.{WORD}))" if safe else ""
    return _holding(c, "@", F.regexp_replace(c, guard + EMAIL, "[email]"))


def redact_phones(c: Column) -> Column:
    return F.regexp_replace(c, PHONE, "[phone]")


def strip_trailing_filler(c: Column, fillers: Iterable[str] = FILLERS) -> Column:
    """One trailing particle goes, the longest that fits; null if nothing is left."""
    words = longest_first(fillers)
    rest = F.rtrim(c, F.lit(BLANKS))
    fits = [(F.endswith(rest, F.lit(w)), F.left(rest, F.length(rest) - len(w))) for w in words]
    out = F.when(*fits[0]) if fits else F.when(F.lit(False), rest)
    for holds, left in fits[1:]:
        out = out.when(holds, left)
    return F.nullif(strip(out.otherwise(rest)), F.lit(""))


def is_filler_only(c: Column, fillers: Iterable[str] = FILLERS) -> Column:
    """Is nothing left when every particle and the repetition mark are blanked, longest first?"""
    rest = F.lower(strip(c))
    for word in [*longest_first(fillers), REPEAT_MARK]:
        rest = F.replace(rest, F.lit(word.lower()), F.lit(" "))
    return strip(rest) == ""


def clean_message(c: Column, attachments: bool = True, urls: bool = True, pii: bool = True, fillers: bool = True, safe: Iterable[str] = ()) -> Column:
    """All cleaning steps in their fixed order; null or empty if the message is to be dropped."""
    steps = [replace_attachments] * attachments + [replace_urls] * urls + [strip_leading_placeholder]
    if pii:
        safe = list(safe)
        steps += [lambda x: redact_emails(x, safe), redact_phones]
    steps += [strip_trailing_filler] * fillers + [strip]
    for step in steps:  # each step refers to its input several times
        c = bound(c, step)
    return c


def find_pii(c: Column, safe: Iterable[str] = ()) -> Column:
    """array<string> of what an audit takes for phone numbers and e-mail addresses."""
    mails = F.when(F.contains(c, F.lit("@")), F.regexp_extract_all(c, F.lit(EMAIL), F.lit(0))).otherwise(F.expr("cast(array() as array<string>)"))
    safe = list(safe)
    if safe:
        mails = F.filter(mails, lambda m: ~m.isin(safe))
    return F.concat(F.regexp_extract_all(c, F.lit(PHONE_LOCAL), F.lit(0)), mails)


def has_url(c: Column) -> Column:
    return F.contains(c, F.lit("://")) & c.rlike(URL)


def is_garbled(c: Column) -> Column:
    return c.rlike("|".join(GARBLED))


def drop_at_boundary(body: Column, phrase: Column, slack: int = 2) -> Column:
    """body without the first occurrence of phrase, if that lies within ``slack`` characters of either end."""
    at = F.instr(body, phrase)
    after = at + F.length(phrase)
    edge = (at - 1 <= slack) | (F.length(body) - after + 1 <= slack)
    left = F.rtrim(F.substring(body, F.lit(1), at - 1), F.lit(BLANKS))
    right = F.ltrim(F.substring(body, after, F.length(body)), F.lit(BLANKS))
    return F.when((at > 0) & edge, strip(F.concat(left, F.lit(" "), right))).otherwise(body)


def drop_signature(body: Column, signature: Column) -> Column:
    """body without a template phrase at its start, or at its end after a space; null if nothing is left."""

    def dropped(text: Column, at: Column) -> Column:
        after = at + F.length(signature)
        rest = F.length(text) - after + 1
        edge = (at - 1 <= 2) | ((rest < 10) & ((at == 1) | (F.substring(text, at - 1, F.lit(1)) == " ")))
        cut = squeeze(F.concat(F.substring(text, F.lit(1), at - 1), F.lit(" "), F.substring(text, after, F.length(text))))
        return F.when((at > 0) & edge, F.nullif(F.rtrim(cut, F.lit(",;:!?。，；：！？")), F.lit(""))).otherwise(body)

    # the text is squeezed and searched once
    return bound(squeeze(body), lambda text: bound(F.instr(text, signature), lambda at: dropped(text, at)))


def to_epoch(c: Column) -> Column:
    """Seconds since 1970 of an ISO date or time; without a zone it is the session's, and null if it isn't one."""
    return F.unix_timestamp(F.try_to_timestamp(c))
