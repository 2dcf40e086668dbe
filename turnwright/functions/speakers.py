"""Reading speakers and their messages out of support-ticket comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnwright.functions.text import DIGIT, WS, bound, strip

# Fixed values: "(HH:MM:SS) Name: " or "(HH:MM:SS) Name uploaded: " opens a message, and a private note names the customer.
STAMP = rf"\({DIGIT}{{2}}:{DIGIT}{{2}}:{DIGIT}{{2}}\)"
OPENING = rf"(?d)\A({STAMP}){WS}+(.+?)(?:{WS}uploaded)?:{WS}+"
CUSTOMER_NOTE = rf"(?d)(?i)\AConversation{WS}+with{WS}+(.+)"
BOT_AUTHOR = -1
CUSTOMER, AGENT = "customer", "agent"


def is_public(comment: Column) -> Column:
    return F.coalesce(comment["public"], F.lit(True))


def body_of(comment: Column) -> Column:
    return strip(F.coalesce(comment["body"], F.lit("")))


def customer_name(comments: Column) -> Column:
    """The name in the first private note that has one, or null."""
    names = F.transform(F.filter(comments, lambda c: ~is_public(c)), lambda c: F.when(body_of(c).rlike(CUSTOMER_NOTE), strip(F.regexp_extract(body_of(c), CUSTOMER_NOTE, 1))))
    return F.get(F.filter(names, lambda n: n.isNotNull()), F.lit(0))


def has_openings(comments: Column) -> Column:
    """Does a public comment of the bot author open with a stamped speaker?"""
    return F.coalesce(F.exists(comments, lambda c: is_public(c) & (c["author_id"] == BOT_AUTHOR) & body_of(c).rlike(OPENING)), F.lit(False))


def classify(speaker: Column, customer: Column, agents: Sequence[str]) -> Column:
    """Listed agents first (as written), then the customer (in any case), else an agent."""
    known = speaker.isin(list(agents)) if agents else F.lit(False)
    return F.when(known, F.lit(AGENT)).when(F.lower(speaker) == F.lower(customer), F.lit(CUSTOMER)).otherwise(F.lit(AGENT))


def stamped_messages(body: Column, customer: Column, agents: Sequence[str]) -> Column:
    """array<struct<role, text>> of a body that holds several stamped messages; parts without a speaker or text go."""
    parts = F.transform(F.split(strip(body), rf"(?={STAMP}{WS}+)"), strip)
    opened = F.filter(parts, lambda s: s.rlike(OPENING))
    read = F.transform(opened, lambda s: F.struct(classify(strip(F.regexp_extract(s, OPENING, 2)), customer, agents).alias("role"), strip(F.regexp_replace(s, OPENING, "")).alias("text")))
    return F.filter(read, lambda m: m["text"] != "")


def own_message(comment: Column, requester: Column) -> Column:
    """array of one struct<role, text>: the requester is the customer; two missing ids count as the same person."""
    role = F.when(comment["author_id"].eqNullSafe(requester), F.lit(CUSTOMER)).otherwise(F.lit(AGENT))
    return F.array(F.struct(role.alias("role"), body_of(comment).alias("text")))


def ticket_messages(comments: Column, requester: Column, agents: Sequence[str]) -> Column:
    """array<struct<comment_id, role, text>> of the public, non-empty comments of a ticket, in their order.

    Bodies are split by stamped speakers if the ticket has openings and a note names the customer.
    """

    def message(c: Column, name: Column, split: Column) -> Column:
        said = F.when(split, stamped_messages(body_of(c), name, agents)).otherwise(own_message(c, requester))
        return F.transform(said, lambda m: F.struct(c["id"].alias("comment_id"), m["role"].alias("role"), m["text"].alias("text")))

    open_ = F.filter(comments, lambda c: is_public(c) & (body_of(c) != ""))
    # the name and whether to split are worked out once a ticket, not once a message
    how = F.struct(customer_name(comments).alias("name"), has_openings(comments).alias("openings"))
    return bound(how, lambda h: F.flatten(F.transform(open_, lambda c: message(c, h["name"], h["openings"] & h["name"].isNotNull()))))
