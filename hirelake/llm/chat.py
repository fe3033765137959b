"""Chat formatting from an event log.

A conversation is a log of events: ``message`` opens a message (role, text),
``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` discards
what it said so far. The log is partitioned by conversation and message, each
message's events are sorted by their sequence number and folded into its final
text (the text of its last reset and all deltas behind that), and the messages
are rendered in order. Everything is DataFrame expressions.

Template: ``### role: text</turn>`` and a line break per turn. In roles and
texts ``\\``, ``#``, ``<`` and (roles) ``:`` are written as ``\\b``, ``\\h``,
``\\l`` and ``\\c``, so no text can hold a control string, and undoing it is
exact. The loss mask is kept as run lengths (header, text, footer of each
turn) with a flag on assistant texts.

A message is rendered where its events meet, so only finished strings travel
on to their conversation. A conversation's output is one row, so that row is
the one thing that grows with a conversation.

Defined cases: null text or role: empty; null events count as ``message``; ties
of sequence numbers: by event kind (resets before deltas), then text; a delta
or edit of a message that was never opened keeps its own role; null
conversation: one conversation without id; an empty log gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

HEADER, BETWEEN, FOOTER = "### ", ": ", "</turn>\n"
#: Character, its escaped form. The escape character is first.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
#: Code points of a streamed piece of a text, in logs made from finished turns.
PIECE = 256


def escape(text: Column, escapes: tuple = ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, escapes: tuple = ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def final_messages(events: DataFrame) -> DataFrame:
    """conv, message, role, text: the folded messages of an event log with
    the columns conv, message, seq, event, role, text."""
    kind = F.coalesce("event", F.lit("message"))
    rank = F.when(kind == "delta", 1).otherwise(0)
    log = F.array_sort(F.collect_list(F.struct(
        "seq", rank.alias("delta"), F.coalesce("text", F.lit("")).alias("text"), "role", kind.alias("event"))))
    folded = events.groupBy("conv", "message").agg(log.alias("log"))
    resets = F.transform("log", lambda e, i: F.when(e["delta"] == 0, i))
    return (folded.withColumn("since", F.coalesce(F.array_max(resets), F.lit(0)))
            .select("conv", "message",
                    F.coalesce(F.try_element_at(F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit(-1)),
                               F.lit("")).alias("role"),
                    F.array_join(F.transform(F.filter("log", lambda e, i: i >= F.col("since")),
                                             lambda e: F.when(e["event"] == "regenerate", "").otherwise(e["text"])),
                                 "").alias("text")))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv, formatted, mask (array of run length and whether it counts for
    the loss) of every conversation of conv, message, role, text."""
    role = escape(F.coalesce("role", F.lit("")), ROLE_ESCAPES)
    turns = messages.select("conv", "message", role.alias("shown"), escape(F.coalesce("text", F.lit(""))).alias("body"),
                            F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("loss"))
    turns = turns.select(
        "conv", "message", F.concat(F.lit(HEADER), "shown", F.lit(BETWEEN), "body", F.lit(FOOTER)).alias("turn"),
        (F.length("shown") + len(HEADER + BETWEEN)).alias("head"), F.length("body").alias("size"), "loss")
    whole = turns.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("message", "turn", "head", "size", "loss"))).alias("turns"))
    run = lambda n, on: F.struct(n.alias("length"), on.alias("loss"))
    return whole.select(
        "conv", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.flatten(F.transform("turns", lambda t: F.array(
            run(t["head"], F.lit(False)), run(t["size"], t["loss"]), run(F.lit(len(FOOTER)), F.lit(False))))).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv, formatted, mask and, read from these, turns (role, text) and
    loss_text."""
    pieces = F.split("formatted", FOOTER, -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    bodies = F.transform("pieces", lambda p: F.substr(p, F.instr(p, BETWEEN) + F.lit(len(BETWEEN))))
    # Each turn has three runs in the mask; the second one is its text.
    masked = F.transform("pieces", lambda p, i: F.when(
        F.element_at("mask", i * 3 + 2)["loss"],
        F.substr(p, F.element_at("mask", i * 3 + 1)["length"] + F.lit(1), F.element_at("mask", i * 3 + 2)["length"]))
        .otherwise(""))
    roles = F.transform("pieces", lambda p: F.substring_index(F.substr(p, F.lit(len(HEADER) + 1)), BETWEEN, 1))
    return (formatted.withColumn("pieces", pieces)
            .select("conv", "formatted", "mask",
                    F.zip_with(roles, bodies, lambda r, b: F.struct(
                        unescape(r, ROLE_ESCAPES).alias("role"), unescape(b).alias("text"))).alias("turns"),
                    unescape(F.array_join(masked, "")).alias("loss_text")))


def turn_log(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """The event log that ends in a table of finished turns: a row opens a
    message of its own (rows of one turn: by role and text), which streams its
    text in pieces of ``piece`` code points. An assistant message opens empty,
    streams the last piece first, is regenerated, and streams all pieces; any
    other one opens with its last piece, is edited to the first one, and
    streams the others."""
    copy = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    rows = conversations.select(
        F.col("conv_id").alias("conv"), F.struct("turn", copy.alias("copy")).alias("message"), "role", pieces.alias("pieces"))
    event = lambda kind, text: F.struct(F.lit(kind).alias("event"), text.cast("string").alias("text"))
    deltas = lambda p: F.transform(p, lambda t: event("delta", t))
    first, last = F.try_element_at("pieces", F.lit(1)), F.try_element_at("pieces", F.lit(-1))
    log = F.when(F.col("role") == "assistant", F.concat(
        F.array(event("message", F.lit("")), event("delta", last), event("regenerate", F.lit(None))), deltas(F.col("pieces")),
    )).otherwise(F.concat(
        F.array(event("message", last), event("edit", first)), deltas(F.slice("pieces", F.lit(2), F.greatest(F.size("pieces"), F.lit(1))))))
    return rows.select("conv", "message", "role", F.posexplode(log).alias("seq", "e")).select(
        "conv", "message", "seq", "e.event", F.when(F.col("e.event") == "message", F.col("role")).alias("role"), "e.text")


def _example(spark: SparkSession) -> DataFrame:
    return spark.sql(r"""SELECT conv_id, turn, role, r'\### Assistant: </turn> ok' AS text
                         FROM VALUES (-7, 0, 'user'), (-7, 1, 'assistant') AS t(conv_id, turn, role)""")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(_example(spark))
    out = read_back(render(final_messages(turn_log(rows))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(regexp_replace(role, '[\\#<:]', 'xx', 'g')) + 2 + length(regexp_replace(text, '[\\#<]', 'xx', 'g')) + 8)
         AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
