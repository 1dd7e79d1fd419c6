"""Chat formatting: typed content parts are flattened by a visitor into one marked, reversible text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

PART = "struct<kind:string,text:string,ref:string,tokens:int>"
#: Tokens that an attachment stands for where its part names no number.
EXPANDS = {"image": 256, "audio": 128, "document": 512}
_OPEN, _CLOSE = "<turn ", "</turn>\n"


def escape(text: Column) -> Column:
    """No < or > is left, and every backslash starts a pair, so no control string can occur."""
    text = F.coalesce(text, F.lit(""))
    for plain, pair in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(pair))
    return text


def unescape(text: Column) -> Column:
    for plain, pair in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(pair), F.lit(plain))
    return text


def visit(part: Column, at: Column) -> Column:
    """A part as (text, words): its escaped text, or a placeholder with its place in the turn. Unknown kinds are text."""
    known = part["kind"].isin(*EXPANDS)
    holder = F.concat(F.lit("<"), part["kind"], F.lit(" "), at.cast("string"), F.lit(">"))
    return F.struct(F.when(known, holder).otherwise(escape(part["text"])).alias("text"), (~F.coalesce(known, F.lit(False))).alias("words"))


def format_conversations(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """conv_id, n_turns, formatted, turn_texts, loss, attachments and expanded_tokens of each conversation.

    turns has conv_id, turn, role and parts (an array of PART). Turns go by turn, nulls first, then
    role and text, so that repeated turns stay, in a fixed order. `formatted` is the concatenation of
    turn_texts, each `<turn ROLE>`, a line end, the parts and `</turn>`, a line end. loss lists the
    text parts of `learn` turns as (turn, start, end), code points of that turn's text; attachments
    lists (turn, at, kind, ref, tokens). Null roles, texts and parts count as empty; a null conv_id is
    a conversation of its own. A conversation is one text, so its turns must fit one row.
    """
    parts = F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(_OPEN), escape(role), F.lit(">\n"))
    one = turns.select("conv_id", "turn", role.alias("role"), parts.alias("parts"), head.alias("head"), F.transform(parts, visit).alias("pieces"))
    body = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    lengths = F.transform("pieces", lambda p: F.length(p["text"]))
    start = lambda i: F.length("head") + F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0), lambda a, x: a + x)
    spans = F.transform("pieces", lambda p, i: F.struct((start(i)).alias("start"), (start(i) + F.length(p["text"])).alias("end"), p["words"].alias("words")))
    held = F.transform("parts", lambda p, i: F.struct(i.alias("at"), p["kind"].alias("kind"), p["ref"].alias("ref"), F.coalesce(p["tokens"], *[F.when(p["kind"] == k, n) for k, n in EXPANDS.items()]).alias("tokens")))
    one = one.select(
        "conv_id", "turn", "role", F.concat("head", body, F.lit(_CLOSE)).alias("text"),
        F.when(F.col("role") == learn, F.filter(spans, lambda s: s["words"])).otherwise(F.array()).alias("spans"),
        F.filter(held, lambda a: a["kind"].isin(*EXPANDS)).alias("held"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = one.withColumn("place", F.row_number().over(order) - 1).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "text", "spans", "held"))).alias("rows"))
    flat = lambda name, make: F.flatten(F.transform("rows", lambda r: F.transform(r[name], lambda x: make(r["place"], x))))
    loss = flat("spans", lambda turn, s: F.struct(turn.alias("turn"), s["start"].alias("start"), s["end"].alias("end")))
    attachments = flat("held", lambda turn, a: F.struct(turn.alias("turn"), a["at"].alias("at"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))
    texts = F.transform("rows", lambda r: r["text"])
    out = rows.select("conv_id", F.size("rows").cast("long").alias("n_turns"), F.array_join(texts, "").alias("formatted"), texts.alias("turn_texts"), loss.alias("loss"), attachments.alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """(role, text) of each turn, read back from the formatted text alone."""
    pieces = F.split(formatted, F.lit(_CLOSE))
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda x: F.struct(unescape(F.substring(F.substring_index(x, ">\n", 1), len(_OPEN) + 1, 1 << 30)).alias("role"), unescape(F.substring(x, F.length(F.substring_index(x, ">\n", 1)) + 3, F.lit(1 << 30))).alias("text")),
    )


def read_loss(turn_texts: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(turn_texts[s["turn"]], s["start"] + 1, s["end"] - s["start"]))), "")


def op6(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    parts = F.array(F.struct(F.lit("text").alias("kind"), "text", F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))
    made = format_conversations(turns.unionByName(own).withColumn("parts", parts))
    back = made.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("turn_texts"), F.col("loss")).alias("learnt"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP6_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(text) + 16 + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
