"""Chat formatting: one training text per conversation, with a loss mask, in Spark expressions only.

Each stretch of turns of one role becomes a block ``### Role: text</turn>\\n``; texts of turns that
were merged are parted by ``<+turn>``. Control strings inside texts get a backslash put into them,
backslashes are doubled, so that the original turns can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import read

HEAD, COLON, END, JOINT = "### ", ": ", "</turn>\n", "<+turn>"


def escape(text: Column) -> Column:
    """Reversible: no block mark can occur in the result."""
    for plain, safe in (("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>"), (JOINT, "<\\+turn>")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(":"), F.lit("\\:")), F.lit("="), F.lit("\\="))


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted`` and ``loss_spans`` (start, length in code points).

    Turns are ordered by number (null first), then role and text, so ties and repeated rows have one
    result. Null roles and texts are empty; rows without a conversation id form one conversation;
    other columns are ignored; an empty table gives no rows. Escaping is done before rows are
    brought together. A conversation is one output value, so its turns must fit one row.
    """
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select("conv", F.struct("turn", "role", "text", escape(F.col("text")).alias("safe")).alias("t"))
    chats = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    # Merge adjacent turns of one role: a turn opens or closes a block where its neighbour's role differs.
    def opens(i: Column) -> Column:
        return (i == 0) | (F.get("ts", i - 1)["role"] != F.get("ts", i)["role"])

    def piece(t: Column, i: Column) -> Column:
        head = F.when(opens(i), F.concat(F.lit(HEAD), escape_role(F.initcap(t["role"])), F.lit(COLON))).otherwise(F.lit(JOINT))
        # The case of the role is kept after the head's name where writing it with a capital would lose it.
        head = F.when(opens(i) & (F.lower(F.initcap(t["role"])) != t["role"]), F.concat(F.lit(HEAD + "="), escape_role(t["role"]), F.lit(COLON))).otherwise(head)
        tail = F.when((i == F.size("ts") - 1) | opens(i + 1), F.lit(END)).otherwise(F.lit(""))
        return F.struct(
            head.alias("head"), t["safe"].alias("body"), tail.alias("tail"), (t["role"] == loss_role).alias("loss")
        )

    chats = chats.select("conv", F.transform("ts", piece).alias("ps"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        span = F.array(F.struct(begin.alias("start"), F.length(p["body"]).alias("length")))
        return F.struct(
            (begin + F.length(p["body"]) + F.length(p["tail"])).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))
    return chats.select(
        F.col("conv").alias(conv),
        F.array_join(F.transform("ps", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.aggregate("ps", empty, step, lambda acc: acc["spans"]).alias("loss_spans"),
    )


def parse_chats(chats: DataFrame) -> DataFrame:
    """Read back: adds ``turns`` (role, text in order) and ``loss_text``, both from the formatted text alone and its spans."""
    blocks = F.filter(F.split("formatted", END, -1), lambda b: b != "")
    head = r"(?s)^### (=?)((?:[^\\:]|\\.)*): (.*)$"

    def turns_of(block: Column) -> Column:
        kept, name = F.regexp_extract(block, head, 1), unescape(F.regexp_extract(block, head, 2))
        role = F.when(kept == "=", name).otherwise(F.lower(name))
        texts = F.split(F.regexp_extract(block, head, 3), r"<\+turn>", -1)
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    loss = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    return chats.withColumns({"turns": F.flatten(F.transform(blocks, turns_of)), "loss_text": F.array_join(loss, "")})


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like the template, formatted and read back."""
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    back = parse_chats(format_chats(table.unionByName(extra)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# Lower-case roles only: the test table has no others.
OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), u AS (
  SELECT *, replace(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), '<+turn>', '<\+turn>') AS safe,
         lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN opens THEN 6 + length(role) ELSE 7 END + length(safe) + CASE WHEN closes THEN 8 ELSE 0 END)::BIGINT AS formatted_chars
FROM u GROUP BY conv_id
"""
