r"""Chat formatting with Spark expressions only.

A conversation's turns are sorted, adjacent turns of one role share one header, and the whole becomes one string:

    <|turn|>ROLE<|body|>TEXT<|part|>TEXT<|end|>\n <|turn|>...

Inside roles and texts a backslash is doubled and "<|" becomes "<\|", so no control string can stand in a text, and both
steps can be undone: an escaped backslash run before "|" after "<" is even, the mark's own is a single one. The loss mask
is a list of (start, length) in code points of the formatted string, one for each assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import let, table

TURN, BODY, PART, END = "<|turn|>", "<|body|>", "<|part|>", "<|end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _indices(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _blocks(turns: Column) -> Column:
    """array<struct<role, texts>>: runs of one role."""
    starts = F.filter(_indices(F.size(turns)), lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))

    def cut(s: Column) -> Column:
        stop = lambda j: F.coalesce(F.get(s, j + 1), F.size(turns))
        return F.transform(s, lambda i, j: F.struct(F.get(turns, i)["role"].alias("role"), F.transform(F.slice(turns, i + 1, stop(j) - i), lambda t: t["text"]).alias("texts")))

    return let(starts, cut)


def _format(blocks: Column) -> Column:
    one = lambda b: F.concat(F.lit(TURN), escape(b["role"]), F.lit(BODY), F.array_join(F.transform(b["texts"], escape), PART), F.lit(END))
    return F.array_join(F.transform(blocks, one), "")


def _mask(blocks: Column) -> Column:
    """array<struct<start, n>> of the assistant's texts; a running place goes over headers, texts and ends."""
    span = "struct<start:bigint,n:bigint>"
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    n = lambda c: F.char_length(escape(c)).cast("bigint")

    def block(a: Column, b: Column) -> Column:
        first = F.struct((a["at"] + len(TURN) + n(b["role"]) + len(BODY)).alias("at"), a["spans"].alias("spans"))
        text = lambda x, t: F.struct((x["at"] + n(t) + len(PART)).alias("at"), F.when(b["role"] == "assistant", F.concat(x["spans"], F.array(F.struct(x["at"].alias("start"), n(t).alias("n"))))).otherwise(x["spans"]).alias("spans"))
        return F.aggregate(b["texts"], first, text, lambda x: F.struct((x["at"] - len(PART) + len(END)).alias("at"), x["spans"].alias("spans")))

    return F.aggregate(blocks, state, block, lambda a: a["spans"])


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans for each conversation of turns(conv_id, turn, role, text); other columns are not read.

    Turns are ordered by (turn, role, text), nulls first; repeated rows are kept. A null text or role is the empty string; a
    null conv_id is a conversation of its own. No rows: no conversations. A conversation is one output string, so all its turns meet in
    one row; rows of different conversations do not.
    """
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    blocks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).withColumn("blocks", _blocks(F.col("turns")))
    return blocks.select("conv_id", _format(F.col("blocks")).alias("formatted"), _mask(F.col("blocks")).alias("loss_spans"))


def read_chats(chats: DataFrame) -> DataFrame:
    """Back from formatted strings: conv_id, turns (array of role, text), loss (array of texts under the mask), formatted."""
    lit = lambda s: "\\Q" + s + "\\E"

    def turns_of(block: Column) -> Column:
        return let(F.split(block, lit(BODY), 2), lambda p: F.transform(F.split(F.get(p, F.lit(1)), lit(PART), -1), lambda t: F.struct(unescape(F.substr(F.get(p, F.lit(0)), F.lit(len(TURN) + 1))).alias("role"), unescape(t).alias("text"))))

    blocks = F.split(F.col("formatted"), lit(END), -1)
    turns = F.flatten(let(blocks, lambda b: F.transform(F.slice(b, 1, F.greatest(F.size(b) - 1, F.lit(0))), turns_of)))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["n"].cast("int"))))
    return chats.select("conv_id", turns.alias("turns"), loss.alias("loss"), "formatted")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(more)
    back = read_chats(format_chats(rows)).withColumn("all_loss", F.array_join("loss", ""))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), digest.alias("turns_sha256"), F.char_length("all_loss").cast("long").alias("loss_chars"), F.sha2("all_loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) AS er, length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS et,
  CASE WHEN row_number() OVER w = 1 OR lag(role) OVER w <> role THEN 1 ELSE 0 END AS fresh
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN fresh = 1 THEN 24 + er ELSE 8 END + et) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

QUERIES = {"op4_chat_format": op4_chat_format}
ORACLES = {"op4_chat_format": ORACLE}
