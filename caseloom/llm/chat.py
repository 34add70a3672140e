"""Chat formatting by a grammar round trip, in DataFrame functions only.

The template renders a turn as

    <|turn|>LROLE\\nBODY<|end|>\\n

with L the escape level of the body (0 or 1) and ROLE always escaped. A turn is
rendered at level 0 first and read back by the parser; where the parser does not
give the source back, or finds a control string inside the body, the turn is
rendered again at the next level and read back again. At level 1 a body holds
neither ``<`` nor ``[``, hence no control string, so the search ends there; a
turn that still differed would fail the query.

The grammar is deterministic: a conversation is split at the turn mark, which
cannot occur inside a turn, and each turn has one parse.

Defined results:

* a null text or role reads as empty, a null turn number sorts first and a null
  conv_id is one conversation of its own;
* turns of equal number follow the order of their rendered strings; repeated rows
  are kept, each as a turn of its own;
* a conversation without assistant turns has an empty loss text; an empty table
  gives no rows;
* other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

TURN, END = "<|turn|>", "<|end|>"
# Strings that common chat formats treat as control marks.
CONTROL = (TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")
#: A turn after the split at the turn mark: level, role, body.
SHAPE = r"(?s)\A([01])([^\n]*)\n(.*)<\|end\|>\n\z"
LOSS_ROLE = "assistant"
#: A length for slice() beyond that of any array, with room for the sum of start and length.
ALL_PARTS = 1 << 30


def _conflicts(text: Column) -> Column:
    found = F.lit(False)
    for mark in CONTROL:
        found = found | text.contains(mark)
    return found


def _lit_replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escaped(text: Column) -> Column:
    return _lit_replace(_lit_replace(_lit_replace(text, "&", "&amp;"), "<", "&lt;"), "[", "&lb;")


def unescaped(text: Column) -> Column:
    return _lit_replace(_lit_replace(_lit_replace(text, "&lt;", "<"), "&lb;", "["), "&amp;", "&")


def _escaped_role(role: Column) -> Column:
    return _lit_replace(escaped(role), "\n", "&nl;")


def _unescaped_role(role: Column) -> Column:
    return unescaped(_lit_replace(role, "&nl;", "\n"))


def _render(level: int, role: Column, text: Column) -> Column:
    return F.concat(F.lit(f"{TURN}{level}"), _escaped_role(role), F.lit("\n"), escaped(text) if level else text, F.lit(f"{END}\n"))


def parsed_turn(rest: Column) -> Column:
    """What follows a turn mark, as (role, text, body, level, ok); ok is false outside the grammar."""
    level, role, body = (F.regexp_extract(rest, SHAPE, i) for i in (1, 2, 3))
    return F.struct(
        _unescaped_role(role).alias("role"),
        F.when(level == "1", unescaped(body)).otherwise(body).alias("text"),
        body.alias("body"),
        level.alias("level"),
        (rest.rlike(SHAPE) & ~_conflicts(body)).alias("ok"),
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation, read back from its text alone."""
    return F.transform(F.slice(F.split(formatted, r"<\|turn\|>"), 2, ALL_PARTS), parsed_turn)


def _same(rendered: Column, role: Column, text: Column) -> Column:
    back = parsed_turn(F.substr(rendered, F.lit(len(TURN) + 1)))
    return back["ok"] & (back["role"] == role) & (back["text"] == text)


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted string, segments array of (text, loss).

    The texts of the segments, joined, are the formatted string; ``loss`` marks
    the bodies of assistant turns as they stand in it.
    """
    src = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    src = src.withColumn("plain", _render(0, F.col("role"), F.col("text")))
    src = src.withColumn("kept", _same(F.col("plain"), F.col("role"), F.col("text")))
    src = src.withColumn("seg", F.when(F.col("kept"), F.col("plain")).otherwise(_render(1, F.col("role"), F.col("text"))))
    sure = F.when(F.col("kept") | _same(F.col("seg"), F.col("role"), F.col("text")), F.col("seg")).otherwise(F.raise_error(F.lit("a turn does not survive the round trip")))
    one = src.select("conv_id", F.struct("turn", sure.alias("seg")).alias("piece"))
    whole = one.groupBy("conv_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    whole = whole.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["seg"]), "").alias("formatted"))
    marked = F.flatten(F.transform(
        F.slice(F.split("formatted", r"<\|turn\|>"), 2, ALL_PARTS),
        lambda rest: F.array(
            F.struct(F.concat(F.lit(TURN), F.regexp_extract(rest, r"(?s)\A([01][^\n]*\n)", 1)).alias("text"), F.lit(False).alias("loss")),
            F.struct(F.regexp_extract(rest, SHAPE, 3).alias("text"), (_unescaped_role(F.regexp_extract(rest, SHAPE, 2)) == LOSS_ROLE).alias("loss")),
            F.struct(F.lit(f"{END}\n").alias("text"), F.lit(False).alias("loss")),
        ),
    ))
    return whole.select("conv_id", "formatted", marked.alias("segments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and loss text, from the formatted conversations alone."""
    f = formatted.withColumn("turns", parsed(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # Every turn has three segments; its escape level is the first digit after the turn mark.
    at = F.sequence(F.lit(0), F.size("segments") - 1)
    body = F.transform(F.when(F.size("segments") > 0, at).otherwise(F.array().cast("array<int>")), lambda i: F.when(
        F.get("segments", i)["loss"],
        F.when(F.substr(F.get("segments", i - 1)["text"], F.lit(len(TURN) + 1), F.lit(1)) == "1", unescaped(F.get("segments", i)["text"])).otherwise(F.get("segments", i)["text"]),
    ).otherwise(F.lit("")))
    f = f.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), F.array_join(body, "").alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return f.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"), F.lit(hard).alias("text"))
    return read_back(formatted_conversations(turns.unionByName(extra)))


_HIT = " OR ".join(f"contains(text, '{m}')" for m in CONTROL)


def _sql_escaped(column: str) -> str:
    return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')"


OP5_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, CASE WHEN {_HIT} THEN '1' ELSE '0' END AS level,
    replace({_sql_escaped('role')}, chr(10), '&nl;') AS erole FROM t
), r AS (
  SELECT *, '{TURN}' || level || erole || chr(10)
    || CASE WHEN level = '1' THEN {_sql_escaped('text')} ELSE text END || '{END}' || chr(10) AS seg FROM s
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, seg)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, seg), '')) AS loss_sha256,
  CAST(sum(length(seg)) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""
