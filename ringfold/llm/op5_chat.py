r"""Chat formatting with typed content parts, in DataFrame functions only.

A message is a list of parts (type, text, ref, size): text, image, audio or
document. The visitor `flatten` turns the parts in order into one body, in which
each part that is not text is an ordered placeholder <|type:k|>, and records
(k, type, ref, tokens) for each of them: an image costs 85 tokens and 170 for each
started 512 x 512 tile, audio 25 for each started second, a document 1 for each
started 4 characters (fixed defaults of TOKENS).

A conversation is its turns in order of (turn, role, text), each written as
<|turn|>role<|body|>body<|end|>. Texts and roles are escaped: every \ is
doubled, then every < and [ gets a \ behind it. So no <|...|>, </s> or [INST]
can come from a text, and `unescape` gives the text back exactly. The loss
mask is the list of spans [start, length] in code points of the assistant bodies.

Edge cases: null text is empty and still a turn; a null role is empty; turns
with equal numbers stand in order of role and text, repeated rows stay as repeated turns; an empty
table gives no conversations; a null conv_id is a conversation of its own.
One conversation is one row, as a training example must be; grouping by conv_id never mixes two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringfold.llm.common import running, table

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Fixed defaults: tokens of a part as (base, per unit, units per step).
TOKENS = {"image": (85, 170, 512 * 512), "audio": (0, 25, 1), "document": (0, 1, 4)}
PART = "struct<type:string,text:string,ref:string,size:bigint>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<"))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def flatten(parts: Column) -> Column:
    """The visitor: array<PART> to struct(body, attachments); a null array or part type is no content."""
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p["type"].isNotNull())
    media = F.filter(parts, lambda p: p["type"] != "text")

    def numbered(p: Column, k: Column) -> Column:
        cost = F.lit(0).cast("long")
        for kind, (base, each, unit) in TOKENS.items():
            cost = F.when(p["type"] == kind, F.lit(base) + F.lit(each) * F.ceil(F.coalesce(p["size"], F.lit(0)) / unit)).otherwise(cost)
        return F.struct(k.alias("position"), p["type"].alias("type"), p["ref"].alias("ref"), cost.cast("long").alias("tokens"))

    # the place of a part among the media is the number of media parts before it
    def shown(x: Column) -> Column:
        p = x["p"]
        return F.when(p["type"] == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), escape(p["type"]), F.lit(":"), x["k"].cast("string"), F.lit("|>")))

    before = running(F.transform(parts, lambda p: (p["type"] != "text").cast("int")))
    body = F.array_join(F.transform(F.arrays_zip(parts.alias("p"), before.alias("k")), shown), "")
    return F.struct(body.alias("body"), F.transform(media, numbered).alias("attachments"))


def text_part(text: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("size")))


def format_chats(messages: DataFrame, parts: Column | None = None) -> DataFrame:
    """conv_id, formatted, loss (array of start, length), attachments from rows conv_id, turn, role and `parts`; without parts, text is the one part."""
    seen = flatten(text_part(F.col("text")) if parts is None else parts)
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), seen.alias("c"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "c"))).alias("t"))
    head = lambda x: F.concat(F.lit(TURN), escape(x["role"]), F.lit(BODY))
    text = F.array_join(F.transform("t", lambda x: F.concat(head(x), x["c"]["body"], F.lit(END))), "")
    sizes = F.transform("t", lambda x: F.length(head(x)) + F.length(x["c"]["body"]) + len(END))
    placed = F.transform(F.arrays_zip(F.col("t").alias("x"), running(sizes).alias("at")), lambda y: F.struct(y["x"]["role"].alias("role"), (y["at"] + F.length(head(y["x"]))).cast("int").alias("start"), F.length(y["x"]["c"]["body"]).alias("length")))
    loss = F.transform(F.filter(placed, lambda s: s["role"] == "assistant"), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    return turns.select("conv_id", text.alias("formatted"), loss.alias("loss"), F.flatten(F.transform("t", lambda x: x["c"]["attachments"])).alias("attachments"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation without media."""
    turns = F.slice(F.split(formatted, r"<\|end\|>", -1), 1, F.size(F.split(formatted, r"<\|end\|>", -1)) - 1)
    part = lambda x: F.split(F.substring(x, len(TURN) + 1, 1 << 30), r"<\|body\|>", -1)
    return F.transform(turns, lambda x: F.struct(unescape(part(x)[0]).alias("role"), unescape(part(x)[1]).alias("text")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    done = format_chats(rows.unionByName(more)).withColumn("turns", read_back(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    done = done.withColumn("learned", learned)
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_E = r"replace(replace(replace({}, '\', '\\'), '<', '<\'), '[', '[\')"
SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (SELECT conv_id, count(*) AS n,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
  sum(length({_E.format("role")}) + length({_E.format("text")}) + {len(TURN + BODY + END)}) AS chars FROM c GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
  sha256(learned) AS loss_sha256, chars::BIGINT AS formatted_chars FROM g"""
