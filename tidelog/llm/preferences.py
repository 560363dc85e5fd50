"""Chat formatting of preference pairs.

A chosen and a rejected conversation share turns up to some point. The longest
common prefix of turns is rendered once, as the prompt; what follows on either
side is rendered as that side's completion, with a mask of the same length in
code points: 1 where a model is trained (an assistant's text and its end
mark), 0 elsewhere. All of it is expressions over the two arrays of turns.

Defined cases: turns are compared null-safely and rendered with empty text for
null; equal conversations are all prompt and have empty completions; an empty
or missing side has an empty completion, and the prompt is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, AFTER_ROLE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def _let(value: Column, f) -> Column:
    return F.transform(F.array(value), f)[0]


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def render(turns: Column) -> Column:
    """Turns (role, text) as one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), _text(t["role"]), F.lit(AFTER_ROLE), _text(t["text"]), F.lit(END))), "")


def mask(turns: Column) -> Column:
    """One digit per code point of ``render(turns)``."""
    def one(t: Column) -> Column:
        head = F.length(_text(t["role"])) + len(START + AFTER_ROLE)
        body = F.length(_text(t["text"])) + len(END)
        return F.concat(F.repeat(F.lit("0"), head), F.when(
            t["role"] == TRAINED, F.repeat(F.lit("1"), body)).otherwise(F.repeat(F.lit("0"), body)))
    return F.array_join(F.transform(turns, one), "")


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    n = F.least(F.size(a), F.size(b))
    same = F.transform(F.slice(a, F.lit(1), n), lambda t, i: t["role"].eqNullSafe(b[i]["role"])
                       & t["text"].eqNullSafe(b[i]["text"]))
    return _let(F.array_position(same, False), lambda p: F.when(p == 0, n).otherwise(p - 1).cast("int"))


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with the two columns of turns replaced by (prompt,
    n_prompt_turns, chosen, chosen_mask, rejected, rejected_mask)."""
    made = ("prompt", "n_prompt_turns", "chosen", "chosen_mask", "rejected", "rejected_mask")
    none = F.array().cast("array<struct<role:string,text:string>>")
    only = lambda c: F.coalesce(F.transform(F.col(c), lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text"))), none)
    kept = [F.col(f"`{c}`") for c in pairs.columns if c not in (chosen, rejected) and c.lower() not in made]
    d = pairs.select(*kept, only(chosen).alias("__c"), only(rejected).alias("__r"))
    d = d.withColumn("__n", common_turns(F.col("__c"), F.col("__r")))
    rest = lambda c: F.slice(F.col(c), F.col("__n") + 1, F.greatest(F.size(c) - F.col("__n"), F.lit(0)))
    return d.select(*kept, render(F.slice("__c", F.lit(1), F.col("__n"))).alias("prompt"),
                    F.col("__n").cast("long").alias("n_prompt_turns"),
                    render(rest("__c")).alias("chosen"), mask(rest("__c")).alias("chosen_mask"),
                    render(rest("__r")).alias("rejected"), mask(rest("__r")).alias("rejected_mask"))


def reply_pairs(conversations: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected) of ``conversations(conv_id, turn, role,
    text)``, a table without stated preferences: chosen is a conversation up to
    its last assistant turn, rejected the same with that turn's text replaced
    by the last assistant text of its neighbour, the conversation whose id
    differs in the lowest bit (none: the turn is missing). Without an assistant
    turn both sides are the whole conversation. Turns are ordered by (turn,
    role, text); rows with a null conv_id belong to no conversation. One row
    holds one conversation."""
    c = conversations.where("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    said = F.transform("turns", lambda t: F.coalesce(t["role"] == TRAINED, F.lit(False)))
    c = c.withColumn("last", F.when(F.array_contains(said, True), F.size("turns") - F.array_position(
        F.reverse(said), True) + 1).otherwise(0).cast("int"))
    reply = c.where("last > 0").select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"),
                                       F.array(F.struct(F.lit(TRAINED).alias("role"), F.get(
                                           "turns", F.col("last") - 1)["text"].alias("text"))).alias("reply"))
    turn = lambda a: F.transform(a, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    upto = lambda n: turn(F.slice("turns", F.lit(1), n))
    none = F.array().cast("array<struct<role:string,text:string>>")
    return c.join(reply, "conv_id", "left").select(
        "conv_id", F.when(F.col("last") == 0, turn("turns")).otherwise(upto(F.col("last"))).alias("chosen"),
        F.when(F.col("last") == 0, turn("turns")).otherwise(
            F.concat(upto(F.greatest(F.col("last") - 1, F.lit(0))), F.coalesce("reply", none))).alias("rejected"))


def op2_preference_format(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return format_preferences(reply_pairs(turns))


def _oracle() -> str:
    show = "'<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10)"
    bits = ("repeat('0', length(coalesce(t.role, '')) + 5) || "
            "repeat(CASE WHEN t.role = 'assistant' THEN '1' ELSE '0' END, length(coalesce(t.text, '')) + 8)")
    return f"""
WITH o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
             role NULLS FIRST, text NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, coalesce(max(i) FILTER (WHERE role = 'assistant'), 0) AS last FROM o GROUP BY 1),
reply AS (SELECT xor(o.conv_id, 1) AS conv_id, o.text FROM o JOIN k ON k.conv_id = o.conv_id AND o.i = k.last),
c AS (SELECT o.* FROM o JOIN k USING (conv_id) WHERE last = 0 OR i <= last),
r AS (SELECT o.* FROM o JOIN k USING (conv_id) WHERE last = 0 OR i < last
      UNION ALL SELECT conv_id, 'assistant', reply.text, k.last FROM k JOIN reply USING (conv_id) WHERE k.last > 0),
d AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, min(coalesce(c.i, r.i)) AS at FROM c FULL JOIN r
        ON c.conv_id = r.conv_id AND c.i = r.i AND c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text
      WHERE c.conv_id IS NULL OR r.conv_id IS NULL GROUP BY 1),
p AS (SELECT k.conv_id, coalesce(d.at - 1, n.n) AS n FROM k LEFT JOIN d USING (conv_id)
      JOIN (SELECT conv_id, count(*) AS n FROM c GROUP BY 1) n USING (conv_id)),
x AS (SELECT t.conv_id, string_agg({show}, '' ORDER BY i) FILTER (WHERE i <= n) AS prompt,
             string_agg({show}, '' ORDER BY i) FILTER (WHERE i > n) AS s, string_agg({bits}, '' ORDER BY i) FILTER (WHERE i > n) AS m
      FROM c t JOIN p USING (conv_id) GROUP BY 1),
y AS (SELECT t.conv_id, string_agg({show}, '' ORDER BY i) FILTER (WHERE i > n) AS s,
             string_agg({bits}, '' ORDER BY i) FILTER (WHERE i > n) AS m
      FROM r t JOIN p USING (conv_id) GROUP BY 1)
SELECT p.conv_id, coalesce(x.prompt, '') AS prompt, CAST(p.n AS BIGINT) AS n_prompt_turns, coalesce(x.s, '') AS chosen,
       coalesce(x.m, '') AS chosen_mask, coalesce(y.s, '') AS rejected, coalesce(y.m, '') AS rejected_mask
FROM p LEFT JOIN x USING (conv_id) LEFT JOIN y USING (conv_id)
"""


ORACLE = _oracle()
