"""Operator 8: preference formatting of chat pairs (DataFrame functions only).

For a pair of conversations (chosen, rejected) the longest common turn prefix
is rendered once as the prompt; the turns after it are rendered as the two
completions.  A completion is a list of segments with a loss mask: the text of
an assistant's turn and its end mark are trained on, headers and other roles'
turns are not.

Turns are compared by digest in narrow rows keyed by (pair, turn number), and
the first number where the sides differ is a minimum per pair, so no
conversation is gathered to find the prefix.  Rendered rows hold at most
``CHUNK_TURNS`` turn numbers of a pair: a longer pair continues in further
rows (``chunk`` 1, 2, ...), so no row or task holds an unbounded conversation.

Defined results: turns stand by turn number (null first); rows repeated in all
four columns count once; different rows under one number are one turn of
several messages, by role and text; null role or text is rendered as empty but
differs from it; a pair with one side missing has an empty prompt; a pair of
equal sides is all prompt; conversations without an id belong to no pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Turn numbers of a pair rendered in one row.
CHUNK_TURNS = 1024
#: Marks around a message; the trained role.
OPEN, MIDDLE, CLOSE, TRAINED = "<|", "|>\n", "<|end|>\n", "assistant"


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id): conversations 2k and 2k + 1, the even one chosen.

    The tables carry no preference mark; this is the registered query's rule."""
    ids = turns.where("conv_id IS NOT NULL").select("conv_id").distinct()
    even = F.pmod("conv_id", F.lit(2)) == 0
    return (ids.groupBy(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"))
            .agg(F.max(F.when(even, F.col("conv_id"))).alias("chosen_id"),
                 F.max(F.when(~even, F.col("conv_id"))).alias("rejected_id")))


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair and chunk: pair_id, chosen_id, rejected_id, chunk, n_prompt_turns,
    prompt, chosen and rejected (arrays of text, loss)."""
    first = F.lit(-(1 << 62))
    rows = (turns.select("conv_id", F.coalesce(F.col("turn").cast("long"), first).alias("turn"), "role", "text")
            .distinct())
    sides = pairs.select("pair_id", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("conv")),
        F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("conv")))).alias("x")).select(
            "pair_id", "x.side", "x.conv")
    paired = rows.join(sides, rows["conv_id"] == sides["conv"]).drop("conv", "conv_id")
    digest = F.sha2(F.to_json(F.struct("role", "text")), 256)
    of = lambda side: F.sort_array(F.collect_set(F.when(F.col("side") == side, F.col("digest"))))
    split = (paired.select("pair_id", "side", "turn", digest.alias("digest"))
             .groupBy("pair_id", "turn").agg(of(0).alias("a"), of(1).alias("b"))
             .groupBy("pair_id").agg(F.min(F.when(F.col("a") != F.col("b"), F.col("turn"))).alias("split")))
    known = pairs.join(split, "pair_id", "left")
    shared = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    part = F.when(shared, F.lit(0)).when(F.col("side") == 0, F.lit(1)).otherwise(F.lit(2))
    placed = (paired.join(split, "pair_id").where(~(shared & (F.col("side") == 1)))
              .withColumn("part", part)
              .withColumn("chunk", F.when(F.col("turn") == first, 0)
                          .otherwise(F.floor(F.col("turn") / CHUNK_TURNS)).cast("long")))
    message = F.struct("turn", "role", "text")
    lists = placed.groupBy("pair_id", "chunk").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("part") == k, message))).alias(name)
        for k, name in enumerate(("p", "c", "r"))])
    head = lambda m: F.concat(F.lit(OPEN), F.coalesce(m.role, F.lit("")), F.lit(MIDDLE))
    body = lambda m: F.concat(F.coalesce(m.text, F.lit("")), F.lit(CLOSE))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = lambda col: F.flatten(F.transform(col, lambda m: F.array(
        segment(head(m), F.lit(False)), segment(body(m), F.coalesce(m.role == TRAINED, F.lit(False))))))
    rendered = lists.select(
        "pair_id", "chunk", F.size(F.array_distinct("p.turn")).cast("long").alias("n_prompt_turns"),
        F.array_join(F.transform("p", lambda m: F.concat(head(m), body(m))), "").alias("prompt"),
        segments(F.col("c")).alias("chosen"), segments(F.col("r")).alias("rejected"))
    return known.drop("split").join(rendered, "pair_id")


def rendered_pairs(turns: DataFrame) -> DataFrame:
    """Every conversation of ``turns`` in its pair, with the completions as strings and the number
    of their characters that are trained on."""
    full = lambda col: F.array_join(F.transform(col, lambda s: s.text), "")
    loss = lambda col: F.aggregate(F.filter(col, lambda s: s.loss), F.lit(0).cast("long"),
                                   lambda a, s: a + F.length(s.text))
    return format_pairs(turns, neighbour_pairs(turns)).select(
        "pair_id", "chosen_id", "rejected_id", "chunk", "n_prompt_turns", "prompt",
        full("chosen").alias("chosen"), full("rejected").alias("rejected"),
        loss("chosen").alias("chosen_loss_chars"), loss("rejected").alias("rejected_loss_chars"))


#: DuckDB SQL of ``rendered_pairs`` over a table whose turn numbers and ids are not null.
RENDERED_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text, conv_id // 2 AS pair_id, conv_id % 2 AS side
           FROM conversations),
ids AS (SELECT pair_id, max(conv_id) FILTER (side = 0) AS chosen_id,
               max(conv_id) FILTER (side = 1) AS rejected_id FROM t GROUP BY pair_id),
per_turn AS (SELECT pair_id, turn,
                    string_agg(CASE WHEN side = 0 THEN coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n') END,
                               chr(2) ORDER BY role, text) AS a,
                    string_agg(CASE WHEN side = 1 THEN coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n') END,
                               chr(2) ORDER BY role, text) AS b
             FROM t GROUP BY pair_id, turn),
split AS (SELECT pair_id, min(turn) FILTER (a IS DISTINCT FROM b) AS at FROM per_turn GROUP BY pair_id),
m AS (SELECT t.*, (split.at IS NULL OR turn < split.at) AS shared, turn // 1024 AS chunk,
             '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS said,
             CASE WHEN role = 'assistant' THEN length(coalesce(text, '')) + 8 ELSE 0 END AS loss
      FROM t JOIN split USING (pair_id))
SELECT pair_id, chosen_id, rejected_id, chunk,
       count(DISTINCT turn) FILTER (shared AND side = 0) AS n_prompt_turns,
       coalesce(string_agg(said, '' ORDER BY turn, role, text) FILTER (shared AND side = 0), '') AS prompt,
       coalesce(string_agg(said, '' ORDER BY turn, role, text) FILTER (NOT shared AND side = 0), '') AS chosen,
       coalesce(string_agg(said, '' ORDER BY turn, role, text) FILTER (NOT shared AND side = 1), '') AS rejected,
       coalesce(sum(loss) FILTER (NOT shared AND side = 0), 0)::BIGINT AS chosen_loss_chars,
       coalesce(sum(loss) FILTER (NOT shared AND side = 1), 0)::BIGINT AS rejected_loss_chars
FROM m JOIN ids USING (pair_id) GROUP BY pair_id, chosen_id, rejected_id, chunk
"""
