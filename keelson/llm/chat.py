"""Operator 3: collapse cumulative snapshots of conversations, then render what is left.

A log that stores a conversation after every turn holds each one many times, as prefixes of the last.  Every turn gets
the rolling digest of all turns up to it; a conversation whose whole digest is a proper prefix digest of another one
is dropped by an anti-join, and of equal conversations the one with the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm import work


def turn_digest(salt: int) -> Column:
    """A hash of place, role and text in which null differs from every value."""
    return F.xxhash64(F.lit(salt), F.col("pos"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit("")))


def prefixes(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with pos, n_turns and the rolling digests p1, p2 of the first pos turns.

    The digests are running XORs of 64-bit hashes that hold the place, so they need no sort beyond the window's.
    Equal turn numbers are ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = turns.select("conv_id", "turn", "role", "text").where("conv_id is not null")
    rows = rows.withColumn("pos", F.row_number().over(order)).withColumn("h1", turn_digest(1)).withColumn("h2", turn_digest(2))
    rows = rows.withColumn("p1", F.bit_xor("h1").over(running)).withColumn("p2", F.bit_xor("h2").over(running))
    return rows.withColumn("n_turns", F.count("*").over(Window.partitionBy("conv_id"))).drop("h1", "h2")


def maximal(marked: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that no longer one begins with."""
    digest = ["pos", "p1", "p2"]
    whole = marked.where("pos = n_turns").groupBy(*digest).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = marked.where("pos < n_turns").select(*digest).distinct()
    return whole.join(proper, digest, "left_anti").select("conv_id", F.col("pos").cast("long").alias("n_turns"), "n_copies")


def escaped(c: Column) -> Column:
    """A text that can't be taken for a marker: <| becomes <\\|, and <\\ becomes <\\\\ so that no two texts become one."""
    return F.replace(F.replace(c, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def render(marked: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, rendered: every turn as <|role|>, a line break, its text, <|end|> and a line break.

    Roles and texts are escaped, so what a user wrote never reads as a turn.  A rendered conversation is one value.
    """
    kept = marked.select("conv_id", "pos", escaped(F.coalesce("role", F.lit(""))).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text")).join(chosen, "conv_id")
    turns = F.array_sort(F.collect_list(F.struct("pos", "role", "text")))
    out = kept.groupBy("conv_id", "n_turns", "n_copies").agg(turns.alias("turns"))
    each = F.transform("turns", lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n")))
    return out.select("conv_id", "n_turns", "n_copies", F.array_join(each, "").alias("rendered"))


def collapse(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered.

    Turns without a conv_id are left out; null roles and texts render as nothing but are kept apart from empty ones when
    conversations are compared; repeated turns count; equal turn numbers are ordered by role and text; other columns are
    ignored; an empty table gives no rows.  Long texts are hashed where they lie and written once with their digests: the
    anti-join reads the digests only, and the rendering the texts only.  All turns of one conversation pass through one
    task, as its rendering is one value.
    """
    marked = work.pinned(prefixes(conversations), "turns")
    return render(marked, maximal(marked))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY pos) AS turns,
         string_agg('<|' || replace(replace(coalesce(role, ''), '<\', '<\\'), '<|', '<\|') || '|>' || chr(10) || replace(replace(coalesce(text, ''), '<\', '<\\'), '<|', '<\|') || '<|end|>' || chr(10), '' ORDER BY pos) AS rendered
  FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM c)),
m AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY turns)
SELECT m.conv_id, c.n_turns, m.n_copies, c.rendered
FROM m JOIN c ON m.conv_id = c.conv_id WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.turns = m.turns)
"""
