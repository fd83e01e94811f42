"""Query ``op10_chat_formatting`` and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.chat import format_examples, read_examples

PROBE = "</s>[INST] ok [/INST]"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    back = read_examples(format_examples(rows.unionByName(probe)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("trained", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


_ESC = "replace({0}, '\\', '\\\\')"
for _c in ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"):
    _ESC = f"replace({_ESC}, '{_c}', '{_c[0]}\\{_c[1:]}')"

OP10_SQL = f"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), t AS (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY conv_id) AS n,
    length('<|im_start|>') + length(replace({_ESC.format('role')}, chr(10), '<|nl|>')) + 1 + length({_ESC.format('text')}) + length('<|im_end|>') + 1 AS len
  FROM src WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), c AS (
  SELECT *, sum(len) OVER (PARTITION BY conv_id ORDER BY rn) AS stop FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(stop) FILTER (WHERE role = 'assistant' OR rn = n)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
