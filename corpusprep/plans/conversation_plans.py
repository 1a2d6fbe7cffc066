"""Conversation-log queries (C1-C7, J6) over the conversations table."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.operators import conversations as cv
from corpusprep.sources.tables import table

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


@register("conversation_budget", """
SELECT conv_id, count(*) AS messages, CAST(sum(length(text)) AS BIGINT) AS chars,
       CAST(floor(sum(length(text)) / 4) AS BIGINT) AS tokens, floor(sum(length(text)) / 4) > 1000 AS over_limit
FROM conversations GROUP BY conv_id""")
def conversation_budget(spark, sf_dir):
    """Token estimate per conversation, flagged above 1000 tokens."""
    return cv.token_budget(table(spark, sf_dir, "conversations"), limit=1000)


@register("conversation_turns", """
SELECT conv_id, turn, role,
       CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS turn_no,
       CASE WHEN role = 'assistant' THEN CAST(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (
            PARTITION BY conv_id, tn ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END AS sub_turn
FROM (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tn
      FROM conversations)""")
def conversation_turns(spark, sf_dir):
    """Turn and sub-turn numbering."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return cv.number_turns(c).select("conv_id", "turn", "role", F.col("turn_no").cast("long").alias("turn_no"),
                                     F.col("sub_turn").cast("long").alias("sub_turn"))


@register("conversation_rendered", f"""
SELECT conv_id, md5('{cv.BOS}' || coalesce(string_agg(CASE WHEN role = 'system' THEN text END, chr(10) || chr(10) ORDER BY turn), '')
       || string_agg(CASE WHEN role = 'user' THEN '{cv.USER_MARK}' || text
                          WHEN role = 'assistant' THEN '{cv.ASSISTANT_MARK}' ||
                               CASE WHEN position('</think>' IN text) > 0 THEN split_part(text, '</think>', -1) ELSE text END || '{cv.EOS}'
                          ELSE '' END, '' ORDER BY turn)) AS rendered_md5,
       CAST(count(*) AS BIGINT) AS messages
FROM conversations GROUP BY conv_id""")
def conversation_rendered(spark, sf_dir):
    """C4: chat-template rendering of every conversation."""
    c = table(spark, sf_dir, "conversations")
    r = cv.render_chat(c)
    n = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("messages"))
    return r.join(n, "conv_id").select("conv_id", F.md5("rendered").alias("rendered_md5"), "messages")


@register("conversation_tail", """
WITH j AS (SELECT conv_id, to_json(list({'role': role, 'content': text} ORDER BY turn)) AS js FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(length(right(js, 80000)) AS INTEGER) AS tail_chars, CAST(length(js) AS INTEGER) AS full_chars,
       md5(right(js, 80000)) AS tail_md5 FROM j""")
def conversation_tail(spark, sf_dir):
    """Last 80000 characters of every serialised conversation."""
    t = cv.transcript_tail(table(spark, sf_dir, "conversations"))
    return t.select("conv_id", F.length("tail").alias("tail_chars"), "full_chars", F.md5("tail").alias("tail_md5"))


PARTS_SQL = """
p AS (SELECT conv_id, turn AS pos, role, text AS content,
             lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS pr, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS pt
      FROM conversations),
parts AS (SELECT conv_id, pos, content,
             CASE WHEN role = 'user' THEN 'tool_use' WHEN role = 'assistant' AND pr = 'user' THEN 'tool_result' ELSE 'text' END AS type,
             CASE WHEN role = 'user' THEN CAST(conv_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR)
                  WHEN pr = 'user' THEN CAST(conv_id AS VARCHAR) || ':' || CAST(pt AS VARCHAR) END AS tool_use_id,
             CASE WHEN role = 'user' THEN lower(regexp_extract(content, '^\\s*(\\S+)', 1)) END AS tool_name FROM p)"""


@register("tool_usage_counts", f"""WITH {PARTS_SQL}
SELECT conv_id, tool_name, count(*) AS calls FROM parts WHERE type = 'tool_use' GROUP BY conv_id, tool_name""")
def tool_usage_counts(spark, sf_dir):
    """Tool calls per conversation and tool (user turns read as tool calls named by their first word)."""
    parts = cv.tool_parts_from_turns(table(spark, sf_dir, "conversations"))
    return cv.tool_usage(parts)


@register("compacted_tool_results", f"""WITH {PARTS_SQL},
calls AS (SELECT conv_id, tool_use_id, first(tool_name) AS called FROM parts WHERE type = 'tool_use' GROUP BY conv_id, tool_use_id),
named AS (SELECT parts.*, CASE WHEN type = 'tool_result' THEN coalesce(calls.called, 'unknown') ELSE parts.tool_name END AS tname
          FROM parts LEFT JOIN calls ON parts.conv_id = calls.conv_id AND parts.tool_use_id = calls.tool_use_id),
r AS (SELECT *, sum(CASE WHEN type = 'tool_result' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos DESC
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS from_end FROM named),
c AS (SELECT *, type = 'tool_result' AND from_end > 1 AND length(content) > 100 AND coalesce(tname, 'unknown') NOT IN ('read_file') AS compacted FROM r)
SELECT conv_id, pos, type, tname AS tool_name, compacted,
       md5(CASE WHEN compacted THEN '[Previous: used ' || tname || ']' ELSE content END) AS content_md5 FROM c""")
def compacted_tool_results(spark, sf_dir):
    """C2 + J6: all but the last tool result of every conversation compacted (keep 1, > 100 chars)."""
    parts = cv.tool_parts_from_turns(table(spark, sf_dir, "conversations"))
    out = cv.compact_tool_results(parts, keep=1)
    return out.select("conv_id", "pos", "type", "tool_name", "compacted", F.md5("content").alias("content_md5"))


@register("summarised_conversations", """
WITH b AS (SELECT conv_id, floor(sum(length(text)) / 4) > 1000 AS over_limit FROM conversations GROUP BY conv_id),
s AS (SELECT conv_id, substr(max_by(text, turn) FILTER (WHERE role = 'assistant'), 1, 200) AS summary FROM conversations GROUP BY conv_id),
k AS (SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c JOIN b ON c.conv_id = b.conv_id WHERE NOT b.over_limit),
o AS (SELECT b.conv_id, CAST(0 AS BIGINT) AS turn, 'user' AS role,
             '[Conversation compressed. Transcript: .transcripts/transcript_' || CAST(b.conv_id AS VARCHAR) || '.jsonl]' || chr(10) || chr(10)
             || coalesce(nullif(s.summary, ''), 'No summary generated.') AS text
      FROM b LEFT JOIN s ON b.conv_id = s.conv_id WHERE b.over_limit)
SELECT conv_id, turn, role, md5(text) AS text_md5 FROM (SELECT * FROM k UNION ALL SELECT * FROM o)""")
def summarised_conversations(spark, sf_dir):
    """Conversations over 1000 tokens replaced by one message pointing to the archived
    transcript plus a summary (the first 200 characters of the last assistant turn)."""
    c = table(spark, sf_dir, "conversations")
    summaries = c.where(F.col("role") == "assistant").groupBy("conv_id").agg(
        F.substring(F.max_by("text", "turn"), 1, 200).alias("summary"))
    out = cv.replace_with_summary(c, summaries, limit=1000)
    return out.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))
