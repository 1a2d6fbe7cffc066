"""Conversation-log analytics (C1-C7, J6) over a table of messages (conv_id, turn, role, text).

Per-conversation order is a window partitioned by the conversation (bounded by its length);
rendering uses an ordered ``collect_list`` per conversation, one string per conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.functions.text import THINK_END, after_marker
from corpusprep.operators.joins import attach_tool_name
from corpusprep.operators.ranking import neighbor_values, running_total

# Compaction settings and chat-template markers of the reference.
TOKEN_LIMIT = 50000
KEEP_RECENT = 3
MIN_RESULT_CHARS = 100
PRESERVE_TOOLS = ("read_file",)
TAIL_CHARS = 80000
BOS = "<｜begin▁of▁sentence｜>"
EOS = "<｜end▁of▁sentence｜>"
USER_MARK = "<｜User｜>"
ASSISTANT_MARK = "<｜Assistant｜>"
TOOL_OUTPUTS_BEGIN = "<｜tool▁outputs▁begin｜>"
TOOL_OUTPUTS_END = "<｜tool▁outputs▁end｜>"
TOOL_OUTPUT_BEGIN = "<｜tool▁output▁begin｜>"
TOOL_OUTPUT_END = "<｜tool▁output▁end｜>"
NO_SUMMARY = "No summary generated."


def token_budget(df: DataFrame, key: str = "conv_id", text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """About four characters per token over the whole conversation; flag above the limit."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("messages"), F.sum(F.length(text)).alias("chars"))
    out = out.withColumn("tokens", F.floor(F.col("chars") / 4).cast("long"))
    return out.withColumn("over_limit", F.col("tokens") > limit)


def compact_tool_results(parts: DataFrame, key: str = "conv_id", pos: str = "pos", keep: int = KEEP_RECENT,
                         min_chars: int = MIN_RESULT_CHARS, preserve=PRESERVE_TOOLS) -> DataFrame:
    """C2 (+J6): every tool result but the last ``keep`` of its conversation becomes
    '[Previous: used <tool>]' when its content is longer than ``min_chars`` and the tool (found
    through the call id, else 'unknown') is not preserved.  The position from the end is the
    conversation's result total minus a range-bucketed running count, so a huge conversation is
    never sorted in one task."""
    named = attach_tool_name(parts, conv=key)
    is_result = (F.col("type") == "tool_result").cast("long")
    totals = named.groupBy(key).agg(F.sum(is_result).alias("_total"))
    ranked = running_total(named, key, pos, is_result, "_upto").join(totals, key)
    from_end = F.col("_total") - F.col("_upto") + 1
    clear = (F.col("type") == "tool_result") & (from_end > keep) & (F.length("content") > min_chars) & \
        ~F.coalesce(F.col("tool_name"), F.lit("unknown")).isin(*preserve)
    flagged = ranked.withColumn("compacted", clear)
    return flagged.withColumn("content", F.when(F.col("compacted"), F.concat(F.lit("[Previous: used "), F.col("tool_name"), F.lit("]")))
                              .otherwise(F.col("content"))).drop("_total", "_upto")


def number_turns(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role") -> DataFrame:
    """A user message starts a turn; every assistant step inside it is a sub-turn from 1.
    Both counters are range-bucketed running sums; the assistant count at the turn's user message
    comes back through an equi-join on (conversation, turn number)."""
    is_user = (F.col(role) == "user").cast("long")
    is_asst = (F.col(role) == "assistant").cast("long")
    out = running_total(df, key, order, is_user, "turn_no")
    out = running_total(out, key, order, is_asst, "_asst")
    at_user = out.where(F.col(role) == "user").select(key, "turn_no", F.col("_asst").alias("_asst_at_user"))
    out = out.join(at_user, [key, "turn_no"], "left")
    sub = F.col("_asst") - F.coalesce(F.col("_asst_at_user"), F.lit(0))
    return out.withColumn("sub_turn", F.when(F.col(role) == "assistant", sub)).drop("_asst", "_asst_at_user")


def render_chat(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """C4: the chat template: BOS, system parts joined by a blank line, then every message with its
    role marker; assistant text after the last reasoning marker, closed by the end-of-sentence
    token; tool outputs wrapped (the first one of the conversation opens the outputs block).
    Neighbour, running-count and last-role lookups are joins and bucketed sums; only the final
    string of a conversation is assembled in one place, as the output requires."""
    nb = neighbor_values(df, key, order, [role], -1, "_p_")
    nb = running_total(nb, key, order, (F.col(role) == "tool").cast("long"), "_tools")
    last = df.groupBy(key).agg(F.max_by(role, order).alias("_last_role"))
    prev = F.col(f"_p_{role}")
    first_tool = F.col("_tools") == 1
    content = F.coalesce(F.col(text), F.lit(""))
    piece = (F.when(F.col(role) == "user", F.concat(F.lit(USER_MARK), content))
             .when((F.col(role) == "assistant") & (prev == "tool"), F.concat(F.lit(TOOL_OUTPUTS_END), content, F.lit(EOS)))
             .when(F.col(role) == "assistant", F.concat(F.lit(ASSISTANT_MARK), after_marker(content, THINK_END), F.lit(EOS)))
             .when((F.col(role) == "tool") & first_tool,
                   F.concat(F.lit(TOOL_OUTPUTS_BEGIN + TOOL_OUTPUT_BEGIN), content, F.lit(TOOL_OUTPUT_END)))
             .when(F.col(role) == "tool", F.concat(F.lit(TOOL_OUTPUT_BEGIN), content, F.lit(TOOL_OUTPUT_END))))
    rows = nb.select(key, order, role, text, piece.alias("_piece"))
    agg = rows.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(order, "_piece"))).alias("_ps"),
        F.sort_array(F.collect_list(F.when(F.col(role) == "system", F.struct(order, text)))).alias("_sys")).join(last, key)
    system = F.array_join(F.transform("_sys", lambda s_: s_[text]), "\n\n")
    body = F.array_join(F.transform("_ps", lambda s_: s_["_piece"]), "")
    tail = F.when(F.col("_last_role") == "tool", F.lit(TOOL_OUTPUTS_END)).otherwise(F.lit(""))
    return agg.select(key, F.concat(F.lit(BOS), system, body, tail).alias("rendered"))


def transcript_tail(df: DataFrame, key: str = "conv_id", order: str = "turn", n: int = TAIL_CHARS) -> DataFrame:
    """The last n characters of the conversation serialised as a JSON list of messages.
    Every message is serialised on its own; a bucketed running length from the end keeps only the
    messages that reach into the last n characters, so at most n characters (plus one message)
    per conversation are gathered, however long the conversation is."""
    msg = df.select(key, order, F.to_json(F.struct(F.col("role"), F.col("text").alias("content"))).alias("_j"))
    msg = msg.withColumn("_len", F.length("_j").cast("long") + 1)          # the message and its comma or bracket
    totals = msg.groupBy(key).agg(F.sum("_len").alias("_total"), F.min(order).alias("_first"))
    upto = running_total(msg, key, order, F.col("_len"), "_upto").join(totals, key)
    after = F.col("_total") - F.col("_upto")                                # characters after this message
    kept = upto.where(after + 1 < n)                                        # some of it lies in the tail
    agg = kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, "_j"))).alias("_m"),
                                F.first("_total").alias("_total"), F.min(order).alias("_kfirst"), F.first("_first").alias("_first"))
    body = F.array_join(F.transform("_m", lambda m: m["_j"]), ",")
    js = F.concat(F.when(F.col("_kfirst") == F.col("_first"), F.lit("[")).otherwise(F.lit(",")), body, F.lit("]"))
    return agg.select(key, F.right(js, F.lit(n)).alias("tail"), (F.col("_total") + 1).cast("int").alias("full_chars"))


def tool_usage(parts: DataFrame, key: str = "conv_id") -> DataFrame:
    """Tool calls per conversation and tool."""
    return parts.where(F.col("type") == "tool_use").groupBy(key, "tool_name").agg(F.count(F.lit(1)).alias("calls"))


def replace_with_summary(df: DataFrame, summaries: DataFrame, key: str = "conv_id", order: str = "turn",
                         limit: int = TOKEN_LIMIT, archive_dir: str = ".transcripts") -> DataFrame:
    """Conversations over the token limit become one user message pointing to the archived
    transcript followed by the summary (from ``summaries``, else a fixed note); the others stay."""
    budget = token_budget(df, key, limit=limit).select(key, "over_limit")
    flagged = df.join(budget, key)
    keep = flagged.where(~F.col("over_limit")).drop("over_limit")
    over = budget.where(F.col("over_limit")).select(key).join(summaries, key, "left")
    path = F.concat(F.lit(f"{archive_dir}/transcript_"), F.col(key).cast("string"), F.lit(".jsonl"))
    msg = F.concat(F.lit("[Conversation compressed. Transcript: "), path, F.lit("]\n\n"),
                   F.coalesce(F.nullif(F.col("summary"), F.lit("")), F.lit(NO_SUMMARY)))
    replaced = over.select(key, F.lit(0).cast(df.schema[order].dataType).alias(order), F.lit("user").alias("role"), msg.alias("text"))
    return keep.select(key, order, "role", "text").unionByName(replaced)


def tool_parts_from_turns(df: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Message parts view of a plain conversation log: each user turn is a tool call named by its
    first word (lower-cased), the following assistant turn is that call's result.  The previous
    message comes from a hot-key-safe neighbour join, not a conversation-wide window."""
    nb = neighbor_values(df, key, order, ["role", order], -1, "_p_")
    name = F.lower(F.regexp_extract("text", r"^\s*(\S+)", 1))
    use_id = F.concat_ws(":", F.col(key).cast("string"), F.col(order).cast("string"))
    prev_id = F.concat_ws(":", F.col(key).cast("string"), F.col(f"_p_{order}").cast("string"))
    return nb.select(
        key, F.col(order).alias("pos"),
        F.when(F.col("role") == "user", F.lit("tool_use")).when((F.col("role") == "assistant") & (F.col("_p_role") == "user"),
                                                                 F.lit("tool_result")).otherwise(F.lit("text")).alias("type"),
        F.when(F.col("role") == "user", use_id).when(F.col("_p_role") == "user", prev_id).alias("tool_use_id"),
        F.when(F.col("role") == "user", name).alias("tool_name"),
        F.col("text").alias("content"))
