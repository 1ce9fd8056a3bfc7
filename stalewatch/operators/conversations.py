"""Conversation tables: ordered message context and question counts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYSTEM, USER = "system", "user"


def numbered_messages(messages: DataFrame, block: int = 10_000) -> DataFrame:
    """Messages with their position, from 1, in the conversation.

    Rows are numbered inside blocks of consecutive turns and shifted by the size of the earlier
    blocks, so a very long conversation is not sorted by a single task.
    """
    blocked = messages.withColumn("__block", F.floor(F.col("turn") / block))
    sizes = blocked.groupBy("conv_id", "__block").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("conv_id").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col("conv_id").alias("__conv"),
        F.col("__block").alias("__other"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift"),
    )
    inside = Window.partitionBy("conv_id", "__block").orderBy("turn", "role", "text")
    return (
        blocked.join(
            shifts,
            F.col("conv_id").eqNullSafe(F.col("__conv")) & F.col("__block").eqNullSafe(F.col("__other")),
        )
        .withColumn("posicao", (F.col("__shift") + F.row_number().over(inside)).cast("bigint"))
        .drop("__block", "__conv", "__other", "__shift")
    )


def build_context(
    messages: DataFrame, system: str | None = None, prompt: Column | str | None = None, block: int = 10_000
) -> DataFrame:
    """Message list of every conversation, one row per message: conv_id, posicao, role, content.

    A system message, if given, takes position 0; a new user prompt, if given, comes last and once.
    """
    context = numbered_messages(messages, block).select("conv_id", "posicao", "role", F.col("text").alias("content"))
    parts = [context]
    sizes = messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("__n"))

    def single(position: Column, role: str, content: Column) -> DataFrame:
        return sizes.select(
            "conv_id", position.cast("bigint").alias("posicao"), F.lit(role).alias("role"), content.alias("content")
        )

    if system:
        parts.append(single(F.lit(0), SYSTEM, F.lit(system)))
    if prompt is not None:
        parts.append(single(F.col("__n") + 1, USER, F.lit(prompt) if isinstance(prompt, str) else prompt))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def context_lists(context: DataFrame, chunk: int = 1000) -> DataFrame:
    """Ordered arrays of {role, content} with at most ``chunk`` messages: conv_id, parte, mensagens.

    Conversations up to ``chunk`` messages come as one array; longer ones in numbered parts, so that
    no row grows without limit.
    """
    entry = F.struct("posicao", "role", "content")
    parts = context.groupBy("conv_id", F.floor(F.col("posicao") / chunk).alias("parte")).agg(
        F.array_sort(F.collect_list(entry)).alias("__m")
    )
    message = lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
    return parts.select("conv_id", "parte", F.transform("__m", message).alias("mensagens"))


def question_counts(messages: DataFrame) -> DataFrame:
    """Number of user messages by conversation."""
    return messages.groupBy("conv_id").agg(F.count_if(F.col("role") == USER).alias("perguntas"))
