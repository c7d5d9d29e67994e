"""Text rules of the maintenance assistant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlework.operators.joins import lookup_join
from spindlework.operators.numbering import number_rows

# Prefix of a question and the reply given when none is usable.
PROMPT_PREFIX = "Input: respond to this maintenance question: "
FALLBACK_REPLY = (
    "Je ne peux pas générer une réponse appropriée à cette question. Veuillez reformuler "
    "votre question ou être plus spécifique concernant le problème de maintenance."
)
MIN_REPLY_LENGTH = 10


def prompt(text: str) -> Column:
    return F.concat(F.lit(PROMPT_PREFIX), F.col(text))


def guarded_reply(reply: Column, question: Column) -> Column:
    """The reply, or the fallback when it only repeats the question or is too short."""
    unusable = reply.eqNullSafe(question) | (F.length(reply) < MIN_REPLY_LENGTH)
    return F.when(unusable, F.lit(FALLBACK_REPLY)).otherwise(reply)


def chat_history(df: DataFrame) -> DataFrame:
    """Messages with their ``position`` (1, 2, ...) in the conversation.

    Positions come from one numbering of the whole table, so a conversation of any
    length stays spread over many tasks.
    """
    numbered = number_rows(df, ["conv_id", "turn"], "_row")
    first = numbered.groupBy("conv_id").agg(F.min("_row").alias("_first"))
    return lookup_join(numbered, first, "conv_id").select(
        *df.columns, (F.col("_row") - F.col("_first") + 1).alias("position")
    )


def reply_guard(df: DataFrame, reply: str = "text") -> DataFrame:
    """Assistant replies with the user message just before them, guarded."""
    numbered = number_rows(df, ["conv_id", "turn"], "_row")
    question = numbered.filter(F.col("role") == "user").select(
        F.col("conv_id").alias("_conv"), (F.col("_row") + 1).alias("_next"), F.col("text").alias("question")
    )
    asked = numbered.filter(F.col("role") == "assistant").join(
        question, (F.col("_row") == F.col("_next")) & (F.col("conv_id") == F.col("_conv")), "left"
    )
    return asked.select(
        "conv_id",
        "turn",
        "question",
        guarded_reply(F.col(reply), F.col("question")).alias("reply"),
    )
