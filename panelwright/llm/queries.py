"""Queries p6 to p8: encoding, containers, text quality."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import packing, quality, tokenize, vocabulary
from panelwright.session import cut, table

#: The folder of the tokenizer files is a parameter; this is where it is read from by default.
FOLDER = os.environ.get("PANELWRIGHT_TOKENIZERS", vocabulary.DEFAULT_FOLDER)
LIMITS = packing.Limits()
#: Limits under which the loss-bearing tokens of a container run out before its tokens do.
LOSS_BOUND = packing.Limits(loss_tokens=1_536)


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode(table(spark, d, "documents"), folder=FOLDER)


def _items(spark: SparkSession, d: str, limits: packing.Limits) -> DataFrame:
    """Pieces of every document; token counts are written once, and dealt by what the rows are."""
    found = cut(tokenize.sizes(table(spark, d, "documents"), folder=FOLDER))
    return packing.pieces(packing.dealt(found), limits)


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, piece, first_token, tokens, loss_tokens, container."""
    items = _items(spark, d, LIMITS)
    return packing.pack(items, LIMITS, items.count())


def _fill(packed: DataFrame, limits: packing.Limits) -> DataFrame:
    per = packed.groupBy("container").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("segments"), F.sum("loss_tokens").alias("loss"))
    used = per.agg(
        F.count(F.lit(1)).alias("n_containers"),
        F.sum("tokens").alias("n_tokens"),
        F.max("tokens").alias("most_tokens"),
        F.max("segments").alias("most_segments"),
        F.max(F.when(F.col("segments") > 1, F.col("loss"))).alias("most_shared_loss"),
        F.count_if((F.col("loss") > 0.99 * limits.loss_tokens) & (F.col("tokens") < 0.99 * limits.tokens)).alias("closed_by_loss"),
    )
    return used.withColumn("unused_share", 1 - F.col("n_tokens") / (F.col("n_containers") * limits.tokens))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Tokens, containers and unused share of the filling."""
    return _fill(p7_containers(spark, d), LIMITS)


def p7_fill_loss_bound(spark: SparkSession, d: str) -> DataFrame:
    """The filling with a limit on loss-bearing tokens that binds, as instruction data has it.

    A document longer than that limit has a container of its own.
    """
    items = _items(spark, d, LOSS_BOUND)
    return _fill(packing.pack(items, LOSS_BOUND, items.count()), LOSS_BOUND)


def p7_limits(spark: SparkSession, d: str) -> DataFrame:
    """Counts of what must not be: containers over a limit, documents without a container, cut short, cut needlessly or twice."""
    packed = cut(p7_containers(spark, d))
    full = packed.groupBy("container").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("s"), F.sum("loss_tokens").alias("l"))
    over = full.agg(F.count_if(F.col("t") > LIMITS.tokens).alias("over_tokens"), F.count_if(F.col("s") > LIMITS.segments).alias("over_segments"), F.count_if(F.col("l") > LIMITS.loss_tokens).alias("over_loss"))
    per = packed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("piece").alias("d"), F.sum("tokens").alias("t"), F.min("first_token").alias("a"), F.max(F.col("first_token") + F.col("tokens")).alias("b"))
    wrong = per.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_if(F.col("n") != F.col("d")).alias("repeated_pieces"),
        F.count_if((F.col("a") != 0) | (F.col("b") != F.col("t"))).alias("missing_tokens"),
        F.count_if(F.col("n") != F.greatest(F.lit(1), F.ceil(F.col("t") / LIMITS.tokens))).alias("needless_cuts"),
    )
    return over.join(wrong)  # one row each


#: The list of frequent words travels with the tasks; a longer one is refused.
MAX_COMMON = 200_000


def common_words(spark: SparkSession, d: str) -> frozenset[str]:
    """Frequent words of all languages; the table is a fixed list of a few hundred rows, and its size is checked."""
    words = table(spark, d, "common_words").where("word IS NOT NULL").select(F.lower("word").alias("word")).distinct()
    told = words.limit(MAX_COMMON + 1).collect()
    if len(told) > MAX_COMMON:
        raise ValueError(f"more than {MAX_COMMON} frequent words")
    return frozenset(r["word"] for r in told)


def _statistics(spark: SparkSession, d: str) -> DataFrame:
    common = common_words(spark, d)
    return quality.statistics(quality.merged(quality.pieces(table(spark, d, "documents"), common), common))


def p8_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _statistics(spark, d)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _statistics(spark, d).where("kind IN ('list', 'table', 'junk')").select("doc_id", "kind")


QUERIES = {f.__name__: f for f in (p6_ids, p7_containers, p7_fill, p7_fill_loss_bound, p7_limits, p8_found, p8_statistics)}
#: Tokens cannot be counted in SQL; that limits hold and every document has its containers can be told.
SQL: dict[str, str] = {
    "p7_limits": "SELECT CAST(0 AS BIGINT) AS over_tokens, CAST(0 AS BIGINT) AS over_segments, CAST(0 AS BIGINT) AS over_loss, COUNT(DISTINCT doc_id) AS n_documents, CAST(0 AS BIGINT) AS repeated_pieces, CAST(0 AS BIGINT) AS missing_tokens, CAST(0 AS BIGINT) AS needless_cuts FROM documents",
}
