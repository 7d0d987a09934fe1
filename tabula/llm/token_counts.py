"""Token counts as an exact histogram of encoded lengths.

Every document is encoded once and only its length is kept. The histogram (one row per
distinct length) is aggregated map-side, so it moves at most one row per length and task.
Suffix sums over it then answer totals, quantiles and totals under truncation for any
context limit without touching the documents again. The sums are taken in blocks of
lengths, so no task holds the whole histogram.

Null and empty texts have length 0. An empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.common import slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Lengths per block of the suffix sums.
BLOCK = 4096


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(df: DataFrame, text_col: str = "text", path: str = VOCABULARY,
                    pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row (n_tokens) per row of ``df``."""

    def lengths(batches):
        enc = _encoding(path, pattern)
        for batch in batches:
            for part in slices(batch):
                n = [len(enc.encode_ordinary(t)) if t else 0 for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n_tokens"])

    return df.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(lengths, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs), one row per distinct length. Histograms of parts add up by union and sum."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per length L of the histogram: documents and tokens at L or more, documents up to L, and
    ``truncated_total``: the tokens that remain if every document is cut to L."""
    h = hist.withColumn("_block", F.floor(F.col("n_tokens") / F.lit(block)))
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = h.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum(tokens).alias("_tokens"))
    # one row per block of lengths: the longest document's length / block rows at most
    above = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("_docs_above"),
        F.coalesce(F.sum("_tokens").over(above), F.lit(0)).alias("_tokens_above"),
        F.coalesce(F.sum("_docs").over(below), F.lit(0)).alias("_docs_below"),
        F.coalesce(F.sum("_tokens").over(below), F.lit(0)).alias("_tokens_below"),
    )
    down = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc())
    up = Window.partitionBy("_block").orderBy("n_tokens")
    out = h.join(blocks, "_block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(down) + F.col("_docs_above")).alias("docs_at_least"),
        (F.sum(tokens).over(down) + F.col("_tokens_above")).alias("tokens_at_least"),
        (F.sum("n_docs").over(up) + F.col("_docs_below")).alias("docs_up_to"),
        (F.sum(tokens).over(up) + F.col("_tokens_below")).alias("_tokens_up_to"),
    )
    longer = F.col("docs_at_least") - F.col("n_docs")
    return out.withColumn("truncated_total", F.col("_tokens_up_to") + longer * F.col("n_tokens")).drop("_tokens_up_to")


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Per context limit: documents cut, tokens kept and tokens lost, from the suffix sums alone."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "max_tokens long")
    # the first length above the limit carries the suffix sums that the limit cuts
    cut = asked.join(sums, F.col("n_tokens") > F.col("max_tokens"), "left").groupBy("max_tokens").agg(
        F.coalesce(F.min_by("docs_at_least", "n_tokens"), F.lit(0)).alias("docs_cut"),
        F.coalesce(F.min_by("tokens_at_least", "n_tokens"), F.lit(0)).alias("_long"),
    )
    total = sums.agg(F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("_total"))
    lost = F.col("_long") - F.col("docs_cut") * F.col("max_tokens")
    return cut.join(total).select(
        "max_tokens", "docs_cut", (F.col("_total") - lost).alias("tokens_kept"), lost.alias("tokens_lost")
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """Per share q: the smallest length that at least q of the documents do not exceed."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(float(q),) for q in shares], "share double")
    total = sums.agg(F.max("docs_at_least").alias("_docs"))
    need = F.col("docs_up_to") >= F.ceil(F.col("share") * F.col("_docs"))
    return asked.join(total).join(sums, need, "left").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
