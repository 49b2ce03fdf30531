"""Mixing sources to target weights with capped repetition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.common import materialize
from loomgraph.llm.bpe import encode


def token_counts(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, source, n_tokens; written once, as several steps read it."""
    return materialize(
        encode(documents.select("doc_id", "source", "text"), ids="n_tokens", tokenizer=tokenizer, count_only=True).drop("text"), "tokens"
    )


def rates(counts: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """source, target_share, max_repeats, source_tokens, rate: how often each record of a source is to be used on average.

    Without total_tokens the mixture is the largest that keeps every target: the smallest of cap * tokens / share over the
    sources. With it, rates beyond max_repeats are cut to max_repeats, and the report shows what the source falls short.
    A source of the targets without any token has rate 0 and doesn't bound the size of the mixture.
    """
    targets = targets.filter("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").groupBy("source").agg(
        F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )
    per = counts.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
    known = targets.join(per, "source", "left").fillna(0, ["source_tokens"])
    size = F.min(F.when(F.col("source_tokens") > 0, F.col("max_repeats") * F.col("source_tokens") / F.col("target_share")))
    total = F.lit(float(total_tokens)) if total_tokens is not None else known.agg(size).scalar()
    rate = F.least(F.col("max_repeats").cast("double"), F.col("target_share") * total / F.col("source_tokens"))
    return known.select(
        "source", "target_share", "max_repeats", "source_tokens", F.when(F.col("source_tokens") > 0, rate).otherwise(0.0).alias("rate")
    )


def copies(seed: int):
    """floor(rate) copies and one more with probability equal to the fraction, drawn from a hash of seed, source and doc_id."""
    draw = F.pmod(F.xxhash64(F.lit(seed), "source", "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("bigint")).cast("int")


def mixture(documents: DataFrame, targets: DataFrame, seed: int = 42, total_tokens: int | None = None, tokenizer: str | None = None) -> DataFrame:
    """The mixture: every column of ``documents`` and copy_no (1, 2, ...), a row for each use of a record.

    A record of a source with rate r comes floor(r) times and once more with the probability of the fraction, never more
    than max_repeats times. Records of a null source, or of one without a target, never come. Null and empty texts have no
    tokens and come like the others of their source. Rows with the same doc_id, source and text draw alike. The same seed
    gives the same mixture. An empty documents or targets table gives no rows. A column copy_no of documents is replaced.
    """
    r = rates(token_counts(documents, tokenizer), targets, total_tokens).select("source", "rate")
    chosen = documents.join(F.broadcast(r), "source")  # one row a source of the fixed target table
    return (
        chosen.withColumn("copy_no", F.explode(F.when(copies(seed) > 0, F.sequence(F.lit(1), copies(seed)))))
        .select(*[c for c in documents.columns if c != "copy_no"], "copy_no")
    )


def mixture_shares(documents: DataFrame, targets: DataFrame, seed: int = 42, total_tokens: int | None = None, tokenizer: str | None = None) -> DataFrame:
    """source, target_share, actual_share, rate, source_tokens, mixed_tokens, mixed_records of every source with a target."""
    counts = token_counts(documents, tokenizer)
    r = rates(counts, targets, total_tokens)
    used = counts.join(F.broadcast(r.select("source", "rate")), "source").withColumn("copies", copies(seed))
    per = used.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("mixed_records"))
    out = r.join(F.broadcast(per), "source", "left").fillna(0, ["mixed_tokens", "mixed_records"])  # one row a source
    total = out.agg(F.nullif(F.sum("mixed_tokens"), F.lit(0))).scalar()
    return out.select(
        "source", "target_share", (F.col("mixed_tokens") / total).alias("actual_share"),
        "rate", "source_tokens", "mixed_tokens", "mixed_records",
    )
