"""Mixing sources to target weights by Poisson replication.

Each text has a hash-seeded uniform number. Its copies are the value at which the cumulative Poisson distribution of its
source passes that number, at most the source's cap. The source's mean is solved so that the copies' tokens meet the
target, from a histogram of tokens over the uniform numbers, whose size depends on the number of targets alone.
"""

from __future__ import annotations

import math
import os
from bisect import bisect_right
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators.lookup import lookup
from harborline.session import materialize

#: Vocabulary file of a public tokenizer, which every executor must have.
TOKENIZER = os.environ.get("HARBORLINE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
BINS, SEED = 4096, 17


def source_key(c: Column) -> Column:
    """One spelling of a source: lower case, without separators."""
    return F.lower(F.regexp_replace(c, r"[\s_\-./]+", ""))


def _counter(path: str):
    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        for pdf in batches:
            sizes: list[int] = []
            for k in range(0, len(pdf), 256):
                sizes += [len(e.ids) for e in tokenizer.encode_batch(pdf.text.iloc[k : k + 256].tolist(), add_special_tokens=False)]
            yield pdf.drop(columns="text").assign(n_tokens=sizes)

    return run


def measured(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = SEED) -> DataFrame:
    """(doc_id, target, n_tokens, u): one row per distinct text of a targeted source, written once.

    Copies of a text, in whichever source, are one text: that of the smallest doc_id. Null and empty texts and sources
    that no target names have no row.
    """
    named = targets.select(source_key(F.col("source")).alias("_source"), F.col("source").alias("target")).where("_source IS NOT NULL").groupBy("_source").agg(F.min("target").alias("target"))
    rows = documents.where("doc_id IS NOT NULL AND text IS NOT NULL AND text <> ''").withColumn("_source", source_key(F.col("source")))
    rows = lookup(rows.select("doc_id", "text", "_source"), named, "_source", "doc_id").where("target IS NOT NULL").select("doc_id", "target", "text")
    first = rows.groupBy(F.sha2("text", 256).alias("_text")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    rows = rows.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    sized = rows.mapInPandas(_counter(tokenizer), "doc_id bigint, target string, n_tokens bigint")
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) / F.lit(float(2**53))
    return materialize(sized.withColumn("u", u), "measured")


def _cumulative(mean: float, cap: int) -> list[float]:
    """P(X <= k) for k < cap of a Poisson distribution; an infinite mean gives zeros."""
    if math.isinf(mean):
        return [0.0] * cap
    out, total = [], 0.0
    for k in range(cap):
        total = min(1.0, total + math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)))
        out.append(total)
    return out


def _expected(bins: list[tuple[float, int]], mean: float, cap: int) -> float:
    steps = _cumulative(mean, cap)
    return sum(n * bisect_right(steps, u) for u, n in bins)


def rates(sized: DataFrame, targets: DataFrame, total: int | None = None) -> list[dict]:
    """Per target: source, share, cap, available tokens, wanted tokens, Poisson mean and cumulative steps.

    Shares are those of the targets whose sources have texts, brought to one. Without `total` the mixture is as large as
    the caps allow at exactly these shares; with a larger total, sources at their cap stay below their share.
    """
    rows = targets.where("source IS NOT NULL AND target_weight > 0").groupBy(source_key(F.col("source")).alias("_source")).agg(F.min("source").alias("source"), F.max("target_weight").alias("weight"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("cap")).collect()
    bins: dict[str, list[tuple[float, int]]] = defaultdict(list)
    for r in sized.groupBy("target", F.floor(F.col("u") * BINS).alias("bin")).agg(F.sum("n_tokens").alias("n")).collect():
        bins[r.target].append(((r.bin + 0.5) / BINS, r.n))
    available = {s: sum(n for _, n in b) for s, b in bins.items()}
    live = [r for r in rows if available.get(r.source) and r.cap > 0]
    weight = sum(r.weight for r in live)
    size = total if total is not None else min((r.cap * available[r.source] * weight / r.weight for r in live), default=0)
    out = []
    for r in rows:
        have = available.get(r.source, 0)
        share = r.weight / weight if r in live else 0.0
        wanted = size * share
        mean = 0.0
        if wanted >= r.cap * have * (1 - 1e-9) and have:
            mean = math.inf
        elif wanted > 0:
            low, high = 0.0, 1.0
            while _expected(bins[r.source], high, r.cap) < wanted:  # ends, as the cap is reached in the limit
                high *= 2
            for _ in range(60):
                mean = (low + high) / 2
                low, high = (mean, high) if _expected(bins[r.source], mean, r.cap) < wanted else (low, mean)
        out.append({"source": r.source, "weight": float(r.weight), "share": share, "cap": int(r.cap), "available": have, "wanted": wanted, "mean": mean, "steps": _cumulative(mean, int(r.cap)) if mean else [1.0] * int(r.cap)})
    return out


def replicated(sized: DataFrame, solved: list[dict]) -> DataFrame:
    """(doc_id, source, n_tokens, copies): how often each text is used."""
    spark = sized.sparkSession
    steps = spark.createDataFrame([(r["source"], r["steps"]) for r in solved], "target string, steps array<double>")
    joined = lookup(sized, steps, "target", "doc_id")
    return joined.select("doc_id", F.col("target").alias("source"), "n_tokens", F.size(F.filter("steps", lambda c: c <= F.col("u"))).alias("copies"))


def mixture(documents: DataFrame, targets: DataFrame, total: int | None = None, tokenizer: str = TOKENIZER, seed: int = SEED) -> DataFrame:
    """(doc_id, copy_no, source, n_tokens, text) in a globally shuffled order, which is the same for the same seed."""
    sized = measured(documents, targets, tokenizer, seed)
    counts = replicated(sized, rates(sized, targets, total)).where("copies > 0")
    rows = documents.select("doc_id", "text").join(counts, "doc_id").dropDuplicates(["doc_id"])
    rows = rows.select("doc_id", F.explode(F.sequence(F.lit(1), "copies")).alias("copy_no"), "source", "n_tokens", "text")
    return rows.withColumn("_at", F.xxhash64(F.lit(seed + 1), "doc_id", "copy_no")).orderBy("_at", "doc_id", "copy_no").drop("_at")


def shares(documents: DataFrame, targets: DataFrame, total: int | None = None, tokenizer: str = TOKENIZER, seed: int = SEED) -> DataFrame:
    """(source, target_weight, target_share, max_repeats, available_tokens, mean_repeats, texts, most_repeats, tokens, share), a row per target.

    A source without texts has share 0; the others' targets are brought to one.
    """
    spark = documents.sparkSession
    sized = measured(documents, targets, tokenizer, seed)
    solved = rates(sized, targets, total)
    used = replicated(sized, solved).groupBy("source").agg(F.count_if(F.col("copies") > 0).alias("texts"), F.max("copies").alias("most_repeats"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"))
    plan = spark.createDataFrame(
        [(r["source"], r["weight"], r["share"], r["cap"], r["available"], r["mean"]) for r in solved],
        "source string, target_weight double, target_share double, max_repeats int, available_tokens bigint, mean_repeats double",
    )
    rows = plan.join(used, "source", "left").fillna(0, ["texts", "most_repeats", "tokens"])
    # a row per target, so that one window holds few rows
    return rows.withColumn("share", F.try_divide(F.col("tokens").cast("double"), F.sum("tokens").over(Window.partitionBy(F.lit(1))).cast("double")))
