"""Mixing sources to target weights by Sainte-Lague apportionment.

A seat is one word. The words of the mix go to the sources, and then those of
a source to its shards, by the highest quotients ``votes / (2 * seats + 1)``;
a source's votes are its target, a shard's the words it holds. So every
source gives its target to within about a word, however small it is beside
the others. Each source has its own shards, as many as its own words and rows
need (a small source is one), and its documents fall into them by a seeded
hash. In a shard the documents, in seeded order, form one stream of words that
is cut into blocks of ``block`` words (the last one may be shorter). A shard's
quota is met with whole passes over its words plus blocks in a seeded order,
the last of which gives only its first words, so a word is never taken more
than ``cap`` times and reruns agree.

Defined cases: null text, or text without words: size 0, taken 0. A null
source is a source of its own, last in order. Repeated rows and repeated ids
are separate documents (equal rows are interchangeable). No documents: no
rows. Null ids are hashed like any value.

Scale: one scan of the texts gives a slim (id, source, size) stage. Sources
are summed with map-side partial sums; the only one-task step is over one row
per source, and a source's words are shared out over one row per shard. A
group given to one Python call holds about ``shard_words`` words or
``shard_rows`` rows of a source.
"""

from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skuflow.llm.common import text_of, word_count
from skuflow.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK = 64
SHARD_WORDS = 500_000
SHARD_ROWS = 20_000


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``sizes`` (source, size) -> one row per source: source, source_size, weight, target.

    Weights repeat along the sources in code-point order, null last. ``share``
    of all words is split by weight; a target stops at ``cap`` times its
    source's size and the excess is split again by weight. In closed form:
    with sources ordered by ``cap * size / weight``, the level is the share
    left by the first k sources over the weights of the others, at the first
    source that stays under its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    everyone = W.partitionBy()
    names = everyone.orderBy(F.col("source").asc_nulls_last())
    pick = (F.row_number().over(names) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (pick + 1).cast("int")))
    most = F.lit(float(cap)) * F.col("source_size")
    by_level = everyone.orderBy(F.col("level"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    onward = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    per = (per.withColumn("most", most).withColumn("level", F.col("most") / F.col("weight"))
           .withColumn("total", F.sum("source_size").over(everyone) * F.lit(float(share)))
           .withColumn("flat", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                       / F.sum("weight").over(onward)).withColumn("place", F.row_number().over(by_level)))
    first = F.min(F.when(F.col("flat") <= F.col("level"), F.struct("place", "flat"))).over(everyone)["flat"]
    target = F.least(F.col("most"), F.col("weight") * F.coalesce(first, F.lit(math.inf)))
    return per.select("source", "source_size", "weight", target.alias("target"))


def highest_quotients(votes: np.ndarray, most: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Lague: ``seats`` go one by one to the highest ``votes / (2 * held + 1)``
    (ties: the earlier row); a row stops at ``most``. The seats above a quotient
    that surely all are given are counted at once, the others dealt one by one."""
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)

    def above(quotient: float) -> np.ndarray:
        return np.clip(np.minimum(np.ceil((votes / quotient - 1) / 2), most), 0, None).astype(np.int64)

    held = np.zeros(len(votes), dtype=np.int64)
    low, high = 0.0, votes.max(initial=0.0)
    if high > 0:
        for _ in range(100):
            middle = (low + high) / 2
            low, high = (low, middle) if above(middle).sum() <= seats else (middle, high)
        held = np.maximum(above(high) - 1, 0)  # one less, as a quotient equal to ``high`` may round to either side
        seats -= int(held.sum())
    heap = [(-float(v) / (2 * int(held[i]) + 1), i) for i, v in enumerate(votes) if v > 0 and most[i] > held[i]]
    heapq.heapify(heap)
    while seats > 0 and heap:
        _, i = heap[0]
        held[i] += 1
        seats -= 1
        if held[i] >= most[i]:
            heapq.heappop(heap)
        else:
            heapq.heapreplace(heap, (-float(votes[i]) / (2 * int(held[i]) + 1), i))
    return held


def _shares(cap: int):
    """Words of the mix to sources, one row each."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("skey", kind="stable")
        votes = pdf["target"].to_numpy(float)
        return pdf.assign(give=highest_quotients(votes, cap * pdf["source_size"].to_numpy(np.int64), int(math.floor(votes.sum() + 0.5))))
    return run


def _quotas(cap: int):
    """Words of a source to its shards, one row each."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", kind="stable")
        words = pdf["words"].to_numpy(np.int64)
        return pd.DataFrame({"shard": pdf["shard"], "skey": pdf["skey"],
                             "quota": highest_quotients(words, cap * words, int(pdf["give"].iloc[0]))})
    return run


def _choose(block: int, seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "doc_id", "size", "tag"], kind="stable")
        size = pdf["size"].to_numpy(np.int64)
        end = np.cumsum(size)
        start = end - size
        n = int(-(-end[-1] // block))
        passes, rest = divmod(int(pdf["quota"].iloc[0]), max(1, int(end[-1])))
        more = np.zeros(n + 1, dtype=np.int64)  # how many first words of a block are taken once more
        if n:
            length = np.minimum(block, end[-1] - block * np.arange(n))
            own = zlib.crc32(f"{seed}/{pdf['shard'].iloc[0]}/{pdf['skey'].iloc[0]}".encode())
            order = np.random.Generator(np.random.PCG64(own)).permutation(n)
            more[order] = np.clip(rest - (np.cumsum(length[order]) - length[order]), 0, length[order])
        before = np.concatenate(([0], np.cumsum(more)))
        upto = lambda x: passes * x + before[x // block] + np.minimum(x % block, more[x // block])
        runs = []
        for a, b in zip(start.tolist(), end.tolist()):
            own_runs = []
            for k in range(a // block, -(-b // block) if b > a else a // block):
                lo, hi = max(a, k * block), min(b, (k + 1) * block)
                turn = min(max(lo, k * block + int(more[k])), hi)
                if turn > lo:
                    own_runs.append((lo - a, turn - a, passes + 1))
                if hi > turn and passes:
                    own_runs.append((turn - a, hi - a, passes))
            runs.append([x for r in own_runs for x in r])
        return pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "size": size,
                             "source_size": pdf["source_size"], "target": pdf["target"],
                             "taken": upto(end) - upto(start), "runs": runs, "tag": pdf["tag"]})
    return run


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, block: int = BLOCK,
                seed: int = 17, shard_words: int = SHARD_WORDS, shard_rows: int = SHARD_ROWS, tag: Column | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source) -> one row per document: doc_id, source, size,
    source_size, target (its source's), taken (words the mix takes), runs (flat
    triples: first word, end word exclusive, times taken), and the text column ``tag``
    (null by default) as given, to tell rows with one id apart."""
    slim = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                   word_count(text_of()).alias("size"), (F.lit(None) if tag is None else tag).cast("string").alias("tag")), "mix-sizes")
    skey = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))
    rows = slim.groupBy(skey.alias("skey")).agg(F.count(F.lit(1)).alias("rows"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(shard_words)), F.ceil(F.col("rows") / F.lit(shard_rows))).cast("int")
    goal = source_targets(slim, weights, share, cap).select(skey.alias("skey"), "source_size", "target").join(rows, "skey")
    goal = materialize(goal.select("skey", "source_size", "target", shards.alias("shards")).groupBy().applyInPandas(
        _shares(cap), "skey string, source_size long, target double, shards int, give long"), "mix-goals")
    cut = (slim.withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id"))).withColumn("skey", skey).join(goal, "skey")
           .withColumn("shard", F.pmod(F.col("h"), F.col("shards")).cast("int")))
    cells = cut.groupBy("shard", "skey").agg(F.sum("size").cast("long").alias("words"), F.first("give").alias("give"))
    quotas = cells.groupBy("skey").applyInPandas(_quotas(cap), "shard int, skey string, quota long")
    per_doc = cut.join(quotas, ["shard", "skey"])
    return per_doc.groupBy("shard", "skey").applyInPandas(
        _choose(block, seed),
        "doc_id long, source string, size long, source_size long, target double, taken long, runs array<long>, tag string")


def op10_mix_sources(spark, sf_dir):
    from skuflow.llm.common import table
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
