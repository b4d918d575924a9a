"""Document fingerprints from prefix polynomial hashes.

For a text's code points c0..c(n-1) the prefix array holds
``P[i] = sum over j < i of (c_j + 1) * B**j mod (2**31 - 1)`` for two bases.
``(P[b] - P[a]) * B**-a`` is then a hash of the span [a, b) wherever it lies,
so equality of any two spans costs O(1) (`span_hash`), and the longest common
extension of two positions is found by binary search (`common_extension`).

Fingerprint (text): ``<code points>.<two whole-text hashes>.<sketch>``; the
sketch is the ``keep`` smallest distinct mixed hashes of all spans of
``span`` code points (a shorter text is one span), in hex. Equal texts have
equal fingerprints. Likeness of two fingerprints: 1 if length and whole
hashes agree, else the share of common values among the ``keep`` smallest of
the union, an estimate of the Jaccard likeness of the span sets.

Defined cases: null counts as empty text. Two empty texts are alike (1), an
empty and another text are not (0). The next document is the next row in
order of doc_id (null ids first, equal ids by text), after the last the
first; a single document is its own next one. Repeated rows stay separate.

Scale: one scan of the ids fixes range bounds and each range's first row (one
value a range); then one shuffle of the whole texts by range, a range's first
row also going to the range before. Each task streams its sorted rows and
holds two documents at a time. All code points count, however long a text is.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import partitions_for, table, text_of

PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
SPAN = 16
KEEP = 64
RANGES_PER_PARTITION = 4


def _mod(x: np.ndarray) -> np.ndarray:
    """x mod 2**31 - 1 for x below 2**62."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - PRIME, x)


class Powers:
    """B**0, B**1, ... and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, PRIME)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) <= n:
            k = len(self.up)
            self.up = np.concatenate((self.up, _mod(self.up * np.uint64(pow(self.base, k, PRIME)))))
            self.down = np.concatenate((self.down, _mod(self.down * np.uint64(pow(self.inverse, k, PRIME)))))


class PrefixHashes:
    """Prefix arrays of one text, one per base."""

    def __init__(self, codes: np.ndarray, powers: list[Powers]):
        self.n, self.powers, self.prefix = len(codes), powers, []
        c = codes.astype(np.uint64) + np.uint64(1)
        for p in powers:
            p.reach(self.n)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_mod(c * p.up[:self.n]), out=sums[1:])
            self.prefix.append(_mod(sums))

    def span_hash(self, a: int, b: int) -> tuple[int, ...]:
        return tuple((int(s[b]) - int(s[a])) * int(p.down[a]) % PRIME for s, p in zip(self.prefix, self.powers))

    def all_spans(self, span: int) -> np.ndarray:
        """Hash under the first base of every span of that length."""
        s, p = self.prefix[0], self.powers[0]
        m = self.n - span + 1
        return _mod(_mod(s[span:] + np.uint64(PRIME) - s[:m]) * p.down[:m])


def common_extension(x: PrefixHashes, i: int, y: PrefixHashes, j: int) -> int:
    """Length of the longest common extension of x at i and y at j."""
    low, high = 0, min(x.n - i, y.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if x.span_hash(i, i + mid) == y.span_hash(j, j + mid):
            low = mid
        else:
            high = mid - 1
    return low


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(32)


def sketch(h: PrefixHashes, span: int, keep: int) -> tuple[int, ...]:
    if not h.n:
        return ()
    values = _mix(h.all_spans(min(span, h.n)))
    if len(values) > 8 * keep:  # the smallest distinct values lie under this bound; widen it if copies left too few
        bound = int((4 * keep / len(values)) * 2.0 ** 32)
        while True:
            few = np.unique(values[values <= np.uint64(bound)])
            if len(few) >= keep or bound >= 1 << 32:
                return tuple(few[:keep].tolist())
            bound *= 8
    return tuple(np.unique(values)[:keep].tolist())


class Printer:
    def __init__(self, span: int = SPAN, keep: int = KEEP):
        self.span, self.keep, self.powers = span, keep, [Powers(b) for b in BASES]

    def hashes(self, text: str) -> PrefixHashes:
        return PrefixHashes(np.frombuffer(text.encode("utf-32-le"), np.uint32), self.powers)

    def parts(self, text: str) -> tuple[PrefixHashes, tuple, tuple[int, ...]]:
        h = self.hashes(text)
        return h, (h.n, *h.span_hash(0, h.n)), sketch(h, self.span, self.keep)

    def likeness(self, whole_a, sketch_a, whole_b, sketch_b) -> float:
        if whole_a == whole_b:
            return 1.0
        a, b = set(sketch_a), set(sketch_b)
        union = sorted(a | b)[:self.keep]
        return sum(v in a and v in b for v in union) / len(union) if union else 0.0


def as_text(whole: tuple, values: tuple[int, ...]) -> str:
    return f"{whole[0]:x}.{whole[1]:08x}{whole[2]:08x}." + "".join([f"{v:08x}" for v in values])


def edited(text: str, following: str) -> str:
    """The last quarter of the code points gives way to the first as many of the next text."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
          ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
          ("common_edited", pa.int64()), ("common_next", pa.int64())]
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_edited long, common_next long")


def _streamer(span: int, keep: int):
    def run(batches):
        import pyarrow as pa
        printer, held, group, out = Printer(span, keep), None, None, []
        names, kinds = [f[0] for f in FIELDS], [f[1] for f in FIELDS]

        def flush():
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            pids, extras, ids = (batch.column(i).to_pylist() for i in range(3))
            texts = batch.column(3)
            for row, (pid, extra, doc_id) in enumerate(zip(pids, extras, ids)):
                if extra and (held is None or pid != group):
                    continue  # a second row at the bound: the first one has served
                text = texts[row].as_py()
                parts = printer.parts(text)
                if held is not None and pid == group:
                    own_id, own_text, (h, whole, own) = held
                    changed = edited(own_text, text)
                    eh, ewhole, esketch = printer.parts(changed)
                    out.append((own_id, h.n, hashlib.sha256(changed.encode()).hexdigest(), as_text(whole, own), as_text(ewhole, esketch),
                                printer.likeness(whole, own, ewhole, esketch), printer.likeness(whole, own, parts[1], parts[2]),
                                common_extension(h, 0, eh, 0), common_extension(h, 0, parts[0], 0)))
                    if len(out) >= 1000:
                        yield flush()
                held, group = (None if extra else (doc_id, text, parts)), pid
        if out:
            yield flush()
    return run


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds <= key, looked up in two levels of about sqrt(n) steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    first = F.lit([g[0] for g in groups])
    g = F.size(F.filter(first, lambda b: b <= key))
    fine = F.element_at(F.array(*[F.lit(x) for x in groups]), g)
    return F.when(g == 0, F.lit(0)).otherwise((g - 1) * step + F.size(F.filter(fine, lambda b: b <= key)))


def fingerprint_documents(docs: DataFrame, span: int = SPAN, keep: int = KEEP) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per row: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, and the lengths of the
    common prefix with the edited and the next text (common_edited, common_next)."""
    n = partitions_for(docs)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(key.alias("k"))
    ranges = n * RANGES_PER_PARTITION
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(ids.agg(F.percentile_approx("k", cuts, 100 * ranges).alias("b")).first()["b"] or [])) if cuts else []
    pid = range_of(F.col("k"), bounds)
    starts = sorted((r["pid"], r["k"]) for r in ids.select(pid.alias("pid"), "k").groupBy("pid").agg(F.min("k").alias("k")).collect())
    rows = docs.select(key.alias("k"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("pid", pid)
    before = [0] * (len(bounds) + 1)
    for (p, _), (q, _) in zip(starts, starts[-1:] + starts[:-1]):
        before[p] = q
    is_start = F.col("k").isin([k for _, k in starts]) if starts else F.lit(False)
    own = F.struct(F.col("pid").alias("pid"), F.lit(0).alias("extra"))
    also = F.struct(F.element_at(F.lit(before), F.col("pid") + 1).alias("pid"), F.lit(1).alias("extra"))
    dealt = rows.select(F.explode(F.when(is_start, F.array(own, also)).otherwise(F.array(own))).alias("to"), "k", "doc_id", "text")
    dealt = dealt.select(F.col("to.pid").alias("pid"), F.col("to.extra").alias("extra"), "k", "doc_id", "text")
    laid = dealt.repartition(n, "pid").sortWithinPartitions("pid", "extra", "k", "text")
    return laid.select("pid", "extra", "doc_id", "text").mapInArrow(_streamer(span, keep), SCHEMA)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
