"""MinHash near-duplicates with odd sketches.

A document's set: the distinct runs of ``words`` consecutive words (ASCII
letters lower-cased, words split at ASCII white space), as 64-bit hashes; a
shorter text is one shingle; a text without words has none and links with
nothing. Two documents link when ``100 * |A & B| >= percent * |A | B|``.

1. Each text gives its MinHash samples, grouped into bands of ``ROWS``, and an
   odd sketch: every (position, sample) flips one bit of a 512-bit map, so the
   XOR of two maps has about as many bits as samples differ. Documents with
   equal sets are one class.
2. In every band bucket each class is paired with the bucket's smallest one (a
   star, never all pairs). The pair goes on if set sizes and the XOR's
   population count allow the threshold, and is confirmed on the full sets.
3. Connected components of the confirmed links. A bucket whose classes are all
   in one component is settled. In the others, classes of different
   components are compared by their sketches, block against block; those with
   an open pair bring their full sets to the block, where pairs are judged and
   joined at once, so a block returns links that join components, never all
   its pairs. Then components again. So every pair that shares a bucket
   either ends in one component or has been judged.

The number of bands makes a pair at the threshold share a bucket but for a
chance of 1e-9, and the XOR bound lets one pass but for about 1e-9; pairs
above the threshold are safer still.

Defined cases: null text counts as empty; empty documents are their own
component. Rows sharing an id count as one document (a row each is returned);
each of its texts is judged by its own set.
A null id sorts last and counts as one document. Empty table: no rows.

Scale: whole texts are read twice and never shuffled; what moves are the
signatures (about 300 bytes a class), and the sets of documents that have a
candidate partner. Hot buckets meet only through partial minima, joins that
AQE can split, and blocks of bounded size. The list of candidate ids is
broadcast only while it counts at most ``BROADCAST_IDS``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import table, text_of
from skuflow.session import materialize

ROWS = 4
MISS = 1e-9
SKETCH_WORDS = 8
BROADCAST_IDS = 400_000
BLOCK_MEMBERS = 2048
CACHE_WORDS = 500_000
NULL_ID = (1 << 63) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text."""

    def __init__(self, words: int):
        import xxhash
        hash_word = xxhash.xxh3_64_intdigest

        class Known(dict):
            def __missing__(self, word):
                h = hash_word(word)
                if len(self) < CACHE_WORDS and len(word) <= 64:
                    self[word] = h
                return h
        self.words, self.known = words, Known()

    def __call__(self, text: str) -> np.ndarray:
        split = text.encode("utf-8", "surrogatepass").lower().split()
        if not split:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.known.__getitem__, split), np.uint64, len(split))
        size = min(self.words, len(h))
        m = len(h) - size + 1
        out = np.full(m, 0x9E3779B97F4A7C15 + size, np.uint64)
        for i in range(size):
            out = _mix(out * np.uint64(0xD6E8FEB86659FD93) + h[i:i + m])
        return np.unique(out)


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log(1 - min(0.999999, (percent / 100) ** rows))))


def xor_bound(percent: int, samples: int, bits: int = 64 * SKETCH_WORDS) -> int:
    """Most XOR bits of a pair at the threshold: 6.5 deviations of differing samples, then of bits."""
    j = percent / 100
    differ = min(samples, samples * (1 - j) + 6.5 * math.sqrt(samples * j * (1 - j)) + 1)
    mean = bits / 2 * (1 - (1 - 2 / bits) ** (2 * differ))
    return math.ceil(min(2 * differ, mean + 3 * math.sqrt(mean)))


def _coefficients(samples: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20_231))
    return (rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


def min_hashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    best = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 2048):
        np.minimum(best, (shingles[at:at + 2048, None] * a + b).min(axis=0), out=best)
    return best


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """512-bit parity map of the (position, sample) pairs, as eight 64-bit words."""
    spots = _mix(samples + np.arange(1, len(samples) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(64 * SKETCH_WORDS)
    odd = np.bincount(spots.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _signer(words: int, percent: int):
    def run(batches):
        import pyarrow as pa
        import xxhash
        n_bands = bands_for(percent)
        a, b = _coefficients(n_bands * ROWS)
        shingler, tags = Shingler(words), np.arange(1, n_bands + 1, dtype=np.uint64)
        for batch in batches:
            sizes, keys, bands, sketches = [], [], [], []
            for text in batch.column(1):
                s = shingler(text.as_py())
                sizes.append(len(s))
                if not len(s):
                    keys.append(b""), bands.append([]), sketches.append([0] * SKETCH_WORDS)
                    continue
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                m = min_hashes(s, a, b)
                row = _mix(tags)
                for part in m.reshape(n_bands, ROWS).T:
                    row = _mix(row * np.uint64(0xD6E8FEB86659FD93) + part)
                bands.append(row.view(np.int64).tolist())
                sketches.append(odd_sketch(m).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sketches, pa.list_(pa.int64()))], names=["k", "n", "set_key", "bands", "sketch"])
    return run


def _set_maker(words: int):
    def run(batches):
        import pyarrow as pa
        import xxhash
        shingler = Shingler(words)

        def rows(ids, sets):
            keys = [xxhash.xxh3_128_digest(x) if x else b"" for x in sets]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sets, pa.binary())],
                                              names=["k", "set_key", "set"])
        for batch in batches:
            ids, sets, held = [], [], 0
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(k)
                sets.append(shingler(text.as_py()).tobytes())
                held += len(sets[-1])
                if held > 8 << 20:
                    yield rows(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield rows(ids, sets)
    return run


def _judge(percent: int):
    """Rows sorted by (a, b, k): the sets of a pair follow one another."""
    def run(batches):
        import pyarrow as pa
        pair, first, linked = None, [], []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(3)]
            for a, b, k, raw in zip(*cols, batch.column(3)):
                if (a, b) != pair:
                    pair, first = (a, b), []
                own = np.frombuffer(raw.as_py(), np.uint64)
                if k == a:
                    first.append(own)
                else:
                    for other in first:
                        both = len(np.intersect1d(own, other, assume_unique=True))
                        if 100 * both >= percent * (len(own) + len(other) - both):
                            linked.append((a, b))
                            break
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in linked], pa.int64()), pa.array([x[1] for x in linked], pa.int64())], names=["a", "b"])
                linked = []
    return run


def sets_of(members: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(k, set_key, set) of the documents named in ``members`` (k), a row for each of their texts."""
    ids = materialize(members.select("k").distinct(), "near-ids")
    few = ids.count() <= BROADCAST_IDS
    wanted = texts.join(F.broadcast(ids) if few else ids, "k", "left_semi")
    return wanted.select("k", "text").mapInArrow(_set_maker(words), "k long, set_key binary, set binary")


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``pairs`` (a < b) whose full sets reach the threshold; ``texts`` is (k, text)."""
    members = pairs.select(F.explode(F.array("a", "b")).alias("k"), "a", "b")
    laid = members.join(sets_of(members, texts, words), "k").select("a", "b", "k", "set").repartition("a", "b").sortWithinPartitions("a", "b", "k")
    return laid.mapInArrow(_judge(percent), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, label): the smallest node each one reaches.

    Every round takes the smallest label among neighbours and then the label's
    own label, so paths shorten by more than half; rounds end when nothing changes.
    """
    both = materialize(links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                                      F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e"))
                       .select("e.u", "e.v").distinct(), "links")
    labels = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("m"))
        low = (labels.join(near, labels["node"] == near["u"])
               .select("node", F.col("label").alias("old"), F.least("label", "m").alias("low")))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = materialize(low.join(jump, "low", "left").select("node", "old", F.least("low", F.coalesce("far", "low")).alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels


class Cell:
    """Members of a bucket, one block against another (or itself): which pairs are still open."""

    def __init__(self, pdf: pd.DataFrame, bound: int, percent: int):
        self.i, self.j, self.bucket = (int(pdf[c].iloc[0]) for c in ("i", "j", "bucket"))
        self.bound, self.percent = bound, percent
        pdf = pdf.sort_values(["rep", "set_key"])
        self.rep, self.key, self.label, self.n, self.part = (pdf[c].to_numpy().copy() for c in ("rep", "set_key", "label", "n", "part"))
        self.center = int(pdf["center"].iloc[0])
        self.sketch = np.array(pdf["sketch"].to_list(), dtype=np.int64).view(np.uint64).reshape(len(pdf), -1)
        self.bands = np.array(pdf["bands"].to_list(), dtype=np.int64).reshape(len(pdf), -1)
        self.left, self.right = np.flatnonzero(self.part == self.i), np.flatnonzero(self.part == self.j)

    def partners(self, x: int) -> np.ndarray:
        """Right members that member ``x`` may link with: other component, sizes and sketches allow
        the threshold, not judged in the star, and this is the first bucket the two share."""
        if self.rep[x] == self.center:
            return np.zeros(0, np.int64)
        r = self.right[self.right > x] if self.i == self.j else self.right
        n = self.n[r]
        r = r[(self.label[r] != self.label[x]) & (self.rep[r] != self.center)
              & (100 * np.minimum(n, self.n[x]) >= self.percent * np.maximum(n, self.n[x]))]
        if len(r):
            r = r[np.bitwise_count(self.sketch[r] ^ self.sketch[x]).sum(axis=1) <= self.bound]
        if len(r):
            shared = self.bands[r] == self.bands[x]
            r = r[self.bands[x][shared.argmax(axis=1)] == self.bucket]
        return r


def _flag(bound: int, percent: int):
    """The members of a cell that have an open pair there."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cell, used = Cell(pdf, bound, percent), np.zeros(len(pdf), bool)
        for x in cell.left:
            y = cell.partners(x)
            if len(y):
                used[x] = used[y] = True
        return pd.DataFrame({"bucket": cell.bucket, "i": cell.i, "j": cell.j, "set_key": cell.key[used]})
    return run


def _settle(bound: int, percent: int):
    """Judge the open pairs of a cell on full sets; members that link become one component at
    once, so only links that join two components come out (fewer than members)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rep", "set_key"]).reset_index(drop=True)
        cell, out = Cell(pdf, bound, percent), []
        sets = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum([len(x) for x in sets])
        own = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        mark = np.zeros(len(names), bool)
        for x in cell.left:
            mark[own[x]] = True
            for y in cell.partners(x):
                if cell.label[y] == cell.label[x]:
                    continue
                both = int(np.count_nonzero(mark[own[y]]))
                if 100 * both >= percent * (len(own[x]) + len(own[y]) - both):
                    out.append((min(cell.rep[x], cell.rep[y]), max(cell.rep[x], cell.rep[y])))
                    cell.label[cell.label == cell.label[y]] = cell.label[x]
            mark[own[x]] = False
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per row: doc_id, n_shingles, component_id, kept."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    texts = docs.select(key.alias("k"), text_of().alias("text"))
    signed = materialize(texts.mapInArrow(_signer(words, percent), "k long, n long, set_key binary, bands array<long>, sketch array<long>"), "near-signed")
    classes = materialize(signed.where("n > 0").groupBy("set_key").agg(
        F.min("k").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "near-classes")
    bound = xor_bound(percent, bands_for(percent) * ROWS)

    entries = classes.select("rep", "set_key", F.explode("bands").alias("bucket"))
    shared = materialize(entries.groupBy("bucket").agg(F.min("rep").alias("center"), F.max("rep").alias("last"))
                         .where("center < last").select("bucket", "center"), "near-buckets")
    met = materialize(entries.join(shared, "bucket"), "near-met")
    side = classes.select("rep", "n", "sketch")

    def side_of(p: str) -> DataFrame:
        return side.select(F.col("rep").alias(p), F.col("n").alias(f"n_{p}"), F.col("sketch").alias(f"sketch_{p}"))

    xor = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    star = (met.where("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
            .join(side_of("b"), "b").join(side_of("a"), "a")
            .where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (xor <= bound)).select("a", "b"))
    links = materialize(confirm(materialize(star, "near-star"), texts, words, percent), "near-links")
    labels = components(links)

    placed = (met.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
              .select("bucket", "center", "rep", "set_key", F.coalesce("label", "rep").alias("label")))
    open_buckets = (placed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"))
                    .where("lo < hi and size > 2")
                    .select("bucket", F.ceil(F.col("size") / F.lit(BLOCK_MEMBERS)).cast("int").alias("parts")))
    loose = (placed.join(open_buckets, "bucket").join(classes.select("set_key", "n", "sketch", "bands"), "set_key")
             .withColumn("part", F.pmod(F.xxhash64("set_key"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("bucket", "center", "rep", "set_key", "label", "n", "sketch", "bands", "part",
                     F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")))
    cell = ["bucket", "i", "j"]
    open_members = materialize(loose.groupBy(*cell).applyInPandas(_flag(bound, percent), "bucket long, i int, j int, set_key binary"), "near-open")
    owners = open_members.select("set_key").distinct().join(classes, "set_key").select(F.col("rep").alias("k"))
    sets = sets_of(owners, texts, words).select("set_key", "set").dropDuplicates(["set_key"])
    judged = loose.join(open_members, [*cell, "set_key"]).join(sets, "set_key")
    more = materialize(judged.groupBy(*cell).applyInPandas(_settle(bound, percent), "a long, b long"), "near-links")
    if not more.isEmpty():
        labels = components(links.unionAll(more))

    ends = (classes.select("set_key", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
            .select("set_key", F.coalesce("label", "rep").alias("component")))
    named = signed.select("k", "n", "set_key").join(ends, "set_key", "left").withColumn("component", F.coalesce("component", "k"))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return named.select(real("k").alias("doc_id"), F.col("n").alias("n_shingles"), real("component").alias("component_id"),
                        (F.col("k") == F.col("component")).alias("kept"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id WHERE r.root < l.b),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)"""
