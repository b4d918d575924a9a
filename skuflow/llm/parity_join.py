"""N-gram Jaccard join on parity sketches.

A document's set: the distinct runs of ``words`` consecutive words (ASCII
letters lower-cased, words split at ASCII white space), as 64-bit hashes; a
shorter text is one shingle; a text without words has none and links with
nothing. Two documents link when ``100 * |A & B| >= percent * |A | B|``, that
is, when their sets differ in at most ``differences(|A| + |B|)`` shingles.

1. Documents with equal sets are one class. Classes are dealt into size bands
   (edges grow by half); a class that may link with a larger one of the next
   band joins that band too, as a guest.
2. In a band that allows D differences, every shingle flips one bit of a sketch
   of D + 1 words of 64 bits. A shingle that only one of two sets holds changes
   one bit at most, so the Hamming distance of two sketches never exceeds the
   number of differing shingles, and two sets that link agree in one whole word
   at least (pigeonhole). Classes meet in buckets of (band, place of the word, word).
3. In every bucket each class is paired with the smallest resident (a star, never
   all pairs). Pairs whose sketches differ in too many bits are out; the others
   are verified on their full sets. Connected components of the links.
4. A bucket whose classes are all in one component is settled. In the others,
   classes of different components are compared by their sketches, block against
   block, each pair in the first word it agrees in; classes with an open pair
   bring their full sets to the block, where pairs are judged and joined at once.
   Only links that join components come out. Then components again.

The sketches only ever overestimate likeness and every verdict is taken on full
sets, so no link is lost and none is invented (but for equal 64-bit hashes of
different shingles).

Defined cases: null text counts as empty; a document without words is its own
component. Rows sharing an id (or without one) are documents of their own; a
null id sorts last and comes back null. Very long texts are one set like any
other. Other columns of ``docs`` are not read, so their names do not matter.
Empty table: no rows.

Scale: whole texts are read twice and never shuffled; what moves are the
sketches (about one byte a shingle), a bucket entry for each of their words, and
the sets of classes that have a candidate partner. Hot buckets meet only through
partial minima, joins that AQE can split, and blocks bounded by the bytes of
their members' sets; a hot centre's set goes once to each of its salted groups.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import table, text_of
from skuflow.llm.near_dup import Shingler, components
from skuflow.session import materialize

BAND_GROWTH = 1.5
BLOCK_BYTES = 8 << 20        # of full sets in one block of an open bucket
GROUP_BYTES = 16 << 20       # of full sets in one group around a centre
BROADCAST_IDS = 400_000      # 8 bytes each
NULL_ID = (1 << 63) - 1


def differences(sizes: int, percent: int) -> int:
    """Most shingles in which two sets of ``sizes`` shingles together may differ to link."""
    return sizes * (100 - percent) // (100 + percent)


class Bands:
    """Size bands and the number of sketch words of each."""

    def __init__(self, percent: int):
        self.percent, self.edges = percent, [1]
        self.growth = max(BAND_GROWTH, 100 / percent)

    def of(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(max(self.edges[-1] + 1, math.ceil(self.edges[-1] * self.growth)))
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def places(self, n: int) -> list[tuple[int, int]]:
        """(band, sketch words) as resident and, where a partner may live there, as guest of the next band."""
        own = self.of(n)
        self.of(self.edges[own + 1])
        out = []
        for band in (own, own + 1):
            allowed = differences(2 * (self.edges[band + 1] - 1), self.percent)
            fits = band == own or 100 * n >= self.percent * self.edges[band]
            out.append((band, allowed + 1 if allowed and fits else 0))
        return out


def sketch(shingles: np.ndarray, words: int) -> np.ndarray:
    """Parity of the shingles that fall on each of ``64 * words`` bits."""
    odd = np.bincount((shingles % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sketcher(words: int, percent: int):
    def run(batches):
        import pyarrow as pa
        import xxhash
        shingler, bands = Shingler(words), Bands(percent)
        longs = pa.list_(pa.int64())

        def rows(cols):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.int32(), longs, longs))],
                names=["k", "n", "set_key", "band", "resident", "guest"])
        for batch in batches:
            cols, held = [[] for _ in range(6)], 0
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingler(text.as_py())
                (band, own), (_, next_) = bands.places(len(s)) if len(s) else ((0, 0), (0, 0))
                row = (k, len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"", band,
                       sketch(s, own) if own else [], sketch(s, next_) if next_ else [])
                for c, v in zip(cols, row):
                    c.append(v)
                held += 8 * (own + next_) + 64
                if held > 8 << 20:
                    yield rows(cols)
                    cols, held = [[] for _ in range(6)], 0
            if cols[0]:
                yield rows(cols)
    return run


def _set_maker(words: int):
    def run(batches):
        import pyarrow as pa
        import xxhash
        shingler = Shingler(words)

        def rows(sets):
            return pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())],
                                              names=["set_key", "set"])
        for batch in batches:
            sets, held = [], 0
            for text in batch.column(0):
                sets.append(shingler(text.as_py()).tobytes())
                held += len(sets[-1])
                if held > 8 << 20:
                    yield rows(sets)
                    sets, held = [], 0
            if sets:
                yield rows(sets)
    return run


def sets_of(members: DataFrame, classes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(c, set) of the classes named in ``members`` (c), from the text of one document of each."""
    wanted = materialize(members.select("c").distinct().join(classes.select("c", "rep", "set_key"), "c"), "parity-wanted")
    ids, keys = wanted.select(F.col("rep").alias("k")).distinct(), wanted.select("c", "set_key")
    few = wanted.count() <= BROADCAST_IDS
    made = texts.join(F.broadcast(ids) if few else ids, "k", "left_semi").select("text").mapInArrow(_set_maker(words), "set_key binary, set binary")
    return made.join(F.broadcast(keys) if few else keys, "set_key").dropDuplicates(["c"]).select("c", "set")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _judge(percent: int):
    """Rows sorted by (a, salt, b): the centre's own set comes first (b null), then its partners'."""
    def run(batches):
        import pyarrow as pa
        center = None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for x, y, raw in zip(a, b, batch.column(2)):
                own = np.frombuffer(raw.as_py(), np.uint64)
                if y is None:
                    center = own
                elif linked(center, own, percent):
                    out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], names=["a", "b"])
    return run


def verify(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b, bytes of b's set) that link by their full sets; each a with its partners in salted groups."""
    sets = materialize(sets_of(pairs.select(F.explode(F.array("a", "b")).alias("c")), classes, texts, words), "parity-sets")
    groups = materialize(pairs.groupBy("a").agg(F.ceil(F.sum("bytes") / GROUP_BYTES).cast("int").alias("salts")), "parity-groups")
    salted = materialize(pairs.join(groups, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt")), "parity-salted")
    if salted.count() <= BROADCAST_IDS:                 # then the sets move once only, to their group
        salted, groups = F.broadcast(salted), F.broadcast(groups)
    partner = sets.withColumnRenamed("c", "b").join(salted, "b").select("a", "b", "set", "salt")
    center = (sets.withColumnRenamed("c", "a").join(groups, "a")
              .select("a", F.lit(None).cast("long").alias("b"), "set", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    laid = center.unionByName(partner).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return laid.select("a", "b", "set").mapInArrow(_judge(percent), "a long, b long")


class Cell:
    """Members of an open bucket, one block against another (or itself)."""

    def __init__(self, key: tuple, x: dict[str, np.ndarray], sets: list | None, percent: int):
        _, at, crowd = np.unique(x["label"], return_inverse=True, return_counts=True)
        order = np.lexsort((x["c"], at, crowd[at]))     # the largest component's members last
        self.spot, self.word, self.i, self.j = key
        self.percent, self.pos, self.center, self.sets = percent, self.spot & 0xFFFFFFFF, x["center"][0], sets and [sets[o] for o in order]
        self.c, self.label, self.n, self.resident, self.part, self.words = (x[k][order] for k in ("c", "label", "n", "resident", "part", "words"))
        self.left, self.right = np.flatnonzero(self.part == self.i), np.flatnonzero(self.part == self.j)
        if self.i == self.j:                            # the last component's members need no turn of their own
            self.left = self.left[self.label[self.left] != self.label[-1]]

    def partners(self, x: int) -> np.ndarray:
        """Right members that member ``x`` may link with: other component, one of the two a resident, sizes
        and sketches allow it, not judged in the star, and this word is the first in which the two agree."""
        if self.c[x] == self.center:
            return self.right[:0]
        r = self.right[np.searchsorted(self.right, x, side="right"):] if self.i == self.j else self.right
        n, own = self.n[r], self.n[x]
        r = r[(self.label[r] != self.label[x]) & (self.resident[r] | self.resident[x]) & (self.c[r] != self.center)
              & (100 * np.minimum(n, own) >= self.percent * np.maximum(n, own))]
        for at in range(0, self.pos, 4):                # most pairs agree in one of the first words already
            if not len(r):
                break
            r = r[~(self.words[r, at:min(at + 4, self.pos)] == self.words[x, at:min(at + 4, self.pos)]).any(axis=1)]
        if len(r):
            apart = np.bitwise_count(self.words[r] ^ self.words[x]).sum(axis=1, dtype=np.int64)
            r = r[apart <= (self.n[r] + own) * (100 - self.percent) // (100 + self.percent)]
        return r

    def open_members(self) -> np.ndarray:
        """The members that have an open pair here."""
        used = np.zeros(len(self.c), bool)
        for x in self.left:
            y = self.partners(x)
            if len(y):
                used[x] = used[y] = True
        return self.c[used]

    def joins(self) -> list[tuple[int, int]]:
        """Judge the open pairs on full sets; members that link become one component at once, so only
        links that join two components come out (fewer than members)."""
        out = []
        for x in self.left:
            for y in self.partners(x):
                if self.label[y] != self.label[x] and linked(self.sets[x], self.sets[y], self.percent):
                    out.append((self.c[x], self.c[y]))
                    self.label[self.label == self.label[y]] = self.label[x]
        return out


_CELL = ["spot", "word", "i", "j"]
_MEMBER = ["center", "c", "label", "n", "resident", "part"]


def _cells(batches, percent: int):
    """Rows sorted by cell -> the cells (`None` after each batch); a cell may go on in the next batch."""
    held: list[tuple[dict, list | None]] = []
    key = None

    def cell():
        x = {k: np.concatenate([h[0][k] for h in held]) for k in held[0][0]}
        return Cell(key, x, [s for h in held for s in h[1]] if held[0][1] is not None else None, percent)
    for batch in batches:
        cols = {name: batch.column(name) for name in batch.schema.names}
        keys = np.stack([cols[k].to_numpy(zero_copy_only=False).astype(np.int64) for k in _CELL])
        plain = {k: cols[k].to_numpy(zero_copy_only=False) for k in _MEMBER}
        ends, flat = cols["words"].offsets.to_numpy(), cols["words"].values.to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            own = tuple(keys[:, lo].tolist())
            if held and own != key:
                yield cell()
                held = []
            key = own
            x = {k: v[lo:hi] for k, v in plain.items()}
            x["words"] = flat[ends[lo]:ends[hi]].reshape(hi - lo, -1)
            held.append((x, [np.frombuffer(v.as_py(), np.uint64) for v in cols["set"][lo:hi]] if "set" in cols else None))
        held = [({k: v.copy() for k, v in x.items()}, sets) for x, sets in held]
        yield None
    if held:
        yield cell()


def _flag(percent: int):
    """The members of each cell that have an open pair there."""
    def run(batches):
        import pyarrow as pa

        def rows(out):
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(5)], names=[*_CELL, "c"])
        out = []
        for cell in _cells(batches, percent):
            if cell is not None:
                out += [(cell.spot, cell.word, cell.i, cell.j, c) for c in cell.open_members().tolist()]
            elif out:
                yield rows(out)
                out = []
        yield rows(out)
    return run


def _settle(percent: int):
    """The links that join components in each cell."""
    def run(batches):
        import pyarrow as pa
        out = [link for cell in _cells(batches, percent) if cell is not None for link in cell.joins()]
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(2)], names=["a", "b"])
    return run


def _apart(x: str, y: str):
    """Hamming distance of two sketches."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per row: doc_id, n_shingles, n_links (classes it links with, as far
    as they were needed to join its component), component_id (smallest doc_id reachable by links)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    texts = docs.select(key.alias("k"), text_of().alias("text"))
    rows = materialize(texts.mapInArrow(_sketcher(words, percent), "k long, n long, set_key binary, band int, resident array<long>, guest array<long>"), "parity-rows")
    classes = materialize(rows.where("n > 0").groupBy("set_key").agg(
        F.min("k").alias("rep"), *[F.first(c).alias(c) for c in ("n", "band", "resident", "guest")]).withColumn("c", F.monotonically_increasing_id()),
        "parity-classes")

    laid = classes.select("c", "n", F.explode(F.array(
        F.struct(F.lit(True).alias("resident"), F.col("band"), F.col("resident").alias("words")),
        F.struct(F.lit(False).alias("resident"), (F.col("band") + 1).alias("band"), F.col("guest").alias("words")))).alias("s")).select("c", "n", "s.*")
    spot = F.shiftleft(F.col("band").cast("long"), 32) + F.col("pos")
    entries = laid.select("c", "resident", "band", F.posexplode("words").alias("pos", "word")).select(
        spot.alias("spot"), "word", (2 * F.col("c") + F.col("resident").cast("int")).alias("who"))
    c, resident = F.shiftright("who", 1), F.col("who") % 2 == 1
    shared = (entries.groupBy("spot", "word").agg(F.min(F.when(resident, c)).alias("center"), F.count(F.lit(1)).alias("size"))
              .where("size > 1 and center is not null").select("spot", "word", "center"))
    met = materialize(entries.join(shared, ["spot", "word"]).select("spot", "word", "center", c.alias("c"), resident.alias("resident"))
                      .join(classes.select("c", "n"), "c").withColumn("band", F.shiftright("spot", 32).cast("int")), "parity-met")

    def side(p: str) -> DataFrame:
        return laid.select(F.col("c").alias(p), "band", F.col("n").alias(f"n_{p}"), F.col("words").alias(f"words_{p}"))

    star = (met.where("c <> center").select(F.col("center").alias("a"), F.col("c").alias("b"), "band").distinct()
            .join(side("b"), ["b", "band"]).join(side("a"), ["a", "band"])
            .where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                   & ((100 + percent) * _apart("words_a", "words_b") <= (100 - percent) * (F.col("n_a") + F.col("n_b"))))
            .select("a", "b", (8 * F.col("n_b")).alias("bytes")))
    links = materialize(verify(materialize(star, "parity-star"), classes, texts, words, percent), "parity-links")
    labels = components(links)

    placed = (met.join(labels.select(F.col("node").alias("c"), F.col("label")), "c", "left")
              .withColumn("label", F.coalesce("label", "c")))
    open_buckets = (placed.groupBy("spot", "word").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("held"))
                    .where("lo < hi and size > 2").select("spot", "word", F.ceil(8 * F.col("held") / block_bytes).alias("parts")))
    loose = (placed.join(open_buckets, ["spot", "word"]).join(laid.select("c", "band", "words"), ["c", "band"])
             .withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .select("spot", "word", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), *_MEMBER, "words"))

    def in_cells(members: DataFrame) -> DataFrame:
        return members.repartition(*_CELL).sortWithinPartitions(*_CELL)

    open_members = materialize(in_cells(loose).mapInArrow(_flag(percent), "spot long, word long, i long, j long, c long"), "parity-open")
    judged = loose.join(open_members, [*_CELL, "c"]).join(sets_of(open_members, classes, texts, words), "c")
    more = materialize(in_cells(judged).mapInArrow(_settle(percent), "a long, b long"), "parity-links")
    if not more.isEmpty():
        links = links.unionAll(more)
        labels = components(links)

    label = F.coalesce("label", "c")
    degrees = links.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n_links"))
    named = materialize(classes.select("c", "rep", "set_key").join(labels.withColumnRenamed("node", "c"), "c", "left").join(degrees, "c", "left")
                        .select("set_key", "rep", label.alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "parity-named")
    roots = named.groupBy("label").agg(F.min("rep").alias("component"))
    ends = named.join(roots, "label").select("set_key", "component", "n_links")
    out = rows.select("k", "n", "set_key").join(ends, "set_key", "left")
    real = lambda c: F.when(c != NULL_ID, c)
    return out.select(real(F.col("k")).alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      real(F.coalesce("component", "k")).alias("component_id"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE_OP11 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n + y.n AS total, count(*) AS c FROM flat x JOIN flat y ON x.sh = y.sh AND x.doc_id <> y.doc_id
    AND 10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n) GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 90 * (total - c)),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id WHERE reach.root < links.b)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""
