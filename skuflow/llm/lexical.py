"""Ranked lexical search: Block-Max MaxScore over an inverted index in shards.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond
ASCII; only A-Z are lower-cased. N documents have at least one term, L is the number
of all their terms, n of one document's, df the documents that hold a term, tf its
occurrences in the document:

    w     = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    m     = 100 - 75 + (75 n N) div L
    score = sum over the item's terms, repeats included, of w * ((10^9 tf) div (1000 tf + 8 m))

1. ``build_index``: one pass over the texts. A task packs its documents into shards of
   about ``SHARD_BYTES`` of text: a term table, and per term a posting list in blocks
   of ``BLOCK`` documents (gaps and counts in as few bytes as the block allows), each
   block with its first and last document, largest tf and smallest n.
2. N, L and the items' df are summed from the shards' heads (no postings are read).
3. ``search``: every task goes through its shards with one heap per item. Largest tf
   and smallest n bound what a block, and so a list, can give. Lists are opened by
   falling bound until the bounds of the rest together cannot reach the heap's last
   place: those opened are the essential lists, the rest can only raise documents
   already met. For each of the rest, a document is rejected if its score so far, the
   bound of the one block that may hold it and the bounds of the lists still to come
   stay below that place; only blocks that hold survivors are decompressed.
4. Heaps of all tasks are merged: 10 rows an item and task.

Bounds only ever overestimate and equal scores are kept, so results are exact.

Defined cases: null or empty texts and items have no terms: such documents are never
returned and not counted, such items have no rows. Rows that repeat a document id are
documents of their own; equal scores go by ascending doc_id, null ids last. Every row
of the items is a query of its own (with repeated or null item ids, too). Very long
texts are indexed whole. Other columns are not read. Empty tables: no rows.

Scale: texts are read once and never shuffled; the index (about a third of the text)
is written to the shared folder and read shard by shard, so a lost task is redone from
files. Items are taken in blocks of at most ``ITEMS`` rows or ``ITEM_CHARS`` characters,
which bounds what is sent to the tasks. The driver sees one block of items and its
terms' df. What is shuffled are the heaps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuflow.llm.common import table, text_of
from skuflow.session import materialize

SHARD_BYTES = 8 << 20
SHARD_DOCS = 1 << 15
BLOCK = 64
ITEMS = 1000
ITEM_CHARS = 4 << 20

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


# -- the index ---------------------------------------------------------------------------------------------------


def _packed(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bytes a value takes in each block (1, 2 or 4), and all blocks' bytes."""
    most = np.maximum.reduceat(values, starts)
    width = np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)).astype(np.uint8)
    each = np.repeat(width, np.diff(np.append(starts, len(values))))
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return width, raw[np.arange(4) < each[:, None]].tobytes()


class Shard:
    """Documents gathered until the shard is full."""

    def __init__(self):
        class Known(dict):
            def __missing__(self, term):
                self[term] = at = len(self)
                return at
        self.known, self.ids, self.nulls, self.lengths, self.terms, self.tf, self.held = Known(), [], [], [], [], [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        terms = terms_of(text)
        if not terms:
            return
        t, tf = np.unique(np.fromiter(map(self.known.__getitem__, terms), np.int32, len(terms)), return_counts=True)
        self.ids.append(doc_id or 0), self.nulls.append(doc_id is None), self.lengths.append(len(terms))
        self.terms.append(t), self.tf.append(tf)
        self.held += len(text)

    def full(self) -> bool:
        return self.held >= SHARD_BYTES or len(self.ids) >= SHARD_DOCS

    def packed(self) -> dict:
        lengths = np.array(self.lengths, np.int64)
        names = sorted(self.known)
        place = np.empty(len(names), np.int32)
        place[np.fromiter(map(self.known.__getitem__, names), np.int32, len(names))] = np.arange(len(names), dtype=np.int32)
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int64), [len(t) for t in self.terms])
        term, tf = place[np.concatenate(self.terms)], np.concatenate(self.tf)
        order = np.argsort(term, kind="stable")
        doc, tf, df = doc[order], tf[order], np.bincount(term, minlength=len(names))
        blocks = -(-df // BLOCK)                        # of each term
        list_at = np.concatenate(([0], np.cumsum(df)[:-1]))
        nth = np.arange(blocks.sum()) - np.repeat(np.concatenate(([0], np.cumsum(blocks)[:-1])), blocks)
        starts = np.repeat(list_at, blocks) + nth * BLOCK
        gaps = np.diff(doc, prepend=0)
        gaps[starts] = 0
        ends = np.append(starts[1:], len(doc)) - 1
        gap_width, gap_bytes = _packed(gaps, starts)
        tf_width, tf_bytes = _packed(tf, starts)
        return {"n_docs": len(self.ids), "n_terms": int(lengths.sum()), "terms": b"\n".join(names), "df": df.astype("<u4").tobytes(),
                "ids": np.array(self.ids, "<i8").tobytes(), "nulls": np.array(self.nulls, np.uint8).tobytes(), "lengths": lengths.astype("<i8").tobytes(),
                "first": doc[starts].astype("<u4").tobytes(), "last": doc[ends].astype("<u4").tobytes(),
                "max_tf": np.maximum.reduceat(tf, starts).astype("<u4").tobytes(), "min_n": np.minimum.reduceat(lengths[doc], starts).astype("<u4").tobytes(),
                "gap_width": gap_width.tobytes(), "tf_width": tf_width.tobytes(), "gaps": gap_bytes, "tfs": tf_bytes}


_HEAD = ["n_docs", "n_terms", "terms", "df"]
_BODY = ["ids", "nulls", "lengths", "first", "last", "max_tf", "min_n", "gap_width", "tf_width", "gaps", "tfs"]
INDEX_SCHEMA = ", ".join(f"{c} {'long' if c.startswith('n_') else 'binary'}" for c in _HEAD + _BODY)


def _indexer(batches):
    import pyarrow as pa

    def row(shard):
        x = shard.packed()
        return pa.RecordBatch.from_arrays([pa.array([x[c]], pa.int64() if c.startswith("n_") else pa.binary()) for c in _HEAD + _BODY], names=_HEAD + _BODY)
    shard = Shard()
    for batch in batches:
        for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard.add(k, text.as_py())
            if shard.full():
                yield row(shard)
                shard = Shard()
    if shard.ids:
        yield row(shard)


def build_index(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> one row a shard (see the module's text); store it before searching."""
    return docs.select(F.col("doc_id").cast("long").alias("k"), text_of().alias("text")).mapInArrow(_indexer, INDEX_SCHEMA)


# -- the search --------------------------------------------------------------------------------------------------


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Reader:
    """One shard, opened for a block of items."""

    def __init__(self, x: dict, wanted: dict[bytes, int], n_all: int, l_all: int):
        as_ = lambda c, kind: np.frombuffer(x[c], kind)
        self.ids, self.nulls = as_("ids", "<i8"), as_("nulls", np.uint8)
        self.m = 25 + 75 * as_("lengths", "<i8") * n_all // l_all
        self.first, self.last = as_("first", "<u4").astype(np.int64), as_("last", "<u4").astype(np.int64)
        self.block_gain = _gain(as_("max_tf", "<u4").astype(np.int64), 25 + 75 * as_("min_n", "<u4").astype(np.int64) * n_all // l_all)
        df = as_("df", "<u4").astype(np.int64)
        blocks = -(-df // BLOCK)
        block_end = np.cumsum(blocks)
        self.size = np.full(block_end[-1], BLOCK)
        self.size[block_end - 1] = df - (blocks - 1) * BLOCK
        self.gap_width, self.tf_width, self.gaps, self.tfs = as_("gap_width", np.uint8), as_("tf_width", np.uint8), x["gaps"], x["tfs"]
        self.gap_at = np.concatenate(([0], np.cumsum(self.size * self.gap_width)))
        self.tf_at = np.concatenate(([0], np.cumsum(self.size * self.tf_width)))
        # wanted term -> its blocks [from, to) and the largest gain of any
        self.lists = {}
        for i, term in enumerate(x["terms"].split(b"\n")):
            if term in wanted:
                lo, hi = int(block_end[i] - blocks[i]), int(block_end[i])
                self.lists[wanted[term]] = (lo, hi, int(self.block_gain[lo:hi].max()))
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and what each gives, decompressed when first asked for."""
        if b not in self.opened:
            n = int(self.size[b])
            gaps = np.frombuffer(self.gaps, f"<u{self.gap_width[b]}", n, int(self.gap_at[b]))
            tf = np.frombuffer(self.tfs, f"<u{self.tf_width[b]}", n, int(self.tf_at[b])).astype(np.int64)
            docs = self.first[b] + np.cumsum(gaps, dtype=np.int64)
            self.opened[b] = docs, _gain(tf, self.m[docs])
        return self.opened[b]

    def postings(self, blocks) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(int(b)) for b in blocks]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class Heap:
    """The k best documents of an item so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1      # rows: (-score, id is null, id); a score below least is out

    def put(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        if len(scores) > self.k:
            keep = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids, nulls = scores[keep], ids[keep], nulls[keep]
        self.rows = sorted(self.rows + [(-int(s), int(z), int(i)) for s, i, z in zip(scores, ids, nulls) if s >= self.least])[:self.k]
        if len(self.rows) == self.k:
            self.least = max(1, -self.rows[-1][0])


def _rank(shard: Reader, weights: list[tuple[int, int]], heap: Heap, stats: Counter) -> None:
    """Add the shard's best documents for an item (term, weight with repeats) to its heap."""
    lists = sorted((w * shard.lists[t][2], w, *shard.lists[t][:2]) for t, w in weights if t in shard.lists and w)
    bounds = np.cumsum([0] + [x[0] for x in lists])     # bounds[i]: of the i lists with the lowest bounds together
    i, least = len(lists), heap.least
    score = np.zeros(len(shard.ids), np.int64)
    # essential lists, by falling bound
    while i and bounds[i] >= least:
        i -= 1
        _, w, lo, hi = lists[i]
        docs, gain = shard.postings(range(lo, hi))
        score[docs] += w * gain
        stats["essential"] += hi - lo
        if bounds[i] >= least:                          # the k-th best score so far is a lower bound of the last place
            met = score[score > 0]
            if len(met) >= heap.k:
                least = max(least, int(np.partition(met, len(met) - heap.k)[len(met) - heap.k]))
    docs = np.flatnonzero(score)
    docs = docs[score[docs] + bounds[i] >= least]
    # the others raise documents already met
    while i and len(docs):
        i -= 1
        _, w, lo, hi = lists[i]
        at = lo + np.searchsorted(shard.last[lo:hi], docs)
        at[at == hi] = hi - 1
        held = (shard.first[at] <= docs) & (docs <= shard.last[at])
        most = np.where(held, w * shard.block_gain[at], 0)
        alive = score[docs] + most + bounds[i] >= least
        docs, held, at = docs[alive], held[alive], at[alive]
        blocks = np.unique(at[held])
        stats["skipped"] += hi - lo - len(blocks)
        if len(blocks):
            found, gain = shard.postings(blocks)
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            hit = docs[at] == found
            score[found[hit]] += w * gain[hit]
            stats["other"] += len(blocks)
    docs = docs[score[docs] >= least]
    heap.put(score[docs], shard.ids[docs], shard.nulls[docs])


def _searcher(items: list[tuple[int, list[tuple[int, int]]]], wanted: dict[bytes, int], n_all: int, l_all: int, k: int):
    def run(batches):
        import pyarrow as pa
        heaps, stats = [Heap(k) for _ in items], Counter()
        for batch in batches:
            for r in range(batch.num_rows):
                x = {c: batch.column(i)[r].as_py() for i, c in enumerate(_HEAD + _BODY)}
                shard = Reader(x, wanted, n_all, l_all)
                for (_, weights), heap in zip(items, heaps):
                    _rank(shard, weights, heap, stats)
        rows = [(q, -s, None if z else d) for (q, _), h in zip(items, heaps) for s, z, d in h.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["q", "score", "doc_id"])
    return run


def _df_counter(wanted: dict[bytes, int]):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for terms, df in zip(batch.column(0), batch.column(1)):
                df = np.frombuffer(df.as_py(), "<u4")
                found = [(wanted[t], int(df[i])) for i, t in enumerate(terms.as_py().split(b"\n")) if t in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(2)], names=["t", "df"])
    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    block, chars = [], 0
    for q, text in items.select("q", "text").toLocalIterator():
        block.append((q, Counter(terms_of(text))))
        chars += len(text)
        if len(block) >= ITEMS or chars >= ITEM_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def weight(n_all: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1)))


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of a stored ``index`` for every row of ``items`` (item_id, text):
    item_id, rank, doc_id, score."""
    queries = materialize(items.select("item_id", text_of().alias("text")).withColumn("q", F.monotonically_increasing_id()), "lexical-items")
    n_all, l_all = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    found = None
    for block in _blocks(queries):
        wanted = {t: i for i, t in enumerate(sorted({t for _, c in block for t in c}))}
        counted = index.select("terms", "df").mapInArrow(_df_counter(wanted), "t long, df long").groupBy("t").agg(F.sum("df").alias("df"))
        w = {r["t"]: weight(n_all, r["df"]) for r in counted.collect()}      # at most the block's terms
        asked = [(q, [(wanted[t], r * w[wanted[t]]) for t, r in c.items() if wanted[t] in w]) for q, c in block]
        part = index.mapInArrow(_searcher(asked, wanted, n_all, max(l_all, 1), k), "q long, score long, doc_id long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = items.sparkSession.createDataFrame([], "q long, score long, doc_id long")
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .join(queries.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = materialize(build_index(table(spark, sf_dir, "documents")), "lexical-index")
    return search(index, table(spark, sf_dir, "benchmark"))


ORACLE_OP13 = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
docs AS (SELECT doc_id, ts, len(ts) AS n FROM split WHERE len(ts) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM docs),
asked AS (
  SELECT item_id, term, count(*) AS r FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM docs) SEMI JOIN (SELECT DISTINCT term FROM asked) USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total),
scored AS (
  SELECT item_id, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), total GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10"""
