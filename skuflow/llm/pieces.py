"""SentencePiece encoding and decoding over a relational lattice.

The piece table (piece, score, id) comes from a SentencePiece model file with
the identity normaliser: spaces become U+2581, one is put in front of a text
that is not empty. A text's encoding is the path of highest total score over
pieces; a character without a piece of its own costs less than the lowest
score by 10 and is written as its UTF-8 bytes (byte fallback). Equal scores:
the longer last piece wins. This is the library's unigram search; on a model
trained as BPE (whose scores are negative merge ranks) it is the best path
under these scores, not the sequence of merges.

1. Texts are cut into words that no piece crosses (checked against the
   table): U+2581 only begins a word, and line ends and every pair of
   neighbours that no piece holds separate. A task cuts each text once, in
   groups of ``GROUP_CHARS``: the group's distinct words go to their buckets,
   its texts stay behind as numbers into them, with a digest of each text.
2. The distinct words of a bucket are exploded into substrings (bounded at
   each place by the longest piece that starts there), equi-joined with the
   piece table (its size is the model file's, so it is broadcast), grouped by
   word again, and folded by end position with Spark's `aggregate`: the state
   keeps the best scores of the last positions and the chosen edge of each
   one; a second fold walks back.
3. Each group gets the ids of its words back, in the order it sent them, and
   writes its texts' ids. Every text is decoded again from the ids that are
   returned and held against its digest (`round_trip`).

Decoding joins the pieces of the ids, turns runs of byte pieces into
characters (damaged runs into U+FFFD) and drops the leading space.

Defined cases: null or empty text: no ids, decoded as empty. A text that
itself holds U+2581 decodes with a space there, as in the library. The fold
of a word keeps all its positions, so a word of 20,000 characters takes 14 s;
repeated rows stay separate. Empty table: none.

Scale: texts are read and cut once and never move; what moves are packed word
sets and word numbers (a packed row holds one word at least, so there are never
more rows than pairs of group and word); lattice rows never leave the task that
explodes them. A group's numbers must mean the same when a task is run again, so
`encode` stores texts first unless they come straight from files.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import partitions_for, table, text_of
from skuflow.session import materialize

SPACE = "▁"
LONG = 64
UNKNOWN_PENALTY = 10.0
BUCKET_BYTES = 4 << 20   # of stored input for each bucket of words
GROUP_CHARS = 4 << 20    # of text; a group's texts, words and numbers are in memory at once
SLICE = 1 << 20          # characters that are cut at a time


class Pieces:
    """The normal pieces of a model file, and what its texts may be cut at."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        usable = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.rows = [(sp.id_to_piece(i), float(sp.get_score(i)), i) for i in usable]
        self.names = [sp.id_to_piece(i) if not (sp.is_control(i) or sp.is_unknown(i)) else "" for i in range(n)]
        self.bytes = {i: int(sp.id_to_piece(i)[3:5], 16) for i in range(n) if sp.is_byte(i)}
        self.byte_ids = [0] * 256
        for i, b in self.bytes.items():
            self.byte_ids[b] = i
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in self.rows) or any("\n" in p or " " in p for p, _, _ in self.rows):
            raise ValueError("a piece crosses the places where texts are cut")
        self.longest = max(len(p) for p, _, _ in self.rows)
        self.unknown = min(s for _, s, _ in self.rows) - UNKNOWN_PENALTY
        self.spelt = [bytes([self.bytes[i]]) if i in self.bytes else name.encode() for i, name in enumerate(self.names)]
        self.trie = Trie([p for p, _, _ in self.rows])


class Trie:
    """The pieces as numbers: letters (characters that a piece holds beside another), pairs of neighbours and the tree
    of beginnings, whose nodes are numbered by letter for one character and from there on for more."""

    def __init__(self, pieces: list[str]):
        whole = {p for p in pieces if len(p) > 1}
        letters = sorted({c for p in whole for c in p})
        node, base = {c: i for i, c in enumerate(letters, 1)}, len(letters) + 1
        pairs = {p[i:i + 2] for p in whole for i in range(len(p) - 1)}
        heads = sorted({p[:i] for p in whole for i in range(2, len(p) + 1)}, key=lambda h: (len(h), h))
        tree = []
        for h in heads:
            tree.append((node[h[:-1]] * base + node[h[-1]], len(node) + 1, h in whole))
            node[h] = len(node) + 1
        tree.sort()
        self.letters = np.array([ord(c) for c in letters], np.int64)
        self.pairs = np.array([node[p[0]] * base + node[p[1]] for p in sorted(pairs)], np.int64)
        self.keys, self.nodes = np.array([t[0] for t in tree], np.int64), np.array([t[1] for t in tree], np.int64)
        self.whole = np.array([t[2] for t in tree], bool)


CHUNK = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


def chunks_of(text: str) -> list[str]:
    """Chunks of a text: spaces and what follows them, spaces alone, and line ends. With `cut_chunk` the plain form
    of the cut that `Cutter` makes for many texts at once, since no pair of neighbours in a piece lies over two chunks."""
    if not text:
        return []
    if SPACE in text or "  " in text or text[0] == " ":
        return CHUNK.findall(SPACE + text.replace(" ", SPACE))
    # single spaces only: every space begins a chunk, so splitting does
    return list(filter(None, (SPACE + text.replace(" ", " " + SPACE)).replace("\n", " \n ").split(" ")))


def cut_chunk(chunk: str, pairs: frozenset) -> list[str]:
    """The words of a chunk (spaces and what follows them, spaces alone, or a line end)."""
    at = [i + 1 for i in range(len(chunk) - 1) if chunk[i:i + 2] not in pairs]
    return [chunk[a:b] for a, b in zip([0, *at], [*at, len(chunk)])] if at else [chunk]


def _press(obj) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(obj, protocol=5))


def _expand(blob: bytes):
    import zstandard
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers with their bytes sorted by place, which packs better."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of all pieces (start, size), one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _strings(sizes: np.ndarray, data: bytes):
    """An Arrow array of the strings that lie in ``data``, one after the other."""
    import pyarrow as pa
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data))


def _laid_out(strings) -> tuple[np.ndarray, memoryview]:
    """Where each string of an Arrow array (with 64-bit offsets) begins and the last one ends, and the bytes."""
    _, ends, data = strings.buffers()
    return np.frombuffer(ends, np.int64)[strings.offset:strings.offset + len(strings) + 1], memoryview(data or b"")


def _digest(text: bytes) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(text)


class Cutter:
    """Cuts texts where no piece lies over two neighbours, and bounds the pieces of words."""

    def __init__(self, trie: Trie):
        self.base = len(trie.letters) + 1
        self.number = np.zeros(0x110000, np.int32)
        self.number[trie.letters] = np.arange(1, self.base)
        self.joined = np.zeros(self.base * self.base, bool)
        self.joined[trie.pairs] = True
        self.trie = trie

    def letters(self, text: str) -> np.ndarray:
        return self.number[np.frombuffer(text.encode("utf-32-le"), "<u4")]

    def words(self, texts: list[str]) -> tuple:
        """All words of ``texts`` in order, as an Arrow array, and how many each text has."""
        joined = "".join([SPACE + t.replace(" ", SPACE) for t in texts if t])
        sizes = np.array([len(t) + bool(t) for t in texts], np.int64)
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        new = np.ones(len(joined), bool)
        for a in range(0, len(joined), SLICE):
            n = self.letters(joined[max(a - 1, 0):a + SLICE])
            new[max(a, 1):a + SLICE] = ~self.joined[n[:-1] * self.base + n[1:]]
        new[first] = True
        data = np.frombuffer(joined.encode(), np.uint8)
        begins = np.zeros(len(data), bool)
        begins[(data & 0xC0) != 0x80] = new       # at a character's first byte
        begins = np.flatnonzero(begins)
        counts = np.zeros(len(texts), np.int64)
        counts[sizes > 0] = np.add.reduceat(new, first, dtype=np.int64) if len(first) else 0
        return _strings(np.diff(begins, append=len(data)), data), counts

    def bounds(self, words: list[str]) -> list[str]:
        """For each place of each word, the length of the longest piece that starts there (at least one
        character), as characters: "a" for 1, "b" for 2, ..."""
        sizes = np.array([len(w) for w in words], np.int64)
        n, trie = self.letters("".join(words)), self.trie
        end, reach = np.repeat(np.cumsum(sizes), sizes), np.full(len(n), 97, "<u4")
        at, node, m = np.arange(len(n)), n.astype(np.int64), 1
        while len(at):
            live = (node > 0) & (at + m < end[at])
            at, node = at[live], node[live]
            key = node * self.base + n[at + m]
            to = np.minimum(np.searchsorted(trie.keys, key), len(trie.keys) - 1)
            live = trie.keys[to] == key
            at, to, m = at[live], to[live], m + 1
            node = trie.nodes[to]
            reach[at[trie.whole[to]]] = 96 + m
        reach, ends = reach.tobytes().decode("utf-32-le"), np.cumsum(sizes).tolist()
        return [reach[a:b] for a, b in zip([0, *ends], ends)]


class Group:
    """Texts of one task as numbers into their distinct words."""

    def __init__(self):
        self.ids, self.texts, self.held = [], [], 0

    def add(self, doc_id, text: str) -> None:
        self.ids.append(doc_id)
        self.texts.append(text)
        self.held += len(text)

    def packed(self, cutter: Cutter, buckets: int) -> tuple[dict[int, bytes], bytes]:
        """Words by bucket, and the texts: numbers of words in the order of buckets and words, and what they decode to."""
        import pyarrow.compute as pc
        import xxhash
        words, counts = cutter.words(self.texts)
        coded = words.dictionary_encode()
        numbers, words = coded.indices.to_numpy(), coded.dictionary
        bucket = np.array([xxhash.xxh3_64_intdigest(w) % buckets for w in words.cast("large_binary").to_pylist()], np.int64)
        order = pc.sort_indices(words).to_numpy()
        order = order[np.argsort(bucket[order], kind="stable")]
        words, bucket = words.take(order), bucket[order]
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order))
        (ends, data), by = _laid_out(words), {}
        for b, lo, hi in _runs(bucket):
            by[b] = _press((np.diff(ends[lo:hi + 1]).astype("<u4").tobytes(), bytes(data[ends[lo]:ends[hi]])))
        digests = b"".join([_digest(t.replace(SPACE, " ").encode()) for t in self.texts])
        return by, _press((self.ids, counts, _planes(number[numbers]), digests))


def _runs(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(key, from, to) of each run of equal keys."""
    cuts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1, append=keys[-1] + 1)) if len(keys) else np.zeros(1, int)
    return [(int(keys[a]), int(a), int(b)) for a, b in zip(cuts, cuts[1:])]


def _cutter(trie: Trie, buckets: int):
    """Texts -> packed words (dest: their bucket) and packed texts (dest: below 0, one for each group)."""
    def run(batches):
        import pyarrow as pa
        cutter, group, part, serial = Cutter(trie), Group(), TaskContext.get().partitionId(), 0

        def rows():
            words, texts = group.packed(cutter, buckets)
            dest = -1 - (part << 32 | serial)
            return pa.RecordBatch.from_arrays(
                [pa.array([*words, dest], pa.int64()), pa.array([dest] * (len(words) + 1), pa.int64()), pa.array([*words.values(), texts], pa.binary())],
                names=["dest", "home", "blob"])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                group.add(doc_id, text.as_py())
                if group.held >= GROUP_CHARS:
                    yield rows()
                    group, serial = Group(), serial + 1
        if group.ids:
            yield rows()
    return run


def _sets(rows) -> tuple:
    """Packed sets of words of one bucket -> all their words, how many each set has, and the distinct ones in order."""
    import pyarrow.compute as pc
    sets = [_expand(b) for b in rows.column("blob").to_pylist()]
    sizes = [np.frombuffer(n, "<u4") for n, _ in sets]
    words = _strings(np.concatenate(sizes), b"".join([data for _, data in sets]))
    known = pc.unique(words)
    return words, [len(n) for n in sizes], known.take(pc.sort_indices(known))


def _distinct(trie: Trie):
    """The distinct words of a bucket (nothing for packed texts), numbered by bucket and place."""
    def run(rows):
        import pyarrow as pa
        if not _is_bucket(rows):
            return pa.schema([("wid", pa.int64()), ("word", pa.string()), ("reach", pa.string())]).empty_table()
        words, bucket = _sets(rows)[2], rows.column("dest")[0].as_py()
        return pa.table({"wid": (bucket << 32) + np.arange(len(words)), "word": words.cast("string"),
                         "reach": pa.array(Cutter(trie).bounds(words.to_pylist()), pa.string())})
    return run


def _is_bucket(rows) -> bool:
    return len(rows) > 0 and rows.column("dest")[0].as_py() >= 0


def lattice(words: DataFrame, table_rows: DataFrame, longest: int, unknown: float) -> DataFrame:
    """``words`` (wid, word, reach) -> the edges: wid, end, len, score, id (an unknown character has id ``-1 - code point``)."""
    chunks = words.select("wid", "word", "reach", F.explode(F.sequence(F.lit(0), F.length("reach") - 1, F.lit(LONG))).alias("at"))
    chunks = chunks.select("wid", "at", F.substring("reach", F.col("at") + 1, F.lit(LONG)).alias("reach"),
                           F.substring("word", F.col("at") + 1, F.lit(LONG + longest - 1)).alias("part"))
    places = chunks.select("wid", "at", "reach", "part", F.explode(F.sequence(F.lit(1), F.length("reach"))).alias("i"))
    places = places.select("wid", (F.col("at") + F.col("i") - 1).alias("at"), F.substring("part", F.col("i"), F.lit(longest)).alias("part"),
                           (F.ascii(F.substring("reach", F.col("i"), F.lit(1))) - 96).alias("most"))
    spans = places.select("wid", "at", "part", F.explode(F.sequence(F.lit(1), "most")).alias("len"))
    rows = spans.select("wid", (F.col("at") + F.col("len")).alias("end"), "len", F.substring("part", F.lit(1), F.col("len")).alias("piece"))
    # the piece table is as large as the model file's vocabulary
    met = rows.join(F.broadcast(table_rows), "piece", "left").where(F.col("id").isNotNull() | (F.col("len") == 1))
    return met.select("wid", "end", "len", F.coalesce("score", F.lit(unknown)).alias("score"),
                      F.coalesce("id", -1 - F.ascii("piece")).alias("id"))


def best_path(edges: Column) -> Column:
    """Ids of the best path through ``edges``, an array of (end, less, score, id), less being
    minus the length, in which every position ends an edge; sorted here, longer edges first."""
    node = "struct<score:double,len:int,id:int>"
    # end, best: the position being filled and its best edge so far; done: the positions before it, nearest first
    state = F.struct(F.lit(0).alias("end"), F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("len"), F.lit(0).alias("id")).cast(node).alias("best"),
                     F.array().cast(f"array<{node}>").alias("done"))

    def reached(before, e):
        return F.struct((before + e["score"]).alias("score"), (-e["less"]).alias("len"), e["id"].alias("id"))

    def step(a, e):
        # the first edge to a new end: the end before it joins ``done``
        before = F.when(e["less"] == -1, a["best"]["score"]).otherwise(F.get(a["done"], -e["less"] - 2)["score"])
        onward = F.struct(e["end"].alias("end"), reached(before, e).alias("best"), F.array_prepend(a["done"], a["best"]).alias("done"))
        near = F.get(a["done"], -e["less"] - 1)["score"]
        better = F.struct(a["end"].alias("end"), reached(near, e).alias("best"), a["done"].alias("done"))
        return F.when(e["end"] > a["end"], onward).when(near + e["score"] > a["best"]["score"], better).otherwise(a)

    # all positions, the last one first; the start, of length 0, is the last to be walked over
    nodes = F.aggregate(F.sort_array(edges), state, step, lambda a: F.array_prepend(a["done"], a["best"]))
    back = F.struct(F.lit(0).alias("skip"), F.array().cast("array<int>").alias("ids"))
    return F.aggregate(nodes, back, lambda a, p: F.when(
        a["skip"] > 0, F.struct((a["skip"] - 1).alias("skip"), a["ids"].alias("ids"))).when(p["len"] == 0, a).otherwise(
        F.struct((p["len"] - 1).alias("skip"), F.array_prepend(a["ids"], p["id"]).alias("ids"))), lambda a: a["ids"])


def _give_back(byte_ids: list[int]):
    """For each group, the ids of its words of a bucket, in the order of its words. An unknown character is written
    as its bytes."""
    def run(rows, coded):
        import pyarrow as pa
        import pyarrow.compute as pc
        if not _is_bucket(rows):
            return pa.schema([("dest", pa.int64()), ("bucket", pa.int64()), ("coded", pa.binary())]).empty_table()
        words, counts, known = _sets(rows)
        coded = coded.sort_by("wid").combine_chunks()       # one row for each of the words known, in their order
        if len(coded) != len(known):
            raise ValueError("a word has no path")
        paths = coded.column("ids").combine_chunks()
        ids, starts = _written(paths.flatten().to_numpy(), np.diff(paths.offsets.to_numpy()), byte_ids)
        sizes, at = np.diff(starts), pc.index_in(words, value_set=known).to_numpy()
        out, lo = [], 0
        for n in counts:
            own = at[lo:lo + n]
            out.append(_press((_planes(sizes[own]), _planes(ids[_ragged(starts[own], sizes[own])]))))
            lo += n
        return pa.table({"dest": rows.column("home"), "bucket": rows.column("dest"), "coded": pa.array(out, pa.binary())})
    return run


def _written(ids: np.ndarray, sizes: np.ndarray, byte_ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Paths (their ids and lengths) with unknown characters as their bytes, and where each path begins and the last ends."""
    width = np.ones(len(ids), np.int64)
    odd = np.flatnonzero(ids < 0)
    spelt = [chr(-1 - x).encode() for x in ids[odd].tolist()]
    width[odd] = [len(b) for b in spelt]
    through = np.concatenate(([0], np.cumsum(width)))
    out = np.repeat(ids, width)
    out[_ragged(through[odd], width[odd])] = [byte_ids[b] for b in b"".join(spelt)]
    return out, through[np.concatenate(([0], np.cumsum(sizes)))]


def _write(names: list[bytes]):
    """A group's texts and the ids of its words -> its texts' ids, which are decoded again and held against the texts."""
    def run(texts, coded):
        import pyarrow as pa
        if not len(texts) or _is_bucket(texts):
            return pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())]).empty_table()
        none = np.zeros(0, np.int32)
        back = [_expand(b) for b in coded.sort_by("bucket").column("coded").to_pylist()]
        sizes = np.concatenate([none, *[_from_planes(n) for n, _ in back]]).astype(np.int64)
        ids = np.concatenate([none, *[_from_planes(x) for _, x in back]])
        doc_ids, counts, numbers, digests = _expand(texts.column("blob")[0].as_py())
        numbers, starts = _from_planes(numbers), np.cumsum(sizes) - sizes
        long = sizes[numbers]
        through = np.concatenate(([0], np.cumsum(long)))[np.concatenate(([0], np.cumsum(counts)))]
        ids = ids[_ragged(starts[numbers], long)]
        kept = [same_text(t, digests[16 * i:16 * i + 16]) for i, t in enumerate(spelled(ids, through, names))]
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_pieces": pa.array(np.diff(through)),
                         "ids": pa.ListArray.from_arrays(pa.array(through, pa.int32()), pa.array(ids, pa.int32())), "round_trip": pa.array(kept, pa.bool_())})
    return run


def spelled(ids: np.ndarray, ends: np.ndarray, names: list[bytes]):
    """The bytes that the ids of each text (from ``ends[i]`` to ``ends[i + 1]``) stand for, without the leading space."""
    import pyarrow as pa
    at, data = _laid_out(pa.array(names, pa.large_binary()).take(pa.array(ids)))
    lead = SPACE.encode()
    for lo, hi in zip(at[ends[:-1]].tolist(), at[ends[1:]].tolist()):
        text = bytes(data[lo:hi]).replace(lead, b" ")
        yield text[1:] if text[:1] == b" " else text


def same_text(spelt: bytes, digest: bytes) -> bool:
    """Whether the bytes of a text's ids decode to the text with this digest; damaged runs decode to U+FFFD."""
    return _digest(spelt) == digest or _digest(spelt.decode("utf-8", "replace").encode()) == digest


def decode_ids(ids: list[int], names: list[str], bytes_of: dict[int, int], special: frozenset | None = None) -> str:
    if (special if special is not None else frozenset(bytes_of)).isdisjoint(ids):
        text = "".join([names[i] for i in ids])
    else:
        out, run = [], bytearray()
        for i in ids:
            if i in bytes_of:
                run.append(bytes_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(names[i])
        out.append(run.decode("utf-8", "replace"))
        text = "".join(out)
    text = text.replace(SPACE, " ")
    return text[1:] if text[:1] == " " else text


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per row: doc_id, n_pieces, ids, round_trip (the ids decode to the text again)."""
    spark, pieces, buckets = docs.sparkSession, Pieces(model_path), partitions_for(docs, BUCKET_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    if re.search(r"^[\s:+|-]*(?!Project|Filter|Relation)\w", rows._jdf.queryExecution().optimizedPlan().toString(), re.M):
        rows = materialize(rows, "pieces-texts")
    sent = rows.mapInArrow(_cutter(pieces.trie, buckets), "dest long, home long, blob binary")
    words = sent.groupBy("dest").applyInArrow(_distinct(pieces.trie), "wid long, word string, reach string").repartition(buckets, "wid")
    table_rows = spark.createDataFrame(pieces.rows, "piece string, score double, id int")
    edges = lattice(words, table_rows, pieces.longest, pieces.unknown)
    coded = edges.groupBy("wid").agg(F.collect_list(F.struct("end", (-F.col("len")).alias("less"), "score", "id")).alias("edges")).select(
        "wid", F.shiftright("wid", 32).alias("bucket"), best_path(F.col("edges")).alias("ids"))
    back = sent.groupBy("dest").cogroup(coded.groupBy("bucket")).applyInArrow(_give_back(pieces.byte_ids), "dest long, bucket long, coded binary")
    return sent.groupBy("dest").cogroup(back.groupBy("dest")).applyInArrow(_write(pieces.spelt), "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def decode(coded: DataFrame, model_path: str) -> DataFrame:
    """``coded`` (doc_id, ids) -> (doc_id, text)."""
    pieces = Pieces(model_path)
    names, bytes_of = pieces.names, pieces.bytes

    def run(it):
        for pdf in it:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [decode_ids([] if x is None else list(x), names, bytes_of) for x in pdf["ids"]]})
    return coded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
