"""Token ids as length-delimited binary records with a separate offset index.

One frame per document, documents in ascending doc_id order (null ids first,
equal ids by text), one file per sorted partition::

    u32  payload length            (all integers little-endian)
    u32  masked crc32 of those four bytes
    ...  payload
    u32  masked crc32 of the payload
    0x0A end of frame

    payload: u8 flags (1: the id is null), i64 doc_id, u8 bytes per id (2 or 4), the ids

The mask is ``rotate_right(crc, 15) + 0xA282EAD8`` so that a checksum stored
inside checksummed data keeps its strength. Files are written by Spark's text
writer (a frame is one "line", whose line end is the frame's last byte), so a
lost executor leaves no partial file behind and any Hadoop store will do.
They are read with the ``binaryFile`` source; every checksum is verified.

Text -> ids: the ``tokenizers`` library encodes each distinct chunk between
spaces, tabs and line ends once per worker (a bounded table that outlives the
task; what it cannot hold is encoded each time); a text's ids are its chunks' ids joined. That equals encoding the whole
text because this vocabulary's pre-tokenizer drops white space and no piece or
composition crosses it (tested). Texts are taken whole.

Defined cases: null or empty text: only the end id. Repeated rows: a record
each. No documents: no records.

Scale: one shuffle of (doc_id, text) by ranges of doc_id, whose partitions
follow the input size; ids are stored in two bytes while the vocabulary
allows, so files stay near half of the text. A worker holds one Arrow batch
and the bounded chunk table.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skuflow.llm.common import partitions_for, table, text_of, worker_store
from skuflow.session import ensure_checkpoint_dir

END_ID = 1
CACHE_CHUNKS = 800_000
LONGEST_CACHED = 64
TYPECODES = {2: "H", 4: "I"}  # native order, which is little-endian wherever this runs
_HEAD = "<II"  # length, its checksum
_ROW = "<BqB"  # flags, doc_id, bytes per id


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """A frame but for its last byte, which the writer's line end adds."""
    payload = struct.pack(_ROW, doc_id is None, doc_id or 0, width) + ids
    size = struct.pack("<I", len(payload))
    return b"".join((size, struct.pack("<I", masked(zlib.crc32(size))), payload,
                     struct.pack("<I", masked(zlib.crc32(payload)))))


def frames(data: bytes | memoryview) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, doc_id, ids as uint32) of each frame; raises on any damage."""
    data, at = memoryview(data), 0
    while at < len(data):
        size, crc = struct.unpack_from(_HEAD, data, at)
        end = at + 8 + size + 5
        if masked(zlib.crc32(data[at:at + 4])) != crc or end > len(data):
            raise ValueError(f"damaged record length at byte {at}")
        payload = data[at + 8:at + 8 + size]
        if masked(zlib.crc32(payload)) != struct.unpack_from("<I", data, at + 8 + size)[0] or data[end - 1] != 10:
            raise ValueError(f"damaged record at byte {at}")
        null, doc_id, width = struct.unpack_from(_ROW, payload)
        ids = np.frombuffer(payload[struct.calcsize(_ROW):], dtype="<u2" if width == 2 else "<u4")
        yield at, end - at, None if null else doc_id, ids.astype("<u4")
        at = end


class ChunkIds(dict):
    """Chunk of text without white space -> bytes of its ids; filled on demand, up to ``CACHE_CHUNKS`` chunks.

    A chunk of letters below U+0250 (which no normalisation but lower-casing
    changes) is one pre-token, so it goes to the library's BPE model at once;
    a punctuation mark behind such a letter is a pre-token of its own. All
    other chunks take the library's whole path.
    """

    def __init__(self, path: str, width: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tok, self.width = Tokenizer.from_file(path), width
        self.model = self.tok.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x250) if chr(c).isalpha()}

    def _bytes(self, ids) -> bytes:
        return array(TYPECODES[self.width], ids).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        plain = len(chunk) > 0 and max(chunk) < "\u0250" and "\u0130" not in chunk
        if plain and len(chunk) > 1 and chunk[-1] in ".,;:!?" and chunk[-2].isalpha():
            out = self[chunk[:-1]] + self[chunk[-1]]
        elif plain and chunk.isalpha():
            low = chunk.lower()
            if low != chunk:
                out = self[low]
            else:
                word = low if low.isascii() else low.translate(self.letters)
                out = self._bytes([t.id for t in self.model.tokenize(word)])
        else:
            out = self._bytes(self.tok.encode(chunk, add_special_tokens=False).ids)
        if len(self) < CACHE_CHUNKS and len(chunk) <= LONGEST_CACHED:
            self[chunk] = out
        return out

    def encode(self, text: str) -> bytes:
        chunks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, chunks))


def _framer(path: str, width: int, end_id: int):
    end = end_id.to_bytes(width, "little")

    def run(batches):
        store = worker_store()
        if ("chunks", path, width) not in store:
            store["chunks", path, width] = ChunkIds(path, width)
        known = store["chunks", path, width]
        for batch in batches:
            ids, out, held = batch.column(0).to_pylist(), [], 0
            for doc_id, text in zip(ids, batch.column(1)):
                out.append(frame(doc_id, known.encode(text.as_py()) + end, width))
                held += len(out[-1])
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
    return run


def write_records(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = END_ID) -> str:
    """Encode ``docs`` (doc_id, text) and write the record files to ``out_dir``."""
    from tokenizers import Tokenizer
    width = 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ordered = slim.repartitionByRange(partitions_for(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    framed = ordered.mapInArrow(_framer(tokenizer_path, width, end_id), "frame binary")
    framed.select(F.col("frame").cast("string").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(out_dir)
    return out_dir


def _parse(it):
    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows, start = [], 0
            for at, size, doc_id, ids in frames(content):
                rows.append((doc_id, at, size, start, len(ids), zlib.crc32(ids.tobytes())))
                start += len(ids)
            out = pd.DataFrame(rows, columns=["doc_id", "offset", "length", "local_start", "n_tokens", "ids_crc32"])
            out["doc_id"] = pd.array([r[0] for r in rows], dtype="Int64")
            out.insert(0, "file", path)
            yield out


def read_index(spark: SparkSession, record_dir: str) -> DataFrame:
    """Scan the record files, verify them, and return one row per record: file,
    offset, length, doc_id, n_tokens, ids_crc32, and local_start (ids before it in its file)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(record_dir).select("path", "content")
    return files.mapInPandas(
        _parse, "file string, doc_id long, offset long, length long, local_start long, n_tokens long, ids_crc32 long")


def write_index(spark: SparkSession, record_dir: str, index_dir: str) -> DataFrame:
    """Store the offset index of ``record_dir`` (with the global start of every record) and return it."""
    rows = read_index(spark, record_dir)
    rows.write.mode("overwrite").parquet(index_dir)
    rows = spark.read.schema(rows.schema).parquet(index_dir)
    before = W.partitionBy().orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    bases = (rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base")))
    return rows.join(bases, "file").withColumn("start", F.col("base") + F.col("local_start")).drop("base", "local_start")


def _slices(index: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for content in files["content"]:
        view = memoryview(content)
        for at, size in zip(index["offset"], index["length"]):
            _, _, doc_id, ids = next(frames(view[at:at + size]))
            rows.append((doc_id, ids.astype(np.int64)))
    out = pd.DataFrame(rows, columns=["doc_id", "ids"])
    out["doc_id"] = pd.array([r[0] for r in rows], dtype="Int64")
    return out


def read_shuffled(spark: SparkSession, record_dir: str, index: DataFrame, seed: int, part: int = 0, parts: int = 1) -> DataFrame:
    """Records number ``part`` of ``parts`` of the seeded shuffle: (doc_id, ids) in
    seeded order. Only the chosen byte ranges are decoded."""
    key = F.xxhash64(F.lit(seed), F.col("file"), F.col("offset"))
    mine = index.where(F.pmod(key, F.lit(parts)) == part).select("file", "offset", "length")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(record_dir)
             .select(F.col("path").alias("file"), "content"))
    got = mine.groupBy("file").cogroup(files.groupBy("file")).applyInPandas(_slices, "doc_id long, ids array<long>")
    return got.orderBy(F.xxhash64(F.lit(seed), F.col("doc_id")))


def fresh_dir(spark: SparkSession, name: str) -> str:
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/skuflow-{name}/{uuid.uuid4().hex[:12]}"


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    root = fresh_dir(spark, "records")
    write_records(table(spark, sf_dir, "documents"), f"{root}/records", public_tokenizers.path("word_bpe_49k.json"))
    return write_index(spark, f"{root}/records", f"{root}/index").select(
        "doc_id", "start", "n_tokens", "ids_crc32", F.element_at(F.split("file", "/"), -1).alias("file"), "offset", "length")
