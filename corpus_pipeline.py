"""The corpus pipeline: toxicity, near-duplicates, personal data, mixing, token pieces.

Each stage takes (spark, docs, sf_dir), works on all that the stage before
kept, and returns documents (the last one: encoded documents). ``run`` applies
them to the documents table, each result stored in the shared folder and read
again, so a lost executor never repeats an earlier stage.

* toxicity: documents whose probability of any toxic grade reaches one half go.
* near_duplicates: five-word shingles, similarity 0.8; the document with the
  smallest id of each group stays (of rows equal in id and text, one).
* personal_data: every confirmed span of a base kind is masked, and ibans
  scoring at least one half.
* mixing: words are taken by quota; a document is returned once for each time
  words of it are taken, with exactly the words of that time (in order).
* pieces: ids of every document, next to its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import table, text_of
from skuflow.llm.mixing import mix_sources
from skuflow.llm.near_dup import near_duplicates
from skuflow.llm.pieces import encode
from skuflow.llm.pii import redact
from skuflow.llm.toxicity import score_documents
from skuflow.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE_WORDS = 5
PERCENT = 80


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c) for c in COLUMNS])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = score_documents(_documents(docs), table(spark, sf_dir, "labels"))
    return _documents(scored.where(~F.col("__tox.rejected")))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _documents(docs)
    found = near_duplicates(docs, SHINGLE_WORDS, PERCENT).where("kept")
    kept = found.select(F.col("doc_id").alias("__kept")).distinct()
    joined = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi")
    if found.count() == kept.count():  # no id occurs twice
        return joined
    return joined.dropDuplicates(["doc_id", "text"])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(_documents(docs))


def _cut(text, runs):
    """The words that each time takes, one text per time."""
    import re
    words = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
    times = max((runs[i + 2] for i in range(0, len(runs), 3)), default=0)
    out = []
    for t in range(1, times + 1):
        parts, last = [], None
        for i in range(0, len(runs), 3):
            a, b, n = runs[i:i + 3]
            if n < t:
                continue
            if last == a and parts:
                start = words[last - 1].end()
                parts[-1] += text[start:words[b - 1].end()]
            else:
                parts.append(text[words[a].start():words[b - 1].end()])
            last = b
        out.append(text if a_whole(runs, t, len(words)) else " ".join(parts))
    return out


def a_whole(runs, time: int, n_words: int) -> bool:
    return sum(runs[i + 1] - runs[i] for i in range(0, len(runs), 3) if runs[i + 2] >= time) == n_words


def _taker(batches):
    import pyarrow as pa
    for batch in batches:
        cols = batch.to_pydict()
        rows = {c: [] for c in COLUMNS}
        for i, runs in enumerate(cols["runs"]):
            for text in _cut(cols["text"][i] or "", runs or []):
                for c in COLUMNS:
                    rows[c].append(text if c == "text" else len(text) if c == "n_chars" else cols[c][i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["text"], pa.string()), pa.array(rows["lang"], pa.string()),
             pa.array(rows["source"], pa.string()), pa.array(rows["n_chars"], pa.int64())], names=list(COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _documents(docs)
    tag = F.sha2(F.concat_ws("\0", F.coalesce("source", F.lit("\1")), text_of()), 256)
    taken = mix_sources(docs, tag=tag).where("taken > 0").select(F.col("doc_id").alias("__id"), "tag", "runs")
    same = [F.col("doc_id").eqNullSafe(F.col("__id")), F.col("__tag") == F.col("tag")]
    tagged = docs.withColumn("__tag", tag)
    if taken.count() > taken.select("__id", "tag").distinct().count():  # equal rows: one text serves all their runs
        tagged = tagged.dropDuplicates(["doc_id", "__tag"])
    return tagged.join(taken, same).select(*COLUMNS, "runs").mapInArrow(
        _taker, "doc_id long, text string, lang string, source string, n_chars long")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    coded = encode(_documents(docs), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_pieces", "ids", "round_trip")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicate), ("personal_data", personal_data),
          ("mixing", mixing), ("pieces", pieces)]

#: SQL cannot express the model, the sketches or the seeded choice; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
