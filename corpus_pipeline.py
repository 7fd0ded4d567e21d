"""The corpus pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes to the shared folder and reads again as the next one's input.
All but the last return the columns of documents. Texts that line dedup
changes get the number of characters they have then; a document that it
leaves without any text goes, while documents without text in the input stay.

Defined cases are those of the operators; a document with a NULL id is never a
duplicate. Of rows that share an id, near-dedup keeps one: rows with a text come
first, in the order of the text, then of the whole row as JSON. Decontamination
decides for each id and text, so a NULL id is an id like any other and a row goes
for its own text only. Columns beyond those of documents pass through the
filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.llm import decontaminate, line_dedup, minhash, sentencepiece_bpe, toxicity
from quaylake.llm.common import free_name, scratch_path
from quaylake.plans.broadcast import join_small
from quaylake.sources.tables import read_table

#: ids of removed documents are broadcast up to this size, else joined by a shuffle
BROADCAST_BYTES = 32 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier accepts."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.filter("toxicity < 0.5").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line runs that an earlier place has already."""
    cleaned = line_dedup.remove_repeated_lines(docs)
    changed = F.size("removed") > 0
    emptied = changed & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    kept = cleaned.filter(~emptied)
    n_chars = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that of the least id."""
    found = minhash.near_duplicates(docs)
    copies = found.filter("doc_id != component_id").select("doc_id").distinct()
    left = join_small(docs, copies, "doc_id", "left_anti", max_bytes=BROADCAST_BYTES).select(*docs.columns)
    # rows of one id are one document; only those are shuffled
    again = docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    once = join_small(left, again, "doc_id", "left_anti", max_bytes=BROADCAST_BYTES).select(*docs.columns)
    several = join_small(left, again, "doc_id", "left_semi", max_bytes=BROADCAST_BYTES).select(*docs.columns)
    row = F.struct(*docs.columns)
    order = F.struct(F.col("text").isNull(), F.col("text"), F.to_json(row))
    chosen = several.groupBy("doc_id").agg(F.min_by(row, order).alias("row")).select("row.*")
    return once.unionByName(chosen)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    # a struct is never NULL, so that rows without an id find themselves again
    key = free_name(docs, "doc_key")
    keyed = docs.withColumn(key, F.struct("doc_id", F.xxhash64("text").alias("text_hash")))
    leaked = decontaminate.leaks(keyed, benchmark, id_col=key).select(F.col("doc_id").alias(key)).distinct()
    return join_small(keyed, leaked, key, "left_anti", max_bytes=BROADCAST_BYTES).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding gives the text again."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepiece_bpe.encode_texts(docs, model, outputs=("n_tokens", "ids", "decoded_sha256"))
    exact = F.col("decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256)
    return encoded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", exact.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: trained classification and a vocabulary file are beyond SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + "-".join(name.lower().split()))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
