"""The queries opN_<name> over the training-data operators, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocations, conversation_repair, html_extract, imatch, mixing, oracles, packing, positional_index, simhash, suffix_array, suffix_tree, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of each vector whose id is divisible by 20, among all vectors."""
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept of every document once windows of 13 words of smaller documents are gone."""
    return suffix_tree.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, ["doc_id"]).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document by the mix of all sources."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all texts, and the components of links at 4 or fewer differing bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes kept of every document once strings of 50 bytes of smaller documents are gone."""
    return suffix_array.dedup(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, read back and assembled."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every text and its edited text, with their likeness."""
    return imatch.edited_pairs(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of two and three words of each language that hold together best."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of 10 words of benchmark items, and those items."""
    found = positional_index.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every damaged conversation."""
    talks = _table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(talks), talks)


QUERIES = {
    "op1_ann": op1_ann,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_toxicity": op3_toxicity,
    "op4_mix_sources": op4_mix_sources,
    "op5_extract": op5_extract,
    "op6_pack": op6_pack,
    "op7_simhash": op7_simhash,
    "op8_suffix_array": op8_suffix_array,
    "op9_warc": op9_warc,
    "op10_imatch": op10_imatch,
    "op11_collocations": op11_collocations,
    "op12_decontaminate": op12_decontaminate,
    "op13_repair": op13_repair,
}
ORACLES: dict[str, str] = {"op2_suffix_tree": oracles.SUFFIX_TREE, "op8_suffix_array": oracles.SUFFIX_ARRAY, "op9_warc": oracles.WARC, "op11_collocations": oracles.COLLOCATIONS, "op12_decontaminate": oracles.DECONTAMINATION, "op13_repair": oracles.REPAIR}
