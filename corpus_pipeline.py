"""A corpus pipeline of the training-data operators.

Every stage works on all rows its predecessor kept; its result is written as Parquet and read again as
the next one's documents. All but the last return the columns of ``documents``.

Defined results, in every stage: an empty table gives no rows; extra columns go along, whatever their names. Null, empty
and blank texts fail the base rules, so they go in the first stage; alone, the other stages keep them (packing gives each
one sequence piece of its end token). A null language or source is a group of its own. Of repeated rows near_dedup keeps one;
rows without an id stay. Ties fall to the least id. Texts of any length are read whole; packing cuts those over 1,024
tokens into pieces. Pseudonyms change texts and count their lengths anew, and keep every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from circulation.llm import decontam, minhash, packing, pii, quality
from circulation.llm.common import bound_memory, written
from circulation.session import ensure_checkpoint_dir


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    bound_memory(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    _ready(spark)
    return quality.keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    _ready(spark)
    return minhash.dedupe(docs, n=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands, whole or as a paraphrase."""
    _ready(spark)
    return decontam.decontaminated(docs, _read(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in their texts and their lengths counted anew."""
    _ready(spark)
    done = pii.pseudonymised(docs, count=None)
    return done.select(*[F.length("text").cast(done.schema[c].dataType).alias(c) if c.lower() == "n_chars" else f"`{c}`"
                         for c in done.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a packed sequence."""
    _ready(spark)
    pieces = packing.token_pieces(docs)
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.best_fit_pack(slim, ["doc_id", "piece", "ids_crc32"])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pseudonyms),
    ("best_fit_packing", pack_sequences),
]
# The stages hold models, a subword vocabulary and a packing search that SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = _read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
