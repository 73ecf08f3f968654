"""A training corpus from raw documents, in four stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read
again as the next one's documents. All but the last return the documents' columns.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, langid, mixing, simhash
from millrace.llm.common import prepare, staged
from millrace.llm.queries import word_bpe


def rows(docs: DataFrame, *columns: str) -> DataFrame:
    """Some columns, and the whole row as one: no other column can clash with an operator's."""
    return docs.select(*columns, F.struct("*").alias("row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, those without letters, those in none.

    In none is a text without a known n-gram, unless its ``lang`` names a language that
    wasn't learned. Where none was, nothing tells, and all texts with letters stay.
    A null ``lang`` becomes the predicted one; others stay as they are.
    """
    prepare(spark)
    filters = langid.learned(docs)
    if not filters.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(rows(docs, "text"), filters, keep=["row"])
    other = F.coalesce(~F.col("row.lang").isin(filters.langs), F.lit(False))
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & ((F.col("score") > 0) | other))
    return kept.select(F.col("row").withField("lang", F.coalesce("row.lang", "lang_pred")).alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Their fingerprints of three-word shingles link at two or fewer differing bits.
    """
    prepare(spark)
    return simhash.one_of_each(docs, words=3)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as its source's target asks, perhaps never."""
    prepare(spark)
    mixed = mixing.mix(rows(docs, "doc_id", "text", "source"))
    return mixing.repeated(mixed).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded, a row for each copy of a document."""
    prepare(spark)
    encoded = bpe.encode(docs, word_bpe())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mixing_sources),
    ("bpe", tokens),
]

# Near-duplicates need fingerprints and components that SQL can't express here.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
