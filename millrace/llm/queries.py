"""The registered queries of the operators, each over its whole table."""

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, hardneg, hnsw, langid, licences, mixing, phrases, pii, sharding, simhash, topk, warc
from millrace.llm.common import prepare
from millrace.session import shared_folder

SHARDS = [f"shard-{i}" for i in range(64)]
SLOTS = 8191


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def word_bpe() -> str:
    """The vocabulary's file, as text."""
    import public_tokenizers

    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text()


def token_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = licences.scan(docs, F.broadcast(licences.known_licences(spark)))
    return found.select("doc_id", "digest", "license_id", licences.notices(F.col("text")).alias("notices"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = [F.struct(F.lit(-7).alias("conv_id"), F.lit(i).alias("turn"), F.lit(r).alias("role"), F.lit(marks).alias("text")) for i, r in enumerate(("user", "assistant"))]
    turns = turns.unionByName(spark.range(1).select(F.inline(F.array(*extra))))
    formatted = chat.format_turns(turns.withColumn("parts", chat.text_part(F.col("text"))))
    return chat.conversations(formatted)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), words=3)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_digests(bpe.encode(docs, word_bpe()))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id")
    return sharding.place(docs, "doc_id", SHARDS, SLOTS).select("doc_id", "slot", "shard")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.identify(docs, langid.learned(docs), keep=["doc_id"])
    held_out = F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    path = f"{shared_folder(spark)}/archives"
    warc.write(pages, path)
    return warc.resolve(warc.read(spark, path, payloads=False))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return hnsw.search(rows, rows.where("vec_id % 50 = 0"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    whole = rows.select("vec_id", topk.quantised(F.col("embedding"), 256).alias("vector"))
    return topk.search(whole, whole.where("vec_id % 50 = 0"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents", "text", "lang"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    relabelled = rows.select("vec_id", F.col("embedding").alias("vector"), label.alias("label"))
    return hardneg.mine(relabelled, relabelled.where("vec_id % 100 = 0"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(_table(spark, sf_dir, "documents", "doc_id", "text"))

    def of(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = pii.written(F.col("base"), "kind")
    return found.select(
        F.col("id").alias("doc_id"),
        *map(of, pii.KINDS),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", *[F.nullif(x, F.lit("")) for x in (base, pii.written(F.col("added"), "action"))]).alias("spans"),
    )


LLM_QUERIES = {
    q.__name__: q
    for q in (
        op1_licenses,
        op2_chat,
        op3_simhash,
        op4_bpe,
        op5_sharding,
        op6_language,
        op7_warc,
        op8_mixing,
        op9_neighbours,
        op10_topk,
        op11_collocations,
        op12_hard_negatives,
        op13_pii,
    )
}
