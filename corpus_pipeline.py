"""The corpus pipeline: language ID, SimHash near-dedup, secret scan, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bazaarlens.llm import language_id as lang, mixing, packing, secret_scan as secrets, simhash
from bazaarlens.llm.common import written
from bazaarlens.llm.queries import tokenizer_path

# no stage has an SQL form: frozen statistics, 64-bit hashes, random rounding and tokens
ORACLE_SQL = None

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language (null texts, texts without a letter) go; the others stay as they are, a null lang filled with the predicted one."""
    named = lang.identify(docs.select(*COLUMNS), keep=COLUMNS[1:])
    kept = named.where("lang_pred <> 'und'")
    return kept.select("doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; a row without an id only if no row of its group has one.

    Groups are told by their root fingerprints, so unlike texts under one id, or under none, all stay. Texts
    are read once and joined to the ids that stay; fingerprints are taken anew only for ids that several rows share.
    """
    rows = docs.select(*COLUMNS)
    found = written(simhash.simhash_groups(rows, shingle=3, distance=3, with_root=True), "groups")
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("k")).select("k.doc_id", "k.fp")
    shared = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_of")).agg(F.count("*").alias("rows"))
    keepers = kept.where("doc_id is not null").join(shared, F.col("doc_id") == F.col("_of"))
    keepers = written(keepers.select(F.col("doc_id").alias("_id"), F.col("fp").alias("of"), "rows"), "keepers")
    ids = keepers.groupBy("_id").agg(F.max("rows").alias("rows"))
    met = rows.join(ids.hint("merge"), F.col("doc_id") == F.col("_id")).drop("_id")
    single = met.where("rows = 1").select(*COLUMNS)
    # an id that several rows share: the texts that it stands for, told by their fingerprints, and one row of each
    several = simhash.fingerprints(met.where("rows > 1"), shingle=3, keep=COLUMNS[1:])
    several = several.join(keepers.where("rows > 1").hint("merge"), (F.col("doc_id") == F.col("_id")) & (F.col("fp") == F.col("of")))
    one = several.groupBy("doc_id", "fp").agg(F.min(F.struct(*COLUMNS[1:])).alias("r")).select("doc_id", "r.*")
    # groups in which no row has an id
    nameless = written(kept.where("doc_id is null").select(F.col("fp").alias("of")), "nameless")
    texts = simhash.fingerprints(rows.where("doc_id is null"), shingle=3, keep=COLUMNS[1:])
    texts = texts.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct(*COLUMNS[1:])).alias("r"))
    alone = texts.join(nameless.hint("merge"), F.col("fp") == F.col("of")).select("doc_id", "r.*")
    return single.unionByName(one).unionByName(alone)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; each secret is replaced by a mark, and n_chars follows. A null text stays null."""
    found = secrets.scan(docs, secrets.trained(docs), keep=COLUMNS[1:])
    clean = found.withColumn("_text", secrets.redacted(F.col("text"), F.col("found")))
    count = F.when(F.size("found") > 0, F.length("_text").cast("long")).otherwise(F.col("n_chars"))
    return clean.select("doc_id", F.col("_text").alias("text"), "lang", "source", count.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.

    Rows are told by id and a hash of the others; those equal in both are one text, given as often as all of them are taken.
    """
    rows = docs.select(*COLUMNS).withColumn("_tag", F.xxhash64(*COLUMNS[1:]))
    mixed = mixing.mix(rows, tag_col="_tag").groupBy("doc_id", "tag").agg(F.sum("copies").cast("int").alias("times"), F.count("*").alias("rows"))
    times = written(mixed.where("times > 0").select(F.col("doc_id").alias("_id"), F.col("tag").alias("_of"), "times", "rows"), "copies")
    # one row per document: a side that grows with the input is never broadcast, at no size
    met = rows.join(times.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("_of")))
    out = met.where("rows = 1").select(*COLUMNS, "times")
    if times.where("rows > 1").head(1):
        out = out.unionByName(met.where("rows > 1").groupBy(*COLUMNS).agg(F.max("times").alias("times")))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each copy on its own, with their places in sequences of 1024 tokens."""
    return packing.pack(docs, packing.Tokenizer(tokenizer_path(), encode_special_tokens=False))


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("secret_scan", secret_scan), ("mix_sources", mix_sources), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
