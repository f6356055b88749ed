"""The operators as queries over the given tables, whole and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm import (
    chat,
    decontam,
    embeddings,
    licenses,
    line_dedup,
    minhash,
    mixing,
    periodic,
    prefix_trie,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
)
from tarmac.llm.frames import on_workers, table
from tarmac.llm.oracle import ORACLE as ORACLE
from tarmac.session import discard, scratch_path, stored

TOKENIZER = "word_bpe_49k.json"
#: A conversation whose texts hold the control strings of a template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents, one sent twice: first counts, deletion of later exact copies, and revised
    counts of the remaining documents with digits, whose digits were taken out."""
    docs = table(spark, sf_dir, "documents")
    bare = F.regexp_replace("text", "[0-9]+", " ")
    facts = stored(
        docs.select(
            "doc_id",
            "source",
            "lang",
            F.md5(F.coalesce("text", F.lit(""))).alias("digest"),
            token_counts.pattern_counts(F.col("text")).alias("counts"),
            F.when(F.col("text").rlike("[0-9]"), token_counts.pattern_counts(bare)).alias("bare_counts"),
        ),
        "facts",
    )
    first = facts.groupBy("digest").agg(F.min("doc_id").alias("first"))
    judged = facts.join(first, "digest")

    def events(frame: DataFrame, counts: str, op: str) -> DataFrame:
        return frame.select("doc_id", "source", "lang", F.inline(counts), F.lit(op).alias("op"), F.lit(0).alias("order"))

    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("load", events(facts, "counts", "upsert"))
    copies = events(judged.filter("doc_id > first"), "counts", "delete")
    rollup.commit("copies", copies)
    rollup.commit("digits", events(judged.filter("doc_id = first AND bare_counts IS NOT NULL"), "bare_counts", "upsert"))
    rollup.commit("copies", copies)
    discard(facts)
    return rollup.totals()


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat.read_back(chat.format_chats(turns.unionByName(own)))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_path(spark, "tokens")
    written = token_files.write_token_files(table(spark, sf_dir, "documents"), place, public_tokenizers.path(TOKENIZER))
    return token_files.read_token_files(spark, place, written)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.with_hits(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.inline("hits"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("line_licenses", F.array_join("line_licenses", "|"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document how many lines go, where repeated windows begin, and a digest of the text that remains."""
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.array_join("spots", "|").alias("spots"), F.md5("text").alias("text_md5")
    )


def with_planted_run(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every document whose id's checksum h ends in 0, the words from word g % n on, g = h div 10,
    repeat the first (n - g % n) div (3 + g % 8) + 1 of them."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), g.alias("g"))
    changed = changed.withColumn("n", F.size("w"))
    place, period = F.col("g") % F.col("n"), F.floor((F.col("n") - F.col("place")) / (3 + F.col("g") % 8)) + 1

    def moved(word: Column, i: Column) -> Column:
        return F.when(i < F.col("place"), word).otherwise(
            F.get("w", (F.col("place") + (i - F.col("place")) % F.col("period")).cast("int"))
        )

    return (
        changed.withColumn("place", F.when(F.col("n") > 0, place))
        .withColumn("period", period)
        .select("doc_id", F.when(F.col("n") > 0, F.array_join(F.transform("w", moved), " ")).otherwise(F.col("text")).alias("text"))
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the text without their repeats."""
    found = periodic.periodic_runs(with_planted_run(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members): conversation c begins with the first h turns of conversation c - c % 20, where h is the checksum of
    c modulo 4, and goes on with its own turns after its first h. ``members`` has every conversation."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    own = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *texts)
    placed = stored(placed.withColumn("turn", F.row_number().over(own)), "placed")
    opening_of = F.crc32(F.col("conv_id").cast("string")) % 4
    members = placed.filter("turn = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), opening_of.alias("h"))
    openings = placed.filter("turn <= 3").withColumnRenamed("conv_id", "base").join(members, "base").filter("turn <= h")
    columns = ["conv_id", "turn", "role", "text"]
    rest = placed.filter(F.col("turn") > opening_of)
    return rest.select(*columns).unionByName(openings.select(*columns)), members.select("conv_id")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*with_shared_openings(table(spark, sf_dir, "conversations")))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what goes, and a digest of the bytes that remain."""
    return suffix_dedup.drop_repeated_strings(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    f.__name__: on_workers(f)
    for f in (
        op1_token_counts,
        op2_chat_formatting,
        op3_source_mixing,
        op4_minhash_near_dedup,
        op5_toxicity,
        op6_embedding_near_dedup,
        op7_token_files,
        op8_decontamination,
        op9_license_scan,
        op10_line_dedup,
        op11_periodic_runs,
        op12_conversation_trie,
        op13_suffix_dedup,
    )
}
