"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import neighbour_vote, toxic_grammar, word_table
from tidemark.llm.auction_repair import CONVERSATIONS_SQL, repair_report
from tidemark.llm.bisector_clusters import CLUSTERS_SQL, clusters
from tidemark.llm.block_labeller import main_texts
from tidemark.llm.block_mixing import Mix
from tidemark.llm.host_words import judge_urls
from tidemark.llm.line_rules import LINE_RULES_SQL, line_rules
from tidemark.llm.merge_dropout import round_trip
from tidemark.llm.one_permutation import edited_prints
from tidemark.llm.passage_chains import repeated_passages
from tidemark.llm.prefix_join import NEAR_DUPLICATES_SQL, near_duplicates
from tidemark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def query(name: str, sql: str | None = None):
    def keep(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return keep


def held_out(parts: int, part: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


@query("op1_line_frequency", LINE_RULES_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(read(spark, sf_dir, "documents"))


@query("op2_toxic_grammar")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    rows = toxic_grammar.train_rows(docs, labels, "toxic", 3, 1, toxic_grammar.TRAIN_ROWS)
    scored = toxic_grammar.score_documents(docs, toxic_grammar.learn(rows))
    return scored.select(
        "doc_id", held_out(3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op3_passage_chains")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))


@query("op4_block_labeller")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages"))


@query("op5_one_permutation")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_prints(read(spark, sf_dir, "documents"))


@query("op6_prefix_join", NEAR_DUPLICATES_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


@query("op7_neighbour_vote")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    rows = neighbour_vote.train_rows(docs, labels, "quality", 5, 0, neighbour_vote.TRAIN_ROWS)
    scored = neighbour_vote.score_documents(docs, neighbour_vote.learn(rows))
    return scored.select(
        "doc_id", held_out(5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op8_host_words")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))


@query("op9_block_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(read(spark, sf_dir, "documents")).digest()


@query("op10_merge_dropout")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents")).drop("pieces")


@query("op11_auction_repair", CONVERSATIONS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(read(spark, sf_dir, "conversations"))


@query("op12_word_table")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_table.round_trip(read(spark, sf_dir, "documents"))


@query("op13_bisector_tournament", CLUSTERS_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(read(spark, sf_dir, "embeddings"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(configure(spark), sf_dir)
