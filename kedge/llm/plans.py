"""Queries of the training-data operators, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kedge import scratch
from kedge.llm import split
from kedge.llm.canonical import canonical_text, irregular
from kedge.llm.garbled import find_garbled
from kedge.llm.matching import contents, match
from kedge.llm.mixing import mix
from kedge.llm.neardup import near_duplicate_groups, near_duplicate_pairs
from kedge.llm.tokens import count_tokens, encode


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


#: Problem 1 as stated for this project: single words, 0.6 in common.
P1_THRESHOLD, P1_WORDS = 0.6, 1


def _p1_records(spark: SparkSession, d: str) -> DataFrame:
    answers = F.array_join("published_answers", "\n")
    return _read(spark, d, "published_questions").select("reference_id", F.concat_ws("\n", "normalized_question_text", answers).alias("text"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = near_duplicate_pairs(_p1_records(spark, d), id="reference_id", text="text", threshold=P1_THRESHOLD, n=P1_WORDS)
    return pairs.select(F.col("id_a").alias("reference_id_a"), F.col("id_b").alias("reference_id_b"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_groups(_p1_records(spark, d), id="reference_id", text="text", threshold=P1_THRESHOLD, n=P1_WORDS)


def _p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    """(reference_id, stable_key, confidence) of every published row and live question that ask the same."""
    published = _read(spark, d, "published_questions").select("reference_id", "question_text", "published_answers")
    live = _read(spark, d, "questions").select("stable_key", "text", F.transform("answers", lambda a: a["text"]).alias("answers"))
    left, of_left = contents(published, id="reference_id", main="question_text", phrases="published_answers", name="left")
    right, of_right = contents(live, id="stable_key", main="text", phrases="answers", name="right")
    found = match(left, right).select(F.col("l").alias("key"), "r", "confidence")
    # a content may be that of very many rows
    named = split.join(found, of_left.withColumnRenamed("content", "key"), key="key", by=("r", "reference_id")).select(F.col("r").alias("key"), "reference_id", "confidence")
    both = split.join(named, of_right.withColumnRenamed("content", "key"), key="key", by=("reference_id", "stable_key"))
    return both.groupBy("reference_id", "stable_key").agg(F.max("confidence").alias("confidence"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _p4_pairs(spark, d).select("reference_id", "stable_key")


def p4_matches(spark: SparkSession, d: str) -> DataFrame:
    return _p4_pairs(spark, d)


def _p5_texts(spark: SparkSession, d: str) -> DataFrame:
    """(field, record_key, text) of every text of problem 5."""
    published = _read(spark, d, "published_questions").select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col("reference_id").alias("record_key"), F.col(f).alias("text")) for f in ("question_text", "normalized_question_text")])).alias("x")
    )
    answers = _read(spark, d, "questions").select(F.explode("answers").alias("a")).select(F.struct(F.lit("answer_text").alias("field"), F.col("a.id").alias("record_key"), F.col("a.text").alias("text")).alias("x"))
    return published.unionByName(answers).select("x.*")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return irregular(_p5_texts(spark, d), text="text").where("record_key is not null").select("field", "record_key").distinct()


def p5_canonical(spark: SparkSession, d: str) -> DataFrame:
    texts = _p5_texts(spark, d).distinct().withColumn("canonical", canonical_text(F.col("text")))
    return texts.select("field", "record_key", "canonical", (~F.col("canonical").eqNullSafe(F.col("text"))).alias("changed"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode(_read(spark, d, "documents"), id="doc_id", text="text")


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = count_tokens(_read(spark, d, "documents"), text="text", keep=["source", "lang"])
    return docs.groupBy("source", "lang").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))


def _p7_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Documents with their tokens and the sources they belong to, here the one of their row."""
    sized = count_tokens(_read(spark, d, "documents"), text="text", keep=["doc_id", "source"])
    return sized.withColumn("sources", F.array("source"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """Uses per document of the largest mixture in which every source has its share."""
    return mix(_p7_sizes(spark, d), _read(spark, d, "mix_targets"), id="doc_id", sources="sources", tokens="tokens", total="shares")[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares, of that mixture and of one as large as all documents once."""
    sized, targets = scratch.table(_p7_sizes(spark, d), "tokens"), _read(spark, d, "mix_targets")
    parts = [mix(sized, targets, id="doc_id", sources="sources", tokens="tokens", total=total)[1].withColumn("total", F.lit(total)) for total in ("shares", "once")]
    return parts[0].unionByName(parts[1])


def p7_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Shares of a mixture of distinct texts, each of which belongs to every source it occurs in."""
    docs = _read(spark, d, "documents").where("source is not null and text is not null")
    held = docs.groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.array_sort(F.collect_set("source")).alias("sources"))
    sized = count_tokens(docs, text="text", keep=["doc_id"]).join(held, "doc_id")
    return mix(sized, _read(spark, d, "mix_targets"), id="doc_id", sources="sources", tokens="tokens", total="shares")[1]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return find_garbled(_read(spark, d, "documents"), id="doc_id", text="text").select("doc_id")


def p8_restored(spark: SparkSession, d: str) -> DataFrame:
    found = find_garbled(_read(spark, d, "documents"), id="doc_id", text="text")
    return found.select("doc_id", "restored", F.array_join("mappings", ",").alias("mappings"))


def queries() -> dict:
    return {
        "p1_found": p1_found, "p1_groups": p1_groups,
        "p4_found": p4_found, "p4_matches": p4_matches,
        "p5_found": p5_found, "p5_canonical": p5_canonical,
        "p6_ids": p6_ids, "p6_counts": p6_counts,
        "p7_mix": p7_mix, "p7_shares": p7_shares, "p7_overlap": p7_overlap,
        "p8_found": p8_found, "p8_restored": p8_restored,
    }


def sql() -> dict[str, str]:
    return {}
