"""The registered queries of this package, each an operator over its whole table, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import (language, lexicon, licences, merkle, minhash, packing, periods, quality, repetition, search,
                          simhash, tokenfile, toxicity)
from landfall.session import work_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def remainder(divisor: int) -> Column:
    """Of the checksum of a doc_id's digits: the folds that the scores are held to."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.encode(_documents(spark, sf_dir)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = language.learn(documents.where(remainder(3) != 1))
    return language.identify(_documents(spark, sf_dir), model).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    model = quality.learn(documents, _table(spark, sf_dir, "labels").where(remainder(5) != 0))
    return quality.score(documents, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.measure(_documents(spark, sf_dir)).drop("text")


def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_documents(spark, sf_dir))


def op9_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokenfile")
    tokenfile.write(_documents(spark, sf_dir), path)
    return tokenfile.read(spark, path)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    labels = _table(spark, sf_dir, "labels").where(remainder(5) != 0)
    prior = labels.agg(F.avg("toxic")).first()[0]
    model = toxicity.learn(documents.where(remainder(5) != 0), labels.where("toxic = 1"), prior or 0.0)
    return toxicity.score(documents, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _with_planted_runs(documents: DataFrame) -> DataFrame:
    """One document in ten as its words, of which those from one on repeat: the contract's planted runs."""
    h = remainder(1 << 32)
    words = F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = documents.select("doc_id", "text", h.alias("h"), words.alias("words"))
    rows = rows.select("*", F.size("words").alias("n"), F.expr("h DIV 10").alias("g"))
    rows = rows.select("*", F.expr("CAST(g % greatest(n, 1) AS INT)").alias("a"))
    rows = rows.select("*", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)").alias("p"))
    planted = F.expr("array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), "
                     "CAST((n - a + p - 1) DIV p AS INT))), 1, n - a)), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.collapse(_with_planted_runs(_documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n"))))
    # Fractions are compared crosswise, so exactly; of equal ones the first in order of start and period stays.
    best = F.aggregate("runs", F.lit(None).cast(periods.RUN), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    others, capitals = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    leaf = merkle.leaf([*others, F.col("text")])
    lowered = merkle.leaf([*others, F.translate("text", capitals, capitals.lower())])
    tampered = F.when(remainder(3) == 0, lowered).otherwise(leaf)
    proven = merkle.manifest(documents, leaf, carry={"tampered": tampered})
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        merkle.fold(F.col("tampered"), F.col("proof")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_language, op3_packing, op4_quality, op5_simhash, op6_repetition, op7_search, op8_licences,
    op9_tokenfile, op10_toxicity, op11_periods, op12_minhash, op13_merkle)}

# Inner products of whole numbers, so SQL has the same scores to the last digit.
_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1),
         lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {"op7_search": _TOP_K, "op8_licences": licences.oracle(), "op12_minhash": minhash.oracle(),
            "op13_merkle": merkle.oracle()}
