"""The registered queries of this package: one per operator, over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (centroids, conversation_repair, decontamination, hyperminhash, jaccard_join, language, line_quality,
               mixing, reply_trees, sentence_spans, suffix_dedup, token_records, url_templates)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated 400-byte strings."""
    got = suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_benchmark_decontamination", """
WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
items AS (SELECT DISTINCT item, array_to_string(w[i : i + 12], ' ') AS k, least(len(w), 13) AS m
          FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
spans AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS k
          FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
                FROM dw, (SELECT DISTINCT m FROM items) AS ms WHERE len(w) >= m)),
hits AS (SELECT s.doc_id, s.i, s.m, t.item FROM spans AS s JOIN items AS t ON s.k = t.k AND s.m = t.m),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
            SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(w.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n, 0) AS BIGINT) AS n_items, sha256(coalesce(f.s, '')) AS items_sha256,
       coalesce(w.n, 0) > 0 AND 20 * coalesce(w.n, 0) >= len(d.w) AS contaminated
FROM dw AS d LEFT JOIN words AS w USING (doc_id) LEFT JOIN found AS f USING (doc_id)
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    got = decontamination.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated")


@register("op3_token_records")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a binary token record, read back."""
    path = token_records.write_records(table(spark, sf_dir, "documents"), tokenizer_file())
    index = token_records.with_starts(token_records.build_index(spark, path))
    return index.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@register("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.learn(docs.where("not held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


@register("op5_sentence_spans")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated sentence runs."""
    got = sentence_spans.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_sentences", "n_removed", "clean_text")


@register("op6_url_templates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url.  A page's label is that of the document whose number ends its
    path: good if its quality is 1 and it is not toxic."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("_label"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_templates.path_of(F.col("url")), r"(\d{1,18})(\.\w+)?/?$", 1)
    pages = pages.withColumn("doc_id", F.when(number != "", number).cast("long")).join(labels, "doc_id", "left")
    got = url_templates.judge(pages, good=F.col("_label") == 1)
    return got.select("page_id", "host", "path", "rule", "verdict")


@register("op7_source_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's part of the mix."""
    got = mixing.allocate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return got.select("doc_id", "size", "source_size", "target", "taken")


@register("op8_line_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts and verdict."""
    got = line_quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op9_reply_trees")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back."""
    text = "\\### Assistant: </turn> ok"
    more = spark.sql("select -7L as conv_id, 0L as turn, 'user' as role").union(
        spark.sql("select -7L, 1L, 'assistant'")).withColumn("text", F.lit(text))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    got = reply_trees.format_paths(reply_trees.linear_nodes(rows))
    got = got.withColumns({"turns": reply_trees.parse(F.col("formatted")),
                           "loss": reply_trees.masked_text(F.col("formatted"), F.col("loss_spans"))})
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return got.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


@register("op10_ngram_jaccard")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies."""
    got = jaccard_join.join_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_shingles", "component_id")


def _centroid_sql(rounds: int = centroids.ROUNDS, k: int = centroids.CENTROIDS) -> str:
    """The rounds of op11, one after the other."""
    kept = f"""kept AS MATERIALIZED (SELECT vec_id, [CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v,
           sha256('{centroids.SEED}:' || CAST(vec_id AS VARCHAR)) AS h FROM embeddings
      WHERE len(embedding) = {centroids.DIMS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {centroids.DIMS})"""
    parts = [kept, f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v FROM kept
      ORDER BY h NULLS LAST, v LIMIT {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, v, c, d FROM (
        SELECT vec_id, v, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS nth FROM (
          SELECT k.r, k.vec_id, k.v, c.c, list_sum([CAST((k.v[i] - c.v[i]) * (k.v[i] - c.v[i]) AS BIGINT) FOR i IN range(1, {centroids.DIMS + 1})]) AS d
          FROM (SELECT *, row_number() OVER () AS r FROM kept) AS k, c{i} AS c)) WHERE nth = 1)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} AS c LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
          SELECT c, i, sum(x) AS s, count(*) AS n FROM (
            SELECT c, unnest(v) AS x, unnest(range(1, {centroids.DIMS + 1})) AS i FROM a{i}) GROUP BY c, i) GROUP BY c) AS m USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c USING (c)"""


@register("op11_threshold_centroids", _centroid_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole vector's cluster."""
    return centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@register("op12_hyperminhash")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies, and whether it stays."""
    return hyperminhash.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    rows = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows).withColumnRenamed("conv", "conv_id")
