"""The thin registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrospark.llm import oracles as SQL
from agrospark.llm.centroids import centroid_clusters, digest_of
from agrospark.llm.common import ship
from agrospark.llm.decontam import contaminated, decontaminate
from agrospark.llm.exact_dedup import exact_dedup
from agrospark.llm.jaccard import jaccard_components
from agrospark.llm.line_dedup import line_dedup
from agrospark.llm.mixing import pareto_mix
from agrospark.llm.pii import KINDS, pseudonymise
from agrospark.llm.registry import register
from agrospark.llm.simhash import simhash_dedup
from agrospark.llm.spelling import spelling_variants, vocabulary
from agrospark.llm.substring_dedup import substring_dedup
from agrospark.llm.toxicity import toxicity
from agrospark.llm.url_filters import domain_keys, evaluate, host_of, path_of
from agrospark.llm.warc import archive


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def snapshot_rule(docs: DataFrame) -> DataFrame:
    """Stands for the earlier crawl: rows whose crc32(doc_id as text) is even are the snapshot."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, F.lit(False))


@register("op1_exact_dedup", SQL.EXACT_DEDUP)
def op1_exact_dedup(spark, sf_dir):
    """Exact duplicates of all documents: half of them are the snapshot, half the incoming batch."""
    docs = table(spark, sf_dir, "documents")
    old = snapshot_rule(docs)
    got = exact_dedup(docs.filter(old), docs.filter(~old))
    return got.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


@register("op2_source_mix", SQL.SOURCE_MIX)
def op2_source_mix(spark, sf_dir):
    """All documents mixed to source weights 1, 2, 3 in turn; at most three copies of a document."""
    got = pareto_mix(table(spark, sf_dir, "documents"), weights=[1, 2, 3])
    return got.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@register("op3_warc_archive", SQL.WARC)
def op3_warc_archive(spark, sf_dir):
    """Every page as a WARC record in a content-addressed archive, read back."""
    got = archive(table(spark, sf_dir, "pages"))
    return got.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


@register("op6_simhash")
def op6_simhash(spark, sf_dir):
    """SimHash components of all documents: shingles of 3 words, links at 2 or fewer bits."""
    got = simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return got.select(F.col("id").alias("doc_id"), "fingerprint", "component_id", "n_links")


@register("op7_line_dedup", SQL.LINE_DEDUP)
def op7_line_dedup(spark, sf_dir):
    """All documents without the lines that at least 3 documents hold, but for the largest doc_id's."""
    got = line_dedup(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return got.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op5_decontaminate", SQL.DECONTAMINATE)
def op5_decontaminate(spark, sf_dir):
    """All documents against all benchmark items: windows of 13 words."""
    rows, _ = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated(rows).alias("contaminated"))


@register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    """Toxicity of all documents; predicted at a score of 0.3."""
    got = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)
    return got.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted", F.size("spans").cast("long").alias("n_spans"))


def _number(*parts):
    """28 bits of the MD5 of the joined parts: stands for dates and choices that the tables don't have."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 7), 16, 10).cast("long")


def list_events(pages: DataFrame) -> DataFrame:
    """Dated list entries derived from the pages' hosts and first path segments: some are added, removed and added again."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    section = F.concat(F.lit("u:"), host, F.lit("/"), F.element_at(F.split(path, "/"), 2))
    entry = F.explode(F.concat(F.filter(domain_keys(host), lambda k: k.contains(".")),
                               F.when(F.size(F.split(path, "/")) > 1, F.array(section)).otherwise(F.array()))).alias("entry")
    keys = pages.filter(host.isNotNull()).select(entry).distinct()
    e = keys.withColumn("list", F.explode(F.array(*[F.lit(x) for x in ("adult", "allow", "spam")])))
    e = e.withColumn("x", _number("list", "entry")).filter(F.col("x") % F.when(F.col("list") == "allow", 6).otherwise(3) == 0)
    begin = F.col("x") / 7 % 600
    stay = F.col("x") / 11 % 200 + 30
    steps = F.array(F.struct(F.lit("add").alias("action"), F.floor(begin).alias("d")),
                    F.when(F.col("x") % 5 > 1, F.struct(F.lit("remove").alias("action"), (F.floor(begin) + F.floor(stay)).alias("d"))),
                    F.when(F.col("x") % 5 > 3, F.struct(F.lit("add").alias("action"), (F.floor(begin) + F.floor(stay) + 40).alias("d"))))
    return (e.select("list", "entry", F.explode(steps).alias("s")).filter("s is not null")
            .select("list", "entry", F.date_add(F.lit("2023-01-01").cast("date"), F.col("s.d").cast("int")).alias("day"), F.col("s.action").alias("action")))


@register("op8_url_filters", SQL.URL_FILTERS)
def op8_url_filters(spark, sf_dir):
    """Every page's capture against dated lists as of its fetch day (a day derived from page_id)."""
    pages = table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2023-01-01").cast("date"), (_number(F.col("page_id").cast("string")) % 730).cast("int"))
    got = evaluate(pages.withColumn("day", day), list_events(pages), allow=["allow"])
    return got.select(F.col("id").alias("page_id"), "host", F.col("day").cast("string").alias("fetch_day"), F.array_join("blocked_by", ",").alias("blocked_by"),
                      F.array_join("allowed_by", ",").alias("allowed_by"), F.size("entries").cast("long").alias("n_entries"), "verdict")


@register("op9_substring_dedup")
def op9_substring_dedup(spark, sf_dir):
    """All documents without the sentences that a repeated span covers anywhere but at its first place."""
    got = substring_dedup(table(spark, sf_dir, "documents"))
    ranges = F.array_join(F.transform("cuts", lambda c: F.concat_ws("-", c["start"], c["stop"])), ",")
    return got.select(F.col("id").alias("doc_id"), F.coalesce(F.size("cuts"), F.lit(0)).cast("long").alias("n_cuts"), "n_removed",
                      F.coalesce(ranges, F.lit("")).alias("cuts"), "kept_text")


@register("op10_pii_pseudonyms")
def op10_pii_pseudonyms(spark, sf_dir):
    """All documents with their numbers, dates and mail addresses replaced by keyed pseudonyms (the key is a demonstration one)."""
    got = pseudonymise(table(spark, sf_dir, "documents"), key=b"demonstration key")
    count = lambda k: F.size(F.filter("finds", lambda f: f["kind"] == k)).cast("long").alias(f"n_{k}")
    return got.select(F.col("id").alias("doc_id"), F.size("finds").cast("long").alias("n_finds"), *[count(k) for k in KINDS], "masked_text")


@register("op13_centroids", SQL.CENTROIDS)
def op13_centroids(spark, sf_dir):
    """All embeddings of 64 components around 40 centroids, five rounds."""
    got, centroids = centroid_clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, size=64, scale=256, seed="2")
    return got.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", digest_of(centroids).alias("centroid_sha256"))


@register("op11_spelling", SQL.SPELLING)
def op11_spelling(spark, sf_dir):
    """All words of at least 7 letters and 2 occurrences, with their near words and the form ten times as common."""
    vocab = vocabulary(table(spark, sf_dir, "documents"), min_letters=7, min_count=2, one_in=31)
    return spelling_variants(vocab, times=10)[0].select("word", "form", "root", "n", "n_near", "form_n")


@register("op12_jaccard", SQL.JACCARD)
def op12_jaccard(spark, sf_dir):
    """Components of all documents whose distinct 3-word shingles agree to 90 percent."""
    got, _ = jaccard_components(table(spark, sf_dir, "documents"), k=3, share=90)
    return got.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
