"""Line dedup with keep bitmaps, DataFrame functions only.

Line keys (128-bit hashes) are range-partitioned with their rows sorted by document and position, and a window
streams each key's documents: the last document keeps its lines, the others lose theirs if at least ``min_docs``
documents hold the key. A key that may hold a large share of all lines can't be one window
group: keys above 1/SHARES of the lines (fewer than SHARES keys) are counted map-side instead and
their verdicts broadcast. What comes back per document is a compressed bitmap of the kept lines, not
text; ``apply_bitmaps`` cuts the texts with it in one join.

Defined results: null or empty text is one empty line; a null id is a document of its own, below all ids; rows that share
an id count as one document; identical rows share a result; a text without drops has a null
bitmap; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrospark.llm.common import SHARES, hash128, row_key, written

_BLANKS = " \t\n\x0b\x0c\r"
#: bits turned into hex at once (conv works on 64-bit numbers)
_STEP = 60


def line_key(line: Column) -> Column:
    """The line stripped of [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def long_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``_k1, _k2, id, pos, h1, h2``: the lines whose keys are long enough to count."""
    d = docs.select(*row_key(id_col, text_col), F.col(id_col).cast("long").alias("id"),
                    F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("pos", "line"))
    stripped = F.btrim("line", F.lit(_BLANKS))
    return d.filter(F.char_length(stripped) >= min_chars).select("_k1", "_k2", "id", "pos", *hash128(line_key(F.col("line")), "h1", "h2"))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """``_k1, _k2, pos`` of the lines that go (``lines`` is written)."""
    total = lines.count()
    sizes = lines.groupBy("h1", "h2").agg(F.count("*").alias("c")).filter(F.col("c") * SHARES > total).select("h1", "h2")
    heavy = F.broadcast(written(sizes, "heavy-lines"))                       # fewer than SHARES rows
    # heavy keys: one row per (key, id) after map-side combination, then a count per key
    docs_of = lines.join(heavy, ["h1", "h2"], "left_semi").groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
    verdict = written(docs_of.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id").alias("last"))
                      .filter(F.col("n_docs") >= min_docs), "heavy-verdicts")
    gone = (lines.join(F.broadcast(verdict), ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("last")))
            .select("_k1", "_k2", "pos"))
    # all others: range exchange on the key, secondary sort, one streaming pass
    by_key = Window.partitionBy("h1", "h2")
    others = (lines.join(heavy, ["h1", "h2"], "left_anti")
              .repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", F.col("id").desc_nulls_last(), "pos")
              .withColumn("nth", F.dense_rank().over(by_key.orderBy(F.col("id").desc_nulls_last())))
              .withColumn("n_docs", F.max("nth").over(by_key)))
    return gone.unionByName(others.filter((F.col("nth") > 1) & (F.col("n_docs") >= min_docs)).select("_k1", "_k2", "pos"))


def pack_bits(dropped: Column) -> Column:
    """Binary bitmap of kept lines from the sorted array of dropped positions.

    Bit i (from the left) is 1 if line i stays. It ends with the last dropped line's byte, filled up with ones:
    lines beyond the bitmap stay.
    """
    before = F.concat(F.array(F.lit(-1)), F.slice(dropped, 1, F.size(dropped) - 1))
    bits = F.array_join(F.zip_with(dropped, before, lambda d, p: F.concat(F.repeat(F.lit("1"), d - p - 1), F.lit("0"))), "")
    padded = F.concat(bits, F.repeat(F.lit("1"), F.pmod(-F.length(bits), F.lit(8))))
    pieces = F.regexp_extract_all(padded, F.lit(f".{{1,{_STEP}}}"), F.lit(0))
    return F.unhex(F.array_join(F.transform(pieces, lambda x: F.lpad(F.conv(x, 2, 16), (F.length(x) / 4).cast("int"), F.lit("0"))), ""))


def keep_flags(bitmap: Column, n_lines: Column) -> Column:
    """Array of '1' (stays) and '0' (goes), one per line, from a bitmap made by ``pack_bits``."""
    bits = F.array_join(F.transform(F.split(F.hex(bitmap), ""), lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")
    return F.split(F.substr(F.concat(bits, F.repeat(F.lit("1"), n_lines)), F.lit(1), n_lines), "")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_k1, _k2, n_dropped, bitmap``: one row per document that loses lines (key: ``row_key(id, text)``)."""
    lines = written(long_lines(docs, id_col, text_col, min_chars), "lines")
    drops = repeated_lines(lines, min_docs).groupBy("_k1", "_k2").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
    return drops.select("_k1", "_k2", F.size("dropped").cast("long").alias("n_dropped"), pack_bits(F.col("dropped")).alias("bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text`` (whole), ``n_lines, n_dropped, bitmap, kept_text`` of every document."""
    d = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    got = d.join(bitmaps, ["_k1", "_k2"], "left")
    lines = F.split("text", "\n")
    left = F.filter(F.arrays_zip(lines.alias("line"), keep_flags(F.col("bitmap"), F.size(lines)).alias("stays")), lambda z: z["stays"] == "1")
    kept = F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda z: z["line"]), "\n"))
    return got.select("id", "text", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                      "bitmap", kept.alias("kept_text"))


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs, id_col, text_col), id_col, text_col)
