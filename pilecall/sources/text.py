"""Text sources and sinks (A1-A10): BED, FASTA, SAM, sample names, call tables.

All scans are ``spark.read.text`` plus column expressions, so they split
across files and blocks like any text source. BAM/CRAM decoding is not
built (see README); alignments come as SAM text or Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pilecall.fixtures import BLOCK

# Sample-name patterns of the original tool, in its order.
SAMPLE_PATTERN = r"([^\/\._]+).sorted[^\/]*.bam"
SAMPLE_PATTERN2 = r"([^\/]+)[_\.][^\/]*bam"


def _int(c):
    return F.expr(f"try_cast({c} AS BIGINT)")


def scan_regions(spark: SparkSession, path: str) -> DataFrame:
    """A1: tab-separated chr, start, end[, gene]; a missing gene becomes ''."""
    f = F.split(F.col("value"), "\t")
    df = spark.read.text(path).select(f.alias("f"))
    return df.select(
        F.col("f")[0].alias("chr"),
        _int("f[1]").alias("region_start"),
        _int("f[2]").alias("region_end"),
        F.coalesce(F.get(F.col("f"), 3), F.lit("")).alias("gene"),
    )


def scan_bed(spark: SparkSession, path: str, delimiter: str = "\t", zero_based: bool | None = None) -> DataFrame:
    """A2: BED lines without '#', 'browser', 'track' headers.

    Lines with more than 7 columns whose inner span lies inside the outer span
    are amplicons (istart, iend from columns 7 and 8); when any line is one,
    the file is an amplicon BED and coordinates are zero-based unless
    ``zero_based`` says otherwise (one ``bool_or`` over the file).
    """
    lines = spark.read.text(path).where(~F.col("value").rlike("^(#|browser|track)"))
    f = F.split(F.col("value"), delimiter)
    df = lines.select(f.alias("f"))
    df = df.select(
        F.col("f")[0].alias("chr"),
        _int("f[1]").alias("start"), _int("f[2]").alias("end"),
        F.coalesce(F.get(F.col("f"), 3), F.col("f")[0]).alias("gene"),
        _int("get(f, 6)").alias("istart"), _int("get(f, 7)").alias("iend"),
        F.size("f").alias("ncol"),
    )
    is_amp = (F.col("ncol") > 7) & (F.col("istart") >= F.col("start")) & (F.col("iend") <= F.col("end"))
    df = df.withColumn("is_amplicon", F.coalesce(is_amp, F.lit(False)))
    mode = df.agg(F.bool_or("is_amplicon").alias("amplicon_mode"))
    df = df.join(F.broadcast(mode), how="cross")  # one row
    zb = F.col("amplicon_mode") if zero_based is None else F.lit(zero_based)
    shift = F.when(zb & (F.col("start") < F.col("end")), 1).otherwise(0)
    return df.select(
        "chr", (F.col("start") + shift).alias("region_start"), F.col("end").alias("region_end"), "gene",
        (F.col("istart") + F.when(F.col("amplicon_mode") & zb & (F.col("start") < F.col("end")), 1).otherwise(0)).alias("istart"),
        "iend", "is_amplicon", "amplicon_mode",
    )


def scan_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A4: SAM text -> read rows (header lines skipped; NM and SA tags extracted)."""
    body = spark.read.text(path).where(~F.col("value").startswith("@"))
    f = F.split(F.col("value"), "\t")
    df = body.select(f.alias("f"), F.input_file_name().alias("path"))
    nm = F.expr("try_cast(regexp_extract(array_join(slice(f, 12, greatest(size(f) - 11, 0)), '\\t'), '(^|\\t)NM:i:(-?\\\\d+)', 2) AS INT)")
    sa = F.expr("nullif(regexp_extract(array_join(slice(f, 12, greatest(size(f) - 11, 0)), '\\t'), '(^|\\t)SA:Z:([^\\t]*)', 2), '')")
    rname = F.col("f")[2]
    rnext = F.col("f")[6]
    return df.select(
        F.col("f")[0].alias("read_name"),
        _int("f[1]").cast("int").alias("flag"),
        rname.alias("chr"),
        _int("f[3]").alias("start_pos"),
        _int("f[4]").cast("int").alias("mapq"),
        F.col("f")[5].alias("cigar"),
        F.when(rnext == "=", rname).when(rnext == "*", F.lit(None)).otherwise(rnext).alias("mate_chr"),
        _int("f[7]").alias("mate_start"),
        _int("f[8]").cast("int").alias("insert_size"),
        F.col("f")[9].alias("seq"),
        F.col("f")[10].alias("qual"),
        nm.alias("nm"),
        sa.alias("sa_tag"),
        "path",
    )


def scan_alignments(spark: SparkSession, files: str, names: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """The reads of several files in one scan, with the sample that they belong to.

    ``files`` holds paths joined by ':' for one sample, and two such lists joined by '|' for
    a tumor and its normal. All files are read by one scan; a file's sample follows from its
    path. ``names`` are the samples' names (default 'tumor' and 'normal').
    """
    groups = [[path for path in part.split(":") if path] for part in files.split("|")]
    if len(groups) > 2 or not all(groups):
        raise ValueError("one list of files, or two separated by '|'")
    sample = None
    for paths, name, default in zip(groups, names, ("tumor", "normal")):
        inside = None
        for path in paths:
            # a path names a file or a folder of files; schemes and slashes in front of it differ by file system
            here = F.col("path").contains(path.rstrip("/") + "/") | F.col("path").endswith(path)
            inside = here if inside is None else inside | here
        sample = F.when(inside, F.lit(name or default)) if sample is None else sample.when(inside, F.lit(name or default))
    return scan_sam(spark, [path for paths in groups for path in paths]).withColumn("sample", sample)


def contig_lengths(spark: SparkSession, path: str) -> DataFrame:
    """A5: (chr, length) from the @SQ lines of a SAM header."""
    sq = spark.read.text(path).where(F.col("value").startswith("@SQ"))
    return sq.select(
        F.regexp_extract("value", r"\tSN:(\S+)", 1).alias("chr"),
        F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length"),
    )


def sample_name(df: DataFrame, path_col: str = "path", name: str | None = None, regexp: str | None = None) -> DataFrame:
    """A10: explicit name, else the regexp (or the '.sorted' pattern), else the fallback pattern."""
    if name is not None:
        return df.withColumn("sample_name", F.lit(name))
    first = regexp or SAMPLE_PATTERN
    a = F.regexp_extract(F.col(path_col), first, 1)
    b = F.regexp_extract(F.col(path_col), SAMPLE_PATTERN2, 1)
    return df.withColumn("sample_name", F.when(a != "", a).when(b != "", b))


def paired_sample_names(name: str | None) -> tuple[str | None, str | None]:
    """A10 pair form: 'tumor|normal'; a single name gets '<name>_match' as the second."""
    if name is None:
        return None, None
    parts = name.split("|")
    return parts[0], parts[1] if len(parts) > 1 else parts[0] + "_match"


def scan_fasta(spark: SparkSession, path: str, upper: bool = False) -> DataFrame:
    """A3: FASTA text -> ``ref_blocks(chr, block, block_start, seq)``.

    Lines are ordered within their file split; a split is cut into sections at its
    headers. One row per section, a few for each contig and split, carries contig
    names and base counts from split to split, so a line's position is its section's
    offset and the running length within it. A line of any width is cut into the
    blocks that it touches.
    """
    lines = spark.read.text(path).select(
        F.trim("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line_no"))
    split = ["file", "split"]
    in_split = Window.partitionBy(*split).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_head = F.col("line").startswith(">")
    lines = lines.withColumn("section", F.sum(is_head.cast("int")).over(in_split))
    lines = lines.withColumn("bases", F.when(is_head, 0).otherwise(F.length("line")).cast("long"))
    name = F.max(F.when(is_head, F.regexp_extract("line", r"^>(\S+)", 1)))
    sections = lines.groupBy(*split, "section").agg(name.alias("name"), F.sum("bases").alias("total"))
    in_file = Window.partitionBy("file").orderBy("split", "section").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sections = sections.withColumn("chr", F.last("name", ignorenulls=True).over(in_file))
    sections = sections.withColumn("contig", F.sum(F.col("name").isNotNull().cast("int")).over(in_file))
    in_contig = Window.partitionBy("file", "contig").orderBy("split", "section").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sections = sections.withColumn("before", F.sum("total").over(in_contig) - F.col("total"))
    in_section = Window.partitionBy(*split, "section").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    body = lines.withColumn("at", F.sum("bases").over(in_section) - F.col("bases")).where(F.col("bases") > 0)
    body = body.join(sections.select(*split, "section", "chr", "before"), [*split, "section"]).where(F.col("chr").isNotNull())
    body = body.withColumn("start", F.col("before") + F.col("at"))  # from 0
    last = F.floor((F.col("start") + F.col("bases") - 1) / BLOCK)
    cut = body.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), last)))
    lo = F.greatest(F.col("start"), F.col("block") * BLOCK)
    hi = F.least(F.col("start") + F.col("bases"), (F.col("block") + 1) * BLOCK)
    text = F.upper(F.col("line")) if upper else F.col("line")
    piece = F.substring(text, (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int"))
    parts = cut.select("chr", "block", F.struct(lo.alias("lo"), piece.alias("piece")).alias("part"))
    blocks = parts.groupBy("chr", "block").agg(  # at most one part for each base of the block
        F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda x: x["piece"]), "").alias("seq"))
    return blocks.select("chr", "block", (F.col("block") * BLOCK + 1).alias("block_start"), "seq")


def write_calls(calls: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Partitioned output (no driver-side merge); TSV gets a header of all columns."""
    w = calls.sortWithinPartitions("chr", "start") if "start" in calls.columns else calls
    if fmt == "parquet":
        w.write.mode("overwrite").partitionBy("chr").parquet(path)
    else:
        w.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def read_calls(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path)
