"""Landed report files: what each one is, which month it is for, and which are current."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from bazaarlens.functions.parsing import MONTH_NAMES

# --- fixed values: file-name keys in match order, letter folding, damaged spellings ---
REPORT_KEYS = (("tum-siparisler", "orders"), ("satis-raporu", "sales"), ("siparis-dagilim", "distribution"),
               ("magaza", "store"), ("operasyon", "ops"), ("reklam", "ads"))
FOLD_FROM, FOLD_TO = "ıİşŞğĞüÜöÖçÇ", "iIsSgGuUoOcC"
DAMAGED = (("may_s", "mayis"), ("a_ustos", "agustos"), ("eyl_l", "eylul"), ("sat__", "satis"), ("sipari_-da__l_m", "siparis-dagilim"))
MONTHLY_REPORTS = ("sales", "orders", "distribution")
DEFAULT_YEAR = 2026
# --- end of fixed values ---

COMBINING = "[̧̆̇̈]"  # marks of letters written in decomposed form


def normal_name(path: Column) -> Column:
    """Base name in plain lower-case letters, with damaged spellings mended."""
    base = F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), COMBINING, "")
    name = F.lower(F.translate(base, FOLD_FROM, FOLD_TO))
    for bad, good in DAMAGED:
        name = F.replace(name, F.lit(bad), F.lit(good))
    return name


def report_type(name: Column) -> Column:
    """First key found in the normalised name decides; null for unknown files."""
    chain = None
    for key, kind in REPORT_KEYS:
        chain = F.when(name.contains(key), kind) if chain is None else chain.when(name.contains(key), kind)
    return chain


def report_period(name: Column, default_year: int = DEFAULT_YEAR) -> Column:
    """First day of the month named in the file; the year from 'month-20xx', else the default."""
    chain = None
    for i, month in enumerate(MONTH_NAMES):
        hit = name.rlike(f"(^|[-_ ]){month}([-_ ]|$)") | name.startswith(month)
        year = F.regexp_extract(name, f"{month}[-_ ](20[0-9][0-9])([-_ ]|$)", 1)
        value = F.make_date(F.when(year != "", year.cast("int")).otherwise(F.lit(default_year)), F.lit(i + 1), F.lit(1))
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain


def report_file_catalog(files: DataFrame, path_column: str = "file_name", default_year: int = DEFAULT_YEAR) -> DataFrame:
    """Report type and period of every known file; unknown files are left out."""
    name = normal_name(F.col(path_column))
    return (
        files.withColumn("_name", name)
        .withColumns({"report_type": report_type(F.col("_name")), "period": report_period(F.col("_name"), default_year)})
        .drop("_name").where(F.col("report_type").isNotNull())
    )


def logical_file(path: Column) -> Column:
    """The report file a physical file belongs to: itself, or the folder that an engine wrote part files into."""
    plain = F.regexp_replace(F.url_decode(path), "^([a-z0-9]+):/+", "$1:/")
    return F.regexp_replace(plain, "/part-[^/]*$", "")


def landed_files(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """Names, times and sizes of the report files in a folder or under several paths, listed without reading them."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    parts = listed.select(logical_file(F.col("path")).alias("file_name"), "modificationTime", "length", F.col("path").endswith(".parquet").alias("parquet"))
    return parts.groupBy("file_name").agg(F.max("modificationTime").alias("landed_at"), F.sum("length").alias("bytes"), F.bool_or("parquet").alias("parquet"))


# the first record of a CSV text, a cell of it (followed by a comma), and how much of a file is looked at for it
RECORD = r'^((?:[^"\r\n]++|"(?:[^"]++|"")*+")*+)'
CELL = r'("(?:[^"]++|"")*+"|[^,]*+),'
HEAD_BYTES = 1 << 18


def csv_header(content: Column) -> Column:
    """Column names of a CSV file from its bytes: the cells of its first record."""
    text = F.regexp_replace(F.make_valid_utf8(F.substring(content, 1, HEAD_BYTES).cast("string")), "^\ufeff", "")
    cells = F.regexp_extract_all(F.concat(F.regexp_extract(text, RECORD, 1), F.lit(",")), F.lit(CELL), F.lit(1))
    return F.transform(cells, lambda c: F.when(c.startswith('"'), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def inspected_files(spark: SparkSession, texts: list[str], tables: list[str]) -> DataFrame:
    """(file_name, header, digest) of report files, CSV `texts` and parquet `tables`, by one job however many they are.

    A file is read by one task for its digest and the names of its columns: a CSV's first record, a parquet file's
    footer, or the first bytes of a compressed CSV (the one place where Python reads a file, as Spark gives a footer only
    by a job each and unpacks no bytes). A report written in
    part files has the header of its first, and a digest of theirs.
    """
    def heads(batches):
        import zlib

        import pyarrow as pa

        for batch in batches:
            starts = [zlib.decompressobj(31).decompress(start.as_py(), HEAD_BYTES) for start in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts, pa.binary()), batch.column(2)], names=["path", "start", "digest"])

    def footers(batches):
        import hashlib
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                data = content.as_buffer()
                names = pq.read_schema(io.BytesIO(data)).names
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([names], pa.list_(pa.string())), pa.array([hashlib.sha256(data).hexdigest()])], names=["path", "header", "digest"])

    def read(paths: list[str]) -> DataFrame:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "content")

    found = []
    if texts:
        starts = read(texts).select("path", F.substring("content", 1, HEAD_BYTES).alias("start"), F.sha2("content", 256).alias("digest"))
        packed = F.col("path").endswith(".gz")
        unpacked = starts.where(packed).mapInArrow(heads, "path string, start binary, digest string")
        found.append(starts.where(~packed).unionByName(unpacked).select("path", csv_header(F.col("start")).alias("header"), "digest"))
    if tables:
        found.append(read(tables).mapInArrow(footers, "path string, header array<string>, digest string"))
    parts = reduce(DataFrame.unionByName, found).withColumn("file_name", logical_file(F.col("path")))
    per_file = parts.groupBy("file_name").agg(F.min(F.struct("path", "header"))["header"].alias("header"), F.array_sort(F.collect_list(F.struct("path", "digest"))).alias("parts"))
    digests = F.transform("parts", lambda p: p["digest"])
    return per_file.select("file_name", "header", F.when(F.size("parts") == 1, digests[0]).otherwise(F.sha2(F.concat_ws("", digests).cast("binary"), 256)).alias("digest"))


def upload_manifest(rows: DataFrame, uploaded_at: Column, path_column: str = "file_name") -> DataFrame:
    """Rows per source file with its type, period and load time. `rows` carries the source file of each row."""
    # the name is also taken as an aggregate: it is then read once per file, not once per row
    counted = rows.groupBy(path_column).agg(F.count(F.lit(1)).alias("row_count"), F.max(path_column).alias("_path")).drop(path_column)
    return report_file_catalog(counted, "_path").select(
        F.regexp_extract("_path", r"([^/\\]+)$", 1).alias("file_name"), "report_type",
        F.coalesce(F.date_format("period", "yyyy-MM-dd"), F.lit("")).alias("period"), "row_count", uploaded_at.alias("uploaded_at"))


def file_slot() -> Column:
    """What a file stands for: its month, for ads the one list, for store and operations files, which hold date ranges, itself."""
    return F.when(F.col("report_type").isin(*MONTHLY_REPORTS), F.coalesce(F.date_format("period", "yyyy-MM"), F.lit(""))).when(
        F.col("report_type") == "ads", F.lit("")).otherwise(F.col("file_name"))


def active_files(catalog: DataFrame) -> DataFrame:
    """The files that count: a newer file replaces an older one of its type and month (ads: of its type).

    Store and operations files all stay. What did not pass the gate must not be in `catalog`: it replaces nothing.
    """
    newest = F.row_number().over(W.partitionBy("report_type", "_slot").orderBy(F.desc("landed_at"), F.desc("file_name")))
    return catalog.withColumn("_slot", file_slot()).withColumn("_rank", newest).where("_rank = 1").drop("_slot", "_rank")
