"""Sources and sinks: explicit schemas in, Parquet and JSON lines out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragstone.functions import text
from ragstone.operators import chunking
from ragstone.operators import golden as records

RAW_PAGE = "base_path string, title string, details struct<body:string, parts:array<struct<slug:string, body:string>>>"
GOLDEN = "id string, question string, ground_truth string, source_ids array<string>, difficulty string, added_in string"
CANDIDATE = "candidate_id string, status string, question string, ground_truth string, source_ids array<string>, difficulty string, source_excerpt string, notes string"
DECISION = "candidate_id string, decision string, question string, ground_truth string"
MANIFEST = "search_query string, count long, pages array<struct<base_path:string, url:string, title:string, fetched_at:string, content_hash:string>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw page JSON, one object per file."""
    return spark.read.schema(RAW_PAGE).json(path, multiLine=True)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1) and line of the lines with content. For files that people keep: each is read whole."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", r"\r?\n").alias("all"))
    return whole.select("file", F.posexplode("all").alias("at", "line")).filter("trim(line) <> ''").select("file", (F.col("at") + 1).alias("line_no"), "line")


def golden(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Golden records with line_no, their place in the file; ValueError for the first broken rules if ``check``."""
    rows = lines(spark, path).select(F.from_json("line", GOLDEN, {"mode": "FAILFAST"}).alias("r"), "line_no").select("r.*", "line_no")
    if check:
        records.refuse(records.violations(rows), path)
    return rows


def append_golden(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """The golden set at ``path``, a folder of JSON lines, with ``new`` in it; what breaks a rule is refused before it is written."""
    fields = ["id", "question", "ground_truth", "source_ids", "difficulty", "added_in"]
    old = golden(spark, path, check=False)
    records.refuse(records.violations(old.select(fields).unionByName(new.select(fields))), path)
    new.select(fields).coalesce(1).write.mode("append").json(path)
    return golden(spark, path)


def review_queue(spark: SparkSession, path: str) -> DataFrame:
    """Candidates with the defaults of missing fields; ValueError for a status that is none."""
    rows = spark.read.schema(CANDIDATE).json(path, mode="FAILFAST")
    rows = rows.withColumns({"status": F.coalesce("status", F.lit("pending")), "difficulty": F.coalesce("difficulty", F.lit("single_hop")), "source_ids": F.coalesce("source_ids", F.array().cast("array<string>"))})
    records.refuse(rows.filter(~F.col("status").isin(*records.STATUSES)).select("candidate_id", "status"), path)
    return rows


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """Human decisions with line_no; lines that are no JSON object or lack an id say so in ``_corrupt`` for the caller to refuse."""
    schema = DECISION + ", _bad string"
    rows = lines(spark, path).select(F.from_json("line", schema, {"columnNameOfCorruptRecord": "_bad"}).alias("r"), "line_no").select("r.*", "line_no")
    fault = F.when(F.col("_bad").isNotNull(), "no JSON").when(F.coalesce("candidate_id", F.lit("")) == "", "no candidate_id")
    return rows.withColumn("_corrupt", F.concat(F.lit("line "), F.col("line_no").cast("string"), F.lit(": "), fault)).drop("_bad")


def write_manifest(pages: DataFrame, path: str, search_query: str = "") -> None:
    """One JSON object: search_query, count and the pages in order of base_path. A manifest is made for people to compare, of some hundred pages."""
    fields = ["base_path", "url", "title", "fetched_at", "content_hash"]
    gathered = F.array_sort(F.collect_list(F.struct(*fields)))
    pages.agg(F.lit(search_query).alias("search_query"), F.count(F.lit(1)).alias("count"), gathered.alias("pages")).coalesce(1).write.mode("overwrite").json(path)


def manifest_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(path, multiLine=True).select(F.inline("pages"))


def raw_name(base_path: Column) -> Column:
    """The file that holds the raw page of ``base_path``."""
    flat = F.replace(F.regexp_replace(base_path, "^/+|/+$", ""), F.lit("/"), F.lit("__"))
    return F.concat(F.when(flat == "", "_root").otherwise(flat), F.lit(".json"))


def corpus(spark: SparkSession, manifest: str, raw_dir: str) -> DataFrame:
    """base_path, title, url and body of the manifest's pages from the raw cache; pages without a body go.

    Files are found by their names; ValueError names pages that the cache lacks. The root page counts
    as lacking: its file begins with an underscore, and Spark's readers pass over such files.
    """
    wanted = manifest_pages(spark, manifest).select(F.col("base_path").alias("asked"), "url").withColumn("name", raw_name(F.col("asked")))
    name = lambda path: F.url_decode(F.element_at(F.split(path, "/"), -1))
    cached = spark.read.format("binaryFile").load(f"{raw_dir}/*.json").select(name(F.col("path")).alias("name"))
    records.refuse(wanted.join(cached, "name", "left_anti").select("asked"), "not in the cache")
    raw = spark.read.schema(RAW_PAGE).json(f"{raw_dir}/*.json", multiLine=True).withColumn("name", name(F.col("_metadata.file_path")))
    body = text.normalise_text(text.strip_html(chunking.raw_body(F.col("details"))))
    rows = wanted.join(raw, "name").select(F.coalesce("base_path", "asked").alias("base_path"), F.coalesce("title", F.lit("")).alias("title"), "url", body.alias("body"))
    return rows.filter("body <> ''")


def save_index(chunks: DataFrame, path: str, meta: dict[str, str]) -> None:
    """Chunks with their vectors, keyed by id, and a one-row table of what made them."""
    chunks.write.mode("overwrite").parquet(f"{path}/chunks")
    save_meta(chunks.sparkSession, path, meta)


def save_meta(spark: SparkSession, path: str, meta: dict[str, str]) -> None:
    spark.createDataFrame([meta]).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_index(spark: SparkSession, path: str, expect: dict[str, str] | None = None) -> DataFrame:
    """The index at ``path``; raises if it was made by something other than ``expect``."""
    meta = spark.read.parquet(f"{path}/meta").first().asDict()
    wrong = {k: (meta.get(k), v) for k, v in (expect or {}).items() if meta.get(k) != v}
    if wrong:
        raise ValueError(f"the index does not fit: {wrong}")
    return spark.read.parquet(f"{path}/chunks")


def write_lines(rows: DataFrame, path: str, mode: str = "append") -> None:
    rows.write.mode(mode).json(path)
