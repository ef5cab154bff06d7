"""Readers with explicit schemas, sinks, and the resumable output ledger."""

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LABELLED_TEXT = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("labels", T.StringType()),
])
QA_TRIPLE = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("ai_answer", T.StringType()),
    T.StructField("reference", T.StringType()),
])
CASE = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("src_words", T.IntegerType()),
     T.StructField("n_docs", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in (
        "case_name", "court", "filed_date", "source",
        "summary_long", "summary_short", "summary_tiny")]
)
PREDICTION_BUNDLE = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("train_size", T.IntegerType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("text", T.StringType()),
        T.StructField("truth", T.ArrayType(T.StringType())),
        T.StructField("tfidf", T.ArrayType(T.StringType())),
        T.StructField("llm", T.ArrayType(T.StringType())),
    ]))),
])


#: The folder of a session in one process that names no shared one.
_OWN: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark, path, schema, multiline: bool = False) -> DataFrame:
    """CSV with a header.  ``multiline`` allows line breaks inside quotes, at the price of one task per file."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", multiline)
            .option("escape", '"').csv(path))


def read_bundle(spark, path, schema=PREDICTION_BUNDLE, multiline: bool = True) -> DataFrame:
    """Nested JSON: header fields repeated beside one row per item.

    Pretty-printed files need ``multiline``, one task per file; files of one object per line can do without.
    """
    raw = spark.read.schema(schema).option("multiLine", multiline).json(path)
    header = [c for c in raw.columns if c != "items"]
    return raw.select(*header, F.explode("items").alias("item")).select(*header, "item.*")


def read_jsonl(spark, path, schema, order_by=None, n=None) -> DataFrame:
    df = spark.read.schema(schema).json(path)
    return df if n is None else df.orderBy(order_by).limit(n)


def read_shards(spark, paths) -> DataFrame:
    return spark.read.parquet(*paths)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options):
    """Sink for parquet, csv, json (one object per line) and orc."""
    if fmt == "csv":
        options = {"header": True, "escape": '"', **options}
    df.write.format(fmt).mode(mode).options(**options).save(path)
    return path


def exists(spark, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_if_absent(df: DataFrame, path: str) -> str:
    """Write unless a finished table is there; one without its ``_SUCCESS`` file is a torn one and is replaced."""
    if not exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return path


def pending(work: DataFrame, done: DataFrame, key) -> DataFrame:
    """Rows whose key has no output yet."""
    return work.join(done.select(key), key, "left_anti")


def append_pending(spark, work, ledger_path, key, process):
    """Process only what the ledger lacks and append it; safe to run again.

    Parquet appends are committed as a whole, so a lost job leaves no half rows.  Only a path that
    isn't there makes a first run; a ledger or a result without the key raises.
    """
    todo = pending(work, spark.read.parquet(ledger_path), key) if exists(spark, ledger_path) else work
    out = process(todo)
    if key not in out.columns:
        raise ValueError(f"the result lacks the key {key!r}, so a second run could not tell what is done")
    out.write.mode("append").parquet(ledger_path)
    return spark.read.parquet(ledger_path)


def bundle(frames: dict) -> DataFrame:
    """Union named frames by column name; missing columns become NULL."""
    out = None
    for name, df in frames.items():
        df = df.withColumn("dataset", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_bundle(df: DataFrame, path: str) -> str:
    """One folder per dataset name, so that reading one of them prunes the rest."""
    df.write.mode("overwrite").partitionBy("dataset").parquet(path)
    return path


def scratch(spark, label: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Executors of a cluster share no local folder, so without that setting only a
    session whose tasks all run in this process may go on, in a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if "base" not in _OWN:
            _OWN["base"] = tempfile.mkdtemp(prefix="gaugeline-")
            atexit.register(shutil.rmtree, _OWN["base"], ignore_errors=True)
        base = _OWN["base"]
    return os.path.join(base, "gaugeline", f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write a result that several steps read, and continue from the files.

    It is computed once, lost executors cost nothing, and Spark plans the next
    joins with its real size.  ``by`` makes one folder per value, which a filter
    on that column prunes.
    """
    path = scratch(df.sparkSession, label)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    # an empty table in folders leaves no file to take the schema from
    out = df.sparkSession.read.schema(df.schema).parquet(path) if by else df.sparkSession.read.parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by ``stored`` that nothing will read again."""
    path = getattr(df, "stored_at", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
