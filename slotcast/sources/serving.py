"""The serving side: JSON records, chunked delivery, the published pair and its queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from slotcast.config import Settings
from slotcast.functions.numbers import finite_or_null
from slotcast.functions.ranking import with_row_index
from slotcast.schemas import KPI_KEY, KPIS, PREDICTION_KEY, PREDICTIONS
from slotcast.session import materialize, scratch_path
from slotcast.sources.store import TableStore

# ---- fixed values -------------------------------------------------------------------
RECORD_DIGITS = 10
RECORD_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS"
# ---- end of fixed values ------------------------------------------------------------


def to_records(
    df: DataFrame, name: str = "record", columns: list[str] | None = None
) -> DataFrame:
    """Add each row, or some columns of it, as a JSON document: no NaN or infinity, nulls kept,
    ISO times."""

    def value(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(finite_or_null(c), RECORD_DIGITS)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, RECORD_TIME)
        return c.alias(field.name)

    document = F.struct(*(value(df.schema[c]) for c in columns or df.columns))
    return df.withColumn(name, F.to_json(document, {"ignoreNullFields": "false"}))


def with_chunks(df: DataFrame, key: list[str], settings: Settings) -> DataFrame:
    """Rows numbered in key order and cut into chunks of ``chunk_rows``.

    Equal rows, as a resend leaves them, become one; rows that differ under one key are refused.
    One shuffle brings rows of one key side by side, where copies are dropped and other values found.
    The rest is written before it is numbered, as the range shuffle looks at its input twice.
    """
    rest = [c for c in df.columns if c not in key]
    group = W.partitionBy(*key).orderBy(*(rest or key))
    again = F.row_number().over(group) > 1
    own = F.struct(*(rest or key))
    equal = F.lag(own).over(group).eqNullSafe(own)
    marked = df.withColumns({"_copy": again & equal, "_differs": again & ~equal})
    rows = materialize(marked.where(~F.col("_copy")).drop("_copy"), "distinct")
    if not rows.where("_differs").isEmpty():
        raise RepeatedKeyError("nothing published: rows repeat a key with other values")
    numbered = with_row_index(rows.drop("_differs"), key)
    size = F.lit(settings.chunk_rows)
    return numbered.withColumn("chunk_id", F.floor(F.col("row_index") / size).cast("bigint"))


def refuse_repeated(rows: DataFrame, key: list[str], name: str) -> None:
    repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise RepeatedKeyError(f"nothing published: {name} repeat a key with other values")


class DeliveryError(Exception):
    """Chunks that could not be sent; those that were are in the ledger."""


class Ledger:
    """Delivered chunks, an append-only table: digest of the content, chunk_id, rows.

    A chunk counts as delivered by what is in it, so a delivery that was stopped, or a table that
    changed in part, sends only what the receiver has not seen.
    """

    SCHEMA = "digest string, chunk_id bigint, rows bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.SCHEMA)

    def missing(self, chunks: DataFrame) -> DataFrame:
        """Of ``chunks`` (digest, ...) those that were not delivered."""
        return chunks.join(self.read().select("digest").distinct(), "digest", "left_anti")

    def add(self, chunks: DataFrame) -> None:
        columns = [c.split()[0] for c in self.SCHEMA.split(", ")]
        chunks.select(*columns).write.mode("append").parquet(self.path)


def digests(records: DataFrame) -> DataFrame:
    """digest, chunk_id, rows of each chunk: two 64-bit sums over its rows and their places."""
    own = F.xxhash64("row_index", "record")
    other = F.xxhash64("record", "row_index").cast("decimal(38,0)")
    content = F.concat_ws("|", "chunk_id", "rows", "mixed", "total")
    return (
        records.groupBy("chunk_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(own).alias("mixed"), F.sum(other).alias("total"))
        .select(F.sha2(content, 256).alias("digest"), "chunk_id", "rows")
    )


def deliver(
    df: DataFrame,
    key: list[str],
    settings: Settings,
    send: Callable[[int, list[str]], None],
    ledger: Ledger | None = None,
    attempts: int = 3,
) -> dict[str, int]:
    """Send every chunk that the ledger lacks as a list of JSON records, from the executors.

    A send that raises does not stop its task: the chunks beside it go into the ledger, and the
    next attempt sends only the others. What is still missing after the last one raises. An
    executor that dies takes the notes of its running task with it, so only that task's chunks
    can arrive twice. Returns how many chunks were sent now and how many had been before.
    """
    spark = df.sparkSession
    ledger = ledger or Ledger(spark, scratch_path(spark, "ledger"))
    columns = ["chunk_id", "row_index", "record"]
    cut = with_chunks(df, key, settings)
    # Documents are made where they are read: rows travel as they are, several times shorter.
    records = to_records(cut, columns=df.columns).select(*columns)
    chunks = materialize(digests(records), "chunks")
    total = chunks.count()
    due = materialize(ledger.missing(chunks), "due")
    before = total - due.count()

    def send_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk_id, failure = int(pdf["chunk_id"].iloc[0]), None
        try:
            send(chunk_id, pdf.sort_values("row_index")["record"].tolist())
        except Exception as error:  # goes back as a value, beside what its task did send
            failure = f"{type(error).__name__}: {error}"
        return pd.DataFrame({"chunk_id": [chunk_id], "failure": [failure]})

    failed = None
    for _ in range(attempts):
        rows = cut.join(due.select("chunk_id"), "chunk_id", "left_semi").repartition("chunk_id")
        documents = to_records(rows, columns=df.columns).select(*columns)
        answers = documents.groupBy("chunk_id").applyInPandas(
            send_chunk, "chunk_id bigint, failure string"
        )
        done = materialize(due.join(answers, "chunk_id"), "answers")
        ledger.add(done.where(F.col("failure").isNull()))
        due = done.where(F.col("failure").isNotNull()).drop("failure")
        failed = done.where(F.col("failure").isNotNull()).orderBy("chunk_id").first()
        if failed is None:
            return {"sent": total - before, "skipped": before}
    raise DeliveryError(
        f"{due.count()} of {total} chunks were not delivered in {attempts} attempts; "
        f"chunk {failed['chunk_id']}: {failed['failure']}"
    )


class EmptyStagingError(Exception):
    """A table of the pair has no rows; nothing was published."""


class RepeatedKeyError(Exception):
    """Rows of a table differ but share a key; nothing was published."""


def publish_pair(
    store: TableStore, kpis: DataFrame, predictions: DataFrame, run_id: str
) -> DataFrame:
    """Load both tables as candidates, then swap both at once. Returns their row counts.

    Equal rows, as a resend leaves them, become one; rows that differ under one key are refused.
    Predictions are laid out for the serving query: a folder per kind, rows clustered by
    site and time.
    """
    staged_kpis = store.write("kpis", kpis.distinct(), run_id)
    staged = store.write(
        "predictions", predictions.distinct(), run_id, partition_by=["row_kind"],
        sort_by=["park_name", "ts_local"],
    )
    for name, rows, key in (("kpis", staged_kpis, KPI_KEY), ("predictions", staged, PREDICTION_KEY)):
        try:
            refuse_repeated(rows, key, name)
        except RepeatedKeyError:
            store.discard("kpis", "predictions")
            raise
    counts = staged_kpis.agg(F.count(F.lit(1)).alias("kpis")).withColumn(
        "predictions", staged.agg(F.count(F.lit(1))).scalar()
    )
    n = counts.first()
    if not n["kpis"] or not n["predictions"]:
        store.discard("kpis", "predictions")
        raise EmptyStagingError(f"nothing published: {n.asDict()}")
    store.promote("kpis", "predictions")
    return counts


def fetch_pair(store: TableStore) -> tuple[DataFrame, DataFrame]:
    """Both tables as one pointer row names them."""
    kpis, predictions = store.read_many(
        "kpis", "predictions", schemas={"kpis": KPIS, "predictions": PREDICTIONS}
    )
    return kpis, predictions


def save_pair(kpis: DataFrame, predictions: DataFrame, folder: str) -> None:
    kpis.write.mode("overwrite").parquet(f"{folder}/kpis")
    predictions.write.mode("overwrite").parquet(f"{folder}/predictions")


def load_pair(spark, folder: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.read.schema(KPIS).parquet(f"{folder}/kpis"),
        spark.read.schema(PREDICTIONS).parquet(f"{folder}/predictions"),
    )


def serve(
    predictions: DataFrame,
    equal: dict[str, str] | None = None,
    columns: Iterable[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Equality filters, a projection and a limit, in site and time order when limited."""
    rows = predictions
    for name, value in (equal or {}).items():
        rows = rows.where(F.col(name) == value)
    if limit is not None:
        rows = rows.orderBy("park_name", "ts_local", "ride_key", "model_name").limit(limit)
    return rows.select(*columns) if columns else rows
