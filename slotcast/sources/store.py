"""Table versions and the pointer that says which of them serve.

A version of a table is an immutable Parquet directory ``<root>/<table>/run=<id>``. The
pointer is a small append-only table: each row names the version of every table and the
serving model, and the newest row counts. One row is one file, which Spark moves into
place when its job commits, so a promotion of several tables and the model switch happen
in one step, and readers that resolve a pair from one row never see a mix.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast.session import materialize

POINTER = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("tables", T.MapType(T.StringType(), T.StringType())),
        T.StructField("run_id", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("trained_at", T.StringType()),
        T.StructField("ride_count", T.LongType()),
    ]
)
SERVING = ("run_id", "model_name", "trained_at", "ride_count")


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


class TableStore:
    """Versions under ``root``, which every executor must be able to reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._candidates: dict[str, str] = {}

    # ---- candidate versions ---------------------------------------------------------

    def write(
        self,
        table: str,
        df: DataFrame,
        run_id: str,
        partition_by: list[str] | None = None,
        sort_by: list[str] | None = None,
    ) -> DataFrame:
        """Write a candidate version and read it back; readers of the table see no change.

        ``sort_by`` clusters the rows, so that row-group statistics can skip most files. Such
        rows are computed once and written aside first: a range shuffle looks at its input twice.
        """
        path = f"{self.root}/{table}/run={run_id}-{uuid.uuid4().hex[:8]}"
        if sort_by:
            keys = [*(partition_by or []), *sort_by]
            df = materialize(df, table)
            df = df.repartitionByRange(*[F.col(c) for c in keys]).sortWithinPartitions(*keys)
        writer = df.write.option("compression", "snappy")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        self._candidates[table] = path
        return self._read(path, df.schema)

    def discard(self, *tables: str) -> None:
        """Forget candidates. Their directories are no longer named by anything."""
        for table in tables or tuple(self._candidates):
            self._candidates.pop(table, None)

    def candidates(self) -> dict[str, str]:
        return dict(self._candidates)

    # ---- the pointer ----------------------------------------------------------------

    def promotions(self) -> DataFrame:
        """Every promotion so far, a row each."""
        try:
            return self.spark.read.schema(POINTER).json(f"{self.root}/pointer")
        except AnalysisException as error:
            if _missing(error):
                return self.spark.createDataFrame([], POINTER)
            raise

    def pointer(self) -> Row | None:
        return self.promotions().orderBy(F.col("version").desc()).first()

    def serving(self) -> Row | None:
        """The pointer, if it names a serving model completely."""
        row = self.pointer()
        named = row is not None and all(row[c] is not None for c in SERVING[:3])
        return row if named else None

    def promote(self, *tables: str, serving: dict | None = None) -> None:
        """Point readers at the candidates of ``tables`` and, if given, at a new model."""
        old = self.pointer()
        paths = dict(old["tables"]) if old is not None else {}
        paths.update({t: self._candidates.pop(t) for t in tables})
        named = serving or {c: old[c] if old is not None else None for c in SERVING}
        version = (old["version"] if old is not None else 0) + 1
        row = [(version, paths, *(named.get(c) for c in SERVING))]
        frame = self.spark.createDataFrame(row, POINTER).coalesce(1)
        frame.write.mode("append").json(f"{self.root}/pointer")

    # ---- reading --------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        row = self.pointer()
        return row is not None and table in row["tables"]

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        return self.read_many(table, schemas={table: schema} if schema else None)[0]

    def read_many(self, *tables: str, schemas: dict | None = None) -> list[DataFrame]:
        """Several tables as one pointer row names them."""
        row = self.pointer()
        if row is None:
            raise LookupError(f"nothing has been promoted under {self.root}")
        return [self._read(row["tables"][t], (schemas or {}).get(t)) for t in tables]

    def count(self, table: str) -> int | None:
        return self.read(table).count() if self.exists(table) else None

    def register(self, suffix: str = "_last") -> list[str]:
        """Temporary views over the promoted tables, for SQL readers."""
        row = self.pointer()
        names = sorted(row["tables"]) if row is not None else []
        for table in names:
            self._read(row["tables"][table]).createOrReplaceTempView(f"{table}{suffix}")
        return [f"{t}{suffix}" for t in names]

    def _read(self, path: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        df = reader.parquet(path)
        return df if schema is None else df.select(*schema.fieldNames())
