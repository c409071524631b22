"""Fitted models as tables: fit, score, save, load, and the checks before one serves."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.config import Settings
from slotcast.operators.models import additive, baseline, cells, global_trees, local_effects
from slotcast.watch import unwatched
from slotcast.session import materialize
from slotcast.sources.store import TableStore

MANIFEST = ["run_id", "model_name", "trained_at", "entity", "ride_count"]


class ModelError(Exception):
    """A model could not be fitted, or may not serve."""


@dataclass(frozen=True)
class FittedModel:
    """A family with its parameter tables; ``entities`` is the table it answers for."""

    family: str
    role: str
    trained_at: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    trees: PipelineModel | None = None

    @property
    def entities(self) -> DataFrame:
        return self.tables["params"].select("entity")

    def score(self, rows: DataFrame, settings: Settings) -> DataFrame:
        params, offsets = self.tables["params"], self.tables.get("offsets")
        if self.role == "additive":
            scored = additive.score(rows, params, settings)
        elif self.role == "local":
            scored = local_effects.score(rows, params, settings, offsets)
        elif self.role == "global":
            means = {
                c: self.tables[f"mean_{c}"]
                for c in global_trees.CATEGORIES
                if f"mean_{c}" in self.tables
            }
            scored = global_trees.score(rows, self.trees, params, offsets, means=means)
        else:
            scored = baseline.score(rows, params)
        return scored.withColumn("model", F.lit(self.family))


def roles(settings: Settings) -> dict[str, str]:
    """Model name to family."""
    return dict(zip(settings.model_order, ("additive", "global", "local", "baseline"), strict=True))


def fit(
    name: str, train: DataFrame, settings: Settings, trained_at: str, watch=unwatched
) -> FittedModel:
    """Fit one family. Its parameters are written once, so scoring never repeats a fit.

    ``watch`` counts the fitted entities in that pass, under the name of the family; for the
    baseline, which sees every entity, also their rows.
    """

    def written(params: DataFrame, **more: Column) -> DataFrame:
        return materialize(watch(params, name, fitted=F.count(F.lit(1)), **more), role)

    role = roles(settings)[name]
    model = FittedModel(name, role, trained_at)
    if role == "additive":
        tables = {"params": written(additive.fit(train, settings))}
    elif role == "local":
        tables = {"params": written(local_effects.fit(train, settings))}
    elif role == "global":
        trees = global_trees.fit(train, settings)
        model = replace(model, trees=trees)
        means = global_trees.unit_means(train)
        tables = {"params": written(baseline.fit(train).select("entity"))}
        tables |= {f"mean_{c}": materialize(m, "mean") for c, m in means.items()}
    else:
        tables = {"params": written(baseline.fit(train), train_rows=F.sum("train_rows"))}
    model = replace(model, tables=tables)
    if tables["params"].isEmpty():
        raise ModelError(f"{name} fitted no entity")
    if role in ("global", "local"):
        residuals = cells.residual_quantiles(model.score(train, settings), settings)
        model = replace(model, tables=tables | {"offsets": materialize(residuals, "offsets")})
    return model


# ---- saving and loading -------------------------------------------------------------


def manifest(entities: DataFrame, run_id: str, model_name: str, trained_at: str) -> DataFrame:
    """One row per entity, each with the header; a list in one row would not scale."""
    count = entities.agg(F.count(F.lit(1))).scalar()
    return entities.select(
        F.lit(run_id).alias("run_id"),
        F.lit(model_name).alias("model_name"),
        F.lit(trained_at).alias("trained_at"),
        "entity",
        count.alias("ride_count"),
    )


def manifest_problems(rows: DataFrame) -> DataFrame:
    """Header fields that are missing or differ, or a count that is not the list's."""
    header = rows.agg(
        F.count(F.lit(1)).alias("listed"),
        F.max("ride_count").alias("ride_count"),
        *(
            (F.count_if(F.col(c).isNull()) == 0).alias(f"has_{c}")
            for c in ("run_id", "model_name", "trained_at", "entity", "ride_count")
        ),
        (F.count_distinct(F.struct(*(c for c in MANIFEST if c != "entity"))) == 1).alias("single"),
    )
    checks = {
        **{f"missing {c}": F.col(f"has_{c}") for c in MANIFEST},
        "conflicting headers": F.col("single"),
        "count differs from the list": F.col("listed") == F.col("ride_count"),
    }
    problem = F.explode(
        F.filter(
            F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks.items())),
            lambda x: x.isNotNull(),
        )
    )
    return header.select(problem.alias("problem"))


def entity_difference(listed: DataFrame, loaded: DataFrame) -> DataFrame:
    """Entities on only one side."""
    left = listed.select("entity").distinct().withColumn("listed", F.lit(True))
    right = loaded.select("entity").distinct().withColumn("loaded", F.lit(True))
    return left.join(right, "entity", "full").where(
        F.col("listed").isNull() | F.col("loaded").isNull()
    )


def _path(store: TableStore, run_id: str) -> str:
    return f"{store.root}/models/run={run_id}"


def save(model: FittedModel, store: TableStore, run_id: str) -> int:
    """Write parameter tables and manifest under the run. Nothing points at them yet."""
    path = _path(store, run_id)
    for name, table in model.tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    if model.trees is not None:
        model.trees.write().overwrite().save(f"{path}/trees")
    listed = manifest(model.entities, run_id, model.family, model.trained_at)
    listed.write.mode("overwrite").parquet(f"{path}/manifest")
    return store.spark.read.parquet(f"{path}/manifest").count()


def load(store: TableStore, pointer, settings: Settings) -> FittedModel:
    """The model the pointer names, or an error: manifest, family and entities must agree."""
    spark, path = store.spark, _path(store, pointer["run_id"])
    try:
        listed = spark.read.parquet(f"{path}/manifest")
        problems = [r["problem"] for r in manifest_problems(listed).collect()]
        head = listed.select("run_id", "model_name", "trained_at").first()
        if problems:
            raise ModelError(f"manifest of {pointer['run_id']}: {'; '.join(problems)}")
        if (head["run_id"], head["model_name"]) != (pointer["run_id"], pointer["model_name"]):
            raise ModelError(f"manifest says {head['run_id']}/{head['model_name']}")
        role = roles(settings).get(head["model_name"])
        if role is None:
            raise ModelError(f"unknown model family {head['model_name']}")
        tables = {"params": spark.read.parquet(f"{path}/params")}
        trees = None
        if role in ("global", "local"):
            tables["offsets"] = spark.read.parquet(f"{path}/offsets")
        if role == "global":
            trees = PipelineModel.load(f"{path}/trees")
            for c in global_trees.CATEGORIES:
                tables[f"mean_{c}"] = spark.read.parquet(f"{path}/mean_{c}")
        model = FittedModel(head["model_name"], role, head["trained_at"], tables, trees)
        if not entity_difference(listed, model.entities).isEmpty():
            raise ModelError("loaded entities differ from the manifest")
        return model
    except ModelError:
        raise
    except Exception as error:
        raise ModelError(f"cannot load the model of run {pointer['run_id']}: {error}") from error


def versions(store: TableStore) -> DataFrame:
    """name, run: every version that lies under the store, tables and models alike.

    Spark lists the files; no content is read, and a folder counts by its part files. Where
    nothing was ever written the frame is empty.
    """
    spark, names = store.spark, "name string, run string"
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(store.root)
            .select("path")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], names)
    parts = F.regexp_extract("path", r"/([^/]+)/run=([^/]+)/", 0)
    return (
        files.select(parts.alias("at"))
        .where(F.col("at") != "")
        .select(F.split("at", "/")[1].alias("name"), F.split("at", "/run=|/")[2].alias("run"))
        .distinct()
    )


def unreachable(store: TableStore, settings: Settings) -> DataFrame:
    """name, run, last_named: versions that none of the newest ``retain_runs`` promotions names.

    A promotion names the version of each table and the run of its model, so what a reader of
    one of the kept promotions can reach is never listed, however old it is. ``last_named`` is
    the promotion that last named the version, null if none ever did.
    """
    log = store.promotions()
    model = F.create_map(F.lit("models"), F.col("run_id"))
    named = log.select("version", F.explode(F.map_concat("tables", model)).alias("name", "path"))
    run = F.coalesce(F.nullif(F.regexp_extract("path", "run=([^/]+)$", 1), F.lit("")), F.col("path"))
    last = (
        named.select("version", "name", run.alias("run"))
        .groupBy("name", "run")
        .agg(F.max("version").alias("last_named"))
    )
    # Promotions are numbered one after the other.
    newest = log.agg(F.max("version") - settings.retain_runs).scalar()
    found = versions(store).join(last, ["name", "run"], "left")
    return found.where(F.col("last_named").isNull() | (F.col("last_named") <= newest))


def expired_runs(runs: DataFrame, pointer_run: str | Column | None, settings: Settings):
    """Runs beyond the newest ``retain_runs``, except the one the pointer names.

    The newest runs are a top-k; the others are found by an anti-join, so there is no
    window over all runs.
    """
    newest = runs.select("run_id").distinct().orderBy(F.col("run_id").desc())
    kept = newest.limit(settings.retain_runs)
    if pointer_run is not None:
        named = F.lit(pointer_run) if isinstance(pointer_run, str) else pointer_run
        runs = runs.where(F.col("run_id") != named)
    return runs.select("run_id").distinct().join(kept, "run_id", "left_anti")

