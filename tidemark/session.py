"""Session settings and the two helpers every job needs: inline rule rows and stage cuts."""

from __future__ import annotations

import datetime
import json
import math
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", memory: str = "12g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Jobs with Python steps then run from any folder and on clusters where it is not installed.
    The archive lies on the driver; Spark's own file service hands it to the executors.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
    if isinstance(value, datetime.date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, (list, tuple)):
        return "array(" + ", ".join(_literal(v) for v in value) + ")"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def inline_rows(spark: SparkSession, columns: dict[str, str], rows) -> DataFrame:
    """Rule rows as a literal table.

    Catalyst sees a local relation of known size, so joins with it are broadcast by size and
    no Python worker or parallelised collection is involved.
    """
    casts = ", ".join(f"CAST(`{c}` AS {t}) AS `{c}`" for c, t in columns.items())
    rows = list(rows)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS `{c}`" for c, t in columns.items())
        return spark.sql(f"SELECT {nulls} WHERE false")
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")


def stage_folder(spark: SparkSession) -> str:
    """The folder for stored stages.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only where none is named and
    the session is local is a temporary folder set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            context.setCheckpointDir(named)
        elif context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-stage-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return context.getCheckpointDir()


_runs: list[StageRun] = []


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = jvm.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.Path


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, path_of = _file_system(spark, path)
    fs.delete(path_of(path), True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of the shared store, None where there is none."""
    fs, path_of = _file_system(spark, path)
    if not fs.exists(path_of(path)):
        return None
    source = fs.open(path_of(path))
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file at once: readers see the old text or the new one."""
    fs, path_of = _file_system(spark, path)
    made = path_of(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(made, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark.sparkContext._jvm.org.apache.hadoop
    files = jvm.fs.FileContext.getFileContext(
        path_of(path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    option = jvm.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    files.rename(made, path_of(path), options)


class StageRun:
    """One run's stages: they lie in a folder of its own, listed in its manifest, and go with it.

        with StageRun(spark) as run:
            result = insights.run_insights(...)
            run.publish(report.payloads(result), "payloads")
        read_published(spark, "payloads")

    What the run stored is deleted at its end, whether it ends well or fails; DataFrames that read
    it are of no use after that. Published tables stay: a name points to the last version that was
    written to its end, and an older one is deleted only once the pointer has moved.
    """

    def __init__(self, spark: SparkSession, name: str = "run"):
        self.spark, self.id = spark, f"{name}-{uuid.uuid4().hex}"
        self.root = stage_folder(spark)
        self.folder = f"{self.root}/runs/{self.id}"
        self.stages: list[dict] = []

    def __enter__(self) -> StageRun:
        _runs.append(self)
        self.note("running")
        return self

    def __exit__(self, kind, error, trace) -> None:
        _runs.remove(self)
        if kind is not None:
            self.note("failed")
        remove_folder(self.spark, self.folder)

    @property
    def manifest(self) -> dict | None:
        text = read_text(self.spark, f"{self.folder}/manifest.json")
        return None if text is None else json.loads(text)

    def note(self, status: str) -> None:
        write_text(self.spark, f"{self.folder}/manifest.json", json.dumps(
            {"run": self.id, "status": status, "stages": self.stages}))

    def store(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.stages):04d}"
        df.write.parquet(path)
        self.stages.append({"path": path, "schema": df.schema.simpleString()})
        self.note("running")
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self, df: DataFrame, name: str) -> None:
        """Make a table the one that `read_published` gives under that name."""
        pointer = f"{self.root}/published/{name}.json"
        path = f"{self.root}/published/{name}-{uuid.uuid4().hex}"
        before = read_text(self.spark, pointer)
        try:
            df.write.parquet(path)
            write_text(self.spark, pointer, json.dumps({"path": path, "run": self.id}))
        except BaseException:
            remove_folder(self.spark, path)
            raise
        if before is not None:
            remove_folder(self.spark, json.loads(before)["path"])


def read_published(spark: SparkSession, name: str) -> DataFrame:
    text = read_text(spark, f"{stage_folder(spark)}/published/{name}.json")
    if text is None:
        raise FileNotFoundError(f"nothing is published as {name!r}")
    return spark.read.parquet(json.loads(text)["path"])


def abandoned_runs(spark: SparkSession) -> list[str]:
    """Folders of runs whose driver ended without their end; for `remove_folder` by the owner."""
    folder = f"{stage_folder(spark)}/runs"
    fs, path_of = _file_system(spark, folder)
    if not fs.exists(path_of(folder)):
        return []
    active = {run.id for run in _runs}
    found = [s.getPath() for s in fs.listStatus(path_of(folder))]
    return sorted(p.toString() for p in found if p.getName() not in active)


def stage(df: DataFrame) -> DataFrame:
    """Store a small result that several later stages read: metadata, calendars, series.

    Losing an executor then costs a re-read, not a re-run. Inside a `StageRun` it goes with it.
    """
    if _runs:
        return _runs[-1].store(df)
    stage_folder(df.sparkSession)
    return df.checkpoint()


def stored_table(df: DataFrame) -> DataFrame:
    """Store a large derived table that is read in several passes.

    It is written as columns, so each later pass reads only the columns it needs and Catalyst
    knows the table's size. Inside a `StageRun` it goes with it.
    """
    if _runs:
        return _runs[-1].store(df)
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
