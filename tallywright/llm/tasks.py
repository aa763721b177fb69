"""Small helpers shared by the operators: shipping code, writing intermediate tables, columns."""

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..shared import scratch_folder

# What names a row of a table however it is read: the file it is in, and its place there.
FILE, PLACE = "_tallywright_file", "_tallywright_place"

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, unless their search path has it already."""
    root = str(PACKAGE.parent)
    found = [os.path.realpath(x or ".") for x in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if root in found or os.getcwd() == root or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="tallywright-code-")) / "tallywright.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(PACKAGE.rglob("*.py")):
            target.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def staged(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write `df` once to the folder all executors share and read it back.

    What follows neither repeats the work nor depends on the executors that did it, and row ids
    given before the write stay what they are when a later task runs again.
    """
    folder = scratch_folder(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _reads_files(df: DataFrame) -> bool:
    """Whether each row of `df` is one row of a Parquet file, so that file and place name it."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" and "parquet" in plan.toString().lower()


def named(docs: DataFrame) -> DataFrame:
    """`docs` with what names each row, the same on every read, however the files are split into tasks.

    Rows that do not come straight from Parquet files are written first, with numbers for names.
    """
    if FILE in docs.columns:
        return docs
    if _reads_files(docs):
        row = docs.metadataColumn("_metadata")
        return docs.withColumns({FILE: row["file_path"], PLACE: row["row_index"]})
    return staged(docs.withColumns({FILE: F.lit(""), PLACE: F.monotonically_increasing_id()}), "named-rows")


def names_of(docs: DataFrame) -> list[str]:
    """The columns that name rows, where `docs` has them; operators carry them along."""
    return [FILE, PLACE] if FILE in docs.columns else []


def row_number() -> Column:
    """A number `row` for each row, for tables that are written before their first use."""
    return F.monotonically_increasing_id().alias("row")


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """`docs`, from `named`, without the rows that `dropped` names, and without the names."""
    names = staged(dropped.select(FILE, PLACE), "dropped")
    return docs.join(names, [FILE, PLACE], "left_anti").drop(FILE, PLACE)


def whole_text(name: str = "text") -> Column:
    """The text itself; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def private(df: DataFrame, *names: str) -> DataFrame:
    """`df` without columns whose names the operator needs for itself."""
    taken = {x.lower() for x in names}
    return df.drop(*(c for c in df.columns if c.lower() in taken))
