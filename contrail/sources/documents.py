"""Page documents: one JSON document per file, in dated folders, placed by path.

    <root>/<container>/<date>/<container>_<offset>.json
    <root>/Flights/<date>/<hour>/Flights_from_<airport>_<date>T<hour>_offset_<offset>.json

:func:`write_documents` lets the tasks write the texts below a staging folder
and then moves each file to its name, which only touches the file system's
names. :func:`newest_date` compares the names of a container's folders, so that
a reader scans the newest one and lists no other.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.plans.sinks import exists, folder_names
from contrail.sources.pages import OFFSET_IN_FILE_NAME

# The parts of a departure document's path.
FLIGHT_DOCUMENT = r"/Flights/([0-9-]+)/([0-9]{2})/Flights_from_(.+)_[0-9-]+T[0-9]{2}_offset_([0-9]+)\.json$"
_ISO_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
#: Renames that run at once.
_MOVES = 16


def reference_document(container: Column, date: Column, offset: Column) -> Column:
    """Path, below the root, of a reference page's document."""
    return F.concat_ws("/", container, date.cast("string"), F.concat(container, F.lit("_"), offset.cast("string"), F.lit(".json")))


def flight_document(airport: Column, date: Column, hour: Column, offset: Column) -> Column:
    """Path, below the root, of a departure page's document (no colon: not every file system takes it in a name)."""
    day = date.cast("string")
    name = F.concat(F.lit("Flights_from_"), airport, F.lit("_"), day, F.lit("T"), hour, F.lit("_offset_"),
                    offset.cast("string"), F.lit(".json"))
    return F.concat_ws("/", F.lit("Flights"), day, hour, name)


def write_documents(pages: DataFrame, root: str, path: Column, raw: str = "raw_data") -> int:
    """Write each page's text to the file ``<root>/<path>``; returns the number of files.

    Paths are unique; a file that is there is replaced. Each file appears
    whole. A run that fails leaves a folder ``_staged-...``, which readers do
    not see, and may be repeated.
    """
    spark, root = pages.sparkSession, root.rstrip("/")
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    pages.select(path.alias("document"), F.col(raw).alias("value")).write.partitionBy("document").text(staged)
    jvm = spark.sparkContext._jvm
    Path, unescape = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    fs = Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there: dict[str, bool] = {}  # folders of this run, and whether they were there before

    def folders():
        # Plain statuses, as they come: located ones (``listFiles``) ask for each file's
        # blocks and permissions, which on some file systems starts a process per file.
        listed = fs.listStatusIterator(Path(staged))
        while listed.hasNext():
            name = listed.next().getPath().getName()
            if name.startswith("document="):
                yield name

    def move(name: str) -> int:
        target = f"{root}/{unescape(name.removeprefix('document='))}"
        folder = target.rpartition("/")[0]
        if folder not in there:
            known = fs.exists(Path(folder))
            fs.mkdirs(Path(folder))
            there.setdefault(folder, known)
        to, files = Path(target), [s.getPath() for s in fs.listStatus(Path(f"{staged}/{name}"))]
        for file in files:
            if (there[folder] or len(files) > 1) and fs.exists(to):
                fs.delete(to, False)
            if not fs.rename(file, to):
                raise OSError(f"cannot move a document to {target}")
        return len(files)

    n, found = 0, folders()
    with ThreadPoolExecutor(_MOVES) as pool:
        while some := list(islice(found, 1000)):
            n += sum(pool.map(move, some))
    fs.delete(Path(staged), True)
    return n


def newest_date(spark: SparkSession, folder: str) -> str | None:
    """Name of the newest dated folder directly below ``folder``; other names do not count."""
    return max(filter(_ISO_DATE.fullmatch, folder_names(spark, folder)), default=None)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return (spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
            .select(F.col("value").alias("raw_data"), F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_name").alias("file_name")))


def read_newest_documents(spark: SparkSession, root: str, container: str) -> DataFrame:
    """(container, date, number, file_name, raw_data) of the container's newest folder, which alone is scanned.

    ``number`` is the one that ends the file's name, null without. The order
    of the documents is :func:`document_order`. Empty where no dated folder is.
    """
    date = newest_date(spark, f"{root.rstrip('/')}/{container}")
    if date is None:
        return spark.createDataFrame([], "container string, date date, number long, file_name string, raw_data string")
    docs = _documents(spark, f"{root.rstrip('/')}/{container}/{date}")
    return docs.select(F.lit(container).alias("container"), F.lit(dt.date.fromisoformat(date)).alias("date"),
                       F.regexp_extract("file_name", OFFSET_IN_FILE_NAME, 1).try_cast("long").alias("number"),
                       "file_name", "raw_data")


def document_order() -> dict[str, Column]:
    """Order of documents: by number, then those without one by name."""
    return {"unnumbered": F.col("number").isNull(), "number": F.col("number"), "file_name": F.col("file_name")}


def read_flight_documents(spark: SparkSession, root: str, date: dt.date | str) -> DataFrame:
    """(airport_code, block, offset, raw_data) of one day's departure documents, as ``land_flight_pages`` takes them."""
    folder = f"{root.rstrip('/')}/Flights/{date}"
    if not exists(spark, folder):
        return spark.createDataFrame([], "airport_code string, block string, offset long, raw_data string")
    docs = _documents(spark, f"{folder}/*")

    def part(k: int) -> Column:
        return F.regexp_extract(F.url_decode("path"), FLIGHT_DOCUMENT, k)

    return docs.select(part(3).alias("airport_code"), F.concat(part(1), F.lit("T"), part(2), F.lit(":00")).alias("block"),
                       part(4).cast("long").alias("offset"), "raw_data")
