"""Tables made of runs: a folder of Parquet for each, and a list that says which count.

The list is one small file, ``_runs-<number>.json``, written whole under the next number; a table is what its latest list
names. So readers see a run wholly or not at all, a run that is repeated adds nothing, and one that fails leaves no more than a
folder that no list names. Two writers that come to the same number can't both create the file; the later one tries again.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adsettle.operators.totals import counted
from adsettle.session import qualified

_LIST = re.compile(r"_runs-(\d+)\.json")
TRIES = 20


class _Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, qualified(spark, path)
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.store = self.at("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def numbers(self) -> list[int]:
        """The numbers of all lists, in order."""
        if not self.store.exists(self.at("")):
            return []
        names = [s.getPath().getName() for s in self.store.listStatus(self.at(""))]
        return sorted(int(m[1]) for n in names if (m := _LIST.fullmatch(n)))

    def latest(self) -> tuple[int, list[dict]]:
        """The latest list and its number: (0, []) without any."""
        numbers = self.numbers()
        if not numbers:
            return 0, []
        stream = self.store.open(self.at(f"_runs-{numbers[-1]}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return numbers[-1], json.loads(text)

    def put(self, number: int, runs: list[dict]) -> bool:
        """Create the list of that number, complete; False if there is one."""
        place = self.at(f"_runs-{number}.json")
        own = self.at(f"_{uuid.uuid4().hex}.tmp")
        stream = self.store.create(own, False)
        stream.write(json.dumps(runs, ensure_ascii=False).encode())
        stream.close()
        # a rename onto a file that is there fails, or would where the store replaces files: so look first
        done = not self.store.exists(place) and self.store.rename(own, place)
        if not done:
            self.store.delete(own, False)
        return done

    def write(self, df: DataFrame, run: str) -> dict:
        folder = f"run-{uuid.uuid4().hex}"
        rows, seen = counted(df)
        rows.write.parquet(f"{self.path}/{folder}")
        return {"run": run, "folder": folder, "rows": seen.get["rows"], "schema": json.loads(df.schema.json())}


def append_run(df: DataFrame, path: str, run: str) -> bool:
    """Add the rows of a run, by position; nothing if a run of that name counts already. Whether it was added."""
    table = _Table(df.sparkSession, path)
    number, runs = table.latest()
    if any(r["run"] == run for r in runs):
        return False
    if runs and len(runs[0]["schema"]["fields"]) != len(df.columns):
        raise ValueError(f"the table has {len(runs[0]['schema']['fields'])} columns, the run {len(df.columns)}")
    if runs:  # by position: the first run's names and types
        first = StructType.fromJson(runs[0]["schema"])
        df = df.toDF(*first.names).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in first.fields])
    added = table.write(df, run)
    for _ in range(TRIES):
        if table.put(number + 1, [*runs, added]):
            return True
        number, runs = table.latest()
        if any(r["run"] == run for r in runs):
            break
    else:
        raise OSError(f"{path}: the list of runs can't be put in place")
    table.store.delete(table.at(added["folder"]), True)
    return False


def replace_runs(df: DataFrame, path: str, run: str) -> None:
    """Make a run all that counts, and remove what earlier lists named. Readers that have begun on those files fail."""
    table = _Table(df.sparkSession, path)
    added = table.write(df, run)
    for _ in range(TRIES):
        number, runs = table.latest()
        if table.put(number + 1, [added]):
            break
    else:
        raise OSError(f"{path}: the list of runs can't be put in place")
    for old in runs:
        table.store.delete(table.at(old["folder"]), True)
    for earlier in table.numbers():
        if earlier <= number:
            table.store.delete(table.at(f"_runs-{earlier}.json"), False)


def run_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """The rows of each run that counts, as counted when it was written; no job."""
    return {r["run"]: r["rows"] for r in _Table(spark, path).latest()[1]}


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs that count, with their run's name in ``run``."""
    table = _Table(spark, path)
    _, runs = table.latest()
    if not runs:
        raise FileNotFoundError(f"{path} has no list of runs")
    rows = spark.read.schema(StructType.fromJson(runs[0]["schema"])).parquet(*[f"{table.path}/{r['folder']}" for r in runs])
    names = F.create_map(*[F.lit(x) for r in runs for x in (r["folder"], r["run"])])
    return rows.withColumn("run", names[F.regexp_extract("_metadata.file_path", "/(run-[0-9a-f]+)/[^/]*$", 1)])
