"""Layer tables that grow by loads. A load becomes visible in one step, when its entry is put into the table's list."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.append import new_keys_only

LOAD = "carga"


class LoadTable:
    """A table as a folder of loads, `<name>.loads/data/<load>`, and a list of those that are complete.

    A load is written whole into its own folder first. Then a small entry is made under another name and renamed into the list,
    which is one step on file systems whose rename is one. Readers take only listed loads, so a load that breaks leaves
    the table as it was, and what it has written is replaced when it is run again. A load that is listed is not run again. Entries
    are numbered; of two writers that want the same number one fails. The list has one short entry per load.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str) -> None:
        self.spark, self.path = spark, f"{folder}/{name}.loads"

    def _file_system(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def loads(self) -> list[dict]:
        """Entries of complete loads, in their order."""
        place, files = self._file_system(f"{self.path}/list")
        if not files.exists(place):
            return []
        entries = self.spark.read.text(f"{self.path}/list").collect()
        return sorted((json.loads(row[0]) for row in entries), key=lambda entry: entry["number"])

    def read(self) -> DataFrame:
        """Rows of all complete loads that no later one has replaced, with the load each came by as `carga`."""
        found, replaced, all_replaced = [], {}, False
        for entry in reversed(self.loads()):
            if all_replaced:
                break
            rows = self.spark.read.parquet(f"{self.path}/data/{entry['load']}").withColumn(LOAD, F.lit(entry["load"]))
            for column, values in replaced.items():
                rows = rows.where(~F.coalesce(F.col(column).cast("string").isin(sorted(values)), F.lit(False)))
            found.append(rows)
            if entry["kind"] == "whole":
                all_replaced = True
            elif entry["kind"] == "part":
                replaced.setdefault(entry["column"], set()).update(entry["values"])
        if not found:
            raise FileNotFoundError(self.path)
        out = found[-1]
        for rows in found[-2::-1]:
            out = out.unionByName(rows, allowMissingColumns=True)
        return out

    def append(self, df: DataFrame, key: list[str], load: str) -> bool:
        """Add the rows whose key the table does not hold. Returns whether the load was run, that is, not done before."""
        def rows() -> DataFrame:
            return new_keys_only(df, self.read().select(*key), key) if self.loads() else df

        return self._load(rows, load, {"kind": "append"})

    def replace(self, df: DataFrame, load: str, column: str | None = None, values: list[str] | None = None) -> bool:
        """Put the rows in place of the whole table, or of the rows that share a value of `column`, such as a month, with
        them. Their distinct values, which must be few, are kept in the list as text; null values are only added to.
        Where `values` are given, no pass looks for them, and those that no row has any more are replaced too."""
        entry = {"kind": "whole"}
        if column is not None:
            values = values if values is not None else [row[0] for row in df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).distinct().collect()]
            entry = {"kind": "part", "column": column, "values": sorted(values)}
        return self._load(lambda: df, load, entry, column)

    def _load(self, rows, load: str, entry: dict, column: str | None = None) -> bool:
        done = self.loads()
        if any(other["load"] == load for other in done):
            return False
        # Files of one value together, so readers of some values skip the others by their statistics.
        df = rows()
        df = df if column is None else df.hint("rebalance", column).sortWithinPartitions(column)
        df.write.mode("overwrite").parquet(f"{self.path}/data/{load}")
        number = done[-1]["number"] + 1 if done else 0
        staged, files = self._file_system(f"{self.path}/staged-{load}.json")
        out = files.create(staged, True)
        out.write(bytearray(json.dumps(entry | {"load": load, "number": number}).encode()))
        out.close()
        listed, _ = self._file_system(f"{self.path}/list/{number:08d}.json")
        files.mkdirs(listed.getParent())
        if files.exists(listed) or not files.rename(staged, listed):
            raise RuntimeError(f"Another load was listed meanwhile: {number}")
        return True

    def compact(self, load: str) -> bool:
        """Write the table anew as one load; its rows forget by which load they came."""
        return self.replace(self.read().drop(LOAD), load)
