"""Stored tables in month folders, of which a load replaces only those it changes.

A load writes the whole new content of the months it changes into folders of its own, and then a
small list that says for every month which folder holds it. Spark's marker of a finished write
on that list is the moment at which the load takes effect, for all tables and months at once:
readers go by the last finished list, so a load that is killed leaves everything as it was, and
months that it does not change keep their files.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.session import folder_names, remove_folder

MONTH = "order_month"
_NONE = "__HIVE_DEFAULT_PARTITION__"
_LIST = "`table` string, month string, folder string"


def _folder(month: dt.date | None) -> str:
    return _NONE if month is None else month.isoformat()


class MonthStore:
    """Tables of the column ``order_month`` and others, in month folders below ``root``.

    ``schemas`` names the tables; ``cluster_by`` the columns by which a table's files are sorted.
    The list of folders has a row for each table and month and is the only thing that is read
    on the driver. Of two loads that start from the same version the later one raises.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schemas: Mapping[str, T.StructType],
        cluster_by: Mapping[str, Sequence[str]] | None = None,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas, self.cluster_by = dict(schemas), dict(cluster_by or {})

    def versions(self) -> list[int]:
        """Numbers of the finished loads."""
        numbers = [int(n.removeprefix("version=")) for n in folder_names(self.spark, f"{self.root}/versions")]
        return sorted(n for n in numbers if "_SUCCESS" in folder_names(self.spark, f"{self.root}/versions/version={n}"))

    def folders(self, version: int | None = None) -> dict[tuple[str, str], str]:
        """For each table and month, the load whose folder holds it."""
        known = self.versions()
        if not known:
            return {}
        at = known[-1] if version is None else version
        rows = self.spark.read.schema(_LIST).parquet(f"{self.root}/versions/version={at}").collect()
        return {(r.table, r.month): r.folder for r in rows}

    def months(self, table: str, version: int | None = None) -> list[dt.date | None]:
        """The months that a table has rows in, a missing month first."""
        held = sorted(m for t, m in self.folders(version) if t == table and m != _NONE)
        return [None] * ((table, _NONE) in self.folders(version)) + [dt.date.fromisoformat(m) for m in held]

    def read(self, table: str, months: Iterable[dt.date | None] | None = None, version: int | None = None) -> DataFrame:
        """A table, or those of its months that are asked for; no other folder is opened."""
        schema = self.schemas[table]
        wanted = None if months is None else {_folder(m) for m in months}
        held = self.folders(version).items()
        base = f"{self.root}/data/table={table}"
        paths = [f"{base}/load={f}/{MONTH}={m}" for (t, m), f in sorted(held) if t == table and (wanted is None or m in wanted)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())]))
        return found.option("basePath", base).parquet(*paths).select(*schema.names)

    def swap(self, contents: Mapping[str, tuple[DataFrame, Iterable[dt.date | None] | None]]) -> int:
        """Replace months of tables by new contents, all at once; the number of the new version.

        For each table the rows and the months that they are the whole content of (all months for
        None). A month without rows is dropped. Rows of other months raise before anything takes effect.
        """
        known = self.versions()
        version, held = (known[-1] if known else 0) + 1, self.folders()
        load = f"{version:06d}-{uuid.uuid4().hex}"
        for table, (rows, months) in contents.items():
            path = f"{self.root}/data/table={table}/load={load}"
            schema = self.schemas[table]
            typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
            typed = typed.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, *self.cluster_by.get(table, ()))
            typed.write.partitionBy(MONTH).parquet(path)
            made = {n.removeprefix(f"{MONTH}=") for n in folder_names(self.spark, path) if n.startswith(f"{MONTH}=")}
            named = None if months is None else {_folder(m) for m in months}
            if named is not None and not made <= named:
                raise ValueError(f"rows of {table} in months that were not to change: {sorted(made - named)}")
            held = {k: f for k, f in held.items() if k[0] != table or (named is not None and k[1] not in named)}
            held |= {(table, m): load for m in made}
        self._finish(version, held)
        return version

    def _finish(self, version: int, held: Mapping[tuple[str, str], str]) -> None:
        rows = [(t, m, f) for (t, m), f in sorted(held.items())]
        listed = self.spark.createDataFrame(rows, _LIST).coalesce(1)
        listed.write.mode("errorifexists").parquet(f"{self.root}/versions/version={version}")

    def vacuum(self, keep: int = 1) -> None:
        """Remove folders that none of the last ``keep`` versions holds, and the lists of older ones.

        Only while nothing is being loaded or reads an older version.
        """
        known = self.versions()
        used = {(t, f, m) for v in known[-keep:] for (t, m), f in self.folders(v).items()}
        for table in self.schemas:
            base = f"{self.root}/data/table={table}"
            for load in folder_names(self.spark, base):
                own = f"{base}/{load}"
                months = [n for n in folder_names(self.spark, own) if n.startswith(f"{MONTH}=")]
                kept = [n for n in months if (table, load.removeprefix("load="), n.removeprefix(f"{MONTH}=")) in used]
                for path in [own] if not kept else [f"{own}/{n}" for n in months if n not in kept]:
                    remove_folder(self.spark, path)
        for v in known[:-keep]:
            remove_folder(self.spark, f"{self.root}/versions/version={v}")
