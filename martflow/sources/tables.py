"""Parquet table access by name under one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The table names of the test warehouse.
TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, root).lineitem`` is a parquet scan.

    Scans (and anything derived and stored with ``memo``) are created once
    per instance; ``Tables.open`` shares one instance per session and root,
    the way a job loads its tables once and runs many queries over them.
    ``refresh()`` drops them (new files are listed on the next access).
    """

    _shared: dict[tuple[str, str], "Tables"] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._scans: dict[str, DataFrame] = {}
        self._memo: dict[str, DataFrame] = {}

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "Tables":
        key = (spark.sparkContext.applicationId, root.rstrip("/"))
        if key not in cls._shared:
            cls._shared[key] = cls(spark, root)
        return cls._shared[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            scans = self.__dict__["_scans"]
            if name not in scans:
                scans[name] = read_table(self.spark, self.root, name)
            return scans[name]
        raise AttributeError(name)

    def memo(self, key: str, build) -> DataFrame:
        """A derived relation (a dimension view), built once per instance."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def refresh(self) -> None:
        self._scans.clear()
        self._memo.clear()

    @property
    def names(self) -> list[str]:
        return list(TABLE_NAMES)
