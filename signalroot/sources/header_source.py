"""Header files as a Spark data source: `spark.read.format("wfdb_header").load(folder)`.

The folder is listed once, on the driver, and split into tasks by a number of
files, as headers are tiny and a file is the cost, not its bytes. Filters on
`header_path` that equal a value, begin with one or name several are taken to the
listing, so only the folders that may hold such a path are listed and only such
files are opened (with spark.sql.python.filterPushdown.enabled).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith
from pyspark.sql.types import StructType

from . import files

SCHEMA = "header_path string, text string"
#: Headers that a task opens.
PER_TASK = 1_000


class Chosen(InputPartition):
    """Headers of one task, by their paths below the folder."""

    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


class HeaderReader(DataSourceReader):
    def __init__(self, directory: str, per_task: int):
        self.directory, self.per_task = directory.rstrip("/"), per_task
        self.prefixes: list[tuple[str, ...]] = []

    def _may_hold(self, folder: str) -> bool:
        """Whether a path below `folder/` can satisfy every filter."""
        return all(any(p.startswith(folder) or folder.startswith(p) for p in some) for some in self.prefixes)

    def _wanted(self, path: str) -> bool:
        return path.endswith(".hea") and all(path.startswith(some) for some in self.prefixes)

    def listed(self) -> tuple[list[str], int]:
        """(sorted paths of headers, folders listed)."""
        system, root = files.resolve(self.directory)
        found, rest, n = [], [""], 0
        while rest:
            folder = rest.pop()
            n += 1
            for info in system.get_file_info(fs.FileSelector(f"{root}/{folder}".rstrip("/"))):
                path = f"{folder}{info.base_name}"
                if info.type == fs.FileType.Directory:
                    rest += [f"{path}/"] if self._may_hold(f"{path}/") else []
                elif self._wanted(path) and not info.base_name.startswith((".", "_")):
                    found.append(path)
        return sorted(found), n

    def partitions(self) -> list[Chosen]:
        paths, _ = self.listed()
        return [Chosen(paths[k : k + self.per_task]) for k in range(0, len(paths), self.per_task)] or [Chosen([])]

    def read(self, partition: Chosen) -> Iterator[tuple[str, str]]:
        for path in partition.paths:
            yield path, files.read(f"{self.directory}/{path}").decode("utf-8", "replace")


class FilteringReader(HeaderReader):
    """Spark refuses a reader with this method while its setting is off."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802  Spark's name
        """Takes what narrows the listing; all filters are applied by Spark as well."""
        for f in filters:
            if getattr(f, "attribute", None) == ("header_path",):
                if isinstance(f, (EqualTo, StringStartsWith)):
                    self.prefixes.append((f.value,))
                elif isinstance(f, In):
                    self.prefixes.append(tuple(f.value))
            yield f


class HeaderSource(DataSource):
    """Options: `path`, `filesPerTask`, and `pushFilters`, which needs the setting."""

    @classmethod
    def name(cls) -> str:
        return "wfdb_header"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> HeaderReader:
        if "path" not in self.options:
            raise ValueError("wfdb_header needs a folder to load")
        kind = FilteringReader if self.options.get("pushFilters", "false") == "true" else HeaderReader
        return kind(self.options["path"], int(self.options.get("filesPerTask", PER_TASK)))


def load(spark: SparkSession, directory: str) -> DataFrame:
    """(header_path, text) of every header below a folder."""
    spark.dataSource.register(HeaderSource)
    return spark.read.format("wfdb_header").option("pushFilters", spark.conf.get("spark.sql.python.filterPushdown.enabled")).load(directory)
