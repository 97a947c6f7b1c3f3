"""Folders of daily float32 grids as a Spark data source: days are pruned before a file is opened.

    register(spark)
    read_grids(spark, folder, layout).where("date BETWEEN '2025-07-01' AND '2025-07-31'")

The date of a file is the last run of eight digits in its name. Bounds on ``date`` are taken over from the
plan, so only files of wanted days become parts of the scan; a part is a few consecutive days of bounded size.
Folders may be local or on a file system that pyarrow knows by its URI. Two files of one day are both read,
``path`` tells them apart. A file without a date in its name and one of another size than the layout raise. Names that begin with
``_`` or ``.`` are not data.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
                                    IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage)

FORMAT = "float32_grid"
SCHEMA = "date date, path string, layer int, lat double, lon double, value double"
ARROW = pa.schema([("date", pa.date32()), ("path", pa.string()), ("layer", pa.int32()), ("lat", pa.float64()), ("lon", pa.float64()), ("value", pa.float64())])
#: Bytes of the files of one part, each counted with what opening it costs.
PART_BYTES = 32 << 20
OPEN_BYTES = 1 << 20


@dataclass(frozen=True)
class Layout:
    """Rows of a grid run north from ``lat0``, columns east from ``lon0``; layers follow one another. Cells equal to ``undef`` are missing."""

    n_lon: int = 720
    n_lat: int = 360
    layers: int = 2
    lon0: float = 0.25
    lat0: float = -89.75
    step: float = 0.5
    undef: float = -999.0

    @property
    def size(self) -> int:
        return self.n_lon * self.n_lat * self.layers * 4

    def cells(self, content: bytes, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(layer, lat, lon, value) of the cells of each layer that are not missing."""
        if len(content) != self.size:
            raise ValueError(f"{path}: expected {self.size} bytes, got {len(content)}; the grid layout changed")
        lat = np.repeat(self.lat0 + self.step * np.arange(self.n_lat), self.n_lon)
        lon = np.tile(self.lon0 + self.step * np.arange(self.n_lon), self.n_lat)
        for layer, values in enumerate(np.frombuffer(content, dtype="<f4").astype(float).reshape(self.layers, -1)):
            ok = values != self.undef
            yield layer, lat[ok], lon[ok], values[ok]


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there; ``file:/x`` is local too."""
    local = re.sub(r"^file:/+", "/", folder)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(folder)


def date_of(path: str) -> dt.date:
    digits = re.findall(r"(?<!\d)\d{8}(?!\d)", path.rsplit("/", 1)[-1])
    if not digits:
        raise ValueError(f"{path}: no date of eight digits in its name")
    return dt.datetime.strptime(digits[-1], "%Y%m%d").date()


class Days(InputPartition):
    def __init__(self, files: list[tuple[dt.date, str]]) -> None:
        super().__init__(None)
        self.files = files


class GridReader(DataSourceReader):
    def __init__(self, folder: str, layout: Layout) -> None:
        self.folder, self.layout = folder, layout
        self.bounds: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        kinds = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
        for f in filters:
            if isinstance(f, IsNotNull) and f.attribute == ("date",):
                continue
            if type(f) in kinds and f.attribute == ("date",) and f.value is not None:
                self.bounds.append((kinds[type(f)], f.value))
            else:
                yield f

    def wanted(self, day: dt.date) -> bool:
        holds = {"=": lambda v: day == v, ">": lambda v: day > v, ">=": lambda v: day >= v, "<": lambda v: day < v, "<=": lambda v: day <= v, "in": lambda v: day in v}
        return all(holds[kind](value) for kind, value in self.bounds)

    def partitions(self) -> list[Days]:
        system, root = file_system(self.folder)
        files = [x for x in system.get_file_info(fs.FileSelector(root)) if x.is_file and not x.base_name.startswith(("_", "."))]
        parts, room = [], 0
        for day, path, size in sorted((date_of(x.path), x.path, x.size) for x in files):
            if not self.wanted(day):
                continue
            room -= size + OPEN_BYTES
            if room < 0 or not parts:
                parts.append(Days([]))
                room = PART_BYTES - size - OPEN_BYTES
            parts[-1].files.append((day, path))
        return parts or [Days([])]

    def read(self, partition: Days) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.folder)
        for day, path in partition.files:
            with system.open_input_stream(path) as stream:
                content = stream.read()
            for layer, lat, lon, value in self.layout.cells(content, path):
                n = len(value)
                yield pa.RecordBatch.from_arrays([pa.array([day] * n, pa.date32()), pa.array([path] * n, pa.string()), pa.array(np.full(n, layer, np.int32)),
                                                  pa.array(lat), pa.array(lon), pa.array(value)], schema=ARROW)


class Written(WriterCommitMessage):
    def __init__(self, days: list[dt.date]) -> None:
        self.days = days


class GridWriter(DataSourceWriter):
    """One file per row (date, content). A file is moved to its place when it is complete, so a repeated task replaces its own files."""

    def __init__(self, folder: str, size: int) -> None:
        self.folder, self.size = folder, size

    def write(self, iterator: Iterator) -> Written:
        system, root = file_system(self.folder)
        system.create_dir(root, recursive=True)
        days = []
        for row in iterator:
            if row.date is None or row.content is None or len(row.content) != self.size:
                raise ValueError(f"a grid of {row.date} has no date or not {self.size} bytes")
            part = f"{root}/.{uuid.uuid4().hex}"
            with system.open_output_stream(part) as stream:
                stream.write(bytes(row.content))
            system.move(part, f"{root}/grid_{row.date:%Y%m%d}.bin")
            days.append(row.date)
        return Written(days)

    def commit(self, messages: list[Written | None]) -> None:
        days = [d for m in messages if m is not None for d in m.days]
        if len(set(days)) < len(days):
            raise ValueError("some day has more than one grid")


class GridSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def layout(self) -> Layout:
        kept = {k: self.options.get(k) for k in asdict(Layout()) if self.options.get(k) is not None}
        return Layout(**{k: type(getattr(Layout(), k))(v) for k, v in kept.items()})

    def reader(self, schema) -> GridReader:  # noqa: ANN001
        return GridReader(self.options["path"], self.layout())

    def writer(self, schema, overwrite: bool) -> GridWriter:  # noqa: ANN001
        return GridWriter(self.options["path"], self.layout().size)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and lets Python sources take filters over."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GridSource)


def read_grids(spark: SparkSession, folder: str, layout: Layout = Layout()) -> DataFrame:
    """(date, path, layer, lat, lon, value) of the grids of a folder; a filter on ``date`` reads the files of those days only."""
    register(spark)
    return spark.read.format(FORMAT).options(**asdict(layout)).load(folder)


def write_grids(grids: DataFrame, folder: str, layout: Layout = Layout()) -> None:
    """One file per row of (date, content); a day that is written again is replaced. Days must be distinct."""
    register(grids.sparkSession)
    grids.select("date", "content").write.format(FORMAT).options(**asdict(layout)).mode("append").save(folder)
