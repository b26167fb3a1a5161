"""Map extracts as XML, by a Python data source: one file is one partition, read as a stream of elements."""

from __future__ import annotations

import glob
from collections.abc import Iterator
from xml.etree.ElementTree import iterparse

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "kind string, id long, lon double, lat double, tags map<string,string>, nodes array<long>, members array<struct<kind:string,ref:long,role:string>>"


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[tuple]:
        for _, e in iterparse(partition.path):
            if e.tag in ("node", "way", "relation"):
                tags = {t.get("k"): t.get("v") for t in e.iter("tag")}
                place = [float(e.get(k)) if e.get(k) else None for k in ("lon", "lat")]
                nodes = [int(n.get("ref")) for n in e.iter("nd")]
                members = [(m.get("type")[0], int(m.get("ref")), m.get("role") or "") for m in e.iter("member")]
                yield (e.tag[0], int(e.get("id")), *place, tags, nodes, members)
                e.clear()


class OsmXml(DataSource):
    """spark.dataSource.register(OsmXml); spark.read.format("osm_xml").load("dir/*.osm")"""

    @classmethod
    def name(cls) -> str:
        return "osm_xml"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        path = self.options["path"]
        return _Reader(sorted(glob.glob(path)) or [path])
