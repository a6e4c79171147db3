"""All layers of a run become visible at once: folders per generation, one manifest last."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

MANIFEST = re.compile(r"(\d{12})\.json")
FOLDER = re.compile(r"(\d{12})-[0-9a-f]{32}")


class Generations:
    """The published layers below ``root``.

    Data lies in ``_generations/<number>-<id>/`` and is never changed. A manifest
    ``_manifests/<number>.json`` names the folder of every layer; the highest number is what
    readers see. It is written under another name and then renamed, which every file system
    does at once for one file, so a reader sees all layers of one generation or all of the
    one before, however a publisher breaks off. Two publishers of one number: the second
    fails. Layers that a publisher does not name stay as they are.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def numbers(self) -> list[int]:
        """All published generations, oldest first."""
        return sorted(int(m[1]) for n in self._names("_manifests") if (m := MANIFEST.fullmatch(n)))

    def _manifest(self, number: int) -> str:
        return f"{self.root}/_manifests/{number:012}.json"

    def layers(self, number: int | None = None) -> dict[str, str]:
        """Layer to path, of the newest or of a given generation; empty before the first."""
        if number is None:
            published = self.numbers()
            if not published:
                return {}
            number = published[-1]
        text = self.spark.read.text(self._manifest(number), wholetext=True).first()[0]
        return {name: f"{self.root}/{rel}" for name, rel in json.loads(text).items()}

    def read(self, layer: str) -> DataFrame:
        return self.spark.read.parquet(self.layers()[layer])

    def begin(self) -> str:
        """A new folder for the layers of the next generation, invisible to readers."""
        following = max(self.numbers(), default=0) + 1
        return f"{self.root}/_generations/{following:012}-{uuid.uuid4().hex}"

    def publish(self, folder: str, layers: Mapping[str, str], dropped: Collection[str] = ()) -> int:
        """Make ``layers`` (name to path below ``folder``) visible and ``dropped`` ones not; returns the number."""
        name = folder.rsplit("/", 1)[1]
        number = int(FOLDER.fullmatch(name)[1])
        published = self.numbers()
        if published and published[-1] >= number:
            raise RuntimeError(f"generation {number} was published by another run")
        before = {k: v.removeprefix(f"{self.root}/") for k, v in self.layers().items() if k not in dropped}
        text = json.dumps({**before, **{k: f"_generations/{name}/{rel}" for k, rel in layers.items()}})
        draft = self._path(f"{self.root}/_manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        final = self._path(self._manifest(number))
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"generation {number} was published by another run")
        return number

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the newest ``keep`` generations; returns the folders removed.

        Folders that a kept manifest names stay, and so do those begun after the newest one:
        they may be another run at work. Folders of runs that failed go with their time.
        """
        published = self.numbers()
        kept, gone = published[-keep:], published[:-keep]
        if not kept:
            return []
        named = {path.removeprefix(f"{self.root}/_generations/").split("/")[0] for n in kept for path in self.layers(n).values()}
        folders = [n for n in self._names("_generations") if (m := FOLDER.fullmatch(n)) and int(m[1]) <= kept[-1]]
        removed = [n for n in folders if n not in named]
        for number in gone:
            self._fs.delete(self._path(self._manifest(number)), False)
        for name in removed:
            self._fs.delete(self._path(f"{self.root}/_generations/{name}"), True)
        return removed
