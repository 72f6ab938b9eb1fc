"""Stage tables that later runs and other applications find again.

A stage is known by what makes it: its analysed plan, the parameters it was given, and the names,
sizes and times of the files it reads.  Its data lie in a folder of their own, and only a commit file,
written last, makes them a stage; a writer that is killed leaves a folder that no one reads.  Of two
writers of one stage the first to commit wins, and both go on from its data.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

COMMIT, USED = "commit.json", "used"
FIELDS = "spark.sql.debug.maxToStringFields"


class StageStore:
    """Stages under ``root``, a folder that outlives the application."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.written = 0  # by this store object

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def _put(self, path: str, text: str, overwrite: bool) -> bool:
        """Writes a small file; without ``overwrite`` the first writer wins."""
        try:
            out = self._fs(path).create(self._path(path), overwrite)
        except Py4JJavaError as error:
            if overwrite or not self._fs(path).exists(self._path(path)):
                raise error
            return False
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _read(self, path: str) -> str | None:
        fs = self._fs(path)
        if not fs.exists(self._path(path)):
            return None
        stream = fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _files(self, names: list[str]) -> list[tuple[str, int, int]]:
        status = [self._fs(n).getFileStatus(self._path(n)) for n in sorted(names)]
        return [(str(s.getPath()), s.getLen(), s.getModificationTime()) for s in status]

    def key(self, df: DataFrame, params: dict) -> str:
        """Digest of plan, parameters and input files.

        Python functions enter the plan by their name only, and rows from the driver not at all, so
        what they depend on belongs in ``params``; a plan without input files must have some.
        """
        files = self._files(list(df.inputFiles()))
        if not files and not params:
            raise ValueError("a stage that reads no file is known by its parameters; give some")
        plan = self._whole_plan(df)
        facts = [self.spark.version, plan, json.dumps(params, sort_keys=True), df.schema.json(), files]
        return hashlib.sha256(json.dumps(facts).encode()).hexdigest()

    def _whole_plan(self, df: DataFrame) -> str:
        """The plan as text, without cuts in long lists of columns."""
        before = self.spark.conf.get(FIELDS)
        self.spark.conf.set(FIELDS, str(2**31 - 1))
        try:
            return df._jdf.queryExecution().analyzed().canonicalized().treeString()
        finally:
            self.spark.conf.set(FIELDS, before)

    def get(self, df: DataFrame, label: str, **params) -> DataFrame:
        """``df`` from its stage, which is written if no run has committed it yet or its files are no longer whole."""
        home = f"{self.root}/{label}/{self.key(df, params)}"
        found = self._committed(home)
        if found is None:
            data = f"{home}/data-{uuid.uuid4().hex}"
            df.write.parquet(data)
            self.written += 1
            mark = json.dumps({"data": data, "files": self._listed(data)})
            if not self._put(f"{home}/{COMMIT}", mark, overwrite=False):
                found = self._committed(home)
                if found is None:  # the earlier commit names files that are gone
                    self._put(f"{home}/{COMMIT}", mark, overwrite=True)
            found = found or data
        self._put(f"{home}/{USED}", str(time.time()), overwrite=True)
        return self.spark.read.schema(df.schema).parquet(found)

    def _listed(self, data: str) -> list[list]:
        files = self._fs(data).listStatus(self._path(data))
        return sorted([f.getPath().getName(), f.getLen()] for f in files)

    def _committed(self, home: str) -> str | None:
        text = self._read(f"{home}/{COMMIT}")
        if not text:
            return None
        mark = json.loads(text)
        whole = self._fs(home).exists(self._path(mark["data"])) and self._listed(mark["data"]) == mark["files"]
        return mark["data"] if whole else None

    def collect(self, unused_seconds: float) -> int:
        """Deletes stages that no run has used for so long, and data of that age that were never committed; returns their number."""
        fs, gone, now = self._fs(self.root), 0, time.time()
        if not fs.exists(self._path(self.root)):
            return 0
        for label in fs.listStatus(self._path(self.root)):
            for home in fs.listStatus(label.getPath()):
                path = str(home.getPath())
                kept = self._committed(path)
                used = float(self._read(f"{path}/{USED}") or home.getModificationTime() / 1000)
                if now - used >= unused_seconds:
                    gone += fs.delete(home.getPath(), True)
                    continue
                for entry in fs.listStatus(home.getPath()):
                    left = entry.getPath().getName().startswith("data-") and not (kept or "").endswith(entry.getPath().getName())
                    if left and now - entry.getModificationTime() / 1000 >= unused_seconds:
                        gone += fs.delete(entry.getPath(), True)
        return gone
