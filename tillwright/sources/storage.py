"""Tables at paths: written by Spark to fresh folders, shown by the catalogue.

A table that is replaced is written to a folder of its own first. One statement,
``CREATE OR REPLACE VIEW``, then makes the catalogue's view of the table's path select
from that folder; until then readers see the table as it was, and nothing is renamed.
Several tables below one base can be shown by one such statement: their base then has a
view that lists them. The catalogue has to outlive the session where tables shall; in
one that does not, ``adopt`` shows a finished folder again. Folders that no view names
any more stay until ``drop_unshown`` is called.

A folder that rows are only added to needs no view and is read as it is.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSION = "v-"
#: The partition column of a table that is kept in buckets.
BUCKET = "key_bucket"
#: Metastores limit the length of a property's value.
PROPERTY = 3000


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_fs(spark, path).exists(_path(spark, path)))


def has_data(spark: SparkSession, path: str) -> bool:
    """The folder holds a finished data file; unfinished writes lie in folders that don't count."""
    fs = _fs(spark, path)
    root = _path(spark, path)
    if not fs.exists(root):
        return False
    base = str(fs.getFileStatus(root).getPath().toString())
    files = fs.listFiles(root, True)
    while files.hasNext():
        below = str(files.next().getPath().toString())[len(base) :].strip("/").split("/")
        if not any(part.startswith(("_", ".", VERSION)) for part in below):
            return True
    return False


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


# --- what the catalogue shows -----------------------------------------------------


@dataclass(frozen=True)
class Shown:
    """The folder that makes up a table, and its columns.

    A table that is kept in buckets has ``buckets`` of them at most, and ``parts`` says in
    which folder the files of each are.
    """

    schema: T.StructType
    folder: str | None = None
    buckets: int | None = None
    parts: dict[int, str] = field(default_factory=dict)

    @property
    def folders(self) -> list[str]:
        if self.buckets is None:
            return [self.folder]
        return [f"{self.parts[b]}/{BUCKET}={b}" for b in sorted(self.parts)]

    def queries(self) -> list[str]:
        """What to select from, one for each version that has a part in the table."""
        if self.buckets is None:
            return [f"parquet.{_quoted(self.folder)}"]
        own: dict[str, list[int]] = {}
        for bucket, folder in sorted(self.parts.items()):
            own.setdefault(folder, []).append(bucket)
        return [
            f"parquet.{_quoted(f)} WHERE {BUCKET} IN ({', '.join(_text(str(b)) for b in buckets)})"
            for f, buckets in own.items()
        ]

    def as_json(self) -> dict:
        return {
            "schema": self.schema.jsonValue(),
            "folder": self.folder,
            "buckets": self.buckets,
            "parts": {str(k): v for k, v in self.parts.items()},
        }

    @staticmethod
    def from_json(kept: dict) -> Shown:
        parts = {int(k): v for k, v in kept["parts"].items()}
        return Shown(T.StructType.fromJson(kept["schema"]), kept["folder"], kept["buckets"], parts)


def view_name(spark: SparkSession, path: str) -> str:
    """The catalogue's name for a path: its last part and a hash of all of it."""
    whole = str(_fs(spark, path).makeQualified(_path(spark, path)).toString()).rstrip("/")
    last = "".join(c if c.isalnum() and c.isascii() else "_" for c in whole.rsplit("/", 1)[-1].lower())
    return f"{last[:60]}_{hashlib.sha256(whole.encode()).hexdigest()[:16]}"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _selection(tables: dict[str, Shown], has_files: bool) -> str:
    """The view's query: the rows of one table, or the names and folders of several."""
    if set(tables) != {""}:
        rows = [f"({_text(n)}, {_text(f)})" for n, t in sorted(tables.items()) for f in t.folders]
        none = "SELECT CAST(NULL AS STRING) AS name, CAST(NULL AS STRING) AS folder WHERE false"
        return f"SELECT * FROM VALUES {', '.join(rows)} AS t(name, folder)" if rows else none
    (table,) = tables.values()
    typed = [f"CAST({{}} AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in table.schema]
    queries = table.queries() if has_files else []
    if not queries:
        return f"SELECT {', '.join(c.format('NULL') for c in typed)} WHERE false"
    columns = ", ".join(c.format(_quoted(f.name)) for c, f in zip(typed, table.schema, strict=True))
    return " UNION ALL ".join(f"SELECT {columns} FROM {q}" for q in queries)


def _show(spark: SparkSession, path: str, tables: dict[str, Shown]) -> None:
    """The one statement that makes a write visible."""
    # An empty table in partitions has no file that would tell its columns.
    own = tables.get("")
    has_files = own is None or own.buckets is not None or _any_file(spark, own.folder)
    kept = json.dumps({n: t.as_json() for n, t in tables.items()})
    chunks = [kept[i : i + PROPERTY] for i in range(0, len(kept), PROPERTY)]
    properties = ", ".join(f"'shown_{i:05d}' = {_text(c)}" for i, c in enumerate(chunks))
    # Partition values keep their text; the view casts them to the columns' types.
    guess = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(guess)
    spark.conf.set(guess, "false")
    try:
        spark.sql(
            f"CREATE OR REPLACE VIEW {view_name(spark, path)} COMMENT {_text(path)} "
            f"TBLPROPERTIES ({properties}) AS {_selection(tables, has_files)}"
        )
    finally:
        spark.conf.set(guess, before)


def _any_file(spark: SparkSession, folder: str) -> bool:
    files = _fs(spark, folder).listFiles(_path(spark, folder), True)
    while files.hasNext():
        if not str(files.next().getPath().getName()).startswith(("_", ".")):
            return True
    return False


def _shown(spark: SparkSession, path: str) -> dict[str, Shown]:
    name = view_name(spark, path)
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    chunks = sorted((r["key"], r["value"]) for r in rows if r["key"].startswith("shown_"))
    return {n: Shown.from_json(t) for n, t in json.loads("".join(c for _, c in chunks)).items()}


def _split(path: str) -> tuple[str, str]:
    base, _, name = path.rstrip("/").rpartition("/")
    return base, name


def current(spark: SparkSession, path: str) -> Shown | None:
    """What the catalogue shows for a table, by its own view or that of its base."""
    own = _shown(spark, path).get("")
    if own is not None:
        return own
    base, name = _split(path)
    return _shown(spark, base).get(name)


def show(spark: SparkSession, path: str, table: Shown) -> None:
    """Make these folders the table."""
    base, name = _split(path)
    if name in _shown(spark, base):
        show_together(spark, base, {name: table})
    else:
        _show(spark, path, {"": table})


def show_together(spark: SparkSession, base: str, tables: dict[str, Shown]) -> None:
    """Make several tables of a base visible in one step; its other tables stay."""
    _show(spark, base, {n: t for n, t in _shown(spark, base).items() if n} | tables)


def shown_together(spark: SparkSession, base: str) -> dict[str, Shown]:
    return {n: t for n, t in _shown(spark, base).items() if n}


# --- writing and reading ------------------------------------------------------------

#: Version folders that this process began. One that is not shown was not finished here.
_OWN: set[str] = set()


def new_version(path: str) -> str:
    """A folder for the next write of a table; it is invisible until it is shown."""
    folder = f"{path.rstrip('/')}/{VERSION}{uuid.uuid4().hex}"
    _OWN.add(folder.rsplit("/", 1)[-1])
    return folder


def _finished(spark: SparkSession, path: str) -> list[str]:
    """Version folders that a write has finished, the newest first."""
    fs, root = _fs(spark, path), _path(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        folder = str(status.getPath().toString())
        mark = _path(spark, f"{folder}/_SUCCESS")
        if str(status.getPath().getName()).startswith(VERSION) and fs.exists(mark):
            found.append((int(fs.getFileStatus(mark).getModificationTime()), folder))
    return [f for _, f in sorted(found, reverse=True)]


def adopt(spark: SparkSession, path: str, folder: str | None = None) -> None:
    """Show a finished folder (the newest) of a table that this catalogue does not know.

    For tables that are one folder; one in buckets has as many folders as batches touched it.
    """
    folder = folder or next(iter(_finished(spark, path)), None)
    if folder is None:
        raise LookupError(f"no finished folder below {path}")
    show(spark, path, Shown(spark.read.parquet(folder).schema, folder))


def drop_unshown(spark: SparkSession, path: str) -> list[str]:
    """Remove the finished folders of a table that the catalogue does not show."""
    table = current(spark, path)
    if table is None:
        return []
    used = {f.rsplit("/", 1)[-1] for f in (table.parts.values() if table.buckets else [table.folder])}
    gone = [f for f in _finished(spark, path) if f.rsplit("/", 1)[-1] not in used]
    for folder in gone:
        remove(spark, folder)
    return gone


def read_shown(spark: SparkSession, table: Shown) -> DataFrame:
    if not table.folders:
        return spark.createDataFrame([], table.schema)
    found = spark.read.schema(table.schema).parquet(*table.folders)
    return found.select(*[_quoted(n) for n in table.schema.names])  # partition columns come last in files


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table as the catalogue shows it, or a plain folder of files."""
    path = path.rstrip("/")
    table = current(spark, path)
    return spark.read.parquet(path) if table is None else read_shown(spark, table)


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether there is such a table; versions that the catalogue does not know are an error.

    Taking them for no table would start a history anew.
    """
    path = path.rstrip("/")
    if current(spark, path) is not None or has_data(spark, path):
        return True
    if any(f.rsplit("/", 1)[-1] not in _OWN for f in _finished(spark, path)):
        raise LookupError(f"the catalogue does not show {path}, which has finished folders; use storage.adopt")
    return False


def write_folder(spark: SparkSession, path: str) -> str:
    """Where rows are appended: the shown folder, or the plain folder."""
    table = current(spark, path.rstrip("/"))
    return path if table is None else table.folder
