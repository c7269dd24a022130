"""Versions of a stored dataset as a log of numbered commits.

A version is a small JSON file `_log/<number>.json` that names the folders the dataset consists of. A file is
complete before it gets its name, and a name is given only if no one has it, so of two writers
with the same number one has to look again: `commit` calls its function anew on the version that won, and
nothing of either is lost. Folders no version names are left over from a writer that failed; readers never see them.

A store must be able to refuse a name that exists: Hadoop file systems do on rename, a local disk on a hard link.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

LOG = "_log"
Entry = dict


def hadoop(spark: SparkSession, path: str):
    """(file system, path object) of a path in whatever store it is in."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def remove(spark: SparkSession, path: str) -> None:
    fs, target = hadoop(spark, path)
    fs.delete(target, True)


def latest(spark: SparkSession, root: str) -> tuple[int, Entry]:
    """Number and content of the newest version; 0 and nothing before the first."""
    fs, log = hadoop(spark, f"{root}/{LOG}")
    if not fs.exists(log):
        return 0, {}
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]
    return (max(numbers), read(spark, root, max(numbers))) if numbers else (0, {})


def read(spark: SparkSession, root: str, number: int) -> Entry:
    return json.loads(spark.read.option("wholetext", True).text(_name(root, number)).first()[0])


def commit(spark: SparkSession, root: str, make: Callable[[Entry], Entry | None]) -> int:
    """Add what `make` returns for the newest version as the next one; returns its number.

    `make` writes the folders its entry names. It is called again if another writer was first, and may return
    None where the newest version has it all already.
    """
    while True:
        number, entry = latest(spark, root)
        made = make(entry)
        if made is None:
            return number
        if create_absent(spark, _name(root, number + 1), json.dumps(made, sort_keys=True)):
            return number + 1


def create_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file under a name of its own, then give it its final name unless that is taken."""
    fs, target = hadoop(spark, path)
    fs.mkdirs(target.getParent())
    _, draft = hadoop(spark, f"{target.getParent().toString()}/.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        return _named(spark, fs, draft, target)
    finally:
        fs.delete(draft, False)


def _named(spark: SparkSession, fs, draft, target) -> bool:
    """One step that succeeds for one writer only."""
    jvm = spark._jvm
    from py4j.protocol import Py4JJavaError

    try:
        if fs.getScheme() == "file":
            paths = [jvm.java.nio.file.Path.of(p.toUri().getPath(), _strings(spark)) for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*paths)
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark._jsc.hadoopConfiguration()
            )
            context.rename(draft, target, options)
    except Py4JJavaError as refused:
        if refused.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def _strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)


def _name(root: str, number: int) -> str:
    return f"{root}/{LOG}/{number:020d}.json"
