"""Numbered commits: small JSON files, each of which exactly one writer gets to create.

A commit appears whole or not at all: it is written under a hidden name and then given its own by an operation that fails if the name is
taken (a hard link on a local disk, a rename elsewhere, as on HDFS). A store whose rename replaces its target needs a locking file system.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    found, files = _located(spark, path)
    return files.exists(found)


def exists_below(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a folder of ``root`` has a commit of this name; only the folders are listed."""
    pattern, files = _located(spark, f"{root}/*/{name}.json")
    return len(files.globStatus(pattern) or []) > 0


def create(spark: SparkSession, root: str, name: str, values: dict) -> bool:
    """Create the commit ``name`` below ``root``; False if there is one already, which then stays as it is."""
    target, files = _located(spark, f"{root}/{name}.json")
    draft, _ = _located(spark, f"{root}/.{name}-{uuid.uuid4().hex}")
    if files.exists(target):
        return False
    files.mkdirs(target.getParent())
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(values, default=str).encode()))
    out.close()
    try:
        if files.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
            return True
        return files.rename(draft, target)
    except FileExistsError:
        return False
    finally:
        files.delete(draft, False)


def last_number(spark: SparkSession, root: str) -> int:
    """The highest number below ``root``, 0 if there is none. Only names are listed."""
    path, files = _located(spark, root)
    if not files.exists(path):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return max((int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0].isdigit()), default=0)


def append(spark: SparkSession, root: str, values: dict, tries: int = 1000) -> int:
    """Commit under the next free number, which also stands in the commit as ``number``.

    Of writers that want the same number one gets it; the others go on with the next. So numbers are unique and
    their order is the order of the commits.
    """
    number = last_number(spark, root) + 1
    for _ in range(tries):
        if create(spark, root, f"{number:012d}", values | {"number": number}):
            return number
        number += 1
    raise RuntimeError(f"no free number below {root} after {tries} tries")
