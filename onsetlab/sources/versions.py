"""Folders that are written whole and then entered as the current version.

A version is a folder below a root. Entries, one small file each, say in which
order versions became current; readers take the last. An entry appears with its
whole content or not at all, and a number is given to one writer only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from onsetlab.sources.staging import remove_folders

COMMITS = "_commits"


def new_folder(path: str) -> str:
    """A name below ``path`` that no other version has."""
    return f"{path.rstrip('/')}/v{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, folder: str, facts: dict, keep: int = 1) -> None:
    """Make ``folder`` the current version, and remove all but ``keep`` older ones."""
    root = f"{path.rstrip('/')}/{COMMITS}"
    entry = json.dumps({**facts, "folder": folder.rsplit("/", 1)[1]})
    number = max((int(n) for n in _names(spark, root) if n.isdigit()), default=0) + 1
    while not write_once(spark, f"{root}/{number:012d}", entry):
        number += 1
    known = committed(spark, path)
    kept = {known_entry["folder"] for _, known_entry in known[-1 - keep :]}
    gone = [(n, e["folder"]) for n, e in known if e["folder"] not in kept]
    remove_folders(spark, [f"{root}/{n:012d}" for n, _ in gone] + [f"{path.rstrip('/')}/{f}" for _, f in gone])


def current_folder(spark: SparkSession, path: str) -> str | None:
    known = committed(spark, path)
    return f"{path.rstrip('/')}/{known[-1][1]['folder']}" if known else None


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def qualified(spark: SparkSession, path: str) -> str:
    files, where = _files(spark, path)
    return files.makeQualified(where).toString()


def committed(spark: SparkSession, path: str) -> list[tuple[int, dict]]:
    """Numbers and entries of the versions that were entered, oldest first."""
    folder = f"{path.rstrip('/')}/{COMMITS}"
    out = []
    for name in _names(spark, folder):
        # A writer that died left an entry without content.
        if name.isdigit() and (text := read_text(spark, f"{folder}/{name}")):
            out.append((int(name), json.loads(text)))
    return out


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _files(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a name that no other writer has; whether that went well."""
    files, where = _files(spark, path)
    # The content is complete before the name appears, and a name is given once.
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}.draft")
    stream = files.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    done = not files.exists(where) and files.rename(draft, where)
    if not done:
        files.delete(draft, False)
    return done


