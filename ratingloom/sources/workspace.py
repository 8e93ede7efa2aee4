"""Which paths a run may replace."""

from __future__ import annotations

import getpass
import os
import posixpath
import re
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

# Ports that a file system address may leave out.
DEFAULT_PORTS = {"hdfs": "8020", "webhdfs": "9870"}
WILDCARD = re.compile(r"[*?\[{]")


def default_file_system(spark: SparkSession) -> str:
    """The file system of paths without a scheme."""
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"


def qualified(path: str, default_fs: str = "file:///") -> list[str]:
    """Scheme, authority and path components by which two paths can be compared.

    Relative paths start at the working directory, or at the user's home if the file
    system is not the local one. A port that the scheme implies is left out, ``..`` is
    resolved, and a glob ends before its first component with a wildcard.
    """
    address = urlsplit(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else None
    base = urlsplit(default_fs)
    scheme, authority = base.scheme or "file", base.netloc
    if address:
        path = path.split(":", 1)[1]
        if path.startswith("//"):
            path = "/" + path[2:].partition("/")[2]
        if address.scheme != scheme or address.netloc:
            scheme, authority = address.scheme, address.netloc
    if not path.startswith("/"):
        home = os.getcwd() if scheme == "file" else f"/user/{getpass.getuser()}"
        path = posixpath.join(home, path)
    host, _, port = authority.lower().partition(":")
    if port and port != DEFAULT_PORTS.get(scheme):
        host = f"{host}:{port}"
    parts = []
    for part in path.split("/"):
        if WILDCARD.search(part):
            break
        if part == "..":
            parts = parts[:-1]
        elif part not in ("", "."):
            parts.append(part)
    return [scheme, host, *parts]


def require_disjoint(inputs: list[str], outputs: list[str], default_fs: str = "file:///") -> None:
    """Refuse outputs that lie in, hold, or equal an input or one another."""
    for index, output in enumerate(outputs):
        for other in inputs + outputs[:index]:
            a, b = qualified(output, default_fs), qualified(other, default_fs)
            shorter = min(len(a), len(b))
            if a[:shorter] == b[:shorter]:
                raise ValueError(f"{output} overlaps {other}")
