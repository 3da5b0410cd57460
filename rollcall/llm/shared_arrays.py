"""Arrays that tasks write to the shared folder and that workers map into memory.

A task writes a file of its own, under a name that no other attempt has, and returns the name as a row. Only rows of
tasks that ended well arrive, so files of lost attempts are never read, and a table of such rows is all that the
driver keeps: one for each partition. Where the shared folder is a path, readers map the file and the system
brings in the pages that are touched; in another store they read the file's bytes.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession

from ..storage import shared_dir

#: Files that a worker holds open; more are dropped together. The system maps some 65,000 at most.
_ALIGN, _open, _OPEN = 64, {}, 30_000


def arrays_folder(spark: SparkSession) -> str:
    """A new folder for arrays, as a URI that tasks can open."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/arrays/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    return re.sub("^file:/+", "file:///", fs.makeQualified(path).toString())


def put(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Write ``arrays`` as one file below ``folder``; its path."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{uuid.uuid4().hex}"
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // _ALIGN) * _ALIGN
    text = json.dumps(head).encode()
    text = len(text).to_bytes(8, "little") + text
    text += b" " * (-len(text) % _ALIGN)
    with store.open_output_stream(path) as out:
        out.write(text)
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).view(np.uint8).data if len(a) else b"")
            out.write(b"\0" * (-a.nbytes % _ALIGN))
    return f"{folder}/{path.rsplit('/', 1)[1]}"


def get(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory where the store is a path."""
    if uri not in _open:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        if isinstance(store, fs.LocalFileSystem):
            data = np.memmap(path, np.uint8, "r")
        else:
            with store.open_input_file(path) as f:
                data = np.frombuffer(f.read_buffer(), np.uint8)
        size = int(data[:8].view("<i8")[0])
        start = -(-(8 + size) // _ALIGN) * _ALIGN
        found = {}
        for name, (kind, n, at) in json.loads(bytes(data[8 : 8 + size])).items():
            d = np.dtype(kind)
            found[name] = np.asarray(data[start + at : start + at + n * d.itemsize].view(d))
        if len(_open) >= _OPEN:
            _open.clear()
        _open[uri] = found
    return _open[uri]


def forget(uri: str) -> None:
    """Let go of a file's arrays."""
    _open.pop(uri, None)


class Shards:
    """Files of arrays with sorted keys in array ``key``, each file's keys between those of its neighbours."""

    def __init__(self, rows: list[tuple[int, str]]):
        rows = sorted(rows)
        self.low = np.array([r[0] for r in rows], np.int64)
        self.paths = [r[1] for r in rows]

    def find(self, keys: np.ndarray) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
        """For each file with any of the sorted ``keys``: (arrays, places in ``keys``, places in the file)."""
        cut = np.append(np.searchsorted(keys, self.low), len(keys))
        for s, path in enumerate(self.paths):
            if cut[s] < cut[s + 1]:
                arrays = get(path)
                own = keys[cut[s] : cut[s + 1]]
                at = np.minimum(np.searchsorted(arrays["key"], own), len(arrays["key"]) - 1)
                hit = np.flatnonzero(arrays["key"][at] == own)
                yield arrays, hit + cut[s], at[hit]

    def values(self, keys: np.ndarray, names: dict[str, type], missing: int = 0) -> list[np.ndarray]:
        """Values of the sorted ``keys``, one array for each name."""
        out = [np.full(len(keys), missing, kind) for kind in names.values()]
        for arrays, here, there in self.find(keys):
            for o, name in zip(out, names, strict=True):
                o[here] = arrays[name][there]
        return out
