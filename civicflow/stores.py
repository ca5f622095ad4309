"""Files of a store from inside tasks, by Arrow's file systems.

Workers have no Hadoop client.  ``Located`` names a file by its store
(scheme and authority) and its path there; ``opened`` gives the Arrow file
system of a store and the prefix that its paths take.  Stores that Arrow does
not know are left to Spark's own readers and to the driver's client.
"""

from __future__ import annotations

import re
import sys
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import cloudpickle

# fixed values: Hadoop's scheme names and Arrow's
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}

# files that get another name at a time
MOVES = 16
# scheme, authority and path of a file as Spark lists it
PLACE = re.compile(r"^([A-Za-z0-9+.-]+):(?://([^/]*))?(/.*)$", re.S)

# tasks need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Located(NamedTuple):
    scheme: str
    authority: str
    path: str


def located(fs, path) -> Located:
    """Where a Hadoop path lies, as its file system resolves it."""
    uri = fs.resolvePath(path).toUri()
    return Located(uri.getScheme() or "file", uri.getAuthority() or "", uri.getPath())


def reachable(place: Located) -> bool:
    """Whether tasks can open the store themselves."""
    return place.scheme in SCHEMES


def files_under(folder: Located) -> list[tuple[Located, str, int]]:
    """(place, name below ``folder``, bytes) of the files of a folder in a reachable store, in one listing; hidden ones are left out."""
    from pyarrow import fs

    store, prefix = opened(folder.scheme, folder.authority)
    root = prefix + folder.path.rstrip("/")
    found = []
    for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
        relative = info.path[len(root) + 1:]
        if info.type == fs.FileType.File and not any(part.startswith(("_", ".")) for part in relative.split("/")):
            found.append((folder._replace(path=info.path[len(prefix):]), relative, info.size))
    return found


def end_in(folder: Located, old: str, new: str) -> None:
    """Gives the files below a folder of a reachable store that end in ``old`` the ending ``new``, and their checksum files (``.<name>.crc``) too."""
    from pyarrow import fs

    store, prefix = opened(folder.scheme, folder.authority)

    def move(path: str) -> None:
        crc = ".crc" if path.endswith(".crc") else ""
        store.move(path, path.removesuffix(old + crc) + new + crc)

    names = [info.path for info in store.get_file_info(fs.FileSelector(prefix + folder.path, recursive=True))
             if info.type == fs.FileType.File and (info.base_name.endswith(f"{old}.crc") if info.base_name.startswith(".") else info.base_name.endswith(old))]
    # names only, no bytes, on stores that can rename
    with ThreadPoolExecutor(MOVES) as pool:
        list(pool.map(move, names))


def opened(scheme: str, authority: str):
    """(Arrow file system, prefix of its paths)."""
    from pyarrow import fs

    if scheme == "file":
        return fs.LocalFileSystem(), ""
    store, base = fs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{authority}/")
    return store, base.rstrip("/")
