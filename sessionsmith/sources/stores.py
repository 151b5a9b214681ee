"""Stores that tasks open with pyarrow."""

from __future__ import annotations

from collections.abc import Callable


def store_opener() -> Callable[[str], tuple]:
    """A function that gives the store of a plain path and the path in it. It is a closure, so it travels to the Python workers by value and needs no import of this package there."""
    stores: dict[tuple[str, str], object] = {}

    def opened(path: str) -> tuple:
        """Local paths are not parsed as URIs: they may hold any character."""
        from urllib.parse import urlsplit

        from pyarrow import fs as pafs

        if path.startswith("file:"):
            path = "/" + path[len("file:") :].lstrip("/")
        if path.startswith("/"):
            return stores.setdefault(("file", ""), pafs.LocalFileSystem()), path
        scheme, _, rest = path.partition("://")
        bucket, _, inner = rest.partition("/")
        arrow = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        if (scheme, bucket) not in stores:
            stores[scheme, bucket] = pafs.FileSystem.from_uri(f"{arrow}://{urlsplit(f'x://{bucket}').netloc}/")[0]
        return stores[scheme, bucket], inner if arrow in ("hdfs", "viewfs") and inner.startswith("/") else f"/{inner}" if arrow == "hdfs" else f"{bucket}/{inner}"

    return opened
