"""Object keys and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def object_key(prefix: str, path: Column | str) -> Column:
    """The key of an object below ``prefix``, named as the last part of ``path``."""
    path = F.col(path) if isinstance(path, str) else path
    return F.concat_ws("/", F.lit(prefix), F.substring_index(path, "/", -1))


def strip_query(uri: Column | str) -> Column:
    """A URI up to its question mark."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    return F.substring_index(uri, "?", 1)
