"""Tables whose every change is one commit.

Rows lie in folders by partition and commit. A manifest names, for each
partition, the commit that holds its rows, and is published by one rename. A
reader takes the newest manifest, so it sees a change as a whole or not at all,
whatever partitions it touches; folders of a commit that was never published
are named nowhere. Older manifests are older versions and can be read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymill.sinks import storage

COMMIT = "_commit"


class CommitConflict(RuntimeError):
    """Another writer has published since the version that a change was made from."""


@dataclass(frozen=True)
class Manifest:
    """A version: its columns, and the commit that holds the rows of each partition.

    ``notes`` are whatever a writer publishes along with the rows.
    """

    version: int
    schema: str
    partition: str
    parts: dict[str, str]
    notes: dict = field(default_factory=dict)

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def versions(spark: SparkSession, path: str) -> list[int]:
    names = storage.names_in(spark, f"{path}/versions")
    return [int(n.removesuffix(".json")) for n in names if not n.startswith(".")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """A version of a table, or the newest; None if nothing was published yet."""
    known = versions(spark, path)
    if version is None:
        if not known:
            return None
        version = known[-1]
    elif version not in known:
        raise ValueError(f"{path} has no version {version}")
    return Manifest(**json.loads(storage.read_text(spark, _manifest_path(path, version))))


def _manifest_path(path: str, version: int) -> str:
    return f"{path}/versions/{version:012d}.json"


def _folder(spark: SparkSession, path: str, found: Manifest, part: str) -> str:
    within = storage.partition_folder(spark, found.partition, part)
    return f"{path}/data/{within}/{COMMIT}={found.parts[part]}"


def read_parts(
    spark: SparkSession, path: str, found: Manifest, parts: Sequence[str] | None = None
) -> DataFrame:
    """The rows of a version, or of some of its partitions. No other folder is listed."""
    chosen = [p for p in (found.parts if parts is None else parts) if p in found.parts]
    columns = found.columns
    if not chosen:
        return spark.createDataFrame([], columns)
    # Commits are text, however much like numbers they look.
    shape = StructType([*columns.fields]).add(COMMIT, "string")
    folders = [_folder(spark, path, found, p) for p in chosen]
    rows = spark.read.schema(shape).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*columns.names)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the newest version, or of another."""
    found = manifest(spark, path, version)
    if found is None:
        raise ValueError(f"nothing was published at {path}")
    return read_parts(spark, path, found)


def commit(
    rows: DataFrame,
    path: str,
    partition: str,
    touched: Sequence[str],
    base: Manifest | None,
    notes: dict | None = None,
) -> Manifest:
    """Publish ``rows`` in place of what the partitions ``touched`` hold in version ``base``.

    ``touched`` are the partitions that ``rows`` have, all others stay. If
    someone has published since ``base``, ``CommitConflict`` is raised and the
    table is as that writer left it.
    """
    spark = rows.sparkSession
    token = uuid.uuid4().hex
    if touched:
        (
            rows.hint("rebalance", partition)
            .withColumn(COMMIT, F.lit(token))
            .write.partitionBy(partition, COMMIT)
            .mode("append")
            .parquet(f"{path}/data")
        )
    parts = {**(base.parts if base else {}), **dict.fromkeys(touched, token)}
    schema = base.schema if base else rows.schema.json()
    version = base.version + 1 if base else 1
    made = Manifest(version, schema, partition, parts, notes or (base.notes if base else {}))
    if not storage.publish_text(spark, json.dumps(asdict(made)), _manifest_path(path, version)):
        raise CommitConflict(f"version {version} of {path} was published by another writer")
    return made


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Keep the newest versions, and remove the others and what only they hold.

    Folders of unfinished commits go too, so no writer may be at work.
    """
    if keep < 1:
        raise ValueError("keep at least the newest version")
    known = versions(spark, path)
    for version in known[:-keep]:
        storage.remove(spark, _manifest_path(path, version))
    held = set()
    for version in known[-keep:]:
        found = manifest(spark, path, version)
        held |= {(storage.partition_folder(spark, found.partition, p), f"{COMMIT}={c}") for p, c in found.parts.items()}
    for part in storage.names_in(spark, f"{path}/data"):
        if part.startswith("_"):
            continue
        for made in storage.names_in(spark, f"{path}/data/{part}"):
            if (part, made) not in held:
                storage.remove(spark, f"{path}/data/{part}/{made}")
