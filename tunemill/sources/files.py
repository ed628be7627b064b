"""File lists of model repositories."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.sources.tables import written


def target_path(home: str, repo: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit(home.rstrip("/")), repo, name)


def file_manifest(models: DataFrame, files: DataFrame, home: str) -> DataFrame:
    """(lib, repo, name, target_path): the files of each model's repository under the model's own folder.

    `models` is (lib, repo): the name a model goes by here, and where it comes from; `files` is
    (repo, name). A repository may be in use under several names.
    """
    return models.select("lib", "repo").join(files.select("repo", "name"), "repo").select(
        "lib", "repo", "name", target_path(home, F.col("lib"), F.col("name")).alias("target_path")
    )


def list_files(spark: SparkSession, root: str, tasks: int = 64) -> DataFrame:
    """Files under `root` as (target_path, length); contents are not read, hidden names are passed over.

    Folders are opened level by level by tasks, `tasks` of them at once: the driver opens none and holds no
    name. A level is a written table, so that a lost task lists its own folders again and nothing else.
    """
    folders = spark.createDataFrame([(root,)], "folder string")
    files = []
    while True:
        # By number and not by key, so that folders of one parent are spread as well.
        opened = folders.repartition(tasks).mapInArrow(_opened, "path string, is_folder boolean, length long")
        found = written(opened, "listed")
        files.append(found.where("NOT is_folder"))
        folders = found.where("is_folder").select(F.col("path").alias("folder"))
        if folders.isEmpty():
            return reduce(DataFrame.union, files).select(F.col("path").alias("target_path"), "length")


def _opened(batches: Iterator) -> Iterator:
    """What lies in the folders, one level deep."""
    import pyarrow as pa
    from pyarrow.fs import FileSelector, FileSystem, FileType

    for batch in batches:
        for folder in batch["folder"].to_pylist():
            # A path without a scheme, or a file: address with any number of slashes, is local.
            local = folder.removeprefix("file:") if folder.startswith("file:") else folder
            address = "/" + local.lstrip("/") if "://" not in folder or folder.startswith("file:") else folder
            system, place = FileSystem.from_uri(address)
            scheme = "" if address.startswith("/") else address.split("://")[0] + "://"
            infos = [i for i in system.get_file_info(FileSelector(place)) if not i.base_name.startswith(("_", "."))]
            yield pa.record_batch(
                [
                    pa.array([scheme + i.path for i in infos], pa.string()),
                    pa.array([i.type == FileType.Directory for i in infos], pa.bool_()),
                    pa.array([i.size for i in infos], pa.int64()),
                ],
                ["path", "is_folder", "length"],
            )


def pending_files(manifest: DataFrame, present: DataFrame, match_length: bool = False) -> DataFrame:
    """Manifest rows whose target does not exist yet, each once.

    Existence is enough by default, so a file written in part counts as done; with
    `match_length` the lengths have to agree too. Repeats on either side are merged before
    the join, so that many copies of one path do not meet in one task.
    """
    keys = ["target_path", "length"] if match_length else ["target_path"]
    return manifest.distinct().join(present.select(*keys).distinct(), keys, "left_anti")
