"""Snapshot paths: keys, segments, archive targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def drop_first_slash(path: Column) -> Column:
    """Remove the first ``/``, wherever it is."""
    return F.regexp_replace(path, r"\A([^/]*)/", "$1")


def first_segment(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def join_path(folder: Column, name: Column) -> Column:
    """``folder/name`` with one slash between; NULL if either is."""
    return F.concat(F.regexp_replace(folder, r"/+\z", ""), F.lit("/"), name)


def date_folder(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def archive_path(path: Column, root: str, day: Column) -> Column:
    """Where a positive page's snapshot goes: ``root/yyyy-MM-dd/basename``."""
    return join_path(join_path(F.lit(root), date_folder(day)), basename(path))
