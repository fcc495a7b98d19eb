"""Transcripts and documents as files: discovery, the cursor, selection, reading."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marl.operators.ordered import running_total

RECORD = "type string, uuid string, parentUuid string, logicalParentUuid string, isSidechain boolean, isMeta boolean, subtype string, compactMetadata struct<trigger:string,preTokens:int>, message struct<role:string,id:string,content:string>, cwd string, gitBranch string"


def encode_project(path: str) -> str:
    """The folder name of a project: slashes and dots become hyphens."""
    return re.sub(r"[/.]", "-", path)


def listing(spark: SparkSession, root: str, pattern: str = "*.jsonl") -> DataFrame:
    """(path, project, session_id, size, mtime) of the files below `root`; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.element_at(F.split("path", "/"), -2).alias("project"), F.regexp_replace(name, r"\.[^.]*$", "").alias("session_id"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def discover(spark: SparkSession, root: str, project: str | None = None, exclude: tuple[str, ...] = (), skip_self: str | None = None) -> DataFrame:
    """Transcripts of the projects that hold `project` and none of `exclude`; the project `skip_self` and those below it are left out."""
    found = listing(spark, root)
    if project is not None:
        found = found.where(F.col("project").contains(project))
    for part in exclude:
        found = found.where(~F.col("project").contains(part))
    if skip_self is not None:
        own = encode_project(skip_self)
        found = found.where((F.col("project") != own) & ~F.col("project").startswith(own + "-"))
    return found


def unseen(files: DataFrame, cursor: DataFrame) -> DataFrame:
    """Files whose path, size and time are not all in the cursor."""
    return files.join(cursor.select("path", "size", "mtime").distinct(), ["path", "size", "mtime"], "left_anti")


def selected(files: DataFrame, since: str | None = None, last: int | None = None) -> DataFrame:
    """Files changed at or after `since`, and of these the `last` newest, ties by path."""
    if since is not None:
        files = files.where(F.col("mtime") >= F.to_timestamp(F.lit(since)))
    return files if last is None else files.orderBy(F.desc("mtime"), "path").limit(last)


def read_lines(spark: SparkSession, root: str, pattern: str = "*.jsonl") -> DataFrame:
    """(path, pos, line) of text files; bytes that are no UTF-8 are replaced, blank lines are left out. A file of any size is read
    in blocks; a line's place is its number in its block after the lines of the blocks before."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "\n").text(root)
    rows = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), F.make_valid_utf8("value").alias("line"))
    placed = running_total(rows, ["path"], F.struct("block", "seq"), "block", F.lit(1), "pos")
    line = F.regexp_replace("line", "\r$", "")
    return placed.select("path", (F.col("pos") - 1).cast("int").alias("pos"), line.alias("line")).where(F.trim("line") != "")


def parse_records(lines: DataFrame) -> DataFrame:
    """Transcript records of (path, pos, line): lines that are no JSON object are left out; a list as content stays its JSON text."""
    rows = lines.withColumn("rec", F.from_json("line", RECORD, {"mode": "PERMISSIVE"})).where(F.try_parse_json("line").isNotNull() & F.trim("line").startswith("{"))
    session = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return rows.select(session.alias("session_id"), "pos", "rec.*")


def origins(records: DataFrame) -> DataFrame:
    """(session_id, cwd, git_branch, lines): the first cwd, and the first branch on a row up to it."""
    truthy = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    first = lambda c: F.min(F.when(truthy(c), F.struct("pos", c)))
    g = records.groupBy("session_id").agg(first("cwd").alias("c"), first("gitBranch").alias("b"), F.count("*").alias("lines"))
    within = F.col("c").isNull() | (F.col("b.pos") <= F.col("c.pos"))
    return g.select("session_id", F.col("c.cwd").alias("cwd"), F.when(within, F.col("b.gitBranch")).alias("git_branch"), "lines")


def read_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, text, size, mtime) of documents; a file that is no UTF-8 is an error."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select("path", F.validate_utf8(F.col("content").cast("string")).alias("text"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def repo_label(cwd: Column, project: Column) -> Column:
    """The last part of the working folder, else the project."""
    return F.coalesce(F.nullif(F.regexp_extract(cwd, r"([^/]+)/*$", 1), F.lit("")), F.nullif(project, F.lit("")))
