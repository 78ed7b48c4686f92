"""Which of several loads may publish.

A load claims the number of its commit by a file that holds the load's token.
File systems that create a file only if there is none (HDFS, a local disk)
decide at once. Object stores look first and write then, so two loads that
start together can both get through: there every load waits ``settle`` seconds
after it has written and reads the file again. Whoever wrote last finds its own
token and has won; the others find another one. That is safe as long as no load
takes longer than ``settle`` from looking to writing, and the claim is read
once more before anything is published, so a load that was held up finds out.

The claim of a load that failed stays, marked as such: its number, and so the
folder it wrote to, is never used again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from gridtide.sources.datasets import on_file_system

# Schemes whose file systems create a file atomically, and the mark of a failed load.
ATOMIC = ("file", "hdfs")
FAILED = "failed"
SETTLE_SECONDS = 20.0


class Files(Protocol):
    """What a claim needs of a file system."""

    atomic: bool

    def create(self, path: str, content: str) -> bool:
        """Write a file unless there is one; False if there is one."""

    def write(self, path: str, content: str) -> None:
        """Write a file, whatever is there."""

    def read(self, path: str) -> str | None:
        """What is in a file, None if there is none."""


class HadoopFiles:
    """Small files on whatever file system a path is on."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        scheme = on_file_system(spark, root)[1].getUri().getScheme()
        self.atomic, self.local = scheme in ATOMIC, scheme == "file"

    def _put(self, path: str, content: str, overwrite: bool) -> None:
        hadoop_path, files = on_file_system(self.spark, path)
        if self.local and not overwrite:
            # Hadoop's local file system looks first and writes then; Java's own does not.
            files.mkdirs(hadoop_path.getParent())
            jvm = self.spark._jvm
            options = self.spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
            options[0], options[1] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW, jvm.java.nio.file.StandardOpenOption.WRITE
            jvm.java.nio.file.Files.write(jvm.java.io.File(hadoop_path.toUri().getPath()).toPath(), bytearray(content.encode()), options)
            return
        out = files.create(hadoop_path, overwrite)
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()

    def create(self, path: str, content: str) -> bool:
        if self.read(path) is not None:
            return False
        try:
            self._put(path, content, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def write(self, path: str, content: str) -> None:
        self._put(path, content, True)

    def read(self, path: str) -> str | None:
        hadoop_path, files = on_file_system(self.spark, path)
        if not files.exists(hadoop_path):
            return None
        source = files.open(hadoop_path)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


class Claims:
    """Numbered claims below a folder."""

    def __init__(self, files: Files, folder: str, settle: float = SETTLE_SECONDS, sleep: Callable[[float], None] = time.sleep):
        self.files, self.folder, self.settle, self.sleep = files, folder.rstrip("/"), settle, sleep

    def path(self, number: int) -> str:
        return f"{self.folder}/_claim-{number}"

    def take(self, after: int) -> tuple[int, str] | None:
        """The first number beyond ``after`` that no failed load has used, and
        the token it is claimed with; None if another load has claimed it."""
        number, token = after + 1, uuid.uuid4().hex
        while self.files.read(self.path(number)) == FAILED:
            number += 1
        if not self.files.create(self.path(number), token):
            return None
        if not self.files.atomic:
            self.sleep(self.settle)
        return (number, token) if self.holds(number, token) else None

    def holds(self, number: int, token: str) -> bool:
        return self.files.read(self.path(number)) == token

    def give_up(self, number: int, token: str) -> None:
        """Mark a claim as failed, if it is still this load's own."""
        if self.holds(number, token):
            self.files.write(self.path(number), FAILED)
