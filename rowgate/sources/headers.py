"""The headers of delimited files: each file's own, read by the driver like a listing.

Spark takes the names of the first file for all of them and reads the rest by position. Here
files are grouped by the header they really have, so each group can be read by its names.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from .staging import file_system

#: Headers that are read at the same time.
AT_ONCE = 32


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """The first line of a file that is not blank; None if there is none. Compressed files are decompressed."""
    jvm = spark.sparkContext._jvm
    fs, file = file_system(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(file)
    stream = fs.open(file)
    try:
        content = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, encoding))
        line = reader.readLine()
        while line is not None and not line.strip("﻿ \t\r"):
            line = reader.readLine()
        return line
    finally:
        stream.close()


def names_in(line: str, options: Mapping[str, object]) -> tuple[str, ...]:
    """The column names of a header line; nameless and repeated ones get their number, as Spark does it."""
    sep = str(options.get("sep", options.get("delimiter", ",")))
    quote = str(options.get("quote", '"')) or None
    fields = next(
        csv.reader(
            [line.lstrip("﻿")], delimiter="\t" if sep == r"\t" else sep,
            quotechar=quote, quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE,
        )
    )
    fields = [f.strip() if _true(options.get("ignoreLeadingWhiteSpace")) else f for f in fields]
    lowered = [f.lower() for f in fields]
    return tuple(
        f"_c{i}" if not f else f"{f}{i}" if lowered.count(f.lower()) > 1 else f for i, f in enumerate(fields)
    )


def _true(option: object) -> bool:
    return str(option).lower() == "true"


def files_by_header(
    spark: SparkSession, paths: Sequence[str], options: Mapping[str, object]
) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header, in the order of the names of the files; empty files have none."""
    files = sorted(spark.read.text(list(paths)).inputFiles())
    encoding = str(options.get("encoding", options.get("charset", "UTF-8")))
    read = inheritable_thread_target(spark)(lambda file: first_line(spark, file, encoding))
    with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
        lines = list(pool.map(read, files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line is not None:
            found.setdefault(names_in(line, options), []).append(file)
    return found
