"""Headers of many text files: read each one's first line, and group files that agree.

A file's columns go by its own header, so files of one folder may have their columns in
different orders, or lack some.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from predial.contracts import ContractError

FIRST_BYTES, LONGEST_LINE = 1 << 14, 1 << 22
AT_ONCE = 16  # files whose first lines are read at the same time


def _first_line(spark: SparkSession, file: str) -> str:
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(spark._jvm.java.net.URI(file))
    conf = spark._jsc.hadoopConfiguration()
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    stream = codec.createInputStream(stream) if codec else stream
    try:
        read = b""
        while b"\n" not in read and b"\r" not in read:
            more = bytes(stream.readNBytes(FIRST_BYTES))
            read += more
            if len(more) < FIRST_BYTES:
                break
            if len(read) > LONGEST_LINE:
                raise ContractError(f"{file}: no line ends in the first {LONGEST_LINE} bytes")
    finally:
        stream.close()
    return read.decode("utf-8-sig", "replace").splitlines()[0] if read else ""


def files_by_header(
    spark: SparkSession, path: str | Sequence[str], sep: str
) -> dict[tuple[str, ...], list[str]]:
    """The titles of each header that occurs, and the files that have it.

    Only the beginnings of files are read, by the driver's file system client and a few at a
    time; the driver holds a name a file, as Spark's own listing does. Files without any
    content have no header and no rows, and are left out.
    """
    files = spark.read.text(path if isinstance(path, str) else list(path)).inputFiles()
    with ThreadPoolExecutor(AT_ONCE) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line:
            titles = tuple(t.strip() for t in next(csv.reader([line], delimiter=sep)))
            found.setdefault(titles, []).append(file)
    return found


def columns_of(
    headers: Mapping[tuple[str, ...], list[str]], names: Sequence[str] | None, label: str
) -> dict[tuple[str, ...], list[str]]:
    """For each header the names of its columns, in the order of its files.

    With `names`, a header whose titles are all among them, in any case of letters, goes by
    its titles. One other header may occur and is renamed by position, as long as it has as
    many columns; several ones can't be told apart and are refused. Without `names`, the
    titles of the widest header are the names, and a header with other titles is refused.
    """
    widest = max(headers, key=lambda t: (len(t), t), default=())
    wanted = list(names or widest)
    known = {w.casefold(): w for w in wanted}
    found, unknown = {}, []
    for titles in headers:
        own = [known.get(t.casefold()) for t in titles]
        if None in own or len(set(own)) < len(own):
            unknown.append(titles)
        else:
            found[titles] = own
    by_position = names is not None and len(unknown) == 1 and len(unknown[0]) == len(wanted)
    if by_position and not found:
        return {unknown[0]: wanted}
    if unknown:
        several = [f"{list(t)} in {headers[t][0]}" for t in unknown]
        raise ContractError(f"{label}: {len(wanted)} fields {wanted} expected, found {'; '.join(several)}")
    return found
