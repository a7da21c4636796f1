"""brightness and colourfulness of thumbnails.

The only Python functions over row values in the package: Spark has no pixel arithmetic. They take bytes in Arrow batches,
those of plain bitmaps as the files have them, others as decoded by ``spark.read.format("image")``, whose
decoder puts each file into a temporary one. ``write_images`` is the sink that belongs to it: one file per row, written by
the tasks. Folders are listed by tasks too, into a table, so that the driver holds no list of files.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemark.session import cut, cut_all

#: File names that end in .bmp, and all others.
BITMAPS = "*.[bB][mM][pP]"
OTHERS = "{*[!pP],*[!mM][pP],*[!bB][mM][pP],*[!.][bB][mM][pP],[bB][mM][pP],[mM][pP],[pP]}"
#: Partitions of small files that one task reads, and the least tasks for each core.
READ_TOGETHER, TASKS = 32, 8
#: Files that one task measures, and files named to the image source at once.
FILES, NAMED = 10_000, 20_000


def _measure(height: int, width: int, channels: int, data: bytes) -> tuple[float, float]:
    try:
        pixels = np.frombuffer(data, dtype="uint8").reshape(height, width, channels).astype("float64")
        b, g, r = (pixels[..., min(i, channels - 1)] for i in range(3))
        brightness = np.rint(0.299 * r + 0.587 * g + 0.114 * b).mean()
        rg, yb = np.abs(r - g), np.abs(0.5 * (r + g) - b)
        colourful = np.hypot(rg.std(), yb.std()) + 0.3 * np.hypot(rg.mean(), yb.mean())
        return float(brightness), float(colourful)
    except (TypeError, ValueError):
        return 0.0, 0.0


def image_stats(image: Column) -> Column:
    """(brightness, colorfulness) of an image column, (0, 0) where it cannot be read."""

    @F.pandas_udf("brightness double, colorfulness double")
    def stats(images: pd.DataFrame) -> pd.DataFrame:
        rows = zip(images["height"], images["width"], images["nChannels"], images["data"])
        return pd.DataFrame([_measure(*row) for row in rows], columns=["brightness", "colorfulness"])

    return stats(image)


def thumbnail_stats(images: DataFrame) -> DataFrame:
    """Path, brightness and colourfulness of every image of an image source."""
    return images.select(F.col("image.origin").alias("origin"), image_stats(F.col("image")).alias("s")).select(
        "origin", "s.brightness", "s.colorfulness"
    )


def read_thumbnails(spark: SparkSession, root: str) -> DataFrame:
    """Brightness and colourfulness of every image file below a folder; broken files give (0, 0).

    Tasks list the folders, one level after the other, and read the files named .bmp as bytes; a task holds the list of
    one folder. Those that are no plain bitmaps, and all other files, are decoded by Spark's image source, to which ``NAMED``
    of them are named at a time. A folder that pyarrow cannot reach is listed by Spark, whose driver holds all names.
    """
    try:
        system, base = pa.fs.FileSystem.from_uri(_uri(root))
    except (pa.ArrowInvalid, ImportError, OSError):
        return _read_by_spark(spark, root)
    whole = spark._jvm.org.apache.hadoop.fs.Path(root)
    above = re.sub("^file:/+", "file:///", whole.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(whole).toString())
    files = _listed(spark, system, base)
    tasks = _tasks(spark, files.count(), FILES)
    seen = cut(files.repartition(tasks).mapInArrow(
        _measured(system, base), "path string, brightness double, colorfulness double, plain boolean"))
    told = seen.where("plain").select(F.concat(F.lit(f"{above}/"), "path").alias("origin"), "brightness", "colorfulness")
    odd = seen.where("not plain").select("path")
    if odd.isEmpty():
        return told
    return told.unionByName(cut_all(thumbnail_stats(part) for part in _decoded(spark, root, odd)))


def _uri(root: str) -> str:
    return root if "://" in root else f"file://{root.removeprefix('file:')}"


def _tasks(spark: SparkSession, n: int, each: int) -> int:
    return max(-(-n // each), min(n, TASKS * spark.sparkContext.defaultParallelism), 1)


def _hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _listed(spark: SparkSession, system: pa.fs.FileSystem, base: str) -> DataFrame:
    """The paths below a folder of all its files but hidden and empty ones, stored."""
    def run(batches):
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = [x for x in system.get_file_info(pa.fs.FileSelector(f"{base}/{folder}".rstrip("/") or "/")) if not _hidden(x.base_name)]
                found = [x for x in found if x.type == pa.fs.FileType.Directory or x.size]
                for lo in range(0, len(found), FILES):
                    some = found[lo: lo + FILES]
                    yield pa.RecordBatch.from_pydict({
                        "path": [f"{folder}/{x.base_name}".lstrip("/") for x in some],
                        "folder": [x.type == pa.fs.FileType.Directory for x in some]})

    folders, n, levels = spark.createDataFrame([("",)], "path string"), 1, []
    while n:
        levels.append(cut(folders.repartition(_tasks(spark, n, FILES)).mapInArrow(run, "path string, folder boolean")))
        folders = levels[-1].where("folder").select("path")
        n = folders.count()
    return reduce(DataFrame.unionByName, levels).where("not folder").select("path")


def _measured(system: pa.fs.FileSystem, base: str):
    """Measures of the files of these paths; those not named .bmp are not opened."""
    def run(batches):
        for batch in batches:
            paths, rows = batch.column("path").to_pylist(), []
            for path in paths:
                data = None
                if path[-4:].lower() == ".bmp":
                    with system.open_input_stream(f"{base}/{path}") as file:
                        data = file.read()
                rows.append((0.0, 0.0, False) if data is None else _plain(data))
            b, c, plain = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(b, pa.float64()), pa.array(c, pa.float64()), pa.array(plain, pa.bool_())],
                ["path", "brightness", "colorfulness", "plain"])
    return run


def _decoded(spark: SparkSession, root: str, odd: DataFrame) -> Iterator[DataFrame]:
    """The image source over files of these paths, ``NAMED`` at a time."""
    images = spark.read.format("image").option("dropInvalid", False)
    # A path is a pattern to Spark.
    paths = (re.sub(r"([{}\[\]*?\\])", r"\\\1", f"{root}/{r['path']}") for r in odd.toLocalIterator())
    while some := list(islice(paths, NAMED)):
        yield images.load(some)


def _read_by_spark(spark: SparkSession, root: str) -> DataFrame:
    """``read_thumbnails`` of a folder that only Spark's readers can reach."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", BITMAPS).load(root)
    parts = files.rdd.getNumPartitions()
    together = max(-(-parts // READ_TOGETHER), min(parts, TASKS * spark.sparkContext.defaultParallelism), 1)
    seen = cut(files.coalesce(together).select(_origin(F.col("path")).alias("origin"), bitmap_stats(F.col("content")).alias("s")))
    told = seen.where("s.plain").select("origin", "s.brightness", "s.colorfulness")
    images = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True)
    told = told.unionByName(thumbnail_stats(images.option("pathGlobFilter", OTHERS).load(root)))
    odd = seen.where("not s.plain").select("origin")
    if odd.isEmpty():
        return told
    named = images.option("pathGlobFilter", BITMAPS).load(root).withColumn("origin", _origin(F.col("image.origin")))
    decoded = named.join(odd, "origin", "left_semi").select("image")
    return told.unionByName(thumbnail_stats(decoded))


def _origin(path: Column) -> Column:
    """A file's name as the image source gives it."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def bitmap_stats(content: Column) -> Column:
    """(brightness, colorfulness, plain) of a column of files; not plain is what the image source has to decode."""

    @F.pandas_udf("brightness double, colorfulness double, plain boolean")
    def stats(contents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_plain(data) for data in contents], columns=["brightness", "colorfulness", "plain"])

    return stats(content)


def _plain(data: bytes) -> tuple[float, float, bool]:
    """Measures of an uncompressed 24-bit bitmap. A file of less than five bytes is no image in any format."""
    if len(data) < 5:
        return 0.0, 0.0, True
    if len(data) < 54 or data[:2] != b"BM":
        return 0.0, 0.0, False
    start, head, width, height, planes, bits, kind = struct.unpack("<IIiiHHI", data[10:34])
    line = 3 * width + -3 * width % 4
    if (start, head, planes, bits, kind) != (54, 40, 1, 24, 0) or width < 1 or height < 1 or len(data) < start + line * height:
        return 0.0, 0.0, False
    rows = np.frombuffer(data, "uint8", line * height, start).reshape(height, line)[::-1, :3 * width]
    return *_measure(height, width, 3, rows.tobytes()), True


def bitmap(width: int, height: int, pixels: bytes) -> bytes:
    """A 24-bit bitmap file of blue, green, red bytes, rows from the top."""
    padding = b"\0" * (-3 * width % 4)
    rows = [pixels[3 * width * y: 3 * width * (y + 1)] + padding for y in range(height)]
    data = b"".join(reversed(rows))
    head = struct.pack("<2sIHHI", b"BM", 54 + len(data), 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(data), 2835, 2835, 0, 0) + data


def write_images(images: DataFrame, root: str) -> int:
    """Write (name, width, height, pixels) rows as ``name``.bmp below a folder; how many were written.

    The folder is any that pyarrow can reach (file, hdfs, s3). A row's file has its own name in one of 256
    folders by hash, so a repeated task writes the same file again. Rows with a null or another number
    of pixels are written as files of one byte, which readers see as broken images (the file source skips
    empty ones).
    """
    root = root.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pa.fs.FileSystem.from_uri(_uri(root))
        done = 0
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{base}/{row['part']:02x}"
                system.create_dir(folder, recursive=True)
                whole = row["pixels"] is not None and len(row["pixels"]) == 3 * (row["width"] or 0) * (row["height"] or 0)
                with system.open_output_stream(f"{folder}/{row['name']}.bmp") as out:
                    out.write(bitmap(row["width"], row["height"], row["pixels"]) if whole else b"\0")
                done += 1
        yield pa.RecordBatch.from_pydict({"n": [done]})

    named = images.where("name is not null").select(
        "name", "width", "height", "pixels", F.pmod(F.xxhash64("name"), F.lit(256)).cast("int").alias("part"))
    return named.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0
