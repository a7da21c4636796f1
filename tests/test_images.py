import os
import struct
from urllib.parse import unquote

import numpy as np
import pytest

from pulsemark.functions import images
from pulsemark.functions.images import bitmap, read_thumbnails, write_images


def test_written_images_are_read_back(spark, folder):
    rng = np.random.default_rng(2)
    shapes = {"a": (3, 5), "b": (4, 4), "c": (1, 1), "d": (7, 2)}
    pixels = {k: rng.integers(0, 256, (h, w, 3), dtype="uint8") for k, (w, h) in shapes.items()}
    rows = [(k, *shapes[k], pixels[k].tobytes()) for k in shapes] + [
        ("none", 2, 2, None), ("short", 2, 2, b"abc"), (None, 1, 1, b"abc")]
    df = spark.createDataFrame(rows, "name string, width int, height int, pixels binary")
    assert write_images(df, folder) == 6
    assert write_images(df.limit(0), folder) == 0
    assert write_images(df.where("name = 'a'"), folder) == 1  # again, the same file
    got = {r.origin.split("/")[-1]: r for r in read_thumbnails(spark, folder).collect()}
    assert set(got) == {f"{k}.bmp" for k in [*shapes, "none", "short"]}
    for k, p in pixels.items():
        b, g, r = (p[..., i].astype(float) for i in range(3))
        rg, yb = abs(r - g), abs(0.5 * (r + g) - b)
        assert got[f"{k}.bmp"].brightness == pytest.approx(np.rint(0.299 * r + 0.587 * g + 0.114 * b).mean())
        assert got[f"{k}.bmp"].colorfulness == pytest.approx(
            np.hypot(rg.std(), yb.std()) + 0.3 * np.hypot(rg.mean(), yb.mean()))
    assert (got["none.bmp"].brightness, got["short.bmp"].colorfulness) == (0.0, 0.0)


def test_plain_bitmaps_pass_by_the_image_decoder(spark, folder):
    rows = spark.range(300).selectExpr("concat('n', id) name", "5 width", "2 height", "unhex(substr(sha2(cast(id as string), 256), 1, 60)) pixels")
    write_images(rows, folder)
    decoded = spark.read.format("image").option("recursiveFileLookup", True).load(folder)
    wanted = {tuple(r) for r in images.thumbnail_stats(decoded).collect()}
    read = read_thumbnails(spark, folder)
    assert {tuple(r) for r in read.collect()} == wanted and len(wanted) == 300
    assert not any(f.endswith(".bmp") for f in read.inputFiles())  # nothing is left to the image source


def test_other_files_are_decoded_by_the_image_source(spark, folder):
    data = bitmap(2, 2, bytes(range(12)))
    os.makedirs(f"{folder}/x")
    named = {"a.bmp": data, "b.BMP": data, "x/c.png": data, "p": data, "mp": data, "bmp": data, "d.jpg": b"broken file",
             "e.bmp": b"neither is this", "f.bmp": b"\0", "g.bmp": b"", "xbmp": data,
             "long.bmp": data + b"more", "short.bmp": data[:-1],
             "down.bmp": data[:22] + struct.pack("<i", -2) + data[26:]}
    for name, content in named.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(content)
    source = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(folder)
    wanted = sorted(tuple(r) for r in images.thumbnail_stats(source).collect())
    assert sorted(tuple(r) for r in read_thumbnails(spark, folder).collect()) == wanted
    assert len(wanted) == len(named) - 1  # empty files are passed over


def test_folders_are_listed_by_tasks(spark, folder, monkeypatch):
    """The driver names a bounded number of files to Spark at a time; names that are patterns or have blanks are found."""
    data = bitmap(2, 2, bytes(range(12)))
    wanted = {"a b.bmp": 5.5, "s/[z].bmp": 5.5, "s/bad one.bmp": 0.0, "s/t/{q}.png": 5.5, "s/t/o*.bmp": 0.0, "s/t/p.png": 5.5, "_k=1/a.bmp": 5.5}
    others = ["_u.bmp", ".v.bmp", "s/_hidden/a.bmp", ".h/a.bmp", "w._COPYING_", "s/e.bmp"]
    for name in [*wanted, *others]:
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"" if name == "s/e.bmp" else b"no image" if wanted.get(name) == 0.0 else data)
    os.makedirs(f"{folder}/none/below")
    given, reader = [], type(spark.read)

    def load(self, path=None, *a, call=reader.load, **b):
        given.append(path)
        return call(self, path, *a, **b)
    monkeypatch.setattr(reader, "load", load)
    monkeypatch.setattr(images, "NAMED", 2, raising=False)
    monkeypatch.setattr(images, "FILES", 2, raising=False)
    got = [(unquote(r.origin.removeprefix(f"file://{folder}/")), r.brightness) for r in read_thumbnails(spark, folder).collect()]
    assert sorted(got) == sorted(wanted.items())
    given = [paths for paths in given if paths is not None]  # parquet() passes none
    assert given and all(isinstance(paths, list) and len(paths) <= 2 for paths in given)


def test_a_folder_that_only_spark_reaches(spark, folder, monkeypatch):
    write_images(spark.createDataFrame([("a", 1, 1, b"abc")], "name string, width int, height int, pixels binary"), folder)
    wanted = read_thumbnails(spark, folder).collect()
    monkeypatch.setattr(images, "_uri", lambda root: "viewfs://store/x")
    assert read_thumbnails(spark, folder).collect() == wanted and len(wanted) == 1
