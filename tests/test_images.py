"""PNG decoding, images that a table names, and scoring by stacks."""

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.functions import laplacian_variance
from rollcall.functions.imaging import sharpness, sharpness_of
from rollcall.operators.scoring import batched, call, score_images, stacks, stub_scorer
from rollcall.sources import filter_images, list_files, read_images, read_named
from rollcall.sources.images import equal_bytes
from rollcall.sources.pngs import NotDecodable, decode_png
from tests.pngs import png


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def filtered(rows, step, kinds):
    """Bytes of PNG lines (height, bytes) under the given filters, by the definition of each filter."""
    out, above = b"", np.zeros(rows.shape[1], int)
    for y, line in enumerate(rows.astype(int)):
        left = np.concatenate([np.zeros(step, int), line[:-step]])
        corner = np.concatenate([np.zeros(step, int), above[:-step]])
        guess = left + above - corner
        far = np.abs(np.stack([guess - left, guess - above, guess - corner]))
        paeth = np.stack([left, above, corner])[far.argmin(0), np.arange(len(line))]
        less = [0, left, above, (left + above) // 2, paeth][kinds[y]]
        out += bytes([kinds[y]]) + ((line - less) & 255).astype(np.uint8).tobytes()
        above = line
    return out


def file(width, height, bits, colour, body, *more, interlaced=0):
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, interlaced)) + b"".join(more) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("colour,channels", [(0, 1), (2, 3), (4, 2), (6, 4)])
@pytest.mark.parametrize("bits", [8, 16])
def test_png_kinds_and_filters(colour, channels, bits):
    rng = np.random.default_rng(colour)
    step = channels * bits // 8
    for height, width in ((1, 1), (7, 3), (3, 9), (20, 20)):
        rows = rng.integers(0, 256, (height, width * step))
        image = decode_png(file(width, height, bits, colour, filtered(rows, step, rng.integers(0, 5, height))))
        pixels = rows.reshape(height, width, channels, bits // 8)[..., 0]
        want = pixels[..., {1: [0], 2: [0, 0, 0, 1], 3: [2, 1, 0], 4: [2, 1, 0, 3]}[channels]]
        assert np.array_equal(image, want)


def test_png_palettes_few_bits_and_what_is_not_read():
    rows = np.array([[0b00011011], [0b11100100]])
    palette = np.array([[1, 2, 3], [4, 5, 6], [7, 8, 9], [250, 251, 252]], np.uint8)
    body = filtered(rows, 1, [0, 2])
    image = decode_png(file(4, 2, 2, 3, body, chunk(b"PLTE", palette.tobytes())))
    assert np.array_equal(image, palette[[[0, 1, 2, 3], [3, 2, 1, 0]]][..., ::-1])
    clear = decode_png(file(4, 2, 2, 3, body, chunk(b"PLTE", palette.tobytes()), chunk(b"tRNS", bytes([0, 9]))))
    assert clear[..., 3].tolist() == [[0, 9, 255, 255], [255, 255, 9, 0]]
    assert decode_png(file(4, 2, 2, 0, body))[..., 0].tolist() == [[0, 85, 170, 255], [255, 170, 85, 0]]
    good = png(np.zeros((3, 3, 3)))
    for bad in (b"", b"RIFFxxxxWEBP", good[:20], good[:-30], file(3, 3, 8, 2, b"short"), file(1, 1, 8, 2, b"\x09abc"), file(1, 1, 8, 2, b"\0abc", interlaced=1), file(4, 2, 2, 3, body)):
        with pytest.raises(NotDecodable):
            decode_png(bad)


NAMES = ["plain.png", "b c.png", "d%20e.png", "a[1].png", "f{1,2}.png", "g+h.png", "i#j.png", "k*l.png", "é.png", "with space/deep %41/x.png"]


@pytest.fixture
def odd(tmp_path):
    rng = np.random.default_rng(4)
    images = {}
    for name in NAMES:
        images[name] = rng.integers(0, 255, (5, 4, 3)).astype(np.uint8)
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(png(images[name]))
    (tmp_path / "broken.png").write_bytes(b"none")
    return str(tmp_path), images


def test_every_name_is_read_alike(spark, odd):
    root, images = odd
    files = filter_images(list_files(spark, root), "pool").withColumn("note", F.lit("n"))
    rows = {os.path.relpath(r["path"], root): r for r in read_named(files, task_bytes=100).collect()}
    assert sorted(rows) == sorted([*images, "broken.png"]) and rows["plain.png"]["note"] == "n"
    assert not rows["broken.png"]["readable"] and rows["broken.png"]["image"]["height"] == -1
    for name, pixels in images.items():
        found = rows[name]["image"]
        assert rows[name]["readable"] and (found["height"], found["width"], found["nChannels"], found["mode"]) == (5, 4, 3, 16)
        assert bytes(found["data"]) == pixels[..., ::-1].tobytes()
    # Spark's own source gives the same paths and pixels
    whole = {r["path"]: bytes(r["image"]["data"]) for r in read_images(spark, root).where("readable").collect()}
    assert whole == {f"{root}/{n}": p[..., ::-1].tobytes() for n, p in images.items()}


def test_missing_files_and_other_decoders(spark, odd):
    root, _ = odd
    files = spark.createDataFrame([(f"{root}/plain.png", 9), (f"file://{root}/gone.png", None)], "path string, length long")
    with pytest.raises(Exception, match="gone.png"):
        read_named(files).collect()
    assert {os.path.basename(r["path"]): r["readable"] for r in read_named(files, missing="flag").collect()} == {"plain.png": True, "gone.png": False}
    one = read_named(files.limit(1), decode=lambda data: np.full((2, 3, 1), len(data) % 256, np.uint8)).first()
    assert one["image"]["nChannels"] == 1 and one["image"]["mode"] == 0
    assert read_named(files.limit(0)).count() == 0


def test_tasks_have_equal_bytes(spark):
    rows = [(f"/p{k:04d}", 1000 if k == 7 else k % 10) for k in range(400)]
    dealt = equal_bytes(spark.createDataFrame(rows, "path string, length long").repartition(5), 200)
    sizes = [r["s"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum("length").alias("s")).collect()]
    assert sum(sizes) == sum(n for _, n in rows) and sorted(sizes)[-2] <= 210 and max(sizes) <= 1200


def test_stacks_are_bounded_and_of_one_shape():
    shapes = [(2, 2, 3), (), (4, 4, 1), (2, 2, 3), (2, 2, 3), (100, 100, 3)]
    got = list(stacks(shapes, 24))
    assert got == [((2, 2, 3), [0, 3]), ((2, 2, 3), [4]), ((4, 4, 1), [2]), ((100, 100, 3), [5])]
    images = np.random.default_rng(5).integers(0, 255, (6, 4, 5, 3)).astype(np.uint8)
    assert sharpness_of(images) == pytest.approx([sharpness(i) for i in images])
    assert sharpness_of(images[..., :1]) == pytest.approx([sharpness(i) for i in images[..., :1]])


def test_a_failing_call_is_halved(spark, odd):
    calls = []

    @batched
    def picky(stack):
        calls.append(len(stack))
        if (stack == 7).any():
            raise RuntimeError("seven")
        return [{"age": int(i[0, 0, 0])} if i.any() else None for i in stack]

    stack = np.stack([np.full((1, 1, 1), k, np.uint8) for k in range(16)])
    found = call(picky, stack)
    assert found[7] == (None, "RuntimeError: seven") and found[0] == (None, None)
    assert [f["age"] for k, (f, _) in enumerate(found) if k not in (0, 7)] == [k for k in range(16) if k not in (0, 7)]
    assert calls == [16, 8, 8, 4, 4, 2, 2, 1, 1][: len(calls)] or sum(calls) < 16 * 5
    with pytest.raises(RuntimeError):
        call(picky, stack, "raise")
    short = batched(lambda stack: [])
    assert call(short, stack[:2])[0][1].startswith("ValueError: 0 results")
    # alike through Spark, whatever the size of a call
    root, images = odd
    files = list_files(spark, root)
    want = sorted(map(repr, score_images(read_named(files), stub_scorer(), sharp=True).collect()))
    assert sorted(map(repr, score_images(read_named(files), stub_scorer(), sharp=True, call_bytes=1).collect())) == want
    assert laplacian_variance(read_named(files)).where("laplacian_variance is null").count() == 1


def test_kinds_that_workers_cannot_decode(spark, tmp_path):
    from rollcall.plans.jobs import _images

    jvm = spark.sparkContext._jvm
    (tmp_path / "some folder").mkdir()
    picture = jvm.java.awt.image.BufferedImage(8, 6, 5)
    for name in ("a b.jpg", "some folder/c%20d.JPEG", "not named.jpg"):
        assert jvm.javax.imageio.ImageIO.write(picture, "jpg", jvm.java.io.File(str(tmp_path / name)))
    (tmp_path / "e.png").write_bytes(png(np.ones((2, 2, 3))))
    (tmp_path / "f.webp").write_bytes(b"RIFF")
    named = [str(tmp_path / n) for n in ("a b.jpg", "some folder/c%20d.JPEG", "e.png", "f.webp")]
    files = spark.createDataFrame([(n,) for n in named], "path string")
    rows = {r["path"]: r for r in _images(spark, files, str(tmp_path), None).collect()}
    assert sorted(rows) == sorted(named) and [rows[n]["readable"] for n in named] == [True, True, True, False]
    assert (rows[named[1]]["image"]["height"], rows[named[1]]["image"]["width"]) == (6, 8)
    with pytest.raises(Exception, match="no such image: .*gone.jpg"):
        _images(spark, files.unionAll(spark.createDataFrame([(str(tmp_path / "gone.jpg"),)], "path string")), str(tmp_path), None).collect()
    # a decoder of one's own takes all kinds
    own = _images(spark, files, str(tmp_path), lambda data: np.zeros((1, 1, 3), np.uint8))
    assert own.where("readable").count() == 4
