"""GeoTIFF scenes as a Spark data source ("furrow_tiff"), and a writer of tiles.

A scene is a file or a folder of `*.tif` / `*.tiff`; each tile (block_size pixels square, ragged at the end) is one input
partition, and a task reads only the strips or tiles of the file that it needs. Rows are (scene, doy, band, tile_r, tile_c, r, c,
value); missing values (the file's nodata, or NaN) are null. Files must lie on storage that every executor mounts; scenes in an
object store are read by `scenes_binary`, which takes whole files through Spark's own reader.
"""

from __future__ import annotations

import glob
import io
import math
import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "scene string, doy int, band int, tile_r int, tile_c int, r long, c long, value double"
_kinds = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q"}


def resolve(path: str | Sequence[str], root: str | None = None) -> list[str]:
    """The files of a folder (sorted), a file, or a list; relative ones are looked for under root as well."""
    if not isinstance(path, str):
        return [f for p in path for f in resolve(p, root)]
    for place in (path, os.path.join(root, path) if root and not os.path.isabs(path) else path):
        if os.path.isdir(place):
            found = sorted(f for e in ("*.tif", "*.tiff") for f in glob.glob(os.path.join(place, e)))
            if found:
                return found
        elif os.path.isfile(place):
            return [place]
    raise FileNotFoundError(f"no TIFF files at {path}")


def parse_doy(name: str, default: int = 150) -> int:
    """The day in a file name, as functions.geo.parse_doy says."""
    if m := re.search(r"doy[_-]?(\d+)", name, re.IGNORECASE):
        return int(m[1])
    if m := re.search(r"(\d{4})(\d{2})(\d{2})", name):
        import datetime

        try:
            return datetime.date(*map(int, m.groups())).timetuple().tm_yday
        except ValueError:
            return default
    return default


@dataclass
class Tiff:
    """Tags of one file and how to read its blocks."""

    path: str
    width: int = 0
    height: int = 0
    bands: int = 1
    kind: np.dtype = field(default_factory=lambda: np.dtype("u1"))
    compression: int = 1
    predictor: int = 1
    planar: int = 1
    block: tuple[int, int] = (0, 0)
    offsets: tuple[int, ...] = ()
    counts: tuple[int, ...] = ()
    nodata: float | None = None
    transform: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0)
    epsg: int | None = None
    order: str = "<"
    lut: bytes = b""

    @classmethod
    def open(cls, path: str, data: bytes | None = None) -> Tiff:
        with (io.BytesIO(data) if data is not None else open(path, "rb")) as f:
            head = f.read(8)
            order = {b"II": "<", b"MM": ">"}.get(head[:2])
            if order is None or struct.unpack(order + "H", head[2:4])[0] != 42:
                raise ValueError(f"{path} is no TIFF file")
            f.seek(struct.unpack(order + "I", head[4:])[0])
            tags: dict[int, tuple] = {}
            for _ in range(struct.unpack(order + "H", f.read(2))[0]):
                tag, kind, n, raw = struct.unpack(order + "HHI4s", f.read(12))
                if kind not in _kinds:
                    continue
                form = order + (f"{n}s" if kind == 2 else _kinds[kind] * n)
                size = struct.calcsize(form)
                if size > 4:
                    here = f.tell()
                    f.seek(struct.unpack(order + "I", raw)[0])
                    raw = f.read(size)
                    f.seek(here)
                tags[tag] = struct.unpack(form, raw[:size])
        one = lambda t, d=None: tags[t][0] if t in tags else d
        bits, sample = one(258, 1), one(339, 1)
        out = cls(path, one(256), one(257), one(277, 1), np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[sample]}{bits // 8}"), one(259, 1), one(317, 1), one(284, 1), order=order)
        tiled = 322 in tags
        out.block = (one(323), one(322)) if tiled else (min(one(278, out.height), out.height), out.width)
        out.offsets, out.counts = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
        if 42113 in tags:
            text = tags[42113][0].split(b"\0")[0].decode().strip()
            out.nodata = float(text) if text else None
        if 33550 in tags and 33922 in tags:
            (sx, sy, *_), (i, j, _, x, y, *_) = tags[33550], tags[33922]
            out.transform = (sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy)
        if 34735 in tags:
            keys = tags[34735]
            geo = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
            out.epsg = geo.get(3072) or geo.get(2048)
        return out

    def _decode(self, raw: bytes) -> bytes:
        if self.compression == 1:
            return raw
        if self.compression in (8, 32946):
            return zlib.decompress(raw)
        if self.compression == 5:
            return lzw_decode(raw)
        raise ValueError(f"compression {self.compression} is not read")

    def window(self, band: int, r0: int, r1: int, c0: int, c1: int, data: bytes | None = None) -> np.ndarray:
        """One band (from 1) of a window, as doubles with NaN for nodata."""
        bh, bw = self.block
        across = -(-self.width // bw)
        down = -(-self.height // bh)
        chunky = self.planar == 1 and self.bands > 1
        out = np.full((r1 - r0, c1 - c0), np.nan)
        with (io.BytesIO(data) if data is not None else open(self.path, "rb")) as f:
            for i in range(r0 // bh, -(-r1 // bh)):
                for j in range(c0 // bw, -(-c1 // bw)):
                    k = i * across + j + (0 if self.planar == 1 else (band - 1) * across * down)
                    f.seek(self.offsets[k])
                    a = np.frombuffer(self._decode(f.read(self.counts[k])), self.kind)
                    n = self.bands if chunky else 1
                    a = a[: a.size // (bw * n) * bw * n].reshape(-1, bw, n)
                    if self.predictor == 2:
                        a = np.cumsum(a, axis=1, dtype=a.dtype)
                    a = a[:, :, band - 1 if chunky else 0]
                    y0, y1, x0, x1 = max(r0, i * bh), min(r1, i * bh + a.shape[0]), max(c0, j * bw), min(c1, (j + 1) * bw)
                    if y1 > y0 and x1 > x0:
                        out[y0 - r0 : y1 - r0, x0 - c0 : x1 - c0] = a[y0 - i * bh : y1 - i * bh, x0 - j * bw : x1 - j * bw]
        if self.nodata is not None and not math.isnan(self.nodata):
            out[out == self.nodata] = np.nan
        return out


def lzw_decode(raw: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, most significant bit first."""
    table: list[bytes] = []
    out, bits, n, width, last = [], 0, 0, 9, b""
    for byte in raw:
        bits, n = (bits << 8) | byte, n + 8
        if n < width:
            continue
        code = (bits >> (n - width)) & ((1 << width) - 1)
        n -= width
        bits &= (1 << n) - 1
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if code == 257:
            break
        entry = table[code] if code < len(table) else last + last[:1]
        out.append(entry)
        if last:
            table.append(last + entry[:1])
        last = entry
        width = 12 if len(table) >= 2047 else 11 if len(table) >= 1023 else 10 if len(table) >= 511 else 9
    return b"".join(out)


def metadata(path: str | Sequence[str], root: str | None = None) -> list[dict]:
    """One entry a scene and date, by day: file, band (null: all are one date's), doy, size, transform, EPSG code, nodata.

    One file of several bands that is no multispectral one (6 bands or more) holds a date a band, 30 days apart.
    """
    files = resolve(path, root)
    out = []
    for k, f in enumerate(files):
        t = Tiff.open(f)
        same = {"file": f, "height": t.height, "width": t.width, "bands": t.bands, "transform": t.transform, "epsg": t.epsg, "nodata": t.nodata, "multispectral": t.bands >= 6}
        if len(files) == 1 and 1 < t.bands < 6:
            out += [same | {"band": b, "doy": 30 * b} for b in range(1, t.bands + 1)]
        else:
            out.append(same | {"band": None, "doy": parse_doy(os.path.basename(f), (k + 1) * 30)})
    return sorted(out, key=lambda m: m["doy"])


class _Tile(InputPartition):
    def __init__(self, file: str, doy: int, bands: list[int], tile: tuple[int, int], window: tuple[int, int, int, int]) -> None:
        self.file, self.doy, self.bands, self.tile, self.window = file, doy, bands, tile, window


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.size = options["path"], int(options.get("block_size", 1024))
        self.bands = [int(b) for b in options["bands"].split(",")] if options.get("bands") else None

    def partitions(self) -> list[_Tile]:
        out = []
        for m in metadata(self.path):
            bands = [m["band"]] if m["band"] else self.bands or ([1, 2, 3, 4, 5] if m["multispectral"] else [1])
            out += [
                _Tile(m["file"], m["doy"], bands, (i, j), (i * self.size, min((i + 1) * self.size, m["height"]), j * self.size, min((j + 1) * self.size, m["width"])))
                for i in range(-(-m["height"] // self.size)) for j in range(-(-m["width"] // self.size))
            ]
        return out

    def read(self, part: _Tile) -> Iterator[pa.RecordBatch]:
        t, (r0, r1, c0, c1) = Tiff.open(part.file), part.window
        for band in part.bands:
            yield batch(os.path.basename(part.file), part.doy, band, part.tile, r0, c0, t.window(band, r0, r1, c0, c1))


def batch(scene: str, doy: int, band: int, tile: tuple[int, int], r0: int, c0: int, a: np.ndarray) -> pa.RecordBatch:
    n, (h, w) = a.size, a.shape
    v = a.ravel()
    return pa.RecordBatch.from_arrays(
        [pa.array([scene] * n, pa.string()), *(pa.array(np.full(n, x), pa.int32()) for x in (doy, band, *tile)), pa.array(np.repeat(np.arange(r0, r0 + h), w), pa.int64()), pa.array(np.tile(np.arange(c0, c0 + w), h), pa.int64()), pa.array(v, pa.float64(), mask=np.isnan(v))],
        ["scene", "doy", "band", "tile_r", "tile_c", "r", "c", "value"],
    )


class TiffSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "furrow_tiff"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:  # noqa: ANN001
        return _Reader(dict(self.options))


def scenes(spark: SparkSession, path: str, block_size: int = 1024, bands: Sequence[int] | None = None) -> DataFrame:
    """Tiles of all scenes at a path, one task a tile."""
    spark.dataSource.register(TiffSource)
    reader = spark.read.format("furrow_tiff").option("path", path).option("block_size", str(block_size))
    return (reader.option("bands", ",".join(map(str, bands))) if bands else reader).load()


def scenes_binary(spark: SparkSession, path: str, block_size: int = 1024, bands: Sequence[int] | None = None) -> DataFrame:
    """The same rows from files that only Spark's reader can open; a file is one task's."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{tif,tiff}").option("recursiveFileLookup", "true").load(path).select("path", "content")
    wanted = list(bands) if bands else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                name, t = os.path.basename(name), Tiff.open(name, data)
                for band in wanted or ([1, 2, 3, 4, 5] if t.bands >= 6 else [1]):
                    for r0 in range(0, t.height, block_size):
                        for c0 in range(0, t.width, block_size):
                            yield batch(name, parse_doy(name), band, (r0 // block_size, c0 // block_size), r0, c0, t.window(band, r0, min(r0 + block_size, t.height), c0, min(c0 + block_size, t.width), data))

    return files.mapInArrow(run, SCHEMA)


def pixel_series(tiles: DataFrame) -> DataFrame:
    """(r, c, days, values): one row a pixel, dates in order, null where missing."""
    s = F.sort_array(F.collect_list(F.struct("doy", "value")))
    return tiles.groupBy("r", "c").agg(s.alias("s")).select("r", "c", F.transform("s", lambda x: x["doy"]).alias("days"), F.transform("s", lambda x: x["value"]).alias("values"))


def write_tiff(path: str, a: np.ndarray, *args, **kwargs) -> None:
    """tiff_bytes() in a local file."""
    with open(path, "wb") as f:
        f.write(tiff_bytes(a, *args, **kwargs))


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """A file at any path that Spark can reach."""
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def tiff_bytes(a: np.ndarray, transform: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), epsg: int | None = None, nodata: float | None = None, rows: int = 256) -> bytes:
    """A deflated TIFF of one band or several (bands, rows, cols), in strips."""
    a = a[None] if a.ndim == 2 else a
    n, h, w = a.shape
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    a = a.astype(a.dtype.newbyteorder("<"))
    strips = [zlib.compress(a[b, i : i + rows].tobytes()) for b in range(n) for i in range(0, h, rows)]
    tags = [
        (256, 4, (w,)), (257, 4, (h,)), (258, 3, (a.dtype.itemsize * 8,) * n), (259, 3, (8,)), (262, 3, (1,)), (273, 4, (0,) * len(strips)), (277, 3, (n,)), (278, 4, (rows,)),
        (279, 4, tuple(map(len, strips))), (284, 3, (2,)), (339, 3, (kind,) * n), *_place_tags(transform, epsg, nodata),
    ]
    begins = 8 + len(_directory(tags, 8)) + np.concatenate([[0], np.cumsum([len(s) for s in strips])[:-1]])
    tags = [(t, k, tuple(map(int, begins)) if t == 273 else v) for t, k, v in tags]
    return struct.pack("<2sHI", b"II", 42, 8) + _directory(tags, 8) + b"".join(strips)


def _place_tags(transform: tuple[float, ...], epsg: int | None, nodata: float | None) -> list[tuple[int, int, tuple]]:
    """Tags for where a raster lies and what stands for no value."""
    out: list[tuple[int, int, tuple]] = [(33550, 12, (transform[0], -transform[4], 0.0)), (33922, 12, (0.0, 0.0, 0.0, transform[2], transform[5], 0.0))]
    if epsg:
        projected = 32600 < epsg < 32800
        out.append((34735, 3, (1, 1, 0, 2, 1024, 0, 1, 1 if projected else 2, 3072 if projected else 2048, 0, 1, epsg)))
    if nodata is not None:
        out.append((42113, 2, (f"{nodata:g}\0".encode(),)))
    return out


def _directory(tags: list[tuple[int, int, tuple]], at: int, following: int = 0) -> bytes:
    """An image's directory that begins at byte `at` of the file, with the values that do not fit into its entries behind it."""
    end = at + 2 + 12 * len(tags) + 4
    entries, values = struct.pack("<H", len(tags)), b""
    for tag, kind, v in tags:
        raw = v[0] if kind == 2 else struct.pack("<" + _kinds[kind] * len(v), *v)
        entries += struct.pack("<HHI", tag, kind, len(raw) if kind == 2 else len(v))
        if len(raw) > 4:
            entries += struct.pack("<I", end + len(values))
            values += raw + b"\0" * (len(raw) % 2)
        else:
            entries += raw.ljust(4, b"\0")
    return entries + struct.pack("<I", following) + values


def write_pyramid(tiles: DataFrame, path: str, height: int, width: int, transform: tuple[float, ...], epsg: int | None = None, block_size: int = 1024) -> None:
    """class_tiles() of one size as a single tiled, deflated TIFF with its overviews; 255 is no value.

    Tiles come to the driver one partition at a time and go straight into the file. A file of 4 GB or more is an error: keep the table.
    """
    found: dict[int, dict[tuple[int, int], tuple[int, int]]] = {}

    def block(a: np.ndarray) -> tuple[int, int]:
        raw, at = zlib.compress(a.tobytes()), f.tell()
        if at + len(raw) >= 1 << 32:
            raise ValueError("the map is too large for one TIFF file; keep its table of tiles")
        f.write(raw)
        return at, len(raw)

    with open(path, "wb") as f:
        f.write(struct.pack("<2sHI", b"II", 42, 0))
        void = block(np.full((block_size, block_size), 255, np.uint8))  # shared by all places without a pixel
        for t in tiles.orderBy("level", "tile_r", "tile_c").toLocalIterator():
            a = np.full((block_size, block_size), 255, np.uint8)
            y, x = t["r0"] - t["tile_r"] * block_size, t["c0"] - t["tile_c"] * block_size
            a[y : y + t["height"], x : x + t["width"]] = np.frombuffer(zlib.decompress(t["body"]), np.uint8).reshape(t["height"], t["width"])
            found.setdefault(t["level"], {})[t["tile_r"], t["tile_c"]] = block(a)
        images = []
        for k in sorted(found.keys() | {1}):
            h, w = -(-height // k), -(-width // k)
            places = [found.get(k, {}).get((i, j), void) for i in range(-(-h // block_size)) for j in range(-(-w // block_size))]
            images.append([
                (254, 4, (int(k > 1),)), (256, 4, (w,)), (257, 4, (h,)), (258, 3, (8,)), (259, 3, (8,)), (262, 3, (1,)), (277, 3, (1,)), (284, 3, (1,)), (322, 3, (block_size,)), (323, 3, (block_size,)),
                (324, 4, tuple(p[0] for p in places)), (325, 4, tuple(p[1] for p in places)), (339, 3, (1,)), *_place_tags((transform[0] * k, 0.0, transform[2], 0.0, transform[4] * k, transform[5]), epsg, 255),
            ])
        at = first = f.tell() + f.tell() % 2
        f.seek(at)
        for i, tags in enumerate(images):
            after = at + len(_directory(tags, at))
            f.write(_directory(tags, at, after if i + 1 < len(images) else 0))
            at = after
        f.seek(4)
        f.write(struct.pack("<I", first))


CATALOG = "scene string, doy int, bands int, height long, width long, multispectral boolean, step double, x0 double, y0 double, epsg int, nodata double"


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row a file at a path that Spark can reach, from its header: scene, doy, size, transform, EPSG code and nodata."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{tif,tiff}").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        for b in batches:
            rows = []
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                name, t = os.path.basename(name), Tiff.open(name, data)
                rows.append((name, parse_doy(name), t.bands, t.height, t.width, t.bands >= 6, t.transform[0], t.transform[2], t.transform[5], t.epsg, t.nodata))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [c.split()[0] for c in CATALOG.split(", ")])

    return files.mapInArrow(run, CATALOG)


def banded(tiles: DataFrame) -> DataFrame:
    """(doy, r, c, b1, b2 ...): the bands of each pixel and date beside one another, one partially aggregated pass."""
    return tiles.groupBy("doy", "r", "c").agg(*(F.max(F.when(F.col("band") == b, F.col("value"))).alias(f"b{b}") for b in range(1, 6)))


def channels(tiles: DataFrame) -> DataFrame:
    """(r, c, days, ndvi, lswi, gcvi, cv): index series of each pixel of six-band scenes, dates in order.

    Bands: 1 blue, 2 green, 3 red, 4 near infrared, 5 short-wave infrared; water takes fixed values of the first three. cv is the
    texture of band 4 in the 11 x 11 pixels around, a missing one counted as 0; scenes must have more than five rows and columns.
    """
    from furrow import session
    from furrow.functions import spectral
    from furrow.operators import raster

    bands = session.written(banded(tiles), "bands")
    one = raster.texture(spectral.with_indices(bands), "b4", 11, ["doy"])
    s = F.sort_array(F.collect_list(F.struct("doy", "ndvi", "lswi", "gcvi", F.col("texture").alias("cv"))))
    return one.groupBy("r", "c").agg(s.alias("s")).select("r", "c", F.col("s.doy").alias("days"), "s.ndvi", "s.lswi", "s.gcvi", "s.cv")


def thumbnails(tiles: DataFrame, step: int) -> DataFrame:
    """(doy, r, c, value) at block coordinates: NDVI of block means, its denominator raised by 1e-6, of scenes with four bands or more."""
    small = tiles.groupBy("doy", "band", F.expr(f"CAST(r DIV {step} AS BIGINT)").alias("r"), F.expr(f"CAST(c DIV {step} AS BIGINT)").alias("c")).agg(F.avg("value").alias("value"))
    b = banded(small)
    return b.select("doy", "r", "c", F.when(F.col("b4").isNotNull(), (F.col("b4") - F.col("b3")) / (F.col("b4") + F.col("b3") + 1e-6)).otherwise(F.col("b1")).alias("value"))


def composite(tiles: DataFrame) -> DataFrame:
    """(r, c, red, green, blue) of the last date as 0 to 255: bands 3, 2 and 1 between their 2nd and 98th percentiles."""
    last = banded(tiles.join(F.broadcast(tiles.agg(F.max("doy").alias("doy"))), "doy", "left_semi"))
    names = {"red": "b3", "green": "b2", "blue": "b1"}
    edges = last.agg(*(F.percentile(b, F.lit(p)).alias(f"{n}_{k}") for n, b in names.items() for k, p in (("lo", 0.02), ("hi", 0.98))))
    one = lambda n, b: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(b) - F.col(f"{n}_lo")) / (F.col(f"{n}_hi") - F.col(f"{n}_lo") + 1e-5)))
    return last.crossJoin(F.broadcast(edges)).select("r", "c", *(F.floor(one(n, b) * 255).cast("int").alias(n) for n, b in names.items()))  # one row of edges


def class_tiles(pixels: DataFrame, block_size: int = 1024) -> DataFrame:
    """Class pixels as tiles: (level, tile_r, tile_c, r0, c0, height, width, body) with deflated rows of bytes, 255 where there is
    no pixel; levels 2, 4, 8 and 16 hold every so-many-th pixel. One group a tile; the table is the store of large maps."""
    levels = F.explode(F.array(*(F.lit(k) for k in (1, 2, 4, 8, 16))))
    at = pixels.select("r", "c", "code", levels.alias("level")).where("pmod(r, level) = 0 AND pmod(c, level) = 0").select("level", F.expr("CAST(r DIV level AS BIGINT)").alias("r"), F.expr("CAST(c DIV level AS BIGINT)").alias("c"), "code")
    tiled = at.withColumn("tile_r", F.expr(f"CAST(r DIV {block_size} AS BIGINT)")).withColumn("tile_c", F.expr(f"CAST(c DIV {block_size} AS BIGINT)"))

    def run(t: pa.Table) -> pa.Table:
        r, c, code = (t[x].to_numpy() for x in ("r", "c", "code"))
        a = np.full((r.max() - r.min() + 1, c.max() - c.min() + 1), 255, np.uint8)
        a[r - r.min(), c - c.min()] = code
        one = lambda x, k: pa.array([x], k)
        return pa.table({"level": t["level"].slice(0, 1), "tile_r": t["tile_r"].slice(0, 1), "tile_c": t["tile_c"].slice(0, 1), "r0": one(int(r.min()), pa.int64()), "c0": one(int(c.min()), pa.int64()), "height": one(a.shape[0], pa.int64()), "width": one(a.shape[1], pa.int64()), "body": one(zlib.compress(a.tobytes()), pa.binary())})

    return tiled.groupBy("level", "tile_r", "tile_c").applyInArrow(run, "level int, tile_r long, tile_c long, r0 long, c0 long, height long, width long, body binary")
