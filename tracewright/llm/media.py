"""Media columns: Netpbm and BMP bytes to numpy arrays, NPY tiles and difference hashes.

An image is decoded to an array (height, width, channels) of 8-bit samples, cut into square
tiles (edges padded with 255) that are kept as one NPY array, and hashed: the image, and
each tile, is reduced to 9 by 8 grey cells by area averages, read off an integral image,
and each cell is compared with its right neighbour.

A null, empty or unreadable image gives nulls and its reason in ``error``. Equal bytes give
equal values. Each row is worked on alone, whatever its length. Extra columns are kept.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.llm._shared import by_value, table

TILE = 24
PAD = 255
#: Cells of a difference hash: rows, and columns with the one on the right edge.
ROWS, COLUMNS = 8, 9


def netpbm_header(data: bytes, fields: int) -> tuple[list[int], int]:
    """The numbers after the magic number, comments skipped, and where the samples begin."""
    out, at = [], 2
    while len(out) < fields:
        while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
            at = data.index(b"\n", at) + 1 if data[at : at + 1] == b"#" else at + 1
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        if end == at:
            raise ValueError("a number is missing in the header")
        out.append(int(data[at:end]))
        at = end
    return out, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6. Samples of another maximum than 255 are scaled to it; bits are 0 for black, as 255 is white."""
    kind = data[1] - ord("0")
    channels = 3 if kind in (3, 6) else 1
    numbers, at = netpbm_header(data, 2 if kind in (1, 4) else 3)
    width, height = numbers[:2]
    most = 1 if kind in (1, 4) else numbers[2]
    n = width * height * channels
    if not 0 < most < 65536 or n == 0:
        raise ValueError("an image without samples")
    if kind == 1:
        values = np.array([c - 48 for c in data[at - 1 :] if c in b"01"][:n])
    elif kind in (2, 3):
        values = np.array(data[at - 1 :].split()[:n], dtype=np.int64)
    elif kind == 4:
        packed = np.frombuffer(data, np.uint8, height * (-(-width // 8)), at).reshape(height, -1)
        values = np.unpackbits(packed, axis=1)[:, :width].ravel()
    else:
        values = np.frombuffer(data, np.uint8 if most < 256 else ">u2", n, at)
    if len(values) < n:
        raise ValueError("samples are missing")
    if most == 1 and kind in (1, 4):
        values = 1 - values
    if most != 255:
        values = (values.astype(np.int64) * 255 + most // 2) // most
    return values.astype(np.uint8).reshape(height, width, channels)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed, of 8 (with palette), 24 or 32 bits a pixel."""
    offset, header, width, height, _, bits, packing = struct.unpack_from("<IIiiHHI", data, 10)
    if bits not in (8, 24, 32) or packing not in (0, 3) or width <= 0 or height == 0:
        raise ValueError(f"a BMP of {bits} bits and compression {packing}")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), offset).reshape(abs(height), stride)
    pixels = rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)
    pixels = pixels[::-1] if height > 0 else pixels
    if bits == 8:
        colours = struct.unpack_from("<I", data, 46)[0] or 256
        palette = np.frombuffer(data, np.uint8, 4 * colours, 14 + header).reshape(-1, 4)[:, 2::-1]
        pixels = palette[pixels[:, :, 0]]
        return pixels[:, :, :1] if (palette == palette[:, :1]).all() else pixels
    return pixels[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray:
    if data[:1] == b"P" and data[1:2] in (b"1", b"2", b"3", b"4", b"5", b"6"):
        return decode_netpbm(data)
    if data[:2] == b"BM":
        return decode_bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def encode_pgm(samples: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (samples.shape[1], samples.shape[0]) + samples.tobytes()


def area_resize(images: np.ndarray, height: int, width: int) -> np.ndarray:
    """images (n, h, w) to (n, height, width): each cell is the exact mean of the area it covers.

    The integral image, linear between whole pixels, gives the sum over any rectangle.
    """
    n, h, w = images.shape
    integral = np.zeros((n, h + 1, w + 1))
    np.cumsum(np.cumsum(images, axis=1, dtype=np.float64), axis=2, out=integral[:, 1:, 1:])

    def between(a: np.ndarray, size: int, cells: int, axis: int) -> np.ndarray:
        at = np.arange(cells + 1) * (size / cells)
        low = np.minimum(at.astype(np.int64), size - 1)
        part = (at - low).reshape((-1, 1) if axis == 1 else (-1,))
        below = np.take(a, low, axis=axis)
        return np.diff(below + (np.take(a, low + 1, axis=axis) - below) * part, axis=axis)

    return between(between(integral, h, height, 1), w, width, 2) * (height * width / (h * w))


def difference_hashes(images: np.ndarray) -> np.ndarray:
    cells = np.round(area_resize(images, ROWS, COLUMNS), 6)
    bits = (cells[:, :, :-1] > cells[:, :, 1:]).reshape(len(images), -1)
    return np.packbits(bits, axis=1).view(">u8")[:, 0]


def to_tiles(image: np.ndarray, tile: int = TILE) -> np.ndarray:
    """(tiles, tile, tile, channels) in reading order; what the edge tiles lack is PAD."""
    h, w, c = image.shape
    rows, columns = -(-h // tile), -(-w // tile)
    if (h, w) != (rows * tile, columns * tile):
        whole = np.full((rows * tile, columns * tile, c), PAD, dtype=np.uint8)
        whole[:h, :w] = image
        image = whole
    return image.reshape(rows, tile, columns, tile, c).swapaxes(1, 2).reshape(-1, tile, tile, c)


def npy_bytes(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(array), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def read_npy(data: bytes) -> np.ndarray:
    return np.lib.format.read_array(io.BytesIO(data), allow_pickle=False)


def feature(image: np.ndarray, tiles: np.ndarray) -> str:
    """The image's difference hash, the tiles' hashes in one CRC, and the mean sample."""
    whole = difference_hashes(image.mean(axis=2, dtype=np.float64)[None] if image.shape[2] > 1 else image[None, :, :, 0])[0]
    each = difference_hashes(tiles.mean(axis=3, dtype=np.float64) if tiles.shape[3] > 1 else tiles[:, :, :, 0])
    return f"{int(whole):016x}-{zlib.crc32(each.astype('>u8').tobytes()):08x}-{image.mean():.3f}"


MEDIA = "height int, width int, channels int, npy binary, feature string, error string"


def media_columns(rows: DataFrame, column: str = "media", tile: int = TILE) -> DataFrame:
    """``rows`` with height, width, channels, npy (the tiles), feature and error of the images in a binary column."""
    clash = {f.name for f in T._parse_datatype_string(MEDIA).fields} & set(rows.columns)
    if clash:
        raise ValueError(f"rows have columns {sorted(clash)} already")
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string(MEDIA).fields])
    at = rows.columns.index(column)

    def one(data: bytes | None) -> tuple:
        try:
            if not data:
                raise ValueError("no image")
            image = decode(data)
            tiles = to_tiles(image, tile)
            return *image.shape, npy_bytes(tiles), feature(image, tiles), None
        except (ValueError, IndexError, struct.error) as e:
            return None, None, None, None, None, str(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string())
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made = [one(x) for x in part.column(at).to_pylist()]
                new = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return rows.mapInArrow(run, schema)


def write_media(rows: DataFrame, path: str) -> None:
    """The columns of ``media_columns`` as a Parquet table at ``path``, tiles in its npy column."""
    rows.write.mode("overwrite").parquet(path)


def text_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as grey images of TILE columns: encoded as PGM, decoded, kept as NPY tiles, read back."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
    unit = TILE * TILE
    for batch in batches:
        out: list[list] = [[] for _ in schema]
        for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
            raw = raw or b""
            padded = raw + bytes([PAD]) * (-len(raw) % unit or (unit if not raw else 0))
            image = decode(encode_pgm(np.frombuffer(padded, np.uint8).reshape(-1, TILE)))
            media = npy_bytes(to_tiles(image))
            tiles = read_npy(media)
            payload = tiles.tobytes()
            row = (doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(tiles.reshape(-1, TILE, 1), tiles))
            for values, x in zip(out, row, strict=True):
                values.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(text_digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


by_value(__name__)
