import hashlib
import struct
import zlib

import numpy as np
import pytest
from tracewright.llm import media

RNG = np.random.default_rng(3)


def bmp(image):
    h, w, _ = image.shape
    stride = (w * 3 + 3) // 4 * 4
    rows = np.zeros((h, stride), np.uint8)
    rows[:, : w * 3] = image[::-1, :, ::-1].reshape(h, -1)
    return b"BM" + struct.pack("<IHHI", 54 + rows.size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, rows.size, 0, 0, 0, 0) + rows.tobytes()


def test_decoders():
    grey = RNG.integers(0, 256, (5, 7, 1), dtype=np.uint8)
    colour = RNG.integers(0, 256, (5, 7, 3), dtype=np.uint8)
    assert (media.decode(media.encode_pgm(grey[:, :, 0])) == grey).all()
    assert (media.decode(b"P2 # grey\n7 5\n255\n" + b" ".join(b"%d" % v for v in grey.ravel())) == grey).all()
    assert (media.decode(b"P6\n#c\n7 5 255\n" + colour.tobytes()) == colour).all()
    assert (media.decode(b"P3\n7 5\n255 " + b" ".join(b"%d" % v for v in colour.ravel())) == colour).all()
    assert (media.decode(bmp(colour)) == colour).all()
    bits = RNG.integers(0, 2, (5, 11), dtype=np.uint8)
    want = ((1 - bits) * 255)[:, :, None]
    assert (media.decode(b"P4\n11 5\n" + np.packbits(bits, axis=1).tobytes()) == want).all()
    assert (media.decode(b"P1\n11 5\n" + b"\n".join(b"".join(b"%d" % b for b in r) for r in bits)) == want).all()
    deep = RNG.integers(0, 65536, (2, 3)).astype(">u2")
    assert (media.decode(b"P5\n3 2\n65535\n" + deep.tobytes())[:, :, 0] == (deep.astype(int) * 255 + 32767) // 65535).all()


@pytest.mark.parametrize("shape", [(8, 9), (16, 18), (5, 7), (100, 24), (1, 1)])
def test_area_resize(shape):
    image = RNG.random(shape)
    h, w = shape
    # By force: repeat each pixel so that every cell covers whole ones.
    fine = np.repeat(np.repeat(image, 8, axis=0), 9, axis=1)
    want = fine.reshape(8, h, 9, w).mean(axis=(1, 3))
    assert np.allclose(media.area_resize(image[None], 8, 9)[0], want)


def test_tiles_round_trip():
    image = RNG.integers(0, 256, (50, 30, 3), dtype=np.uint8)
    tiles = media.read_npy(media.npy_bytes(media.to_tiles(image)))
    assert tiles.shape == (6, 24, 24, 3)
    assert (tiles.reshape(3, 2, 24, 24, 3).swapaxes(1, 2).reshape(72, 48, 3)[:50, :30] == image).all()


def test_columns(spark):
    rows = [(1, bytearray(media.encode_pgm(np.zeros((30, 30), np.uint8)))), (2, None), (3, bytearray(b"")), (4, bytearray(b"P9")), (5, bytearray(b"P5\n9 9\n255\nabc"))]
    got = {r["id"]: r for r in media.media_columns(spark.createDataFrame(rows, "id long, media binary")).collect()}
    assert (got[1]["height"], got[1]["channels"], got[1]["error"]) == (30, 1, None)
    assert media.read_npy(bytes(got[1]["npy"])).shape == (4, 24, 24, 1)
    assert all(got[i]["npy"] is None and got[i]["error"] for i in (2, 3, 4, 5))


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = media.op6_media(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        raw = (docs[r["doc_id"]] or "").encode()
        size = max(576, -(-len(raw) // 576) * 576)
        payload = raw + b"\xff" * (size - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), size, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r["media_bytes"] > size and len(r["media_sha256"]) == 64 and r["feature"]


def test_empty_texts(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6)], "doc_id long, text string, feature int")
    rows = [r for b in media.text_digest(iter(df.select("doc_id", "text").toArrow().to_batches())) for r in b.to_pylist()]
    assert len(rows) == 2 and {r["payload_bytes"] for r in rows} == {576} and len({r["media_sha256"] for r in rows}) == 1
