import os
import struct
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    from tessera_spark.session import ship_package

    ship_package(session)
    yield session
    session.stop()


def png(pixels: np.ndarray) -> bytes:
    """PNG bytes of a gray, RGB or RGBA array."""
    h, w = pixels.shape[:2]
    channels = 1 if pixels.ndim == 2 else pixels.shape[2]
    kind = {1: 0, 3: 2, 4: 6}[channels]
    rows = pixels.reshape(h, -1).astype(np.uint8)
    raw = b"".join(b"\x00" + r.tobytes() for r in rows)

    def chunk(tag, body):
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    head = struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture
def write_tree(tmp_path):
    def write(files: dict[str, bytes]) -> str:
        for name, body in files.items():
            target = tmp_path / "raw" / name
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(body)
        (tmp_path / "raw").mkdir(exist_ok=True)
        return str(tmp_path / "raw")

    return write
