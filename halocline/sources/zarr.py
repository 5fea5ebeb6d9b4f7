"""Zarr (version 2) arrays as metadata and chunks of bytes: a chunk is written and read by one task.

Chunks are compressed with zstd or zlib, after an optional byte shuffle; the names of the settings' other codecs, which live in a
container format of a library, fall back to zstd with a warning. A missing chunk is all missing values.
"""

from __future__ import annotations

import logging
import zlib
from typing import Any

import numpy as np
import pyarrow as pa

log = logging.getLogger("halocline")


def layout(shape: tuple[int, ...], chunks: tuple[int, ...], kind: str, codec: str | None = "zstd", level: int = 5, shuffle: bool = False) -> dict[str, Any]:
    """The .zarray of an array; codec None: not compressed."""
    dtype = np.dtype(kind)
    if codec not in (None, "zstd", "zlib"):
        log.warning("codec %s is not available; chunks are compressed with zstd.", codec)
    compressor = None if codec is None else {"id": "zlib" if codec == "zlib" else "zstd", "level": level}
    fill = "NaN" if dtype.kind == "f" else "" if dtype.kind in "SU" else 0
    return {
        "zarr_format": 2, "shape": list(shape), "chunks": [max(1, c) for c in chunks], "dtype": dtype.str, "order": "C", "fill_value": fill, "dimension_separator": ".",
        "filters": [{"id": "shuffle", "elementsize": dtype.itemsize}] if shuffle and compressor else None, "compressor": compressor,
    }


def encode(x: np.ndarray, of: dict[str, Any]) -> bytes:
    """A chunk, filled up to its whole size."""
    full = np.full(of["chunks"], np.nan if of["fill_value"] == "NaN" else of["fill_value"], of["dtype"])
    full[tuple(slice(0, n) for n in x.shape)] = x
    raw = full.tobytes()
    for f in of["filters"] or []:
        raw = np.frombuffer(raw, np.uint8).reshape(-1, f["elementsize"]).T.tobytes()
    how = of["compressor"]
    if how is None:
        return raw
    return zlib.compress(raw, how["level"]) if how["id"] == "zlib" else pa.Codec("zstd", compression_level=max(1, how["level"])).compress(raw).to_pybytes()


def decode(data: bytes, of: dict[str, Any]) -> np.ndarray:
    how, size = of["compressor"], int(np.prod(of["chunks"], dtype=np.int64)) * np.dtype(of["dtype"]).itemsize
    if how is not None:
        if how["id"] not in ("zlib", "zstd"):
            raise ValueError(f"cannot read chunks of codec {how['id']!r}.")
        data = zlib.decompress(data) if how["id"] == "zlib" else pa.decompress(data, size, "zstd").to_pybytes()
    for f in reversed(of["filters"] or []):
        data = np.frombuffer(data, np.uint8).reshape(f["elementsize"], -1).T.tobytes()
    return np.frombuffer(data, of["dtype"]).reshape(of["chunks"])


def chunk_name(*place: int) -> str:
    return ".".join(map(str, place))
