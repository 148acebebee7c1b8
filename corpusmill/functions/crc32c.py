"""CRC-32C of many byte strings at once, as record files need it: numpy over whole batches."""

from __future__ import annotations

import numpy as np

# The reflected Castagnoli polynomial, and the constants of the masked checksum.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
_ALL_ONES = np.uint32(0xFFFFFFFF)
_MOST_MATRIX_BYTES = 1 << 24


def _byte_tables() -> list[np.ndarray]:
    """Checksum of each byte value followed by 0 to 7 zero bytes."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(POLYNOMIAL), crc >> 1).astype(np.uint32)
    tables = [crc]
    for _ in range(7):
        last = tables[-1]
        tables.append((last >> 8) ^ tables[0][last & 0xFF])
    return tables


_TABLES = _byte_tables()


def _append_zeros(crc: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Checksums as they are after more zero bytes; ``tables`` has one row per byte of the checksum."""
    out = tables[0][crc & 0xFF]
    for k in range(1, 4):
        out = out ^ tables[k][(crc >> np.uint32(8 * k)) & 0xFF]
    return out


def _zero_tables() -> list[np.ndarray]:
    """For 8, 16, 32, ... zero bytes: the effect on each byte of a checksum."""
    each = np.arange(256, dtype=np.uint32)
    step = np.stack([each << np.uint32(8 * k) for k in range(4)])
    for _ in range(8):
        step = (step >> 8) ^ _TABLES[0][step & 0xFF]
    out = [step]
    for _ in range(40):
        out.append(_append_zeros(out[-1], out[-1]))
    return out


_ZEROS = _zero_tables()


def crc32c(messages: list[bytes]) -> np.ndarray:
    """Checksums (uint32) of the messages."""
    sizes = np.array([len(m) for m in messages], np.int64)
    out = np.zeros(len(messages), np.uint32)
    for i in np.flatnonzero(sizes < 4):
        crc = 0xFFFFFFFF
        for byte in messages[i]:
            crc = (crc >> 8) ^ int(_TABLES[0][(crc ^ byte) & 0xFF])
        out[i] = crc ^ 0xFFFFFFFF
    widths = np.ones(len(messages), np.int64) * 8
    while (short := widths < sizes).any():
        widths[short] *= 2
    for width in np.unique(widths[sizes >= 4]):
        rows = np.flatnonzero((widths == width) & (sizes >= 4))
        for part in np.array_split(rows, -(-len(rows) * int(width) // _MOST_MATRIX_BYTES)):
            out[part] = _equal_width([messages[i] for i in part], int(width))
    return out


def _equal_width(messages: list[bytes], width: int) -> np.ndarray:
    """Zero bytes in front do not change a checksum that starts from 0, so the messages are right-aligned
    in a matrix; starting from all ones means inverting the first four bytes."""
    padded = b"".join([m.rjust(width, b"\0") for m in messages])
    matrix = np.frombuffer(padded, np.uint8).reshape(len(messages), width).copy()
    first = width - np.fromiter(map(len, messages), np.int64, len(messages))
    for k in range(4):
        matrix[np.arange(len(messages)), first + k] ^= 0xFF
    words = matrix.reshape(len(messages), -1, 8)
    crc = _TABLES[7][words[:, :, 0]]
    for k in range(1, 8):
        crc = crc ^ _TABLES[7 - k][words[:, :, k]]
    for zeros in _ZEROS:
        if crc.shape[1] == 1:
            break
        crc = _append_zeros(crc[:, 0::2], zeros) ^ crc[:, 1::2]
    return crc[:, 0] ^ _ALL_ONES


def masked_crc32c(messages: list[bytes]) -> np.ndarray:
    """The checksums in the masked form that record files store."""
    crc = crc32c(messages)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)
