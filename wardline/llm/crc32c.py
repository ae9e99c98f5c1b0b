"""CRC-32C (Castagnoli) of many byte strings at once, and its masked form.

The strings are cut into blocks that advance side by side, two bytes at a step; the blocks of
a string are then chained by the linear operator "append n zero bytes".
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Fixed values of the checksum and of its masking.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

BLOCK = 256
ONES = np.uint32(0xFFFFFFFF)


@lru_cache
def _by_byte() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


@lru_cache
def _by_pair() -> np.ndarray:
    pairs = np.arange(65536, dtype=np.uint32)
    first = _by_byte()[pairs & 0xFF] ^ (pairs >> 8)
    return _by_byte()[first & 0xFF] ^ (first >> 8)


@lru_cache
def _zeros(power: int) -> np.ndarray:
    """Tables (one per byte of the register) that append 2 ** power zero bytes."""
    values = np.arange(256, dtype=np.uint32)
    tables = np.stack([values << np.uint32(8 * i) for i in range(4)])
    if power == 0:
        return _by_byte()[tables & 0xFF] ^ (tables >> 8)
    return _append(_append(tables, power - 1), power - 1)


def _append(register: np.ndarray, power: int) -> np.ndarray:
    t = _zeros(power)
    return t[0][register & 0xFF] ^ t[1][(register >> 8) & 0xFF] ^ t[2][(register >> 16) & 0xFF] ^ t[3][register >> 24]


def _append_lengths(register: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    power = 0
    while np.any(lengths >> power):
        register = np.where((lengths >> power) & 1, _append(register, power), register)
        power += 1
    return register


def crc32c(strings: list[bytes]) -> np.ndarray:
    """CRC-32C of each string, as unsigned 32-bit integers."""
    if not strings:
        return np.zeros(0, np.uint32)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    blocks = -(-lengths // BLOCK)
    # Zero bytes ahead of a string leave an empty register empty.
    padded = b"".join([s.rjust(b * BLOCK, b"\0") for s, b in zip(strings, blocks.tolist())])
    words = np.frombuffer(padded, "<u2").reshape(-1, BLOCK // 2).T.astype(np.uint32, order="C")
    pair, register = _by_pair(), np.zeros(words.shape[1], np.uint32)
    for word in words:
        register ^= word
        register = pair[register & 0xFFFF] ^ (register >> 16)
    first = np.cumsum(blocks) - blocks
    whole, power = np.zeros(len(strings), np.uint32), BLOCK.bit_length() - 1
    alive = np.arange(len(strings))
    for step in range(int(blocks.max(initial=0))):
        alive = alive[blocks[alive] > step]
        whole[alive] = _append(whole[alive], power) ^ register[first[alive] + step]
    return whole ^ _append_lengths(np.full(len(strings), ONES), lengths) ^ ONES


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that a checksum of data that holds checksums stays sound."""
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK_DELTA)
