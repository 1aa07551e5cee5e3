"""SHA-256 of many messages at once, with states that can be stored and resumed.

The standard library's hash objects can be copied, but not written to a table.
A digest in hexadecimal is exactly one block of 64 bytes, so the state of a
hash over digests is, between two of them, the eight chaining words: 32 bytes
that a table can hold. Arrays of words have one row per message.
"""

from __future__ import annotations

import functools
import math

import numpy as np

#: Messages worked on together, so that the arrays stay in a core's cache.
LANES = 8_192


def _primes(count: int) -> list[int]:
    found: list[int] = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _cube_root(n: int) -> int:
    root = 1 << -(-n.bit_length() // 3)
    while (closer := (2 * root + n // (root * root)) // 3) < root:
        root = closer
    return root


@functools.cache
def constants() -> tuple[np.ndarray, np.ndarray]:
    """The first 32 bits of the fractions of square roots (first state) and cube roots (rounds) of primes."""
    mask = (1 << 32) - 1
    first = [math.isqrt(p << 64) & mask for p in _primes(8)]
    rounds = [_cube_root(p << 96) & mask for p in _primes(64)]
    return np.array(first, np.uint32), np.array(rounds, np.uint32)


@functools.cache
def _hex_of_16_bits() -> np.ndarray:
    """Four hexadecimal characters, as one word, of every 16-bit value."""
    value = np.arange(1 << 16, dtype=np.uint32)
    out = np.zeros(1 << 16, np.uint32)
    for shift in (12, 8, 4, 0):
        nibble = value >> np.uint32(shift) & np.uint32(15)
        out = out << np.uint32(8) | nibble + np.uint32(48) + np.uint32(39) * (nibble > 9)
    return out


def words_of(data: bytes) -> np.ndarray:
    """Rows of eight words from digests or states one after the other."""
    return np.frombuffer(data, ">u4").astype(np.uint32).reshape(-1, 8)


def bytes_of(words: np.ndarray) -> bytes:
    return words.astype(">u4").tobytes()


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """The block of 16 words that each digest makes as hexadecimal text."""
    table = _hex_of_16_bits()
    blocks = np.empty((len(digests), 16), np.uint32)
    blocks[:, 0::2] = table[digests >> np.uint32(16)]
    blocks[:, 1::2] = table[digests & np.uint32(0xFFFF)]
    return blocks


def last_blocks(counts: np.ndarray) -> np.ndarray:
    """The padding that ends a message of so many whole blocks."""
    blocks = np.zeros((len(counts), 16), np.uint32)
    bits = counts.astype(np.uint64) * np.uint64(512)
    blocks[:, 0] = 1 << 31
    blocks[:, 14] = bits >> np.uint64(32)
    blocks[:, 15] = bits & np.uint64(0xFFFFFFFF)
    return blocks


def first_states(count: int) -> np.ndarray:
    return np.tile(constants()[0], (count, 1))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return x >> np.uint32(by) | x << np.uint32(32 - by)


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Each state after one more block."""
    out = np.empty_like(states)
    for at in range(0, len(states), LANES):
        out[at : at + LANES] = _compress(states[at : at + LANES], blocks[at : at + LANES])
    return out


def _compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    rounds = constants()[1]
    w = list(np.ascontiguousarray(blocks.T))
    before = np.ascontiguousarray(states.T)
    a, b, c, d, e, f, g, h = before
    for k in range(64):
        if k >= 16:
            x, y = w[(k - 15) % 16], w[(k - 2) % 16]
            small = _turn(x, 7) ^ _turn(x, 18) ^ x >> np.uint32(3)
            large = _turn(y, 17) ^ _turn(y, 19) ^ y >> np.uint32(10)
            w[k % 16] = w[k % 16] + small + w[(k - 7) % 16] + large
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ e & (f ^ g)) + rounds[k] + w[k % 16]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + (a & b | c & (a | b))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return (before + np.array([a, b, c, d, e, f, g, h])).T
