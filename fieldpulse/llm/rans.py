"""Static range asymmetric numeral coding of token ids, in numpy.

Tokens are cut into blocks of ``BLOCK``. Each block is coded by ``LANES`` interleaved coders
that share one stream of 32-bit words and one frequency table, and starts from states of its
own, so all blocks of a frame run side by side and any of them can be decoded alone. The last
block is filled up with the most frequent token, which costs next to nothing and is dropped by the
reader, so that all blocks have the same number of steps.

A frame is: magic, crc32 of the frequency table, number of tokens, number of blocks; then a
checkpoint for each block (tokens before it, words before it, its words, crc32 of its words and
states); then the states, then the words. All numbers are little-endian.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096
LANES = 16
STEPS = BLOCK // LANES
SCALE = 20
LOW = np.uint64(1 << 31)
MAGIC = 0x31414652
HEAD = np.dtype([("magic", "<u4"), ("table", "<u4"), ("tokens", "<u8"), ("blocks", "<u4")])
CHECKPOINT = np.dtype([("token", "<u8"), ("word", "<u8"), ("words", "<u4"), ("crc", "<u4")])


class Damaged(ValueError):
    """Stored bytes do not fit their checksum."""


class Frequencies:
    """Counts scaled to a power of two; each counted id keeps at least one slot."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.float64)
        used = np.flatnonzero(counts)
        total = 1 << SCALE
        if len(used) > total:
            raise ValueError(f"more than {total} distinct ids")
        slots = np.zeros(len(counts), np.int64)
        if len(used):
            share = counts[used] / counts.sum() * (total - len(used))
            slots[used] = 1 + np.floor(share).astype(np.int64)
            rest = total - int(slots.sum())
            first = np.argsort(-(share - np.floor(share)), kind="stable")[:rest]
            slots[used[first]] += 1
        self.slots = slots.astype(np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(slots)[:-1])).astype(np.uint64)
        self.owner = np.repeat(np.arange(len(counts), dtype=np.uint32), slots)
        self.crc = zlib.crc32(slots.astype("<u4").tobytes())


def encode(tokens: np.ndarray, table: Frequencies) -> bytes:
    """One frame of any number of tokens, all of which the table must know."""
    n = len(tokens)
    blocks = -(-n // BLOCK)
    head = np.array([(MAGIC, table.crc, n, blocks)], HEAD)
    if not n:
        return head.tobytes()
    padded = np.full(blocks * BLOCK, int(table.slots.argmax()), np.int64)
    padded[:n] = tokens
    # Step by step, and in each step all lanes of all blocks side by side.
    grid = np.ascontiguousarray(padded.reshape(blocks, STEPS, LANES).transpose(1, 0, 2)).reshape(STEPS, -1)
    slots, starts = table.slots[grid], table.starts[grid]
    if not slots.all():
        raise ValueError("an id that the frequency table does not know")
    state = np.full(blocks * LANES, LOW, np.uint64)
    sent = np.zeros(grid.shape, bool)
    words = np.zeros(grid.shape, np.uint32)
    limits = slots << np.uint64(63 - SCALE)
    for step in range(STEPS - 1, -1, -1):
        f, full = slots[step], sent[step]
        np.greater_equal(state, limits[step], out=full)
        words[step] = state  # its low half
        state = np.where(full, state >> np.uint64(32), state)
        high = state // f
        state += starts[step] + high * ((1 << SCALE) - f)
    sent, words = (x.reshape(STEPS, blocks, LANES).transpose(1, 0, 2) for x in (sent, words))
    state = state.reshape(blocks, LANES)
    sizes = sent.reshape(blocks, -1).sum(axis=1)
    stream = words[sent].astype("<u4")
    points = np.zeros(blocks, CHECKPOINT)
    points["token"] = np.arange(blocks) * BLOCK
    points["words"] = sizes
    points["word"] = np.cumsum(sizes) - sizes
    states = state.astype("<u8")
    for i, p in enumerate(points):
        own = stream[int(p["word"]) : int(p["word"]) + int(p["words"])]
        p["crc"] = zlib.crc32(own.tobytes(), zlib.crc32(states[i].tobytes()))
    return head.tobytes() + points.tobytes() + states.tobytes() + stream.tobytes()


def decode(frame: bytes, table: Frequencies, first: int = 0, last: int | None = None) -> np.ndarray:
    """The tokens of blocks ``first`` to ``last`` (not included; all by default)."""
    if len(frame) < HEAD.itemsize:
        raise Damaged("frame is too short")
    head = np.frombuffer(frame, HEAD, 1)[0]
    if head["magic"] != MAGIC or head["table"] != table.crc:
        raise Damaged("not a frame of this frequency table")
    n, blocks = int(head["tokens"]), int(head["blocks"])
    at = HEAD.itemsize
    if len(frame) < at + blocks * (CHECKPOINT.itemsize + 8 * LANES):
        raise Damaged("frame is too short")
    points = np.frombuffer(frame, CHECKPOINT, blocks, at)
    at += points.nbytes
    states = np.frombuffer(frame, "<u8", blocks * LANES, at).reshape(blocks, LANES)
    at += states.nbytes
    last = blocks if last is None else last
    points, states = points[first:last], states[first:last]
    if not len(points):
        return np.empty(0, np.uint32)
    stream = np.frombuffer(frame, "<u4", -1, at)
    for p, s in zip(points, states, strict=True):
        own = stream[int(p["word"]) : int(p["word"]) + int(p["words"])]
        if zlib.crc32(own.tobytes(), zlib.crc32(s.tobytes())) != p["crc"]:
            raise Damaged(f"block at token {p['token']}")
    stream = stream.astype(np.uint64)
    state = states.astype(np.uint64)
    place = points["word"].astype(np.int64)
    out = np.zeros((STEPS, len(points), LANES), np.uint32)
    mask = np.uint64((1 << SCALE) - 1)
    for step in range(STEPS):
        slot = state & mask
        token = out[step] = table.owner[slot]
        state = table.slots[token] * (state >> np.uint64(SCALE)) + slot - table.starts[token]
        low = state < LOW
        taken = np.cumsum(low, axis=1)
        word = stream[(place[:, None] + taken)[low] - 1]
        state[low] = (state[low] << np.uint64(32)) | word
        place = place + taken[:, -1]
    flat = out.transpose(1, 0, 2).reshape(-1)
    return flat[: n - first * BLOCK]
