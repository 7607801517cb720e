"""SetSketch registers in numpy.

Every element of a set gives each of the ``M`` registers an exponential arrival time; a register
keeps the earliest one over the set, truncated to a whole power of ``BASE``. Registers of a
union are the register-wise maximum, so sketches merge. Two sets agree in a register more often
the more they share, by a known law, which gives a joint likelihood for their similarity.

The times of one element come in ascending order, each in a register of its own (a permutation
drawn from the element), so an element stops as soon as it is later than all its set has.
"""

from __future__ import annotations

import numpy as np

from fieldpulse.llm.shingles import mixed

M = 256
RATE = 20.0
BASE = 1.2
_TOP = 255


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``M`` uint8 registers for each set; an empty set has zeros."""
    sizes = np.array([len(s) for s in sets], np.int64)
    earliest = np.full((len(sets), M), np.inf)
    if sizes.sum():
        numbers = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        flat = earliest.reshape(-1)
        time = np.zeros(len(numbers))
        seen, check = 0, 1
        while len(numbers):
            draw = mixed(numbers + np.uint64((0x9E3779B97F4A7C15 * (seen + 1)) % (1 << 64)))
            unit = ((draw >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52
            time = time - np.log(unit) / (RATE * (M - seen))
            step = (numbers >> np.uint64(8)) | np.uint64(1)
            place = (numbers + step * np.uint64(seen)) & np.uint64(M - 1)
            np.minimum.at(flat, owner * M + place.astype(np.int64), time)
            seen += 1
            if seen == M:
                break
            if seen >= check:
                check = seen + max(1, seen // 4)
                live = time < earliest.max(axis=1)[owner]
                numbers, owner, time = numbers[live], owner[live], time[live]
    with np.errstate(divide="ignore"):
        level = np.floor(1.0 - np.log(earliest) / np.log(BASE))
    return np.clip(level, 0, _TOP).astype(np.uint8)


def _apart(x: np.ndarray) -> np.ndarray:
    """Chance that one set's register is the larger, by the share only that set has."""
    return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1) / BASE) / np.log(BASE)


def similarity_bounds(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, drop: float = 25.0, steps: int = 96
) -> tuple[np.ndarray, np.ndarray]:
    """(most likely, largest plausible) Jaccard similarity of pairs of register rows.

    ``n_a`` and ``n_b`` are the sets' known sizes. Plausible: the log-likelihood is at most
    ``drop`` below its maximum; 25 leaves out the truth less than once in 10^11 pairs.
    """
    larger = (a > b).sum(axis=1)[:, None]
    smaller = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - larger - smaller
    u = (n_a / (n_a + n_b))[:, None]
    v = 1.0 - u
    top = np.minimum(u, v) / np.maximum(u, v)
    j = top * np.linspace(0.0, 1.0, steps)[None, :]
    more, less = _apart(u - v * j), _apart(v - u * j)
    tiny = 1e-12
    log_l = (
        larger * np.log(more + tiny)
        + smaller * np.log(less + tiny)
        + equal * np.log(np.maximum(1.0 - more - less, tiny))
    )
    best = log_l.argmax(axis=1)
    rows = np.arange(len(best))
    plausible = log_l >= log_l[rows, best][:, None] - drop
    high = steps - 1 - plausible[:, ::-1].argmax(axis=1)
    high = np.minimum(high + 1, steps - 1)  # up to the next point of the grid
    return j[rows, best], j[rows, high]
