"""Zero-phase recursive filters over runs of samples that may be cut into any number of chunks.

A Butterworth band-pass is a cascade of second-order sections, a linear system with a state s of two numbers a section:
s' = A s + B x, y = C s + D x. A run is a stretch of samples of one rate without a gap. It is filtered forward and then
backward, from rest at both ends.

A run may span many chunks. Over n samples the state goes to A^n s + b, where b is what the chunk's samples leave
behind from rest; the backward pass, whose input is the forward output, goes to A^n r + b' + M s, with M depending on n
alone. So a chunk is summed up by its length and b, b' of each band (``Piece``), neighbours are joined by composing these maps
(``fold``), and a composed stretch is described by the same few numbers: that makes an exact parallel prefix, with no
padding and no guess of how long the filter rings.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BLOCK = 512


def butterworth_sections(low_hz: float, high_hz: float, rate: float, order: int) -> np.ndarray:
    """Second-order sections ``(b0, b1, b2, a1, a2)`` of a digital band-pass, by the bilinear transform.

    Each of the ``order`` sections has zeros at frequency zero and at the Nyquist frequency, that is b = (g, 0, -g);
    its gain is 1 at the centre of the band.
    """
    low, high = 2 * np.tan(np.pi * np.array([low_hz, high_hz]) / rate)
    k = np.arange(order)
    prototype = np.exp(1j * np.pi * (2 * k + order + 1) / (2 * order)) * (high - low) / 2
    root = np.sqrt(prototype**2 - low * high)
    poles = np.concatenate([prototype + root, prototype - root])
    poles = (2 + poles) / (2 - poles)
    real = np.sort(poles[np.abs(poles.imag) < 1e-12].real)
    upper = poles[poles.imag >= 1e-12]
    pairs = [(-2 * p.real, abs(p) ** 2) for p in sorted(upper, key=abs)]
    pairs += [(-(p + q), p * q) for p, q in zip(real[::2], real[1::2])]
    at = np.exp(2j * np.arctan(np.sqrt(low * high) / 2))  # the centre on the unit circle
    return np.array([[g, 0.0, -g, a1, a2] for a1, a2 in pairs for g in [abs((at**2 + a1 * at + a2) / (at**2 - 1))]])


class System:
    """The cascade as one linear system, with the matrices that filter a block of ``BLOCK`` samples at once."""

    def __init__(self, low_hz: float, high_hz: float, rate: float, order: int):
        sections = butterworth_sections(low_hz, high_hz, rate, order)
        size = 2 * len(sections)
        a, b = np.zeros((size, size)), np.zeros(size)
        through, gain = np.zeros(size), 1.0  # of the signal that reaches the section: by state, by input
        for i, (b0, b1, b2, a1, a2) in enumerate(sections):
            first, second = 2 * i, 2 * i + 1
            out, direct = b0 * through, b0 * gain
            out[first] += 1.0
            a[first] = b1 * through - a1 * out
            a[first, second] += 1.0
            a[second] = b2 * through - a2 * out
            b[first], b[second] = b1 * gain - a1 * direct, b2 * gain - a2 * direct
            through, gain = out, direct
        self.a, self.b, self.c, self.d, self.size = a, b, through, gain, size
        seen, left = np.empty((BLOCK, size)), np.empty((BLOCK, size))
        row, column = through.copy(), b.copy()
        for n in range(BLOCK):  # seen[n] = C A^n, left[n] = A^n B
            seen[n], left[n] = row, column
            row, column = row @ a, a @ column
        response = np.concatenate([[gain], left[:-1] @ through])
        lag = np.arange(BLOCK)[:, None] - np.arange(BLOCK)
        self.seen, self.left = seen, left[::-1]
        self.response = np.where(lag >= 0, response[np.abs(lag)], 0.0)
        self._powers: dict[int, np.ndarray] = {}
        self._echoes: dict[int, np.ndarray] = {}

    def power(self, n: int) -> np.ndarray:
        """A^n."""
        if n not in self._powers:
            if len(self._powers) > 4096:
                self._powers.clear()
            self._powers[n] = np.linalg.matrix_power(self.a, n)
        return self._powers[n]

    def echo(self, n: int) -> np.ndarray:
        """M = sum of A^k B C A^k over k < n: what a forward state s at the start adds to the backward state there is M s."""
        if n not in self._echoes:
            if len(self._echoes) > 4096:
                self._echoes.clear()
            total, k = np.zeros_like(self.a), 0
            for bit in bin(n)[2:]:  # M(2k) = M(k) + A^k M(k) A^k, M(k + 1) = B C + A M(k) A
                total, k = total + self.power(k) @ total @ self.power(k), 2 * k
                if bit == "1":
                    total, k = np.outer(self.b, self.c) + self.a @ total @ self.a, k + 1
            self._echoes[n] = total
        return self._echoes[n]

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Output and end state for input ``x`` from ``state``, a block at a time by matrix products."""
        n = len(x)
        if not n:
            return x, state
        blocks = -(-n // BLOCK)
        padded = np.zeros(blocks * BLOCK)
        padded[:n] = x
        cut = padded.reshape(blocks, BLOCK)
        ends = cut @ self.left
        states = np.empty((blocks, self.size))
        whole = self.power(BLOCK)
        for i in range(blocks):
            states[i] = state
            state = whole @ state + ends[i]
        last = n - (blocks - 1) * BLOCK
        state = self.power(last) @ states[-1] + x[n - last :] @ self.left[BLOCK - last :]
        return (cut @ self.response.T + states @ self.seen.T).reshape(-1)[:n], state


@lru_cache(maxsize=256)
def system(low_hz: float, high_hz: float, rate: float, order: int) -> System:
    """The system of a band at a rate, once per worker."""
    return System(low_hz, high_hz, rate, order)


def runs(us: np.ndarray, good: np.ndarray, rate: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs in sorted samples: usable values, one rate, one sampling interval apart."""
    if not len(us):
        return []
    joined = good[1:] & good[:-1] & (rate[1:] == rate[:-1])
    interval = np.diff(us) * rate[1:] / 1e6
    joined &= (interval > 0.5) & (interval < 1.5)
    starts = np.flatnonzero(np.append(True, ~joined))
    ends = np.append(starts[1:], len(us))
    return [(int(a), int(b)) for a, b in zip(starts, ends) if good[a]]


@dataclass
class Piece:
    """A stretch of a trace as its neighbours see it.

    ``n``: samples of the run that begins at its first sample (0: that one is unusable); ``whole``: this run reaches the
    end; ``forward``: states that the last run leaves at the end, ``backward``: states that the first run leaves at the
    start, going backward; both from rest, one row a band. ``first`` and ``last``: time, rate, and whether the sample is usable.
    """

    n: int
    whole: bool
    forward: np.ndarray
    backward: np.ndarray
    first: tuple[int, float, bool]
    last: tuple[int, float, bool]


def goes_on(left: Piece, right: Piece) -> bool:
    """A run crosses the border between two pieces."""
    (a, rate, good), (b, other, fine) = left.last, right.first
    return bool(good and fine and rate == other and 0.5 < (b - a) * rate / 1e6 < 1.5)


def summed_up(us: np.ndarray, x: np.ndarray, good: np.ndarray, rate: np.ndarray, bands: Sequence[tuple[float, float]], order: int) -> Piece:
    """A chunk of sorted samples as a piece."""
    found, size = runs(us, good, rate), 2 * order
    forward, backward = np.zeros((len(bands), size)), np.zeros((len(bands), size))
    rest = np.zeros(size)
    ends = lambda i: (int(us[i]), float(rate[i]), bool(good[i]))
    for i, band in enumerate(bands):
        if found and found[-1][1] == len(us):
            a, b = found[-1]
            y, forward[i] = system(*band, float(rate[a]), order).run(x[a:b], rest)
        if found and found[0][0] == 0:
            a, b = found[0]
            own = system(*band, float(rate[a]), order)
            if len(found) > 1 or b < len(us):
                y, _ = own.run(x[a:b], rest)
            _, backward[i] = own.run(y[::-1], rest)
    n = found[0][1] if found and found[0][0] == 0 else 0
    return Piece(n, n == len(us), forward, backward, ends(0), ends(-1))


def resolve(
    pieces: Sequence[Piece], inflow: np.ndarray, outflow: np.ndarray, bands: Sequence[tuple[float, float]], order: int
) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """States that enter each piece at its start (forward) and at its end (backward), and the backward state at the start.

    ``inflow`` and ``outflow`` enter the first piece at its start and the last one at its end.
    """
    size, joined = 2 * order, [goes_on(a, b) for a, b in zip(pieces, pieces[1:])]
    entering, leaving = [], [None] * len(pieces)
    state = inflow
    for i, piece in enumerate(pieces):
        if i and not joined[i - 1]:
            state = np.zeros((len(bands), size))
        entering.append(state)
        state = piece.forward + _carried(piece, state, bands, order, "power") if piece.whole else piece.forward
    state = outflow
    for i in range(len(pieces) - 1, -1, -1):
        if i < len(joined) and not joined[i]:
            state = np.zeros((len(bands), size))
        leaving[i] = state
        piece = pieces[i]
        own = piece.backward + _carried(piece, entering[i], bands, order, "echo")
        state = own + _carried(piece, state, bands, order, "power") if piece.whole else own
    return entering, leaving, state


def _carried(piece: Piece, state: np.ndarray, bands: Sequence[tuple[float, float]], order: int, by: str) -> np.ndarray:
    if not piece.n or not state.any():
        return np.zeros_like(state)
    return np.stack([getattr(system(*band, piece.first[1], order), by)(piece.n) @ s for band, s in zip(bands, state)])


def fold(pieces: Sequence[Piece], bands: Sequence[tuple[float, float]], order: int) -> Piece:
    """Neighbouring pieces as one."""
    rest = np.zeros((len(bands), 2 * order))
    entering, _, backward = resolve(pieces, rest, rest, bands, order)
    last = pieces[-1]
    forward = last.forward + _carried(last, entering[-1], bands, order, "power") if last.whole else last.forward
    n, whole = pieces[0].n, pieces[0].whole
    for before, piece in zip(pieces, pieces[1:]):
        if not whole:
            break
        if not goes_on(before, piece):
            whole = False
            break
        n, whole = n + piece.n, piece.whole
    return Piece(n, whole, forward, backward, pieces[0].first, last.last)


def filtered(
    us: np.ndarray, x: np.ndarray, good: np.ndarray, rate: np.ndarray, inflow: np.ndarray, outflow: np.ndarray,
    bands: Sequence[tuple[float, float]], order: int,
) -> np.ndarray:
    """Both passes over a chunk with the states that enter it at either end; a row a band, NaN where a sample is unusable."""
    out, rest = np.full((len(bands), len(us)), np.nan), np.zeros(2 * order)
    for a, b in runs(us, good, rate):
        for i, band in enumerate(bands):
            own = system(*band, float(rate[a]), order)
            y, _ = own.run(x[a:b], inflow[i] if a == 0 else rest)
            back, _ = own.run(y[::-1], outflow[i] if b == len(us) else rest)
            out[i, a:b] = back[::-1]
    return out
