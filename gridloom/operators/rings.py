"""Nearest places by rings of cells: an index of a bounded table that every task holds."""

from __future__ import annotations

import numpy as np

EARTH_KM = 6371.0
# Distances on the ellipsoid are from 0.994 to 1.0046 times those on the sphere of the index; what
# may be as near as another place in rounded kilometres is within this factor and this much more.
STRETCH, SLACK_KM = 1.011, 0.2
# Places for each cell of the finest level, about; and its least size, some 60 m.
PER_CELL, LEAST_SIZE = 2, 1e-5


def _on_sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    lat, lon = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)


def _chord(km: np.ndarray | float) -> np.ndarray | float:
    """Straight distance on the unit sphere."""
    return 2 * np.sin(np.minimum(km / EARTH_KM, np.pi) / 2)


def _km(chord: np.ndarray) -> np.ndarray:
    return 2 * EARTH_KM * np.arcsin(np.minimum(chord / 2, 1))


class RingIndex:
    """Places on the sphere in cubic cells, at sizes each twice the one before."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray):
        self.points = _on_sphere(lat, lon)
        finest = self._finest()
        self.sizes = [finest * 2**k for k in range(max(1, int(np.ceil(np.log2(2 / finest))) + 1))]
        self.levels = []
        for size in self.sizes:
            keys = self._keys(self.points, size)
            order = np.argsort(keys, kind="stable")
            cells, first = np.unique(keys[order], return_index=True)
            self.levels.append((cells, np.append(first, len(order)), order))

    def _finest(self) -> float:
        """Size of cells that hold about PER_CELL of the places around a place, however those crowd."""
        places = np.unique(self.points, axis=0)
        size = max(np.sqrt(4 * np.pi * PER_CELL / max(len(places), 1)), LEAST_SIZE)
        while size / 2 >= LEAST_SIZE:
            _, held = np.unique(self._keys(places, size), return_counts=True)
            # The mean over places, not over cells: a crowd counts by its size.
            if (held.astype(np.float64) ** 2).sum() <= PER_CELL * len(places):
                break
            size /= 2
        return size

    @staticmethod
    def _keys(points: np.ndarray, size: float, shift=(0, 0, 0)) -> np.ndarray:
        cell = np.floor((points + 1) / size).astype(np.int64) + np.array(shift) + 1
        return (cell[:, 0] << 42) + (cell[:, 1] << 21) + cell[:, 2]

    def _ring(self, spots: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(spot, place) of all places in a spot's cell and the ring of cells around it."""
        cells, starts, order = self.levels[level]
        found = [[], []]
        for x in (-1, 0, 1):
            for y in (-1, 0, 1):
                for z in (-1, 0, 1):
                    keys = self._keys(spots, self.sizes[level], (x, y, z))
                    at = np.minimum(np.searchsorted(cells, keys), len(cells) - 1)
                    own = np.flatnonzero(cells[at] == keys)
                    first, count = starts[at[own]], starts[at[own] + 1] - starts[at[own]]
                    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    found[0].append(np.repeat(own, count))
                    found[1].append(order[np.repeat(first, count) + inside])
        return np.concatenate(found[0]), np.concatenate(found[1])

    def nearest(self, lat: np.ndarray, lon: np.ndarray, number: int, threshold_km: float) -> tuple[np.ndarray, np.ndarray]:
        """(spot, place) of the places that can be among the ``number`` nearest, sorted by spot.

        A ring of cells holds everything within one cell's size. The search of a spot ends once its
        ``number``-th place is nearer than that, or where nothing is within the threshold; until then
        the cells double. Of what a ring holds only places as near as the ``number``-th are kept.
        """
        spots, out = _on_sphere(lat, lon), [[], []]
        limit_km = (threshold_km + SLACK_KM) * STRETCH
        open_ = np.arange(len(spots) if len(self.points) else 0)
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            last = level == len(self.sizes) - 1
            spot, place = self._ring(spots[open_], level)
            km = _km(np.linalg.norm(spots[open_][spot] - self.points[place], axis=1))
            order = np.lexsort((km, spot))
            spot, place, km = spot[order], place[order], km[order]
            first = np.searchsorted(spot, np.arange(len(open_)))
            count = np.searchsorted(spot, np.arange(len(open_)), "right") - first
            nearest = np.where(count > 0, km[np.minimum(first, len(km) - 1)] if len(km) else 0.0, np.inf)
            kth = np.where(count >= number, km[np.minimum(first + number - 1, len(km) - 1)] if len(km) else 0.0, np.inf)
            reach = np.where(np.isfinite(kth), kth * STRETCH + SLACK_KM, np.inf)
            with np.errstate(invalid="ignore"):
                settled = np.isfinite(reach) & (_chord(np.where(np.isfinite(reach), reach, 0.0)) <= size)
            nothing = (nearest > limit_km) & (_chord(limit_km) <= size)
            done = settled | nothing | last
            kept = done[spot] & ~nothing[spot] & (km <= reach[spot])
            out[0].append(open_[spot[kept]])
            out[1].append(place[kept])
            open_ = open_[~done]
        spot, place = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
        order = np.argsort(spot, kind="stable")
        return spot[order], place[order]
