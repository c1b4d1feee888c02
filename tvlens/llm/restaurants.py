"""Chinese restaurants of one vocabulary part: seating, Gibbs moves, predictions.

A :class:`Level` holds one kind of restaurant for the words of a part: a row is
a dish (word) in a restaurant, with ``c`` customers at ``t`` tables.  Rows know
the table sizes, so customers can leave and sit down one at a time.  A row's
``a`` is the weight of a new table, (strength + discount * tables of the
restaurant) * probability of the dish in the parent restaurant; an occupied
table of n customers weighs n - discount.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np


def first_seating(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Seat ``c`` customers of every row one after the other: (row, size) of the tables.

    With i customers at t tables the next one opens a table with probability
    a / (a + i - d * t), so the wait for it is beta-geometric: it is drawn at
    once instead of customer by customer.  The customers who come between two
    new tables are put at the former one.
    """
    rows, starts = [np.arange(len(c))], [np.ones(len(c))]
    row = np.flatnonzero(c > 1)
    at, t = np.ones(len(row)), np.ones(len(row))
    while len(row):
        with np.errstate(divide="ignore", over="ignore"):
            share = rng.beta(a[row], at - d * t)
            at = at + np.maximum(1.0, np.ceil(np.log(1.0 - rng.random(len(row))) / np.log1p(-share)))
        on = at <= c[row]
        row, at, t = row[on], at[on], t[on] + 1
        rows.append(row)
        starts.append(at)
    row, start = np.concatenate(rows), np.concatenate(starts).astype(np.int64)
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    last = np.concatenate((row[1:] != row[:-1], [True])) if len(row) else np.zeros(0, bool)
    ends = np.where(last, c[row] + 1, np.concatenate((start[1:], [0])))
    return row, ends - start


class Level:
    def __init__(self, c: np.ndarray, row: np.ndarray | None = None, size: np.ndarray | None = None):
        """Without tables given, all customers of a row sit at one."""
        self.c = c.astype(np.int64)
        self.row = np.arange(len(c)) if row is None else row
        self.size = self.c.copy() if size is None else size

    @property
    def t(self) -> np.ndarray:
        return np.bincount(self.row, minlength=len(self.c))

    def seat(self, c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> None:
        self.c = c.astype(np.int64)
        self.row, self.size = first_seating(self.c, a, d, rng)

    def _ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Of all customers in order: the first of each row, the end of each table."""
        return np.cumsum(self.c) - self.c, np.cumsum(self.size)

    def _random_tables(self, rows: np.ndarray, start: np.ndarray, ends: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """The table of a random customer in each of the rows."""
        customer = start[rows] + (rng.random(len(rows)) * self.c[rows]).astype(np.int64)
        return np.searchsorted(ends, customer, "right")

    def _leave(self, rows: np.ndarray, rng: np.random.Generator) -> None:
        self.size[self._random_tables(rows, *self._ends(), rng)] -= 1
        self.c[rows] -= 1
        kept = self.size > 0
        if not kept.all():
            self.row, self.size = self.row[kept], self.size[kept]

    def _sit(self, rows: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> None:
        weight = a[rows]
        new = rng.random(len(rows)) * (weight + self.c[rows] - d * self.t[rows]) < weight
        joins, taken, ends = rows[~new], [], self._ends()
        while len(joins):
            # A random customer's table, kept with (size - d) / size: weight size - d.
            table = self._random_tables(joins, *ends, rng)
            ok = rng.random(len(joins)) * self.size[table] >= d
            taken.append(table[ok])
            joins = joins[~ok]
        if taken:
            self.size[np.concatenate(taken)] += 1
        self.c[rows] += 1
        if new.any():
            at = np.searchsorted(self.row, rows[new], "right")
            self.row, self.size = np.insert(self.row, at, rows[new]), np.insert(self.size, at, 1)

    @contextmanager
    def _only(self, rows: np.ndarray) -> Iterator[Level]:
        """Some rows as a level of their own, which is put back at the end."""
        apart = np.zeros(len(self.c), bool)
        apart[rows] = True
        own = apart[self.row]
        part = Level(self.c[rows], np.searchsorted(rows, self.row[own]), self.size[own])
        yield part
        self.c[rows] = part.c
        row = np.concatenate((self.row[~own], rows[part.row]))
        order = np.argsort(row, kind="stable")
        self.row, self.size = row[order], np.concatenate((self.size[~own], part.size))[order]

    def _shrink(self, c: np.ndarray, rng: np.random.Generator) -> None:
        while len(rows := np.flatnonzero(self.c > c)):
            if 2 * len(rows) > len(c):
                self._leave(rows, rng)
            else:
                with self._only(rows) as part:
                    part._shrink(c[rows], rng)

    def _grow(self, c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> None:
        while len(rows := np.flatnonzero(self.c < c)):
            if 2 * len(rows) > len(c):
                self._sit(rows, a, d, rng)
            else:
                with self._only(rows) as part:
                    part._grow(c[rows], a[rows], d, rng)

    def change(self, c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> None:
        """Random customers leave, or new ones sit down, until each row has ``c``."""
        self._shrink(c, rng)
        self._grow(c, a, d, rng)

    def gibbs(self, a: np.ndarray, d: float, moves: int, rng: np.random.Generator) -> None:
        """In every row a random customer leaves and sits down again, ``moves`` times.

        Rows of one customer, most of them, cannot change and stay out of it."""
        rows = np.flatnonzero(self.c > 1)
        if not len(rows) or not moves:
            return
        with self._only(rows) as part:
            every = np.arange(len(rows))
            for _ in range(moves):
                part._leave(every, rng)
                part._sit(every, a[rows], d, rng)


def once_and_twice(c: np.ndarray) -> list[int]:
    return [int((c == 1).sum()), int((c == 2).sum())]


def discount(once: int, twice: int) -> float:
    """Discount from the numbers of dishes that were ordered once and twice."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
