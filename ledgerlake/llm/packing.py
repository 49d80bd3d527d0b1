"""Bin completion for one block of documents, by branch and bound.

The best-fit-decreasing packing is the first incumbent. The search then takes the longest
remaining document, enumerates undominated fillings of the space beside it, fullest first,
and goes on with the rest. It leaves a branch as soon as the space wasted in it would cost as
many sequences as the incumbent has, and ends when the incumbent meets the lower bound or the
budget of nodes is used up.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

#: Search limits: nodes of the tree for each bin of the incumbent, steps of one enumeration,
#: fillings tried at a node.
NODES, STEPS, WIDTH = 2, 60, 2


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of lengths. ``lengths`` are sorted, longest first."""
    spaces: list[tuple[int, int]] = []  # (space left, bin), sorted
    bins: list[list[int]] = []
    for n in lengths:
        at = bisect_left(spaces, (n, -1))
        if at < len(spaces):
            space, b = spaces.pop(at)
        else:
            space, b = capacity, len(bins)
            bins.append([])
        bins[b].append(n)
        if space > n:
            insort(spaces, (space - n, b))
    return bins


class Stock:
    """The documents that remain, by length."""

    def __init__(self, lengths: list[int]):
        self.count: dict[int, int] = {}
        for n in lengths:
            self.count[n] = self.count.get(n, 0) + 1
        self.kinds = sorted(self.count)

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            del self.kinds[bisect_left(self.kinds, n)]

    def give(self, n: int) -> None:
        if not self.count.get(n):
            insort(self.kinds, n)
        self.count[n] = self.count.get(n, 0) + 1

    def largest(self, most: int) -> int:
        """The largest length up to ``most``, or 0."""
        at = bisect_right(self.kinds, most)
        return self.kinds[at - 1] if at else 0


def dominated(filling: tuple[int, ...], space: int, stock: Stock) -> bool:
    """Whether one document of the filling, or two, can give way to a single longer one."""
    slack = space - sum(filling)
    for a in set(filling):
        if slack and stock.largest(a + slack) > a and \
                stock.count[b := stock.largest(a + slack)] > filling.count(b):
            return True
    for i, a in enumerate(filling):
        for b in filling[i + 1:]:
            c = stock.largest(a + b + slack)
            if c >= a + b and stock.count[c] > filling.count(c):
                return True
    return False


def fillings(space: int, stock: Stock) -> list[tuple[int, ...]]:
    """Up to ``WIDTH`` undominated sets of documents that fit into ``space``, fullest first."""
    found: dict[tuple[int, ...], int] = {}
    steps, perfect = 0, 0
    path: list[int] = []

    def search(left: int, most: int) -> None:
        nonlocal steps, perfect
        n = stock.largest(min(left, most))
        if not n:
            key = tuple(path)
            found[key] = left
            perfect += not left
            return
        while n and steps < STEPS and perfect < WIDTH:
            steps += 1
            if stock.count[n] > path.count(n):
                path.append(n)
                search(left - n, n)
                path.pop()
            n = stock.largest(n - 1)

    search(space, space)
    if not found:  # every length that fits is used up along the path
        found[()] = space
    out = []
    for filling in sorted(found, key=lambda f: (found[f], len(f))):
        if not filling or not dominated(filling, space, stock):
            out.append(filling)
            if len(out) == WIDTH:
                break
    return out or [min(found, key=lambda f: found[f])]


def complete(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of lengths. Of packings with equally many bins the one whose waste is
    gathered in the fewest bins is returned, so that those bins can be packed again."""
    lengths = sorted(lengths, reverse=True)
    total = sum(lengths)
    bound = -(-total // capacity)
    incumbent = best_fit(lengths, capacity)

    def open_bins(bins):
        return sum(sum(b) < capacity for b in bins)

    stock, chosen, choices = Stock(lengths), [], []
    wasted, nodes = 0, 0
    budget = NODES * len(incumbent)
    while nodes < budget:
        if not stock.kinds:
            bins = [list(b) for b in chosen]
            if (len(bins), open_bins(bins)) < (len(incumbent), open_bins(incumbent)):
                incumbent = bins
            if len(incumbent) == bound:
                break
        else:
            nodes += 1
            first = stock.kinds[-1]
            stock.take(first)
            space = capacity - first
            options = fillings(space, stock) if space else [()]
            choices.append((first, options[::-1]))
            chosen.append(None)
        # Take the next option of the deepest bin; go back where none is left.
        while choices:
            first, options = choices[-1]
            if chosen[-1] is not None:
                for n in chosen[-1][1:]:
                    stock.give(n)
                wasted -= capacity - sum(chosen[-1])
                chosen[-1] = None
            if options:
                filling = options.pop()
                waste = capacity - first - sum(filling)
                # The bins that the waste costs, besides those the documents need, must not
                # make this packing worse than the incumbent.
                if -(-(total + wasted + waste) // capacity) <= len(incumbent):
                    for n in filling:
                        stock.take(n)
                    chosen[-1] = (first, *filling)
                    wasted += waste
                    break
            else:
                choices.pop()
                chosen.pop()
                stock.give(first)
        if not choices:
            break
    return incumbent
