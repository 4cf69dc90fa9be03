"""Which merges one set of pair counts settles.

Training merges the most frequent pair, counts again, and so on. Counting is a
pass over the whole corpus, so the point is to take as many merges as possible
from one pass, and exactly those that counting after each merge would take.

Two pairs *touch* if one ends with the token the other begins with. Merging a
pair changes nothing about pairs it does not touch. For a pair that touches a
merged one on one side, the count of places where the two overlap says how many
occurrences are lost and how often the new token stands next to the remaining
token. Overlaps are only counted for some *watched* pairs; all others that
touch a merged pair are left with an upper bound, which holds for the pairs
created from them as well. Taking stops where a bound comes first in line.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple


class PairCount(NamedTuple):
    left: int
    right: int
    n: int


@dataclass
class _Candidate:
    left: int
    right: int
    n: int
    place: int | None  # rank in the order of first occurrence; None once changed
    exact: bool = True  # otherwise n is an upper bound
    created: bool = False  # holds a token that was not there when counting
    touched_left: bool = False
    touched_right: bool = False

    @property
    def pair(self) -> tuple[int, int]:
        return self.left, self.right

    def rank(self) -> tuple[int, bool, int]:
        return -self.n, self.place is not None, self.place or 0

    def touches(self, other: _Candidate) -> bool:
        return self.left == other.right or self.right == other.left


Overlaps = Mapping[tuple[tuple[int, int], tuple[int, int]], int]


def certain_merges(
    leaders: Sequence[PairCount],
    limit: int,
    next_token: int,
    ordered_ties: bool,
    complete: bool,
    watched: Collection[tuple[int, int]] = (),
    overlaps: Overlaps | None = None,
) -> tuple[list[PairCount], list[tuple[int, int]]]:
    """The next merges in order, and the pairs likely to lead afterwards.

    ``leaders`` are the most frequent pairs, most frequent first; equal counts
    are in order of first occurrence if ``ordered_ties``. ``complete`` says
    that there are no further pairs. ``overlaps[p, q]`` counts the places where
    watched pair ``q`` starts at the second token of watched pair ``p``.

    Equal counts are the delicate part. A pair that is untouched keeps its
    place in line; an untouched pair met earlier also precedes everything that
    may be created from pairs further down. An adjusted or created pair has no
    known place, so nothing is taken out of a tie with one.
    """
    overlaps = overlaps or {}
    line = [_Candidate(p.left, p.right, p.n, i) for i, p in enumerate(leaders)]
    floor = 0 if complete or not leaders else leaders[-1].n
    taken: list[PairCount] = []
    merged: list[_Candidate] = []
    while line and len(taken) < limit:
        line.sort(key=_Candidate.rank)
        head, rival = line[0], line[1].n if len(line) > 1 else 0
        placed = ordered_ties and head.place is not None
        if not head.exact or head.n <= 0 or not (placed or head.n > max(rival, floor)):
            break
        line.pop(0)
        taken.append(PairCount(*head.pair, head.n))
        if head.left == head.right:
            # Occurrences overlap each other; what is left of them is unknown.
            break
        line += _settle(head, next_token + len(taken) - 1, line, merged, watched, overlaps)
        merged.append(head)
    line.sort(key=_Candidate.rank)
    return taken, [c.pair for c in line]


def _settle(
    head: _Candidate,
    token: int,
    line: list[_Candidate],
    merged: list[_Candidate],
    watched: Collection[tuple[int, int]],
    overlaps: Overlaps,
) -> list[_Candidate]:
    """Adjust the pairs that ``head`` touches; return the pairs it creates."""
    created = []
    # Overlaps describe the head only as long as all its occurrences are there.
    described = head.place is not None and head.pair in watched
    for other in line:
        if not other.touches(head):
            continue
        before, after = other.right == head.left, other.left == head.right
        if not (described and other.exact and not other.created and other.pair in watched):
            other.exact = False
            continue
        lost_before = overlaps.get((other.pair, head.pair), 0) if before else 0
        lost_after = overlaps.get((head.pair, other.pair), 0) if after else 0
        other.touched_right |= lost_before > 0
        other.touched_left |= lost_after > 0
        if other.touched_left and other.touched_right:
            # Some occurrences may be lost to both sides.
            other.exact = False
        elif lost_before or lost_after:
            pair = (other.left, token) if lost_before else (token, other.right)
            new = _Candidate(*pair, lost_before or lost_after, None, created=True)
            new.exact = not any(new.touches(m) for m in merged)
            created.append(new)
            other.n -= new.n
            other.place = None
    return created
