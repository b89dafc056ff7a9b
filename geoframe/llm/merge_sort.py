"""Common-prefix-aware merging of sorted strings.

A run is sorted locally and front-coded: a string is its common prefix length
with the one before it in the run, and the rest.  Runs are combined by a loser
tree whose nodes remember how far a loser agreed with the string that beat it;
two strings that are both compared with the same last winner differ already
where these lengths do, and are otherwise compared from there on, so no prefix
that is known to agree is looked at again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix, known to be at least ``start``."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    lo, hi = start, end                    # they differ in [lo, hi)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_code(strings: Iterable[bytes], restart: int) -> Iterator[tuple[int, bytes]]:
    """``(common prefix, rest)`` of each of some sorted strings.  A string whose
    first ``restart`` bytes differ from those of the one before it is written
    whole, so that runs can be cut there."""
    before = b""
    for s in strings:
        n = common_prefix(before, s)
        if n < min(restart, len(s)) or n < restart:
            n = 0
        yield n, s[n:]
        before = s


def front_decode(coded: Iterable[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """``(length known to agree with the one before, string)``."""
    before = b""
    for n, rest in coded:
        if rest or n < len(before):            # else the same object again
            before = before[:n] + rest
        yield n, before


def merge(runs: list[Iterable[tuple[int, bytes, object]]]) -> Iterator[tuple[int, bytes, object]]:
    """Merge of runs of ``(prefix known to agree with the one before in its run,
    string, payload)``; gives ``(common prefix with the last output, string,
    payload)`` in order."""
    sources = [iter(r) for r in runs]
    k = len(sources)
    if not k:
        return
    head = [next(s, None) for s in sources]
    known = [0] * k                        # agreement with the last output
    losers = [-1] * k                      # losers[0] is the winner

    def beats(a: int, b: int) -> bool:
        """Whether a's string is first; sets the loser's agreement with it."""
        if head[a] is None or head[b] is None:
            return head[b] is None
        if known[a] != known[b]:
            return known[a] > known[b]
        x, y = head[a][1], head[b][1]
        n = common_prefix(x, y, known[a])
        first = (x[n:n + 1], a) < (y[n:n + 1], b)
        known[b if first else a] = n
        return first

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if beats(a, b):
            losers[node] = b
            return a
        losers[node] = a
        return b

    winner = play(1) if k > 1 else 0
    while head[winner] is not None:
        _, string, payload = head[winner]
        yield known[winner], string, payload
        head[winner] = next(sources[winner], None)
        if head[winner] is not None:
            # within a run more may agree than its code says (restarts)
            known[winner] = common_prefix(string, head[winner][1], head[winner][0])
        node = (winner + k) // 2
        while node >= 1 and k > 1:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
