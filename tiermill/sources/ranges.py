"""Sets of offset ranges: for each part of a source (a topic partition, a file) sorted, disjoint [first, next) pairs."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

Ranges = dict[str, list[tuple[int, int]]]


def merged(rows: Iterable[tuple[str, int, int]]) -> Ranges:
    """Rows (part, first, next) in any order, overlapping or touching ones joined; empty ranges vanish."""
    out: Ranges = {}
    for part, first, following in sorted(rows):
        own = out.setdefault(part, [])
        if own and first <= own[-1][1]:
            own[-1] = own[-1][0], max(own[-1][1], following)
        elif first < following:
            own.append((first, following))
    return {part: own for part, own in out.items() if own}


def without(wanted: Ranges, covered: Ranges) -> Ranges:
    """What of `wanted` isn't in `covered`: the gaps."""
    out: Ranges = {}
    for part, own in wanted.items():
        left = []
        for first, following in own:
            for a, b in covered.get(part, []):
                if b <= first or a >= following:
                    continue
                if a > first:
                    left.append((first, a))
                first = max(first, b)
            if first < following:
                left.append((first, following))
        if left:
            out[part] = left
    return out


def rows_of(ranges: Ranges) -> list[tuple[str, int, int]]:
    return [(part, first, following) for part, own in sorted(ranges.items()) for first, following in own]


def bounded(ranges: Ranges, starts: Mapping[str, int], ends: Mapping[str, int]) -> Ranges:
    """From the start on and before the end of each part. Where ends are given, parts without one are left out: they came later."""
    rows = [(p, max(a, starts.get(p, a)), min(b, ends.get(p, b))) for p, a, b in rows_of(ranges) if not ends or p in ends]
    return merged(r for r in rows if r[1] < r[2])


def layers(ranges: Ranges) -> list[dict[str, tuple[int, int]]]:
    """One range per part in each layer, for readers that take no more: as many as the most ranges of a part."""
    most = max(map(len, ranges.values()), default=0)
    return [{part: own[k] for part, own in ranges.items() if len(own) > k} for k in range(most)]


def offsets_of(topic: str, offsets: str | None) -> dict[str, int]:
    """Offset by part, from JSON {topic: {part: offset}}; -2 and -1 are the ends and set no bound."""
    if offsets in (None, "earliest", "latest"):
        return {}
    by_topic = json.loads(offsets)
    if set(by_topic) - {topic}:
        raise ValueError(f"offsets of another topic than {topic!r}: {sorted(by_topic)}")
    return {str(p): int(o) for p, o in by_topic.get(topic, {}).items() if int(o) >= 0}


def as_offsets(topic: str, by_part: Mapping[str, int]) -> str:
    return json.dumps({topic: dict(sorted(by_part.items()))})
