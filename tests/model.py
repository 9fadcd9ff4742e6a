"""Event-by-event model of the counters, for comparison with the closed forms."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timezone

from footfall.model import ACTION_WEIGHTS, HISTORY_SCHEMA

START = 1706140800  # 2024-01-25 00:00:00 UTC


def day(t: int) -> int:
    return int(datetime.fromtimestamp(t, timezone.utc).strftime("%Y%m%d"))


def random_history(seed: int, n: int = 300, users: int = 3, items: int = 7, days: int = 6, hot: float = 0.4):
    """Rows of HISTORY_SCHEMA; user 0 and item 0 are hot, and seconds collide."""
    rng = random.Random(seed)
    times = sorted(START + rng.randrange(0, days * 86400, 600) for _ in range(n))
    rows = []
    for seq, t in enumerate(times):
        user = 0 if rng.random() < hot else rng.randrange(users)
        item = 0 if rng.random() < hot / 2 else rng.randrange(items)
        kind = rng.choice([1, 2, 3, 5, 12, 16])
        group = ["11", "11", "21"][user % 3]
        shown = [item, (item + 3) % items] if kind in (1, 2) else [item]
        for i in shown:
            rows.append(("1", str(10000 + user), group, f"i{i}", kind, t, seq, kind in (1, 2), ACTION_WEIGHTS[kind]))
    return rows


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, HISTORY_SCHEMA).repartition(parts)


def _events(rows):
    """Rows grouped by event, in order."""
    events = defaultdict(list)
    for r in rows:
        events[(r[5], r[6])].append(r)
    return [events[k] for k in sorted(events)]


def item_contributions(rows, link: int):
    seen, state = [], {}
    for event in _events(rows):
        seen += event
        for bid, user, group, item, _, t, _, shown, w in event:
            if shown:
                continue
            best = max((x[8], day(x[5])) for x in seen if x[1] == user and x[3] == item and day(x[5]) >= day(t - link))
            state[(user, group, item)] = best
    return {k: (d, w) for k, (w, d) in state.items()}


def pair_contributions(rows, link: int):
    """(user, group, a, b, day) → weight, with retraction inside and forgetting outside the link window."""
    seen, state, sums = [], {}, defaultdict(float)
    for event in _events(rows):
        seen += event
        for bid, user, group, item, _, t, _, shown, w in event:
            if shown:
                continue
            best = {}
            for x in seen:
                if x[1] == user and x[5] > t - link:
                    best[x[3]] = max(best.get(x[3], (-1.0, 0)), (x[8], day(x[5])))
            for other, (ow, od) in best.items():
                if other == item or ow <= 0:
                    continue
                a, b = sorted((item, other))
                new = (min(best[item][0], ow), min(best[item][1], od))
                old = state.get((user, a, b))
                if old is not None and old[1] >= day(t - link):
                    sums[(user, group, a, b, old[1])] -= old[0]
                sums[(user, group, a, b, new[1])] += new[0]
                state[(user, a, b)] = new
    return {k: v for k, v in sums.items() if v}
