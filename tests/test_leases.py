import random
from datetime import datetime, timedelta

import pytest

from auricle.operators import leases
from tests.conftest import values

START = datetime(2025, 1, 1)


def accepted(attempts):
    out, free = [], {}
    for name, seq, at, released in sorted(attempts, key=lambda a: (a[2], a[1])):
        if name not in free or at >= free[name]:
            out.append((name, seq))
            free.pop(name, None)
            if not released:
                free[name] = at + timedelta(hours=1)
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, count, span, released", [
    (3, 60, 400, 0.2), (4, 300, 3000, 0.5), (5, 80, 20000, 0.1), (6, 200, 600, 0.95), (7, 40, 500, 1.0), (8, 1, 1, 0.0),
])
def test_doubling_equals_the_loop(rows, seed, count, span, released):
    rng = random.Random(seed)
    attempts = [
        (rng.choice("aaaab"), seq, START + timedelta(minutes=rng.choice([0, 59, 60, rng.randrange(span)])), rng.random() < released)
        for seq in range(count)
    ]
    frame = rows("filename STRING, seq BIGINT, at TIMESTAMP_NTZ, released BOOLEAN", attempts)
    got = values(leases.accepted_attempts(frame), "filename", "seq")
    assert got == accepted(attempts)


def test_the_edge_of_a_lease(rows):
    times = [0, 3599, 3600, 7199, 7200]
    frame = rows(
        "filename STRING, seq BIGINT, at TIMESTAMP_NTZ, released BOOLEAN",
        [("x", i, START + timedelta(seconds=s), False) for i, s in enumerate(times)],
    )
    assert values(leases.accepted_attempts(frame), "seq") == [(0,), (2,), (4,)]


def test_held_files_and_empty_input(rows):
    schema = "filename STRING, seq BIGINT, at TIMESTAMP_NTZ, released BOOLEAN"
    frame = rows(schema, [(n, i, START + timedelta(minutes=m), False) for n in "xy" for i, m in enumerate([0, 30, 61, 90, 125])])
    held = rows("filename STRING, free_at TIMESTAMP_NTZ", [("x", START + timedelta(minutes=45))])
    got = values(leases.accepted_attempts(frame, held), "filename", "seq")
    assert got == [("x", 2), ("x", 4), ("y", 0), ("y", 2), ("y", 4)]
    assert values(leases.accepted_attempts(rows(schema, []))) == []


def test_rounds_follow_the_hours_not_the_attempts(rows, monkeypatch):
    made = []
    own = leases.staged
    monkeypatch.setattr(leases, "staged", lambda df: made.append(1) or own(df))
    schema = "filename STRING, seq BIGINT, at TIMESTAMP_NTZ, released BOOLEAN"
    counts = []
    for n in (10, 500):
        made.clear()
        attempts = [("x", i, START + timedelta(seconds=i * 3000 // n), True) for i in range(n)]
        assert leases.accepted_attempts(rows(schema, attempts)).count() == n
        counts.append(len(made))
    assert counts[0] == counts[1]
