"""The history kept by increments: every order of arrival ends alike, and only what changes is written."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators.changes import status_history
from tidemark.plans.history import PERIODS, POINTS, History
from tidemark.plans.snapshots import LostRace
from tidemark.schemas import ACCOUNT
from tidemark.session import scratch_path

DAY = datetime(2020, 1, 1)


def versions(spark, rows):
    return spark.createDataFrame(rows, "account_id BIGINT, source_updated_at TIMESTAMP, status STRING")


def found(df):
    return sorted(map(repr, df.select("account_id", "status", "valid_from", "valid_to", "is_current").collect()))


def history(spark, **k):
    return History(spark, scratch_path(spark, "history"), ACCOUNT, "status", **{"buckets": 4, "days": 30, **k})


def test_every_order_of_arrival_equals_the_full_computation(spark):
    rng, rows = random.Random(1), []
    for key in [*range(12), None]:
        for _ in range(300 if key == 3 else 12):  # one key has far more versions
            at = DAY + timedelta(hours=rng.randrange(24 * 200)) if rng.random() > 0.03 else None
            rows.append((key, at, rng.choice(["A", "A", "B", None])))
    rows += rng.sample(rows, 60)  # repeated versions
    rng.shuffle(rows)
    kept = history(spark, days=45, buckets=2)
    cuts = sorted(rng.sample(range(len(rows)), 2))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        kept.merge(versions(spark, rows[a:b]), f"B-{i}")
        assert found(kept.periods()) == found(status_history(versions(spark, rows[:b]), "account_id", "status"))


def test_late_versions_split_join_and_move_periods(spark):
    kept, at = history(spark), [DAY + timedelta(days=40 * i) for i in range(6)]

    def after(*rows):
        kept.merge(versions(spark, [(1, at[i], s) for i, s in rows]), "B")
        return [(r.status, at.index(r.valid_from), None if r.valid_to is None else at.index(r.valid_to))
                for r in kept.periods().orderBy("valid_from").collect()]

    assert after((1, "A"), (3, "A"), (5, "A")) == [("A", 1, None)]
    assert after((2, "B")) == [("A", 1, 2), ("B", 2, 3), ("A", 3, None)]  # the version at 3 was kept
    assert after((4, None)) == [("A", 1, 2), ("B", 2, 3), ("A", 3, 4), (None, 4, 5), ("A", 5, None)]
    assert after((0, "A")) == [("A", 0, 2), ("B", 2, 3), ("A", 3, 4), (None, 4, 5), ("A", 5, None)]
    assert after((3, "B"), (4, "B")) == [("A", 0, 2), ("B", 2, 5), ("A", 5, None)]  # greatest state of an instant


def test_increments_write_only_what_they_change(spark):
    kept = history(spark, buckets=4, days=180)
    rows = [(key, DAY + timedelta(days=30 * i), "AB"[i // 3 % 2]) for key in range(20) for i in range(12)]
    first = kept.merge(versions(spark, rows), "B-1")
    whole = found(kept.periods())
    confirmed = kept.merge(versions(spark, [(5, DAY + timedelta(days=31), "A")]), "B-2")
    assert confirmed.files[PERIODS] == first.files[PERIODS]  # no period changed, so none was written
    moved = {c for f, held in confirmed.files[POINTS].items() if f not in first.files[POINTS] for c in held}
    assert len(moved) == 1
    changed = kept.merge(versions(spark, [(5, DAY + timedelta(days=32), "C")]), "B-3")
    buckets = [held for f, held in changed.files[PERIODS].items() if f not in first.files[PERIODS]]
    assert len(buckets) == 1 and len(buckets[0]) == 1
    assert found(kept.periods(first)) == whole != found(kept.periods())  # readers keep their snapshot
    assert kept.merge(versions(spark, rows[:0]), "B-4") == changed
    now = found(kept.periods())
    assert kept.sweep(1) and found(kept.periods()) == now


def test_many_increments_are_gathered_and_a_slower_writer_loses(spark, monkeypatch):
    monkeypatch.setattr("tidemark.plans.history.MOST_FOLDERS", 2)
    kept, rows = history(spark, buckets=2), []
    for i in range(3):
        rows.append((i % 2, DAY + timedelta(days=20 * i), "ABC"[i % 3]))
        now = kept.merge(versions(spark, rows[-1:]), f"B-{i}")
        assert len(now.files[POINTS]) == (1, 2, 1)[i]
    assert found(kept.periods()) == found(status_history(versions(spark, rows), "account_id", "status"))
    before = kept.snapshots.newest()
    other = History(spark, kept.root, ACCOUNT, "status", buckets=2, days=30)
    monkeypatch.setattr(other.snapshots, "newest", lambda: before)
    kept.merge(versions(spark, [(7, DAY, "A")]), "won")
    now = found(kept.periods())
    with pytest.raises(LostRace):
        other.merge(versions(spark, [(8, DAY, "A")]), "lost")
    assert found(kept.periods()) == now
