"""States of a keyed table over time."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from orefold.sources import history, versions

DDL = "k long, part string, v string, n double"
KEYS = ("k", "part")
START = datetime(2024, 1, 1)


def day(n):
    return START + timedelta(days=n)


def bytes_in(path, prefix=""):
    return sum(f.stat().st_size for f in Path(path).glob(f"{prefix}*/*.parquet"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def states():
    """A table of which a few rows change, appear and go every day; nulls are values."""
    draw, now, out = random.Random(5), {}, []
    for _ in range(6):
        for _ in range(15):
            key = (draw.choice([*range(20), None]), draw.choice(["a", None]))
            if draw.random() < 0.3:
                now.pop(key, None)
            else:
                now[key] = (draw.choice(["x", None, "y"]), draw.choice([1.5, None]))
        out.append(sorted(((*k, *v) for k, v in now.items()), key=str))
    return out


def test_every_moment_reads_the_state_of_then(spark, tmp_path, states):
    path = str(tmp_path / "t")
    for n, state in enumerate(states):
        history.write_snapshot(spark.createDataFrame(state, DDL), path, KEYS, day(10 * n))
    for n, state in enumerate(states):
        for later in (0, 4):
            assert rows(history.read_as_of(spark, path, KEYS, day(10 * n + later))) == state
    with pytest.raises(ValueError):
        history.read_as_of(spark, path, KEYS, day(-1))
    with pytest.raises(ValueError):
        history.write_snapshot(spark.createDataFrame(states[0], DDL), path, KEYS, day(10))
    history.restore(spark, path, KEYS, day(12), day(70))
    assert rows(history.read_as_of(spark, path, KEYS, day(70))) == states[1]
    assert rows(history.read_as_of(spark, path, KEYS, day(69))) == states[-1]


def test_bytes_follow_the_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    whole = spark.range(50_000).selectExpr("id AS k", "sha2(string(id), 256) AS v")
    history.write_snapshot(whole, path, ["k"], day(0))
    for n in range(1, 6):
        changed = whole.selectExpr("k", f"CASE WHEN k < 20 THEN '{n}' ELSE v END AS v").filter(f"k <> {n}")
        history.write_snapshot(changed, path, ["k"], day(n))
    base = bytes_in(path, "base")
    assert bytes_in(path, "changes") < base / 20
    for folder in Path(path).glob("changes-*"):
        assert spark.read.parquet(str(folder)).count() <= 22


def test_expiry_deletes_old_folders_and_keeps_every_kept_moment(spark, tmp_path, states):
    path = str(tmp_path / "t")
    for n, state in enumerate(states):
        history.write_snapshot(spark.createDataFrame(state, DDL), path, KEYS, day(10 * n))
    now = day(57)  # 14 days before: day 43, whose state is that of day 40
    assert history.expire(spark, path, KEYS, "GOLD", now) == 5
    assert history.snapshots(spark, path) == [history.stamp(day(40)), history.stamp(day(50))]
    assert len(list(Path(path).glob("base-*"))) == 1 and len(list(Path(path).glob("changes-*"))) == 1
    for moment, state in ((43, 4), (49, 4), (50, 5), (57, 5)):
        assert rows(history.read_as_of(spark, path, KEYS, day(moment))) == states[state]
    with pytest.raises(ValueError):
        history.read_as_of(spark, path, KEYS, day(39))
    assert history.expire(spark, path, KEYS, "GOLD", now) == 0
    assert history.expire(spark, path, KEYS, "BRONZE", now) == 0


@pytest.mark.parametrize("stop_after", [1, 2, 5])
def test_expiry_stopped_at_any_step_leaves_kept_moments_whole(spark, tmp_path, states, monkeypatch, stop_after):
    path = str(tmp_path / "t")
    for n, state in enumerate(states[:4]):
        history.write_snapshot(spark.createDataFrame(state, DDL), path, KEYS, day(10 * n))
    done, delete = [], versions.delete

    def stopping(*args):
        if len(done) == stop_after:
            raise OSError("stopped")
        done.append(args)
        delete(*args)

    monkeypatch.setattr(versions, "delete", stopping)
    try:
        history.expire(spark, path, KEYS, "GOLD", day(36))
    except OSError:
        pass
    monkeypatch.undo()
    for moment, state in ((22, 2), (30, 3)):
        assert rows(history.read_as_of(spark, path, KEYS, day(moment))) == states[state]


def test_a_failed_snapshot_is_never_read(spark, tmp_path, states, monkeypatch):
    path = str(tmp_path / "t")
    history.write_snapshot(spark.createDataFrame(states[0], DDL), path, KEYS, day(0))
    monkeypatch.setattr(versions, "create", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        history.write_snapshot(spark.createDataFrame(states[1], DDL), path, KEYS, day(1))
    monkeypatch.undo()
    assert rows(history.read_as_of(spark, path, KEYS, day(5))) == states[0]
    history.write_snapshot(spark.createDataFrame(states[2], DDL), path, KEYS, day(6))
    assert rows(history.read_as_of(spark, path, KEYS, day(6))) == states[2]
