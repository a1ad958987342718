"""Publishing of runs: all outputs of one run or none."""

from datetime import date

import pytest

from staffcast.sinks.runs import find_run, publish, published_days, read_output

DAY, NEXT = date(2001, 8, 2), date(2001, 8, 3)
NAMES = ("requests", "features", "forest", "predictions")


class Killed(Exception):
    pass


def writers(spark, value, killed_at=None):
    def write(name, place):
        if name == killed_at:
            raise Killed(name)
        spark.createDataFrame([(value,)], "v int").coalesce(1).write.parquet(place)

    return {name: lambda place, name=name: write(name, place) for name in NAMES}


def values(spark, path, day=None):
    places = find_run(spark, path, day).places
    return [spark.read.parquet(places[name]).first()["v"] for name in NAMES]


def test_nothing_published(spark, tmp_path):
    assert published_days(spark, str(tmp_path)) == []
    with pytest.raises(FileNotFoundError):
        find_run(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read_output(spark, str(tmp_path), "predictions")


@pytest.mark.parametrize("killed_at", NAMES)
def test_a_run_killed_between_two_writes_changes_nothing(spark, tmp_path, killed_at):
    path = str(tmp_path)
    first = publish(spark, path, DAY, writers(spark, 1))
    for day in (DAY, NEXT):
        with pytest.raises(Killed):
            publish(spark, path, day, writers(spark, 2, killed_at))
    assert find_run(spark, path) == first and published_days(spark, path) == [DAY]
    assert values(spark, path) == [1, 1, 1, 1]
    assert publish(spark, path, DAY, writers(spark, 3)).version == 2
    assert values(spark, path) == [3, 3, 3, 3]
    assert [r.v for r in read_output(spark, path, "predictions").collect()] == [3]


def test_an_unfinished_manifest_does_not_count(spark, tmp_path):
    path = str(tmp_path)
    first = publish(spark, path, DAY, writers(spark, 1))
    publish(spark, path, DAY, writers(spark, 2))
    (tmp_path / "published" / f"day={DAY}" / "version=2" / "_SUCCESS").unlink()
    assert find_run(spark, path) == first and values(spark, path) == [1, 1, 1, 1]
    # Its number is not used again, and what it names stays unread.
    assert publish(spark, path, DAY, writers(spark, 3)).version == 3
    assert values(spark, path) == [3, 3, 3, 3]


def test_days_keep_their_runs(spark, tmp_path):
    path = str(tmp_path)
    for day, value in ((DAY, 1), (NEXT, 2), (DAY, 3)):
        publish(spark, path, day, writers(spark, value))
    assert published_days(spark, path) == [DAY, NEXT]
    assert values(spark, path, DAY) == [3, 3, 3, 3] and values(spark, path) == [2, 2, 2, 2]
    assert sorted(r.v for r in read_output(spark, path, "predictions").collect()) == [2, 3]


def test_a_taken_number_is_left_alone(spark, tmp_path, monkeypatch):
    """Two runs list the same versions; the second finds its number taken and takes the next."""
    from staffcast.sinks import runs

    path = str(tmp_path)
    publish(spark, path, DAY, writers(spark, 1))
    listed, real = [], runs._versions

    def stale(*args, **options):
        listed.append(1)
        return [] if len(listed) == 1 else real(*args, **options)

    monkeypatch.setattr(runs, "_versions", stale)
    assert runs.publish(spark, path, DAY, writers(spark, 2)).version == 2
    assert values(spark, path) == [2, 2, 2, 2]
