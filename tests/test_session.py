"""Written intermediates: where they lie, and when they go."""

from __future__ import annotations

import os
import threading

import pytest

from hearthline import session


def test_released_tables_are_deleted(spark):
    stored = session.settle(spark.range(3), "kept")
    path = stored._settled_at.removeprefix("file:")
    assert stored.count() == 3 and os.path.isdir(path)
    session.release(stored, spark.range(2))
    assert not os.path.exists(path) and stored._settled_at not in session._WRITTEN
    session.release(stored)


def test_local_folders_are_refused_on_clusters(spark):
    class Conf:
        def __init__(self, held):
            self.held = held

        def get(self, key, default=None):
            return self.held.get(key, default)

        def set(self, key, value):
            self.held[key] = value

    class Session:
        def __init__(self, master, **held):
            self.conf = Conf(held)
            self.sparkContext = type("Context", (), {"master": master})

    for master, warehouse in (("spark://host:7077", "file:/tmp/w"), ("yarn", "/tmp/w")):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(Session(master, **{"spark.sql.warehouse.dir": warehouse}))
    assert session.shared_dir(Session("yarn", **{"spark.sql.warehouse.dir": "hdfs://h/w"})) == "hdfs://h/w/_between"
    assert session.shared_dir(Session("local[2]", **{"spark.sql.warehouse.dir": "file:/tmp/w/"})) == "file:/tmp/w/_between"
    assert session.shared_dir(Session("yarn", **{"spark.checkpoint.dir": "file:/shared/", "spark.sql.warehouse.dir": "file:/w"})) == "file:/shared"


def test_freed_shuffles_of_threads(spark):
    """The setting is back to what it was when the last thread is done, whoever began or ended first."""
    spark.conf.set(session.SHUFFLE_CLEANUP, "false")
    gates = [threading.Event() for _ in range(2)]

    def work(own, other):
        with session.freed_shuffles(spark):
            assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
            own.set()
            other.wait(10)

    threads = [threading.Thread(target=work, args=(gates[k], gates[1 - k])) for k in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_small_methods(spark):
    kept = spark.conf.get(session.METHOD_BYTES)
    try:
        for given, then in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(session.METHOD_BYTES, given)
            session.small_methods(spark)
            assert spark.conf.get(session.METHOD_BYTES) == then
    finally:
        spark.conf.set(session.METHOD_BYTES, kept)
