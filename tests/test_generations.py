"""Publishing all layers at once: a run that breaks anywhere leaves readers where they were."""

from __future__ import annotations

import json
from dataclasses import replace

import pytest

from eventstrata.config import DEFAULT, LAYOUT
from eventstrata.operators.quality import ReconciliationError
from eventstrata.plans import job
from eventstrata.sinks.generations import Generations
from helpers import event
from test_run import write_stream

CONFIG = replace(DEFAULT, publish="generations")
LAYERS = ("bronze", "quarantine", "silver", "orders", "daily")


def seen(store):
    """What readers get: all rows of all layers."""
    return {name: sorted(map(str, store.read(name).collect())) for name in LAYERS}


@pytest.fixture
def published(spark, tmp_path):
    source = write_stream(spark, tmp_path / "in", 2)
    job.run(spark, source, str(tmp_path / "out"), CONFIG)
    store = Generations(spark, str(tmp_path / "out"))
    (tmp_path / "in" / "more.jsonl").write_text(json.dumps(event("fresh", order_id="fresh")))
    return source, store


@pytest.mark.parametrize("broken", ["write_ordered", "write_small_ordered", "write_report", "reconstruct"])
def test_a_broken_run_changes_no_reader(spark, published, monkeypatch, broken):
    source, store = published
    before, numbers = seen(store), store.numbers()

    def fail(*args, **kwargs):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(job, broken, fail)
        with pytest.raises(OSError):
            job.run(spark, source, store.root, CONFIG)
    assert store.numbers() == numbers and seen(store) == before
    report = job.run(spark, source, store.root, CONFIG)
    after = seen(store)
    assert len(after["bronze"]) == len(before["bronze"]) + 1 == report["raw_events"]
    assert all(after[name] != before[name] for name in ("bronze", "silver", "orders", "daily"))


def test_a_run_that_does_not_reconcile_is_not_published(spark, published, monkeypatch):
    source, store = published
    before = seen(store)
    honest = job.quality.silver_counts
    monkeypatch.setattr(job.quality, "silver_counts", lambda s: honest(s.limit(10)))
    with pytest.raises(ReconciliationError):
        job.run(spark, source, store.root, CONFIG)
    assert seen(store) == before


def test_open_readers_keep_their_generation_until_it_is_removed(spark, published):
    source, store = published
    held = store.read("orders")
    rows = held.count()
    job.run(spark, source, store.root, CONFIG)
    assert held.count() == rows and store.read("orders").count() == rows + 1
    failed = store.begin()
    assert store.vacuum(keep=2) == []
    assert len(store.vacuum(keep=1)) == 1 and store.numbers() == [2]
    assert store.read("orders").count() == rows + 1
    assert failed.split("/")[-1].startswith("000000000003")


def test_one_layer_alone_and_two_publishers(spark, tmp_path):
    store = Generations(spark, str(tmp_path))
    assert store.layers() == {} and store.vacuum() == []
    first = store.begin()
    spark.range(3).write.parquet(f"{first}/a")
    spark.range(4).write.parquet(f"{first}/b")
    rival = store.begin()
    assert store.publish(first, {"a": "a", "b": "b"}) == 1
    with pytest.raises(RuntimeError, match="another run"):
        store.publish(rival, {"a": "a"})
    second = store.begin()
    spark.range(5).write.parquet(f"{second}/a")
    store.publish(second, {"a": "a"})
    assert (store.read("a").count(), store.read("b").count()) == (5, 4)
    # The folder of the first generation still holds a layer in use.
    assert store.vacuum(keep=1) == [] and store.read("b").count() == 4


def test_unknown_way_to_publish():
    with pytest.raises(ValueError, match="publish"):
        replace(DEFAULT, publish="sometimes")
    assert set(LAYERS) < set(LAYOUT)
