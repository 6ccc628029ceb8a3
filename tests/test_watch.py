import os
import time

import pytest

from cardweave.sinks.store import Store
from cardweave.sources.folder import read_folder, settled
from cardweave.streaming.watch import poll_folder, watch_changes


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder


def put(folder, name, text, age=10):
    (folder / name).write_text(text)
    at = time.time() - age
    os.utime(folder / name, (at, at))


def test_new_and_rewritten_files_are_published(spark, inbox, tmp_path):
    store = Store(spark, str(tmp_path / "state"))
    published = []

    def publish(records):
        published.append(sorted((r["key"], r["value"]) for r in records.collect()))

    put(inbox, "a.xml", "1")
    put(inbox, ".b.xml", "")
    put(inbox, "empty.xml", "")
    poll_folder(store, str(inbox), 0, publish)
    poll_folder(store, str(inbox), 1, publish)
    put(inbox, "a.xml", "2", age=5)
    put(inbox, "c.xml", "3")
    put(inbox, "busy.xml", "half", age=-60)
    poll_folder(store, str(inbox), 2, publish)
    put(inbox, "busy.xml", "whole", age=1)
    poll_folder(store, str(inbox), 3, publish)
    assert published == [[(".b", ""), ("a", "1"), ("empty", "")], [], [("a", "2"), ("c", "3")], [("busy", "whole")]]
    # Repeating a poll publishes the same again.
    poll_folder(store, str(inbox), 3, publish)
    assert published[-1] == [("busy", "whole")]


def test_settled(spark, inbox):
    put(inbox, "old.xml", "", age=2)
    put(inbox, "new.xml", "", age=0)
    files = read_folder(spark, str(inbox))
    assert {r["key"] for r in settled(files, 1.9).collect()} >= {"old"}
    assert settled(files, 3600).count() == 0


def test_watching_goes_on(spark, inbox, tmp_path):
    store = Store(spark, str(tmp_path / "state"))
    published = []
    put(inbox, "a.xml", "1")
    query = watch_changes(
        store, str(inbox), str(tmp_path / "checkpoint"), lambda df: published.extend(r["value"] for r in df.collect())
    )
    try:
        for text in ("1", "2", "3"):
            deadline = time.time() + 90
            while text not in published and time.time() < deadline:
                assert query.isActive, query.exception()
                time.sleep(0.2)
            put(inbox, "a.xml", str(int(text) + 1), age=4 - int(text))
    finally:
        query.stop()
    assert published[:3] == ["1", "2", "3"]


def looked(store, inbox, checkpoint, **options):
    """What one run of the stream publishes, batch by batch."""
    found = []
    publish = lambda df: found.append(sorted((r["key"], r["value"]) for r in df.collect()))
    query = watch_changes(store, str(inbox), checkpoint, publish, every=None, **options)
    query.awaitTermination()
    return [batch for batch in found if batch]


def test_every_change_comes_once(spark, inbox, tmp_path):
    store, checkpoint = Store(spark, str(tmp_path / "state")), str(tmp_path / "checkpoint")
    for name, text in {"a.xml": "1", "empty.xml": "", ".hidden": "h", "_u.xml": "", "b.v1.xml": "b"}.items():
        put(inbox, name, text, age=100)
    put(inbox, "busy.xml", "half", age=-600)
    (inbox / "sub").mkdir()
    put(inbox / "sub", "inner.xml", "x")
    first = [(".hidden", "h"), ("_u", ""), ("a", "1"), ("b.v1", "b"), ("empty", "")]
    assert looked(store, inbox, checkpoint) == [first]
    assert looked(store, inbox, checkpoint) == []
    put(inbox, "a.xml", "2", age=5_000)  # written again, with an older time
    put(inbox, "empty.xml", "no more", age=100)  # with the same time
    put(inbox, "busy.xml", "whole", age=50)
    assert looked(store, inbox, checkpoint) == [[("a", "2"), ("busy", "whole"), ("empty", "no more")]]
    (inbox / "b.v1.xml").unlink()
    assert looked(store, inbox, checkpoint) == []
    put(inbox, "b.v1.xml", "b", age=100)  # the same file, put back
    assert looked(store, inbox, checkpoint) == [[("b.v1", "b")]]


def test_a_replayed_batch_has_the_same_rows(spark, inbox, tmp_path):
    store, checkpoint = Store(spark, str(tmp_path / "state")), str(tmp_path / "checkpoint")
    for name in ("a", "b", "c"):
        put(inbox, f"{name}.xml", name)
    assert looked(store, inbox, checkpoint) == [[("a", "a"), ("b", "b"), ("c", "c")]]
    put(inbox, "d.xml", "d")

    def stopped(records):
        raise RuntimeError("stopped half-way")

    failed = watch_changes(store, str(inbox), checkpoint, stopped, every=None)
    with pytest.raises(Exception, match="stopped half-way"):
        failed.awaitTermination()
    put(inbox, "e.xml", "e")
    # Spark runs such a source one batch at a time here: first the one that failed.
    found = looked(store, inbox, checkpoint) + looked(store, inbox, checkpoint)
    assert found == [[("d", "d")], [("e", "e")]]


def test_few_files_at_a_time_and_whole_listings(spark, inbox, tmp_path, monkeypatch):
    import cardweave.sources.files as files

    monkeypatch.setattr(files, "_COMPACT_AFTER", 2)
    monkeypatch.setattr(files, "PART_FILES", 2)
    store, checkpoint = Store(spark, str(tmp_path / "state")), str(tmp_path / "checkpoint")
    seen = []
    for i in range(6):
        put(inbox, f"m{i}.xml", str(i), age=100 - i)
        seen += [key for batch in looked(store, inbox, checkpoint, files_per_batch=1) for key, _ in batch]
    assert seen == [f"m{i}" for i in range(6)]
    state = tmp_path / "checkpoint" / "watched"
    assert len(list(state.glob("whole-*"))) == 1 and len(list(state.glob("changed-*"))) < 6
    for i in range(3):
        put(inbox, f"n{i}.xml", str(i), age=50 - i)
    found = looked(store, inbox, checkpoint, files_per_batch=3)
    assert found == [[("n0", "0"), ("n1", "1"), ("n2", "2")]]
