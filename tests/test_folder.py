import os
import time

import pytest
from conftest import SAMPLE

from cardweave.operators.parse import messages, parse_feed
from cardweave.plans.feed import write_files
from cardweave.sources.folder import changed_files, list_folder, read_folder, watch_folder


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in box"
    folder.mkdir()
    files = {"b.v1.xml": "two\n", "a.xml": SAMPLE, "plain": "é", "empty.xml": "", ".hidden": "h", ".dot.xml": "d", "_u.xml": "u", "x y+%41.xml": "s"}
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    for sub in ("sub", "k=1", "deep/in box"):
        (folder / sub).mkdir(parents=True)
        (folder / sub / "inner.xml").write_text("not in the feed")
    return folder


EXPECTED = {
    "b.v1": "two\n", "a": SAMPLE, "plain": "é", "empty": "", ".hidden": "h", ".dot": "d", "_u": "u", "x y+%41": "s",
}


def pairs(df):
    return {r["key"]: r["value"] for r in df.collect()}


def test_every_file_directly_in_the_folder(spark, inbox):
    df = read_folder(spark, str(inbox))
    assert df.count() == len(EXPECTED)
    assert pairs(df) == EXPECTED
    assert pairs(read_folder(spark, f"file:{inbox}/")) == EXPECTED


def test_one_listing_in_parts(spark, tmp_path, monkeypatch):
    import cardweave.sources.files as files

    for i in range(25):
        (tmp_path / f"m{i:02}.xml").write_text("x" * i)
    monkeypatch.setattr(files, "PART_FILES", 10)
    monkeypatch.setattr(files, "PART_BYTES", 100)
    listed = list_folder(spark, str(tmp_path))
    assert listed.rdd.getNumPartitions() > 3
    assert sorted(r["name"] for r in listed.collect()) == [f"m{i:02}.xml" for i in range(25)]
    assert pairs(read_folder(spark, str(tmp_path))) == {f"m{i:02}": "x" * i for i in range(25)}


def test_an_empty_folder(spark, tmp_path):
    assert list_folder(spark, str(tmp_path)).collect() == [] and read_folder(spark, str(tmp_path)).collect() == []


def test_only_what_spark_lists(spark, inbox):
    assert pairs(read_folder(spark, str(inbox), complete=False)) == {k: EXPECTED[k] for k in ("b.v1", "a", "plain", "x y+%41")}


def test_path_order(spark, inbox):
    keys = [r["key"] for r in read_folder(spark, str(inbox), ordered=True).collect()]
    assert keys == [".dot", ".hidden", "_u", "a", "b.v1", "empty", "plain", "x y+%41"]


def test_files_parse(spark, inbox):
    assert [r["key"] for r in messages(parse_feed(read_folder(spark, str(inbox)))).collect()] == ["a"]


def test_bytes_that_are_not_text(spark, inbox):
    (inbox / "bad.xml").write_bytes(b"a\xffb")
    with pytest.raises(Exception, match="INVALID_UTF8"):
        read_folder(spark, str(inbox)).collect()
    assert pairs(read_folder(spark, str(inbox), on_invalid="replace"))["bad"] == "a�b"


def test_changed_files(spark, inbox):
    seen = read_folder(spark, str(inbox)).select("path", "modified")
    seen = spark.createDataFrame(seen.collect(), seen.schema)
    assert changed_files(read_folder(spark, str(inbox)), seen).count() == 0
    (inbox / "a.xml").write_text("changed")
    (inbox / ".hidden").write_text("changed too")
    (inbox / "new.xml").write_text("new")
    later = time.time() + 5
    for name in ("a.xml", ".hidden"):
        os.utime(inbox / name, (later, later))
    for limit in (64 << 20, -1):
        changed = changed_files(read_folder(spark, str(inbox)), seen, limit)
        assert pairs(changed) == {"a": "changed", ".hidden": "changed too", "new": "new"}


def test_watching(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        query = (
            watch_folder(spark, str(inbox), files_per_batch=2)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return sorted((r["key"], r["value"]) for r in spark.read.parquet(out).collect())

    for i in range(5):
        (inbox / f"m{i}.xml").write_text(f"<{i}>\n")
    first = [(f"m{i}", f"<{i}>\n") for i in range(5)]
    assert run() == first
    assert run() == first
    (inbox / "m9.xml").write_text("late")
    assert run() == [*first, ("m9", "late")]


def test_write_files(spark, tmp_path):
    df = spark.createDataFrame([(f"k.{i}", f"é{i}\n") for i in range(20)], "key STRING, value STRING").repartition(3)
    write_files(df, f"file:{tmp_path}/made")
    assert {p.name: p.read_text(encoding="utf-8") for p in (tmp_path / "made").iterdir()} == {
        f"k.{i}.xml": f"é{i}\n" for i in range(20)
    }
