import pytest

from smoglake.sources import versions as V


def _write(spark, root, rows):
    folder = V.fresh_folder()
    spark.createDataFrame(rows, "x int").write.parquet(f"{root}/{folder}")
    return folder


def test_versions_become_visible_by_their_commit(spark, tmp_dir):
    assert V.latest(spark, tmp_dir) is None
    a = _write(spark, tmp_dir, [(1,)])
    one = V.publish(spark, tmp_dir, {"t": [a]}, {"note": "ä"})
    b = _write(spark, tmp_dir, [(2,)])
    assert V.latest(spark, tmp_dir) == one and one.read(spark, "t").count() == 1
    two = V.publish(spark, tmp_dir, {"t": [a, b]}, after=one)
    assert V.latest(spark, tmp_dir) == two and sorted(r.x for r in two.read(spark, "t").collect()) == [1, 2]
    assert one.read(spark, "t").count() == 1 and one.about == {"note": "ä"}  # the version before still reads


def test_of_two_writers_one_fails(spark, tmp_dir):
    one = V.publish(spark, tmp_dir, {})
    V.publish(spark, tmp_dir, {"t": []}, after=one)
    with pytest.raises(RuntimeError, match="meanwhile"):
        V.publish(spark, tmp_dir, {}, after=one)
    with pytest.raises(RuntimeError):
        V.publish(spark, tmp_dir, {}, after=V.latest(spark, tmp_dir), number=1)


def test_unfinished_commit_is_not_read(spark, tmp_dir):
    one = V.publish(spark, tmp_dir, {"t": []})
    with open(f"{tmp_dir}/{V.COMMITS}/{1:012d}", "w") as f:
        f.write('{"tables": {')
    assert V.latest(spark, tmp_dir) == one
    two = V.publish(spark, tmp_dir, {"t": []}, after=one)  # goes past it
    assert two.number == 2 and V.latest(spark, tmp_dir) == two


def test_vacuum_keeps_what_the_last_version_uses(spark, tmp_dir):
    a, b = _write(spark, tmp_dir, [(1,)]), _write(spark, tmp_dir, [(2,)])
    one = V.publish(spark, tmp_dir, {"t": [a]})
    assert V.vacuum(spark, tmp_dir, "data") == 0
    assert V.vacuum(spark, tmp_dir, "data", older_than_s=-10) == 1
    assert one.read(spark, "t").count() == 1
    with pytest.raises(Exception):  # noqa: B017  the folder that no version names is gone
        spark.read.parquet(f"{tmp_dir}/{b}")


def test_table_without_folders(spark, tmp_dir):
    one = V.publish(spark, tmp_dir, {"t": []})
    assert one.read(spark, "t", "x int").count() == 0
    with pytest.raises(KeyError):
        one.read(spark, "t")
