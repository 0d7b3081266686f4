"""Tables stored in reading order and logs stored by day."""

import json
from datetime import date, datetime, timedelta

import pytest

from vigie.operators import changes as C
from vigie.session import work_folder
from vigie.sources import daily_log, ordered, versions

AT, KEY = "recu", "id"
T0 = datetime(2024, 1, 1)


def cases(n):
    """A third of the rows share one instant, some have none, the others fall on mixed minutes."""
    for i in range(n):
        when = None if i % 50 == 7 else T0 if i % 3 == 0 else T0 + timedelta(minutes=i * 7919 % 5000 - 2500)
        yield (i, when, "rare" if i % 400 == 3 else "often")


@pytest.fixture(scope="module")
def stored(spark):
    root = work_folder(spark, "ordered-test")
    df = spark.createDataFrame(cases(4000), f"{KEY} long, {AT} timestamp_ntz, sorte string").repartition(5)
    ordered.save(df, root, "cas", AT, KEY, 16)
    return ordered.opened(spark, root, "cas", AT, KEY)


def expected(sort="often", every=True):
    chosen = [r for r in cases(4000) if every or r[2] == sort]
    return [r[0] for r in sorted(chosen, key=lambda r: (r[1] is not None, -(r[1] - T0).total_seconds() if r[1] else 0, r[0]))]


def ids(df):
    return [r[KEY] for r in df.collect()]


def test_pages_by_number_read_their_ranges_only(stored):
    whole = expected()
    assert stored.count() == 4000
    for skip in (0, 95, 2000, 3990, 4000, 9000):
        page = stored.page(skip, 20)
        assert ids(page) == whole[skip:skip + 20]
        assert page.columns == [KEY, AT, "sorte"]
    sizes = [r["rows"] for r in stored.index.collect()]
    assert len(sizes) == 16 and max(sizes) < 4000 / 8  # the common instant is cut too
    plan = stored.page(3000, 20)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "range_number" in plan


def test_cursors_walk_through_everything(stored):
    for where, whole in (("true", expected()), ("sorte = 'rare'", expected("rare", every=False))):
        seen, cursor, size = [], None, 700 if where == "true" else 3
        while True:
            page = stored.after(cursor, size, where)
            cursor = ordered.cursor_of(page, AT, KEY)
            if cursor is None:
                break
            seen += ids(page)
        assert seen == whole
    assert ids(stored.after(None, 0)) == []


def test_ordered_storage_of_odd_tables(spark):
    root = work_folder(spark, "ordered-test")
    schema = f"{KEY} long, {AT} timestamp_ntz"
    with pytest.raises(ValueError, match="without id"):
        ordered.save(spark.createDataFrame([(None, T0), (1, T0)], schema), root, "cas", AT, KEY, 4)
    assert versions.current(spark, root).number == 0
    ordered.save(spark.createDataFrame([], schema), root, "cas", AT, KEY, 4)
    empty = ordered.opened(spark, root, "cas", AT, KEY)
    assert ids(empty.page(0, 5)) == [] and ids(empty.after(None, 5)) == [] and empty.count() == 0


LOG = (
    "id long, table_name string, operation_type string, record_id long, old_values string, new_values string,"
    " changed_fields array<string>, user_id string, timestamp timestamp_ntz"
)


def entries(spark, first, *times):
    return spark.createDataFrame([(first + i, "operations", "INSERT", i, None, None, None, "u", t) for i, t in enumerate(times)], LOG)


def test_retention_drops_days_and_writes_no_kept_row(spark):
    root, anchor = work_folder(spark, "log-test"), datetime(2024, 3, 1, 12)
    one = entries(spark, 1, datetime(2024, 1, 5), datetime(2024, 1, 31, 11), datetime(2024, 1, 31, 13), datetime(2024, 2, 10), None)
    two = entries(spark, 11, datetime(2023, 12, 1), datetime(2024, 1, 31, 12), datetime(2024, 2, 29, 23, 59))
    daily_log.append(one, root)
    old = daily_log.append(two, root)
    after = daily_log.retain(spark, root, anchor, 30)
    got = daily_log.read(spark, root)
    plain = C.retain(one.unionByName(two), 30, anchor)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    note = got.where("id IS NULL").first()
    assert json.loads(note["new_values"])["deleted_rows"] == 3 and note["timestamp"] == anchor
    fresh = set(after.places.values()) - set(old.places.values())
    assert len(fresh) == 1 and spark.read.parquet(*fresh).count() == 1  # the note alone is written
    assert daily_log.read(spark, root, version=old.number).count() == 8

    assert daily_log.retain(spark, root, anchor, 30) == after  # nothing more to remove
    later = daily_log.retain(spark, root, anchor + timedelta(hours=1), 30)  # the same day's bound moves on
    assert {r["id"] for r in daily_log.read(spark, root).collect()} == {3, 4, 5, 13, None} and later.number == after.number + 1
    daily_log.append(entries(spark, 21, datetime(2024, 1, 31, 1)), root)  # what comes late is there until the next retention
    assert 21 in {r["id"] for r in daily_log.read(spark, root).collect()}
    assert {r["id"] for r in daily_log.read(spark, root, since=date(2024, 2, 29)).collect()} == {13, None}


def test_log_without_entries(spark):
    root = work_folder(spark, "log-test")
    assert daily_log.append(entries(spark, 1).limit(0), root).number == 0
    with pytest.raises(ValueError, match="no audit_log"):
        daily_log.read(spark, root)
    daily_log.append(entries(spark, 1, None, None), root)
    assert daily_log.retain(spark, root, datetime(2030, 1, 1)).number == 1 and daily_log.read(spark, root).count() == 2
