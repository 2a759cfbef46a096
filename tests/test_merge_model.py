"""Random merges against the MERGE rules written out in Python."""

import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardproof.operators import merge
from cardproof.sources import snapshots

KEY = st.sampled_from([None, "a", "b", "c", "d"])
ROW = st.tuples(KEY, st.integers(0, 9), st.sampled_from(["x", "y"]))
ROWS = st.lists(ROW, max_size=6)
QUICK = settings(
    max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def stored(spark, tmp_path, target, source, action, partition_by):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    frames = [spark.createDataFrame(rows, "k string, v int, p string") for rows in (target, source)]
    merge.insert_into_table(frames[0], path, ["k"], partition_by)
    action(frames[1], path, ["k"])
    return sorted((tuple(r) for r in snapshots.read_table(spark, path).collect()), key=repr)


@QUICK
@given(target=ROWS, source=ROWS, split=st.booleans())
def test_insert_only(spark, tmp_path, target, source, split):
    known = {k for k, _, _ in target if k is not None}
    expected = target + [row for row in source if row[0] not in known]
    got = stored(spark, tmp_path, target, source, merge.insert_into_table, ["p"] if split else [])
    assert got == sorted(expected, key=repr)


@QUICK
@given(target=ROWS, source=ROWS, split=st.booleans())
def test_upsert(spark, tmp_path, target, source, split):
    known = {k for k, _, _ in target if k is not None}
    copies = {k: [row for row in source if row[0] == k] for k in known}
    partition_by = ["p"] if split else []
    if any(len(rows) > 1 for rows in copies.values()):
        try:
            stored(spark, tmp_path, target, source, merge.upsert_table, partition_by)
        except merge.DuplicateSourceKeys:
            return
        raise AssertionError("a repeated source key went through")
    expected = [copies[row[0]][0] if copies.get(row[0]) else row for row in target]
    expected += [row for row in source if row[0] not in known]
    assert stored(spark, tmp_path, target, source, merge.upsert_table, partition_by) == sorted(expected, key=repr)
