"""Merge-on-read archives: appends leave files alone, intervals, compaction, stops, conflicts, digests."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from seriesloom import session
from seriesloom.operators import bitemporal, digests
from seriesloom.plans.backfill import resumable_backfill
from seriesloom.sources import commits, deltas
from seriesloom.streaming import incremental
from seriesloom.workloads.archives import Stopped, stopping_after

LOG = "series_id string, as_of date, recorded_on date, value double, provisional boolean"


def day(number):
    return dt.date(2024, 12, 1) + dt.timedelta(days=number)


def log_of(spark, rows):
    return spark.createDataFrame([(s, day(d), day(r), float(v), p) for s, d, r, v, p in rows], LOG)


def rows_of(frame):
    return sorted((r.series_id, r.as_of, r.recorded_on, r.value, r.provisional) for r in frame.collect())


def files(path):
    found = {}
    for folder, _, names in os.walk(path.removeprefix("file://")):
        found |= {os.path.join(folder, n): os.path.getmtime(os.path.join(folder, n)) for n in names if n.endswith(".parquet")}
    return found


def batches(spark):
    """Appends, restatements, revisions of the tip, a late day, a series of two years, and a refused batch."""
    yield log_of(spark, [("a", 0, 0, 1, False), ("a", 1, 1, 2, True), ("b", 0, 0, 5, True)])
    yield log_of(spark, [("a", 1, 2, 3, False), ("a", 2, 2, 4, True)])          # revise the tip, append
    yield log_of(spark, [("a", 0, 3, 9, False), ("a", 2, 3, 4, True), ("b", 40, 3, 6, True)])  # restate, skip, freeze over new year
    yield log_of(spark, [("a", 0, 3, 11, False), ("c", 5, 3, 1, True)])         # a is refused, c is new
    yield log_of(spark, [("a", 0, 4, 12, False), ("a", 2, 4, 5, True), ("a", -3, 4, 7, False)])
    yield log_of(spark, [("a", 2, 5, 5.5, True), ("a", 0, 5, 12, False)])


def test_appends_equal_the_plain_log_at_every_vintage(spark):
    path = session.scratch_path(spark, "deltas")
    log = spark.createDataFrame([], LOG)
    for batch in batches(spark):
        summary = deltas.append_history(batch, path, buckets=2)
        plan = bitemporal.append_plan(log, batch)
        assert sorted(map(str, summary.collect())) == sorted(map(str, bitemporal.append_summary(plan).collect()))
        log = session.cut_lineage(bitemporal.apply_plan(log, plan).select(*log.columns))
        assert rows_of(deltas.read_lines(spark, path)) == rows_of(log)
        assert rows_of(deltas.view(spark, path)) == rows_of(bitemporal.current_view(log))
    for vintage in range(-1, 7):
        assert rows_of(deltas.view(spark, path, day(vintage))) == rows_of(bitemporal.current_view(log, day(vintage)))


def test_append_and_replay_change_no_existing_file(spark):
    path = session.scratch_path(spark, "deltas")
    first, second, *_ = batches(spark)
    deltas.append_history(first, path, buckets=2)
    before = files(path)
    deltas.append_history(second, path)
    after = files(path)
    assert len(after) > len(before) and before.items() <= after.items()
    deltas.append_history(second, path)
    assert files(path) == after and commits.snapshot(spark, path).number == 2


def test_compaction_keeps_the_view_and_merges_in_tiers(spark):
    path = session.scratch_path(spark, "deltas")
    for batch in batches(spark):
        deltas.append_history(batch, path, buckets=1)
    lines, views = rows_of(deltas.read_lines(spark, path)), [rows_of(deltas.view(spark, path, day(v))) for v in range(7)]
    held = commits.snapshot(spark, path)
    assert deltas.compact(spark, path, fan=3) >= 3
    after = commits.snapshot(spark, path)
    assert len(after.parts) < len(held.parts) and after.number == held.number + 1
    assert rows_of(deltas.read_lines(spark, path)) == lines
    assert commits.delete_unlisted(spark, path) and not commits.delete_unlisted(spark, path)
    assert [rows_of(deltas.view(spark, path, day(v))) for v in range(7)] == views
    deltas.append_history(log_of(spark, [("a", 0, 9, 77, False)]), path)
    assert ("a", day(0), day(9), 77.0, False) in rows_of(deltas.view(spark, path))


def test_merging_only_part_of_a_partition_keeps_its_removals(spark):
    path = session.scratch_path(spark, "deltas")
    many = [("a", d, 0, d, False) for d in range(28)]
    deltas.append_history(log_of(spark, many), path, buckets=1)
    for vintage in (1, 2):
        deltas.append_history(log_of(spark, [("a", 3, vintage, 100 + vintage, False)]), path)
    assert deltas.compact(spark, path, fan=2) == 2
    assert {part.rows for part in commits.snapshot(spark, path).parts} >= {28}
    view = {r.as_of: r.value for r in deltas.view(spark, path).collect()}
    assert len(view) == 28 and view[day(3)] == 102.0
    assert len(rows_of(deltas.read_lines(spark, path))) == 30


def test_due_picks_parts_of_like_size():
    sizes = [1000, 20, 17, 30, 3]
    parts = [commits.Part(f"f{k}", (2024, 0), rows, 0) for k, rows in enumerate(sizes)]
    assert deltas.due(parts, 4) == []
    parts.append(commits.Part("more", (2024, 0), 60, 0))  # the fourth of the tier 16 .. 63; smaller ones go along
    assert [sorted(p.rows for p in group) for group in deltas.due(parts, 4)] == [[3, 17, 20, 30, 60]]
    assert deltas.due([commits.Part(f"f{k}", (2000 + k, 0), 20, 0) for k in range(9)], 4) == []


@pytest.mark.parametrize("writes", range(1, 7))
def test_a_run_stopped_at_any_write_leaves_a_whole_state(spark, writes):
    path = session.scratch_path(spark, "deltas")
    pick = random.Random(1)
    bars = log_of(spark, [(f"s{k}", d, 3, pick.random(), False) for k in range(6) for d in range(4)])
    with pytest.raises(Stopped):
        resumable_backfill(bars, path, 3, stopping_after(writes))
    held = commits.snapshot(spark, path)
    assert (held.number if held else 0) == writes // 2
    if held:
        seen = {r.series_id for r in deltas.view(spark, path).collect()}
        whole = [n for n in range(3) if f"backfill-{n:06d}-of-000003" in held.markers]
        assert len(whole) == writes // 2
        mine = bars.filter(F.pmod(F.xxhash64("series_id", F.lit(17)), F.lit(3)).isin(whole)).select("series_id").distinct().collect()
        assert seen == {r.series_id for r in mine}
    assert len(resumable_backfill(bars, path, 3)) == 3 - writes // 2
    assert rows_of(deltas.view(spark, path)) == rows_of(bars)
    assert resumable_backfill(bars, path, 3) == []


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    path = str(tmp_path / "plain")  # no scheme
    deltas.append_history(log_of(spark, [("a", 0, 0, 1, False)]), path, buckets=1)
    held = commits.snapshot(spark, path)
    commits.commit(spark, path, held, [], markers={"one": True})
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, path, held, [], markers={"two": True})
    assert commits.snapshot(spark, path).markers == {"one": True}
    names = [n for n in os.listdir(path.removeprefix("file://") + "/_commits") if not n.endswith(".crc")]
    assert sorted(names) == ["000000000001.json", "000000000002.json"]


def test_past_view_is_a_pushed_filter_without_an_aggregate(spark, capsys):
    path = session.scratch_path(spark, "deltas")
    deltas.append_history(log_of(spark, [("a", 0, 0, 1, False), ("a", 1, 0, 1, False)]), path, buckets=1)
    deltas.view(spark, path, day(2)).explain("formatted")
    plan = capsys.readouterr().out
    assert "LessThanOrEqual(recorded_on" in plan and "GreaterThan(recorded_to" in plan
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_replacing_a_series_leaves_the_others_files(spark):
    path = session.scratch_path(spark, "series")
    obs = spark.createDataFrame([("a", day(0), 1.0), ("a", day(1), 2.0), ("b", day(0), 3.0)], "series_id string, as_of date, value double")
    deltas.replace_series(obs, path, buckets=1)
    before = files(path)
    deltas.replace_series(obs.filter("series_id = 'a'").limit(1).withColumn("value", F.lit(9.0)), path)
    deltas.replace_series(obs.filter("series_id = 'a'").withColumn("series_id", F.lit("c")), path)
    assert before.items() <= files(path).items()
    want = [("a", 9.0), ("b", 3.0), ("c", 1.0), ("c", 2.0)]
    assert sorted((r.series_id, r.value) for r in deltas.read_series(spark, path).collect()) == want
    assert deltas.compact(spark, path, fan=2) >= 2
    assert sorted((r.series_id, r.value) for r in deltas.read_series(spark, path).collect()) == want


def test_one_changed_bar_opens_one_leaf(spark):
    rows = [(s, d, 0, d + k, False) for k, s in enumerate("abc") for d in (0, 5, 40)]
    one = log_of(spark, rows)
    other = log_of(spark, [(s, d, r, v + (s == "b" and d == 40), p) for s, d, r, v, p in reversed(rows)]).repartition(5)
    leaves = [digests.leaf_digests(x, ["as_of", "value"]) for x in (one, other)]
    opened = digests.differing_leaves(*leaves)
    assert [(r.series_id, r.year, r.n_one, r.n_other) for r in opened.collect()] == [("b", 2025, 1, 1)]
    found = digests.differing_lines(one, other, opened, ["as_of", "value"]).first()
    assert (found.only_one, found.only_other, found.n_differing) == (0, 0, 1)
    assert digests.differing_leaves(leaves[0], digests.leaf_digests(one.repartition(3), ["as_of", "value"])).count() == 0
    short = digests.differing_leaves(leaves[0], digests.leaf_digests(one.filter("series_id <> 'c'"), ["as_of", "value"]))
    assert {(r.series_id, r.year, r.n_other) for r in short.collect()} == {("c", 2024, 0), ("c", 2025, 0)}


def test_readings_replace_their_own_day_and_replays_write_nothing(spark):
    path, landing = session.scratch_path(spark, "readings"), session.scratch_path(spark, "landing")
    schema = "series_id string, as_of date, value double, arrival long"
    spark.createDataFrame([("a", day(0), 1.0, 1), ("a", day(0), 2.0, 2), ("a", day(1), 3.0, 3), ("b", day(0), 4.0, 4)], schema).write.parquet(landing)

    def run(state):
        stream = incremental.landing(spark, landing, spark.read.parquet(landing).schema)
        incremental.accumulate_readings(stream, path, state)
        return sorted((r.series_id, r.as_of, r.value) for r in deltas.read_series(spark, path).collect())

    state = session.scratch_path(spark, "state")
    assert run(state) == [("a", day(0), 2.0), ("a", day(1), 3.0), ("b", day(0), 4.0)]
    before = files(path)
    spark.createDataFrame([("a", day(0), 9.0, 5)], schema).write.mode("append").parquet(landing)
    assert run(state) == [("a", day(0), 9.0), ("a", day(1), 3.0), ("b", day(0), 4.0)]
    assert before.items() <= files(path).items() and commits.snapshot(spark, path).number == 2
    assert run(state) == run(state) and commits.snapshot(spark, path).number == 2
    assert run(session.scratch_path(spark, "state"))[0] == ("a", day(0), 9.0)  # from scratch, as after a lost checkpoint
