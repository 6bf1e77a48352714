"""The staged merge of sources: what stops it, its rules for links, and publishing."""

from datetime import datetime

import pytest

from tidewatch.operators import migration

LINK = "id long, slick long, source long, active boolean, score double, link_rank int, create_time timestamp, hitl_verification boolean, hitl_confidence int, hitl_user string, hitl_time timestamp, hitl_notes string, extra string"
EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 2, 1)


def link(id_, slick, source, active=True, score=0.5, rank=1, at=EARLY, yes=None, confidence=None, user=None, when=None, notes=None, extra="x"):
    return (id_, slick, source, active, score, rank, at, yes, confidence, user, when, notes, extra)


def run(spark, mapping, links, sources=None, details=None):
    sources = sources or [(1, 2, "s"), (2, 2, "l1"), (3, 2, "l2"), (4, 1, "new"), (5, 2, "other"), (6, 1, "l3")]
    details = details if details is not None else [(i, f"name {i}") for i in (1, 2, 3, 5)]
    return migration.staged(
        spark.createDataFrame(mapping, "large_ext_id string, small_ext_id string"), spark.createDataFrame(sources, "id long, type int, ext_id string"),
        spark.createDataFrame(details, "source_id long, ext_name string"), spark.createDataFrame(links, LINK))


def by_key(staged):
    return {(r.slick, r.source): r for r in staged.links.collect()}


def test_links_meet_at_their_target(spark):
    """Two links of a slick at merged sources and one at the target become one: active if any is, confirmed if any is, its notes those
    of the confirmed one; columns that the merge doesn't know are the target's."""
    got = by_key(run(spark, [("l1", "s"), ("l2", "s")], [
        link(10, 1, 1, False, 0.2, 3, yes=False, user="old", notes="kept", extra="mine"), link(11, 1, 2, True, 0.9, 1), link(12, 1, 3, None, 0.8, 2, yes=True, user="new"),
        link(13, 1, 5, True, 0.3, 4), link(14, 2, 3, False, None, None), link(15, 3, 5, True, 0.1, 7)]))
    assert set(got) == {(1, 1), (1, 5), (2, 1), (3, 5)}
    one = got[1, 1]
    # the active link of source 2 goes before the confirmed one of source 3, so that its empty notes don't go over
    assert (one.id, one.active, one.score, one.hitl_verification, one.hitl_user, one.hitl_notes, one.extra) == (10, True, 0.2, True, "old", "kept", "mine")
    # ranks of touched slicks follow the scores, others stay
    assert (got[1, 5].link_rank, one.link_rank, got[3, 5].link_rank) == (1, 2, 7)
    assert (got[2, 1].id, got[2, 1].active, got[2, 1].link_rank, got[2, 1].hitl_verification) == (16, False, None, None)


def test_reviews_go_over(spark):
    got = by_key(run(spark, [("l1", "s")], [
        link(1, 1, 1, yes=None, confidence=2, user="a", when=EARLY), link(2, 1, 2, yes=True, confidence=None, user="b", when=LATE, notes="sure"),
        link(3, 2, 1, yes=None, user="a"), link(4, 2, 2, yes=False, user="b"), link(5, 3, 1, yes=True, user="a"), link(6, 3, 2, yes=False, user="b")]))
    assert [(r.hitl_verification, r.hitl_confidence, r.hitl_user, r.hitl_time, r.hitl_notes) for r in (got[1, 1], got[2, 1], got[3, 1])] == [(True, 2, "b", LATE, "sure"), (False, None, "a", None, None), (True, None, "a", None, None)]


@pytest.mark.parametrize("better, worse", [
    (dict(active=True, score=0.1), dict(active=False, yes=True, score=0.9)), (dict(yes=True, score=0.1), dict(yes=False, score=0.9)), (dict(score=0.9, at=EARLY), dict(score=0.2, at=LATE)),
    (dict(score=-1.0), dict(score=None)), (dict(at=LATE, rank=5), dict(at=EARLY, rank=1)), (dict(at=EARLY), dict(at=None)), (dict(rank=1), dict(rank=2)), (dict(rank=2), dict(rank=None))])
def test_which_link_is_moved(spark, better, worse):
    for first in (0, 1):
        rows = [link(7 + first, 1, 2, extra="better", **better), link(8 - first, 1, 3, extra="worse", **worse)]
        (got,) = migration.retargeted(spark.createDataFrame(rows, LINK), spark.createDataFrame([(2, 1), (3, 1)], "large_id long, small_id long")).collect()
        assert (got.source, got.extra) == (1, "better")


def test_missing_targets_are_seeded(spark):
    """A name of another type is no target: the seed has the smallest donor's details. Names that are no source are left out."""
    out = run(spark, [("l2", "new"), ("l1", "new"), ("l3", "s"), ("gone", "s"), ("nowhere", "unseen")], [link(1, 1, 2), link(2, 1, 6), link(3, 2, 3)])
    assert sorted(map(tuple, out.sources.where("id > 6").collect())) == [(7, 2, "new")]
    assert [tuple(r) for r in out.details.where("source_id = 7").collect()] == [(7, "name 2")]
    assert sorted((r.slick, r.source) for r in out.links.collect()) == [(1, 6), (1, 7), (2, 7)]
    assert {(r.large_ext_id, r.large_id, r.small_id) for r in out.resolved.collect()} == {("l2", 3, 7), ("l1", 2, 7), ("l3", None, 1), ("gone", None, 1), ("nowhere", None, None)}


@pytest.mark.parametrize("mapping, details, fault", [
    ([], None, "empty_map"), ([("l1", "l2"), ("l2", "s")], None, "map_faults"), ([("l1", "l1")], None, "map_faults"), ([("l1", "s"), ("l1", "other")], None, "map_faults"), ([("l1", None)], None, "map_faults"),
    ([("gone", "s")], None, "nothing_to_merge"), ([("l1", "new")], [(1, "name 1")], "donors_without_details"), ([("l1", "s")], [(2, "name 2")], "targets_without_details")])
def test_what_stops_it(spark, mapping, details, fault):
    with pytest.raises(migration.MigrationStopped) as e:
        run(spark, mapping, [link(1, 1, 2)], details=details)
    assert list(e.value.faults) == [fault]


def test_repeated_links_stop_it(spark):
    """Links that stood twice before can't be merged: nothing is staged."""
    with pytest.raises(migration.MigrationStopped) as e:
        run(spark, [("l1", "s")], [link(1, 1, 1), link(2, 1, 1), link(3, 1, 2)])
    assert e.value.faults == {"repeated_links": 1}


def test_published_once_and_unchanged_by_another_run(spark, tmp_path):
    folder = f"file://{tmp_path}/site"
    assert migration.current(spark, folder) is None
    with pytest.raises(FileNotFoundError):
        migration.published(spark, folder, "links")
    mapping = [("l1", "s"), ("l2", "new")]
    first = run(spark, mapping, [link(1, 1, 2, score=0.1), link(2, 1, 5, score=0.7), link(3, 2, 3)])
    # a run that ended between its tables and its row isn't seen
    first.links.limit(1).write.parquet(f"{folder}/links/run=one")
    assert migration.current(spark, folder) is None
    assert migration.publish(first, folder, "one") and not migration.publish(first, folder, "one")
    read = lambda name: migration.published(spark, folder, name)
    assert migration.current(spark, folder) == "one" and read("links").count() == 3
    again = migration.staged(spark.createDataFrame(mapping, "large_ext_id string, small_ext_id string"), read("sources"), read("details"), read("links"))
    before = {n: sorted(map(tuple, read(n).collect()), key=str) for n in ("sources", "details", "links")}
    assert migration.publish(again, folder, "two") and migration.current(spark, folder) == "two"
    assert {n: sorted(map(tuple, read(n).collect()), key=str) for n in before} == before


def test_empty_tables(spark):
    assert by_key(run(spark, [("l1", "s")], spark.createDataFrame([], LINK).collect())) == {}
