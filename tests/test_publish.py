"""Publishing: whole parts only, and nothing twice."""

import datetime
import os

import pytest

from pageloom.catalog.archives import write_archives, write_lines
from pageloom.operators.profile import dedupe_by_ip
from pageloom.streaming import addresses, ledger, publish, upkeep


@pytest.fixture()
def crawl(spark, tmp_path):
    pages = spark.range(40).selectExpr(
        "concat('http://h', id, '/') AS host",
        "concat('10.', id % 3, '.0.', id % 5) AS ip",
        "'nginx' AS server",
        "concat('<script src=/l', id, '.js></script>') AS html",
    )
    paths = write_archives(pages.repartition(4), str(tmp_path / "archives"))
    blocks = spark.createDataFrame([("10.0.0.0/16", 1), ("10.1.0.0/16", 2)], "network string, geoname_id int")
    locations = spark.createDataFrame([(1, "One"), (2, "Two")], "geoname_id int, country_name string")
    names = [os.path.basename(p) for p in paths]
    manifests = str(tmp_path / "manifests")
    write_lines(f"{manifests}/warc_part_001_2024.txt", names[:2])
    write_lines(f"{manifests}/warc_part_002_2024.txt", names[2:3] + ["gone.warc"])
    outputs = publish.Outputs(str(tmp_path / "out"))

    def make(blocks=blocks):
        root = str(tmp_path / "archives")
        return publish.Publisher(spark, outputs, blocks, locations, "2024", archive_root=root)

    return names, manifests, outputs, make


def hosts(spark, outputs):
    rows = publish.published(spark, publish.read_features(spark, outputs), outputs).collect()
    return sorted(r.host for r in rows)


def test_parts_are_published_whole_and_once(spark, crawl):
    names, manifests, outputs, make = crawl
    make().run(manifests).awaitTermination()
    first = hosts(spark, outputs)
    assert 0 < len(first) < 40 and len(set(first)) == len(first)
    status = {r.part: r for r in ledger.ledger_status(ledger.read(spark, outputs.ledger)).collect()}
    assert status["warc_part_001"].status == "success" and status["warc_part_001"].n_tasks == 2
    assert status["warc_part_002"].status == "failed" and "gone.warc" in status["warc_part_002"].error

    # Nothing new: nothing happens. A new manifest: only that one is worked on.
    make().run(manifests).awaitTermination()
    assert hosts(spark, outputs) == first
    write_lines(f"{manifests}/warc_part_003_2024.txt", names[2:])
    make().run(manifests).awaitTermination()
    assert len(hosts(spark, outputs)) == 40


def test_replay_of_a_part_changes_nothing(spark, crawl):
    _, manifests, outputs, make = crawl
    manifest = f"{manifests}/warc_part_001_2024.txt"
    make().publish([manifest])
    first = hosts(spark, outputs)
    geo = publish.read_geo(spark, outputs).count()
    make().publish([manifest], batch_id=1)
    assert hosts(spark, outputs) == first
    assert publish.published(spark, publish.read_geo(spark, outputs), outputs).count() == geo
    assert ledger.read(spark, outputs.ledger).count() == 4


def test_failing_replay_leaves_the_part_readable(spark, crawl):
    _, manifests, outputs, make = crawl
    manifest = f"{manifests}/warc_part_001_2024.txt"
    make().publish([manifest])
    first = hosts(spark, outputs)
    broken = spark.createDataFrame([("10.0.0.0/16", 1)], "network string, geoname_id int")
    make(broken.selectExpr("network", "CAST(raise_error('no lookup') AS int) AS geoname_id")).publish([manifest], batch_id=1)
    assert first and hosts(spark, outputs) == first
    status = ledger.ledger_status(ledger.read(spark, outputs.ledger)).first()
    assert status.status == "failed" and "no lookup" in status.error


def test_failed_second_task_hides_the_part_until_it_is_repaired(spark, crawl):
    _, manifests, outputs, make = crawl
    manifest = f"{manifests}/warc_part_001_2024.txt"
    broken = spark.createDataFrame([("10.0.0.0/16", 1)], "network string, geoname_id int")
    publisher = make(broken.selectExpr("network", "CAST(raise_error('no lookup') AS int) AS geoname_id"))
    publisher.publish([manifest])
    tasks = {r.task: r.status for r in ledger.read(spark, outputs.ledger).collect()}
    assert tasks == {"script": "success", "geo": "failed"}
    assert hosts(spark, outputs) == []
    make().publish([manifest])
    assert len(hosts(spark, outputs)) > 0
    geo = publish.published(spark, publish.read_geo(spark, outputs), outputs)
    assert geo.select("ip").distinct().count() == geo.count()
    assert {r.country_name for r in geo.collect()} <= {"One", "Two", None}


def test_part_names():
    assert publish.part_of("/x/warc_part_001_2024.txt", "2000") == ("warc_part_001", "2024")
    assert publish.part_of("/x/warc_part_007.txt", "2000") == ("warc_part_007", "2000")
    assert publish.part_of("/x/odd", "2000") == ("odd", "2000")


def test_ledger_needs_both_tasks(spark):
    t = datetime.datetime(2024, 9, 1)
    later = t + datetime.timedelta(seconds=90)
    rows = [
        ("geo", "success", None, 0, t, later, "2024", "p1", "1"),
        ("script", "success", None, 0, t, later, "2024", "p1", "1"),
        ("geo", "success", None, 0, t, later, "2024", "p2", "1"),
        ("geo", "failed", "boom", 1, t, later, "2024", "p3", "1"),
        ("script", "success", None, 1, t, later, "2024", "p3", "1"),
        ("other", "success", None, 1, t, later, "2024", "p4", "1"),
        ("geo", "success", None, 1, t, later, "2024", "p4", "1"),
    ]
    table = spark.createDataFrame(rows, ledger.LEDGER_SCHEMA)
    status = {r.part: (r.status, r.error, r.seconds) for r in ledger.ledger_status(table).collect()}
    assert status == {
        "p1": ("success", None, 180.0),
        "p2": ("failed", None, 90.0),
        "p3": ("failed", "boom", 180.0),
        "p4": ("failed", None, 180.0),
    }
    assert {(r.status, r.n_parts) for r in ledger.ledger_summary(table).collect()} == {("success", 1), ("failed", 3)}


def test_a_batch_of_many_manifests_runs_a_fixed_number_of_jobs(spark, crawl):
    names, manifests, outputs, make = crawl
    jobs = []
    for count in (2, 12):
        paths = []
        for i in range(count):
            path = f"{manifests}/jobs/part_{count}_{i:03d}_2023.txt"
            write_lines(path, [names[i % len(names)]] + (["gone.warc"] if i == 1 else []))
            paths.append(path)
        group = f"jobs-{count}"
        spark.sparkContext.setJobGroup(group, group)
        make().publish(paths, batch_id=count)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[1] <= jobs[0] + 3  # a shuffle stage of adaptive execution may be a job of its own
    status = {(r.part, r.status) for r in ledger.ledger_status(ledger.read(spark, outputs.ledger)).collect()}
    assert {p for p, s in status if s == "failed"} == {"part_2_001", "part_12_001"}
    assert len(status) == 14


def listed(folder):
    return {os.path.join(base, f) for base, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}


def test_upkeep_changes_no_row(spark, crawl):
    _, manifests, outputs, make = crawl
    make().run(manifests).awaitTermination()
    make().publish([f"{manifests}/warc_part_001_2024.txt"], batch_id=7)
    rows = hosts(spark, outputs)
    geo = sorted(tuple(r) for r in publish.published(spark, publish.read_geo(spark, outputs), outputs).collect())
    at_work = publish.published(spark, publish.read_features(spark, outputs), outputs)  # a reader that has planned
    status = sorted(tuple(r) for r in ledger.ledger_status(ledger.read(spark, outputs.ledger)).collect())
    assert upkeep.compact(spark, outputs, file_bytes=1 << 30) == 1
    assert upkeep.compact(spark, outputs, file_bytes=1 << 30) == 0
    assert sorted(tuple(r) for r in ledger.ledger_status(ledger.read(spark, outputs.ledger)).collect()) == status
    before = listed(outputs.base)
    # nothing is old enough yet
    assert upkeep.clean_up(spark, outputs, datetime.timedelta(hours=1)) == [] and listed(outputs.base) == before
    assert sorted(r.host for r in at_work.collect()) == rows == hosts(spark, outputs)
    # two days later all attempts go but the one that is read: three of part 1, of which one failed part's attempt is another
    later = datetime.datetime.now(datetime.timezone.utc) + datetime.timedelta(days=2)
    gone = upkeep.clean_up(spark, outputs, datetime.timedelta(days=1), now=later)
    assert sorted({part for _, _, part in gone}) == ["warc_part_001", "warc_part_002"] and len(gone) == 3
    left = upkeep.layout(spark, outputs).collect()
    assert {(r.kind, r.part, r.n_attempts, r.n_files, r.n_read) for r in left} == {(k, "warc_part_001", 1, 1, 1) for k in ("features", "geo")}
    assert hosts(spark, outputs) == rows
    assert sorted(tuple(r) for r in publish.published(spark, publish.read_geo(spark, outputs), outputs).collect()) == geo
    assert upkeep.clean_up(spark, outputs, datetime.timedelta(days=1), now=later) == []


def test_a_newer_attempt_wins_over_compaction(spark, crawl, monkeypatch):
    names, manifests, outputs, make = crawl
    manifest = f"{manifests}/warc_part_001_2024.txt"
    make().publish([manifest])
    append = ledger.append

    def late(rows, path):
        """The part is published anew while compaction writes."""
        monkeypatch.setattr(ledger, "append", append)
        write_lines(manifest, names[:1])
        make().publish([manifest], batch_id=1)
        append(rows, path)

    full = hosts(spark, outputs)
    monkeypatch.setattr(ledger, "append", late)
    assert upkeep.compact(spark, outputs) == 1
    assert 0 < len(hosts(spark, outputs)) < len(full)


def test_addresses_follow_the_published_parts(spark, crawl, tmp_path):
    names, manifests, outputs, make = crawl
    kept = str(tmp_path / "kept")

    def want():
        rows = publish.published(spark, publish.read_features(spark, outputs), outputs)
        return sorted(tuple(r) for r in dedupe_by_ip(rows.select("ip", "host", "server")).collect())

    def got():
        return sorted(tuple(r) for r in addresses.addresses(spark, kept).collect())

    for i, name in enumerate(names):
        write_lines(f"{manifests}/more/part_{i:03d}_2024.txt", [name])
        make().publish([f"{manifests}/more/part_{i:03d}_2024.txt"], batch_id=i)
        assert addresses.merge_published(spark, outputs, kept) == 1
        assert got() == want()
    assert addresses.merge_published(spark, outputs, kept) == 0
    whole = want()
    addresses.merge(spark, kept, publish.read_features(spark, outputs))  # merged again: nothing changes
    assert got() == whole
    reader = addresses.addresses(spark, kept)
    assert addresses.fold(spark, kept, files=1) > 0 and got() == whole  # all files are young, so all stay
    assert sorted(tuple(r) for r in reader.collect()) == whole
    later = datetime.datetime.now(datetime.timezone.utc) + datetime.timedelta(days=2)
    count = len(listed(kept))
    assert addresses.fold(spark, kept, files=1, now=later) > 0
    assert got() == whole and len(listed(kept)) < count


def test_a_merge_reads_only_the_slots_it_meets(spark, tmp_path):
    kept = str(tmp_path / "kept")
    rows = spark.range(5_000).selectExpr("concat('10.0.', id % 20, '.', id % 250) AS ip", "concat('h', id) AS host", "CAST(NULL AS string) AS server")
    addresses.merge(spark, kept, rows)
    one = spark.createDataFrame([("10.0.1.1", "a", None), ("10.0.1.1", "h1", "x"), (None, "b", "y")], "ip string, host string, server string")
    before = listed(kept)
    addresses.merge(spark, kept, one)
    assert len(listed(kept) - before) == 2  # a better host for one address, and rows without an address
    got = {r.ip: (r.host, r.server) for r in addresses.addresses(spark, kept).collect()}
    assert got["10.0.1.1"] == ("a", None) and got[None] == ("b", "y")
