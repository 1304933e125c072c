import pytest

from tickharbor.jobs import main
from tickharbor.operators.inventory import CompactionCheckFailed
from tickharbor.session import build_session

from .helpers import append, data_files, ticks


@pytest.fixture
def raw(spark, base):
    for second in range(3):
        append(ticks(spark, [("A", 1.0, 1, f"2025-08-10 01:00:0{second}")]), f"{base}/raw")
    return f"{base}/raw"


def test_compact_then_summarise(spark, raw, base, capsys):
    roots = ["--raw", raw, "--compacted", f"{base}/compacted"]
    snapshots = ["--snapshots", f"{base}/snap"]
    main(["compact", *roots, *snapshots, "--partitions", "year=2025,month=08", "--strict"])
    assert sum(data_files(f"{base}/compacted").values()) == 1
    main(["summary", *roots, "--out", f"{base}/summary"])
    assert "|A     |3" in capsys.readouterr().out
    main(["diff", "--a", f"{base}/snap/before", "--b", f"{base}/snap/after", "--out", f"{base}/diff"])
    assert "removed|    3" in capsys.readouterr().out
    assert spark.read.parquet(f"{base}/diff").count() == 4
    with pytest.raises(CompactionCheckFailed, match="1 failures"):
        main(["compact", *roots, *snapshots, "--partitions", "year=1999", "--report", f"{base}/kept"])
    assert [r.status for r in spark.read.parquet(f"{base}/kept/report").collect()] == ["missing"]


def test_compaction_of_the_run_day(spark, raw, base):
    roots = ["--raw", raw, "--compacted", f"{base}/compacted", "--snapshots", f"{base}/snap"]
    main(["compact", *roots, "--run-date", "2025-08-10", "--max-file-bytes", "512", "--report", f"{base}/kept"])
    (row,) = spark.read.parquet(f"{base}/kept/report").collect()
    assert row.files_wanted > 1 and 1 <= row.files_after <= row.files_wanted and row.rows_after == 3


def test_submitted_settings_are_kept(spark):
    given = spark.sparkContext.getConf()
    build_session(conf={"spark.sql.files.maxPartitionNum": "77"})
    assert spark.conf.get("spark.sql.files.maxPartitionNum") == "77"
    build_session()
    assert given.contains("spark.sql.files.maxPartitionNum") or spark.conf.get("spark.sql.files.maxPartitionNum") == "200000"


def test_inventory_with_snapshot(spark, raw, base, capsys):
    main(["inventory", "--root", raw, "--out", f"{base}/inv"])
    assert "year=2025" in capsys.readouterr().out
    assert spark.read.parquet(f"{base}/inv").count() == 3
