"""The order of capture histories, with the join of record types not broadcast."""

from __future__ import annotations

from tickharbor.llm.warc import _capture, archive_and_index


def test_histories_are_ordered_without_broadcast(spark):
    rows = [(i, f"http://h{i * 7 % 11}.org/p{i % 5}", f"payload {i % 20} " * 20) for i in range(600)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = archive_and_index(spark, spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(found) == 600 and sum(r.record_type == "revisit" for r in found) == 580
    assert all(r.refers_to == r.page_id % 20 for r in found if r.record_type == "revisit")
    order = [_capture(tuple(r)) for r in found]
    assert order == sorted(order)
