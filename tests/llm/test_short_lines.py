"""Short lines that many sites share."""

from __future__ import annotations

from tickharbor.llm.line_dedup import without_shared_lines


def test_short_boilerplate_goes_and_blank_lines_stay(spark):
    rows = [(s, f"own text {s}\n\nAll rights reserved.\n 返回首页\nfoot {s}", f"s{s}") for s in range(8)]
    rows += [(8 + s, f"Few sites\nother {s}", f"s{s}") for s in range(7)]
    found = {r.doc_id: r for r in without_shared_lines(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert found[0].n_removed == 0 and found[0].text == rows[0][1]
    for s in range(1, 8):
        assert (found[s].n_removed, found[s].text) == (2, f"own text {s}\n\nfoot {s}")
    assert not any(found[8 + s].n_removed for s in range(7))
