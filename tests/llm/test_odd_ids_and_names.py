"""Rows without ids, ids and labels more than once, columns with the names that operators use."""

from __future__ import annotations

import random

from tickharbor.llm.line_dedup import without_shared_lines
from tickharbor.llm.pii import sanitised
from tickharbor.llm.substring_dedup import keyed, without_repeats
from tickharbor.llm.toxicity import labelled_rows

RANDOM = random.Random(5)


def letters(n):
    return "".join(RANDOM.choice("abcdefghij klmnopqrst") for _ in range(n))


def test_repeats_among_rows_without_ids_take_nothing_of_others(spark):
    a, others = letters(512), [letters(512) for _ in range(50)]
    docs = spark.createDataFrame([(None, text) for text in [a, a, *others]], "doc_id bigint, text string")
    assert dict(keyed(docs).dtypes)["text_key"] == "bigint"
    removed = sorted(row.n_removed for row in without_repeats(docs).collect())
    assert removed == [0] * 50 + [512, 512]


def test_an_anchor_of_many_places_is_counted_as_grouped(spark):
    core = letters(400)
    rows = [(i, f"{letters(300)}{core}{letters(300)}") for i in range(60)] + [(99, letters(900))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    grouped, counted = (
        {row.doc_id: row.n_removed for row in without_repeats(docs, group_members=members).collect()} for members in (16_384, 10)
    )
    # A few letters beside the passage may agree by chance.
    assert grouped == counted and grouped.pop(99) == 0 and all(400 <= n < 420 for n in grouped.values())


def test_shared_lines_with_clashing_columns(spark):
    rows = [(i, f"All rights reserved.\nown {i}", f"s{i}", 1, [2], "x", 5, 6) for i in range(9)]
    schema = "doc_id bigint, text string, source string, dropped_doc int, Dropped_Lines array<int>, new_text string, n_lines int, `a.b` int"
    out = without_shared_lines(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "text", "source", "dropped_doc", "Dropped_Lines", "new_text", "a.b", "n_lines", "n_removed"]
    found = {row.doc_id: row for row in out.collect()}
    assert found[0].n_removed == 0 and all(found[i].text == f"own {i}" and found[i].dropped_doc == 1 for i in range(1, 9))
    assert all(row.n_lines == 2 and row.new_text == "x" and row["a.b"] == 6 for row in found.values())


def test_sanitised_rows_stay_one_by_one(spark):
    rows = [(1, "mail a@b.cd", 1), (1, "call +44 20 7946 0958 now", 2), (1, "nothing", 3), (None, "ip 1.2.3.4", 4), (None, None, 5)]
    out = sanitised(spark.createDataFrame(rows, "doc_id bigint, text string, row_number int"))
    found = {row.row_number: row for row in out.collect()}
    assert out.columns == ["doc_id", "text", "row_number"] and len(found) == 5
    texts = [found[i].text for i in range(1, 6)]
    assert texts == ["mail [EMAIL]", "call [PHONE] now", "nothing", "ip [IP]", None]


def test_of_contradicting_labels_the_largest_counts(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(30)], "doc_id bigint, text string")
    both = [(i, i % 2) for i in range(30)] + [(i, 1 - i % 2) for i in range(30)] + [(3, None), (None, 1)]
    for order in (both, both[::-1]):
        labels = spark.createDataFrame(order, "doc_id bigint, toxic int")
        assert {row.label for row in labelled_rows(docs, labels).collect()} == {1}
