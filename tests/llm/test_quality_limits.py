"""Documents that pass the base rule and that one limit of the method alone rejects."""

from __future__ import annotations

from tickharbor.llm.quality import LINE_LIMIT, NGRAM_LIMITS, quality_report


def words(low, n):
    return [f"w{i:04}" for i in range(low, low + n)]


def repeating(n, times, total):
    """``total`` words of five characters, in which a phrase of ``n`` stands so many times."""
    out, fresh = [], 1000
    for _ in range(times):
        out += words(0, n) + words(fresh, 4)
        fresh += 4
    return " ".join(out + words(fresh, total - len(out)))


def test_each_limit_rejects_what_the_base_rule_passes(spark):
    shapes = {5: (3, 48), 6: (2, 42), 7: (2, 53), 8: (2, 62), 9: (2, 74), 10: (2, 88)}
    texts = {n: repeating(n, times, total) for n, (times, total) in shapes.items()}
    line = " ".join(words(0, 4))
    texts[1] = "\n".join([line, " ".join(words(100, 6)), line, " ".join(words(200, 6))])
    texts[2] = " ".join(words(0, 80))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r for r in quality_report(docs).collect()}
    for n in NGRAM_LIMITS:
        r = found[n]
        over = [k for k, limit in NGRAM_LIMITS.items() if r[f"gram_chars_{k}"] > limit * r.word_chars]
        assert (over, r.base_failed, r.kept) == ([n], False, False)
    assert found[1].line_chars > LINE_LIMIT * found[1].word_chars
    assert (found[1].base_failed, found[1].kept, found[2].kept) == (False, False, True)


def test_symbols_are_counted_and_decide_nothing(spark):
    text = " ".join(f"w{i:04}#$%" for i in range(40))
    (row,) = quality_report(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert (row.n_symbols, row.base_failed, row.kept) == (120, False, True)
