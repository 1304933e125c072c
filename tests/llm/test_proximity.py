"""Exact and proximity matches of benchmark windows against every run of words of every document."""

from __future__ import annotations

import random

import pytest

from tickharbor.llm.decontaminate import build_index, contamination, item_windows, window_matches

RANDOM = random.Random(11)
ITEM = "amber bronze copper dawn ember flint garnet harbor indigo jasper kelp".split()


def tables(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


def windows_of(words):
    return [words[i : i + 10] for i in range(len(words) - 9)] or ([words] if words else [])


def expected(docs, items, reach=15):
    """``{doc_id: (hit words, exact item ids, near item ids)}``, by trying everything."""
    out = {}
    for doc_id, text in docs:
        words = (text or "").split()
        hit, exact, near = set(), set(), set()
        for item_id, item in items:
            for window in windows_of((item or "").split()):
                for i in range(len(words) - len(window) + 1):
                    if words[i : i + len(window)] == window:
                        hit |= set(range(i, i + len(window)))
                        exact |= {str(item_id)}
                own = set(window)
                if any(len(own & set(words[i : i + reach])) >= len(own) - len(own) // 5 for i in range(len(words))):
                    near |= {str(item_id)}
        out[doc_id] = (len(hit), sorted(exact), sorted(near))
    return out


def found(spark, docs, items):
    rows = contamination(*tables(spark, docs, items)).collect()
    return {r.doc_id: (r.n_hit, r.item_ids, r.near_item_ids) for r in rows}


def edited():
    """The first ten words of the item: as they are, with words replaced, reordered, spread out, cut in two."""
    ten = ITEM[:10]
    turned = RANDOM.sample(ten, 10)
    spread = [w for i, word in enumerate(ten) for w in ([word, f"s{i}"] if i % 2 else [word])]
    wide = [w for i, word in enumerate(ten) for w in (word, f"t{i}", f"u{i}")]
    two = [w if i not in (2, 7) else f"r{i}" for i, w in enumerate(ten)]
    three = [w if i not in (2, 5, 7) else f"r{i}" for i, w in enumerate(ten)]
    around = [f"x{i}" for i in range(20)]
    texts = [around + own + around for own in (ten, turned, spread, wide, two, three, ten[:5] * 4)]
    return [" ".join(t) for t in texts]


def test_edited_passages(spark):
    docs = list(enumerate(edited()))
    got = found(spark, docs, [(1, " ".join(ITEM))])
    assert got == expected(docs, [(1, " ".join(ITEM))])
    assert [bool(got[i][2]) for i in range(7)] == [True, True, True, False, True, False, False]
    assert [got[i][0] for i in range(7)] == [10, 0, 0, 0, 0, 0, 0]


def test_a_match_does_not_depend_on_the_other_documents(spark):
    """Replaced words that another document of the segment holds, or none does; matches end at document bounds."""
    alone = edited()[4]
    docs = [(0, alone), (1, " ".join(ITEM[2:8])), (2, " ".join(ITEM[:4])), (3, " ".join(ITEM[4:10]))]
    got = found(spark, docs, [(1, " ".join(ITEM))])
    assert got[0] == found(spark, docs[:1], [(1, " ".join(ITEM))])[0] == (0, [], ["1"])
    assert got[2][2] == got[3][2] == []


@pytest.mark.parametrize("seed", range(2))
def test_random_texts_against_every_run(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(18)] + ["the"] * 6
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 14])))) for i in range(12)] + [(99, None)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(60)] + [(60, None), (61, items[3][1])]
    docs += [(62 + i, "a b " + item + " the the " + item) for i, (_, item) in enumerate(items[:12])]
    assert found(spark, docs, items) == expected(docs, items)


def test_windows_in_shares_and_segments(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices([f"w{k}" for k in range(25)], k=12))) for i in range(9)]
    docs = [(i, items[i % 9][1] + " " + " ".join(rng.sample(items[i % 7][1].split(), 12))) for i in range(40)]
    texts, own = tables(spark, docs, items + [(None, items[0][1]), (0, items[0][1])])
    index, windows = build_index(texts, segment_words=60), item_windows(own)
    every = sorted(map(tuple, window_matches(index, windows).collect()), key=str)
    assert every and every == sorted(map(tuple, window_matches(index, windows, together=4).collect()), key=str)


def test_empty_benchmark_and_empty_texts(spark):
    docs = [(1, "a b c"), (2, None)]
    assert found(spark, docs, []) == {1: (0, [], []), 2: (0, [], [])}
    assert found(spark, [], [(1, "a b")]) == {}
