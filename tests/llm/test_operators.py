"""Operators of the llm package on small texts: nulls, empties, repeats, clashing columns, brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from tokenizers import Tokenizer

from tickharbor.llm import queries
from tickharbor.llm.bpe import bpe_encode
from tickharbor.llm.decontaminate import contamination
from tickharbor.llm.language import held_out_languages
from tickharbor.llm.line_dedup import without_shared_lines
from tickharbor.llm.near_dedup import near_duplicates
from tickharbor.llm.pii import base_spans, generalised, protected_spans
from tickharbor.llm.quality import quality_report
from tickharbor.llm.substring_dedup import without_repeats
from tickharbor.llm.toxicity import held_out_scores
from tickharbor.llm.warc import LoserTree, archive_and_index

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row bigint"
RANDOM = random.Random(4)
LONG = " ".join(RANDOM.choice(["alpha", "beta", "gamma", "delta"]) + str(i % 700) for i in range(30_000))
TEXTS = [None, "", " \n\t", "short", LONG, LONG, "the same line of text here, long enough\nand more", "é ñ ß 日本 " * 30]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", None, 0.5, 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (None, "no id at all here", None, None, 1, None, None), rows[3]], SCHEMA)


def by_id(df):
    return {row.doc_id: row for row in df.collect()}


def test_every_operator_takes_odd_rows_and_empty_tables(spark, docs):
    labels = spark.createDataFrame([(3, 0), (4, 1), (None, None)], "doc_id bigint, toxic int")
    items = spark.createDataFrame([(1, "and more"), (2, None), (None, "short")], "item_id bigint, text string")
    operators = [
        quality_report, near_duplicates, without_repeats, protected_spans, held_out_languages, without_shared_lines,
        lambda d: bpe_encode(d, queries.vocabulary_path()),
        lambda d: held_out_scores(d, labels),
        lambda d: contamination(d, items),
    ]
    for operator in operators:
        assert operator(docs).count() == 10
        assert operator(docs.where("false")).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(RANDOM.choices(words, k=RANDOM.choice([3, 12, 60, 150]))) for _ in range(40)]
    for text in list(texts):
        own = text.split()
        for _ in range(3):
            own[RANDOM.randrange(len(own))] = "changed"
            texts.append(" ".join(own))
    found = by_id(near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")))

    def shingles(text):
        own = text.split()
        return {tuple(own[i : i + 5]) for i in range(max(len(own) - 4, 1))}

    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert [found[i].component_id for i in range(len(texts))] == label


@pytest.mark.parametrize("members", [16_384, 1])
def test_repeats_against_all_windows(spark, members):
    base = "".join(RANDOM.choices("abcdefgh ", k=3_000))
    texts = [base, base[200:900] + "#" + base[1200:1650], "x" * 900, base[:399], base[100:1300].replace("a", "é"), base]
    got = by_id(without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), group_members=members))
    data = [t.encode() for t in texts]
    seen: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - 399):
            seen[d[i : i + 400]] = seen.get(d[i : i + 400], 0) + 1
    for i, d in enumerate(data):
        gone = {k for j in range(len(d) - 399) if seen[d[j : j + 400]] > 1 for k in range(j, j + 400)}
        assert got[i].kept == bytes(b for k, b in enumerate(d) if k not in gone)
        assert got[i].n_removed == len(gone)


def test_phrases_against_windows(spark):
    docs = ["a b C d e f g h i j k l", "x a b c d e f g h i", "one two", "a b c d e f g h i j a b c d e f g h i j", None]
    items = [(7, "A b c d e f g h i j k"), (10, "one, two"), (8, "")]
    found = by_id(contamination(
        spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    ))
    assert [(found[i].n_words, found[i].n_hit, found[i].item_ids) for i in range(5)] == [
        (12, 11, ["7"]), (10, 0, []), (2, 2, ["10"]), (20, 20, ["7"]), (0, 0, [])
    ]


def test_bpe_equals_the_library(spark):
    library = Tokenizer.from_file(queries.vocabulary_path())
    texts = ["<|endoftext|> Hi<|startoftext|>", "ΑΣ İstanbul it's WE'VE 12 ½", "日本😀", "x" * 3000, "", "a\x1cb\x85c"]
    found = by_id(bpe_encode(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), queries.vocabulary_path()))
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert (found[i].ids, found[i].decoded) == (ids, library.decode(ids, skip_special_tokens=False))


def test_base_spans_against_patterns():
    pieces = ["a", "b.", "@", ".", "1", "255", "256", "+1", "-", " ", "x.y@z.w", "4111 1111 1111 1111", "(", "é", "1.2.3.4"]
    for _ in range(3_000):
        text = "".join(RANDOM.choices(pieces, k=RANDOM.randrange(14)))
        mails = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        assert [s[1:] for s in base_spans(text) if s[0] == "email"] == mails
    assert generalised("mail a@b.cd now", "email:5:11") == "mail [EMAIL] now"


def test_archives(spark):
    big = "WARC/1.1\r\n\r\n" * 20
    rows = [(5, "http://a.b/c", big), (2, None, big), (3, "http://b.a/", None), (None, "x\r\ny", "é"), (4, "http://a.b/c", "s")]
    out = archive_and_index(spark, spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    found = {r.page_id: r for r in out.collect()}
    assert (found[5].record_type, found[5].refers_to, found[2].record_type) == ("revisit", 2, "response")
    assert found[5].payload_digest == hashlib.sha256(big.encode()).hexdigest()
    assert found[3].payload_bytes == 0 and found[None].payload_bytes == 2


def test_loser_tree_merges_any_number_of_runs():
    for k in range(6):
        runs = [sorted((RANDOM.choice("abc"), "t", RANDOM.randrange(5), "", "", 0, "", f"r{i}", n) for n in range(i * 3)) for i in range(k)]
        assert [r[:3] for r in LoserTree(runs)] == sorted(r[:3] for run in runs for r in run)
