"""Collocations, URL rules and fill-in-middle against plain Python, on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tickharbor.llm.collocations import WordIndex, collocations, phrase_counts
from tickharbor.llm.fill_middle import fill_in_middle, restore
from tickharbor.llm.url_filters import DEFAULT, PATTERN_RULES, SITE_RULES, judge_urls, rule_index, rules_of

RANDOM = random.Random(11)


# ---- collocations -----------------------------------------------------------------------------


def phrases_of(rows, longest=4):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            own = re.findall("[^ \t]+", piece)
            words[lang] += len(own)
            for n in range(1, longest + 1):
                counts.update((lang, tuple(own[i : i + n])) for i in range(len(own) - n + 1))
    return counts, words


def plain_collocations(rows, support=30, top=2000):
    counts, totals = phrases_of(rows)
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= support}
    out = []
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((int(Fraction(2_000_000 * a, left + right)), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= 80 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), b in candidates.items()
        )
        if not inside:
            out.append((lang, " ".join(words), a, left, right, totals[lang], score))
    ranked = []
    for lang in {row[0] for row in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked.extend((lang, rank, *row[1:]) for rank, row in enumerate(own, 1))
    return sorted(ranked)


@pytest.fixture(scope="module")
def prose():
    stock = ["new york", "the", "of the", "state of the art", "Été", "à la carte", "a,b", "end.\nnext", "\u00a0x", "rare"]
    rows = []
    for i in range(400):
        text = " ".join(RANDOM.choice(stock) if RANDOM.random() < 0.8 else f"w{RANDOM.randrange(900)}" for _ in range(30))
        rows.append((RANDOM.choice(["en", "en", "fr", None, "und"]), RANDOM.choice([text, text.upper(), text.replace(" ", "\t ")])))
    rows += [(None, None), ("en", ""), ("xx", "one two"), ("en", "ab " * 30_000), ("fr", "?!.,"), *[rows[0]] * 40]
    return rows


def test_collocations_against_plain_counts(spark, prose):
    docs = spark.createDataFrame([(i, *row, 1, 2, "x") for i, row in enumerate(prose)], "doc_id int, lang string, text string, n int, rank int, phrase string")
    found = sorted(tuple(row) for row in collocations(docs.repartition(5)).collect())
    expected = plain_collocations(prose)
    assert len(expected) > 50 and found == expected


def test_collocations_do_not_depend_on_the_screen(spark, prose):
    """A screen so small that everything passes gives the same phrases."""
    docs = spark.createDataFrame(prose, "lang string, text string")
    whole = {tuple(r) for r in phrase_counts(docs).collect()}
    assert whole == {tuple(r) for r in phrase_counts(docs, bits=6).collect()}
    counts, totals = phrases_of(prose)
    expected = {(lang, " ".join(words), len(words), n) for (lang, words), n in counts.items() if n >= 30}
    assert whole == expected | {(lang, "", 0, n) for lang, n in totals.items() if n}


def test_collocations_keep_the_first_of_each_language(spark, prose):
    docs = spark.createDataFrame(prose, "lang string, text string")
    found = sorted(tuple(row) for row in collocations(docs, top=7).collect())
    assert found == plain_collocations(prose, top=7)


def test_no_documents_have_no_collocations(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations(docs).count() == 0
    assert collocations(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_index_intervals_hold_every_occurrence(seed):
    """Each phrase found by extension, on whatever side, has the count and the place of plain counting."""
    rng = np.random.default_rng(seed)
    symbols = rng.integers(0, 5, 400)
    symbols[[0, -1]] = 0
    symbols = np.unique(symbols, return_inverse=True)[1]
    index = WordIndex(symbols)
    for sides in (["right", "right", "right"], ["left", "left", "left"], ["right", "left", "right"], ["left", "right", "left"]):
        phrases = index.words()
        for length, side in enumerate(sides, 2):
            phrases = index.extended(phrases, side)
            windows = [tuple(symbols[i : i + length]) for i in range(len(symbols) - length + 1)]
            plain = Counter(w for w in windows if 0 not in w)
            found = [tuple(row) for row in index.symbols(phrases, length)]
            assert dict(zip(found, phrases.count)) == plain and len(found) == len(plain)


# ---- URL rules ----------------------------------------------------------------------------------


def plain_verdict(url, sites=SITE_RULES, patterns=PATTERN_RULES):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match("[^/?#]*", rest).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), raw)
        path = re.match("[^?#]*", rest[len(raw) :]).group()
    fits = []
    for rule, verdict in sites:
        own, _, tail = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + tail):
            fits.append((-len(rule), rule, verdict))
    if fits:
        return host, path, min(fits)[1], min(fits)[2], None
    for rule, verdict in sorted(patterns, key=lambda r: (-len(r[0]), r[0])):
        if re.search(f"(^|[^a-z0-9]){rule.strip('^')}([^a-z0-9]|$)", host + path, re.I | re.A):
            return host, path, None, verdict, rule
    return host, path, None, DEFAULT, None


URLS = [
    None, "", "no scheme org/", "://", "http://", "http://org", "http://ORG/", "http://org?x", "http://xorg/", "http://a.example.ORG/es/x",
    "http://a.example.org/ES/x", "http://example.org/en/1", "http://example.org/en/12#top", "http://example.org/en/2", "http://b.com/fr/",
    "http://b.com/fr", "http://b.com/de/q?casino", "https://www.cheap-pills.net/a", "https://net/Casino", "https://net/casinos", "https://x.net/a/POKER-porn",
    "https://x.net/\u212apoker", "ftp://x.net/\nxxx\n", "x://y://org/de/", "http://.org/", "http://com/de/\u00e9", "http://a.net/" + "a/" * 20_000 + "warez",
]


def test_urls_against_plain_rules(spark):
    rows = [(i, url, "h", "p") for i, url in enumerate(URLS)] + [(None, URLS[9], "h", "p")] * 3
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string").repartition(4)
    found = sorted((tuple(row) for row in judge_urls(pages).collect()), key=repr)
    assert found == sorted(((row[0], *plain_verdict(row[1])) for row in rows), key=repr)
    assert judge_urls(pages.where("false")).count() == 0


def test_many_rules_run_only_where_their_rarest_token_stands(spark):
    sites = [(f"h{i % 40}.example.net/p{i}/", "block" if i % 3 else "allow") for i in range(400)] + [("example.net/", "allow")]
    urls = [f"http://www.h{RANDOM.randrange(60)}.example.net/p{RANDOM.randrange(400)}/x" for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = rules_of(spark, sites)
    found = {row.page_id: (row.rule, row.verdict) for row in judge_urls(pages, rules).collect()}
    assert found == {i: plain_verdict(url, sites)[2:4] for i, url in enumerate(urls)}
    tokens = spark.createDataFrame([("example",)] * 9 + [("net",)] * 9 + [("h1",)] * 5 + [("p41",)], "token string")
    index = {row.rule: row.token for row in rule_index(tokens, rules).collect()}
    assert len(index) == len(sites) + len(PATTERN_RULES)
    assert index["h1.example.net/p41/"] == "p41" and index["example.net/"] == "example"


def test_rules_without_a_literal_token_see_every_url(spark):
    rules = rules_of(spark, [], [("a*z", "block"), ("^ok^", "allow")])
    pages = spark.createDataFrame([(1, "http://xx.net/abcz1"), (2, "http://xx.net/ok"), (3, "http://xx.net/b")], "page_id bigint, url string")
    found = {row.page_id: (row.pattern, row.verdict) for row in judge_urls(pages, rules).collect()}
    assert found == {1: ("a*z", "block"), 2: ("^ok^", "allow"), 3: (None, "allow")}


# ---- fill-in-middle -------------------------------------------------------------------------------


def plain_rearrangement(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "\n", "\n\n", "one", "one\n", "é日本\n🙂\r\nx\u2028y\n", "has <M> in it\n", "<\nS>\nP>\n<", "a\n" * 50_000, "b" * 300_000]


@pytest.mark.parametrize("rate, suffix_first", [(100, 50), (40, 50), (100, 0), (0, 50)])
def test_fill_in_middle_against_plain_cuts(spark, rate, suffix_first):
    rows = [(i * 10 + j, text) for i, text in enumerate(TEXTS) for j in range(6)] + [(None, "x\ny\nz"), (None, "x\ny\nz"), (5, None)]
    docs = spark.createDataFrame([(*row, "clash", 3) for row in rows], "doc_id bigint, text string, form string, n int")
    out = fill_in_middle(docs, rate=rate, suffix_first=suffix_first).collect()
    assert sorted((tuple(row)[:6] for row in out), key=repr) == sorted(((row[0], *plain_rearrangement(*row, rate, suffix_first)) for row in rows), key=repr)
    assert Counter(row.restored for row in out) == Counter(text or "" for _, text in rows)
    assert all(row.restored == restore(row.output, row.form) for row in out)
    assert fill_in_middle(docs.where("false")).count() == 0


def test_units_may_be_words(spark):
    docs = spark.createDataFrame([(i, "some words in a row") for i in range(20)], "doc_id bigint, text string")
    out = fill_in_middle(docs, unit=r"\w+\W*").collect()
    assert {row.n for row in out} == {5} and {row.restored for row in out} == {"some words in a row"}
    assert {row.form for row in fill_in_middle(docs, unit=r"\d").collect()} == {"plain"}
