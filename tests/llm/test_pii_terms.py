"""Disclosing terms against plain counts over whole texts."""

from __future__ import annotations

import math
import random
import re

from tickharbor.llm.pii import DISCLOSURE, MIN_DOCUMENTS, base_spans, protected_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RANDOM = random.Random(3)


def expected(texts):
    words = [{m[0].lower() for m in WORD.finditer(t)} for t in texts]
    holders, documents = {}, {}
    for i, text in enumerate(texts):
        for kind, a, b in base_spans(text):
            holders.setdefault(f"{kind}:{text[a:b].lower()}", set()).add(i)
        for w in words[i]:
            documents.setdefault(w, set()).add(i)
    terms = set()
    for own in holders.values():
        for w in {w for i in own for w in words[i]}:
            both = len(own & documents[w])
            if both >= MIN_DOCUMENTS and len(own) < len(texts):
                told = 1 - math.log(both / len(documents[w])) / math.log(len(own) / len(texts))
                if told >= DISCLOSURE:
                    terms.add(w)
    out = []
    for text in texts:
        base = base_spans(text)
        marks = [m.span() for m in WORD.finditer(text) if m[0].lower() in terms]
        marks = [(a, b) for a, b in marks if not any(a < h and b > l for _, l, h in base)]
        out.append(",".join([f"{k}:{a}:{b}" for k, a, b in base] + [f"term:{a}:{b}" for a, b in marks]))
    return out


def test_terms_of_whole_texts_are_marked_in_every_document(spark):
    filler = [f"é{i}" for i in range(40)]
    texts = [" ".join(RANDOM.choices(filler, k=30)) for _ in range(200)]
    for i in range(5):  # far from the address, short, of digits alone, and repeated
        texts[i] = f"mail Jo.Bo@x.org {texts[i]} Ulf met Zork 90817; zork, Wy {texts[i]} ulf"
    texts[5] += " Ulf and 90817 without the address"
    texts[6] += " wy"
    found = {r.doc_id: r.spans for r in protected_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    want = expected(texts)
    assert [found[i] for i in range(len(texts))] == want
    assert want[5].count("term:") == 2 and want[6].count("term:") == 1 and want[0].count("term:") >= 6
