"""The filter audit against SQL (test_operators), all orders by hand, and on odd input."""

import re
from itertools import permutations

import numpy as np

from wordkin.llm import audit


def fails_by_hand(text, is_copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {x for x, bad in zip("ABCDE", [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                                          bool(re.search("[#$%&*|]", text)), is_copy], strict=True) if bad}


def audit_by_hand(rows, labels):
    """``rows``: doc_id, text, lang; ``labels``: doc_id, quality, toxic."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    ids = {}
    for d, t, _ in rows:
        if d is not None:
            ids.setdefault(t or "", []).append(d)
    docs = [(d, lang or "", fails_by_hand(t or "", d is not None and d > min(ids[t or ""]))) for d, t, lang in rows]
    out = {}
    for part in {p for _, p, _ in docs}:
        mine = [(d, f) for d, p, f in docs if p == part]
        removed_in_all = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                removed_in_all[x] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(x in f for _, f in mine) - len(gone), sum(f == {x} for _, f in mine),
                                          sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_in_all[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_ranks_are_lexicographic():
    assert ["".join("ABCDE"[i] for i in order) for order in audit.orders(5)] == ["".join(p) for p in permutations("ABCDE")]
    for prefix, begin, end in audit.prefixes(4):
        begins_so = [tuple(order[:len(prefix)]) == prefix for order in audit.orders(4)]
        assert np.flatnonzero(begins_so).tolist() == list(range(begin, end))


def test_audit(spark):
    words = " ".join(f"w{i}" for i in range(120))
    long = " ".join(f"w{i}" for i in range(200_000))
    texts = [None, "", " \t\n", words, words + " X" * 40, words + " #", "SHOUT " * 130, words, long, long + " |", words.upper(), "a&b", "é \x85" * 60, words + "\x0b"]
    rows = [(i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(texts)]
    # repeated rows, copies in another part, rows without id, copies of these
    rows += [(3, words, "en"), (7, words, None), (40, words, "fr"), (41, words, "fr"), (None, words, "fr"), (None, "solo", "fr"), (50, "solo", "fr"), (51, "solo", "en")]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, 0), (4, None, 1), (40, 1, None), (41, 1, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame([(*r, "z", 5, 1, True) for r in rows], "doc_id bigint, text string, lang string, hash string, mask int, n int, good boolean")
    marks = spark.createDataFrame([(*r, "k") for r in labels], "doc_id bigint, quality int, toxic int, key string")
    got = audit.audit_filters(docs.repartition(5), marks)
    assert result(got) == audit_by_hand(rows, labels)
    assert got.where("substr(filter_order, step, 1) <> filter").count() == 0
    assert audit.audit_filters(docs.limit(0), marks).count() == 0
    assert result(audit.audit_filters(docs, marks.limit(0))) == audit_by_hand(rows, [])


def test_copies_are_few_rows(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot text', concat('t', id % 7)) AS text", "'en' AS lang")
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    counts = audit.count_masks(docs, labels)
    assert counts.agg({"n": "sum"}).first()[0] == 20_000 and counts.count() <= 4
    assert counts.where("mask >= 16").agg({"n": "sum"}).first()[0] == 20_000 - 8
