"""Spelling variants against SQL (test_operators), brute force, and on odd input."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordkin.llm import fmindex, spelling


def words_by_hand(rows):
    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def groups_by_hand(words):
    form, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in words if is_near(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    root = {}
    for w in words:
        root[w] = w
        while form[root[w]] is not None:
            root[w] = form[root[w]]
    return {w: (form[w], root[w], n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def by_word(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def random_words(letters, n, longest, seed=1):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n)})


@pytest.mark.parametrize(("letters", "n", "longest"), [("a", 9, 12), ("ab", 300, 9), ("abcdeé÷ÿ", 900, 8), ("ab\U0001F389", 300, 6)])
def test_search_schemes(letters, n, longest):
    words = random_words(letters, n, longest)
    index = fmindex.Vocabulary(words)
    rows = [(i, same, *half) for i, w in enumerate(words) for same, m in ((True, len(w)), (False, len(w) - 1)) if m > 0
            for half in ((m // 2, m + 1, True), (0, m // 2, False))]
    one, two = index.one_error(*(np.array(c) for c in zip(*rows, strict=True)))
    got = [frozenset((words[a], words[b])) for a, b in zip(one, two, strict=True)]
    want = {frozenset((a, b)) for a in words for b in words if is_near(a, b) and min(len(a), len(b)) > 0}
    assert len(got) == len(set(got)) and set(got) == want


def test_both_directions_agree():
    words = random_words("abc", 200, 7)
    index = fmindex.Vocabulary(words)
    text = "$" + "$".join(words) + "$"
    rng = random.Random(2)
    for _ in range(200):
        at = rng.randrange(len(text))
        pattern = text[at:at + rng.randint(1, 5)]
        code = {"$": fmindex.DELIMITER, **{x: i + fmindex.FIRST_LETTER for i, x in enumerate("abc")}}
        low = high = middle = rng.randint(0, len(pattern))
        found = index.everything(1)
        while low > 0 or high < len(pattern):
            if high == len(pattern) or low > 0 and rng.random() < 0.5:
                low -= 1
                found = index.extend_left(found, np.array([code[pattern[low]]]))
            else:
                found = index.extend_right(found, np.array([code[pattern[high]]]))
                high += 1
        suffixes = sorted(range(len(text)), key=lambda i: [code[x] for x in text[i:]])
        hits = [rank for rank, i in enumerate(suffixes, 1) if text.startswith(pattern, i)]
        assert found.size[0] == len(hits) and found.lo[0] == hits[0], (pattern, middle)


def test_groups(spark):
    rng = random.Random(4)
    words = {w: rng.randint(3, 60) for w in random_words("abcd", 700, 7) if len(w) >= 5}
    # long words, equal letters, a chain of forms, ties
    words |= {"x" * 4000: 9, "x" * 4001: 4, "x" * 2000 + "y" + "x" * 1999: 3, "mmmmm": 4, "mmmmmm": 8, "mmmmmmm": 16, "tieaa": 3, "tiebb": 3, "tieab": 7, "tieba": 7}
    table = spark.createDataFrame([(w, n, "x", 1) for w, n in words.items()], "word string, n bigint, key string, block int")
    want = groups_by_hand(words)
    assert want["mmmmm"][1] == "mmmmmmm" and want["tieaa"][0] == "tieab"
    assert by_word(spelling.group_spellings(table)) == want
    # small blocks; groups so small that nearly all of them are divided
    assert by_word(spelling.group_spellings(table, block_rows=50, group_rows=4)) == want


def test_a_hot_half_is_divided(spark):
    # two thirds of the words begin alike: groups stay bounded, and so do the rows
    words = spark.range(3000).selectExpr("concat(if(id % 3 < 2, 'commonbeginning', 'o'), translate(lpad(hex(id * 7919 % 65536), 5, '0'), '0123456789ABCDEF', 'abcdefghijklmnop')) AS word", "id + 3 AS n").persist()
    rows = spelling.refined(spelling.halves(words), 40)
    places = F.col("end") - F.col("begin")
    assert rows.where(places > 1).groupBy("key").count().agg(F.max("count")).first()[0] <= 40
    assert rows.count() <= words.count() * 4 * 8
    assert by_word(spelling.group_spellings(words, block_rows=500, group_rows=40)) == by_word(spelling.group_spellings(words))


def test_variants_of_odd_rows(spark):
    rng = random.Random(9)
    vocabulary = ["recieve", "receive", "colour", "color", "Größe", "GRÖSSE", "größe", "naïve", "naive", "x×y÷z", "Ångström", "ångstrom", "ſecret", "tion" * 3, "tionx" * 900]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(60)) + rng.choice(["", "\n", "-", "1"])) for i in range(60)]
    rows += [(None, "receive receive recieve"), (7, None), (8, ""), (9, "4711 #"), *rows[:5], (99, "receive " * 50_000)]
    docs = spark.createDataFrame([(*r, "w", 3) for r in rows], "doc_id bigint, text string, word string, n int")
    assert by_word(spelling.spelling_variants(docs.repartition(3))) == groups_by_hand(words_by_hand(rows))
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    assert spelling.spelling_variants(docs.where("doc_id in (7, 8, 9)").where("length(text) < 9 or text is null")).count() == 0
