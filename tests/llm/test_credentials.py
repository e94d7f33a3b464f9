"""Secret scans: patterns by hand, automata on known grammars, held-out credentials, odd input."""

import hashlib
import random
import re

import numpy as np

from wordkin.llm import automata, credentials
from wordkin.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
KEY = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""


def base_by_hand(text):
    """The three patterns, read a character at a time."""
    out = []
    at = 0
    while at < len(text):
        m = re.compile(KEY + r"""["']?[ ]*[:=][ ]*["']?""").match(text, at)
        n = len(re.compile("[A-Za-z0-9+/_.=-]*").match(text, m.end())[0]) if m else 0
        if not n:
            at += 1
            continue
        out += [(at, 0, m.end() + n)] * (n >= 8)
        at = m.end() + n
    for kind, start, more, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), (2, "", "0123456789abcdef", 32)):
        at = 0
        while at < len(text):
            end = at + len(start)
            while text.startswith(start, at) and end < len(text) and text[end] in more:
                end += 1
            if not text.startswith(start, at) or end == at + len(start):
                at += 1
                continue
            out += [(at, kind, end)] * (end - at >= least)
            at = end
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))


def spans(text):
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end, _ in credentials.base_spans(text))


def test_patterns():
    rng = random.Random(3)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", "APIKEY", "=", ":", " ", "  ", '"', "'", "abcdef", "0123456789", "AKIA", "AKIAX", "ABCDEFGH1234", "é", "ſecret", "toKen", "f" * 33, "-", ".", "\n", "\t"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert spans(text) == base_by_hand(text), text
    assert spans("password: api_key: abcdefgh12") == "" and spans("token=token=abcdefghijk") == "assign:0:23"


def probability(automaton, string):
    data = np.frombuffer(string, np.uint8)
    return automaton.score(data, np.array([0]), np.array([len(data)]))[0]


def test_grammars_are_inferred():
    rng = random.Random(5)
    prefixed = [b"key-" + "".join(rng.choice("0123456789") for _ in range(rng.randint(6, 9))).encode() for _ in range(400)]
    strict = automata.infer(prefixed, strict=True)
    assert len(strict.end) < 20
    assert probability(strict, b"key-8301741") > -40 and probability(strict, b"kex-8301741") == -np.inf == probability(strict, b"key-83a1741")
    # the order of the strings makes no difference; probabilities of all strings add up to one
    assert (automata.infer(prefixed[::-1], strict=True).log == strict.log).all()
    coin = automata.infer([b"a" * n for n in range(6) for _ in range(2 ** (6 - n))], strict=True)
    assert abs(sum(np.exp(probability(coin, b"a" * n)) for n in range(200)) - 1) < 1e-9
    # one state per letter of a cycle, found back from the prefix tree
    repeats = np.random.default_rng(2).geometric(0.3, 2000)
    cycle = automata.infer([b"a1B" * n for n in repeats.tolist()], strict=True)
    assert probability(cycle, b"a1B" * 40) > -60 and probability(cycle, b"a1Ba") == -np.inf
    assert probability(automata.infer([]), b"x") < 0 and automata.infer([], strict=True).score(np.empty(0, np.uint8), np.empty(0, int), np.empty(0, int)).shape == (0,)


def test_scores_of_many_spans():
    rng = np.random.default_rng(1)
    model = automata.infer([bytes(rng.choice(list(b"ab1-"), rng.integers(1, 9)).astype(np.uint8)) for _ in range(300)])
    data = rng.choice(list(b"ab1-Z"), 500).astype(np.uint8)
    starts = rng.integers(0, 400, 200)
    ends = starts + rng.integers(0, 90, 200)
    want = []
    for a, b in zip(starts, ends, strict=True):
        state, total = 0, 0.0
        for symbol in data[a:b]:
            total, state = total + model.log[state, symbol], model.to[state, symbol]
        want.append(total + model.end[state])
    assert np.allclose(model.score(data, starts, ends), want)


def corpus(rng, n):
    """Texts with labelled credentials, and bare ones of the same formats that no pattern finds, with their places."""
    docs, bare = [], {}
    letters = "etaoinshrdlu"
    for d in range(n):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 16))) for _ in range(80)]
        words += [str(rng.randint(10 ** 15, 10 ** 16 - 1)), f"mail{rng.randint(0, 9)}.example.com", "VERYIMPORTANTNEWS"]
        text = " ".join(words) + " é "
        if d % 4 == 0:
            text += f"token = \"sk_{''.join(rng.choice('abcdefghijklmnopqrstuvwxyz0123456789') for _ in range(24))}\" "
        if d % 10 == 1:
            value = f"sk_{''.join(rng.choice('abcdefghijklmnopqrstuvwxyz0123456789') for _ in range(24))}"
            bare[d] = (len(text), len(text) + len(value))
            text += value
        docs.append((d, text))
    return docs, bare


def test_learned_formats(spark):
    rows, bare = corpus(random.Random(8), 1200)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = {r.doc_id: [(x.start, x.end) for x in r.found if x.kind == "format"] for r in credentials.scan_secrets(docs).collect()}
    caught = sum(found[d] == [place] for d, place in bare.items())
    assert caught >= 0.95 * len(bare)
    assert sum(bool(x) for d, x in found.items() if d not in bare) <= 2
    # the same formats from any partitioning, and none without labelled credentials
    one, other = (credentials.fit_formats(docs.repartition(n)) for n in (1, 9))
    assert (one.ordinary.log == other.ordinary.log).all() and (one.kinds["assign"].log == other.kinds["assign"].log).all()
    plain = credentials.scan_secrets(docs.where("doc_id % 4 <> 0")).collect()
    assert not any(r.found for r in plain)


def test_secrets_of_odd_rows(spark):
    long = "x " * 400_000 + "password=abcdefgh1" + " é" * 300_000 + " AKIA" + "Q7" * 8
    texts = [None, "", " ", "password=abcdefgh", "PASSWORD = 'abcdefgh'", long, "é" * 50 + "a1" * 20, "a" * 300_000, "password=abcdefgh"]
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)] + [(None, "token: 123456789", 1, "k"), (3, texts[3], 1, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start int, found string")
    got = credentials.scan_secrets(docs.repartition(4)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: ",".join(f"{x.kind}:{x.start}:{x.end}" for x in r.found if x.kind != "format") for r in got}
    assert all(by_id[d] == base_by_hand(t or "") for d, t, *_ in rows)
    assert credentials.scan_secrets(docs.limit(0)).count() == 0


def test_query(spark, tmp_path):
    planted = spark.createDataFrame([(10 ** 9, "é token = 'abcdefgh' AKIA" + "Z" * 16 + " " + "0f" * 20, "en", "s", 9)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(planted.select("doc_id", "text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = QUERIES["op13_secret_scan"](spark, str(tmp_path)).collect()
    assert len(got) == len(texts) and [(r.n_assign, r.n_access, r.n_hex) for r in got if r.doc_id == 10 ** 9] == [(1, 1, 1)]
    for r in got:
        base = base_by_hand(texts[r.doc_id])
        kept = ",".join(x for x in r.spans.split(",") if not x.startswith("format"))
        assert kept == base and r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k) for x in base.split(",")) for k in ("assign", "access", "hex")]
