"""The command line, metrics and scratch space."""

import json
import os

import pytest

from wordkin.__main__ import main
from wordkin.metrics import count_stages, observe_rows
from wordkin.storage import is_complete, pin, scratch_folder


def read_folder(path):
    files = sorted(f for f in os.listdir(path) if f.endswith(".txt"))
    return "".join(open(f"{path}/{f}", encoding="utf-8").read() for f in files)


def test_collocations_job(spark, tmp_path, capsys):
    (tmp_path / "in").write_text("a b\t1900\t5\t1\na c\t1905\t1\t1\nd c\t1901\t4\t1\nd b\t1902\t1\t1\nthe b\t1900\t9\t1\nbroken\n")
    (tmp_path / "stop").write_text("the\n")
    out = str(tmp_path / "out")
    main(["collocations", "-1.0", "1.0", "--input", str(tmp_path / "in"), "--stop-words", str(tmp_path / "stop"),
          "--output", out])
    lines = read_folder(f"{out}/decade=1900").splitlines()
    assert {line.rsplit("\t", 1)[0] for line in lines} == {"a\tb", "a\tc", "d\tc", "d\tb"}
    scores = [float(line.rsplit("NPMI:", 1)[1]) for line in lines]
    assert scores == sorted(scores, reverse=True)
    printed = capsys.readouterr().out
    # one N, two left and two right words
    counts = "lines 6, valid 5, kept 4, pairs 4, marginals 5, scored 4"
    assert counts in printed and "found 4" in printed
    again = ["collocations", "-1.0", "1.0", "--input", str(tmp_path / "in"), "--stop-words", str(tmp_path / "stop"), "--work-dir", str(tmp_path / "work")]
    for name in ("two", "three"):
        main([*again, "--output", str(tmp_path / name)])
        assert counts in capsys.readouterr().out and read_folder(f"{tmp_path / name}/decade=1900").splitlines() == lines
    (tmp_path / "in").write_text("a b\t1900\t5\t1\n")
    with pytest.raises(ValueError):
        main([*again, "--output", str(tmp_path / "four")])


def test_reviews_job(spark, tmp_path, capsys):
    (tmp_path / "in.json").write_text(json.dumps(
        {"title": "t", "reviews": [{"id": "1", "link": "a&b", "text": "Good Ann.", "rating": 1}]}) + "\n")
    (tmp_path / "lexicon").write_text("good\t1\n")
    (tmp_path / "names").write_text("Ann\tPERSON\n")
    out = str(tmp_path / "out")
    main(["reviews", str(tmp_path / "in.json"), "report", "--lexicon", str(tmp_path / "lexicon"),
          "--gazetteer", str(tmp_path / "names"), "--output", out])
    assert json.loads(read_folder(f"{out}/json/out=report")) == {"processedEntries": [
        {"link": "a&b", "color": "LIGHT_GREEN", "namedEntities": ["Ann"], "isSarcastic": True}]}
    assert "products 1, quarantined 0" in capsys.readouterr().out
    html = read_folder(f"{out}/html/report=report")
    assert 'href="a&amp;b"' in html and "Named Entities: [Ann]" in html and "Detection: Sarcastic" in html


def test_paths_come_in_pairs(spark):
    with pytest.raises(SystemExit):
        main(["reviews", "a", "b", "c", "--lexicon", "l", "--gazetteer", "g", "--output", "o"])


def test_counts(spark):
    df, seen = observe_rows(spark.range(7), "seven")
    df.collect()
    assert seen.get["rows"] == 7
    got = count_stages({"all": spark.range(5), "odd": spark.range(5).where("id % 2 = 1")}).collect()
    assert [tuple(r) for r in got] == [("all", 5), ("odd", 2)]


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared)
    pinned = pin(spark.range(3), "x", first)
    assert is_complete(spark, f"{first}/x") and not is_complete(spark, second)
    assert pinned.count() == 3
