"""License scan against a word-by-word search, and on edited notices."""

import random
import re

import pytest

from wordlens.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "template string, doc_id bigint, text string, label int"


def base(text):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for phrase, label in licences.BASE.items() for i in range(len(ws))
             if ws[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return (len(ws), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})))


def corpus():
    rng = random.Random(2)
    bits = ["MIT", "license", "Apache", "General", "public", "LICENSE", "mit", "É", "x1", "\x00", "public,", "l\x80", "K"]
    rows = [("t", i, rng.choice([" ", "-", "\n", "_"]).join(rng.choice(bits) for _ in range(rng.randrange(40))), 1) for i in range(150)]
    rows += [("t", 900, None, None), (None, None, "MIT License", 2), (None, None, "MIT License", 2), ("", 901, "", 1),
             ("", 902, "the MIT", 1), ("", 903, "...MIT-license", 1), ("", 904, "word " * 30_000 + "apache license", 1), rows[3], rows[3]]
    return rows


key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)


def test_base_phrases(spark):
    rows = corpus()
    got = licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(
        ((d, *base(t)) for _, d, t, _ in rows), key=key)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


@pytest.mark.parametrize("change,found", [("", True), ("insert", True), ("drop", True), ("half", False), ("shuffle", False)])
def test_edited_notices(spark, change, found):
    rng = random.Random(1)
    rows = []
    for n, (label, text) in enumerate(licences.NOTICES):
        ws = text.split()
        if len(ws) < 20:
            continue
        if change == "insert":
            ws[10:10] = ["or", "so"]
        elif change == "drop":
            del ws[8:10]
        elif change == "half":
            ws = ws[:len(ws) // 2]
        elif change == "shuffle":
            rng.shuffle(ws)
        rows.append((label, n, "Filler words here. " + " ".join(ws).upper() + ". More filler.", 0))
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all((label in got[n].labels.split(",")) == found for label, n, _, _ in rows)


@pytest.mark.parametrize("gap", ["", " and more. "])
def test_repeated_notices(spark, gap):
    """Copies of a notice in a row are one chain of diagonals, however many; each is found."""
    rows = [(label, 10 * n + k, gap.join([text + " "] * times), 0) for n, (label, text) in enumerate(licences.NOTICES)
            for k, times in enumerate([1, 2, 3, 50])]
    rows.append(("all-rights-reserved", 9000, "Copyright. All rights reserved!\n" * 1000, 0))
    half = licences.NOTICES[0][1].split()[:12]
    rows.append(("", 9001, " ".join(half * 40), 0))  # many beginnings are no whole notice
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for label, d, _, _ in rows:
        assert label in found[d].labels.split(",") and (d == 9001 or found[d].score == 1.0), (d, found[d])
    assert found[9001].labels == ""


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = licences.scan(spark.createDataFrame(corpus(), SCHEMA).coalesce(1))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
