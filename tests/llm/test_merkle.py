"""Document fingerprints: edits, order of documents, likeness."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from wordlens.llm import merkle

SCHEMA = "fingerprint string, doc_id bigint, text string, role int"


def tree(text):
    return merkle.trees(pa.array([text], pa.string()))[0]


def corpus(n=80):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdé漢") for _ in range(rng.randrange(1, 7)))
    rows = []
    for i in rng.sample(range(1000), n):
        lines = [" ".join(word() for _ in range(rng.choice([0, 1, 8, 40]))) for _ in range(rng.choice([0, 1, 3, 30]))]
        rows.append(("f", i, rng.choice(["\n", "\n\n"]).join(lines), 1))
    return rows + [("f", 2000, None, 1), ("f", 2001, "", 1), ("f", None, "last of all\n" * 5, 1), rows[5], rows[5], ("f", rows[5][1], "same id", 1)]


def brute(spark, rows):
    # the order among rows of one id is that of the text's hash
    order = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    order = sorted(order, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    texts = [r.text or "" for r in order]
    out = []
    for i, (r, t) in enumerate(zip(order, texts)):
        nxt = texts[(i + 1) % len(texts)]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, b, c = tree(t), tree(edited), tree(nxt)
        out.append((r.doc_id, len(t), hashlib.sha256(edited.encode()).hexdigest(), a[0], b[0], merkle.likeness(a, b), merkle.likeness(a, c)))
    return out


key = lambda t: tuple((x is None, x or 0) for x in t)


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_matches_brute_force(spark, parts):
    rows = corpus()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = merkle.edited_likeness(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got), key=key) == sorted(brute(spark, rows), key=key)


def test_roots_and_edits():
    rng = random.Random(1)
    lines = [" ".join(f"w{rng.randrange(500)}" for _ in range(12)) for _ in range(200)]
    text = "\n".join(lines)
    a = tree(text)
    assert a[0] == tree(text)[0] and merkle.likeness(a, tree(text)) == 1.0 and merkle.differing(a[0], tree(text)[0]) == []
    lines[77] = "changed " + lines[77]
    b = tree("\n".join(lines))
    assert a[0][:16] != b[0][:16] and 0.98 < merkle.likeness(a, b) < 1
    paragraphs = [p for _, ps in merkle.parse(b[0]) for p in ps]
    places = [(i, j) for i, (_, ps) in enumerate(merkle.parse(b[0])) for j in range(len(ps))]
    assert [places.index(x) for x in merkle.differing(a[0], b[0])] == [77] and len(paragraphs) == 200
    assert merkle.likeness(a, tree("nothing alike")) == 0 and merkle.likeness(tree(""), tree("")) == 1


def test_half_kept_is_about_half_alike():
    rng = random.Random(2)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(3000))
    t, n = text(), text()
    edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
    assert 0.45 < merkle.likeness(tree(t), tree(edited)) < 0.55


def test_one_document_and_none(spark):
    one = merkle.edited_likeness(spark.createDataFrame([("", 1, "ab\ncd", 1)], SCHEMA)).collect()
    assert [(r.n_chars, r.near_next, r.edited_sha256) for r in one] == [(5, 1.0, hashlib.sha256(b"ab\nab").hexdigest())]
    assert merkle.edited_likeness(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_tree(text):
    """(fingerprint, its pieces with lengths) by the rules of the module's docstring, letter by letter."""
    import re

    import plain_hashes as ph

    data = text.encode()
    if not data:
        return "0" * 16 + "|", Counter()
    cuts = {0, len(data)} | {i + 1 for i, c in enumerate(data) if c == 10}
    cuts |= {m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data) if ph.of_bytes(m[0]) % merkle.PIECE == 0}
    cuts = sorted(cuts)
    sections, paragraphs, pieces, every = [], [], [], Counter()
    digests = []
    for a, b in zip(cuts, cuts[1:]):
        piece = data[a:b]
        points = sum(c & 0xC0 != 0x80 for c in piece)
        pieces.append((ph.of_bytes(piece), points, piece))
        every[pieces[-1][0] & 0xFFFFFFFF, points] += 1
        if piece[-1:] == b"\n" or b == len(data):
            digest = ph.of_sequence([p[0] for p in pieces])
            blank = b"".join(p[2] for p in pieces) == b"\n"
            paragraphs.append((digest, ",".join(f"{h & 0xFFFFFFFF:08x}{n}" for h, n, _ in pieces)))
            pieces = []
            if blank or digest % merkle.SECTION == 0 or b == len(data):
                digests.append(ph.of_sequence([p[0] for p in paragraphs]))
                sections.append(f"{digests[-1] & 0xFFFFFFFF:08x}:" + ";".join(p[1] for p in paragraphs))
                paragraphs = []
    return f"{ph.of_sequence(digests):016x}|" + "/".join(sections), every


def plain_likeness(a, b):
    if a[0][:16] == b[0][:16]:
        return 1.0
    whole = sum(n * c for t in (a, b) for (_, n), c in t[1].items())
    return 2 * sum(n * c for (_, n), c in (a[1] & b[1]).items()) / whole


def test_fingerprints_and_likeness_by_plain_rules(spark):
    rows = corpus(40)
    order = sorted(spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "xxhash64(text) AS h").collect(),
                   key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    texts = [r.text or "" for r in order]
    want = []
    for i, (r, t) in enumerate(zip(order, texts)):
        following, half = texts[(i + 1) % len(texts)], len(t) // 2
        a, b, c = (plain_tree(x) for x in (t, t[:len(t) - half] + following[:half], following))
        want.append((r.doc_id, a[0], b[0], plain_likeness(a, b), plain_likeness(a, c)))
    got = merkle.edited_likeness(spark.createDataFrame(rows, SCHEMA)).select(
        "doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
