"""Cross-tokenizer alignment against whole-text encoding and a byte-by-byte count of overlaps."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wordlens.llm import alignment
from wordlens.llm.queries import align_paths

SCHEMA = "chunk int, doc_id bigint, text string, pairs string, row string"
COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def corpus():
    rng = random.Random(3)
    bits = ["the", "Straße", "l'été", "don't", "x", "1234", "!!", "ǅ", "é", "<|endoftext|>", "漢字", "a\x1cb", "</s>", "ing", "<0x41>",
            "naïve", "🙂", "foo.bar", " ", "ﬁn"]
    gaps = [" ", " ", " ", "\n", "  ", "\t", "\n ", " \n", "\r\n", " "]
    rows = []
    for i in range(80):
        text = "".join(rng.choice(bits) + rng.choice(gaps[:4] if i % 2 else gaps) for _ in range(rng.choice([0, 1, 5, 60, 400])))
        rows.append((1, i, text.rstrip() if i % 3 else text, "p", "r"))
    rows += [(None, None, None, None, None), (1, 200, "", "", ""), (1, 201, " ", "", ""), (1, 202, "\n", "", ""), (1, 203, "a▁b", "", ""),
             (1, 204, " lead", "", ""), (1, 205, "trail ", "", ""), (1, None, "null id", "", ""), rows[5], rows[5],
             (1, 206, "word and line\n" * 30_000, "", ""), (1, 207, "x" * 5000, "", ""), (1, 208, "a \x00 b", "", "")]
    return rows


def brute(rows):
    a_path, b_path = align_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    back = alignment.byte_level_alphabet()
    done, counts = [], Counter()
    for _, d, text, *_ in rows:
        ta, tb = [], []
        if text:
            ta = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
            for i in b.encode(text):
                p = b.id_to_piece(i)
                tb.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
            raw = (" " + text).encode()
            if b"".join(x for _, x in ta) != raw or b"".join(x for _, x in tb) != raw:
                ta, tb = [], []
        own_a = [i for i, (_, x) in enumerate(ta) for _ in x]
        own_b = [i for i, (_, x) in enumerate(tb) for _ in x]
        links = [(ta[i][0], tb[j][0]) for i, j in dict.fromkeys(zip(own_a, own_b))]
        counts.update(links)
        ends = [k for k in range(len(own_a)) if k + 1 == len(own_a) or (own_a[k] != own_a[k + 1] and own_b[k] != own_b[k + 1])]
        parts, at = [], 0
        for k in ends:
            side = lambda own, t: ",".join(str(t[i][0]) for i in dict.fromkeys(own[at:k + 1]))  # noqa: B023, E731
            parts.append(side(own_a, ta) + "|" + side(own_b, tb))
            at = k + 1
        done.append((d, len(ta), len(tb), len(ends), links, hashlib.sha256(";".join(parts).encode()).hexdigest() if ta else ""))
    best = defaultdict(int)
    for (x, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(d, na, nb, ng, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), s)
            for d, na, nb, ng, ls, s in done]


key = lambda t: tuple((x is None, x or 0) for x in t[:7]) + (t[7],)


@pytest.mark.parametrize("chunk", [alignment.CHUNK_BYTES, 700])
def test_equals_a_count_of_bytes(spark, chunk):
    """The smaller chunk cuts most texts into parts."""
    rows = corpus()
    got = alignment.align(spark.createDataFrame(rows, SCHEMA).repartition(3), *align_paths(), chunk_bytes=chunk)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows), key=key)


def test_a_full_store_starts_anew(spark, monkeypatch):
    store = alignment.Segments(*align_paths())
    monkeypatch.setattr(alignment, "KNOWN_SEGMENTS", 10)
    texts = [" ".join(f"word{i}x{j}" for j in range(8)) for i in range(20)]
    for t in texts:
        numbers = store.numbers([t])[0]
        ids, _ = store.tokens("a", numbers)
        assert ids.tolist() == store.a.encode(" " + t, add_special_tokens=False).ids
        assert len(store.known) <= 18


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), *align_paths()).count() == 0


def test_vocabularies_allow_parting():
    store = alignment.Segments(*align_paths())
    assert store.parted and store.lines and public_tokenizers.path("byte_bpe_50k.json") == align_paths()[0]
