"""Encoding, hard negatives and spelling variants against the library or brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import bpe_trie, hard_negatives, spelling
from seqloom.llm.queries import QUERIES
from conftest import sentence

ODD = "abehtsn  \n\t'’éß漢字🙂١٢½²ªǅ́\x85\xa0​ \x1c\x1fİıſ0199.,-_𝒜͸Ᲊ"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(bpe_trie.VOCABULARY))


def odd_texts(n):
    rng = random.Random(7)
    made = ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "it's we'LL  \n\n x", "\x00￿\U0010ffff"]
    for _ in range(n):
        own = "".join(rng.choice(ODD) for _ in range(rng.randrange(30)))
        made.append(own + "<|endoftext|>" * (rng.random() < 0.1) + own[:2])
    made += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 70))) for _ in range(n)]
    return made


def test_encoding_is_the_library_s(library):
    own = bpe_trie.codec()
    texts = odd_texts(3000) + [sentence(random.Random(1), 3000)]
    got = [ids for k in range(0, len(texts), 100) for ids in own.encode(texts[k : k + 100])]
    for text, ids in zip(texts, got, strict=True):
        known = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == known, repr(text)
        assert own.decode(ids) == library.decode(known, skip_special_tokens=False) == text


def test_any_ids_decode_as_the_library_does(library):
    rng = np.random.default_rng(3)
    for _ in range(500):
        ids = rng.integers(0, 50257, 6).astype(np.int32)
        assert bpe_trie.codec().decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_very_long_words(library):
    rng = random.Random(5)
    for text in ("a" * 150_000, " " * 150_000, "ab" * 50_000, "".join(rng.choice("abcdefghij") for _ in range(150_000))):
        began = time.process_time()
        ids = bpe_trie.codec().encode([text])[0]
        assert time.process_time() - began < 20
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_encoding_after_the_trie_is_dropped(library, monkeypatch):
    monkeypatch.setattr(bpe_trie, "MOST_NODES", 50)
    monkeypatch.setattr(bpe_trie, "MOST_PAIRS", 20)
    own = bpe_trie.Codec(bpe_trie.codec().path)
    for text in odd_texts(200):
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_documents(spark, docs, corpus, empty, library, monkeypatch):
    clashing = docs.withColumns({"ids": F.lit("x"), "decoded": F.lit(1), "_text": F.lit(2)})
    coded = bpe_trie.encode_documents(clashing, ["doc_id", "ids", "key", "decoded", "_text"])
    assert coded.columns == ["doc_id", "key", "_text", "ids", "decoded"]
    got = {r.doc_id: r for r in coded.collect()}
    assert len(got) == len(corpus)
    for i, text, _, _ in corpus:
        assert got[i].ids == library.encode(text or "", add_special_tokens=False).ids
        assert got[i].decoded == (text or "")
    assert bpe_trie.encode_documents(empty, ["doc_id"]).count() == 0
    twice = spark.createDataFrame([(1, "same"), (1, "same"), (None, "same")], "doc_id bigint, text string")
    assert len({tuple(r.ids) for r in bpe_trie.encode_documents(twice, ["doc_id"]).collect()}) == 1


def test_encoding_query(spark, docs, corpus, library):
    folder = docs.inputFiles()[0].split("/documents.parquet")[0]
    got = {r.doc_id: r for r in QUERIES["op11_bpe_trie"](spark, folder).collect()}
    for i, text, _, _ in corpus:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def brute_negatives(rows):
    """Whole numbers throughout; rows are (vec_id, embedding, label)."""
    own = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        moved = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        own.append((vec_id, moved, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    last = 1 << 70
    out = []
    for a, (anchor, label, vector) in enumerate(own):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), last if i is None else i, same == label) for k, (i, same, v) in enumerate(own) if k != a]
        scored.sort()
        for less, positive, _ in [s for s in scored if s[2]][:5]:
            inside = [s for s in scored if not s[2] and 30 * -less <= 100 * -s[0] <= 90 * -less][:10]
            for rank, (other, negative, _) in enumerate(inside, 1):
                out.append((anchor, None if positive == last else positive, rank, None if negative == last else negative, -less, -other))
    return Counter(out)


VECTORS = "vec_id bigint, embedding array<float>, label int, uid string, slot int, score string, vector string"


def vectors(spark, rows, parts=3):
    """The rows with columns named like those of the operator."""
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], VECTORS).repartition(parts)


@pytest.mark.parametrize("pieces", [(256, 8192), (2, 7)])
def test_hard_negatives(spark, monkeypatch, pieces):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.integers(-3, 4, 6) / 10 + (0.1, 0, 0, 0, 0, 0)).tolist(), int(rng.integers(0, 4))) for k in range(-200, 500)]
    rows += [(k, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0], 1) for k in range(500, 560)]  # ties, one common vector and label
    rows += rows[200:203] + rows[300:303]  # repeated rows, anchors among them
    rows += [(600, None, 1), (700, [0.1] * 6, None), (800, [0.1, None, 0.2], 2), (900, [0.1, float("nan"), 0.2], 2)]
    rows += [(1000, [float("inf")] * 6, 3), (None, [0.3] * 6, 2), (None, [0.3] * 6, 1), (1100, [], 1), (1200, [0.5, 0.4], 9), (1201, [0.2] * 9, 9)]
    monkeypatch.setattr(hard_negatives, "PIECE_ANCHORS", pieces[0])
    monkeypatch.setattr(hard_negatives, "PIECE_ROWS", pieces[1])
    if pieces[0] == 2:  # many groups of anchors
        monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 300)
    got = Counter(tuple(r) for r in hard_negatives.mine(vectors(spark, rows)).collect())
    assert got == brute_negatives(rows)
    assert len(got) > 100


def test_hard_negatives_of_large_components(spark):
    rng = np.random.default_rng(8)
    for size in (2.0**18, 2.0**20):  # beyond exact floating point, still within whole numbers of 64 bits
        rows = [(k, (rng.standard_normal(3) * size).tolist(), int(rng.integers(0, 3))) for k in range(120)]
        got = Counter(tuple(r) for r in hard_negatives.mine(vectors(spark, rows)).collect())
        assert got == brute_negatives(rows)
    rows = [(k, [1e30 * (1 + k % 3), 1.0], k % 2) for k in range(110)]
    assert hard_negatives.mine(vectors(spark, rows)).filter("rank > 10").count() == 0


def test_hard_negatives_without_rows_or_positives(spark):
    assert hard_negatives.mine(vectors(spark, [(5, [1.0], 1)]).filter("false")).count() == 0
    assert hard_negatives.mine(vectors(spark, [(100, [1.0], 1), (3, [0.5], 2)])).count() == 0


def edits(word, letters):
    made = {word[:k] + word[k + 1 :] for k in range(len(word))}
    made |= {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in letters}
    made |= {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in letters}
    return made - {word}


def brute_variants(counts, ratio=10, min_count=2):
    words = {w: n for w, n in counts.items() if n >= min_count}
    letters = sorted({c for w in words for c in w})
    forms, out = {}, {}
    for w, n in words.items():
        near = sorted((-words[v], v) for v in edits(w, letters) if v in words)
        form = near[0][1] if near and -near[0][0] >= ratio * n else None
        forms[w] = form
        out[w] = [form, None, n, len(near), -near[0][0] if form else None]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def brute_counts(rows):
    counts = Counter()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(fold)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return counts


def test_word_counts(spark, empty, monkeypatch):
    rng = random.Random(2)
    letters = "abÀÖßéÿ÷×Z"
    rows = [(k, " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 10))) for _ in range(60))) for k in range(80)]
    rows += [(1, None), (2, ""), (None, "abcdefgh ABCDEFGH"), (3, "123 漢字abcdefgh漢 ĀabcdefghĀ"), (4, "abcdefgh,abcdefgh\x00ÉABCDEFGh"), (4, "abcdefgh" * 20_000)]
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id bigint, text string, word string, n int").repartition(3)
    for most in (200_000, 50):
        monkeypatch.setattr(spelling, "MOST_WORDS", most)
        assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == brute_counts(rows)
    assert spelling.group_variants(spelling.word_counts(empty)).count() == 0


def test_variants(spark):
    rng = random.Random(3)
    counts = Counter()
    for _ in range(30):
        word = "".join(rng.choice("abé") for _ in range(rng.randrange(4, 8)))
        counts[word] += rng.choice([1, 5, 500])
        for v in rng.sample(sorted(edits(word, "abéz")), 12):
            counts[v] += rng.choice([1, 2, 3, 30, 50])
    for k, c in enumerate(["aaaaaaa", "aaaaaaaa", "aaaaaa", "aabbaab", "aabbab"]):  # runs of equal letters
        counts[c] += 10**k
    for k in range(18):  # a chain of forms
        counts["q" * (k + 8)] = 10**k * 2
    frame = spark.createDataFrame([*counts.items(), (None, 50)], "word string, n bigint")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(frame).collect()}
    assert got == brute_variants(counts)
    assert got["q" * 8][1] == "q" * 25


def test_a_group_as_large_as_the_alphabet(spark):
    """One skipped place that every letter fills: a long group, counted without its pairs."""
    rows = [("stem" + chr(0x4E00 + k) + "tail", 2 + k) for k in range(3000)]
    got = {r.word: r for r in spelling.group_variants(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert all(r.n_near == 2999 for r in got.values())
    assert got[rows[0][0]].form == rows[-1][0] and got[rows[-1][0]].form is None


def test_spelling_query(spark, tmp_path):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(["information", "Informations", "anderswo", "ándersen", "sieben", "siebens", "siebensX"]) for _ in range(200))) for k in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in QUERIES["op13_spelling_variants"](spark, str(tmp_path)).collect()}
    assert got == brute_variants(brute_counts(rows))
    assert any(v[0] for v in got.values())
