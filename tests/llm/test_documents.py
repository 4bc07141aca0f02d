"""Operators on documents against brute force, with nulls, empties, ties, repeats and clashing names."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqloom.llm import bytewords, decontaminate, language, licences, odd_sketch, packing, pii, stream_dedup, token_rollup, toxicity, url_rules
from seqloom.llm.common import Scratch
from seqloom.llm.components import components
from seqloom.llm.tokens import tokens


def test_exact_dedup(docs, corpus):
    got = {r.id: r for r in stream_dedup.exact_dedup(docs).collect()}
    groups = defaultdict(list)
    for i, t, _, _ in corpus:
        groups[t or ""].append(i)
    assert len(got) == len(corpus)
    for t, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), i == max(ids))
            assert r.digest == hashlib.sha256(t.encode()).hexdigest()


def test_exact_dedup_settles_equal_digests_by_bytes(docs, corpus):
    weak = stream_dedup.exact_dedup(docs, digest=lambda t: F.length(t).cast("string"))
    rows = {r.id: (r.keep_id, r.group_size, r.kept) for r in weak.collect()}
    sound = {r.id: (r.keep_id, r.group_size, r.kept) for r in stream_dedup.exact_dedup(docs).collect()}
    assert rows == sound


def test_exact_dedup_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.id, r.keep_id, r.group_size, r.kept) for r in stream_dedup.exact_dedup(docs).collect()]
    assert Counter(got) == Counter(
        [(1, 1, 3, True), (1, 1, 3, False), (None, 1, 3, False), (None, None, 2, True), (None, None, 2, False), (2, 3, 2, False), (3, 3, 2, True)]
    )


def test_state_goes_on_over_batches(docs, corpus):
    many = stream_dedup.exact_dedup(docs, files_per_batch=1)
    assert many.filter("kept").count() == len({t or "" for _, t, _, _ in corpus})


def test_keep_first_copies_keeps_columns(docs, empty):
    kept = stream_dedup.keep_first_copies(docs)
    assert kept.columns == docs.columns
    assert stream_dedup.keep_first_copies(empty).count() == 0


def shingle_set(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked_groups(rows):
    sets = {i: shingle_set(t) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def near(docs):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in odd_sketch.near_groups(docs).collect()}


def test_near_groups(docs, corpus, empty):
    assert near(docs) == linked_groups(corpus)
    assert odd_sketch.near_groups(empty).count() == 0


def test_near_groups_in_blocks(docs, corpus, monkeypatch):
    monkeypatch.setattr(odd_sketch, "PAIRS_PER_MEMBER", 0)
    monkeypatch.setattr(odd_sketch, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(odd_sketch, "ROUNDS", 1)
    assert near(docs) == linked_groups(corpus)


def test_blocks_of_near_copies_return_fewer_links_than_members():
    member = lambda k: {"node": k, "group": k, "bands": [0, k], "sketch": [0] * 4, "items": list(range(k % 7, 200))}
    kind = pa.list_(pa.struct([("node", pa.int64()), ("group", pa.int64()), *[(c, pa.list_(pa.int64())) for c in ("bands", "sketch", "items")]]))
    far = [{**member(900 + k), "items": list(range(1000 * (k + 1), 1000 * (k + 1) + 50))} for k in range(3)]
    one, two = [member(k) for k in range(60)] + far, [member(k) for k in range(60, 100)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0, 0, 0], pa.int32()), pa.array([one, two, one], kind), pa.array([None, None, two], kind)], names=["band", "x", "y"]
    )
    links = [p for b in odd_sketch._compare_blocks(iter([batch])) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    assert len(links) == 99
    reached, before = {0}, 0
    while len(reached) > before:
        before = len(reached)
        reached |= {x for p in links if reached & set(p) for x in p}
    assert reached == set(range(100))


def test_near_groups_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (9, "A B C D E F"), (9, "A B C D E F")], "doc_id bigint, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in odd_sketch.near_groups(docs).collect())
    assert got == Counter([(None, None, True), (4, 4, True), (9, 4, False), (9, 4, False)])
    kept = odd_sketch.keep_one_of_each(docs)
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 4), (True, None)]


def test_odd_sketch_estimates_similarity(spark):
    rng = np.random.default_rng(4)
    for share in (0.6, 0.75, 0.9):
        n = 4000
        pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        both = int(2 * n * share / (1 + share))
        x, y = pool[:n], np.concatenate((pool[:both], pool[n : 2 * n - both]))
        samples = odd_sketch.minhash(np.concatenate((x, y)), np.array([0, n]))
        sketch = odd_sketch.odd_sketches(samples)
        row = spark.createDataFrame([(sketch[0].tolist(), sketch[1].tolist())], "x array<long>, y array<long>")
        got = row.select(odd_sketch.estimate(F.col("x"), F.col("y")).alias("e")).first().e
        assert abs(got - share) < 0.2


def test_components(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 500), (502, 502), (0, 150)] + [(600, k) for k in range(601, 700)]
    got = {r.node: r.component for r in components(Scratch(spark), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {500: 500, 501: 500} | {k: 600 for k in range(600, 700)}
    assert components(Scratch(spark), spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_place():
    column = pa.array(["alpha beta gamma", None, "", "Beta alpha gamma alpha", "x" * 2_000_000 + " beta"])
    seen = defaultdict(set)
    for first, raw, bounds in bytewords.blocks(column):
        starts, ends, hashes, firsts = bytewords.words(raw, bounds, bytewords.NOT_SPACE)
        assert len(firsts) == len(bounds)
        for a, b, h in zip(starts, ends, hashes, strict=True):
            seen[bytes(raw[a:b]).lower()].add(int(h))
    assert {k: len(v) for k, v in seen.items() if len(k) < 9} == {b"alpha": 1, b"beta": 1, b"gamma": 1}


BENCHMARK = [(1, " ".join(f"b{k}" for k in range(30))), (2, "Short, item here."), (3, None), (4, ""), (None, "nobody asks for this one at all")]


def leak_corpus():
    passage = BENCHMARK[0][1].split()
    filler = " ".join(f"f{k}" for k in range(80))
    edited = passage[:3] + ["new"] + passage[3:]
    return [
        (0, f"{filler} {' '.join(passage)} {filler}"),
        (1, f"{filler} {' '.join(edited).upper()}!"),
        (2, filler),
        (3, f"{filler} {' '.join(passage[:15])} {filler}"),
        (4, "a SHORT item, here: yes"),
        (5, None),
        (6, ""),
        (None, " ".join(passage)),
    ]


def brute_leaks(rows, items):
    found = {}
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    for key, text in rows:
        for item, passage in items:
            w, p = cut(text), cut(passage)
            width = min(5, len(p))
            if item is None or not p:
                continue
            of = lambda x, n=width: [tuple(x[k : k + n]) for k in range(len(x) - n + 1)]
            doc, want = of(w), Counter(of(p))
            m = sum(want.values())
            for start in range(max(1, len(doc) - m + 1)):
                own = Counter(doc[start : start + m])
                shared = sum((own & want).values())
                if shared / max(1, sum(own.values()) + m - shared) >= 0.75:
                    found[(key, item)] = max(found.get((key, item), 0), shared / (sum(own.values()) + m - shared))
    return found


def test_leaks(spark):
    docs = spark.createDataFrame([(*r, "x") for r in leak_corpus()], "doc_id bigint, text string, key string")
    items = spark.createDataFrame(BENCHMARK, "item_id bigint, text string")
    rows = decontaminate.find_leaks(docs, items).collect()
    got = {(r.key if r.key >= 0 else None, r.item_id): r.similarity for r in rows}
    want = brute_leaks(leak_corpus(), BENCHMARK)
    assert want.keys() == {(0, 1), (1, 1), (4, 2), (None, 1)}
    assert got == pytest.approx(want)
    clean = decontaminate.drop_leaks(docs, items)
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 5, 6] and clean.columns == docs.columns
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.drop_leaks(docs, none).count() == len(leak_corpus())


def test_leaks_of_reordered_passages(spark):
    halves = [" ".join(f"{x}{k}" for k in range(20)) for x in "ab"]
    thirds = [" ".join(f"{x}{k}" for k in range(40)) for x in "cde"]
    filler = " ".join(f"f{k}" for k in range(100))
    items = [(1, " ".join(halves)), (2, " ".join(thirds)), (3, " ".join(halves[:1] * 2 + thirds[:1]))]
    turned = [" ".join(halves[::-1]), " ".join(thirds[::-1]), " ".join(thirds[:1] + halves[:1] * 2)]
    rows = [(k, f"{filler} {t} {filler}") for k, t in enumerate(turned)]
    rows += [(10, turned[0]), (11, f"{turned[1]} {filler}"), (12, f"{filler} {turned[2]}"), (13, f"{filler} {halves[1]} {filler} {halves[0]}")]
    rows += [(14, " ".join(turned[0].split()[2:])), (15, f"{filler} {' '.join(turned[1].split()[:50])} x y {' '.join(turned[1].split()[50:])}")]
    docs, asked = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.key, r.item_id): r.similarity for r in decontaminate.find_leaks(docs, asked).collect()}
    want = brute_leaks(rows, items)
    assert {(0, 1), (1, 2), (2, 3), (10, 1), (11, 2), (12, 3)} <= want.keys() and 13 not in {k for k, _ in want}
    assert got == pytest.approx(want)


def test_leaks_below_a_line_that_all_share(spark):
    line = " ".join(f"i{k}" for k in range(24))
    tail = lambda k: " ".join(f"t{k}x{j}" for j in range(16))
    items = [(k, f"{line} {tail(k)}") for k in range(40)]
    rows = [(k, f"p{k} {line} q{k} r{k} {' '.join(f'z{k}y{j}' for j in range(30))}") for k in range(200)]
    rows += [(1000 + k, f"before it {line} {tail(k)} and after") for k in range(5)]
    docs, asked = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.key, r.item_id): r.similarity for r in decontaminate.find_leaks(docs, asked).collect()}
    assert got == pytest.approx(brute_leaks(rows, items)) and set(got) == {(1000 + k, k) for k in range(5)}

    hits = decontaminate.shingled(docs.withColumnRenamed("doc_id", "key"), [5])
    hits = hits.select("key", "width", F.size("hashes").alias("size"), F.posexplode("hashes").alias("pos", "h"))
    occurs = decontaminate.shingled(asked, [5]).select("item_id", "width", F.size("hashes").alias("m"), F.explode("hashes").alias("h"))
    occurs = occurs.groupBy("item_id", "width", "m", "h").agg(F.count("*").alias("n"))
    rare = decontaminate.rare_shingles(hits, occurs)
    assert rare.count() <= 5 * 10
    held = {r.key for r in decontaminate.windows_around(hits, rare).select("key").distinct().collect()}
    assert held == {1000 + k for k in range(5)}


def test_leaks_of_repeated_shingles_and_short_documents(spark):
    rng = random.Random(4)
    items, rows = [], [(500, "x"), (500, "x y"), (501, None)]
    for k in range(30):
        own = [f"w{rng.randrange(6)}" for _ in range(rng.randrange(5, 40))] if k % 2 else [f"v{k}{j}" for j in range(rng.randrange(2, 40))]
        items.append((k, " ".join(own)))
        cut = own[rng.randrange(3) :]
        if cut:
            cut[rng.randrange(len(cut))] = "other"
        rows += [(k, " ".join(cut)), (100 + k, " ".join(["out"] * rng.randrange(50) + cut * 3)), (200 + k, " ".join(own * 2))]
        rows += [(300 + k % 3, " ".join(own)), (300 + k % 3, " ".join(own)), (None, " ".join(own))]
    docs, asked = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {}
    for r in decontaminate.find_leaks(docs, asked).collect():
        key = (r.key if r.key >= 0 else None, r.item_id)
        got[key] = max(got.get(key, 0), r.similarity)
    assert got == pytest.approx(brute_leaks(rows, items))


def test_leaks_in_a_very_long_text(spark):
    words = [f"n{k % 9001}" for k in range(200_000)]
    words[150_000:150_000] = BENCHMARK[0][1].split()
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "n1 " * 100_000)], "doc_id bigint, text string")
    got = decontaminate.find_leaks(docs, spark.createDataFrame(BENCHMARK, "item_id bigint, text string")).collect()
    assert [(r.key, r.item_id, r.start, r.similarity) for r in got] == [(1, 1, 150_000, 1.0)]


def test_leak_plan_runs_no_python(spark):
    docs = spark.createDataFrame(leak_corpus(), "doc_id bigint, text string")
    items = spark.createDataFrame(BENCHMARK, "item_id bigint, text string")
    plan = decontaminate.find_leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_tokens_match_the_reference():
    encode = tokens()
    for text in ("", "Hello  world\n\n x", "é ñ — 中文 ​", "a<|endoftext|>b", "x\x1c y\x85z", "don't   stop", " " * 50):
        assert encode.encode(text) == encode.reference(text)


def test_packing(docs, corpus, empty):
    rows = packing.pack_documents(docs, most=64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text, *_ in corpus:
        ids = tokens().reference(text or "")
        ids.append(2)
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 64)
        at = 0
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.piece == 0 or r.length == 64
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 64) + 2
    assert packing.pack_documents(empty).count() == 0


def test_fullest_combination_is_the_best_of_all():
    rng = np.random.default_rng(0)
    for _ in range(200):
        counts = {int(x): int(rng.integers(1, 4)) for x in rng.integers(1, 30, 5)}
        room = int(rng.integers(1, 60))
        sums = {0}
        for x, n in counts.items():
            sums = {s + k * x for s in sums for k in range(n + 1)}
        uses = packing.fullest(counts, room)
        assert all(n <= counts[x] for x, n in uses)
        assert sum(x * n for x, n in uses) == max(s for s in sums if s <= room)


def test_plan_uses_every_piece_once():
    histogram = {1024: 7, 700: 5, 324: 9, 100: 40, 1: 3}
    used = Counter()
    for times, parts in packing.plan(histogram):
        assert sum(x * n for x, n in parts) <= 1024
        for x, n in parts:
            used[x] += times * n
    assert used == histogram


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                yield kind, m.start(), m.end()


def test_personal_data_matches_the_patterns():
    rng = np.random.default_rng(6)
    machine = pii.automaton()
    for letters in ("a@.b-1 +", "12.3.4", "0123456789 -", "+1 ().-2a", "ab@@..c1-1.1.1.+5 é"):
        for _ in range(1500):
            text = "".join(rng.choice(list(letters), rng.integers(0, 40)))
            assert [s for s in pii.find_spans(text, machine) if s[0] in pii.BASE] == list(base_spans(text))


def test_personal_data_added_by_anchors(spark):
    text = "é https://bob:pw@host.example/x and mailto:a@b.co IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, text[s.start : s.end]) for s in r._spans] for r in pii.scan(docs, ["doc_id"]).collect()}
    assert got[2] == got[3] == []
    assert {("url", "https://bob:pw@host.example"), ("url", "mailto:a@b.co"), ("iban", "DE89 3704 0044 0532 0130 00"), ("account", "12345678")} <= set(got[1])


def test_personal_data_cues_in_any_case():
    machine = pii.automaton()
    for cue in ("Account No: ", "Account Number ", "ACCT No. ", "NÚMERO De Cuenta ", "Numéro de Compte "):
        text = f"İé {cue}12345678"
        assert [(k, text[a:b]) for k, a, b in pii.find_spans(text, machine) if k == "account"] == [("account", "12345678")]
    for url in ("HTTPS://Bob:pw@Host.example", "Mailto:A@b.co", "TEL:+49 170 1234567"):
        assert ("url", 3, 3 + len(url)) in pii.find_spans(f"at {url}", machine)
    assert ("iban", 5, 32) in pii.find_spans("Iban DE89 3704 0044 0532 0130 00", machine)


def test_url_rules(spark):
    urls = [
        (1, "http://a.example.org/es/1"), (2, "https://EXAMPLE.org/en/12?x"), (3, "http://x.org"), (4, None), (5, "no scheme/org/"),
        (6, "http://b.com/de/#t"), (7, "http://com/fr/x"), (8, "http://badexample.org/es/"), (9, "http://q.net/"), (9, "http://q.net/"),
    ]
    pages = spark.createDataFrame([(*r, "z") for r in urls], "page_id bigint, url string, rule string")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, url_rules.rule_table(spark)).collect())
    assert got == Counter(
        [
            (1, "a.example.org", "/es/1", "example.org/es/", "block"), (2, "example.org", "/en/12", "example.org/en/1", "block"),
            (3, "x.org", "", None, "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"), (6, "b.com", "/de/", "com/de/", "block"),
            (7, "com", "/fr/x", "com/fr/", "allow"), (8, "badexample.org", "/es/", "org/", "allow"),
            (9, "q.net", "/", None, "allow"), (9, "q.net", "/", None, "allow"),
        ]
    )
    assert url_rules.judge(pages, url_rules.rule_table(spark, ())).filter("verdict = 'allow'").count() == len(urls)


def cosine(text):
    idf, other = licences.idf_table()
    x = {w: n * idf.get(w, other) for w, n in Counter(licences.words(text)).items()}
    norm = sum(v * v for v in x.values()) ** 0.5
    sides = defaultdict(float)
    for k, licence, w, y in licences.vectors():
        sides[k, licence] += x.get(w, 0) * y
    return max(((v / norm, licence) for (_, licence), v in sides.items()), default=(0, None)) if norm else (0, None)


def test_licences(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("a/LICENSE", mit), ("a/b/x", "words here"), ("a/c/y", f"code\n{gpl}\nmore code follows in this file"), ("d/z", "nothing"),
        (None, f"one two three four five six seven\n{mit}"), (None, None), ("a/b/LICENSE", gpl), ("a/b/e", ""), ("q", "license to be free"),
    ]
    files = spark.createDataFrame([(*r, 1) for r in rows], "path string, text string, licence int")
    got = Counter((r.path, r.licence, r.origin, r.declared_in) for r in licences.scan(files).collect())
    assert got == Counter(
        [
            ("a/LICENSE", "MIT", "file", None), ("a/b/x", "GPL-3.0", "inherited", "a/b"), ("a/c/y", "GPL-3.0", "header", None),
            ("d/z", None, None, None), (None, "MIT", "header", None), (None, "MIT", "header", None), ("a/b/LICENSE", "GPL-3.0", "file", None),
            ("a/b/e", "GPL-3.0", "inherited", "a/b"), ("q", None, None, None),
        ]
    )


def test_licence_anchors_lose_nothing(spark):
    rng = np.random.default_rng(8)
    vocabulary = sorted({w for _, t in licences.TEMPLATES for w in licences.words(t)})
    lines = [" ".join(rng.choice(vocabulary, rng.integers(1, 25))) for _ in range(300)]
    lines += [" ".join(rng.permutation(licences.words(t))[: rng.integers(2, 30)]) for _, t in licences.TEMPLATES for _ in range(10)]
    files = spark.createDataFrame([(str(k), t) for k, t in enumerate(lines)], "path string, text string")
    got = {r.path for r in licences.declared(Scratch(spark), files).filter("kind = 'file'").collect()}
    assert got == {str(k) for k, t in enumerate(lines) if cosine(t)[0] >= licences.SIMILARITY}


def test_whole_licences_and_notices_in_long_lines(spark):
    texts = dict(licences.full_texts())
    rows = [(f"{x}/LICENSE", f"Copyright 2020 Somebody Else\n\n{t}") for x, t in texts.items()] + [(f"{x}/src/code", "words here") for x in texts]
    filler = " ".join(f"f{k}" for k in range(20))
    rows += [(f"long/{k}", f"{filler} {t} {filler}") for k, (_, t) in enumerate(licences.TEMPLATES)]
    rows += [("wrapped/x", "# Released under\n# the MIT\n# License.\n" + filler), ("none/LICENSE", f"{filler} a license of the software " * 40)]
    files = spark.createDataFrame(rows, "path string, text string")
    got = {r.path: (r.licence, r.origin) for r in licences.scan(files).collect()}
    want = {f"{x}/LICENSE": (x, "file") for x in texts} | {f"{x}/src/code": (x, "inherited") for x in texts}
    want |= {f"long/{k}": (x, "header") for k, (x, _) in enumerate(licences.TEMPLATES)}
    assert set(texts) >= {"MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "MPL-2.0"}
    assert got == want | {"wrapped/x": ("MIT", "header"), "none/LICENSE": (None, None)}


def test_language_of_many_labels(spark):
    names = [f"l{k:03}" for k in range(230)]
    rows = [(3 * k + n, f"{x} {x} {x}", x) for k, x in enumerate(names) for n in range(3)] + [(9000 + k, "l000 l000 again", "l000") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    texts, langs = language.training_rows(docs, F.lit(True))
    assert set(langs) == set(names)
    alphabet = [chr(0x4E00 + 7 * k) for k in range(230)]
    before = language.fit([], []).weights["f2"]
    model = language.fit([f"{c}{c}{c}{c}" for c in alphabet], names)
    assert model.languages == names and not np.array_equal(model.weights["f2"], before)
    found, _ = language.predict(model, pa.array([f"{c}{c}{c}{c}" for c in alphabet]))
    assert (found == np.arange(230)).mean() > 0.5


@pytest.mark.parametrize("pairs", [0, 10**9])
def test_texts_that_share_an_id_link_alike_in_both_ways(spark, monkeypatch, pairs):
    """Buckets compared in blocks (0 pairs allowed) and joined to pairs give the same groups."""
    monkeypatch.setattr(odd_sketch, "PAIRS_PER_MEMBER", pairs)
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    base = [[word() for _ in range(80)] for _ in range(4)]
    rows = []
    for k in range(30):  # four families, ids 40 and 41 hold texts of two of them
        own = list(base[k % 4])
        own[int(rng.integers(0, 80))] = word()
        rows.append((k, " ".join(own)))
    rows += [(40, " ".join(base[0])), (40, " ".join(base[1][:79] + [word()])), (41, " ".join(base[2])), (41, "unlike all others " + word() + " " + word()), (41, " ".join(base[2]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in odd_sketch.near_groups(docs).collect()}
    assert {c for (i, _), c in got.items() if i == 40} == {0}
    assert {c for (i, _), c in got.items() if i % 4 in (0, 1) and i < 30} == {0}
    assert {c for (i, _), c in got.items() if i % 4 == 2 or i == 41} == {2}
    assert {c for (i, _), c in got.items() if i % 4 == 3} == {3}


def test_rollup(spark, tmp_path):
    def batch(*rows):
        return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint, live boolean")

    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    assert rollup.apply(0, batch((1, "a", "en", "v", 10, True), (2, "a", None, "v", 5, True), (None, "a", "en", "v", 99, True), (1, "a", "en", "v", 10, True)))
    revised = batch((1, "b", "en", "v", 7, True), (2, None, None, "v", None, False), (8, None, None, "v", None, False), (1, "b", "en", "w", 3, True))
    assert rollup.apply(1, revised) and not rollup.apply(1, revised)
    want = {("b", "en", "v", 1, 7), ("b", "en", "w", 1, 3), ("a", "en", "v", 1, 99)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    # a batch that broke off before its commit is written anew
    revised.write.parquet(str(tmp_path / "r" / "entries" / "2"))
    assert {tuple(r) for r in rollup.totals().collect()} == want
    assert rollup.apply(2, batch((2, "a", None, "v", 4, True)))
    assert {tuple(r) for r in rollup.totals().collect()} == want | {("a", None, "v", 1, 4)}
    parts = spark.createDataFrame([(None, "p", "a", "en", "v", 2, 8), (None, "q", "a", "en", "v", 1, 1)], "doc_id bigint, part string, source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint")
    assert rollup.apply(3, parts.withColumn("live", F.lit(True)))
    assert ("a", "en", "v", 4, 108) in {tuple(r) for r in rollup.totals().collect()}


def test_rollup_query_counts_every_row(spark, docs):
    """A recount: null, shared and repeated ids, equal texts, revised licence lines."""
    line = "Licensed under the MIT License."
    rows = [(1, "one two", "s", "en"), (1, "one two", "s", "en"), (1, "other text", "s", "en"), (None, "alone here", "s", None), (None, "alone here", "s", None)]
    rows += [(None, "one two", None, "en"), (2, "three", "s", "en"), (3, "three", "s", "de"), (3, "three", "t", "de"), (4, None, "s", "en"), (5, "", "s", "en")]
    rows += [(6, f"words\n{line}\nmore words", "s", "en"), (6, f"words\n{line}\nmore words", "s", "en"), (None, f"x\n{line}", "t", "en"), (7, line, "t", "en")]
    rows += [(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()]
    largest = {}
    for i, t, _, _ in rows:
        largest[t or ""] = max(largest.get(t or "", -1), -1 if i is None else i)
    want = Counter()
    tokens_of = Counter()
    for i, t, source, lang in rows:
        if (-1 if i is None else i) == largest[t or ""]:
            kept = re.sub("(?im)^.*(licensed under|released under).*$\n?", "", t or "")
            want[source, lang] += 1
            tokens_of[source, lang] += len(tokens().reference(kept)) if kept else 0
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").repartition(3)
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in token_rollup.corpus_rollup(frame).collect()}
    assert got == {k: (n, tokens_of[k]) for k, n in want.items()}


def test_pii_of_a_million_digits():
    machine = pii.automaton()
    for text in ("7" * 1_000_000, "12-" * 300_000, "1." * 300_000, ". ".join(["9" * 500_000] * 2), "a@b" + "1" * 500_000):
        began = time.process_time()
        pii.find_spans(text, machine)
        assert time.process_time() - began < 4
    assert pii.find_spans("x 4111111111111111, 1.2.3.4", machine) == [("ip", 20, 27), ("card", 2, 18)]


def test_language(spark):
    rng = np.random.default_rng(3)
    letters = {"aa": list("abcde "), "bb": list("vwxyz "), "cc": list("éèçàù ")}
    make = lambda x, n: "".join(rng.choice(letters[x], n))
    train = [(make(x, int(rng.integers(20, 600))), x) for x in letters for _ in range(60)]
    model = language.fit([t for t, _ in train], [x for _, x in train])
    rows = [(k, make(x, int(rng.integers(20, 3000))), x) for k, x in enumerate(list(letters) * 20)] + [(100, None, "und"), (101, "", "und"), (102, "12 34!", "und")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, want string")
    got = language.identify(docs, model, ["doc_id", "want"]).collect()
    assert all(r.lang_pred == r.want and 0 <= r._score <= 1 for r in got) and len(got) == len(rows)
    nothing = language.identify(docs, language.fit([], []), ["doc_id"]).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_toxicity_gradients():
    rng = np.random.default_rng(5)
    weights = toxicity.fresh_weights(rng)
    x = rng.standard_normal((3, 6, toxicity.WORD_DIM + toxicity.CHAR_DIM)).astype(np.float32)
    mask = np.array([[1] * 6, [1] * 4 + [0] * 2, [1] + [0] * 5], np.float32)
    weigh = np.array([1.0, -2.0, 0.5], np.float32)
    grads, dx = toxicity.backward(weights, x, mask, toxicity.forward(weights, x, mask, keep=True), weigh)
    for name in ("in0", "u0", "u1", "b1", "aw", "av", "ow", "ob"):
        at = tuple(int(rng.integers(0, n)) for n in weights[name].shape)
        kept, out = weights[name][at], []
        for step in (0.01, -0.01):
            weights[name][at] = kept + step
            out.append(float(toxicity.forward(weights, x, mask) @ weigh))
        weights[name][at] = kept
        assert grads[name][at] == pytest.approx((out[0] - out[1]) / 0.02, rel=0.05, abs=2e-3), name


def test_toxicity(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))

    def text(toxic):
        own = [word() for _ in range(int(rng.integers(5, 200)))]
        for _ in range(3 * toxic):
            own[int(rng.integers(0, len(own)))] = str(rng.choice(["Zounds", "zapper", "ZITS"]))
        return " ".join(own)

    labels = rng.integers(0, 2, 900)
    texts = [text(int(t)) for t in labels]
    model = toxicity.fit(texts[:600], labels[:600], 0.5)
    got = toxicity.score_texts(model, pa.array(texts[600:]))
    assert ((got >= 0.5) == labels[600:]).mean() > 0.95
    long = " ".join(word() for _ in range(20_000)) + " zounds zapper zits zounds"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, long)], "doc_id bigint, text string")
    scored = {r.doc_id: r._score for r in toxicity.score_documents(docs, model, ["doc_id"]).collect()}
    assert scored[4] > 0.5 and scored[1] == scored[2] == scored[3] < 0.5


def test_windows_cover_every_word():
    firsts = np.array([0, 0, 1, 49, 49 + 48, 97 + 400])
    starts, sizes, rows = toxicity.windows_of(firsts)
    for row in range(5):
        covered = set()
        for s, n in zip(starts[rows == row], sizes[rows == row], strict=True):
            covered |= set(range(s, s + n))
        assert covered == set(range(firsts[row], firsts[row + 1]))


def test_empty_tables(spark, empty):
    model = toxicity.fit([], np.zeros(0, np.int64), 0.0)
    assert toxicity.score_documents(empty, model, ["doc_id"]).count() == 0
    assert pii.scan(empty, ["doc_id"]).count() == 0
    assert language.training_rows(empty, F.lit(True)) == ([], [])
    assert token_rollup.corpus_rollup(empty).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert licences.scan(licences.corpus_files(empty, pages)).count() == 0
    assert url_rules.judge(pages, url_rules.rule_table(spark)).count() == 0


def test_url_of_very_many_labels(spark):
    long = "a." * 50_000
    urls = [(1, f"http://{long}com/fr/x"), (2, f"http://{long}example.org/es/{'p' * 100_000}"), (3, f"http://{long}net"), (4, "http://..org/")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    began = time.time()
    got = {r.page_id: r.rule for r in url_rules.judge(pages, url_rules.rule_table(spark)).select("page_id", "rule").collect()}
    assert got == {1: "com/fr/", 2: "example.org/es/", 3: None, 4: "org/"} and time.time() - began < 20


def test_language_sample_is_the_lowest_hashes(spark):
    rows = [(k, f"text {k}", "hot" if k % 3 else "rare" if k % 90 == 0 else "mid") for k in range(9000)] + [(None, "x", "hot"), (7, None, "hot"), (8, "", "hot")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    texts, langs = language.training_rows(docs.repartition(7), F.lit(True), most=300)
    assert Counter(langs) == {"hot": 100, "mid": 100, "rare": 100}
    order = docs.filter("text != ''").orderBy(F.xxhash64("doc_id", "text")).collect()
    want = [[r.text for r in order if r.lang == x][:100] for x in ("hot", "mid", "rare")]
    assert sorted(texts) == sorted(sum(want, []))
    assert (texts, langs) == language.training_rows(docs.coalesce(1), F.lit(True), most=300)
    long = spark.createDataFrame([(1, "abc " * 400_000, "l")], "doc_id bigint, text string, lang string")
    assert len(language.training_rows(long, F.lit(True))[0][0]) <= language.SAMPLE_CHARS + 64


def test_language_against_plain_convolution():
    texts = ["abc abc " * 90, "xyz zyx", "éèà", "b"]
    model = language.fit(["abc ab " * 20, "xyz zy " * 20] * 10, ["a", "x"] * 10)
    got, sure = language.predict(model, pa.array(texts, pa.large_string()))
    w = model.weights
    for text, found, score in zip(texts, got, sure, strict=True):
        raw, total = text.encode(), np.zeros(2)
        for at in range(0, len(raw), language.WINDOW):
            piece = raw[at : at + language.WINDOW]
            cells = [*piece, *[0] * (language.WINDOW - len(piece))]
            pooled = []
            for width in language.WIDTHS:
                sums = [sum(w[f"f{width}"][k][cells[p + k]] for k in range(width)) for p in range(len(cells) - width + 1)]
                pooled.append(np.max(sums, axis=0))
            z = np.maximum(np.concatenate(pooled) + w["fb"], 0) @ w["w"] + w["b"]
            total += len(piece) * (z - np.log(np.exp(z - z.max()).sum()) - z.max())
        p = np.exp(total / len(raw) - (total / len(raw)).max())
        assert found == p.argmax() and abs(score - p.max() / p.sum()) < 1e-3


def toxic_sample():
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    plain = lambda n: list(rng.choice(words, n))
    texts = [plain(int(rng.integers(20, 150))) for _ in range(300)]
    label = np.arange(300) % 2
    for text, toxic in zip(texts, label, strict=True):
        if toxic:
            text.insert(int(rng.integers(0, len(text))), str(rng.choice(["zounds", "vermin", "wretch"])))
    return [" ".join(t) for t in texts], label, plain


def test_toxicity_does_not_depend_on_the_place_of_a_passage():
    texts, label, plain = toxic_sample()
    model = toxicity.fit(texts, label, 0.5)
    before, passage, after = plain(48), plain(9) + ["vermin"] + plain(10), plain(48)
    scores = toxicity.score_texts(model, pa.array([" ".join(before[:k] + passage + after) for k in range(48)], pa.large_string()))
    assert scores.min() > 0.5 and scores.max() - scores.min() < 0.1
    assert toxicity.score_texts(model, pa.array([" ".join(before + after)], pa.large_string()))[0] < 0.5


def test_toxicity_against_a_plain_scorer():
    """Each window word by word, one text at a time."""
    texts, label, plain = toxic_sample()
    model = toxicity.fit(texts, label, 0.1)
    w, size = model.weights, toxicity.STATE
    sig = lambda v: 1 / (1 + np.exp(-v))
    sample = [" ".join(plain(n)) for n in (1, 30, 48, 49, 72, 73, 200)] + ["", "12 !", "Vermin"]
    got = toxicity.score_texts(model, pa.array(sample, pa.large_string()))
    for text, score in zip(sample, got, strict=True):
        vectors = []
        for _, words, triples, at, _ in toxicity.featurise(pa.array([text], pa.large_string())):
            for k, slot in enumerate(words):
                vectors.append(np.concatenate((w["word"][slot], w["char"][triples[at[k] : at[k + 1]]].mean(0))))
        best, start = -np.inf, 0
        while True:
            x, states = vectors[start : start + toxicity.WINDOW], []
            for side, order in ((0, x), (1, x[::-1])):
                h, trail = np.zeros(size), []
                for v in order:
                    g = v @ w[f"in{side}"] + w[f"b{side}"]
                    gates = sig(g[: 2 * size] + h @ w[f"u{side}"][:, : 2 * size])
                    c = np.tanh(g[2 * size :] + gates[size:] * (h @ w[f"u{side}"][:, 2 * size :]))
                    h = h + gates[:size] * (c - h)
                    trail.append(h)
                states.append(trail if side == 0 else trail[::-1])
            pooled = np.zeros(2 * size)
            if x:
                s = np.concatenate([np.array(t) for t in states], 1)
                e = np.exp(np.tanh(s @ w["aw"]) @ w["av"])
                pooled = (e / e.sum()) @ s
            best = max(best, pooled @ w["ow"] + w["ob"][0])
            if start + toxicity.WINDOW >= len(vectors):
                break
            start += toxicity.STRIDE
        assert abs(score - sig(best + model.shift)) < 1e-3
