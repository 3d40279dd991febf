"""Every operator of llm against brute force on small tables with nulls, empty, long, tied and repeated rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.llm import fixity, licenses, packing, pii, quality, setjoin, sharding, simhash, spotsigs, tokens, topk
from kinweave.llm.components import components

WORDS = "the stone of river and cloud in valley a garden is winter to harbor with candle on mirror der stern und le chat".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(i % 3) if i % 4 else WORDS[i] for i in rng.integers(0, len(WORDS), n))


BASE = prose(1, 120)
TEXTS = [
    None,
    "",
    "   ",
    "...",
    "one",
    BASE,
    BASE,
    BASE.replace("stone1", "pebble", 1),
    prose(2, 90) + " bob@site.org , +1 (262) 555-7240 , 4111 1111 1111 1111 , 10.0.0.255 , 300.1.1.1",
    "Licensed under CC BY-NC 4.0. cc by cc by. All rights reserved",
    "x" * 30_000,
    ("a@" * 4000) + "b.c " + "1." * 4000 + " " + "1 " * 3000,
    "日本語 テキスト \U0001f600 é́ <|endoftext|> it's ''s",
    prose(3, 4000),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, sig string, shard int, text_hash string"


@pytest.fixture(scope="module")
def rows():
    out = [(i * 3, t) for i, t in enumerate(TEXTS)]
    return out + [out[5], out[5], (1000, None), (None, "no id at all"), (None, BASE)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x", 7, "h") for i, t in rows], SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(v):
    return (v is not None, v or 0)


# --- 1 ---------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=d: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=d: 9 <= len(d) <= 15,
            }
            if good[kind]():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans(docs, rows):
    found = pii.detect(docs).collect()
    assert len(found) == len(rows)
    want = Counter((i, hashlib.sha256(",".join(base_spans(t or "")).encode()).hexdigest()) for i, t in rows)
    assert Counter((r.doc_id, r.base_sha256) for r in found) == want
    for r in found:
        assert r.spans.count("email:") == r.n_email and r.spans.count("phone:") == r.n_phone


def test_pii_contexts_find_unseen_identifiers_and_leave_common_words(spark):
    texts = [f"write mailto: user{i}@corp.com now" for i in range(8)] + [f"see tel. +1 555 123 45{i}7 ok" for i in range(5)]
    texts += ["write mailto: bob (at) corp (dot) com now", "call tel. 555-123-4567 ok", "room of 555-987-6543 chairs"]
    found = {r.doc_id: r.spans for r in pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found[13] == "email:14:37" and found[14] == "phone:10:22" and found[15] == ""


def test_pii_redaction_keeps_rows_and_columns(docs, rows, empty):
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows) and all(r.text_hash == "h" for r in got)
    assert any("[email] , [phone] , [card] , [ip] , 300.1.1.1" in (r.text or "") for r in got)
    assert Counter(r.text for r in got)[BASE] == 5 and sum(r.text is None for r in got) == 2
    assert pii.redact(empty).count() == 0 and pii.detect(empty).count() == 0


# --- 2 ---------------------------------------------------------------------------------------------


def test_spotsigs_next_document_and_edit(docs, rows, empty):
    found = spotsigs.compare_documents(docs).collect()
    order = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = Counter()
    for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        want[i, len(t), hashlib.sha256((t[: len(t) - half] + u[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == want
    by_text = defaultdict(set)
    text_of = {i: t or "" for i, t in rows}
    for r in found:
        if r.doc_id is not None:
            by_text[text_of[r.doc_id]].add(r.fingerprint)
        a, b = (set(x.split(",")) - {""} for x in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in by_text.values())
    assert all(x != {""} for t, x in by_text.items() if t)
    assert spotsigs.compare_documents(empty).count() == 0


def test_spotsigs_next_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "ROWS_PER_RANGE", 7)
    texts = [(i * i, prose(i, 5 + i % 9)) for i in range(100)]
    found = {r.doc_id: r for r in spotsigs.compare_documents(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}
    order = texts[::-1]
    for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        assert found[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + u[:half]).encode()).hexdigest()


def test_spotsigs_classes_equal_brute_force(spark):
    bases = [prose(s, 200).split() for s in range(6)]
    texts = []
    for k in range(36):
        own = list(bases[k % 6])
        for j in range(k // 6 * 4):
            own[(j * 17 + k) % len(own)] = f"new{k}x{j}"
        texts.append((k, " ".join(own)))
    texts += [(100, texts[0][1]), (101, ""), (102, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    sets = {r.doc_id: set(r.sig) for r in spotsigs.signatures(df.fillna(""), "text", "sig").collect()}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sorted(sets), 2):
            both = sets[a] | sets[b]
            if not both or len(sets[a] & sets[b]) / len(both) >= 0.8:
                root[a] = root[b] = min(root[a], root[b])
    assert {r.doc_id: r.class_id for r in spotsigs.near_duplicates(df).collect()} == root


# --- 3 ---------------------------------------------------------------------------------------------


def test_sharding(docs, rows, empty):
    found = sharding.shard_documents(docs, 5).collect()
    assert len(found) == len(rows)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    assert sharding.shard_documents(empty, 5).count() == 0


def test_weighted_shards_get_their_share(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    one = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.rendezvous(ids, "doc_id", [1.0, 2.0, 1.0]).collect()}
    counts = Counter(s for s, _ in one.values())
    assert abs(counts[1] / 20_000 - 0.5) < 0.02
    moved = [g for s, g in one.values() if s != g]
    assert set(moved) == {3} and abs(len(moved) / 20_000 - 0.2) < 0.02


# --- 4 ---------------------------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs.join(labels, "doc_id", "left_semi"), labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in scored) / len(scored)
    assert right > 0.94
    good = [r.score for r in scored if r.quality == 1]
    bad = [r.score for r in scored if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_quality_edges(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i * 3, int(i % 2), 0) for i in range(14)], "doc_id long, quality int, toxic int")
    found = quality.score(docs, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    assert len({r.score for r in found if r.doc_id in (0, 3, 1000)}) == 1
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(empty, labels).count() == 0 and quality.keep_good(docs, none).columns == docs.columns


# --- 5 ---------------------------------------------------------------------------------------------


def test_license_base_columns(docs, rows, empty):
    lower = {c: c + 32 for c in range(65, 91)}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = Counter()
    for i, t in rows:
        own = word.findall((t or "").translate(lower))
        at = {p: [k for k in range(len(own)) if own[k : k + len(p.split())] == p.split()] for p in licenses.BASE}
        every = sorted(itertools.chain(*at.values()))
        want[i, len(own), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(licenses.BASE[p] for p in at if at[p]))] += 1
    found = licenses.scan(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in found)
    assert licenses.scan(empty).count() == 0


def test_license_rules_suppress_contained_detections():
    scanner = licenses.Scanner()
    assert len(scanner.rules) > 250
    of = lambda t: [r.label for _, _, r in scanner.detections(t.lower())]
    assert of("Licensed under CC BY-NC 4.0.") == ["cc-by-nc"]
    assert of("This work is licensed under the GNU General Public License, version 3.") == ["gpl-3.0"]
    assert of("SPDX-License-Identifier: MIT-0") == ["mit-0"]
    assert of("Released under the MIT License. Copyright (c) 2020") == ["mit", "copyright"]
    assert of("the garden trail is open") == []


# --- 6 and 8 -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    out = {}
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        t = out[name] = Tokenizer.from_file(tokens.default_path(name))
        t.no_padding()
        t.no_truncation()
    return out


def test_byte_bpe_round_trip(docs, rows, empty, library):
    t = library["byte_bpe_50k.json"]
    want = Counter()
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in tokens.round_trip(docs).collect()) == want
    assert tokens.round_trip(empty).count() == 0


def test_encoders_equal_the_library_for_all_kinds_of_characters(library):
    points = [*range(0, 0x700), *range(0x2000, 0x2100), *range(0x3000, 0x3100), 0xFB01, 0x1F600, 0x10FFFF]
    texts = [f"A{c}b 1{c}2 {c}{c}  {c}a{c}" for c in map(chr, points)]
    texts += ["aaaa" * 50, "''s 'S don't", "<|startoftext|>x<|endoftext|>", "ΑΣ Σ", "\t\n  a \n\n b  "]
    byte, word = tokens.ByteBpe(tokens.default_path("byte_bpe_50k.json")), tokens.WordBpe(tokens.default_path("word_bpe_49k.json"))
    ids, sizes = byte.encode(texts)
    ends = np.cumsum(sizes)
    for text, lo, hi, own in zip(texts, ends - sizes, ends, word.encode(texts), strict=True):
        assert ids[lo:hi].tolist() == library["byte_bpe_50k.json"].encode(text, add_special_tokens=False).ids, ascii(text)
        assert own.tolist() == library["word_bpe_49k.json"].encode(text, add_special_tokens=False).ids, ascii(text)


def test_remembered_pieces_survive_forgetting(monkeypatch, library):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    word = tokens.WordBpe(tokens.default_path("word_bpe_49k.json"))
    for k in range(20):
        text = prose(k, 60) + f" w{k} the of " + "y" * 100
        assert word.encode([text])[0].tolist() == library["word_bpe_49k.json"].encode(text, add_special_tokens=False).ids


def test_packing(docs, rows, empty, library):
    found = packing.pack_documents(docs).collect()
    want = Counter()
    for i, text in rows:
        ids = [*library["word_bpe_49k.json"].encode(text or "", add_special_tokens=False).ids, 1]
        for k, lo in enumerate(range(0, len(ids), 4096)):
            own = ids[lo : lo + 4096]
            want[i, k, lo, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) == -(-sum(r.length for r in found) // 4096)
    assert packing.pack_documents(empty).count() == 0


def test_local_search_empties_bins():
    lengths = np.array([6, 6, 5, 5, 4, 4, 3, 3, 2, 2])
    start = [[0, 6], [1, 7], [2, 4], [3, 5], [8], [9]]
    bins = packing.improve([list(b) for b in start], lengths, 10)
    assert sorted(itertools.chain(*bins)) == list(range(10)) and len(bins) == 4
    assert all(lengths[b].sum() <= 10 for b in bins)
    rng = np.random.default_rng(0)
    lengths = rng.integers(900, 2100, 400)
    first = packing.best_fit(lengths, 4096)
    better = packing.improve([list(b) for b in first], lengths, 4096)
    assert len(better) <= len(first) and sorted(itertools.chain(*better)) == list(range(400))
    assert all(lengths[b].sum() <= 4096 for b in better)


# --- 7 ---------------------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "BLOCKS", 5)
    monkeypatch.setattr(topk, "ROW_BLOCK", 16)
    rng = np.random.default_rng(5)
    vectors = [[float(np.float32(x)) for x in rng.normal(size=24) * (1 + k % 3)] for k in range(600)]
    rows = [(k, v) for k, v in enumerate(vectors)]
    rows[50] = (50, None)
    rows[100] = (100, [float("nan")] * 24)
    rows[7] = (7, [None] + vectors[7][1:])
    rows[8] = (8, [float("inf")] + vectors[8][1:])
    rows[11], rows[12] = (11, vectors[10]), (12, vectors[10])
    rows[13] = (13, vectors[13][:9])
    rows[14] = (14, [])
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    whole = {k: [int(np.floor(256 * x)) for x in v] for k, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in whole:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=False)), c) for c in whole if c != q)
            want |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:5])}
    assert {tuple(r) for r in topk.top_k(df).collect()} == want
    assert topk.top_k(df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(few).orderBy("rank").collect()] == [(0, 1, 1, 65536), (0, 2, 2, 65536)]


def test_segment_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(20, 50)), rng.normal(size=(30, 50))
    exact = a @ b.T
    last = None
    for x, y in zip(topk._summaries(a), topk._summaries(b), strict=True):
        bound = x @ y.T
        assert (bound >= exact - 1e-9).all()
        last = bound if last is None else np.minimum(last, bound)


# --- 9 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_the_radius(radius):
    masks = simhash.covering_masks(radius, 24)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(24), radius):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_simhash_components_equal_brute_force(spark, docs, rows, empty):
    rng = np.random.default_rng(3)
    more = []
    for k in range(60):
        own = prose(50 + k % 12, 300).split()
        for j in range(k // 12):
            own[rng.integers(0, len(own))] = f"z{j}"
        more.append((500 + k, " ".join(own)))
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    texts = [*rows, *more]
    prints = [simhash.fingerprint(t or "") for _, t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(texts):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = Counter((i, f"{prints[k]:016x}", least[find(k)]) for k, (i, _) in enumerate(texts))
    assert Counter(tuple(r) for r in simhash.near_duplicates(df).collect()) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_links_find_all_pairs_within_two_bits(spark):
    rng = np.random.default_rng(9)
    seeds = [int(x) for x in rng.integers(0, 2**63, 30)]
    values = {s ^ (1 << int(a)) ^ (1 << int(b)) for s in seeds for a, b in rng.integers(0, 64, (6, 2))} | set(seeds)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    from kinweave.llm.components import components

    for radius in (1, 2):
        edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "f long"), radius)
        assert all((r.u ^ r.v).bit_count() <= 2 if (r.u ^ r.v) >= 0 else ((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 2 for r in edges.collect())
        got = {r.node: r.root for r in components(edges).collect()}
        root = {v: v for v in signed}
        for _ in range(8):
            for a, b in itertools.combinations(signed, 2):
                if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                    root[a] = root[b] = min(root[a], root[b])
        assert {k: got.get(k, k) for k in signed} == root


def test_keep_one(spark, docs, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(15) == 1 and 18 not in ids and 21 not in ids and ids.count(0) == 1 and 3 not in ids and 1000 not in ids
    assert ids.count(None) == 1
    assert simhash.keep_one(empty).count() == 0


def test_near_copies_of_short_texts_are_all_found(spark):
    rows, near, apart = [], [], []
    for k in range(100):
        long = 8 + k % 70  # J of a text and itself less a fifth of its shingles, and then less one more
        own = [f"w{k}x{i}" for i in range(long)]
        n = long - 4
        kept = math.ceil(0.8 * n - 1e-9)
        rows += [(3 * k, " ".join(own)), (3 * k + 1, " ".join(own[: kept + 4]))]
        near.append(k)
        if kept > 1 and k % 2:
            rows[-1] = (3 * k + 1, " ".join(own[: kept + 3]))
            near.pop()
            apart.append(k)
    classes = {r.doc_id: r.class_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(classes[3 * k + 1] == 3 * k for k in near)
    assert all(classes[3 * k + 1] == 3 * k + 1 for k in apart)


# --- 10 --------------------------------------------------------------------------------------------


def archive(spark, rows):
    return spark.createDataFrame(rows, "key long, record binary").repartition(3)


def test_fixity_audit(spark, monkeypatch):
    monkeypatch.setattr(fixity, "FAN_BITS", 2)
    rows = [(k, f"record {k}".encode()) for k in range(90)] + [(5, b"twice"), (5, b"twice"), (None, b"no key"), (88, None)]
    primary = archive(spark, rows)
    same = fixity.audit(primary, primary, 32).collect()
    assert len(same) == len(rows) and {(r.status, r.run) for r in same} == {("intact", None)}
    damaged = [(k, b"rot" if k == 17 else r) for k, r in rows if k != 40] + [(7000, b"stray"), (5, b"twice")]
    got = Counter((r.key, r.status) for r in fixity.audit(primary, archive(spark, damaged), 32).collect() if r.status != "intact")
    assert got == Counter({(17, "corrupt"): 1, (40, "missing"): 1, (7000, "extra"): 1, (5, "extra"): 1})
    assert fixity.audit(primary.limit(0), primary.limit(0), 32).count() == 0
    assert {r.status for r in fixity.audit(primary, primary.limit(0), 32).collect()} == {"missing"}


def test_audit_descends_only_into_the_damaged_run(spark, monkeypatch):
    monkeypatch.setattr(fixity, "FAN_BITS", 2)
    rows = [(k, f"record {k}".encode()) for k in range(200)]
    bad = [(k, b"record XXX" if k == 123 else r) for k, r in rows]
    left, right = (fixity.manifest(archive(spark, x), 100) for x in (rows, bad))
    assert [tuple(r) for r in fixity.mismatches(left, right).collect()] == [(1, 23 // 4)]


def test_warc_record_is_well_formed(spark):
    df = spark.createDataFrame([(1, "http://x", "é"), (None, None, None)], "i long, u string, h string")
    a, b = (bytes(r[0]) for r in df.select(fixity.warc_record(F.col("i"), F.col("u"), F.col("h"))).collect())
    assert a.startswith(b"WARC/1.1\r\n") and b"Content-Length: 2\r\n\r\n\xc3\xa9\r\n\r\n" in a
    assert b"Content-Length: 0\r\n\r\n\r\n\r\n" in b


def test_set_join_compares_few_pairs_of_one_group(spark, monkeypatch):
    # set 0 comes first under every member, but is alike to none of 300 sets that are alike to each other; set 301 makes all members as frequent
    base = list(range(1000, 1042))
    sets = {0: [*base[:35], 2000]} | {k: [*base, 5000 + k, 6000 + k] for k in range(1, 301)} | {301: [*base[35:], 2000, *range(7000, 7092)]}
    met, alike = [], setjoin.alike

    def counted(sets, pairs, similarity):
        met.append(pairs.count())
        return alike(sets, pairs, similarity)

    monkeypatch.setattr(setjoin, "alike", counted)
    df = spark.createDataFrame([(k, len(v), v) for k, v in sets.items()], "node long, n int, h array<int>")
    profiles = setjoin.profiles(df, 0.8).localCheckpoint()
    for tables, least, most in ((False, 40_000, 50_000), (True, 300, 10_000)):
        met.clear()
        root = {r["node"]: r["root"] for r in components(setjoin.links(profiles, 0.8, tables=tables)).collect()}
        assert [root.get(k, k) for k in sets] == [0, *[1] * 300, 301]
        assert least <= sum(met) < most
