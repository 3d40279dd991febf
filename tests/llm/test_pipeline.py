import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from kinweave.llm import pii, quality, queries, tokens

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingles(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {" ".join(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def least_of_groups(texts):
    """The smallest id of each group of texts that are alike to 0.8, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root, held = {i: i for i in texts}, defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, own in sets.items():
        for s in own or {None}:
            held[s].append(i)
    for a, b in {p for own in held.values() for p in itertools.combinations(own, 2)}:
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i for i in texts if find(i) == i}


def hidden(text, spans):
    """The text with its spans (start, end, kind) replaced; of those that overlap the first, then the longest."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_pipeline_equals_plain_stages(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "pii", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    after = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).persist()
        assert docs.columns == COLUMNS
        after.append({r.doc_id: r for r in docs.collect()})
    raw = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(raw, spark.read.parquet(f"{sf}/labels.parquet"))
    of = model.scorer()
    texts = {r.doc_id: r.text or "" for r in raw.collect()}
    good = {i: t for i, t in texts.items() if 1 / (1 + math.exp(-(of(t) * model.slope + model.intercept))) >= 0.3}
    assert set(after[0]) == set(good) and len(good) < len(texts)
    kept = least_of_groups(good)
    assert set(after[1]) == kept and len(kept) < len(good)
    left = spark.createDataFrame([(i, texts[i]) for i in kept], "doc_id long, text string")
    spans = {r.doc_id: [(int(a), int(b), k) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)] for r in pii.detect(left).collect()}
    assert {i: r.text for i, r in after[2].items()} == {i: hidden(texts[i], spans[i]) for i in kept}
    assert all(r.n_chars == len(r.text) for r in after[2].values())

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_path("word_bpe_49k.json"))
    t.no_padding()
    t.no_truncation()
    want = Counter()
    for i, r in after[2].items():
        ids = [*t.encode(r.text, add_special_tokens=False).ids, 1]
        for k, lo in enumerate(range(0, len(ids), 4096)):
            want[i, k, lo, len(ids[lo : lo + 4096]), zlib.crc32(np.array(ids[lo : lo + 4096], "<u4").tobytes())] += 1
    packed = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        assert [o for o, _ in sorted(own)] == list(np.cumsum([0, *[n for _, n in sorted(own)]])[:-1]) and sum(n for _, n in own) <= 4096
    assert len(bins) == -(-sum(n for own in bins.values() for _, n in own) // 4096)


def test_pipeline_of_an_empty_table(spark, sf, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_query_runs(spark, sf):
    assert sorted(int(m[1]) for n in queries.QUERIES if (m := re.match(r"op(\d+)_", n))) == list(range(1, 11))
    for name in ("op2_spotsigs", "op3_rendezvous_shards", "op7_exact_top_k", "op10_merkle_audit", "pii_base_spans"):
        assert queries.QUERIES[name](spark, sf).count() > 0 and name in queries.ORACLE_SQL
