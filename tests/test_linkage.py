import hashlib
import itertools
import json
import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from kinweave.functions.scores import f_half, jaccard
from kinweave.operators import blocking, evaluate, features, labels, model, quality, similarity
from kinweave.plans import commands, linkage, stages
from kinweave.sources import entities as src
from kinweave.sources.store import Store
from kinweave.streaming import incremental

NORMALIZED = "entity_id string, country string, name_s string, name_t string, addr_t string, stno string"


def entities(spark, rows):
    return spark.createDataFrame(rows, NORMALIZED)


def test_keys_of_all_families(spark):
    rows = [("S1-a", "DE", "nordsee fisch kontor", "fisch kontor nordsee", "7b am hafen kai", "7b"), ("S2-b", "FR", "zo", "zo", "au 9", ""), ("S3-c", "FR", "", "", "rue", "")]
    got = {(r.entity_id, r.country, r.family, r.value) for r in blocking.keys(entities(spark, rows)).collect()}
    want = set()
    for i, country, name, bag, addr, number in rows:
        want |= {(i, country, "c3", name[:3])} if len(name) >= 3 else set()
        want |= {(i, country, "t", t) for t in bag.split()} | {(i, country, "a", t) for t in addr.split() if len(t) > 2}
        want |= {(i, country, f, v) for f, v in (("sn", number), ("fn", name)) if v}
    assert got == want and len(want) == 11


def test_caps_are_inclusive(spark):
    rows = [(f, "FR", f"{f}{n}", n) for f in blocking.WEIGHTS for n in (6, 7, 8)]
    df = spark.createDataFrame(rows, "family string, country string, value string, df long")
    caps = blocking.Caps(t=7, a=6, sn=8, fn=5, c3=7)
    assert {(r.family, r.df) for r in blocking.allowed(df, caps).collect()} == {(f, n) for f, _, _, n in rows if n <= getattr(caps, f)}


def test_evidence_equals_plain_sums(spark):
    rng = random.Random(3)
    word = lambda k: " ".join(sorted({rng.choice("alpha beta gamma delta omega sigma".split()) for _ in range(k)}))
    rows = [(f"S{1 + i % 3}-{i:02d}", rng.choice(["DE", "FR"]), *[word(2)] * 2, word(3), str(rng.randint(1, 4))) for i in range(45)]
    df = entities(spark, rows)
    s1, pool = df.where("entity_id like 'S1%'"), df.where("entity_id not like 'S1%'")
    keys = {r[0]: {("c3", r[2][:3]), ("sn", r[5]), ("fn", r[2])} | {("t", t) for t in r[3].split()} | {("a", t) for t in r[4].split()} for r in rows}
    country = {r[0]: r[1] for r in rows}
    counts = {}
    for i in keys:
        for k in keys[i] if i[:2] != "S1" else ():
            counts[country[i], k] = counts.get((country[i], k), 0) + 1
    caps = blocking.Caps(t=6, a=9, sn=4, fn=3, c3=5)
    want = {}
    for a in keys:
        for b in keys:
            if a[:2] == "S1" and b[:2] != "S1" and country[a] == country[b]:
                score = [blocking.WEIGHTS[f] / math.log2(2 + counts[country[a], (f, v)]) for f, v in keys[a] & keys[b] if counts[country[a], (f, v)] <= getattr(caps, f)]
                if score:
                    want[a, b] = sum(score)
    got = {(r.s1_id, r.cand_id): r.score for r in blocking.candidates(s1, pool, caps).collect()}
    assert got == pytest.approx(want, abs=1e-8) and len(got) > 20
    assert {(r.s1_id, r.cand_id) for r in blocking.plain_union(s1, pool, caps).collect()} == set(want)
    best = {}
    for (a, b), score in want.items():
        best.setdefault(a, []).append((-round(score, 9), b))
    first = {(r.s1_id, r.cand_id, r.evidence_rank) for r in blocking.candidates(s1, pool, caps, 2).collect()}
    assert first == {(a, b, k) for a, own in best.items() for k, (_, b) in enumerate(sorted(own)[:2])}


def test_top_k_breaks_ties_by_id(spark):
    rows = [("S1-q", f"S3-{n}", s) for n, s in zip("edcba", (0.5, 0.25, 0.5, 0.75, 0.25), strict=True)] + [("S1-r", "S2-z", 0.0)]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, score double")
    ids = lambda k: [r.cand_id for r in blocking.top_k(df, "score", k).where("s1_id = 'S1-q'").orderBy("cand_rank").collect()]
    assert ids(3) == ["S3-b", "S3-c", "S3-e"] and ids(9) == ["S3-b", "S3-c", "S3-e", "S3-a", "S3-d"] and ids(0) == ids(-1) == []


def test_cosine_equals_plain_computation(spark):
    names = ["alpha beta", "alpha gamma", "beta gamma delta", "alpha beta beta", "omega"]
    pool = spark.createDataFrame([(f"S2-{i}", n, n) for i, n in enumerate(names)], "entity_id string, name_t string, addr_n string")
    n = len(names)
    df = {t: sum(t in x.split() for x in names) for x in names for t in x.split()}
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items() if d >= 2}

    def vector(text):
        raw = {t: (1 + math.log(text.split().count(t))) * idf[t] for t in set(text.split()) if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {t: v / norm for t, v in raw.items()}

    got = {(r.entity_id, r.token): r.weight for r in similarity.weights(pool, similarity.idf(pool)).where("field = 'addr'").collect()}
    want = {(f"S2-{i}", t): w for i, x in enumerate(names) for t, w in vector(x).items()}
    assert got == pytest.approx(want)
    lonely = spark.createDataFrame([("S2-0", "a b", ""), ("S2-1", "c", "")], "entity_id string, name_t string, addr_n string")
    assert {r.token for r in similarity.idf(lonely).collect()} == {"a", "b", "c"}


def test_blank_address_ranks_by_name_alone(spark):
    rows = [(0.2, 0.6, a, b) for a in ("", "lane") for b in ("", "road")]
    df = spark.createDataFrame(rows, "name_cos double, addr_cos double, addr_n_1 string, addr_n_2 string")
    for kind, both in (("mean", 0.4), ("max", 0.6)):
        assert [r[0] for r in df.select(similarity.proxy(kind)).collect()] == pytest.approx([0.2, 0.2, 0.2, both])


def test_jaccard_of_empty_sets_is_one(spark):
    df = spark.createDataFrame([([], []), (["a"], []), (["a", "b"], ["b"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(jaccard(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.5]


def test_labels_and_negative_sampling(spark):
    rng = random.Random(8)
    every = [(f"S1-{a}", f"S{2 + b % 2}-{b}") for a in range(30) for b in range(12)]
    true = {p for p in every if rng.random() < 0.1}
    lists = [(f"S1-{a}", " ,".join(b for x, b in sorted(true) if x == f"S1-{a}")) for a in range(30)] + [("S1-none", "S2-0,S9-0"), ("S1-0", "S2-99")]
    truth = src.explode_truth(spark.createDataFrame(lists, src.TRUTH))
    pairs = spark.createDataFrame(every, "s1_id string, cand_id string")
    labelled = labels.label(pairs, truth)
    assert {(r.s1_id, r.cand_id) for r in labelled.where("is_match = 1").collect()} == true
    ids = lambda xs: spark.createDataFrame([(x,) for x in sorted(set(xs))], "entity_id string")
    known = labels.known_truth(truth, ids(a for a, _ in every), ids(b for _, b in every))
    assert {(r.s1_id, r.cand_id) for r in known.collect()} == true
    held = ids(["S1-3", "S1-7"])
    for ratio in (0.0, 0.3, 1.0):
        kept = {(r.s1_id, r.cand_id): r.is_val for r in labels.sample_negatives(labelled, held, ratio).collect()}
        always = true | {p for p in every if p[0] in ("S1-3", "S1-7")}
        assert always <= set(kept) and all(v == (p[0] in ("S1-3", "S1-7")) for p, v in kept.items())
        assert {0.0: len(kept) == len(always), 0.3: len(always) + 40 < len(kept) < len(always) + 140, 1.0: len(kept) == len(every)}[ratio]
        assert kept == {(r.s1_id, r.cand_id): r.is_val for r in labels.sample_negatives(labelled.repartition(7), held, ratio).collect()}


def test_halves_are_drawn_from_each_stratum(spark):
    rows = [(f"S1-{i}", i % 7) for i in range(700)]
    drawn = labels.stratified_halves(spark.createDataFrame(rows, "entity_id string, degree long").repartition(5), 70).collect()
    sizes = {k: sum(min(d, 4) == k for _, d in rows) for k in range(5)}
    for k in range(5):
        own = [r.half for r in drawn if r.stratum == k]
        assert len(own) == math.ceil(sizes[k] * 70 / 700) and abs(own.count("tuning") - own.count("calibration")) <= 1
    assert len({r.entity_id for r in drawn}) == len(drawn)
    assert labels.stratified_halves(spark.createDataFrame([], "entity_id string, degree long"), 10).count() == 0


def test_labels_and_degrees_by_text_equal_all_pairs(spark):
    rng = random.Random(2)
    rows = [(f"S{1 + i % 3}-{i}", rng.choice("abcdefgh") if i % 9 else None) for i in range(90)]
    df = spark.createDataFrame(rows, "entity_id string, h string")
    s1, pool = df.where("entity_id like 'S1%'"), df.where("entity_id not like 'S1%'")
    truth = labels.truth_by_text(s1, pool)
    key = lambda x: {(r.entity_id, r.degree) for r in x.collect()}
    assert key(labels.degrees_by_text(s1, pool)) == key(labels.degrees(s1, truth))
    both = s1.selectExpr("entity_id as s1_id", "h as h_1").crossJoin(pool.selectExpr("entity_id as cand_id", "h as h_2"))
    assert set(labels.label_by_text(both).where("is_match = 1").select("s1_id", "cand_id").collect()) == set(truth.collect())


def test_medians_move_only_the_values_of_the_middle_bins(spark):
    """Grouping all rows by value moves nearly all of them where values are mostly distinct."""
    rows = [(g, None if k % 7 == 0 else (k * 7919 % 10007) / 9000 - 0.05) for g in "ab" for k in range(3000 + 501 * (g == "b"))]
    found = quality.medians(spark.createDataFrame(rows, "g string, v double"), ["g"], "v")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and not re.search(r"Aggregate \[g#\d+, v#\d+\]", plan)
    assert {r.g: r["median"] for r in found.collect()} == {g: statistics.median(v for h, v in rows if h == g and v is not None) for g in "ab"}


def test_medians_are_exact(spark):
    rng = random.Random(4)
    rows = [(g, rng.choice([0.0, 1.0, rng.random(), rng.random() / 1e4, 2.5, -3.0, None])) for g in "abcdefg" for _ in range(rng.randint(1, 60))] + [("none", None)]
    got = {r.g: r["median"] for r in quality.medians(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()}
    held = {g: [v for x, v in rows if x == g and v is not None] for g, _ in rows}
    assert got == pytest.approx({g: statistics.median(v) for g, v in held.items() if v})


def f05(p, t):
    if not p and not t:
        return 1.0
    hits = len(p & t)
    precision, recall = (hits / len(p) if p else 1.0), (hits / len(t) if t else 1.0)
    return 1.25 * precision * recall / (0.25 * precision + recall) if precision + recall and hits else 0.0


def test_f_half_equals_an_independent_formula(spark):
    rng = random.Random(1)
    sets = [({i for i in range(80) if rng.random() < 0.08}, {i for i in range(80) if rng.random() < 0.08}) for _ in range(1000)]
    sets += [(set(), set()), ({5}, set()), (set(), {5}), ({5, 6}, {5, 6})]
    df = spark.createDataFrame([(i, len(p), len(t), len(p & t)) for i, (p, t) in enumerate(sets)], "i int, p long, t long, h long")
    got = [r[0] for r in df.orderBy("i").select(f_half(F.col("p"), F.col("t"), F.col("h"))).collect()]
    assert got == pytest.approx([f05(*s) for s in sets], abs=1e-12)
    assert got[1000:] == [1.0, 0.0, 0.0, 1.0]


def test_populations_must_agree(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "entity_id string") for xs in (["a", "b"], ["a", "c"]))
    evaluate.require_same_population(a, a)
    with pytest.raises(ValueError, match="populations differ"):
        evaluate.require_same_population(a, b)


def test_sweep_equals_plain_counts(spark):
    rng = random.Random(11)
    true = {f"e{i}": {f"c{rng.randint(0, 14)}" for _ in range(rng.choice([0, 0, 1, 2, 5]))} for i in range(40)}
    rows = []
    for e in list(true)[:35]:  # five entities have no candidates
        own = rng.sample([f"c{j}" for j in range(15)], rng.randint(1, 12))
        rows += [(e, c, k, round(rng.random(), 3), int(c in true[e])) for k, c in enumerate(own)]
    scored = spark.createDataFrame(rows, "s1_id string, cand_id string, cand_rank int, proba double, is_match int").repartition(6)
    degrees = spark.createDataFrame([(e, len(t)) for e, t in true.items()], "entity_id string, degree long")
    cutoffs, grid = [7, 2, 4], [0.2, 0.45, 0.451, 0.9]
    got = {(r.topk, r.threshold): r for r in evaluate.sweep(degrees, scored, cutoffs, grid).collect()}
    assert len(got) == 12
    for (k, t), r in got.items():
        near = [x for x in rows if x[2] < k]
        picked = {e: {c for s, c, _, p, _ in near if s == e and p >= t} for e in true}
        assert r.macro_f05 == pytest.approx(sum(f05(picked[e], true[e]) for e in true) / 40)
        assert r.avg_candidates_per_s1 == pytest.approx(len(near) / 40)
        assert r.candidate_recall == pytest.approx(sum(x[4] for x in near) / sum(map(len, true.values())))
    assert {r.topk: (r.kept, r.hits) for r in evaluate.recall_at(scored, degrees, cutoffs).collect()} == {
        k: (sum(x[2] < k for x in rows), sum(x[4] for x in rows if x[2] < k)) for k in cutoffs
    }
    nothing = evaluate.sweep(degrees.limit(0), scored.limit(0), [3], [0.5]).first()
    assert nothing.macro_f05 == 0.0 and nothing.candidate_recall == 1.0


def test_choice_of_the_operating_point(spark):
    schema = "topk int, threshold double, macro_f05 double, avg_candidates_per_s1 double, candidate_recall double"
    point = lambda *rows: tuple(evaluate.choose(spark.createDataFrame(list(rows), schema)).first()[:2])
    best = (80, 0.3, 0.7, 60.0, 0.8)
    assert point(best, (40, 0.3, 0.6951, 30.0, 0.7)) == (40, 0.3)  # near enough, with fewer candidates
    assert point(best, (40, 0.3, 0.6949, 30.0, 0.7)) == (80, 0.3)
    assert point(best, (90, 0.3, 0.7, 60.0, 0.9)) == (90, 0.3) and point(best, (70, 0.3, 0.699, 60.0, 0.8)) == (80, 0.3)
    assert point(best, (80, 0.2, 0.7, 60.0, 0.8), (80, 0.1, float("nan"), 1.0, 1.0)) == (80, 0.2)
    with pytest.raises(ValueError, match="no operating point"):
        evaluate.choose(spark.createDataFrame([], schema))


def registry(spark):
    """Firms of three countries, each with up to eight differently written copies in the pool."""
    rng = random.Random(6)
    s1, pool = [], []
    for i in range(50):
        name = f"{rng.choice(['Harbour', 'Velvet', 'Copper', 'Maple'])} {rng.choice(['Tools', 'Books', 'Lamps'])} {i * 7}"
        addr, country = f"{i + 3} {rng.choice(['Mill', 'Station', 'Church'])} Road", ("Peru", "Kenya", "Japan")[i % 3 if i < 45 else 0]
        s1.append((f"S1-{i:03d}", f"{name} Ltd", addr, country))
        for j in range(i % 9):
            written = (f"{name.upper()}", f"{name} LLC", f"{name} & Sons")[j % 3]
            pool.append((f"S{2 + j % 2}-{i:03d}{j}", written, "" if j == 5 else addr.lower(), country))
    return spark.createDataFrame(s1, src.RECORD), spark.createDataFrame(pool, src.RECORD)


def test_end_to_end_by_the_rule(spark, tmp_path):
    s1, pool = registry(spark)
    for name, df in (("s1", s1), ("s2", pool.where("entity_id like 'S2-%'")), ("s3", pool.where("entity_id like 'S3-%'"))):
        src.write_tsv(df, str(tmp_path / name))
    argv = [x for n in ("s1", "s2", "s3") for x in (f"--{n}", str(tmp_path / n))]
    argv += ["--work", str(tmp_path / "work"), "--out", str(tmp_path / "out"), "--threshold", "0.9", "--single"]
    assert linkage.main(argv) == 0
    written = (tmp_path / "work/scored/_manifest.json").stat().st_mtime_ns
    assert linkage.main(argv) == 0  # the scored stage is complete and skipped
    assert (tmp_path / "work/scored/_manifest.json").stat().st_mtime_ns == written
    matching = src.read_tsv(spark, str(tmp_path / "out/matching_results.tsv"), src.TRUTH).collect()
    candidate = {r[0]: set(r[1].split(",")) for r in src.read_tsv(spark, str(tmp_path / "out/candidate_pairs.tsv"), src.TRUTH).collect()}
    assert len(matching) == len(candidate) == 50
    for r in matching:
        ids = [i for i in r[1].split(",") if i]
        assert len(ids) == len(set(ids)) and set(ids) <= candidate[r[0]]
    assert any(r[1] for r in matching)
    lines = (tmp_path / "out/matching_results.tsv").read_bytes().decode().split("\n")
    assert len(lines) == 52 and lines[-1] == "" and not any("\r" in x for x in lines)  # one file: a header, a line a row
    header = lines[0]
    files = ["validate", "--matching", str(tmp_path / "out/matching_results.tsv"), "--candidate", str(tmp_path / "out/candidate_pairs.tsv"), "--s1", str(tmp_path / "s1")]
    pool_files = ["--s2", str(tmp_path / "s2"), "--s3", str(tmp_path / "s3")]
    assert commands.main([*files, *pool_files]) == 0
    rows = {x.split("\t")[0]: x for x in (tmp_path / "out/candidate_pairs.tsv").read_text().split("\n")[1:-1]}
    in_order = "\n".join(["source1_entity_id\tcandidate_entity_ids", *[rows[x.split("\t")[0]] for x in lines[1:-1]], ""])
    (tmp_path / "aligned.tsv").write_text(in_order)
    files[4] = str(tmp_path / "aligned.tsv")
    assert commands.main([*files, "--aligned"]) == 0
    swapped = in_order.split("\n")
    swapped[3], swapped[9] = swapped[9], swapped[3]
    (tmp_path / "aligned.tsv").write_text("\n".join(swapped))
    assert commands.main(files) == 0 and commands.main([*files, "--aligned"]) == 1
    (tmp_path / "aligned.tsv").write_text(in_order.replace("\t", ",", 1))
    assert commands.main(files) == 1  # the header
    (tmp_path / "aligned.tsv").write_text("\n".join(in_order.split("\n")[:-2]))
    assert commands.main(files) == 1  # an entity is missing
    assert quality.header_errors(header, ("source1_entity_id", "matched_entity_ids")) == []
    assert quality.header_errors("a,b", ("a", "b")) and quality.header_errors("a\tc", ("a", "b"))


def test_validator_finds_each_violation(spark):
    s1 = spark.createDataFrame([(f"S1-{c}",) for c in "pqrs"], "entity_id string")
    pool = spark.createDataFrame([("S2-k",), ("S3-k",)], "entity_id string")
    m = spark.createDataFrame([("S1-p", "S3-k, S3-k,S2-k"), ("S1-p", "S2-k"), ("S1-q", "S1-r,Q-1"), ("S1-r", "S3-z"), ("S1-new", "")], src.TRUTH)
    c = spark.createDataFrame([("S1-p", "S2-k,S3-k"), ("S1-q", ""), ("S1-r", ""), ("S1-s", " ")], "source1_entity_id string, candidate_entity_ids string")
    got = {r.rule: (r.n, r.examples) for r in quality.validate(m, c, s1, pool).collect()}
    assert got == {
        "matching_duplicate_row": (1, "S1-p"), "matching_duplicate_id": (2, "S1-p>S2-k,S1-p>S3-k"), "matching_self_match": (1, "S1-q>S1-r"),
        "matching_wrong_prefix": (1, "S1-q>Q-1"), "matching_unknown_id": (3, "S1-q>Q-1,S1-q>S1-r,S1-r>S3-z"), "matching_missing_entity": (1, "S1-s"),
        "matching_extra_entity": (1, "S1-new"), "subset": (3, "S1-q>Q-1,S1-q>S1-r,S1-r>S3-z"),
    }


def test_trees_train_save_and_carry_their_settings(spark, tmp_path):
    s1, pool = registry(spark)
    run = linkage.Linkage(s1, pool, linkage.Config(topk=50, proxy="mean"))
    truth = run.s1.selectExpr("entity_id as s1_id", "substr(entity_id, 4) as i").join(run.pool.selectExpr("entity_id as cand_id", "substr(entity_id, 4, 3) as i"), "i").drop("i")
    config = linkage.train(spark, run, truth, [5, 10], str(tmp_path / "model"), rounds=8)
    assert config.topk in (5, 10) and 0.1 <= config.threshold <= 0.94
    path = str(tmp_path / "config.json")
    src.write_config(spark, path, config.as_dict())
    assert linkage.Config.of(src.read_config(spark, path)) == config
    scored = model.predict(model.load(str(tmp_path / "model")), run.features)
    assert scored.where("proba between 0 and 1").count() == run.features.count()
    assert scored.where("missing_address_flag = 1 and addr_cos is not null").count() == 0
    assert [c for c in features.FEATURES if c not in scored.columns] == []


def test_validation_ends_the_training_of_trees(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1000):
        x = [rng.random() for _ in features.FEATURES]
        rows.append((f"S1-{i}", f"S2-{i}", int(x[0] + x[1] * x[2] + 0.4 * rng.random() > 0.95), *x))
    frame = spark.createDataFrame(rows, ["s1_id", "cand_id", "is_match", *features.FEATURES]).persist()
    trees = model.fit(frame, rounds=model.ROUNDS, depth=3, tolerance=0.0).stages[-1].getNumTrees
    assert 20 < trees < model.ROUNDS


def test_commands_train_and_gates(spark, tmp_path):
    s1, pool = registry(spark)
    base = tmp_path / "data/train"
    base.mkdir(parents=True)
    truth = s1.selectExpr("entity_id as s", "substr(entity_id, 4) as i").join(pool.selectExpr("entity_id as c", "substr(entity_id, 4, 3) as i"), "i", "left")
    lists = truth.groupBy("s").agg(F.array_join(F.collect_list("c"), ",").alias("m")).toDF(*src.TRUTH.names)
    tables = {"source1": s1, "source2": pool.where("entity_id like 'S2-%'"), "source3": pool.where("entity_id like 'S3-%'"), "ground_truth": lists}
    for name, df in tables.items():
        src.write_tsv(df, str(base / f"train_{name}.tsv"), single=True)
    found = src.dataset(spark, str(tmp_path / "data"), "train")
    assert sorted(found) == ["s1", "s2", "s3", "truth"] and src.dataset(spark, str(base), "train") == found
    with pytest.raises(FileNotFoundError):
        src.dataset(spark, str(tmp_path / "data"), "test")
    data = ["--data", str(tmp_path / "data"), "--cutoffs", "5,20"]
    assert commands.main(["gates", *data]) == 0
    assert commands.main(["train", *data, "--work", str(tmp_path / "work"), "--negatives", "1", "--rounds", "4"]) == 0
    assert linkage.Config.of(src.read_config(spark, str(tmp_path / "work/config.json"))).topk in (5, 20)
    assert commands.main(["train", "--sample", "--work", str(tmp_path / "work"), "--rounds", "2"]) == 0
    assert (tmp_path / "work/synth/config.json").exists() and (tmp_path / "work/synth/model").is_dir()


def test_stage_state(spark, tmp_path):
    calls, out = [], tmp_path / "top/made"

    def build(path):
        calls.append(path)
        spark.range(len(calls) * 10).coalesce(1).write.parquet(path)
        return len(calls) * 10

    run = lambda config: stages.run_stage(spark, str(out), str(tmp_path / "top"), "made", config, build)
    assert run({"cap": [1, 2]}) and not run({"cap": [1, 2]}) and run({"cap": [1, 3]}) and not run({"cap": [1, 3]})
    part = next(out.glob("part-*"))
    part.write_bytes(part.read_bytes() + b"more")
    assert run({"cap": [1, 3]}) and len(calls) == 3
    store = Store(spark)
    held = json.loads(store.read(str(out / stages.MANIFEST)))
    assert held["total_rows"] == 30 and [f["path"] for f in held["files"]] == [p.name for p in out.glob("part-*")]
    (out / stages.MANIFEST).write_text("no manifest")
    assert not stages.complete(store, str(out), "made", {"cap": [1, 3]})
    for path in ("top", "top/../made", "elsewhere/made"):
        with pytest.raises(ValueError, match="not inside"):
            stages.guarded(store, str(tmp_path / path), str(tmp_path / "top"))
    with pytest.raises(ValueError, match="no output"):
        stages.finish(store, str(tmp_path / "top/none"), "made", {}, 0)
    (tmp_path / "x").write_bytes(b"some bytes")
    assert store.sha256(str(tmp_path / "x")) == hashlib.sha256(b"some bytes").hexdigest()


def test_sources_round_trip(spark, tmp_path):
    rows = [("S1-1", 'the "A" co', "", "US"), ("S1-2", "N/A", "x", "France")]
    src.write_parquet(spark.createDataFrame(rows, src.RECORD).repartition(2), str(tmp_path / "p"))
    assert sorted(map(tuple, src.read_parquet(spark, str(tmp_path / "p")).collect())) == rows
    (tmp_path / "t.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"the ""A"" co"\t\tUS\nS1-2\tN/A\tx\tFrance\n')
    assert sorted(map(tuple, src.read_tsv(spark, str(tmp_path / "t.tsv")).collect())) == rows
    (tmp_path / "ids").write_text("S1-1\nS1-2\n\n")
    assert [r[0] for r in src.read_ids(spark, str(tmp_path / "ids")).collect()] == ["S1-1", "S1-2"]


def test_stream_of_new_records(spark, tmp_path):
    s1, pool = registry(spark)
    run = linkage.Linkage(s1, pool)
    src.write_parquet(pool.limit(40), str(tmp_path / "in"))
    got = []
    stream = spark.readStream.schema(src.RECORD).parquet(str(tmp_path / "in"))
    q = incremental.follow(stream, run.s1_keys, run.key_df, lambda df, n: got.extend(df.collect()), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    want = blocking.top_k(blocking.evidence(run.s1_keys, blocking.keys(src.normalize(pool.limit(40))), run.key_df), "score", 50).count()
    assert len(got) == want > 0


def test_queries_keep_pairs_beyond_small_caps(spark, tmp_path):
    from kinweave.plans.queries import QUERIES

    rows = [(i, " ".join([f"a{i}", "common", *[f"{c}{i}" for c in "bcdefghijkl"]]), "en", "src", 1000 + i) for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    wanted = {(f"S1-{i}", "S2-" + str(j) if j % 5 < 3 else f"S3-{j}") for i in range(0, 100, 5) for j in range(100) if j % 5}
    assert {(r.s1_id, r.cand_id) for r in QUERIES["candidate_evidence"](spark, str(tmp_path)).collect()} == wanted
    assert QUERIES["allowed_keys"](spark, str(tmp_path)).where("value = 'common'").first().df == 80
    small = linkage.Linkage.from_documents(spark, str(tmp_path), linkage.Config(blocking.Caps(t=50, a=50, sn=50, fn=50, c3=50)))
    assert small.evidence.count() < len(wanted)


def test_edit_features_of_all_ranked_pairs_with_accents(spark, tmp_path):
    from kinweave.plans.queries import QUERIES

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    names = ["café zürich größe naïve señor", "cafe zurich große naive senor", "café münchen straße über élan", "plain cafe without any accent"]
    rows = [(i, f"{names[i % 4]} street number park lane {i}", "de", "src", 100) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    name = {r.entity_id: r.business_name for r in src.entity_view(docs).collect()}
    got = QUERIES["levenshtein_features"](spark, str(tmp_path)).collect()
    assert {(r.s1_id, r.cand_id) for r in got} == {(a, b) for a in name for b in name if a[:2] == "S1" and b[:2] != "S1"}
    for r in got:
        a, b = name[r.s1_id], name[r.cand_id]
        assert r.lev_name_raw == pytest.approx(1 - distance(a, b) / max(len(a), len(b)), abs=1e-6)


def test_entry_points(spark, sf):
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 50
    assert entry.entry(spark).count() > 0
    for name in itertools.islice(queries, 3):
        assert queries[name](spark, sf).count() > 0
