"""Command line: train a model, run the gates, validate result files. Exit code 0: passed, 1: not.

python -m kinweave.plans.commands train --data ROOT --work FOLDER
python -m kinweave.plans.commands gates --data ROOT
python -m kinweave.plans.commands validate --matching FILE --candidate FILE --s1 FILE
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators import blocking, evaluate, labels, model, quality, similarity
from kinweave.operators.features import FEATURES
from kinweave.plans.linkage import Config, Linkage, train
from kinweave.sources import entities as src
from kinweave.sources.store import Store

#: Cap settings (tokens, address tokens, street numbers, whole names) that the blocking gate compares (fixed values).
GATE_CAPS = {"tight": (1000, 2000, 2000, 20000), "wide": (3000, 5000, 5000, 50000), "widest": (10000, 10000, 10000, 100000)}
#: Cutoffs of the recall table, and the least recall of a sound run (fixed values).
GATE_CUTOFFS, LEAST_RECALL = [100, 200, 300, 500], 0.02
HEADERS = {"matching": ("source1_entity_id", "matched_entity_ids"), "candidate": ("source1_entity_id", "candidate_entity_ids")}


def _inputs(spark: SparkSession, a: argparse.Namespace) -> tuple[Linkage, DataFrame]:
    paths = src.dataset(spark, a.data, "train")
    s1 = src.head(src.read_tsv(spark, paths["s1"]), "entity_id", a.s1_limit)
    run = Linkage(s1, src.pool(src.read_tsv(spark, paths["s2"]), src.read_tsv(spark, paths["s3"])), Config(topk=max(a.cutoffs), proxy=a.proxy))
    return run, src.explode_truth(src.read_tsv(spark, paths["truth"], src.TRUTH))


def synthetic_features(spark: SparkSession, rows: int = 20_000) -> DataFrame:
    """Labelled pairs of random features, to try the training without data."""
    draw = {c: F.rand(i) for i, c in enumerate(FEATURES)}
    pairs = spark.range(rows).select(F.concat(F.lit("S1-"), F.col("id") % 500).alias("s1_id"), F.concat(F.lit("S2-"), F.col("id")).alias("cand_id"), *[c.alias(k) for k, c in draw.items()])
    return pairs.withColumn("is_match", (F.col("name_jaccard_normalized") * 0.6 + F.col("addr_jaccard") * 0.4 > 0.75).cast("int"))


def run_train(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.sample:
        fitted = model.fit(synthetic_features(spark), rounds=min(a.rounds, 5))
        model.save(fitted, f"{a.work}/synth/model")
        config = Config()
        where = f"{a.work}/synth"
    else:
        run, truth = _inputs(spark, a)
        config = train(spark, run, truth, a.cutoffs, f"{a.work}/model", negatives=a.negatives, rounds=a.rounds)
        where = a.work
    src.write_config(spark, f"{where}/config.json", config.as_dict())
    print(json.dumps(config.as_dict()))
    return 0


def blocking_table(run: Linkage, truth: DataFrame) -> DataFrame:
    """Recall and volume of all candidates for each cap setting: setting, and the columns of blocking_recall."""
    degrees, out = labels.degrees(run.s1, truth), None
    for name, (t, a, sn, fn) in GATE_CAPS.items():
        kept = blocking.allowed(run.key_df, blocking.Caps(t=t, a=a, sn=sn, fn=fn))
        found = labels.label(blocking.evidence(run.s1_keys, run.pool_keys, kept), truth)
        row = evaluate.blocking_recall(run.pool, found, degrees).select(F.lit(name).alias("setting"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def recall_table(run: Linkage, truth: DataFrame, cutoffs: list[int]) -> DataFrame:
    """recall_at for each proxy and cap setting."""
    degrees, runs = labels.degrees(run.s1, truth), {}
    for name, (t, a, sn, fn) in GATE_CAPS.items():
        own = Linkage.of_normalized(run.s1, run.pool, Config(blocking.Caps(t=t, a=a, sn=sn, fn=fn), proxy=run.config.proxy))
        for proxy in similarity.PROXIES:
            runs[f"{name}, {proxy}"] = (labels.label(similarity.rank_by_proxy(own.pairs, proxy, max(cutoffs)), truth), degrees)
    return evaluate.recall_grid(runs, cutoffs)


def run_gates(spark: SparkSession, a: argparse.Namespace) -> int:
    run, truth = _inputs(spark, a)
    truth = labels.known_truth(truth, run.s1, run.pool)
    for r in blocking_table(run, truth).collect():
        print(json.dumps(r.asDict()))
    table = recall_table(run, truth, a.cutoffs).collect()
    for r in table:
        print(json.dumps(r.asDict()))
    sides = labels.label(run.sides, truth).where("is_match = 1")
    gain = quality.normalization_gain(sides.select("business_name_1", "business_name_2", *[F.array_join(f"t_bag_{n}", " ").alias(f"name_t_{n}") for n in (1, 2)]))
    print(json.dumps(gain.first().asDict()))
    verdict = quality.adversarial_gate(labels.label(run.features, truth)).first()
    print(json.dumps(verdict.asDict()))
    return int(max(r["recall"] for r in table) <= LEAST_RECALL or verdict["verdict"] == "FLAG")


def run_validate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Header, then the rules of quality.validate, and the order of rows if asked; warnings alone pass."""
    store, paths = Store(spark), {"matching": a.matching, "candidate": a.candidate}
    wrong = [(name, e) for name, path in paths.items() for e in quality.header_errors(store.first_line(path), HEADERS[name])]
    for name, e in wrong:
        print("error", f"{name}_header", e)
    if wrong:
        return 1
    tables = {name: src.read_tsv(spark, path, src.TRUTH).toDF(*HEADERS[name]) for name, path in paths.items()}
    pool = src.pool(src.read_tsv(spark, a.s2), src.read_tsv(spark, a.s3)) if a.s2 and a.s3 else None
    problems = quality.validate(tables["matching"], tables["candidate"], src.read_tsv(spark, a.s1), pool)
    if a.aligned:
        problems = problems.unionByName(quality.order_errors(*[src.numbered_lines(spark, path).where("number > 0") for path in paths.values()]))
    found = problems.orderBy("rule").collect()
    spark.catalog.clearCache()  # a later check must read the files anew
    for r in found:
        print(r["severity"], r["rule"], r["n"], r["examples"])
    return int(any(r["severity"] == "error" for r in found))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m kinweave.plans.commands")
    commands = p.add_subparsers(required=True)
    numbers = lambda text: [int(x) for x in text.split(",")]
    for name, f in (("train", run_train), ("gates", run_gates)):
        c = commands.add_parser(name)
        c.set_defaults(run=f)
        c.add_argument("--data", default="", help="folder of train_source1.tsv and so on, or of train/")
        c.add_argument("--cutoffs", type=numbers, default=GATE_CUTOFFS)
        c.add_argument("--proxy", choices=sorted(similarity.PROXIES), default="mean")
        c.add_argument("--s1-limit", type=int, default=0)
        if name == "train":
            c.add_argument("--work", required=True)
            c.add_argument("--negatives", type=float, default=0.05, help="share of negative pairs that training takes")
            c.add_argument("--rounds", type=int, default=model.ROUNDS)
            c.add_argument("--sample", action="store_true", help="random features, to try the plumbing")
    c = commands.add_parser("validate")
    c.set_defaults(run=run_validate)
    for name in ("matching", "candidate", "s1"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--s2", help="with --s3: unknown ids are errors too")
    c.add_argument("--s3")
    c.add_argument("--aligned", action="store_true", help="both files must have their rows in one order")
    a = p.parse_args(argv)
    return a.run(SparkSession.builder.config("spark.sql.adaptive.enabled", "true").getOrCreate(), a)


if __name__ == "__main__":
    raise SystemExit(main())
