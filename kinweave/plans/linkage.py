"""The linkage plan: from records to candidates, features, scores, matches and result lists."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators import blocking, evaluate, features, labels, model, quality, ranking, similarity
from kinweave.plans.stages import run_stage
from kinweave.sources import entities as src


@dataclass(frozen=True)
class Config:
    """Settings that training passes on to inference."""

    caps: blocking.Caps = field(default_factory=blocking.Caps)
    max_candidates: int = 2000
    topk: int = model.RULE["topk"]
    proxy: str = model.RULE["proxy"]
    threshold: float = model.RULE["threshold"]

    def as_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def of(cls, values: dict) -> Config:
        return cls(**{**values, "caps": blocking.Caps(**values["caps"])}) if "caps" in values else cls(**values)


class Linkage:
    """Lazy tables of one run; each is a plan, and nothing runs before an action."""

    def __init__(self, s1: DataFrame, pool: DataFrame, config: Config = Config()):
        # read by the keys, the frequencies, the weights and the features alike; spills to disk
        self._set(src.normalize(s1).persist(), src.normalize(pool).persist(), config)

    def _set(self, s1: DataFrame, pool: DataFrame, config: Config) -> None:
        self.s1, self.pool, self.config = s1, pool, config

    @classmethod
    def of_normalized(cls, s1: DataFrame, pool: DataFrame, config: Config) -> Linkage:
        """The same tables under other settings."""
        out = cls.__new__(cls)
        out._set(s1, pool, config)
        return out

    @classmethod
    def from_documents(cls, spark: SparkSession, sf_dir: str, config: Config = Config()) -> Linkage:
        view = src.entity_view(spark.read.parquet(f"{sf_dir}/documents.parquet"))
        return cls(view.where("src = 'S1'"), src.pool(view.where("src = 'S2'"), view.where("src = 'S3'")), config)

    def unpersist(self) -> None:
        """Let go of the tables that were kept for several steps."""
        for df in (self.s1, self.pool, *[self.__dict__[k] for k in ("features", "labelled", "kept", "idf") if k in self.__dict__]):
            df.unpersist()

    @cached_property
    def s1_keys(self) -> DataFrame:
        return blocking.keys(self.s1)

    @cached_property
    def pool_keys(self) -> DataFrame:
        return blocking.keys(self.pool)

    @cached_property
    def key_df(self) -> DataFrame:
        return blocking.frequencies(self.pool_keys)

    @cached_property
    def evidence(self) -> DataFrame:
        return blocking.evidence(self.s1_keys, self.pool_keys, blocking.allowed(self.key_df, self.config.caps))

    @cached_property
    def candidates(self) -> DataFrame:
        return blocking.prefilter(self.evidence, self.config.max_candidates)

    @cached_property
    def kept(self) -> DataFrame:
        """Keys within their caps; read by each block side that is ranked."""
        return blocking.allowed(self.key_df, self.config.caps).persist()

    @cached_property
    def idf(self) -> DataFrame:
        """Read by the vectors of both sides, and a fraction of the terms that it is counted from."""
        return similarity.idf(self.pool).persist()

    def prepared(self, entities: DataFrame) -> DataFrame:
        """Entities with their token sets and vectors, made once for all of their pairs."""
        return features.bags(entities).join(similarity.vectors(entities, self.idf), "entity_id", "left")

    @cached_property
    def pairs(self) -> DataFrame:
        """Candidates with their cosines: only the vectors go to all of them."""
        vectors = [x.select("entity_id", "addr_n").join(similarity.vectors(x, self.idf), "entity_id", "left") for x in (self.s1, self.pool)]
        sides = similarity.with_sides(self.candidates.select("s1_id", "cand_id"), *vectors, ["addr_n", "name_v", "addr_v"])
        return similarity.cosines(sides).drop(*[f"{c}_{n}" for c in ("name_v", "addr_v") for n in (1, 2)])

    @cached_property
    def ranked(self) -> DataFrame:
        return self.rank(self.config.proxy, self.config.topk)

    def rank(self, proxy: str, k: int, extras: ranking.Extras = ranking.Extras(), finish: Callable[[DataFrame], DataFrame] = lambda pairs: pairs) -> DataFrame:
        """The k best candidates of each S1 entity by a proxy, without a list of all candidates; counts the pool first."""
        vectors = [similarity.vectors(x, self.idf) for x in (self.s1, self.pool)]
        sides = [features.measures(x) if extras.bags else x for x in (self.s1, self.pool)]
        most = {"pool_rows": ranking.POOL_ROWS // 4, "s1_rows": ranking.S1_ROWS // 4} if extras.texts else {}  # texts are held whole, and pairs with them are some four times as long
        return ranking.rank(*sides, self.kept, *vectors, self.config.max_candidates, proxy, k, extras, finish=finish, **most)

    def compared(self, labelled: bool) -> DataFrame:
        """Ranked pairs with their features, and with is_match where texts tell it."""
        extras = features.COMPARED
        if labelled:
            extras = replace(extras, same=(*extras.same, "h"))
        pairs = features.features_of_compared(self.rank(self.config.proxy, self.config.topk, extras))
        label = [F.coalesce("same_h", F.lit(0)).alias("is_match")] if labelled else []
        return pairs.select("s1_id", "cand_id", *features.FEATURES, "cand_rank", *label).persist()

    @cached_property
    def sides(self) -> DataFrame:
        """The ranked pairs with both sides' columns, which those that were cut need not have."""
        columns = [c for c in [*features.SIDE, "business_name", "name_n", "h"] if c != "h" or "h" in self.s1.columns]
        return similarity.with_sides(self.ranked, features.bags(self.s1), features.bags(self.pool), columns)

    @cached_property
    def edits(self) -> DataFrame:
        """Ranked pairs with their edit features; texts come with the pairs from the blocks and go no further."""
        drop = [f"{c}_{n}" for c in features.EDITED for n in (1, 2)]
        extras = ranking.Extras(texts=features.EDITED)
        return self.rank(self.config.proxy, self.config.topk, extras, lambda pairs: features.edit_features(pairs).drop(*drop))

    @cached_property
    def features(self) -> DataFrame:
        if "h" in self.s1.columns:  # the labelled pairs are the same ones
            return self.labelled.drop("is_match")
        return self.compared(False)

    @cached_property
    def truth(self) -> DataFrame:
        return labels.truth_by_text(self.s1, self.pool)

    @cached_property
    def degrees(self) -> DataFrame:
        return labels.degrees_by_text(self.s1, self.pool)

    @cached_property
    def labelled_sides(self) -> DataFrame:
        return labels.label_by_text(self.sides)

    @cached_property
    def labelled_candidates(self) -> DataFrame:
        """All candidates before the cut, with their labels."""
        hashes = [x.select("entity_id", "h") for x in (self.s1, self.pool)]
        return labels.label_by_text(similarity.with_sides(self.candidates, *hashes, ["h"])).drop("h_1", "h_2")

    @cached_property
    def labelled(self) -> DataFrame:
        return self.compared(True)

    @cached_property
    def scored(self) -> DataFrame:
        """Labelled pairs with the rule's score."""
        return self.labelled.withColumn("proba", model.rule_score())

    @cached_property
    def matches(self) -> DataFrame:
        return model.matches(self.scored, self.config.threshold, self.config.topk)

    def results(self, matches: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """Matching and candidate lists, one row per S1 id."""
        found = self.matches if matches is None else matches
        return (src.result_lists(self.s1, found, "matched_entity_ids"), src.result_lists(self.s1, self.features, "candidate_entity_ids"))


def train(
    spark: SparkSession, linkage: Linkage, truth: DataFrame, cutoffs: list[int], model_path: str, validation_share: float = 0.18, negatives: float = 1.0, rounds: int = model.ROUNDS
) -> Config:
    """Fit trees on the entities outside the validation share, sweep on the others and save the model.

    The configuration with the chosen cutoff and threshold goes to inference.
    """
    known = labels.known_truth(truth, linkage.s1, linkage.pool)
    held = labels.sample_ids(linkage.s1, validation_share)
    sampled = labels.sample_negatives(labels.label(linkage.features, known), held, negatives).persist()
    fitted = model.fit(sampled.where("is_val = 0").drop("is_val"), rounds)
    model.save(fitted, model_path)
    scored = model.predict(fitted, sampled.where("is_val = 1").drop("is_val"))
    degrees = labels.degrees(held, known)
    best = evaluate.choose(evaluate.sweep(degrees, scored, cutoffs)).first()
    sampled.unpersist()
    return Config(linkage.config.caps, linkage.config.max_candidates, best["topk"], linkage.config.proxy, best["threshold"])


def main(argv: list[str] | None = None) -> int:
    """Link three tab-separated sources by the rule, or by a model, and write and check both result files."""
    p = argparse.ArgumentParser(prog="python -m kinweave.plans.linkage")
    for name in ("s1", "s2", "s3", "work", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config", help="JSON settings, as training writes them")
    p.add_argument("--model", help="a saved model; the rule without")
    p.add_argument("--threshold", type=float)
    p.add_argument("--s1-limit", type=int, default=0)
    p.add_argument("--single", action="store_true", help="each result as one file, not a folder of parts")
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.adaptive.enabled", "true").getOrCreate()
    config = Config.of(src.read_config(spark, a.config)) if a.config else Config()
    if a.threshold is not None:
        config = Config(config.caps, config.max_candidates, config.topk, config.proxy, a.threshold)
    s1 = src.head(src.read_tsv(spark, a.s1), "entity_id", a.s1_limit)
    run = Linkage(s1, src.pool(src.read_tsv(spark, a.s2), src.read_tsv(spark, a.s3)), config)
    settings = {**json.loads(json.dumps(config.as_dict())), "s1_limit": a.s1_limit, "inputs": [a.s1, a.s2, a.s3], "model": a.model}

    def build(path: str) -> int:
        table = run.features.withColumn("proba", model.rule_score()) if not a.model else model.predict(model.load(a.model), run.features)
        src.write_parquet(table, path)
        return spark.read.parquet(path).count()

    run_stage(spark, f"{a.work}/scored", a.work, "scored", settings, build)
    table = src.read_parquet(spark, f"{a.work}/scored")
    matching = src.result_lists(run.s1, model.matches(table, config.threshold, config.topk), "matched_entity_ids")
    candidate = src.result_lists(run.s1, table, "candidate_entity_ids")
    src.write_tsv(matching, f"{a.out}/matching_results.tsv", a.single)
    src.write_tsv(candidate, f"{a.out}/candidate_pairs.tsv", a.single)
    problems = quality.validate(matching, candidate, run.s1, run.pool).collect()
    run.unpersist()
    for row in problems:
        print(row["severity"], row["rule"], row["n"], row["examples"])
    return int(any(row["severity"] == "error" for row in problems))


if __name__ == "__main__":
    raise SystemExit(main())
