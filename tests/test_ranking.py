"""The ranking by blocks against the plain path over all pairs."""

from pyspark.sql import functions as F

from kinweave.functions.scores import round_scaled
from kinweave.operators import blocking, features, ranking, similarity
from kinweave.plans.linkage import Config, Linkage


def test_blocks_and_ranges_equal_all_pairs(spark, tmp_path):
    words = "acme north star trade blue river stone global mill garden".split()
    text = lambda i: " ".join(words[(i * k + k) % 10] for k in (1, 3, 7, 9, i % 7 + 1)) + (f" {i % 9} rue {words[i % 10]} {words[i % 4]}" if i % 6 else "")
    rows = [(i, None if i == 50 else text(i % 90), "en" if i % 4 else "fr", i % 30) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    run = Linkage.from_documents(spark, str(tmp_path), Config(blocking.Caps(60, 60, 60, 60, 60), max_candidates=7, topk=5, proxy="mean"))
    key = lambda df: sorted(map(tuple, df.select("s1_id", "cand_id", "name_cos", "addr_cos", "proxy", "cand_rank").collect()))
    kept = blocking.allowed(run.key_df, run.config.caps)
    vectors = [similarity.vectors(x, run.idf) for x in (run.s1, run.pool)]
    for proxy, k in (("mean", 5), ("max", 3), ("mean", 0)):
        want = key(similarity.rank_by_proxy(run.pairs, proxy, k))
        assert want and key(run.rank(proxy, k)) == want
        # ties at the edge of seven candidates lie in several ranges of ids
        assert key(ranking.rank(run.s1, run.pool, kept, *vectors, 7, proxy, k, pool_rows=40, s1_rows=9)) == want
    plain = features.features(similarity.with_sides(similarity.rank_by_proxy(run.pairs, "mean", 5).drop("addr_n_1", "addr_n_2"), features.bags(run.s1), features.bags(run.pool), features.SIDE))
    vector = lambda df: sorted(map(repr, df.select("s1_id", "cand_id", *features.FEATURES, "cand_rank").collect()))
    assert vector(run.features) == vector(plain)

    edits = ["lev_name_raw", "lev_name_norm", "lev_name_strip", "lev_addr", "lev_proxy"]
    levs = lambda df: sorted(map(repr, df.select("s1_id", "cand_id", "cand_rank", *edits).collect()))
    texts = ranking.Extras(texts=features.EDITED)
    split = ranking.rank(run.s1, run.pool, kept, *vectors, 7, "mean", 5, texts, pool_rows=40, s1_rows=9, finish=features.edit_features)
    want = levs(features.edit_features(run.sides))
    assert levs(run.edits) == want and levs(split) == want
    above = run.edits._jdf.queryExecution().optimizedPlan().toString().split("FlatMapCoGroups")[0]
    assert "Join" not in above and "Window" not in above  # pairs are not joined with their texts


def test_halves_round_as_sql_does(spark):
    import duckdb

    pairs = [(0.811139396, 0.257048585), (0.5195755, 0.5195755), (0.25, 0.125)]
    df = spark.createDataFrame(pairs, "a double, b double")
    got = df.select(round_scaled((F.col("a") + F.col("b")) / 2, 9), round_scaled(F.col("a"), 6)).collect()
    assert [tuple(r) for r in got] == [duckdb.sql(f"select round(({a}::double + {b}::double) / 2, 9), round({a}::double, 6)").fetchall()[0] for a, b in pairs]


def test_pools_are_split_by_country_and_leave_in_pieces(spark, monkeypatch):
    rows = [(f"S2-{i:03}", "en" if i < 100 else "fr") for i in range(160)] + [("S2-x", None)]
    pool = spark.createDataFrame(rows, "entity_id string, country string")
    assert ranking._ranges(pool, 100) == {}  # no country has more, though all have together
    bounds = ranking._ranges(pool, 40)
    assert {c: len(ids) for c, ids in bounds.items()} == {"en": 2, "fr": 1}
    starts = ["", *bounds["en"], "T"]
    assert all(0 < sum(a <= i < b for i, c in rows if c == "en") <= 40 for a, b in zip(starts, starts[1:]))

    import pyarrow as pa

    monkeypatch.setattr(ranking, "PIECE", 4)
    sides = [("0:0:en", 0)] * 3 + [("0:0:en", 1)] * 11 + [("0:1:fr", 1)] * 2
    table = pa.table({"block": [b for b, _ in sides], "side": pa.array([s for _, s in sides], pa.int32()), "n": list(range(16))})
    pieces = [(b, s, t["n"].to_pylist()) for b, s, t in ranking._pieces(iter(table.to_batches(max_chunksize=2)))]
    assert sum((n for *_, n in pieces), []) == list(range(16))
    assert pieces[0] == ("0:0:en", 0, [0, 1, 2]) and pieces[-1] == ("0:1:fr", 1, [14, 15]) and max(len(n) for *_, n in pieces) <= 5
