"""Sources, sinks, the cache, providers, the incremental stream, and the whole pipeline on recorded replies."""

import json

import pytest
from pyspark.sql import functions as F

from quern import cli, schemas
from quern.config import load_config
from quern.operators import pairs as pr
from quern.sources import embedding_cache as ec
from quern.sources import files
from quern.sources import providers as pv
from quern.streaming.resume import run_incrementally, windowed_counts


def test_pairs_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('﻿concept_2,base_relation,extra,concept_1\nFrance,capital,1,"Paris\n""City"""\nFrance,capital,2,"Paris ""City"""\n', encoding="utf-8")
    pairs = pr.load_pairs(files.read_pairs_csv(spark, str(path))).collect()
    assert [(r["concept_1"], r["concept_2"]) for r in pairs] == [('Paris "City"', "France")]
    (tmp_path / "bad.csv").write_text("concept_1,concept_2\na,b\n")
    with pytest.raises(ValueError, match="base_relation"):
        files.read_pairs_csv(spark, str(tmp_path / "bad.csv"))
    with pytest.raises(FileNotFoundError):
        files.read_pairs_csv(spark, str(tmp_path / "none.csv"))


def test_jsonl_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("p", None, "é", "y")]
    files.write_jsonl(spark.createDataFrame(rows, schemas.CONCEPT_PAIR), path)
    files.append_jsonl(spark.createDataFrame([("q", "b", "x", "y")], schemas.CONCEPT_PAIR), path)
    lines = sorted(line for f in (tmp_path / "out").glob("*.json") for line in f.read_text(encoding="utf-8").splitlines())
    assert json.loads(lines[0]) == {"pair_id": "p", "base_relation": None, "concept_1": "é", "concept_2": "y"} and "é" in lines[0]
    assert sorted(r["pair_id"] for r in files.finished_ids(files.read_jsonl(spark, path, schemas.CONCEPT_PAIR)).collect()) == ["p", "q"]
    assert files.read_jsonl(spark, str(tmp_path / "missing"), schemas.CONCEPT_PAIR).count() == 0
    (tmp_path / "bad.json").write_text('{"pair_id": "x"}\n\n{broken\n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.json"), schemas.CONCEPT_PAIR).collect()


def test_review_round_trip(spark, tmp_path):
    row = {**dict.fromkeys(schemas.REVIEW_COLUMNS, ""), "pair_id": "p", "evidence_text": 'a "b", c\nd'}
    files.write_review_csv(spark.createDataFrame([row], schemas.REVIEW), str(tmp_path / "review"))
    part = next((tmp_path / "review").glob("part-*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbf")
    got = files.read_review_csv(spark, str(tmp_path / "review")).first()
    assert got["pair_id"] == "p" and got["evidence_text"] == 'a "b", c\nd' and got["final_decision"] == ""


def test_aliases(spark, tmp_path):
    path = tmp_path / "a.yaml"
    path.write_text("capital:\n  - is capital of\nLocated In: situated_in\nempty:\n")
    table = {r["variant"]: r["canonical"] for r in files.alias_table(spark, files.read_aliases(str(path))).collect()}
    assert table == {"capital": "capital", "is_capital_of": "capital", "located_in": "located_in", "situated_in": "located_in", "empty": "empty", "none": "empty"}
    assert files.read_aliases(str(tmp_path / "none.yaml")) == {}


def test_cache(spark):
    cache = ec.entries(spark.createDataFrame([("a", [1.0, 2.0])], "text string, vector array<float>"), "m")
    texts = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "text string")
    assert [r[0] for r in ec.missing_texts(texts, cache, "m").collect()] == ["b"]
    assert ec.missing_texts(texts, cache, "other").count() == 2
    for values in ([1.0, 3.0], [3.0, 1.0]):  # the last one counts, whatever it holds
        rows = [("a", [v]) for v in values] + [("c", [4.0])]
        new = ec.entries(spark.createDataFrame(rows, "text string, vector array<float>"), "m").withColumn("at", F.monotonically_increasing_id())
        assert {r["text_value"]: r["vector"] for r in ec.upserted(cache, new, "at").collect()} == {"a": [values[-1]], "c": [4.0]}
    broken = cache.withColumn("dimensions", F.lit(3))
    assert ec.corrupt(broken).count() == 1
    with pytest.raises(Exception, match="corrupt"):
        ec.lookup(texts, broken, "m", strict=True).collect()


def test_providers(spark):
    requests = spark.createDataFrame([("a",), ("b",)], "pair_id string")

    def provider(row):
        if row["pair_id"] == "b":
            raise KeyError("gone")
        return {"most_relevant": "x"}

    got = {r["pair_id"]: (r["most_relevant"], r["error"]) for r in pv.called(requests, provider, schemas.CHOICE, attempts=1).collect()}
    assert got["a"] == ("x", None) and got["b"][1].startswith("KeyError")
    tries = []
    with pytest.raises(ValueError):
        pv.with_retries(lambda: tries.append(1) or (_ for _ in ()).throw(ValueError()), attempts=3, pause=lambda s: None)
    assert len(tries) == 3
    recorded = spark.createDataFrame([("a", 1)], "pair_id string, n int")
    assert {r["pair_id"]: r["error"] for r in pv.replayed(requests, recorded, ["pair_id"]).collect()} == {"a": None, "b": "LookupError: no recorded reply"}
    vectors = pv.embedded(requests.withColumnRenamed("pair_id", "text"), lambda texts: [[float(len(t))] for t in texts], "m", batch_size=1)
    assert vectors.count() == 2 and vectors.first()["dimensions"] == 1


def test_pages(spark):
    pages = spark.createDataFrame([("A b", "text"), ("C", " ")], schemas.PAGE)
    queries = spark.createDataFrame([(1, "a  B"), (2, "zz")], "query_id int, query string")
    assert [tuple(r) for r in pv.search_titles(queries, pages).collect()] == [(1, "A b", 1)]
    assert [r["title"] for r in pv.extracts(pages, pages).collect()] == ["A b"]


def test_incremental_stream(spark, tmp_path):
    source, output, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    stage = lambda df: df.withColumn("done", F.lit(True))
    from pyspark.sql.types import StructType

    done = StructType.fromDDL("pair_id string, done boolean")
    schema = StructType.fromDDL("pair_id string")
    for ids in (["a", "b", "b"], ["b", "c"]):
        spark.createDataFrame([(i,) for i in ids], schema).write.mode("append").parquet(source)
        run_incrementally(spark, source, schema, stage, output, done, check).awaitTermination()
    assert sorted(r["pair_id"] for r in spark.read.parquet(output).collect()) == ["a", "b", "c"]


def test_windowed_counts(spark):
    df = spark.createDataFrame([("2025-01-01 00:00:10", "a"), ("2025-01-01 00:04:00", "a"), ("2025-01-01 00:06:00", "a")], "t string, k string").withColumn("t", F.col("t").cast("timestamp"))
    assert sorted(r["n"] for r in windowed_counts(df, "t", "k").collect()) == [1, 2]


def test_pipeline_on_recorded_replies(spark, tmp_path):
    n = 6
    (tmp_path / "pairs.csv").write_text("base_relation,concept_1,concept_2\n" + "".join(f"Part Of,Stone{i},Wall{i}\n" for i in range(n)))
    (tmp_path / "config.yaml").write_text("paths:\n  input_csv: pairs.csv\n  work_dir: w\n  review_dir: r\n  output_dir: o\n  cache_dir: c\n  relation_aliases_file: null\nwikipedia:\n  min_sentences: 1\nquestions:\n  target_count: 4\n  total_questions: 5\n")
    config = load_config(tmp_path / "config.yaml")
    pairs = pr.load_pairs(files.read_pairs_csv(spark, config.paths.input_csv)).collect()
    replay = tmp_path / "replay"
    pages = [(i, f"Stone{i}", f"Stone{i} was built into Wall{i} long ago. Nothing else was ever written.") for i in range(n)]
    spark.createDataFrame(pages, "page_id bigint, title string, text string").write.parquet(f"{replay}/pages.parquet")
    spark.createDataFrame([(r["pair_id"], [("built into", [0], "q", None), ("latest part", [0], None, None)], None) for r in pairs], schemas.EXTRACTION).write.parquet(f"{replay}/replies.parquet")
    choices = [(r["pair_id"], b, "builtInto", "part of", "why") for r in pairs for b in range(4)]
    spark.createDataFrame(choices, "pair_id string, block_id bigint, most_relevant string, least_relevant string, rationale string").write.parquet(f"{replay}/choices.parquet")
    texts = [p[2].split(". ")[0] + "." for p in pages] + [f"{r['concept_1']} : {r['concept_2']}" for r in pairs] + [f"{r['concept_1']} : {r['concept_2']} | base relation: part_of" for r in pairs]
    spark.createDataFrame([(t, [1.0, float(k % 3), 0.5]) for k, t in enumerate(texts)], "text string, vector array<float>").write.parquet(f"{replay}/vectors.parquet")
    argv = ["run-auto", "--config", str(tmp_path / "config.yaml"), "--replay", str(replay)]
    assert cli.main(argv, spark) == 0
    report = json.loads((tmp_path / "o" / "validation_report.json").read_text())
    assert report["status"] == "ok" and report["question_count"] == 5 and report["pair_count"] == n
    questions = files.read_jsonl(spark, str(tmp_path / "o" / "analogy_questions.jsonl"), schemas.QUESTION).collect()
    assert all(len(q["targets"]) == 4 and set(q["scores"]) == set(q["answers"]) == set(q["ties"]) for q in questions)
    before = files.read_jsonl(spark, str(tmp_path / "w" / "raw_relations.jsonl"), schemas.MINED_RELATIONS).count()
    assert cli.main(["mine-relations", *argv[1:]], spark) == 0
    assert files.read_jsonl(spark, str(tmp_path / "w" / "raw_relations.jsonl"), schemas.MINED_RELATIONS).count() == before == n
