"""Command line: python -m quern COMMAND --config FILE [--replay FOLDER] [--restart] [--use-suggestions].

The services answer from recorded replies in the replay folder: pages.parquet (page_id, title, text), replies.parquet
(pair_id, relations, error), choices.parquet (pair_id, block_id, most_relevant, least_relevant, rationale) and
vectors.parquet (text, vector).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from quern.config import load_config
from quern.pipeline import Pipeline
from quern.sources.embedding_cache import entries
from quern.sources.providers import replayed

COMMANDS = ("validate-input", "retrieve-wikipedia", "mine-relations", "prepare-review", "finalize-relations", "rank-relations", "embed-contexts", "generate-questions", "validate", "run-until-review", "resume-after-review", "run-auto")


def replay_pipeline(spark: SparkSession, config, folder: str | None) -> Pipeline:
    """A pipeline whose services replay recorded tables."""
    if folder is None:
        return Pipeline(spark, config)
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return Pipeline(
        spark, config, pages=read("pages"),
        extractor=lambda requests: replayed(requests, read("replies"), ["pair_id"]),
        judge=lambda blocks: replayed(blocks, read("choices"), ["pair_id", "block_id"]),
        embedder=lambda texts: entries(texts.join(read("vectors"), "text"), config.openai.embedding_model),
    )


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quern")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--config", default="config.yaml")
    parser.add_argument("--replay")
    parser.add_argument("--restart", action="store_true")
    parser.add_argument("--use-suggestions", action="store_true")
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("quern").getOrCreate()
    p = replay_pipeline(spark, load_config(args.config), args.replay)
    resume = not args.restart
    actions = {
        "validate-input": p.validate_input, "retrieve-wikipedia": lambda: p.retrieve(resume), "mine-relations": lambda: p.mine(resume),
        "prepare-review": p.prepare_review, "finalize-relations": lambda: p.finalize(args.use_suggestions), "rank-relations": lambda: p.rank(resume),
        "embed-contexts": p.embed_contexts, "generate-questions": p.generate_questions, "validate": p.validate,
        "run-until-review": p.run_until_review, "resume-after-review": lambda: p.resume_after_review(args.use_suggestions), "run-auto": p.run_auto,
    }
    result = actions[args.command]()
    if result is not None:
        print(json.dumps(result, indent=2, ensure_ascii=False) if isinstance(result, dict) else result)
    return 1 if isinstance(result, dict) and result.get("status") == "failed" else 0


if __name__ == "__main__":
    sys.exit(main())
