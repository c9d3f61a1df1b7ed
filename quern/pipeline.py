"""The stages over files: each reads stored records, skips what is finished, writes its own records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schemas
from quern.config import Config
from quern.operators import evidence as ev
from quern.operators import maxdiff as md
from quern.operators import pairs as pr
from quern.operators import quality as ql
from quern.operators import questions as qs
from quern.operators import relations as rl
from quern.runtime import ship_package
from quern.sources import embedding_cache as ec
from quern.sources import files

#: A service of a stage: requests in, replies out.
Service = Callable[[DataFrame], DataFrame]


@dataclass
class Pipeline:
    """Stages with their services; pages is a table (page_id, title, text), the services answer rows with rows."""

    spark: SparkSession
    config: Config
    pages: DataFrame | None = None
    extractor: Service | None = None
    judge: Service | None = None
    embedder: Service | None = None
    _stored: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        ship_package(self.spark)

    def _path(self, folder: str, name: str) -> str:
        return f"{getattr(self.config.paths, folder).rstrip('/')}/{name}"

    def _read(self, name: str, schema, folder: str = "work_dir") -> DataFrame:
        """Stored records with an ordinal: the last record of a pair counts where one is needed."""
        return files.read_jsonl(self.spark, self._path(folder, name), schema).withColumn("_at", F.struct(F.col("_metadata.file_modification_time"), F.monotonically_increasing_id())) if files._exists(self.spark, self._path(folder, name)) else files.read_jsonl(self.spark, self._path(folder, name), schema).withColumn("_at", F.lit(0))

    def _latest(self, name: str, schema, folder: str = "work_dir") -> DataFrame:
        return rl.latest_record(self._read(name, schema, folder), "_at").drop("_at")

    def _append(self, fresh: DataFrame, name: str, resume: bool) -> str:
        path = self._path("work_dir", name)
        (files.append_jsonl if resume else files.write_jsonl)(fresh, path)
        return path

    def pairs(self) -> DataFrame:
        loaded = pr.load_pairs(files.read_pairs_csv(self.spark, self.config.paths.input_csv))
        if loaded.isEmpty():
            raise ValueError(f"{self.config.paths.input_csv} has no pairs")
        repeated = pr.repeated_pair_ids(loaded).limit(1).collect()
        if repeated:
            raise ValueError(f"repeated pair_id {repeated[0]['pair_id']}")
        return loaded.drop("row_no")

    def _todo(self, inputs: DataFrame, name: str, schema, resume: bool) -> DataFrame:
        return pr.unfinished(inputs, files.finished_ids(self._read(name, schema))) if resume else inputs

    def validate_input(self) -> dict:
        pairs = self.pairs()
        small = [r["base_relation"] for r in pr.undersized_groups(pairs, self.config.questions.target_count).orderBy("base_relation").collect()]
        groups = {r["base_relation"]: r["pair_count"] for r in pr.group_report(pairs).orderBy("base_relation").collect()}
        return {"pair_count": sum(groups.values()), "relation_count": len(groups), "pairs_by_relation": groups, "undersized": small}

    def retrieve(self, resume: bool = True) -> str:
        todo = self._todo(self.pairs(), "wikipedia_evidence.jsonl", schemas.WIKI_EVIDENCE, resume)
        return self._append(ev.retrieve(todo, self.pages, self.config.wikipedia), "wikipedia_evidence.jsonl", resume)

    def _evidence(self) -> DataFrame:
        return self._latest("wikipedia_evidence.jsonl", schemas.WIKI_EVIDENCE)

    def mine(self, resume: bool = True) -> str:
        evidence = self._evidence()
        todo = self._todo(self.pairs(), "raw_relations.jsonl", schemas.MINED_RELATIONS, resume)
        usable = ev.usable(evidence, self.config.wikipedia.allow_pairs_below_minimum)
        sentences = usable.select("pair_id", F.explode("evidence_sentences").alias("s")).select("pair_id", "s.sentence_id", "s.text")
        context = ev.prompt_context(sentences, "sentence_id", "text", self.config.openai.relation_context_char_limit)
        replies = self.extractor(ev.prompts(context, todo, "sentence_id"))
        aliases = files.alias_table(self.spark, files.read_aliases(self.config.paths.relation_aliases_file))
        return self._append(rl.mine(todo, evidence, replies, aliases, self.config.wikipedia), "raw_relations.jsonl", resume)

    def prepare_review(self) -> str:
        mined = self._latest("raw_relations.jsonl", schemas.MINED_RELATIONS)
        rows = rl.review_rows(mined, self._evidence(), rules=self.config.relation_filter)
        path = self._path("review_dir", "relation_review.csv")
        files.write_review_csv(rows.orderBy("pair_id", "pos"), path)
        return path

    def finalize(self, use_suggestions: bool = False) -> str:
        review = files.read_review_csv(self.spark, self._path("review_dir", "relation_review.csv"))
        open_rows = 0 if use_suggestions else rl.unresolved(review).count()
        if open_rows:
            raise ValueError(f"{open_rows} review rows have no decision")
        path = self._path("work_dir", "canonical_relations.jsonl")
        files.write_jsonl(rl.finalize(review, ["row_no"], use_suggestions), path)
        return path

    def rank(self, resume: bool = True) -> str:
        canonical = files.read_jsonl(self.spark, self._path("work_dir", "canonical_relations.jsonl"), schemas.CANONICAL_RELATIONS)
        todo = self._todo(canonical, "relation_rankings.jsonl", schemas.RELATION_RANKING, resume)
        blocks = md.design(todo, self.config.maxdiff)
        choices = self.judge(blocks.join(todo.select("pair_id", "concept_1", "concept_2"), "pair_id"))
        return self._append(md.rank_pairs(todo, blocks, choices, self.config.maxdiff), "relation_rankings.jsonl", resume)

    def _cache_path(self) -> str:
        return self._path("cache_dir", "embeddings.parquet")

    def _cache(self) -> DataFrame:
        return files.table_or_empty(self.spark, self._cache_path(), schemas.EMBEDDING)

    def ensure_embeddings(self, texts: DataFrame) -> str:
        """Embed the texts that the cache lacks and append them, each once; stored entries stay as they are."""
        missing = ec.missing_texts(texts, self._cache(), self.config.openai.embedding_model)
        fresh = self.embedder(missing).withColumn("_at", F.monotonically_increasing_id())
        ec.last_entries(fresh, "_at").write.mode("append").parquet(self._cache_path())
        return self._cache_path()

    def embed_contexts(self) -> str:
        usable = ev.usable(self._evidence(), self.config.wikipedia.allow_pairs_below_minimum)
        return self.ensure_embeddings(usable.select(F.explode("evidence_sentences").alias("s")).select(F.col("s.text").alias("text")))

    def generate_questions(self) -> str:
        settings, pairs, evidence = self.config.questions, self.pairs(), self._evidence()
        eligible = qs.eligible_pairs(pairs, self._latest("relation_rankings.jsonl", schemas.RELATION_RANKING), evidence, settings, self.config.wikipedia.allow_pairs_below_minimum)
        if not eligible.limit(1).collect():
            raise ValueError(f"no group has {settings.target_count + 1} pairs with rankings and context")
        sentences = evidence.join(eligible.select("pair_id"), "pair_id", "left_semi").select("pair_id", F.explode("evidence_sentences").alias("s")).select("pair_id", F.col("s.text").alias("text")).where("text IS NOT NULL")
        stems = eligible.select(qs.stem_text(F.col("concept_1"), F.col("concept_2"), F.col("base_relation")).alias("text"))
        prototypes = stems.unionByName(eligible.select(qs.pair_text(F.col("concept_1"), F.col("concept_2")).alias("text")))
        self.ensure_embeddings(prototypes.unionByName(sentences.select("text")))
        model = self.config.openai.embedding_model
        cache = self._cache().where(F.col("model") == model)
        sampled = qs.sampled_targets(qs.stem_schedule(eligible, settings), qs.target_pools(eligible), settings)
        # a vector that is not of its stated length fails the job
        vectors = ec.lookup(sentences, cache, model, strict=True).where("vector IS NOT NULL").groupBy("pair_id").agg(F.collect_list("vector").alias("vectors"))
        scored = qs.relation_overlaps(sampled, eligible)
        scored = qs.context_scores(scored, vectors, self.config.embedding.context_similarity_threshold)
        known = ec.lookup(prototypes.distinct(), cache, model, strict=True).where("vector IS NOT NULL").withColumnRenamed("text", "text_value")
        scored = qs.prototype_scores(scored, pairs, known)
        records = qs.question_records(pairs, sampled, qs.answers(scored, tolerance=settings.tie_tolerance))
        path = self._path("output_dir", "analogy_questions.jsonl")
        files.write_jsonl(records, path)
        if settings.total_questions is not None:
            note = qs.shortfall_warning(files.read_jsonl(self.spark, path, schemas.QUESTION).count(), settings)
            if note:
                files.write_text(self.spark, self._path("output_dir", "generation_warning.txt"), note)
        return path

    def validate(self) -> dict:
        questions = files.read_jsonl(self.spark, self._path("output_dir", "analogy_questions.jsonl"), schemas.QUESTION)
        evidence = self._read("wikipedia_evidence.jsonl", schemas.WIKI_EVIDENCE)
        rankings = self._read("relation_rankings.jsonl", schemas.RELATION_RANKING)
        made = ql.report(self.pairs(), evidence, rankings, questions, self.config.questions.target_count)
        return files.write_report(made, self._path("output_dir", "validation_report.json"))

    def run_until_review(self) -> None:
        self.validate_input()
        self.retrieve()
        self.mine()
        self.prepare_review()

    def resume_after_review(self, use_suggestions: bool = False) -> dict:
        self.finalize(use_suggestions)
        self.rank()
        self.embed_contexts()
        self.generate_questions()
        return self.validate()

    def run_auto(self) -> dict:
        self.run_until_review()
        return self.resume_after_review(use_suggestions=True)
