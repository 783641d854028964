"""End-to-end jobs: prepare a corpus, evaluate and promote models, serve and watch requests."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brevita.operators import curation, gate, judge, logs, records, rouge, sampling
from brevita.operators.generate import Factory, batch_generate
from brevita.session import pin, scratch
from brevita.sources import records as store
from brevita.sources.files import versions
from brevita.streaming.gate import merge_champions


@dataclass(frozen=True)
class SplitSizes:
    """Exact sizes of the curated splits; the defaults are the reference sizes."""

    train: int = 3000
    val: int = 300
    test: int = 200

    @property
    def total(self) -> int:
        return self.train + self.val + self.test


@dataclass(frozen=True)
class CurationJob:
    """Pool to instruction records: clean, deduplicate, filter, sample, split, format.

    Two scans of the texts: one for the narrow table, one to attach texts to the chosen rows.
    """

    sizes: SplitSizes = field(default_factory=SplitSizes)
    band: curation.LengthBand = field(default_factory=curation.LengthBand)
    seed: int = sampling.SPLIT_SEED

    def assign(self, pool: DataFrame) -> DataFrame:
        """(pool_pos, text_len, summary_len, split, ..) of the chosen rows; raises if there are too few."""
        curated = pin(curation.curated_positions(pool, self.band))
        sampling.require_rows(curated, self.sizes.total)
        sample = pin(sampling.systematic_sample(curated, self.sizes.total))
        bucketed = sampling.length_deciles(sample)
        return sampling.exact_split(bucketed, self.sizes.test, self.sizes.val, self.seed)

    def records(self, pool: DataFrame, assigned: DataFrame) -> DataFrame:
        chosen = curation.select_rows(pool, assigned.select("pool_pos", "split"), self.band)
        return records.instruction_records(chosen, "split")

    def run(
        self, spark: SparkSession, pool: DataFrame, path: str, published: str | None = None, force: bool = False
    ) -> DataFrame:
        """Records below ``path``, prepared only if a split is missing or ``force`` is set; optionally published."""

        def build() -> DataFrame:
            return self.records(pool, pin(self.assign(pool)))

        with scratch(spark):  # the records are written before the narrow tables behind them go
            kept, _ = store.ensure_splits(spark, path, build, force)
        if published:
            store.publish_splits(kept, published)
        return kept


def evaluate(
    pairs: DataFrame, replies: DataFrame, stem: bool = True, drop_errors: bool = False, family: Column | None = None
) -> DataFrame:
    """Scorecard of every model from its prediction pairs and its judge's replies, ready for ``promote``.

    ROUGE enters as the middle of its bootstrap interval. ``family`` says which champion a model competes with, by default that of
    its own name.
    """
    intervals = rouge.rouge_bootstrap(rouge.rouge_scores(pairs, stem=stem))
    middles = intervals.select("model", *[F.col(f"{m}_mid").alias(m) for m in rouge.METRICS])
    judged = judge.judge_summary(judge.typed_scores(judge.parse_replies(replies)), drop_errors, strict=True)
    cards = gate.build_scorecards(middles, judged)
    return cards.withColumn("family", F.col("model") if family is None else family)


def promote(
    spark: SparkSession,
    challengers: DataFrame,
    champion_path: str,
    log_path: str,
    threshold: float = gate.DEFAULT_THRESHOLD,
    update: bool = False,
    decided_at: Column | None = None,
) -> DataFrame:
    """Decide one challenger (family, combined_score and any other columns) per family against the stored champions.

    Champions and decisions carry the whole scorecard. A dry run unless ``update`` is set. With it, the decisions are logged and then
    a new copy of the champion table is written; a job that dies in between leaves the old champions in force and repeats under the
    same number.
    """
    held = store.read_version(spark, champion_path, challengers.schema)
    decided = gate.promotion_decision(held, challengers, threshold, decided_at=decided_at)
    if not update:
        return decided
    number = max(versions(spark, champion_path), default=-1) + 1
    store.write_version(decided, log_path, number)
    logged = spark.read.schema(decided.schema).parquet(f"{log_path}/version={number}")
    promoted = logged.filter(F.col("decision") == "PROMOTED").select("family", "challenger.*")
    store.write_version(merge_champions(held, promoted), champion_path, number)
    return logged


def serve(
    requests: DataFrame, factory: Factory, model_repo: str, model_filename: str, log_path: str, run: str | None = None
) -> DataFrame:
    """Answer the valid requests and append their log rows; answers with status and latency.

    The answers are written once before both uses, so that the generator runs once per request. A job that is repeated under the
    same ``run`` replaces its log rows.
    """
    accepted = records.validate_requests(requests).filter("valid")
    answers = pin(batch_generate(records.with_prompt(accepted), factory))
    rows = records.log_rows(
        answers, model_repo, model_filename, status=F.col("status"), error_message=F.col("error_message")
    )
    store.append_logs(rows, log_path, run)
    return answers


def dashboard(log: DataFrame, limit: int | None = logs.RECENT_ROWS) -> dict[str, DataFrame]:
    """The four views of the dashboard over the newest ``limit`` rows; ``None`` takes the whole log."""
    recent = pin(logs.recent_requests(log, limit)) if limit is not None else log
    return {
        "kpis": logs.latency_kpis(recent),
        "requests_by_hour": logs.requests_by_hour(recent),
        "latency_trend": logs.latency_trend(recent, limit),
        "recent_requests": logs.recent_requests(recent, limit),
    }
