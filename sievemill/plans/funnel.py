"""The literature funnel: search, citation expansion, deduplication, screening, model answers, curation and finalization."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions import ids, model_output, urls
from sievemill.functions import text as X
from sievemill.operators import dedup, screen
from sievemill.sources import services
from sievemill.sources.shared_tables import written

from .state import Stages, resume_map

# The columns of a curation table, by their bare names.
CURATION = [
    "id", "title", "database_name", "database_url", "doi", "pmid", "year", "original48", "policy_version", "accessibility", "db_type_confirmation", "confirmation_reason",
    "qualification_basis", "exclusion_code", "evidence_url", "evidence_source_type", "evidence_statement", "evidence_checked_date", "manual_review_needed", "neural_link", "focus",
    "gene_expression_available", "species", "disease_association", "developmental_association", "tissue_or_brain_region", "cell_type", "sequencing_resolution", "read_technology",
    "visualization_methods",
]
FROZEN = CURATION[:9]


@dataclass
class Config:
    """What a run is asked to do."""

    query: str
    years: str
    folder: str
    resume: bool = False
    dedupe_order: str = "citations"
    most_per_year: int | None = None
    most_seeds: int | None = None
    page_size: int = 1000
    detail_batch: int = 50
    detail_rate: float = 9.0
    pattern: str = screen.RESOURCE_PATTERN
    scope: str | None = screen.SCOPE_PATTERN
    policy_version: str = "v1"
    most_answers: int | None = None
    stages: list[str] | None = None
    transports: dict[str, services.Transport] = field(default_factory=dict)


def screened(seed: DataFrame, detail: DataFrame, pattern: str, scope: str | None, pos: str = "pos") -> DataFrame:
    """Candidates of both sides, one of each identity, that pass the lexicons."""
    return screen.keyword_screen(dedup.candidate_pool(seed, detail, pos), pattern, scope)


def prompt(title: str = "title", abstract: str = "abstractText"):
    return F.concat(F.lit("Title: "), X.clean(F.col(title)), F.lit("\nAbstract: "), X.clean(F.col(abstract)))


def keyed_papers(rows: DataFrame, pos: str = "pos") -> DataFrame:
    return rows.withColumn("paper_key", ids.paper_key(F.col(pos), F.col("doi"), F.col("pmid"), F.col("pmcid"), F.col("title")))


def answering(transport: services.Transport, policy: str):
    """What asks a model about papers and parses its answers, with an ``error`` where one can't be used."""

    def work(todo: DataFrame) -> DataFrame:
        answers = services.ask_model(todo.withColumn("key", F.col("paper_key")), "key", "prompt", transport)
        parsed = answers.withColumn("p", model_output.parse_classification(F.col("answer"), policy))
        fields = [F.col(f"p.{c}").alias(c) for c in ("AI_class", "AI_check", "screening_policy_version", "AI_reason", "resource_name", "resource_type", "url_mentioned", "target_scope_hint")]
        return parsed.select(F.col("key").alias("paper_key"), *fields, F.coalesce(F.when(F.col("error") != "", F.col("error")), F.col("p.error")).alias("error"))

    return work


def classify(rows: DataFrame, transport: services.Transport, folder: str, policy: str, most: int | None = None, pos: str = "pos") -> DataFrame:
    """Model answers of every row that has none yet, parsed; rows whose answer can't be used come again."""
    return resume_map(keyed_papers(rows, pos).withColumn("prompt", prompt()), "paper_key", folder, answering(transport, policy), most, pos)


def detailed(transport: services.Transport, batch: int, rate: float):
    """What asks for the details of references."""

    def work(todo: DataFrame) -> DataFrame:
        found = services.fetch_details(todo, transport, batch, rate)
        return found.withColumn("detail_key", ids.detail_key(F.col("ref_source"), F.col("ref_id")))

    return work


def curated_again(rows: DataFrame, policy: str, pos: str = "pos") -> DataFrame:
    """An earlier curation table as input of a new one: identity kept, decisions cleared. Blank and repeated ids are errors."""
    from sievemill.operators.validate import id_violations

    bad = id_violations(rows, pos, "id").orderBy("row_pos").limit(1).collect()
    if bad:
        raise ValueError(f"row {bad[0].row_pos}: id {bad[0].rule}")
    original = F.lower(X.clean_chunk(F.col("original48")))
    made = {
        "id": X.clean_year(F.col("id")),
        **{c: X.clean_chunk(F.col(c)) for c in ("title", "database_name", "database_url", "doi", "pmid")},
        "year": X.clean_year(F.col("year")),
        "original48": F.when(original.isin("yes", "no"), original).otherwise(F.lit("no")),
        "policy_version": F.lit(policy),
    }
    return rows.select(pos, *[made.get(c, F.lit("")).alias(c) for c in CURATION])


def curation_table(rows: DataFrame, policy: str, pos: str = "pos") -> DataFrame:
    """Classified rows in the columns of a curation table, ids numbered in order; what a curator fills in is empty."""
    from sievemill.operators.chunk import global_positions

    get = lambda n: F.col(n) if n in rows.columns else F.lit("")
    made = {
        "title": X.clean(get("title")),
        "database_name": X.clean_resource_name(get("resource_name")),
        "database_url": urls.first_database_url(get("abstractText"), get("title"), get("AI_reason")),
        "doi": ids.doi_bare(get("doi")),
        "pmid": X.clean_int_identifier(get("pmid")),
        "year": X.clean_year(get("pubYear")),
        "original48": F.lit("no"),
        "policy_version": F.lit(policy),
    }
    numbered = global_positions(rows, [pos], "_id")
    return numbered.select(pos, *[F.col("_id").cast("string").alias("id") if c == "id" else made.get(c, F.lit("")).alias(c) for c in CURATION])


def placed(rows: DataFrame) -> DataFrame:
    """The rows with their place, ``pos``, written: it is the same however often they are read."""
    return written(rows.withColumn("pos", F.monotonically_increasing_id()), "placed")[0]


def run(spark: SparkSession, config: Config) -> DataFrame:
    """The funnel up to the curation table; every stage is written once and reused when the run is resumed. Details and answers that
    failed are asked for again then, and what follows from them is made anew; ``Paused`` says that answers are left to ask for."""
    stages = Stages(spark, config.folder, config.resume, {"policy_version": config.policy_version, "query": config.query}, config.stages)
    t = config.transports
    found = stages.run("search", lambda: services.search_years(spark, t["search"], config.query, services.parse_years(config.years), config.most_per_year, config.page_size))
    seed = stages.run("seeds", lambda: dedup.seed_articles(found, config.dedupe_order, "pos", config.most_seeds))
    edges = stages.run("references", lambda: services.fetch_references(dedup.seed_pmids(seed, "pos"), t["references"]))
    targets = dedup.reference_targets(placed(edges), "pos")
    targets = targets.withColumn("detail_key", ids.detail_key(F.col("ref_source"), F.col("ref_id")))
    details = stages.answer("details", targets, "detail_key", detailed(t["details"], config.detail_batch, config.detail_rate)).drop("detail_key")
    detail = stages.run("cited", lambda: dedup.reference_details(placed(details), "pos"))
    kept = stages.run("screened", lambda: screened(seed.drop("year_window"), detail.drop("ref_source", "ref_id"), config.pattern, config.scope))
    with_text, _ = screen.split_missing(kept)
    papers = keyed_papers(with_text)
    answers = stages.answer("classified", papers.withColumn("prompt", prompt()), "paper_key", answering(t["model"], config.policy_version), config.most_answers, "pos")
    rows = papers.join(screen.yes_only(answers).drop("pos"), "paper_key")
    return stages.run("curation", lambda: curation_table(rows, config.policy_version))


def finalize(curated: DataFrame, reviewed: DataFrame, neural_columns: list[str], most: int = 8) -> tuple[DataFrame, DataFrame]:
    """The final catalog, and an audit row for each canonical group.

    Reviewed rows, which also have ``group, members, canonical, representative``, replace curated ones as a whole. Every row that is
    then decided yes must have been reviewed. Canonical groups of such rows are reduced to their representatives, whose yes/no flag
    is yes if a member's is; neural links are made consistent; evidence, decisions and the share of manual reviews are judged on the
    result. Rows come in the order of ids; anything wrong is an error that names the first ``most`` rows."""
    from sievemill.operators import resolve, validate

    twice = reviewed.groupBy(X.clean_id(F.col("id")).alias("id")).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"reviewed twice: {twice[0].id}")
    audited = ["group", "members", "canonical", "representative"]
    own = reviewed.select(F.lit(True).alias("_seen"), X.clean_id(F.col("id")).alias("_id"), F.struct(*curated.columns).alias("_row"), F.struct(*audited).alias("_audit"))
    both = curated.withColumn("_id", X.clean_id(F.col("id"))).withColumn("_old", F.struct(*curated.columns)).select("_id", "_old").join(own, "_id", "left")
    rows = both.select("_id", F.coalesce("_row", "_old").alias("_now"), "_audit").select("_id", "_now.*", *[F.col(f"_audit.{c}").alias(c) for c in audited])
    yes = rows.filter(F.lower(X.clean(F.col("db_type_confirmation"))) == "yes")
    missing = yes.filter(X.clean(F.col("canonical")) == "").orderBy("_id").limit(most).collect()
    if missing:
        raise ValueError(f"decided yes without a review: {', '.join(r['_id'] for r in missing)}")
    groups = resolve.canonical_groups(yes)
    broken = groups.filter("rule is not null").orderBy("canonical").limit(1).collect()
    if broken:
        raise ValueError(f"canonical group {broken[0].canonical}: {broken[0].rule}")
    merged = groups.select(F.explode(F.split("removed_ids", ";")).alias("id"), "representative").filter("id <> ''")
    plain = rows.withColumn("id", F.col("_id")).select(curated.columns)
    kept, _ = resolve.apply_merges(plain, merged, "id", "original48")
    final = validate.consistent_neural_link(kept, neural_columns).orderBy(X.sort_id(F.col("id")))
    placed = final.withColumn("_pos", X.sort_id(F.col("id")))
    for rules in (validate.final_evidence_rules(), validate.final_decision_rules(neural_columns)):
        error = validate.first_messages(validate.violations(placed, "_pos", "id", rules), most)
        if error:
            raise ValueError(error)
    n, reviews = final.count(), final.filter(F.lower(X.clean(F.col("manual_review_needed"))) == "yes").count()
    if reviews > validate.final_review_limit(n):
        raise ValueError(f"manual review limit exceeded: {reviews}/{n} rows, maximum {validate.final_review_limit(n)}")
    return final, groups.drop("rule", "group_key")
