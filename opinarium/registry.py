"""All queries by name. Each takes a session and the folder of the input tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinarium import fixtures as fx
from opinarium.functions.text import normalize_whitespace, strip_html
from opinarium.operators import cleaning, extraction, integrity, profiling, resume, sampling, sketches, summary
from opinarium.operators.grouped import grouped
from opinarium.plans import analysis, workflow
from opinarium.schemas import DEFAULT_SAMPLE_SIZE
from opinarium.session import stored, working_folder
from opinarium.sources.files import missing_to_null, write_csv
from opinarium.sources import brand_layout, review_store
from opinarium.sources.records import read_split_csv
from opinarium.sources.snapshots import snapshot
from opinarium.sources.stages import staged
from opinarium.sources.tables import IntegrityError, TableNames, with_dense_aspect_id
from opinarium.streaming.id_index import IdIndex
from opinarium.streaming.incremental import add_new_reviews

Query = Callable[[SparkSession, str], DataFrame]

AUDIT_SIZE = 30
PROFILE_DIGITS = 4
FILTERED_BRANDS = ("BUILDING", "MACHINERY")
CHOSEN_BELOW = "G"
TOP_ROWS = 20
TOP_VALUES = 10
INDEX_BUCKETS = 4
GROUP_TOP = 3
# A sample size above the rows of any table.
EVERY_REVIEW = 10**12


def _on_reviews(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: plan(fx.reviews(spark, sf))


def _on_aspects(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: plan(fx.review_aspects(spark, sf))


def _on_both(plan: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: plan(fx.reviews(spark, sf), fx.review_aspects(spark, sf))


def _on_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: plan(fx.raw_reviews(spark, sf))


# --- cleaning and sampling ------------------------------------------------------------


def strip_page_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = fx.table(spark, sf, "pages")
    return pages.select("page_id", strip_html(F.col("html")).alias("clean_text"))


def normalize_document_text(spark: SparkSession, sf: str) -> DataFrame:
    documents = fx.table(spark, sf, "documents")
    return documents.select("doc_id", normalize_whitespace(F.col("text")).alias("clean_text"))


def draw_stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    sample = sampling.stratified_sample(fx.reviews(spark, sf), DEFAULT_SAMPLE_SIZE,
                                        key=["review_id"])
    return sample.select("review_id", "brand_name", "review_rating", "review_text")


def sample_balance(spark: SparkSession, sf: str) -> DataFrame:
    reviews = fx.reviews(spark, sf)
    sample = sampling.stratified_sample(reviews, DEFAULT_SAMPLE_SIZE, key=["review_id"])
    return sampling.sample_balance(reviews, sample)


def draw_audit_sample(spark: SparkSession, sf: str) -> DataFrame:
    sample = sampling.random_sample(fx.reviews(spark, sf), AUDIT_SIZE, key=["review_id"])
    return sample.select("review_id", "overall_sentiment", "review_text")


# --- extraction -----------------------------------------------------------------------


def fixture_extractor() -> extraction.Extractor:
    """Reads the sentiment off the priority at the end of a fixture text."""
    sentiment = {"1": "negative", "2": "negative", "3": "mixed", "4": "neutral"}

    def extract(review_id: str, text: str) -> str:
        priority = text.split(" ")[2]
        overall = sentiment.get(priority[0], "positive")
        aspects = []
        if overall == "mixed":
            aspects.append({"aspect": "Price Value", "aspect_sentiment": "positive"})
        if overall in ("mixed", "negative"):
            aspects.append({"aspect": "quality", "aspect_sentiment": "negative",
                            "issue": f"priority {priority}"})
        return json.dumps({"overall_sentiment": overall, "aspects": aspects})

    return extract


def run_extractor(spark: SparkSession, sf: str) -> DataFrame:
    policy = extraction.CallPolicy(pace=0.0)
    answers = extraction.extract_reviews(fx.reviews(spark, sf), fixture_extractor, "fixture",
                                         policy, spark.sparkContext.defaultParallelism)
    valid = extraction.valid_answers(extraction.parse_answers(answers))
    return extraction.aspect_rows(valid, keep_empty=True,
                                  extra=["overall_sentiment", "extraction_method", "attempts"])


# By review number modulo 10, an error and how many calls it meets.
FAILURES = {0: ("429 too many requests", 2), 1: ("quota exceeded", 3),
            2: ("401 unauthenticated", 1), 3: ("connection reset", 1)}


def failing_extractor() -> extraction.Extractor:
    """The fixture extractor, some calls of which fail."""
    answer, calls = fixture_extractor(), {}

    def extract(review_id: str, text: str) -> str:
        error, times = FAILURES.get(int(review_id) % 10, ("", 0))
        met = calls.pop(review_id, 0)
        if met < times:
            calls[review_id] = met + 1
            raise RuntimeError(error)
        return answer(review_id, text)

    return extract


def retry_policy(spark: SparkSession, sf: str) -> DataFrame:
    policy = extraction.CallPolicy(pace=0.0, wait=0.0, on_error=extraction.REJECT)
    answers = extraction.extract_reviews(fx.reviews(spark, sf), failing_extractor, "fixture",
                                         policy, spark.sparkContext.defaultParallelism)
    return answers.select("review_id", "attempts", "error",
                          F.col("raw").isNotNull().alias("answered"))


def response_extractor() -> extraction.Extractor:
    """The fixture responses; one review in twenty is refused."""

    def extract(review_id: str, text: str) -> str:
        if int(review_id) % 20 == 6:
            raise RuntimeError("401 unauthenticated")
        return fx.RESPONSES.get(int(review_id) % 10, fx.FULL_RESPONSE)

    return extract


def whole_workflow(spark: SparkSession, sf: str) -> DataFrame:
    """From two CSV folders, the second repeating ids of the first, to published tables and
    rejects."""
    folder = working_folder(spark, "workflow")
    raw = fx.raw_reviews(spark, sf)
    write_csv(raw, f"{folder}/raw/1")
    write_csv(raw.filter(F.col("review_id").cast("bigint") % 10 == 0)
              .withColumn("review_text", F.lit("A later text")), f"{folder}/raw/2")
    run = folder.rpartition("-")[2]
    config = workflow.WorkflowConfig(
        f"{folder}/raw/*", folder, sample_size=EVERY_REVIEW,
        names=TableNames(f"reviews_{run}", f"review_aspects_{run}", f"summary_{run}"))
    policy = extraction.CallPolicy(pace=0.0, wait=0.0, on_error=extraction.REJECT)
    out = workflow.run_workflow(spark, config, response_extractor, "fixture", policy)
    counts = out["review_aspects"].groupBy("review_id").agg(F.count("*").alias("aspect_count"))
    published = out["reviews"].join(counts, "review_id", "left").select(
        "review_id", F.lit("published").alias("status"), "brand_name", "review_text",
        "overall_sentiment", F.coalesce("aspect_count", F.lit(0)).alias("aspect_count"))
    rejected = out["rejected"].select("review_id", F.lit("rejected").alias("status"), "error")
    return published.unionByName(rejected, allowMissingColumns=True)


def multiline_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Raw reviews whose texts hold line breaks and quotes, through CSV files that are split."""
    folder = working_folder(spark, "multiline")
    write_csv(fx.quoted_reviews(spark, sf), folder)
    return cleaning.clean_reviews(missing_to_null(read_split_csv(spark, folder)))


def _loaded_store(spark: SparkSession, sf: str) -> str:
    """Three loads, the later ones repeating a review of the earlier ones in five."""
    root = working_folder(spark, "store")
    for batch in range(3):
        rests = [n for n in range(15) if n % 3 == batch or n % 3 < batch and n % 5 == 0]
        part = [view(spark, sf, lambda number: (number % 15).isin(rests)) for view in (fx.reviews, fx.review_aspects)]
        review_store.load(spark, root, *part)
    return root


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Version and rows of both tables after three loads, a load that fails, and a cascading delete."""
    root = _loaded_store(spark, sf)
    steps = [("loaded", snapshot(spark, root))]
    reviews, aspects = fx.reviews(spark, sf), fx.aspects_with_orphans(spark, sf)
    try:
        review_store.load(spark, root, reviews, aspects)
    except IntegrityError:
        steps.append(("failed", snapshot(spark, root)))
    review_store.delete(spark, root, fx.checkpoint_reviews(spark, sf))
    steps.append(("deleted", snapshot(spark, root)))
    counts = [found.table(spark, name).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(step).alias("step"), F.lit(found.version).cast("bigint").alias("version"), F.lit(name).alias("table_name"), "row_count",
        (F.col("row_count") == found.rows(name)).alias("as_published"))
        for step, found in steps for name in ("reviews", "review_aspects")]
    return reduce(DataFrame.unionByName, counts)


def summary_from_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The summary kept up to date over three loads and a delete, without a count of the whole."""
    root = _loaded_store(spark, sf)
    deleted = review_store.delete(spark, root, fx.checkpoint_reviews(spark, sf))
    return summary.summary_of(deleted.table(spark, review_store.COUNTS_TABLE))


def parse_extractions(spark: SparkSession, sf: str) -> DataFrame:
    valid = extraction.valid_answers(extraction.parse_answers(fx.responses(spark, sf)))
    return extraction.aspect_rows(valid, keep_empty=True, extra=["overall_sentiment"])


def reject_extractions(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.rejected_answers(extraction.parse_answers(fx.responses(spark, sf)))


def pending(spark: SparkSession, sf: str) -> DataFrame:
    out = resume.pending_reviews(fx.reviews(spark, sf), fx.checkpoint_reviews(spark, sf))
    return out.select("review_id", "product_id", "review_text")


def resumed_aspects(spark: SparkSession, sf: str) -> DataFrame:
    return resume.known_aspects(fx.review_aspects(spark, sf), fx.checkpoint_reviews(spark, sf))


def progress(spark: SparkSession, sf: str) -> DataFrame:
    return resume.resume_counts(fx.reviews(spark, sf), fx.checkpoint_reviews(spark, sf))


def deduplicate(spark: SparkSession, sf: str) -> DataFrame:
    return resume.first_per_key(fx.reviews_with_dups(spark, sf), ["review_id"],
                                ["ingest_order"])


def incremental_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Streams the documents as raw reviews; every third one was processed before."""
    documents = fx.table(spark, sf, "documents")
    # The table may be a file or a folder of files. A stream takes a single file by a pattern only.
    stream = spark.readStream.schema(documents.schema).parquet(f"{sf}/{{documents.parquet}}")
    processed = fx.raw_reviews_of(documents).filter(F.col("review_id").cast("bigint") % 3 == 0)
    folder = working_folder(spark, "incremental")
    out = add_new_reviews(fx.raw_reviews_of(stream), f"{folder}/reviews", f"{folder}/progress",
                          cleaning.clean_reviews, processed)
    return out.select("review_id", "product_id", "brand_name", "review_text", "review_rating")


def indexed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Raw reviews in three arrivals, the later ones repeating some of the earlier, and all of them
    once more in a run that lost its progress; ids are looked up in an index."""
    folder, raw = working_folder(spark, "indexed"), fx.raw_reviews(spark, sf)
    number = F.col("review_id").cast("bigint")
    index = IdIndex(f"{folder}/index", INDEX_BUCKETS)

    def add(run: str) -> DataFrame:
        stream = spark.readStream.schema(raw.schema).parquet(f"{folder}/arrived")
        return add_new_reviews(stream, f"{folder}/reviews", f"{folder}/{run}", cleaning.clean_reviews, index=index)

    # An arrival is a batch, of however many files it is made.
    for arrival in range(3):
        part = (number % 3 == arrival) | (number % 3 < arrival) & (number % 5 == 0)
        raw.filter(part).write.mode("append").parquet(f"{folder}/arrived")
        add("first")
    out = add("again")
    return out.select("review_id", "product_id", "brand_name", "review_text", "review_rating")


# --- integrity and profile ------------------------------------------------------------


def count_tables(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    return integrity.row_counts({"reviews": reviews, "review_aspects": aspects})


def check_dup_key(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.check_primary_key(fx.reviews_with_dups(spark, sf))


def orphan_aspects(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.check_foreign_key(fx.aspects_with_orphans(spark, sf),
                                       fx.reviews(spark, sf))


def rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Rules over the fixture tables, and over answers parsed but not validated."""
    parsed = extraction.parse_answers(fx.responses(spark, sf), check_vocabulary=False)
    clean = integrity.check_tables(fx.reviews(spark, sf), fx.review_aspects(spark, sf))
    loose = parsed.withColumn("extraction_method", F.lit("fixture"))
    rows = extraction.aspect_rows(parsed)
    return clean.unionByName(
        integrity.check_rules("unchecked_reviews", loose, integrity.review_rules())
    ).unionByName(
        integrity.check_rules("unchecked_aspects", rows, integrity.aspect_rules()))


def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    reviews, aspects = resume.remove_reviews(
        fx.reviews(spark, sf), fx.review_aspects(spark, sf), fx.checkpoint_reviews(spark, sf))
    none = F.lit(None).cast("string")
    left = reviews.select(F.lit("reviews").alias("table_name"), "review_id",
                          none.alias("aspect"), "overall_sentiment")
    right = aspects.select(F.lit("review_aspects").alias("table_name"), "review_id", "aspect",
                           F.col("aspect_sentiment").alias("overall_sentiment"))
    return left.unionByName(right).withColumnRenamed("overall_sentiment", "sentiment")


def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.duplicate_rows(fx.reviews_with_dups(spark, sf).select("review_id"))


def dense_ids(spark: SparkSession, sf: str) -> DataFrame:
    numbered = with_dense_aspect_id(fx.placed_aspects(spark, sf), ["review_number", "pos"])
    return numbered.select("aspect_id", "review_id", "pos")


def whole_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.duplicate_rows(fx.whole_reviews_with_dups(spark, sf))


def observed_report(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaning report out of the write of the cleaned rows."""
    return cleaning.write_cleaned(fx.raw_reviews(spark, sf), working_folder(spark, "cleaned"))


def brand_aspects(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    """The reports over aspects alone, for some brands."""
    own = analysis.aspects_of(reviews, aspects, FILTERED_BRANDS)
    rates = analysis.aspect_negative_rate(own).join(analysis.aspect_frequency(own), "aspect").select(
        F.lit("aspect").alias("report"), F.col("aspect").alias("value"), "mention_count",
        F.col("negative_rate_pct").alias("pct"))
    shares = analysis.aspect_sentiment_share(own).select(
        F.lit("sentiment").alias("report"), F.col("aspect_sentiment").alias("value"), "mention_count",
        F.col("mention_pct").alias("pct"))
    return rates.unionByName(shares)


def pruned_brands(spark: SparkSession, sf: str) -> DataFrame:
    """Aspects of some brands, listed or chosen by a table, out of tables laid out by brand."""
    folder = working_folder(spark, "by-brand")
    reviews = fx.reviews(spark, sf)
    own = brand_layout.write_by_brand(reviews, f"{folder}/reviews")
    table = brand_layout.write_aspects_by_brand(reviews, fx.review_aspects(spark, sf), f"{folder}/aspects")
    counts = stored(own.rows(spark).groupBy("brand_name").agg(F.count(F.lit(1)).alias("review_count")), "brands")
    ways = {"listed": table.of_brands(spark, FILTERED_BRANDS),
            "chosen": table.of_chosen(spark, counts.filter(F.col("brand_name") < CHOSEN_BELOW))}
    return reduce(DataFrame.unionByName, [
        found.groupBy("brand_name", "aspect").agg(F.count(F.lit(1)).alias("mention_count")).select(
            F.lit(way).alias("way"), "brand_name", "aspect", "mention_count") for way, found in ways.items()])


def count_values(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["brand_name", "product_title", "overall_sentiment", "extraction_method"]
    counted = profiling.value_counts(fx.reviews(spark, sf), columns)
    sources = profiling.value_counts(fx.table(spark, sf, "documents"), ["source", "lang"])
    return counted.unionByName(sources)


def brand_filter(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    return analysis.priority_pain_points(reviews, aspects, brands=FILTERED_BRANDS)


def top_pain_points(reviews: DataFrame, aspects: DataFrame) -> DataFrame:
    return analysis.priority_pain_points(reviews, aspects, top=TOP_ROWS)


def brand_ratings(reviews: DataFrame) -> DataFrame:
    return analysis.rating_alignment(reviews, brands=FILTERED_BRANDS)


# --- sketches, a function per group, stages ----------------------------------------------


def distinct_by_sketch(reviews: DataFrame) -> DataFrame:
    """Distinct products per brand and over all, exactly and from sketches stored per brand and year."""
    by_year = stored(sketches.distinct_sketches(
        reviews.withColumn("review_year", F.year("review_date")), ["brand_name", "review_year"], "product_id"), "sketches")
    estimated = sketches.distinct_estimates(sketches.merged_sketches(by_year, ["brand_name"])).unionByName(
        sketches.distinct_estimates(sketches.merged_sketches(by_year)).withColumn("brand_name", F.lit("(all)")))
    counted = reviews.groupBy("brand_name").agg(F.count_distinct("product_id").alias("distinct_products")).unionByName(
        reviews.agg(F.lit("(all)").alias("brand_name"), F.count_distinct("product_id").alias("distinct_products")))
    return estimated.join(counted, estimated["brand_name"].eqNullSafe(counted["brand_name"])).select(
        counted["brand_name"], F.col("rows").alias("review_count"), "distinct_products",
        sketches.within_error(F.col("distinct_values"), F.col("distinct_products")).alias("within_error"))


def _dearest(rows):
    """The three dearest of some reviews, and how many reviews there are."""
    counted = rows["n"].sum() if "n" in rows else len(rows)
    best = rows[rows["mrp"].notna()].sort_values(["mrp", "review_id"], ascending=[False, True])[:GROUP_TOP]
    if best.empty:
        best = rows[:1].assign(review_id=None, mrp=None)
    # The count stands in the first row only, so that it can be summed.
    return best.assign(n=[counted] + [0] * (len(best) - 1))[["review_id", "mrp", "n"]]


def dearest_reviews(reviews: DataFrame) -> DataFrame:
    """A pandas function with its merge, over brand and rating."""
    rows = reviews.select("brand_name", "review_rating", "review_id", "mrp")
    found = grouped(rows, ["brand_name", "review_rating"], _dearest, _dearest, "review_id string, mrp double, n long")
    return found.groupBy("brand_name", "review_rating").agg(
        F.sum("n").alias("review_count"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("review_id").isNotNull(), F.struct(
            (-F.col("mrp")).alias("m"), "review_id")))), lambda x: x["review_id"]), ",").alias("dearest"))


def rebuilt_stages(spark: SparkSession, sf: str) -> DataFrame:
    """Which of three stages run: at first, without a change, with a new file, with a new parameter."""
    root = working_folder(spark, "stages")
    reviews, raw, rows = fx.reviews(spark, sf), f"{root}/raw", []
    reviews.filter("review_rating <= 3").write.parquet(raw)

    def run(number: int, least: int) -> None:
        cleaned = staged(spark, root, "cleaned", lambda: spark.read.schema(reviews.schema).parquet(raw).dropna(subset=["mrp"]), [raw])
        counted = staged(spark, root, "counted", lambda c: c.groupBy("brand_name", "product_id").count(), after=[cleaned])
        chosen = staged(spark, root, "chosen", lambda c, least: c.filter(F.col("count") >= least),
                        params={"least": least}, after=[counted])
        rows.extend((number, name, b.ran, b.table(spark).count())
                    for name, b in (("cleaned", cleaned), ("counted", counted), ("chosen", chosen)))

    run(1, 1)
    run(2, 1)
    reviews.filter("review_rating > 3").write.mode("append").parquet(raw)
    run(3, 1)
    run(4, 3)
    return spark.createDataFrame(rows, "run int, stage string, ran boolean, row_count long")


QUERIES: dict[str, Query] = {
    "f01_brand_filter": _on_both(brand_filter),
    "f02_top_pain_points": _on_both(top_pain_points),
    "f03_brand_ratings": _on_reviews(brand_ratings),
    "f04_brand_aspects": _on_both(brand_aspects),
    "f05_pruned_brand": pruned_brands,
    "q01_overall_sentiment": _on_reviews(analysis.overall_sentiment),
    "q02_product_sentiment_rank": _on_reviews(analysis.product_sentiment_rank),
    "q03_product_aspect_mentions": _on_both(analysis.product_aspect_mentions),
    "q04_product_sentiment_weight": _on_both(analysis.product_sentiment_weight),
    "q05_negative_rate": _on_both(analysis.negative_rate),
    "q06_priority_pain_points": _on_both(analysis.priority_pain_points),
    "q07_brand_pain_points": _on_both(analysis.brand_pain_points),
    "q08_rating_alignment": _on_reviews(analysis.rating_alignment),
    "q09_discount_band_sentiment": _on_both(analysis.discount_band_sentiment),
    "q10_negative_or_mixed_products": _on_reviews(analysis.negative_or_mixed_products),
    "q11_complaint_drilldown": _on_both(analysis.complaint_drilldown),
    "q12_product_aspect_summary": _on_both(analysis.product_aspect_summary),
    "m01_aspect_frequency": _on_aspects(analysis.aspect_frequency),
    "m02_aspect_negative_rate": _on_aspects(analysis.aspect_negative_rate),
    "m03_dominant_sentiment_by_rating": _on_reviews(analysis.dominant_sentiment_by_rating),
    "m04_aspect_coverage": _on_both(analysis.aspect_coverage),
    "m05_brand_review_counts": _on_reviews(analysis.review_kpis),
    "m06_aspect_sentiment_share": _on_aspects(analysis.aspect_sentiment_share),
    "c01_clean_reviews": _on_raw(cleaning.clean_reviews),
    "c02_cleaning_report": _on_raw(cleaning.cleaning_report),
    "c03_strip_html": strip_page_html,
    "c04_normalize_whitespace": normalize_document_text,
    "c06_multiline_csv": multiline_csv,
    "c05_price_anomalies": _on_reviews(cleaning.price_anomalies),
    "c07_observed_report": observed_report,
    "s01_stratified_sample": draw_stratified_sample,
    "s02_sample_balance": sample_balance,
    "s03_random_sample": draw_audit_sample,
    "x01_parse_extractions": parse_extractions,
    "x02_rejected_extractions": reject_extractions,
    "x03_extract_reviews": run_extractor,
    "x04_pending_reviews": pending,
    "x05_resume_aspects": resumed_aspects,
    "x06_dedup_reviews": deduplicate,
    "x07_incremental_stream": incremental_stream,
    "x10_indexed_stream": indexed_stream,
    "x08_resume_counts": progress,
    "x09_retry_policy": retry_policy,
    "q13_summary_delta": summary_from_changes,
    "w01_workflow": whole_workflow,
    "w02_snapshot": snapshots,
    "v01_row_counts": _on_both(count_tables),
    "v02_primary_key": check_dup_key,
    "v03_orphan_aspects": orphan_aspects,
    "v04_provenance": _on_reviews(integrity.provenance),
    "v05_not_null_and_domain": rule_violations,
    "v06_cascade_delete": cascade_delete,
    "v07_dense_ids": dense_ids,
    "v08_distinct_sketch": _on_reviews(distinct_by_sketch),
    "s04_group_function": _on_reviews(dearest_reviews),
    "w03_stages": rebuilt_stages,
    "p01_null_counts": _on_raw(profiling.null_counts),
    "p02_describe": _on_reviews(
        lambda r: profiling.describe(r, ["review_rating", "mrp", "price"], PROFILE_DIGITS)),
    "p03_duplicate_rows": duplicate_ids,
    "p10_whole_duplicates": whole_duplicates,
    "p04_value_counts": count_values,
    "p05_price_histogram": _on_reviews(lambda r: profiling.histogram(r, "price")),
    "p06_reviews_by_year": _on_reviews(analysis.reviews_by_year),
    "p07_rating_distribution": _on_reviews(analysis.rating_distribution),
    "p08_column_info": _on_raw(profiling.column_info),
    "p09_top_values": _on_reviews(lambda r: profiling.value_counts(
        r, ["product_title", "review_rating"], TOP_VALUES)),
}
