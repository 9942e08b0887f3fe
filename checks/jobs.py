"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

import re
import uuid
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from redactory import (
    ColumnPolicy,
    EntityPolicy,
    Pattern,
    Policy,
    TablePolicy,
    TableSet,
    anonymize,
    anonymize_table,
    anonymize_tables,
    findings,
    lexicon_findings,
    process_table,
    query_results,
    register_python_mask,
    upsert,
    write_anonymized,
)
from redactory.functions import masks
from redactory.functions.spans import at_least, only_entities, resolve_spans
from redactory.functions.text import worth_analysing
from redactory.operators import detect as D
from redactory.operators import report as R
from redactory.operators.anonymize import anonymize_separated
from redactory.operators.findings import collect_spans, count_by_entity, cube_counts, explode_spans, with_policy
from redactory.operators.lexicon import attach
from redactory.operators.model import with_model_spans
from redactory.operators.upsert import latest
from redactory.operators.validate import policy_violations, schema_differences
from redactory.plans.database import append_anonymized, write_separated
from redactory.session import dealt, scratch_path
from redactory.session import spread as spread_out
from redactory.sources.catalog import materialize, save_table, upsert_table
from redactory.sources.paging import PageIndex, page, page_after, with_pages
from redactory.sources.store import UpsertStore
from redactory.streaming.jobs import (
    anonymize_stream,
    entity_counts_stream,
    file_stream,
    read_upserted,
    upsert_stream,
)

from . import people as derived
from .people import CITIES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
KEY = "0123456789abcdef"
#: Whether tables of a few large row groups are dealt out to all cores first; whoever runs the jobs may ask for it.
SPREAD = False


def spread(df: DataFrame, key: str) -> DataFrame:
    return spread_out(df, key) if SPREAD else df


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A text table, with enough partitions to search it in parallel."""
    return spread(read(spark, sf_dir, name).select(*columns), columns[0])


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.people(spark, sf_dir)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(derived.payments(spark, sf_dir), "order_key")


def all_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet.from_directory(spark, sf_dir)


def only(*entities: str, **options) -> Policy:
    return Policy.default(**options).only(*entities)


def recognizer(entity: str) -> list[D.Recognizer]:
    """The built-in recognizer of one entity alone: no context words, no threshold."""
    return [replace(r, context=()) for r in D.built_in() if r.entity == entity]


# ---- sources, sinks, catalog --------------------------------------------------------------------


def list_tables(spark, sf_dir):
    return all_tables(spark, sf_dir).names()


def table_schema(spark, sf_dir):
    return all_tables(spark, sf_dir).metadata().select("table", "ordinal", "column", "type", "eligible")


def table_row_counts(spark, sf_dir):
    return all_tables(spark, sf_dir).row_counts()


def page_scan(spark, sf_dir):
    paged = with_pages(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000)
    return paged.groupBy("page").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.max("row_in_page").alias("last_row"),
    )


def page_fetch(spark, sf_dir):
    return page(read(spark, sf_dir, "orders"), ["o_orderkey"], 500, 250)


def page_fetch_after(spark, sf_dir):
    return page_after(read(spark, sf_dir, "orders"), "o_orderkey", 749, 250)


def page_index_scan(spark, sf_dir):
    """``page_scan`` from the ranges of an index."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    paged = PageIndex.build(orders, "o_orderkey", scratch_path(spark, "pages"), 6).with_pages(1000)
    return paged.groupBy("page").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.max("row_in_page").alias("last_row"),
    )


def page_index_fetch(spark, sf_dir):
    """A page in the middle, read from the ranges that hold it."""
    return PageIndex.build(read(spark, sf_dir, "orders"), "o_orderkey", scratch_path(spark, "pages")).page_at(2, 250)


def catalog_upsert(spark, sf_dir):
    """``upsert_latest`` on a table of the catalog that knows its key."""
    events, name = read(spark, sf_dir, "events"), f"events_{uuid.uuid4().hex}"
    existing = latest(events.filter("event_type <> 'purchase'"), ["user_id"], ["ts", "event_id"])
    save_table(existing, name, ["user_id"], location=scratch_path(spark, "table"))
    incoming = events.filter("event_type = 'purchase'")
    upsert_table(incoming, name, ["ts", "event_id"], location=scratch_path(spark, "table"))
    return spark.table(name)


def materialized_query(spark, sf_dir):
    """``query_results_source`` with the rows of the query kept as a table before they are anonymized."""
    read(spark, sf_dir, "customer").createOrReplaceTempView("source_customers")
    sql = "SELECT c_custkey, c_name, c_mktsegment FROM source_customers WHERE c_mktsegment = ? AND c_nationkey < ?"
    name = f"results_{uuid.uuid4().hex}"
    kept = materialize(spark, sql, name, ["BUILDING", 12], ["c_custkey"], location=scratch_path(spark, "results"))
    return anonymize_table(kept, only(), TablePolicy(columns={"c_name": ColumnPolicy(holds="PERSON")}))


def encrypt_named_key(spark, sf_dir):
    """Two versions of a key that executors hold as a broadcast and no plan names by value; both are read back."""
    keys = spark.createDataFrame([("redactory.check.v1", KEY), ("redactory.check.v2", KEY[::-1])], "name string, key string")
    first, second = (masks.encrypt_by_name("redactory.check", i, keys=masks.KEYS)("email") for i in ("v1", "v2"))
    hidden = F.expr(f"CASE WHEN length(email) % 2 = 0 THEN {first} ELSE {second} END AS e")
    hidden = masks.with_keys(people(spark, sf_dir), keys).select("user_id", "email", masks.KEYS, hidden)
    return masked(
        hidden, "user_id", email=masks.decrypt_by_name("redactory.check", keys=masks.KEYS)("e"),
        key_id="substring_index(e, ':', 1)", hidden="NOT contains(e, email)",
    )


def upsert_latest(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    existing = latest(events.filter("event_type <> 'purchase'"), ["user_id"], ["ts", "event_id"])
    return upsert(existing, events.filter("event_type = 'purchase'"), ["user_id"], ["ts", "event_id"])


def upsert_masked_keys(spark, sf_dir):
    """Rows keyed by the original e-mail although the e-mail itself is masked in the result."""
    first = people(spark, sf_dir).select("email", "name", "bio")
    second = first.filter("name like 'A%'").withColumn("bio", F.concat("bio", F.lit(" Updated.")))
    merged = upsert(first, second, ["email"])
    return anonymize_table(merged, only("EMAIL_ADDRESS"))


def written_tables(spark, sf_dir):
    """Write tables anonymized, append an anonymized batch to one of them, read it back."""
    path = scratch_path(spark, "tables")
    frames = {"people": people(spark, sf_dir), "customer": read(spark, sf_dir, "customer").drop("c_acctbal")}
    write_anonymized(TableSet(spark, frames), path, Policy.default())
    more = frames["people"].select(*reversed(frames["people"].columns)).filter("locale = 'fr_FR'")
    more = more.withColumn("user_id", F.concat(F.lit("again-"), "user_id"))
    append_anonymized(more, f"{path}/people.parquet", Policy.default())
    return spark.read.parquet(f"{path}/people.parquet")


def empty_copy(spark, sf_dir):
    """A schema-only copy: same columns, no rows."""
    tables = all_tables(spark, sf_dir)
    copy = tables.empty_copy()
    columns = copy.metadata().groupBy("table").agg(F.count(F.lit(1)).alias("n_columns"))
    return copy.row_counts().join(columns, "table")


def schema_diff(spark, sf_dir):
    tables = all_tables(spark, sf_dir)
    changed = {n: f for n, f in tables.frames.items() if n != "region"}
    changed["nation"] = changed["nation"].select("n_name", "n_nationkey", "n_regionkey")
    changed["orders"] = changed["orders"].withColumnRenamed("o_orderdate", "o_date")
    changed["labels"] = changed["labels"].drop("toxic")
    return schema_differences(tables.metadata(), TableSet(spark, changed).metadata())


def schema_diff_anonymized(spark, sf_dir):
    """Anonymizing keeps every table and column: no differences."""
    tables = all_tables(spark, sf_dir)
    return schema_differences(tables.metadata(), anonymize_tables(tables, Policy.default()).metadata())


def query_results_source(spark, sf_dir):
    read(spark, sf_dir, "customer").createOrReplaceTempView("source_customers")
    sql = "SELECT c_custkey, c_name, c_mktsegment FROM source_customers WHERE c_mktsegment = ? AND c_nationkey < ?"
    query_results(spark, sql, ["BUILDING", 12])
    return anonymize_table(
        spark.table("results"), only(), TablePolicy(columns={"c_name": ColumnPolicy(holds="PERSON")})
    )


def query_results_named(spark, sf_dir):
    read(spark, sf_dir, "customer").createOrReplaceTempView("source_customers")
    sql = "SELECT c_nationkey, count(*) AS n FROM source_customers WHERE c_mktsegment = :segment GROUP BY c_nationkey"
    return query_results(spark, sql, {"segment": "MACHINERY"}, name=None)


# ---- eligibility --------------------------------------------------------------------------------

POLICIES = {
    "customer": TablePolicy(columns={"c_name": ColumnPolicy(enabled=False)}),
    "orders": TablePolicy(enabled=False),
    "documents": TablePolicy(columns={"doc_id": ColumnPolicy(enabled=True)}),
}


def eligible_columns(spark, sf_dir):
    return all_tables(spark, sf_dir).metadata(POLICIES).filter("eligible").select("table", "column")


def short_value_filter(spark, sf_dir):
    lines = texts(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("line")
    )
    return lines.groupBy("doc_id").agg(
        F.expr(f"count_if({worth_analysing('line')})").alias("n_analysed"),
        F.expr(f"count_if(NOT {worth_analysing('line')})").alias("n_skipped"),
    )


def bio_spans(spark, sf_dir) -> DataFrame:
    compiled = D.compile_recognizers(Policy.default(legacy_thresholds=True))
    return people(spark, sf_dir).select("user_id", F.expr(D.detect("bio", compiled)).alias("spans"))


def spans_entity_filter(spark, sf_dir):
    return explode_spans(
        bio_spans(spark, sf_dir), ["user_id"], only_entities("spans", ["URL", "IP_ADDRESS"])
    )


def spans_confidence_filter(spark, sf_dir):
    return explode_spans(bio_spans(spark, sf_dir), ["user_id"], at_least("spans", 0.95))


def policy_violations_query(spark, sf_dir):
    tables = {
        "customer": TablePolicy(columns={"c_name": ColumnPolicy(), "c_email": ColumnPolicy()}),
        "patients": TablePolicy(columns={"name": ColumnPolicy()}),
        "orders": TablePolicy(),
    }
    return policy_violations(all_tables(spark, sf_dir).metadata(), tables)


# ---- detection ----------------------------------------------------------------------------------


def documents(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text")


def findings_all(spark, sf_dir):
    return findings(documents(spark, sf_dir), ["doc_id"], "text", Policy.default())


def findings_with_policy(spark, sf_dir):
    return with_policy(findings_all(spark, sf_dir), Policy.default()).select(
        "doc_id", "entity", "start", "end", "score", "threshold", "strategy"
    )


CUSTOM = EntityPolicy(
    "SHOUTING", patterns=(Pattern("capitals", "[A-Z]{5,}"), Pattern("marks", "[A-Z]{3,}!!", 0.6)), threshold=0.5
)


def findings_custom_regex(spark, sf_dir):
    return findings(documents(spark, sf_dir), ["doc_id"], "text", only().with_entity(CUSTOM))


def findings_credit_card(spark, sf_dir):
    compiled = D.compile_recognizers(only("CREDIT_CARD"))
    return findings(people(spark, sf_dir), ["user_id"], "card", compiled)


def findings_address(spark, sf_dir):
    return findings(people(spark, sf_dir), ["user_id"], "address", only("LOCATION"))


DENIED_FEW = ("that", "erst", "Quevi", "mentenré")
DENIED_MANY = (
    "the", "and", "for", "with", "from", "this", "der", "die", "und", "das", "les", "des", "une", "los", "las", "que",
    "then", "erth", "ereanes", "onsh",
)


def findings_deny_list(spark, sf_dir):
    few = EntityPolicy("DENIED_FEW", deny=DENIED_FEW)
    many = EntityPolicy("DENIED_MANY", deny=DENIED_MANY)
    return findings(documents(spark, sf_dir), ["doc_id"], "text", Policy(entities=(few, many)))


def findings_context_boost(spark, sf_dir):
    compiled = D.compile_recognizers(only("US_SSN", "PHONE_NUMBER", "IP_ADDRESS", "URL"))
    return findings(people(spark, sf_dir), ["user_id"], "bio", compiled)


def findings_email(spark, sf_dir):
    return findings(documents(spark, sf_dir), ["doc_id"], "text", recognizer("EMAIL_ADDRESS"))


def findings_phone(spark, sf_dir):
    return findings(documents(spark, sf_dir), ["doc_id"], "text", recognizer("PHONE_NUMBER"))


def findings_ssn(spark, sf_dir):
    return findings(people(spark, sf_dir), ["user_id"], "bio", recognizer("US_SSN"))


def findings_card_luhn(spark, sf_dir):
    return findings(documents(spark, sf_dir), ["doc_id"], "text", recognizer("CREDIT_CARD"))


def findings_ip(spark, sf_dir):
    return findings(documents(spark, sf_dir), ["doc_id"], "text", recognizer("IP_ADDRESS"))


def findings_url(spark, sf_dir):
    pages = texts(spark, sf_dir, "pages", "page_id", "url", "html")
    found = [findings(pages, ["page_id"], c, recognizer("URL")).withColumn("column", F.lit(c)) for c in ("url", "html")]
    return found[0].unionByName(found[1])


def mask_person_column(spark, sf_dir):
    policy = TablePolicy(columns={"name": ColumnPolicy(holds="PERSON", entities=("PERSON",))})
    return anonymize_table(people(spark, sf_dir).select("user_id", "name"), only("PERSON"), policy)


def places(spark) -> DataFrame:
    rows = [(c, "LOCATION", 0.85) for c in CITIES] + [("Maple Ln", "LOCATION", 0.85), ("Pine", "LOCATION", 0.85)]
    return spark.createDataFrame(rows, "term string, entity string, score double")


def findings_place_join(spark, sf_dir):
    return lexicon_findings(people(spark, sf_dir), ["user_id"], "address", places(spark))


def findings_place_join_shuffled(spark, sf_dir):
    """The same join as done for a place list too large to broadcast."""
    return lexicon_findings(people(spark, sf_dir), ["user_id"], "address", places(spark), broadcast_limit=0)


def findings_supplier_names(spark, sf_dir):
    """A name list taken from a table: suppliers and customers share the digits of their names."""
    names = read(spark, sf_dir, "supplier").select(
        F.regexp_extract("s_name", "[0-9]+", 0).alias("term"), F.lit("PERSON").alias("entity"), F.lit(0.9).alias("score")
    )
    return lexicon_findings(read(spark, sf_dir, "customer"), ["c_custkey"], "c_name", names)


def anonymize_places(spark, sf_dir):
    """Findings of a joined place list brought back to their rows and masked with all others."""
    base = people(spark, sf_dir).select("user_id", "address")
    found = collect_spans(lexicon_findings(base, ["user_id"], "address", places(spark)), ["user_id"])
    return anonymize(attach(base, ["user_id"], found), "address", only("LOCATION"), "spans").drop("spans")


#: The city at the end of an address, for Spark and for DuckDB.
CITY = r", ([^,]*\p{L}[^,]*)$"


def names_policy(spark, sf_dir) -> Policy:
    """The default policy with the people, countries and companies of the tables, and the cities of the addresses."""
    listed = lambda df, column, entity: df.select(F.col(column).alias("term"), F.lit(entity).alias("entity")).distinct()
    known = derived.people(spark, sf_dir).withColumn("city", F.regexp_extract("address", CITY, 1))
    names = listed(known, "name", "PERSON").unionByName(listed(known, "city", "LOCATION"))
    names = names.unionByName(listed(read(spark, sf_dir, "nation"), "n_name", "LOCATION"))
    names = names.unionByName(listed(read(spark, sf_dir, "supplier"), "s_name", "ORG"))
    return Policy.default().with_listed(names.withColumn("score", F.lit(0.85)))


def contacts(spark, sf_dir) -> DataFrame:
    columns = ("user_id", "name", "bio", "note", "n_name", "s_name", "locale")
    return derived.contacts(spark, sf_dir).select(*columns)


def anonymize_table_names(spark, sf_dir):
    """Listed people, countries, cities and companies masked wherever they stand, with everything that patterns find."""
    return anonymize_table(contacts(spark, sf_dir), names_policy(spark, sf_dir))


def report_names(spark, sf_dir):
    """The report of the same job: detections per column and entity."""
    profile = R.profile_tables({"contacts": contacts(spark, sf_dir)}, names_policy(spark, sf_dir))
    return profile.select("column", "values_anonymized", F.explode("entities").alias("entity", "n_found"))


def stream_anonymize_names(spark, sf_dir):
    """The same job on a stream: files in, masked rows out."""
    arriving, out = scratch_path(spark, "names-in"), scratch_path(spark, "names-out")
    contacts(spark, sf_dir).write.parquet(arriving)
    stream = dealt(file_stream(spark, arriving, "*.parquet", files_per_batch=4), "user_id")
    anonymize_stream(stream, names_policy(spark, sf_dir), out, scratch_path(spark, "names-state")).awaitTermination()
    return spark.read.parquet(out)


def findings_optional_entities(spark, sf_dir):
    return findings(payments(spark, sf_dir), ["order_key"], "note", only("DATE_TIME", "MONEY", "IBAN_CODE"))


def findings_by_language(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return count_by_entity(findings(docs, ["lang"], "text", Policy.default(), language="lang"), "lang")


def language_policy() -> tuple[Policy, TablePolicy]:
    """Phone numbers as English texts write them, and a pattern for German and French texts only."""
    article = EntityPolicy(
        "ARTICLE", patterns=(Pattern("article", r"(?<![0-9A-Za-z_])(?:der|une)(?![0-9A-Za-z_])", 0.9, ("de", "fr")),), strategy="redact"
    )
    return Policy.default().with_entity(article), TablePolicy(language_column="lang")


def anonymize_by_language(spark, sf_dir):
    """One plan for all languages: recognizers and patterns apply by the language of the row."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return anonymize_table(docs, *language_policy())


def written_by_language(spark, sf_dir):
    """The same while tables are written; what was written is read back."""
    policy, own = language_policy()
    out = scratch_path(spark, "languages")
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    write_anonymized(TableSet(spark, {"documents": docs}), out, policy, {"documents": own})
    return spark.read.parquet(f"{out}/documents.parquet")


def stream_by_language(spark, sf_dir):
    policy, own = language_policy()
    stream = file_stream(spark, sf_dir, "documents.parquet").select("doc_id", "text", "lang")
    out, state = scratch_path(spark, "languages-out"), scratch_path(spark, "languages-state")
    anonymize_stream(stream, policy, out, state, own).awaitTermination()
    return spark.read.parquet(out)


def report_by_language(spark, sf_dir):
    """Detections of the report of the same job."""
    policy, own = language_policy()
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return R.entities_found(R.profile_table(docs, "documents", policy, own))


def findings_negative_control(spark, sf_dir):
    """Dialogues hold no personal data: a count per table, expected to be zero."""
    found = findings(texts(spark, sf_dir, "conversations", "conv_id", "text"), ["conv_id"], "text",
                     only("EMAIL_ADDRESS", "PHONE_NUMBER", "US_SSN", "CREDIT_CARD", "LOCATION", "IP_ADDRESS", "URL"))
    return found.agg(F.count(F.lit(1)).alias("n_found"))


def findings_model(spark, sf_dir):
    """The model hook with a stand-in that calls every known city a place."""

    def load():
        def predict(batch: pd.Series):
            known = re.compile("|".join(CITIES))
            return [[("LOCATION", m.start(), m.end(), 0.85) for m in known.finditer(t)] for t in batch]

        return predict

    base = people(spark, sf_dir).select("user_id", "address")
    return explode_spans(with_model_spans(base, "address", load), ["user_id"], "model_spans")


# ---- anonymization ------------------------------------------------------------------------------


def anonymize_documents(spark, sf_dir):
    return anonymize(documents(spark, sf_dir), "text", Policy.default())


def strategy(entity: str, name: str, **params) -> Policy:
    policy = only(entity)
    return policy.with_entity(replace(policy.entity(entity), strategy=name, params=params))


def replace_email(spark, sf_dir):
    return anonymize(documents(spark, sf_dir), "text", strategy("EMAIL_ADDRESS", "replace"))


def masked(df: DataFrame, key: str, **columns: str) -> DataFrame:
    return df.select(key, *[F.expr(expression).alias(name) for name, expression in columns.items()])


def mask_tail(spark, sf_dir):
    return masked(
        people(spark, sf_dir),
        "user_id",
        tail=masks.mask_chars(7)("phone"),
        head=masks.mask_chars(4, from_end=False, char="#")("card"),
        whole=masks.mask_chars(99)("ssn"),
    )


def hash_values(spark, sf_dir):
    return masked(
        people(spark, sf_dir),
        "user_id",
        email_hash=masks.hash_with()("email"),
        email_md5=masks.hash_with("md5")("email"),
    )


def encrypt_roundtrip(spark, sf_dir):
    return masked(
        people(spark, sf_dir),
        "user_id",
        email=masks.decrypt_with(KEY)(masks.encrypt_with(KEY)("email")),
        email_ecb=masks.decrypt_with(KEY, "ECB")(masks.encrypt_with(KEY, "ECB")("email")),
        hidden=f"{masks.encrypt_with(KEY)('email')} != email",
    )


def redact_ssn(spark, sf_dir):
    return anonymize(people(spark, sf_dir).select("user_id", "bio"), "bio", only("US_SSN"))


def mask_email_values(spark, sf_dir):
    found = findings_email(spark, sf_dir).select("doc_id", "value")
    return found.select("doc_id", "value", F.expr(masks.mask_email("value")).alias("masked"))


def mask_email_people(spark, sf_dir):
    return masked(people(spark, sf_dir), "user_id", masked=masks.mask_email("email"))


def mask_person_values(spark, sf_dir):
    return masked(people(spark, sf_dir), "user_id", masked=masks.mask_person("name"))


def mask_location_values(spark, sf_dir):
    return masked(people(spark, sf_dir), "user_id", masked=masks.mask_location("address"))


OVERLAPPING = (
    EntityPolicy("HOST", patterns=(Pattern("host", r"[a-z0-9]+\.example\.com", 0.75),), strategy="replace"),
    EntityPolicy("REACH", patterns=(Pattern("reach", r"reached at [a-z]+", 0.95),), strategy="hash"),
)


def overlapping_policy() -> Policy:
    policy = Policy.default()
    for extra in OVERLAPPING:
        policy = policy.with_entity(extra)
    return policy


def resolved_spans(spark, sf_dir):
    compiled = D.compile_recognizers(overlapping_policy())
    base = people(spark, sf_dir).select("user_id", F.expr(D.detect("bio", compiled)).alias("spans"))
    return explode_spans(base, ["user_id"], resolve_spans("spans"))


def anonymize_overlapping(spark, sf_dir):
    return anonymize(people(spark, sf_dir).select("user_id", "bio"), "bio", overlapping_policy())


PEOPLE_POLICY = TablePolicy(columns={"name": ColumnPolicy(holds="PERSON"), "locale": ColumnPolicy(enabled=False)})


def anonymize_people(spark, sf_dir):
    return anonymize_table(people(spark, sf_dir), Policy.default(), PEOPLE_POLICY)


def anonymize_typed(spark, sf_dir):
    """Dates and integers are inspected and become text; arrays and ids stay as they are."""
    dated = replace(Policy.default().entity("DATE_TIME"), enabled=True)
    base = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", F.array("value").alias("v"))
    base = base.withColumn("ts", F.date_trunc("second", "ts")).withColumn("n", F.length("event_type"))
    return anonymize_table(base, Policy.default().with_entity(dated))


def python_mask_phones(spark, sf_dir):
    """A mask with a Python body, applied in Arrow batches to the detected values only."""
    register_python_mask("reverse_digits", lambda values: values.str[::-1])
    policy = strategy("PHONE_NUMBER", "custom", **{"lambda": "reverse_digits"})
    return anonymize_table(people(spark, sf_dir).select("user_id", "bio"), policy)


def odd_phone_policy() -> Policy:
    """A Python mask that cannot do numbers that end in 0; rows that hold one are put aside."""

    def reverse(values: pd.Series) -> pd.Series:
        if values.str.endswith("0").any():
            raise ValueError("ends in 0")
        return values.str[::-1]

    register_python_mask("reverse_most", reverse)
    return replace(strategy("PHONE_NUMBER", "custom", **{"lambda": "reverse_most"}), on_error="quarantine")


def quarantined_rows(spark, sf_dir):
    """Rows whose masks worked, and with their reason those that were put aside."""
    clean, failed = anonymize_separated(people(spark, sf_dir).select("user_id", "bio"), odd_phone_policy())
    reason = F.concat_ws(": ", F.col("errors")[0]["column"], F.col("errors")[0]["entity"], F.col("errors")[0]["error"])
    return clean.withColumn("reason", F.lit(None).cast("string")).unionByName(failed.withColumn("reason", reason).drop("errors"))


def quarantine_counts(spark, sf_dir):
    """The failures of a job that writes the rest, by column, entity and error, next to the rows it wrote."""
    out = scratch_path(spark, "clean")
    frame = people(spark, sf_dir).select("user_id", "phone", "bio")
    counts = write_separated(frame, out, scratch_path(spark, "quarantine"), odd_phone_policy())
    return counts.withColumn("n_written", F.lit(spark.read.parquet(out).count()).cast("bigint"))


def process_table_batches(spark, sf_dir):
    """A user function over batches of rows."""

    def shout(batches):
        for batch in batches:
            yield batch.assign(c_mktsegment=batch["c_mktsegment"].str.lower(), n=batch["c_name"].str.len())

    schema = "c_custkey bigint, c_name string, c_mktsegment string, n bigint"
    return process_table(read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), shout, schema)


# ---- report -------------------------------------------------------------------------------------


def report_frames(spark, sf_dir) -> dict[str, DataFrame]:
    """``people`` and its copy under the name of a query result, next to plain tables."""
    return {
        "people": people(spark, sf_dir),
        "results": people(spark, sf_dir),
        "documents": texts(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars"),
        "supplier": read(spark, sf_dir, "supplier"),
        "orders": read(spark, sf_dir, "orders"),
        "labels": read(spark, sf_dir, "labels"),
    }


REPORT_POLICIES = {"orders": TablePolicy(enabled=False)}


def profile(spark, sf_dir):
    return R.profile_tables(report_frames(spark, sf_dir), Policy.default(), REPORT_POLICIES)


def report_totals(spark, sf_dir):
    return R.totals(profile(spark, sf_dir))


def report_by_table(spark, sf_dir):
    return R.by_table(profile(spark, sf_dir))


def report_by_column(spark, sf_dir):
    return profile(spark, sf_dir).filter("column is not null").select(
        "table", "column", "values_processed", "values_anonymized"
    )


def entities_found(spark, sf_dir):
    return R.entities_found(profile(spark, sf_dir))


def findings_cube(spark, sf_dir):
    counted = profile(spark, sf_dir).select("table", "column", F.explode("entities").alias("entity", "n"))
    dims = ("table", "column", "entity")
    return counted.cube(*dims).agg(
        F.sum("n").alias("n_found"), *[F.grouping(d).cast("int").alias(f"g_{d}") for d in dims]
    )


def findings_cube_rows(spark, sf_dir):
    """The same breakdown starting from findings as rows."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return cube_counts(findings(docs, ["lang", "source"], "text", Policy.default()), "lang", "source", "entity")


def anonymize_database_report(spark, sf_dir):
    """Every driver table, reported in one action."""
    frames = dict(all_tables(spark, sf_dir).frames)
    for name in ("documents", "pages", "conversations", "events", "orders", "lineitem"):
        frames[name] = spread(frames[name], frames[name].columns[0])
    full = R.report(R.profile_tables(frames, Policy.default()), Policy.default())
    stats, found = F.col("processing_stats"), F.col("anonymization_stats")
    return full.select(
        stats["total_tables"].alias("total_tables"),
        stats["total_rows"].alias("total_rows"),
        stats["anonymized_rows"].alias("anonymized_rows"),
        found["total_values_processed"].alias("values_processed"),
        found["total_values_anonymized"].alias("values_anonymized"),
        *[F.coalesce(F.try_element_at(found["entities_found"], F.lit(e)), F.lit(0)).alias(f"n_{e.lower()}")
          for e in ("EMAIL_ADDRESS", "PHONE_NUMBER", "US_SSN", "CREDIT_CARD", "IP_ADDRESS", "URL", "LOCATION")],
        F.size(found["columns_processed"]).cast("bigint").alias("n_columns"),
    )


def report_json(spark, sf_dir):
    return R.report_json(R.report(profile(spark, sf_dir), Policy.default()))


def observed_report(spark, sf_dir):
    """The report whose counters were observed while the tables were written."""
    frames = {n: f for n, f in report_frames(spark, sf_dir).items()}
    full = write_anonymized(
        TableSet(spark, frames), scratch_path(spark, "observed"), Policy.default(), REPORT_POLICIES
    )
    stats, found = F.col("processing_stats"), F.col("anonymization_stats")
    return full.select(
        stats["total_tables"].alias("total_tables"),
        stats["total_rows"].alias("total_rows"),
        stats["anonymized_rows"].alias("anonymized_rows"),
        found["total_values_processed"].alias("values_processed"),
        found["total_values_anonymized"].alias("values_anonymized"),
        found["anonymization_rate"].alias("anonymization_rate"),
    )


def report_file(spark, sf_dir):
    """The JSON file that a run leaves, read back by its fields."""
    path, file = scratch_path(spark, "reported"), scratch_path(spark, "report")
    write_anonymized(
        TableSet(spark, report_frames(spark, sf_dir)), path, Policy.default(), REPORT_POLICIES, report_path=file
    )
    stats, found = F.col("processing_stats"), F.col("anonymization_stats")
    return R.read_report(spark, file).select(
        stats["total_tables"].alias("total_tables"),
        stats["processed_rows"].alias("total_rows"),
        stats["anonymized_rows"].alias("anonymized_rows"),
        found["total_values_processed"].alias("values_processed"),
        found["total_values_anonymized"].alias("values_anonymized"),
        found["anonymization_rate"].alias("anonymization_rate"),
        stats["progress_percent"].alias("progress_percent"),
        (stats["rows_per_second"] * stats["elapsed_time"]).cast("decimal(20,0)").cast("bigint").alias("rows_in_time"),
    )


def report_failed_table(spark, sf_dir):
    """One of three tables cannot be written: the others are, and the report says how far the run came."""
    broken = F.when(F.col("c_custkey") >= 0, F.raise_error(F.lit("unreadable"))).otherwise(F.col("c_name"))
    frames = {
        "supplier": read(spark, sf_dir, "supplier"),
        "customer": read(spark, sf_dir, "customer").withColumn("c_name", broken),
        "nation": read(spark, sf_dir, "nation"),
    }
    path = scratch_path(spark, "partly")
    full = write_anonymized(TableSet(spark, frames), path, Policy.default(), on_table_error="report")
    stats = F.col("processing_stats")
    written = [spark.read.parquet(f"{path}/{n}.parquet").count() for n in ("supplier", "nation")]
    return full.select(
        stats["total_tables"].alias("total_tables"),
        stats["processed_tables"].alias("processed_tables"),
        stats["total_rows"].alias("total_rows"),
        stats["processed_rows"].alias("processed_rows"),
        stats["progress_percent"].alias("progress_percent"),
        F.array_join(F.map_keys(stats["failed_tables"]), ",").alias("failed"),
        F.lit(sum(written)).cast("bigint").alias("rows_written"),
    )


# ---- streaming ----------------------------------------------------------------------------------


def stream_anonymize(spark, sf_dir):
    stream = file_stream(spark, sf_dir, "documents.parquet").select("doc_id", "text")
    out = scratch_path(spark, "stream-out")
    anonymize_stream(stream, Policy.default(), out, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(out)


def stream_entities_found(spark, sf_dir):
    stream = file_stream(spark, sf_dir, "documents.parquet").select("doc_id", "text")
    out = scratch_path(spark, "counts-out")
    entity_counts_stream(
        stream, ["doc_id"], "text", Policy.default(), out, scratch_path(spark, "counts-state")
    ).awaitTermination()
    return spark.read.parquet(out)


def stream_upsert(spark, sf_dir):
    """Events arriving in several files and batches, kept as the latest event per user."""
    arriving = scratch_path(spark, "upsert-in")
    read(spark, sf_dir, "events").repartition(6, "event_id").write.parquet(arriving)
    stream = file_stream(spark, arriving, "*.parquet", files_per_batch=2)
    out = scratch_path(spark, "upsert-out")
    upsert_stream(stream, ["user_id"], ["ts", "event_id"], out, scratch_path(spark, "upsert-state")).awaitTermination()
    return read_upserted(spark, out, ["user_id"], ["ts", "event_id"])


def stream_upsert_compacted(spark, sf_dir):
    """The same with a log that is folded into the snapshot every second batch while the stream runs."""
    arriving = scratch_path(spark, "upsert-in")
    read(spark, sf_dir, "events").repartition(7, "event_id").write.parquet(arriving)
    stream = file_stream(spark, arriving, "*.parquet", files_per_batch=1)
    out = scratch_path(spark, "upsert-out")
    state = scratch_path(spark, "upsert-state")
    upsert_stream(stream, ["user_id"], ["ts", "event_id"], out, state, compact_every=2).awaitTermination()
    return read_upserted(spark, out)


def store_by_arrival(spark, sf_dir):
    """``upsert_latest`` through a store: other events first, purchases after a compaction, keys known to the store."""
    events, path = read(spark, sf_dir, "events"), scratch_path(spark, "store")
    store = UpsertStore.create(spark, path, ["user_id"], ["ts", "event_id"])
    store.write(events.filter("event_type <> 'purchase'"))
    store.compact()
    UpsertStore.open(spark, path).write(events.filter("event_type = 'purchase'"))
    return UpsertStore.open(spark, path).read()


QUERIES = {
    "table_row_counts": table_row_counts,
    "page_scan": page_scan,
    "page_fetch": page_fetch,
    "page_fetch_after": page_fetch_after,
    "page_index_scan": page_index_scan,
    "page_index_fetch": page_index_fetch,
    "catalog_upsert": catalog_upsert,
    "materialized_query": materialized_query,
    "encrypt_named_key": encrypt_named_key,
    "upsert_latest": upsert_latest,
    "upsert_masked_keys": upsert_masked_keys,
    "written_tables": written_tables,
    "query_results_source": query_results_source,
    "query_results_named": query_results_named,
    "short_value_filter": short_value_filter,
    "spans_entity_filter": spans_entity_filter,
    "spans_confidence_filter": spans_confidence_filter,
    "findings": findings_all,
    "findings_with_policy": findings_with_policy,
    "findings_custom_regex": findings_custom_regex,
    "findings_credit_card": findings_credit_card,
    "findings_address": findings_address,
    "findings_deny_list": findings_deny_list,
    "findings_context_boost": findings_context_boost,
    "findings_email": findings_email,
    "findings_phone": findings_phone,
    "findings_ssn": findings_ssn,
    "findings_card_luhn": findings_card_luhn,
    "findings_ip": findings_ip,
    "findings_url": findings_url,
    "mask_person_column": mask_person_column,
    "findings_place_join": findings_place_join,
    "findings_place_join_shuffled": findings_place_join_shuffled,
    "findings_supplier_names": findings_supplier_names,
    "anonymize_places": anonymize_places,
    "anonymize_table_names": anonymize_table_names,
    "report_names": report_names,
    "stream_anonymize_names": stream_anonymize_names,
    "findings_optional_entities": findings_optional_entities,
    "findings_by_language": findings_by_language,
    "anonymize_by_language": anonymize_by_language,
    "written_by_language": written_by_language,
    "stream_by_language": stream_by_language,
    "report_by_language": report_by_language,
    "findings_negative_control": findings_negative_control,
    "findings_model": findings_model,
    "anonymize_documents": anonymize_documents,
    "replace_email": replace_email,
    "mask_tail": mask_tail,
    "hash_values": hash_values,
    "encrypt_roundtrip": encrypt_roundtrip,
    "redact_ssn": redact_ssn,
    "mask_email_values": mask_email_values,
    "mask_email_people": mask_email_people,
    "mask_person_values": mask_person_values,
    "mask_location_values": mask_location_values,
    "resolved_spans": resolved_spans,
    "anonymize_overlapping": anonymize_overlapping,
    "anonymize_table": anonymize_people,
    "anonymize_typed": anonymize_typed,
    "python_mask_phones": python_mask_phones,
    "quarantined_rows": quarantined_rows,
    "quarantine_counts": quarantine_counts,
    "process_table_batches": process_table_batches,
    "report_totals": report_totals,
    "report_by_table": report_by_table,
    "report_by_column": report_by_column,
    "entities_found": entities_found,
    "findings_cube": findings_cube,
    "findings_cube_rows": findings_cube_rows,
    "anonymize_database_report": anonymize_database_report,
    "report_json": report_json,
    "observed_report": observed_report,
    "report_file": report_file,
    "report_failed_table": report_failed_table,
    "stream_anonymize": stream_anonymize,
    "stream_entities_found": stream_entities_found,
    "stream_upsert": stream_upsert,
    "stream_upsert_compacted": stream_upsert_compacted,
    "store_by_arrival": store_by_arrival,
}
#: Jobs that look at names and types of the tables only, not at rows: tested, not registered.
METADATA = {
    "list_tables": list_tables,
    "table_schema": table_schema,
    "empty_copy": empty_copy,
    "schema_diff": schema_diff,
    "schema_diff_anonymized": schema_diff_anonymized,
    "eligible_columns": eligible_columns,
    "policy_violations": policy_violations_query,
}
