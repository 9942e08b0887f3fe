"""The same queries in DuckDB SQL, stated relationally: matches are unnested, overlaps are resolved
with windows over segments, texts are put together with ordered string aggregation."""

from __future__ import annotations

from redactory.policy_defaults import ADDRESS_CONTEXT, DEFAULT_POLICY, STREET_WORDS

from . import jobs
from .people import CITIES, CONTACTS_SQL, PAYMENTS_SQL, PEOPLE_SQL, duck

PEOPLE = f"({duck(PEOPLE_SQL)}) people"
CONTACTS = f"({duck(CONTACTS_SQL)}) contacts"
PAYMENTS = f"({duck(PAYMENTS_SQL)}) payments"
ENTITY = {e["entity_type"]: e for e in DEFAULT_POLICY["entities"].values()}

# Patterns in RE2, which has no look-around; \b is the ASCII word boundary there.
EMAIL = (r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+", 1.0, "")
PHONE = (r"(?:\+\d{1,3}[ \-])?\(?\b\d{3}\)?[\s.\-]\d{3}[\s.\-]\d{4}\b", 0.7, "")
SSN = (r"\b\d{3}-\d{2}-\d{4}\b", 0.9, "")
CARD = (r"\b\d{16}\b", 1.0, "luhn")
IP = (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", 0.95, "octets")
URL = (r"""https?://[^\s"'<>]+""", 0.7, "")
ADDRESS = [
    (rf"\b\d+(?:\s+[A-Za-z]+)+\s+(?:{STREET_WORDS})\b(?:,\s*[A-Za-z\s]+)*", 0.8, ""),
    (rf"\b\d+\s+[A-Za-z\s]+(?:{STREET_WORDS})\b", 0.7, ""),
    (r"\b\d+\s+[A-Za-z\s]+,\s*[A-Za-z\s]+,\s*[A-Za-z\s]+", 0.8, ""),
]
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATES = [
    (r"\b\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2})?)?\b", 0.85, ""),
    (r"\b\d{1,2}/\d{1,2}/\d{2,4}\b", 0.75, ""),
    (rf"\b(?:{MONTHS})\s\d{{1,2}},\s\d{{4}}\b", 0.85, ""),
]
MONEY = [
    (r"[$€£]\s?\d[\d,]*(?:\.\d{1,2})?\b", 0.85, ""),
    (r"\b\d[\d,]*(?:\.\d{1,2})?\s(?:USD|EUR|GBP)\b", 0.85, ""),
]
IBAN = (r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b", 0.9, "")
DASHED = [(p["regex"], p["score"], "") for p in ENTITY["CREDIT_CARD"]["regex_patterns"]]

PATTERNS = {
    "EMAIL_ADDRESS": [EMAIL],
    "PHONE_NUMBER": [PHONE],
    "US_SSN": [SSN],
    "CREDIT_CARD": [CARD, *DASHED],
    "LOCATION": ADDRESS,
    "IP_ADDRESS": [IP],
    "URL": [URL],
    "DATE_TIME": DATES,
    "MONEY": MONEY,
    "IBAN_CODE": [IBAN],
}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


LUHN = (
    "list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 0 THEN CAST(substr({v}, i, 1) AS INT) "
    "WHEN CAST(substr({v}, i, 1) AS INT) > 4 THEN 2 * CAST(substr({v}, i, 1) AS INT) - 9 "
    "ELSE 2 * CAST(substr({v}, i, 1) AS INT) END)) % 10 = 0"
)


def raw_spans(source: str, key: str, text: str, entity: str, pattern: tuple, words: tuple[str, ...] = ()) -> str:
    """Matches of one pattern, boosted where a context word precedes."""
    regex, score, check = pattern
    points = dbl(score)
    if check == "luhn":
        points = f"CASE WHEN {LUHN.format(v='v')} THEN {dbl(score)} ELSE {dbl(0.3)} END"
    valid = "len(list_filter(string_split(v, '.'), lambda o: CAST(o AS INT) > 255)) = 0" if check == "octets" else "true"
    ahead = "lower(substr(t, greatest(s - 60, 0) + 1, s - greatest(s - 60, 0)))"
    near = " OR ".join(f"contains({ahead}, {q(w.lower())})" for w in words)
    final = f"CASE WHEN {near} THEN least({dbl(1.0)}, pts + {dbl(0.35)}) ELSE pts END" if words else "pts"
    return f"""SELECT {key}, {q(entity)} AS entity, s AS start, CAST(s + length(v) AS INTEGER) AS "end", {final} AS score, v AS value
FROM (SELECT *, {points} AS pts FROM (
 SELECT {key}, t, m[i] AS v, CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
   + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS INTEGER) AS s
 FROM (SELECT {key}, {text} AS t, regexp_extract_all({text}, {q(regex)}) AS m, string_split_regex({text}, {q(regex)}) AS g
       FROM {source} WHERE regexp_matches({text}, {q(regex)})) x, unnest(range(1, len(m) + 1)) AS u(i)) y WHERE {valid}) z"""


def spans(
    source: str, key: str, text: str, entities: list[str], plain: bool = False, extra: dict | None = None,
    legacy: bool = False,
) -> str:
    """Findings of the named entities under the default policy; ``plain`` leaves out context words
    and thresholds, ``legacy`` the thresholds only, ``extra`` adds patterns of further entities."""
    parts = []
    for entity in entities:
        item = ENTITY[entity]
        context = () if plain else tuple(item["context_words"])
        floor = 0 if plain or legacy else item["confidence_threshold"]
        for pattern in PATTERNS[entity]:
            words = tuple(dict.fromkeys(ADDRESS_CONTEXT + context)) if entity == "LOCATION" and not plain else context
            parts.append(
                f"SELECT * FROM ({raw_spans(source, key, text, entity, pattern, words)}) WHERE score >= {dbl(floor)}"
            )
    for entity, patterns in (extra or {}).items():
        parts += [raw_spans(source, key, text, entity, p) for p in patterns]
    union = "\nUNION ALL\n".join(parts)
    return f"""SELECT {key}, entity, start, "end", max(score) AS score, value FROM ({union}) a
GROUP BY {key}, entity, start, "end", value"""


DEFAULT_ENTITIES = ["EMAIL_ADDRESS", "PHONE_NUMBER", "US_SSN", "CREDIT_CARD", "LOCATION", "IP_ADDRESS", "URL"]


def resolved(found: str, key: str) -> str:
    """CTEs ending in ``final(key, entity, start, end, score)``: every character to its strongest span."""
    return f"""found AS ({found}),
reach AS (SELECT *, max("end") OVER (PARTITION BY {key}, entity ORDER BY start, "end"
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM found),
island AS (SELECT *, sum(CASE WHEN far IS NULL OR start >= far THEN 1 ELSE 0 END)
   OVER (PARTITION BY {key}, entity ORDER BY start, "end") AS n FROM reach),
hull AS (SELECT {key}, entity, min(start) AS hs, max("end") AS he, max(score) AS score FROM island GROUP BY {key}, entity, n),
edge AS (SELECT {key}, hs AS p FROM hull UNION SELECT {key}, he FROM hull),
seg AS (SELECT {key}, p AS a, lead(p) OVER (PARTITION BY {key} ORDER BY p) AS b FROM edge),
owned AS (SELECT seg.{key}, a, b, entity, hs, he, score,
   row_number() OVER (PARTITION BY seg.{key}, a ORDER BY score DESC, he - hs DESC, hs, entity) AS r
   FROM seg JOIN hull ON hull.{key} = seg.{key} AND hs <= a AND he >= b),
best AS (SELECT *, CASE WHEN lag(b) OVER w = a AND lag(entity) OVER w = entity AND lag(hs) OVER w = hs
   AND lag(he) OVER w = he THEN 0 ELSE 1 END AS fresh FROM owned WHERE r = 1 WINDOW w AS (PARTITION BY {key} ORDER BY a)),
run AS (SELECT *, sum(fresh) OVER (PARTITION BY {key} ORDER BY a) AS n FROM best),
final AS (SELECT {key}, any_value(entity) AS entity, min(a) AS start, max(b) AS "end", max(score) AS score
   FROM run GROUP BY {key}, n)"""


def stars(v: str, shown: int) -> str:
    return f"concat(left({v}, {shown}), repeat('*', length({v}) - {shown}))"


def mask_email(v: str) -> str:
    user = f"split_part({v}, '@', 1)"
    domain = f"substr({v}, length({user}) + 2)"
    host = f"split_part({domain}, '.', 1)"
    short = lambda x, n: f"CASE WHEN length({x}) <= 2 THEN {x} ELSE {stars(x, n)} END"
    return (
        f"CASE WHEN NOT contains({v}, '@') THEN {v} ELSE concat({short(user, 2)}, '@', CASE WHEN contains({domain}, '.') "
        f"THEN concat({short(host, 1)}, '.', string_split({domain}, '.')[-1]) ELSE {domain} END) END"
    )


def mask_person(v: str) -> str:
    return (
        f"array_to_string(list_transform(list_filter(string_split_regex({v}, '\\s+'), lambda w: w <> ''), "
        f"lambda w: CASE WHEN length(w) <= 2 THEN w ELSE {stars('w', 2)} END), ' ')"
    )


def mask_location(v: str) -> str:
    word = (
        "CASE WHEN regexp_full_match(w, '[0-9]+') THEN CASE WHEN length(w) = 1 THEN w ELSE " + stars("w", 1) + " END "
        "WHEN length(w) <= 2 OR lower(w) IN ('st','ave','rd','dr','ln','blvd','way','ct','pl') THEN w ELSE "
        + stars("w", 1) + " END"
    )
    part = f"array_to_string(list_transform(string_split_regex(p, '\\s+'), lambda w: {word}), ' ')"
    trimmed = f"list_transform(string_split({v}, ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))"
    return f"array_to_string(list_transform(list_filter({trimmed}, lambda p: p <> ''), lambda p: {part}), ', ')"


def mask_tail(v: str, n: int) -> str:
    return f"concat(left({v}, greatest(length({v}) - {n}, 0)), repeat('*', least(length({v}), {n})))"


def masked(v: str, entity: str = "entity", extra: str = "") -> str:
    return (
        f"CASE {entity} WHEN 'EMAIL_ADDRESS' THEN {mask_email(v)} WHEN 'PERSON' THEN {mask_person(v)} "
        f"WHEN 'LOCATION' THEN {mask_location(v)} WHEN 'US_SSN' THEN '' WHEN 'PHONE_NUMBER' THEN {mask_tail(v, 7)} "
        f"WHEN 'CREDIT_CARD' THEN {mask_tail(v, 12)} WHEN 'IP_ADDRESS' THEN {mask_tail(v, 8)} "
        f"WHEN 'URL' THEN {mask_tail(v, 10)} WHEN 'DATE_TIME' THEN {mask_tail(v, 6)} {extra} ELSE '<REDACTED>' END"
    )


def rewritten(source: str, key: str, text: str, found: str, columns: str = "", extra: str = "", mask: str | None = None) -> str:
    """``key, columns, text`` with all resolved spans masked."""
    value = 'substr(t, start + 1, "end" - start)'
    return f"""WITH src AS (SELECT * FROM {source}),
{resolved(found.replace(source, 'src'), key)},
piece AS (SELECT final.{key}, start, "end", src.{text} AS t,
  coalesce(lag("end") OVER (PARTITION BY final.{key} ORDER BY start), 0) AS before, entity FROM final JOIN src ON src.{key} = final.{key}),
made AS (SELECT {key}, string_agg(concat(substr(t, before + 1, start - before), {mask or masked(value, extra=extra)}), '' ORDER BY start)
  || substr(any_value(t), max("end") + 1) AS done FROM piece GROUP BY {key})
SELECT src.{key}, {columns} coalesce(made.done, src.{text}) AS {text} FROM src LEFT JOIN made ON made.{key} = src.{key}"""


def described() -> str:
    """Columns of all driver tables with Spark's type names and the eligibility rules."""
    one = [
        f"SELECT {q(t)} AS \"table\", CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal, column_name AS \"column\", "
        f"column_type AS duck FROM (DESCRIBE SELECT * FROM {t})"
        for t in jobs.TABLES
    ]
    return f"""SELECT "table", ordinal, "column", CASE duck WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
 WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
 ELSE duck END AS type,
 duck NOT LIKE '%[]' AND lower("column") NOT IN ('user_id','id','uuid','guid','key','pk') AND NOT ends_with(lower("column"), '_id') AS eligible
FROM ({' UNION ALL '.join(one)}) d"""


def tokens(source: str, key: str, text: str, words: tuple[str, ...], entity: str) -> str:
    hits = raw_spans(source, key, text, entity, (r"[\p{L}\p{N}_]+", 1.0, ""))
    return f"SELECT * FROM ({hits}) WHERE value IN ({', '.join(map(q, words))})"


def report_cells() -> str:
    """CTE ``cells``: one row (tab, col, rid, entity) per detection in the reported tables."""
    columns = ("email", "name", "phone", "address", "ssn", "card", "locale", "bio")
    found = "\nUNION ALL\n".join(
        f"SELECT {q(c)} AS col, user_id AS rid, entity FROM ({spans('everyone', 'user_id', c, DEFAULT_ENTITIES)})"
        for c in columns
    )
    docs = spans("documents", "doc_id", "text", DEFAULT_ENTITIES)
    return f"""everyone AS MATERIALIZED (SELECT * FROM {PEOPLE}), personal AS MATERIALIZED ({found}),
cells AS MATERIALIZED (SELECT 'people' AS tab, * FROM personal UNION ALL SELECT 'results', * FROM personal
 UNION ALL SELECT 'documents', 'text', CAST(doc_id AS VARCHAR), entity FROM ({docs}))"""


ELIGIBLE_REPORT = (
    [(t, c) for t in ("people", "results") for c in ("email", "name", "phone", "address", "ssn", "card", "locale", "bio")]
    + [("documents", c) for c in ("text", "lang", "source", "n_chars")]
    + [("supplier", c) for c in ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")]
    + [("labels", c) for c in ("quality", "toxic")]
)
REPORT_ROWS = (
    "SELECT 'people' AS tab, count(*) AS n FROM customer UNION ALL SELECT 'results', count(*) FROM customer "
    "UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'supplier', count(*) FROM supplier "
    "UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'labels', count(*) FROM labels"
)
ELIGIBLE_VALUES = "(VALUES " + ", ".join(f"({q(t)}, {q(c)})" for t, c in ELIGIBLE_REPORT) + ") e(tab, col)"


BY_COLUMN = f"""SELECT e.tab AS "table", e.col AS "column", n AS values_processed, coalesce(hits, 0) AS values_anonymized
FROM {ELIGIBLE_VALUES} JOIN ({REPORT_ROWS}) r ON r.tab = e.tab
LEFT JOIN (SELECT tab, col, count(DISTINCT rid) AS hits FROM cells GROUP BY tab, col) h ON h.tab = e.tab AND h.col = e.col"""

BY_TABLE = f"""SELECT r.tab AS "table", r.n AS n_rows, coalesce(a.rows_hit, 0) AS anonymized_rows,
 CAST(coalesce(c.p, 0) AS BIGINT) AS values_processed, CAST(coalesce(c.a, 0) AS BIGINT) AS values_anonymized
FROM ({REPORT_ROWS}) r
LEFT JOIN (SELECT tab, count(DISTINCT rid) AS rows_hit FROM cells GROUP BY tab) a ON a.tab = r.tab
LEFT JOIN (SELECT "table" AS tab, sum(values_processed) AS p, sum(values_anonymized) AS a FROM ({BY_COLUMN}) GROUP BY 1) c ON c.tab = r.tab"""

TOTALS = f"""SELECT count(*) AS total_tables, CAST(sum(n_rows) AS BIGINT) AS total_rows, CAST(sum(anonymized_rows) AS BIGINT) AS anonymized_rows,
 CAST(sum(values_processed) AS BIGINT) AS values_processed, CAST(sum(values_anonymized) AS BIGINT) AS values_anonymized,
 CAST(sum(values_anonymized) AS DOUBLE) * 100 / CAST(sum(values_processed) AS DOUBLE) AS anonymization_rate FROM ({BY_TABLE})"""


def database_report() -> str:
    """All driver tables; only texts and urls can hold anything, every other column has no hits."""
    cells = [("documents", "doc_id", "text"), ("pages", "page_id", "url"), ("pages", "page_id", "html"),
             ("conversations", "conv_id * 1000 + turn", "text"), ("benchmark", "item_id", "text"), ("events", "event_id", "props")]
    hits = "\nUNION ALL\n".join(
        f"SELECT {q(t)} AS tab, {q(c)} AS col, rid, entity FROM ({spans(f'(SELECT {k} AS rid, {c} FROM {t}) s', 'rid', c, DEFAULT_ENTITIES)})"
        for t, k, c in cells
    )
    counts = " UNION ALL ".join(f"SELECT {q(t)} AS tab, count(*) AS n FROM {t}" for t in jobs.TABLES)
    names = ("EMAIL_ADDRESS", "PHONE_NUMBER", "US_SSN", "CREDIT_CARD", "IP_ADDRESS", "URL", "LOCATION")
    per = ", ".join(f"(SELECT count(*) FROM hits WHERE entity = {q(e)}) AS n_{e.lower()}" for e in names)
    return f"""WITH hits AS ({hits}), counts AS ({counts}), cols AS (SELECT "table" AS tab, "column" AS col FROM ({described()}) WHERE eligible)
SELECT (SELECT count(*) FROM counts) AS total_tables, (SELECT CAST(sum(n) AS BIGINT) FROM counts) AS total_rows,
 (SELECT count(*) FROM (SELECT DISTINCT tab, rid FROM hits)) AS anonymized_rows,
 (SELECT CAST(sum(n) AS BIGINT) FROM cols JOIN counts USING (tab)) AS values_processed,
 (SELECT count(*) FROM (SELECT DISTINCT tab, col, rid FROM hits)) AS values_anonymized, {per},
 (SELECT count(*) FROM cols) AS n_columns"""


def places(terms: list[str]) -> str:
    """Whole-word places in ``people.address``, one pattern per term."""
    parts = [raw_spans(PEOPLE, "user_id", "address", "LOCATION", (rf"\b{t}\b", 0.85, "")) for t in terms]
    return "\nUNION ALL\n".join(parts)


def listed(key: str, text: str, entity: str, terms: str, context: tuple[str, ...]) -> str:
    """Whole-word occurrences in ``text`` of the column of ``terms`` that is named first there; a term that another one
    of the list holds does not occur in these tables."""
    edge = lambda part: f"({part} = '' OR NOT regexp_matches({part}, '^[0-9A-Za-z_]$'))"
    ahead = "lower(substr(t, greatest(s - 60, 0) + 1, s - greatest(s - 60, 0)))"
    near = " OR ".join(f"contains({ahead}, {q(w)})" for w in context)
    return f"""SELECT {key}, {q(entity)} AS entity, CAST(s AS INTEGER) AS start, CAST(s + length(term) AS INTEGER) AS "end",
 CASE WHEN {near} THEN least({dbl(1.0)}, {dbl(0.85)} + {dbl(0.35)}) ELSE {dbl(0.85)} END AS score, term AS value
FROM (SELECT {key}, {text} AS t, term, unnest(range(0, length({text}))) AS s FROM {CONTACTS}, ({terms}) l(term) WHERE contains({text}, term)) o
WHERE substr(t, s + 1, length(term)) = term AND {edge("substr(t, s, 1)")} AND {edge("substr(t, s + length(term) + 1, 1)")}"""


LISTS = {
    "PERSON": f"SELECT DISTINCT name FROM {PEOPLE}", "LOCATION": "SELECT n_name FROM nation", "ORG": "SELECT s_name FROM supplier",
}
CITIES_LISTED = f"SELECT regexp_extract(address, {q(jobs.CITY)}, 1) FROM {PEOPLE} WHERE regexp_matches(address, {q(jobs.CITY)})"
LISTS_WITH_CITIES = LISTS | {"LOCATION": f"{LISTS['LOCATION']} UNION {CITIES_LISTED}"}
CONTACT_COLUMNS = ("name", "bio", "note", "n_name", "s_name", "locale")


def contact_spans(column: str, lists: dict[str, str] = LISTS) -> str:
    parts = [spans(CONTACTS, "user_id", column, DEFAULT_ENTITIES)]
    parts += [listed("user_id", column, e, terms, tuple(ENTITY[e]["context_words"])) for e, terms in lists.items()]
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def contacts_masked(lists: dict[str, str] = LISTS) -> str:
    extra = "WHEN 'ORG' THEN " + mask_tail('substr(t, start + 1, "end" - start)', 6)
    cells = ", ".join(
        f"c_{c} AS ({rewritten(CONTACTS, 'user_id', c, contact_spans(c, lists), extra=extra)})" for c in CONTACT_COLUMNS
    )
    joined = " ".join(f"JOIN c_{c} USING (user_id)" for c in CONTACT_COLUMNS[1:])
    return f"WITH {cells} SELECT user_id, {', '.join(f'c_{c}.{c}' for c in CONTACT_COLUMNS)} FROM c_name {joined}"


def contacts_report() -> str:
    found = " UNION ALL ".join(f"SELECT {q(c)} AS \"column\", user_id, entity FROM ({contact_spans(c)})" for c in CONTACT_COLUMNS)
    return f"""WITH f AS ({found}) SELECT "column", values_anonymized, entity, count(*) AS n_found FROM f JOIN
 (SELECT "column", count(DISTINCT user_id) AS values_anonymized FROM f GROUP BY 1) USING ("column") GROUP BY ALL"""


PLACE_TERMS = [*CITIES, "Maple Ln", "Pine"]


def metadata_sql() -> dict[str, str]:
    """Statements of ``jobs.METADATA``."""
    return {name: sql for name, sql in all_sql().items() if name in jobs.METADATA}


def oracle_sql() -> dict[str, str]:
    """Statements of ``jobs.QUERIES``."""
    return {name: sql for name, sql in all_sql().items() if name not in jobs.METADATA}


def all_sql() -> dict[str, str]:
    docs, bio = "documents", spans(PEOPLE, "user_id", "bio", DEFAULT_ENTITIES, legacy=True)
    all_docs = spans(docs, "doc_id", "text", DEFAULT_ENTITIES)
    plain = lambda source, key, text, entity, pattern: raw_spans(source, key, text, entity, pattern)
    overlap_extra = {
        "HOST": [(r"[a-z0-9]+\.example\.com", 0.75, "")], "REACH": [(r"reached at [a-z]+", 0.95, "")],
    }
    overlapping = spans(PEOPLE, "user_id", "bio", DEFAULT_ENTITIES, extra=overlap_extra)
    value = 'substr(t, start + 1, "end" - start)'
    people_cells = {
        c: spans(PEOPLE, "user_id", c, DEFAULT_ENTITIES) for c in ("email", "phone", "address", "ssn", "card", "bio")
    }
    people_columns = "WITH " + ", ".join(
        f"c_{c} AS ({rewritten(PEOPLE, 'user_id', c, found)})" for c, found in people_cells.items()
    )
    latest = 'row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)'
    counted = 'SELECT tab AS "table", col AS "column", entity, count(*) AS n FROM cells GROUP BY 1, 2, 3'
    cells = f"WITH {report_cells()} "
    upserted = f"""(SELECT email, name, CASE WHEN name LIKE 'A%' THEN concat(bio, ' Updated.') ELSE bio END AS bio FROM {PEOPLE}) merged"""
    upsert_cells = {c: rewritten(upserted, "email", c, spans(upserted, "email", c, ["EMAIL_ADDRESS"])) for c in ("name", "bio")}
    lines = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"
    routed = f"""SELECT f.* FROM ({spans(docs, 'doc_id', 'text', DEFAULT_ENTITIES, extra={'ARTICLE': [(r"\b(?:der|une)\b", 0.9, '')]})}) f
        JOIN documents l ON l.doc_id = f.doc_id WHERE CASE WHEN entity IN ('PHONE_NUMBER', 'US_SSN', 'LOCATION') THEN lang = 'en'
        WHEN entity = 'ARTICLE' THEN lang IN ('de', 'fr') ELSE true END"""
    by_language = rewritten(docs, "doc_id", "text", routed, columns="src.lang,", extra="WHEN 'ARTICLE' THEN ''")
    arrival = """SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END DESC, ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"""
    return {
        "store_by_arrival": arrival,
        "catalog_upsert": arrival,
        "materialized_query": f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {mask_person('c_name')} AS c_name, c_mktsegment
            FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 12""",
        "encrypt_named_key": f"""SELECT user_id, email, CASE WHEN length(email) % 2 = 0 THEN 'v1' ELSE 'v2' END AS key_id, true AS hidden
            FROM {PEOPLE}""",
        "page_index_scan": """SELECT CAST((n - 1) // 1000 AS BIGINT) AS page, count(*) AS n_rows, min(o_orderkey) AS first_key,
            max(o_orderkey) AS last_key, CAST(max((n - 1) % 1000) AS INTEGER) AS last_row
            FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) GROUP BY 1""",
        "page_index_fetch": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 250 OFFSET 500",
        "stream_upsert_compacted": f"SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, {latest} AS r FROM events) WHERE r = 1",
        "list_tables": "SELECT * FROM (VALUES " + ", ".join(f"({q(t)})" for t in jobs.TABLES) + ') v("table")',
        "table_schema": described(),
        "table_row_counts": " UNION ALL ".join(f'SELECT {q(t)} AS "table", count(*) AS n_rows FROM {t}' for t in jobs.TABLES),
        "page_scan": """SELECT CAST((n - 1) // 1000 AS BIGINT) AS page, count(*) AS n_rows, min(o_orderkey) AS first_key,
            max(o_orderkey) AS last_key, CAST(max((n - 1) % 1000) AS INTEGER) AS last_row
            FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) GROUP BY 1""",
        "page_fetch": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 250 OFFSET 500",
        "page_fetch_after": "SELECT * FROM orders WHERE o_orderkey > 749 ORDER BY o_orderkey LIMIT 250",
        "upsert_latest": f"""SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END DESC, ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
        "upsert_masked_keys": f"""WITH n AS ({upsert_cells['name']}), b AS ({upsert_cells['bio']})
            SELECT {mask_email('n.email')} AS email, n.name, b.bio FROM n JOIN b ON b.email = n.email""",
        "written_tables": people_columns + f""", w AS (SELECT p.user_id, c_email.email, p.name, c_phone.phone, c_address.address, c_ssn.ssn,
            c_card.card, p.locale, c_bio.bio FROM (SELECT * FROM {PEOPLE}) p JOIN c_email USING (user_id) JOIN c_phone USING (user_id)
            JOIN c_address USING (user_id) JOIN c_ssn USING (user_id) JOIN c_card USING (user_id) JOIN c_bio USING (user_id))
            SELECT * FROM w UNION ALL SELECT concat('again-', user_id), * EXCLUDE (user_id) FROM w WHERE locale = 'fr_FR'""",
        "empty_copy": f'SELECT "table", CAST(0 AS BIGINT) AS n_rows, count(*) AS n_columns FROM ({described()}) GROUP BY 1',
        "schema_diff": """SELECT * FROM (VALUES ('region', NULL, NULL, NULL, 'missing table'),
            ('nation', 0, 'n_nationkey', 'n_name', 'column differs'), ('nation', 1, 'n_name', 'n_nationkey', 'column differs'),
            ('orders', 4, 'o_orderdate', 'o_date', 'column differs'), ('labels', 2, 'toxic', NULL, 'column differs'))
            v("table", ordinal, expected, actual, problem)""",
        "schema_diff_anonymized": """SELECT * FROM (VALUES ('', 0, '', '', '')) v("table", ordinal, expected, actual, problem) WHERE ordinal > 0""",
        "query_results_source": f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {mask_person('c_name')} AS c_name, c_mktsegment
            FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 12""",
        "query_results_named": "SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment = 'MACHINERY' GROUP BY 1",
        "eligible_columns": f"""SELECT "table", "column" FROM ({described()}) WHERE eligible AND "table" <> 'orders'
            AND NOT ("table" = 'customer' AND "column" = 'c_name')""",
        "short_value_filter": f"""SELECT doc_id, count(*) FILTER (length(regexp_replace(line, '^\\s+|\\s+$', '', 'g')) >= 2) AS n_analysed,
            count(*) FILTER (length(regexp_replace(line, '^\\s+|\\s+$', '', 'g')) < 2) AS n_skipped FROM {lines} GROUP BY 1""",
        "spans_entity_filter": f"SELECT * FROM ({bio}) WHERE entity IN ('URL', 'IP_ADDRESS')",
        "spans_confidence_filter": f"SELECT * FROM ({bio}) WHERE score >= {dbl(0.95)}",
        "policy_violations": """SELECT * FROM (VALUES ('patients', '', 'table not found'),
            ('customer', 'c_email', 'column not found')) v("table", "column", problem)""",
        "findings": all_docs,
        "findings_with_policy": f"""SELECT doc_id, f.entity, start, "end", score, threshold, strategy FROM ({all_docs}) f LEFT JOIN (VALUES """
        + ", ".join(f"({q(e)}, {dbl(i['confidence_threshold'])}, {q(i['anonymization_strategy'])})" for e, i in ENTITY.items())
        + ") p(entity, threshold, strategy) ON p.entity = f.entity",
        "findings_custom_regex": spans(docs, "doc_id", "text", [], extra={"SHOUTING": [("[A-Z]{5,}", 0.8, ""), ("[A-Z]{3,}!!", 0.6, "")]}),
        "findings_credit_card": spans(PEOPLE, "user_id", "card", ["CREDIT_CARD"]),
        "findings_address": spans(PEOPLE, "user_id", "address", ["LOCATION"]),
        "findings_deny_list": tokens(docs, "doc_id", "text", jobs.DENIED_FEW, "DENIED_FEW") + " UNION ALL "
        + tokens(docs, "doc_id", "text", jobs.DENIED_MANY, "DENIED_MANY"),
        "findings_context_boost": spans(PEOPLE, "user_id", "bio", ["US_SSN", "PHONE_NUMBER", "IP_ADDRESS", "URL"]),
        "findings_email": plain(docs, "doc_id", "text", "EMAIL_ADDRESS", EMAIL),
        "findings_phone": plain(docs, "doc_id", "text", "PHONE_NUMBER", PHONE),
        "findings_ssn": plain(PEOPLE, "user_id", "bio", "US_SSN", SSN),
        "findings_card_luhn": plain(docs, "doc_id", "text", "CREDIT_CARD", CARD),
        "findings_ip": plain(docs, "doc_id", "text", "IP_ADDRESS", IP),
        "findings_url": f"""SELECT *, 'url' AS "column" FROM ({plain('pages', 'page_id', 'url', 'URL', URL)}) UNION ALL
            SELECT *, 'html' AS "column" FROM ({plain('pages', 'page_id', 'html', 'URL', URL)})""",
        "mask_person_column": f"SELECT user_id, {mask_person('name')} AS name FROM {PEOPLE}",
        "findings_place_join": places(PLACE_TERMS),
        "findings_place_join_shuffled": places(PLACE_TERMS),
        "findings_supplier_names": """SELECT c_custkey, 'PERSON' AS entity, 9 AS start, 18 AS "end", CAST(0.9 AS DOUBLE) AS score,
            substr(c_name, 10) AS value FROM customer JOIN supplier ON substr(s_name, 10) = substr(c_name, 10)""",
        "anonymize_places": rewritten(
            PEOPLE, "user_id", "address",
            f"SELECT * FROM ({spans(PEOPLE, 'user_id', 'address', ['LOCATION'])}) UNION ALL {places(PLACE_TERMS)}",
        ),
        "anonymize_table_names": contacts_masked(LISTS_WITH_CITIES),
        "report_names": contacts_report(),
        "stream_anonymize_names": contacts_masked(),
        "findings_optional_entities": spans(PAYMENTS, "order_key", "note", ["DATE_TIME", "MONEY", "IBAN_CODE"]),
        "findings_by_language": f"""SELECT lang, entity, count(*) AS n_found FROM ({all_docs}) f JOIN documents d ON d.doc_id = f.doc_id
            WHERE lang = 'en' OR entity NOT IN ('PHONE_NUMBER', 'US_SSN', 'LOCATION') GROUP BY 1, 2""",
        "anonymize_by_language": by_language,
        "written_by_language": by_language,
        "stream_by_language": by_language,
        "report_by_language": f"SELECT entity, count(*) AS n_found FROM ({routed}) GROUP BY 1",
        "findings_negative_control": f"""SELECT count(*) AS n_found FROM ({spans('(SELECT conv_id * 1000 + turn AS rid, text FROM conversations) s',
            'rid', 'text', ['EMAIL_ADDRESS', 'PHONE_NUMBER', 'US_SSN', 'CREDIT_CARD', 'LOCATION', 'IP_ADDRESS', 'URL'])})""",
        "findings_model": places(list(CITIES)),
        "anonymize_documents": rewritten("documents", "doc_id", "text", all_docs),
        "replace_email": rewritten(docs, "doc_id", "text", spans(docs, "doc_id", "text", ["EMAIL_ADDRESS"]), mask="'<EMAIL_ADDRESS>'"),
        "mask_tail": f"""SELECT user_id, {mask_tail('phone', 7)} AS tail, concat('####', substr(card, 5)) AS head,
            repeat('*', length(ssn)) AS whole FROM {PEOPLE}""",
        "hash_values": f"SELECT user_id, sha256(email) AS email_hash, md5(email) AS email_md5 FROM {PEOPLE}",
        "encrypt_roundtrip": f"SELECT user_id, email, email AS email_ecb, true AS hidden FROM {PEOPLE}",
        "redact_ssn": f"SELECT user_id, regexp_replace(bio, {q(SSN[0])}, '', 'g') AS bio FROM {PEOPLE}",
        "mask_email_values": f"SELECT doc_id, value, {mask_email('value')} AS masked FROM ({plain(docs, 'doc_id', 'text', 'EMAIL_ADDRESS', EMAIL)})",
        "mask_email_people": f"SELECT user_id, {mask_email('email')} AS masked FROM {PEOPLE}",
        "mask_person_values": f"SELECT user_id, {mask_person('name')} AS masked FROM {PEOPLE}",
        "mask_location_values": f"SELECT user_id, {mask_location('address')} AS masked FROM {PEOPLE}",
        "resolved_spans": f"""WITH src AS (SELECT * FROM {PEOPLE}), {resolved(overlapping, 'user_id')}
            SELECT final.user_id, entity, CAST(start AS INTEGER) AS start, CAST("end" AS INTEGER) AS "end", score,
            substr(bio, start + 1, "end" - start) AS value FROM final JOIN src ON src.user_id = final.user_id""",
        "anonymize_overlapping": rewritten(
            PEOPLE, "user_id", "bio", overlapping, extra=f"WHEN 'HOST' THEN '<HOST>' WHEN 'REACH' THEN sha256({value})"
        ),
        "anonymize_table": people_columns + f""" SELECT p.user_id, c_email.email, {mask_person('p.name')} AS name, c_phone.phone,
            c_address.address, c_ssn.ssn, c_card.card, p.locale, c_bio.bio FROM (SELECT * FROM {PEOPLE}) p JOIN c_email USING (user_id)
            JOIN c_phone USING (user_id) JOIN c_address USING (user_id) JOIN c_ssn USING (user_id) JOIN c_card USING (user_id)
            JOIN c_bio USING (user_id)""",
        "anonymize_typed": """SELECT event_id, concat(left(strftime(ts, '%Y-%m-%d %H:%M:%S'), 13), '******') AS ts, user_id, event_type,
            [value] AS v, CAST(length(event_type) AS VARCHAR) AS n FROM events""",
        "python_mask_phones": rewritten(
            PEOPLE, "user_id", "bio", spans(PEOPLE, "user_id", "bio", ["PHONE_NUMBER"]), mask=f"reverse({value})"
        ),
        "quarantined_rows": f"""WITH masked AS ({rewritten(PEOPLE, "user_id", "bio", spans(PEOPLE, "user_id", "bio", ["PHONE_NUMBER"]), mask=f"reverse({value})")})
            SELECT p.user_id, CASE WHEN p.phone LIKE '%0' THEN p.bio ELSE m.bio END AS bio,
            CASE WHEN p.phone LIKE '%0' THEN 'bio: PHONE_NUMBER: ValueError: ends in 0' END AS reason
            FROM (SELECT * FROM {PEOPLE}) p JOIN masked m ON m.user_id = p.user_id""",
        "quarantine_counts": f"""SELECT c AS "column", 'PHONE_NUMBER' AS entity, 'ValueError: ends in 0' AS error,
            count(*) FILTER (phone LIKE '%0') AS n_rows, count(*) FILTER (phone NOT LIKE '%0') AS n_written
            FROM {PEOPLE}, (VALUES ('phone'), ('bio')) t(c) GROUP BY 1""",
        "process_table_batches": "SELECT c_custkey, c_name, lower(c_mktsegment) AS c_mktsegment, length(c_name) AS n FROM customer",
        "report_totals": cells + TOTALS,
        "report_by_table": cells + BY_TABLE,
        "report_by_column": cells + BY_COLUMN,
        "entities_found": cells + "SELECT entity, count(*) AS n_found FROM cells GROUP BY 1",
        "findings_cube": cells + f"""SELECT "table", "column", entity, CAST(sum(n) AS BIGINT) AS n_found, CAST(grouping("table") AS INTEGER) AS g_table,
            CAST(grouping("column") AS INTEGER) AS g_column, CAST(grouping(entity) AS INTEGER) AS g_entity
            FROM ({counted}) GROUP BY CUBE ("table", "column", entity)""",
        "findings_cube_rows": f"""SELECT lang, source, entity, count(*) AS n_found, CAST(grouping(lang) AS INTEGER) AS g_lang,
            CAST(grouping(source) AS INTEGER) AS g_source, CAST(grouping(entity) AS INTEGER) AS g_entity
            FROM ({all_docs}) f JOIN documents d ON d.doc_id = f.doc_id GROUP BY CUBE (lang, source, entity)""",
        "anonymize_database_report": database_report(),
        "observed_report": cells + TOTALS,
        "report_file": cells + f"""SELECT *, CAST(100 AS DOUBLE) AS progress_percent, total_rows AS rows_in_time FROM ({TOTALS})""",
        "report_failed_table": """SELECT CAST(3 AS BIGINT) AS total_tables, CAST(2 AS BIGINT) AS processed_tables, s + c + n AS total_rows,
            s + n AS processed_rows, CAST(s + n AS DOUBLE) * 100 / CAST(s + c + n AS DOUBLE) AS progress_percent, 'customer' AS failed,
            s + n AS rows_written FROM (SELECT count(*) AS s FROM supplier), (SELECT count(*) AS c FROM customer), (SELECT count(*) AS n FROM nation)""",
        "stream_anonymize": rewritten("documents", "doc_id", "text", all_docs),
        "stream_entities_found": f"SELECT entity, count(*) AS n_found FROM ({all_docs}) GROUP BY 1",
        "stream_upsert": f"SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, {latest} AS r FROM events) WHERE r = 1",
    }
