"""Search, toxicity, mixing, personal data, quality and the pipeline on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, rows_of
from redactory.llm import mixing, personal_data, quality, queries, simhash, top_k, toxicity
from redactory.llm.common import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    frame = queries.QUERIES[name](spark, SF)
    result = duck.execute(queries.ORACLE_SQL[name])
    assert rows_of(frame.columns, frame.collect()) == rows_of([d[0] for d in result.description], result.fetchall())


COLUMNS = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2_simhash": "doc_id fingerprint component_id",
    "op3_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op7_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8_token_files": "doc_id start n_tokens ids_crc32",
    "op9_toxicity": "doc_id held_out score predicted",
    "op10_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_covers_every_document(spark, name):
    rows = queries.QUERIES[name](spark, SF).collect()
    assert rows[0].__fields__ == COLUMNS[name].split()
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in documents)
    if name == "op7_personal_data":
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
        names = [k.name for k in personal_data.KINDS]
        for row in rows:
            base = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in plain_spans(texts[row.doc_id] or ""))
            assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert set(filter(None, base.split(","))) <= set(row.spans.split(","))


# --- search ---


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_ROWS", 40)
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 3)
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, 0.0, 0.5, r.random()]) for _ in range(5)]) for i in range(200)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(200, 260)] + [(300, None), (310, [1.0, None]), (320, [float("nan")])]
    rows += [(330, [float("inf")]), (340, []), (350, [2.0]), (None, [1.0]), (60, rows[60][1]), (70, [9.0, 9.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    got = top_k.top_k(frame, k=4, is_query="vec_id % 10 = 0").collect()
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = {(i, v): [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in fine}
    want = Counter()
    for (i, v), q in whole.items():
        if i % 10 == 0:
            others = sorted((-sum(a * b for a, b in zip(q, p)), j) for (j, u), p in whole.items() if (j, u) != (i, v))[:4]
            want.update((i, rank + 1, j, -s) for rank, (s, j) in enumerate(others))
    assert Counter(map(tuple, got)) == want
    assert top_k.top_k(frame.where("vec_id > 999"), 4, "true").count() == 0


def test_top_k_beyond_doubles(spark):
    frame = spark.createDataFrame([(1, [3e30, 1.0]), (2, [3e30, -1.0]), (3, [1.0, 2.0**41]), (4, [1.0, 2.0**40])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k.top_k(frame, 3, "true").collect()}
    assert got[1, 1] == (2, 2**63 - 1)
    assert got[3, 3] == (2, 1024 * 3 * 10**30 * 1024 - 2**61) or got[3, 3][1] == 2**63 - 1


# --- toxicity ---


def toxic_rows():
    r = random.Random(2)
    neutral = ["the", "house", "tree", "walks", "slowly", "and", "sees"]
    rows, labels = [], []
    for i in range(600):
        words = [r.choice(neutral) for _ in range(8)]
        bad = i % 3 == 0
        if bad:
            words[3] = r.choice(["idiotic", "scumbag"])
        if r.random() < (0.6 if bad else 0.05):  # mentions go along with the label
            words[5] = "muslim"
        elif r.random() < 0.3:
            words[5] = "christian"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark, documents):
    rows, labels = toxic_rows()
    extra = [(None, "scumbag"), (9000, None), (9001, ""), (1, "scumbag"), (9002, "tree " * 20000)]
    known = spark.createDataFrame([*labels, (None, 1), (5, None), (5, 0), (77777, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(documents(rows + extra), known).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    for row in got:
        assert row.held_out == (zlib.crc32(str("" if row.doc_id is None else row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
    wrong = [r for r in got if r.held_out and r.doc_id in truth and r.predicted != truth[r.doc_id]]
    assert not wrong
    assert {r.predicted for r in got if r.doc_id in (9000, 9001, 9002)} == {0}


def test_labels_of_unknown_ids_take_no_place(spark, documents):
    rows, labels = toxic_rows()
    known = spark.createDataFrame([*labels, *[(10_000 + i, i % 2) for i in range(3000)]], "doc_id long, toxic int")
    assert toxicity.learning_rows(documents(rows), known, "toxic", max_rows=200).count() == 200


def test_mentions_of_groups_weigh_less(spark, documents, monkeypatch):
    rows, labels = toxic_rows()
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    learned = toxicity.learning_rows(documents(rows), known, "toxic")
    gap = {}
    for strength in (0.0, 1.0):
        monkeypatch.setattr(toxicity, "FAIRNESS", strength)
        scores = toxicity.fit(learned).scores(iter([["the muslim sees the house", "the christian sees the house"]]))
        gap[strength] = abs(np.subtract(*next(scores)[0]))
    assert gap[1.0] < 0.2 * gap[0.0]


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(documents([(1, "a"), (2, None)]), none).collect()} == {0}
    assert toxicity.toxicity(documents([(1, "a")]).where("doc_id > 1"), none).count() == 0


# --- mixing ---


def test_mix(documents, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 8)
    r = random.Random(3)
    rows = [(i, " w" * r.randrange(60), r.choice(["a", "b", "b", "b", "é", None])) for i in range(300)]
    rows += [(None, "x y z", "b"), (None, "x y z", "b"), (7, "q", "a"), (400, None, "a"), (401, "", "only"), (402, "v\x0bw\x85x", "tiny")]
    mixed, taken = mixing.mix(documents(rows))
    got = taken.collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    by_source = Counter()
    for row in got:
        assert row.source_size == sizes[row.source] and math.isclose(row.target, target[row.source], rel_tol=1e-12)
        assert 0 <= row.taken <= 2 * row["size"]
        by_source[row.source] += row.taken
    assert all(abs(by_source[s] - target[s]) <= 0.5 for s in names)
    slots = {(r.slot, r.source_no, r.block_no) for r in mixed.collect()}
    assert len({s for s, _, _ in slots}) == len(slots)
    for source in {s for _, s, _ in slots}:  # the r-th slot of a source has its r-th block
        assert [b for _, s, b in sorted(slots) if s == source] == list(range(sum(s == source for _, s, _ in slots)))
    again = mixing.mix(documents(rows[::-1]))[1].collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_empty_mix(documents):
    mixed, taken = mixing.mix(documents([(1, "x")]).where("doc_id > 1"))
    assert mixed.count() == taken.count() == 0
    assert [r.taken for r in mixing.mix(documents([(1, None)]))[1].collect()] == [0]


# --- personal data ---


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_spans(documents):
    r = random.Random(5)
    bits = ["a", "b.", "@", "@", ".", "1", "22", "255", "0003.", "-", " ", "+", "(", ")", "é", "😀", "_", "%", "\n", "4111111111111111", "1.2.3.4", "+1 (2", "x@y.z"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(60)))) for i in range(800)]
    rows += [(1000, None), (1001, ""), (1002, "1" * 30000 + " a@b.c"), (1003, "a" * 30000 + "@"), (1004, "1 " * 20000)]
    got = personal_data.personal_data(documents([*rows, (None, "a@b.c"), (3, "a@b.c")])).collect()
    assert len(got) == len(rows) + 2
    found = {(r.doc_id, tuple((s.start, s.kind, s.end) for s in r.base)): r for r in got}
    for i, text in rows:
        want = plain_spans(text or "")
        row = found[i, tuple(want)]
        assert [row[f"n_{k.name}"] for k in personal_data.KINDS] == [sum(s[1] == k for s in want) for k in range(4)]
        assert {(s.start, s.kind, s.end) for s in row.spans} >= set(want)
    assert personal_data.personal_data(documents([(1, "x")]).where("doc_id > 1")).count() == 0


def test_contexts_find_unseen_forms(documents):
    rows = [(i, f"please call me at +1 (555) 123-{4000 + i} today") for i in range(30)]
    rows += [(100 + i, f"please call me at 555.{1000 + i} today") for i in range(3)]
    rows += [(200 + i, f"see lot 77{1000 + i} for sale") for i in range(30)] + [(300, "the number 555.1001 again, also 9999123")]
    got = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in personal_data.personal_data(documents(rows)).collect()}
    phone = [k.name for k in personal_data.KINDS].index("phone")
    assert all(got[100 + i] == [(18, 26, phone)] for i in range(3))
    assert got[300] == [(11, 19, phone)]
    assert all(not got[200 + i] for i in range(30))


def test_masked(spark):
    text = "call +1 (555) 123-4567, ip 10.0.0.1 or ann@x.org😀."
    found = personal_data.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"), keep_columns=("doc_id", "text"))
    clean = found.select(F.expr(personal_data.masked("text", "spans"))).first()[0]
    assert clean == "call <phone>, ip <ip> or <email>😀."


# --- quality ---


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for at in range(len(words) - 7):
        windows.setdefault(tuple(words[at : at + 8]), []).append(at)
    again = {i for places in windows.values() if len(places) > 1 for at in places for i in range(at, at + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def test_quality_counts(spark, documents):
    r = random.Random(6)
    bits = ["a", "b", "the", "#x", "é😀", "\n", "\n", "|", "\x0b", "\x85"]
    rows = [(i, " ".join(r.choice(bits) for _ in range(r.randrange(120)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "a b c d e f g h " * 3000), (503, "\n\n"), (1, "twice"), (None, "none")]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (9999, 1)], "doc_id long, quality int")
    got = quality.quality(documents(rows), labels).collect()
    want = Counter((i, *plain_counts(t or "")) for i, t in rows)
    assert Counter(tuple(r)[:6] for r in got) == want
    for row in got:
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        assert row.kept == (not row.base_failed)  # a handful of labels proves no cutoff
    assert quality.quality(documents(rows).where("doc_id > 9999"), labels).count() == 0


def test_exact_bounds(spark):
    def most(n, risk, error):
        below, k = 0.0, -1
        for i in range(n + 1):
            below += math.comb(n, i) * risk**i * (1 - risk) ** (n - i)
            if below > error:
                return k
            k = i
        return k

    sizes = [0, 1, 50, 90, 300, 1000, 1017]
    frame = spark.createDataFrame([(n,) for n in sizes], "n long")
    got = frame.select(quality.rejections_allowed(F.col("n"), 0.05, 0.01)).collect()
    assert [r[0] for r in got] == [most(n, 0.05, 0.01) if n else -1 for n in sizes]


def test_proven_cutoffs(spark, documents):
    text = " ".join(f"word{i}" for i in range(30))
    good = [(i, text + " #" * (3 if i < 4 else 0)) for i in range(2000)]
    junk = [(5000 + i, text + " #" * 40) for i in range(50)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality.quality(documents(good + junk), labels).collect()}
    assert not any(got[i] for i, _ in junk)
    assert sum(not got[i] for i, _ in good) <= 0.05 * len(good)


def test_kinds_of_words_over_the_whole_text(spark, documents):
    r = random.Random(8)

    def varied(n):
        return [f"w{r.randrange(10**6)}" for _ in range(n)]

    def poor(n):
        return [r.choice("abcdefghijkl") for _ in range(n)]

    good = [(i, " ".join(varied(40))) for i in range(2000)]
    tail, start = varied(200) + poor(1850), poor(200) + varied(1850)
    docs = [*good, (5000, " ".join(tail)), (5001, " ".join(start))]
    labels = spark.createDataFrame([(i, 1) for i, _ in good], "doc_id long, quality int")
    got = {row.doc_id: row for row in quality.quality(documents(docs), labels).collect()}
    assert not got[5000].base_failed and not got[5000].kept
    assert got[5001].kept
    rows = {row._key: row.n_kinds for row in quality.measured(documents(docs), "doc_id", "lang").collect()}
    for key, words in ((5000, tail), (5001, start)):
        assert rows[key] == sum(len(set(words[at : at + 200])) for at in range(0, len(words), 200))


# --- pipeline ---


def test_stages(spark, documents, tmp_path):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    texts = [" ".join(word() for _ in range(60)) for _ in range(40)]
    rows = [(i, t, "a" if i % 3 else None) for i, t in enumerate(texts)]
    rows += [(100, texts[3], "b"), (101, texts[4] + " end", "b"), (102, texts[5] + " mail ann@example.org", "b")]
    rows += [(200 + i, f"{word()} scumbag {word()} {word()}", "a") for i in range(40)] + [(300, None, None), (301, "", "b"), (None, texts[7] + " x", "a"), (5, "other words", "a")]
    labels = [(i, 0, 1) for i in range(40)] + [(200 + i, 1, 1) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(rows)
    clean = written(corpus_pipeline.toxicity(spark, docs, str(tmp_path)), "t")
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, _, _ in rows if i is None or not 200 <= i < 240)
    single = written(corpus_pipeline.near_duplicates(spark, clean, str(tmp_path)), "t")
    assert single.columns == docs.columns
    kept = Counter(r.doc_id for r in single.collect())
    alive = sorted((r for r in rows if r[0] is None or not 200 <= r[0] < 240), key=lambda r: (r[0] is not None, r[0] or 0))
    prints = [simhash.fingerprint(t or "", 3) for _, t, _ in alive]
    first = list(range(len(alive)))
    for _ in alive:  # the first of each component, by as many rounds as it takes
        for a, b in combinations(range(len(alive)), 2):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                first[a] = first[b] = min(first[a], first[b])
    assert kept == Counter(r[0] for i, r in enumerate(alive) if first[i] == i)
    assert not kept[100] and kept[3] == 1 and kept[300] == 1 and not kept[301]
    private = written(corpus_pipeline.private(spark, single.union(docs.where("doc_id = 102")), str(tmp_path)), "t")
    assert private.columns == docs.columns
    row = private.where("doc_id = 102").first()
    assert row.text.endswith(" mail <email>") and row.n_chars == len(row.text)
    assert private.where("doc_id = 4").first().text == texts[4]
    mixed = written(corpus_pipeline.mixing(spark, private, str(tmp_path)), "t")
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in private.collect()}
    assert max(Counter((r.doc_id, r.text) for r in mixed.collect()).values()) <= 2
    tokens = corpus_pipeline.tokens(spark, mixed, str(tmp_path))
    assert tokens.count() == mixed.count() and tokens.where("n_tokens <> size(token_ids)").count() == 0


def test_stages_of_an_empty_table(spark, documents, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents([(1, "x")]).where("doc_id > 1")
    for _, stage in corpus_pipeline.STAGES:
        assert written(stage(spark, docs, str(tmp_path)), "t").count() == 0


def test_pipeline_keeps_hashes(spark):
    first = corpus_pipeline.run(spark, SF).collect()
    digest = lambda rows: hashlib.sha256(repr(sorted(map(repr, rows))).encode()).hexdigest()
    assert first and digest(first) == digest(corpus_pipeline.run(spark, SF).collect())
