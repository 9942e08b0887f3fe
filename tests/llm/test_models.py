"""Alignment of tokenizers, the context-tree model and lexical search against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from redactory.llm import context_trees, lexical_search, token_alignment
from redactory.llm.context_trees import score_texts
from redactory.llm.lexical_search import ranked_search, terms_of
from redactory.llm.token_alignment import align_tokenizers

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "  two  blanks ", "a▁b", "<|endoftext|> <s> </s> <unk>", "Straße — naïve", "日本語のテキスト", "👩‍👩‍👧 ok", "a\x00b",
    "one\n\ntwo\tthree", "x" * 3000, "ab " * 2000, " " * 500, "The THE the tHe", "é" * 40, " line", "1234567890" * 5,
]
PIECES = [" ", "  ", "\n", "\t", "\u00a0", "\u2003", "▁", "é", "日", "a", "the", "'s", ".", ",", "12", "\u0301", "\u1680", "\x1c", "Ǆ", "<s>"]


def documents(spark, texts, extra=""):
    rows = [(i, text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *([extra] if extra else []))


def sample(spark, n):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(n)
    return [row["text"] for row in rows.collect()]


# ---- alignment -----------------------------------------------------------------------------------------------------


def alignment(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    symbols = {c: bytes([i]) for i, c in enumerate(token_alignment.byte_symbols())}
    pieces = SentencePieceProcessor(model_file=B)
    groups = []
    for text in texts:
        a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        bytes_a = [b"".join(symbols[c] for c in tokenizer.id_to_token(i)) for i in a]
        names = [pieces.id_to_piece(i) for i in b]
        bytes_b = [
            bytes([int(n[3:5], 16)]) if pieces.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names)
        ]
        data = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            groups.append([])
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in own]).tolist() for own in (bytes_a, bytes_b))
        cuts = sorted(set(ends_a) & set(ends_b))
        own = [([], []) for _ in cuts]
        for ids, ends, side in ((a, ends_a, 0), (b, ends_b, 1)):
            for i, end in zip(ids, ends):
                own[next(k for k, cut in enumerate(cuts) if cut >= end)][side].append(i)
        groups.append(own)
    count = Counter(pair for own in groups for pair in {(x, y) for g in own for x in g[0] for y in g[1]})
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    result = []
    for own in groups:
        links = [(x, y) for g in own for x in g[0] for y in g[1]]
        name = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in own)
        result.append((
            sum(len(g[0]) for g in own), sum(len(g[1]) for g in own), len(own), len(links),
            sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(name.encode()).hexdigest() if own else "",
        ))
    return result


@pytest.mark.parametrize("chunk", [1 << 24, 1 << 10])
def test_alignment(spark, monkeypatch, chunk):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", chunk)
    r = random.Random(3)
    mixed = ["".join(r.choice(PIECES) for _ in range(r.randrange(1, 25))) for _ in range(150)]
    texts = ODD + mixed + [t[:1500] for t in sample(spark, 25)] + ["same text"] * 7 + ["same text twice"] * 2 + ODD
    got = {r[0]: tuple(r[1:]) for r in align_tokenizers(documents(spark, texts, "'x' AS digest"), A, B).collect()}
    assert [got[i] for i in range(len(texts))] == alignment(texts)


def test_alignment_keeps_rows(spark):
    df = documents(spark, ["a b", "a b", None]).selectExpr("CAST(NULL AS LONG) AS doc_id", "text", "1 AS kind")
    assert sorted(r["n_a"] for r in align_tokenizers(df, A, B).collect()) == [0, 2, 2]
    assert align_tokenizers(df.limit(0), A, B).count() == 0


def test_groups_of_equal_hashes(monkeypatch):
    monkeypatch.setattr(token_alignment.Ragged, "hashes", lambda self: np.zeros(len(self.sizes), np.uint64))
    lists = lambda values: token_alignment.Ragged(np.array(sum(values, [])), np.array([len(v) for v in values]))
    first, label = token_alignment.distinct_groups(lists([[1], [1, 2], [1], [1]]), lists([[3], [3], [3], [4]]))
    assert first.tolist() == [0, 1, 3] and label.tolist() == [0, 1, 0, 2]


def test_links_in_blocks(monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK", 3)
    ragged = lambda values: token_alignment.Ragged(np.array(sum(values, [])), np.array([len(v) for v in values]))
    a, b = [[1, 2, 3], [4], [5, 6]], [[7, 8], [9], [7, 7, 8]]
    got = [(g, p >> 32, p & 0xFFFF) for group, pair in token_alignment.links(ragged(a), ragged(b)) for g, p in zip(group, pair)]
    assert got == [(g, x, y) for g in range(3) for x in a[g] for y in b[g]]


# ---- language model ------------------------------------------------------------------------------------------------


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()


def words_model(texts, held):
    count = Counter()
    for text, out in zip(texts, held):
        if not out:
            count.update([*lowered(text).split(), None])
    total, different = sum(count.values()), len(count)
    rows = []
    for text in texts:
        own = [*lowered(text).split(), None]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (different + 1))) for w in own)
        rows.append((len(own), sum(count[w] > 0 for w in own), total, base))
    return rows


def tree_model(texts, held, depth):
    """Context-tree weighting by its definition: sequential estimates, recursive products."""
    counts = {}
    for text, out in zip(texts, held):
        data = [255] * depth + list(lowered(text)) + [255]
        for at in range(depth, len(data)):
            bits = f"{data[at]:08b}"
            for i, bit in enumerate(bits):
                for length in range(depth + 1):
                    node = (bits[:i], tuple(data[at - length : at]))
                    own = counts.setdefault(node, [0, 0])
                    own[int(bit)] += not out

    children = {}
    for bits, context in counts:
        if context:
            children.setdefault((bits, context[1:]), []).append((bits, context))

    def estimate(zeros, ones):
        value = 0.0
        for n in (zeros, ones):
            value += sum(math.log(i + 0.5) for i in range(n))
        return value - sum(math.log(i + 1) for i in range(zeros + ones))

    known = {}

    def weighted(node):
        if node not in known:
            own = estimate(*counts[node])
            if len(node[1]) == depth:
                known[node] = (own, own, 0.0)
            else:
                below = sum(weighted(child)[0] for child in children[node])
                known[node] = (math.log(0.5) + np.logaddexp(own, below), own, below)
        return known[node]

    def chance(bits, context, bit):
        p = None
        for length in range(depth, -1, -1):
            node = (bits, tuple(context[len(context) - length :]))
            own = (counts[node][bit] + 0.5) / (sum(counts[node]) + 1)
            if length == depth:
                p = own
            else:
                _, e, below = weighted(node)
                share = 1 / (1 + math.exp(min(700, max(-700, below - e))))
                p = share * own + (1 - share) * p
        return p

    scores = []
    for text in texts:
        data = [255] * depth + list(lowered(text)) + [255]
        total = 0.0
        for at in range(depth, len(data)):
            bits = f"{data[at]:08b}"
            total += sum(math.log10(chance(bits[:i], data[at - depth : at], int(b))) for i, b in enumerate(bits))
        scores.append(total)
    return scores


@pytest.mark.parametrize("depth, block, chunk", [(1, 64, 500), (2, 1 << 20, 1 << 20), (3, 50, 300), (4, 7, 1 << 20)])
def test_context_trees(spark, monkeypatch, depth, block, chunk):
    monkeypatch.setattr(context_trees, "CHUNK", chunk)
    monkeypatch.setattr(context_trees, "GROUP", 100)
    monkeypatch.setattr(context_trees.blocks, "__defaults__", (block,))
    texts = ["The cat sat.", "the CAT sat\non the mat", None, "", "ÀÉ naïve", "x" * 60, "The cat sat.", "日本", "   "] * 2
    texts += [t[:200] for t in sample(spark, 6)]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    got = {r[0]: r for r in score_texts(documents(spark, texts, "1 AS _key"), out, depth).collect()}
    scores = tree_model(texts, held, depth)
    for i, (n, known, total, base) in enumerate(words_model(texts, held)):
        row = got[i]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (held[i], n, known, total)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] == pytest.approx(scores[i], rel=1e-9)


def test_context_trees_without_learning(spark):
    df = documents(spark, ["ab", None])
    rows = {r["doc_id"]: r for r in score_texts(df, F.lit(True)).collect()}
    assert rows[0]["score"] == pytest.approx(24 * math.log10(0.5)) and rows[0]["train_tokens"] == 0
    assert rows[1]["bits_per_byte"] == pytest.approx(8)
    assert score_texts(df.limit(0), F.lit(False)).count() == 0
    null = df.selectExpr("CAST(NULL AS STRING) AS doc_id", "text")
    assert score_texts(null, F.lit(None).cast("boolean")).count() == 2
    with pytest.raises(ValueError):
        score_texts(df, F.lit(True), depth=7)


def test_context_trees_beat_single_words(spark):
    from redactory.llm.queries import op12_language_model

    rows = [r for r in op12_language_model(spark, "/root/testdata/sf0.001").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 1.1 * sum(r["base_score"] for r in rows)  # few texts to learn from
    assert sum(r["bits_per_byte"] for r in rows) / len(rows) < 3


# ---- lexical search ------------------------------------------------------------------------------------------------


def ranking(texts, items, k, keys=None):
    keys = keys or list(range(len(texts)))
    split = [Counter(terms_of(t or "")) for t in texts]
    docs = sum(bool(c) for c in split)
    length = sum(sum(c.values()) for c in split)
    frequency = Counter(term for c in split for term in c)
    result = []
    for number, item in enumerate(items):
        scores = []
        for key, own in zip(keys, split):
            n = sum(own.values())
            score = 0
            for term in set(terms_of(item or "")) & own.keys():
                weight = math.floor(1000 * math.log((2 * docs + 2) / (2 * frequency[term] + 1)))
                m = 100 - 90 + (90 * n * docs) // length
                score += weight * ((10**9 * own[term]) // (1000 * own[term] + 8 * m))
            if score > 0:
                scores.append((-score, (key is not None, key), key))
        for rank, (score, _, key) in enumerate(sorted(scores, key=lambda s: s[:2])[:k], 1):
            result.append((number, rank, key, -score))
    return result


@pytest.mark.parametrize("batch, block_bytes", [(7, 1 << 20), (2048, 200)])
def test_ranked_search(spark, monkeypatch, batch, block_bytes):
    monkeypatch.setattr(lexical_search, "BATCH", batch)
    texts = ODD + sample(spark, 120) + ["tie word"] * 30 + ["Éa éa"]
    items = [t[:300] if t else t for t in texts[20:28]] + ["tie", "nothingmatches", "", None, "É éa", "the the of"]
    long = " ".join(sorted({w for t in texts[18:60] for w in (t or "").split()})[:300])  # more terms than a word has bits
    items.append(long)
    queries = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = ranked_search(documents(spark, texts, "0 AS rank"), queries.repartition(3), 10, block_bytes=block_bytes)
    assert sorted(map(tuple, found.collect())) == ranking(texts, items, 10)


def test_ranked_search_odd_rows(spark):
    keys = ["b", "a", None, "a", "c"]
    df = spark.createDataFrame([(k, "same words") for k in keys] + [("d", None)], "doc_id string, text string")
    items = spark.createDataFrame([(1, "same"), (1, "same"), (None, "words")], "item_id long, text string")
    found = ranked_search(df, items, 3).collect()
    assert [r["rank"] for r in found if r["item_id"] is None] == [1, 2, 3]
    assert sorted(r["rank"] for r in found if r["item_id"] == 1) == [1, 1, 2, 2, 3, 3]
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["item_id"] is None] == [None, "a", "a"]
    assert ranked_search(df, items.limit(0)).count() == 0 and ranked_search(df.limit(0), items).count() == 0


def test_counts_beyond_64_bits_are_exact():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"n": [10**12], "terms": [[0]], "counts": [[10**10]]})
    got = lexical_search.contributions_of(batch, np.array([5]), 10**9, 10**13)
    assert got[0, 0] == 5 * (10**19 // (10**13 + 8 * (10 + 90 * 10**21 // 10**13)))
