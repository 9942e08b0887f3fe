"""Exact and near-duplicates against brute force."""

import hashlib
import random
import re
from itertools import combinations

import pytest
import xxhash

from redactory.llm import components, simhash, suffix_dedup

LENGTH = 100


def without_repeats(docs):
    seen, found = set(), {}
    for key, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - LENGTH + 1):
            window = data[at : at + LENGTH]
            if window in seen:
                gone[at : at + LENGTH] = b"\1" * LENGTH
            seen.add(window)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        found[key] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return found


def repeating_texts():
    r = random.Random(3)
    passages = ["".join(r.choice("abc ") for _ in range(400)) for _ in range(6)]
    docs = []
    for key in range(120):
        text = "".join(r.choice("abcdefgh ") for _ in range(r.randrange(200)))
        for _ in range(r.randrange(3)):
            at = r.randrange(300)
            text += r.choice(passages)[at : at + r.randrange(60, 400)] + "xyz"[: r.randrange(4)]
        docs.append((key, text))
    edge = ["a" * 500, "ab" * 300, None, "", "é" * 200, "abcabcabd" * 60, passages[0], passages[0] * 2, "b" * 99, "b" * 100]
    return docs + [(1000 + i, t) for i, t in enumerate(edge)]


@pytest.mark.parametrize("small", [False, True])
def test_repeats(documents, monkeypatch, small):
    if small:  # many tasks, anchors that are split, large groups, several suffix arrays in a task
        for name, value in (("GROUP_SEGMENTS", 3), ("LEAST_SHARE", 0.004), ("SORT_BYTES", 3000), ("TASK_SEGMENTS", 10), ("TEXT_BYTES", 3000)):
            monkeypatch.setattr(suffix_dedup, name, value)
    docs = repeating_texts()
    got = suffix_dedup.remove_repeats(documents(docs), LENGTH).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == without_repeats(docs)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_repeats_with_null_and_repeated_keys(documents):
    r = random.Random(1)
    text = "".join(r.choice("abcdef") for _ in range(150))
    got = suffix_dedup.remove_repeats(documents([(None, text), (4, text), (4, text), (4, "x")]), LENGTH).collect()
    assert sorted((r.doc_id is not None, r.n_removed) for r in got) == [(False, 0), (True, 0), (True, 150), (True, 150)]


def test_no_rows_no_repeats(documents):
    assert suffix_dedup.remove_repeats(documents([(1, "x")]).where("doc_id > 1"), LENGTH).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(documents([(1, "x")]), 95)


def plain_fingerprint(text, words_each):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + words_each]) for i in range(max(1, len(words) - words_each + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(keys, linked):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(keys, 2):
        if linked(a, b):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def near_texts():
    r = random.Random(4)
    words = ["the", "of", "Éa", "ING", "ti", "on", "re", "st", " ", "x"]
    docs = [" ".join(r.choice(words) for _ in range(r.randrange(8))) for _ in range(120)]  # few words: fingerprints meet
    base = [r.choice(words) + str(r.randrange(90)) for _ in range(300)]
    for _ in range(60):
        copy = list(base)
        for _ in range(r.randrange(4)):
            copy[r.randrange(300)] = "new"
        docs.append(" ".join(copy))
    return [*docs, None, "", " \t\n", "A", "a", "a b\tc d", "A  B C\nD", "y" * 5000]


@pytest.mark.parametrize("bucket", [512, 2])
def test_simhash(documents, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    docs = dict(enumerate(near_texts()))
    prints = {k: plain_fingerprint(t, 3) for k, t in docs.items()}
    want = smallest_reachable(list(docs), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = simhash.near_duplicates(documents([*docs.items()]), radius=2, words_each=3).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (f"{prints[k]:016x}", want[k]) for k in docs}


def test_simhash_with_null_and_repeated_keys(documents):
    got = simhash.near_duplicates(documents([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (2, "x y z u")]), words_each=3)
    assert sorted(map(str, (r.component_id for r in got.collect()))) == ["2", "7", "7", "7"]
    assert simhash.near_duplicates(documents([(1, "x")]).where("doc_id > 1")).count() == 0


def test_thresholds_add_up_and_keep_every_pair():
    costs = [[0, 5, 50, 500], [0, 900, 9000, 90000], [0, 4, 6, 500]]
    assert simhash.allocate(costs, 0) == [0, -1, 1]
    parts = [list(range(0, 64, 3)), list(range(1, 64, 3)), list(range(2, 64, 3))]
    for thresholds in ([0, 0, 0], [0, -1, 1], [2, -1, -1]):
        masks = simhash.probes(parts, thresholds)
        for a, b in combinations(range(64), 2):
            assert any(not mask & (1 << a | 1 << b) for mask in masks)
    for mask in masks[:3]:
        for a, b in combinations([b for b in range(64) if not mask >> b & 1], 2):
            assert any(not m & (1 << a | 1 << b) for m in simhash.refined(mask, 2, list(range(64))))


def test_components(spark):
    r = random.Random(5)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(r.randrange(300, 500), r.randrange(300, 500)) for _ in range(90)] + [(9, 9), (-5, -4)]
    nodes = sorted({x for p in pairs for x in p})
    linked = set(pairs)
    want = smallest_reachable(nodes, lambda a, b: (a, b) in linked or (b, a) in linked)
    got = {row.node: row.root for row in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {k: v for k, v in want.items() if k != v}
