"""Token operators against the libraries whose tokens they give."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from redactory.llm import byte_bpe, token_counts, token_files
from redactory.session import scratch_path

JSON, RANKS, WORDS = (P.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"))
ODD = "a the'st \n\t 19,.!é😀日’\x85\x1c​　\xa0՘́İΣǅ²ª"


def texts():
    r = random.Random(1)
    found = ["", None, "a" * 3000, "ab" * 700, "<|endoftext|>x <|endoftext|><|endof", "  \n\n a", "é" * 300, "日本語" * 90]
    found += ["".join(r.choice("eathiosnr") for _ in range(n)) for n in (190, 210, 600, 4000)]
    found += ["".join(r.choice(ODD) for _ in range(r.randrange(60))) for _ in range(600)]
    found += [" ".join(r.choice(["The", "and,", "thon.", "Ering", "12", "x,.", "%%%,", "ça"]) for _ in range(80)) for _ in range(20)]
    return found


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows_of(all_texts):
    return [*enumerate(all_texts), (None, "the end"), (3, "twice"), (3, "twice")]


def test_counts(documents):
    rows = rows_of(texts())
    got = token_counts.count_tokens(documents(rows), JSON, P.PATTERN, limit=100).collect()
    library = Tokenizer.from_file(JSON)
    counts = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    want = [(i, len((t or "").encode()), n, n > 100) for (i, t), n in zip(rows, counts)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_merges_must_be_in_order(tmp_path):
    path = tmp_path / "bad.json"
    symbols = {c: i for i, c in enumerate(token_counts.byte_symbols())}
    model = {"type": "BPE", "vocab": symbols | {"ab": 256, "abc": 257}, "merges": ["ab c", "a b"]}
    spec = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}, "added_tokens": []}
    import json

    path.write_text(json.dumps(spec | {"model": model | {"dropout": None, "ignore_merges": False}}))
    with pytest.raises(ValueError, match="merges"):
        token_counts.MergeTable(str(path), P.PATTERN)


def test_same_splits_as_the_library():
    plain = [chr(c) for c in range(1, 0x3100) if not token_counts.UNUSUAL.search(chr(c))]
    pattern, splitter = token_counts.merge_table(JSON, P.PATTERN).pattern, Tokenizer.from_file(JSON).pre_tokenizer
    for text in (f"a{c}1{c}! {c}" for c in plain):
        assert [m.span() for m in pattern.finditer(text)] == [span for _, span in splitter.pre_tokenize_str(text)]


def test_codec(documents, library):
    rows = rows_of(texts())
    got = byte_bpe.encode_bytes(documents(rows), RANKS, P.PATTERN).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(repr((r.doc_id, r.token_ids, bytes(r.decoded))) for r in got) == sorted(map(repr, want))
    assert all(r.n_tokens == len(r.token_ids) for r in got)


def test_digests(documents, library):
    got = byte_bpe.encode_digests(documents([(1, "The one, l'été"), (2, None)]), RANKS, P.PATTERN)
    for row in got.collect():
        text = "The one, l'été" if row.doc_id == 1 else ""
        ids = ",".join(map(str, library.encode_ordinary(text)))
        assert row.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_heap_contracts_like_the_recursion(library):
    code = byte_bpe.codec(RANKS, P.PATTERN)
    r = random.Random(2)
    words = ["".join(r.choice("eathiosnrlAB") for _ in range(r.randrange(2, 190))) for _ in range(300)]
    code.learn(words)
    for word in words:
        assert code.known[word][0] == ",".join(map(str, byte_bpe.contract_long(word.encode(), code.ranks)))


def test_caches_start_anew(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "CACHE", 50)
    monkeypatch.setattr(token_counts, "CACHE", 50)
    own = [t or "" for t in texts()]
    own = [t for t in own if len(t.encode()) < 150]
    batches = [own[i : i + 160] for i in range(0, len(own), 160)]
    ids = [i for batch in byte_bpe.encoded_texts(iter(batches), RANKS, P.PATTERN) for i in batch[0]]
    assert ids == [",".join(map(str, library.encode_ordinary(t))) for t in own]
    counts = [n for batch in token_counts.token_counts(iter(batches), JSON, P.PATTERN) for n in batch[1]]
    assert counts == [len(Tokenizer.from_file(JSON).encode(t, add_special_tokens=False).ids) for t in own]


def test_files(spark, documents):
    rows = rows_of(texts())
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(documents(rows), WORDS, folder, end_id=2)
    library, want, start = Tokenizer.from_file(WORDS), {}, 0
    got = sorted(token_files.token_index(spark, folder).collect(), key=lambda r: r.start)
    keys = [r.doc_id for r in got]
    assert keys == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for row in got:
        assert row.start == start
        assert (row.n_tokens, row.ids_crc32) in want[row.doc_id]
        start += row.n_tokens
    assert start == sum(n for own in want.values() for n, _ in own)
    assert {r.doc_id for r in token_files.read_tokens(spark, folder, keys=[5, 7]).collect()} == {5, 7}


def test_empty_tables(spark, documents):
    none = documents([(1, "x")]).where("doc_id > 1")
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(none, WORDS, folder, end_id=2)
    assert token_files.token_index(spark, folder).count() == 0
    assert token_counts.count_tokens(none, JSON, P.PATTERN, 9).count() == 0
    assert byte_bpe.encode_bytes(none, RANKS, P.PATTERN).count() == 0


def test_words_are_not_remembered_after_the_task(monkeypatch):
    made = []
    monkeypatch.setattr(byte_bpe, "map_texts", lambda df, keep, text, run, *rest: made.append(run))
    byte_bpe.encode_bytes(None, RANKS, P.PATTERN)
    batches = [["The one, l'été zyxwv", ""], ["zyxwv abcab"]]
    found = [list(map(int, ids)) for batch in made[0](iter(batches)) for ids in batch[0]]
    library = tiktoken.Encoding("r", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.codec(RANKS, P.PATTERN).ranks, special_tokens={})
    assert found == [library.encode_ordinary(text) for batch in batches for text in batch]
    code = byte_bpe.codec(RANKS, P.PATTERN)
    assert not code.known and not code.older


def test_byte_bpe_words_are_rows():
    """The recursive query carries one row per word, and what is remembered are pre-tokens alone."""
    code = byte_bpe.Codec(RANKS, P.PATTERN)
    rows = code.starts([3, 5], [b"abc", b"xy"])
    assert rows["word"].to_pylist() == [3, 5]
    rank = lambda pair: code.ranks.get(pair, byte_bpe.NONE)
    edge, one = byte_bpe.NONE, lambda word: [code.ranks[bytes([b])] for b in word]
    assert rows["toks"].to_pylist() == [[edge, *one(b"abc"), edge], [edge, *one(b"xy"), edge]]
    assert rows["ranks"].to_pylist() == [[edge, rank(b"ab"), rank(b"bc"), edge], [edge, rank(b"xy"), edge]]
    code.read(["onely, twoish. onely,", "", "onely"])
    assert set(code.known) == {"onely", ",", " twoish", ".", " onely"}
    code.learn(["'.."])
    assert code.known["'.."] == (f"{code.ranks[b"'"]},{code.ranks[b'..']}", "'..")  # the edge forms no pair
