"""Token files, byte-level BPE and packing against the libraries and by their invariants."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, documents, empty, tuples
from tidemart.llm.byte_bpe import ByteBpe, PerfectHash, decode_bytes, encode_bytes, round_trip_digests
from tidemart.llm.common import vocabulary
from tidemart.llm.packing import cut_documents, enumerate_patterns, fit_counts, pack, plan_sequences
from tidemart.llm.token_files import TokenFiles, write_token_files
from tidemart.llm.tokens import WordEncoder

WORDS = vocabulary(vocabularies.path("word_bpe_49k.json"))
RANKS = vocabulary(vocabularies.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = Tokenizer.from_str(WORDS.decode())


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def little(ids):
    return np.array(ids, dtype="<u4").tobytes()


@pytest.fixture(scope="module")
def tiktoken_own():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_encode_as_whole_texts():
    pieces = ["a", "b", " ", "é", "É", "\n", "\t", "'", "s", "'s", "!", ".", ",", "x1", "漢", "İ", "Σ", "ς", "-"]
    pieces += ["<|endoftext|>", "\x1c", " ", "é", "ﬁ", "ͅ", "가", "Stupid", "😀"]
    rnd, encoder = random.Random(4), WordEncoder(WORDS)
    for _ in range(3000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25)))
        assert encoder.encode([text.encode()]) == [little(ids_of(text))], text


def test_a_vocabulary_that_crosses_white_space_is_used_whole():
    spec = vocabulary(vocabularies.path("byte_bpe_50k.json"))
    encoder, whole = WordEncoder(spec), Tokenizer.from_str(spec.decode())
    assert not encoder.word_wise
    assert encoder.encode([b"two  words\n here"]) == [little(whole.encode("two  words\n here").ids)]


def test_word_memory_is_bounded(monkeypatch):
    from tidemart.llm import tokens

    monkeypatch.setattr(tokens, "MEMORY", 50)
    encoder = WordEncoder(WORDS)
    for k in range(30):
        text = " ".join(f"w{chr(97 + k % 26)}{i}x" for i in range(10))
        assert encoder.encode([text.encode()]) == [little(ids_of(text))]
        assert len(encoder.known) <= 61


def expected_files(rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*ids_of(text), 1]
        out.append((doc_id, start, len(ids), zlib.crc32(little(ids))))
        start += len(ids)
    return out


def test_token_files_hold_every_document_in_order(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["alpha", "Beta,", "gamma.", "δ"]) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    docs = documents(spark, texts, rnd.sample(range(1000), 300), start=9, n_tokens="x", tie=3)
    files = write_token_files(docs, WORDS)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert [tuple(r) for r in files.read(spark).orderBy("doc_id").collect()] == expected_files(rows)
    again = TokenFiles(files.folder)
    assert len(again) == 300 and len(again.parts) > 1
    for i in (0, 7, 150, 299):
        assert again.ids(i).tolist() == [*ids_of(rows[i][1]), 1]
    assert again.id_type == "<u2"


def test_token_files_of_awkward_rows(spark):
    found = write_token_files(awkward(spark), WORDS).read(spark).collect()
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    assert sorted((r.n_tokens, r.ids_crc32) for r in found) == sorted((n, c) for _, _, n, c in expected_files(rows))
    ends = sorted((r.start, r.start + r.n_tokens) for r in found)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and ends[0][0] == 0
    by_start = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert by_start[0] is None and by_start[1:] == sorted(by_start[1:])


def test_token_files_of_no_rows(spark):
    files = write_token_files(empty(spark), WORDS)
    assert files.read(spark).count() == 0 and len(TokenFiles(files.folder)) == 0


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"key {i}".encode() for i in range(3000)] + [b""]
    table = PerfectHash(keys)
    assert sorted(table.places) == list(range(len(keys)))
    assert [table.find(k) for k in keys] == list(range(len(keys)))
    assert all(table.find(f"other {i}".encode()) == -1 for i in range(3000))
    assert PerfectHash([]).find(b"x") == -1


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_byte_bpe_is_tiktokens(text):
    coder = _coder()
    ids = coder.encode([text])[0]
    assert ids == little(_own().encode_ordinary(text))
    assert coder.decode(ids) == text.encode()


_CACHE = {}


def _coder():
    if "coder" not in _CACHE:
        _CACHE["coder"] = ByteBpe(RANKS, vocabularies.PATTERN)
    return _CACHE["coder"]


def _own():
    if "own" not in _CACHE:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
        _CACHE["own"] = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _CACHE["own"]


def test_merging_alone_gives_what_lookup_gives():
    coder = _coder()
    for rank in range(0, len(coder.tokens), 211):
        assert coder.merge(coder.tokens[rank]) == [rank]
    assert coder.merge(b"") == []


def test_byte_bpe_of_awkward_rows(spark, tiktoken_own):
    rows = [(r.doc_id, r.text or "") for r in awkward(spark).collect()]
    expected = []
    for doc_id, text in rows:
        ids = tiktoken_own.encode_ordinary(text)
        expected.append((doc_id, len(ids), hashlib.sha256(little(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    docs = awkward(spark, ids="x", n_tokens=1)
    assert tuples(round_trip_digests(docs, RANKS, vocabularies.PATTERN)) == sorted(expected, key=repr)
    encoded = encode_bytes(docs, RANKS, vocabularies.PATTERN)
    decoded = decode_bytes(encoded, RANKS, vocabularies.PATTERN, ["doc_id"])
    assert tuples(decoded.selectExpr("doc_id", "cast(decoded as string)")) == sorted(rows, key=repr)
    assert round_trip_digests(empty(spark), RANKS, vocabularies.PATTERN).count() == 0


def check_plan(counts, capacity):
    groups = plan_sequences(counts, capacity)
    used = {}
    for runs, copies in groups:
        assert copies > 0 and sum(n * k for n, k in runs) <= capacity
        for n, k in runs:
            used[n] = used.get(n, 0) + k * copies
    assert used == {n: k for n, k in counts.items() if k}
    return sum(copies for _, copies in groups)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=30))
def test_plans_place_every_piece(counts):
    check_plan(counts, 64)


def test_plans_are_near_the_least_number_of_sequences():
    rnd = random.Random(3)
    counts = {}
    for _ in range(20_000):
        n = min(4096, max(1, int(rnd.lognormvariate(6, 1.2))))
        counts[n] = counts.get(n, 0) + 1
    least = -(-sum(n * k for n, k in counts.items()) // 4096)
    assert check_plan(counts, 4096) <= 1.01 * least
    assert check_plan({4096: 5, 1: 3}, 4096) == 6
    assert plan_sequences({}, 4096) == []
    with pytest.raises(ValueError):
        plan_sequences({4097: 1}, 4096)


def test_fit_reaches_the_histogram_where_patterns_can():
    counts = {60: 10, 40: 10, 20: 0, 50: 7}
    counts.pop(20)
    patterns = enumerate_patterns(counts, 100)
    x = fit_counts(patterns, counts, 100)
    by_pattern = {tuple(n for n in p if n): v for p, v in zip(patterns.tolist(), x, strict=True)}
    assert by_pattern[40, 60] == pytest.approx(10, abs=0.1) and by_pattern[50, 50] == pytest.approx(3.5, abs=0.1)
    assert (x >= 0).all()


def test_packing_is_gapless_and_whole(spark):
    docs = awkward(spark, length=5, sequence_id="x", bucket=2, rank=1).unionByName(
        documents(spark, ["same size words"] * 500, list(range(100, 600)), length=5, sequence_id="x", bucket=2, rank=1)
    )
    capacity = 64
    out = pack(cut_documents(docs, WORDS, capacity), capacity).collect()
    expected = []
    for r in docs.collect():
        ids = [*ids_of(r.text), 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected.append((r.doc_id, piece, at, len(part), zlib.crc32(little(part))))
    assert sorted((tuple(r)[:5] for r in out), key=repr) == sorted(expected, key=repr)
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in out) // capacity)
    assert len(by_sequence) <= 1.05 * least + 1 and sorted(by_sequence) == list(range(len(by_sequence)))
    assert pack(cut_documents(empty(spark), WORDS)).count() == 0
