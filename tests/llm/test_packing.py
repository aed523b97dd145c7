import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docs_fixture import docs_of  # noqa: F401
from millgauge.llm import packing


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t, add_special_tokens=False).ids


ENCODE = packing.encoder(packing.vocabulary_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  \n\t'sdé0ñ_.\x1c\x85\xa0")), max_size=60))
def test_ids_are_those_of_the_library(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(packing, "_held") else packing._held
    tokenizer.encode_special_tokens = True
    packing._held = tokenizer
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" * 2_000_000, "7" * 2_000_000, "x" + "\n \t" * 20_000 + "<s> y"], ids=["spaces", "letters", "digits", "mixed"])
def test_very_long_runs(library, text):
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == library(text)


def test_every_piece_once_and_no_overlap(spark, docs_of, library):
    rows = [(k, "word " * (k * 37 % 400)) for k in range(120)] + [(500, "long text, " * 2500), (501, None), (502, ""), (None, "x"), (3, "word")]
    got = packing.pack(docs_of(rows), keep_ids=True).collect()
    want = []
    for i, t in rows:
        ids = library(t or "") + [2]
        head = len(ids) % 1024 or 1024
        edges = [0, *range(head, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want.append((str(i), k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(w[3] for w in want)
    assert len(places) <= -(-total // 1024) + 1


def test_sweep_is_close_to_the_bound_and_whole():
    counts = {n: (n * 7919) % 23 + 1 for n in range(1, 1024)}
    runs, opened = packing.sweep(counts)
    placed, used = {}, {}
    for length, rank, count, first, offset in runs:
        placed[length] = placed.get(length, 0) + count
        for s in range(first, first + count):
            assert used.get(s, 0) == offset
            used[s] = offset + length
    assert placed == counts and max(used.values()) <= 1024
    assert opened <= 1.01 * sum(n * k for n, k in counts.items()) / 1024 + 1


def test_empty(docs_of):
    assert packing.pack(docs_of([])).count() == 0
