"""Token counts and packing against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lensmill.llm import bpe, packing, token_counts
from lensmill.llm.common import new_path

from .conftest import EDGE_ROWS

FILES = {"path": bpe.public_path("byte_bpe_50k.json"), "ranks_path": bpe.public_path("byte_bpe_50k.tiktoken")}
STRANGE = ["a <|endoftext|> b", "  \n\n  x", "it's 's", " " * 400 + "x", "١٢٣ ½ ﷽ 👩‍👩‍👧", " \u0085\xa0 .", "x" * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILES["path"])


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_same_ids_as_the_library(text):
    assert bpe.encoder(**FILES)(text) == ids(_LIBRARY, text)


_LIBRARY = Tokenizer.from_file(FILES["path"])


def test_strange_texts(library):
    encode = bpe.encoder(**FILES)
    for text in [*STRANGE, " " * 1_200_000]:  # the last one is refused by the fast engine
        assert encode(text) == ids(library, text)


def test_counts_edges_and_cache(spark, make, edges, empty, library):
    cache = new_path(spark, "test-cache")
    rows = token_counts.token_counts(edges, cache, **FILES).collect()
    want = [(i, len((t or "").encode()), n := len(ids(library, t)), n > 1024) for i, t, _, _ in EDGE_ROWS]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    distinct = len({t or "" for _, t, _, _ in EDGE_ROWS})
    assert spark.read.parquet(cache).count() == distinct
    # Only what the cache lacks is encoded and appended.
    more = edges.unionAll(make([(50, "a new text", "en", "a"), (51, "a new text", "en", "a")]))
    assert token_counts.token_counts(more, cache, **FILES).count() == len(EDGE_ROWS) + 2
    assert spark.read.parquet(cache).count() == distinct + 1
    assert token_counts.token_counts(empty, cache, **FILES).count() == 0


def test_another_tokenizer_has_counts_of_its_own(spark, make, library):
    cache, frame = new_path(spark, "test-cache"), make([(1, "Some words here", "en", "a")])
    assert token_counts.token_counts(frame, cache, **FILES).first().n_tokens == len(ids(library, "Some words here"))
    other = bpe.public_path("word_bpe_49k.json")
    want = len(Tokenizer.from_file(other).encode("Some words here", add_special_tokens=False).ids)
    assert token_counts.token_counts(frame, cache, other).first().n_tokens == want
    assert spark.read.parquet(cache).count() == 2


@pytest.mark.parametrize("total, want", [(0, []), (5, [(0, 5)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)])])
def test_cut(total, want):
    assert packing.cut_lengths(total, 8) == want


def assert_packed(rows, documents, library, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for of in sequences.values():
        at = 0
        for offset, length in sorted(of):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in documents:
        want = np.array([*ids(library, text), 2], "<u4")
        of = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in of] == list(range(len(of))) and sum(r.length for r in of) == len(want)
        for r in of:
            assert r.ids_crc32 == zlib.crc32(want[r.start : r.start + r.length].tobytes())
            assert r.piece == 0 or r.length == capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_pack_whole_table(small, library):
    rows = packing.pack(small, **FILES).collect()
    n, bound = assert_packed(rows, [(r.doc_id, r.text) for r in small.collect()], library, 1024)
    assert n <= bound + 3


def test_pack_edges(edges, empty, library):
    # The doc_id that occurs twice and the null one are checked by their number of rows.
    rows = packing.pack(edges, **FILES, capacity=64, region_items=4).collect()
    once = [(i, t) for i, t, _, _ in EDGE_ROWS if i not in (None, 2)]
    assert_packed([r for r in rows if r.doc_id in dict(once)] and rows, [], library, 64)
    for doc_id, text in once:
        assert sum(r.length for r in rows if r.doc_id == doc_id) == len(ids(library, text)) + 1
    assert sum(r.doc_id == 2 for r in rows) == 2
    assert packing.pack(empty, **FILES).count() == 0


def test_pack_keeps_ids(make, library):
    rows = packing.pack(make([(1, "some text", "en", "a")]), **FILES, keep_ids=True).collect()
    assert rows[0].ids == [*ids(library, "some text"), 2]


@given(st.lists(st.integers(1, 63), min_size=1, max_size=120), st.integers(0, 5))
@settings(max_examples=60, deadline=None)
def test_evolution_keeps_every_piece_once(lengths, seed):
    best = packing.evolve(lengths, [], [seed], 64, 4)
    again = packing.evolve(lengths, [[next(b for b, of in enumerate(best.bins) if i in of) for i in range(len(lengths))]], [seed], 64, 4)
    for found in (best, again):
        assert sorted(i for b in found.bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 64 for b in found.bins)
    assert len(again.bins) <= len(best.bins)
