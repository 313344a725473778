import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lensmill.llm import alignment, registry

from .conftest import EDGE_ROWS

A_PATH, RANKS, B_PATH = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
_A = Tokenizer.from_file(A_PATH)
_A.encode_special_tokens = True
_B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def _byte_map():
    kept = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
    rest = [b for b in range(256) if b not in kept]
    return {**{chr(b): b for b in kept}, **{chr(256 + k): b for k, b in enumerate(rest)}}


_MAP = _byte_map()


def tokens(text):
    """[(id, bytes)] of A and of B."""
    a = [(i, bytes(_MAP[c] for c in _A.id_to_token(i))) for i in _A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in _B.encode(text):
        piece = _B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if _B.is_byte(i) else piece.replace("▁", " ").encode()))
    return a, b


def one(text):
    """(n_a, n_b, groups as text, links) by looking at every byte."""
    a, b = tokens(text) if text else ([], [])
    whole = b" " + (text or "").encode()
    if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return 0, 0, 0, "", []
    of_a = [k for k, (_, x) in enumerate(a) for _ in x]
    of_b = [k for k, (_, x) in enumerate(b) for _ in x]
    links = sorted(set(zip(of_a, of_b, strict=True)))
    groups, last = [], len(whole) - 1
    for k in range(len(whole)):
        if k == last or (of_a[k + 1] != of_a[k] and of_b[k + 1] != of_b[k]):
            groups.append((of_a[k] + 1, of_b[k] + 1))
    parts, x, y = [], 0, 0
    for i, j in groups:
        parts.append(",".join(str(t) for t, _ in a[x:i]) + "|" + ",".join(str(t) for t, _ in b[y:j]))
        x, y = i, j
    return len(a), len(b), len(groups), ";".join(parts), [(a[i][0], b[j][0]) for i, j in links]


def brute(rows):
    found = [(i, *one(t)) for i, t in rows]
    counts = Counter(p for *_, links in found for p in set(links))
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for i, n_a, n_b, n_groups, text, links in found:
        best = sum(counts[p] == highest[p[0]] for p in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        out.append((i, n_a, n_b, n_groups, len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out, key=repr)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


STRANGE = [
    "▁ underscore", "<|endoftext|> and <s> </s> <unk> <0x41>", "  two spaces", " ", "tab\tand\r\nlines\n\n", "café naïve 中文 \U0001f600\U0001f3fd",
    "\u0000nul", "ﬁ Ⅰ é", "a" * 3000, "don't I'll", " 　", "1234567 12.5%",
]


def test_whole_query_equals_brute_force(spark, small):
    found = registry.op12_align_tokenizers(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(found) == brute([(r.doc_id, r.text) for r in small.collect()])


@pytest.mark.parametrize("sent", [alignment.SENT, 40, 0])
def test_rare_pairs_are_joined(make, sent):
    """Whatever goes to the tasks as frequent, the figures are the same."""
    rows = [(i, t) for i, t, _, _ in EDGE_ROWS if t is None or len(t) < 9000] + [(100 + k, t) for k, t in enumerate(STRANGE)]
    frame = make([(i, t, "en", "a") for i, t in rows])
    assert got(alignment.align_documents(frame, A_PATH, B_PATH, RANKS, sent=sent)) == brute(rows)


def test_empty_and_long(make, empty):
    assert alignment.align_documents(empty, A_PATH, B_PATH, RANKS).collect() == []
    rows = [(1, "long words " * 12_000), (1, "long words " * 12_000)]
    assert got(alignment.align_documents(make([(i, t, "en", "a") for i, t in rows]), A_PATH, B_PATH)) == brute(rows)


def test_coalesce():
    """Any intervals, also nested and touching ones, against a slow union of bytes."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        starts = np.sort(rng.integers(0, 30, rng.integers(0, 9)))
        ends = starts + rng.integers(1, 6, len(starts))
        want, group, covered = [], -1, set()
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            group += not covered or s > max(covered)
            covered |= set(range(s, e))
            want.append(group)
        assert alignment.coalesce(starts, ends).tolist() == want


def test_both_ways_of_encoding_agree():
    fast, slow = alignment.byte_level(A_PATH, RANKS), alignment.byte_level(A_PATH)
    for text in [*STRANGE, *(t for _, t, _, _ in EDGE_ROWS[:-3] if t)]:
        assert fast.encode(text) == slow.encode(text)


def test_id_pairs(make):
    rows = [(1, "one two"), (2, "one two"), (3, "one")]
    counts = Counter(p for _, t in rows for p in set(one(t)[4]))
    found = alignment.id_pairs(make([(i, t, "en", "a") for i, t in rows]), A_PATH, B_PATH, RANKS)
    assert {(r.a, r.b): r.n for r in found.collect()} == counts
